"""Counts, summaries and data profiles.

Global numbers come from scalar subqueries or one-row aggregates, never from a window
without partitions; distinct counts are taken in two levels so that both combine map-side.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from parcelhouse.functions import bare_code
from parcelhouse.model import SESSION_KEYS
from parcelhouse.operators.quantiles import exact_quantiles
from parcelhouse.operators.reshape import first_values


def numeric_columns(df: DataFrame, leave_out=()) -> list:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in leave_out
    ]


def text_columns(df: DataFrame, leave_out=()) -> list:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and f.name not in leave_out
    ]


def _tick(name):
    return F.col(f"`{name}`")


def _rows_from(columns: dict, df: DataFrame, name="column") -> DataFrame:
    """One-row frame to one row per entry; ``columns`` maps name to a struct of its cells."""
    return df.select(
        F.inline(
            F.array(*[F.struct(F.lit(c).alias(name), *cells) for c, cells in columns.items()])
        )
    )


def melt(df: DataFrame, columns, ids=(), name="feature", value="value") -> DataFrame:
    return df.select(*ids, *[_tick(c).cast("double").alias(c) for c in columns]).unpivot(
        list(ids), [_tick(c) for c in columns], name, value
    )


def session_counts(df: DataFrame) -> DataFrame:
    """Numbers of distinct sessions and subjects."""
    subject, session = SESSION_KEYS
    return (
        df.groupBy(subject, session).agg(F.lit(1).alias("_one"))
        .groupBy(subject).agg(F.count("*").alias("_n"))
        .agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("n_sessions"),
            F.count("*").alias("n_subjects"),
        )
    )


def value_statistics(df: DataFrame, column="AGE") -> DataFrame:
    """min, max, mean and number missing; all null when there is no value."""
    c = _tick(column)
    return df.agg(
        F.min(c).alias("min"), F.max(c).alias("max"), F.avg(c).alias("mean"),
        F.count_if(c.isNull()).alias("missing"),
    )


def column_statistics(df: DataFrame, columns, probs=(0.25, 0.5, 0.75)) -> DataFrame:
    """n, mean, std, min, quantiles and max per column; columns without values are left out."""
    return exact_quantiles(melt(df, columns), ["feature"], "value", probs)


def cohort_statistics(answers: DataFrame, features) -> DataFrame:
    """mean, std, median, min, max, n per feature over the given rows."""
    found = column_statistics(answers, features, [0.5])
    return found.select(
        "feature", "mean", "std", F.col("quantiles")[0].alias("median"), "min", "max", "n"
    )


def describe(df: DataFrame, columns) -> DataFrame:
    """count, mean, std, min, quartiles, max per numeric column."""
    q = F.col("quantiles")
    return column_statistics(df, columns).select(
        "feature", F.col("n").alias("count"), "mean", "std", "min",
        q[0].alias("q25"), q[1].alias("q50"), q[2].alias("q75"), "max",
    )


def parameters_by_model(df: DataFrame) -> DataFrame:
    """Sorted distinct parameters of each model (bounded by the vocabulary)."""
    return (
        df.select("model", "param").dropna().distinct()
        .groupBy("model").agg(F.sort_array(F.collect_list("param")).alias("params"))
    )


def coverage(df: DataFrame, by, region="label", subject="subject_code") -> DataFrame:
    """Distinct regions and subjects per group."""
    return df.dropna(subset=list(by)).groupBy(*by).agg(
        F.countDistinct(region).alias("n_regions"), F.countDistinct(subject).alias("n_subjects")
    )


def region_consistency(df: DataFrame, by, region="label") -> DataFrame:
    """Distinct regions per session, then their min, max and mean per group."""
    keys = [*by, *[k for k in SESSION_KEYS if k not in by]]
    per_session = df.dropna(subset=keys).groupBy(*keys).agg(F.countDistinct(region).alias("_n"))
    return per_session.groupBy(*by).agg(
        F.min("_n").alias("min_regions"), F.max("_n").alias("max_regions"),
        F.avg("_n").alias("mean_regions"),
    )


def total_statistics(df: DataFrame, value="tiv", order=None) -> DataFrame:
    """One total per session (the first), then mean, std, min and max."""
    return first_values(df, list(SESSION_KEYS), [value], order).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"), F.min(value).alias("min"), F.max(value).alias("max"),
    )


def missing_profile(df: DataFrame, columns=None) -> DataFrame:
    """Missing values and their share per column, most first; one pass over the table."""
    columns = columns or df.columns
    counts = df.agg(
        F.count("*").alias("_rows"),
        *[F.count(_tick(c)).alias(f"_c{i}") for i, c in enumerate(columns)],
    )
    missing = {
        c: [
            (F.col("_rows") - F.col(f"_c{i}")).alias("missing"),
            F.try_divide(100.0 * (F.col("_rows") - F.col(f"_c{i}")), F.col("_rows")).alias("pct"),
        ]
        for i, c in enumerate(columns)
    }
    return _rows_from(missing, counts).orderBy(F.col("missing").desc(), "column")


def negative_profile(df: DataFrame, columns=None) -> DataFrame:
    """Number of negative values per numeric column that has some."""
    columns = columns or numeric_columns(df)
    counts = df.agg(
        *[F.count_if(_tick(c) < 0).alias(f"_c{i}") for i, c in enumerate(columns)]
    )
    cells = {c: [F.col(f"_c{i}").alias("n_negative")] for i, c in enumerate(columns)}
    return _rows_from(cells, counts).where(F.col("n_negative") > 0)


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Keys that occur more than once, with their multiplicity."""
    return df.groupBy(*keys).agg(F.count("*").alias("multiplicity")).where("multiplicity > 1")


def duplicate_count(df: DataFrame, keys) -> DataFrame:
    """Number of rows that share their key with another row, and of such keys."""
    return duplicate_keys(df, keys).agg(
        F.coalesce(F.sum("multiplicity"), F.lit(0)).alias("duplicate_rows"),
        F.count("*").alias("duplicate_keys"),
    )


def range_check(df: DataFrame, ranges: dict, by=()) -> DataFrame:
    """Per column (and group): actual min and max against the expected range."""
    counts = df.groupBy(*by).agg(
        *[
            F.struct(
                F.min(_tick(c)).cast("double").alias("actual_min"),
                F.max(_tick(c)).cast("double").alias("actual_max"),
                F.count_if((_tick(c) < lo) | (_tick(c) > hi)).alias("n_out_of_range"),
            ).alias(f"_c{i}")
            for i, (c, (lo, hi)) in enumerate(ranges.items())
        ]
    )
    rules = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"), F.lit(float(lo)).alias("expected_min"),
                F.lit(float(hi)).alias("expected_max"), F.col(f"_c{i}").alias("found"),
            )
            for i, (c, (lo, hi)) in enumerate(ranges.items())
        ]
    )
    return counts.select(*by, F.explode(rules).alias("_r")).select(*by, "_r.*").select(
        *by, "column", "expected_min", "expected_max", "found.*"
    )


def parameter_range_check(df: DataFrame, ranges: dict, param="param", value="mean") -> DataFrame:
    """As :func:`range_check` for long rows, where the parameter names the range."""
    rules = df.sparkSession.createDataFrame(
        [(p, float(lo), float(hi)) for p, (lo, hi) in ranges.items()],
        f"`{param}` string, expected_min double, expected_max double",
    )
    v = _tick(value)
    # One row per documented parameter, a literal table: the planner sees that it is tiny.
    return df.join(rules, param).groupBy(param, "expected_min", "expected_max").agg(
        F.min(v).alias("actual_min"), F.max(v).alias("actual_max"),
        F.count_if((v < F.col("expected_min")) | (v > F.col("expected_max"))).alias(
            "n_out_of_range"
        ),
    )


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows and share of each value; null is a value of its own."""
    groups = df.groupBy(_tick(column).alias("value")).agg(F.count("*").alias("n"))
    total = groups.agg(F.sum("n")).scalar()
    return groups.select("value", "n", (F.col("n") * 100.0 / total).alias("pct"))


def distributions(df: DataFrame, columns) -> DataFrame:
    """The distribution of several columns, one pass over the table."""
    long = df.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column"), _tick(c).cast("string").alias("value"))
                    for c in columns
                ]
            )
        )
    )
    groups = long.groupBy("column", "value").agg(F.count("*").alias("n"))
    rows = groups.where(F.col("column") == columns[0]).agg(F.sum("n")).scalar()
    return groups.select("column", "value", "n", (F.col("n") * 100.0 / rows).alias("pct"))


def correlation(df: DataFrame, columns) -> DataFrame:
    """Correlation matrix as rows ``(a, b, r)``; a pair uses the rows where both exist.

    Every task sums products of whole column blocks (counts, values, squares, for each pair over its
    common rows) and sends one row per pair; values are taken from the column's mean, which
    keeps the sums exact. Null where a column doesn't vary over the common rows.
    """
    columns = list(columns)
    numbers = df.select(*[_tick(c).cast("double").alias(f"_{i}") for i, c in enumerate(columns)])
    means = numbers.agg(*[F.avg(c) for c in numbers.columns]).first()
    center = np.array([m if m is not None and np.isfinite(m) else 0.0 for m in means])
    first, second = np.triu_indices(len(columns))

    def sums(batches):
        total = None
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])
            there = ~np.isnan(x)
            x = np.where(there, x - center, 0.0)
            there = there.astype(float)
            part = np.stack([there.T @ there, x.T @ there, (x * x).T @ there, x.T @ x])
            total = part if total is None else total + part
        if total is not None:
            n, one, squares, products = total
            cells = [
                first, second, n[first, second], one[first, second], one[second, first],
                squares[first, second], squares[second, first], products[first, second],
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cells], names=names)

    names = ["i", "j", "n", "x", "y", "xx", "yy", "xy"]
    kinds = ", ".join(f"{c} {'bigint' if c in 'ij' else 'double'}" for c in names)
    found = numbers.mapInArrow(sums, kinds).groupBy("i", "j").agg(
        *[F.sum(c).alias(c) for c in names[2:]]
    )
    spread = F.sqrt(F.expr("n * xx - x * x")) * F.sqrt(F.expr("n * yy - y * y"))
    r = F.when(spread > 0, F.expr("n * xy - x * y") / spread)
    name = F.array(*[F.lit(c) for c in columns])
    pair = F.struct(name[F.col("i").cast("int")].alias("a"), name[F.col("j").cast("int")].alias("b"))
    turned = F.struct(pair["b"].alias("a"), pair["a"].alias("b"))
    both = F.when(F.col("i") == F.col("j"), F.array(pair)).otherwise(F.array(pair, turned))
    return found.select(r.alias("r"), F.inline(both)).select("a", "b", "r")


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Counts in equal-width bins from min to max; empty bins are listed too."""
    c = _tick(column).cast("double")
    values = df.select(c.alias("v")).where(F.col("v").isNotNull())
    edges = values.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    span = F.when(F.col("lo") == F.col("hi"), F.lit(0.5)).otherwise(0.0)
    edges = edges.select((F.col("lo") - span).alias("lo"), (F.col("hi") + span).alias("hi"))
    ends = edges.select(F.struct("lo", "hi")).scalar()
    lo, hi = ends["lo"], ends["hi"]
    placed = values.select(
        F.least(F.floor((F.col("v") - lo) / (hi - lo) * bins), F.lit(bins - 1))
        .cast("int").alias("bin")
    )
    counted = placed.groupBy("bin").agg(F.count("*").alias("n"))
    width = (hi - lo) / bins
    frame = df.sparkSession.range(bins).select(
        F.col("id").cast("int").alias("bin"),
        (lo + F.col("id") * width).alias("from_value"),
        (lo + (F.col("id") + 1) * width).alias("to_value"),
    ).where(F.col("from_value").isNotNull())
    return frame.join(counted, "bin", "left").select(
        "bin", "from_value", "to_value", F.coalesce("n", F.lit(0)).alias("n")
    )


def column_profile(df: DataFrame, column: str) -> DataFrame:
    """Non-null and null rows; min, max, mean of a number, number of values of a text."""
    c = _tick(column)
    counts = [F.count(c).alias("n_non_null"), F.count_if(c.isNull()).alias("n_null")]
    if column in numeric_columns(df):
        return df.agg(*counts, F.min(c).alias("min"), F.max(c).alias("max"), F.avg(c).alias("mean"))
    return df.agg(*counts, F.countDistinct(c).alias("n_distinct"))


def top_values(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    """The k most frequent values, ties by value."""
    groups = df.where(_tick(column).isNotNull()).groupBy(_tick(column).alias("value"))
    return groups.agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "value").limit(k)


def head(df: DataFrame, order, k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def find_columns(df: DataFrame, text: str) -> list:
    """Names of the columns that contain ``text``, in any case."""
    return [c for c in df.columns if text.lower() in c.lower()]


def find_subjects(df: DataFrame, text: str, column="Subject Code") -> DataFrame:
    """Rows whose code contains ``text``."""
    return df.where(F.contains(_tick(column), bare_code(F.lit(text))))


def ledger_status(ledger: DataFrame) -> DataFrame:
    """Distinct sessions per source."""
    return ledger.select(*SESSION_KEYS, "source").distinct().groupBy("source").agg(
        F.count("*").alias("n_sessions")
    )


def outcome_summary(
    sessions: DataFrame, loaded: DataFrame, failed: DataFrame = None
) -> DataFrame:
    """Sessions by load outcome: ``success`` with data; without, ``error`` if a file of theirs
    failed, else ``skipped``."""
    keys = list(SESSION_KEYS)

    def marked(df, name):
        return df.select(*keys).distinct().withColumn(name, F.lit(True))

    found = sessions.select(*keys).join(marked(loaded, "_found"), keys, "left")
    status = F.when(F.col("_found"), "success")
    if failed is not None:
        found = found.join(marked(failed, "_failed"), keys, "left")
        status = status.when(F.col("_failed"), "error")
    return found.groupBy(status.otherwise("skipped").alias("status")).agg(F.count("*").alias("n"))
