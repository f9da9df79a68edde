"""Quality rules over regional measurements."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from parcelhouse.model import SESSION_KEYS
from parcelhouse.operators.quantiles import exact_quantiles
from parcelhouse.plans.scratch import materialize

OUTLIER_THRESHOLD = 3.0
MIN_VALID_SHARE = 0.8
MAX_OUTLIER_SHARE = 0.1


def outlier_limits(
    long: DataFrame, by=("label", "metric"), value="value", threshold=OUTLIER_THRESHOLD
) -> DataFrame:
    """IQR and z-score limits per region and metric: few groups, each of many sessions."""
    found = exact_quantiles(long, by, value, [0.25, 0.75])
    q = F.col("quantiles")
    reach = threshold * (q[1] - q[0])
    return found.select(
        *by, F.col("mean").alias("_mean"), F.col("std").alias("_std"),
        (q[0] - reach).alias("_low"), (q[1] + reach).alias("_high"),
    )


def outlier_flags(
    long: DataFrame, by=("label", "metric"), value="value", threshold=OUTLIER_THRESHOLD
) -> DataFrame:
    """Rows with ``iqr_outlier`` and ``z_outlier``; null where there is no value."""
    # Few rows (regions x metrics), written so that the planner sees it: the long table
    # is not shuffled by region, where single regions would be hot.
    limits = materialize(outlier_limits(long, by, value, threshold), "outlier-limits")
    v = F.col(value)
    z = F.try_divide(F.abs(v - F.col("_mean")), F.col("_std"))
    return long.join(limits, list(by), "left").withColumns(
        {
            "iqr_outlier": (v < F.col("_low")) | (v > F.col("_high")),
            "z_outlier": F.when(v.isNotNull(), F.coalesce(z > threshold, F.lit(False))),
        }
    ).drop("_mean", "_std", "_low", "_high")


def valid_share(long: DataFrame, value="value", region="label", n_regions=None) -> DataFrame:
    """Share of all regions that have a value, per session."""
    keys = list(SESSION_KEYS)
    cells = long.groupBy(*keys, region).agg(F.count(value).alias("_n"))
    total = (
        F.lit(n_regions)
        if n_regions is not None
        else long.agg(F.countDistinct(region)).scalar()
    )
    return cells.groupBy(*keys).agg(F.count_if(F.col("_n") > 0).alias("n_valid")).select(
        *keys, "n_valid", (F.col("n_valid") / total).alias("valid_share")
    )


def enough_valid(long, value="value", region="label", n_regions=None, minimum=MIN_VALID_SHARE):
    """Sessions with values for at least ``minimum`` of the regions."""
    return valid_share(long, value, region, n_regions).where(F.col("valid_share") >= minimum)


def session_quality(
    long: DataFrame, by=("label", "metric"), value="value", region="label", n_regions=None,
    minimum=MIN_VALID_SHARE, maximum=MAX_OUTLIER_SHARE, threshold=OUTLIER_THRESHOLD,
) -> DataFrame:
    """Per session: valid share, outlier share and ``qc_pass``.

    A session passes with at least ``minimum`` valid regions and at most ``maximum`` of its
    values flagged by either outlier rule.
    """
    keys = list(SESSION_KEYS)
    flagged = outlier_flags(long, by, value, threshold)
    outliers = flagged.groupBy(*keys).agg(
        F.count(value).alias("n_values"),
        F.count_if(F.col("iqr_outlier") | F.col("z_outlier")).alias("n_outliers"),
    )
    joined = valid_share(long, value, region, n_regions).join(outliers, keys, "left")
    share = F.coalesce(F.try_divide("n_outliers", "n_values"), F.lit(0.0))
    return joined.select(
        *keys, "n_valid", "valid_share", "n_outliers", share.alias("outlier_share"),
        ((F.col("valid_share") >= minimum) & (share <= maximum)).alias("qc_pass"),
    )


def validation_report(
    features: dict, metadata: DataFrame, key="participant_id", required=(), optional=(),
) -> DataFrame:
    """Findings ``(severity, rule, dataset, n, sample)`` over published tables.

    Rules: required columns exist, optional ones too (a warning), ids are not null, ids are
    unique, feature ids are described in the metadata, and described ids have features (a
    warning). The ids of a table are summed up first, in any order; only tables whose sums differ
    from those of sound metadata are joined with it.
    """
    spark = metadata.sparkSession
    named = {"metadata": metadata, **features}
    found, absent = [], []
    for name, df in named.items():
        for column in (key, *required) if name == "metadata" else (key,):
            if column not in df.columns:
                absent.append(("error", "missing column", name, 1, column))
    absent += [
        ("warning", "missing optional column", "metadata", 1, c)
        for c in optional if c not in metadata.columns
    ]
    described, same = None, set()
    if key in metadata.columns:
        described = metadata.select(key).dropna().distinct().withColumn("_described", F.lit(True))
        own = _id_findings(metadata, "metadata", key, None).where(F.col("n") > 0).collect()
        found.append(spark.createDataFrame(own, _FINDING))
        if not own:
            sums = _id_sums({n: df for n, df in named.items() if key in df.columns}, key)
            same = {n for n, s in sums.items() if s == sums["metadata"]}
    for name, df in features.items():
        if key in df.columns and name not in same:
            found.append(_id_findings(df, name, key, described))
    if absent:
        found.append(spark.createDataFrame(absent, _FINDING))
    if not found:
        return spark.createDataFrame([], _FINDING)
    return reduce(DataFrame.unionByName, found).where(F.col("n") > 0)


def _id_sums(tables: dict, key) -> dict:
    """Count, sum and exclusive or of two hashes of the ids, for all tables in one job."""
    h, other = F.xxhash64(F.col(key).cast("string")), F.hash(F.col(key).cast("string"))
    parts = [
        df.agg(
            F.lit(name).alias("name"), F.count("*").alias("n"), F.count(key).alias("known"),
            F.sum(h.cast("decimal(38,0)")).alias("total"), F.bit_xor(h).alias("x"),
            F.sum(other.cast("bigint")).alias("other"),
        )
        for name, df in tables.items()
    ]
    rows = reduce(DataFrame.unionByName, parts).collect()
    return {r["name"]: tuple(r)[1:] for r in rows}


_FINDING = "severity string, rule string, dataset string, n bigint, sample string"


def _id_findings(df: DataFrame, name, key, described) -> DataFrame:
    """All id rules of one table: one scan of its ids, one join with the described ids."""
    ids = df.groupBy(key).agg(F.count("*").alias("_rows"))
    present = F.col("_rows").isNotNull()
    known = F.col(key).isNotNull()
    rules = [
        ("error", "null id", F.when(~known, F.col("_rows")), ~known),
        ("error", "duplicate id", F.lit(1), known & (F.col("_rows") > 1)),
    ]
    if described is not None:
        ids = ids.join(described, key, "full")
        without = F.col("_described").isNull()
        rules += [
            ("error", "id without metadata", F.lit(1), known & present & without),
            ("warning", "id without features", F.lit(1), ~present),
        ]
    text = F.col(key).cast("string")
    counts = ids.agg(
        *[
            F.struct(
                F.lit(severity).alias("severity"), F.lit(rule).alias("rule"),
                F.lit(name).alias("dataset"),
                F.coalesce(F.sum(F.when(hit, weight)), F.lit(0)).cast("bigint").alias("n"),
                F.min(F.when(hit, text)).alias("sample"),
            ).alias(f"_f{i}")
            for i, (severity, rule, weight, hit) in enumerate(rules)
        ]
    )
    return counts.select(F.inline(F.array(*[f"_f{i}" for i in range(len(rules))])))


def validation_summary(report: DataFrame) -> DataFrame:
    """One row: valid or not, numbers of errors and warnings."""
    return report.agg(
        (F.count_if(F.col("severity") == "error") == 0).alias("valid"),
        F.count_if(F.col("severity") == "error").alias("n_errors"),
        F.count_if(F.col("severity") == "warning").alias("n_warnings"),
    )
