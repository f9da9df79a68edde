"""Joins between session-keyed tables. No broadcast hints: registries and scalars grow
with the data, so Spark decides by their size (and AQE splits skewed partitions)."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from parcelhouse.functions import bare_code, prefixed
from parcelhouse.model import (
    ALL_STATISTICS,
    FEATURE_PREFIXES,
    LOAD_SOURCES,
    REGION_COLUMNS,
    SESSION_KEYS,
    age_column,
)

_KEYS = list(SESSION_KEYS)


def attach(df: DataFrame, other: DataFrame, keys=SESSION_KEYS) -> DataFrame:
    """Left join on the session keys, bringing only columns ``df`` lacks.

    Serves session metadata, totals and covariates; columns that start with ``_`` stay out.
    """
    new = [c for c in other.columns if c not in df.columns and not c.startswith("_")]
    return df.join(other.select(*keys, *[f"`{c}`" for c in new]), list(keys), "left")


def attach_regions(long: DataFrame, lookup: DataFrame, on="label") -> DataFrame:
    """Region attributes of the lookup table onto long rows."""
    return attach(long, lookup, [on])


def covariate_columns(columns, age=None) -> list:
    """Keys, the age column, then all that is no feature, statistic or region column."""
    resolved = age_column(columns, age)
    head = [c for c in _KEYS if c in columns] + ([resolved] if resolved else [])
    skip = set(head) | set(ALL_STATISTICS) | set(REGION_COLUMNS)
    return head + [
        c for c in columns if c not in skip and not c.startswith(FEATURE_PREFIXES)
    ]


def session_covariates(df: DataFrame, age=None) -> DataFrame:
    """Distinct session rows with their covariates; age is always called ``AGE``."""
    resolved = age_column(df.columns, age)
    chosen = []
    for name in covariate_columns(df.columns, age):
        if name == resolved:
            chosen.append(F.col(f"`{name}`").alias("AGE"))
        elif resolved is None or name.lower() != "age":
            chosen.append(F.col(f"`{name}`"))
    return df.select(*chosen).distinct()


def loaded_with_age(pairs: DataFrame, registry: DataFrame, age=None) -> DataFrame:
    """Session pairs with their age, called ``AGE``."""
    resolved = age_column(registry.columns, age)
    if resolved is None:
        return pairs
    ages = registry.select(*_KEYS, F.col(f"`{resolved}`").alias("AGE")).distinct()
    return pairs.join(ages, _KEYS, "left")


def only_sessions(df: DataFrame, sessions: DataFrame) -> DataFrame:
    """Rows of the given sessions."""
    return df.join(sessions.select(*_KEYS), _KEYS, "left_semi")


def without_sessions(df: DataFrame, sessions: DataFrame) -> DataFrame:
    """Rows of all other sessions."""
    return df.join(sessions.select(*_KEYS), _KEYS, "left_anti")


def missing_sessions(
    registry: DataFrame, loaded: DataFrame, reason="no data", failed: DataFrame = None
) -> DataFrame:
    """Report of registered sessions without data: the reasons of its failed files
    (``subject_code, session_id, reason``), else ``reason``."""
    missing = without_sessions(registry.select(*_KEYS), loaded)
    if failed is None:
        return missing.withColumn("reason", F.lit(reason))
    # The vocabulary of reasons bounds the list.
    why = failed.groupBy(*_KEYS).agg(
        F.array_join(F.sort_array(F.collect_set("reason")), "; ").alias("_why")
    )
    return missing.join(why, _KEYS, "left").select(
        *_KEYS, F.coalesce("_why", F.lit(reason)).alias("reason")
    )


def full_outer(frames: dict, keys=SESSION_KEYS, separator="_") -> DataFrame:
    """Wide tables side by side, joined on the keys, columns prefixed by table name.

    One keyed union and one grouping, however many tables: each row travels as one struct. A table
    with two rows for a key is an error; rows with equal keys meet, null keys included.
    """
    keys = list(keys)
    named = [prefixed(df, name, keys, separator) for name, df in frames.items()]
    columns = [[c for c in df.columns if c not in keys] for df in named]

    def packed(df, mine):
        here = F.struct(F.lit(True).alias("_in"), *[F.col(f"`{c}`") for c in columns[mine]])
        kinds = [n.select(F.struct(F.lit(True).alias("_in"), *[F.col(f"`{c}`") for c in columns[i]]).alias("t"))
                 .schema["t"].dataType for i, n in enumerate(named)]
        return df.select(
            *keys,
            *[(here if i == mine else F.lit(None)).cast(k).alias(f"_t{i}") for i, k in enumerate(kinds)],
        )

    union = reduce(DataFrame.unionByName, [packed(df, i) for i, df in enumerate(named)])
    together = union.groupBy(*keys).agg(
        *[F.first(f"_t{i}", ignorenulls=True).alias(f"_t{i}") for i in range(len(named))],
        *[F.count(f"_t{i}").alias(f"_n{i}") for i in range(len(named))],
    )
    several = [
        F.when(F.col(f"_n{i}") > 1, F.raise_error(F.lit(f"table {name} has several rows for a key")))
        for i, name in enumerate(frames)
    ]
    cells = [
        F.col(f"_t{i}")[c].alias(c) for i, held in enumerate(columns) for c in held
    ]
    # The check is part of a column, so that it can't be pruned away.
    checked = F.coalesce(*[e.cast(union.schema[keys[0]].dataType) for e in several], F.col(keys[0]))
    return together.select(checked.alias(keys[0]), *keys[1:], *cells)


def with_questionnaire(
    sessions: DataFrame, answers: DataFrame, on="Subject Code", subject="subject_code"
) -> DataFrame:
    """Sessions with the answers of their subject; codes are compared without separators."""
    left = sessions.withColumn(subject, bare_code(subject))
    right = answers.withColumnRenamed(on, "_match")
    joined = left.join(right, F.col(subject) == F.col("_match"), "left")
    return joined.withColumnRenamed("_match", on)


def match_audit(joined: DataFrame, matched: Column) -> DataFrame:
    """Numbers of matched and unmatched rows."""
    return joined.agg(
        F.count_if(matched).alias("n_matched"), F.count_if(~matched).alias("n_unmatched")
    )


def of_cohort(answers: DataFrame, cohort: DataFrame, on="Subject Code", code="subject_code"):
    """Answers of the subjects in the cohort."""
    wanted = cohort.select(bare_code(code).alias("_code"))
    return answers.join(wanted, bare_code(f"`{on}`") == F.col("_code"), "left_semi")


def flag_column(source: str) -> str:
    return "diffusion_loaded" if source == "diffusion" else f"anatomical_{source}_loaded"


def loaded_flags(ledger: DataFrame, sources=LOAD_SOURCES) -> DataFrame:
    """One row per session in the ledger, one boolean per source."""
    return ledger.groupBy(*_KEYS).agg(
        *[F.bool_or(F.col("source") == s).alias(flag_column(s)) for s in sources]
    )


def with_loaded_flags(registry: DataFrame, ledger: DataFrame, sources=LOAD_SOURCES) -> DataFrame:
    """Registry with its load flags; false where the ledger has nothing."""
    joined = attach(
        registry.drop(*[flag_column(s) for s in sources]), loaded_flags(ledger, sources)
    )
    return joined.withColumns(
        {flag_column(s): F.coalesce(flag_column(s), F.lit(False)) for s in sources}
    )


def pending_work(registry: DataFrame, ledger: DataFrame, sources=LOAD_SOURCES) -> DataFrame:
    """Sessions that still need sources, with the list of them."""
    if not sources:
        raise ValueError("no sources asked for")
    wanted = registry.select(
        *_KEYS, F.explode(F.array(*[F.lit(s) for s in sources])).alias("source")
    )
    open_ = wanted.join(
        ledger.select(*_KEYS, "source"), [*_KEYS, "source"], "left_anti"
    )
    # At most one entry per source: the list is bounded by the vocabulary.
    return open_.groupBy(*_KEYS).agg(
        F.sort_array(F.collect_set("source")).alias("sources_to_load")
    )


def pending_sessions(registry: DataFrame, ledger: DataFrame, sources=LOAD_SOURCES) -> DataFrame:
    """The full registry rows of the pending sessions, with ``sources_to_load``."""
    return registry.join(pending_work(registry, ledger, sources), _KEYS, "inner")


def pending_breakdown(pending: DataFrame) -> DataFrame:
    """How many sessions need each source."""
    return (
        pending.select(F.explode("sources_to_load").alias("source"))
        .groupBy("source")
        .agg(F.count("*").alias("n_sessions"))
    )
