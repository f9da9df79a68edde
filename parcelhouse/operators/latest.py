"""Keep one row per key, and unions of tables that grew different columns."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from parcelhouse.model import LOAD_ORDER, SESSION_KEYS


def _first_row(df, keys, ordering):
    # row_number() = 1 plans a WindowGroupLimit below the exchange: every map task sends
    # at most one row per key, so a key that holds a third of the table stays cheap.
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*ordering))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def keep_last(df: DataFrame, keys, order=LOAD_ORDER) -> DataFrame:
    """The last row of each key in ``order``."""
    return _first_row(df, keys, [F.col(c).desc_nulls_last() for c in order])


def keep_first(df: DataFrame, keys, order) -> DataFrame:
    """The first row of each key in ``order``."""
    return _first_row(df, keys, [F.col(c).asc_nulls_last() for c in order])


def keep_preferred(df: DataFrame, keys, path: Column, patterns, usable: Column) -> DataFrame:
    """One row per key: the first pattern of the list that has a usable row.

    Rows that match no pattern come last and are tried only through the first of them by
    path: if that one is not usable the key has no result.
    """
    preference = F.lit(len(patterns))
    for position in reversed(range(len(patterns))):
        preference = F.when(path.rlike(patterns[position]), position).otherwise(preference)
    rows = df.select(
        *keys, F.struct("*").alias("_row"), preference.alias("_preference"), path.alias("_path"),
        F.coalesce(usable, F.lit(False)).alias("_usable"),
    )
    named = F.when(
        F.col("_usable") & (F.col("_preference") < len(patterns)), F.struct("_preference", "_path")
    )
    # One grouping, reduced before the shuffle. "Any file" means the first one by path, whatever its name.
    best = rows.groupBy(*keys).agg(
        F.min_by("_row", named).alias("_best"),
        F.min_by(F.struct("_row", "_usable"), F.col("_path")).alias("_any"),
    )
    chosen = F.coalesce(F.col("_best"), F.when(F.col("_any._usable"), F.col("_any._row")))
    return best.select(chosen.alias("_row")).where(F.col("_row").isNotNull()).select("_row.*")


def last_values(df: DataFrame, keys, values, order: str) -> DataFrame:
    """Last non-null value per key and column; hash aggregation with map-side combine."""
    return df.groupBy(*keys).agg(
        *[
            F.max_by(F.col(v), F.when(F.col(v).isNotNull(), F.col(order))).alias(v)
            for v in values
        ]
    )


def union_all(frames) -> DataFrame:
    """Union by name; a column a table lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def session_pairs(*frames) -> DataFrame:
    """Distinct session keys over several tables."""
    return union_all([f.select(*SESSION_KEYS) for f in frames]).distinct()
