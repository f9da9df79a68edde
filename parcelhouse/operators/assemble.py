"""Several features side by side."""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from parcelhouse.model import SESSION_KEYS
from parcelhouse.operators.reshape import to_wide


@dataclass(frozen=True)
class Feature:
    """One wide feature: which long rows it is made of, and of which statistic."""

    name: str
    statistic: str
    rows: dict

    def condition(self) -> Column:
        return reduce(
            lambda a, b: a & b, [F.col(c) == v for c, v in self.rows.items()], F.lit(True)
        )


def feature_column(feature: str, region: str) -> str:
    return f"{feature}__{region}"


def assemble_features(
    long: DataFrame, features, regions=None, order=None, region="label", unique=False
):
    """The full outer join of wide features, planned as one filter and one pivot.

    Columns are ``{feature}__{region}``. A chain of outer joins gives the same rows but
    shuffles the growing result once per feature. ``regions`` maps feature name to its
    region list; without it the column list is read from the data. ``unique`` says that a key
    has one row, as published ones have: one shuffle by session is enough then.
    """
    features = list(features)
    if not features:
        raise ValueError("no features asked for")
    wanted = reduce(lambda a, b: a | b, [f.condition() for f in features])
    cells = F.filter(
        F.array(
            *[
                F.struct(
                    F.lit(f.name).alias("feature"),
                    F.when(f.condition(), F.col(f.statistic)).cast("double").alias("value"),
                )
                for f in features
            ]
        ),
        lambda c: c["value"].isNotNull(),
    )
    carried = [c for c in order or () if c not in SESSION_KEYS]
    rows = long.where(wanted).select(*SESSION_KEYS, region, *carried, F.inline(cells))
    named = rows.withColumn("_column", F.concat("feature", F.lit("__"), region))
    columns = None
    if regions is not None:
        columns = [feature_column(f.name, r) for f in features for r in regions[f.name]]
    return to_wide(named, "_column", "value", columns, order, unique=unique)
