"""Names of features and datasets."""

from pyspark.sql import Column, DataFrame, functions as F

from parcelhouse.functions.identifiers import _col
from parcelhouse.model import ALL_STATISTICS


def strip_dataset_prefix(name) -> Column:
    """``anatomical_gm`` -> ``gm``, ``diffusion_X`` -> ``X``."""
    return F.regexp_replace(_col(name), "^(anatomical|diffusion)_", "")


def prefixed(df: DataFrame, prefix: str, keep=(), separator="_") -> DataFrame:
    """Every column renamed to ``{prefix}{separator}{column}``, except those in ``keep``."""
    return df.select(
        *[
            F.col(f"`{c}`").alias(c if c in keep else f"{prefix}{separator}{c}")
            for c in df.columns
        ]
    )


def parse_feature_name(name: str, modality: str, statistics=ALL_STATISTICS) -> dict:
    """Split a feature name into pipeline, metric and statistic.

    Statistics may have underscores (``z_filtered_mean``), so the longest known one that
    ends the name wins; an unknown statistic is the last word (diffusion) or all that
    follows the metric (anatomical).
    """
    known = sorted((s for s in statistics if name.endswith("_" + s)), key=len)
    if modality == "anatomical":
        metric, _, statistic = name.partition("_")
        if known:
            statistic = known[-1]
            metric = name[: -len(statistic) - 1]
        return {"pipeline": None, "metric": metric, "statistic": statistic}
    statistic = known[-1] if known else name.rpartition("_")[2]
    pipeline, _, metric = name[: -len(statistic) - 1].partition("_")
    return {"pipeline": pipeline, "metric": metric, "statistic": statistic}
