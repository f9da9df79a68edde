"""Statistics of a region from the rows of its voxels.

Definitions, over the non-null values x of one group:

* ``mad_median``     median(|x - median|)
* ``robust_*``       over |x - median| <= 3 * 1.4826 * mad_median (all x if that is 0)
* ``z_filtered_*``   over |x - mean| <= 3 * std (all x if std is null or 0)
* ``iqr_filtered_*`` over [Q1 - 1.5 IQR, Q3 + 1.5 IQR]
* ``volume_mm3``     number of voxels times the volume of one

``std`` is the sample deviation throughout.
"""

from pyspark.sql import DataFrame, functions as F

from parcelhouse.operators.quantiles import exact_quantiles
from parcelhouse.plans.scratch import materialize

_QUARTILES = (0.25, 0.5, 0.75)
_NORMAL_MAD = 1.4826


def _deviation():
    return F.abs(F.col("_v") - F.col("_q")[1])


def _summaries(rows: DataFrame, by, voxel_volume: float) -> DataFrame:
    """Final aggregates; ``rows`` carry ``_v`` and the group's _q, _mad, _mean, _std."""
    v, q = F.col("_v"), F.col("_q")
    spread = 1.5 * (q[2] - q[0])
    robust = (F.col("_mad") == 0) | (_deviation() <= 3 * _NORMAL_MAD * F.col("_mad"))
    near = F.col("_std").isNull() | (F.col("_std") == 0) | (
        F.abs(v - F.col("_mean")) <= 3 * F.col("_std")
    )
    inside = v.between(q[0] - spread, q[2] + spread)
    return rows.groupBy(*by).agg(
        (F.count("*") * F.lit(float(voxel_volume))).alias("volume_mm3"),
        F.count("*").alias("voxel_count"),
        F.avg(v).alias("mean"),
        F.stddev_samp(v).alias("std"),
        F.first(q[1]).alias("median"),
        F.sum(v).alias("sum"),
        F.first("_mad").alias("mad_median"),
        F.avg(F.when(robust, v)).alias("robust_mean"),
        F.stddev_samp(F.when(robust, v)).alias("robust_std"),
        F.avg(F.when(near, v)).alias("z_filtered_mean"),
        F.stddev_samp(F.when(near, v)).alias("z_filtered_std"),
        F.avg(F.when(inside, v)).alias("iqr_filtered_mean"),
        F.stddev_samp(F.when(inside, v)).alias("iqr_filtered_std"),
    )


def region_statistics(
    voxels: DataFrame,
    by=("subject_code", "session_id", "label"),
    value: str = "value",
    voxel_volume: float = 1.0,
) -> DataFrame:
    """All region statistics per group of voxel rows; exact for groups of any size.

    A group's parameters are one row; every pass over the voxels combines map-side.
    """
    by = list(by)
    rows = voxels.select(*by, F.col(value).cast("double").alias("_v")).dropna()
    quartiles = exact_quantiles(rows, by, "_v", _QUARTILES)
    center = materialize(
        quartiles.select(
            *by, F.col("quantiles").alias("_q"), F.col("mean").alias("_mean"),
            F.col("std").alias("_std"),
        ),
        "region-centers",
    )
    centered = rows.join(center, by).withColumn("_d", _deviation())
    mads = exact_quantiles(centered, by, "_d", [0.5]).select(
        *by, F.col("quantiles")[0].alias("_mad")
    )
    return _summaries(centered.join(materialize(mads, "region-mads"), by), by, voxel_volume)
