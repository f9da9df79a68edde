"""Stripe artefacts: amplitude of a mean profile in one frequency band."""

import math

from pyspark.sql import DataFrame, functions as F

TARGET_FREQUENCY = 0.25
FREQUENCY_TOLERANCE = 0.05


def band_amplitudes(
    df: DataFrame, by, profile: str, target=TARGET_FREQUENCY, tolerance=FREQUENCY_TOLERANCE
) -> DataFrame:
    """``(by, amplitude)``: sum of 2/n |Y_k| over frequencies k/n within ``target`` +- ``tolerance``.

    Y is the discrete Fourier transform of the profile array, k runs below n/2; ``by`` names
    one profile each. Null if the profile has a missing value, 0 if no frequency is in band.
    Goertzel's recurrence runs over the array in its row: nothing is exploded or shuffled.
    """
    values = F.transform(profile, lambda v: v.cast("double"))
    n = F.size(profile)
    in_band = F.filter(
        F.sequence(F.lit(0), F.greatest(F.floor(n / 2).cast("int") - 1, F.lit(0))),
        lambda k: (k / n >= target - tolerance) & (k / n <= target + tolerance),
    )
    zero = F.struct(F.lit(0.0).alias("now"), F.lit(0.0).alias("before"))

    def size(k):
        angle = 2 * math.pi * k / F.col("_n")
        double_cosine = 2 * F.cos(angle)

        def step(s, v):
            return F.struct(
                (v + double_cosine * s["now"] - s["before"]).alias("now"),
                s["now"].alias("before"),
            )

        last = F.aggregate("_values", zero, step)
        return F.aggregate(
            F.array(last), F.lit(0.0),
            lambda _, s: F.hypot(s["now"] - s["before"] * F.cos(angle), s["before"] * F.sin(angle)),
        )

    rows = df.select(*by, values.alias("_values"), n.alias("_n"), in_band.alias("_band"))
    amplitude = F.aggregate("_band", F.lit(0.0), lambda a, k: a + size(k) * 2 / F.col("_n"))
    whole = F.col("_values").isNotNull() & F.forall("_values", lambda v: v.isNotNull())
    return rows.select(
        *by,
        F.when(F.size("_values") == 0, F.lit(0.0)).when(whole, amplitude).alias("amplitude"),
    )


def mean_profile(voxels: DataFrame, by, axis: str, value: str) -> DataFrame:
    """Mean over each slice along an axis, as an array in axis order."""
    slices = voxels.groupBy(*by, axis).agg(F.avg(value).alias("_m"))
    # One entry per slice: bounded by the size of the image, not by its number of voxels.
    return slices.groupBy(*by).agg(
        F.sort_array(F.collect_list(F.struct(axis, "_m")))["_m"].alias("profile")
    )


def strip_score(voxels: DataFrame, by, axis: str = "z", value: str = "value", **band) -> DataFrame:
    profiles = mean_profile(voxels, by, axis, value)
    return band_amplitudes(profiles, by, "profile", **band).withColumnRenamed(
        "amplitude", "strip_score"
    )
