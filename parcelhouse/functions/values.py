"""Value expressions: coercion, missing values, derived measures."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from parcelhouse.functions.identifiers import _NUMBER, _col


def numeric_or_null(raw) -> Column:
    """Text to double; anything that is not a plain number becomes null."""
    text = _col(raw).cast("string")
    return F.when(text.rlike(_NUMBER), F.trim(text).try_cast("double"))


def missing_to_null(df: DataFrame) -> DataFrame:
    """NaN to NULL in every floating-point column; do this once, at the source."""
    return df.selectExpr(
        *[
            f"nullif(`{f.name}`, cast('NaN' as {f.dataType.simpleString()})) as `{f.name}`"
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else f"`{f.name}`"
            for f in df.schema.fields
        ]
    )


def measured_value(metric="metric", volume="volume_mm3", mean="mean") -> Column:
    """The one value that stands for a region: volume for volumes, else the mean."""
    return F.when(_col(metric) == "volume", _col(volume)).otherwise(_col(mean))


def adjusted_volume(metric="metric", volume="volume_mm3", total="tiv") -> Column:
    """Volume as a share of the session total; null for other metrics and for total 0."""
    return F.when(_col(metric) == "volume", F.try_divide(_col(volume), _col(total)))


def needed_sources(flags: dict) -> Column:
    """Array of the sources whose loaded flag is false or missing.

    ``flags`` maps source name to its flag column, or to None if there is no such column.
    """
    return F.array_compact(
        F.array(
            *[
                F.lit(name)
                if flag is None
                else F.when(~F.coalesce(_col(flag), F.lit(False)), F.lit(name))
                for name, flag in flags.items()
            ]
        )
    )


def all_true(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions)
