"""Scans of registries, questionnaires, participants and lookup tables."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from parcelhouse.functions import (
    bare_code,
    legacy_code,
    missing_to_null,
    numeric_or_null,
    pad_zeros,
    session_id,
    subject_code,
)
from parcelhouse.model import SESSION_KEYS
from parcelhouse.operators.answers import COERCED
from parcelhouse.operators.latest import keep_last, union_all

_ID_COLUMNS = {*SESSION_KEYS, "Subject Code", "UID", "full_name", "ID ", "participant_id"}


def read_delimited(
    spark: SparkSession, path, separator=",", text_columns=(), multiline=False, schema=None
) -> DataFrame:
    """A file with a header. Types are inferred, but identifier columns stay text."""
    reader = spark.read.options(
        header=True, sep=separator, quote='"', escape='"', multiLine=multiline,
        nanValue="NaN", enforceSchema=False,
    )
    if schema is None:
        inferred = reader.option("inferSchema", True).csv(path).schema
        as_text = _ID_COLUMNS | set(text_columns)
        schema = T.StructType(
            [
                T.StructField(f.name, T.StringType() if f.name in as_text else f.dataType)
                for f in inferred.fields
            ]
        )
    return missing_to_null(reader.schema(schema).csv(path))


def normalize_registry(raw: DataFrame) -> DataFrame:
    """Stored ids next to the raw ones (file paths carry the raw ids)."""
    absent = [k for k in SESSION_KEYS if k not in raw.columns]
    if absent:
        raise ValueError(f"registry lacks required columns {absent}")
    return raw.withColumns(
        {
            "subject_code_raw": F.col("subject_code").cast("string"),
            "session_id_raw": F.col("session_id").cast("string"),
            "subject_code": subject_code("subject_code"),
            "session_id": session_id("session_id"),
        }
    )


def accepted(registry: DataFrame) -> DataFrame:
    """Rows with both ids; joins rely on it."""
    return registry.dropna(subset=list(SESSION_KEYS))


def rejected(registry: DataFrame) -> DataFrame:
    """The other rows, with the reason."""
    reason = (
        F.when(F.col("subject_code").isNull(), "subject code missing")
        .when(F.col("session_id_raw").isNull(), "session id missing")
        .when(F.col("session_id").isNull(), "session id is no number")
    )
    return registry.withColumn("reason", reason).where(F.col("reason").isNotNull())


def read_registry(spark, path, schema=None) -> DataFrame:
    """Session registry; both ids as text and normalised, other columns inferred."""
    return accepted(normalize_registry(read_delimited(spark, path, schema=schema)))


def read_participants(spark, path) -> DataFrame:
    return read_delimited(spark, path, separator="\t")


def read_region_lookup(spark, path) -> DataFrame:
    """Region lookup table; label and network names are text."""
    return read_delimited(spark, path, separator="\t", text_columns=("label", "network_label"))


def clean_questionnaire(raw: DataFrame, clean=True, standardize=True) -> DataFrame:
    """Plain subject codes, no refusals (a missing answer is kept), numbers as numbers."""
    df = raw
    if standardize:
        df = df.withColumn("Subject Code", bare_code("`Subject Code`"))
    if clean:
        if "Questionnaire" in df.columns:
            df = df.where(~F.col("Questionnaire").eqNullSafe("No"))
        df = df.withColumns(
            {c: numeric_or_null(f"`{c}`") for c in COERCED if c in df.columns}
        )
    return df


def read_questionnaire(spark, path, clean=True, standardize=True, multiline=False) -> DataFrame:
    """Questionnaire export. Spark splits the file; an export whose free-text answers hold line
    breaks needs ``multiline``, which reads each file in one task."""
    return clean_questionnaire(
        read_delimited(spark, path, multiline=multiline), clean, standardize
    )


# The older registries: dataset name -> expressions for their ids.
_EXTRA_REGISTRIES = {
    "legacy": lambda: {"subject_code": legacy_code("subject_code")},
    "legacy_vip": lambda: {
        "subject_id": pad_zeros(F.col("`ID `").cast("string"), 9),
        "subject_code": pad_zeros(F.col("`ID `").cast("string"), 9),
    },
    "legacy_repeated": lambda: {"subject_code": legacy_code("subject_code")},
    "cardiff": lambda: {"subject_code": legacy_code("full_name")},
}


def combine_registries(main: DataFrame, extras: dict) -> DataFrame:
    """One registry from the main one and any of the older ones, the last listed winning.

    ``extras`` maps dataset name to frame; each row is tagged with its ``source``.
    """
    unknown = set(extras) - set(_EXTRA_REGISTRIES)
    if unknown:
        raise ValueError(f"unknown registries {sorted(unknown)}")
    first = main.withColumns(
        {
            "session_id": pad_zeros(F.col("session_id").cast("string"), 12),
            "subject_code": legacy_code("subject_code"),
        }
    ).where(F.col("subject_code") != "0000")
    frames = [first.withColumn("_position", F.lit(0))]
    for position, name in enumerate(_EXTRA_REGISTRIES, start=1):
        if extras.get(name) is not None:
            frames.append(
                extras[name].withColumns(
                    {
                        **_EXTRA_REGISTRIES[name](),
                        "session_id": F.col("session_id").cast("string"),
                        "source": F.lit(name),
                        "_position": F.lit(position),
                    }
                )
            )
    joined = union_all(frames).withColumns(
        {
            "session_id": bare_code("session_id"),
            "subject_code": legacy_code("subject_code"),
        }
    )
    # Within one registry the order of rows is not kept by a distributed scan: equal keys
    # are told apart by their whole content.
    rest = [c for c in joined.columns if c not in (*SESSION_KEYS, "_position")]
    return keep_last(joined, list(SESSION_KEYS), ["_position", *rest]).drop("_position")


def read_registries(spark, main_path, extra_paths: dict) -> DataFrame:
    """As :func:`combine_registries` from files; registries that do not exist are skipped.

    The index column that some of them start with has no name and is dropped.
    """
    extras = {}
    for name, path in extra_paths.items():
        try:
            extras[name] = read_delimited(spark, path).drop("_c0")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
    return combine_registries(read_delimited(spark, main_path), extras)
