"""Catalog of stored datasets: an append-only JSON table, the newest entry per name counts.

Entries are schema-sized (one per dataset), so reading them on the driver is planning, not
data work.
"""

import json
import time
import uuid
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F

from parcelhouse.model import schema
from parcelhouse.operators.latest import keep_last

CATALOG_SCHEMA = schema(
    kind="string", name="string", modality="string", metric="string", source="string",
    source_modality="string", workflow="string", model="string", param="string",
    n_rows="bigint", n_sessions="bigint", n_subjects="bigint", n_regions="bigint",
    columns="array<string>", statistics="array<string>", regions="array<string>",
    path="string", batch_hi="bigint", version="bigint", created_at="timestamp",
)


def read_or_empty(spark, path, columns, fmt="parquet") -> DataFrame:
    """A stored table, or an empty one of that schema where nothing is stored yet."""
    try:
        return spark.read.schema(columns).format(fmt).load(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], columns)


def write_lines(spark, folder: str, rows) -> None:
    """Add one file of JSON lines. Planning data is small: it needs no job."""
    jvm = spark._jvm
    name = f"part-{uuid.uuid4().hex}.json"
    final = jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    hidden = jvm.org.apache.hadoop.fs.Path(f"{folder}/_{name}")
    files = final.getFileSystem(spark._jsc.hadoopConfiguration())
    lines = [json.dumps({c: v for c, v in r.items() if v is not None}) for r in rows]
    out = files.create(hidden, False)
    try:
        out.write("".join(f"{line}\n" for line in lines).encode())
    finally:
        out.close()
    # Readers see the whole file or none.
    if not files.rename(hidden, final):
        raise OSError(f"cannot write {folder}/{name}")


class Catalog:
    def __init__(self, spark, root: str):
        self.spark = spark
        self.path = f"{root}/catalog"
        self._seen, self._rows = [], []

    def entries(self, kind=None) -> DataFrame:
        rows = read_or_empty(self.spark, self.path, CATALOG_SCHEMA, "json")
        current = keep_last(rows, ["kind", "name"], ["version"])
        return current if kind is None else current.where(F.col("kind") == kind)

    def _listing(self) -> list:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/*.json")
        found = at.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(at)
        return sorted(s.getPath().getName() for s in found or [])

    def _current(self) -> list:
        """The current entries, read again only when files have been added."""
        listing = self._listing()
        if listing != self._seen:
            self._rows, self._seen = self.entries().collect() if listing else [], listing
        return self._rows

    def all(self, kind=None) -> list:
        return [r for r in self._current() if kind in (None, r.kind)]

    def find(self, kind: str, name: str):
        hits = [r for r in self.all(kind) if r["name"] == name]
        return hits[0] if hits else None

    def names(self, kind: str, modality=None) -> list:
        return sorted(
            r["name"] for r in self.all(kind) if modality in (None, r.modality)
        )

    def register(self, entries: DataFrame) -> None:
        """Append the rows of a table of entries; columns that are not given are null."""
        self.add(*(r.asDict() for r in entries.collect()))

    def add(self, *entries: dict) -> None:
        now = {"version": time.time_ns(), "created_at": datetime.now(timezone.utc).isoformat()}
        names = set(CATALOG_SCHEMA.names)
        rows = [{**{c: v for c, v in e.items() if c in names}, **now} for e in entries]
        write_lines(self.spark, self.path, rows)

    def export_manifest(self, path: str) -> None:
        """All current entries as one JSON file."""
        self.entries().orderBy("kind", "name").coalesce(1).write.mode("overwrite").json(path)


def describe_long(long: DataFrame, statistics, by=("source",)) -> DataFrame:
    """Catalog entries of long tables: rows, sessions, subjects, statistics with values."""
    filled = [
        F.when(F.count(s) > 0, F.lit(s)).alias(f"_s{i}") for i, s in enumerate(statistics)
    ]
    per_subject = (
        long.groupBy(*by, "subject_code", "session_id")
        .agg(F.count("*").alias("_n"), *[F.count(s).alias(s) for s in statistics])
        .groupBy(*by, "subject_code")
        .agg(
            F.sum("_n").alias("_n"), F.count("*").alias("_sessions"),
            *[F.sum(s).alias(s) for s in statistics],
        )
    )
    filled = [F.when(F.sum(s) > 0, F.lit(s)) for s in statistics]
    return per_subject.groupBy(*by).agg(
        F.sum("_n").alias("n_rows"), F.sum("_sessions").alias("n_sessions"),
        F.count("*").alias("n_subjects"),
        F.array_compact(F.array(*filled)).alias("statistics"),
    )


def describe_features(wide: DataFrame, by, regions) -> DataFrame:
    """Catalog entries of stored wide features: each row is a session, and a column with a value a region."""
    names = [F.col("`" + r.replace("`", "``") + "`") for r in regions]
    filled = [F.when(F.count(c) > 0, F.lit(r)) for c, r in zip(names, regions)]
    # An empty text comes back as a null from the name of a folder.
    texts = {c: F.coalesce(c, F.lit("")) for c, t in wide.dtypes if c in by and t == "string"}
    return wide.withColumns(texts).groupBy(*by).agg(
        F.count("*").alias("n_sessions"),
        (F.array_compact(F.array(*filled)) if filled else F.array().cast("array<string>")).alias("regions"),
    ).withColumn("n_regions", F.size("regions").cast("bigint"))
