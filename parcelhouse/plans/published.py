"""The published layout: participant-keyed tables per modality, format, metric, statistic.

``features/{modality}/{wide|long}/{metric}_{statistic}.parquet`` plus ``metadata.parquet``
and a manifest. Metrics are called gm, wm, ct or by diffusion parameter here, and tidy rows
name their statistic.
"""

import time
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F

from parcelhouse.functions import parse_feature_name
from parcelhouse.model import SESSION_KEYS, schema
from parcelhouse.operators.latest import keep_last
from parcelhouse.operators.quality import validation_report, validation_summary
from parcelhouse.operators.reshape import to_tidy
from parcelhouse.operators.sessions import full_outer
from parcelhouse.plans.scratch import materialize

KEY = "participant_id"
# Columns that metadata may lack.
OPTIONAL_FIELDS = ("age", "sex", "site", "tiv", "qc_pass")
_ENTRY = schema(
    modality="string", format="string", pipeline="string", metric="string", statistic="string",
    file="string", n_features="bigint", version="bigint",
)


def participant_rows(df: DataFrame) -> DataFrame:
    """Sessions keyed by one participant id ``{subject}_{session}``."""
    return df.withColumn(KEY, F.concat_ws("_", *SESSION_KEYS)).drop(*SESSION_KEYS)


def tidy_view(long: DataFrame, metric: str, statistics) -> DataFrame:
    """Canonical long rows as ``(participant_id, parcel, metric, value, statistic)``."""
    return (
        participant_rows(long)
        .select(KEY, F.col("label").alias("parcel"), F.lit(metric).alias("metric"), *statistics)
        .unpivot([KEY, "parcel", "metric"], list(statistics), "statistic", "value")
        .where(F.col("value").isNotNull())
        .select(KEY, "parcel", "metric", "value", "statistic")
    )


def wide_to_tidy(wide: DataFrame, metric: str, statistic: str) -> DataFrame:
    return to_tidy(wide, metric, statistic, (KEY,))


class PublishedDataset:
    def __init__(self, spark, root: str, compression="snappy"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.compression = compression

    def _path(self, modality, fmt, stem):
        return f"{self.root}/features/{modality}/{fmt}/{stem}.parquet"

    def _manifest(self) -> DataFrame:
        try:
            rows = self.spark.read.schema(_ENTRY).json(f"{self.root}/manifest")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            rows = self.spark.createDataFrame([], _ENTRY)
        # The newest entry of a dataset counts; entries are schema-sized.
        return keep_last(rows, ["modality", "format", "pipeline", "metric", "statistic"], ["version", "file"])

    def write_features(
        self, data: DataFrame, modality, metric, statistic, fmt="wide", pipeline=None
    ) -> str:
        """Write one dataset as a new version and enter it in the manifest; readers of the
        version before go on undisturbed."""
        stem = "_".join(p for p in (pipeline, metric, statistic) if p)
        version = time.time_ns()
        path = f"{self._path(modality, fmt, stem)}/version={version}"
        data.write.option("compression", self.compression).parquet(path)
        entry = (modality, fmt, pipeline, metric, statistic, path, len(data.columns) - 1, version)
        self.spark.createDataFrame([entry], _ENTRY).coalesce(1).write.mode("append").json(
            f"{self.root}/manifest"
        )
        return path

    def retain(self, versions: int = 1) -> list:
        """Remove all but the newest versions of every dataset; returns their paths."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        at = jvm.org.apache.hadoop.fs.Path(f"{self.root}/features/*/*/*.parquet/version=*")
        files = at.getFileSystem(conf)
        tables = {}
        # Folder names only: one for each dataset and version.
        for status in files.globStatus(at) or []:
            path = status.getPath().toString()
            tables.setdefault(path.rpartition("/")[0], []).append(path)
        gone = []
        for paths in tables.values():
            paths.sort(key=lambda p: int(p.rpartition("=")[2]))
            gone += paths[: max(0, len(paths) - max(1, versions))]
        for path in gone:
            files.delete(jvm.org.apache.hadoop.fs.Path(path), True)
        return gone

    def write_metadata(self, data: DataFrame) -> None:
        data.write.mode("overwrite").parquet(f"{self.root}/features/metadata.parquet")

    def get_metadata(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/features/metadata.parquet")

    def _entries(self, **wanted):
        rows = self._manifest()
        for column, value in wanted.items():
            if value is not None:
                rows = rows.where(F.col(column) == value)
        # One row per dataset: schema-sized.
        found = rows.orderBy("file").collect()
        if not found:
            raise FileNotFoundError(f"no published features with {wanted}")
        return found

    def get_features(
        self, modality, metric=None, statistic=None, fmt="wide", pipeline=None
    ) -> DataFrame:
        """One wide table, tidy rows with filters, or all wide tables side by side."""
        if fmt == "wide" and metric and statistic:
            found = self._entries(
                modality=modality, format="wide", metric=metric, statistic=statistic
            )
            found = [e for e in found if e.pipeline == pipeline]
            if not found:
                raise FileNotFoundError(f"no published features of pipeline {pipeline}")
            return self.spark.read.parquet(found[0].file)
        if fmt == "long":
            found = self._entries(modality=modality, format="long", pipeline=pipeline)
            tables = [self.spark.read.parquet(e.file) for e in found]
            rows = reduce(DataFrame.unionByName, tables)
            # Partition pruning is not available here; both filters reach the Parquet scan.
            if metric:
                rows = rows.where(F.col("metric") == metric)
            if statistic:
                rows = rows.where(F.col("statistic") == statistic)
            return rows
        found = self._entries(modality=modality, format="wide")
        stems = {e.file.split("/")[-2].removesuffix(".parquet"): e.file for e in found}
        return full_outer({s: self.spark.read.parquet(f) for s, f in stems.items()}, (KEY,))

    def select(self, anatomical=(), diffusion=()) -> DataFrame:
        """Named features of both modalities, joined by participant."""
        tables = {}
        for modality, names in (("anatomical", anatomical), ("diffusion", diffusion)):
            for name in names or ():
                parts = parse_feature_name(name, modality)
                tables[name] = self.get_features(
                    modality, parts["metric"], parts["statistic"], pipeline=parts["pipeline"]
                )
        if not tables:
            raise ValueError("no features asked for")
        return full_outer(tables, (KEY,))

    def available_metrics(self, modality) -> DataFrame:
        """Metric -> sorted statistics."""
        return available_metrics(self._manifest().where(F.col("modality") == modality))

    def subject_ids(self) -> DataFrame:
        return self.get_metadata().select(KEY).distinct()

    def validate(self, required=(), optional=OPTIONAL_FIELDS):
        """``(report, summary)``: findings over all wide tables and the metadata, and one row with the
        verdict and the numbers of subjects and of features by modality."""
        entries = [r for r in self._manifest().collect() if r.format == "wide"]
        tables = {
            "_".join(p for p in (e.modality, e.pipeline, e.metric, e.statistic) if p):
            self.spark.read.parquet(e.file) for e in entries
        }
        report = materialize(
            validation_report(tables, self.get_metadata(), KEY, required, optional), "validation"
        )
        counts = {
            f"n_{m}_features": F.lit(sum(e.n_features for e in entries if e.modality == m)).cast("bigint")
            for m in ("anatomical", "diffusion")
        }
        summary = validation_summary(report).withColumns(
            {"n_subjects": self.n_subjects().select("n_subjects").scalar(), **counts}
        )
        return report, summary

    def n_subjects(self) -> DataFrame:
        return self.get_metadata().agg(F.countDistinct(KEY).alias("n_subjects"))


def available_metrics(entries: DataFrame) -> DataFrame:
    """Metric -> sorted statistics, from catalog or tidy rows (bounded by the vocabulary)."""
    return (
        entries.select("metric", "statistic").where(F.col("metric").isNotNull()).distinct()
        .groupBy("metric").agg(F.sort_array(F.collect_list("statistic")).alias("statistics"))
    )
