"""The stored tables.

``long/source=S/batch_id=N``   staged batches; the newest batch of a key counts
``base/S/data/version=V``      published rows, one per key, in buckets of subjects
``base/S/manifest/version=V``  which version holds each bucket
``ledger/batch_id=N``          which session has been loaded from which source
``files/kind=K/batch_id=N``    which version of which file has been worked on, and its outcome
``hook_failures/batch_id=N``   sessions whose hook failed
``epochs``                     which batch a micro-batch was written as
``totals``, ``registry``       session scalars and covariates
``wide/S/data/version=V``      wide features by bucket and statistic (and model, param)
``wide/S/manifest/version=V``  which version holds each bucket, and the base it was made from
``catalog``                    what exists, and which version is current

Publishing is copy on write: only buckets that staged rows fall into are merged and written
again, the manifest of the new version names the old files of all others.

Writes go data, ledger, catalog, in this order: a crash leaves unreferenced data at most.
One writer at a time is assumed, as plain files offer no transactions.
"""

import time

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from parcelhouse.model import (
    ALL_STATISTICS,
    ANATOMICAL_STATISTICS,
    DIFFUSION_STATISTICS,
    LEDGER_SCHEMA,
    LOAD_ORDER,
    LOAD_SOURCES,
    LONG_SCHEMA,
    SESSION_KEYS,
    long_keys,
    region_column,
    schema,
)
from parcelhouse.functions import missing_to_null
from parcelhouse.operators.assemble import Feature, assemble_features
from parcelhouse.operators.latest import keep_last, session_pairs
from parcelhouse.operators.profile import ledger_status, session_counts, value_statistics
from parcelhouse.operators.reshape import first_values, region_list, to_wide_by_value
from parcelhouse.operators.sessions import (
    attach,
    missing_sessions,
    pending_sessions,
    session_covariates,
    with_loaded_flags,
)
from parcelhouse.plans.catalog import (
    Catalog,
    describe_features,
    describe_long,
    read_or_empty,
    write_lines,
)
from parcelhouse.plans.scratch import materialize

# "none" writes uncompressed files; brotli needs a codec Spark does not ship.
CODECS = ("snappy", "gzip", "zstd", "lz4", "none")
TOTALS_SCHEMA = schema(
    subject_code="string", session_id="string", tiv="double", batch_id="bigint"
)
FILES_SCHEMA = schema(
    subject_code="string", session_id="string", file_path="string", length="bigint",
    modified="bigint", reason="string", kind="string", batch_id="bigint",
)
HOOK_SCHEMA = schema(
    subject_code="string", session_id="string", error="string", batch_id="bigint"
)
EPOCH_SCHEMA = schema(checkpoint="string", epoch="bigint", batch_id="bigint")
MANIFEST_SCHEMA = schema(
    bucket="bigint", n_buckets="bigint", version="bigint", n_rows="bigint",
    n_sessions="bigint", n_subjects="bigint", statistics="array<string>",
)
WIDE_SCHEMA = schema(
    bucket="bigint", n_buckets="bigint", base_version="bigint", version="bigint",
    statistic="string", model="string", param="string", regions="array<string>",
    n_sessions="bigint",
)
#: Rows of a bucket on average before the number of buckets is doubled.
BUCKET_ROWS = 5_000_000
#: Wide rows that a task lays out, as Spark holds them while it sorts them by file.
WIDE_BYTES = 1 << 28
_KEY_BYTES = 150
_REGION_FILE = r"_parc\.tsv$"
_TISSUE_FILE = r"_tissue-[^/]+_parc\.tsv$"
_KEYS = list(SESSION_KEYS)


def check_codec(codec: str) -> str:
    if codec not in CODECS:
        raise ValueError(f"codec {codec!r} is not available; use one of {CODECS} (zstd for brotli)")
    return codec


def numbered(df: DataFrame) -> DataFrame:
    """The order of the given rows decides between equal keys of one delivery: the last counts."""
    if "line_no" in df.columns:
        return df
    return df.withColumn("line_no", F.monotonically_increasing_id())


def conform(df: DataFrame) -> DataFrame:
    """The canonical long columns; columns outside the vocabulary go to ``extras``."""
    if "label" not in df.columns:
        df = df.withColumnRenamed(region_column(df.columns), "label")
    known = {f.name for f in LONG_SCHEMA.fields}
    df = numbered(df)
    other = [c for c in df.columns if c not in known]
    if other:
        cells = ", ".join(f"'{c}', cast(`{c}` as string)" for c in other)
        more = f"map_filter(map({cells}), (k, v) -> v is not null)"
        if "extras" in df.columns:
            names = ", ".join(f"'{c}'" for c in other)
            kept = f"map_filter(extras, (k, v) -> k not in ({names}))"
            more = f"map_concat(coalesce({kept}, cast(map() as map<string,string>)), {more})"
        df = df.withColumn("extras", F.expr(more))
    return missing_to_null(
        df.selectExpr(
            *[
                f"cast({f'`{f.name}`' if f.name in df.columns else 'null'} as "
                f"{f.dataType.simpleString()}) as `{f.name}`"
                for f in LONG_SCHEMA.fields
            ]
        )
    )


def bucket_of(n: int):
    """By subject, so that counts of sessions and subjects add up over buckets."""
    return F.pmod(F.xxhash64("subject_code"), F.lit(n))


class FeatureStore:
    def __init__(self, spark, root: str, compression: str = "snappy", bucket_rows=BUCKET_ROWS):
        self.spark = spark
        self.bucket_rows = bucket_rows
        self.root = root.rstrip("/")
        self.compression = check_codec(compression)
        self.catalog = Catalog(spark, self.root)
        self._long = f"{self.root}/long"
        self._ledger = f"{self.root}/ledger"
        self._last_batch = 0

    # -- long tables ---------------------------------------------------------------

    def _write(self, df, path, mode="errorifexists", partitions=()):
        writer = df.write.mode(mode).option("compression", self.compression)
        writer = writer.option("partitionOverwriteMode", "dynamic")
        (writer.partitionBy(*partitions) if partitions else writer).parquet(path)

    def staged(self) -> DataFrame:
        return read_or_empty(self.spark, self._long, LONG_SCHEMA)

    def ledger(self) -> DataFrame:
        return read_or_empty(self.spark, self._ledger, LEDGER_SCHEMA)

    def new_batch(self) -> int:
        """A batch number above all earlier ones: microseconds, strictly increasing."""
        self._last_batch = max(self._last_batch + 1, time.time_ns() // 1000)
        return self._last_batch

    def write_batch(self, df: DataFrame, batch_id: int) -> None:
        """Stage rows that carry their ``source`` and enter their sessions in the ledger."""
        # Rebalancing splits a large source over several files and joins small ones. It takes the rows
        # as they were given: the many columns they lack come after it.
        rows = conform(numbered(df).hint("rebalance", "source"))
        self._write(
            rows.withColumn("batch_id", F.lit(batch_id).cast("bigint")),
            self._long, "overwrite", ["source", "batch_id"],
        )
        written = self.staged().where(F.col("batch_id") == batch_id)
        flag = F.when(F.col("source").startswith("diffusion"), "diffusion").otherwise(
            F.regexp_replace("source", "^anatomical_", "")
        )
        sessions = written.select(*_KEYS, flag.alias("source")).distinct().select(
            "*",
            F.current_timestamp().alias("loaded_at"),
            F.lit(batch_id).cast("bigint").alias("batch_id"),
        )
        # Distinct sessions come evenly dealt.
        self._write(sessions, self._ledger, "overwrite", ["batch_id"])

    def save_long(self, df: DataFrame, source: str) -> int:
        """Stage rows of one source as a new batch; later batches replace equal keys."""
        batch = self.new_batch()
        self.write_batch(df.withColumn("source", F.lit(source)), batch)
        return batch

    def save_anatomical_long(self, df: DataFrame, modality: str) -> int:
        return self.save_long(df.withColumn("modality", F.lit(modality)), f"anatomical_{modality}")

    def save_diffusion_long(self, df: DataFrame, workflow: str) -> int:
        return self.save_long(df.withColumn("workflow", F.lit(workflow)), f"diffusion_{workflow}")

    def manifest(self, source: str) -> list:
        """One row for each published bucket: planning data, like a listing of files."""
        entry = self.catalog.find("base", source)
        if entry is None:
            return []
        return read_or_empty(self.spark, entry.path, MANIFEST_SCHEMA, "json").collect()

    def _read_buckets(self, source: str, rows) -> DataFrame:
        data = f"{self.root}/base/{source}/data"
        paths = [f"{data}/version={r.version}/bucket={r.bucket}" for r in rows]
        if not paths:
            return self.spark.createDataFrame([], LONG_SCHEMA)
        return self.spark.read.schema(LONG_SCHEMA).parquet(*paths)

    def published(self, source: str):
        entry = self.catalog.find("base", source)
        if entry is None:
            return None, -1
        return self._read_buckets(source, self.manifest(source)), entry.batch_hi

    def _first_files(self, staged: DataFrame, base) -> DataFrame:
        """The first tissue file of each session with staged rows, over staged and published ones."""
        named = F.col("source_path").rlike(_TISSUE_FILE)
        touched = staged.where(named).select(*_KEYS, "source_path")
        if base is not None:
            touched = touched.union(
                base.where(named).select(*_KEYS, "source_path").join(
                    staged.select(*_KEYS).distinct(), _KEYS, "left_semi"
                )
            )
        return touched.groupBy(*_KEYS).agg(F.min("source_path").alias("_first"))

    def current(self, source: str) -> DataFrame:
        """One row per key, the newest: published rows not delivered again, plus staged ones."""
        base, upto = self.published(source)
        return self._merged(source, base, self._staged_of(source, upto))

    def _staged_of(self, source: str, upto: int) -> DataFrame:
        return self.staged().where((F.col("source") == source) & (F.col("batch_id") > upto))

    def _merged(self, source: str, base, staged: DataFrame) -> DataFrame:
        """Only the staged rows are deduplicated. Published rows are unique already; they are
        filtered by the staged keys, which costs no shuffle while those fit a broadcast. Of
        several files for one session and tissue the first by path counts, whenever they came.
        """
        named = F.coalesce(F.col("source_path").rlike(_REGION_FILE), F.lit(False))
        if not staged.where(named).isEmpty():
            # A file loaded again replaces all that its earlier version gave.
            files = staged.where(named).groupBy("source_path").agg(F.max("batch_id").alias("_newest"))
            old = named & (F.col("batch_id") < F.col("_newest"))
            staged = staged.join(files, "source_path", "left").where(
                ~F.coalesce(old, F.lit(False))
            ).select(staged.columns)
            if base is not None:
                base = base.join(files, "source_path", "left_anti").select(base.columns)
        from_files = F.col("source_path").rlike(_TISSUE_FILE)
        if source.startswith("anatomical") and not staged.where(from_files).isEmpty():
            first = self._first_files(staged, base)
            late = from_files & (F.col("source_path") > F.col("_first"))
            counts = ~F.coalesce(late, F.lit(False))
            staged = staged.join(first, _KEYS, "left").where(counts).select(staged.columns)
            if base is not None:
                base = base.join(first, _KEYS, "left").where(counts).select(base.columns)
        keys = list(long_keys(source))
        newest = keep_last(staged, keys, LOAD_ORDER)
        if base is None:
            return newest
        match = [base[k].eqNullSafe(newest[k]) for k in keys]
        return base.join(newest.select(*keys), match, "left_anti").unionByName(newest)

    def staged_sources(self) -> list:
        return sorted(r[0] for r in self.staged().select("source").distinct().collect())

    def list_long_formats(self) -> list:
        return self.catalog.names("base")

    def load_long(self, source: str, include_staged: bool = True) -> DataFrame:
        known = self.list_long_formats()
        if source in known or (include_staged and source in self.staged_sources()):
            return self.current(source) if include_staged else self.published(source)[0]
        raise ValueError(
            f"no long table {source!r}; published: {known}, staged: {self.staged_sources()}"
        )

    def publish(self, sources=None, keep_staged: bool = False) -> list:
        """Merge staged rows into the published ones, as a new version of each source."""
        batch_hi = self.staged().agg(F.max("batch_id")).first()[0]
        if batch_hi is None:
            return []
        done = []
        for source in sources or self.staged_sources():
            self._publish_source(source, batch_hi)
            done.append(source)
        if not keep_staged:
            self.drop_staged(done, batch_hi)
        return done

    def _publish_source(self, source: str, batch_hi: int) -> None:
        entry, held = self.catalog.find("base", source), self.manifest(source)
        staged = self._staged_of(source, -1 if entry is None else entry.batch_hi)
        staged = staged.where(F.col("batch_id") <= batch_hi)

        before = held[0].n_buckets if held else 1
        counts = [F.count(c).alias(c) for c in LONG_SCHEMA.names]
        found = staged.groupBy(bucket_of(before).alias("bucket")).agg(F.count("*").alias("_n"), *counts).collect()
        total = sum(r.n_rows for r in held) + sum(r["_n"] for r in found)
        buckets = before
        while buckets * self.bucket_rows < total:
            buckets *= 2
        # More buckets mean that all rows are dealt anew; the doubling makes that rare.
        touched = {r.bucket for r in (held if buckets > before else found)}
        kept = [] if buckets > before else [r for r in held if r.bucket not in touched]
        stale = [r for r in held if r.bucket in touched]
        base = self._read_buckets(source, stale) if stale else None
        version = time.time_ns()
        path = f"{self.root}/base/{source}/data/version={version}"
        if base is None:
            # Columns without any value need not be shuffled: they are written as nulls.
            least = {*long_keys(source), *LOAD_ORDER, "source"}
            staged = staged.select(
                *[c for c in LONG_SCHEMA.names if c in least or any(r[c] for r in found)]
            )
        rows = self._merged(source, base, staged).withColumn("bucket", bucket_of(buckets))
        # Rebalancing splits a bucket with a hot subject over several files.
        rows = rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", *_KEYS)
        whole = [
            F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in LONG_SCHEMA.fields
        ]
        self._write(rows.select(*whole, "bucket"), path, partitions=["bucket"])
        columns = T.StructType([*LONG_SCHEMA.fields, T.StructField("bucket", T.LongType())])
        stored = self.spark.read.schema(columns).parquet(path)
        facts = describe_long(stored, self._statistics(source), ("bucket",)).withColumns(
            {"n_buckets": F.lit(buckets), "version": F.lit(version)}
        )
        made = facts.select(*MANIFEST_SCHEMA.names).collect()
        manifest = f"{self.root}/base/{source}/manifest/version={version}"
        write_lines(self.spark, manifest, [r.asDict() for r in (*kept, *made)])
        with_values = {s for r in [*kept, *made] for s in r.statistics or ()}
        totals = {
            c: sum(r[c] for r in [*kept, *made]) for c in ("n_rows", "n_sessions", "n_subjects")
        }
        self.catalog.add(
            {
                "kind": "base", "name": source, "path": manifest, "batch_hi": batch_hi,
                "modality": source.partition("_")[0], "columns": LONG_SCHEMA.names, **totals,
                "statistics": [s for s in self._statistics(source) if s in with_values],
            }
        )

    def drop_staged(self, sources=None, upto=None) -> None:
        """Remove staged batches (of some sources, up to a batch); the ledger stays."""
        batches = self.staged().select("source", "batch_id").distinct()
        if sources is not None:
            batches = batches.where(F.col("source").isin(*sources)) if sources else batches.limit(0)
        if upto is not None:
            batches = batches.where(F.col("batch_id") <= upto)
        # One entry per directory: bounded by the number of open batches.
        for row in batches.collect():
            self._delete(f"{self._long}/source={row.source}/batch_id={row.batch_id}")

    def staged_status(self) -> DataFrame:
        """Sessions per staged source."""
        return ledger_status(self.staged())

    # -- files, hooks and repeated micro-batches -----------------------------------------

    def record_files(self, files: DataFrame, kind: str, batch_id: int) -> None:
        """Enter the files of a batch, with the ``reason`` why one gave no rows (null if it did)."""
        rows = files.withColumns(
            {"kind": F.lit(kind), "batch_id": F.lit(batch_id).cast("bigint")}
        ).select(*FILES_SCHEMA.names)
        self._write(
            rows.hint("rebalance"), f"{self.root}/files", "overwrite", ["kind", "batch_id"]
        )

    def file_ledger(self, kind=None) -> DataFrame:
        """What is known of each file: its newest entry."""
        rows = read_or_empty(self.spark, f"{self.root}/files", FILES_SCHEMA)
        if kind is not None:
            rows = rows.where(F.col("kind") == kind)
        return keep_last(rows, ["kind", "file_path"], ["batch_id"])

    def failed_files(self) -> DataFrame:
        """Files whose present version gave no rows, with the reason."""
        return self.file_ledger().where(F.col("reason").isNotNull()).select(
            *_KEYS, "kind", "file_path", "reason", "batch_id"
        )

    def missing_report(self, registry: DataFrame, path: str = None) -> DataFrame:
        """Registered sessions without data and why, on request also written as CSV."""
        found = missing_sessions(registry, self.existing_sessions(), failed=self.failed_files())
        if path is not None:
            found.write.mode("overwrite").option("header", True).csv(path)
        return found

    def record_hook_failures(self, failures: DataFrame, batch_id: int) -> None:
        rows = failures.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        self._write(rows, f"{self.root}/hook_failures", "overwrite", ["batch_id"])

    def hook_failures(self) -> DataFrame:
        return read_or_empty(self.spark, f"{self.root}/hook_failures", HOOK_SCHEMA)

    def batch_of(self, checkpoint: str, epoch: int) -> int:
        """The batch number of a micro-batch: the same again if it is repeated."""
        path = f"{self.root}/epochs"
        rows = read_or_empty(self.spark, path, EPOCH_SCHEMA, "json").where(
            (F.col("checkpoint") == checkpoint) & F.col("epoch").isin(epoch, -1)
        ).collect()
        forgotten = max((r.batch_id for r in rows if r.epoch == -1), default=-1)
        known = [r.batch_id for r in rows if r.epoch == epoch and r.batch_id > forgotten]
        if known:
            return known[0]
        batch_id = self.new_batch()
        row = {"checkpoint": checkpoint, "epoch": epoch, "batch_id": batch_id}
        write_lines(self.spark, path, [row])
        return batch_id

    def forget(self, checkpoint: str) -> None:
        """Drop a stream's checkpoint, so that it loads everything anew; a tombstone row says
        that its batch numbers up to now don't count any more."""
        tombstone = {"checkpoint": checkpoint, "epoch": -1, "batch_id": self.new_batch()}
        write_lines(self.spark, f"{self.root}/epochs", [tombstone])
        self._delete(checkpoint)

    def _delete(self, location: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(location)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def _folders(self, pattern: str) -> list:
        """Paths of the folders below the root that match: names only, no data."""
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{pattern}")
        found = at.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(at)
        return sorted(s.getPath().toString() for s in found or [])

    def retain(self, versions: int = 2) -> list:
        """Remove what neither the newest versions nor the catalog use; returns the paths.

        Of bucketed tables these are manifests and the bucket files that no kept one names.
        """
        in_use = {r.path.rstrip("/").rpartition("/")[2] for r in self.catalog.all() if r.path}
        gone = []

        def old(pattern):
            held = sorted(self._folders(pattern), key=lambda n: int(n.rpartition("=")[2]))
            kept = held[max(0, len(held) - versions) :]
            kept += [p for p in held if p not in kept and p.rpartition("/")[2] in in_use]
            return kept, [p for p in held if p not in kept]

        gone += old("registry/version=*")[1]
        for kind, read in (("base", self.spark.read.json), ("wide", self.spark.read.parquet)):
            for folder in self._folders(f"{kind}/*/manifest"):
                table = f"{kind}/{folder.split('/')[-2]}"
                kept, unused = old(f"{table}/manifest/version=*")
                named = set()
                for path in kept:
                    named |= {tuple(r) for r in read(path).select("version", "bucket").distinct().collect()}
                gone += unused
                for path in self._folders(f"{table}/data/version=*/bucket=*"):
                    version, bucket = (int(x.partition("=")[2]) for x in path.split("/")[-2:])
                    if (version, bucket) not in named:
                        gone.append(path)
        for path in gone:
            self._delete(path)
        return gone

    # -- totals and registry ---------------------------------------------------------

    def _totals(self) -> DataFrame:
        return read_or_empty(self.spark, f"{self.root}/totals", TOTALS_SCHEMA)

    def save_tiv(self, df: DataFrame) -> None:
        """Session totals; the newest per session counts. Also a feature with one region."""
        absent = [c for c in (*_KEYS, "tiv") if c not in df.columns]
        if absent:
            raise ValueError(f"totals lack the columns {absent}")
        batch = self.new_batch()
        rows = missing_to_null(df.select(*_KEYS, F.col("tiv").cast("double").alias("tiv")))
        # Equal sessions within one delivery are told apart by value, the larger one last.
        unique = keep_last(rows.where(F.col("tiv").isNotNull()), _KEYS, ["tiv"])
        self._write(
            unique.withColumn("batch_id", F.lit(batch).cast("bigint")),
            f"{self.root}/totals", "overwrite", ["batch_id"],
        )
        facts = self.load_tiv().agg(F.count("*").alias("n_sessions")).select(
            F.lit("wide").alias("kind"), F.lit("tiv").alias("name"),
            F.lit("anatomical").alias("modality"), F.lit("tiv").alias("metric"),
            F.array(F.lit("tiv")).alias("regions"), F.lit(1).alias("n_regions"),
            F.lit(f"{self.root}/totals").alias("path"), "n_sessions",
        )
        self.catalog.register(facts)

    def has_tiv(self) -> bool:
        return self.catalog.find("wide", "tiv") is not None

    def load_tiv(self) -> DataFrame:
        totals = self._totals()
        if totals.isEmpty():
            raise ValueError("no session totals are stored")
        return keep_last(totals, _KEYS, ["batch_id"]).drop("batch_id")

    def initialize_metadata(self, registry: DataFrame, age=None) -> None:
        """Store the covariates of all registered sessions; flags come from the ledger."""
        path = f"{self.root}/registry/version={time.time_ns()}"
        self._write(session_covariates(registry, age), path)
        facts = self.spark.read.parquet(path).agg(F.count("*").alias("n_rows")).select(
            F.lit("registry").alias("kind"), F.lit("registry").alias("name"),
            F.lit(path).alias("path"), "n_rows",
        )
        self.catalog.register(facts)

    def load_metadata(self) -> DataFrame:
        """Covariates with load flags; without a registry an empty frame with the keys."""
        entry = self.catalog.find("registry", "registry")
        if entry is None:
            return self.spark.createDataFrame([], "subject_code string, session_id string")
        return with_loaded_flags(self.spark.read.parquet(entry.path), self.ledger())

    def pending(self, registry: DataFrame, sources=LOAD_SOURCES) -> DataFrame:
        return pending_sessions(registry, self.ledger(), sources)

    def existing_sessions(self) -> DataFrame:
        """Sessions that have been loaded, published or not."""
        return session_pairs(self.ledger())

    # -- wide features ---------------------------------------------------------------

    def _statistics(self, source):
        return ANATOMICAL_STATISTICS if source.startswith("anatomical") else DIFFUSION_STATISTICS

    def generate_wide_features(self, metrics=None, modalities=None) -> list:
        """Bring the wide features of all published sources up to date.

        Only buckets published since a source's features were made are pivoted again.
        ``modalities`` names sources exactly (``gm``, ``anatomical_gm``, ``diffusion`` ...).
        """
        made = []
        for source in self.list_long_formats():
            family, _, name = source.partition("_")
            if modalities and not {source, family, name} & set(modalities):
                continue
            made += self._publish_wide(source, family, name, metrics)
        return sorted(made)

    def _publish_wide(self, source, family, name, metrics):
        by = ["statistic"] if family == "anatomical" else ["statistic", "model", "param"]
        wanted = [s for s in self._statistics(source) if not metrics or s in metrics]
        if not wanted:
            return []
        held = {r.bucket: r for r in self.manifest(source)}
        entry, old, fresh = self.catalog.find("wide_source", source), None, set()
        if entry is not None and list(entry.statistics) == wanted:
            old = self.spark.read.schema(WIDE_SCHEMA).parquet(entry.path)
            made_from = old.select("bucket", "n_buckets", "base_version").distinct().collect()
            fresh = {
                r.bucket for r in made_from if r.bucket in held
                and (r.n_buckets, r.base_version) == (held[r.bucket].n_buckets, held[r.bucket].version)
            }
        stale = [r for b, r in held.items() if b not in fresh]
        if not stale:
            return self._names_of(source, wanted)
        # A statistic without any value in these buckets gives no cells.
        present = [s for s in wanted if any(s in (r.statistics or wanted) for r in stale)] or wanted
        cells = self._wide_cells(source, stale, by, present)
        regions = region_list(cells, "label")
        if not regions and not fresh:
            return []
        version = time.time_ns()
        path = f"{self.root}/wide/{source}/data/version={version}"
        index = [*_KEYS, "bucket", *by[1:]]
        together = self._dealt(cells, stale, by, len(present) * (8 * len(regions) + _KEY_BYTES))
        wide = to_wide_by_value(
            together.sortWithinPartitions("_group", *_KEYS), "label", present, regions, index, by[0]
        )
        self._write(wide, path, partitions=["bucket", *by])
        columns = T.StructType(
            [T.StructField(c, T.StringType()) for c in _KEYS]
            + [T.StructField(r, T.DoubleType()) for r in regions]
            + [T.StructField("bucket", T.LongType())] + [T.StructField(c, T.StringType()) for c in by]
        )
        stored = self.spark.read.schema(columns).parquet(path)
        sources = self._small(
            bucket=[r.bucket for r in stale], n_buckets=[r.n_buckets for r in stale],
            base_version=[r.version for r in stale],
        )
        facts = describe_features(stored, ["bucket", *by], regions).join(sources, "bucket").withColumn(
            "version", F.lit(version)
        )
        listed = facts.select(
            *[
                (F.col(f.name) if f.name in facts.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in WIDE_SCHEMA.fields
            ]
        )
        if fresh:
            still = self._small(bucket=sorted(fresh))
            listed = listed.unionByName(old.join(still, "bucket", "left_semi"))
        manifest = f"{self.root}/wide/{source}/manifest/version={version}"
        self._write(listed.hint("rebalance"), manifest)
        listed = self.spark.read.schema(WIDE_SCHEMA).parquet(manifest)
        parts = [F.lit(name), *[F.col(c) for c in by[1:]], F.col("statistic")]
        entries = listed.groupBy(*by).agg(
            F.sum("n_sessions").alias("n_sessions"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("regions")))).alias("regions"),
        ).withColumns(
            {
                "n_regions": F.size("regions").cast("bigint"),
                "kind": F.lit("wide"), "name": F.concat_ws("_", *parts),
                "modality": F.lit(family), "source": F.lit(source), "path": F.lit(manifest),
                "source_modality" if family == "anatomical" else "workflow": F.lit(name),
            }
        ).withColumnRenamed("statistic", "metric")
        self.catalog.register(entries)
        self.catalog.add(
            {"kind": "wide_source", "name": source, "path": manifest, "statistics": wanted}
        )
        return self._names_of(source, wanted)

    def _names_of(self, source, statistics) -> list:
        return [
            r["name"] for r in self.catalog.all("wide")
            if r.source == source and r.metric in statistics
        ]

    def _wide_cells(self, source, buckets, by, statistics):
        """One row for each session, region, model and parameter, with its statistics.

        Published rows are unique by key. Where the parts of the key that features leave out have one value,
        so are cells, and the published rows serve as they are.
        """
        rows = self._read_buckets(source, buckets)
        # Null group keys are left out, as are cells without a value.
        known = rows.dropna(subset=[*_KEYS, "label", *by[1:]])
        known = known.where(F.coalesce(*statistics).isNotNull())
        bucket = bucket_of(buckets[0].n_buckets).alias("bucket")
        values = [F.col(s).cast("double").alias(s) for s in statistics]
        names = [*_KEYS, "bucket", *by[1:], "label"]
        rest = [k for k in long_keys(source) if k not in (*_KEYS, "label", *by)]
        if known.select(*rest).distinct().limit(2).count() < 2:
            return known.select(*_KEYS, bucket, *by[1:], "label", *values)
        cells = known.select(*_KEYS, bucket, *by[1:], "label", *LOAD_ORDER, *values)
        return materialize(first_values(cells, names, statistics, LOAD_ORDER), "wide-cells")

    def _dealt(self, cells, buckets, by, width) -> DataFrame:
        """Cells in tasks that each write wide rows of about ``WIDE_BYTES``, ``width`` bytes for a session;
        ``_group`` numbers buckets and features in the order of their folders.

        A task takes whole sessions of one or a few features, so that it writes few files; a feature of many
        sessions is dealt over several tasks. The sizes are planning data, one for each bucket and feature.
        """
        sessions = {r.bucket: r.n_sessions for r in buckets}
        found = cells.groupBy("bucket", *by[1:]).count().collect()
        found = sorted(found, key=lambda r: [r[c] for c in ("bucket", *by[1:])])
        ends = np.cumsum([min(r["count"], sessions[r.bucket]) * width for r in found], dtype=float)
        total = float(ends[-1]) if found else 0.0
        least = total / (2 * self.spark.sparkContext.defaultParallelism)
        part = min(max(least, WIDE_BYTES / 16), WIDE_BYTES)
        first = np.floor(np.concatenate([[0.0], ends[:-1]]) / part).astype(int)[: len(found)]
        last = np.maximum(first, np.ceil(ends / part).astype(int) - 1)
        places = self._small(
            **{c: [r[c] for r in found] for c in ("bucket", *by[1:])},
            _first=first.tolist(), _n=(last - first + 1).tolist(), _group=list(range(len(found))),
        )
        at = F.col("_first") + F.pmod(F.xxhash64(*_KEYS), F.col("_n"))
        dealt = cells.join(places, ["bucket", *by[1:]]).withColumn("_part", at.cast("int"))
        tasks = int(last[-1]) + 1 if found else 1
        return dealt.repartitionById(tasks, "_part").drop("_first", "_n", "_part")

    def _small(self, **columns) -> DataFrame:
        """Planning data as a table whose size the planner knows; numbers, and texts for models and parameters."""
        types = {c: pa.string() if c in ("model", "param") else pa.int64() for c in columns}
        return self.spark.createDataFrame(
            pa.table({c: pa.array(v, types[c]) for c, v in columns.items()})
        )

    def list_features(self, modality=None) -> list:
        return self.catalog.names("wide", modality)

    def get_feature_info(self, name: str):
        return self.catalog.find("wide", name)

    def get_regions(self, name: str) -> list:
        return list(self._feature(name).regions)

    def _feature(self, name):
        entry = self.get_feature_info(name)
        if entry is None:
            raise ValueError(f"no feature {name!r}; available: {self.list_features()}")
        return entry

    def _with_session_columns(self, df, include_metadata, include_tiv):
        if include_metadata and self.catalog.find("registry", "registry") is not None:
            df = attach(df, self.load_metadata())
        if include_tiv and self.has_tiv():
            df = attach(df, self.load_tiv())
        return df

    def load_feature(self, name, include_metadata=True, include_tiv=False) -> DataFrame:
        entry = self._feature(name)
        if name == "tiv":
            df = self.load_tiv()
        else:
            place = {"statistic": entry.metric, "model": entry.model, "param": entry.param}
            place = {c: v for c, v in place.items() if v is not None}
            listed = self.spark.read.schema(WIDE_SCHEMA).parquet(entry.path)
            for column, value in place.items():
                listed = listed.where(F.col(column) == value)
            data = f"{self.root}/wide/{entry.source}/data"
            # One folder for each bucket: planning data.
            folders = [
                f"{data}/version={r.version}/bucket={r.bucket}"
                for r in listed.select("version", "bucket").distinct().collect()
            ]
            # A given schema keeps partition values text ("01" is no number).
            columns = T.StructType(
                [T.StructField(c, T.StringType()) for c in (*_KEYS, *place)]
                + [T.StructField(r, T.DoubleType()) for r in entry.regions]
            )
            df = self.spark.read.schema(columns).option("basePath", data).parquet(*folders)
            for column, value in place.items():
                df = df.where(F.col(column) == value)
            # A session may have values for other parameters of the source only.
            df = df.select(*_KEYS, *[F.col(f"`{r}`") for r in entry.regions]).where(
                F.coalesce(*[F.col(f"`{r}`") for r in entry.regions]).isNotNull()
            )
        return self._with_session_columns(df, include_metadata, include_tiv)

    def load_features(self, names, include_metadata=True, include_tiv=False) -> DataFrame:
        """Several features in one table, columns ``{feature}__{region}``."""
        entries = [self._feature(n) for n in names]
        if not entries:
            raise ValueError("no features asked for")
        stored = [e for e in entries if e.name != "tiv"]
        include_tiv = include_tiv or len(stored) < len(entries)
        features, regions, longs = [], {}, []
        for entry in stored:
            rows = {"source": entry.source}
            rows.update({c: entry[c] for c in ("model", "param") if entry[c] is not None})
            features.append(Feature(entry.name, entry.metric, rows))
            regions[entry.name] = list(entry.regions)
        for source in sorted({e.source for e in stored}):
            longs.append(self.published(source)[0])
        if not features:
            return self._with_session_columns(self.load_tiv(), include_metadata, False)
        long = longs[0]
        for more in longs[1:]:
            long = long.unionByName(more)
        # Rows of diffusion sources may differ in ``desc`` alone; the order decides between them.
        several = any(e.source.startswith("diffusion") for e in stored)
        wide = assemble_features(
            long, features, regions, LOAD_ORDER if several else None, unique=True
        )
        return self._with_session_columns(wide, include_metadata, include_tiv)

    # -- summary ----------------------------------------------------------------------

    def summary(self) -> DataFrame:
        """One row: sessions, subjects, tables and features."""
        entries = self.catalog.entries()
        tables = entries.agg(
            F.count_if(F.col("kind") == "base").alias("n_long"),
            F.count_if(F.col("kind") == "wide").alias("n_wide_features"),
            F.count_if((F.col("kind") == "wide") & (F.col("modality") == "anatomical")).alias(
                "n_anatomical_features"
            ),
            F.count_if((F.col("kind") == "wide") & (F.col("modality") == "diffusion")).alias(
                "n_diffusion_features"
            ),
            F.coalesce(
                F.bool_or((F.col("kind") == "wide") & (F.col("name") == "tiv")), F.lit(False)
            ).alias("has_tiv"),
        )
        counts = session_counts(self.ledger())
        return tables.withColumns(
            {c: counts.select(c).scalar() for c in ("n_sessions", "n_subjects")}
        )

    def age_statistics(self) -> DataFrame:
        return value_statistics(self.load_metadata(), "AGE")
