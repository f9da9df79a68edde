"""Stored tables, incremental load and the published layout.

Every query builds its store from the whole tables below the scratch folder and returns
what the store then answers; the SQL states the same result in one shot.
"""

from pyspark.sql import functions as F

from parcelhouse.operators.latest import keep_last
from parcelhouse.operators.profile import outcome_summary
from parcelhouse.operators.reshape import to_wide
from parcelhouse.plans.load_job import LoadSettings, run_load
from parcelhouse.plans.published import (
    KEY,
    PublishedDataset,
    available_metrics,
    participant_rows,
    tidy_view,
)
from parcelhouse.plans.scratch import materialize, scratch_path
from parcelhouse.plans.store import FeatureStore
from parcelhouse.sources.region_files import anatomical_files, anatomical_glob, list_files
from parcelhouse.streaming.ingest import ingest_stream, load_anatomical
from parcelhouse.workloads.bindings import (
    LONG_DIFFUSION,
    LONG_EVENTS,
    LONG_TISSUE,
    SESSIONS,
    long_diffusion,
    long_tissue,
    sessions,
    table,
    with_,
)
from parcelhouse.workloads.files import ATLAS, _REGION_SQL, _as_csv, anatomical_tree
from parcelhouse.workloads.registry import query
from parcelhouse.workloads.trees import write_text_tree

KEYS = ["subject_code", "session_id"]
EVENTS = "anatomical_ev"


def _store(spark, **options):
    return FeatureStore(spark, scratch_path(spark, "store"), **options)


def _event_rows(spark, sf):
    """Events as store rows; ``part`` is the third of the day, the order of delivery."""
    return table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("subject_code"),
        F.date_format("ts", "yyyyMMdd").alias("session_id"),
        F.col("event_type").alias("label"),
        F.col("value").alias("mean"),
        F.col("event_id").alias("line_no"),
        F.floor(F.hour("ts") / 8).cast("int").alias("part"),
    )


def _deliveries(spark, sf):
    rows = _event_rows(spark, sf)
    return [rows.where(F.col("part") == p).drop("part") for p in range(3)]


_NEWEST = with_(e=LONG_EVENTS) + """
SELECT subject_code, session_id, label, arg_max(mean, seq) AS mean FROM e GROUP BY ALL
"""
_CELLS = [*KEYS, "label", "mean"]


_PATH = (
    "concat_ws('/', lpad(cast(cast(round(volume_mm3 * 100) as bigint) as {s}), 12, '0'), "
    "lpad(cast(partkey as {s}), 12, '0'), lpad(cast(suppkey as {s}), 12, '0'), "
    "cast(cast(mean as bigint) as {s}), cast(cast(round(std * 100) as bigint) as {s}), "
    "cast(cast(round(tax * 100) as bigint) as {s}), linestatus, cast(cast(shipdate as date) as {s}))"
)


def _tissue_rows(spark, sf, modality=None):
    rows = long_tissue(spark, sf)
    if modality is not None:
        rows = rows.where(F.col("modality") == modality)
    return rows.withColumn("source_path", F.expr(_PATH.format(s="string"))).drop(
        "tax", "partkey", "suppkey", "linestatus", "shipdate", "tiv"
    )


_TISSUE = f"SELECT *, {_PATH.format(s='varchar')} AS path FROM ({LONG_TISSUE})"
_CURRENT = """
SELECT subject_code, session_id, modality, label, arg_max(volume_mm3, path) AS volume_mm3,
       arg_max(mean, path) AS mean, arg_max(std, path) AS std FROM t GROUP BY ALL
"""


def _wide(value, label="label", names=range(1, 8), alias="{n}"):
    return ", ".join(
        f"max({value}) FILTER (WHERE {label} = '{n}') AS \"{alias.format(n=n)}\"" for n in names
    )


@query("k02_upsert", _NEWEST)
def upsert(spark, sf):
    """Two deliveries published, a third only staged."""
    store = _store(spark)
    first, second, third = _deliveries(spark, sf)
    store.save_anatomical_long(first, "ev")
    store.save_anatomical_long(second, "ev")
    store.publish()
    store.save_anatomical_long(third, "ev")
    return store.load_long(EVENTS).select(*_CELLS)


@query(
    "k02_incremental",
    with_(e=LONG_EVENTS) + """
    SELECT subject_code, session_id, label,
           mean + CASE WHEN CAST(subject_code AS BIGINT) % 100 = 7 THEN 2 ELSE 0 END AS mean
    FROM (SELECT subject_code, session_id, label, arg_max(mean, seq) AS mean FROM e GROUP BY ALL)
    """,
)
def incremental(spark, sf):
    """One subject in a hundred is delivered twice more; the other buckets stay as they are."""
    store = _store(spark, bucket_rows=2_000)
    rows = _event_rows(spark, sf).drop("part")
    store.save_anatomical_long(rows, "ev")
    store.publish()
    for added in (1, 2):
        few = rows.where(F.col("subject_code").cast("bigint") % 100 == 7)
        store.save_anatomical_long(few.withColumn("mean", F.col("mean") + added), "ev")
        store.publish()
    return store.load_long(EVENTS, include_staged=False).select(*_CELLS)


@query(
    "k03_incremental",
    with_(t=_TISSUE, c=_CURRENT) + f"""
    , d AS (SELECT subject_code, session_id, label, volume_mm3
              + CASE WHEN CAST(subject_code AS BIGINT) % 50 = 3 THEN 1000 ELSE 0 END AS volume_mm3
            FROM c WHERE modality = 'gm')
    SELECT subject_code, session_id, {_wide("volume_mm3")} FROM d GROUP BY ALL
    """,
)
def incremental_wide(spark, sf):
    """Wide features follow a correction of some subjects; only their buckets are pivoted again."""
    store = _store(spark, bucket_rows=5_000)
    rows = _tissue_rows(spark, sf, "gm")
    store.save_anatomical_long(rows, "gm")
    store.publish()
    store.generate_wide_features()
    few = rows.where(F.col("subject_code").cast("bigint") % 50 == 3)
    store.save_anatomical_long(few.withColumn("volume_mm3", F.col("volume_mm3") + 1000), "gm")
    store.publish()
    store.generate_wide_features()
    return store.load_feature("gm_volume_mm3", include_metadata=False)


@query("k01_codec", _NEWEST)
def codec(spark, sf):
    store = _store(spark, compression="gzip")
    for delivery in _deliveries(spark, sf):
        store.save_anatomical_long(delivery, "ev")
    store.publish()
    return store.load_long(EVENTS, include_staged=False).select(*_CELLS)


@query("s07_t07_staged", _NEWEST)
def staged(spark, sf):
    """Nothing is published: the staged rows answer."""
    store = _store(spark)
    for delivery in _deliveries(spark, sf):
        store.save_anatomical_long(delivery, "ev")
    return store.load_long(EVENTS).select(*_CELLS)


@query(
    "t04_t09_publish",
    _NEWEST.replace("arg_max(mean, seq) AS mean", "arg_max(mean, seq) AS mean, 0::BIGINT AS n_staged"),
)
def publish(spark, sf):
    """Published after every delivery; nothing stays staged."""
    store = _store(spark)
    for delivery in _deliveries(spark, sf):
        store.save_anatomical_long(delivery, "ev")
        store.publish()
    return store.load_long(EVENTS, include_staged=False).select(
        *_CELLS, F.lit(store.staged().count()).cast("bigint").alias("n_staged")
    )


@query("t03_stream", _NEWEST)
def stream(spark, sf):
    """Three deliveries arrive as files; each run of the stream takes what is new."""
    store, inbox = _store(spark), scratch_path(spark, "inbox")
    checkpoint = scratch_path(spark, "checkpoint")
    for delivery in _deliveries(spark, sf):
        delivery.write.mode("append").parquet(inbox)
        rows = spark.readStream.schema(delivery.schema).parquet(inbox)
        ingest_stream(store, rows, EVENTS, checkpoint)
    return store.load_long(EVENTS).select(*_CELLS)


@query("t05_resume", with_(l=_REGION_SQL) + "SELECT l.* EXCLUDE (remark), 1::BIGINT AS n_batches FROM l")
def resume(spark, sf):
    """Region files by ledger; the second run finds nothing new."""
    store, root = _store(spark), anatomical_tree(spark, sf)
    load_anatomical(store, root, ATLAS)
    load_anatomical(store, root, ATLAS)
    batches = store.staged().select("batch_id").distinct().count()
    tables = [store.load_long(f"anatomical_{m}") for m in ("gm", "wm", "ct")]
    rows = tables[0].unionByName(tables[1]).unionByName(tables[2])
    return rows.select(
        *KEYS, "modality", "metric", "label", "index", "volume_mm3", "mean", "std",
        F.lit(batches).cast("bigint").alias("n_batches"),
    )


@query("t05_registry_grows", with_(l=_REGION_SQL) + "SELECT l.* EXCLUDE (remark) FROM l")
def registry_grows(spark, sf):
    """Half of the subjects are registered only after the files of all have been seen."""
    store, root = _store(spark), anatomical_tree(spark, sf)
    found = list_files(spark, root, anatomical_glob())
    ids = anatomical_files(found, ATLAS).select(*KEYS).distinct()
    registry = materialize(
        ids.withColumns({f"{k}_raw": F.col(k) for k in KEYS}), "growing-registry"
    )
    early = registry.where(F.pmod(F.col("subject_code").cast("bigint"), F.lit(2)) == 0)
    load_anatomical(store, root, ATLAS, early)
    store.publish()
    load_anatomical(store, root, ATLAS, registry)
    tables = [store.load_long(f"anatomical_{m}") for m in ("gm", "wm", "ct")]
    rows = tables[0].unionByName(tables[1]).unionByName(tables[2])
    return rows.select(
        *KEYS, "modality", "metric", "label", "index", "volume_mm3", "mean", "std"
    )


def _loaded(store):
    tables = [store.load_long(f"anatomical_{m}") for m in ("gm", "wm", "ct")]
    rows = tables[0].unionByName(tables[1]).unionByName(tables[2])
    return rows.select(*KEYS, "modality", "metric", "label", "index", "volume_mm3", "mean", "std")


@query(
    "t01_file_rewritten",
    with_(l=_REGION_SQL) + """
    , m AS (SELECT *, modality = 'ct' AND CAST(subject_code AS BIGINT) % 10 = 3 AS again,
                   row_number() OVER (PARTITION BY subject_code, session_id, modality ORDER BY index) AS i
            FROM l)
    SELECT subject_code, session_id, modality, metric, label, index,
           CASE WHEN again THEN 5.0::DOUBLE ELSE volume_mm3 END AS volume_mm3,
           CASE WHEN NOT again THEN mean END AS mean, CASE WHEN NOT again THEN std END AS std,
           (SELECT count(*) FROM m WHERE again AND i = 1) AS n_loaded_again
    FROM m WHERE NOT again OR i = 1
    """,
)
def file_rewritten(spark, sf):
    """Some files are rewritten in place with fewer rows; a further run loads them alone."""
    store, root = _store(spark), anatomical_tree(spark, sf, fresh=True)
    load_anatomical(store, root, ATLAS)
    store.publish()
    rows = _loaded(store).where("modality = 'ct' AND cast(subject_code AS bigint) % 10 = 3")
    files = rows.groupBy(*KEYS).agg(F.min("index").alias("index")).select(
        F.concat_ws(
            "", F.lit("sub-"), "subject_code", F.lit("/ses-"), "session_id",
            F.lit(f"/anat/atlas-{ATLAS}/a_tissue-CT_parc.tsv"),
        ).alias("path"),
        F.concat(
            F.lit("index\tlabel\tvolume_mm3\n"), F.col("index").cast("string"), F.lit("\tR."),
            F.col("index").cast("string"), F.lit("\t5.0\n"),
        ).alias("content"),
    )
    write_text_tree(files, root)
    again = load_anatomical(store, root, ATLAS)
    store.publish()
    return _loaded(store).withColumn("n_loaded_again", F.lit(again).cast("bigint"))


@query(
    "t01_source_added",
    with_(l=_REGION_SQL) + """
    SELECT subject_code, session_id, modality, metric, label, index, volume_mm3, mean, std,
           (SELECT count(DISTINCT (subject_code, session_id, modality)) FROM l WHERE modality <> 'gm') AS n_added
    FROM l
    """,
)
def source_added(spark, sf):
    """Two more tissues are asked for later: their files are loaded, the first ones are not read again."""
    store, root = _store(spark), anatomical_tree(spark, sf)
    load_anatomical(store, root, ATLAS, modalities=("gm",))
    store.publish()
    added = load_anatomical(store, root, ATLAS, modalities=("gm", "wm", "ct"))
    return _loaded(store).withColumn("n_added", F.lit(added).cast("bigint"))


def _broken_tree(spark, sf):
    """One wm file in nine lacks the region column, one is blank; suppliers are the registry."""
    root = anatomical_tree(spark, sf, fresh=True)
    kind = F.col("l_suppkey") % 9
    lines = table(spark, sf, "lineitem").where("l_returnflag = 'N' AND l_suppkey % 9 IN (0, 1)")
    files = lines.select("l_suppkey", "l_linestatus").distinct().select(
        F.concat(
            F.lit("sub-"), F.col("l_suppkey").cast("string"),
            F.when(F.col("l_linestatus") == "F", "/ses-01").otherwise("/ses-02"),
            F.lit(f"/anat/atlas-{ATLAS}/a_tissue-WM_parc.tsv"),
        ).alias("path"),
        F.when(kind == 0, "std\tmean\n1\t2\n").otherwise(" \n").alias("content"),
    )
    write_text_tree(files, root)
    return root


_BROKEN = with_(l=_REGION_SQL) + """
, r AS (SELECT CAST(s_suppkey AS VARCHAR) AS subject_code, '0' || k AS session_id, s_suppkey % 9 AS kind
        FROM supplier, range(1, 4) AS t(k)),
o AS (SELECT subject_code, session_id, kind, EXISTS (SELECT 1 FROM l WHERE modality = 'wm'
        AND l.subject_code = r.subject_code AND l.session_id = r.session_id) AS has_file FROM r)
"""


def _broken_store(spark, sf):
    store = _store(spark)
    registry = table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("subject_code"),
        F.explode(F.array(F.lit("01"), F.lit("02"), F.lit("03"))).alias("session_id"),
    )
    registry = registry.withColumns({f"{k}_raw": F.col(k) for k in KEYS})
    load_anatomical(store, _broken_tree(spark, sf), ATLAS, registry, modalities=("wm",))
    return store, registry


@query(
    "a19_outcomes_of_files",
    _BROKEN + """
    SELECT CASE WHEN NOT has_file THEN 'skipped' WHEN kind IN (0, 1) THEN 'error' ELSE 'success' END AS status,
           count(*) AS n FROM o GROUP BY ALL
    """,
)
def outcomes_of_files(spark, sf):
    store, registry = _broken_store(spark, sf)
    return outcome_summary(registry, store.existing_sessions(), store.failed_files())


@query(
    "k07_report_file",
    _BROKEN + """
    SELECT subject_code, session_id, CASE WHEN NOT has_file THEN 'no data'
        WHEN kind = 0 THEN 'no region column' ELSE 'empty file' END AS reason
    FROM o WHERE NOT has_file OR kind IN (0, 1)
    """,
)
def report_file(spark, sf):
    """The report of sessions without data, written as CSV and read back."""
    store, registry = _broken_store(spark, sf)
    path = scratch_path(spark, "missing")
    store.missing_report(registry, path)
    return spark.read.schema("subject_code string, session_id string, reason string").option(
        "header", True).csv(path)


@query(
    "t03_session_hook",
    with_(e=LONG_EVENTS) + """
    , n AS (SELECT subject_code, session_id, label, arg_max(mean, seq) AS mean FROM e GROUP BY ALL)
    SELECT n.*, (SELECT count(DISTINCT (subject_code, session_id)) FROM e
                 WHERE CAST(subject_code AS BIGINT) % 7 = 2) AS n_failed FROM n
    """,
)
def session_hook(spark, sf):
    """A hook per session that fails for some of them: all rows are there, the failures are listed."""
    store, inbox = _store(spark), scratch_path(spark, "inbox")
    rows = _event_rows(spark, sf).drop("part")
    rows.write.parquet(inbox)

    def hook(subject, session, frame):
        if int(subject) % 7 == 2:
            raise ValueError(f"{len(frame)} rows of {session} refused")

    source = spark.readStream.schema(rows.schema).parquet(inbox)
    ingest_stream(store, source, EVENTS, scratch_path(spark, "checkpoint"), on_session=hook)
    failed = store.hook_failures().select(*KEYS).distinct().count()
    return store.load_long(EVENTS).select(*_CELLS, F.lit(failed).cast("bigint").alias("n_failed"))


@query("k02_within_delivery", _NEWEST)
def within_delivery(spark, sf):
    """One delivery without any order column: of equal keys the last row counts."""
    store = _store(spark)
    rows = _event_rows(spark, sf).orderBy("line_no").drop("part", "line_no")
    store.save_anatomical_long(rows, "ev")
    return store.load_long(EVENTS).select(*_CELLS)


@query("t06_force", _NEWEST.replace("arg_max(mean, seq) AS mean", "round(arg_max(mean, seq) + 1, 6) AS mean"))
def force(spark, sf):
    """A full reload with corrected values replaces what was loaded and published."""
    store, inbox = _store(spark), scratch_path(spark, "inbox")
    checkpoint = scratch_path(spark, "checkpoint")
    rows = _event_rows(spark, sf).drop("part")
    rows.write.parquet(inbox)
    source = spark.readStream.schema(rows.schema).parquet(inbox)
    ingest_stream(store, source, EVENTS, checkpoint)
    store.publish()
    corrected = source.withColumn("mean", F.round(F.col("mean") + 1, 6))
    store.forget(checkpoint)
    ingest_stream(store, corrected, EVENTS, checkpoint)
    return store.load_long(EVENTS).select(*_CELLS)


def _tissue_store(spark, sf, modalities=("gm", "wm", "ct"), publish=True):
    store = _store(spark)
    for modality in modalities:
        store.save_anatomical_long(_tissue_rows(spark, sf, modality), modality)
    if publish:
        store.publish()
    return store


@query(
    "t01_pending",
    with_(s=SESSIONS, l=LONG_TISSUE) + """
    SELECT s.subject_code, s.session_id, site,
           string_agg(w.source, ',' ORDER BY w.source) AS sources_to_load
    FROM s, (VALUES ('gm'), ('wm'), ('ct')) AS w(source)
    WHERE w.source = 'ct' OR NOT EXISTS (SELECT 1 FROM l WHERE l.modality = w.source
        AND l.subject_code = s.subject_code AND l.session_id = s.session_id)
    GROUP BY ALL
    """,
)
def pending(spark, sf):
    store = _tissue_store(spark, sf, ("gm", "wm"), publish=False)
    found = store.pending(sessions(spark, sf), ("gm", "wm", "ct"))
    return found.select(
        *KEYS, "site", F.array_join("sources_to_load", ",").alias("sources_to_load")
    )


@query(
    "t02_ledger",
    with_(s=SESSIONS, l=LONG_TISSUE) + """
    SELECT s.subject_code, s.session_id, round(AGE, 6) AS "AGE", site, priority,
           coalesce(bool_or(l.modality = 'gm'), false) AS anatomical_gm_loaded,
           coalesce(bool_or(l.modality = 'wm'), false) AS anatomical_wm_loaded,
           false AS anatomical_ct_loaded, false AS diffusion_loaded
    FROM s LEFT JOIN l ON l.subject_code = s.subject_code AND l.session_id = s.session_id
    GROUP BY s.subject_code, s.session_id, AGE, site, priority
    """,
)
def ledger(spark, sf):
    store = _tissue_store(spark, sf, ("gm", "wm"))
    store.initialize_metadata(sessions(spark, sf))
    return store.load_metadata().withColumn("AGE", F.round("AGE", 6))


@query(
    "t08_existing",
    with_(l=LONG_TISSUE) + "SELECT DISTINCT subject_code, session_id FROM l",
)
def existing(spark, sf):
    store = _tissue_store(spark, sf, ["gm"])
    for modality in ("wm", "ct"):
        store.save_anatomical_long(_tissue_rows(spark, sf, modality), modality)
    return store.existing_sessions()


@query(
    "t09_keep_staged",
    with_(l=LONG_TISSUE) + """
    SELECT 'anatomical_' || modality AS source, count(DISTINCT (subject_code, session_id)) AS n_sessions
    FROM l GROUP BY ALL
    """,
)
def keep_staged(spark, sf):
    store = _tissue_store(spark, sf, publish=False)
    store.publish(keep_staged=True)
    return store.staged_status()


@query(
    "c01_register",
    with_(t=_TISSUE, c=_CURRENT) + """
    SELECT 'anatomical_' || modality AS name, 'anatomical' AS modality, count(*) AS n_rows,
           count(DISTINCT (subject_code, session_id)) AS n_sessions,
           count(DISTINCT subject_code) AS n_subjects, 'volume_mm3,mean,std' AS statistics
    FROM c GROUP BY c.modality
    """,
)
def register(spark, sf):
    entries = _tissue_store(spark, sf).catalog.entries("base")
    return entries.select(
        "name", "modality", "n_rows", "n_sessions", "n_subjects",
        F.array_join("statistics", ",").alias("statistics"),
    )


@query(
    "c02_k03_register_wide",
    with_(t=_TISSUE, c=_CURRENT) + """
    SELECT modality || '_' || s AS name, s AS metric, modality AS source_modality,
           count(DISTINCT label) AS n_regions,
           count(DISTINCT (subject_code, session_id)) AS n_sessions,
           string_agg(DISTINCT label, ',' ORDER BY label) AS regions
    FROM c, (VALUES ('volume_mm3'), ('mean'), ('std')) AS v(s) GROUP BY ALL
    """,
)
def register_wide(spark, sf):
    store = _tissue_store(spark, sf)
    store.generate_wide_features()
    return store.catalog.entries("wide").select(
        "name", "metric", "source_modality", "n_regions", "n_sessions",
        F.array_join("regions", ",").alias("regions"),
    )


@query(
    "s08_load_feature",
    with_(t=_TISSUE, c=_CURRENT, s=SESSIONS) + f"""
    , w AS (SELECT subject_code, session_id, {_wide("volume_mm3")} FROM c
            WHERE modality = 'gm' GROUP BY ALL)
    SELECT w.*, round(s.AGE, 6) AS "AGE", site, priority, o.o_totalprice AS tiv,
           true AS anatomical_gm_loaded, false AS anatomical_wm_loaded,
           false AS anatomical_ct_loaded, false AS diffusion_loaded
    FROM w LEFT JOIN s ON w.subject_code = s.subject_code AND w.session_id = s.session_id
    LEFT JOIN orders o ON CAST(o_orderkey AS VARCHAR) = w.session_id
    """,
)
def load_feature(spark, sf):
    store = _tissue_store(spark, sf, ["gm"])
    store.initialize_metadata(sessions(spark, sf))
    store.save_tiv(
        sessions(spark, sf).join(
            table(spark, sf, "orders").select(
                F.col("o_orderkey").cast("string").alias("session_id"),
                F.col("o_totalprice").alias("tiv"),
            ),
            "session_id",
        )
    )
    store.generate_wide_features(metrics=["volume_mm3"])
    df = store.load_feature("gm_volume_mm3", include_metadata=True, include_tiv=True)
    return df.withColumn("AGE", F.round("AGE", 6))


@query(
    "s08_load_features",
    with_(t=_TISSUE, c=_CURRENT) + "SELECT subject_code, session_id, " + ", ".join(
        f"max({s}) FILTER (WHERE label = '{n}' AND modality = '{m}') AS \"{m}_{s}__{n}\""
        for m, s in (("gm", "volume_mm3"), ("wm", "mean"), ("ct", "std")) for n in range(1, 8)
    ) + " FROM c GROUP BY ALL",
)
def load_features(spark, sf):
    store = _tissue_store(spark, sf)
    store.generate_wide_features()
    return store.load_features(["gm_volume_mm3", "wm_mean", "ct_std"], include_metadata=False)


@query(
    "r02_k03_diffusion_features",
    with_(l=LONG_DIFFUSION) + """
    SELECT workflow || '_' || model || '_' || param || '_' || s AS name, count(DISTINCT label) AS n_regions,
           count(DISTINCT (subject_code, session_id)) AS n_sessions
    FROM l, (VALUES ('mean'), ('std'), ('volume_mm3'), ('voxel_count')) AS v(s)
    GROUP BY ALL
    """,
)
def diffusion_features(spark, sf):
    """All features of a workflow are published by one job."""
    store = _store(spark)
    rows = long_diffusion(spark, sf).withColumn("desc", F.lit("unknown"))
    for workflow in ("A", "N", "R"):
        store.save_diffusion_long(
            rows.where(F.col("workflow") == workflow).drop("tax", "partkey", "shipdate"), workflow
        )
    store.publish()
    store.generate_wide_features()
    return store.catalog.entries("wide").select("name", "n_regions", "n_sessions")


@query(
    "k04_s09_tiv",
    """
    SELECT CAST(o_custkey AS VARCHAR) AS subject_code, CAST(o_orderkey AS VARCHAR) AS session_id,
           CASE o_orderstatus WHEN 'F' THEN o_totalprice / 2 ELSE o_totalprice END AS tiv
    FROM orders
    """,
)
def totals(spark, sf):
    """A second delivery corrects some totals; one delivery holds a session twice."""
    orders = table(spark, sf, "orders")
    rows = orders.select(
        F.col("o_custkey").cast("string").alias("subject_code"),
        F.col("o_orderkey").cast("string").alias("session_id"),
        F.col("o_totalprice").alias("tiv"), "o_orderstatus",
    )
    store = _store(spark)
    store.save_tiv(rows.unionByName(rows.withColumn("tiv", -F.col("tiv"))))
    finished = rows.where("o_orderstatus = 'F'")
    store.save_tiv(finished.withColumn("tiv", F.col("tiv") / 2))
    return store.load_feature("tiv")


@query(
    "a17_summary",
    with_(l=LONG_TISSUE) + """
    SELECT 3::BIGINT AS n_long, 10::BIGINT AS n_wide_features, 10::BIGINT AS n_anatomical_features,
           0::BIGINT AS n_diffusion_features, true AS has_tiv,
           count(DISTINCT (subject_code, session_id)) AS n_sessions,
           count(DISTINCT subject_code) AS n_subjects FROM l
    """,
)
def summary(spark, sf):
    store = _tissue_store(spark, sf)
    store.generate_wide_features()
    store.save_tiv(long_tissue(spark, sf))
    return store.summary()


@query(
    "a03_age_statistics",
    with_(s=SESSIONS) + """
    SELECT round(min(AGE), 6) AS min, round(max(AGE), 6) AS max, round(avg(AGE), 6) AS mean,
           count(*) FILTER (WHERE AGE IS NULL) AS missing FROM s
    """,
)
def age_statistics(spark, sf):
    store = _store(spark)
    store.initialize_metadata(sessions(spark, sf).withColumnRenamed("AGE", "age"))
    return store.age_statistics().select(
        *[F.round(c, 6).alias(c) for c in ("min", "max", "mean")], "missing"
    )


def _published(spark, sf):
    """gm_mean, wm_volume_mm3 and ct_std wide, and tidy rows of all three."""
    data = PublishedDataset(spark, scratch_path(spark, "published"))
    # One join and one reduction to a row per key serve all six datasets.
    rows = _tissue_rows(spark, sf).select(*KEYS, "modality", "label", "volume_mm3", "mean", "std", "source_path")
    newest = keep_last(rows, [*KEYS, "modality", "label"], ["source_path"]).drop("source_path")
    newest = materialize(newest, "published-rows")
    for modality, statistic in (("gm", "mean"), ("wm", "volume_mm3"), ("ct", "std")):
        long = newest.where(F.col("modality") == modality)
        wide = to_wide(long, "label", statistic, unique=True)
        data.write_features(participant_rows(wide), "anatomical", modality, statistic)
        tidy = tidy_view(long, modality, ["mean", "volume_mm3"])
        data.write_features(tidy, "anatomical", modality, "all", "long")
    data.write_metadata(
        participant_rows(sessions(spark, sf)).withColumnRenamed("site", "group")
    )
    return data


_ID = "subject_code || '_' || session_id AS participant_id"


@query(
    "s10_k05_contract",
    with_(t=_TISSUE, c=_CURRENT) + f"""
    SELECT {_ID}, {_wide("mean")} FROM c WHERE modality = 'gm' GROUP BY ALL
    """,
)
def contract(spark, sf):
    return _published(spark, sf).get_features("anatomical", "gm", "mean")


@query(
    "s10_p06_contract_long",
    with_(t=_TISSUE, c=_CURRENT) + f"""
    SELECT {_ID}, label AS parcel, modality AS metric, volume_mm3 AS value,
           'volume_mm3' AS statistic FROM c WHERE modality = 'wm'
    """,
)
def contract_long(spark, sf):
    return _published(spark, sf).get_features("anatomical", "wm", "volume_mm3", fmt="long")


@query(
    "s10_rewritten",
    with_(t=_TISSUE, c=_CURRENT) + f"""
    SELECT {_ID}, label AS parcel, modality AS metric, volume_mm3 AS value,
           'volume_mm3' AS statistic, 'second' AS edition FROM c WHERE modality = 'wm'
    """,
)
def rewritten(spark, sf):
    """Written again with one more column, a dataset is its newest version only."""
    data = _published(spark, sf)
    tidy = data.get_features("anatomical", "wm", "volume_mm3", fmt="long")
    data.write_features(tidy.withColumn("edition", F.lit("second")), "anatomical", "wm", "all", "long")
    entries = data._entries(modality="anatomical", format="long", metric="wm")
    return spark.read.parquet(*[e.file for e in entries])


_SIDE_BY_SIDE = with_(
    t=_TISSUE, c=_CURRENT,
    g=f"SELECT {_ID}, {_wide('mean', alias='gm_mean_{n}')} FROM c WHERE modality = 'gm' GROUP BY ALL",
    w=f"SELECT {_ID}, {_wide('volume_mm3', alias='wm_volume_mm3_{n}')} FROM c "
      "WHERE modality = 'wm' GROUP BY ALL",
    d=f"SELECT {_ID}, {_wide('std', alias='ct_std_{n}')} FROM c WHERE modality = 'ct' GROUP BY ALL",
) + "SELECT * FROM g FULL JOIN w USING (participant_id) FULL JOIN d USING (participant_id)"


@query("s10_j09_contract_all", _SIDE_BY_SIDE)
def contract_all(spark, sf):
    return _published(spark, sf).get_features("anatomical")


@query("j09_e08_select", _SIDE_BY_SIDE)
def select(spark, sf):
    return _published(spark, sf).select(anatomical=["gm_mean", "wm_volume_mm3", "ct_std"])


@query(
    "c03_metrics",
    with_(l=LONG_TISSUE) + """
    SELECT modality AS metric, 'all,' || CASE modality WHEN 'gm' THEN 'mean'
        WHEN 'wm' THEN 'volume_mm3' ELSE 'std' END AS statistics FROM l GROUP BY ALL
    """,
)
def metrics(spark, sf):
    found = _published(spark, sf).available_metrics("anatomical")
    return found.select("metric", F.array_join("statistics", ",").alias("statistics"))


@query(
    "c03_metrics_tidy",
    with_(l=LONG_TISSUE) + """
    SELECT modality AS metric, 'mean,std' AS statistics FROM l GROUP BY ALL
    """,
)
def metrics_tidy(spark, sf):
    long = long_tissue(spark, sf)
    tidy = long.select(
        F.col("modality").alias("metric"),
        F.explode(F.array(F.lit("std"), F.lit("mean"))).alias("statistic"),
    )
    return available_metrics(tidy).select(
        "metric", F.array_join("statistics", ",").alias("statistics")
    )


@query(
    "c05_published",
    with_(l=LONG_TISSUE, s=SESSIONS) + """
    , f AS (SELECT m, count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.modality = m
              AND l.subject_code = s.subject_code AND l.session_id = s.session_id)) AS n
            FROM s, (VALUES ('gm'), ('wm'), ('ct')) AS t(m) GROUP BY ALL)
    SELECT true AS valid, 0::BIGINT AS n_errors, 5 + count(*) FILTER (WHERE n > 0) AS n_warnings,
           (SELECT count(*) FROM s) AS n_subjects, 21::BIGINT AS n_anatomical_features,
           0::BIGINT AS n_diffusion_features FROM f
    """,
)
def published_summary(spark, sf):
    """Optional fields are missing and sessions lack features: warnings, no errors."""
    return _published(spark, sf).validate(required=("AGE",))[1]


@query("c04_subjects", with_(s=SESSIONS) + f"SELECT DISTINCT {_ID} FROM s")
def subjects(spark, sf):
    return _published(spark, sf).subject_ids()


@query("c04_n_subjects", with_(s=SESSIONS) + "SELECT count(*) AS n_subjects FROM s")
def n_subjects(spark, sf):
    return _published(spark, sf).n_subjects()


def _suppliers_csv(spark, sf):
    registry = table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("subject_code"),
        F.explode(F.array(F.lit("01"), F.lit("02"))).alias("session_id"),
        F.col("s_acctbal").alias("AGE"),
    )
    return _as_csv(registry, "registry")


@query(
    "c09_job",
    with_(l=_REGION_SQL) + f"""
    , c AS (SELECT lpad(subject_code, CAST(greatest(4, length(subject_code)) AS INTEGER), '0') AS subject_code,
                   substr(session_id, 2) AS session_id, label, volume_mm3, s_acctbal AS "AGE"
            FROM l JOIN supplier ON subject_code = CAST(s_suppkey AS VARCHAR)
            WHERE modality = 'gm')
    SELECT subject_code, session_id, "AGE", true AS anatomical_gm_loaded,
           {_wide("volume_mm3", names=[f"R.{n}" for n in range(1, 8)])},
           0::BIGINT AS second_run_published
    FROM c GROUP BY ALL
    """,
)
def job(spark, sf):
    """Files to features in one call; a second call finds nothing to do."""
    settings = LoadSettings(
        registry_path=_suppliers_csv(spark, sf), store_root=scratch_path(spark, "store"),
        anatomical_root=anatomical_tree(spark, sf), atlas=ATLAS, sources=("gm", "wm", "ct"),
    )
    run_load(spark, settings)
    again = run_load(spark, settings)
    store = FeatureStore(spark, settings.store_root)
    return (
        store.load_feature("gm_volume_mm3")
        .drop("anatomical_wm_loaded", "anatomical_ct_loaded", "diffusion_loaded")
        .withColumn("second_run_published", F.lit(len(again.published)).cast("bigint"))
    )
