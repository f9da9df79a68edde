"""Properties of the store: nothing lost, newest wins, reruns change nothing."""

import os
import urllib.parse

import pytest
from pyspark.sql import functions as F

from parcelhouse.plans.load_job import LoadSettings, run_load
from parcelhouse.plans.store import FeatureStore, bucket_of, check_codec
from parcelhouse.streaming.ingest import load_anatomical, load_diffusion, session_hook
from test_sources import _write

COLUMNS = "subject_code string, session_id string, label string, mean double, line_no bigint"


def _rows(spark, *rows):
    return spark.createDataFrame(list(rows), COLUMNS)


def _values(df):
    return {(r.subject_code, r.session_id, r.label, r["mean"]) for r in df.collect()}


def test_upsert_is_idempotent_and_keeps_the_newest(spark, root):
    store = FeatureStore(spark, root)
    first = _rows(spark, ("1", "a", "x", 1.0, 1), ("1", "a", "x", 2.0, 2), ("1", "a", "y", 3.0, 3))
    store.save_anatomical_long(first, "gm")
    assert _values(store.load_long("anatomical_gm")) == {("1", "a", "x", 2.0), ("1", "a", "y", 3.0)}
    store.publish()
    store.save_anatomical_long(first, "gm")
    store.save_anatomical_long(_rows(spark, ("1", "a", "y", 9.0, 1), ("2", "a", "x", 4.0, 1)), "gm")
    want = {("1", "a", "x", 2.0), ("1", "a", "y", 9.0), ("2", "a", "x", 4.0)}
    assert _values(store.load_long("anatomical_gm")) == want
    store.publish()
    assert _values(store.load_long("anatomical_gm")) == want
    assert store.staged().count() == 0 and store.publish() == []
    assert store.catalog.find("base", "anatomical_gm").n_sessions == 2


def test_publishing_merges_and_never_overwrites(spark, root):
    store = FeatureStore(spark, root)
    for subject in "123":
        store.save_anatomical_long(_rows(spark, (subject, "a", "x", 1.0, 1)), "gm")
        store.publish()
    assert store.load_long("anatomical_gm").count() == 3


def _files(root, table):
    found = {}
    for folder, _, names in os.walk(os.path.join(root, table)):
        for name in names:
            if name.endswith(".parquet"):
                path = os.path.join(folder, name)
                found[path] = os.path.getmtime(path)
    return found


def _buckets(files):
    return {next(p for p in f.split("/") if p.startswith("bucket=")) for f in files}


def test_a_delivery_rewrites_only_its_buckets(spark, root):
    store = FeatureStore(spark, root, bucket_rows=40)
    many = _rows(spark, *[(str(i), "a", r, float(i), 1) for i in range(100) for r in "xyzuvw"])
    store.save_anatomical_long(many, "gm")
    store.publish()
    store.generate_wide_features()
    base, wide = _files(root, "base"), _files(root, "wide")
    assert len(_buckets(base)) == 16
    store.save_anatomical_long(_rows(spark, ("5", "a", "x", -5.0, 1), ("5", "b", "new", 1.0, 2)), "gm")
    store.publish()
    store.generate_wide_features()
    for table, before in (("base", base), ("wide", wide)):
        after = _files(root, table)
        assert all(after[f] == t for f, t in before.items())
        added = [f for f in after if f not in before and "/data/" in f]
        assert added and len(_buckets(added)) == 1
    entry = store.catalog.find("base", "anatomical_gm")
    assert (entry.n_rows, entry.n_sessions, entry.n_subjects) == (601, 101, 100)
    got = {(r.subject_code, r.session_id): r for r in store.load_feature("gm_mean", False).collect()}
    assert len(got) == 101 and got[("5", "a")].x == -5.0 and got[("5", "b")].new == 1.0
    assert got[("7", "a")].new is None and got[("7", "a")].x == 7.0
    assert store.get_feature_info("gm_mean").n_sessions == 101
    # Nothing new, nothing written.
    held = _files(root, "wide")
    assert store.generate_wide_features() == ["gm_mean"] and _files(root, "wide") == held
    # More rows than the buckets are meant for: all are dealt anew, once.
    store.save_anatomical_long(_rows(spark, *[(f"n{i}", "a", "x", 1.0, 1) for i in range(200)]), "gm")
    store.publish()
    assert {r.n_buckets for r in store.manifest("anatomical_gm")} == {32}
    assert store.load_long("anatomical_gm").count() == 801
    store.generate_wide_features()
    # Buckets of old versions go once no kept manifest names them.
    gone = store.retain(1)
    assert any("/base/" in p and "/bucket=" in p for p in gone)
    assert any("/wide/" in p and "/bucket=" in p for p in gone)
    assert store.load_long("anatomical_gm").count() == 801
    assert store.load_feature("gm_mean", False).count() == 301
    assert store.retain(1) == []


def test_features_of_some_statistics_keep_the_others(spark, root):
    store = FeatureStore(spark, root)
    rows = _rows(spark, ("1", "a", "x", 1.0, 1)).withColumn("std", F.lit(0.5))
    store.save_anatomical_long(rows, "gm")
    store.publish()
    assert store.generate_wide_features() == ["gm_mean", "gm_std"]
    store.save_anatomical_long(rows.withColumn("mean", F.lit(3.0)), "gm")
    store.publish()
    assert store.generate_wide_features(metrics=["mean"]) == ["gm_mean"]
    store.retain(1)
    assert store.load_feature("gm_mean", False).first().x == 3.0
    assert store.load_feature("gm_std", False).first().x == 0.5


def test_diffusion_rows_of_other_parameters_survive(spark, root):
    store = FeatureStore(spark, root)
    rows = _rows(spark, ("1", "a", "x", 1.0, 1))
    for desc in ("d1", "d2"):
        for param in ("FA", "MD"):
            tagged = rows.withColumns({"model": F.lit("dti"), "param": F.lit(param), "desc": F.lit(desc)})
            store.save_diffusion_long(tagged, "W")
    store.publish()
    assert store.load_long("diffusion_W").count() == 4
    store.generate_wide_features()
    assert store.list_features("diffusion") == ["W_dti_FA_mean", "W_dti_MD_mean"]
    assert store.load_feature("W_dti_FA_mean", include_metadata=False).count() == 1


def test_partition_values_stay_text(spark, root):
    store = FeatureStore(spark, root)
    rows = _rows(spark, ("1", "a", "x", 1.0, 1)).withColumns(
        {"model": F.lit("01"), "param": F.lit("1e3"), "desc": F.lit("d")}
    )
    store.save_diffusion_long(rows, "W")
    store.publish()
    store.generate_wide_features()
    got = store.load_feature("W_01_1e3_mean", include_metadata=False).collect()
    assert [tuple(r) for r in got] == [("1", "a", 1.0)]


def test_unknown_columns_are_kept(spark, root):
    store = FeatureStore(spark, root)
    store.save_anatomical_long(
        _rows(spark, ("1", "a", "x", float("nan"), 1)).withColumn("site", F.lit("S")), "gm"
    )
    row = store.load_long("anatomical_gm").first()
    assert row.extras == {"site": "S"} and row["mean"] is None


def test_unknown_names_list_what_exists(spark, root):
    store = FeatureStore(spark, root)
    store.save_anatomical_long(_rows(spark, ("1", "a", "x", 1.0, 1)), "gm")
    with pytest.raises(ValueError, match="anatomical_gm"):
        store.load_long("anatomical_wm")
    with pytest.raises(ValueError):
        store.load_feature("nothing")
    with pytest.raises(ValueError):
        store.load_tiv()
    with pytest.raises(ValueError):
        store.save_tiv(_rows(spark))
    assert store.load_metadata().columns == ["subject_code", "session_id"]
    with pytest.raises(ValueError, match="zstd"):
        check_codec("brotli")


def test_ledger_drives_pending_work(spark, root):
    store = FeatureStore(spark, root)
    registry = spark.createDataFrame(
        [("1", "a", 30.0), ("2", "a", None)], "subject_code string, session_id string, age double"
    )
    store.initialize_metadata(registry)
    store.save_anatomical_long(_rows(spark, ("1", "a", "x", 1.0, 1)), "gm")
    flags = {r.subject_code: (r.anatomical_gm_loaded, r.diffusion_loaded) for r in store.load_metadata().collect()}
    assert flags == {"1": (True, False), "2": (False, False)}
    pending = {r.subject_code: r.sources_to_load for r in store.pending(registry, ("gm", "ct")).collect()}
    assert pending == {"1": ["ct"], "2": ["ct", "gm"]}
    # A session that is registered later is pending too, and "nothing to do" is no error.
    more = registry.unionByName(spark.createDataFrame([("3", "a", 1.0)], registry.schema))
    assert store.pending(more, ("gm",)).count() == 2
    assert store.pending(registry.where("subject_code = '1'"), ("gm",)).count() == 0
    assert store.age_statistics().first().missing == 1


def _tissue(value):
    return f"label\tmean\nA\t{value}\nB\t{value}\n"


def _path(subject, tissue="GM"):
    return f"sub-{subject}/ses-01/anat/atlas-A/x_tissue-{tissue}_parc.tsv"


def test_only_new_files_are_loaded(spark, root):
    tree, store = root + "/tree", FeatureStore(spark, root + "/store")
    seen = []

    def hook(rows, batch_id):
        seen.append(rows.count())
        raise RuntimeError("a failing hook must not stop the load")

    _write(tree, {_path(1): _tissue(1), _path(2): _tissue(2)})
    assert load_anatomical(store, tree, "A", on_batch=hook) == 2
    assert load_anatomical(store, tree, "A", on_batch=hook) == 0
    assert seen == [4]
    _write(tree, {_path(3): _tissue(3)})
    assert load_anatomical(store, tree, "A", on_batch=hook) == 1
    assert seen == [4, 2]
    assert store.load_long("anatomical_gm").count() == 6
    assert store.existing_sessions().count() == 3


def test_loading_everything_again_doubles_nothing(spark, root):
    tree, store = root + "/tree", FeatureStore(spark, root + "/store")
    _write(tree, {_path(1): _tissue(1)})
    load_anatomical(store, tree, "A")
    store.publish()
    assert load_anatomical(store, tree, "A", again=True) == 1
    assert store.load_long("anatomical_gm").count() == 2


@pytest.mark.parametrize("published", [False, True])
def test_a_rewritten_file_replaces_its_rows(spark, root, published):
    tree, store = root + "/tree", FeatureStore(spark, root + "/store")
    _write(tree, {_path(1): _tissue(1), _path(2): _tissue(2)})
    load_anatomical(store, tree, "A")
    if published:
        store.publish()
    _write(tree, {_path(1): "label\tmean\nA\t10\nC\t30\n"})
    assert load_anatomical(store, tree, "A") == 1
    want = {("1", "A", 10.0), ("1", "C", 30.0), ("2", "A", 2.0), ("2", "B", 2.0)}
    for _ in range(2):
        rows = store.load_long("anatomical_gm").collect()
        assert {(r.subject_code, r.label, r["mean"]) for r in rows} == want and len(rows) == 4
        store.publish()


def test_sources_asked_for_later_and_odd_names(spark, root):
    tree, store = root + "/tree", FeatureStore(spark, root + "/store")
    odd = "sub-1/ses-0[1]/anat/atlas-A/x+y {z}_tissue-GM_parc.tsv"
    _write(tree, {odd: _tissue(1), _path(2): _tissue(2), _path(2, "WM"): _tissue(3)})
    assert load_anatomical(store, tree, "A", modalities=("gm",)) == 2
    assert load_anatomical(store, tree, "A", modalities=("gm", "wm")) == 1
    assert store.staged_sources() == ["anatomical_gm", "anatomical_wm"]
    assert store.load_long("anatomical_gm").count() == 4
    # In batches of one file each.
    other = FeatureStore(spark, root + "/other")
    assert load_anatomical(other, tree, "A", files_per_batch=1) == 3
    assert other.load_long("anatomical_gm").count() == 4


def test_files_without_rows_are_reported(spark, root):
    tree, store = root + "/tree", FeatureStore(spark, root + "/store")
    bad = {
        _path(2): "", _path(3): " \n\n", _path(4): "label\tmean\n", _path(5): "mean\tstd\n1\t2\n",
        _path(6): "label\tnote\nA\tx\n",
    }
    _write(tree, {_path(1): _tissue(1), _path(7): _tissue(7), **bad})
    registry = _registry(spark, *"1234568")
    load_anatomical(store, tree, "A", registry)
    assert {(r.subject_code, r.reason) for r in store.failed_files().collect()} == {
        ("3", "empty file"), ("4", "no rows"), ("5", "no region column"), ("6", "no statistic column"),
    }
    store.missing_report(registry, root + "/missing")
    report = spark.read.option("header", True).csv(root + "/missing")
    got = {(r.subject_code, r.reason) for r in report.collect()}
    # A file without a single byte is no file to Spark.
    assert {("8", "no data"), ("2", "no data")} < got and ("5", "no region column") in got and len(got) == 6
    # Nothing is tried again until the file changes.
    assert load_anatomical(store, tree, "A", registry) == 0
    _write(tree, {_path(5): _tissue(5)})
    assert load_anatomical(store, tree, "A", registry) == 1
    assert "5" not in {r.subject_code for r in store.failed_files().collect()}


def test_session_hook_failures_are_reported_and_lose_nothing(spark, root):
    tree, store = root + "/tree", FeatureStore(spark, root + "/store")
    _write(tree, {_path(i): _tissue(i) for i in range(1, 5)})
    seen = root + "/seen"
    os.makedirs(seen)

    def hook(subject, session, frame):
        if subject == "3":
            raise ValueError("not this one")
        with open(f"{seen}/{subject}-{session}-{len(frame)}", "w"):
            pass

    load_anatomical(store, tree, "A", on_session=hook)
    assert sorted(os.listdir(seen)) == ["1-01-2", "2-01-2", "4-01-2"]
    failures = store.hook_failures().collect()
    assert [(r.subject_code, r.error) for r in failures] == [("3", "ValueError: not this one")]
    assert store.load_long("anatomical_gm").count() == 8


def test_hooks_get_whole_sessions_without_a_grouping(spark):
    def hook(subject, session, frame):
        raise ValueError(f"{len(frame)} {frame['n'].dtype} {sorted(frame['mean'])}")

    rows = spark.createDataFrame(
        [(s, str(t), float(i), None if s == "2" and i == 0 else i) for s in ("1", "2", None) for t in range(3)
         for i in range(4)],
        "subject_code string, session_id string, mean double, n bigint",
    )
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        failed = session_hook(rows.coalesce(1), hook)
        got = {(r.subject_code, r.session_id): r.error for r in failed.collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    values = "[0.0, 1.0, 2.0, 3.0]"
    assert got == {
        (s, str(t)): f"ValueError: 4 {'float64' if s == '2' else 'int64'} {values}"
        for s in ("1", "2", None) for t in range(3)
    }
    assert "FlatMapGroups" not in failed._jdf.queryExecution().toString()


def _registry(spark, *subjects):
    rows = [(s, "01", s, "01") for s in subjects]
    return spark.createDataFrame(
        rows, "subject_code string, session_id string, subject_code_raw string, session_id_raw string"
    )


def test_late_registration_loads_files_seen_before(spark, root):
    tree, store = root + "/tree", FeatureStore(spark, root + "/store")
    _write(tree, {_path(1): _tissue(1), _path(2): _tissue(2)})
    load_anatomical(store, tree, "A", _registry(spark, "1"))
    assert store.load_long("anatomical_gm").count() == 2
    load_anatomical(store, tree, "A", _registry(spark, "1", "2"))
    assert {r.subject_code for r in store.load_long("anatomical_gm").collect()} == {"1", "2"}
    batches = store.staged().select("batch_id").distinct().count()
    load_anatomical(store, tree, "A", _registry(spark, "1", "2"))
    assert store.staged().select("batch_id").distinct().count() == batches


def test_incremental_load_equals_scan(spark, root):
    from parcelhouse.sources.region_files import scan_anatomical

    tree, store = root + "/tree", FeatureStore(spark, root + "/store")
    late = "sub-1/ses-01/anat/atlas-A/a_tissue-GM_parc.tsv"
    _write(tree, {_path(1): _tissue(1), _path(2): _tissue(2)})
    load_anatomical(store, tree, "A")
    store.publish()
    _write(tree, {late: "label\tmean\nA\t9\n"})
    load_anatomical(store, tree, "A")
    want = {(r.subject_code, r.label, r["mean"]) for r in scan_anatomical(spark, tree, "A").collect()}
    for _ in range(2):
        rows = store.load_long("anatomical_gm").collect()
        assert {(r.subject_code, r.label, r["mean"]) for r in rows} == want and len(rows) == 3
        store.publish()


def test_repeated_epoch_is_the_same_batch(spark, root):
    store = FeatureStore(spark, root)
    first = store.batch_of("c", 0)
    assert store.batch_of("c", 0) == first and store.batch_of("c", 1) > first
    other = store.batch_of("d", 0)
    store.forget("c")
    assert store.batch_of("c", 0) > other and store.batch_of("d", 0) == other
    for _ in range(2):
        store.write_batch(_rows(spark, ("1", "a", "x", 1.0, 1)).withColumn("source", F.lit("anatomical_gm")), first)
    assert store.staged().count() == 1


def test_old_versions_are_removed_on_demand(spark, root):
    store = FeatureStore(spark, root)
    for value in (1.0, 2.0, 3.0):
        store.save_anatomical_long(_rows(spark, ("1", "a", "x", value, 1)), "gm")
        store.publish()
    assert len([p for p in store.retain(1) if "/data/" in p]) == 2
    assert store.load_long("anatomical_gm").first()["mean"] == 3.0


def test_whole_load(spark, root):
    tree = root + "/tree"
    _write(
        root,
        {"r.csv": "subject_code,session_id,Age@Scan\n1,01,30\n2,01,\n5,01,9\n"},
    )
    _write(tree, {_path(1): _tissue(1), _path(1, "WM"): _tissue(4), _path(2): _tissue(2), _path(9): _tissue(9)})
    _write(
        tree,
        {
            "qsirecon-W/sub-1/ses-01/dwi/atlas-A/s_model-m_param-p_parc.tsv": "name\tmean\nA\t0.5\n",
            "sub-1/ses-01/anat/cat_sub-1_ses-01_T1w.xml": "<S><vol_TIV>1500</vol_TIV></S>",
        },
    )
    settings = LoadSettings(
        root + "/r.csv", root + "/store", tree, tree, tree, atlas="A", sources=("gm", "diffusion")
    )
    first = run_load(spark, settings)
    assert (first.n_sessions, first.n_pending, first.n_skipped) == (3, 3, 0)
    assert first.published == ["anatomical_gm", "diffusion_W"]
    assert first.features == ["W_m_p_mean", "gm_mean"]
    again = run_load(spark, settings)
    assert again.published == [] and again.n_pending == 2 and again.n_files == 0
    assert first.n_files == 3 and first.outcomes == again.outcomes == {"success": 2, "skipped": 1}
    store = FeatureStore(spark, root + "/store")
    got = {
        (r.subject_code, r.session_id, r["gm_mean__A"], r["W_m_p_mean__A"], r.AGE, r.tiv)
        for r in store.load_features(["gm_mean", "W_m_p_mean"], True, True).collect()
    }
    assert got == {("0001", "1", 1.0, 0.5, 30, 1500.0), ("0002", "1", 2.0, None, None, None)}
    # A forced run reads all files again; changed values win.
    _write(tree, {_path(1): _tissue(7)})
    settings.force = True
    run_load(spark, settings)
    table = store.load_feature("gm_mean", include_metadata=False)
    assert {(r.subject_code, r.A) for r in table.collect()} == {("0001", 7.0), ("0002", 2.0)}
    assert store.summary().first().n_sessions == 2


def test_old_contract_versions_and_scratch_are_removed(spark, root):
    from parcelhouse.plans.published import PublishedDataset
    from parcelhouse.plans.scratch import clear_scratch, materialize, scratch_root

    data = PublishedDataset(spark, root)
    for value in (1.0, 2.0):
        rows = spark.createDataFrame([("1_a", value)], "participant_id string, x double")
        data.write_features(rows, "anatomical", "gm", "mean")
    data.write_metadata(rows.drop("x"))
    assert len(data.retain(1)) == 1 and data.retain(1) == []
    assert data.get_features("anatomical", "gm", "mean").first().x == 2.0
    report, summary = data.validate(optional=("sex",))
    assert [r.rule for r in report.collect()] == ["missing optional column"]
    assert summary.first().asDict() == {
        "valid": True, "n_errors": 0, "n_warnings": 1, "n_subjects": 1,
        "n_anatomical_features": 1, "n_diffusion_features": 0,
    }
    made, kept = materialize(spark.range(3), "old"), materialize(spark.range(3), "new")
    folder = os.path.dirname(urllib.parse.urlparse(made.inputFiles()[0]).path)
    assert folder.startswith(scratch_root(spark))
    os.utime(folder, (0, 0))
    assert clear_scratch(spark, 100_000) == 1
    assert not os.path.exists(folder) and kept.count() == 3


def test_manifest_export(spark, root):
    store = FeatureStore(spark, root)
    store.save_anatomical_long(_rows(spark, ("1", "a", "x", 1.0, 1)), "gm")
    store.publish()
    store.generate_wide_features()
    store.catalog.export_manifest(root + "/manifest")
    assert {r["name"] for r in spark.read.json(root + "/manifest").collect()} == {"anatomical_gm", "gm_mean"}
    assert store.get_regions("gm_mean") == ["x"] and os.path.isdir(root + "/wide")


def test_published_datasets_share_one_join(spark, monkeypatch):
    from parcelhouse.workloads import stored

    calls, whole = [], stored.long_tissue
    monkeypatch.setattr(stored, "long_tissue", lambda *a: calls.append(a) or whole(*a))
    data = stored._published(spark, "/root/testdata/sf0.001")
    assert len(calls) == 1
    assert data.get_features("anatomical", "ct", "std").count() > 0


def test_wide_features_deal_rows_by_session_once(spark, root, monkeypatch):
    from parcelhouse.plans import store as stores

    written = []
    monkeypatch.setattr(stores, "materialize", lambda df, name: written.append(name) or df)
    store = FeatureStore(spark, root)
    store.save_anatomical_long(_rows(spark, ("1", "a", "x", 1.0, 1), ("1", "b", "y", 3.0, 2)), "gm")
    store.save_long(
        _rows(spark, ("1", "a", "x", 5.0, 1), ("1", "a", "x", 6.0, 2)).selectExpr(
            "*", "'m' || line_no as modality"), "anatomical_two")
    store.publish()
    store.generate_wide_features(modalities=["gm"])
    assert written == []
    got = {tuple(r) for r in store.load_feature("gm_mean", include_metadata=False).collect()}
    assert got == {("1", "a", 1.0, None), ("1", "b", None, 3.0)}
    # Two tissues in one source: the first row of a cell counts, and cells are reduced to it.
    store.generate_wide_features(modalities=["two"])
    assert written == ["wide-cells"]
    assert [tuple(r) for r in store.load_feature("two_mean", include_metadata=False).collect()] == [("1", "a", 5.0)]


def _diffusion_rows(spark, subjects=60):
    """Sessions of unlike regions and statistics, for four parameters, one of which has a single session."""
    rows = []
    for i in range(subjects):
        for param in ("FA", "MD", ""):
            for j, region in enumerate(["r.1", "r2", "r3"]):
                if (i + j) % 3:
                    mean = float(i + j) if i % 4 else None
                    rows.append((str(i), f"s{i % 2}", "dti", param, region, mean, i * 10 + j))
    rows.append(("0", "s0", "dti", "RD", "r3", None, 7))
    return spark.createDataFrame(rows, "subject_code string, session_id string, model string, param string, "
                                 "label string, mean double, voxel_count bigint").withColumn("desc", F.lit("d"))


def test_wide_rows_are_written_without_a_shuffle_of_wide_rows(spark, root, monkeypatch):
    plans, write = [], FeatureStore._write

    def noted(self, df, path, *args, **options):
        if "/wide/" in path and "/data/" in path:
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(self, df, path, *args, **options)

    monkeypatch.setattr(FeatureStore, "_write", noted)
    store = FeatureStore(spark, root)
    store.save_diffusion_long(_diffusion_rows(spark), "W")
    store.publish()
    store.generate_wide_features()
    # One shuffle, of narrow rows: the laying out comes above it, and only the ordering by file above that.
    (plan,) = plans
    lines = plan.splitlines()
    shuffles = [i for i, line in enumerate(lines) if "Repartition" in line or "Rebalance" in line]
    assert len(shuffles) == 1 and "Aggregate" not in plan
    assert any("MapInArrow" in line for line in lines[: shuffles[0]])


@pytest.mark.parametrize("wide_bytes, descs", [(1 << 28, "d"), (600, "d"), (600, "de")])
def test_wide_rows_of_all_sessions_however_they_are_dealt(spark, root, monkeypatch, wide_bytes, descs):
    from parcelhouse.plans import store as stores

    monkeypatch.setattr(stores, "WIDE_BYTES", wide_bytes)
    store = FeatureStore(spark, root, bucket_rows=100)
    rows = _diffusion_rows(spark)
    for desc in reversed(descs):
        store.save_diffusion_long(rows.withColumn("desc", F.lit(desc)), "W")
    store.publish()
    store.generate_wide_features()
    want = {}
    for r in rows.collect():
        for statistic in ("mean", "voxel_count"):
            if r[statistic] is not None:
                feature = want.setdefault(f"W_dti_{r.param}_{statistic}", {})
                feature.setdefault((r.subject_code, r.session_id), {})[r.label] = float(r[statistic])
    assert store.list_features() == sorted(want)
    for name, sessions in want.items():
        entry = store.get_feature_info(name)
        regions = sorted({r for cells in sessions.values() for r in cells})
        assert (entry.n_sessions, list(entry.regions), entry.n_regions) == (len(sessions), regions, len(regions))
        if "__" not in name:
            got = store.load_feature(name, include_metadata=False).collect()
            assert len(got) == len(sessions)
            for row in got:
                cells = sessions[(row.subject_code, row.session_id)]
                assert [row[r] for r in regions] == [cells.get(r) for r in regions]
    files = [f for f in _files(root, "wide") if "/data/" in f and "param=MD" in f and "voxel_count" in f]
    assert len(files) == 4 if wide_bytes > 1000 else len(files) > 4


def test_wide_features_forget_buckets_that_lost_their_values(spark, root):
    store = FeatureStore(spark, root, bucket_rows=2)
    store.save_anatomical_long(_rows(spark, *[(str(i), "a", "x", float(i), 1) for i in range(8)]), "gm")
    store.publish()
    store.generate_wide_features()
    assert store.get_feature_info("gm_mean").n_sessions == 8
    # All subjects of one bucket, which then has no cells at all.
    bucket = bucket_of(store.manifest("anatomical_gm")[0].n_buckets)
    rows = store.load_long("anatomical_gm").withColumn("bucket", bucket)
    lost = [r.subject_code for r in rows.collect() if r.bucket == rows.where("subject_code = '5'").first().bucket]
    assert len(lost) < 8
    store.save_anatomical_long(spark.createDataFrame([(s, "a", "x", None, 2) for s in lost], COLUMNS), "gm")
    store.publish()
    store.generate_wide_features()
    got = {r.subject_code for r in store.load_feature("gm_mean", include_metadata=False).collect()}
    assert got == {str(i) for i in range(8)} - {*lost}
    assert store.get_feature_info("gm_mean").n_sessions == len(got)
    assert store.load_long("anatomical_gm").count() == 8
