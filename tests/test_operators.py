"""Operators against plain Python on small tables, and their ways for large groups."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from parcelhouse.operators import profile
from parcelhouse.operators.assemble import Feature, assemble_features
from parcelhouse.operators.latest import keep_last, keep_preferred, last_values, union_all
from parcelhouse.operators.quality import outlier_flags, session_quality, validation_report
from parcelhouse.operators import quantiles
from parcelhouse.operators.quantiles import exact_quantiles
from parcelhouse.operators.regions import region_statistics
from parcelhouse.operators.reshape import region_list, to_wide
from parcelhouse.operators.sessions import attach, full_outer, session_covariates
from parcelhouse.operators.spectral import band_amplitudes, strip_score


def _groups(seed, n):
    """Skewed: one group holds most rows; ties, a constant and a one-row group."""
    rng = random.Random(seed)
    rows = [("hot", rng.gauss(0, 100)) for _ in range(n)]
    rows += [("ties", float(rng.randrange(4))) for _ in range(n // 4)]
    rows += [("constant", 3.0)] * 50 + [("one", 1.5), ("null", None)]
    rows += [("wild", rng.choice([1e9, -1e9, 0.0, 1.0])) for _ in range(200)]
    return rows


@pytest.mark.parametrize("parts", [2, 60, 1 << 14])
def test_quantiles_are_exact_for_any_group_size(spark, monkeypatch, parts):
    monkeypatch.setattr(quantiles, "PARTS", parts)
    rng = random.Random(parts)
    rows = _groups(1, 20_000)
    for n in [*range(1, 130, 9), 999, 1000, 1001]:
        rows += [(f"n{n}", rng.gauss(0, 1)) for _ in range(n)]
    # Neighbouring doubles, all orders of magnitude, subnormal and signed zeros.
    rows += [("close", float(np.nextafter(1.0, 2.0)) if i % 3 else 1.0) for i in range(99)]
    rows += [("steps", 1.0 + i * 2.0**-52) for i in range(500)]
    rows += [("spread", rng.choice([-1, 1]) * 10.0 ** rng.uniform(-320, 300)) for _ in range(400)]
    rows += [("zeros", z) for z in (0.0, -0.0, 5e-324, -5e-324, 0.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    probs = [0.0, 0.01, 0.02, 0.1, 0.25, 0.5, 0.75, 0.9, 0.98, 1.0]
    got = {r.g: r for r in exact_quantiles(df, ["g"], "v", probs).collect()}
    table = pd.DataFrame(rows, columns=["g", "v"]).dropna()
    assert set(got) == set(table.g)
    for g, values in table.groupby("g").v:
        r = got[g]
        assert (r.n, r["min"], r["max"]) == (len(values), values.min(), values.max())
        assert np.allclose(r.quantiles, np.quantile(values, probs), rtol=1e-12, atol=1e-310 if g == "spread" else 1e-12)
        assert np.isclose(r["mean"], values.mean(), rtol=1e-9, atol=1e-9)
        if g != "spread" and len(values) > 1:
            assert np.isclose(r["std"], values.std(), rtol=1e-9, atol=1e-15)


def test_quantiles_of_infinities_and_nothing(spark):
    inf = float("inf")
    rows = [("a", inf), ("a", -inf), ("a", 1.0), ("b", float("nan")), ("b", 2.0), (None, 1.0), ("c", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r.quantiles for r in exact_quantiles(df, ["g"], "v", [0.5]).collect()}
    assert got["a"] == [1.0] and np.isnan(got["b"][0]) and set(got) == {"a", "b"}
    assert exact_quantiles(df.limit(0), ["g"], "v", [0.5]).count() == 0


def test_region_statistics_of_groups_of_all_sizes(spark):
    df = spark.createDataFrame(_groups(3, 3_000), "g string, value double").repartition(5)
    found = region_statistics(df, ["g"], voxel_volume=1.5).toPandas().set_index("g")
    rows = pd.DataFrame(_groups(3, 3_000), columns=["g", "v"]).dropna()
    for g, x in rows.groupby("g").v:
        x, hot = x.to_numpy(), found.loc[g]
        mad = np.median(np.abs(x - np.median(x)))
        robust = x[np.abs(x - np.median(x)) <= 3 * 1.4826 * mad] if mad else x
        q1, q3 = np.quantile(x, [0.25, 0.75])
        inside = x[(x >= q1 - 1.5 * (q3 - q1)) & (x <= q3 + 1.5 * (q3 - q1))]
        assert np.isclose(hot.mad_median, mad) and np.isclose(hot.robust_mean, robust.mean())
        assert np.isclose(hot.iqr_filtered_mean, inside.mean()) and hot.voxel_count == len(x)
        assert hot.volume_mm3 == 1.5 * len(x)
        if len(robust) > 1:
            assert np.isclose(hot.robust_std, robust.std(ddof=1))
    assert np.isclose(found.loc["constant"].robust_mean, 3.0) and found.loc["one"].mad_median == 0


def test_strip_score_matches_fft(spark):
    rng = np.random.default_rng(4)
    for n in (1, 2, 7, 64):
        profile_ = rng.normal(size=n)
        spectrum = 2.0 / n * np.abs(np.fft.fft(profile_)[: n // 2])
        freq = np.arange(n // 2) / n
        want = spectrum[(freq >= 0.25 - 0.05) & (freq <= 0.25 + 0.05)].sum()
        df = spark.createDataFrame([(1, profile_.tolist())], "i int, p array<double>")
        assert np.isclose(band_amplitudes(df, ["i"], "p").first().amplitude, want)
    gap = spark.createDataFrame([(1, [1.0, None] * 8)], "i int, p array<double>")
    assert band_amplitudes(gap, ["i"], "p").first().amplitude is None
    volume = rng.normal(size=(3, 4, 20))
    rows = [("s", int(z), float(volume[x, y, z])) for x in range(3) for y in range(4) for z in range(20)]
    means = volume.mean(axis=(0, 1))
    spectrum = 2.0 / 20 * np.abs(np.fft.fft(means)[:10])
    freq = np.arange(10) / 20
    want = spectrum[(freq >= 0.25 - 0.05) & (freq <= 0.25 + 0.05)].sum()
    got = strip_score(spark.createDataFrame(rows, "s string, z int, value double"), ["s"]).first()
    assert np.isclose(got.strip_score, want)


def test_keep_last_and_last_values(spark):
    rows = [("a", 1, 1.0), ("a", 3, None), ("a", 2, 2.0), ("b", 1, 5.0)]
    df = spark.createDataFrame(rows, "k string, s bigint, v double")
    assert {tuple(r) for r in keep_last(df, ["k"], ["s"]).collect()} == {
        ("a", 3, None), ("b", 1, 5.0),
    }
    assert {tuple(r) for r in last_values(df, ["k"], ["v"], "s").collect()} == {
        ("a", 2.0), ("b", 5.0),
    }


def test_keep_last_reduces_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id").alias("s"))
    plan = keep_last(df, ["k"], ["s"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.index("Partial"), "the limit must sit below the exchange"


def test_preferred_file_falls_through_to_one_with_a_number(spark):
    rows = [
        ("a", "x/best", None), ("a", "x/second", 2.0), ("a", "x/zz", 9.0),
        ("b", "x/other1", None), ("b", "x/other2", 5.0),
        ("c", "x/other1", 7.0), ("c", "x/other0", 8.0),
        ("d", "x/best", 1.0), ("d", "x/second", 2.0),
    ]
    df = spark.createDataFrame(rows, "k string, path string, v double")
    got = keep_preferred(df, ["k"], F.col("path"), ["best$", "second$"], F.col("v").isNotNull())
    # b: "any file" is tried once, and the first one has no number.
    assert {(r.k, r.v) for r in got.collect()} == {("a", 2.0), ("c", 8.0), ("d", 1.0)}


def test_wide_drops_empty_rows_and_columns_and_takes_the_first_value(spark):
    rows = [
        ("1", "a", "x.1", None, 1), ("1", "a", "x.1", 2.0, 2), ("1", "a", "x.1", 3.0, 3),
        ("1", "b", "y", None, 1), ("2", "a", "z", 4.0, 1), ("2", "a", None, 4.0, 1),
    ]
    df = spark.createDataFrame(
        rows, "subject_code string, session_id string, label string, mean double, seq bigint"
    )
    wide = to_wide(df, "label", "mean", order=["seq"])
    assert wide.columns == ["subject_code", "session_id", "x.1", "z"]
    assert {tuple(r) for r in wide.collect()} == {("1", "a", 2.0, None), ("2", "a", None, 4.0)}


def test_wide_needs_no_further_shuffle_for_the_pivot(spark):
    df = spark.range(100).selectExpr(
        "cast(id % 7 as string) subject_code", "cast(id % 3 as string) session_id", "cast(id % 5 as string) label",
        "cast(id as double) mean", "id seq",
    )
    wide = to_wide(df, "label", "mean", [str(i) for i in range(5)], ["seq"])
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2


@pytest.mark.parametrize("unique", [False, True])
def test_wide_holds_narrow_cells_only(spark, unique):
    """No aggregate has full-width rows, and sessions that begin in one batch and end in another stay whole."""
    rows = [(str(s), f"d{d}", f"r{r}", float(s * 100 + d * 10 + r) if (s + r) % 3 else None, 7 * r if r % 2 else None, r)
            for s in range(5) for d in range(3) for r in range(9) if (s * d + r) % 4]
    schema = "subject_code string, session_id string, label string, mean double, size bigint, seq bigint"
    df = spark.createDataFrame(rows, schema)
    names = [f"r{r}" for r in range(8)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2)
    try:
        wide = to_wide(df, "label", ["mean", "size"], names, ["seq"], unique=unique)
        got = {tuple(r) for r in wide.collect()}
        count = wide.count()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert wide.columns == ["subject_code", "session_id", *(f"{n}_{v}" for n in names for v in ("mean", "size"))]
    cells = {r[:3]: r[3:5] for r in rows}
    keys = {r[:2] for r in rows if r[3] is not None or r[4] is not None}
    assert got == {(*k, *(x for n in names for x in cells.get((*k, n), (None, None)))) for k in keys}
    assert count == len(got)
    single = to_wide(df, "label", "mean", names, ["seq"], unique=unique)
    assert "pivot" not in single._jdf.queryExecution().executedPlan().toString()


def test_region_names_that_differ_in_case_are_refused(spark):
    df = spark.createDataFrame([("LH_a",), ("lh_A",)], "label string")
    with pytest.raises(ValueError):
        region_list(df, "label")
    many = spark.range(10_500).selectExpr("cast(id as string) label")
    assert len(region_list(many, "label")) == 10_500


def test_features_with_equal_regions_keep_their_names(spark):
    rows = [("1", "a", m, "r", float(i)) for i, m in enumerate(["gm", "wm", "ct", "x"])]
    long = spark.createDataFrame(
        rows, "subject_code string, session_id string, modality string, label string, mean double"
    )
    features = [Feature(m, "mean", {"modality": m}) for m in ("gm", "wm", "ct", "x")]
    got = assemble_features(long, features).first().asDict()
    assert {k: v for k, v in got.items() if "__" in k} == {
        "gm__r": 0.0, "wm__r": 1.0, "ct__r": 2.0, "x__r": 3.0,
    }
    with pytest.raises(ValueError):
        assemble_features(long, [])


def test_attach_does_not_overwrite_or_leak(spark):
    long = spark.createDataFrame([("1", "a", 1.0)], "subject_code string, session_id string, x double")
    other = spark.createDataFrame(
        [("1", "a", 9.0, 7, 5)], "subject_code string, session_id string, x double, _h int, y int"
    )
    assert attach(long, other).first().asDict() == {
        "subject_code": "1", "session_id": "a", "x": 1.0, "y": 5,
    }


def test_age_is_always_called_age(spark):
    df = spark.createDataFrame(
        [("1", "a", 30.0, 1.0)], "subject_code string, session_id string, age double, gm_x double"
    )
    got = session_covariates(df)
    assert got.columns == ["subject_code", "session_id", "AGE"] and got.first().AGE == 30.0


def test_full_outer_keeps_all_keys(spark):
    a = spark.createDataFrame([("1", 1.0)], "id string, x double")
    b = spark.createDataFrame([("2", 2.0)], "id string, x double")
    got = {tuple(r) for r in full_outer({"a": a, "b": b}, ["id"]).collect()}
    assert got == {("1", 1.0, None), ("2", None, 2.0)}


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(5)
    for values in (rng.normal(size=500), np.array([2.0, 2.0])):
        df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
        got = [r.n for r in profile.histogram(df, "v", 10).orderBy("bin").collect()]
        assert got == np.histogram(values, 10)[0].tolist()


def test_correlation_is_pairwise_complete(spark):
    table = pd.DataFrame({"a": [1.0, 2, 3, 4], "b": [2.0, 1, None, 5], "c": [1.0, None, 2, 2]})
    df = spark.createDataFrame(table.astype(object).where(table.notna(), None), "a double, b double, c double")
    got = profile.correlation(df, ["a", "b", "c"]).toPandas().pivot(index="a", columns="b", values="r")
    assert np.allclose(got.to_numpy(float), table.corr().to_numpy())


def test_statistics_of_empty_columns(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, None)], "x double, y double")
    got = profile.cohort_statistics(df, ["x", "y"]).collect()
    assert [r.feature for r in got] == ["x"] and got[0].median == 2.0
    ages = profile.value_statistics(df, "y").first()
    assert (ages["min"], ages["mean"], ages.missing) == (None, None, 2)


def test_outliers_and_session_quality(spark):
    rows = [(str(i), "a", "r", "m", float(i % 7)) for i in range(60)]
    rows += [("hot", "a", "r", "m", 1e4), ("none", "a", "r", "m", None)]
    df = spark.createDataFrame(
        rows, "subject_code string, session_id string, label string, metric string, value double"
    )
    flags = {r.subject_code: (r.iqr_outlier, r.z_outlier) for r in outlier_flags(df).collect()}
    assert flags["hot"] == (True, True) and flags["none"] == (None, None)
    assert flags["5"] == (False, False) and len(flags) == 62
    passed = {r.subject_code: r.qc_pass for r in session_quality(df).collect()}
    assert passed["5"] and not passed["hot"] and not passed["none"]


def test_validation_report_finds_missing_columns(spark):
    meta = spark.createDataFrame([("1",)], "participant_id string")
    bad = spark.createDataFrame([(1,)], "id int")
    got = validation_report({"gm": bad}, meta, required=("age",)).collect()
    assert {(r.rule, r.dataset, r["sample"]) for r in got} == {
        ("missing column", "metadata", "age"), ("missing column", "gm", "participant_id"),
    }


def test_validation_looks_closer_where_ids_differ(spark):
    ids = lambda *values: spark.createDataFrame([(v,) for v in values], "participant_id string")
    meta = ids("1", "2", "3")
    tables = {
        "same": ids("3", "1", "2"), "short": ids("1", "2"), "twice": ids("1", "2", "3", "3"),
        "other": ids("1", "2", "4"), "null": ids("1", "2", "3", None),
    }
    got = {(r.severity, r.rule, r.dataset, r.n) for r in validation_report(tables, meta, optional=("sex",)).collect()}
    assert got == {
        ("warning", "missing optional column", "metadata", 1), ("warning", "id without features", "short", 1),
        ("error", "duplicate id", "twice", 1), ("error", "id without metadata", "other", 1),
        ("warning", "id without features", "other", 1), ("error", "null id", "null", 1),
    }
    # Metadata with faults of its own is no measure: every table is looked at.
    got = {(r.rule, r.dataset) for r in validation_report({"gm": ids("1", "1")}, ids("1", "1")).collect()}
    assert got == {("duplicate id", "metadata"), ("duplicate id", "gm")}
    assert validation_report({"gm": meta}, meta).count() == 0


def test_tables_side_by_side(spark):
    frames = {
        "a": spark.createDataFrame([("1", "x", 1.0), ("2", "x", None)], "subject_code string, session_id string, v double"),
        "b": spark.createDataFrame([("2", "x", "t"), ("3", "y", "u")], "subject_code string, session_id string, v string"),
        "c": spark.createDataFrame([("9", "z")], "subject_code string, session_id string"),
    }
    got = full_outer(frames)
    assert got.columns == ["subject_code", "session_id", "a_v", "b_v"]
    assert {tuple(r) for r in got.collect()} == {
        ("1", "x", 1.0, None), ("2", "x", None, "t"), ("3", "y", None, "u"), ("9", "z", None, None),
    }
    plan = full_outer(frames)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    with pytest.raises(Exception, match="table b has several rows"):
        full_outer({**frames, "b": frames["b"].union(frames["b"])}).collect()


def test_correlation_of_many_columns(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(1e6, 1, (300, 1)) + rng.normal(0, 1, (300, 60))
    frame = pd.DataFrame(base, columns=[f"r.{i}" for i in range(60)])
    frame = frame.mask(rng.random(frame.shape) < 0.2)
    frame["flat"], frame["none"] = 2.0, None
    frame["none"] = frame["none"].astype(float)
    df = spark.createDataFrame(frame.astype(object).where(frame.notna(), None).values.tolist(),
                               ", ".join(f"`{c}` double" for c in frame.columns)).repartition(5)
    got = {(r.a, r.b): r.r for r in profile.correlation(df, list(frame.columns)).collect()}
    want = frame.corr()
    assert len(got) == 62 * 62
    for (a, b), r in got.items():
        assert (r is None) if np.isnan(want.loc[a, b]) else np.isclose(r, want.loc[a, b], atol=1e-7)


def test_union_fills_missing_columns(spark):
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([("s",)], "y string")
    assert {tuple(r) for r in union_all([a, b]).collect()} == {(1, None), (None, "s")}
