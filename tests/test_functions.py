import pytest
from pyspark.sql import functions as F

from parcelhouse.functions import (
    adjusted_volume,
    bare_code,
    bids_entities,
    missing_to_null,
    numeric_or_null,
    pad_zeros,
    parse_feature_name,
    session_id,
    subject_code,
)
from parcelhouse.model import first_existing, region_column


def _map(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(fn("v")).collect()]


def test_subject_codes(spark):
    raw = ["7", "C-12/3", "a b.c", "12345", None]
    assert _map(spark, subject_code, raw) == ["0007", "C_12_3", "a_b_c", "12345", None]


def test_session_ids(spark):
    raw = ["01", "202303161349", "7.0", " 5 ", "1e3", "-2.9", "x1", "1d", "", "nan", None]
    assert _map(spark, session_id, raw) == [
        "1", "202303161349", "7", "5", "1000", "-2", None, None, None, None, None,
    ]


def test_padding_keeps_longer_codes(spark):
    assert _map(spark, lambda c: pad_zeros(c, 3), ["1", "1234"]) == ["001", "1234"]


def test_bare_code(spark):
    assert _map(spark, bare_code, ["00-48_R", "0048 R"]) == ["0048R", "0048R"]


def test_entities(spark):
    names = ["sub-1_ses-2_model-a_desc-x-y_model-b_parc.tsv", "plain.tsv"]
    got = _map(spark, bids_entities, names)
    assert got == [{"sub": "1", "ses": "2", "model": "b", "desc": "x-y"}, {}]


def test_numbers(spark):
    raw = ["1.5", " 2 ", "1d", "n/a", "1e-3", ".5", "5.", None]
    assert _map(spark, numeric_or_null, raw) == [1.5, 2.0, None, None, 0.001, 0.5, 5.0, None]


def test_missing_to_null(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b")], "`x.y` double, s string")
    assert [tuple(r) for r in missing_to_null(df).collect()] == [(1.0, "a"), (None, "b")]


def test_adjusted_volume_with_zero_total(spark):
    df = spark.createDataFrame(
        [("volume", 2.0, 4.0), ("volume", 2.0, 0.0), ("thickness", 2.0, 4.0)],
        "metric string, volume_mm3 double, tiv double",
    )
    assert [r[0] for r in df.select(adjusted_volume()).collect()] == [0.5, None, None]


def test_feature_names():
    assert parse_feature_name("gm_volume_mm3", "anatomical") == {
        "pipeline": None, "metric": "gm", "statistic": "volume_mm3",
    }
    assert parse_feature_name("DIPY_dki_fa_z_filtered_mean", "diffusion") == {
        "pipeline": "DIPY", "metric": "dki_fa", "statistic": "z_filtered_mean",
    }
    assert parse_feature_name("W_m_p_skew", "diffusion")["statistic"] == "skew"


def test_aliases():
    assert region_column(["index", "name"]) == "name"
    assert region_column(["index", "name"], "index") == "index"
    with pytest.raises(ValueError):
        first_existing(["a"], ["b"])
