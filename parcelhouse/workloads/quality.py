"""Outliers, valid shares, session quality and validation."""

from pyspark.sql import functions as F

from parcelhouse.operators.quality import (
    enough_valid,
    outlier_flags,
    session_quality,
    validation_report,
    validation_summary,
)
from parcelhouse.workloads.bindings import LONG_EVENTS, LONG_TISSUE, long_events, long_tissue, table, with_
from parcelhouse.workloads.registry import query

KEYS = ["subject_code", "session_id"]

# Limits of a 1.0 threshold, so that the uniform columns have outliers at all.
_FLAGGED = """
, m AS (SELECT label, metric, avg(v) AS mu, stddev_samp(v) AS sd, quantile_cont(v, 0.25) AS q1,
               quantile_cont(v, 0.75) AS q3 FROM t WHERE v IS NOT NULL GROUP BY ALL),
f AS (SELECT t.*, v < q1 - {k} * (q3 - q1) OR v > q3 + {k} * (q3 - q1) AS iqr_outlier,
             coalesce(abs(v - mu) / nullif(sd, 0) > {k}, false) AS z_outlier
      FROM t JOIN m ON t.label = m.label AND t.metric = m.metric)
"""
_VALUES = "SELECT subject_code, session_id, modality, label, metric, volume_mm3 AS v FROM l"


@query(
    "c06_outliers",
    with_(l=LONG_EVENTS, t="SELECT *, 'event' AS metric, mean AS v FROM l") + _FLAGGED.format(k="3.0")
    + "SELECT subject_code, session_id, label, seq, v AS value, iqr_outlier, z_outlier FROM f",
)
def outliers(spark, sf):
    rows = long_events(spark, sf).withColumnRenamed("mean", "value").withColumn(
        "metric", F.lit("event")
    )
    return outlier_flags(rows).drop("metric")


@query(
    "c07_min_valid",
    with_(l=LONG_TISSUE) + """
    , n AS (SELECT count(DISTINCT label) AS n FROM l),
    s AS (SELECT subject_code, session_id,
                 count(DISTINCT label) FILTER (WHERE std > 0) AS n_valid FROM l GROUP BY ALL)
    SELECT subject_code, session_id, n_valid, round(n_valid / n, 6) AS valid_share FROM s, n
    WHERE n_valid / n >= 0.8
    """,
)
def min_valid(spark, sf):
    rows = long_tissue(spark, sf).withColumn("value", F.when(F.col("std") > 0, F.col("std")))
    return enough_valid(rows).withColumn("valid_share", F.round("valid_share", 6))


@query(
    "c08_qc",
    with_(l=LONG_TISSUE, t=_VALUES) + _FLAGGED.format(k="1.0") + """
    , n AS (SELECT count(DISTINCT label) AS n FROM l),
    s AS (SELECT subject_code, session_id, count(DISTINCT label) AS n_valid,
                 count(*) FILTER (WHERE iqr_outlier OR z_outlier) AS n_outliers, count(*) AS c
          FROM f GROUP BY ALL)
    SELECT subject_code, session_id, n_valid, round(n_valid / n, 6) AS valid_share, n_outliers,
           round(n_outliers / c, 6) AS outlier_share,
           n_valid / n >= 0.4 AND n_outliers / c <= 0.3 AS qc_pass
    FROM s, n
    """,
)
def qc(spark, sf):
    rows = long_tissue(spark, sf).withColumnRenamed("volume_mm3", "value")
    found = session_quality(rows, threshold=1.0, minimum=0.4, maximum=0.3)
    return found.withColumns(
        {c: F.round(c, 6) for c in ("valid_share", "outlier_share")}
    )


_METADATA = "SELECT CAST(c_custkey AS VARCHAR) AS participant_id FROM customer WHERE c_acctbal > 0"
_WIDE = "SELECT DISTINCT subject_code AS participant_id FROM e"


def _tables(spark, sf):
    metadata = table(spark, sf, "customer").where("c_acctbal > 0").select(
        F.col("c_custkey").cast("string").alias("participant_id")
    )
    events = long_events(spark, sf).select(F.col("subject_code").alias("participant_id"))
    orders = table(spark, sf, "orders").select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey").cast("string")).alias(
            "participant_id"
        )
    )
    return {"events": events.distinct(), "orders": orders}, metadata


_REPORT = with_(
    e=LONG_EVENTS, m=_METADATA, w=_WIDE,
    o="SELECT CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS VARCHAR) END AS participant_id "
      "FROM orders",
    x="""
    SELECT 'error' AS severity, 'missing column' AS rule, 'metadata' AS dataset,
           1::BIGINT AS n, 'age' AS sample
    UNION ALL SELECT 'error', 'null id', 'orders', count(*), min(participant_id) FROM o
        WHERE participant_id IS NULL
    UNION ALL SELECT 'error', 'duplicate id', 'orders', count(*), min(participant_id) FROM
        (SELECT participant_id FROM o WHERE participant_id IS NOT NULL GROUP BY ALL
         HAVING count(*) > 1)
    UNION ALL SELECT 'error', 'id without metadata', 'events', count(*), min(participant_id) FROM w
        WHERE participant_id NOT IN (SELECT participant_id FROM m)
    UNION ALL SELECT 'error', 'id without metadata', 'orders', count(DISTINCT participant_id),
        min(participant_id) FROM o WHERE participant_id NOT IN (SELECT participant_id FROM m)
    UNION ALL SELECT 'warning', 'id without features', 'events', count(*), min(participant_id)
        FROM m WHERE participant_id NOT IN (SELECT participant_id FROM w)
    UNION ALL SELECT 'warning', 'id without features', 'orders', count(*), min(participant_id)
        FROM m WHERE participant_id NOT IN
        (SELECT participant_id FROM o WHERE participant_id IS NOT NULL)""",
)


@query("c05_validate", _REPORT + "SELECT * FROM x WHERE n > 0")
def validate(spark, sf):
    tables, metadata = _tables(spark, sf)
    return validation_report(tables, metadata, required=("age",))


@query(
    "c05_validation_summary",
    _REPORT + """
    SELECT count(*) FILTER (WHERE severity = 'error') = 0 AS valid,
           count(*) FILTER (WHERE severity = 'error') AS n_errors,
           count(*) FILTER (WHERE severity = 'warning') AS n_warnings FROM x WHERE n > 0
    """,
)
def validation(spark, sf):
    tables, metadata = _tables(spark, sf)
    return validation_summary(validation_report(tables, metadata, required=("age",)))
