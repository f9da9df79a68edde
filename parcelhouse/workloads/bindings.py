"""Views of the benchmark tables as measurement tables, in Spark and in SQL."""

from pyspark.sql import DataFrame, functions as F


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def long_events(spark, sf_dir) -> DataFrame:
    """Events as region measurements: real duplicates per key, ``event_id`` orders them."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("subject_code"),
        F.date_format("ts", "yyyyMMdd").alias("session_id"),
        F.col("event_type").alias("label"),
        F.col("value").alias("mean"),
        F.col("event_id").alias("seq"),
    )


LONG_EVENTS = """
SELECT CAST(user_id AS VARCHAR) AS subject_code, strftime(ts, '%Y%m%d') AS session_id,
       event_type AS label, value AS mean, event_id AS seq
FROM events
"""

MODALITY = {"A": "gm", "N": "wm", "R": "ct"}


def long_tissue(spark, sf_dir) -> DataFrame:
    """Line items as tissue measurements. No row id: all columns together order rows."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    flag = F.col("l_returnflag")
    modality = F.when(flag == "A", "gm").when(flag == "N", "wm").otherwise("ct")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").cast("string").alias("subject_code"),
        F.col("l_orderkey").cast("string").alias("session_id"),
        modality.alias("modality"),
        F.when(flag == "R", "thickness").otherwise("volume").alias("metric"),
        F.col("l_linenumber").cast("string").alias("label"),
        F.col("l_extendedprice").alias("volume_mm3"),
        F.col("l_quantity").alias("mean"),
        F.col("l_discount").alias("std"),
        F.col("o_totalprice").alias("tiv"),
        F.col("l_tax").alias("tax"),
        F.col("l_partkey").alias("partkey"),
        F.col("l_suppkey").alias("suppkey"),
        F.col("l_linestatus").alias("linestatus"),
        F.col("l_shipdate").alias("shipdate"),
    )


LONG_TISSUE = """
SELECT CAST(o_custkey AS VARCHAR) AS subject_code, CAST(l_orderkey AS VARCHAR) AS session_id,
       CASE l_returnflag WHEN 'A' THEN 'gm' WHEN 'N' THEN 'wm' ELSE 'ct' END AS modality,
       CASE l_returnflag WHEN 'R' THEN 'thickness' ELSE 'volume' END AS metric,
       CAST(l_linenumber AS VARCHAR) AS label, l_extendedprice AS volume_mm3,
       l_quantity AS mean, l_discount AS std, o_totalprice AS tiv, l_tax AS tax,
       l_partkey AS partkey, l_suppkey AS suppkey, l_linestatus AS linestatus,
       l_shipdate AS shipdate
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""
TISSUE_ORDER = (
    "volume_mm3", "partkey", "suppkey", "mean", "std", "tax", "linestatus", "shipdate",
)


def long_diffusion(spark, sf_dir) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_suppkey").cast("string").alias("subject_code"),
        F.col("l_orderkey").cast("string").alias("session_id"),
        F.col("l_returnflag").alias("workflow"),
        F.col("l_linestatus").alias("model"),
        F.col("p_type").alias("param"),
        F.col("p_brand").alias("label"),
        F.col("l_quantity").alias("mean"),
        F.col("l_discount").alias("std"),
        F.col("l_extendedprice").alias("volume_mm3"),
        F.col("l_linenumber").cast("bigint").alias("voxel_count"),
        F.col("l_tax").alias("tax"),
        F.col("l_partkey").alias("partkey"),
        F.col("l_shipdate").alias("shipdate"),
    )


LONG_DIFFUSION = """
SELECT CAST(l_suppkey AS VARCHAR) AS subject_code, CAST(l_orderkey AS VARCHAR) AS session_id,
       l_returnflag AS workflow, l_linestatus AS model, p_type AS param, p_brand AS label,
       l_quantity AS mean, l_discount AS std, l_extendedprice AS volume_mm3,
       CAST(l_linenumber AS BIGINT) AS voxel_count, l_tax AS tax, l_partkey AS partkey,
       l_shipdate AS shipdate
FROM lineitem JOIN part ON l_partkey = p_partkey
"""
DIFFUSION_ORDER = (
    "volume_mm3", "partkey", "mean", "std", "tax", "voxel_count", "shipdate",
)


def sessions(spark, sf_dir) -> DataFrame:
    """Orders as the session registry; age is unknown for one priority."""
    age = F.datediff(F.col("o_orderdate"), F.lit("1995-01-01").cast("date")) / F.lit(365.25)
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("subject_code"),
        F.col("o_orderkey").cast("string").alias("session_id"),
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", age).alias("AGE"),
        F.col("o_orderstatus").alias("site"),
        F.col("o_orderpriority").alias("priority"),
    )


SESSIONS = """
SELECT CAST(o_custkey AS VARCHAR) AS subject_code, CAST(o_orderkey AS VARCHAR) AS session_id,
       CASE WHEN o_orderpriority <> '4-NOT SPECIFIED'
            THEN date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) / 365.25 END AS AGE,
       o_orderstatus AS site, o_orderpriority AS priority
FROM orders
"""


def answers(spark, sf_dir) -> DataFrame:
    """Customers as questionnaire rows. The code has separators; some answers are missing."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.concat_ws("-", F.lit("C"), key.cast("string")).alias("Subject Code"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "No")
        .when(F.col("c_mktsegment") != "FURNITURE", "Yes").alias("Questionnaire"),
        F.when(F.col("c_acctbal") < 0, "n/a")
        .otherwise(F.floor(F.col("c_acctbal") / 300).cast("string")).alias("PHQ9"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("Age"),
        F.col("c_mktsegment").alias("Education"),
        F.col("c_nationkey").alias("Salary"),
        F.col("c_custkey").alias("UID"),
    )


ANSWERS = """
SELECT 'C-' || CAST(c_custkey AS VARCHAR) AS "Subject Code",
       CASE WHEN c_mktsegment = 'MACHINERY' THEN 'No'
            WHEN c_mktsegment <> 'FURNITURE' THEN 'Yes' END AS "Questionnaire",
       CASE WHEN c_acctbal < 0 THEN 'n/a'
            ELSE CAST(CAST(floor(c_acctbal / 300) AS BIGINT) AS VARCHAR) END AS "PHQ9",
       CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS "Age",
       c_mktsegment AS "Education", c_nationkey AS "Salary", c_custkey AS "UID"
FROM customer
"""
# The same after cleaning: plain codes, refusals dropped, PHQ9 a number.
CLEAN_ANSWERS = f"""
SELECT replace("Subject Code", '-', '') AS "Subject Code", "Questionnaire",
       TRY_CAST("PHQ9" AS DOUBLE) AS "PHQ9", "Age", "Education", "Salary", "UID"
FROM ({ANSWERS}) WHERE "Questionnaire" IS DISTINCT FROM 'No'
"""


def with_(**views) -> str:
    """A WITH clause."""
    return "WITH " + ", ".join(f"{name} AS ({sql})" for name, sql in views.items()) + " "
