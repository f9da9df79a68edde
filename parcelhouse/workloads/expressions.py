"""Identifier and value expressions, projections and filters."""

from pyspark.sql import functions as F

from parcelhouse.functions import (
    adjusted_volume,
    bare_code,
    bids_entities,
    legacy_code,
    measured_value,
    needed_sources,
    numeric_or_null,
    pad_zeros,
    prefixed,
    session_id,
    strip_dataset_prefix,
    subject_code,
)
from parcelhouse.operators.answers import column_groups, numeric_features, text_features
from parcelhouse.operators.profile import find_columns, find_subjects
from parcelhouse.operators.sessions import (
    attach,
    of_cohort,
    session_covariates,
)
from parcelhouse.sources.tables import clean_questionnaire
from parcelhouse.workloads.bindings import (
    ANSWERS,
    CLEAN_ANSWERS,
    LONG_DIFFUSION,
    LONG_TISSUE,
    SESSIONS,
    answers,
    long_diffusion,
    long_tissue,
    sessions,
    table,
    with_,
)
from parcelhouse.workloads.registry import query

_RAW_SUBJECT = "concat_ws('/', substr(o_orderstatus, 1, 1), cast(o_custkey as string))"


@query(
    "e01_e02_ids",
    """
    SELECT o_orderkey,
           CASE WHEN length(s) < 4 THEN lpad(s, 4, '0') ELSE s END AS subject_code,
           CAST(CAST(trunc(TRY_CAST(r AS DOUBLE)) AS BIGINT) AS VARCHAR) AS session_id
    FROM (SELECT o_orderkey, translate(CAST(o_custkey AS VARCHAR), '/ -.', '____') AS s,
                 CASE o_orderstatus WHEN 'F' THEN '0' || CAST(o_orderkey AS VARCHAR)
                      WHEN 'O' THEN CAST(o_orderkey AS VARCHAR) || '.0' ELSE 'x' || o_orderkey
                 END AS r FROM orders)
    UNION ALL
    SELECT o_orderkey, translate(o_orderpriority || '/' || o_custkey || '.a b', '/ -.', '____'),
           NULL FROM orders
    """,
)
def ids(spark, sf):
    orders = table(spark, sf, "orders")
    key = F.col("o_orderkey").cast("string")
    raw = (
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("0"), key))
        .when(F.col("o_orderstatus") == "O", F.concat(key, F.lit(".0")))
        .otherwise(F.concat(F.lit("x"), key))
    )
    plain = orders.select(
        "o_orderkey",
        subject_code("o_custkey").alias("subject_code"),
        session_id(raw).alias("session_id"),
    )
    messy = F.concat("o_orderpriority", F.lit("/"), F.col("o_custkey").cast("string"), F.lit(".a b"))
    return plain.unionByName(
        orders.select(
            "o_orderkey",
            subject_code(messy).alias("subject_code"),
            session_id(F.lit(None).cast("string")).alias("session_id"),
        )
    )


@query(
    "e03_e04_codes",
    """
    SELECT c_custkey, replace(replace(c_name || '-' || c_mktsegment || '_ a', '-', ''), '_', '')
               .replace(' ', '') AS bare,
           replace(replace(replace(c_name || chr(9) || '-_' || chr(10), chr(9), ''), chr(10), ''),
                   '-_', '') AS legacy,
           CASE WHEN length(CAST(c_custkey AS VARCHAR)) < 9
                THEN lpad(CAST(c_custkey AS VARCHAR), 9, '0')
                ELSE CAST(c_custkey AS VARCHAR) END AS padded
    FROM customer
    """,
)
def codes(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey",
        bare_code(F.concat("c_name", F.lit("-"), "c_mktsegment", F.lit("_ a"))).alias("bare"),
        legacy_code(F.concat("c_name", F.lit("\t-_\n"))).alias("legacy"),
        pad_zeros(F.col("c_custkey").cast("string"), 9).alias("padded"),
    )


@query(
    "e05_entities",
    """
    SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS sub, CAST(o_orderkey AS VARCHAR) AS ses,
           o_orderstatus || '-' || o_orderpriority AS model, 'last' AS rep,
           CAST(NULL AS VARCHAR) AS param, 4 AS n_entities
    FROM orders
    """,
)
def entities(spark, sf):
    name = F.concat(
        F.lit("sub-"), F.col("o_custkey").cast("string"), F.lit("_ses-"),
        F.col("o_orderkey").cast("string"), F.lit("_rep-first_model-"), "o_orderstatus",
        F.lit("-"), "o_orderpriority", F.lit("_rep-last_parc.tsv"),
    )
    found = table(spark, sf, "orders").select("o_orderkey", bids_entities(name).alias("e"))
    return found.select(
        "o_orderkey", *[F.col("e")[k].alias(k) for k in ("sub", "ses", "model", "rep", "param")],
        F.size("e").alias("n_entities"),
    )


@query(
    "e06_numeric",
    """
    SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS value,
           CAST(NULL AS DOUBLE) AS suffixed FROM customer
    """,
)
def numeric(spark, sf):
    text = F.when(F.col("c_acctbal") < 0, "n/a").otherwise(
        F.concat(F.lit(" "), F.col("c_acctbal").cast("string"), F.lit(" "))
    )
    return table(spark, sf, "customer").select(
        "c_custkey",
        numeric_or_null(text).alias("value"),
        numeric_or_null(F.concat(F.col("c_custkey").cast("string"), F.lit("d"))).alias("suffixed"),
    )


@query(
    "e09_strip_prefix",
    """
    SELECT workflow, name, count(*) AS n
    FROM (SELECT l_returnflag AS workflow, l_linestatus || '_diffusion_' AS name FROM lineitem)
    GROUP BY ALL
    """,
)
def strip_prefix(spark, sf):
    named = table(spark, sf, "lineitem").select(
        strip_dataset_prefix(F.concat(F.lit("diffusion_"), "l_returnflag")).alias("workflow"),
        strip_dataset_prefix(
            F.concat(F.lit("anatomical_"), "l_linestatus", F.lit("_diffusion_"))
        ).alias("name"),
    )
    return named.groupBy("workflow", "name").agg(F.count("*").alias("n"))


@query(
    "e10_needed_sources",
    """
    SELECT o_orderkey,
           concat_ws(',', CASE WHEN o_orderstatus <> 'F' THEN 'gm' END,
                     CASE WHEN o_orderpriority <> '1-URGENT' THEN 'wm' END, 'ct') AS needed
    FROM orders
    """,
)
def needed(spark, sf):
    flags = {
        "gm": F.col("o_orderstatus") == "F",
        "wm": F.when(F.col("o_orderpriority") == "1-URGENT", True),
        "ct": None,
    }
    return table(spark, sf, "orders").select(
        "o_orderkey", F.array_join(needed_sources(flags), ",").alias("needed")
    )


@query(
    "e07_prefix",
    "SELECT s_suppkey, s_name AS gm_mean_s_name, s_acctbal AS gm_mean_s_acctbal FROM supplier",
)
def prefix(spark, sf):
    chosen = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    return prefixed(chosen, "gm_mean", keep=["s_suppkey"])


@query(
    "p01_modality",
    with_(l=LONG_TISSUE) + """
    SELECT subject_code, session_id, modality, label, volume_mm3 FROM l
    WHERE modality IN ('gm', 'ct')
    """,
)
def modality(spark, sf):
    return (
        long_tissue(spark, sf).where(F.col("modality").isin("gm", "ct"))
        .select("subject_code", "session_id", "modality", "label", "volume_mm3")
    )


@query(
    "p02_workflow",
    with_(l=LONG_DIFFUSION) + """
    SELECT workflow, model, param, count(*) AS n FROM l WHERE workflow IN ('A', 'N')
    GROUP BY ALL
    """,
)
def workflow(spark, sf):
    return (
        long_diffusion(spark, sf).where(F.col("workflow").isin("A", "N"))
        .groupBy("workflow", "model", "param").agg(F.count("*").alias("n"))
    )


@query(
    "p03_null_keep",
    with_(q=ANSWERS) + """
    SELECT "Subject Code", "Questionnaire" FROM q WHERE "Questionnaire" IS DISTINCT FROM 'No'
    """,
)
def null_keep(spark, sf):
    return answers(spark, sf).where(~F.col("Questionnaire").eqNullSafe("No")).select(
        "Subject Code", "Questionnaire"
    )


@query(
    "p05_non_null",
    with_(s=SESSIONS) + "SELECT subject_code, session_id, round(AGE, 6) AS age FROM s "
    "WHERE AGE IS NOT NULL",
)
def non_null(spark, sf):
    return sessions(spark, sf).dropna(subset=["AGE"]).select(
        "subject_code", "session_id", F.round("AGE", 6).alias("age")
    )


@query(
    "p07_covariates",
    with_(s=SESSIONS) + """
    SELECT DISTINCT subject_code, session_id, round(AGE, 6) AS "AGE", site, priority FROM s
    """,
)
def covariates(spark, sf):
    raw = sessions(spark, sf).withColumnRenamed("AGE", "Age@Scan").withColumns(
        {"gm_volume": F.lit(1.0), "mean": F.lit(2.0), "label": F.lit("x"), "DIPY_a": F.lit(1)}
    )
    doubled = raw.unionByName(raw)
    return session_covariates(doubled).withColumn("AGE", F.round("AGE", 6))


@query(
    "p08_cohort",
    with_(q=ANSWERS) + """
    SELECT "Subject Code", "Age" FROM q
    WHERE replace("Subject Code", '-', '') IN (SELECT 'C' || o_custkey FROM orders
                                               WHERE o_orderstatus = 'P')
    """,
)
def cohort(spark, sf):
    members = table(spark, sf, "orders").where("o_orderstatus = 'P'").select(
        F.concat(F.lit("C_ "), F.col("o_custkey").cast("string")).alias("subject_code")
    )
    return of_cohort(answers(spark, sf), members).select("Subject Code", "Age")


@query(
    "p11_j10_covariate_rows",
    with_(l=LONG_TISSUE, s=SESSIONS) + """
    SELECT l.subject_code, l.session_id, modality, label, volume_mm3, s.site, s.priority
    FROM l LEFT JOIN s ON l.subject_code = s.subject_code AND l.session_id = s.session_id
    """,
)
def covariate_rows(spark, sf):
    long = long_tissue(spark, sf).select(
        "subject_code", "session_id", "modality", "label", "volume_mm3"
    )
    registry = sessions(spark, sf).withColumns(
        {"_modalities": F.lit("gm"), "label": F.lit("other")}
    )
    return attach(long, registry).drop("AGE")


@query(
    "p12_value_select",
    with_(l=LONG_TISSUE) + """
    SELECT subject_code, session_id, modality, metric, label,
           CASE WHEN metric = 'volume' THEN volume_mm3 ELSE mean END AS value FROM l
    """,
)
def value_select(spark, sf):
    return long_tissue(spark, sf).select(
        "subject_code", "session_id", "modality", "metric", "label",
        measured_value().alias("value"),
    )


@query(
    "p13_tiv_norm",
    with_(l=LONG_TISSUE) + """
    SELECT subject_code, session_id, modality, label,
           CASE WHEN metric = 'volume' AND tiv <> 0 THEN round(volume_mm3 / tiv, 6) END
               AS volume_mm3_normalized FROM l
    """,
)
def tiv_norm(spark, sf):
    return long_tissue(spark, sf).select(
        "subject_code", "session_id", "modality", "label",
        F.round(adjusted_volume(), 6).alias("volume_mm3_normalized"),
    )


@query(
    "p14_p15_column_groups",
    with_(q=CLEAN_ANSWERS) + """
    SELECT "Subject Code", "PHQ9" AS mental_health__PHQ9, "Age" AS demographics__Age,
           "Education" AS socioeconomic__Education, "Salary" AS socioeconomic__Salary FROM q
    """,
)
def groups(spark, sf):
    df = clean_questionnaire(answers(spark, sf))
    features = set(numeric_features(df)) | set(text_features(df))
    chosen = [
        F.col(c).alias(f"{group}__{c}")
        for group, columns in column_groups(df.columns).items()
        for c in columns
        if c in features
    ]
    return df.select("Subject Code", *chosen)


@query(
    "p16_lookup",
    with_(q=CLEAN_ANSWERS) + """
    SELECT "Subject Code", "PHQ9" FROM q WHERE contains("Subject Code", 'C1')
    """,
)
def lookup(spark, sf):
    df = clean_questionnaire(answers(spark, sf))
    return find_subjects(df, "C-1").select("Subject Code", *find_columns(df, "phq"))
