"""Joins, set operations, sorts and keep-one rules."""

from pyspark.sql import functions as F

from parcelhouse.functions import bare_code
from parcelhouse.operators.assemble import Feature, assemble_features
from parcelhouse.operators.latest import keep_first, keep_last, keep_preferred, session_pairs, union_all
from parcelhouse.operators.profile import head
from parcelhouse.operators.reshape import region_list, to_wide
from parcelhouse.operators.sessions import (
    attach,
    attach_regions,
    full_outer,
    loaded_with_age,
    match_audit,
    missing_sessions,
    only_sessions,
    pending_sessions,
    with_loaded_flags,
    with_questionnaire,
    without_sessions,
)
from parcelhouse.sources.tables import clean_questionnaire
from parcelhouse.workloads.bindings import (
    CLEAN_ANSWERS,
    LONG_EVENTS,
    LONG_TISSUE,
    SESSIONS,
    TISSUE_ORDER,
    answers,
    long_events,
    long_tissue,
    sessions,
    table,
    with_,
)
from parcelhouse.workloads.registry import query

KEYS = ["subject_code", "session_id"]
EVENT_KEYS = [*KEYS, "label"]
# The ledger analog: finished orders have all tissues, open ones only gm.
_LEDGER = """
SELECT CAST(o_custkey AS VARCHAR) AS subject_code, CAST(o_orderkey AS VARCHAR) AS session_id,
       s.source FROM orders, (VALUES ('gm'), ('wm'), ('ct')) AS s(source)
WHERE o_orderstatus = 'F' OR (o_orderstatus = 'O' AND s.source = 'gm')
"""


def ledger(spark, sf):
    loaded = F.when(
        F.col("o_orderstatus") == "F", F.array(F.lit("gm"), F.lit("wm"), F.lit("ct"))
    ).when(F.col("o_orderstatus") == "O", F.array(F.lit("gm")))
    return table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("subject_code"),
        F.col("o_orderkey").cast("string").alias("session_id"),
        F.explode(loaded).alias("source"),
    )


_WIDE_LI = """
SELECT subject_code, session_id, """ + ", ".join(
    f"max(volume_mm3) FILTER (WHERE label = '{n}' AND modality = 'gm') AS \"{n}\"" for n in range(1, 8)
) + """ FROM l WHERE modality = 'gm' AND volume_mm3 IS NOT NULL GROUP BY ALL
"""


def wide_gm(spark, sf):
    """Wide gm volumes; the largest value of a cell counts."""
    gm = long_tissue(spark, sf).where("modality = 'gm'").withColumn("_o", -F.col("volume_mm3"))
    return to_wide(gm, "label", "volume_mm3", order=["_o"])


@query(
    "j01_meta",
    with_(l=LONG_TISSUE, w=_WIDE_LI, s=SESSIONS) + """
    SELECT w.*, round(s.AGE, 6) AS "AGE", site, priority
    FROM w LEFT JOIN s ON w.subject_code = s.subject_code AND w.session_id = s.session_id
    """,
)
def meta(spark, sf):
    joined = attach(wide_gm(spark, sf), sessions(spark, sf))
    return joined.withColumn("AGE", F.round("AGE", 6))


@query(
    "j02_tiv",
    with_(l=LONG_TISSUE, w=_WIDE_LI) + """
    SELECT w.*, t.tiv FROM w LEFT JOIN
    (SELECT CAST(o_custkey AS VARCHAR) AS c, CAST(o_orderkey AS VARCHAR) AS s,
            o_totalprice AS tiv FROM orders WHERE o_orderstatus <> 'P') t
    ON w.subject_code = t.c AND w.session_id = t.s
    """,
)
def tiv(spark, sf):
    totals = table(spark, sf, "orders").where("o_orderstatus <> 'P'").select(
        F.col("o_custkey").cast("string").alias("subject_code"),
        F.col("o_orderkey").cast("string").alias("session_id"),
        F.col("o_totalprice").alias("tiv"),
    )
    return attach(wide_gm(spark, sf), totals)


_FEATURES = {
    "gm_volume_mm3": ("volume_mm3", "gm"), "wm_volume_mm3": ("volume_mm3", "wm"),
    "ct_mean": ("mean", "ct"),
}


@query(
    "j03_multi_feature",
    with_(l=LONG_TISSUE) + "SELECT subject_code, session_id, " + ", ".join(
        f"max({s}) FILTER (WHERE label = '{n}' AND modality = '{m}') AS \"{f}__{n}\""
        for f, (s, m) in _FEATURES.items()
        for n in range(1, 8)
    ) + " FROM l GROUP BY ALL",
)
def multi_feature(spark, sf):
    features = [Feature(f, s, {"modality": m}) for f, (s, m) in _FEATURES.items()]
    long = long_tissue(spark, sf).withColumn(
        "_o", F.when(F.col("modality") == "ct", -F.col("mean")).otherwise(-F.col("volume_mm3"))
    )
    # The published region list of each feature: one small scan of the region column.
    regions = region_list(
        table(spark, sf, "lineitem").select(F.col("l_linenumber").cast("string").alias("label")),
        "label",
    )
    return assemble_features(long, features, {f.name: regions for f in features}, ["_o"])


@query(
    "j04_pending",
    with_(s=SESSIONS, d=_LEDGER) + """
    SELECT s.subject_code, s.session_id, site,
           CASE WHEN site = 'O' THEN 'ct,wm' ELSE 'ct,gm,wm' END AS sources_to_load
    FROM s WHERE site <> 'F'
    """,
)
def pending(spark, sf):
    found = pending_sessions(sessions(spark, sf), ledger(spark, sf), ("gm", "wm", "ct"))
    return found.select(
        *KEYS, "site", F.array_join("sources_to_load", ",").alias("sources_to_load")
    )


@query(
    "j05_questionnaire",
    with_(q=CLEAN_ANSWERS, s=SESSIONS) + """
    SELECT 'C' || s.subject_code AS subject_code, s.session_id, q."Subject Code", q."PHQ9",
           q."Questionnaire"
    FROM s LEFT JOIN q ON 'C' || s.subject_code = q."Subject Code"
    """,
)
def questionnaire(spark, sf):
    return _sessions_with_answers(spark, sf).select(
        *KEYS, "Subject Code", "PHQ9", "Questionnaire"
    )


def _sessions_with_answers(spark, sf):
    coded = sessions(spark, sf).withColumn("subject_code", F.concat(F.lit("C_"), "subject_code"))
    return with_questionnaire(coded, clean_questionnaire(answers(spark, sf)))


@query(
    "j06_loaded_age",
    with_(l=LONG_TISSUE, s=SESSIONS) + """
    SELECT p.subject_code, p.session_id, round(s.AGE, 6) AS "AGE"
    FROM (SELECT DISTINCT subject_code, session_id FROM l) p
    LEFT JOIN s ON p.subject_code = s.subject_code AND p.session_id = s.session_id
    """,
)
def loaded_age(spark, sf):
    registry = sessions(spark, sf).withColumnRenamed("AGE", "Age")
    return loaded_with_age(session_pairs(long_tissue(spark, sf)), registry).withColumn(
        "AGE", F.round("AGE", 6)
    )


@query(
    "j07_anti",
    with_(l=LONG_TISSUE, s=SESSIONS) + """
    SELECT subject_code, session_id FROM s WHERE NOT EXISTS (SELECT 1 FROM l WHERE
    l.subject_code = s.subject_code AND l.session_id = s.session_id AND l.modality = 'gm')
    """,
)
def anti(spark, sf):
    gm = long_tissue(spark, sf).where("modality = 'gm'")
    return without_sessions(sessions(spark, sf).select(*KEYS), gm)


@query(
    "j08_semi",
    with_(l=LONG_TISSUE, s=SESSIONS) + """
    SELECT subject_code, session_id, modality, label, volume_mm3 FROM l
    WHERE EXISTS (SELECT 1 FROM s WHERE s.subject_code = l.subject_code
                  AND s.session_id = l.session_id AND s.priority = '1-URGENT')
    """,
)
def semi(spark, sf):
    urgent = sessions(spark, sf).where("priority = '1-URGENT'")
    return only_sessions(long_tissue(spark, sf), urgent).select(
        *KEYS, "modality", "label", "volume_mm3"
    )


_EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


@query(
    "j09_concat",
    with_(
        e=LONG_EVENTS,
        n="SELECT subject_code, session_id, label, max(mean) AS top, min(mean) AS low, count(*) AS n "
          "FROM e GROUP BY ALL",
    ) + "SELECT subject_code, session_id, " + ", ".join(
        f"max({v}) FILTER (WHERE label = '{t}') AS {t}_{v}" for t in _EVENT_TYPES for v in ("top", "low", "n")
    ) + " FROM n GROUP BY ALL",
)
def concat(spark, sf):
    """One table for each event type, side by side."""
    summed = long_events(spark, sf).groupBy(*KEYS, "label").agg(
        F.max("mean").alias("top"), F.min("mean").alias("low"), F.count("*").alias("n")
    )
    return full_outer({t: summed.where(F.col("label") == t).drop("label") for t in _EVENT_TYPES})


@query(
    "j11_ledger",
    with_(s=SESSIONS, d=_LEDGER) + """
    SELECT s.subject_code, s.session_id, site,
           coalesce(bool_or(d.source = 'gm'), false) AS anatomical_gm_loaded,
           coalesce(bool_or(d.source = 'wm'), false) AS anatomical_wm_loaded,
           coalesce(bool_or(d.source = 'ct'), false) AS anatomical_ct_loaded,
           coalesce(bool_or(d.source = 'diffusion'), false) AS diffusion_loaded
    FROM s LEFT JOIN d ON s.subject_code = d.subject_code AND s.session_id = d.session_id
    GROUP BY ALL
    """,
)
def flags(spark, sf):
    return with_loaded_flags(sessions(spark, sf).select(*KEYS, "site"), ledger(spark, sf))


@query(
    "j12_match_audit",
    with_(q=CLEAN_ANSWERS, s=SESSIONS) + """
    SELECT count(*) FILTER (WHERE q."Subject Code" IS NOT NULL) AS n_matched,
           count(*) FILTER (WHERE q."Subject Code" IS NULL) AS n_unmatched
    FROM s LEFT JOIN q ON 'C' || s.subject_code = q."Subject Code"
    """,
)
def audit(spark, sf):
    joined = _sessions_with_answers(spark, sf)
    return match_audit(joined, F.col("Subject Code").isNotNull())


@query(
    "j12_unmatched",
    with_(q=CLEAN_ANSWERS, s=SESSIONS) + """
    SELECT 'C' || s.subject_code AS subject_code, s.session_id FROM s
    WHERE 'C' || s.subject_code NOT IN (SELECT "Subject Code" FROM q)
    ORDER BY 1, 2 LIMIT 20
    """,
)
def unmatched(spark, sf):
    joined = _sessions_with_answers(spark, sf).where(F.col("Subject Code").isNull())
    return head(joined.select(*KEYS), KEYS, 20)


@query(
    "s12_j13_region_dim",
    """
    SELECT CAST(s_suppkey AS VARCHAR) AS subject_code, n_name AS label, r_name AS network_label,
           s_acctbal AS mean
    FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey
    """,
)
def region_dim(spark, sf):
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    lookup = nation.join(region, nation.n_regionkey == region.r_regionkey, "left").select(
        F.col("n_nationkey").alias("index"), F.col("n_name").alias("label"),
        F.col("r_name").alias("network_label"),
    )
    long = table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("subject_code"),
        F.col("s_nationkey").alias("index"), F.col("s_acctbal").alias("mean"),
    )
    return attach_regions(long, lookup, "index").drop("index")


@query(
    "w01_keep_last",
    with_(l=LONG_TISSUE) + """
    SELECT * EXCLUDE (rn, shipdate), strftime(shipdate, '%Y-%m-%d') AS shipdate FROM (
        SELECT *, row_number() OVER (PARTITION BY subject_code, session_id, modality, label
            ORDER BY """ + ", ".join(f"{c} DESC" for c in TISSUE_ORDER) + """) AS rn FROM l)
    WHERE rn = 1
    """,
)
def last(spark, sf):
    kept = keep_last(long_tissue(spark, sf), [*KEYS, "modality", "label"], TISSUE_ORDER)
    return kept.withColumn("shipdate", F.date_format("shipdate", "yyyy-MM-dd"))


@query(
    "w01_keep_last_events",
    with_(e=LONG_EVENTS) + """
    SELECT subject_code, session_id, label, arg_max(mean, seq) AS mean, max(seq) AS seq
    FROM e GROUP BY ALL
    """,
)
def last_events(spark, sf):
    return keep_last(long_events(spark, sf), EVENT_KEYS, ["seq"])


@query(
    "w02_preferred",
    """
    SELECT subject_code, arg_min(tiv, rank) AS tiv FROM (
        SELECT CAST(o_custkey AS VARCHAR) AS subject_code,
               CASE WHEN o_orderstatus <> 'O' THEN o_totalprice END AS tiv,
               {'p': CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 ELSE 2 END,
                'k': lpad(CAST(o_orderkey AS VARCHAR), 12, '0')} AS rank,
               row_number() OVER (PARTITION BY o_custkey
                   ORDER BY o_orderkey) = 1 AS is_first
        FROM orders)
    WHERE tiv IS NOT NULL AND (rank.p < 2 OR is_first) GROUP BY subject_code
    """,
)
def preferred(spark, sf):
    reports = table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("subject_code"),
        F.when(F.col("o_orderstatus") != "O", F.col("o_totalprice")).alias("tiv"),
        F.concat_ws(
            "/", F.lpad(F.col("o_orderkey").cast("string"), 12, "0"), "o_orderpriority"
        ).alias("path"),
    )
    best = keep_preferred(
        reports, ["subject_code"], F.col("path"), ("/1-URGENT$", "/2-HIGH$"),
        F.col("tiv").isNotNull(),
    )
    return best.select("subject_code", "tiv")


@query(
    "w02_first_file",
    """
    SELECT CAST(l_suppkey AS VARCHAR) AS subject_code, l_returnflag AS tissue,
           min(lpad(CAST(l_orderkey AS VARCHAR), 12, '0') || '_' || l_linenumber
               || '_' || l_partkey) AS path
    FROM lineitem GROUP BY ALL
    """,
)
def first_file(spark, sf):
    files = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("subject_code"),
        F.col("l_returnflag").alias("tissue"),
        F.concat_ws(
            "_", F.lpad(F.col("l_orderkey").cast("string"), 12, "0"),
            F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string"),
        ).alias("path"),
    )
    return keep_first(files, ["subject_code", "tissue"], ["path"])


@query(
    "u01_union",
    """
    SELECT CAST(c_custkey AS VARCHAR) AS subject_code, c_acctbal AS mean, c_mktsegment AS site,
           CAST(NULL AS VARCHAR) AS label FROM customer
    UNION ALL
    SELECT CAST(s_suppkey AS VARCHAR), s_acctbal, NULL, s_name FROM supplier
    """,
)
def union(spark, sf):
    first = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("subject_code"),
        F.col("c_acctbal").alias("mean"), F.col("c_mktsegment").alias("site"),
    )
    second = table(spark, sf, "supplier").select(
        F.col("s_name").alias("label"), F.col("s_suppkey").cast("string").alias("subject_code"),
        F.col("s_acctbal").alias("mean"),
    )
    return union_all([first, second])


@query(
    "u02_pairs",
    with_(l=LONG_TISSUE, s=SESSIONS) + """
    SELECT subject_code, session_id FROM l UNION SELECT subject_code, session_id FROM s
    """,
)
def pairs(spark, sf):
    return session_pairs(long_tissue(spark, sf), sessions(spark, sf))


@query(
    "u03_distinct",
    with_(l=LONG_TISSUE) + "SELECT DISTINCT subject_code, session_id, tiv FROM l",
)
def distinct(spark, sf):
    return long_tissue(spark, sf).select(*KEYS, "tiv").distinct()


@query(
    "u04_skipped",
    with_(s=SESSIONS) + "SELECT count(*) AS n_skipped FROM s WHERE site = 'F'",
)
def skipped(spark, sf):
    registry = sessions(spark, sf).select(*KEYS)
    open_ = pending_sessions(registry, ledger(spark, sf), ("gm", "wm", "ct"))
    return without_sessions(registry, open_).agg(F.count("*").alias("n_skipped"))


@query(
    "o01_sorted_registry",
    with_(s=SESSIONS) + "SELECT subject_code, session_id, site FROM s ORDER BY 1, 2",
)
def sorted_registry(spark, sf):
    return sessions(spark, sf).select(*KEYS, "site").orderBy(*KEYS)


@query(
    "o02_topk",
    with_(l=LONG_TISSUE) + """
    SELECT subject_code, session_id, count(*) AS n FROM l GROUP BY ALL
    ORDER BY n DESC, subject_code, session_id LIMIT 50
    """,
)
def topk(spark, sf):
    counts = long_tissue(spark, sf).groupBy(*KEYS).agg(F.count("*").alias("n"))
    return head(counts, [F.col("n").desc(), *KEYS], 50)


@query(
    "k07_missing_report",
    with_(l=LONG_TISSUE, s=SESSIONS) + """
    SELECT subject_code, session_id, 'no data' AS reason FROM s WHERE NOT EXISTS
    (SELECT 1 FROM l WHERE l.subject_code = s.subject_code AND l.session_id = s.session_id)
    """,
)
def missing_report(spark, sf):
    return missing_sessions(sessions(spark, sf), long_tissue(spark, sf))
