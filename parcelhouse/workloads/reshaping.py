"""Long to wide and back."""

from pyspark.sql import functions as F

from parcelhouse.operators.answers import participant_summaries
from parcelhouse.operators.latest import keep_last
from parcelhouse.operators.reshape import (
    combined_anatomical,
    combined_diffusion,
    flatten_quality_record,
    to_tidy,
    to_value_map,
    to_wide,
)
from parcelhouse.operators.sessions import attach
from parcelhouse.sources.tables import clean_questionnaire
from parcelhouse.workloads.bindings import (
    CLEAN_ANSWERS,
    DIFFUSION_ORDER,
    LONG_DIFFUSION,
    LONG_EVENTS,
    LONG_TISSUE,
    TISSUE_ORDER,
    answers,
    long_diffusion,
    long_events,
    long_tissue,
    table,
    with_,
)
from parcelhouse.workloads.registry import query

KEYS = ["subject_code", "session_id"]
_EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
_BRANDS = [f"Brand#{n}" for n in range(1, 26)]
_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


def _rank(order):
    return "{" + ", ".join(f"'{c}': {c}" for c in order) + "}"


def _pivot_sql(column, value, names, order, index="subject_code, session_id"):
    cells = (
        f"SELECT {index}, {column} AS _c, arg_min({value}, {order}) AS _v FROM l "
        f"WHERE {value} IS NOT NULL GROUP BY ALL"
    )
    return f"SELECT {index}, " + ", ".join(
        f"max(_v) FILTER (WHERE _c = '{n}') AS \"{n}\"" for n in names
    ) + f" FROM ({cells}) GROUP BY ALL"


@query(
    "r01_wide",
    with_(
        l=LONG_EVENTS,
        c="SELECT CAST(c_custkey AS VARCHAR) AS subject_code, c_mktsegment AS site FROM customer",
    ) + "SELECT l.subject_code, session_id, site, " + ", ".join(
        f"arg_max(mean, seq) FILTER (WHERE label = '{e}') AS {e}" for e in _EVENT_TYPES
    ) + " FROM l LEFT JOIN c ON l.subject_code = c.subject_code GROUP BY ALL",
)
def wide(spark, sf):
    newest = keep_last(long_events(spark, sf), [*KEYS, "label"], ["seq"])
    covariates = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("subject_code"), F.col("c_mktsegment").alias("site")
    )
    return attach(to_wide(newest, "label", "mean", order=["seq"]), covariates, ["subject_code"])


@query(
    "r02_wide_multi",
    with_(l=LONG_DIFFUSION) + "SELECT subject_code, session_id, workflow, model, param, "
    + ", ".join(
        f"arg_min({v}, {_rank(DIFFUSION_ORDER)}) FILTER (WHERE label = '{b}') AS \"{b}_{v}\""
        for b in _BRANDS for v in ("mean", "volume_mm3")
    ) + " FROM l GROUP BY ALL",
)
def wide_multi(spark, sf):
    return to_wide(
        long_diffusion(spark, sf), "label", ["mean", "volume_mm3"], order=DIFFUSION_ORDER,
        index=[*KEYS, "workflow", "model", "param"],
    )


@query(
    "r01_value_map",
    with_(l=LONG_EVENTS) + """
    SELECT subject_code, session_id, count(*) AS n_regions, round(sum(mean), 4) AS total,
           string_agg(label || '=' || CAST(mean AS VARCHAR), ';' ORDER BY label) AS cells
    FROM (SELECT subject_code, session_id, label, arg_max(mean, seq) AS mean FROM l GROUP BY ALL)
    GROUP BY ALL
    """,
)
def value_map(spark, sf):
    newest = keep_last(long_events(spark, sf), [*KEYS, "label"], ["seq"])
    cells = F.array_sort(F.map_entries("values"))
    return to_value_map(newest, "label", "mean", ["seq"]).select(
        *KEYS,
        F.size("values").cast("bigint").alias("n_regions"),
        F.round(F.aggregate(F.map_values("values"), F.lit(0.0), lambda a, b: a + b), 4).alias("total"),
        F.array_join(
            F.transform(cells, lambda c: F.concat(c["key"], F.lit("="), c["value"].cast("string"))),
            ";",
        ).alias("cells"),
    )


@query(
    "r03_combined",
    with_(
        l=f"SELECT *, modality || '_' || metric || '_' || label AS f, CASE WHEN metric = 'volume' "
        f"THEN volume_mm3 ELSE mean END AS v FROM ({LONG_TISSUE})"
    ) + _pivot_sql(
        "f", "v",
        [f"{m}_{t}_{n}" for m, t in (("gm", "volume"), ("wm", "volume"), ("ct", "thickness"))
         for n in range(1, 8)],
        _rank(TISSUE_ORDER),
    ),
)
def combined(spark, sf):
    return combined_anatomical(long_tissue(spark, sf), order=TISSUE_ORDER)


_BY_YEAR = "SELECT * REPLACE (CAST(year(shipdate) AS VARCHAR) AS session_id) FROM (" + LONG_DIFFUSION + ")"


@query(
    "r04_combined",
    with_(
        l=f"SELECT *, workflow || '_' || model || '_' || param || '_' || label AS f FROM ({_BY_YEAR})"
    ) + _pivot_sql(
        "f", "mean",
        [f"{w}_{m}_{p}_{b}" for w in "ANR" for m in "FO" for p in _TYPES for b in _BRANDS],
        _rank(DIFFUSION_ORDER),
    ),
)
def combined_diff(spark, sf):
    """All workflows, models, parameters and regions; a session is a supplier's year."""
    rows = long_diffusion(spark, sf).withColumn("session_id", F.year("shipdate").cast("string"))
    return combined_diffusion(rows.withColumnRenamed("label", "name"), order=DIFFUSION_ORDER)


@query(
    "r04_combined_sessions",
    with_(
        l=f"SELECT *, workflow || '_' || model || '_' || param || '_' || linenumber AS f "
        f"FROM (SELECT *, CAST(voxel_count AS VARCHAR) AS linenumber FROM ({LONG_DIFFUSION}))"
    ) + _pivot_sql(
        "f", "mean",
        [f"{w}_{m}_{p}_{b}" for w in "ANR" for m in "FO" for p in _TYPES for b in range(1, 8)],
        _rank(DIFFUSION_ORDER),
    ),
)
def combined_sessions(spark, sf):
    """All workflows and all sessions; regions are the line numbers."""
    rows = long_diffusion(spark, sf).withColumn("name", F.col("voxel_count").cast("string"))
    return combined_diffusion(rows, order=DIFFUSION_ORDER)


@query(
    "r05_tidy",
    with_(l=LONG_EVENTS) + """
    , d AS (SELECT subject_code || '_' || session_id AS participant_id, label,
              arg_max(mean, seq) AS mean FROM l GROUP BY ALL)
    SELECT p.participant_id, t.label AS parcel, 'event' AS metric, d.mean AS value,
           'mean' AS statistic
    FROM (SELECT DISTINCT participant_id FROM d) p CROSS JOIN (SELECT DISTINCT label FROM d) t
    LEFT JOIN d ON d.participant_id = p.participant_id AND d.label = t.label
    """,
)
def tidy(spark, sf):
    newest = keep_last(long_events(spark, sf), [*KEYS, "label"], ["seq"])
    wide_ = to_wide(newest, "label", "mean", order=["seq"])
    keyed = wide_.withColumn("participant_id", F.concat_ws("_", *KEYS)).drop(*KEYS)
    return to_tidy(keyed, "event", "mean")


@query(
    "r06_qc_flat",
    """
    SELECT event_id, 'qualitymeasures_k' AS measure,
           CAST(json_extract(props, '$.k') AS DOUBLE) AS value FROM events
    UNION ALL
    SELECT event_id, 'qualityratings_value', value FROM events
    """,
)
def qc_flat(spark, sf):
    events = table(spark, sf, "events")
    record = F.concat(
        F.lit('{"qualitymeasures": '), "props", F.lit(', "qualityratings": {"value": '),
        F.col("value").cast("string"), F.lit(', "name": "'), "event_type",
        F.lit('"}, "filedata": {"size": 1}}'),
    )
    return flatten_quality_record(events.withColumn("record", record), ["event_id"], "record")


@query(
    "r06_mixed_record",
    """
    SELECT event_id, 'qualitymeasures_k' AS measure,
           CAST(json_extract(props, '$.k') AS DOUBLE) AS value FROM events
    UNION ALL
    SELECT event_id, 'qualityratings_value', value FROM events
    """,
)
def qc_mixed(spark, sf):
    """Scalar blocks beside the wanted ones, and quoted numbers, which are no numbers."""
    events = table(spark, sf, "events")
    record = F.concat(
        F.lit('{"software": "x", "version": 12, "qualitymeasures": '), "props",
        F.lit(', "list": [1], "qualityratings": {"value": '), F.col("value").cast("string"),
        F.lit(', "quoted": "7.5", "name": "'), "event_type", F.lit('"}}'),
    )
    return flatten_quality_record(events.withColumn("record", record), ["event_id"], "record")


@query(
    "r07_summary",
    with_(q=CLEAN_ANSWERS) + """
    , cells AS (
        SELECT "Subject Code", 'mental_health' AS g, 'PHQ9' AS f, CAST("PHQ9" AS BIGINT) AS n,
               NULL AS t FROM q
        UNION ALL SELECT "Subject Code", 'demographics', 'Age', CAST(floor("Age") AS BIGINT),
               NULL FROM q
        UNION ALL SELECT "Subject Code", 'socioeconomic', 'Education', NULL, "Education" FROM q
        UNION ALL SELECT "Subject Code", 'socioeconomic', 'Salary', "Salary", NULL FROM q)
    SELECT "Subject Code", g AS category, f AS feature, coalesce(t, CAST(n AS VARCHAR)) AS value
    FROM cells WHERE t IS NOT NULL OR n IS NOT NULL
    """,
)
def summary(spark, sf):
    df = clean_questionnaire(answers(spark, sf))
    maps = participant_summaries(df)
    flat = maps.select("Subject Code", F.explode("summary").alias("category", "m")).select(
        "Subject Code", "category", F.explode("m").alias("feature", "value")
    )
    whole = F.floor(F.col("value").try_cast("double")).cast("string")
    return flat.withColumn("value", F.coalesce(whole, "value"))
