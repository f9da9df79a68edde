"""Counts, summaries and profiles."""

from pyspark.sql import functions as F

from parcelhouse.operators import profile
from parcelhouse.operators.answers import PARAMETER_RANGES, SCALE_RANGES, numeric_features
from parcelhouse.operators.regions import region_statistics
from parcelhouse.operators.sessions import of_cohort, pending_breakdown, pending_sessions
from parcelhouse.operators.spectral import band_amplitudes, strip_score
from parcelhouse.sources.tables import clean_questionnaire
from parcelhouse.workloads.bindings import (
    CLEAN_ANSWERS,
    LONG_DIFFUSION,
    LONG_EVENTS,
    LONG_TISSUE,
    SESSIONS,
    answers,
    long_diffusion,
    long_events,
    long_tissue,
    sessions,
    table,
    with_,
)
from parcelhouse.workloads.joins import _LEDGER, ledger
from parcelhouse.workloads.registry import query

KEYS = ["subject_code", "session_id"]


def _rounded(df, columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query(
    "a01_first_value",
    with_(l=LONG_EVENTS) + """
    SELECT subject_code, label, arg_min(mean, seq) FILTER (WHERE mean > 1) AS mean
    FROM l GROUP BY ALL
    """,
)
def first_value(spark, sf):
    from parcelhouse.operators.reshape import first_values

    rows = long_events(spark, sf).withColumn("mean", F.when(F.col("mean") > 1, F.col("mean")))
    return first_values(rows, ["subject_code", "label"], ["mean"], ["seq"])


@query(
    "a02_counts",
    with_(l=LONG_TISSUE) + """
    SELECT count(DISTINCT (subject_code, session_id)) AS n_sessions,
           count(DISTINCT subject_code) AS n_subjects FROM l
    """,
)
def counts(spark, sf):
    return profile.session_counts(long_tissue(spark, sf))


@query(
    "a03_age",
    with_(s=SESSIONS) + """
    SELECT round(min(AGE), 6) AS min, round(max(AGE), 6) AS max, round(avg(AGE), 6) AS mean,
           count(*) FILTER (WHERE AGE IS NULL) AS missing FROM s
    """,
)
def age(spark, sf):
    return _rounded(profile.value_statistics(sessions(spark, sf)), ["min", "max", "mean"])


@query(
    "a04_cohort_statistics",
    with_(q=CLEAN_ANSWERS) + """
    , c AS (SELECT * FROM q WHERE "Subject Code" IN (SELECT 'C' || o_custkey FROM orders)),
    u AS (SELECT 'PHQ9' AS feature, "PHQ9" AS v FROM c UNION ALL SELECT 'Age', "Age" FROM c
          UNION ALL SELECT 'Salary', CAST("Salary" AS DOUBLE) FROM c)
    SELECT feature, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std,
           round(median(v), 6) AS median, min(v) AS min, max(v) AS max, count(v) AS n
    FROM u WHERE v IS NOT NULL GROUP BY feature
    """,
)
def cohort(spark, sf):
    members = table(spark, sf, "orders").select(
        F.concat(F.lit("C-"), F.col("o_custkey").cast("string")).alias("subject_code")
    )
    chosen = of_cohort(clean_questionnaire(answers(spark, sf)), members)
    found = profile.cohort_statistics(chosen, numeric_features(chosen))
    return _rounded(found, ["mean", "std", "median"])


@query(
    "a05_parameters",
    with_(l=LONG_DIFFUSION) + """
    SELECT model, string_agg(DISTINCT param, ',' ORDER BY param) AS params FROM l GROUP BY model
    """,
)
def parameters(spark, sf):
    found = profile.parameters_by_model(long_diffusion(spark, sf))
    return found.select("model", F.array_join("params", ",").alias("params"))


@query(
    "a06_coverage",
    with_(l=LONG_DIFFUSION) + """
    SELECT workflow, model, param, count(DISTINCT label) AS n_regions,
           count(DISTINCT subject_code) AS n_subjects FROM l GROUP BY ALL
    """,
)
def coverage(spark, sf):
    return profile.coverage(long_diffusion(spark, sf), ["workflow", "model", "param"])


@query(
    "a07_region_consistency",
    with_(l=LONG_TISSUE) + """
    SELECT modality, min(n) AS min_regions, max(n) AS max_regions, round(avg(n), 6) AS mean_regions
    FROM (SELECT modality, subject_code, session_id, count(DISTINCT label) AS n FROM l GROUP BY ALL)
    GROUP BY modality
    """,
)
def consistency(spark, sf):
    return _rounded(
        profile.region_consistency(long_tissue(spark, sf), ["modality"]), ["mean_regions"]
    )


@query(
    "a08_tiv_statistics",
    with_(l=LONG_TISSUE) + """
    SELECT count(t) AS n, round(avg(t), 4) AS mean, round(stddev_samp(t), 4) AS std,
           min(t) AS min, max(t) AS max
    FROM (SELECT subject_code, session_id, min(tiv) AS t FROM l GROUP BY ALL)
    """,
)
def tiv_statistics(spark, sf):
    found = profile.total_statistics(long_tissue(spark, sf), order=["tiv"])
    return _rounded(found, ["mean", "std"], 4)


@query(
    "a09_missing",
    with_(q=CLEAN_ANSWERS) + """
    , n AS (SELECT count(*) AS n FROM q), u AS (
        SELECT 'Subject Code' AS c, count(*) - count("Subject Code") AS m FROM q
        UNION ALL SELECT 'Questionnaire', count(*) - count("Questionnaire") FROM q
        UNION ALL SELECT 'PHQ9', count(*) - count("PHQ9") FROM q
        UNION ALL SELECT 'Age', count(*) - count("Age") FROM q
        UNION ALL SELECT 'Education', count(*) - count("Education") FROM q
        UNION ALL SELECT 'Salary', count(*) - count("Salary") FROM q
        UNION ALL SELECT 'UID', count(*) - count("UID") FROM q)
    SELECT c AS "column", m AS missing, round(100.0 * m / n, 6) AS pct FROM u, n
    """,
)
def missing(spark, sf):
    return _rounded(profile.missing_profile(clean_questionnaire(answers(spark, sf))), ["pct"])


@query(
    "a09_missing_long",
    with_(l=LONG_TISSUE) + """
    , w AS (SELECT nullif(std, 0) AS std, nullif(tax, 0) AS tax,
                   CASE WHEN metric = 'volume' THEN volume_mm3 END AS volume_mm3, mean FROM l)
    SELECT c AS "column", m AS missing, round(100.0 * m / n, 6) AS pct FROM (
        SELECT 'std' AS c, count(*) - count(std) AS m, count(*) AS n FROM w
        UNION ALL SELECT 'tax', count(*) - count(tax), count(*) FROM w
        UNION ALL SELECT 'volume_mm3', count(*) - count(volume_mm3), count(*) FROM w
        UNION ALL SELECT 'mean', count(*) - count(mean), count(*) FROM w)
    """,
)
def missing_long(spark, sf):
    long = long_tissue(spark, sf).select(
        F.nullif("std", F.lit(0.0)).alias("std"), F.nullif("tax", F.lit(0.0)).alias("tax"),
        F.when(F.col("metric") == "volume", F.col("volume_mm3")).alias("volume_mm3"), "mean",
    )
    return _rounded(profile.missing_profile(long), ["pct"])


@query(
    "a10_negative",
    """
    SELECT 'c_acctbal' AS "column", count(*) FILTER (WHERE c_acctbal < 0) AS n_negative
    FROM customer HAVING n_negative > 0
    UNION ALL
    SELECT 'shifted', count(*) FILTER (WHERE c_custkey - 10 < 0) FROM customer
    """,
)
def negative(spark, sf):
    customers = table(spark, sf, "customer").withColumn("shifted", F.col("c_custkey") - 10)
    return profile.negative_profile(customers)


@query(
    "a11_duplicate_keys",
    with_(l=LONG_TISSUE) + """
    SELECT subject_code, session_id, modality, label, count(*) AS multiplicity FROM l
    GROUP BY ALL HAVING count(*) > 1
    """,
)
def duplicates(spark, sf):
    return profile.duplicate_keys(long_tissue(spark, sf), [*KEYS, "modality", "label"])


@query(
    "a11_duplicate_count",
    with_(l=LONG_TISSUE) + """
    SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicate_rows, count(*) AS duplicate_keys
    FROM (SELECT count(*) AS n FROM l GROUP BY subject_code, session_id, modality, label
          HAVING count(*) > 1)
    """,
)
def duplicate_count(spark, sf):
    return profile.duplicate_count(long_tissue(spark, sf), [*KEYS, "modality", "label"])


@query(
    "a12_ranges",
    with_(q=CLEAN_ANSWERS) + """
    SELECT 'PHQ9' AS "column", 0.0::DOUBLE AS expected_min, 27.0::DOUBLE AS expected_max,
           min("PHQ9") AS actual_min, max("PHQ9") AS actual_max,
           count(*) FILTER (WHERE "PHQ9" < 0 OR "PHQ9" > 27) AS n_out_of_range FROM q
    UNION ALL
    SELECT 'Age', 18, 100, min("Age"), max("Age"),
           count(*) FILTER (WHERE "Age" < 18 OR "Age" > 100) FROM q
    """,
)
def ranges(spark, sf):
    df = clean_questionnaire(answers(spark, sf))
    present = {c: r for c, r in SCALE_RANGES.items() if c in df.columns}
    return profile.range_check(df, present)


@query(
    "a12_parameter_ranges",
    with_(l=LONG_DIFFUSION) + """
    , r AS (SELECT CASE param WHEN 'ECONOMY' THEN 'FA' WHEN 'PROMO' THEN 'MD' ELSE 'ICVF' END AS param,
                   std AS v FROM l WHERE param IN ('ECONOMY', 'PROMO', 'SMALL'))
    SELECT param, 0.0::DOUBLE AS expected_min,
           CASE param WHEN 'MD' THEN 0.005 ELSE 1.0 END::DOUBLE AS expected_max,
           min(v) AS actual_min, max(v) AS actual_max,
           count(*) FILTER (WHERE v < 0 OR v > CASE param WHEN 'MD' THEN 0.005 ELSE 1 END)
               AS n_out_of_range
    FROM r GROUP BY param
    """,
)
def parameter_ranges(spark, sf):
    names = F.create_map(
        *[F.lit(x) for x in ("ECONOMY", "FA", "PROMO", "MD", "SMALL", "ICVF")]
    )
    long = long_diffusion(spark, sf).withColumn("param", names[F.col("param")])
    return profile.parameter_range_check(long, PARAMETER_RANGES, value="std")


@query(
    "a13_distribution",
    with_(q=CLEAN_ANSWERS) + """
    SELECT "Questionnaire" AS value, count(*) AS n,
           round(count(*) * 100.0 / (SELECT count(*) FROM q), 6) AS pct FROM q GROUP BY ALL
    """,
)
def distribution(spark, sf):
    found = profile.distribution(clean_questionnaire(answers(spark, sf)), "Questionnaire")
    return _rounded(found, ["pct"])


@query(
    "a13_distributions",
    with_(l=LONG_DIFFUSION) + """
    SELECT c AS "column", value, n, round(n * 100.0 / (SELECT count(*) FROM l), 6) AS pct FROM (
        SELECT 'workflow' AS c, workflow AS value, count(*) AS n FROM l GROUP BY ALL
        UNION ALL SELECT 'model', model, count(*) FROM l GROUP BY ALL
        UNION ALL SELECT 'param', param, count(*) FROM l GROUP BY ALL)
    """,
)
def distributions(spark, sf):
    found = profile.distributions(long_diffusion(spark, sf), ["workflow", "model", "param"])
    return _rounded(found, ["pct"])


_NUMBERS = ("volume_mm3", "mean", "std", "tax")


@query(
    "a14_describe",
    with_(l=LONG_TISSUE) + " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, count({c}) AS count, round(avg({c}), 4) AS mean,
        round(stddev_samp({c}), 4) AS std, min({c}) AS min, round(quantile_cont({c}, 0.25), 6) AS q25,
        round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75,
        max({c}) AS max FROM l"""
        for c in _NUMBERS
    ),
)
def describe(spark, sf):
    found = profile.describe(long_tissue(spark, sf), _NUMBERS)
    return _rounded(_rounded(found, ["q25", "q50", "q75"]), ["mean", "std"], 4)


@query(
    "a15_correlation",
    with_(l=LONG_TISSUE) + " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM l"
        for a in _NUMBERS for b in _NUMBERS
    ),
)
def correlation(spark, sf):
    return _rounded(profile.correlation(long_tissue(spark, sf), list(_NUMBERS)), ["r"])


@query(
    "a16_pending_breakdown",
    with_(s=SESSIONS, d=_LEDGER) + """
    SELECT w.source, count(*) AS n_sessions FROM s, (VALUES ('gm'), ('wm'), ('ct')) AS w(source)
    WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.subject_code = s.subject_code
                      AND d.session_id = s.session_id AND d.source = w.source)
    GROUP BY w.source
    """,
)
def breakdown(spark, sf):
    found = pending_sessions(sessions(spark, sf), ledger(spark, sf), ("gm", "wm", "ct"))
    return pending_breakdown(found)


@query(
    "a18_ledger_status",
    with_(d=_LEDGER) + "SELECT source, count(*) AS n_sessions FROM d GROUP BY source",
)
def ledger_status(spark, sf):
    rows = ledger(spark, sf)
    return profile.ledger_status(rows.unionByName(rows))


@query(
    "a19_outcome",
    with_(s=SESSIONS, l=LONG_TISSUE) + """
    SELECT CASE WHEN p.subject_code IS NULL THEN 'skipped' ELSE 'success' END AS status,
           count(*) AS n
    FROM s LEFT JOIN (SELECT DISTINCT subject_code, session_id FROM l) p
    ON p.subject_code = s.subject_code AND p.session_id = s.session_id GROUP BY ALL
    """,
)
def outcome(spark, sf):
    return profile.outcome_summary(sessions(spark, sf), long_tissue(spark, sf))


@query(
    "a20_hist",
    with_(l=LONG_TISSUE) + """
    , e AS (SELECT min(volume_mm3) AS lo, max(volume_mm3) AS hi FROM l),
    b AS (SELECT least(CAST(floor((volume_mm3 - lo) / (hi - lo) * 30) AS INTEGER), 29) AS bin,
                 count(*) AS n FROM l, e WHERE volume_mm3 IS NOT NULL GROUP BY ALL)
    SELECT CAST(i.bin AS INTEGER) AS bin, round(lo + i.bin * ((hi - lo) / 30), 4) AS from_value,
           round(lo + (i.bin + 1) * ((hi - lo) / 30), 4) AS to_value, coalesce(b.n, 0) AS n
    FROM range(30) AS i(bin) CROSS JOIN e LEFT JOIN b ON b.bin = i.bin
    """,
)
def hist(spark, sf):
    found = profile.histogram(long_tissue(spark, sf), "volume_mm3", 30)
    return _rounded(found, ["from_value", "to_value"], 4)


@query(
    "a21_parcel_stats",
    """
    WITH v AS (SELECT CAST(l_suppkey AS VARCHAR) AS session_id, l_returnflag AS label,
                      l_extendedprice / 7 AS x FROM lineitem),
    q AS (SELECT session_id, label, median(x) AS med, quantile_cont(x, 0.25) AS q1,
                 quantile_cont(x, 0.75) AS q3, avg(x) AS m, stddev_samp(x) AS s, mad(x) AS d
          FROM v GROUP BY ALL)
    SELECT session_id, label, count(*) * 2.0::DOUBLE AS volume_mm3, count(*) AS voxel_count,
           round(avg(x), 4) AS mean, round(stddev_samp(x), 4) AS std, round(any_value(med), 4) AS median,
           round(sum(x), 2) AS sum, round(any_value(d), 4) AS mad_median,
           round(avg(x) FILTER (WHERE d = 0 OR abs(x - med) <= 3 * 1.4826 * d), 4) AS robust_mean,
           round(stddev_samp(x) FILTER (WHERE d = 0 OR abs(x - med) <= 3 * 1.4826 * d), 4)
               AS robust_std,
           round(avg(x) FILTER (WHERE s IS NULL OR s = 0 OR abs(x - m) <= 3 * s), 4)
               AS z_filtered_mean,
           round(stddev_samp(x) FILTER (WHERE s IS NULL OR s = 0 OR abs(x - m) <= 3 * s), 4)
               AS z_filtered_std,
           round(avg(x) FILTER (WHERE x BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 4)
               AS iqr_filtered_mean,
           round(stddev_samp(x) FILTER (WHERE x BETWEEN q1 - 1.5 * (q3 - q1)
                                        AND q3 + 1.5 * (q3 - q1)), 4) AS iqr_filtered_std
    FROM v JOIN q USING (session_id, label) GROUP BY ALL
    """,
)
def parcel_stats(spark, sf):
    voxels = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("session_id"),
        F.col("l_returnflag").alias("label"),
        # Sevenths, so that no mean ends on a rounding tie between the two engines.
        (F.col("l_extendedprice") / 7).alias("value"),
    )
    found = region_statistics(voxels, ["session_id", "label"], "value", voxel_volume=2.0)
    exact = {"session_id", "label", "voxel_count", "volume_mm3"}
    return _rounded(
        found.withColumn("sum", F.round("sum", 2)),
        [c for c in found.columns if c not in exact | {"sum"}], 4,
    )


@query(
    "a22_strip_score",
    """
    WITH p AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v,
                      generate_subscripts(embedding, 1) - 1 AS z, len(embedding) AS n
               FROM embeddings),
    y AS (SELECT vec_id, k, 2.0 / n * sqrt(power(sum(v * cos(2 * pi() * k * z / n)), 2)
                 + power(sum(v * sin(2 * pi() * k * z / n)), 2)) AS a
          FROM p, range(1000) AS f(k) WHERE k < n // 2 AND k / n BETWEEN 0.25 - 0.05 AND 0.25 + 0.05
          GROUP BY vec_id, k, n)
    SELECT vec_id, round(sum(a), 6) AS strip_score FROM y GROUP BY vec_id
    """,
)
def strip_profile(spark, sf):
    vectors = table(spark, sf, "embeddings")
    scores = band_amplitudes(vectors, ["vec_id"], "embedding")
    return scores.select("vec_id", F.round("amplitude", 6).alias("strip_score"))


@query(
    "a22_strip_score_voxels",
    """
    WITH s AS (SELECT l_suppkey, day(l_shipdate) AS z, avg(l_quantity) AS v FROM lineitem
               GROUP BY ALL),
    p AS (SELECT *, count(*) OVER (PARTITION BY l_suppkey) AS n,
                 row_number() OVER (PARTITION BY l_suppkey ORDER BY z) - 1 AS i FROM s),
    y AS (SELECT l_suppkey, k, 2.0 / n * sqrt(power(sum(v * cos(2 * pi() * k * i / n)), 2)
                 + power(sum(v * sin(2 * pi() * k * i / n)), 2)) AS a
          FROM p, range(32) AS f(k) WHERE k < n // 2 AND k / n BETWEEN 0.25 - 0.05 AND 0.25 + 0.05
          GROUP BY l_suppkey, k, n)
    SELECT l_suppkey, round(sum(a), 6) AS strip_score FROM y GROUP BY l_suppkey
    """,
)
def strip_voxels(spark, sf):
    voxels = table(spark, sf, "lineitem").select(
        "l_suppkey", F.dayofmonth("l_shipdate").alias("z"), "l_quantity"
    )
    return _rounded(strip_score(voxels, ["l_suppkey"], "z", "l_quantity"), ["strip_score"])


@query(
    "a24_column",
    with_(s=SESSIONS) + """
    SELECT 'AGE' AS "column", count(AGE) AS n_non_null, count(*) - count(AGE) AS n_null,
           round(min(AGE), 6) AS min, round(max(AGE), 6) AS max, round(avg(AGE), 6) AS mean,
           NULL::BIGINT AS n_distinct FROM s
    UNION ALL
    SELECT 'priority', count(priority), count(*) - count(priority), NULL, NULL, NULL,
           count(DISTINCT priority) FROM s
    """,
)
def column(spark, sf):
    df = sessions(spark, sf)
    numbers = _rounded(profile.column_profile(df, "AGE"), ["min", "max", "mean"])
    texts = profile.column_profile(df, "priority")
    both = numbers.withColumn("column", F.lit("AGE")).unionByName(
        texts.withColumn("column", F.lit("priority")), allowMissingColumns=True
    )
    return both


@query(
    "a24_top_values",
    with_(l=LONG_DIFFUSION) + """
    SELECT label AS value, count(*) AS n FROM l GROUP BY label ORDER BY n DESC, label LIMIT 10
    """,
)
def top_values(spark, sf):
    return profile.top_values(long_diffusion(spark, sf), "label", 10)
