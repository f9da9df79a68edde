"""File scans. The files are derived from the whole tables, one small file per session.

Their rows are regions: values of a session are first aggregated per region, so a file is
bounded by the number of regions however often one key occurs.
"""

from pyspark.sql import functions as F

from parcelhouse.plans.scratch import scratch_path
from parcelhouse.sources.region_files import (
    discover_workflows,
    scan_anatomical,
    scan_diffusion,
)
from parcelhouse.sources.reports import scan_totals
from parcelhouse.sources.tables import (
    accepted,
    combine_registries,
    normalize_registry,
    read_delimited,
    read_participants,
    read_questionnaire,
    read_region_lookup,
    read_registries,
    read_registry,
    rejected,
)
from parcelhouse.workloads.bindings import (
    CLEAN_ANSWERS,
    LONG_DIFFUSION,
    answers,
    long_diffusion,
    sessions,
    table,
    with_,
)
from parcelhouse.workloads.registry import query
from parcelhouse.workloads.trees import write_text_tree

ATLAS = "demo"


def _rows_per_region(spark, sf):
    return (
        table(spark, sf, "lineitem")
        .groupBy("l_suppkey", "l_linestatus", "l_returnflag", "l_linenumber")
        .agg(
            F.round(F.sum("l_extendedprice"), 2).alias("volume"),
            F.max("l_quantity").alias("mean"), F.min("l_discount").alias("std"),
        )
    )


_REGION_SQL = """
SELECT CAST(l_suppkey AS VARCHAR) AS subject_code,
       CASE l_linestatus WHEN 'F' THEN '01' ELSE '02' END AS session_id,
       CASE l_returnflag WHEN 'A' THEN 'gm' WHEN 'N' THEN 'wm' ELSE 'ct' END AS modality,
       CASE l_returnflag WHEN 'R' THEN 'thickness' ELSE 'volume' END AS metric,
       'R.' || l_linenumber AS label, CAST(l_linenumber AS BIGINT) AS index,
       round(sum(l_extendedprice), 2) AS volume_mm3, max(l_quantity) AS mean,
       CASE WHEN l_returnflag <> 'R' THEN nullif(min(l_discount), 0) END AS std,
       CASE WHEN l_returnflag = 'R' THEN 'note' || l_linenumber END AS remark
FROM lineitem
GROUP BY l_suppkey, l_linestatus, l_returnflag, l_linenumber
"""


_trees = {}


def _written_once(write, spark, sf, fresh) -> str:
    """A tree of files that a session writes once and then only reads, or a new one to change."""
    key = (write.__name__, spark.sparkContext.applicationId, sf)
    if fresh:
        return write(spark, sf)
    if key not in _trees:
        _trees[key] = write(spark, sf)
    return _trees[key]


def anatomical_tree(spark, sf, fresh=False) -> str:
    """Tissue files: wm has another column order, ct lacks std and has a column of its own.

    A second gm file per session must be ignored.
    """
    return _written_once(_write_anatomical, spark, sf, fresh)


def _write_anatomical(spark, sf) -> str:
    root = scratch_path(spark, "anatomical")
    number, volume = F.col("l_linenumber").cast("string"), F.col("volume").cast("string")
    mean = F.col("mean").cast("string")
    std = F.when(F.col("std") == 0, "").otherwise(F.col("std").cast("string"))
    label = F.concat(F.lit("R."), number)
    line = {
        "A": F.concat_ws("\t", number, label, volume, mean, std),
        "N": F.concat_ws("\t", std, mean, volume, label, number),
        "R": F.concat_ws("\t", number, label, volume, mean, F.concat(F.lit("note"), number)),
    }
    header = {
        "A": "index\tlabel\tvolume_mm3\tmean\tstd\n",
        "N": "std\tmean\tvolume_mm3\tlabel\tindex\r\n",
        "R": "index\tlabel\tvolume_mm3\tmean\tremark\n",
    }
    flag = F.col("l_returnflag")
    lines = F.when(flag == "A", line["A"]).when(flag == "N", line["N"]).otherwise(line["R"])
    head = F.when(flag == "A", header["A"]).when(flag == "N", header["N"]).otherwise(header["R"])
    tissue = F.when(flag == "A", "GM").when(flag == "N", "WM").otherwise("CT")
    body = F.when(flag == "N", F.array_join("lines", "\r\n")).otherwise(
        F.array_join("lines", "\n")
    )
    session = F.concat(
        F.lit("sub-"), F.col("l_suppkey").cast("string"),
        F.when(F.col("l_linestatus") == "F", "/ses-01").otherwise("/ses-02"),
    )
    files = (
        _rows_per_region(spark, sf)
        .groupBy("l_suppkey", "l_linestatus", "l_returnflag")
        .agg(F.sort_array(F.collect_list(lines)).alias("lines"))
        .withColumns(
            {
                "path": F.concat(
                    session, F.lit(f"/anat/atlas-{ATLAS}/a_tissue-"), tissue, F.lit("_parc.tsv")
                ),
                "content": F.concat(head, body),
            }
        )
    )
    second = files.where(flag == "A").withColumns(
        {
            "path": F.replace(F.col("path"), F.lit("/a_tissue"), F.lit("/b_tissue")),
            "content": F.concat(head, F.lit("9\tR.9\t-1\t-1\t-1\n")),
        }
    )
    write_text_tree(files.unionByName(second), root)
    return root


_SCANNED = ["subject_code", "session_id", "modality", "metric", "label", "index", "volume_mm3",
            "mean", "std"]


@query("s02_anat", with_(l=_REGION_SQL) + "SELECT * FROM l")
def anat(spark, sf):
    rows = scan_anatomical(spark, anatomical_tree(spark, sf), ATLAS)
    return rows.select(*_SCANNED, F.col("extras")["remark"].alias("remark"))


@query(
    "s02_j08_anat_sessions",
    with_(l=_REGION_SQL) + """
    SELECT l.* EXCLUDE (remark), s_acctbal AS tiv FROM l
    JOIN supplier ON CAST(s_suppkey AS VARCHAR) = subject_code
    WHERE modality <> 'wm' AND s_acctbal > 0
    """,
)
def anat_sessions(spark, sf):
    suppliers = table(spark, sf, "supplier").where("s_acctbal > 0").select(
        F.col("s_suppkey").cast("string").alias("subject_code"),
        F.explode(F.array(F.lit("01"), F.lit("02"))).alias("session_id"),
        F.col("s_acctbal").alias("tiv"),
    )
    rows = scan_anatomical(
        spark, anatomical_tree(spark, sf), ATLAS, sessions=suppliers, modalities=["gm", "ct"],
        totals=suppliers,
    )
    return rows.select(*_SCANNED, "tiv")


def diffusion_tree(spark, sf) -> str:
    root = scratch_path(spark, "diffusion")
    regions = (
        long_diffusion(spark, sf)
        .groupBy("subject_code", "workflow", "model", "label")
        .agg(F.max("mean").alias("mean"), F.count("*").alias("voxel_count"))
    )
    line = F.concat_ws(
        "\t", "label", F.col("mean").cast("string"), F.col("voxel_count").cast("string")
    )
    # Only one model is named in the file names, and with a second dash.
    entity = F.when(F.col("model") == "F", "_model-F-x_param-old_param-p1").otherwise("_desc-d")
    files = regions.groupBy("subject_code", "workflow", "model").agg(
        F.sort_array(F.collect_list(line)).alias("lines")
    ).select(
        F.concat(
            F.lit("qsirecon-"), "workflow", F.lit("/sub-"), "subject_code", F.lit("/ses-01/dwi/"),
            F.lit(f"atlas-{ATLAS}/sub-"), "subject_code", F.lit("_ses-01"), entity,
            F.lit("_parc.tsv"),
        ).alias("path"),
        F.concat(F.lit("name\tmean\tvoxel_count\n"), F.array_join("lines", "\n")).alias("content"),
    )
    write_text_tree(files, root)
    return root


@query("s03_diff", with_(l=LONG_DIFFUSION) + """
    SELECT subject_code, '01' AS session_id, workflow,
           CASE m WHEN 'F' THEN 'F-x' ELSE 'unknown' END AS model,
           CASE m WHEN 'F' THEN 'p1' ELSE 'unknown' END AS param,
           CASE m WHEN 'F' THEN 'unknown' ELSE 'd' END AS "desc", label, mean, voxel_count
    FROM (SELECT subject_code, workflow, model AS m, label, max(mean) AS mean,
                 count(*) AS voxel_count FROM l GROUP BY ALL)
    """)
def diff(spark, sf):
    return scan_diffusion(spark, diffusion_tree(spark, sf), ATLAS).select(
        "subject_code", "session_id", "workflow", "model", "param", "desc", "label", "mean",
        "voxel_count",
    )


@query("s04_workflows", "SELECT DISTINCT l_returnflag AS workflow FROM lineitem")
def workflows(spark, sf):
    return discover_workflows(spark, diffusion_tree(spark, sf))


@query(
    "s05_tiv",
    """
    SELECT CAST(s_suppkey AS VARCHAR) AS subject_code, '1' AS session_id,
           CASE s_nationkey % 5 WHEN 0 THEN s_acctbal WHEN 1 THEN s_acctbal + 1
                WHEN 2 THEN s_acctbal + 2 WHEN 3 THEN s_acctbal + 3 END AS tiv
    FROM supplier WHERE s_nationkey % 5 < 4
    """,
)
def tiv(spark, sf):
    """Reports in five states: corrected, uncorrected, plain, other name, no number."""
    root = scratch_path(spark, "reports")
    state = F.col("s_nationkey") % 5

    def xml(value):
        return F.concat(
            F.lit("<S><help><subjectmeasures><vol_TIV>total volume</vol_TIV></subjectmeasures>"
                  "</help><subjectmeasures><vol_TIV> "),
            value.cast("string"), F.lit(" </vol_TIV></subjectmeasures></S>"),
        )

    value = F.col("s_acctbal")
    text_only = F.lit("<S><subjectmeasures><vol_TIV>none</vol_TIV></subjectmeasures></S>")
    outside = F.concat(F.lit("<S><vol_TIV>"), (value + 2).cast("string"), F.lit("</vol_TIV></S>"))
    reports = {
        "_ce-corrected_T1w": F.when(state == 0, xml(value)).otherwise(text_only),
        "_ce-uncorrected_T1w": F.when(state == 1, xml(value + 1)).when(
            state == 2, F.lit("<S><vol_TIV>7</S>")
        ),
        "_T1w": F.when(state.isin(0, 1), xml(value + 9)).when(state == 2, outside),
        "_acq-x_T1w": F.when(state == 3, xml(value + 3)),
    }
    files = table(spark, sf, "supplier").select(
        "s_suppkey",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("name"),
                        # With another name it must be the first file there is.
                        (F.when(state != 3, text) if name == "_ce-corrected_T1w" else text).alias(
                            "content"
                        ),
                    )
                    for name, text in reports.items()
                ]
            )
        ),
    ).where(F.col("content").isNotNull())
    key = F.col("s_suppkey").cast("string")
    paths = F.concat(
        F.lit("sub-"), key, F.lit("/ses-1/anat/cat_sub-"), key, F.lit("_ses-1"), "name",
        F.lit(".xml"),
    )
    write_text_tree(files.withColumn("path", paths), root)
    return scan_totals(spark, root)


def _as_csv(df, name, separator=","):
    path = scratch_path(df.sparkSession, name)
    df.write.options(
        header=True, sep=separator, escape='"', ignoreTrailingWhiteSpace=False
    ).csv(path)
    return path


def _raw_registry(spark, sf):
    key = F.col("session_id")
    return sessions(spark, sf).select(
        F.concat(F.lit("C-"), "subject_code").alias("subject_code"),
        F.when(F.col("site") == "F", F.concat(F.lit("0"), key))
        .when(F.col("site") == "O", F.concat(key, F.lit(".0")))
        .when(F.col("priority") != "5-LOW", F.concat(F.lit("x"), key)).alias("session_id"),
        F.round("AGE", 4).alias("AGE"), "site",
    )


@query(
    "s01_registry",
    """
    SELECT CASE WHEN length('C_' || o_custkey) < 4 THEN lpad('C_' || o_custkey, 4, '0')
                ELSE 'C_' || o_custkey END AS subject_code,
           CAST(o_orderkey AS VARCHAR) AS session_id, 'C-' || o_custkey AS subject_code_raw,
           CASE o_orderstatus WHEN 'F' THEN '0' || o_orderkey ELSE o_orderkey || '.0' END
               AS session_id_raw,
           CASE WHEN o_orderpriority <> '4-NOT SPECIFIED'
                THEN round(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) / 365.25, 4)
                END AS "AGE", o_orderstatus AS site
    FROM orders WHERE o_orderstatus <> 'P'
    """,
)
def registry(spark, sf):
    return read_registry(spark, _as_csv(_raw_registry(spark, sf), "registry"))


@query(
    "s01_rejected",
    """
    SELECT CASE o_orderpriority WHEN '5-LOW' THEN 'session id missing'
                ELSE 'session id is no number' END AS reason, count(*) AS n
    FROM orders WHERE o_orderstatus = 'P' GROUP BY ALL
    """,
)
def rejects(spark, sf):
    raw = read_delimited(spark, _as_csv(_raw_registry(spark, sf), "registry"))
    checked = normalize_registry(raw)
    assert accepted(checked).columns == checked.columns
    return rejected(checked).groupBy("reason").agg(F.count("*").alias("n"))


@query("s06_questionnaire", with_(q=CLEAN_ANSWERS)
       + 'SELECT * REPLACE (CAST("UID" AS VARCHAR) AS "UID") FROM q')
def questionnaire(spark, sf):
    return read_questionnaire(spark, _as_csv(answers(spark, sf), "answers"))


def _registries(spark, sf):
    orders = table(spark, sf, "orders")
    code = F.concat(F.lit("S_"), F.col("o_custkey").cast("string"))
    main = orders.select(
        F.when(F.col("o_custkey") % 7 == 0, "00-00").otherwise(code).alias("subject_code"),
        F.col("o_orderkey").cast("string").alias("session_id"),
        F.col("o_orderpriority").alias("info"),
    )
    legacy = orders.where("o_orderstatus = 'P'").select(
        F.concat(code, F.lit("-\t")).alias("subject_code"),
        F.concat(F.lit("_"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("session_id"),
        F.lit("from legacy").alias("info"),
    )
    vip = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("ID "), F.lit("1").alias("session_id"),
        F.lit("from vip").alias("info"),
    )
    cardiff = table(spark, sf, "supplier").select(
        F.col("s_name").alias("full_name"), F.col("s_nationkey").alias("session_id"),
        F.lit("from cardiff").alias("info"),
    )
    return main, {"legacy": legacy, "legacy_vip": vip, "cardiff": cardiff}


_MULTI = """
    WITH raw AS (
        SELECT 0 AS p, 'S' || o_custkey AS subject_code,
               lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS session_id, NULL AS source,
               o_orderpriority AS info
        FROM orders WHERE o_custkey % 7 > 0
        UNION ALL
        SELECT 1, 'S' || o_custkey, lpad(CAST(o_orderkey AS VARCHAR), 12, '0'), 'legacy',
               'from legacy' FROM orders WHERE o_orderstatus = 'P'
        UNION ALL
        SELECT 2, lpad(CAST(c_custkey AS VARCHAR), 9, '0'), '1', 'legacy_vip', 'from vip'
        FROM customer
        UNION ALL
        SELECT 4, s_name, CAST(s_nationkey AS VARCHAR), 'cardiff', 'from cardiff'
        FROM supplier)
    SELECT subject_code, session_id, source, info FROM raw
    QUALIFY row_number() OVER (PARTITION BY subject_code, session_id ORDER BY p DESC) = 1
    """


@query(
    "s13_multi_registry",
    _MULTI,
)
def multi_registry(spark, sf):
    main, extras = _registries(spark, sf)
    return combine_registries(main, extras).select("subject_code", "session_id", "source", "info")


@query("s13_registry_files", _MULTI.replace("""
        UNION ALL
        SELECT 4,""", """
        UNION ALL
        SELECT 3, 'S' || o_custkey, lpad(CAST(o_orderkey AS VARCHAR), 12, '0'), 'legacy_repeated',
               'scanned again' FROM orders WHERE o_orderpriority = '5-LOW'
        UNION ALL
        SELECT 4,"""))
def registry_files(spark, sf):
    """The same from CSV files, with the repeated sessions; a file that isn't there is skipped."""
    main, extras = _registries(spark, sf)
    orders = table(spark, sf, "orders")
    extras["legacy_repeated"] = orders.where("o_orderpriority = '5-LOW'").select(
        F.col("o_orderkey").alias("_c0"), F.concat(F.lit("S-"), "o_custkey").alias("subject_code"),
        F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("session_id"),
        F.lit("scanned again").alias("info"),
    )
    paths = {name: _as_csv(df, name) for name, df in extras.items() if name != "cardiff"}
    paths["cardiff"] = scratch_path(spark, "not-written")
    absent = read_registries(spark, _as_csv(main, "main"), paths)
    paths["cardiff"] = _as_csv(extras["cardiff"], "cardiff")
    whole = read_registries(spark, _as_csv(main, "main"), paths)
    assert "_c0" not in whole.columns and absent.columns == [c for c in whole.columns if c != "full_name"]
    return whole.select("subject_code", "session_id", "source", "info")


@query(
    "s12_lookup_file",
    "SELECT p_partkey AS index, '0' || p_size AS label, p_type AS network_label, p_brand AS label_7network FROM part",
)
def lookup_file(spark, sf):
    """A region lookup table from a TSV file; labels keep their leading zeros."""
    regions = table(spark, sf, "part").select(
        F.col("p_partkey").alias("index"), F.concat(F.lit("0"), F.col("p_size").cast("string")).alias("label"),
        F.col("p_type").alias("network_label"), F.col("p_brand").alias("label_7network"),
    )
    found = read_region_lookup(spark, _as_csv(regions, "lookup", "\t"))
    return found.withColumn("index", F.col("index").cast("bigint"))


@query(
    "s14_participants",
    "SELECT 'sub-' || c_custkey AS participant_id, c_acctbal AS age, c_mktsegment AS site FROM customer",
)
def participants(spark, sf):
    people = table(spark, sf, "customer").select(
        F.concat(F.lit("sub-"), F.col("c_custkey").cast("string")).alias("participant_id"),
        F.col("c_acctbal").alias("age"), F.col("c_mktsegment").alias("site"),
    )
    return read_participants(spark, _as_csv(people, "participants", "\t"))
