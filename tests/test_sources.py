"""File scans on small trees with the awkward cases."""

import os

import pytest

from parcelhouse.functions import bare_code
from parcelhouse.operators.answers import (
    column_groups,
    numeric_features,
    participant_summary,
    text_features,
)
from parcelhouse.sources.region_files import discover_workflows, scan_anatomical, scan_diffusion
from parcelhouse.sources.reports import scan_totals
from parcelhouse.sources.tables import (
    normalize_registry,
    read_delimited,
    read_questionnaire,
    read_registries,
    read_registry,
    rejected,
)
from parcelhouse.workloads.trees import write_text_tree


def _write(root, files):
    for path, text in files.items():
        full = os.path.join(root, path)
        os.makedirs(os.path.dirname(full), exist_ok=True)
        with open(full, "w", newline="") as stream:
            stream.write(text)
    return root


def test_anatomical_files_with_awkward_content(spark, root):
    place = "sub-00+48R/ses-01/anat/atlas-A/"
    _write(
        root,
        {
            place + "s_tissue-GM_parc.tsv": "index\tlabel\tvolume_mm3\tmean\n1\tLH.Vis\t812.4\t0.61\n2\tB\t\tNaN\n3\tshort\n",
            place + "t_tissue-GM_parc.tsv": "index\tlabel\tmean\n9\tIGNORED\t1\n",
            place + "s_tissue-WM_parc.tsv": "mean\tnew col\tlabel\tindex\r\n0.5\tn1\tB\t2\r\nNA\tn/a\tC\t3\r\n",
            place + "s_tissue-CT_parc.tsv": "",
            place + "notes.txt": "x",
            "sub-2/ses-1/anat/atlas-B/s_tissue-GM_parc.tsv": "label\tmean\nOTHER\t1\n",
        },
    )
    got = {
        (r.subject_code, r.session_id, r.modality, r.metric, r.label, r["index"], r.volume_mm3, r["mean"])
        for r in scan_anatomical(spark, root, "A").collect()
    }
    head = ("00+48R", "01")
    assert got == {
        head + ("gm", "volume", "LH.Vis", 1, 812.4, 0.61),
        head + ("gm", "volume", "B", 2, None, None),
        head + ("gm", "volume", "short", 3, None, None),
        head + ("wm", "volume", "B", 2, None, 0.5),
        head + ("wm", "volume", "C", 3, None, None),
    }
    extras = {r.label: r.extras for r in scan_anatomical(spark, root, "A", modalities=["wm"]).collect()}
    assert extras == {"B": {"new col": "n1"}, "C": {"new col": None}}


def test_only_registered_sessions_are_scanned(spark, root):
    text = "label\tmean\nA\t1\n"
    _write(root, {f"sub-{s}/ses-1/anat/atlas-A/x_tissue-GM_parc.tsv": text for s in (1, 2)})
    wanted = spark.createDataFrame([("2", "1")], "subject_code string, session_id string")
    assert [r.subject_code for r in scan_anatomical(spark, root, "A", wanted).collect()] == ["2"]


def test_missing_folder_is_an_empty_scan(spark, root):
    assert scan_anatomical(spark, root + "/nowhere", "A").count() == 0


def test_diffusion_files(spark, root):
    place = "qsirecon-W/sub-1/ses-2/dwi/atlas-A/"
    _write(
        root,
        {
            place + "sub-1_model-noddi_param-icvf_desc-x-y_parc.tsv": "name\tmean\tvoxel_count\nR\t0.5\t7\n",
            place + "sub-1_param-a_param-b_parc.tsv": "label\tmean\nR\t0.25\n",
            "qsirecon-V/sub-1/ses-2/dwi/atlas-A/z_parc.tsv": "label\tmean\nR\t1\n",
        },
    )
    rows = scan_diffusion(spark, root, "A").collect()
    assert {(r.workflow, r.model, r.param, r.desc, r.label, r["mean"], r.voxel_count) for r in rows} == {
        ("W", "noddi", "icvf", "x-y", "R", 0.5, 7),
        ("W", "unknown", "b", "unknown", "R", 0.25, None),
        ("V", "unknown", "unknown", "unknown", "R", 1.0, None),
    }
    assert {r[0] for r in discover_workflows(spark, root).collect()} == {"W", "V"}
    assert scan_diffusion(spark, root, "A", workflows=["V"]).count() == 1


def test_totals_from_reports(spark, root):
    def name(subject, middle=""):
        return f"sub-{subject}/ses-1/anat/cat_sub-{subject}_ses-1{middle}_T1w.xml"

    good = (
        "<S><help><subjectmeasures><vol_TIV>total (text)</vol_TIV></subjectmeasures></help>"
        "<subjectmeasures><vol_TIV> {} </vol_TIV></subjectmeasures></S>"
    )
    text_only = "<S><subjectmeasures><vol_TIV>words</vol_TIV></subjectmeasures></S>"
    _write(
        root,
        {
            name(1, "_ce-corrected"): good.format(1501.5), name(1): good.format(7),
            name(2, "_ce-corrected"): text_only, name(2, "_ce-uncorrected"): good.format(8),
            name(3, "_ce-corrected"): "<S><vol_TIV>5</S>", name(3): "<S><vol_TIV>9</vol_TIV></S>",
            name(4): text_only,
            "sub-5/ses-1/anat/cat_other.xml": good.format(11),
        },
    )
    got = {(r.subject_code, r.tiv) for r in scan_totals(spark, root).collect()}
    assert got == {("1", 1501.5), ("2", 8.0), ("3", 9.0), ("5", 11.0)}


def test_registry_with_bad_rows(spark, root):
    _write(
        root,
        {"r.csv": "subject_code,session_id,Age,site\n0048R,202303161349,31.5,A\n7,01,,B\n"
                  ",5,1,C\nX,abc,2,D\nY,,3,E\n"},
    )
    rows = {tuple(r) for r in read_registry(spark, root + "/r.csv").drop("site").collect()}
    assert rows == {
        ("0048R", "202303161349", 31.5, "0048R", "202303161349"), ("0007", "1", None, "7", "01"),
    }
    bad = rejected(normalize_registry(read_delimited(spark, root + "/r.csv"))).collect()
    assert {(r.site, r.reason) for r in bad} == {
        ("C", "subject code missing"), ("D", "session id is no number"), ("E", "session id missing"),
    }
    _write(root, {"bad.csv": "subject,session_id\n1,2\n"})
    with pytest.raises(ValueError):
        read_registry(spark, root + "/bad.csv")


def test_optional_registries(spark, root):
    _write(
        root,
        {
            "main.csv": "subject_code,session_id\na-b,12\n0000,13\n",
            "legacy.csv": "subject_code,session_id\nab,000000000012\n",
        },
    )
    joined = read_registries(
        spark, root + "/main.csv", {"legacy": root + "/legacy.csv", "cardiff": root + "/none.csv"}
    )
    assert [tuple(r) for r in joined.select("subject_code", "session_id", "source").collect()] == [
        ("ab", "000000000012", "legacy")
    ]


def test_questionnaire(spark, root):
    _write(
        root,
        {"q.csv": 'Subject Code,UID,Questionnaire,PHQ9,Age,Gender,Note\n00-48_R,1,Yes,n/a,30,F,"a\nb"\n'
                  "0048R,2,,5,31,,x\n9,3,No,6,32,M,y\n"},
    )
    df = read_questionnaire(spark, root + "/q.csv", multiline=True)
    assert {(r["Subject Code"], r.UID, r.PHQ9, r.Age) for r in df.collect()} == {
        ("0048R", "1", None, 30.0), ("0048R", "2", 5.0, 31.0),
    }
    assert numeric_features(df) == ["PHQ9", "Age"] and text_features(df) == ["Gender", "Note"]
    assert column_groups(df.columns) == {"demographics": ["Gender", "Age"], "mental_health": ["PHQ9"]}
    summaries = [r.summary for r in participant_summary(df, "00-48R").collect()]
    assert {"demographics": {"Gender": "F", "Age": "30.0"}} in summaries
    assert {"demographics": {"Age": "31.0"}, "mental_health": {"PHQ9": "5.0"}} in summaries
    assert df.where(bare_code("`Subject Code`") == "9").count() == 0


def test_text_tree(spark, root):
    df = spark.createDataFrame([("a/b.txt", "x\n"), ("c.txt", "y")], "path string, content string")
    assert write_text_tree(df, root) == 2
    assert open(os.path.join(root, "a/b.txt")).read() == "x\n"


def test_listing_and_reading_in_tasks_finds_what_spark_finds(spark, root):
    from parcelhouse.sources import region_files as files

    deep = "sub-1 +%25é/ses-01/anat/"
    _write(
        root,
        {
            "a_tissue-GM_parc.tsv": "1", "sub-2/b_tissue-WM_parc.tsv": "22",
            deep + "atlas-A/x,{y}_tissue-GM_parc.tsv": "333", deep + "atlas-A/empty_tissue-GM_parc.tsv": "",
            deep + "_hidden/c_tissue-GM_parc.tsv": "4", deep + ".d_tissue-GM_parc.tsv": "4",
            deep + "k=_v/_k=v_tissue-CT_parc.tsv": "55", "sub-2/notes_tissue-GM_parc.tsv.txt": "6",
        },
    )
    glob = files.anatomical_glob()
    listed = files.list_files(spark, root, glob)
    rows = {tuple(r) for r in listed.collect()}
    assert len(rows) == 4
    assert rows == {tuple(r) for r in files._listed_by_spark(spark, root, glob).collect()}
    read = files.read_listed(listed, root)
    got = {tuple(r) for r in read.collect()}
    assert got == {tuple(r) for r in files._read_by_spark(listed, False).collect()}
    # No file index, whose statuses the driver gathers.
    assert "FileScan" not in read._jdf.queryExecution().toString()
