"""Session totals from XML reports."""

from pyspark.sql import Column, DataFrame, functions as F

from parcelhouse.functions import numeric_or_null
from parcelhouse.model import SESSION_KEYS
from parcelhouse.operators.latest import keep_preferred
from parcelhouse.operators.sessions import only_sessions
from parcelhouse.sources.region_files import read_files

_PATTERN = r"/sub-([^/]+)/ses-([^/]+)/anat/cat_[^/]*\.xml$"
# Report names, best first.
_NAMES = (
    r"/cat_sub-([^/]+)_ses-([^/]+)_ce-corrected_T1w\.xml$",
    r"/cat_sub-([^/]+)_ses-([^/]+)_ce-uncorrected_T1w\.xml$",
    r"/cat_sub-([^/_]+)_ses-([^/_]+)_T1w\.xml$",
)


def total_volume(xml) -> Column:
    """First number in ``subjectmeasures/vol_TIV``, else in any ``vol_TIV``; null if none.

    ``xpath`` ends the job on malformed text, so it runs only on text that parses.
    """
    text = F.col(xml) if isinstance(xml, str) else xml
    parsed = F.from_xml(text, "_corrupt_record string", {"mode": "PERMISSIVE"})
    well_formed = parsed.isNotNull() & parsed["_corrupt_record"].isNull()

    def first_number(path):
        numbers = F.transform(F.xpath(text, F.lit(path)), numeric_or_null)
        return F.try_element_at(F.filter(numbers, lambda x: x.isNotNull()), F.lit(1))

    return F.when(
        well_formed,
        F.coalesce(
            first_number("//subjectmeasures/vol_TIV[1]/text()"), first_number("//vol_TIV/text()")
        ),
    )


def totals_from_reports(files: DataFrame, sessions=None) -> DataFrame:
    """One total per session, from the best report that has a number."""
    found = files.where(F.col("file_path").rlike(_PATTERN)).withColumns(
        {
            "subject_code": F.regexp_extract("file_path", _PATTERN, 1),
            "session_id": F.regexp_extract("file_path", _PATTERN, 2),
        }
    )
    if sessions is not None:
        found = only_sessions(found, sessions)
    measured = found.select(*SESSION_KEYS, "file_path", total_volume("text").alias("tiv"))
    best = keep_preferred(
        measured, list(SESSION_KEYS), F.col("file_path"), _NAMES, F.col("tiv").isNotNull()
    )
    return best.select(*SESSION_KEYS, "tiv")


def scan_totals(spark, root, sessions=None) -> DataFrame:
    return totals_from_reports(read_files(spark, root, "cat_*.xml"), sessions)
