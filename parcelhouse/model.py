"""Names, keys and vocabularies of the data model."""

from pyspark.sql import types as T

# Statistic columns of the region tables.
ANATOMICAL_STATISTICS = (
    "volume_mm3", "mean", "std", "median", "sum", "robust_std", "mad_median",
)
DIFFUSION_STATISTICS = (
    "mean", "std", "median", "robust_mean", "robust_std", "mad_median",
    "z_filtered_mean", "z_filtered_std", "iqr_filtered_mean", "iqr_filtered_std",
    "volume_mm3", "voxel_count",
)
# Columns that identify a region.
REGION_COLUMNS = (
    "index", "label", "network_label", "label_7network", "index_17network",
    "label_17network", "network_label_17network", "atlas_name", "network_id",
)
# Tissue class in the file name -> (modality, metric).
TISSUES = {
    "GM": ("gm", "volume"),
    "WM": ("wm", "volume"),
    "CT": ("ct", "thickness"),
}
# Candidate names, first existing one wins.
REGION_ALIASES = ("label", "name", "region", "index")
VALUE_ALIASES = ("mean", "Mean", "value")
AGE_ALIASES = ("AGE", "Age@Scan", "age", "Age")
# Column prefixes that mark feature columns in a session table.
FEATURE_PREFIXES = ("gm_", "wm_", "ct_", "DSIStudio", "MRtrix", "DIPY", "AMICO")

SESSION_KEYS = ("subject_code", "session_id")
ANATOMICAL_KEYS = SESSION_KEYS + ("modality", "label")
DIFFUSION_KEYS = SESSION_KEYS + ("workflow", "model", "param", "desc", "label")
LOAD_ORDER = ("batch_id", "source_path", "line_no")
LOAD_SOURCES = ("gm", "wm", "ct", "diffusion")

ALL_STATISTICS = tuple(dict.fromkeys(ANATOMICAL_STATISTICS + DIFFUSION_STATISTICS))
_LONG_INTEGERS = {"index", "index_17network", "network_id", "voxel_count"}


_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
    "array<string>": T.ArrayType(T.StringType()),
}


def schema(**columns) -> T.StructType:
    """``schema(name="string", ...)``; unlike a DDL string it needs no running session."""
    return T.StructType([T.StructField(c, _TYPES[kind]) for c, kind in columns.items()])


def _field(name):
    if name in _LONG_INTEGERS:
        return T.StructField(name, T.LongType())
    if name in ALL_STATISTICS:
        return T.StructField(name, T.DoubleType())
    return T.StructField(name, T.StringType())


REGION_FIELDS = [_field(c) for c in REGION_COLUMNS]
STATISTIC_FIELDS = [_field(c) for c in ALL_STATISTICS]
TAG_FIELDS = [_field(c) for c in ("modality", "metric", "workflow", "model", "param", "desc")]

#: Canonical long table; unknown upstream columns are kept in ``extras``.
LONG_SCHEMA = T.StructType(
    [_field(c) for c in SESSION_KEYS]
    + TAG_FIELDS
    + REGION_FIELDS
    + STATISTIC_FIELDS
    + [
        T.StructField("tiv", T.DoubleType()),
        T.StructField("extras", T.MapType(T.StringType(), T.StringType())),
        T.StructField("source_path", T.StringType()),
        T.StructField("line_no", T.LongType()),
        T.StructField("source", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

LEDGER_SCHEMA = schema(
    subject_code="string", session_id="string", source="string", loaded_at="timestamp",
    batch_id="bigint",
)


def first_existing(columns, candidates, required=True, what="column"):
    """First name of ``candidates`` present in ``columns``; None or an error if absent."""
    for name in candidates:
        if name in columns:
            return name
    if required:
        raise ValueError(f"no {what} among {list(candidates)}; available: {list(columns)}")
    return None


def region_column(columns, preferred=None):
    head = (preferred,) if preferred else ()
    return first_existing(columns, head + REGION_ALIASES, what="region column")


def value_column(columns, preferred=None):
    head = (preferred,) if preferred else ()
    return first_existing(columns, head + VALUE_ALIASES, what="value column")


def age_column(columns, preferred=None):
    head = (preferred,) if preferred else ()
    return first_existing(columns, head + AGE_ALIASES, required=False)


def long_keys(source):
    """Row key of a stored long table by its name."""
    return DIFFUSION_KEYS if source.startswith("diffusion") else ANATOMICAL_KEYS
