"""The operators bound to the benchmark tables, each with the SQL that states its result."""

from parcelhouse.workloads.registry import ORACLES, QUERIES  # noqa: F401
from parcelhouse.workloads import (  # noqa: F401
    expressions,
    files,
    joins,
    profiles,
    quality,
    reshaping,
    stored,
)
