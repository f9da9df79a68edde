"""Tables written in between, whose shuffle files go as soon as the table stands."""

from __future__ import annotations

from pyspark.sql import DataFrame

from parcelhouse.plans.scratch import materialize

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared scratch folder and read it back.

    Lineage ends here, and the shuffle files of the job are removed when it is done; while it
    runs, lost ones are made again as ever.
    """
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, "false")
    conf.set(_CLEANUP, "true")
    try:
        return materialize(df, name)
    finally:
        conf.set(_CLEANUP, before)
