"""The whole load: registry, pending work, files, totals, publication."""

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from parcelhouse.model import LOAD_SOURCES, SESSION_KEYS
from parcelhouse.operators.profile import outcome_summary
from parcelhouse.plans.store import FeatureStore
from parcelhouse.sources.reports import scan_totals
from parcelhouse.sources.tables import accepted, normalize_registry, read_delimited, rejected
from parcelhouse.streaming.ingest import load_anatomical, load_diffusion, normalized


@dataclass
class LoadSettings:
    registry_path: str
    store_root: str
    anatomical_root: str = None
    diffusion_root: str = None
    report_root: str = None
    atlas: str = "4S456Parcels"
    sources: tuple = LOAD_SOURCES
    workflows: tuple = None
    age_column: str = None
    compression: str = "snappy"
    force: bool = False
    keep_staged: bool = False
    on_batch: object = None
    on_session: object = None
    missing_report: str = None


@dataclass
class LoadResult:
    n_sessions: int
    n_pending: int
    n_skipped: int
    published: list = field(default_factory=list)
    features: list = field(default_factory=list)
    summary: DataFrame = None
    n_rejected: int = 0
    rejected: DataFrame = None
    n_files: int = 0
    outcomes: dict = field(default_factory=dict)
    failed: DataFrame = None


def run_load(spark, settings: LoadSettings) -> LoadResult:
    """Load what is new, publish it and report.

    The file ledger says which files are new or changed; the session ledger which registered
    sessions are still without data. Registry rows without usable ids are counted and returned, as
    are sessions by outcome and the files that failed. A forced load takes all files again.
    """
    store = FeatureStore(spark, settings.store_root, settings.compression)
    rows = normalize_registry(read_delimited(spark, settings.registry_path))
    registry, refused = accepted(rows), rejected(rows)
    store.initialize_metadata(
        registry.drop("subject_code_raw", "session_id_raw"), settings.age_column
    )
    sessions = registry.select(*SESSION_KEYS).distinct()
    n_sessions = sessions.count()
    if settings.force:
        n_pending = n_sessions
    else:
        n_pending = store.pending(sessions, settings.sources).count()
    tissues = [s for s in settings.sources if s != "diffusion"]

    hooks = {"on_batch": settings.on_batch, "on_session": settings.on_session}
    n_files = 0
    if settings.anatomical_root and tissues:
        n_files += load_anatomical(
            store, settings.anatomical_root, settings.atlas, registry, tissues,
            again=settings.force, **hooks,
        )
    if settings.diffusion_root and "diffusion" in settings.sources:
        n_files += load_diffusion(
            store, settings.diffusion_root, settings.atlas, registry, settings.workflows,
            again=settings.force, **hooks,
        )
    if settings.report_root:
        totals = normalized(scan_totals(spark, settings.report_root), registry)
        if not totals.where(F.col("tiv").isNotNull()).isEmpty():
            store.save_tiv(totals)
    published = store.publish(keep_staged=settings.keep_staged)
    features = store.generate_wide_features(modalities=published) if published else []
    failed = store.failed_files()
    outcomes = outcome_summary(sessions, store.existing_sessions(), failed)
    if settings.missing_report:
        store.missing_report(sessions, settings.missing_report)
    return LoadResult(
        n_sessions, n_pending, n_sessions - n_pending, published, features, store.summary(),
        refused.count(), refused, n_files, {r.status: r.n for r in outcomes.collect()}, failed,
    )
