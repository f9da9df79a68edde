"""Incremental, resumable loads.

Region files are found by listing. The store's file ledger holds, for every file that has been
worked on, its path, length and modification time, the batch, and why it gave no rows, if so; what
the listing has and the ledger lacks is the work. So a file rewritten in place, a source asked for
later and a session registered later are loaded without reading anything else again.
Files are read and written in batches: data first, then sessions, then the file ledger; after a crash the
files of an open batch are loaded again under a newer number, which replaces their rows.

Streams of rows go through ``foreachBatch``; a micro-batch that is repeated is written again under
the number it had.
"""

import logging

from pyspark.sql import DataFrame, functions as F, types as T

from parcelhouse.model import SESSION_KEYS
from parcelhouse.plans.scratch import materialize
from parcelhouse.sources.region_files import (
    anatomical_files,
    anatomical_glob,
    anatomical_rows,
    diffusion_files,
    diffusion_rows,
    file_problem,
    list_files,
    read_listed,
)

log = logging.getLogger(__name__)
_KEYS = list(SESSION_KEYS)


def _after_batch(store, batch_id, on_batch, on_session):
    if on_batch is None and on_session is None:
        return
    written = store.staged().where(F.col("batch_id") == batch_id)
    if on_session is not None:
        store.record_hook_failures(session_hook(written, on_session), batch_id)
    if on_batch is not None:
        try:
            on_batch(written, batch_id)
        except Exception:  # a failing hook must not stop the load
            log.exception("hook failed on batch %s", batch_id)


def session_hook(rows: DataFrame, hook) -> DataFrame:
    """Call ``hook(subject, session, frame)`` with the rows of every session, inside the tasks.

    Returns one row with the error for each session whose call failed; a session's rows are regions
    times measures. Calls may be repeated when a task is.
    """

    # Columns without any value in the batch are not sent.
    counts = rows.agg(*[F.count(c).alias(c) for c in rows.columns]).first()
    filled = [c for c in rows.columns if c in _KEYS or counts[c]]
    sent = rows.select(*filled)
    whole = [f.name for f in sent.schema.fields if isinstance(f.dataType, T.LongType)]

    def call(batches):
        import pandas as pd

        failed = []
        for subject, session, frame in _sessions(batches, whole):
            try:
                hook(subject, session, frame)
            except Exception as error:  # reported, not raised: the load goes on
                failed.append((subject, session, f"{type(error).__name__}: {error}"))
        yield pd.DataFrame(failed, columns=[*_KEYS, "error"])

    # Sessions lie side by side in a task; a grouping would start anew for each of them.
    together = sent.repartition(*_KEYS).sortWithinPartitions(*_KEYS)
    return together.mapInPandas(call, "subject_code string, session_id string, error string")


def _sessions(batches, whole):
    """``(subject, session, frame)`` of rows sorted by session, also where one spans several batches.

    Columns of whole numbers become fractions where another session of the batch lacks a value;
    a session that has all of them gets whole numbers.
    """
    import numpy as np
    import pandas as pd

    def ready(frames):
        frame = pd.concat(frames, ignore_index=True) if len(frames) > 1 else frames[0].reset_index(drop=True)
        for column in whole:
            if frame[column].dtype.kind == "f" and frame[column].notna().all():
                frame[column] = frame[column].astype("int64")
        return frame[_KEYS[0]].iloc[0], frame[_KEYS[1]].iloc[0], frame

    def same(one, two):
        return one == two or (one is None and two is None)

    held, last = [], None
    for batch in batches:
        if not len(batch):
            continue
        # None equals None here, as in a grouping.
        codes = [pd.factorize(batch[k], use_na_sentinel=False)[0] for k in _KEYS]
        new = np.flatnonzero(np.any([np.diff(c) != 0 for c in codes], axis=0)) + 1
        cuts = [0, *new.tolist(), len(batch)]
        ids = [batch[k].tolist() for k in _KEYS]
        for start, stop in zip(cuts, cuts[1:]):
            key = (ids[0][start], ids[1][start])
            if held and not (same(key[0], last[0]) and same(key[1], last[1])):
                yield ready(held)
                held = []
            held.append(batch.iloc[start:stop])
            last = key
    if held:
        yield ready(held)


def _raw_sessions(registry):
    """Session keys as they appear in paths, to drop files before they are read."""
    return registry.select(
        F.col("subject_code_raw").alias("subject_code"), F.col("session_id_raw").alias("session_id")
    )


def normalized(rows: DataFrame, registry: DataFrame) -> DataFrame:
    """Stored ids instead of those in the paths; rows of unregistered sessions fall away."""
    ids = registry.select(
        F.col("subject_code_raw").alias("_subject"), F.col("session_id_raw").alias("_session"),
        F.col("subject_code").alias("_stored_subject"),
        F.col("session_id").alias("_stored_session"),
    ).distinct()
    match = (rows["subject_code"] == ids["_subject"]) & (rows["session_id"] == ids["_session"])
    joined = rows.join(ids, match)
    return joined.withColumns(
        {"subject_code": F.col("_stored_subject"), "session_id": F.col("_stored_session")}
    ).drop("_subject", "_session", "_stored_subject", "_stored_session")


def _load_files(
    store, kind, root, glob, sessions_of, parse, registry, files_per_batch, again, on_batch,
    on_session,
) -> int:
    """Load the files below ``root`` that the ledger lacks; returns how many.

    ``sessions_of`` gives the files with the ids in their paths; files that it leaves out, and
    those of unregistered sessions, are none of this load's. All files are one batch, unless
    ``files_per_batch`` says less.
    """
    spark = store.spark
    work = sessions_of(list_files(spark, root, glob))
    if registry is not None:
        work = work.join(_raw_sessions(registry), _KEYS, "left_semi")
    version = ["file_path", "length", "modified"]
    if not again:
        work = work.join(store.file_ledger(kind).select(*version), version, "left_anti")
    work = materialize(work.select(*_KEYS, *version), "due-files")
    n_files = work.count()
    parts = -(-n_files // (files_per_batch or max(1, n_files)))
    for part in range(parts):
        due = work if parts == 1 else work.where(F.pmod(F.xxhash64("file_path"), F.lit(parts)) == part)
        if parts == 1 or not due.isEmpty():
            batch_id = store.new_batch()
            sound = read_listed(due, root).where(file_problem().isNull())
            store.write_batch(parse(sound), batch_id)
            store.record_files(_outcomes(store, root, due, batch_id, registry), kind, batch_id)
            _after_batch(store, batch_id, on_batch, on_session)
    return n_files


def _outcomes(store, root: str, due: DataFrame, batch_id: int, registry) -> DataFrame:
    """The files of a batch with the reason why they gave no rows (null if they did).

    Only such files are looked at once more.
    """
    written = store.staged().where(F.col("batch_id") == batch_id)
    loaded = written.select(F.col("source_path").alias("file_path")).distinct()
    failed = materialize(due.join(loaded, "file_path", "left_anti"), "failed-files")
    texts = read_listed(failed, root).select("file_path", file_problem().alias("reason"))
    reason = F.coalesce("reason", F.when(~F.col("_read"), "unreadable"), F.lit("no rows"))
    failed = failed.join(texts.withColumn("_read", F.lit(True)), "file_path", "left").fillna(
        False, ["_read"]
    ).withColumn("reason", reason).drop("_read")
    good = due.join(loaded, "file_path", "left_semi").withColumn("reason", F.lit(None).cast("string"))
    found = good.unionByName(failed)
    return found if registry is None else normalized(found, registry)


def load_anatomical(
    store, root, atlas="4S456Parcels", registry=None, modalities=None,
    files_per_batch=None, on_batch=None, on_session=None, again=False,
) -> int:
    """Load new and changed tissue files. With a registry only its sessions, under their stored ids.

    Of several files for one session and tissue the first by path counts, in whatever order
    they arrive: the store drops the rows of the others when it reads or publishes.
    ``again`` loads all files, whatever the ledger says. Returns the number of files.
    """

    def parse(files):
        rows = anatomical_rows(files, atlas, modalities)
        if registry is not None:
            rows = normalized(rows, registry)
        return rows.withColumn("source", F.concat(F.lit("anatomical_"), "modality"))

    return _load_files(
        store, "anatomical", root, anatomical_glob(modalities),
        lambda f: anatomical_files(f, atlas, modalities), parse, registry, files_per_batch,
        again, on_batch, on_session,
    )


def load_diffusion(
    store, root, atlas="4S456Parcels", registry=None, workflows=None,
    files_per_batch=None, on_batch=None, on_session=None, again=False,
) -> int:
    """Load new and changed diffusion files of all or some workflows; returns their number."""

    def parse(files):
        rows = diffusion_rows(files, atlas, workflows)
        if registry is not None:
            rows = normalized(rows, registry)
        return rows.withColumn("source", F.concat(F.lit("diffusion_"), "workflow"))

    return _load_files(
        store, "diffusion", root, "*_parc.tsv", lambda f: diffusion_files(f, atlas, workflows),
        parse, registry, files_per_batch, again, on_batch, on_session,
    )


def ingest_stream(
    store, rows: DataFrame, source: str, checkpoint, on_batch=None, on_session=None
) -> None:
    """Load a stream of long rows (any streaming source) into one long table."""

    def load(batch: DataFrame, epoch: int) -> None:
        batch_id = store.batch_of(checkpoint, epoch)
        store.write_batch(batch.withColumn("source", F.lit(source)), batch_id)
        _after_batch(store, batch_id, on_batch, on_session)

    query = (
        rows.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
