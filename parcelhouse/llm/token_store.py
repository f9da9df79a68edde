"""Token ids in raw shard files, found by key through minimal perfect hash indexes.

Documents are dealt in ranges of ``doc_id`` and each task writes its ids, in that order, as raw
little-endian numbers behind a short header. Files get fresh names; only those that the table
of contents names count, so a task may be run again at any time.

An index finds documents by their ids. A document's key is a bijective hash of its id (and, where rows share an
id, their number in it), so distinct ids never share a key. Keys are dealt to index parts, and each part holds a
minimal perfect hash: levels of bit arrays in which a key owns a bit that no other key of the
level shares; the rank of its bit is its slot, and the slot has a fingerprint, how many rows share the id, the shard and the
place. A lookup touches a few bits and one slot, whatever the size of the store; an id that is
not there fails its fingerprint, save one in 2**32.

Files go to any file system Arrow reaches, below the shared scratch folder unless ``root``
says otherwise.

Defined results: a null text is an empty one; every text ends with the end id, so an empty one
has that id alone; rows that share an id are stored each, ordered by the hash of their texts, and a lookup of the id
finds them all; missing ids come first and are looked up as null. Two entries with one key, which only further rows of an id
can give, raise an error instead of losing one. An empty table gives an empty store. Texts of any length are stored
whole, a text being one block of a task. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelhouse.llm.pretokens import encoder
from parcelhouse.llm.scratch_tables import written
from parcelhouse.llm.text_arrays import blocks, mix
from parcelhouse.plans.scratch import scratch_path

_MAGIC, _HEADER = b"IDS1", 8
_SHARD_BYTES = 64 << 20
_BLOCK = 2 << 20
_PART_KEYS = 50_000
#: Bits of a level for each of its keys, and levels before the few keys left are listed.
_GAMMA, _LEVELS = 2, 40
_ENTRY = ("shard string, piece int, task int, doc_id bigint, inside bigint, offset bigint, "
          "n_tokens bigint")
#: What stands for a missing id before hashing.
_MISSING = np.uint64(0x6E756C6C206964)


def width_of(vocabulary: int) -> int:
    return 2 if vocabulary <= 1 << 16 else 4


class _Shard:
    def __init__(self, root: str, width: int):
        self.files, base = fs.FileSystem.from_uri(root)
        self.files.create_dir(base, recursive=True)
        self.name = f"{uuid.uuid4().hex}.ids"
        self.out = self.files.open_output_stream(f"{base}/{self.name}")
        self.out.write(_MAGIC + bytes([width]) + bytes(_HEADER - len(_MAGIC) - 1))
        self.at = _HEADER


def keys_of(docs, nth: np.ndarray) -> np.ndarray:
    """Keys of ids (``None`` for a missing one) and the number of a row among those of its id."""
    missing = np.array([d is None for d in docs], bool)
    ids = np.array([0 if d is None else d for d in docs], np.int64).view(np.uint64)
    return mix(mix(np.where(missing, ids ^ _MISSING, ids)) + _STEP * (2 * nth.astype(np.uint64) + missing))


#: Odd, so that steps from one key don't meet early.
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _writing(root: str, path: str, end_id: int):
    def write(batches):
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        coder, shard, piece, last, seen = encoder(path), None, -1, (), 0
        width = width_of(coder.size)
        for block in blocks(batches, size=_BLOCK):
            ids, count = coder.encode(block)
            n = len(count)
            text = np.repeat(np.arange(n), count)
            out = np.full(len(ids) + n, end_id, f"<u{width}")
            out[np.arange(len(ids)) + text] = ids
            count = count + 1
            if shard is None or shard.at > _SHARD_BYTES:
                if shard:
                    shard.out.close()
                shard, piece = _Shard(root, width), piece + 1
            shard.out.write(out.tobytes())
            offset = shard.at + (np.cumsum(count) - count) * width
            shard.at += int(count.sum()) * width
            docs = block.column("doc_id").to_pylist()
            inside = []
            for doc in docs:
                seen = seen + 1 if (doc,) == last else 0
                last = (doc,)
                inside.append(seen)
            yield pa.RecordBatch.from_arrays([
                pa.array([shard.name] * n), pa.array([piece] * n, pa.int32()),
                pa.array([task] * n, pa.int32()), pa.array(docs, pa.int64()),
                pa.array(inside, pa.int64()), pa.array(offset.astype(np.int64)), pa.array(count),
            ], names=["shard", "piece", "task", "doc_id", "inside", "offset", "n_tokens"])
        if shard:
            shard.out.close()

    return write


def perfect_hash(keys: np.ndarray):
    """Levels of bits (level sizes, all bits), the rank before every level's words, and the
    keys that no level could take."""
    sizes, bits, left, level = [], [], np.unique(keys), 0
    while len(left) and level < _LEVELS:
        size = max(64, (len(left) * _GAMMA + 63) // 64 * 64)
        at = _place(left, level, size)
        hits = np.bincount(at, minlength=size)
        bits.append(hits == 1)
        sizes.append(size)
        left = left[hits[at] > 1]
        level += 1
    return sizes, np.concatenate(bits) if bits else np.zeros(0, bool), left


def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    x = mix(keys + np.uint64(0x9E3779B97F4A7C15 * (level + 1) % (1 << 64)))
    return ((x >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)


def slots(keys: np.ndarray, sizes, bits: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """The slot of each key; any slot, or -1, for a key that was not indexed."""
    out = np.full(len(keys), -1, np.int64)
    rank = np.cumsum(bits) - 1
    open_, base = np.arange(len(keys)), 0
    for level, size in enumerate(sizes):
        at = base + _place(keys[open_], level, size)
        hit = bits[at]
        out[open_[hit]] = rank[at[hit]]
        open_ = open_[~hit]
        base += size
    if len(rest) and len(open_):
        at = np.minimum(np.searchsorted(rest, keys[open_]), len(rest) - 1)
        found = rest[at] == keys[open_]
        out[open_[found]] = int(bits.sum()) + at[found]
    return out


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix(keys ^ np.uint64(0xA5A5A5A5A5A5A5A5)) >> np.uint64(32)).astype(np.uint32)


_INDEX = ("part int, sizes array<int>, bits binary, rest binary, fingerprints binary, "
          "shards array<string>, shard binary, offset binary, n_tokens binary, rows binary")


def _index(key, table):
    keys = keys_of(table.column("doc_id").to_pylist(), table.column("nth").to_numpy())
    unique, first = np.unique(keys, return_index=True)
    if len(unique) < len(keys):
        raise ValueError(f"two entries of index part {key[0].as_py()} share a key")
    sizes, bits, rest = perfect_hash(unique)
    order = np.empty(len(unique), np.int64)
    order[slots(unique, sizes, bits, rest)] = np.arange(len(unique))
    pick = first[order]
    names, shard = np.unique(table.column("shard").to_numpy(zero_copy_only=False), return_inverse=True)

    def held(column):
        return [table.column(column).to_numpy()[pick].tobytes()]

    return pa.table({
        "part": pa.array([key[0].as_py()], pa.int32()),
        "sizes": pa.array([sizes], pa.list_(pa.int32())),
        "bits": [np.packbits(bits).tobytes()], "rest": [rest.tobytes()],
        "fingerprints": [fingerprints(unique[order]).tobytes()],
        "shards": [[str(x) for x in names]],
        "shard": [shard[pick].astype(np.uint32).tobytes()],
        "offset": held("offset"), "n_tokens": held("n_tokens"), "rows": held("rows"),
    })


_PLACE = "doc_id bigint, nth bigint, shard string, offset bigint, n_tokens bigint, rows bigint"


def _found(key, wanted, index):
    keys = keys_of(wanted.column("doc_id").to_pylist(), wanted.column("nth").to_numpy())
    names = ("offset", "n_tokens", "rows")
    shard, numbers = np.zeros(len(keys), object), {c: np.zeros(len(keys), np.int64) for c in names}
    hit = np.zeros(len(keys), bool)
    if index.num_rows and len(keys):
        row = {c: index.column(c)[0].as_py() for c in index.column_names}
        size = sum(row["sizes"])
        bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=size).astype(bool)
        slot = slots(keys, row["sizes"], bits, np.frombuffer(row["rest"], np.uint64))
        marks = np.frombuffer(row["fingerprints"], np.uint32)
        hit = (slot >= 0) & (slot < len(marks))
        hit[hit] = marks[slot[hit]] == fingerprints(keys[hit])
        at = slot[hit]
        shard[hit] = np.array(row["shards"], object)[np.frombuffer(row["shard"], np.uint32)[at]]
        for c in names:
            numbers[c][hit] = np.frombuffer(row[c], np.int64)[at]
    keep = pa.array(hit)
    return pa.table({
        "doc_id": wanted.column("doc_id").combine_chunks().filter(keep),
        "nth": wanted.column("nth").combine_chunks().filter(keep),
        "shard": pa.array(shard[hit], pa.string()),
        **{c: pa.array(numbers[c][hit]) for c in names},
    })


def _reading(root: str):
    def read(key, table):
        files, base = fs.FileSystem.from_uri(root)
        order = np.argsort(table.column("offset").to_numpy(), kind="stable")
        table = table.take(pa.array(order))
        first, crc = [], []
        with files.open_input_file(f"{base}/{key[0].as_py()}") as stored:
            header = stored.read_at(_HEADER, 0)
            if header[:4] != _MAGIC:
                raise ValueError(f"{base}/{key[0].as_py()} is no file of token ids")
            width = header[4]
            for offset, count in zip(*(table.column(c).to_pylist() for c in ("offset", "n_tokens"))):
                ids = np.frombuffer(stored.read_at(count * width, offset), f"<u{width}")
                first.append((offset - _HEADER) // width)
                crc.append(zlib.crc32(ids.astype("<u4").tobytes()))
        return pa.table({
            "doc_id": table.column("doc_id"), "nth": table.column("nth"), "shard": table.column("shard"),
            "inside": pa.array(first, pa.int64()), "n_tokens": table.column("n_tokens"),
            "ids_crc32": pa.array(crc, pa.int64()),
        })

    return read


class TokenStore:
    """A store of token ids: ``root`` holds the files, ``contents`` one row for each document,
    ``index`` one row for each part of the index."""

    def __init__(self, root: str, contents: DataFrame, index: DataFrame, parts: int):
        self.root, self.contents, self.index, self.parts = root, contents, index, parts

    def part_of(self):
        """The index part of a row; a further row of an id has a part of its own."""
        return F.pmod(F.xxhash64("doc_id", "nth"), F.lit(self.parts)).cast("int")

    def _looked_up(self, wanted: DataFrame) -> DataFrame:
        wanted = wanted.select("doc_id", "nth").withColumn("part", self.part_of())
        return wanted.groupBy("part").cogroup(self.index.groupBy("part")).applyInArrow(_found, _PLACE)

    def locate(self, ids: DataFrame) -> DataFrame:
        """Shard, byte offset and length of every row of each ``doc_id`` (null: those without id),
        numbered by ``nth``; ids not in the store give no row."""
        first = self._looked_up(ids.select(
            F.col("doc_id").cast("bigint").alias("doc_id"), F.lit(0).cast("bigint").alias("nth")))
        first = written(first, "located")
        more = first.where("rows > 1").select(
            "doc_id", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("rows") - 1)).alias("nth"))
        return first.unionByName(self._looked_up(more)).drop("rows")

    def digests(self, ids: DataFrame) -> DataFrame:
        """What the files hold for each ``doc_id``: place in its shard, number and crc of its ids."""
        return self.locate(ids).groupBy("shard").applyInArrow(
            _reading(self.root),
            "doc_id bigint, nth bigint, shard string, inside bigint, n_tokens bigint, ids_crc32 bigint")

    def ids(self) -> DataFrame:
        """Every id of the store once."""
        return self.contents.where("nth = 0").select("doc_id")

    def starts(self) -> DataFrame:
        """Tokens before each shard: shards follow each other by task, then by number. One row a task
        is ordered as a whole."""
        shards = self.contents.groupBy("task", "piece", "shard").agg(F.sum("n_tokens").alias("n"))
        before = Window.rowsBetween(Window.unboundedPreceding, -1)
        tasks = shards.groupBy("task").agg(F.sum("n").alias("n"))
        tasks = tasks.select("task", F.coalesce(
            F.sum("n").over(before.orderBy("task")), F.lit(0)).alias("earlier"))
        own = F.coalesce(F.sum("n").over(before.partitionBy("task").orderBy("piece")), F.lit(0))
        return shards.withColumn("own", own).join(tasks, "task").select(
            "shard", (F.col("own") + F.col("earlier")).alias("base"))


def _numbered(entries: DataFrame) -> DataFrame:
    """Entries with ``nth``, their number among all rows of their id, and ``rows``, how many there are.

    Only ids with several rows are looked at, and of those that several tasks wrote one row for each task.
    """
    sizes = entries.groupBy("doc_id", "task").agg((F.max("inside") + 1).alias("n"))
    id_ = Window.partitionBy("doc_id")
    several = sizes.withColumns({
        "rows": F.sum("n").over(id_),
        "before": F.coalesce(
            F.sum("n").over(id_.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    }).where("rows > 1")
    several = written(several.select(
        F.col("doc_id").alias("_id"), F.col("task").alias("_task"), "rows", "before"), "shared-ids")
    match = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("task") == F.col("_task"))
    return entries.join(several, match, "left").select(
        "shard", "piece", "task", "doc_id", "offset", "n_tokens",
        (F.col("inside") + F.coalesce("before", F.lit(0))).alias("nth"),
        F.coalesce("rows", F.lit(1)).cast("bigint").alias("rows"))


def store_tokens(docs: DataFrame, path: str, end_id: int = 0, root: str = None) -> TokenStore:
    """Encode every text with the tokenizer at ``path`` and write files, contents and index."""
    root = root or scratch_path(docs.sparkSession, "token-ids")
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text",
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    rows = rows.repartitionByRange("doc_id", "text_hash").sortWithinPartitions("doc_id", "text_hash")
    entries = written(rows.mapInArrow(_writing(root, path, end_id), _ENTRY), "entries")
    contents = written(_numbered(entries), "contents")
    parts = contents.count() // _PART_KEYS + 1
    store = TokenStore(root, contents, None, parts)
    keyed = contents.select("doc_id", "nth", "shard", "offset", "n_tokens", "rows").withColumn("part", store.part_of())
    store.index = written(keyed.groupBy("part").applyInArrow(_index, _INDEX), "index")
    return store
