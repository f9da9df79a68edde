"""Repeated passages by prefix-free parsing: phrases, their dictionary, its sorted suffixes.

A rolling hash of 24 bytes gives the triggers: the least hash among the 27 inside a string of
50 bytes. Consecutive 50-byte strings with one trigger make a phrase, and neighbouring phrases
overlap by 49 bytes, so every 50-byte string lies in exactly one phrase of its text and
equal strings lie in phrases of equal triggers. A phrase is a few dozen bytes, but as long as a run of
one character.

1. Every text is parsed once. Within a task, a phrase is sent on for its smallest document
   only (later ones are repeats already), so a passage that a third of all texts hold sends one entry a task.
2. Entries meet by trigger. Equal phrases: all but the smallest document's are repeats as a
   whole. Different phrases on one trigger form the dictionary that still needs its suffixes.
3. Those dictionary phrases (mostly the edges of repeats) are fetched from the texts. Per trigger their
   suffixes of at least 50 bytes are sorted by their bytes; neighbours that agree in 50 bytes
   share a class, and its smallest document keeps it. At depth 50 the dictionary alone
   decides the corpus order: a suffix of a phrase never ends inside the 50 bytes, so ties
   that full suffix sorting would settle by the parse are exactly the equal strings wanted here.
4. Each text is cut by its repeated strings.

Dictionary entries are compared by 88 hash bits and the bits of their part, suffixes byte by byte.
All tables are dealt by hash; parts and buckets grow in number with the bytes of the input,
not in size.

Defined results: null is an empty text; texts under 50 bytes lose nothing; rows that share an
id never take from each other, each is judged for itself; a missing id counts as the largest. Only ``doc_id``
and ``text`` are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelhouse.llm.scratch_tables import written
from parcelhouse.llm.text_arrays import Roller, blocks, mix

LENGTH, TRIGGER = 50, 24
_WINDOW = LENGTH - TRIGGER + 1
_PART_BYTES = 2 << 20
_FLUSH = 1 << 19
_LAST = (1 << 63) - 1
_NONE = np.uint64((1 << 64) - 1)
_WHOLE, _DETAIL = 0, 1


def _home(doc: np.ndarray, check: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of a text; rows that share an id (or have none) are spread by their texts."""
    return (doc % buckets + check.astype(np.int64)) % buckets


def _slide(op, x: np.ndarray, width: int) -> np.ndarray:
    """``op`` over every run of ``width`` neighbours, by doubling."""
    done, out = 1, x
    while done * 2 <= width:
        out = op(out[: len(out) - done], out[done:])
        done *= 2
    if done < width:
        rest = width - done
        out = op(out[: len(out) - rest], out[rest:])
    return out


def pack(*arrays: np.ndarray) -> bytes:
    """Unsigned integers, each column in as few bytes as its largest value needs."""
    n = len(arrays[0])
    widths = [max(1, (int(a.max()).bit_length() + 7) // 8) if n else 1 for a in arrays]
    body = [np.ascontiguousarray(a, "<u8").view(np.uint8).reshape(n, 8)[:, :w].tobytes()
            for a, w in zip(arrays, widths)]
    return bytes(widths) + b"".join(body)


def unpack(data: bytes, columns: int, n: int) -> list[np.ndarray]:
    at, out = columns, []
    for w in data[:columns]:
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :w] = np.frombuffer(data, np.uint8, n * w, at).reshape(n, w)
        out.append(wide.view("<u8").ravel())
        at += n * w
    return out


def _gathered(table: pa.Table, columns: int) -> list[np.ndarray]:
    """The packed columns of all rows; the first one as signed numbers above the row's base."""
    parts = [[np.zeros(0, np.int64), *[np.zeros(0, np.uint64)] * (columns - 1)]]
    for n, base, body in zip(*(table.column(c).to_pylist() for c in ("n", "base", "body"))):
        first, *rest = unpack(body, columns, n)
        parts.append([first.view(np.int64) + base, *rest])
    return [np.concatenate(c) for c in zip(*parts)]


def parse(block, roller: Roller):
    """Phrases of a block: text number, first byte, number of 50-byte strings, trigger, hash."""
    n, sums = len(block.data), roller.sums(block.data)
    sizes = np.diff(block.offsets)
    if n < LENGTH:
        return [np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)] * 2
    last = np.repeat(block.offsets[1:], sizes)
    at = np.arange(n - TRIGGER + 1)
    hashes = roller.spans(sums, at, at + TRIGGER)
    least = _slide(np.minimum, hashes, _WINDOW)
    inside = at[: len(least)] + LENGTH <= last[: len(least)]
    text_start = np.zeros(n + 1, bool)
    text_start[block.offsets] = True
    new = inside.copy()
    new[1:] &= (least[1:] != least[:-1]) | text_start[1 : len(least)] | ~inside[:-1]
    start = np.flatnonzero(new)
    stop = np.concatenate((start[1:], [len(least)]))
    text = np.searchsorted(block.offsets, start, "right") - 1
    stop = np.minimum(stop, block.offsets[text + 1] - LENGTH + 1)
    phrase = roller.spans(sums, start, stop + LENGTH - 1)
    return text, start - block.offsets[text], stop - start, least[start], phrase


def _rows(kind, part, n, base, body):
    return pa.RecordBatch.from_arrays(
        [pa.array(kind, pa.int32()), pa.array(part, pa.int32()), pa.array(n, pa.int32()),
         pa.array(base, pa.int64()), pa.array(body, pa.binary())],
        names=["kind", "part", "n", "base", "body"])


_ROW = "kind int, part int, n int, base bigint, body binary"


def _dealt(kind: int, part: np.ndarray, doc: np.ndarray, *columns: np.ndarray):
    """One packed row for each value of ``part``."""
    order = np.argsort(part, kind="stable")
    part, doc, columns = part[order], doc[order], [c[order] for c in columns]
    cuts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1], [True])))
    parts, sizes, bases, bodies = [], [], [], []
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        base = int(doc[a:b].min())
        parts.append(int(part[a]))
        sizes.append(b - a)
        bases.append(base)
        bodies.append(pack((doc[a:b] - base).view(np.uint64), *(c[a:b] for c in columns)))
    return _rows([kind] * len(parts), parts, sizes, bases, bodies)


def _parsed(bits: int, buckets: int):
    shift, low = np.uint64(64 - bits), np.uint64((1 << 40) - 1)

    def entries(held):
        text, doc, check, at, count, trigger, phrase = (np.concatenate(c) for c in zip(*held))
        order = np.lexsort((doc, phrase, trigger))
        doc, check, at, count, trigger, phrase = (
            c[order] for c in (doc, check, at, count, trigger, phrase))
        new = np.concatenate(
            ([True], (trigger[1:] != trigger[:-1]) | (phrase[1:] != phrase[:-1])))
        least = doc[new][np.cumsum(new) - 1]
        own = doc == least
        # A least hash has few high bits; mixed, triggers fill all parts alike.
        key = mix(trigger[own])
        yield _dealt(0, (key >> shift).astype(np.int64), doc[own], key & low,
                     phrase[own] >> np.uint64(16), check[own], at[own], count[own])
        if not own.all():
            late = ~own
            yield _dealt(0, -1 - _home(doc[late], check[late], buckets), doc[late], check[late], at[late], count[late])

    def parsed(batches):
        roller, held, size = Roller(), [], 0
        for block in blocks(batches):
            text, at, count, trigger, phrase = parse(block, roller)
            if not len(text):
                continue
            ids = block.column("doc_id").to_numpy(zero_copy_only=False)
            check = block.column("check").to_numpy(zero_copy_only=False).astype(np.uint64)
            held.append((text, ids[text], check[text], at.astype(np.uint64),
                         count.astype(np.uint64), trigger, phrase))
            size += len(text)
            if size >= _FLUSH:
                yield from entries(held)
                held, size = [], 0
        if held:
            yield from entries(held)

    return parsed


def _compared(buckets: int):
    def compared(key, table):
        part = key[0].as_py()
        if part < 0:
            doc, check, at, count = _gathered(table, 4)
            return pa.Table.from_batches(
                [_dealt(_WHOLE, _home(doc, check, buckets), doc, check, at, count, np.zeros_like(at))])
        doc, trigger, phrase, check, at, count = _gathered(table, 6)
        order = np.lexsort((doc, phrase, trigger))
        doc, trigger, phrase, check, at, count = (
            c[order] for c in (doc, trigger, phrase, check, at, count))
        new_trigger = np.concatenate(([True], trigger[1:] != trigger[:-1]))
        new = new_trigger | np.concatenate(([True], phrase[1:] != phrase[:-1]))
        own = doc == doc[new][np.cumsum(new) - 1]
        out = []
        if not own.all():
            x = ~own
            out.append(_dealt(_WHOLE, _home(doc[x], check[x], buckets), doc[x], check[x], at[x], count[x],
                              np.zeros(int(x.sum()), np.uint64)))
        first = np.flatnonzero(new_trigger)
        owners = np.where(own, doc, doc[new][np.cumsum(new) - 1])
        several = np.minimum.reduceat(owners, first) < np.maximum.reduceat(owners, first)
        x = own & several[np.cumsum(new_trigger) - 1]
        if x.any():
            out.append(_dealt(_DETAIL, _home(doc[x], check[x], buckets), doc[x], check[x], at[x], count[x],
                              (np.uint64(part) << np.uint64(40)) | trigger[x]))
        return pa.Table.from_batches(out or [_rows([], [], [], [], [])])

    return compared


def _per_text(texts: pa.Table, entries: list[np.ndarray]):
    """Each text's number, id and the entries (sorted by document) that are its own."""
    doc, check, *rest = entries
    order = np.argsort(doc, kind="stable")
    doc, check, rest = doc[order], check[order], [c[order] for c in rest]
    ids, checks = (texts.column(c).to_numpy() for c in ("doc_id", "check"))
    low, high = np.searchsorted(doc, ids, "left"), np.searchsorted(doc, ids, "right")
    for i, (a, b) in enumerate(zip(low.tolist(), high.tolist())):
        mine = check[a:b] == np.uint64(checks[i])
        yield i, ids[i], [c[a:b][mine].astype(np.int64) for c in rest]


def _fetched(key, texts, entries):
    """The bytes of the dictionary phrases that need their suffixes."""
    column = texts.column("text")
    keys, docs, checks, ats, slices = [], [], [], [], []
    check = texts.column("check").to_pylist()
    for i, doc, (at, count, trigger) in _per_text(texts, _gathered(entries, 5)):
        if not len(at):
            continue
        data = column[i].as_py()
        keys += trigger.tolist()
        docs += [int(doc)] * len(at)
        checks += [check[i]] * len(at)
        ats += at.tolist()
        slices += [data[a : a + c + LENGTH - 1] for a, c in zip(at.tolist(), count.tolist())]
    return pa.table({
        "trigger": pa.array(keys, pa.int64()), "doc_id": pa.array(docs, pa.int64()),
        "check": pa.array(checks, pa.int32()), "at": pa.array(ats, pa.int64()),
        "phrase": pa.array(slices, pa.binary()),
    })


_PHRASE = "trigger bigint, doc_id bigint, check int, at bigint, phrase binary"


def suffix_order(data: np.ndarray, start: np.ndarray, major: np.ndarray):
    """Order of the suffixes at ``start`` by ``major``, then by their first 50 bytes, and
    which of them begin a new class of equal ones."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    words = []
    for a in range(0, LENGTH, 8):
        wide = np.zeros((len(start), 8), np.uint8)
        size = min(8, LENGTH - a)
        for b in range(size):
            wide[:, b] = padded[start + a + b]
        words.append(wide.view(">u8").ravel().astype(np.uint64))
    order = np.lexsort((*words[::-1], major))
    new = np.zeros(len(order), bool)
    new[:1] = True
    for column in (major, *words):
        column = column[order]
        new[1:] |= column[1:] != column[:-1]
    return order, new


def _settled(buckets: int):
    def settled(key, table):
        column = table.column("phrase").combine_chunks().cast(pa.large_binary())
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
        offsets = np.frombuffer(column.buffers()[1], np.int64)[
            column.offset : column.offset + len(column) + 1]
        data = np.frombuffer(column.buffers()[2], np.uint8)
        count = np.diff(offsets) - (LENGTH - 1)
        which = np.repeat(np.arange(len(count)), count)
        inner = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
        trigger, doc, check, at = (
            table.column(c).to_numpy() for c in ("trigger", "doc_id", "check", "at"))
        order, new = suffix_order(data, offsets[which] + inner, trigger[which])
        which, inner = which[order], inner[order]
        mine = doc[which]
        least = np.minimum.reduceat(mine, np.flatnonzero(new))[np.cumsum(new) - 1]
        late = mine > least
        which, start = which[late], (at[which] + inner)[late]
        order = np.lexsort((start, which))
        which, start = which[order], start[order]
        if not len(which):
            return pa.Table.from_batches([_rows([], [], [], [], [])])
        new = np.concatenate(
            ([True], (which[1:] != which[:-1]) | (start[1:] != start[:-1] + 1)))
        first = np.flatnonzero(new)
        size = np.diff(np.concatenate((first, [len(new)])))
        which, start = which[first], start[first]
        return pa.Table.from_batches([_dealt(
            _WHOLE, _home(doc[which], check[which], buckets), doc[which], check[which].astype(np.uint64),
            start.astype(np.uint64), size.astype(np.uint64), np.zeros(len(size), np.uint64))])

    return settled


def _cut(keep_text: bool):
    def cut(key, texts, entries):
        column = texts.column("text")
        removed, spans, digests, kept_texts = [], [], [], []
        for i, _, (at, count, _) in _per_text(texts, _gathered(entries, 5)):
            data = column[i].as_py() or b""
            whole = np.frombuffer(data, np.uint8)
            if len(at):
                edge = np.zeros(len(data) + 1, np.int64)
                np.add.at(edge, at, 1)
                np.add.at(edge, at + count + LENGTH - 1, -1)
                gone = np.cumsum(edge[:-1]) > 0
                spans.append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
                removed.append(int(gone.sum()))
                if keep_text:
                    character = np.cumsum((whole & 0xC0) != 0x80)
                    gone = np.isin(character, character[gone])
                kept = whole[~gone].tobytes()
            else:
                spans.append(0)
                removed.append(0)
                kept = data
            if keep_text:
                kept_texts.append(kept)
            else:
                digests.append(hashlib.sha256(kept).hexdigest())
        out = {
            "row": texts.column("row"),
            "n_bytes": pa.array([len(x.as_py() or b"") for x in column], pa.int64()),
            "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(spans, pa.int64()),
        }
        if keep_text:
            out["kept"] = pa.array(kept_texts, pa.binary())
        else:
            out["kept_sha256"] = pa.array(digests, pa.string())
        return pa.table(out)

    return cut


def repeated_passages(docs: DataFrame, carry: tuple[str, ...] = (), keep_text: bool = False):
    """Per row ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256``, or with
    ``keep_text`` the remaining bytes as ``kept``, where a character that lost a byte is gone as a
    whole. ``carry`` names further columns to return."""
    texts = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LAST)).alias("doc_id"),
        F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("text"),
        F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(1 << 16)).cast("int").alias("check"),
        F.struct(F.col("doc_id"), *(F.col(c) for c in carry)).alias("row"),
    )
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(1, (size // _PART_BYTES).bit_length())
    buckets = (1 << bits) + 1
    entries = texts.select("doc_id", "text", "check").mapInArrow(_parsed(bits, buckets), _ROW)
    found = written(entries.groupBy("part").applyInArrow(_compared(buckets), _ROW), "phrases")

    home = F.pmod(F.pmod(F.col("doc_id"), F.lit(buckets)) + F.col("check"), F.lit(buckets))
    placed = texts.withColumn("part", home.cast("int"))
    whole, detail = (found.where(F.col("kind") == k) for k in (_WHOLE, _DETAIL))
    phrases = placed.drop("row").groupBy("part").cogroup(detail.groupBy("part")).applyInArrow(
        _fetched, _PHRASE)
    phrases = written(phrases, "dictionary")
    parts = F.pmod(F.xxhash64("trigger"), F.lit(1 << bits)).cast("int")
    edges = written(
        phrases.withColumn("part", parts).groupBy("part").applyInArrow(_settled(buckets), _ROW),
        "suffixes")
    last = T.StructField("kept", T.BinaryType()) if keep_text else T.StructField("kept_sha256", T.StringType())
    counts = [T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")]
    result = placed.groupBy("part").cogroup(whole.union(edges).groupBy("part")).applyInArrow(
        _cut(keep_text), T.StructType([texts.schema["row"], *counts, last]))
    return result.select("row.*", "n_bytes", "n_removed", "n_spans", last.name)
