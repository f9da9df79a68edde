"""Packed products, order MinHash and the prefix trie against brute force, edge cases included."""

import collections
import hashlib
import re
import struct
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

MASK = (1 << 64) - 1


# -- packed products -----------------------------------------------------------------

VECTORS = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("label", T.IntegerType()),
    T.StructField("embedding", T.ArrayType(T.DoubleType())),
    T.StructField("vector", T.StringType()), T.StructField("chunk", T.StringType()),
    T.StructField("group", T.StringType()), T.StructField("rank", T.StringType()),
])


@pytest.mark.parametrize("size,bound", [(64, 150), (1, 3_000_000_000), (3, 1_000_000_000), (7, 1), (300, 40_000)])
def test_packed_scores_are_exact(size, bound):
    from parcelhouse.llm.packed_products import Packed

    rng = np.random.default_rng(size)
    candidates, anchors = (rng.integers(-bound, bound, (n, size), endpoint=True) for n in (11, 4))
    candidates[0], anchors[0], candidates[1] = bound, bound, -bound
    packed = Packed(candidates, bound)
    if bound < 200:
        assert packed.fields > 1
    want = [[sum(int(x) * int(y) for x, y in zip(a, c)) for c in candidates] for a in anchors]
    assert packed.scores(anchors).tolist() == want


def _mined(rows):
    ok = {}
    for vec_id, label, vector in rows:
        if vec_id is None or label is None or vector is None or len(vector) != 4:
            continue
        if any(x is None or not np.isfinite(x) for x in vector):
            continue
        ok.setdefault(vec_id, []).append((label, tuple(vector)))
    ok = {k: min(v) for k, v in ok.items()}
    whole = {k: [int(np.floor(256 * x)) for x in v] for k, (_, v) in ok.items()}
    out = []
    for a in ok:
        if a % 50:
            continue
        score = {c: sum(x * y for x, y in zip(whole[a], whole[c])) for c in ok if c != a}
        order = sorted(score, key=lambda c: (-score[c], c))
        for p in [c for c in order if ok[c][0] == ok[a][0]][:5]:
            inside = [c for c in order if ok[c][0] != ok[a][0]
                      and 50 * score[p] <= 100 * score[c] <= 95 * score[p]][:3]
            out += [(a, p, r + 1, c, score[p], score[c]) for r, c in enumerate(inside)]
    return sorted(out)


def test_hard_negatives(spark):
    from parcelhouse.llm.packed_products import hard_negatives, usable

    rng = np.random.default_rng(2)
    rows = [(i - 100, int(rng.integers(0, 3)), [float(x) for x in rng.normal(size=4).round(1)]) for i in range(400)]
    rows += [(1000 + i, 1, [0.5, 0.5, 0.25, 0.0]) for i in range(60)]  # ties
    rows += [(2000 + i, 2, [0.5, 0.5, 0.0, 0.0]) for i in range(60)]
    rows += [
        (50, None, [1.0] * 4), (None, 1, [1.0] * 4), (51, 1, None), (52, 1, [1.0, None, 1.0, 1.0]),
        (53, 1, [1.0, float("nan"), 1.0, 1.0]), (54, 1, [float("inf")] * 4), (55, 1, [1.0, 2.0]), (56, 1, []),
        (100, 0, [0.0] * 4), (100, 0, [0.0] * 4), (150, 1, [1e6, -1e6, 3e6, 1.0]), (7, 2, [0.1] * 4),
        (57, 1, [1e300, 1.0, 1.0, 1.0]),
    ]
    df = spark.createDataFrame([(*r, "v", "c", "g", "r") for r in rows], VECTORS).repartition(5)
    ready = usable(df)
    got = hard_negatives(ready, ready.where("vec_id % 50 = 0"))
    columns = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    got = sorted(tuple(r[c] for c in columns) for r in got.collect())
    assert got == _mined([r for r in rows if r[0] != 57]) and len(got) > 50
    empty = usable(df.limit(0))
    assert hard_negatives(empty, empty).count() == 0


# -- order MinHash -------------------------------------------------------------------

def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def _chain(*values):
    seed = 42
    for v in values:
        if isinstance(v, str):
            raw = v.encode()
        else:
            raw = struct.pack("<q", v[0]) if isinstance(v, tuple) else struct.pack("<i", v)
        seed = xxhash.xxh64_intdigest(raw, seed=seed)
    return _signed(seed)


_SCRIPTS = "฀-๿⺀-鿿가-힯"
_SYMBOL = re.compile(f"[{_SCRIPTS}]|[^\x20\x09-\x0d{_SCRIPTS}]{{1,16}}")


def _elements(text):
    """Each of the 64 orders for itself: all numbered k-mers by their distance from where it starts."""
    symbols = _SYMBOL.findall(text)
    if not symbols:
        return [0] * 64
    grams = [_chain(*symbols[i : i + 5]) for i in range(max(1, len(symbols) - 4))]
    seen, numbered = collections.Counter(), []
    for place, g in enumerate(grams):
        h = _chain((g,), seen[g >> 28])
        seen[g >> 28] += 1
        numbered.append((((h >> 28) << 28 | place), place))
    out = []
    for j in range(-32, 32):
        least = sorted(numbered, key=lambda x: (x[0] - (j << 58)) & MASK)[:2]
        a, b = sorted(p for _, p in (least * 2)[:2])
        out.append(_chain((grams[a],), (grams[b],)) & 65535)
    return out


def _documents():
    rng = np.random.default_rng(9)
    prose = lambda n: " ".join(rng.choice(["ba", "tor", "rim", "schä", "é", "the", "x"], n))
    unique = lambda n: " ".join(f"w{i}" for i in rng.integers(0, 10**6, n))
    base = unique(300)
    texts = [None, "", " \n", "one", "two words", "a b c d e", prose(70), prose(2000), "x " * 500, "w" * 5000,
             "日本語のテキスト" * 40, "สวัสดีชาวโลก " * 9, "🙂🙂 mixed 한국어 text " * 7, base, base, base + " end",
             unique(40), unique(3000)]
    rows = [(i * 3 - 7, t) for i, t in enumerate(texts)]
    rows += [(8, "another text, same id"), (5, texts[4]), (5, texts[4]), (None, "no id"), (None, None), (None, "no id")]
    return rows


DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("next", T.StringType()), T.StructField("_id", T.StringType()),
    T.StructField("n_chars", T.StringType()), T.StructField("own", T.StringType()),
])


@pytest.fixture(scope="module")
def documents():
    return _documents()


def test_order_minhash(spark, documents):
    from parcelhouse.llm.order_minhash import fingerprints

    df = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in documents], DOCS).repartition(4)
    got = collections.Counter(tuple(r) for r in fingerprints(df).collect())

    def place(row):
        text = (row[1] or "").encode()
        h1 = _signed(xxhash.xxh64_intdigest(text, seed=42))
        return (row[0] is not None, row[0] or 0, h1)

    unique = sorted({(r[0], r[1] or "") for r in documents}, key=place, reverse=True)
    want = collections.Counter()
    hexed = lambda e: "".join(f"{x:04x}" for x in e)
    for i, (doc_id, text) in enumerate(unique):
        follower = unique[(i + 1) % len(unique)][1]
        third = len(text) // 3
        edited = text[: len(text) - third] + follower[:third]
        own, new, other = _elements(text), _elements(edited), _elements(follower)
        same = lambda a, b: sum(x == y for x, y in zip(a, b)) / 64
        copies = sum((r[0], r[1] or "") == (doc_id, text) for r in documents)
        want[(doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), hexed(own), hexed(new),
              same(own, new), same(own, other))] += copies
    assert got == want
    assert fingerprints(df.limit(0)).count() == 0
    alone = fingerprints(df.where("doc_id = 5 and text = 'two words'")).collect()
    assert {r.near_next for r in alone} == {1.0}


def test_likeness_follows_edits(spark):
    """A text with its halves exchanged keeps nearly all k-mers, but the pairs change their order."""
    from parcelhouse.llm.order_minhash import with_elements

    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in rng.integers(0, 10**6, 2000)]
    edited = words[:1000] + ["new"] + words[1000:]
    swapped = words[1000:] + words[:1000]
    texts = [words, edited, swapped, [f"v{w}" for w in words]]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "k int, text string")
    e = [r.e for r in with_elements(df, "text", "e").orderBy("k").collect()]
    near = [sum(a == b for a, b in zip(e[0], x)) / 64 for x in e]
    assert near[1] > 0.9 and 0.25 < near[2] < 0.75 and near[3] < 0.05


def test_very_long_text(spark):
    from parcelhouse.llm.order_minhash import with_elements

    df = spark.range(1).select(F.expr("repeat('some words of a long text and more ', 60000)").alias("text"))
    assert len(with_elements(df, "text", "e").first().e) == 64


def test_order_minhash_is_native(spark, documents):
    from parcelhouse.llm.order_minhash import with_elements

    plan = with_elements(spark.createDataFrame(documents[:3], "doc_id long, text string"), "text", "e")
    text = plan._jdf.queryExecution().toString()
    assert "Python" not in text and "Arrow" not in text


# -- prefix trie ---------------------------------------------------------------------

TURNS = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
    T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
    T.StructField("depth", T.StringType()), T.StructField("block", T.StringType()),
    T.StructField("t1", T.StringType()),
])


def _trie(rows):
    convs = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            convs[c].append((turn is not None, turn or 0, role, text[:64], tie, text))
    convs = {c: [(t[2], t[5]) for t in sorted(v)] for c, v in convs.items()}
    members = collections.defaultdict(list)
    for c in convs:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        path = tuple(convs.get(base, [])[:h] + convs[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].append((c, d == len(path)))
    out = []
    for node, held in members.items():
        below = [n for n in members if n[: len(node)] == node]
        leaves = [n for n in below if not any(len(m) == len(n) + 1 and m[: len(n)] == n for m in below)]
        saved = sum((len(members[n]) - 1) * len(re.findall(r"[^\x20\x09-\x0d]+", n[-1][1])) for n in below if n)
        ends = ",".join(str(c) for c in sorted(c for c, end in held if end))
        children = sum(len(n) == len(node) + 1 for n in below)
        parent = min(c for c, _ in members[node[:-1]]) if node else None
        out.append((min(c for c, _ in held), len(node), parent, len(held), children, len(leaves), saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def _turns():
    rng = np.random.default_rng(5)
    say = lambda: " ".join(rng.choice(["yes", "no", "why", "a\tb"], rng.integers(0, 4)))
    rows = []
    for c in range(-25, 70):
        if c % 20 == 0 and c > 20:
            continue  # bases that don't exist
        for turn in range(int(rng.integers(1, 7))):
            rows.append((c, turn, "user" if turn % 2 == 0 else "bot", say()))
    long = [(t, "user", say()) for t in range(40)]
    rows += [(c, *t) for c in (100, 101, 103, 4096, 9000) for t in long]
    rows += [(100, 40, "bot", "one more"), (101, 40, "bot", "and another"), (101, 41, None, "x y z")]
    rows += [(77, None, None, None), (77, None, "user", "first"), (77, 3, "user", None), (77, 3, "bot", "tie"),
             (77, 3, "user", ""), (77, 3, "user", "rep"), (77, 3, "user", "rep"), (None, 1, "user", "nobody")]
    return rows


@pytest.mark.parametrize("partitions", ["3", "40"])
def test_prefix_trie(spark, partitions):
    from parcelhouse.llm.prefix_rollup import ordered_turns, prefix_trie, rebuilt

    rows = _turns()
    df = spark.createDataFrame([(*r, "d", "b", "t") for r in rows], TURNS).repartition(6)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(partitions == "3").lower())
    try:
        got = prefix_trie(rebuilt(ordered_turns(df))).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    assert sorted((tuple(r[c] for c in columns) for r in got), key=str) == _trie(rows)


def test_prefix_trie_of_nothing(spark):
    from parcelhouse.llm.prefix_rollup import ordered_turns, prefix_trie, rebuilt

    df = spark.createDataFrame([], TURNS)
    assert prefix_trie(rebuilt(ordered_turns(df))).count() == 0
    # Alone with a base that isn't there, a conversation may be left without a turn: a root that is a leaf.
    alone = next(c for c in range(21, 99) if c % 20 and zlib.crc32(str(c).encode()) % 4)
    df = spark.createDataFrame([(alone, 0, "user", "hello", None, None, None)], TURNS)
    got = prefix_trie(rebuilt(ordered_turns(df))).collect()
    assert [(r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves) for r in got] == [
        (alone, 0, None, 1, 0, 1)]
    assert got[0].ends_sha256 == hashlib.sha256(str(alone).encode()).hexdigest()
