"""Order MinHash fingerprints, in DataFrame functions only.

A text is a sequence of symbols: words, long ones cut every 16 characters, and single characters
of scripts that are written without blanks. Its k-mers are runs of five symbols, each numbered by
how often the same run has occurred before in the text. An order of the hashed, numbered k-mers selects the two least; what is
kept of them is their order in the text, and the ordered pair is hashed to one element of the fingerprint.
So an element survives only if both k-mers stay and stay in order, which follows the edit
distance, not just the set of k-mers.

The 64 orders are rotations of one: order j starts at the j-th 64th of the range of hashes and
runs round it. One sort serves them all, as the two least of every order are among the two least
of each 64th; each order for itself is as random as a fresh hash.

Only arrays inside a row are used; texts meet their neighbours by joins on (id, hash of text).

Defined results: a null text is an empty one; texts without a symbol share one fingerprint; a text of fewer
than five symbols is a single k-mer; equal texts have equal fingerprints. Texts of any length are read whole
(places take 28 bits: 268 million symbols a text). K-mers of one text are told apart by 36 bits. Elements have 16 bits, so unrelated ones agree once in
65536. Rows that share id and text count as one document and get equal rows, as many as they are; documents that share
an id follow each other by the hash of their text; documents without an id come last in descending order. A
single document is its own neighbour. An empty table gives no rows. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelhouse.llm.scratch_tables import written

ELEMENTS, _BIN_BITS, _K = 64, 6, 5
_PLACE_BITS = 28
_LOW = (1 << _PLACE_BITS) - 1
#: Han, kana, Hangul and Thai characters are symbols each for themselves.
_SCRIPTS = r"\u0E00-\u0E7F\u2E80-\u9FFF\uAC00-\uD7AF"
SYMBOL = rf"[{_SCRIPTS}]|[^\x20\x09-\x0D{_SCRIPTS}]{{1,16}}"
_KEYS = ("_known", "_id", "_h1", "_h2")


def with_elements(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add ``name``: the elements of the fingerprint of ``text`` (not null), an array of ints."""
    grams = ", ".join(f"_symbols[i + {n}]" for n in range(_K))
    first, last = -(ELEMENTS // 2), ELEMENTS // 2 - 1
    bin_of = f"cast(shiftright({{}}, {64 - _BIN_BITS}) AS int)"
    steps = (
        ("_symbols", f"regexp_extract_all(`{text}`, r'{SYMBOL}', 0)"),
        ("_grams", f"""CASE WHEN size(_symbols) = 0 THEN array()
            WHEN size(_symbols) < {_K} THEN array(xxhash64(_symbols))
            ELSE transform(sequence(0, size(_symbols) - {_K}), i -> xxhash64({grams})) END"""),
        # Only where a k-mer repeats are the places sorted by k-mer to number its occurrences.
        ("_sorted", f"""CASE WHEN size(array_distinct(_grams)) < size(_grams) THEN
            sort_array(transform(_grams, (g, i) -> (g & ~{_LOW}L) | i)) END"""),
        ("_starts", f"""filter(sequence(0, size(_sorted) - 1), i ->
            i = 0 OR (_sorted[i] & ~{_LOW}L) <> (_sorted[i - 1] & ~{_LOW}L))"""),
        ("_nth", """flatten(transform(_starts, (s, i) ->
            sequence(0, coalesce(get(_starts, i + 1), size(_sorted)) - s - 1)))"""),
        ("_order", f"""CASE WHEN _sorted IS NULL THEN
            sort_array(transform(_grams, (g, i) -> (xxhash64(g, 0) & ~{_LOW}L) | i))
            ELSE sort_array(zip_with(_sorted, _nth, (x, n) ->
                (xxhash64(_grams[cast(x & {_LOW}L AS int)], n) & ~{_LOW}L) | (x & {_LOW}L))) END"""),
        ("_least", f"""filter(_order, (x, i) ->
            i < 2 OR {bin_of.format("x")} <> {bin_of.format("_order[i - 2]")})"""),
        ("_bins", f"transform(_least, x -> {bin_of.format('x')})"),
        ("_heads", """CASE WHEN size(_bins) > 0 THEN filter(sequence(0, size(_bins) - 1), i ->
            i = 0 OR _bins[i] <> _bins[i - 1]) END"""),
        # Where each order begins: at its own 64th, or the next one that has k-mers.
        ("_begin", f"""flatten(concat(
            transform(_heads, (p, i) -> array_repeat(p,
                _bins[p] - CASE WHEN i = 0 THEN {first - 1} ELSE _bins[_heads[i - 1]] END)),
            array(array_repeat(0, {last} - _bins[size(_bins) - 1]))))"""),
        ("_pairs", f"""transform(_begin, p -> array_sort(array(
            cast(_least[p] & {_LOW}L AS int),
            cast(_least[(p + 1) % size(_least)] & {_LOW}L AS int))))"""),
        (name, f"""CASE WHEN size(_grams) = 0 THEN array_repeat(0, {ELEMENTS}) ELSE
            transform(_pairs, p -> cast(xxhash64(_grams[p[0]], _grams[p[1]]) & 65535 AS int)) END"""),
    )
    # A step whose array would be missing is not reached by the next one's lambda.
    guarded = {"_starts": "_sorted", "_begin": "_heads"}
    keep = df.columns
    for step, sql in steps:
        if step in guarded:
            sql = f"CASE WHEN {guarded[step]} IS NOT NULL THEN {sql} END"
        df = df.withColumn(step, F.expr(sql))
    return df.select(*keep, name)


def fingerprint(elements: str) -> Column:
    """Four hexadecimal digits an element."""
    return F.expr(f"array_join(transform({elements}, e -> right(lower(hex(65536 + e)), 4)), '')")


def likeness(a: str, b: str) -> Column:
    """The share of elements that agree."""
    return F.expr(f"size(filter(zip_with({a}, {b}, (x, y) -> x = y), e -> e)) / double({ELEMENTS})")


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    doc_id = F.col("doc_id").cast("bigint")
    return docs.select(
        doc_id.isNotNull().cast("int").alias("_known"), F.coalesce(doc_id, F.lit(0)).alias("_id"),
        F.xxhash64(text).alias("_h1"), F.hash(text).alias("_h2"), text.alias("text"))


def _neighbours(keyed: DataFrame) -> DataFrame:
    """Every document's key, length and number of copies, with ``next``: the key before it in ascending order
    (of the least: the greatest). Ranges are ordered apart; one row for each range links them."""
    keys = keyed.groupBy(*_KEYS).agg(
        F.first(F.length("text")).cast("bigint").alias("n_chars"), F.count("*").alias("copies"))
    ranges = written(
        keys.repartitionByRange(*_KEYS).select("*", F.spark_partition_id().alias("_range")), "ranges")
    ends = ranges.groupBy("_range").agg(F.max(F.struct(*_KEYS)).alias("last")).orderBy("_range").collect()
    before = [(r["_range"], tuple(ends[i - 1]["last"])) for i, r in enumerate(ends)]
    key = ", ".join(f"{n}: {ranges.schema[n].dataType.simpleString()}" for n in _KEYS)
    before = keyed.sparkSession.createDataFrame(before, f"_range int, before struct<{key}>")
    order = Window.partitionBy("_range").orderBy(*_KEYS)
    inside = F.lag(F.struct(*_KEYS)).over(order)
    return ranges.join(before, "_range").withColumn("next", F.coalesce(inside, "before")).drop("_range", "before")


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    The edited text ends, for a third of its characters, with the beginning of the next document
    in descending order of ids.
    """
    keyed = _keyed(docs)
    links = written(_neighbours(keyed), "neighbours")
    # Copies are joined into one before the shuffle; both joins below read the same exchange.
    texts = keyed.groupBy(*_KEYS).agg(F.first("text").alias("text"))
    asked = links.select(
        *(F.col(f"next.{k}").alias(k) for k in _KEYS), F.struct(*_KEYS).alias("to"),
        F.expr("cast(n_chars div 3 AS int)").alias("_size"))
    heads = texts.join(asked, list(_KEYS)).select("to.*", F.expr("left(text, _size)").alias("_head"))
    both = texts.join(heads, list(_KEYS)).withColumn(
        "_edited", F.expr("concat(left(text, length(text) - length(text) div 3), _head)"))
    both = with_elements(with_elements(both, "text", "own"), "_edited", "edited")
    made = written(both.select(
        *_KEYS, "own", fingerprint("edited").alias("edited_fingerprint"),
        likeness("own", "edited").alias("near_edited"),
        F.sha2("_edited", 256).alias("edited_sha256")), "elements")
    other = made.select(F.struct(*_KEYS).alias("next"), F.col("own").alias("others"))
    done = made.join(links, list(_KEYS)).join(other, "next")
    return done.select(
        F.expr("CASE WHEN _known = 1 THEN _id END").alias("doc_id"), "n_chars", "edited_sha256",
        fingerprint("own").alias("fingerprint"), "edited_fingerprint", "near_edited",
        likeness("own", "others").alias("near_next"),
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("_copy")).drop("_copy")
