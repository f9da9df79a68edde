"""The prefix trie of conversations by ROLLUP over positional columns.

Every conversation is cut into blocks of eight turns, one row each, whose columns ``t1`` to ``t8`` hold the
turns' ids (a 128-bit hash of role and text). ``GROUP BY block, prior, ROLLUP (t1, ..., t8)`` then aggregates all
prefixes of a block together, and ``grouping_id`` tells how long each is; ``prior`` is the
node that the blocks before lead to. The key of a node is the exclusive or of two independent 64-bit
hashes of (turn id, place) over its path, so a block finds its prior node without waiting for other blocks.

What is summed over subtrees takes a second ROLLUP: every node's value stands in a row with its path,
under its smallest member, and the sums of a member's later blocks stand in the rows of its earlier ones.

Turns are ranked by ranges, so a long conversation is split over tasks; only its block rows, an eighth
of them and without texts, meet in a window. Ids of conversations that end in one node are joined in pieces of
at most 4096 and hashed piece by piece as a sorted stream.

Defined results: a null role or text is an empty one; rows without ``conv_id`` take no part; turns that share a number
are ordered by role, by the first 64 characters of the text, then by hash; repeated rows are turns each. Texts of any
length count whole. An empty table gives no node, not even a root. Only the four named columns are read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelhouse.llm.scratch_tables import written

_BLOCK = 8
_TURNS = tuple(f"t{i}" for i in range(1, _BLOCK + 1))
_WORDS = tuple(f"w{i}" for i in range(1, _BLOCK + 1))
_PLACE = ("conv_id", "turn", "role", "head", "turn_id")
#: Low bits of a conversation's id that share a piece of the list of ends.
_PIECE_BITS = 12
_EMPTY_HASH = hashlib.sha256(b"").hexdigest()


def ordered_turns(df: DataFrame) -> DataFrame:
    """``conv_id, pos, turn_id, n_words``: turns by place (from 1), without their texts."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = df.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        role.alias("role"), F.left(text, F.lit(64)).alias("head"),
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("turn_id"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("n_words"))
    turns = written(
        turns.repartitionByRange(*(F.col(c).asc_nulls_first() for c in _PLACE))
        .select("*", F.spark_partition_id().alias("part")), "turns")
    sizes = turns.groupBy("conv_id", "part").count()
    before = F.sum("count").over(
        Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    # Only conversations cut by the end of a range have rows here: at most one for each range.
    offsets = written(sizes.withColumn("offset", before).where("offset > 0").drop("count"), "offsets")
    inside = F.row_number().over(
        Window.partitionBy("conv_id", "part").orderBy(*(F.col(c).asc_nulls_first() for c in _PLACE[1:])))
    return turns.withColumn("inside", inside).join(offsets, ["conv_id", "part"], "left").select(
        "conv_id", (F.coalesce("offset", F.lit(0)) + F.col("inside")).cast("bigint").alias("pos"),
        "turn_id", "n_words")


def rebuilt(turns: DataFrame) -> DataFrame:
    """Conversations with other beginnings, in the columns of ``ordered_turns``.

    Conversation c takes the first h turns of c - c % 20 for its own first h; h is the crc32 of c
    as text, modulo 4. A row without place and turn stands for the conversation itself.
    """
    turns = written(turns, "places")
    h = F.crc32(F.col("conv_id").cast("string")) % 4
    base = F.col("conv_id") - F.col("conv_id") % 20
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    lengths = convs.where("conv_id % 20 = 0").select(F.col("conv_id").alias("base"), F.least("n", F.lit(3)).alias("n_base"))
    # One row a conversation; a base is shared by twenty (the base 0: by 39).
    convs = written(
        convs.select("conv_id", h.alias("h"), base.alias("base")).join(lengths, "base", "left")
        .withColumn("short", F.col("h") - F.least("h", F.coalesce("n_base", F.lit(0)))), "conversations")
    short = convs.where("short > 0").select("conv_id", "short")
    own = turns.where(F.col("pos") > h).join(short, "conv_id", "left").select(
        "conv_id", (F.col("pos") - F.coalesce("short", F.lit(0))).alias("pos"), "turn_id", "n_words")
    heads = turns.where((F.col("pos") <= 3) & (F.col("conv_id") % 20 == 0)).withColumnRenamed("conv_id", "base")
    given = heads.join(convs, "base").where(F.col("pos") <= F.col("h"))
    none = convs.select("conv_id", F.lit(None).cast("bigint").alias("pos"),
                        F.lit(None).cast("binary").alias("turn_id"), F.lit(None).cast("bigint").alias("n_words"))
    return own.unionByName(given.select(*own.columns)).unionByName(none)


def _hashes(turn: str, place: str) -> tuple[str, str]:
    return f"xxhash64({turn}, {place})", f"xxhash64({place}, {turn})"


def blocks(turns: DataFrame) -> DataFrame:
    """One row for each conversation and block: the prior node, the turns' ids and words, the number of
    turns (``held``, 9 if more blocks follow) and, in the last block, the node where it ends."""
    block = F.coalesce(F.expr(f"(pos - 1) div {_BLOCK}"), F.lit(0))
    a, b = (F.expr(x) for x in _hashes("turn_id", "pos"))
    rows = turns.select("conv_id", block.cast("bigint").alias("block"), F.when(
        F.col("pos").isNotNull(), F.struct("pos", "turn_id", "n_words")).alias("item"), a.alias("a"), b.alias("b"),
        F.col("pos").isNotNull().alias("real"))
    rows = rows.groupBy("conv_id", "block").agg(
        F.sort_array(F.collect_list("item")).alias("items"),
        *(F.coalesce(F.bit_xor(F.when(F.col("real"), F.col(c))), F.lit(0)).alias(c) for c in "ab"))
    order = Window.partitionBy("conv_id").orderBy("block")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    last = F.lead("block").over(order).isNull()
    rows = rows.select(
        "*", last.alias("last"),
        *(F.coalesce(F.bit_xor(c).over(earlier), F.lit(0)).alias(f"prior_{c}") for c in "ab"))
    return rows.select(
        "conv_id", "block", "prior_a", "prior_b",
        F.when(F.col("last"), F.size("items")).otherwise(_BLOCK + 1).alias("held"),
        *(F.when(F.col("last"), F.col(f"prior_{c}").bitwiseXOR(F.col(c))).alias(f"end_{c}") for c in "ab"),
        *(F.expr(f"get(items, {i}).turn_id").alias(t) for i, t in enumerate(_TURNS)),
        *(F.expr(f"get(items, {i}).n_words").alias(w) for i, w in enumerate(_WORDS)))


_GROUPING = f"GROUP BY block, prior_a, prior_b, ROLLUP ({', '.join(_TURNS)})"
_LEVEL = f"{_BLOCK} - bit_count(grouping_id())"
#: A prefix is one of rows that are long enough; a block's own beginning is a node only as the root.
_IS_NODE = f"level = {' + '.join(f'int({t} IS NOT NULL)' for t in _TURNS)} AND (level > 0 OR block = 0)"


def _key(c: str, upto: str) -> str:
    """A node's key, or with ``upto`` one level less its parent's."""
    steps = " ".join(
        f"^ CASE WHEN {i} <= {upto} THEN {_hashes(t, f'(block * {_BLOCK} + {i})')[c == 'b']} ELSE 0L END"
        for i, t in enumerate(_TURNS, 1))
    return f"prior_{c} {steps}"


def nodes(block_rows: DataFrame) -> DataFrame:
    """All nodes: path columns, level in the block, key, parent's key, smallest member, members, whether
    it is childless, and the tokens that storing it once saves."""
    words = ", ".join(f"max({w}) AS {w}" for w in _WORDS)
    rolled = block_rows.sparkSession.sql(
        f"""SELECT block, prior_a, prior_b, {', '.join(_TURNS)}, {_LEVEL} AS level, {words},
            min(conv_id) AS conv_id, count(*) AS n_convs, max(held) AS held FROM {{rows}} {_GROUPING}""",
        rows=block_rows).where(_IS_NODE)
    at_level = f"coalesce(element_at(array({', '.join(_WORDS)}), nullif(level, 0)), 0)"
    return rolled.selectExpr(
        "block", "prior_a", "prior_b", *_TURNS, "level", "conv_id", "n_convs",
        f"block * {_BLOCK} + level AS depth", f"(n_convs - 1) * {at_level} AS saved",
        "bigint(held <= level) AS leaf",
        *(f"{_key(c, 'level')} AS key_{c}" for c in "ab"),
        *(f"CASE WHEN level > 0 THEN {_key(c, 'level - 1')} ELSE prior_{c} END AS parent_{c}" for c in "ab"))


def subtree_sums(tree: DataFrame, block_rows: DataFrame) -> DataFrame:
    """``key_a, key_b, n_leaves, saved_tokens`` over the subtree of every node."""
    path = ["block", "prior_a", "prior_b", *_TURNS]
    mine = tree.groupBy("conv_id", "block").agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"))
    later = Window.partitionBy("conv_id").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    # Only conversations of several blocks have anything in a later block.
    several = block_rows.where("block > 0").select("conv_id").distinct()
    carried = block_rows.select("conv_id", *path).join(several, "conv_id", "left_semi").join(
        mine, ["conv_id", "block"], "left")
    carried = carried.select(*path, *(F.sum(c).over(later).alias(c) for c in ("leaf", "saved"))).where(
        "leaf > 0 OR saved > 0").fillna(0, ["leaf", "saved"])
    values = tree.select(*path, "leaf", "saved").unionByName(carried)
    summed = tree.sparkSession.sql(
        f"""SELECT block, prior_a, prior_b, {', '.join(_TURNS)}, {_LEVEL} AS level,
            sum(leaf) AS n_leaves, sum(saved) AS saved_tokens FROM {{rows}} {_GROUPING}""",
        rows=values).where(_IS_NODE)
    return summed.selectExpr(*(f"{_key(c, 'level')} AS key_{c}" for c in "ab"), "n_leaves", "saved_tokens")


def _hashed(batches):
    """Sorted pieces in, one hash for each node out; at most one hash is open at a time."""
    now, running = None, None

    def out(done):
        return pa.RecordBatch.from_pydict(
            {"key_a": [d[0] for d in done], "key_b": [d[1] for d in done], "ends_sha256": [d[2] for d in done]},
            schema=pa.schema([("key_a", pa.int64()), ("key_b", pa.int64()), ("ends_sha256", pa.string())]))

    for batch in batches:
        done = []
        for a, b, piece in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
            if (a, b) == now:
                running.update(b",")
            else:
                if now is not None:
                    done.append((*now, running.hexdigest()))
                now, running = (a, b), hashlib.sha256()
            running.update(piece.encode())
        yield out(done)
    if now is not None:
        yield out([(*now, running.hexdigest())])


def end_hashes(block_rows: DataFrame) -> DataFrame:
    """``key_a, key_b, ends_sha256`` of the nodes where conversations end."""
    ends = block_rows.where("end_a IS NOT NULL").select(
        F.col("end_a").alias("key_a"), F.col("end_b").alias("key_b"), "conv_id",
        F.shiftright("conv_id", _PIECE_BITS).alias("piece"))
    ids = F.transform(F.sort_array(F.collect_set("conv_id")), lambda c: c.cast("string"))
    pieces = ends.groupBy("key_a", "key_b", "piece").agg(F.array_join(ids, ",").alias("ids"))
    pieces = pieces.repartition("key_a", "key_b").sortWithinPartitions("key_a", "key_b", "piece")
    return pieces.mapInArrow(_hashed, "key_a bigint, key_b bigint, ends_sha256 string")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row for each node of the trie of ``turns`` (``conv_id, pos, turn_id, n_words``; a row without place for
    every conversation): ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``."""
    rows = written(blocks(turns), "blocks")
    tree = written(nodes(rows), "nodes")
    keys = ["key_a", "key_b"]
    facts = {
        "conv_id": "bigint", "depth": "bigint", "parent_a": "bigint", "parent_b": "bigint", "n_convs": "bigint",
        "n_children": "bigint", "n_leaves": "bigint", "saved_tokens": "bigint", "ends_sha256": "string",
    }

    def filled(df):
        return df.select(*keys, *(
            (F.col(c) if c in df.columns else F.lit(None)).cast(kind).alias(c) for c, kind in facts.items()))

    children = tree.where("depth > 0").groupBy(F.col("parent_a").alias("key_a"), F.col("parent_b").alias("key_b")).agg(
        F.count("*").alias("n_children"))
    parts = [tree, children, subtree_sums(tree, rows), end_hashes(rows)]
    union = filled(parts[0])
    for part in parts[1:]:
        union = union.unionByName(filled(part))
    whole = union.groupBy(*keys).agg(*(F.max(c).alias(c) for c in facts))
    parents = tree.select(F.col("key_a").alias("parent_a"), F.col("key_b").alias("parent_b"),
                          F.col("conv_id").alias("parent_conv_id"))
    return whole.join(parents, ["parent_a", "parent_b"], "left").select(
        "conv_id", "depth", F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"), "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(_EMPTY_HASH)).alias("ends_sha256"))
