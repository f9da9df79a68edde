"""The operators bound to the benchmark tables, with SQL where SQL states the result."""

from __future__ import annotations

from pyspark.sql import functions as F

QUERIES = {}
ORACLES = {}


def query(name: str, sql: str = None):
    """Register ``fn(spark, sf_dir)`` under ``name``."""

    def enter(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return enter


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_LEDGER_SQL = r"""
WITH t AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)),
                lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT k, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c
  FROM (SELECT k, words, unnest(range(1, len(words) - 1)) AS i FROM t)
), twice AS (
  SELECT k, i FROM (
    SELECT k, i, count(*) OVER (PARTITION BY k, a, b, c) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT k, count(DISTINCT j) AS n FROM (
    SELECT k, i AS j FROM twice UNION ALL SELECT k, i + 1 FROM twice
    UNION ALL SELECT k, i + 2 FROM twice) GROUP BY k
), m AS (
  SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(lines) AS n_lines,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
    length(regexp_replace(array_to_string(words, ''), '[^A-ZÀ-ÖØ-Þ]+', '', 'g')) AS n_capitals,
    length(regexp_replace(array_to_string(words, ''), '[!-@\[-`{-~]+', '', 'g')) AS n_letters
  FROM t LEFT JOIN covered USING (k)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words
    OR 100 * n_symbols > 10 * word_chars OR 100 * n_dup_lines > 50 * n_lines
    OR (n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 14 * n_words))
    OR 100 * n_capitals > 30 * word_chars OR 100 * n_letters < 60 * word_chars) AS kept
FROM m
"""


@query("op8_rule_ledger", _LEDGER_SQL)
def rule_ledger(spark, sf_dir):
    """The ledger of every document and the standard policy's verdict."""
    from parcelhouse.llm.rule_ledger import BASE, STANDARD, ledger, passes

    return ledger(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~passes(BASE)).alias("base_failed"), passes(STANDARD).alias("kept"),
    )


@query("op9_probminhash")
def probminhash(spark, sf_dir):
    """The near-duplicate class of every document."""
    from parcelhouse.llm.probminhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


@query("op10_prefix_free")
def prefix_free(spark, sf_dir):
    """What every document keeps once 50-byte strings of earlier documents are taken out."""
    from parcelhouse.llm.prefix_free import repeated_passages

    return repeated_passages(table(spark, sf_dir, "documents"))


@query("op6_token_store")
def token_store(spark, sf_dir):
    """Every document's ids as the files hold them, each found through the index."""
    import public_tokenizers

    from parcelhouse.llm.token_store import store_tokens

    store = store_tokens(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return store.digests(store.ids()).join(store.starts(), "shard").select(
        "doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


@query("op3_sentencepiece")
def sentencepiece_ids(spark, sf_dir):
    """Ids of every whole text by probabilities estimated from all texts, and whether they decode to it."""
    import public_tokenizers

    from parcelhouse.llm.sentencepiece_text import encoded
    from parcelhouse.llm.unigram import estimated_scores

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("piece_bpe_32k.model")
    return encoded(docs, path, scores=estimated_scores(docs, path))


@query("op7_trie_counts")
def trie_token_counts(spark, sf_dir):
    """Pre-tokens and tokens of every whole text by probabilities estimated from all texts."""
    import public_tokenizers

    from parcelhouse.llm.token_counts import token_counts
    from parcelhouse.llm.unigram import estimated_scores

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts(docs, path, scores=estimated_scores(docs, path))


_MIX_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, lang, coalesce(source, '') AS s, coalesce(lang, '') AS l,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_words,
    length(coalesce(text, '')) AS size, coalesce(text, '') AS text
  FROM documents
), e AS (
  SELECT doc_id, source, lang, s, l, n_words,
    CASE WHEN n_words > 0 AND 20 * (size - length(replace(text, '|', ''))) >= n_words THEN 'tables'
      WHEN n_words > 0 AND 20 * len(regexp_extract_all(text, '[#*$%&<>]')) >= n_words THEN 'markup'
      WHEN n_words > 0 AND 20 * (size - length(replace(text, '!!', ''))) >= n_words THEN 'shouting'
      WHEN regexp_matches(text, '[0-9]') THEN 'figures' ELSE 'prose' END AS topic
  FROM d
), languages(l, goal_l) AS (VALUES ('en', 0.5::DOUBLE), ('de', 0.2), ('fr', 0.2), ('es', 0.1)),
topics(topic, goal_t) AS (VALUES ('prose', 0.6::DOUBLE), ('figures', 0.2), ('tables', 0.1),
  ('markup', 0.05), ('shouting', 0.05)),
cells AS (
  SELECT s, l, topic, sum(n_words)::DOUBLE AS tokens FROM e GROUP BY ALL HAVING sum(n_words) > 0
), goals AS (
  SELECT *, sqrt(sum(tokens) OVER (PARTITION BY s)) AS goal_s
  FROM cells JOIN languages USING (l) JOIN topics USING (topic)
), scaled AS (
  SELECT s, l, topic, tokens,
    goal_s / (SELECT sum(g) FROM (SELECT DISTINCT s, goal_s AS g FROM goals)) AS goal_s,
    goal_l / (SELECT sum(g) FROM (SELECT DISTINCT l, goal_l AS g FROM goals)) AS goal_l,
    goal_t / (SELECT sum(g) FROM (SELECT DISTINCT topic, goal_t AS g FROM goals)) AS goal_t
  FROM goals
), fit AS (
  SELECT 0 AS i, s, l, topic, tokens, goal_s, goal_l, goal_t, tokens AS w FROM scaled
  UNION ALL
  SELECT i + 1, s, l, topic, tokens, goal_s, goal_l, goal_t,
    w * goal_t / sum(w) OVER (PARTITION BY topic) AS w
  FROM (SELECT * REPLACE (w * goal_l / sum(w) OVER (PARTITION BY l) AS w)
    FROM (SELECT * REPLACE (w * goal_s / sum(w) OVER (PARTITION BY s) AS w)
      FROM fit WHERE i < 25))
), factors AS (
  SELECT s, l, topic, tokens, w / tokens AS f FROM fit WHERE i = 25
), level AS (
  SELECT sum(f * tokens) / sum(tokens) AS level FROM factors WHERE f > 0
), drawn AS (
  SELECT e.*, CASE WHEN n_words > 0
      THEN coalesce(round(f / (SELECT level FROM level), 9), 0.0) ELSE 0.0 END AS expected_copies,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT / 4294967296.0 AS u
  FROM e LEFT JOIN factors USING (s, l, topic)
), taken AS (
  SELECT *, floor(expected_copies)::BIGINT + (u < expected_copies - floor(expected_copies))::BIGINT AS copies
  FROM drawn
)
SELECT doc_id, source, lang, topic, n_words, least(expected_copies, 1.0) AS probability, expected_copies,
  copies, copies > 0 AS kept FROM taken
"""


@query("op1_raking", _MIX_SQL)
def raking(spark, sf_dir):
    """The calibrated probability of every document and how often it is drawn."""
    from parcelhouse.llm.raking import mixed

    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    return mixed(docs, repeat=True).drop("text")


@query("op2_projection_forest")
def projection_forest(spark, sf_dir):
    """The ten nearest vectors found for every hundredth vector."""
    from parcelhouse.llm.projection_forest import nearest, usable

    vectors = usable(table(spark, sf_dir, "embeddings"))
    return nearest(vectors, vectors.where("vec_id % 100 = 0"))


@query("op4_toxicity")
def toxicity(spark, sf_dir):
    """The toxicity score of every document."""
    from parcelhouse.llm.toxicity import fit, scored

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scored(docs, fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic")))


@query("op5_context_mixing")
def context_mixing(spark, sf_dir):
    """The log probability of every document."""
    from parcelhouse.llm.context_mixing import scores

    return scores(table(spark, sf_dir, "documents").select("doc_id", "text"))


_NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
    list_dot_product(a.e, c.e)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
  row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""


@query("op11_packed_products", _NEGATIVES_SQL)
def packed_products(spark, sf_dir):
    """The hard negatives of every fiftieth vector, for each of its positives."""
    from parcelhouse.llm.packed_products import hard_negatives, usable

    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = usable(table(spark, sf_dir, "embeddings").withColumn("label", moved))
    return hard_negatives(rows, rows.where("vec_id % 50 = 0")).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


@query("op12_order_minhash")
def order_minhash(spark, sf_dir):
    """The fingerprint of every document and of its edited text."""
    from parcelhouse.llm.order_minhash import fingerprints

    return fingerprints(table(spark, sf_dir, "documents"))


_TRIE_SQL = r"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
      left(coalesce(text, ''), 64),
      md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT DISTINCT conv_id AS c, conv_id - conv_id % 20 AS base,
    (xor(4294967295, list_reduce(list_transform(string_split(conv_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT),
      lambda crc, d: list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, z:
        CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END, xor(crc, d)),
      4294967295::BIGINT)) % 4) AS h
  FROM turns
), parts AS (
  SELECT c, 0 AS part, pos, role, text FROM convs JOIN turns ON conv_id = base AND pos <= h
  UNION ALL SELECT c, 1, pos, role, text FROM convs JOIN turns ON conv_id = c AND pos > h
), rebuilt AS (
  SELECT c, coalesce(list({'role': role, 'text': text} ORDER BY part, pos) FILTER (pos IS NOT NULL), []) AS path
  FROM convs LEFT JOIN parts USING (c) GROUP BY c
), prefixes AS (
  SELECT c, d, path[1:d] AS node, d = len(path) AS ends
  FROM (SELECT c, path, unnest(range(0, len(path) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT node, d, min(c) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '') AS ids
  FROM prefixes GROUP BY node, d
), linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id,
    (n.n_convs - 1) * CASE WHEN n.d = 0 THEN 0
      ELSE len(regexp_extract_all(n.node[n.d].text, '[^\x20\x09-\x0D]+')) END AS saved
  FROM nodes n LEFT JOIN nodes p ON n.d > 0 AND p.d = n.d - 1 AND p.node = n.node[1:n.d - 1]
), children AS (
  SELECT d - 1 AS d, node[1:d - 1] AS node, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL
), above AS (
  SELECT k AS d, node[1:k] AS node, sum(leaf::BIGINT) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT l.node, l.saved, c.n_children IS NULL AS leaf, unnest(range(0, l.d + 1)) AS k
    FROM linked l LEFT JOIN children c ON c.d = l.d AND c.node = l.node)
  GROUP BY ALL
)
SELECT conv_id, l.d AS depth, parent_conv_id, n_convs, coalesce(n_children, 0) AS n_children,
  n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, sha256(ids) AS ends_sha256
FROM linked l JOIN above a ON a.d = l.d AND a.node = l.node
LEFT JOIN children c ON c.d = l.d AND c.node = l.node
"""


@query("op13_prefix_rollup", _TRIE_SQL)
def prefix_rollup(spark, sf_dir):
    """Every node of the prefix trie of the rebuilt conversations."""
    from parcelhouse.llm.prefix_rollup import ordered_turns, prefix_trie, rebuilt

    return prefix_trie(rebuilt(ordered_turns(table(spark, sf_dir, "conversations"))))
