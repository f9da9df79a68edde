"""Mixing to target weights: token counts raked to marginals, documents sampled by probability.

Iterative proportional fitting scales the token count of every cell (source, language, topic) until the
sums by source, by language and by topic have the target shares. The cells of a source stand in
one row, so a round is one small job: each source finds its own factor, and what comes back to the driver is a
matrix of languages by topics, whose size the given targets bound; the number of sources
doesn't matter. A document's expected copies are its cell's factor over a level:

* with ``repeat`` the level is set by a budget of tokens (by default those of all cells that take part).
  A document is taken as often as the whole part says, and once more with the rest as probability, so
  expected tokens meet all targets whatever the budget;
* otherwise no document is taken twice, and probabilities are cut at 1. The level is then the one below
  which cells hold nine tenths of the tokens (to 1/64 of a power of two): scarce cells above it are taken whole
  and miss their share. With ``exact`` it is the largest factor, so that none is cut, of fewer documents.

``exact`` and a ``tolerance`` above 0 go on until shares agree to it, and warn where they can't.
``achieved`` gives shares beside targets. The draw is a hash of the id: a repeated run takes the same documents.

Defined results: a null source, language or topic is the value ``''``. Values without a
target share (or with share 0) are never drawn; shares are taken in proportion over the values that
have tokens. A text without words has no weight and isn't drawn, nor is a document of a cell that
no fit can reach. Rows that share an id are drawn or left together. An empty table gives no rows. Other columns pass
through, whatever their names; those called like an output are replaced.
"""

from __future__ import annotations

import warnings

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelhouse.llm.scratch_tables import written

ROUNDS, LEVEL, STEPS = 25, 0.9, 64
MOST_ROUNDS, TOLERANCE = 200, 1e-4
#: Rounds in which a fit must come nearer by a hundredth.
_PATIENCE = 10
BLANKS = r"[\x20\x09-\x0D]+"
LANGUAGES = {"en": 0.5, "de": 0.2, "fr": 0.2, "es": 0.1}
TOPICS = {"prose": 0.6, "figures": 0.2, "tables": 0.1, "markup": 0.05, "shouting": 0.05}


def n_words(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")).cast("bigint")


def form_topic(text: Column, words: Column) -> Column:
    """A topic by form, for tables that name none: marks per twenty words, then digits."""
    text = F.coalesce(text, F.lit(""))

    def often(count: Column) -> Column:
        return (words > 0) & (F.lit(20) * count >= words)

    return (
        F.when(often(F.length(text) - F.length(F.replace(text, F.lit("|"), F.lit("")))), "tables")
        .when(often(F.regexp_count(text, F.lit("[#*$%&<>]"))), "markup")
        .when(often(F.length(text) - F.length(F.replace(text, F.lit("!!"), F.lit("")))), "shouting")
        .when(text.rlike("[0-9]"), "figures").otherwise("prose"))


def tempered(cells: DataFrame, exponent: float) -> DataFrame:
    """Targets of sources: their tokens to the power ``exponent``."""
    return cells.groupBy("source").agg(F.pow(F.sum("tokens"), F.lit(exponent)).alias("target"))


def rake(cells: DataFrame, targets: DataFrame, languages: dict, topics: dict, rounds: int = ROUNDS,
         tolerance: float = 0.0):
    """``(source, lang, topic, factor)``: what each cell's tokens are multiplied by.

    ``cells`` has ``source, lang, topic, tokens``; ``targets`` has ``source, target``. Rounds end early
    once all shares are within ``tolerance`` of their targets, if that is above 0.
    """
    langs = [x for x in languages if languages[x] > 0]
    tops = [x for x in topics if topics[x] > 0]
    shape = (len(langs), len(tops))
    grid = cells.where(
        (F.col("tokens") > 0) & F.col("lang").isin(langs) & F.col("topic").isin(tops))
    sums = [F.coalesce(F.sum(F.when((F.col("lang") == x) & (F.col("topic") == y), F.col("tokens"))),
                       F.lit(0)).cast("double") for x in langs for y in tops]
    by_source = grid.groupBy("source").agg(F.array(*sums).alias("t"))
    by_source = written(by_source.join(targets.where("target > 0"), "source"), "cells")
    total = by_source.agg(F.sum("target")).first()[0] or 1.0

    def factor(each: np.ndarray) -> Column:
        scale = F.array(*(F.lit(float(x)) for x in each.ravel()))
        dot = F.aggregate(F.zip_with("t", scale, lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
        return F.col("target") / F.lit(total) / dot

    def share(goal: np.ndarray, now: np.ndarray) -> np.ndarray:
        goal = np.where(now > 0, goal, 0)
        return np.divide(goal / max(goal.sum(), 1e-300), now, out=np.zeros_like(now), where=now > 0)

    lang_goal, topic_goal = np.array([languages[x] for x in langs]), np.array([topics[x] for x in tops])
    by_lang, by_topic = np.ones(shape[0]), np.ones(shape[1])
    reached = np.zeros(shape, bool)
    gaps = []
    for _ in range(rounds):
        own = by_source.withColumn("f", factor(np.outer(by_lang, by_topic)))
        row = own.agg(*(F.sum(F.col("f") * F.col("t")[i]).alias(f"m{i}") for i in range(len(sums)))).first()
        matrix = np.array([x or 0.0 for x in row]).reshape(shape)
        reached = matrix > 0
        now = matrix * np.outer(by_lang, by_topic)
        gaps.append(max(np.abs(share(goal, s) * s - s / max(s.sum(), 1e-300)).max() for goal, s in (
            (lang_goal, now.sum(axis=1)), (topic_goal, now.sum(axis=0)))))
        # A fit that can't be reached stops coming nearer.
        if gaps[-1] < tolerance or tolerance > 0 and len(gaps) > _PATIENCE and gaps[-1] > 0.99 * gaps[-1 - _PATIENCE]:
            break
        by_lang = by_lang * share(lang_goal, (matrix * np.outer(by_lang, by_topic)).sum(axis=1))
        by_topic = by_topic * share(topic_goal, (matrix * np.outer(by_lang, by_topic)).sum(axis=0))
    if gaps and gaps[-1] >= tolerance > 0:
        warnings.warn(f"shares are {gaps[-1]:.2g} off their targets after {len(gaps)} rounds", stacklevel=2)
    scale = np.outer(by_lang, by_topic)
    pairs = F.array(*(
        F.struct(F.lit(x).alias("lang"), F.lit(y).alias("topic"),
                 F.lit(float(scale[i, j]) if reached[i, j] else 0.0).alias("g"))
        for i, x in enumerate(langs) for j, y in enumerate(tops)))
    return own.select("source", "f", F.explode(pairs).alias("p")).select(
        "source", "p.lang", "p.topic", (F.col("f") * F.col("p.g")).alias("factor"))


def level_of(cells: DataFrame) -> float:
    """The factor below which cells hold ``LEVEL`` of the tokens."""
    step = F.floor(F.log2("factor") * STEPS).alias("step")
    steps = cells.where("factor > 0").groupBy(step).agg(F.sum("tokens").alias("tokens"))
    held = sorted((r["step"], r["tokens"]) for r in steps.collect())  # a few hundred steps at most
    total, below = sum(t for _, t in held), 0
    for step, tokens in held:
        below += tokens
        if below >= LEVEL * total:
            return float(2.0 ** ((step + 1) / STEPS))
    return 1.0


def draw(doc_id: Column) -> Column:
    """A number in [0, 1) by the id."""
    digits = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 32))


_OUT = ("topic", "n_words", "probability", "copies", "kept")


def mixed(docs: DataFrame, topic: Column = None, languages: dict = None, topics: dict = None,
          exponent: float = 0.5, rounds: int = ROUNDS, exact: bool = False, repeat: bool = False,
          budget: float = None, tolerance: float = 0.0) -> DataFrame:
    """``docs`` with ``topic``, ``n_words``, ``probability``, ``copies`` and ``kept``.

    ``probability`` is that of being taken at all; with ``repeat`` ``expected_copies`` may be more than that.
    """
    if exact:
        rounds, tolerance = max(rounds, MOST_ROUNDS), TOLERANCE
    rows = docs.select(
        F.struct("*").alias("_row"), n_words(F.col("text")).alias("n_words"), F.col("text").alias("_text"),
        *((F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"_{c}")) for c in ("source", "lang")),
        draw(F.col("doc_id")).alias("_draw"), (F.lit(None) if topic is None else topic).cast("string").alias("_given"))
    marked = rows.withColumn(
        "topic", form_topic(F.col("_text"), F.col("n_words")) if topic is None else F.col("_given"))
    marked = marked.withColumn("_topic", F.coalesce("topic", F.lit(""))).drop("_text", "_given")
    cells = written(
        marked.groupBy(*(F.col(f"_{c}").alias(c) for c in ("source", "lang", "topic")))
        .agg(F.sum("n_words").alias("tokens")), "cells")
    languages, topics = languages or LANGUAGES, topics or TOPICS
    known = cells.where(F.col("lang").isin([*languages]) & F.col("topic").isin([*topics]))
    factors = rake(cells, tempered(known, exponent), languages, topics, rounds, tolerance)
    factors = written(factors.join(cells.where("tokens > 0"), ["source", "lang", "topic"]), "factors")
    if repeat:
        sums = factors.where("factor > 0").agg(F.sum(F.col("factor") * F.col("tokens")), F.sum("tokens")).first()
        level = (sums[0] or 1.0) / (budget or sums[1] or 1.0)
    elif exact:
        level = factors.agg(F.max("factor")).first()[0] or 1.0
    else:
        level = level_of(factors)
    expected = F.col("factor") / F.lit(level)
    factors = factors.select(
        *(F.col(c).alias(f"_{c}") for c in ("source", "lang", "topic")),
        F.round(expected if repeat else F.least(expected, F.lit(1.0)), 9).alias("_e"))
    out = marked.join(factors, ["_source", "_lang", "_topic"], "left").withColumn(
        "_e", F.when(F.col("n_words") > 0, F.coalesce("_e", F.lit(0.0))).otherwise(0.0))
    whole = F.floor("_e")
    copies = whole + (F.col("_draw") < F.col("_e") - whole).cast("bigint")
    more = [F.col("_e").alias("expected_copies")] if repeat else []
    keep = [c for c in docs.columns if c not in (*_OUT, "expected_copies")]
    return out.select(
        *(F.col("_row")[c].alias(c) for c in keep), "topic", "n_words",
        F.least("_e", F.lit(1.0)).alias("probability"), *more, copies.alias("copies"), (copies > 0).alias("kept"))


def achieved(drawn: DataFrame, languages: dict = None, topics: dict = None, exponent: float = 0.5) -> DataFrame:
    """``(dimension, value, target, share)``: shares of the expected tokens of ``mixed`` beside their targets."""
    goals = {"lang": languages or LANGUAGES, "topic": topics or TOPICS}
    times = F.col("expected_copies" if "expected_copies" in drawn.columns else "probability")
    names = ["source", "lang", "topic"]
    cells = drawn.groupBy(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in names)).agg(
        F.sum("n_words").alias("tokens"), F.sum(F.col("n_words") * times).alias("expected"))
    wanted = [F.col(c).isin([x for x in goal if goal[x] > 0]) for c, goal in goals.items()]
    known = written(cells.where((F.col("tokens") > 0) & wanted[0] & wanted[1]), "expected")
    out = None
    for c in names:
        rows = known.groupBy(c).agg(F.sum("expected").alias("expected"), F.pow(F.sum("tokens"), F.lit(exponent)).alias("target"))
        if c in goals:
            pairs = F.create_map(*(F.lit(x) for pair in goals[c].items() for x in pair))
            rows = rows.withColumn("target", pairs[F.col(c)].cast("double"))
        total = rows.agg(F.sum("target"), F.sum("expected")).first()
        part = rows.select(F.lit(c).alias("dimension"), F.col(c).alias("value"),
                           (F.col("target") / F.lit(total[0] or 1.0)).alias("target"),
                           (F.col("expected") / F.lit(total[1] or 1.0)).alias("share"))
        out = part if out is None else out.union(part)
    return out
