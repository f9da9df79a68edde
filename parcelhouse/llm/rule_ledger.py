"""Quality rules as a bitmask ledger, in DataFrame functions only.

Every rule is evaluated once per document. The ledger keeps what was measured and one bit
per failed rule, so a policy (a named, versioned set of rules) is a bitwise test over stored
bits, and the effect of every rule is a bitwise aggregation, without reading texts again.

Defined results: a null or empty text has no words and fails ``few_words``; other columns,
whatever their names, pass through ``ledger`` untouched when ``keep`` names them; repeated
rows are judged each for itself; an empty table gives an empty ledger. Texts of any length are measured
whole (positions take 28 bits: 268 million words a text).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words are runs of anything but these.
BLANKS = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
_POSITION_BITS = 28

#: Bit, name and condition of failure, over the ledger's measurements.
RULES = (
    ("few_words", "n_words < 50"),
    ("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "100 * n_symbols > 10 * word_chars"),
    ("repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    ("word_length", "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 14 * n_words)"),
    ("capitals", "100 * n_capitals > 30 * word_chars"),
    ("letters", "100 * n_letters < 60 * word_chars"),
)
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """Rules that reject a document, under a version that is kept with the decision."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BIT[r] for r in self.rules)


BASE = Policy("base", ("few_words", "repeated_windows"))
STANDARD = Policy("2026-1", tuple(BIT))


def _repeat_words(words: str, hashes: str, ordered: str, same: str) -> dict[str, str]:
    """Steps that count the words inside three-word windows found twice or more.

    Windows are hashed; only where two hashes agree are they ordered, with their positions
    in the low bits, and only windows that share the high bits are compared as texts.
    """
    low = (1 << _POSITION_BITS) - 1
    window = f"{words}[i - 1], {words}[i], {words}[i + 1]"
    high = f"shiftright({{}}, {_POSITION_BITS})"
    return {
        hashes: f"""CASE WHEN size({words}) < 3 THEN array()
            ELSE transform(sequence(1, size({words}) - 2), i -> xxhash64({window})) END""",
        ordered: f"""CASE WHEN size(array_distinct({hashes})) = size({hashes}) THEN array()
            ELSE sort_array(transform({hashes}, (h, i) ->
                shiftleft(shiftright(h, {_POSITION_BITS}), {_POSITION_BITS}) | (i + 1))) END""",
        same: f"""sort_array(transform(filter({ordered}, (x, i) ->
                coalesce({high.format(f"get({ordered}, i - 1)")} = {high.format("x")}, false)
                OR coalesce({high.format(f"get({ordered}, i + 1)")} = {high.format("x")}, false)),
            y -> transform(array(cast(y & {low} AS int)),
                i -> struct(struct({window}) AS words, i AS at))[0]))""",
    }


def measured(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns of ``keep`` and the measurements of ``text``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    steps = _repeat_words("_words", "_hashes", "_ordered", "_same")
    df = docs.select(*keep, text.alias("_text"))
    df = df.withColumns({
        "_words": F.expr(f"array_remove(split(_text, r'{BLANKS}'), '')"),
        "_lines": F.expr(
            r"filter(split(_text, '\n'), l -> l rlike r'[^\x20\x09-\x0D]')"
        ),
    })
    df = df.withColumns({
        "_solid": F.expr("array_join(_words, '')"),
        "_hashes": F.expr(steps["_hashes"]),
    })
    for name in ("_ordered", "_same"):
        df = df.withColumn(name, F.expr(steps[name]))
    covered = """size(array_distinct(flatten(transform(
        filter(_same, (x, i) -> coalesce(get(_same, i - 1).words = x.words, false)
            OR coalesce(get(_same, i + 1).words = x.words, false)),
        x -> array(x.at, x.at + 1, x.at + 2)))))"""
    return df.select(
        *keep,
        F.expr("cast(size(_words) AS bigint)").alias("n_words"),
        F.expr("cast(length(_solid) AS bigint)").alias("word_chars"),
        F.expr(f"cast(regexp_count(_solid, r'{SYMBOLS}') AS bigint)").alias("n_symbols"),
        F.expr("cast(size(_lines) AS bigint)").alias("n_lines"),
        F.expr("cast(size(_lines) - size(array_distinct(_lines)) AS bigint)").alias("n_dup_lines"),
        F.expr(f"cast({covered} AS bigint)").alias("n_repeat_words"),
        F.expr(r"cast(length(regexp_replace(_solid, r'[^A-ZÀ-ÖØ-Þ]+', '')) AS bigint)")
        .alias("n_capitals"),
        F.expr(r"cast(length(regexp_replace(_solid, r'[!-@\[-`{-~]+', '')) AS bigint)")
        .alias("n_letters"),
    )


def ledger(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Measurements and ``failed``: one bit for each rule of ``RULES`` that a document fails."""
    bits = " | ".join(
        f"CASE WHEN {condition} THEN {BIT[name]}L ELSE 0L END" for name, condition in RULES
    )
    return measured(docs, keep).withColumn("failed", F.expr(bits))


def passes(policy: Policy, failed: str = "failed") -> Column:
    """True where no rule of the policy failed."""
    return F.col(failed).bitwiseAND(F.lit(policy.mask).cast("bigint")) == 0


def kept_documents(docs: DataFrame, policy: Policy = STANDARD) -> DataFrame:
    """The rows of ``docs`` that the policy doesn't reject, with their columns as they are.

    A filter would be pushed below the measurements and repeat them; a generator stays above.
    """
    rows = docs.select(F.struct("*").alias("row"), "text")
    return ledger(rows, ("row",)).select(F.inline(F.when(passes(policy), F.array("row"))))


def ablation(ledger: DataFrame, policies: tuple[Policy, ...] = (STANDARD,)) -> DataFrame:
    """For each policy and rule: how many fail it, and how many only it rejects.

    One aggregation over the stored bits; ``n_only`` documents would be kept without the rule.
    """
    counts, rows = [F.count(F.lit(1)).alias("n_docs")], []
    for p, policy in enumerate(policies):
        mine = F.col("failed").bitwiseAND(F.lit(policy.mask).cast("bigint"))
        counts.append(F.count_if(mine != 0).alias(f"r{p}"))
        for rule in policy.rules:
            bit = F.lit(BIT[rule]).cast("bigint")
            counts += [
                F.count_if(mine.bitwiseAND(bit) != 0).alias(f"f{p}_{rule}"),
                F.count_if(mine == bit).alias(f"o{p}_{rule}"),
            ]
            rows.append(
                f"named_struct('version', '{policy.version}', 'rule', '{rule}', 'n_docs', n_docs, "
                f"'n_rejected', r{p}, 'n_failed', f{p}_{rule}, 'n_only', o{p}_{rule})"
            )
    return ledger.agg(*counts).select(F.expr(f"inline(array({', '.join(rows)}))"))
