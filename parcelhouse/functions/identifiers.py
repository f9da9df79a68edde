"""Identifier expressions. All take and return Columns; nothing runs in Python."""

from pyspark.sql import Column, functions as F

# Text forms of a number that float() would accept and an id may have.
_NUMBER = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def pad_zeros(code, width) -> Column:
    """Left-pad with zeros without cutting longer strings (``lpad`` alone would)."""
    code = _col(code)
    return F.when(F.length(code) < width, F.lpad(code, width, "0")).otherwise(code)


def subject_code(raw) -> Column:
    """Stored subject code: separators become ``_``, short codes are padded to 4."""
    return pad_zeros(F.translate(_col(raw).cast("string"), "/ -.", "____"), 4)


def session_id(raw) -> Column:
    """Stored session id: integer part as text; null when the text is no number."""
    text = _col(raw).cast("string")
    number = F.when(text.rlike(_NUMBER), F.trim(text).try_cast("double"))
    return number.try_cast("bigint").cast("string")


def bare_code(raw) -> Column:
    """Code without ``-``, ``_`` and blanks, for matching questionnaires."""
    return F.translate(_col(raw).cast("string"), "-_ ", "")


def legacy_code(raw) -> Column:
    """As :func:`bare_code`, also without tabs and line feeds."""
    return F.translate(_col(raw).cast("string"), "-_ \t\n", "")


def bids_entities(file_name) -> Column:
    """``key-value`` parts of a file name as a map; the last of a repeated key wins."""
    parts = F.filter(F.split(_col(file_name), "_"), lambda p: F.contains(p, F.lit("-")))
    pairs = F.transform(parts, lambda p: F.split(p, "-", 2))
    return F.aggregate(
        pairs,
        F.create_map().cast("map<string,string>"),
        lambda acc, kv: F.map_concat(
            F.map_filter(acc, lambda k, _: k != kv[0]), F.create_map(kv[0], kv[1])
        ),
    )
