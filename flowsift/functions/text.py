"""Text expressions: tokens, character n-grams, payload signatures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD_PATTERN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"
SPACE_PATTERN = r"[\s\p{Z}]+"

# Payload signatures, in reporting order.
SIGNATURES = (
    ("sql_injection", r"(?i)(union\s+select|drop\s+table|or\s+'1'='1'|--\s*$)"),
    ("shell_injection", r"(\$\(|;\s*(rm|nc|bash|sh|wget|curl)\b|/bin/sh)"),
    ("path_traversal", r"\.\./"),
    ("xss", r"(?i)<script"),
    ("credential_access", r"/etc/(passwd|shadow)"),
    ("encoded_payload", r"(?i)powershell\s+-enc|base64\s+-d"),
)


def tokens(text: Column, level: str = "char", lowercase: bool = True) -> Column:
    """Token array of the whole text: code points, or word runs and single punctuation marks."""
    body = F.coalesce(text, F.lit(""))
    if lowercase:
        body = F.lower(body)
    if level == "char":
        return F.filter(F.split(body, ""), lambda t: t != F.lit(""))
    if level == "word":
        return F.regexp_extract_all(body, F.lit(WORD_PATTERN), F.lit(0))
    raise ValueError(f"unknown token level: {level}")


def _all_matches(text: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def char_ngrams(text: Column, low: int = 1, high: int = 3) -> Column:
    """Character n-grams inside words, each word padded by one space on both sides.

    A padded word shorter than n is emitted once, and the larger n are skipped for it. Words are
    put on lines of their own, so one pattern per n finds all grams without crossing words.
    """
    # only from the start of a run, else a long one in the middle is read anew from each of its spaces
    trimmed = F.regexp_replace(F.lower(text), rf"^{SPACE_PATTERN}|(?<![\s\p{{Z}}]){SPACE_PATTERN}+$", "")
    lines = F.concat(F.lit(" "), F.regexp_replace(trimmed, SPACE_PATTERN, " \n "), F.lit(" "))
    grams = [_all_matches(lines, rf"(?=([^\n]{{{n}}}))[^\n]", 1) for n in range(low, high + 1)]
    if low > 3:
        grams.append(_all_matches(lines, rf"(?<![^\n])[^\n]{{1,{low - 1}}}(?![^\n])", 0))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.concat(*grams))


def text_ngrams(text: Column, size: int) -> Column:
    """All n-grams of code points over the whole text, in order."""
    return _all_matches(text, rf"(?s)(?=(.{{{size}}})).", 1)


def signatures(payload: Column) -> Column:
    """Names of the signatures found in the payload; empty for a NULL or empty payload."""
    body = F.coalesce(payload, F.lit(""))
    hits = F.array(*[F.when(body.rlike(p), F.lit(name)) for name, p in SIGNATURES])
    return F.when(body == F.lit(""), F.array().cast("array<string>")).otherwise(F.array_compact(hits))
