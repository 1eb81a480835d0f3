"""Fill-in-middle transformation: texts cut at unit borders by one match that keeps every repetition."""

from __future__ import annotations

import re
from collections.abc import Sequence

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: One code point, line ends included.
CODE_POINT = r"(?s:.)"
#: Marks before prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
PLAIN, PSM, SPM = "plain", "psm", "spm"

CUTS = "struct<n: bigint, prefix_chars: bigint, middle_end: bigint>"


def whole_match(unit: str) -> regex.Pattern:
    """Pattern of a text made of units; group 1 captures every one of them.

    The repeat is possessive, so a long text keeps no way back for each unit.
    """
    if regex.compile(unit).fullmatch(""):
        raise ValueError("a unit may not be empty")
    return regex.compile(f"(?:({unit}))*+")


def _cuts(unit: str):
    @F.arrow_udf(CUTS)
    def cuts(text: pa.Array, first: pa.Array, second: pa.Array) -> pa.Array:
        pattern, out = whole_match(unit), ([], [], [])
        for value, x, y in zip(text, first, second):
            match = pattern.fullmatch(value.as_py())
            row = (None, None, None)
            if match:
                ends = match.ends(1)
                n = len(ends)
                a, b = sorted((x.as_py() % (n + 1), y.as_py() % (n + 1)))
                row = (n, ends[a - 1] if a else 0, ends[b - 1] if b else 0)
            for column, cell in zip(out, row):
                column.append(cell)
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in out], ["n", "prefix_chars", "middle_end"])

    return cuts


def _separable(marks: Sequence[str]) -> None:
    """Marks must be found again wherever the text around them is cut."""
    starts = {m[:1] for m in marks}
    if len(set(marks)) != 3 or "" in starts or any(c in starts for m in marks for c in m[1:]):
        raise ValueError("three different marks, and none may hold the first character of a mark again")


def fill_in_middle(
    docs: DataFrame,
    seed: int = 1,
    plain_percent: int = 10,
    spm_percent: int = 20,
    unit: str = CODE_POINT,
    marks: Sequence[str] = MARKS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Training texts with a marked middle: ``doc_id, n, form, prefix_chars, middle_chars, output``.

    A text of ``n`` units is cut after two numbers of units drawn from 0 to n. The draws are digits of
    the SHA-256 of ``seed:doc_id``, so reruns and lost tasks agree. ``psm`` texts are written
    prefix, suffix, middle and ``spm`` texts suffix, prefix, middle, each part after its mark;
    ``plain`` texts stay as they are. Plain are a share of all texts, and those that are empty, hold a
    mark or do not consist of units (``n`` is then NULL). ``prefix_chars`` and ``middle_chars`` count
    code points and are NULL for plain texts.

    NULL and white space: a NULL text is an empty one, white space is text. A NULL id draws as an empty
    id. Rows that repeat an id are cut at the same draws, each in its own text; equal texts under other
    ids are cut elsewhere. An empty table gives no rows. Other columns of ``docs`` are not read. A very
    long text is matched whole; its task holds about 50 bytes a unit while it does.

    One projection without a shuffle: only offsets come back from Python, texts are put together in
    the JVM.
    """
    _separable(marks)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint").alias(f"h{i + 1}") for i in range(4)]
    rows = rows.select("*", *draws)
    rows = rows.withColumn("cut", _cuts(unit)("text", "h1", "h2"))
    marked = F.lit(False)
    for mark in marks:
        marked = marked | F.contains("text", F.lit(mark))
    plain = (F.col("text") == "") | marked | (F.col("h3") % 100 >= 100 - plain_percent) | F.col("cut.n").isNull()
    rows = rows.withColumn("form", F.when(plain, PLAIN).when(F.col("h4") % 100 < spm_percent, SPM).otherwise(PSM))
    a, b = F.col("cut.prefix_chars").cast("int"), F.col("cut.middle_end").cast("int")
    length = F.length("text")
    prefix = F.lit(marks[0]), F.substring("text", F.lit(1), a)
    middle = F.lit(marks[2]), F.substring("text", a + 1, b - a)
    suffix = F.lit(marks[1]), F.substring("text", b + 1, length - b)
    cut = F.col("form") != PLAIN
    return rows.select(
        "doc_id",
        F.col("cut.n").alias("n"),
        "form",
        F.when(cut, F.col("cut.prefix_chars")).alias("prefix_chars"),
        F.when(cut, F.col("cut.middle_end") - F.col("cut.prefix_chars")).alias("middle_chars"),
        F.when(F.col("form") == PSM, F.concat(*prefix, *suffix, *middle))
        .when(F.col("form") == SPM, F.concat(*suffix, *prefix, *middle))
        .otherwise(F.col("text"))
        .alias("output"),
    )


def restore_text(output: Column | str, form: Column | str, marks: Sequence[str] = MARKS) -> Column:
    """The text that ``fill_in_middle`` made an output from, of output and form alone.

    A cut output holds each mark once. NULL gives NULL, any other form than the three as well.
    """
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    parts = F.split(output, "|".join(re.escape(m) for m in marks), -1)
    second, third, middle = (F.get(parts, F.lit(i)) for i in (1, 2, 3))
    return (
        F.when(form == PLAIN, output)
        .when(form == PSM, F.concat(second, middle, third))
        .when(form == SPM, F.concat(third, middle, second))
    )
