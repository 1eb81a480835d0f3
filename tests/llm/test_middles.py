import hashlib

import pytest
from pyspark.sql import functions as F

from brute import no_docs, odd_docs, odd_rows
from flowsift.llm.middles import fill_in_middle, restore_text, whole_match


def brute(doc_id, text):
    """The contract, code point by code point."""
    text = text or ""
    digits = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digits[i : i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return doc_id, n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


def key(row):
    return repr(row)


def test_equals_brute_force(spark):
    pieces = ["a", "é", "😀", "\n", "\r\n", "<", "<P", "P>", "S>", "<M", " ", "é", " ", "<<"]
    texts = [(i, "".join(pieces[(i * j + j // 3) % len(pieces)] for j in range(i % 57))) for i in range(400)]
    texts += [(1000 + i, f"ab{m}cd") for i, m in enumerate(("<P>", "<S>", "<M>", "<X>"))]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(4)
    got = fill_in_middle(docs).withColumn("restored", restore_text("output", "form")).collect()
    assert sorted((tuple(r)[:6] for r in got), key=key) == sorted((brute(*t) for t in texts), key=key)
    whole = dict(texts)
    assert all(r.restored == whole[r.doc_id] for r in got)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_odd_rows(spark):
    got = fill_in_middle(odd_docs(spark)).collect()
    assert sorted(map(tuple, got), key=key) == sorted((brute(i, t) for i, t, *_ in odd_rows()), key=key)
    assert fill_in_middle(no_docs(spark)).collect() == []


def test_one_very_long_text(spark):
    docs = spark.range(5).select(F.col("id").alias("doc_id"), F.expr("repeat('aé😀\n', 500000)").alias("text"))
    got = fill_in_middle(docs).select("n", (restore_text("output", "form") == F.expr("repeat('aé😀\n', 500000)")).alias("same")).collect()
    assert [tuple(r) for r in got] == [(2_000_000, True)] * 5


def test_other_units_and_marks(spark):
    docs = spark.createDataFrame([(i, "one two  three\nfour " * (i % 7)) for i in range(60)] + [(60, "no,words")], "doc_id bigint, text string")
    got = fill_in_middle(docs, unit=r"\w+\s*", marks=("[p]", "{s}", "(m)"), plain_percent=0, spm_percent=50).collect()
    for r in got:
        if r.doc_id == 60:
            assert (r.n, r.form, r.output) == (None, "plain", "no,words")
            continue
        assert r.n == 4 * (r.doc_id % 7)
        if r.form != "plain":
            head = r.output.split("[p]")[1].split("{s}")[0].split("(m)")[0]
            assert head == "" or head[-1].isspace()
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    with pytest.raises(ValueError):
        whole_match(".?")
    with pytest.raises(ValueError):
        fill_in_middle(docs, marks=("<P", "<S", "<<"))


def test_every_repetition_is_captured():
    assert whole_match(r"\X").fullmatch("éa😀").ends(1) == [2, 3, 4]
    assert whole_match(r"(?s:.)").fullmatch("").ends(1) == []


def test_query_equals_sql(spark, sf, oracle):
    from flowsift.llm.catalog import ORACLES, QUERIES

    name = "op13_fill_in_middle"
    got = QUERIES[name](spark, sf).toArrow()
    want = oracle.execute(ORACLES[name]).to_arrow_table()
    assert got.column_names == want.column_names
    assert sorted(zip(*got.to_pydict().values()), key=key) == sorted(zip(*want.to_pydict().values()), key=key)
