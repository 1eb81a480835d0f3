import hashlib
import random

import numpy as np
import pytest

from brute import no_docs, odd_docs, odd_rows, shingle_set
from flowsift.llm import fingerprints
from flowsift.llm.fingerprints import compare_with_edits, containment, decode, fingerprint_documents, likeness, merge, sketches


@pytest.mark.parametrize("range_rows", [1, 7, 4096])
def test_edits_follow_the_next_document(spark, monkeypatch, range_rows):
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", range_rows)
    rng = random.Random(1)
    docs = [(i, "".join(rng.choice("abé \U0001f600z") for _ in range(rng.randint(0, 40)))) for i in rng.sample(range(-50, 500), 60)]
    got = {r.doc_id: r for r in compare_with_edits(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)).collect()}
    docs.sort()
    assert len(got) == len(docs)
    for (i, text), (_, after) in zip(docs, docs[1:] + docs[:1]):
        half = len(text) // 2
        edit = text[: len(text) - half] + after[:half]
        own, edited, following = sketches([text, edit, after], fingerprints.SCALE)
        assert got[i].n_chars == len(text) and got[i].edited_sha256 == hashlib.sha256(edit.encode()).hexdigest()
        assert np.array_equal(decode(got[i].fingerprint), own) and np.array_equal(decode(got[i].edited_fingerprint), edited)
        assert got[i].near_edited == likeness(own, edited) and got[i].near_next == likeness(own, following)


def test_estimates(spark):
    rng = random.Random(2)
    words = [f"w{rng.randrange(10**6)}" for _ in range(20_000)]
    whole, part, other = sketches([" ".join(words), " ".join(words[5000:7000]), " ".join(words[:10_000])], 8)
    assert containment(part, whole) == 1.0 and abs(containment(whole, part) - 0.1) < 0.03
    assert abs(likeness(whole, other) - 0.5) < 0.05
    first, second = sketches([" ".join(words[:10_000]), " ".join(words[9_996:])], 8)
    assert np.array_equal(merge(first, second), whole)


def test_equal_texts_have_equal_fingerprints(spark):
    rows = [r for r in odd_rows() if r[1]]
    prints = {}
    for r in fingerprint_documents(odd_docs(spark)).join(odd_docs(spark).select("doc_id", "text").distinct(), "doc_id").collect():
        prints.setdefault(r.doc_id, set()).add(r.fingerprint)
    assert prints[1] < prints[2] and len(prints[1]) == 1 and prints[4] == {""} and len(rows) > 5
    assert all(len(p) >= 16 for i, s in prints.items() for p in s if i in (1, 7, 10))


def test_odd_rows(spark):
    got = compare_with_edits(odd_docs(spark)).collect()
    assert len(got) == len(odd_rows())
    assert all(0.0 <= r.near_edited <= 1.0 and 0.0 <= r.near_next <= 1.0 for r in got)
    one = compare_with_edits(spark.createDataFrame([(5, "abcd")], "doc_id bigint, text string")).head()
    assert one.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and one.near_next == 1.0
    assert compare_with_edits(no_docs(spark)).count() == 0
    assert shingle_set("a b") == {(b"a", b"b")}
