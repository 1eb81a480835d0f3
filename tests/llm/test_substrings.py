import random

import pytest

from brute import no_docs, odd_docs, odd_rows, spaced
from flowsift.llm import substrings
from flowsift.llm.substrings import remove_repeats


def expected(docs, k):
    first = {}
    for i, text in docs:
        words = spaced(text)
        for at in range(len(words) - k + 1):
            if i is not None:
                gram = tuple(words[at : at + k])
                first[gram] = min(first.get(gram, i), i)
    out = []
    for i, text in docs:
        words = spaced(text)
        gone = [False] * len(words)
        for at in range(len(words) - k + 1):
            if i is not None and first[tuple(words[at : at + k])] < i:
                gone[at : at + k] = [True] * k
        out.append((i, len(words), sum(gone), b" ".join(w for w, g in zip(words, gone) if not g).decode()))
    return sorted(out, key=repr)


def rows(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in df.collect()), key=repr)


@pytest.mark.parametrize(("flush", "bucket", "k"), [(1, 500, 13), (4000, 3000, 13), (1 << 30, 1 << 30, 13), (2000, 2000, 4), (2000, 2000, 1)])
def test_equals_brute_force(spark, monkeypatch, flush, bucket, k):
    monkeypatch.setattr(substrings, "FLUSH_BYTES", flush)
    monkeypatch.setattr(substrings, "BUCKET_BYTES", bucket)
    rng = random.Random(k)
    passages = [" ".join(rng.choice("abcdefghij") for _ in range(rng.randint(5, 40))) for _ in range(8)]
    docs = []
    for i in rng.sample(range(1000), 60):
        parts = [rng.choice(passages) if rng.random() < 0.5 else " ".join(rng.choice("klmnopqrstuvw") for _ in range(rng.randint(1, 30))) for _ in range(rng.randint(0, 5))]
        docs.append((i, "\n".join(parts)))
    docs += [(5000 + i, docs[0][1]) for i in range(20)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    assert rows(remove_repeats(frame, k)) == expected(docs, k)


def test_spans_are_maximal(spark):
    text = " ".join(f"w{i}" for i in range(40))
    frame = spark.createDataFrame([(1, text), (2, "a b " + text + " c")], "doc_id bigint, text string")
    found = {r.doc_id: [(s.start, s.end) for s in r.spans] for r in remove_repeats(frame).collect()}
    assert found == {1: [], 2: [(2, 42)]}


def test_odd_rows(spark):
    docs = [(r[0], r[1]) for r in odd_rows()]
    assert rows(remove_repeats(odd_docs(spark))) == expected(docs, 13)
    assert remove_repeats(no_docs(spark)).count() == 0
