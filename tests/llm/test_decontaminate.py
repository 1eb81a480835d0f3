import random

import numpy as np
import pytest

from brute import alnum, no_docs, odd_docs
from flowsift.llm import decontaminate
from flowsift.llm.decontaminate import find_contamination, hit_words
from flowsift.llm.fmindex import FMIndex

ITEMS = "item_id bigint, text string, extra string"


def expected(docs, items, window):
    phrases = {}
    for i, text in items:
        words = alnum(text)
        for at in range(max(len(words) - window, 0) + 1 if words else 0):
            phrases.setdefault(tuple(words[at : at + window]), set()).add("" if i is None else str(i))
    out = []
    for i, text in docs:
        words, found = alnum(text), set()
        hit = [0] * len(words)
        for n in {len(p) for p in phrases}:
            for at in range(len(words) - n + 1):
                if (names := phrases.get(tuple(words[at : at + n]))) is not None:
                    found |= names
                    hit[at : at + n] = [1] * n
        out.append((i, len(words), sum(hit), sorted(found)))
    return sorted(out, key=repr)


def rows(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, list(r.hit_items or [])) for r in df.withColumn("n_hit", hit_words()).collect()), key=repr)


@pytest.mark.parametrize(("shard", "block", "window"), [(1 << 20, 1 << 18, 13), (40, 60, 13), (300, 1 << 18, 3), (40, 10, 1)])
def test_equals_brute_force(spark, monkeypatch, shard, block, window):
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", shard)
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block)
    rng = random.Random(window)
    text = lambda n: " ".join(rng.choice("ab Cd, e.f g-h é 9").strip() or "z" for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 2, 5, 13, 14, 30]))) for i in range(25)] + [(None, "a b"), (3, "unique words here"), (4, None)]
    docs = [(i, text(rng.randint(0, 60)) + " " + (rng.choice(items)[1] or "") + " " + text(rng.randint(0, 9))) for i in range(80)]
    benchmark = spark.createDataFrame([(*i, "x") for i in items], ITEMS)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    assert rows(find_contamination(frame, benchmark, window)) == expected(docs, items, window)


def test_odd_rows_and_clashing_columns(spark):
    benchmark = spark.createDataFrame([(1, "on the mat and the dog", "x"), (2, None, "x"), (None, "straße sind überall", "x")], ITEMS)
    docs = odd_docs(spark)
    found = find_contamination(docs, benchmark)
    assert set(docs.columns) <= set(found.columns) and dict(found.dtypes)["n_words"] == "bigint"
    assert rows(found) == expected([(r.doc_id, r.text) for r in docs.collect()], [(1, "on the mat and the dog"), (None, "straße sind überall")], 13)
    assert find_contamination(no_docs(spark), benchmark).count() == 0
    nothing = find_contamination(docs, benchmark.limit(0)).withColumn("n_hit", hit_words())
    assert {r.n_hit for r in nothing.collect()} == {0}


def test_index_counts_and_locates():
    rng = np.random.default_rng(5)
    lengths = rng.integers(1, 50, 40)
    runs = rng.integers(1, 4, lengths.sum())
    index = FMIndex(runs, lengths, 3)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    for n in (1, 2, 5):
        phrase = rng.integers(1, 4, (1, n))
        want = {s + r + at for r, (s, e) in enumerate(zip(starts, starts[1:])) for at in range(e - s - n + 1) if (runs[s + at : s + at + n] == phrase[0]).all()}
        low, high = index.search(phrase, np.array([n]))
        assert set(index.locate(np.arange(low[0], high[0])).tolist()) == want
