import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowsift.models import sequence
from flowsift.models.sequence import Alphabet, Regimes, SwitchingChain, chain, log_odds
from flowsift.models.textmodels import TextBaseline, TextSequence
from flowsift.operators.evaluate import average_precision
from flowsift.session import stage


@pytest.fixture(scope="module")
def regimes():
    rng = np.random.default_rng(4)
    return Regimes(rng.uniform(0.2, 4.0, (2, 50)).astype(np.float32), np.array([[0.7, 0.3], [0.4, 0.6]]), np.array([[[0.9, 0.1], [0.3, 0.7]], [[0.6, 0.4], [0.2, 0.8]]]))


def paths(regimes, y, cells):
    """Weight of every path of regimes, the one before the text first."""
    for path in itertools.product((0, 1), repeat=len(cells) + 1):
        w = regimes.start[y][path[0]]
        for a, b, c in zip(path, path[1:], cells):
            w *= regimes.moves[y][a][b] * (float(regimes.odds[y][c]) if b else 1.0)
        yield path, w


@pytest.mark.parametrize("width", [1, 3, 128])
def test_recursion_equals_all_paths(monkeypatch, regimes, width):
    monkeypatch.setattr(sequence, "CHUNK", width)
    rng = np.random.default_rng(1)
    cells = [rng.integers(0, 50, n) for n in (5, 0, 8, 1, 7)]
    labels = np.array([0, 1, 1, 0, 1])
    got = log_odds(regimes, cells)
    for i, y in itertools.product(range(5), (0, 1)):
        assert got[i, y] == pytest.approx(math.log(sum(w for _, w in paths(regimes, y, cells[i]))), abs=1e-12)
    want = {}
    for i, y in itertools.product(range(5), (0, 1)):
        total = sum(w for _, w in paths(regimes, y, cells[i]))
        each = {}
        for path, w in paths(regimes, y, cells[i]):
            for c, b in zip(cells[i], path[1:]):
                each[c] = each.get(c, 0.0) + b * w / total
            if labels[i] == y and len(cells[i]):
                for a, b in zip(path, path[1:]):
                    want[y, y, -1 - 2 * a - b] = want.get((y, y, -1 - 2 * a - b), 0.0) + w / total
        for c, n in each.items():
            n0, s0 = want.get((y, labels[i], c), (0.0, 0.0))
            want[y, labels[i], c] = n0 + n, s0 + n * n
    found = {}
    for y, label, names, counts, squares in sequence._expect(regimes, cells, labels):
        for c, n, s in zip(names, counts, squares):
            found[y, label, c] = (n, s) if c >= 0 else n
    for k, v in want.items():
        assert found[k] == pytest.approx(v, abs=1e-9)


def test_long_texts_neither_overflow_nor_depend_on_their_neighbours(regimes):
    rng = np.random.default_rng(2)
    cells = [rng.integers(0, 50, n) for n in (300_000, 40, 700_000, 129)]
    together = log_odds(regimes, cells)
    assert np.isfinite(together).all()
    assert np.array_equal(together, np.concatenate([log_odds(regimes, [c]) for c in cells]))


def test_chain_is_a_distribution():
    p = chain(np.random.default_rng(3).integers(0, 3, 6**4).astype(float), 6).reshape(-1, 6)
    assert np.allclose(p.sum(axis=1), 1.0) and (p > 0).all()


def test_cells_hold_context_and_class():
    alphabet = Alphabet(np.array([ord("a"), ord("b")], np.uint32))
    codes = [c % alphabet.size for c in alphabet.cells("aB é7\t;\U0001f600")]
    assert codes == [5, 6, 3, 1, 2, 3, 4, 4]
    assert alphabet.cells("ab")[1] == (0 * 7 + 0) * 49 + 5 * 7 + 6 and len(alphabet.cells("")) == 0


@pytest.fixture(scope="module")
def ordered(spark):
    """Texts of random words; three of them stand in one order or in the other."""
    rng = random.Random(3)
    rows = []
    for i in range(900):
        y = int(rng.random() < 0.3)
        words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 7))) for _ in range(rng.randint(20, 40))]
        at = rng.randrange(len(words))
        words[at:at] = ["open", "pipe", "send"][:: 1 if y else -1]
        rows.append((i, " ".join(words), y))
    df = stage(spark.createDataFrame(rows, "id int, payload string, label int"), "ordered")
    return df.where("id < 600"), df.where("id >= 600")


def test_order_alone_is_learned(spark, ordered, tmp_path):
    train, test = ordered
    model = TextSequence.fit(train, "payload", "label").with_threshold(test, "label", 0.8)
    baseline = TextBaseline.fit(train, "payload", "label", iterations=20)
    scored = stage(baseline.score(model.score(test)), "ordered-scores")
    found, bag = (average_precision(scored, "label", c).first()[0] for c in ("text_proba", "baseline_proba"))
    assert found > 0.95 and bag < 0.6
    loaded = TextSequence.load(spark, model.save(spark, str(tmp_path / "sequence")))
    again = {r["id"]: r["text_proba"] for r in loaded.score(test.repartition(3)).collect()}
    assert again == {r["id"]: r["text_proba"] for r in scored.collect()} and loaded.threshold == model.threshold


def test_odd_texts(spark):
    rows = [(1, None, 1), (2, "", 0), (3, "x" * 300_000, 1), (4, "ok", 0), (4, "ok", 0), (5, "ok", None)]
    df = spark.createDataFrame(rows, "id int, payload string, label int").withColumn("__own", F.lit(1))
    model = TextSequence.fit(df, "payload", "label", rounds=1)
    got = model.score(df).collect()
    assert len(got) == 6 and all(0 <= r["text_proba"] <= 1 and r["__own"] == 1 for r in got)
    assert len({r["text_proba"] for r in got if not r["payload"]}) == 1
    assert sorted(map(str, model.score(df.coalesce(1)).collect())) == sorted(map(str, got))
    assert model.score(df.limit(0)).count() == 0
    for part in (df.where("label = 1"), df.limit(0)):
        alone = SwitchingChain.fit(part, "payload", "label", rounds=1)
        values = [v for r in df.select(alone.log_odds(spark, F.col("payload")).alias("o")).collect() for v in r["o"]]
        assert np.isfinite(values).all()


def test_baseline_equals_a_dense_fit(spark):
    rng = random.Random(8)
    texts = [" ".join(rng.choice(["rm", "ls", "cat", "/etc", "x", "git"]) for _ in range(rng.randint(1, 6))) for _ in range(60)]
    labels = [int("rm" in t or rng.random() < 0.2) for t in texts]
    df = spark.createDataFrame(list(zip(range(60), texts, labels)), "id int, payload string, label int")
    model = TextBaseline.fit(df, "payload", "label", iterations=1000, tolerance=1e-12)
    got = {r["id"]: r["baseline_proba"] for r in model.score(df).collect()}

    def grams(text):
        return [w[i : i + n] for w in (f" {w} " for w in text.split()) for n in (1, 2, 3) for i in range(len(w) - n + 1)]

    held = [grams(t) for t in texts]
    df_of = {g: sum(g in set(h) for h in held) for g in {g for h in held for g in h}}
    terms = sorted(g for g, n in df_of.items() if n >= 2)
    x = np.array([[h.count(g) * (math.log(61 / (1 + df_of[g])) + 1) for g in terms] for h in held])
    x = np.hstack([x / np.linalg.norm(x, axis=1, keepdims=True), np.ones((60, 1))])
    y = np.array(labels, float)
    weight = np.where(y == 1, 30 / y.sum(), 30 / (60 - y.sum()))
    ridge, w = np.diag([1.0] * len(terms) + [0.0]), np.zeros(len(terms) + 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        w -= np.linalg.solve(x.T @ (x * (weight * p * (1 - p))[:, None]) + ridge, x.T @ (weight * (p - y)) + ridge @ w)
    want = 1 / (1 + np.exp(-x @ w))
    assert len(model.stages.stages[0].vocabulary) == len(terms)
    assert all(got[i] == pytest.approx(want[i], abs=1e-6) for i in range(60))


def test_cells_are_ordered_once_for_both_regimes(monkeypatch):
    """A batch of texts is sorted once a label, whatever the number of regimes."""
    from flowsift.models import sequence

    calls = []
    plain = np.unique
    monkeypatch.setattr(sequence.np, "unique", lambda *a, **k: calls.append(1) or plain(*a, **k))
    cells = [np.arange(5), np.arange(3)]
    found = list(sequence._expect(None, cells, np.array([0, 1])))
    assert len(calls) == 4
    assert [(r, y, float(n.sum())) for r, y, _, n, _ in found] == [(0, 0, 5.0), (0, 1, 3.0), (1, 0, 5.0), (1, 1, 3.0)]


def test_baseline_scores_as_its_stages_do(spark):
    """Whole batches are scored by number; MLlib's stages over the terms of the pattern give the same."""
    from pyspark.ml.functions import vector_to_array

    from flowsift.functions.text import char_ngrams

    rows = [(i, t, i % 2) for i, t in enumerate(["ls -la", "cat /etc/shadow", "ls", "cat x", "", "İß \U0001F600", None, "cat cat"])]
    df = spark.createDataFrame(rows, "id int, payload string, label int")
    model = TextBaseline.fit(df, "payload", "label", iterations=20)
    terms = df.withColumn("__terms", char_ngrams(F.coalesce("payload", F.lit("")), 1, 3))
    want = model.stages.transform(terms).select("id", vector_to_array("__proba")[1].alias("p"))
    got = {r["id"]: r["baseline_proba"] for r in model.score(df).collect()}
    assert got == {r["id"]: pytest.approx(r["p"], abs=1e-12) for r in want.collect()}
    assert "ArrowEvalPython" in model.score(df)._jdf.queryExecution().toString()


def test_cells_of_a_batch_equal_those_of_its_texts():
    """Texts are cut apart in one pass: no context reaches into the next text, also after empty and odd ones."""
    alphabet = Alphabet(np.array([97, 98, 233], np.uint32))
    texts = ["abİc", "", "b", "\ud800a", "", "AB 9中" * 50, "a"]
    alone = [alphabet.cells(t) for t in texts]
    assert all(np.array_equal(a, b) for a, b in zip(alphabet.cells_of(texts), alone, strict=True))
    assert [len(c) for c in alone] == [len(t.lower()) for t in texts] and alphabet.cells_of([]) == []


def test_short_pieces_take_few_steps():
    """A piece is stepped through as far as it reaches, not to the length of the longest."""
    chunks = sequence.Chunks.of(np.array([3, 0, 300, 1]))
    assert chunks.owner.tolist() == [0, 2, 2, 2, 3] and chunks.nth.tolist() == [0, 0, 1, 2, 0]
    assert sum(chunks.on) == 304 and chunks.on[:2] == [5, 4] and len(chunks.on) == sequence.CHUNK
    assert [t.tolist() for t in chunks.turns()] == [[0, 1, 4], [2], [3]]
    assert sorted(chunks.place[chunks.valid()].tolist()) == list(range(304))
