import random

import pytest
from pyspark.sql import functions as F

from brute import groups, no_docs, odd_docs, odd_rows, shingle_set
from flowsift.llm import jaccard
from flowsift.llm.components import components
from flowsift.llm.jaccard import join_similar


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words) + 1)
        kind = rng.random()
        if kind < 0.4 and words:
            words[min(at, len(words) - 1)] = f"e{rng.randrange(10**6)}"
        elif kind < 0.7:
            words.insert(at, f"e{rng.randrange(10**6)}")
        elif words:
            words.pop(min(at, len(words) - 1))
    return words


def check(spark, texts, **options):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in join_similar(frame, **options).collect()}
    sets = [shingle_set(t, options.get("shingle", 5)) for t in texts]
    want = groups(sets, options.get("num", 3), options.get("den", 4))
    assert got == {i: (len(s), c) for i, (s, c) in enumerate(zip(sets, want))}
    return len(set(want))


@pytest.fixture
def small_buckets(monkeypatch):
    monkeypatch.setattr(jaccard, "FLUSH_BYTES", 20_000)
    monkeypatch.setattr(jaccard, "BUCKET_BYTES", 20_000)


@pytest.mark.parametrize("seed", [1, 2])
def test_edits_around_the_threshold(spark, small_buckets, seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(60):
        n = rng.choice([1, 3, 6, 8, 12, 20, 35, 64, 100, 130, 250, 500])
        base = [f"w{rng.randrange(5000)}" for _ in range(n)]
        texts.append(" ".join(base))
        # an edit changes about five shingles, so these straddle a similarity of 0.75
        for _ in range(rng.randint(0, 4)):
            texts.append(" ".join(edited(rng, base, rng.randint(0, max(1, n // 25)))))
    assert check(spark, texts) < len(texts)


def test_shared_passage_of_many_documents(spark, small_buckets):
    rng = random.Random(3)
    passage = [f"p{i}" for i in range(70)]
    texts = []
    for _ in range(80):
        own = [f"u{rng.randrange(10**6)}" for _ in range(rng.randint(15, 60))]
        texts.append(" ".join(passage + own))
    texts += [" ".join(edited(rng, t.split(), 1)) for t in texts[:10]]
    check(spark, texts)


def test_family_of_near_copies(spark, small_buckets):
    rng = random.Random(4)
    base = [f"w{rng.randrange(5000)}" for _ in range(120)]
    check(spark, [" ".join(edited(rng, base, rng.randint(0, 4))) for _ in range(120)])


@pytest.mark.parametrize(("num", "den", "shingle"), [(1, 2, 1), (9, 10, 3), (4, 5, 1)])
def test_other_thresholds(spark, small_buckets, num, den, shingle):
    rng = random.Random(num)
    texts = []
    for _ in range(25):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randint(1, 60))]
        texts += [" ".join(edited(rng, base, rng.randint(0, len(base) // 2))) for _ in range(4)]
    check(spark, texts, num=num, den=den, shingle=shingle)


def test_deletion_neighbourhoods_find_what_exact_segments_miss(spark):
    """Every set whose exact credits run out is looked up by neighbourhoods too."""
    bands = jaccard.Bands(3, 4)
    described = spark.createDataFrame([(7, 100, 30, 5, 0, 0)], "set_key bigint, n_shingles bigint, used_0 int, up_0 int, used_1 int, up_1 int")
    shared = [(s, k, 0, -1, False) for s in range(20) for k in (7, 8)] + [(100 + s, k, 0, s, k == 8) for s in range(3) for k in (7, 8)]
    frame = spark.createDataFrame(shared, "sig bigint, set_key bigint, role int, slot int, deleted boolean")
    chosen = jaccard.allocate(frame, described, bands).collect()
    # need 29, offered 30 of which 20 are shared, 2 free neighbourhoods: 17 exact signatures are looked up
    assert len([r for r in chosen if r.by_exact]) == 17 and not [r for r in chosen if r.upgrade]
    few = described.withColumn("used_0", F.lit(20))
    chosen = jaccard.allocate(frame, few, bands).collect()
    assert len([r for r in chosen if r.by_exact]) == 20 and len([r for r in chosen if r.upgrade]) == 3


def test_odd_rows(spark):
    rows = odd_rows()
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in join_similar(odd_docs(spark)).collect()), key=repr)
    sets = [shingle_set(r[1]) for r in rows]
    roots = groups(sets)
    want = []
    for r, s, c in zip(rows, sets, roots):
        ids = [x[0] for x, d in zip(rows, roots) if d == c and x[0] is not None]
        want.append((r[0], len(s), min(ids) if s and ids else r[0]))
    assert got == sorted(want, key=repr)
    assert join_similar(no_docs(spark)).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 140)] + [(200, 200), (300, 301), (301, 300)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert {found[i] for i in range(31)} == {0} and {found[i] for i in range(100, 140)} == {100} and found[301] == 300
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_one_document_of_each_group_stays(spark):
    kept = jaccard.one_per_group(odd_docs(spark))
    assert kept.columns == odd_docs(spark).columns
    rows = sorted(((r.doc_id, (r.text or "")[:7]) for r in kept.collect()), key=repr)
    # the copies under 1, 2 and NULL are one group, as are 7 and 8; texts without words all stay
    assert rows == sorted([(1, "the cat"), (2, "another"), (None, ""), (3, ""), (4, ""), (5, " \t\n "), (6, "12 34 %"), (7, "w0x0 w1"), (9, "Größe u"), (10, "x")], key=repr)
    assert jaccard.one_per_group(no_docs(spark)).count() == 0


def compared(spark, monkeypatch, texts):
    """Pairs that the second phase compares."""
    seen, verify = [], jaccard._verify
    monkeypatch.setattr(jaccard, "_verify", lambda pairs, *more: seen.append(pairs.count()) or verify(pairs, *more))
    check(spark, texts)
    monkeypatch.setattr(jaccard, "_verify", verify)
    return seen[1]


def test_unlinked_texts_around_one_passage_do_not_meet(spark, monkeypatch):
    """120 shared words and 45 of their own: every signature of the passage is shared by all."""
    passage = [f"p{i}" for i in range(120)]
    texts = [" ".join(passage + [f"u{n}x{i}" for i in range(45)]) for n in range(200)]
    assert compared(spark, monkeypatch, texts) == 0


def test_linked_and_unlinked_texts_around_one_passage(spark, monkeypatch):
    """Pairs of near copies in the family, texts with little of their own, and chains through them."""
    rng = random.Random(9)
    passage = [f"p{i}" for i in range(120)]
    texts = [" ".join(passage + [f"u{n}x{i}" for i in range(rng.choice([2, 10, 17, 18, 19, 20, 22, 30, 45]))]) for n in range(60)]
    texts += [" ".join(edited(rng, t.split(), rng.randint(1, 3))) for t in texts]
    few = compared(spark, monkeypatch, texts)
    assert few < len(texts) * (len(texts) - 1) / 2


def test_variants_that_share_most_signatures_hardly_meet(spark, monkeypatch):
    rng = random.Random(7)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for _ in range(240):
        words = list(base)
        for at in rng.sample(range(150), rng.randint(2, 11)):
            words[at] = f"e{rng.randrange(6)}"
        texts.append(" ".join(words))
    compared = []
    verify = jaccard._verify
    monkeypatch.setattr(jaccard, "_verify", lambda pairs, *rest: compared.append(pairs.count()) or verify(pairs, *rest))
    assert check(spark, texts) > 20
    # the first comparison is with one text a signature
    assert 10 * sum(compared[1:]) < len(texts) * (len(texts) - 1) / 2
