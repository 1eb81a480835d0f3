import math

import pytest
from pyspark.sql import functions as F

from flowsift.functions.text import char_ngrams
from flowsift.operators import grams, vocab


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(0, "ls -la"), (1, "ls /tmp"), (2, "cat a"), (3, ""), (4, None)]
    return spark.createDataFrame(rows, "id int, t string")


def test_vocabulary_order_and_cap(spark, corpus):
    full = {r["token"]: r["id"] for r in vocab.build_vocabulary(corpus, "t").collect()}
    assert full[" "] == 2 and full["a"] == 3 and full["l"] == 4
    assert sorted(full.values()) == list(range(2, 2 + len(full)))
    assert vocab.vocab_size(vocab.build_vocabulary(corpus, "t")).first()[0] == len(full) + 2
    assert vocab.build_vocabulary(corpus, "t", max_vocab=5).count() == 3
    assert vocab.build_vocabulary(corpus, "t", max_vocab=1).count() == 0
    assert {r["token"] for r in vocab.build_vocabulary(corpus, "t", "word", min_freq=2).collect()} == {"ls"}


@pytest.mark.parametrize("level", ["char", "word"])
@pytest.mark.parametrize("max_len", [3, 8])
def test_encode_paths_agree(spark, corpus, level, max_len):
    words = vocab.build_vocabulary(corpus.where("id < 2"), "t", level)
    by_map = vocab.encode_tokens(corpus, ["id"], "t", words, level, max_len=max_len)
    by_join = vocab.encode_tokens(corpus, ["id"], "t", words, level, max_len=max_len, map_tokens=0)
    a, b = ({r["id"]: r["ids"] for r in df.collect()} for df in (by_map, by_join))
    assert a == b and set(a) == {0, 1, 2, 3, 4}
    assert all(len(ids) == max_len for ids in a.values())
    assert a[3] == a[4] == [0] * max_len
    assert 1 in a[2]


def test_encode_with_empty_vocabulary(corpus):
    words = vocab.build_vocabulary(corpus, "t", max_vocab=0)
    ids = {r["id"]: r["ids"] for r in vocab.encode_tokens(corpus, ["id"], "t", words, max_len=2).collect()}
    assert ids[2] == [1, 1] and ids[3] == [0, 0]


def test_tfidf_by_hand(spark):
    df = spark.createDataFrame([(0, "ab"), (1, "a"), (2, "a")], "id int, t string")
    got = {(r["id"], r["term"]): r["weight"] for r in vocab.tfidf(df, "id", "t", min_df=2, low=1, high=1).collect()}
    both = math.log(4 / 4) + 1
    norm = math.sqrt((2 * both) ** 2 + both**2)
    assert got[0, " "] == pytest.approx(2 * both / norm) and got[0, "a"] == pytest.approx(both / norm)
    assert (0, "b") not in got


def test_tfidf_joins_agree(spark, corpus, monkeypatch):
    small = vocab.tfidf(corpus, "id", "t").collect()
    monkeypatch.setattr(vocab, "attach", lambda wide, dim, on, how="inner": __import__(
        "flowsift.operators.joins", fromlist=["salted_join"]).salted_join(wide, dim, on, how))
    large = vocab.tfidf(corpus, "id", "t").collect()
    def key(rows):
        return sorted((r["id"], r["term"], round(r["weight"], 12)) for r in rows)

    assert key(small) == key(large)


def test_token_counts_do_not_depend_on_partitions(corpus):
    a = vocab.token_counts(corpus, "t")
    b = vocab.token_counts(corpus.repartition(7), "t")
    assert sorted(a.collect()) == sorted(b.collect())
    assert a.agg(F.sum("freq")).first()[0] == 18


@pytest.mark.parametrize("low, high", [(1, 3), (1, 1), (2, 3), (3, 3)])
def test_counted_grams_equal_the_pattern(spark, low, high, monkeypatch):
    wide = "".join(chr(0x4E00 + i) for i in range(20_000))
    texts = ["ls -la", "", None, "  a\t b\n\nc ", "\x00a \x00\x00 a\x00", "\u2003\u00a0", "İß Σας \U0001F600x", "a" * 70_000, wide + "\U0010FFFF", "x\u0085\x1cy"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string").coalesce(1)
    got = df.select("id", F.inline(grams.gram_counts(F.col("t"), low, high)).alias("g", "n"))
    got = got.select("id", grams.gram_text(F.col("g")).alias("term"), "n")
    want = df.select("id", F.explode(char_ngrams(F.coalesce("t", F.lit("")), low, high)).alias("term"))
    want = want.groupBy("id", "term").agg(F.count("*").cast("int").alias("n"))
    assert sorted(got.collect()) == sorted(want.collect())


def test_tfidf_ways_agree(spark, corpus):
    """Terms listed in tasks, joined, and patterns for longer grams; a repeated key is one text."""
    def key(df):
        return sorted((r["id"], r["term"], round(r["weight"], 12)) for r in df.collect())

    assert key(vocab.tfidf(corpus, "id", "t")) == key(vocab.tfidf(corpus, "id", "t", most=0))
    doubled = corpus.unionByName(corpus.where("id = 0").withColumn("t", F.lit("cat la")))
    got = vocab.tfidf(doubled, "id", "t")
    assert got.groupBy("id", "term").count().where("count > 1").count() == 0
    assert all(abs(r[0] - 1) < 1e-9 for r in got.groupBy("id").agg(F.sum(F.col("weight") ** 2)).select("sum(POWER(weight, 2))").collect())
    assert vocab.tfidf(corpus, "id", "t", low=1, high=4).where("length(term) = 4").count() == 2
