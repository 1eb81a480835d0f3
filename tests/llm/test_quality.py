import numpy as np
from pyspark.sql import functions as F

from brute import no_docs, odd_docs, odd_rows
from flowsift.llm.quality import FEATURES, classify_quality, document_statistics, fit_quality, rising
from flowsift.llm.words import held_out


def test_held_out_labels(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    held = held_out(F.col("doc_id"), 4, 2)
    scored, _ = classify_quality(docs, labels, ~held)
    assert scored.count() == docs.count()
    rows = scored.join(labels, "doc_id").where(held).collect()
    right = np.mean([(r.score >= 0.7) == (r.quality == 1) for r in rows])
    good, poor = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    assert len(rows) > 10 and right > 0.9 and np.mean(good) > np.mean(poor) + 0.5


def test_statistics(spark):
    texts = [(1, "One two two.\nOne two two.\n9 é"), (2, ""), (3, None)]
    got = {r.doc_id: r for r in document_statistics(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()}
    r = got[1]
    assert abs(r.log_words - np.log1p(8)) < 1e-9 and r.distinct_words == 5 / 8 and r.top_word == 2 / 8
    assert abs(r.distinct_lines - 2 / 3) < 1e-9 and abs(r.upper - 2 / 30) < 1e-9 and abs(r.digits - 1 / 30) < 1e-9
    assert got[2].log_words == got[3].log_words == 0.0 and got[2].distinct_words == 0.0


def test_partitions_do_not_matter(spark):
    rng = np.random.default_rng(1)
    rows = [(*map(float, rng.normal(size=len(FEATURES))), None) for _ in range(500)]
    rows = [(*r[:-1], float(r[0] * r[1] > 0)) for r in rows]
    frame = spark.createDataFrame(rows, [*FEATURES, "label"])
    a, b = (fit_quality(frame.repartition(n)) for n in (1, 6))
    x = np.array([r[:-1] for r in rows])
    assert np.allclose(a.raw(x), b.raw(x), atol=1e-6)
    # a product of two signs among ten other numbers; a linear score would be right half the time
    assert np.mean((a.score(x) > 0.5) == np.array([r[-1] for r in rows])) > 0.8


def test_isotonic_regression():
    n, s = np.array([1.0, 1, 2, 1, 1]), np.array([0.0, 1, 0, 1, 1])
    assert rising(n, s).tolist() == [0.0, 1 / 3, 1 / 3, 1.0, 1.0]


def test_odd_rows(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(1, 1), (3, 0), (7, 1), (7, 0), (None, 1), (4, None), (99, 1)], "doc_id bigint, quality int")
    scored, _ = classify_quality(docs, labels, F.lit(True))
    got = scored.collect()
    assert len(got) == len(odd_rows()) and all(0.0 <= r.score <= 1.0 for r in got)
    for nothing in (labels.limit(0), labels.where("quality IS NULL")):
        assert {r.score for r in classify_quality(docs, nothing, F.lit(True))[0].collect()} == {0.5}
    one_class, _ = classify_quality(docs, labels.where("quality = 1"), F.lit(True))
    assert {r.score for r in one_class.collect()} == {1.0}
    assert classify_quality(no_docs(spark), labels, F.lit(True))[0].count() == 0
