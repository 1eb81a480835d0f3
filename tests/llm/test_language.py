import random

from pyspark.sql import functions as F

from brute import no_docs, odd_docs, odd_rows
from flowsift.llm import language
from flowsift.llm.language import fit_languages, identify, learn_and_identify
from flowsift.llm.words import held_out

WORDS = {
    "aa": "the house and river old bank water stone light under".split(),
    "bb": "größe straße über nicht wasser haus stein licht unter fluss".split(),
    "cc": "дом река камень вода свет старый берег под над город".split(),
}


def corpus(seed, n):
    rng = random.Random(seed)
    return [(i, " ".join(rng.choice(WORDS[lang]) for _ in range(rng.randint(3, 40))), lang) for i, lang in enumerate(rng.choice(list(WORDS)) for _ in range(n))]


def test_held_out_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    held = held_out(F.col("doc_id"), 3, 1)
    found = learn_and_identify(docs, ~held).join(docs.select("doc_id", "lang"), "doc_id").where(held)
    right, n = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).head()
    assert n > 30 and right > 0.97


def test_unseen_words_fall_back_to_characters(spark):
    model = fit_languages(spark.createDataFrame(corpus(1, 200), "doc_id bigint, text string, lang string"))
    texts = [(1, "houses riverbank waters underlight"), (2, "straßen häuser wassergröße"), (3, "городской каменный домик"), (4, "STONE THE RIVER"), (5, "日本語"), (6, "123 -"), (7, None)]
    got = {r.doc_id: r for r in identify(spark.createDataFrame(texts, "doc_id bigint, text string"), model).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3, 4)] == ["aa", "bb", "cc", "aa"]
    assert got[5].lang_pred in WORDS and abs(got[5].score - 1 / 3) < 1e-6
    assert (got[6].lang_pred, got[6].score, got[7].lang_pred, got[7].score) == ("und", 0.0, "und", 0.0)


def test_counts_cover_all_rows_whatever_the_partitions(spark):
    frame = spark.createDataFrame(corpus(2, 300), "doc_id bigint, text string, lang string")
    a, b = (fit_languages(frame.repartition(n)) for n in (1, 7))
    assert a.languages == b.languages == sorted(WORDS)
    assert all((x == y).all() for x, y in zip(a.keys, b.keys)) and all((x == y).all() for x, y in zip(a.logs, b.logs))
    small = fit_languages(frame, max_words=5, max_grams=7)
    assert [len(k) for k in small.keys] == [5, 7, 7, 7, 7, 7]


def test_odd_rows(spark):
    docs = odd_docs(spark)
    got = learn_and_identify(docs, F.lit(True)).collect()
    assert len(got) == len(odd_rows())
    by_id = {r.doc_id: r for r in got}
    assert by_id[3].lang_pred == by_id[4].lang_pred == by_id[5].lang_pred == by_id[6].lang_pred == "und"
    assert by_id[1].lang_pred == "en" and by_id[9].lang_pred == "de"
    assert all(0.0 <= r.score <= 1.0 for r in got)
    untaught = learn_and_identify(docs, F.lit(False)).collect()
    assert {(r.lang_pred, r.score) for r in untaught} == {("und", 0.0)}
    assert learn_and_identify(no_docs(spark), F.lit(True)).count() == 0
    kept = identify(docs, fit_languages(docs), keep=docs.columns)
    assert dict(kept.dtypes)["score"] == "double" and set(kept.columns) == set(docs.columns)


def test_a_hot_language_crowds_nobody_out(spark, monkeypatch):
    rng = random.Random(3)
    hot = ["".join(rng.choice("abcdefgh") for _ in range(7)) for _ in range(300)]
    small = ["".join(rng.choice("abcdefgh") for _ in range(7)) for _ in range(8)]
    rows = [(i, " ".join(hot), "aa") for i in range(40)] + [(40, " ".join(small), "bb")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    test = spark.createDataFrame([(1, " ".join(small[:4])), (2, " ".join(hot[:4]))], "doc_id bigint, text string")
    shared = fit_languages(frame, max_words=16, max_grams=40)
    assert len(shared.keys[0]) == 16
    monkeypatch.setattr(language, "MAX_WORDS", 10)
    monkeypatch.setattr(language, "MAX_GRAMS", 60)
    own = fit_languages(frame)
    assert len(own.keys[0]) == 18 and all(len(k) <= 120 for k in own.keys[1:])
    for model in (shared, own):
        missing = model.logs[0].min()
        assert (model.logs[0][:, 1] > missing).sum() == 8
        assert {r.doc_id: r.lang_pred for r in identify(test, model).collect()}[1] == "bb"
