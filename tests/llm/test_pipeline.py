import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from brute import groups, no_docs, odd_docs, odd_rows, shingle_set
from flowsift.llm import catalog
from flowsift.llm.decontaminate import find_contamination, hit_words, is_contaminated

DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, sf):
    """Input and output of every stage over the smallest documents."""
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), []
    for name, step in corpus_pipeline.STAGES:
        after = corpus_pipeline.written(step(spark, docs, sf), f"test-{name}")
        out.append((name, docs, after))
        docs = after
    return out


def test_order_and_columns(stages):
    assert [name for name, _, _ in stages] == ["language", "near_duplicates", "decontaminated", "private", "mixed"]
    for _, _, after in stages[:-1]:
        assert after.columns == DOCUMENTS


def test_language_keeps_prose(stages):
    _, before, after = stages[0]
    assert after.count() >= 0.98 * before.where(F.col("text").rlike(r"\p{L}")).count()
    assert after.where("NOT text RLIKE '\\\\p{L}'").count() == 0


def test_one_of_each_group_stays(stages):
    _, before, after = stages[1]
    rows = sorted((r.doc_id, r.text) for r in before.collect())
    roots = groups([shingle_set(t) for _, t in rows])
    assert sorted(r.doc_id for r in after.collect()) == sorted({rows[i][0] for i in roots})


def test_contaminated_documents_go(spark, sf, stages):
    _, before, after = stages[2]
    found = find_contamination(before, spark.read.parquet(f"{sf}/benchmark.parquet"))
    bad = found.where(is_contaminated(hit_words(), F.col("n_words"))).select("doc_id").collect()
    kept = {r.doc_id for r in after.collect()}
    assert kept == {r.doc_id for r in before.collect()} - {r.doc_id for r in bad}


def test_private_data_goes_and_counts_follow(stages):
    _, before, after = stages[3]
    assert after.count() == before.count()
    assert after.where("text RLIKE '[0-9]{16}|@mail'").count() <= before.where("text RLIKE '[0-9]{16}'").count()
    assert after.where("n_chars != length(text)").count() == 0


def test_mix_meets_its_targets(stages):
    _, before, after = stages[4]
    assert after.count() == before.count()
    off = after.groupBy("source", "target").agg(F.sum("taken").alias("taken")).where("abs(taken - target) > 0.5").count()
    assert off == 0


def test_run_applies_all_stages(spark, sf, stages):
    assert sorted(map(repr, corpus_pipeline.run(spark, sf).collect())) == sorted(map(repr, stages[-1][2].collect()))


@pytest.mark.parametrize("number", range(5))
def test_stages_stand_odd_rows(spark, sf, number):
    name, step = corpus_pipeline.STAGES[number]
    docs = odd_docs(spark)
    after = step(spark, docs, sf)
    assert after.columns == docs.columns if number < 4 else "taken" in after.columns
    assert 0 < after.count() <= docs.count()
    if number < 4:  # columns named like those of an operator come out with their own values
        kept = [c for c in docs.columns if c not in ("text", "n_chars")]
        assert {repr(r) for r in after.select(kept).collect()} <= {repr(r) for r in docs.select(kept).collect()}
        assert {(r.score, r.lang_pred, r.n_words, r.row) for r in after.collect()} == {(0.5, odd_rows()[0][11], "n", "r")}
    assert step(spark, no_docs(spark), sf).count() == 0


def test_queries_are_registered_by_number():
    assert sorted(int(name[2:].split("_")[0]) for name in catalog.QUERIES) == list(range(1, 14))
    assert set(catalog.ORACLES) <= set(catalog.QUERIES)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, sf, oracle, name):
    def rows(table):
        columns = sorted(table.column_names)
        return columns, sorted(map(repr, zip(*(table.column(c).to_pylist() for c in columns))))

    assert rows(catalog.QUERIES[name](spark, sf).toArrow()) == rows(oracle.execute(catalog.ORACLES[name]).to_arrow_table())
