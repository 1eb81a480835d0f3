import random

from brute import alnum, no_docs, odd_docs
from flowsift.llm.licenses import NOTICES, PHRASES, license_report, scan_licenses


def expected(text):
    words = [w.decode() for w in alnum(text)]
    at, labels = [], set()
    for phrase, label in PHRASES.items():
        phrase = phrase.split()
        for i in range(len(words) - len(phrase) + 1):
            if words[i : i + len(phrase)] == phrase:
                at.append(i)
                labels.add(label)
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def test_base_phrases_equal_brute_force(spark):
    rng = random.Random(2)
    vocabulary = ["cc", "by", "CC-BY", "general", "public", "license", "GENERAL", "all", "rights", "reserved.", "x", "é", "general public license", "All rights reserved"]
    docs = [(i, rng.choice([" ", "\n", ", ", "-"]).join(rng.choice(vocabulary) for _ in range(rng.randint(0, 30)))) for i in range(150)]
    docs += [(500, "cc by " * 400), (501, "by cc"), (502, "cc"), (503, "general public license general public license")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in license_report(frame).collect()}
    assert got == {i: expected(t) for i, t in docs}


def test_notices_with_changes(spark):
    label, notice = next((lab, n) for lab, n in NOTICES if lab == "bsd")
    words = notice.split()
    changed = " ".join(words[:6] + ["whatsoever"] + words[6:14] + words[15:])
    docs = [(i, f"intro text {n} more text") for i, (_, n) in enumerate(NOTICES)] + [(100, "one two " + changed + " three"), (101, " ".join(words[:5])), (102, notice.upper())]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {r.doc_id: r for r in license_report(frame).collect()}
    for i, (lab, _) in enumerate(NOTICES):
        assert lab in got[i].labels.split(",") and got[i].score == 1.0
    assert got[100].labels == "bsd" and 0.8 <= got[100].score <= 1.0
    assert got[101].labels == "" and got[101].score == 0.0 and got[102].labels == "bsd"
    spans = [(r.start, r.end) for r in scan_licenses(frame)[1].where("doc_id = 100").collect()]
    assert spans == [(2, 2 + len(changed.split()))]


def test_versions_are_told_apart(spark):
    frame = spark.createDataFrame([(1, "This work is licensed under the GNU General Public License, version 3.")], "doc_id bigint, text string")
    row = license_report(frame).head()
    assert row.labels == "gpl,gpl-3.0" and row.base_labels == "gpl"


def test_odd_rows(spark):
    docs = odd_docs(spark)
    got = sorted(((r.doc_id, r.n_words, r.labels) for r in license_report(docs).collect()), key=repr)
    assert got == sorted(((r.doc_id, len(alnum(r.text)), "") for r in docs.collect()), key=repr)
    both = spark.createDataFrame([(None, "cc by"), (None, "cc by"), (1, "cc by"), (1, "all rights reserved"), (1, None)], "doc_id bigint, text string")
    assert sorted(r.n_base for r in license_report(both).collect()) == [0, 1, 1, 1, 1]
    assert license_report(no_docs(spark)).count() == 0
