import time

import pytest
from pyspark.sql import functions as F

from flowsift.functions import labels, numeric, text
from flowsift.schema import FLOW_FEATURES, LABELS, flow_schema, quoted


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_schema_has_78_features_in_order():
    assert len(FLOW_FEATURES) == 78 and len(set(FLOW_FEATURES)) == 78
    assert flow_schema().names[-1] == "Label"
    assert len(set(FLOW_FEATURES)) == 78
    assert quoted("Fwd Header Length.1") == "`Fwd Header Length.1`"


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("DDoS", "DDoS"),
        (" DoS Hulk ", "DoS"),
        ("Web Attack - Brute Force", "Brute Force"),
        ("Web Attack - XSS", "Web Attack"),
        ("Sql Injection", "Web Attack"),
        ("SSH-Patator", "Brute Force"),
        ("Port Scan", "PortScan"),
        ("Bot", "Botnet"),
        ("Heartbleed", "Infiltration"),
        ("\tbenign\n", "BENIGN"),
        ("", "BENIGN"),
        ("nan", "BENIGN"),
        (None, "BENIGN"),
        ("something new", "DoS"),
    ],
)
def test_normalise_label(spark, raw, expected):
    assert one(spark, labels.normalise_label(F.lit(raw).cast("string"))) == expected


def test_labels_round_trip(spark):
    df = spark.createDataFrame([(x,) for x in LABELS], "label string")
    rows = df.select(
        "label", labels.label_id(F.col("label")).alias("i"), labels.label_name(labels.label_id(F.col("label"))).alias("n")
    ).collect()
    assert {r["label"]: r["i"] for r in rows} == {x: i for i, x in enumerate(LABELS)}
    assert all(r["label"] == r["n"] for r in rows)


def test_attack_score_without_benign(spark):
    p = F.array(F.lit(0.2), F.lit(0.8))
    assert one(spark, labels.attack_score(p, [0, 3])) == pytest.approx(0.8)
    assert one(spark, labels.attack_score(p, [2, 3])) == 1.0
    assert one(spark, labels.predicted_class(p, [2, 5])) == 5


def test_finite(spark):
    for bad in (float("inf"), float("-inf"), float("nan"), None):
        assert one(spark, numeric.finite(F.lit(bad).cast("double"))) is None
    assert one(spark, numeric.finite(F.lit(-1.5))) == -1.5


def test_confidence(spark):
    assert one(spark, numeric.confidence(F.lit(0.5))) == 0.0
    assert one(spark, numeric.confidence(F.lit(0.9))) == pytest.approx(0.8)
    assert one(spark, numeric.confidence(F.lit(0.0))) == 1.0


def test_tokens(spark):
    assert one(spark, text.tokens(F.lit("Ab🙂c"))) == ["a", "b", "🙂", "c"]
    assert one(spark, text.tokens(F.lit("Ab"), lowercase=False)) == ["A", "b"]
    assert one(spark, text.tokens(F.lit(""))) == []
    assert one(spark, text.tokens(F.lit(None).cast("string"))) == []
    assert one(spark, text.tokens(F.lit("cat /etc/été_1;"), "word")) == ["cat", "/", "etc", "/", "été_1", ";"]


def by_hand(value, low, high):
    out = []
    for w in value.lower().split():
        w = f" {w} "
        for n in range(low, high + 1):
            out += [w[i : i + n] for i in range(max(1, len(w) - n + 1))]
            if len(w) <= n:
                break
    return sorted(out)


@pytest.mark.parametrize("value", ["ab  cde\tf", "", "   ", "x", "ünï 🙂🙂 z", "a\nb", "--  $(rm)"])
@pytest.mark.parametrize(("low", "high"), [(1, 3), (2, 5), (4, 6)])
def test_char_ngrams(spark, value, low, high):
    assert sorted(one(spark, text.char_ngrams(F.lit(value), low, high))) == by_hand(value, low, high)


def test_text_ngrams_keep_order_and_code_points(spark):
    assert one(spark, text.text_ngrams(F.lit("a🙂\nb"), 2)) == ["a🙂", "🙂\n", "\nb"]
    assert one(spark, text.text_ngrams(F.lit("a"), 2)) == []


@pytest.mark.parametrize(
    ("payload", "expected"),
    [
        ("1 uNion   select a", ["sql_injection"]),
        ("drop table x", ["sql_injection"]),
        ("name' -- ", ["sql_injection"]),
        ("x; wget http://h", ["shell_injection"]),
        ("$(id)", ["shell_injection"]),
        ("..%2f ../a", ["path_traversal"]),
        ("<ScRipt>", ["xss"]),
        ("cat /etc/passwd", ["credential_access"]),
        ("echo x | base64 -d", ["encoded_payload"]),
        ("<script>;nc ../ /etc/shadow", ["shell_injection", "path_traversal", "xss", "credential_access"]),
        ("plain words", []),
        ("", []),
        (None, []),
    ],
)
def test_signatures(spark, payload, expected):
    assert one(spark, text.signatures(F.lit(payload).cast("string"))) == expected


def test_char_ngrams_of_many_spaces(spark):
    """A run of spaces costs its length, wherever it stands."""
    rows = spark.createDataFrame([("a" + " " * 100_000 + "b",), (" " * 100_000 + "a b" + " " * 100_000,), (" " * 100_000,)], "t string")
    began = time.time()
    got = [sorted(r[0]) for r in rows.select(text.char_ngrams(F.col("t"), 2, 2)).collect()]
    assert got == [[" a", " b", "a ", "b "]] * 2 + [[]]
    assert time.time() - began < 30
