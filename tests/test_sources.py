import csv

import pytest
from pyspark.sql import functions as F

from flowsift.plans.preprocess import preprocess_flows, preprocess_payloads, write_processed
from flowsift.schema import FLOW_FEATURES
from flowsift.session import scratch_dir, stage
from flowsift.sources import flows as scan
from flowsift.sources import tables, views


def write_csv(path, header, rows):
    with path.open("w", newline="") as fh:
        out = csv.writer(fh)
        out.writerow(header)
        out.writerows(rows)


def test_real_layout_csv(spark, tmp_path):
    """Padded names, the repeated header column, bad cells, granular labels."""
    names = [f.removesuffix(".1") for f in FLOW_FEATURES]
    header = [f" {n}" for n in names] + [" Label"]
    path = tmp_path / "day.csv"
    write_csv(path, header, [[i + 0.5 for i in range(78)] + ["DoS Hulk"], ["Infinity", "NaN", "", "x"] + [1] * 74 + ["BENIGN"]])
    df = scan.read_flows(spark, str(path))
    assert df.columns == [*FLOW_FEATURES, "Label"]
    row = df.where("Label = 'DoS'").first()
    assert row["Fwd Header Length"] == FLOW_FEATURES.index("Fwd Header Length") + 0.5
    assert row["Fwd Header Length.1"] == FLOW_FEATURES.index("Fwd Header Length.1") + 0.5
    bad = df.where("Label = 'BENIGN'").first()
    assert bad[0] == float("inf") and bad[1] != bad[1] and bad[2] is None and bad[3] is None


def test_csv_folder_union(spark, tmp_path):
    write_csv(tmp_path / "a.csv", ["x", "y", "label"], [[1, 2, "Bot"]])
    write_csv(tmp_path / "b.csv", ["label", " x "], [["DDoS", 3]])
    write_csv(tmp_path / "c.csv", ["x", "y", "label"], [[5, 6, ""]])
    rows = scan.read_flows(spark, str(tmp_path), ["x", "y"]).collect()
    assert sorted(tuple(r) for r in rows if r["y"] is not None) == [(1.0, 2.0, "Botnet"), (5.0, 6.0, "BENIGN")]
    assert [tuple(r) for r in rows if r["y"] is None] == [(3.0, None, "DDoS")]


def test_scan_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        scan.read_flows(spark, str(tmp_path))
    write_csv(tmp_path / "a.csv", ["x", "label"], [[1, "Bot"]])
    with pytest.raises(ValueError, match="77|78"):
        scan.read_flows(spark, str(tmp_path / "a.csv"))
    with pytest.raises(ValueError, match="label"):
        scan.read_payloads(spark, str(tmp_path / "a.csv"))


def test_payload_csv(spark, tmp_path):
    write_csv(tmp_path / "p.csv", ["extra", "payload", "label"], [["e", 'say "hi",\nthen', 1], ["e", "ls", 0]])
    rows = scan.read_payloads(spark, str(tmp_path / "p.csv")).orderBy("label").collect()
    assert [tuple(r) for r in rows] == [("ls", 0), ('say "hi",\nthen', 1)]


def test_materialize(spark, tmp_path):
    path = str(tmp_path / "t")

    def make(n):
        return lambda: spark.range(n)

    assert tables.materialize(spark, make(3), path) == "written"
    assert tables.materialize(spark, make(5), path) == "kept"
    assert spark.read.parquet(path).count() == 3
    assert tables.materialize(spark, make(5), path, force=True) == "written"
    assert spark.read.parquet(path).count() == 5
    real = tmp_path / "real"
    real.mkdir()
    assert tables.materialize(spark, make(6), path, csv_folder=str(real)) == "kept"
    (real / "x.csv").write_text("a\n1\n")
    assert tables.materialize(spark, make(6), path, force=True, csv_folder=str(real)) == "csv_present"


def test_runs_append(spark, tmp_path):
    path = str(tmp_path / "runs")
    tables.append_run(spark, path, "a", {"depth": 6}, {"pr_auc": 0.5}, {"loss": [0.9, 0.4]}, {"ok": True})
    tables.append_run(spark, path, "b", metrics={"pr_auc": 0.6})
    rows = tables.read_runs(spark, path)
    assert rows.count() == 6
    assert [r["value"] for r in rows.where("kind = 'series'").orderBy("step").collect()] == ["0.9", "0.4"]


def test_vocab_round_trip(spark, tmp_path):
    words = spark.createDataFrame([("é\n", 4, 2), ('"', 1, 3)], tables.VOCAB_SCHEMA)
    back = tables.load_vocab(spark, tables.save_vocab(words, str(tmp_path / "v")))
    assert sorted(back.collect()) == sorted(words.collect())


class Session:
    """Just enough of a session to ask for its scratch folder."""

    def __init__(self, folder, master):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "app"})


def test_scratch_follows_the_checkpoint_folder():
    assert scratch_dir(Session("s3a://b/c/", "yarn"), "x").startswith("s3a://b/c/x-")
    a, b = (scratch_dir(Session(None, "local[2]"), "x") for _ in range(2))
    assert a != b and a.rsplit("/", 1)[0] == b.rsplit("/", 1)[0]
    with pytest.raises(RuntimeError):
        scratch_dir(Session(None, "yarn"), "x")


def test_stage_reads_back(spark):
    df = spark.range(4).withColumn("p", F.col("id") % 2)
    assert sorted(stage(df, "y", partition_by="p").collect()) == sorted(df.collect())


def test_pipeline_is_leak_free(spark, sf, tmp_path):
    raw = views.flows_dup(spark, sf)
    out, pre = preprocess_flows(raw, views.FLOW_COLS, views.FLOW_KEYS, "label")
    assert out.count() == views.flows(spark, sf).count()
    train = out.where("split = 'train'")
    means = train.agg(*[F.avg(c) for c in views.FLOW_COLS]).first()
    assert all(abs(m) < 1e-2 for m in means)
    path = write_processed(out, str(tmp_path / "processed"), views.FLOW_COLS)
    assert scan.read_split(spark, path, "val").count() == out.where("split = 'val'").count()
    plan = scan.read_split(spark, path, "val", ["bytes"])._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(split" in plan and "ReadSchema: struct<bytes:float>" in plan
    broken = out.withColumn("bytes", F.lit(float("nan")))
    with pytest.raises(ValueError):
        write_processed(broken, str(tmp_path / "broken"), views.FLOW_COLS)
    assert pre.fitted


def test_payload_pipeline(spark, sf):
    parts, words = preprocess_payloads(views.payloads(spark, sf), ["doc_id"], "payload", "label")
    assert parts.count() == views.payloads(spark, sf).count()
    unseen = words.join(
        parts.where("split = 'train'").select(F.explode(F.split(F.lower("payload"), "")).alias("token")).distinct(),
        "token",
        "left_anti",
    )
    assert unseen.count() == 0
    doubled = views.payloads(spark, sf).unionByName(views.payloads(spark, sf).withColumn("doc_id", F.col("doc_id") + 10**6))
    once, _ = preprocess_payloads(doubled, ["doc_id"], "payload", "label", drop_duplicates=True)
    assert once.count() == parts.select("payload", "label").distinct().count()


def test_malformed_lines_are_rejected_with_their_reason(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x, y ,label\n1,2,Bot\n3,4\n5,6,DDoS,7\n8,"9,BENIGN\n\n10,"1,5",BENIGN\n11,,\n13,5" pipe,"a ""b"", c"\n14,2,"open\n')
    (tmp_path / "b.csv").write_text("label,x\nBot,12\nBot\nx" + ",1" * 50_000 + "\n")
    rows, rejects = scan.read_csv_checked(spark, str(tmp_path))
    found = {(r["file"][-5:], r["line"][:12], r["reason"]) for r in rejects.collect()}
    assert found == {
        ("a.csv", "3,4", "too few cells"),
        ("a.csv", "5,6,DDoS,7", "too many cells"),
        ("a.csv", '8,"9,BENIGN', "unclosed quote"),
        ("a.csv", '14,2,"open', "unclosed quote"),
        ("b.csv", "Bot", "too few cells"),
        ("b.csv", "x,1,1,1,1,1,", "too many cells"),
    }
    assert sorted((r["x"], r["y"] or "", r["label"] or "") for r in rows.collect()) == [("1", "2", "Bot"), ("10", "1,5", "BENIGN"), ("11", "", ""), ("12", "", "Bot"), ("13", '5" pipe', 'a "b", c')]
    # the same lines, whichever columns are asked for
    assert rows.select("x").count() == rows.count() == 5 and rejects.select("reason").count() == rejects.count() == 6


def test_checked_flows_of_one_file(spark, tmp_path):
    write_csv(tmp_path / "a.csv", [" x", "y ", "Label"], [[1, 2, "Bot"], [3, 4, "DDoS", 5], [6, "bad", "BENIGN"]])
    flows, rejects = scan.read_flows_checked(spark, str(tmp_path / "a.csv"), ["x", "y"])
    assert sorted(map(tuple, flows.collect())) == [(1.0, 2.0, "Botnet"), (6.0, None, "BENIGN")]
    assert [r["reason"] for r in rejects.collect()] == ["too many cells"]


def test_written_tables_are_packed(spark, sf, monkeypatch, tmp_path):
    """Staged tables, and the splits that ``scan_split`` writes, take zstd."""
    from flowsift import session
    from flowsift.catalog import scans

    monkeypatch.setattr(session, "scratch_dir", lambda *_: f"{tmp_path}/staged")
    monkeypatch.setattr(scans, "scratch_dir", lambda *_: f"{tmp_path}/splits")
    assert scans.scan_split(spark, sf).count() == 8
    files = [p for p in tmp_path.rglob("*.parquet") if p.is_file()]
    assert {p.relative_to(tmp_path).parts[0] for p in files} == {"staged", "splits"}
    assert all(p.name.endswith(".zstd.parquet") for p in files)
