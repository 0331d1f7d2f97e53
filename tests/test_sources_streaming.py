import json

from pyspark.sql import functions as F

from cardloom.sources import readers
from cardloom.streaming import logs


def test_targets(spark, tmp_path):
    p = tmp_path / "targets.txt"
    p.write_text("# list\n a/b@1 \n\nc/d@2\na/b@1\n")
    assert [r.target for r in readers.read_targets(spark, str(p)).orderBy("pos").collect()] == ["a/b@1", "c/d@2"]
    df = spark.createDataFrame([("o/m@x@abc",)], "t string").select(readers.parse_target(F.col("t")).alias("p"))
    assert tuple(df.first().p) == ("o/m@x", "abc")


def test_usage_log_drops_broken_lines(spark, tmp_path):
    run = tmp_path / "run1"
    run.mkdir()
    (run / "usage.jsonl").write_text('{"cost": 0.004, "provider": "p"}\n\nbroken\n{"cost": 0.006, "provider": "q", "input_tokens": 3}\n')
    rows = readers.read_usage(spark, str(tmp_path / "*")).collect()
    assert [(r.run, r.cost) for r in sorted(rows, key=lambda r: r.cost)] == [("run1", 0.004), ("run1", 0.006)]


def test_evaluations_cards_and_frozen_files(spark, tmp_path):
    d = tmp_path / "data" / "mmlu" / "own" / "m"
    d.mkdir(parents=True)
    (d / "u.json").write_text(json.dumps({"evaluation_results": [{"evaluation_name": "MMLU", "metric_config": {"metric_name": "acc", "metric_id": "a"}, "score_details": {"score": 0.5}}]}))
    (d / "v.json").write_text("{broken")
    got = readers.read_evaluations(spark, str(tmp_path / "data")).collect()
    assert [(r.benchmark, r.model_id, r.evaluation_name, r.score) for r in got] == [("mmlu", "own/m", "MMLU", 0.5)]
    cards = tmp_path / "cards"
    cards.mkdir()
    (cards / "one.json").write_text(json.dumps({"identity": {"name": "One", "model_type": "Not specified"}, "lineage": {"base_models": ["x", "y"]}}))
    cells = {(r.target, r.section, r.field): r.value for r in readers.read_cards(spark, str(cards)).collect()}
    assert cells == {("one", "identity", "name"): "One", ("one", "identity", "model_type"): "Not specified", ("one", "lineage", "base_models"): '["x","y"]'}
    (cards / "bad.bin").write_bytes(b"\xff\xfe")
    frozen = {r["name"]: (r.valid, r.content is None) for r in readers.freeze(spark, str(cards)).collect()}
    assert frozen == {"one.json": (True, False), "bad.bin": (False, True)}


def test_front_matter_and_sections(spark):
    text = '---\nlicense: mit\ntags:\n- a\nname: "X y"\nlicense: gpl\n---\n# A\n## B\ntext\n# C\n### D\n'
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert df.select(readers.front_matter(F.col("text"))).first()[0] == {"license": "mit", "name": "X y"}
    assert [r.path for r in readers.sections(df).orderBy("at").collect()] == [["A"], ["A", "B"], ["C"], ["C", "D"]]


def test_streams(spark, tmp_path):
    src = tmp_path / "in"
    rows = [(f"r{i % 2}", float(i), f"2026-01-01 00:{i:02d}:00") for i in range(20)]
    df = spark.createDataFrame(rows, "run string, cost double, ts string").withColumn("ts", F.to_timestamp("ts"))
    df.write.parquet(str(src))
    stopped = []
    stream = spark.readStream.schema(df.schema).parquet(str(src))
    totals = stream.groupBy("run").agg(F.sum("cost").alias("cost"))
    q = totals.writeStream.outputMode("complete").foreachBatch(logs.stop_above(95.0, lambda r, c: stopped.append((r, c)))).option("checkpointLocation", str(tmp_path / "c1")).start()
    q.processAllAvailable()
    q.stop()
    assert stopped == [("r1", 100.0)]
    last = logs.latest_events(stream, "run", "ts", ["cost"]).writeStream.outputMode("complete").format("memory").queryName("last").option("checkpointLocation", str(tmp_path / "c2")).start()
    last.processAllAvailable()
    last.stop()
    assert {tuple(r) for r in spark.table("last").collect()} == {("r0", 18.0), ("r1", 19.0)}
    hours = logs.spend_by_window(stream).writeStream.outputMode("update").format("memory").queryName("hours").option("checkpointLocation", str(tmp_path / "c3")).start()
    hours.processAllAvailable()
    hours.stop()
    assert spark.table("hours").agg(F.sum("calls")).first()[0] == 20
