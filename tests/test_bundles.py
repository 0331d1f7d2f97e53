import json

import pytest
from pyspark.sql import functions as F

from cardloom.sources.bundles import Bundles, bundle_id, object_path

FILES = "target string, name string, uri string, content binary"


@pytest.fixture
def files(spark):
    spark.dataSource.register(Bundles)
    rows = [("t", "README.md", "u/r", b"hello"), ("t", "config.json", "u/c", b"{}"), ("u", "README.md", "v/r", b"hello"), ("u", "gone", None, None), ("u", "empty", "v/e", b""), ("é x", "n\n2", "u", b"\xff\x00")]
    return spark.createDataFrame(rows, FILES).repartition(3, "name")


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_round_trip_faults_and_no_second_write(spark, files, tmp_path):
    path = str(tmp_path / "b")
    files.write.format("bundle").mode("append").save(path)
    back = spark.read.format("bundle").load(path)
    assert _rows(back.select("target", "name", "uri", "content")) == _rows(files)
    assert back.where("fault is not null or sha256 <> sha2(content, 256) or size_bytes <> length(content)").count() == 0
    assert json.loads((tmp_path / "b" / "manifest.json").read_text())["files"] == 6
    assert len(list((tmp_path / "b" / "objects").rglob("*/*/*"))) == 4  # equal contents are one object
    with pytest.raises(Exception, match="never written over"):
        files.write.format("bundle").mode("append").save(path)
    with pytest.raises(Exception, match="never written over"):
        files.write.format("bundle").mode("overwrite").save(path)
    files.repartition(3, "name").write.format("bundle").mode("append").save(str(tmp_path / "c"))
    assert bundle_id(path) == bundle_id(str(tmp_path / "c"))
    hello, config = (tmp_path / "b" / object_path(back.where(f"name = '{n}'").first().sha256) for n in ("README.md", "config.json"))
    hello.write_bytes(b"hellO")
    config.write_bytes(b"{}}")
    (tmp_path / "b" / object_path(back.where("name = 'empty'").first().sha256)).unlink()
    got = {r.name: r.fault for r in back.where("fault is not null and content is null").collect()}
    assert got == {"README.md": "digest_differs", "config.json": "size_differs", "empty": "object_missing"}
    part = next((tmp_path / "b" / "manifest").glob("*.jsonl"))
    part.write_bytes(part.read_bytes() + b"{}")
    with pytest.raises(Exception, match="manifest was changed"):
        back.collect()


def test_a_failed_task_leaves_nothing(spark, files, tmp_path):
    broken = files.withColumn("uri", F.when(F.col("name") == "gone", F.raise_error(F.lit("lost")).cast("string")).otherwise(F.col("uri")))
    with pytest.raises(Exception, match="lost"):
        broken.write.format("bundle").mode("append").save(str(tmp_path / "b"))
    assert list(tmp_path.iterdir()) == []
    with pytest.raises(Exception, match="no bundle"):
        spark.read.format("bundle").load(str(tmp_path / "b")).collect()
    with pytest.raises(Exception, match="takes the columns"):
        files.drop("uri").write.format("bundle").mode("append").save(str(tmp_path / "b"))


def test_empty_bundle(spark, files, tmp_path):
    files.where("false").write.format("bundle").mode("append").save(f"file://{tmp_path}/b")
    assert spark.read.format("bundle").load(f"file://{tmp_path}/b").collect() == []
