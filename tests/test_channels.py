import uuid

import pytest
from pyspark.sql import functions as F

from cardloom.operators.channels import Channel, fill_gaps

FIELDS = ("a", "b", "c")


def _channel(spark, name, fields, first, again, log):
    known = spark.createDataFrame([(*x, g) for g, xs in ((False, first), (True, again)) for x in xs], "target string, field string, value string, again boolean")

    def ask(open_):
        log.append((name, sorted((r.target, r.field) for r in open_.collect())))
        return open_.join(known, ["target", "field", "again"]).select("target", "field", "value")

    return Channel(name, fields, ask)


def test_later_channels_are_asked_for_what_is_open(spark, tmp_path):
    asked = spark.createDataFrame([(t, f) for t in ("t", "u") for f in FIELDS] + [("t", "a"), (None, "a"), ("t", None)], "target string, field string")
    log = []
    channels = [
        _channel(spark, "readme", ("a", "b"), [("t", "a", "x"), ("t", "b", "no")], [("t", "b", "y")], log),
        _channel(spark, "paper", FIELDS, [("u", "a", "no"), ("u", "b", "y")], [("u", "a", "no"), ("u", "c", None)], log),
        _channel(spark, "html", ("c",), [("t", "c", "z")], [("t", "c", "never")], log),
    ]
    covers = F.col("value") != "no"
    folder = str(tmp_path / "run")
    got = sorted((r.channel, r.target, r.field, r.value or "", r.again) for r in fill_gaps(asked, channels, covers, folder).collect())
    every = [(t, f) for t in "tu" for f in FIELDS]
    assert log == [
        ("readme", [x for x in every if x[1] != "c"]), ("readme", [("t", "b")]), ("paper", every), ("paper", [("u", "a"), ("u", "c")]), ("html", [("t", "c"), ("u", "c")]), ("html", []),
    ]
    want = [("html", "t", "c", "z", False), ("paper", "u", "a", "no", False), ("paper", "u", "a", "no", True), ("paper", "u", "b", "y", False), ("paper", "u", "c", "", True), ("readme", "t", "a", "x", False), ("readme", "t", "b", "no", False), ("readme", "t", "b", "y", True)]
    assert got == want
    # a run with the same folder reads what was answered, and one that lost its last answer asks for that alone
    (tmp_path / "run" / "html-again" / "_SUCCESS").unlink()
    log.clear()
    assert fill_gaps(asked, channels, covers, folder).count() == len(want)
    assert log == [("html", [])]
    assert fill_gaps(asked.limit(0), channels, covers, f"{folder}-{uuid.uuid4().hex}").count() == 0


def test_a_failing_channel_leaves_no_table(spark, tmp_path):
    asked = spark.createDataFrame([("t", "a")], "target string, field string")
    broken = Channel("readme", ("a",), lambda q: q.select("target", "field", F.raise_error(F.lit("no answer")).cast("string").alias("value")))
    with pytest.raises(Exception, match="no answer"):
        fill_gaps(asked, [broken], F.lit(True), str(tmp_path / "run"))
    good = Channel("readme", ("a",), lambda q: q.select("target", "field", F.lit("v").alias("value")))
    assert [tuple(r) for r in fill_gaps(asked, [good], F.lit(True), str(tmp_path / "run")).collect()] == [("t", "a", "v", "readme", False)]
    assert fill_gaps(asked, [good], F.lit(True), str(tmp_path / "run")).count() == 1
