import pytest

from cardloom.llm.common import new_folder
from cardloom.llm.warc import arc_to_records, pages_to_warc, parse_arc, parse_warc

BODY = b"HTTP/1.0 200 OK\r\nX-Page-Id: 4\r\n\r\nhi\nURL x"


def arc(version, records):
    names = {1: b"URL IP-address Archive-date Content-type Archive-length", 2: b"URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"}[version]
    block = b"%d 0 me\n%s\n" % (version, names)
    out = b"filedesc://x.arc 0.0.0.0 19990101000000 text/plain %d\n%s" % (len(block), block)
    for body in records:
        middle = b"" if version == 1 else b" 200 - - 0 x.arc"
        out += b"\nhttp://a.b/c 1.2.3.4 19990203040506 text/html%s %d\n%s" % (middle, len(body), body)
    return out + b"\n"


@pytest.mark.parametrize("version", [1, 2])
def test_lengths_decide_not_line_ends(spark, version):
    data = arc(version, [BODY, b"", BODY + b"\n\nmore"])
    assert [b for _, b in parse_arc(data)] == [BODY, b"", BODY + b"\n\nmore"]
    rows = arc_to_records(spark.createDataFrame([(bytearray(data),)], "archive binary")).collect()
    assert [(r.page_id, r.date, r.ip, r.payload_bytes) for r in rows] == [(4, "1999-02-03T04:05:06Z", "1.2.3.4", 8), (None, "1999-02-03T04:05:06Z", "1.2.3.4", 0), (4, "1999-02-03T04:05:06Z", "1.2.3.4", 14)]
    with pytest.raises(ValueError):
        list(parse_arc(data.replace(b"text/html", b"text/html x y z")))


def test_round_trip_and_revisits(spark):
    big = "é" * 60 + "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n"
    rows = [(3, "http://a/1", big), (2, None, big), (5, "http://a b/\n", big), (6, "u", "small"), (7, "u", "small"), (8, "u", None), (9, "u", ""), (2, "other", big), (None, "n", "p" * 200), (11, "long", "y" * 3_000_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = new_folder(spark, "warc")
    got = pages_to_warc(df, path).collect()
    assert sorted((str(r.page_id), r.record_type, r.refers_to) for r in got) == sorted([("3", "revisit", 2), ("2", "response", None), ("5", "revisit", 2), ("6", "response", None), ("7", "response", None), ("8", "response", None), ("9", "response", None), ("2", "response", None), ("None", "response", None), ("11", "response", None)])
    assert {r.payload_bytes for r in got if r.page_id in (2, 3, 5)} == {len(big.encode())}
    assert {bytes(r.payload).decode() for r in got if r.page_id == 2} == {big}
    assert len({r.record_id for r in got}) == len(got)
    content = [r.content for r in spark.read.format("binaryFile").load(path).collect()]
    assert sum(len(list(parse_warc(bytes(c)))) for c in content) == len(rows)


def test_no_pages(spark):
    assert pages_to_warc(spark.createDataFrame([], "page_id long, url string, html string"), new_folder(spark, "warc")).collect() == []


def test_a_page_without_an_id_is_no_response_to_others(spark):
    rows = [(None, "a", "x" * 150), (5, "b", "x" * 150), (3, "c", "x" * 150), (None, "d", "z" * 150), (None, "e", "z" * 150)]
    got = pages_to_warc(spark.createDataFrame(rows, "page_id long, url string, html string"), new_folder(spark, "warc")).collect()
    assert sorted((r.uri, r.record_type, r.refers_to) for r in got) == [("a", "response", None), ("b", "revisit", 3), ("c", "response", None), ("d", "response", None), ("e", "response", None)]
