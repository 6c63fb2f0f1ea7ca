import hashlib
import uuid

import pytest

from postlens.llm import warc
from postlens.session import scratch_path

MAGIC = "WARC/1.1\r\n"


def record(payload: str, page: int) -> str:
    head = f"{MAGIC}WARC-Type: response\r\nWARC-Record-ID: <urn:page:{page}>\r\nContent-Length: {len(payload.encode())}\r\n\r\n"
    return head + payload + "\r\n\r\n"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "y") for i, u, h in rows], "page_id long, url string, html string, digest string, piece string")


def expected(rows, least):
    known = {}
    for i, _, h in rows:
        if len((h or "").encode()) >= least and i is not None:
            known.setdefault(h, []).append(i)
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        copies = sum(x[2] == h for x in rows)
        first = max(known[h]) if h in known and copies > 1 else None
        again = first is not None and i != first
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=repr)


BIG = "<p>ä</p>" * 200
ROWS = [
    (1, "http://a/", BIG), (2, "http://b/", BIG), (3, None, BIG), (4, "http://c/", None), (5, "http://d/", ""), (6, "http://e/\r\nX: y", "small"), (7, "http://f/", "small"),
    (8, "http://g/WARC/1.1", record("inner " * 9, 99)), (9, "u", MAGIC), (10, "u", MAGIC + MAGIC + "x" + MAGIC), (11, "u", "a\r\n\r\n" + record("", 1) + "tail"),
    (12, "u", record(record("deep", 98), 97) * 40), (13, "u", "z" * 300_000), (14, "u", "\r\n\r\n"), (15, "u", "WARC/1.1"), (16, "u", "\r\n\r\n" + MAGIC + "Content-Length: 5\r\n\r\n"),
    (None, "u", "no id"), (None, "u", BIG), (17, "u", "same " * 300), (17, "u", "same " * 300), (-3, "u", "minus"), (18, "u", f"x{MAGIC}Content-Length: 99999999\r\n\r\ny"),
]


@pytest.mark.parametrize("split", ["128m", "64k", "700"])
def test_round_trip(spark, split):
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        rows = ROWS if split != "700" else [r for r in ROWS if r[0] != 13]
        got = warc.archive_round_trip(pages(spark, rows).coalesce(2))
        assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        assert sorted(map(tuple, got.collect()), key=repr) == expected(rows, warc.REVISIT_BYTES)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_no_pages(spark):
    assert warc.archive_round_trip(pages(spark, [])).collect() == []


def written(spark, text):
    path = scratch_path(spark, f"raw-{uuid.uuid4().hex}")
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.option("lineSep", "\r\n").text(path)
    return path


def test_a_foreign_archive_with_other_headers(spark):
    text = "WARC/1.1\r\nwarc-type:  warcinfo\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\n" + record("hello", 5)
    rows = warc.read_warc(spark, written(spark, text[:-2])).collect()
    assert [tuple(r) for r in rows] == [(5, "response", None, 5, hashlib.sha1(b"hello").hexdigest())]


@pytest.mark.parametrize("text", [record("hello", 1)[:-4], "junk" + record("x", 1)[:-2], record("x", 1).replace("Length: 1", "Length: 7")[:-2]])
def test_a_broken_archive_is_refused(spark, text):
    with pytest.raises(ValueError, match="no chain"):
        warc.read_warc(spark, written(spark, text))


def test_chains_of_any_length(spark):
    for n in (1, 2, 3, 8, 9):
        links = spark.createDataFrame([("f", i, i + 1) for i in range(n)] + [("f", 100 + i, 101 + i) for i in range(5)] + [("g", 3, 7)], "file string, start long, next long")
        assert sorted(map(tuple, warc.reachable(links).collect())) == [("f", i) for i in range(n)] + [("g", 3)]
