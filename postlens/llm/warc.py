"""WARC archives: written by Spark's text writer, read back by byte ranges, with every record boundary proven.

A reader that starts in the middle of a file can't tell a record from a payload that looks like one. So each task only
reports candidates: where the magic stands, and where the record that starts there would end. A record is real if the
chain of successors from the start of its file reaches it; pointer jumping finds these in a logarithmic number of joins.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlens.llm.common import keep, table
from postlens.session import scratch_path

VERSION = "1.1"
#: Payloads of fewer bytes are never written as revisits.
REVISIT_BYTES = 1000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes of a file that share a key when the pieces of a record are gathered.
STRETCH = 1 << 20
END = "\r\n"


def _magic(version: str) -> str:
    return f"WARC/{version}{END}"


def _header_value(value: Column, version: str) -> Column:
    """A value that fits in one header line and does not end in the magic, which would look like a boundary."""
    line = F.regexp_replace(value, r"[\x00-\x1f\x7f]", " ")
    return F.regexp_replace(line, f"(WARC/{re.escape(version.split('.')[0])})[.]({re.escape(version.split('.')[1])})\\s*$", "$1%2E$2")


def with_revisits(records: DataFrame, min_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Add digest, size, record_type and refers_to to rows of (id, uri, payload).

    Of equal payloads of at least ``min_bytes`` the one with the largest id is a response and the others revisit it; a
    null id revisits too, if any id is known. Rows that share the largest id are all responses.
    """
    payload = F.coalesce(F.col("payload"), F.lit(b""))
    rows = records.withColumns({"payload": payload, "digest": F.sha1(payload), "size": F.octet_length(payload).cast("long")})
    large = rows.where(F.col("size") >= min_bytes)
    same = large.groupBy("digest").agg(F.max("id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1 and first_id is not null")
    same = keep(same.select("digest", "first_id"), "same-payload")  # its real size decides how it is joined
    rows = rows.join(same, "digest", "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("id").eqNullSafe(F.col("first_id"))
    return rows.select(
        "id", "uri", "payload", "digest", "size",
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
        F.when(revisit, F.col("first_id")).alias("refers_to"),
    )


def _line(name: str, value: Column) -> Column:
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit(END))).otherwise(F.lit(""))


def write_warc(records: DataFrame, path: str, version: str = VERSION) -> None:
    """Write rows of ``with_revisits`` as WARC files, one for each task, each record where its row is: nothing is moved.

    The two line ends after a record are the line separator of the text writer. A null uri has no header line.
    """
    block = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    head = F.concat(
        F.lit(_magic(version)),
        _line("WARC-Type", F.col("record_type")),
        _line("WARC-Record-ID", urn(F.col("id"))),
        _line("WARC-Date", F.lit(DATE)),
        _line("WARC-Target-URI", _header_value(F.col("uri"), version)),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _line("WARC-Refers-To", F.when(F.col("refers_to").isNotNull(), urn(F.col("refers_to")))),
        _line("WARC-Profile", F.when(F.col("record_type") == "revisit", F.lit(PROFILE))),
        _line("Content-Type", F.lit("text/html")),
        _line("Content-Length", F.octet_length(block).cast("string")),
        F.lit(END),
    )
    record = F.concat(head.cast("binary"), block).cast("string")
    records.select(record.alias("value")).write.option("lineSep", END * 2).text(path)


def _pieces(spark: SparkSession, path: str, version: str) -> DataFrame:
    """What stands between two magics, by file and byte range. Spark splits the files; a range ends with the piece that
    crosses its end."""
    lines = spark.read.option("lineSep", _magic(version)).text(path)
    return lines.select(F.col("value").cast("binary").alias("piece"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


_SCAN = "file string, block long, at long, length long, head long, content long, id long, record_type string, refers_to long, digest string, sha1 string, piece binary"


def _parse(piece: bytes) -> tuple[int, dict[bytes, bytes]] | None:
    """Length of the header that starts the piece, with its blank line, and its fields; None if it is no header."""
    end = piece.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = {}
    for line in piece[:end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower()] = value.strip()
    return end + 4, fields


def _number(value: bytes | None) -> int | None:
    found = re.fullmatch(rb"<urn:page:(-?\d+)>", value or b"")
    return int(found[1]) if found else None


def _scanner(magic: int, with_pieces: bool):
    """For each piece: its place in the range that it was read with, and what its header says, if it has one."""

    def scan(batches):
        where, at = None, 0
        for batch in batches:
            out = []
            for piece, file, block in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                piece = piece.as_py()
                if (file, block) != where:
                    where, at = (file, block), 0
                row = dict.fromkeys(("head", "content", "id", "record_type", "refers_to", "digest", "sha1"))
                row |= {"file": file, "block": block, "at": at, "length": len(piece), "piece": piece if with_pieces else None}
                found = _parse(piece)
                if found and found[1].get(b"content-length", b"").isdigit():
                    head, fields = found
                    content = int(fields[b"content-length"])
                    row |= {"head": head, "content": content, "id": _number(fields.get(b"warc-record-id")), "refers_to": _number(fields.get(b"warc-refers-to"))}
                    row |= {"record_type": fields.get(b"warc-type", b"").decode(errors="replace"), "digest": fields.get(b"warc-payload-digest", b"").decode(errors="replace").removeprefix("sha1:")}
                    if head + content + 4 == len(piece):
                        row["sha1"] = hashlib.sha1(piece[head : head + content]).hexdigest()
                at += len(piece) + magic
                out.append(row)
            yield pa.RecordBatch.from_pylist(out, schema=_ARROW)

    return scan


_ARROW = pa.schema(
    [(n, {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[t]) for n, t in (x.rsplit(" ", 1) for x in _SCAN.split(", "))]
)


def _located(scanned: DataFrame, bases: DataFrame) -> DataFrame:
    """Replace the place within a range by the offset in the file (of the byte after the magic)."""
    return scanned.join(bases, ["file", "block"]).withColumn("start", F.col("base") + F.col("at")).drop("block", "at", "base")


def reachable(links: DataFrame) -> DataFrame:
    """The (file, start) that the chain from the first record of each file reaches.

    ``links`` has (file, start, next) of all candidates. Round k adds the nodes 2^k steps behind known ones and doubles
    the pointers, so a file of n records takes about log2(n) rounds of two joins over three short columns; pointers that
    lead to no candidate are dropped.
    """
    firsts = links.groupBy("file").agg(F.min("start").alias("start"))
    known = keep(firsts.join(links.select("file", "start"), ["file", "start"]), "warc-known")
    nodes = links.select("file", F.col("start").alias("next"))
    jumps = keep(links.join(nodes, ["file", "next"], "left_semi").select("file", "start", "next"), "warc-jumps")
    while True:
        more = keep(known.join(jumps, ["file", "start"]).select("file", F.col("next").alias("start")), "warc-more")
        if more.isEmpty():
            return known
        known = known.union(more)
        onward = jumps.select("file", F.col("start").alias("next"), F.col("next").alias("after"))
        jumps = keep(jumps.join(onward, ["file", "next"]).select("file", "start", F.col("after").alias("next")), "warc-jumps")


def _rebuilt(spark: SparkSession, path: str, version: str, bases: DataFrame, places: DataFrame, broken: DataFrame) -> DataFrame:
    """(file, start, sha1) of the records whose payload holds the magic: their pieces are read again and put together."""
    stretch = lambda c: F.floor(F.col(c) / STRETCH)
    spans = broken.select("file", F.col("start").alias("record"), "head", "content", (F.col("start") + F.col("head") + F.col("content") + 4).alias("end"))
    spans = spans.withColumn("stretch", F.explode(F.sequence(stretch("record"), stretch("end"))))
    parts = places.select("file", "start").withColumn("stretch", stretch("start")).join(spans, ["file", "stretch"])
    parts = keep(parts.where("start >= record and start < end").select("file", "start", "record", "head", "content"), "warc-parts")
    pieces = _located(_pieces(spark, path, version).mapInArrow(_scanner(len(_magic(version)), True), _SCAN).select("file", "block", "at", "piece"), bases)
    whole = pieces.join(parts, ["file", "start"]).groupBy("file", "record", "head", "content").agg(
        F.sort_array(F.collect_list(F.struct("start", "piece"))).alias("p")  # the pieces of one record
    )
    data = F.expr(f"reduce(transform(p, x -> x.piece), cast(null as binary), (a, b) -> if(a is null, b, concat(a, cast('{_magic(version).encode().decode('unicode_escape')}' as binary), b)))")
    return whole.select("file", F.col("record").alias("start"), F.sha1(F.substring(data, F.col("head").cast("int") + 1, F.col("content").cast("int"))).alias("sha1"))


def read_warc(spark: SparkSession, path: str, version: str = VERSION) -> DataFrame:
    """(id, record_type, refers_to, size, digest) of every record below ``path``; size and digest are those of the
    payload as it stands in the archive, and of the record it refers to for a revisit.

    The magic inside of payloads, even whole records, is told from real boundaries. An archive whose chain does not end
    at the end of its file is refused. No files give an empty result.
    """
    magic = len(_magic(version))
    scanned = keep(_pieces(spark, path, version).mapInArrow(_scanner(magic, False), _SCAN).drop("piece"), "warc-scan")
    ranges = scanned.groupBy("file", "block").agg(F.sum(F.col("length") + magic).alias("n"))  # a row for each byte range
    before = F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    bases = keep(ranges.select("file", "block", F.coalesce(before, F.lit(0)).alias("base")), "warc-bases")
    pieces = keep(_located(scanned, bases), "warc-pieces")
    candidates = pieces.where("content is not null and start > 0").withColumn("next", F.col("start") + F.col("head") + F.col("content") + 4 + magic)
    links = candidates.select("file", "start", "next")
    found = keep(candidates.join(reachable(links), ["file", "start"]), "warc-records")

    ends = pieces.groupBy("file").agg(F.max(F.col("start") + F.col("length")).alias("size"))
    last = found.groupBy("file").agg(F.max("next").alias("last"), F.min("start").alias("first"))
    bad = ends.join(last, "file", "left").where(f"size > 0 and (last is null or last - {magic} != size or first != {magic})").select("file").take(1)
    if bad:
        raise ValueError(f"no chain of records from start to end: {bad[0]['file']}")

    broken = found.where("sha1 is null")
    if not broken.isEmpty():
        mended = _rebuilt(spark, path, version, bases, pieces, broken)
        found = found.join(mended.withColumnRenamed("sha1", "mended"), ["file", "start"], "left").withColumn("sha1", F.coalesce("sha1", "mended"))
    records = found.select("id", "record_type", "refers_to", F.col("content").alias("size"), F.col("sha1"), "digest")
    responses = records.where("record_type = 'response'").select("id", F.col("record_type"), "refers_to", "size", F.col("sha1").alias("digest"))
    referred = responses.select(F.col("id").alias("refers_to"), "digest", F.col("size").alias("full")).distinct()
    revisits = records.where("record_type = 'revisit'").select("id", "record_type", "refers_to", "digest").join(referred, ["refers_to", "digest"], "left")
    return responses.union(revisits.select("id", "record_type", "refers_to", F.col("full").alias("size"), "digest"))


def page_records(pages: DataFrame) -> DataFrame:
    return pages.select(F.col("page_id").alias("id"), F.col("url").alias("uri"), F.col("html").cast("binary").alias("payload"))


def archive_round_trip(pages: DataFrame, min_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html) to WARC files in the shared folder and read them back.

    page_id, payload_bytes, payload_digest, record_type, refers_to of each row. Null html is an empty payload; a null url
    is left out of the header; repeated rows are records of their own; other columns are not read.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_warc(with_revisits(page_records(pages), min_bytes), path)
    read = read_warc(spark, path)
    return read.select(F.col("id").alias("page_id"), F.col("size").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", "refers_to")


def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    """All pages, through an archive."""
    return archive_round_trip(table(spark, folder, "pages"))


QUERIES = {"op2_warc": op2_warc}
ORACLES = {
    "op2_warc": f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
m AS (SELECT payload_digest, max(page_id) AS first_id, count(*) AS n FROM p WHERE payload_bytes >= {REVISIT_BYTES} GROUP BY ALL),
j AS (SELECT p.*, CASE WHEN n > 1 AND first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
  FROM p LEFT JOIN m USING (payload_digest))
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to FROM j
"""
}
