"""Legacy archive converter: ARC version 1 and 2 records become WARC records.

An ARC record is one header line, whose fields depend on the version of its file, and as many bytes
as that line declares. The converter reads lines and declared lengths, never delimiters in the body,
and makes up what WARC wants and ARC lacks: record identifiers (from the record's own content, so a
repeated task writes the same), ISO timestamps, record types and block and payload digests.

WARC files are bounded by bytes and start with a warcinfo record. Spark's text writer writes them, with
WARC's record end as line separator; its commit protocol covers lost executors. A file is one gzip stream.
They are read as binary files, unpacked piece by piece, so a task holds one packed file and one record. ARC
files may be plain or gzip-compressed, in one member or one a record.

A null body counts as empty; bytes that are no records raise an error. A page without id can revisit another
one, and among payloads of such pages only one of them is the response; repeated rows are the same record.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarn.llm.common import Scratch, new_path

# Field lines of the two ARC versions, and WARC's line ends.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
CRLF, RECORD_END = "\r\n", "\r\n\r\n"


def _utf8_len(c: Column) -> Column:
    return F.octet_length(c).cast("string")


def arc_records(pages: DataFrame, version: Column, date: str = "20260101000000", ip: str = "0.0.0.0") -> DataFrame:
    """``arc``: one small ARC file (version block and one HTTP record) per row of (page_id, url, html)."""
    body = F.coalesce(F.col("html").cast("string"), F.lit(""))
    url = F.regexp_replace(F.coalesce(F.col("url").cast("string"), F.lit("about:blank")), r"[\s\x00-\x20]+", "%20")
    url = F.when(url == "", "about:blank").otherwise(url)
    ident = F.when(F.col("page_id").isNotNull(), F.concat(F.lit("X-Page-Id: "), F.col("page_id").cast("string"), F.lit(CRLF))).otherwise("")
    block = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"), ident, F.lit(CRLF), body)
    about = {v: f"{v} 0 tarn\n{line}\n" for v, line in ARC_FIELDS.items()}
    head = {v: f"filedesc://pages.arc {ip} {date} text/plain " + ("" if v == 1 else "200 - - 0 pages.arc ") + f"{len(a)}\n{a}\n" for v, a in about.items()}
    mid = F.when(version == 1, F.lit("")).otherwise(F.lit("200 - - 0 pages.arc "))
    line = F.concat(url, F.lit(f" {ip} {date} text/html "), mid, _utf8_len(block), F.lit("\n"))
    return pages.select(F.concat(F.when(version == 1, F.lit(head[1])).otherwise(F.lit(head[2])), line, block, F.lit("\n")).cast("binary").alias("arc"))


class Stream:
    """Bytes of a plain or gzip-compressed file (any number of members), unpacked as they are asked for."""

    def __init__(self, blob: bytes, piece: int = 1 << 17):
        self.blob, self.piece, self.at, self.held = memoryview(blob), piece, 0, bytearray()
        self.packed = blob[:2] == b"\x1f\x8b"
        self.unpack = zlib.decompressobj(31) if self.packed else None

    def more(self) -> bool:
        if self.at >= len(self.blob):
            if self.packed and not self.unpack.eof:
                raise ValueError("gzip member is cut off")
            return False
        if self.packed:
            if self.unpack.eof:
                self.unpack = zlib.decompressobj(31)
            part = self.blob[self.at : self.at + self.piece]
            self.held += self.unpack.decompress(part)
            self.at += len(part) - len(self.unpack.unused_data)
        else:
            self.held += self.blob[self.at : self.at + self.piece]
            self.at += self.piece
        return True

    def until(self, mark: bytes) -> bytes:
        """What comes before ``mark``, which is taken too; an error if it never comes."""
        start = 0
        while (k := self.held.find(mark, start)) < 0:
            start = max(0, len(self.held) - len(mark) + 1)
            if not self.more():
                raise ValueError("file ends inside a record header")
        return self.take(k + len(mark))[:k]

    def take(self, n: int) -> bytes:
        """The next ``n`` bytes, fewer only at the end."""
        while len(self.held) < n and self.more():
            pass
        out = bytes(self.held[:n])
        del self.held[:n]
        return out

    def skip(self, of: bytes) -> bool:
        """Drops leading bytes that are in ``of``; whether anything follows."""
        while True:
            k = next((i for i, c in enumerate(self.held) if c not in of), -1)
            if k >= 0:
                del self.held[:k]
                return True
            self.held.clear()
            if not self.more():
                return False


def parse_arc(blob: bytes) -> Iterator[dict]:
    """Records of one ARC file; the version block says how header lines read."""
    file, fields = Stream(blob), ARC_FIELDS[1].split()
    while file.skip(b"\r\n"):  # blank lines stand between records
        parts = file.until(b"\n").decode("utf-8", "replace").strip().split(" ")
        first = parts[0].startswith("filedesc://")
        names = fields if not first else ARC_FIELDS[1 if len(parts) == 5 else 2].split()
        if len(parts) != len(names):
            raise ValueError(f"ARC header has {len(parts)} fields, not {len(names)}")
        head = dict(zip(names, parts, strict=True))
        size = int(head["Archive-length"])
        block = file.take(size)
        if len(block) != size:
            raise ValueError("ARC record is shorter than declared")
        if first:
            fields = ARC_FIELDS[2 if block.startswith(b"2") else 1].split()
            continue
        yield {**head, "block": block}


def _b32(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def _to_records(batches: Iterator[pd.DataFrame], names: list[str]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for blob in pdf["arc"]:
            for r in parse_arc(bytes(blob)):
                d, block = r["Archive-date"], r["block"]
                date = f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10] or '00'}:{d[10:12] or '00'}:{d[12:14] or '00'}Z"
                http = block.startswith(b"HTTP/")
                cut = block.find(b"\r\n\r\n") + 4 if http else 0
                head, payload = block[:cut], block[cut:]
                ident = next((int(x[11:]) for x in head.split(b"\r\n") if x.startswith(b"X-Page-Id: ")), None)
                whole, inner = hashlib.sha1(block).digest(), hashlib.sha1(payload).digest()
                h = hashlib.sha1(f"{r['URL']} {date} {ident} ".encode() + whole).hexdigest()
                rec = f"<urn:uuid:{h[:8]}-{h[8:12]}-5{h[13:16]}-a{h[17:20]}-{h[20:32]}>"
                rows.append((ident, r["URL"], r["IP-address"], date, rec, "application/http; msgtype=response" if http else r["Content-type"], head, payload, len(payload), _b32(whole), _b32(inner)))
        yield pd.DataFrame(rows, columns=["page_id", "uri", "ip", "date", "record_id", "content_type", "head", "payload", "payload_bytes", "block_digest", "payload_digest"]).astype({"page_id": "Int64"})[names]


RECORDS = "page_id long, uri string, ip string, date string, record_id string, content_type string, head binary, payload binary, payload_bytes long, block_digest string, payload_digest string"


def arc_to_records(arcs: DataFrame, names: list[str] | None = None) -> DataFrame:
    """WARC fields, head and payload of every record of the ARC files in column ``arc``, or those ``names``."""
    fields = [f.split() for f in RECORDS.split(", ")]
    kept = [f for f in fields if not names or f[0] in names]
    return arcs.mapInPandas(partial(_to_records, names=[f[0] for f in kept]), ", ".join(" ".join(f) for f in kept))


def mark_revisits(records: DataFrame, originals: DataFrame, least: int = 1000) -> DataFrame:
    """Adds the record to which a repeated payload refers: that with the largest page_id of its digest.

    originals: (page_id, record_id, payload_bytes, payload_digest) of all records, without payloads. A digest
    that many pages share is joined by broadcast, as in ``hot_join``, but in one pass over the payloads.
    """
    last = (
        originals.filter(F.col("payload_bytes") >= least)
        .groupBy("payload_digest")
        .agg(F.max("page_id").alias("refers_to"), F.max_by("record_id", F.struct(F.coalesce("page_id", F.lit(-(1 << 63))), "record_id")).alias("refers_record"), F.count("*").alias("copies"))
        .filter("copies > 1")
    )
    last = Scratch(records.sparkSession).put(last, "repeated")
    cut = max(1000.0, float(last.agg(F.sum("copies")).first()[0] or 0) / 2000)
    hot = last.filter(F.col("copies") > cut).select("payload_digest", F.col("refers_to").alias("hot_to"), F.col("refers_record").alias("hot_record"))
    cold = last.filter(F.col("copies") <= cut).select(F.col("payload_digest").alias("joined"), "refers_to", "refers_record")
    spread = F.when(F.col("hot_record").isNull() & (F.col("payload_bytes") >= least), F.col("payload_digest")).otherwise(F.concat(F.lit("#"), "record_id"))
    both = records.join(F.broadcast(hot), "payload_digest", "left").withColumn("joined", spread).join(cold, "joined", "left")
    both = both.withColumn("refers_record", F.coalesce("hot_record", "refers_record")).withColumn("refers_to", F.coalesce("hot_to", "refers_to"))
    revisit = F.col("refers_record").isNotNull() & (F.col("record_id") != F.col("refers_record"))
    return both.withColumn("record_type", F.when(revisit, "revisit").otherwise("response")).withColumn("refers_to", F.when(revisit, F.col("refers_to"))).drop("joined", "hot_to", "hot_record")


def warc_text(marked: DataFrame) -> DataFrame:
    """``value``: each record without the record end; a revisit keeps the HTTP head and drops the payload."""
    revisit = F.col("record_type") == "revisit"
    body = F.when(revisit, F.col("head").cast("string")).otherwise(F.concat(F.col("head").cast("string"), F.col("payload").cast("string")))

    def line(name: str, c: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), c, F.lit(CRLF))

    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", F.col("record_id")),
        line("WARC-Date", F.col("date")),
        line("WARC-Target-URI", F.col("uri")),
        line("WARC-IP-Address", F.col("ip")),
        F.when(revisit, F.concat(line("WARC-Refers-To", F.col("refers_record")), F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n"), F.when(F.col("refers_to").isNotNull(), line("X-Refers-To-Page", F.col("refers_to").cast("string"))).otherwise(""))).otherwise(line("WARC-Block-Digest", F.col("block_digest"))),
        line("WARC-Payload-Digest", F.col("payload_digest")),
        line("X-Payload-Length", F.col("payload_bytes").cast("string")),
        line("Content-Type", F.col("content_type")),
        line("Content-Length", _utf8_len(body)),
        F.lit(CRLF),
    )
    return marked.select(F.concat(head, body).alias("value"))


def _volumes(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Adds the number of the file in which a task puts each record, and a warcinfo record at each one's start."""
    text = "software: tarn\r\nformat: WARC File Format 1.1\r\n"
    h = hashlib.sha1(text.encode()).hexdigest()
    info = f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{h[:8]}-{h[8:12]}-5{h[13:16]}-a{h[17:20]}-{h[20:32]}>\r\nWARC-Date: 2026-01-01T00:00:00Z\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(text)}\r\n\r\n{text}"
    done, last = 0, -1
    for b in batches:
        if not b.num_rows:
            continue
        value = b.column(0)
        ends = done + np.cumsum(pc.binary_length(value).to_numpy(zero_copy_only=False).astype(np.int64) + 4)
        volume = np.r_[done, ends[:-1]] // most
        done = int(ends[-1])
        new = [int(v) for v in np.unique(volume) if v > last]
        last = int(volume[-1])
        if new:
            yield pa.RecordBatch.from_arrays([pa.array([info] * len(new), value.type), pa.array(new, pa.int32())], names=["value", "volume"])
        yield pa.RecordBatch.from_arrays([value, pa.array(volume, pa.int32())], names=["value", "volume"])


def write_warc(marked: DataFrame, path: str, file_bytes: int = 64 << 20) -> None:
    """WARC files of at most ``file_bytes`` unpacked bytes (and the rest of one record), gzip-compressed."""
    placed = warc_text(marked).mapInArrow(partial(_volumes, most=file_bytes), "value string, volume int")
    placed.write.partitionBy("volume").option("lineSep", RECORD_END).option("compression", "gzip").text(path)


def parse_warc(blob: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record, by declared lengths; ``blob`` may be gzip-compressed."""
    file = Stream(blob)
    while file.skip(b""):
        first, *lines = file.until(b"\r\n\r\n").decode("utf-8", "replace").split(CRLF)
        if not first.startswith("WARC/"):
            raise ValueError("no WARC record where one should start")
        head = dict(x.split(": ", 1) for x in lines)
        size = int(head["Content-Length"])
        block = file.take(size)
        if len(block) != size or file.take(4) != b"\r\n\r\n":
            raise ValueError("WARC record does not end where its length says")
        yield head, block


def _from_warc(batches: Iterator[pd.DataFrame], at_once: int = 5000) -> Iterator[pd.DataFrame]:
    def table(rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri", "record_id", "warc_date"])
        return out.astype({"page_id": "Int64", "refers_to": "Int64"})

    for pdf in batches:
        for blob in pdf["content"]:
            rows = []
            for head, block in parse_warc(bytes(blob)):
                if head["WARC-Type"] == "warcinfo":
                    continue
                cut = block.find(b"\r\n\r\n") + 4 if block.startswith(b"HTTP/") else 0
                ident = next((int(x[11:]) for x in block[:cut].split(b"\r\n") if x.startswith(b"X-Page-Id: ")), None)
                digest = base64.b32decode(head["WARC-Payload-Digest"][5:])
                if head["WARC-Type"] == "response" and hashlib.sha1(block[cut:]).digest() != digest:
                    raise ValueError(f"payload of {head['WARC-Record-ID']} does not match its digest")
                refers = head.get("X-Refers-To-Page")
                rows.append((ident, int(head["X-Payload-Length"]), digest.hex(), head["WARC-Type"], int(refers) if refers else None, head["WARC-Target-URI"], head["WARC-Record-ID"], head["WARC-Date"]))
                if len(rows) == at_once:
                    yield table(rows)
                    rows = []
            yield table(rows)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per record, its payload digest checked."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt.gz").load(path).select("content")
    return files.mapInPandas(_from_warc, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, target_uri string, record_id string, warc_date string")


def convert(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Pages through ARC files of both versions into WARC files at ``path``, and read back."""
    spark = pages.sparkSession
    path = path or new_path(spark, "warc")
    src = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    arcs = arc_records(src, F.when(F.pmod(F.xxhash64("page_id"), F.lit(2)) == 0, 1).otherwise(2))
    originals = arc_to_records(arcs, ["page_id", "record_id", "payload_bytes", "payload_digest"])
    write_warc(mark_revisits(arc_to_records(arcs), originals), path)
    return read_warc(spark, path)
