"""WARC archives with an index first.

Workers write each record as its own gzip member and give back where it lies: file, offset, length, URL, digest. The
index is a table; whatever part of it is selected is sorted by place, neighbouring ranges are read at once, and records
are cut from what was read. Archives go to the shared folder through Arrow's file systems.
"""
from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmura.llm._store import fresh, table

#: Ranges closer than GAP are read as one, up to SPAN bytes; a file is dealt to tasks in stretches of SPAN.
GAP, SPAN = 64 << 10, 8 << 20
#: Tasks that read at most.
READERS = 100_000
DATE = "2000-01-01T00:00:00Z"

INDEX = "page_id long, url string, file string, offset long, length long, digest string, payload_bytes long, record_type string, refers_to long"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"

_ID = "<urn:murmura:page:{}>"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url: str | None, payload: bytes, sha: str, refers_to) -> bytes:
    """One WARC/1.1 record; a revisit has no payload, but says how long it was and what it was like."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else "about:blank"
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", "WARC-Record-ID: " + _ID.format(page_id),
        f"WARC-Date: {DATE}", f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{sha}",
        "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    if refers_to is not None:
        head[2:2] = ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "WARC-Refers-To: " + _ID.format(refers_to)]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload of a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    number = lambda x: None if x.endswith(":None>") else int(x[1:-1].rpartition(":")[2])
    kind = fields["WARC-Type"]
    if kind == "response":
        said = digest(payload)
        if fields["WARC-Payload-Digest"] != f"sha1:{said}":
            raise ValueError(f"{fields['WARC-Record-ID']}: the payload does not match its digest")
        return number(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], len(payload), said, kind, None, payload
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    return (number(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], size, fields["WARC-Payload-Digest"][5:], kind, number(fields["WARC-Refers-To"]), None)


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(folder)
        store.create_dir(path)
        name = f"pages-{uuid.uuid4().hex}.warc.gz"  # drawn in this call: no other, and no second attempt, writes to it
        out, at = None, 0
        for batch in batches:
            rows = []
            html = batch.column("html").cast(pa.binary())
            for i, (page_id, url, refers_to) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "refers_to")))):
                payload = html[i].as_py() or b""
                sha = digest(payload)
                pack = zlib.compressobj(1, zlib.DEFLATED, 31)
                raw = pack.compress(record(page_id, url, payload, sha, refers_to)) + pack.flush()
                out = out or store.open_output_stream(f"{path}/{name}", compression=None, buffer_size=1 << 20)
                out.write(raw)
                rows.append((page_id, url, f"{folder}/{name}", at, len(raw), sha, len(payload), "response" if refers_to is None else "revisit", refers_to))
                at += len(raw)
            kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 9, kinds)], [x.split()[0] for x in INDEX.split(", ")])
        if out:
            out.close()

    return run


def ranges(places: list[tuple[int, int]]) -> Iterator[tuple[int, int, list[int]]]:
    """Sorted (offset, length) to reads: begin, end, and which places each read holds."""
    held: list[int] = []
    begin = end = 0
    for i, (offset, length) in enumerate(places):
        if held and (offset > end + GAP or offset + length - begin > SPAN):
            yield begin, end, held
            held = []
        if not held:
            begin = offset
        held.append(i)
        end = max(end, offset + length) if len(held) > 1 else offset + length
    if held:
        yield begin, end, held


def _read(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        opened: tuple = (None, None)
        for batch in batches:
            files, offsets, lengths = (batch.column(c).to_pylist() for c in ("file", "offset", "length"))
            a = 0
            while a < len(files):
                b = a
                while b < len(files) and files[b] == files[a]:
                    b += 1
                if opened[0] != files[a]:
                    store, path = fs.FileSystem.from_uri(files[a])
                    opened = (files[a], store.open_input_file(path))
                for begin, end, held in ranges(list(zip(offsets[a:b], lengths[a:b]))):
                    raw = opened[1].read_at(end - begin, begin)
                    rows = [parse(zlib.decompress(raw[offsets[a + i] - begin :][: lengths[a + i]], 31)) for i in held]
                    if not with_payload:
                        rows = [(*r[:6], None) for r in rows]
                    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [x.split()[0] for x in RECORDS.split(", ")])
                a = b

    return run


def write_archives(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Writes a record per row of pages (page_id, url, html) and returns the index.

    Of rows with equal payloads of at least least_bytes, those with the largest page_id are responses, the others revisit
    it; a null page_id is smaller than any, and revisits only a page that has one. A null html is empty; a null url is
    about:blank in the record; repeated rows are written each. Equal payloads are matched on keys alone, so a payload
    that many pages share isn't gathered anywhere. An empty table gives an empty index."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    keyed = pages.select("page_id", "url", "html", F.sha1(payload).alias("sha"), F.octet_length(payload).alias("size"))
    keys = keyed.select("page_id", "sha", "size").where(F.col("size") >= least_bytes)
    leaders = keys.groupBy("sha").agg(F.max("page_id").alias("leader"), F.count("*").alias("n")).where("n > 1 and leader is not null").select("sha", "leader")
    follow = (
        keys.select("page_id", "sha").join(leaders, "sha").where("not (page_id <=> leader)").distinct()
        .select(F.col("page_id").alias("p"), F.col("sha").alias("s"), F.col("leader").alias("refers_to")))
    typed = keyed.join(follow, F.col("page_id").eqNullSafe(F.col("p")) & (F.col("sha") == F.col("s")), "left")
    written = typed.select("page_id", "url", "html", "refers_to").mapInArrow(_write(fresh(pages.sparkSession, "warc")), INDEX)
    return table(written, "index")


def read_records(index: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of any selection of an index, by coalesced reads of sorted byte ranges.

    The number of tasks follows the bytes to read, not those of the index, which is small."""
    size = index.agg(F.sum("length")).first()[0] or 0
    return (
        index.select("file", "offset", "length")
        .repartition(min(max(1, -(-size // SPAN)), READERS), "file", F.floor(F.col("offset") / SPAN)).sortWithinPartitions("file", "offset")
        .mapInArrow(_read(with_payload), RECORDS))


def op8_warc(spark, sf_dir: str) -> DataFrame:
    """All pages to archives and back."""
    index = write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return read_records(index, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
