"""WARC archives compressed with a dictionary, one Zstandard frame for each record.

The dictionary is trained on a bounded sample of the records that are archived and stands in a leading skippable
frame (magic 0x184D2A5D) of each file, as the WARC Zstandard format has it. Spark's text sink writes the files, so its
committer covers lost executors and any file system it knows: the bytes of a frame pass through it as they are,
and the line separator is an empty skippable frame, which readers of Zstandard pass over. A file comes from one task, so
the scan's partition size bounds it.

Which record is the response is decided on digests alone. Pages whose payload may be repeated are few or their payloads
are; of each repeated payload one copy moves, however many pages have it, and the payloads of other pages never leave their
task.

Defined cases: a null html is an empty payload; a null url is written as about:blank; of payloads shorter than 100
bytes each record is a response; of rows that repeat the smallest page_id of their payload the one with the least url is the
response, of equal rows one, and the others revisit it; a null page_id ranks last and is written without an id; an empty table
writes no records; further columns are not archived.
"""

from __future__ import annotations

import hashlib
import io
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bitmap, bits_for, kept_at, marked, scratch, slot, small_batches

LEAST_REVISIT = 100
DICTIONARY_MAGIC = b"\x5d\x2a\x4d\x18"
#: An empty skippable frame; all its bytes are ASCII.
SEPARATOR = "\x50\x2a\x4d\x18\x00\x00\x00\x00"
#: Bounds of the training sample and of the dictionary.
SAMPLE_RECORDS, SAMPLE_BYTES, DICTIONARY_BYTES = 1000, 32 << 10, 112_640
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _urn(name: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(name.encode()).digest()[:16], version=4)}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, kind: str, refers_to: int | None, size: int, name: str) -> bytes:
    """A response record with its HTTP head and payload, or a revisit record with neither. name: what no other record of the
    archives has. The response of a payload that others revisit is named by its digest."""
    own = f"payload {digest}" if kind == "response" and size >= LEAST_REVISIT else name
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_urn(own)}", "WARC-Date: 1970-01-01T00:00:00Z"]
    head.append("WARC-Target-URI: " + (quote(url, safe="%:/?#[]@!$&'()*+,;=~") or "about:blank" if url else "about:blank"))
    head += [f"WARC-Payload-Digest: sha256:{digest}", f"Payload-Length: {size}"]
    head += [] if page_id is None else [f"Page-ID: {page_id}"]
    if kind == "revisit":
        head += [f"WARC-Refers-To: {_urn(f'payload {digest}')}", f"WARC-Profile: {REVISIT_PROFILE}"]
        head += [] if refers_to is None else [f"Refers-To-Page-ID: {refers_to}"]
        block = b""
    else:
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def plan(pages: DataFrame) -> DataFrame:
    """page_id, url, payload (null for a revisit), size, digest, kind, refers_to for every row of pages."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("payload"))
    rows = rows.select("*", F.octet_length("payload").cast("long").alias("size"), F.sha2("payload", 256).alias("digest"))
    slots = rows.where(F.col("size") >= LEAST_REVISIT)
    bits = bits_for(pages.count())
    at = slot([F.col("digest")], bits)
    repeated = slots.select(at.alias("slot")).groupBy("slot").count().where("count > 1")
    repeats = marked(bitmap(repeated.select("slot"), bits), at) & (F.col("size") >= LEAST_REVISIT)
    alone = rows.where(~repeats).select("page_id", "url", "payload", "size", "digest", F.lit("response").alias("kind"), F.lit(None).cast("long").alias("refers_to"))
    again = rows.where(repeats)
    order = F.struct(F.col("page_id").isNull().alias("last"), "page_id", F.col("url").isNull().alias("bare"), "url")
    firsts = again.groupBy("digest").agg(F.min(order).alias("first"), F.any_value("payload").alias("payload"), F.any_value("size").alias("size"))
    firsts = kept_at(firsts.select("digest", "size", "payload", F.col("first.page_id").alias("page_id"), F.col("first.url").alias("url")), "op7-firsts")[0]
    responses = firsts.select("page_id", "url", "payload", "size", "digest", F.lit("response").alias("kind"), F.lit(None).cast("long").alias("refers_to"))
    each = again.groupBy("digest", "size", "page_id", "url").agg(F.count("*").alias("n"))
    named = firsts.select(F.col("digest").alias("__digest"), F.col("page_id").alias("refers_to"), F.col("url").alias("__url"))
    own = F.col("page_id").eqNullSafe(F.col("refers_to")) & F.col("url").eqNullSafe(F.col("__url"))
    others = each.join(named, F.col("digest") == F.col("__digest")).withColumn("n", F.col("n") - own.cast("int")).where("n > 0")
    revisits = others.withColumn("k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).select("page_id", "url", F.lit(None).cast("string").alias("payload"), "size", "digest", F.lit("revisit").alias("kind"), "refers_to")
    return alone.unionByName(responses).unionByName(revisits)


def train_dictionary(pages: DataFrame) -> bytes:
    """A Zstandard dictionary from records of pages that a hash of page_id draws; raw content of the same records
    where there are too few to train on."""
    some = pages.where(F.octet_length("html") <= SAMPLE_BYTES)
    n = max(1, some.count())
    scale = 1 << 30
    draw = F.pmod(F.xxhash64("page_id"), F.lit(scale).cast("long")) < min(scale, int(SAMPLE_RECORDS / n * scale) + 1)
    rows = some.where(draw).select("page_id", "url", "html").limit(2 * SAMPLE_RECORDS).collect()
    rows.sort(key=lambda r: (r["page_id"] is None, r["page_id"] or 0, r["html"]))
    samples = [record(r["page_id"], r["url"], b := r["html"].encode(), hashlib.sha256(b).hexdigest(), "response", None, len(b), "") for r in rows]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-DICTIONARY_BYTES:] or b"WARC/1.1\r\n"


def write_warc(records: DataFrame, out: str, dictionary: bytes, level: int = 3) -> None:
    """Writes the rows of plan() below out, a file for each partition. Records are named by a secret of the call, their
    partition and their place in it, which a task that runs again repeats."""
    sent = records.sparkSession.sparkContext.broadcast(dictionary)
    secret = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(sent.value), write_content_size=True)
        name, n = f"{secret} {TaskContext.get().partitionId()}", 0
        for batch in batches:
            out: list[bytes] = []
            held = 0
            for row in zip(*[batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "size", "digest", "kind", "refers_to")], strict=True):
                page_id, url, payload, size, digest, kind, refers_to = row
                if not n:
                    info = b"software: tesela\r\nformat: WARC File Format 1.1\r\n"
                    out.append(DICTIONARY_MAGIC + len(sent.value).to_bytes(4, "little") + sent.value)
                    head = f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: {_urn(f'{name} info')}\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(info)}\r\n\r\n"
                    out.append(made.compress(head.encode() + info + b"\r\n\r\n"))
                n += 1
                out.append(made.compress(record(page_id, url, (payload or "").encode(), digest, kind, refers_to, size, f"{name} {n}")))
                held += len(out[-1])
                if held > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["frame"])
                    out, held = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["frame"])

    with small_batches(records.sparkSession, 2000):
        frames = records.mapInArrow(run, "frame binary")
        frames.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", SEPARATOR).option("compression", "none").mode("overwrite").text(out)


def records_of(data: bytes | pa.Buffer) -> Iterator[tuple[dict[str, str], bytes]]:
    """The headers and the block of each record of an archive."""
    dictionary, data = None, memoryview(data)
    if data[:4] == DICTIONARY_MAGIC:
        dictionary = zstandard.ZstdCompressionDict(bytes(data[8 : 8 + int.from_bytes(data[4:8], "little")]))
    stream = io.BufferedReader(zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(data, read_across_frames=True), 1 << 20)
    while line := stream.readline():
        if line.strip() != b"WARC/1.1":
            raise ValueError(f"no WARC record where one is due: {line[:40]!r}")
        head: dict[str, str] = {}
        while (line := stream.readline().rstrip(b"\r\n")) != b"":
            key, _, value = line.decode().partition(":")
            head[key.lower()] = value.strip()
        block = stream.read(int(head["content-length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a WARC record does not end where its length says")
        yield head, block


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    page = lambda head, key: int(head[key]) if key in head else None
    types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string())
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri", "record_id"]
    for batch in batches:
        for content in batch.column("content"):
            rows: list[tuple] = []
            for head, block in records_of(content.as_buffer()):
                kind = head["warc-type"]
                if kind not in ("response", "revisit"):
                    continue
                digest, size = head["warc-payload-digest"].removeprefix("sha256:"), int(head["payload-length"])
                if kind == "response":
                    payload = block.partition(b"\r\n\r\n")[2]
                    if hashlib.sha256(payload).hexdigest() != digest or len(payload) != size:
                        raise ValueError(f"the payload of {head['warc-record-id']} does not have its digest")
                rows.append((page(head, "page-id"), size, digest, kind, page(head, "refers-to-page-id"), head["warc-target-uri"], head["warc-record-id"]))
                if len(rows) == 2000:
                    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names)
                    rows = []
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, target_uri, record_id of every record; digests of
    responses are taken from their payloads again and must agree."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(_read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, target_uri string, record_id string")


def warc(pages: DataFrame) -> DataFrame:
    """Archives pages (page_id, url, html) in the shared folder and reads the archives back."""
    spark = pages.sparkSession
    out = scratch(spark, "op7-warc")
    write_warc(plan(pages), out, train_dictionary(pages))
    return read_warc(spark, out).drop("record_id")
