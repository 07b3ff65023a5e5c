"""Web archives (WARC 1.1) written from and read into a table of payload chunks.

A payload is never one value here: it is rows of ``uid, chunk, data`` in order, with the digest carried along as chunks
pass and the final one in the row of the last chunk. A payload longer than a chunk becomes a segmented record, as the format has
it: the first segment, then ``continuation`` records. An archive is one gzip file per task, so it is read as one stream; the reader
takes its lines as they come, keeps one record head and running digests, and gives rows of chunks again.

Equal payloads are found by digest and length. Groups are reduced twice, first with a salt, so no group meets in one task.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .workspace import Workspace

CHUNK_BYTES = 1 << 20
BATCH_BYTES = 8 << 20
SALTS = 64
DATE = "1970-01-01T00:00:00Z"

RESPONSE, REVISIT = "response", "revisit"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Characters that a header line may hold as they are; all others of a URL are percent-encoded.
URL_SAFE = "!#$%&'()*+,/:;=?@[]~"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


CHUNKS = "uid long, id string, url string, chunk int, data binary, n_bytes long, digest string, last boolean"


def to_chunks(pages: DataFrame, chunk_bytes: int = CHUNK_BYTES, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """The chunk table of ``pages``: each payload in rows of at most ``chunk_bytes``, at least one.

    ``n_bytes`` and ``digest`` (SHA-1, base32) are those of the payload up to and with the row; ``last`` marks the row in which they
    are those of the whole. ``uid`` numbers the rows of ``pages``, so it is stable only once the table is written.
    """
    names = ["uid", "id", "url", "chunk", "data", "n_bytes", "digest", "last"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int32(), pa.binary(), pa.int64(), pa.string(), pa.bool_()]

    def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
        for uid, page, url, payload in zip(*(batch.column(i) for i in range(4)), strict=True):
            whole = memoryview(payload.as_buffer())
            running = hashlib.sha1(usedforsecurity=False)
            for chunk, start in enumerate(range(0, max(len(whole), 1), chunk_bytes)):
                data = whole[start:start + chunk_bytes]
                running.update(data)
                end = start + len(data)
                yield uid.as_py(), page.as_py(), url.as_py(), chunk, bytes(data), end, base32(running.digest()), end == len(whole)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from in_batches(rows(batch), names, kinds, lambda row: len(row[4]))

    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary")
    named = pages.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("string").alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    return named.mapInArrow(run, CHUNKS)


def in_batches(rows: Iterator[tuple], names: list[str], kinds: list[pa.DataType], weight) -> Iterator[pa.RecordBatch]:
    """Rows in Arrow batches of about ``BATCH_BYTES``."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += weight(row) + 200
        if size >= BATCH_BYTES:
            yield _batch(held, names, kinds)
            held, size = [], 0
    if held:
        yield _batch(held, names, kinds)


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def decide(chunks: DataFrame, id_type: str, at_least: int = 0, salts: int = SALTS) -> DataFrame:
    """``uid, payload_bytes, payload_digest, refers_uid, refers_id`` for every record of a written chunk table.

    ``refers_uid`` is null for responses. Of records with equal payloads of ``at_least`` bytes or more, the one with the largest id
    is the response (ids compare as ``id_type``, null is smallest, the later row wins ties); smaller payloads all are.
    """
    ends = chunks.where("last").select("uid", "id", F.col("n_bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"))
    wide = ends.where(F.col("payload_bytes") >= at_least).withColumn("salt", F.pmod(F.xxhash64("uid"), F.lit(salts)).cast("int"))
    rank = F.struct(F.col("id").cast(id_type).alias("order"), "uid", "id")
    parts = wide.groupBy("payload_digest", "payload_bytes", "salt").agg(F.max(rank).alias("top"), F.count(F.lit(1)).alias("rows"))
    tops = parts.groupBy("payload_digest", "payload_bytes").agg(F.max("top").alias("top"), F.sum("rows").alias("rows")).where("rows > 1").drop("rows")
    salted = parts.select("payload_digest", "payload_bytes", "salt").join(tops, ["payload_digest", "payload_bytes"])
    refers = [F.col("top.uid").alias("refers_uid"), F.col("top.id").alias("refers_id")]
    revisits = wide.join(salted, ["payload_digest", "payload_bytes", "salt"]).where("uid <> top.uid").select("uid", *refers)
    return ends.drop("id").join(revisits, "uid", "left")


def record_id(uid: int, page: str | None) -> str:
    """A name for a record that gives its page's id back; ``uid`` sets rows of one id apart."""
    return f"<urn:page:{uid}>" if page is None else f"<urn:page:{uid}:{quote(page, safe='')}>"


def _record(kind: str, name: str, date: str, block: bytes, fields: list[tuple[str, str]], content: str | None) -> bytes:
    """One record without its last line feed, which the line writer adds."""
    head = [("WARC-Type", kind), ("WARC-Record-ID", name), ("WARC-Date", date), *fields]
    head += [("WARC-Block-Digest", f"sha1:{base32(hashlib.sha1(block, usedforsecurity=False).digest())}")]
    head += [("Content-Type", content)] if content else []
    head += [("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r"


def _http_head(n_bytes: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()


def segments(row: dict, date: str) -> bytes:
    """The record that one chunk row becomes: a response, a revisit without its payload, or a continuation of a long response."""
    name, number = record_id(row["uid"], row["id"]), row["chunk"] + 1
    fields = []
    if number == 1:
        if row["url"] is not None:
            fields.append(("WARC-Target-URI", quote(row["url"], safe=URL_SAFE)))
        fields.append(("WARC-Payload-Digest", f"sha1:{row['payload_digest']}"))
        head = _http_head(row["payload_bytes"])
        if row["refers_uid"] is not None:
            fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(row["refers_uid"], row["refers_id"]))]
            return _record(REVISIT, name, date, head, fields, "application/http; msgtype=response")
        if not row["last"]:
            fields.append(("WARC-Segment-Number", "1"))
        return _record(RESPONSE, name, date, head + row["data"], fields, "application/http; msgtype=response")
    fields += [("WARC-Segment-Origin-ID", name), ("WARC-Segment-Number", str(number))]
    if row["last"]:
        fields.append(("WARC-Segment-Total-Length", str(len(_http_head(row["payload_bytes"])) + row["payload_bytes"])))
    return _record("continuation", f"<urn:segment:{number}:{name[5:]}", date, row["data"], fields, None)


def write_archives(chunks: DataFrame, decisions: DataFrame, path: str, date: str = DATE) -> None:
    """Write the records of a chunk table below ``path``, one archive per task, the segments of a record in one archive and in order.

    Lines are written by Spark, so the folder may be on any store that Spark writes to and a repeated task replaces its file.
    """
    columns = ["uid", "id", "url", "chunk", "data", "last", "payload_bytes", "payload_digest", "refers_uid", "refers_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        info = _record("warcinfo", f"<urn:archive:{TaskContext.get().partitionId()}>", date, b"format: WARC File Format 1.1\r\n", [], "application/warc-fields")
        first = True
        for batch in batches:
            lines = ([(info,)] if first else []) + [(segments(row, date),) for row in _dicts(batch)]
            first = False
            yield from in_batches(iter(lines), ["value"], [pa.binary()], lambda row: len(row[0]))

    # dealt by record before the join, so that no later choice of a join sends the segments of one record to two tasks
    dealt = chunks.drop("n_bytes", "digest").repartition("uid")
    ordered = dealt.join(decisions, "uid").where("refers_uid IS NULL OR chunk = 0").select(*columns).sortWithinPartitions("uid", "chunk")
    lines = ordered.mapInArrow(run, "value binary").select(F.col("value").cast("string"))
    lines.write.option("compression", "gzip").option("lineSep", "\n").text(path)


def _dicts(batch: pa.RecordBatch) -> Iterator[dict]:
    names = batch.schema.names
    for values in zip(*batch.columns, strict=True):
        yield {name: value.as_py() for name, value in zip(names, values, strict=True)}


class ArchiveStream:
    """Takes the bytes of one archive as they come and gives pieces of blocks: ``(head, piece, ended)``.

    ``head`` is the dictionary of the record's fields in lower case. What is held is one head or the last bytes given, never a block.
    A broken archive is an error, not a shorter result.
    """

    def __init__(self):
        self.held = b""
        self.head: dict[str, str] | None = None
        self.left = 0

    def feed(self, data: bytes) -> Iterator[tuple[dict[str, str], bytes, bool]]:
        self.held += data
        at = 0
        while True:
            if self.head is None:
                end = self.held.find(b"\r\n\r\n", at)
                if end < 0:
                    break
                version, *fields = self.held[at:end].decode("utf-8").split("\r\n")
                if not version.startswith("WARC/"):
                    raise ValueError(f"no record where one should start: {version[:80]!r}")
                self.head = {k.strip().lower(): v.strip() for k, v in (f.split(":", 1) for f in fields)}
                self.left, at = int(self.head["content-length"]), end + 4
            piece = self.held[at:at + self.left]
            at, self.left = at + len(piece), self.left - len(piece)
            if self.left or len(self.held) < at + 4:
                if piece:
                    yield self.head, piece, False
                break
            if self.held[at:at + 4] != b"\r\n\r\n":
                raise ValueError(f"record {self.head.get('warc-record-id')} does not end where its length says")
            yield self.head, piece, True
            at, self.head = at + 4, None
        self.held = self.held[at:]

    def close(self) -> None:
        if self.held.strip() or self.head is not None:
            raise ValueError("the archive breaks off inside a record")


class RecordReader:
    """Rows of chunks from the pieces of one archive, with digests carried over the segments of a record."""

    def __init__(self, keep_data: bool):
        self.keep_data = keep_data
        self.open: dict | None = None

    def rows(self, stream: ArchiveStream, data: bytes) -> Iterator[tuple]:
        for head, piece, ended in stream.feed(data):
            kind = head["warc-type"]
            if kind in (RESPONSE, REVISIT):
                if self.open is not None and self.open["head"] is not head:
                    raise ValueError(f"record {self.open['head'].get('warc-record-id')} lacks its last segment")
                if self.open is None:
                    self.open = {"head": head, "http": b"", "seen": 0, "chunk": 0, "sha": hashlib.sha1(usedforsecurity=False), "full": None}
            elif kind != "continuation":
                continue
            elif self.open is None or head.get("warc-segment-origin-id") != self.open["head"]["warc-record-id"]:
                raise ValueError(f"segment {head.get('warc-record-id')} does not follow its record")
            yield from self._piece(self.open, head, piece, ended)

    def close(self) -> None:
        if self.open is not None:
            raise ValueError(f"record {self.open['head'].get('warc-record-id')} lacks its last segment")

    def _piece(self, record: dict, head: dict[str, str], piece: bytes, ended: bool) -> Iterator[tuple]:
        if record["full"] is None:
            http = record["http"] + piece
            cut = http.find(b"\r\n\r\n")
            if cut < 0 and ended:
                raise ValueError(f"record {head.get('warc-record-id')} has no message head")
            if cut < 0:
                record["http"] = http
                return
            record["full"] = int(re.search(rb"(?im)^content-length: *(\d+)", http[:cut])[1])
            piece = http[cut + 4:]
        record["sha"].update(piece)
        record["seen"] += len(piece)
        first, total = record["head"], head.get("warc-segment-total-length")
        last = ended and (total is not None if "warc-segment-number" in head else True)
        digest = base32(record["sha"].digest())
        stated = first["warc-payload-digest"].removeprefix("sha1:")
        revisit = first["warc-type"] == REVISIT
        intact = revisit or (digest == stated and record["seen"] == record["full"])
        yield (
            *_ids(first["warc-record-id"]), first.get("warc-target-uri"), first["warc-type"], record["chunk"], piece if self.keep_data else None,
            record["full"] if revisit and last else record["seen"], stated if revisit else digest, last, intact if last else None,
            *(_ids(first["warc-refers-to"]) if revisit else (None, None)))
        record["chunk"] += 1
        if last:
            self.open = None


def _ids(name: str) -> tuple[int, str | None]:
    uid, page = re.fullmatch(r"<urn:page:(\d+)(?::(.*))?>", name).groups()
    return int(uid), None if page is None else unquote(page)


RECORDS = ("uid long, id string, url string, record_type string, chunk int, data binary, n_bytes long, digest string, last boolean, "
           "intact boolean, refers_uid long, refers_id string")


def read_archives(spark: SparkSession, path: str, keep_data: bool = True) -> DataFrame:
    """The records of the archives below ``path`` as rows of chunks, in the order of their archive within a task.

    ``n_bytes`` and ``digest`` are those of the payload read so far, recomputed from its bytes; a revisit gives those of the payload
    it stands for. ``intact`` says in the last row whether size and digest are those that the record states. Without ``keep_data`` payloads are
    only checked. No archives give no rows.
    """
    names = [field.split()[0] for field in RECORDS.split(", ")]
    text, whole, flag = pa.string(), pa.int64(), pa.bool_()
    kinds = [whole, text, text, text, pa.int32(), pa.binary(), whole, text, flag, flag, whole, text]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        file, stream, reader = None, ArchiveStream(), RecordReader(keep_data)
        for batch in batches:
            files = batch.column(1).dictionary_encode() if batch.num_rows else None
            start = 0
            while start < batch.num_rows:
                code = files.indices[start].as_py()
                end = start + 1
                if len(files.dictionary) == 1:
                    end = batch.num_rows
                while end < batch.num_rows and files.indices[end].as_py() == code:
                    end += 1
                if files.dictionary[code].as_py() != file:
                    stream.close()
                    reader.close()
                    file, stream, reader = files.dictionary[code].as_py(), ArchiveStream(), RecordReader(keep_data)
                for low in range(start, end, 1024):
                    lines = batch.column(0).slice(low, min(end - low, 1024)).to_pylist()
                    yield from reader.rows(stream, b"\n".join(lines) + b"\n")
                start = end
        stream.close()
        reader.close()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from in_batches(rows(batches), names, kinds, lambda row: len(row[5] or b""))

    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.col("value").cast("binary"), F.col("_metadata.file_path")).mapInArrow(run, RECORDS)


def archive_pages(pages: DataFrame, work: Workspace, chunk_bytes: int = CHUNK_BYTES, at_least: int = 0, id_col: str = "page_id",
                  url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write ``pages`` as archives and read them back: ``page_id, payload_bytes, payload_digest, record_type, refers_to, intact``.

    One row per row of ``pages``. A null payload is empty. Rows that share id and payload are records of their own: one is the response, the others
    revisit it. A null id gives a null ``page_id``, and a null ``refers_to`` where the response has it. A null url is left out.
    Other columns are not read. No rows give no archives and no rows. The archives stay in the workspace, under ``archives``.
    """
    id_type = pages.schema[id_col].dataType.simpleString()
    chunks = work.settle(to_chunks(pages, chunk_bytes, id_col, url_col, payload_col), "chunks", compression="zstd")
    write_archives(chunks, decide(chunks, id_type, at_least), work.path("archives"))
    work.drop("chunks")
    read = read_archives(pages.sparkSession, work.path("archives"), keep_data=False)
    return read.where("last").select(
        F.col("id").cast(id_type).alias("page_id"), F.col("n_bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        "record_type", F.col("refers_id").cast(id_type).alias("refers_to"), "intact")


ORACLE_SQL = """
WITH payloads AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS sha, unhex(sha1(coalesce(html, '')))::BIT::VARCHAR AS bits
    FROM pages
), named AS (
    SELECT page_id, payload_bytes, sha, max(page_id) OVER (PARTITION BY sha, payload_bytes) AS top,
        array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            1 + list_sum(list_transform(range(5), lambda k: substr(bits, 5 * i + k + 1, 1)::INT * (16 >> k::INT)))::INT, 1)), '') AS payload_digest
    FROM payloads
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> top THEN top END AS refers_to, true AS intact
FROM named
"""
