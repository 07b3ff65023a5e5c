"""Archives: written, read back, checked against the format and brute force."""

import base64
import glob
import gzip
import hashlib
from collections import Counter, defaultdict

import pytest
from compare import connect, difference

from motefield.llm import warc

from .conftest import SMALL

PAYLOADS = [None, "", "a", "a", "<p>é\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n", "\n\n\n", "\r", "x" * 5_000, "日本" * 700, "x" * 5_000, "line\n" * 900, "\x00\x01"]


def pages(spark):
    rows = [(i, f"http://h/{i}?q=ä b\r\nX: y", p, "n") for i, p in enumerate(PAYLOADS)]
    rows += [(3, "http://again", "a", "n"), (None, None, "a", "n"), (None, "u", "only here", "n"), (99, None, "x" * 5_000, "n"), (99, None, "x" * 5_000, "n")]
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest string")


def digest(payload):
    return base64.b32encode(hashlib.sha1((payload or "").encode()).digest()).decode()


def expected(rows, at_least=0):
    groups = defaultdict(list)
    for i, payload in rows:
        groups[(payload or "")].append(i)
    out = Counter()
    for payload, ids in groups.items():
        size, own = len(payload.encode()), sorted(ids, key=lambda i: (i is not None, i or 0), reverse=True)
        for k, i in enumerate(own):
            revisit = k > 0 and size >= at_least
            out[i, size, digest(payload), "revisit" if revisit else "response", own[0] if revisit else None, True] += 1
    return out


@pytest.mark.parametrize("chunk, at_least", [(warc.CHUNK_BYTES, 0), (7, 0), (1000, 2), (1 << 20, 10**6)])
def test_pages_come_back(spark, work, chunk, at_least):
    rows = pages(spark)
    want = expected([(r["page_id"], r["html"]) for r in rows.collect()], at_least)
    assert Counter(tuple(r) for r in warc.archive_pages(rows, work, chunk, at_least).collect()) == want


def records(path):
    """A plain reader of whole archives: heads and blocks by their stated lengths."""
    for file in glob.glob(f"{path}/*.gz"):
        data = gzip.open(file).read()
        while data:
            head, rest = data.split(b"\r\n\r\n", 1)
            fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
            size = int(fields["Content-Length"])
            assert rest[size:size + 4] == b"\r\n\r\n"
            yield fields, rest[:size]
            data = rest[size + 4:]


def test_the_format(spark, work):
    warc.archive_pages(pages(spark), work, 1000).collect()
    found = list(records(work.path("archives")))
    by_kind = Counter(f["WARC-Type"] for f, _ in found)
    assert by_kind["warcinfo"] == len(glob.glob(work.path("archives") + "/*.gz")) and by_kind["continuation"] > 5
    assert len({f["WARC-Record-ID"] for f, _ in found if f["WARC-Type"] != "warcinfo"}) == len(found) - by_kind["warcinfo"]
    whole = {}
    for fields, block in found:
        assert fields["WARC-Block-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode() and "\r" not in fields.get("WARC-Target-URI", "")
        if fields["WARC-Type"] == "response":
            whole[fields["WARC-Record-ID"]] = (fields["WARC-Payload-Digest"], [block])
        if fields["WARC-Type"] == "continuation":
            whole[fields["WARC-Segment-Origin-ID"]][1].append(block)
            assert int(fields["WARC-Segment-Number"]) == len(whole[fields["WARC-Segment-Origin-ID"]][1])
        if "WARC-Segment-Total-Length" in fields:
            assert int(fields["WARC-Segment-Total-Length"]) == sum(map(len, whole[fields["WARC-Segment-Origin-ID"]][1]))
    for stated, blocks in whole.values():
        assert stated == "sha1:" + base64.b32encode(hashlib.sha1(b"".join(blocks).split(b"\r\n\r\n", 1)[1]).digest()).decode()
    assert all(f["WARC-Refers-To"] in whole for f, _ in found if f["WARC-Type"] == "revisit")


def test_payloads_come_back_in_chunks(spark, work):
    warc.archive_pages(pages(spark), work, 64).collect()
    read = warc.read_archives(spark, work.path("archives"))
    data = defaultdict(list)
    for r in read.where("record_type = 'response'").collect():
        data[r["uid"]].append((r["chunk"], r["data"], r["last"], r["digest"]))
    got = Counter(b"".join(d for _, d, _, _ in sorted(parts)) for parts in data.values())
    assert got == Counter(p.encode() for p in {p or "" for p in PAYLOADS} | {"only here"})
    assert all([last for *_, last, _ in sorted(parts)] == [False] * (len(parts) - 1) + [True] for parts in data.values())


@pytest.mark.parametrize("step", [1, 3, 50, 10_000])
def test_streams_may_be_cut_anywhere(step):
    rows = [{"uid": 1, "id": "5", "url": "u", "chunk": 0, "data": b"x\r\n\r\ny", "last": False, "payload_bytes": 9, "payload_digest": digest("x\r\n\r\nyabc"), "refers_uid": None, "refers_id": None}]
    rows.append(rows[0] | {"chunk": 1, "data": b"abc", "last": True})
    data = b"".join(warc.segments(r, warc.DATE) + b"\n" for r in rows)
    stream, reader = warc.ArchiveStream(), warc.RecordReader(True)
    found = [row for at in range(0, len(data), step) for row in reader.rows(stream, data[at:at + step])]
    stream.close()
    reader.close()
    assert b"".join(r[5] for r in found) == b"x\r\n\r\nyabc" and found[-1][8:10] == (True, True) and found[-1][:2] == (1, "5")


def test_damage_is_an_error():
    row = {"uid": 1, "id": None, "url": None, "chunk": 0, "data": b"abc", "last": True, "payload_bytes": 3, "payload_digest": digest("abc"), "refers_uid": None, "refers_id": None}
    good = warc.segments(row, warc.DATE) + b"\n"
    for data in (good[:-9], good[5:], good.replace(b"\r\n\r\nabc", b"\r\n\r\nabcd")):
        stream, reader = warc.ArchiveStream(), warc.RecordReader(True)
        with pytest.raises(ValueError):
            list(reader.rows(stream, data))
            stream.close()
    stream, reader = warc.ArchiveStream(), warc.RecordReader(True)
    assert [r[9] for r in reader.rows(stream, good.replace(b"\r\n\r\nabc", b"\r\n\r\nabd"))] == [False]


def test_sql(spark, work):
    assert difference(warc.archive_pages(spark.read.parquet(f"{SMALL}/pages.parquet"), work), connect(SMALL), warc.ORACLE_SQL) is None


def test_no_rows(spark, work):
    assert warc.archive_pages(pages(spark).where("false"), work).collect() == []
