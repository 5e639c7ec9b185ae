import base64
import gzip
import hashlib
import io

import pytest
from pyspark.sql import functions as F

from pointlake.llm import warc as W
from pointlake.llm.common import shared_folder

SCHEMA = "page_id long, url string, html string, digest string, record string"


def _run(spark, rows, least=0):
    raw, folder = shared_folder(spark, "raw"), shared_folder(spark, "warc")
    df = spark.createDataFrame([(i, u, h, "d", "r") for i, u, h in rows], SCHEMA)
    W.write_archives(df, raw, least)
    archives = W.normalise(spark, raw, folder)
    return archives, W.read_records(archives)


ROWS = [(1, "http://a/1", "same"), (2, "http://a/2", "same"), (3, None, "same"), (4, "http://a/4\r\nX: y", "é🙂\r\n\r\nWARC/1.1\r\n\r\n"),
        (5, "u", None), (6, "u", ""), (7, "u", "x" * 3_000_000), (8, "u", "two"), (8, "u", "two"), (None, "n", "lonely"), (None, "n", "same")]


def test_round_trip(spark):
    _, got = _run(spark, ROWS)
    rows = sorted(got.collect(), key=lambda r: (r.page_id is None, r.page_id or 0, r.payload_bytes))
    assert [(r.page_id, r.record_type, r.refers_to) for r in rows] == [
        (1, "revisit", 3), (2, "revisit", 3), (3, "response", None), (4, "response", None), (5, "revisit", 6), (6, "response", None),
        (7, "response", None), (8, "response", None), (8, "response", None), (None, "revisit", 3), (None, "response", None)]
    by = {r.page_id: r for r in rows}
    for i, _, html in ROWS:
        if i is not None:
            data = (html or "").encode()
            assert by[i].payload_bytes == len(data)
            assert by[i].payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode()
    assert by[3].url is None and by[4].url == "http://a/4 X: y"


def test_short_payloads_are_all_responses(spark):
    _, got = _run(spark, ROWS[:6], least=5)
    assert {r.record_type for r in got.collect()} == {"response"}


def test_members_can_be_read_alone(spark):
    archives, got = _run(spark, ROWS[:4])
    for r in got.collect():
        fs, path = W.open_store(r.archive)
        with fs.open_input_file(path) as f:
            data = f.read_at(f.size() - r.offset, r.offset)
        engine = __import__("zlib").decompressobj(31)
        record = engine.decompress(data)
        assert engine.eof and record.startswith(b"WARC/1.1\r\n") and record.endswith(W.END)
    assert archives.agg(F.sum("n_records")).first()[0] == 4


@pytest.mark.parametrize("members", [1, 3])
def test_streams_of_any_shape(members, monkeypatch):
    monkeypatch.setattr(W, "PIECE", 7)
    one = [b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <%d>\r\nContent-Length: %d\r\n\r\n" % (i, n) + b"y" * n + W.END for i, n in enumerate((0, 1, 5000))]
    data = gzip.compress(b"".join(one)) if members == 1 else b"".join(map(gzip.compress, one))
    archive, sidecar = io.BytesIO(), io.BytesIO()
    assert W.normalise_file(io.BytesIO(data), archive, sidecar)[0] == 3
    assert gzip.decompress(archive.getvalue()) == b"".join(one)
    assert len(sidecar.getvalue().splitlines()) == 3


@pytest.mark.parametrize("data", [gzip.compress(b"not a record\r\n\r\n"), gzip.compress(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc"),
                                  gzip.compress(b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc" + W.END)[:-12]])
def test_broken_archives_raise(data):
    with pytest.raises((ValueError, KeyError)):
        W.normalise_file(io.BytesIO(data), io.BytesIO(), io.BytesIO())


def test_empty_table(spark):
    archives, got = _run(spark, [])
    assert got.count() == 0
