import gzip
import hashlib

from pyspark.sql import functions as F

from ledgerloom.llm import warc

SCHEMA = "page_id long, url string, html string, replica int, file string"


def pages(spark, n=70):
    rows = [(i, f"http://x/{i}", f"<p>{i}\r\n\r\nWARC/1.1\r\n{'é' * (i % 9)}</p>", 1, "f") for i in range(n)]
    rows += [(100, None, None, 1, "f"), (101, "http://a\r\nX: 1", "", 1, "f"), (None, "u", "no id", 1, "f"), (102, "u", "same", 1, "f"), (102, "u", "same", 1, "f")]
    return spark.createDataFrame(rows, SCHEMA)


def record(page_id, url, html):
    html = html or ""
    lines = ["WARC/1.1", "WARC-Type: resource", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>"]
    lines += [] if url is None else [f"WARC-Target-URI: {url}".replace("\r", "%0D").replace("\n", "%0A")]
    lines += ["WARC-Date: 2024-01-01T00:00:00Z", "Content-Type: text/html", f"Content-Length: {len(html.encode())}"]
    return ("\r\n".join(lines) + "\r\n\r\n" + html + "\r\n\r\n").encode()


def test_audit_finds_the_damaged_records_and_no_others(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 400)
    monkeypatch.setattr(warc, "FAN", 4)
    frame = pages(spark).repartition(3)
    got = warc.fixity_audit(frame, F.coalesce(F.col("page_id").isin(3, 44, 101), F.lit(False))).collect()
    want = []
    for r in frame.collect():
        body = record(r.page_id, r.url, r.html)
        want.append((r.page_id, len(body), hashlib.sha256(body).hexdigest(), r.page_id not in (3, 44)))
    assert sorted((tuple(r) for r in got), key=repr) == sorted(want, key=repr)


def test_files_are_bounded_by_bytes(spark, tmp_path, monkeypatch):
    """A page of three megabytes has a file of its own; the others share files of a few hundred kilobytes."""
    monkeypatch.setattr(warc, "FILE_BYTES", 300_000)
    rows = [(i, f"http://x/{i}", ("é" * (i % 90)) * 500, 1, "f") for i in range(120)] + [(500, "u", "long " * 600_000, 1, "f")]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(2)
    html = F.coalesce("html", F.lit(""))
    warc.write_replicas(frame, f"file://{tmp_path}/w", [html, html])
    sizes = [len(gzip.decompress(p.read_bytes())) for p in tmp_path.glob("w/replica=0/**/*.txt.gz")]
    assert len(sizes) > 10 and sum(s > 400_000 for s in sizes) == 1
    got = warc.fixity_audit(frame, F.coalesce(F.col("page_id") == 500, F.lit(False))).collect()
    assert len(got) == 121 and [r.page_id for r in got if not r.intact] == [500]


def test_equal_replicas_and_empty_table(spark):
    assert all(r.intact for r in warc.fixity_audit(pages(spark), F.lit(False)).collect())
    assert warc.fixity_audit(pages(spark).limit(0), F.lit(True)).collect() == []


def test_a_record_that_one_replica_lacks(spark):
    rows = [(0, "a", 0, "1", 0, 9, b"x"), (0, "a", 1, "2", 9, 12, b"y"), (1, "a", 0, "1", 0, 9, b"x"), (0, "b", 0, "3", 0, 4, b"z"), (1, "b", 0, "3", 0, 4, b"z")]
    records = spark.createDataFrame(rows, "replica int, file string, place long, record string, start long, end long, digest binary")
    assert [tuple(r) for r in warc.differing_records(records).collect()] == [("a", 1)]


def test_records_of_damaged_files():
    good = record(1, "u", "abc") + record(2, "u", "de")
    assert [r[2] for r in warc._records_of(good)] == ["1", "2"]
    assert [r[:2] for r in warc._records_of(good[:-3])] == [(0, len(record(1, "u", "abc"))), (len(record(1, "u", "abc")), len(good) - 3)]
    assert [r[2] for r in warc._records_of(b"junk")] == [None]
    packed = gzip.compress(good) + gzip.compress(b"tail")
    assert warc._unpacked(packed) == good + b"tail" and good.startswith(warc._unpacked(packed[:60]))
