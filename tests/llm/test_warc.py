import gzip
import hashlib
import io
import os

import pytest

from tickframe.llm import warc


@pytest.fixture
def archive(spark, tmp_path):
    warc.register(spark)
    return lambda name: f"file://{tmp_path}/{name}"


PAGES = "page_id long, url string, html string, payload string, file string, first long"


def brute(rows):
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        top = max((p for p, _, h in rows if p is not None and (h or "") == (html or "")), default=None)
        again = len(data) >= 1000 and top is not None and (page is None or page < top)
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", top if again else None))
    return sorted(out, key=str)


def rows():
    big, accents = "<p>a</p>" * 200, "é漢" * 400
    out = [(1, "http://a.example/", big), (2, "http://b.example/x y\r\nz", big), (3, None, accents), (4, "u", accents), (5, "u", ""), (6, "u", None),
           (7, "u", "x" * 999), (8, "u", "x" * 999), (9, "u", "WARC/1.1\r\n\r\n" * 100), (9, "u", "other"), (10, "u", big), (10, "u", big),
           (None, "u", big), (None, "u", "y" * 1000), (None, "u", "y" * 1000), (11, "u", "z" * 3_000_000)]
    return out + [(100 + i, "http://copy.example/", accents) for i in range(300)]


def test_round_trip(spark, archive):
    pages = spark.createDataFrame([(*r, "clash", "clash", 0) for r in rows()], PAGES).repartition(5)
    warc.as_records(pages).write.format("warc").mode("append").option("max_bytes", 5000).save(archive("a"))
    read = spark.read.format("warc").load(archive("a"))
    assert sorted((tuple(r) for r in warc.report(read).collect()), key=str) == brute(rows())
    got = read.where("record_type = 'response'").select(warc.page_id("record_id").alias("p"), "payload", "target_uri", "file").collect()
    assert {(r.p, bytes(r.payload)) for r in got} <= {(p, (h or "").encode()) for p, _, h in rows()}
    assert len({r.file for r in got}) > 5  # archives are rolled
    lean = spark.read.format("warc").option("payload", "false").load(archive("a"))
    assert sorted((tuple(r) for r in warc.report(lean).collect()), key=str) == brute(rows())
    assert lean.where("payload IS NOT NULL").count() == 0
    uris = {r.target_uri for r in read.where("target_uri LIKE 'http://b%'").collect()}
    assert uris == {"http://b.example/x%20y%0D%0Az"}


def test_append_overwrite_and_uncommitted_files(spark, archive, tmp_path):
    one = spark.createDataFrame([(1, "u", "a", "", "", 0)], PAGES)
    two = spark.createDataFrame([(2, "u", "b", "", "", 0)], PAGES)
    warc.as_records(one).write.format("warc").mode("append").save(archive("b"))
    warc.as_records(two).write.format("warc").mode("append").save(archive("b"))
    (tmp_path / "b" / "part-00000-lost-00000.warc.gz").write_bytes(b"half a file of a lost task")
    ids = lambda: sorted(r.page_id for r in warc.report(spark.read.format("warc").load(archive("b"))).collect())
    assert ids() == [1, 2]
    warc.as_records(two).write.format("warc").mode("overwrite").save(archive("b"))
    assert ids() == [2]


def test_empty_table(spark, archive):
    pages = spark.createDataFrame([], PAGES)
    warc.as_records(pages).write.format("warc").mode("append").save(archive("c"))
    assert warc.report(spark.read.format("warc").load(archive("c"))).collect() == []


def members():
    sha = hashlib.sha1(b"body").hexdigest()
    row = {"record_id": "urn:page:1", "record_type": "response", "target_uri": "u", "refers_to": None, "payload_bytes": 4, "payload_digest": sha, "payload": b"body"}
    return [warc.record(row | {"record_id": f"urn:page:{i}"}, warc.DATE, 6) for i in range(3)]


@pytest.mark.parametrize("chunk", [1, 7, 1 << 20])
def test_incremental_reading(chunk):
    """The reader's results don't depend on where the file's pieces end; each member is a whole gzip file."""
    raw = b"".join(members())
    got = list(warc.records(io.BytesIO(raw), chunk=chunk))
    assert [g["record_id"] for g in got] == [f"urn:page:{i}" for i in range(3)] and all(g["payload"] == b"body" for g in got)
    for i, g in enumerate(got):
        end = got[i + 1]["offset"] if i < 2 else len(raw)
        assert gzip.decompress(raw[g["offset"]:end]).startswith(b"WARC/1.1\r\n")


def spoiled(at, change):
    plain = gzip.decompress(members()[at])
    return [gzip.compress(change(plain)) if i == at else m for i, m in enumerate(members())]


@pytest.mark.parametrize("name,change", [
    ("block digest", lambda b: b.replace(b"body", b"bodi")),
    ("more bytes", lambda b: b + b"xyz12"),
    ("fewer bytes", lambda b: b[:-6]),
    ("not a WARC", lambda b: b"HTTP" + b[4:]),
])
@pytest.mark.parametrize("chunk", [3, 1 << 20])
def test_damaged_records(name, change, chunk):
    raw = b"".join(spoiled(1, change))
    with pytest.raises(ValueError, match=name):
        list(warc.records(io.BytesIO(raw), chunk=chunk))
    got = list(warc.records(io.BytesIO(raw), permissive=True, chunk=chunk))
    assert [g.get("record_id") for g in got] == ["urn:page:0", None, "urn:page:2"] and name in got[1]["fault"]


@pytest.mark.parametrize("chunk", [2, 1 << 20])
def test_damaged_compression(chunk):
    a, b, c = members()
    got = list(warc.records(io.BytesIO(a + b[:20] + b"\x00\x01\x02" * 9 + c), permissive=True, chunk=chunk))
    assert got[0]["record_id"] == "urn:page:0" and got[-1]["record_id"] == "urn:page:2" and any(g.get("fault") for g in got)
    with pytest.raises(ValueError, match="ends inside"):
        list(warc.records(io.BytesIO(a + b[:-9]), chunk=chunk))


def test_foreign_folder(spark, archive, tmp_path):
    """A folder without a manifest is read whole; PERMISSIVE rows tell faults."""
    os.mkdir(tmp_path / "d")
    (tmp_path / "d" / "one.warc.gz").write_bytes(b"".join(spoiled(1, lambda b: b.replace(b"body", b"bodi"))))
    read = spark.read.format("warc").option("mode", "PERMISSIVE").load(archive("d"))
    assert sorted(str(r.record_id) + str(r.fault) for r in read.collect()) == ["Noneblock digest differs", "urn:page:0None", "urn:page:2None"]
