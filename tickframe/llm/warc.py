"""WARC archives as a Spark data source, one gzip member per record.

``register(spark)`` makes ``df.write.format("warc").save(folder)`` and
``spark.read.format("warc").load(folder)`` work.

* Writing: each task appends records to its own archive and starts another
  one beyond ``max_bytes``. A file counts once the job's commit has named it
  in the folder's manifest, so a task that is lost and run again, or run
  twice, leaves no half-written or doubled archive.
* Reading: one task reads an archive from front to back: pieces of the file
  go through an incremental zlib decompressor, a record's block is framed by
  its Content-Length, and block and payload digests are computed on the way
  and compared with the header's. With option ``payload`` = ``false`` no
  payload is kept, so memory doesn't depend on the records' sizes.
* Files are opened through ``pyarrow.fs``, so the folder may be in any store
  that it knows (file, hdfs, s3, gs).

Option ``mode``: ``FAILFAST`` (default) ends the job on a damaged record;
``PERMISSIVE`` gives a row whose ``fault`` tells the damage and goes on at
the next gzip member. Folders without a manifest are read whole
(``*.warc.gz``), for archives of other origin.

Cases: a null payload of a response is empty; a revisit has no payload but
states its length and digest; control characters and blanks of a target URI
are percent-encoded, a null one is left out; an empty table gives an empty
manifest and no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from .common import shared_folder, small, stage

RECORD = ("record_id string, record_type string, target_uri string, refers_to string, payload_bytes long, payload_digest string, "
          "payload binary, file string, offset long, fault string")
CHUNK = 1 << 20
MAX_BYTES = 128 << 20
#: Longest header block that a reader accepts.
MAX_HEADER = 1 << 20
DATE = "1970-01-01T00:00:00Z"
MANIFEST = "_manifest.json"
#: Payloads below this many bytes are never replaced by a revisit record.
MIN_REVISIT = 1000
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _store(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder) if ":/" in folder else (pafs.LocalFileSystem(), folder)


def _base32(hexed: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(hexed)).decode()


def _hex(digest: str | None) -> str | None:
    return base64.b32decode(digest.split(":", 1)[1].upper()).hex() if digest and digest.lower().startswith("sha1:") else None


def _uri(text: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", text)


def member(fields: list[tuple[str, str]], block: bytes, level: int) -> bytes:
    """One record as a gzip member."""
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    press = zlib.compressobj(level, zlib.DEFLATED, 31)
    return press.compress(head.encode() + b"\r\n" + block + b"\r\n\r\n") + press.flush()


def record(row: dict, date: str, level: int) -> bytes:
    """The member of a response or revisit row."""
    payload, revisit = row["payload"] or b"", row["record_type"] == "revisit"
    digest = row["payload_digest"] if revisit else hashlib.sha1(payload).hexdigest()
    block = _HTTP % (row["payload_bytes"] if revisit else len(payload)) + (b"" if revisit else payload)
    fields = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", f"<{row['record_id']}>"), ("WARC-Date", date)]
    if row["target_uri"] is not None:
        fields.append(("WARC-Target-URI", _uri(row["target_uri"])))
    if revisit:
        fields += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", f"<{row['refers_to']}>")]
    fields += [("WARC-Payload-Digest", _base32(digest)), ("WARC-Block-Digest", _base32(hashlib.sha1(block).hexdigest())),
               ("Content-Type", "application/http;msgtype=response")]
    return member(fields, block, level)


class _Framed:
    """One record, fed with the decompressed bytes of its member."""

    def __init__(self, keep: bool):
        self.keep, self.fields, self.head, self.left = keep, None, bytearray(), 0
        self.block, self.payload_sha, self.http, self.in_http = hashlib.sha1(), hashlib.sha1(), bytearray(), False
        self.size, self.parts, self.tail = 0, [], b""

    def _parse(self, head: bytes) -> dict:
        lines = head.decode("utf-8", "replace").split("\r\n")
        out = {}
        for line in lines[1:]:
            name, _, value = line.partition(":")
            out[name.strip().lower()] = value.strip()
        out[""] = lines[0]
        return out

    def feed(self, data: bytes) -> None:
        if self.fields is None:
            self.head += data
            end = self.head.find(b"\r\n\r\n")
            if end < 0:
                if len(self.head) > MAX_HEADER:
                    raise ValueError("no end of the record header")
                return
            self.fields = self._parse(bytes(self.head[:end]))
            if not self.fields[""].startswith("WARC/1."):
                raise ValueError("not a WARC record")
            self.left = int(self.fields["content-length"])
            self.in_http = self.fields.get("content-type", "").startswith("application/http")
            data, self.head = bytes(self.head[end + 4:]), bytearray()
        body, rest = data[:self.left], data[self.left:]
        self.left -= len(body)
        self.block.update(body)
        if self.in_http and body:
            self.http += body
            end, body = self.http.find(b"\r\n\r\n"), b""
            if end >= 0:
                body, self.http, self.in_http = bytes(self.http[end + 4:]), self._parse(bytes(self.http[:end])), False
            elif len(self.http) > MAX_HEADER:
                raise ValueError("no end of the HTTP header")
        if body:
            self.payload_sha.update(body)
            self.size += len(body)
            if self.keep:
                self.parts.append(body)
        self.tail += rest
        if len(self.tail) > 4:
            raise ValueError("more bytes than Content-Length")

    def close(self) -> dict:
        if self.fields is None or self.left or self.tail != b"\r\n\r\n" or self.in_http:
            raise ValueError("fewer bytes than Content-Length")
        get, kind = self.fields.get, self.fields.get("warc-type")
        stated, block = _hex(get("warc-payload-digest")), _hex(get("warc-block-digest"))
        if block is not None and block != self.block.hexdigest():
            raise ValueError("block digest differs")
        if kind == "revisit":
            size, digest = (int(self.http["content-length"]) if isinstance(self.http, dict) and "content-length" in self.http else None), stated
        else:
            size, digest = self.size, self.payload_sha.hexdigest()
            if stated is not None and stated != digest:
                raise ValueError("payload digest differs")
        return {"record_id": (get("warc-record-id") or "").strip("<>"), "record_type": kind, "target_uri": get("warc-target-uri"),
                "refers_to": get("warc-refers-to").strip("<>") if get("warc-refers-to") else None, "payload_bytes": size, "payload_digest": digest,
                "payload": b"".join(self.parts) if self.keep and kind != "revisit" else None, "fault": None}


def records(stream, keep: bool = True, permissive: bool = False, chunk: int = CHUNK):
    """The records of one archive, in order, each with the offset of its member."""
    raw, at = b"", 0
    while True:
        raw = raw or stream.read(chunk)
        if not raw:
            return
        offset, press, one = at, zlib.decompressobj(31), _Framed(keep)
        try:
            full = False
            while not press.eof:
                if not raw and not full:
                    raw = stream.read(chunk)
                    if not raw:
                        raise ValueError("the archive ends inside a member")
                given = len(raw)
                data = press.decompress(raw, chunk)
                raw = press.unused_data if press.eof else press.unconsumed_tail
                at, full = at + given - len(raw), len(data) == chunk
                one.feed(data)
            yield one.close() | {"offset": offset}
        except (ValueError, KeyError, zlib.error) as fault:
            if not permissive:
                raise ValueError(f"record at byte {offset}: {fault}") from fault
            yield {"offset": offset, "fault": str(fault)}
            if not press.eof:  # look for the next member, from just behind this one's start
                stream.seek(offset + 1)
                raw, at = b"", offset + 1
                while (found := raw.find(b"\x1f\x8b\x08")) < 0:
                    more = stream.read(chunk)
                    if not more:
                        return
                    raw, at = raw[-2:] + more, at + len(raw[:-2])
                raw, at = raw[found:], at + found


@dataclass
class _Written(WriterCommitMessage):
    files: list


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options, schema, overwrite: bool):
        self.folder = options["path"].rstrip("/")
        self.level, self.date = int(options.get("level", 6)), options.get("date", DATE)
        self.max_bytes, self.overwrite = int(options.get("max_bytes", MAX_BYTES)), overwrite

    def write(self, batches):
        store, folder = _store(self.folder)
        store.create_dir(folder, recursive=True)
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        files, out, size = [], None, 0
        columns = ["record_id", "record_type", "target_uri", "refers_to", "payload_bytes", "payload_digest", "payload"]
        try:
            for batch in batches:
                rows = [batch.column(c) for c in columns]
                for i in range(batch.num_rows):
                    if out is None:
                        files.append({"name": f"part-{part:05d}-{attempt}-{len(files):05d}.warc.gz", "records": 0, "bytes": 0})
                        out = store.open_output_stream(f"{folder}/{files[-1]['name']}", compression=None)
                        size = out.write(member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", self.date),
                                                 ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n", self.level))
                    size += out.write(record({c: v[i].as_py() for c, v in zip(columns, rows, strict=True)}, self.date, self.level))
                    files[-1]["records"] += 1
                    files[-1]["bytes"] = size
                    if size >= self.max_bytes:
                        out.close()
                        out = None
        except BaseException:
            if out is not None:
                out.close()
            for f in files:
                store.delete_file(f"{folder}/{f['name']}")
            raise
        if out is not None:
            out.close()
        return _Written(files)

    def commit(self, messages) -> None:
        store, folder = _store(self.folder)
        store.create_dir(folder, recursive=True)
        old = _manifest(store, folder) or []
        files = [f for m in messages if m is not None for f in m.files]
        fresh = f"{folder}/{MANIFEST}.{uuid.uuid4().hex}"
        with store.open_output_stream(fresh, compression=None) as out:
            out.write(json.dumps({"files": files if self.overwrite else old + files}).encode())
        store.move(fresh, f"{folder}/{MANIFEST}")
        if self.overwrite:
            for f in old:
                store.delete_file(f"{folder}/{f['name']}")

    def abort(self, messages) -> None:
        store, folder = _store(self.folder)
        for m in messages:
            for f in m.files if m is not None else []:
                store.delete_file(f"{folder}/{f['name']}")


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.folder = options["path"].rstrip("/")
        self.keep = options.get("payload", "true").lower() != "false"
        self.permissive = options.get("mode", "FAILFAST").upper() == "PERMISSIVE"

    def partitions(self):
        store, folder = _store(self.folder)
        files = _manifest(store, folder)
        if files is None:
            found = store.get_file_info(pafs.FileSelector(folder))
            files = [{"name": f.base_name} for f in found if f.base_name.endswith(".warc.gz")]
        return [InputPartition(f["name"]) for f in files] or [InputPartition("")]

    def read(self, partition):
        if not partition.value:
            return
        store, folder = _store(self.folder)
        rows, held = [], 0
        with store.open_input_file(f"{folder}/{partition.value}") as stream:
            for one in records(stream, self.keep, self.permissive):
                rows.append(one | {"file": partition.value})
                held += len(one.get("payload") or b"")
                if len(rows) >= 4096 or held >= 16 << 20:
                    yield pa.RecordBatch.from_pylist(rows, _ARROW)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _ARROW)


_ARROW = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()), ("refers_to", pa.string()),
                    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()), ("file", pa.string()),
                    ("offset", pa.int64()), ("fault", pa.string())])


def _manifest(store, folder: str) -> list | None:
    name = f"{folder}/{MANIFEST}"
    if store.get_file_info(name).type == pafs.FileType.NotFound:
        return None
    with store.open_input_stream(name, compression=None) as f:
        return json.loads(f.read())["files"]


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return RECORD

    def writer(self, schema, overwrite):
        return WarcWriter(self.options, schema, overwrite)

    def reader(self, schema):
        return WarcReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcDataSource)


def as_records(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Record rows of (page_id, url, html). Of rows whose payloads are equal
    and have ``min_revisit`` bytes or more, those with the largest page_id
    are responses and the others revisit it; a null page_id is below all
    others. Rows that repeat a page_id with its payload are alike."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("target_uri"), payload.alias("payload"))
    rows = rows.select("*", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"))
    groups = (rows.where(F.col("payload_bytes") >= min_revisit).groupBy("payload_bytes", "payload_digest")
              .agg(F.max("page_id").alias("first"), F.count("*").alias("copies")).where(F.col("copies") > 1).drop("copies"))
    rows = rows.join(small(stage(groups, "warc-groups")), ["payload_bytes", "payload_digest"], "left")
    again = F.col("first").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") < F.col("first")))
    name = F.concat(F.lit("urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    return rows.select(name.alias("record_id"), F.when(again, "revisit").otherwise("response").alias("record_type"), "target_uri",
                       F.when(again, F.concat(F.lit("urn:page:"), F.col("first").cast("string"))).alias("refers_to"),
                       "payload_bytes", "payload_digest", F.when(~again, F.col("payload")).alias("payload"))


def page_id(record_id) -> F.Column:
    """The number behind a record id of ``as_records``."""
    return F.substring(record_id, 10, 20).try_cast("long")


def new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"


def report(archive: DataFrame) -> DataFrame:
    rows = archive.where(F.col("record_type").isin("response", "revisit"))
    return rows.select(page_id("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page_id("refers_to").alias("refers_to"))
