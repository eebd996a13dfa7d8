"""WARC archives as a Spark data source, for reading and writing.

Reading plans partitions from file sizes and the offsets that a writer's manifest lists. In each, a record's headers are parsed first:
records whose type or headers fail the pushed predicates are skipped, and payloads that nobody wants are not decoded. A gzip member
whose extra field 'sl' tells that one record is all of it is skipped without inflating the rest; other members are inflated record by
record, however many a member has, and Content-Length is what skips in plain files. Files are reached through pyarrow's file systems, so a
path may be a URI.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, datetime

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, IsNotNull, StringStartsWith, WriterCommitMessage

SCHEMA = "record_id string, record_type string, target_uri string, date string, refers_to string, refers_to_uri string, payload_digest string, content_type string, content_length long, payload_length long, headers map<string,string>, payload binary"
#: Columns that are a header's value.
HEADER = {"record_id": "warc-record-id", "record_type": "warc-type", "target_uri": "warc-target-uri", "date": "warc-date", "refers_to": "warc-refers-to", "refers_to_uri": "warc-refers-to-target-uri", "payload_digest": "warc-payload-digest", "content_type": "content-type"}
WRITE_SCHEMA = "record_id string, record_type string, target_uri string, date string, refers_to string, refers_to_uri string, payload_digest string, payload binary"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = b"\r\n\r\n"
_ARROW = pa.schema([(n, pa.string()) for n in HEADER] + [("content_length", pa.int64()), ("payload_length", pa.int64()), ("headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())])


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def parse_headers(block: bytes) -> dict[str, str]:
    """Header fields by lower-cased name; the version line is left out, folded lines are joined."""
    out: dict[str, str] = {}
    name = ""
    for line in block.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and name:
            out[name] += " " + line.strip()
        else:
            name, _, value = line.partition(":")
            name = name.strip().lower()
            if name:
                out[name] = value.strip()
    return out


class _Stream:
    """Bytes of a file from an offset on, with skipping. A buffer is only added to at its end and taken from at its front, so all is linear."""

    def __init__(self, file, at: int, step: int = 1 << 18):
        self.file, self.at, self.step, self.buffer = file, at, step, bytearray()
        file.seek(at)

    def more(self) -> bool:
        new = self.file.read(self.step)
        self.buffer += new
        return bool(new)

    def need(self, n: int) -> bool:
        while len(self.buffer) < n:
            if not self.more():
                return False
        return True

    def take(self, n: int) -> bytes:
        """The next n bytes, or what there is of them."""
        self.need(n)
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        self.at += len(out)
        return out

    def skip(self, n: int) -> None:
        """Past the next n bytes, by a seek beyond what is buffered."""
        self.at += n
        if n <= len(self.buffer):
            del self.buffer[:n]
        else:
            self.buffer.clear()
            self.file.seek(self.at)

    def head(self) -> bytes | None:
        """A record's header block, past the empty lines before it; None at the end."""
        while self.need(1) and self.buffer[0] in b"\r\n":
            self.take(1)
        seen = 0
        while (at := self.buffer.find(_END, seen)) < 0:
            seen = max(0, len(self.buffer) - 3)
            if not self.more():
                if self.buffer:
                    raise ValueError("a record ends early")
                return None
        out = self.take(at + 4)[:at]
        if not out.startswith(b"WARC/"):
            raise ValueError("no WARC record")
        return out


class _Inflated(_Stream):
    """What gzip members hold, one after the other."""

    def __init__(self, file, at: int):
        super().__init__(file, at)
        self.raw, self.unzip, self.length, self.whole = _Stream(file, at), None, None, None

    @property
    def between(self) -> bool:
        """Nothing is left of the member read last."""
        return not self.buffer and (self.unzip is None or self.unzip.eof)

    def more(self) -> bool:
        if self.unzip is None or self.unzip.eof:
            if not self.raw.need(18):
                return False
            self.raw.need(512)  # or what is left
            self.length, self.whole = _gzip_length(bytes(self.raw.buffer[:512]))
            self.unzip, self.begin = zlib.decompressobj(31), self.raw.at
        piece = self.raw.take(min(max(4096, len(self.raw.buffer)), 1 << 16)) if self.buffer else self.raw.take(4096)
        if not piece:
            raise ValueError("a gzip member ends early")
        self.buffer += self.unzip.decompress(piece, 1 << 20)
        back = self.unzip.unused_data if self.unzip.eof else self.unzip.unconsumed_tail
        if back:
            self.raw.buffer[:0] = back
            self.raw.at -= len(back)
        return True

    def skip(self, n: int) -> None:
        while n and self.need(1):
            n -= len(self.take(min(n, len(self.buffer))))

    def leave(self) -> None:
        """Past the member, without inflating the rest."""
        self.raw.skip(self.begin + self.length - self.raw.at)
        self.buffer.clear()
        self.unzip = None


def _gzip_length(head: bytes) -> tuple[int | None, int | None]:
    """Bytes of this gzip member, and of what it holds, as its extra field 'sl' tells, if it does."""
    if len(head) < 12 or not head[3] & 4:
        return None, None
    size = struct.unpack_from("<H", head, 10)[0]
    at, past = 12, 12 + size
    while at + 4 <= min(past, len(head)):
        kind, n = head[at : at + 2], struct.unpack_from("<H", head, at + 2)[0]
        if kind == b"sl" and n >= 8 and at + 12 <= len(head):
            packed, whole = struct.unpack_from("<II", head, at + 4)
            return packed or None, whole
        at += 4 + n
    return None, None


def records(file, at: int, past: int, packed: bool, want, payloads: bool) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """(headers, block or None) of the records that begin in [at, past), packed: in members that do. want(headers) decides before anything else is decoded."""
    source = _Inflated(file, at) if packed else _Stream(file, at)
    while True:
        if packed and source.between:
            if source.raw.at >= past:
                return
        elif not packed:
            while source.need(1) and source.buffer[0] in b"\r\n":
                source.take(1)
            if source.at >= past:
                return
        fresh = packed and source.between
        head = source.head()
        if head is None:
            return
        headers = parse_headers(head)
        take, size = want(headers), int(headers.get("content-length", 0))
        if fresh and source.length and source.whole == len(head) + 4 + size + 4 and not (take and payloads):
            source.leave()
        elif take and payloads:
            block = source.take(size)
            if len(block) < size:
                raise ValueError("a record ends early")
        else:
            source.skip(size)
        if take:
            yield headers, block if payloads else None
        if packed:
            source.skip(4) if not source.between else None
            while source.buffer and source.buffer[0] in b"\r\n":
                source.take(1)


def payload_of(headers: dict[str, str], block: bytes | None) -> bytes | None:
    """What follows the HTTP headers, where the block has some."""
    if block is None:
        return None
    if headers.get("content-type", "").startswith("application/http"):
        return block.partition(_END)[2]
    return block


@dataclass
class Part(InputPartition):
    """Stretches of files: (path, from, to)."""

    pieces: list[tuple[str, int, int]]

    def __init__(self, pieces: list[tuple[str, int, int]]):
        self.pieces = pieces


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.size = int(options.get("partition_bytes", 64 << 20))
        self.payloads = options.get("payload", "true").lower() == "true"
        self.tests: list[tuple[str, str, tuple[str, ...]]] = []
        if types := options.get("record_types"):
            self.tests.append(("in", "warc-type", tuple(x.strip() for x in types.split(","))))

    def partitions(self) -> list[Part]:
        """Stretches of about partition_bytes; small files share a partition. A manifest's files are all there is, where there is one."""
        system, root = opened(self.path)
        info = system.get_file_info(root)
        files: dict[str, tuple[int, list[int]]] = {}
        if info.type == fs.FileType.File:
            files[root] = (info.size, [])
        else:
            found = system.get_file_info(fs.FileSelector(root, recursive=False))
            lists = [f for f in found if f.base_name.startswith("_manifest")]
            for f in sorted(lists, key=lambda f: f.path):
                with system.open_input_stream(f.path) as s:
                    for line in s.read().decode().splitlines():
                        x = json.loads(line)
                        files[f"{root}/{x['name']}"] = (x["bytes"], x["marks"])
            if not lists:
                files = {f.path: (f.size, []) for f in found if f.is_file and f.base_name.endswith((".warc", ".warc.gz"))}
        out, own, have = [], [], 0
        for path, (size, marks) in sorted(files.items()):
            cuts, last = [0], 0
            for m in marks:
                if m - last >= self.size:
                    cuts.append(m)
                    last = m
            for a, b in zip(cuts, [*cuts[1:], size], strict=True):
                if own and have + b - a > self.size:
                    out.append(Part(own))
                    own, have = [], 0
                own.append((path, a, b))
                have += b - a
        return [*out, *([Part(own)] if own else [])] or [Part([])]

    def wanted(self, headers: dict[str, str]) -> bool:
        for kind, name, values in self.tests:
            x = headers.get(name)
            if x is None or (kind == "in" and x not in values) or (kind == "starts" and not x.startswith(values)):
                return False
        return True

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        system, _ = opened(self.path)
        rows, size = [], 0
        for path, a, b in partition.pieces:
            with system.open_input_file(path) as f:
                for headers, block in records(f, a, b, path.endswith(".gz"), self.wanted, self.payloads):
                    payload = payload_of(headers, block)
                    given = headers.get("x-payload-length")
                    length = int(given) if given is not None else None if payload is None else len(payload)
                    rows.append([*(headers.get(h) for h in HEADER.values()), int(headers.get("content-length", 0)), length, list(headers.items()), payload])
                    size += len(payload or b"") + 512
                    if size >= 2 << 20:
                        yield self._batch(rows)
                        rows, size = [], 0
        if rows:
            yield self._batch(rows)

    @staticmethod
    def _batch(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), _ARROW, strict=True)], schema=_ARROW)


class PushReader(WarcReader):
    """A reader that takes predicates on columns that are headers; Spark's setting for it must be on."""

    def pushFilters(self, filters):  # noqa: N802 - Spark's name
        for f in filters:
            name = HEADER.get(f.attribute[0]) if getattr(f, "attribute", None) and len(f.attribute) == 1 else None
            if name and isinstance(f, EqualTo) and isinstance(f.value, str):
                self.tests.append(("in", name, (f.value,)))
            elif name and isinstance(f, In) and all(isinstance(v, str) for v in f.value):
                self.tests.append(("in", name, tuple(f.value)))
            elif name and isinstance(f, StringStartsWith):
                self.tests.append(("starts", name, (f.value,)))
            elif name and isinstance(f, IsNotNull):
                self.tests.append(("there", name, ()))
            else:
                yield f


@dataclass
class Written(WriterCommitMessage):
    files: list[dict]


class WarcWriter(DataSourceArrowWriter):
    """A task writes files of names of its own; only those of committed tasks get into the manifest, which is what readers go by."""

    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.level = int(options.get("level", 3))
        self.packed = options.get("compression", "gzip") == "gzip"
        self.most = int(options.get("file_bytes", 512 << 20))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, root = opened(self.path)
        system.create_dir(root, recursive=True)
        files, out, at = [], None, 0

        def put(record: bytes) -> None:
            nonlocal at
            raw = _member(record, self.level) if self.packed else record
            if at - (files[-1]["marks"] or [0])[-1] >= 8 << 20:
                files[-1]["marks"].append(at)
            out.write(raw)
            at += len(raw)
            files[-1]["records"] += 1

        for batch in iterator:
            for row in batch.to_pylist():
                if out is None or at >= self.most:
                    if out is not None:
                        out.close()
                        files[-1]["bytes"] = at
                    name = f"part-{uuid.uuid4().hex}.warc" + ".gz" * self.packed
                    files.append({"name": name, "bytes": 0, "records": 0, "marks": []})
                    out, at = system.open_output_stream(f"{root}/{name}", compression=None), 0
                    put(_info(name))
                put(record_bytes(row))
        if out is not None:
            out.close()
            files[-1]["bytes"] = at
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        system, root = opened(self.path)
        system.create_dir(root, recursive=True)
        with system.open_output_stream(f"{root}/_manifest-{uuid.uuid4().hex}.json") as s:
            s.write("".join(json.dumps(f) + "\n" for m in messages if m for f in m.files).encode())

    def abort(self, messages: list[Written | None]) -> None:
        system, root = opened(self.path)
        for f in (f for m in messages if m for f in m.files):
            try:
                system.delete_file(f"{root}/{f['name']}")
            except OSError:  # it is in no manifest, so nobody reads it
                pass


def _member(record: bytes, level: int) -> bytes:
    """A gzip member that tells its compressed and whole length in the extra field 'sl'."""
    z = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = z.compress(record) + z.flush()
    size = 24 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, size if size < 1 << 32 else 0, len(record) & 0xFFFFFFFF)
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


def _lines(fields: list[tuple[str, str | None]]) -> bytes:
    return b"WARC/1.1\r\n" + "".join(f"{k}: {' '.join(str(v).split())}\r\n" for k, v in fields if v is not None).encode() + b"\r\n"


def _info(name: str) -> bytes:
    block = b"format: WARC File Format 1.1\r\n"
    now = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    return _lines([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", now), ("WARC-Filename", name), ("Content-Type", "application/warc-fields"), ("Content-Length", str(len(block)))]) + block + _END


def record_bytes(row: dict) -> bytes:
    """One record. A revisit has HTTP headers only; its payload's length and digest are told by its headers."""
    payload = row["payload"] or b""
    revisit = row["record_type"] == "revisit"
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if not revisit:
        block += payload
    digest = row["payload_digest"]
    return (
        _lines(
            [
                ("WARC-Type", row["record_type"]),
                ("WARC-Record-ID", row["record_id"]),
                ("WARC-Target-URI", row["target_uri"]),
                ("WARC-Date", row["date"]),
                ("WARC-Payload-Digest", digest and f"sha256:{digest}"),
                ("WARC-Refers-To", row["refers_to"]),
                ("WARC-Refers-To-Target-URI", row["refers_to_uri"]),
                ("WARC-Profile", REVISIT_PROFILE if revisit else None),
                ("X-Payload-Length", str(len(payload))),
                ("Content-Type", "application/http; msgtype=response"),
                ("Content-Length", str(len(block))),
            ]
        )
        + block
        + _END
    )


class WarcDataSource(DataSource):
    """format("warc"). Options to read: payload (true), record_types (comma-joined), partition_bytes, pushdown (false); to write: compression, level, file_bytes."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return (PushReader if self.options.get("pushdown", "false").lower() == "true" else WarcReader)(dict(self.options))

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("archives are only added to")
        return WarcWriter(dict(self.options))


def register(spark: SparkSession) -> None:
    """Make format("warc") known, with predicates pushed to it."""
    from tidemill.llm.common import ship

    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def read_warc(spark: SparkSession, path: str, *, payload: bool = True) -> DataFrame:
    """Records of a file or folder. Filters on header columns, of the forms =, in, starts with and is not null, are pushed to the reader."""
    register(spark)
    return spark.read.format("warc").option("pushdown", "true").option("payload", str(payload).lower()).load(path)


def page_records(pages: DataFrame, *, key: str = "page_id", url: str = "url", html: str = "html", least: int = 100) -> DataFrame:
    """Rows to write: a record for each page, a revisit where an earlier page has the same payload of at least `least` bytes.

    Edge cases: a null html is the empty payload; a null key is written as such and is the earliest of nobody; rows that repeat the smallest key of
    their payload are all responses; columns that are not named don't matter.
    """
    from tidemill.llm.common import cut, drop

    base = pages.select(F.col(f"`{key}`").alias("k"), F.col(f"`{url}`").alias("u"), F.coalesce(F.col(f"`{html}`"), F.lit("")).cast("binary").alias("payload"))
    base = base.withColumns({"digest": F.sha2("payload", 256), "size": F.octet_length("payload")})
    # what is decided by digest is decided without the payloads, which only meet their own row's decision; a digest of very many pages is dealt out
    few = base.where(F.col("size") >= least).select("k", "u", "digest")
    again = cut(few.groupBy("digest").agg(F.min(F.when(F.col("k").isNotNull(), F.struct("k", "u"))).alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null").select(F.col("digest").alias("d"), F.col("first.k").alias("first"), F.col("first.u").alias("first_url")))
    salted = again.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(15)))).hint("merge")
    own = few.select("k", "digest").distinct().withColumn("s", F.pmod(F.xxhash64("k"), F.lit(16)).cast("int"))
    narrow = own.join(salted, (F.col("digest") == F.col("d")) & (F.col("s") == F.col("salt")))
    revisits = cut(narrow.where(~F.col("k").eqNullSafe(F.col("first"))).select(F.col("k").alias("own"), "d", "first", "first_url"))
    drop(again)
    both = base.join(revisits, F.col("k").eqNullSafe(F.col("own")) & (F.col("digest") == F.col("d")), "left")
    late = F.col("first").isNotNull()

    def urn(c):
        return F.concat(F.lit("<urn:x-page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))

    return both.select(
        urn(F.col("k")).alias("record_id"),
        F.when(late, "revisit").otherwise("response").alias("record_type"),
        F.col("u").alias("target_uri"),
        F.lit("2020-01-01T00:00:00Z").alias("date"),
        F.when(late, urn(F.col("first"))).alias("refers_to"),
        F.when(late, F.col("first_url")).alias("refers_to_uri"),
        F.col("digest").alias("payload_digest"),
        "payload",
    )


def write_warc(rows: DataFrame, path: str) -> None:
    """Write record rows (see page_records) as archives under `path`."""
    register(rows.sparkSession)
    rows.write.format("warc").mode("append").save(path)


def page_number(urn: str) -> Column:
    """The page's key from a record id; null if it was null."""
    text = F.regexp_extract(F.col(urn), r"^<urn:x-page:(-?\d+)>$", 1)
    return F.when(text != "", text).cast("long")
