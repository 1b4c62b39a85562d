"""A Spark data source for WARC archives, and revisit records for repeated payloads.

Reading plans whole files into partitions of similar size, parses the headers of a record
first, and decodes the payload only of records that pass the pushed-down predicates and
only if the schema asks for it. Files are plain (payloads are then skipped by seeking) or
have one gzip member per record.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    In,
    InputPartition,
    WriterCommitMessage,
)

from lakejobs.llm.common import kept, share_package

SCHEMA = (
    "record_id string, record_type string, target_uri string, payload_digest string, "
    "refers_to string, payload_length long, payload binary"
)
# Header fields of the format.
FIELDS = {
    "record_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PARTITION_BYTES = 64 << 20
CHUNK = 1 << 18
BATCH_BYTES = 8 << 20
# Longer header blocks than this are not WARC.
MAX_HEADER = 1 << 20


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path on it."""
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path)


@dataclass
class Files(InputPartition):
    """Files one task reads."""

    paths: list[str]

    def __init__(self, paths: list[str]):
        self.paths = paths


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class _Stream:
    """Bytes of a file, decoded record by record when compressed."""

    def __init__(self, source, compressed: bool):
        self.source, self.compressed = source, compressed
        self.raw = self.text = b""
        self.decoder = zlib.decompressobj(31) if compressed else None

    def _more(self) -> bool:
        if not self.compressed:
            data = self.source.read(CHUNK)
            self.text += data
            return bool(data)
        while True:
            if not self.raw:
                self.raw = self.source.read(CHUNK)
                if not self.raw:
                    return False
            if self.decoder.eof:
                self.decoder = zlib.decompressobj(31)
            out = self.decoder.decompress(self.raw, CHUNK)
            self.raw = self.decoder.unused_data if self.decoder.eof else self.decoder.unconsumed_tail
            if out:
                self.text += out
                return True

    def until(self, mark: bytes) -> bytes | None:
        """Bytes through ``mark``; None at the end of the file."""
        start = 0
        while (at := self.text.find(mark, start)) < 0:
            if len(self.text) > MAX_HEADER:
                raise ValueError("not a WARC file: a header block does not end")
            start = max(0, len(self.text) - len(mark))
            if not self._more():
                if self.text.strip():
                    raise ValueError("a WARC record is cut off")
                return None
        out, self.text = self.text[: at + len(mark)], self.text[at + len(mark) :]
        return out

    def take(self, size: int) -> bytes:
        parts, have = [self.text[:size]], min(size, len(self.text))
        self.text = self.text[size:]
        while have < size:
            if not self._more():
                raise ValueError("a WARC record is cut off")
            parts.append(self.text[: size - have])
            self.text = self.text[size - have :]
            have += len(parts[-1])
        return b"".join(parts)

    def skip(self, size: int) -> None:
        """Pass over bytes without keeping them."""
        if not self.compressed and size > len(self.text):
            self.source.seek(self.source.tell() + size - len(self.text))
            self.text = b""
            return
        while size > len(self.text):
            size -= len(self.text)
            self.text = b""
            if not self._more():
                raise ValueError("a WARC record is cut off")
        self.text = self.text[size:]


def _headers(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8", "replace").strip("\r\n").split("\r\n")
    pairs = (line.split(":", 1) for line in lines[1:] if ":" in line)
    return {k.strip().lower(): v.strip() for k, v in pairs}


def read_records(
    source, compressed: bool, wanted: dict[str, set[str]], with_payload: bool
) -> Iterator[dict]:
    """Records whose header fields are among ``wanted`` (field of FIELDS to values)."""
    stream = _Stream(source, compressed)
    while (block := stream.until(b"\r\n\r\n")) is not None:
        headers = _headers(block.lstrip())
        size = int(headers.get("content-length", 0))
        row = {field: headers.get(name.lower()) for field, name in FIELDS.items()}
        if any(row[field] not in values for field, values in wanted.items()):
            stream.skip(size + 4)
            continue
        row["payload_length"], row["payload"] = size, None
        if headers.get("content-type", "").startswith("application/http"):
            head = stream.until(b"\r\n\r\n")
            http = _headers(head)
            size -= len(head)
            row["payload_length"] = int(http.get("content-length", size))
        if with_payload and row["record_type"] != "revisit":
            row["payload"] = stream.take(size)
            stream.skip(4)
        else:
            stream.skip(size + 4)
        yield row


def record_bytes(row: dict) -> bytes:
    """One WARC record; a revisit has no payload but keeps its length in the HTTP headers."""
    revisit = row["record_type"] == "revisit"
    body = b"" if revisit else row["payload"] or b""
    length = row["payload_length"] if row["payload_length"] is not None else len(body)
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {length}\r\n\r\n"
    ).encode()
    lines = ["WARC/1.1"]
    lines += [f"{FIELDS[f]}: {_one_line(row[f])}" for f in FIELDS if row[f] is not None]
    lines += [f"WARC-Profile: {PROFILE}"] if revisit else []
    lines += ["Content-Type: application/http;msgtype=response"]
    lines += [f"Content-Length: {len(http) + len(body)}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + http + body + b"\r\n\r\n"


def _one_line(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A")


class WarcReader(DataSourceReader):
    def __init__(self, schema, options):
        self.columns = [f.name for f in schema]
        self.path = options["path"]
        self.wanted: dict[str, set[str]] = {}
        self.arrow = None

    def pushFilters(self, filters):
        """Take equality and membership of header fields; return what Spark must check."""
        for one in filters:
            column = getattr(one, "attribute", (None,))[0]
            if column in FIELDS and isinstance(one, EqualTo):
                values = {one.value}
            elif column in FIELDS and isinstance(one, In):
                values = set(one.value)
            else:
                yield one
                continue
            self.wanted[column] = self.wanted.get(column, values) & values

    def partitions(self):
        fs, path = file_system(self.path)
        found = fs.get_file_info(pafs.FileSelector(path, recursive=False))
        files = sorted(
            ((f.path, f.size) for f in found if f.is_file and ".warc" in f.base_name),
            key=lambda f: (-f[1], f[0]),
        )
        parts, size = [[]], 0
        for name, n in files:
            if parts[-1] and size + n > PARTITION_BYTES:
                parts.append([])
                size = 0
            parts[-1].append(name)
            size += n
        return [Files(p) for p in parts if p] or [Files([])]

    def read(self, partition):
        names = {f.split()[0]: f.split()[1] for f in SCHEMA.split(", ")}
        kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
        schema = pa.schema([(c, kinds[names[c]]) for c in self.columns])
        fs, _ = file_system(self.path)
        rows, held = [], 0
        for path in partition.paths:
            with fs.open_input_file(path) as source:
                records = read_records(
                    source, path.endswith(".gz"), self.wanted, "payload" in self.columns
                )
                for row in records:
                    rows.append({c: row[c] for c in self.columns})
                    held += 200 + len(row["payload"] or b"")
                    if held > BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


class WarcWriter(DataSourceArrowWriter):
    """Each task attempt writes files of its own under ``_pending``; commit moves them up."""

    def __init__(self, options):
        self.path = options["path"]
        self.compressed = options.get("compression", "gzip") == "gzip"
        self.file_bytes = int(options.get("file_bytes", 256 << 20))

    def write(self, iterator):
        fs, path = file_system(self.path)
        fs.create_dir(f"{path}/_pending", recursive=True)
        names, out, size = [], None, 0
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None or size > self.file_bytes:
                    if out:
                        out.close()
                    suffix = ".warc.gz" if self.compressed else ".warc"
                    names.append(f"part-{uuid.uuid4().hex}{suffix}")
                    out, size = fs.open_output_stream(f"{path}/_pending/{names[-1]}", compression=None), 0
                data = record_bytes(row)
                if self.compressed:
                    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                    data = packer.compress(data) + packer.flush()
                out.write(data)
                size += len(data)
        if out:
            out.close()
        return Written(names)

    def commit(self, messages):
        fs, path = file_system(self.path)
        for message in messages:
            for name in message.names if message else []:
                fs.move(f"{path}/_pending/{name}", f"{path}/{name}")

    def abort(self, messages):
        fs, path = file_system(self.path)
        for message in messages:
            for name in message.names if message else []:
                fs.delete_file(f"{path}/_pending/{name}")


class WarcSource(DataSource):
    """``spark.read.format("warc")``; options ``path``, and for writing ``compression``."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(schema, self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    share_package(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def read_warc(spark: SparkSession, path: str, schema: str = SCHEMA) -> DataFrame:
    """Records under ``path``; ask for a ``schema`` without payload to leave payloads undecoded."""
    register(spark)
    return spark.read.format("warc").schema(schema).load(path)


def write_warc(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write rows with the columns of SCHEMA, one record each, to the new folder ``path``."""
    register(records.sparkSession)
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    writer = records.select(*names).write.format("warc").mode("append")
    writer.option("path", path).option("compression", compression).save()


def record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), page_id.cast("string"), F.lit(">"))


def page_of(uri: Column) -> Column:
    """The id in a record id, NULL for other URIs."""
    return F.try_to_number(F.regexp_extract(uri, r"^<urn:page:(-?\d+)>$", 1), F.lit("S" + "9" * 19)).cast("long")


def with_revisits(
    pages: DataFrame,
    least_bytes: int = 1000,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """Rows with the columns of SCHEMA for ``pages``.

    Of rows with equal payloads of ``least_bytes`` or more, those with the largest id are
    responses and the others revisit it without a payload. NULL html is an empty payload.
    Rows without an id are responses; rows repeated under one id are judged alike. Other
    columns are not read.
    """
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_col).alias("__id"),
        F.col(url_col).alias("target_uri"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_length"),
        F.sha1(payload).alias("__sha1"),
    )
    large = kept(
        rows.where(F.col("payload_length") >= least_bytes).select("__id", "__sha1"), "payloads"
    )
    last = (
        large.groupBy("__sha1")
        .agg(F.max("__id").alias("__last"), F.min("__id").alias("__first"))
        .where("__first < __last")
        .select("__sha1", "__last")
    )
    revisits = kept(
        large.join(kept(last, "repeated-payloads"), "__sha1")
        .where("__id < __last")
        .distinct(),
        "revisits",
    )
    is_revisit = F.col("__last").isNotNull()
    return rows.join(revisits, ["__id", "__sha1"], "left").select(
        F.coalesce(record_id(F.col("__id")), F.lit("<urn:page:>")).alias("record_id"),
        F.when(is_revisit, "revisit").otherwise("response").alias("record_type"),
        "target_uri",
        F.concat(F.lit("sha1:"), "__sha1").alias("payload_digest"),
        record_id(F.col("__last")).alias("refers_to"),
        "payload_length",
        F.when(~is_revisit, F.col("payload")).alias("payload"),
    )


def archived(records: DataFrame) -> DataFrame:
    """Per record read back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Length and digest of responses are taken from the payload itself, those of revisits
    from their headers.
    """
    known = F.col("payload").isNotNull()
    return records.select(
        page_of(F.col("record_id")).alias("page_id"),
        F.when(known, F.octet_length("payload").cast("long"))
        .otherwise(F.col("payload_length"))
        .alias("payload_bytes"),
        F.when(known, F.sha1("payload"))
        .otherwise(F.lower(F.regexp_extract("payload_digest", r"^sha1:(.*)$", 1)))
        .alias("payload_digest"),
        "record_type",
        page_of(F.col("refers_to")).alias("refers_to"),
    )
