"""WARC archives: write captures as records, read records back, and put each capture together again.

A capture is a request, a response (or a revisit of an earlier one) and metadata.
The archives are files of gzip members, one for each record, in a folder that all
executors reach. Records say which others they belong to by WARC-Concurrent-To,
so assembly is a join on record ids; what a revisit repeats is found by WARC-Refers-To.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zlib
from collections.abc import Callable, Iterator
from datetime import UTC, datetime
from typing import BinaryIO

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shipflux.llm.common import share
from shipflux.session import staged, work_folder

# A task begins a new archive when one has this many bytes; readers get stretches of whole records of about the other.
ARCHIVE_BYTES = 1 << 30
SLICE_BYTES = 16 << 20
# Bytes taken from a file at once.
BLOCK = 1 << 20
# A table of repeated payloads, or of what revisits refer to, is broadcast up to this size and shuffled beyond.
SMALL_BYTES = 64 << 20
# A key of this share of all rows or more is hot; there are no more such keys than the number says.
HOT_SHARE = 256

# Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURES = ("response", "revisit", "resource", "conversion")
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_RADIX32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def base32_sha1(payload: Column) -> Column:
    """The bare upper-case base32 SHA-1 of a binary column: four times 40 bits as eight digits."""
    digits = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digits, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), _RADIX32, _BASE32)


def record_id(*parts: Column) -> Column:
    """A record id of the given values; equal values, equal id."""
    spelled = [F.coalesce(p.cast("string"), F.lit("\x00")) for p in parts]
    digits = F.md5(F.concat_ws("\x01", *spelled).cast("binary"))
    return F.concat(F.lit("urn:uuid:"), F.regexp_replace(digits, "(.{8})(.{4})(.{4})(.{4})(.{12})", "$1-$2-$3-$4-$5"))


def attached(rows: DataFrame, side: DataFrame, key: str, total: int) -> DataFrame:
    """Left join of `rows` with a staged `side` of unique keys, columns `count` (rows that share the key) and `found`.

    Keys that have 1/HOT_SHARE of `total` rows or more are few by that, and are
    broadcast. The rest is broadcast if its measured size is small, else merged by
    shuffle, where rows with no key or a hot one travel by a hash of their own.
    """
    hot = side.filter(F.col("count") * HOT_SHARE >= total).select(key, F.col("found").alias("hot"))
    rest = side.filter(F.col("count") * HOT_SHARE < total).select(F.col(key).alias("rest_key"), F.col("found").alias("rest"))
    met = rows.join(F.broadcast(hot), key, "left")
    size = rest.agg(F.sum(F.octet_length("rest_key") + F.octet_length(F.to_json("rest")) + 40)).first()[0] or 0
    if size <= SMALL_BYTES:
        met = met.join(F.broadcast(rest), F.col(key) == F.col("rest_key"), "left")
    else:
        own = F.concat(F.lit("hot "), F.xxhash64("own_id").cast("string"))
        met = met.withColumn("way", F.when(F.col("hot").isNotNull() | F.col(key).isNull(), own).otherwise(F.col(key)))
        met = met.join(rest.hint("merge"), F.col("way") == F.col("rest_key"), "left").drop("way")
    return met.withColumn("found", F.coalesce("hot", "rest")).drop("hot", "rest", "rest_key")


# ---- writing ----


def head(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = [VERSION, *(f"{k}: {v}" for k, v in fields if v is not None), f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def one_line(value: str | None) -> str | None:
    """A value for a header line: control characters are percent-encoded, as in a URL."""
    if value is None:
        return None
    return "".join(c if " " <= c != "\x7f" else f"%{ord(c):02X}" for c in value)


def http_target(url: str | None) -> tuple[str, str]:
    """Host and target of a request line, without spaces."""
    after = (url or "").partition("://")[2].replace(" ", "%20")
    cut = min((i for i in map(after.find, "/?#") if i >= 0), default=len(after))
    target = after[cut:].partition("#")[0]
    return after[:cut], target if target.startswith("/") else f"/{target}"


def capture_records(row: dict, date: str) -> list[bytes]:
    """The request, the response or revisit, and the metadata of one row."""
    url, own, first = one_line(row["url"]), row["own_id"], row["found"]
    payload = row["payload"]
    digest = f"sha1:{row['digest']}"
    common = [("WARC-Date", date), ("WARC-Target-URI", url)]

    def described(kind: str, name: str, media: str, more=()) -> list:
        return [("WARC-Type", kind), ("WARC-Record-ID", f"<{name}>"), *common, *more, ("Content-Type", media)]

    host, target = http_target(url)
    request = f"GET {target} HTTP/1.1\r\nHost: {host}\r\n\r\n".encode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    beside = [("WARC-Concurrent-To", f"<{own}>")]
    if first is None:
        kept = described("response", own, "application/http; msgtype=response", [("WARC-Payload-Digest", digest)])
        main = head(kept, http + payload)
    else:
        more = [
            ("WARC-Payload-Digest", digest),
            ("WARC-Profile", IDENTICAL),
            ("WARC-Refers-To", f"<{first['record_id']}>"),
            ("WARC-Refers-To-Target-URI", one_line(first["url"])),
            ("WARC-Refers-To-Date", date),
        ]
        main = head(described("revisit", own, "application/http; msgtype=response", more), http)
    fields = f"id: {one_line(row['id'])}\r\n" if row["id"] is not None else ""
    return [
        head(described("request", row["request_id"], "application/http; msgtype=request", beside), request),
        main,
        head(described("metadata", row["metadata_id"], "application/warc-fields", beside), fields.encode()),
    ]


def archiver(folder: str, date: str, archive_bytes: int, slice_bytes: int):
    """Write a task's rows as archives; give (path, start, end, records) of stretches of whole records.

    File names are new for every attempt of a task, and only what a finished task
    gives back is ever read, so an attempt that is lost or repeated does no harm.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(folder) if "://" in folder else (pafs.LocalFileSystem(), folder)
        store.create_dir(root, recursive=True)
        path, out, start, at, records = "", None, 0, 0, 0

        def stretch() -> pa.RecordBatch:
            where = folder.rstrip("/") + "/" + path.rsplit("/", 1)[1]
            return pa.RecordBatch.from_pydict({"path": [where], "start": [start], "end": [at], "records": [records]})

        for batch in batches:
            for row in (r for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist()):
                if out is None:
                    path = f"{root}/{uuid.uuid4().hex}.warc.gz"
                    out, start, at, records = store.open_output_stream(path, compression=None), 0, 0, 0
                    info = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<{uuid.uuid4().urn}>"), ("WARC-Date", date)]
                    written = [head([*info, ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")]
                else:
                    written = []
                for record in [*written, *capture_records(row, date)]:
                    member = zlib.compressobj(6, zlib.DEFLATED, 31)
                    records += 1
                    at += out.write(member.compress(record) + member.flush())
                if at - start >= slice_bytes or at >= archive_bytes:
                    yield stretch()
                    start, records = at, 0
                if at >= archive_bytes:
                    out.close()
                    out = None
        if out is not None:
            out.close()
            if at > start:
                yield stretch()

    return run


STRETCH = "path string, start long, end long, records long"


def write(
    pages: DataFrame,
    folder: str | None = None,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    archive_bytes: int = ARCHIVE_BYTES,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """Write three records for each row below `folder`, and return the written list of their stretches.

    Of rows with equal payloads the one of smallest id is a response (of these, that
    of the smallest url) and the others are revisits of it. A null html is an empty
    payload. Rows of equal id, url and payload are one capture, whose records are
    written once for each of them under the same ids. A null id sorts last; a null
    url has no WARC-Target-URI. Other columns are not read. `folder` must be open to
    Arrow's file systems on all executors; without one it lies in the work folder.
    """
    spark = pages.sparkSession
    folder = folder or work_folder(spark, "archives")
    payload = F.coalesce(F.col(html).cast("binary"), F.lit(b""))
    named = pages.select(F.col(page_id).alias("id"), F.col(url).cast("string").alias("url"), payload.alias("payload"))
    named = named.withColumn("digest", base32_sha1(F.col("payload")))
    order = F.struct(F.col("id").isNull().alias("last"), "id", F.col("url").isNull().alias("no_url"), "url")
    groups = named.groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("count"))
    own_id = record_id(F.lit("response"), F.col("id"), F.col("url"), F.col("digest"))
    first = F.struct(
        record_id(F.lit("response"), F.col("first.id"), F.col("first.url"), F.col("digest")).alias("record_id"),
        F.col("first.url").alias("url"),
    )
    repeated = staged(groups.filter("count > 1").select("digest", "count", first.alias("found")), "repeated")
    rows = named.withColumn("own_id", own_id)
    marked = attached(rows, repeated, "digest", _rows(pages))
    marked = marked.select(
        F.col("id").cast("string").alias("id"),
        "url",
        "payload",
        "digest",
        "own_id",
        record_id(F.lit("request"), F.col("own_id")).alias("request_id"),
        record_id(F.lit("metadata"), F.col("own_id")).alias("metadata_id"),
        F.when(F.col("found.record_id") != F.col("own_id"), F.col("found")).alias("found"),
    )
    share(spark, None)
    date = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    return staged(marked.mapInArrow(archiver(folder, date, archive_bytes, slice_bytes), STRETCH), "stretches")


def _rows(df: DataFrame) -> int:
    return df.select(F.lit(1)).count()


# ---- reading ----


class Plain:
    """The bytes of a file, from a place in it on."""

    def __init__(self, file: BinaryIO, start: int):
        file.seek(start)
        self.file, self.place = file, start

    def read(self) -> bytes:
        data = self.file.read(BLOCK)
        self.place += len(data)
        return data


class Members:
    """The inflated bytes of gzip members, one after the other."""

    def __init__(self, file: BinaryIO, start: int, path: str):
        file.seek(start)
        self.file, self.path, self.place, self.raw, self.inflate = file, path, start, b"", None

    def next(self) -> bool:
        """Go to the next member, which begins at `place`; False at the end of the file."""
        self.raw = self.raw or self.file.read(BLOCK)
        self.inflate = zlib.decompressobj(31)
        return bool(self.raw)

    def read(self) -> bytes:
        """The next bytes, at most BLOCK; none at the end of the member."""
        data = b""
        while not data and not self.inflate.eof:
            self.raw = self.raw or self.file.read(BLOCK)
            if not self.raw:
                raise ValueError(f"{self.path}: the last gzip member is cut off")
            before = len(self.raw)
            data = self.inflate.decompress(self.raw, BLOCK)
            self.raw = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
            self.place += before - len(self.raw)
        return data


class Records:
    """The records in the bytes of a source."""

    def __init__(self, source: Plain | Members, path: str):
        self.source, self.path, self.held = source, path, b""

    def more(self) -> bool:
        """Whether anything but line ends is left."""
        while not (held := self.held.lstrip(b"\r\n")):
            self.held = self.source.read()
            if not self.held:
                return False
        self.held = held
        return True

    def line_block(self) -> bytes:
        """Bytes up to and with an empty line."""
        while (cut := self.held.find(b"\r\n\r\n")) < 0:
            data = self.source.read()
            if not data:
                raise ValueError(f"{self.path}: a record's header is cut off")
            self.held += data
        block, self.held = self.held[: cut + 4], self.held[cut + 4 :]
        return block

    def body(self, length: int) -> Iterator[bytes]:
        while length > 0:
            data = self.held or self.source.read()
            if not data:
                raise ValueError(f"{self.path}: a record ends {length} bytes early")
            part, self.held = data[:length], data[length:]
            length -= len(part)
            yield part


def named_fields(lines: bytes) -> dict[str, list[str]]:
    """Header fields by lower-cased name; a line that begins with a blank goes on with the last."""
    found: dict[str, list[str]] = {}
    last = None
    for line in lines.decode("utf-8", "replace").split("\r\n"):
        if line[:1] in (" ", "\t") and last:
            found[last][-1] += f" {line.strip()}"
        elif ":" in line:
            last, _, value = line.partition(":")
            last = last.strip().lower()
            found.setdefault(last, []).append(value.strip())
    return found


def bare(value: str | None) -> str | None:
    return value.strip("<>") if value is not None else None


def read_record(records: Records, offset: int, payload: bool) -> dict:
    """The next record. The block is read in parts; a payload is kept on demand."""
    lines = records.line_block()
    if not lines.startswith(b"WARC/"):
        raise ValueError(f"{records.path}: no record at {offset}")
    fields = named_fields(lines)
    one: Callable[[str], str | None] = lambda name: fields.get(name, [None])[0]
    http = (one("content-type") or "").startswith("application/http")
    listed = (one("content-type") or "").startswith("application/warc-fields")
    before, digest, kept, size = b"", hashlib.sha1(usedforsecurity=False), io.BytesIO(), 0
    inside = not http
    for data in records.body(int(one("content-length") or 0)):
        if not inside:
            before += data
            cut = before.find(b"\r\n\r\n")
            if cut < 0:
                continue
            data, before, inside = before[cut + 4 :], before[: cut + 4], True
        size += len(data)
        digest.update(data)
        if payload or listed:
            kept.write(data)
    headers = named_fields(before)
    first_line = before.partition(b"\r\n")[0].decode("latin-1")
    status = first_line.split(" ")[1] if first_line.startswith("HTTP/") and " " in first_line else ""
    length = headers.get("content-length", [""])[0]
    declared = one("warc-payload-digest")
    return {
        "path": records.path,
        "offset": offset,
        "record_id": bare(one("warc-record-id")),
        "type": one("warc-type"),
        "date": one("warc-date"),
        "target_uri": one("warc-target-uri"),
        "concurrent_to": [bare(v) for v in fields.get("warc-concurrent-to", [])],
        "refers_to": bare(one("warc-refers-to")),
        "http_status": int(status) if status.isdigit() else None,
        "http_length": int(length) if length.isdigit() else None,
        "declared_digest": declared.rpartition(":")[2].upper() if declared else None,
        "payload_bytes": size,
        "payload_digest": base64.b32encode(digest.digest()).decode(),
        "fields": [(k, v[0]) for k, v in named_fields(kept.getvalue()).items()] if listed else [],
        "payload": kept.getvalue() if payload else None,
    }


# Columns of a record that was read; payload is null unless asked for.
RECORD = (
    "path string, offset long, record_id string, type string, date string, target_uri string, concurrent_to array<string>, "
    "refers_to string, http_status int, http_length long, declared_digest string, payload_bytes long, payload_digest string, "
    "fields map<string,string>, payload binary"
)
_ARROW = pa.schema(
    [
        ("path", pa.string()), ("offset", pa.int64()), ("record_id", pa.string()), ("type", pa.string()), ("date", pa.string()),
        ("target_uri", pa.string()), ("concurrent_to", pa.list_(pa.string())), ("refers_to", pa.string()),
        ("http_status", pa.int32()), ("http_length", pa.int64()), ("declared_digest", pa.string()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("fields", pa.map_(pa.string(), pa.string())), ("payload", pa.binary()),
    ]
)


def opened(path: str) -> BinaryIO:
    store, place = pafs.FileSystem.from_uri(path) if ":/" in path else (pafs.LocalFileSystem(), path)
    return store.open_input_file(place)


def stretch_records(path: str, start: int, end: int | None, payload: bool) -> Iterator[dict]:
    """All records of a file that begin at `start` or later and before `end`.

    The offset of a record in a gzip member is the member's, so several records may share one.
    """
    with opened(path) as file:
        if file.read(2) == b"\x1f\x8b":
            members = Members(file, start, path)
            while (end is None or members.place < end) and members.next():
                offset, records = members.place, Records(members, path)
                while records.more():
                    yield read_record(records, offset, payload)
        else:
            plain = Plain(file, start)
            records = Records(plain, path)
            while records.more():
                offset = plain.place - len(records.held)
                if end is not None and offset >= end:
                    return
                yield read_record(records, offset, payload)


def reader(payload: bool, batch_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                for record in stretch_records(row["path"], row["start"], row["end"], payload):
                    held.append(record)
                    size += 500 + len(record["payload"] or b"")
                    if size >= batch_bytes:
                        yield pa.RecordBatch.from_pylist(held, schema=_ARROW)
                        held, size = [], 0
        yield pa.RecordBatch.from_pylist(held, schema=_ARROW)

    return run


def read(stretches: DataFrame, payload: bool = False) -> DataFrame:
    """The records of the stretches (path, start, end; a null end is the file's), with the columns of RECORD.

    Payload sizes and digests are those of the bytes in the file. Of HTTP records the
    payload is what follows the HTTP header, of others the block. A record that ends
    early, or bytes that are no record, raise an error that names the file: nothing
    is left out silently. No stretches, no records.
    """
    share(stretches.sparkSession, None)
    # Rows are tiny and stand for megabytes each, so the number of tasks is fixed by their number.
    dealt = stretches.select("path", "start", "end").repartition(max(1, 2 * _rows(stretches)), "path", "start")
    return dealt.mapInArrow(reader(payload, 8 * BLOCK), RECORD)


def archives(spark: SparkSession, folder: str) -> DataFrame:
    """Every `.warc` and `.warc.gz` below a folder as one stretch; only names are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    files = files.filter(F.lower("path").rlike(r"\.warc(\.gz)?$"))
    return files.select("path", F.lit(0).cast("long").alias("start"), F.lit(None).cast("long").alias("end"))


# ---- assembly ----


def owners(records: DataFrame) -> DataFrame:
    """(id, owner): of every record that is no capture by itself the captures it belongs to, through concurrent-to.

    Either may name the other, directly or through a third record; a record that
    belongs to none is its own owner. Each round follows one more step and ends
    when no record is new.
    """
    is_capture = F.col("type").isin(*CAPTURES)
    aside = records.filter(~is_capture & (F.col("type") != "warcinfo")).select(F.col("record_id").alias("id")).distinct()
    named = records.select(F.col("record_id").alias("id"), is_capture.alias("capture"), F.explode("concurrent_to").alias("other"))
    captures = records.filter(is_capture).select(F.col("record_id").alias("owner")).distinct()
    direct = named.filter(~F.col("capture")).select("id", F.col("other").alias("owner")).join(captures, "owner", "left_semi")
    back = named.filter("capture").select(F.col("other").alias("id"), F.col("id").alias("owner")).join(aside, "id", "left_semi")
    known = staged(direct.select("id", "owner").union(back.select("id", "owner")).distinct(), "owners")
    while True:
        open_ones = staged(aside.join(known, "id", "left_anti"), "open")
        if open_ones.isEmpty():
            return known
        pairs = named.select("id", "other")
        pairs = pairs.union(pairs.select("other", "id")).toDF("id", "other").join(open_ones, "id", "left_semi")
        through = known.select(F.col("id").alias("other"), "owner")
        new = staged(pairs.join(through, "other").select("id", "owner").distinct(), "owners")
        if new.isEmpty():
            return known.union(open_ones.select("id", F.col("id").alias("owner")))
        known = staged(known.union(new), "owners")


def in_order(entries: Column) -> Column:
    """Records by file and offset."""

    def compare(a: Column, b: Column) -> Column:
        x, y = F.struct(a["path"], a["offset"]), F.struct(b["path"], b["offset"])
        return F.when(x < y, -1).when(x > y, 1).otherwise(0)

    return F.array_sort(entries, compare)


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: capture_id, target_uri, date, record, requests, metadata, refers_to, same_payload.

    `records` is a written table of `read`. `record` is the response, revisit or
    resource; `requests` and `metadata` are lists in order of file and offset. For a
    revisit `same_payload` is what it refers to, if that is present: size, digest and
    place of the payload, and the fields of that capture's metadata. Records written twice under one id count once, the
    first by file and offset. Records without capture give a row of their own with
    a null `record`. Records without id, and warcinfo, belong to no capture.
    """
    columns = [c for c in records.columns if c != "record_id"]
    whole = F.struct("path", "offset", *(c for c in columns if c not in ("path", "offset")))
    single = records.filter(F.col("record_id").isNotNull() & F.col("type").isNotNull()).groupBy("record_id")
    single = staged(single.agg(F.min_by(whole, F.struct("path", "offset")).alias("r")).select("record_id", "r.*"), "records")
    captures = single.filter(F.col("type").isin(*CAPTURES))
    entry = F.struct("path", "offset", "record_id", *(c for c in columns if c not in ("path", "offset")))
    aside = single.withColumn("entry", entry).select(F.col("record_id").alias("id"), "type", "entry")
    parts = owners(single).join(aside, "id").groupBy(F.col("owner").alias("capture_id")).agg(
        in_order(F.collect_list(F.when(F.col("type") == "request", F.col("entry")))).alias("requests"),
        in_order(F.collect_list(F.when(F.col("type") != "request", F.col("entry")))).alias("metadata"),
    )
    mains = captures.select(F.col("record_id").alias("capture_id"), entry.alias("record"))
    joined = mains.join(parts, "capture_id", "full")
    shown = F.coalesce("record", F.get("requests", F.lit(0)), F.get("metadata", F.lit(0)))
    joined = staged(
        joined.select(
            "capture_id",
            shown["target_uri"].alias("target_uri"),
            shown["date"].alias("date"),
            "record",
            F.coalesce("requests", F.array()).alias("requests"),
            F.coalesce("metadata", F.array()).alias("metadata"),
            F.col("record.refers_to").alias("refers_to"),
        ),
        "captures",
    )
    referred = joined.filter("refers_to IS NOT NULL").groupBy("refers_to").agg(F.count("*").alias("count"))
    meant = joined.filter("record IS NOT NULL").select(
        F.col("capture_id").alias("refers_to"),
        F.struct("record.payload_bytes", "record.payload_digest", "record.path", "record.offset", first_fields(F.col("metadata")).alias("fields")).alias("found"),
    )
    side = staged(referred.join(meant, "refers_to"), "referred")
    linked = attached(joined.withColumn("own_id", F.col("capture_id")), side, "refers_to", _rows(joined))
    return linked.withColumnRenamed("found", "same_payload").drop("own_id")


def payload_facts(captures: DataFrame) -> DataFrame:
    """`captures` with the size and digest of the full payload: a revisit's are those of the record it refers to.

    Where that record is not among the captures, the revisit's own headers are taken.
    """
    revisit = F.col("record.type") == "revisit"
    size = F.coalesce("same_payload.payload_bytes", "record.http_length")
    digest = F.coalesce("same_payload.payload_digest", "record.declared_digest")
    return captures.withColumns(
        {
            "payload_bytes": F.when(revisit, size).otherwise(F.col("record.payload_bytes")),
            "payload_digest": F.when(revisit, digest).otherwise(F.col("record.payload_digest")),
        }
    )


def first_fields(metadata: Column) -> Column:
    """The fields of the first metadata record as a map, or null."""
    return F.get(metadata, F.lit(0))["fields"]
