"""WARC archives as seekable Zstandard bundles.

A task writes the records it holds to bundles of its own: records are grouped into
independent frames, and a skippable frame at the end lists the frames' sizes and
checksums, so that a reader finds any frame by a seek and any Zstandard reader can read
the file from the start.  The index maps a record's id to its bundle, its frame and its
offset within the frame.

Records of equal payloads are found by digests alone, before any payload moves: rows
are grouped by digest and length with partial sums, and groups of several rows go back
to the rows by broadcast while their counted number is small, and else by a join in
which the largest groups, ten thousand at most, are still broadcast.

Bundles lie below ``spark.checkpoint.dir`` or a folder of the caller's, which has to be
one that ``pyarrow.fs`` opens.  A name holds the task attempt's own id, and only
bundles that the index names count, so what a lost attempt left behind is never read.

Defined cases: a null payload is empty; a null url has no target header; control
characters of a url are written in percent form; rows with a null id are never
referred to while their payload has a row with an id, and of those without any, all are responses; rows
that share the largest id of a payload are all responses; an empty table writes no
bundle; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minewright.staging import shared_dir, small_batches, stage, table

#: Fixed values of the seekable format: magic numbers of a skippable frame and of its footer.
_SKIPPABLE, _SEEKABLE = 0x184D2A5E, 0x8F92EAB1
#: Footer: number of frames, a descriptor whose highest bit says that there are checksums, magic number.
_FOOTER = struct.Struct("<IBI")
_ENTRY = struct.Struct("<III")

RECORD = "page_id long, record_id string, record_type string, bundle string, frame long, frame_start long, frame_bytes long, frame_size long, offset long, length long"
PAGE = "page_id long, url string, record_id string, record_type string, refers_to_record string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def _open_folder(folder: str):
    """A file system and the folder's path in it."""
    from pyarrow import fs

    if folder.startswith("file:"):
        return fs.LocalFileSystem(), re.sub(r"^file:/*", "/", folder)
    if folder.startswith("/"):
        return fs.LocalFileSystem(), folder
    return fs.FileSystem.from_uri(folder)


def record_id(page_id: int | None, digest: str) -> str:
    """The same for a page and payload whoever works it out, so that a revisit can name a record in another bundle."""
    return f"urn:uuid:{uuid.UUID(hashlib.md5(f'{page_id}/{digest}'.encode()).hexdigest())}"


def encode_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, is_revisit: bool, date: str) -> bytes:
    """A response with its payload, or a revisit with the headers of the response alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if is_revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if is_revisit else 'response'}", f"WARC-Record-ID: <{record_id(page_id, digest)}>", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    if is_revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{record_id(refers_to, digest)}>", f"X-Refers-To-Page-Id: {refers_to}"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def decode_records(data: memoryview) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """Offset, length, headers and block of each record."""
    at, raw = 0, bytes(data)
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at)
        head, *lines = raw[at:end].decode().split("\r\n")
        if not head.startswith("WARC/"):
            raise ValueError(f"no record at {at}")
        headers = dict(line.split(": ", 1) for line in lines)
        start, size = end + 4, int(headers["Content-Length"])
        if raw[start + size : start + size + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at {at} has another length than it says")
        yield at, start + size + 4 - at, headers, raw[start : start + size]
        at = start + size + 4


class BundleWriter:
    """Independent frames of some records each, and a table of them at the end."""

    def __init__(self, out, frame_bytes: int, level: int = 3):
        import zstandard

        self.out, self.frame_bytes, self.written, self.held, self.size = out, frame_bytes, 0, [], 0
        self.frames: list[tuple[int, int, int]] = []
        self.compress = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True).compress

    def add(self, record: bytes) -> tuple[int, int]:
        """The number of the record's frame and its offset within."""
        if self.held and self.size + len(record) > self.frame_bytes:
            self.flush()
        place = len(self.frames), self.size
        self.held.append(record)
        self.size += len(record)
        return place

    def flush(self) -> None:
        import xxhash

        if self.held:
            plain = b"".join(self.held)
            packed = self.compress(plain)
            self.out.write(packed)
            self.frames.append((len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
            self.written += len(packed)
            self.held, self.size = [], 0

    def close(self) -> None:
        self.flush()
        body = b"".join(_ENTRY.pack(*f) for f in self.frames) + _FOOTER.pack(len(self.frames), 0x80, _SEEKABLE)
        self.out.write(struct.pack("<II", _SKIPPABLE, len(body)) + body)
        self.out.close()


def seek_table(file) -> list[tuple[int, int, int, int]]:
    """Start, packed size, plain size and checksum of a bundle's frames, from its end alone."""
    size = file.size()
    file.seek(size - _FOOTER.size)
    n, descriptor, magic = _FOOTER.unpack(file.read(_FOOTER.size))
    if magic != _SEEKABLE or not descriptor & 0x80:
        raise ValueError("not a bundle with a table of frames and checksums")
    file.seek(size - _FOOTER.size - n * _ENTRY.size)
    out, at = [], 0
    for packed, plain, check in _ENTRY.iter_unpack(file.read(n * _ENTRY.size)):
        out.append((at, packed, plain, check))
        at += packed
    return out


def read_frame(file, start: int, packed: int, plain: int, check: int | None = None) -> bytes:
    import xxhash
    import zstandard

    file.seek(start)
    data = zstandard.ZstdDecompressor().decompress(file.read(packed), max_output_size=plain)
    if len(data) != plain or check is not None and xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != check:
        raise ValueError(f"the frame at {start} is damaged")
    return data


def _write(folder: str, frame_bytes: int, bundle_bytes: int, date: str):
    """Writes its rows to bundles and gives the index rows of each bundle once that is closed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _open_folder(folder)
        writer, index, name = None, [], ""

        def closed() -> pa.RecordBatch:
            writer.close()
            starts = [0]
            for packed, _, _ in writer.frames:
                starts.append(starts[-1] + packed)
            rows = [(*r[:3], name, r[3], starts[r[3]], *writer.frames[r[3]][:2], *r[4:]) for r in index]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=[f.split()[0] for f in RECORD.split(", ")]).cast(_schema(RECORD))

        for b in batches:
            for i in range(b.num_rows):
                page, url, payload, digest, refers, revisit = (b.column(c)[i].as_py() for c in ("page_id", "url", "payload", "digest", "refers_to", "revisit"))
                if writer is None:
                    name = f"pages-{uuid.uuid4().hex}.warc.zst"
                    writer, index = BundleWriter(files.open_output_stream(f"{base}/{name}", compression=None), frame_bytes), []
                record = encode_record(page, url, payload, digest, refers, revisit, date)
                frame, offset = writer.add(record)
                index.append((page, record_id(page, digest), "revisit" if revisit else "response", frame, offset, len(record)))
                if writer.written >= bundle_bytes:
                    yield closed()
                    writer = None
        if writer is not None:
            yield closed()

    return run


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(n, kinds[t]) for n, t in (f.split() for f in ddl.split(", "))])


#: Groups of equal payloads up to this number are broadcast, a hundred bytes each; of more, those with over ``HOT`` rows and a ten-thousandth of all.
FEW, HOT, SHARE = 100_000, 1000, 10_000


def with_originals(rows: DataFrame, least: int) -> DataFrame:
    """``rows`` (``page_id, bytes, sha`` and more) with ``refers_to``: the largest page_id of an equal payload of ``least`` bytes or more, where that is another's."""
    groups = rows.where(F.col("bytes") >= least).groupBy("sha", "bytes").agg(F.max("page_id").alias("_top"), F.count(F.lit(1)).alias("_n")).where("_n > 1 AND _top IS NOT NULL")
    groups = stage(groups, "warc-groups")
    n, total = groups.agg(F.count(F.lit(1)), F.coalesce(F.sum("_n"), F.lit(0))).first()
    known = groups.drop("_n")
    if n <= FEW:
        met = rows.join(F.broadcast(known), ["sha", "bytes"], "left")
    else:
        hot = F.broadcast(groups.where(F.col("_n") > max(HOT, total // SHARE)).drop("_n"))
        rest = rows.join(hot, ["sha", "bytes"], "left_anti").join(known, ["sha", "bytes"], "left")
        met = rows.join(hot, ["sha", "bytes"]).unionByName(rest)
    return met.withColumn("refers_to", F.expr("CASE WHEN NOT page_id <=> _top THEN _top END")).drop("_top")


def write_archives(pages: DataFrame, folder: str | None = None, least: int = 1000, frame_bytes: int = 1 << 20, bundle_bytes: int = 256 << 20, date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """Writes a record for each row of ``pages`` (``page_id, url, html``) and returns the index, a row each, staged.

    A record's bundle is the ``bundle`` column's file in ``folder``.  Payloads of ``least`` bytes or more are written once.
    """
    spark = pages.sparkSession
    small_batches(spark)
    folder = folder or f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    files, base = _open_folder(folder)
    files.create_dir(base, recursive=True)
    rows = pages.select("page_id", "url", F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("bytes", F.octet_length("payload").cast("long")).withColumn("sha", F.sha2("payload", 256))
    records = with_originals(rows, least).select("page_id", "url", "payload", F.sha1("payload").alias("digest"), "refers_to", F.col("refers_to").isNotNull().alias("revisit"))
    index = stage(records.mapInArrow(_write(folder, frame_bytes, bundle_bytes, date), RECORD), "warc-index")
    index._folder = folder
    return index


def _page(headers: dict[str, str], block: bytes) -> dict:
    """A record as a row; a response's digest is worked out anew and compared."""
    head, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?m)^Content-Length: (\d+)", head)[1])
    digest, revisit = headers["WARC-Payload-Digest"].removeprefix("sha1:"), headers["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"{headers['WARC-Record-ID']}: the payload is another than its digest says")
    number = lambda name: int(headers[name]) if name in headers else None
    return {
        "page_id": number("X-Page-Id"), "url": headers.get("WARC-Target-URI"), "record_id": headers["WARC-Record-ID"].strip("<>"), "record_type": headers["WARC-Type"],
        "refers_to_record": headers["WARC-Refers-To"].strip("<>") if revisit else None, "refers_to": number("X-Refers-To-Page-Id"),
        "payload_bytes": size, "payload_digest": digest, "payload": None if revisit else payload}


def _read(folder: str, whole: bool):
    """Records of frames (``bundle, start, packed, plain, check``), or of single places in them (``offset, length`` too)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _open_folder(folder)
        for b in batches:
            for r in b.to_pylist():
                with files.open_input_file(f"{base}/{r['bundle']}") as f:
                    data = read_frame(f, r["start"], r["packed"], r["plain"], r.get("check"))
                found = decode_records(memoryview(data)) if whole else (next(decode_records(memoryview(data)[p["offset"] : p["offset"] + p["length"]])) for p in r["places"])
                yield pa.RecordBatch.from_pylist([_page(headers, block) for _, _, headers, block in found], schema=_schema(PAGE))

    return run


def read_archives(bundles: DataFrame, folder: str) -> DataFrame:
    """All records of ``bundles`` (``bundle``): tables of frames are read first, and their frames dealt over all tasks."""

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _open_folder(folder)
        for b in batches:
            for name in b.column("bundle").to_pylist():
                with files.open_input_file(f"{base}/{name}") as f:
                    found = seek_table(f)
                yield pa.RecordBatch.from_pylist([{"bundle": name, "frame": i, "start": x[0], "packed": x[1], "plain": x[2], "check": x[3]} for i, x in enumerate(found)], schema=_schema("bundle string, frame long, start long, packed long, plain long, check long"))

    listed = bundles.select("bundle").repartition("bundle").mapInArrow(frames, "bundle string, frame long, start long, packed long, plain long, check long")
    return listed.repartition("bundle", "frame").mapInArrow(_read(folder, whole=True), PAGE)


def fetch_records(index: DataFrame, folder: str, wanted: DataFrame) -> DataFrame:
    """Records of the index by ``wanted`` (``record_id``): each frame that has some is read once, at its place."""
    near = index.join(wanted.select("record_id").distinct(), "record_id", "left_semi")
    by_frame = near.groupBy("bundle", F.col("frame_start").alias("start"), F.col("frame_bytes").alias("packed"), F.col("frame_size").alias("plain")).agg(F.collect_list(F.struct("offset", "length")).alias("places"))
    return by_frame.mapInArrow(_read(folder, whole=False), PAGE)


OP13_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest, max(page_id) OVER (PARTITION BY body) AS top FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM top THEN top END AS refers_to FROM d"""


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = write_archives(table(spark, sf_dir, "pages"))
    read = read_archives(index.select("bundle").distinct(), index._folder)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
