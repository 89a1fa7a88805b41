"""WARC archives, written with repeats as revisits and read back by byte ranges.

**Writing.** Every row becomes one record, a gzip member of its own, of a ``.warc.gz`` file; a shuffle partition is a file. Of
rows with equal payloads that with the smallest id is the ``response``, the others are ``revisit`` records that carry headers
only. A file is written under a passing name and renamed when it is whole, its name and its bytes hang on its partition's rows
alone, and the manifest (``_manifest``, Parquet) names the files of the job that was committed. So a task that is lost or runs
twice leaves one file.

**Reading.** Files are cut into byte ranges without a look at record bounds. A task scans its range for the gzip magic number,
takes a candidate for a member only if it inflates to a WARC header, and owns the records that *start* in its range, which it
reads to their end. A payload may itself hold a stored archive, whose members look real to a task that starts inside it; so all
ranges first report where their first record starts and where their last one ends, and ranges that their predecessor's end
contradicts walk again from there, until every file is one unbroken chain. Bytes that are no member (damage) are skipped up to
the next candidate. A whole member whose payload does not match the digest in its header is refused.

Defined results: a null payload is empty; rows with the same id and payload are responses alike where the id is the smallest;
null ids are larger than all others, and a group of null ids only has responses only; an empty table gives a manifest without files and reads as no rows;
other columns are dropped. Payloads below ``least`` bytes are always responses.

Files are opened with ``pyarrow.fs`` (local and mounted folders, HDFS, object stores); ranges are listed by Spark.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import join_groups, shared_table, slices

MAGIC = b"\x1f\x8b\x08"
#: Bytes of a range, of one read, and of one inflated piece.
SPLIT_BYTES, READ_BYTES, PIECE_BYTES = 32 << 20, 1 << 20, 1 << 20
#: Tasks that ranges are dealt to; more ranges share tasks.
MOST_TASKS = 20_000
#: A header block beyond this is no WARC header.
MOST_HEADER = 1 << 20
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID = re.compile(rb"<urn:page:(-?\d*)>")
RECORDS_DDL = ("path string, offset long, page_id long, url string, record_type string, refers_to long, payload_bytes long, "
               "payload_digest string, payload binary")
RECORDS = pa.schema([("path", pa.string()), ("offset", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()),
                     ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()),
                     ("payload_digest", pa.string()), ("payload", pa.binary())])
#: Bytes of payloads in one batch that a reading task returns (or one record).
BATCH_BYTES = 4 << 20


def base32_sha1(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def record(page_id: int | None, url: str | None, payload: bytes | None, first: int | None, revisit: bool, n_bytes: int,
           digest: str, date: str = DATE) -> bytes:
    """One gzip member: a response with its payload, or a revisit with the response's HTTP header only."""
    name = "" if page_id is None else str(page_id)
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n").encode()
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{name}>",
             f"WARC-Date: {date}", f"WARC-Target-URI: {quote(url or f'urn:page:{name}', safe=SAFE)}",
             "Content-Type: application/http;msgtype=response", f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{first}>"]
    block = http if revisit else http + (payload or b"")
    lines += [f"Content-Length: {len(block)}", "", ""]
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n") + pack.flush()


#: Characters that stay as they are in an address; blanks, controls and all beyond ASCII are escaped.
SAFE = "!#$%&'()*+,/:;=?@[]~-._"


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub("^file:/+", "/", path))


def roles(pages: DataFrame, least: int = 0, id_col: str = "page_id", url_col: str = "url", text_col: str = "html") -> DataFrame:
    """page_id, url, payload, n_bytes, sha1 (hex), first (smallest id of its equals) and revisit of every row.

    Only hashes are grouped; the payloads are shuffled once, by their hash, but for hot groups, whose rows are spread.
    """
    text = F.col(f"`{text_col}`")
    payload = F.coalesce(F.encode(text, "UTF-8") if dict(pages.dtypes)[text_col] == "string" else text.cast("binary"), F.lit(b""))
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                        payload.alias("payload")) \
        .withColumn("n_bytes", F.octet_length("payload").cast("long")).withColumn("key", F.sha2("payload", 256))
    groups = shared_table(rows.groupBy("key").agg(F.count("*").alias("n"), F.min("page_id").alias("first")), "payloads")
    total = groups.agg(F.sum("n")).first()[0] or 0
    return join_groups(rows, groups.where("n > 1"), "key", total).select(
        "page_id", "url", "payload", "n_bytes", F.sha1("payload").alias("sha1"), "first",
        (F.coalesce(F.col("page_id") != F.col("first"), F.col("first").isNotNull()) & (F.col("n_bytes") >= least)).alias("revisit"))


def write(pages: DataFrame, path: str, least: int = 0, id_col: str = "page_id", url_col: str = "url", text_col: str = "html",
          date: str = DATE) -> None:
    """One record for each row in ``.warc.gz`` files under ``path``, and their manifest."""

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = _open(path)
        context = TaskContext.get()
        name = f"{folder}/part-{context.partitionId():06d}.warc.gz"
        passing, out, records, size = f"{name}.{uuid.uuid4().hex}", None, 0, 0
        for batch in batches:
            for row in (row for part in slices(batch, 2) for row in part.to_pylist()):
                if out is None:
                    store.create_dir(folder, recursive=True)
                    out = store.open_output_stream(passing, compression=None)
                member = record(row["page_id"], row["url"], row["payload"], row["first"], row["revisit"], row["n_bytes"],
                                base32_sha1(bytes.fromhex(row["sha1"])), date)
                out.write(member)
                records, size = records + 1, size + len(member)
        if out is not None:
            out.close()
            store.move(passing, name)
            yield pa.RecordBatch.from_pydict({"file": [name.rsplit("/", 1)[1]], "records": [records], "bytes": [size]})

    rows = roles(pages, least, id_col, url_col, text_col).sortWithinPartitions("page_id", "sha1", "url")
    rows.mapInArrow(files, "file string, records long, bytes long").write.parquet(f"{path.rstrip('/')}/_manifest")


def ranges(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """path, start, stop of every byte range of the archives under ``path`` (a folder that ``write`` made, or any other).

    Where there is a manifest only its files count; lengths come from Spark's own listing, which reads no content.
    """
    path = path.rstrip("/")
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(path).select("path", "length")
    try:
        manifest = spark.read.parquet(f"{path}/_manifest").select("file")
    except Exception as problem:
        if "PATH_NOT_FOUND" not in str(problem):
            raise
        manifest = None
    if manifest is not None:
        listed = listed.withColumn("file", F.element_at(F.split("path", "/"), -1)).join(manifest, "file", "left_semi")
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(split_bytes).cast("long")))
    return listed.where("length > 0").select("path", "length", starts.alias("start")) \
        .select("path", "start", F.least(F.col("start") + split_bytes, "length").alias("stop"))


class _Bytes:
    """Reads of one file at any place, a piece at a time."""

    def __init__(self, path: str):
        store, name = _open(path)
        self.file = store.open_input_file(name)
        self.size, self.at, self.piece = self.file.size(), 0, b""

    def read(self, place: int) -> bytes:
        """Some bytes from ``place`` on; none at the end of the file."""
        if not self.at <= place < self.at + len(self.piece):
            self.at, self.piece = place, self.file.read_at(min(READ_BYTES, max(0, self.size - place)), place)
        return self.piece[place - self.at:]

    def find(self, place: int, stop: int) -> int | None:
        """First place of the magic number that starts from ``place`` on and before ``stop``."""
        tail, at = b"", place
        while at - len(tail) < stop and (piece := self.read(at)):
            hit = (tail + piece).find(MAGIC)
            if hit >= 0:
                return at - len(tail) + hit if at - len(tail) + hit < stop else None
            at, tail = at + len(piece), (tail + piece)[-2:]
        return None


def inflate(source: _Bytes, place: int, ends: list[int]) -> Iterator[bytes]:
    """Pieces of the member at ``place``; its end goes to ``ends`` when it is whole. Raises zlib.error at damage."""
    pull, at = zlib.decompressobj(31), place
    while not pull.eof:
        piece = pull.unconsumed_tail or source.read(at)
        if not piece:
            raise zlib.error("the file ends within a member")
        if not pull.unconsumed_tail:
            at += len(piece)
        yield pull.decompress(piece, PIECE_BYTES)
    ends.append(at - len(pull.unused_data))


def header_of(source: _Bytes, place: int) -> bytes | None:
    """The WARC header at ``place``, or None if there is none."""
    held = b""
    try:
        for piece in inflate(source, place, []):
            held += piece
            if not held.startswith(b"WARC/"[:len(held)]):
                return None
            if b"\r\n\r\n" in held:
                return held[:held.index(b"\r\n\r\n")]
            if len(held) > MOST_HEADER:
                return None
    except zlib.error:
        return None
    return None


def scan(source: _Bytes, place: int, stop: int) -> int | None:
    """Start of the first valid member that starts from ``place`` on and before ``stop``."""
    while (place := source.find(place, stop)) is not None:
        if header_of(source, place) is not None:
            return place
        place += 1
    return None


def walk(source: _Bytes, place: int | None, stop: int, take=None) -> Iterator[tuple[int, object]]:
    """(end, what ``take`` made of the pieces) of each member from ``place`` on that starts before ``stop``."""
    while place is not None and place < stop:
        ends: list[int] = []
        try:
            made = take(place, inflate(source, place, ends)) if take else sum(1 for _ in inflate(source, place, ends))
        except zlib.error:
            made = None
        if ends:
            yield ends[0], made
            if source.read(ends[0])[:3] == MAGIC:
                place = ends[0]
                continue
        place = scan(source, ends[0] if ends else place + 1, stop)


def _dealt(rows: DataFrame) -> DataFrame:
    """Ranges dealt one by one: a row of a few bytes stands for much work, so partitions are counted, not left to row sizes."""
    return rows.repartition(max(1, min(rows.count(), MOST_TASKS)))


def chain(table: DataFrame) -> DataFrame:
    """path, start, stop, first, after: where the first record owned by a range starts, and where its last one ends.

    Both are null where no record starts inside. Ranges that disagree with their predecessors walk again.
    """
    ddl = "path string, start long, stop long, first long, after long"

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                source = _Bytes(row["path"])
                expected, start, stop = row["expected"], row["start"], row["stop"]
                first = scan(source, start if expected is None else expected, stop)
                after = None
                for after, _ in walk(source, first, stop):
                    pass
                yield pa.RecordBatch.from_pylist([{"path": row["path"], "start": start, "stop": stop, "first": first, "after": after}],
                                                 pa.schema([("path", pa.string()), *[(c, pa.int64()) for c in ("start", "stop", "first", "after")]]))

    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    known = shared_table(_dealt(table.withColumn("expected", F.lit(None).cast("long"))).mapInArrow(ends, ddl), "chain")
    while True:
        checked = known.withColumn("came", F.max("after").over(before))
        wrong = checked.where("came > start AND (first < came)")
        if wrong.isEmpty():
            return known
        again = shared_table(_dealt(wrong.select("path", "start", "stop", F.col("came").alias("expected"))).mapInArrow(ends, ddl), "again")
        known = shared_table(known.join(again.select("path", "start"), ["path", "start"], "left_anti").unionByName(again), "chain")


def _fields(header: bytes) -> dict[bytes, bytes]:
    pairs = (line.partition(b":") for line in header.split(b"\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def _taker(path: str, whole: bool):
    """Turns the pieces of a member into a row of RECORDS; without ``whole`` a payload is hashed and let go."""

    def take(place: int, pieces: Iterator[bytes]) -> dict | None:
        held = b""
        for piece in pieces:
            held += piece
            if b"\r\n\r\n" in held:
                break
        header, _, held = held.partition(b"\r\n\r\n")
        fields = _fields(header)
        kind = fields.get(b"warc-type", b"").decode()
        left = int(fields.get(b"content-length", b"0"))
        http, sha, kept, size = None, hashlib.sha1(), [], 0
        block = held[:left]
        left -= len(block)
        while True:
            if http is None and kind in ("response", "revisit") and b"\r\n\r\n" in block:
                top, _, block = block.partition(b"\r\n\r\n")
                http = _fields(top)
            if http is not None or kind not in ("response", "revisit"):
                sha.update(block)
                size += len(block)
                if whole:
                    kept.append(block)
                block = b""
            if not left:
                break
            piece = next(pieces, b"")
            if not piece:
                break
            block += piece[:left]
            left -= len(piece[:left])
        for _ in pieces:  # to the member's end, where its checksum is
            pass
        if http is None and kind == "response":  # no HTTP header: the block is the payload
            sha.update(block)
            size, kept = len(block), [block]
        if kind not in ("response", "revisit"):
            return None
        said = fields.get(b"warc-payload-digest", b"").decode().rpartition(":")[2]
        own = base32_sha1(sha.digest())
        if kind == "response" and said and said != own:
            raise ValueError(f"{path} at {place}: the payload's digest is {own}, its header says {said}")
        name, refers = ID.search(fields.get(b"warc-record-id", b"")), ID.search(fields.get(b"warc-refers-to", b""))
        return {"path": path, "offset": place, "page_id": int(name[1]) if name and name[1] else None,
                "url": fields.get(b"warc-target-uri", b"").decode(errors="replace"), "record_type": kind,
                "refers_to": int(refers[1]) if refers and refers[1] else None,
                "payload_bytes": size if kind == "response" else int((http or {}).get(b"content-length", b"0")),
                "payload_digest": own if kind == "response" else said, "payload": b"".join(kept) if whole and kind == "response" else None}

    return take


def read(spark: SparkSession, path: str, payload: bool = True, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The response and revisit records of all archives under ``path``; with ``payload`` false that column stays null and no
    payload is ever held whole."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                source, take = _Bytes(row["path"]), _taker(row["path"], payload)
                out, held = [], 0
                for _, made in walk(source, row["first"], row["stop"], take):
                    if made:
                        out.append(made)
                        held += 200 + len(made["payload"] or b"")
                    if held > BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(out, RECORDS)
                        out, held = [], 0
                if out:
                    yield pa.RecordBatch.from_pylist(out, RECORDS)

    owned = chain(ranges(spark, path, split_bytes)).where("first IS NOT NULL").select("path", "start", "stop", "first")
    return _dealt(owned).mapInArrow(records, RECORDS_DDL)


def digest(pages: DataFrame, path: str) -> DataFrame:
    """Write ``pages`` under ``path`` and give what the archives say about each of them."""
    write(pages, path)
    return read(pages.sparkSession, path, payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: The same rows in DuckDB, from the payloads instead of archives.
SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
h AS (SELECT page_id, octet_length(b) AS payload_bytes, sha1(b) AS s, min(page_id) OVER (PARTITION BY sha256(b)) AS first FROM p)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i:
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[
           ((('0x' || s[(i * 5 // 20) * 5 + 1:(i * 5 // 20) * 5 + 5])::BIGINT >> (15 - (i * 5) % 20)) & 31) + 1]), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM h
"""
