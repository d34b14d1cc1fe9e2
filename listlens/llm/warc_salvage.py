"""WARC archives: a writer, and a reader that salvages damaged files.

The writer puts a gzip member per record into files of bounded size. Names hold the task attempt, and only files
that a finished attempt reported are in the manifest, so tasks that are run again leave nothing behind. Of
records with equal payloads (from ``least_bytes`` on) one is a response, the others revisit it: who revisits
whom is found on digests, and one shuffle by record brings that to the payloads.

The reader streams each file. A record must pass all checks: the gzip member's checksum and length, version
line, needed headers, block length and end, block and payload digest. After a failed check it searches for the
next place where a member (gzip magic) or a version line begins and all checks pass, goes on from there, and
logs the bytes in between as a quarantined gap. Memory holds one record.

Defined cases: a null payload is empty; null URLs are left out; a null record key is the key of a record without
one, and such records come before all keys; rows that repeat key and payload are each written as the same kind
of record; empty tables give an archive without files; a file without a valid record is one gap. An intact record
inside the payload of a damaged uncompressed record is recovered like any other.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import quote, unquote

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listlens.llm import shared

VERSION = b"WARC/1.1"
MAGIC = b"\x1f\x8b\x08"
#: A file is closed at the first record that ends beyond this many bytes.
FILE_BYTES = 32 << 20
READ_BYTES = 1 << 20
INFLATE_BYTES = 1 << 14
_KEY = "urn:x-record:"
_DATE = "2000-01-01T00:00:00Z"  # archives of the same rows are the same bytes


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# --- records ---


def _key_uri(key: str | None) -> str:
    return f"<{_KEY}{'null' if key is None else 'k' + quote(key, safe='')}>"


def _key_of(uri: str) -> str | None:
    name = uri.strip("<>").removeprefix(_KEY)
    return unquote(name[1:]) if name.startswith("k") else None


def record_bytes(key: str | None, url: str | None, payload: bytes, refers_to: str | None, revisit: bool) -> bytes:
    """One WARC record; a revisit has the HTTP head but not the payload."""
    digest = "sha1:" + sha1_base32(payload)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _key_uri(key)), ("WARC-Date", _DATE),
        ("WARC-Target-URI", None if url is None else quote(url, safe="/:?&=#%+,;@!$'()*[]~")),
        ("WARC-Refers-To", _key_uri(refers_to) if revisit else None),
        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if revisit else None),
        ("WARC-Payload-Digest", digest), ("WARC-Block-Digest", "sha1:" + sha1_base32(block)),
        ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block))),
    ]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head if v is not None)
    return VERSION + b"\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


class Damaged(Exception):
    """A check failed."""


def parse_head(data: bytes) -> tuple[dict[str, str], int]:
    """Headers by lower-case name, and where the block begins."""
    end = data.find(b"\r\n\r\n")
    if not re.match(rb"WARC/\d+\.\d+\r\n", data):
        raise Damaged("version line")
    if end < 0:
        raise Damaged("headers not ended")
    head: dict[str, str] = {}
    for line in data[:end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("header line")
        head[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
    if not all(k in head for k in ("warc-type", "warc-record-id", "content-length")) or not head["content-length"].isdigit():
        raise Damaged("needed header missing")
    return head, end + 4


def check_record(data: bytes) -> dict:
    """The record that ``data`` is, exactly; raises Damaged."""
    head, at = parse_head(data)
    size = int(head["content-length"])
    block = data[at : at + size]
    if len(block) < size or data[at + size :] != b"\r\n\r\n":
        raise Damaged("block length")
    if "warc-block-digest" in head and head["warc-block-digest"] != "sha1:" + sha1_base32(block):
        raise Damaged("block digest")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", http)
    revisit = head["warc-type"] == "revisit"
    digest = head.get("warc-payload-digest", "").removeprefix("sha1:")
    if not revisit:
        found = sha1_base32(payload)
        if digest and digest != found:
            raise Damaged("payload digest")
        digest = found
    return {
        "record_type": head["warc-type"], "record_key": _key_of(head["warc-record-id"]), "url": head.get("warc-target-uri"),
        "refers_to": _key_of(head["warc-refers-to"]) if "warc-refers-to" in head else None, "payload_digest": digest,
        "payload_bytes": int(length[1]) if revisit and length else len(payload), "payload": None if revisit else payload,
    }


# --- reading ---


class _Window:
    """The bytes of a stream from some offset on, as far as they were asked for."""

    def __init__(self, stream: BinaryIO) -> None:
        self.stream, self.start, self.data, self.ended = stream, 0, bytearray(), False

    def more(self) -> bool:
        got = b"" if self.ended else self.stream.read(READ_BYTES)
        self.ended = not got
        self.data += got
        return bool(got)

    def drop(self, n: int) -> None:
        del self.data[:n]
        self.start += n


def _gzip_record(window: _Window) -> tuple[dict, int]:
    """The record that the member at the window's start holds, and the member's length."""
    z, out, at = zlib.decompressobj(31), [], 0
    while not z.eof:
        if at >= len(window.data) and not window.more():
            raise Damaged("member cut off" if window.data else "end of file")
        piece = bytes(window.data[at : at + INFLATE_BYTES])
        at += len(piece)
        try:
            out.append(z.decompress(piece))
        except zlib.error as e:
            raise Damaged("gzip member") from e
    return check_record(b"".join(out)), at - len(z.unused_data)


def _plain_record(window: _Window) -> tuple[dict, int]:
    while (end := window.data.find(b"\r\n\r\n")) < 0 or not window.data:
        if len(window.data) > 64 and not window.data.startswith(b"WARC/") or len(window.data) > 1 << 20 or not window.more():
            raise Damaged("version line")
    head, at = parse_head(bytes(window.data[: end + 4]))
    size = at + int(head["content-length"]) + 4
    while len(window.data) < size:
        if not window.more():
            raise Damaged("record cut off")
    return check_record(bytes(window.data[:size])), size


def salvage(stream: BinaryIO, zipped: bool) -> Iterator[dict]:
    """Records and gaps of a file in order, each with kind, offset and length."""
    window, read = _Window(stream), _gzip_record if zipped else _plain_record
    mark = MAGIC if zipped else b"WARC/"
    gap, reason = -1, ""
    while window.data or window.more():
        if window.data.startswith(mark) or len(window.data) < len(mark) and window.more() and window.data.startswith(mark):
            try:
                record, length = read(window)
            except Damaged as e:
                why = str(e)
            else:
                if gap >= 0:
                    yield {"kind": "gap", "offset": gap, "length": window.start - gap, "reason": reason}
                    gap = -1
                yield {"kind": "record", "offset": window.start, "length": length, "reason": None, **record}
                window.drop(length)
                continue
        else:
            why = "no member or version line"
        if gap < 0:
            gap, reason = window.start, why
        start = 1
        while (at := window.data.find(mark, start)) < 0:
            window.drop(max(start, len(window.data) - len(mark) + 1))
            start = 0
            if not window.more():
                window.drop(len(window.data))
                break
        else:
            window.drop(at)
    if gap >= 0:
        yield {"kind": "gap", "offset": gap, "length": window.start - gap, "reason": reason}


READ_SCHEMA = (
    "file string, kind string, offset long, length long, reason string, record_type string, record_key string, url string, "
    "refers_to string, payload_digest string, payload_bytes long, payload binary"
)
_FIELDS = [f.split()[0] for f in READ_SCHEMA.split(", ")]


def read_archives(files: DataFrame, payloads: bool = True) -> DataFrame:
    """Records and gaps of the files named in column ``file`` (URIs), one task per file or few."""

    def read(batches):
        from pyarrow import fs

        for pdf in batches:
            for uri in pdf["file"]:
                store, path = fs.FileSystem.from_uri(_uri(uri))
                rows, held = [], 0
                with store.open_input_stream(path, compression=None) as f:
                    for x in salvage(f, path.endswith(".gz")):
                        if not payloads:
                            x["payload"] = None
                        rows.append({"file": uri, **x})
                        held += len(x.get("payload") or b"") + 200
                        if held > 8 << 20:
                            yield _frame(rows)
                            rows, held = [], 0
                if rows:
                    yield _frame(rows)

    return files.select("file").mapInPandas(read, READ_SCHEMA)


def _frame(rows: list[dict]) -> pd.DataFrame:
    return pd.DataFrame({f: pd.Series([r.get(f) for r in rows], dtype=object) for f in _FIELDS})


def files_below(spark: SparkSession, folder: str) -> DataFrame:
    """The archives of a folder by name, listed by Spark without reading them."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.warc*").load(folder).select(F.col("path").alias("file"))


# --- writing ---


def with_revisits(pages: DataFrame, key: str, payload: str, least_bytes: int = 0) -> DataFrame:
    """Adds ``revisit`` and ``refers_to``: among equal payloads the largest key is the one referred to.

    A table that has columns of these names already is refused.
    """
    if {"revisit", "refers_to"} & set(pages.columns):
        raise ValueError("the table already has a column revisit or refers_to")
    body = F.coalesce(pages[payload].cast("binary"), F.lit(b""))
    rows = pages.withColumn("__digest", F.sha2(body, 256)).withColumn("__key", shared.id_key(F.col(key)))
    small = rows.select("__key", "__digest", F.col(key).alias("__id"), F.length(body).alias("__n")).distinct()
    winners = small.where(F.col("__n") >= least_bytes).groupBy("__digest").agg(
        F.max(F.struct(F.col("__id").isNotNull(), "__id", "__key")).alias("__w"), F.count("*").alias("__size")
    ).where("__size > 1")
    losers = small.join(winners, "__digest").where("__key != __w.__key").select("__digest", "__key", F.col("__w.__id").alias("refers_to"), F.lit(True).alias("revisit"))
    return rows.join(losers, ["__digest", "__key"], "left").select(*[rows[c] for c in pages.columns], F.coalesce("revisit", F.lit(False)).alias("revisit"), "refers_to")


def write_archives(records: DataFrame, folder: str, key: str, payload: str, url: str | None = None, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the rows (with ``revisit`` and ``refers_to``) below ``folder``; returns the manifest (file, records, bytes).

    ``folder`` is a URI that all executors reach.
    """

    def write(batches):
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        task, out, name, done, at, n = TaskContext.get(), None, "", [], 0, 0
        for pdf in batches:
            for k, u, body, ref, revisit in zip(pdf["k"], pdf["u"], pdf["body"], pdf["ref"], pdf["revisit"]):
                if out is None:
                    name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{len(done):04d}.warc.gz"
                    out, at, n = store.open_output_stream(f"{base}/{name}", compression=None), 0, 0
                member = gzip_member(record_bytes(k, u, bytes(body), ref, bool(revisit)))
                out.write(member)
                at, n = at + len(member), n + 1
                if at >= file_bytes:
                    out.close()
                    done.append((f"{folder}/{name}", n, at))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", n, at))
        yield pd.DataFrame(done, columns=["file", "records", "bytes"], dtype=object)

    rows = records.select(
        F.col(key).cast("string").alias("k"), (F.col(url).cast("string") if url else F.lit(None).cast("string")).alias("u"),
        F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("body"), F.col("refers_to").cast("string").alias("ref"), "revisit",
    )
    return shared.cut(rows.mapInPandas(write, "file string, records long, bytes long"))


def _uri(folder: str) -> str:
    return folder if "://" in folder else "file://" + folder.removeprefix("file:")


def round_trip(pages: DataFrame, key: str = "page_id", payload: str = "html", url: str | None = "url", least_bytes: int = 0) -> DataFrame:
    """Write all pages, read the archives back, and remove them; records and gaps without their payloads.

    Only the named columns are read, so others may have any names.
    """
    from pyarrow import fs

    spark = pages.sparkSession
    folder = _uri(shared.work_folder(spark))
    named = pages.select(F.col(key).alias("page"), F.col(payload).alias("body"), (F.col(url).cast("string") if url else F.lit(None).cast("string")).alias("address"))
    manifest = write_archives(with_revisits(named, "page", "body", least_bytes), folder, "page", "body", "address")
    files = manifest.repartition(max(1, manifest.count()))
    found = shared.store(read_archives(files, payloads=False).drop("payload"))
    store, base = fs.FileSystem.from_uri(folder)
    if store.get_file_info(base).type != fs.FileType.NotFound:
        store.delete_dir(base)
    return found


def op2(pages: DataFrame) -> DataFrame:
    kind = pages.schema["page_id"].dataType
    found = round_trip(pages).where("kind = 'record'")
    return found.select(
        F.col("record_key").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )


SQL_OP2 = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
w AS (SELECT page_id, octet_length(encode(body)) AS payload_bytes, sha1(body) AS h, max(page_id) OVER (PARTITION BY body) AS top FROM p),
bits AS (
  SELECT page_id, string_agg(
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> 15) & 31) + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> 10) & 31) + 1, 1)
    || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> 5) & 31) + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v & 31) + 1, 1), '' ORDER BY i) AS payload_digest
  FROM (SELECT page_id, i, CAST('0x' || substr(h, CAST(5 * i + 1 AS BIGINT), 5) AS INTEGER) AS v FROM w, range(8) AS r(i)) GROUP BY page_id
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM w JOIN bits USING (page_id)
"""
