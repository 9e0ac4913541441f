"""WARC archives with a two-level capture index.

Archives hold one gzip member for each record. Index lines, keyed by the URL with its host reversed, are sorted over
the whole collection and cut into compressed blocks; each index file ends with a sparse directory of its blocks (first
key, offset, length), and the list of index files with their first keys is the level above. A lookup searches the
files, then the directory, then the block by halves, and reads only a range of the archive. Whole tables are looked up in
the order of their keys, so a task reads each block once, and ranges are read archive by archive in order of place.
Of records with equal payloads one holds the payload; the others are revisits that refer to it.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import re
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm._common import cut, put_file, read_range, steps, store, task_name

ARCHIVE_BYTES, BLOCK_LINES, SALTS = 16 << 20, 256, 32
TAIL = 12  # offset (8 bytes) and length (4) of the directory, at an index file's end
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def sort_key(url: str | None) -> str:
    """The URL with its host reversed, without scheme and fragment: com,example,www)/path?query."""
    m = re.match(r"(?s)^.*?://([^/?#]*)([^#]*)", url or "")
    if not m:
        return f"){(url or '').partition('#')[0]}"
    host, _, port = m[1].rpartition("@")[2].lower().partition(":")
    return ",".join(reversed(host.split("."))) + (f":{port}" if port else "") + ")" + (m[2] or "/")


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def line_safe(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, refers_url: str | None = None) -> bytes:
    """A response, or a revisit if it refers to another page: then the payload itself stays out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}", f"WARC-Target-URI: {line_safe(url or '')}",
        f"WARC-Payload-Digest: sha1:{digest_of(payload)}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Refers-To-Target-URI: {line_safe(refers_url or '')}", f"WARC-Refers-To-Date: {DATE}", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


def parse(data: bytes) -> dict:
    """A record from its gzip member; the digest of a response is computed from its payload and must be the one stated."""
    head, _, rest = zlib.decompress(data, 31).partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("no WARC record")
    of = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    block = rest[: int(of["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = of["WARC-Payload-Digest"].removeprefix("sha1:")
    length = int(re.search(rb"(?i)content-length: (\d+)", http)[1])
    if of["WARC-Type"] == "response" and (digest_of(payload) != stated or len(payload) != length):
        raise ValueError(f"damaged payload in {of['WARC-Record-ID']}")
    page = lambda x: int(x[len("<urn:page:") : -1]) if x and x != "<urn:page:>" else None
    return {"page_id": page(of["WARC-Record-ID"]), "url": of["WARC-Target-URI"], "record_type": of["WARC-Type"], "payload_bytes": length, "payload_digest": stated, "refers_to": page(of.get("WARC-Refers-To")), "payload": payload if of["WARC-Type"] == "response" else None}


def referred(pages: DataFrame, id_col: str, payload: Column, least_bytes: int = 0) -> DataFrame:
    """pages with refers_to and refers_url: the largest id of those with the same payload and its url, null for that one itself and for payloads under least_bytes.

    A payload that a third of all rows share is counted by salted parts first, so no task joins all of its rows.
    """
    salted = pages.withColumns({"__digest": F.concat(F.sha1(payload), F.lpad(F.length(payload).cast("string"), 12, "0")), "__salt": F.pmod(F.xxhash64(F.col(id_col)), F.lit(SALTS))})
    parts = salted.groupBy("__digest", "__salt").agg(F.max(F.struct(id_col, "url")).alias("__most"))
    whole = parts.groupBy("__digest").agg(F.max("__most").alias("__most")).select("__digest", F.col(f"__most.{id_col}").alias("__holder"), F.col("__most.url").alias("__holder_url"))
    holders = parts.select("__digest", "__salt").join(whole, "__digest")
    other = ((F.col("__holder") != F.col(id_col)) | F.col(id_col).isNull()) & (F.length(payload) >= least_bytes) & F.col("__holder").isNotNull()
    found = salted.join(holders, ["__digest", "__salt"]).withColumns({"refers_to": F.when(other, F.col("__holder")), "refers_url": F.when(other, F.col("__holder_url"))})
    return found.drop("__digest", "__salt", "__holder", "__holder_url")


def write_archives(spark: SparkSession, pages: DataFrame, out: str, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Writes a record for every row of pages under out, then the index; returns the directory: first_key, path, offset, length, lines.

    A null payload is an empty one, a null url an empty one. Of equal payloads of at least least_bytes the row with the
    largest id is the response; rows that repeat its id are responses too. A row without id refers to the holder if there
    is one with an id. Other columns are not read, whatever their names. An empty table writes nothing.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"), F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"))

    def archive(batches):
        name, rolled, held, lines = f"{out}/warc/{task_name()}", 0, bytearray(), []

        def close():
            nonlocal rolled, held, lines
            path = f"{name}-{rolled:05d}.warc.gz"
            put_file(path, bytes(held))
            done, rolled, held, lines = lines, rolled + 1, bytearray(), []
            return pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(zip(*done), (pa.string(), pa.int64(), pa.int64(), pa.int64()))), pa.array([path] * len(done))], names=["key", "page_id", "offset", "length", "path"])

        for part in steps(batches, "payload"):
            for page_id, url, payload, refers_to, refers_url in zip(*(part.column(c).to_pylist() for c in ("page_id", "url", "payload", "refers_to", "refers_url"))):
                data = member(record(page_id, url, payload, refers_to, refers_url))
                lines.append((line_safe(sort_key(url)), page_id, len(held), len(data)))
                held += data
                if len(held) >= ARCHIVE_BYTES:
                    yield close()
        if lines:
            yield close()

    lines = cut(spark, referred(rows, "page_id", F.col("payload"), least_bytes).select("page_id", "url", "payload", "refers_to", "refers_url").mapInArrow(archive, "key string, page_id long, offset long, length long, path string"), "warc-lines")

    def index(batches):
        path, held, blocks, waiting = f"{out}/index/{task_name()}.cdxj.z", bytearray(), [], []

        def close():
            packed = zlib.compress("\n".join(f"{k} {json.dumps(x)}" for k, x in waiting).encode())
            blocks.append((waiting[0][0], path, len(held), len(packed), len(waiting)))
            held.extend(packed)
            waiting.clear()

        for b in batches:
            for row in b.to_pylist():
                waiting.append((row.pop("key"), row))
                if len(waiting) == BLOCK_LINES:
                    close()
        if waiting:
            close()
        if blocks:
            directory = zlib.compress(json.dumps([(k, at, n) for k, _, at, n, _ in blocks]).encode())
            put_file(path, bytes(held) + directory + len(held).to_bytes(8, "big") + len(directory).to_bytes(4, "big"))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*blocks), (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()))], names=["first_key", "path", "offset", "length", "lines"])

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = lines.repartitionByRange(n, "key", "page_id", "path", "offset").sortWithinPartitions("key", "page_id")
    return cut(spark, ordered.mapInArrow(index, "first_key string, path string, offset long, length long, lines long"), "warc-directory")


def lines_of(data: bytes) -> list[tuple[str, dict]]:
    return [(k, json.loads(x)) for k, _, x in (line.partition(" ") for line in zlib.decompress(data).decode().split("\n"))]


def read_archives(spark: SparkSession, directory: DataFrame, urls: DataFrame, url_col: str = "url") -> DataFrame:
    """url, page_id, record_type, payload_bytes, payload_digest, refers_to of every record of each different URL in urls.

    The URLs' keys are sorted over the whole table. Each is searched by halves in the list of index files, in the file's
    block directory and in the block; neighbours mostly find both still open. What is found (places in archives) is
    brought together by archive and read by ranges in order. A null url is an empty one; an URL that the archives do not
    have gives no row.
    """
    schema = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long"
    types = {"page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "refers_to": pa.int64()}
    index = CaptureIndex(directory)

    @F.arrow_udf("string")
    def key_of(given: pa.Array) -> pa.Array:
        return pa.array([line_safe(sort_key(u)) for u in given.to_pylist()], pa.string())

    def files_of(batches):
        for b in batches:
            pairs = [(f, key) for key in b.column("key").to_pylist() for f in index.files(key)]
            yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in pairs], pa.int32()), pa.array([k for _, k in pairs], pa.string())], names=["file", "key"])

    def locate(batches):
        names, types_ = ("path", "offset", "length"), (pa.string(), pa.int64(), pa.int64())
        for b in batches:
            places = []
            for f, key in zip(b.column("file").to_pylist(), b.column("key").to_pylist()):
                for lines in index.lines(f, key):
                    places += [[x[c] for c in names] for x in lines]
                    if len(places) >= 8192:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*places), types_)], names=names)
                        places = []
            if places:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*places), types_)], names=names)

    def read(batches):
        name, opened = None, None
        for b in batches:
            rows, held = [], 0
            for path, offset, length in zip(*(b.column(c).to_pylist() for c in ("path", "offset", "length"))):
                if path != name:
                    if opened:
                        opened.close()
                    files, where = store(path)
                    name, opened = path, files.open_input_file(where)
                found = parse(opened.read_at(length, offset))
                held += len(found.pop("payload") or b"")
                rows.append(found)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in types.items()], names=list(types))
        if opened:
            opened.close()

    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keys = urls.select(key_of(F.coalesce(F.col(url_col).cast("string"), F.lit(""))).alias("key")).distinct()
    # a key that very many records have stands in many index files, each of which is searched by itself
    searched = keys.mapInArrow(files_of, "file int, key string").repartitionByRange(n, "file", "key").sortWithinPartitions("file", "key")
    places = searched.mapInArrow(locate, "path string, offset long, length long")
    return places.repartition(n, "path").sortWithinPartitions("path", "offset").mapInArrow(read, schema)


class CaptureIndex:
    """Lookups of URLs by halves. It holds the first key and path of each index file, one for a task that wrote any, and the directory and block last used."""

    def __init__(self, directory: DataFrame):
        found = directory.groupBy("path").agg(F.min("first_key").alias("k")).orderBy("k", "path").collect()
        self.firsts, self.paths = [r["k"] for r in found], [r["path"] for r in found]
        self.directory: tuple = (None, None, None)  # path, first keys, (offset, length) of its blocks
        self.block: tuple = (None, None, None)  # place, keys, lines

    def blocks(self, path: str) -> tuple[list[str], list[tuple[int, int]]]:
        if self.directory[0] != path:
            files, at = store(path)
            size = files.get_file_info(at).size
            tail = read_range(path, size - TAIL, TAIL)
            found = json.loads(zlib.decompress(read_range(path, int.from_bytes(tail[:8], "big"), int.from_bytes(tail[8:], "big"))))
            self.directory = (path, [b[0] for b in found], [(b[1], b[2]) for b in found])
        return self.directory[1:]

    def read(self, path: str, offset: int, length: int) -> tuple[list[str], list[dict]]:
        if self.block[0] != (path, offset):
            lines = lines_of(read_range(path, offset, length))
            self.block = ((path, offset), [k for k, _ in lines], [x for _, x in lines])
        return self.block[1:]

    def files(self, key: str) -> range:
        """Numbers of the index files that may have a key."""
        return range(max(0, bisect.bisect_left(self.firsts, key) - 1), bisect.bisect_right(self.firsts, key))

    def lines(self, f: int, key: str):
        """The lines of a key in one index file, block by block."""
        firsts, places = self.blocks(self.paths[f])
        for b in range(max(0, bisect.bisect_left(firsts, key) - 1), bisect.bisect_right(firsts, key)):
            keys, found = self.read(self.paths[f], *places[b])
            yield found[bisect.bisect_left(keys, key) : bisect.bisect_right(keys, key)]

    def find(self, url: str) -> list[dict]:
        """All records of a URL."""
        key = line_safe(sort_key(url))
        return [parse(read_range(x["path"], x["offset"], x["length"])) for f in self.files(key) for lines in self.lines(f, key) for x in lines]
