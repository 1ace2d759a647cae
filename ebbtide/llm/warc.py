"""WARC archives with a two-level capture index.

Pages are written as gzip members of WARC/1.1 files, one member a record, so
that any record can be read by its byte range. Of records with equal payloads
the one with the largest page id is a response; the others are revisits that
refer to it and hold no payload.

The index has two levels: the captures' reversed-host URL keys (``com,example,
www)/path``), sorted over all files, in compressed blocks of ``BLOCK_LINES``;
and a sparse directory with the first and last key of each block and its byte
range. A lookup searches the directory by bisection, range-reads one block,
searches that by bisection and range-reads the record. Probes come sorted, so a
task holds only the directory's slice between its first and last key.

Files are written by tasks into the shared folder under names of their own
attempt; only files that a finished task reports are in the index, so a lost
executor's files are never read. Files are opened through ``pyarrow.fs``.

Null html is an empty payload, which is a payload like any other. Pages without
a url have an empty key. A page without an id refers to the response of its
payload like any other, and is a response where no page of that payload has an
id. Rows with equal ids and urls are captures of their own, read back one for
one; those with the largest id of a payload are all responses.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.dataset as pads
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import new_path, stored

#: Compressed bytes after which a task begins another WARC file.
FILE_BYTES = 256 << 20
#: Captures in a block of the index.
BLOCK_LINES = 1024
LEVEL = 4
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "<urn:x-page:{}>"

Entry = tuple[str, str, int, int]  # key, file, offset, length


def capture_key(url: Column, page_id: Column) -> Column:
    """Reversed host, path and query, then the page id so that it sorts as a number."""
    url = F.coalesce(url, F.lit(""))
    scheme = "^[A-Za-z][A-Za-z0-9+.-]*://"
    host = F.lower(F.regexp_replace(F.regexp_extract(url, scheme + "([^/?#]*)", 1), "^[^@]*@", ""))
    port = F.regexp_extract(host, "(:[0-9]+)$", 1)
    name = F.regexp_replace(host, ":[0-9]*$", "")
    rest = F.regexp_extract(url, scheme + "[^/?#]*([^#]*)", 1)
    surt = F.concat(F.array_join(F.reverse(F.split(name, "\\.")), ","), port, F.lit(")"), F.when(rest == "", "/").otherwise(rest))
    key = F.regexp_replace(F.when(url.rlike(scheme), surt).otherwise(url), "[\\x00-\\x20\\x7F]", "%20")
    number = F.lpad((page_id.cast("decimal(20,0)") + F.expr("9223372036854775808BD")).cast("string"), 20, "0")
    return F.concat(key, F.lit(" "), F.coalesce(number, F.lit("-")))


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def format_record(page_id, url: str | None, date: str, payload: bytes, refers_to) -> bytes:
    """One record, uncompressed: an HTTP response, without its body for a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {RECORD_ID.format('null' if page_id is None else page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url))
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {RECORD_ID.format(refers_to)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(member: bytes) -> dict:
    """The fields of one gzip member; the payload is None for a revisit."""
    data = gzip.decompress(member)
    head, _, body = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = body[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    number = lambda name: None if name not in fields or "null" in fields[name] else int(fields[name].rsplit(":", 1)[1].rstrip(">"))
    out = {
        "page_id": number("WARC-Record-ID"), "url": fields.get("WARC-Target-URI"), "record_type": fields["WARC-Type"],
        "payload_bytes": size, "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        "refers_to": number("WARC-Refers-To"), "payload": None,
    }
    if out["record_type"] == "response":
        if len(payload) != size or payload_digest(payload) != out["payload_digest"]:
            raise ValueError(f"damaged record of page {out['page_id']}")
        out["payload"] = payload
    return out


def _deduplicated(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """(key, page_id, url, html, refers_to): refers_to is null for responses."""
    rows = pages.select(
        capture_key(F.col(url_col), F.col(id_col)).alias("key"), F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
        F.col(html_col).alias("html"), F.unhex(F.sha1(F.coalesce(html_col, F.lit("")))).alias("sha"),
    )
    last = rows.groupBy("sha").agg(F.max("page_id").alias("last"))
    refers = F.when(F.col("page_id").eqNullSafe(F.col("last")), F.lit(None)).otherwise(F.col("last"))
    return rows.join(last, "sha").select("key", "page_id", "url", "html", refers.alias("refers_to"))


def write(pages: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z", id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Writes the archives; (key, file, offset, length) of every record, stored."""

    def run(batches):
        fs, root = filesystem(folder)
        fs.create_dir(root, recursive=True)
        out, name, at = None, "", 0
        try:
            for batch in batches:
                rows: list[Entry] = []
                for key, page_id, url, html, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if out is None or at >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = fs.open_output_stream(f"{root}/{name}", compression=None)
                    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                    member = z.compress(format_record(page_id, url, date, (html or "").encode(), refers_to)) + z.flush()
                    out.write(member)
                    rows.append((key, name, at, len(member)))
                    at += len(member)
                k, f, o, n = zip(*rows, strict=True) if rows else ((), (), (), ())
                yield pa.RecordBatch.from_pydict({"key": pa.array(k, pa.string()), "file": pa.array(f, pa.string()), "offset": pa.array(o, pa.int64()), "length": pa.array(n, pa.int64())})
        finally:
            if out is not None:
                out.close()

    return stored(_deduplicated(pages, id_col, url_col, html_col).mapInArrow(run, "key string, file string, offset bigint, length bigint"), "captures")


def build_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> str:
    """Writes the sorted blocks and the directory; returns the directory's path."""

    def run(batches):
        fs, root = filesystem(folder)
        fs.create_dir(root, recursive=True)
        name = f"{uuid.uuid4().hex}.idx"
        held: list[Entry] = []
        at = 0
        with fs.open_output_stream(f"{root}/{name}", compression=None) as out:
            for batch in _with_end(batches):
                if batch is not None:
                    held += zip(*(c.to_pylist() for c in batch.columns), strict=True)
                rows = []
                while len(held) >= block_lines or (batch is None and held):
                    own, held = held[:block_lines], held[block_lines:]
                    block = zlib.compress("\n".join("\t".join(map(str, e)) for e in own).encode())
                    out.write(block)
                    rows.append((own[0][0], own[-1][0], name, at, len(block)))
                    at += len(block)
                if rows:
                    a, b, f, o, n = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_pydict({"first": a, "last": b, "file": f, "offset": pa.array(o, pa.int64()), "length": pa.array(n, pa.int64())})

    sorted_rows = _by_key(captures.select("key", "file", "offset", "length"))
    path = new_path(captures.sparkSession, "directory")
    sorted_rows.mapInArrow(run, "first string, last string, file string, offset bigint, length bigint").write.parquet(path)
    return path


def _with_end(batches) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def _by_key(rows: DataFrame) -> DataFrame:
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionByRange(n, "key").sortWithinPartitions("key")


class Index:
    """The directory's slice between two keys, and the blocks that it points to."""

    def __init__(self, directory: str, index_folder: str, low: str, high: str):
        fs, path = filesystem(directory)
        blocks = pads.dataset(path, filesystem=fs, format="parquet").to_table(filter=(pads.field("last") >= low) & (pads.field("first") <= high)).sort_by("first")
        self.fs, self.root = filesystem(index_folder)
        self.blocks = blocks.to_pylist()
        self.last = [b["last"] for b in self.blocks]
        self._held: tuple[int, list[list[str]], list[str]] = (-1, [], [])

    def _block(self, i: int) -> tuple[list[list[str]], list[str]]:
        if self._held[0] != i:
            b = self.blocks[i]
            with self.fs.open_input_file(f"{self.root}/{b['file']}") as f:
                lines = [x.split("\t") for x in zlib.decompress(f.read_at(b["length"], b["offset"])).decode().split("\n")]
            self._held = (i, lines, [x[0] for x in lines])
        return self._held[1:]

    def find(self, key: str, nth: int = 0) -> Entry | None:
        """The nth capture of this key, counted from 0."""
        i = bisect_left(self.last, key)
        while i < len(self.blocks):
            lines, keys = self._block(i)
            at = bisect_left(keys, key) + nth
            if at < len(keys):
                return (key, lines[at][1], int(lines[at][2]), int(lines[at][3])) if keys[at] == key else None
            nth = at - len(keys)
            i += 1
        return None


def lookup(probes: DataFrame, archive: str, index_folder: str, directory: str, with_payload: bool = False) -> DataFrame:
    """Reads the captures of these keys back from the archives; ``probes`` has a column ``key``.

    The nth probe of a key gets its nth capture. A key without a capture raises.
    """
    payload = ", payload binary" if with_payload else ""

    def run(batches):
        fs, root = filesystem(archive)
        seen, nth = None, 0
        for batch in batches:
            keys = batch.column(0).to_pylist()
            if not keys:
                continue
            index = Index(directory, index_folder, keys[0], keys[-1])
            entries = []
            for key in keys:
                nth = nth + 1 if key == seen else 0
                seen = key
                entry = index.find(key, nth)
                if entry is None:
                    raise KeyError(f"no capture {nth} of {key}")
                entries.append(entry)
            rows, open_file, name = [], None, ""
            for _, file, offset, length in sorted(entries, key=lambda e: e[1:]):  # in the order of the files
                if file != name:
                    if open_file is not None:
                        open_file.close()
                    open_file, name = fs.open_input_file(f"{root}/{file}"), file
                record = parse_record(open_file.read_at(length, offset))
                if not with_payload:
                    del record["payload"]
                rows.append(record)
            if open_file is not None:
                open_file.close()
            kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64(), "payload": pa.binary()}
            yield pa.RecordBatch.from_pydict({c: pa.array([r[c] for r in rows], kinds.get(c, pa.string())) for c in rows[0]})

    schema = f"page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint{payload}"
    return _by_key(probes.select("key")).mapInArrow(run, schema)


def round_trip(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", with_payload: bool = False) -> DataFrame:
    """Archives all pages, indexes them, and reads every page back through the index."""
    spark: SparkSession = pages.sparkSession
    folder = folder or new_path(spark, "warc")
    captures = write(pages, f"{folder}/archive", id_col=id_col, url_col=url_col, html_col=html_col)
    directory = build_index(captures, f"{folder}/index")
    probes = pages.select(capture_key(F.col(url_col), F.col(id_col)).alias("key"))
    return lookup(probes, f"{folder}/archive", f"{folder}/index", directory, with_payload)
