"""WARC archives with a two-level capture index.

``write_archives`` writes one record per page into gzip-per-record archives, a
repeated payload being a revisit of one response. ``write_index`` sorts the
captures by reversed-host URL key into compressed blocks of lines; beside each
block file lies a sparse directory with the first key and the place of every
block. ``lookup`` finds captures by URL: binary search in the list of block
files, binary search in the directory of that file, one range read, one block
decompressed. ``fetch`` range-reads and parses the records.

Archives and index lie below a shared folder, opened through pyarrow's file
systems (file, hdfs, s3, gs), so any task can read what another has written.
A task writes under a name of its own attempt and the resulting DataFrame is
stored before it is used: it lists exactly the files of the attempts that
succeeded, and a lost executor leaves at most an unlisted file.
"""

from __future__ import annotations

import bisect
import hashlib
import io
import json
import re
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import hadoop_path, materialize, scratch_folder

MIN_REVISIT_BYTES = 1000
FILE_BYTES = 256 << 20        # an archive is closed beyond this size
BLOCK_LINES = 512             # captures in one compressed block of the index
LOOKUPS_A_TASK = 50_000       # captures a lookup task finds, on average
FETCH_BYTES = 8 << 20         # compressed bytes a task reads back, on average
RECORD_DATE = "2024-01-01T00:00:00Z"   # the tables carry no crawl time


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), re.sub(r"^file:/*", "/", uri)
    return pafs.FileSystem.from_uri(uri)


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with its scheme, as Spark's own default file system resolves it: tasks
    open it with Arrow, where a bare path would be the executor's own disk."""
    fs, path = hadoop_path(spark, folder)
    return fs.makeQualified(path).toString()


def new_archive_folder(spark: SparkSession) -> str:
    return scratch_folder(spark, "warc")


def url_key(url: str | None) -> str:
    """Sort key of a URL: host labels reversed, without www, port and scheme, then the
    path and query, all in lower case; the fragment is dropped. ``http://M.a.org:80/B?c#d``
    becomes ``org,a,m)/b?c``. Null and unusable URLs get the key ``)``."""
    try:
        parts = urlsplit((url or "").strip())
        host = (parts.hostname or "").removeprefix("www.")
    except ValueError:
        return ")"
    path = parts.path or "/"
    return (",".join(reversed(host.split("."))) + ")" + path + (f"?{parts.query}" if parts.query else "")).lower() if host else ")"


# ------------------------------------------------------------------ records

def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC/1.0 record: a response with the payload, or a revisit with the HTTP
    headers alone (their Content-Length keeps the payload's size)."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<urn:page:{page_id}>"),
            ("WARC-Date", RECORD_DATE), ("WARC-Target-URI", json.dumps(url)), ("WARC-Payload-Digest", f"sha1:{digest}"),
            ("WARC-Block-Digest", f"sha1:{hashlib.sha1(block).hexdigest()}"),
            ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    if refers_to is not None:
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"),
                 ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    return b"WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """The fields of one record; raises on a malformed one or a wrong digest."""
    stream = io.BytesIO(data)
    if stream.readline() != b"WARC/1.0\r\n":
        raise ValueError("not a WARC record")

    def headers() -> dict[str, str]:
        out = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().rstrip("\r\n").partition(": ")
            out[name.lower()] = value
        return out

    head = headers()
    if "content-length" not in head:
        raise ValueError("damaged WARC record")
    block = stream.read(int(head["content-length"]))
    if f"sha1:{hashlib.sha1(block).hexdigest()}" != head["warc-block-digest"] or stream.read() != b"\r\n\r\n":
        raise ValueError("damaged WARC record")
    stream = io.BytesIO(block)
    stream.readline()
    size = int(headers()["content-length"])
    revisit = head["warc-type"] == "revisit"
    payload = None if revisit else stream.read()
    if payload is not None and (len(payload) != size or f"sha1:{hashlib.sha1(payload).hexdigest()}" != head["warc-payload-digest"]):
        raise ValueError("damaged payload")

    def page(uri: str):
        own = uri.removeprefix("<urn:page:").removesuffix(">")
        return None if own == "None" else int(own)

    return {"page_id": page(head["warc-record-id"]), "url": json.loads(head["warc-target-uri"]), "record_type": head["warc-type"],
            "payload_bytes": size, "payload_digest": head["warc-payload-digest"].removeprefix("sha1:"),
            "refers_to": page(head["warc-refers-to"]) if revisit else None, "payload": payload}


def squeeze(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


# ------------------------------------------------------------------ writing

def with_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                  min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """page_id, url, payload, digest and refers_to (null for responses). Only digests
    and ids are grouped (with partial aggregation, so a payload that a third of the
    pages share arrives as one row a task), and only payloads that occur twice are
    joined back; a hot digest there is split by the skew join."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.encode(F.coalesce(F.col(payload_col).cast("string"), F.lit("")), "UTF-8").alias("payload")
                        ).withColumn("digest", F.sha1("payload"))
    groups = (rows.filter((F.length("payload") >= min_bytes) & F.col("page_id").isNotNull()).groupBy("digest")
              .agg(F.max("page_id").alias("first_id"), F.min("page_id").alias("other"), F.count("*").alias("n"))
              .filter("n > 1 and other < first_id").select("digest", "first_id"))
    refers = F.when(F.col("page_id") != F.col("first_id"), F.col("first_id"))
    return rows.join(groups, "digest", "left").select("page_id", "url", "payload", "digest", refers.alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the archives below ``folder`` and return the stored captures: page_id,
    url, url_key, file, offset, length.

    A null payload is an empty one; a null page id is written as a response and
    never referred to; equal ids are records of their own; an empty table writes
    nothing. Records stream through a task, an archive is closed at ``file_bytes``.
    """
    folder = qualified(pages.sparkSession, folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_fs(folder)
        context = TaskContext.get()
        fs.create_dir(root, recursive=True)
        out, name, at, count = None, "", 0, 0
        try:
            for batch in batches:
                rows = []
                for page_id, url, payload, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if out is None or at >= file_bytes:
                        if out is not None:
                            out.close()
                        name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}-{count:04d}.warc.gz"
                        out, at, count = fs.open_output_stream(f"{root}/{name}", compression=None), 0, count + 1
                    data = squeeze(record(page_id, url, payload, digest, refers_to))
                    out.write(data)
                    rows.append((page_id, url, url_key(url), name, at, len(data)))
                    at += len(data)
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.string(), pa.string(), pa.string(),
                                                                                  pa.int64(), pa.int64()), strict=True)],
                        ["page_id", "url", "url_key", "file", "offset", "length"])
        finally:
            if out is not None:
                out.close()

    written = with_revisits(pages, id_col, url_col, payload_col).mapInArrow(
        write, "page_id long, url string, url_key string, file string, offset long, length long")
    return materialize(written, "warc-captures")


# -------------------------------------------------------------------- index

def write_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Write the index below ``folder`` and return its block files: index_file,
    first_key, last_key, blocks, lines.

    Lines are sorted by (url_key, page_id) over the whole table by a range
    exchange whose bounds include file and offset, so even one URL with most of
    the captures is spread over tasks. A block file is a series of gzip members of
    ``block_lines`` JSON lines; its directory holds (first key, offset, length) of
    each block.
    """
    folder = qualified(captures.sparkSession, folder)
    order = ["url_key", "page_id", "file", "offset"]
    dealt = captures.select("url_key", "page_id", "url", "file", "offset", "length").repartitionByRange(*order).sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_fs(folder)
        context = TaskContext.get()
        name = f"index-{context.partitionId():06d}-{context.taskAttemptId()}"
        fs.create_dir(root, recursive=True)
        out, at, lines, held, directory, last = None, 0, 0, [], [], None

        def flush() -> None:
            nonlocal out, at
            if out is None:
                out = fs.open_output_stream(f"{root}/{name}.gz", compression=None)
            data = squeeze("".join(json.dumps(x) + "\n" for x in held).encode())
            out.write(data)
            directory.append([held[0][0], at, len(data)])
            at += len(data)
            held.clear()

        for batch in batches:
            for line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append(line)
                last, lines = line[0], lines + 1
                if len(held) >= block_lines:
                    flush()
        if held:
            flush()
        if out is not None:
            out.close()
            with fs.open_output_stream(f"{root}/{name}.dir", compression=None) as d:
                d.write(json.dumps(directory).encode())
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in ((name, pa.string()), (directory[0][0], pa.string()), (last, pa.string()),
                                               (len(directory), pa.int64()), (lines, pa.int64()))],
                ["index_file", "first_key", "last_key", "blocks", "lines"])

    return materialize(dealt.mapInArrow(write, "index_file string, first_key string, last_key string, blocks long, lines long"),
                       "warc-index")


class Index:
    """Reads one block file through its directory; keeps the last block it opened."""

    def __init__(self, folder: str, name: str):
        self.fs, root = open_fs(folder)
        with self.fs.open_input_stream(f"{root}/{name}.dir", compression=None) as f:
            self.directory = json.loads(f.read())
        self.first = [d[0] for d in self.directory]
        self.data = self.fs.open_input_file(f"{root}/{name}.gz")
        self.held: tuple[int, list] = (-1, [])

    def block(self, k: int) -> list:
        if self.held[0] != k:
            _, offset, length = self.directory[k]
            lines = zlib.decompress(self.data.read_at(length, offset), 31).decode().splitlines()
            self.held = (k, [json.loads(x) for x in lines])
        return self.held[1]

    def find(self, key: str) -> Iterator[list]:
        """All lines of a key: from the last block that begins before it, onwards."""
        k = max(0, bisect.bisect_left(self.first, key) - 1)
        while k < len(self.directory) and self.first[k] <= key:
            lines = self.block(k)
            at = bisect.bisect_left(lines, key, key=lambda x: x[0])
            while at < len(lines) and lines[at][0] == key:
                yield lines[at]
                at += 1
            k += 1


def lookup(urls: DataFrame, index: DataFrame, folder: str, url_col: str = "url") -> DataFrame:
    """Captures of the distinct URLs in ``urls``: page_id, url, file, offset, length.

    Level one is a binary search in the list of block files, which has one entry per
    task that wrote the index and is sent to all tasks; level two runs in the
    tasks, which get the queries of a file together. Null URLs find the captures without a URL;
    unknown URLs find nothing; URLs with one key share their captures.
    """
    folder = qualified(urls.sparkSession, folder)
    files = sorted((r.first_key, r.last_key, r.index_file) for r in index.select("first_key", "last_key", "index_file").collect())
    first = [f[0] for f in files]

    @F.pandas_udf("struct<query string, files array<string>>")
    def route(urls: pd.Series) -> pd.DataFrame:
        queries, found = [url_key(u) for u in urls], []
        for query in queries:
            k = bisect.bisect_right(first, query)
            own = []
            while k and files[k - 1][1] >= query:       # a key of many captures spans several files
                k -= 1
                own.append(files[k][2])
            found.append(own)
        return pd.DataFrame({"query": pd.Series(queries, dtype=object), "files": pd.Series(found, dtype=object)})

    routed = urls.select(F.col(url_col).cast("string").alias("url")).distinct().select(route("url").alias("r"))
    found = routed.select("r.query", F.explode("r.files").alias("index_file")).distinct()
    # AQE would join the few bytes of many queries into one task; their lookups are the work
    tasks = 1 + (index.agg(F.sum("lines")).first()[0] or 0) // LOOKUPS_A_TASK
    dealt = found.select("index_file", "query").repartition(tasks, "index_file", F.xxhash64("query") % 16).sortWithinPartitions("index_file", "query")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[str, Index | None] = ("", None)
        for batch in batches:
            rows = []
            for name, query in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held[0] != name:
                    held = (name, Index(folder, name))
                for line in held[1].find(query):
                    rows.append(line[1:])
                    if len(rows) >= 10_000:
                        yield _captures(rows)
                        rows = []
            if rows:
                yield _captures(rows)

    return dealt.mapInArrow(search, "page_id long, url string, file string, offset long, length long")


def _captures(rows: list) -> pa.RecordBatch:
    types = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                                      ["page_id", "url", "file", "offset", "length"])


def fetch(captures: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """Read and verify the records of captures: page_id, url, record_type,
    payload_bytes, payload_digest, refers_to and, on request, payload (null for
    revisits). Captures of one archive are read in order of offset; a large
    archive's captures are dealt to several tasks by ranges of 4 MB."""
    folder = qualified(captures.sparkSession, folder)
    rows = materialize(captures.select("file", "offset", "length"), "warc-fetch")
    tasks = 1 + (rows.agg(F.sum("length")).first()[0] or 0) // FETCH_BYTES
    spread = rows.repartition(tasks, "file", F.shiftright("offset", 22)).sortWithinPartitions("file", "offset")
    names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", *(["payload"] if with_payload else [])]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_fs(folder)
        held, data = "", None
        for batch in batches:
            rows: list[dict] = []
            size = 0
            for name, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held != name:
                    held, data = name, fs.open_input_file(f"{root}/{name}")
                rows.append(parse(zlib.decompress(data.read_at(length, offset), 31)))
                size += rows[-1]["payload_bytes"] * with_payload
                if size > 32 << 20:
                    yield _records(rows, names, types)
                    rows, size = [], 0
            if rows:
                yield _records(rows, names, types)

    schema = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long"
    return spread.mapInArrow(read, schema + (", payload binary" if with_payload else ""))


def _records(rows: list[dict], names: list[str], types: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in zip(names, types, strict=False)], names)
