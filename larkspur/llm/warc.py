"""WARC archives with a two-level capture index.

Records are written as gzip members, one archive per task.  The index sorts captures by
reversed-host URL key and page; it is range-partitioned, each part being a file of compressed
blocks of `LINES` captures with a sparse directory (first key, offset, length of each block)
in a file beside it.  A lookup finds the part by binary search over the parts' first
keys, the block by binary search in the part's directory, and reads that block's range,
then the records' ranges.
"""

from __future__ import annotations

import base64
import bisect
import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm import common

LINES = 1000
#: Parts of the index at most; the first keys of the parts are all that the driver holds.
PARTS = 4096
#: Captures of an index part, about, until there are PARTS of them.
PART_CAPTURES = 4096
LEAST_REVISIT = 1000
LEVEL = 3
_STRETCH = 16 << 20
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2024-01-01T00:00:00Z"
_CAPTURES = "key string, page long, file string, offset long, length long"


def url_key(url: str | None) -> str:
    """Reversed-host sort key: `https://A.b.org/x?q` gives `org,b,a)/x?q`; null gives an empty key."""
    if not url:
        return ""
    _, found, tail = url.partition("://")
    if not found:
        return ")" + url
    host = re.match(r"[^/?#]*", tail).group()
    return ",".join(reversed(host.lower().split("."))) + ")" + tail[len(host) :]


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def record(page: int | None, url: str | None, payload: bytes, sha1_hex: str, refers_to: int | None) -> bytes:
    """One gzip member.  A revisit keeps the HTTP headers, with the full length, and no payload."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http if revisit else http + payload
    digest = base64.b32encode(bytes.fromhex(sha1_hex)).decode()
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url or "")
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{page}>", f"WARC-Date: {_DATE}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}", "", ""]
    pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(head).encode() + body + b"\r\n\r\n") + pack.flush()


def parse(raw: bytes) -> dict:
    """Fields of a record's gzip member: page, url, type, digest (hex), payload size and bytes, refers_to."""
    data = zlib.decompress(raw, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    body = rest[: int(fields["Content-Length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?m)^Content-Length: (\d+)", http).group(1))

    def page(name: str) -> int | None:
        found = re.fullmatch(r"<urn:page:(-?\d+)>", fields.get(name, ""))
        return int(found.group(1)) if found else None

    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    return {
        "page_id": page("WARC-Record-ID"), "url": fields["WARC-Target-URI"], "record_type": fields["WARC-Type"], "payload_digest": digest,
        "payload_bytes": size, "payload": payload if fields["WARC-Type"] == "response" else None, "refers_to": page("WARC-Refers-To"),
    }


def revisits(df: DataFrame, key: str = "page_id", html: str = "html", least: int = LEAST_REVISIT) -> DataFrame:
    """(page, sha1, refers_to) of rows whose payload a row with a larger key holds too."""
    payload = F.coalesce(common.quoted(html), F.lit("")).cast("binary")
    marked = df.select(common.quoted(key).cast("long").alias("page"), F.sha1(payload).alias("sha1"), F.octet_length(payload).alias("n"))
    marked = marked.where(F.col("n") >= least).select("page", "sha1")
    groups = marked.groupBy("sha1").agg(F.max("page").alias("refers_to"), F.count(F.lit(1)).alias("rows")).where("rows > 1 and refers_to is not null")
    again = marked.join(groups.select("sha1", "refers_to"), "sha1").where("page is null or page < refers_to")
    return again.distinct()


@dataclass
class Archive:
    """Where the records and their index are."""

    folder: str
    captures: DataFrame
    parts: list[tuple[str, str]]  # (first key, index file), sorted


def write(df: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write every row as a record below `folder`; returns the stored captures.

    Of rows with equal payloads of at least `LEAST_REVISIT` bytes, those with the largest key
    are responses and the others revisit it; all smaller payloads are responses.  Null html is
    an empty payload, null keys never are the largest, repeated rows keep their records.
    """
    payload = F.coalesce(common.quoted(html), F.lit("")).cast("binary")
    rows = df.select(common.quoted(key).cast("long").alias("page"), common.quoted(url).alias("url"), payload.alias("payload"), F.sha1(payload).alias("sha1"))
    seen = revisits(df, key, html).select(F.col("page").alias("p"), F.col("sha1").alias("s"), "refers_to")
    typed = rows.join(seen, rows.page.eqNullSafe(seen.p) & (rows.sha1 == seen.s), "left").select("page", "url", "payload", "sha1", "refers_to")
    return common.stored(typed.mapInArrow(_write_records(folder), _CAPTURES), "captures")


def _write_records(folder: str):
    names = ["key", "page", "file", "offset", "length"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, out, at, name = TaskContext.get(), None, 0, None
        try:
            for batch in batches:
                rows = []
                for page, url, payload, sha1, refers_to in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                    if out is None:
                        # one file per attempt: only the attempt that counts is in the captures
                        name = f"{folder}/pages-{task.partitionId():05d}-{task.taskAttemptId()}.warc.gz"
                        system, path = _open(name)
                        system.create_dir(path.rpartition("/")[0], recursive=True)
                        out = system.open_output_stream(path, compression=None)
                    raw = record(page, url, payload, sha1, refers_to)
                    out.write(raw)
                    rows.append((url_key(url), page, name, at, len(raw)))
                    at += len(raw)
                if rows:
                    yield _captures(rows, names)
        finally:
            if out is not None:
                out.close()

    return run


def _captures(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def index(captures: DataFrame, folder: str, lines: int = LINES, parts: int = PARTS) -> list[tuple[str, str]]:
    """Write the capture index below `folder`; returns (first key, file) of each part, sorted."""
    wanted = max(1, min(parts, captures.count() // PART_CAPTURES))
    ordered = captures.repartitionByRange(wanted, "key", "page", "file", "offset").sortWithinPartitions("key", "page", "file", "offset")
    made = common.stored(ordered.mapInArrow(_write_index(folder, lines), "first_key string, file string"), "parts")
    return sorted((r.first_key, r.file) for r in made.collect())


def _write_index(folder: str, lines: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        name = f"{folder}/index-{task.partitionId():05d}-{task.taskAttemptId()}"
        out, waiting, directory, at = None, [], [], 0

        def flush() -> int:
            raw = zlib.compress("\n".join(waiting).encode(), LEVEL)
            out.write(raw)
            directory.append([json.loads(waiting[0])[0], at, len(raw)])
            waiting.clear()
            return at + len(raw)

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if out is None:
                    system, path = _open(name)
                    system.create_dir(path.rpartition("/")[0], recursive=True)
                    out = system.open_output_stream(path + ".blocks", compression=None)
                waiting.append(json.dumps(row))
                if len(waiting) == lines:
                    at = flush()
        if waiting:
            at = flush()
        if out is not None:
            out.close()
            with system.open_output_stream(path + ".directory", compression=None) as side:
                side.write(json.dumps(directory).encode())
            yield pa.RecordBatch.from_arrays([pa.array([directory[0][0]]), pa.array([name])], names=["first_key", "file"])

    return run


def archive(df: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html") -> Archive:
    captures = write(df, folder, key, url, html)
    return Archive(folder, captures, index(captures, folder))


def find(spark: SparkSession, parts: list[tuple[str, str]], urls: DataFrame, url: str = "url") -> DataFrame:
    """Captures (key, page, file, offset, length) of each distinct URL key, by two binary searches."""
    firsts, files = [p[0] for p in parts], [p[1] for p in parts]

    def to_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, at = [], []
            for k in {url_key(u) for u in batch.column(0).to_pylist()}:
                # a key may fill several parts: from the last that starts below it on
                for i in range(max(0, bisect.bisect_left(firsts, k) - 1), bisect.bisect_right(firsts, k)):
                    keys.append(k)
                    at.append(files[i])
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(at, pa.string())], names=["key", "part"])

    asked = urls.select(common.quoted(url).alias("url")).mapInArrow(to_parts, "key string, part string").distinct()
    return asked.repartition(max(1, len(parts)), "part").sortWithinPartitions("part", "key").mapInArrow(_search_part, _CAPTURES)


def _search_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["key", "page", "file", "offset", "length"]
    part = directory = firsts = system = path = None
    held, block = None, []
    for batch in batches:
        rows = []
        for key, own in zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True):
            if own != part:
                part, held = own, None
                system, path = _open(own)
                with system.open_input_file(path + ".directory") as f:
                    directory = json.loads(f.read())
                firsts = [d[0] for d in directory]
            for i in range(max(0, bisect.bisect_left(firsts, key) - 1), bisect.bisect_right(firsts, key)):
                if held != i:
                    with system.open_input_file(path + ".blocks") as f:
                        raw = f.read_at(directory[i][2], directory[i][1])
                    held, block = i, [json.loads(x) for x in zlib.decompress(raw).decode().split("\n")]
                a = bisect.bisect_left(block, key, key=lambda r: r[0])
                b = bisect.bisect_right(block, key, key=lambda r: r[0])
                rows += map(tuple, block[a:b])
                if len(rows) > 50_000:
                    yield _captures(rows, names)
                    rows = []
        if rows:
            yield _captures(rows, names)


_RECORDS = "page_id long, url string, record_type string, payload_digest string, payload_bytes long, payload binary, refers_to long"


def read(captures: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of captures, read by range and parsed; stretches of a file go to one task."""
    names = ["page_id", "url", "record_type", "payload_digest", "payload_bytes", "payload", "refers_to"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = f = None
        for batch in batches:
            rows, size = [], 0
            for own, offset, length in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if own != name:
                    if f is not None:
                        f.close()
                    name = own
                    system, path = _open(own)
                    f = system.open_input_file(path)
                got = parse(f.read_at(length, offset))
                if not payloads:
                    got["payload"] = None
                rows.append(got)
                size += len(got["payload"] or b"")
                if size > 16_000_000:
                    yield _records(rows, names, kinds)
                    rows, size = [], 0
            if rows:
                yield _records(rows, names, kinds)
        if f is not None:
            f.close()

    found = common.stored(captures, "found")
    # a given number of tasks: what they read is the records, not the few bytes of these rows
    tasks = -(-(found.agg(F.sum("length")).first()[0] or 0) // _STRETCH)
    dealt = found.withColumn("stretch", F.expr(f"offset div {_STRETCH}")).repartition(max(1, tasks), "file", "stretch").sortWithinPartitions("file", "offset")
    return dealt.select("file", "offset", "length").mapInArrow(run, _RECORDS)


def _records(rows: list[dict], names: list[str], kinds: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds, strict=True)], names=names)


def lookup(archived: Archive, urls: DataFrame, url: str = "url", payloads: bool = True) -> DataFrame:
    """Records of all captures of the given URLs."""
    return read(find(urls.sparkSession, archived.parts, urls, url), payloads)
