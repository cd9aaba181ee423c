"""WARC archives, their capture index merged from sorted runs, and reading them back."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime, timedelta
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callstrata.llm.common import hot_join, limit_batches, stored
from callstrata.llm.tokens import task_number

END = b"\r\n\r\n"
#: Index rows merged in one task, on average; the key space is cut into as many ranges as that takes.
MERGED_ROWS = 200_000
ENTRY = ("urlkey string, timestamp string, page_id bigint, file string, offset bigint, size bigint, "
         "digest string, type string")
PAGE = ("page_id bigint, url string, timestamp string, payload_bytes bigint, payload_digest string, "
        "record_type string, refers_to bigint, payload binary")


def url_key(url: str | None) -> str:
    """Sort key of a URL: host labels reversed, lower case, without user, default port, leading
    www or fragment; then path and sorted query. What is no URL is its own key."""
    text = (url or "").strip()
    try:
        parts = urlsplit(text)
        host = (parts.hostname or "").removeprefix("www.")
        port = parts.port
    except ValueError:
        return text.lower()
    if not host:
        return text.lower()
    own = f":{port}" if port and port != {"http": 80, "https": 443}.get(parts.scheme) else ""
    query = "&".join(sorted(parts.query.split("&"))) if parts.query else ""
    key = ",".join(reversed(host.split("."))) + own + ")" + (parts.path or "/").lower()
    return f"{key}?{query.lower()}" if query else key


def capture_time(number: int | None) -> datetime:
    """Pages carry no time; a fixed start plus their number in seconds stands for it."""
    return datetime(2024, 1, 1, tzinfo=UTC) + timedelta(seconds=(number or 0) % (1 << 32))


def decided(pages: DataFrame, smallest: int = 1000) -> DataFrame:
    """(page_id, url, payload, digest, refers_to): each page's payload and the page it revisits, if any.

    Of pages with equal payloads of at least `smallest` bytes the one with the largest page_id is
    stored, the others refer to it. Groups are counted before the shuffle; members of very common
    ones are spread over all tasks.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.sha1("payload"))
    # without a digest key small payloads are never shuffled together
    narrow = rows.where(F.length("payload") >= smallest).select("page_id", "digest")
    groups = stored(
        narrow.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("last")).where("n > 1"))
    keyed = rows.withColumn("__digest", F.when(F.length("payload") >= smallest, F.col("digest")))
    joined = hot_join(
        keyed, groups.withColumnRenamed("digest", "__digest"), ["__digest"], "n", F.struct("page_id", "url"))
    refers = F.when(~F.col("last").eqNullSafe(F.col("page_id")), F.col("last"))
    return joined.select("page_id", "url", "payload", "digest", refers.alias("refers_to"))


# ---- records ---------------------------------------------------------------------------------

def _line(value: str) -> str:
    return " ".join(value.split())


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record: a response with its HTTP message, or a revisit with its HTTP header only."""
    base32 = base64.b32encode(bytes.fromhex(digest)).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    header = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url} {digest}')}>",
        f"WARC-Date: {capture_time(page_id):%Y-%m-%dT%H:%M:%SZ}", f"WARC-Target-URI: {_line(url or '')}",
        f"WARC-Payload-Digest: sha1:{base32}", "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        header.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        header += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                   f"X-Refers-To-Page: {refers_to}"]
    return "\r\n".join(header).encode() + END + block + END


def parse(data: bytes) -> dict:
    """The fields of one record; raises ValueError on a record that contradicts itself."""
    head, _, rest = data.partition(END)
    lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    block, tail = rest[: int(fields["Content-Length"])], rest[int(fields["Content-Length"]):]
    if lines[0] != "WARC/1.1" or tail != END:
        raise ValueError("not a whole WARC record")
    http, _, payload = block.partition(END)
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    whole = fields["WARC-Type"] == "response"
    if whole and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError("payload and digest differ")
    number = {k: int(fields[k]) if k in fields else None for k in ("X-Page-ID", "X-Refers-To-Page")}
    return {
        "page_id": number["X-Page-ID"], "url": fields["WARC-Target-URI"], "timestamp": fields["WARC-Date"],
        "payload_bytes": size, "payload_digest": digest, "record_type": fields["WARC-Type"],
        "refers_to": number["X-Refers-To-Page"], "payload": payload if whole else None,
    }


# ---- writing ---------------------------------------------------------------------------------

def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def write_archives(captures: DataFrame, path: str, roll_bytes: int = 256 << 20) -> None:
    """Write .warc.gz files below path/archive and their locally sorted index runs below path/runs.

    Every record is a gzip member of its own. A task streams its records into files of its own
    name and attempt and emits an index entry for each, a run at a time sorted by URL key and time.
    Spark commits the entries of one attempt per task, so files of lost attempts are never named.
    `path` must be a folder all executors share. Columns: those of decided().
    """
    limit_batches(captures.sparkSession)
    _store(path)[0].create_dir(f"{_store(path)[1]}/archive", recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(path)
        entries, out, at, number = [], None, 0, 0
        name = f"part-{task_number():05d}-{uuid.uuid4().hex}"
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    file, at = f"{name}-{number:03d}.warc.gz", 0
                    out = store.open_output_stream(f"{base}/archive/{file}", compression=None)
                data = zlib.compress(record(**row), 6, 31)
                out.write(data)
                entries.append((
                    url_key(row["url"]), f"{capture_time(row['page_id']):%Y%m%d%H%M%S}", row["page_id"], file, at,
                    len(data), row["digest"], "response" if row["refers_to"] is None else "revisit"))
                at += len(data)
                if at >= roll_bytes or len(entries) >= MERGED_ROWS:
                    out.close()
                    out, number = None, number + 1
                    yield sorted_run(entries)
                    entries = []
        if out is not None:
            out.close()
        if entries:
            yield sorted_run(entries)

    rows = captures.select("page_id", "url", "payload", "digest", "refers_to").mapInArrow(run, f"{ENTRY}, run string, place bigint")
    rows.write.mode("overwrite").parquet(f"{path}/runs")


def order(entry: tuple) -> tuple:
    """Index order: URL key, time, page id (none first), file, place in it."""
    return entry[0], entry[1], entry[2] is not None, entry[2] or 0, entry[3], entry[4]


def sorted_run(entries: list[tuple]) -> pa.RecordBatch:
    entries.sort(key=order)
    columns = [pa.array(list(x)) for x in zip(*entries, strict=True)]
    columns[2] = columns[2].cast(pa.int64())
    n = len(entries)
    names = [x.split(" ")[0] for x in ENTRY.split(", ")]
    return pa.RecordBatch.from_arrays(
        [*columns, pa.array([uuid.uuid4().hex] * n), pa.array(range(n), pa.int64())], [*names, "run", "place"])


# ---- merging ---------------------------------------------------------------------------------

def loser_tree(runs: list[Iterator]) -> Iterator:
    """Merge sorted iterators of (key, value): each inner node keeps the loser of its match, so the
    next least item costs one match per level."""
    k = len(runs)
    heads = [next(r, None) for r in runs]

    def beats(a: int, b: int) -> bool:
        """Whether run a goes before run b; a finished run loses, equal keys go by run."""
        if heads[a] is None or heads[b] is None:
            return heads[b] is None and (heads[a] is not None or a < b)
        return (heads[a][0], a) < (heads[b][0], b)

    losers = [-1] * k
    winner = -1
    for leaf in range(k):
        contender, node = leaf, (leaf + k) // 2
        while node and losers[node] >= 0:
            if beats(losers[node], contender):
                losers[node], contender = contender, losers[node]
            node //= 2
        if node:
            losers[node] = contender
        else:
            winner = contender
    while k and heads[winner] is not None:
        yield heads[winner]
        heads[winner] = next(runs[winner], None)
        contender, node = winner, (winner + k) // 2
        while node:
            if beats(losers[node], contender):
                losers[node], contender = contender, losers[node]
            node //= 2
        winner = contender


def merge_index(spark: SparkSession, path: str) -> None:
    """Merge all runs into path/index: globally ordered capture histories.

    The key space (URL key, time, page) is cut into ranges of about MERGED_ROWS entries, so a URL
    with very many captures takes several. Each range gets its slice of every run, still in
    order, and a loser tree merges the slices. `part` and `place` give the order over all files.
    """
    runs = spark.read.parquet(f"{path}/runs")
    ranges = max(1, -(-runs.count() // MERGED_ROWS))
    names = [x.split(" ")[0] for x in ENTRY.split(", ")]
    sliced = runs.repartitionByRange(
        ranges, "urlkey", "timestamp", F.col("page_id").asc_nulls_first(), "file", "offset",
    ).sortWithinPartitions("run", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices: dict[str, list[tuple]] = {}
        for batch in batches:
            columns = [batch.column(names.index(c)).to_pylist() for c in names]
            for own, entry in zip(batch.column(len(names)).to_pylist(), zip(*columns, strict=True), strict=True):
                slices.setdefault(own, []).append(entry)
        merged = loser_tree([iter([(order(e), e) for e in part]) for part in slices.values()])
        part, place, block = task_number(), 0, []
        for _, entry in merged:
            block.append((*entry, part, place))
            place += 1
            if len(block) == 20_000:
                yield _table(block)
                block = []
        if block:
            yield _table(block)

    def _table(block):
        columns = list(zip(*block, strict=True))
        kinds = [pa.int64() if c in ("page_id", "offset", "size") else pa.string() for c in names]
        return pa.RecordBatch.from_arrays(
            [*[pa.array(c, k) for c, k in zip(columns, kinds, strict=False)],
             pa.array(columns[-2], pa.int32()), pa.array(columns[-1], pa.int64())], [*names, "part", "place"])

    sliced.mapInArrow(run, f"{ENTRY}, part int, place bigint").write.mode("overwrite").parquet(f"{path}/index")


def histories(spark: SparkSession, path: str) -> DataFrame:
    """The merged index; ordered by (part, place)."""
    return spark.read.parquet(f"{path}/index")


# ---- reading ---------------------------------------------------------------------------------

def read_archives(spark: SparkSession, path: str, index: DataFrame | None = None) -> DataFrame:
    """The records an index names (all by default), read from the archives and checked against
    their digests: PAGE with index_part and index_place.

    Entries are dealt by file and place, so a task reads stretches of files in order and a file is
    shared by several tasks.
    """
    wanted = (histories(spark, path) if index is None else index).select("file", "offset", "size", "part", "place")
    ordered = wanted.repartition("file", F.floor(F.col("offset") / (32 << 20))).sortWithinPartitions("file", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(path)
        current, source = None, None
        for batch in batches:
            found, held = [], 0
            for row in batch.to_pylist():
                if row["file"] != current:
                    if source:
                        source.close()
                    current, source = row["file"], store.open_input_file(f"{base}/archive/{row['file']}")
                source.seek(row["offset"])
                one = parse(zlib.decompress(source.read(row["size"]), 31))
                found.append((*one.values(), row["part"], row["place"]))
                held += one["payload_bytes"]
                if held > 8_000_000:
                    yield _pages(found)
                    found, held = [], 0
            if found:
                yield _pages(found)
        if source:
            source.close()

    def _pages(found):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), PAGE_SCHEMA, strict=True)], schema=PAGE_SCHEMA)

    return ordered.mapInArrow(run, f"{PAGE}, index_part int, index_place bigint")


PAGE_SCHEMA = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("timestamp", pa.string()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
    ("index_part", pa.int32()), ("index_place", pa.int64()),
])


def archive(pages: DataFrame, path: str, smallest: int = 1000) -> None:
    """Write the pages as WARC files with a merged index below `path`.

    Columns read: page_id, url, html. Null html is an empty payload, a null URL an empty one; a null
    page_id never stands for others. Repeated rows of one page get a record each. Pages of equal
    payload and equal largest page_id are all responses. No pages give an empty index.
    """
    write_archives(decided(pages, smallest), path)
    merge_index(pages.sparkSession, path)
