"""WARC archives and a merged capture index (operator 7).

Writing: Spark's text writer with the record terminator as line separator makes real WARC 1.1 files on any storage
Spark can write to, each file one gzip stream. Of records with equal payloads of at least ``REVISIT_BYTES`` bytes the one with the smallest page id is
a response, the others are revisits without payload.

Reading: files are read whole (a limit on their records keeps them near ``FILE_BYTES`` before compression), records are cut by Content-Length and
digests are checked. Each file's captures, sorted by URL key, timestamp and page id, are a run. Runs are cut
into ranges and kept in order inside them by Spark, and in each range the k runs meet in a loser tree, which reads each of
them a block at a time; the winners come out in global order with their place in the capture history of their URL. Ranges
are cut by page id and place of writing as well, so that even one URL, or one repeated row, with a third of all
captures is spread over ranges.

Null html is an empty payload, null url an empty one; a null page id is written empty and read back null, and is no one's response to refer to
unless all ids are null. Repeated rows are records of their own; a repeated smallest id is a response each time. Ties in URL key and
timestamp go by page id. An empty table gives no rows. Columns other than the named ones are not read.
"""

from __future__ import annotations

import gzip
import hashlib
import math
from collections.abc import Iterable, Iterator
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.storage import scratch_path, settle
from .common import raw

REVISIT_BYTES = 100
FILE_BYTES = 8 << 20
#: Captures that one range of the merge holds, about.
RANGE_ROWS = 50_000
#: Rows of a run that are Python objects at once.
RUN_ROWS = 1024
CRLF = "\r\n"
#: 2024-01-01T00:00:00Z, the time of page 0 where the table names no time; an id's seconds after it go round in SPAN.
EPOCH = 1704067200
SPAN = 1_000_000_000
#: The last second that a date of the format can write.
LAST_SECOND = 253402300799

CAPTURE = (
    "page_id bigint, url string, url_key string, time bigint, payload_digest string, payload_bytes bigint, "
    "record_type string, refers_to bigint, file string, position bigint, payload binary"
)


def decided(pages: DataFrame, id_col: str, url_col: str, html_col: str, time: Column | None) -> DataFrame:
    """page_id, url, html, time, digest, n_bytes, ``first`` (the response a revisit refers to, else null)."""
    if time is None:
        when = F.lit(EPOCH) + F.pmod(F.coalesce(F.col(id_col).cast("bigint"), F.lit(0).cast("bigint")), F.lit(SPAN))
    else:
        given = time.cast("bigint")
        when = F.when(given.between(0, LAST_SECOND), given).otherwise(
            F.raise_error(F.concat(F.lit("no second of the years 1970 to 9999: "), F.coalesce(given.cast("string"), F.lit("null")))).cast("bigint")
        )
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"),
        F.coalesce(F.col(url_col), F.lit("")).alias("url"),
        F.coalesce(F.col(html_col), F.lit("")).alias("html"),
        when.alias("time"),
    ).withColumns({"digest": F.sha2("html", 256), "n_bytes": F.octet_length("html").cast("bigint")})
    long = rows.where(F.col("n_bytes") >= REVISIT_BYTES)
    copies = long.groupBy("digest").agg(F.min("page_id").alias("least"), F.count(F.lit(1)).alias("n"))
    shared = copies.where("n > 1").select("digest", "least")
    # The pages are the kept side, so a hot digest can be split.
    return rows.join(shared, "digest", "left").withColumn(
        "first", F.when((F.col("n_bytes") >= REVISIT_BYTES) & ~F.col("page_id").eqNullSafe(F.col("least")), F.col("least"))
    )


def record_text(rows: DataFrame) -> DataFrame:
    """One WARC record per row, without the closing blank lines, as ``value``."""
    url = F.regexp_replace("url", r"[\x00-\x20\x7f]", "%20")
    revisit = F.col("first").isNotNull()
    payload = F.when(revisit, F.lit("")).otherwise(F.col("html"))

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))

    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    head = F.concat(
        F.lit("WARC/1.1" + CRLF),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), page, F.lit(">"))),
        line("WARC-Date", F.date_format(F.timestamp_seconds("time"), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        line("WARC-Target-URI", url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        line("X-Payload-Length", F.col("n_bytes").cast("string")),
        F.when(revisit, line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("first").cast("string"), F.lit(">")))).otherwise(""),
        line("Content-Length", F.octet_length(payload).cast("string")),
        F.lit(CRLF),
    )
    return rows.select(F.concat(head, payload).alias("value"))


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    time: Column | None = None,
) -> str:
    """Write the pages as WARC files under ``path``; returns the path. The html is shuffled once, to meet its copies."""
    size, rows = pages.agg(F.sum(F.coalesce(F.octet_length(html_col), F.lit(0)) + 400), F.count(F.lit(1))).first()
    most = max(1, int(FILE_BYTES * rows / max(1, size or 0)))
    records = record_text(decided(pages, id_col, url_col, html_col, time))
    records.write.option("lineSep", CRLF + CRLF).option("maxRecordsPerFile", most).text(path, compression="gzip")
    return path


def url_key(url: str) -> str:
    """Host labels reversed, then path and query: captures of a site lie together."""
    try:
        parts = urlsplit(url)
        host = (parts.hostname or "").removeprefix("www.")
    except ValueError:
        return url.lower()
    query = f"?{parts.query}" if parts.query else ""
    return f"{','.join(reversed(host.split('.')))}){parts.path or '/'}{query}".lower()


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], int, bytes]]:
    """Headers, position (before compression) and block of each record of an archive."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8").split(CRLF)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = dict(x.split(": ", 1) for x in lines[1:])
        start = end + 4
        stop = start + int(headers["Content-Length"])
        yield headers, at, data[start:stop]
        at = stop + 4


def read_archives(spark: SparkSession, path: str, keep_payload: bool = True) -> DataFrame:
    """The captures of all archives under ``path``, each file's sorted: the runs of the index."""
    from calendar import timegm
    from time import strptime

    def page(name: str | None) -> int | None:
        number = (name or "").removeprefix("<urn:page:").rstrip(">")
        return int(number) if number else None

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                name, data = batch.column("path")[i].as_py(), raw(batch.slice(i, 1), "content")[0]
                data = gzip.decompress(data) if name.endswith(".gz") else data
                found = []
                for h, at, block in parse_records(data):
                    digest = h["WARC-Payload-Digest"].removeprefix("sha256:")
                    kind, size = h["WARC-Type"], int(h["X-Payload-Length"])
                    if kind == "response" and (hashlib.sha256(block).hexdigest() != digest or len(block) != size):
                        raise ValueError(f"{name}: wrong digest at byte {at}")
                    when = timegm(strptime(h["WARC-Date"], "%Y-%m-%dT%H:%M:%SZ"))
                    url = h["WARC-Target-URI"]
                    found.append(
                        (page(h["WARC-Record-ID"]), url, url_key(url), when, digest, size, kind,
                         page(h.get("WARC-Refers-To")), name, at, block if keep_payload and kind == "response" else None)
                    )
                found.sort(key=capture_order)
                yield pa.RecordBatch.from_pylist([dict(zip(names, x)) for x in found], schema=schema)

    names = [x.split()[0] for x in CAPTURE.split(", ")]
    kinds = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in CAPTURE.split(", ")])
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(parse, CAPTURE)


def capture_order(row: tuple) -> tuple:
    """URL key, timestamp, page id (null first), place of writing."""
    return (row[2], row[3], row[0] is not None, row[0] or 0, row[8], row[9])


class LoserTree:
    """Merges k sorted runs: inner nodes keep the loser of their match, the root the winner.

    An advance replays only the matches on the winner's path, log2(k) comparisons.
    """

    def __init__(self, runs: Iterable[Iterable]):
        self.runs = [iter(r) for r in runs]
        self.k = max(1, len(self.runs))
        self.heads = [next(r, None) for r in self.runs] or [None]
        self.losers = [-1] * self.k
        self.winner = self.build(1) if self.k > 1 else 0

    def before(self, i: int, j: int) -> bool:
        a, b = self.heads[i], self.heads[j]
        return b is None or (a is not None and (a, i) < (b, j))

    def build(self, node: int) -> int:
        """The winner below a node; leaves are numbered from k on."""
        if node >= self.k:
            return node - self.k
        left, right = self.build(2 * node), self.build(2 * node + 1)
        win, lose = (left, right) if self.before(left, right) else (right, left)
        self.losers[node] = lose
        return win

    def __iter__(self) -> Iterator:
        while self.heads[self.winner] is not None:
            i = self.winner
            yield self.heads[i]
            self.heads[i] = next(self.runs[i], None)
            node = (i + self.k) // 2
            while node >= 1:
                if self.before(self.losers[node], i):
                    i, self.losers[node] = self.losers[node], i
                node //= 2
            self.winner = i


def stretches(column: pa.Array) -> Iterator[tuple[int, int, str]]:
    """Start, length and value of each stretch of equal values."""
    ended = pc.run_end_encode(column)
    start = 0
    for end, value in zip(ended.run_ends.to_pylist(), ended.values.to_pylist()):
        yield start, end - start, value
        start = end


def merge_runs(captures: DataFrame) -> DataFrame:
    """The captures in global order with ``range`` and ``place`` (their order) and ``history`` (from 1, per URL key)."""
    columns = [c for c in captures.columns if c != "payload"]
    index = captures.select(*columns)
    rows = index.agg(F.count(F.lit(1))).first()[0]
    ranges = max(1, math.ceil(rows / RANGE_ROWS))
    order = ("url_key", "time", "page_id", "file", "position")
    # Equal captures differ in their place of writing, so a range can end between them. Spark orders the runs of a range.
    cut = index.repartitionByRange(ranges, *order).sortWithinPartitions("file", "url_key", "time", "page_id", "position")
    key_at = [columns.index(c) for c in order]

    def run_of(parts: list[pa.RecordBatch]) -> Iterator[tuple]:
        """The rows of a run with their keys, of one part at a time."""
        for part in parts:
            for row in zip(*[c.to_pylist() for c in part.columns]):
                key, time, page, file, at = (row[i] for i in key_at)
                yield (key, time, page is not None, page or 0, file, at), row

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        runs: dict[str, list[pa.RecordBatch]] = {}
        schema = None
        for batch in batches:
            schema = batch.schema
            for at, n, file in stretches(batch.column(key_at[3])):
                runs.setdefault(file, []).extend(batch.slice(at + i, min(RUN_ROWS, n - i)) for i in range(0, n, RUN_ROWS))
        if schema is None:
            return
        out, number, place = [], TaskContext.get().partitionId(), 0
        for _, row in LoserTree(run_of(parts) for parts in runs.values()):
            out.append((*row, number, place))
            place += 1
            if len(out) == 4096:
                yield rows_to_batch(out, schema)
                out = []
        if out:
            yield rows_to_batch(out, schema)

    def rows_to_batch(out: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
        kinds = [*schema.types, pa.int32(), pa.int64()]
        columns_out = [pa.array(c, t) for c, t in zip(zip(*out), kinds)]
        return pa.RecordBatch.from_arrays(columns_out, names=[*schema.names, "range", "place"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in index.schema)
    merged = settle(cut.mapInArrow(merge, f"{fields}, range int, place bigint"))
    # A URL key's place of its first capture in a range, and how many it has in earlier ranges.
    seen = merged.groupBy("url_key", "range").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("start"))
    earlier = Window.partitionBy("url_key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = seen.select("url_key", "range", "start", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n_before"))
    return (
        merged.join(offsets, ["url_key", "range"])
        .withColumn("history", F.col("n_before") + F.col("place") - F.col("start") + 1)
        .drop("n_before", "start")
    )


def archive_pages(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write the pages, read the archives back and merge their runs: one row per capture, without payloads."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc-")
    write_archives(pages, path)
    return merge_runs(settle(read_archives(spark, path, keep_payload=False)))
