"""WARC archives of web pages, read back into globally ordered capture histories.

Writing: each page becomes a WARC/1.1 record whose block is an HTTP response; pages with a payload that
a smaller page id has too become revisit records that refer to it. The records are built
with column functions and written by Spark's text sink with the record separator as line end, so that a lost
executor's files are replaced by the committer as for any table. Each part file is an archive.

Reading: a task parses whole archives by their content lengths, checks each payload's
digest and emits the archive's index as a run sorted by URL key and timestamp.
The external merge deals the runs out by ranges of (URL key, timestamp, page id) and
merges the runs' slices of each range with a loser tree, which needs one comparison per level of the tree and row.
(shard, position) is the global order: all captures of a URL stand together, the oldest first.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstat.llm.common import written
from reelstat.session import scratch_path

CRLF = "\r\n"
RECORD_END = CRLF + CRLF
ID_PREFIX = "urn:page:"
LEAST_REVISIT_BYTES = 0
RECORDS_PER_ARCHIVE = 2000
FIRST_CAPTURE = "2024-01-01 00:00:00"  # pages carry no time: a page's is this plus its id in seconds

# The digits of base 32 as Spark's conv() writes them, and as RFC 4648 does.
CONV_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
RFC_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def sha1_base32(hexadecimal: Column) -> Column:
    """Base 32 of a SHA-1 given in hex: four times ten hex digits are eight base 32 digits each."""
    parts = [F.lpad(F.conv(F.substring(hexadecimal, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*parts), CONV_DIGITS, RFC_DIGITS)


def _captured(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    payload = F.coalesce(F.col(html_col), F.lit(""))
    return pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        # no white space or control characters in a header line
        F.regexp_replace(F.coalesce(F.col(url_col), F.lit("")), r"[\x00-\x20\x7F]+", "%20").alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha1(payload.cast("binary")).alias("sha1"),
    )


def write_archives(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> str:
    """Write every row of ``pages`` as a record under ``path`` and return it.

    A null html is an empty payload, a null url an empty target. Repeated rows give a record each.
    """
    captured = _captured(pages, id_col, url_col, html_col)
    repeated = written(
        captured.where(F.col("payload_bytes") >= LEAST_REVISIT_BYTES)
        .groupBy("sha1", "payload_bytes")
        .agg(F.min("page_id").alias("first_id"), F.max("page_id").alias("last_id"))
        .where("first_id < last_id")
        .select("sha1", "payload_bytes", "first_id"),
        "payloads",
    )
    known = captured.join(repeated, ["sha1", "payload_bytes"], "left")
    revisit = F.col("first_id").isNotNull() & (F.col("first_id") != F.col("page_id"))
    date = F.date_format(
        F.timestamp_seconds(F.unix_timestamp(F.lit(FIRST_CAPTURE)) + F.col("page_id")), "yyyy-MM-dd'T'HH:mm:ss'Z'"
    )
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.col("payload_bytes"),
        F.lit(RECORD_END),
    )
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    record = F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: "),
        F.when(revisit, "revisit").otherwise("response"),
        F.lit(f"{CRLF}WARC-Record-ID: <{ID_PREFIX}"),
        F.col("page_id"),
        F.lit(f">{CRLF}WARC-Date: "),
        date,
        F.lit(f"{CRLF}WARC-Target-URI: "),
        F.col("url"),
        F.lit(f"{CRLF}WARC-Payload-Digest: sha1:"),
        sha1_base32(F.col("sha1")),
        F.when(
            revisit,
            F.concat(
                F.lit(f"{CRLF}WARC-Refers-To: <{ID_PREFIX}"),
                F.col("first_id"),
                F.lit(f">{CRLF}WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ),
        ).otherwise(""),
        F.lit(f"{CRLF}Content-Type: application/http; msgtype=response{CRLF}Content-Length: "),
        F.octet_length(block),
        F.lit(RECORD_END),
        block,
    )
    (
        known.select(record.alias("value"))
        .write.option("lineSep", RECORD_END)
        .option("maxRecordsPerFile", RECORDS_PER_ARCHIVE)
        .text(path)
    )
    return path


class BadArchive(ValueError):
    pass


def records(data: bytes) -> Iterator[tuple[int, dict[str, str], memoryview]]:
    """(offset, headers, block) of each record of an archive."""
    at, view, end = 0, memoryview(data), RECORD_END.encode()
    while at < len(data):
        head = data.find(end, at)
        if head < 0 or data[at : at + 5] != b"WARC/":
            raise BadArchive(f"no record at byte {at}")
        lines = data[at:head].decode().split(CRLF)[1:]
        headers = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        start = head + len(end)
        stop = start + int(headers["content-length"])
        if data[stop : stop + len(end)] != end:
            raise BadArchive(f"the record at byte {at} has another length than it says")
        yield at, headers, view[start:stop]
        at = stop + len(end)


_authority = re.compile(r"^(?:[a-z][a-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(?::(\d*))?", re.IGNORECASE)


def url_key(url: str) -> str:
    """Sort-friendly key: host labels from the top-level one down, then path and query in lower case, no fragment."""
    found = _authority.match(url)
    if not found:
        return url.partition("#")[0].lower()
    host, port = found[1].lower(), found[2]
    rest = url[found.end() :].partition("#")[0].lower() or "/"
    labels = host.split(".")
    if labels[0] == "www" and len(labels) > 2:
        labels = labels[1:]
    return ",".join(reversed(labels)) + (f":{port}" if port and port not in ("80", "443") else "") + ")" + rest


RUN_COLUMNS = (
    ("page_id", pa.int64(), "long"),
    ("url_key", pa.string(), "string"),
    ("timestamp", pa.string(), "string"),
    ("payload_bytes", pa.int64(), "long"),
    ("payload_digest", pa.string(), "string"),
    ("record_type", pa.string(), "string"),
    ("refers_to", pa.int64(), "long"),
    ("archive", pa.string(), "string"),
    ("archive_offset", pa.int64(), "long"),
    ("seq", pa.int64(), "long"),
)
RUN_SCHEMA = pa.schema([(n, t) for n, t, _ in RUN_COLUMNS])
RUN_DDL = ", ".join(f"{n} {d}" for n, _, d in RUN_COLUMNS)


def _page_id(field: str) -> int:
    return int(field.strip("<>").removeprefix(ID_PREFIX))


def index_archive(data: bytes, name: str) -> list[tuple]:
    """The archive's sorted run: one entry per record."""
    entries = []
    for offset, headers, block in records(data):
        head = bytes(block[:4096]).partition(RECORD_END.encode())[0]
        length = int(re.search(rb"content-length:\s*(\d+)", head, re.IGNORECASE)[1])
        digest = headers["warc-payload-digest"].removeprefix("sha1:")
        kind = headers["warc-type"]
        if kind == "response":
            payload = block[len(head) + len(RECORD_END) :]
            if len(payload) != length or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                raise BadArchive(f"{name}: the payload at byte {offset} is not what its record says")
        refers = _page_id(headers["warc-refers-to"]) if "warc-refers-to" in headers else None
        stamp = re.sub(r"\D", "", headers["warc-date"])
        entries.append(
            (_page_id(headers["warc-record-id"]), url_key(headers["warc-target-uri"]), stamp, length, digest, kind, refers, name, offset)
        )
    entries.sort(key=lambda e: (e[1], e[2], e[0]))
    return [(*e, k) for k, e in enumerate(entries)]


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The sorted runs of all archives under ``path``; an archive is read whole by one task."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0), batch.column(1)):
                rows = index_archive(data.as_buffer().to_pybytes(), name.as_py().rpartition("/")[2])
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), RUN_SCHEMA.types)], schema=RUN_SCHEMA
                    )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(index, RUN_DDL)


class LoserTree:
    """Merges sorted sequences: each inner node keeps the loser of the match below it, the winner goes up."""

    def __init__(self, runs: Sequence[Iterator]):
        self.runs = [iter(r) for r in runs]
        self.heads = [next(r, None) for r in self.runs]
        n = len(self.runs)
        self.losers = [-1] * max(n, 1)
        self.winner = self._play(1) if n > 1 else 0

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or x is not None and (x, a) <= (y, b)

    def _play(self, node: int) -> int:
        n = len(self.runs)
        if node >= n:
            return node - n
        a, b = self._play(2 * node), self._play(2 * node + 1)
        won, lost = (a, b) if self._beats(a, b) else (b, a)
        self.losers[node] = lost
        return won

    def __iter__(self):
        n = len(self.runs)
        while n and (head := self.heads[self.winner]) is not None:
            yield head
            run = self.winner
            self.heads[run] = next(self.runs[run], None)
            node = (run + n) // 2
            while node:
                if self._beats(self.losers[node], run):
                    self.losers[node], run = run, self.losers[node]
                node //= 2
            self.winner = run


def merge_runs(runs: DataFrame) -> DataFrame:
    """All index entries in global order; adds ``shard`` and ``position``, drops ``seq``."""
    keys = ("url_key", "timestamp", "page_id")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [batch for batch in batches if len(batch)]
        if not parts:
            return
        slices = pa.Table.from_batches(parts)
        names, columns = slices["archive"].to_pylist(), [slices[k].to_pylist() for k in keys]
        starts = [k for k in range(len(names)) if k == 0 or names[k] != names[k - 1]] + [len(names)]
        tree = LoserTree(
            [zip(*(c[a:b] for c in columns), range(a, b)) for a, b in zip(starts, starts[1:])]  # rows of a run are in its order
        )
        order = [entry[3] for entry in tree]
        merged = slices.take(pa.array(order, pa.int64())).drop_columns(["seq"])
        yield from merged.append_column("position", pa.array(range(len(order)), pa.int64())).to_batches(10_000)

    dealt = (
        runs.repartitionByRange(*keys)
        .withColumn("shard", F.spark_partition_id().cast("long"))
        .sortWithinPartitions("archive", "seq")
    )
    ddl = ", ".join(f"{n} {d}" for n, _, d in RUN_COLUMNS if n != "seq") + ", shard long, position long"
    return dealt.mapInArrow(merge, ddl)


def capture_histories(pages: DataFrame, path: str | None = None, **columns: str) -> DataFrame:
    """Write ``pages`` to archives, read them back and merge their runs: one row per page row.

    Without ``path`` the archives go to a new folder under the shared checkpoint folder. An empty table gives no rows.
    """
    spark = pages.sparkSession
    path = write_archives(pages, path or scratch_path(spark, "reelstat-tables", f"warc-{uuid.uuid4().hex}"), **columns)
    return merge_runs(written(read_runs(spark, path), "capture-runs"))
