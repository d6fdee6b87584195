"""``ratings_bin``: the 10-byte little-endian rating record file as a Spark data source.

Reader: files (a file or a folder of ``*.bin`` / any files, taken in path
order) are cut into byte ranges at multiples of 10 bytes, one input partition
per range, read with ``pyarrow.fs`` (local, HDFS, object stores) and decoded
by a NumPy structured dtype into Arrow record batches — no per-row Python. A
partial trailing record is ignored (``size // 10`` records). ``row_no`` is the
record's position across all files, so positional operators need no sort.

Writer: each task packs its Arrow batches into records and writes one part
file under a task-attempt name; the driver's commit renames the winners to
``part-<number>-<job>.bin`` (file order = task order = input order), so a retried or
speculative task leaves no duplicate. Appended parts are numbered on from those that are there.
Numbers in paths are compared as numbers. A value outside a record's field is an error;
only rating and category are narrowed to a byte (P9).

With the option ``wide`` a user, movie or date that the 10 bytes cannot hold is no error: from the first batch that has
one, a task writes 18-byte records (``WIDE_DTYPE``) to a second part ``part-<number>-<job>.wide.bin``, which follows its
first. The reader tells the two apart by name.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
    WriterCommitMessage,
)

from ..schema import RECORD_DTYPE, WIDE_RECORD_DTYPE

SCHEMA = "user_id long, movie_id int, date int, rating int, category int, row_no long"
DTYPE, WIDE_DTYPE = np.dtype(RECORD_DTYPE), np.dtype(WIDE_RECORD_DTYPE)
WIDE = ".wide.bin"   # ending of the files of wide records
DEFAULT_SPLIT_BYTES = 64 * 1024 * 1024
BATCH_RECORDS = 1 << 20


def _fs(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _list(path: str) -> list[tuple[str, int]]:
    """(path, size) of the data files under ``path``, in path order with numbers compared as numbers."""
    from pyarrow import fs

    filesystem, root = _fs(path)
    info = filesystem.get_file_info(root)
    if info.type == fs.FileType.File:
        return [(root, info.size)]
    out = []
    for f in filesystem.get_file_info(fs.FileSelector(root, recursive=True)):
        rel = f.path[len(root.rstrip("/")) + 1:].split("/")
        if f.type == fs.FileType.File and not any(p.startswith(("_", ".")) for p in rel):
            out.append((f.path, f.size))
    return sorted(out, key=lambda f: path_order(f[0]))


def path_order(path: str) -> list:
    """Sort key of a path: its digit runs count as numbers, so part-99999 comes before part-100000."""
    return [int(x) if x.isdigit() else x for x in re.split(r"([0-9]+)", path)]


def _dtype(path: str) -> np.dtype:
    return WIDE_DTYPE if path.endswith(WIDE) else DTYPE


class _Range(InputPartition):
    def __init__(self, uri: str, path: str, first: int, count: int, row0: int):
        super().__init__(None)
        self.uri, self.path, self.first, self.count, self.row0 = uri, path, first, count, row0


FIELDS = {"user_id": "user", "movie_id": "movie", "date": "date", "rating": "rating", "category": "category"}


def decode(buf: bytes | memoryview, row0: int = 0, keep: dict | None = None, dtype: np.dtype = DTYPE) -> pa.RecordBatch:
    """Records → Arrow batch (F1: little-endian u32/u16/u16/u8/u8).

    ``keep`` maps a column to the set of values to keep (pushed-down filters).
    """
    rec = np.frombuffer(buf, dtype=dtype)
    row_no = np.arange(row0, row0 + len(rec), dtype=np.int64)
    if keep:
        mask = np.ones(len(rec), dtype=bool)
        for column, values in keep.items():
            mask &= np.isin(rec[FIELDS[column]], np.array(sorted(values)))
        rec, row_no = rec[mask], row_no[mask]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(rec["user"].astype(np.int64)),
            pa.array(rec["movie"].astype(np.int32)),
            pa.array(rec["date"].astype(np.int32)),
            pa.array(rec["rating"].astype(np.int32)),
            pa.array(rec["category"].astype(np.int32)),
            pa.array(row_no),
        ],
        names=["user_id", "movie_id", "date", "rating", "category", "row_no"],
    )


def fits(batch: pa.RecordBatch) -> bool:
    """Whether 10-byte records can hold every user, movie and date of the batch (nulls aside)."""
    for name in ("user_id", "movie_id", "date"):
        ends = pc.min_max(batch.column(name)).as_py()
        if ends["min"] is not None and (ends["min"] < 0 or ends["max"] > np.iinfo(DTYPE[FIELDS[name]]).max):
            return False
    return True


def encode(batch: pa.RecordBatch, dtype: np.dtype = DTYPE) -> bytes:
    """Arrow batch → packed records (rating and category narrowed to u8).

    Raises ``ValueError`` on a null and on a user, movie or date that its field cannot hold.
    """
    rec = np.empty(batch.num_rows, dtype=dtype)
    for i, name in enumerate(batch.schema.names):
        column, target = batch.column(i), FIELDS[name]
        if column.null_count:
            raise ValueError(f"{name} is null in a rating record")
        values = column.to_numpy(zero_copy_only=False)
        if name in ("rating", "category"):
            values = np.mod(values, 256)
        field = np.iinfo(dtype[target])
        if len(values) and (values.min() < field.min or values.max() > field.max):
            raise ValueError(f"{name} must be {field.min}..{field.max} in a rating record, not {values.min()}..{values.max()}")
        rec[target] = values
    return rec.tobytes()


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.split_bytes = int(options.get("splitBytes", DEFAULT_SPLIT_BYTES))
        self.lo, self.hi = 0, None   # row_no range [lo, hi) from pushed filters
        self.keep: dict = {}         # column -> allowed values from pushed filters

    def pushFilters(self, filters):
        """Row-position ranges cut whole byte ranges; equality / IN on fields mask in the task."""
        for f in filters:
            col = f.attribute[0] if len(f.attribute) == 1 else None
            if col == "row_no" and isinstance(f, (LessThan, LessThanOrEqual, GreaterThan, GreaterThanOrEqual, EqualTo)):
                v = int(f.value)
                if isinstance(f, (LessThan, LessThanOrEqual, EqualTo)):
                    cap = v if isinstance(f, LessThan) else v + 1
                    self.hi = cap if self.hi is None else min(self.hi, cap)
                if isinstance(f, (GreaterThan, GreaterThanOrEqual, EqualTo)):
                    self.lo = max(self.lo, v + 1 if isinstance(f, GreaterThan) else v)
            elif col in FIELDS and isinstance(f, (EqualTo, In)):
                vals = {f.value} if isinstance(f, EqualTo) else set(f.value)
                vals = {int(x) for x in vals if x is not None}
                self.keep[col] = self.keep.get(col, vals) & vals
            else:
                yield f

    def partitions(self):
        parts, row0 = [], 0
        for path, size in _list(self.path):
            record = _dtype(path).itemsize
            n = size // record  # a partial trailing record is ignored
            per_split = max(1, self.split_bytes // record)
            for first in range(0, n, per_split):
                count = min(per_split, n - first)
                a, b = max(row0 + first, self.lo), row0 + first + count
                if self.hi is not None:
                    b = min(b, self.hi)
                if a < b:
                    parts.append(_Range(self.path, path, a - row0, b - a, a))
            row0 += n
        return parts or [_Range(self.path, "", 0, 0, 0)]

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        if partition.count == 0:
            return
        filesystem, _ = _fs(partition.uri)
        dtype = _dtype(partition.path)
        with filesystem.open_input_file(partition.path) as f:
            done = 0
            while done < partition.count:
                n = min(BATCH_RECORDS, partition.count - done)
                buf = f.read_at(n * dtype.itemsize, (partition.first + done) * dtype.itemsize)
                yield decode(buf, partition.row0 + done, self.keep, dtype)
                done += n


class _Commit(WriterCommitMessage):
    def __init__(self, task: int, paths: list[str]):
        self.task, self.paths = task, paths


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path = options["path"].rstrip("/")
        self.overwrite = overwrite
        self.wide = options.get("wide", "false") == "true"
        self.job = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Commit:
        from pyspark import TaskContext

        ctx = TaskContext.get()
        task = ctx.partitionId() if ctx else 0
        attempt = ctx.attemptNumber() if ctx else 0
        filesystem, root = _fs(self.path)
        tmp = f"{root}/_temporary/{self.job}/part-{task:010d}-{attempt}"
        filesystem.create_dir(f"{root}/_temporary/{self.job}", recursive=True)
        paths = [f"{tmp}.bin"]
        out = filesystem.open_output_stream(paths[0])
        try:
            for batch in iterator:
                if self.wide and len(paths) == 1 and not fits(batch):
                    out.close()
                    paths.append(tmp + WIDE)
                    out = filesystem.open_output_stream(paths[1])
                if batch.num_rows:
                    out.write(encode(batch, _dtype(paths[-1])))
        finally:
            out.close()
        return _Commit(task, paths)

    def commit(self, messages) -> None:
        filesystem, root = _fs(self.path)
        from pyarrow import fs

        first = 0
        for f in filesystem.get_file_info(fs.FileSelector(root, allow_not_found=True)):
            if f.type == fs.FileType.File and (number := re.match(r"part-([0-9]+)", f.base_name)):
                if self.overwrite:
                    filesystem.delete_file(f.path)
                else:
                    first = max(first, int(number[1]) + 1)
        for m in messages:
            for path in m.paths if m is not None else ():
                ending = WIDE if path.endswith(WIDE) else ".bin"
                filesystem.move(path, f"{root}/part-{first + m.task:010d}-{self.job[:8]}{ending}")
        filesystem.delete_dir(f"{root}/_temporary/{self.job}")

    def abort(self, messages) -> None:
        filesystem, root = _fs(self.path)
        if filesystem.get_file_info(f"{root}/_temporary/{self.job}").type.name == "Directory":
            filesystem.delete_dir(f"{root}/_temporary/{self.job}")


class RatingsBinary(DataSource):
    """``spark.read.format("ratings_bin").load(path)`` / ``df.write.format("ratings_bin").save(path)``."""

    @classmethod
    def name(cls) -> str:
        return "ratings_bin"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options, overwrite)


def register(spark) -> None:
    """Register the source; its classes travel to executors by value (no package install there)."""
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(RatingsBinary)
    # let the source see filters (positions prune byte ranges; field filters mask in the task)
    if spark.conf.get("spark.sql.python.filterPushdown.enabled", "false") != "true":
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_ratings_bin(spark, path: str, category: int | None = None, split_bytes: int | None = None):
    """The records of ``path`` (optionally one category, P4)."""
    register(spark)
    r = spark.read.format("ratings_bin")
    if split_bytes:
        r = r.option("splitBytes", str(split_bytes))
    df = r.load(path)
    return df if category is None else df.where(df.category == category)


def write_ratings_bin(df, path: str, mode: str = "overwrite", wide: bool = False) -> None:
    """K1 (byte form): records in the frame's partition order; ``mode`` overwrite or append.

    ``wide`` lets rows whose ids or date a 10-byte record cannot hold be stored, as 18-byte records.
    """
    register(df.sparkSession)
    df.select("user_id", "movie_id", "date", "rating", "category").write.format("ratings_bin").option(
        "wide", str(wide).lower()).mode(mode).save(path)
