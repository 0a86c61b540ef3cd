"""``kvbatch``: a Spark Python data source that writes rows to a key-value
store in fixed-size batches (K3-K5, K9).

Each Spark task walks its partition once, cuts it into batches of
``batch_size`` rows (a new batch also starts when the ``group_by`` column
changes, so batches never span groups) and hands every batch to a client
built on the executor from ``client='package.module:factory'``.  Profiles:

``batch_retry`` (default size 25)
    ``client.batch_write(table, items) -> unprocessed items``; the rest is
    resent after 1, 2, 4 ... s (capped at ``max_sleep``, with jitter) and the
    task fails after ``max_retries`` resends.
``multi_put`` (default size 200)
    ``client.put_multi(table, keys, items)``: one all-or-nothing call per
    batch; ``key`` names the key column.
``per_row`` (default size 1000)
    ``client.put(table, key, item)``: one insert-or-replace call per row.

Keyed puts are idempotent, so Spark's task retries and speculation give
at-least-once delivery with a last-write-wins result; apply
``operators.latest_by_key`` first when a key may repeat.

Option ``report`` names a shared folder for the progress of the write (B2):
each task writes a row for each batch, ``(part, group, batch, rows, resends)``,
to a file of its own, and the commit lists the files of the tasks that count, so
a retried task's rows are not read twice; `write_report` gives the rows back as
a table.  Only one name and three totals a task go through the driver.

Required options are checked on the driver before any data is read
(``table`` and ``client``; ``key`` for ``multi_put``/``per_row``; any
name listed in ``require``).  Options prefixed ``client.`` are passed to
the factory as keyword arguments.
"""

from __future__ import annotations

import importlib
import json
import random
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

PROFILE_SIZES = {"batch_retry": 25, "multi_put": 200, "per_row": 1000}


@dataclass
class KVCommit(WriterCommitMessage):
    rows: int
    batches: int
    resends: int
    report: str | None = None  # the task's report file


class KVBatchDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "kvbatch"

    def writer(self, schema: StructType, overwrite: bool) -> "KVBatchWriter":
        return KVBatchWriter(dict(self.options), schema)


def _load_factory(path: str):
    module, _, attr = path.partition(":")
    if not module or not attr:
        raise ValueError(f"client must look like 'package.module:factory', got {path!r}")
    return getattr(importlib.import_module(module), attr)


def _map_fixer(dtype: DataType):
    """Arrow gives maps as lists of (key, value) pairs; the client gets
    dicts, as a record would have them.  ``None`` when no map is inside."""
    if isinstance(dtype, MapType):
        inner = _map_fixer(dtype.valueType)
        return lambda v: None if v is None else {k: (inner(x) if inner else x) for k, x in v}
    if isinstance(dtype, StructType):
        fixers = {f.name: _map_fixer(f.dataType) for f in dtype.fields}
        fixers = {k: f for k, f in fixers.items() if f}
        if not fixers:
            return None
        return lambda v: None if v is None else {k: (fixers[k](x) if k in fixers else x) for k, x in v.items()}
    if isinstance(dtype, ArrayType):
        inner = _map_fixer(dtype.elementType)
        return (lambda v: None if v is None else [inner(x) for x in v]) if inner else None
    return None


class KVBatchWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], schema: StructType):
        opts = {k.lower(): v for k, v in options.items()}
        self.profile = opts.get("profile", "batch_retry")
        if self.profile not in PROFILE_SIZES:
            raise ValueError(f"unknown profile {self.profile!r}")
        required = ["table", "client"] + (["key"] if self.profile != "batch_retry" else [])
        required += [r.strip().lower() for r in opts.get("require", "").split(",") if r.strip()]
        missing = [r for r in required if not opts.get(r)]
        if missing:
            raise ValueError(f"kvbatch: required option(s) missing: {', '.join(missing)}")
        self.table = opts["table"]
        self.client_path = opts["client"]
        # one column, or several for a store whose key has parts
        self.key = [k.strip() for k in opts.get("key", "").split(",") if k.strip()]
        for k in self.key:
            if k not in schema.fieldNames():
                raise ValueError(f"kvbatch: key column {k!r} not in the data")
        self.group_by = [g.strip() for g in opts["group_by"].split(",")] if opts.get("group_by") else None
        for g in self.group_by or []:
            if g not in schema.fieldNames():
                raise ValueError(f"kvbatch: group_by column {g!r} not in the data")
        self.batch_size = int(opts.get("batch_size", PROFILE_SIZES[self.profile]))
        if self.batch_size <= 0:
            raise ValueError("kvbatch: batch_size must be positive")
        self.max_retries = int(opts.get("max_retries", "8"))
        self.base_sleep = float(opts.get("base_sleep", "1.0"))
        self.max_sleep = float(opts.get("max_sleep", "30.0"))
        self.client_kwargs = {k[len("client."):]: v for k, v in opts.items() if k.startswith("client.")}
        self.report = opts.get("report")
        self.fix = _map_fixer(schema)
        # layout columns (group, batch number) used for cutting batches but
        # not sent to the store
        self.exclude = [c.strip() for c in opts.get("exclude", "").split(",") if c.strip()]
        _load_factory(self.client_path)  # fail fast on the driver

    # -- executor side -------------------------------------------------
    def _items(self, record_batches: Iterator) -> Iterator[dict]:
        # one C++ conversion per Arrow batch instead of one Row per record
        for rb in record_batches:
            items = rb.to_pylist()
            yield from (map(self.fix, items) if self.fix else items)

    def _batches(self, record_batches: Iterator) -> Iterator[tuple[tuple, list[dict]]]:
        """``(group, items)`` of every batch."""
        if self.group_by is None:
            yield from (((), batch) for batch in self._fixed_batches(record_batches))
            return
        batch: list[dict] = []
        current = object()
        for item in self._items(record_batches):
            if self.group_by is not None:
                g = tuple(item.get(k) for k in self.group_by)
                if batch and g != current:
                    yield current, batch
                    batch = []
                current = g
            if self.exclude:
                item = {k: v for k, v in item.items() if k not in self.exclude}
            batch.append(item)
            if len(batch) >= self.batch_size:
                yield current, batch
                batch = []
        if batch:
            yield current, batch

    def _fixed_batches(self, record_batches: Iterator) -> Iterator[list[dict]]:
        """Fixed-size batches without groups: list slices per Arrow batch,
        no per-row loop."""
        carry: list[dict] = []
        size = self.batch_size
        for rb in record_batches:
            rows = rb.to_pylist()
            if self.fix:
                rows = [self.fix(r) for r in rows]
            if self.exclude:
                rows = [{k: v for k, v in r.items() if k not in self.exclude} for r in rows]
            if carry:
                rows = carry + rows
            full = len(rows) - len(rows) % size
            for lo in range(0, full, size):
                yield rows[lo:lo + size]
            carry = rows[full:]
        if carry:
            yield carry

    def _send_with_retry(self, client, items: list[dict]) -> int:
        resends = 0
        pending = items
        sleep = self.base_sleep
        while True:
            pending = list(client.batch_write(self.table, pending) or [])
            if not pending:
                return resends
            if resends >= self.max_retries:
                raise RuntimeError(f"kvbatch: {len(pending)} item(s) still unprocessed after {resends} resends")
            resends += 1
            time.sleep(min(self.max_sleep, sleep) * (0.5 + random.random() / 2))
            sleep *= 2

    def _key(self, item: dict) -> str | tuple[str, ...]:
        """The store key: text, or a tuple of texts for a key with parts."""
        parts = tuple(str(item[k]) for k in self.key)
        return parts[0] if len(parts) == 1 else parts

    def write(self, iterator: Iterator) -> KVCommit:
        client = _load_factory(self.client_path)(**self.client_kwargs)
        rows = batches = resends = 0
        report = _Report(self.report) if self.report else None
        try:
            for group, batch in self._batches(iterator):
                again = 0
                if self.profile == "batch_retry":
                    again = self._send_with_retry(client, batch)
                elif self.profile == "multi_put":
                    client.put_multi(self.table, [self._key(b) for b in batch], batch)
                else:
                    for item in batch:
                        client.put(self.table, self._key(item), item)
                rows += len(batch)
                batches += 1
                resends += again
                if report:
                    report.add(group, len(batch), again)
        finally:
            close = getattr(client, "close", None)
            if close:
                close()
        return KVCommit(rows=rows, batches=batches, resends=resends, report=report.close() if report else None)

    # -- driver side ---------------------------------------------------
    def commit(self, messages: list[KVCommit]) -> None:
        done = [m for m in messages if m]
        self.totals = (sum(m.rows for m in done), sum(m.batches for m in done), sum(m.resends for m in done))
        if self.report:
            filesystem, path = _open(self.report)
            with filesystem.open_output_stream(f"{path}/committed.json") as f:
                f.write("".join(json.dumps({"file": m.report, "rows": m.rows}) + "\n" for m in done if m.report).encode())

    def abort(self, messages: list[KVCommit]) -> None:
        pass


_REPORT = pa.schema([("part", pa.string()), ("group", pa.list_(pa.string())), ("batch", pa.int64()), ("rows", pa.int64()), ("resends", pa.int64())])
_REPORT_DDL = "part string, `group` array<string>, batch bigint, rows bigint, resends bigint"
_REPORT_ROWS = 1 << 14


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    uri = folder if "://" in folder or folder.startswith("/") else folder.replace("file:", "", 1)
    filesystem, path = fs.FileSystem.from_uri(uri)
    return filesystem, path.rstrip("/")


class _Report:
    """The batches of one task attempt, written as they are sent."""

    def __init__(self, folder: str):
        filesystem, path = _open(folder)
        filesystem.create_dir(path, recursive=True)
        self.name = f"part-{uuid.uuid4().hex}.parquet"
        self.stream = filesystem.open_output_stream(f"{path}/{self.name}")
        self.writer = pq.ParquetWriter(self.stream, _REPORT)
        self.rows: list[tuple] = []
        self.n = 0

    def add(self, group: tuple, rows: int, resends: int) -> None:
        self.rows.append((self.name, [None if g is None else str(g) for g in group], self.n, rows, resends))
        self.n += 1
        if len(self.rows) == _REPORT_ROWS:
            self._flush()

    def _flush(self) -> None:
        columns = zip(*self.rows, strict=True) if self.rows else [[]] * len(_REPORT)
        self.writer.write_table(pa.table([pa.array(c, t) for c, t in zip(columns, _REPORT.types, strict=True)], schema=_REPORT))
        self.rows = []

    def close(self) -> str:
        self._flush()
        self.writer.close()
        self.stream.close()
        return self.name


def write_report(spark: SparkSession, folder: str) -> DataFrame:
    """``(part, group, batch, rows, resends)`` of the batches of a finished
    ``kvbatch`` write with option ``report``: ``group`` has the values of
    ``group_by`` as text and ``batch`` numbers a task's batches from 0."""
    committed = spark.read.schema("file string, rows bigint").json(f"{folder.rstrip('/')}/committed.json")
    parts = spark.read.schema(_REPORT_DDL).option("pathGlobFilter", "part-*.parquet").parquet(folder)
    return parts.join(committed.select(F.col("file").alias("part")), "part", "left_semi")


def progress(report: DataFrame, group: int = 1, number: int | None = 1) -> DataFrame:
    """Progress rows of a write report, as `operators.batch_report` counts them
    ahead: ``(group, batch, lo, hi, pct)``.  ``group``: how many of the group
    values name the group; ``number``: which of them numbers its batches (None:
    the task's own numbers)."""
    number_col = F.col("batch") if number is None else F.get("group", F.lit(number)).cast("bigint")
    rows = report.select(F.slice("group", 1, F.lit(group)).alias("group"), number_col.alias("batch"), "rows")
    batches = rows.groupBy("group", "batch").agg(F.sum("rows").alias("rows"))
    totals = batches.groupBy("group").agg(F.sum("rows").alias("total"))
    upto = Window.partitionBy("group").orderBy("batch").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = batches.join(totals, "group").withColumn("hi", F.sum("rows").over(upto))
    return out.select("group", "batch", (F.col("hi") - F.col("rows")).alias("lo"), "hi", F.round(F.col("hi") * 100.0 / F.col("total"), 2).alias("pct"))


def register(spark) -> None:
    """Make ``df.write.format('kvbatch')`` available in this session."""
    spark.dataSource.register(KVBatchDataSource)
