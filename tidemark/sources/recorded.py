"""Recorded messages as a stream, and byte ranges of files: two Python data sources.

``recorded`` replays what a recorder of subscriptions has written: ``segment=k/chunk=c/*.parquet``, a segment being a span
of arrivals and a chunk the subscription of up to 20 markets. Offsets are segments. A micro-batch takes ``step`` segments,
one task for each segment and chunk, so a batch is bounded and read in parallel. What has been committed is noted in the
folder ``progress``: a reader that starts again goes on from there. Spark's own checkpoint decides where a batch begins,
so nothing is lost or read twice; after a restart the first batch may hold up to twice the segments.

``ranges`` reads bytes by a plan: rows (file, start, end) become as few requests as the gaps between them allow, each
request one task's, and come back cut as planned.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.operators import windows

#: Fixed: markets of one subscription message.
SUBSCRIBE = 20


def opened(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a path or address, and the path in it."""
    return pyarrow.fs.FileSystem.from_uri(path if "://" in path else f"file://{path}" if not path.startswith("file:") else "file://" + path[5:])


def chunk_of(markets: DataFrame, market: str = "market_ticker", size: int = SUBSCRIBE) -> DataFrame:
    """(market, chunk): markets in order, ``size`` to a subscription. Markets are named once here, so there are few."""
    names = markets.select(market).distinct()
    return names.withColumn("chunk", F.floor((F.row_number().over(Window.orderBy(market)) - 1) / size).cast("int"))


def bounded(messages: DataFrame, span: Column, order: str, rows: int) -> DataFrame:
    """Adds ``segment``: spans in order, each cut along ``order`` into segments of at most ``rows`` messages, numbered from 0."""
    d = windows.running_sum(messages.withColumns({"__span": span, "__one": F.lit(1).cast("long")}), ["__span"], [order], "__one", "__upto")
    d = d.withColumn("__part", F.floor((F.col("__upto") - 1) / rows)).drop("__one", "__upto")
    place = Window.orderBy("__span", "__part")  # a row a segment
    parts = d.select("__span", "__part").distinct().select(F.struct("__span", "__part").alias("__s"), (F.row_number().over(place) - 1).alias("segment"))
    return d.join(F.broadcast(parts), F.struct("__span", "__part") == F.col("__s")).drop("__span", "__part", "__s")


def record(messages: DataFrame, segment: Column, path: str, market: str = "market_ticker") -> int:
    """Writes messages as a recorder would; returns how many segments there are."""
    chunks = chunk_of(messages, market).withColumnRenamed(market, "__m")
    m = messages.withColumn("segment", segment.cast("int")).join(chunks, F.col(market) == F.col("__m")).drop("__m")
    m.repartition("segment", "chunk").write.partitionBy("segment", "chunk").parquet(path)
    return (m.agg(F.max("segment")).first()[0] if not m.isEmpty() else -1) + 1


class Piece(InputPartition):
    """A chunk of a segment."""

    def __init__(self, folder: str):
        self.folder = folder


class RecordedReader(DataSourceStreamReader):
    def __init__(self, schema, options: dict):
        self.schema, self.options = schema, dict(options)
        self.step = int(self.options.get("step", 1))
        self.at: int | None = None

    def initialOffset(self) -> dict:
        return {"segment": 0}

    def _committed(self) -> int:
        fs, path = opened(self.options["progress"])
        if fs.get_file_info(f"{path}/committed").type == pyarrow.fs.FileType.NotFound:
            return 0
        with fs.open_input_stream(f"{path}/committed") as f:
            return json.loads(f.read())["segment"]

    def latestOffset(self) -> dict:
        end = int(self.options["segments"])
        if self.at is None:  # the note may be one batch behind Spark's checkpoint, so the first batch reaches farther
            done = self._committed()
            return {"segment": min(end, done + self.step * (2 if done else 1))}
        return {"segment": min(end, self.at + self.step)}

    def partitions(self, start: dict, end: dict) -> list[Piece]:
        self.at = end["segment"]
        fs, path = opened(self.options["path"])
        found = []
        for k in range(start["segment"], end["segment"]):
            some = pyarrow.fs.FileSelector(f"{path}/segment={k}", allow_not_found=True)
            found += [Piece(f"segment={k}/{x.base_name}") for x in fs.get_file_info(some) if x.type == pyarrow.fs.FileType.Directory]
        return sorted(found, key=lambda p: p.folder)

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        fs, path = opened(self.options["path"])
        kind = to_arrow_schema(self.schema)
        for x in fs.get_file_info(pyarrow.fs.FileSelector(f"{path}/{partition.folder}")):
            if x.path.endswith(".parquet"):
                with fs.open_input_file(x.path) as f:
                    for b in pyarrow.parquet.ParquetFile(f, coerce_int96_timestamp_unit="us").iter_batches(columns=kind.names):
                        yield from pa.Table.from_batches([b.select(kind.names)]).cast(kind).to_batches()

    def commit(self, end: dict) -> None:
        fs, path = opened(self.options["progress"])
        fs.create_dir(path, recursive=True)
        with fs.open_output_stream(f"{path}/committed.new") as f:
            f.write(json.dumps(end).encode())
        fs.move(f"{path}/committed.new", f"{path}/committed")


class RecordedSource(DataSource):
    """``readStream.format("recorded")`` with a schema, ``path``, ``segments``, ``progress`` and ``step``."""

    @classmethod
    def name(cls) -> str:
        return "recorded"

    def streamReader(self, schema) -> RecordedReader:
        return RecordedReader(schema, self.options)


def packed(rows: DataFrame, content: str, folder: str) -> DataFrame:
    """Writes the binary column ``content`` end to end, a file for each partition; the other columns with (file, start, end), end included.

    A file is named by its partition, so a task that runs again writes the same one. Stage the result: reading it writes.
    """
    others = [c for c in rows.columns if c != content]
    framed = rows.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), F.col(f"`{content}`").alias("content"))

    def run(it):
        name, at = f"{folder}/part-{TaskContext.get().partitionId():06d}", 0
        fs, path = opened(name)
        fs.create_dir(path.rpartition("/")[0], recursive=True)
        with fs.open_output_stream(path) as f:
            for b in it:
                start, end = [], []
                for x in b.column(1):
                    raw = x.as_py() or b""
                    f.write(raw)
                    start.append(at)
                    at += len(raw)
                    end.append(at - 1)
                yield pa.record_batch([b.column(0), pa.array([name] * len(start), pa.string()), pa.array(start, pa.int64()), pa.array(end, pa.int64())], names=["row", "file", "start", "end"])

    schema = StructType([framed.schema["row"], *StructType.fromDDL("file string, start bigint, end bigint").fields])
    return framed.mapInArrow(run, schema).select("row.*", "file", "start", "end")


def merged_ranges(plan: DataFrame, gap: int, most: int) -> DataFrame:
    """(file, from, to, parts array<struct<start,end>>): requests for (file, start, end), ends included.

    Ranges of a file closer than ``gap`` bytes share a request, as long as it stays within a window of ``most`` bytes.
    """
    w = Window.partitionBy("file", "window").orderBy("start", "end")
    d = plan.select("file", "start", "end").distinct().withColumn("window", F.floor(F.col("start") / most))
    reach = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    d = d.withColumn("new", F.when(F.col("start") <= reach + 1 + gap, 0).otherwise(1))
    d = d.withColumn("request", F.sum("new").over(w))
    g = d.groupBy("file", "window", "request").agg(F.min("start").alias("from"), F.max("end").alias("to"), F.sort_array(F.collect_list(F.struct("start", "end"))).alias("parts"))
    return g.select("file", "from", "to", "parts")


class Request(InputPartition):
    """A file of the plan."""

    def __init__(self, file: str):
        self.file = file


class RangeReader(DataSourceReader):
    """Reads a plan that ``read_ranges`` has written: each of its files is one task's requests."""

    def __init__(self, options: dict):
        self.options = dict(options)

    def partitions(self) -> list[Request]:
        fs, path = opened(self.options["plan"])
        return [Request(x.path) for x in fs.get_file_info(pyarrow.fs.FileSelector(path)) if x.path.endswith(".parquet")]

    def read(self, partition: Request) -> Iterator[tuple]:
        fs, _ = opened(self.options["plan"])
        with fs.open_input_file(partition.file) as f:
            for batch in pyarrow.parquet.ParquetFile(f).iter_batches(256):
                for r in batch.to_pylist():
                    store, path = opened(r["file"])
                    with store.open_input_file(path) as data:
                        raw = data.read_at(r["to"] - r["from"] + 1, r["from"])
                    for p in r["parts"]:
                        yield r["file"], p["start"], p["end"], raw[p["start"] - r["from"] : p["end"] - r["from"] + 1], r["from"], r["to"]


class RangeSource(DataSource):
    """``format("ranges")`` with ``plan``, a folder of Parquet files of merged requests."""

    @classmethod
    def name(cls) -> str:
        return "ranges"

    def schema(self) -> str:
        return "file string, start bigint, end bigint, bytes binary, from bigint, to bigint"

    def reader(self, schema) -> RangeReader:
        return RangeReader(self.options)


def read_ranges(plan: DataFrame, folder: str, gap: int = 1 << 16, most: int = 64 << 20, tasks: int | None = None) -> DataFrame:
    """(file, start, end, bytes, from, to) of a plan (file, start, end): each range's bytes, and the request they came with.

    A range beyond the end of its file gives the bytes that are there. ``folder``: where the merged plan is written.
    """
    spark = plan.sparkSession
    requests = merged_ranges(plan, gap, most)
    requests.repartition(tasks or spark.sparkContext.defaultParallelism * 2, "file", "from").write.parquet(folder)
    spark.dataSource.register(RangeSource)
    return spark.read.format("ranges").option("plan", folder).load()
