"""A change log addressed by position, and a streaming source with its own offsets.

The log is a folder of segments, ``<log>/segment=<first>-<last>-<rows>/*.parquet``, in envelope form plus ``position``,
a growing number that the source database gives to each change (gaps are allowed). ``append_segment`` writes a
segment aside and renames it into place, so a reader sees whole segments only.

``position_feed`` reads it as a stream whose offset is ``{"position": n}``: everything up to n has been read. A
query starts after any position and restarts from the one in its checkpoint. Planning needs the
names of the segments, not their files; a batch opens the segments of its range only. A batch takes whole segments
until it has ``max_rows``, at least one. Spark does not tell such a source where a restarted query stands when it
asks for the next offset, so the last planned position is kept in a file of the stream; a crash between that file and
Spark's own offset log makes one batch of up to twice the limit. An ``availableNow`` run takes one such batch.

The tasks read through pyarrow's file systems (local paths, hdfs, s3, gs).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tidemart.session import _fs, child_names
from tidemart.streaming.apply import ENVELOPE

POSITION = "position"
SCHEMA = T.StructType([T.StructField(POSITION, T.LongType()), *[T.StructField(f.name, f.dataType) for f in ENVELOPE.fields]])
NAME = "position_log"


def segments(spark: SparkSession, log: str) -> list[tuple[int, int, int]]:
    """(first, last, rows) of each segment, in order."""
    return sorted(tuple(int(x) for x in n[len("segment="):].split("-")) for n in child_names(spark, log) if n.startswith("segment="))


def append_segment(df: DataFrame, log: str) -> None:
    """Add change records (envelope columns and ``position``) as the next segment; their positions must be
    larger than all before. No rows add nothing. One writer at a time."""
    spark, log = df.sparkSession, log.rstrip("/")
    seen, new = Observation(), f"{log}/_new-{uuid.uuid4().hex}"
    rows = df.select(*SCHEMA.names).repartitionByRange(POSITION).sortWithinPartitions(POSITION).observe(
        seen, F.min(POSITION).alias("first"), F.max(POSITION).alias("last"), F.count(F.lit(1)).alias("n"))
    rows.write.parquet(new)
    first, last, n = (seen.get[k] for k in ("first", "last", "n"))
    old = segments(spark, log)
    source, fs = _fs(spark, new)
    if not n or first < 0 or (old and first <= old[-1][1]):
        fs.delete(source, True)
        if n:
            raise ValueError(f"segment {first}-{last} does not lie behind the log's end {old[-1][1] if old else -1}")
        return
    if not fs.rename(source, _fs(spark, f"{log}/segment={first}-{last}-{n}")[0]):
        raise OSError(f"could not publish segment {first}-{last}")


def position_source() -> type[DataSource]:
    """The data source class. It is local to this function, so that Spark ships it to the
    workers by value and they need no copy of this package."""

    class Range(InputPartition):
        def __init__(self, path: str, low: int, high: int):
            self.path, self.low, self.high = path, low, high

    class Reader(DataSourceStreamReader):
        def __init__(self, options: dict):
            self.log, self.planned = options["path"], options["planned"]
            self.start = int(options.get("start", -1))
            self.max_rows = int(options.get("max_rows", 0))
            self.at = None

        @staticmethod
        def files(path: str):
            from pyarrow import fs
            if path.startswith("file:"):
                path = "/" + path[len("file:"):].lstrip("/")
            return fs.FileSystem.from_uri(path)

        def children(self, path: str) -> list[str]:
            from pyarrow import fs
            files, inner = self.files(path)
            return [f.path for f in files.get_file_info(fs.FileSelector(inner, allow_not_found=True))]

        def segments(self) -> list[tuple[int, int, int, str]]:
            found = []
            for path in self.children(self.log):
                name = path.rstrip("/").rsplit("/", 1)[-1]
                if name.startswith("segment="):
                    found.append((*(int(x) for x in name[len("segment="):].split("-")), name))
            return sorted(found)

        def remember(self, position: int) -> None:
            files, path = self.files(self.planned)
            files.create_dir(path.rsplit("/", 1)[0], recursive=True)
            with files.open_output_stream(path + ".new") as out:
                out.write(str(position).encode())
            files.move(path + ".new", path)

        def remembered(self) -> int:
            files, path = self.files(self.planned)
            try:
                with files.open_input_stream(path) as text:
                    return int(text.read())
            except FileNotFoundError:
                return self.start

        def initialOffset(self) -> dict:
            self.at = self.start
            return {"position": self.start}

        def latestOffset(self) -> dict:
            if self.at is None:  # a restarted query
                self.at = self.remembered()
            end, rows = self.at, 0
            for _, last, n, _ in self.segments():
                if last <= self.at:
                    continue
                if self.max_rows and rows and rows + n > self.max_rows:
                    break
                end, rows = last, rows + n
            if end != self.at:
                self.remember(end)
                self.at = end
            return {"position": end}

        def partitions(self, start: dict, end: dict) -> list:
            low, high = start["position"], end["position"]
            out = []
            for first, last, _, name in self.segments():
                if last > low and first <= high:
                    base = f"{self.log.rstrip('/')}/{name}"
                    names = [p.rsplit("/", 1)[-1] for p in self.children(base)]
                    out += [Range(f"{base}/{n}", low, high) for n in sorted(names) if n.endswith(".parquet")]
            return out

        def read(self, partition):
            import pyarrow as pa
            import pyarrow.compute as pc
            import pyarrow.parquet as pq
            files, path = self.files(partition.path)
            columns = ["position", "_table", "_cdc_version", "_cdc_is_deleted", "_cdc_synced_at", "payload"]
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.timestamp("us", "UTC"), pa.string()]
            schema = pa.schema(list(zip(columns, kinds)))
            with files.open_input_file(path) as file:
                for batch in pq.ParquetFile(file).iter_batches(batch_size=10_000, columns=columns):
                    p = batch.column("position")
                    batch = batch.filter(pc.and_(pc.greater(p, partition.low), pc.less_equal(p, partition.high)))
                    if batch.num_rows:
                        yield pa.RecordBatch.from_arrays([batch.column(f.name).cast(f.type) for f in schema], schema=schema)

    class PositionLog(DataSource):
        @classmethod
        def name(cls) -> str:
            return "position_log"

        def schema(self) -> str:
            return ("position bigint, _table string, _cdc_version bigint, _cdc_is_deleted int, _cdc_synced_at timestamp, payload string")

        def streamReader(self, schema) -> Reader:
            return Reader(dict(self.options))

    return PositionLog


def position_feed(spark: SparkSession, log: str, checkpoint: str, start: int = -1, max_rows: int | None = None) -> DataFrame:
    """Streaming change records after position ``start`` (a new query) or after the checkpoint's (a restarted one).

    ``checkpoint`` is the folder of the query that reads the feed; the planned position is kept beside its offsets."""
    spark.dataSource.register(position_source())
    reader = spark.readStream.format(NAME).option("planned", f"{checkpoint.rstrip('/')}/position/planned").option("start", str(start))
    if max_rows:
        reader = reader.option("max_rows", str(max_rows))
    return reader.load(log)
