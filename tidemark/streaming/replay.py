"""Stored rows replayed as a stream: a fixed number of rows per trigger, whatever the files.

The source's offset is a row number over the files in the order of their names. A list of the files and
their row counts is stored once, so a restart in the middle of a file goes on at the next row. A batch is cut
into slices, at most one file each, which the executors read themselves.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from collections.abc import Callable, Iterator, Sequence
from itertools import accumulate

import pyarrow as pa
import pyarrow.csv
import pyarrow.dataset
import pyarrow.fs
import pyarrow.parquet
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

SLICE_ROWS = 100_000


class Slice(InputPartition):
    """Rows ``first`` to ``last`` (exclusive) of a file."""

    def __init__(self, path: str, first: int, last: int):
        self.path, self.first, self.last = path, first, last


def _batches(path: str, fmt: str, header: bool, schema: pa.Schema, first: int, last: int) -> Iterator[pa.RecordBatch]:
    """The rows of a file as Arrow batches, without those before ``first`` where the format allows it."""
    files, name = pa.fs.FileSystem.from_uri(path)
    if fmt == "parquet":
        with pa.parquet.ParquetFile(files.open_input_file(name)) as file:
            sizes = [file.metadata.row_group(i).num_rows for i in range(file.num_row_groups)]
            ends = list(accumulate(sizes))
            wanted = [i for i, (n, end) in enumerate(zip(sizes, ends)) if end > first and end - n < last]
            skip = first - (ends[wanted[0]] - sizes[wanted[0]]) if wanted else 0
            for batch in file.iter_batches(row_groups=wanted, columns=schema.names):
                yield batch.slice(min(skip, batch.num_rows))
                skip = max(0, skip - batch.num_rows)
        return
    options = pa.csv.ReadOptions(column_names=None if header else schema.names)
    convert = pa.csv.ConvertOptions(column_types=dict(zip(schema.names, schema.types)), include_columns=schema.names, strings_can_be_null=True,
                                    null_values=[""])
    parse = pa.csv.ParseOptions(newlines_in_values=True)
    skip = first
    with files.open_input_stream(name) as stream, pa.csv.open_csv(stream, options, parse, convert) as reader:
        for batch in reader:
            yield batch.slice(min(skip, batch.num_rows))
            skip = max(0, skip - batch.num_rows)


class RowReader(DataSourceStreamReader):
    def __init__(self, options: dict, schema: T.StructType):
        self.rows = int(options["rowspertrigger"])
        self.fmt, self.header = options["fileformat"], options["header"] == "true"
        self.paths, counts = zip(*json.loads(options["files"])) if options["files"] != "[]" else ((), ())
        self.ends = list(accumulate(counts))
        self.schema = to_arrow_schema(schema)
        self.planned = 0

    def initialOffset(self) -> dict:
        return {"row": 0}

    def latestOffset(self) -> dict:
        return {"row": min(self.planned + self.rows, self.ends[-1] if self.ends else 0)}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        """Also called with an empty range, by which a restarted query says where it stands."""
        self.planned = max(self.planned, end["row"])
        out, row = [], start["row"]
        while row < end["row"]:
            i = bisect_right(self.ends, row)
            begin = self.ends[i - 1] if i else 0
            stop = min(end["row"], self.ends[i], row + SLICE_ROWS)
            out.append(Slice(self.paths[i], row - begin, stop - begin))
            row = stop
        return out

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        left = partition.last - partition.first
        for batch in _batches(partition.path, self.fmt, self.header, self.schema, partition.first, partition.last):
            batch = batch.slice(0, left)
            left -= batch.num_rows
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column(n).cast(t) for n, t in zip(self.schema.names, self.schema.types)], schema=self.schema)
            if not left:
                return


class RowReplay(DataSource):
    """``spark.readStream.format("tidemark_rows")``; :func:`replay_rows` sets its options."""

    @classmethod
    def name(cls) -> str:
        return "tidemark_rows"

    def streamReader(self, schema: T.StructType) -> RowReader:
        return RowReader(dict(self.options), schema)


def _listed(spark: SparkSession, path: str, schema: T.StructType, fmt: str, header: bool, index: str) -> list[tuple[str, int]]:
    """File names and row counts, counted by a Spark job the first time and stored."""
    try:
        stored = spark.read.schema("path STRING, n BIGINT").json(index).collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        reader = spark.read.schema(schema).format(fmt)
        if fmt == "csv":
            reader = reader.option("header", str(header).lower())
        found = reader.load(path).groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("n"))
        found.coalesce(1).write.mode("ignore").json(index)
        stored = spark.read.schema("path STRING, n BIGINT").json(index).collect()
    return sorted((r["path"], r["n"]) for r in stored)


def replay_rows(spark: SparkSession, path: str, schema: T.StructType, rows_per_trigger: int, index: str, fmt: str = "parquet",
                header: bool = True) -> DataFrame:
    """``rows_per_trigger`` rows per batch; the trigger interval sets the rate (one row a second: 1 and "1 second").

    Rows come by file name and then as they lie in the file. ``index`` is a path for the list of files, which belongs
    to the query's checkpoint: files that come later are not part of the replay. Executors read the files with
    pyarrow, whose file systems must know the path; parquet and csv files are read.
    """
    if rows_per_trigger < 1:
        raise ValueError("rows_per_trigger must be at least 1")
    if fmt not in ("parquet", "csv"):
        raise ValueError(f"cannot replay {fmt} files by rows")
    spark.dataSource.register(RowReplay)
    files = _listed(spark, path, schema, fmt, header, index)
    return (spark.readStream.format("tidemark_rows").schema(schema).option("files", json.dumps(files)).option("fileFormat", fmt)
            .option("header", str(header).lower()).option("rowsPerTrigger", rows_per_trigger).load())


def run_to_end(df: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], mode: str = "append", interval: str = "0 seconds") -> None:
    """Process batch after batch until the replay is used up, then stop."""
    query = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(each).trigger(processingTime=interval).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
