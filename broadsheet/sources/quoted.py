"""Quoted CSV files in parallel: a Python data source that cuts a file with line breaks inside its texts into byte ranges.

Whether a line break ends a record depends on the quotes before it, all the way to the start of the file. A first job
counts the quotes of every range; sums over the ranges before tell each range whether it starts inside quotes. A task then
finds the first record that starts in its range and reads on to the end of the last one, beyond the range if need be.
"""

from __future__ import annotations

import base64
import csv
import io
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StringType, StructType
from pyspark.sql.window import Window

NAME = "quoted_csv"
RANGE_BYTES = 16 << 20
QUOTE, BREAK = 34, 10
BATCH_ROWS = 4096


def _uri(path: str) -> str:
    return path if ":/" in path else f"file://{path}"


def files_of(path: str) -> list[tuple[str, int]]:
    """(path, bytes) of a file, or of the files of a folder in the order of their names; hidden ones do not count."""
    fs, inner = pa.fs.FileSystem.from_uri(_uri(path))
    info = fs.get_file_info(inner)
    if info.type == pa.fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = [info] if info.type == pa.fs.FileType.File else fs.get_file_info(pa.fs.FileSelector(inner, recursive=True))
    scheme = _uri(path)[:_uri(path).rindex(inner)] if inner in _uri(path) else ""
    kept = [f for f in found if f.type == pa.fs.FileType.File and not f.base_name.startswith(("_", "."))]
    return sorted((scheme + f.path, f.size) for f in kept)


def ranges_of(files: list[tuple[str, int]], range_bytes: int) -> list[tuple[str, int, int]]:
    """(path, first byte, end) of all ranges, in order."""
    return [(path, a, min(a + range_bytes, size)) for path, size in files for a in range(0, size, range_bytes)]


def _open(path: str):
    fs, inner = pa.fs.FileSystem.from_uri(path)
    return fs.open_input_file(inner)


def count_quotes(spark: SparkSession, files: list[tuple[str, int]], range_bytes: int) -> bytes:
    """For each range of ``ranges_of`` one bit: whether it starts inside quotes. One row per range comes to the driver."""
    sizes = spark.createDataFrame(files, "path string, size bigint")
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("size") - 1, F.lit(range_bytes).cast("bigint"))).alias("first")
    ranges = sizes.where("size > 0").select("path", "size", starts)
    ranges = ranges.repartition(max(1, len(ranges_of(files, range_bytes))), "path", "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            odd = []
            for path, size, first in zip(*(c.to_pylist() for c in b.columns)):
                with _open(path) as f:
                    f.seek(first)
                    data = f.read(min(range_bytes, size - first))
                odd.append(data.count(b'"') % 2)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(odd, pa.int32())], names=["path", "first", "odd"])

    counted = ranges.mapInArrow(run, "path string, first bigint, odd int")
    before = Window.partitionBy("path").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    bits = counted.select("path", "first", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).alias("open")).orderBy("path", "first")
    return np.packbits([r["open"] for r in bits.collect()]).tobytes()


class QuotedRange(InputPartition):
    def __init__(self, path: str, first: int, end: int, inside: bool):
        super().__init__(None)
        self.path, self.first, self.end, self.inside = path, first, end, inside


def record_bytes(f, size: int, first: int, end: int, inside: bool, step: int = 1 << 20) -> bytes:
    """The bytes of all records of a file that start in [first, end). ``inside``: whether ``first`` is inside quotes."""
    start = max(0, first - 1)  # a record starts at ``first`` if the byte before ends one
    f.seek(start)
    data = f.read(end - start)
    if start < first:
        inside ^= data[0] == QUOTE
    codes = np.frombuffer(data, np.uint8)
    quoted = (np.cumsum(codes == QUOTE) + inside) % 2 == 1
    ends = np.flatnonzero((codes == BREAK) & ~quoted) + 1  # where the next record starts
    begin = 0 if first == 0 else int(ends[0]) if len(ends) else len(data)
    if begin >= len(data):
        return b""
    parts, inside, at = [data[begin:]], bool(quoted[-1]), end
    if codes[-1] == BREAK and not inside:
        return parts[0]  # the next record starts at ``end``, in the next range
    while at < size:
        more = f.read(min(step, size - at))
        codes = np.frombuffer(more, np.uint8)
        quoted = (np.cumsum(codes == QUOTE) + inside) % 2 == 1
        ends = np.flatnonzero((codes == BREAK) & ~quoted)
        if len(ends):
            parts.append(more[:int(ends[0]) + 1])
            break
        parts.append(more)
        inside, at = bool(quoted[-1]), at + len(more)
    return b"".join(parts)


def _records(data: bytes) -> Iterator[list[str]]:
    csv.field_size_limit(1 << 31)
    return (r for r in csv.reader(io.StringIO(data.decode("utf-8"), newline="")) if r)


def _header(path: str, size: int) -> list[str]:
    with _open(path) as f:
        first = record_bytes(f, size, 0, 1, False)
    return next(_records(first.removeprefix(b"\xef\xbb\xbf")), [])


class QuotedReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]):
        self.names, self.path = schema.fieldNames(), options["path"]
        self.range_bytes = int(options.get("rangebytes", RANGE_BYTES))
        self.bits = options.get("inside")

    def partitions(self) -> list[QuotedRange]:
        files = files_of(self.path)
        if self.bits is None:  # nothing is known of the quotes: a file is a range
            return [QuotedRange(path, 0, size, False) for path, size in files if size]
        ranges = ranges_of(files, self.range_bytes)
        bits = np.unpackbits(np.frombuffer(zlib.decompress(base64.b64decode(self.bits)), np.uint8))
        return [QuotedRange(*r, bool(b)) for r, b in zip(ranges, bits)]

    def read(self, part: QuotedRange) -> Iterator[pa.RecordBatch]:
        fs, inner = pa.fs.FileSystem.from_uri(part.path)
        size = fs.get_file_info(inner).size
        with fs.open_input_file(inner) as f:
            data = record_bytes(f, size, part.first, part.end, part.inside)
            if record_bytes(f, size, 0, 1, False).endswith(b"\r\n"):
                data = data.replace(b"\r\n", b"\n")  # as Spark's own reader does in a file whose lines end so
        rows = _records(data.removeprefix(b"\xef\xbb\xbf") if part.first == 0 else data)
        if part.first == 0:
            next(rows, None)
        batch: list[list[str]] = []
        for r in rows:
            batch.append(r)
            if len(batch) == BATCH_ROWS:
                yield self._batch(batch)
                batch = []
        if batch:
            yield self._batch(batch)

    def _batch(self, rows: list[list[str]]) -> pa.RecordBatch:
        """An empty field is null, short records are filled up with nulls, what is beyond the header is left."""
        columns = [pa.array([(r[i] or None) if i < len(r) else None for r in rows], pa.string()) for i in range(len(self.names))]
        return pa.RecordBatch.from_arrays(columns, names=self.names)


class QuotedCsv(DataSource):
    """``spark.read.format("quoted_csv")``: all columns as text. ``read_quoted`` counts the quotes first and so splits files;
    without that count a file is one range."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> StructType:
        schema = StructType()
        files = [f for f in files_of(self.options["path"]) if f[1]]
        for name in _header(*files[0]) if files else []:
            schema = schema.add(name or "", StringType())
        return schema

    def reader(self, schema: StructType) -> QuotedReader:
        return QuotedReader(schema, self.options)


def read_quoted(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The rows of quoted CSV files with a header, all columns as text, each file read by as many tasks as it has ranges.

    Fields are separated by commas; quotes inside quoted fields are doubled; a quote may not stand in an unquoted field.
    Records end with a line feed, with or without a carriage return before it; where the header's does, those inside
    texts become line feeds too. Files are opened through pyarrow's file
    systems (local, hdfs, s3, gs, abfs).
    """
    spark.dataSource.register(QuotedCsv)
    files = files_of(path)
    bits = base64.b64encode(zlib.compress(count_quotes(spark, files, range_bytes))).decode() if files else None
    reader = spark.read.format(NAME).option("rangebytes", range_bytes)
    return (reader.option("inside", bits) if bits else reader).load(path)
