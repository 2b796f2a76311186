"""CSV source tables: file lookup, declared types, optional tables and the presence inventory."""

from __future__ import annotations

import csv
import sys
from collections.abc import Iterator
from functools import partial
from gzip import GzipFile
from io import BufferedReader
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketmart.schemas import FILE_NAMES, OPTIONAL_COLUMNS, OPTIONAL_SOURCES, SCHEMAS
from basketmart.sources.tables import LazyTables


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system it names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def resolve_source(spark: SparkSession, folder: str, name: str) -> str | None:
    """Path of the first file name a source is found under, or None."""
    for candidate in FILE_NAMES[name]:
        path = f"{folder.rstrip('/')}/{candidate}"
        if path_exists(spark, path):
            return path
    return None


def source_inventory(spark: SparkSession, folder: str) -> DataFrame:
    """Each source with the file it was found in, NULL where it is missing."""
    rows = []
    for name in SCHEMAS:
        path = resolve_source(spark, folder, name)
        rows.append((name, path.rsplit("/", 1)[-1] if path else None))
    return spark.createDataFrame(rows, "source string, file string")


RANGE_BYTES = 128 * 1024 * 1024
BLOCK = 1 << 20  # bytes looked through at once
ROWS = 10_000  # rows of a batch
_STORES = {"s3a": "s3", "s3n": "s3"}  # how Arrow calls a store that Hadoop names differently


def _open(uri: str):
    """A file as a stream, on whatever file system its address names; a gzip file as its content."""
    from pyarrow import fs

    if uri.startswith("file:"):
        stream = BufferedReader(fs.LocalFileSystem().open_input_file("/" + uri.removeprefix("file:").lstrip("/")))
    else:
        scheme, colon, rest = uri.partition(":")
        system, path = fs.FileSystem.from_uri(_STORES.get(scheme, scheme) + colon + rest)
        stream = BufferedReader(system.open_input_file(path))
    return GzipFile(fileobj=stream) if uri.endswith(".gz") else stream


class _Lines:
    """Physical lines of a stream as text, and the place behind the last one."""

    def __init__(self, stream, place: int):
        self.stream, self.place = stream, place

    def __iter__(self):
        return self

    def __next__(self) -> str:
        line = self.stream.readline()
        if not line:
            raise StopIteration
        self.place += len(line)
        return line.decode("utf-8", "replace")


def _header(uri: str) -> list[str]:
    with _open(uri) as stream:
        names = next(csv.reader(_Lines(stream, 0), strict=True), [])
    return [name.removeprefix("\ufeff") for name in names]


def _rows_of_range(uri: str, start: int, end: int, quoted: bool, names: list[str]) -> Iterator[list[str]]:
    """Rows whose first byte lies in the range; ``quoted``: the byte before the range lies between quotes."""
    with _open(uri) as stream:
        place = 0
        if start:
            # the row that the byte before the range belongs to, is the range's before
            stream.seek(start - 1)
            place = start - 1
            while line := stream.readline():
                place += len(line)
                quoted ^= bool(line.count(b'"') & 1)
                if not quoted:
                    break
        lines = _Lines(stream, place)
        reader = csv.reader(lines, strict=True)
        if not start:
            next(reader, None)
        while lines.place < end:
            row = next(reader, None)
            if row is None:
                return
            if row and len(row) != len(names):
                raise ValueError(f"{uri}: {len(row)} fields instead of {len(names)} in the row before byte {lines.place}")
            if row:
                yield row


def _quotes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Quotes from the byte before each range to the byte before the next one."""
    for batch in batches:
        found = []
        for row in batch.to_pylist():
            n, left = 0, max(row["end"] - 1, 0) - max(row["start"] - 1, 0)
            with _open(row["uri"]) as stream:
                stream.seek(max(row["start"] - 1, 0))
                while left > 0 and (block := stream.read(min(BLOCK, left))):
                    n, left = n + block.count(b'"'), left - len(block)
            found.append(n)
        yield pa.RecordBatch.from_arrays(
            [batch.column("uri"), batch.column("start"), batch.column("end"), pa.array(found, pa.int64())],
            ["uri", "start", "end", "quotes"],
        )


def read_hidden_csv(spark: SparkSession, path: str) -> DataFrame:
    """A headered CSV file, or each file of a folder, as text columns; also where its name starts with an underscore.

    Spark's own readers treat such names as hidden and return nothing. A file is cut into byte ranges, each read by its own
    task. Quotes are counted in a pass of their own, so a range knows whether it starts between quotes and quoted line
    breaks may lie anywhere; quotes within quotes are doubled. A gzip file is one range. Empty fields are NULL, blank lines
    are skipped, and a row with too many or too few fields fails the read with its place in the file.
    """
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    listed = [(f.getPath().toString(), f.getLen()) for f in system.listStatus(hadoop_path) if f.isFile() and f.getLen()]
    files = sorted((u, n) for u, n in listed if not u.endswith((".crc", "/_SUCCESS")))
    if not files:
        raise ValueError(f"no file with a header in {path}")
    names = _header(files[0][0])
    ranges = spark.createDataFrame(files, "uri string, bytes long")
    whole = F.col("uri").endswith(".gz")
    starts = F.when(whole, F.array(F.lit(0).cast("long"))).otherwise(F.sequence(F.lit(0), F.col("bytes") - 1, F.lit(RANGE_BYTES)))
    ranges = ranges.select("uri", "bytes", F.explode(starts).alias("start"))
    end = F.when(whole, F.lit(1 << 62)).otherwise(F.least(F.col("start") + RANGE_BYTES, "bytes"))
    ranges = ranges.select("uri", "start", end.alias("end"))
    tasks = sum(1 if uri.endswith(".gz") else -(-size // RANGE_BYTES) for uri, size in files)
    ranges = ranges.repartition(tasks, "uri", "start")
    if tasks > len(files):
        counted = ranges.mapInArrow(_quotes, "uri string, start long, end long, quotes long")
        # one row for each range of a file
        earlier = W.partitionBy("uri").orderBy("start").rowsBetween(W.unboundedPreceding, -1)
        odd = F.coalesce(F.sum("quotes").over(earlier) % 2, F.lit(0)) == 1
        ranges = counted.select("uri", "start", "end", odd.alias("quoted")).repartition(tasks, "uri", "start")
    else:
        ranges = ranges.withColumn("quoted", F.lit(False))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(sys.maxsize)
        for batch in batches:
            for row in batch.to_pylist():
                rows = _rows_of_range(row["uri"], row["start"], row["end"], row["quoted"], names)
                while part := list(islice(rows, ROWS)):
                    columns = [pa.array([v or None for v in column], pa.string()) for column in zip(*part)]
                    yield pa.RecordBatch.from_arrays(columns, names)

    return ranges.mapInArrow(read, ", ".join(f"`{name}` string" for name in names))


def read_source(
    spark: SparkSession, path: str, name: str, infer_schema: bool = False, quoted_breaks: bool = False
) -> DataFrame:
    """A source with lower-case column names and its declared types.

    Columns are matched by header name, so their order in the file does not matter. A row with too many or too few fields
    and a value that does not fit its declared type fail the read, which therefore parses every column. Columns beyond the
    schema stay as text. ``infer_schema`` keeps the types Spark finds instead, at the price of one more pass over the file.
    Files with line breaks between quotes need ``quoted_breaks``, which reads them by the quote-aware ranges that hidden
    names are read by; without it such a row fails the read.
    """
    hidden = quoted_breaks or path.rstrip("/").rsplit("/", 1)[-1].startswith("_")
    reader = spark.read.option("header", True).option("inferSchema", infer_schema)
    reader = reader.option("mode", "FAILFAST").option("columnPruning", False)
    raw = read_hidden_csv(spark, path) if hidden else reader.csv(path)
    frame = raw.toDF(*[column.strip().lower() for column in raw.columns])
    declared = SCHEMAS[name]
    absent = [f.name for f in declared if f.name not in frame.columns]
    missing = [column for column in absent if column not in OPTIONAL_COLUMNS.get(name, set())]
    if missing:
        raise ValueError(f"{name}: columns {missing} are missing in {path}")
    if infer_schema and not hidden:
        return frame
    present = [f for f in declared if f.name not in absent]
    extra = [column for column in frame.columns if column not in declared.names]
    return frame.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in present], *extra)


def empty_source(spark: SparkSession, name: str) -> DataFrame:
    """A source without rows but with its full schema."""
    return spark.createDataFrame([], SCHEMAS[name])


def csv_sources(spark: SparkSession, folder: str, infer_schema: bool = False) -> LazyTables:
    """All eight sources of a folder; a missing optional one is empty, missing required ones are an error."""
    paths = {name: resolve_source(spark, folder, name) for name in SCHEMAS}
    missing = [name for name, path in paths.items() if path is None and name not in OPTIONAL_SOURCES]
    if missing:
        raise ValueError(f"required sources missing in {folder}: {', '.join(missing)}")

    def build(name: str) -> DataFrame:
        path = paths[name]
        return read_source(spark, path, name, infer_schema) if path else empty_source(spark, name)

    return LazyTables({name: partial(build, name) for name in SCHEMAS})
