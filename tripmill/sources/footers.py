"""What Parquet files hold, by their footers, which tasks read."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Tasks that read footers, by cores of the cluster.
TASKS_EACH = 4
FOUND = "folder string, layout string, columns string, sample string, files bigint"


@dataclass
class Layout:
    """Files alike in the types of the asked columns. ``layout`` is None where tasks cannot open files."""

    layout: str | None
    columns: frozenset[str] = frozenset()
    sample: str = ""
    files: int = 0
    folders: set[str] = field(default_factory=set)


def data_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path): the Parquet files below files, directories and globs: a listing, no content is read."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return listing.option("pathGlobFilter", "*.parquet").load(list(paths)).select("path")


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path in it of a file as Spark names it."""
    scheme, found, rest = path.partition(":")
    if not found or scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/") if found else path
    return fs.FileSystem.from_uri({"s3a": "s3", "s3n": "s3"}.get(scheme, scheme) + ":" + rest)


def footer(path: str, wanted: Sequence[str]) -> tuple[str | None, str]:
    """The stored types of the wanted columns, and the names of all columns."""
    try:
        system, place = opened(path)
    except (pa.ArrowInvalid, NotImplementedError, OSError):
        return None, ""  # a file system that only Spark knows
    with system.open_input_file(place) as source:
        schema = pq.read_metadata(source).schema
    stored = [schema.column(i) for i in range(len(schema))]
    types = [f"{c.path} {c.physical_type} {c.logical_type}" for c in stored if c.path.split(".")[0] in wanted]
    return "; ".join(sorted(types)), "\n".join(sorted({c.path.split(".")[0] for c in stored}))


def layouts(spark: SparkSession, paths: Sequence[str], wanted: Sequence[str]) -> list[Layout]:
    """The different layouts of all files below ``paths``; one job, whose tasks read the footers.

    Each task sends a row per folder and layout, so the driver never holds a list of files.
    """
    try:
        files = data_files(spark, paths)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []

    def read(batches) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple, list] = {}
        for batch in batches:
            for path in batch.column(0).to_pylist():
                layout, columns = footer(path, wanted)
                known = seen.setdefault((path.rpartition("/")[0], layout, columns), [path, 0])
                known[0] = min(known[0], path)
                known[1] += 1
        rows = [(*key, *value) for key, value in seen.items()]
        kinds = (pa.string(), pa.string(), pa.string(), pa.string(), pa.int64())
        names = ["folder", "layout", "columns", "sample", "files"]
        columns = list(zip(*rows)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    tasks = TASKS_EACH * spark.sparkContext.defaultParallelism
    out: dict[tuple, Layout] = {}
    for row in files.coalesce(tasks).mapInArrow(read, FOUND).collect():
        columns = frozenset(row.columns.split("\n"))
        own = out.setdefault((row.layout, columns), Layout(row.layout, columns, row.sample))
        own.sample = min(own.sample, row.sample)
        own.files += row.files
        own.folders.add(row.folder)
    return sorted(out.values(), key=lambda x: (x.layout or "", x.sample))


def files_of(
    spark: SparkSession, paths: Sequence[str], layout: str, folders: Iterable[str], wanted: Sequence[str]
) -> list[str]:
    """The files of a layout in folders that hold others too."""

    def read(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen = [p for p in batch.column(0).to_pylist() if footer(p, wanted)[0] == layout]
            yield pa.RecordBatch.from_arrays([pa.array(chosen, pa.string())], names=["path"])

    inside = F.regexp_extract("path", "^(.*)/[^/]*$", 1).isin(*sorted(folders))
    tasks = TASKS_EACH * spark.sparkContext.defaultParallelism
    files = data_files(spark, paths).where(inside).coalesce(tasks)
    return sorted(r.path for r in files.mapInArrow(read, "path string").collect())


def columns_everywhere(spark: SparkSession, path: str, required: Sequence[str]) -> tuple[int, int]:
    """How many files there are below ``path``, and how many of the required columns all of them have.

    A column that the file's folders are named by, as partitioned tables do, counts as the file's.
    """
    files, everywhere = 0, set(required)
    for layout in layouts(spark, [path], ()):
        files += layout.files
        for folder in layout.folders:
            below = folder.partition(path.rstrip("/").rpartition(":")[2])[2]
            everywhere &= layout.columns | {unquote(m) for m in re.findall(r"([^/=]+)=[^/]*", below)}
    return files, len(everywhere) if files else 0
