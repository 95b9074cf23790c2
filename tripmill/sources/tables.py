"""Parquet tables: schema-checked load, full replace by releases, replay-safe append, compaction."""

from __future__ import annotations

import json
import re
import uuid
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping, Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.contract import BATCH_SCHEMA
from tripmill.functions.numeric import to_integer
from tripmill.session import configure
from tripmill.sources.footers import Layout, data_files, files_of, layouts
from tripmill.sources.loads import (
    COMPACTED,
    drop_replaced,  # noqa: F401  (part of this module's interface)
    last_snapshot,
    load_folder,
    load_names,
    make_snapshot,
)
from tripmill.sources.releases import (
    Release,
    Run,
    delete,
    drop_old,
    file_system,
    last_release,
    make_release,
    names_in,
    take_lease,
)


FOOTERS = 16


class SchemaMismatch(ValueError):
    """A source lacks a column the schema asks for."""


def load_trips(
    spark: SparkSession, paths: Sequence[str], schema: T.StructType = BATCH_SCHEMA
) -> DataFrame:
    """Load monthly Parquet files, directories or globs as one table of ``schema``.

    Months may store a column with different numeric types, which one Parquet
    read cannot merge, also within one directory. Footers are read by one job
    (``sources.footers``) and grouped by the types they store; Spark names the types
    of one file of each group, and each group is one scan, by folders where
    a folder's files agree. Files of a store that only Spark can open are typed one by one.
    """
    configure(spark)
    if not paths:
        raise ValueError("no paths given")
    found = layouts(spark, paths, schema.names)
    if not found:
        raise ValueError("no Parquet files found")
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    if any(layout.layout is None for layout in found):
        for types, file in typed_one_by_one(spark, paths, schema):
            groups.setdefault(types.json(), (types, []))[1].append(file)
    else:
        for types, files in typed_by_layout(spark, paths, found, schema):
            groups.setdefault(types.json(), (types, []))[1].extend(files)
    # Folders are read whole, and what they are named by is no column of theirs.
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    parts = [to_schema(reader.schema(types).parquet(*group), schema) for types, group in groups.values()]
    return reduce(DataFrame.unionByName, parts)


def typed_by_layout(
    spark: SparkSession, paths: Sequence[str], found: Sequence[Layout], schema: T.StructType
) -> Iterator[tuple[T.StructType, list[str]]]:
    """(types, paths to read) for every layout of the wanted columns."""
    folders: dict[str, set[str]] = {}
    samples: dict[str, str] = {}
    for layout in found:
        require_columns(layout.columns, schema, layout.sample)
        folders.setdefault(layout.layout, set()).update(layout.folders)
        samples.setdefault(layout.layout, layout.sample)
    layouts_in = Counter(folder for own in folders.values() for folder in own)
    in_order = sorted(f"{folder}/" for folder in layouts_in)
    all_below = whole_folders(spark, paths)
    for layout, own in folders.items():
        types = assert_schema(spark.read.parquet(literal(samples[layout])), schema).schema
        alone = {f for f in own if all_below and layouts_in[f] == 1}
        files = [
            literal(folder) + ("/*.parquet" if has_below(in_order, folder) else "") for folder in sorted(alone)
        ]
        if own - alone:
            files += map(literal, files_of(spark, paths, layout, own - alone, schema.names))
        yield types, files


def has_below(folders: Sequence[str], folder: str) -> bool:
    """Whether sorted folder names, each with a final slash, have one below ``folder``."""
    following = bisect_right(folders, f"{folder}/")
    return following < len(folders) and folders[following].startswith(f"{folder}/")


def literal(path: str) -> str:
    """A path whose characters stand for themselves where globs are read."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def whole_folders(spark: SparkSession, paths: Sequence[str]) -> bool:
    """Whether the paths name folders, so that all files of a folder below them are meant."""

    def is_folder(path: str) -> bool:
        found, system = file_system(spark, path)
        return system.exists(found) and system.getFileStatus(found).isDirectory()

    return all(is_folder(path) for path in paths)


def typed_one_by_one(
    spark: SparkSession, paths: Sequence[str], schema: T.StructType
) -> list[tuple[T.StructType, str]]:
    """(types, file) by a small Spark job per file, ``FOOTERS`` of them at a time."""
    files = [literal(r.path) for r in data_files(spark, paths).distinct().collect()]
    with ThreadPool(FOOTERS) as pool:
        types = pool.map(lambda f: assert_schema(spark.read.parquet(f), schema).schema, files)
    return list(zip(types, files, strict=True))


def require_columns(columns: Iterable[str], schema: T.StructType, place: str) -> None:
    absent = [name for name in schema.names if name not in columns]
    if absent:
        raise SchemaMismatch("missing columns: " + ", ".join(absent) + f" in {place}")


def assert_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` narrowed to the columns of ``schema``; more columns are fine, fewer are not."""
    absent = [name for name in schema.names if name not in df.columns]
    if absent:
        raise SchemaMismatch("missing columns: " + ", ".join(absent))
    return df.select(*schema.names)


def to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to the types of ``schema``; fractions are rounded where it has integers."""

    def cast(wanted: T.StructField):
        found = df.schema[wanted.name].dataType
        column = F.col(wanted.name)
        if isinstance(wanted.dataType, T.LongType) and isinstance(
            found, (T.DoubleType, T.FloatType, T.DecimalType)
        ):
            return to_integer(column).alias(wanted.name)
        return column.cast(wanted.dataType).alias(wanted.name)

    return df.select(*[cast(f) for f in schema.fields])


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a written table in the column order of ``schema``; an empty one has no rows."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def laid_out(df: DataFrame, partition_by: Sequence[str], cluster_by: Sequence[str]) -> DataFrame:
    """Bring rows of a partition value together and sort them for row-group skipping.

    ``cluster_by`` is columns or SQL expressions, such as ``layout.interleaved`` gives.

    Rebalancing splits a date that holds much of the data over several tasks
    and files and merges small dates, both by their measured sizes. A plain
    repartition by date would write a large date in one task. Expressions are worked
    out once per row before the sort, which would else do so in every comparison.
    """
    spread = df.hint("rebalance", *[F.col(c) for c in partition_by])
    # Names longer than any that the table has.
    longest = max(map(len, df.columns))
    places = {k: f"{'_' * longest}{i}" for i, k in enumerate(cluster_by) if k not in df.columns}
    if places:
        spread = spread.withColumns({name: F.expr(k) for k, name in places.items()})
    keys = [*map(F.expr, partition_by), *(F.col(places[k]) if k in places else F.expr(k) for k in cluster_by)]
    return spread.sortWithinPartitions(*keys).drop(*places.values()) if keys else spread


def write_run(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
) -> None:
    """Write ``df`` as the whole content of ``path``."""
    writer = laid_out(df, partition_by, cluster_by).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def run_path(root: str, name: str, run_id: str) -> str:
    return f"{root.rstrip('/')}/{name}/run={run_id}"


def write_candidate(
    df: DataFrame,
    name: str,
    root: str,
    run_id: str,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
) -> DataFrame:
    """Write a new content of table ``name`` and read it back; readers do not see it yet."""
    take_lease(df.sparkSession, root, run_id)
    path = run_path(root, name, run_id)
    write_run(df, path, partition_by, cluster_by)
    return read_table(df.sparkSession, path, df.schema)


def publish(
    written: DataFrame, name: str, root: str, run_id: str, keep: int | None = None
) -> Release:
    """Make a run's rows the content of table ``name``, for this and all other sessions."""
    return publish_together({name: written}, root, run_id, keep)


def publish_together(
    written: Mapping[str, DataFrame],
    root: str,
    run_id: str,
    keep: int | None = None,
    seen: Mapping[str, int] | None = None,
) -> Release:
    """Make a run's rows the content of several tables at once, by one release.

    With ``keep``, runs that only releases before the last ``keep`` ones name are deleted. ``seen``
    notes the last batch of each stream that the tables include; without it the last release's note stays.
    """
    spark = next(iter(written.values())).sparkSession
    runs = {name: Run(run_id, df.schema.json()) for name, df in written.items()}
    made = make_release(spark, root, runs, seen)
    if keep is not None:
        drop_old(spark, root, keep)
    return made


def released_tables(spark: SparkSession, root: str, release: Release | None = None) -> dict[str, DataFrame]:
    """All tables below ``root`` as one release has them, the last one by default."""
    release = release or last_release(spark, root)
    if release is None:
        return {}
    return {name: read_run(spark, root, name, run) for name, run in release.tables.items()}


def read_run(spark: SparkSession, root: str, name: str, run: Run) -> DataFrame:
    """The rows of table ``name`` as a release has them, also where they are folders of several runs."""
    schema = T.StructType.fromJson(json.loads(run.columns))
    if run.parts is None:
        return read_table(spark, run_path(root, name, run.run_id), schema)
    if not run.parts:
        return spark.createDataFrame([], schema)
    base = f"{root.rstrip('/')}/{name}"
    folders = [literal(f"{base}/run={run_id}/{part}") for part, run_id in sorted(run.parts.items())]
    listed = T.StructType([*schema.fields, T.StructField("run", T.StringType())])
    return spark.read.schema(listed).option("basePath", base).parquet(*folders).select(*schema.names)


def parts_of(spark: SparkSession, root: str, name: str, run: Run) -> dict[str, str]:
    """The run that has each partition folder of table ``name``."""
    if run.parts is not None:
        return dict(run.parts)
    return {f: run.run_id for f in names_in(spark, run_path(root, name, run.run_id)) if "=" in f}


def current_table(spark: SparkSession, name: str, root: str) -> DataFrame:
    """The published content of table ``name`` below ``root``.

    Several tables that belong together are read by ``released_tables``, from one release.
    """
    release = last_release(spark, root)
    if release is None or name not in release.tables:
        raise LookupError(f"table {name} below {root} has not been published")
    return released_tables(spark, root, Release(release.number, {name: release.tables[name]}))[name]


def replace_table(
    df: DataFrame,
    name: str,
    root: str,
    run_id: str,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    keep: int | None = None,
) -> DataFrame:
    """Replace table ``name`` by the rows of ``df`` and read it back.

    Rows go to a directory of this run; only then does a release name it.
    Readers see the old table or the new one, a failed write leaves the old
    one in place, and a rerun with the same ``run_id`` writes the same place.
    """
    written = write_candidate(df, name, root, run_id, partition_by, cluster_by)
    publish(written, name, root, run_id, keep)
    return written


def append_batch(
    df: DataFrame,
    path: str,
    load_id: str,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
) -> None:
    """Add the rows of one load to a table. Repeating a load replaces its own rows."""
    write_run(df, load_folder(path, load_id), partition_by, cluster_by)


def read_loads(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """An appended table: all loads but those that a compaction has replaced or not finished."""
    listed = T.StructType([*schema.fields, T.StructField("load_id", T.StringType())])
    try:
        rows = spark.read.schema(listed).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    return rows.where(last_snapshot(spark, path).is_live(F.col("load_id"))).select(*schema.names)


def read_some_loads(
    spark: SparkSession, path: str, names: Sequence[str], schema: T.StructType
) -> DataFrame:
    """The rows of some loads, read from their folders alone."""
    if not names:
        return spark.createDataFrame([], schema)
    listed = T.StructType([*schema.fields, T.StructField("load_id", T.StringType())])
    reader = spark.read.schema(listed).option("basePath", path)
    return reader.parquet(*(literal(load_folder(path, n)) for n in names)).select(*schema.names)


def compact(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    leave: int = 1,
) -> str | None:
    """Rewrite an appended table's finished loads as one load; its name, or None if few are there.

    The last ``leave`` loads of every query stay, as a restarted stream may write
    them again. Rows appear in the new load and vanish from the old ones at
    once, when the next snapshot names it; ``drop_replaced`` deletes the old files later. If
    another compaction of the table has ended meanwhile, this one's load is deleted.
    """
    snapshot = last_snapshot(spark, path)
    pending = snapshot.pending(load_names(spark, path))
    old = {query: own[: -leave or None] for query, own in pending.items() if own[: -leave or None]}
    names = [name for own in old.values() for _, name in own]
    if len(names) < 2:
        return None
    new = COMPACTED + uuid.uuid4().hex
    following, absorbed = snapshot.with_merged(new, {q: (own[0][0], own[-1][0]) for q, own in old.items()})
    rows = read_some_loads(spark, path, [*names, *(m.name for m in absorbed)], schema)
    append_batch(rows, path, new, partition_by, cluster_by)
    if make_snapshot(spark, path, following):
        return new
    delete(spark, load_folder(path, new))
    return None
