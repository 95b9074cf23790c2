"""What several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: A word is a run of characters other than ASCII white space.
SPACE = r"[\x20\x09-\x0D]+"


#: Bytes of a batch of rows on its way to or from Python; a task holds a few copies of one.
BATCH_BYTES = 8 << 20


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df``, whose session from now on sends batches of at most ``BATCH_BYTES`` to Python."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_dir(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``, or below the warehouse where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    base = base or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: later steps start from files."""
    path = work_dir(df.sparkSession, name)
    in_small_batches(df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Array entries of some 30 bytes that are broadcast at most.
BROADCAST_ENTRIES = 2_000_000


def bounded(df: DataFrame, array: str) -> DataFrame:
    """Marked for broadcast if its arrays have few entries in all, else left to a shuffle."""
    entries = df.agg(F.sum(F.size(array) + 1)).first()[0] or 0
    return F.broadcast(df) if entries <= BROADCAST_ENTRIES else df


def in_tasks(df: DataFrame, rows: int, each: int) -> DataFrame:
    """``df``, after whose last shuffle about ``each`` of its ``rows`` come to a task, not fewer."""
    return df.coalesce(max(1, -(-rows // each)))


def columns_here(df: DataFrame) -> list[np.ndarray]:
    """The columns of a bigint table of bounded size, as arrays in the driver's memory.

    They travel as bytes, a row per batch, which costs a tenth of collected rows.
    """
    names = df.columns

    def pack(batches):
        for batch in batches:
            values = [[c.to_numpy().astype(np.int64).tobytes()] for c in batch.columns]
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.binary()) for v in values], names=names)

    rows = df.mapInArrow(pack, ", ".join(f"`{n}` binary" for n in names)).collect()
    return [np.frombuffer(b"".join(r[i] for r in rows), np.int64) for i in range(len(names))]


def words(text: Column) -> Column:
    """The words of a text, as an array without empty strings."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null as empty."""
    return pc.fill_null(column.cast(pa.large_binary()), b"").to_pylist()


#: Rows of a batch that are worked on at a time; bounds what a task holds besides the batch.
ROWS = 2048


def slices(batches: Iterable[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most ``rows`` rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    give_back()


def give_back() -> None:
    """Return freed memory to the system: a worker process stays for the next task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def in_batches(
    df: DataFrame,
    schema: str,
    work: Callable[[pa.RecordBatch], dict[str, object]],
    rows: int = ROWS,
) -> DataFrame:
    """``mapInArrow`` with a function from some rows to the columns named in ``schema``."""
    fields = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        for batch in slices(batches, rows):
            out = work(batch)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[f.name], f.type, from_pandas=False) for f in fields], schema=fields
            )

    return in_small_batches(df).mapInArrow(run, schema)
