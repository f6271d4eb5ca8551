"""Helpers the operators share: Arrow column maps, stored tables, words."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text, about, that a task works on at a time.
SLICE_BYTES = 4 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach: the session's checkpoint folder.

    Only a session that names none (tests) gets a fresh local one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
        folder = "file://" + tempfile.mkdtemp(prefix="larkspur-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; it is removed when the session's JVM ends."""
    folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts lineage, survives executors."""
    folder = fresh_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def add_columns(
    df: DataFrame,
    inputs: list[str],
    fields: list[tuple[str, T.DataType]],
    make: Callable[[], Callable[..., list[pa.Array]]],
) -> DataFrame:
    """Add columns worked out in Python from Arrow batches, without a shuffle.

    `make` runs once per task and gives the function that turns the input columns
    of a batch into the new ones.  A batch is cut into slices of about SLICE_BYTES of input
    text, so what a task holds does not follow from the length of the texts in a batch.
    Columns of `df` that bear a new column's name (in any case) are replaced.
    """
    taken = {name.lower() for name, _ in fields}
    kept = [f for f in df.schema.fields if f.name.lower() not in taken]
    wanted = list(dict.fromkeys([*(f.name for f in kept), *inputs]))
    columns = kept + [T.StructField(n, t) for n, t in fields]
    # plain names inside, as names with dots cannot be handed to the map
    names = [f"c{i}" for i in range(len(columns))]
    schema = T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, columns, strict=True)])

    small_batches(df.sparkSession)
    places = [wanted.index(c) for c in inputs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in (part for whole in batches for part in sliced(whole, places)):
            pa.default_memory_pool().release_unused()
            if batch.num_rows:
                new = work(*(batch.column(wanted.index(c)) for c in inputs))
                old = [batch.column(i) for i in range(len(kept))]
                yield pa.RecordBatch.from_arrays(old + new, names=names)

    plain = df.select(*(quoted(c).alias(f"c{i}") for i, c in enumerate(wanted)))
    return plain.mapInArrow(run, schema).toDF(*(f.name for f in columns))


def small_batches(spark: SparkSession) -> None:
    """Let the session hand rows to Python in batches of at most SLICE_BYTES.

    Spark's own limit is 64 MB and 10,000 rows, which each running task holds several times over,
    on both sides.  A smaller limit that the session already has stays.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    current = int(spark.conf.get(name).rstrip("b"))
    if not 0 < current <= SLICE_BYTES:
        spark.conf.set(name, str(SLICE_BYTES))


def sliced(batch: pa.RecordBatch, columns: list[int]) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about SLICE_BYTES of the given columns' text, one row at least."""
    sizes = np.zeros(batch.num_rows, np.int64)
    for i in columns:
        kind = batch.column(i).type
        if pa.types.is_string(kind) or pa.types.is_binary(kind):
            sizes += pc.fill_null(pc.binary_length(batch.column(i)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes) // SLICE_BYTES
    edges = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:]):
        yield batch.slice(a, b - a)


def unused(df: DataFrame, base: str) -> str:
    """A column name that `df` does not bear, in any case."""
    name, taken = f"__{base}", {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def quoted(name: str) -> Column:
    """A column by its literal name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def as_bytes(texts: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; a null text counts as empty."""
    return [b or b"" for b in texts.cast(pa.binary()).to_pylist()]


def words(text: bytes) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+`: exactly what a split of bytes at white space gives."""
    return text.split()


def list_of(values: pa.Array, offsets) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
