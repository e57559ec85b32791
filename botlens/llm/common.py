"""Helpers that several corpus operators share."""

from __future__ import annotations

import contextlib
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from botlens.shipping import ship_package

#: Rows that are Python objects at a time.
_ROWS = 512
#: Upper case to lower case, A-Z only.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """Where the package of public tokenizers keeps a file; a cluster has it on every worker."""
    import public_tokenizers

    return public_tokenizers.path(name)


def fresh(frame: DataFrame, name: str) -> str:
    """A column name that the frame does not have yet, in any case of letters."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def arrow_column(function: Callable[[list], list], kind: str) -> Callable[..., Column]:
    """A column function that hands whole Arrow batches to ``function`` as Python lists.

    ``function`` gets one list per argument and returns one list of values (dicts for structs).
    """
    returned = StructType.fromDDL(f"x {kind}")[0].dataType
    arrow_type = to_arrow_type(returned)

    def batch(*columns: pa.Array) -> pa.Array:
        # A few rows at a time: a batch of long texts is not doubled as Python objects.
        starts = range(0, len(columns[0]), _ROWS)
        parts = [pa.array(function(*(c.slice(i, _ROWS).to_pylist() for c in columns)), arrow_type) for i in starts]
        return pa.concat_arrays(parts) if parts else pa.array([], arrow_type)

    return lambda *columns: F.arrow_udf(_typed(batch, len(columns)), returned)(*columns)


def _typed(batch: Callable, arguments: int) -> Callable:
    """The same function with the annotations that Spark reads the kind of UDF from."""
    if arguments == 1:
        def one(a: pa.Array) -> pa.Array:
            return batch(a)
        one.__annotations__ = {"a": pa.Array, "return": pa.Array}
        return one

    def two(a: pa.Array, b: pa.Array) -> pa.Array:
        return batch(a, b)
    two.__annotations__ = {"a": pa.Array, "b": pa.Array, "return": pa.Array}
    return two


def shared_folder(spark: SparkSession) -> str:
    """A new path in the folder that the cluster names in spark.checkpoint.dir.

    Only a single-process session without that setting gets a temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = f"file://{tempfile.gettempdir()}/botlens-shared"
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def saved(frame: DataFrame) -> DataFrame:
    """The frame as a table in the shared folder: lineage ends there, lost executors cost nothing."""
    path = shared_folder(frame.sparkSession)
    frame.write.parquet(path)
    out = frame.sparkSession.read.schema(frame.schema).parquet(path)
    out._saved_path = path
    return out


@contextlib.contextmanager
def short_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files of a query go when the query ends: for steps that hand on tables of :func:`saved`."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def discard(frame: DataFrame) -> None:
    """Delete a table of ``saved`` that nothing reads any more."""
    path = getattr(frame, "_saved_path", None)
    if path:
        spark = frame.sparkSession
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Data and offsets of an Arrow string column, nulls as empty; no copy of the text.

    Offsets start at 0: ``data[offsets[i]:offsets[i + 1]]`` is row i.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    held = column.buffers()[2]
    data = np.frombuffer(held, dtype=np.uint8) if held is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_blocks(offsets: np.ndarray, limit: int) -> Iterable[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes each; a longer row is a range of its own."""
    start, rows = 0, len(offsets) - 1
    while start < rows:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        stop = min(max(stop, start + 1), rows)
        yield start, stop
        start = stop
