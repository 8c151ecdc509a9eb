"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import sys
import time
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from furlens.session import shared_dir

# Fixed pattern of white space in the contracts of several operators.
WHITE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

BROADCAST_BYTES = 16_000_000  # larger sides are shuffled


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written below the shared folder and read again: cuts lineage, survives lost executors."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.stored_path = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables made by ``stored`` that no later plan reads."""
    for table in tables:
        jvm = table.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(table.stored_path)
        path.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of jobs that are done and that no plan refers to.

    It does so when the driver's garbage is collected, which can be long after.
    Python's references go first, and Spark's cleaner works on its own thread.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def per_process(key: tuple, make):
    """What ``make`` returns, made once in each Python worker, whose tasks come one after the other."""
    holder = sys.modules.setdefault("furlens_worker_state", types.ModuleType("furlens_worker_state"))
    made = holder.__dict__.setdefault("made", {})
    if key not in made:
        made[key] = make()
    return made[key]


def forget() -> None:
    """Drop what ``per_process`` has kept for the tasks of another operator, beside which this worker's own would stand."""
    getattr(sys.modules.get("furlens_worker_state"), "made", {}).clear()
    give_back()


def give_back() -> None:
    """Return memory that is not in use: workers are kept for later tasks, beside which it would stay."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


SLICE_BYTES = 4_000_000


def sliced(batches: Iterator[pa.RecordBatch], column: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``most`` bytes of a text column at most, one row at least."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = (np.cumsum(lengths) - lengths) // most
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if b > a:
                # a copy: some Arrow string functions misread slices that begin inside an array
                yield batch.take(pa.array(np.arange(a, b)))
        del batch
        give_back()


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def with_row_keys(docs: DataFrame) -> DataFrame:
    """``docs`` with ``row_file`` and ``row_index``, the place of each row in its Parquet files.

    The pair names a row whatever its columns hold, nulls and repeated rows
    included, and is the same in every pass. Rows that do not come from files
    are written to the shared folder first.
    """
    keys = {"row_file": F.xxhash64("_metadata.file_path"), "row_index": F.col("_metadata.row_index")}
    try:
        return docs.withColumns(keys)
    except AnalysisException:
        return stored(docs, "rows").withColumns(keys)


WIDTHS = {"boolean": 1, "byte": 1, "short": 2, "integer": 4, "float": 4}


def _row_bytes(df: DataFrame) -> Column:
    """About the bytes of a row: 16, and what its columns hold."""
    total = F.lit(16)
    for field in df.schema.fields:
        kind = field.dataType
        if kind.typeName() in ("string", "binary"):
            total = total + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif kind.typeName() == "array":
            total = total + WIDTHS.get(kind.elementType.typeName(), 8) * F.coalesce(F.size(field.name), F.lit(0))
        else:
            total = total + F.lit(WIDTHS.get(kind.typeName(), 8))
    return total


def small(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast if its bytes were counted to be few, else as it is. Give it a stored table: it is read twice."""
    return F.broadcast(df) if (df.agg(F.sum(_row_bytes(df))).first()[0] or 0) <= most else df


def by_place(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` with row keys and numbered columns, whose names clash with nothing, and (doc_id, text) of the same rows."""
    keyed = with_row_keys(docs.toDF(*(f"column{i}" for i in range(len(docs.columns)))))
    return keyed, keyed.select(*(F.col(f"column{docs.columns.index(c)}").alias(c) for c in ("doc_id", "text")))


def without_rows(keyed: DataFrame, dropped: DataFrame, columns: list[str]) -> DataFrame:
    """``keyed`` rows whose keys are not in ``dropped``, under the names ``columns`` of their documents."""
    keys = ["row_file", "row_index"]
    return keyed.join(small(stored(dropped.select(*keys), "dropped")), keys, "left_anti").drop(*keys).toDF(*columns)
