"""Rows as the operators take them, whatever the table around them looks like."""

from __future__ import annotations

import ctypes
import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, SparkContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def quoted(name: str) -> str:
    """A column's name as an expression, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def by_value(context: SparkContext, value: object) -> Broadcast:
    """Broadcast a value with the code of its class, which executors need not have installed."""
    return context.broadcast(cloudpickle.dumps(value))


def value_of(shared: Broadcast):
    return pickle.loads(shared.value)


def keyed(docs: DataFrame, doc_id: str, text: str, carry: bool = False) -> DataFrame:
    """Id, text (null: empty) and a 64-bit key of both, which also tells repeated ids apart.

    With `carry` all columns but the text come along in one struct, `carried`.
    """
    columns = [
        F.col(quoted(doc_id)).alias("doc_id"),
        F.coalesce(F.col(quoted(text)), F.lit("")).alias("text"),
    ]
    if carry:
        columns.append(F.struct(*[quoted(c) for c in docs.columns if c != text]).alias("carried"))
    rows = docs.select(*columns)
    return rows.select(F.xxhash64("doc_id", "text").alias("key"), *rows.columns)


def release() -> None:
    """Give back to the system what this worker has freed but still holds.

    Workers outlive their tasks, and what idle ones keep counts against an executor's memory.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library
    if trim is not None:
        trim(0)


def releasing(task: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The task, which releases memory when it is done."""

    def run(batches: Iterator) -> Iterator:
        yield from task(batches)
        release()

    return run


def released(found: pa.Table) -> pa.Table:
    """What the task of a group found, after it released memory."""
    release()
    return found


def beside(task: Callable, columns: str, *inputs: str) -> Column:
    """A struct column that a task computes from input columns.

    Only the inputs go to Python and only the struct comes back; the rows' other columns, long
    texts among them, wait in the JVM.  `task` maps an iterator of arrays, or of tuples of arrays
    where there are several inputs, to an iterator of struct arrays of the same lengths.  It is
    marked as nondeterministic, so that a filter on its result does not compute it once more.
    """
    made = F.arrow_udf(releasing(task), StructType.fromDDL(columns), F.ArrowUDFType.SCALAR_ITER)
    return made.asNondeterministic()(*inputs)


def struct_of(**columns: pa.Array | np.ndarray) -> pa.StructArray:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()]
    return pa.StructArray.from_arrays(arrays, list(columns))


def carried_back(rows: DataFrame, schema: StructType, text: str) -> DataFrame:
    """The columns of the table that `keyed` was given, in its order."""
    return rows.select(
        *[F.col(text).alias("text") if f.name == "text" else F.col(f"carried.{quoted(f.name)}") for f in schema]
    )


def whole_groups(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.Table]:
    """Rows that come ordered by `column`, in tables that never split a value's rows."""
    left = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        rows = rows if left is None else pa.concat_tables([left, rows]).combine_chunks()
        values = rows[column].to_numpy()
        other = np.flatnonzero(values != values[-1])
        ended = int(other[-1]) + 1 if len(other) else 0
        if ended:
            yield rows.slice(0, ended).combine_chunks()
        left = rows.slice(ended)
    if left is not None:
        yield left.combine_chunks()
