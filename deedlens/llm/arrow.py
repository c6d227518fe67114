"""Small helpers for functions over Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession


#: Texts that Spark hands to Python at once. Its default of 10,000 holds some 100 MB in each of several buffers.
TEXTS_AT_ONCE = 512


def small_batches(spark: SparkSession) -> None:
    """Bound what a task holds of texts on the way to Python and back; a smaller setting of the session stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= TEXTS_AT_ONCE:
        spark.conf.set(name, str(TEXTS_AT_ONCE))


def texts(column: pa.Array) -> Iterator[str]:
    """The strings of a column, NULL as the empty one, one after the other."""
    for value in column:
        yield value.as_py() or ""


def raw(column: pa.Array) -> Iterator[bytes]:
    """The same as UTF-8 bytes, without decoding them."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    for value in column.cast(kind):
        yield value.as_py() or b""


def lists(values: np.ndarray, lengths: list[int], kind: pa.DataType) -> pa.ListArray:
    """Lists of the given lengths cut from one flat array."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
