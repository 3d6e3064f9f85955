"""Arrow batches of texts, taken a bounded block at a time."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from llm.wordhash import BLOCK, blocks


def give_back() -> None:
    """Returns memory that this worker has freed to the machine: workers live on, and later stages share it with them."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def bound_batches(spark: SparkSession) -> None:
    """Rows of whole texts reach the workers a thousand at a time, some megabytes, and not ten thousand."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def map_texts(
    df: DataFrame,
    function: Callable[[list[str | None], pa.RecordBatch], dict | None],
    schema: str,
    text: str = "text",
    size: int = BLOCK,
) -> DataFrame:
    """`function(texts, rows)` on blocks of rows; it returns columns by name, or None for no rows.

    A block holds about `size` characters, so that memory doesn't follow the number of rows in an Arrow batch.
    """
    from pyspark.sql.types import _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema

    bound_batches(df.sparkSession)
    kinds = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text).to_pylist()
            for start, end in blocks(texts, size):
                out = function(texts[start:end], batch.slice(start, end - start))
                if out is not None:
                    yield pa.RecordBatch.from_arrays(
                        [x if isinstance(x, pa.Array) else pa.array(x, type=kind.type) for kind in kinds for x in [out[kind.name]]],
                        schema=kinds,
                    )
        give_back()

    return df.mapInArrow(run, schema)
