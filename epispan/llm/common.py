"""Small helpers the training-data operators share."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

#: Text handed to one step inside a task, so that a batch of very long texts stays bounded.
SLICE_CHARS = 8_000_000
#: Bytes Spark hands to a Python worker at once.
BATCH_BYTES = 64 << 20
_BATCH_SETTING, _UNBOUNDED = "spark.sql.execution.arrow.maxBytesPerBatch", 2**31 - 1
_ASCII_UPPER = re.compile("[A-Z]+")


def schema_of(text: str) -> StructType:
    return _parse_datatype_string(text)


def lower_ascii(text: str) -> str:
    """Lower-case A-Z only, whatever other letters the text holds."""
    return text.lower() if text.isascii() else _ASCII_UPPER.sub(lambda m: m[0].lower(), text)


def ascii_lower_bytes(text: str | None) -> bytes:
    """UTF-8 of a text with A-Z lower-cased (null: empty); byte-wise lowering touches nothing else."""
    return (text or "").encode("utf-8", "surrogatepass").lower()


def bound_batches(spark: SparkSession) -> None:
    """Bound the bytes of a batch as well as its rows, so that very long texts travel few at a time.

    A value the session has set itself stays.
    """
    if spark.conf.get(_BATCH_SETTING, str(_UNBOUNDED)) == str(_UNBOUNDED):
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


def map_arrow(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterable[dict]], schema: str) -> DataFrame:
    """``mapInArrow`` over a function that yields dictionaries of whole columns."""
    bound_batches(df.sparkSession)
    arrow = to_arrow_schema(schema_of(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in function(batches):
            yield pa.RecordBatch.from_arrays(
                [c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type) for f, c in ((f, columns[f.name]) for f in arrow)],
                schema=arrow,
            )

    return df.mapInArrow(run, schema)


def text_slices(batches: Iterator[pa.RecordBatch], limit: int = SLICE_CHARS) -> Iterator[tuple[list, list[str | None]]]:
    """Ids and texts (columns 0 and 1) in runs of bounded text; a single longer text is a run of its own."""
    ids: list = []
    texts: list[str | None] = []
    held = 0
    for batch in batches:
        for key, value in zip(batch.column(0), batch.column(1), strict=True):
            text = value.as_py()
            ids.append(key.as_py())
            texts.append(text)
            held += len(text or "")
            if held >= limit:
                yield ids, texts
                ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the splitmix64 finaliser)."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64, copy=True)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x
