"""What the operators of this folder share: document keys, byte batches, rolling hashes, written tables.

Documents are told apart by (doc_id, hash of the text): rows equal in both are one document that was
stored twice, so they get the same result and are no copies of each other. A null id comes after all
others. Results replace input columns of the same name; all other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repoquarry.session import materialize

NO_ID = 2**63 - 1  # stands for a null id: sorts last
BROADCAST_BYTES = 32 << 20  # largest table handed to every executor
SLICE = 1 << 20  # bytes of text worked on at once where nothing is gained by more
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15 | 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed(docs: DataFrame, id_col: str, text_col: str, key: str = "__document_key", mark: str = "__document_mark") -> DataFrame:
    """Add the two columns that tell documents apart; they survive any other columns of the table."""
    return docs.withColumns(
        {key: F.coalesce(docs[id_col].cast("long"), F.lit(NO_ID)), mark: F.hash(docs[text_col].cast("string"))}
    )


def id_of(key: Column) -> Column:
    return F.when(key != NO_ID, key)


def bound(value: Column, function) -> Column:
    """function(value) with the value worked out once, however often the function uses it."""
    return F.get(F.transform(F.array(value), function), F.lit(0))


def remainder_is(doc_id: Column, divisor: int, value: int) -> Column:
    """crc32 of the id as text, modulo divisor, equals value; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % divisor == value, F.lit(False))


def with_fields(schema: T.StructType, *fields: tuple[str, str], drop: tuple[str, ...] = ()) -> T.StructType:
    """The schema without columns of the new names, then the new ones: 'name', 'type'."""
    new = {n.lower() for n, _ in fields} | {n.lower() for n in drop}
    kept = [f for f in schema.fields if f.name.lower() not in new]
    added = [T.StructField(n, T._parse_datatype_string(t)) for n, t in fields]
    return T.StructType(kept + added)


def batch_of(batch: pa.RecordBatch, schema: T.StructType, added: dict[str, pa.Array]) -> pa.RecordBatch:
    """The batch with columns added, in the order of the schema."""
    return pa.RecordBatch.from_arrays(
        [added[n] if n in added else batch.column(n) for n in schema.names], schema.names
    )


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null is the empty text."""
    column = column.cast(pa.large_binary()) if not pa.types.is_string(column.type) else column.cast(pa.large_string()).cast(pa.large_binary())
    column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def slices(batch: pa.RecordBatch, text: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch by rows so that each piece has about ``most`` bytes of text, one row at least."""
    if not batch.num_rows:
        return
    sizes = np.asarray(pc.binary_length(batch.column(text)).fill_null(0)).astype(np.int64)
    piece = np.cumsum(sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield batch.slice(a, b - a)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Hashes of any stretches of a sequence from one running sum; equal stretches have equal hashes."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        power = np.full(n + 1, _MULTIPLIER, np.uint64)
        power[0] = 1
        np.cumprod(power, out=power)
        inverse = np.full(n + 1, np.uint64(pow(int(_MULTIPLIER), -1, 1 << 64)), np.uint64)
        inverse[0] = 1
        self._inverse = np.cumprod(inverse, out=inverse)
        self._sum = np.zeros(n + 1, np.uint64)
        np.cumsum(values.astype(np.uint64) * power[:n], out=self._sum[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self._sum[end] - self._sum[start]) * self._inverse[start] + (end - start).astype(np.uint64))

    def each(self, width: int) -> np.ndarray:
        """Hash of the stretch of ``width`` values at every place."""
        n = len(self._sum) - 1
        if n < width:
            return np.zeros(0, np.uint64)
        return mixed((self._sum[width:] - self._sum[: n - width + 1]) * self._inverse[: n - width + 1])


def smallest_within(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbouring values."""
    span, out = 1, values
    while span * 2 <= width:
        out, span = np.minimum(out[:-span], out[span:]), span * 2
    return out if span == width else np.minimum(out[: len(out) - (width - span)], out[width - span :])


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of a written table."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(target).getLength()


def joinable(df: DataFrame, name: str) -> DataFrame:
    """Write the smaller side of a join; hand it to every executor only if its file size allows that.

    Beyond BROADCAST_BYTES (files are compressed: a quarter of the bound) the join shuffles both sides.
    """
    written, path = materialize(df, name)
    return F.broadcast(written) if stored_bytes(df.sparkSession, path) * 4 <= BROADCAST_BYTES else written
