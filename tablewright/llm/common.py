"""What several operators share: table access, packed blocks of rows, 64-bit hashing, components."""

from __future__ import annotations

import io
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablewright.sources.tables import stored

#: Blocks of documents hold about so many bytes of text: what one Python worker keeps at a time.
BLOCK_BYTES = 4 << 20

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def with_fields(schema: StructType, ddl: str) -> StructType:
    """The schema with further fields."""
    return StructType(schema.fields + StructType.fromDDL(ddl).fields)


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def text_bytes(docs: DataFrame, text: str) -> int:
    """Bytes of all texts: the one number that sizes the blocks of a job."""
    return int(docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0])


def block_count(spark: SparkSession, total_bytes: int) -> int:
    return max(partitions(spark), math.ceil(total_bytes / BLOCK_BYTES))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def spread(keys: np.ndarray, n: int) -> np.ndarray:
    """Block number of each 64-bit key."""
    return (mix(keys.astype(np.int64).view(np.uint64) + _GOLDEN) % np.uint64(n)).astype(np.int32)


def pack(columns: Sequence[np.ndarray]) -> bytes:
    """Columns of equal length as one compressed value, byte planes apart so that small numbers cost little."""
    n = len(columns[0])
    planes = [np.ascontiguousarray(c).view(np.uint8).reshape(n, c.dtype.itemsize).T.tobytes() for c in columns]
    return n.to_bytes(8, "little") + zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpack(blob: bytes, kinds: Sequence[str]) -> list[np.ndarray]:
    n, raw = int.from_bytes(blob[:8], "little"), zstandard.ZstdDecompressor().decompress(blob[8:])
    out, at = [], 0
    for kind in kinds:
        width = np.dtype(kind).itemsize
        plane = np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n)
        out.append(np.ascontiguousarray(plane.T).reshape(-1).view(kind))
        at += n * width
    return out


def unpack_all(blobs: Sequence[bytes], kinds: Sequence[str]) -> list[np.ndarray]:
    parts = [unpack(b, kinds) for b in blobs]
    if not parts:
        return [np.zeros(0, kind) for kind in kinds]
    return [np.concatenate(c) for c in zip(*parts, strict=True)]


def by_block(block: np.ndarray, columns: Sequence[np.ndarray]) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The rows of each block number, in their given order."""
    if not len(block):
        return
    order = np.argsort(block, kind="stable")
    block = block[order]
    starts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
    for a, b in zip(starts, [*starts[1:], len(block)], strict=True):
        rows = order[a:b]
        yield int(block[a]), [c[rows] for c in columns]


def to_ipc(rows: pa.Table) -> bytes:
    sink = io.BytesIO()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(rows.combine_chunks())
    return sink.getvalue()


def from_ipc(blobs: Sequence[bytes]) -> pa.Table | None:
    tables = [pa.ipc.open_stream(b).read_all() for b in blobs]
    return pa.concat_tables(tables).combine_chunks() if tables else None


def byte_column(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column one after another, and where each row begins (and the last ends); null: empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_binary())
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components as (node, component), component being the smallest node; nodes of edges only.

    Large-star and small-star passes in turn: every pass links nodes to the smallest neighbour,
    so that paths shrink by half or more. Each pass is joins and partial minima, written to the
    shared folder; the driver sees one number per pass.
    """
    # (hi, lo) pairs; a node's smallest neighbour is found by a partial minimum, never by a list.
    now = stored(
        edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).where("hi <> lo").distinct(), "edges"
    )
    if now.isEmpty():
        return now.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    while True:
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            now.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        large = large.where("hi <> lo").distinct()
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low, "hi").select(
            F.when(F.col("lo") == F.col("m"), F.col("hi")).otherwise(F.col("lo")).alias("hi"), F.col("m").alias("lo")
        )
        after = stored(small.where("hi <> lo").distinct(), "edges")
        done = after.count() == now.count() and after.join(now, ["hi", "lo"], "left_anti").isEmpty()
        now = after
        if done:
            return now.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
