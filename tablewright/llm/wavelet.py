"""Token ids in wavelet matrix files: one succinct, searchable file per shard of documents.

Texts are encoded where they lie; ids then move to the shard of their document id. A shard's ids
in document order become bit-planes (most significant first; each plane sorts the next one stably
by its bit) with counts of ones at block starts. From the file alone a token at a place, the
number of a token before a place and the place of a token's k-th occurrence are found without
decoding the rest. The files are binary values of a Parquet table, one row and file per shard, so
that any store that Spark writes to will do.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewright.llm.common import block_count, by_block, pack, text_bytes, unpack_all
from tablewright.llm.word_tokens import Runs, WordTokens
from tablewright.llm.words import cut_batches
from tablewright.sources.tables import save_parquet

MAGIC = b"WAVELET1"
_BLOCK = 512  # bits between stored counts of ones
_NO_ID = -(2**63)
_DOC = ("i8", "i8")  # id, number of tokens


class WaveletMatrix:
    """Bit-planes with rank and select over a sequence of small integers."""

    def __init__(self, n: int, zeros: list[int], planes: list[np.ndarray], counts: list[np.ndarray]) -> None:
        self.n, self.zeros, self.planes, self.counts = n, zeros, planes, counts

    @classmethod
    def build(cls, values: np.ndarray, bits: int) -> WaveletMatrix:
        zeros, planes, counts = [], [], []
        for shift in range(bits - 1, -1, -1):
            one = (values >> shift) & 1 == 1
            plane = np.packbits(one, bitorder="little")
            padded = np.concatenate([plane, np.zeros(-len(plane) % (_BLOCK // 8), np.uint8)])
            per_block = np.bitwise_count(padded).reshape(-1, _BLOCK // 8).sum(1)
            counts.append(np.r_[0, np.cumsum(per_block)].astype("<u4"))
            planes.append(plane)
            zeros.append(int(len(values) - counts[-1][-1]))
            values = np.concatenate([values[~one], values[one]])
        return cls(len(one) if bits else 0, zeros, planes, counts)

    def _ones(self, level: int, at: int) -> int:
        block = at // _BLOCK
        first = block * (_BLOCK // 8)
        rest = np.unpackbits(self.planes[level][first:(at + 7) // 8], bitorder="little")[: at - block * _BLOCK]
        return int(self.counts[level][block]) + int(rest.sum())

    def access(self, at: int) -> int:
        """The value at a place."""
        value = 0
        for level, zeros in enumerate(self.zeros):
            bit = int(self.planes[level][at >> 3]) >> (at & 7) & 1
            ones = self._ones(level, at)
            at = zeros + ones if bit else at - ones
            value = 2 * value + bit
        return value

    def _descend(self, value: int, at: int) -> tuple[int, int]:
        """Begin of the value's run in the last order, and where `at` falls in it."""
        begin = 0
        for level, zeros in enumerate(self.zeros):
            low, high = self._ones(level, begin), self._ones(level, at)
            bit = value >> (len(self.zeros) - 1 - level) & 1
            begin, at = (zeros + low, zeros + high) if bit else (begin - low, at - high)
        return begin, at

    def rank(self, value: int, at: int) -> int:
        """How often the value stands before a place."""
        begin, end = self._descend(value, at)
        return end - begin

    def count(self, value: int, low: int, high: int) -> int:
        return self.rank(value, high) - self.rank(value, low)

    def select(self, value: int, k: int) -> int:
        """The place of the value's k-th occurrence (from 0)."""
        begin, end = self._descend(value, self.n)
        if not 0 <= k < end - begin:
            raise IndexError(f"value {value} stands {end - begin} times")
        at = begin + k
        for level in range(len(self.zeros) - 1, -1, -1):
            zeros = self.zeros[level]
            bit = value >> (len(self.zeros) - 1 - level) & 1
            at = self._place(level, at - zeros if bit else at, bit)
        return at

    def _place(self, level: int, k: int, bit: int) -> int:
        """The place of the k-th one or zero of a plane."""
        counts = self.counts[level].astype(np.int64)
        if not bit:
            counts = np.arange(len(counts)) * _BLOCK - counts
        block = int(np.searchsorted(counts, k, "right")) - 1
        first = block * (_BLOCK // 8)
        bits = np.unpackbits(self.planes[level][first:first + _BLOCK // 8], bitorder="little")
        return block * _BLOCK + int(np.flatnonzero(bits == bit)[k - int(counts[block])])

    def values(self) -> np.ndarray:
        """The whole sequence: planes are undone from the last to the first."""
        out = np.zeros(self.n, np.uint16 if len(self.zeros) <= 16 else np.uint32)
        for level in range(len(self.zeros) - 1, -1, -1):
            one = np.unpackbits(self.planes[level], count=self.n, bitorder="little").view(bool)
            before = np.empty_like(out)
            before[~one] = out[: self.zeros[level]]
            before[one] = out[self.zeros[level]:] | out.dtype.type(1 << (len(self.zeros) - 1 - level))
            out = before
        return out

    def to_bytes(self) -> bytes:
        head = np.array([self.n, len(self.zeros), *self.zeros], "<u8").tobytes()
        return head + b"".join(p.tobytes() + c.tobytes() for p, c in zip(self.planes, self.counts, strict=True))

    @classmethod
    def from_bytes(cls, raw: bytes) -> WaveletMatrix:
        n, bits = (int(x) for x in np.frombuffer(raw, "<u8", 2))
        zeros = [int(x) for x in np.frombuffer(raw, "<u8", bits, 16)]
        at, wide, blocks = 16 + 8 * bits, (n + 7) // 8, -(-n // _BLOCK) + 1
        planes, counts = [], []
        for _ in range(bits):
            planes.append(np.frombuffer(raw, np.uint8, wide, at))
            counts.append(np.frombuffer(raw, "<u4", blocks, at + wide))
            at += wide + 4 * blocks
        return cls(n, zeros, planes, counts)


def shard_file(ids: np.ndarray, sizes: np.ndarray, tokens: np.ndarray, bits: int) -> bytes:
    """Document ids and sizes, and the wavelet matrix of all their tokens."""
    documents = zstandard.ZstdCompressor().compress(ids.astype("<i8").tobytes() + sizes.astype("<i8").tobytes())
    return MAGIC + np.array([len(ids), len(documents)], "<u8").tobytes() + documents + WaveletMatrix.build(tokens, bits).to_bytes()


def read_shard(raw: bytes) -> tuple[np.ndarray, np.ndarray, WaveletMatrix]:
    """Document ids, their numbers of tokens, and the matrix of a shard's file."""
    if raw[:8] != MAGIC:
        raise ValueError("not a wavelet file")
    n, wide = (int(x) for x in np.frombuffer(raw, "<u8", 2, 8))
    documents = zstandard.ZstdDecompressor().decompress(raw[24:24 + wide])
    return np.frombuffer(documents, "<i8", n), np.frombuffer(documents, "<i8", n, 8 * n), WaveletMatrix.from_bytes(raw[24 + wide:])


_workers: dict[int, WordTokens] = {}


def _encode(
    batches: Iterator[pa.RecordBatch], tokenizer: Broadcast, end_id: int, cuts: np.ndarray
) -> Iterator[pa.RecordBatch]:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    key = hash(tokenizer.value)
    if key not in _workers:
        _workers[key] = WordTokens(tokenizer.value)
    for batch, data, offsets in cut_batches(batches):
        found = _workers[key].encode(data, offsets)
        ends = np.cumsum(found.sizes)
        found = Runs(np.insert(found.values, ends, np.uint32(end_id)), found.sizes + 1)
        ids = batch.column("id").to_numpy(zero_copy_only=False).astype("i8")
        shards, blobs = [], []
        for shard, (at,) in by_block(np.searchsorted(cuts, ids, "right").astype(np.int32), [np.arange(len(ids))]):
            own = found.take(at)
            head = pack([ids[at], own.sizes])
            shards.append(shard)
            blobs.append(len(head).to_bytes(8, "little") + head + pack([own.values]))
        yield pa.RecordBatch.from_arrays([pa.array(shards, pa.int32()), pa.array(blobs, pa.binary())], ["shard", "blob"])


def _build(rows: pa.Table, bits: int) -> pa.Table:
    heads, bodies = [], []
    for blob in rows["blob"].to_pylist():
        cut = 8 + int.from_bytes(blob[:8], "little")
        heads.append(blob[8:cut])
        bodies.append(blob[cut:])
    ids, sizes = unpack_all(heads, _DOC)
    (tokens,) = unpack_all(bodies, ("u4",))
    begins = np.cumsum(sizes) - sizes
    order = np.argsort(ids, kind="stable")
    if len(np.unique(ids)) < len(ids):  # rows that repeat an id stand by their tokens
        texts = [tokens[b:b + s].astype(">u4").tobytes() for b, s in zip(begins, sizes, strict=True)]
        order = np.array(sorted(range(len(ids)), key=lambda i: (ids[i], texts[i])))
    size = sizes[order]
    place = np.repeat(begins[order] - (np.cumsum(size) - size), size) + np.arange(size.sum())
    raw = shard_file(ids[order], size, tokens[place], bits)
    return pa.table({"shard": rows["shard"][:1], "n_tokens": pa.array([len(tokens)], pa.int64()), "file": pa.array([raw], pa.binary())})


def write_tokens(
    docs: DataFrame, path: str, tokenizer_path: str, end_id: int, id_column: str = "doc_id", text_column: str = "text"
) -> str:
    """Encode all texts and write their ids, each document ended by `end_id`, as wavelet files in ascending id order.

    The table at `path` has shard (ascending with the ids), n_tokens and file. Null texts are empty:
    their only id is the end id. A null id is the smallest. Rows that repeat an id stand by their
    tokens. An empty table writes no file.

    The tokenizer's file is read by the driver and broadcast: a vocabulary of fixed size.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        content = f.read()
    from tokenizers import Tokenizer

    bits = max(1, math.ceil(math.log2(max(Tokenizer.from_str(content).get_vocab_size(), end_id + 1))))
    tokenizer = spark.sparkContext.broadcast(content)
    rows = docs.select(F.coalesce(F.col(id_column).cast("long"), F.lit(_NO_ID)).alias("id"), F.col(text_column).alias("text"))
    shards = block_count(spark, text_bytes(rows, "text"))
    # The cut points only balance the shards: any would give the same ids at the same places.
    cuts = rows.select(F.expr(f"percentile_approx(id, array({','.join(str((i + 1) / shards) + 'D' for i in range(shards - 1))}), {20 * shards})")) if shards > 1 else None
    found = cuts.first()[0] if cuts is not None else None
    edges = np.unique(np.array(found or [], "i8"))
    files = (
        rows.mapInArrow(lambda b: _encode(b, tokenizer, end_id, edges), "shard int, blob binary")
        .groupBy("shard").applyInArrow(lambda t: _build(t, bits), "shard int, n_tokens long, file binary")
    )
    return save_parquet(files, path)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for shard, raw in zip(batch.column("shard").to_pylist(), batch.column("file"), strict=True):
            ids, sizes, matrix = read_shard(raw.as_py())
            tokens = matrix.values().astype("<u4").tobytes()
            ends = np.cumsum(sizes)
            crc = [zlib.crc32(tokens[4 * (e - s):4 * e]) for s, e in zip(sizes.tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard] * len(ids), pa.int32()), pa.array(ids), pa.array(ends - sizes), pa.array(sizes), pa.array(crc, pa.int64())],
                ["shard", "id", "within", "n_tokens", "ids_crc32"],
            )


def read_tokens(spark: SparkSession, path: str, id_column: str = "doc_id") -> DataFrame:
    """id, start (ids of all documents before it), n_tokens, ids_crc32 of every document, read from the files at `path`."""
    files = spark.read.schema("shard int, n_tokens long, file binary").parquet(path)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("shard", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("first"))
    rows = files.select("shard", "file").mapInArrow(_read, "shard int, id long, within long, n_tokens long, ids_crc32 long")
    return rows.join(starts, "shard").select(
        F.when(F.col("id") != _NO_ID, F.col("id")).alias(id_column), (F.col("first") + F.col("within")).alias("start"), "n_tokens", "ids_crc32"
    )
