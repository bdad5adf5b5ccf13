"""Approximate nearest neighbours with an inverted multi-index.

Vectors are cut in two halves, each quantised by its own k-means; a cell is a pair of centroids.
A query walks the pairs in the order of summed distance with a heap until the cells hold enough
vectors, and all vectors of these cells are scored exactly. Cells lie in shards of some thousand
vectors, a cell of any size over as many shards as it needs; a block of queries and a shard are
one task's work.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import with_fields
from tablewright.llm.vectors import matrix, usable
from tablewright.sources.tables import stored

#: Vectors of a shard and queries of a block.
SHARD, BLOCK = 4096, 1024


def k_means(points: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    centres = points[np.random.default_rng(seed).choice(len(points), min(k, len(points)), replace=False)]
    for _ in range(rounds):
        nearest = _nearest(points, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        count = np.bincount(nearest, minlength=len(centres))
        centres = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centres)
    return centres


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres**2).sum(1) - 2 * points @ centres.T, axis=1)


def walk(first: np.ndarray, second: np.ndarray, counts: np.ndarray, wanted: int) -> list[int]:
    """Cells in the order of summed distance until they hold `wanted` vectors.

    `first` and `second` are the distances to the centroids of each half, `counts` the vectors of
    cell i * len(second) + j.
    """
    by_first, by_second = np.argsort(first, kind="stable").tolist(), np.argsort(second, kind="stable").tolist()
    a, b = first[by_first].tolist(), second[by_second].tolist()
    heap, taken, cells, have = [(a[0] + b[0], 0, 0)], [0] * (len(a) + 1), [], 0
    while heap and have < wanted:
        _, i, j = heapq.heappop(heap)
        cell = by_first[i] * len(b) + by_second[j]
        if counts[cell]:
            cells.append(cell)
            have += counts[cell]
        taken[i] = j + 1  # of row i the first j + 1 pairs are done
        if j + 1 < len(b) and (i == 0 or taken[i - 1] > j + 1):
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
        if i + 1 < len(a) and taken[i + 1] == j:
            heapq.heappush(heap, (a[i + 1] + b[j], i + 1, j))
    return cells


def _assign(batches: Iterator[pa.RecordBatch], first: np.ndarray, second: np.ndarray, half: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            v = matrix(batch.column("vector").to_pandas())
            cell = _nearest(v[:, :half], first) * len(second) + _nearest(v[:, half:], second)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype("i4"))], [*batch.schema.names, "cell"])


def _plan(batches: Iterator[pa.RecordBatch], first: np.ndarray, second: np.ndarray, half: int, counts: np.ndarray, wanted: int) -> Iterator[pa.RecordBatch]:
    begins = np.cumsum(counts) - counts
    plain = counts.tolist()
    for batch in batches:
        bits, shards = [], []
        for v in batch.column("vector").to_pandas():
            v = np.asarray(v, dtype=np.float64)
            near_first, near_second = first @ v[:half], second @ v[half:]
            cells = np.array(walk(near_first.max() - near_first, near_second.max() - near_second, plain, wanted), np.int64)
            seen = np.zeros(len(counts), bool)
            seen[cells] = True
            bits.append(np.packbits(seen).tobytes())
            touched = [np.arange(begins[c] // SHARD, (begins[c] + counts[c] - 1) // SHARD + 1) for c in cells]
            shards.append(np.unique(np.concatenate(touched)) if touched else np.zeros(0, np.int64))
        columns = [*batch.columns, pa.array(bits, pa.binary()), pa.array([s.astype("i8") for s in shards], pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "bits", "shards"])


def _score(queries: pd.DataFrame, vectors: pd.DataFrame, k: int, cells: int) -> pd.DataFrame:
    """The k best of a shard for each query of a block."""
    out = {"query_id": [], "vec_id": [], "score": []}
    if len(queries) and len(vectors):
        vectors = vectors.sort_values("cell", kind="stable")
        cell, ids = vectors.cell.to_numpy(), vectors.vec_id.to_numpy()
        v, q = matrix(vectors.vector), matrix(queries.vector)
        seen = np.unpackbits(np.frombuffer(b"".join(queries.bits), np.uint8).reshape(len(queries), -1), axis=1, count=cells).view(bool)
        score = np.full((len(q), len(v)), -np.inf)
        edges = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1], True])
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            who = np.flatnonzero(seen[:, cell[a]])
            score[who, a:b] = q[who] @ v[a:b].T
        query_ids = queries.query_id.to_numpy()
        score[query_ids[:, None] == ids[None, :]] = -np.inf
        rank = max(0, len(v) - k)
        least = np.partition(score, rank, axis=1)[:, rank]
        for row, (query, low) in enumerate(zip(query_ids, least, strict=True)):
            near = np.flatnonzero((score[row] >= low - 1e-9) & (score[row] > -np.inf))
            exact = (v[near] * q[row]).sum(1)  # the same sum for equal vectors wherever they lie
            best = np.lexsort((ids[near], -exact))[:k]
            out["query_id"].extend([query] * len(best))
            out["vec_id"].extend(ids[near][best])
            out["score"].extend(exact[best])
    return pd.DataFrame(out).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 20, id_column: str = "vec_id", vector_column: str = "embedding",
    centroids: int = 64, sample: int = 20_000, visit: float = 0.65,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k largest inner products among `vectors` but itself.

    Scores are inner products of the original vectors in double precision; ties go to the smaller
    id. The centroids are fitted on at most `sample` vectors, dealt by the hash of their ids; every
    vector is indexed. A query scores cells that together hold at least the share `visit` of all
    vectors, and k besides its own: that share sets the recall. Directions without any structure
    need a large one.

    Vectors that are null, zero, or hold null or non-finite components take no part, nor do vectors
    without id or of another length than most (on a tie the longer). Rows may repeat: each is a
    candidate; a repeated query id is one query (the smallest vector). Fewer candidates than k: all.
    """
    spark = vectors.sparkSession

    def clean(df: DataFrame) -> DataFrame:
        kind = F.col(vector_column).cast("array<float>") if dict(df.dtypes)[vector_column] == "array<float>" else F.col(vector_column).cast("array<double>")
        return df.select(F.col(id_column).cast("long").alias("vec_id"), kind.alias("vector")).where(F.col("vec_id").isNotNull() & usable("vector"))

    shape = "query_id long, rank int, vec_id long, score double"
    every = clean(vectors)
    sizes = every.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if sizes is None or sizes["d"] < 2:
        return spark.createDataFrame([], shape) if sizes is None else _plain(every.where("size(vector) = 1"), clean(queries), k)
    d, total = sizes["d"], sizes["count"]
    every = every.where(F.size("vector") == d)
    asked = clean(queries).where(F.size("vector") == d)
    blocks = max(1, math.ceil(asked.count() / BLOCK))
    # Walks are long for their few bytes: so many tasks as blocks, whatever the size of the shuffle.
    asked = asked.repartition(blocks, "vec_id").groupBy("vec_id").agg(F.min("vector").alias("vector"))
    some = matrix(every.orderBy(F.xxhash64("vec_id"), "vec_id", "vector").limit(sample).select("vector").toPandas()["vector"])
    half = d // 2
    first, second = k_means(some[:, :half], centroids), k_means(some[:, half:], centroids)
    cells = len(first) * len(second)
    indexed = stored(
        every.mapInArrow(lambda b: _assign(b, first, second, half), with_fields(every.schema, "cell int")), "cells"
    )
    counts = np.zeros(cells, np.int64)  # at most centroids^2 rows
    for row in indexed.groupBy("cell").count().collect():
        counts[row["cell"]] = row["count"]
    begins = np.cumsum(counts) - counts
    # A query sees none of the rows with its own id, and needs k others.
    most = indexed.groupBy("vec_id").count().agg(F.max("count")).first()[0]
    wanted = max(math.ceil(visit * total), k + most)
    planned = asked.mapInArrow(
        lambda b: _plan(b, first, second, half, counts, wanted), with_fields(asked.schema, "bits binary, shards array<long>")
    ).select(
        F.col("vec_id").alias("query_id"), "vector", "bits", F.explode("shards").alias("shard"),
        F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("block"),
    )
    layout = spark.createDataFrame(
        [(c, int(begins[c]), int(counts[c])) for c in np.flatnonzero(counts).tolist()], "cell int, first long, held long"
    )
    place = F.col("first") + F.pmod(F.xxhash64("vec_id", "vector"), F.col("held"))
    dealt = indexed.join(F.broadcast(layout), "cell").select(
        "vec_id", "vector", "cell", F.floor(place / SHARD).cast("long").alias("shard"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"),
    )
    scored = planned.groupBy("shard", "block").cogroup(dealt.groupBy("shard", "block")).applyInPandas(
        lambda q, v: _score(q, v, k, cells), "query_id long, vec_id long, score double"
    )
    return _ranked(scored, k)


def _ranked(scored: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )


def _plain(every: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """Vectors of one component have no halves: the best are the k largest or the k smallest numbers."""
    number = F.col("vector")[0].cast("double")
    numbers = every.select("vec_id", number.alias("x"))
    ends = numbers.orderBy(F.desc("x"), "vec_id").limit(k + 1).unionByName(numbers.orderBy("x", "vec_id").limit(k + 1)).distinct()
    queries = asked.where("size(vector) = 1").groupBy(F.col("vec_id").alias("query_id")).agg(F.min("vector").alias("vector")).select("query_id", number.alias("q"))
    scored = queries.withColumn("_", F.lit(1)).join(F.broadcast(ends.withColumn("_", F.lit(1))), "_").where("vec_id <> query_id")
    return _ranked(scored.select("query_id", "vec_id", (F.col("q") * F.col("x")).alias("score")), k)
