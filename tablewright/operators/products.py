"""Sparse products: a table of entries times a table of vectors, and the nearest rows of a sparse matrix.

Entries `(row, column, value)` and vectors are cut into blocks by their keys; a block with many
entries is cut again, so no cell grows with a hot row or column. What leaves a cell is summed there
before it is shuffled. A product cuts columns into ranges: where a row's columns lie near each other,
it is in few blocks, and only so many sums of it are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.functions.scalars import nine_digits, ratio
from tablewright.session import pieces
from tablewright.sources.tables import dropped, stored

#: Vectors of one block, and entries of one cell.
BLOCK_ROWS, CELL_ENTRIES = 1 << 14, 1 << 20
#: Products of one cell of a self-join, and how many are held at a time.
CELL_PRODUCTS, HELD_PRODUCTS = 1 << 23, 1 << 21
#: Entries that one round of ranges shuffles, about.
ROUND_ENTRIES = 1 << 26
#: Entries of one part of a long row.
PART_ENTRIES = 1024
#: Products of one cell of a product of two sparse tables; the lists of its columns are held at once.
ROW_PRODUCTS = 1 << 24
#: Stands for a null key inside a cell; sorts first, as nulls do.
NO_KEY = -(1 << 63)


def hashed(key: str, n: int | Column, seed: int = 7) -> Column:
    """Block of a key; salted, because shuffle rows are placed by an unsalted hash."""
    return F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(n) if isinstance(n, int) else n).cast("int")


def key_ranges(df: DataFrame, key: str, blocks: int, name: str) -> Bucketizer:
    """Ranges of about equally many rows; the cut points only balance the blocks."""
    points = df.approxQuantile(key, [i / blocks for i in range(1, blocks)], 0.25 / blocks) if blocks > 1 else []
    return Bucketizer(splits=[float("-inf"), *(sorted(set(points)) or [0.0]), float("inf")], inputCol=key, outputCol=name)


def matrix(vectors: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of a list column."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)


def list_column(rows: np.ndarray) -> pa.Array:
    """A list column of equally long rows."""
    bounds = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.ascontiguousarray(rows, np.float64).reshape(-1)))


def _cell_sums(entries: pa.Table, vectors: pa.Table) -> pa.Table:
    """Per row of a cell the sum of value x vector."""
    out = pa.schema([("row", pa.int64()), ("v", pa.list_(pa.float64()))])
    if not entries.num_rows or not vectors.num_rows:
        return out.empty_table()
    vectors = vectors.sort_by("col")
    keys, dense = vectors["col"].to_numpy(), matrix(vectors["v"])
    row, col, x = (entries[c].to_numpy() for c in ("row", "col", "x"))
    at = np.minimum(np.searchsorted(keys, col), len(keys) - 1)
    known = keys[at] == col
    order = np.flatnonzero(known)[np.argsort(row[known], kind="stable")]
    row, at, x = row[order], at[order], x[order]
    rows, first = np.unique(row, return_index=True)
    sums = np.zeros((len(rows), dense.shape[1]))
    step = max(1, (1 << 22) // dense.shape[1])
    for low in range(0, len(row), step):
        high = min(low + step, len(row))
        part = dense[at[low:high]] * x[low:high, None]
        a, b = np.searchsorted(first, low, "right") - 1, np.searchsorted(first, high, "left")
        sums[a:b] += np.add.reduceat(part, np.maximum(first[a:b] - low, 0))
    return pa.table([pa.array(rows), list_column(sums)], schema=out)


def sparse_times_dense(entries: DataFrame, dense: DataFrame, row: str, col: str, value: str, vector: str, name: str = "product") -> DataFrame:
    """`(row, name)`: for every row the sum over its entries of the value times the vector of the column.

    `dense` has one vector per column, named like the entries' column. Entries whose column has no
    vector, or a null one, add nothing; rows without any other entry are left out. Keys are whole numbers.
    """
    given = dense.select(F.col(col).cast("long").alias("col"), F.col(vector).alias("v")).where("v is not null and col is not null")
    ranges = key_ranges(given, "col", max(1, -(-given.count() // BLOCK_ROWS)), "cb")
    cells = entries.select(
        F.col(row).cast("long").alias("row"), F.col(col).cast("long").alias("col"), F.col(value).cast("double").alias("x")
    ).where("x is not null and col is not null")
    cells, given = ranges.transform(cells), ranges.transform(given)
    # A block of columns with many entries is cut by row; its vectors go to every cut.
    sizes = cells.groupBy("cb").agg(F.ceil(F.count("*") / CELL_ENTRIES).cast("int").alias("cuts"))
    # One row per block: neither entries nor vectors are shuffled to meet it.
    sizes = F.broadcast(sizes)
    cells = cells.join(sizes, "cb").withColumn("cut", hashed("row", F.col("cuts"), 9)).drop("cuts")
    there = sizes.select(F.col("cb").alias("_cb"), F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("cut"))
    placed = given.join(F.broadcast(there), F.col("cb") == F.col("_cb")).select("col", "v", "cb", "cut")
    sums = cells.groupBy("cb", "cut").cogroup(placed.groupBy("cb", "cut")).applyInArrow(_cell_sums, "row long, v array<double>")
    whole = sums.groupBy("row").agg(Summarizer.sum(array_to_vector("v")).alias("_s"))
    return whole.select(F.col("row").alias(row), vector_to_array("_s").alias(name))


def _cell_dots(pairs: pa.Table, left: pa.Table, right: pa.Table) -> pa.Table:
    """The inner product of the vectors of both sides of every pair; null where one is null."""
    score = np.full(pairs.num_rows, np.nan)
    at = []
    for side, key in ((left, "l"), (right, "c")):
        side = side.filter(pc.and_(pc.is_valid(side["v"]), pc.is_valid(side["key"]))).sort_by("key")
        keys, wanted = side["key"].to_numpy(), pairs[key].to_numpy()
        if not len(keys):
            return pairs.select(["l", "i"]).append_column("score", pa.nulls(pairs.num_rows, pa.float64()))
        place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        at.append((matrix(side["v"]), place, keys[place] == wanted))
    (a, i, known), (b, j, there) = at
    both = np.flatnonzero(known & there)
    step = max(1, (1 << 22) // a.shape[1])
    for low in range(0, len(both), step):
        part = both[low : low + step]
        score[part] = np.einsum("ij,ij->i", a[i[part]], b[j[part]])
    none = np.ones(len(score), bool)
    none[both] = False
    return pairs.select(["l", "i"]).append_column("score", pa.array(score, mask=none))


def pair_dots(pairs: DataFrame, left: DataFrame, right: DataFrame, left_id: str, right_id: str, left_vector: str, right_vector: str) -> DataFrame:
    """`(left_id, right_id, score)`: inner products for given pairs whose two sides have a row.

    Pairs are cut into ranges of the left key; a left vector goes to its range and a right vector once
    to each range that asks for it, equal ones as one. A block with a hot left key is cut by right key. Expects one vector per left key.
    """
    rows = right.select(F.col(right_id).cast("long").alias("i"), F.col(right_vector).alias("v"))
    classes = stored(rows.groupBy("v").agg(F.count("*").alias("n")).select("v", F.monotonically_increasing_id().alias("key")), "classes")
    # A null vector is a class too.
    of = rows.select("i", F.col("v").alias("_v")).join(classes, F.col("_v").eqNullSafe(F.col("v"))).select("i", F.col("key").alias("c"))
    vectors = left.select(F.col(left_id).cast("long").alias("key"), F.col(left_vector).alias("v"))
    given = pairs.select(F.col(left_id).cast("long").alias("l"), F.col(right_id).cast("long").alias("i"))
    given = stored(given.join(of, "i").join(vectors.select(F.col("key").alias("l")), "l"), "pairs")
    blocks = max(pieces(pairs.sparkSession), -(-given.count() // CELL_ENTRIES))
    cells = key_ranges(given, "l", blocks, "cb").transform(given)
    cuts = cells.groupBy("cb").agg(F.ceil(F.count("*") / (4 * CELL_ENTRIES)).cast("int").alias("cuts"))
    cells = cells.join(F.broadcast(cuts), "cb").withColumn("cut", hashed("c", F.col("cuts"), 9)).select("l", "i", "c", "cb", "cut")
    side = {}
    for name, key, source in (("l", "l", vectors), ("c", "c", classes)):
        asked = cells.select(F.col(key).alias("_key"), F.col("cb").alias("cb"), F.col("cut").alias("cut")).distinct()
        found = source.join(asked, F.col("key") == F.col("_key"))
        side[name] = found.select(F.col("key").alias("key"), F.col("v").cast("array<double>").alias("v"), "cb", "cut", F.lit(name).alias("side"))
    both = side["l"].unionByName(side["c"])

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        return _cell_dots(a, b.filter(pc.equal(b["side"], "l")), b.filter(pc.equal(b["side"], "c")))

    dots = cells.groupBy("cb", "cut").cogroup(both.groupBy("cb", "cut")).applyInArrow(run, "l long, i long, score double")
    return dots.select(F.col("l").cast(pairs.schema[left_id].dataType).alias(left_id), F.col("i").cast(pairs.schema[right_id].dataType).alias(right_id), "score")


def gram(rows: DataFrame, vector: str, width: int) -> np.ndarray:
    """Sum of the outer products of all vectors with themselves: width x width numbers, however many rows."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            if batch.num_rows:
                v = matrix(batch.column(0))
                total += v.T @ v
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width * width)), pa.array(total.ravel())], ["cell", "part"])

    cells = rows.select(vector).mapInArrow(partial, "cell long, part double").groupBy("cell").agg(F.sum("part").alias("s"))
    out = np.zeros(width * width)
    for r in cells.collect():
        out[r["cell"]] = r["s"]
    return out.reshape(width, width)


def times_matrix(rows: DataFrame, key: str, vector: str, right: np.ndarray) -> DataFrame:
    """Every vector times a small matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), list_column(matrix(batch.column(1)) @ right)], [key, vector])

    return rows.select(F.col(key).cast("long").alias(key), vector).mapInArrow(run, f"{key} long, {vector} array<double>")


def _cell_neighbours(left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    """Sums of products over the features of one cell for pairs that may be among the k best of their first item.

    With more cells than one for an item, what the others may add to a pair is at most the product
    of the two norms outside; a pair that stays under the k-th least certain sum by that is left out.
    """
    out = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("part", pa.float64())])
    if not left.num_rows or not right.num_rows:
        return out.empty_table()
    whole = left["cuts"][0].as_py() == 1
    lists = right["list"].combine_chunks()
    size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    feature, held = np.repeat(right["f"].to_numpy(), size), lists.flatten()
    b, xb = held.field("i").to_numpy(), held.field("x").to_numpy()
    order = np.argsort(feature, kind="stable")
    feature, b, xb = feature[order], b[order], xb[order]
    others, b = np.unique(b, return_inverse=True)
    rest_b = np.zeros(len(others)) if whole else np.sqrt(np.maximum(0, 1 - np.bincount(b, xb * xb)))
    order = np.argsort(left["i"].to_numpy(), kind="stable")
    a, f, xa = (left[c].to_numpy()[order] for c in ("i", "f", "x"))
    begin, end = np.searchsorted(feature, f), np.searchsorted(feature, f, "right")
    done = np.r_[0, np.cumsum(end - begin)]
    items, first = np.unique(a, return_index=True)
    bounds = np.r_[first, len(a)]
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    at = 0
    while at < len(items):
        # As many items as fit; one with more products is summed piece by piece.
        to = max(at + 1, int(np.searchsorted(done[bounds], done[bounds[at]] + HELD_PRODUCTS, "right")) - 1)
        keys, sums = np.zeros(0, np.int64), np.zeros(0)
        low = bounds[at]
        while low < bounds[to]:
            high = min(bounds[to], max(low + 1, int(np.searchsorted(done, done[low] + HELD_PRODUCTS, "right")) - 1))
            reps = end[low:high] - begin[low:high]
            l = np.repeat(np.arange(low, high), reps)
            r = np.arange(len(l)) - np.repeat(np.cumsum(reps) - reps, reps) + np.repeat(begin[low:high], reps)
            key = np.searchsorted(items, a[l]) * len(others) + b[r]
            key, where = np.unique(np.concatenate([keys, key]), return_inverse=True)
            keys, sums = key, np.bincount(where, np.concatenate([sums, xa[l] * xb[r]]), len(key))
            low = high
        x, y = keys // len(others), keys % len(others)
        other = items[x] != others[y]
        x, y, sums = x[other], y[other], sums[other]
        rest = np.zeros(len(x))
        if not whole:
            outside = np.sqrt(np.maximum(0, 1 - np.add.reduceat(xa * xa, first)))
            rest = outside[x] * rest_b[y]
        # The k-th sum that is certain: pairs that cannot reach it are not among the k best.
        sure = np.lexsort((-(sums - rest), x))
        place = np.arange(len(x)) - np.searchsorted(x[sure], x[sure])
        kth = np.full(len(items), -np.inf)
        kth[x[sure[place == k - 1]]] = (sums - rest)[sure[place == k - 1]]
        keep = sums + rest >= kth[x] - 2e-9
        found.append((items[x[keep]], others[y[keep]], sums[keep]))
        at = to
    return pa.table([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], schema=out)


def nearest_rows(entries: DataFrame, item: str, feature: str, value: str, k: int, cell_products: int = CELL_PRODUCTS) -> DataFrame:
    """`(item, neighbour, sim)`: for every item the k others of largest cosine over common features, exact.

    Items are cut into ranges of about equal work; a range gets the whole feature lists that its
    items are in, so all sums of an item arise in one cell and only its k best leave it. Where the
    items of a feature lie near each other, its list goes to few ranges. A range with a hot item is
    cut by feature as well; its cells then send what may still be among the k best, by the norms
    outside. Long feature lists travel in parts. Many entries are worked off in rounds of ranges: the
    shuffle files of a round go when its k best are written. Expects one entry per item and feature.
    """
    length = entries.groupBy(item).agg(F.sqrt(F.sum(F.col(value) * F.col(value))).alias("_len"))
    counts = entries.groupBy(feature).agg(F.count("*").alias("_n"))
    work = counts.agg(F.sum(F.col("_n") * F.col("_n")).cast("double")).first()[0] or 0.0
    blocks = int(max(pieces(entries.sparkSession), -(-work // cell_products)))
    rows = entered = stored(
        entries.join(length, item).join(counts, feature).select(
            F.col(feature).cast("long").alias("f"), F.col(item).cast("long").alias("i"), ratio(value, "_len").alias("x"), F.col("_n").alias("n"),
        ), "entries"
    )
    rows = key_ranges(rows, "i", blocks, "cb").transform(rows)
    cuts = rows.groupBy("cb").agg(F.ceil(F.sum("n") / (2 * cell_products)).cast("int").alias("cuts"))
    # One row per block of `cell_products` products.
    left = rows.join(F.broadcast(cuts), "cb").withColumn("cut", hashed("f", F.col("cuts"), 9)).select("f", "i", "x", "n", "cb", "cut", "cuts")
    # The ranges that a list goes to.
    asked = stored(left.select("f", "n", "cb", "cut").distinct(), "asked")
    lists = (
        rows.groupBy("f", hashed("i", F.ceil(F.col("n") / PART_ENTRIES), 11).alias("p")).agg(F.collect_list(F.struct("i", "x")).alias("list"))
        .select(F.col("f").alias("f"), "list")
    )
    best = Window.partitionBy(item).orderBy(nine_digits("sim").desc(), "neighbour")

    def nearest(left: DataFrame, asked: DataFrame) -> DataFrame:
        right = lists.join(asked.select(F.col("f").alias("_f"), "cb", "cut"), F.col("f") == F.col("_f")).select("f", "list", "cb", "cut")
        parts = left.drop("n").groupBy("cb", "cut").cogroup(right.groupBy("cb", "cut")).applyInArrow(
            lambda a, b: _cell_neighbours(a, b, k), "a long, b long, part double"
        )
        # Dealt by item once, for the sums and for the order.
        sims = parts.repartition("a").groupBy(F.col("a").alias(item), F.col("b").alias("neighbour")).agg(F.sum("part").alias("sim"))
        return sims.withColumn("_rn", F.row_number().over(best)).where(F.col("_rn") <= k).drop("_rn")

    turns = _turns(rows, asked)
    if len(turns) > 1:
        lists = stored(lists, "lists")
    found = [stored(nearest(left.where(t), asked.where(t)), "nearest") for t in turns]
    if len(turns) > 1:
        for table in (entered, asked, lists):
            dropped(table)
    return reduce(DataFrame.unionByName, found)


def _turns(rows: DataFrame, asked: DataFrame) -> list[Column]:
    """Conditions on the range `cb`, one per round: entries, and those of the lists that go to each range, about `ROUND_ENTRIES` at a time."""
    rounds = max(1, -(-(rows.count() + (asked.agg(F.sum("n")).first()[0] or 0)) // ROUND_ENTRIES))
    return [F.col("cb") % rounds == r for r in range(rounds)]


def _cell_weighted(left: pa.Table, right: pa.Table, k: int, weight_left: bool) -> pa.Table:
    """Sums of products and of weights per row and target of one cell.

    A cell that holds its rows whole leaves out what is seen and all but the k best of a row; the
    others send all sums and the seen pairs as marks.
    """
    out = pa.schema([("r", pa.int64()), ("t", pa.int64()), ("s", pa.float64()), ("w", pa.float64()), ("mark", pa.int32())])
    if not left.num_rows:
        return out.empty_table()
    whole = left["cuts"][0].as_py() == 1
    mark = left["mark"].to_numpy() == 1
    r, c, x = left["r"].to_numpy(), left["c"].to_numpy(), left["x"].to_numpy()
    there = left["x"].combine_chunks().is_valid().to_numpy(zero_copy_only=False)
    lists = right["list"].combine_chunks()
    held = lists.flatten()
    column = np.repeat(right["c"].to_numpy(), lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
    order = np.argsort(column, kind="stable")
    column, target, y = column[order], held.field("t").to_numpy()[order], held.field("y").to_numpy(zero_copy_only=False)[order]
    known = held.field("y").is_valid().to_numpy(zero_copy_only=False)[order]
    targets, target = np.unique(target, return_inverse=True)
    seen_r, seen_t = r[mark], c[mark]
    found = [] if whole else [(seen_r, seen_t, np.zeros(len(seen_r)), np.zeros(len(seen_r)), np.zeros(len(seen_r), bool), np.ones(len(seen_r), np.int32))]
    order = np.flatnonzero(~mark)[np.argsort(r[~mark], kind="stable")]
    a, c, x, there = r[order], c[order], x[order], there[order]
    begin, end = np.searchsorted(column, c), np.searchsorted(column, c, "right")
    done = np.r_[0, np.cumsum(end - begin)]
    rows, first = np.unique(a, return_index=True)
    bounds = np.r_[first, len(a)]
    # Seen pairs as numbers of row and target; what is in no list needs no mark.
    at_r, at_t = np.searchsorted(rows, seen_r), np.searchsorted(targets, seen_t)
    hit = (at_r < len(rows)) & (at_t < len(targets))
    hit[hit] = (rows[at_r[hit]] == seen_r[hit]) & (targets[at_t[hit]] == seen_t[hit])
    seen = np.unique(at_r[hit] * len(targets) + at_t[hit])
    at = 0
    while at < len(rows):
        # As many rows as fit; one with more products is summed piece by piece.
        to = max(at + 1, int(np.searchsorted(done[bounds], done[bounds[at]] + HELD_PRODUCTS, "right")) - 1)
        keys, sums, weights, terms = np.zeros(0, np.int64), np.zeros(0), np.zeros(0), np.zeros(0)
        low = bounds[at]
        while low < bounds[to]:
            high = min(bounds[to], max(low + 1, int(np.searchsorted(done, done[low] + HELD_PRODUCTS, "right")) - 1))
            reps = end[low:high] - begin[low:high]
            l = np.repeat(np.arange(low, high), reps)
            q = np.arange(len(l)) - np.repeat(np.cumsum(reps) - reps, reps) + np.repeat(begin[low:high], reps)
            both = there[l] & known[q]
            product = np.where(both, x[l] * y[q], 0.0)
            weight = np.where(there[l], np.abs(x[l]), 0.0) if weight_left else np.where(known[q], np.abs(y[q]), 0.0)
            key = np.searchsorted(rows, a[l]) * len(targets) + target[q]
            key, where = np.unique(np.concatenate([keys, key]), return_inverse=True)
            sums = np.bincount(where, np.concatenate([sums, product]), len(key))
            weights = np.bincount(where, np.concatenate([weights, weight]), len(key))
            terms = np.bincount(where, np.concatenate([terms, both]), len(key))
            keys, low = key, high
        if whole:
            place = np.minimum(np.searchsorted(seen, keys), max(len(seen) - 1, 0))
            keep = seen[place] != keys if len(seen) else np.ones(len(keys), bool)
            keys, sums, weights, terms = keys[keep], sums[keep], weights[keep], terms[keep]
        row, aim = keys // max(len(targets), 1), keys % max(len(targets), 1)
        if whole:
            scored = (terms > 0) & (weights != 0)
            digits = np.floor(np.nan_to_num(sums / np.where(scored, weights, 1.0)) * 1e9 + 0.5)
            order = np.lexsort((aim, -digits, ~scored, row))
            best = order[np.arange(len(row)) - np.searchsorted(row[order], row[order]) < k]
            row, aim, sums, weights, terms = row[best], aim[best], sums[best], weights[best], terms[best]
        found.append((rows[row], targets[aim], sums, weights, terms == 0, np.zeros(len(row), np.int32)))
        at = to
    if not found:
        return out.empty_table()
    r, t, s, w, none, marks = (np.concatenate(part) for part in zip(*found, strict=True))
    return pa.table([pa.array(r), pa.array(t), pa.array(s, mask=none), pa.array(w), pa.array(marks)], schema=out)


def weighted_topk(
    entries: DataFrame, links: DataFrame, row: str, col: str, x: str, target: str, y: str, weight: str, k: int, seen: DataFrame,
    row_products: int = ROW_PRODUCTS,
) -> DataFrame:
    """`(row, target, score, rank)`: for every row the k targets of largest weighted mean, those in `seen` left out, exact.

    The mean of a row and target is the sum of x times y over the entries `(row, col, x)` and links
    `(col, target, y)` of one column, over the sum of the absolute values of `weight` (x or y). Rows
    are cut into ranges of about as many entries; a range gets the lists of the columns it holds, so a
    row's sums arise in one cell and only its k best leave it: products are not shuffled. Where the
    columns of near rows are the same, a list goes to few ranges; large tables are worked off in rounds of ranges. A range with much work is cut by column too; its cells send their sums. Long lists travel in parts.
    Keys are whole numbers; rows and targets may be null.
    """
    whole_key = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(NO_KEY))
    counts = links.groupBy(F.col(col).cast("long").alias("c")).agg(F.count("*").alias("n")).where("c is not null")
    given = entries.select(whole_key(row).alias("r"), F.col(col).cast("long").alias("c"), F.col(x).cast("double").alias("x"))
    rows = stored(given.join(counts, "c").select("r", "c", "x", "n"), "entries")
    blocks = max(pieces(entries.sparkSession), -(-(rows.agg(F.sum("n")).first()[0] or 0) // row_products))
    ranges = key_ranges(rows, "r", blocks, "cb")
    rows = ranges.transform(rows)
    cuts = F.broadcast(rows.groupBy("cb").agg(F.ceil(F.sum("n") / (4 * row_products)).cast("int").alias("cuts")))
    marks = seen.select(whole_key(row).alias("r"), whole_key(target).alias("c"), F.lit(None).cast("double").alias("x"), F.lit(1).alias("mark"))
    left = rows.select("r", "c", "x", F.lit(0).alias("mark"), "cb").unionByName(ranges.transform(marks))
    left = left.join(cuts, "cb").withColumn("cut", hashed("c", F.col("cuts"), 9))
    asked = stored(rows.join(cuts, "cb").select("c", "n", "cb", hashed("c", F.col("cuts"), 9).alias("cut")).distinct(), "asked")
    parts = links.select(F.col(col).cast("long").alias("c"), whole_key(target).alias("t"), F.col(y).cast("double").alias("y")).join(counts, "c")
    lists = parts.groupBy("c", hashed("t", F.ceil(F.col("n") / PART_ENTRIES), 11).alias("p")).agg(F.collect_list(F.struct("t", "y")).alias("list"))
    best = Window.partitionBy("r").orderBy(nine_digits("score").desc(), "t")

    def topk(left: DataFrame, asked: DataFrame) -> DataFrame:
        right = lists.join(asked.select(F.col("c").alias("_c"), "cb", "cut"), F.col("c") == F.col("_c")).select("c", "list", "cb", "cut")
        sums = left.groupBy("cb", "cut").cogroup(right.groupBy("cb", "cut")).applyInArrow(
            lambda a, b: _cell_weighted(a, b, k, weight == x), "r long, t long, s double, w double, mark int"
        )
        whole = sums.groupBy("r", "t").agg(F.sum("s").alias("s"), F.sum("w").alias("w"), F.max("mark").alias("mark")).where("mark = 0")
        return whole.withColumn("score", ratio("s", "w")).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    turns = _turns(rows, asked)
    if len(turns) > 1:
        lists = stored(lists.select("c", "list"), "lists")
        ranked = reduce(DataFrame.unionByName, [stored(topk(left.where(t), asked.where(t)).select("r", "t", "score", "rank"), "lists") for t in turns])
    else:
        ranked = topk(left, asked)
    kinds = {row: entries.schema[row].dataType, target: links.schema[target].dataType}
    named = [F.nullif(F.col(c), F.lit(NO_KEY)).cast(kinds[n]).alias(n) for c, n in (("r", row), ("t", target))]
    return ranked.select(*named, "score", "rank")
