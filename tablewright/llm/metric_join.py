"""Exact near-duplicate vectors: a metric range join on pivots.

A cosine bound is a distance bound between unit vectors. Within a label, some vectors are pivots
and every vector is at home in the cell of its nearest pivot h. A vector v within r of u can only
miss u's cell q if d(v, q) > d(v, h) + 2r (triangle inequality), or if v lies further than r
beyond the plane between h and q; all others are copied to q. So each vector meets all its
neighbours in its own home cell, cells are joined by themselves, and links are counted once per end.

Equal vectors are one vector with a number of copies from the start. The home vectors of a cell and
all its members are cut into parts; a pair of parts is the unit of work. Copies are kept as names, and
vectors go to the pairs in rounds whose shuffle files are freed, so disk does not grow with the pairs.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import connected, partitions, with_fields
from tablewright.llm.vectors import matrix, usable
from tablewright.sources.tables import stored

#: Vectors that one pivot stands for, the most pivots of a label, and vectors of one part of a cell.
#: Where vectors have no structure nearly every cell gets a copy, so cells are as large as one task compares at ease.
PER_PIVOT, MOST_PIVOTS, PART = 8192, 256, 1 << 14
#: Cosines held at a time, and bytes of vectors that one round of pairs of parts shuffles, about.
HELD_COSINES, ROUND_BYTES = 1 << 22, 1 << 30
_KEYS = ["label", "size", "cell", "i", "j"]


def _unit(vectors: pd.Series) -> np.ndarray:
    v = matrix(vectors)
    v /= np.abs(v).max(1, keepdims=True)  # squares of very small or large numbers would leave the range
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def cells_of(u: np.ndarray, pivots: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """Each unit vector's home, and for every pivot whether the vector goes to its cell."""
    d = np.sqrt(np.maximum(0, ((u[:, None, :] - pivots[None, :, :]) ** 2).sum(2)))
    home = d.argmin(1)
    at_home = d[np.arange(len(u)), home]
    apart = np.sqrt(((pivots[:, None, :] - pivots[None, :, :]) ** 2).sum(2))[home]
    beyond = (d**2 - at_home[:, None] ** 2) / np.where(apart > 0, 2 * apart, 1)
    goes = (d <= at_home[:, None] + 2 * radius) & (beyond <= radius)
    goes[np.arange(len(u)), home] = True
    return home, goes


def _spread(vectors: pd.DataFrame, pivots: pd.DataFrame, radius: float) -> pd.DataFrame:
    if vectors.empty or pivots.empty:
        return vectors.assign(cell=np.zeros(0, "i4"), home=np.zeros(0, bool)).iloc[:0]
    u, p = _unit(vectors.vector), _unit(pivots.sort_values("place").vector)
    parts = []
    for low in range(0, len(u), 256):  # a few vectors at a time against all pivots
        home, goes = cells_of(u[low:low + 256], p, radius)
        row, cell = np.nonzero(goes)
        parts.append((row + low, cell, home[row] == cell))
    row, cell, at_home = (np.concatenate(c) for c in zip(*parts, strict=True))
    return vectors.iloc[row].assign(cell=cell.astype("i4"), home=at_home)


def _join(rows: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """Links of each home vector with the members of a pair of parts, and what hangs together there."""
    out: list[tuple[bytes, int, bytes]] = []
    for _, group in rows.groupby(_KEYS, sort=False):
        own, members = group[group.as_home], group[group.as_member]
        if own.empty or members.empty:
            continue
        a, b, copies = _unit(own.vector), _unit(members.vector).T, members.copies.to_numpy()
        names = np.unique(group.node.to_numpy())
        left, right = np.searchsorted(names, own.node.to_numpy()), np.searchsorted(names, members.node.to_numpy())
        root, count, linked = np.arange(len(names)), np.zeros(len(names)), np.zeros(len(names), bool)
        step = max(1, HELD_COSINES // len(members))
        for low in range(0, len(own), step):  # a few home vectors at a time against all members
            i, j = np.nonzero(a[low:low + step] @ b >= cosine)
            x, y = left[low + i], right[j]
            other = x != y
            x, y = x[other], y[other]
            count += np.bincount(x, copies[j[other]], len(names))
            linked[x] = linked[y] = True
            while (root[x] != root[y]).any():
                least, to = np.minimum(root[x], root[y]), np.arange(len(names))
                np.minimum.at(to, root[x], least)
                np.minimum.at(to, root[y], least)
                while (to[to] != to).any():
                    to = to[to]
                root = to[root]
        out.extend(zip(names[linked], count[linked].astype("i8"), names[root[linked]], strict=True))
    return pd.DataFrame(out, columns=["node", "links", "root"]).astype({"links": "int64"})


def near_vectors(
    vectors: DataFrame, cosine: float = 0.98, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label"
) -> DataFrame:
    """One row per row: id, n_links, component_id, kept.

    Two rows are linked if their labels are equal and not null and their vectors' cosine, in double
    precision, is at least `cosine`. `n_links` counts the other rows linked directly, `component_id`
    is the smallest id reachable over links, `kept` says whether that is the row's own.

    Vectors that are null, zero, or hold null or non-finite components link with nothing, nor do
    vectors of different lengths with each other; they are components of their own. Repeated rows
    link with each other. A null id is passed over as a component's id if the component has another.
    """
    spark = vectors.sparkSession
    radius = math.sqrt(max(0.0, 2 - 2 * cosine)) + 1e-9
    rows = vectors.select(F.col(id_column).alias("id"), F.col(label_column).alias("label"), F.col(vector_column).alias("vector"))
    good = F.col("label").isNotNull() & usable("vector")
    # The name of a (label, vector): shortest decimal forms tell all different numbers apart; -0 is 0.
    text = F.concat_ws(":", F.col("label").cast("string"), F.array_join(F.transform("vector", lambda x: x + F.lit(0).cast("float")), ","))
    rows = rows.withColumn("node", F.when(good, F.unhex(F.md5(text))))
    distinct = stored(
        rows.where("node is not null").groupBy("node").agg(
            F.min("id").alias("rep"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("vector").alias("vector")
        ).withColumn("size", F.size("vector")), "vectors"
    )
    group = ["label", "size"]
    per_label = distinct.groupBy(*group).agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy(*group).orderBy(F.xxhash64("node"), "node"))
    pivots = distinct.select(*group, "vector", "node").withColumn("place", place).where(F.col("place") <= MOST_PIVOTS)
    pivots = pivots.join(per_label, group).where(F.col("place") <= F.ceil(F.col("n") / PER_PIVOT))
    chunks = F.ceil(F.col("n") / PART).cast("int")
    dealt = distinct.join(per_label, group).withColumn("chunk", F.pmod(F.xxhash64("node"), chunks).cast("int"))
    known = pivots.withColumn("chunk", F.explode(F.sequence(F.lit(0), chunks - 1)))
    keys = [*group, "chunk"]
    shape = with_fields(distinct.select(*group, "node").schema, "cell int, home boolean")
    names = shape.names
    members = stored(
        dealt.select(*keys, "node", "vector").groupBy(*keys).cogroup(known.select(*[F.col(c).alias(c) for c in (*keys, "place", "vector")]).groupBy(*keys))
        .applyInPandas(lambda v, p: _spread(v, p, radius)[names], shape), "members"
    )
    cell = [*group, "cell"]
    def parts(n):
        return F.greatest(F.lit(1), F.ceil(n / PART)).cast("int")

    sizes = members.groupBy(*cell).agg(F.count_if("home").alias("_own"), F.count("*").alias("_n"))
    sizes = sizes.select(*cell, "_own", "_n", parts(F.col("_own")).alias("homes"), parts(F.col("_n")).alias("parts"))
    copied = F.col("_own") * F.col("parts") + F.col("_n") * F.col("homes")
    total = sizes.agg(F.coalesce(F.sum(copied), F.lit(0)).alias("rows"), F.coalesce(F.sum(copied * (F.col("size") * 4 + 64)), F.lit(0)).alias("bytes")).first()
    rounds = max(1, math.ceil(total["bytes"] / ROUND_BYTES))
    placed = members.join(sizes.drop("_own", "_n"), cell)

    def part(n: str):
        return F.pmod(F.xxhash64("node"), F.col(n)).cast("int")

    def pair(i, j, as_home, as_member):
        return F.struct(i.alias("i"), j.alias("j"), as_home.alias("as_home"), as_member.alias("as_member"))

    at_home = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: pair(part("homes"), j, F.col("home"), j == part("parts")))
    as_member = F.transform(
        F.sequence(F.lit(0), F.col("homes") - 1), lambda i: pair(i, part("parts"), F.lit(False), ~F.col("home") | (i != part("homes")))
    )
    pairs = F.filter(F.concat(F.when(F.col("home"), at_home).otherwise(F.array().cast("array<struct<i:int,j:int,as_home:boolean,as_member:boolean>>")), as_member), lambda x: x["as_home"] | x["as_member"])
    blocks = max(partitions(spark), math.ceil(total["rows"] / rounds / (4 * PART)))
    work = placed.withColumn("_p", F.explode(pairs)).select(*cell, "_p.*", "node")
    unit = F.xxhash64(*_KEYS)
    work = work.withColumn("block", F.pmod(unit, F.lit(blocks)).cast("int"))
    found = []
    for r in range(rounds):
        now = work.where(F.pmod(F.xxhash64(unit, F.lit(5)), F.lit(rounds)) == r) if rounds > 1 else work
        now = now.join(distinct.select("node", "copies", "vector"), "node")
        found.append(stored(now.groupBy("block").applyInPandas(lambda r: _join(r, cosine), "node binary, links long, root binary"), "links"))
    linked = reduce(DataFrame.unionByName, found)
    hang = connected(linked.select(F.col("node").alias("a"), F.col("root").alias("b")))
    counts = linked.groupBy("node").agg(F.sum("links").alias("links"))
    classes = distinct.select("node", "rep", "copies").join(hang, "node", "left").join(counts, "node", "left")
    classes = classes.withColumn("component", F.coalesce("component", "node"))
    smallest = classes.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = classes.join(smallest, "component").select(
        "node", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    out = rows.select("id", "node").join(stored(named, "components"), "node", "left")
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(
        F.col("id").alias(id_column), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(component == F.col("id"), component.isNull()).alias("kept"),
    )
