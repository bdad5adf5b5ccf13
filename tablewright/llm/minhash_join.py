"""Word n-gram Jaccard join: MinHash bands find pairs, full n-gram sets decide.

Texts with equal n-gram sets are one set from the start. A set's MinHash values are cut into
bands; sets that agree on a band meet in its bucket. A pair is looked at in the first band it
agrees on and nowhere else, so no list of pairs is ever shuffled or made distinct: buckets hold
only members, and give back only, per member, how many it links to and the smallest member that
it is linked with through others. Buckets of any size are cut into parts, and pairs of parts are
the unit of work, so a band that a third of all texts share is many small tasks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import block_count, connected, mix, text_bytes
from tablewright.llm.words import cut_batches, shingle_sets
from tablewright.sources.tables import stored

#: Members of one part of a bucket.
PART = 256
_NO_ID = -(2**63)


def choose_bands(threshold: float, recall: float, hashes: int = 96) -> tuple[int, int]:
    """The most rows per band, and the fewest bands, that find a pair at the threshold with the given probability.

    `hashes` bounds the rows, never the recall: where even one row per band needs more bands, there are more.
    """
    if not 0 < threshold <= 1 or not 0 < recall < 1:
        raise ValueError("threshold must be above 0 and at most 1, recall between 0 and 1")
    best = (1, 1)
    for rows in range(1, 17):
        agree = threshold**rows
        bands = max(1, math.ceil(math.log(1 - recall) / math.log1p(-agree))) if agree < 1 else 1
        if rows == 1 or bands * rows <= hashes:
            best = (bands, rows)
    return best


def _factors(n: int) -> np.ndarray:
    """An odd multiplier per hash function."""
    return np.random.default_rng(20240302).integers(0, 2**64, n, dtype=np.uint64) | np.uint64(1)


def band_hashes(values: np.ndarray, bounds: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One row of band hashes per non-empty set."""
    starts = bounds[:-1][bounds[1:] > bounds[:-1]]
    out = np.zeros((len(starts), bands), np.uint64)
    if not len(starts):
        return out
    factor = _factors(bands * rows)
    for band in range(bands):
        joint = np.full(len(starts), band + 1, np.uint64)
        for row in range(rows):
            j = band * rows + row
            low = np.minimum.reduceat(values * factor[j] + np.uint64(j), starts)
            joint = mix(joint + low)
        out[:, band] = joint
    return out


def _signatures(batches: Iterator[pa.RecordBatch], words: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in cut_batches(batches):
        values, bounds = shingle_sets(data, offsets, words)
        full = np.flatnonzero(bounds[1:] > bounds[:-1])
        joint = band_hashes(values, bounds, bands, rows)
        digests = [hashlib.blake2b(values[bounds[i]:bounds[i + 1]].tobytes(), digest_size=16).digest() for i in full]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id").take(pa.array(full)), batch.column("text_key").take(pa.array(full)),
                pa.array(digests, pa.binary()), pa.array([r.tobytes() for r in joint], pa.binary()),
            ],
            ["id", "text_key", "digest", "bands"],
        )


def _explode_bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = [np.frombuffer(b.as_py(), "i8") for b in batch.column("bands")]
        if keys:
            which = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), batch.column("digest").take(pa.array(which))], ["key", "digest"])


def _groups(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Rows of each pair of parts, each set once."""
    rows = rows.drop_duplicates(["key", "i", "j", "digest"]).sort_values(["key", "i", "j"], kind="stable")
    keys = rows[["key", "i", "j"]].to_numpy()
    cuts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(1), True])
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b - a > 1:
            yield rows.iloc[a:b]


def _first_pairs(group: pd.DataFrame) -> np.ndarray:
    """Which members of a pair of parts are to be compared here: the bucket's band is the first they agree on."""
    key, i, j = group.key.iloc[0], group.i.iloc[0], group.j.iloc[0]
    bands = np.frombuffer(b"".join(group.bands), "i8").reshape(len(group), -1)
    band = int((bands == key).all(0).argmax())
    here = np.triu(np.ones((len(group), len(group)), bool), 1)
    for earlier in range(band):
        here &= bands[:, earlier, None] != bands[None, :, earlier]
    if i != j:
        part = group.part.to_numpy()
        here &= part[:, None] != part[None, :]
    return here


def _needed(rows: pd.DataFrame) -> pd.DataFrame:
    """Members that have somebody to be compared with in a pair of parts."""
    out = [rows.iloc[:0]]
    for group in _groups(rows):
        here = _first_pairs(group)
        used = here.any(0) | here.any(1)
        if used.any():
            out.append(group[used])
    return pd.concat(out)


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections."""
    size = np.array([len(s) for s in sets])
    value = np.concatenate(sets)
    member = np.repeat(np.arange(len(sets)), size)
    order = np.argsort(value, kind="stable")
    value, member = value[order], member[order]
    new = np.r_[True, value[1:] != value[:-1]]
    place = np.cumsum(new) - 1
    often = np.bincount(place) > 1  # what one member has alone adds nothing
    kept = often[place]
    column = (np.cumsum(often) - 1)[place[kept]]
    member = member[kept]
    common = np.zeros((len(sets), len(sets)))
    wide = 4096
    for low in range(0, int(often.sum()), wide):
        a, b = np.searchsorted(column, [low, low + wide])
        dense = np.zeros((len(sets), wide), np.float32)
        dense[member[a:b], column[a:b] - low] = 1
        common += dense @ dense.T
    return common


def _verify(rows: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links of each member in each pair of parts, and the smallest set it hangs together with there."""
    digests, links, roots = [], [], []
    for group in _groups(rows):
        here = _first_pairs(group)
        sets = [np.frombuffer(s, "u8") for s in group["values"]]
        size = np.array([len(s) for s in sets])
        common = _common(sets)
        linked = here & (common >= threshold * (size[:, None] + size[None, :] - common) - 1e-9)
        linked |= linked.T
        if not linked.any():
            continue
        names, copies = group.digest.to_numpy(), group.copies.to_numpy()
        root = np.argsort(np.argsort(names))
        while True:
            least = np.where(linked, root[None, :], len(root)).min(1)
            after = np.minimum(root, least)
            if (after == root).all():
                break
            root = after
        count = linked @ copies
        ordered = np.sort(names)
        for k in np.flatnonzero(linked.any(1)):
            digests.append(names[k])
            links.append(int(count[k]))
            roots.append(ordered[root[k]])
    return pd.DataFrame({"digest": digests, "links": np.array(links, "i8"), "root": roots})


def _with_sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in cut_batches(batches):
        values, bounds = shingle_sets(data, offsets, words)
        sets = [values[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        # An id may stand for several texts: only the one with the wanted set goes on.
        same = [hashlib.blake2b(s, digest_size=16).digest() == d.as_py() for s, d in zip(sets, batch.column("digest"), strict=True)]
        columns = [batch.column("digest"), pa.array(sets, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["digest", "values"]).filter(pa.array(same, pa.bool_()))


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = 5, threshold: float = 0.8, recall: float = 0.99999
) -> DataFrame:
    """One row per row of `docs`: id, set_id, class_id, n_links.

    Two rows are linked if the sets of their word n-grams (words are runs without ASCII white
    space, case kept) have a Jaccard similarity of `threshold` or more. `set_id` is the smallest
    id with the same set, `class_id` the smallest id reachable over links, `n_links` the number
    of other rows linked directly. A pair at the threshold is found with probability `recall`.

    Texts with fewer words are one n-gram; texts that are null or without words link with nothing
    and are classes of their own. Repeated rows link with each other. Null ids take part; as a
    set_id or class_id they are passed over where the set or class has another id.
    """
    found = row_classes(docs, id_column, text_column, words, threshold, recall)
    return found.select(id_column, "set_id", "class_id", "n_links")


def row_classes(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = 5, threshold: float = 0.8, recall: float = 0.99999
) -> DataFrame:
    """`near_duplicates` with `text_key` (md5 of the text), which tells rows of one id apart, and `class_key`.

    Rows of one class share its `class_key`, whatever their ids; it is null for texts without words.
    """
    spark = docs.sparkSession
    bands, rows = choose_bands(threshold, recall)
    texts = docs.select(F.coalesce(F.col(id_column).cast("long"), F.lit(_NO_ID)).alias("id"), F.col(text_column).alias("text"))
    signed = stored(
        texts.withColumn("text_key", F.md5("text"))
        .mapInArrow(lambda b: _signatures(b, words, bands, rows), "id long, text_key string, digest binary, bands binary"), "signatures"
    )
    sets = stored(
        signed.groupBy("digest").agg(
            F.min("id").alias("rep"), F.min(F.when(F.col("id") != _NO_ID, F.col("id"))).alias("set_id"),
            F.count("*").alias("copies"), F.first("bands").alias("bands"),
        ), "sets"
    )
    members = sets.select("digest", "bands").mapInArrow(_explode_bands, "key long, digest binary")
    buckets = members.groupBy("key").count().where("count > 1")
    blocks = block_count(spark, text_bytes(texts, "text"))
    parts = F.ceil(F.col("count") / PART).cast("int")
    active = (
        members.join(buckets, "key").withColumn("part", F.pmod(F.xxhash64("digest"), parts).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
        .select("key", "digest", "part", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"))
    )
    where = F.pmod(F.xxhash64("key", "i", "j"), F.lit(blocks)).cast("int").alias("block")
    shape = "key long, digest binary, part int, i int, j int, bands binary"
    needed = stored(
        active.join(sets.select("digest", "bands"), "digest").withColumn("block", where).groupBy("block")
        .applyInPandas(lambda r: _needed(r)[["key", "digest", "part", "i", "j", "bands"]], shape), "needed"
    )
    wanted = needed.select("digest").distinct().join(sets.select("digest", F.col("rep").alias("id")), "digest")
    full = texts.join(wanted, "id").select("digest", "text").mapInArrow(lambda b: _with_sets(b, words), "digest binary, values binary")
    linked = stored(
        needed.join(full, "digest").join(sets.select("digest", "copies"), "digest").withColumn("block", where).groupBy("block")
        .applyInPandas(lambda r: _verify(r, threshold), "digest binary, links long, root binary"), "links"
    )
    counts = linked.groupBy("digest").agg(F.sum("links").alias("links"))
    hang = connected(linked.select(F.col("digest").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "digest")
    classes = sets.select("digest", "set_id", "copies").join(hang, "digest", "left").join(counts, "digest", "left")
    classes = classes.withColumn("component", F.coalesce("component", "digest"))
    smallest = classes.groupBy("component").agg(F.min("set_id").alias("class_id"))
    named = stored(
        classes.join(smallest, "component").select(
            "digest", "component", "set_id", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
        ), "classes"
    )
    linked_rows = signed.select("id", "text_key", "digest").join(named, "digest").select(
        "id", "set_id", "class_id", "n_links", "text_key", F.col("component").alias("class_key")
    )
    own = F.when(F.col("id") != _NO_ID, F.col("id"))
    empty = texts.where(F.col("text").isNull() | ~F.col("text").rlike(r"[^\x20\x09-\x0D]")).select(
        "id", own.alias("set_id"), own.alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.md5("text").alias("text_key"),
        F.lit(None).cast("binary").alias("class_key"),
    )
    return linked_rows.unionByName(empty).select(own.alias(id_column), "set_id", "class_id", "n_links", "text_key", "class_key")


def one_per_class(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options: float) -> DataFrame:
    """The rows of `docs` with one row of each class of near-duplicates: the smallest id, then the smallest md5 of the text.

    A row without an id stays only where no row of its class has one. Rows that repeat an id but not
    the text are documents of their own; of rows that repeat both, the smallest by all columns stays.
    Texts that are null or without words all stay. Columns of any name stay.
    """
    classes = row_classes(docs.select(id_column, text_column), id_column, text_column, **options).where("class_key is not null")
    first = F.min(F.struct(F.col(id_column).isNull().alias("none"), F.col(id_column).alias("id"), "text_key")).alias("_first")
    chosen = classes.groupBy("class_key").agg(first).select(F.col("_first.id").alias("_id"), F.col("_first.text_key").alias("_text_key"))
    wordless = F.col(text_column).isNull() | ~F.col(text_column).rlike(r"[^\x20\x09-\x0D]")
    same = F.col(id_column).eqNullSafe(F.col("_id")) & (F.md5(text_column) == F.col("_text_key"))
    kept = docs.where(~wordless).join(chosen, same, "left_semi")
    # Only rows that repeat another travel: their smallest is found by partial minima.
    key = [F.col(id_column).alias("_id"), F.md5(text_column).alias("_text_key")]
    copied = stored(docs.where(~wordless).groupBy(*key).count().where("count > 1").drop("count"), "copied")
    if not copied.isEmpty():
        single, several = kept.join(copied, same, "left_anti"), kept.join(copied, same, "left_semi")
        smallest = several.groupBy(*key).agg(F.min(F.struct(*docs.columns)).alias("_row"))
        kept = single.unionByName(smallest.select("_row.*"))
    return kept.unionByName(docs.where(wordless))
