"""Quality by importance resampling: how much likelier a text is as target text than as raw text.

Both sides are bags of hashed unigrams and bigrams with a fixed number of buckets. The raw model
counts every document; the target model counts documents that a bounded sample of labels calls
good. A document's log weight is the sum of its n-grams' log ratios, less an offset per n-gram that
held-out labels set. Gumbel noise, seeded by the
id, turns the k largest sums into a weighted sample without replacement.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import mix
from tablewright.llm.words import cut_batches, span_hashes
from tablewright.sources.tables import stored

BUCKETS = 1 << 14
#: Labelled rows that the target model may be fitted on: a sample dealt by the hash of the id.
LABELS = 200_000

_KIND = np.full(256, 2, np.uint8)  # 0 white space, 1 letters and digits, 2 other
_KIND[[0x20, *range(0x09, 0x0E)]] = 0
_KIND[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
_NO_ID = -(2**63)


def ngram_buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all unigrams and bigrams, and the document of each. Tokens are runs of one kind of byte."""
    kind = _KIND[data]
    fresh = np.zeros(len(data) + 1, bool)
    fresh[offsets] = True
    change = np.r_[True, kind[1:] != kind[:-1]][: len(data)] | fresh[:-1]
    starts = np.flatnonzero(change)
    ends = np.r_[starts[1:], len(data)]
    real = kind[starts] > 0
    starts, ends = starts[real], ends[real]
    h = span_hashes(data, starts, ends)
    doc = np.searchsorted(offsets, starts, "right") - 1
    together = doc[1:] == doc[:-1]
    pairs = mix(h[:-1] * np.uint64(3) + h[1:])[together]
    buckets = np.concatenate([h, pairs]) & np.uint64(BUCKETS - 1)
    return buckets.astype(np.int64), np.concatenate([doc, doc[1:][together]])


def _counts(batches: Iterator[pa.RecordBatch], good: np.ndarray) -> Iterator[pa.RecordBatch]:
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch, data, offsets in cut_batches(batches):
        buckets, doc = ngram_buckets(data, offsets)
        raw += np.bincount(buckets, minlength=BUCKETS)
        chosen = np.isin(batch.column("id").to_numpy(zero_copy_only=False), good)
        target += np.bincount(buckets[chosen[doc]], minlength=BUCKETS)
    used = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(raw[used]), pa.array(target[used])], ["bucket", "raw", "target"])


def _means(batches: Iterator[pa.RecordBatch], ratios: np.ndarray, chosen: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Mean log ratio of the chosen documents' n-grams."""
    for batch in batches:
        batch = batch.filter(pa.array(np.isin(batch.column("id").to_numpy(zero_copy_only=False), chosen)))
        for part, data, offsets in cut_batches([batch]):
            buckets, doc = ngram_buckets(data, offsets)
            count = np.bincount(doc, minlength=part.num_rows)
            mean = np.bincount(doc, ratios[buckets], part.num_rows) / np.maximum(count, 1)
            full = pa.array(count > 0)
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(mean)], ["id", "mean"]).filter(full)


def best_cut(means: np.ndarray, good: np.ndarray) -> float:
    """The mean log ratio that parts good from bad best: largest sum of both shares that fall on their side."""
    if not good.any():
        return 0.0
    if good.all():
        return float(min(0.0, means.min()))
    order = np.argsort(means, kind="stable")
    means, good = means[order], good[order]
    bad_below = np.r_[0, np.cumsum(~good)] / (~good).sum()
    good_above = 1 - np.r_[0, np.cumsum(good)] / good.sum()
    edges = np.r_[means[0] - 1, (means[1:] + means[:-1]) / 2, means[-1] + 1]
    real = np.r_[True, means[1:] > means[:-1], True]
    return float(edges[np.where(real, bad_below + good_above, -1).argmax()])


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", labelled: int = LABELS) -> np.ndarray:
    """Log ratio of each bucket, less an offset per n-gram.

    Half of the labelled documents, dealt by the hash of their ids, show the target: those of
    quality 1 that are not toxic. A document that the target model has not seen looks unlikely for
    that alone, the more so the fewer labels there are; the other half of the labels therefore sets
    the offset, where the documents of the target and the others, toxic ones among them, part best. At most `labelled` labels are used. Without
    good labels all ratios are 0. Labels with null ids or null quality are passed over; of several
    labels of a document the worst holds.
    """
    sample = labels.where(F.col(id_column).isNotNull() & F.col("quality").isNotNull()).groupBy(F.col(id_column).cast("long").alias("id")).agg(
        F.min("quality").alias("quality"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic")
    )
    rows = sample.orderBy(F.xxhash64("id"), "id").limit(labelled).collect()
    ids = np.array([r["id"] for r in rows], np.int64)
    fine = np.array([r["quality"] == 1 for r in rows], bool)
    clean = np.array([r["toxic"] == 0 for r in rows], bool)
    shown = mix(ids.view(np.uint64)) & np.uint64(1) == 1
    target_ids = np.sort(ids[shown & fine & clean])
    texts = docs.select(F.coalesce(F.col(id_column).cast("long"), F.lit(_NO_ID)).alias("id"), F.col(text_column).alias("text"))
    found = texts.mapInArrow(lambda b: _counts(b, target_ids), "bucket long, raw long, target long").groupBy("bucket").agg(
        F.sum("raw").alias("raw"), F.sum("target").alias("target")
    )
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for row in found.collect():  # one row per bucket at most
        raw[row["bucket"]], target[row["bucket"]] = row["raw"], row["target"]
    if not target.sum():
        return np.zeros(BUCKETS)
    ratios = np.log(target + 1) - np.log(raw * (target.sum() / raw.sum()) + 1)
    held, wanted = ids[~shown], dict(zip(ids.tolist(), (fine & clean).tolist(), strict=True))
    means = texts.mapInArrow(lambda b: _means(b, ratios, np.sort(held)), "id long, mean double").toPandas()  # labelled rows only
    if means.empty:
        return ratios
    means = means.sort_values(["mean", "id"])
    return ratios - best_cut(means["mean"].to_numpy(), np.array([wanted[i] for i in means["id"]], bool))


def _scores(batch: pa.RecordBatch, ids: str, data: np.ndarray, offsets: np.ndarray, ratios: np.ndarray, seed: int, noise: float) -> tuple[np.ndarray, np.ndarray]:
    """Log weight of each document, and that plus its Gumbel noise."""
    buckets, doc = ngram_buckets(data, offsets)
    weight = np.bincount(doc, ratios[buckets], batch.num_rows) if len(doc) else np.zeros(batch.num_rows)
    key = batch.column(ids).cast(pa.int64()).fill_null(_NO_ID).to_numpy().view(np.uint64)
    uniform = ((mix(key + np.uint64(seed * 0x9E3779B97F4A7C15 % 2**64)) >> np.uint64(11)).astype(float) + 0.5) / 2**53
    return weight, weight - noise * np.log(-np.log(uniform))


def _ordered(key: np.ndarray) -> np.ndarray:
    """Integers in the order of the numbers."""
    bits = (key + 0.0).view(np.int64)
    return bits ^ ((bits >> 63) & np.int64(2**63 - 1))


def _score_rows(batches: Iterator[pa.RecordBatch], ratios: np.ndarray, seed: int, noise: float) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in cut_batches(batches):
        weight, key = _scores(batch, "id", data, offsets, ratios, seed, noise)
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(weight), pa.array(key), pa.array(_ordered(key))], ["id", "log_weight", "key", "place"])


def kth_largest(scores: DataFrame, place: str, k: int) -> int:
    """The k-th largest 64-bit integer: counts per 16 leading bits, then within one such range, four times."""
    low, width = -(2**63), 48
    while True:
        inside = scores.where(F.col(place).between(low, low + 2 ** (width + 16) - 1))
        part = F.shiftright(F.col(place) - F.lit(low), width) if low >= 0 or width < 48 else F.shiftright(place, width)
        counts = {r[0]: r[1] for r in inside.groupBy(part.alias("part")).count().collect()}  # 65,536 at most
        for bucket in sorted(counts, reverse=True):
            if k <= counts[bucket]:
                low = (bucket << width) if width == 48 else low + (bucket << width)
                break
            k -= counts[bucket]
        if width == 0:
            return low
        width -= 16


def score(docs: DataFrame, ratios: np.ndarray, id_column: str = "doc_id", text_column: str = "text", seed: int = 11, noise: float = 1.0) -> DataFrame:
    """id, log_weight, key (log weight plus Gumbel noise) and place (the key as an ordered integer) of every document, stored."""
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    return stored(
        rows.mapInArrow(lambda b: _score_rows(b, ratios, seed, noise), "id long, log_weight double, key double, place long"), "scores"
    )


def threshold(scores: DataFrame, k: int | None = None) -> int | None:
    """The place from which documents are taken: the k largest keys.

    By default k is the number of documents with a log weight of 0 or more.
    Equal keys at the end are all taken. None if nothing is to be taken.
    """
    total, likely = scores.agg(F.count("*"), F.count_if(F.col("log_weight") >= 0)).first()
    k = likely if k is None else min(k, total)
    return kth_largest(scores, "place", k) if k > 0 else None


def _take(batches: Iterator[pa.RecordBatch], ids: str, text: str, ratios: np.ndarray, seed: int, noise: float, least: int) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in cut_batches(batches, text):
        _, key = _scores(batch, ids, data, offsets, ratios, seed, noise)
        yield batch.filter(pa.array(_ordered(key) >= least))


def take(docs: DataFrame, ratios: np.ndarray, least: int | None, id_column: str = "doc_id", text_column: str = "text", seed: int = 11, noise: float = 1.0) -> DataFrame:
    """The rows of `docs` whose key reaches the threshold, unchanged: scored again where they lie instead of joined."""
    if least is None:
        return docs.limit(0)
    return docs.mapInArrow(lambda b: _take(b, id_column, text_column, ratios, seed, noise, least), docs.schema)
