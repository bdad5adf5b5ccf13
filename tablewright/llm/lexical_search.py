"""Ranked lexical search: term-at-a-time with a limit on accumulators, in shards of documents.

Texts become an index where they lie: per shard of `SHARD_BYTES` of text the postings of every
term, packed. A search joins the terms of its queries with the index (Spark chooses the kind of
join by size), so only postings of asked terms move, once per block of queries. Each (shard, block)
pair is worked off by itself: for a query the rarest term comes first; its postings open
accumulators. When the bounds of the terms still to come add up to less than the k-th partial
score, no new document can enter the first k, so no accumulator is opened any more and the rest of
the terms only raises those that are there, exactly. The first k of each shard meet in a top-k
per query.

All scores are whole numbers; the bound of a term is its highest share within the shard.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import pack, unpack
from tablewright.llm.words import cut_batches, word_spans
from tablewright.sources.tables import stored

#: Text of one shard of the index.
SHARD_BYTES = 8 << 20
#: Queries that share a pass over a shard.
QUERY_BLOCK = 256
#: Weight of a document's length against the mean, in hundredths, and of the whole length term.
LENGTH_SHARE, SATURATION = 75, 8
_SCALE = 1_000_000_000
#: Bytes that part terms: ASCII other than letters and digits.
_APART = np.zeros(256, bool)
_APART[[b for b in range(128) if not chr(b).isalnum()]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The terms of a batch of texts, and where each text's terms begin (and the last ends)."""
    start, end, first = word_spans(data, offsets, _APART)
    size = end - start
    at = np.r_[0, np.cumsum(size)]
    place = np.repeat(start - at[:-1], size) + np.arange(at[-1])
    column = pa.Array.from_buffers(pa.large_string(), len(size), [None, pa.py_buffer(at), pa.py_buffer(_LOWER[data[place]])])
    return column.dictionary_encode(), first


def _index(rows: Iterator[pa.RecordBatch], id_: str, text: str) -> Iterator[pa.RecordBatch]:
    """For every shard one row of its documents' ids and lengths, then one row a term: (document, occurrences) as pairs."""
    schema = pa.schema([
        ("shard", pa.int64()), ("term", pa.string()), ("df", pa.int64()), ("places", pa.binary()),
        ("ids", pa.list_(pa.int64())), ("lengths", pa.binary()), ("n_docs", pa.int64()), ("n_terms", pa.int64()),
    ])
    held: list[tuple[pa.Array, np.ndarray, pa.Array, np.ndarray, np.ndarray]] = []
    size = 0

    def emit() -> Iterator[pa.RecordBatch]:
        shard, lengths = uuid.uuid4().int >> 65, np.concatenate([h[1] for h in held])
        whole = pa.chunked_array([h[2] for h in held]).combine_chunks().dictionary_encode()
        renumber, at, base, keys, counts = whole.indices.to_numpy().astype(np.int64), 0, 0, [], []
        for _, n, terms, pair, times in held:
            keys.append(renumber[at:at + len(terms)][pair >> 32] << 32 | (pair & 0xFFFFFFFF) + base)
            counts.append(times)
            at, base = at + len(terms), base + len(n)
        key, count = np.concatenate(keys), np.concatenate(counts)
        order = np.argsort(key)
        key, count = key[order], count[order]
        yield pa.RecordBatch.from_pylist([{
            "shard": shard, "ids": pa.concat_arrays([h[0] for h in held]).to_pylist(), "lengths": pack([lengths.astype("<i8")]),
            "n_docs": int((lengths > 0).sum()), "n_terms": int(lengths.sum()),
        }], schema=schema)
        bounds = np.searchsorted(key >> 32, np.arange(len(whole.dictionary) + 1))
        pairs = np.column_stack([key & 0xFFFFFFFF, count]).astype("<u4")
        for a in range(0, len(whole.dictionary), 20_000):
            terms = whole.dictionary.slice(a, 20_000).cast(pa.string())
            cut = bounds[a:a + len(terms) + 1]
            places = pa.Array.from_buffers(
                pa.large_binary(), len(terms), [None, pa.py_buffer(8 * (cut - cut[0])), pa.py_buffer(pairs[cut[0]:cut[-1]].tobytes())]
            ).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(shard, len(terms)), terms, pa.array(np.diff(cut)), places, *(pa.nulls(len(terms), schema.field(i).type) for i in range(4, 8))],
                schema=schema,
            )

    for batch, data, offsets in cut_batches(rows, text):
        words, first = _words(data, offsets)
        doc = np.repeat(np.arange(batch.num_rows), np.diff(first))
        pair, times = np.unique(words.indices.to_numpy().astype(np.int64) << 32 | doc, return_counts=True)
        held.append((batch.column(id_).cast(pa.int64()), np.diff(first), words.dictionary, pair, times))
        size += len(data)
        if size >= SHARD_BYTES:
            yield from emit()
            held, size = [], 0
    if held:
        yield from emit()


def index(docs: DataFrame, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """The inverted index of all texts, written to the shared folder: per shard one row of its documents and one a term.

    Terms are runs of ASCII letters and digits and of all characters beyond ASCII, with A-Z in
    lower case. Null and empty texts are documents without terms; rows that repeat an id and rows
    without one are documents of their own; a text beyond a shard's size is a shard by itself; an
    empty table gives an empty index. Other columns are not looked at.
    """
    schema = "shard long, term string, df long, places binary, ids array<long>, lengths binary, n_docs long, n_terms long"
    chosen = docs.select(F.col(id_).alias("_id"), F.col(text).alias("_text"))
    return stored(chosen.mapInArrow(lambda rows: _index(rows, "_id", "_text"), schema), "index")


def query_terms(queries: DataFrame, id_: str = "item_id", text: str = "text") -> DataFrame:
    """Every query's terms and how often it holds each, by Spark expressions."""
    low = F.translate(F.col(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    terms = F.regexp_extract_all(low, F.lit(r"([0-9a-z\x{80}-\x{10FFFF}]+)"), 1)
    return queries.select(F.col(id_).alias("item_id"), F.explode(terms).alias("term")).groupBy("item_id", "term").agg(F.count("*").alias("times"))


def accumulate(
    terms: list[tuple[np.ndarray, np.ndarray]], most: list[int], n_docs: int, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """Documents with accumulators and their scores: (documents, shares) per term, the rarest first, and each term's highest share.

    Every document that can be among the first k is there with its exact score.
    """
    score, opened = np.zeros(n_docs, np.int64), np.zeros(n_docs, bool)
    left, opening, found = sum(most), True, np.zeros(0, np.int64)
    for (docs, share), bound in zip(terms, most, strict=True):
        if opening and len(found) >= k:
            # A document not yet opened gets at most what is left; one that ties may win by its id.
            opening = left >= int(np.partition(score[found], len(found) - k)[len(found) - k])
        if opening:
            score[docs] += share
            found = np.concatenate([found, docs[~opened[docs]]])
            opened[docs] = True
        else:
            there = opened[docs]
            score[docs[there]] += share[there]
        left -= bound
    return found, score[found]


def _search_shard(held: pa.Table, asked: pa.Table, k: int) -> pa.Table:
    """The first k documents of one shard for every query of one block."""
    out: dict[str, list] = {"item_id": [], "doc_id": [], "score": []}
    if held.num_rows and asked.num_rows:
        shard = held.slice(0, 1).to_pylist()[0]
        ids = np.array([(i is not None, i or 0) for i in shard["ids"]], dtype=[("is", bool), ("id", "i8")])
        (lengths,) = unpack(shard["lengths"], ["<i8"])
        m = 100 - LENGTH_SHARE + (LENGTH_SHARE * lengths * shard["all_docs"]) // max(1, shard["all_terms"])
        shares = {}
        for term, places, weight in zip(*(asked[c].to_pylist() for c in ("term", "places", "weight")), strict=True):
            docs, tf = np.frombuffer(places, "<u4").reshape(-1, 2).T.astype(np.int64)
            part = weight * ((_SCALE * tf) // (1000 * tf + SATURATION * m[docs]))
            shares[term] = (docs, part, int(part.max()))
        queries: dict[int | None, list] = {}
        for term, df, uses in zip(*(asked[c].to_pylist() for c in ("term", "all_df", "uses")), strict=True):
            for use in uses:
                queries.setdefault(use["item_id"], []).append((df, term, use["times"]))
        for item, terms in queries.items():
            terms.sort()
            lists = [(shares[t][0], shares[t][1] * times) for _, t, times in terms]
            docs, score = accumulate(lists, [shares[t][2] * times for _, t, times in terms], len(lengths), k)
            docs, score = docs[score > 0], score[score > 0]
            first = np.lexsort((ids["id"][docs], ids["is"][docs], -score))[:k]
            out["item_id"] += [item] * len(first)
            out["doc_id"] += [shard["ids"][d] for d in docs[first].tolist()]
            out["score"] += score[first].tolist()
    return pa.table({c: pa.array(v, pa.int64()) for c, v in out.items()})


def search(held: DataFrame, queries: DataFrame, k: int = 10, id_: str = "item_id", text: str = "text") -> DataFrame:
    """The k highest-scoring documents of an `index` for every query: item_id, rank, doc_id, score.

    Equal scores rank by ascending document id (null first). Fewer than k documents with a score
    above 0: these. A query without terms, null or empty, has no rows; rows that repeat a query id
    are one query of all their terms. Empty tables give no rows. A query text may be as long as
    a document: its distinct terms are rows.
    """
    total = held.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("d"), F.coalesce(F.sum("n_terms"), F.lit(0)).alias("t")).first()
    n = int(total["d"])
    blocks = max(1, math.ceil(queries.count() / QUERY_BLOCK))
    uses = query_terms(queries, id_, text).withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)))
    # Written, so that its size is known when Spark chooses the join.
    asked = stored(uses.groupBy("block", "term").agg(F.collect_list(F.struct("item_id", "times")).alias("uses")), "asked_terms")
    met = stored(held.where("term is not null").select("shard", "term", "df", "places").join(asked, "term"), "asked_postings")
    weight = F.floor(1000 * F.log((2 * F.lit(n) + 2).cast("double") / (2 * F.col("all_df") + 1))).cast("long")
    weights = met.select("shard", "term", "df").distinct().groupBy("term").agg(F.sum("df").alias("all_df")).withColumn("weight", weight)
    lists = met.join(weights, "term").select("shard", "block", "term", "places", "all_df", "weight", "uses")
    shards = (
        stored(met.select("shard", "block").distinct(), "asked_shards")
        .join(held.where("term is null").select("shard", "ids", "lengths"), "shard")
        .withColumns({"all_docs": F.lit(n), "all_terms": F.lit(int(total["t"]))})
    )
    found = (
        shards.groupBy("shard", "block").cogroup(lists.groupBy("shard", "block"))
        .applyInArrow(lambda a, b: _search_shard(a, b, k), "item_id long, doc_id long, score long")
    )
    place = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc("doc_id")))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
