"""Tags and documents: cleaning, counting, co-occurrence, search."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.ladders import ordered_numbers
from tablewright.functions.scalars import nine_digits, ratio
from tablewright.operators.columns import exploded_genres, normalised_tag
from tablewright.operators.products import hashed
from tablewright.session import pieces
from tablewright.sources.tables import stored

#: Postings and query tokens of one cell of a search, and how many scores and products are held at a time.
BLOCK_POSTINGS, BLOCK_TOKENS, HELD_SCORES = 1 << 20, 1 << 16, 1 << 21


def clean_tags(tags: DataFrame, lemmas: dict[str, str] | None = None) -> DataFrame:
    """Normalised tags, empties dropped, one row per user, item and tag.

    `lemmas` is a small table of word forms to replace word by word.
    """
    clean = normalised_tag("tag")
    if lemmas:
        table = F.create_map(*[F.lit(x) for pair in lemmas.items() for x in pair])
        clean = F.array_join(F.transform(F.split(clean, " "), lambda w: F.coalesce(F.try_element_at(table, w), w)), " ")
    # Dealt by pair first, so that the patterns run in as many tasks as the shuffle has and equal tags meet without another one.
    dealt = tags.select("userId", "movieId", "tag").repartition("userId", "movieId")
    out = dealt.select("userId", "movieId", clean.alias("tag_clean")).where(F.length("tag_clean") > 0)
    return out.dropDuplicates(["userId", "movieId", "tag_clean"])


def top_tags(tags: DataFrame, n: int, tag: str = "tag_clean") -> DataFrame:
    counts = tags.groupBy(tag).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), tag).limit(n)


def top_tags_per_genre(tags: DataFrame, movies: DataFrame, n: int = 150) -> DataFrame:
    """Tags are counted per film before genres multiply the rows."""
    per_film = tags.groupBy("movieId", "tag_clean").agg(F.count(F.lit(1)).alias("_n"))
    counts = per_film.join(exploded_genres(movies), "movieId").groupBy("genre", "tag_clean").agg(F.sum("_n").alias("n"))
    best = Window.partitionBy("genre").orderBy(F.desc("n"), "tag_clean")
    return counts.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n)


def tag_relevance(tags: DataFrame) -> DataFrame:
    """`(movieId, tag_clean, relevance)`: share of the item's most frequent tag."""
    counts = tags.groupBy("movieId", "tag_clean").agg(F.count(F.lit(1)).alias("n"))
    peak = counts.groupBy("movieId").agg(F.max("n").alias("_peak"))
    return counts.join(peak, "movieId").select("movieId", "tag_clean", ratio("n", "_peak").alias("relevance"))


def relevance_vectors(relevance: DataFrame) -> tuple[DataFrame, DataFrame]:
    """`(vectors, tags)`: per item one vector over all tags of the table, and the tags by number.

    A vector is kept as the numbers of the item's tags in rising order and their relevances; all other
    places are 0. Tags are numbered in alphabetical order, so vectors of one table share their places.
    """
    tags = ordered_numbers(relevance, ["tag_clean"], "tag_number")
    placed = relevance.join(tags, "tag_clean").groupBy("movieId").agg(F.sort_array(F.collect_list(F.struct("tag_number", "relevance"))).alias("_e"))
    # An item holds each tag once, so its list is bounded by the number of its distinct tags.
    return placed.select("movieId", F.col("_e.tag_number").alias("places"), F.col("_e.relevance").alias("relevances")), tags


def cooccurrence(tags: DataFrame, top_n: int = 80, min_edge: int = 30) -> DataFrame:
    """Edges `(a, b, weight)` among the commonest tags: the number of items holding both.

    An item's list holds at most `top_n` distinct tags, so its pairs are bounded; they are summed
    in the task that makes them and only one row per edge and task is shuffled.
    """
    # At most top_n rows, whatever the data size.
    top = F.broadcast(top_tags(tags, top_n).select("tag_clean"))
    sets = tags.join(top, "tag_clean", "left_semi").groupBy("movieId").agg(
        F.array_sort(F.collect_set("tag_clean")).alias("s")
    )
    left = sets.select("s", F.posexplode("s").alias("i", "a"))
    pairs = left.select("a", F.explode(F.slice("s", F.col("i") + 2, F.lit(top_n))).alias("b"))
    return pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("weight")).where(F.col("weight") >= min_edge)


def weighted_degree(edges: DataFrame, n: int = 40) -> DataFrame:
    """Sum of edge weights per node, the n largest."""
    ends = edges.select(F.explode(F.array("a", "b")).alias("node"), "weight")
    return ends.groupBy("node").agg(F.sum("weight").alias("degree")).orderBy(F.desc("degree"), "node").limit(n)


def tokens(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """`(key, token, tf)` over the whole text."""
    words = F.split(F.lower(F.col(text)), r"[^\p{L}\p{N}]+")
    return (
        df.select(key, F.explode(words).alias("token"))
        .where(F.col("token") != "")
        .groupBy(key, "token")
        .agg(F.count(F.lit(1)).alias("tf"))
    )


def token_weights(documents: DataFrame, doc_id: str, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """`(weights, idf)`: TF-IDF weight of every token of every document, and the smoothed idf of every token."""
    doc_tokens = stored(tokens(documents, doc_id, text), "tokens")
    n_docs = documents.agg(F.count(F.lit(1))).scalar()
    held = doc_tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    # Smoothed logarithm of documents over documents holding the token.
    idf = stored(held.select("token", (F.log((F.lit(1.0) + n_docs) / (F.col("df") + 1)) + 1).alias("idf")), "idf")
    return doc_tokens.join(idf, "token").select(doc_id, "token", (F.col("tf") * F.col("idf")).alias("_w")), idf


def impacts(weights: DataFrame, doc_id: str, asked: DataFrame) -> DataFrame:
    """`(doc_id, token, impact)` of the tokens in `asked`: the weight of a token over the length of the document's vector."""
    norms = weights.groupBy(doc_id).agg(F.sqrt(F.sum(F.col("_w") * F.col("_w"))).alias("_dn"))
    wanted = weights.join(asked, "token", "left_semi")
    return wanted.join(norms, doc_id).select(doc_id, "token", ratio("_w", "_dn").alias("impact"))


def _cell_scores(postings: pa.Table, asked: pa.Table, k: int) -> pa.Table:
    """The k best documents of every query in a cell that holds its documents and queries whole."""
    out = pa.schema([("q", asked.schema.field("q").type), ("d", postings.schema.field("d").type), ("score", pa.float64())])
    if not postings.num_rows or not asked.num_rows:
        return out.empty_table()
    words, queries = pc.unique(asked["token"]), pc.unique(asked["q"])
    docs = pc.unique(postings["d"])
    docs = docs.take(pc.sort_indices(docs))
    word, q = (pc.index_in(asked[c], v).to_numpy() for c, v in (("token", words), ("q", queries)))
    at, d = (pc.index_in(postings[c], v).to_numpy(zero_copy_only=False) for c, v in (("token", words), ("d", docs)))
    order = np.argsort(word, kind="stable")
    word, q, qw = word[order], q[order], asked["qw"].to_numpy()[order]
    order = np.argsort(d, kind="stable")
    order = order[~np.isnan(at[order])]
    at, d, impact = at[order].astype(np.int64), d[order].astype(np.int64), postings["impact"].to_numpy()[order]
    begin, reps = np.searchsorted(word, at), np.searchsorted(word, at, "right") - np.searchsorted(word, at)
    done = np.r_[0, np.cumsum(reps)]
    best_q, best_d, best_s = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    width = max(1, HELD_SCORES // len(queries))
    for first in range(0, len(docs), width):
        # The scores of some documents for all queries of the cell.
        n = min(width, len(docs) - first)
        score = np.zeros(len(queries) * n)
        low, end = np.searchsorted(d, (first, first + n))
        while low < end:
            high = min(end, max(low + 1, int(np.searchsorted(done, done[low] + HELD_SCORES, "right")) - 1))
            r = reps[low:high]
            l = np.repeat(np.arange(low, high), r)
            a = np.arange(len(l)) - np.repeat(np.cumsum(r) - r, r) + np.repeat(begin[low:high], r)
            score += np.bincount(q[a] * n + d[l] - first, qw[a] * impact[l], len(score))
            low = high
        held = np.flatnonzero(score)
        all_q, all_d = np.r_[best_q, held // n], np.r_[best_d, held % n + first]
        all_s = np.r_[best_s, score[held]]
        order = np.lexsort((all_d, -np.floor(all_s * 1e9 + 0.5), all_q))
        keep = order[np.arange(len(order)) - np.searchsorted(all_q[order], all_q[order]) < k]
        best_q, best_d, best_s = all_q[keep], all_d[keep], all_s[keep]
    return pa.table([queries.take(pa.array(best_q)), docs.take(pa.array(best_d)), pa.array(best_s)], schema=out)


def search(queries: DataFrame, documents: DataFrame, k: int, query_id: str, doc_id: str, first_docs: int = 20) -> DataFrame:
    """TF-IDF cosine of every query with every document sharing a token, best k per query, exact.

    Documents and queries are cut into blocks; a cell gets the postings of its documents whose token is
    asked and the tokens of its queries, so a score arises in one cell and only the k best of a query
    leave it. Products are never shuffled, and a posting is once per block of queries. A block has at
    least `first_docs` x k documents on average, if there are that many.
    """
    weights, idf = token_weights(documents, doc_id)
    weighted = tokens(queries, query_id).join(idf, "token").select(query_id, "token", (F.col("tf") * F.col("idf")).alias("_w"))
    q_norms = weighted.groupBy(query_id).agg(F.sqrt(F.sum(F.col("_w") * F.col("_w"))).alias("_qn"))
    q = stored(weighted.join(q_norms, query_id).select(query_id, "token", ratio("_w", "_qn").alias("qw")), "query-tokens")
    postings = stored(impacts(weights, doc_id, q.select("token").distinct()), "postings")
    n = postings.agg(F.count(F.lit(1)).alias("postings"), F.approx_count_distinct(doc_id).alias("docs")).first()
    few = max(1, n["docs"] // (first_docs * k))
    doc_blocks = max(min(few, pieces(documents.sparkSession)), -(-n["postings"] // BLOCK_POSTINGS))
    query_blocks = max(1, -(-q.count() // BLOCK_TOKENS))

    def blocks(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = postings.select(F.col(doc_id).alias("d"), "token", "impact", hashed(doc_id, doc_blocks).alias("db"), blocks(query_blocks).alias("qb"))
    right = q.select(F.col(query_id).alias("q"), "token", "qw", hashed(query_id, query_blocks).alias("qb"), blocks(doc_blocks).alias("db"))
    kinds = T.StructType([T.StructField("q", q.schema[query_id].dataType), T.StructField("d", postings.schema[doc_id].dataType), T.StructField("score", T.DoubleType())])
    found = left.groupBy("db", "qb").cogroup(right.groupBy("db", "qb")).applyInArrow(lambda a, b: _cell_scores(a, b, k), kinds)
    order = Window.partitionBy("q").orderBy(nine_digits("score").desc(), "d")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("q").alias(query_id), F.col("d").alias(doc_id), "score", "rank")
