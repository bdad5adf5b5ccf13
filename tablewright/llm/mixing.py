"""Source mixing: capped water-filling sets the targets, seeded repetitions fill them.

Weights share a total; a source stops at a number of epochs of its own size, and what it cannot
take is shared again by weight among the others until none is above its cap. The targets need one
small row per source; each round brings the driver two sums. A source's target is then met by
whole repetitions of every document and, for the rest, one pass over its documents in a seeded
order. The order is kept in pieces of some thousand documents: a piece gets its share of the rest
by size, so a source of any size is many small sorts. Where a piece's share ends inside a document,
a seeded draw takes or leaves that document by the part that is inside: texts are always whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.sources.tables import stored

#: A word, as sizes count them.
WORD = r"[^\x20\x09-\x0D]+"
#: Documents of one piece of a source's seeded order, on average.
PIECE = 4096


def seeded(key: Column, seed: str) -> Column:
    """Hex digest that orders documents; the same on every engine and partitioning."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))))


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, epochs: float) -> DataFrame:
    """source, source_size, n_docs, target; weights go round the sources in code point order, null last."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    # One row per source: numbering them in one task costs no more than listing the sources.
    ranked = stored(totals.withColumn("weight", F.get(cycle, F.pmod(place, F.lit(len(weights)))))
                    .withColumn("cap", F.lit(float(epochs)) * F.col("source_size")), "sources")
    everything = ranked.agg(F.sum("source_size")).first()[0]
    budget = float(share) * float(everything or 0)
    level = 0.0
    while True:
        capped = F.col("cap") < F.lit(level) * F.col("weight")
        held, free = ranked.agg(
            F.coalesce(F.sum(F.when(capped, F.col("cap"))), F.lit(0.0)), F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0.0))
        ).first()
        after = (budget - held) / free if free else level
        if after <= level:
            break
        level = after
    return ranked.withColumn("target", F.least("cap", F.lit(level) * F.col("weight"))).drop("cap", "weight")


def mixture(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
    weights: Sequence[float] = (5, 2, 1), share: float = 1.5, epochs: float = 2.0, seed: str = "mix",
) -> DataFrame:
    """One row per document: id, size, source_size, target, taken (and source, text_key, repeat, to find the row again).

    `size` counts the words of the text (null: 0). `taken` is the number of words the mixture takes
    of the document, a multiple of its size and never more than ceil(epochs) times it. The document
    at the end of a piece's share is taken once more with the probability of the part that is inside,
    so the expected words are the share, and a piece is off by less than that document. The draw
    depends on id, source, text and place among equal rows, not on the order of the documents. A null
    source is a source; null ids share one place in the order. Rows that repeat an id are documents
    of their own, ordered by size and text. Texts may be of any length; an empty table has no rows; other columns are not looked at.
    """
    sizes = stored(
        docs.select(
            F.col(id_column).alias("id"), F.col(source_column).cast("string").alias("source"),
            F.coalesce(F.regexp_count(text_column, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.md5(text_column).alias("text_key"),
        ), "sizes"
    )
    targets = source_targets(sizes, weights, share, epochs).withColumnRenamed("source", "of")
    key = seeded(F.col("id"), seed)
    pieces = F.ceil(F.col("n_docs") / PIECE)
    placed = sizes.join(F.broadcast(targets) if _small(targets) else targets, F.col("source").eqNullSafe(F.col("of"))).drop("of").withColumns({
        "key": key,
        "piece": F.pmod(F.conv(F.substring(key, 1, 8), 16, 10).cast("long"), pieces),
        "whole": F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)),
    })
    part = F.when(F.col("source_size") > 0, (F.col("target") - F.col("whole") * F.col("source_size")) / F.col("source_size")).otherwise(F.lit(0.0))
    placed = placed.withColumn("part", part)
    # A piece's quota: the difference of the rounded shares up to its end and up to its begin.
    per_piece = placed.groupBy("source", "piece", "part").agg(F.sum("size").alias("piece_size"))
    upto = F.sum("piece_size").over(Window.partitionBy("source").orderBy("piece"))
    quota = per_piece.withColumn("upto", upto).select(
        F.col("source").alias("of"), F.col("piece").alias("of_piece"),
        (F.floor(F.col("upto") * F.col("part")) - F.floor((F.col("upto") - F.col("piece_size")) * F.col("part"))).alias("quota"),
    )
    order = Window.partitionBy("source", "piece").orderBy("key", "size", "text_key").rowsBetween(Window.unboundedPreceding, 0)
    placed = placed.withColumn("upto", F.sum("size").over(order))
    placed = placed.join(quota, F.col("source").eqNullSafe(F.col("of")) & (F.col("piece") == F.col("of_piece")))
    extra = F.greatest(F.lit(0), F.least(F.col("size"), F.col("quota") - F.col("upto") + F.col("size")))
    repeat = F.row_number().over(Window.partitionBy("id", "text_key", "source").orderBy("key", "upto"))
    drawn = placed.withColumns({"extra": extra, "repeat": repeat})
    once = draw(seed, "id", "source", "text_key", "repeat") * F.col("size") < F.col("extra")
    times = F.col("whole") + F.when(once, 1).otherwise(0)
    return drawn.select(
        F.col("id").alias(id_column), "size", "source_size", "target", (times * F.col("size")).cast("long").alias("taken"),
        "source", "text_key", "repeat",
    )


def draw(seed: str, *columns: str) -> Column:
    """Number in [0, 1) that depends on the seed and the columns; the same on every engine and partitioning."""
    key = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns]
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(f"{seed} draw"), *key)), 1, 8), 16, 10).cast("double") / 2.0**32


def _small(targets: DataFrame, rows: int = 100_000) -> bool:
    """Whether the list of sources has a size that may be broadcast; it is counted, not guessed."""
    return targets.count() <= rows


def repeat_documents(docs: DataFrame, plan: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                     source_column: str = "source") -> DataFrame:
    """The documents as often as the plan takes them, always whole; those that it does not take, or without words, do not appear."""
    numbered = docs.withColumn("_key", F.md5(text_column)).withColumn("_source", F.col(source_column).cast("string"))
    repeat = F.row_number().over(Window.partitionBy(id_column, "_key", "_source").orderBy(F.lit(1)))
    numbered = numbered.withColumn("_repeat", repeat)
    found = plan.where("taken > 0").select(
        F.col(id_column).alias("_id"), F.col("text_key").alias("_k"), F.col("source").alias("_s"), F.col("repeat").alias("_r"),
        (F.col("taken") / F.col("size")).cast("int").alias("_times"),
    )
    joined = numbered.join(
        found, F.col(id_column).eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_k")) & F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_repeat") == F.col("_r"))
    )
    return joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).select(*docs.columns)
