"""Composite index of communes and the optical anchor."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.scalars import flag, ratio
from tablewright.functions.tails import erfc
from tablewright.operators.columns import COLLECTIVE_CATEGORIES, DEPLOYED
from tablewright.operators.windows import with_percentile_rank
from tablewright.sources.tables import stored

# Default weights of the three parts.
WEIGHTS = {"coverage": 0.60, "pm_load": 0.20, "coll_lag": 0.20}


def commune_equity(buildings: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """Coverage, load per connection point and collective coverage, weighted into one index.

    `coll_lag` is a coverage share of collective buildings (falling back to the commune's
    coverage), despite its name.
    """
    w = weights or WEIGHTS
    ok = flag(F.col("imb_etat") == DEPLOYED)
    collective = F.col("catg_loc_imb").isin(COLLECTIVE_CATEGORIES)
    g = buildings.where(F.col("code_insee").isNotNull()).groupBy("code_insee").agg(
        F.avg(ok).alias("coverage"), F.avg(F.when(collective, ok)).alias("_coll"), F.count(F.lit(1)).alias("n_buildings"),
        F.count_distinct("pm_ref").alias("_pm"), F.min("nom_com").alias("nom_com"),
    )
    # Nine digits keep equal loads equal whatever the order of summation.
    g = stored(g.withColumn("_load", F.round(ratio("n_buildings", F.greatest("_pm", F.lit(1))), 9)), "communes")
    ranked = with_percentile_rank(g, "_load").withColumn("pm_load", 1 - F.col("rank_pct"))
    ranked = ranked.withColumn("coll_lag", F.coalesce("_coll", "coverage"))
    index = sum((F.col(c) * F.lit(w[c]) for c in ("pm_load", "coll_lag")), F.col("coverage") * F.lit(w["coverage"]))
    return ranked.withColumn("equity_index", index).select(
        "code_insee", "coverage", "pm_load", "coll_lag", "equity_index", "nom_com", "n_buildings"
    )


def anchor_q(osnr: Column, low_db: float = 5.0, high_db: float = 25.0) -> Column:
    """Ideal Q factor for a normalised signal-to-noise ratio, scaled to the data's range."""
    db = F.lit(low_db) + F.lit(high_db - low_db) * osnr
    linear = F.pow(F.lit(10.0), db / 10)
    return 20 * F.log10(F.sqrt(2 * linear) + 1e-9) / 4


def bit_error_rate(q: Column) -> Column:
    return erfc(q / math.sqrt(2.0)) / 2
