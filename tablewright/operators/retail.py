"""Sales operators: what-if scenarios, daily forecasts, walk-forward scores, association rules."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.functions.scalars import flag, half_even, ratio
from tablewright.sources.tables import stored

# Thresholds tried for association rules, highest first, and the lift floor.
SUPPORT_STEPS = [0.20, 0.15, 0.10, 0.05, 0.03]
MIN_LIFT = 1.0
# Half-width of a central 80 % band in standard deviations.
BAND_80 = 1.2816


def what_if(
    transactions: DataFrame,
    price: float = 1.0,
    quantity: float = 1.0,
    member_target: float | None = None,
    wallet_target: float | None = None,
    member: str = "BUILDING",
    wallet: str = "1-URGENT",
) -> DataFrame:
    """Baseline and projected revenue per month under changed prices, quantities and shares."""
    units = half_even(F.greatest(F.col("quantity") * F.lit(quantity), F.lit(1.0)), 0)
    projected = F.col("unit_price") * F.lit(price) * units * 1.05
    shares = transactions.agg(F.struct(
        F.avg(flag(F.col("customer_type") == member)).alias("member"), F.avg(flag(F.col("payment") == wallet)).alias("wallet"),
    )).scalar()
    lift = F.lit(1.0)
    if member_target is not None:
        lift = lift * (1 + (F.lit(member_target) - shares["member"]) * 0.05)
    if wallet_target is not None:
        lift = lift * (1 + (F.lit(wallet_target) - shares["wallet"]) * 0.03)
    # Both sums come from the same rows, so one aggregation replaces a join on the month.
    months = transactions.groupBy(F.date_format("ts", "yyyy-MM").alias("month")).agg(
        F.sum("total").alias("baseline"), F.sum(projected).alias("_p")
    )
    return months.withColumn("projected", F.col("_p") * lift).drop("_p").withColumn(
        "delta", F.col("projected") - F.col("baseline")
    )


def _fit_additive(series: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Straight trend and weekday means of what it leaves, per series."""
    first = series.groupBy(*keys).agg(F.min("ds").alias("_start"))
    dated = series.join(first, keys).withColumn("_t", F.datediff("ds", "_start").cast("double"))
    trend = dated.groupBy(*keys).agg(
        F.min("_start").alias("_start"), F.max("ds").alias("_end"),
        F.regr_slope("y", "_t").alias("_slope"), F.regr_intercept("y", "_t").alias("_icpt"),
    )
    left = dated.drop("_start").join(trend, keys)
    left = left.withColumn("_r", F.col("y") - F.col("_icpt") - F.col("_slope") * F.col("_t"))
    # Weekday sums give both the seasonal means and the spread around them.
    season = left.groupBy(*keys, F.weekday("ds").alias("_dow")).agg(
        F.avg("_r").alias("_season"), F.count("_r").alias("_n"), F.var_pop("_r").alias("_v")
    )
    spread = season.groupBy(*keys).agg(
        F.sqrt(F.sum(F.col("_n") * F.col("_v")) / (F.sum("_n") - 1)).alias("_sd")
    )
    return trend.join(spread, keys), season.drop("_n", "_v")


def additive_forecast(series: DataFrame, keys: list[str], horizon: int = 30) -> DataFrame:
    """`(keys, ds, yhat, yhat_lower, yhat_upper)` for the days after each series."""
    trend, season = _fit_additive(series, keys)
    days = F.explode(F.sequence(F.date_add("_end", 1), F.date_add("_end", horizon)))
    ahead = trend.select("*", days.alias("ds")).withColumn("_dow", F.weekday("ds"))
    ahead = ahead.join(season, [*keys, "_dow"], "left")
    yhat = (
        F.col("_icpt") + F.col("_slope") * F.datediff("ds", "_start") + F.coalesce("_season", F.lit(0.0))
    )
    return ahead.select(
        *keys, "ds", yhat.alias("yhat"), (yhat - BAND_80 * F.col("_sd")).alias("yhat_lower"),
        (yhat + BAND_80 * F.col("_sd")).alias("yhat_upper"),
    )


#: Changes that a second-order autoregression needs at least.
LEAST_CHANGES = 5


def autoregressive_fit(series: DataFrame, keys: list[str]) -> DataFrame:
    """Least squares of each day's change on the two changes before it, one row per series.

    Columns: b0, b1, b2, the last two changes (d1 the later), the last level and day, and a status:
    `fitted` or `too_short` (under five changes; the coefficients are then null). Where the two
    earlier changes tell the same, the second has no weight; where they do not vary, neither has.
    """
    days = Window.partitionBy(*keys).orderBy("ds")
    change = series.select(*keys, "ds", "y", (F.col("y") - F.lag("y").over(days)).alias("d"))
    lagged = change.withColumns({"x1": F.lag("d").over(days), "x2": F.lag("d", 2).over(days)})
    full = F.col("x2").isNotNull()

    def both(a: str, b: str) -> Column:
        return F.covar_pop(F.when(full, F.col(a)), F.when(full, F.col(b)))

    sums = lagged.groupBy(*keys).agg(
        F.count("d").alias("n_changes"), F.max("ds").alias("end"), F.max_by("y", "ds").alias("level"),
        F.max_by("d", "ds").alias("d1"), F.max_by("x1", "ds").alias("d2"),
        *[F.avg(F.when(full, F.col(c))).alias(f"m_{c}") for c in ("d", "x1", "x2")],
        both("x1", "x1").alias("c11"), both("x2", "x2").alias("c22"), both("x1", "x2").alias("c12"),
        both("x1", "d").alias("c1"), both("x2", "d").alias("c2"),
    )
    c = F.col
    det = c("c11") * c("c22") - c("c12") * c("c12")
    sound = det > 1e-12 * c("c11") * c("c22")
    b1 = F.when(sound, (c("c1") * c("c22") - c("c2") * c("c12")) / det).when(c("c11") > 0, c("c1") / c("c11")).otherwise(0.0)
    b2 = F.when(sound, (c("c2") * c("c11") - c("c1") * c("c12")) / det).otherwise(0.0)
    enough = c("n_changes") >= LEAST_CHANGES
    return sums.withColumns({"b1": F.when(enough, b1), "b2": F.when(enough, b2)}).select(
        *keys, "end", "level", "d1", "d2", "n_changes", (c("m_d") - c("b1") * c("m_x1") - c("b2") * c("m_x2")).alias("b0"), "b1", "b2",
        F.when(enough, "fitted").otherwise("too_short").alias("status"),
    )


def autoregressive_forecast(series: DataFrame, keys: list[str], horizon: int = 30) -> DataFrame:
    """`(keys, ds, yhat, status)`: a second-order autoregression on day-to-day changes, rolled forward.

    A series of under five changes fits no model: its rows have a null forecast and the status `too_short`.
    """
    fit = autoregressive_fit(series, keys)
    start = F.struct(F.col("level").alias("level"), F.col("d1").alias("d1"), F.col("d2").alias("d2"), F.array().cast("array<double>").alias("out"))

    def roll(state: Column, _: Column) -> Column:
        change = F.col("b0") + F.col("b1") * state["d1"] + F.col("b2") * state["d2"]
        return F.struct(
            (state["level"] + change).alias("level"), change.alias("d1"), state["d1"].alias("d2"),
            F.concat(state["out"], F.array(state["level"] + change)).alias("out"),
        )

    rolled = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), start, roll)["out"]
    ahead = fit.select(*keys, "end", "status", F.posexplode(rolled).alias("_i", "yhat"))
    return ahead.select(*keys, F.date_add("end", F.col("_i") + 1).alias("ds"), "yhat", "status")


def walk_forward(series: DataFrame, entity: str, folds: int = 3, horizon: int = 7, min_train: int = 30) -> DataFrame:
    """`(entity, fold, ds, y, role)`: each fold trains on all days before its test week."""
    order = Window.partitionBy(entity).orderBy("ds")
    indexed = series.select("*", F.row_number().over(order).alias("_i"))
    sizes = series.groupBy(entity).agg(F.count(F.lit(1)).alias("_n"))
    rows = indexed.join(sizes, entity).withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(folds))))
    end = F.col("_n") - F.col("fold") * horizon
    kept = rows.where((end > min_train) & (F.col("_i") <= end + horizon))
    return kept.select(entity, "fold", "ds", "y", F.when(F.col("_i") <= end, "train").otherwise("test").alias("role"))


def walk_forward_error(splits: DataFrame, entity: str, forecast, horizon: int = 7) -> DataFrame:
    """Mean over folds of a model's mean absolute error, per entity."""
    keys = [entity, "fold"]
    predicted = forecast(splits.where("role = 'train'").select(*keys, "ds", "y"), keys, horizon)
    test = splits.where("role = 'test'").select(*keys, "ds", "y")
    per_fold = test.join(predicted.select(*keys, "ds", "yhat").where("yhat is not null"), [*keys, "ds"]).groupBy(*keys).agg(
        F.avg(F.abs(F.col("y") - F.col("yhat"))).alias("_mae"))
    return per_fold.groupBy(entity).agg(F.avg("_mae").alias("mae"))


def champion_forecast(series: DataFrame, entity: str, horizon: int = 30, folds: int = 3) -> tuple[DataFrame, DataFrame]:
    """Scores of both models per entity, and the forecast of each entity's better model."""
    splits = walk_forward(series, entity, folds)
    a = walk_forward_error(splits, entity, additive_forecast).withColumnRenamed("mae", "additive_mae")
    b = walk_forward_error(splits, entity, autoregressive_forecast).withColumnRenamed("mae", "autoregressive_mae")
    scores = series.select(entity).distinct().join(a, entity, "left").join(b, entity, "left")
    inf = F.lit(float("inf"))
    wins = F.coalesce("additive_mae", inf) <= F.coalesce("autoregressive_mae", inf)
    scores = scores.withColumn("winner", F.when(wins, "additive").otherwise("autoregressive"))
    first = additive_forecast(series, [entity], horizon).select(entity, "ds", "yhat", F.lit("additive").alias("winner"))
    second = autoregressive_forecast(series, [entity], horizon).select(entity, "ds", "yhat", F.lit("autoregressive").alias("winner"))
    both = first.unionByName(second)
    return scores, both.join(scores.select(entity, "winner"), [entity, "winner"], "left_semi")


def actual_and_forecast(series: DataFrame, forecast: DataFrame, entity: str, since: int) -> DataFrame:
    """The last `since` days of each series and its forecast in one long table."""
    last = series.groupBy(entity).agg(F.max("ds").alias("_end"))
    actual = series.join(last, entity).where(F.datediff("_end", "ds") < since)
    return actual.select(entity, "ds", F.col("y").alias("value"), F.lit("actual").alias("kind")).unionByName(
        forecast.select(entity, "ds", F.col("yhat").alias("value"), F.lit("forecast").alias("kind"))
    )


def association_rules(
    transactions: DataFrame, basket: list[str], item: str, steps: list[float] | None = None, min_lift: float = MIN_LIFT
) -> DataFrame:
    """Rules with any number of items on both sides at the highest support that yields one.

    Itemsets are mined once at the lowest support; every split of a frequent itemset is then
    looked up among the itemsets, since all parts of a frequent set are frequent.
    """
    steps = sorted(steps or SUPPORT_STEPS)
    sets = stored(transactions.groupBy(*basket).agg(F.collect_set(item).alias("items")), "baskets")
    n = sets.count()
    # A hair below the lowest step: the exact support test follows and must see every candidate.
    mined = FPGrowth(itemsCol="items", minSupport=max(steps[0] - 0.5 / max(n, 1), 0.0), minConfidence=1.0).fit(sets)
    freq = mined.freqItemsets.select(F.array_sort("items").alias("items"), (F.col("freq") / F.lit(n)).alias("support"))
    support = freq.select(F.array_join("items", ", ").alias("name"), "support")
    mask = F.explode(F.expr("sequence(1, cast(pow(2, size(items)) as int) - 2)"))
    splits = freq.where(F.size("items") > 1).select("items", "support", mask.alias("m"))
    side = "array_join(filter(items, (x, i) -> (shiftright(m, i) & 1) = {}), ', ')"
    rules = splits.select("support", F.expr(side.format(1)).alias("antecedents"), F.expr(side.format(0)).alias("consequents"))
    rules = (
        rules.join(support.select(F.col("name").alias("antecedents"), F.col("support").alias("_a")), "antecedents")
        .join(support.select(F.col("name").alias("consequents"), F.col("support").alias("_c")), "consequents")
        .select(
            "antecedents", "consequents", "support", ratio("support", "_a").alias("confidence"),
            ratio(ratio("support", "_a"), "_c").alias("lift"),
        )
        .where((F.col("lift") >= min_lift) & (F.col("support") >= steps[0]))
    )
    top = rules.agg(F.max("support")).scalar()
    chosen = F.greatest(*[F.when(top >= s, F.lit(s)).otherwise(F.lit(0.0)) for s in steps], F.lit(0.0))
    return rules.where(F.col("support") >= chosen).orderBy(F.desc("lift"))
