"""Queries for metrics and for deterministic model steps on scored rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.operators import aggregates as A
from tablewright.operators import metrics as E
from tablewright.operators.sampling import random_split
from tablewright.plans.columns import r6
from tablewright.plans.order import QUART_SQL
from tablewright.plans.registry import query
from tablewright.plans.shared import POP_SQL, SPLIT_SQL, item_vectors, pop_lists
from tablewright.plans.views import BUCKET



@query("ev01_regression_metrics", "scored", """
select round(avg(abs(y_true - y_pred)), 6) as mae, round(sqrt(avg(pow(y_true - y_pred, 2))), 6) as rmse,
 round(1 - avg(pow(y_true - y_pred, 2)) / var_pop(y_true), 6) as r2, round(avg(abs(y_true - y_pred) / greatest(abs(y_true), 1e-6)) * 100, 6) as mape from scored""")
def _(t):
    m = E.regression_metrics(t.scored, "y_true", "y_pred")
    return m.select(*[r6(c).alias(c) for c in m.columns])


@query("ev02_confusion", "scored", "select y as actual, cast(p >= 0.5 as int) as predicted, count(*) as n from scored group by 1, 2")
def _(t):
    return E.confusion(t.scored, "y", "p", 0.5)


COUNTS_SQL = "c as (select count(*) filter (p >= 0.5 and y = 1) as tp, count(*) filter (p >= 0.5 and y = 0) as fp, count(*) filter (p < 0.5 and y = 1) as fn, count(*) filter (p < 0.5 and y = 0) as tn from scored)"
RATES_SQL = """round((tp + tn) / (tp + fp + fn + tn), 6) as accuracy, round(tp / greatest(tp + fp, 1), 6) as precision, round(tp / greatest(tp + fn, 1), 6) as recall,
 round(2 * (tp / greatest(tp + fp, 1)) * (tp / greatest(tp + fn, 1)) / greatest(tp / greatest(tp + fp, 1) + tp / greatest(tp + fn, 1), 1e-9), 6) as f1"""
RATES = ["accuracy", "precision", "recall", "f1"]


@query("ev03_threshold_metrics", "scored", f"with {COUNTS_SQL} select tp, fp, fn, tn, {RATES_SQL} from c")
def _(t):
    return E.classification_metrics(t.scored, "y", "p").select("tp", "fp", "fn", "tn", *[r6(c).alias(c) for c in RATES])


SWEEP_SQL = f"""
g as (select i, i / 100 as t from range(5, 96) r(i)),
c as (select i, t, count(*) filter (p >= t and y = 1) as tp, count(*) filter (p >= t and y = 0) as fp, count(*) filter (p < t and y = 1) as fn, count(*) filter (p < t and y = 0) as tn
  from g, scored group by 1, 2),
w as (select t, {RATES_SQL} from c)"""


@query("ev04_threshold_sweep", "scored", f"with {SWEEP_SQL} select round(t, 6) as threshold, accuracy, precision, recall, f1 from w")
def _(t):
    s = E.threshold_sweep(t.scored, "y", "p")
    return s.select(r6("threshold").alias("threshold"), *[r6(c).alias(c) for c in RATES])


@query("ev04_chosen_threshold", "scored", f"""
with {SWEEP_SQL} select coalesce((select round(t, 6) from w where recall >= 0.95 order by precision desc, t limit 1), 0.5) as threshold""")
def _(t):
    s = E.threshold_sweep(t.scored, "y", "p").withColumn("precision", r6("precision")).withColumn("recall", r6("recall"))
    return E.chosen_threshold(s).select(r6("threshold").alias("threshold"))


@query("ev05_classification_report", "scored", f"""
with {COUNTS_SQL}, r as (select '0' as label, tn / (tn + fn) as p, tn / (tn + fp) as r, tn + fp as s from c union all select '1', tp / (tp + fp), tp / (tp + fn), tp + fn from c),
f as (select label, p, r, 2 * p * r / (p + r) as f, s from r),
u as (select * from f union all select 'macro', avg(p), avg(r), avg(f), sum(s) from f union all select 'weighted', sum(p * s) / sum(s), sum(r * s) / sum(s), sum(f * s) / sum(s), sum(s) from f)
select label, round(p, 6) as precision, round(r, 6) as recall, round(f, 6) as f1, cast(s as bigint) as support from u""")
def _(t):
    r = E.classification_report(t.scored, "y", "p")
    return r.select("label", *[r6(c).alias(c) for c in ("precision", "recall", "f1")], "support")


STEPS_SQL = """
d as (select p, count(*) filter (y = 1) as pos, count(*) filter (y = 0) as neg from scored group by p),
k as (select p, pos, neg, sum(pos) over (order by p desc) as tp, sum(neg) over (order by p desc) as fp, sum(pos) over () as np, sum(neg) over () as nn from d)"""


@query("ev06_roc_curve", "scored", f"with {STEPS_SQL} select round(p, 6) as threshold, round(fp / nn, 6) as fpr, round(tp / np, 6) as tpr from k")
def _(t):
    c = E.roc_curve(t.scored, "y", "p")
    return c.select(*[r6(x).alias(x) for x in c.columns])


@query("ev06_auc", "scored", f"with {STEPS_SQL} select round(sum(pos * (nn - fp + neg / 2)) / (any_value(np)::double * any_value(nn)), 6) as auc from k")
def _(t):
    return E.auc(t.scored, "y", "p").withColumn("auc", r6("auc"))


@query("ev07_pr_curve", "scored", f"with {STEPS_SQL} select round(p, 6) as threshold, round(tp / (tp + fp), 6) as precision, round(tp / np, 6) as recall from k")
def _(t):
    c = E.pr_curve(t.scored, "y", "p")
    return c.select(*[r6(x).alias(x) for x in c.columns])


@query("ev07_average_precision", "scored", f"with {STEPS_SQL} select round(sum(pos / np * tp / (tp + fp)), 6) as average_precision from k")
def _(t):
    return E.average_precision(t.scored, "y", "p").withColumn("average_precision", r6("average_precision"))


@query("ev08_brier", "scored", "select round(avg(pow(p - y, 2)), 6) as brier from scored")
def _(t):
    return E.brier(t.scored, "y", "p").withColumn("brier", r6("brier"))


@query("ev09_reliability", "scored", """
select cast(least(floor(p * 10), 9) as int) as bin, count(*) as n, round(avg(p), 6) as mean_score, round(avg(y), 6) as observed from scored group by 1 having count(*) >= 20""")
def _(t):
    return E.reliability(t.scored, "y", "p").select("bin", "n", r6("mean_score").alias("mean_score"), r6("observed").alias("observed"))


RANK_SQL = f"""{SPLIT_SQL}, {POP_SQL},
rel as (select userId, movieId from te where rating >= 3.5), nrel as (select userId, count(*) as nr from rel group by 1),
hit as (select top.userId, rank, row_number() over (partition by top.userId order by rank) as nth from top join rel on rel.userId = top.userId and rel.movieId = top.movieId),
per as (select userId, count(*) as h, sum(1 / log2(rank + 1)) as dcg, sum(nth / rank) as ap, min(rank) as first from hit group by 1),
ideal as (select i, sum(1 / log2(i + 1)) over (order by i) as idcg from range(1, 11) r(i)),
m as (select userId, coalesce(h, 0) / 10 as precision, coalesce(h, 0) / nr as recall, coalesce(dcg, 0) / idcg as ndcg, coalesce(ap, 0) / least(nr, 10) as map, coalesce(1 / first, 0) as mrr
  from nrel left join per using (userId) join ideal on i = least(nr, 10))"""
MEANS_SQL = ", ".join(f"round(avg({m}), 6) as {m}" for m in E.RANKING)


@query("ev10_ranking_metrics", "ratings", f"with {RANK_SQL} select {MEANS_SQL}, count(*) as n_users from m")
def _(t):
    split, lists = pop_lists(t)
    m = E.ranking_metrics(lists, split.where("split = 2"))
    return m.select(*[r6(c).alias(c) for c in E.RANKING], "n_users")


LIST_SQL = f"{RANK_SQL}, l as (select * from top where userId in (select userId from nrel))"


@query("ev11_coverage", "ratings", f"with {LIST_SQL} select round(count(distinct movieId) / (select count(distinct movieId) from ratings), 6) as coverage from l")
def _(t):
    split, lists = pop_lists(t)
    kept = E.evaluated(lists, split.where("split = 2"), 10)
    return E.catalogue_coverage(kept, split).withColumn("coverage", r6("coverage"))


@query("ev12_novelty", "ratings", f"""
with {LIST_SQL}, b as (select userId, avg(-log2(greatest(n / (select count(*) from tr), 1e-12))) as b from l join pop using (movieId) group by 1) select round(avg(b), 6) as novelty from b""")
def _(t):
    split, lists = pop_lists(t)
    kept = E.evaluated(lists, split.where("split = 2"), 10)
    return E.novelty(kept, split.where("split = 0")).withColumn("novelty", r6("novelty"))


@query("ev13_diversity", "ratings movies", f"""
with {LIST_SQL}, nv as (select count(*) as nv from embeddings),
v as (select movieId, embedding::double[64] as e from movies, nv join embeddings on vec_id = movieId % nv),
p as (select a.userId, avg(array_cosine_similarity(x.e, z.e)) as c from l a join l b on a.userId = b.userId and a.movieId < b.movieId
 join v x on x.movieId = a.movieId join v z on z.movieId = b.movieId group by 1)
select round(avg(1 - c), 6) as diversity from p""")
def _(t):
    split, lists = pop_lists(t)
    kept = E.evaluated(lists, split.where("split = 2"), 10)
    return E.diversity(kept, item_vectors(t)).withColumn("diversity", r6("diversity"))


@query("ev14_serendipity", "ratings", f"""
with {LIST_SQL}, ni as (select count(distinct movieId) as ni from ratings),
h as (select l.userId, count(*) as h from l join rel on rel.userId = l.userId and rel.movieId = l.movieId join pop on pop.movieId = l.movieId, ni where pr > greatest(floor(ni * 0.1::double), 1) group by 1)
select round(avg(coalesce(h, 0) / 10), 6) as serendipity from nrel left join h using (userId)""")
def _(t):
    split, lists = pop_lists(t)
    test = split.where("split = 2")
    s = E.serendipity(E.evaluated(lists, test, 10), split.where("split = 0"), test, split)
    return s.withColumn("serendipity", r6("serendipity"))


@query("ev15_metrics_per_segment", "ratings", f"with {QUART_SQL}, {RANK_SQL} select segment, {MEANS_SQL}, count(*) as n_users from m join seg using (userId) group by 1")
def _(t):
    split, lists = pop_lists(t)
    segments = A.activity_quartiles(split.groupBy("userId").agg(F.count("*").alias("n")))
    m = E.ranking_metrics(lists, split.where("split = 2"), segments=segments)
    return m.select("segment", *[r6(c).alias(c) for c in E.RANKING], "n_users")


MODEL_SQL = """
e as (select source as model, avg(abs(y_true - y_pred)) as mae, sqrt(avg(pow(y_true - y_pred, 2))) as rmse, avg(pow(p - y, 2)) as brier from scored group by 1)"""


def model_table(t):
    return t.scored.groupBy(F.col("source").alias("model")).agg(
        F.avg(F.abs(F.col("y_true") - F.col("y_pred"))).alias("mae"),
        F.sqrt(F.avg(F.pow(F.col("y_true") - F.col("y_pred"), 2))).alias("rmse"), F.avg(F.pow(F.col("p") - F.col("y"), 2)).alias("brier"))


@query("ev16_comparison_scaled", "scored", f"""
with {MODEL_SQL}, l as (select model, metric, value from e unpivot (value for metric in (mae, rmse, brier)))
select model, metric, round(value, 6) as value, round(coalesce((value - min(value) over (partition by metric)) / nullif(max(value) over (partition by metric) - min(value) over (partition by metric), 0), 0), 6) as scaled from l""")
def _(t):
    long = E.min_max_long(model_table(t), "model", ["mae", "rmse", "brier"])
    return long.select("model", "metric", r6("value").alias("value"), r6("scaled").alias("scaled"))


@query("ev17_residuals", "scored", "select doc_id, round(y_true, 6) as y_true, round(y_pred, 6) as y_pred, round(y_true - y_pred, 6) as error from scored")
def _(t):
    return E.residuals(t.scored, "doc_id", "y_true", "y_pred").select("doc_id", *[r6(c).alias(c) for c in ("y_true", "y_pred", "error")])


@query("ev17_residual_histogram", "scored", """
select cast(least(floor((least(greatest(y_true - y_pred, -1000), 1000) + 1000) * 40 / 2000), 39) as int) as bin, count(*) as n from scored group by 1""")
def _(t):
    return E.residual_histogram(t.scored, "y_true", "y_pred", -1000, 1000, 40)


@query("ev18_error_cases", "scored", """
with o as (select *, case when p >= 0.4 and y = 1 then 'TP' when p < 0.4 and y = 0 then 'TN' when p < 0.4 and y = 1 then 'FN' end as outcome from scored),
r as (select *, row_number() over (partition by outcome order by case when outcome = 'TP' then -p else p end, doc_id) as rank from o where outcome is not null)
select outcome, cast(rank as int) as rank, doc_id, y, p from r where rank <= case outcome when 'TP' then 4 else 2 end""")
def _(t):
    return E.error_cases(t.scored, "doc_id", "y", "p", 0.4, {"TP": 4, "TN": 2, "FN": 2})


@query("ml24_decision", "scored", "select doc_id, cast(p >= 0.62 as int) as predicted from scored")
def _(t):
    return E.decisions(t.scored, "p", 0.62).select("doc_id", "predicted")


@query("ml25_champion", "scored", f"with {MODEL_SQL} select min_by(model, (mae, model)) as champion, round(min(mae), 6) as mae from e")
def _(t):
    return E.best_model(model_table(t), "model", "mae").withColumn("mae", r6("mae"))


CONFORMAL_SQL = f"""
part as (select *, case when {BUCKET('cast(doc_id as varchar)')} / 4294967296::double < 0.5::double then 'calibrate' else 'test' end as half from scored),
cal as (select abs(y_true - y_pred) as e, row_number() over (order by abs(y_true - y_pred)) as rn, count(*) over () as n from part where half = 'calibrate'),
k as (select e as radius from cal where rn = least(greatest(ceil((n + 1) * 0.9::double - 1e-9), 1), n))"""


@query("ml27_conformal", "scored", f"""
with {CONFORMAL_SQL} select round(any_value(radius), 6) as radius, round(avg(cast(abs(y_true - y_pred) <= radius as int)), 6) as coverage, count(*) as n from part, k where half = 'test'""")
def _(t):
    part = t.scored.withColumn("half", random_split("doc_id", {"calibrate": 0.5, "test": 0.5}))
    radius = E.conformal_radius(part.where("half = 'calibrate'"), "y_true", "y_pred", 0.1).scalar()
    held = part.where("half = 'test'")
    c = E.coverage(held, "y_true", "y_pred", radius)
    return c.select(r6(radius).alias("radius"), r6("coverage").alias("coverage"), "n")
