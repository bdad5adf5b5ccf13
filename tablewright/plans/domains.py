"""Queries for tags and documents, forecasts, baskets, the equity index and what-if scenarios."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from tablewright.operators import aggregates as A
from tablewright.operators import equity as Q
from tablewright.operators import retail as R
from tablewright.operators import text as X
from tablewright.operators.missing import clean_buildings
from tablewright.plans.columns import r6
from tablewright.plans.quality import CLEAN_BUILDINGS_SQL
from tablewright.plans.registry import query
from tablewright.plans.shared import DEGREE_SQL, TAG_SQL, tags_clean
from tablewright.sources.tables import stored



@query("tx01_clean_tags", "tags", f"with {TAG_SQL} select * from c")
def _(t):
    return tags_clean(t)


@query("tx02_tag_documents", "tags", f"""
with {TAG_SQL}, k as (select movieId, tag_clean, count(*) as n from c group by 1, 2)
select movieId, string_agg(tag_clean, ' ' order by n desc, tag_clean) as doc, cast(sum(n) as bigint) as total_tags from k group by 1 having sum(n) >= 10""")
def _(t):
    return A.tag_documents(tags_clean(t), min_count=10).select("movieId", "doc", "total_tags")


@query("tx03_top_tags", "tags", f"with {TAG_SQL} select tag_clean, count(*) as n from c group by 1 order by n desc, tag_clean limit 30")
def _(t):
    return X.top_tags(tags_clean(t), 30)


@query("tx03_top_tags_per_genre", "tags movies", f"""
with {TAG_SQL}, g as (select movieId, unnest(string_split(genres, '|')) as genre from movies),
n as (select genre, tag_clean, count(*) as n from c join g using (movieId) where genre <> '(no genres listed)' group by 1, 2)
select genre, tag_clean, n, cast(rank as int) as rank from (select *, row_number() over (partition by genre order by n desc, tag_clean) as rank from n) where rank <= 150""")
def _(t):
    return X.top_tags_per_genre(tags_clean(t), t.movies, 150)


EDGE_SQL = f"""{DEGREE_SQL}, it as (select distinct movieId, tag_clean from c where tag_clean in (select tag_clean from top)),
edges as (select x.tag_clean as a, y.tag_clean as b, count(*) as weight from it x join it y on x.movieId = y.movieId and x.tag_clean < y.tag_clean group by 1, 2 having count(*) >= 3)"""


@query("tx04_cooccurrence", "tags", f"with {EDGE_SQL} select a, b, weight from edges")
def _(t):
    return X.cooccurrence(tags_clean(t), 80, 3)


@query("jn10_pairs_on_group", "tags", f"with {EDGE_SQL} select a, count(*) as partners, cast(sum(weight) as bigint) as weight from edges group by a")
def _(t):
    edges = X.cooccurrence(tags_clean(t), 80, 3)
    return edges.groupBy("a").agg(F.count("*").alias("partners"), F.sum("weight").alias("weight"))


@query("tx05_weighted_degree", "tags", f"""
with {EDGE_SQL} select node, cast(sum(weight) as bigint) as degree from (select a as node, weight from edges union all select b, weight from edges) group by 1 order by 2 desc, 1 limit 40""")
def _(t):
    return X.weighted_degree(X.cooccurrence(tags_clean(t), 80, 3), 40)


def tokens_sql(table, key):
    return f"""select {key}, token, count(*)::double as tf from (select {key}, unnest(string_split_regex(lower(text), '[^\\p{{L}}\\p{{N}}]+')) as token from {table}) where token <> '' group by 1, 2"""


@query("tx09_search", "", f"""
with dt as ({tokens_sql('documents', 'doc_id')}), qt as ({tokens_sql('benchmark', 'item_id')}),
idf as (select token, ln((1 + (select count(*) from documents)) / (count(*) + 1)) + 1 as idf from dt group by token),
dn as (select doc_id, sqrt(sum(tf * idf * tf * idf)) as dn from dt join idf using (token) group by 1),
qw as (select item_id, token, tf * idf as w, idf from qt join idf using (token)), qn as (select item_id, sqrt(sum(w * w)) as qn from qw group by 1),
sc as (select item_id, doc_id, sum(tf * idf * w) as s from dt join qw using (token) group by 1, 2),
r as (select item_id, doc_id, s / (dn * qn) as score from sc join dn using (doc_id) join qn using (item_id)),
k as (select *, row_number() over (partition by item_id order by round(score, 9) desc, doc_id) as rank from r)
select item_id, doc_id, round(score, 6) as score, cast(rank as int) as rank from k where rank <= 5""")
def _(t):
    found = X.search(t.benchmark, t.documents, 5, "item_id", "doc_id")
    return found.select("item_id", "doc_id", r6("score").alias("score"), "rank")


SERIES_SQL = """
d as (select product_line, cast(ts as date) as ds, sum(total) as y from transactions group by 1, 2),
c as (select product_line, unnest(generate_series(min(ds), max(ds), interval 1 day))::date as ds from d group by 1),
s as (select product_line, ds, coalesce(y, 0) as y from c left join d using (product_line, ds))"""


def series(t):
    return stored(A.daily_series(t.transactions, "product_line", "ts", "total"), "series")


def additive_sql(source, keys, horizon):
    """The additive model fitted to `source(keys, ds, y)`, as steps ending in `fc`."""
    return f"""
t0 as (select *, (ds - min(ds) over (partition by {keys}))::double as i from {source}),
tr0 as (select {keys}, regr_slope(y, i) as slope, regr_intercept(y, i) as icpt, min(ds) as a, max(ds) as b from t0 group by {keys}),
rs as (select {keys}, isodow(ds) as dow, y - icpt - slope * i as r from t0 join tr0 using ({keys})),
sea as (select {keys}, dow, avg(r) as season from rs group by {keys}, dow),
sd as (select {keys}, sqrt(sum((r - season) * (r - season)) / (count(*) - 1)) as sd from rs join sea using ({keys}, dow) group by {keys}),
fu as (select {keys}, a, slope, icpt, (b + h)::date as ds from tr0, (select unnest(range(1, {horizon} + 1))::int as h)),
fc as (select {keys}, ds, icpt + slope * (ds - a) + coalesce(season, 0) as yhat, sd from fu join sd using ({keys}) left join sea on {' and '.join(f'sea.{k.strip()} = fu.{k.strip()}' for k in keys.split(','))} and dow = isodow(ds))"""


@query("fc01_additive_forecast", "transactions", f"""
with {SERIES_SQL}, {additive_sql('s', 'product_line', 30).replace('fc as (select product_line', 'fc as (select fu.product_line')}
select product_line, strftime(ds, '%Y-%m-%d') as ds, round(yhat, 3) as yhat, round(yhat - 1.2816::double * sd, 3) as yhat_lower, round(yhat + 1.2816::double * sd, 3) as yhat_upper from fc""")
def _(t):
    f = R.additive_forecast(series(t), ["product_line"], 30)
    return f.select("product_line", F.col("ds").cast("string").alias("ds"), *[F.round(c, 3).alias(c) for c in ("yhat", "yhat_lower", "yhat_upper")])


def autoregressive_sql(source, keys, horizon):
    """The autoregression fitted to `source(keys, ds, y)` and rolled forward, as steps ending in `ar`."""
    w = f"over (partition by {keys} order by ds)"
    full = "filter (x2 is not null)"
    return f"""
ar1 as (select *, y - lag(y) {w} as d from {source}), ar2 as (select *, lag(d) {w} as x1, lag(d, 2) {w} as x2 from ar1),
ar3 as (select {keys}, max(ds) as e, max_by(y, ds) as lv, max_by(d, ds) as d1, max_by(x1, ds) as d2, count(d) as n, avg(d) {full} as md, avg(x1) {full} as m1, avg(x2) {full} as m2,
 var_pop(x1) {full} as c11, var_pop(x2) {full} as c22, covar_pop(x1, x2) {full} as c12, covar_pop(x1, d) {full} as c1, covar_pop(x2, d) {full} as c2 from ar2 group by {keys}),
ar4 as (select *, c11 * c22 - c12 * c12 > 1e-12::double * c11 * c22 as sound, c11 * c22 - c12 * c12 as det from ar3),
ar5 as (select *, case when n < 5 then null when sound then (c1 * c22 - c2 * c12) / det when c11 > 0 then c1 / c11 else 0 end as b1,
 case when n < 5 then null when sound then (c2 * c11 - c1 * c12) / det else 0 end as b2 from ar4),
ar as (select {keys}, e, md - b1 * m1 - b2 * m2 as b0, b1, b2, 0 as h, lv as yhat, d1, d2, case when n < 5 then 'too_short' else 'fitted' end as status from ar5
 union all select {keys}, e, b0, b1, b2, h + 1, yhat + b0 + b1 * d1 + b2 * d2, b0 + b1 * d1 + b2 * d2, d1, status from ar where h < {horizon})"""


@query("fc02_autoregressive_forecast", "transactions", f"""
with recursive {SERIES_SQL}, {autoregressive_sql('s', 'product_line', 30)}
select product_line, strftime(e + h, '%Y-%m-%d') as ds, round(yhat, 3) as yhat, status from ar where h > 0""")
def _(t):
    f = R.autoregressive_forecast(series(t), ["product_line"], 30)
    return f.select("product_line", F.col("ds").cast("string").alias("ds"), F.round("yhat", 3).alias("yhat"), "status")


@query("fc03_additive_error", "transactions", f"""
with {SERIES_SQL}, n as (select *, row_number() over (partition by product_line order by ds) as k, count(*) over (partition by product_line) as n from s),
w as (select product_line, fold, ds, y, k <= n - fold * 7 as train from n, range(1, 4) f(fold) where n - fold * 7 > 30 and k <= n - fold * 7 + 7),
wt as (select product_line, fold, ds, y from w where train), {additive_sql('wt', 'product_line, fold', 7).replace('fc as (select product_line, fold', 'fc as (select fu.product_line, fu.fold')},
e as (select w.product_line, w.fold, avg(abs(y - yhat)) as mae from w join fc on fc.product_line = w.product_line and fc.fold = w.fold and fc.ds = w.ds where not train group by 1, 2)
select product_line, round(avg(mae), 3) as mae from e group by 1""")
def _(t):
    splits = R.walk_forward(series(t), "product_line")
    return R.walk_forward_error(splits, "product_line", R.additive_forecast).withColumn("mae", F.round("mae", 3))


CHAMPION_SQL = f"""
n as (select *, row_number() over (partition by product_line order by ds) as k, count(*) over (partition by product_line) as n from s),
w as (select product_line, fold, ds, y, k <= n - fold * 7 as train from n, range(1, 4) f(fold) where n - fold * 7 > 30 and k <= n - fold * 7 + 7),
wt as (select product_line, fold, ds, y from w where train), {additive_sql('wt', 'product_line, fold', 7).replace('fc as (select product_line, fold', 'fc as (select fu.product_line, fu.fold')},
{autoregressive_sql('wt', 'product_line, fold', 7)},
ea as (select w.product_line, w.fold, avg(abs(y - yhat)) as mae from w join fc on fc.product_line = w.product_line and fc.fold = w.fold and fc.ds = w.ds where not train group by 1, 2),
eb as (select w.product_line, w.fold, avg(abs(y - yhat)) as mae from w join ar on ar.product_line = w.product_line and ar.fold = w.fold and ar.e + ar.h = w.ds where not train and yhat is not null group by 1, 2),
sc as (select product_line, additive_mae, autoregressive_mae, case when coalesce(additive_mae, 'inf'::double) <= coalesce(autoregressive_mae, 'inf'::double) then 'additive' else 'autoregressive' end as winner
 from (select distinct product_line from s) left join (select product_line, avg(mae) as additive_mae from ea group by 1) using (product_line)
 left join (select product_line, avg(mae) as autoregressive_mae from eb group by 1) using (product_line))"""


def _renamed(steps, *names):
    """The steps of a model under other names, for a second use in one text."""
    for name in sorted(names, key=len, reverse=True):
        steps = re.sub(rf"\b{name}\b", f"{name}_all", steps)
    return steps


@query("fc03_champion", "transactions", f"""
with recursive {SERIES_SQL}, {CHAMPION_SQL}
select product_line, round(additive_mae, 3) as additive_mae, round(autoregressive_mae, 3) as autoregressive_mae, winner from sc""")
def _(t):
    scores, _ = R.champion_forecast(series(t), "product_line")
    return scores.withColumns({c: F.round(c, 3) for c in ("additive_mae", "autoregressive_mae")})


@query("fc03_champion_forecast", "transactions", f"""
with recursive {SERIES_SQL}, {CHAMPION_SQL},
{_renamed(additive_sql('s', 'product_line', 30).replace('fc as (select product_line', 'fc as (select fu.product_line'), 't0', 'tr0', 'rs', 'sea', 'sd', 'fu', 'fc')},
{_renamed(autoregressive_sql('s', 'product_line', 30), 'ar', 'ar1', 'ar2', 'ar3', 'ar4', 'ar5')}
select product_line, strftime(ds, '%Y-%m-%d') as ds, round(yhat, 3) as yhat, winner from fc_all join sc using (product_line) where winner = 'additive'
union all select product_line, strftime(e + h, '%Y-%m-%d'), round(yhat, 3), winner from ar_all join sc using (product_line) where winner = 'autoregressive' and h > 0""")
def _(t):
    _, forecast = R.champion_forecast(series(t), "product_line")
    return forecast.select("product_line", F.col("ds").cast("string").alias("ds"), F.round("yhat", 3).alias("yhat"), "winner")


@query("fc04_actual_and_forecast", "transactions", f"""
with {SERIES_SQL}, {additive_sql('s', 'product_line', 30).replace('fc as (select product_line', 'fc as (select fu.product_line')},
m as (select product_line, max(ds) as b from s group by 1)
select product_line, strftime(ds, '%Y-%m-%d') as ds, round(y, 3) as value, 'actual' as kind from s join m using (product_line) where b - ds < 60
union all select product_line, strftime(ds, '%Y-%m-%d'), round(yhat, 3), 'forecast' from fc""")
def _(t):
    s = series(t)
    both = R.actual_and_forecast(s, R.additive_forecast(s, ["product_line"], 30), "product_line", 60)
    return both.select("product_line", F.col("ds").cast("string").alias("ds"), F.round("value", 3).alias("value"), "kind")


@query("bk01_association_rules", "transactions", """
with names as (select product_line, row_number() over (order by product_line) - 1 as i from (select distinct product_line from transactions)),
bs as (select branch, cast(ts as date) as ds, bit_or(1 << i::int) as m from transactions join names using (product_line) group by 1, 2),
sets as (select cast(s as int) as s, count(*) filter ((m & s) = s) / count(*) as sup from bs, range(1, 64) r(s) group by 1),
f as (select * from sets where sup >= 0.03),
nm as (select s, string_agg(product_line, ', ' order by product_line) as name from f, names where (s & (1 << i::int)) > 0 group by 1),
r as (select a.s as x, c.s as y, b.sup as support, b.sup / a.sup as confidence, b.sup / a.sup / c.sup as lift from f a join f c on (a.s & c.s) = 0 join f b on b.s = (a.s | c.s) where b.sup / a.sup / c.sup >= 1),
th as (select max(v) as v from (select unnest([0.20, 0.15, 0.10, 0.05, 0.03])::double as v) where v <= (select max(support) from r))
select p.name as antecedents, q.name as consequents, round(support, 6) as support, round(confidence, 6) as confidence, round(lift, 6) as lift
from r join nm p on p.s = x join nm q on q.s = y, th where support >= th.v""")
def _(t):
    days = t.transactions.select("branch", F.to_date("ts").alias("ds"), "product_line")
    rules = R.association_rules(days, ["branch", "ds"], "product_line")
    return rules.select("antecedents", "consequents", *[r6(c).alias(c) for c in ("support", "confidence", "lift")])


@query("eq01_commune_equity", "buildings", f"""
with b as ({CLEAN_BUILDINGS_SQL}),
g as (select code_insee, avg(coalesce(cast(imb_etat = 'deploye' as int), 0)) as coverage, avg(coalesce(cast(imb_etat = 'deploye' as int), 0)) filter (catg_loc_imb in ('entre 2 et 11', 'entre 12 et 35', 'entre 36 et 99', '100 et plus')) as coll,
 count(*) as n_buildings, round(count(*) / greatest(count(distinct pm_ref), 1), 9) as load, min(nom_com) as nom_com from b group by 1),
r as (select *, 1 - (rank() over (order by load) + (count(*) over (partition by load) - 1) / 2) / count(*) over () as pm_load, coalesce(coll, coverage) as coll_lag from g)
select code_insee, round(coverage, 6) as coverage, round(pm_load, 6) as pm_load, round(coll_lag, 6) as coll_lag,
 round(0.6::double * coverage + 0.2::double * pm_load + 0.2::double * coll_lag, 6) as equity_index, nom_com, n_buildings from r""")
def _(t):
    e = Q.commune_equity(clean_buildings(t.buildings))
    real = ("coverage", "pm_load", "coll_lag", "equity_index")
    return e.select("code_insee", *[r6(c).alias(c) for c in real], "nom_com", "n_buildings")


@query("wi01_what_if", "transactions", """
with sh as (select avg(cast(customer_type = 'BUILDING' as int)) as m, avg(cast(payment = '1-URGENT' as int)) as w from transactions),
x as (select strftime(ts, '%Y-%m') as month, sum(total) as baseline, sum(unit_price * 1.05::double * round_even(greatest(quantity * 0.95::double, 1), 0) * 1.05::double) as p from transactions group by 1)
select month, round(baseline, 3) as baseline, round(p * (1 + (0.5::double - m) * 0.05::double) * (1 + (0.4::double - w) * 0.03::double), 3) as projected,
 round(p * (1 + (0.5::double - m) * 0.05::double) * (1 + (0.4::double - w) * 0.03::double) - baseline, 3) as delta from x, sh""")
def _(t):
    out = R.what_if(t.transactions, 1.05, 0.95, member_target=0.5, wallet_target=0.4)
    return out.select("month", *[F.round(c, 3).alias(c) for c in ("baseline", "projected", "delta")])


@query("ph01_anchor", "links", """
select link_id, round(20 * log10(sqrt(2 * pow(10, (5 + 20 * osnr) / 10)) + 1e-9) / 4, 6) as anchor,
 round(q_factor - 20 * log10(sqrt(2 * pow(10, (5 + 20 * osnr) / 10)) + 1e-9) / 4, 6) as residual from links""")
def _(t):
    anchor = Q.anchor_q(F.col("osnr"))
    return t.links.select("link_id", r6(anchor).alias("anchor"), r6(F.col("q_factor") - anchor).alias("residual"))


def _erfc_sql():
    """The same rational fit as the operator, x = q / sqrt(2) >= 0."""
    from tablewright.functions.tails import ERFC_TERMS

    poly = f"({ERFC_TERMS[-1]}::double)"
    for c in reversed(ERFC_TERMS[:-1]):
        poly = f"({poly} * t + ({c}::double))"
    return f"t * exp(-x * x + {poly})"


@query("ph01_bit_error_rate", "links", f"""
with x as (select link_id, q_factor / sqrt(2) as x, 1 / (1 + abs(q_factor / sqrt(2)) / 2) as t from links)
select link_id, round(case when x >= 0 then {_erfc_sql()} else 2 - {_erfc_sql()} end / 2, 9) as ber from x""")
def _(t):
    return t.links.select("link_id", F.round(Q.bit_error_rate(F.col("q_factor")), 9).alias("ber"))
