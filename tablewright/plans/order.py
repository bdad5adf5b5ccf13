"""Queries for windows, set operations, samples, splits and statistics."""

from __future__ import annotations

from pyspark.sql import functions as F


from tablewright.operators import aggregates as A
from tablewright.operators import columns as C
from tablewright.operators import metrics as E
from tablewright.operators import relations as J
from tablewright.operators import retail as R
from tablewright.operators import sampling as S
from tablewright.operators import statistics as X
from tablewright.operators import windows as W

from tablewright.plans.columns import LINKS, r6
from tablewright.plans.registry import query
from tablewright.plans.shared import (
    DEGREE_SQL, POP_SQL, SPLIT_SQL, YEAR_SQL, pop_lists, split_ratings, tags_clean,
)
from tablewright.plans.views import BUCKET
from tablewright.sources.files import path_labels

SPACE = "4294967296::double"


@query("pr05_split_code", "ratings", f"with {SPLIT_SQL} select split, count(*) as n from s group by split")
def _(t):
    ranked = W.recency_rank(t.kept("ratings"))
    return ranked.groupBy(C.split_code(F.col("rn_desc"), F.col("user_n")).alias("split")).agg(F.count("*").alias("n"))


@query("wn01_recency_rank", "ratings", """
select userId, movieId, cast(row_number() over (partition by userId order by rated_at desc, movieId desc) as bigint) as rn_desc,
 count(*) over (partition by userId) as user_n from ratings""")
def _(t):
    return W.recency_rank(t.kept("ratings")).select("userId", "movieId", F.col("rn_desc").cast("long").alias("rn_desc"), "user_n")


@query("wn02_leave_last_out", "ratings movies", f"""
with {SPLIT_SQL} select userId, movieId, rating, split, cast(hour(rated_at) as int) as hour, cast(isodow(rated_at) as int) as dow,
 cast(year(rated_at) - {YEAR_SQL} as int) as movie_age from s left join movies using (movieId)""")
def _(t):
    films = t.movies.select("movieId", C.release_year("title", -1).alias("release_year"))
    return W.with_rating_context(split_ratings(t), films).drop("rated_at")


@query("wn03_percentile_rank", "ratings", """
with u as (select userId, avg(rating) as m from ratings group by 1)
select userId, round((rank() over (order by m) + (count(*) over (partition by m) - 1) / 2) / count(*) over (), 6) as rank_pct from u""")
def _(t):
    means = t.ratings.groupBy("userId").agg(F.avg("rating").alias("m"))
    return W.with_percentile_rank(means, "m").select("userId", r6("rank_pct").alias("rank_pct"))


@query("wn04_cumulative_precision", "ratings", f"""
with {SPLIT_SQL}, {POP_SQL}, h as (select userId, rank, cast(exists (select 1 from te where te.userId = top.userId and te.movieId = top.movieId and te.rating >= 3.5) as int) as hit from top)
select userId, rank, hit, round(sum(hit) over (partition by userId order by rank) / rank, 6) as precision_at from h""")
def _(t):
    split, lists = pop_lists(t)
    relevant = E.relevant_pairs(split.where("split = 2")).withColumn("hit", F.lit(1))
    hits = lists.join(relevant, ["userId", "movieId"], "left").na.fill(0, ["hit"])
    return W.cumulative_precision(hits).select("userId", "rank", "hit", r6("precision_at").alias("precision_at"))


@query("wn05_top_n", "", "select o_orderkey, o_custkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 25")
def _(t):
    return W.top_n(t.orders, 25, F.desc("o_totalprice"), "o_orderkey").select("o_orderkey", "o_custkey", "o_totalprice")


@query("wn06_top_per_group", "ratings", """
select userId, movieId, rating, cast(rank as int) as rank from (select *, row_number() over (partition by userId order by rating desc, movieId) as rank from ratings) where rank <= 5""")
def _(t):
    return W.top_per_group(t.ratings, ["userId"], 5, F.desc("rating"), "movieId").select("userId", "movieId", "rating", "rank")


@query("wn07_last_per_key", "", """
select user_id, event_id, event_type, value from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events) where rn = 1""")
def _(t):
    return W.last_per_key(t.events, ["user_id"], ["ts", "event_id"], ["event_id", "event_type", "value"])


@query("wn08_deduplicate", "tags", "select count(*) as n_rows, count(distinct userId) as users from (select distinct userId, movieId, tag from tags)")
def _(t):
    kept = t.tags.dropDuplicates(["userId", "movieId", "tag"])
    return kept.agg(F.count("*").alias("n_rows"), F.count_distinct("userId").alias("users"))


@query("wn09_popularity_bucket", "ratings", """
with s as (select movieId, count(*) as n_ratings from ratings group by movieId), q as (select quantile_cont(n_ratings, [0.5, 0.8, 0.95, 0.99]) as c from s)
select movieId, n_ratings, cast((n_ratings > c[1])::int + (n_ratings > c[2])::int + (n_ratings > c[3])::int + (n_ratings > c[4])::int as int) as popularity_bucket from s, q""")
def _(t):
    return A.popularity_bucket(t.ratings.groupBy("movieId").agg(F.count("*").alias("n_ratings")))


QUART_SQL = """u as (select userId, count(*) as n from ratings group by 1), q as (select quantile_cont(n, [0.25, 0.5, 0.75]) as c from u),
seg as (select userId, n, case when n < c[1] + 1 then 'Q1' when n < c[2] + 1 then 'Q2' when n < c[3] + 1 then 'Q3' else 'Q4' end as segment from u, q)"""


@query("wn10_activity_quartiles", "ratings", f"with {QUART_SQL} select userId, n, segment from seg")
def _(t):
    return A.activity_quartiles(t.ratings.groupBy("userId").agg(F.count("*").alias("n")))


@query("st01_union", "", """
select key, kind, name from (select c_custkey as key, 'customer' as kind, c_name as name from customer union all select s_suppkey, 'supplier', s_name from supplier)""")
def _(t):
    a = t.customer.select(F.col("c_custkey").alias("key"), F.lit("customer").alias("kind"), F.col("c_name").alias("name"))
    b = t.supplier.select(F.col("s_suppkey").alias("key"), F.lit("supplier").alias("kind"), F.col("s_name").alias("name"))
    return a.unionByName(b)


@query("st02_distinct_keys", "ratings", "select userId from ratings union select user_id from events")
def _(t):
    return J.all_keys([t.ratings, t.events.withColumnRenamed("user_id", "userId")], "userId")


@query("st03_side_by_side", "links", "select link_id, round(osnr, 6) as osnr, round(osnr * dispersion, 6) as product, round(q_factor, 6) as q_factor from links")
def _(t):
    both = C.pairwise_products(t.links.select("link_id", "osnr", "dispersion", "q_factor"), ["osnr", "dispersion"])
    return both.select("link_id", r6("osnr").alias("osnr"), r6("osnr_x_dispersion").alias("product"), r6("q_factor").alias("q_factor"))


@query("st04_top_set", "tags", f"""
with {DEGREE_SQL} select userId, movieId, tag_clean from c where tag_clean in (select tag_clean from top)""")
def _(t):
    from tablewright.operators.text import top_tags

    tags = tags_clean(t)
    return J.restrict_to(tags, top_tags(tags, 80), ["tag_clean"]).select("userId", "movieId", "tag_clean")


@query("sa01_sample_active", "ratings", f"""
select userId, movieId, rating from ratings where {BUCKET('cast(userId as varchar)')} / {SPACE} < 0.2::double
 and userId in (select userId from ratings group by 1 having count(*) >= 20)""")
def _(t):
    return S.sample_active(t.ratings, "userId", 0.2, 20).select("userId", "movieId", "rating")


@query("sa01_sample_fraction", "", f"""
select event_id, user_id, value from events where {BUCKET('cast(user_id as varchar)')} / {SPACE} < 0.3::double""")
def _(t):
    return S.sample_fraction(t.events, "user_id", 0.3).select("event_id", "user_id", "value")


@query("sa02_sample_rows", "", f"select event_id, user_id, value from events order by {BUCKET('cast(event_id as varchar)')}, event_id limit 300")
def _(t):
    return S.sample_rows(t.events, "event_id", 300).select("event_id", "user_id", "value")


@query("sa03_sample_per_class", "", f"""
select doc_id, lang from (select doc_id, lang, row_number() over (partition by lang order by {BUCKET('cast(doc_id as varchar)')}, doc_id) as rn from documents) where rn <= 30""")
def _(t):
    return S.sample_per_class(t.documents.select("doc_id", "lang"), "lang", "doc_id", 30)


@query("sa04_systematic", "", "select o_orderkey, o_totalprice from orders where o_orderkey % 50 = 0")
def _(t):
    return S.systematic_sample(t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey", 50)


CAP_SQL = f"cap as (select userId from (select distinct userId from ratings) order by {BUCKET('cast(userId as varchar)')}, userId limit 200)"


@query("sa05_cap_users", "ratings", f"with {CAP_SQL} select userId, movieId, rating from ratings where userId in (select userId from cap)")
def _(t):
    return S.cap_users(t.ratings, "userId", 200).select("userId", "movieId", "rating")


@query("sp01_three_way", "links", f"""
select split, count(*) as n, round(avg(q_factor), 6) as mean_q from (select q_factor, case when u < 0.7::double then 'train' when u < 0.7::double + 0.15::double then 'val' else 'test' end as split
 from (select q_factor, {BUCKET('link_id')} / {SPACE} as u from links)) group by 1""")
def _(t):
    split = S.random_split("link_id", {"train": 0.7, "val": 0.15, "test": 0.15})
    return t.links.groupBy(split.alias("split")).agg(F.count("*").alias("n"), r6(F.avg("q_factor")).alias("mean_q"))


@query("sp02_two_way", "houses", f"select pid, case when {BUCKET('cast(pid as varchar)')} / {SPACE} < 0.8::double then 'train' else 'test' end as split from houses")
def _(t):
    return t.houses.select("pid", S.random_split("pid", {"train": 0.8, "test": 0.2}).alias("split"))


@query("sp03_stratified", "scored", f"""
select doc_id, y, case when (rn - 1) / nullif(n - 1, 0) < 0.2::double then 1 else 0 end as is_test from
 (select doc_id, y, row_number() over (partition by y order by {BUCKET('cast(doc_id as varchar)')}, doc_id) as rn, count(*) over (partition by y) as n from scored)""")
def _(t):
    return S.stratified_split(t.scored.select("doc_id", "y"), "y", "doc_id", 0.2)


@query("sp04_promote", "manifest", f"""
with m as (select filepath, split_part(filepath, '/', -3) as split, split_part(filepath, '/', -2) as label from manifest),
r as (select *, row_number() over (partition by label order by {BUCKET('filepath')}, filepath) as rn, count(*) over (partition by label) as n from m where split = 'train')
select filepath, label, case when (rn - 1) / nullif(n - 1, 0) < 0.1::double then 'val' else 'train' end as split from r
union all select filepath, label, split from m where split <> 'train'""")
def _(t):
    labelled = path_labels(t.manifest).select("filepath", "label", "split")
    return S.promote_to_validation(labelled, "label", "filepath", 0.1)


@query("sp05_group_folds", "buildings", f"""
with g as (select pm_ref, row_number() over (order by count(*) desc, {BUCKET('pm_ref')}) - 1 as r from buildings group by pm_ref)
select imb_id, pm_ref, cast(case when r % 10 < 5 then r % 10 else 9 - r % 10 end as int) as fold from buildings join g using (pm_ref)""")
def _(t):
    return S.group_folds(t.buildings.select("imb_id", "pm_ref"), "pm_ref", 5)


@query("sp06_hash_folds", "links", f"""
select cast({BUCKET('link_id')} % 5 as int) as fold, count(*) as n, round(avg(q_factor), 6) as mean_q from links group by 1""")
def _(t):
    return t.links.groupBy(S.hash_folds("link_id", 5).alias("fold")).agg(F.count("*").alias("n"), r6(F.avg("q_factor")).alias("mean_q"))


@query("sp07_walk_forward", "transactions", """
with d as (select product_line, cast(ts as date) as ds, sum(total) as y from transactions group by 1, 2),
c as (select product_line, unnest(generate_series(min(ds), max(ds), interval 1 day))::date as ds from d group by 1),
s as (select product_line, ds, coalesce(y, 0) as y, row_number() over (partition by product_line order by ds) as i, count(*) over (partition by product_line) as n from c left join d using (product_line, ds))
select product_line, cast(fold as int) as fold, strftime(ds, '%Y-%m-%d') as ds, case when i <= n - fold * 7 then 'train' else 'test' end as role
from s, range(1, 4) f(fold) where n - fold * 7 > 30 and i <= n - fold * 7 + 7""")
def _(t):
    s = A.daily_series(t.transactions, "product_line", "ts", "total")
    return R.walk_forward(s, "product_line").select("product_line", "fold", F.col("ds").cast("string").alias("ds"), "role")


NUMBERS = [*LINKS, "q_factor"]


@query("ss01_correlation_matrix", "links", " union all ".join(
    f"select '{a}' as a, '{b}' as b, round(corr({a}, {b}), 6) as corr from links" for i, a in enumerate(NUMBERS) for b in NUMBERS[i + 1:]))
def _(t):
    return X.correlation_matrix(t.links, NUMBERS).withColumn("corr", r6("corr"))


@query("ss01_target_correlation", "links", " union all ".join(
    f"select '{a}' as \"column\", round(corr({a}, q_factor), 6) as corr from links" for a in LINKS))
def _(t):
    return X.target_correlation(t.links, LINKS, "q_factor").withColumn("corr", r6("corr"))


def _rank_sql(c):
    return f"rank() over (order by {c}) + (count(*) over (partition by {c}) - 1) / 2"


@query("ss02_spearman", "links", " union all ".join(
    f"select '{c}' as \"column\", round(corr(a, b), 6) as rho from (select {_rank_sql(c)} as a, {_rank_sql('q_factor')} as b from links)" for c in LINKS))
def _(t):
    return X.spearman(t.links, LINKS, "q_factor").withColumn("rho", r6("rho"))


ANOVA_SQL = """
with g as (select branch, count(*) as n, avg(total) as m, var_pop(total) as v from transactions group by branch), a as (select sum(n * m) / sum(n) as gm, sum(n) as n, count(*) as k from g)
select round((select sum(n * (m - gm) * (m - gm)) / (any_value(k) - 1) from g, (select gm, k from a)) / (select sum(n * v) from g) * (n - k), 4) as f_value,
 k - 1 as df_between, cast(n - k as bigint) as df_within from a"""


@query("ss03_anova", "transactions", ANOVA_SQL)
def _(t):
    return X.anova(t.transactions, "branch", "total").withColumn("f_value", F.round("f_value", 4))


@query("ss03_anova_p", "transactions")
def _(t):
    return X.anova_p(t.transactions, "branch", "total")


@query("ss04_normality", "links", """
with b as (select count(*)::double as n, avg(q_factor) as m from links),
c as (select any_value(n) as n, avg(pow(q_factor - m, 3)) / pow(avg(pow(q_factor - m, 2)), 1.5::double) as g1, avg(pow(q_factor - m, 4)) / pow(avg(pow(q_factor - m, 2)), 2) as b2 from links, b),
s as (select *, g1 * sqrt((n + 1) * (n + 3) / (6 * (n - 2))) as y, 3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9)) as beta2,
 (b2 - 3 * (n - 1) / (n + 1)) / sqrt(24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))) as x,
 6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) as rb from c),
w as (select *, sqrt(2 * (beta2 - 1)) - 1 as w2, 6 + 8 / rb * (2 / rb + sqrt(1 + 4 / (rb * rb))) as a from s),
z as (select asinh(y / sqrt(2 / (w2 - 1))) / sqrt(ln(w2) / 2) as z1,
 (1 - 2 / (9 * a) - sign((1 - 2 / a) / (1 + x * sqrt(2 / (a - 4)))) * pow(abs((1 - 2 / a) / (1 + x * sqrt(2 / (a - 4)))), 1.0::double / 3)) / sqrt(2 / (9 * a)) as z2 from w)
select round(z1, 4) as z_skew, round(z2, 4) as z_kurtosis, round(z1 * z1 + z2 * z2, 3) as k2, round(exp(-(z1 * z1 + z2 * z2) / 2), 6) as p_value from z""")
def _(t):
    k = X.normality(t.links, "q_factor")
    return k.select(F.round("z_skew", 4).alias("z_skew"), F.round("z_kurtosis", 4).alias("z_kurtosis"), F.round("k2", 3).alias("k2"), r6("p_value").alias("p_value"))


def _bin_sql(c):
    return " + ".join(f"({c} > (select quantile_cont({c}, {i / 10}) from links))::int" for i in range(1, 10))


@query("ss05_binned_information", "links", "with " + f"coded as (select {', '.join(f'{_bin_sql(c)} as {c}' for c in NUMBERS)} from links), " + """
long as (select "column", x, q_factor as t from coded unpivot (x for "column" in (""" + ", ".join(LINKS) + """))),
cells as (select "column", x, t, count(*)::double as n from long group by all),
j as (select *, sum(n) over (partition by "column", x) as nx, sum(n) over (partition by "column", t) as nt, sum(n) over (partition by "column") as a from cells)
select "column", round(sum(n / a * ln(n * a / (nx * nt))), 6) as information from j group by 1""")
def _(t):
    return X.binned_information(t.links, LINKS, "q_factor").withColumn("information", r6("information"))


@query("ss06_distance_outliers", "links", f"""
with m as (select {', '.join(f'avg({c}) as m_{c}, stddev_pop({c}) as s_{c}' for c in LINKS)} from links),
d as (select link_id, round({' + '.join(f'pow(({c} - m_{c}) / s_{c}, 2)' for c in LINKS)}, 9) as distance from links, m)
select link_id, round(distance, 6) as distance, cast(distance > (select quantile_cont(distance, 0.99) from d) as int) as is_outlier from d""")
def _(t):
    return X.distance_outliers(t.links, LINKS).select("link_id", r6("distance").alias("distance"), "is_outlier")


@query("ss07_treatment_means", "buildings", """
select cast(code_l331 is not distinct from 'A' as int) as treated, round(avg(case when imb_etat is not distinct from 'deploye' then 0 else 1 end), 6) as mean_outcome, count(*) as n from buildings group by 1""")
def _(t):
    b = C.with_lag_flag(t.buildings).withColumn("treated", F.col("code_l331").eqNullSafe("A").cast("int"))
    return X.treatment_means(b, "treated", "is_lagging").withColumn("mean_outcome", r6("mean_outcome"))
