"""Queries for joins and aggregations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tablewright.functions.scalars import ratio
from tablewright.operators import aggregates as A
from tablewright.operators import columns as C
from tablewright.operators import relations as J
from tablewright.operators.missing import clean_buildings
from tablewright.operators.retail import what_if
from tablewright.plans.columns import GENRES, NORMAL_SQL, r6
from tablewright.plans.quality import CLEAN_BUILDINGS_SQL
from tablewright.plans.registry import query
from tablewright.plans.shared import YEAR_SQL, tags_clean



@query("jn01_inner_dimension", "ratings movies", """
select p.genre, count(*) as n, round(avg(rating), 6) as mean_rating from ratings join
 (select movieId, unnest(string_split(genres, '|')) as genre from movies) p using (movieId) where genre <> '(no genres listed)' group by 1""")
def _(t):
    joined = t.ratings.join(C.exploded_genres(t.movies), "movieId")
    return joined.groupBy("genre").agg(F.count("*").alias("n"), r6(F.avg("rating")).alias("mean_rating"))


@query("jn02_left_features", "ratings movies", f"""
select userId, movieId, rating, cast(year(rated_at) - {YEAR_SQL} as int) as movie_age from ratings left join movies using (movieId)""")
def _(t):
    films = t.movies.select("movieId", C.release_year("title", -1).alias("release_year"))
    return t.ratings.join(films, "movieId", "left").select(
        "userId", "movieId", "rating", (F.year("rated_at") - F.col("release_year")).alias("movie_age")
    )


@query("jn03_group_values_to_rows", "buildings", """
select imb_id, pm_n_buildings, pm_n_operators from buildings left join
 (select pm_ref, count(*) as pm_n_buildings, count(distinct code_l331) as pm_n_operators from buildings group by pm_ref) using (pm_ref)""")
def _(t):
    rows = C.building_flags(t.buildings)
    return J.with_group_values(rows, A.pm_features(rows), "pm_ref").select("imb_id", "pm_n_buildings", "pm_n_operators")


@query("jn04_semi_join", "ratings", """
select userId, movieId, rating from ratings where userId in (select userId from ratings group by userId having count(*) >= 45)""")
def _(t):
    active = t.ratings.groupBy("userId").agg(F.count("*").alias("n")).where("n >= 45")
    return J.restrict_to(t.ratings, active, ["userId"]).select("userId", "movieId", "rating")


@query("jn05_aggregate_before_join", "ratings movies", f"""
select cast(floor(y / 10) * 10 as int) as decade, genre, count(*) as n, round(avg(rating), 6) as mean_rating
from ratings join (select movieId, {YEAR_SQL} as y, unnest(string_split(genres, '|')) as genre from movies) using (movieId)
where y > 0 and genre <> '(no genres listed)' group by 1, 2""")
def _(t):
    years = t.movies.select("movieId", C.decade(C.release_year("title")).alias("decade")).where("decade is not null")
    films = years.join(C.exploded_genres(t.movies), "movieId")
    return J.genre_means(t.ratings, films, ["decade", "genre"]).withColumn("mean_rating", r6("mean_rating"))


@query("jn06_baseline_vs_projected", "transactions", """
with b as (select strftime(ts, '%Y-%m') as month, sum(total) as baseline from transactions group by 1),
p as (select strftime(ts, '%Y-%m') as month, sum(unit_price * 1.1::double * round_even(greatest(quantity * 0.9::double, 1), 0) * 1.05::double) as projected from transactions group by 1)
select month, round(baseline, 4) as baseline, round(projected, 4) as projected, round(projected - baseline, 4) as delta from b join p using (month)""")
def _(t):
    out = what_if(t.transactions, price=1.1, quantity=0.9)
    return out.select("month", *[F.round(c, 4).alias(c) for c in ("baseline", "projected", "delta")])


@query("jn07_fallback_lookup", "buildings", """
with g as (select code_insee, avg(cast(imb_etat is not distinct from 'deploye' as int)) as coverage from buildings group by 1),
c as (select code_insee, avg(cast(imb_etat is not distinct from 'deploye' as int)) as coll from buildings where catg_loc_imb = '100 et plus' and code_l331 = 'A' group by 1)
select code_insee, round(coverage, 6) as coverage, round(coalesce(coll, coverage), 6) as coll from g left join c using (code_insee)""")
def _(t):
    b = C.with_lag_flag(t.buildings).withColumn("ok", 1 - F.col("is_lagging"))
    g = b.groupBy("code_insee").agg(F.avg("ok").alias("coverage"))
    c = b.where("catg_loc_imb = '100 et plus' and code_l331 = 'A'").groupBy("code_insee").agg(F.avg("ok").alias("coll"))
    out = J.filled_from(g, c, "code_insee", "coll", "coverage")
    return out.select("code_insee", r6("coverage").alias("coverage"), r6("coll").alias("coll"))


@query("ag01_sum_by_key", "transactions", "select branch, round(sum(total), 4) as total from transactions group by branch")
def _(t):
    return t.transactions.groupBy("branch").agg(F.round(F.sum("total"), 4).alias("total")).orderBy(F.desc("total"))


@query("ag02_multi_measure", "transactions", """
select branch, payment, round(sum(total), 4) as total, count(*) as n, round(avg(rating), 4) as mean_rating from transactions group by 1, 2""")
def _(t):
    return t.transactions.groupBy("branch", "payment").agg(
        F.round(F.sum("total"), 4).alias("total"), F.count("*").alias("n"), F.round(F.avg("rating"), 4).alias("mean_rating")
    )


@query("ag03_share_of_total", "transactions", """
select product_line, round(sum(total), 4) as total, round(sum(total) / sum(sum(total)) over (), 6) as share from transactions group by 1""")
def _(t):
    g = t.transactions.groupBy("product_line").agg(F.sum("total").alias("total"))
    return A.with_share(g, "total").select("product_line", F.round("total", 4).alias("total"), r6("share").alias("share"))


@query("ag04_by_rating_value", "ratings", "select rating, count(*) as n from ratings group by 1")
def _(t):
    return t.ratings.groupBy("rating").agg(F.count("*").alias("n"))


def _time_sql(expr, name):
    return f"select cast({expr} as int) as {name}, count(*) as n, round(avg(rating), 6) as mean_rating from ratings group by 1"


def _by(t, expr, name):
    return A.count_mean(t.ratings, expr, "rating", name).select(name, "n", r6("mean_value").alias("mean_rating"))


@query("ag04_by_year", "ratings", _time_sql("year(rated_at)", "year"))
def _(t):
    return _by(t, F.year("rated_at"), "year")


@query("ag04_by_month", "ratings", _time_sql("month(rated_at)", "month"))
def _(t):
    return _by(t, F.month("rated_at"), "month")


@query("ag04_by_weekday", "ratings", _time_sql("isodow(rated_at)", "dow"))
def _(t):
    return _by(t, F.weekday("rated_at") + 1, "dow")


@query("ag04_by_age", "ratings movies", f"""
select cast(year(rated_at) - y as int) as age, count(*) as n, round(avg(rating), 6) as mean_rating from ratings join
 (select movieId, {YEAR_SQL} as y from movies) using (movieId) where y > 0 and year(rated_at) - y between 0 and 100 group by 1""")
def _(t):
    films = t.movies.select("movieId", C.release_year("title").alias("y")).where("y is not null")
    aged = t.ratings.join(films, "movieId").withColumn("age", F.year("rated_at") - F.col("y"))
    return A.count_mean(aged.where(F.col("age").between(0, 100)), "age", "rating", "age").select(
        "age", "n", r6("mean_value").alias("mean_rating"))


@query("ag04_events_by_hour", "", """
select event_type, cast(hour(ts) as int) as hour, count(*) as n, round(avg(value), 6) as mean_value from events group by 1, 2""")
def _(t):
    return t.events.groupBy("event_type", F.hour("ts").alias("hour")).agg(
        F.count("*").alias("n"), r6(F.avg("value")).alias("mean_value"))


FLAGS_SQL = ", ".join(f"cast(list_contains(string_split(genres, '|'), '{g}') as int) as g_{g}" for g in GENRES)


@query("ag05_item_features", "ratings movies", f"""
with s as (select movieId, count(*) as n_ratings, avg(rating) as mean_rating, stddev(rating) as std_rating, count(distinct userId) as n_unique_users,
  min(rated_at) as a, max(rated_at) as b from ratings group by movieId),
q as (select quantile_cont(n_ratings, [0.5, 0.8, 0.95, 0.99]) as c from s),
m as (select *, {YEAR_SQL} as release_year, {FLAGS_SQL} from movies)
select movieId, n_ratings, round(mean_rating, 6) as mean_rating, round(std_rating, 6) as std_rating, n_unique_users,
 strftime(a, '%Y-%m-%d') as first_rated, strftime(b, '%Y-%m-%d') as last_rated,
 cast((n_ratings > c[1])::int + (n_ratings > c[2])::int + (n_ratings > c[3])::int + (n_ratings > c[4])::int as int) as popularity_bucket,
 title, release_year, cast(floor(release_year / 10) * 10 as int) as decade, {', '.join('g_' + g for g in GENRES)}
from s cross join q left join m using (movieId)""")
def _(t):
    f = A.item_features(t.kept("ratings"), t.movies, GENRES, missing_year=-1)
    return f.select(
        "movieId", "n_ratings", r6("mean_rating").alias("mean_rating"), r6("std_rating").alias("std_rating"), "n_unique_users",
        F.date_format("first_rated_at", "yyyy-MM-dd").alias("first_rated"),
        F.date_format("last_rated_at", "yyyy-MM-dd").alias("last_rated"),
        "popularity_bucket", "title", "release_year", "decade", *[f"g_{g}" for g in GENRES],
    )


@query("ag06_user_features", "ratings movies", f"""
select userId, count(*) as n_ratings, round(avg(rating), 6) as mean_rating, round(stddev(rating), 6) as std_rating, count(distinct movieId) as n_unique_movies,
 cast(floor((epoch(max(rated_at)) - epoch(min(rated_at))) / 86400) as int) as tenure_days,
 {', '.join(f"round(avg(rating) filter (g_{g} = 1), 6) as affinity_{g}, nullif(count(*) filter (g_{g} = 1), 0) as n_{g}" for g in GENRES)}
from ratings left join (select movieId, {FLAGS_SQL} from movies) using (movieId) group by userId""")
def _(t):
    f = A.user_features(t.ratings, t.movies, GENRES)
    per = [c for g in GENRES for c in (r6(f"affinity_{g}").alias(f"affinity_{g}"), F.col(f"n_{g}"))]
    return f.select("userId", "n_ratings", r6("mean_rating").alias("mean_rating"), r6("std_rating").alias("std_rating"),
                    "n_unique_movies", "tenure_days", *per)


CLEAN = f"b as ({CLEAN_BUILDINGS_SQL}), f as (select *, coalesce(cast(catg_loc_imb = 'individuel' as int), 0) as ind, coalesce(cast(catg_loc_imb in ('entre 36 et 99', '100 et plus') as int), 0) as big from b)"
PM_SQL = """select pm_ref, count(*) as pm_n_buildings, count(distinct code_insee) as pm_n_communes, count(distinct code_l331) as pm_n_operators,
 round(avg(ind), 6) as pm_share_individuel, round(avg(big), 6) as pm_share_collective_large from f group by pm_ref"""
COM_SQL = """select code_insee, count(*) as com_n_buildings, count(distinct pm_ref) as com_n_pm, count(distinct code_l331) as com_n_operators,
 round(avg(ind), 6) as com_share_individuel, round(count(*) / greatest(count(distinct pm_ref), 1), 6) as com_buildings_per_pm from f group by code_insee"""
HHI_SQL = """select code_insee, round(sum(n * n) / (sum(n) * sum(n)), 6) as com_hhi from
 (select code_insee, coalesce(code_l331, '__na__') as op, count(*)::double as n from f group by 1, 2) group by code_insee"""


def flagged(t):
    return C.building_flags(clean_buildings(t.buildings))


@query("ag07_pm_features", "buildings", f"with {CLEAN} {PM_SQL}")
def _(t):
    g = A.pm_features(flagged(t))
    return g.withColumns({c: r6(c) for c in ("pm_share_individuel", "pm_share_collective_large")})


@query("ag08_commune_features", "buildings", f"with {CLEAN} {COM_SQL}")
def _(t):
    g = A.commune_features(flagged(t))
    return g.withColumns({c: r6(c) for c in ("com_share_individuel", "com_buildings_per_pm")})


@query("ag09_operator_concentration", "buildings", f"with {CLEAN} {HHI_SQL}")
def _(t):
    return A.operator_concentration(flagged(t)).withColumn("com_hhi", r6("com_hhi"))


@query("ag09_building_feature_table", "buildings", f"""
with {CLEAN} select imb_id, is_lagging, cast(batiment is not null as int) as has_building_label, coalesce(try_cast(num_voie as double), -1) as num_voie_filled,
 ind as is_individuel, big as is_collective_large, pm_n_buildings, pm_n_communes, pm_n_operators, pm_share_individuel, pm_share_collective_large,
 com_n_buildings, com_n_pm, com_n_operators, com_share_individuel, com_buildings_per_pm, com_hhi
from f left join ({PM_SQL}) using (pm_ref) left join ({COM_SQL}) using (code_insee) left join ({HHI_SQL}) using (code_insee)""")
def _(t):
    table = A.building_feature_table(clean_buildings(t.buildings))
    keep = [c for c in A.BUILDING_FEATURES if c != "has_postcode"]
    real = {"pm_share_individuel", "pm_share_collective_large", "com_share_individuel", "com_buildings_per_pm", "com_hhi"}
    return table.select("imb_id", "is_lagging", *[r6(c).alias(c) if c in real else F.col(c) for c in keep])


@query("ag10_conditional_mean", "buildings", """
select trim(nom_com) as nom_com, count(imb_id) as n, round(avg(case when imb_etat is not distinct from 'deploye' then 0 else 1 end) * 100, 4) as lag_pct
from buildings group by 1 having count(*) >= 100 order by round(avg(case when imb_etat is not distinct from 'deploye' then 0 else 1 end) * 100, 4) desc, 1 limit 15""")
def _(t):
    b = C.with_lag_flag(C.trim_strings(t.buildings))
    g = b.groupBy("nom_com").agg(F.count("imb_id").alias("n"), F.round(F.avg("is_lagging") * 100, 4).alias("lag_pct"))
    return g.where("n >= 100").orderBy(F.desc("lag_pct"), "nom_com").limit(15)


@query("ag11_rfm", "transactions", """
with s as (select max(ts) + interval 1 day as snap from transactions),
p as (select invoice_id, min_by(product_line, (-n, product_line)) as dominant_product from (select invoice_id, product_line, count(*) as n from transactions group by 1, 2) group by 1)
select invoice_id, cast(floor((epoch(any_value(snap)) - epoch(max(ts))) / 86400) as int) as recency, round(sum(quantity), 2) as frequency, round(sum(total), 4) as monetary,
 round(avg(rating), 6) as avg_rating, min(branch) as branch, min(customer_type) as customer_type, any_value(dominant_product) as dominant_product
from transactions join p using (invoice_id), s group by invoice_id""")
def _(t):
    return A.rfm(t.transactions).select(
        "invoice_id", "recency", F.round("frequency", 2).alias("frequency"), F.round("monetary", 4).alias("monetary"),
        r6("avg_rating").alias("avg_rating"), "branch", "customer_type", "dominant_product")


@query("ag12_segment_profile", "transactions", """
select customer_type, count(*) as size, round(avg(total), 4) as total, round(avg(quantity), 6) as quantity, round(count(*) / sum(count(*)) over (), 6) as share
from transactions group by 1""")
def _(t):
    return A.segment_profile(t.transactions, "customer_type", ["total", "quantity"]).select(
        "customer_type", "size", F.round("total", 4).alias("total"), r6("quantity").alias("quantity"), r6("share").alias("share"))


@query("ag13_daily_series", "transactions", """
with d as (select product_line, cast(ts as date) as ds, sum(total) as y from transactions group by 1, 2),
c as (select product_line, unnest(generate_series(min(ds), max(ds), interval 1 day))::date as ds from d group by 1)
select product_line, strftime(ds, '%Y-%m-%d') as ds, round(coalesce(y, 0), 4) as y from c left join d using (product_line, ds)""")
def _(t):
    s = A.daily_series(t.transactions, "product_line", "ts", "total")
    return s.select("product_line", F.col("ds").cast("string").alias("ds"), F.round("y", 4).alias("y"))


@query("ag14_weighted_mean", "ratings movies", f"""
select cast(floor(y / 10) * 10 as int) as decade, count(*) as n, round(avg(rating), 6) as mean_rating from ratings join
 (select movieId, {YEAR_SQL} as y from movies) using (movieId) where y > 0 group by 1""")
def _(t):
    films = t.movies.select("movieId", C.decade(C.release_year("title")).alias("decade")).where("decade is not null")
    return J.genre_means(t.ratings, films, ["decade"]).withColumn("mean_rating", r6("mean_rating"))


@query("ag15_quantile_cut", "ratings", """
with i as (select movieId, count(*) as n, avg(rating) as mean_rating from ratings group by 1)
select movieId, n, round(mean_rating, 6) as mean_rating from i where n >= (select quantile_cont(n, 0.9) from i)""")
def _(t):
    items = t.ratings.groupBy("movieId").agg(F.count("*").alias("n"), F.avg("rating").alias("mean_rating"))
    return A.above_quantile(items, "n", 0.9).withColumn("mean_rating", r6("mean_rating"))


@query("ag16_cold_start", "ratings movies", """
with u as (select count(*) as n from ratings group by userId), i as (select count(*) as n from ratings group by movieId)
select round(count(*) filter (n < 5) * 100.0::double / count(*), 6) as pct_item_lt5, round(count(*) filter (n < 10) * 100.0::double / count(*), 6) as pct_item_lt10,
 (select round(count(*) filter (n < 5) * 100.0::double / count(*), 6) from u) as pct_user_lt5, (select round(count(*) filter (n < 10) * 100.0::double / count(*), 6) from u) as pct_user_lt10,
 (select round(count(*) * 100.0::double / (select count(*) from movies), 6) from movies where movieId not in (select movieId from ratings)) as pct_item_unrated from i""")
def _(t):
    c = A.cold_start_percentages(t.kept("ratings"), t.movies)
    return c.select(*[r6(x).alias(x) for x in c.columns])


@query("ag17_density", "ratings", """
select count(*) / (count(distinct userId)::double * count(distinct movieId)) as density from ratings""")
def _(t):
    g = t.ratings.agg(F.count("*").alias("n"), F.count_distinct("userId").alias("u"), F.count_distinct("movieId").alias("i"))
    return g.select(ratio("n", F.col("u").cast("double") * F.col("i")).alias("density"))


@query("ag18_long_tail", "ratings", """
with i as (select movieId, count(*) as n from ratings group by 1), r as (select n, row_number() over (order by n desc) as rk from i)
select n as frequency, count(*) as members, min(rk) as rank_from, max(rk) as rank_to from r group by n""")
def _(t):
    return A.long_tail(t.ratings.groupBy("movieId").agg(F.count("*").alias("n")))


@query("ag19_tag_documents", "tags", f"""
with c as (select distinct userId, movieId, {NORMAL_SQL} as tag_clean from tags),
k as (select movieId, tag_clean, count(*) as n from c where length(tag_clean) > 0 group by 1, 2)
select movieId, string_agg(tag_clean, ' ' order by n desc, tag_clean) as doc, string_agg(n::varchar, ' ' order by n desc, tag_clean) as counts,
 count(*) as n_tags, cast(sum(n) as bigint) as total_tags from k group by 1 having sum(n) >= 3""")
def _(t):
    return A.tag_documents(tags_clean(t))


@query("ag20_class_weights", "scored", """
select y, count(*) as n, round(sum(count(*)) over () / (count(*) over () * count(*)), 6) as weight from scored group by y""")
def _(t):
    return A.class_weights(t.scored, "y").withColumn("weight", r6("weight"))


@query("ag21_two_way_counts", "manifest", """
select split_part(filepath, '/', -3) as split, count(*) filter (contains(filepath, '/NORMAL/')) as "NORMAL", count(*) filter (contains(filepath, '/PNEUMONIA/')) as "PNEUMONIA",
 count(*) as total, round(count(*) filter (contains(filepath, '/PNEUMONIA/')) / nullif(count(*) filter (contains(filepath, '/NORMAL/')), 0), 6) as ratio from manifest group by 1""")
def _(t):
    from tablewright.sources.files import path_labels

    g = A.two_way_counts(path_labels(t.manifest), "split", "label", ["NORMAL", "PNEUMONIA"])
    return g.withColumn("ratio", r6(ratio("PNEUMONIA", "NORMAL")))


@query("ag22_crosstab_margins", "buildings", """
with b as (select coalesce(imb_etat, 'missing') as imb_etat, case when imb_etat is not distinct from 'deploye' then '0' else '1' end as is_lagging from buildings)
select case when grouping(imb_etat) = 1 then 'All' else imb_etat end as imb_etat, case when grouping(is_lagging) = 1 then 'All' else is_lagging end as is_lagging, count(*) as n
from b group by cube (imb_etat, is_lagging)""")
def _(t):
    return A.crosstab_margins(C.with_lag_flag(t.buildings), "imb_etat", "is_lagging")


@query("ag23_pivot_decade_genre", "ratings movies", f"""
with f as (select movieId, {YEAR_SQL} as y, unnest(string_split(genres, '|')) as genre from movies),
common as (select genre, row_number() over (order by count(*) desc, genre) as k from ratings join f using (movieId) where genre <> '(no genres listed)' group by 1 order by k limit 10)
select cast(floor(y / 10) * 10 as int) as decade, {', '.join(f"round(avg(rating) filter (k = {k}), 6) as genre_{k}" for k in range(1, 11))}
from ratings join f using (movieId) join common using (genre) where y > 0 group by 1""")
def _(t):
    """Means of the ten commonest genres by rated films, genre_1 being the commonest.

    Columns are named by rank: genre names may differ only by case, which column names may not.
    """
    genres = C.exploded_genres(t.movies)
    # Ten rows at most, so their order is no large sort and the join sends them whole.
    common = J.genre_means(t.ratings, genres, ["genre"]).orderBy(F.desc("n"), "genre").limit(10)
    ranked = common.select("genre", F.row_number().over(Window.orderBy(F.desc("n"), "genre")).alias("k"))
    years = t.movies.select("movieId", C.decade(C.release_year("title")).alias("decade")).where("decade is not null")
    means = J.genre_means(t.ratings, years.join(genres.join(F.broadcast(ranked), "genre"), "movieId"), ["decade", "k"])
    wide = means.groupBy("decade").pivot("k", list(range(1, 11))).agg(F.max("mean_rating"))
    return wide.select("decade", *[r6(str(k)).alias(f"genre_{k}") for k in range(1, 11)])


@query("ag24_baskets", "transactions", """
select branch, strftime(ts, '%Y-%m-%d') as ds, string_agg(distinct product_line, ', ' order by product_line) as products from transactions group by 1, 2""")
def _(t):
    listed = A.baskets(t.transactions).groupBy("branch", "ds").agg(F.array_sort(F.collect_set("product_line")).alias("p"))
    return listed.select("branch", F.col("ds").cast("string").alias("ds"), F.array_join("p", ", ").alias("products"))


@query("ag25_wide_to_long", "transactions", """
with w as (select branch, round(avg(total), 4) as total, round(avg(quantity), 4) as quantity, round(avg(rating), 4) as rating from transactions group by 1)
select branch, measure, value from w unpivot (value for measure in (total, quantity, rating))""")
def _(t):
    w = t.transactions.groupBy("branch").agg(*[F.round(F.avg(c), 4).alias(c) for c in ("total", "quantity", "rating")])
    return w.unpivot(["branch"], ["total", "quantity", "rating"], "measure", "value")


@query("ag26_mean_relevance", "tags", f"""
with c as (select distinct userId, movieId, {NORMAL_SQL} as tag_clean from tags), n as (select movieId, tag_clean, count(*)::double as n from c where length(tag_clean) > 0 group by 1, 2),
r as (select *, n / max(n) over (partition by movieId) as relevance from n)
select tag_clean, round(avg(relevance), 6) as mean_relevance from r group by 1 order by round(avg(relevance), 6) desc, 1 limit 20""")
def _(t):
    from tablewright.operators.text import tag_relevance

    means = tag_relevance(tags_clean(t)).groupBy("tag_clean").agg(r6(F.avg("relevance")).alias("mean_relevance"))
    return means.orderBy(F.desc("mean_relevance"), "tag_clean").limit(20)
