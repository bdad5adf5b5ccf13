"""Queries for missing values and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.functions.ladders import melt
from tablewright.functions.scalars import numeric_columns
from tablewright.operators import missing as M
from tablewright.operators import profiling as P
from tablewright.operators.columns import with_lag_flag
from tablewright.plans.columns import LINKS, r6
from tablewright.plans.registry import query

HOUSE = ["pid", "total_bsmt_sf", "first_flr_sf", "pool_area", "house_style", "alley"]


@query("mv01_null_audit", "houses", """
with c as (select count(*) as n, """ + ", ".join(f"count(*) filter ({c} is null) as {c}" for c in HOUSE) + """ from houses)
select "column", missing, round(missing * 100.0::double / n, 6) as percent from c unpivot (missing for "column" in (""" + ", ".join(HOUSE) + """))
where missing > 0""")
def _(t):
    audit = M.null_audit(t.houses)
    return audit.select("column", "missing", r6("percent").alias("percent"))


@query("mv02_drop_sparse", "houses", """
select pid, round(total_bsmt_sf, 6) as total_bsmt_sf, first_flr_sf, house_style, constant_col, year_built, year_remod, yr_sold,
 round(sale_price, 6) as sale_price from houses""")
def _(t):
    kept = M.drop_sparse(t.houses, 0.5, 0.4)
    return kept.withColumn("total_bsmt_sf", r6("total_bsmt_sf")).withColumn("sale_price", r6("sale_price"))


@query("mv03_impute_median", "houses", """
select pid, round(coalesce(total_bsmt_sf, (select median(total_bsmt_sf) from houses)), 6) as total_bsmt_sf,
 round(coalesce(first_flr_sf, (select median(first_flr_sf) from houses)), 6) as first_flr_sf,
 round(coalesce(pool_area, (select median(pool_area) from houses)), 6) as pool_area from houses""")
def _(t):
    cols = ["total_bsmt_sf", "first_flr_sf", "pool_area"]
    return M.impute_median(t.houses.select("pid", *cols), cols).select("pid", *[r6(c).alias(c) for c in cols])


@query("mv04_impute_mode", "houses", """
select pid, coalesce(house_style, (select house_style from houses where house_style is not null group by 1 order by count(*) desc, 1 limit 1)) as house_style,
 coalesce(alley, (select alley from houses where alley is not null group by 1 order by count(*) desc, 1 limit 1)) as alley from houses""")
def _(t):
    return M.impute_mode(t.houses.select("pid", "house_style", "alley"))


@query("mv05_drop_null_rows", "houses",
       "select pid from houses where total_bsmt_sf is not null and house_style is not null")
def _(t):
    return t.houses.dropna(subset=["total_bsmt_sf", "house_style"]).select("pid")


@query("mv05_drop_any_null", "houses", "select pid from houses where " + " and ".join(f"{c} is not null" for c in HOUSE))
def _(t):
    return t.houses.dropna("any").select("pid")


@query("mv06_clean_transactions", "transactions_raw", """
with kept as (select * from transactions_raw where product_line is not null),
filled as (select invoice_id, line_no, product_line,
  coalesce(customer_type, (select customer_type from kept where customer_type is not null group by 1 order by count(*) desc, 1 limit 1)) as customer_type,
  coalesce(unit_price, (select median(unit_price) from kept)) as unit_price, coalesce(quantity, (select median(quantity) from kept)) as quantity,
  try_strptime(date_str, '%m/%d/%y') as d, try_strptime(date_str || ' ' || time_str, '%m/%d/%y %H:%M') as m from kept)
select invoice_id, line_no, product_line, customer_type, round(unit_price, 6) as unit_price, quantity,
 round_even(unit_price * quantity * 1.05::double, 4) as total, round_even(unit_price * quantity, 4) as cogs,
 round_even(round_even(unit_price * quantity, 4) * 0.05::double, 4) as tax, strftime(d, '%Y-%m-%d') as sale_date,
 strftime(m, '%Y-%m-%d %H:%M') as moment from filled where d is not null""")
def _(t):
    return M.clean_transactions(t.transactions_raw).select(
        "invoice_id", "line_no", "product_line", "customer_type", r6("unit_price").alias("unit_price"), "quantity",
        "total", "cogs", "tax", F.col("sale_date").cast("string").alias("sale_date"),
        F.date_format("moment", "yyyy-MM-dd HH:mm").alias("moment"),
    )


CLEAN_BUILDINGS_SQL = """
select imb_id, x, y, nullif(trim(code_insee), '') as code_insee, nullif(trim(nom_com), '') as nom_com, nullif(trim(pm_ref), '') as pm_ref,
 nullif(trim(imb_etat), '') as imb_etat, nullif(trim(code_l331), '') as code_l331,
 lpad(cast(cast(code_poste as double)::bigint as varchar), 5, '0') as code_poste, nullif(trim(num_voie), '') as num_voie, nullif(trim(batiment), '') as batiment,
 case when imb_etat is not distinct from 'deploye' then 0 else 1 end as is_lagging,
 case when catg_loc_imb in ('individuel', 'entre 2 et 11', 'entre 12 et 35', 'entre 36 et 99', '100 et plus') then catg_loc_imb end as catg_loc_imb
from buildings where x between -5 and 10 and y between 41 and 52"""


@query("mv07_clean_buildings", "buildings", f"select * exclude (x, y), round(x, 6) as x, round(y, 6) as y from ({CLEAN_BUILDINGS_SQL})")
def _(t):
    return M.clean_buildings(t.buildings).withColumn("x", r6("x")).withColumn("y", r6("y"))


@query("mv07_clean_building_dates", "buildings", """
select imb_id, case num_voie when '' then null when '1' then date '2021-03-04' when '2' then null else cast('2021-0' || num_voie || '-15' as date) end as date_completude,
 case when batiment = 'A' then 'true' when num_voie = '3' then null else 'false' end as date_completude_manquante
from buildings where x between -5 and 10 and y between 41 and 52""")
def _(t):
    n = F.col("num_voie")
    day = F.when(n == "1", "3/4/2021").when(n == "2", "2021-02-30").when(n == "", "n/a").otherwise(F.concat(F.lit("2021-0"), n, F.lit("-15")))
    dated = t.buildings.withColumns({"date_completude": day, "date_completude_manquante": F.when(F.col("batiment") == "A", "T").when(n == "3", "?").otherwise("False")})
    return M.clean_buildings(dated).select("imb_id", "date_completude", F.col("date_completude_manquante").cast("string").alias("date_completude_manquante"))


@query("mv09_finite_drop_constant", "houses", """
select pid, round(coalesce(total_bsmt_sf, 0), 6) as total_bsmt_sf, coalesce(first_flr_sf, 0) as first_flr_sf, coalesce(pool_area, 0) as pool_area,
 cast(year_built as double) as year_built, cast(year_remod as double) as year_remod, round(sale_price, 6) as sale_price from houses""")
def _(t):
    houses = t.houses
    numbers = [c for c in numeric_columns(houses) if c != "pid"]
    out = M.drop_constant(M.finite_numbers(houses.select("pid", *numbers), numbers))
    return out.withColumn("total_bsmt_sf", r6("total_bsmt_sf")).withColumn("sale_price", r6("sale_price"))


def _describe_sql(c):
    return (f"select '{c}' as \"column\", count({c}) as count, round(avg({c}), 6) as mean, round(stddev({c}), 6) as std, round(min({c}), 6) as min, "
            f"round(quantile_cont({c}, 0.25), 6) as q25, round(median({c}), 6) as q50, round(quantile_cont({c}, 0.75), 6) as q75, "
            f"round(max({c}), 6) as max from links")


@query("pf01_describe_numeric", "links", " union all ".join(_describe_sql(c) for c in [*LINKS, "q_factor"]))
def _(t):
    d = P.describe_numeric(t.links, [*LINKS, "q_factor"])
    return d.select("column", "count", *[r6(c).alias(c) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")])


def _text_sql(c):
    return (f"select '{c}' as \"column\", cast(sum(n) as bigint) as count, count(*) as \"unique\", min_by(v, (-n, v)) as top, max(n) as freq "
            f"from (select {c} as v, count(*) as n from transactions where {c} is not null group by 1)")


@query("pf02_describe_text", "transactions", " union all ".join(_text_sql(c) for c in ("branch", "city", "gender", "payment", "product_line")))
def _(t):
    return P.describe_text(t.transactions, ["branch", "city", "gender", "payment", "product_line"])


@query("pf03_category_counts", "buildings", """
select coalesce(imb_etat, 'missing') as imb_etat, count(*) as n, round(count(*) * 100.0::double / sum(count(*)) over (), 6) as pct
from buildings group by 1""")
def _(t):
    return P.category_counts(t.buildings, "imb_etat").withColumn("pct", r6("pct"))


@query("pf04_duplicate_rows", "links", """
select cast(sum(n - 1) as bigint) as duplicates, cast(sum(n) as bigint) as n_rows from
 (select count(*) as n from links group by """ + ", ".join(f"round({c}, 9)" for c in LINKS) + ")")
def _(t):
    return P.duplicate_rows(t.links.select(*[F.round(c, 9).alias(c) for c in LINKS]))


@query("pf05_headline", "ratings", """
select count(*) as n_ratings, count(distinct userId) as n_users, count(distinct movieId) as n_items, cast(min(year(rated_at)) as int) as year_min,
 cast(max(year(rated_at)) as int) as year_max, round(count(*) / (count(distinct userId) * count(distinct movieId)), 6) as density,
 round(1 - count(*) / (count(distinct userId) * count(distinct movieId)), 6) as sparsity from ratings""")
def _(t):
    return P.interaction_headline(t.ratings).withColumn("density", r6("density")).withColumn("sparsity", r6("sparsity"))


@query("pf06_skewness", "links", " union all ".join(
    f"select '{c}' as \"column\", round(skewness({c}), 6) as skew from links" for c in LINKS))
def _(t):
    return melt(t.links, LINKS).groupBy("column").agg(r6(P.corrected_skewness("value")).alias("skew"))


@query("pf07_histogram", "ratings", """
with u as (select userId, count(*) as n from ratings group by userId)
select cast(least(floor((least(greatest(n, 1), 100) - 1) * 80 / 99), 79) as int) as bin, count(*) as n from u group by 1""")
def _(t):
    counts = t.ratings.groupBy("userId").agg(F.count(F.lit(1)).alias("n"))
    return P.histogram(counts.withColumnRenamed("n", "ratings"), "ratings", 1, 100, 80)


@query("pf08_histogram_2d", "ratings", """
with u as (select log10(count(*)) as x, avg(rating) as y from ratings group by movieId), m as (select max(x) as top from u)
select cast(least(floor(x * 40 / top), 39) as int) as x_bin, cast(least(floor((y - 0.5::double) * 40 / 4.5::double), 39) as int) as y_bin, count(*) as n
from u, m where y between 0.5 and 5 group by 1, 2""")
def _(t):
    stats = t.ratings.groupBy("movieId").agg(
        F.log10(F.count(F.lit(1)).cast("double")).alias("x"), F.avg("rating").alias("y")
    )
    return P.histogram_2d(stats, "x", "y", (0.0, stats.agg(F.max("x")).scalar()), (0.5, 5.0))


@query("pf09_kernel_density", "ratings", """
with u as (select case when count(*) >= 40 then 'heavy' else 'casual' end as segment, avg(rating) as v from ratings group by userId),
s as (select segment, count(*) as n, stddev(v) * pow(count(*), -0.2::double) as h from u group by segment),
g as (select cast(i as int) as point, 0.5::double + i * 0.1::double as x from range(46) t(i))
select segment, point, round(sum(exp(-pow((x - v) / h, 2) / 2) / (n * h * sqrt(2 * pi()))), 6) as density, round(any_value(x), 6) as x
from u join s using (segment), g group by segment, point""")
def _(t):
    users = t.ratings.groupBy("userId").agg(F.count(F.lit(1)).alias("n"), F.avg("rating").alias("v"))
    users = users.select(F.when(F.col("n") >= 40, "heavy").otherwise("casual").alias("segment"), "v")
    d = P.kernel_density(users, "segment", "v", 0.5, 5.0, 46)
    return d.select("segment", "point", r6("density").alias("density"), r6("x").alias("x"))


@query("pf10_box_statistics", "transactions", """
with q as (select branch, quantile_cont(total, 0.25) as q25, median(total) as q50, quantile_cont(total, 0.75) as q75 from transactions group by branch),
f as (select *, q25 - (q75 - q25) * 1.5 as lo, q75 + (q75 - q25) * 1.5 as hi from q)
select branch, round(any_value(q25), 4) as q25, round(any_value(q50), 4) as q50, round(any_value(q75), 4) as q75,
 round(min(total) filter (total between lo and hi), 4) as whisker_low, round(max(total) filter (total between lo and hi), 4) as whisker_high,
 count(*) filter (not total between lo and hi) as outliers from transactions join f using (branch) group by branch""")
def _(t):
    b = P.box_statistics(t.transactions, "branch", "total")
    names = ["q25", "q50", "q75", "whisker_low", "whisker_high"]
    return b.select("branch", *[F.round(c, 4).alias(c) for c in names], "outliers")


@query("pf11_violations", "buildings", """
with b as (select *, case when imb_etat is not distinct from 'deploye' then 0 else 1 end as is_lagging from buildings)
select 'known_state' as rule, count(*) filter (imb_etat is null) as violations from b
union all select 'flag_matches_state', count(*) filter ((is_lagging = 1) <> (imb_etat is distinct from 'deploye')) from b
union all select 'in_bounds', count(*) filter (not (x between -5 and 10 and y between 41 and 52)) from b""")
def _(t):
    b = with_lag_flag(t.buildings)
    return P.violations(b, {
        "known_state": F.col("imb_etat").isNotNull(),
        "flag_matches_state": (F.col("is_lagging") == 1) == ~F.col("imb_etat").eqNullSafe("deploye"),
        "in_bounds": F.col("x").between(-5, 10) & F.col("y").between(41, 52),
    })
