"""Queries for projection, predicate, string, date, array and geometry operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.functions.scalars import (
    flag, norm, ratio, sum_present,
)
from tablewright.operators import columns as C
from tablewright.operators import geo as G
from tablewright.plans.registry import query

# The genre vocabulary of the film view: part name words and part types.
GENRES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
LINKS = ["osnr", "launch_power", "fiber_length", "dispersion", "nonlinear_effect"]


def r6(c):
    return F.round(c, 6)


@query("pr01_select_rename_drop", "ratings", "select userId as user_id, movieId as movie_id, rating from ratings")
def _(t):
    return C.pick(t.ratings, ["userId", "movieId", "rating"], {"userId": "user_id", "movieId": "movie_id"})


@query("pr02_in_bounds", "buildings",
       "select imb_id, round(x, 6) as x, round(y, 6) as y from buildings where x between -5 and 10 and y between 41 and 52")
def _(t):
    inside = C.in_bounds(t.buildings, {"x": (-5, 10), "y": (41, 52)})
    return inside.select("imb_id", r6("x").alias("x"), r6("y").alias("y"))


@query("pr03_members_or_null", "buildings", """
select imb_id, case when catg_loc_imb in ('individuel', 'entre 2 et 11', 'entre 12 et 35', 'entre 36 et 99', '100 et plus')
  then catg_loc_imb end as catg_loc_imb from buildings""")
def _(t):
    return C.members_or_null(t.buildings, "catg_loc_imb", C.BUILDING_CATEGORIES).select("imb_id", "catg_loc_imb")


def catalogue(t):
    stats = t.ratings.groupBy("movieId").agg(
        F.count(F.lit(1)).alias("rating_count"), F.avg("rating").alias("rating_mean")
    )
    tokens = F.split("genres", r"\|")
    films = t.movies.withColumn("year", C.release_year("title")).join(stats, "movieId", "left")
    keep = F.col("year").between(1960, 1999) & (F.coalesce("rating_count", F.lit(0)) >= 5)
    for g in ("PROMO", "red"):
        keep = keep & F.array_contains(tokens, g)
    return films.where(keep)


CATALOGUE_SQL = """
with stats as (select movieId, count(*) as rating_count, avg(rating) as rating_mean from ratings group by movieId),
films as (select m.*, cast(nullif(regexp_extract(title, '\\((\\d{4})\\)', 1), '') as int) as year, rating_count, rating_mean
  from movies m left join stats using (movieId)),
kept as (select * from films where year between 1960 and 1999 and coalesce(rating_count, 0) >= 5
  and list_contains(string_split(genres, '|'), 'PROMO') and list_contains(string_split(genres, '|'), 'red'))
"""


@query("pr04_catalogue_top", "ratings movies", CATALOGUE_SQL + """
select movieId, title, year, genres, rating_count, round(rating_mean, 6) as rating_mean
from kept order by rating_count desc, movieId limit 20""")
def _(t):
    return (
        catalogue(t).orderBy(F.desc("rating_count"), "movieId").limit(20)
        .select("movieId", "title", "year", "genres", "rating_count", r6("rating_mean").alias("rating_mean"))
    )


@query("pr04_catalogue_summary", "ratings movies", CATALOGUE_SQL + """
select count(*) as films, round(avg(rating_mean), 6) as mean_rating, cast(sum(rating_count) as bigint) as interactions from kept""")
def _(t):
    return catalogue(t).agg(
        F.count(F.lit(1)).alias("films"), r6(F.avg("rating_mean")).alias("mean_rating"),
        F.sum("rating_count").alias("interactions"),
    )


@query("pr06_basket_tier", "transactions", """
select invoice_id, line_no, case when total <= 100 then 'Low' when total <= 300 then 'Mid' when total <= 500 then 'High' else 'VeryHigh' end as tier
from transactions""")
def _(t):
    return t.transactions.select("invoice_id", "line_no", C.basket_tier("total").alias("tier"))


@query("pr07_flags", "transactions", """
select invoice_id, line_no, cast(gender = 'Female' as int) as is_female, cast(customer_type = 'BUILDING' as int) as is_member,
  cast(isodow(ts) >= 6 as int) as is_weekend from transactions""")
def _(t):
    return t.transactions.select(
        "invoice_id", "line_no", flag(F.col("gender") == "Female").alias("is_female"),
        flag(F.col("customer_type") == "BUILDING").alias("is_member"), flag(F.weekday("ts") >= 5).alias("is_weekend"),
    )


@query("pr07_lagging", "buildings",
       "select imb_id, case when imb_etat is not distinct from 'deploye' then 0 else 1 end as is_lagging from buildings")
def _(t):
    return C.with_lag_flag(t.buildings).select("imb_id", "is_lagging")


@query("pr08_presence_flags", "buildings", """
select imb_id, cast(batiment is not null as int) as has_building_label, cast(code_poste is not null as int) as has_postcode,
  coalesce(try_cast(num_voie as double), -1) as num_voie_filled, cast(catg_loc_imb = 'individuel' as int) as is_individuel,
  cast(catg_loc_imb in ('entre 36 et 99', '100 et plus') as int) as is_collective_large from buildings""")
def _(t):
    return C.building_flags(t.buildings).select(
        "imb_id", "has_building_label", "has_postcode", "num_voie_filled", "is_individuel", "is_collective_large"
    )


@query("pr09_guarded_ratios", "links", """
select link_id, round(osnr / (nonlinear_effect + 1e-6), 6) as osnr_over_nl, round(launch_power * fiber_length, 6) as power_x_length,
  round(dispersion * fiber_length, 6) as disp_x_length, round(nonlinear_effect * launch_power, 6) as nl_x_power,
  round(ln(1 + osnr), 6) as log_osnr, round(ln(1 + launch_power), 6) as log_power from links""")
def _(t):
    names = ["osnr_over_nl", "power_x_length", "disp_x_length", "nl_x_power", "log_osnr", "log_power"]
    return C.physics_columns(t.links).select("link_id", *[r6(n).alias(n) for n in names])


@query("pr09_unit_margin", "transactions",
       "select invoice_id, line_no, round(total / nullif(quantity, 0), 6) as unit_margin from transactions")
def _(t):
    return t.transactions.select("invoice_id", "line_no", r6(ratio("total", "quantity")).alias("unit_margin"))


PAIRS = [(a, b) for i, a in enumerate(LINKS) for b in LINKS[i:]]


@query("pr10_pairwise_products", "links",
       "select link_id, " + ", ".join(f"round({a} * {b}, 6) as {a}_x_{b}" for a, b in PAIRS) + " from links")
def _(t):
    wide = C.pairwise_products(t.links.select("link_id", *LINKS), LINKS)
    return wide.select("link_id", *[r6(f"{a}_x_{b}").alias(f"{a}_x_{b}") for a, b in PAIRS])


@query("pr11_money_columns", "transactions", """
select invoice_id, line_no, round_even(unit_price * quantity * 1.05::double, 4) as total, round_even(unit_price * quantity, 4) as cogs,
  round_even(round_even(unit_price * quantity, 4) * 0.05::double, 4) as tax from transactions""")
def _(t):
    return C.money_columns(t.transactions).select("invoice_id", "line_no", "total", "cogs", "tax")


@query("pr12_row_sum", "houses",
       "select pid, round(coalesce(total_bsmt_sf, 0) + coalesce(first_flr_sf, 0), 6) as total_sf from houses")
def _(t):
    houses = t.houses
    names = ["total_bsmt_sf", "first_flr_sf", "second_flr_sf"]
    return houses.select("pid", r6(sum_present(houses, names)).alias("total_sf"))


@query("str01_trim_strings", "buildings", """
select imb_id, nullif(trim(nom_com), '') as nom_com, nullif(trim(num_voie), '') as num_voie, nullif(trim(batiment), '') as batiment from buildings""")
def _(t):
    return C.trim_strings(t.buildings.select("imb_id", "nom_com", "num_voie", "batiment"))


@query("str02_postcode", "buildings", """
select imb_id, case when length(d) < 5 then lpad(d, 5, '0') else d end as code_poste
from (select imb_id, cast(cast(trunc(try_cast(code_poste as double)) as bigint) as varchar) as d from buildings)""")
def _(t):
    return t.buildings.select("imb_id", C.postcode("code_poste").alias("code_poste"))


@query("str03_text_to_boolean", "buildings", """
select imb_id, case when lower(s) in ('true', 't') then 1 when lower(s) in ('false', 'f') then 0 end as complete
from (select imb_id, case code_l331 when 'A' then 'True' when 'N' then 'f' else code_l331 end as s from buildings)""")
def _(t):
    raw = F.when(F.col("code_l331") == "A", "True").when(F.col("code_l331") == "N", "f").otherwise(F.col("code_l331"))
    return t.buildings.select("imb_id", C.text_to_boolean(raw).cast("int").alias("complete"))


@query("str04_release_year", "movies",
       r"select movieId, coalesce(cast(nullif(regexp_extract(title, '\((\d{4})\)', 1), '') as int), -1) as release_year from movies")
def _(t):
    return t.movies.select("movieId", C.release_year("title", missing=-1).alias("release_year"))


NORMAL_SQL = r"trim(regexp_replace(regexp_replace(lower(trim(tag)), '[^a-z0-9\s\-'']', ' ', 'g'), '\s+', ' ', 'g'))"


@query("str05_normalised_tag", "tags", f"""
select userId, movieId, tag_clean, count(*) as n from (select userId, movieId, {NORMAL_SQL} as tag_clean from tags)
where length(tag_clean) > 0 group by all""")
def _(t):
    clean = t.tags.select("userId", "movieId", C.normalised_tag("tag").alias("tag_clean"))
    return clean.where(F.length("tag_clean") > 0).groupBy("userId", "movieId", "tag_clean").agg(F.count(F.lit(1)).alias("n"))


@query("str06_genre_flags", "movies", "select movieId, "
       + ", ".join(f"cast(list_contains(string_split(genres, '|'), '{g}') as int) as g_{g}" for g in GENRES) + " from movies")
def _(t):
    return t.movies.select("movieId", *C.genre_flags(GENRES))


@query("str07_substring", "movies", "select movieId, title from movies where contains(title, 'ring')")
def _(t):
    return t.movies.where(F.col("title").contains("ring")).select("movieId", "title")


SUBTYPE_SQL = """case when split_part(filepath, '/', -2) = 'NORMAL' then 'normal' when contains(name, 'bacteria') then 'bacteria'
  when contains(name, 'virus') then 'virus' else 'unknown' end"""


@query("str08_file_subtype", "manifest", f"""
select filepath, {SUBTYPE_SQL} as subtype from (select filepath, lower(split_part(filepath, '/', -1)) as name from manifest)""")
def _(t):
    from tablewright.sources.files import file_subtype

    return t.manifest.select("filepath", file_subtype("filepath").alias("subtype"))


@query("dt01_parsed_date", "transactions_raw", """
select invoice_id, line_no, strftime(d, '%Y-%m-%d') as sale_date from
 (select *, try_strptime(date_str, '%m/%d/%y') as d from transactions_raw) where d is not null""")
def _(t):
    dated = t.transactions_raw.withColumn("d", C.parsed_date("date_str")).where(F.col("d").isNotNull())
    return dated.select("invoice_id", "line_no", F.col("d").cast("string").alias("sale_date"))


@query("dt02_parsed_moment", "transactions_raw", """
select invoice_id, line_no, strftime(try_strptime(date_str || ' ' || time_str, '%m/%d/%y %H:%M'), '%Y-%m-%d %H:%M') as moment from transactions_raw""")
def _(t):
    return t.transactions_raw.select(
        "invoice_id", "line_no", F.date_format(C.parsed_moment("date_str", "time_str"), "yyyy-MM-dd HH:mm").alias("moment")
    )


@query("dt03_epoch", "ratings", """
select userId, movieId, strftime(to_timestamp(s)::timestamp, '%Y-%m-%d %H:%M:%S') as rated_at, cast(year(to_timestamp(s)) as int) as year
from (select userId, movieId, epoch(rated_at)::bigint as s from ratings)""")
def _(t):
    seconds = F.unix_timestamp(F.col("rated_at").cast("timestamp"))
    epoch = t.ratings.select("userId", "movieId", seconds.alias("s"))
    moment = F.timestamp_seconds("s")
    return epoch.select(
        "userId", "movieId", F.date_format(moment, "yyyy-MM-dd HH:mm:ss").alias("rated_at"), F.year(moment).alias("year")
    )


@query("dt04_calendar", "", """
select event_id, cast(hour(ts) as int) as hour, cast(isodow(ts) - 1 as int) as dow, dayname(ts) as day_name, cast(month(ts) as int) as month,
 monthname(ts) as month_name, cast(isodow(ts) >= 6 as int) as is_weekend from events""")
def _(t):
    return C.calendar_columns(t.events.select("event_id", "ts"), "ts").drop("ts")


@query("dt05_tenure", "ratings", """
select userId, cast(floor((epoch(max(rated_at)) - epoch(min(rated_at))) / 86400) as int) as tenure_days from ratings group by userId""")
def _(t):
    spans = t.ratings.groupBy("userId").agg(F.min("rated_at").alias("a"), F.max("rated_at").alias("b"))
    return spans.select("userId", C.whole_days("a", "b").alias("tenure_days"))


@query("dt05_house_age", "houses", "select pid, yr_sold - year_built as house_age, cast(year_remod <> year_built as int) as is_remodeled from houses")
def _(t):
    return t.houses.select(
        "pid", (F.col("yr_sold") - F.col("year_built")).alias("house_age"),
        flag(F.col("year_remod") != F.col("year_built")).alias("is_remodeled"),
    )


@query("dt06_decade", "movies", r"""
select movieId, cast(floor(y / 10) * 10 as int) as decade from
 (select movieId, coalesce(cast(nullif(regexp_extract(title, '\((\d{4})\)', 1), '') as int), -1) as y from movies)""")
def _(t):
    return t.movies.select("movieId", C.decade(C.release_year("title", missing=-1)).alias("decade"))


@query("dt07_month_key", "", """
select strftime(o_orderdate, '%Y-%m') as month, count(*) as n, round(sum(o_totalprice), 2) as revenue from orders group by 1""")
def _(t):
    return t.orders.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("revenue")
    )


@query("arr01_exploded_genres", "movies",
       "select movieId, genre from (select movieId, unnest(string_split(genres, '|')) as genre from movies) where genre <> '(no genres listed)'")
def _(t):
    return C.exploded_genres(t.movies)


@query("arr02_genre_count_histogram", "movies",
       "select cast(len(string_split(genres, '|')) as int) as n_genre, count(*) as n from movies group by 1")
def _(t):
    return t.movies.groupBy(F.size(F.split("genres", r"\|")).alias("n_genre")).agg(F.count(F.lit(1)).alias("n"))


@query("arr03_vector_norm", "", """
select vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x : x::double * x::double))), 6) as norm,
 cast(len(list_filter(embedding, lambda x : x > 0.1::float)) as int) as active from embeddings""")
def _(t):
    return t.embeddings.select(
        "vec_id", r6(norm("embedding")).alias("norm"),
        F.size(F.filter("embedding", lambda x: x > F.lit(0.1).cast("float"))).alias("active"),
    )


@query("geo01_crs", "buildings", """
select case when (select max(abs(x)) < 180 and max(abs(y)) < 90 from buildings) then 'EPSG:4326' else 'EPSG:2154' end as crs, count(*) as n from buildings""")
def _(t):
    b = t.buildings
    return b.groupBy(G.crs(b).alias("crs")).agg(F.count(F.lit(1)).alias("n"))


METRES = "(select imb_id, 700000 + (x - 3) * 70000e0 as mx, 6600000 + (y - 46.5e0) * 111000e0 as my from buildings)"


def _lambert_sql():
    e, n, c = G.ECCENTRICITY, G.CONE_EXPONENT, G.CONE_CONSTANT
    text = f"select *, mx - 700000 as dx, {G.POLE_NORTHING}::double - my as dy from {METRES}"
    text = f"select *, -ln(sqrt(dx * dx + dy * dy) / {c}::double) / {n}::double as iso, degrees(atan(dx / dy) / {n}::double) + 3 as lon from ({text})"
    text = f"select imb_id, lon, iso, 2 * atan(exp(iso)) - pi() / 2 as phi from ({text})"
    for _ in range(6):
        text = (f"select imb_id, lon, iso, 2 * atan(pow((1 + {e}::double * sin(phi)) / (1 - {e}::double * sin(phi)), {e}::double / 2) * exp(iso)) - pi() / 2 as phi"
                f" from ({text})")
    return f"select imb_id, round(lon, 6) as lon, round(degrees(phi), 6) as lat from ({text})"


@query("geo02_lambert93", "buildings", _lambert_sql())
def _(t):
    metres = t.buildings.select(
        "imb_id", (700000 + (F.col("x") - 3) * 70000.0).alias("x"), (6600000 + (F.col("y") - 46.5) * 111000.0).alias("y")
    )
    return G.with_degrees(metres).select("imb_id", r6("lon").alias("lon"), r6("lat").alias("lat"))


@query("geo03_haversine", "buildings", """
select imb_id, round(2 * 6371.0::double * asin(sqrt(pow(sin(radians(48.8566::double - y) / 2), 2) + cos(radians(y)) * cos(radians(48.8566::double))
 * pow(sin(radians(2.3522::double - x) / 2), 2))), 4) as km from buildings""")
def _(t):
    km = G.haversine_km(F.col("y"), F.col("x"), F.lit(48.8566), F.lit(2.3522))
    return t.buildings.select("imb_id", F.round(km, 4).alias("km"))


def located(t):
    return C.with_lag_flag(G.with_degrees(C.trim_strings(t.buildings)))


@query("geo04_grid_cells", "buildings", """
select cast(floor(x / 0.5::double) as bigint)::varchar || ':' || cast(floor(y / 0.5::double) as bigint)::varchar as cell, count(*) as n,
 round(avg(case when imb_etat is not distinct from 'deploye' then 0 else 1 end), 6) as lag_mean from buildings group by 1""")
def _(t):
    cells = G.cell_summary(located(t), 0.5, "is_lagging")
    return cells.select("cell", "n", r6("mean_value").alias("lag_mean"))


@query("geo05_centroids", "buildings", """
select code_insee, min(trim(nom_com)) as nom_com, round(avg(x), 6) as lon, round(avg(y), 6) as lat, count(imb_id) as n_buildings
from buildings group by code_insee""")
def _(t):
    c = G.centroids(located(t))
    return c.select("code_insee", "nom_com", r6("lon").alias("lon"), r6("lat").alias("lat"), "n_buildings")


@query("geo06_bounding_box", "buildings", """
select round(min(x) - 0.01::double, 6) as min_lon, round(min(y) - 0.01::double, 6) as min_lat, round(max(x) + 0.01::double, 6) as max_lon,
 round(max(y) + 0.01::double, 6) as max_lat from buildings""")
def _(t):
    box = G.bounding_box(located(t))
    return box.select(*[r6(c).alias(c) for c in box.columns])


@query("geo07_morans_i", "buildings", """
with areas as (select code_insee, avg(x) as lon, avg(y) as lat, avg(case when imb_etat is not distinct from 'deploye' then 0 else 1 end) as rate
  from buildings group by code_insee),
pairs as (select a.code_insee, b.code_insee as nb, row_number() over (partition by a.code_insee
  order by (a.lon - b.lon) * (a.lon - b.lon) + (a.lat - b.lat) * (a.lat - b.lat), b.code_insee) as rn
  from areas a join areas b on a.code_insee <> b.code_insee),
z as (select code_insee, rate - avg(rate) over () as z from areas),
lagged as (select p.code_insee, avg(z.z) as lag from pairs p join z on z.code_insee = p.nb where rn <= 5 group by p.code_insee)
select round(sum(z * lag) / sum(z * z), 4) as morans_i, count(*) as n_areas from z join lagged using (code_insee)""")
def _(t):
    from tablewright.operators.retrieval import nearest_points

    spots = located(t)
    areas = spots.groupBy("code_insee").agg(
        F.avg("lon").alias("lon"), F.avg("lat").alias("lat"), F.avg("is_lagging").alias("rate")
    )
    near = nearest_points(areas, "code_insee", ["lon", "lat"], 5)
    near = near.select("code_insee", F.col("neighbour"))
    result = G.morans_i(areas, near, "code_insee", "rate")
    return result.select(F.round("morans_i", 4).alias("morans_i"), "n_areas")
