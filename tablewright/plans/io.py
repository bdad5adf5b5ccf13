"""Queries for sources and sinks: a view is written in the format, read back and summed up."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.plans.columns import LINKS, r6
from tablewright.plans.registry import query
from tablewright.session import scratch_path
from tablewright.sources import schemas as S
from tablewright.sources import tables as IO
from tablewright.sources.files import path_labels
from tablewright.sources.audit import audit, read_text_columns
from tablewright.streaming.ingest import ingest_csv
from tablewright.streaming.rollup import add_events, close_days, rollup


def written_ratings(t, label):
    """The ratings view as a CSV file set with epoch seconds."""
    path = scratch_path(t.spark, label)
    seconds = F.unix_timestamp(F.col("rated_at").cast("timestamp"))
    IO.save_csv(t.ratings.select("userId", "movieId", "rating", seconds.alias("timestamp")), path)
    return path


RATINGS_BY_YEAR = """
select cast(year(rated_at) as int) as year, count(*) as n, count(distinct userId) as users, round(avg(rating), 6) as mean_rating
from ratings {} group by 1"""


def by_year(df):
    return df.groupBy(F.col("year").cast("int").alias("year")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("userId").alias("users"),
        r6(F.avg(F.col("rating").cast("double"))).alias("mean_rating"),
    )


@query("io01_csv_declared_schema", "ratings", RATINGS_BY_YEAR.format(""))
def _(t):
    return by_year(IO.read_ratings(t.spark, written_ratings(t, "io01")))


@query("io01_csv_tags", "tags", "select cast(year(tagged_at) as int) as year, count(*) as n, count(distinct tag) as tags from tags group by 1")
def _(t):
    path = scratch_path(t.spark, "io01-tags")
    seconds = F.unix_timestamp(F.col("tagged_at").cast("timestamp"))
    IO.save_csv(t.tags.select("userId", "movieId", "tag", seconds.alias("timestamp")), path)
    back = IO.read_tags(t.spark, path)
    return back.groupBy(F.year("tagged_at").alias("year")).agg(F.count("*").alias("n"), F.count_distinct("tag").alias("tags"))


@query("io01_csv_movies", "movies", "select movieId::bigint as movieId, title, genres from movies")
def _(t):
    path = IO.save_csv(t.movies, scratch_path(t.spark, "io01-movies"))
    return IO.read_csv(t.spark, path, S.MOVIES)


@query("io02_csv_mixed_schema", "buildings", """
select code_insee, count(*) as n, count(code_l331) as known_operator, count(distinct code_poste) as codes, round(avg(x), 6) as mean_x from buildings group by 1""")
def _(t):
    path = scratch_path(t.spark, "io02")
    IO.save_csv(t.buildings.select(F.xxhash64("imb_id").alias("row"), *t.buildings.columns), path)
    back = IO.read_buildings(t.spark, path)
    return back.groupBy("code_insee").agg(
        F.count("row_id").alias("n"), F.count("code_l331").alias("known_operator"),
        F.count_distinct("code_poste").alias("codes"), r6(F.avg("x")).alias("mean_x"),
    )


@query("io03_csv_separator", "houses", """
select pid, round(total_bsmt_sf, 6) as total_bsmt_sf, house_style, alley, year_built from houses""")
def _(t):
    path = scratch_path(t.spark, "io03")
    houses = t.houses.select("pid", "total_bsmt_sf", "house_style", "alley", "year_built")
    IO.save_csv(houses, path, sep=";")
    back = IO.read_csv(t.spark, path, houses.schema, sep=";")
    return back.withColumn("total_bsmt_sf", r6("total_bsmt_sf"))


@query("io04_csv_trimmed_header", "transactions", """
select branch, count(*) as n, round(sum(total), 4) as total from transactions group by 1""")
def _(t):
    path = scratch_path(t.spark, "io04")
    IO.save_csv(t.transactions.select(F.col("branch").alias(" branch"), F.col("total").alias("total ")), path)
    back = IO.read_trimmed_header(t.spark, path)
    return back.groupBy("branch").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("total"), 4).alias("total"))


@query("io04_schema_audit", "transactions", """
select c as "column", kind, n as n_values, case when kind = 'bigint' then 0 else n end as not_bigint, case when kind in ('bigint', 'double') then 0 else n end as not_double
from (select count(*) as n from transactions), (values ('invoice_id', 'bigint'), ('branch', 'string'), ('total', 'double'), ('sale_day', 'date')) v(c, kind)""")
def _(t):
    path = scratch_path(t.spark, "io04-audit")
    IO.save_csv(t.transactions.select("invoice_id", "branch", "total", F.to_date("ts").alias("sale_day")), path)
    return audit(read_text_columns(t.spark, path)).select("column", "kind", "n_values", "not_bigint", "not_double")


@query("io05_first_rows", "links", f"""
select link_id, {', '.join(f'round({c}, 6) as {c}' for c in LINKS)} from links order by link_id, {', '.join(LINKS)} limit 500""")
def _(t):
    return IO.first_rows(t.links, 500, "link_id", *LINKS).select("link_id", *[r6(c).alias(c) for c in LINKS])


@query("io06_parquet_skip_if_present", "ratings", """
select userId, count(*) as n, round(sum(rating), 2) as total from ratings group by userId""")
def _(t):
    path = scratch_path(t.spark, "io06")
    IO.save_parquet(t.ratings, path)
    IO.save_parquet(t.ratings.limit(0), path, mode="ignore")
    return t.spark.read.parquet(path).groupBy("userId").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("rating"), 2).alias("total")
    )


def yearly_table(t, label):
    path = scratch_path(t.spark, label)
    return IO.save_parquet(t.ratings.withColumn("year", F.year("rated_at")), path, partition_by="year")


@query("io07_year_partitions", "ratings", RATINGS_BY_YEAR.format(""))
def _(t):
    return by_year(t.spark.read.parquet(yearly_table(t, "io07")))


@query("io08_pruned_year_scan", "ratings", RATINGS_BY_YEAR.format("where year(rated_at) in (1998, 1999)"))
def _(t):
    return by_year(t.spark.read.parquet(yearly_table(t, "io08")).where(F.col("year").isin(1998, 1999)))


@query("io09_incremental_ingest", "ratings", RATINGS_BY_YEAR.format(""))
def _(t):
    target = scratch_path(t.spark, "io09-out")
    ingest_csv(t.spark, written_ratings(t, "io09"), S.RATINGS, target, IO.with_moment, partition_by="year")
    return by_year(t.spark.read.parquet(target))


@query("ag05_event_rollup", "", """
select cast(ts as date)::varchar as day, event_type as item, count(*) as n, round(avg(value), 6) as mean_value, round(stddev_pop(value), 5) as std_value, count(distinct user_id) as people
from events group by 1, 2""")
def _(t):
    """Three batches out of order, each taken up by a run of its own that goes on from the checkpoint."""
    source, target, progress = (scratch_path(t.spark, f"rollup-{n}") for n in ("in", "state", "progress"))
    events = t.events.select("event_id", "ts", "user_id", "event_type", "value")
    for part in (2, 0, 1):
        IO.save_parquet(events.where(F.col("event_id") % 3 == part), source, mode="append")
        add_events(t.spark, source, events.schema, target, progress, "ts", "event_type", "value", "user_id")
    found = rollup(t.spark, close_days(t.spark, target, scratch_path(t.spark, "rollup-closed")))
    return found.select(F.col("day").cast("string").alias("day"), "item", "n", r6("mean_value").alias("mean_value"), F.round("std_value", 5).alias("std_value"), "people")


@query("io10_result_csv_json", "ratings", """
select 'n_ratings' as metric, cast(count(*) as double) as value from ratings union all
select 'mean_rating', round(avg(rating), 6) from ratings""")
def _(t):
    row = t.ratings.agg(F.count(F.lit(1)).cast("double").alias("n_ratings"), r6(F.avg("rating")).alias("mean_rating"))
    long = row.unpivot([], ["n_ratings", "mean_rating"], "metric", "value")
    csv = IO.save_csv(long, scratch_path(t.spark, "io10-csv"))
    back = t.spark.read.schema("metric string, value double").csv(csv, header=True)
    return t.spark.read.schema("metric string, value double").json(IO.save_json(back, scratch_path(t.spark, "io10-json")))


@query("io11_file_manifest", "manifest", """
select split_part(filepath, '/', -3) as split, split_part(filepath, '/', -2) as label, cast(any_value(label_idx) as int) as label_idx, subtype, count(*) as n
from (select filepath, case when split_part(filepath, '/', -2) = 'PNEUMONIA' then 1 else 0 end as label_idx,
 case when split_part(filepath, '/', -2) = 'NORMAL' then 'normal' when contains(lower(split_part(filepath, '/', -1)), 'bacteria') then 'bacteria'
  when contains(lower(split_part(filepath, '/', -1)), 'virus') then 'virus' else 'unknown' end as subtype from manifest) group by 1, 2, 4""")
def _(t):
    labelled = path_labels(t.manifest)
    return labelled.groupBy("split", "label", "label_idx", "subtype").agg(F.count(F.lit(1)).alias("n"))
