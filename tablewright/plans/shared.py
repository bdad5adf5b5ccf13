"""Pieces used by several query sections, each as a frame and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators.recsys import popularity_topk
from tablewright.operators.text import clean_tags
from tablewright.operators.windows import leave_last_out
from tablewright.plans.columns import NORMAL_SQL
from tablewright.sources.tables import dropped, stored

YEAR_SQL = r"coalesce(cast(nullif(regexp_extract(title, '\((\d{4})\)', 1), '') as int), -1)"

SPLIT_SQL = """
s as (select userId, movieId, rating, rated_at, case when n < 10 then 0 when rn <= 2 then 2 when rn <= 4 then 1 else 0 end as split from
 (select *, row_number() over (partition by userId order by rated_at desc, movieId desc) as rn, count(*) over (partition by userId) as n from ratings)),
tr as (select * from s where split = 0), te as (select * from s where split = 2)"""

POP_SQL = """
pop as (select movieId, count(*) as n, row_number() over (order by count(*) desc, movieId) as pr from tr group by movieId),
cand as (select u.userId, pop.movieId, pop.n, row_number() over (partition by u.userId order by pop.pr) as rank
 from (select distinct userId from te) u cross join pop anti join tr on tr.userId = u.userId and tr.movieId = pop.movieId),
top as (select userId, movieId, cast(n as double) as score, cast(rank as int) as rank from cand where rank <= 10)"""

TAG_SQL = f"c as (select distinct userId, movieId, {NORMAL_SQL} as tag_clean from tags where length({NORMAL_SQL}) > 0)"
DEGREE_SQL = f"{TAG_SQL}, top as (select tag_clean, count(*) as n from c group by 1 order by n desc, tag_clean limit 80)"


def tags_clean(t) -> DataFrame:
    return stored(clean_tags(t.tags), "tags")


def split_ratings(t) -> DataFrame:
    ratings = t.kept("ratings")
    split = stored(leave_last_out(ratings), "split")
    dropped(ratings)
    return split


def pop_lists(t, k: int = 10) -> tuple[DataFrame, DataFrame]:
    """The split ratings and the popularity lists of the users with test ratings."""
    split = split_ratings(t)
    users = split.where("split = 2").select("userId").distinct()
    return split, popularity_topk(split.where("split = 0"), users, k)


def item_vectors(t) -> DataFrame:
    """`(movieId, embedding)`: item i takes the stored vector number i modulo their count."""
    n = t.embeddings.agg(F.count(F.lit(1))).scalar()
    films = t.movies.select("movieId", (F.col("movieId") % n).alias("vec_id"))
    return films.join(t.embeddings.select("vec_id", "embedding"), "vec_id").select("movieId", "embedding")


VECTOR_SQL = """nv as (select count(*) as nv from embeddings),
v as (select movieId, embedding::double[] as e from movies, nv join embeddings on vec_id = movieId % nv)"""
