"""Queries for recommenders and vector retrieval."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.operators import recsys as K
from tablewright.operators import retrieval as V
from tablewright.operators import windows as W
from tablewright.operators.text import relevance_vectors, tag_relevance
from tablewright.plans.columns import r6
from tablewright.plans.registry import query
from tablewright.plans.shared import (
    POP_SQL, SPLIT_SQL, TAG_SQL, VECTOR_SQL, item_vectors, pop_lists, split_ratings, tags_clean,
)
from tablewright.plans.views import BUCKET
from tablewright.sources.tables import dropped, stored



def unit_sql(v):
    return f"list_transform({v}, lambda x : x / sqrt(list_sum(list_transform({v}, lambda y : y * y))))"


@query("rc01_interactions", "ratings", """
with u as (select userId, cast(row_number() over (order by userId) - 1 as int) as user_index from (select distinct userId from ratings)),
i as (select movieId, cast(row_number() over (order by movieId) - 1 as int) as item_index from (select distinct movieId from ratings))
select userId, movieId, rating, user_index, item_index from ratings join u using (userId) join i using (movieId)""")
def _(t):
    return K.interactions(t.ratings)


@query("rc02_mean_predictors", "ratings", f"""
with {SPLIT_SQL}, mu as (select avg(rating) as mu from tr), ub as (select userId, avg(rating) as u from tr group by 1), ib as (select movieId, avg(rating) as i from tr group by 1)
select te.userId, te.movieId, rating, round(mu, 6) as global_mean, round(coalesce(u, mu), 6) as user_mean, round(coalesce(i, mu), 6) as item_mean
from te left join ub using (userId) left join ib using (movieId), mu""")
def _(t):
    split = split_ratings(t)
    test = split.where("split = 2").select("userId", "movieId", "rating")
    p = K.mean_predictions(split.where("split = 0"), test)
    return p.select("userId", "movieId", "rating", *[r6(c).alias(c) for c in ("global_mean", "user_mean", "item_mean")])


@query("rc03_popularity_topk", "ratings", f"with {SPLIT_SQL}, {POP_SQL} select userId, movieId, score, rank from top")
def _(t):
    return pop_lists(t)[1]


def knn_sql(row, col):
    return f"""
nm as (select {row} as a, sqrt(sum(rating * rating)) as l from tr group by 1),
sim as (select x.{row} as a, y.{row} as b, round(sum(x.rating * y.rating) / (any_value(p.l) * any_value(q.l)), 9) as sim from tr x join tr y on x.{col} = y.{col} and x.{row} <> y.{row}
 join nm p on p.a = x.{row} join nm q on q.a = y.{row} group by 1, 2),
nb as (select a, b, sim from (select *, row_number() over (partition by a order by sim desc, b) as rn from sim) where rn <= 50)"""


FINISH_SQL = """
best as (select userId, movieId, score, row_number() over (partition by userId order by round(score, 9) desc, movieId) as rank from sc
 anti join tr on tr.userId = sc.userId and tr.movieId = sc.movieId)
select userId, movieId, round(score, 6) as score, cast(rank as int) as rank from best where rank <= 10"""


def trained(t):
    return split_ratings(t).where("split = 0").select("userId", "movieId", "rating")


def rounded(df):
    return df.select("userId", "movieId", r6("score").alias("score"), "rank")


@query("rc04_item_neighbours", "ratings", f"with {SPLIT_SQL}, {knn_sql('movieId', 'userId')} select a as \"movieId\", b as neighbour, round(sim, 6) as sim from nb")
def _(t):
    near = K.cosine_neighbours(trained(t), "movieId", "userId", 50)
    return near.withColumn("sim", r6(F.round("sim", 9)))


@query("rc04_item_knn_topk", "ratings", f"""
with {SPLIT_SQL}, {knn_sql('movieId', 'userId')},
sc as (select userId, b as movieId, sum(sim * rating) / sum(abs(sim)) as score from tr join nb on nb.a = tr.movieId group by 1, 2), {FINISH_SQL}""")
def _(t):
    train = trained(t)
    near = K.cosine_neighbours(train, "movieId", "userId", 50).withColumn("sim", F.round("sim", 9))
    return rounded(K.item_knn_topk(train, near))


@query("rc04_item_knn_predictions", "ratings", f"""
with {SPLIT_SQL}, {knn_sql('movieId', 'userId')},
sc as (select te.userId, te.movieId, sum(sim * tr.rating) / sum(abs(sim)) as p from te join nb on nb.b = te.movieId join tr on tr.userId = te.userId and tr.movieId = nb.a group by 1, 2)
select te.userId, te.movieId, rating, round(coalesce(p, 3.5::double), 6) as prediction from te left join sc on sc.userId = te.userId and sc.movieId = te.movieId""")
def _(t):
    split = split_ratings(t)
    train = split.where("split = 0").select("userId", "movieId", "rating")
    near = K.cosine_neighbours(train, "movieId", "userId", 50).withColumn("sim", F.round("sim", 9))
    p = K.item_knn_predictions(train, near, split.where("split = 2").select("userId", "movieId", "rating"))
    return p.withColumn("prediction", r6("prediction"))


@query("rc05_user_knn_topk", "ratings", f"""
with {SPLIT_SQL}, {knn_sql('userId', 'movieId')},
sc as (select nb.a as userId, movieId, sum(sim * rating) / sum(abs(sim)) as score from nb join tr on tr.userId = nb.b group by 1, 2), {FINISH_SQL}""")
def _(t):
    train = trained(t)
    near = K.cosine_neighbours(train, "userId", "movieId", 50).withColumn("sim", F.round("sim", 9))
    return rounded(K.user_knn_topk(train, near))


@query("rc06_bias_predictor", "ratings", f"""
with {SPLIT_SQL}, mu as (select avg(rating) as mu from tr), ub as (select userId, avg(rating) as u from tr group by 1), ib as (select movieId, avg(rating) as i from tr group by 1)
select te.userId, te.movieId, round(mu + coalesce(u - mu, 0) + coalesce(i - mu, 0), 6) as bias from te left join ub using (userId) left join ib using (movieId), mu""")
def _(t):
    split = split_ratings(t)
    p = K.mean_predictions(split.where("split = 0"), split.where("split = 2").select("userId", "movieId"))
    return p.select("userId", "movieId", r6("bias").alias("bias"))


PROFILE_SQL = f"""{VECTOR_SQL}, un as (select movieId, {unit_sql('e')} as e from v),
pc as (select userId, p, sum(rating * x) as s from (select userId, rating, unnest(e) as x, generate_subscripts(e, 1) as p from tr join un using (movieId)) group by 1, 2),
pr as (select userId, {unit_sql('list(s order by p)')} as f from pc group by 1)"""


# Films without genres have no vector here: they score -1.
GENRE_VECTOR_SQL = PROFILE_SQL.replace("from movies, nv join", "from (from movies where genres <> '(no genres listed)') movies, nv join")


@query("rc08_content_topk", "ratings movies", f"""
with {SPLIT_SQL}, {GENRE_VECTOR_SQL},
zero as (select list(0::double) as z from range(0, (select max(len(e)) from un))), us as (select userId, coalesce(f, z) as f from (select distinct userId from ratings) left join pr using (userId), zero),
sc as (select userId, movieId, case when e is null then -1 else list_inner_product(f, e) end as score from us, (select movieId, e from movies left join un using (movieId))),
best as (select sc.userId, sc.movieId, score, row_number() over (partition by sc.userId order by round(score, 9) desc, sc.movieId) as rank from sc
 anti join tr on tr.userId = sc.userId and tr.movieId = sc.movieId)
select userId, movieId, round(score, 6) as score, cast(rank as int) as rank from best where rank <= 10""")
def _(t):
    split = split_ratings(t)
    described = t.movies.where("genres <> '(no genres listed)'").select("movieId")
    items = item_vectors(t).join(described, "movieId", "left_semi")
    train = split.where("split = 0").select("userId", "movieId", "rating")
    return rounded(K.content_topk(train, items, 10, split, t.movies))


BLEND_SQL = """
z as (select userId, movieId, n::double as n, score as c from cs join pop using (movieId)),
st as (select userId, avg(n) as nm, stddev_pop(n) as ns, avg(c) as cm, stddev_pop(c) as cd from z group by 1),
sc as (select userId, movieId, 0.7::double * (n - nm) / (case when ns < 1e-9 then 1 else ns end) + 0.3::double * (c - cm) / (case when cd < 1e-9 then 1 else cd end) as score from z join st using (userId))"""


@query("rc09_blend_lists", "ratings movies", f"""
with {SPLIT_SQL}, {POP_SQL}, {PROFILE_SQL},
cs as (select tr.userId, tr.movieId, list_inner_product(f, e) as score from tr join pr using (userId) join un using (movieId)), {BLEND_SQL}
select userId, movieId, round(score, 6) as score from sc""")
def _(t):
    from tablewright.functions.scalars import unit_vector
    from tablewright.operators.products import pair_dots

    train, items = trained(t), item_vectors(t)
    units = items.select("movieId", unit_vector("embedding").alias("e"))
    profiles = stored(K.content_profiles(train, items), "profiles")
    content = stored(pair_dots(train, profiles, units, "userId", "movieId", "profile", "e"), "content")
    counts = train.groupBy("movieId").agg(F.count("*").cast("double").alias("score"))
    popular = train.select("userId", "movieId").join(counts, "movieId")
    blended = K.blend(popular, content, 0.7)
    for table in (profiles, content):
        dropped(table)
    return blended.withColumn("score", r6("score"))


@query("rc09_hybrid_topk", "ratings movies", f"""
with {SPLIT_SQL}, {POP_SQL}, {PROFILE_SQL},
cs as (select userId, un.movieId, list_inner_product(f, e) as score from pr, un join pop using (movieId)), {BLEND_SQL},
best as (select sc.userId, sc.movieId, score, row_number() over (partition by sc.userId order by round(score, 9) desc, sc.movieId) as rank from sc
 anti join tr on tr.userId = sc.userId and tr.movieId = sc.movieId)
select userId, movieId, round(score, 6) as score, cast(rank as int) as rank from best where rank <= 10""")
def _(t):
    from tablewright.functions.scalars import unit_vector

    train, items = trained(t), item_vectors(t)
    profiles = K.content_profiles(train, items)
    counts = train.groupBy("movieId").agg(F.array(F.count("*").cast("double")).alias("embedding"))
    units = items.join(counts.select("movieId"), "movieId", "left_semi").select("movieId", unit_vector("embedding").alias("embedding"))
    everyone = profiles.select("userId", F.array(F.lit(1.0)).alias("profile"))
    return rounded(K.hybrid_topk(everyone, counts, profiles, units, 0.7, 10, seen=train))


@query("rc10_relevance_vectors", "tags", f"""
with {TAG_SQL}, n as (select movieId, tag_clean, count(*)::double as n from c group by 1, 2), r as (select movieId, tag_clean, n / max(n) over (partition by movieId) as rel from n),
k as (select tag_clean, row_number() over (order by tag_clean) - 1 as i from (select distinct tag_clean from r)), w as (select count(*) as width from k)
select movieId, width, string_agg(i::varchar, ' ' order by i) as places, round(sum(rel * (i + 1)) / sum(i + 1), 6) as weighted_relevance, round(sqrt(sum(rel * rel)), 6) as norm
from r join k using (tag_clean), w group by 1, 2""")
def _(t):
    """Places and sums of every item's vector over all tags."""
    vectors, tags = relevance_vectors(tag_relevance(tags_clean(t)))
    flat = vectors.select("movieId", F.array_join(F.col("places").cast("array<string>"), " ").alias("text"), F.explode(F.arrays_zip("places", "relevances")).alias("e"))
    i, rel = F.col("e.places") + 1, F.col("e.relevances")
    return flat.groupBy("movieId", F.col("text").alias("places")).agg(
        r6(F.sum(rel * i) / F.sum(i)).alias("weighted_relevance"), r6(F.sqrt(F.sum(rel * rel))).alias("norm")
    ).withColumn("width", tags.agg(F.count("*")).scalar())


@query("rc10_relevance_rows", "tags", f"""
with {TAG_SQL}, n as (select movieId, tag_clean, count(*)::double as n from c group by 1, 2)
select movieId, tag_clean, round(n / max(n) over (partition by movieId), 6) as relevance from n""")
def _(t):
    """The vectors of all items over all tags of the table, as their entries above 0."""
    return tag_relevance(tags_clean(t)).withColumn("relevance", r6("relevance"))


@query("rc11_similar_items", "", """
with e as (select vec_id, embedding::double[] as e from embeddings),
p as (select a.vec_id as query_id, b.vec_id as item_id, list_inner_product(a.e, b.e) as score from e a join e b on a.vec_id <> b.vec_id),
r as (select *, row_number() over (partition by query_id order by score desc, item_id) as rank from p)
select query_id, item_id, round(score, 6) as score, cast(rank as int) as rank from r where rank <= 10""")
def _(t):
    found = V.similar_items(t.embeddings, 10, "vec_id", "embedding")
    return found.select("query_id", "item_id", r6("score").alias("score"), "rank")


@query("rc12_stored_vector_topk", "ratings movies", f"""
with {SPLIT_SQL}, {PROFILE_SQL}, sc as (select userId, movieId, list_inner_product(f, e) as score from pr, un),
best as (select *, row_number() over (partition by userId order by round(score, 9) desc, movieId) as rank from sc)
select userId, movieId, round(score, 6) as score, cast(rank as int) as rank from best where rank <= 10""")
def _(t):
    from tablewright.functions.scalars import unit_vector

    train, items = trained(t), item_vectors(t)
    users = stored(K.content_profiles(train, items), "user-vectors")
    catalogue = stored(items.select("movieId", unit_vector("embedding").alias("embedding")), "item-vectors")
    return rounded(K.vector_topk(users, catalogue, 10))


@query("rc13_cold_start", "ratings movies", f"""
with {VECTOR_SQL}, liked as (select userId, movieId from (select *, row_number() over (partition by userId order by rating desc, rated_at desc, movieId) as rn from ratings) where rn <= 3),
pc as (select userId, p, avg(x) as s from (select userId, unnest(e) as x, generate_subscripts(e, 1) as p from liked join v using (movieId)) group by 1, 2),
pr as (select userId, {unit_sql('list(s order by p)')} as f from pc group by 1),
sc as (select userId, movieId, list_inner_product(f, e) as score from pr, v),
best as (select sc.userId, sc.movieId, score, row_number() over (partition by sc.userId order by round(score, 9) desc, sc.movieId) as rank from sc anti join liked l on l.userId = sc.userId and l.movieId = sc.movieId)
select userId, movieId, round(score, 6) as score, cast(rank as int) as rank from best where rank <= 10""")
def _(t):
    items = item_vectors(t)
    # Stored: both the profiles and the pairs to leave out read it.
    liked = stored(W.top_per_group(t.ratings, ["userId"], 3, F.desc("rating"), F.desc("rated_at"), "movieId").select("userId", "movieId"), "liked")
    profiles = V.liked_profile(liked, items, "userId", "movieId", "embedding")
    return rounded(K.vector_topk(profiles, items, 10, seen=liked))


@query("rc14_negatives", "ratings", f"""
with {SPLIT_SQL}, items as (select movieId, row_number() over (order by movieId) - 1 as i from (select distinct movieId from tr)), ni as (select count(*) as ni from items),
un as (select u.userId, items.movieId, row_number() over (partition by u.userId order by i) - 1 as k from (select distinct userId from tr) u cross join items
 anti join tr on tr.userId = u.userId and tr.movieId = items.movieId),
sn as (select userId, count(*) as sn from tr group by 1),
d as (select userId, movieId, cast(draw as int) as draw, {BUCKET("userId::varchar || '-' || movieId::varchar || '-' || draw::varchar")} % (ni - sn) as k from tr join sn using (userId), ni, range(1, 5) r(draw) where rating >= 3.5)
select d.userId, d.movieId, draw, un.movieId as negative from d join un on un.userId = d.userId and un.k = d.k""")
def _(t):
    return K.negatives(trained(t), 4)


@query("rc15_sequences", "ratings", """
with items as (select movieId, row_number() over (order by movieId) as i from (select distinct movieId from ratings)),
r as (select userId, i, row_number() over (partition by userId order by rated_at desc, movieId desc) as rn from ratings join items using (movieId)),
l as (select userId, list(i order by rn desc) as s from r where rn <= 51 group by 1 having count(*) >= 3)
select userId, array_to_string(list_concat(list_transform(range(0, 50 - (len(s) - 1)), lambda x : 0), s[1:len(s) - 1]), ' ') as input,
 array_to_string(list_concat(list_transform(range(0, 50 - (len(s) - 1)), lambda x : 0), s[2:len(s)]), ' ') as target from l""")
def _(t):
    s = K.sequences(t.ratings)
    return s.select("userId", *[F.array_join(F.col(c).cast("array<string>"), " ").alias(c) for c in ("input", "target")])


@query("jn08_exclude_seen", "ratings tags", f"""
with {SPLIT_SQL} select userId, movieId from (select distinct userId, movieId from tags) anti join tr using (userId, movieId)""")
def _(t):
    from tablewright.operators.relations import without_pairs

    tagged = t.tags.select("userId", "movieId").distinct()
    return without_pairs(tagged, split_ratings(t).where("split = 0"), ["userId", "movieId"])


@query("jn09_metadata_lookup", "ratings movies", f"""
with {SPLIT_SQL}, {POP_SQL} select userId, rank, movieId, title, genres from top left join movies using (movieId)""")
def _(t):
    return pop_lists(t)[1].join(t.movies, "movieId", "left").select("userId", "rank", "movieId", "title", "genres")
