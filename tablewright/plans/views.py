"""The input views: one SQL text per view, valid in Spark and in the checking engine.

The driver's tables stand in for ratings, films, tags, shop transactions, buildings, optical
links, houses, scored documents and a file manifest. `table` renders a table name and `bucket`
the hash of a string; nulls are injected by hash because the tables hold none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablewright.sources.tables import stored

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

Render = Callable[[str], str]

LINE = "concat(cast(l_orderkey as varchar(20)), '-', cast(l_linenumber as varchar(9)))"


def line_key(prefix: str) -> str:
    return f"concat('{prefix}', cast(l_orderkey as varchar(20)), '-', cast(l_linenumber as varchar(9)))"


def part_key(prefix: str) -> str:
    return f"concat('{prefix}', cast(p_partkey as varchar(20)))"


def ratings(t: Render, b: Render) -> str:
    return f"""
    select userId, movieId, rating, rated_at from (
      select o_custkey as userId, l_partkey as movieId,
             cast(ceil(l_quantity / 5) as double) / 2 as rating, l_shipdate as rated_at,
             row_number() over (partition by o_custkey, l_partkey
                                order by l_shipdate desc, l_orderkey desc, l_linenumber desc) as rn
      from {t('orders')} join {t('lineitem')} on o_orderkey = l_orderkey) x
    where rn = 1"""


def movies(t: Render, b: Render) -> str:
    return f"""
    select p_partkey as movieId,
           case when p_size = 50 then p_name
                else concat(p_name, ' (', cast(1950 + p_size as varchar(4)), ')') end as title,
           case when p_size = 49 then '(no genres listed)'
                else concat(replace(p_name, ' ', '|'), '|', p_type) end as genres
    from {t('part')}"""


def tags(t: Render, b: Render) -> str:
    return f"""
    select o_custkey as userId, l_partkey as movieId,
           case when {b(LINE)} % 10 = 0 then ' !! '
                when {b(LINE)} % 3 = 0 then concat('  ', upper(p_type), '!')
                when {b(LINE)} % 3 = 1 then o_orderpriority
                else concat(p_name, '  ', p_brand) end as tag,
           l_shipdate as tagged_at
    from {t('orders')} join {t('lineitem')} on o_orderkey = l_orderkey
    join {t('part')} on p_partkey = l_partkey"""


def transactions(t: Render, b: Render) -> str:
    return f"""
    select l_orderkey as invoice_id, l_linenumber as line_no, r_name as branch, n_name as city,
           c_mktsegment as customer_type,
           case when c_custkey % 2 = 0 then 'Female' else 'Male' end as gender,
           p_type as product_line, o_orderpriority as payment,
           p_retailprice as unit_price, l_quantity as quantity,
           round(p_retailprice * l_quantity * 1.05e0, 4) as total,
           4 + 60 * l_discount as rating, l_shipdate as ts
    from {t('lineitem')} join {t('orders')} on o_orderkey = l_orderkey
    join {t('customer')} on c_custkey = o_custkey join {t('part')} on p_partkey = l_partkey
    join {t('nation')} on n_nationkey = c_nationkey join {t('region')} on r_regionkey = n_regionkey"""


def transactions_raw(t: Render, b: Render) -> str:
    return f"""
    select l_orderkey as invoice_id, l_linenumber as line_no, p_retailprice as unit_price,
           case when {b(line_key('q'))} % 50 = 0 then null else l_quantity end as quantity,
           case when {b(line_key('p'))} % 25 = 0 then null else p_type end as product_line,
           case when {b(line_key('c'))} % 12 = 0 then null else c_mktsegment end as customer_type,
           case when {b(line_key('d'))} % 200 = 0 then 'n/a'
                else concat(cast(month(l_shipdate) as varchar(2)), '/', cast(day(l_shipdate) as varchar(2)),
                            '/', substr(cast(year(l_shipdate) + 20 as varchar(4)), 3, 2)) end as date_str,
           concat(cast(10 + l_linenumber % 11 as varchar(2)), ':',
                  substr(cast(100 + l_partkey % 60 as varchar(3)), 2, 2)) as time_str
    from {t('lineitem')} join {t('orders')} on o_orderkey = l_orderkey
    join {t('customer')} on c_custkey = o_custkey join {t('part')} on p_partkey = l_partkey"""


def buildings(t: Render, b: Render) -> str:
    return f"""
    select {LINE} as imb_id,
           -6 + 17e0 * (l_partkey % 1000) / 1000 as x, 40.5e0 + 12e0 * (l_orderkey % 997) / 997 as y,
           cast(n_nationkey as varchar(5)) as code_insee, concat('  ', n_name, ' ') as nom_com,
           cast(l_suppkey as varchar(20)) as pm_ref,
           case when {b('cast(l_orderkey as varchar(20))')} % 50 = 0 then null
                when l_linestatus = 'F' then 'deploye' else 'cible' end as imb_etat,
           case p_type when 'ECONOMY' then 'individuel' when 'STANDARD' then 'entre 2 et 11'
                when 'MEDIUM' then 'entre 12 et 35' when 'SMALL' then 'entre 36 et 99'
                when 'LARGE' then '100 et plus' else 'autre' end as catg_loc_imb,
           case when {b("concat('op', cast(l_suppkey as varchar(20)))")} % 7 = 0 then null
                else l_returnflag end as code_l331,
           concat(cast(l_partkey % 99999 as varchar(20)), '.0') as code_poste,
           case when l_linenumber = 1 then '' else cast(l_linenumber as varchar(9)) end as num_voie,
           case when l_linenumber % 2 = 0 then 'A' end as batiment
    from {t('lineitem')} join {t('supplier')} on s_suppkey = l_suppkey
    join {t('nation')} on n_nationkey = s_nationkey join {t('part')} on p_partkey = l_partkey"""


def links(t: Render, b: Render) -> str:
    return f"""
    select {LINE} as link_id,
           l_quantity / 50 as osnr, l_discount * 10 as launch_power, l_tax * 12.5e0 as fiber_length,
           p_size / 50e0 as dispersion, (p_retailprice - 900) / 100 as nonlinear_effect,
           2 + 4 * l_quantity / 50 + 2 * l_discount * 10 - l_tax * 12.5e0 as q_factor
    from {t('lineitem')} join {t('part')} on p_partkey = l_partkey"""


def scored(t: Render, b: Render) -> str:
    return f"""
    select l.doc_id, l.quality as y, l.toxic, d.lang, d.source,
           cast(round(0.5e0 * l.quality + 0.5e0 * ({b('cast(l.doc_id as varchar(20))')} % 1000) / 999e0, 3)
                as double) as p,
           cast(d.n_chars as double) as y_true,
           d.n_chars * (0.9e0 + 0.2e0 * ({b("concat('r', cast(l.doc_id as varchar(20)))")} % 1000) / 999e0)
             as y_pred
    from {t('labels')} l join {t('documents')} d on d.doc_id = l.doc_id"""


def houses(t: Render, b: Render) -> str:
    return f"""
    select p_partkey as pid,
           case when {b(part_key('a'))} % 10 = 0 then null else p_retailprice end as total_bsmt_sf,
           case when {b(part_key('b'))} % 10 < 2 then null else cast(p_size as double) end as first_flr_sf,
           case when {b(part_key('c'))} % 10 < 6 then null else cast(p_size as double) end as pool_area,
           case when {b(part_key('d'))} % 10 = 0 then null else p_type end as house_style,
           case when {b(part_key('e'))} % 100 < 45 then null else p_brand end as alley,
           1 as constant_col, 1950 + p_size as year_built,
           1950 + p_size + case when p_partkey % 3 = 0 then 5 else 0 end as year_remod, 2010 as yr_sold,
           p_retailprice * 100 + p_size * 500 as sale_price
    from {t('part')}"""


def manifest(t: Render, b: Render) -> str:
    return f"""
    select concat('chest/', case when doc_id % 10 = 0 then 'test' when doc_id % 97 = 1 then 'val'
                                 else 'train' end, '/',
                  case when lang = 'en' then 'PNEUMONIA' else 'NORMAL' end, '/', source,
                  case when lang <> 'en' then '' when doc_id % 3 = 0 then '_virus'
                       when doc_id % 3 = 1 then '_bacteria' else '' end,
                  '_', cast(doc_id as varchar(20)), '.jpeg') as filepath, n_chars
    from {t('documents')}"""


VIEWS = {
    f.__name__: f
    for f in (ratings, movies, tags, transactions, transactions_raw, buildings, links, scored, houses, manifest)
}


def _spark_bucket(text: str) -> str:
    return f"cast(conv(substr(md5(concat({text}, ':42')), 1, 8), 16, 10) as bigint)"


def _oracle_bucket(text: str, seed: int = 42) -> str:
    return f"('0x' || substr(md5(({text}) || ':{seed}'), 1, 8))::bigint"


class Tables:
    """Attribute access to the driver tables and to the views built on them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def kept(self, name: str) -> DataFrame:
        """A view of joined and ranked tables written once and read back: the input of operators that pass over it often."""
        return stored(getattr(self, name), name)

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.read(name)
        if name in VIEWS:
            used: dict[str, DataFrame] = {}

            def table(t: str) -> str:
                used[t] = self.read(t)
                return "{" + t + "}"

            text = VIEWS[name](table, _spark_bucket)
            return self.spark.sql(text, **used)
        raise AttributeError(name)


def oracle_text(views: str, body: str) -> str:
    """`body` with the named views in front of it as common table expressions."""
    names = views.split()
    ctes = [f"{n} as ({VIEWS[n](lambda t: t, _oracle_bucket)})" for n in names]
    body = body.strip()
    if not ctes:
        return body
    if body.lower().startswith("with recursive "):
        return "with recursive " + ",\n".join(ctes) + ",\n" + body[len("with recursive "):]
    if body.lower().startswith("with "):
        return "with " + ",\n".join(ctes) + ",\n" + body[5:]
    return "with " + ",\n".join(ctes) + "\n" + body


BUCKET = _oracle_bucket
