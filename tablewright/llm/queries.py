"""The registered queries of the subpackage and the SQL of those that SQL can say."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import byte_bpe, chat, importance, lexical_search, main_text, metric_join, minhash_join, mixing, multi_index, suffix_dedup, turn_repair, wavelet, word_table
from tablewright.llm.common import table
from tablewright.session import scratch_path


def op1_html_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return main_text.extract(table(spark, folder, "pages").select("page_id", "url", "html"))


def op2_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs, length=100)


def op3_multi_index(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return multi_index.nearest(vectors, vectors.where("vec_id % 20 = 0"), k=20)


def op4_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    """The documents that the sample takes."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scores = importance.score(docs, importance.fit(docs, table(spark, folder, "labels")))
    least = importance.threshold(scores)
    taken = scores.where(F.lit(False) if least is None else F.col("place") >= least)
    return taken.select(F.col("id").alias("doc_id"), "log_weight", "key", F.lit(True).alias("kept"))


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    return mixing.mixture(docs).select("doc_id", "size", "source_size", "target", "taken")


OP5_SQL = r"""
WITH sizes AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, md5(text) AS text_key FROM documents
), totals AS (
    SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n_docs,
        [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][(row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1] AS weight
    FROM sizes GROUP BY source
), caps AS (
    SELECT *, 2.0::DOUBLE * source_size AS cap, 1.5::DOUBLE * sum(source_size) OVER ()::DOUBLE AS budget FROM totals
), levels AS (  -- the level if a source and all that cap out before it are capped
    SELECT *, coalesce(sum(cap) OVER before, 0.0) AS held, sum(weight) OVER () - coalesce(sum(weight) OVER before, 0.0) AS free
    FROM caps WINDOW before AS (ORDER BY cap / weight, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
    SELECT (budget - held) / free AS level FROM levels WHERE (budget - held) / free <= cap / weight
    ORDER BY cap / weight, encode(source) NULLS LAST LIMIT 1
), targets AS (SELECT source, source_size, n_docs, least(cap, level * weight) AS target FROM caps, level
), placed AS (
    SELECT s.doc_id, s.source, s.size, s.text_key, t.source_size, t.target, md5('mix:' || coalesce(s.doc_id::VARCHAR, 'null')) AS key,
        ('0x' || md5('mix:' || coalesce(s.doc_id::VARCHAR, 'null'))[1:8])::BIGINT % ceil(t.n_docs / 4096)::BIGINT AS piece,
        CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS whole
    FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), parts AS (
    SELECT *, CASE WHEN source_size > 0 THEN (target - whole * source_size) / source_size ELSE 0.0 END AS part,
        sum(size) OVER (PARTITION BY source, piece ORDER BY key, size, text_key NULLS FIRST ROWS UNBOUNDED PRECEDING) AS upto FROM placed
), pieces AS (
    SELECT source, piece, part, sum(size) AS piece_size, sum(sum(size)) OVER (PARTITION BY source ORDER BY piece) AS piece_upto
    FROM parts GROUP BY source, piece, part
), extras AS (  -- the part of a document inside its piece's share: a seeded draw takes it whole or not at all
    SELECT p.*, greatest(0, least(p.size, floor(q.piece_upto * q.part) - floor((q.piece_upto - q.piece_size) * q.part) - p.upto + p.size)) AS extra,
        row_number() OVER (PARTITION BY doc_id, text_key, p.source ORDER BY key, upto) AS repeat
    FROM parts p JOIN pieces q ON p.source IS NOT DISTINCT FROM q.source AND p.piece = q.piece
)
SELECT doc_id, size, source_size, target, (size * (whole + CASE WHEN size * (('0x' || md5(concat_ws(':', 'mix draw', coalesce(doc_id::VARCHAR, 'null'),
    coalesce(source, 'null'), coalesce(text_key, 'null'), repeat::VARCHAR))[1:8])::BIGINT / 4294967296.0::DOUBLE) < extra THEN 1 ELSE 0 END))::BIGINT AS taken
FROM extras
"""


def op6_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return minhash_join.near_duplicates(docs, words=5, threshold=0.8)


OP6_SQL = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), grams AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN [list_aggregate(w[i:i + 4], 'string_agg', ' ') FOR i IN range(1, len(w) - 3)]
        WHEN len(w) > 0 THEN [list_aggregate(w, 'string_agg', ' ')] ELSE [] END) AS g FROM words
), sizes AS (SELECT doc_id, count(*) AS n, md5(string_agg(g, chr(10) ORDER BY g)) AS grams FROM grams GROUP BY doc_id
), pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
    SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE common * 10 >= 8 * (x.n + y.n - common)
), both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
    SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN both_ways l ON r.other = l.a
), classes AS (SELECT doc_id, min(other) AS class_id FROM reach GROUP BY doc_id
), counts AS (SELECT a AS doc_id, count(*) AS n_links FROM both_ways GROUP BY a)
SELECT d.doc_id, coalesce(min(d.doc_id) OVER (PARTITION BY s.grams, CASE WHEN s.grams IS NULL THEN d.doc_id END), d.doc_id) AS set_id,
    c.class_id, coalesce(n.n_links, 0) AS n_links
FROM documents d LEFT JOIN sizes s USING (doc_id) JOIN classes c USING (doc_id) LEFT JOIN counts n USING (doc_id)
"""

ANSWER = "</s>[INST] ok [/INST]"


def op7_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", ANSWER), (-7, 1, "assistant", ANSWER)], rows.schema)
    made = chat.format_conversations(rows.unionByName(extra))
    turns = F.transform(chat.read_turns(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    read = made.select("conv_id", "formatted", turns.alias("turns"), chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join("turns", ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP7_SQL = r"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), long AS (
    SELECT *, length(replace(replace(role, '\', '\\'), '<|', '<\|')) AS role_chars,
        length(replace(replace(text, '\', '\\'), '<|', '<\|')) AS text_chars,
        lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) IS NOT DISTINCT FROM role AS joined FROM rows
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(text_chars + CASE WHEN joined THEN 8 ELSE 8 + role_chars + 8 + 7 END)::BIGINT AS formatted_chars
FROM long GROUP BY conv_id
"""


def op8_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return byte_bpe.encode_texts(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, digests=True)


def op9_wavelet_tokens(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    path = wavelet.write_tokens(docs, scratch_path(spark, "wavelet"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return wavelet.read_tokens(spark, path)


def op10_metric_range_join(spark: SparkSession, folder: str) -> DataFrame:
    return metric_join.near_vectors(table(spark, folder, "embeddings").select("vec_id", "embedding", "label"), cosine=0.98)


OP10_SQL = """
WITH RECURSIVE good AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS norm
    FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.98
), reach AS (
    SELECT vec_id, vec_id AS other FROM embeddings UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON r.other = l.a
), components AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id
), counts AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n.n_links, 0) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN components c USING (vec_id) LEFT JOIN counts n USING (vec_id)
"""


def op11_word_table(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = Path(public_tokenizers.path("word_bpe_49k.json")).read_text()
    made = word_table.encode_texts(table(spark, folder, "documents").select("doc_id", "text"), tokenizer, decoded="decoded")
    return made.select(
        "doc_id", "n_tokens", F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    held = lexical_search.index(table(spark, folder, "documents").select("doc_id", "text"))
    return lexical_search.search(held, table(spark, folder, "benchmark").select("item_id", "text"), k=10)


OP12_SQL = r"""
WITH terms AS (
    SELECT row_number() OVER () AS place, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents
), lengths AS (SELECT place, doc_id, len(t)::BIGINT AS n FROM terms WHERE len(t) > 0
), whole AS (SELECT count(*) AS all_docs, coalesce(sum(n), 0)::BIGINT AS all_terms FROM lengths
), held AS (SELECT place, term, count(*) AS tf FROM (SELECT place, unnest(t) AS term FROM terms) GROUP BY place, term
), asked AS (
    SELECT item_id, term, count(*) AS times FROM (
        SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
    ) GROUP BY item_id, term
), weights AS (
    SELECT term, floor(1000 * ln((2 * all_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
    FROM (SELECT term, count(*) AS df FROM held WHERE term IN (SELECT term FROM asked) GROUP BY term), whole
), shares AS (
    SELECT h.place, l.doc_id, h.term, w.w * ((1000000000 * h.tf) // (1000 * h.tf + 8 * (25 + (75 * l.n * all_docs) // all_terms))) AS share
    FROM held h JOIN weights w ON w.term = h.term JOIN lengths l ON l.place = h.place, whole
), scores AS (
    SELECT item_id, place, doc_id, sum(times * share)::BIGINT AS score FROM asked JOIN shares USING (term) GROUP BY item_id, place, doc_id
), ranked AS (
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST)::INTEGER AS rank, doc_id, score
    FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""


def damaged_turns(rows: DataFrame) -> DataFrame:
    """Conversations with a fifth of their rows damaged, by a checksum of conversation and turn; dropped rows are not present."""
    def said(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat_ws(":", said("conv_id"), said("turn")).cast("binary")) % 20
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return (
        rows.select("conv_id", "turn", said("role").alias("role"), said("text").alias("text"), kind.alias("kind"))
        .withColumns({"text": text, "role": F.when(F.col("kind") == 4, "user").otherwise(F.col("role")), "present": F.col("kind") != 0})
        .withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        .drop("kind", "copy")
    )


def op13_turn_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return turn_repair.repair(damaged_turns(rows), present="present")


OP13_SQL = r"""
WITH RECURSIVE keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(
            string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT),
            lambda crc, b: list_reduce([xor(crc, b)] || range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
        )) % 20 AS kind FROM conversations
), damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM (SELECT *, unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy FROM keyed WHERE kind <> 0)
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k, count(*) OVER (PARTITION BY conv_id) AS n FROM damaged
), marked AS (
    SELECT *, left(role, 1) AS i, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY k) AS i_before,
        right(regexp_replace(text, '[\x20\x09-\x0D]+$', ''), 1) AS last_char,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 AS seen FROM placed
), faults AS (
    SELECT *, last_char = '' AS blank, last_char <> '' AND seen AS duplicate, last_char <> '' AND NOT seen AND last_char NOT IN ('.', '!', '?') AS truncated
    FROM marked
), counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (blank) AS blank,
        count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
        count(*) FILTER (i_before IS NOT NULL AND i_before || i NOT IN ('su', 'ua', 'au')) AS illegal FROM faults GROUP BY conv_id
), best AS (  -- the cheapest rest after the four ends: nothing yet, system, user, assistant
    SELECT DISTINCT conv_id, n + 1 AS k, {'c': 0::BIGINT, 'a': '', 't': '', 'm': 0::BIGINT} AS e0,
        {'c': 10::BIGINT, 'a': 'II', 't': chr(10) || 'user:' || chr(10) || 'assistant:', 'm': 2::BIGINT} AS e1,
        {'c': 5::BIGINT, 'a': 'I', 't': chr(10) || 'assistant:', 'm': 1::BIGINT} AS e2, {'c': 0::BIGINT, 'a': '', 't': '', 'm': 0::BIGINT} AS e3 FROM placed
    UNION ALL
    SELECT conv_id, k,
        list_sort([b0, {'c': 5 + b2.c, 'a': 'I' || b2.a, 't': chr(10) || 'user:' || b2.t, 'm': 1 + b2.m},
            {'c': 10 + b3.c, 'a': 'II' || b3.a, 't': chr(10) || 'user:' || chr(10) || 'assistant:' || b3.t, 'm': 2 + b3.m}])[1],
        list_sort([b1, {'c': 5 + b2.c, 'a': 'I' || b2.a, 't': chr(10) || 'user:' || b2.t, 'm': 1 + b2.m},
            {'c': 10 + b3.c, 'a': 'II' || b3.a, 't': chr(10) || 'user:' || chr(10) || 'assistant:' || b3.t, 'm': 2 + b3.m}])[1],
        list_sort([b2, {'c': 5 + b3.c, 'a': 'I' || b3.a, 't': chr(10) || 'assistant:' || b3.t, 'm': 1 + b3.m}])[1],
        list_sort([b3, {'c': 5 + b2.c, 'a': 'I' || b2.a, 't': chr(10) || 'user:' || b2.t, 'm': 1 + b2.m}])[1]
    FROM (
        SELECT conv_id, k,
            list_sort([d0, CASE WHEN stays AND i = 's' THEN {'c': e1.c + x, 'a': 'K' || e1.a, 't': line || e1.t, 'm': 1 + e1.m}
                WHEN stays AND i = 'u' THEN {'c': e2.c + x, 'a': 'K' || e2.a, 't': line || e2.t, 'm': 1 + e2.m} ELSE d0 END,
                CASE WHEN stays THEN {'c': e2.c + x + 1, 'a': 'R' || e2.a, 't': chr(10) || 'user:' || text || e2.t, 'm': 1 + e2.m} ELSE d0 END])[1] AS b0,
            list_sort([d1, CASE WHEN stays AND i = 'u' THEN {'c': e2.c + x, 'a': 'K' || e2.a, 't': line || e2.t, 'm': 1 + e2.m} ELSE d1 END,
                CASE WHEN stays THEN {'c': e2.c + x + 1, 'a': 'R' || e2.a, 't': chr(10) || 'user:' || text || e2.t, 'm': 1 + e2.m} ELSE d1 END])[1] AS b1,
            list_sort([d2, CASE WHEN stays AND i = 'a' THEN {'c': e3.c + x, 'a': 'K' || e3.a, 't': line || e3.t, 'm': 1 + e3.m} ELSE d2 END,
                CASE WHEN stays THEN {'c': e3.c + x + 1, 'a': 'R' || e3.a, 't': chr(10) || 'assistant:' || text || e3.t, 'm': 1 + e3.m} ELSE d2 END])[1] AS b2,
            list_sort([d3, CASE WHEN stays AND i = 'u' THEN {'c': e2.c + x, 'a': 'K' || e2.a, 't': line || e2.t, 'm': 1 + e2.m} ELSE d3 END,
                CASE WHEN stays THEN {'c': e2.c + x + 1, 'a': 'R' || e2.a, 't': chr(10) || 'user:' || text || e2.t, 'm': 1 + e2.m} ELSE d3 END])[1] AS b3
        FROM (
            SELECT f.conv_id, f.k, f.i, f.text, NOT f.blank AND NOT f.duplicate AS stays, CASE WHEN f.truncated THEN 5 ELSE 0 END AS x,
                chr(10) || f.role || ':' || f.text AS line, e1, e2, e3,
                {'c': e0.c + 2, 'a': 'D' || e0.a, 't': e0.t, 'm': e0.m} AS d0, {'c': e1.c + 2, 'a': 'D' || e1.a, 't': e1.t, 'm': e1.m} AS d1,
                {'c': e2.c + 2, 'a': 'D' || e2.a, 't': e2.t, 'm': e2.m} AS d2, {'c': e3.c + 2, 'a': 'D' || e3.a, 't': e3.t, 'm': e3.m} AS d3
            FROM best b JOIN faults f ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.k = b.k - 1
        )
    )
)
SELECT o.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate, coalesce(c.truncated, 0) AS truncated,
    coalesce(c.illegal, 0) AS illegal, coalesce(b.e0.c, 0) AS cost, coalesce(b.e0.a, '') AS audit, sha256(coalesce(b.e0.t[2:], '')) AS repaired_sha256,
    coalesce(n.n_rows, 0) AS n_rows, coalesce(b.e0.m, 0) AS n_repaired
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
    LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM o.conv_id AND b.k = 1
    LEFT JOIN (SELECT conv_id, count(*) AS n_rows FROM placed GROUP BY conv_id) n ON n.conv_id IS NOT DISTINCT FROM o.conv_id
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_main_text": op1_html_main_text,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_multi_index": op3_multi_index,
    "op4_importance_resampling": op4_importance_resampling,
    "op5_mixing": op5_mixing,
    "op6_ngram_jaccard_join": op6_ngram_jaccard_join,
    "op7_chat_format": op7_chat_format,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_wavelet_tokens": op9_wavelet_tokens,
    "op10_metric_range_join": op10_metric_range_join,
    "op11_word_table": op11_word_table,
    "op12_lexical_search": op12_lexical_search,
    "op13_turn_repair": op13_turn_repair,
}

SQL: dict[str, str] = {
    "op5_mixing": OP5_SQL,
    "op6_ngram_jaccard_join": OP6_SQL,
    "op7_chat_format": OP7_SQL,
    "op10_metric_range_join": OP10_SQL,
    "op12_lexical_search": OP12_SQL,
    "op13_turn_repair": OP13_SQL,
}
