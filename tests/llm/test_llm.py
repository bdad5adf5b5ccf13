"""Operators of the llm subpackage against brute force, round trips and edge cases."""

from __future__ import annotations

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from tablewright.llm import byte_bpe, chat, importance, main_text, metric_join, minhash_join, mixing, multi_index, suffix_dedup, wavelet

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_bytes long, ids string"


@pytest.fixture(scope="module")
def docs(spark):
    """Null and empty texts, a null id, repeated rows, a long text, shared passages, clashing columns."""
    rnd = random.Random(5)
    words = ["alpha", "beta", "gamma", "délta", "the", "of", "€uro", "x", "longerword"]
    line = " ".join(rnd.choice(words) for _ in range(60))
    rows = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 90)))) for i in range(30)]
    rows += [(30, None), (31, ""), (32, " \n\t"), (None, "no id " + line), (33, line), (34, line + " tail"), (35, line), (35, line)]
    rows += [(36, rows[3][1]), (37, " ".join(rnd.choice(words) for _ in range(6000))), (38, "ab" * 400), (39, "x " + line + " x")]
    full = [(i, t, "en", [None, "s1", "s2", "s3"][k % 4], 0, 1, "z") for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, DOCS)


def local(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


def order(row):
    return (row[0] is not None, row[0] or 0, row[1])


def test_repeats_match_brute_force(docs):
    for length in (8, 100):
        seen, want = set(), []
        for i, text in sorted(local(docs), key=order):
            raw = text.encode()
            gone = [False] * len(raw)
            for k in range(len(raw) - length + 1):
                w = raw[k:k + length]
                if w in seen:
                    gone[k:k + length] = [True] * length
                seen.add(w)
            kept = bytes(c for c, g in zip(raw, gone, strict=True) if not g)
            spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
            want.append((i, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
        got = suffix_dedup.remove_repeats(docs, length=length).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_repeats_of_busy_grams(docs, monkeypatch):
    plain = suffix_dedup.remove_repeats(docs, length=20).select("doc_id", "n_removed", "kept_sha256").collect()
    monkeypatch.setattr(suffix_dedup, "HOT_RUNS", 3)
    monkeypatch.setattr(suffix_dedup, "HOT_IN_BATCH", 2)
    busy = suffix_dedup.remove_repeats(docs, length=20).select("doc_id", "n_removed", "kept_sha256").collect()
    assert sorted(map(repr, plain)) == sorted(map(repr, busy))


def test_run_index_on_small_alphabets():
    for seed in range(60):
        rnd = random.Random(seed)
        length = rnd.choice([3, 5, 8])
        texts = [bytes(rnd.choice(b"ab\x00") for _ in range(rnd.randint(length, 30))) for _ in range(rnd.randint(1, 10))]
        seen, want = set(), []
        for t in texts:
            for k in range(len(t)):
                w = t[k:k + length]
                want.append(len(w) == length and w in seen)
                seen.add(w)
        got = suffix_dedup.run_index(np.frombuffer(b"".join(texts), np.uint8), np.array([len(t) for t in texts]), length)
        assert got.tolist() == want


def test_kept_text_has_whole_characters(spark):
    rows = [(1, "é" * 60), (2, "a" + "é" * 60 + "b")]
    out = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), length=100, keep_text=True)
    kept = {r.doc_id: r.kept for r in out.collect()}
    assert kept[2] == "ab" and set(kept[1]) == {"é"}  # the first text repeats within itself


def test_near_duplicates_match_brute_force(docs):
    rows = local(docs)

    def grams(text):
        w = text.split()
        return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])

    sets = [grams(t) for _, t in rows]
    links = [[j for j in range(len(rows)) if j != i and sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])] for i in range(len(rows))]
    got = {}
    for r in minhash_join.near_duplicates(docs).collect():
        got.setdefault(r.doc_id, []).append((r.class_id, r.n_links))
    for i, (doc, _) in enumerate(rows):
        reach, todo = {i}, [i]
        while todo:
            todo += [j for j in links[todo.pop()] if j not in reach and not reach.add(j)]
        ids = [rows[j][0] for j in reach if rows[j][0] is not None]
        assert (min(ids) if ids else None, len(links[i])) in got[doc]


def test_parts_of_large_buckets_change_nothing(docs, monkeypatch):
    plain = sorted(map(repr, minhash_join.near_duplicates(docs).collect()))
    monkeypatch.setattr(minhash_join, "PART", 2)
    assert sorted(map(repr, minhash_join.near_duplicates(docs).collect())) == plain


def test_recall_at_low_thresholds(spark):
    assert minhash_join.choose_bands(0.8, 0.99999) == (22, 4)
    for threshold in (0.01, 0.05, 0.1, 0.5, 0.9, 1.0):
        bands, rows = minhash_join.choose_bands(threshold, 0.99999)
        assert 1 - (1 - threshold**rows) ** bands >= 0.99999
    rnd = random.Random(4)
    texts = []
    for pair in range(40):
        shared = [f"s{pair}x{k}" for k in range(14)]
        texts += [" ".join([*shared, *(f"p{pair}s{side}x{k}" for k in range(34))]) for side in range(2)]
    rnd.shuffle(texts)
    rows = minhash_join.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), threshold=0.1).collect()
    assert [r.n_links for r in rows] == [1] * 80


def test_pipeline_keeps_texts_that_share_an_id(spark):
    import corpus_pipeline

    a, b = " ".join(f"a{k}" for k in range(30)), " ".join(f"b{k}" for k in range(30))
    rows = [(1, a), (1, b), (2, b + " tail"), (3, "one two three"), (3, "one two three"), (3, " one  two three"), (None, a), (None, "no other text like it"),
            (4, None), (4, None), (4, ""), (5, " "), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0, k, "z") for k, (i, t) in enumerate(rows)], DOCS)
    out = corpus_pipeline.near_duplicates(spark, docs, "")
    assert out.columns == docs.columns
    kept = sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)
    # The blank inside of the third text of id 3 makes it equal in words only; one of the three stays.
    three = [t for i, t in kept if i == 3]
    assert len(three) == 1 and three[0].split() == ["one", "two", "three"]
    rest = [(1, a), (1, b), (None, "no other text like it"), (4, None), (4, None), (4, ""), (5, " "), (None, None)]
    assert [r for r in kept if r[0] != 3] == sorted(rest, key=repr)


def test_mixture_meets_targets(docs):
    rows = mixing.mixture(docs).collect()
    assert len(rows) == docs.count()
    by = {}
    for r in rows:
        assert 0 <= r.taken <= 2 * r["size"]
        by.setdefault(r.source, []).append(r)
    total = sum(r["size"] for r in rows)
    assert abs(sum(v[0].target for v in by.values()) - 1.5 * total) < 1e-6 * total
    for own in by.values():
        assert own[0].target <= 2 * own[0].source_size and abs(sum(r.taken for r in own) - own[0].target) <= max(r["size"] for r in own) + 2
        assert all(r.taken % max(1, r["size"]) == 0 for r in own)
    plan = mixing.mixture(docs)
    out = mixing.repeat_documents(docs, plan).collect()
    assert sum(len((r.text or "").split()) for r in out) == sum(r.taken for r in rows)


def test_pipeline_mixes_whole_texts(spark, docs):
    import corpus_pipeline

    rnd = random.Random(8)
    small = [(100 + i, " ".join(f"w{j}" for j in range(rnd.randint(5, 400))), "en", f"t{i // 2}", 0, 1, "z") for i in range(240)]
    every = docs.where("doc_id is not null").unionByName(spark.createDataFrame(small, DOCS))
    out = corpus_pipeline.mix_sources(spark, every, "").select("doc_id", "text", "source").collect()
    texts = {(r.doc_id, r.text) for r in every.collect()}
    assert out and all((r.doc_id, r.text) in texts for r in out)
    words = {}
    for r in out:
        words[r.source] = words.get(r.source, 0) + len(r.text.split())
    plan = mixing.mixture(every).collect()
    target, largest = {r.source: r.target for r in plan}, {}
    for r in plan:
        largest[r.source] = max(largest.get(r.source, 0), r["size"])
    assert all(abs(words.get(s, 0) - target[s]) <= largest[s] + 2 for s in target)
    assert abs(sum(words.values()) - sum(target.values())) < 0.1 * sum(target.values())
    assert all(r.taken % max(1, r["size"]) == 0 and r.taken <= 2 * r["size"] for r in plan) and sum(r.taken for r in plan) == sum(words.values())


def test_chat_round_trip(spark):
    odd = "a\\<|b <\\| <|turn|> \\\\<|end|> <|part|><|text|>"
    rows = [
        (1, 0, "system", odd), (1, 1, "user", None), (1, 2, "assistant", odd), (1, 3, "assistant", "<"), (1, 4, "assistant", "|x"),
        (2, None, None, ""), (2, 0, "assistant", "é<|"), (2, 0, "assistant", "é<|"), (None, 1, "us<|er\n", "\\"), (3, 5, "user", "u " * 3000),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat.format_conversations(turns)
    from pyspark.sql import functions as F

    got = {r.conv_id: r for r in made.select("conv_id", chat.read_turns(F.col("formatted")).alias("t"), chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("l")).collect()}
    for conv in (1, 2, None, 3):
        own = sorted([r for r in rows if r[0] == conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        assert [(t.role, t.text) for t in got[conv].t] == [(r[2] or "", r[3] or "") for r in own]
        assert got[conv].l == "".join(r[3] or "" for r in own if r[2] == "assistant")


def test_bpe_is_the_librarys(docs):
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = byte_bpe.encode_texts(docs, RANKS, public_tokenizers.PATTERN).collect()
    want = sorted((repr(i), t, library.encode_ordinary(t)) for i, t in local(docs))
    assert sorted((repr(r.doc_id), bytes(r.decoded).decode(), r.ids) for r in out) == want


def test_wavelet_files_hold_the_ids(spark, docs, tmp_path):
    library = Tokenizer.from_file(WORDS)
    library.encode_special_tokens = True
    texts = sorted([(i, library.encode(t, add_special_tokens=False).ids + [2]) for i, t in local(docs)], key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    path = wavelet.write_tokens(docs, f"{tmp_path}/tokens", WORDS, end_id=2)
    got = wavelet.read_tokens(spark, path).orderBy("start").collect()
    at = 0
    for r, (i, ids) in zip(got, texts, strict=True):
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    shard = spark.read.parquet(path).orderBy("shard").first()
    _, _, matrix = wavelet.read_shard(bytes(shard.file))
    every = matrix.values()
    for k in range(0, len(every), max(1, len(every) // 50)):
        token = int(every[k])
        assert matrix.access(k) == token and matrix.rank(token, k) == (every[:k] == token).sum() and matrix.select(token, matrix.rank(token, k)) == k


def test_word_tokens_of_special_strings():
    from tablewright.llm import word_tokens

    texts = ["a <|endoftext|> b", "x<|endoftext|>y. <|startoftext|>", "<|EndOfText|>", "<|endoftext|><|endoftext|>", "plain words.", "<|endoftext |>", ""]
    made = open(WORDS, encoding="utf-8").read()
    data = [t.encode() for t in texts]
    offsets = np.r_[0, np.cumsum([len(d) for d in data])].astype(np.int64)
    found = word_tokens.WordTokens(made).encode(np.frombuffer(b"".join(data), np.uint8), offsets)
    plain = Tokenizer.from_str(made)
    expected = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert found.values.tolist() == sum(expected, []) and found.sizes.tolist() == [len(e) for e in expected]


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(400, 16)).astype("f4")
    v[50:80] = v[49]
    v[100:120] = v[99] + rng.normal(size=(20, 16)).astype("f4") * 0.05
    rows = [(i, x.tolist(), i % 3) for i, x in enumerate(v)]
    rows += [(400, None, 1), (401, [0.0] * 16, 1), (402, [float("nan")] * 16, 1), (403, [None] + [1.0] * 15, 1), (404, v[49].tolist(), None), (405, [1.0] * 5, 2), (406, [float("inf")] * 16, 0)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_nearest_recall_and_scores(vectors):
    out = multi_index.nearest(vectors, vectors.where("vec_id % 20 = 0"), k=20).collect()
    good = {r.vec_id: np.array(r.embedding, float) for r in vectors.where("vec_id < 400 or vec_id = 404").collect()}
    ids = np.array(sorted(good))
    found = {}
    for r in out:
        found.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    assert set(found) == {i for i in good if i % 20 == 0}
    hits = []
    for q, own in found.items():
        score = np.array([(good[i] * good[q]).sum() if i != q else -np.inf for i in ids])
        best = ids[np.lexsort((ids, -score))[:20]]
        hits.append(len({v for v, _ in own.values()} & set(best.tolist())) / 20)
        assert sorted(own) == list(range(1, 21)) and all(abs(s - (good[v] * good[q]).sum()) < 1e-12 for v, s in own.values())
    assert np.mean(hits) >= 0.9


def test_nearest_of_few_vectors_are_all(spark):
    rng = np.random.default_rng(4)
    for n, copies, k in ((2, 1, 20), (15, 1, 20), (25, 1, 20), (25, 6, 20), (60, 1, 50)):
        rows = [(i, x.tolist()) for i, x in enumerate(rng.normal(size=(n, 16)).astype("f4"))]
        rows += [(0, rng.normal(size=16).astype("f4").tolist()) for _ in range(copies - 1)]
        small = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
        counts = {r.query_id: r["count"] for r in multi_index.nearest(small, small, k=k).groupBy("query_id").count().collect()}
        assert counts == {i: min(k, len(rows) - (copies if i == 0 else 1)) for i in range(n)}


def test_near_vectors_match_brute_force(vectors, monkeypatch):
    for part, per_pivot in ((2048, 1024), (16, 20)):
        monkeypatch.setattr(metric_join, "PART", part)
        monkeypatch.setattr(metric_join, "PER_PIVOT", per_pivot)
        got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in metric_join.near_vectors(vectors).collect()}
        rows = [(r.vec_id, np.array(r.embedding, float), r.label) for r in vectors.where("vec_id < 400").collect()]
        unit = {i: (v / np.linalg.norm(v), l) for i, v, l in rows}
        links = {i: [j for j in unit if j != i and unit[j][1] == unit[i][1] and unit[i][0] @ unit[j][0] >= 0.98] for i in unit}
        for i in unit:
            reach, todo = {i}, [i]
            while todo:
                todo += [j for j in links[todo.pop()] if j not in reach and not reach.add(j)]
            assert got[i] == (len(links[i]), min(reach), min(reach) == i)
        assert all(got[i] == (0, i, True) for i in range(400, 407))


PAGE = """<html><head><title>t</title></head><body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></ul></nav>
<div class="cookie-notice">We use cookies.</div><article><h1>Head &amp; line</h1><p>First <b>bold</b>word&nbsp;x.<br>Next line<p>Short.
<div class="ad">Buy now</div><script>if (a < b) "</p>"</script><!-- <p>no</p> --><p>Last 5 &lt; 6 &eacute;.</p><section id="comments"><p>A reader says the
same of it all.</p></section></article><aside>Aside text</aside><form><p>Your name</p></form><footer>&copy; 2020</footer></body></html>"""


def test_main_text():
    assert main_text.main_text(PAGE) == "Head & line First boldword x. Next line Short. Last 5 < 6 é."
    prose = "This is the story of a man who went to the sea and of what he found there when he was old and all alone. " * 3
    page = f"<body><div id=menu><a href=a>One</a> <a href=b>Two</a></div><h2>Title</h2><p>{prose}</p><p>Yes.</p><p>{prose}</p><p><a href=x>More stories here</a></p>"
    assert main_text.main_text(page) == " ".join(f"Title {prose} Yes. {prose}".split())
    assert main_text.main_text(None) == main_text.main_text("") == main_text.main_text("<p") == ""
    assert main_text.main_text("<p>Hello <i>world</i>") == "Hello world"


def test_main_text_without_stop_words():
    menu = "<div id=menu><a href=a>One</a> <a href=b>Two</a></div>"
    prose = "This is the story of a man who went to the sea and of what he found there when he was old and all alone. " * 3
    russian = "Старый рыбак вышел утром далеко в море и долго ждал большую рыбу возле тёмной воды своего залива. " * 3
    chinese = "老渔夫清晨独自出海在湾流里等待一条大鱼直到夜里星星升起他仍然没有回家村里的孩子站在岸边看着远方的灯火。" * 2
    polish = "Stary rybak wypłynął rankiem daleko w morze czekając długo wielkiej ryby obok ciemnej wody swojej zatoki. " * 3
    for text in (russian, chinese, polish):
        page = f"<body>{menu}<h1>Head</h1><p>{text}</p><p>{text}</p><p><a href=x>{text}</a></p><p>Junk</p><p><a href=x>More</a></p>"
        assert main_text.main_text(page) == " ".join(f"Head {text} {text}".split())
        both = f"<body>{menu}<p>{text}</p><p>{text}</p><p><a href=s>Share</a></p><p>{prose}</p>"
        assert main_text.main_text(both) == " ".join(f"{text} {text} {prose}".split())
    code = "for item in range(10): print(item, item ** 2, sep=';'); " * 5
    assert main_text.main_text(f"{menu}<p>{prose}</p><pre>{code}</pre><p>{prose}</p>") == " ".join(f"{prose} {code} {prose}".split())
    assert main_text.main_text(f"{menu}<p>{prose}</p><p>\xa9 {prose}</p><p>\xa9 2020 A Company</p>") == " ".join(f"{prose} \xa9 {prose}".split())
    assert main_text.main_text(f"<p>{prose}</p><p>\xa9 2020 A</p><p>{prose}</p>") == " ".join(f"{prose} \xa9 2020 A {prose}".split())
    card = "<article><p>A card.</p></article>"
    assert main_text.main_text(f"<body>{menu}<p>{prose}</p>{card}<p>{prose}</p>") == " ".join(f"{prose} A card. {prose}".split())


def test_main_text_table(spark):
    pages = spark.createDataFrame([(1, PAGE, "u"), (1, PAGE, "u"), (2, None, "u"), (None, "", None)], "page_id long, html string, text string")
    out = main_text.extract(pages).collect()
    assert len(out) == 4 and {(r.page_id, r.n_chars) for r in out} == {(1, 60), (2, 0), (None, 0)}


def test_importance_sampling(spark):
    rnd = random.Random(2)
    good = ["sea", "ship", "wind", "harbour", "the", "of", "sail"]
    rows = [(i, " ".join(rnd.choice(good) for _ in range(40))) for i in range(300)]
    rows += [(i, " ".join(rnd.choice(good) + "***" for _ in range(40))) for i in range(300, 360)] + [(360, None), (361, ""), (None, "sea ship"), (1, rows[1][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 300), 0) for i in range(0, 360, 2)] + [(None, 1, 0), (4, None, 0)], "doc_id long, quality int, toxic int")
    ratios = importance.fit(docs, labels)
    scores = importance.score(docs, ratios)
    least = importance.threshold(scores)
    kept = {r.doc_id for r in importance.take(docs, ratios, least).collect()}
    assert kept >= set(range(300)) and not kept & set(range(300, 360))
    ten = importance.threshold(scores, 10)
    keys = sorted((r.place for r in scores.collect()), reverse=True)
    assert ten == keys[9]
    assert importance.take(docs, importance.fit(docs, labels.limit(0)), None).count() == 0


def test_toxic_labels_do_not_pull_the_offset(spark):
    rnd = random.Random(6)
    good, bad = ["sea", "ship", "wind", "harbour", "sail"], ["mud", "rot", "bile", "grime", "slag"]
    kinds = [(good, 1, 0)] * 150 + [(good + bad, 1, 1)] * 100 + [(bad, 0, 0)] * 100
    docs = spark.createDataFrame([(i, " ".join(rnd.choice(w) for _ in range(80))) for i, (w, _, _) in enumerate(kinds)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q, t) for i, (_, q, t) in enumerate(kinds)], "doc_id long, quality int, toxic int")
    ratios = importance.fit(docs, labels)
    kept = {r.doc_id for r in importance.take(docs, ratios, importance.threshold(importance.score(docs, ratios))).collect()}
    assert len(kept & set(range(150))) >= 145 and len(kept & set(range(150, 350))) <= 5


def test_empty_tables(spark, docs, vectors):
    none, no_vectors = docs.limit(0), vectors.limit(0)
    assert suffix_dedup.remove_repeats(none).count() == 0
    assert minhash_join.near_duplicates(none).count() == 0
    assert mixing.mixture(none).count() == 0
    assert byte_bpe.encode_texts(none, RANKS, public_tokenizers.PATTERN).count() == 0
    assert multi_index.nearest(no_vectors, no_vectors).count() == 0
    assert metric_join.near_vectors(no_vectors).count() == 0
    assert not importance.fit(none, spark.createDataFrame([], "doc_id long, quality int, toxic int")).any()
    assert chat.format_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
    assert main_text.extract(spark.createDataFrame([], "page_id long, html string")).count() == 0


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        made = stage(spark, docs, folder)
        made.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "tokens":
            assert docs.columns == before.columns
            assert docs.where("n_chars <> length(text)").isEmpty()
    assert docs.where("n_tokens <> size(ids)").isEmpty() and docs.count() == before.count()
    assert sorted(r.text for r in docs.collect()) == sorted(r.text for r in before.collect())


def test_near_vectors_in_rounds_and_parts(spark, monkeypatch):
    """Home vectors and members are cut apart, and rounds of pairs of parts together give the same rows."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] + rng.normal(size=8) * 0.12).tolist(), i % 2) for i in range(240)]
    df = spark.createDataFrame([*rows, *[(300 + i, r[1], r[2]) for i, r in enumerate(rows[:9])]], "vec_id long, embedding array<float>, label int")
    whole = sorted(map(tuple, metric_join.near_vectors(df).collect()))
    written = []
    monkeypatch.setattr(metric_join, "stored", lambda frame, label, put=metric_join.stored: written.append((label, frame.columns)) or put(frame, label))
    for name, value in (("PART", 24), ("PER_PIVOT", 40), ("ROUND_BYTES", 80000), ("HELD_COSINES", 50)):
        monkeypatch.setattr(metric_join, name, value)
    assert sorted(map(tuple, metric_join.near_vectors(df).collect())) == whole
    # Copies are written as names only.
    assert all("vector" not in columns for label, columns in written if label == "members")
    assert sum(label == "links" for label, _ in written) > 1
