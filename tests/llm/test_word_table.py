"""Ids through the table of distinct words against the library's own calls."""

from __future__ import annotations

import random
from pathlib import Path

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tablewright.llm import word_table

FILE = Path(public_tokenizers.path("word_bpe_49k.json")).read_text()


def texts() -> list[str | None]:
    rnd = random.Random(11)
    odd = ["naïve", "ΣΑΣ", "İstanbul", "été", "汉字テスト", "don't", "x1y22", "<|endoftext|>", "a<|startoftext|>b", " wide gap", "…", "🙂🙂",
           "ﬁne", "'s't", "́lone", "a\x00b", "#!?..", "क्षत्रिय"]
    out: list[str | None] = [None, "", " \n\t ", "the", "the the  the\n", "<|endoftext|>", "x" * 5000]
    for _ in range(120):
        out.append(rnd.choice(["", " ", "\n"]).join(rnd.choice([*odd, " ", "plain", "word."]) for _ in range(rnd.randint(1, 30))))
        out.append(" ".join(rnd.choice([*odd, "the", "of"]) for _ in range(rnd.randint(1, 60))))
    return out + out[3:9]


@pytest.mark.parametrize("chunk", [200, 8 << 20])
def test_ids_and_texts_are_the_library_s(spark, monkeypatch, chunk):
    monkeypatch.setattr(word_table, "CHUNK_BYTES", chunk)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = [(i if i % 7 else None, t, "kept", i) for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, chunk long")
    encoded = word_table.encode_texts(docs, FILE)
    assert encoded.columns == ["doc_id", "chunk", "n_tokens", "ids"]
    got = {r.chunk: r for r in word_table.decode_ids(encoded, FILE).collect()}
    assert len(got) == len(rows)
    assert {r.chunk: r for r in word_table.encode_texts(docs, FILE, decoded="decoded").collect()} == got
    for doc, text, _, i in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert (got[i].doc_id, got[i].n_tokens, got[i].ids) == (doc, len(ids), ids)
        assert got[i].decoded == library.decode(ids, skip_special_tokens=False)


def test_lists_of_ids_without_pieces(spark):
    rows = [(1, None), (2, []), (3, [320, 10**8, -1, 49407]), (4, [320, None, 320])]
    out = word_table.decode_ids(spark.createDataFrame(rows, "k long, ids array<int>"), FILE).collect()
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert {r.k: r.decoded for r in out} == {1: "", 2: "", 3: library.decode([320, 49407], skip_special_tokens=False), 4: library.decode([320, 320])}


def test_empty_table_and_other_tokenizers(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert word_table.decode_ids(word_table.encode_texts(none, FILE), FILE).count() == 0
    with pytest.raises(ValueError, match="white space"):
        word_table.encode_texts(none, Path(public_tokenizers.path("byte_bpe_50k.json")).read_text())
    with pytest.raises(ValueError, match="decoder"):
        word_table.decode_ids(none, Path(public_tokenizers.path("byte_bpe_50k.json")).read_text())
