"""Token ids through a table of distinct words, and texts again through a table of pieces.

A word is what stands between ASCII white space. Texts are split where they lie, in chunks of
`CHUNK_BYTES`: a chunk keeps its distinct words, the commonest first, and for every place of its
texts the number of the word there. Only distinct words travel. They go to the bucket of their
hash, where equal words of all chunks meet and the tokenizer sees each word once; their ids go
back to the chunks that hold the word and are joined to its places. A common word sends one row a
chunk, so no word, source or document makes a task larger than the others.

Ids become text by a join with the piece table: its size is that of the tokenizer's vocabulary, so
it travels whole, addressed by id.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablewright.llm.common import block_count, by_block, from_ipc, mix, pack, partitions, text_bytes, to_ipc, unpack, with_fields
from tablewright.llm.word_tokens import Runs
from tablewright.llm.words import cut_batches, span_hashes, word_spans
from tablewright.session import scratch_path

#: Text of one chunk: what shares a list of distinct words.
CHUNK_BYTES = 8 << 20
#: Text whose places are worked out at a time.
PIECE_BYTES = 1 << 20
#: Text whose words fill one bucket of the word table.
BUCKET_BLOCKS = 16
#: Words whose ids a worker holds at a time.
SLICE_WORDS = 1 << 19
# The kinds of stages under which white space parts words for good.
_NORMALIZERS = {"NFC", "NFKC", "Replace", "Lowercase"}
_SPLITTERS = {"Split", "ByteLevel", "Whitespace", "WhitespaceSplit", "Punctuation", "Digits"}


def _slices(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> pa.Array:
    """Slices of bytes as a column of words."""
    at = np.r_[0, np.cumsum(size)]
    place = np.arange(at[-1])
    place += np.repeat(begin - at[:-1], size)
    return pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(data[place]))])


def _flat(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and bounds of a column of words."""
    if isinstance(words, pa.ChunkedArray):
        words = words.combine_chunks()
    bounds = np.frombuffer(words.buffers()[1], np.int64, len(words) + 1, 8 * words.offset)
    data = words.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), bounds


def _pack_words(words: pa.Array) -> bytes:
    data, bounds = _flat(words)
    sizes = pack([np.diff(bounds).astype("<u4")])
    return len(sizes).to_bytes(8, "little") + sizes + pack([data[bounds[0]:bounds[-1]]])


def _unpack_words(blob: bytes) -> pa.Array:
    n = 8 + int.from_bytes(blob[:8], "little")
    (sizes,), (data,) = unpack(blob[8:n], ["<u4"]), unpack(blob[n:], ["u1"])
    bounds = np.r_[0, np.cumsum(sizes, dtype=np.int64)]
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))])


def _pack_runs(runs: Runs) -> bytes:
    sizes = pack([runs.sizes.astype("<u4")])
    return len(sizes).to_bytes(8, "little") + sizes + pack([runs.values.astype("<u4")])


def _unpack_runs(blob: bytes) -> Runs:
    n = 8 + int.from_bytes(blob[:8], "little")
    (sizes,), (values,) = unpack(blob[8:n], ["<u4"]), unpack(blob[n:], ["<u4"])
    return Runs(values, sizes.astype(np.int64))


def _check(made: dict) -> None:
    """A tokenizer whose words depend on each other across white space is refused."""

    def kinds(stage: dict | None, inner: str) -> set[str]:
        return set() if not stage else {s["type"] for s in stage.get(inner, [stage])}

    splitters = kinds(made.get("pre_tokenizer"), "pretokenizers")
    white = any(t["lstrip"] or t["rstrip"] or set(t["content"]) & set(" \t\n\r\v\f") for t in made.get("added_tokens") or [])
    drops = any(
        s.get("type") == "WhitespaceSplit" or s.get("type") == "Whitespace" or (s.get("type") == "Split" and s.get("behavior") == "Removed")
        for s in (made.get("pre_tokenizer") or {}).get("pretokenizers", [made.get("pre_tokenizer") or {}])
    )
    if not (kinds(made.get("normalizer"), "normalizers") <= _NORMALIZERS and splitters <= _SPLITTERS and drops) or white or made.get("post_processor"):
        raise ValueError("the tokenizer does not drop white space between words, so words cannot be encoded apart")


def _chunks(rows: Iterator[pa.RecordBatch], text: str, buckets: int) -> Iterator[pa.RecordBatch]:
    """One row a chunk: its other columns, words per text, the word's number at every place, distinct words by bucket."""

    def emit() -> pa.RecordBatch:
        whole = pa.chunked_array([w for _, w, _, _ in held]).combine_chunks().dictionary_encode()
        number, at, count = whole.indices.to_numpy(), 0, np.zeros(len(whole.dictionary), np.int64)
        numbers = []
        for _, words, index, _ in held:
            numbers.append(number[at:at + len(words)])
            count += np.bincount(numbers[-1], np.bincount(index, minlength=len(words)), len(count)).astype(np.int64)
            at += len(words)
        # The commonest word gets number 0: small numbers pack well.
        by_count = np.argsort(-count, kind="stable")
        renumber = np.empty(len(by_count), "<u4")
        renumber[by_count] = np.arange(len(by_count))
        places = np.concatenate([renumber[n][index] for n, (_, _, index, _) in zip(numbers, held, strict=True)])
        words = whole.dictionary.take(pa.array(by_count))
        data, bounds = _flat(words)
        bucket = (mix(span_hashes(data, bounds[:-1], bounds[1:])) % np.uint64(buckets)).astype(np.int32)
        asked = [{"bucket": b, "words": _pack_words(words.take(pa.array(which)))} for b, (which,) in by_block(bucket, [np.arange(len(words))])]
        others = pa.Table.from_batches([b for b, _, _, _ in held])
        return pa.RecordBatch.from_pylist([{
            "chunk": uuid.uuid4().int >> 65, "others": to_ipc(others),
            "counts": pack([np.concatenate([c for _, _, _, c in held]).astype("<u4")]),
            "places": pack([places]), "bucket_of": pack([bucket.astype("<u4")]), "asked": asked,
        }], schema=out)

    out = pa.schema([
        ("chunk", pa.int64()), ("others", pa.binary()), ("counts", pa.binary()), ("places", pa.binary()), ("bucket_of", pa.binary()),
        ("asked", pa.list_(pa.struct([("bucket", pa.int32()), ("words", pa.binary())]))),
    ])
    held: list[tuple[pa.RecordBatch, pa.Array, np.ndarray, np.ndarray]] = []
    size = 0
    for batch, data, offsets in cut_batches(rows, text, PIECE_BYTES):
        start, end, first = word_spans(data, offsets)
        words = _slices(data, start, end - start).dictionary_encode()
        rest = batch.drop_columns([text])
        if not rest.num_columns:
            rest = pa.RecordBatch.from_arrays([pa.nulls(batch.num_rows)], ["_"])
        held.append((rest, words.dictionary, words.indices.to_numpy(), np.diff(first)))
        size += len(data)
        if size >= CHUNK_BYTES:
            yield emit()
            held, size = [], 0
    if held:
        yield emit()


def _encode_bucket(asked: pa.Table, tokenizer_file: str) -> pa.Table:
    """The ids of one bucket's words for every chunk that asked; each distinct word is encoded once."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(tokenizer_file)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    sets = [_unpack_words(w.as_py()) for w in asked["words"]]
    whole = pa.chunked_array(sets).combine_chunks().dictionary_encode()
    distinct = whole.dictionary.cast(pa.large_string())
    found = [_library(tokenizer, distinct.slice(at, 8192).to_pylist()) for at in range(0, len(distinct), 8192)]
    ids = Runs(np.concatenate([f.values for f in found]), np.concatenate([f.sizes for f in found]))
    number, at, answers = whole.indices.to_numpy().astype(np.int64), 0, []
    for words in sets:
        answers.append(_pack_runs(ids.take(number[at:at + len(words)])))
        at += len(words)
    return pa.table({"chunk": asked["chunk"], "bucket": asked["bucket"], "ids": pa.array(answers, pa.binary())})


def _library(tokenizer, words: list[str]) -> Runs:
    return Runs.of([m.ids for m in tokenizer.encode_batch_fast(words, add_special_tokens=False)])


def _expand(chunks: pa.Table, answers: pa.Table, out: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The ids of every text of one chunk, from its own row and the ids of its distinct words."""
    (chunk,) = chunks.to_pylist()
    runs = [_unpack_runs(row["ids"]) for row in sorted(answers.to_pylist(), key=lambda r: r["bucket"])]
    (bucket,), (place,), (counts,) = unpack(chunk["bucket_of"], ["<u4"]), unpack(chunk["places"], ["<u4"]), unpack(chunk["counts"], ["<u4"])
    found = Runs(np.concatenate([np.zeros(0, np.uint32), *(r.values for r in runs)]), np.concatenate([np.zeros(0, np.int64), *(r.sizes for r in runs)]))
    # Words lie in their bucket in the order of their numbers, so a stable sort by bucket undoes the split.
    back = np.empty(len(bucket), np.int64)
    back[np.argsort(bucket, kind="stable")] = np.arange(len(bucket))
    words = found.take(back)
    others = from_ipc([chunk["others"]])
    bounds = np.r_[0, np.cumsum(counts, dtype=np.int64)]
    at = 0
    while at < len(counts):
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + SLICE_WORDS, "right")) - 1)
        texts = words.take(place[bounds[at]:bounds[to]].astype(np.int64)).joined(bounds[at:to + 1] - bounds[at])
        ids = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(texts.sizes)].astype(np.int32)), pa.array(texts.values.astype(np.int32)))
        part = others.slice(at, to - at)
        columns = {f.name: part[f.name] for f in out if f.name in part.column_names}
        yield from pa.table({**columns, "n_tokens": pa.array(texts.sizes), "ids": ids}).cast(out).combine_chunks().to_batches()
        at = to


def encode_texts(docs: DataFrame, tokenizer_file: str, text: str = "text", decoded: str | None = None) -> DataFrame:
    """Every row with `n_tokens` and `ids` of its text instead of the text, as the tokenizers library encodes it without special tokens.

    With `decoded` the ids are decoded again into a column of that name, as `decode_ids` does, by
    the worker that has them.

    `tokenizer_file` is the content of a tokenizer file that drops white space between words;
    another one raises ValueError. Null and empty texts have no ids; ties and repeated rows are rows of their own; a
    text longer than a chunk is a chunk by itself; an empty table gives an empty table. Other
    columns stay, null or not, but for `n_tokens`, `ids` and the decoded text, which are replaced.
    """
    _check(json.loads(tokenizer_file))
    docs = docs.drop("n_tokens", "ids", *([decoded] if decoded else []))
    buckets = max(1, block_count(docs.sparkSession, text_bytes(docs, text)) // BUCKET_BLOCKS)
    rest = docs.drop(text)
    chunks = _in_buckets(
        docs.mapInArrow(
            lambda rows: _chunks(rows, text, buckets),
            "chunk long, others binary, counts binary, places binary, bucket_of binary, asked array<struct<bucket: int, words: binary>>",
        ),
        "chunk", max(partitions(docs.sparkSession), buckets),
    )
    asked = chunks.select("chunk", F.explode("asked").alias("a")).select(F.col("chunk").alias("chunk"), "a.bucket", "a.words")
    answers = asked.groupBy("bucket").applyInArrow(lambda group: _encode_bucket(group, tokenizer_file), "chunk long, bucket int, ids binary")
    schema = with_fields(rest.schema, "n_tokens long, ids array<int>")
    arrow = _arrow(schema)
    table = _piece_table(docs, tokenizer_file) if decoded else None
    if decoded:
        schema = with_fields(schema, f"{decoded} string")
    whole = _arrow(schema)

    def expand(chunk: pa.Table, found: pa.Table) -> pa.Table:
        rows = _expand(chunk, found, arrow)
        return pa.Table.from_batches(_join_pieces(rows, "ids", decoded, table.value) if decoded else rows, whole)

    # The chunks lie in buckets, so only the answers are shuffled to meet them.
    return chunks.drop("asked").groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(expand, schema)


def _in_buckets(df: DataFrame, key: str, n: int) -> DataFrame:
    """The frame written to the shared folder in at most 100,000 buckets of a key, and read back so that joins on the key need not move it.

    Spark knows of buckets through its catalog, where the table stays registered under a fresh name.
    """
    path = scratch_path(df.sparkSession, "chunks")
    name = "word_chunks_" + path.rsplit("-", 1)[1]
    df.write.bucketBy(min(n, 100_000), key).option("path", path).option("compression", "zstd").saveAsTable(name)
    return df.sparkSession.table(name)


def _arrow(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def pieces(tokenizer_file: str) -> list[str | None]:
    """The piece of every id; null where no id is."""
    from tokenizers import Tokenizer

    vocabulary = Tokenizer.from_str(tokenizer_file).get_vocab(with_added_tokens=True)
    out: list[str | None] = [None] * (max(vocabulary.values(), default=-1) + 1)
    for piece, i in vocabulary.items():
        out[i] = piece
    return out


def _join_pieces(rows: Iterator[pa.RecordBatch], ids: str, name: str, by_id: list[str | None]) -> Iterator[pa.RecordBatch]:
    """Each list's pieces, looked up by id and joined by a space; ids without a piece are left out."""
    table = pa.array(by_id, pa.large_string())
    for whole in rows:
        sizes = pc.fill_null(pc.list_value_length(whole.column(ids)), 0).to_numpy()
        bounds = np.r_[0, np.cumsum(sizes, dtype=np.int64)]
        at = 0
        while at < whole.num_rows:
            to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + (1 << 20), "right")) - 1)
            batch = whole.slice(at, to - at)
            found = pc.list_flatten(batch.column(ids))
            found = pc.if_else(pc.and_(pc.greater_equal(found, 0), pc.less(found, len(table))), found, pa.scalar(None, found.type))
            looked = table.take(found)
            first = (bounds[at:to + 1] - bounds[at]).astype(np.int64)
            if looked.null_count:
                keep = looked.is_valid().to_numpy(zero_copy_only=False)
                first, looked = np.r_[0, np.cumsum(keep)][first], looked.drop_null()
            lists = pa.LargeListArray.from_arrays(pa.array(first), looked)
            texts = pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*batch.schema.names, name])
            at = to


def _piece_table(df: DataFrame, tokenizer_file: str) -> Broadcast:
    """The piece table for the workers; a tokenizer with a decoder raises ValueError."""
    if json.loads(tokenizer_file).get("decoder"):
        raise ValueError("only tokenizers without a decoder are decoded")
    return df.sparkSession.sparkContext.broadcast(pieces(tokenizer_file))


def decode_ids(encoded: DataFrame, tokenizer_file: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """Every row with the text of its ids, as the library decodes them with special tokens kept.

    The piece table is joined by id and pieces in their order by a space, which is what a tokenizer without a decoder
    does; one with a decoder raises ValueError. Null and empty lists give an empty text, ids without
    a piece nothing. A column of the new name is replaced, all others stay.
    """
    table, encoded = _piece_table(encoded, tokenizer_file), encoded.drop(name)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _join_pieces(rows, ids, name, table.value)

    return encoded.mapInArrow(run, with_fields(encoded.schema, f"{name} string"))
