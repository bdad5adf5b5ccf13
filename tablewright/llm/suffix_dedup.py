"""Exact removal of repeated passages: a run-length suffix index over the places where texts part.

A byte goes if a `length`-byte string that covers it also starts earlier in the corpus (smaller
id, or same document and smaller start). The corpus is never sorted suffix by suffix:

1. `anchors`: every window of `length` bytes names the smallest-hashed k-gram inside it. Equal
   windows name equal k-grams, so windows need to meet only where their k-grams do. Runs of
   windows that name the same k-gram are one row: a hash of the k-gram and one of the run's text.
2. `_settle`: equal runs (all but the first) repeat as a whole, k-grams seen once repeat nothing.
   What remains are first runs whose k-gram has other texts around it, where matches begin and end.
3. `run_index`: for these the texts themselves are gathered by k-gram. A run-length
   Burrows-Wheeler transform with the suffix positions at run ends gives, streamed over the text,
   each suffix's longest match with its neighbour; matches of `length` or more chain equal windows.
4. `_cut`: the marked windows return to their documents.

k-grams with very many different runs (a line that most documents share) are met window by
window instead: the same rows, spread by the hash of the whole window and reduced to one row per
task before they move. A row of the list of such k-grams stands for at least `HOT_RUNS` runs, and the
list has at most 2^20 rows.

Hashes have 64 bits; a k-gram and a run hash have to agree together, so 128 bits decide.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import (
    block_count, by_block, byte_column, from_ipc, mix, pack, spread, text_bytes, to_ipc, unpack_all, with_fields,
)
from tablewright.sources.tables import stored

#: Different runs around one k-gram from which its windows are met one by one.
HOT_RUNS = 2000
#: Of these, so many in one batch of documents make a k-gram a candidate.
HOT_IN_BATCH = 8

_rng = np.random.default_rng(20240229)
_BYTE_CODE = _rng.integers(0, 2**64, 256, dtype=np.uint64)
_LEVEL_CODE = _rng.integers(0, 2**64, 40, dtype=np.uint64) | np.uint64(1)
_STEP = 1 << 17  # window starts worked on at a time: arrays that stay in cache
_PLACE = np.uint64((1 << 20) - 1)

_RUN = ("u8", "u8", "i8", "i4", "i8", "i4")  # k-gram, run, document, copy, start, windows
_MARK = ("u8", "i8", "i4", "i8", "i4", "u1")  # k-gram, document, copy, start, windows, 1: to be compared
_SPAN = ("i8", "i4", "i8", "i4")  # document, copy, start, windows


def _power_of_two(n: int) -> int:
    return 1 << (n.bit_length() - 1)


def _gram_hashes(data: np.ndarray, widths: set[int]) -> dict[int, np.ndarray]:
    """Hashes of all substrings of the given widths (powers of two), by start."""
    h, width, level, out = _BYTE_CODE[data], 1, 0, {}
    while True:
        if width in widths:
            out[width] = h
        if width >= max(widths):
            return out
        h = h[:-width] * _LEVEL_CODE[level] + h[width:]
        width, level = 2 * width, level + 1


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while 2 * have <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[: len(x) - (width - have)], x[width - have:]) if width > have else x


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, hot: np.ndarray) -> list[np.ndarray]:
    """Runs of windows by their k-gram: k-gram hash, run hash, document's place, start in it, windows.

    For a k-gram in the sorted array `hot` each window is a run of its own.
    """
    gram, wide = _power_of_two(max(1, length // 2)), _power_of_two(length)
    choices, parts = length - gram + 1, []
    begins, ends = offsets[:-1], offsets[1:]
    for low in range(0, max(0, len(data) - length + 1), _STEP):
        part = data[low:low + _STEP + length - 1]
        hashes = _gram_hashes(part, {gram, wide})
        h = mix(hashes[gram])
        named = _sliding_min((h & ~_PLACE) | np.arange(len(h), dtype=np.uint64), choices) & _PLACE
        named = named.astype(np.int64)
        n = len(named)
        # Windows that reach over a document's end are none.
        first, last = np.searchsorted(ends, [low + 1, low + n + length], "left")
        near = slice(first, min(last + 1, len(ends)))
        over = np.zeros(n + 1, np.int32)
        np.add.at(over, np.clip(np.maximum(begins[near], ends[near] - length + 1) - low, 0, n), 1)
        np.add.at(over, np.clip(ends[near] - low, 0, n), -1)
        named[np.cumsum(over[:n]) > 0] = -1
        change = np.r_[True, named[1:] != named[:-1]]
        edges = begins[near] - low
        change[edges[(edges >= 0) & (edges < n)]] = True
        start = np.flatnonzero(change)
        end = np.r_[start[1:], n] - 1
        keep = named[start] >= 0
        start, end = start[keep], end[keep]
        key = h[named[start]]
        w = hashes[wide]

        def window(at: np.ndarray, w: np.ndarray = w) -> np.ndarray:
            return mix(w[at]) + w[at + (length - wide)]

        if len(hot):
            is_hot = hot[np.minimum(np.searchsorted(hot, key), len(hot) - 1)] == key
            each = np.where(is_hot, end - start + 1, 1)
            of = np.repeat(np.arange(len(start)), each)
            within = np.arange(len(of)) - np.repeat(np.cumsum(each) - each, each)
            single = is_hot[of]
            start = start[of] + np.where(single, within, 0)
            end = np.where(single, start, end[of])
            key = np.where(single, mix(window(start) ^ _LEVEL_CODE[39]), key[of])
        run = mix(mix(window(start)) + window(end) * np.uint64(3) + (end - start).astype(np.uint64))
        doc = np.searchsorted(offsets, start + low, "right") - 1
        parts.append((key, run, doc, start + low - offsets[doc], (end - start + 1).astype(np.int32)))
    if not parts:
        return [np.zeros(0, k) for k in ("u8", "u8", "i8", "i8", "i4")]
    return [np.concatenate(c) for c in zip(*parts, strict=True)]


def _batches(rows: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Batches cut so that their texts hold some MB (a longer text stays whole)."""
    for batch in rows:
        data, offsets = byte_column(batch.column(text))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + (8 << 20), "right")) - 1)
            yield batch.slice(at, to - at), data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at]
            at = to


def _busy_grams(rows: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Different runs per k-gram of a batch, where there are several; and, without k-gram, the number of all runs."""
    for _, data, offsets in _batches(rows, "text"):
        key, run, *_ = anchors(data, offsets, length, np.zeros(0, "u8"))
        every = np.unique(np.stack([key, run], 1).view("u8,u8")) if len(key) else np.zeros(0, "u8,u8")
        grams, counts = np.unique(every["f0"], return_counts=True)
        busy = counts >= HOT_IN_BATCH
        yield pa.RecordBatch.from_arrays(
            [pa.array([None, *grams[busy].view("i8").tolist()], pa.int64()), pa.array([len(key), *counts[busy].tolist()], pa.int64())],
            ["gram", "runs"],
        )


def _identified(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return batch.column("_ord").to_numpy(zero_copy_only=False).astype("i8"), batch.column("_copy").to_numpy(
        zero_copy_only=False
    ).astype("i4")


def _runs(rows: Iterator[pa.RecordBatch], length: int, hot: np.ndarray, blocks: int) -> Iterator[pa.RecordBatch]:
    """The runs of each batch by block of their k-gram; of equal runs in a batch only the first has to be met."""
    for batch, data, offsets in _batches(rows, "text"):
        key, run, doc, start, n = anchors(data, offsets, length, hot)
        if not len(key):
            continue
        ids, copies = _identified(batch)
        ids, copies = ids[doc], copies[doc]
        order = np.lexsort((start, copies, ids, run, key))
        key, run, ids, copies, start, n = (c[order] for c in (key, run, ids, copies, start, n))
        again = np.r_[False, (key[1:] == key[:-1]) & (run[1:] == run[:-1])]
        block, kind, blobs = [], [], []
        for repeated in (False, True):
            rows_of = again == repeated
            columns = [c[rows_of] for c in (key, run, ids, copies, start, n)]
            # Repeats only pass through: their block is dealt by document.
            for b, part in by_block(spread(columns[2 if repeated else 0].view("i8"), blocks), columns):
                if repeated:
                    part[0], part[1] = np.zeros_like(part[0]), np.zeros_like(part[1])
                block.append(b)
                kind.append(int(repeated))
                blobs.append(pack(part))
        yield pa.RecordBatch.from_arrays([pa.array(block, pa.int32()), pa.array(kind, pa.int32()), pa.array(blobs, pa.binary())], ["block", "kind", "blob"])


def _blocks(ids: np.ndarray, columns: list[np.ndarray], blocks: int) -> pd.DataFrame:
    rows = [(b, pack(c)) for b, c in by_block(spread(ids, blocks), columns)]
    return pd.DataFrame(rows, columns=["block", "blob"]).astype({"block": "int32"})


def _settle(rows: pd.DataFrame, blocks: int) -> pd.DataFrame:
    """Runs that repeat an earlier one as a whole, and runs that share their k-gram with other runs, by document block."""
    key, run, ids, copies, start, n = unpack_all(rows.blob[rows.kind == 0].tolist(), _RUN)
    by_key = np.argsort(key)
    sorted_key = key[by_key]
    same = sorted_key[1:] == sorted_key[:-1]
    shared = by_key[np.r_[False, same] | np.r_[same, False]] if len(key) else by_key
    key, run, ids, copies, start, n = (c[shared] for c in (key, run, ids, copies, start, n))
    order = np.lexsort((start, copies, ids, run, key))
    key, run, ids, copies, start, n = (c[order] for c in (key, run, ids, copies, start, n))
    new_key = np.r_[True, key[1:] != key[:-1]][: len(key)]
    new_run = new_key | np.r_[True, run[1:] != run[:-1]][: len(key)]
    group = np.cumsum(new_key) - 1
    texts = np.bincount(group, new_run) if len(key) else np.zeros(0)
    compare = new_run & (texts[group] > 1) if len(key) else new_run
    used = ~new_run | compare
    _, _, ids1, copies1, start1, n1 = unpack_all(rows.blob[rows.kind == 1].tolist(), _RUN)
    marks = [
        np.r_[np.where(compare, key, np.uint64(0))[used], np.zeros(len(ids1), "u8")], np.r_[ids[used], ids1],
        np.r_[copies[used], copies1], np.r_[start[used], start1], np.r_[n[used], n1],
        np.r_[compare[used].astype("u1"), np.zeros(len(ids1), "u1")],
    ]
    return _blocks(marks[1], marks, blocks)


def _packed_documents(rows: Iterator[pa.RecordBatch], blocks: int) -> Iterator[pa.RecordBatch]:
    """Documents gathered by block, compressed: how texts travel."""
    for batch, _, _ in _batches(rows, "text"):
        ids, _ = _identified(batch)
        whole = pa.Table.from_batches([batch])
        out = [(b, to_ipc(whole.take(pa.array(at)))) for b, (at,) in by_block(spread(ids, blocks), [np.arange(len(ids))])]
        yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in out], pa.int32()), pa.array([x for _, x in out], pa.binary())], ["block", "blob"])


def _place_of(docs: pa.Table, ids: np.ndarray, copies: np.ndarray) -> np.ndarray:
    """Row of each (document, copy) in the block."""
    own = np.rec.fromarrays([docs["_ord"].to_numpy().astype("i8"), docs["_copy"].to_numpy().astype("i8")])
    order = np.argsort(own, order=["f0", "f1"])
    # Ranks of both sides among the block's documents.
    values, first = np.unique(own[order], return_index=True)
    wanted = np.rec.fromarrays([ids, copies.astype("i8")])
    return order[first[np.searchsorted(values, wanted)]]


def _texts_to_compare(docs: pd.DataFrame, marks: pd.DataFrame, length: int, blocks: int) -> pd.DataFrame:
    """The text around each run that has to be compared, by block of its k-gram."""
    key, ids, copies, start, n, compare = unpack_all(marks.blob.tolist(), _MARK)
    chosen = compare == 1
    key, ids, copies, start, n = (c[chosen] for c in (key, ids, copies, start, n))
    if not len(key):
        return pd.DataFrame({"block": np.zeros(0, "i4"), "blob": []})
    whole = from_ipc(docs.blob.tolist())
    data, offsets = byte_column(whole["text"])
    at = offsets[_place_of(whole, ids, copies)] + start
    rows = []
    for b, (i,) in by_block(spread(key.view("i8"), blocks), [np.arange(len(key))]):
        size = n[i] + (length - 1)
        index = np.repeat(at[i] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        header = pack([key[i], ids[i], copies[i], start[i], n[i]])
        rows.append((b, len(header).to_bytes(8, "little") + header + pack([data[index]])))
    return pd.DataFrame(rows, columns=["block", "blob"]).astype({"block": "int32"})


def suffix_order(text: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Rank of every suffix of many strings at once; `left` is the distance to the string's own end mark.

    End marks are smaller than all bytes and ordered by place. Prefix doubling from seven symbols;
    only suffixes that are still tied are sorted again.
    """
    n = len(text)
    symbol = np.where(left > 0, text.astype(np.uint64) + np.uint64(1), np.uint64(0))
    padded = np.concatenate([symbol, np.zeros(7, np.uint64)])
    key = np.zeros(n, np.uint64)
    for j in range(7):
        key = (key << np.uint64(9)) | np.where(left >= j, padded[j:j + n], np.uint64(0))
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    # A suffix that ends within seven symbols is settled by its place: the stable sort has it.
    new = np.r_[True, (sorted_key[1:] != sorted_key[:-1]) | (left[order][1:] < 7)]
    first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = first
    size = np.diff(np.r_[np.flatnonzero(new), n])
    tied = order[np.repeat(size > 1, size)]
    step = 7
    while len(tied):
        key = (rank[tied] << 32) | rank[tied + step]
        by = np.argsort(key)
        tied, key = tied[by], key[by]
        old = key >> 32
        group = np.r_[True, old[1:] != old[:-1]]
        new = np.r_[True, key[1:] != key[:-1]]
        places = np.arange(len(tied))
        begin = np.maximum.accumulate(np.where(group, places, 0))
        first = np.maximum.accumulate(np.where(new, places, 0))
        rank[tied] = old + (first - begin)
        size = np.diff(np.r_[np.flatnonzero(new), len(tied)])
        tied = tied[np.repeat(size > 1, size)]
        step *= 2
    return rank


def _common_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> np.ndarray:
    out, open_, done, wide = np.minimum(limit, 0), np.arange(len(a)), 0, 8
    padded = np.concatenate([text, np.zeros(64, text.dtype)])
    out = limit.copy()
    while len(open_):
        steps = np.arange(wide)
        differ = padded[(a[open_] + done)[:, None] + steps] != padded[(b[open_] + done)[:, None] + steps]
        hit = differ.any(1)
        found = done + differ.argmax(1)
        out[open_[hit]] = np.minimum(limit[open_[hit]], found[hit])
        open_ = open_[~hit & (limit[open_] > done + wide)]
        done, wide = done + wide, 32
        # Gather indices never leave the padding: rows beyond their limit are closed.
    return out


def run_index(text: np.ndarray, sizes: np.ndarray, length: int) -> np.ndarray:
    """Which windows of `length` bytes also start earlier, for strings that follow one another in corpus order.

    Returns a flag for every byte of the concatenated strings, set at starts of repeated windows.
    The index is the run-compressed Burrows-Wheeler transform: only at run ends are the suffix
    position, its neighbour and their common prefix kept. Streaming over the text, the sample at or
    before a byte gives that byte's neighbour and match length.
    """
    ends = np.cumsum(sizes + 1)
    n = int(ends[-1]) if len(sizes) else 0
    if not n:
        return np.zeros(0, bool)
    begins = ends - sizes - 1
    left = np.repeat(ends - 1, sizes + 1) - np.arange(n)
    whole = np.zeros(n, np.uint8)
    whole[left > 0] = text
    rank = suffix_order(whole, left)
    suffix = np.empty(n, np.int64)
    suffix[rank] = np.arange(n)
    # The symbol before each suffix; before a whole string stands its own mark, which starts a run.
    before = np.where(suffix > 0, whole[suffix - 1].astype(np.int16), -1)
    is_begin = np.zeros(n, bool)
    is_begin[begins] = True
    head = np.r_[True, (before[1:] != before[:-1]) | is_begin[suffix[1:]] | is_begin[suffix[:-1]]]
    heads = np.flatnonzero(head)
    sample, neighbour = suffix[heads], suffix[np.maximum(heads - 1, 0)]
    common = _common_prefix(whole, sample, neighbour, np.minimum(left[sample], left[neighbour]))
    common[heads == 0] = 0
    by_place = np.argsort(sample)
    sample, neighbour, common = sample[by_place], neighbour[by_place], common[by_place]
    sampled = np.zeros(n, np.int64)
    sampled[sample] = 1
    last = np.cumsum(sampled) - 1
    distance = np.arange(n) - sample[last]
    match = common[last] - distance >= length
    place = np.flatnonzero(match)
    # Chains of equal windows: every window leads to its neighbour, the first of a chain to itself.
    root = np.arange(n)
    root[place] = neighbour[last[place]] + distance[place]
    while True:
        further = root[root[place]]
        if (further == root[place]).all():
            break
        root[place] = further
    earliest = np.arange(n)
    np.minimum.at(earliest, root[place], place)
    heads_of = np.unique(root[place])
    repeated = np.zeros(n, bool)
    repeated[place] = earliest[root[place]] < place
    repeated[heads_of] = earliest[heads_of] < heads_of
    return repeated[left > 0]


def _compare(rows: pd.DataFrame, length: int, blocks: int) -> pd.DataFrame:
    """Repeated windows among the gathered texts, by document block."""
    headers, texts = [], []
    for blob in rows.blob:
        cut = 8 + int.from_bytes(blob[:8], "little")
        headers.append(blob[8:cut])
        texts.append(unpack(blob[cut:])[0])
    key, ids, copies, start, n = unpack_all(headers, ("u8", "i8", "i4", "i8", "i4"))
    text, size = np.concatenate(texts), n.astype(np.int64) + (length - 1)
    offset = np.cumsum(size) - size
    out = []
    # Strings meet by k-gram; an index takes some MB of whole k-gram groups, in corpus order.
    by_key = np.argsort(key, kind="stable")
    new = np.flatnonzero(np.r_[True, key[by_key][1:] != key[by_key][:-1]])
    volume = np.add.reduceat(size[by_key], new)
    share = (np.cumsum(volume) - volume) // (2 << 20)
    cuts = np.r_[new[np.flatnonzero(np.r_[True, share[1:] != share[:-1]])], len(key)]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        i = by_key[a:b]
        i = i[np.lexsort((start[i], copies[i], ids[i]))]
        index = np.repeat(offset[i] - (np.cumsum(size[i]) - size[i]), size[i]) + np.arange(size[i].sum())
        repeated = np.flatnonzero(run_index(text[index], size[i], length))
        if not len(repeated):
            continue
        string = np.searchsorted(np.cumsum(size[i]), repeated, "right")
        within = repeated - (np.cumsum(size[i]) - size[i])[string]
        first = np.flatnonzero(np.r_[True, (string[1:] != string[:-1]) | (within[1:] != within[:-1] + 1)])
        many = np.diff(np.r_[first, len(string)]).astype("i4")
        of = i[string[first]]
        out.append((ids[of], copies[of], start[of] + within[first], many))
    spans = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, k) for k in _SPAN]
    return _blocks(spans[0], spans, blocks)


def unpack(blob: bytes) -> list[np.ndarray]:
    return unpack_all([blob], ("u1",))


def _cut(docs: pd.DataFrame, marks: pd.DataFrame, length: int, schema: pa.Schema) -> pa.Table:
    """Each document of the block with what is left of it."""
    whole = from_ipc(docs.blob.tolist())
    if whole is None:
        return schema.empty_table()
    _, ids, copies, start, n, compare = unpack_all(marks.blob[marks.kind == 0].tolist(), _MARK)
    settled = compare == 0
    found = unpack_all(marks.blob[marks.kind == 1].tolist(), _SPAN)
    ids, copies, start, n = (np.r_[a[settled], b] for a, b in zip((ids, copies, start, n), found, strict=True))
    data, offsets = byte_column(whole["text"])
    depth = np.zeros(len(data) + 1, np.int32)
    if len(ids):
        at = offsets[_place_of(whole, ids, copies)] + start
        np.add.at(depth, at, 1)
        np.add.at(depth, at + n + (length - 1), -1)
    gone = np.cumsum(depth[:-1]) > 0
    begins, ends = offsets[:-1], offsets[1:]
    total = np.r_[0, np.cumsum(gone)]
    opens = gone & ~np.r_[False, gone[:-1]][: len(gone)]
    opens[begins[(begins < len(gone))]] = gone[begins[(begins < len(gone))]]
    spans = np.r_[0, np.cumsum(opens)]
    left = [data[a:b][~gone[a:b]].tobytes() for a, b in zip(begins, ends, strict=True)]
    texts: list[str] = []
    if "kept" in schema.names:
        character = np.cumsum((data & 0xC0) != 0x80) - 1
        harmed = np.zeros(int(character[-1]) + 1 if len(data) else 0, bool)
        harmed[character[gone]] = True
        whole_left = ~harmed[character]
        texts = [data[a:b][whole_left[a:b]].tobytes().decode() for a, b in zip(begins, ends, strict=True)]
    columns = {
        "n_bytes": ends - begins, "n_removed": total[ends] - total[begins], "n_spans": spans[ends] - spans[begins],
        "kept_sha256": [hashlib.sha256(x).hexdigest() for x in left], "kept": texts,
    }
    return pa.table([pa.array(columns[f.name], f.type) if f.name in columns else whole[f.name].cast(f.type) for f in schema], schema=schema)


def remove_repeats(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", length: int = 100, keep_text: bool = False
) -> DataFrame:
    """Every document with the bytes that remain once repeated `length`-byte strings are cut.

    Adds n_bytes, n_removed, n_spans, kept_sha256 (of the remaining bytes) and, with `keep_text`,
    the remaining text as `kept`, without characters that lost a byte. The text column itself is
    left out; input columns with the names of results give way.

    Null texts are empty. A null id counts as the smallest. Rows that repeat an id are separate
    documents, ordered by their text. Documents shorter than `length` stay whole.
    """
    spark = docs.sparkSession
    made = ["n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if keep_text else [])]
    extra = [c for c in docs.columns if c not in {text_column, *made, "_ord", "_copy", "text"}]
    numbered = docs.select(
        F.coalesce(F.col(id_column).cast("long"), F.lit(-(2**63))).alias("_ord"), F.lit(0).alias("_copy"),
        F.col(text_column).alias("text"), *extra,
    )
    if not numbered.groupBy("_ord").count().where("count > 1").isEmpty():
        numbered = numbered.withColumn("_copy", F.row_number().over(Window.partitionBy("_ord").orderBy("text")))
    texts = numbered.select("_ord", "_copy", "text")

    busy = stored(
        texts.select("text").mapInArrow(lambda rows: _busy_grams(rows, length), "gram long, runs long")
        .groupBy("gram").agg(F.sum("runs").alias("runs")).where(f"gram is null or runs >= {HOT_RUNS}"), "busy"
    )
    runs = busy.where("gram is null").select("runs").first()
    limit = max(HOT_RUNS, (runs[0] if runs else 0) >> 20)
    hot = np.sort(np.array([r[0] for r in busy.where(f"gram is not null and runs >= {limit}").select("gram").collect()], "i8").view("u8"))

    blocks = block_count(spark, text_bytes(texts, "text"))
    marks = stored(
        texts.mapInArrow(lambda rows: _runs(rows, length, hot, blocks), "block int, kind int, blob binary")
        .groupBy("block").applyInPandas(lambda rows: _settle(rows, blocks), "block int, blob binary"), "marks"
    )
    packed = texts.mapInArrow(lambda rows: _packed_documents(rows, blocks), "block int, blob binary")
    found = (
        packed.groupBy("block").cogroup(marks.groupBy("block"))
        .applyInPandas(lambda d, m: _texts_to_compare(d, m, length, blocks), "block int, blob binary")
        .groupBy("block").applyInPandas(lambda rows: _compare(rows, length, blocks), "block int, blob binary")
    )
    every = marks.withColumn("kind", F.lit(0)).unionByName(found.withColumn("kind", F.lit(1)))
    schema = with_fields(
        docs.select(*extra).schema, "n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept string" * keep_text
    )
    arrow = pa.schema([_arrow_field(f) for f in schema])
    packed = numbered.mapInArrow(lambda rows: _packed_documents(rows, blocks), "block int, blob binary")
    return (
        packed.groupBy("block").cogroup(every.groupBy("block"))
        .applyInArrow(lambda d, m: _cut(d.to_pandas(), m.to_pandas(), length, arrow), schema)
    )


def _arrow_field(field) -> pa.Field:
    from pyspark.sql.pandas.types import to_arrow_type

    return pa.field(field.name, to_arrow_type(field.dataType))
