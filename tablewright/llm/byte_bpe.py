"""Byte-level BPE by recursive DuckDB queries: token rows contract pair by pair until nothing merges.

Each Python worker keeps one in-memory DuckDB with the merge table: every pair of tokens whose
joined bytes are a token, with its rank. The pieces of a batch that are not known yet become rows
of (word, position, token). A recursive query joins neighbouring rows with the merge table,
contracts each word's leftmost pair of minimum rank and drops finished words, until no pair is
left. Ordered aggregation gives each word's ids, and their bytes joined in order: the decoded word.
Known pieces are kept in a memo of bounded size, which saves work and changes no result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import with_fields
from tablewright.llm.words import cut_batches

#: Pieces that a worker remembers, and pieces that one recursive query takes.
MEMO_PIECES = 400_000
QUERY_PIECES = 50_000

_CONTRACT = """
WITH RECURSIVE steps(word, place, next, token, open) AS (
    SELECT word, place, place + 1, token, true FROM bytes_of_words
    UNION ALL (
        WITH now AS (SELECT * FROM steps WHERE open),
        pairs AS (
            SELECT a.word, a.place, a.next, b.next AS after_next, (rank::BIGINT << 32) + a.place AS ranked
            FROM now a JOIN now b ON a.next = b.place AND a.word = b.word JOIN merges ON joint = a.token::BIGINT * 4294967296 + b.token
        ),
        least AS (
            SELECT word, min(ranked) AS ranked, arg_min(place, ranked) AS spot, arg_min(next, ranked) AS gone,
                arg_min(after_next, ranked) AS after_next
            FROM pairs GROUP BY word
        )
        SELECT n.word, n.place, CASE WHEN n.place = spot THEN after_next ELSE n.next END,
            CASE WHEN n.place = spot THEN (ranked >> 32)::INT ELSE n.token END, spot IS NOT NULL
        FROM now n LEFT JOIN least l ON n.word = l.word WHERE gone IS NULL OR n.place <> gone
    )
)
SELECT word, place, token FROM steps WHERE NOT open UNION ALL SELECT word, place, token FROM whole_words
"""
_GATHER = f"""
SELECT word, list(token ORDER BY place) AS ids, unhex(string_agg(hex, '' ORDER BY place)) AS decoded
FROM ({_CONTRACT}) JOIN vocabulary USING (token) GROUP BY word ORDER BY word
"""


class Encoder:
    """One worker's merge table, patterns and memo."""

    def __init__(self, ranks_file: bytes, pattern: str) -> None:
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks_file.splitlines()) if a}
        # The pattern's white space is Unicode's.
        self.find = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall
        joints = [
            (left, right, rank)
            for token, rank in self.ranks.items()
            for i in range(1, len(token))
            if (left := self.ranks.get(token[:i])) is not None and (right := self.ranks.get(token[i:])) is not None
        ]
        left, right, rank = (np.array(c, "i8") for c in zip(*joints, strict=True)) if joints else (np.zeros(0, "i8"),) * 3
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB"})
        self._load("merges", pa.table({"joint": left * 2**32 + right, "rank": rank.astype("i4")}))
        self._load("vocabulary", pa.table({
            "token": pa.array(self.ranks.values(), pa.int32()), "hex": [t.hex() for t in self.ranks],
        }))
        self.byte_ids = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        self.ids: dict[str, bytes] = {}
        self.decoded: dict[str, bytes] = {}

    def _load(self, name: str, rows: pa.Table) -> None:
        self.db.register("incoming", rows)
        self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM incoming")
        self.db.unregister("incoming")

    def learn(self, pieces: set[str]) -> None:
        """Encode pieces that the memo does not hold."""
        new = [p for p in pieces if p not in self.ids]
        if len(self.ids) + len(new) > MEMO_PIECES:
            self.ids, self.decoded = {}, {}
            new = list(pieces)
        for at in range(0, len(new), QUERY_PIECES):
            self._contract(new[at:at + QUERY_PIECES])

    def _contract(self, pieces: list[str]) -> None:
        texts = [p.encode() for p in pieces]
        known = [self.ranks.get(t, -1) for t in texts]
        whole = [i for i, k in enumerate(known) if k >= 0]
        rest = [i for i, k in enumerate(known) if k < 0]
        size = np.array([len(texts[i]) for i in rest], np.int64)
        joined = np.frombuffer(b"".join([texts[i] for i in rest]), np.uint8)
        words = np.repeat(np.array(rest, np.int32), size)
        self.db.register("bytes_of_words", pa.table({"word": words, "place": np.arange(len(joined), dtype=np.int64), "token": self.byte_ids[joined]}))
        self.db.register("whole_words", pa.table({
            "word": pa.array(whole, pa.int32()), "place": pa.array(np.zeros(len(whole), np.int64)),
            "token": pa.array([known[i] for i in whole], pa.int32()),
        }))
        out = self.db.sql(_GATHER).to_arrow_table().combine_chunks()
        for name in ("bytes_of_words", "whole_words"):
            self.db.unregister(name)
        if not out.num_rows:
            return
        lists = out["ids"].chunk(0)
        ends = lists.offsets.to_numpy() * 4
        flat = lists.values.to_numpy().astype("<u4").tobytes()
        for word, a, b, text in zip(out["word"].to_pylist(), ends[:-1].tolist(), ends[1:].tolist(), out["decoded"].to_pylist(), strict=True):
            self.ids[pieces[word]] = flat[a:b]
            self.decoded[pieces[word]] = text


_encoders: dict[tuple[int, str], Encoder] = {}


def _encoder(ranks_file: bytes, pattern: str) -> Encoder:
    key = (hash(ranks_file), pattern)
    if key not in _encoders:
        _encoders[key] = Encoder(ranks_file, pattern)
    return _encoders[key]


def _encode(
    batches: Iterator[pa.RecordBatch], ranks_file: Broadcast, pattern: str, finish: Callable[[bytes, bytes], tuple], fields: pa.Schema
) -> Iterator[pa.RecordBatch]:
    encoder = _encoder(ranks_file.value, pattern)
    for batch, data, offsets in cut_batches(batches):
        raw = data.tobytes()
        pieces = [encoder.find(raw[a:b].decode()) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        encoder.learn({p for own in pieces for p in own})
        rows = [
            finish(b"".join(map(encoder.ids.__getitem__, own)), b"".join(map(encoder.decoded.__getitem__, own))) for own in pieces
        ]
        made = list(zip(*rows, strict=True))
        columns = [batch.column(i) for i, name in enumerate(batch.schema.names) if name != "text"]
        names = [name for name in batch.schema.names if name != "text"]
        columns += [pa.array(c, f.type) for c, f in zip(made, fields, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, [*names, *fields.names])


def _ids(ids: bytes, decoded: bytes) -> tuple:
    return len(ids) // 4, np.frombuffer(ids, "<u4").astype("i4"), decoded


def _digests(ids: bytes, decoded: bytes) -> tuple:
    return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()


_IDS = ("n_tokens long, ids array<int>, decoded binary", pa.schema([("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.binary())]))
_DIGESTS = (
    "n_tokens long, ids_sha256 string, decoded_sha256 string",
    pa.schema([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]),
)


def encode_texts(docs: DataFrame, ranks_path: str, pattern: str, text_column: str = "text", digests: bool = False) -> DataFrame:
    """The other columns of `docs` with n_tokens, ids (token ids of the whole text) and decoded (their bytes).

    With `digests` instead of the values: ids_sha256 (ids as little-endian unsigned 32-bit integers)
    and decoded_sha256. Each match of `pattern` is encoded by itself, by the ranks of a rank file
    (base64 token and rank per line); no special tokens. Null texts are empty and have no ids.
    Input columns with the names of results give way. Rows may repeat; each gets its own result.

    The rank file is read once by the driver and broadcast: it is a vocabulary of fixed size.
    """
    declared, fields = _DIGESTS if digests else _IDS
    with open(ranks_path, "rb") as f:
        ranks_file = docs.sparkSession.sparkContext.broadcast(f.read())
    others = [c for c in docs.columns if c not in {text_column, "text", *fields.names}]
    rows = docs.select(*others, F.col(text_column).alias("text"))
    schema = with_fields(docs.select(*others).schema, declared)
    finish = _digests if digests else _ids
    return rows.mapInArrow(lambda b: _encode(b, ranks_file, pattern, finish, fields), schema)
