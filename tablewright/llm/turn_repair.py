"""Repair of damaged conversations: the cheapest edits to turns that alternate.

Rows are dealt by conversation and sorted by turn; `mapInPandas` streams a partition's rows and
carries the state of a dynamic program from batch to batch: the cheapest cost of each of four ends
(nothing yet, a system turn, a user turn, an assistant turn). Every row leaves three bytes of
backpointers: which edits and insertions tie for the cheapest. They and the rows' texts go to
temporary files of the task once they pass `SPOOL_BYTES`. Read backward, the backpointers show
which ends lie on a cheapest path; read forward again, the first edit by its letter among those is
taken at each step. Choosing by letter while going forward would not do: of two beginnings of
different length the better one depends on what follows.

Which rows repeat an earlier one is known by 128 bits of each row; sorted runs of these also move
to a temporary file. So a conversation of any length needs a bounded amount of memory besides its audit.
"""

from __future__ import annotations

import hashlib
import re
import struct
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import partitions

#: What one conversation keeps in memory of backpointers and of texts, and how many digests of rows, before files take them.
SPOOL_BYTES, DIGESTS = 8 << 20, 200_000
#: Rows whose backpointers are read at a time.
BLOCK_ROWS = 1 << 16
#: Costs of the edits; `TRUNCATED` is added to a row that stays though it is cut short.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

START, SYSTEM, USER, ASSISTANT = range(4)
_NEVER = 1 << 60
#: The end after a user or assistant turn that may follow each end.
_NEXT = (USER, USER, ASSISTANT, USER)
_NAME = {USER: "user", ASSISTANT: "assistant"}
_BLANK = "\\x20\\x09-\\x0D"
_LAST = re.compile(f"[^{_BLANK}](?=[{_BLANK}]*\\Z)")
#: Of one row: ties of the place before it, its cheapest ways.
_ROW, _ROW_BYTES = "<BH", 3
_FITS = ("su", "ua", "au")

RESULT = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string, n_rows long, n_repaired long"
)


class Seen:
    """Digests met so far; full sets become sorted runs in temporary files."""

    def __init__(self) -> None:
        self.now: set[bytes] = set()
        self.runs: list[np.ndarray] = []

    def add(self, digest: bytes) -> bool:
        """Whether the digest was there before."""
        if digest in self.now or any(self._holds(run, digest) for run in self.runs):
            return True
        self.now.add(digest)
        if len(self.now) >= DIGESTS:
            file = tempfile.TemporaryFile()
            np.sort(np.frombuffer(b"".join(self.now), ">u8,>u8")).tofile(file)
            file.flush()
            self.runs.append(np.memmap(file, ">u8,>u8", "r"))
            self.now = set()
        return False

    @staticmethod
    def _holds(run: np.ndarray, digest: bytes) -> bool:
        wanted = np.frombuffer(digest, ">u8,>u8")[0]
        at = int(np.searchsorted(run, wanted))
        return at < len(run) and run[at] == wanted


def target(end: int, letter: str, initial: str) -> int | None:
    """The end that an edit of a row leads to; none if the row may not be kept there."""
    if letter == "D":
        return end
    if letter == "R":
        return _NEXT[end]
    if initial == "s":
        return SYSTEM if end == START else None
    return _NEXT[end] if initial == _NAME[_NEXT[end]][0] else None


class Program:
    """The transitions of the dynamic program. Only differences of costs matter and they are few, so each is worked out once."""

    def __init__(self) -> None:
        self._gap: dict = {}
        self._step: dict = {}
        self._letters: dict = {}

    def gap(self, cost: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
        """Costs after insertions at one place, and the ties: low bits where none was needed, high bits where one leads on.

        Two insertions at one place suffice: a third comes back to an end that was cheaper before.
        """
        if cost not in self._gap:
            best = list(cost)
            for _ in range(2):
                for end in range(4):
                    best[_NEXT[end]] = min(best[_NEXT[end]], best[end] + INSERT)
            ties = sum(1 << end for end in range(4) if best[end] == cost[end])
            ties |= sum(16 << end for end in range(4) if best[_NEXT[end]] == best[end] + INSERT)
            self._gap[cost] = tuple(best), ties
        return self._gap[cost]

    def step(self, cost: tuple[int, ...], initial: str, must_go: bool, cut: bool) -> tuple[tuple[int, ...], int]:
        """Costs after a row, and a bit for each (end, letter) that is a cheapest way to where it leads; the top bit: a system row."""
        key = (cost, initial if initial in ("s", "u", "a") else "", must_go, cut)
        if key not in self._step:
            ways = []
            for end in range(4):
                for k, letter in enumerate("DKR"):
                    to = target(end, letter, initial)
                    if to is not None and (letter == "D" or not must_go):
                        price = {"D": DELETE, "K": 0, "R": REROLE}[letter] + (TRUNCATED if cut and letter != "D" else 0)
                        ways.append((to, cost[end] + price, 3 * end + k))
            after = tuple(min([c for to, c, _ in ways if to == end], default=_NEVER) for end in range(4))
            self._step[key] = after, sum(1 << bit for to, c, bit in ways if c == after[to] and c < _NEVER) | (initial == "s") << 15
        return self._step[key]

    def letters(self, ways: int, good: int) -> tuple[str, ...]:
        """For each end before a row the letters of the cheapest ways from it to good ends after the row."""
        key = ways << 4 | good
        if key not in self._letters:
            found = []
            for end in range(4):
                to = (end, SYSTEM if ways >> 15 and end == START else _NEXT[end], _NEXT[end])
                found.append("".join(x for k, x in enumerate("DKR") if ways >> (3 * end + k) & 1 and good >> to[k] & 1))
            self._letters[key] = tuple(found)
        return self._letters[key]


def _closed(good: int, ties: int) -> int:
    """Ends of a place that lead to good ends of it by insertions."""
    for _ in range(2):
        for end in range(4):
            if ties >> (4 + end) & 1 and good >> _NEXT[end] & 1:
                good |= 1 << end
    return good


class Conversation:
    """One conversation's rows, fed in the order of their turns."""

    def __init__(self, program: Program) -> None:
        self.program = program
        self.base, self.cost = 0, (0, _NEVER, _NEVER, _NEVER)
        self.back, self.texts = (tempfile.SpooledTemporaryFile(max_size=SPOOL_BYTES) for _ in range(2))
        self.seen = Seen()
        self.rows = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low: int | None = None
        self.high: int | None = None
        self.before = ""

    def feed(self, turn: int | None, role: str, text: str) -> None:
        if turn is not None and turn != self.high:
            self.turns, self.high = self.turns + 1, turn
            self.low = turn if self.low is None else self.low
        initial = role[:1]
        self.illegal += self.rows > 0 and self.before + initial not in _FITS
        self.before, self.rows = initial, self.rows + 1
        name, raw = role.encode(), text.encode()
        head = struct.pack("<QQ", len(name), len(raw)) + name
        seen = self.seen.add(hashlib.blake2b(head + raw, digest_size=16).digest())
        last, cut = _LAST.search(text), False
        if last is None:
            self.blank += 1
        elif seen:
            self.duplicate += 1
        elif last[0] not in ".!?":
            self.truncated, cut = self.truncated + 1, True
        opened, ties = self.program.gap(self.cost)
        after, ways = self.program.step(opened, initial, last is None or seen, cut)
        self.back.write(struct.pack(_ROW, ties, ways))
        self.texts.write(head + raw)
        least = min(after)
        self.base, self.cost = self.base + least, tuple(c - least if c < _NEVER else c for c in after)

    def _good(self) -> tuple[int, int, int, tempfile.SpooledTemporaryFile]:
        """Cheapest cost, ties and good ends of the last place, and per row the good ends at the place before it and after it."""
        opened, ties = self.program.gap(self.cost)
        cost = min(opened[START], opened[ASSISTANT])
        last = _closed(sum(1 << end for end in (START, ASSISTANT) if opened[end] == cost), ties)
        good, path = last & ties, tempfile.SpooledTemporaryFile(max_size=SPOOL_BYTES)
        for to in range(self.rows, 0, -BLOCK_ROWS):
            first = max(0, to - BLOCK_ROWS)
            self.back.seek(first * _ROW_BYTES)
            block, out = list(struct.iter_unpack(_ROW, self.back.read((to - first) * _ROW_BYTES))), bytearray(to - first)
            for k in range(to - first - 1, -1, -1):
                before, ways = block[k]
                leading = self.program.letters(ways, good)
                here = _closed(sum(1 << end for end in range(4) if leading[end]), before)
                out[k] = here | good << 4
                good = here & before & 15
            path.seek(first)
            path.write(out)
        return self.base + cost, ties, last, path

    def result(self) -> tuple:
        """The values of `RESULT`."""
        cost, last_ties, last_good, path = self._good()
        digest, audit, end, kept = hashlib.sha256(), bytearray(), START, 0

        def say(role: bytes, text: bytes) -> None:
            nonlocal kept
            digest.update((b"\n" if kept else b"") + role + b":" + text)
            kept += 1

        def insert() -> None:
            nonlocal end
            end = _NEXT[end]
            audit.append(ord("I"))
            say(_NAME[end].encode(), b"")

        for spool in (self.back, self.texts, path):
            spool.seek(0)
        for at in range(0, self.rows, BLOCK_ROWS):
            rows, marks = self.back.read(BLOCK_ROWS * _ROW_BYTES), path.read(BLOCK_ROWS)
            for (ties, ways), mark in zip(struct.iter_unpack(_ROW, rows), marks, strict=True):
                role_size, text_size = struct.unpack("<QQ", self.texts.read(16))
                role, text = self.texts.read(role_size), self.texts.read(text_size)
                letters = self.program.letters(ways, mark >> 4)
                while letters[end][:1] != "D" and ties >> (4 + end) & 1 and mark >> _NEXT[end] & 1:
                    insert()
                letter = letters[end][0]
                audit.append(ord(letter))
                if letter == "R":
                    role = _NAME[_NEXT[end]].encode()
                if letter != "D":
                    end = SYSTEM if letter == "K" and ways >> 15 and end == START else _NEXT[end]
                    say(role, text)
        while last_ties >> (4 + end) & 1 and last_good >> _NEXT[end] & 1:
            insert()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (
            gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit.decode(), digest.hexdigest(), self.rows, kept,
        )


def _stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per conversation of a sorted partition; a conversation goes on from batch to batch."""
    names = ["key", *(f.split()[0] for f in RESULT.split(", "))]
    key, now, done, program = None, None, [], Program()
    for batch in batches:
        for this, turn, role, text, present in batch.itertuples(index=False):
            if now is None or this != key:
                if now is not None:
                    done.append((key, *now.result()))
                key, now = this, Conversation(program)
            if present:
                now.feed(None if turn is None else int(turn), role, text)
        if done:
            yield pd.DataFrame(done, columns=names)
            done = []
    if now is not None:
        yield pd.DataFrame([(key, *now.result())], columns=names)


def repair(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", present: str | None = None
) -> DataFrame:
    """Faults of every conversation, its cheapest repair as one letter per edit, and the digest of the repaired turns.

    A repaired conversation is empty or an optional system turn and then pairs of user and
    assistant. K keeps a row, R gives it the role user or assistant, D deletes it (the only edit of
    blank rows and of rows that repeat an earlier role and text), I inserts an empty turn. Of equally
    cheap repairs the one whose letters come first in ASCII is taken.

    Rows are ordered by turn (null first), then role and text; a null role or text is one space; rows without a conversation id
    are one conversation. With `present` rows where that column is not true only name their
    conversation: one without other rows has zeros and an empty audit. An empty table gives an
    empty table; texts and conversations may be of any length; other columns are not looked at.
    """
    key_type = rows.schema[conv].dataType
    chosen = rows.select(
        F.col(conv).cast("string").alias("key"), F.col(turn).cast("long").alias("at"), F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"), (F.coalesce(F.col(present), F.lit(False)) if present else F.lit(True)).alias("present"),
    )
    dealt = chosen.repartition(partitions(rows.sparkSession), "key").sortWithinPartitions("key", F.asc_nulls_first("at"), "role", "text")
    # As text, whole numbers keep all digits beside nulls.
    streamed = dealt.withColumn("at", F.col("at").cast("string")).mapInPandas(_stream, f"key string, {RESULT}")
    return streamed.withColumn("key", F.col("key").cast(key_type)).withColumnRenamed("key", conv)
