"""Token ids of whole batches of texts under a tokenizer whose words end at white space.

Distinct words are found with Arrow, the tokenizer sees each distinct run of letters once, and
numpy puts the ids of all words one after another.
"""

from __future__ import annotations

import json
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tablewright.llm.words import word_spans

#: Runs of letters that a worker remembers with their ids.
MEMO_WORDS = 500_000
# The stages of the tokenizer file under which words may be encoded apart.
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_CLOSING = '!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'  # ASCII punctuation but the apostrophe, with which contractions begin
#: Letters whose lower case depends on the library.
_UNSURE = "[İΣ]"
#: Scripts in which a run of letters is in NFC anyway: Latin up to U+02FF, Cyrillic.
_COMPOSED = r"^[\x{0}-\x{2ff}\x{400}-\x{52f}]*$"


class Runs:
    """Sequences of ids one after another, with their bounds."""

    def __init__(self, values: np.ndarray, sizes: np.ndarray) -> None:
        self.values, self.sizes, self.begins = values, sizes, np.cumsum(sizes) - sizes

    @classmethod
    def of(cls, sequences: list[list[int]]) -> Runs:
        sizes = np.fromiter(map(len, sequences), np.int64, len(sequences))
        return cls(np.fromiter((i for s in sequences for i in s), np.uint32, int(sizes.sum())), sizes)

    def __add__(self, other: Runs) -> Runs:
        return Runs(np.concatenate([self.values, other.values]), np.concatenate([self.sizes, other.sizes]))

    def take(self, which: np.ndarray) -> Runs:
        sizes = self.sizes[which]
        begins = np.cumsum(sizes) - sizes
        place = np.repeat(self.begins[which] - begins, sizes) + np.arange(sizes.sum())
        return Runs(self.values[place], sizes)

    def joined(self, groups: np.ndarray) -> Runs:
        """Sequences groups[i] to groups[i + 1] as one."""
        bounds = np.r_[0, np.cumsum(self.sizes)][groups]
        return Runs(self.values, np.diff(bounds))


def _slices(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> pa.Array:
    """Slices of bytes as a text column."""
    at = np.r_[0, np.cumsum(size)]
    place = np.repeat(begin - at[:-1], size) + np.arange(at[-1])
    return pa.Array.from_buffers(pa.large_string(), len(size), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(data[place]))])


def _content(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column."""
    bounds = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, 8 * column.offset)
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), bounds


class WordTokens:
    """A worker's tokenizer, and the ids of runs of letters that it has seen.

    The tokenizer must normalise to NFC, fold to lower case and part runs of letters, digits and other
    characters. White space then parts words for good. Most words are letters and perhaps closing
    punctuation, and the tokenizer parts these too, so each is encoded once in lower case, thousands
    in one call. Whatever is not of this form is encoded word by word. Another kind of tokenizer
    encodes text by text.
    """

    def __init__(self, tokenizer_file: str) -> None:
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_str(tokenizer_file)
        # As the library's plain call: a special token's string in a text is that token.
        made = json.loads(tokenizer_file)
        normalizers = [n["type"] for n in (made.get("normalizer") or {}).get("normalizers", [])]
        stages = (made.get("pre_tokenizer") or {}).get("pretokenizers", [])
        suffix = made["model"].get("end_of_word_suffix")
        self.by_word = bool(
            suffix and normalizers == _NORMALIZERS and len(stages) == 2 and not made.get("post_processor")
            and stages[0].get("pattern") == {"Regex": _PATTERN} and stages[1]["type"] == "ByteLevel"
        )
        self.known, self.runs = pa.array([], pa.large_string()), Runs.of([])
        if self.by_word:
            # Runs of lower-case letters need no normaliser, and spaces part them.
            made["normalizer"], stages[0] = None, {"type": "WhitespaceSplit"}
            self.plain = Tokenizer.from_str(json.dumps(made))
            self.plain.encode_special_tokens = True
            vocabulary = self.full.get_vocab()
            self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
            self.closes[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> Runs:
        """The ids of each text; texts lie in `data` from offset to offset."""
        if not self.by_word:
            raw = data.tobytes()
            return self._whole([raw[a:b].decode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)])
        start, end, first = word_spans(data, offsets)
        words = _slices(data, start, end - start).dictionary_encode()
        return self._distinct(words.dictionary).take(words.indices.to_numpy().astype(np.int64)).joined(first)

    def _whole(self, texts: list[str]) -> Runs:
        found = Runs.of([])
        for at in range(0, len(texts), 4096):
            found += Runs.of([m.ids for m in self.full.encode_batch_fast(texts[at:at + 4096], add_special_tokens=False)])
        return found

    def _distinct(self, words: pa.Array) -> Runs:
        """The ids of each of some distinct words."""
        if not len(words):
            return Runs.of([])
        letters = pc.utf8_rtrim(words, characters=_CLOSING)
        sure = pc.and_(pc.utf8_is_alpha(letters), pc.invert(pc.match_substring_regex(letters, _UNSURE))).to_numpy(zero_copy_only=False)
        composed = pc.match_substring_regex(letters, _COMPOSED).to_numpy(zero_copy_only=False)
        check = np.flatnonzero(sure & ~composed)
        sure[check] = [unicodedata.is_normalized("NFC", w) for w in letters.take(pa.array(check)).to_pylist()]
        yes, no = np.flatnonzero(sure), np.flatnonzero(~sure)
        low = pc.utf8_lower(letters.take(pa.array(yes))).dictionary_encode()
        data, bounds = _content(words)
        size = pc.binary_length(letters).to_numpy()[yes]
        closing = _slices(data, bounds[yes] + size, bounds[yes + 1] - bounds[yes] - size).dictionary_encode()
        runs = self._letters(low.dictionary) + self._whole(closing.dictionary.to_pylist()) + self._whole(words.take(pa.array(no)).to_pylist())
        # Two parts a word: letters and closing, or a whole word and nothing.
        runs += Runs.of([[]])
        parts = np.full((len(words), 2), len(runs.sizes) - 1, np.int64)
        n_low, n_closing = len(low.dictionary), len(closing.dictionary)
        parts[yes, 0] = low.indices.to_numpy()
        parts[yes, 1] = n_low + closing.indices.to_numpy().astype(np.int64)
        parts[no, 0] = n_low + n_closing + np.arange(len(no))
        return runs.take(parts.reshape(-1)).joined(np.arange(0, 2 * len(words) + 1, 2))

    def _letters(self, words: pa.Array) -> Runs:
        """The ids of each of some distinct runs of lower-case letters."""
        new = words.filter(pc.is_null(pc.index_in(words, value_set=self.known)))
        if len(self.known) + len(new) > MEMO_WORDS:
            self.known, self.runs, new = words.slice(0, 0), Runs.of([]), words
        for at in range(0, len(new), 4096):
            self.runs += self._together(new.slice(at, 4096).to_pylist())
        self.known = pa.concat_arrays([self.known, new])
        return self.runs.take(pc.index_in(words, value_set=self.known).to_numpy().astype(np.int64))

    def _together(self, words: list[str]) -> Runs:
        (made,) = self.plain.encode_batch_fast([" ".join(words)], add_special_tokens=False)
        ids = np.array(made.ids, np.uint32)
        ends = np.flatnonzero(self.closes[ids]) + 1
        return Runs(ids, np.diff(ends, prepend=0)) if len(ends) == len(words) else self._whole(words)
