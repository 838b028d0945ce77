"""Encoding with the vocabulary of a public byte-level BPE tokenizer, by prefix dynamic programming.

For each byte prefix of a pre-token the one token that ends its encoding is stored; an encoding is
read off backwards. A candidate is the last token of a prefix if it forms a compatible pair with the
last token of the prefix before it, that is if no merge across their seam would have come earlier
than the merges that made them. Appending only extends the table, and after an edit the table is
recomputed until it agrees with the old one over the length of the longest token.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Where the public vocabularies lie; a parameter of everything here.
FOLDER = "/opt/tokenizers"
#: Pre-tokens of the byte-level vocabularies (public).
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pre-tokens remembered by a worker, and the longest that it remembers.
REMEMBERED, LONGEST = 200_000, 64
BYTES = 256


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file: itself if printable, else one from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in shown}
    rest = (b for b in range(BYTES) if b not in set(shown))
    return letters | {chr(BYTES + n): b for n, b in enumerate(rest)}


class Vocabulary:
    """The tokens, their merges and the automaton that finds the tokens ending at each byte."""

    def __init__(self, path: str) -> None:
        import ahocorasick

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        letter = _byte_letters()
        ids, merges = model["vocab"], model["merges"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        self.left = dict.fromkeys(range(BYTES), -1)
        self.right = dict(self.left)
        self.merged: dict[int, int] = {}
        raw = {i: t.translate({ord(c): b for c, b in letter.items()}) for t, i in ids.items() if all(c in letter for c in t)}
        used = {t: i for i, t in raw.items() if len(t) == 1}
        for n, (a, b) in enumerate(pairs):
            token = ids[a + b]
            if token != BYTES + n:
                raise ValueError("ids must follow the order of the merges")
            self.left[token], self.right[token] = ids[a], ids[b]
            self.merged[ids[a] << 32 | ids[b]] = token
            used[raw[token]] = token
        self.longest = max(map(len, used))
        self.find = ahocorasick.Automaton()
        for text, token in used.items():
            self.find.add_word(text, (len(text), token))
        self.find.make_automaton()
        self._compatible: dict[int, bool] = {}

    def compatible(self, a: int, b: int) -> bool:
        """Whether the encoding of the bytes of ``a`` and ``b`` together is just ``a, b``."""
        key = a << 32 | b
        known = self._compatible.get(key)
        if known is None:
            if len(self._compatible) > 2_000_000:
                self._compatible.clear()
            known = self._compatible[key] = self._seam_holds(a, b)
        return known

    def _seam_holds(self, a: int, b: int) -> bool:
        # Time runs backwards: of the tokens at the seam the one made last is taken apart. A merge of
        # what then meets there must not be earlier; at the same rank the one further left is first.
        before = 1 << 62
        while True:
            if self.merged.get(a << 32 | b, before) < before:
                return False
            if a > b:
                if a < BYTES:
                    return True
                before, a = a, self.right[a]
            else:
                if b < BYTES:
                    return True
                before, b = b + 1, self.left[b]


class Prefixes:
    """The table of the last tokens of all prefixes of one pre-token; it can grow and be edited."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b"") -> None:
        self.vocabulary, self.text = vocabulary, ""
        self.last: list[int] = [-1]  # by the length of the prefix
        self.size: list[int] = [0]
        self.append(data)

    def _extend(self, text: str, start: int, last: list[int], size: list[int]) -> Iterator[int]:
        """Adds the entry of each further prefix of ``text``; yields the length that each is for."""
        v = self.vocabulary
        back = max(0, start - v.longest)
        ends = v.find.iter(text, back) if back else v.find.iter(text)
        at, candidates = -1, []
        for end, (length, token) in ends:
            end += 1
            if end <= start or end - length < back:
                continue
            if end != at:
                if candidates:
                    self._choose(at, candidates, last, size)
                    yield at
                at, candidates = end, []
            candidates.append((length, token))
        if candidates:
            self._choose(at, candidates, last, size)
            yield at

    def _choose(self, end: int, candidates: list[tuple[int, int]], last: list[int], size: list[int]) -> None:
        for length, token in candidates:
            if length == end or self.vocabulary.compatible(last[end - length], token):
                last.append(token)
                size.append(length)
                return
        raise AssertionError("a prefix has no last token")

    def append(self, data: bytes) -> None:
        start, self.text = len(self.text), self.text + data.decode("latin-1")
        for _ in self._extend(self.text, start, self.last, self.size):
            pass

    def replace(self, start: int, end: int, data: bytes) -> int:
        """Puts ``data`` in place of the bytes from ``start`` to ``end``; the number of entries computed anew."""
        old_last, old_size = self.last, self.size
        text = self.text[:start] + data.decode("latin-1") + self.text[end:]
        shift = len(text) - len(self.text)
        last, size = old_last[: start + 1], old_size[: start + 1]
        same = done = 0
        if len(text) == start:
            self.text, self.last, self.size = text, last, size
            return 0
        for at in self._extend(text, start, last, size):
            done += 1
            was = at - shift
            inside = was > end and size[at] <= at - (start + len(data))
            same = same + 1 if inside and (last[at], size[at]) == (old_last[was], old_size[was]) else 0
            if same >= self.vocabulary.longest:
                last += old_last[was + 1 :]
                size += old_size[was + 1 :]
                break
        self.text, self.last, self.size = text, last, size
        return done

    def ids(self) -> list[int]:
        out, at = [], len(self.text)
        while at:
            out.append(self.last[at])
            at -= self.size[at]
        return out[::-1]


class Encoder:
    """Encodes texts; pre-tokens that were met before are looked up."""

    def __init__(self, path: str) -> None:
        import regex

        self.vocabulary = Vocabulary(path)
        self.split = regex.compile(PATTERN).findall
        self.known: dict[str, array] = {}

    def word(self, text: str) -> array:
        found = self.known.get(text)
        if found is None:
            found = array("i", Prefixes(self.vocabulary, text.encode()).ids())
            if len(text) <= LONGEST:
                if len(self.known) >= REMEMBERED:
                    self.known.clear()
                self.known[text] = found
        return found

    def encode(self, text: str | None) -> array:
        """The ids of ``text``, without special tokens; none for an empty or null text."""
        out = array("i")
        for word in self.split(text or ""):
            out.extend(self.word(word))
        return out

    def count(self, text: str | None) -> int:
        return sum(len(self.word(word)) for word in self.split(text or ""))


@lru_cache(2)
def encoder(path: str) -> Encoder:
    """One encoder per worker and vocabulary."""
    return Encoder(path)


def vocabulary_path(name: str, folder: str = FOLDER) -> str:
    return f"{folder}/{name}.json"


def encode_texts(df: DataFrame, row_id: str, text: str, vocabulary: str = "byte_bpe_50k", folder: str = FOLDER) -> DataFrame:
    """``row_id`` and ``ids`` of each row; empty and null texts have an empty list. Other columns are dropped.

    Repeated rows come out again, and a very long text costs time in proportion to its length.
    """
    path, kind = vocabulary_path(vocabulary, folder), dict(df.dtypes)[row_id]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for batch in batches:
            for part in range(0, len(batch), 1000):
                some = batch.slice(part, 1000)
                flat, ends = array("i"), [0]
                for t in some.column(1).to_pylist():
                    flat.extend(e.encode(t))
                    ends.append(len(flat))
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(flat, np.int32) if flat else [], pa.int32()))
                yield pa.RecordBatch.from_arrays([some.column(0), ids], [row_id, "ids"])

    return df.select(row_id, text).mapInArrow(run, f"`{row_id}` {kind}, ids array<int>")


def token_counts(df: DataFrame, row_id: str, text: str, vocabulary: str = "byte_bpe_50k", folder: str = FOLDER) -> DataFrame:
    """``row_id`` and ``tokens``, the number of ids of each row: 0 for empty and null texts."""
    path, kind = vocabulary_path(vocabulary, folder), dict(df.dtypes)[row_id]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(e.count, batch.column(1).to_pylist()), pa.int64())], [row_id, "tokens"])

    return df.select(row_id, text).mapInArrow(run, f"`{row_id}` {kind}, tokens long")
