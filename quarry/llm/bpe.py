"""Byte-level BPE on numpy arrays: pre-tokens, and merging of many sequences in step by rank."""

from __future__ import annotations

import json
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import regex

from quarry.llm.textnp import _power_tables, mix

#: Fixed values of the public byte-level BPE vocabularies: the pattern that splits text before merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The same split for texts of Latin characters only, in which the classes of the faster module mean the same.
_LATIN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
_NOT_LATIN = re.compile("[^\x00-\x1b\x20-\xb1\xb4-\xb8\xba\xbb\xbf-ɏ]")
_ANY = regex.compile(PATTERN)
_NONE = np.int32(2**31 - 1)


def pre_tokens(text: str) -> list[str]:
    return (_ANY if _NOT_LATIN.search(text) else _LATIN).findall(text)


#: Classes of Latin characters: letter, digit, other, white space.
_CLASS = np.array([3 if chr(c).isspace() else 0 if chr(c).isalpha() else 1 if chr(c).isdecimal() else 2 for c in range(0x250)], np.uint8)
_CONTRACTED = re.compile("'(?:[stmd]|re|ve|ll)")


def is_plain(text: str) -> bool:
    """Whether plain_tokens splits the text as the pattern does: Latin characters, none of the pattern's endings after an apostrophe."""
    return not (_NOT_LATIN.search(text) or "'" in text and _CONTRACTED.search(text))


def plain_tokens(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
    """Pre-tokens of texts for which is_plain holds: all texts joined, where tokens begin and end in it, and tokens of each text.

    A token is a run of one class. A space before a run of letters, digits or other signs belongs to it; of longer
    white space before a run the last character stands alone or, if a space, goes with the run.
    """
    joined = "".join(texts)
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    n = len(points)
    stops = np.cumsum([len(t) for t in texts], dtype=np.int64)
    if not n:
        return joined, stops[:0], stops[:0], np.zeros(len(texts), np.int64)
    kind = _CLASS[points]
    first = np.empty(n, bool)
    first[0] = True
    first[1:] = kind[1:] != kind[:-1]
    inner = stops[stops < n]
    text_start = np.zeros(n, bool)
    text_start[0] = True
    text_start[inner] = True
    first |= text_start
    # white space that a run of its text follows: its last character parts from the rest, and a space joins the run
    run = np.flatnonzero(first[1:] & (kind[1:] != 3) & (kind[:-1] == 3) & ~text_start[1:]) + 1
    first[run - 1] = True
    first[run[points[run - 1] == 0x20]] = False
    begin = np.flatnonzero(first)
    counts = np.diff(np.r_[0, np.searchsorted(begin, stops)])
    return joined, begin, np.r_[begin[1:], n], counts


def token_hashes(joined: str, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each token."""
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    power, inverse = _power_tables(len(points) + 1)
    sums = np.zeros(len(points) + 1, np.uint64)
    np.cumsum((points.astype(np.uint64) + np.uint64(1)) * power[: len(points)], out=sums[1:])
    return mix((sums[end] - sums[begin]) * inverse[begin] + (end - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte: itself if printable, else the next free one from U+0100."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class RankMerger:
    """Counts the symbols that BPE leaves of each pre-token.

    All pre-tokens of a call lie end to end in one array of symbol ids. In each round every sequence applies
    its own lowest-ranked pair, at all places where it stands, left to right; sequences without a known pair
    leave the arrays. A merge makes a symbol that only later ranks use, so this equals one merge at a time.
    """

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        symbols = byte_symbols()
        self.byte_id = np.array([vocab[symbols[b]] for b in range(256)], np.int64)
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int64)
        self._build((left << 32) | right)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        h = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)

    def _build(self, keys: np.ndarray) -> None:
        """An open-addressed table of pairs, so that a round looks all pairs up at once."""
        self.bits = max(4, int(len(keys) * 8).bit_length())
        size = 1 << self.bits
        self.keys, self.ranks = np.full(size, -1, np.int64), np.full(size, _NONE, np.int32)
        todo, at, self.probes = np.arange(len(keys)), self._slot(keys), 0
        while len(todo):
            self.probes += 1
            spot = at[todo] & (size - 1)
            free = self.keys[spot] < 0
            _, first = np.unique(np.where(free, spot, -1), return_index=True)
            first = first[free[first]]
            self.keys[spot[first]], self.ranks[spot[first]] = keys[todo[first]], todo[first]
            left = np.ones(len(todo), bool)
            left[first] = False
            todo = todo[left]
            at[todo] += 1

    def rank(self, keys: np.ndarray) -> np.ndarray:
        at, mask = self._slot(keys), len(self.keys) - 1
        out = np.where(self.keys[at] == keys, self.ranks[at], _NONE)
        rest = np.flatnonzero((out == _NONE) & (self.keys[at] >= 0))
        for k in range(1, self.probes):
            if not len(rest):
                break
            spot = (at[rest] + k) & mask
            hit = self.keys[spot] == keys[rest]
            out[rest[hit]] = self.ranks[spot[hit]]
            rest = rest[~hit & (self.keys[spot] >= 0)]
        return out

    def counts(self, tokens: list[bytes]) -> np.ndarray:
        lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        result = lengths.copy()
        ids = self.byte_id[np.frombuffer(b"".join(tokens), np.uint8)]
        of = np.repeat(np.arange(len(tokens)), lengths)
        rank = self._pair_ranks(ids, of)
        while len(ids) > 1:
            begin = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
            sizes = np.diff(np.r_[begin, len(ids)])
            best = np.minimum.reduceat(rank, begin)
            live = best != _NONE
            if not live.all():
                result[of[begin[~live]]] = sizes[~live]
                stay = np.repeat(live, sizes)
                ids, of, rank, best, sizes = ids[stay], of[stay], rank[stay], best[live], sizes[live]
                if not len(ids):
                    return result
            chosen = np.flatnonzero(rank == np.repeat(best, sizes))
            run = np.r_[True, chosen[1:] != chosen[:-1] + 1]  # overlapping places: every second one, from the left
            within = np.arange(len(chosen)) - np.maximum.accumulate(np.where(run, np.arange(len(chosen)), 0))
            chosen = chosen[within % 2 == 0]
            ids[chosen] = self.merged[rank[chosen]]
            stay = np.ones(len(ids), bool)
            stay[chosen + 1] = False
            ids, of = ids[stay], of[stay]
            rank = self._pair_ranks(ids, of)
        if len(ids):
            result[of] = 1
        return result

    def _pair_ranks(self, ids: np.ndarray, of: np.ndarray) -> np.ndarray:
        """The rank of the pair that begins at each symbol."""
        out = np.full(len(ids), _NONE, np.int32)
        if len(ids) > 1:
            both = np.flatnonzero(of[:-1] == of[1:])
            out[both] = self.rank((ids[both] << 32) | ids[both + 1])
        return out


class Vocabulary:
    """A byte-level BPE file: its merger, and the special strings that its library cuts out of texts first."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            found = json.load(f)
        model = found["model"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.vocab = model["vocab"]
        self.merger = RankMerger(model["vocab"], pairs)
        self.special = {x["content"]: x["id"] for x in found.get("added_tokens", [])}
        self._cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def pieces(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens of a text, and how many special strings it holds."""
        if self._cut is None or not any(s in text for s in self.special):
            return pre_tokens(text), 0
        parts = self._cut.split(text)
        return list(chain.from_iterable(map(pre_tokens, parts[::2]))), len(parts) // 2

    def parts(self, text: str) -> list[str]:
        """The text cut at special strings, which stand at odd places."""
        if self._cut is None or not any(s in text for s in self.special):
            return [text]
        return self._cut.split(text)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)
