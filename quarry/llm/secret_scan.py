"""Secret scans: one deterministic automaton for all rules, run over many stretches of text in step; each end leads back to its start."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quarry.llm.automaton import Automaton, fold_part, parse, reverse
from quarry.llm.common import id_and_text, text_pieces
from quarry.llm.textnp import buffers

# The base rules. The first part of assign takes letters in either case.
ASSIGN = (r"(password|passwd|secret|token|api_?key)", r"[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]+")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{8,}"  # the same maximal runs as of one digit or more, without a report for each short one
#: Further kinds, whose spans come beside the base ones.
MORE = {
    "private_key": r"-----BEGIN [A-Z ]*PRIVATE KEY-----",
    "github": r"gh[opsu]_[A-Za-z0-9]+",
    "slack": r"xox[abprs]-[A-Za-z0-9-]+",
}
#: Fewest characters of a span, and for assign of the assigned value; a shorter match is dropped.
LEAST = {"assign": 6, "access": 20, "hex": 24, "private_key": 1, "github": 40, "slack": 15}
BASE = ("assign", "access", "hex")
KINDS = (*BASE, *MORE)
#: Stretches of about so many bytes run beside each other.
STRETCH = 512


class Scanner:
    """All rules in one forward automaton that reports ends; one backward automaton for each rule finds the start."""

    def __init__(self):
        trees = [fold_part(*ASSIGN), parse(ACCESS), parse(HEX), *map(parse, MORE.values())]
        self.forward = Automaton(trees)
        self.backward = [self._walk_back(Automaton([reverse(t)], anywhere=False)) for t in trees]
        self.flat = self.forward.next.reshape(-1)
        self.accepts = self.forward.accepts
        self.some = self.accepts > 0
        # after these bytes every state is the start: texts can be cut there without loss
        self.resets = (self.forward.next == 0).all(axis=0)

    @staticmethod
    def _walk_back(a: Automaton) -> tuple[list[list[int]], list[int], int]:
        """Transitions, accepting states, and the state that nothing leads out of."""
        dead = [k for k in range(len(a.next)) if not a.accepts[k] and (a.next[k] == k).all()]
        return a.next.tolist(), a.accepts.tolist(), dead[0] if dead else -1

    def stretches(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges that cover the texts; each begins where the automaton is in its start state."""
        safe = np.flatnonzero(self.resets[raw]) + 1
        goals = np.arange(STRETCH, len(raw), STRETCH)
        at = np.searchsorted(safe, goals)
        cuts = np.unique(np.r_[offsets[:-1], safe[at[at < len(safe)]]])
        cuts = cuts[cuts < len(raw)]
        return cuts, np.r_[cuts[1:], len(raw)]

    def ends(self, raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(stretch, rule, end within it) of each maximal run of accepting places of a rule, by stretch and end: one step of all stretches at a time, the longest first."""
        order = np.argsort(begin - end, kind="stable")
        at, length = begin[order], (end - begin)[order]
        state = np.zeros(len(order), np.int64)
        seen: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64),) * 3]
        live = np.searchsorted(-length, -np.arange(int(length[0]) if len(length) else 0), side="left")
        for step, n in enumerate(live.tolist()):
            now = self.flat[state[:n] * 256 + raw[at[:n] + step]]
            state[:n] = now
            hit = np.flatnonzero(self.some[now])
            if len(hit):
                seen.append((order[hit], np.full(len(hit), step), self.accepts[now[hit]]))
        stretch, step, rules = (np.concatenate(x) for x in zip(*seen, strict=True))
        by_place = np.lexsort((step, stretch))
        stretch, step, rules = stretch[by_place], step[by_place], rules[by_place]
        goes_on = np.zeros(len(step), bool)
        goes_on[:-1] = (stretch[1:] == stretch[:-1]) & (step[1:] == step[:-1] + 1)
        following = np.where(goes_on, np.r_[rules[1:], np.zeros(min(1, len(rules)), np.int64)], 0)
        gone = rules & ~following
        found = [np.flatnonzero(gone >> k & 1) for k in range(len(KINDS))]
        rule = np.repeat(np.arange(len(KINDS)), [len(x) for x in found])
        place = np.concatenate(found)
        order = np.lexsort((rule, step[place], stretch[place]))
        return stretch[place][order], rule[order], step[place][order] + 1

    def start(self, rule: int, piece: bytes, end: int, least: int) -> int:
        """The leftmost start of a match of the rule that ends at `end` and begins at `least` or later; -1 if none. Walks back over the match alone: beyond it the automaton is dead."""
        table, accepts, dead = self.backward[rule]
        state, found = 0, -1
        for k in range(end - 1, least - 1, -1):
            state = table[state][piece[k]]
            if state == dead:
                break
            if accepts[state]:
                found = k
        return found

    def spans(self, raw: np.ndarray, offsets: np.ndarray) -> list[list[tuple[int, int, int]]]:
        """For each text (start, rule, end) of the leftmost matches of each rule that do not overlap, in bytes."""
        begin, end = self.stretches(raw, offsets)
        out: list[list[tuple[int, int, int]]] = [[] for _ in offsets[1:]]
        here, piece, after, base, own = -1, b"", [], 0, out
        for k, rule, e in zip(*(x.tolist() for x in self.ends(raw, begin, end)), strict=True):
            if k != here:
                here, piece, after = k, raw[begin[k] : end[k]].tobytes(), [0] * len(KINDS)
                doc = int(np.searchsorted(offsets, begin[k], side="right")) - 1
                base, own = int(begin[k] - offsets[doc]), out[doc]
            s = self.start(rule, piece, e, after[rule])
            if s < 0:
                continue
            after[rule] = e
            if (e - s if rule else _value_length(piece, s, e)) >= LEAST[KINDS[rule]]:
                own.append((s + base, rule, e + base))
        return out


def _value_length(piece: bytes, start: int, end: int) -> int:
    """Length of the assigned value: what follows the keyword, quote, spaces, sign, spaces and quote."""
    k = start
    while piece[k] not in b":=":
        k += 1
    k += 1
    while piece[k] == 0x20:
        k += 1
    return end - k - (piece[k] in b"\"'")


@lru_cache(maxsize=1)
def scanner() -> Scanner:
    return Scanner()


def scan_secrets(docs: DataFrame) -> DataFrame:
    """Per row of `docs`: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    Spans are kind:start:end in code points, end exclusive, ordered by start, then by kind as in KINDS. A null
    or empty text has none, and the hash of the empty string. Texts of any length are scanned whole. Repeated rows give
    repeated results; further columns, whatever their names, are not read. An empty table gives an empty result. No shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner()
        for batch in batches:
            counts, digests, every = [], [], []
            for a, b in text_pieces(batch, "text"):
                raw, offsets = buffers(batch.column("text").slice(a, b - a))
                for doc, spans in enumerate(map(sorted, scan.spans(raw, offsets))):
                    if spans:
                        lead = (raw[offsets[doc] : offsets[doc + 1]] & 0xC0) != 0x80  # first bytes of code points
                        points = np.r_[0, np.cumsum(lead)]
                        spans = [(int(points[s]), rule, int(points[e])) for s, rule, e in spans]
                    named = [f"{KINDS[rule]}:{s}:{e}" for s, rule, e in spans]
                    base_named = [x for x, (_, rule, _) in zip(named, spans, strict=True) if rule < len(BASE)]
                    counts.append([sum(rule == k for _, rule, _ in spans) for k in range(len(BASE))])
                    digests.append(hashlib.sha256(",".join(base_named).encode()).hexdigest())
                    every.append(",".join(named))
            n = np.array(counts, np.int64).reshape(-1, len(BASE))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(n[:, k]) for k in range(len(BASE))), pa.array(digests, pa.string()), pa.array(every, pa.string())],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    return id_and_text(docs).mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
