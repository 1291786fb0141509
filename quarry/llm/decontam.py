"""Benchmark decontamination: a BM25 index of test items, block-max WAND for each passage, overlap verification."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import text_pieces, written
from quarry.llm.textnp import NOT_ALNUM, Words, buffers, mix

K1, B = 1.2, 0.75
#: Share of the question's and of the answer's shingles that a passage must hold.
LEAST_OVERLAP = 0.8
SHINGLE = 5
#: Postings in a block of a list.
POSTING_BLOCK = 32
#: Stretches of items, of similar length each, for which a passage is bounded before its lists are walked.
STRETCHES, LEAST_STRETCH = 64, 4
#: Characters of test items in one index; more items are searched in further passes.
INDEX_CHARS = 16_000_000
_FILTER_BITS = 20


def split_item(text: str) -> tuple[str, str]:
    """Question and answer of an item: the answer is its last sentence; a single sentence is both."""
    parts = re.findall(r"[^.?!]+(?:[.?!]+|$)", text)
    parts = [p for p in parts if p.strip()]
    return ("".join(parts[:-1]), parts[-1]) if len(parts) > 1 else (text, text)


def _words(column: pa.Array) -> Words:
    return Words(*buffers(pc.utf8_lower(column)), NOT_ALNUM)


def _hashes(texts: list[str]) -> list[np.ndarray]:
    words = _words(pa.array(texts, pa.large_string()))
    h = words.hashes()
    return [h[a:b] for a, b in zip(words.of_text[:-1], words.of_text[1:], strict=True)]


def _grams(h: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(max(0, len(h) - n + 1), np.uint64)
    for k in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[k : k + len(out)]
    return mix(out + np.uint64(n))


@dataclass(eq=False)
class _Part:
    """A question or an answer: the length of its shingles (all its words, if those are fewer) and their hashes."""

    length: int
    grams: np.ndarray

    @classmethod
    def of(cls, h: np.ndarray) -> _Part:
        n = min(SHINGLE, len(h))
        return cls(n, np.unique(_grams(h, n)) if n else np.zeros(0, np.uint64))

    def overlap(self, passage: np.ndarray) -> float:
        if not self.length:
            return 1.0
        return float(np.isin(self.grams, _grams(passage, self.length)).mean())


@dataclass
class Statistics:
    """Of all items with words, whatever part of them an index holds: how many, their mean length, and how many hold each word."""

    n: int
    mean: float
    holding: dict[int, int]

    @classmethod
    def of(cls, hashes: list[np.ndarray]) -> Statistics:
        sizes = [len(h) for h in hashes if len(h)]
        return cls(len(sizes), sum(sizes) / max(1, len(sizes)), Counter(x for h in hashes for x in set(h.tolist())))


class _List:
    """Postings of a term, ascending by item, with the largest impact of each block and of all."""

    __slots__ = ("items", "impacts", "block_last", "block_max", "top", "at")

    def __init__(self, items: list[int], impacts: list[float]):
        self.items, self.impacts, self.at = items, impacts, 0
        self.block_last = [items[min(k + POSTING_BLOCK, len(items)) - 1] for k in range(0, len(items), POSTING_BLOCK)]
        self.block_max = [max(impacts[k : k + POSTING_BLOCK]) for k in range(0, len(items), POSTING_BLOCK)]
        self.top = max(impacts)


class ItemIndex:
    """Impacts are BM25 terms over the item's score against itself, so that a passage with all its terms scores 1."""

    def __init__(self, ids: list[int], texts: list[str], statistics: Statistics | None = None):
        hashes = _hashes(texts)
        all_items = statistics or Statistics.of(hashes)
        kept = sorted((k for k, h in enumerate(hashes) if len(h)), key=lambda k: len(hashes[k]))
        self.ids = [ids[k] for k in kept]
        hashes = [hashes[k] for k in kept]
        halves = [split_item(texts[k]) for k in kept]
        self.questions = [_Part.of(h) for h in _hashes([q for q, _ in halves])]
        self.answers = [_Part.of(h) for h in _hashes([a for _, a in halves])]
        self.reach = max(map(len, hashes), default=1)
        posted: dict[int, tuple[list[int], list[float]]] = {}
        self.least = 1.0
        for item, h in enumerate(hashes):
            impact = {}
            for x, tf in Counter(h.tolist()).items():
                seen = all_items.holding[x]
                idf = float(np.log(1 + (all_items.n - seen + 0.5) / (seen + 0.5)))
                impact[x] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(h) / all_items.mean))
            own = sum(impact.values())
            # the most that words outside of LEAST_OVERLAP of the shingles can weigh: no held item scores below `least`
            lost = {p: int((1 - LEAST_OVERLAP) * len(p.grams) + 1e-9) for p in (self.questions[item], self.answers[item])}
            self.least = min(self.least, 1 - sum(sorted(impact.values())[-sum(lost.values()) :]) / own if sum(lost.values()) else 1.0)
            for x, v in impact.items():
                items, impacts = posted.setdefault(x, ([], []))
                items.append(item)
                impacts.append(v / own)
        self.terms = np.array(sorted(posted), np.uint64)
        self.lists = [_List(*posted[int(x)]) for x in self.terms]
        self.top = np.array([p.top for p in self.lists])
        self.stretch = max(LEAST_STRETCH, -(-len(self.ids) // STRETCHES))
        self.tops = np.zeros((len(self.lists), -(-len(self.ids) // self.stretch)), np.float32)
        for k, p in enumerate(self.lists):
            np.maximum.at(self.tops[k], np.array(p.items) // self.stretch, p.impacts)
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[(self.terms & np.uint64((1 << _FILTER_BITS) - 1)).astype(np.int64)] = True

    def term_ids(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of words that items have, and their terms."""
        place = np.flatnonzero(self.filter[(h & np.uint64((1 << _FILTER_BITS) - 1)).astype(np.int64)])
        at = np.searchsorted(self.terms, h[place])
        at[at == len(self.terms)] = 0
        real = self.terms[at] == h[place] if len(self.terms) else np.zeros(len(place), bool)
        return place[real], at[real]

    def retrieve(self, terms: list[int], least: float, first: int, last: int) -> list[tuple[int, float]]:
        """Block-max WAND: all items from `first` to before `last` whose score for these terms reaches `least`."""
        lists = [self.lists[t] for t in terms]
        for p in lists:
            p.at = bisect_left(p.items, first)
        found = []
        while True:
            lists = [p for p in lists if p.at < len(p.items) and p.items[p.at] < last]
            lists.sort(key=lambda p: p.items[p.at])
            bound, pivot = 0.0, -1
            for k, p in enumerate(lists):
                bound += p.top
                if bound >= least - 1e-9:
                    pivot = k
                    break
            if pivot < 0:
                return found
            item = lists[pivot].items[lists[pivot].at]
            while pivot + 1 < len(lists) and lists[pivot + 1].items[lists[pivot + 1].at] == item:
                pivot += 1
            bound, following = 0.0, lists[pivot + 1].items[lists[pivot + 1].at] if pivot + 1 < len(lists) else len(self.ids)
            for p in lists[: pivot + 1]:
                block = bisect_left(p.block_last, item, p.at // POSTING_BLOCK)
                if block < len(p.block_last):
                    bound += p.block_max[block]
                    following = min(following, p.block_last[block] + 1)
            if bound < least - 1e-9:
                goal = max(following, item + 1)
                for p in lists[: pivot + 1]:
                    p.at = bisect_left(p.items, goal, p.at)
                continue
            score = 0.0
            for p in lists[: pivot + 1]:
                p.at = bisect_left(p.items, item, p.at)
                if p.at < len(p.items) and p.items[p.at] == item:
                    score += p.impacts[p.at]
                    p.at += 1
            if score >= least - 1e-9:
                found.append((item, score))

    def leaks(self, texts: pa.Array) -> dict[int, dict[int, tuple[float, float, float]]]:
        """text -> item -> (score, overlap of the question, of the answer).

        Passages are windows of twice the longest item's words, each half over the next, so that some passage
        holds any place where an item can stand.
        """
        words = _words(texts)
        h = words.hashes()
        place, term = self.term_ids(h)
        text = np.searchsorted(words.of_text, place, side="right") - 1
        window = (place - words.of_text[text]) // self.reach
        most = int(np.diff(words.of_text).max(initial=0)) // self.reach + 2
        passage = text * most + window + 1  # window k holds the stretches k - 1 and k
        pairs = np.unique(np.r_[passage, passage - 1] * len(self.terms) + np.r_[term, term]) if len(place) else np.zeros(0, np.int64)
        of, term = pairs // max(1, len(self.terms)), pairs % max(1, len(self.terms))
        out: dict[int, dict[int, tuple[float, float, float]]] = {}
        if not len(of):
            return out
        begin = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        end = np.r_[begin[1:], len(of)]
        bound = np.add.reduceat(self.top[term], begin)  # no item can reach more: without it WAND finds no pivot
        for k in np.flatnonzero(bound >= self.least - 1e-6).tolist():
            terms = term[begin[k] : end[k]]
            near = np.flatnonzero(self.tops[terms].sum(axis=0) >= self.least - 1e-4)
            if not len(near):
                continue
            doc, stretch = divmod(int(of[begin[k]]), most)
            first = int(words.of_text[doc])
            a = first + max(0, stretch - 1) * self.reach
            b = min(int(words.of_text[doc + 1]), first + (stretch + 1) * self.reach)
            for item, score in [x for n in near.tolist() for x in self.retrieve(terms.tolist(), self.least, n * self.stretch, (n + 1) * self.stretch)]:
                q, r = self.questions[item].overlap(h[a:b]), self.answers[item].overlap(h[a:b])
                if q >= LEAST_OVERLAP and r >= LEAST_OVERLAP:
                    own = out.setdefault(doc, {})
                    own[item] = max(own.get(item, (0.0, 0.0, 0.0)), (score, q, r))
        return out


LEAK = "array<struct<item_id: bigint, score: double, question_overlap: double, answer_overlap: double>>"
_LEAK_TYPE = pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("question_overlap", pa.float64()), ("answer_overlap", pa.float64())]))


def _words_of_items(items: DataFrame) -> DataFrame:
    """(word, items, n): how many items hold each word; under a null word, how many items have words, and their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [h for h in _hashes(batch.column("text").to_pylist()) if len(h)]
            found = Statistics.of(hashes)
            words = np.fromiter(found.holding, np.uint64, len(found.holding)).view(np.int64)
            held = [*found.holding.values(), found.n]
            yield pa.RecordBatch.from_arrays([pa.array([*words.tolist(), None], pa.int64()), pa.array(held, pa.int64()), pa.array([0] * len(words) + [sum(map(len, hashes))], pa.int64())], ["word", "items", "n"])

    return items.select("text").mapInArrow(run, "word long, items long, n long").groupBy("word").agg(F.sum("items").alias("items"), F.sum("n").alias("n"))


def _blocks(benchmark: DataFrame) -> Iterator[tuple[ItemIndex, bool]]:
    """Indexes of INDEX_CHARS characters at most, each with the statistics of all items, and whether it is the only one."""
    spark = benchmark.sparkSession
    items = benchmark.select("item_id", "text").where("item_id is not null and length(text) > 0")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-total // INDEX_CHARS)
    if not n:
        return
    counts = written(_words_of_items(items), "benchmark-words")
    every = counts.where("word is null").first()
    for k in range(n):
        rows = sorted(items.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == k).collect(), key=lambda r: (r["item_id"], r["text"]))
        texts = [r["text"] for r in rows]
        own = np.unique(np.concatenate([np.zeros(0, np.uint64), *_hashes(texts)])).view(np.int64)
        mine = counts.where("word is not null")
        if n > 1:  # only the words of this block come to the driver
            mine = mine.join(F.broadcast(spark.createDataFrame(pd.DataFrame({"word": own}))), "word")
        holding = {r["word"] % (1 << 64): r["items"] for r in mine.collect()}
        index = ItemIndex([r["item_id"] for r in rows], texts, Statistics(every["items"], every["n"] / max(1, every["items"]), holding))
        if index.ids:
            yield index, n == 1


def mark_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """`docs` with a column `leaks`: the items that a text holds, each with its best score and overlaps; [] for none.

    Words are runs of letters and digits, lower-cased; an item counts as held if one passage
    holds LEAST_OVERLAP of the 5-word shingles of its question and of its
    answer. Null and empty texts hold nothing; null and empty items, and those without words, are held by nothing.
    Texts of any length are searched whole. Equal items are all reported; of rows that share an item_id the better score
    counts. Repeated rows have their results each; an existing column `leaks` is replaced, others stay. An empty table, or
    an empty benchmark, gives no leaks. Scores use statistics of all items, so that they do not depend on the blocks.
    There is no shuffle; an index of at most INDEX_CHARS characters goes to the tasks. A larger benchmark makes further
    passes, each written before the next, so that no two indexes are held at once.
    """
    names = [c for c in docs.columns if c != "leaks"]
    out = docs.select(*(F.col(f"`{c}`") for c in names)).withColumn("leaks", F.from_json(F.lit("[]"), LEAK))
    schema = out.schema

    def marker(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                before = batch.column("leaks").to_pylist()
                for a, b in text_pieces(batch, "text"):
                    for doc, items in index.leaks(batch.column("text").slice(a, b - a)).items():
                        best: dict[int, tuple] = {}
                        for k, v in items.items():
                            best[index.ids[k]] = max(v, best.get(index.ids[k], v))
                        before[a + doc] = before[a + doc] + [{"item_id": i, "score": v[0], "question_overlap": v[1], "answer_overlap": v[2]} for i, v in best.items()]
                held = pa.array([sorted(x, key=lambda y: y["item_id"]) for x in before], _LEAK_TYPE)
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), held], [*names, "leaks"])

        return run

    return _passes(out, benchmark, marker, schema)


def _passes(docs: DataFrame, benchmark: DataFrame, step, schema) -> DataFrame:
    """`docs` through `step` for each index of the benchmark."""
    for index, only in _blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(index)
        docs = docs.mapInArrow(step(shared), schema)
        if not only:
            docs = written(docs, "benchmark-pass")
            shared.destroy()
    return docs


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` that hold no item of the benchmark, with all their columns; see mark_leaks."""

    def keeper(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for a, b in text_pieces(batch, "text"):
                    keep[[a + k for k in shared.value.leaks(batch.column("text").slice(a, b - a))]] = False
                yield batch.filter(pa.array(keep))

        return run

    return _passes(docs, benchmark, keeper, docs.schema)


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and item it holds: doc_id, item_id, score, question_overlap, answer_overlap."""
    return mark_leaks(docs.select("doc_id", "text"), benchmark).select("doc_id", F.explode("leaks").alias("x")).select("doc_id", "x.*")
