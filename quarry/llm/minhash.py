"""Near duplicates: circulant MinHash, banding, exact Jaccard verification, components."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import cut, id_and_text, small_batches, text_pieces, written
from quarry.llm.components import components
from quarry.llm.textnp import Words, buffers, mix

#: Size of the circle that shingles are laid on.
CIRCLE = 1 << 20
#: Documents verified against each other by one call; larger groups are cut into such blocks, and each pair of blocks into a call.
BLOCK = 64
#: Shingles in a group from which it is cut as well.
BLOCK_SHINGLES = 4_000_000
_COLUMNS = 4096


def bands_for(percent: int) -> tuple[int, int]:
    """(bands, rows): under one pair in a million with that similarity shares no band."""
    rows = 6 if percent >= 85 else 5 if percent >= 80 else 3
    miss = 1 - (percent / 100) ** rows
    return max(1, int(np.ceil(np.log(7e-7) / np.log(miss)))), rows


@lru_cache(maxsize=2)
def permutations(width: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """The two permutations of the circle; the second as a view whose row p holds its values at p, p + 1, ... p + width - 1."""
    rng = np.random.default_rng(seed)
    first = rng.permutation(CIRCLE).astype(np.int32)
    second = rng.permutation(CIRCLE).astype(np.uint32)
    return first, np.lib.stride_tricks.sliding_window_view(np.r_[second, second[:width]], width)


def shingles(raw: np.ndarray, offsets: np.ndarray, words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; fewer words than a shingle make one, none make none."""
    found = Words(raw, offsets)
    h = found.hashes()
    n = len(h)
    rolled = np.zeros(max(0, n - words + 1), np.uint64)
    for k in range(words):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + h[k : k + len(rolled)]
    rolled = mix(rolled + np.uint64(words))
    out = []
    for a, b in zip(found.of_text[:-1].tolist(), found.of_text[1:].tolist(), strict=True):
        if b - a >= words:
            out.append(np.unique(rolled[a : b - words + 1]))
        elif b > a:
            whole = np.uint64(0)
            with np.errstate(over="ignore"):
                for x in h[a:b]:
                    whole = whole * np.uint64(0x9E3779B97F4A7C15) + x
                out.append(mix(np.array([whole + np.uint64(b - a)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signature(items: np.ndarray, width: int) -> np.ndarray:
    """All coordinates from two permutations: the first spreads the items, the second is read at 0 to width - 1 places further."""
    first, shifted = permutations(width)
    at = first[(items & np.uint64(CIRCLE - 1)).astype(np.int64)]
    best = np.full(width, np.iinfo(np.uint32).max, np.uint32)
    for k in range(0, len(at), _COLUMNS):
        np.minimum(best, shifted[at[k : k + _COLUMNS]].min(axis=0), out=best)
    return best


def _sketcher(words: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in text_pieces(batch, "text"):
                part = batch.slice(a, b - a)
                sets = shingles(*buffers(part.column("text")), words)
                n = np.array([len(s) for s in sets], np.int64)
                key = np.zeros((len(sets), 2), np.uint64)
                keys = np.zeros((len(sets), bands), np.uint64)
                for k, s in enumerate(sets):
                    if len(s):
                        key[k] = mix(s).sum(), mix(s ^ np.uint64(0xA5A5A5A55A5A5A5A)).sum()
                        coordinates = signature(s, bands * rows).reshape(bands, rows).astype(np.uint64)
                        h = np.arange(bands, dtype=np.uint64)
                        for j in range(rows):
                            h = mix(h * np.uint64(0xD6E8FEB86659FD93) + coordinates[:, j] + np.uint64(1))
                        keys[k] = h
                flat = pa.array(keys.view(np.int64).ravel())
                held = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * bands), flat)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n), pa.array(key[:, 0].view(np.int64)), pa.array(key[:, 1].view(np.int64)), held],
                    ["doc_id", "n_shingles", "k1", "k2", "bands"],
                )

    return run


class _Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of all pairs of one block; only items that two sets have are multiplied out."""
    n = len(sets)
    if n == 2:
        return np.array([[0, len(np.intersect1d(*sets, assume_unique=True))]] * 2)
    items, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    name = np.cumsum(counts > 1) - 1
    of = np.repeat(np.arange(n), [len(s) for s in sets])
    keep = counts[inverse] > 1
    column, of = name[inverse[keep]], of[keep]
    order = np.argsort(column, kind="stable")
    column, of = column[order], of[order]
    out = np.zeros((n, n), np.float64)
    for at in range(0, int(name[-1]) + 1 if len(name) else 0, _COLUMNS):
        a, b = np.searchsorted(column, [at, at + _COLUMNS])
        x = np.zeros((n, _COLUMNS), np.float32)
        x[of[a:b], column[a:b] - at] = 1
        out += x @ x.T
    return np.rint(out).astype(np.int64)


def _verifier(words: int, percent: int):
    def links(ids: list[int], texts: list[str]) -> Iterator[tuple[int, int]]:
        raw, offsets = buffers(pa.array(texts, pa.large_string()))
        sets = shingles(raw, offsets, words)
        sizes = np.array([len(s) for s in sets])
        both = _overlaps(sets)
        close = np.argwhere(np.triu(100 * both >= percent * (sizes[:, None] + sizes[None, :] - both), 1))
        forest = _Forest(len(ids))
        for x, y in close.tolist():
            forest.join(x, y)
        least: dict[int, int] = {}
        for k, doc in enumerate(ids):
            r = forest.root(k)
            least[r] = min(least.get(r, doc), doc)
        for k, doc in enumerate(ids):
            if least[forest.root(k)] != doc:
                yield least[forest.root(k)], doc

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, texts = None, [], []
        for batch in batches:
            out: list[tuple[int, int]] = []
            for *here, doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if here != key:
                    if len(ids) > 1:
                        out += links(ids, texts)
                    key, ids, texts = here, [], []
                ids.append(doc)
                texts.append(text or "")
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], ["a", "b"])
        if len(ids) > 1:
            out = list(links(ids, texts))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], ["a", "b"])

    return run


def _groups(reps: DataFrame) -> DataFrame:
    """Which representatives meet in which call: kind, g1, g2, g3, rep. Any two that share a band meet in one at least."""
    keyed = reps.select("rep", "n_shingles", F.explode("bands").alias("key"))
    counts = cut(keyed.groupBy("key").agg(F.min("rep").alias("hub"), F.count("*").alias("m"), F.sum("n_shingles").alias("total")).where("m > 1"))
    shared = written(keyed.join(counts, "key").select("key", "rep", "hub", "m", "total", "n_shingles"), "minhash-bands")
    loose = cut(components(shared.select("hub", "rep"), "hub", "rep"))
    weight = shared.groupBy("rep").agg(F.first("n_shingles").alias("n"), F.sum(F.ceil(F.col("m") / BLOCK)).alias("by_band"))
    placed = loose.join(cut(weight), F.col("node") == F.col("rep")).select("rep", "component", "n", "by_band")
    placed = written(placed, "minhash-places")
    size = placed.groupBy("component").agg(F.count("*").alias("m"), F.sum("n").alias("total"), F.sum("by_band").alias("by_band"))
    blocks = F.least("m", F.greatest(F.ceil(F.col("m") / BLOCK), F.ceil(F.col("total") / BLOCK_SHINGLES)))
    size = cut(size.select("component", blocks.cast("int").alias("blocks"), (F.col("m") * blocks <= F.col("by_band")).alias("whole")))
    placed = placed.select("rep", "component").join(size, "component")
    mine = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")

    def met(rows: DataFrame, kind: int, key: str) -> DataFrame:
        rows = rows.select("rep", F.col(key).alias("g1"), mine.alias("mine"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        return rows.select(F.lit(kind).alias("kind"), "g1", F.least("mine", "other").alias("g2"), F.greatest("mine", "other").alias("g3"), "rep")

    whole = met(placed.where("blocks = 1 or whole"), 0, "component")
    banded = cut(placed.where("blocks > 1 and not whole").select("rep"))
    by_band = shared.join(banded, "rep").withColumn("blocks", F.least("m", F.greatest(F.ceil(F.col("m") / BLOCK), F.ceil(F.col("total") / BLOCK_SHINGLES))).cast("int"))
    return whole.union(met(by_band, 1, "key"))


def near_duplicates(docs: DataFrame, words: int = 3, percent: int = 85) -> DataFrame:
    """Per row of `docs`: doc_id, n_shingles, component_id, kept.

    Texts are linked when 100 * intersection >= percent * union of their sets of `words`-word shingles
    (A-Z lower-cased; words end at ASCII white space). Null and empty texts have no shingles and no links: their
    component is their own doc_id, as is that of rows with no partner. Rows with equal sets form one class and
    meet the others through its smallest doc_id; rows that repeat a doc_id count as documents of their own. A null doc_id stands alone
    (component null, kept). Texts of any length count whole; further columns, whatever their names, are not read. An empty
    table gives an empty result.

    Candidates are rows that share a band of the signature; all of them are verified on full sets, in blocks
    of bounded size, whatever the size of a band. Only doc_ids, set digests and band keys are shuffled before
    that; texts move once, for the verification.
    """
    bands, rows = bands_for(percent)
    spark = docs.sparkSession
    with small_batches(spark):
        sketch = written(id_and_text(docs).mapInArrow(_sketcher(words, bands, rows), "doc_id long, n_shingles long, k1 long, k2 long, bands array<long>"), "minhash-sketch")
    full = sketch.where("n_shingles > 0 and doc_id is not null")
    reps = written(full.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands")), "minhash-sets")
    groups = _groups(reps)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = id_and_text(docs).withColumnRenamed("doc_id", "rep")
    calls = cut(groups).join(texts, "rep").select("kind", "g1", "g2", "g3", "rep", "text")
    calls = calls.repartition(parts, "kind", "g1", "g2", "g3").sortWithinPartitions("kind", "g1", "g2", "g3", "rep")
    with small_batches(spark):
        links = cut(calls.mapInArrow(_verifier(words, percent), "a long, b long"))
    linked = components(links, "a", "b")
    classes = cut(reps.select("k1", "k2", "rep").join(cut(linked), F.col("rep") == F.col("node"), "left").select("k1", "k2", F.coalesce("component", "rep").alias("component_id")))
    own = sketch.select("doc_id", "n_shingles", "k1", "k2")
    alone = F.col("n_shingles") == 0
    joined = own.where(~alone & F.col("doc_id").isNotNull()).join(classes, ["k1", "k2"]).select("doc_id", "n_shingles", "component_id")
    rest = own.where(alone | F.col("doc_id").isNull()).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return joined.union(rest).select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
