"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import small_batches, text_pieces, written
from quarry.llm.textnp import NOT_ALNUM, Words, buffers

BUCKET_BITS = 18
BUCKETS = 1 << BUCKET_BITS
DIM = 8
FILTERS = 16
WIDTHS = (1, 2, 3)
#: Labelled rows that the classifier is fitted on, at most, of each label, and their words; chosen by a seeded hash.
MOST_TOXIC, MOST_CLEAN = 3000, 6000
MOST_TOXIC_WORDS, MOST_CLEAN_WORDS = 2_000_000, 4_000_000
EPOCHS, BATCH, RATE = 12, 64, 0.03
#: The fold whose labelled rows set the cut and the thresholds; the network is not trained on it.
CALIBRATION = 1
#: Labelled rows of a language in that fold, and toxic ones among them, from which it gets a threshold of its own.
LEAST_FOR_THRESHOLD, LEAST_TOXIC = 100, 10
PAD = max(WIDTHS) - 1
#: Logits are counted in bins of 1/BINS between -MOST_LOGIT and MOST_LOGIT.
BINS, MOST_LOGIT = 64, 40


def word_features(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Three bucket numbers for each word (itself, its first 5 bytes, its first 4), packed, and the texts' offsets into them."""
    words = Words(raw, offsets, NOT_ALNUM)
    mask = np.uint64(BUCKETS - 1)
    packed = words.hashes() & mask
    packed |= (words.prefix_hashes(5) >> np.uint64(7) & mask) << np.uint64(BUCKET_BITS)
    packed |= (words.prefix_hashes(4) >> np.uint64(13) & mask) << np.uint64(2 * BUCKET_BITS)
    return packed, words.of_text


def _unpack(packed: np.ndarray) -> np.ndarray:
    mask = np.uint64(BUCKETS - 1)
    return np.stack([(packed >> np.uint64(k * BUCKET_BITS) & mask).astype(np.int64) for k in range(3)], axis=1)


@dataclass
class ToxicityModel:
    """Embeddings, filters of each width and their weights. `thresholds`: of the score, by language; "" for all others."""

    embedding: np.ndarray
    filters: np.ndarray  # (max width * DIM, filters of all widths): a narrow filter has zeros beyond its width
    filter_bias: np.ndarray
    weights: np.ndarray
    bias: float
    thresholds: dict[str, float] = field(default_factory=dict)

    def windows(self, packed: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Filter outputs at each place of each text, the first place of each text, and the padded buckets. Each text ends in PAD empty places, so an empty one has places too."""
        n = len(offsets) - 1
        starts = offsets[:-1] + PAD * np.arange(n)
        total = int(offsets[-1]) + PAD * n
        place = np.arange(offsets[-1]) + PAD * np.repeat(np.arange(n), np.diff(offsets))
        buckets = _unpack(packed)
        x = np.zeros((total + PAD, DIM), np.float32)
        x[place] = self.embedding[buckets[:, 0]] + self.embedding[buckets[:, 1]] + self.embedding[buckets[:, 2]]
        wide = np.hstack([x[k : total + k] for k in range(PAD + 1)])
        if PAD:  # windows end with their text
            last = np.r_[starts[1:], total]
            for back in range(1, PAD + 1):
                wide[last - back, back * DIM :] = 0
        z = np.maximum(wide @ self.filters + self.filter_bias, 0)
        return z, starts, wide

    def logits(self, packed: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if len(offsets) < 2:
            return np.zeros(0)
        z, starts, _ = self.windows(packed, offsets)
        return np.maximum.reduceat(z, starts, axis=0) @ self.weights + self.bias


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _joined(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate([*texts, np.zeros(0, np.uint64)]), np.r_[0, np.cumsum([len(t) for t in texts])].astype(np.int64)


def train(texts: list[np.ndarray], labels: np.ndarray, counts: tuple[int, int], seed: int = 5, epochs: int = EPOCHS) -> ToxicityModel:
    """Fit on packed features from a random start; `counts`: clean and toxic rows that these stand for.

    With one label only there is nothing to learn: every text gets the smoothed base rate, and stays below 0.5.
    """
    rng = np.random.default_rng(seed)
    n_filters = FILTERS * len(WIDTHS)
    filters = np.zeros(((PAD + 1) * DIM, n_filters), np.float32)
    mask = np.zeros_like(filters)
    for k, width in enumerate(WIDTHS):
        filters[: width * DIM, k * FILTERS : (k + 1) * FILTERS] = rng.normal(0, 0.3, (width * DIM, FILTERS))
        mask[: width * DIM, k * FILTERS : (k + 1) * FILTERS] = 1
    weights = np.where(np.arange(n_filters) % 2, 0.3, -0.3).astype(np.float32)
    model = ToxicityModel(np.zeros((BUCKETS, DIM), np.float32), filters, np.zeros(n_filters, np.float32), weights, 0.0, {"": 0.5})
    positive = int(labels.sum())
    if positive in (0, len(labels)):
        rate = min((counts[1] + 0.5) / (sum(counts) + 2), 0.49)
        model.weights[:] = 0
        model.bias = float(np.log(rate / (1 - rate)))
        return model
    model.embedding[...] = rng.normal(0, 0.02, model.embedding.shape)
    squares = {name: np.full_like(getattr(model, name), 1e-2) for name in ("embedding", "filters", "filter_bias", "weights")}
    bias_square = 1e-2
    # a row weighs as the rows of its label that it stands for, in units of a clean one
    stands_for = (counts[1] / positive) / (counts[0] / (len(labels) - positive))
    weight_of = np.where(labels == 1, stands_for * (counts[0] / counts[1]) ** 0.5, 1.0)

    def descend(name: str, step: np.ndarray, at=...) -> None:
        squares[name][at] += step * step
        getattr(model, name)[at] -= RATE * step / np.sqrt(squares[name][at])

    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            packed, offsets = _joined([texts[k] for k in chosen])
            z, starts, wide = model.windows(packed, offsets)
            edges = [*starts.tolist(), len(z)]
            best = np.stack([a + z[a:b].argmax(axis=0) for a, b in zip(edges[:-1], edges[1:], strict=True)])  # (texts, filters)
            pooled = z[best, np.arange(n_filters)]
            error = ((sigmoid(pooled @ model.weights + model.bias) - labels[chosen]) * weight_of[chosen] / len(chosen)).astype(np.float32)
            d_pool = (error[:, None] * model.weights) * (pooled > 0)
            d_filters = np.einsum("tf,tfw->wf", d_pool, wide[best]) * mask
            text, f = np.nonzero(d_pool)
            d_wide = model.filters.T[f] * d_pool[text, f][:, None]
            descend("weights", error @ pooled)
            descend("filters", d_filters)
            descend("filter_bias", d_pool.sum(axis=0))
            bias_square += float(error.sum()) ** 2
            model.bias -= RATE * float(error.sum()) / bias_square**0.5
            # the words under the best windows: places within a text, less the empty ones at its end
            touched, change = [], []
            buckets = _unpack(packed)
            for k in range(PAD + 1):
                place = best[text, f] + k - starts[text]
                real = place < np.diff(offsets)[text]
                touched.append(buckets[offsets[:-1][text[real]] + place[real]].ravel())
                change.append(np.repeat(d_wide[real, k * DIM : (k + 1) * DIM], 3, axis=0))
            touched, change = np.concatenate(touched), np.concatenate(change)
            if len(touched):
                by_bucket = np.argsort(touched, kind="stable")
                touched = touched[by_bucket]
                begin = np.flatnonzero(np.r_[True, touched[1:] != touched[:-1]])
                descend("embedding", np.add.reduceat(change[by_bucket], begin), touched[begin])
    return model


def _cut(bins: np.ndarray, labels: np.ndarray, n: np.ndarray) -> float:
    """The cut with the fewest errors, in the middle of the widest such gap; n rows of each bin and label."""
    found, where = np.unique(bins, return_inverse=True)
    toxic, clean = (np.bincount(where, weights=n * (labels == y), minlength=len(found)) for y in (1, 0))
    x = (found + 0.5) / BINS
    wrong = np.r_[0, np.cumsum(toxic)] + np.r_[np.cumsum(clean[::-1])[::-1], 0]
    edges = np.r_[x[0] - 2, x, x[-1] + 2]
    gap = np.diff(edges) * (wrong == wrong.min())
    k = int(np.argmax(gap))
    return float((edges[k] + edges[k + 1]) / 2)


def _fold(folds: int):
    """crc32 of the doc_id as text, modulo `folds`; null for a null doc_id."""
    return F.crc32(F.col("doc_id").cast("string")) % folds


def _calibrate(model: ToxicityModel, docs: DataFrame, usable: DataFrame, folds: int) -> None:
    """Moves the bias so that the best cut over all labelled rows of fold CALIBRATION is a score of 0.5; then a threshold for each language."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in text_pieces(batch, "text", 1 << 18):
                part = batch.slice(a, b - a)
                logits = shared.value.logits(*word_features(*buffers(part.column("text"))))
                bins = np.floor(np.clip(logits, -MOST_LOGIT, MOST_LOGIT) * BINS).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("lang"), pa.array(bins)], ["doc_id", "lang", "bin"])

    # all texts that may be labelled are scored, so that labels meet narrow rows and no text is shuffled
    found = docs.select("doc_id", "lang", "text").where(_fold(folds) == CALIBRATION).mapInArrow(run, "doc_id long, lang string, bin int")
    rows = found.join(usable, "doc_id").groupBy("lang", "toxic", "bin").agg(F.count("*").alias("n")).collect()
    langs = np.array([r["lang"] or "" for r in rows], object)
    bins, labels, n = (np.array([r[c] for r in rows], np.int64) for c in ("bin", "toxic", "n"))
    if len(set(labels.tolist())) < 2:
        return
    shift = _cut(bins, labels, n)
    model.bias -= shift
    for lang in sorted(set(langs) - {""}):
        own = langs == lang
        if n[own].sum() >= LEAST_FOR_THRESHOLD and LEAST_TOXIC <= n[own & (labels == 1)].sum() < n[own].sum():
            model.thresholds[lang] = float(sigmoid(np.array(_cut(bins[own], labels[own], n[own]) - shift)))


def _sample(docs: DataFrame, usable: DataFrame, seed: int) -> tuple[DataFrame, set[int]]:
    """Rows (doc_id, toxic, words) to train on, and the labels that they have: MOST_TOXIC and MOST_CLEAN of each label at most, and of no more words than stated, in the order of a seeded hash. A doc_id that stands several times gives one row."""

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in text_pieces(batch, "text"):
                part = batch.slice(a, b - a)
                packed, offsets = word_features(*buffers(part.column("text")))
                held = packed.tobytes()
                rows = [held[s * 8 : e * 8] for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("toxic"), part.column("order"), pa.array(np.diff(offsets)), pa.array(rows, pa.binary())], ["doc_id", "toxic", "order", "n", "words"])

    usable = usable.withColumn("order", F.xxhash64(F.lit(seed), "doc_id"))
    chosen = usable.where("toxic = 1").orderBy("order", "doc_id").limit(MOST_TOXIC).union(usable.where("toxic = 0").orderBy("order", "doc_id").limit(MOST_CLEAN))
    # at most MOST_TOXIC + MOST_CLEAN narrow rows
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic", "order").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    rows = written(texts.select("doc_id", "toxic", "order", "text").mapInArrow(features, "doc_id long, toxic int, order long, n long, words binary"), "toxicity-sample")
    sizes = sorted(rows.select("toxic", "order", "doc_id", "n").collect())
    held, labels, left = [], set(), {1: MOST_TOXIC_WORDS, 0: MOST_CLEAN_WORDS}
    for r in sizes:
        if r["n"] <= left[r["toxic"]]:
            left[r["toxic"]] -= r["n"]
            held.append((r["doc_id"],))
            labels.add(r["toxic"])
    ids = docs.sparkSession.createDataFrame(held, "doc_id long")
    return rows.join(F.broadcast(ids), "doc_id").select("doc_id", "toxic", "words"), labels


def _train_in_task(rows: DataFrame, counts: tuple[int, int], seed: int, epochs: int) -> ToxicityModel:
    """Trains on the bounded rows of _sample, in the order of their doc_ids, in one task: the driver gets the model and no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, labels = [], []
        for batch in batches:
            texts += [np.frombuffer(x, np.uint64) for x in batch.column("words").to_pylist()]
            labels += batch.column("toxic").to_pylist()
        if texts:
            model = train(texts, np.array(labels, np.int64), counts, seed, epochs)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model, pickle.HIGHEST_PROTOCOL)], pa.binary())], ["model"])

    with small_batches(rows.sparkSession):
        (found,) = rows.repartition(1).sortWithinPartitions("doc_id").select("toxic", "words").mapInArrow(run, "model binary").collect()
    return pickle.loads(found["model"])


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5, seed: int = 5, epochs: int = EPOCHS) -> ToxicityModel:
    """Fit on labelled rows whose crc32(doc_id as text) mod `folds` is neither 0 nor CALIBRATION; see _sample for how many.

    The cut and the thresholds come from all labelled rows of fold CALIBRATION, which the network has not seen. Of labels
    that contradict each other the toxic one counts; labels that are null or neither 0 nor 1 count as absent.
    """
    known = labels.select(F.col("doc_id").alias("doc_id"), "toxic").where("toxic in (0, 1)").where(_fold(folds) != 0)
    usable = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    training = usable.where(_fold(folds) != CALIBRATION)
    rows, sampled = _sample(docs, training, seed)
    n = {r["toxic"]: r["n"] for r in docs.select("doc_id").join(training, "doc_id").groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    counts = (n.get(0, 0), n.get(1, 0))
    if len(sampled) < 2:  # of no or one label
        return train([np.zeros(0, np.uint64)] * len(sampled), np.array(sorted(sampled), np.int64), counts, seed, epochs)
    model = _train_in_task(rows, counts, seed, epochs)
    _calibrate(model, docs, usable, folds)
    return model


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The columns of `docs` with score (0 to 1, of the text alone), predicted (1 if score >= 0.5) and rejected (score >= its language's threshold).

    Null and empty texts get the score of a text without words. Texts of any length are scored whole. Languages that
    are null or had few labels share the threshold 0.5. Every row gets a result, repeated rows and doc_ids each their
    own; columns named as the results are replaced, others stay. An empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text = "text"
    names = [c for c in docs.columns if c not in ("score", "predicted", "rejected")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            scores = [sigmoid(model.logits(*word_features(*buffers(batch.column(text).slice(a, b - a))))) for a, b in text_pieces(batch, text, 1 << 18)]
            score = np.concatenate([*scores, np.zeros(0)])
            least = np.array([model.thresholds.get(x or "", model.thresholds[""]) for x in batch.column("lang").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(score), pa.array((score >= 0.5).astype(np.int32)), pa.array(score >= least)],
                [*names, "score", "predicted", "rejected"],
            )

    kept = docs.select(*(F.col(f"`{c}`") for c in names))
    added = T.StructType.fromDDL("score double, predicted int, rejected boolean")
    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, *added.fields]))


def keep_clean(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The rows of `docs` whose score is below the threshold of their language, with all their columns; see score_toxicity.

    Texts without words are scored as such, so they stay unless the labels speak against them. Repeated rows fare alike.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts, langs = batch.column("text"), batch.column("lang").to_pylist()
            scores = [sigmoid(model.logits(*word_features(*buffers(texts.slice(a, b - a))))) for a, b in text_pieces(batch, "text", 1 << 18)]
            least = np.array([model.thresholds.get(x or "", model.thresholds[""]) for x in langs])
            yield batch.filter(pa.array(np.concatenate([*scores, np.zeros(0)]) < least))

    return docs.mapInArrow(run, docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score_toxicity(docs, fit(docs, labels))
