"""LM scoring: masked pseudo-likelihood of a window network that sees both sides of each token."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import id_and_text, text_pieces, written
from quarry.llm.textnp import NOT_ALNUM, Words, buffers, mix

#: Words with an id of their own in the network; all others share OTHERS ids there by their first PREFIX bytes, and keep their own counts in a table.
KNOWN, OTHERS, PREFIX = 8192, 1024, 3
IDS = KNOWN + OTHERS
#: Ids are cut by frequency into CLASSES classes of MEMBERS each.
CLASSES = 96
MEMBERS = -(-IDS // CLASSES)
DIM = 16
#: Tokens seen on each side of the masked one.
SIDE = 2
#: The rows are dealt into as many rounds; after each the trainers' networks are averaged.
ROUNDS = 3
#: Tokens for which there is one trainer: their number depends on the corpus alone.
TRAINER_TOKENS = 8_000_000
#: Masked tokens of a training step; tokens that are put together before steps are cut; tokens scored at once.
STEP, BLOCK, BATCH = 2048, 1 << 16, 8192
RATE = 0.1
#: Logits within this bound need no shift before their exponentials: float32 holds exp(-2 * SAFE) to exp(2 * SAFE).
SAFE = 40
#: Distinct words that a task counts before it hands its counts on.
COUNTED = 400_000
_CHUNK = 1 << 16
_SALTS = 64
_GROUPS = 64
_SEED = 7
#: Logarithms of counts are summed as whole numbers of this unit, so that their order does not matter.
_UNIT = 1 << 30


@dataclass
class Tokens:
    """Ids of words: known ones by sorted hash, the rest by bucket. Each id is a member of a class, with a share of it; log_mass: of the words of each bucket."""

    hashes: np.ndarray
    ids: np.ndarray
    class_of: np.ndarray
    member_of: np.ndarray
    share: np.ndarray  # (CLASSES, MEMBERS): log of the share by counts
    log_class: np.ndarray
    log_mass: np.ndarray
    total: int

    def of(self, h: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        out = KNOWN + bucket
        if len(self.hashes):
            at = np.searchsorted(self.hashes, h)
            at[at == len(self.hashes)] = 0
            known = self.hashes[at] == h
            out[known] = self.ids[at[known]]
        return out


def make_tokens(hashes: np.ndarray, counts: np.ndarray, bucket_mass: np.ndarray) -> Tokens:
    """Known words, most frequent first, with their counts, and the mass of the words left in each bucket."""
    n = np.ones(IDS)
    n[: len(counts)] += counts
    n[KNOWN:] += bucket_mass
    rank = np.argsort(-n, kind="stable")
    class_of, member_of = np.empty(IDS, np.int64), np.empty(IDS, np.int64)
    class_of[rank], member_of[rank] = np.divmod(np.arange(IDS), MEMBERS)
    mass = np.bincount(class_of, weights=n, minlength=CLASSES)
    share = np.full((CLASSES, MEMBERS), -np.inf, np.float32)  # places without a member
    share[class_of, member_of] = np.log(n / mass[class_of])
    order = np.argsort(hashes)
    log_class = np.log(np.maximum(mass, 1e-9) / mass.sum())
    return Tokens(hashes[order], order.astype(np.int64), class_of, member_of, share, log_class, np.log(np.maximum(bucket_mass, 1)), int(counts.sum() + bucket_mass.sum()))


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Row ranges, and the hashes, buckets and places of their words."""
    for a, b in text_pieces(batch, "text"):
        words = Words(*buffers(batch.column("text").slice(a, b - a)), NOT_ALNUM)
        yield a, b, words.hashes(), (words.prefix_hashes(PREFIX) >> np.uint64(40)).astype(np.int64) % OTHERS, words.of_text


def count_words(docs: DataFrame) -> DataFrame:
    """(word hash, bucket, n) of all words of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            none = np.zeros(0, np.int64)
            h, first, where = np.unique(np.concatenate([np.zeros(0, np.uint64), *(x for x, _, _ in held)]), return_index=True, return_inverse=True)
            n = np.bincount(where, weights=np.concatenate([none, *(y for _, _, y in held)]), minlength=len(h)).astype(np.int64)
            bucket = np.concatenate([none, *(x for _, x, _ in held)])[first]
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(bucket.astype(np.int32)), pa.array(n)], ["word", "bucket", "n"])

        for batch in batches:
            for _, _, h, bucket, _ in _pieces(batch):
                found, first, n = np.unique(h, return_index=True, return_counts=True)
                held.append((found, bucket[first], n))
                size += len(found)
                if size > 4 * COUNTED:
                    yield flush()
                    held, size = [], 0
        yield flush()

    return docs.select("text").mapInArrow(run, "word long, bucket int, n long").groupBy("word").agg(F.min("bucket").alias("bucket"), F.sum("n").alias("n"))


def learn_tokens(counts: DataFrame) -> Tokens:
    """The KNOWN most frequent words of the table of counts, ties by hash, and the mass of the rest of each bucket."""
    # the best of each of a fixed number of groups, then the best of those: what reaches the driver does not grow with partitions
    place = F.row_number().over(Window.partitionBy("group").orderBy(F.desc("n"), "word"))
    best = counts.withColumn("group", F.pmod(F.xxhash64("word"), F.lit(_GROUPS))).withColumn("place", place).where(F.col("place") <= KNOWN)
    top = best.orderBy(F.desc("n"), "word").limit(KNOWN).select("word", "bucket", "n").collect()
    mass = np.zeros(OTHERS)
    for r in counts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        mass[r["bucket"]] = r["n"]
    for r in top:
        mass[r["bucket"]] -= r["n"]
    return make_tokens(np.array([r["word"] for r in top], np.int64).view(np.uint64), np.array([r["n"] for r in top], np.int64), mass)


class WindowNetwork:
    """Embeddings for each place of the window, one hidden layer, a softmax over classes of tokens and one over the members of each class.

    A token's probability is that of its class in its context times its own in the class, in the same context. Both
    softmaxes start at the shares by counts. `squares` are Adagrad's sums; those of an embedding are one for each row.
    """

    def __init__(self, tokens: Tokens, state: np.ndarray | None = None, seed: int = 3):
        self.tokens = tokens
        shapes = {"embedding": (2 * SIDE, IDS + 1, DIM), "hidden_bias": (DIM,), "out": (DIM, CLASSES), "out_bias": (CLASSES,), "inner": (CLASSES, MEMBERS, DIM + 1)}
        squares = shapes | {"embedding": (2 * SIDE, IDS + 1)}
        sizes = [int(np.prod(s)) for s in (*shapes.values(), *squares.values())]
        self.state = np.zeros(sum(sizes), np.float32) if state is None else np.array(state, np.float32)
        parts = np.split(self.state, np.cumsum(sizes)[:-1])
        self.weights = {k: p.reshape(s) for (k, s), p in zip(shapes.items(), parts[: len(shapes)], strict=True)}
        self.squares = {k: p.reshape(s) for (k, s), p in zip(squares.items(), parts[len(shapes) :], strict=True)}
        if state is None:
            rng = np.random.default_rng(seed)
            for k in ("embedding", "out"):
                self.weights[k][...] = rng.normal(0, 0.1, shapes[k])
            self.weights["out_bias"][...] = tokens.log_class
            for x in self.squares.values():
                x[...] = 1e-6

    def contexts(self, ids: np.ndarray, of_text: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Ids around each of `places`, the pad id beyond its text: (2 * SIDE, places)."""
        text = np.searchsorted(of_text, places, side="right") - 1
        first, end = of_text[text], of_text[text + 1]
        out = np.empty((2 * SIDE, len(places)), np.int64)
        for row, d in enumerate([*range(-SIDE, 0), *range(1, SIDE + 1)]):
            at = places + d
            inside = (at >= first) & (at < end)
            out[row] = np.where(inside, ids[np.where(inside, at, 0)], IDS)
        return out

    def forward(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The hidden layer, with a column of ones behind it, and the classes' logits."""
        w = self.weights
        hidden = w["embedding"][0].take(context[0], axis=0)
        for k in range(1, len(context)):
            hidden += w["embedding"][k].take(context[k], axis=0)
        hidden += w["hidden_bias"]
        inputs = np.ones((len(hidden), DIM + 1), np.float32)
        np.tanh(hidden, out=inputs[:, :DIM])
        return inputs, inputs @ np.vstack([w["out"], w["out_bias"]])

    def members(self) -> np.ndarray:
        """What the inputs are multiplied with for the members' logits, shares included: (CLASSES, MEMBERS, DIM + 1)."""
        out = self.weights["inner"].copy()
        out[:, :, DIM] += self.tokens.share
        return out

    def in_class(self, classes: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Class, begin and end of the runs of sorted `classes`."""
        edge = np.r_[0, np.cumsum(np.bincount(classes, minlength=CLASSES))].tolist()
        return ((c, a, b) for c, (a, b) in enumerate(zip(edge[:-1], edge[1:], strict=True)) if b > a)

    def log_prob(self, ids: np.ndarray, of_text: np.ndarray) -> np.ndarray:
        """log P(id | both sides) at every place."""
        out = np.zeros(len(ids))
        members = self.members()
        safe, safe_in = _safe(np.vstack([self.weights["out"], self.weights["out_bias"]]).T), _safe(members)
        for a in range(0, len(ids), BATCH):
            places, part, classes = self.by_class(ids, np.arange(a, min(a + BATCH, len(ids))))
            inputs, logits = self.forward(self.contexts(ids, of_text, places))
            found = logits[np.arange(len(part)), classes]
            found -= _log_sum(logits, safe)
            own = self.tokens.member_of[part]
            for c, x, y in self.in_class(classes):
                logits = inputs[x:y] @ members[c].T
                found[x:y] += logits[np.arange(y - x), own[x:y]]
                found[x:y] -= _log_sum(logits, safe_in[c])
            out[places] = found
        return out

    def by_class(self, ids: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places in the order of their ids' classes, their ids, and the classes."""
        classes = self.tokens.class_of[ids[places]].astype(np.uint16)
        order = np.argsort(classes, kind="stable")
        return places[order], ids[places[order]], classes[order]

    def _descend(self, name: str, step: np.ndarray) -> None:
        """Overwrites `step`."""
        squares, held = self.squares[name], step * step
        squares += held
        np.sqrt(squares, out=held)
        step *= RATE
        step /= held
        self.weights[name] -= step

    def train(self, ids: np.ndarray, of_text: np.ndarray, places: np.ndarray) -> None:
        """One pass over the masked places, STEP at a time."""
        slot, places_in = np.zeros(STEP, np.int64), np.arange(DIM)
        for a in range(0, len(places), STEP):
            here, part, classes = self.by_class(ids, places[a : a + STEP])
            around, n = self.contexts(ids, of_text, here), len(here)
            inputs, p = self.forward(around)
            _shares(p, n)
            p[np.arange(n), classes] -= 1 / n
            back = p @ self.weights["out"].T
            # one product for each class, all else for all members' logits together
            members, inner, runs = self.members(), self.weights["inner"], list(self.in_class(classes))
            q, more, step = np.empty((n, MEMBERS), np.float32), np.empty_like(back), np.zeros_like(members)
            for c, x, y in runs:
                np.matmul(inputs[x:y], members[c].T, out=q[x:y])
            _shares(q, n)
            q[np.arange(n), self.tokens.member_of[part]] -= 1 / n
            for c, x, y in runs:
                mine = q[x:y]
                np.matmul(mine, inner[c, :, :DIM], out=more[x:y])
                np.matmul(mine.T, inputs[x:y], out=step[c])
            self._descend("inner", step)
            back += more
            hidden = inputs[:, :DIM]
            back *= 1 - hidden * hidden
            self._descend("out", hidden.T @ p)
            self._descend("out_bias", p.sum(axis=0))
            self._descend("hidden_bias", back.sum(axis=0))
            flat = back.ravel().astype(np.float64)
            for k, row in enumerate(around):
                order = np.argsort(row.astype(np.uint16), kind="stable")
                found = row[order]
                new = np.r_[True, found[1:] != found[:-1]]
                used = found[new]
                slot[order] = np.cumsum(new) - 1  # sums over the rows that occur, not over all ids
                step = np.bincount((slot[:n, None] * DIM + places_in).ravel(), weights=flat, minlength=len(used) * DIM).reshape(-1, DIM).astype(np.float32)
                now = self.squares["embedding"][k].take(used) + (step * step).mean(axis=1)
                self.squares["embedding"][k][used] = now
                step *= RATE
                step /= np.sqrt(now)[:, None]
                rows = self.weights["embedding"][k]
                rows[used] = rows.take(used, axis=0) - step


def _shares(logits: np.ndarray, n: int) -> None:
    """Turns each row's logits into their softmax over `n`, shifted by its maximum where that is beyond SAFE."""
    if not (logits.max() < SAFE and logits[:, 0].min() > -SAFE):  # the first place has a member in every class
        top = logits.max(axis=1)
        far = np.flatnonzero(np.abs(top) >= SAFE)
        logits[far] -= top[far, None]
    sums, _ = _exp(logits, True)
    logits *= (1 / (sums * n))[:, None]


def _safe(rows: np.ndarray) -> np.ndarray:
    """Whether inputs within 1, the last one 1, times all `rows` stay below SAFE, and times one of them above -SAFE."""
    most = np.abs(rows) @ np.r_[np.ones(DIM, np.float32), np.float32(0)]
    return ((rows[..., DIM] + most).max(axis=-1) < SAFE) & ((rows[..., DIM] - most).max(axis=-1) > -SAFE)


def _exp(logits: np.ndarray, safe: bool) -> tuple[np.ndarray, np.ndarray | float]:
    """Turns logits into exponentials, shifted by each row's maximum where they are not safe; their sums, and the shifts."""
    shift = 0.0
    if not safe:
        shift = logits.max(axis=1)
        logits -= shift[:, None]
    np.exp(logits, out=logits)
    return logits @ np.ones(logits.shape[1], np.float32), shift


def _log_sum(logits: np.ndarray, safe: bool) -> np.ndarray:
    sums, shift = _exp(logits, safe)
    return np.log(sums) + shift


def _mean(pdf: pd.DataFrame) -> pd.DataFrame:
    """The mean of some trainers' chunks by masked tokens; in the trainers' order, so that it is the same however they met."""
    pdf = pdf.sort_values("trainer")
    n = pdf["n"].to_numpy(np.float64)
    values = np.zeros(len(pdf["w"].iloc[0]) // 4)
    for share, w in zip(n / n.sum(), pdf["w"], strict=True):
        values += share * np.frombuffer(w, np.float32)
    return pd.DataFrame({"chunk": [pdf["chunk"].iloc[0]], "trainer": [pdf["trainer"].iloc[0]], "n": [int(n.sum())], "w": [values.astype(np.float32).tobytes()]})


def _training_rows(docs: DataFrame, shared, trainers: int) -> DataFrame:
    """Each document's ids, with its round and its trainer: by a hash of the row, whatever partition it is in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = shared.value
        for batch in batches:
            for a, b, h, bucket, of_text in _pieces(batch):
                held = tokens.of(h, bucket).astype("<u2").tobytes()
                ids = [held[2 * x : 2 * y] for x, y in zip(of_text[:-1].tolist(), of_text[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(a, b - a) for c in ("deal", "round", "trainer")), pa.array(ids, pa.binary())], ["deal", "round", "trainer", "ids"])

    deal = F.xxhash64(F.lit(_SEED), "doc_id", "text")
    part = lambda bits, n: F.pmod(F.shiftright("deal", bits), F.lit(n)).cast("int")
    rows = docs.select("text", deal.alias("deal")).select("text", "deal", part(0, ROUNDS).alias("round"), part(8, trainers).alias("trainer"))
    return rows.mapInArrow(run, "deal long, round int, trainer int, ids binary").where(F.length("ids") > 0)


def _trainer(shared):
    """Trains one network for each trainer, from the shared one, on every token of its rows in order; yields the network in chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, state = shared.value
        trainer, network, held, size, trained = None, None, [], 0, 0

        def flush() -> None:
            nonlocal held, size, trained
            if held:
                of_text = np.r_[0, np.cumsum([len(x) for x in held])]
                network.train(np.concatenate(held).astype(np.int64), of_text, np.arange(size))
                trained += size
            held, size = [], 0

        def chunks() -> pa.RecordBatch:
            flush()
            parts = [network.state[k : k + _CHUNK].tobytes() for k in range(0, len(network.state), _CHUNK)] if trained else []
            n = len(parts)
            return pa.RecordBatch.from_arrays([pa.array(range(n), pa.int32()), pa.array([trainer] * n, pa.int32()), pa.array([trained] * n, pa.int64()), pa.array(parts, pa.binary())], ["chunk", "trainer", "n", "w"])

        for batch in batches:
            for t, ids in zip(*(batch.column(c).to_pylist() for c in ("trainer", "ids")), strict=True):
                if t != trainer:
                    if network is not None:
                        yield chunks()
                    trainer, network, trained = t, WindowNetwork(tokens, state), 0
                held.append(np.frombuffer(ids, "<u2"))
                size += len(held[-1])
                if size >= BLOCK:
                    flush()
        if network is not None:
            yield chunks()

    return run


def train_network(docs: DataFrame, tokens: Tokens) -> WindowNetwork:
    """Rounds of trainers that start from the last round's mean, each on its own rows; all rows are taken once, and every token of them is masked once.

    Rounds and trainers come from a hash of each row, and trainers from the number of tokens: the network
    does not depend on how the rows are partitioned. Equal rows (doc_id and text) meet in one trainer.
    """
    context = docs.sparkSession.sparkContext
    trainers = max(1, -(-tokens.total // TRAINER_TOKENS))
    rows = written(_training_rows(docs, context.broadcast(tokens), trainers), "lm-ids")
    network, schema = WindowNetwork(tokens), "chunk int, trainer int, n long, w binary"
    for k in range(ROUNDS):
        mine = rows.where(F.col("round") == k).select("trainer", "deal", "ids").repartitionById(trainers, F.col("trainer"))
        parts = mine.sortWithinPartitions("trainer", "deal", "ids").select("trainer", "ids").mapInArrow(_trainer(context.broadcast((tokens, network.state))), schema)
        if trainers > _SALTS:
            parts = parts.groupBy("chunk", F.pmod("trainer", F.lit(_SALTS))).applyInPandas(_mean, schema)
        found = sorted(parts.groupBy("chunk").applyInPandas(_mean, schema).select("chunk", "w").collect(), key=lambda r: r["chunk"])  # one network
        if found:
            network = WindowNetwork(tokens, np.concatenate([np.frombuffer(r["w"], np.float32) for r in found]))
    return network


@dataclass
class Scorer:
    """What scoring needs: the counts of all words, the ids and the network."""

    counts: DataFrame
    tokens: Tokens
    network: WindowNetwork


def fit(docs: DataFrame) -> Scorer:
    """Counts the words of all rows and trains on all of them."""
    docs = id_and_text(docs)
    counts = written(count_words(docs), "lm-words")
    tokens = learn_tokens(counts)
    return Scorer(counts, tokens, train_network(docs, tokens))


def _rare(h: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct words of each text, and how often they stand in it: (text, word, times)."""
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    new = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (text[1:] != text[:-1])][: len(h)])
    return text[new], h[new], np.diff(np.r_[new, len(h)])


def score(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """Per row of `docs`: doc_id, n_tokens, log_prob (sum of log P(token | both sides)), mean_log_prob.

    A word that the network knows by its bucket only has the bucket's probability in its context times its own count
    over the bucket's mass; one that the scorer has not seen counts as seen once. The counts stay a table, which the
    words of the texts are joined with.
    """
    shared = docs.sparkSession.sparkContext.broadcast((scorer.tokens, scorer.network.state))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = WindowNetwork(*shared.value)
        for batch in batches:
            for a, b, h, bucket, of_text in _pieces(batch):
                ids, n = network.tokens.of(h, bucket), np.diff(of_text)
                text = np.repeat(np.arange(b - a), n)
                rare = ids >= KNOWN
                log_prob = network.log_prob(ids, of_text)
                log_prob[rare] -= network.tokens.log_mass[ids[rare] - KNOWN]
                total = np.bincount(text, weights=log_prob, minlength=b - a).astype(np.float64)
                row = batch.column("row").slice(a, b - a).to_numpy()
                # one line for each text, under a word that no count is taken of, and one for each word known by its bucket
                of, word, times = _rare(h[rare], text[rare])
                none = pa.nulls(len(of), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.r_[row, row[of]]),
                        pa.array(np.r_[mix(row.view(np.uint64)), word].view(np.int64)),
                        pa.array(np.r_[np.zeros(b - a, np.int64), times]),
                        pa.concat_arrays([batch.column("doc_id").slice(a, b - a).cast(pa.int64()), none]),
                        pa.concat_arrays([pa.array(n.astype(np.int64)), none]),
                        pa.concat_arrays([pa.array(total), pa.nulls(len(of), pa.float64())]),
                    ],
                    ["row", "word", "times", "doc_id", "n_tokens", "log_prob"],
                )

    found = id_and_text(docs).withColumn("row", F.monotonically_increasing_id()).mapInArrow(run, "row long, word long, times long, doc_id long, n_tokens long, log_prob double")
    own = (F.col("times") * F.round(F.log(F.coalesce("n", F.lit(1)).cast("double")) * _UNIT).cast("long")).alias("own")
    lines = found.join(scorer.counts.select("word", "n"), "word", "left").select("row", "doc_id", "n_tokens", "log_prob", own)
    sums = lines.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("n_tokens").alias("n_tokens"), F.max("log_prob").alias("base"), F.sum("own").alias("own"))
    scored = sums.select("doc_id", "n_tokens", (F.col("base") + F.coalesce(F.col("own"), F.lit(0)) / _UNIT).alias("log_prob"))
    return scored.withColumn("mean_log_prob", F.when(F.col("n_tokens") > 0, F.col("log_prob") / F.col("n_tokens")))


def score_documents(docs: DataFrame) -> DataFrame:
    """Fits on all rows of `docs` and scores each: doc_id, n_tokens, log_prob, mean_log_prob; see score.

    Tokens are runs of letters and digits, lower-cased. Null and empty texts, and those without tokens, have
    0 tokens, log_prob 0 and a null mean. Word counts and training take in every row; repeated rows and doc_ids count
    as often as they stand and get a result each. Texts of any length count whole. Further columns, whatever their
    names, are not read. An empty table gives an empty result.
    """
    return score(docs, fit(docs))
