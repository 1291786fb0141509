"""Near duplicates, repeats, mixing, search, decontamination, toxicity, the pipeline: against brute force."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from quarry.llm import common, decontam, minhash, mixing, topk_search, toxicity
from quarry.llm.components import components
from quarry.llm.suffix_array import repeated_starts, suffix_order
from quarry.llm import suffix_dedup
from quarry.llm.suffix_dedup import remove_repeats
from quarry.llm.suffix_spark import suffix_ranks, windows_of
from quarry.llm.textnp import buffers
from quarry.llm.topk_search import top_k

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, texts, source=None):
    rows = [(k, t, "en", source(k) if source else "s", 0) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def prose(rng, n, vocab=3000):
    return " ".join(f"w{rng.randrange(vocab)}" for _ in range(n))


def edited(rng, text, changes):
    words = text.split(" ")
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return " ".join(words)


def brute_components(texts, n, percent):
    def shingles(t):
        w = WORD.findall((t or "").translate(str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})))
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()

    sets = [shingles(t) for t in texts]
    label = list(range(len(texts)))
    changed = True
    links = [(i, j) for i in range(len(texts)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    while changed:
        changed = False
        for i, j in links:
            low = min(label[i], label[j])
            changed |= label[i] != low or label[j] != low
            label[i] = label[j] = low
    return [(k, len(s), label[k]) for k, s in enumerate(sets)]


@pytest.mark.parametrize(("n", "percent", "block"), [(3, 85, 64), (5, 80, 64), (3, 85, 4)])
def test_near_duplicates(spark, monkeypatch, n, percent, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rng = random.Random(4)
    base = [prose(rng, 80) for _ in range(6)]
    texts = [None, "", "  ", "one", "One", "one two", "a b c", *base, base[0], base[0].upper().lower()]
    texts += [edited(rng, base[1], 1) for _ in range(12)] + [edited(rng, base[2], k % 4) for k in range(20)] + [prose(rng, 40) for _ in range(10)]
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(frame(spark, texts), n, percent).collect())
    assert got == [(k, size, c, k == c) for k, size, c in brute_components(texts, n, percent)]


def test_near_duplicates_of_nothing(spark):
    assert minhash.near_duplicates(frame(spark, [])).count() == 0
    nulls = spark.createDataFrame([(None, "a b c d"), (3, "a b c d")], "doc_id long, text string")
    assert sorted((str(r["component_id"]), r["kept"]) for r in minhash.near_duplicates(nulls).collect()) == [("3", True), ("None", True)]


def test_near_duplicates_of_repeated_ids_and_long_texts(spark):
    rng = random.Random(8)
    long = prose(rng, 150_000, 10**6)
    rows = [(3, long, 0, True), (9, long + " more", 0, True), (3, "a b c d", 0, True), (5, "a b c d", 0, True), (4, None, 0, True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id int, kept boolean")
    found = sorted((r["doc_id"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(docs).collect())
    assert found == [(3, 3, True), (3, 3, True), (4, 4, True), (5, 3, False), (9, 3, False)]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), max_size=14))
def test_components(spark, edges):
    label = {x: x for e in edges for x in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {x: c for x, c in label.items() if any(x in e and e[0] != e[1] for e in edges)}


@settings(max_examples=150, deadline=None)
@given(st.binary(max_size=60).map(lambda b: bytes(x % 3 for x in b)), st.integers(1, 6))
def test_suffix_order_and_repeats(data, length):
    text = np.frombuffer(data, np.uint8)
    assert suffix_order(text.astype(np.int64) + 1).tolist() == sorted(range(len(data)), key=lambda k: data[k:])
    starts = np.arange(max(0, len(data) - length + 1))
    seen = Counter(data[k : k + length] for k in starts)
    assert repeated_starts(text, starts, length).tolist() == [seen[data[k : k + length]] > 1 for k in starts]


def test_suffix_order_over_all_executors(spark):
    for data in (b"aaaaaaa", bytes(random.Random(1).choice(b"ab") for _ in range(130))):
        symbols = spark.createDataFrame([(k, x + 2) for k, x in enumerate(data)], "pos long, c long")
        found = sorted((r["rank"], r["pos"]) for r in suffix_ranks(windows_of(symbols), len(data), len(data)).collect())
        assert [r for r, _ in found] == list(range(len(data))) and [p for _, p in found] == sorted(range(len(data)), key=lambda k: data[k:])


def removed_by_hand(texts, length=200):
    """(bytes, removed, spans, digest of the rest) of each text."""
    held = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in held for i in range(len(b) - length + 1))
    out = []
    for b in held:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(x for x, g in zip(b, gone, strict=False) if not g)
        out.append((len(b), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum() + gone[0]), hashlib.sha256(kept).hexdigest()))
    return out


def removed(rows):
    return [tuple(r)[1:5] for r in sorted(rows, key=lambda r: r["doc_id"])]


@pytest.mark.parametrize("group_bytes", [1 << 21, 2100, 400])
def test_repeats_are_removed(spark, group_bytes):
    """Groups sorted whole in tasks, dealt by their ends, and sorted over all executors."""
    rng = random.Random(2)
    shared = [prose(rng, 60) for _ in range(3)]
    texts = [None, "", "short", "short", "x" * 450, "é" * 150, *(f"{prose(rng, 30)} {shared[k % 3]} {prose(rng, 30)}" for k in range(12)), prose(rng, 90)]
    texts += [texts[-1], shared[0][:150], shared[0][20:230] + "!", prose(rng, 2000) + shared[1][30:250] + prose(rng, 2000)]
    assert removed(remove_repeats(frame(spark, texts), 200, group_bytes).collect()) == removed_by_hand(texts)
    assert remove_repeats(frame(spark, [])).count() == 0


def test_repeats_with_anchors_that_tie(spark, monkeypatch):
    """Hashes that agree in their high bits, in pieces of different size: the same strings still have the same anchors."""
    honest = suffix_dedup._gram_hashes
    monkeypatch.setattr(suffix_dedup, "_gram_hashes", lambda raw: honest(raw) & np.uint64(0xFFF) | (honest(raw) & np.uint64(3)) << np.uint64(62))
    rng = random.Random(5)
    texts = [prose(rng, 50) for _ in range(3)]
    texts += [prose(rng, 9000) + texts[0] + prose(rng, 40), prose(rng, 20) + texts[0] + prose(rng, 20), texts[1] + texts[0]]

    def found(batch):
        raw = np.frombuffer("".join(batch).encode(), np.uint8)
        offsets = np.r_[0, np.cumsum([len(t.encode()) for t in batch])]
        text, first, n, anchor, _ = suffix_dedup.owned_starts(raw, offsets, 200)
        return {(batch[t].encode()[f + k : f + k + 200], int(a)) for t, f, m, a in zip(text, first, n, anchor, strict=True) for k in range(m)}

    alone = set().union(*(found([t]) for t in texts))
    assert found(texts) == alone and len({s for s, _ in alone}) == len(alone)


def test_repeated_rows_and_clashing_columns(spark):
    long = prose(random.Random(3), 60)
    rows = [(1, long, 5, 0), (1, long, 6, 1), (1, "other", 7, 2), (None, long[:250], 8, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_removed int, `row` long")
    found = sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"]) for r in remove_repeats(docs).collect())
    size = len(long.encode())
    assert found == sorted([("1", size, size), ("1", size, size), ("1", 5, 0), ("None", 250, 250)])


def filled_targets(sizes):
    """The contract in exact fractions: 1, 2, 3, repeating, by code point, null last; what passes 3 times a source goes to the rest by weight."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: Fraction([1, 2, 3][k % 3]) for k, s in enumerate(names)}
    total, capped = Fraction(sum(sizes.values())), set()
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(3 * sizes[s] for s in capped)
        want = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if want[s] > 3 * sizes[s]}
        if not over:
            return {s: Fraction(3 * sizes[s]) if s in capped else want[s] for s in names}
        capped |= over


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.one_of(st.none(), st.text(max_size=3)), st.integers(0, 1000), max_size=6))
def test_targets(sizes):
    got, want = mixing.targets(sizes), filled_targets(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - float(want[s])) <= 1e-6 * max(1, float(want[s])) for s in sizes)
    assert all(got[s] <= 3 * sizes[s] + 1e-6 for s in sizes)


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 6), max_size=8), st.integers(0, 400))
def test_fit_stays_in_bounds_and_near(lengths, budget):
    sizes, counts = list(lengths), list(lengths.values())
    take = mixing.fit(sizes, counts, budget)
    total = sum(n * t for n, t in zip(sizes, take, strict=True))
    assert all(0 <= t <= c for t, c in zip(take, counts, strict=True)) and total <= budget
    if sizes:
        assert min(budget, sum(n * c for n, c in lengths.items())) - total <= max(sizes)


def test_mixing(spark):
    rng = random.Random(3)
    texts = [prose(rng, rng.randrange(1, 60)) for _ in range(400)] + [None, "", "same text here"] + ["same text here"] * 60
    docs = frame(spark, texts, lambda k: None if k % 11 == 0 else f"s{k % 4}")
    rows = mixing.mix_sources(docs).collect()
    again = mixing.mix_sources(docs.repartition(3)).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in rows) == sorted((r["doc_id"], r["taken"]) for r in again)
    taken, target, size = defaultdict(int), {}, defaultdict(int)
    for r in rows:
        assert r["size"] == len(WORD.findall(texts[r["doc_id"]] or "")) and r["taken"] <= 3 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0)
        taken[r["source"]] += r["taken"]
        size[r["source"]] += r["size"]
        target[r["source"]] = (r["target"], r["source_size"])
    want = filled_targets(size)
    for s in target:
        assert abs(target[s][0] - float(want[s])) < 1e-6 and target[s][1] == size[s] and abs(taken[s] - want[s]) <= 2
    assert mixing.mix_sources(frame(spark, [])).count() == 0
    copies = Counter(r["doc_id"] for r in mixing.mixed(docs).collect())
    assert copies == Counter({r["doc_id"]: r["taken"] // r["size"] for r in rows if r["taken"]})


def test_mixing_of_repeated_and_missing_ids(spark):
    """Rows that share a doc_id, or have none, and columns named as the results: the mix takes as many words as it plans."""
    rng = random.Random(4)
    rows = [(None if k % 3 == 0 else 1, prose(rng, 1 + k % 9), f"s{k % 4}", k, "x") for k in range(200)] + [(1, "same words", "s1", 9, "x")] * 30
    rows += [(5, "long " * 50_000, "s2", 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size int, target string")
    plan = mixing.mix_sources(docs).collect()
    out = mixing.mixed(docs).collect()
    assert len(plan) == len(rows) and out[0].__fields__ == docs.columns
    words = Counter()
    for r in out:
        words[r["source"]] += len(WORD.findall(r["text"]))
    want = Counter()
    for r in plan:
        want[r["source"]] += r["taken"]
    assert words == want and mixing.mixed(docs.limit(0)).count() == 0


@pytest.mark.parametrize("scale", [1.0, 1e6])
def test_top_k(spark, scale):
    rng = np.random.default_rng(5)
    held = (rng.integers(-3, 4, (260, 7)) / 8 * scale).tolist()
    held[3], held[4], held[5], held[6] = None, [None] * 7, [float("nan")] + [0.0] * 6, [float("inf")] + [0.0] * 6
    held += [[1.0, 2.0], [3.0, 4.0]]
    ids = [*range(0, 2580, 10)] + [7, 2600, 2601, 2700]
    ids = ids[: len(held)] + [9000 + k for k in range(len(held) - len(ids))]
    rows = spark.createDataFrame(list(zip(ids, held, strict=True)), "vec_id long, embedding array<double>")
    usable = {i: [int(np.floor(1024 * x)) for x in v] for i, v in zip(ids, held, strict=True) if v and all(x is not None and np.isfinite(x) for x in v)}
    want = []
    for q, a in usable.items():
        if q % 100 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), c) for c, b in usable.items() if c != q and len(a) == len(b))[:10]
            want += [(q, k + 1, c, -s) for k, (s, c) in enumerate(scores)]
    assert sorted(map(tuple, top_k(rows, 10, 100, query_components=40).collect())) == sorted(want)
    assert top_k(rows.limit(0)).count() == 0


def test_top_k_of_repeated_queries(spark):
    """A vec_id that stands twice asks twice, and is no candidate of its own; columns named as the results do no harm."""
    held = [(100, [1.0, 0.0], 1), (100, [0.0, 1.0], 2), (7, [0.5, 0.25], 3), (8, [0.25, 0.5], 4), (8, [0.25, 0.5], 5)]
    rows = spark.createDataFrame(held, "vec_id long, embedding array<float>, score int")
    for components in (4_000_000, 2):
        got = sorted(map(tuple, top_k(rows, 2, 100, query_components=components).collect()))
        assert got == sorted([(100, 1, 7, 524288), (100, 2, 8, 262144), (100, 1, 8, 524288), (100, 2, 8, 524288)])


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_bounds_leave_few_products(spread):
    """Of clustered vectors, and of vectors without any structure, under half of the pairs are multiplied out, and none of the best is lost."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 32))
    vectors = np.floor(1024 * (centres[rng.integers(0, 20, 4000)] * (1 - spread) + spread * rng.normal(size=(4000, 32)))).astype(np.int64)
    ids = np.arange(4000)
    asked = ids % 100 == 0
    floor = topk_search.first_floor(ids[asked], vectors[asked], ids[::8], vectors[::8], 10)
    search = topk_search.Search(ids[asked], vectors[asked], 10, topk_search.axes(vectors[::8]), floor)
    for a in range(0, 4000, topk_search.BLOCK):
        search.feed(ids[a : a + topk_search.BLOCK], vectors[a : a + topk_search.BLOCK])
    for k, q in enumerate(ids[asked]):
        scores = vectors @ vectors[q]
        best = sorted((x for x in ids if x != q), key=lambda x: (-scores[x], x))[:10]
        assert search.of[k].tolist() == best
    assert search.seen == 40 * 4000 and search.multiplied < (0.1 if spread < 1 else 0.5) * search.seen


def items_and_docs():
    rng = random.Random(6)
    items = [f"{prose(rng, 20, 400)}? {prose(rng, 9, 400)}." for _ in range(40)] + ["", None, "tiny one."]
    held = {0: 3, 1: 5, 2: 8, 3: 42}
    docs = [prose(rng, 300, 400) for _ in range(30)] + [None, ""]
    for d, i in held.items():
        words = docs[d].split(" ")
        docs[d] = " ".join(words[:77]) + " " + (items[i].upper() if d == 1 else items[i]) + "! " + " ".join(words[77:])
    docs[4] += " " + items[9][: len(items[9]) // 3]
    return items, docs, held


def test_leaks(spark):
    items, docs, held = items_and_docs()
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontam.find_leaks(frame(spark, docs), benchmark).collect()}
    tiny = {(k, 42) for k, d in enumerate(docs) if d and "tiny one" in d.lower()}
    assert found == set(held.items()) | tiny
    left = {r["doc_id"] for r in decontam.decontaminate(frame(spark, docs), benchmark).collect()}
    assert left == set(range(len(docs))) - set(held)
    assert decontam.find_leaks(frame(spark, docs), benchmark.limit(0)).count() == 0


def test_leaks_do_not_depend_on_blocks(spark, monkeypatch):
    """Scores too: the index of each block knows the statistics of all items."""
    items, docs, held = items_and_docs()
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rows = lambda: sorted(map(tuple, decontam.find_leaks(frame(spark, docs), benchmark).collect()))
    whole = rows()
    monkeypatch.setattr(decontam, "INDEX_CHARS", 2500)
    blocked = rows()
    assert [x[:2] for x in blocked] == [x[:2] for x in whole] and {x[:2] for x in whole} >= set(held.items())
    assert np.allclose([x[2:] for x in blocked], [x[2:] for x in whole])
    left = {r["doc_id"] for r in decontam.decontaminate(frame(spark, docs), benchmark).collect()}
    assert left == set(range(len(docs))) - {x[0] for x in whole}


def test_leaks_of_repeated_ids_and_long_texts(spark):
    rng = random.Random(12)
    item = f"{prose(rng, 20, 400)}? {prose(rng, 9, 400)}."
    benchmark = spark.createDataFrame([(1, item, 0), (1, "quite another text of some words here", 0), (2, item, 0), (None, item, 0)], "item_id long, text string, leaks int")
    long = prose(rng, 60_000, 400) + " " + item + " " + prose(rng, 1000, 400)
    rows = [(4, item, "a"), (4, item, "b"), (4, "no", "c"), (None, long, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, leaks string")
    found = sorted((str(r["doc_id"]), r["item_id"]) for r in decontam.find_leaks(docs, benchmark).collect())
    assert found == [("4", 1), ("4", 1), ("4", 2), ("4", 2), ("None", 1), ("None", 2)]
    marked = decontam.mark_leaks(docs, benchmark)
    assert marked.columns == ["doc_id", "text", "leaks"] and marked.count() == 4
    assert [r["leaks"] for r in decontam.decontaminate(docs, benchmark).collect()] == ["c"]


def test_wand_finds_what_scores_find():
    rng = random.Random(8)
    texts = [prose(rng, rng.randrange(6, 40), 120) for _ in range(300)]
    index = decontam.ItemIndex(list(range(300)), texts)
    for _ in range(40):
        terms = sorted(rng.sample(range(len(index.lists)), 60))
        scores = defaultdict(float)
        for t in terms:
            for i, v in zip(index.lists[t].items, index.lists[t].impacts, strict=True):
                scores[i] += v
        want = {i for i, v in scores.items() if v >= 0.55}
        assert {i for i, _ in index.retrieve(terms, 0.55, 0, 300)} == want


def toxic_corpus():
    rng = random.Random(9)
    bad = ["idiot", "moron", "scum", "loser"]
    texts, labels = [], []
    for k in range(900):
        words = prose(rng, 50, 500).split(" ")
        if k % 5 == 0:
            for _ in range(3):
                words[rng.randrange(50)] = rng.choice(bad)
        texts.append(" ".join(words))
        labels.append((k, int(k % 5 == 0)))
    return texts, labels


def test_toxicity_on_held_out_rows(spark):
    texts, labels = toxic_corpus()
    docs = frame(spark, [*texts, None, ""])
    marked = spark.createDataFrame(labels + [(5, None), (None, 1)], "doc_id long, toxic int")
    rows = {r["doc_id"]: r for r in toxicity.toxicity(docs, marked).collect()}
    held = [k for k, _ in labels if zlib.crc32(str(k).encode()) % 5 == 0]
    assert np.mean([rows[k]["predicted"] == labels[k][1] for k in held]) >= 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows.values())
    assert rows[900]["score"] == rows[901]["score"] and rows[900]["predicted"] == 0


def test_toxicity_without_labels(spark):
    docs = frame(spark, ["a", None])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r["predicted"] for r in toxicity.toxicity(docs, none).collect()] == [0, 0]
    assert toxicity.toxicity(docs.limit(0), none).count() == 0
    # labels of one kind say nothing of the other
    one = spark.createDataFrame([(k, 1) for k in range(9)], "doc_id long, toxic int")
    assert {r["predicted"] for r in toxicity.toxicity(frame(spark, ["bad words"] * 12), one).collect()} == {0}


def test_toxicity_is_trained_in_a_task(spark, monkeypatch):
    """The driver holds no training rows, and the model is that of the same rows trained here."""
    texts, labels = toxic_corpus()
    docs, marked = frame(spark, texts), spark.createDataFrame(labels, "doc_id long, toxic int")
    held, train = [], toxicity.train

    def seen(texts, labels, counts, *more):
        model = train(texts, labels, counts, *more)
        model.thresholds["trained in"] = os.getpid()
        held.append(len(texts))
        return model

    monkeypatch.setattr(toxicity, "train", seen)
    model = toxicity.fit(docs, marked, epochs=2)
    assert model.thresholds["trained in"] != os.getpid() and not held
    training = marked.where("crc32(cast(doc_id as string)) % 5 > 1")
    rows = toxicity._sample(docs, training, 5)[0].orderBy("doc_id").collect()
    y = np.array([r["toxic"] for r in rows])
    here = train([np.frombuffer(r["words"], np.uint64) for r in rows], y, (int((y == 0).sum()), int(y.sum())), 5, 2)
    assert len(rows) > 50 and all(np.allclose(getattr(here, x), getattr(model, x), atol=1e-3) for x in ("embedding", "filters", "weights"))


def test_toxicity_rows(spark):
    """Repeated and missing doc_ids, very long texts, columns named as the results."""
    texts, labels = toxic_corpus()
    rows = [(k, t, "en", 1, 7.5, "kept") for k, t in enumerate(texts)]
    rows += [(3, "idiot " * 200_000, "xx", 1, 7.5, "kept"), (3, "", None, 1, 7.5, "kept"), (None, "idiot scum moron loser", "en", 1, 7.5, "kept")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, predicted int, score double, other string")
    marked = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(docs, marked, epochs=3)
    found = toxicity.score_toxicity(docs, model)
    assert found.columns == ["doc_id", "text", "lang", "other", "score", "predicted", "rejected"]
    out = found.collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 and r["other"] == "kept" for r in out)
    assert [r["predicted"] for r in out if r["doc_id"] is None or len(r["text"]) > 10**6] == [1, 1]
    assert toxicity.keep_clean(docs, model).columns == docs.columns


def test_forward_pass_is_the_plain_arithmetic():
    rng = np.random.default_rng(1)
    n = toxicity.FILTERS * len(toxicity.WIDTHS)
    model = toxicity.ToxicityModel(*(rng.normal(0, 1, s).astype(np.float32) for s in ((toxicity.BUCKETS, toxicity.DIM), ((toxicity.PAD + 1) * toxicity.DIM, n), n, n)), 0.3)
    texts = ["one two three four five", "", "word"]
    packed, offsets = toxicity.word_features(*buffers(pa.array(texts)))
    got = model.logits(packed, offsets)
    for k in range(len(texts)):
        words = [sum(model.embedding[int(p) >> (18 * j) & (toxicity.BUCKETS - 1)] for j in range(3)) for p in packed[offsets[k] : offsets[k + 1]]]
        words += [np.zeros(toxicity.DIM)] * toxicity.PAD
        best = np.zeros(n)  # relu: no filter gives less
        for at in range(len(words)):
            window = np.concatenate([words[at + j] if at + j < len(words) else np.zeros(toxicity.DIM) for j in range(toxicity.PAD + 1)])
            best = np.maximum(best, window @ model.filters + model.filter_bias)
        assert np.isclose(got[k], best @ model.weights + model.bias, rtol=1e-4)


def test_trained_network_beats_counts_of_labels():
    """On the held-out fold of a table: the network from its random start against the largest log odds of a word by label counts."""
    folder = "/root/testdata/sf0.1"
    docs = pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text"]).to_pandas()
    docs = docs.merge(pq.read_table(f"{folder}/labels.parquet").to_pandas(), on="doc_id")
    fold = np.array([zlib.crc32(str(x).encode()) % 5 for x in docs.doc_id])
    y = docs.toxic.to_numpy()
    packed, offsets = toxicity.word_features(*buffers(pa.array(docs.text.tolist(), pa.large_string())))
    texts = [packed[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    kept, held = np.flatnonzero(fold > 1), np.flatnonzero(fold == 0)
    counts = (int((y[kept] == 0).sum()), int((y[kept] == 1).sum()))
    hits = np.zeros((2, toxicity.BUCKETS))
    for k in kept:
        hits[y[k], np.unique(toxicity._unpack(texts[k]).ravel())] += 1
    odds = np.where(hits.sum(axis=0) > 0, np.log((hits[1] + 0.5) / (counts[1] + 1)) - np.log((hits[0] + 0.5) / (counts[0] + 1)), 0)
    odds = np.clip(odds, -3, 3) * np.minimum(1, hits.sum(axis=0) / 8)
    of_counts = np.array([odds[toxicity._unpack(t)].sum(axis=1).max() if len(t) else 0 for t in texts])

    def logits(model):
        return np.concatenate([model.logits(*toxicity._joined(texts[a : a + 64])) for a in range(0, len(texts), 64)])

    def figures(scores):
        """Accuracy at the cut of the calibration fold, and the share of pairs in the right order."""
        calibration = np.flatnonzero(fold == 1)
        scores = np.clip(scores, -toxicity.MOST_LOGIT, toxicity.MOST_LOGIT)
        cut = toxicity._cut(np.floor(scores[calibration] * toxicity.BINS).astype(int), y[calibration], np.ones(len(calibration)))
        bad, good = scores[held][y[held] == 1], scores[held][y[held] == 0]
        order = (bad[:, None] > good).mean() + (bad[:, None] == good).mean() / 2
        return ((scores[held] >= cut) == y[held]).mean(), order

    start, trained, plain = (figures(x) for x in (logits(toxicity.train([texts[k] for k in kept], y[kept], counts, epochs=0)), logits(toxicity.train([texts[k] for k in kept], y[kept], counts)), of_counts))
    assert start[1] < 0.8 and trained[0] > max(plain[0], 0.975) and trained[1] > max(plain[1], 0.97)


def test_thresholds_are_those_of_all_labelled_rows(spark, monkeypatch):
    """Texts that are clean two times in three stay clean, though toxic rows are as many as clean ones in the sample."""
    monkeypatch.setattr(toxicity, "MOST_TOXIC", 40)
    monkeypatch.setattr(toxicity, "MOST_CLEAN", 40)
    kinds = [("good kind words", 0)] * 600 + [("grey mixed lines", 0)] * 80 + [("grey mixed lines", 1)] * 40 + [("bad foul speech", 1)] * 40
    docs = frame(spark, [t for t, _ in kinds])
    labels = spark.createDataFrame([(k, y) for k, (_, y) in enumerate(kinds)], "doc_id long, toxic int")
    found = {(kinds[r["doc_id"]][0], r["predicted"], r["rejected"]) for r in toxicity.toxicity(docs, labels).collect()}
    assert found == {("good kind words", 0, False), ("grey mixed lines", 0, False), ("bad foul speech", 1, True)}


def test_pipeline_stages(spark, tmp_path):
    texts, labels = toxic_corpus()
    rng = random.Random(1)
    clean = [k for k in range(900) if k % 5]
    texts[clean[3]] = texts[clean[2]]
    texts[clean[5]] = edited(rng, texts[clean[4]], 1)
    item = prose(rng, 30, 5000)
    texts[clean[7]] += " " + item
    docs = frame(spark, texts, lambda k: f"s{k % 3}")
    where = str(tmp_path)
    docs.write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame([(k, 1, y) for k, y in labels], "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{where}/benchmark.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert len(corpus_pipeline.STAGES) == 5
    kept = stages["toxicity"](spark, docs, where)
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}
    assert kept.columns == docs.columns and len(ids(kept) ^ set(clean)) <= 20
    kept = stages["minhash_near_dedup"](spark, docs.where("doc_id % 5 <> 0"), where)
    assert ids(kept) == set(clean) - {clean[3], clean[5]}
    kept = stages["benchmark_decontamination"](spark, kept, where)
    assert kept.columns == docs.columns and ids(kept) == set(clean) - {clean[3], clean[5], clean[7]}
    mixed = stages["source_mixing"](spark, kept, where)
    assert mixed.columns == docs.columns and ids(mixed) <= ids(kept)
    rows = corpus_pipeline.run(spark, where)
    assert rows.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and rows.count() > 0


def test_freed_native_memory_goes_back(spark, monkeypatch):
    """What the driver's JVM frees outside its heap leaves the process when an intermediate table is written or cut."""
    jvm = spark._jvm

    def held():
        return int(re.search(r"RssAnon:\s+(\d+)", Path(f"/proc/{jvm.java.lang.ProcessHandle.current().pid()}/status").read_text())[1]) / 1024

    assert common.trimmed(spark)
    used = [jvm.java.util.zip.Deflater() for _ in range(600)]
    for k, x in enumerate(used):
        if k % 20:  # the rest keep the arena from shrinking by itself
            x.end()
    before = held()
    assert common.trimmed(spark) and held() < before - 20
    calls = []
    monkeypatch.setattr(common, "trimmed", calls.append)
    assert common.cut(spark.range(3)).count() == common.written(spark.range(3), "trim").count() == 3 and len(calls) == 2
