"""LM scores: against plain arithmetic, a unigram on held-out rows, and themselves under other partitions."""

import math
import random
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from quarry.llm import lm_score as lm
from quarry.llm.textnp import NOT_ALNUM, Words, buffers


def frame(spark, texts):
    return spark.createDataFrame([(k, t, "en", 1, 0.5) for k, t in enumerate(texts)], "doc_id long, text string, lang string, n_tokens int, log_prob double")


def plain_tokens(masses=None):
    """Tokens of a vocabulary without known words, every id as frequent as the next."""
    return lm.make_tokens(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(lm.OTHERS) if masses is None else masses)


def languages(rng, n_texts, words=80, stems=250):
    """Texts of two made-up languages, whose words never meet in one text."""
    kinds = [[f"{p}{k}" for k in range(stems)] for p in ("al", "ze")]
    return [" ".join(rng.choice(kinds[k % 2]) for _ in range(words)) for k in range(n_texts)]


def test_log_prob_is_the_plain_arithmetic():
    """The pseudo-likelihood of one text, token by token, in plain Python."""
    rng = np.random.default_rng(2)
    net = lm.WindowNetwork(plain_tokens(rng.integers(1, 50, lm.OTHERS).astype(float)))
    ids = rng.integers(0, lm.IDS, 9)
    of_text = np.array([0, 5, 5, 9])
    for _ in range(3):
        net.train(ids, of_text, np.arange(9))
    got = net.log_prob(ids, of_text)
    w, tok = net.weights, net.tokens
    for k, x in enumerate(ids.tolist()):
        first, end = (0, 5) if k < 5 else (5, 9)
        around = [int(ids[k + d]) if first <= k + d < end else lm.IDS for d in (-2, -1, 1, 2)]
        hidden = [math.tanh(sum(float(w["embedding"][j][c][i]) for j, c in enumerate(around)) + float(w["hidden_bias"][i])) for i in range(lm.DIM)]
        classes = [sum(h * float(w["out"][i][c]) for i, h in enumerate(hidden)) + float(w["out_bias"][c]) for c in range(lm.CLASSES)]
        c, m = int(tok.class_of[x]), int(tok.member_of[x])
        members = [sum(h * float(w["inner"][c][j][i]) for i, h in enumerate([*hidden, 1.0])) + float(tok.share[c][j]) for j in range(lm.MEMBERS)]
        log_sum = lambda xs: max(xs) + math.log(sum(math.exp(x - max(xs)) for x in xs))
        assert math.isclose(got[k], classes[c] - log_sum(classes) + members[m] - log_sum(members), abs_tol=1e-4)


def test_probabilities_of_all_ids_sum_to_one():
    net = lm.WindowNetwork(plain_tokens())
    one = np.array([0, 3])
    every = np.array([net.log_prob(np.array([1, x, 2]), one)[1] for x in range(lm.IDS)])
    assert np.isclose(np.exp(every).sum(), 1, atol=1e-3)


def test_network_tells_members_of_a_class_apart_by_both_sides():
    """Two words of one class and of equal counts, each between words of its own: the context says which."""
    tokens = plain_tokens()
    a, b = (int(np.flatnonzero((tokens.class_of == 5) & (tokens.member_of == m))[0]) for m in (3, 4))
    net = lm.WindowNetwork(tokens)
    ids, of_text = np.array([1, a, 2, 3, b, 4] * 1000), np.arange(0, 6001, 3)
    for _ in range(20):
        net.train(ids, of_text, np.arange(len(ids)))
    p = lambda x, y, z: net.log_prob(np.array([x, y, z]), np.array([0, 3]))[1]
    assert p(1, a, 2) > p(1, b, 2) + 1 and p(3, b, 4) > p(3, a, 4) + 1
    assert p(1, a, 2) > p(lm.IDS - 1, a, 2) > p(3, a, 4) or p(1, a, 2) > p(1, a, lm.IDS - 1)


def unigram(train, texts):
    n = Counter(w for t in train for w in t.split())
    total = sum(n.values())
    return sum(math.log(max(n[w], 1) / total) for t in texts for w in t.split())


def test_held_out_rows_are_told_better_than_by_a_unigram(spark):
    """Two languages of equal size: the context halves the words to choose from, log 2 nats a token at best."""
    texts = languages(random.Random(1), 3000)
    held = [t for k, t in enumerate(texts) if zlib.crc32(str(k).encode()) % 5 == 0]
    train = [t for k, t in enumerate(texts) if zlib.crc32(str(k).encode()) % 5]
    scorer = lm.fit(frame(spark, train))
    rows = lm.score(frame(spark, held), scorer).collect()
    n = sum(r["n_tokens"] for r in rows)
    assert n == 80 * len(held)
    gain = (sum(r["log_prob"] for r in rows) - unigram(train, held)) / n
    assert 0.5 < gain < math.log(2) + 0.02


@pytest.mark.parametrize("trainer_tokens", [lm.TRAINER_TOKENS, 7000])
def test_scores_do_not_depend_on_partitions(spark, monkeypatch, trainer_tokens):
    """With one trainer, and with several."""
    monkeypatch.setattr(lm, "TRAINER_TOKENS", trainer_tokens)
    docs = frame(spark, languages(random.Random(3), 400))
    one, many = ({r["doc_id"]: r["log_prob"] for r in lm.score_documents(docs.repartition(n)).collect()} for n in (1, 16))
    assert one.keys() == many.keys() and all(math.isclose(one[k], many[k], rel_tol=1e-4) for k in one)


def test_rows(spark):
    rows = lm.score_documents(frame(spark, ["a b c", "a b c", None, "", "... !", "a " * 300_000])).collect()
    found = {r["doc_id"]: r for r in rows}
    assert rows[0].asDict().keys() == {"doc_id", "n_tokens", "log_prob", "mean_log_prob"}
    assert found[0]["log_prob"] == found[1]["log_prob"] < 0 and found[0]["n_tokens"] == 3 and found[5]["n_tokens"] == 300_000
    assert all((found[k]["n_tokens"], found[k]["log_prob"], found[k]["mean_log_prob"]) == (0, 0.0, None) for k in (2, 3, 4))
    assert lm.score_documents(frame(spark, [])).count() == 0


def test_repeated_and_missing_ids_keep_their_rows(spark):
    docs = spark.createDataFrame([(1, "x y z"), (1, "x y z"), (1, "other words here"), (None, "x y"), (None, "x y")], "doc_id long, text string")
    rows = lm.score_documents(docs).collect()
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in rows) == [("1", 3), ("1", 3), ("1", 3), ("None", 2), ("None", 2)]


def test_words_outside_the_known_have_their_own_share(spark):
    """Texts of one word have one context, so the probabilities of all words add up to one; within a bucket they are as the counts."""
    seen = {f"{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{k}": 1 + k % 3 for k in range(lm.KNOWN + 3000)}
    words = [w for w, n in seen.items() for _ in range(n)]
    rows = lm.score_documents(frame(spark, words).coalesce(4)).collect()
    log_prob = {words[r["doc_id"]]: r["log_prob"] for r in rows}
    assert len(rows) == len(words) and 0.9 < np.exp(list(log_prob.values())).sum() < 1.01
    found = Words(*buffers(pa.array(list(seen))), NOT_ALNUM)
    rank = sorted(zip(seen, found.hashes().view(np.int64).tolist(), found.prefix_hashes(lm.PREFIX).tolist(), strict=True), key=lambda x: (-seen[x[0]], x[1]))
    once = {}
    for w, _, p in rank[lm.KNOWN :]:
        once.setdefault((p >> 40) % lm.OTHERS, set()).add(round(log_prob[w], 4))
    assert len(once) > 100 and all(len(v) == 1 for v in once.values())


def test_every_token_is_masked_once_in_training(spark, monkeypatch):
    """Also those of texts of one or two tokens, and of a text longer than a block."""
    monkeypatch.setattr(lm, "BLOCK", 50)
    texts = ["a", "a b", "a b c", "a b c d", None, "x " * 301] + ["one two three four five"] * 20
    tokens = plain_tokens()
    rows = lm._training_rows(frame(spark, texts), spark.sparkContext.broadcast(tokens), 1).toArrow()
    trained, train = Counter(), lm.WindowNetwork.train

    def seen(self, ids, of_text, places):
        assert len(set(places.tolist())) == len(places)
        trained.update(ids[places].tolist())
        train(self, ids, of_text, places)

    monkeypatch.setattr(lm.WindowNetwork, "train", seen)
    out = list(lm._trainer(SimpleNamespace(value=(tokens, None)))(iter(rows.to_batches())))
    assert trained == Counter(np.frombuffer(b"".join(rows.column("ids").to_pylist()), "<u2").tolist()) and sum(trained.values()) == 1 + 2 + 3 + 4 + 301 + 100
    assert set(out[-1].column("n").to_pylist()) == {411}


@pytest.mark.parametrize("safe", [True, False])
def test_shifted_and_plain_exponentials_agree(safe):
    """Logits of large weights are shifted, and their sums stay finite."""
    rng = np.random.default_rng(4)
    logits = rng.normal(0, 5, (7, lm.MEMBERS)).astype(np.float32)
    expected = [math.log(sum(math.exp(x) for x in row)) for row in logits.astype(float).tolist()]
    assert np.allclose(lm._log_sum(logits.copy(), safe), expected, rtol=1e-5)
    rows = rng.normal(0, 50, (3, lm.MEMBERS, lm.DIM + 1)).astype(np.float32)
    assert not lm._safe(rows).any() and lm._safe(rows / 1000).all()
    assert np.allclose(lm._log_sum(logits * 100, False), (logits * 100).max(axis=1), atol=5)


def test_a_step_sums_and_shifts_no_more_than_it_needs(monkeypatch):
    """A training step sums changes over the ids that occur, not over all, and takes the softmax of all members at once; logits beyond SAFE are shifted."""
    rng = np.random.default_rng(6)
    net = lm.WindowNetwork(plain_tokens())
    ids, calls, wide = rng.integers(0, lm.IDS, 300), [], []
    exp, bincount = lm._exp, np.bincount
    monkeypatch.setattr(lm, "_exp", lambda logits, safe: (calls.append(len(logits)), exp(logits, safe))[1])
    monkeypatch.setattr(np, "bincount", lambda *a, **b: (wide.append(b.get("minlength", 0)), bincount(*a, **b))[1])
    net.train(ids, np.array([0, 300]), np.arange(300))
    assert calls == [300, 300] and max(wide) < lm.IDS
    before = net.weights["embedding"].copy()
    net.weights["out_bias"][3], net.weights["inner"][:, 0, -1] = 200, -300
    net.weights["inner"][:, 1, -1] = 150
    net.train(ids, np.array([0, 300]), np.arange(300))
    assert np.isfinite(net.state).all() and not np.array_equal(before, net.weights["embedding"])
    logits = np.array([[-300.0, 150, 149], [1, 2, -np.inf], [-90, -91, -92]], np.float32)
    expected = [[math.exp(x - max(row)) / sum(math.exp(y - max(row)) for y in row) / 2 for x in row] for row in logits.astype(float).tolist()]
    lm._shares(logits, 2)
    assert np.allclose(logits, expected, atol=1e-6)
