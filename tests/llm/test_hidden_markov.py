from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortline.llm import hidden_markov as hm
from cohortline.llm.common import fold

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def small_model(states=3, classes=5, seed=1):
    rng = np.random.default_rng(seed)
    emit = rng.dirichlet(np.ones(classes), states).T.copy()
    return hm.Model(
        rng.dirichlet(np.ones(states)), rng.dirichlet(np.ones(states), states), emit, classes, np.ones(classes), np.ones(classes)
    )


def test_likelihood_is_the_sum_over_all_state_paths():
    model = small_model()
    for seq in ([0], [1, 4], [2, 2, 0, 3], [4, 0, 1, 2, 3, 0]):
        total = 0.0
        for path in product(range(3), repeat=len(seq)):
            p = model.start[path[0]] * model.emit[seq[0], path[0]]
            for a, b, o in zip(path, path[1:], seq[1:]):
                p *= model.move[a, b] * model.emit[o, b]
            total += p
        got = hm.likelihoods(model, [np.array([0], np.uint16), np.array(seq, np.uint16)])[1]
        assert abs(got - math.log(total)) < 1e-9


def test_expected_counts_equal_brute_force():
    model = small_model()
    seqs = [np.array(s, np.uint16) for s in ([0, 1], [3], [2, 4, 1, 0])]
    begin, moves, emissions = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
    for seq in seqs:
        paths = {}
        for path in product(range(3), repeat=len(seq)):
            p = model.start[path[0]] * model.emit[seq[0], path[0]]
            for a, b, o in zip(path, path[1:], seq[1:]):
                p *= model.move[a, b] * model.emit[o, b]
            paths[path] = p
        total = sum(paths.values())
        for path, p in paths.items():
            begin[path[0]] += p / total
            for a, b in zip(path, path[1:]):
                moves[a, b] += p / total
            for z, o in zip(path, seq):
                emissions[o, z] += p / total
    got = hm.expected(model, seqs)
    for a, b in zip(got, (begin, moves, emissions)):
        assert np.allclose(a, b)


def test_batches_do_not_change_results(monkeypatch):
    model = small_model()
    rng = np.random.default_rng(0)
    seqs = [rng.integers(0, 5, n).astype(np.uint16) for n in (1, 50, 3, 700, 20, 20)]
    whole, counts = hm.likelihoods(model, seqs), hm.expected(model, seqs)
    monkeypatch.setattr(hm, "BATCH_TOKENS", 30)
    assert np.allclose(hm.likelihoods(model, seqs), whole)
    assert all(np.allclose(a, b) for a, b in zip(hm.expected(model, seqs), counts))


def base_scores(rows, learned):
    tokens = {k: [*WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), None] for k, t in rows}
    counts = Counter(w for k in learned for w in tokens[k])
    n, v = sum(counts.values()), len(counts)
    return {
        k: (len(w), sum(counts[x] > 0 for x in w), n, sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w))
        for k, w in tokens.items()
    }


@pytest.fixture(scope="module")
def awkward(docs):
    return [(n, r["doc_id"], r["text"]) for n, r in enumerate(docs.select("doc_id", "text").collect())]


def learns(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 != 2


def test_base_scores_equal_brute_force(docs, awkward):
    wanted = base_scores([(n, t) for n, _, t in awkward], [n for n, i, _ in awkward if learns(i)])
    expected = sorted((str(i), *wanted[n][:3], round(wanted[n][3], 6)) for n, i, _ in awkward)
    rows = hm.score_texts(docs, fold("doc_id", 7) != 2, rounds=1).collect()
    got = sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in rows)
    assert [g[:4] for g in got] == [e[:4] for e in expected]
    assert all(abs(g[4] - e[4]) < 1e-5 for g, e in zip(got, expected))
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in rows)


def test_frequent_words_are_those_of_all_training_texts(spark, monkeypatch):
    # Words that lead in the texts of a few ids only: a sample of texts by id would miss most of them.
    rows = [(n, f"common w{n % 20} w{n % 20} own{n}") for n in range(400)] + [(n, f"late{n % 5} " * 90) for n in (1, 88, 203, 305, 399)]
    docs = spark.createDataFrame([(i, t, i % 7 != 2) for i, t in rows], "doc_id bigint, text string, train boolean").repartition(5)
    monkeypatch.setattr(hm, "FREQUENT", 12)
    monkeypatch.setattr(hm, "SAMPLE_TEXTS", 40, raising=False)
    monkeypatch.setattr(hm, "BLOCK_BYTES", 500)
    counts = Counter(w for i, t in rows if i % 7 != 2 for w in t.encode().split())
    wanted = sorted(counts, key=lambda w: (-counts[w], w))[:12]
    assert hm.frequent_words(docs).words == {w: i + 1 for i, w in enumerate(wanted)}


def test_one_state_is_nearly_the_unigram_model(docs):
    rows = hm.score_texts(docs, fold("doc_id", 7) != 2, states=1, rounds=1).collect()
    # Every class of several words keeps room for unknown ones of its own, which weighs for rare words only.
    known = [r for r in rows if r["n_known"] == r["n_tokens"]]
    score, base = (sum(r[c] for r in known) for c in ("score", "base_score"))
    assert known and abs(score - base) <= 0.05 * abs(base)


def test_every_round_raises_the_likelihood(spark):
    rng = np.random.default_rng(3)
    seqs = [rng.integers(0, 5, rng.integers(1, 40)).astype(np.uint16) for _ in range(200)]
    table = spark.createDataFrame([(s.tobytes(),) for s in seqs], "seq binary").repartition(3)
    model = small_model()
    before = -np.inf
    for _ in range(4):
        model, now = hm.train_round(table, model)
        assert now >= before - 1.0
        before = now
    assert np.allclose(model.emit.sum(0), 1) and np.allclose(model.move.sum(1), 1)


def test_held_out_texts_gain(spark, given):
    from cohortline.llm.registered import op1_hidden_markov

    held = op1_hidden_markov(spark, given).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert held[0] > held[1]


def test_nothing_to_score_or_learn(docs, no_docs):
    assert hm.score_texts(no_docs, F.lit(True), rounds=1).collect() == []
    rows = hm.score_texts(docs, F.lit(False), rounds=1).collect()
    assert len(rows) == docs.count()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and abs(r["base_score"]) < 1e-9 for r in rows)
