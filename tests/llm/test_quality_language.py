from __future__ import annotations

import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from cohortline.llm.language import UNKNOWN, codes_of, fit, kernel, learn_languages, predict_languages
from cohortline.llm.quality import RULES, fit_votes, keep_good, pattern_table, quality, votes, with_counts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_counts_equal_brute_force(docs):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    for r in quality(docs.select("doc_id", "text")).join(docs.select("doc_id", "text").distinct(), "doc_id").collect():
        wanted = plain_counts(r["text"])
        assert tuple(r[n] for n in names) == wanted
        failed = wanted[0] < 20 or 100 * wanted[4] > 30 * wanted[0]
        assert r["base_failed"] == failed and not (failed and r["kept"])


def test_keep_good_keeps_the_rows_that_quality_keeps(docs, no_docs):
    kept = quality(docs).where("kept").count()
    rows = keep_good(docs)
    assert rows.columns == docs.columns and rows.count() == kept
    assert keep_good(no_docs).collect() == [] and quality(no_docs).collect() == []


def test_em_finds_the_better_votes():
    """Rules of known accuracy over made-up documents: the posterior finds the quality."""
    rng = np.random.default_rng(0)
    good = rng.random(20_000) < 0.85
    n = len(RULES)
    vote = np.full((len(good), n), 2)
    for r in range(n):
        fires = np.where(good, rng.random(len(good)) < 0.02, rng.random(len(good)) < 0.5)
        vote[:, r] = np.where(fires, 0, np.where(rng.random(len(good)) < 0.2, 1, 2))
    codes = (vote * 3 ** np.arange(n)[::-1]).sum(1)
    fitted = fit_votes(Counter(codes.tolist()))
    verdict = np.array([fitted[c] >= 0.5 for c in codes.tolist()])
    assert (verdict == good).mean() > 0.97


def test_patterns_cover_all_documents(docs):
    assert sum(pattern_table(votes(with_counts(docs.select("text")))).values()) == docs.count()


def test_labelled_quality(spark, given):
    """Unsupervised, and still right: labels are only compared."""
    labels = spark.read.parquet(f"{given}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    judged = quality(spark.read.parquet(f"{given}/documents.parquet")).where("NOT base_failed").join(labels, "doc_id")
    rows = judged.select("label", "kept").collect()
    good = [r["kept"] for r in rows if r["label"] == 1]
    assert sum(good) >= 0.95 * len(good)


def test_kernel_is_the_blended_spectrum():
    texts = [("en", "abcab"), ("de", "bcx")]
    model = fit(texts, texts)

    def grams(t):
        return {t[i : i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}

    for text in ("abc", "xxbcq", "q"):
        got = kernel([text], model)[0]
        for j, (_, mark) in enumerate(texts):
            wanted = len(grams(text) & grams(mark)) / np.sqrt(len(grams(text)) * len(grams(mark)))
            # Characters outside the alphabet count as one.
            assert abs(got[j] - wanted) < 1e-6
    assert len(codes_of("", model.letters)) == 0


def test_languages_are_told_apart(docs, no_docs):
    model = learn_languages(docs, F.lit(True), n_landmarks=5)
    rows = predict_languages(docs, model).collect()
    assert len(rows) == docs.count()
    for r in rows:
        if not any(c.isalpha() for c in r["text"] or ""):
            assert (r["lang_pred"], r["lang_score"]) == (UNKNOWN, 0)
        else:
            assert 0 <= r["lang_score"] <= 1 and r["lang_pred"] in ("de", "en")
        if r["doc_id"] is not None and 1 < r["doc_id"] < 40:
            assert r["lang_pred"] == r["lang"]
    assert predict_languages(no_docs, model).collect() == []
    nothing = learn_languages(no_docs, F.lit(True))
    assert {r["lang_pred"] for r in predict_languages(docs, nothing).collect()} == {UNKNOWN}


def test_held_out_accuracy(spark, given):
    from cohortline.llm.registered import op3_language

    docs = spark.read.parquet(f"{given}/documents.parquet").select("doc_id", "lang")
    rows = op3_language(spark, given).where("held_out").join(docs, "doc_id").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.95 * len(rows)
