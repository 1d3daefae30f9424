"""Quality rules as weak supervision (operator 8).

Every rule votes for a document, against it, or abstains. The number of documents with each pattern of
votes is counted over the whole input; with nine rules there are at most 3**9 patterns, whatever
the input's size, so expectation-maximisation over that table sees every document and costs nothing.
The model has a latent quality and, given it, independent rules with their own rates of each vote. The
posterior of a document's own pattern replaces the usual demand that all rules must pass.

Null and empty texts have no words and zero counts; they fail the base rule. Very long texts are
read whole, one at a time. Repeated rows are judged alike. An empty table gives no rows. Columns
other than the named ones are not read. Same counts give the same pattern, so ties cannot differ.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.storage import settle
from .common import BLANKS, blocks_of, bound_batches, id_and_text, raw, text_sizes

#: All ASCII bytes but letters.
NO_LETTERS = bytes(range(65)) + bytes(range(91, 97)) + bytes(range(123, 128))
#: Those but blanks: what is left of a text without them has the words that hold a letter.
NO_LETTERS_NO_BLANKS = bytes(x for x in NO_LETTERS if x not in BLANKS)
#: Counted as symbols.
SYMBOLS = b"#*$%&|<>"
WINDOW = 8
BLOCK_BYTES = 4 << 20

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_upper", "n_letters", "n_bare")

#: Rule name, measure, and the limits of the votes: against outside the outer pair, for inside the
#: inner pair, no vote between.
RULES = (
    ("length", "n_words", (30, float("inf")), (60, float("inf"))),
    ("word_length", "word_chars / n_words", (2.5, 14), (3.5, 10)),
    ("symbols", "n_symbols / n_words", (0, 0.1), (0, 0.02)),
    ("dup_lines", "n_dup_lines / n_lines", (0, 0.3), (0, 0.1)),
    ("repeats", "n_repeat_words / n_words", (0, 0.3), (0, 0.1)),
    ("distinct", "n_distinct / n_words", (0.15, 1), (0.25, 1)),
    ("upper_case", "n_upper / n_letters", (0, 0.3), (0, 0.1)),
    ("letters", "n_letters / word_chars", (0.9, 1), (0.94, 1)),
    ("bare_words", "n_bare / n_words", (0, 0.15), (0, 0.05)),
)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window found twice or more in the text, the first one included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    seen = [line[a:b] for a, b in zip(starts[:n].tolist(), ends[window - 1 :].tolist())]
    if len(set(seen)) == n:
        return 0
    first: dict[bytes, int] = {}
    covered = np.zeros(len(words) + 1, np.int64)
    for i, piece in enumerate(seen):
        j = first.setdefault(piece, i)
        if j != i:
            for k in (i, j):
                covered[k] += 1
                covered[k + window if k + window <= len(words) else len(words)] -= 1
    return int((np.cumsum(covered[:-1]) > 0).sum())


def counts_of(data: bytes) -> tuple[int, ...]:
    """The counts named in COUNTS for one text."""
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    letters = data.translate(None, NO_LETTERS)
    wide = np.frombuffer(letters, np.uint8)
    points = np.frombuffer(data, np.uint8)
    return (
        len(words),
        int(((points & 0xC0) != 0x80).sum()) - (len(data) - len(data.translate(None, BLANKS))),
        len(data) - len(data.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        len(set(words)),
        int((wide < 91).sum()),
        int(((wide & 0xC0) != 0x80).sum()),
        len(words) - len(data.translate(None, NO_LETTERS_NO_BLANKS).split()),
    )


def with_counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows with their counts; one pass, no shuffle."""
    bound_batches(df.sparkSession)
    names_in = df.columns

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks_of(batches, lambda b: text_sizes(b, "_text"), BLOCK_BYTES):
            found = np.array([counts_of(x) for x in raw(block, "_text")], np.int64).reshape(-1, len(COUNTS))
            yield pa.RecordBatch.from_arrays(
                [*[block.column(c) for c in names_in], *map(pa.array, found.T)], names=[*names_in, *COUNTS]
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    given = df.withColumn("_text", F.coalesce(F.col(text_col), F.lit("")))
    return given.mapInArrow(count, f"{fields}, " + ", ".join(f"{c} bigint" for c in COUNTS))


def quality_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with its counts."""
    docs = id_and_text(df, id_col, text_col)
    return with_counts(docs).drop("text")


def votes(counts: DataFrame) -> DataFrame:
    """The counts with ``pattern``: one digit a rule, 0 against, 1 abstains, 2 for.

    A rule whose measure has a zero denominator abstains.
    """
    pattern = F.lit(0)
    for _, measure, (low, high), (inner_low, inner_high) in RULES:
        top, _, bottom = measure.partition(" / ")
        value = F.col(top) / F.nullif(F.col(bottom), F.lit(0)) if bottom else F.col(top).cast("double")
        vote = (
            F.when((value < low) | (value > high), 0)
            .when((value >= inner_low) & (value <= inner_high), 2)
            .otherwise(1)
        )
        pattern = pattern * 3 + vote
    return counts.withColumn("pattern", pattern.cast("int"))


def fit_votes(table: dict[int, int], n_rules: int = len(RULES), rounds: int = 100) -> dict[int, float]:
    """Posterior probability of good quality for each pattern, by expectation-maximisation.

    ``table`` has the number of documents per pattern. Starts from rules that are right more often than
    not; a vote against is taken as the rarer and stronger sign, since a rule watches for one kind of fault.
    The rates are smoothed by one document each way and the prior by ten.
    """
    if not table:
        return {}
    codes = np.array(sorted(table), np.int64)
    weight = np.array([table[c] for c in codes.tolist()], float)
    digits = np.stack([codes // 3 ** (n_rules - 1 - r) % 3 for r in range(n_rules)], 1)
    one_hot = np.eye(3)[digits]  # patterns x rules x votes
    # Rates of (against, abstain, for) given bad and good quality.
    rates = np.stack([np.tile([0.4, 0.2, 0.4], (n_rules, 1)), np.tile([0.02, 0.18, 0.8], (n_rules, 1))])
    prior = 0.9
    prior_rates = rates.copy()
    good = np.full(len(codes), prior)
    for _ in range(rounds):
        log_like = np.einsum("prv,qrv->pq", one_hot, np.log(rates))
        odds = log_like[:, 1] - log_like[:, 0] + np.log(prior / (1 - prior))
        good = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        share = np.stack([weight * (1 - good), weight * good])
        votes_seen = np.einsum("qp,prv->qrv", share, one_hot) + prior_rates
        rates = votes_seen / votes_seen.sum(2, keepdims=True)
        prior = (share[1].sum() + 9) / (weight.sum() + 10)
    return dict(zip(codes.tolist(), good.tolist()))


def pattern_table(voted: DataFrame) -> dict[int, int]:
    """Documents per pattern of votes: at most 3**rules rows come to the driver."""
    return {r["pattern"]: r["n"] for r in voted.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).collect()}


def judged(voted: DataFrame, fitted: dict[int, float], threshold: float = 0.5) -> DataFrame:
    """The rows with base_failed, the posterior ``quality`` of their pattern, and ``kept``."""
    rows = [(k, float(v)) for k, v in fitted.items()]
    # At most 3**rules rows.
    posterior = F.broadcast(voted.sparkSession.createDataFrame(rows, "pattern int, quality double"))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return (
        voted.join(posterior, "pattern", "left")
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (F.col("quality") >= threshold))
    )


def quality(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """One row per document: its counts, base_failed, the posterior ``quality`` and ``kept``."""
    voted = settle(votes(quality_counts(df, id_col, text_col)))
    return judged(voted, fit_votes(pattern_table(voted)), threshold)


def keep_good(df: DataFrame, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``df`` that are kept. The texts are counted twice, so that they are neither shuffled nor written."""
    fitted = fit_votes(pattern_table(votes(with_counts(df.select(text_col), text_col))))
    names = {c: f"_{i}" for i, c in enumerate(df.columns)}
    own = df.select(*[F.col(c).alias(n) for c, n in names.items()])
    verdict = judged(votes(with_counts(own, names[text_col])), fitted, threshold)
    return verdict.where("kept").select(*[F.col(n).alias(c) for c, n in names.items()])
