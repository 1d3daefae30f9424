"""A hidden Markov language model of words (operator 1).

Tokens are the words of a text (ASCII letters lower case) and one end. A state emits a class of tokens, the class its token:
P(token | state) = B[state, class] * P(token | class). The end and the ``FREQUENT`` most frequent words of all training texts are
classes of their own; all other words share classes by their last letters. Within a class a token has probability
(c + 1) / (N_class + V_class + 1) from exact counts over all training texts, the rest being left to unknown words. So the parameters
that Baum-Welch trains are bounded, whatever the vocabulary, and with one state the model is the add-one unigram model.

* One pass counts the words of all training texts, per block and then by one shuffle, for the frequent ones.
* One pass writes each text's class sequence and, per block of texts, an index of its rarer words with where they occur.
* The index alone is shuffled by word for exact counts, then back by block for sums per text. The frequent words are not in it,
  so no word has more rows than there are blocks.
* Every Baum-Welch round runs over all training sequences; expected counts are summed per task, then per class by Spark.
  Only the first round's starting point comes from a bounded sample.
* The scaled forward recursion gives the exact likelihood of every whole sequence.

Null and empty texts are one end. Texts of any length are one sequence. Rows with a null id are scored but not learned from. Repeated
rows count and score each for itself. Ties among frequent words go by the word. Without training texts all tokens are unknown and the score is that of the prior.
An empty table gives no rows. Columns other than the named ones are not read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.storage import scratch_path, settle
from .common import blocks_of, id_and_text, raw, text_sizes

STATES = 6
ROUNDS = 3
FREQUENT = 4096
ENDINGS = 512
#: Longest word with a class of its own, in bytes.
LONGEST = 48
#: Groups whose leading words are merged for the frequent ones.
TOP_GROUPS = 16
#: Texts of the sample that starts Baum-Welch, about.
START_TEXTS = 1_500
START_TOKENS = 600_000
#: Documents that weigh as much as the prior in the emission counts, in tokens.
PRIOR_TOKENS = 50.0
BLOCK_BYTES = 12 << 20
#: Tokens handled at once by the recursions; a longer text comes alone.
BATCH_TOKENS = 2_000_000
SEED = 7


def key_of(word: bytes) -> bytes:
    """The word itself, or a 16-byte digest of a longer one: at most 16 bytes, and the two kinds never meet."""
    if len(word) < 16:
        return word
    from xxhash import xxh3_128_digest

    return xxh3_128_digest(word)


@dataclass
class Classes:
    """Class 0 is the end, 1.. the frequent words, then the endings."""

    words: dict[bytes, int]

    @property
    def size(self) -> int:
        return 1 + len(self.words) + ENDINGS

    @property
    def own(self) -> int:
        """Classes of one token."""
        return 1 + len(self.words)

    def of(self, word: bytes) -> int:
        known = self.words.get(word)
        return self.own + zlib.crc32(word[-3:]) % ENDINGS if known is None else known


def in_sample(most: int, rows: int) -> Column:
    """About ``most`` of the rows, by a hash of their id."""
    part = min(1.0, most / max(1, rows))
    return F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 30)) < int(part * (1 << 30))


def frequent_words(docs: DataFrame) -> Classes:
    """The FREQUENT most frequent words by their exact counts over all training texts, ties by the word."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks_of(batches, text_sizes, BLOCK_BYTES):
            found: Counter[bytes] = Counter()
            for text in raw(block):
                found.update(text.lower().split())
            kept = [w for w in found if len(w) <= LONGEST]
            for low in range(0, len(kept), 50_000):
                part = kept[low : low + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part, pa.binary()), pa.array([found[w] for w in part], pa.int64())], names=["word", "n"]
                )

    sums = docs.where("train").select("text").mapInArrow(counted, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    # The first of each partition meet in TOP_GROUPS groups, so that what the driver merges does not grow with the partitions.
    lead = Window.partitionBy("part").orderBy(F.desc("n"), "word")
    parts = sums.withColumn("part", F.spark_partition_id() % TOP_GROUPS)
    few = parts.withColumn("place", F.row_number().over(lead)).where(F.col("place") <= FREQUENT)
    top = few.orderBy(F.desc("n"), "word").limit(FREQUENT).select("word").collect()
    return Classes({bytes(r["word"]): i + 1 for i, r in enumerate(top)})


INDEX = "kind int, block bigint, doc int, doc_id {kind}, train boolean, seq binary, key binary, cls int, n_train bigint, postings binary"


def index_texts(docs: DataFrame, classes: Classes, path: str) -> DataFrame:
    """Write, per block of texts: sequences (kind 0), rarer words (1: key, class, training count, and where they occur), training
    counts per class (2)."""
    shared = docs.sparkSession.sparkContext.broadcast(classes)
    kind = docs.schema["doc_id"].dataType.simpleString()
    kinds = ("kind", "block", "doc", "doc_id", "train", "seq", "key", "cls", "n_train", "postings")

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        block_ids = count(TaskContext.get().partitionId() << 32)
        for block in blocks_of(batches, text_sizes, BLOCK_BYTES):
            types = [pa.int32(), pa.int64(), pa.int32(), block.schema.field("doc_id").type, pa.bool_(), pa.binary(), pa.binary(), pa.int32(), pa.int64(), pa.binary()]
            number = next(block_ids)

            def batch(rows: int, what: int, **columns) -> pa.RecordBatch:
                given = {"kind": pa.array(np.full(rows, what, np.int32)), "block": pa.array(np.full(rows, number)), **columns}
                return pa.RecordBatch.from_arrays(
                    [given.get(c, pa.nulls(rows, t)) for c, t in zip(kinds, types)], names=list(kinds)
                )

            local: dict[bytes, int] = defaultdict(count().__next__)
            ids = [np.fromiter(map(local.__getitem__, text.lower().split()), np.int64) for text in raw(block)]
            train = np.array(block.column("train").to_pylist(), bool)
            cls = np.fromiter(map(known.of, local), np.uint16, len(local))
            end = np.zeros(1, np.uint16)
            seqs = [np.concatenate((cls[x], end)) for x in ids]
            yield batch(
                len(ids), 0, doc=pa.array(np.arange(len(ids), dtype=np.int32)), doc_id=block.column("doc_id"),
                train=block.column("train"), seq=pa.array([s.tobytes() for s in seqs], pa.binary()),
            )
            learned = [s for s, t in zip(seqs, train) if t]
            if learned:
                n = np.bincount(np.concatenate(learned), minlength=known.size)
                some = np.flatnonzero(n)
                yield batch(len(some), 2, cls=pa.array(some.astype(np.int32)), n_train=pa.array(n[some]))
            if not local:
                continue
            # Where each rarer word occurs: (word, text) pairs with their number.
            words = np.concatenate(ids)
            texts = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
            rare = cls[words] >= known.own
            pairs, times = np.unique(words[rare] * len(ids) + texts[rare], return_counts=True)
            if not len(pairs):
                continue
            word, text = pairs // len(ids), pairs % len(ids)
            starts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            postings = (text.astype(np.uint64) << np.uint64(40)) | times.astype(np.uint64)
            offsets = np.concatenate((starts, [len(pairs)])) * 8
            n_train = np.add.reduceat(times * train[text], starts)
            names = list(local)
            own = word[starts]
            for low in range(0, len(own), 50_000):
                high = min(low + 50_000, len(own))
                data = postings.tobytes()[offsets[low] : offsets[high]]
                at = pa.py_buffer((offsets[low : high + 1] - offsets[low]).astype(np.int32).tobytes())
                yield batch(
                    high - low, 1, key=pa.array([key_of(names[w]) for w in own[low:high].tolist()], pa.binary()),
                    cls=pa.array(cls[own[low:high]].astype(np.int32)), n_train=pa.array(n_train[low:high]),
                    postings=pa.Array.from_buffers(pa.binary(), high - low, [None, at, pa.py_buffer(data)]),
                )

    docs.mapInArrow(indexed, INDEX.format(kind=kind)).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.parquet(path)


@dataclass
class Model:
    """Start, transition and emission probabilities of the states, and the counts of the classes."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # classes x states
    own: int
    n: np.ndarray  # training tokens per class
    v: np.ndarray  # different training words per class

    @property
    def tokens(self) -> int:
        return int(self.n.sum())

    @property
    def words(self) -> int:
        return int(self.v.sum())


def class_prior(n: np.ndarray, v: np.ndarray, own: int) -> np.ndarray:
    """The add-one unigram model of the classes: a class of several words also has room for unknown ones."""
    weight = n + np.where(np.arange(len(n)) < own, 1.0, v + 1.0)
    return weight / weight.sum()


def arranged(seqs: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Batches for the recursions: numbers of the sequences, longest first; tokens by time, then sequence; where each
    time starts; and each token's sequence."""
    order = np.argsort([-len(s) for s in seqs], kind="stable")
    low = 0
    while low < len(order):
        high, total = low, 0
        while high < len(order) and (high == low or total + len(seqs[order[high]]) <= BATCH_TOKENS):
            total += len(seqs[order[high]])
            high += 1
        mine = order[low:high]
        lengths = np.array([len(seqs[i]) for i in mine])
        active = np.cumsum(np.bincount(lengths)[::-1])[::-1][1:]  # sequences longer than each time
        starts = np.concatenate(([0], np.cumsum(active)))
        first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        time = np.arange(total) - np.repeat(first, lengths)
        number = np.repeat(np.arange(len(mine)), lengths)
        at = starts[time] + number
        tokens, whose = np.empty(total, np.uint16), np.empty(total, np.int64)
        tokens[at] = np.concatenate([seqs[i] for i in mine])
        whose[at] = number
        yield mine, tokens, starts, whose
        low = high


def forward(model: Model, tokens: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scaled forward probabilities and the scales, whose logarithms sum to the log-likelihood."""
    alpha = model.emit[tokens]
    scale = np.empty(len(tokens))
    for t in range(len(starts) - 1):
        a, b = starts[t], starts[t + 1]
        here = alpha[a:b]
        if t == 0:
            here *= model.start
        else:
            before = starts[t - 1]
            here *= alpha[before : before + b - a] @ model.move
        total = here.sum(1)
        here /= total[:, None]
        scale[a:b] = total
    return alpha, scale


def likelihoods(model: Model, seqs: list[np.ndarray]) -> np.ndarray:
    """Natural logarithm of the likelihood of each class sequence."""
    out = np.zeros(len(seqs))
    for mine, tokens, starts, whose in arranged(seqs):
        _, scale = forward(model, tokens, starts)
        out[mine] = np.bincount(whose, np.log(scale), len(mine))
    return out


def expected(model: Model, seqs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected starts, moves and emissions (classes x states) of sequences, and their log-likelihood."""
    k = len(model.start)
    begin, moves, emissions, total = np.zeros(k), np.zeros((k, k)), np.zeros(model.emit.shape), 0.0
    for mine, tokens, starts, _ in arranged(seqs):
        alpha, scale = forward(model, tokens, starts)
        total += float(np.log(scale).sum())
        beta = np.ones((len(mine), k))
        back = model.move.T.copy()
        for t in range(len(starts) - 2, -1, -1):
            a, b = starts[t], starts[t + 1]
            if t + 2 < len(starts):
                c = starts[t + 2]
                ahead = model.emit[tokens[b:c]]
                ahead *= beta[: c - b]
                ahead /= scale[b:c, None]
                moves += alpha[a : a + c - b].T @ ahead
                beta[: c - b] = ahead @ back
            alpha[a:b] *= beta[: b - a]
        begin += alpha[: starts[1]].sum(0)
        for z in range(k):
            emissions[:, z] += np.bincount(tokens, alpha[:, z], len(emissions))
    return begin, moves * model.move, emissions, total


def maximised(model: Model, begin: np.ndarray, moves: np.ndarray, emissions: np.ndarray) -> Model:
    """The model that expected counts give, the class prior weighing PRIOR_TOKENS tokens a state."""
    prior = class_prior(model.n, model.v, model.own)[:, None]
    emit = emissions + PRIOR_TOKENS * prior
    move, start = moves + 1 / len(begin), begin + 1 / len(begin)
    return Model(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0), model.own, model.n, model.v)


def starting_model(seqs: list[np.ndarray], n: np.ndarray, v: np.ndarray, own: int, states: int) -> Model:
    """A mixture of unigram models over the sample's texts, each part a state that likes to stay, then some rounds of
    Baum-Welch over the sample."""
    rng = np.random.default_rng(SEED)
    prior = class_prior(n, v, own)
    uniform = np.full(states, 1 / states)
    stay = np.full((states, states), 0.05 / states) + 0.95 * np.eye(states)
    model = Model(uniform, stay / stay.sum(1, keepdims=True), np.tile(prior[:, None], (1, states)), own, n, v)
    if not seqs or states == 1:
        return model
    tokens = np.concatenate(seqs)
    whose = np.repeat(np.arange(len(seqs)), [len(s) for s in seqs])
    belongs = rng.dirichlet(np.full(states, 0.3), len(seqs))
    for _ in range(25):
        emit = np.stack([np.bincount(tokens, belongs[whose, z], len(prior)) for z in range(states)], 1)
        emit = emit + PRIOR_TOKENS * prior[:, None]
        emit /= emit.sum(0)
        logs = np.log(emit)
        fit = np.stack([np.bincount(whose, logs[tokens, z], len(seqs)) for z in range(states)], 1)
        fit += np.log(belongs.mean(0) + 1e-6)
        fit -= fit.max(1, keepdims=True)
        belongs = np.exp(fit)
        belongs /= belongs.sum(1, keepdims=True)
    model.emit = emit
    for _ in range(4):
        model = maximised(model, *expected(model, seqs)[:3])
    return model


def sequences_of(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint16) for x in batch.column("seq").to_pylist()]


def sequence_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Slices of the batches with about as many tokens as the recursions take at once."""
    for block in blocks_of(batches, lambda b: text_sizes(b, "seq"), 2 * BATCH_TOKENS):
        yield block, sequences_of(block)


def train_round(sequences: DataFrame, model: Model) -> tuple[Model, float]:
    """One round of Baum-Welch over all training sequences; returns the new model and the old one's log-likelihood."""
    shared = sequences.sparkSession.sparkContext.broadcast(model)
    k = len(model.start)

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        sums = None
        for _, seqs in sequence_batches(batches):
            found = expected(fitted, seqs)
            sums = found if sums is None else tuple(a + b for a, b in zip(sums, found))
        if sums is None:
            return
        begin, moves, emissions, total = sums
        # Classes first, then the moves from each state, the starts, and the likelihood.
        rows = np.vstack([emissions, moves, begin[None], np.full((1, k), total)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(rows), dtype=np.int32)), *[pa.array(np.ascontiguousarray(rows[:, z])) for z in range(k)]],
            names=["row", *[f"z{z}" for z in range(k)]],
        )

    schema = "row int, " + ", ".join(f"z{z} double" for z in range(k))
    summed = sequences.select("seq").mapInArrow(counts, schema).groupBy("row")
    # One row per class and state comes to the driver.
    found = summed.agg(*[F.sum(f"z{z}").alias(f"z{z}") for z in range(k)]).collect()
    size = len(model.emit)
    rows = np.zeros((size + k + 2, k))
    for r in found:
        rows[r["row"]] = r[1:]
    return maximised(model, rows[size + k], rows[size : size + k], rows[:size]), float(rows[size + k + 1, 0])


def rare_sums(index: DataFrame) -> DataFrame:
    """Per text (block, doc): the sum of log10(c + 1) and the number of known tokens over its rarer words."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            postings = batch.column("postings")
            offsets = np.frombuffer(postings.buffers()[1], np.int32)[postings.offset : postings.offset + len(postings) + 1]
            data = np.frombuffer(postings.buffers()[2], np.uint64, (offsets[-1] - offsets[0]) // 8, offsets[0])
            lengths = np.diff(offsets) // 8
            c = np.repeat(batch.column("c").to_numpy(), lengths)
            blocks = np.repeat(batch.column("block").to_numpy(), lengths)
            texts, times = (data >> np.uint64(40)).astype(np.int64), (data & np.uint64((1 << 40) - 1)).astype(np.int64)
            for block in np.unique(blocks).tolist():
                mine = blocks == block
                own = sums.setdefault(block, [np.zeros(0), np.zeros(0)])
                for i, weight in enumerate((times[mine] * np.log10(c[mine] + 1.0), times[mine] * (c[mine] > 0))):
                    new = np.bincount(texts[mine], weight)
                    size = max(len(new), len(own[i]))
                    own[i] = np.pad(own[i], (0, size - len(own[i]))) + np.pad(new, (0, size - len(new)))
        for block, (logs, known) in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(logs), block)), pa.array(np.arange(len(logs), dtype=np.int32)), pa.array(logs),
                 pa.array(known.astype(np.int64))],
                names=["block", "doc", "rare_log", "rare_known"],
            )

    dealt = index.select("block", "c", "postings").repartition("block")
    return dealt.mapInArrow(summed, "block bigint, doc int, rare_log double, rare_known bigint")


def scored(sequences: DataFrame, model: Model) -> DataFrame:
    """Per text: tokens, sums over the tokens of classes of one token, and log10 of the classes' part of the likelihood."""
    shared = sequences.sparkSession.sparkContext.broadcast(model)
    kind = sequences.schema["doc_id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        single = np.arange(len(fitted.n)) < fitted.own
        own_log = np.where(single, np.log10(fitted.n + 1.0), 0.0)
        own_known = (single & (fitted.n > 0)).astype(float)
        spread = np.where(single, 0.0, np.log10(fitted.n + fitted.v + 1.0))
        for batch, seqs in sequence_batches(batches):
            log_likes = likelihoods(fitted, seqs) / math.log(10)
            lengths = np.array([len(s) for s in seqs], np.int64)
            tokens, whose = np.concatenate(seqs), np.repeat(np.arange(len(seqs)), lengths)
            logs, known, spreads = (np.bincount(whose, w[tokens], len(seqs)) for w in (own_log, own_known, spread))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("block", "doc", "doc_id")], pa.array(lengths), pa.array(logs),
                 pa.array(known.astype(np.int64)), pa.array(log_likes - spreads)],
                names=["block", "doc", "doc_id", "n_tokens", "own_log", "own_known", "class_score"],
            )

    return sequences.select("block", "doc", "doc_id", "seq").mapInArrow(
        score,
        f"block bigint, doc int, doc_id {kind}, n_tokens bigint, own_log double, own_known bigint, class_score double",
    )


def score_texts(
    df: DataFrame,
    learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    states: int = STATES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every row; ``learn`` marks the rows learned from."""
    spark: SparkSession = df.sparkSession
    docs = id_and_text(df, id_col, text_col, F.coalesce(learn, F.lit(False)).alias("train"))
    rows = df.agg(F.count(F.lit(1))).first()[0]
    classes = frequent_words(docs)
    written = index_texts(docs, classes, scratch_path(spark, "words-"))
    sequences = written.where("kind = 0").select("block", "doc", "doc_id", "train", "seq")

    by_word = Window.partitionBy("key")
    counted = settle(
        written.where("kind = 1").select(
            "block", "cls", "postings", F.sum("n_train").over(by_word).alias("c"),
            (F.row_number().over(by_word.orderBy("block")) == 1).alias("first"),
        )
    )
    n, v = np.zeros(classes.size), np.zeros(classes.size)
    for r in written.where("kind = 2").groupBy("cls").agg(F.sum("n_train").alias("n")).collect():
        n[r["cls"]] = r["n"]
    for r in counted.where("first AND c > 0").groupBy("cls").agg(F.count(F.lit(1)).alias("v")).collect():
        v[r["cls"]] = r["v"]
    v[: classes.own] = n[: classes.own] > 0

    learned = sequences.where("train")
    short = learned.where(in_sample(START_TEXTS, rows)).where(F.octet_length("seq") <= START_TOKENS // 10)
    sample, total = [], 0
    for r in sorted(short.select("doc_id", "seq").collect(), key=lambda r: (r["doc_id"], r["seq"])):
        seq = np.frombuffer(r["seq"], np.uint16)
        total += len(seq)
        if total <= START_TOKENS:
            sample.append(seq)
    model = starting_model(sample, n, v, classes.own, states)
    for _ in range(rounds):
        model, _ = train_round(learned, model)

    tokens, words = model.tokens, model.words
    rare = rare_sums(counted)
    joined = scored(sequences, model).join(rare, ["block", "doc"], "left")
    rare_log = F.coalesce("rare_log", F.lit(0.0))
    return joined.select(
        "doc_id",
        "n_tokens",
        (F.col("own_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("bigint").alias("train_tokens"),
        (F.col("own_log") + rare_log - F.col("n_tokens") * math.log10(tokens + words + 1)).alias("base_score"),
        (F.col("class_score") + rare_log).alias("score"),
    )
