"""Language identification by string kernels (operator 3).

The kernel of two texts is the number of different character n-grams (lengths 1 to 3, lower case) that both contain,
divided by the root of the product of their own numbers. Nyström landmarks are a few labelled texts per language; every text is
described by its kernel values with them, multiplied by the inverse root of the landmarks' own kernel matrix.
One ridge regression per language, one against the rest, is solved on a bounded sample: at most ``LANDMARKS`` landmarks and
``SAMPLE`` texts per language, among those with the smallest id hashes. Scoring is two matrix products a batch: presence matrix times the
landmarks' presence, then times the regressions.

The regression values of a text sum to about 1, also for a text of no known language, so they cannot reject one. Likeness can: the
share of a text's own n-grams that the landmarks of its language have. With ``reject``, texts below ``LIKE_SHARE`` of
the labelled texts' median are ``und``.

Every text is read whole. A null text, an empty one and one without a letter are ``und`` with score 0, and so is all
if nothing is learned from. Ties go to the language first in code point order. Repeated rows get equal results. An empty table gives no rows.
Columns other than the named ones are not read, and in prediction none but the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import blocks_of, bound_batches, text_sizes

#: Per language: landmarks, and texts that the regressions are fitted to.
LANDMARKS = 24
SAMPLE = 300
#: Longest n-gram, and the characters told apart; all others count as one more.
ORDER = 3
ALPHABET = 127
RIDGE = 1e-3
UNKNOWN = "und"
#: A text is of its language if its likeness is at least this share of the labelled texts' median.
LIKE_SHARE = 0.4
BLOCK_BYTES = 2 << 20
#: Texts in one presence matrix.
BATCH = 64


@dataclass
class Model:
    """Alphabet, the column of each n-gram code (0: in no landmark), landmarks' presence, their norms, and weights.

    For likeness: whether a code has ORDER characters and one is a letter, and which of these each language's landmarks have.
    """

    letters: np.ndarray
    column: np.ndarray
    presence: np.ndarray
    weights: np.ndarray
    languages: list[str]
    lettered: np.ndarray
    known: np.ndarray
    limits: np.ndarray


def codes_of(text: str, letters: np.ndarray) -> np.ndarray:
    """Codes of all n-grams, repeats included: a number of up to ORDER digits to the base ALPHABET + 2."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    x = letters[points].astype(np.int32)
    out, code = [x], x
    for n in range(1, ORDER):
        if len(x) <= n:
            break
        code = code[:-1] * (ALPHABET + 2) + x[n:]
        out.append(code)
    return np.concatenate(out)


def presence_of(texts: list[str], model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which of the landmarks' n-grams each text has (rows of 0 and 1), and the numbers of all its different n-grams and of
    those that are ``lettered``."""
    width = model.presence.shape[0]
    found = np.zeros((len(texts), width + 1), np.float32)
    sizes, totals = np.zeros(len(texts)), np.zeros(len(texts))
    seen = np.zeros(len(model.column), bool)
    for i, text in enumerate(texts):
        codes = codes_of(text, model.letters)
        seen[codes] = True
        own = np.flatnonzero(seen) if len(codes) * 20 > len(seen) else np.unique(codes)
        seen[own] = False
        sizes[i] = len(own)
        totals[i] = np.count_nonzero(model.lettered[own])
        found[i, model.column[own]] = 1
    return found[:, 1:], sizes, totals


def kernel(texts: list[str], model: Model) -> np.ndarray:
    """Kernel values of texts (rows) with the landmarks."""
    return kernel_of(*presence_of(texts, model)[:2], model)


def kernel_of(found: np.ndarray, sizes: np.ndarray, model: Model) -> np.ndarray:
    return found @ model.presence / np.sqrt(np.maximum(1, sizes))[:, None]


def fit(landmarks: list[tuple[str, str]], sample: list[tuple[str, str]], ridge: float = RIDGE) -> Model | None:
    """Fit on (language, text) pairs."""
    languages = sorted({lang for lang, _ in sample}, key=lambda x: x.encode("utf-8", "surrogatepass"))
    if not languages or not landmarks:
        return None
    points: dict[int, int] = {}
    for _, text in landmarks:
        values, counts = np.unique(np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32), return_counts=True)
        for v, n in zip(values.tolist(), counts.tolist()):
            points[v] = points.get(v, 0) + n
    letters = np.ones(0x110000, np.uint8)
    for rank, point in enumerate(sorted(points, key=lambda p: (-points[p], p))[:ALPHABET]):
        letters[point] = rank + 2
    sets = [np.unique(codes_of(text, letters)) for _, text in landmarks]
    used = np.unique(np.concatenate(sets))
    column = np.zeros((ALPHABET + 2) ** ORDER, np.int32)
    column[used] = np.arange(1, len(used) + 1)
    presence = np.zeros((len(used), len(landmarks)), np.float32)
    for j, own in enumerate(sets):
        presence[column[own] - 1, j] = 1 / np.sqrt(max(1, len(own)))
    lettered = lettered_codes(points, letters)
    digits = np.stack([used // (ALPHABET + 2) ** i % (ALPHABET + 2) for i in range(ORDER)])
    # Characters outside the alphabet are one code, so what holds one is known to no language.
    clear = lettered[used] & (digits != 1).all(0)
    of = np.array([[lang == x for x in languages] for lang, _ in landmarks], np.float32)
    known = ((presence @ of > 0) & clear[:, None]).astype(np.float32)
    model = Model(letters, column, presence, np.zeros((0, 0)), languages, lettered, known, np.zeros(len(languages)))
    own_values, vectors = np.linalg.eigh((presence.T @ presence).astype(float))
    kept = own_values > 1e-6 * own_values.max()
    root = vectors[:, kept] / np.sqrt(own_values[kept])
    features = kernel([t for _, t in sample], model).astype(float) @ root
    # A constant feature for the intercept, and every language weighs the same.
    features = np.hstack([features, np.ones((len(features), 1))])
    wanted = np.array([[lang == x for x in languages] for lang, _ in sample], float)
    weigh = (wanted / wanted.sum(0)).sum(1)[:, None]
    left = features.T @ (weigh * features) + ridge * np.eye(features.shape[1])
    solved = np.linalg.solve(left, features.T @ (weigh * wanted))
    model.weights = np.vstack([root @ solved[:-1], solved[-1:]])
    marks = set(landmarks)
    for i, lang in enumerate(languages):
        # Judged by texts that are no landmarks, which know all of themselves; else each landmark by the others.
        texts = [t for x, t in sample if x == lang and (x, t) not in marks]
        parts = [texts[at : at + BATCH] for at in range(0, len(texts), BATCH)]
        values = [v for part in parts for v in likeness(part, model)[:, i].tolist()]
        often = (presence[:, of[:, i] > 0] > 0).sum(1) > 1
        own = [x for x, (of_lang, _) in zip(sets, landmarks) if of_lang == lang]
        values = values or [(often & clear)[column[x] - 1].sum() / max(1, lettered[x].sum()) for x in own]
        model.limits[i] = LIKE_SHARE * np.median(values) if values else 0
    return model


def lettered_codes(points: dict[int, int], letters: np.ndarray) -> np.ndarray:
    """Of each code, whether it has ORDER characters and at least one letter; a character outside the alphabet counts as one."""
    base = ALPHABET + 2
    letter = np.zeros(base, bool)
    letter[1] = True
    for p in points:
        if letters[p] > 1:
            letter[letters[p]] = chr(p).isalpha()
    some = letter
    for _ in range(1, ORDER):
        some = (some[:, None] | letter[None, :]).ravel()
    some[: base ** (ORDER - 1)] = False
    return some


def likeness(texts: list[str], model: Model) -> np.ndarray:
    """Per text and language: the share of the text's different n-grams of ORDER characters, those with a letter, that the
    language's landmarks have. It goes to 0 for texts unlike all of them, and is 0 without such an n-gram."""
    found, _, totals = presence_of(texts, model)
    return likeness_of(found, totals, model)


def likeness_of(found: np.ndarray, totals: np.ndarray, model: Model) -> np.ndarray:
    return found @ model.known / np.maximum(1, totals)[:, None]


def predict(texts: list[str], model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best language's number, its regression value held to 0..1, and whether the text is like its texts."""
    found, sizes, totals = presence_of(texts, model)
    values = kernel_of(found, sizes, model) @ model.weights[:-1] + model.weights[-1]
    best = values.argmax(1)
    rows = np.arange(len(best))
    like = likeness_of(found, totals, model)[rows, best] >= model.limits[best]
    return best, np.clip(values[rows, best], 0, 1), like


def labelled_sample(
    df: DataFrame, id_col: str, text_col: str, lang_col: str, learn: Column, each: int
) -> list[tuple[str, str]]:
    """(language, text) of ``each`` documents per language, smallest id hash first; the texts are read for these only."""
    rows = df.where(learn).where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    hashed = F.xxhash64(F.col(id_col).cast("string"))
    # A few times as many as are wanted, by their hash: of a language with most of all rows only these are ordered.
    counts = {
        r["lang"]: r["n"]
        for r in rows.groupBy(F.col(lang_col).cast("string").alias("lang")).agg(F.count(F.lit(1)).alias("n")).collect()
    }
    if not counts:
        return []
    share = [F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, (4 * each + 100) / n))]
    rare = F.pmod(hashed, F.lit(1 << 40)) < F.try_element_at(F.create_map(*share), F.col(lang_col).cast("string")) * (1 << 40)
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(1 << 40)), "doc_id"))
    ids = (
        rows.where(rare)
        .select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), hashed.alias("h"))
        .distinct()
        .withColumn("place", place)
        .where(F.col("place") <= each)
    )
    wanted = F.broadcast(ids.select("doc_id", "lang", "place"))  # at most ``each`` rows per language
    texts = rows.select(
        F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")
    )
    found = texts.join(wanted, ["doc_id", "lang"]).select("lang", "place", "text").collect()
    return [(r["lang"], r["text"]) for r in sorted(found, key=lambda r: (r["place"], r["lang"], r["text"]))]


def learn_languages(
    df: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    n_landmarks: int = LANDMARKS, n_sample: int = SAMPLE,
) -> Model | None:
    sample = labelled_sample(df, id_col, text_col, lang_col, learn, n_sample)
    taken: dict[str, int] = {}
    landmarks = []
    for lang, text in sample:
        taken[lang] = taken.get(lang, 0) + 1
        if taken[lang] <= n_landmarks:
            landmarks.append((lang, text))
    return fit(landmarks, sample)


def predict_languages(df: DataFrame, model: Model | None, text_col: str = "text", reject: bool = False) -> DataFrame:
    """The rows with ``lang_pred`` and ``lang_score``; one pass, no shuffle. ``reject``: texts unlike their language's are ``und``, too."""
    bound_batches(df.sparkSession)
    # The number of n-gram codes bounds the model: a few MB.
    shared = df.sparkSession.sparkContext.broadcast(model)
    names_in = df.columns
    given = df.withColumn("_text", F.col(text_col).cast("string"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for block in blocks_of(batches, lambda b: text_sizes(b, "_text"), BLOCK_BYTES):
            texts = block.column("_text").to_pylist()
            names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            clear = [i for i, t in enumerate(texts) if t and fitted and any(c.isalpha() for c in t)]
            for at in range(0, len(clear), BATCH):
                mine = clear[at : at + BATCH]
                for i, b, value, like in zip(mine, *map(np.ndarray.tolist, predict([texts[i] for i in mine], fitted))):
                    if like or not reject:
                        names[i], scores[i] = fitted.languages[b], value
            yield pa.RecordBatch.from_arrays(
                [*[block.column(c) for c in names_in], pa.array(names), pa.array(scores)],
                names=[*names_in, "lang_pred", "lang_score"],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return given.mapInArrow(score, f"{fields}, lang_pred string, lang_score double")
