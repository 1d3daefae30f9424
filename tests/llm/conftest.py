"""Small tables with the awkward cases that every operator has to take."""

from __future__ import annotations

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, words string, size int, block int, train boolean"

GERMAN = "der die das und nicht ein eine mit von zu den ist auf für im dem sich auch es an werden aus er hat dass sie nach wird bei"
ENGLISH = "the and of to in a is that for it as was with be by on not he his but at are this have from or had an they which"


def text_of(words: str, n: int, seed: int) -> str:
    import random

    rng = random.Random(seed)
    chosen = words.split()
    out = [rng.choice(chosen) + rng.choice(["", "", "", ".", ",", "er", "ing"]) for _ in range(n)]
    return " ".join(out[: n // 2]) + "\n" + " ".join(out[n // 2 :])


def rows() -> list[tuple]:
    """Nulls in any column, empty and very long texts, ties, repeated rows, odd characters."""
    out = []
    for i in range(40):
        lang = ("de", "en")[i % 2]
        text = text_of((GERMAN, ENGLISH)[i % 2], 30 + 7 * i, i)
        out.append((i, text, lang, ("a", "b", "c", None)[i % 4]))
    long = text_of(ENGLISH, 40_000, 99)
    out += [
        (100, None, "en", "a"),
        (101, "", "en", "a"),
        (102, " \n\t ", None, "b"),
        (103, long, "en", "a"),
        (104, long, "en", "a"),
        (105, "1234 5678 ### $$$", None, None),
        (106, "one", None, "z"),
        (107, "  leading  and \r\n odd spaces 　 ｗｉｄｅ 😀 <|endoftext|> É", "en", "b"),
        (0, out[0][1], "de", "a"),
        (0, out[0][1], "de", "a"),
        (None, out[1][1], "en", None),
        (None, None, None, None),
        (108, " ".join(["same words again and again in this long line"] * 30), "en", "c"),
    ]
    return [(i, t, lang, s, len(t or ""), "x", 1, 2, True) for i, t, lang, s in out]


@pytest.fixture(scope="session")
def docs(spark):
    """Has columns whose names the operators use inside."""
    return spark.createDataFrame(rows(), DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def given(spark):
    import os

    folder = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(folder):
        pytest.skip("the given tables are not here")
    return folder
