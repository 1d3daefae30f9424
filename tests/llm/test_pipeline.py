from __future__ import annotations

import importlib
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

corpus_pipeline = importlib.import_module("corpus_pipeline")


@pytest.fixture(scope="module")
def stages(spark, given, tmp_path_factory):
    """The tables between the stages, over the given documents."""
    folder = tmp_path_factory.mktemp("stages")
    made = [spark.read.parquet(f"{given}/documents.parquet")]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, made[-1], given).write.parquet(f"{folder}/{i}")
        made.append(spark.read.parquet(f"{folder}/{i}"))
    return made


def test_columns(stages):
    for table in stages[1:-1]:
        assert tuple(table.columns) == corpus_pipeline.COLUMNS
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(stages[-1].columns)


def test_filters_keep_good_documents(spark, given, stages):
    labels = spark.read.parquet(f"{given}/labels.parquet")
    good = labels.where("quality = 1").join(stages[0].where(F.size(F.split("text", r"\s+")) > 60), "doc_id").select("doc_id")
    for before, after in ((0, 1), (1, 2)):
        was = stages[before].join(good, "doc_id", "left_semi").count()
        assert stages[after].join(good, "doc_id", "left_semi").count() >= 0.97 * was
    bad = labels.where("quality = 0").select("doc_id")
    assert stages[2].join(bad, "doc_id", "left_semi").count() < 0.2 * stages[1].join(bad, "doc_id", "left_semi").count()


def test_no_copies_stay(stages):
    texts = [r[0] for r in stages[3].select(F.lower("text")).collect()]
    assert len(set(texts)) == len(texts)
    all_before = {r[0] for r in stages[2].select(F.lower("text")).collect()}
    assert len(all_before) - len(set(texts)) < 0.2 * len(all_before)


def test_mix_and_packing_hold_all_words(stages):
    words = stages[3].agg(F.sum(F.size(F.filter(F.split("text", r"[ \t\n\x0B\f\r]+"), lambda w: w != "")))).first()[0]
    mixed = stages[4].agg(F.sum(F.size(F.filter(F.split("text", r"[ \t\n\x0B\f\r]+"), lambda w: w != "")))).first()[0]
    assert abs(mixed - words) <= 64 * 25
    room = stages[5].groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert room.agg(F.max("n")).first()[0] <= 1024
    assert stages[5].where("start = 0").count() == stages[4].count()


def test_stages_take_awkward_and_empty_tables(spark, docs, no_docs, given, tmp_path):
    for name, table in (("rows", docs), ("none", no_docs)):
        now = table
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, now, given).write.parquet(f"{tmp_path}/{name}{i}")
            now = spark.read.parquet(f"{tmp_path}/{name}{i}")
        assert (now.count() == 0) == (name == "none")


def test_rest_imports_without_the_optional_part(tmp_path):
    """A copy without the two folders and the pipeline still lists the other queries."""
    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    code = (
        "import sys, importlib.abc\n"
        "class Gone(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.startswith(('cohortline.llm', 'corpus_pipeline')):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "names = e.queries()\n"
        "assert names and not any(n.startswith('op') and n[2].isdigit() or n == 'pipeline' for n in names)\n"
    )
    subprocess.run([sys.executable, "-B", "-c", code], cwd=root, check=True)


def test_operators_are_registered():
    import __spark_entry__ as e

    names = list(e.queries())
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1


def test_language_stage_rejects_what_no_language_claims(spark, given):
    """Other scripts, other languages, gibberish and digits go; labelled texts and other prose of the languages stay."""
    import random

    rng = random.Random(2)

    def drawn(letters, n):
        return "".join(rng.choice(letters) for _ in range(n))

    unlike = [
        "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью",
        "人人生而自由,在尊严和权利上一律平等。他们赋有理性和良心,并应以兄弟关系的精神相对待。",
        "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα",
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem",
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki",
        "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler",
        " ".join(drawn("abcdefghijklmnopqrstuvwxyz", rng.randint(2, 9)) for _ in range(60)),
        drawn("0123456789 ", 300) + "a",
        drawn("#$%&.,;!? ", 300) + "a",
    ]
    like = [
        "All human beings are born free and equal in dignity and rights. They are endowed with reason and conscience",
        "Alle Menschen sind frei und gleich an Würde und Rechten geboren. Sie sind mit Vernunft und Gewissen begabt",
    ]
    given_docs = spark.read.parquet(f"{given}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    rows = [(-1 - i, t, None, "x", len(t)) for i, t in enumerate([*unlike, *like])]
    more = spark.createDataFrame(rows, given_docs.schema)
    kept = {r["doc_id"] for r in corpus_pipeline.identify_language(spark, given_docs.unionByName(more), given).collect()}
    assert {i for i in kept if i < 0} == {-1 - len(unlike), -2 - len(unlike)}
    assert len([i for i in kept if i >= 0]) >= 0.99 * given_docs.count()
