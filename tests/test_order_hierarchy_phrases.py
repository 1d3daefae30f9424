from __future__ import annotations

import random
import re

import pytest
from conftest import final_plan, rows
from pyspark.sql import functions as F

from cohortline.functions.permute import permuted
from cohortline.operators import phrases as ph
from cohortline.operators.hierarchy import ancestors, cycle_items, roll_up
from cohortline.operators.splits import epoch_order, indexed_shards, shard_positions
from cohortline.sources.listing import ListingReader, list_files

# --- order by a bijection


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 1000])
def test_every_place_once_and_back(spark, n):
    df = spark.range(n).withColumn("key", F.lit("42:1:0"))
    moved = df.withColumn("to", permuted(F.col("id"), F.lit(n), F.col("key")))
    back = moved.withColumn("from", permuted(F.col("to"), F.lit(n), F.col("key"), inverse=True)).collect()
    assert sorted(r["to"] for r in back) == list(range(n))
    assert all(r["from"] == r["id"] for r in back)
    if n == 1000:
        assert sum(abs(r["to"] - r["id"]) for r in back) > 250 * n
        other = df.select(permuted(F.col("id"), F.lit(n), F.lit("42:2:0")).alias("to")).collect()
        assert sum(a["to"] == b["to"] for a, b in zip(back, other)) < 20


def test_a_new_epoch_needs_no_shuffle(spark):
    df = spark.range(500).select(F.concat(F.lit("s"), "id").alias("subject_key"))
    shards = indexed_shards(df, 3)
    stored = spark.createDataFrame(shards.collect(), shards.schema)
    orders = {}
    for epoch in (0, 1):
        ordered = epoch_order(stored, 16, epoch=epoch)
        assert "Exchange" not in final_plan(ordered)
        got = ordered.collect()
        for shard in {r["shard"] for r in got}:
            own = [r for r in got if r["shard"] == shard]
            assert sorted(r["position"] for r in own) == list(range(len(own)))
            assert all(r["batch"] == r["position"] // 16 for r in own)
        orders[epoch] = {r["subject_key"]: r["position"] for r in got}
    assert orders[0] != orders[1]
    # One batch read alone is the batch of the whole order.
    alone = shard_positions(stored, 1, range(16, 32), epoch=1)
    assert {r["subject_key"] for r in alone.collect()} == {
        r["subject_key"] for r in epoch_order(stored, 16, epoch=1).where("shard = 1 and batch = 1").collect()
    }


# --- hierarchy


def closure(edges):
    above = {}
    for item, parent in edges:
        if item is not None and parent is not None:
            above.setdefault(item, set()).add(parent)
    out = {}
    for item in above:
        seen, level, distance = {}, {item}, 0
        while level:
            distance += 1
            level = {p for x in level for p in above.get(x, ())} - set(seen)
            seen.update(dict.fromkeys(level, distance))
        out.update({(item, a): d for a, d in seen.items()})
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_ancestors_with_cycles_and_several_parents(spark, seed):
    rng = random.Random(seed)
    edges = [(i, rng.randrange(max(1, i))) for i in range(1, 60)] + [(100 + i, 100 + (i + 1) % 7) for i in range(7)]
    edges += [(200 + i, 201 + i) for i in range(40)] + [(5, 3), (300, 100), (301, 301), (None, 1), (1, None), (5, 3)]
    table = spark.createDataFrame(edges, "item int, parent int")
    pairs = ancestors(table)
    wanted = closure(edges)
    assert {(r["item"], r["ancestor"]): r["distance"] for r in pairs.collect()} == wanted
    assert {r["item"] for r in cycle_items(pairs).collect()} == {a for a, b in wanted if a == b}
    facts = [(rng.randrange(60), 1, rng.random() < 0.5) for _ in range(200)] + [(103, 1, True), (301, 1, True), (777, 1, True), (None, 1, True)]
    sums = roll_up(spark.createDataFrame(facts, "item int, n int, open boolean"), pairs, {"total": "n"})
    expected = {}
    for item, n, _ in facts:
        if item is not None:
            for a in {item} | {b for x, b in wanted if x == item}:
                expected[a] = expected.get(a, 0) + n
    assert {r["item"]: r["total"] for r in sums.collect()} == expected


def test_hierarchies_of_projects_are_apart(spark):
    table = spark.createDataFrame([("p", 1, 2), ("q", 2, 3), ("p", 2, 4)], "project string, item int, parent int")
    assert rows(ancestors(table, by="project")) == [("p", 1, 2, 1), ("p", 1, 4, 2), ("p", 2, 4, 1), ("q", 2, 3, 1)]
    assert ancestors(table.limit(0), by="project").collect() == []


# --- phrases


def found_by_hand(texts, listed):
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    out = []
    for i, text in texts:
        said = words(text)
        for j, phrase in listed:
            wanted = words(phrase)
            out += [(i, j, k) for k in range(len(said)) if wanted and said[k : k + len(wanted)] == wanted]
    return sorted(out, key=str)


def test_phrases_are_found(spark, monkeypatch):
    rng = random.Random(3)
    vocabulary = ["the", "the", "the", "of", "Red", "knee", "joint", "x-ray", "Élan", "中文", "a1"]
    texts = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60)))) for i in range(80)]
    texts += [(900, None), (901, ""), (902, "the"), (903, "THE,of;Red the of"), (3, "knee joint"), (None, "the of")]
    listed = [(1, "the of"), (2, "Knee Joint"), (3, "x ray"), (4, "the"), (5, "the the the the"), (6, "never said words"), (7, ""), (8, None)]
    listed += [(9, "élan"), (10, "of red knee joint x ray a1"), (11, "KNEE  joint"), (12, "knee"), (2, "red"), (13, "中文")]
    table = spark.createDataFrame(texts, "doc_id int, text string").repartition(3)
    phrases = spark.createDataFrame(listed, "phrase_id int, phrase string")
    wanted = found_by_hand(texts, listed)
    got = ph.find_phrases(table, phrases)
    assert got.columns == ["text_id", "phrase_id", "position"]
    assert sorted(map(tuple, got.collect()), key=str) == wanted and len(wanted) > 100
    # Words that share a place of the small table still give only true matches.
    monkeypatch.setattr(ph, "BUCKETS", 3)
    assert sorted(map(tuple, ph.find_phrases(table, phrases).collect()), key=str) == wanted
    assert ph.find_phrases(table.limit(0), phrases).collect() == []
    assert ph.find_phrases(table, phrases.limit(0)).collect() == []
    assert ph.find_phrases(table, phrases.where("phrase_id > 6 and phrase_id < 9")).collect() == []


# --- file listing


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    top = tmp_path_factory.mktemp("tree")
    names = [f"p{p}/s{s}/deep/{f}" for p in range(4) for s in range(6) for f in ("a.dcm", "b.DCM", "c.txt", "noext")]
    for name in [*names, "top.dcm", "p0/here.dcm"]:
        path = top / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"12345")
    return top, names


def test_listing_gives_the_rows_of_the_built_in_one(spark, tree):
    top, names = tree
    listed = list_files(spark, str(top), tasks=5)
    got = {r.path: r for r in listed.collect()}
    assert len(got) == listed.count() == len(names) + 2
    built_in = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(top)).select("path", "length")
    assert {p.removeprefix("file:") for p, _ in rows(built_in)} == set(got)
    one = got[f"{top}/p2/s3/deep/b.DCM"]
    assert (one.name, one.extension, one.project, one.length) == ("b.DCM", ".dcm", "p2", 5) and one.modified is not None
    assert got[f"{top}/top.dcm"].project == "" and got[f"{top}/p0/here.dcm"].project == "p0"


def test_filters_reach_the_listing(spark, tree):
    top, _ = tree
    some = list_files(spark, str(top), ".dcm").where(F.col("project").isin("p1", "p3") & F.col("path").endswith("a.dcm"))
    assert {r.project for r in some.collect()} == {"p1", "p3"} and some.count() == 12
    from pyspark.sql.datasource import EqualTo, GreaterThan

    reader = ListingReader(str(top), 3)
    rest = list(reader.pushFilters([EqualTo(("project",), "p1"), GreaterThan(("length",), 3)]))
    assert len(rest) == 1 and reader.equal == {"project": {"p1"}}
    directories = [d for p in reader.partitions() for d, _ in p.directories]
    assert directories and not any("/p0" in d or "/p2" in d for d in directories)
    # The driver holds directories, not files; each is listed by one task.
    assert len(directories) == len(set(directories))


def test_wide_levels_stay_with_their_parents(spark, tree, monkeypatch):
    from cohortline.sources import listing

    monkeypatch.setattr(listing, "MOST_DIRECTORIES", 5)
    top, names = tree
    parts = ListingReader(str(top), 2).partitions()
    assert sum(len(p.directories) for p in parts) <= 1 + 5
    reader = ListingReader(str(top), 2)
    found = [x for p in reader.partitions() for b in reader.read(p) for x in b.column("path").to_pylist()]
    assert len(found) == len(set(found)) == len(names) + 2
