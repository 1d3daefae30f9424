from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortline.llm import simhash
from cohortline.llm.kdtree import Tree, top_k
from cohortline.llm.simhash import components, keep_one, links, near_groups, shingle_hashes, signed

VECTORS = "vec_id bigint, embedding array<float>, label int, score bigint, shard int"


def brute(rows, k=5, step=50):
    sound = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            sound[i, tuple(int(np.floor(256 * float(np.float32(x)))) for x in v)] = True
    out = []
    for qi, qv in sound:
        if qi % step == 0:
            found = sorted(
                (-sum(a * b for a, b in zip(qv, v)), i)
                for i, v in sound
                if (i, v) != (qi, qv) and len(v) == len(qv)
            )[:k]
            out += [(qi, n + 1, i, -s) for n, (s, i) in enumerate(found)]
    return sorted(out)


@pytest.fixture(scope="module")
def vectors():
    rng = random.Random(5)
    same = [rng.uniform(-1, 1) for _ in range(6)]
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(260)]
    rows += [(i, same) for i in range(300, 420)]  # one very common vector
    rows += [(500, None), (550, [None] * 6), (600, [float("nan")] + same[1:]), (650, [float("inf")] + same[1:])]
    rows += [(None, same), (0, rows[0][1]), (700, []), (701, []), (750, [1.0, 2.0])]
    return rows


def as_table(spark, rows):
    return spark.createDataFrame([(i, v, 0, 0, 0) for i, v in rows], VECTORS)


def test_top_k_equals_brute_force(spark, vectors, monkeypatch):
    monkeypatch.setattr("cohortline.llm.kdtree.SHARD_ROWS", 64)
    got = top_k(as_table(spark, vectors), F.col("vec_id") % 50 == 0)
    assert sorted(tuple(r) for r in got.collect()) == brute(vectors)


def test_top_k_of_nothing(spark):
    assert top_k(as_table(spark, []), F.col("vec_id") % 50 == 0).collect() == []
    assert top_k(as_table(spark, [(1, [1.0])]), F.col("vec_id") % 50 == 0).collect() == []


def test_repeated_rows_and_ids_as_the_sql_has_them(spark, tmp_path):
    import duckdb

    from cohortline.llm.registered import ORACLES

    data = [(50, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 0.0]), (50, [0.2, 0.0]), (50, [1.0, 0.0]), (3, [1.0, 0.0])]
    table = as_table(spark, data)
    table.write.parquet(str(tmp_path / "e"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/e/*.parquet'")
    wanted = con.execute(f"SELECT query_id, rank, vec_id, score FROM ({ORACLES['op2_kdtree']})").fetchall()
    got = [tuple(r) for r in top_k(table, F.col("vec_id") % 50 == 0).collect()]
    assert sorted(got) == sorted(wanted)
    assert sorted(x[2] for x in got) == [1, 1, 2, 2, 3, 3, 50, 50]


@pytest.mark.parametrize("long", [1e30, -1e20, 4e5])
def test_vectors_beyond_exact_products_are_refused(spark, long):
    table = as_table(spark, [(50, [1.0, 0.0]), (7, [long, 0.5])])
    with pytest.raises(Exception, match="not be exact: vector 7"):
        top_k(table, F.col("vec_id") % 50 == 0).collect()


def test_boxes_bound_all_points_below():
    rng = np.random.default_rng(1)
    points = np.floor(rng.normal(size=(500, 8)) * 256)
    tree = Tree(np.arange(500), np.arange(500), points, 20)
    queries = np.floor(rng.normal(size=(10, 8)) * 256)
    bounds = tree.bounds(queries)
    for node, rows in enumerate(tree.rows):
        assert (bounds[:, node] >= (queries @ points[rows].T).max(1)).all()
        if tree.children[node]:
            left, right = tree.children[node]
            assert sorted([*tree.rows[left], *tree.rows[right]]) == sorted(rows)
    least = -np.inf
    for q, b in zip(queries, bounds):
        found = tree.search(q, b, -1, -1, 5, least)
        assert [s for s, _ in found] == sorted((points @ q).tolist(), reverse=True)[:5]


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_fingerprint(text):
    import xxhash

    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    group = list(range(len(prints)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 2:
                x, y = root(i), root(j)
                group[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(prints))]


def test_fingerprints_and_groups_equal_brute_force(docs, no_docs):
    given = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    prints = [plain_fingerprint(t) for _, t in given]
    roots = plain_components(prints)
    least = {}
    for (i, _), r in zip(given, roots):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    wanted = sorted((str(i), format(p, "016x"), least.get(r)) for (i, _), p, r in zip(given, prints, roots))
    got = near_groups(docs).collect()
    assert sorted((str(r["doc_id"]), r["fingerprint"], r["component_id"]) for r in got) == wanted
    assert near_groups(no_docs).collect() == []


@pytest.mark.parametrize("bucket", [1, 64])
def test_links_are_those_of_all_pairs(spark, monkeypatch, bucket):
    """Clouds of near fingerprints around a few centres, with small and with large keys."""
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rng = random.Random(2)
    prints = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(25):
            x = centre
            for _ in range(rng.randint(0, 4)):
                x ^= 1 << rng.randrange(64)
            prints.add(x)
    prints = sorted(signed(x) for x in prints | {0, (1 << 64) - 1})
    table = spark.createDataFrame([(x,) for x in prints], "fp bigint")
    found = {r["node"]: r["root"] for r in components(links(table)).collect()}
    wanted = plain_components([x % (1 << 64) for x in prints])
    groups = {}
    for x, r in zip(prints, wanted):
        groups.setdefault(r, set()).add(x)
    got = {}
    for x in prints:
        got.setdefault(found.get(x, x), set()).add(x)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, got.values()))


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501)], "a bigint, b bigint")
    found = {r["node"]: r["root"] for r in components(edges).collect()}
    assert found == {**{i: 0 for i in range(1, 201)}, 501: 500}


def test_one_document_of_each_group_stays(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(5000)]
    rows, n = [], 0
    for length in (0, 2, 60, 400, 3000):
        for _ in range(5):
            base = rng.choices(words, k=length)
            for edits in (0, 0, 1):
                copy = list(base)
                for _ in range(min(edits, length)):
                    copy[rng.randrange(length)] = rng.choice(words)
                rows.append((n, " ".join(copy)))
                n += 1
    # Repeated ids with other texts and null ids, and columns named like those used inside.
    rows += [(7, " ".join(rng.choices(words, k=300))), (None, rows[40][1]), (None, " ".join(rng.choices(words, k=300)))]
    table = spark.createDataFrame([(*r, "d", 1, "r") for r in rows], "doc_id bigint, text string, digest string, place int, row string")
    groups = near_groups(table).collect()
    kept = keep_one(table)
    assert kept.columns == table.columns
    got = kept.collect()
    named = {r["component_id"] for r in groups if r["component_id"] is not None}
    assert named <= {r["doc_id"] for r in got}
    assert sum(r["doc_id"] is None for r in got) == sum(r["component_id"] is None for r in groups) == 1
    # The prints of the kept texts lie in different components, and all components are there.
    prints = {r["fingerprint"] for r in near_groups(kept).collect()}
    assert len(prints) == len(got) == len(named) + 1
    assert len({r["component_id"] for r in near_groups(kept).collect()}) == len(named) + 1


def test_keep_one_takes_awkward_rows(docs, no_docs):
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    # 103 and 104 are copies, 0 is repeated; null, empty and blank texts are one group of texts without words.
    assert ids.count(0) == 1 and 103 in ids and 104 not in ids
    assert len([i for i in ids if i in (100, 101, 102, None)]) <= 2
    assert keep_one(no_docs).collect() == []
