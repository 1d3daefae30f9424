from __future__ import annotations

import hashlib
import json
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortline.llm import mixing
from cohortline.llm.chat import canonical_turns, escaped, format_records, read_loss, read_turns, turn_records, unescaped
from cohortline.llm.mixing import cut_words, draws, mixed_counts, mixed_documents, permuted, shared_targets, targets
from cohortline.llm.warc import LoserTree, archive_pages, capture_order, read_archives, url_key, write_archives

PAGES = "page_id bigint, url string, html string, digest string, time bigint"


@pytest.fixture(scope="module")
def pages(spark):
    long = "<p>" + "copy é " * 40
    rows = [(i, f"https://www.example.org/{i % 3}", f"<html>{i} " + "x" * i) for i in range(60)]
    rows += [(i, "https://example.org/hot", long) for i in range(100, 160)]
    rows += [(200, None, None), (201, "", ""), (202, "http://a b\r\nX: y", "short"), (203, "http://b/", "short")]
    rows += [(204, "http://c/", "WARC/1.1\r\nContent-Length: 3\r\n\r\n" + long), (None, "http://d/", long), (205, "http://[bad", long + "😀")]
    return spark.createDataFrame([(i, u, h, "d", 1) for i, u, h in rows], PAGES).repartition(4)


def test_archives_come_back_whole(spark, pages, tmp_path):
    write_archives(pages, str(tmp_path / "w"))
    back = read_archives(spark, str(tmp_path / "w")).collect()
    payload = {r["payload_digest"]: bytes(r["payload"]) for r in back if r["record_type"] == "response"}
    wanted = Counter((r["page_id"], (r["html"] or "").encode()) for r in pages.collect())
    assert Counter((r["page_id"], payload[r["payload_digest"]]) for r in back) == wanted
    for r in back:
        data = payload[r["payload_digest"]]
        assert len(data) == r["payload_bytes"] and hashlib.sha256(data).hexdigest() == r["payload_digest"]
        if r["record_type"] == "revisit":
            assert len(data) >= 100 and r["refers_to"] is not None and r["refers_to"] != r["page_id"]
    hot = [r for r in back if r["page_id"] is None or 100 <= r["page_id"] < 160]
    assert [r["page_id"] for r in hot if r["record_type"] == "response"] == [100]
    assert {r["refers_to"] for r in hot if r["page_id"] != 100} == {100}


def test_any_number_is_a_page_id(spark, tmp_path):
    ids = [0, -1, 10**12, -(10**11), 2**63 - 1, -(2**63), None, 7]
    copy = "<p>" + "x" * 200
    table = spark.createDataFrame([(i, f"http://a/{n}", copy if n % 2 else f"page {n}", "d", n) for n, i in enumerate(ids)], PAGES)
    back = {r["page_id"]: r for r in archive_pages(table).collect()}
    assert set(back) == set(ids)
    same = [i for n, i in enumerate(ids) if n % 2]
    least = min(i for i in same if i is not None)
    for i in ids:
        revisits = i in same and i != least
        assert back[i]["record_type"] == ("revisit" if revisits else "response")
        assert back[i]["refers_to"] == (least if revisits else None)
    nulls = spark.createDataFrame([(None, "u", copy, "d", 0), (3, "u", copy, "d", 0)], PAGES)
    assert {r["page_id"]: r["refers_to"] for r in archive_pages(nulls).collect()} == {None: 3, 3: None}
    late = table.withColumn("time", F.lit(2**62))
    with pytest.raises(Exception, match="no second of the years"):
        write_archives(late, str(tmp_path / "late"), time=F.col("time"))


def test_index_is_in_global_order(pages, monkeypatch):
    monkeypatch.setattr("cohortline.llm.warc.RANGE_ROWS", 20)
    rows = archive_pages(pages).orderBy("range", "place").collect()
    assert len(rows) == pages.count()
    keys = [(r["url_key"], r["time"], r["page_id"] is not None, r["page_id"] or 0) for r in rows]
    assert keys == sorted(keys)
    seen = Counter()
    for r in rows:
        seen[r["url_key"]] += 1
        assert r["history"] == seen[r["url_key"]]


def test_equal_captures_are_spread_over_ranges(spark, monkeypatch):
    monkeypatch.setattr("cohortline.llm.warc.RANGE_ROWS", 30)
    monkeypatch.setattr("cohortline.llm.warc.RUN_ROWS", 4)
    same = spark.createDataFrame([(5, "http://a/", "<p>" + "x" * 200, "d", 9)] * 300 + [(6, "http://b/", "y", "d", 9)] * 20, PAGES)
    rows = archive_pages(same.repartition(6)).orderBy("range", "place").collect()
    assert [r["page_id"] for r in rows] == [5] * 300 + [6] * 20
    assert [r["history"] for r in rows] == [*range(1, 301), *range(1, 21)]
    assert max(Counter(r["range"] for r in rows).values()) < 120


def test_no_pages(spark):
    assert archive_pages(spark.createDataFrame([], PAGES)).collect() == []


def test_loser_tree_merges_runs():
    rng = random.Random(1)
    for k in (0, 1, 2, 3, 5, 8, 13):
        runs = [sorted(rng.randrange(50) for _ in range(rng.randrange(20))) for _ in range(k)]
        assert list(LoserTree(runs)) == sorted(x for r in runs for x in r)


def test_url_keys():
    assert url_key("https://www.Example.org/A?b=1") == "org,example)/a?b=1"
    assert url_key("http://[bad") == "http://[bad" and capture_order((None, "", "k", 1, "", 0, "", None, "f", 2))[2] is False


def test_targets_share_all_and_stop_at_three_times():
    sizes = [100, 10, 5, 0, 300]
    found = shared_targets(sizes, [1, 2, 3, 1, 2])
    assert abs(sum(found) - sum(sizes)) < 1e-6
    assert all(t <= 3 * n + 1e-9 for t, n in zip(found, sizes)) and found[1] == 30 and found[2] == 15
    assert shared_targets([], []) == [] and shared_targets([0], [1]) == [0]


def test_permutation():
    import numpy as np

    for n in (1, 2, 3, 10, 1000):
        assert sorted(permuted(np.arange(n), n, 5).tolist()) == list(range(n))
    assert permuted(np.arange(1000), 1000, 5).tolist() != list(range(1000))


def test_draws_are_exact_and_pass_by_pass(spark):
    totals = spark.createDataFrame([("a", 64 * 9000), ("b", 64 * 500), (None, 130), ("c", 0)], "source string, source_size bigint")
    table = targets(totals)
    rows = draws(table).collect()
    for s in table.collect():
        own = [r for r in rows if r["number"] == s["number"]]
        assert len(own) == s["n_draws"]
        times = Counter((r["pass"], r["block"]) for r in own)
        assert all(n == 1 for n in times.values())
        assert all(r["block"] < s["n_blocks"] and r["pass"] < 3 for r in own)
    assert len({r["shard"] for r in rows}) > 1


def test_mix_comes_near_targets_and_repeats(spark, docs, no_docs):
    rows = mixed_counts(docs).collect()
    assert len(rows) == docs.count()
    again = mixed_counts(docs.repartition(5)).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again))
    taken, target = defaultdict(int), {}
    for r in rows:
        assert r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    for s, t in target.items():
        assert abs(taken[s] - t) <= 64
    assert mixed_counts(no_docs).collect() == []


def test_mixed_documents_hold_the_taken_words(docs, no_docs):
    made = mixed_documents(docs)
    assert made.columns == docs.columns
    words = Counter()
    for r in made.collect():
        words[r["doc_id"], r["source"]] += len((r["text"] or "").encode().split())
    wanted = Counter()
    for r in mixed_counts(docs).collect():
        wanted[r["doc_id"], r["source"]] += r["taken"]
    assert words == +wanted
    assert mixed_documents(no_docs).collect() == []


def test_cut_words():
    text = b" a b\nc  d e "
    assert cut_words(text, [(0, 2), (2, 5)], 5) == text
    assert cut_words(text, [(3, 5), (1, 2)], 5) == b"b\nd e "


def test_layouts(spark):
    records = [
        ({"prompt": "p", "response": "r"}, "prompt_response", [("user", "p"), ("assistant", "r")]),
        ({"instruction": "i", "input": "", "output": "o"}, "instruction_input_output", [("user", "i"), ("assistant", "o")]),
        ({"instruction": "i", "input": "x", "output": None}, "instruction_input_output", [("user", "i\n\nx"), ("assistant", "")]),
        ({"messages": [{"role": "system", "content": "s"}, {"content": None, "role": "user"}]}, "messages", [("system", "s"), ("user", "")]),
        ({"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}]}, "conversations", [("user", "h"), ("assistant", "g")]),
        ({"role": "user", "text": "t"}, "turn", [("user", "t")]),
        ({"other": 1}, None, []),
        ({"messages": "no list"}, None, []),
    ]
    rows = [(i, json.dumps(r)) for i, (r, _, _) in enumerate(records)] + [(90, "no json"), (91, None)]
    table = spark.createDataFrame(rows, "id int, record string")
    found = {r["id"]: (r["layout"], [tuple(t) for t in r["turns"]], r["schema_hash"]) for r in canonical_turns(table).collect()}
    for i, (_, layout, turns) in enumerate(records):
        assert found[i][:2] == (layout, turns)
    assert found[1][2] == found[2][2] and found[90][:2] == found[91][:2] == (None, [])


def test_format_and_read_back(spark):
    texts = ["", "a", "<|turn|>user\nx<|end|>\n", "&amp; &lt; [INST] \\ < & [", "é😀\n\n", "&#10;&#91;", "</s>[INST] ok [/INST]"]
    rows = []
    for c in range(6):
        for t in range(7):
            rows.append((c, t // 2, ("user", "assistant", "odd\n<|end|>", None)[(c + t) % 4], texts[(c * t) % 7]))
    rows += [(None, None, None, None), (9, 0, "assistant", "x" * 3_000_000)]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    records = table.select("conv_id", "turn", turn_records(table).alias("record"))
    made = format_records(records).withColumn("data", F.encode("formatted", "UTF-8"))
    back = made.select("conv_id", read_turns(F.col("formatted")).alias("turns"), read_loss(F.col("data"), F.col("loss_spans")).alias("loss"))
    wanted = defaultdict(list)
    for c, t, role, text in rows:
        wanted[c].append((-1 if t is None else t, role or "", text or ""))
    got = {r["conv_id"]: ([tuple(t) for t in r["turns"]], r["loss"]) for r in back.collect()}
    assert set(got) == set(wanted)
    for c, turns in wanted.items():
        turns = [(r, x) for _, r, x in sorted(turns)]
        assert got[c] == (turns, "".join(x for r, x in turns if r == "assistant"))


def test_escape_is_reversible(spark):
    texts = ["&", "&amp;", "&lt;<[&#91;", "<|end|>", ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", escaped(F.col("t")).alias("e"), unescaped(escaped(F.col("t"))).alias("u")).collect():
        assert r["u"] == r["t"] and "<" not in r["e"] and "[" not in r["e"]


def test_chat_is_native(spark, given):
    from cohortline.llm.registered import op10_chat

    plan = op10_chat(spark, given)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_no_conversation_vanishes(spark):
    rows = [
        (1, 0, '{"prompt": "p", "response": "r"}'),
        (2, 0, '{"other": 1}'),
        (3, 0, "no json"),
        (4, 0, '{"messages": [{"role": "user", "content": "c", "extra": 1}]}'),
        (5, 0, '{"messages": []}'),
        (6, 0, '{"other": 1}'), (6, 1, '{"role": "assistant", "text": "a"}'), (6, 2, None),
    ]
    made = format_records(spark.createDataFrame(rows, "conv_id int, turn int, record string"))
    got = {r["conv_id"]: (r["formatted"], r["loss_spans"], r["n_unmapped"]) for r in made.collect()}
    assert set(got) == {1, 2, 3, 4, 5, 6}
    assert got[1][2] == 0 and "r" in got[1][0]
    assert all(got[i][0] == "" and got[i][1] == [] for i in (2, 3, 4, 5)) and got[2][2] == got[3][2] == got[4][2] == 1
    assert got[6][2] == 2 and got[6][0].count("<|turn|>") == 1
    back = made.where("conv_id in (5, 6)").select("conv_id", F.size(read_turns(F.col("formatted"))).alias("n")).collect()
    assert {r["conv_id"]: r["n"] for r in back} == {5: 0, 6: 1}


@pytest.mark.parametrize("rows_a_task", [8, 2048])
def test_what_the_mix_takes_against_a_plain_loop(spark, docs, monkeypatch, rows_a_task):
    """Every word of a source in one list, cut into blocks, and the blocks that its draws take counted one by one."""
    monkeypatch.setattr(mixing, "STREAM_ROWS", rows_a_task)
    monkeypatch.setattr(mixing, "SHARD_DRAWS", 50)
    text = F.coalesce("text", F.lit(""))
    size = F.size(F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).cast("bigint")
    order = F.xxhash64(F.col("doc_id").cast("string"), size, F.xxhash64(text))
    given = docs.select("doc_id", "source", text.alias("text"), F.xxhash64(text).alias("hash"), order.alias("order"))
    sized = [(r.doc_id, r.source, len(re.findall(r"[^\x20\x09-\x0D]+", r.text)), r.hash, r.order) for r in given.collect()]
    names = sorted({s for _, s, *_ in sized}, key=lambda s: (s is None, s or ""))
    sizes = [sum(n for _, s, n, *_ in sized if s == name) for name in names]
    goals = shared_targets(sizes, [(1, 2, 3)[k % 3] for k in range(len(names))])
    # With one bucket a stream follows the signed hash, with several the unsigned one.
    turn = 1 << 64 if rows_a_task == 8 else 0
    expected = []
    for k, name in enumerate(names):
        mine = [x for x in sized if x[1] == name]
        mine.sort(key=lambda x: (x[4] + turn if x[4] < 0 else x[4], x[0] is not None, x[0] or 0, x[2], x[3]))
        words = [at for at, x in enumerate(mine) for _ in range(x[2])]
        blocks = [words[b : b + mixing.BLOCK_WORDS] for b in range(0, len(words), mixing.BLOCK_WORDS)]
        taken = Counter()
        n, n_draws = mixing.draws_for(goals[k], sizes[k])
        assert n == len(blocks)
        for j in range(n_draws):
            key = (mixing.SEED * 1_000_003 + k) * 7 + j // n
            taken.update(blocks[int(permuted(np.array([j % n]), n, key)[0])])
        expected += [(x[0], name, x[2], sizes[k], goals[k], taken[at]) for at, x in enumerate(mine)]
    got = [tuple(r) for r in mixed_counts(docs).collect()]
    assert Counter(got) == Counter(expected)
