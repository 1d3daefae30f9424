from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given as examples
from hypothesis import settings
from hypothesis import strategies as st

from cohortline.llm import divergence as div
from cohortline.llm import prefix_trie as trie
from cohortline.llm.bpe import PairIndex, decode_ids, encode_texts, word_decoder, word_encoder
from cohortline.llm.divergence import divergence
from cohortline.llm.tokens import tokenizer_path
from cohortline.llm.transducer import Transducer

# --- BPE encoding and decoding


@pytest.fixture(scope="module")
def library():
    pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))


BITS = ["a", "b ", "  ", " ", "\n", "\t", "é", "é", "'s", "'ll", "'", "12", "!", "!!!!", "　", "<|endoftext|>", "<|startoftext|>"]
BITS += ["<|ENDOFTEXT|>", "Ab", "\x1c", "\r\n", "中", "😀", "́", "\x85", "İ", "ΑΣ", "\x00", "<|", "|>", "aaaa", "the", "ing", "가"]
BITS += ["ﬁ", "१२", "‍", "don't", "I'M", "×", "÷", "µ", "ª", "²", "½", "\xa0", "ÿ", "Þ", "ß"]


def test_ids_and_texts_are_the_librarys(library):
    rng = random.Random(3)
    texts = ["".join(rng.choice(BITS) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    encoder = word_encoder(tokenizer_path("word_bpe_49k.json"))
    ids, bounds = encoder.encode(pa.array(texts))
    back = word_decoder(tokenizer_path("word_bpe_49k.json")).decode(ids, bounds).to_pylist()
    for i, text in enumerate(texts):
        wanted = library.encode(text, add_special_tokens=False).ids
        assert ids[bounds[i] : bounds[i + 1]].tolist() == wanted, text
        assert back[i] == library.decode(wanted, skip_special_tokens=False), text


def test_every_character_alone_and_beside_a_letter(library):
    encoder = word_encoder(tokenizer_path("word_bpe_49k.json"))
    texts = [x for c in range(0x250) for x in (chr(c), f"a{chr(c)}b")]
    ids, bounds = encoder.encode(pa.array(texts))
    for i, text in enumerate(texts):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_wide_path_agrees_with_the_narrow_one(library, monkeypatch):
    encoder = word_encoder(tokenizer_path("word_bpe_49k.json"))
    parts = ["Don't", "l'été", "x²½", "a\xa0b", "'sabc", "''s"]
    narrow = encoder.words_of(parts)
    monkeypatch.setattr(encoder, "usual", False)
    assert encoder.words_of(parts) == narrow


def test_bpe_over_awkward_rows(docs, no_docs, library):
    made = decode_ids(encode_texts(docs))
    assert made.columns == ["doc_id", "ids", "decoded"]
    got = Counter((r.doc_id, bytes(r.ids), r.decoded) for r in made.collect())
    wanted: Counter = Counter()
    for r in docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        wanted[r.doc_id, np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)] += 1
    assert got == wanted
    assert decode_ids(encode_texts(no_docs)).collect() == []


def merged_by_hand(symbols, ranks, made):
    """The lowest rank first, its leftmost place first, one merge at a time."""
    symbols = list(symbols)
    while True:
        pairs = [(ranks[p], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in ranks]
        if not pairs:
            return symbols
        rank, i = min(pairs)
        symbols[i : i + 2] = [made[rank]]


@examples(st.lists(st.lists(st.integers(0, 2), min_size=1, max_size=12), min_size=1, max_size=6), st.integers(0, 10**6))
@settings(max_examples=150, deadline=None)
def test_pair_index_merges_like_one_merge_at_a_time(words, seed):
    rng = random.Random(seed)
    pairs, made, tokens = [], [], [0, 1, 2]
    for _ in range(8):
        pair = (rng.choice(tokens), rng.choice(tokens))
        if pair not in pairs:
            pairs.append(pair)
            made.append(len(tokens))
            tokens.append(len(tokens))
    keys = np.array([a << 32 | b for a, b in pairs], np.int64)
    order = np.argsort(keys)
    symbols = np.array([x for w in words for x in [*w, -1]], np.int64)
    index = PairIndex(symbols, keys[order], order.astype(np.int64), np.array(made, np.int64))
    out = index.merge(np.array(pairs, np.int64)).tolist()
    ranks = {p: i for i, p in enumerate(pairs)}
    assert out == [x for w in words for x in [*merged_by_hand(w, ranks, made), -1]]


# --- Source divergence audit


@examples(st.sets(st.binary(max_size=6), max_size=40), st.lists(st.binary(max_size=6), max_size=20))
@settings(max_examples=150, deadline=None)
def test_transducer_gives_ordinals(words, others):
    ordered = sorted(words)
    made = Transducer(ordered)
    asked = [*ordered, *others]
    data = np.frombuffer(b"".join(asked), np.uint8)
    sizes = np.array([len(x) for x in asked], np.int64)
    found = made.ordinals(data, np.cumsum(sizes) - sizes, sizes)
    assert found.tolist() == [ordered.index(x) if x in words else -1 for x in asked]


def test_transducer_is_minimal():
    words = sorted(a + b for a in (b"ab", b"cd", b"xyz") for b in (b"ing", b"ed", b"s", b""))
    made = Transducer(words)
    # Equal suffix sets are one state: states are as many as there are distinct sets of continuations.
    rights = {frozenset(w[len(p) :] for w in words if w.startswith(p)) for w in words for p in [w[:i] for i in range(len(w) + 1)]}
    assert len(made.states) == len(rights)
    with pytest.raises(ValueError):
        Transducer([b"b", b"a"])


def divergence_by_hand(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(lower))) for text, lang, source in rows]
    seen = defaultdict(Counter)
    for lang, _, terms in docs:
        seen[lang].update(set(terms))
    kept = {lang: sorted((t for t, n in own.items() if n >= 3), key=str.encode) for lang, own in seen.items()}
    counts = defaultdict(Counter)
    for lang, source, terms in docs:
        known = set(kept.get(lang, ()))
        for key in ((lang, source), lang):
            counts[key].update(t for t in terms if t in known)
    share = {}
    for key, own in counts.items():
        terms = kept.get(key if isinstance(key, str) else key[0], [])
        share[key] = {t: 1 + 10**9 * (own[t] + 1) // (own.total() + len(terms)) for t in terms}
    out = []
    for lang, source in [k for k in counts if not isinstance(k, str)]:
        p, q = share[lang, source], share[lang]
        pairs = [(sum((p[t] - o[t]) ** 2 // o[t] for t in p), k[1]) for k, o in share.items() if not isinstance(k, str) and k[0] == lang and k[1] != source]
        terms = [((p[t] - q[t]) ** 2 // q[t], t) for t in p if counts[lang, source][t] > 0 and p[t] > q[t]]
        for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, 200)):
            ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
            out += [(lang, source, part, item, value, i + 1) for i, (value, item) in enumerate(ranked)]
    return sorted(out)


def test_divergence_over_awkward_rows(docs, no_docs, spark):
    more = [("", "tr", "x"), (None, "tr", "y"), ("Zwei zwei ZWEI ÄÖ äö", "de", ""), ("zwei ÄÖ Äö", "de", None), ("zwei\x00äö_Äö", "de", "a")]
    rows = [(r.text, r.lang, r.source) for r in docs.collect()] + more
    df = docs.select("text", "lang", "source", "words", "block").unionByName(
        spark.createDataFrame([(*m, "w", 1) for m in more], "text string, lang string, source string, words string, block int")
    )
    got = divergence(df)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == divergence_by_hand(rows)
    assert divergence(no_docs).collect() == []


def test_divergence_in_many_shards_and_blocks(docs, monkeypatch):
    for name, value in (("SHARD_TERMS", 7), ("LEAST_TERMS", 5), ("MOST_TERMS", 5), ("BLOCK_BYTES", 500), ("TOP", 3)):
        monkeypatch.setattr(div, name, value)
    got = sorted(map(tuple, divergence(docs).collect()))
    whole = divergence_by_hand([(r.text, r.lang, r.source) for r in docs.collect()])
    assert got == [r for r in whole if r[2] == "pair" or r[5] <= 3]


def test_shares_of_large_counts_are_exact():
    counts, total = np.array([[3, 20_000_000_000]]), np.array([[30_000_000_000]])
    assert div.scaled(counts, total).tolist() == [[1 + 10**9 * (int(c) + 1) // 30_000_000_000 for c in counts[0]]]


# --- Conversation prefix trie

CONV = "conv_id bigint, turn bigint, role string, text string, depth int, words string"


def trie_by_hand(rows):
    given = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            given[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in given.items()}
    built = {}
    for c, said in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + said[h:]
    nodes, kids = defaultdict(list), defaultdict(int)
    for c, said in built.items():
        for d in range(len(said) + 1):
            nodes[tuple(said[:d])].append(c)
    for said in nodes:
        if said:
            kids[said[:-1]] += 1
    saved, leaves = defaultdict(int), defaultdict(int)
    for said, members in nodes.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", said[-1][1])) if said else 0
        for d in range(len(said) + 1):
            saved[said[:d]] += (len(members) - 1) * words
            leaves[said[:d]] += said not in kids
    out = []
    for said, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(built[c]) == len(said))
        parent = min(nodes[said[:-1]]) if said else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(members), len(said), parent, len(members), kids[said] if said in kids else 0, leaves[said], saved[said], digest))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def talks(spark):
    rng = random.Random(5)
    rows = []
    for c in [*range(60), -1, -7, -20, -23, 999_999_999_999, 10**18]:
        for t in range(rng.randint(1, 7)):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["one two", "x", "", "\x0bwide　space \n"])))
    rows += [(200, t, "user", f"turn {t % 3}") for t in range(300)] + [(201, t, "user", f"turn {t % 3}") for t in range(300)]
    rows += [(c, 0, None, None) for c in range(300, 330)]  # most of them turnless when rebuilt
    rows += [(400, None, "user", "null turn"), (400, 1, "user", "b"), (400, 1, "user", "a"), (400, 1, "user", "a"), (400, None, None, "z")]
    rows += [(None, 0, "user", "no id"), (None, None, None, None)]
    return spark.createDataFrame([(*r, 1, "w") for r in rows], CONV).repartition(3)


def test_trie(talks, spark, monkeypatch):
    wanted = trie_by_hand([tuple(r)[:4] for r in talks.collect()])
    got = trie.prefix_trie(talks)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == wanted
    # Sums and digests over many chunks of a conversation and of a node.
    monkeypatch.setattr(trie, "CHUNK", 7)
    assert sorted(map(tuple, trie.prefix_trie(talks).collect()), key=str) == wanted
    assert trie.prefix_trie(spark.createDataFrame([], CONV)).collect() == []


def test_collisions_are_seen_and_the_work_repeated(talks, monkeypatch):
    wanted = trie_by_hand([tuple(r)[:4] for r in talks.collect()])
    real, weak = trie.bases, [1, 1, 1, 1]
    asked = []

    def some(seed):
        # Base 1 forgets the order of turns, so equal sums of different sequences collide.
        asked.append(seed)
        return weak if seed == 0 else real(seed)

    monkeypatch.setattr(trie, "bases", some)
    assert sorted(map(tuple, trie.prefix_trie(talks).collect()), key=str) == wanted
    assert max(asked) == 1
