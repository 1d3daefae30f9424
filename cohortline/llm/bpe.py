"""BPE encoding and decoding with a pair occurrence index (operator 11).

For a word tokenizer file of the ``tokenizers`` library: BPE with an end-of-word suffix, white space dropped between
words, no decoder. A block's texts are cut at ASCII white space, where no word, normal form or special token of such a
file can reach across; the library's own normaliser and splitter make the words of each distinct part. The words not
met before are merged together: all their symbols lie in one array, an index maps every pair that has a rank to all
its positions, the active ranks are applied in ascending order at all positions at once, and the lists of the pairs
that a merge makes beside it are extended. A position that an earlier merge changed is dropped when its rank comes.
Ascending order gives the library's ids since a merge's parts are made by lower ranks; other files are refused.

A block is bounded, whatever a partition holds; parts are remembered up to a bound. Decoding joins the tokens by a space,
as the library does without a decoder. Null and empty texts have no ids and decode to the empty text. Special tokens in
a text are special. Very long texts are one block each; a part of any length is encoded whole. Repeated
rows are encoded each for itself. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import blocks_of, gather, id_and_text, list_bounds, text_sizes
from .tokens import tokenizer_path

TOKENIZER = "word_bpe_49k.json"
BLOCK_BYTES = 4 << 20
#: Bytes of ids that are decoded at once; a text takes about twice as many, and its places sixteen times.
BLOCK_IDS = 1 << 20
#: Parts that a worker remembers, in two generations, and the longest of them in characters.
MOST_PARTS = 200_000
LONGEST_PART = 64
#: Parts split into words in one call.
TOGETHER = 1000
#: The pattern by which the file splits words, fixed value, and what it means for lower-case text up to U+00FF.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NARROW = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼½¾]|[^\t-\r \x85\xa0a-zªµºß-öø-ÿ0-9²³¹¼½¾]+")
WIDE = re.compile("[^\x00-\xff]")


class PairIndex:
    """All positions of every mergeable pair in an array of symbols, where -1 parts the words."""

    def __init__(self, symbols: np.ndarray, keys: np.ndarray, ranks: np.ndarray, made: np.ndarray):
        """``keys``: the pairs left << 32 | right in ascending order, with their ``ranks``; ``made`` by rank."""
        self.symbols = symbols
        self.keys, self.ranks, self.made = keys, ranks, made
        n = len(symbols)
        self.after = np.arange(1, n + 1)
        self.before = np.arange(-1, n - 1)
        self.places: dict[int, list[np.ndarray]] = defaultdict(list)
        self.active: list[int] = []
        self.add(np.arange(max(0, n - 1)))

    def add(self, left: np.ndarray) -> None:
        """Enter the pairs that begin at ``left`` into the lists of their ranks."""
        first, second = self.symbols[left], self.symbols[self.after[left]]
        key = first << 32 | second
        key[(first < 0) | (second < 0)] = -1
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        known = self.keys[at] == key
        rank, left = self.ranks[at[known]], left[known]
        if not len(rank):
            return
        order = np.argsort(rank, kind="stable")
        rank, left = rank[order], left[order]
        starts = np.flatnonzero(np.concatenate(([True], rank[1:] != rank[:-1])))
        for r, own in zip(rank[starts].tolist(), np.split(left, starts[1:])):
            if r not in self.places:
                heapq.heappush(self.active, r)
            self.places[r].append(own)

    def merge(self, pair_of: np.ndarray) -> np.ndarray:
        """Apply all ranks; the symbols that remain, with the -1 between words."""
        symbols, after, before = self.symbols, self.after, self.before
        n = len(symbols)
        while self.active:
            rank = heapq.heappop(self.active)
            lists = self.places.pop(rank)
            left = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            a, b = pair_of[rank]
            right = after[left]
            valid = symbols[left] == a
            valid[valid] = symbols[right[valid]] == b
            left, right = left[valid], right[valid]
            if a == b and len(left) > 1:
                # In a run of one symbol every second pair goes, from the left.
                inside = np.concatenate(([False], right[:-1] == left[1:]))
                begins = np.flatnonzero(~inside)
                turn = np.arange(len(left)) - np.repeat(begins, np.diff(np.append(begins, len(left))))
                left, right = left[turn % 2 == 0], right[turn % 2 == 0]
            if not len(left):
                continue
            follows = after[right]
            symbols[left] = self.made[rank]
            symbols[right] = -2
            after[left] = follows
            before[follows[follows < n]] = left[follows < n]
            beside = np.concatenate((before[left], left[follows < n]))
            self.add(np.unique(beside[beside >= 0]))
        return symbols[symbols != -2]


def byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level file: itself if visible, else one from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return [chr(b) if b in visible else chr(0x100 + hidden.index(b)) for b in range(256)]


class WordEncoder:
    """Ids of texts, for one tokenizer file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        model = data["model"]
        tokenizer = Tokenizer.from_file(path)
        self.normalizer, self.splitter = tokenizer.normalizer, tokenizer.pre_tokenizer
        words = [w for w, _ in self.splitter.pre_tokenize_str("a b")]
        added = data["added_tokens"]
        plain = all(not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]) for t in added)
        if model["type"] != "BPE" or words != ["a", "b"] or data["decoder"] or data["post_processor"] or not plain:
            raise ValueError("this file is no BPE of words parted by white space without a decoder")
        vocabulary = model["vocab"]
        suffix = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in added}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.special_re = re.compile("|".join(map(re.escape, longest_first)) or r"(?!)")
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.pair_of = np.array([[vocabulary[a], vocabulary[b]] for a, b in pairs], np.int64).reshape(-1, 2)
        self.made = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
        self.check_order()
        keys = self.pair_of[:, 0] << 32 | self.pair_of[:, 1]
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        # A word's characters each stand for a byte; the last one takes the suffix.
        self.byte_of, inner, last = {}, np.zeros(256, np.int64), np.zeros(256, np.int64)
        for byte, char in enumerate(byte_characters()):
            self.byte_of[char] = byte
            inner[byte], last[byte] = vocabulary[char], vocabulary[char + suffix]
        self.inner, self.last = inner, last
        # Without wide characters the usual normaliser and pattern are the lower case and NARROW.
        steps = data["normalizer"] and [x["type"] for x in data["normalizer"].get("normalizers", ())]
        patterns = [x.get("pattern") for x in data["pre_tokenizer"].get("pretokenizers", ())]
        self.usual = steps == ["NFC", "Replace", "Lowercase"] and patterns == [{"Regex": SPLIT}, None]
        self.words: dict[bytes, bytes] = {}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def check_order(self) -> None:
        """Refuse a file where a merge uses a token that only a later merge makes."""
        first: dict[int, int] = {}
        for rank, token in enumerate(self.made.tolist()):
            if first.setdefault(token, rank) != rank:
                raise ValueError("two merges make one token")
        for rank, pair in enumerate(self.pair_of.tolist()):
            if any(first.get(x, -1) >= rank for x in pair):
                raise ValueError("a merge comes before one that makes its part")

    def merge_words(self, words: list[bytes]) -> list[bytes]:
        """The ids of words as little-endian unsigned 32-bit, all words merged together."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        data = np.frombuffer(b" ".join([*words, b""]), np.uint8)
        symbols = self.inner[data]
        symbols[ends - 1] = self.last[data[ends - 1]]
        symbols[ends] = -1
        merged = PairIndex(symbols, self.keys, self.ranks, self.made).merge(self.pair_of)
        stops = 4 * np.flatnonzero(merged == -1)
        ids = merged.astype("<u4").tobytes()
        return [ids[a:b] for a, b in zip([0, *(stops[:-1] + 4).tolist()], stops.tolist())]

    def words_of(self, parts: list[str]) -> list[list[bytes]]:
        """The words of each part that holds no special token, as UTF-8."""
        if self.usual:
            out = [None if WIDE.search(p) else [w.encode() for w in NARROW.findall(p.lower())] for p in parts]
            rest = [i for i, own in enumerate(out) if own is None]
        else:
            out, rest = [None] * len(parts), list(range(len(parts)))
        for k in range(0, len(rest), TOGETHER):
            now = rest[k : k + TOGETHER]
            normal = [self.normalizer.normalize_str(parts[i]) if self.normalizer else parts[i] for i in now]
            ends = np.cumsum([len(p) + 1 for p in normal])
            found = self.splitter.pre_tokenize_str(" ".join(normal))
            owner = np.searchsorted(ends, [span[0] for _, span in found], "right").tolist()
            for i in now:
                out[i] = []
            for at, (word, _) in zip(owner, found):
                out[now[at]].append(bytes(map(self.byte_of.__getitem__, word)))
        return out

    def learn(self, parts: list[str]) -> None:
        """Remember the ids of parts."""
        plain, cut = [], {}
        for part in parts:
            if self.special_re.search(part):
                at, pieces = 0, []
                for m in self.special_re.finditer(part):
                    pieces += [part[at : m.start()], self.special[m[0]]]
                    at = m.end()
                cut[part] = [*pieces, part[at:]]
                plain += [x for x in cut[part] if isinstance(x, str)]
            else:
                plain.append(part)
        plain = list(dict.fromkeys(plain))
        words = self.words_of(plain)
        if len(self.words) > MOST_PARTS:
            self.words.clear()
        ids = self.words
        distinct = list({w for own in words for w in own if w not in ids})
        ids.update(zip(distinct, self.merge_words(distinct) if distinct else ()))
        made = {p: b"".join([ids[w] for w in own]) for p, own in zip(plain, words)}
        for w in distinct:
            if len(w) > LONGEST_PART:
                ids.pop(w)
        for part, pieces in cut.items():
            made[part] = b"".join(made[x] if isinstance(x, str) else np.array([x], "<u4").tobytes() for x in pieces)
        self.known.update((p, made[p]) for p in parts)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and the n + 1 bounds of the texts among them."""
        lists = pc.ascii_split_whitespace(texts)
        bounds = list_bounds(lists)
        coded = lists.flatten().dictionary_encode()
        parts = coded.dictionary.to_pylist()
        if len(self.known) > MOST_PARTS // 2:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        fresh = [p for p in parts if p not in known]
        known.update((p, older[p]) for p in fresh if p in older)
        self.learn([p for p in fresh if p not in older])
        ids = list(map(known.__getitem__, parts))
        for p in fresh:
            if len(p) > LONGEST_PART:
                del known[p]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), "<u4")
        out, ends = gather(flat, np.cumsum(lengths) - lengths, lengths, coded.indices.to_numpy())
        return out, np.concatenate(([0], ends))[bounds]


class WordDecoder:
    """Texts of ids, for one tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        tokens = {i: t for t, i in Tokenizer.from_file(path).get_vocab(with_added_tokens=True).items()}
        # Every token with the space that follows it, as UTF-8, in one array.
        written = [f"{tokens[i]} ".encode() if i in tokens else b"" for i in range(max(tokens) + 1)]
        self.written = np.frombuffer(b"".join(written), np.uint8)
        self.written_n = np.array([len(x) for x in written], np.int64)
        self.written_at = np.cumsum(self.written_n) - self.written_n

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
        """The texts of ids that lie one after another: tokens joined by a space."""
        data, ends = gather(self.written, self.written_at, self.written_n, ids)
        cuts = np.concatenate(([0], ends))[bounds]
        # The space after a text's last token goes.
        keep = np.ones(len(data), bool)
        keep[cuts[1:][np.diff(cuts) > 0] - 1] = False
        sizes = np.diff(cuts) - (np.diff(cuts) > 0)
        offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
        texts = pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(data[keep]))
        return texts.cast(pa.string())


@lru_cache(maxsize=2)
def word_decoder(path: str) -> WordDecoder:
    return WordDecoder(path)


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    """One encoder a worker process and file."""
    return WordEncoder(path)


def encode_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """One row per row: ``doc_id`` and ``ids``, little-endian unsigned 32-bit."""
    path = path or tokenizer_path(TOKENIZER)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_encoder(path).encode
        for block in blocks_of(batches, text_sizes, BLOCK_BYTES):
            ids, bounds = encode(block.column("text"))
            offsets = pa.py_buffer((4 * bounds).astype(np.int32))
            column = pa.BinaryArray.from_buffers(pa.binary(), len(bounds) - 1, [None, offsets, pa.py_buffer(ids)])
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), column], names=["doc_id", "ids"])

    docs = id_and_text(df, id_col, text_col)
    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids binary")


def decode_ids(df: DataFrame, path: str | None = None) -> DataFrame:
    """The rows of ``encode_texts`` with ``decoded``, the text that the library gives for the ids; a null has none."""
    path = path or tokenizer_path(TOKENIZER)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = word_decoder(path).decode
        for block in blocks_of(batches, lambda b: text_sizes(b, "ids"), BLOCK_IDS):
            column = block.column("ids")
            rows = column.fill_null(b"")
            bounds = np.concatenate(([0], np.cumsum(text_sizes(block, "ids"), dtype=np.int64))) // 4
            ids = np.frombuffer(b"".join(rows.to_pylist()), "<u4")
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), column, decode(ids, bounds)], names=["doc_id", "ids", "decoded"]
            )

    kind = df.schema["doc_id"].dataType.simpleString()
    return df.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids binary, decoded string")
