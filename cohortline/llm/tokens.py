"""Token ids of whole texts, for a byte-level tokenizer file of the ``tokenizers`` library.

Such a tokenizer cuts a text before every space that a visible character follows, whatever stands
around, and between a letter and a sign, so the parts between such places can be encoded apart. Parts repeat: a block's texts are cut and coded by a dictionary in
Arrow, only its distinct parts are looked up among those the worker has seen, up to a bound, and the ids are gathered
by their places. Texts that hold a special token's string, which is that token, or the mark that parts the parts, are encoded whole.
The ids are those that the library gives for the whole text.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import gather, list_bounds

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
#: Parts that a worker remembers, in two generations, and the longest part it remembers.
MOST_PARTS = 600_000
LONGEST_PART = 64
#: Parts encoded in one call.
TOGETHER = 500
#: Stands before each part but the first of a text.
MARK = "\x00"
#: A space before a visible character: the place to cut.
CUT = (
    r" ([^\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}])"
)
#: A letter and a sign that ends its word, another place to cut; letters up to U+00FF, whatever Unicode version is in use.
SIGN = r"([A-Za-zÀ-ÖØ-öø-ÿ])([.,;:!?)\]\x22])"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class PartEncoder:
    """Unsigned 32-bit ids of texts."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        # One character of a byte-level token stands for one byte of the text.
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.bytes_of[i] = len(token)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode_column(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, each text's followed by ``end``, and the n + 1 bounds of the texts among them."""
        whole = pc.match_substring(texts, MARK)
        for token in self.special:
            whole = pc.or_(whole, pc.match_substring(texts, token))
        odd = np.flatnonzero(whole.to_numpy(zero_copy_only=False))
        plain = pc.if_else(whole, "", texts) if len(odd) else texts
        marked = pc.replace_substring_regex(pc.replace_substring_regex(plain, CUT, MARK + r" \1"), SIGN, rf"\1{MARK}\2")
        lists = pc.split_pattern(marked, MARK)
        bounds = list_bounds(lists)
        coded = lists.flatten().dictionary_encode()
        parts = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        order = coded.indices.to_numpy()
        ids = self.ids_of(parts)
        if len(odd):
            # A whole text is one part, in the place of the empty one that it left.
            order = order.copy()
            order[bounds[odd]] = len(ids) + np.arange(len(odd))
            found = self.tokenizer.encode_batch_fast(texts.take(pa.array(odd)).to_pylist(), add_special_tokens=False)
            ids += [np.array(e.ids, "<u4").tobytes() for e in found]
        if end is not None:
            order = np.insert(order, bounds[1:], len(ids))
            bounds = bounds + np.arange(len(bounds))
            ids.append(np.array([end], "<u4").tobytes())
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat, ends = gather(np.frombuffer(b"".join(ids), "<u4"), np.cumsum(lengths) - lengths, lengths, order)
        return flat, np.concatenate(([0], ends))[bounds]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian ids of each text, given as UTF-8."""
        flat, bounds = self.encode_column(pa.array(texts, pa.binary()).cast(pa.string()))
        data = flat.tobytes()
        return [data[4 * a : 4 * b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]

    def ids_of(self, parts: list[str]) -> list[bytes]:
        """The ids of distinct parts, most of them remembered."""
        if len(self.known) > MOST_PARTS // 2:
            # Parts that come again move to the new generation; the others are forgotten with the old one.
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        fresh = [p for p in parts if p not in known]
        known.update((p, older[p]) for p in fresh if p in older)
        new = [p for p in fresh if p not in older]
        self.learn([p for p in new if p[:1] == " "])
        heads = [p for p in new if p[:1] != " "]
        for p, e in zip(heads, self.tokenizer.encode_batch_fast(heads, add_special_tokens=False)):
            known[p] = np.array(e.ids, "<u4").tobytes()
        ids = list(map(known.__getitem__, parts))
        for p in fresh:
            if len(p) > LONGEST_PART:
                del known[p]
        return ids

    def learn(self, fresh: list[str]) -> None:
        """The ids of parts that begin with a space; many are encoded in one call and told apart by the bytes of their tokens."""
        groups = [fresh[i : i + TOGETHER] for i in range(0, len(fresh), TOGETHER)]
        for group, e in zip(groups, self.tokenizer.encode_batch_fast(["".join(g) for g in groups], add_special_tokens=False)):
            ids = np.array(e.ids, "<u4")
            ends = np.cumsum(self.bytes_of[ids])
            stops = (np.searchsorted(ends, np.cumsum([len(p.encode()) for p in group])) + 1) * 4
            data, start = ids.tobytes(), 0
            for p, stop in zip(group, stops.tolist()):
                self.known[p] = data[start:stop]
                start = stop


@lru_cache(maxsize=2)
def encoder(path: str) -> PartEncoder:
    """One encoder a worker process and file."""
    return PartEncoder(path)


def cut_lengths(n: int, most: int) -> list[int]:
    """Lengths of the pieces of a document of ``n`` tokens: all ``most`` but the first, which may be shorter."""
    first = n % most
    return ([first] if first else []) + [most] * (n // most)


def cut_pieces(bounds: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, piece, start and length of every piece of documents with these bounds, as ``cut_lengths`` has them."""
    n = np.diff(bounds)
    pieces = -(-n // most)
    doc = np.repeat(np.arange(len(n)), pieces)
    piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first = (n - (pieces - 1) * most)[doc]
    start = np.where(piece == 0, 0, first + (piece - 1) * most)
    return doc, piece, start, np.where(piece == 0, first, most)
