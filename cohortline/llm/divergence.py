"""Source divergence audit over a minimal transducer vocabulary (operator 12).

A first pass over the texts counts in how many documents of its language each term occurs; the terms in at least
``LEAST_DOCS`` of them are kept and numbered in byte order within their language. The vocabulary is dealt by term into shards of
bounded size, each of which becomes a minimal acyclic transducer that gives the ordinals. A second pass streams the
texts' terms, combined by block and by (language, source), through the transducers: what they accept is counted by
ordinal. Ordinals then carry the audit: blocks of consecutive ordinals of a language hold the counts of all its
sources as one matrix, from which a task takes its part of every pair's sum and its largest terms, ties by ordinal. Terms
become text again only in the result. All arithmetic is in integers.

Null text, language and source are the empty string. Repeated rows are documents of their own. Empty texts have no
terms, but their (language, source) is a group. Without kept terms a language has pairs of value 0 and no terms. Ties go to the
term or source that is less in UTF-8. Very long texts and terms are taken whole. An empty table gives no rows. Other
columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranks import ordered_position
from ..sources.storage import settle
from .common import blocks_of, bound_batches, text_sizes
from .transducer import Transducer

LEAST_DOCS = 3
SCALE = 1_000_000_000
TOP = 200
BLOCK_BYTES = 4 << 20
#: Kept terms and counted rows of a shard of the vocabulary, about.
SHARD_TERMS = 40_000
SHARD_ROWS = 1_000_000
#: Cells of a matrix of sources and terms, and the least and most terms of one.
CELLS = 1 << 21
LEAST_TERMS, MOST_TERMS = 1 << 8, 1 << 14

#: For each byte, itself in lower case if it belongs to a term, else 0.
FOLDED = np.array([b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0 for b in range(256)], np.uint8)


def spans(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column's rows one after another, and the n + 1 bounds of the rows."""
    large = column.cast(pa.large_binary())
    offsets = np.frombuffer(large.buffers()[1], np.int64)[large.offset : large.offset + len(large) + 1]
    data = large.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def terms_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct terms of all texts, and for each occurrence the place of its term and of its text."""
    data, bounds = spans(texts)
    folded = FOLDED[data]
    inside = folded > 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    # A term never reaches from one text into the next.
    firsts = bounds[:-1][np.diff(bounds) > 0]
    begins[firsts] = inside[firsts]
    starts = np.flatnonzero(begins)
    # Where each term starts among the bytes that belong to terms.
    offsets = np.append(np.cumsum(inside, dtype=np.int32)[starts] - 1, np.count_nonzero(inside)) if len(starts) else np.zeros(1)
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(folded[inside])]
    )
    coded = words.dictionary_encode()
    rows = np.searchsorted(bounds, starts, "right") - 1
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), rows


def coded_groups(block: pa.RecordBatch, names: list[str]) -> tuple[pa.RecordBatch, np.ndarray]:
    """The distinct values of the columns in a block, and the number of each row's values."""
    number = np.zeros(block.num_rows, np.int64)
    for name in names:
        coded = block.column(name).dictionary_encode()
        number = number * (len(coded.dictionary) + 1) + coded.indices.to_numpy()
    _, first, codes = np.unique(number, return_index=True, return_inverse=True)
    return block.select(names).take(pa.array(first)), codes


def counted(docs: DataFrame, by: list[str], once_a_text: bool) -> DataFrame:
    """``by``, ``term`` and ``n``: occurrences, or texts with the term, summed over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks_of(batches, text_sizes, BLOCK_BYTES):
            terms, code, row = terms_of(block.column("text"))
            if not len(code):
                continue
            groups, group_of = coded_groups(block, by)
            if once_a_text:
                pairs = np.unique(code * block.num_rows + row)
                code, row = np.divmod(pairs, block.num_rows)
            keys, n = np.unique(group_of[row] * len(terms) + code, return_counts=True)
            group, term = np.divmod(keys, len(terms))
            columns = groups.take(pa.array(group)).columns
            words = terms.take(pa.array(term)).cast(pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*columns, words, pa.array(n)], names=[*by, "term", "n"])

    fields = ", ".join(f"{c} string" for c in by)
    rows = docs.select(*by, "text").mapInArrow(run, f"{fields}, term string, n bigint")
    return rows.groupBy(*by, "term").agg(F.sum("n").alias("n"))


def vocabulary(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """The kept terms of each language with their ordinals from 0: lang, term, ordinal. Written once."""
    kept = counted(docs, ["lang"], True).where(F.col("n") >= least_docs).select("lang", "term")
    return settle(ordered_position(kept, ["lang"], ["term"]).select("lang", "term", (F.col("position") - 1).alias("ordinal")))


def recount(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """How often each kept term occurs in each group: lang, source, ordinal, n. Written once."""
    seen = settle(counted(docs, ["lang", "source"], False))
    # Two numbers size the shards.
    shards = max(1, math.ceil(kept.count() / SHARD_TERMS), math.ceil(seen.count() / SHARD_ROWS))
    shard = F.pmod(F.xxhash64("term"), F.lit(shards)).alias("shard")

    def stream(known: pa.Table, rows: pa.Table) -> pa.Table:
        known = known.combine_chunks().set_column(known.schema.get_field_index("term"), "term", known["term"].cast(pa.binary()))
        known = known.sort_by("term")
        transducer = Transducer(known["term"].to_pylist())
        coded = rows["term"].combine_chunks().dictionary_encode()
        data, bounds = spans(coded.dictionary)
        place = transducer.ordinals(data, bounds[:-1], np.diff(bounds))[coded.indices.to_numpy()]
        mine = place >= 0
        ordinal = known["ordinal"].to_numpy()[place[mine]] if len(known) else place[mine]
        found = rows.filter(pa.array(mine))
        return pa.table([found["lang"], found["source"], pa.array(ordinal), found["n"]], ["lang", "source", "ordinal", "n"])

    left = kept.select("lang", shard, "term", "ordinal").groupBy("lang", "shard")
    right = seen.select("lang", shard, "source", "term", "n").groupBy("lang", "shard")
    return settle(left.cogroup(right).applyInArrow(stream, "lang string, source string, ordinal bigint, n bigint"))


def scaled(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / total), exactly."""
    if not counts.size or int(counts.max()) < (1 << 62) // SCALE:
        return 1 + SCALE * (counts + 1) // total
    exact = 1 + SCALE * (counts.astype(object) + 1) // total.astype(object)
    return exact.astype(np.int64)


def block_terms(sources: int) -> int:
    """Terms of a block whose matrix has about CELLS cells."""
    return max(LEAST_TERMS, min(MOST_TERMS, CELLS // max(1, sources)))


def compared(counts: DataFrame, kept: DataFrame, groups: DataFrame) -> DataFrame:
    """Per block of ordinals: every pair's part of its sum (``other``) and each source's largest terms (``ordinal``)."""
    terms_in = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    words_in = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    known = groups.join(words_in, ["lang", "source"], "left").join(terms_in, ["lang"], "left").fillna(0, ["total", "v"])
    langs = known.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"), F.sum("total").alias("lang_total"))
    size = F.least(F.lit(MOST_TERMS), F.greatest(F.lit(LEAST_TERMS), F.floor(F.lit(CELLS) / F.col("sources")))).cast("bigint")
    sized = langs.withColumn("size", size)
    # One row per source and block, the first block being there without terms too.
    last = F.greatest(F.lit(0), F.floor((F.col("v") - 1) / F.col("size"))).cast("bigint")
    members = known.join(sized, "lang").withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    cells = counts.join(sized.select("lang", "size"), "lang").withColumn("block", F.floor(F.col("ordinal") / F.col("size")).cast("bigint"))

    def compare(cell: pa.Table, member: pa.Table) -> pa.Table:
        member = member.sort_by("source")
        n = len(member)
        names = member["source"].combine_chunks()
        lang, v, size, block, lang_total = (member[c][0].as_py() for c in ("lang", "v", "size", "block", "lang_total"))
        width = max(0, min(size, v - block * size))
        count = np.zeros((n, width), np.int64)
        if len(cell):
            row = pa.compute.index_in(cell["source"].combine_chunks(), names).to_numpy()
            count[row, cell["ordinal"].to_numpy() - block * size] = cell["n"].to_numpy()
        p = scaled(count, (member["total"].to_numpy() + v)[:, None]) if width else count
        q = scaled(count.sum(0), np.array(lang_total + v)) if width else count[:1]
        pair, term = [], []
        for i in range(n):
            gap = p[i] - p
            pair.append((gap * gap // p).sum(1)) if width else pair.append(np.zeros(n, np.int64))
            mine = np.flatnonzero((count[i] > 0) & (p[i] > q)) if width else np.zeros(0, np.int64)
            over = p[i][mine] - q[mine] if width else mine
            value = over * over // q[mine] if width else mine
            best = np.lexsort((mine, -value))[:TOP]
            term.append((mine[best] + block * size, value[best]))
        others = np.array([j for i in range(n) for j in range(n) if i != j], np.int64)
        values = np.array([pair[i][j] for i in range(n) for j in range(n) if i != j], np.int64)
        at = np.concatenate([np.repeat(np.arange(n), n - 1), np.repeat(np.arange(n), [len(x) for x, _ in term])])
        ordinal = np.concatenate([np.full(len(others), -1), *[x for x, _ in term]]).astype(np.int64)
        value = np.concatenate([values, *[x for _, x in term]]).astype(np.int64)
        item = pa.concat_arrays([names.take(pa.array(others)), pa.nulls(len(value) - len(others), pa.string())])
        return pa.table(
            [pa.array([lang] * len(value), pa.string()), names.take(pa.array(at)), item, pa.array(ordinal), pa.array(value)],
            ["lang", "source", "other", "ordinal", "value"],
        )

    left = cells.select("lang", "block", "source", "ordinal", "n").groupBy("lang", "block")
    right = members.select("lang", "block", "source", "total", "v", "size", "lang_total").groupBy("lang", "block")
    made = left.cogroup(right).applyInArrow(compare, "lang string, source string, other string, ordinal bigint, value bigint")
    return settle(made)


def divergence(
    df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_docs: int = LEAST_DOCS
) -> DataFrame:
    """lang, source, part, item, value, rank: how far each source lies from the others and from its language."""
    bound_batches(df.sparkSession)
    named = {"lang": lang_col, "source": source_col, "text": text_col}
    docs = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for n, c in named.items()])
    kept = vocabulary(docs, least_docs)
    counts = recount(docs, kept)
    parts = compared(counts, kept, docs.select("lang", "source").distinct())
    keys = ["lang", "source"]
    pairs = parts.where(F.col("other").isNotNull()).groupBy(*keys, F.col("other").alias("item")).agg(F.sum("value").alias("value"))
    by_value = Window.partitionBy(*keys).orderBy(F.desc("value"), "item")
    pairs = pairs.select(*keys, F.lit("pair").alias("part"), "item", "value", F.row_number().over(by_value).alias("rank"))
    by_ordinal = Window.partitionBy(*keys).orderBy(F.desc("value"), "ordinal")
    best = parts.where(F.col("other").isNull()).withColumn("rank", F.row_number().over(by_ordinal)).where(F.col("rank") <= TOP)
    terms = best.join(kept, ["lang", "ordinal"]).select(*keys, F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")
    return pairs.unionByName(terms)
