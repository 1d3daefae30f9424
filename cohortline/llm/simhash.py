"""SimHash near-duplicates by pivot distance tables (operator 6).

A fingerprint's distances to reference fingerprints (pivots) are computed once. By the triangle
inequality two fingerprints within r bits differ by at most r in every such distance. The pivots are of
two kinds:

* zero and 32 pivots with two neighbouring bits set. d(x, pair) - d(x, 0) is 2 less twice the bits that x has in
  the pair, so these distances tell a fingerprint's pairs apart. Up to two changed bits touch at most two of four
  groups of eight pairs: the coordinates of the other two groups stay as they are. Each of the six choices
  of two groups is a join key, so no close pair is missed and far pairs hardly meet;
* pseudorandom pivots, whose largest coordinate difference discards candidates before they are verified.

A key shared by more than ``BUCKET`` different fingerprints (a large group of near copies) does not emit its pairs. Its
members go by an exact other way: each is linked to its 64 one-bit neighbours and itself, and two fingerprints
are within two bits exactly if they share one of these; the smallest member of each stands for the rest.

Null and empty texts have fingerprint zero and link like any other. Ties in bit counts leave the bit 0. Equal texts,
repeated rows and repeated ids share one fingerprint and one component. A null id is no component's name unless all
its ids are null. Very long texts are hashed whole. An empty table gives no rows. Columns other
than the named ones are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.storage import settle
from .common import blocks_of, id_and_text, raw, text_sizes

SHINGLE_WORDS = 3
SEED = 42
RADIUS = 2
BLOCK_BYTES = 4 << 20
#: Most different fingerprints of a key that are compared with each other.
BUCKET = 64
N_RANDOM_PIVOTS = 16


def shingle_hashes(data: bytes, words_in: int = SHINGLE_WORDS, seed: int = SEED) -> np.ndarray:
    """XXH64 of every shingle of a text, repeats included; of the whole sequence, if there are fewer words."""
    from xxhash import xxh64_intdigest

    words = data.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - words_in + 1)
    last = ends[words_in - 1 :] if len(words) >= words_in else ends[-1:]
    return np.array(
        [xxh64_intdigest(line[a:b], seed) for a, b in zip(starts[:n].tolist(), last.tolist())], np.uint64
    )


def majority(hashes: np.ndarray) -> int:
    """The 64 bits that are set in over half of the hashes."""
    if not len(hashes):
        return 0
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i : i + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little", signed=True)


def fingerprints(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_in: int = SHINGLE_WORDS, seed: int = SEED
) -> DataFrame:
    """doc_id and the 64-bit fingerprint ``fp`` (as a signed number) of every text."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks_of(batches, text_sizes, BLOCK_BYTES):
            prints = [majority(shingle_hashes(x, words_in, seed)) for x in raw(block)]
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), pa.array(prints, pa.int64())], names=["doc_id", "fp"]
            )

    docs = id_and_text(df, id_col, text_col)
    return docs.mapInArrow(hashed, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp bigint")


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def pair_pivots() -> list[int]:
    """32 pivots with two neighbouring bits set."""
    return [3 << (2 * i) for i in range(32)]


def random_pivots(n: int = N_RANDOM_PIVOTS) -> list[int]:
    rng = np.random.default_rng(SEED)
    return [int(x) for x in rng.integers(0, 1 << 64, n, dtype=np.uint64, endpoint=False)]


def pivot_table(prints: DataFrame) -> DataFrame:
    """Distances of each fingerprint to the pivots: ``d0``, ``groups`` (four arrays of eight), ``far``."""
    fp = F.col("fp")
    to_pair = [distance(fp, F.lit(signed(p))).cast("tinyint") for p in pair_pivots()]
    return prints.select(
        "fp",
        F.bit_count(fp).cast("tinyint").alias("d0"),
        F.array(*[F.array(*to_pair[8 * g : 8 * g + 8]) for g in range(4)]).alias("groups"),
        random_distances(fp).alias("far"),
    )


def random_distances(fp: Column) -> Column:
    """Distances to the pseudorandom pivots."""
    return F.array(*[distance(fp, F.lit(signed(p))).cast("tinyint") for p in random_pivots()])


def keyed(table: DataFrame) -> DataFrame:
    """Six rows per fingerprint: the coordinates of two of the four groups, relative to d0, as ``key``."""
    choices = []
    for n, (a, b) in enumerate(combinations(range(4), 2)):
        # A relative distance is -2, 0 or 2: one ternary digit a pivot.
        code = F.lit(n).cast("bigint")
        for g in (a, b):
            for i in range(8):
                digit = (F.col("groups")[g][i] - F.col("d0")).cast("bigint") + 2
                code = code * 3 + F.shiftright(digit, 1)
        choices.append(code)
    return table.select("fp", "far", F.explode(F.array(*choices)).alias("key"))


def link_small(members: DataFrame, radius: int) -> DataFrame:
    """Pairs within ``radius`` bits among fingerprints that share a key of at most BUCKET members."""
    right = members.select("key", F.col("fp").alias("other"), F.col("far").alias("other_far"))
    widest = F.array_max(F.zip_with("far", "other_far", lambda x, y: F.abs(x - y)))
    return (
        members.join(right, "key")
        .where(F.col("fp") < F.col("other"))
        .where(widest <= radius)
        .where(distance(F.col("fp"), F.col("other")) <= radius)
        .select(F.col("fp").alias("a"), F.col("other").alias("b"))
    )


def link_large(members: DataFrame) -> DataFrame:
    """Links within two bits through shared one-bit neighbours: at most 65 rows a fingerprint, no pairs."""
    flips = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(signed(1 << i))) for i in range(64)])
    near = members.select("fp", F.explode(flips).alias("point"))
    least = near.groupBy("point").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return near.join(least.select("point", "b"), "point").where("fp <> b").select(F.col("fp").alias("a"), "b")


def links(prints: DataFrame) -> DataFrame:
    """Links (a, b) whose components are those of all fingerprints within two bits."""
    entries = settle(keyed(pivot_table(prints)))
    sizes = entries.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    small = entries.join(sizes.where(F.col("n") <= BUCKET).select("key"), "key")
    close = link_small(small, RADIUS)
    large = entries.join(sizes.where(F.col("n") > BUCKET).select("key"), "key").select("fp").distinct()
    return close.unionByName(link_large(large)).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 100) -> DataFrame:
    """``node`` and the smallest node of its component, ``root``, by alternating large and small stars.

    Every round links each node's larger, then its smaller neighbours to its smallest neighbour, and is written to
    shared storage; the rounds grow with the logarithm of the component's size. The fixed point is a star a component.
    """
    pairs = settle(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    )
    before = None
    for _ in range(most_rounds):
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            joined.select("u", F.col("m").alias("v"))
        )
        pairs = settle(small.where("u <> v").distinct())
        now = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
    raise RuntimeError("components did not settle")


def grouped_prints(docs: DataFrame) -> DataFrame:
    """Of rows ``doc_id, fp``: every fingerprint with the ``root`` of its component and the component's smallest id."""
    prints = settle(docs.groupBy("fp").agg(F.min("doc_id").alias("least_id")))
    found = components(links(prints.select("fp")))
    # Only fingerprints with a link: their component's smallest id.
    rooted = prints.join(found, prints["fp"] == found["node"]).select("fp", "root", "least_id")
    roots = found.select(F.col("root").alias("fp")).distinct().join(prints, "fp")
    rooted = rooted.unionByName(roots.select("fp", F.col("fp").alias("root"), "least_id"))
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    linked = rooted.join(least, "root").select("fp", "root", "component_id")
    return prints.join(linked, "fp", "left").select(
        "fp",
        F.coalesce("root", "fp").alias("root"),
        F.when(F.col("root").isNull(), F.col("least_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def near_groups(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_in: int = SHINGLE_WORDS
) -> DataFrame:
    """doc_id, fingerprint (hexadecimal) and component_id of every row."""
    docs = settle(fingerprints(df, id_col, text_col, words_in))
    return docs.join(grouped_prints(docs), "fp", "left").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_in: int = SHINGLE_WORDS
) -> DataFrame:
    """The rows of ``df``, one of each near-duplicate component: that with the smallest id, null ids last; of rows that share this id the
    one whose text has the smaller digest, and of equal rows one.

    The caller's columns travel as one struct, so no name can clash. Texts shuffle once, to the rows that stay.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    named = df.select(F.struct(F.col(id_col).alias("id"), F.md5(text.cast("binary")).alias("digest")).alias("doc_id"), text.alias("text"))
    docs = settle(fingerprints(named, words_in=words_in)).select(F.col("doc_id.id").alias("doc_id"), "doc_id.digest", "fp")
    rooted = docs.join(grouped_prints(docs), "fp")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "digest")).alias("best")
    stays = rooted.groupBy("root").agg(best).select(F.col("best.doc_id").cast("string").alias("id"), F.col("best.digest").alias("digest"))
    rows = df.select(F.col(id_col).cast("string").alias("id"), F.md5(text.cast("binary")).alias("digest"), F.struct("*").alias("row"))
    same = rows["id"].eqNullSafe(stays["id"]) & (rows["digest"] == stays["digest"])
    kept = rows.join(stays, same, "left_semi")
    # Equal rows: each task keeps one before they meet.
    place = F.row_number().over(Window.partitionBy("digest", "id").orderBy(F.lit(0)))
    return kept.withColumn("place", place).where(F.col("place") == 1).select("row.*")
