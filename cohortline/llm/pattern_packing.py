"""Pattern packing by non-negative least squares (operator 4).

The whole plan is made on the histogram of piece lengths, which has at most ``most`` entries whatever the
input's size: patterns of up to three lengths that fill a sequence exactly are enumerated, non-negative
least squares fits how often each is used to the histogram, the counts are rounded down to what is
there, and the rest is packed best fit, longest first, also as counts of equal sequences. A piece then only needs its rank among the
pieces of its length, which comes from counts per task; no text and no ids meet in one place.

Null and empty texts are one token (the end). Longer texts than ``most`` are cut losslessly. Repeated rows are
packed each for itself; equal lengths are interchangeable, so ties have no effect on the number of
sequences. An empty table gives no rows. Columns other than the named ones are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.storage import settle
from .common import blocks_of, id_and_text, text_sizes
from .tokens import END_ID, cut_pieces, encoder, tokenizer_path

MOST = 1024
BLOCK_BYTES = 4 << 20
ROUNDS = 400

Plan = list[tuple[tuple[int, ...], int]]


def token_pieces(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    most: int = MOST,
    end_id: int = END_ID,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ``ids`` (little-endian unsigned 32-bit), and its
    place among the pieces of its length in its task (``task``, ``place``). Written once and read back.
    """
    path = path or tokenizer_path()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode_column
        task = TaskContext.get().partitionId()
        seen = np.zeros(most + 1, np.int64)
        for block in blocks_of(batches, text_sizes, BLOCK_BYTES):
            ids, bounds = encode(block.column("text"), end_id)
            doc, piece, start, length = cut_pieces(bounds, most)
            # Each piece's number among those of its length, on from the blocks before.
            order = np.argsort(length, kind="stable")
            counts = np.bincount(length, minlength=most + 1)
            place = np.empty(len(doc), np.int64)
            place[order] = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts - seen, counts)
            seen += counts
            offsets = pa.py_buffer((4 * np.concatenate(([0], np.cumsum(length)))).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("doc_id").take(pa.array(doc)),
                    pa.array(piece.astype(np.int32)),
                    pa.array(start),
                    pa.array(length),
                    pa.BinaryArray.from_buffers(pa.binary(), len(doc), [None, offsets, pa.py_buffer(ids)]),
                    pa.array(np.full(len(doc), task, np.int32)),
                    pa.array(place),
                ],
                names=["doc_id", "piece", "start", "length", "ids", "task", "place"],
            )

    docs = id_and_text(df, id_col, text_col)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids binary, task int, place bigint"
    return settle(docs.mapInArrow(cut, schema))


def patterns(lengths: list[int], most: int) -> np.ndarray:
    """All rows (a, b, c), a >= b >= c >= 0, of given lengths that sum to ``most``; 0 stands for no document."""
    have = np.zeros(most + 1, bool)
    have[lengths] = True
    have[0] = False
    out = []
    if have[most]:
        out.append(np.array([[most, 0, 0]]))
    for a in np.flatnonzero(have):
        b = np.flatnonzero(have[: a + 1])
        c = most - a - b
        ok = (c >= 0) & (c <= b)
        b, c = b[ok], c[ok]
        ok = have[c] | (c == 0)
        out.append(np.stack([np.full(ok.sum(), a), b[ok], c[ok]], 1))
    return np.concatenate(out) if out else np.zeros((0, 3), np.int64)


def fit_counts(rows: np.ndarray, histogram: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """x >= 0 that minimises |A x - h|, A's columns being the patterns: accelerated projected gradient.

    A is kept as three length indices a pattern; entry 0 of the histogram absorbs the empty places.
    """
    if not len(rows):
        return np.zeros(0)
    size = len(histogram)

    def packed(x: np.ndarray) -> np.ndarray:
        out = sum(np.bincount(rows[:, k], x, size) for k in range(rows.shape[1]))
        out[0] = 0
        return out

    # A bound on the largest eigenvalue of A'A: largest column sum times largest row sum.
    step = 1 / (rows.shape[1] * packed(np.ones(len(rows))).max())
    x = y = np.zeros(len(rows))
    t = 1.0
    for _ in range(rounds):
        rest = packed(y) - histogram
        rest[0] = 0
        new = np.maximum(0, y - step * sum(rest[rows[:, k]] for k in range(rows.shape[1])))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def best_fit(left: dict[int, int], most: int) -> Plan:
    """Best-fit-decreasing of counts of lengths; sequences with equal content are one entry with a count."""
    room: dict[int, dict[tuple[int, ...], int]] = defaultdict(dict)
    for length in sorted(left, reverse=True):
        count = left[length]
        while count:
            space = next((r for r in range(length, most) if room[r]), None)
            if space is None:
                per = most // length
                whole, rest = divmod(count, per)
                for n, times in ((per, whole), (rest, 1)):
                    if n and times:
                        kind = (length,) * n
                        room[most - n * length][kind] = room[most - n * length].get(kind, 0) + times
                break
            kind, times = next(iter(room[space].items()))
            used = min(times, count)
            if used == times:
                del room[space][kind]
            else:
                room[space][kind] = times - used
            new = (*kind, length)
            room[space - length][new] = room[space - length].get(new, 0) + used
            count -= used
    return [(kind, times) for kinds in room.values() for kind, times in kinds.items()]


def plan_packing(histogram: dict[int, int], most: int = MOST) -> Plan:
    """Contents of all sequences, as (lengths, how many such sequences)."""
    left = {k: v for k, v in histogram.items() if v > 0}
    rows = patterns(sorted(left), most)
    target = np.zeros(most + 1)
    for length, n in left.items():
        target[length] = n
    counts = fit_counts(rows, target)
    plan: Plan = []
    # The most used first; a count is rounded and then limited by what is left.
    for i in np.argsort(-counts, kind="stable")[: int((counts >= 0.5).sum())].tolist():
        kind = tuple(x for x in rows[i].tolist() if x)
        times = min([round(counts[i]), *(left[x] // kind.count(x) for x in set(kind))])
        if times > 0:
            plan.append((kind, int(times)))
            for x in kind:
                left[x] -= times
    return plan + best_fit({k: v for k, v in left.items() if v}, most)


def slots(plan: Plan) -> np.ndarray:
    """Rows (length, first rank, sequence of that rank, offset), sorted: each holds for the ranks up to the next."""
    next_rank: dict[int, int] = defaultdict(int)
    out, sequence = [], 0
    for kind, times in plan:
        offset = 0
        for length in kind:
            out.append((length, next_rank[length], sequence, offset))
            next_rank[length] += times
            offset += length
        sequence += times
    return np.array(sorted(out), np.int64).reshape(-1, 4)


def place_pieces(pieces: DataFrame, most: int = MOST) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``; other columns pass through."""
    per_task = pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    # One row per length comes to the driver: at most ``most``.
    totals = per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()
    table = slots(plan_packing({r["length"]: r["n"] for r in totals}, most))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = per_task.select("task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = pieces.join(before, ["task", "length"]).withColumn("rank", F.col("before") + F.col("place"))
    kept = [c for c in pieces.columns if c not in ("task", "place")]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Ranks of different lengths never meet: a place in the table is found inside its length.
        starts = {int(x): np.searchsorted(table[:, 0], [x, x + 1]) for x in np.unique(table[:, 0])}
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            row = np.zeros(len(length), np.int64)
            for x in np.unique(length):
                low, high = starts[int(x)]
                mine = length == x
                row[mine] = low + np.searchsorted(table[low:high, 1], rank[mine], "right") - 1
            found = table[row] if len(row) else np.zeros((0, 4), np.int64)
            sequence = found[:, 2] + rank - found[:, 1]
            columns = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence), pa.array(np.ascontiguousarray(found[:, 3]))],
                names=[*kept, "sequence_id", "offset"],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema if f.name in kept)
    return ranked.select(*kept, "rank").mapInArrow(find, f"{fields}, sequence_id bigint, offset bigint")


def pack_patterns(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, most: int = MOST
) -> DataFrame:
    """Pieces with their ids, sequence and offset."""
    return place_pieces(token_pieces(df, id_col, text_col, path, most), most)
