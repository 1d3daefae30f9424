"""Best-fit-decreasing packing into written id matrices (operator 5).

Texts become pieces of at most ``most`` tokens as in ``pattern_packing.token_pieces``. Pieces are packed in groups of about ``GROUP_TOKENS``
tokens: longest first, each into the fullest sequence that still holds it, found by a segment tree over the sequences' free room. A
group's last sequences stay partly empty, which costs a sequence or two in a group's thousand.
Every sequence is one row of the written matrix: ``ids`` and ``positions`` (little-endian unsigned 16- or 32-bit, padded to ``most``; positions start
again at 0 with each piece), ``cu_seqlens`` (0 and the end of each piece), and the pieces with their document. One pass, no
shuffle; groups are bounded whatever the input holds.

Null and empty texts are one token (the end). Longer texts than ``most`` are split losslessly. Ties in length keep the order of the input. Repeated rows are packed
each for itself. An empty table writes no rows. Columns other than the named ones are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.storage import scratch_path
from .common import blocks_of, id_and_text, text_sizes
from .tokens import END_ID, cut_pieces, encoder, tokenizer_path

MOST = 1024
GROUP_TOKENS = 1_000_000
BLOCK_BYTES = 4 << 20
PAD_ID = 0
PIECE = ("piece", "start", "offset", "length")


class RoomTree:
    """Sequences by free room, with a segment tree that finds the least room of at least a given size."""

    def __init__(self, most: int):
        self.width = 1 << most.bit_length()
        # A node holds the number of sequences whose room lies below it.
        self.count = [0] * (2 * self.width)
        self.sequences: list[list[int]] = [[] for _ in range(most + 1)]

    def change(self, room: int, by: int) -> None:
        node = room + self.width
        while node:
            self.count[node] += by
            node //= 2

    def add(self, room: int, sequence: int) -> None:
        self.sequences[room].append(sequence)
        self.change(room, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """Remove and return (room, sequence) of the least room >= ``least``."""
        node = least + self.width
        if not self.count[node]:
            # Up until a right neighbour has sequences, then down its leftmost branch.
            while node > 1 and (node % 2 or not self.count[node + 1]):
                node //= 2
            if node <= 1:
                return None
            node += 1
            while node < self.width:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.width
        self.change(room, -1)
        return room, self.sequences[room].pop()


def best_fit_decreasing(lengths: list[int], most: int) -> list[list[int]]:
    """Which pieces each sequence holds, in order."""
    tree, packed = RoomTree(most), []
    for piece in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = tree.take(lengths[piece])
        room, sequence = found or (most, len(packed))
        if found is None:
            packed.append([])
        packed[sequence].append(piece)
        if room > lengths[piece]:
            tree.add(room - lengths[piece], sequence)
    return packed


def write_matrix(
    df: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    most: int = MOST,
    end_id: int = END_ID,
    width: int = 2,
) -> DataFrame:
    """Write the packed rows as Parquet under ``path`` and return them as read back.

    ``width`` is the bytes of an id and position: 2 holds ids below 65,536.
    """
    tokenizer = tokenizer or tokenizer_path()
    kind_of_id = f"<u{width}"
    kind = df.schema[id_col].dataType.simpleString()
    ramp = np.arange(most).astype(kind_of_id).tobytes()
    padding = np.full(most, PAD_ID, kind_of_id).tobytes()
    zeros = bytes(most * width)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode_column
        sequence = TaskContext.get().partitionId() << 32
        held: list[tuple] = []  # (id, piece, start, ids)
        total = 0

        def rows() -> pa.RecordBatch:
            nonlocal sequence, held, total
            made = best_fit_decreasing([len(x[3]) // width for x in held], most)
            ids, positions, ends, docs, numbers = [], [], [], [], []
            for members in made:
                at, own = 0, [0]
                for i in members:
                    doc, piece, start, tokens = held[i]
                    length = len(tokens) // width
                    numbers.append((piece, start, at, length))
                    docs.append(doc)
                    at += length
                    own.append(at)
                ends.append(own)
                rest = most - at
                ids.append(b"".join([*[held[i][3] for i in members], padding[: rest * width]]))
                positions.append(b"".join([*[ramp[: len(held[i][3])] for i in members], zeros[: rest * width]]))
            counts = pa.array(np.concatenate(([0], np.cumsum([len(x) for x in made]))).astype(np.int32))
            fields = [pa.array(x) for x in np.array(numbers, np.int64).reshape(-1, 4).T.copy()]
            pieces = pa.StructArray.from_arrays(fields, names=list(PIECE))
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(sequence, sequence + len(made))),
                    pa.array(ids, pa.binary()),
                    pa.array(positions, pa.binary()),
                    pa.array(ends, pa.list_(pa.int32())),
                    pa.ListArray.from_arrays(counts, pa.array(docs, doc_type)),
                    pa.ListArray.from_arrays(counts, pieces),
                ],
                names=["sequence_id", "ids", "positions", "cu_seqlens", "doc_ids", "pieces"],
            )
            sequence += len(made)
            held, total = [], 0
            return out

        doc_type = pa.null()
        for block in blocks_of(batches, text_sizes, BLOCK_BYTES):
            doc_type = block.schema.field("doc_id").type
            ids, bounds = encode(block.column("text"), end_id)
            if width == 2 and len(ids) and ids.max() > 0xFFFF:
                raise ValueError("an id needs more than 16 bits")
            data = ids.astype(kind_of_id).tobytes()
            names = block.column("doc_id").to_pylist()
            at = 0
            for doc, piece, start, length in zip(*[x.tolist() for x in cut_pieces(bounds, most)]):
                held.append((names[doc], piece, start, data[at * width : (at + length) * width]))
                at += length
                total += length
                if total >= GROUP_TOKENS:
                    yield rows()
        if held:
            yield rows()

    schema = (
        f"sequence_id bigint, ids binary, positions binary, cu_seqlens array<int>, doc_ids array<{kind}>, "
        "pieces array<struct<piece:bigint,start:bigint,offset:bigint,length:bigint>>"
    )
    rows = id_and_text(df, id_col, text_col).mapInArrow(packed, schema)
    # Small row groups: a writer holds one of them, and the ids do not get smaller in larger ones.
    rows.write.option("compression", "zstd").option("parquet.block.size", str(16 << 20)).parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def matrix_pieces(matrix: DataFrame, width: int = 2) -> DataFrame:
    """One row per piece of a written matrix, with its ids and positions cut out by ``cu_seqlens``."""
    numbered = matrix.select("*", F.posexplode("pieces").alias("n", "p"))
    begin, end = F.col("cu_seqlens")[F.col("n")], F.col("cu_seqlens")[F.col("n") + 1]

    def cut(name: str):
        return F.substr(F.col(name), begin * width + 1, (end - begin) * width)

    return numbered.select(
        F.col("doc_ids")[F.col("n")].alias("doc_id"),
        "p.piece",
        "p.start",
        (end - begin).cast("bigint").alias("length"),
        "sequence_id",
        begin.cast("bigint").alias("offset"),
        cut("ids").alias("ids"),
        cut("positions").alias("positions"),
    )


def pack_matrix(df: DataFrame, path: str | None = None, **options) -> DataFrame:
    """The written matrix, in scratch storage that goes with the application unless ``path`` names a folder."""
    return write_matrix(df, path or scratch_path(df.sparkSession, "matrix-"), **options)
