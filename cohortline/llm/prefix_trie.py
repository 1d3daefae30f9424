"""Prefix trie of rebuilt conversations by composable fingerprints (operator 13).

A conversation's rebuilt form is the head of its base conversation (the first h turns of ``c - c % 20``) followed by its own turns
after the first h. No rebuilt text is made. A run of turns is an element of a monoid: its length and the sum of g(turn) * B^place
modulo a prime, in four lanes; (n, s) o (m, t) = (n + m, s + B^n * t). Prefix sums over the given turns
are all that is needed: the product of a base's head and an own suffix comes from three stored sums by adding, and by shifting the
exponents with B's inverse. So every rebuilt prefix is a row of integers.

Equality is verified, not assumed. A turn is known by a reference, the least (conversation, place) with the same role and
text; turns with equal digests are compared by their whole text. All rows of a prefix group must have the same parent group and the
same reference of their last turn, which makes the sequences equal turn by turn. A collision on either level is never passed on: the
work is repeated with other digests and bases.

Places come from range pieces, sums from chunks of places, subtree sums from sums along each conversation's own prefixes
counted at each node's smallest member: nothing walks the trie level by level, and a conversation with most of the turns is spread. Only the digest
of a node's own conversations is taken in one task, as a stream in constant memory, since SHA-256 is sequential.

Turns without a conversation id take no part. A null turn comes first; ties go by role, then text; repeated rows are turns of their own. Null role and text
are empty. ``%`` keeps the sign of the id. An empty table gives no rows. A conversation may have 2^32 turns. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranks import ordered_position
from ..sources.storage import settle

#: The largest primes below 2^31, one for each lane.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
LANES = range(len(PRIMES))
SPAN = 20
HEADS = 4
WORD = r"[^\x20\x09-\x0D]+"
#: Places of a chunk that is summed in one task.
CHUNK = 4096
SEEDS = 8
NODE = ["depth", "f0", "f1"]


def bases(seed: int) -> list[int]:
    """The base of each lane for a seed."""
    return [int(hashlib.sha256(f"{seed}:{lane}".encode()).hexdigest(), 16) % (PRIMES[lane] - 2) + 2 for lane in LANES]


def power(base: int, prime: int, exponent: Column) -> Column:
    """base ^ exponent modulo a prime, by the exponent's bits."""
    out = F.lit(1).cast("bigint")
    for bit in range(32):
        factor = F.when(exponent.bitwiseAND(F.lit(1 << bit)) != 0, F.lit(pow(base, 1 << bit, prime)))
        out = out * factor.otherwise(F.lit(1)) % prime
    return out


def running(df: DataFrame, group: str, place: str, totals: dict[str, str]) -> DataFrame:
    """Running sums (new column: summed column) along dense places of a group, each chunk in a task of its own."""
    chunked = df.withColumn("chunk", F.expr(f"{place} div {CHUNK}"))
    keys = [group, "chunk"]
    sums = chunked.groupBy(*keys).agg(*[F.sum(c).alias(f"all_{new}") for new, c in totals.items()])
    earlier = Window.partitionBy(group).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*keys, *[F.coalesce(F.sum(f"all_{new}").over(earlier), F.lit(0)).alias(f"before_{new}") for new in totals])
    upto = Window.partitionBy(*keys).orderBy(place).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = chunked.withColumns({new: F.sum(c).over(upto) for new, c in totals.items()})
    both = inside.join(offsets, keys).withColumns({new: F.col(new) + F.col(f"before_{new}") for new in totals})
    return both.select(*df.columns, *totals)


def placed_turns(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """conv_id, position (from 1), role, text."""
    rows = df.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("bigint").alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    return ordered_position(rows, ["conv_id"], ["turn", "role", "text"])


def keyed_turns(placed: DataFrame, seed: int) -> DataFrame | None:
    """conv_id, place, k0, k1 (a digest of role and text), words; none if two different turns share a digest."""
    said = F.concat(F.lit(f"{seed}:"), F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    digest = F.md5(said.cast("binary"))
    keys = {"k0": F.conv(F.substring(digest, 1, 15), 16, 10), "k1": F.conv(F.substring(digest, 17, 15), 16, 10)}
    keyed = placed.withColumns({k: v.cast("bigint") for k, v in keys.items()})
    distinct = keyed.select("k0", "k1", "role", "text").distinct().groupBy("k0", "k1").agg(F.count(F.lit(1)).alias("texts"))
    if not distinct.where(F.col("texts") > 1).isEmpty():
        return None
    words = F.regexp_count("text", F.lit(WORD)).cast("bigint")
    return settle(keyed.select("conv_id", F.col("position").alias("place"), "k0", "k1", words.alias("words")))


def prefix_sums(turns: DataFrame, seed: int) -> DataFrame:
    """Turns with their reference, each lane's term (t) and its sum up to the place (s)."""
    refs = turns.groupBy("k0", "k1").agg(F.min(F.struct("conv_id", "place")).alias("ref"))
    known = turns.join(refs, ["k0", "k1"])
    low = F.lit((1 << 30) - 1)
    values = [F.col("k0").bitwiseAND(low), F.shiftright("k0", 30), F.col("k1").bitwiseAND(low), F.shiftright("k1", 30)]
    place = F.col("place")
    terms = {f"t{i}": (values[i] + 1) * power(bases(seed)[i], PRIMES[i], place) % PRIMES[i] for i in LANES}
    termed = known.select(
        "conv_id", "place", F.col("ref.conv_id").alias("ref_conv"), F.col("ref.place").alias("ref_place"), "words",
        *[c.alias(name) for name, c in terms.items()],
    )
    summed = running(termed, "conv_id", "place", {f"s{i}": f"t{i}" for i in LANES})
    return settle(summed.withColumns({f"s{i}": F.col(f"s{i}") % PRIMES[i] for i in LANES}))


def fingerprint(lanes: list[Column]) -> list[Column]:
    """Two integers of the four lanes."""
    return [F.shiftleft(lanes[0], 31).bitwiseOR(lanes[1]), F.shiftleft(lanes[2], 31).bitwiseOR(lanes[3])]


def rebuilt_prefixes(sums: DataFrame, seed: int) -> DataFrame:
    """One row per rebuilt conversation and depth, the root included: fingerprints of the prefix and of its parent, the last
    turn's reference and words, and ``left``, the turns that follow. Written once."""
    zero = F.lit(0).cast("bigint")
    first = F.struct("place", *[f"s{i}" for i in LANES], *[f"t{i}" for i in LANES], "ref_conv", "ref_place", "words")
    # A head has at most HEADS - 1 turns.
    heads = sums.where(F.col("place") < HEADS).groupBy("conv_id").agg(F.sort_array(F.collect_list(first)).alias("own"))
    convs = sums.groupBy("conv_id").agg(F.max("place").alias("n")).join(heads, "conv_id")
    convs = convs.withColumns({"h": F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS, "base_id": F.col("conv_id") - F.col("conv_id") % SPAN})
    convs = convs.join(heads.select(F.col("conv_id").alias("base_id"), F.col("own").alias("base")), "base_id", "left")
    # Turns taken from the base, and own turns left out.
    convs = convs.withColumn("taken", F.least("h", F.greatest(F.lit(0), F.coalesce(F.size("base"), F.lit(0)))).cast("bigint"))
    convs = convs.withColumn("length", F.col("taken") + F.greatest(zero, F.col("n") - F.col("h")))
    convs = convs.withColumns(
        {f"b{i}": F.coalesce(F.get("base", F.col("taken") - 1)[f"s{i}"], zero) for i in LANES}
        | {f"o{i}": F.coalesce(F.get("own", F.least("h", "n") - 1)[f"s{i}"], zero) for i in LANES}
    )

    def less(lane: int, value: Column, term: Column) -> Column:
        return F.pmod(value - term, F.lit(PRIMES[lane]))

    def row(depth: Column, lanes: list[Column], parents: list[Column], *last: Column) -> list[Column]:
        f, p = fingerprint(lanes), fingerprint(parents)
        names = [F.col("conv_id"), depth.cast("bigint").alias("depth"), f[0].alias("f0"), f[1].alias("f1"), p[0].alias("p0"), p[1].alias("p1")]
        return [*names, *last, (F.col("length") - depth).alias("left")]

    head = convs.select("conv_id", "length", F.explode(F.concat(F.array(F.lit(None).cast(heads.schema["own"].dataType.elementType)), F.slice(F.coalesce("base", "own"), F.lit(1), F.col("taken").cast("int")))).alias("t"))
    turn = F.col("t")
    head_rows = head.select(
        *row(
            F.coalesce(turn["place"], zero),
            [F.coalesce(turn[f"s{i}"], zero) for i in LANES],
            [F.coalesce(less(i, turn[f"s{i}"], turn[f"t{i}"]), zero) for i in LANES],
            turn["ref_conv"].alias("ref_conv"),
            turn["ref_place"].alias("ref_place"),
            F.coalesce(turn["words"], zero).alias("words"),
        )
    )
    wanted = convs.select("conv_id", "h", "taken", "length", *[f"b{i}" for i in LANES], *[f"o{i}" for i in LANES])
    own = sums.join(wanted, "conv_id").where(F.col("place") > F.col("h"))
    shift = F.col("h") - F.col("taken")
    backs = {}
    for i in LANES:
        inverse = pow(bases(seed)[i], -1, PRIMES[i])
        back = F.get(F.array(*[F.lit(pow(inverse, k, PRIMES[i])) for k in range(HEADS)]), shift.cast("int"))
        moved = less(i, F.col(f"s{i}"), F.col(f"o{i}")) * back % PRIMES[i]
        backs |= {f"l{i}": (F.col(f"b{i}") + moved) % PRIMES[i], f"m{i}": F.col(f"t{i}") * back % PRIMES[i]}
    own = own.withColumns(backs)
    own_rows = own.select(
        *row(
            F.col("place") - shift,
            [F.col(f"l{i}") for i in LANES],
            [less(i, F.col(f"l{i}"), F.col(f"m{i}")) for i in LANES],
            F.col("ref_conv"),
            F.col("ref_place"),
            F.col("words"),
        )
    )
    return settle(head_rows.unionByName(own_rows))


def prefix_nodes(prefixes: DataFrame) -> DataFrame | None:
    """One row per prefix group; none if a group's rows do not agree on parent and last turn."""
    same = ["p0", "p1", "ref_conv", "ref_place"]
    grouped = prefixes.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.max("words").alias("words"),
        *[F.min(c).alias(c) for c in same],
        *[F.max(c).alias(f"{c}_max") for c in same],
    )
    nodes = settle(grouped)
    differs = F.lit(False)
    for c in same:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"{c}_max"))
    if not nodes.where(differs).isEmpty():
        return None
    return nodes.select(*NODE, "conv_id", "n_convs", "words", "p0", "p1")


def end_digests(prefixes: DataFrame) -> DataFrame:
    """SHA-256 of the ids of the conversations that end at a node, in numeric order, joined by commas."""
    ends = prefixes.where(F.col("left") == 0).withColumn("part", F.expr(f"conv_id div {CHUNK}"))
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
    parts = ends.groupBy(*NODE, "part").agg(ids.alias("ids"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            out = []
            for *key, ids in zip(*[batch.column(c).to_pylist() for c in (*NODE, "ids")]):
                if key == node:
                    state.update(b"," + ids.encode())
                    continue
                if node is not None:
                    out.append((*node, state.hexdigest()))
                node, state = key, hashlib.sha256(ids.encode())
            yield rows_of(out)
        if node is not None:
            yield rows_of([(*node, state.hexdigest())])

    def rows_of(out: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        columns = [pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays(columns, names=[*NODE, "ends_sha256"])

    ordered = parts.repartition(*NODE).sortWithinPartitions(*NODE, "part").select(*NODE, "ids")
    return ordered.mapInArrow(digest, "depth bigint, f0 bigint, f1 bigint, ends_sha256 string")


def trie(prefixes: DataFrame, nodes: DataFrame) -> DataFrame:
    up = (F.col("depth") - 1).alias("depth")
    children = nodes.where(F.col("depth") > 0).select(up, F.col("p0").alias("f0"), F.col("p1").alias("f1"))
    counted = nodes.join(children.groupBy(*NODE).agg(F.count(F.lit(1)).alias("n_children")), NODE, "left").fillna(0, ["n_children"])
    # A node's own share is carried by its smallest member and summed over that conversation's shorter prefixes.
    least = counted.select(*NODE, F.col("conv_id").alias("least"), ((F.col("n_convs") - 1) * F.col("words")).alias("own"), (F.col("n_children") == 0).cast("bigint").alias("leaf"))
    mine = F.col("conv_id") == F.col("least")
    shares = prefixes.select(*NODE, "conv_id", "left").join(least, NODE).select(
        *NODE, "conv_id", "left", *[F.when(mine, F.col(c)).otherwise(F.lit(0)).cast("bigint").alias(c) for c in ("own", "leaf")]
    )
    below = running(shares, "conv_id", "left", {"saved_tokens": "own", "n_leaves": "leaf"})
    sums = below.groupBy(*NODE).agg(F.sum("saved_tokens").alias("saved_tokens"), F.sum("n_leaves").alias("n_leaves"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("f0").alias("p0"), F.col("f1").alias("p1"), F.col("conv_id").alias("parent_conv_id"))
    out = counted.join(sums, NODE).join(end_digests(prefixes), NODE, "left").join(parents, ["depth", "p0", "p1"], "left")
    none = hashlib.sha256(b"").hexdigest()
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256")
    )


def prefix_trie(
    df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations."""
    placed = placed_turns(df, conv_col, turn_col, role_col, text_col)
    for seed in range(SEEDS):
        turns = keyed_turns(placed, seed)
        if turns is None:
            continue
        prefixes = rebuilt_prefixes(prefix_sums(turns, seed), seed)
        nodes = prefix_nodes(prefixes)
        if nodes is not None:
            return trie(prefixes, nodes)
    raise RuntimeError(f"fingerprints collided under {SEEDS} seeds")
