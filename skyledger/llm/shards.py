"""K-d tree sharding: split at distributed weighted medians along the widest metadata dimension.

Rows with equal texts form one unit with the coordinates length, language and source, and the sum of their
bytes as weight. A unit that weighs over a 64th of a shard, in bytes or rows, is cut into pieces by a hash of
the row's id, so no group of copies unbalances a shard; pieces of a unit stay neighbours in every order.
A node of the tree that has to become k shards is split along its widest coordinate where the left side weighs
k//2 k-ths. The place is found by histograms over successive digits of a 60-bit key (coordinate, then hash of
the text), all nodes of a level in one job: the driver sees at most 4,096 sums a node, whatever the input.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from skyledger.llm.common import stored

LAW = "bytes"
OVERHEAD = 8
PIECES = 64
DIGIT_BITS, DIGITS, KEY_BITS, COORD_BITS = 12, 5, 60, 20
ROWS_PER_SLICE = 20_000
DIMS = ("length", "lang", "source")


@dataclass
class Node:
    """Leaves to make of this node; a split node has a dimension, a cut and two parts."""

    leaves: int
    first: int
    dim: str | None = None
    cut: int = 0
    parts: list["Node"] = field(default_factory=list)

    def place(self, value: Callable[["Node"], int]) -> Column:
        """The value of the node that a unit's keys lead to."""
        if not self.parts:
            return F.lit(value(self))
        return F.when(F.col(f"_{self.dim}") < F.lit(self.cut), self.parts[0].place(value)).otherwise(self.parts[1].place(value))


def _code(column: Column) -> Column:
    """A place of a text on a line of 2^20, equal for equal texts; null first."""
    return F.coalesce(F.shiftright(F.crc32(column.cast("binary")), 32 - COORD_BITS), F.lit(0)).cast("bigint")


def measured(docs: DataFrame, text: str = "text", id_column: str = "doc_id", lang: str = "lang", source: str = "source") -> DataFrame:
    """Id, size and checksums of each row, and what places it; the text itself goes no further."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(id_column).alias("doc_id"),
        (F.octet_length(body) + F.lit(OVERHEAD)).cast("bigint").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.xxhash64(body).alias("_text"),
        _code(F.col(lang)).alias("_lang"),
        _code(F.col(source)).alias("_source"),
    )


def units(rows: DataFrame, shards: int) -> tuple[DataFrame, DataFrame]:
    """Rows with their piece, and one row per unit with its keys and weight."""
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), F.count("*").alias("rows")).head()
    size_limit, row_limit = max(1.0, total["bytes"] / (shards * PIECES)), max(1.0, total["rows"] / (shards * PIECES))
    parts = F.ceil(F.greatest(F.col("_bytes") / F.lit(size_limit), F.col("_rows") / F.lit(row_limit)))
    # at most shards * PIECES groups pass either limit, so the broadcast has a bound
    heavy = (
        rows.groupBy("_text").agg(F.sum("size").alias("_bytes"), F.count("*").alias("_rows"))
        .where((F.col("_bytes") > size_limit) | (F.col("_rows") > row_limit))
        .select("_text", parts.cast("bigint").alias("_parts"))
    )
    placed = rows.join(F.broadcast(heavy), "_text", "left").withColumn(
        "_piece", F.coalesce(F.pmod(F.xxhash64("doc_id"), F.col("_parts")), F.lit(0)).cast("int")
    ).drop("_parts")
    tie = F.shiftleft(F.shiftrightunsigned(F.col("_text"), 34), 10) + F.pmod("_piece", F.lit(1024))
    length = F.floor(F.log2(F.col("_one")) * F.lit(1 << 15)).cast("bigint")
    key = {"length": length, "lang": F.col("_lang"), "source": F.col("_source")}
    made = placed.groupBy("_text", "_piece").agg(
        F.sum("size").alias("_weight"), F.min("size").alias("_one"), F.min("_lang").alias("_lang"), F.min("_source").alias("_source")
    ).select(
        "_text", "_piece", "_weight",
        *[(F.shiftleft(F.least(key[d], F.lit((1 << COORD_BITS) - 1)), KEY_BITS - COORD_BITS) + tie).alias(f"_{d}") for d in DIMS],
    )
    return placed, made


def build(made: DataFrame, shards: int) -> Node:
    """The tree, level by level."""
    root = Node(shards, 0)
    level = [root] if shards > 1 else []
    widths: dict[str, int] = {}
    while level:
        order = {id(node): i for i, node in enumerate(level)}
        here = made.withColumn("_node", root.place(lambda node: order.get(id(node), -1))).where("_node >= 0")
        spans = here.groupBy("_node").agg(
            F.sum("_weight").alias("w"),
            *[f(F.shiftright(f"_{d}", KEY_BITS - COORD_BITS)).alias(f"{name}_{d}") for d in DIMS for name, f in (("lo", F.min), ("hi", F.max))],
        ).collect()
        found = {row["_node"]: row for row in spans}
        if not widths and found:
            widths = {d: max(1, found[0][f"hi_{d}"] - found[0][f"lo_{d}"]) for d in DIMS}
        goals = {}
        for i, node in enumerate(level):
            row = found.get(i)
            wide = {d: (row[f"hi_{d}"] - row[f"lo_{d}"]) / widths[d] if row else 0 for d in DIMS}
            node.dim = max(DIMS, key=lambda d: wide[d])
            goals[i] = (row["w"] if row else 0) * (node.leaves // 2) / node.leaves
        cuts = _cuts(here, level, goals)
        below = []
        for i, node in enumerate(level):
            node.cut = cuts[i]
            left = node.leaves // 2
            node.parts = [Node(left, node.first), Node(node.leaves - left, node.first + left)]
            below += [part for part in node.parts if part.leaves > 1]
        level = below
    return root


def _cuts(here: DataFrame, level: list[Node], goals: dict[int, float]) -> dict[int, int]:
    """The key at which each node splits: the weighted median, digit by digit."""
    dims = F.array(*[F.lit(DIMS.index(node.dim)) for node in level])
    keyed = here.select("_node", "_weight", F.get(F.array(*[f"_{d}" for d in DIMS]), F.get(dims, F.col("_node"))).alias("_key"))
    prefix, before, cuts = {i: 0 for i in goals}, {i: 0.0 for i in goals}, {}
    for step in range(DIGITS):
        shift = KEY_BITS - DIGIT_BITS * (step + 1)
        wanted = F.array(*[F.lit(-1 if i in cuts else prefix[i]).cast("bigint") for i in range(len(level))])
        inside = F.shiftright("_key", shift + DIGIT_BITS) == F.get(wanted, F.col("_node"))
        sums: dict[int, list[tuple[int, int]]] = {i: [] for i in goals}
        for row in keyed.where(inside).groupBy("_node", F.shiftright("_key", shift).alias("k")).agg(F.sum("_weight").alias("w")).collect():
            sums[row["_node"]].append((row["k"], row["w"]))
        for i, goal in goals.items():
            if i in cuts:
                continue
            chosen = None
            for k, w in sorted(sums[i]):
                chosen = (k, w)
                if before[i] + w >= goal:
                    break
                before[i] += w
            if chosen is None:
                cuts[i] = 0
                continue
            k, w = chosen
            near = goal - before[i] <= before[i] + w - goal
            if step == DIGITS - 1 or w <= goal / 500 or before[i] == goal:
                cuts[i] = (k if near else k + 1) << shift
            prefix[i] = k
        if len(cuts) == len(goals):
            break
    return cuts


def shard(docs: DataFrame, shards: int = 24, text: str = "text", id_column: str = "doc_id", lang: str = "lang", source: str = "source") -> DataFrame:
    """Every row with its shard and its place there: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    A null text has no bytes and the place of an empty one; null id, language or source are values like any
    other; repeated rows are separate rows of one unit. An empty table gives an empty result. Other columns
    of ``docs`` are not read. Places are gapless from 0 in each shard; they are counted in slices of a shard,
    so no task ranks a whole shard.
    """
    rows = stored(measured(docs, text, id_column, lang, source), "shard-rows")
    placed, made = units(rows, shards)
    made = stored(made, "shard-units")
    tree = build(made, shards)
    homes = made.select("_text", "_piece", tree.place(lambda leaf: leaf.first).cast("int").alias("shard"))
    n = rows.count()
    slices = max(8, n // (shards * ROWS_PER_SLICE))
    sliced = placed.join(homes, ["_text", "_piece"]).select(
        "doc_id", "size", "text_crc32", "shard", F.pmod(F.xxhash64("doc_id", "_text"), F.lit(slices)).cast("int").alias("_slice")
    )
    sliced = stored(sliced, "shard-sliced")
    counts = sliced.groupBy("shard", "_slice").agg(F.count("*").alias("_n"))
    ahead = Window.partitionBy("shard").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "_slice", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_start"))
    rank = Window.partitionBy("shard", "_slice").orderBy("doc_id", "text_crc32", "size")
    return sliced.withColumn("_rank", F.row_number().over(rank)).join(starts, ["shard", "_slice"]).select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard",
        (F.col("_start") + F.col("_rank") - 1).cast("bigint").alias("slot"), F.lit(None).cast(T.IntegerType()).alias("grown_shard"),
    )
