"""Sharding by a hierarchical weighted hash tree (DataFrame functions only).

Shards hang in racks, racks in regions; a node weighs what its shards weigh together. A document
goes down the tree: at every level each child of the node that it has reached draws an exponential
ticket -ln(u) / weight from a hash of (doc_id, child), and the least ticket wins. A child wins with
probability weight / weight of its node, whatever hangs below it, and a document hashes the
children along its own way only (regions, the racks of one, the shards of one), not every shard.

The least ticket over the regions is exponential with the weight of the whole tree. What comes on top
of the tree -- a shard beyond the first ``SHARDS``, a shard's weight beyond 1 -- draws one ticket
with the added weight against that minimum: if it is smaller the document moves to that shard, else
it stays where it is. So added weight takes its share of the documents from all other shards alike,
and no document moves but into the shard, and so the rack and region, whose weight has grown (law ``key``).

``slot`` numbers the rows of a shard from 0 without gaps. Rows are counted per cell (shard,
hash of the row) and numbered within their cell, so no shard is gathered in one task.

Defined cases: null doc_id: hashed as its own key; null text: no bytes (size 8, CRC of the
empty text); texts of any length: only size and CRC are taken; repeated rows: same shard, slots of
their own; equal tickets: the child with the smaller number; empty input: empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorlake.llm.common import pinned, table, text_bytes

REGIONS, RACKS = 2, 3   # shard i hangs in region i mod 2, rack (i div 2) mod 3
SHARDS = 24
CELLS = 256             # cells of a shard whose rows are numbered on their own
ROW_OVERHEAD = 8        # bytes of a row besides its text


@dataclass(frozen=True)
class Tree:
    """region -> rack -> shard -> weight, and what was added on top: (shard, weight)."""
    nodes: dict[int, dict[int, dict[int, float]]]
    added: tuple[tuple[int, float], ...] = ()


def tree(n_shards: int, weights: dict[int, float] | None = None) -> Tree:
    """``n_shards`` shards of weight 1 or as ``weights`` say."""
    weight = {i: (weights or {}).get(i, 1.0) for i in range(n_shards)}
    nodes: dict[int, dict[int, dict[int, float]]] = {}
    for i in range(min(n_shards, SHARDS)):
        nodes.setdefault(i % REGIONS, {}).setdefault((i // REGIONS) % RACKS, {})[i] = min(weight[i], 1.0)
    more = [(i, w if i >= SHARDS else w - 1.0) for i, w in weight.items()]
    return Tree(nodes, tuple((i, w) for i, w in more if w > 0))


def _ticket(key: Column, node: str, weight: float) -> Column:
    """An exponential draw with rate ``weight`` from a hash of the document and a node's path."""
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(node)), 11)
    return -F.log((bits.cast("double") + 0.5) / float(1 << 53)) / weight


def _least(drawn: list[Column]) -> Column:
    return F.least(*drawn) if len(drawn) > 1 else drawn[0]


def _draw(key: Column, path: str, children: dict[int, float]) -> Column:
    """(ticket, child) of the child of a node whose ticket is least."""
    return _least([F.struct(_ticket(key, f"{path}{c}", w).alias("ticket"), F.lit(c).alias("child")) for c, w in children.items()])


def _below(child: Column, ways: dict[int, Column]) -> Column:
    """What is below the child that was reached; only that branch is computed."""
    *some, (_, out) = ways.items()
    for number, way in reversed(some):
        out = F.when(child == number, way).otherwise(out)
    return out


def shard_of(key: Column, placed: Tree) -> Column:
    """The shard that the descent reaches for ``key``, or the one added since that draws a smaller ticket."""
    weight = {g: {r: sum(shards.values()) for r, shards in racks.items()} for g, racks in placed.nodes.items()}
    region = _draw(key, "", {g: sum(racks.values()) for g, racks in weight.items()})
    shard = _below(region["child"], {g: _below(_draw(key, f"{g}/", weight[g])["child"],
                                               {r: _draw(key, f"{g}/{r}/", shards)["child"] for r, shards in racks.items()})
                                     for g, racks in placed.nodes.items()})
    added = [F.struct(_ticket(key, f"+{i}", w).alias("ticket"), F.lit(i).alias("shard")) for i, w in placed.added]
    return _least([F.struct(region["ticket"].alias("ticket"), shard.alias("shard")), *added])["shard"]


def assign(docs: DataFrame, n_shards: int = SHARDS, weights: dict[int, float] | None = None) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot, grown_shard."""
    key = F.col("doc_id").cast("string")
    rows = pinned(docs.select(
        "doc_id", (text_bytes(F.col("text")) + ROW_OVERHEAD).alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        shard_of(key, tree(n_shards, weights)).alias("shard"),
        shard_of(key, tree(n_shards + 1, weights)).alias("grown_shard"))
        .withColumn("_cell", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(CELLS)).cast("int")))
    before = Window.partitionBy("shard").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("shard", "_cell").agg(F.count("*").alias("_n")).select(
        "shard", "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    in_cell = Window.partitionBy("shard", "_cell").orderBy("doc_id", "text_crc32", "size")
    return (rows.withColumn("_i", F.row_number().over(in_cell)).join(offsets, ["shard", "_cell"])
            .select("doc_id", "size", "text_crc32", "shard",
                    (F.col("_offset") + F.col("_i") - 1).alias("slot"), "grown_shard"))


def place(docs: DataFrame, n_shards: int = SHARDS, weights: dict[int, float] | None = None, column: str = "shard") -> DataFrame:
    """``docs`` with the shard of each row as ``column`` (no shuffle); a column of that name is replaced."""
    return docs.withColumn(column, shard_of(F.col("doc_id").cast("string"), tree(n_shards, weights)))


def op5_shard(spark, sf_dir):
    """Shard and slot of every document, and its shard among one more."""
    return assign(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
