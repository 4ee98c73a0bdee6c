"""Sharding by a hierarchical weighted hash tree.

The tree has regions, racks and shards. A row descends it: at each node every child draws
a number from the key and the child's name, exponentially distributed with the child's
weight as rate, and the least one wins. A child thus gets a share in proportion to its
weight, and its draw does not depend on its siblings. Raising a weight moves rows into
that subtree only, lowering it moves rows out of it only; draws below other children stay
as they are.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import text_or_empty
from textmill.operators.indexing import global_index
from textmill.runtime import materialize

BASE_SHARDS = 8
RACKS_PER_REGION = 2
SHARDS_PER_RACK = 2


@dataclass(frozen=True)
class Leaf:
    region: str
    rack: str
    shard: int
    weight: float = 1.0


def topology(shards: int) -> list[Leaf]:
    """Two regions of two racks of two shards, and each further shard as a region of its own.

    A further shard is a new child of the root, so adding it moves rows into it alone.
    """
    if shards < BASE_SHARDS:
        raise ValueError(f"the tree starts with {BASE_SHARDS} shards")
    per_region = RACKS_PER_REGION * SHARDS_PER_RACK
    leaves = [Leaf(f"region{s // per_region}", f"rack{s // SHARDS_PER_RACK}", s) for s in range(BASE_SHARDS)]
    return leaves + [Leaf(f"region-of-{s}", f"rack-of-{s}", s) for s in range(BASE_SHARDS, shards)]


def _draw(key: Column, level: str, children: dict) -> Column:
    """The winning child of one node; `children` maps names to weights."""
    names = sorted(n for n, weight in children.items() if weight > 0)
    if len(names) == 1:
        return F.lit(names[0])

    def score(name) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(F.lit(f"{level}/{name}"), key), 11).cast("double")
        return -F.log((bits + 0.5) / float(1 << 53)) / F.lit(float(children[name]))

    return F.array_min(F.array(*[F.struct(score(n).alias("score"), F.lit(n).alias("name")) for n in names]))["name"]


def _weights(leaves: list[Leaf], name: str) -> dict:
    return {k: sum(x.weight for x in leaves if getattr(x, name) == k) for k in {getattr(x, name) for x in leaves}}


def _descend(node: Column, below: dict) -> Column:
    """The value of `below` for the node that a row has reached; other branches are not evaluated."""
    chosen = reduce(lambda c, name: c.when(node == name, below[name]), sorted(below), F)
    return chosen


def place(df: DataFrame, leaves: list[Leaf], name: str, key: str = "doc_id") -> DataFrame:
    """Add column `name`: the shard of each row's key.

    Rows with the same key share a shard; a null key is a key like others. Shard numbers
    in `leaves` must differ; leaves of weight 0 get nothing.
    """
    leaves = [x for x in leaves if x.weight > 0]
    if not leaves or len({x.shard for x in leaves}) < len(leaves):
        raise ValueError("the tree needs leaves with distinct shards and a weight above 0")
    at = F.col(key)
    racks, shards = {}, {}
    for region in {x.region for x in leaves}:
        racks[region] = _draw(at, "rack", _weights([x for x in leaves if x.region == region], "rack"))
    for rack in {(x.region, x.rack) for x in leaves}:
        own = [x for x in leaves if (x.region, x.rack) == rack]
        shards["/".join(rack)] = _draw(at, "shard", _weights(own, "shard"))
    kept = list(df.columns)
    step = df.withColumn("_llm_region", _draw(at, "region", _weights(leaves, "region")))
    step = step.withColumn("_llm_rack", F.concat_ws("/", "_llm_region", _descend(F.col("_llm_region"), racks)))
    return step.withColumn(name, _descend(F.col("_llm_rack"), shards).cast("int")).select(*kept, name)


def shard_documents(docs: DataFrame, shards: int = BASE_SHARDS, leaves: list[Leaf] | None = None) -> DataFrame:
    """`(doc_id, size, text_crc32, law, shard, slot, grown_shard)`, one row per row of `docs`.

    The law is `key`: doc_id and the tree decide alone. `slot` numbers the rows of a shard
    from 0 in the order of doc_id, null first; rows that repeat a doc_id get neighbouring
    slots in no fixed order. `grown_shard` is the shard with one more in the tree. `size` is the
    number of UTF-8 bytes plus 1; a null text counts as empty. Only doc_id and text are read.
    """
    grown = topology(shards + 1) if leaves is None else None
    text = text_or_empty()
    sized = docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    placed = place(sized, leaves or topology(shards), "shard")
    placed = place(placed, grown, "grown_shard") if grown else placed.withColumn("grown_shard", F.lit(None).cast("int"))
    # Written first: the range sort samples its input and would read the texts twice.
    numbered = global_index(materialize(placed, "shards"), ["shard", "doc_id"], "_llm_at")
    starts = numbered.groupBy("shard").agg(F.min("_llm_at").alias("_llm_start"))  # one row per leaf of the tree
    return numbered.join(F.broadcast(starts), "shard").select(
        "doc_id", "size", "text_crc32", "law", "shard", (F.col("_llm_at") - F.col("_llm_start")).alias("slot"), "grown_shard"
    )
