"""Sharding by a hierarchical weighted hash tree, in DataFrame operations only.

A topology is a tree of regions, racks and shards; a shard has a weight, a rack or region weighs what its shards weigh together. A key descends level by level: each
child draws ``-ln(u) / weight`` with u hashed from (key, child), and the least draw wins, so a child gets its weight's share of the keys. Where a weight changes, a draw
changes only for the nodes above it: keys move into a subtree that became heavier or out of one that became lighter, and nowhere else.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..shared import materialise

#: Hexadecimal digits of a draw.
DIGITS = 13
#: Rows of a shard are numbered inside so many buckets by hash, so no task holds a shard.
BUCKETS = 4096
#: So many equal rows at most come out of one array.
RUN = 100_000


@dataclass(frozen=True)
class Shard:
    region: str
    rack: str
    shard: int
    weight: float = 1.0


def topology(shards: int, *, per_rack: int = 2, per_region: int = 4) -> list[Shard]:
    """``shards`` shards of weight 1 in racks of ``per_rack`` and regions of ``per_region``, one after the other.

    A shard that opens a region, such as the ninth, is the only one whose branch changes weight: it takes keys only into itself. One that joins a rack makes its rack and region
    heavier, so keys come into that region, and to any of its shards.
    """
    return [Shard(f"r{k // per_region}", f"k{k // per_rack}", k) for k in range(shards)]


def _draw(key: Column, node: str, weight: float) -> Column:
    """The node's draw for a key: exponential with its weight as rate. Equal draws go by the node's name."""
    u = (F.conv(F.substring(F.md5(F.concat(key, F.lit(f":{node}")).cast("binary")), 1, DIGITS), 16, 10).cast("long").cast("double") + 0.5) / float(16**DIGITS)
    return F.struct((-F.log(u) / F.lit(float(weight))).alias("draw"), F.lit(node).alias("node"))


def _winner(key: Column, weights: dict[str, float]) -> Column:
    draws = [_draw(key, node, w) for node, w in sorted(weights.items()) if w > 0]
    return (F.least(*draws) if len(draws) > 1 else draws[0])["node"]


def _weigh(shards: Sequence[Shard], level: str) -> dict[str, float]:
    out: dict[str, float] = {}
    for s in shards:
        name = str(getattr(s, level))
        out[name] = out.get(name, 0.0) + s.weight
    return out


def place(rows: DataFrame, key: Column, shards: Sequence[Shard], *, column: str = "shard") -> DataFrame:
    """Adds ``column``, the shard that ``key`` (text) descends to. A key meets the children of one region and one rack only, so its draws are as many as the tree is wide at
    each level, not as many as there are shards. The topology stands in the plan; nothing is shuffled or broadcast. Shards of weight 0 take nothing."""
    if not any(s.weight > 0 for s in shards) or any(s.weight < 0 for s in shards):
        raise ValueError("weights must not be negative, and one must be positive")
    if len({s.shard for s in shards}) < len(shards) or len({(s.rack, s.region) for s in shards}) > len({s.rack for s in shards}):
        raise ValueError("a shard or a rack is named twice")

    def descend(among: Sequence[Shard], level: str, below: str) -> Column:
        """For the rows that stand at a node of ``level``: their child at ``below``."""
        out = F.lit(None).cast("string")
        for node in sorted({getattr(s, level) for s in among}):
            inside = [s for s in among if getattr(s, level) == node]
            if any(s.weight > 0 for s in inside):
                out = F.when(F.col(f"_{level}") == node, _winner(key, _weigh(inside, below))).otherwise(out)
        return out

    rows = rows.withColumn("_region", _winner(key, _weigh(shards, "region")))
    rows = rows.withColumn("_rack", descend(shards, "region", "rack"))
    return rows.withColumn(column, descend(shards, "rack", "shard").cast("int")).drop("_region", "_rack")


def key_of(doc_id: Column, text: Column) -> Column:
    """What decides where a row goes: its id; without one, its text."""
    return F.coalesce(doc_id.cast("string"), F.concat(F.lit("t"), F.md5(text.cast("binary"))), F.lit(""))


def assign(docs: DataFrame, shards: Sequence[Shard], grown: Sequence[Shard] | None = None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) of every row of ``docs``.

    ``law`` is ``key``: the id and the topology alone decide, so equal ids share a shard, and rows without an id go by their text. ``size`` is the text's UTF-8 bytes plus 1 (null: 1) and
    ``text_crc32`` theirs (null: 0). ``slot`` numbers a shard's rows without a gap: by bucket of a hash of id and text, then id (null first), size, crc; equal rows are interchangeable
    and numbered together, so neither a shard nor a hot id or text is one task. ``grown_shard`` is the shard under ``grown``, null without it. Other columns are not read; an
    empty table gives no rows.
    """
    blank = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), (F.octet_length(blank) + F.lit(1).cast("long")).cast("long").alias("size"), F.crc32(blank).alias("crc"),
        key_of(F.col(id_col), F.col(text_col)).alias("key"), F.md5(F.concat_ws(":", F.col(id_col).cast("string"), F.md5(blank)).cast("binary")).alias("at"),
    )
    rows = rows.withColumn("bucket", (F.conv(F.substring("at", 1, 8), 16, 10).cast("long") % BUCKETS).cast("int"))
    distinct = rows.groupBy("id", "size", "crc", "key", "at", "bucket").agg(F.count(F.lit(1)).alias("n"))
    placed = place(distinct, F.col("key"), shards)
    placed = placed.withColumn("grown_shard", F.lit(None).cast("int")) if grown is None else place(placed, F.col("key"), grown, column="grown_shard")
    placed = materialise(placed.drop("key"), "shards")
    sums = placed.groupBy("shard", "bucket").agg(F.sum("n").alias("rows"))
    before = F.coalesce(F.sum("rows").over(W.partitionBy("shard").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = sums.select(F.col("shard").alias("s"), F.col("bucket").alias("b"), before.alias("start"))
    inside = W.partitionBy("shard", "bucket").orderBy(F.col("id").asc_nulls_first(), "size", "crc", "at").rowsBetween(W.unboundedPreceding, -1)
    numbered = placed.withColumn("earlier", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(starts, (F.col("shard") == F.col("s")) & (F.col("bucket") == F.col("b")))
    runs = numbered.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / F.lit(RUN)))))
    first = F.col("run") * RUN
    each = runs.withColumn("k", F.explode(F.sequence(first, F.least(first + (RUN - 1), F.col("n") - 1))))
    return each.select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("key").alias("law"), "shard", (F.col("start") + F.col("earlier") + F.col("k")).cast("long").alias("slot"), "grown_shard"
    )


def moved(placed: DataFrame) -> DataFrame:
    """(shard, grown_shard, rows, bytes) of what a grown topology moves, from ``assign`` output."""
    return placed.where("shard <> grown_shard").groupBy("shard", "grown_shard").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"))


#: The same in DuckDB's SQL, for eight shards and a ninth. A crc is folded byte by byte.
ORACLE = r"""
WITH RECURSIVE bits AS (SELECT i AS b, i::BIGINT AS c, 0 AS k FROM range(256) x(i) UNION ALL SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY b) AS crc_table FROM bits WHERE k = 8),
d AS (SELECT doc_id, coalesce(text, '') AS body, coalesce(doc_id::VARCHAR, 't' || md5(text), '') AS key FROM documents),
e AS MATERIALIZED (SELECT doc_id, key, octet_length(encode(body))::BIGINT + 1 AS size, md5(concat_ws(':', doc_id::VARCHAR, md5(body))) AS spot,
        xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(body)), '..'), lambda h: ('0x' || h)::BIGINT)),
            lambda c, x: xor(c >> 8, crc_table[(xor(c, x) & 255) + 1])), 4294967295) AS text_crc32 FROM d, crc),
nodes AS (SELECT s AS shard, s // 4 AS region, s // 2 AS rack FROM range(9) x(s)),
tops AS (SELECT n AS shards, region, count(*)::DOUBLE AS w FROM nodes, (VALUES (8), (9)) v(n) WHERE shard < n GROUP BY ALL),
r AS MATERIALIZED (SELECT DISTINCT key, shards, arg_min(region, -ln((('0x' || substr(md5(key || ':r' || region), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0) / w) OVER (PARTITION BY key, shards) AS region
      FROM (SELECT DISTINCT key FROM e), tops),
racks AS (SELECT n AS shards, region, rack, count(*)::DOUBLE AS w FROM nodes, (VALUES (8), (9)) v(n) WHERE shard < n GROUP BY ALL),
k AS MATERIALIZED (SELECT key, shards, arg_min(rack, -ln((('0x' || substr(md5(key || ':k' || rack), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0) / w) AS rack FROM r JOIN racks USING (shards, region) GROUP BY ALL),
p AS MATERIALIZED (SELECT key, shards, arg_min(shard, -ln((('0x' || substr(md5(key || ':' || shard), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)) AS shard FROM k JOIN nodes USING (rack) WHERE shard < shards GROUP BY ALL)
SELECT doc_id, size, text_crc32, 'key' AS law, a.shard::INT AS shard, b.shard::INT AS grown_shard,
       row_number() OVER (PARTITION BY a.shard ORDER BY ('0x' || substr(spot, 1, 8))::BIGINT % 4096, doc_id NULLS FIRST, size, text_crc32, spot) - 1 AS slot
FROM e JOIN p a ON a.key = e.key AND a.shards = 8 JOIN p b ON b.key = e.key AND b.shards = 9
"""
