"""Merkle manifest of a dataset: a hash tree of documents in each source, and one of the sources' roots above them.

Nodes carry nested-interval labels: ``[lo, hi)`` are the leaf ranks that a node covers. An ancestor of a node is one whose interval holds the node's; it is found by an
equi-join on (tree, level, bucket of leaf ranks) with the containment as residual. Siblings are what a parent's interval holds outside a node's own. So a leaf's proof is the
siblings of the ancestors that hold its rank, by level.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..shared import discard, materialise

FAN_OUT = 3
#: Levels of a tree that are built, or attached to a node, in one shuffle: a group holds FAN_OUT ** TIER digests at most.
TIER = 5
#: The columns of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts' text, one after the other."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def encoded(c: Column) -> Column:
    """A value by itself: ``-`` for null, else its UTF-8 length, a colon and the value. No two rows of values share an encoding."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: Sequence[Column]) -> Column:
    return digest(*(encoded(c) for c in columns))


def ranked(rows: DataFrame, order: Sequence[Column], rank: str) -> DataFrame:
    """``rows`` with their rank from 0 in ``order``, a table in the shared folder. Rows are dealt by ranges of the order, numbered inside a range, and ranges by prefix sums
    of their counts, one row a range. Equal rows are told apart by where they were read, so that many of them are many ranges."""
    spread = [*order, F.xxhash64(F.monotonically_increasing_id())]
    dealt = materialise(rows.repartitionByRange(*spread).withColumn("range", F.spark_partition_id()), "merkle-ranges")
    counts = dealt.groupBy("range").count()
    before = F.coalesce(F.sum("count").over(W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("range", before.alias("before"))
    inside = F.row_number().over(W.partitionBy("range").orderBy(*order)) - 1
    numbered = dealt.withColumn("inside", inside).join(starts, "range").withColumn(rank, (F.col("before") + F.col("inside")).cast("long"))
    out = materialise(numbered.drop("range", "inside", "before"), "merkle-ranked")
    discard(dealt)
    return out


def _next(children: Column, fan_out: int) -> Column:
    """Digests of a level -> those of the level above: each run of ``fan_out`` consecutive ones, the last may be shorter."""
    runs = F.sequence(F.lit(0), F.floor((F.size(children) - 1) / F.lit(fan_out)).cast("int"))
    return F.transform(runs, lambda i: F.sha2(F.array_join(F.slice(children, i * fan_out + 1, fan_out), "").cast("binary"), 256))


def forest(leaves: DataFrame, *, fan_out: int = FAN_OUT, tier: int = TIER) -> DataFrame:
    """(tree, n, rank, digest) with ranks 0 to n - 1 in each tree -> all nodes (tree, n, level, lo, hi, digest), a table in the shared folder.

    A level has nodes as long as the level below has several; a tree of one leaf is that leaf. One shuffle builds ``tier`` levels: the digests of ``fan_out ** tier``
    consecutive nodes of a level come together as one array, so no group grows with the data.
    """
    width = fan_out**tier
    level, parts, tops = 0, [], leaves.select("tree", "n", "rank", "digest")
    while not tops.isEmpty():
        block = F.floor(F.col("rank") / width)
        sorted_ = F.transform(F.array_sort(F.collect_list(F.struct("rank", "digest"))), lambda x: x["digest"])
        rows = tops.groupBy("tree", "n", block.alias("block")).agg(sorted_.alias("d0"))
        several = lambda k: F.col("n") > fan_out ** (level + k)  # noqa: E731 - whether level + k has more than one node
        for k in range(1, tier + 1):
            rows = rows.withColumn(f"d{k}", F.when(several(k - 1), _next(F.col(f"d{k - 1}"), fan_out)))
        node = lambda k: lambda d, i: F.struct(F.lit(level + k).alias("level"), (F.col("block") * fan_out ** (tier - k) + i).alias("at"), d.alias("digest"))
        none = F.array().cast("array<struct<level:int,at:bigint,digest:string>>")
        all_ = F.concat(*(F.coalesce(F.transform(f"d{k}", node(k)), none) for k in range(tier + 1)))
        nodes = rows.select("tree", "n", F.explode(all_).alias("x")).select("tree", "n", "x.*")
        span = F.pow(F.lit(fan_out), F.col("level")).cast("long")
        labelled = nodes.select("tree", "n", "level", (F.col("at") * span).alias("lo"), F.least((F.col("at") + 1) * span, "n").alias("hi"), "digest")
        part = materialise(labelled, "merkle-nodes")
        top = level + tier
        # the topmost level of these blocks is the lowest of the next ones
        parts.append(part.where(F.col("level") < top))
        above = part.where(F.col("level") == top)
        alone = above.where(F.col("n") <= fan_out**top)  # a root
        parts.append(alone)
        tops = above.where(F.col("n") > fan_out**top).select("tree", "n", F.floor(F.col("lo") / fan_out**top).alias("rank"), "digest")
        level = top
    out = parts[0] if parts else leaves.select("tree", "n", F.lit(0).alias("level"), F.col("rank").alias("lo"), F.col("rank").alias("hi"), "digest")
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _bucket(rank: Column, level: Column, fan_out: int) -> Column:
    return F.floor(rank / F.pow(F.lit(float(fan_out)), level)).cast("long")


def _holds(outer_lo: str, outer_hi: str, lo: str, hi: str) -> Column:
    return (F.col(outer_lo) <= F.col(lo)) & (F.col(hi) <= F.col(outer_hi))


def siblings(nodes: DataFrame, *, fan_out: int = FAN_OUT) -> DataFrame:
    """(tree, n, level, lo, hi, left, right) of every node below a root: the digests of its parent's other children before and after it.

    A node meets its parent by containment; what the parent's interval holds outside the node's own is its siblings. A parent has ``fan_out`` children at most.
    """
    child = nodes.withColumn("up", F.col("level") + 1).withColumn("b", _bucket(F.col("lo"), F.col("level") + 1, fan_out))
    parent = nodes.where("level > 0").select(F.col("tree").alias("t"), F.col("level").alias("l"), F.col("lo").alias("plo"), F.col("hi").alias("phi"), _bucket(F.col("lo"), F.col("level"), fan_out).alias("pb"))
    met = child.join(parent, (F.col("tree") == F.col("t")) & (F.col("up") == F.col("l")) & (F.col("b") == F.col("pb")) & _holds("plo", "phi", "lo", "hi"))
    runs = met.groupBy("tree", "n", "level", "plo", "phi").agg(F.array_sort(F.collect_list(F.struct("lo", "hi", "digest"))).alias("run"))
    own = runs.withColumn("own", F.explode("run"))
    outside = lambda keep: F.array_join(F.transform(F.filter("run", keep), lambda x: x["digest"]), "")
    return own.select("tree", "n", "level", F.col("own.lo").alias("lo"), F.col("own.hi").alias("hi"), outside(lambda x: x["hi"] <= F.col("own.lo")).alias("left"), outside(lambda x: x["lo"] >= F.col("own.hi")).alias("right"))


def paths(steps: DataFrame, *, top: int, base: int = 0, fan_out: int = FAN_OUT, tier: int = TIER) -> DataFrame:
    """(tree, lo, path) of every node at level ``base``: ``path`` holds (left, right) of the node and its ancestors below the root, from the lowest up.

    ``steps`` is ``siblings`` output, ``top`` its highest level. A node meets its next ``tier`` ancestors by containment, one key a level, and the whole path of the last of them
    afterwards: every tier has a ``fan_out ** tier``-th of the rows of the one below.
    """
    last = min(base + tier, top + 1)
    member = steps.where(F.col("level") == base).select("tree", "lo", "hi", F.explode(F.sequence(F.lit(base), F.lit(last - 1))).alias("up"))
    member = member.withColumn("b", _bucket(F.col("lo"), F.col("up"), fan_out))
    above = steps.where(F.col("level").between(base, last - 1)).select(
        F.col("tree").alias("t"), "level", F.col("lo").alias("alo"), F.col("hi").alias("ahi"), _bucket(F.col("lo"), F.col("level"), fan_out).alias("ab"), "left", "right"
    )
    met = member.join(above, (F.col("tree") == F.col("t")) & (F.col("up") == F.col("level")) & (F.col("b") == F.col("ab")) & _holds("alo", "ahi", "lo", "hi"))
    found = met.groupBy("tree", "lo", "hi").agg(F.array_sort(F.collect_list(F.struct("level", "left", "right"))).alias("path"))
    if last <= top:
        rest = paths(steps, top=top, base=last, fan_out=fan_out, tier=tier).select(F.col("tree").alias("t"), F.col("lo").alias("alo"), F.col("path").alias("rest"))
        reach = F.lit(fan_out**last)
        found = found.join(rest, (F.col("tree") == F.col("t")) & (F.floor(F.col("lo") / reach) * reach == F.col("alo")), "left")
        found = found.withColumn("path", F.concat("path", F.coalesce("rest", F.array().cast("array<struct<level:int,left:string,right:string>>"))))
    return found.select("tree", "lo", "path")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, leaf, lambda d, x: digest(x["left"], d, x["right"]))


def proof_text(path: Column) -> Column:
    """The siblings of a path one after the other, level by level, left to right."""
    return F.array_join(F.transform(path, lambda x: F.concat(x["left"], x["right"])), "")


@dataclass
class Manifest:
    """``leaves`` (key columns, tree, rank, leaf), ``nodes`` of the trees of documents and ``top`` of the tree over their roots; ``trees`` (group, tree, n)."""

    leaves: DataFrame
    trees: DataFrame
    nodes: DataFrame
    top: DataFrame
    fan_out: int

    def root(self) -> str | None:
        """The one digest that stands for the whole table; none for an empty one."""
        found = self.top.where(F.col("hi") - F.col("lo") == F.col("n")).where(F.col("n") <= F.pow(F.lit(float(self.fan_out)), F.col("level"))).select("digest").first()
        return found and found[0]

    def proofs(self) -> DataFrame:
        """``leaves`` with ``subroot``, ``root`` and ``path``, the (left, right) siblings from the leaf to the root."""
        root = self.root()
        none = F.array().cast("array<struct<level:int,left:string,right:string>>")
        up = _all_paths(self.top, self.fan_out).withColumnsRenamed({"tree": "of", "lo": "at", "path": "upper"})
        whole = (F.col("lo") == 0) & (F.col("hi") == F.col("n")) & (F.col("n") <= F.pow(F.lit(float(self.fan_out)), F.col("level")))
        roots = self.nodes.where(whole).select(F.col("tree").alias("r"), F.col("digest").alias("subroot"))
        tops = materialise(roots.join(up, F.col("r") == F.col("at"), "left").select("r", "subroot", F.coalesce("upper", none).alias("upper")), "merkle-tops")
        low = _all_paths(self.nodes, self.fan_out).withColumnsRenamed({"tree": "t", "lo": "l"})
        found = self.leaves.join(low, (F.col("tree") == F.col("t")) & (F.col("rank") == F.col("l")), "left").join(tops, F.col("tree") == F.col("r"))
        return found.withColumn("path", F.concat(F.coalesce("path", none), "upper")).withColumn("root", F.lit(root)).drop("t", "l", "r", "upper")


def _all_paths(nodes: DataFrame, fan_out: int) -> DataFrame:
    steps = materialise(siblings(nodes, fan_out=fan_out), "merkle-siblings")
    top = steps.agg(F.max("level")).first()[0]
    return paths(steps, top=-1 if top is None else top, fan_out=fan_out) if top is not None else steps.selectExpr("tree", "lo", "cast(array() as array<struct<level:int,left:string,right:string>>) as path")


def manifest(leaves: DataFrame, *, group: str, order: Sequence[str], fan_out: int = FAN_OUT) -> Manifest:
    """The hash trees over ``leaves``, which have a ``leaf`` digest, a ``group`` (source) and key columns; in a group leaves ascend by ``order``, nulls first, ties by digest.

    Groups go by their text, null first, bytewise. Equal rows are leaves of their own, next to each other. No group is handled by one task: ranks come from ranges of the whole
    order. Column names of ``leaves`` must not be those of ``Manifest`` tables (tree, n, rank, level, lo, hi, path). An empty table has no nodes and no root.
    """
    by = [F.col(group).asc_nulls_first(), *(F.col(c).asc_nulls_first() for c in order), F.col("leaf").asc()]
    placed = ranked(leaves, by, "place")
    groups = placed.groupBy(group).agg(F.min("place").alias("base"), F.count(F.lit(1)).alias("n"))
    trees = ranked(groups, [F.col(group).asc_nulls_first()], "tree")
    named = trees.select(F.col(group).alias("g"), "tree", "base", "n")
    numbered = placed.join(named, F.col(group).eqNullSafe(F.col("g"))).withColumn("rank", F.col("place") - F.col("base")).drop("g", "base", "place")
    numbered = materialise(numbered, "merkle-leaves")
    nodes = forest(numbered.select("tree", "n", "rank", F.col("leaf").alias("digest")), fan_out=fan_out)
    whole = (F.col("lo") == 0) & (F.col("hi") == F.col("n")) & (F.col("n") <= F.pow(F.lit(float(fan_out)), F.col("level")))
    roots = nodes.where(whole)
    n = trees.count()
    top = forest(roots.select(F.lit(0).cast("long").alias("tree"), F.lit(n).cast("long").alias("n"), F.col("tree").alias("rank"), "digest"), fan_out=fan_out)
    return Manifest(numbered.drop("n"), trees, nodes, top, fan_out)


def tampered(doc_id: Column, text: Column) -> Column:
    """What the check of a manifest is tried on: without line feeds where 2 divides the crc32 of the id."""
    return F.when(F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)


def merkle_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row of ``docs``.

    ``folded_root`` goes from the leaf of the tampered row, up the untampered siblings; ``verified`` tells whether it is the root. Null values have an encoding of their own and
    a null id isn't tampered with; other columns are not read; repeated rows are leaves of their own. An empty table gives no rows.
    """
    cols = [F.col(c) for c in FIELDS]
    now = [F.when(F.col("doc_id").isNotNull(), tampered(F.col("doc_id"), F.col("text"))).otherwise(F.col("text")) if c == "text" else F.col(c) for c in FIELDS]
    leaves = docs.select("doc_id", "source", leaf_digest(cols).alias("leaf"), leaf_digest(now).alias("found"))
    proofs = manifest(leaves, group="source", order=["doc_id"]).proofs()
    out = proofs.select("doc_id", "leaf", "subroot", "root", F.sha2(proof_text(F.col("path")).cast("binary"), 256).alias("proof_sha256"), fold(F.col("found"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def oracle(levels: int = 10) -> str:
    """The same in DuckDB's SQL, for sources of up to ``3 ** levels`` rows and as many sources: one step a level, which leaves finished trees as they are."""
    enc = lambda c: f"coalesce(octet_length(encode({c}::VARCHAR))::VARCHAR || ':' || {c}::VARCHAR, '-')"
    leaf = lambda text: f"sha256({' || '.join(enc(text if c == 'text' else c) for c in FIELDS)})"

    def tree(name: str, first: str) -> str:
        """Nodes ``name0, name1, ...`` (t, r, m nodes of the level, d, lft, rgt) from ``first``."""
        beside = lambda a, b: f"coalesce(string_agg(d, '') OVER (PARTITION BY t, r // 3 ORDER BY r ROWS BETWEEN {a} AND {b}), '')"
        sides = f"CASE WHEN m > 1 THEN {beside('UNBOUNDED PRECEDING', '1 PRECEDING')} ELSE '' END AS lft, CASE WHEN m > 1 THEN {beside('1 FOLLOWING', 'UNBOUNDED FOLLOWING')} ELSE '' END AS rgt"
        out = [f"{name}0 AS MATERIALIZED (SELECT *, {sides} FROM ({first}))"]
        for k in range(levels):
            up = f"SELECT t, r // 3 AS r, any_value((m + 2) // 3) AS m, CASE WHEN any_value(m) = 1 THEN min(d) ELSE sha256(string_agg(d, '' ORDER BY r)) END AS d FROM {name}{k} GROUP BY t, r // 3"
            out.append(f"{name}{k + 1} AS MATERIALIZED (SELECT *, {sides} FROM ({up}))")
        return ", ".join(out)

    def climb(name: str, nodes: str, first: str) -> str:
        out = [f"{name}0 AS ({first})"]
        for k in range(levels):
            step = f"SELECT p.* EXCLUDE (place, acc, proof), p.place // 3 AS place, CASE WHEN x.m > 1 THEN sha256(x.lft || p.acc || x.rgt) ELSE p.acc END AS acc, p.proof || x.lft || x.rgt AS proof"
            out.append(f"{name}{k + 1} AS MATERIALIZED ({step} FROM {name}{k} p JOIN {nodes}{k} x ON x.t = p.t AND x.r = p.place)")
        return ", ".join(out)

    return f"""
WITH RECURSIVE bits AS (SELECT i AS b, i::BIGINT AS c, 0 AS k FROM range(256) x(i) UNION ALL SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY b) AS crc_table FROM bits WHERE k = 8),
e AS (SELECT *, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(doc_id::VARCHAR)), lambda i: ascii(substr(doc_id::VARCHAR, (i + 1)::INT, 1))::BIGINT)),
        lambda c, x: xor(c >> 8, crc_table[(xor(c, x) & 255) + 1])) & 1 AS low FROM documents, crc),
u AS (SELECT *, CASE WHEN low = 1 THEN replace(text, chr(10), '') ELSE text END AS found_text FROM e),
d AS MATERIALIZED (SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS t, {leaf("text")} AS leaf, {leaf("found_text")} AS found FROM u),
o AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r, count(*) OVER (PARTITION BY t) AS m FROM d),
{tree("a", "SELECT t, r, m, leaf AS d FROM o")},
{tree("z", f"SELECT 0 AS t, t AS r, count(*) OVER () AS m, d FROM a{levels}")},
{climb("p", "a", "SELECT doc_id, leaf, t, r AS place, found AS acc, '' AS proof FROM o")},
{climb("q", "z", f"SELECT p.doc_id, p.leaf, a.d AS subroot, 0 AS t, p.t AS place, p.acc, p.proof FROM p{levels} p JOIN a{levels} a ON a.t = p.t")}
SELECT doc_id, leaf, subroot, z.d AS root, sha256(proof) AS proof_sha256, acc AS folded_root, acc = z.d AS verified FROM q{levels}, z{levels} z
"""
