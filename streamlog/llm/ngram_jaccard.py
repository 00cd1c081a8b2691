"""N-gram Jaccard join by a token-group matrix, exact for every link.

1. Each text becomes its set of shingle hashes; equal sets are one class and are not expanded.
2. Classes are partitioned into groups of similar sets. A set has a few keys, each made of five min-hashes; it joins the most
   popular one, so near copies meet in one or few groups. Groups are cut into blocks of bounded size.
3. The token-group matrix holds, sparsely, the union of each block's tokens that can matter: under one global order (rare
   tokens first) two sets at or above the threshold t share k tokens of the first n - ceil(t n) + k of either. A block pair
   whose unions share fewer there cannot hold a link and is never opened. k grows with n, so a passage in common opens nothing.
4. An opened pair first bounds every set by its overlap with the other block's whole token union, then intersects the sets that pass.
5. A pair of blocks gives a spanning set of its links; connected components join them.

A group of many blocks, as a large cluster of near copies makes, is first linked along a tree of its blocks. Blocks that this joins into one component stand in the
matrix as one part: they are never compared with each other again. What meets a part is opened with the block of it that shares most; its other blocks follow only
where that left sets apart. So a cluster of near copies costs about as many pairs as it has blocks.

The order in 3 comes from counts of frequent tokens over all texts. Any order keeps the result exact: the counts only keep
passages that many texts share out of the matrix.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .components import components, few_tasks
from ..shared import discard, forget, materialise
from .words import mix, shingle_sets, text_slices, tidy

#: Keys of a set, and min-hashes in a key.
KEYS, KEY_WIDTH = 8, 5
#: Sets and tokens of a block, on average at most; bounds what one task holds.
BLOCK_SETS, BLOCK_TOKENS = 512, 1 << 17
#: Children of a block in its group's tree, and pairs that travel with one copy of a text.
FANOUT, PAIRS = 8, 64
#: A token counts as frequent if one run of about WINDOW tokens has it LOCAL times; at most FREQUENT of them order the matrix.
WINDOW, LOCAL, FREQUENT = 4 << 20, 4, 1 << 20
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def _set_id(tokens: np.ndarray) -> int:
    """Equal for equal sets: sum and xor of remixed tokens and the size, mixed again."""
    if not len(tokens):
        return 0
    x = mix(tokens ^ np.uint64(0x5851F42D4C957F2D))
    return int(mix(np.atleast_1d(x.sum()) + mix(np.atleast_1d(np.bitwise_xor.reduce(x)) ^ np.uint64(len(x)))).view(np.int64)[0])


def _keys(sets: list[np.ndarray]) -> np.ndarray:
    """Group keys, one row a set: KEY_WIDTH one-permutation min-hashes each; empty bins take the next full one."""
    bins = KEYS * KEY_WIDTH
    sizes = np.array([len(s) for s in sets])
    low = np.full(len(sets) * bins, _EMPTY, np.uint64)
    if sizes.sum():
        flat = np.concatenate(sets)
        np.minimum.at(low, np.repeat(np.arange(len(sets)), sizes) * bins + (flat % np.uint64(bins)).astype(np.int64), flat)
    low = low.reshape(-1, bins)
    for _ in range(bins):
        hole = low == _EMPTY
        if not hole[sizes > 0].any():
            break
        low = np.where(hole, np.roll(low, -1, axis=1), low)
    keys = np.zeros((len(sets), KEYS), np.uint64)
    for k in range(KEY_WIDTH):
        keys = mix(keys * np.uint64(31) + low[:, k::KEY_WIDTH] + np.uint64(k + 1))
    return mix(keys + np.arange(KEYS, dtype=np.uint64)).view(np.int64)


def _least_overlap(n: int, num: int, den: int) -> int:
    """What a set of n shares at least with any set at or above num/den."""
    return -(-n * num // den)


def _depth(n):
    """How many tokens of their prefixes two linked sets must share, by the smaller one's size; in SQL as well below."""
    return 1 + n // 16


def _scan(width: int):
    """One pass over the texts: a row (id, set_id, n, keys) for each, and rows (token, df) of locally frequent tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tokens, known = [], 0, set()

        def frequent() -> pa.RecordBatch:
            token, count = np.unique(np.concatenate(held), return_counts=True)
            keep = count >= LOCAL
            m = int(keep.sum())
            return pa.RecordBatch.from_arrays([pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.list_(pa.int64())), pa.array(token[keep].view(np.int64)), pa.array(count[keep].astype(np.int64))], names=["id", "set_id", "n", "keys", "token", "df"])

        for batch in batches:
            for part in text_slices(batch, "text"):
                sets = shingle_sets(part.column("text"), width)
                ids = [_set_id(s) for s in sets]
                keys, m = _keys(sets), len(sets)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, (m + 1) * KEYS, KEYS, dtype=np.int32)), pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), lists, pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64())], names=["id", "set_id", "n", "keys", "token", "df"])
                for i, s in zip(ids, sets, strict=True):
                    if len(s) and i not in known:
                        known.add(i)
                        held.append(s)
                        tokens += len(s)
                if tokens >= WINDOW:
                    yield frequent()
                    held, tokens, known = [], 0, set()
        if held:
            yield frequent()

    return run


def _prefixes(width: int, num: int, den: int, order):
    """(set_id, prefix): the first n - ceil(t n) + k tokens of each set, rare ones first; a set once for each run of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, count = order.value
        seen: set[int] = set()
        for batch in batches:
            for part in text_slices(batch, "text"):
                ids, firsts = [], []
                for s in shingle_sets(part.column("text"), width):
                    i = _set_id(s)
                    if not len(s) or i in seen:
                        continue
                    if len(seen) >= 100_000:
                        seen.clear()
                    seen.add(i)
                    p = min(len(s), len(s) - _least_overlap(len(s), num, den) + _depth(len(s)))
                    at = np.minimum(np.searchsorted(token, s), max(0, len(token) - 1))
                    df = np.where(token[at] == s, count[at], 0) if len(token) else np.zeros(len(s), np.int64)
                    cold = s[df == 0]
                    firsts.append(cold[:p] if len(cold) >= p else s[np.argsort(df, kind="stable")[:p]])
                    ids.append(i)
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in firsts])]).astype(np.int32)
                flat = np.concatenate(firsts).view(np.int64) if firsts else np.empty(0, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["set_id", "prefix"])

    return run


def _tokens(width: int):
    """The token sets of the classes to open. An id may have other texts as well: those are passed over."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                sets = shingle_sets(part.column("text"), width)
                same = pa.array([_set_id(s) == i for s, i in zip(sets, part.column("set_id").to_pylist(), strict=True)], pa.bool_())
                out = pa.RecordBatch.from_arrays([part.column("block"), part.column("node"), pa.array([s.tobytes() for s in sets], pa.binary()), part.column("pairs")], names=["block", "node", "tokens", "pairs"])
                yield out.filter(same)

    return run


def _shared_counts(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of sets in a with sets in b, over the tokens both sides have, a slab of columns at a time."""
    out = np.zeros((len(a), len(b)), np.float32)
    if not a or not b:
        return out
    row_a, row_b = np.repeat(np.arange(len(a)), [len(s) for s in a]), np.repeat(np.arange(len(b)), [len(s) for s in b])
    flat_a, flat_b = np.concatenate(a), np.concatenate(b)
    common = np.intersect1d(flat_a, flat_b)
    if not len(common):
        return out
    at_a, at_b = (np.minimum(np.searchsorted(common, x), len(common) - 1) for x in (flat_a, flat_b))
    in_a, in_b = common[at_a] == flat_a, common[at_b] == flat_b
    at_a, row_a, at_b, row_b = at_a[in_a], row_a[in_a], at_b[in_b], row_b[in_b]
    order_a, order_b = np.argsort(at_a, kind="stable"), np.argsort(at_b, kind="stable")
    at_a, row_a, at_b, row_b = at_a[order_a], row_a[order_a], at_b[order_b], row_b[order_b]
    for lo in range(0, len(common), 2048):
        x, y = np.zeros((len(a), 2048), np.float32), np.zeros((len(b), 2048), np.float32)
        i, j = slice(*np.searchsorted(at_a, [lo, lo + 2048])), slice(*np.searchsorted(at_b, [lo, lo + 2048]))
        x[row_a[i], at_a[i] - lo] = 1
        y[row_b[j], at_b[j] - lo] = 1
        out += x @ y.T
    return out


def _links(a: list[np.ndarray], b: list[np.ndarray], num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of sets at or above the threshold: bound by the other side's union, then intersect those that pass."""

    def passing(sets: list[np.ndarray], others: list[np.ndarray]) -> list[int]:
        union = np.unique(np.concatenate(others))
        return [k for k, s in enumerate(sets) if (union[np.minimum(np.searchsorted(union, s), len(union) - 1)] == s).sum() >= _least_overlap(len(s), num, den)]

    if a is b:
        keep_a = keep_b = list(range(len(a)))
    else:
        keep_a = passing(a, b)
        keep_b = passing(b, [a[k] for k in keep_a]) if keep_a else []
    if not keep_a or not keep_b:
        return np.empty(0, int), np.empty(0, int)
    some_a, some_b = [a[k] for k in keep_a], [b[k] for k in keep_b]
    inter = _shared_counts(some_a, some_b).astype(np.int64)
    total = np.array([len(s) for s in some_a])[:, None] + np.array([len(s) for s in some_b])[None, :]
    i, j = np.nonzero(den * inter >= num * (total - inter))
    return np.array(keep_a)[i], np.array(keep_b)[j]


class _Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def _open(num: int, den: int):
    """An opened pair of blocks -> a spanning forest of its links. Links inside a block come from the block's own pair (left = right)."""

    def run(table: pa.Table) -> pa.Table:
        left = table["g1"][0].as_py()
        once = np.unique(np.array([hash(x.as_py()) for x in table["tokens"]]), return_index=True)[1]  # an id may be in several rows
        table = table.take(pa.array(np.sort(once)))
        block, nodes = table["block"].to_numpy(), table["node"].to_numpy()
        sets = [np.frombuffer(x.as_py(), np.uint64) for x in table["tokens"]]
        first = np.flatnonzero(block == left)
        own = table["g1"][0].as_py() == table["g2"][0].as_py()
        second = first if own else np.flatnonzero(block != left)
        a, forest, out = [sets[k] for k in first], _Forest(len(sets)), []
        b = a if own else [sets[k] for k in second]
        i, j = _links(a, b, num, den) if a and b else (np.empty(0, int), np.empty(0, int))
        if len(i) and not own:  # what either block links by itself need not be linked again
            for side, at in ((a, first), (b, second)):
                for x, y in zip(*_links(side, side, num, den), strict=True):
                    forest.join(at[x], at[y])
        for x, y in zip(first[i], second[j], strict=True):
            if x != y and forest.join(x, y):
                out.append((min(nodes[x], nodes[y]), max(nodes[x], nodes[y])))
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    return run


def _frequent_tokens(scanned: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Frequent tokens, sorted, and their counts: at most FREQUENT of them, the least frequent left out by powers of two."""
    counts = scanned.where("token is not null").groupBy("token").agg(F.sum("df").alias("df"))
    steps = counts.groupBy(F.floor(F.log2("df")).alias("step")).count().orderBy(F.desc("step")).collect()  # 64 rows at most
    least, total = 64, 0
    for row in steps:
        total += row["count"]
        if total > FREQUENT:
            break
        least = row["step"]
    kept = counts.where(F.col("df") >= F.lit(2.0) ** int(least)).toArrow()
    token, df = kept["token"].to_numpy().view(np.uint64), kept["df"].to_numpy()
    order = np.argsort(token)
    return token[order], df[order]


def _place(rows: DataFrame, total: int) -> DataFrame:
    """Classes of equal sets, then groups of similar classes, then blocks of bounded size: (set_id, node, n, group, at, block), with the block's size, least and most n.

    ``at`` is a block's number in its group. Counts by key are tables of their own before they are joined back, so that Spark can split the rows of a hot key.
    """
    sets = rows.where("n > 0").groupBy("set_id").agg(F.min("id").alias("node"), F.first("n").alias("n"), F.first("keys").alias("keys")).where("node is not null")
    sets = materialise(few_tasks(sets, total), "sets")
    keyed = sets.select("set_id", F.explode("keys").alias("key"))
    popular = materialise(few_tasks(keyed.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), total), "keys")
    chosen = keyed.join(popular, "key").groupBy("set_id").agg(F.max(F.struct("size", "key"))["key"].alias("key"))
    grouped = materialise(few_tasks(sets.drop("keys").join(chosen, "set_id", "left").withColumn("group", F.coalesce("key", "set_id")).drop("key"), total), "groups")
    wide = grouped.groupBy("group").agg(F.ceil(F.greatest(F.count("*") / BLOCK_SETS, F.sum("n") / BLOCK_TOKENS)).alias("blocks")).where("blocks > 1")
    wide = materialise(few_tasks(wide, total // BLOCK_SETS), "wide")
    placed = grouped.join(wide, "group", "left").withColumn("at", F.pmod(F.xxhash64("set_id"), F.coalesce("blocks", F.lit(1)))).withColumn("block", F.xxhash64("group", "at"))
    blocks = placed.groupBy("block").agg(F.count("*").alias("size"), F.min("n").alias("least"), F.max("n").alias("most"))
    out = placed.select("set_id", "node", "n", "group", "at", "block", F.col("blocks").isNotNull().alias("wide")).join(blocks, "block")
    out = materialise(few_tasks(out, total), "blocks")
    for table in (sets, popular, grouped, wide):
        discard(table)
    return out


def _tree(placed: DataFrame) -> DataFrame:
    """(g1, g2): every block of a wide group with itself and with its parent in the group's tree. Blocks without sets are no places in it."""
    there = placed.where("wide").select("group", "at", "block").distinct()
    at = F.row_number().over(W.partitionBy("group").orderBy("at")) - 1  # one row a block
    there = there.withColumn("at", at).withColumn("parent", F.floor((F.col("at") - 1) / FANOUT))
    up = there.select("group", F.col("at").alias("parent"), F.col("block").alias("above"))
    met = there.where("at > 0").join(up, ["group", "parent"]).select(F.least("block", "above").alias("g1"), F.greatest("block", "above").alias("g2"))
    return met.union(there.select(F.col("block").alias("g1"), F.col("block").alias("g2")))


def _whole(placed: DataFrame, found: DataFrame) -> DataFrame:
    """(block, part): blocks whose sets are all of one component, and that component."""
    part = F.coalesce("component", "node")
    each = placed.select("block", "node").join(found, "node", "left").groupBy("block").agg(F.min(part).alias("part"), F.max(part).alias("last"))
    each = each.where("part = last").select("block", F.xxhash64(F.lit("part"), "part").alias("part"))
    return materialise(few_tasks(each, placed.count()), "whole")


def _pairs(texts: DataFrame, placed: DataFrame, joined: DataFrame | None, order, width: int, num: int, den: int, total: int) -> DataFrame:
    """(g1, g2, late): pairs of blocks to open, each multi-set block with itself among them but for what the tree has opened.

    ``joined`` blocks of one component are one row a token of the matrix. What such a part meets is then looked up in its blocks one by one; all but the block that
    shares most are ``late``.
    """
    # Each block's token union, then the matrix: (token, part), with the sizes of the part's sets in one number.
    prefixes = texts.mapInArrow(tidy(_prefixes(width, num, den, order)), "set_id long, prefix array<long>")
    held = prefixes.join(placed.select("set_id", "block"), "set_id")
    unions = held.groupBy("block").agg(F.array_distinct(F.flatten(F.collect_list("prefix"))).alias("tokens"))
    blocks = placed.select("block", "least", "most").distinct()
    unions = unions.join(blocks, "block")
    if joined is not None:
        unions = materialise(few_tasks(unions.join(joined, "block", "left"), total), "unions")
        parts = unions.where("part is not null").groupBy("part").agg(F.min("least").alias("least"), F.max("most").alias("most"))
        alone = unions.where("part is null").select(F.explode("tokens").alias("token"), "block", "least", "most")
        inside = unions.where("part is not null").select(F.explode("tokens").alias("token"), "block", "part")
        together = inside.select("token", "part").distinct().join(parts, "part").select("token", F.col("part").alias("block"), "least", "most")
        matrix = alone.union(together)
    else:
        matrix = unions.select(F.explode("tokens").alias("token"), "block", "least", "most")
    matrix = matrix.select("token", "block", (F.shiftleft("least", 32) + F.col("most")).alias("sizes"))
    least, most = (lambda side: F.shiftright(f"{side}.sizes", 32)), (lambda side: F.col(f"{side}.sizes").bitwiseAND(F.lit((1 << 32) - 1)))
    fits = (F.col("x.block") < F.col("y.block")) & (most("x") * den >= least("y") * num) & (most("y") * den >= least("x") * num)
    met = matrix.alias("x").join(matrix.alias("y"), (F.col("x.token") == F.col("y.token")) & fits)  # one exchange serves both sides
    met = met.select(F.col("x.block").alias("g1"), F.col("y.block").alias("g2"), F.least(least("x"), least("y")).alias("least"))
    enough = F.col("shared") >= F.floor(1 + F.col("least") / 16)
    cross = met.groupBy("g1", "g2", "least").agg(F.count("*").alias("shared")).where(enough).select("g1", "g2", "least")
    own = placed.where("size > 1 and not wide").select(F.col("block").alias("g1"), F.col("block").alias("g2")).distinct()
    if joined is None:
        return materialise(few_tasks(cross.select("g1", "g2").union(own).withColumn("late", F.lit(False)), total), "pairs")
    cross = materialise(few_tasks(cross, total), "part-pairs")
    members = materialise(few_tasks(unions.where("part is not null").select("part", "block"), total // BLOCK_SETS), "part-blocks")
    known = members.select("part").distinct()
    # A part on either side: which of its blocks share enough with the whole other side.
    sides = cross.select(F.col("g1").alias("part"), F.col("g2").alias("other"), "least").union(cross.select(F.col("g2").alias("part"), F.col("g1").alias("other"), "least")).join(known, "part", "left_semi")
    theirs = sides.join(matrix.select(F.col("block").alias("other"), "token"), "other")
    hits = inside.join(theirs, ["part", "token"]).groupBy("part", "other", "block", "least").agg(F.count("*").alias("shared")).where(enough)
    hits = materialise(few_tasks(hits.select("part", "other", "block", "shared"), total), "part-hits")
    best = hits.groupBy("part", "other").agg(F.max_by("block", F.struct("shared", "block")).alias("best"))
    hits = hits.join(best, ["part", "other"]).select("part", "other", "block", (F.col("block") != F.col("best")).alias("late"))
    plain = cross.join(known.withColumnRenamed("part", "g1"), "g1", "left_anti").join(known.withColumnRenamed("part", "g2"), "g2", "left_anti").select("g1", "g2", F.lit(False).alias("late"))
    mixed = hits.join(known.withColumnRenamed("part", "other"), "other", "left_anti").select(F.least("block", "other").alias("g1"), F.greatest("block", "other").alias("g2"), "late")
    across = hits.alias("x").join(hits.alias("y"), (F.col("x.part") == F.col("y.other")) & (F.col("x.other") == F.col("y.part")) & (F.col("x.part") < F.col("y.part")))
    across = across.select(F.least("x.block", "y.block").alias("g1"), F.greatest("x.block", "y.block").alias("g2"), (F.col("x.late") | F.col("y.late")).alias("late"))
    return materialise(few_tasks(plain.union(mixed).union(across).union(own.withColumn("late", F.lit(False))), total), "pairs")


def _apart(pairs: DataFrame, whole: DataFrame) -> DataFrame:
    """The late pairs whose blocks aren't one component by now."""
    x, y = (whole.select(F.col("block").alias(g), F.col("part").alias(f"part_{g}")) for g in ("g1", "g2"))
    late = pairs.where("late").join(x, "g1", "left").join(y, "g2", "left")
    return materialise(late.where(~F.coalesce(F.col("part_g1") == F.col("part_g2"), F.lit(False))).select("g1", "g2"), "late-pairs")


#: Slots of the filter by which a step that opens few texts leaves the others out before they are shuffled; a bit each, so a fixed size.
SLOTS = 1 << 23


def _only(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The texts whose id may be a wanted node: by a bit for each slot of hashed ids."""
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(SLOTS))
    words = wanted.select(slot("node").alias("slot")).groupBy(F.floor(F.col("slot") / 64).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot % 64 as int))")).alias("bits")).toArrow()
    mask = np.zeros(SLOTS // 64, np.uint64)
    mask[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    shared = texts.sparkSession.sparkContext.broadcast(mask)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("slot").to_numpy()
            there = shared.value[at // 64] >> (at % 64).astype(np.uint64) & np.uint64(1)
            yield batch.filter(pa.array(there.astype(bool))).select(["id", "text"])

    return texts.withColumn("slot", slot("id")).mapInArrow(tidy(run), "id long, text string")


def _link(texts: DataFrame, placed: DataFrame, pairs: DataFrame, width: int, num: int, den: int, few: bool = False) -> DataFrame:
    """(a, b): links that span what the opened pairs hold; ``few`` where these are of few texts."""
    # Token sets of the blocks to open only, dealt to the pairs of their block; a block of many pairs sends several copies, each with few of them.
    ends = pairs.select(F.explode(F.array_distinct(F.array("g1", "g2"))).alias("block"), F.struct("g1", "g2").alias("pair"))
    many = ends.groupBy("block").agg(F.ceil(F.count("*") / PAIRS).alias("copies")).where("copies > 1")
    ends = ends.join(many, "block", "left").withColumn("copy", F.pmod(F.xxhash64("pair"), F.coalesce("copies", F.lit(1))))
    sides = ends.groupBy("block", "copy").agg(F.collect_list("pair").alias("pairs"))
    wanted = placed.join(sides, "block").select("node", "block", "set_id", "pairs")
    some = _only(texts, wanted) if few else texts
    opened = some.join(wanted, some["id"] == wanted["node"]).select("block", "node", "set_id", "text", "pairs")
    members = opened.mapInArrow(tidy(_tokens(width)), "block long, node long, tokens binary, pairs array<struct<g1:long,g2:long>>")
    members = members.select("block", "node", "tokens", F.explode("pairs").alias("pair")).select("block", "node", "tokens", "pair.g1", "pair.g2")
    return materialise(members.groupBy("g1", "g2").applyInArrow(_open(num, den), "a long, b long"), "links")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 5, threshold: tuple[int, int] = (4, 5)) -> DataFrame:
    """Links texts whose shingle sets have a Jaccard similarity of ``threshold`` (a ratio of integers) or more.

    Returns id, ``n_shingles``, ``set_id`` (equal for equal sets) and ``component_id``: the smallest id reachable by links. One
    row for each row of ``docs``; other columns of ``docs`` are not read, so they cannot clash. A null or wordless text has no
    shingles and is linked with nothing; a text of fewer than ``width`` words is one shingle. Repeated rows stay repeated. A null id
    gets the component of its equals, or null. Rows with the same id and different texts are documents of their own, each with the component of its text.
    An empty table gives no rows. Sets and shingles are told apart by 64-bit hashes: n different texts are all told apart but for a chance of n^2 / 2^65.
    """
    num, den = threshold
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    scanned = materialise(texts.mapInArrow(tidy(_scan(width)), "id long, set_id long, n long, keys array<long>, token long, df long"), "shingles")
    rows = scanned.where("token is null").select("id", "set_id", "n", "keys")  # one a document
    order = spark.sparkContext.broadcast(_frequent_tokens(scanned))
    # Between the steps, the shuffles of the one before are let go: each step leaves a small table.
    total = rows.count()
    placed = _place(rows, total)
    forget(spark)
    links, joined = None, None
    if placed.where("wide").take(1):
        tree = materialise(few_tasks(_tree(placed), total // BLOCK_SETS), "tree")
        links = _link(texts, placed, tree, width, num, den, few=True)
        wide = placed.where("wide")
        joined = _whole(wide, components(links))
        forget(spark)
    pairs = _pairs(texts, placed, joined, order, width, num, den, total)
    forget(spark)
    more = _link(texts, placed, pairs.where("not late").select("g1", "g2"), width, num, den)
    links = more if links is None else links.union(more)
    found = components(links)
    if joined is not None and pairs.where("late").take(1):
        forget(spark)
        late = _apart(pairs, _whole(placed, found))
        if late.take(1):
            found = components(links.union(_link(texts, placed, late, width, num, den, few=True)))
    forget(spark)

    class_of = placed.select("set_id", "node").join(found, "node", "left").select("set_id", F.coalesce("component", "node").alias("component"))
    out = rows.select("id", "n", "set_id").join(class_of, "set_id", "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "set_id", F.coalesce("component", "id").alias("component_id"))
