"""Merkle manifest of a dataset: a tree per group over its rows in key order, and a tree over the groups.

Rows get their rank in the group from one range partitioning by (group, key, leaf), written once: a
row's place in its task, plus the rows of its group in earlier tasks. A hot group thus spreads over
many tasks. The rank's digits to base ``fan`` are columns; ``depth`` of them lie within a block of
fan^depth consecutive rows. One exchange deals the rows by (group, block); digit after digit is then
grouped away, each time nesting the children as structs in their parent, until a block is one row.
Block roots are the next round's rows, until every group is one node; the groups' roots, ranked by
group, go through the same rounds. On the way back each block gets the path of its root by grouping it
with the path's row, and one nested transform and an explode emit a path per leaf, without joins.

A parent is the SHA-256 (lowercase hex) of its children's concatenated hex digests; a lone child is
hashed, too, except where it is the only node left of its group, which is then the group's root.

Order: null groups and null keys come first, rows of one group and key are ordered by leaf (equal
leaves are the same row, and which comes first changes no digest). Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiframe.llm.common import cut, save_small

FAN = 3
DEPTH = 6
PATH = "array<struct<l:string,r:string>>"


def leaf_hash(*inputs: Column) -> Column:
    """Digest of the inputs, each as ``-`` if null, else its UTF-8 length in bytes, a colon and the value."""
    text = [c.cast("string") for c in inputs]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]), 256)


def ranked(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """``rows`` with ``r``: the 0-based rank in the group; written to the shared folder."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the last key spreads rows that are equal in all others
    spread = rows.withColumn("_tie", F.rand(7)).repartitionByRange(n, group, *order, "_tie").sortWithinPartitions(group, *order, "_tie")
    placed = cut(spread.withColumn("_at", F.monotonically_increasing_id()).drop("_tie"))
    placed = placed.withColumn("_task", F.shiftright("_at", 33)).withColumn("_at", F.col("_at").bitwiseAND((1 << 33) - 1))
    runs = placed.groupBy(group, "_task").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(group).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1))
    # one row per task and group in it; Spark broadcasts it only if it is small
    shift = save_small(runs.select(F.col(group).alias("_g"), F.col("_task").alias("_t"), (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift")), "merkle-shift")
    on = (F.col("_task") == F.col("_t")) & F.col(group).eqNullSafe(F.col("_g"))
    return placed.join(shift, on).withColumn("r", F.col("_at") + F.col("_shift")).drop("_at", "_task", "_t", "_g", "_shift")


def _parent(kids: Column, first: Column) -> Column:
    """Digest of a node; ``first``: it is the first of its level, so that a lone child was the last node."""
    joined = F.sha2(F.array_join(F.transform(kids, lambda k: k["h"]), ""), 256)
    return F.when(first & (F.size(kids) == 1), kids[0]["h"]).otherwise(joined)


def blocks(nodes: DataFrame, fan: int = FAN, depth: int = DEPTH) -> DataFrame:
    """(g, b, h, kids): every block of fan^depth consecutive nodes (g, r, h, row) of a group as one row."""
    power = [fan**k for k in range(depth + 1)]
    digit = [F.expr(f"cast(r div {power[k]}L % {fan} as int)").alias(f"d{k}") for k in range(depth)]
    df = nodes.select("g", F.expr(f"r div {power[depth]}L").alias("b"), *digit, F.struct("h", "row").alias("node")).repartition("g", "b")
    for k in range(depth):
        above = [f"d{i}" for i in range(k + 1, depth)]
        kid = F.struct(F.col(f"d{k}").alias("d"), F.col("node.h").alias("h"),
                       (F.col("node.row") if k == 0 else F.col("node.kids")).alias("row" if k == 0 else "kids"))
        df = df.groupBy("g", "b", *above).agg(F.sort_array(F.collect_list(kid)).alias("kids"))
        first = F.col("b") == 0
        for c in above:
            first = first & (F.col(c) == 0)
        df = df.select("g", "b", *above, F.struct(_parent(F.col("kids"), first).alias("h"), F.col("kids").alias("kids")).alias("node"))
    return df.select("g", "b", "node.h", "node.kids")


def _step(kids: Column, i: Column) -> Column:
    """Digests left and right of child ``i``, concatenated."""
    side = lambda part: F.array_join(F.transform(part, lambda k: k["h"]), "")
    return F.struct(side(F.slice(kids, F.lit(1), i)).alias("l"), side(F.slice(kids, i + 2, F.size(kids))).alias("r"))


def _emit(kids: Column, path: Column, depth: int, sole: Column) -> Column:
    """ARRAY<STRUCT<row, path>> of all rows below ``kids``. ``sole``: no other node stands beside
    these on their level, in which case a lone child is not hashed again."""
    def below(k: Column, i: Column) -> Column:
        hashed = ~(sole & (F.size(kids) == 1))
        way = F.concat(F.when(hashed, F.array(_step(kids, i))).otherwise(F.array().cast(PATH)), path)
        if depth == 1:
            return F.array(F.struct(k["row"].alias("row"), k["h"].alias("h"), way.alias("path")))
        return _emit(k["kids"], way, depth - 1, sole & (k["d"] == 0))

    return F.flatten(F.transform(kids, below))


def unroll(level: DataFrame, paths: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(row, h, path, top): the rows of all blocks with the digests beside their way to the root.
    ``paths`` holds (g, b, path, top) of every block."""
    none = lambda df, c: F.lit(None).cast(df.schema[c].dataType).alias(c)
    both = level.select("g", "b", "kids", none(paths, "path"), none(paths, "top")).unionByName(
        paths.select("g", "b", none(level, "kids"), "path", "top"))
    met = both.groupBy("g", "b").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("kids", "path", "top")])
    rows = _emit(F.col("kids"), F.col("path"), depth, F.col("b") == 0)
    return met.select("top", F.explode(rows).alias("x")).select("x.row", "x.h", "x.path", "top")


def _grow(nodes: DataFrame, fan: int, depth: int) -> list[DataFrame]:
    """Rounds of blocks until every group is one block; each round is written once."""
    rounds = []
    while True:
        level = cut(blocks(nodes, fan, depth))
        rounds.append(level)
        if not (level.agg(F.max("b")).first()[0] or 0):
            return rounds
        nodes = level.select("g", F.col("b").alias("r"), "h", F.struct("g", "b").alias("row"))


def _descend(rounds: list[DataFrame], paths: DataFrame, depth: int) -> DataFrame:
    for level in reversed(rounds[1:]):
        found = unroll(level, paths, depth)
        paths = found.select("row.g", "row.b", "path", "top")
    return unroll(rounds[0], paths, depth)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the digests beside its way give."""
    return F.aggregate(path, leaf, lambda acc, s: F.sha2(F.concat(s["l"], acc, s["r"]), 256))


def proof_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["l"], s["r"])), ""), 256)


def manifest(rows: DataFrame, group: str, key: str, leaf: str, carry: tuple[str, ...] = (), fan: int = FAN, depth: int = DEPTH) -> DataFrame:
    """(group, key, leaf, *carry, subroot, root, path) of every row; ``path`` lists, level by level up to
    the root, the digests left and right of the row's node. Other columns are left out."""
    if len({group, key, leaf, *carry}) < 3 + len(carry):
        raise ValueError("group, key, leaf and carried columns must differ")
    data = rows.select(F.col(group).alias("g"), F.col(key).alias("k"), F.col(leaf).alias("h"), F.struct(*[F.lit(0).alias("_"), *carry]).alias("c"))
    nodes = ranked(data, "g", "k", "h").select("g", "r", "h", F.struct("g", "k", "c").alias("row"))
    rounds = _grow(nodes, fan, depth)
    subroots = rounds[-1].select(F.lit(0).alias("one"), F.col("g"), "h")  # one row per group
    top_nodes = ranked(subroots, "one", "g").select(F.col("one").alias("g"), "r", "h", F.struct("g", F.col("h").alias("subroot")).alias("row"))
    top_rounds = _grow(top_nodes, fan, depth)
    roots = top_rounds[-1].select("g", "b", F.array().cast(PATH).alias("path"), F.struct(F.col("h").alias("root")).alias("top"))
    tops = _descend(top_rounds, roots, depth).select(
        "row.g", F.lit(0).cast("bigint").alias("b"), "path", F.struct("row.subroot", "top.root").alias("top"))
    out = _descend(rounds, tops, depth)
    return out.select(F.col("row.g").alias(group), F.col("row.k").alias(key), F.col("h").alias(leaf),
                      *[F.col(f"row.c.{c}").alias(c) for c in carry], "top.subroot", "top.root", "path")
