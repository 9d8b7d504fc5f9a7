"""Prefix trie of conversations with totals of all subtrees, by depth bands (operator 11).

Turns are ordered by number (null first; equal numbers by a digest of role and text).  A null role
or text is empty.  Conversation c is rebuilt from the first h turns of conversation c - c % ``FAMILY`` and
its own turns after its first h, h = crc32(decimal c) % ``HEADS``.

1. *Rows.*  A turn is a 128-bit digest of role and text, and its number of words; no text is shuffled.
   Turns are range-partitioned by (conversation, turn), so one conversation may lie in many tasks;
   places in it are the places in a task and the counts of the tasks before.
2. *Nodes.*  The key of a prefix is the exclusive or of the digests of its (depth, turn) pairs, so it is a
   running value per task, corrected for the tasks before.  Conversations that lie in several tasks
   have at most two rows for each task in that correction, which is broadcast.  Grouping rows by key gives
   nodes, their members and the smallest member; a group of equal prefixes is added up map-side.
3. *Totals.*  Depths are cut into bands of ``BAND``.  A node adds its own values to its ancestors in its
   band alone, at most ``BAND`` rows, found in the path that its smallest member takes through that
   band.  The roots of the bands are a trie of a ``BAND``-th of the depth; their totals come from the same rule
   (so there are log(depth) rounds), and complete totals then go up to the ancestors in the band above.
4. *Ends.*  The conversations that end in a node are listed in runs of at most 4,096 ids, and the runs are
   streamed in order through the digest, which takes them one after the other by its nature.

The parent of a node is found by a join on keys; parents of more than a thousandth of all nodes (fewer
than 1,000) are broadcast instead.

Defined cases: rows without a conversation id take no part; repeated rows are turns of their own; a
null turn comes first; very long texts and conversations need no more memory; an absent or short
conversation gives the turns it has; other columns are not read, whatever their names; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, whole, word_list

FAMILY = 20
HEADS = 4
BAND = 16
#: Ids in one run of the ends of a node: 2 ** RUN_BITS.
RUN_BITS = 12
#: One of so many nodes: the children of a parent that is broadcast are more.
HOT_SHARE = 1000
HOT = 1000
KEY = ["n1", "n2"]


def _turns(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    said = conversations.select(
        F.col(conv_id).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"),
        whole(F.col(role).cast("string")).alias("role"), whole(F.col(text).cast("string")).alias("text"))
    return said.filter("conv is not null").select(
        "conv", "turn", F.xxhash64("role", "text").alias("k1"), F.xxhash64(F.lit(1), "role", "text").alias("k2"),
        F.size(word_list(F.col("text"))).cast("long").alias("words"))


def _digest(depth: Column, turn: Column) -> dict[str, Column]:
    """Two halves of the digest of a (depth, turn) pair."""
    return {"z1": F.xxhash64(depth, turn["k1"], turn["k2"]), "z2": F.xxhash64(turn["k2"], depth, turn["k1"], F.lit(2))}


def _heads(conv: Column, heads: int) -> Column:
    return (F.crc32(conv.cast("string").cast("binary")) % heads).cast("long")


def rebuilt(conversations: DataFrame, family: int = FAMILY, heads: int = HEADS, conv_id: str = "conv_id",
            turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Per conversation and depth from 0: conv, depth, key of the prefix (n1, n2), that of the prefix before
    (p1, p2; null at the root), words of the last turn, and last, whether the conversation ends there."""
    order = [F.col("turn").asc_nulls_first(), "k1", "k2", "tie"]
    turns = cut(_turns(conversations, conv_id, turn, role, text).withColumn("tie", F.monotonically_increasing_id()))
    dealt = cut(turns.repartitionByRange("conv", *order).withColumn("part", F.spark_partition_id()))
    placed = dealt.withColumn("place", F.row_number().over(Window.partitionBy("conv", "part").orderBy(*order)).cast("long"))

    # a conversation has a row for each task that it lies in
    by_part = Window.partitionBy("conv").orderBy("part")
    parts = cut(dealt.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("n")).withColumns({
        "before": F.sum("n").over(by_part) - F.col("n"), "n_own": F.sum("n").over(Window.partitionBy("conv"))}))
    head = (placed.filter((F.col("conv") % family == 0) & (F.col("place") < heads)).join(parts, ["conv", "part"])
            .filter(F.col("before") + F.col("place") < heads).groupBy(F.col("conv").alias("base"))
            .agg(F.sort_array(F.collect_list(F.struct(   # fewer than ``heads`` rows
                (F.col("before") + F.col("place")).alias("place"), "k1", "k2", "words"))).alias("head")))
    convs = parts.filter("before = 0").select("conv", "n_own").withColumns({
        "h": _heads(F.col("conv"), heads), "base": F.col("conv") - F.col("conv") % family})
    nothing = F.array().cast("array<struct<place:bigint,k1:bigint,k2:bigint,words:bigint>>")
    keyed = F.transform(F.coalesce(F.slice("head", 1, F.col("h").cast("int")), nothing), lambda t: F.struct(
        t["place"].alias("depth"), t["words"].alias("words"), *[v.alias(k) for k, v in _digest(t["place"], t).items()]))
    convs = cut(convs.join(head, "base", "left").withColumn("head", keyed).withColumns({
        "n_head": F.size("head").cast("long"),
        **{f"h{i}": F.aggregate(F.col(f"head.z{i}"), F.lit(0).cast("long"), lambda a, z: a.bitwiseXOR(z)) for i in (1, 2)}}))

    info = parts.select("conv", "part", "before").join(convs.select("conv", "h", "n_own", "n_head", "h1", "h2"), "conv")
    own = placed.join(info, ["conv", "part"]).withColumn("place", F.col("before") + F.col("place")).filter("place > h")
    own = own.withColumn("depth", F.col("place") - F.col("h") + F.col("n_head"))
    own = own.withColumns(_digest(F.col("depth"), {k: F.col(k) for k in ("k1", "k2")}))
    upto = Window.partitionBy("conv", "part").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = cut(own.withColumns({f"x{i}": F.expr(f"bit_xor(z{i})").over(upto).bitwiseXOR(F.col(f"h{i}")) for i in (1, 2)}).select(
        "conv", "part", "depth", "z1", "z2", "x1", "x2", "words", (F.col("place") == F.col("n_own")).alias("last")))
    # conversations that lie in several tasks: at most two rows a task
    several = parts.filter("n < n_own").select("conv", "part")
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    several = cut(own.join(F.broadcast(several), ["conv", "part"]).groupBy("conv", "part").agg(
        *[F.expr(f"bit_xor(z{i})").alias(f"z{i}") for i in (1, 2)]).select("conv", "part", *[
            F.coalesce(F.expr(f"bit_xor(z{i})").over(earlier), F.lit(0)).alias(f"o{i}") for i in (1, 2)]))
    own = own.join(F.broadcast(several), ["conv", "part"], "left").select(
        "conv", "depth", "z1", "z2", "words", "last",
        *[F.col(f"x{i}").bitwiseXOR(F.coalesce(f"o{i}", F.lit(0))).alias(f"n{i}") for i in (1, 2)])

    first = Window.partitionBy("conv").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = F.col("n_own") <= F.col("h")
    lead = convs.select("conv", "n_head", ends.alias("ends"), F.explode("head").alias("t")).select(
        "conv", "t.depth", "t.z1", "t.z2", "t.words", (F.col("ends") & (F.col("t.depth") == F.col("n_head"))).alias("last"))
    lead = lead.withColumns({f"n{i}": F.expr(f"bit_xor(z{i})").over(first) for i in (1, 2)})
    zero = F.lit(0).cast("long")
    root = convs.select("conv", zero.alias("depth"), zero.alias("n1"), zero.alias("n2"), F.lit(None).cast("long").alias("p1"),
                        F.lit(None).cast("long").alias("p2"), zero.alias("words"), (ends & (F.col("n_head") == 0)).alias("last"))
    names = root.columns
    under = own.unionByName(lead).withColumns({f"p{i}": F.col(f"n{i}").bitwiseXOR(F.col(f"z{i}")) for i in (1, 2)})
    return cut(root.unionByName(under.select(*names)))


def totals(rows: DataFrame, nodes: DataFrame, values: list[str], band: int = BAND) -> DataFrame:
    """(n1, n2, values) summed over the whole subtree of every node.

    ``rows`` (conv, depth, n1, n2) are the paths, ``nodes`` (n1, n2, conv, depth, values) have in
    conv a conversation that goes through them."""
    of_band = F.floor(F.col("depth") / band).cast("long").alias("band")
    sums = [F.sum(v).alias(v) for v in values]
    paths = cut(rows.groupBy("conv", of_band).agg(   # at most ``band`` nodes in a path
        F.sort_array(F.collect_list(F.struct("depth", *KEY))).alias("path")))
    inside = nodes.select("conv", "depth", of_band, *values).join(paths, ["conv", "band"])
    upwards = F.slice("path", 1, (F.col("depth") % band + 1).cast("int"))
    inside = cut(inside.select(F.explode(upwards).alias("up"), *values).groupBy("up.n1", "up.n2").agg(*sums))
    deepest = nodes.agg(F.max("depth")).first()[0] or 0   # one number
    if deepest < band:
        return inside
    thin = lambda df: df.filter(F.col("depth") % band == 0).withColumn("depth", F.floor(F.col("depth") / band).cast("long"))
    roots = thin(nodes.select(*KEY, "conv", "depth"))
    complete = totals(thin(rows.select("conv", "depth", *KEY)), roots.join(inside, KEY), values, band)
    above = (roots.filter("depth > 0").join(complete, KEY).withColumn("band", F.col("depth") - 1).join(paths, ["conv", "band"])
             .select(F.explode("path").alias("up"), *values).select("up.n1", "up.n2", *values))
    return cut(inside.select(*KEY, *values).unionByName(above).groupBy(*KEY).agg(*sums))


def _ends(rows: DataFrame) -> DataFrame:
    """(n1, n2, ends_sha256) of the nodes in which a conversation ends."""
    runs = rows.filter("last").groupBy(*KEY, F.shiftright("conv", RUN_BITS).alias("run")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha = None, None
        for batch in batches:
            done = []
            for n1, n2, ids in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if (n1, n2) == node:
                    sha.update(b"," + ids.encode())
                    continue
                if node is not None:
                    done.append((*node, sha.hexdigest()))
                node, sha = (n1, n2), hashlib.sha256(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=[*KEY, "ends_sha256"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*node, sha.hexdigest())], names=[*KEY, "ends_sha256"])

    return (runs.repartition(*KEY).sortWithinPartitions(*KEY, "run").select(*KEY, "ids")
            .mapInArrow(digest, "n1 long, n2 long, ends_sha256 string"))


def trie(rows: DataFrame, band: int = BAND) -> DataFrame:
    """Per node of the rows of :func:`rebuilt`: conv_id (the smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256, and the node's key (n1, n2)."""
    nodes = rows.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv"), F.max("depth").alias("depth"),
        F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.max("words").alias("words"))
    nodes = cut(nodes)
    children = nodes.filter("depth > 0").groupBy(F.col("p1").alias("n1"), F.col("p2").alias("n2")).agg(
        F.count(F.lit(1)).alias("n_children"))
    nodes = cut(nodes.join(children, KEY, "left").withColumns({
        "n_children": F.coalesce("n_children", F.lit(0).cast("long")),
        "n_leaves": F.col("n_children").isNull().cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("words")}))
    sums = totals(rows.select("conv", "depth", *KEY), nodes.select(*KEY, "conv", "depth", "n_leaves", "saved_tokens"),
                  ["n_leaves", "saved_tokens"], band)

    limit = max(HOT, nodes.count() // HOT_SHARE)
    parents = nodes.select(F.col("n1").alias("p1"), F.col("n2").alias("p2"), F.col("conv").alias("parent_conv_id"), "n_children")
    hot = cut(parents.filter(F.col("n_children") > limit).drop("n_children"))   # fewer than HOT_SHARE rows
    found = nodes.join(F.broadcast(hot), ["p1", "p2"], "left")
    cold = found.filter("parent_conv_id is null").drop("parent_conv_id").join(
        parents.filter((F.col("n_children") > 0) & (F.col("n_children") <= limit)).drop("n_children"), ["p1", "p2"], "left")
    nodes = found.filter("parent_conv_id is not null").unionByName(cold).drop("n_leaves", "saved_tokens")
    nothing = hashlib.sha256(b"").hexdigest()
    return nodes.join(sums, KEY).join(_ends(rows), KEY, "left").select(
        F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"), *KEY)


def oracle_sql(family: int = FAMILY, heads: int = HEADS) -> str:
    """The same nodes in DuckDB; the checksum of the decimal id is taken four bits at a time."""
    # fixed values: the checksum's table for four bits
    table = ("[0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948, "
             "3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108]")
    return f"""
WITH turns AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place,
           coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
    SELECT conv_id, conv_id - conv_id % {family} AS base,
           xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
               string_split(conv_id::VARCHAR, ''), lambda d: [(ord(d) & 15)::BIGINT, (ord(d) >> 4)::BIGINT]))),
               lambda c, x: xor(c >> 4, {table}[(xor(c, x) & 15) + 1]::BIGINT))) % {heads} AS h
    FROM (SELECT DISTINCT conv_id FROM turns)),
said AS (
    SELECT c.conv_id, 0 AS own, t.place, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.place <= c.h
    UNION ALL
    SELECT c.conv_id, 1, t.place, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.place > c.h),
deep AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY own, place) AS depth, text,
           md5(role) || md5(text) AS turn FROM said),
paths AS (
    SELECT conv_id, depth, string_agg(turn, '') OVER (PARTITION BY conv_id ORDER BY depth) AS node,
           len(string_split_regex(trim(text, E' \\t\\n\\x0b\\f\\r'), '[ \\t\\n\\x0b\\f\\r]+'))
           - (trim(text, E' \\t\\n\\x0b\\f\\r') = '')::INT AS words,
           depth = max(depth) OVER (PARTITION BY conv_id) AS last
    FROM deep
    UNION ALL
    SELECT conv_id, 0, '', 0, conv_id NOT IN (SELECT conv_id FROM said) FROM convs),
nodes AS (
    SELECT node, min(conv_id) AS conv_id, any_value(depth) AS depth, count(*) AS n_convs, any_value(words) AS words,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256,
           left(node, greatest(length(node) - 64, 0)) AS up
    FROM paths GROUP BY node),
grown AS (
    SELECT n.*, p.conv_id AS parent_conv_id, coalesce(k.n_children, 0) AS n_children
    FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.node = n.up
    LEFT JOIN (SELECT up, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY up) k ON k.up = n.node),
sums AS (
    SELECT a.node, sum((g.n_children = 0)::BIGINT) AS n_leaves, sum((g.n_convs - 1) * g.words) AS saved_tokens
    FROM grown g JOIN paths a ON a.conv_id = g.conv_id AND a.depth <= g.depth GROUP BY a.node)
SELECT conv_id, depth::BIGINT AS depth, parent_conv_id, n_convs::BIGINT AS n_convs, n_children::BIGINT AS n_children,
       n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, ends_sha256
FROM grown JOIN sums USING (node)"""
