"""Prefix trie of conversations by hashing of fixed-length blocks of turns.

A node of the trie is a sequence of first turns that some conversation has.
Turns are reduced to digests where they are read; texts are never exchanged.

1. Turns get their place in the conversation by one sort over all partitions
   (a conversation may hold any share of the rows).
2. ``BLOCK`` turns make a block.  A block's node is named by the blocks before
   it, their digests tagged with their place and XORed to 128 bits, so the
   names of a long conversation are running sums, taken in segments.
3. Conversations are grouped by block nodes.  Where a node has one successor
   block, all its members go the same way: the turns inside are a chain and
   need no grouping.  Only blocks that have siblings are opened, once per
   distinct block, and grouped turn by turn.
4. A member is *ahead* at a node if it has the node's smallest id.  It stays so
   below, so every conversation is ahead on one stretch down to its end, and
   each node has one conversation ahead.  Sums over a subtree are therefore sums
   over members: leaves are conversations that are ahead at a childless end,
   children are stretches that begin there, and the code points of all nodes
   below are those of the members' stretches.  No walk over the tree is needed.

Rows without conversation id are left out.  Turns stand by number, null first,
those of one number by the digest of role and text; null role and text are
empty.  Equal rows are turns of their own.  An empty table gives no rows.
Names that two different blocks share stop the job (a third hash is compared).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import clean, looked_up, map_arrow, read, scoped, stored

BLOCK = 4
SEGMENT = 256  # blocks of one conversation whose names one task sums up
SPAN = 100  # conversations of so many consecutive ids share a head
HEAD = 6  # ... of fewer turns than this
CHUNK_BITS = 9  # ids of a node are joined to one text in chunks of 2^9
NO_IDS = hashlib.sha256(b"").hexdigest()

KEY = ["d", "a", "b"]
_BEFORE = (W.unboundedPreceding, -1)


def placed_turns(conversations: DataFrame) -> DataFrame:
    """c, p (place from 1), digest, size (code points of the text) of every turn, stored."""
    role, text = (F.coalesce(F.col(x), F.lit("")) for x in ("role", "text"))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))
    rows = clean(conversations, "conv_id", "turn", "role", "text").where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("c"), "turn", digest.alias("digest"), F.char_length(text).cast("long").alias("size"))
    order = [F.col("c").asc(), F.col("turn").asc_nulls_first(), F.col("digest").asc()]
    # equal rows may be many: a number of their own lets them go to several partitions
    rows = rows.repartitionByRange(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *order, F.rand(7))

    def run(batches):
        from pyspark import TaskContext

        part, last, have = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            c = batch.column("c").to_numpy()
            n = len(c)
            if not n:
                continue
            head = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
            rank = np.arange(n) - np.repeat(head, np.diff(np.append(head, n)))
            if c[0] == last:
                rank[:head[1] if len(head) > 1 else n] += have
            last, have = c[-1], int(rank[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column("c"), pa.array(np.full(n, part), pa.int32()), pa.array(rank + 1), batch.column("digest"),
                 batch.column("size")], ["c", "part", "p", "digest", "size"])

    local = stored(map_arrow(rows.sortWithinPartitions(*order).select("c", "digest", "size"), run,
                             "c bigint, part int, p bigint, digest binary, size bigint"), "turns")
    counts = local.groupBy("c", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(W.partitionBy("c").orderBy("part").rowsBetween(*_BEFORE))
    # only the first conversation of a partition can have begun in another: one row per partition at most
    carried = counts.select("c", "part", before.alias("before")).where("before > 0")
    return (local.join(F.broadcast(carried), ["c", "part"], "left")
            .select("c", (F.col("p") + F.coalesce("before", F.lit(0))).alias("p"), "digest", "size"))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (c, d, turns, digest, size) after the heads are exchanged, and conversations (c, turns)."""
    own = turns.groupBy("c").agg(F.count(F.lit(1)).alias("own"))
    h = F.crc32(F.col("c").cast("string").cast("binary")) % HEAD
    heads = (turns.where((F.col("c") % SPAN == 0) & (F.col("p") < HEAD)).groupBy("c")
             .agg(F.sort_array(F.collect_list(F.struct("p", "digest", "size"))).alias("head")).withColumnRenamed("c", "base"))
    size = F.coalesce(F.size("head"), F.lit(0))
    convs = (own.withColumn("h", h).withColumn("base", F.col("c") - F.col("c") % SPAN).join(heads, "base", "left")
             .withColumn("shift", F.least(F.col("h"), F.when(F.col("head").isNull(), 0).otherwise(size)).cast("long"))
             .withColumn("turns", F.col("shift") + F.greatest(F.col("own") - F.col("h"), F.lit(0))))
    convs = stored(convs.select("c", "own", "h", "shift", "turns", F.slice("head", F.lit(1), F.col("h").cast("int")).alias("head")), "conversations")
    borrowed = (convs.select("c", "turns", F.explode("head").alias("t"))
                .select("c", F.col("t.p").alias("d"), "turns", F.col("t.digest").alias("digest"), F.col("t.size").alias("size")))
    mine = looked_up(turns, convs.select("c", "h", "shift", "turns", F.col("own").alias("_n")), ["c"]).where("p > h")
    mine = mine.select("c", (F.col("p") - F.col("h") + F.col("shift")).alias("d"), "turns", "digest", "size")
    return mine.unionByName(borrowed), convs.select("c", "turns")


def _blocks(turns: DataFrame) -> DataFrame:
    """A row per conversation and block: its place k, m turns, the name (pa, pb) of what stands before,
    code points before it, and names a1, b1 ... and sizes l1 ... of the nodes of its turns."""
    at = F.col("d") - 1
    rows = (turns.groupBy("c", "turns", F.floor(at / BLOCK).cast("long").alias("k"))
            .agg(F.sort_array(F.collect_list(F.struct("d", "digest", "size"))).alias("t")).withColumn("m", F.size("t").cast("long")))

    def digests(n):
        return F.concat(*[F.coalesce(F.get("t", F.lit(i))["digest"], F.lit(b"")) for i in range(n)])

    sizes = [F.coalesce(F.get("t", F.lit(i))["size"], F.lit(0)) for i in range(BLOCK)]
    tag = [F.when(F.col("m") == BLOCK, F.xxhash64(F.lit(s), "k", digests(BLOCK))).otherwise(F.lit(0)) for s in (1, 2)]
    rows = rows.select("c", "turns", "k", "m", F.floor(F.col("k") / SEGMENT).alias("seg"), tag[0].alias("xa"), tag[1].alias("xb"),
                       sum(sizes[1:], sizes[0]).alias("l"), *[s.alias(f"l{i + 1}") for i, s in enumerate(sizes)],
                       *[digests(i + 1).alias(f"g{i + 1}") for i in range(BLOCK)])
    inside = W.partitionBy("c", "seg").orderBy("k").rowsBetween(*_BEFORE)
    zero = F.lit(0).cast("long")
    rows = rows.withColumns({"pa": F.coalesce(F.bit_xor("xa").over(inside), zero), "pb": F.coalesce(F.bit_xor("xb").over(inside), zero),
                             "pre": F.coalesce(F.sum("l").over(inside), zero)})
    rows = stored(rows, "blocks-local", compression="zstd")
    long = rows.where(F.col("turns") > BLOCK * SEGMENT)
    if not long.isEmpty():
        sums = long.groupBy("c", "seg").agg(F.bit_xor("xa").alias("xa"), F.bit_xor("xb").alias("xb"), F.sum("l").alias("l"))
        over = W.partitionBy("c").orderBy("seg").rowsBetween(*_BEFORE)
        sums = sums.select("c", "seg", F.bit_xor("xa").over(over).alias("oa"), F.bit_xor("xb").over(over).alias("ob"),
                           F.sum("l").over(over).alias("ol")).where("seg > 0")
        rows = rows.join(sums, ["c", "seg"], "left").withColumns({
            "pa": F.col("pa").bitwiseXOR(F.coalesce("oa", zero)), "pb": F.col("pb").bitwiseXOR(F.coalesce("ob", zero)),
            "pre": F.col("pre") + F.coalesce("ol", zero)})
    names = {}
    for i in range(1, BLOCK + 1):
        for x, s in (("a", 11), ("b", 12)):
            name = (F.xxhash64(F.lit(s), "pa", "pb", F.lit(i), f"g{i}") if i < BLOCK
                    else F.col(f"p{x}").bitwiseXOR(F.col(f"x{x}")))
            names[f"{x}{i}"] = F.when(F.col("m") >= i, name)
    rows = rows.withColumns(names).withColumn("check", F.xxhash64(F.lit(3), "pa", "pb", f"g{BLOCK}"))
    last = {x: F.coalesce(*[F.col(f"{x}{i}") for i in range(BLOCK, 0, -1)]) for x in ("a", "b")}
    return rows.select("c", "turns", "k", "m", last["a"].alias("a"), last["b"].alias("b"), "pa", "pb", "pre", "check",
                       (F.col("turns") == F.col("k") * BLOCK + F.col("m")).alias("last"), (F.col("pre") + F.col("l")).alias("upto"),
                       *names, *[f"l{i}" for i in range(1, BLOCK + 1)])


_INNER = [f"{x}{i}" for x in "abl" for i in range(1, BLOCK + 1)]
_BLOCK_KEY = ["k", "m", "a", "b"]


def block_nodes(blocks: DataFrame) -> DataFrame:
    """Distinct blocks after equal beginnings: n members, the smallest (rep), how many end there, and kids,
    the number of blocks that follow the same beginning."""
    nodes = blocks.groupBy(*_BLOCK_KEY).agg(
        F.count(F.lit(1)).alias("n"), F.min("c").alias("rep"), F.count_if("last").alias("ends"),
        F.min("check").alias("low"), F.max("check").alias("high"), *[F.first(x).alias(x) for x in ("pa", "pb", "pre", *_INNER)])
    sound = F.when(F.col("low") == F.col("high"), F.col("n")).otherwise(
        F.raise_error(F.lit("two blocks of turns under one name")).cast("long"))
    nodes = stored(nodes.withColumn("n", sound).drop("low", "high"), "block-nodes")
    beside = nodes.groupBy("k", "pa", "pb").agg(F.count(F.lit(1)).alias("kids"))
    return stored(looked_up(nodes, beside.withColumn("_n", F.col("kids")), ["k", "pa", "pb"]), "families")


def turn_nodes(nodes: DataFrame, sums: tuple = ()) -> DataFrame:
    """Nodes of single turns (depth d, name a, b): those inside blocks without siblings as
    they are, the others grouped; ``sums`` are columns to be added up over members."""
    def entry(i):
        pre = F.col("pre") + sum((F.col(f"l{j}") for j in range(1, i)), F.lit(0))
        above = [F.col(f"{x}{i - 1}") if i > 1 else F.col(f"p{x}") for x in ("a", "b")]
        ends = F.when(F.col("m") == i, F.col("ends")).otherwise(F.lit(0))
        return F.struct((F.col("k") * BLOCK + i).alias("d"), F.col(f"a{i}").alias("a"), F.col(f"b{i}").alias("b"),
                        above[0].alias("above_a"), above[1].alias("above_b"), pre.alias("pre"), ends.alias("ends"))

    each = nodes.select("n", "rep", "kids", *sums, F.explode(F.slice(F.array(*[entry(i) for i in range(1, BLOCK + 1)]), F.lit(1), F.col("m").cast("int"))).alias("e"))
    each = each.select("n", "rep", "kids", *sums, "e.*")
    columns = [*KEY, "above_a", "above_b", "pre", "n", "rep", "ends", *sums]
    opened = each.where("kids > 1").groupBy(*KEY).agg(
        *[F.first(x).alias(x) for x in ("above_a", "above_b", "pre")], F.min("rep").alias("rep"),
        *[F.sum(x).alias(x) for x in ("n", "ends", *sums)])
    return each.where("kids = 1").select(*columns).unionByName(opened.select(*columns))


def _root(convs: DataFrame, sums: tuple = ()) -> DataFrame:
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    one = convs.agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("rep"), F.count_if(F.col("turns") == 0).alias("ends"),
                    *[F.sum(x).alias(x) for x in sums]).where("n > 0")
    return one.select(zero.alias("d"), zero.alias("a"), zero.alias("b"), none.alias("above_a"), none.alias("above_b"), zero.alias("pre"),
                      "n", "rep", "ends", *sums)


def _end_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 over the ids of each node (d, a, b), ascending, joined by commas: ids are
    joined in chunks of consecutive ids, and the chunks run through the hash one by one."""
    chunk = F.shiftright("c", CHUNK_BITS)
    chunks = ends.groupBy(*KEY, chunk.alias("chunk")).agg(F.array_sort(F.collect_list("c")).alias("ids"))
    chunks = chunks.select(*KEY, "chunk", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))

    def run(batches):
        key, state, done = None, None, []

        def out():
            rows = [(*k, s.hexdigest()) for k, s in done]
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(),) * 3 + (pa.string(),))],
                                              [*KEY, "ends_sha256"])

        for batch in batches:
            for *now, ids in zip(*[batch.column(x).to_pylist() for x in (*KEY, "ids")]):
                if now == key:
                    state.update(b",")
                else:
                    if key is not None:
                        done.append((key, state))
                    key, state = now, hashlib.sha256()
                state.update(ids.encode())
            if done:
                yield out()
        if key is not None:
            done.append((key, state))
            yield out()

    ordered = chunks.repartition(*KEY).sortWithinPartitions(*KEY, "chunk").select(*KEY, "ids")
    return map_arrow(ordered, run, "d bigint, a bigint, b bigint, ends_sha256 string")


@scoped
def trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256."""
    turns, convs = rebuilt(placed_turns(conversations))
    blocks = stored(_blocks(turns), "blocks")
    nodes = block_nodes(blocks)
    tree = stored(turn_nodes(nodes).unionByName(_root(convs)), "nodes")

    # the stretch on which a conversation is ahead: first depth, code points before it, the node above it
    ahead = tree.groupBy("rep").agg(
        F.count(F.lit(1)).alias("_n"), F.min("d").alias("first"), F.min("pre").alias("skip"), F.min_by("above_a", "d").alias("a"),
        F.min_by("above_b", "d").alias("b"), F.max((F.col("n") == F.col("ends")).cast("long")).alias("leaf"))
    ahead = stored(ahead.withColumnRenamed("rep", "c"), "stretches")
    begins = ahead.where("first > 0").select("c", (F.col("first") - 1).alias("d"), "a", "b")
    begun = stored(begins.groupBy(*KEY).agg(F.count(F.lit(1)).alias("begun")), "begun")
    over = begun.join(tree.select(*KEY, F.col("rep").alias("parent")), KEY).withColumnRenamed("begun", "_n")
    parents = looked_up(begins, over, KEY).select("c", "parent")

    sums = ("total", "own", "leaf")
    ends = blocks.where("last").select("c", "turns", F.col("turns").alias("d"), "a", "b", F.col("upto").alias("total"))
    zero = F.lit(0).cast("long")
    known = convs.join(ends.select("c", "total"), "c", "left").join(ahead.drop("a", "b"), "c", "left").join(parents, "c", "left")
    known = stored(known.select("c", "turns", F.coalesce("total", zero).alias("total"), "first", "skip", "parent", F.col("_n").alias("nodes"),
                                F.when(F.col("first").isNull(), zero).otherwise(F.coalesce("total", zero) - F.col("skip")).alias("own"),
                                F.coalesce("leaf", zero).alias("leaf")), "known")

    blocks_of = F.ceil(F.col("turns") / BLOCK)
    added = looked_up(blocks.select("c", *_BLOCK_KEY), known.select("c", *sums, blocks_of.alias("_n")), ["c"])
    added = added.groupBy(*_BLOCK_KEY).agg(*[F.sum(x).alias(x) for x in sums])
    tree = stored(turn_nodes(nodes.join(added, _BLOCK_KEY), sums).unionByName(_root(known, sums)), "summed")

    found = looked_up(tree, known.where("nodes > 0").select(F.col("c").alias("rep"), F.col("turns").alias("rep_turns"), "first", "skip", "parent",
                                                           F.col("nodes").alias("_n")), ["rep"])
    at_end = ends.select(*KEY, "c").unionByName(convs.where("turns = 0").select(zero.alias("d"), zero.alias("a"), zero.alias("b"), "c"))
    found = found.join(begun, KEY, "left").join(_end_digests(at_end), KEY, "left")
    n = F.col("n")
    return found.select(
        F.col("rep").alias("conv_id"), F.col("d").alias("depth"),
        F.when(F.col("d") == F.col("first"), F.col("parent")).otherwise(F.col("rep")).alias("parent_conv_id"), n.alias("n_convs"),
        (F.coalesce("begun", zero) + (F.col("rep_turns") > F.col("d")).cast("long")).alias("n_children"), F.col("leaf").alias("n_leaves"),
        (F.col("total") - F.col("own") - (n - 1) * F.col("pre") - F.col("skip")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NO_IDS)).alias("ends_sha256"))


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(read(spark, sf_dir, "conversations"))


ORACLE_SQL = r"""
WITH bits AS (SELECT list(c ORDER BY n) AS t FROM (
    SELECT n, list_reduce(list_prepend(n, range(8)), lambda c, _: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
    FROM (SELECT unnest(range(256)) AS n))),
rows AS (SELECT CAST(conv_id AS BIGINT) AS c, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
turns AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, sha256(concat(strlen(r), ':', r, x))) AS p, r, x FROM rows),
heads AS (SELECT c, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(1, len(s) + 1), lambda i: CAST(ascii(s[i]) AS BIGINT))),
    lambda v, y: xor(v // 256, t[(xor(v, y) & 255) + 1]))) % 6 AS h
    FROM (SELECT c, CAST(c AS VARCHAR) AS s FROM (SELECT DISTINCT c FROM turns)), bits),
again AS (SELECT heads.c, 0 AS own, p, r, x FROM heads JOIN turns ON turns.c = heads.c - heads.c % 100 AND p <= h
    UNION ALL SELECT heads.c, 1, p, r, x FROM heads JOIN turns ON turns.c = heads.c AND p > h),
seq AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY own, p) AS d, {'r': r, 'x': x} AS y FROM again),
whole AS (SELECT heads.c, coalesce(list(y ORDER BY d) FILTER (d IS NOT NULL), []) AS l FROM heads LEFT JOIN seq USING (c) GROUP BY heads.c),
paths AS (SELECT c, d, list_slice(l, 1, d) AS path, len(l) AS n FROM (SELECT c, l, unnest(range(0, len(l) + 1)) AS d FROM whole)),
nodes AS (SELECT path, d, min(c) AS conv_id, count(*) AS n_convs, string_agg(c, ',' ORDER BY c) FILTER (n = d) AS ids FROM paths GROUP BY path, d),
member AS (SELECT conv_id, nodes.d, c FROM nodes JOIN paths USING (path, d)),
above AS (SELECT k.conv_id, k.d, v.conv_id AS parent FROM nodes k JOIN nodes v ON k.d = v.d + 1 AND list_slice(k.path, 1, k.d - 1) = v.path),
kids AS (SELECT parent AS conv_id, d - 1 AS d, count(*) AS n_children FROM above GROUP BY ALL),
below AS (SELECT m.conv_id, m.d, u.d AS ud, u.n_convs, coalesce(kids.n_children, 0) AS k, CASE WHEN u.d > 0 THEN length(u.path[u.d].x) ELSE 0 END AS size
    FROM member m JOIN nodes u ON u.conv_id = m.c AND u.d >= m.d LEFT JOIN kids ON kids.conv_id = u.conv_id AND kids.d = u.d),
added AS (SELECT conv_id, d, count(*) FILTER (k = 0) AS n_leaves, CAST(sum((n_convs - 1) * size) AS BIGINT) AS saved_tokens FROM below GROUP BY conv_id, d)
SELECT n.conv_id, n.d AS depth, parent AS parent_conv_id, n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens,
       sha256(coalesce(ids, '')) AS ends_sha256
FROM nodes n JOIN added USING (conv_id, d) LEFT JOIN above USING (conv_id, d) LEFT JOIN kids USING (conv_id, d)
"""
