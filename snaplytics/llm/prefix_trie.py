"""Prefix trie of conversations by ROLLUP over positional turn columns.

Turns become ids (a digest of role and text, and the text's bytes). A conversation's ids of
one block of positions stand in columns, and ``GROUP BY key, ROLLUP (t1, ..., tw)`` with
``grouping_id()`` makes the nodes of all depths of that block at once. Conversations that go on
take the node they reached as the key of the next block's columns. A second ROLLUP over
the nodes, from the last block to the first, adds up subtrees; a block's totals by key are
what the block before carries on. Groups are combined before they are shuffled, so a first
turn that a third of all conversations share costs one row per task. The ids of the
conversations that end at a node are sorted by range over all tasks and joined to
long pieces before one task runs a node's pieces through its hash, in a stream.

Cases: a null role or text counts as empty; null turns come first; rows of one conversation
with equal ``turn`` go by digest of role and text, so repeated rows are repeated turns;
rows without ``conv_id`` belong to no conversation and are left out; a
conversation may be turnless after rebuilding, it then ends at the root; texts may have any
length (only digests are grouped); an empty table has no nodes, not even a root; other columns
are not read. Blocks after the first take one round of jobs each, whatever the number of
conversations that reach them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import staged, table

#: Turn columns of the first block, and of the later ones.
FIRST_BLOCK = 8
LATER_BLOCK = 32
#: Ids of one piece of a node's list of conversations.
PIECE = 4096

RESULT = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
          "saved_tokens long, ends_sha256 string")


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), tid: 16 bytes of digest, then the text's bytes as 8 bytes."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    tid = F.unhex(F.concat(F.substring(digest, 1, 32), F.lpad(F.hex(F.octet_length(text).cast("long")), 16, "0")))
    turns = conversations.filter(F.col("conv_id").isNotNull()).select("conv_id", "turn", tid.alias("tid"))
    by_turn = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "tid")
    return turns.select("conv_id", F.row_number().over(by_turn).cast("long").alias("pos"), "tid")


def text_bytes(tid: Column) -> Column:
    return F.conv(F.hex(F.substring(tid, 17, 8)), 16, 10).cast("long")


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From ordered turns: (conv_id, pos, len, tid) of the conversations whose first
    crc32(conv_id) % 9 turns come from conversation conv_id - conv_id % 5, and (conv_id, len)."""
    convs = staged(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("size")), "trie-convs")
    own = convs.select("conv_id", "size", (F.col("conv_id") - F.col("conv_id") % 5).alias("base"),
                       (F.crc32(F.col("conv_id").cast("string")) % 9).alias("h"))
    bases = convs.select(F.col("conv_id").alias("base"), F.col("size").alias("base_size"))
    taken = F.least("h", F.coalesce("base_size", F.lit(0)))
    plan = staged(own.join(bases, "base", "left").select(
        "conv_id", "base", "h", taken.alias("taken"),
        (taken + F.greatest(F.col("size") - F.col("h"), F.lit(0))).alias("len")), "trie-plan")
    first = turns.filter(F.col("pos") <= 8).withColumnRenamed("conv_id", "base") \
        .join(plan, "base").filter(F.col("pos") <= F.col("h")).select("conv_id", "pos", "len", "tid")
    rest = turns.join(plan, "conv_id").filter(F.col("pos") > F.col("h")) \
        .select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "len", "tid")
    return first.unionByName(rest), plan.select("conv_id", "len")


def path_digest(width: int, keep: Column | None = None) -> Column:
    """Digest of the key and the turn columns up to ``keep`` (ids have one length, nulls none)."""
    def part(k: int) -> Column:
        t = F.coalesce(f"t{k}", F.lit(b""))
        return t if keep is None else F.when(keep >= k, t).otherwise(F.lit(b""))
    key = F.unhex(F.lpad(F.hex("key"), 16, "0"))
    return F.unhex(F.substring(F.sha2(F.concat(key, *[part(k) for k in range(1, width + 1)]), 256), 1, 32))


def roll_up(rows: DataFrame, width: int, values: str) -> DataFrame:
    """``values`` for every prefix of the turn columns by key: key, t1.., level and values.
    Groupings whose last column is null belong to shorter conversations and go."""
    columns = ", ".join(f"t{k}" for k in range(1, width + 1))
    real = " OR ".join([f"gid = {2 ** width - 1}"] + [f"(gid = {2 ** (width - k) - 1} AND t{k} IS NOT NULL)" for k in range(1, width + 1)])
    sql = f"""
        SELECT * FROM (SELECT key, {columns}, grouping_id() AS gid, {values}
                       FROM {{rows}} GROUP BY key, ROLLUP ({columns})) WHERE {real}"""
    return rows.sparkSession.sql(sql, rows=rows).withColumn("level", (F.lit(width) - F.bit_count("gid")).cast("long")).drop("gid")


def ends_digests(ends: DataFrame) -> DataFrame:
    """(node, depth, conv_id) -> (node, depth, ends_sha256) of the ids, ascending, comma-joined."""
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            node, ids = None, []
            for batch in batches:
                for n, d, c in zip(*(col.to_pylist() for col in batch.columns)):
                    if (n, d) != node or len(ids) == PIECE:
                        if ids:
                            yield *node, ids[0], ",".join(map(str, ids))
                        node, ids = (n, d), []
                    ids.append(c)
            if ids:
                yield *node, ids[0], ",".join(map(str, ids))
        yield from batched(rows(), ["node", "depth", "first", "ids"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            node, state = None, None
            for batch in batches:
                for n, d, _, ids in zip(*(col.to_pylist() for col in batch.columns)):
                    if (n, d) != node:
                        if state:
                            yield *node, state.hexdigest()
                        node, state = (n, d), hashlib.sha256(ids.encode())
                    else:
                        state.update(b"," + ids.encode())
            if state:
                yield *node, state.hexdigest()
        yield from batched(rows(), ["node", "depth", "ends_sha256"])

    def batched(rows, names, size=10_000):
        part = []
        for row in rows:
            part.append(row)
            if len(part) == size:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in part])
                part = []
        if part:
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in part])

    by_range = ends.select("node", "depth", "conv_id").repartitionByRange("node", "depth", "conv_id") \
        .sortWithinPartitions("node", "depth", "conv_id")
    cut = by_range.mapInArrow(pieces, "node long, depth long, first long, ids string")
    return cut.repartition("node", "depth").sortWithinPartitions("node", "depth", "first") \
        .mapInArrow(digests, "node long, depth long, ends_sha256 string")


def prefix_trie(turns: DataFrame, lengths: DataFrame, first: int = FIRST_BLOCK, later: int = LATER_BLOCK) -> DataFrame:
    """The trie's nodes for conversations given as (conv_id, pos, len, tid) and (conv_id, len)."""
    spark = turns.sparkSession
    longest = lengths.agg(F.max("len")).first()[0]
    if longest is None:
        return spark.createDataFrame([], RESULT)
    block = F.when(F.col("pos") <= first, 0).otherwise(F.floor((F.col("pos") - first - 1) / later) + 1).cast("int")
    place = F.when(F.col("pos") <= first, F.col("pos")).otherwise((F.col("pos") - first - 1) % later + 1)
    cells = staged(turns.select("conv_id", "len", place.alias("place"), "tid", block.alias("block")), "trie-cells", by="block")
    blocks = [(0, first)]
    while sum(blocks[-1]) < longest:
        blocks.append((sum(blocks[-1]), later))

    # down the blocks: nodes, and where each conversation is after the block
    nodes, ends, reached = [], [], None
    for b, (offset, width) in enumerate(blocks):
        here = cells.filter(F.col("block") == b).groupBy("conv_id") \
            .agg(F.max("len").alias("len"), F.array_sort(F.collect_list(F.struct("place", "tid"))).alias("path"))
        path = [F.get("path", F.lit(k))["tid"].alias(f"t{k + 1}") for k in range(width)]
        if b == 0:
            turnless = lengths.filter(F.col("len") == 0).select("conv_id", "len", F.lit(None).cast("array<struct<place:bigint,tid:binary>>").alias("path"))
            here = here.unionByName(turnless).withColumn("key", F.lit(0).cast("long"))
        else:
            here = here.join(reached, "conv_id")
        here = staged(here.select("conv_id", "len", "key", *path), f"trie-paths{b}")
        found = roll_up(here, width, "count(1) AS n_convs, min(conv_id) AS conv_id, max(len) AS deepest")
        if b:
            found = found.filter(F.col("level") > 0)
        last = F.element_at(F.array(F.lit(None).cast("binary"), *[F.col(f"t{k}") for k in range(1, width + 1)]), (F.col("level") + 1).cast("int"))
        made = staged(found.select(
            "*", path_digest(width).alias("pid"), (F.col("deepest") == F.col("level") + offset).cast("long").alias("leaf"),
            (F.coalesce(text_bytes(last), F.lit(0)) * (F.col("n_convs") - 1)).alias("saved")), f"trie-nodes{b}")
        at = here.select("conv_id", (F.col("len") > offset + width).alias("more"), path_digest(width).alias("pid")) \
            .join(made.select("pid", F.col("conv_id").alias("node"), (F.col("level") + offset).alias("depth")), "pid")
        at = staged(at.select("conv_id", "more", "node", "depth"), f"trie-at{b}")
        reached = at.filter("more").select("conv_id", F.col("node").alias("key"))
        ends.append(at.filter(~F.col("more")).select("node", "depth", "conv_id"))
        nodes.append(made)

    # up the blocks: what lies below each node
    results, carried = [], None
    for b in reversed(range(len(blocks))):
        offset, width = blocks[b]
        rows = nodes[b]
        if carried is None:
            rows = rows.withColumns({c: F.lit(0).cast("long") for c in ("c_leaves", "c_saved", "c_children")})
        else:
            full = F.when(F.col("level") == width, F.col("conv_id"))
            rows = rows.join(carried.withColumnRenamed("key", "c_key"), full == F.col("c_key"), "left") \
                .fillna(0, ["c_leaves", "c_saved", "c_children"])
        below = staged(roll_up(rows, width, """
            min(conv_id) AS conv_id, max(n_convs) AS n_convs, sum(leaf + c_leaves) AS n_leaves, sum(saved + c_saved) AS saved_tokens,
            max(c_children) AS c_children""").withColumns({
                "pid": path_digest(width), "parent": path_digest(width, F.col("level") - 1)}).select(
                "pid", "parent", "key", "level", "conv_id", "n_convs", "n_leaves", "saved_tokens", "c_children"), f"trie-below{b}")
        children = below.filter(F.col("level") > 0).groupBy("parent").agg(F.count(F.lit(1)).alias("n"))
        counted = staged(below.join(children.withColumnRenamed("parent", "pid"), "pid", "left").withColumn(
            "n_children", F.when(F.col("level") == width, F.col("c_children")).otherwise(F.coalesce("n", F.lit(0)))), f"trie-counted{b}")
        parents = counted.select(F.col("pid").alias("parent"), F.col("conv_id").alias("p_conv"))
        parent = F.when(F.col("level") > 0, F.col("p_conv") if b == 0 else F.when(F.col("level") == 1, F.col("key")).otherwise(F.col("p_conv")))
        shown = counted if b == 0 else counted.filter(F.col("level") > 0)
        results.append(staged(shown.join(parents, "parent", "left").select(
            "conv_id", (F.col("level") + offset).alias("depth"), parent.alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens"),
            f"trie-results{b}"))
        if b:
            carried = counted.filter(F.col("level") == 0).select(
                "key", F.col("n_leaves").alias("c_leaves"), F.col("saved_tokens").alias("c_saved"), F.col("n_children").alias("c_children"))

    def union(parts: list[DataFrame]) -> DataFrame:
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out
    hashes = ends_digests(union(ends)).withColumnRenamed("node", "conv_id")
    empty = hashlib.sha256(b"").hexdigest()
    return union(results).join(hashes, ["conv_id", "depth"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = staged(ordered_turns(table(spark, sf_dir, "conversations")), "trie-turns")
    return prefix_trie(*rebuilt_turns(turns))


ORACLE = """
WITH t AS (
  SELECT conv_id, turn, octet_length(encode(coalesce(text, ''))) AS bytes,
    sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (
  SELECT conv_id, bytes, digest, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest, bytes) AS pos FROM t),
c AS (
  SELECT conv_id, count(*) AS size, conv_id - conv_id % 5 AS base,
    xor(list_reduce([4294967295::BIGINT] || flatten(list_transform(string_split(conv_id::VARCHAR, ''),
        lambda s: [ascii(s)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
      lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END),
      4294967295::BIGINT) % 9 AS h
  FROM o GROUP BY conv_id),
r AS (
  SELECT c.conv_id, o.pos, o.digest, o.bytes FROM c JOIN o ON o.conv_id = c.base AND o.pos <= c.h
  UNION ALL
  SELECT c.conv_id, o.pos - c.h + least(c.h, coalesce(b.size, 0)), o.digest, o.bytes
  FROM c JOIN o ON o.conv_id = c.conv_id AND o.pos > c.h LEFT JOIN c b ON b.conv_id = c.base),
l AS (
  SELECT c.conv_id, coalesce(list(r.digest ORDER BY r.pos) FILTER (WHERE r.pos IS NOT NULL), []) AS turns,
    coalesce(list(r.bytes ORDER BY r.pos) FILTER (WHERE r.pos IS NOT NULL), []) AS sizes
  FROM c LEFT JOIN r USING (conv_id) GROUP BY c.conv_id),
p AS (
  SELECT conv_id, d, len(turns) = d AS ends, coalesce(sizes[d], 0) AS bytes,
    sha256(array_to_string(turns[1:d], '/')) AS path, sha256(array_to_string(turns[1:d - 1], '/')) AS up
  FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM l)),
n AS (
  SELECT d, path, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(bytes) AS saved,
    bool_and(ends) AS leaf, any_value(up) AS up, sha256(coalesce(string_agg(CASE WHEN ends THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256
  FROM p GROUP BY d, path),
s AS (
  SELECT p.d, p.path, count(*) FILTER (WHERE n.leaf) AS n_leaves, sum(n.saved) AS saved_tokens, count(*) FILTER (WHERE n.d = p.d + 1) AS n_children
  FROM n JOIN p ON p.conv_id = n.conv_id AND p.d <= n.d GROUP BY p.d, p.path)
SELECT n.conv_id, n.d::BIGINT AS depth, m.conv_id AS parent_conv_id, n.n_convs, s.n_children, s.n_leaves,
  s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM n JOIN s ON s.d = n.d AND s.path = n.path LEFT JOIN n m ON n.d > 0 AND m.d = n.d - 1 AND m.path = n.up
"""
