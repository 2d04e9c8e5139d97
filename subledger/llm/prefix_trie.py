"""Conversation prefix trie by ROLLUP over positional turn columns.

A node is a distinct sequence of first turns. Every conversation is cut into
blocks of ``WIDTH`` turns; one ROLLUP over a block's turn columns aggregates
all prefixes that end in it, and the block is keyed by the node that the
blocks before it end in. Sums over subtrees follow by pointer doubling: the
number of rounds is the logarithm of the longest conversation.

Turns are known by two 64-bit hashes of position, role and text. A node is
known by the exclusive or of its turns' hashes, so the key of a prefix is an
aggregate too, and no conversation has to be gathered to compute it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subledger.llm.columns import col, text_of
from subledger.session import scratch_path

#: Turns of a block, each a column of the rollup.
WIDTH = 8
#: Blocks whose hashes one task adds up in order; a longer conversation is split.
CHUNK_BLOCKS = 1024
#: Conversation ids that one chunk of text holds before it is hashed.
CHUNK_IDS = 4096
#: Characters of a text that partition borders are made of; the sort looks at all.
BORDER_CHARS = 32
NODE = ["node_a", "node_b"]


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again, which cuts its lineage."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def numbered_turns(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``(conv_id, position, id_a, id_b, chars)`` of every turn, numbered from 1.

    Turns are ordered by ``turn`` (null first), equal ones by role and text;
    repeated rows are turns of their own. A null role or text is empty, a row
    without a conversation id is left out. An empty table gives no rows; other
    columns don't matter.

    A conversation may span many partitions: rows are dealt by range, numbered
    within their partition, and moved on by the rows of the partitions before.
    """
    rows = df.select(
        col(conv).cast("long").alias("conv_id"),
        col(turn).alias("turn"),
        text_of(role).alias("role"),
        text_of(text).alias("text"),
        F.monotonically_increasing_id().alias("row"),
    ).where("conv_id IS NOT NULL")
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), "role"]
    ranged = rows.repartitionByRange(*order, F.left("text", F.lit(BORDER_CHARS)), "row")
    placed = stored(
        ranged.sortWithinPartitions(*order, "text", "row").select(
            "conv_id",
            F.monotonically_increasing_id().alias("place"),
            F.xxhash64("role", "text").alias("hash_a"),
            F.xxhash64(F.lit(1), "text", "role").alias("hash_b"),
            F.length("text").cast("long").alias("chars"),
        ),
        "turns",
    ).withColumn("part", F.shiftrightunsigned("place", 33))
    # Each border between partitions cuts one conversation at most, so these are at most as many as partitions.
    counts = placed.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    moved = counts.withColumn("before", F.sum("n").over(before)).where("before IS NOT NULL").drop("n")
    first = F.min("place").over(Window.partitionBy("conv_id", "part"))
    within = placed.withColumn("within", F.col("place") - first)
    numbered = within.join(F.broadcast(moved), ["conv_id", "part"], "left")
    position = F.col("within") + F.coalesce("before", F.lit(0)) + 1
    return numbered.select("conv_id", position.alias("position"), "hash_a", "hash_b", "chars")


def blocks_of(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """A row for each conversation and block: its turns, and the key of the node before it.

    Conversations of ``convs`` without a turn have one block without turns.
    """
    at = F.col("position")
    tagged = turns.select(
        "conv_id",
        F.floor((at - 1) / WIDTH).alias("block"),
        F.struct(
            at,
            F.xxhash64("position", "hash_a", "hash_b").alias("a"),
            F.xxhash64("hash_b", "position", "hash_a").alias("b"),
            "chars",
        ).alias("turn"),
    )
    full = tagged.groupBy("conv_id", "block").agg(
        F.array_sort(F.collect_list("turn")).alias("turns"),  # WIDTH at most
        F.bit_xor("turn.a").alias("xor_a"),
        F.bit_xor("turn.b").alias("xor_b"),
    )
    bare = convs.select("conv_id").join(turns.select("conv_id").where("position = 1"), "conv_id", "left_anti")
    zero = F.lit(0).cast("long")
    empty = bare.select(
        "conv_id", zero.alias("block"), F.array().cast(full.schema["turns"].dataType).alias("turns"),
        zero.alias("xor_a"), zero.alias("xor_b"),
    )
    full = stored(full.unionByName(empty), "blocks")
    chunked = full.withColumn("chunk", F.floor(F.col("block") / CHUNK_BLOCKS))
    chunks = chunked.groupBy("conv_id", "chunk").agg(F.bit_xor("xor_a").alias("a"), F.bit_xor("xor_b").alias("b"))
    earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select(
        "conv_id", "chunk", *(F.coalesce(F.bit_xor(c).over(earlier), zero).alias(f"before_{c}") for c in "ab")
    ).where("chunk > 0")
    within = Window.partitionBy("conv_id", "chunk").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    running = chunked.select(
        "*", *(F.coalesce(F.bit_xor(f"xor_{c}").over(within), zero).alias(f"within_{c}") for c in "ab")
    ).join(chunks, ["conv_id", "chunk"], "left")
    prior = (F.col(f"within_{c}").bitwiseXOR(F.coalesce(f"before_{c}", zero)).alias(f"prior_{c}") for c in "ab")
    return running.select("conv_id", "block", "turns", "xor_a", "xor_b", *prior)


def nodes_of(blocks: DataFrame) -> DataFrame:
    """All nodes by one ROLLUP: key, depth, key of the parent, members and their smallest id.

    The rollup's last column that isn't rolled up is the node's last turn; a
    conversation that ended before it makes no node.
    """
    names = [f"t{i}" for i in range(1, WIDTH + 1)]
    turn = F.transform("turns", lambda t: F.struct(t["a"].alias("a"), t["b"].alias("b"), t["chars"].alias("chars")))
    wide = blocks.withColumn("turns", turn).select(
        "conv_id", "block", "prior_a", "prior_b", *(F.get("turns", F.lit(i)).alias(n) for i, n in enumerate(names))
    )
    listed = ", ".join(names)
    grouped = blocks.sparkSession.sql(
        f"""
        SELECT block, prior_a, prior_b, {listed}, {WIDTH} - bit_count(grouping_id()) AS used,
               count(*) AS n_convs, min(conv_id) AS conv_id
        FROM {{wide}} GROUP BY block, prior_a, prior_b, ROLLUP ({listed})
        """,
        wide=wide,
    )
    last = F.get(F.array(*names), F.col("used") - 1)

    def key(part: str) -> Column:
        out = F.col(f"prior_{part}")
        for name in names:
            out = out.bitwiseXOR(F.coalesce(F.col(name)[part], F.lit(0).cast("long")))
        return out

    real = grouped.withColumn("last", last).where("last IS NOT NULL OR (used = 0 AND block = 0)")
    keyed = real.select("*", key("a").alias("node_a"), key("b").alias("node_b"))
    return keyed.select(
        *NODE,
        (F.col("block") * WIDTH + F.col("used")).cast("long").alias("depth"),
        F.col("node_a").bitwiseXOR(F.col("last.a")).alias("up_a"),
        F.col("node_b").bitwiseXOR(F.col("last.b")).alias("up_b"),
        "conv_id",
        "n_convs",
        F.coalesce("last.chars", F.lit(0)).alias("chars"),
    )


def subtree_sums(nodes: DataFrame, values: list[str]) -> DataFrame:
    """``(node_a, node_b, *values)``, each value summed over the node's subtree.

    After round i a node holds the sum over its descendants less than 2^i
    below it and points to its ancestor 2^i above; the next round adds what
    those that point to it hold. Rounds are the logarithm of the depth.
    """
    deepest = nodes.agg(F.max("depth")).first()[0] or 0  # one number
    state = nodes.select(*NODE, "depth", "up_a", "up_b", *values)
    step = 1
    while step <= deepest:
        below = state.where(f"depth >= {step}")
        added = below.groupBy(F.col("up_a").alias("node_a"), F.col("up_b").alias("node_b")).agg(
            *(F.sum(v).alias(f"more_{v}") for v in values)
        )
        # The ancestor of an ancestor, for those that have one.
        jumps = state.where(f"depth >= {step}").select(
            F.col("node_a").alias("up_a"), F.col("node_b").alias("up_b"),
            F.col("up_a").alias("far_a"), F.col("up_b").alias("far_b"),
        )
        far = below.where(f"depth >= {2 * step}").select(*NODE, "up_a", "up_b").join(jumps, ["up_a", "up_b"])
        state = stored(
            state.drop("up_a", "up_b")
            .join(added, NODE, "left")
            .join(far.select(*NODE, F.col("far_a").alias("up_a"), F.col("far_b").alias("up_b")), NODE, "left")
            .select(
                *NODE, "depth", "up_a", "up_b",
                *((F.col(v) + F.coalesce(f"more_{v}", F.lit(0))).alias(v) for v in values),
            ),
            "sums",
        )
        step *= 2
    return state.select(*NODE, *values)


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ``(node, conversation)`` rows to comma-joined pieces of bounded length."""
    names = [*NODE, "first", "ids"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    out: list[tuple] = []
    node, ids = None, []

    def close() -> None:
        if ids:
            out.append((*node, ids[0], ",".join(map(str, ids))))
            ids.clear()

    for a, b, conv in _rows_of(batches):
        if (a, b) != node or len(ids) == CHUNK_IDS:
            close()
            node = (a, b)
        ids.append(conv)
        if len(out) >= 1024:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
            out.clear()
    close()
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces to one digest a node; a piece at a time is held."""
    names, types = [*NODE, "ends_sha256"], [pa.int64(), pa.int64(), pa.string()]
    out: list[tuple] = []
    node, state = None, None
    for a, b, _, ids in _rows_of(batches):
        if (a, b) == node:
            state.update(b"," + ids.encode())
            continue
        if node is not None:
            out.append((*node, state.hexdigest()))
        node, state = (a, b), hashlib.sha256(ids.encode())
        if len(out) >= 4096:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
            out.clear()
    if node is not None:
        out.append((*node, state.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)


def end_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ascending comma-joined ids of the conversations that end in a node.

    A node in which very many end is cut into pieces by range; only the joined
    pieces meet, and pass through the hash one after another.
    """
    order = [*NODE, "conv_id"]
    dealt = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = dealt.mapInArrow(_chunks, "node_a long, node_b long, first long, ids string")
    met = pieces.repartition(*NODE).sortWithinPartitions(*NODE, "first")
    return met.mapInArrow(_digests, "node_a long, node_b long, ends_sha256 string")


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row for each node of the trie of conversations.

    ``turns`` are rows as :func:`numbered_turns` makes them, positions without
    gaps from 1; ``convs`` holds the id of every conversation once, also of
    those without turns, which are members of the root alone. Without any
    conversation there is no node. Equal conversations share all their nodes;
    extra columns of either input don't matter.

    Columns: the node's key (``node_a``, ``node_b``), ``conv_id`` (smallest
    member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` (over the subtree, for every member but one
    the code points of the node's last turn), ``ends_sha256``.
    """
    blocks = stored(blocks_of(turns, convs), "blocks")
    nodes = stored(nodes_of(blocks), "nodes")
    ends = blocks.groupBy("conv_id").agg(F.bit_xor("xor_a").alias("node_a"), F.bit_xor("xor_b").alias("node_b"))
    children = nodes.where("depth > 0").groupBy(F.col("up_a").alias("node_a"), F.col("up_b").alias("node_b"))
    counted = nodes.join(children.agg(F.count("*").alias("n_children")), NODE, "left").fillna(0, ["n_children"])
    counted = stored(
        counted.withColumns(
            {
                "n_leaves": F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long"),
                "saved_tokens": (F.col("n_convs") - 1) * F.col("chars"),
            }
        ),
        "nodes",
    )
    values = ["n_leaves", "saved_tokens"]
    parents = nodes.select(
        F.col("node_a").alias("up_a"), F.col("node_b").alias("up_b"), F.col("conv_id").alias("parent_conv_id")
    )
    return (
        counted.drop(*values)
        .join(subtree_sums(counted, values), NODE)
        .join(parents, ["up_a", "up_b"], "left")
        .join(end_digests(ends), NODE, "left")
        .select(
            *NODE, "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", *values,
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )


def rebuilt(turns: DataFrame, family: int, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations that start as the first of their family does, and all conversation ids.

    Conversation c starts with the first h turns of conversation c - c % family
    (all if it has fewer, none if it is absent), and goes on with its own turns
    after its first h; h is the CRC-32 of c's decimal form modulo ``most``.
    """
    heads = (
        turns.where(f"conv_id % {family} = 0 AND position < {most}")
        .groupBy(F.col("conv_id").alias("base"))
        .agg(F.array_sort(F.collect_list(F.struct("position", "hash_a", "hash_b", "chars"))).alias("head"))
    )
    ids = turns.where("position = 1").select("conv_id")
    given = ids.withColumns(
        {
            "taken": F.crc32(F.col("conv_id").cast("string")) % most,
            "base": F.col("conv_id") - F.col("conv_id") % family,
        }
    ).join(heads, "base", "left")
    head = F.slice("head", F.lit(1), F.col("taken").cast("int"))
    given = stored(given.select("conv_id", "taken", F.coalesce(head, F.slice("head", 1, 0)).alias("head")), "heads")
    first = given.select("conv_id", F.inline("head"))
    kept = given.select("conv_id", "taken", F.coalesce(F.size("head"), F.lit(0)).alias("n_head"))
    kept = kept.withColumn("n_head", F.greatest("n_head", F.lit(0)))
    own = turns.join(kept, "conv_id").where("position > taken")
    own = own.withColumn("position", F.col("position") - F.col("taken") + F.col("n_head")).select(first.columns)
    return stored(first.unionByName(own), "rebuilt"), ids
