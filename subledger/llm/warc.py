"""WARC fixity: Merkle trees over offset ranges, compared from the roots down."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subledger.llm.columns import col
from subledger.session import shared_dir

#: Bytes of a file that one leaf covers, and children of an inner node.
LEAF_BYTES, FANOUT = 1 << 16, 16
#: Entries without an offset that one leaf covers.
LOOSE_ENTRIES = 256


def hashed_records(df: DataFrame, content: Column, keep: Sequence[str]) -> DataFrame:
    """The ``keep`` columns with ``length`` and ``digest`` of each record's
    bytes; a null record has no bytes. One narrow pass: contents go no further."""
    data = F.coalesce(content.cast("binary"), F.lit(b""))
    return df.select(*(col(c) for c in keep), F.octet_length(data).cast("long").alias("length"), F.sha2(data, 256).alias("digest"))


def _node(leaf_bytes: int, groups: int) -> Column:
    """The leaf of an entry: its range of offsets, or without an offset one of so many groups by digest."""
    loose = -1 - F.pmod(F.xxhash64("length", "digest"), F.lit(groups))
    return F.when(F.col("offset").isNull(), loose).otherwise(F.floor(F.col("offset") / F.lit(leaf_bytes)))


def _leaves(manifest: DataFrame, leaf_bytes: int, groups: int) -> DataFrame:
    """A node for each range of offsets that holds records.

    Equal entries are counted before they meet, so repeated rows don't pile up
    in a node, and the count is part of the hash.
    """
    rows = manifest.groupBy("file", "offset", "length", "digest").agg(F.count(F.lit(1)).alias("n"))
    entries = F.sort_array(F.collect_list(F.struct("offset", "length", "digest", "n")))
    line = F.transform(entries, lambda e: F.concat_ws(":", e["offset"], e["length"], e["digest"], e["n"]))
    node = _node(leaf_bytes, groups).alias("node")
    return rows.groupBy("file", node).agg(F.sha2(F.array_join(line, "\n"), 256).alias("hash"))


def _parents(nodes: DataFrame, fanout: int) -> DataFrame:
    children = F.sort_array(F.collect_list(F.struct("node", "hash")))
    line = F.transform(children, lambda c: F.concat_ws(":", c["node"], c["hash"]))
    up = F.floor(F.col("node") / F.lit(fanout)).alias("node")
    return nodes.groupBy("file", up).agg(F.sha2(F.array_join(line, "\n"), 256).alias("hash"))


def merkle_tree(
    manifest: DataFrame, levels: int, leaf_bytes: int = LEAF_BYTES, fanout: int = FANOUT, groups: int = 1
) -> list[DataFrame]:
    """Levels of nodes ``(file, node, hash)`` from the leaves to the roots.

    A node has at most ``fanout`` children and a leaf the records of one range,
    so a file of any size is hashed by many tasks.
    """
    tree = [_leaves(manifest, leaf_bytes, groups).checkpoint()]
    while len(tree) < levels:
        tree.append(_parents(tree[-1], fanout).checkpoint())
    return tree


def _differing(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    a = ours.select("file", "node", F.col("hash").alias("a"))
    b = theirs.select("file", "node", F.col("hash").alias("b"))
    return a.join(b, ["file", "node"], "full").where(~F.col("a").eqNullSafe(F.col("b"))).select("file", "node")


def audit(ours: DataFrame, theirs: DataFrame, leaf_bytes: int = LEAF_BYTES, fanout: int = FANOUT) -> DataFrame:
    """Records in which two replicas differ: ``file``, ``offset``, ``record``,
    ``kind`` (changed, missing in theirs, extra in theirs) and both digests.

    Both sides are manifests ``(file, offset, record, length, digest)``. Roots
    are compared first, and a level is read only below nodes that differ. A
    null file is the empty one. Entries that differ at one offset are paired
    in the order of their length and digest and are changed; what is left over
    is missing or extra, and so is every entry without an offset, as nothing
    says which it would have been. An entry that one replica repeats more
    often is changed as well; without an offset it is missing or extra once.
    Empty sides are allowed.
    """
    shared_dir(ours.sparkSession)
    sides = []
    for side in (ours, theirs):
        file = F.coalesce(F.col("file").cast("string"), F.lit(""))
        sides.append(side.withColumns({"file": file, "offset": F.col("offset").cast("long")}).checkpoint())
    measured = [s.agg(F.max("offset"), F.count_if(F.col("offset").isNull())).first() for s in sides]
    last = max(m[0] or 0 for m in measured)
    groups = max(1, max(m[1] for m in measured) // LOOSE_ENTRIES)
    levels, width = 1, last // leaf_bytes + 1
    while width > 1:
        levels, width = levels + 1, -(-width // fanout)
    a, b = (merkle_tree(s, levels, leaf_bytes, fanout, groups) for s in sides)
    open_ = _differing(a[-1], b[-1])
    for level in range(levels - 2, -1, -1):
        above = open_.select("file", F.col("node").alias("up")).checkpoint()
        up = F.floor(F.col("node") / F.lit(fanout)).alias("up")
        below = [t.select("*", up).join(above, ["file", "up"], "left_semi") for t in (a[level], b[level])]
        open_ = _differing(*below)
    ranges = open_.checkpoint()
    found = []
    for side, mark in zip(sides, "ab", strict=True):
        rows = side.select("*", _node(leaf_bytes, groups).alias("node")).join(ranges, ["file", "node"], "left_semi")
        found.append(rows.groupBy("file", "offset", "length", "digest").agg(
            F.min("record").alias(f"r{mark}"), F.count(F.lit(1)).alias(f"n{mark}")
        ))
    same = F.col("l.file").eqNullSafe(F.col("r.file")) & F.col("l.offset").eqNullSafe(F.col("r.offset"))
    same = same & F.col("l.length").eqNullSafe(F.col("r.length")) & (F.col("l.digest") == F.col("r.digest"))
    both = found[0].alias("l").join(found[1].alias("r"), same, "full").where("na IS NULL OR nb IS NULL OR na <> nb")
    own = (F.coalesce(f"l.{c}", f"r.{c}").alias(c) for c in ("file", "offset", "length", "digest"))
    more = F.coalesce("na", F.lit(0)) > F.coalesce("nb", F.lit(0))
    odd = both.select(
        *own, F.coalesce("ra", "rb").alias("record"), more.alias("ours"), (F.col("na").isNotNull() & F.col("nb").isNotNull()).alias("both")
    ).checkpoint()
    # Entries of one offset, which are few, are paired by their place among them.
    place = F.row_number().over(Window.partitionBy("file", "offset", "ours").orderBy("length", "digest"))
    placed = odd.where("offset IS NOT NULL AND NOT both").withColumn("place", place)
    left = placed.where("ours").select("file", "offset", "place", F.col("digest").alias("digest_a"), F.col("record").alias("ra"))
    right = placed.where("NOT ours").select("file", "offset", "place", F.col("digest").alias("digest_b"), F.col("record").alias("rb"))
    met = left.join(right, ["file", "offset", "place"], "full").withColumn("record", F.coalesce("ra", "rb"))
    loose = odd.where("offset IS NULL").select(
        "file", "offset", "record", F.when(F.col("ours"), F.col("digest")).alias("digest_a"),
        F.when(~F.col("ours"), F.col("digest")).alias("digest_b"),
    )
    repeated = odd.where("offset IS NOT NULL AND both").select(
        "file", "offset", "record", F.col("digest").alias("digest_a"), F.col("digest").alias("digest_b")
    )
    listed = met.select("file", "offset", "record", "digest_a", "digest_b").unionByName(loose).unionByName(repeated)
    kind = F.when(F.col("digest_b").isNull(), "missing").when(F.col("digest_a").isNull(), "extra").otherwise("changed")
    return listed.select("file", "offset", "record", kind.alias("kind"), "digest_a", "digest_b")
