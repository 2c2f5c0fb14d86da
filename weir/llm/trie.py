"""The prefix trie of conversations, by collapsing whole sequences.

1. *Sequences.*  Every conversation is rebuilt and named by a fingerprint of
   its turns; identical ones become one weighted sequence, with the list of the
   conversations that end there.
2. *Leaves.*  A sequence that is a proper prefix of another goes by anti-join;
   what stays are the leaves of the trie.
3. *Prefixes.*  Each sequence gives its prefixes to an aggregate by prefix,
   with its weight.  Members, leaves and saved bytes of a node all are sums over
   the sequences that pass through it:

   ``sum over the subtree of n_convs * bytes`` is the sum of weight times the
   bytes from the node on; ``sum over the subtree of bytes``, each node once,
   is the same over the sequence that *owns* the node, that with the node's
   smallest conversation.  A sequence owns all its nodes from some depth on.

Texts don't move: turns are 128-bit digests from the scan on, prefixes the
exclusive-or of digests of (depth, turn).  Turns are numbered over range
partitions, so a conversation of any length spreads over several tasks; all
other groups are aggregated before they are shuffled.  Only the digest of a
node's end list is sequential by nature: ids come to it joined in blocks of a
range of ids, in order, and it runs over them in bounded memory.

Defined cases: rows without a conv_id are no conversation's; null roles and
texts are empty ones; ties in turn are ordered by the digest of role and text
(repeated rows are turns each); a null turn comes first; an empty table has no
node, not even the root; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weir.llm.common import written

#: A conversation starts with up to SHARED - 1 turns of the first of its GROUP.
GROUP, SHARED = 5, 9
#: Ids joined into one piece of text before a digest is taken over the pieces.
ID_RANGE = 4096
#: A node with one in so many of all children is broadcast to them; there can be no more than that.
HOT_SHARE = 1024


def _halves(text: Column) -> list[Column]:
    """The 128 bits of an MD5 as two longs."""
    digest = F.md5(text)
    return [F.conv(F.substring(digest, at, 16), 16, -10).cast("long") for at in (1, 17)]


def _running(df: DataFrame, key: str, order: list[str], sums: dict[str, Column], name: str) -> DataFrame:
    """``df`` with running aggregates (``sums``: name to an aggregate, sum or xor) per ``key`` in ``order``.

    Rows lie in range partitions of (key, order); each has running values of its
    own, and what the earlier partitions of a key come to is added.
    """
    spread = (df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(key, *order, "_tie")
              .withColumn("_part", F.spark_partition_id()))
    sorted_ = written(spread, name)
    inside = Window.partitionBy(key, "_part").orderBy(*order, "_tie")
    local = sorted_.select("*", *[agg.over(inside.rowsBetween(Window.unboundedPreceding, 0)).alias(f"_{c}") for c, agg in sums.items()])
    earlier = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = sorted_.groupBy(key, "_part").agg(*[agg.alias(f"_t_{c}") for c, agg in sums.items()])
    # only keys that lie in several partitions have anything before
    before = (totals.select(key, "_part", *[_merge(c, F.col(f"_t_{c}")).over(earlier).alias(f"_b_{c}") for c in sums])
              .where(F.coalesce(*[F.col(f"_b_{c}").isNotNull() for c in sums])))
    joined = local.join(before, [key, "_part"], "left")
    out = []
    for c in sums:
        own, ahead = F.col(f"_{c}"), F.coalesce(F.col(f"_b_{c}"), F.lit(0).cast("long"))
        out.append((own.bitwiseXOR(ahead) if c.startswith("x") else own + ahead).alias(c))
    return joined.select(*df.columns, *out)


def _merge(name: str, value: Column) -> Column:
    return F.bit_xor(value) if name.startswith("x") else F.sum(value)


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((conv_id, depth, a, b, bytes) of the rebuilt turns from 1 on, (conv_id) of all conversations)."""
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        # the length keeps role and text apart
        F.concat_ws(":", F.char_length(role), F.concat(role, text)).alias("said"),
        F.octet_length(text).cast("long").alias("bytes"))
    turns = turns.select("conv_id", "turn", *[h.alias(c) for h, c in zip(_halves(F.col("said")), "ab", strict=True)], "bytes")
    placed = written(_running(turns, "conv_id", ["turn", "a", "b"], {"pos": F.count(F.lit(1))}, "trie-turns"), "trie-placed")

    heads = (placed.where(F.col("pos") < SHARED).groupBy("conv_id")
             .agg(F.sort_array(F.collect_list(F.struct("pos", "a", "b", "bytes"))).alias("head")))
    c = F.col("conv_id")
    convs = placed.select("conv_id").distinct().select(
        "conv_id", (c - c % GROUP).alias("base"), (F.crc32(c.cast("string").cast("binary")) % SHARED).cast("int").alias("h"))
    shared = (convs.join(heads.withColumnRenamed("conv_id", "base"), "base", "left")
              .select("conv_id", "h", F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.array()).alias("head")))
    shared = written(shared.withColumn("k", F.size("head")), "trie-shared")
    ahead = (shared.select("conv_id", F.explode("head").alias("t"))
             .select("conv_id", F.col("t.pos").alias("depth"), "t.a", "t.b", "t.bytes"))
    own = (placed.join(shared.select("conv_id", "h", "k"), "conv_id").where("pos > h")
           .select("conv_id", (F.col("pos") - F.col("h") + F.col("k")).alias("depth"), "a", "b", "bytes"))
    return ahead.unionByName(own), shared.select("conv_id")


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's ids, which come in order, a piece at a time."""
    now, digest = None, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([v], pa.int64()) for v in now] + [pa.array([digest.hexdigest()])], ["x1", "x2", "depth", "ends_sha256"])

    for batch in batches:
        for *node, ids in zip(*(batch.column(c).to_pylist() for c in ("x1", "x2", "depth", "ids")), strict=True):
            if node != now:
                if now:
                    yield done()
                now, digest = node, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
    if now:
        yield done()


NODE = ["x1", "x2", "depth"]


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256): a row per node."""
    turns, convs = rebuilt(conversations)
    # two independent digests of (depth, turn): their exclusive-or up to a depth names the prefix
    salted = turns.select("conv_id", "depth", "bytes", F.xxhash64("depth", "a", "b").alias("t1"),
                          F.xxhash64(F.lit(1), "b", "depth", "a").alias("t2"))
    paths = written(_running(salted, "conv_id", ["depth"],
                             {"x1": F.bit_xor("t1"), "x2": F.bit_xor("t2"), "upto": F.sum("bytes")}, "trie-rebuilt"), "trie-paths")

    # 1. sequences, with their weight, and where each conversation ends
    last = F.max(F.struct("depth", "x1", "x2", "upto"))
    of_conv = paths.groupBy("conv_id").agg(last.alias("end"))
    zero = F.lit(0).cast("long")
    ends = written(convs.join(of_conv, "conv_id", "left").select(
        "conv_id", *[F.coalesce(f"end.{f}", zero).alias(f) for f in ("x1", "x2", "depth", "upto")]), "trie-ends")
    sequences = written(ends.groupBy(*NODE, "upto").agg(F.count(F.lit(1)).alias("weight"), F.min("conv_id").alias("conv_id")), "trie-sequences")

    # 2. the prefixes of every sequence, the root among them; leaves are no other's proper prefix
    weighted = sequences.select("conv_id", "weight", F.col("depth").alias("length"), F.col("upto").alias("whole"))
    root = weighted.select("*", zero.alias("x1"), zero.alias("x2"), zero.alias("depth"), zero.alias("bytes"), zero.alias("upto"),
                           F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2"))
    # the prefix before is the same without the last turn's digests
    named = paths.select("conv_id", "depth", "x1", "x2", "bytes", "upto", F.col("x1").bitwiseXOR(F.col("t1")).alias("p1"),
                         F.col("x2").bitwiseXOR(F.col("t2")).alias("p2"))
    prefixes = written(root.unionByName(named.join(weighted, "conv_id")), "trie-prefixes")
    inner = prefixes.where("depth < length").select(*NODE).distinct()
    leaves = sequences.select(*NODE, "conv_id").join(inner, NODE, "left_anti").select("conv_id", F.lit(1).cast("long").alias("leaf"))

    # 3. nodes: weighted prefixes, then the depth from which each sequence owns its nodes
    nodes = written(prefixes.groupBy(*NODE).agg(F.sum("weight").alias("n_convs"), F.min("conv_id").alias("conv_id"),
                                                F.first("p1").alias("p1"), F.first("p2").alias("p2")), "trie-nodes")
    owners = nodes.groupBy("conv_id").agg(F.min("depth").alias("owned_from"))
    marks = written(weighted.select("conv_id").join(owners, "conv_id", "left").join(leaves, "conv_id", "left"), "trie-marks")
    # bytes of the sequence's nodes before the first that it owns
    unowned = (prefixes.join(marks.select("conv_id", "owned_from"), "conv_id").where("depth = owned_from")
               .select("conv_id", (F.col("upto") - F.col("bytes")).alias("unowned")))
    marked = prefixes.join(marks.join(unowned, "conv_id", "left"), "conv_id")
    from_here = F.col("whole") - F.col("upto") + F.col("bytes")
    owned = F.when(F.col("unowned").isNotNull(), F.col("whole") - F.greatest(F.col("upto") - F.col("bytes"), F.col("unowned"))).otherwise(zero)
    sums = marked.groupBy(*NODE).agg(F.sum(F.col("weight") * from_here - owned).alias("saved_tokens"),
                                     F.coalesce(F.sum("leaf"), zero).alias("n_leaves"))

    listed = (ends.groupBy(*NODE, F.floor(F.col("conv_id") / ID_RANGE).alias("piece"))
              .agg(F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
              .repartition(*NODE).sortWithinPartitions(*NODE, "piece").select(*NODE, "ids")
              .mapInArrow(_ends, "x1 long, x2 long, depth long, ends_sha256 string"))
    children = (nodes.where("depth > 0").groupBy(F.col("p1").alias("x1"), F.col("p2").alias("x2"), (F.col("depth") - 1).alias("depth"))
                .agg(F.count(F.lit(1)).alias("n_children")))
    none = hashlib.sha256(b"").hexdigest()
    found = written(nodes.join(sums, NODE).join(children, NODE, "left").join(listed, NODE, "left").select(
        "conv_id", *NODE, "p1", "p2", "n_convs", F.coalesce("n_children", zero).alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256")), "trie-found")
    return _with_parents(found)


def _with_parents(found: DataFrame) -> DataFrame:
    """Each node with its parent's conv_id; parents of very many children are sent to them."""
    parents = found.where("n_children > 0").select(
        F.col("x1").alias("p1"), F.col("x2").alias("p2"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    total = parents.agg(F.sum("n_children")).first()[0] or 0
    key = ["p1", "p2", "depth"]
    hot = F.col("n_children") * HOT_SHARE >= total
    most = F.broadcast(parents.where(hot).drop("n_children"))
    below = found.where("depth > 0")
    rest = below.join(F.broadcast(parents.where(hot).select(*key)), key, "left_anti").join(parents.where(~hot).drop("n_children"), key)
    whole = below.join(most, key).unionByName(rest).unionByName(
        found.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long")))
    return whole.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
