"""Operator 12: the prefix trie of conversations, by truncation peeling.

A node of depth d is a distinct sequence of the first d turns (role and text) of
some conversation.  The trie is peeled from its deepest nodes up: a node merges
the conversations that end there with its surviving children, its last turn is
stripped, and it meets its siblings under the remaining turns.

1. Every conversation's prefixes get chained digests, in one pass over its turns in
   order; texts are not shuffled, only their digest and number of words.
2. One grouping of the digests, combined before the shuffle, discovers the nodes
   and their members.
3. Nodes of one path with equally many members have the same members: between
   them nothing ends and nothing meets.  Such a stretch is stripped in one go, and
   stretches of a single member, which are all that most conversations have below
   their shared turns, need no peeling at all: they have one leaf and save
   nothing.  So there are as many rounds as depths at which a shared stretch
   begins, not as many as the longest conversation has turns.
4. Each round takes the shared stretches that begin at the deepest depth left, with
   what their children have sent up, and sends leaves and savings to their parents.

A node that very many conversations share is only ever summed up (with partial
sums before each shuffle).  The one exception is the digest of the ids that end at
a node, which has to read them in order: they are sorted and written out in ranges,
and one task reads the pieces of text as a stream in constant memory.

Defined cases: rows without conv_id belong to no conversation; a NULL role or text
is the empty one; turns are ordered by turn (NULL first), then by role and the digest
of the text; repeated rows are turns of their own; a conversation of no turns
is a member of the root only; a table without conversations has no nodes.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_PATTERN, staged

#: Digest of the root, and of no ids.
ROOT = bytes(16)
EMPTY_SHA256 = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
#: Characters of ids in one piece.
PIECE = 1 << 16


def turn_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), turn_key, words: the turns of every conversation in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        role.alias("role"),
        # the length of the role tells where the text begins
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("turn_key"),
        F.regexp_count(text, F.lit(WORD_PATTERN)).cast("long").alias("words"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "turn_key")
    return rows.select("conv_id", F.row_number().over(order).cast("long").alias("pos"), "turn_key", "words")


def paths(turns: DataFrame) -> DataFrame:
    """conv_id, depth, node, parent, words, ended: every prefix of every conversation.

    ``turns``: conv_id, pos, turn_key, words; a row with pos 0 (and no key) stands
    for the conversation itself, so one without turns has its root.
    """

    def chain(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from hashlib import blake2b

        names = ["conv_id", "depth", "node", "parent", "words", "ended"]
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.bool_()]
        last, depth, node = None, 0, ROOT
        held = None  # the newest row: whether it is its conversation's last shows with the next one
        for batch in batches:
            rows = []
            for conv, pos, key, words in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if held is not None:
                    rows.append((*held, conv != last))
                if conv != last:
                    last, depth, node = conv, 0, ROOT
                    held = (conv, 0, ROOT, None, 0)
                else:
                    parent, node, depth = node, blake2b(node + key, digest_size=16).digest(), depth + 1
                    held = (conv, depth, node, parent, words)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((*held, True), kinds)], names)

    return (
        turns.repartition("conv_id")
        .sortWithinPartitions("conv_id", "pos")
        .select("conv_id", "pos", "turn_key", "words")
        .mapInArrow(chain, "conv_id long, depth long, node binary, parent binary, words long, ended boolean")
    )


def ends_digests(ended: DataFrame, piece: int = PIECE) -> DataFrame:
    """node, ends_sha256 of the nodes at which conversations end (``ended``: node, conv_id)."""
    parts = int(ended.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def batch(node, first, ids):
            return pa.RecordBatch.from_arrays(
                [pa.array([node], pa.binary()), pa.array([first], pa.int64()), pa.array([",".join(ids)])], ["node", "first", "ids"]
            )

        node, first, ids, size = None, None, [], 0
        for part in batches:
            for key, conv in zip(part.column("node").to_pylist(), part.column("conv_id").to_pylist()):
                if ids and (key != node or size >= piece):
                    yield batch(node, first, ids)
                    ids = []
                if not ids:
                    node, first, size = key, conv, 0
                ids.append(str(conv))
                size += len(ids[-1]) + 1
        if ids:
            yield batch(node, first, ids)

    def digest(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from hashlib import sha256

        def batch(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.binary(), pa.string()))], ["node", "ends_sha256"]
            )

        node, state = None, None
        for part in batches:
            rows = []
            for key, ids in zip(part.column("node").to_pylist(), part.column("ids").to_pylist()):
                if key != node:
                    if state is not None:
                        rows.append((node, state.hexdigest()))
                    node, state = key, sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if rows:
                yield batch(rows)
        if state is not None:
            yield batch([(node, state.hexdigest())])

    pieces = (
        ended.select("node", "conv_id")
        .repartitionByRange(parts, "node", "conv_id")
        .sortWithinPartitions("node", "conv_id")
        .mapInArrow(write, "node binary, first long, ids string")
    )
    return (
        pieces.repartition("node").sortWithinPartitions("node", "first").select("node", "ids")
        .mapInArrow(digest, "node binary, ends_sha256 string")
    )


def peel(nodes: DataFrame) -> DataFrame:
    """conv_id, n_convs, bottom, below, kids, leaves of every shared stretch.

    ``nodes``: conv_id (smallest member), n_convs, depth, node, parent, words.  A
    stretch is the nodes of one (conv_id, n_convs); ``below``: the savings under its
    last node, which has ``kids`` children; ``leaves``: of all its nodes.
    """
    top = F.min(F.struct("depth", "parent"))
    stretches = nodes.groupBy("conv_id", "n_convs").agg(
        top.alias("top"), F.max("depth").alias("bottom"), F.sum("words").alias("words")
    )
    stretches = stretches.select("conv_id", "n_convs", F.col("top.depth").alias("top"), F.col("top.parent").alias("up"), "bottom", "words")
    # the parent is the last node of its own stretch
    where = nodes.filter("n_convs > 1").select(
        F.col("node").alias("up"), F.col("conv_id").alias("up_conv"), F.col("n_convs").alias("up_n")
    )
    solitary = (
        stretches.filter("n_convs = 1 AND top > 0")
        .groupBy("up")
        .agg(F.count(F.lit(1)).alias("kids"))
        .join(where, "up")
        .select("up_conv", "up_n", "kids", F.col("kids").alias("leaves"), F.lit(0).cast("long").alias("saved"))
    )
    shared = staged(stretches.filter("n_convs > 1").join(where, "up", "left").drop("up"), "op12-stretches")
    sent = staged(solitary, "op12-solitary")
    # a short list: the depths at which shared stretches begin
    tops = sorted((r["top"] for r in shared.select("top").distinct().collect()), reverse=True)
    done = None
    for depth in tops:
        level = shared.filter(F.col("top") == depth)
        from_below = (
            sent.join(
                level.select(F.col("conv_id").alias("up_conv"), F.col("n_convs").alias("up_n")), ["up_conv", "up_n"], "left_semi"
            )
            .groupBy(F.col("up_conv").alias("conv_id"), F.col("up_n").alias("n_convs"))
            .agg(F.sum("kids").alias("kids"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("below"))
        )
        zero = F.lit(0).cast("long")
        merged = level.join(from_below, ["conv_id", "n_convs"], "left").select(
            "conv_id", "n_convs", "bottom", "up_conv", "up_n",
            F.coalesce("kids", zero).alias("kids"),
            F.coalesce("leaves", F.lit(1).cast("long")).alias("leaves"),
            F.coalesce("below", zero).alias("below"),
            (F.coalesce("below", zero) + (F.col("n_convs") - 1) * F.col("words")).alias("saved"),
        )
        merged = staged(merged, "op12-level")
        done = merged if done is None else done.unionByName(merged)
        up = merged.filter("up_conv IS NOT NULL")
        sent = sent.unionByName(up.select("up_conv", "up_n", F.lit(1).cast("long").alias("kids"), "leaves", "saved"))
    if done is None:
        return nodes.select("conv_id", "n_convs", F.col("depth").alias("bottom"), *[F.lit(0).cast("long").alias(c) for c in ("below", "kids", "leaves")]).limit(0)
    return done.select("conv_id", "n_convs", "bottom", "below", "kids", "leaves")


def trie(turns: DataFrame) -> DataFrame:
    """The nodes of the trie of ``turns`` (as ``paths`` takes them), one row each.

    node, parent (digests), conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.
    """
    rows = staged(paths(turns), "op12-paths")
    nodes = rows.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.max("depth").alias("depth"),
        F.max("parent").alias("parent"),
        F.max("words").alias("words"),
        F.max("ended").alias("ended"),
    )
    nodes = staged(nodes, "op12-nodes")
    stretches = peel(nodes)
    # savings of a shared node: those below its stretch and those of the stretch from it on
    down = Window.partitionBy("conv_id", "n_convs").orderBy(F.desc("depth"))
    inner = F.col("depth") < F.col("bottom")
    shared = (
        nodes.filter("n_convs > 1")
        .join(stretches, ["conv_id", "n_convs"])
        .select(
            "node", "parent", "conv_id", "depth", "n_convs", "ended",
            F.when(inner, 1).otherwise(F.col("kids")).cast("long").alias("n_children"),
            F.col("leaves").alias("n_leaves"),
            (F.col("below") + (F.col("n_convs") - 1) * F.sum("words").over(down)).alias("saved_tokens"),
        )
    )
    one = nodes.filter("n_convs = 1").select(
        "node", "parent", "conv_id", "depth", "n_convs", "ended",
        F.when(F.col("ended"), 0).otherwise(1).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"),
    )
    alone = one.withColumn(
        "ends_sha256", F.when(F.col("ended"), F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(F.lit(EMPTY_SHA256))
    )
    # only shared nodes can end several conversations
    lasts = rows.filter("ended").join(nodes.filter("n_convs > 1 AND ended").select("node"), "node", "left_semi")
    shared = shared.join(ends_digests(lasts), "node", "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY_SHA256))
    )
    both = shared.unionByName(alone).drop("ended")
    # the parent of a shared node, or of the first of a solitary stretch, is shared; else the parent is of the same conversation
    parents = nodes.filter("n_convs > 1").select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = both.join(parents, "parent", "left").withColumn(
        "parent_conv_id", F.when(F.col("depth") > 0, F.coalesce("parent_conv_id", "conv_id"))
    )
    return out.select(
        "node", "parent", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The prefix trie of the conversations as they are."""
    turns = turn_rows(conversations)
    return trie(turns.unionByName(_markers(turns.select("conv_id").distinct())))


def _markers(convs: DataFrame) -> DataFrame:
    """The pos-0 row of every conversation."""
    return convs.select(
        "conv_id", F.lit(0).cast("long").alias("pos"), F.lit(None).cast("binary").alias("turn_key"), F.lit(0).cast("long").alias("words")
    )


def branched(conversations: DataFrame, family: int = 20, most: int = 4) -> DataFrame:
    """Turns of conversations rebuilt as branches of another one.

    Conversation c takes the first h = crc32(c) % ``most`` turns of c - c % ``family``, then its
    own turns after its first h.  Returned as ``trie`` takes them.
    """
    own = staged(turn_rows(conversations), "op12-turns")
    convs = own.select("conv_id").distinct().withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % most)
    heads = own.filter((F.col("pos") < most) & (F.col("conv_id") % family == 0)).withColumnRenamed("conv_id", "base")
    taken = (
        convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % family)
        .join(heads, "base")
        .filter("pos <= h")
        .select("conv_id", "pos", "turn_key", "words")
    )
    kept = own.withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).filter("pos > h")
    kept = kept.select("conv_id", "pos", "turn_key", "words")  # after the taken ones: their places are at most h
    return _markers(convs).unionByName(taken).unionByName(kept)
