"""Trie of the turns that conversations have in common from their beginning.

Conversations are cut into blocks of a few turns. A block's digest is that of all turns up to its end, chained block by
block, so conversations are first grouped by whole blocks. A block that is the only one after its forerunner is passed by
the same conversations from its first turn to its last; only where several blocks follow one forerunner are turns
compared one by one, and then once per different block, not per conversation.

What a node says of its subtree needs no walk over the tree. The smallest member of a node stays the smallest of every
node it passes below, so each node belongs to one conversation, and the nodes below a node are those that belong to its
members: sums over members are enough.

Only digests and word counts of turns are shuffled, never texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from membervane.llm.common import staged, word_count

#: Turns in a block.
BLOCK = 4
#: Bytes of a digest, and the digest of no turns at all.
WIDTH = 16
ROOT = bytes(WIDTH)
EMPTY = hashlib.sha256(b"").hexdigest()


def turns_of(conversations: DataFrame) -> DataFrame:
    """Digest and word count of every turn, numbered from 1: (conv_id, place, digest, words).

    Turns are in the order of ``turn``, null first, those of one number by role and digest. Null roles and texts count as
    empty; rows without a conversation take no part; every repeated row is a turn of its own. Texts may have any length.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), digest.alias("digest"), word_count(text).alias("words")
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "digest")
    return rows.select("conv_id", F.row_number().over(order).cast("long").alias("place"), "digest", "words")


def share_heads(turns: DataFrame, every: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with the turns of another one: their ids, and their turns in place of the former ones.

    The first h turns of conversation c become those of conversation c - c % ``every``, as far as it has them;
    h is the checksum of c in decimals modulo ``most``. A conversation that neither gives a turn has none.
    """
    head = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("long")
    ids = turns.select("conv_id").distinct()
    given = turns.where((F.col("place") < most) & (F.col("conv_id") % every == 0)).withColumnRenamed("conv_id", "giver")
    takers = ids.select("conv_id", (F.col("conv_id") - F.col("conv_id") % every).alias("giver"), head.alias("_head"))
    taken = takers.join(given, "giver").where(F.col("place") <= F.col("_head")).select(*turns.columns)
    return ids, taken.unionByName(turns.where(F.col("place") > head))


def _chain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Blocks of the turns of conversations that come in order; only the open block of one conversation is held."""
    conv, number, before, forerunner = None, 0, 0, ROOT
    digests: list[bytes] = []
    words: list[int] = []
    out: list[tuple] = []

    def close(last: bool) -> None:
        nonlocal number, before, forerunner
        joined = b"".join(digests)
        own = hashlib.md5(forerunner + joined).digest()
        out.append((conv, number, forerunner, own, joined, list(words), before, int(last)))
        number, before, forerunner = number + 1, before + sum(words), own
        digests.clear()
        words.clear()

    names = ["conv_id", "number", "forerunner", "own", "digests", "words", "before", "is_last"]
    for batch in batches:
        for c, digest, n in zip(batch["conv_id"].tolist(), batch["digest"].tolist(), batch["words"].tolist(), strict=True):
            if c != conv:
                if digests:
                    close(True)
                conv, number, before, forerunner = c, 0, 0, ROOT
            elif len(digests) == BLOCK:
                close(False)
            digests.append(bytes(digest))
            words.append(n)
        if out:
            yield pd.DataFrame(out, columns=names)
            out.clear()
    if digests:
        close(True)
        yield pd.DataFrame(out, columns=names)


BLOCKS = "conv_id long, number long, forerunner binary, own binary, digests binary, words array<long>, before long, is_last long"


def blocks_of(turns: DataFrame) -> DataFrame:
    """The blocks of every conversation with the digests of all turns before and up to them."""
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "place").select("conv_id", "digest", "words")
    return ordered.mapInPandas(_chain, BLOCKS)


SAME_BLOCK = ("number", "forerunner", "own", "digests", "words", "before")
SAME_NODE = ("node", "parent", "depth", "words", "before")


def _merged(measures: dict[str, str]) -> list[Column]:
    return [(F.min if how == "min" else F.sum)(name).alias(name) for name, how in measures.items()]


def _nodes(blocks: DataFrame, single: DataFrame, measures: dict[str, str]) -> DataFrame:
    """Nodes of different blocks: (node, parent, depth, words, before and the measures).

    Turns of blocks that have no sibling are nodes as they are; those of the others are merged where they agree.
    """
    at = F.posexplode("words").alias("at", "node_words")
    turns = blocks.join(single.select("own", F.lit(True).alias("is_single")), "own", "left").select("*", at)

    def digest(length: Column) -> Column:
        return F.unhex(F.md5(F.concat("forerunner", F.substring("digests", F.lit(1), (length * WIDTH).cast("int")))))

    whole = F.col("at") + 1 == F.size("words")
    inner = F.expr("aggregate(slice(words, 1, at), 0L, (a, x) -> a + x)")
    measured = [F.when(whole, F.col(c)).otherwise(F.lit(0)).alias(c) if c == "n_ends" else F.col(c) for c in measures]
    placed = turns.select(
        "is_single",
        F.when(whole, F.col("own")).otherwise(digest(F.col("at") + 1)).alias("node"),
        F.when(F.col("at") == 0, F.col("forerunner")).otherwise(digest(F.col("at"))).alias("parent"),
        (F.col("number") * BLOCK + F.col("at") + 1).alias("depth"),
        F.col("node_words").alias("words"),
        (F.col("before") + inner).alias("before"),
        *measured,
    )
    parted = placed.where(F.col("is_single").isNull()).groupBy(*SAME_NODE).agg(*_merged(measures))
    return placed.where("is_single").select(*parted.columns).unionByName(parted)


def _hash_ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One hash per node over the ids that end there, which come in order and are not held."""
    node, running = None, None
    for batch in batches:
        out = []
        for key, c in zip(batch["node"].tolist(), batch["conv_id"].tolist(), strict=True):
            key = bytes(key)
            if key != node:
                if running is not None:
                    out.append((node, running.hexdigest()))
                node, running = key, hashlib.sha256(str(c).encode())
            else:
                running.update(b",%d" % c)
        if out:
            yield pd.DataFrame(out, columns=["node", "ends_sha256"])
    if running is not None:
        yield pd.DataFrame([(node, running.hexdigest())], columns=["node", "ends_sha256"])


def trie(ids: DataFrame, turns: DataFrame) -> DataFrame:
    """Nodes of the trie of ``turns`` (conv_id, place, digest, words); ``ids`` also names conversations without a turn.

    Gives per node: conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs, n_children, n_leaves,
    saved_tokens (words that members after the first repeat, in the whole subtree) and ends_sha256 (of the ids that end
    there, ascending, comma-joined). No conversation, no node.
    """
    blocks = staged(blocks_of(turns), "trie-blocks")
    counted = {"n_convs": "sum", "n_ends": "sum", "conv_id": "min"}
    passed = blocks.withColumns({"n_convs": F.lit(1).cast("long"), "n_ends": F.col("is_last")})
    different = staged(passed.groupBy(*SAME_BLOCK).agg(*_merged(counted)), "trie-different-blocks")
    single = different.groupBy("forerunner").agg(F.count(F.lit(1)).alias("n"), F.first("own").alias("own")).where("n = 1").select("own")
    single = staged(single, "trie-single-blocks")

    # What belongs to each conversation: the nodes whose smallest member it is, and all its turns.
    first = _nodes(different, single, counted)
    held = first.groupBy("conv_id").agg(F.sum("words").alias("held"), F.sum((F.col("n_convs") == F.col("n_ends")).cast("long")).alias("n_leaves"))
    length = F.col("before") + F.expr("aggregate(words, 0L, (a, x) -> a + x)")
    marks = blocks.where("is_last = 1").select("conv_id", length.alias("total")).join(held, "conv_id", "left")
    marks = staged(ids.join(marks, "conv_id", "left").na.fill(0, ["total", "held", "n_leaves"]), "trie-marks")

    summed = counted | {"total": "sum", "held": "sum", "n_leaves": "sum"}
    members = passed.join(marks, "conv_id").groupBy(*SAME_BLOCK).agg(*_merged(summed))
    below = _nodes(members, single, summed)
    own = marks.select(F.col("conv_id"), F.col("total").alias("own_total"), F.col("held").alias("own_held"))
    repeated = F.col("total") - F.col("n_convs") * F.col("before")
    single_copy = F.col("held") - F.col("own_held") + F.col("own_total") - F.col("before")
    nodes = below.join(own, "conv_id").select("node", "parent", "depth", "conv_id", "n_convs", "n_leaves", (repeated - single_copy).alias("saved_tokens"))
    nodes = staged(nodes, "trie-nodes")

    children = nodes.where("depth > 1").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    upper = nodes.select(F.col("node").alias("_above"), F.col("conv_id").alias("above_conv_id"))
    # First turns look themselves up, which spreads them; their parent is the root.
    looked_up = F.when(F.col("depth") == 1, F.col("node")).otherwise(F.col("parent"))
    named = nodes.withColumn("_above", looked_up).join(upper, "_above").join(children, "node", "left")

    turnless = ids.join(blocks.select("conv_id").distinct(), "conv_id", "left_anti").select(F.lit(ROOT).alias("node"), "conv_id")
    ends = blocks.where("is_last = 1").select(F.col("own").alias("node"), "conv_id").unionByName(turnless)
    ends = ends.repartition("node").sortWithinPartitions("node", "conv_id").mapInPandas(_hash_ends, "node binary, ends_sha256 string")
    # The root takes no part in the joins, as most first turns may be its children: its row is one aggregate.
    top = marks.agg(F.count(F.lit(1)), F.min("conv_id"), F.sum("total") - F.sum("held"), F.greatest(F.sum("n_leaves"), F.lit(1))).first()
    n_convs, smallest, saved, n_leaves = top
    kinds = "node binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"
    rows = [(ROOT, smallest, 0, None, n_convs, nodes.where("depth = 1").count(), n_leaves, saved)] if n_convs else []
    root = turns.sparkSession.createDataFrame(rows, kinds)
    lower = named.select(
        "node", "conv_id", "depth", F.when(F.col("depth") == 1, F.lit(smallest)).otherwise(F.col("above_conv_id")).alias("parent_conv_id"),
        "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves", "saved_tokens",
    )
    found = root.unionByName(lower).join(ends, "node", "left").drop("node")
    return found.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY)))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of conversations (conv_id, turn, role, text), see ``turns_of`` and ``trie``; further columns are ignored."""
    turns = turns_of(conversations)
    return trie(turns.select("conv_id").distinct(), turns)
