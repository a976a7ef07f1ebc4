"""SimHash fingerprints of word shingles, and their near pairs by tiled exact comparison.

A fingerprint has one word of 64 bits, or several for a finer measure. Distinct fingerprints are sorted by the
population counts of their four segments (of 16 bits, or of whole words) and cut into blocks. Two fingerprints differ in at least as many bits as their population counts do, segment by
segment, so blocks (and tiles inside them) whose counts lie more than the radius apart are
skipped; all others are compared in full with exclusive-or and bit counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from membervane.llm.common import staged
from membervane.llm.components import connected, local_components

SEED = 42
#: Fingerprints of a block (one row), and of a tile inside it.
BLOCK, TILE = 4096, 256
#: Shingles whose bits are counted at once.
SHINGLES = 1 << 16
SEGMENTS = 4


def fingerprint(text: str | None, shingle: int = 3, words: int = 1) -> np.ndarray:
    """SimHash of the word shingles of a text in 64-bit words (1 or an even number); zero if it has no word of text.

    One word takes XXH64 of the shingles, more take the 128 bits of XXH3 under one seed after another.
    """
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII letters and ASCII white space only
    if not parts:
        return np.zeros(words, np.uint64)
    joined = b" ".join(parts)
    ends = list(accumulate(len(w) + 1 for w in parts))
    starts = [0, *ends]
    digest, seeds = (xxhash.xxh64_digest, [SEED]) if words == 1 else (xxhash.xxh3_128_digest, range(SEED, SEED + words // 2))
    counts, n = np.zeros((len(seeds), 64 * words // len(seeds)), np.int64), max(1, len(parts) - shingle + 1)
    for at in range(0, n, SHINGLES):
        spans = zip(starts[at : min(at + SHINGLES, n)], ends[shingle - 1 + at :])
        pieces = [joined[a : b - 1] for a, b in spans] if len(parts) >= shingle else [joined]
        for k, seed in enumerate(seeds):
            hashes = np.frombuffer(b"".join([digest(p, seed) for p in pieces]), np.uint8)
            counts[k] += np.unpackbits(hashes.reshape(len(pieces), -1), axis=1).sum(axis=0, dtype=np.int64)
    return np.frombuffer(np.packbits(2 * counts.ravel() > n).tobytes(), ">u8").astype(np.uint64)


def names_of(words: int) -> list[str]:
    """Columns of a fingerprint's words."""
    return ["fingerprint", *[f"fingerprint{k}" for k in range(1, words)]]


def fingerprints(docs: DataFrame, shingle: int = 3, words: int = 1) -> DataFrame:
    """``doc_id`` and the words of the fingerprint (as signed longs) of every row of ``doc_id, text``; null text is empty."""
    names = names_of(words)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = np.array([fingerprint(t, shingle, words) for t in batch["text"]], np.uint64).reshape(-1, words)
            yield pd.DataFrame({"doc_id": batch["doc_id"]} | {c: found[:, k].view(np.int64) for k, c in enumerate(names)})

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, " + ", ".join(f"{c} long" for c in names))


def as_hex(fingerprint: Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def segment_counts(prints: np.ndarray) -> np.ndarray:
    """Population counts of the segments, one row per fingerprint."""
    if prints.shape[1] > 1:
        return np.bitwise_count(prints).astype(np.int16)
    shifts = np.arange(SEGMENTS, dtype=np.uint64) * np.uint64(16)
    return np.bitwise_count((prints >> shifts) & np.uint64(0xFFFF)).astype(np.int16)


def boxes(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest count of each segment in every tile."""
    at = np.arange(0, len(counts), TILE)
    return np.minimum.reduceat(counts, at), np.maximum.reduceat(counts, at)


def near_pairs(a: np.ndarray, b: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places ``i, j`` with at most ``radius`` differing bits between ``a[i]`` and ``b[j]``, tile by tile."""
    (low_a, high_a), (low_b, high_b) = boxes(segment_counts(a)), boxes(segment_counts(b))
    gap = np.maximum(0, np.maximum(low_a[:, None] - high_b[None], low_b[None] - high_a[:, None])).sum(axis=2)
    for s, t in zip(*np.nonzero(gap <= radius)):
        x, y = a[s * TILE : (s + 1) * TILE], b[t * TILE : (t + 1) * TILE]
        bits = np.bitwise_count(x[:, None, 0] ^ y[None, :, 0])
        if a.shape[1] > 1:
            bits += np.bitwise_count(x[:, None, 1] ^ y[None, :, 1])
        i, j = np.nonzero(bits <= radius)
        if a.shape[1] > 2 and len(i):  # the rest only where the first two words leave room
            near = np.bitwise_count(x[i] ^ y[j]).sum(axis=1, dtype=np.int64) <= radius
            i, j = i[near], j[near]
        if len(i):
            yield i + s * TILE, j + t * TILE


def blocks(prints: DataFrame, radius: int, words: int) -> DataFrame:
    """Blocks of fingerprints with their ``node`` in segment order, each with the components inside it.

    ``representatives`` has, place by place, the smallest node that the block links to.
    """
    names = names_of(words)
    if words == 1:
        counts = [F.bit_count(F.shiftright("fingerprint", 16 * k).bitwiseAND(0xFFFF)) for k in range(SEGMENTS)]
    else:
        counts = [F.bit_count(c) for c in names]
    parts = max(1, -(-prints.count() // BLOCK))
    rows = prints.select(*names, "node", *[c.alias(f"_c{k}") for k, c in enumerate(counts)])
    order = [*[f"_c{k}" for k in range(len(counts))], *names]
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), BLOCK):
                part = batch.iloc[at : at + BLOCK]
                a, nodes = part[names].to_numpy(np.int64).view(np.uint64), part["node"].to_numpy()
                root = np.arange(len(a))
                for i, j in near_pairs(a, a, radius):
                    root = local_components(len(a), np.concatenate([np.arange(len(a)), i]), np.concatenate([root, j]))
                least = nodes.copy()
                np.minimum.at(least, root, nodes)
                c = segment_counts(a)
                yield pd.DataFrame(
                    {
                        "block": [int(nodes[0])],
                        "low": [c.min(axis=0).astype(np.int32)],
                        "high": [c.max(axis=0).astype(np.int32)],
                        "prints": [a.view(np.int64).ravel()],
                        "nodes": [nodes],
                        "representatives": [least[root]],
                    }
                )

    kinds = "block long, low array<int>, high array<int>, prints array<long>, nodes array<long>, representatives array<long>"
    return rows.select(*names, "node").mapInPandas(pack, kinds)


def links_between(pairs: DataFrame, radius: int, words: int) -> DataFrame:
    """Links ``a, b`` between the local components of two different blocks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                a, b = (np.asarray(x).view(np.uint64).reshape(-1, words) for x in (row.prints, row.prints2))
                own, other = np.asarray(row.representatives), np.asarray(row.representatives2)
                found = [np.unique(np.stack([own[i], other[j]], axis=1), axis=0) for i, j in near_pairs(a, b, radius)]
                if found:
                    yield pd.DataFrame(np.unique(np.concatenate(found), axis=0), columns=["a", "b"])

    return pairs.mapInPandas(run, "a long, b long")


def near_components(prints: DataFrame, radius: int = 3, words: int = 1) -> DataFrame:
    """Fingerprint and ``component`` for rows of distinct fingerprints with a ``node`` each.

    Fingerprints with at most ``radius`` differing bits are linked; ``component`` is the smallest node
    reachable. Which blocks may meet is found by an equality join on the counts of their first
    segment. Links inside a block become one representative each before blocks are compared, so
    that a group of many near copies yields few links.
    """
    prints = staged(prints, "prints")
    packed = staged(blocks(prints, radius, words), "blocks")
    inside = packed.select(F.explode(F.arrays_zip("nodes", "representatives")).alias("x")).select(
        F.col("x.nodes").alias("a"), F.col("x.representatives").alias("b")
    )
    segments = SEGMENTS if words == 1 else words
    box = packed.select("block", "low", "high")
    left = box.withColumn("_at", F.explode(F.sequence(F.col("low")[0], F.col("high")[0])))
    right = box.select(F.col("block").alias("block2"), F.col("low").alias("low2"), F.col("high").alias("high2"))
    right = right.withColumn("_at", F.explode(F.sequence(F.col("low2")[0] - radius, F.col("high2")[0] + radius)))
    gap = sum(
        F.greatest(F.lit(0), F.col("low")[k] - F.col("high2")[k], F.col("low2")[k] - F.col("high")[k]) for k in range(segments)
    )
    meeting = left.join(right, "_at").where((F.col("block") < F.col("block2")) & (gap <= radius))
    meeting = meeting.select("block", "block2").distinct()
    held = packed.select("block", "prints", "representatives")
    pairs = meeting.join(held, "block").join(held.toDF("block2", "prints2", "representatives2"), "block2")
    across = links_between(pairs.select("prints", "representatives", "prints2", "representatives2"), radius, words)
    labels = connected(inside.where("a != b").union(across))
    return prints.join(labels, "node", "left").select(*names_of(words), F.coalesce("component", "node").alias("component"))


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3, words: int = 1) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``doc_id, text`` (and ``fingerprint1`` … for more ``words``).

    Documents are linked when their fingerprints differ in at most ``radius`` bits; ``component_id`` is the
    smallest ``doc_id`` reachable, the document's own included. Null, empty and blank texts have
    fingerprint 0 and are linked like any other. Texts of fewer words than a shingle count as one
    shingle. A row without ``doc_id`` links nothing; its component is that of rows with the same
    fingerprint, null if there is none. Repeated rows get equal results. Empty tables give empty
    results; other columns are not read.
    """
    names = names_of(words)
    prints = staged(fingerprints(docs, shingle, words), "fingerprints")
    nodes = prints.where(F.col("doc_id").isNotNull()).groupBy(*names).agg(F.min("doc_id").alias("node"))
    groups = staged(near_components(nodes, radius, words), "components")
    return prints.join(groups, names, "left").select("doc_id", *names, F.col("component").alias("component_id"))
