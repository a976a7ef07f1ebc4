"""Improbable-feature digests: rare byte windows of a text in chained Bloom filters.

Every window of bytes gets a rarity from its entropy; the rarest of each run of neighbouring windows
wins, and windows that win often enough become features. The window is the same for texts of every length, so an excerpt has
the features of its part of the text. A feature sets five bits of a
2048-bit filter; a filter that holds its number of features is followed by the next one. Two
digests are compared filter by filter on the bits they share beyond what chance gives.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of a window, which is also the number of neighbours that compete.
WINDOW = 16
#: Share of the neighbours' contests that a window must win.
WINS = 0.25
#: Windows with less of the highest possible entropy (in thousandths) tell nothing.
PLAIN, USELESS = 100, 2000
#: Bits of a filter, bits of a feature in it, features of a filter.
FILTER_BITS, FEATURE_BITS, FILTER_FEATURES = 2048, 5, 160
#: Bytes of a text looked at together.
STRETCH = 1 << 20
#: c log2 c for the count c of a byte in a window, in whole 2^-20ths, so that sums are exact wherever a window stands.
UNIT = 1 << 20
PART = np.rint(np.concatenate([[0.0], np.arange(1, 65) * np.log2(np.arange(1, 65))]) * UNIT).astype(np.int64)


def rarity(data: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """How ordinary each window is, smaller for rarer: distance of its entropy from the middle of the scale.

    Windows of very little entropy (padding, repeats) come last. The entropy is carried along: one
    byte enters and one leaves, and each changes the sum by the number of its equals in the window.
    """
    n = len(data)
    order = np.argsort(data, kind="stable")
    key = data[order].astype(np.int64) * (n + window) + order  # ascending: by byte, then by place
    at = np.arange(n)
    equals = np.empty(n, np.int64)
    equals[order] = at - np.searchsorted(key, key - (window - 1))  # among the others of a window before
    after = np.empty(n, np.int64)
    after[order] = np.searchsorted(key, key + (window - 1), side="right") - 1 - at  # among the others of a window after
    come = PART[equals + 1] - PART[equals]
    go = PART[after + 1] - PART[after]
    # The first window is built up byte by byte; then each step brings one byte in and takes one out.
    head = np.bincount(data[:window], minlength=256)
    total = PART[head].sum() + np.concatenate([[0], np.cumsum(come[window:] - go[: n - window])])
    entropy = np.log2(window) - total / (window * UNIT)
    level = np.rint(entropy * (1000 / np.log2(window))).astype(np.int64)
    # High entropy is rare in prose; nearly constant windows tell nothing.
    return np.where(level < PLAIN, USELESS, 1000 - level)


def window_hashes(data: np.ndarray, window: int) -> np.ndarray:
    """A 64-bit hash of every window."""
    words = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, window)).view(np.uint64)
    mixed = np.zeros(len(words), np.uint64)
    for k in range(words.shape[1]):
        mixed = (mixed ^ words[:, k]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return mixed


def features(data: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """64-bit hashes of the selected windows, in order of their place, equal ones once.

    Of equally rare windows the one with the smallest hash wins, so the choice depends on nothing but the bytes around.
    """
    if len(data) < window:
        return np.zeros(0, np.uint64) if not len(data) else np.array([int.from_bytes(hashlib.blake2b(data.tobytes(), digest_size=8).digest(), "little")], np.uint64)
    found, run = [], window
    for start in range(0, len(data) - window + 1, STRETCH):
        part = data[start : start + STRETCH + 2 * window - 2]
        ranks, hashes = rarity(part, window), window_hashes(part, window)
        n = len(ranks)
        order = (ranks << 52) | ((hashes >> np.uint64(32)).astype(np.int64) & 0xFFFFF) << 32 | np.arange(n)
        if n <= run:
            wins = np.array([int(np.argmin(order))])
        else:
            # Smallest of each run neighbours: smallest of a block's end and the next one's start.
            whole = -(-n // run) * run
            both = np.full(whole, np.iinfo(np.int64).max)
            both[:n] = order
            grid = both.reshape(-1, run)
            left = np.minimum.accumulate(grid, axis=1).ravel()
            right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
            least = np.minimum(right[: n - run + 1], left[run - 1 : n]) & 0xFFFFFFFF
            edge = np.flatnonzero(np.diff(least, prepend=-1))
            wins = least[edge][np.diff(edge, append=len(least)) >= WINS * run]
        wins = wins[ranks[wins] < USELESS] if len(wins) > 1 else wins
        found.append(hashes[wins])
    chosen = np.concatenate(found)
    if not len(chosen):
        chosen = window_hashes(data[:window], window)
    _, first = np.unique(chosen, return_index=True)
    return chosen[np.sort(first)]


def digest(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Filters (one row of packed bits each) and the number of features in each."""
    hashes = features(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8))
    n = -(-len(hashes) // FILTER_FEATURES)
    bits = np.zeros((n, FILTER_BITS), bool)
    owner = np.arange(len(hashes)) // FILTER_FEATURES
    for k in range(FEATURE_BITS):
        bits[owner, ((hashes >> np.uint64(11 * k)) & np.uint64(FILTER_BITS - 1)).astype(np.int64)] = True
    return np.packbits(bits, axis=1), np.bincount(owner, minlength=n) if n else np.zeros(0, np.int64)


def as_text(filters: np.ndarray, held: np.ndarray) -> str:
    """``features:filters`` with the filters deflated and in base 64; ``0:`` for an empty text."""
    return f"{int(held.sum())}:" + (base64.b64encode(zlib.compress(filters.tobytes(), 6)).decode() if len(filters) else "")


def from_text(printed: str) -> tuple[np.ndarray, np.ndarray]:
    n, packed = printed.split(":", 1)
    if not packed:
        return np.zeros((0, FILTER_BITS // 8), np.uint8), np.zeros(0, np.int64)
    filters = np.frombuffer(zlib.decompress(base64.b64decode(packed)), np.uint8).reshape(-1, FILTER_BITS // 8)
    held = np.full(len(filters), FILTER_FEATURES)
    held[-1] = int(n) - FILTER_FEATURES * (len(filters) - 1)
    return filters, held


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """0 to 1: for each filter of the one with fewer, its best normalised overlap, weighed by its features.

    It is held against each filter of the other and each two neighbours together, since features of one filter
    may lie in two there if the texts begin in different places. The overlap of two filters is the share of common bits between what chance gives and the most there could
    be. Two empty digests are alike (1), an empty one and another are not (0).
    """
    if len(b[0]) < len(a[0]) or (len(a[0]) == len(b[0]) and b[1].sum() < a[1].sum()):
        a, b = b, a
    if not len(a[0]):
        return float(not len(b[0]))
    wide_a, wide_b = a[0].view(np.uint64), b[0].view(np.uint64)
    wide_b = np.concatenate([wide_b, wide_b[:-1] | wide_b[1:]])
    ones_a = np.bitwise_count(wide_a).sum(axis=1, dtype=np.int64).astype(float)
    ones_b = np.bitwise_count(wide_b).sum(axis=1, dtype=np.int64).astype(float)
    best = np.zeros(len(a[0]))
    for k in range(len(a[0])):
        common = np.bitwise_count(wide_a[k] & wide_b).sum(axis=1, dtype=np.int64)
        most = np.minimum(ones_a[k], ones_b)
        chance = ones_a[k] * ones_b / FILTER_BITS
        best[k] = np.clip((common - chance) / np.maximum(most - chance, 1e-9), 0, 1).max()
    return float(np.average(best, weights=a[1]))


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many (or all) of the following text."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


def split_points(docs: DataFrame, rows_per_block: int, most_blocks: int) -> list[int]:
    """Ids at which blocks of about so many rows begin, from a bounded sample of the ids themselves."""
    n = docs.count()
    want = min(most_blocks, max(1, n // rows_per_block))
    if want < 2:
        return []
    rate = max(1, n // (want * 20))
    sample = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(rate)) == 0).select("doc_id").distinct()
    ids = sorted(r[0] for r in sample.collect())
    return sorted({ids[k * len(ids) // want] for k in range(1, want)}) if len(ids) >= want else ids[1:]


def with_next(docs: DataFrame, rows_per_block: int = 1000, most_blocks: int = 4096) -> DataFrame:
    """Rows of ``doc_id, text`` dealt out so that each block also holds the first row that follows it.

    Blocks are ranges of ids. The rows of an id that begins a block go to the block before it as well,
    marked by ``_copy``. Inside a block rows come in order. A block whose range follows the last id
    of the table gets the rows of the smallest id, so the order is a ring.
    """
    ids = docs.where(F.col("doc_id").isNotNull()).select("doc_id")
    points = split_points(ids, rows_per_block, most_blocks)
    first = ids.agg(F.min("doc_id")).first()[0]
    width = max(1, int(len(points) ** 0.5))
    groups = [points[k : k + width] for k in range(0, len(points), width)]
    if points:
        heads = F.array(*[F.lit(g[0]).cast("long") for g in groups])
        nested = F.array(*[F.array(*[F.lit(x).cast("long") for x in g]) for g in groups])
        outer = F.size(F.filter(heads, lambda x: x <= F.col("doc_id")))
        inner = F.size(F.filter(F.element_at(nested, F.greatest(F.lit(1), outer)), lambda x: x <= F.col("doc_id")))
        block = F.when(outer == 0, 0).otherwise((outer - 1) * width + inner)
        begins = F.array_contains(F.element_at(nested, F.greatest(F.lit(1), outer)), F.col("doc_id"))
    else:
        block, begins = F.lit(0), F.lit(False)
    last = len(points)
    placed = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text", block.cast("int").alias("_block"), begins.alias("_begins"))
    where_to = F.array_compact(
        F.array(
            F.struct(F.col("_block").alias("block"), F.lit(0).alias("copy")),
            F.when(F.col("_begins"), F.struct((F.col("_block") - 1).alias("block"), F.lit(1).alias("copy"))),
            F.when(F.col("doc_id") == F.lit(first), F.struct(F.lit(last).alias("block"), F.lit(2).alias("copy"))),
        )
    )
    dealt = placed.withColumn("_to", F.explode(where_to)).select("doc_id", "text", F.col("_to.block").alias("_block"), F.col("_to.copy").alias("_copy"))
    order = ["_block", "_copy", "doc_id", "text"]
    return dealt.repartition(max(1, len(points) + 1), "_block").sortWithinPartitions(*order)


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def compare_with_next(docs: DataFrame, rows_per_block: int = 1000, most_blocks: int = 4096) -> DataFrame:
    """The fingerprint of every text, of its edited text, and how alike these and the next document's are.

    ``docs`` has ``doc_id, text``. The next document is the next by ascending id (rows that share an id come in
    order of their text, and follow one another), the first after the last. Null text is empty; an empty text has no feature,
    one shorter than a window a single one. A table of one row is its own next. Rows without an id take no part.
    An empty table gives an empty result; other columns are not read. A very long text is looked at a stretch at a time, but stays in one task, and
    comparing two of them costs the product of their filters. Texts are shuffled once; each task streams through its range.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, of, done = None, None, False
        for batch in batches:
            rows = []
            for doc_id, text, block, copy in batch[["doc_id", "text", "_block", "_copy"]].itertuples(index=False):
                text = text or ""
                if block != of:
                    held, of, done = None, block, False
                if done:
                    continue
                mark = digest(text)
                if held is not None:
                    before, old, old_mark = held
                    changed = edited(old, text)
                    new_mark = digest(changed)
                    sha = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
                    rows.append((before, len(old), sha, as_text(*old_mark), as_text(*new_mark), likeness(old_mark, new_mark), likeness(old_mark, mark)))
                held, done = (doc_id, text, mark), copy > 0
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in RESULT.split(", ")])

    return with_next(docs.select("doc_id", "text"), rows_per_block, most_blocks).mapInPandas(run, RESULT)
