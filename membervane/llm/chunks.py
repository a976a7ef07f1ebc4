"""Substring deduplication by content-defined chunking with a gear rolling hash.

A text is cut where the gear hash of the bytes just before has its marked bits at zero, so cuts
move with the text around them and an insertion changes the chunks next to it only. Chunks are
looked up by digest, as many neighbours together as a span must have bytes at least: such a run belongs to the first
place that holds it, and runs that go on in both places are one repeated span, which stands there as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from membervane.llm.common import slices, staged, unused, with_column

#: Bits of the gear hash; as each byte shifts it by one, it depends on so many last bytes.
GEAR_BITS = 16
#: Bits that must be zero at a cut (one in 2^k places), and the least and the most bytes of a chunk.
CUT_BITS, LEAST, MOST = 4, 16, 128
#: Bytes of a text whose hash is rolled at once; chunks emitted at once.
STRETCH, ROWS = 1 << 20, 200_000
#: One number per byte value.
GEAR = np.array([xxhash.xxh64_intdigest(bytes([b]), 1) & 0xFFFF for b in range(256)], np.uint16)
MASK = np.uint16(((1 << CUT_BITS) - 1) << (GEAR_BITS - CUT_BITS))
RUN = "doc_id long, start int, size int, h1 long, h2 int"


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The gear hash after each byte: sum of the last 16 bytes' numbers, each shifted by its age."""
    h = GEAR[data]
    for step in (1, 2, 4, 8):
        older = h[:-step] << np.uint16(step)
        h = h.copy()
        h[step:] += older
    return h


def cuts(data: np.ndarray) -> list[int]:
    """Ends of the chunks of a text."""
    places = []
    for at in range(0, len(data), STRETCH):
        before = min(at, GEAR_BITS - 1)
        marked = (gear_hashes(data[at - before : at + STRETCH]) & MASK) == 0
        places.append(np.flatnonzero(marked[before:]) + at + 1)
    ends, last = [], 0
    for place in [*np.concatenate(places).tolist(), len(data)] if places else []:
        while place - last > MOST:
            last += MOST
            ends.append(last)
        if place - last >= LEAST or (place == len(data) and place > last):
            ends.append(place)
            last = place
    return ends


def runs_of(ends: list[int], least: int) -> list[tuple[int, int]]:
    """First and last byte (exclusive) of the shortest run of ``least`` bytes or more that begins with each chunk.

    The last run goes on to the end of the text as well, so that no chunk is left out.
    """
    runs, last = [], 0
    for begin in [0, *ends[:-1]] if ends else []:
        while last < len(ends) and ends[last] - begin < least:
            last += 1
        if last == len(ends):
            break
        runs.append((begin, ends[last]))
    if runs and runs[-1][1] < ends[-1]:
        runs.append((runs[-1][0], ends[-1]))
    return runs


def chunk_runs(docs: DataFrame, min_bytes: int) -> DataFrame:
    """``doc_id, start, size, h1, h2`` of every run of chunks: place and length in bytes, and 96 bits of a digest."""

    def emit(ids, starts, sizes, digests):
        halves = np.frombuffer(b"".join(digests), np.dtype([("h1", "<i8"), ("h2", "<i4"), ("rest", "<i4")]))
        columns = {"doc_id": np.array(ids, np.int64), "start": np.array(starts, np.int32), "size": np.array(sizes, np.int32)}
        return pd.DataFrame(columns | {"h1": halves["h1"], "h2": halves["h2"]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        digest = xxhash.xxh3_128_digest
        ids, starts, sizes, digests = [], [], [], []
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                raw = text.encode("utf-8", "surrogatepass")
                runs = runs_of(cuts(np.frombuffer(raw, np.uint8)), min_bytes)
                ids += [doc_id] * len(runs)
                starts += [a for a, _ in runs]
                sizes += [b - a for a, b in runs]
                digests += [digest(raw[a:b]) for a, b in runs]
                if len(ids) >= ROWS:
                    yield emit(ids, starts, sizes, digests)
                    ids, starts, sizes, digests = [], [], [], []
            if ids:
                yield emit(ids, starts, sizes, digests)
                ids, starts, sizes, digests = [], [], [], []

    usable = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    return usable.select("doc_id", "text").mapInPandas(run, RUN)


def repeated_spans(docs: DataFrame, min_bytes: int = 120) -> DataFrame:
    """``doc_id, start, size, first_doc_id, first_start, n_runs``: spans (in bytes of UTF-8) seen before.

    Seen before means: in a document with a smaller ``doc_id``, or further to the front of the same one. The bytes of a span stand as a
    whole at ``first_start`` of ``first_doc_id``, and have at least ``min_bytes``. A span is made of ``n_runs`` runs of chunks that go on,
    overlapping or end to end, in both places. Spans of one document with different first places may overlap.
    In periodic text each run is a span of its own, as all have one first place. At each end of a copy less than ``min_bytes`` may be left, as far as no shortest run lies in it.
    Null texts and rows without ``doc_id`` take no part; texts of less than ``min_bytes`` (empty ones too) have no run. Very long texts
    are cut a stretch at a time; their runs are rows like all others.
    Rows that share a ``doc_id`` are one document: a run at the same place of each is one run. An empty table
    gives an empty result; other columns are not read.
    """
    runs = staged(chunk_runs(docs, min_bytes), "chunk-runs")
    place = F.struct("doc_id", "start")
    firsts = runs.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("held"))
    firsts = staged(firsts.where("held > 1").select("h1", "h2", "first"), "first-runs")
    repeated = runs.join(firsts, ["h1", "h2"]).where(F.col("first") < place)
    # Runs at one distance from their first places form a span as long as each begins within or next to those before.
    shift = (F.col("start") - F.col("first.start")).alias("shift")
    repeated = repeated.select("doc_id", "start", (F.col("start") + F.col("size")).alias("stop"), F.col("first.doc_id").alias("first_doc_id"), shift)
    copies = Window.partitionBy("doc_id", "first_doc_id", "shift").orderBy("start", "stop")
    begins = F.coalesce(F.col("start") > F.max("stop").over(copies.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    spans = repeated.withColumn("begins", begins.cast("int")).withColumn("span", F.sum("begins").over(copies.rowsBetween(Window.unboundedPreceding, 0)))
    spans = spans.groupBy("doc_id", "first_doc_id", "shift", "span").agg(
        F.min("start").alias("start"), F.max("stop").alias("stop"), F.count(F.lit(1)).alias("n_runs")
    )
    return spans.select(
        "doc_id", "start", (F.col("stop") - F.col("start")).alias("size"), "first_doc_id", (F.col("start") - F.col("shift")).alias("first_start"), "n_runs"
    )


def without_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` with the spans cut out of ``text``, and the number of bytes removed as ``bytes_removed``.

    Spans may overlap. A code point that a span cuts through is removed with it. Documents without spans, null texts and rows without ``doc_id``
    stay as they are.
    """
    names = [c for c in docs.columns if c != "bytes_removed"]
    own = unused("spans", names)
    listed = spans.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("start", "size"))).alias(own))
    joined = docs.select(*names).join(listed, "doc_id", "left").select(*names, own)
    schema = with_column(docs.select(*names), "bytes_removed", T.IntegerType())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in slices(batches):
            texts, removed = batch["text"].tolist(), np.zeros(len(batch), np.int32)
            for k, rows in enumerate(batch.pop(own)):
                if rows is None or texts[k] is None:
                    continue
                raw, at, kept = texts[k].encode("utf-8", "surrogatepass"), 0, []
                for r in rows:
                    start, size = r.values() if isinstance(r, dict) else r
                    kept.append(raw[at:start])
                    at = max(at, start + size)
                left = b"".join([*kept, raw[at:]])
                texts[k], removed[k] = left.decode("utf-8", "ignore"), len(raw) - len(left)
            batch["text"], batch["bytes_removed"] = texts, removed
            yield batch

    return joined.mapInPandas(run, schema)


def dedup_chunks(docs: DataFrame, min_bytes: int = 120) -> DataFrame:
    """``docs`` without the spans that ``repeated_spans`` finds in them."""
    return without_spans(docs, staged(repeated_spans(docs, min_bytes), "spans"))
