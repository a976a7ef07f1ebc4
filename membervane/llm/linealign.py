"""Line deduplication by pairwise alignment (patience diff).

Documents meet through windows: the shortest runs of adjacent lines that are long enough to go, one from and one up to
every line, and the shorter runs that few documents hold. A block that is long or rare consists of such windows, so the
document that first holds a window names a pair, and the pairs grow with the text, however often a line recurs. All
lines of a pair are aligned by a patience diff, and the common blocks that are long or rare are deleted from the later document.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from membervane.llm.common import slices, staged, with_column

#: Lines emitted at once.
ROWS = 200_000
#: Bytes of a packed line: its hash, words and characters.
LINE_SIZE = 18
LINE = "doc_id long, at int, h1 long, h2 long, nth int, words int"


def lines_of(docs: DataFrame) -> DataFrame:
    """``doc_id, at, h1, h2, nth, words`` of every line that is not blank: place, 128-bit hash, occurrence in the document."""

    def emit(columns: list[list], digests: list[bytes]) -> pd.DataFrame:
        halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        return pd.DataFrame(
            {
                "doc_id": np.array(columns[0], np.int64),
                "at": np.array(columns[1], np.int32),
                "h1": halves[:, 0],
                "h2": halves[:, 1],
                "nth": np.array(columns[2], np.int32),
                "words": np.array(columns[3], np.int32),
            }
        )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hash_of = xxhash.xxh3_128_digest
        columns, digests = [[], [], [], []], []
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                seen: dict[bytes, int] = {}
                for at, line in enumerate(text.split("\n")):
                    line = line.strip()
                    if line:
                        h = hash_of(line.encode("utf-8", "surrogatepass"))
                        nth = seen[h] = seen.get(h, 0) + 1
                        digests.append(h)
                        for column, value in zip(columns, (doc_id, at, nth, line.count(" ") + 1)):
                            column.append(value)
                        if len(digests) >= ROWS:
                            yield emit(columns, digests)
                            columns, digests = [[], [], [], []], []
            if digests:
                yield emit(columns, digests)
                columns, digests = [[], [], [], []], []

    usable = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    return usable.select("doc_id", "text").mapInPandas(run, LINE)


def first_holders(lines: DataFrame) -> DataFrame:
    """For every occurrence of a line that several documents hold: its first document, the place there, and the number of documents."""
    grouped = lines.groupBy("h1", "h2", "nth").agg(F.min(F.struct("doc_id", "at")).alias("first"), F.count(F.lit(1)).alias("held"))
    return grouped.where("held > 1").select("h1", "h2", "nth", F.col("first.doc_id").alias("first_id"), F.col("first.at").alias("first_at"), "held")


def longest_rising(values: list[int]) -> list[int]:
    """Places of a longest strictly rising subsequence."""
    tops: list[int] = []
    ends: list[int] = []
    back = [-1] * len(values)
    for k, v in enumerate(values):
        place = bisect_left(tops, v)
        back[k] = ends[place - 1] if place else -1
        tops[place : place + 1] = [v]
        ends[place : place + 1] = [k]
    found, k = [], ends[-1] if ends else -1
    while k >= 0:
        found.append(k)
        k = back[k]
    return found[::-1]


def patience(own: list[int], other: list[int], unique: list[bool]) -> list[int]:
    """Places of the aligned pairs of lines, given in rising order of ``own``.

    Lines that are unique in both documents are aligned first (a longest common order); the
    others are then aligned between two such anchors.
    """
    singles = [k for k, u in enumerate(unique) if u]
    anchors = [singles[k] for k in longest_rising([other[k] for k in singles])]
    if len(singles) == len(own):
        return anchors
    found, edges = [], [(-1, -1), *[(k, other[k]) for k in anchors], (len(own), 1 << 62)]
    for (k, low), (stop, high) in zip(edges, edges[1:]):
        between = [x for x in range(k + 1, stop) if low < other[x] < high]
        found += [between[x] for x in longest_rising([other[x] for x in between])]
        if stop < len(own):
            found.append(stop)
    return found


def deletions(shared: list[tuple], rare_documents: int, long_words: int) -> list[int]:
    """Places of the lines to delete from one document.

    ``shared`` has ``(first_id, at, first_at, held, words, nth, key)`` of its lines with an earlier first holder. A
    block is a run of aligned lines without a gap of other shared or unshared lines in either
    document; it goes if one of its lines is rare: held by few documents, or long.
    """
    gone: list[int] = []
    for _, rows in groupby(sorted(shared), key=lambda r: r[0]):
        rows = list(rows)
        repeats = Counter(r[6] for r in rows)
        aligned = patience([r[1] for r in rows], [r[2] for r in rows], [repeats[r[6]] == 1 for r in rows])
        block: list[tuple] = []
        for r in [*(rows[k] for k in aligned), None]:
            if block and (r is None or r[1] - block[-1][1] != 1 or r[2] - block[-1][2] != 1):
                if any(x[3] <= rare_documents or x[4] >= long_words for x in block):
                    gone += [x[1] for x in block]
                block = []
            if r is not None:
                block.append(r)
    return gone


def dedup_lines(docs: DataFrame, rare_documents: int = 20, long_words: int = 8) -> DataFrame:
    """``docs`` without the lines that their first holder holds in an aligned block: the narrow rule, see ``dedup_blocks`` for the whole one.

    Each line meets its first holder only, so a copied block is cut where one of its lines stood elsewhere before.

    A line is rare if at most ``rare_documents`` documents hold it, or if it has ``long_words`` words or more
    (a line of that length does not recur by chance, however often it was copied). Lines are compared without white
    space around them. The columns of ``docs`` (``doc_id``, ``text`` and any others) stay, and
    ``lines_removed`` is added. A document that loses all its lines keeps an empty text. Null
    texts and rows without a ``doc_id`` stay as they are, blank lines stay where they are. Rows that share a ``doc_id`` are the same
    document: a line goes from each of them only where it stands in the same place. Empty tables give empty results.
    """
    lines = staged(lines_of(docs), "lines")
    holders = staged(first_holders(lines), "holders")
    shared = lines.join(holders, ["h1", "h2", "nth"]).where(F.col("first_id") < F.col("doc_id"))
    found = F.struct("first_id", "at", "first_at", "held", "words", "nth", F.col("h1").alias("key"))
    shared = shared.groupBy("doc_id").agg(F.collect_list(found).alias("_shared"))
    names = [c for c in docs.columns if c != "lines_removed"]
    joined = docs.select(*names).join(shared, "doc_id", "left").select(*names, "_shared")
    schema = with_column(docs.select(*names), "lines_removed", T.IntegerType())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in slices(batches):
            texts, removed = batch["text"].tolist(), [0] * len(batch)
            for k, rows in enumerate(batch.pop("_shared")):
                if rows is None or texts[k] is None:
                    continue
                gone = set(deletions([tuple(r.values()) if isinstance(r, dict) else tuple(r) for r in rows], rare_documents, long_words))
                if gone:
                    parts = texts[k].split("\n")
                    left = [p for at, p in enumerate(parts) if at not in gone]
                    texts[k], removed[k] = "\n".join(left), len(parts) - len(left)
            batch["text"], batch["lines_removed"] = texts, np.array(removed, np.int32)
            yield batch

    return joined.mapInPandas(run, schema)


def packed_lines(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, lines`` of every document: ``LINE_SIZE`` bytes for each line that is not blank."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hash_of = xxhash.xxh3_128_digest
        for batch in batches:
            packed = []
            for text in batch.pop("text"):
                lines = []
                for line in text.split("\n"):
                    line = line.strip()
                    if line:
                        lines += (hash_of(line.encode("utf-8", "surrogatepass")), bytes((min(len(line.split()), 255), min(len(line), 255))))
                packed.append(b"".join(lines))
            yield batch.assign(lines=packed)

    usable = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    return usable.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInPandas(run, "doc_id long, text_hash long, lines binary")


def unpacked(packed: bytes) -> tuple[list[bytes], list[int], list[int]]:
    """Hashes, words and characters (both up to 255) of packed lines."""
    hashes = [packed[at : at + 16] for at in range(0, len(packed), LINE_SIZE)]
    return hashes, list(packed[16::LINE_SIZE]), list(packed[17::LINE_SIZE])


def key_of(hashes: list[bytes]) -> bytes:
    """The name of a run of lines."""
    return hashes[0] if len(hashes) == 1 else xxhash.xxh3_128_digest(b"".join(hashes))


def half_of(key: bytes) -> int:
    return int.from_bytes(key[:8], "little", signed=True)


def windows(words: list[int], chars: list[int], long_words: int, long_chars: int) -> Iterator[tuple[int, int, bool]]:
    """``start, stop, long`` of the shortest long runs from each line and up to each line, and of all runs too short for that."""
    n, stop, start, found = len(words), 0, 0, set()
    w = c = 0
    for at in range(n):
        while stop < n and w < long_words and c < long_chars:
            w, c, stop = w + words[stop], c + chars[stop], stop + 1
        full = w >= long_words or c >= long_chars
        for end in range(at + 1, stop if full else stop + 1):
            yield at, end, False
        if full:
            found.add((at, stop))
        w, c = w - words[at], c - chars[at]
    w = c = 0
    for at in range(n):
        w, c = w + words[at], c + chars[at]
        while w - words[start] >= long_words or c - chars[start] >= long_chars:
            w, c, start = w - words[start], c - chars[start], start + 1
        if w >= long_words or c >= long_chars:
            found.add((start, at + 1))
    for start, stop in sorted(found):
        yield start, stop, True


def numbered(hashes: list[bytes], words: list[int], chars: list[int], long_words: int, long_chars: int) -> Iterator[tuple[int, int, bool, int, bytes]]:
    """The windows with their occurrence in the document and a key of both, so that a document with as many occurrences is met."""
    seen: dict[bytes, int] = {}
    for start, stop, long in windows(words, chars, long_words, long_chars):
        run = key_of(hashes[start:stop])
        nth = seen[run] = seen.get(run, 0) + 1
        yield start, stop, long, nth, run if nth == 1 else xxhash.xxh3_128_digest(run + nth.to_bytes(8, "little"))


def window_keys(packed: DataFrame, long_words: int, long_chars: int) -> DataFrame:
    """``doc_id, h1, h2, long`` of the numbered windows of every document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, keys, longs = [], [], []

        def emit() -> pd.DataFrame:
            halves = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
            return pd.DataFrame({"doc_id": np.array(ids, np.int64), "h1": halves[:, 0], "h2": halves[:, 1], "long": np.array(longs, bool)})

        for batch in batches:
            for doc_id, lines in zip(batch["doc_id"], batch["lines"]):
                hashes, words, chars = unpacked(bytes(lines))
                own = {key: long for _, _, long, _, key in numbered(hashes, words, chars, long_words, long_chars)}
                ids += [doc_id] * len(own)
                keys += own
                longs += own.values()
                if len(keys) >= ROWS:
                    yield emit()
                    ids, keys, longs = [], [], []
        if keys:
            yield emit()

    return packed.select("doc_id", "lines").mapInPandas(run, "doc_id long, h1 long, h2 long, long boolean")


def first_windows(keys: DataFrame, rare_documents: int) -> DataFrame:
    """``h1, h2, first_id`` of the windows that several documents hold and that are long or held by few."""
    grouped = keys.groupBy("h1", "h2").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("held"), F.first("long").alias("_long"))
    return grouped.where((F.col("held") > 1) & (F.col("_long") | (F.col("held") <= rare_documents))).select("h1", "h2", "first_id")


def singles_of(lines: list[bytes], low: int, high: int, run: int) -> dict:
    """Place of every run of so many lines between two places, -1 if it stands there more than once."""
    counts: dict = {}
    for at in range(low, high - run + 1):
        key = lines[at] if run == 1 else tuple(lines[at : at + run])
        counts[key] = -1 if key in counts else at
    return counts


def align(own: list[bytes], other: list[bytes]) -> list[tuple[int, int]]:
    """Pairs of places of equal lines, rising in both: patience diff over all common lines.

    Next to an anchor the lines that go on with it are taken first, then the lines that stand once on both sides, in a longest
    common order. Where no line does, runs of 2, 4, 8 … lines are looked at; where no run does either (the
    text is periodic), equal lines are taken in turn.
    """
    found, todo = [], [(0, len(own), 0, len(other), False, False)]
    while todo:
        a, b, c, d, after, before = todo.pop()
        while after and a < b and c < d and own[a] == other[c]:
            found.append((a, c))
            a, c = a + 1, c + 1
        while before and a < b and c < d and own[b - 1] == other[d - 1]:
            b, d = b - 1, d - 1
            found.append((b, d))
        run, anchors = 1, []
        while run <= min(b - a, d - c):
            mine, theirs = singles_of(own, a, b, run), singles_of(other, c, d, run)
            common = [(mine[k], theirs[k]) for k in mine if k in theirs]
            if not common:
                break
            single = sorted(p for p in common if p[0] >= 0 and p[1] >= 0)
            if single:
                anchors = [single[k] for k in longest_rising([p[1] for p in single])]
                break
            run *= 2
        if anchors:
            found += anchors
            todo.append((a, anchors[0][0], c, anchors[0][1], False, True))
            for (i, j), (k, m) in zip(anchors, anchors[1:]):
                todo.append((i + 1, k, j + 1, m, True, True))
            todo.append((anchors[-1][0] + 1, b, anchors[-1][1] + 1, d, True, False))
        elif run > 1:
            places: dict[bytes, list[int]] = {}
            for j in range(d - 1, c - 1, -1):
                places.setdefault(other[j], []).append(j)
            turn = [(i, places[own[i]].pop()) for i in range(a, b) if places.get(own[i])]
            found += [turn[k] for k in longest_rising([p[1] for p in turn])]
    return sorted(found)


def doomed(lines: bytes, earlier: bytes, named: set[int], long_words: int, long_chars: int) -> list[int]:
    """Numbers (blank lines do not count) of the lines to delete from one document because of an earlier one.

    A block is a run of aligned lines without a gap in either document. It goes if it is long in all, or
    if it holds a rare run. ``named`` has the windows that the earlier document is the first to hold, by the first halves
    of their keys. All lines are aligned, and if that leaves lines of such windows, these lines again among themselves: what
    crosses only lines that a third document held first was not moved.
    """
    (hashes, words, chars), other = unpacked(lines), unpacked(earlier)[0]
    own, rare = set(), set()
    for a, b, long, nth, key in numbered(hashes, words, chars, long_words, long_chars):
        if half_of(key) in named:
            own.update(range(a, b))
            if not long:
                rare.update([(a, b), half_of(key)] if nth == 1 else [(a, b)])

    def goes(low: int, high: int) -> bool:
        if sum(words[low:high]) >= long_words or sum(chars[low:high]) >= long_chars:
            return True
        return bool(rare) and any((i, j) in rare or half_of(key_of(hashes[i:j])) in rare for i in range(low, high) for j in range(i + 1, high + 1))

    def blocks(aligned: list[tuple[int, int]]) -> Iterator[int]:
        low = 0
        for k in range(1, len(aligned) + 1):
            if k == len(aligned) or aligned[k][0] - aligned[k - 1][0] != 1 or aligned[k][1] - aligned[k - 1][1] != 1:
                if goes(aligned[low][0], aligned[k - 1][0] + 1):
                    yield from range(aligned[low][0], aligned[k - 1][0] + 1)
                low = k

    gone = set(blocks(align(hashes, other)))
    if own - gone:
        mine, held = sorted(own), {hashes[k] for k in own}
        theirs = [k for k, h in enumerate(other) if h in held]
        gone.update(blocks([(mine[i], theirs[j]) for i, j in align([hashes[k] for k in mine], [other[k] for k in theirs])]))
    return sorted(gone)


def dedup_blocks(docs: DataFrame, rare_documents: int = 20, long_words: int = 8, long_chars: int = 40) -> DataFrame:
    """``docs`` without the lines that an earlier document (smaller ``doc_id``) holds in an aligned block.

    A block goes if its lines have ``long_words`` words or ``long_chars`` characters in all, however many documents hold it, or if
    a run of its lines is held by at most ``rare_documents`` documents (as often as the document holds it). Lines are compared without white
    space around them, and blank lines do not part a block. A block that stands in another order than in the document that first holds it stays, as does
    the second copy of a block inside one document. The columns of ``docs`` (``doc_id``, ``text`` and any others) stay, and
    ``lines_removed`` is added. A document that loses all its lines keeps an empty text. Null
    texts and rows without a ``doc_id`` stay as they are, blank lines stay where they are. Rows that share a ``doc_id`` are not compared
    with one another; each is aligned by its own lines. Empty tables give empty results.
    """
    packed = staged(packed_lines(docs), "lines")
    keys = staged(window_keys(packed, long_words, long_chars), "windows")
    firsts = staged(first_windows(keys, rare_documents), "holders")
    pairs = keys.join(firsts, ["h1", "h2"]).where(F.col("first_id") < F.col("doc_id"))
    pairs = staged(pairs.groupBy("doc_id", "first_id").agg(F.collect_set("h1").alias("named")), "pairs")
    earlier = packed.select(F.col("doc_id").alias("first_id"), F.col("lines").alias("earlier"))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = zip(batch["lines"], batch["earlier"], batch["named"])
            gone = [np.array(doomed(bytes(own), bytes(other), set(named), long_words, long_chars), np.int32).tobytes() for own, other, named in rows]
            yield batch[["doc_id", "text_hash"]].assign(gone=gone)

    met = pairs.join(earlier, "first_id").join(packed, "doc_id").select("doc_id", "text_hash", "lines", "earlier", "named")
    gone = met.mapInPandas(compare, "doc_id long, text_hash long, gone binary").where(F.length("gone") > 0)
    gone = gone.groupBy("doc_id", "text_hash").agg(F.collect_set("gone").alias("_gone"))
    names = [c for c in docs.columns if c != "lines_removed"]
    gone = gone.withColumnsRenamed({"doc_id": "_id", "text_hash": "_text_hash"})
    joined = docs.select(*names).join(gone, (F.col("doc_id") == F.col("_id")) & (F.xxhash64("text") == F.col("_text_hash")), "left").select(*names, "_gone")
    schema = with_column(docs.select(*names), "lines_removed", T.IntegerType())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in slices(batches):
            texts, removed = batch["text"].tolist(), [0] * len(batch)
            for k, found in enumerate(batch.pop("_gone")):
                if found is None:
                    continue
                numbers = {int(n) for part in found for n in np.frombuffer(bytes(part), np.int32)}
                left, number = [], -1
                for line in texts[k].split("\n"):
                    number += bool(line.strip())
                    if line.strip() and number in numbers:
                        removed[k] += 1
                    else:
                        left.append(line)
                texts[k] = "\n".join(left)
            batch["text"], batch["lines_removed"] = texts, np.array(removed, np.int32)
            yield batch

    return joined.mapInPandas(run, schema)
