"""SentencePiece encoding and decoding by a batched Viterbi search.

Words of equal length advance together, one character at a time, as rows of a matrix. Hashes of
the substrings that end at a character probe the sorted hashes of the pieces; every piece found
is a step from an earlier character, and the best step is stored as a back pointer.

The models at hand are of the merging kind, whose encoding is not the one of the largest summed score.
It is still the best path of the same lattice if a step is admissible only where the merges themselves would leave the two
neighbouring pieces apart: a sequence of pieces is the result of merging if, and only if, each pair of neighbours is
(``Pieces.apart``), so one step to each character remains. Results equal those of the library.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from pathlib import Path

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from membervane.llm.common import nullable, slices

#: The sign that stands for a blank.
BLANK = "▁"
BASE = np.uint64(0x9E3779B97F4A7C15)
#: Words of one length that advance together; words whose ids are kept; a word is searched for safe cuts from this length.
TOGETHER, KEPT, LONG = 10_000, 120_000, 24
#: Fewer than four words of this length or more advance one by one.
ALONE = 64
#: Bits of the table of first bits of hashes, and of the table of verdicts on pairs.
FILTER, PAIRS = 20, 21
NEVER = np.iinfo(np.int64).max


class Pieces:
    """The vocabulary of a model as arrays, and the search over it."""

    def __init__(self, model: bytes):
        found = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = found.get_piece_size()
        names = [found.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (found.is_byte(i) or found.is_control(i) or found.is_unknown(i) or found.is_unused(i))]
        self.size, self.unknown = n, n  # one more number: a character that is no piece
        self.bytes_at = np.full(256, found.unk_id(), np.int64)
        for i in range(n):
            if found.is_byte(i):
                self.bytes_at[int(names[i][3:5], 16)] = i
        ids = {names[i]: i for i in plain}
        rank = {names[i]: place for place, i in enumerate(sorted(plain, key=lambda i: (-found.get_score(i), i)))}
        self.longest = max(map(len, ids), default=1)
        self.powers = np.ones(self.longest + 1, np.uint64)
        for k in range(self.longest):
            self.powers[k + 1 :] *= BASE
        self.hash = np.full(n + 1, 1, np.uint64)
        self.length = np.ones(n + 1, np.int64)
        self.rank = np.full(n + 1, NEVER)
        self.made_at = np.full(n + 1, -1)  # rank of the merge that makes the piece, -1 for a character
        self.left, self.right = np.full(n + 1, -1), np.full(n + 1, -1)
        self.reachable = np.zeros(n + 1, bool)
        for name, i in ids.items():
            self.hash[i], self.length[i], self.rank[i] = self._hash(name), len(name), rank[name]
            halves = self._last_merge(name, rank)
            self.reachable[i] = halves is not None
            if halves and len(name) > 1:
                self.made_at[i], self.left[i], self.right[i] = rank[name], ids[halves[0]], ids[halves[1]]
        self.reachable[self.unknown] = True
        self.hash[self.unknown] = np.uint64(0xD1B54A32D192ED03)
        self.maybe = np.zeros(1 << FILTER, bool)  # first bits of the hashes that occur
        self.maybe[self.hash[plain] >> np.uint64(64 - FILTER)] = True
        self.pair_kept, self.pair_apart = np.full(1 << PAIRS, -1), np.zeros(1 << PAIRS, bool)
        order = np.argsort(self.hash[plain])
        self.keys, self.ids = self.hash[plain][order], np.array(plain)[order]
        if len(np.unique(self.keys)) < len(self.keys):
            raise ValueError("two pieces share a hash")
        self.pairs = {name[k : k + 2] for name in ids for k in range(len(name) - 1)}
        inner = any(BLANK in name.lstrip(BLANK) for name in ids)
        line = "" if any("\n" in name for name in ids) else "\n"
        self.words = re.compile("(?s).+" if inner else f"{BLANK}*[^{BLANK}{line}]+|{BLANK}+" + (f"|{line}" if line else ""))
        table = [bytes([int(x[3:5], 16)]) if found.is_byte(i) else b"" if found.is_control(i) else x.replace(BLANK, " ").encode() for i, x in enumerate(names)]
        self.blob = np.frombuffer(b"".join(table), np.uint8)
        self.blob_size = np.array([len(x) for x in table])
        self.blob_at = np.cumsum(self.blob_size) - self.blob_size
        self.kind = np.dtype("<u2") if n <= 1 << 16 else np.dtype("<u4")
        self.cache: dict[str, bytes] = {}
        self.id_of, self.verdicts = ids, {}

    @staticmethod
    def _hash(name: str) -> np.uint64:
        h = 0
        for c in name:
            h = (h * int(BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
        return np.uint64(h)

    @staticmethod
    def _last_merge(name: str, rank: dict[str, int]) -> tuple[str, str] | None:
        """The two parts that merging joins last to make a piece; None if it never makes it."""
        parts, halves = list(name), (name, "")
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda k: (rank.get(parts[k] + parts[k + 1], NEVER), k))
            if parts[best] + parts[best + 1] not in rank:
                return None
            halves = parts[best], parts[best + 1]
            parts[best : best + 2] = ["".join(halves)]
        return halves if name in rank else None

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Ids of the pieces with these hashes, -1 for none."""
        found = np.full(keys.shape, -1)
        likely = self.maybe[keys >> np.uint64(64 - FILTER)]
        few = keys[likely]
        at = np.minimum(np.searchsorted(self.keys, few), len(self.keys) - 1)
        found[likely] = np.where(self.keys[at] == few, self.ids[at], -1)
        return found

    def neighbours(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``apart``, with the verdicts on many pairs kept (each pair has one place, the last one there stays)."""
        code = a * (self.size + 1) + b
        place = (code.view(np.uint64) * BASE >> np.uint64(64 - PAIRS)).astype(np.int64)
        new, first = np.unique(code[self.pair_kept[place] != code], return_index=True)
        at = np.flatnonzero(self.pair_kept[place] != code)[first]
        verdict = self.apart(a[at], b[at])
        self.pair_kept[place[at]], self.pair_apart[place[at]] = new, verdict
        found, lost = self.pair_apart[place], self.pair_kept[place] != code
        if lost.any():
            found[lost] = self.apart(a[lost], b[lost])
        return found

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging leaves piece ``a`` and piece ``b`` as they are when they stand side by side.

        The merges that made the two are taken back, the latest first. If, at some moment, the parts that touch
        could be joined by a merge that comes before the one just taken back, merging would have done that.
        """
        fine = np.ones(len(a), bool)
        open_ = np.arange(len(a))
        limit = np.full(len(a), NEVER)
        while len(open_):
            joined = self.find(self.hash[a] * self.powers[np.minimum(self.length[b], self.longest)] + self.hash[b])
            early = (joined >= 0) & (self.rank[joined] < limit) & (self.length[a] + self.length[b] == self.length[joined])
            fine[open_[early]] = False
            made_a, made_b = self.made_at[a], self.made_at[b]
            go = ~early & ((made_a >= 0) | (made_b >= 0))
            open_, a, b, made_a, made_b = open_[go], a[go], b[go], made_a[go], made_b[go]
            first = made_a > made_b
            # Of two equal merges the one further left comes first.
            limit = np.where(first, made_a, made_b + 1)
            a, b = np.where(first, self.right[a], a), np.where(first, b, self.left[b])
        return fine

    def advance(self, words: Sequence[str]) -> list[bytes]:
        """Ids of words of one length."""
        n, size = len(words), len(words[0])
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(n, size).astype(np.uint64)
        sums = np.zeros((n, size + 1), np.uint64)
        for k in range(size):
            sums[:, k + 1] = sums[:, k] * BASE + codes[:, k] + np.uint64(1)
        last, back = np.full((n, size + 1), -1), np.zeros((n, size + 1), np.int64)
        for end in range(1, size + 1):
            span = min(end, self.longest)
            keys = sums[:, end, None] - sums[:, end - span : end] * self.powers[span:0:-1]
            ids = self.find(keys)
            ids[:, -1] = np.where(ids[:, -1] < 0, self.unknown, ids[:, -1])
            before = last[:, end - span : end]
            row, step = np.nonzero((ids >= 0) & self.reachable[ids] & ((before >= 0) | (np.arange(end - span, end) == 0)))
            a, b = before[row, step], ids[row, step]
            good, inner = np.ones(len(a), bool), a >= 0
            good[inner] = self.neighbours(a[inner], b[inner])
            score = np.zeros(ids.shape, np.int64)
            score[row, step] = np.where(good, span - step, 0)
            best = score.argmax(axis=1)
            back[:, end] = score[np.arange(n), best]
            last[:, end] = np.where(back[:, end] > 0, ids[np.arange(n), best], -1)
        at, found = np.full(n, size), []
        rows = np.arange(n)
        while at.any():
            found.append(np.where(at > 0, last[rows, at], -1))
            at = at - np.where(at > 0, back[rows, at], 0)
        grid = np.stack(found[::-1], axis=1)
        out, strange = [], (grid == self.unknown).any(axis=1)
        flat, ends = grid[grid >= 0].astype(self.kind).tobytes(), np.cumsum((grid >= 0).sum(axis=1)) * self.kind.itemsize
        begin = 0
        for k, end in enumerate(ends.tolist()):
            out.append(self._with_bytes(words[k], grid[k]) if strange[k] else flat[begin:end])
            begin = end
        return out

    def advance_alone(self, word: str) -> bytes:
        """Ids of a long word that has no others of its length to advance with: the same steps, one by one."""
        last, back = [-1] * (len(word) + 1), [0] * (len(word) + 1)
        for end in range(1, len(word) + 1):
            for begin in range(max(0, end - self.longest), end):
                i = self.id_of.get(word[begin:end], self.unknown if end - begin == 1 else None)
                if i is None or not self.reachable[i] or (begin and last[begin] < 0):
                    continue
                if begin:
                    pair = last[begin], i
                    good = self.verdicts.get(pair)
                    if good is None:
                        good = self.verdicts[pair] = bool(self.apart(np.array(pair[:1]), np.array(pair[1:]))[0])
                    if not good:
                        continue
                last[end], back[end] = i, end - begin
                break
        found, at = [], len(word)
        while at:
            found.append(last[at])
            at -= back[at]
        return self._with_bytes(word, np.array(found[::-1]))

    def _with_bytes(self, word: str, ids: np.ndarray) -> bytes:
        """Ids of a word in which characters that are no piece are spelled in bytes."""
        found, at = [], 0
        for i in ids[ids >= 0].tolist():
            if i == self.unknown:
                found += self.bytes_at[list(word[at].encode("utf-8", "replace"))].tolist()
            else:
                found.append(i)
            at += int(self.length[i])
        return np.array(found, self.kind).tobytes()

    def _cut(self, word: str) -> list[str]:
        """A long word cut between characters that stand side by side in no piece, so that no merge crosses."""
        if len(word) < LONG:
            return [word]
        places = [k + 1 for k in range(len(word) - 1) if word[k : k + 2] not in self.pairs]
        return [word[a:b] for a, b in zip([0, *places], [*places, len(word)])]

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """Ids of texts, as packed little-endian numbers."""
        split = [self.words.findall(BLANK + t.replace(" ", BLANK)) if t else [] for t in texts]
        if len(self.cache) > KEPT:
            self.cache, self.verdicts = {}, {}
        known = self.cache
        fresh = {w for words in split for w in words if w not in known}
        parts = {w: self._cut(w) for w in fresh if len(w) >= LONG}
        by_length: dict[int, list[str]] = {}
        for w in {p for w in fresh for p in parts.get(w, (w,))}:
            by_length.setdefault(len(w), []).append(w)
        solved: dict[str, bytes] = {}
        for size, words in by_length.items():
            if size >= ALONE and len(words) < 4:
                solved.update((w, self.advance_alone(w)) for w in words)
                continue
            step = max(1, TOGETHER * 8 // max(8, size))
            for at in range(0, len(words), step):
                some = words[at : at + step]
                solved.update(zip(some, self.advance(some)))
        for w in fresh:
            known[w] = b"".join([solved[p] for p in parts[w]]) if w in parts else solved[w]
        return [b"".join([known[w] for w in words]) for words in split]

    def decode(self, packed: bytes) -> str:
        ids = np.frombuffer(packed, self.kind).astype(np.int64)
        size = self.blob_size[ids]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(self.blob_at[ids] - (ends - size), size)
        return self.blob[at].tobytes().decode("utf-8", "replace").removeprefix(" ")


_loaded: dict[int, Pieces] = {}


def load(model: bytes) -> Pieces:
    """The arrays of a model, built once per process."""
    key = hash(model)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Pieces(model)
    return _loaded[key]


def _ids(pieces: Pieces, batch: pd.DataFrame) -> list:
    texts, found = batch["text"].tolist(), []
    for at in range(0, len(texts), 500):
        part = texts[at : at + 500]
        found += [None if t is None else p for t, p in zip(part, pieces.encode([t or "" for t in part]))]
    return found


def _texts(pieces: Pieces, batch: pd.DataFrame) -> list:
    return [None if p is None else pieces.decode(p) for p in batch["ids"]]


_OUTPUTS = {"ids": (T.BinaryType(), _ids), "decoded": (T.StringType(), _texts)}


def _mapped(docs: DataFrame, model_file: str, *outputs: str) -> DataFrame:
    kept = docs.select(*[c for c in docs.columns if c not in outputs])
    model = docs.sparkSession.sparkContext.broadcast(Path(model_file).read_bytes())
    schema = nullable(kept)
    for name in outputs:
        schema = schema.add(name, _OUTPUTS[name][0])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = load(model.value)
        for batch in slices(batches):
            for name in outputs:
                batch[name] = _OUTPUTS[name][1](pieces, batch)
            yield batch
        pieces.cache = {}  # the process may go on to other work

    return kept.mapInPandas(run, schema)


def encode(docs: DataFrame, model_file: str) -> DataFrame:
    """``docs`` with ``ids``: the pieces of ``text`` as packed little-endian numbers (16 bits up to 65,536 pieces).

    Null texts have null ids, empty texts none (an empty value). All other columns stay; one that is named ``ids`` is replaced. Repeated
    rows get equal results, an empty table an empty one. The model file is read on the driver and broadcast.
    """
    return _mapped(docs, model_file, "ids")


def decode(encoded: DataFrame, model_file: str) -> DataFrame:
    """Encoded rows with ``decoded``: the text that their ``ids`` spell.

    It equals the text that was encoded, unless that held the sign for a blank (U+2581), which decodes to a blank. Null
    ids decode to null.
    """
    return _mapped(encoded, model_file, "decoded")


def encode_and_decode(docs: DataFrame, model_file: str) -> DataFrame:
    """``docs`` with ``ids`` and ``decoded``, in one pass through one Python process per task."""
    return _mapped(docs, model_file, "ids", "decoded")

