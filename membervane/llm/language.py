"""Language identification with string kernels.

The kernel of two texts is the number of character n-grams (blended spectrum, n = 1 to 3) that both hold,
over the geometric mean of their numbers. Landmark texts span a Nystroem approximation, in which
one-versus-rest kernel ridge regression is solved in closed form. A batch of texts is scored by two
matrix products: n-gram presence by landmarks, then kernel values by coefficients.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from membervane.llm.common import slices, with_column

#: n-grams are told apart by so many bits of a multiplicative hash.
BITS = 20
ORDERS = (1, 2, 3)
#: Texts scored together; characters of a text looked at together.
BATCH, STRETCH = 64, 1 << 20
UNKNOWN = "und"


@cache
def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def characters(text: str) -> np.ndarray:
    """Code points of the lower-cased text, with a blank for everything but letters and one around the text."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(letters()[codes], codes, np.uint32(32))


def grams(codes: np.ndarray) -> np.ndarray:
    """Hashed n-grams of all orders, repeats included."""
    step = np.uint64(0x9E3779B97F4A7C15)
    wide, found, rolled = codes.astype(np.uint64), [], None
    for n in ORDERS:
        if len(wide) < n:
            break
        rolled = wide if n == 1 else rolled[:-1] * step + wide[n - 1 :]
        mixed = (rolled + np.uint64(n)) * step
        mixed ^= mixed >> np.uint64(32)
        found.append((mixed * step) >> np.uint64(64 - BITS))
    return np.concatenate(found).astype(np.int64) if found else np.zeros(0, np.int64)


@dataclass
class Model:
    """``columns``: place of a hashed n-gram in ``presence`` (n-grams by landmarks), -1 for others."""

    languages: list[str]
    columns: np.ndarray
    presence: np.ndarray
    norms: np.ndarray
    coefficients: np.ndarray

    def kernel(self, texts: list[np.ndarray]) -> np.ndarray:
        """Normalised kernel values of texts (as ``characters``) with the landmarks."""
        held = np.zeros((len(texts), len(self.presence)), np.float32)
        own = np.ones(len(texts), np.float32)
        for k, codes in enumerate(texts):
            seen = np.zeros(1 << BITS, bool) if len(codes) > STRETCH // 8 else None
            if seen is None:
                hashes = np.unique(grams(codes))
            else:  # a long text is looked at in overlapping stretches
                for at in range(0, len(codes), STRETCH):
                    seen[grams(codes[at : at + STRETCH + max(ORDERS) - 1])] = True
                hashes = np.flatnonzero(seen)
            places = self.columns[hashes]
            held[k, places[places >= 0]] = 1
            own[k] = max(1, len(hashes))
        return (held @ self.presence) / np.sqrt(own[:, None] * self.norms)

    def scores(self, texts: list[np.ndarray]) -> np.ndarray:
        return self.kernel(texts) @ self.coefficients


def fit(rows: list[tuple[str, str]], landmarks: int, ridge: float) -> Model:
    """A model from ``(text, language)`` rows; the first rows of each language serve as landmarks, in equal numbers."""
    rows = [(characters(t), lang) for t, lang in rows if letters()[np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)].any()]
    languages = sorted({lang for _, lang in rows})
    if not rows:
        return Model([], np.full(1 << BITS, -1, np.int32), np.zeros((0, 0), np.float32), np.zeros(0, np.float32), np.zeros((0, 0)))
    each = max(1, landmarks // len(languages))
    chosen = [codes for one in languages for codes in [c for c, lang in rows if lang == one][:each]]
    sets = [np.unique(grams(codes)) for codes in chosen]
    known = np.unique(np.concatenate(sets))
    columns = np.full(1 << BITS, -1, np.int32)
    columns[known] = np.arange(len(known))
    presence = np.zeros((len(known), len(chosen)), np.float32)
    for k, held in enumerate(sets):
        presence[columns[held], k] = 1
    model = Model(languages, columns, presence, np.array([len(s) for s in sets], np.float32), np.zeros((0, 0)))
    k_nm = np.concatenate([model.kernel([c for c, _ in rows[at : at + BATCH]]) for at in range(0, len(rows), BATCH)]).astype(np.float64)
    k_mm = model.kernel(chosen).astype(np.float64)
    wanted = np.array([[float(lang == one) for one in languages] for _, lang in rows])
    # Languages count alike however many rows each has.
    weight = 1 / wanted.sum(axis=0)[wanted.argmax(axis=1)]
    left = k_nm.T @ (k_nm * weight[:, None]) + ridge * (k_mm + 1e-3 * np.eye(len(chosen)))
    model.coefficients = np.linalg.solve(left, k_nm.T @ (wanted * weight[:, None]))
    return model


def held_out(doc_id: Column) -> Column:
    """Documents that nothing is learned from: a third of them by a checksum of the id."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def training_rows(docs: DataFrame, per_language: int) -> list[tuple[str, str]]:
    """At most ``per_language`` texts of every language, those with the smallest hash of the id.

    Counts per language give the hash below which about twice as many rows lie, so only these rows
    leave the scan.
    """
    usable = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = usable.groupBy("lang").count().collect()
    if not counts:
        return []
    order = F.xxhash64(F.lit("train"), "doc_id").bitwiseAND(2**62 - 1)
    bound = {r["lang"]: int(2**62 * min(1.0, (2 * per_language + 50) / r["count"])) for r in counts}
    limits = F.create_map(*[F.lit(x) for pair in bound.items() for x in pair])
    sample = usable.where(order <= F.element_at(limits, F.col("lang"))).select("lang", "text", order.alias("o"), "doc_id").collect()
    taken: dict[str, list] = {}
    for r in sorted(sample, key=lambda r: (r["o"], str(r["doc_id"]), r["text"])):
        taken.setdefault(r["lang"], []).append((r["text"], r["lang"]))
    return [x for lang in sorted(taken) for x in taken[lang][:per_language]]


def identify(docs: DataFrame, per_language: int = 150, landmarks: int = 160, ridge: float = 1e-3) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1, of the language predicted) and ``held_out``.

    ``docs`` has ``doc_id, text, lang`` and any other columns, which stay. The model is fitted on the driver
    on at most ``per_language`` rows of each language (null languages and held-out rows never), with
    about ``landmarks`` landmarks; predictions look at the whole text and at nothing else. Null texts and texts without a letter get
    ``und`` and score 0, as does everything if there is nothing to learn from. A column of ``docs`` that is
    named like a result is replaced. Repeated rows get equal results; an empty table an empty one.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(training_rows(docs, per_language), landmarks, ridge))
    names = [c for c in docs.columns if c not in ("lang_pred", "score", "held_out")]
    kept = docs.select(*names)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, is_letter = model.value, letters()
        for batch in slices(batches):
            texts = batch["text"].tolist()
            lang, score = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
            for at in range(0, len(texts), BATCH):
                codes = [characters(t or "") for t in texts[at : at + BATCH]]
                spoken = [k for k, c in enumerate(codes) if is_letter[c].any()]
                if spoken and known.languages:
                    found = known.scores([codes[k] for k in spoken])
                    best = found.argmax(axis=1)
                    places = np.array(spoken) + at
                    lang[places] = np.array(known.languages, object)[best]
                    score[places] = np.clip(found[np.arange(len(best)), best], 0, 1)
            batch["lang_pred"], batch["score"] = lang, score
            yield batch

    schema = with_column(kept, "lang_pred", T.StringType()).add("score", T.DoubleType())
    found = kept.mapInPandas(run, schema)
    return found.withColumn("held_out", held_out(F.col("doc_id")))
