"""Exact top-k by inner product with a forest of M-trees.

Integer vectors get one more coordinate that gives all of them the same length, so that the largest inner product is the
smallest distance, and a distance is a metric. The vectors are sorted by their nearest routing vector and their
distance from it, and cut into trees of pages. A page keeps its pivot, its covering radius, and the distance of every vector
from the pivot; a tree keeps its pages. Every query starts with the best scores of its own page and then searches
each tree best first: pages in order of their least possible distance, until that exceeds the k-th best so far. Inside a page the stored
distances rule out vectors by the triangle inequality before any product is computed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from membervane.llm.common import staged

#: Vectors of a page and of a tree, routing vectors, queries that search a tree together.
PAGE, TREE, ROUTES, TOGETHER = 512, 16_384, 128, 4096
#: Bounds are widened by this for the rounding of square roots.
SLACK = 1e-6
PAGES = "tree int, page int, pivot array<double>, radius double, ids array<long>, away array<double>, vectors array<array<long>>"
FOUND = "query_id long, vec_id long, score long"


def as_integers(embedding: Column, scale: int = 64) -> Column:
    """``floor(scale * x)`` of every component, as longs; null unless all components are finite numbers."""
    x = F.transform(embedding, lambda v: v.cast("double"))
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return F.when(fine, F.transform(x, lambda v: F.floor(v * scale).cast("long")))


def lifted(vectors: np.ndarray, norm: float) -> np.ndarray:
    """Vectors with the coordinate that brings their squared length to ``norm``."""
    v = vectors.astype(np.float64)
    return np.concatenate([v, np.sqrt(np.maximum(0, norm - (v * v).sum(axis=1)))[:, None]], axis=1)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squares = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(squares, 0))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products: in floating point while that is exact."""
    largest = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if largest < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def stacked(vectors: pd.Series, width: int) -> np.ndarray:
    """One row per vector, short ones filled with zeros."""
    out = np.zeros((len(vectors), width), np.int64)
    for k, v in enumerate(vectors):
        out[k, : len(v)] = v
    return out


def pages_of(vectors: DataFrame, norm: float, width: int, routes: np.ndarray, count: int) -> DataFrame:
    """The pages of all trees; a tree is a range of (nearest routing vector, distance, id)."""

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            d = distances(lifted(stacked(batch["vector"], width), norm), routes)
            batch["cell"] = d.argmin(axis=1).astype(np.int32)
            batch["away"] = d.min(axis=1)
            yield batch

    routed = vectors.mapInPandas(route, "vec_id long, vector array<long>, cell int, away double")
    trees = max(1, -(-count // TREE))
    order = ["cell", "away", "vec_id"]
    ranged = routed.repartitionByRange(trees, *order).sortWithinPartitions(*order).withColumn("tree", F.spark_partition_id())

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = 0
        for batch in batches:
            for _, cell in batch.groupby("cell", sort=True):
                for at in range(0, len(cell), PAGE):
                    part = cell.iloc[at : at + PAGE]
                    v = stacked(part["vector"], width)
                    x = lifted(v, norm)
                    middle = x.mean(axis=0, keepdims=True)
                    pivot = x[distances(x, middle)[:, 0].argmin()]
                    away = distances(x, pivot[None])[:, 0]
                    order = np.argsort(away, kind="stable")
                    yield pd.DataFrame(
                        {
                            "tree": part["tree"].iloc[:1].to_numpy(),
                            "page": [number],
                            "pivot": [pivot],
                            "radius": [away.max()],
                            "ids": [part["vec_id"].to_numpy()[order]],
                            "away": [away[order]],
                            "vectors": [list(v[order])],
                        }
                    )
                    number += 1

    return ranged.select("tree", "cell", "vec_id", "vector").mapInPandas(pack, PAGES)


def queries_of(pages: DataFrame, every: int, k: int) -> DataFrame:
    """``query_id, vector, bound``: the queries, with the k-th best score of their own page as a first bound."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for ids, vectors in zip(batch["ids"], batch["vectors"]):
                asking = np.flatnonzero(ids % every == 0)
                if not len(asking):
                    continue
                v = np.stack(list(vectors))
                bound = np.full(len(asking), np.iinfo(np.int64).min)
                if len(ids) > k:
                    scores = products(v[asking], v).astype(np.float64)
                    scores[np.arange(len(asking)), asking] = -np.inf
                    bound = np.partition(scores, -k, axis=1)[:, -k]
                    bound = np.floor(bound).astype(np.int64)
                yield pd.DataFrame({"query_id": ids[asking], "vector": list(v[asking]), "bound": bound})

    return pages.select("ids", "vectors").mapInPandas(run, "query_id long, vector array<long>, bound long")


def best_first(pages: pd.DataFrame, ids: np.ndarray, asking: np.ndarray, bound: np.ndarray, norm: float, k: int) -> tuple[pd.DataFrame, int]:
    """The up to ``k`` best of one tree for each query that reach its bound, and the number of products computed.

    All queries take their next page at the same time; a query is done when its next page cannot hold a score as good as
    its k-th best. Equal scores are kept, so ties can be decided by id afterwards.
    """
    q = np.concatenate([asking.astype(np.float64), np.zeros((len(asking), 1))], axis=1)
    length = (q * q).sum(axis=1)
    pivots = np.stack([np.asarray(p) for p in pages["pivot"]])
    to_pivot = distances(q, pivots)
    least = np.maximum(0, to_pivot - pages["radius"].to_numpy()[None])
    order = np.argsort(least, axis=1, kind="stable")
    vectors = [np.stack(list(v)) for v in pages["vectors"]]
    names = [np.asarray(x) for x in pages["ids"]]
    away = [np.asarray(x) for x in pages["away"]]
    held = [np.zeros((0, 2), np.int64) for _ in ids]
    bound = bound.astype(np.float64)
    computed = 0
    reach = lambda rows: np.sqrt(np.maximum(0, length[rows] + norm - 2 * bound[rows])) + SLACK
    active = np.arange(len(ids))
    for turn in range(order.shape[1]):
        active = active[least[active, order[active, turn]] <= reach(active)]
        if not len(active):
            break
        page_of = order[active, turn]
        for page in np.unique(page_of):
            rows = active[page_of == page]
            near, far = to_pivot[rows, page], reach(rows)
            low = np.searchsorted(away[page], near - far - SLACK)
            high = np.searchsorted(away[page], near + far + SLACK, side="right")
            some = slice(int(low.min()), int(high.max()))
            if some.start >= some.stop:
                continue
            scores = products(asking[rows], vectors[page][some])
            computed += scores.size
            others = names[page][some]
            for r, s in zip(rows, scores):
                good = np.flatnonzero((s >= bound[r]) & (others != ids[r]))
                if len(good):
                    both = np.concatenate([held[r], np.stack([s[good], others[good]], axis=1)])
                    both = both[np.lexsort((both[:, 1], -both[:, 0]))][:k]
                    held[r] = both
                    if len(both) == k:
                        bound[r] = max(bound[r], float(both[-1, 0]))
    found = np.concatenate(held) if held else np.zeros((0, 2), np.int64)
    who = np.repeat(ids, [len(h) for h in held])
    return pd.DataFrame({"query_id": who, "vec_id": found[:, 1], "score": found[:, 0]}), computed


def top_k(vectors: DataFrame, every: int = 20, k: int = 20) -> DataFrame:
    """The ``k`` highest inner products of every query with all other vectors: ``query_id, rank, vec_id, score``.

    ``vectors`` has ``vec_id`` and ``vector`` (array of long). Queries are the rows whose ``vec_id`` is divisible by ``every``; ties go to the smaller
    ``vec_id``. Null ids, null vectors and vectors with a null take no part; shorter vectors are filled with zeros; ``vec_id`` is a key,
    of rows that share one the smallest vector counts. Fewer than ``k`` others give all of them. Scores are exact while they fit a long.
    Empty tables give empty results; other columns are not read. The routing vectors are a bounded sample; all vectors are indexed.
    """
    spark = vectors.sparkSession
    usable = vectors.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", lambda v: v.isNotNull()))
    usable = staged(usable.groupBy("vec_id").agg(F.min("vector").alias("vector")), "vectors")
    square = F.aggregate("vector", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
    count, norm, width = usable.agg(F.count(F.lit(1)), F.max(square), F.max(F.size("vector"))).first()
    if not count:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    sample = usable.orderBy(F.xxhash64(F.lit("route"), "vec_id"), "vec_id").limit(ROUTES).toPandas()
    routes = lifted(stacked(sample["vector"], width), norm)
    pages = staged(pages_of(usable, norm, width, routes, count), "pages")
    queries = staged(queries_of(pages, every, k), "queries")
    trees, asked = pages.agg(F.max("tree") + 1).first()[0], queries.count()
    groups = max(1, -(-asked // TOGETHER))
    # Every group of queries meets every tree: a group and a tree are bounded, and neither is collected anywhere.
    asking = queries.withColumn("group", F.pmod(F.xxhash64("query_id"), F.lit(groups)).cast("int"))
    asking = asking.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    held = pages.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))

    def search(tree: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        if not len(tree) or not len(ask):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        found, _ = best_first(tree, ask["query_id"].to_numpy(), stacked(ask["vector"], width), ask["bound"].to_numpy(), norm, k)
        return found

    found = held.groupBy("tree", "group").cogroup(asking.groupBy("tree", "group")).applyInPandas(search, FOUND)
    # Spark applies the rank filter before the exchange too, so a task sends k rows of a query at most.
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
