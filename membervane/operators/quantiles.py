"""Exact order statistics of columns of any size.

Spark's ``percentile`` keeps every distinct value of a column in one task. Here a column is
reduced to its distinct values with their counts (a hash aggregation, so copies never travel), and
the values are cut into range buckets at sampled values; a column that fits one bucket has no
cut, and takes the same way. Counts per bucket say which bucket holds a rank, so that exact ranks only ever need a window
inside one bucket. The sampled cuts decide the balance of the buckets, not the result. Buckets grow in
size and in number with the square root of the values, so neither meets a limit.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from membervane.session import stage

#: Least number of values for which another bucket is made.
BUCKET_ROWS = 100_000
#: Sampled values per cut.
SAMPLED = 5


def bucket_size(rows: int, bucket_rows: int | None = None) -> int:
    """Values of a bucket: as asked, or the larger of ``BUCKET_ROWS`` and the square root of all."""
    return max(1, bucket_rows if bucket_rows is not None else max(BUCKET_ROWS, math.isqrt(rows)))


def _present(col: str) -> Column:
    """The value as double, NULL for NaN."""
    value = F.col(col).cast("double")
    return F.when(~F.isnan(value), value)


def count_values(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """Number of values per column, without NULL and NaN."""
    row = df.agg(*[F.count(_present(c)).alias(c) for c in columns]).first()
    return {c: row[c] for c in columns}


def bucket_cuts(
    df: DataFrame, columns: Sequence[str], sizes: Mapping[str, int], bucket_rows: int | None = None
) -> dict[str, list[float]]:
    """Cut values per column for buckets of about ``bucket_rows`` values; none for a short column.

    Cuts are taken from a sample of the distinct values (by a hash of the value, so each task sends its
    few sampled values only), ``SAMPLED`` per bucket.
    """
    wanted = {c: math.ceil(sizes[c] / bucket_size(sizes[c], bucket_rows)) for c in columns}
    cuts: dict[str, list[float]] = {c: [] for c in columns}
    long = [c for c in columns if wanted[c] > 1]
    if long:
        picked = []
        for c in long:
            rate = max(1, sizes[c] // (SAMPLED * wanted[c]))
            hit = F.pmod(F.xxhash64(_present(c)), F.lit(rate)) == 0
            picked.append(F.when(hit, F.struct(F.lit(c).alias("series"), _present(c).alias("value"))))
        sample = df.select(F.inline(F.array_compact(F.array(*picked)))).filter(F.col("value").isNotNull()).distinct()
        values: dict[str, list[float]] = {c: [] for c in long}
        for row in sample.collect():
            values[row["series"]].append(row["value"])
        for c, found in values.items():
            found.sort()
            number = min(wanted[c], len(found))
            cuts[c] = sorted({found[k * len(found) // number] for k in range(1, number)})
    return cuts


def constants(numbers: Sequence[float]) -> Column:
    """A constant array of doubles, one node in the plan however long it is."""
    return F.split(F.lit(",".join(repr(float(x)) for x in numbers)), ",").cast("array<double>")


def with_buckets(
    df: DataFrame, cuts: Mapping[str, Sequence[float]], out: Mapping[str, str]
) -> DataFrame:
    """Add the number of the range bucket each column's value falls in, as a double.

    Found by binary search on the cuts; a column without cuts has one bucket, zero.
    """
    single = {out[c]: F.lit(0.0) for c in cuts if not cuts[c]}
    several = [c for c in cuts if cuts[c]]
    if single:
        df = df.withColumns(single)
    if several:
        search = Bucketizer(
            splitsArray=[[-math.inf, *cuts[c], math.inf] for c in several],
            inputCols=several,
            outputCols=[out[c] for c in several],
            handleInvalid="keep",
        )
        df = search.transform(df)
    return df


@dataclass
class Ranking:
    """Distinct values of several columns, cut into range buckets.

    ``values`` has one row (series, bucket, value, copies) per distinct value, and is a written
    table where there are several buckets; ``totals`` holds, per series, the bucket numbers,
    rows and smallest values in order.
    """

    values: DataFrame
    sizes: dict[str, int]
    totals: dict[str, list[tuple[int, int, float | None]]]

    def starts(self, series: str) -> list[int]:
        """Rank of the first row of each bucket."""
        rows = [n for _, n, _ in self.totals.get(series, [])]
        return [0, *accumulate(rows)][: len(rows)]

    def ranked(self, wanted: Sequence[tuple[str, int]] | None = None) -> DataFrame:
        """Add first rank, end rank and next larger value to each value.

        Ranks count from zero. ``wanted`` keeps some (series, bucket) pairs only.
        """
        spark = self.values.sparkSession
        bounds = []
        for series, buckets in self.totals.items():
            following = [low for _, _, low in buckets[1:]] + [None]
            for (bucket, _, _), start, then in zip(
                buckets, self.starts(series), following, strict=True
            ):
                if wanted is None or (series, bucket) in wanted:
                    bounds.append((series, bucket, start, then))
        # One row per bucket.
        table = spark.createDataFrame(
            bounds, "series string, bucket int, bucket_start long, next_bucket_value double"
        )
        inside = Window.partitionBy("series", "bucket").orderBy("value")
        upto = F.sum("copies").over(inside.rowsBetween(Window.unboundedPreceding, 0))
        return (
            self.values.join(F.broadcast(table), ["series", "bucket"])
            .withColumn("rank_end", F.col("bucket_start") + upto)
            .withColumn(
                "next_value",
                F.coalesce(F.lead("value").over(inside), F.col("next_bucket_value")),
            )
            .select(
                "series",
                "bucket",
                "value",
                (F.col("rank_end") - F.col("copies")).alias("rank_start"),
                "rank_end",
                "next_value",
            )
        )


def _bucketed(df: DataFrame, columns: Sequence[str], cuts: Mapping[str, Sequence[float]]) -> DataFrame:
    """Values of all columns below each other: rows (series, bucket, value)."""
    buckets = {c: f"_bucket_{i}" for i, c in enumerate(columns)}
    wide = with_buckets(df.select(*[_present(c).alias(c) for c in columns]), cuts, buckets)
    entries = [
        F.struct(
            F.lit(c).alias("series"),
            F.col(buckets[c]).cast("int").alias("bucket"),
            F.col(c).alias("value"),
        )
        for c in columns
    ]
    return wide.select(F.inline(F.array(*entries))).filter(F.col("value").isNotNull())


def _counted(bucketed: DataFrame) -> DataFrame:
    return bucketed.groupBy("series", "bucket", "value").agg(F.count(F.lit(1)).alias("copies"))


def _collect_totals(rows: DataFrame, size: Column) -> dict[str, list[tuple[int, int, float | None]]]:
    """Bucket numbers, rows and smallest values per series: one row per bucket."""
    per_bucket = rows.groupBy("series", "bucket").agg(size.alias("rows"), F.min("value").alias("low"))
    totals: dict[str, list[tuple[int, int, float | None]]] = {}
    for row in sorted(per_bucket.collect(), key=lambda r: (r["series"], r["bucket"])):
        totals.setdefault(row["series"], []).append((row["bucket"], row["rows"], row["low"]))
    return totals


def rank_values(
    df: DataFrame,
    columns: Sequence[str],
    sizes: Mapping[str, int] | None = None,
    bucket_rows: int | None = None,
) -> Ranking:
    """Reduce columns to their distinct values in range buckets."""
    sizes = dict(sizes or count_values(df, columns))
    cuts = bucket_cuts(df, columns, sizes, bucket_rows)
    counted = _counted(_bucketed(df, columns, cuts))
    if not any(cuts.values()):
        # One bucket per column: its size is known, and nothing reads the values twice.
        return Ranking(counted, sizes, {c: [(0, sizes[c], None)] for c in columns if sizes[c]})
    values = stage(counted, "values")
    return Ranking(values, sizes, _collect_totals(values, F.sum("copies")))


def _interpolate(low: float, high: float, share: float) -> float:
    return low + (high - low) * share


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    fractions: Sequence[float] | Mapping[str, Sequence[float]],
    bucket_rows: int | None = None,
    sizes: Mapping[str, int] | None = None,
) -> dict[str, list[float | None]]:
    """Exact quantiles with linear interpolation, NULL and NaN ignored, as driver values.

    ``fractions`` may differ per column. A column without values gives ``None``. ``sizes`` are the numbers of values, where they are known.
    """
    asked = (
        {c: list(fractions[c]) for c in columns}
        if isinstance(fractions, Mapping)
        else {c: list(fractions) for c in columns}
    )
    return _quantiles(df, columns, asked, sizes or count_values(df, columns), bucket_rows)


def _quantiles(
    df: DataFrame,
    columns: Sequence[str],
    asked: Mapping[str, Sequence[float]],
    sizes: Mapping[str, int],
    bucket_rows: int | None,
) -> dict[str, list[float | None]]:
    out: dict[str, list[float | None]] = {c: [None] * len(asked[c]) for c in columns}
    filled = [c for c in columns if sizes[c] and asked[c]]
    if filled:
        positions = {c: [q * (sizes[c] - 1) for q in asked[c]] for c in filled}
        ranks = {c: sorted({r for p in positions[c] for r in (math.floor(p), math.ceil(p))}) for c in filled}
        found = _values_at(df, {c: sizes[c] for c in filled}, ranks, bucket_rows)
        for c in filled:
            out[c] = [
                _interpolate(found[c, math.floor(p)], found[c, math.ceil(p)], p - math.floor(p))
                for p in positions[c]
            ]
    return out


def _values_at(
    df: DataFrame, sizes: Mapping[str, int], ranks: Mapping[str, Sequence[int]], bucket_rows: int | None
) -> dict[tuple[str, int], float]:
    """Values at the given ranks.

    Rows are first only counted per bucket. Values are grouped and moved for the few buckets
    that hold a wanted rank.
    """
    columns = list(sizes)
    cuts = bucket_cuts(df, columns, sizes, bucket_rows)
    bucketed = _bucketed(df, columns, cuts)
    one_each = {c: [(0, sizes[c], None)] for c in columns}
    totals = _collect_totals(bucketed, F.count(F.lit(1))) if any(cuts.values()) else one_each
    ranking = Ranking(bucketed, dict(sizes), totals)
    wanted = []
    for series, positions in ranks.items():
        starts = ranking.starts(series)
        for rank in positions:
            bucket = ranking.totals[series][bisect_right(starts, rank) - 1][0]
            wanted.append((series, bucket, rank))
    # Two requests per asked fraction at most.
    requests = df.sparkSession.createDataFrame(wanted, "series string, bucket int, rank long")
    held = bucketed.join(F.broadcast(requests.select("series", "bucket")), ["series", "bucket"], "left_semi")
    ranking.values = _counted(held)
    hit = (F.col("rank") >= F.col("rank_start")) & (F.col("rank") < F.col("rank_end"))
    rows = (
        ranking.ranked({(s, b) for s, b, _ in wanted})
        .join(F.broadcast(requests), ["series", "bucket"])
        .filter(hit)
        .select("series", "rank", "value")
        .collect()
    )
    found = {(r["series"], r["rank"]): r["value"] for r in rows}
    if len(found) < len({(s, r) for s, _, r in wanted}):
        raise RuntimeError("the values changed between two passes over them: stage the input first")
    return found


def quantile_cuts(df: DataFrame, col: str, fractions: Sequence[float]) -> list[float | None]:
    """Exact quantiles of one column."""
    return exact_quantiles(df, [col], fractions)[col]


def quantile_table(df: DataFrame, columns: Sequence[str], fractions: Sequence[float]) -> DataFrame:
    """Exact quantiles of several columns as rows (column, fraction, value)."""
    found = exact_quantiles(df, columns, fractions)
    rows = [(c, float(q), v) for c in columns for q, v in zip(fractions, found[c], strict=True)]
    return df.sparkSession.createDataFrame(rows, "column string, fraction double, value double")


def quantile_rank(
    df: DataFrame,
    columns: Mapping[str, str],
    n_quantiles: int = 100,
    bucket_rows: int | None = None,
    sizes: Mapping[str, int] | None = None,
) -> DataFrame:
    """Add the rank of each value as a fraction of its column's distribution: ``{source: out}``.

    The distribution is described by ``min(n_quantiles, number of values)`` evenly spaced exact
    quantiles. Between two quantiles the fraction grows linearly; a value that several quantiles
    share gets the middle of their fractions; the smallest value gets 0 and the largest 1.
    NULL and NaN give NULL. ``sizes`` are the numbers of values, where they are known.
    """
    sources = list(columns)
    sizes = sizes or count_values(df, sources)
    fractions = {}
    for c in sources:
        n = max(2, min(n_quantiles, sizes[c]))
        fractions[c] = [i / (n - 1) for i in range(n)]
    quantiles = _quantiles(df, sources, fractions, sizes, bucket_rows)
    filled = [c for c in sources if sizes[c]]
    values = {c: f"_value_{i}" for i, c in enumerate(filled)}
    segments = {v: f"_segment_{i}" for i, v in enumerate(values.values())}
    located = with_buckets(
        df.withColumns({v: _present(c) for c, v in values.items()}),
        {values[c]: sorted(set(quantiles[c])) for c in filled},
        segments,
    )
    ranks = {
        out: _rank(F.col(values[c]), F.col(segments[values[c]]), quantiles[c])
        if c in values
        else F.lit(None).cast("double")
        for c, out in columns.items()
    }
    return located.withColumns(ranks).drop(*values.values(), *segments.values())


def _rank(x: Column, segment: Column, quantiles: Sequence[float]) -> Column:
    """Fraction of a value that lies in the given segment between two different quantiles."""
    steps = len(quantiles) - 1
    knots = sorted(set(quantiles))
    first = {v: i for i, v in reversed(list(enumerate(quantiles)))}
    last = {v: i for i, v in enumerate(quantiles)}
    # Segment 0 lies below every knot, segment k between knots k - 1 and k.
    place = segment.cast("int") - 1

    def at(numbers: Sequence[float]) -> Column:
        return F.get(constants(numbers), place)

    low, low_rank = at(knots), at([last[k] for k in knots])
    middle = at([(first[k] + last[k]) / 2 / steps for k in knots])
    between = (low_rank + (x - low) / (at([*knots[1:], knots[-1]]) - low)) / steps
    return (
        F.when(x <= knots[0], F.lit(0.0))
        .when(x >= knots[-1], F.lit(1.0))
        .when(x == low, middle)
        .when(x.isNotNull(), between)
    )


def rank_lookup(
    requests: DataFrame, ranking: Ranking, spread_by: Sequence[str], p: str = "p", out: str = "value"
) -> DataFrame:
    """Interpolated quantile of a ranked series for every row: columns ``series`` and ``p`` in.

    A request falls into the bucket that holds its rank. Values and requests of a bucket are
    merged in rank order, and each request takes the last value before it. A bucket that many
    requests fall into, say because a third of all rows ask for the same fraction, is dealt
    out to several shares by a hash of the ``spread_by`` columns, each with its own copy of the
    bucket's values. A share holds about as many requests as a bucket holds values, so that all
    copies together are at most about as many rows as values and requests.
    """
    series_names = list(ranking.totals)
    share_rows = bucket_size(max(ranking.sizes.values()))
    size = F.lit(None).cast("long")
    for s in series_names:
        size = F.when(F.col("series") == s, F.lit(ranking.sizes[s])).otherwise(size)
    position = F.col(p) * (size - 1)
    starts = {f"_at_{i}": [float(x) for x in ranking.starts(s)[1:]] for i, s in enumerate(series_names)}
    slots = {at: f"_slot_{i}" for i, at in enumerate(starts)}
    floor = F.floor(position)
    located = requests.withColumns(
        {"_floor": floor, "_share": position - floor, **{at: floor.cast("double") for at in starts}}
    )
    located = with_buckets(located, starts, slots)
    bucket: Column = F.lit(None).cast("int")
    for s, slot in zip(series_names, slots.values(), strict=True):
        numbers = constants([b for b, _, _ in ranking.totals[s]])
        found = F.get(numbers, F.col(slot).cast("int")).cast("int")
        bucket = F.when(F.col("series") == s, found).otherwise(bucket)
    located = located.withColumn("bucket", bucket).drop(*starts, *slots.values())

    # One row per bucket that a request falls into.
    loads = located.groupBy("series", "bucket").count().collect()
    shares = [
        (r["series"], r["bucket"], math.ceil(r["count"] / share_rows))
        for r in loads
        if r["bucket"] is not None
    ]
    spark = requests.sparkSession
    table = spark.createDataFrame(shares, "series string, bucket int, shares int")
    values = (
        ranking.ranked()
        .join(F.broadcast(table), ["series", "bucket"], "left")
        .withColumn("_lot", F.explode(F.sequence(F.lit(0), F.coalesce("shares", F.lit(1)) - 1)))
        .select(
            "series",
            "bucket",
            "_lot",
            F.col("rank_start").alias("_rank"),
            F.struct("value", "rank_end", "next_value").alias("_pool"),
        )
    )
    lot = F.pmod(F.xxhash64(*spread_by), F.coalesce(F.col("shares"), F.lit(1)).cast("long"))
    asked = (
        located.join(F.broadcast(table), ["series", "bucket"], "left")
        .withColumn("_lot", F.when(F.col("bucket").isNull(), F.xxhash64(*spread_by)).otherwise(lot).cast("long"))
        .withColumn("_rank", F.col("_floor"))
        .withColumn("_request", F.lit(True))
        .drop("shares", "_floor")
    )
    values = values.withColumn("_lot", F.col("_lot").cast("long"))
    merged = values.unionByName(asked, allowMissingColumns=True)
    before = (
        Window.partitionBy("series", "bucket", "_lot")
        .orderBy("_rank", F.col("_request").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    pool = F.col("_found")
    upper = F.when(F.col("_rank") + 1 < pool["rank_end"], pool["value"]).otherwise(
        F.coalesce(pool["next_value"], pool["value"])
    )
    kept = [c for c in requests.columns]
    return (
        merged.withColumn("_found", F.last("_pool", ignorenulls=True).over(before))
        .filter(F.col("_request"))
        .select(*kept, (pool["value"] + (upper - pool["value"]) * F.col("_share")).alias(out))
    )
