"""Ordered computations over groups of any size.

A window partitioned by log alone puts a whole log into one task. Here the order is cut into bins, and every bin borrows
what it needs from the others as one or two extra rows: the last row before it, the first after it, or the count of all
before it. With these rows in place an ordinary window inside the bin gives the answer of a window over the whole group,
and the extra rows are dropped. What a bin borrows comes from a scan of bin summaries, cut once more into blocks of
bins. A log that holds a third of all rows is thus spread over its bins, and NULL keys group as in any grouping.

Bins are range partitions by key and order, cut at sampled quantiles, whatever the size of the table. So bins hold like
numbers of rows however the values are spread: an outlier, NaN, an infinity or a crowd of close values changes nothing.
The rows are written with their bin, since a sample drawn again would cut elsewhere. Callers who know the rate of their
sensors may give a fixed width instead and save that write.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensormill.workspace import materialise

BIN = "_bin"
BLOCK = "_block"
BINS_PER_BLOCK = 1024
_LAST_BIN = 1 << 62

_FOLD = {"max": F.max, "min": F.min, "sum": F.sum}


def bin_of(value: Column, width: int | float) -> Column:
    """Bin number of a fixed width. It only has to grow with the value, which division in double precision keeps.

    Bounded, so that extreme values, infinities and NaN (which sorts last) have a bin too.
    """
    place = F.floor(F.least(F.greatest(value / F.lit(width), F.lit(-float(_LAST_BIN))), F.lit(float(_LAST_BIN))))
    return F.when(F.isnan(value.cast("double")), F.lit(_LAST_BIN)).otherwise(place.cast("bigint"))


def binned(df: DataFrame, keys: Sequence[str], order: Sequence[str], width: float | None = None) -> DataFrame:
    """``df`` with its bin: of a fixed width over the first of ``order``, or of like size over keys and order."""
    if width is not None:
        return df.withColumn(BIN, bin_of(F.col(order[0]), width))
    cut = df.repartitionByRange(*keys, *order).withColumn(BIN, F.spark_partition_id().cast("bigint"))
    return materialise(cut, "binned")


def scan_bins(
    bins: DataFrame, keys: Sequence[str], scans: Mapping[str, tuple[str, str, str]], keep: Sequence[str] = ()
) -> DataFrame:
    """Fold the summaries of all earlier or all later bins of the group, excluding the bin itself.

    ``bins`` has one row per ``keys`` and ``_bin`` with summary columns. ``scans`` maps a new column to (summary column,
    fold, side) with fold ``max``/``min``/``sum`` and side ``before``/``after``. Returns keys, ``_bin``, the columns to
    ``keep`` and the new ones; a sum over nothing is 0, a maximum or minimum over nothing NULL.
    """
    blocked = bins.withColumn(BLOCK, bin_of(F.col(BIN), BINS_PER_BLOCK))

    def others(partition: list[str], order: str, side: str):
        direction = F.col(order).asc() if side == "before" else F.col(order).desc()
        return Window.partitionBy(*partition).orderBy(direction).rowsBetween(Window.unboundedPreceding, -1)

    blocks = blocked.groupBy(*keys, BLOCK).agg(
        *(_FOLD[fold](source).alias(name) for name, (source, fold, _) in scans.items())
    )
    borrowed = blocks.select(
        *keys,
        BLOCK,
        *(_FOLD[fold](name).over(others([*keys], BLOCK, side)).alias(name) for name, (_, fold, side) in scans.items()),
    )
    rows = blocked.select(
        *keys, BLOCK, BIN, *keep, *(F.col(source).alias(name) for name, (source, _, _) in scans.items()), F.lit(True).alias("_own")
    )
    # Each block adds one row in front of its bins and one behind them, holding what the other blocks contribute.
    ends = []
    for side, at in (("before", F.col(BLOCK) * BINS_PER_BLOCK - 1), ("after", (F.col(BLOCK) + 1) * BINS_PER_BLOCK)):
        values = [
            F.when(F.lit(side == scanned_side), F.col(name)).alias(name) for name, (_, _, scanned_side) in scans.items()
        ]
        ends.append(F.struct(at.alias(BIN), *values))
    edges = borrowed.select(*keys, BLOCK, F.explode(F.array(*ends)).alias("_end")).select(
        *keys, BLOCK, "_end.*", F.lit(False).alias("_own")
    )
    rows = rows.unionByName(edges, allowMissingColumns=True)

    def result(name: str) -> Column:
        _, fold, side = scans[name]
        folded = _FOLD[fold](name).over(others([*keys, BLOCK], BIN, side))
        return (F.coalesce(folded, F.lit(0)) if fold == "sum" else folded).alias(name)

    scanned = rows.select(*keys, BIN, *keep, *(result(name) for name in scans), "_own")
    return scanned.where("_own").drop("_own")


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    width: float | None = None,
    ties: Sequence[str] = (),
    payload: Sequence[str] = (),
    name: str = "previous",
) -> DataFrame:
    """Add the struct (time, ties, payload) of the preceding row of the group, NULL for the first row.

    Equals ``lag`` over the whole group ordered by time, ties and payload.
    """
    row = F.struct(time, *ties, *payload)
    cut = binned(df.withColumn("_row", row), keys, [time, "_row"], width)
    ends = cut.groupBy(*keys, BIN).agg(F.max("_row").alias("_last"))
    borrowed = scan_bins(ends, keys, {"_row": ("_last", "max", "before")}).where(F.col("_row").isNotNull())
    rows = cut.withColumn("_own", F.lit(True)).unionByName(
        borrowed.withColumn("_own", F.lit(False)), allowMissingColumns=True
    )
    inside = Window.partitionBy(*keys, BIN).orderBy("_row", "_own")
    return rows.withColumn(name, F.lag("_row").over(inside)).where("_own").drop(BIN, "_row", "_own")


def with_position(
    df: DataFrame, keys: Sequence[str], order: str, width: float | None = None, name: str = "position"
) -> DataFrame:
    """Add the zero-based position of each row in its group; ``order`` is unique within the group."""
    cut = binned(df, keys, [order], width)
    sizes = cut.groupBy(*keys, BIN).agg(F.count(F.lit(1)).alias("_size"))
    borrowed = scan_bins(sizes, keys, {"_n": ("_size", "sum", "before")})
    rows = cut.withColumns({"_n": F.lit(1).cast("bigint"), "_own": F.lit(True)}).unionByName(
        borrowed.withColumn("_own", F.lit(False)), allowMissingColumns=True
    )
    so_far = Window.partitionBy(*keys, BIN).orderBy("_own", order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(name, F.sum("_n").over(so_far) - 1).where("_own").drop(BIN, "_n", "_own")


def with_running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    width: float | None = None,
    name: str = "running",
) -> DataFrame:
    """Add the sum of ``value`` over the rows of the group up to and including each; ``order`` is unique within it."""
    return with_running_sums(df, keys, order, {name: value}, width)


def with_running_sums(df: DataFrame, keys: Sequence[str], order: Sequence[str], sums: Mapping[str, str], width: float | None = None) -> DataFrame:
    """The same for several columns at once: ``sums`` maps each new column to the one it sums."""
    cut = binned(df, keys, [*order], width)
    sizes = cut.groupBy(*keys, BIN).agg(*(F.sum(value).alias(f"_size_{name}") for name, value in sums.items()))
    borrowed = scan_bins(sizes, keys, {f"_v_{name}": (f"_size_{name}", "sum", "before") for name in sums})
    rows = cut.withColumns({**{f"_v_{name}": F.col(value) for name, value in sums.items()}, "_own": F.lit(True)}).unionByName(
        borrowed.withColumn("_own", F.lit(False)), allowMissingColumns=True
    )
    so_far = Window.partitionBy(*keys, BIN).orderBy("_own", *order).rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.withColumns({name: F.sum(f"_v_{name}").over(so_far) for name in sums})
    return summed.where("_own").drop(BIN, "_own", *(f"_v_{name}" for name in sums))


def with_neighbours(
    points: DataFrame,
    marks: DataFrame,
    keys: Sequence[str],
    time: str,
    payload: Sequence[str],
    width: float | None = None,
) -> DataFrame:
    """Add to each point the structs ``before`` and ``after`` (time, payload): the marks that stand around it.

    ``before`` is the last mark of the group at or before the point, ``after`` the first at or after it; of several
    marks at one time the one of the greatest payload before and of the least after. NULL where there is none, and for
    points without a time. Both sides are merged on one time line and cut into bins, so a crowded group is many tasks.
    """
    content = F.struct(F.col(time), *payload)
    own = F.struct(*(F.col(c) for c in points.columns if c not in keys))
    line = points.select(*keys, F.col(time).alias("_t"), own.alias("_point")).unionByName(
        marks.where(F.col(time).isNotNull()).select(*keys, F.col(time).alias("_t"), content.alias("_mark")), allowMissingColumns=True
    )
    cut = binned(line, keys, ["_t"], width)
    ends = cut.groupBy(*keys, BIN).agg(F.max("_mark").alias("_last"), F.min("_mark").alias("_first"))
    outside = scan_bins(ends, keys, {"_before": ("_last", "max", "before"), "_after": ("_first", "min", "after")})
    borrowed = outside.select(*keys, BIN, F.explode(F.array_compact(F.array("_before", "_after"))).alias("_mark"))
    rows = cut.unionByName(borrowed.withColumn("_t", F.col(f"_mark.{time}")), allowMissingColumns=True)
    inside = Window.partitionBy(*keys, BIN)
    # Rows of one time see each other: the frames are by value, not by row.
    until, onwards = (Window.unboundedPreceding, Window.currentRow), (Window.currentRow, Window.unboundedFollowing)
    seen = rows.withColumns({
        "before": F.max("_mark").over(inside.orderBy("_t").rangeBetween(*until)),
        "after": F.min("_mark").over(inside.orderBy("_t").rangeBetween(*onwards)),
    }).where(F.col("_point").isNotNull())
    timed = F.col("_t").isNotNull()
    others = [F.col(f"_point.`{c}`").alias(c) for c in points.columns if c not in keys]
    return seen.select(*keys, *others, F.when(timed, F.col("before")).alias("before"), F.when(timed, F.col("after")).alias("after"))


def _ranks(cut: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Add ``_to``, the rank of the last copy of each value, and ``_total``; NULLs have no rank."""
    cut = cut.withColumn("_n", F.when(F.col(value).isNotNull(), F.col("copies")).otherwise(0))
    sizes = cut.groupBy(*keys, BIN).agg(F.sum("_n").alias("_size"))
    scanned = scan_bins(
        sizes, keys, {"_lower": ("_size", "sum", "before"), "_upper": ("_size", "sum", "after")}, keep=["_size"]
    )
    borrowed = scanned.select(
        *keys,
        BIN,
        F.col("_lower").alias("_n"),
        (F.col("_lower") + F.col("_size") + F.col("_upper")).alias("_total"),
        F.lit(False).alias("_own"),
    )
    rows = cut.withColumn("_own", F.lit(True)).unionByName(borrowed, allowMissingColumns=True)
    inside = Window.partitionBy(*keys, BIN).orderBy("_own", value).rowsBetween(Window.unboundedPreceding, 0)
    # The borrowed row comes first in its bin, so what it carries reaches all rows of the bin.
    return rows.select(
        *keys,
        value,
        "copies",
        F.sum("_n").over(inside).alias("_to"),
        F.max("_total").over(inside).alias("_total"),
        "_own",
    ).where("_own")


def distribution(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    percents: Sequence[int],
    width: float | None = None,
    extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Per group: ``n``, ``n_null``, ``min``, ``max`` and exact nearest-rank percentiles ``p<percent>``.

    The percentile is the value of rank ceil(n * percent / 100). Equal values are counted before the shuffle, ranks
    come from running counts inside bins of the value. The counted values are needed three times, so they are written
    once and whatever leads to them runs once. ``extra`` adds aggregates over ``value`` and ``copies``.
    """
    counted = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("copies"))
    cut = binned(counted, keys, [value], width)
    ranked = _ranks(cut if width is None else materialise(cut, "counted-values"), keys, value)

    def at(percent: int) -> Column:
        rank = F.greatest(F.lit(1), F.floor((F.col("_total") * percent + 99) / 100))
        hit = (F.col("_to") - F.col("copies") < rank) & (rank <= F.col("_to")) & F.col(value).isNotNull()
        return F.max(F.when(hit, F.col(value))).alias(f"p{percent}")

    return ranked.groupBy(*keys).agg(
        F.max("_total").alias("n"),
        F.sum(F.when(F.col(value).isNull(), F.col("copies")).otherwise(0)).alias("n_null"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        *(at(p) for p in percents),
        *(column.alias(name) for name, column in (extra or {}).items()),
    )


def quantiles(
    df: DataFrame, keys: Sequence[str], value: str, percents: Sequence[int], width: float | None = None
) -> DataFrame:
    """Only ``n`` and the percentiles; NULLs do not count."""
    present = df.where(F.col(value).isNotNull())
    return distribution(present, keys, value, percents, width).select(*keys, "n", *(f"p{p}" for p in percents))
