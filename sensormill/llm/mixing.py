"""Mixing sources to target weights by entropy balancing, in DataFrame operations only.

Targets. The mix takes ``share`` times all words. Sources in order of code point, NULL last, weigh 3, 1, 2 and so on; each
gets its part of the mix by weight, but no more than ``most`` times its own words. What is above is dealt again by weight
among the sources below, until none is above. This has a closed form: with sources ordered by words over weight, the
first ones are full, and the rest share what is left by weight.

Rates. Each document gets a rate, how often it is taken, between 0 and ``most``. Among all rates whose words add up to the
source's target, entropy balancing takes those closest to 1 in relative entropy: rate = exp(lambda * size), at most
``most``, with one multiplier per source. The multipliers maximise a concave dual, whose gradient is the gap between the
words taken and the target. They are found by Newton steps for all sources at once; an interval kept around the root
replaces a step that leaves it. Rates depend on source and size alone, so every step is one aggregation over the table
of (source, size) with counts, a table that is made once and is far smaller than the documents.

Copies. A document is taken floor(rate) times, and once more if its place, a hash of its row between 0 and 1, is below the
fraction by enough: sources are cut where the words taken reach the target. The cut is found in two rounds of bins over
the places, then exactly inside one bin. The gap that is left is smaller than one document; a few more documents, chosen
to fit it, close it.

NULL texts count 0 words and are taken 0 words. Empty sources (no words) have target 0. Repeated rows are documents of
their own; equal ones are interchangeable, so reruns agree. Other columns are ignored by ``mixed`` and kept by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensormill.workspace import materialise

WEIGHTS = (3.0, 1.0, 2.0)
ROUNDS = 60
BINS = 1024
SALTS = 16
TOP_UPS = 4
#: Bounds of a multiplier, and of an exponent.
WIDEST, STEEPEST = 1e4, 50.0


def size_of(text: Column) -> Column:
    """Number of words, runs without ASCII white space."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def targets(sizes: DataFrame, share: float, most: float) -> DataFrame:
    """``sizes`` (source, source_size and others; one row per source) with ``target``.

    The running sums go over the table of sources, which a window holds in one task.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.encode("source", "utf-8"))
    weights = F.array(*(F.lit(w) for w in WEIGHTS))
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(WEIGHTS))) + 1
    placed = sizes.withColumn("weight", F.element_at(weights, turn.cast("int"))).withColumn(
        "fill", F.row_number().over(Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source")))
    )
    whole = Window.partitionBy()
    before = Window.orderBy("fill").rowsBetween(Window.unboundedPreceding, -1)
    left_words = F.lit(share) * F.sum("source_size").over(whole) - F.lit(most) * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    left_weight = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    levelled = placed.withColumn("level", left_words / left_weight).withColumn(
        "full", F.col("level") * F.col("weight") >= F.lit(most) * F.col("source_size")
    )
    rest = F.min(F.when(~F.col("full"), F.struct("fill", "level"))).over(whole)
    own = F.lit(most) * F.col("source_size")
    dealt = levelled.withColumn("rest", rest)
    target = F.when(F.col("rest").isNull() | (F.col("fill") < F.col("rest.fill")), own).otherwise(F.col("rest.level") * F.col("weight"))
    return dealt.withColumn("target", target.cast("double")).select(*sizes.columns, "target")


def _salts() -> Column:
    return F.explode(F.array(*(F.lit(i) for i in range(SALTS)))).alias("salt")


def _by_source(rows: DataFrame, per_source: DataFrame) -> DataFrame:
    """Join values per source to rows; a source that holds a third of the rows meets ``SALTS`` copies of its values."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("size", "u"), F.lit(SALTS)).cast("int"))
    return salted.join(per_source.select("*", _salts()), ["key", "salt"]).drop("salt")


def multipliers(histogram: DataFrame, goals: DataFrame, most: float) -> DataFrame:
    """(key, mean, lam) such that the words of ``histogram`` (key, size, n) add up to the goals' targets.

    Sizes are taken in units of the source's mean size. Sources whose target is nothing or all they may give have no
    finite multiplier and are left out.
    """
    filled = histogram.filter("size > 0")
    means = filled.groupBy("key").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"))
    free = goals.join(means, "key").filter((F.col("target") < F.lit(most) * F.col("source_size")) & (F.col("target") > 0))
    start = {"lam": F.lit(0.0), "low": F.lit(-WIDEST), "high": F.lit(WIDEST), "done": F.lit(False)}
    state = materialise(free.select("key", "target", "mean").withColumns(start), "dual")
    table = materialise(filled.withColumn("salt", F.pmod(F.xxhash64("size"), F.lit(SALTS)).cast("int")), "histogram")
    for _ in range(ROUNDS):
        going = state.filter("NOT done")
        if going.isEmpty():
            break
        scaled, words = F.col("size") / F.col("mean"), F.col("size") * F.col("n")
        tilt = F.exp(F.least(F.col("lam") * scaled, F.lit(STEEPEST)))
        sums = (
            table.join(going.select("key", "mean", "lam", _salts()), ["key", "salt"])
            .groupBy("key")
            .agg(
                F.sum(words * F.least(tilt, F.lit(most))).alias("words"),
                F.sum(F.when(tilt < most, words * scaled * tilt).otherwise(0.0)).alias("slope"),
            )
        )
        gap = F.col("words") - F.col("target")
        stepped = going.join(sums, "key").withColumns({
            "gap": gap,
            "low": F.when(gap < 0, F.col("lam")).otherwise(F.col("low")),
            "high": F.when(gap > 0, F.col("lam")).otherwise(F.col("high")),
            "newton": F.when(F.col("slope") > 0, F.col("lam") - gap / F.col("slope")),
        })
        inside = F.coalesce((F.col("newton") > F.col("low")) & (F.col("newton") < F.col("high")), F.lit(False))
        reached = F.abs("gap") <= F.greatest(F.lit(0.5), F.lit(1e-6) * F.col("target"))
        lam = F.when(reached, F.col("lam")).when(inside, F.col("newton")).otherwise((F.col("low") + F.col("high")) / 2)
        moved = stepped.select("key", "target", "mean", lam.alias("lam"), "low", "high", reached.alias("done"))
        state = materialise(state.filter("done").unionByName(moved), "dual")
    return state.select("key", "mean", "lam")


def _rate(most: float) -> Column:
    tilt = F.exp(F.least(F.col("lam") * F.col("size") / F.col("mean"), F.lit(STEEPEST)))
    full = F.col("target") >= F.lit(most) * F.col("source_size")
    return F.when(full, F.lit(most)).when(F.col("lam").isNull(), F.lit(0.0)).otherwise(F.least(tilt, F.lit(most)))


def mixed(docs: DataFrame, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, copies and taken (copies times size)."""
    place = F.pmod(F.xxhash64(F.lit("place"), "doc_id", "text"), F.lit(1 << 50)) / F.lit(float(1 << 50))
    rows = materialise(
        docs.select(
            "doc_id", "source", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("key"),
            size_of(F.col("text")).alias("size"), place.alias("u"),
        ), "sizes"
    )
    histogram = materialise(rows.groupBy("key", "source", "size").agg(F.count("*").alias("n")), "histogram")
    sizes = histogram.groupBy("key", "source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    goals = materialise(targets(sizes, share, most).drop("source"), "goals")
    dual = multipliers(histogram.drop("source"), goals, most)
    sure = F.when(F.col("size") > 0, F.floor("rate")).otherwise(0).cast("int")
    fraction = F.col("rate") - F.col("sure")
    rated = (
        _by_source(rows.drop("source"), goals.join(dual, "key", "left"))
        .withColumn("rate", _rate(most))
        .withColumn("sure", sure)
        # the order in which documents are taken once more, from 0 to 1; NULL: it may not be
        .withColumn("v", F.when((F.col("size") > 0) & (F.col("sure") + 1 <= most), (F.col("u") - fraction + 1) / 2))
        .withColumn("bin", F.floor(F.col("v") * BINS).cast("int"))
        .withColumn("fine", F.floor((F.col("v") * BINS - F.col("bin")) * BINS).cast("int"))
    )
    kept = ("doc_id", "key", "size", "u", "source_size", "target", "sure", "v", "bin", "fine")
    return _top_up(_cut(materialise(rated.select(*kept), "rated")), most)


def _crossing(sums: DataFrame, step: str) -> DataFrame:
    """Per source the first bin in which the running ``words`` pass ``gap``, and the words before it."""
    order = Window.partitionBy("key").orderBy(step).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = sums.withColumn("before", F.sum("words").over(order) - F.col("words"))
    passing = running.filter(F.col("before") + F.col("words") > F.col("gap"))
    first = passing.groupBy("key").agg(F.min(F.struct(step, "before")).alias("c"))
    return first.select("key", F.col(f"c.{step}").alias(f"cut_{step}"), F.col("c.before").alias(f"before_{step}"))


def _cut(rated: DataFrame) -> DataFrame:
    """Copies of every row: documents in order of ``v`` are taken once more until the next would pass the target."""
    sure = rated.groupBy("key").agg(F.sum(F.col("sure") * F.col("size")).alias("words"), F.first("target").alias("target"))
    gaps = materialise(sure.select("key", (F.col("target") - F.col("words")).alias("gap")), "gaps")
    may = rated.filter("v IS NOT NULL")
    coarse = may.groupBy("key", "bin").agg(F.sum("size").alias("words")).join(gaps, "key")
    cut = materialise(gaps.join(_crossing(coarse, "bin"), "key", "left"), "cut")
    inner = _by_source(may, cut).filter("bin = cut_bin")
    fine = inner.groupBy("key", "fine").agg(F.sum("size").alias("words"), F.first(F.col("gap") - F.col("before_bin")).alias("gap"))
    cut = materialise(cut.join(_crossing(fine, "fine"), "key", "left"), "cut")
    same_bin = F.col("bin") == F.col("cut_bin")
    earlier = F.col("cut_bin").isNull() | (F.col("bin") < F.col("cut_bin")) | (same_bin & (F.col("fine") < F.col("cut_fine")))
    placed = _by_source(rated, cut).withColumns({
        "rim": F.coalesce(same_bin & (F.col("fine") == F.col("cut_fine")), F.lit(False)),
        "ahead": F.col("v").isNotNull() & earlier,
    })
    order = Window.partitionBy("key").orderBy("v", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fits = F.sum("size").over(order) <= F.col("gap") - F.col("before_bin") - F.col("before_fine")
    rows = placed.filter("NOT rim").withColumn("more", F.col("ahead")).unionByName(placed.filter("rim").withColumn("more", fits))
    copies = F.col("sure") + F.col("more").cast("int")
    return materialise(rows.select("doc_id", "key", "size", "u", "source_size", "target", copies.alias("copies")), "copies")


def _top_up(rows: DataFrame, most: float) -> DataFrame:
    """Take single documents once more where they fit the gap that is left, the largest first."""
    taken = rows.groupBy("key").agg(F.sum(F.col("copies") * F.col("size")).alias("words"), F.first("target").alias("target"))
    left = materialise(taken.select("key", (F.col("target") - F.col("words")).alias("left")), "left")
    same = ("key", "doc_id", "size", "u")
    single = rows.filter("size > 0").groupBy(*same).agg(F.count("*").alias("n"), F.max("copies").alias("copies"))
    may = materialise(single.filter((F.col("n") == 1) & (F.col("copies") + 1 <= most)).select(*same), "single")
    picked = []
    for _ in range(TOP_UPS):
        fitting = _by_source(may, left).filter("size <= left")
        for earlier in picked:
            fitting = fitting.join(earlier.select("key", F.col("size").alias("s"), F.col("u").alias("p")), "key", "left").filter(
                "s IS NULL OR s <> size OR p <> u"
            ).drop("s", "p")
        best = materialise(fitting.groupBy("key").agg(F.max(F.struct("size", "u", "doc_id")).alias("b")).select("key", "b.*"), "best")
        picked.append(best)
        left = left.join(best.select("key", F.col("size").alias("given")), "key", "left")
        left = materialise(left.select("key", (F.col("left") - F.coalesce("given", F.lit(0))).alias("left")), "left")
    chosen = picked[0]
    for best in picked[1:]:
        chosen = chosen.unionByName(best)
    chosen = chosen.select(F.col("doc_id").alias("d"), F.col("size"), F.col("u"), "key", F.lit(1).alias("more"))
    joined = rows.join(chosen, ["key", "size", "u"], "left")
    hit = F.col("more").isNotNull() & F.col("d").eqNullSafe(F.col("doc_id"))
    copies = F.col("copies") + F.when(hit, 1).otherwise(0)
    return joined.select("doc_id", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).cast("bigint").alias("taken"))
