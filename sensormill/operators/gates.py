"""Gates, quarantine and the numbers reported about them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensormill.operators.joins import join_null_safe
from sensormill.operators.ordered import quantiles


def evaluate_gates(targets: DataFrame, gates: Mapping[str, Column], ids: Sequence[str]) -> DataFrame:
    """One row per target and gate; ``passed`` is NULL where the gate had nothing to look at.

    Every target meets every gate because the gates are columns of its row, so a gate that did not fire leaves a row
    saying so.
    """
    outcomes = F.array(
        *(F.struct(F.lit(name).alias("gate"), condition.alias("passed")) for name, condition in gates.items())
    )
    return targets.select(*ids, F.explode(outcomes).alias("_g")).select(*ids, "_g.gate", "_g.passed")


def gate_counters(outcomes: DataFrame, by: Sequence[str] = ("gate",)) -> DataFrame:
    """Evaluated, passed, failed and skipped. A skip means that nobody looked; it is not a pass."""

    def number(condition: Column, name: str) -> Column:
        return F.sum(F.when(condition, 1).otherwise(0)).alias(name)

    passed = F.col("passed")
    return outcomes.groupBy(*by).agg(
        number(passed.isNotNull(), "evaluated"),
        number(passed.isNotNull() & passed, "passed"),
        number(passed.isNotNull() & ~passed, "failed"),
        number(passed.isNull(), "skipped"),
    )


def silent_gates(counters: DataFrame) -> DataFrame:
    """Gates to alert on: something was skipped, or nothing was evaluated at all."""
    return counters.where("skipped > 0 OR evaluated = 0")


def gate_mart(outcomes: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Counters for every prefix of ``dimensions``, down to the total; level counts the columns rolled up."""
    passed = F.col("passed")
    flags = outcomes.select(
        *dimensions,
        passed.isNotNull().cast("int").alias("_e"),
        F.coalesce(passed, F.lit(False)).cast("int").alias("_p"),
    )
    # Count at the finest level first: rollup multiplies its input rows by the number of levels.
    finest = flags.groupBy(*dimensions).agg(
        F.count(F.lit(1)).alias("n"), F.sum("_e").alias("evaluated"), F.sum("_p").alias("passed")
    )
    return rolled_up(finest, dimensions)


def rolled_up(counts: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Counters for every prefix of ``dimensions`` from partial counts (dimensions, n, evaluated, passed)."""
    n, evaluated, passed = F.sum("n"), F.sum("evaluated"), F.sum("passed")
    return counts.rollup(*dimensions).agg(
        F.grouping_id().cast("bigint").alias("level"),
        evaluated.alias("evaluated"),
        passed.alias("passed"),
        (evaluated - passed).alias("failed"),
        (n - evaluated).alias("skipped"),
    )


def with_reasons(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add ``reasons``: the names of the rules a row breaks, in the order given. NULL conditions do not count."""
    marks = F.array(*(F.when(F.coalesce(broken, F.lit(False)), F.lit(name)) for name, broken in rules.items()))
    return df.withColumn("reasons", F.array_compact(marks))


def split_quarantine(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows with reasons). Together they are the input, each row exactly once."""
    marked = with_reasons(df, rules)
    return marked.where(F.size("reasons") == 0).drop("reasons"), marked.where(F.size("reasons") > 0)


def quarantine_depth(quarantined: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return quarantined.select(*by, F.explode("reasons").alias("reason")).groupBy(*by, "reason").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def freshness(
    df: DataFrame, by: Sequence[str], emitted_ns: str, queryable_ns: str, percents: Sequence[int] = (50, 95)
) -> DataFrame:
    """Exact percentiles of the time from emission until a row could be queried."""
    lag = df.select(*by, (F.col(queryable_ns) - F.col(emitted_ns)).alias("lag_ns"))
    return quantiles(lag, by, "lag_ns", percents)


def fault_recall(
    faults: DataFrame, detections: DataFrame, ids: Sequence[str], fault_type: str = "fault_type"
) -> DataFrame:
    """Detected share per fault type. There is no overall figure, and completeness is reported elsewhere."""
    found = detections.select(*ids).distinct().withColumn("_found", F.lit(1))
    joined = join_null_safe(faults, found, ids, "left")
    return joined.groupBy(fault_type).agg(
        F.count(F.lit(1)).alias("n_faults"),
        F.count("_found").alias("n_detected"),
        (F.count("_found").cast("double") / F.count(F.lit(1)).cast("double")).alias("recall"),
    )
