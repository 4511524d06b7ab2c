"""Service levels from stored sketches: lines come in three batches by their flag, one of them twice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensormill.functions.timing import epoch_ns
from sensormill.operators.slis import ACCURACY, ratio
from sensormill.plans.sli_store import SliStore
from sensormill.queries.registry import query, table
from sensormill.queries.timelines import DAY_NS
from sensormill.workspace import fresh_path

_WINDOW_NS = 30 * DAY_NS
_RATIO = ratio(ACCURACY)
_SIGNALS = ("high_tax", "no_discount", "status_differs", "landed")


def _stored(spark: SparkSession, folder: str) -> SliStore:
    """An order line is emitted with its order and can be queried once shipped; the priority is the slice."""
    orders, lines = table(spark, folder, "orders"), table(spark, folder, "lineitem")
    emitted = orders.select("o_orderkey", F.col("o_orderpriority").alias("log_id"), "o_orderstatus", epoch_ns(orders, "o_orderdate").alias("emitted_ns"))
    landed = lines.select("l_orderkey", "l_returnflag", "l_linestatus", "l_tax", "l_discount", epoch_ns(lines, "l_shipdate").alias("queryable_ns"))
    rows = landed.join(emitted, landed.l_orderkey == emitted.o_orderkey)
    signals = {
        "high_tax": F.col("l_tax") > 0.06, "no_discount": F.col("l_discount") == 0,
        "status_differs": F.col("l_linestatus") != F.col("o_orderstatus"), "landed": F.col("queryable_ns") >= F.col("emitted_ns"),
    }
    store = SliStore(spark, fresh_path(spark, "slis"), ["log_id"], _WINDOW_NS)
    for batch, flag in ((0, "A"), (1, "N"), (2, "R"), (1, "N")):  # the second comes once more
        store.add(rows.where(F.col("l_returnflag") == flag), batch, "emitted_ns", "queryable_ns", signals)
    return store


_LAGS = f"""lags AS (SELECT o_orderpriority AS log_id, epoch_ns(l_shipdate) - epoch_ns(o_orderdate) AS lag,
  epoch_ns(l_shipdate) // {_WINDOW_NS} * {_WINDOW_NS} AS window_ns, l_tax > 0.06 AS high_tax, l_discount = 0 AS no_discount,
  l_linestatus <> o_orderstatus AS status_differs FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
placed AS (SELECT *, CASE WHEN lag = 0 THEN 0 ELSE sign(lag) * (ceil(ln(CAST(abs(lag) AS DOUBLE)) / ln({_RATIO!r})) + 1000000) END AS bucket FROM lags)"""


def _percentiles_sql(rows: str, by: str) -> str:
    value = f"CASE WHEN bucket = 0 THEN 0.0 ELSE sign(bucket) * pow({_RATIO!r}, abs(bucket) - 1000000) * {2 / (1 + _RATIO)!r} END"
    picks = ", ".join(f"max(CASE WHEN rn = greatest(1, (cnt * {p} + 99) // 100) THEN round(({value}) / 1e9, 3) END) AS p{p}_s" for p in (50, 95))
    return f"""SELECT {by}, count(*) AS n, {picks} FROM (SELECT {by}, bucket, row_number() OVER (PARTITION BY {by} ORDER BY bucket) AS rn,
  count(*) OVER (PARTITION BY {by}) AS cnt FROM {rows}) GROUP BY {by}"""


def _seconds(df: DataFrame) -> DataFrame:
    return df.withColumns({f"p{p}_s": F.round(F.col(f"p{p}") / F.lit(1e9), 3) for p in (50, 95)}).drop("p50", "p95")


@query(f"WITH {_LAGS} {_percentiles_sql('placed', 'window_ns')}")
def sli_series(spark: SparkSession, folder: str) -> DataFrame:
    """Freshness per window of thirty days, from sketches: the bucket of the exact rank, and its middle."""
    return _seconds(_stored(spark, folder).series())


@query(
    f"""WITH {_LAGS}, members AS (SELECT DISTINCT 'urgent' AS release_id, o_orderpriority AS log_id FROM orders WHERE o_orderpriority < '3'
  UNION ALL SELECT DISTINCT 'all', o_orderpriority FROM orders),
held AS (SELECT m.release_id, p.* FROM placed p JOIN members m USING (log_id)),
q AS ({_percentiles_sql('held', 'release_id')})
SELECT q.*, c.* EXCLUDE (release_id) FROM q JOIN (SELECT release_id, count(*) FILTER (high_tax) AS high_tax, count(*) FILTER (no_discount) AS no_discount,
  count(*) FILTER (status_differs) AS status_differs, count(*) FILTER (lag >= 0) AS landed,
  CAST(count(*) FILTER (lag >= 0) AS DOUBLE) / count(*) AS completeness FROM held GROUP BY release_id) c USING (release_id)"""
)
def sli_per_release(spark: SparkSession, folder: str) -> DataFrame:
    """Freshness, completeness, quarantine depth by reason and mismatches per release, from the stored parts alone."""
    priorities = table(spark, folder, "orders").select(F.col("o_orderpriority").alias("log_id")).distinct()
    members = priorities.where("log_id < '3'").select(F.lit("urgent").alias("release_id"), "log_id").unionByName(
        priorities.select(F.lit("all").alias("release_id"), "log_id")
    )
    found = _seconds(_stored(spark, folder).of_releases(members, _SIGNALS))
    return found.withColumn("completeness", F.col("landed").cast("double") / F.col("n").cast("double"))
