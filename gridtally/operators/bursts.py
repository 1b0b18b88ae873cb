"""Access bursts: ``n`` accesses of one key within a time span.

For every access, in time order per key, a burst starts there when the
access ``n - 1`` places later is less than ``within`` after it. A key is
reported once per qualifying first access, so it can repeat. Equal
timestamps never look backwards: only later list positions count.

Two exact plans; neither sends all rows of a key to one task:

``method="sorted"`` (default): one global sort on (key, time, tie-break).
Spark's range partitioner samples the sort keys, so partitions come out
evenly sized even when one key holds a third of all rows. The sorted rows are
checkpointed, so that the partition borders stay, and the first ``n - 1`` rows
of every partition are added as look-ahead rows to the partitions before it
(partitions x (n - 1)^2 rows in all). ``lead()`` over (partition, key) then
sees every following access it needs. Task size is bounded by the partition
size, whatever the skew. The only broadcast numbers the partitions that have
rows: one row per partition of the sort.

``method="buckets"``: built-in window functions only. Rows are split into
time buckets per key (``bucket_seconds`` long, at least ``within``); each
bucket also gets a copy of the next bucket's rows in its first ``within``
span, so ``lead()`` inside (key, bucket) sees every following access it needs.
A hot key spreads over as many tasks as it has buckets, which bounds a task by
time span rather than by size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtally.plans.session import shared_dir


def _seconds(ts: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.TimestampNTZType):
        # wall-clock seconds: no session time zone, no DST gaps
        return (F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("bigint") * 86400
                + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts))
    return F.unix_seconds(ts.cast("timestamp"))


def _with_following(df: DataFrame, key: str, ts: str, order: list[str], n: int,
                    within_seconds: int, bucket_seconds: int | None) -> DataFrame:
    if n < 2:
        raise ValueError("n must be at least 2")
    bucket_seconds = bucket_seconds or 4 * within_seconds
    if bucket_seconds < within_seconds:
        raise ValueError("bucket must be at least as long as within")
    secs = _seconds(F.col(ts), df.schema[ts].dataType)
    own = F.floor(secs / bucket_seconds)
    in_head = secs - own * bucket_seconds < within_seconds
    spread = df.select(
        "*",
        own.alias("_own_bucket"),
        F.explode(F.when(in_head, F.array(own, own - 1)).otherwise(F.array(own)))
        .alias("_bucket"),
    )
    w = Window.partitionBy(key, "_bucket").orderBy(*[F.col(c).asc() for c in [ts, *order]])
    nxt = spread.select(
        "*", *[F.lead(ts, k).over(w).alias(f"_next_{k}") for k in range(1, n)])
    return nxt.filter(F.col("_bucket") == F.col("_own_bucket")).filter(
        F.col(f"_next_{n - 1}") < F.col(ts) + F.expr(f"INTERVAL {within_seconds} SECONDS"))


def _sorted_hits(df: DataFrame, key: str, ts: str, order: list[str], n: int,
                 within_seconds: int) -> DataFrame:
    """Bursts by a balanced global sort: ``key, ts, order..., _next_1 .. _next_{n-1}``."""
    if n < 2:
        raise ValueError("n must be at least 2")
    cols = [key, ts, *order]
    shared_dir(df.sparkSession)  # checkpoint folder
    ranked = df.select(*cols).orderBy(*cols).select(
        "*", F.spark_partition_id().alias("_pid"), F.monotonically_increasing_id().alias("_pos"))
    # Freeze the range boundaries: all reads below must see the same split.
    ranked = ranked.checkpoint(eager=True)
    # Partitions with rows, numbered without holes: one row per partition.
    numbered = ranked.groupBy("_pid").agg(F.count(F.lit(1)).alias("_rows")).select(
        "_pid", F.row_number().over(Window.orderBy("_pid")).alias("_part"))
    rows = ranked.join(F.broadcast(numbered), "_pid")
    # monotonically_increasing_id = partition index << 33 | row index in partition
    is_head = F.col("_pos") - F.shiftleft(F.col("_pid").cast("bigint"), 33) < n - 1
    # Every partition before it has at least one row, so n - 1 of them suffice.
    ahead = rows.filter(is_head).select(
        *cols, "_pos", F.explode(F.sequence(F.col("_part") - (n - 1), F.col("_part") - 1))
        .alias("_part"), F.lit(False).alias("_own"))
    seen = rows.select(*cols, "_pos", "_part", F.lit(True).alias("_own")).unionByName(ahead)
    w = Window.partitionBy("_part", key).orderBy("_pos")
    nxt = seen.select("*", *[F.lead(ts, k).over(w).alias(f"_next_{k}") for k in range(1, n)])
    return nxt.filter("_own").filter(
        F.col(f"_next_{n - 1}") < F.col(ts) + F.expr(f"INTERVAL {within_seconds} SECONDS"))


def _hits_for(df, key, ts, order, n, within_seconds, bucket_seconds, method):
    if method == "sorted":
        return _sorted_hits(df, key, ts, order, n, within_seconds)
    if method == "buckets":
        return _with_following(df, key, ts, order, n, within_seconds, bucket_seconds)
    raise ValueError("method must be 'sorted' or 'buckets'")


def access_bursts(df: DataFrame, key: str, ts: str, n: int = 3,
                  within_seconds: int = 3600, order: list[str] | None = None,
                  bucket_seconds: int | None = None, method: str = "sorted") -> DataFrame:
    """``(key, ts, order...)`` of each access that starts a burst of ``n``.

    ``order`` lists tie-break columns for equal timestamps (e.g. an event id).
    ``method="sorted"`` runs a checkpoint (an action) when called.
    """
    order = order or []
    return _hits_for(df, key, ts, order, n, within_seconds, bucket_seconds, method) \
        .select(key, ts, *order)


def burst_witnesses(df: DataFrame, key: str, ts: str, n: int = 3,
                    within_seconds: int = 3600, order: list[str] | None = None,
                    bucket_seconds: int | None = None, method: str = "sorted") -> DataFrame:
    """Each burst with its ``n`` access times: ``key, order..., ts_1 .. ts_n``."""
    order = order or []
    hits = _hits_for(df, key, ts, order, n, within_seconds, bucket_seconds, method)
    return hits.select(key, *order, F.col(ts).alias("ts_1"),
                       *[F.col(f"_next_{k}").alias(f"ts_{k + 1}") for k in range(1, n)])
