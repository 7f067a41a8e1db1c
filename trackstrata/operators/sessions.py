"""Session intervals and the as-of join of facts to the session in force.

The strategies give the same rows; every fact is kept, with nulls where no session applies (before
the first one, unknown or null key, null time). All they need to know is measured on the sessions, a small table held once; the
facts are read by the join alone. ``auto``, the default, takes ``interval`` when the sessions are few in all and few
per key, ``union`` when some slice of a key holds very many, else ``sliced``.

``sliced``
    Time is cut into slices, by default as long as a session lasts on average, so that a session covers two slices or
    so. Each session is listed under every slice it covers, the last one of a key up to the slice after the latest start of
    any session; later facts count as lying in that slice, earlier ones as before all. Facts then meet the sessions by an
    equi-join on (key, slice) with a range condition that at most one session satisfies. The number of listed
    sessions follows from the measures: few are broadcast, so the facts are not shuffled at all; otherwise Spark splits a
    hot (key, slice) as a skewed join partition, and a key that holds a third of all facts is spread
    over many tasks.
``union``
    For keys with very many sessions per slice: facts and sessions are sorted together per
    (key, slice, salt) and the last session is carried forward. No pairs are compared; sessions are
    repeated per salt, facts are dealt over the salts. The facts are read a second time to set the salts, unless given.
``interval``
    For a few sessions per key: join on the key alone with the range condition; the intervals are
    broadcast only if their measured number allows. The facts are read once, with no shuffle. Keys with more than
    ``FEW_PER_KEY`` sessions are served by ``sliced`` even if this is asked for.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import BROADCAST_ROWS, hold

DAY = 86_400
FACTS_PER_TASK = 2_000_000
FEW_PER_KEY = 32
FEW_PER_SLICE = 256
_LISTED = 4096


def _slice(ts: Column | str, seconds: int) -> Column:
    """Number of the time slice, independent of the session time zone."""
    column = F.col(ts) if isinstance(ts, str) else ts
    since = (column.cast("timestamp_ntz") - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")).cast("interval second")
    return F.floor(since.cast("bigint") / F.lit(seconds))


def dedupe_sessions(
    sessions: DataFrame, by: str, start: str, columns: Sequence[str], tie: Sequence[str] = ()
) -> DataFrame:
    """One row per (key, start): the one with the smallest ``tie`` values (file name), then values."""
    first = F.min_by(F.struct(*columns), F.struct(*tie, *[F.col(c).alias(f"_{c}") for c in columns]))
    return (
        sessions.where(F.col(by).isNotNull() & F.col(start).isNotNull())
        .groupBy(by, start)
        .agg(first.alias("_values"))
        .select(by, start, "_values.*")
    )


def session_intervals(
    sessions: DataFrame,
    by: str = "cam_ID",
    start: str = "start",
    columns: Sequence[str] = ("plant_species",),
    tie: Sequence[str] = (),
    end: str = "end",
) -> DataFrame:
    """Half-open ``[start, end)`` per key; ``end`` is null for the last, open session."""
    sessions = dedupe_sessions(sessions, by, start, columns, tie)
    return sessions.withColumn(end, F.lead(start).over(Window.partitionBy(by).orderBy(start)))


@dataclass(frozen=True)
class _Measured:
    """What the sessions tell: how many in all, of how many keys, most per key, seconds from each key's first start to the
    latest start of all, summed, and the earliest and latest start in seconds."""

    total: int
    keys: int
    most: int
    span: int
    earliest: int
    latest: int

    def slice_seconds(self) -> int:
        return max(1, -(-self.span // self.total)) if self.span else DAY

    def listed(self, seconds: int) -> int:
        """A bound on the rows of :func:`_listed`: each session lies in one slice more than it spans, and the last in one more."""
        return 2 * self.total + self.span // seconds + 2 * self.keys


def _measure(intervals: DataFrame, by: str) -> _Measured | None:
    per_key = intervals.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.min("_from").alias("a"), F.max("_from").alias("z"))
    first, last = _slice("a", 1), _slice("z", 1)
    row = per_key.agg(F.sum("n"), F.count(F.lit(1)), F.max("n"), F.sum(first), F.min(first), F.max(last)).first()
    if not row[0]:
        return None
    return _Measured(row[0], row[1], row[2], row[1] * row[5] - row[3], row[4], row[5])


def _listed(intervals: DataFrame, seconds: int, end: int) -> DataFrame:
    """The intervals under each ``_slice`` they cover, open ones up to slice ``end``. Long lists are made in two steps, so no row holds one."""
    until = F.coalesce(_slice("_to", seconds), F.lit(end))
    parts = F.explode(F.sequence(_slice("_from", seconds), until, F.lit(_LISTED)))
    blocks = intervals.withColumns({"_until": until, "_block": parts})
    each = F.explode(F.sequence("_block", F.least(F.col("_block") + (_LISTED - 1), F.col("_until"))))
    return blocks.withColumn("_slice", each).drop("_until", "_block")


def session_join(
    facts: DataFrame,
    sessions: DataFrame,
    by: str = "cam_ID",
    ts: str = "timestamp",
    start: str = "start",
    columns: Sequence[str] = ("plant_species",),
    tie: Sequence[str] = (),
    strategy: str = "auto",
    slice_seconds: int | None = None,
    salts: int | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Add to each fact the ``columns`` of the latest session of its key with ``start <= ts``.

    For ``union``, ``salts`` left out is set from the heaviest (key, slice) of the facts.
    """
    if strategy not in ("auto", "interval", "sliced", "union"):
        raise ValueError(f"unknown strategy {strategy!r}")
    kept = facts.columns
    clash = [c for c in columns if c in kept]
    if clash:
        raise ValueError(f"facts already have {clash}")
    found = [F.col("_values").getField(c).alias(c) for c in columns]
    unique = dedupe_sessions(sessions, by, start, columns, tie)
    packed = unique.select(F.col(by), F.col(start).alias("_from"), F.struct(*columns).alias("_values"))
    following = F.lead("_from").over(Window.partitionBy(by).orderBy("_from"))
    intervals = hold(packed.withColumn("_to", following))
    measured = _measure(intervals, by)
    if measured is None:
        return facts.select(*kept, *[F.lit(None).cast(unique.schema[c].dataType).alias(c) for c in columns])
    seconds = slice_seconds or measured.slice_seconds()

    if strategy == "auto":
        if measured.total <= broadcast_rows and measured.most <= FEW_PER_KEY:
            strategy = "interval"
        else:
            starts = intervals.groupBy(by, _slice("_from", seconds)).agg(F.count(F.lit(1)).alias("_n"))
            strategy = "union" if (starts.agg(F.max("_n")).first()[0] or 0) > FEW_PER_SLICE else "sliced"

    if strategy == "interval" and measured.most > FEW_PER_KEY:
        strategy = "sliced"  # no fact is compared with very many sessions
    if strategy == "interval":
        lines = intervals.withColumnRenamed(by, "_by")
        lines = F.broadcast(lines) if measured.total <= broadcast_rows else lines
        return _ranged(facts, lines, F.col(by) == F.col("_by"), ts).select(*kept, *found)

    # facts after the slice of the latest start meet the sessions that are open there
    end = measured.latest // seconds + 1
    facts = facts.withColumn("_slice", F.least(_slice(ts, seconds), F.lit(end)))
    lines = _listed(intervals, seconds, end).withColumnRenamed(by, "_by")
    if strategy == "sliced":
        few = measured.listed(seconds) <= broadcast_rows
        lines = lines.withColumnRenamed("_slice", "_at")
        same = (F.col(by) == F.col("_by")) & (F.col("_slice") == F.col("_at"))
        return _ranged(facts, F.broadcast(lines) if few else lines, same, ts).select(*kept, *found)
    return _union_join(facts, lines, by, ts, seconds, kept, found, salts)


def _ranged(facts: DataFrame, intervals: DataFrame, same: Column, ts: str) -> DataFrame:
    begun = F.col("_from").isNull() | (F.col("_from") <= F.col(ts))
    running = F.col("_to").isNull() | (F.col(ts) < F.col("_to"))
    return facts.join(intervals, same & begun & running, "left")


def _union_join(
    facts: DataFrame,
    lines: DataFrame,
    by: str,
    ts: str,
    seconds: int,
    kept: Sequence[str],
    found: Sequence[Column],
    salts: int | None,
) -> DataFrame:
    placeable = F.col(by).isNotNull() & F.col(ts).isNotNull()
    if salts is None:
        cells = facts.where(placeable).groupBy(by, "_slice").agg(F.count(F.lit(1)).alias("_n"))
        salts = 1 + (cells.agg(F.max("_n")).first()[0] or 0) // FACTS_PER_TASK
    # the task number keeps copies of one fact from sharing a salt
    salt = F.pmod(F.xxhash64(F.spark_partition_id(), *kept), F.lit(salts)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    time, values = lines.schema["_from"].dataType, lines.schema["_values"].dataType
    rows = facts.where(placeable).select(
        F.col(by).alias("_by"),
        "_slice",
        salt.alias("_salt"),
        F.col(ts).cast(time).alias("_at"),
        F.lit(2).alias("_kind"),
        F.lit(None).cast(values).alias("_values"),
        F.struct(*kept).alias("_fact"),
    )
    # a session that began in an earlier slice holds from the start of this one
    carried = _slice("_from", seconds) < F.col("_slice")
    starts = lines.select(
        "_by",
        "_slice",
        every.alias("_salt"),
        F.when(~carried, F.col("_from")).alias("_at"),
        F.when(carried, 0).otherwise(1).alias("_kind"),
        "_values",
        F.lit(None).cast(rows.schema["_fact"].dataType).alias("_fact"),
    )
    order = (
        Window.partitionBy("_by", "_slice", "_salt")
        .orderBy(F.asc_nulls_first("_at"), "_kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    merged = rows.unionByName(starts)
    carried_on = merged.withColumn("_values", F.last("_values", ignorenulls=True).over(order))
    matched = carried_on.where(F.col("_kind") == 2).select("_fact.*", *found)
    rest = facts.where(~placeable).select(*kept, *[F.lit(None).cast(matched.schema[c].dataType).alias(c) for c in matched.columns if c not in kept])
    return matched.unionByName(rest)
