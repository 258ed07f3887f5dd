"""As-of lookups: the observation of the same departure nearest another moment.

Two forms. ``neighbours`` answers probes from one table against another.
``self_lookups`` answers several offsets of a table against itself.

Neither emits pairs. Observations and probes become events of one time line per key; a
running ``last`` (or, read backwards, ``last`` again) carries the most recent observation
to each probe. A key's line is sorted in one task, after one shuffle that also brings the
rows themselves, so the tables are read once. Keys too large for that, found by a count of
the key column alone, take another way: their distinct moments are looked up in lines cut
into spans, so that one departure holding a large share of the rows is spread over many
tasks, and the last observation of each span is carried into the following ones from a
summary with one row per key and non-empty span. The rows then take the answers of their
moment.

The count also says how many tasks the lines are dealt to: a task sorts about as many
events however large the tables are.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareloom.functions.times import HOUR
from fareloom.session import stored

SPAN = 6 * HOUR
# A line of more rows is cut into spans, which are shortened until about so many fall into one.
SPAN_ROWS = 50_000
# Tasks are added until each sorts about so many events, whatever the shuffle partitions are.
TASK_EVENTS = 400_000
# Rows without a key or a time are dealt over so many groups; they are in nobody's line.
SPREAD = 1024


def _load(lines: DataFrame, span_rows: int) -> tuple[int, DataFrame | None]:
    """How many rows there are, and the keys of more than ``span_rows`` if any.

    ``lines`` holds ``_key`` and ``_at``. A dense key comes with ``_parts``, the number of
    parts its usual span is cut into. Such keys are stored: there is at most one for
    ``span_rows`` rows, and Spark sees how small their table is before it plans a join, so
    a key with a large share of the rows is not gathered in one task.
    """
    held = F.col("_key").isNotNull()
    counts = lines.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"))
    size = counts.agg(F.sum("_n").alias("all"), F.max(F.when(held, F.col("_n"))).alias("most")).first()
    if (size["most"] or 0) <= span_rows:
        return size["all"] or 0, None
    spans = lines.filter(held).groupBy("_key", F.floor(F.col("_at") / SPAN).alias("_s")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    fullest = F.coalesce(F.max(F.when(F.col("_s").isNotNull(), F.col("_n"))), F.lit(1))
    dense = spans.groupBy("_key").agg(
        F.sum("_n").alias("_n"), F.ceil(fullest / span_rows).alias("_parts")
    )
    return size["all"], stored(dense.filter(F.col("_n") > span_rows).select("_key", "_parts"), "dense")


def _dealt(rows: DataFrame, events: int, *by: str) -> DataFrame:
    """Rows by key, in as many tasks as so many events need; few are left to AQE."""
    if events <= TASK_EVENTS:
        return rows.repartition(*by)
    usual = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(max(usual, -(-events // TASK_EVENTS)), *by)


def _carry(line: DataFrame, direction: str, group: Sequence[str], seen: str = "_seen") -> Column:
    """The last observation at or before each event, or the first at or after it.

    Observations come before probes at the same moment, so equality matches.
    """
    turn = {"prev": F.asc, "next": F.desc}[direction]
    inside = (
        Window.partitionBy(*group)
        .orderBy(turn("_at"), F.col(seen).isNull(), turn(seen))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return F.last(seen, ignorenulls=True).over(inside)


def neighbours(
    probes: DataFrame,
    observations: DataFrame,
    key: str,
    probe_us: str,
    observed_us: str,
    take: Sequence[str],
    directions: Sequence[str] = ("prev", "next"),
    span_rows: int = SPAN_ROWS,
) -> DataFrame:
    """Probes with ``prev`` and/or ``next``: the observation at or before / after.

    Both are structs ``(at, *take)``, null when there is none. Times are integer
    microseconds. A match at the probe's own moment is both. Of observations of one key
    and moment ``prev`` is the greatest and ``next`` the smallest. Probes with a null key
    or time find nothing and stay; such observations are never found.
    """
    events, dense = _load(
        probes.select(F.col(key).alias("_key"), F.col(probe_us).alias("_at")).unionAll(
            observations.select(F.col(key).alias("_key"), F.col(observed_us).alias("_at"))
        ),
        span_rows,
    )
    if dense is None:
        return _in_one_line(
            probes, observations, key, probe_us, observed_us, take, directions, events
        )
    few, seen_few = (
        rows.join(dense, rows[key] == dense["_key"], "left_anti") for rows in (probes, observations)
    )
    return _in_one_line(
        few, seen_few, key, probe_us, observed_us, take, directions, events
    ).unionByName(
        _in_spanned_lines(
            probes, observations, dense, key, probe_us, observed_us, take, directions, events
        )
    )


def _in_one_line(
    probes: DataFrame,
    observations: DataFrame,
    key: str,
    probe_us: str,
    observed_us: str,
    take: Sequence[str],
    directions: Sequence[str],
    events: int,
) -> DataFrame:
    seen = F.struct(F.col(observed_us).alias("at"), *take)
    seen_type = observations.select(seen.alias("s")).schema["s"].dataType
    lost = F.col(key).isNull() | F.col(probe_us).isNull()
    asked = probes.select(
        F.col(key).alias("_key"),
        F.when(lost, F.pmod(F.xxhash64(*probes.columns), F.lit(SPREAD))).alias("_lost"),
        F.col(probe_us).alias("_at"),
        F.struct(*probes.columns).alias("_row"),
        F.lit(None).cast(seen_type).alias("_seen"),
    )
    given = observations.filter(F.col(key).isNotNull() & F.col(observed_us).isNotNull()).select(
        F.col(key).alias("_key"),
        F.lit(None).cast("bigint").alias("_lost"),
        F.col(observed_us).alias("_at"),
        F.lit(None).cast(probes.schema.simpleString()).alias("_row"),
        seen.alias("_seen"),
    )
    line = _dealt(asked.unionByName(given), events, "_key", "_lost")
    found = line.withColumns({d: _carry(line, d, ["_key", "_lost"]) for d in directions})
    return found.filter(F.col("_row").isNotNull()).select("_row.*", *directions)


def _in_spanned_lines(
    probes: DataFrame,
    observations: DataFrame,
    dense: DataFrame,
    key: str,
    probe_us: str,
    observed_us: str,
    take: Sequence[str],
    directions: Sequence[str],
    events: int,
) -> DataFrame:
    """The same for dense keys, whose lines are long. Times may be null."""
    asked = probes.select(
        F.col(key).alias("_key"), F.col(probe_us).alias("_at"),
        F.struct(*probes.columns).alias("_row"),
    ).join(dense, "_key")
    seen = observations.filter(F.col(observed_us).isNotNull()).select(
        F.col(key).alias("_key"), F.col(observed_us).alias("_at"),
        F.struct(F.col(observed_us).alias("at"), *take).alias("_seen"),
    ).join(dense, "_key")
    moment = ["_key", "_at", "_parts"]
    given = _dealt(seen, events, "_key", "_at").groupBy(*moment).agg(
        F.min("_seen").alias("_low"), F.max("_seen").alias("_high")
    )
    moments = _dealt(asked.filter("_at IS NOT NULL").select(*moment), events, "_key", "_at")
    found = _in_spans(moments.distinct(), given, directions, events)
    return _answered(asked, found, "_at", directions, events)


def _in_spans(
    asked: DataFrame, given: DataFrame, directions: Sequence[str], events: int
) -> DataFrame:
    """``asked`` with its neighbours, from lines cut into spans.

    Both hold ``_key``, ``_at`` and the key's ``_parts``; ``given`` has one row per key and
    moment, with the smallest (``_low``) and greatest (``_high``) observation of it.
    """
    length = F.greatest(F.lit(1), F.floor(F.lit(SPAN) / F.col("_parts")))
    both = asked.withColumn("_asks", F.lit(True)).unionByName(
        given.withColumn("_asks", F.lit(False)), allowMissingColumns=True
    )
    group = ["_key", "_span"]
    line = _dealt(both.withColumn("_span", F.floor(F.col("_at") / length)), events, *group)

    ends = {"prev": "_high", "next": "_low"}
    edges = {"prev": F.max("_high"), "next": F.min("_low")}
    summary = line.groupBy(*group).agg(*[edges[d].alias(f"_edge_{d}") for d in directions])
    sort_at = {"prev": F.asc, "next": F.desc}
    out = line
    for d in directions:
        out = out.withColumn(f"_in_{d}", _carry(line, d, group, ends[d]))
        # One row per key and span that holds something.
        earlier = (
            Window.partitionBy("_key")
            .orderBy(sort_at[d]("_span"))
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        summary = summary.withColumn(
            f"_carry_{d}", F.last(f"_edge_{d}", ignorenulls=True).over(earlier)
        )
    carried = summary.select(*group, *[f"_carry_{d}" for d in directions])
    return out.filter("_asks").join(carried, group, "left").select(
        *asked.columns,
        *[F.coalesce(F.col(f"_in_{d}"), F.col(f"_carry_{d}")).alias(d) for d in directions],
    )


def _answered(
    rows: DataFrame, answers: DataFrame, at: str, names: Sequence[str], events: int
) -> DataFrame:
    """Whole rows with the answers of their key and moment, which are hashed; rows stream by."""
    moment = ["_key", at]
    dealt = _dealt(answers.select(*moment, *names), events, *moment)
    return _dealt(rows, events, *moment).join(dealt.hint("shuffle_hash"), moment, "left").select(
        "_row.*", *names
    )


def within(found: Column, target_us: Column, tolerance_us: int) -> Column:
    """Whether a neighbour exists and is no further away than the tolerance."""
    return F.abs(found["at"] - target_us) <= tolerance_us


def nearest(prev: Column, nxt: Column, target_us: Column, tolerance_us: int) -> Column:
    """The closer neighbour inside the tolerance; the earlier one wins a tie."""
    back = F.when(within(prev, target_us, tolerance_us), prev)
    ahead = F.when(within(nxt, target_us, tolerance_us), nxt)
    ahead_closer = back.isNull() | (ahead["at"] - target_us < target_us - back["at"])
    return F.when(ahead.isNotNull() & ahead_closer, ahead).otherwise(back)


@dataclass(frozen=True)
class Lookup:
    """What to fetch: the value ``offset_us`` away, within ``tolerance_us``."""

    name: str
    offset_us: int
    tolerance_us: int
    direction: str  # "forward" or "nearest"


def self_lookups(
    df: DataFrame,
    key: str,
    at: str,
    value: str,
    lookups: Sequence[Lookup],
    span_rows: int = SPAN_ROWS,
) -> DataFrame:
    """Add one column per lookup: another observation's ``value`` of the same key.

    Every row comes back once, with nulls where its key or time is null. After the shuffle a
    row becomes one event that brings all its columns and a thin probe per lookup. A given
    column may not have a lookup's name.
    """
    rows, dense = _load(
        df.select(F.col(key).alias("_key"), F.unix_micros(at).alias("_at")), span_rows
    )
    events = rows * (1 + len(lookups))
    if dense is None:
        return _lookups_in_one_line(df, key, at, value, lookups, events)
    few = df.join(dense, df[key] == dense["_key"], "left_anti")
    return _lookups_in_one_line(few, key, at, value, lookups, events).unionByName(
        _lookups_in_spans(df, dense, key, at, value, lookups, events)
    )


def _best(spec: Lookup, target: Column) -> Column:
    """The lookup's own choice between ``prev`` and ``next``."""
    if spec.direction == "nearest":
        return nearest(F.col("prev"), F.col("next"), target, spec.tolerance_us)
    return F.when(within(F.col("next"), target, spec.tolerance_us), F.col("next"))


def _sides(lookups: Sequence[Lookup]) -> list[str]:
    return ["next"] if all(s.direction == "forward" for s in lookups) else ["prev", "next"]


def _lookups_in_one_line(
    df: DataFrame, key: str, at: str, value: str, lookups: Sequence[Lookup], events: int
) -> DataFrame:
    lost = F.col(key).isNull() | F.col(at).isNull()
    group = ["_key", "_lost"]
    # Rows travel once, as columns, so that unused ones stay behind; a key is not sent twice.
    sent = {c: "_key" if c == key else f"_{i}_of_row" for i, c in enumerate(df.columns)}
    kept = [n for n in sent.values() if n != "_key"]
    rows = df.select(
        F.col(key).alias("_key"),
        F.when(lost, F.pmod(F.xxhash64(*df.columns), F.lit(SPREAD))).alias("_lost"),
        F.unix_micros(at).alias("_own"),
        F.col(value).alias("_v"),
        *[F.col(c).alias(n) for c, n in sent.items() if n != "_key"],
    )
    in_line, own = F.col("_lost").isNull(), F.col("_own")
    seen = F.struct(own.alias("at"), F.col("_v").alias("v"))
    nothing = F.lit(None).cast(rows.select(seen.alias("seen")).schema["seen"].dataType)

    def event(number: int, by: int, seen: Column) -> Column:
        return F.struct(
            F.lit(number).alias("_i"), (own + F.lit(by)).alias("_at"), seen.alias("_seen")
        )

    itself = event(-1, 0, F.when(in_line, seen))
    asked = [event(i, s.offset_us, nothing) for i, s in enumerate(lookups)]
    # Events are made where the line is sorted; of a row's only the first keeps its columns.
    line = _dealt(rows, events, *group).select(
        *group, "_own", *kept,
        F.inline(F.when(in_line, F.array(itself, *asked)).otherwise(F.array(itself))),
    ).withColumns({n: F.when(F.col("_i") == -1, F.col(n)) for n in kept})
    sides = _sides(lookups)
    found = line.withColumns({d: _carry(line, d, group) for d in sides})
    # Every event of one key and moment: its probes' answers, to the rows of that moment.
    moment = Window.partitionBy(*group, "_own")
    answers = {
        s.name: F.max(F.when(F.col("_i") == i, _best(s, F.col("_at"))["v"])).over(moment)
        for i, s in enumerate(lookups)
    }
    return (
        found.withColumns(answers)
        .filter(F.col("_i") == -1)
        .select(*[F.col(n).alias(c) for c, n in sent.items()], *[s.name for s in lookups])
    )


def _lookups_in_spans(
    df: DataFrame,
    dense: DataFrame,
    key: str,
    at: str,
    value: str,
    lookups: Sequence[Lookup],
    events: int,
) -> DataFrame:
    """The same for dense keys: their moments are looked up, then every row takes its answers."""
    rows = df.select(
        F.col(key).alias("_key"), F.unix_micros(at).alias("_own"), F.col(value).alias("_v"),
        F.struct(*df.columns).alias("_row"),
    ).join(dense, "_key")
    moment = ["_key", "_own"]
    thin = rows.filter("_own IS NOT NULL").select(*moment, "_parts", "_v")
    moments = _dealt(thin, events, *moment).groupBy(*moment, "_parts").agg(
        F.min("_v").alias("_min"), F.max("_v").alias("_max"),
        F.bool_or(F.col("_v").isNull()).alias("_unknown"),
    )
    # A null value comes before all others.
    least = F.when(~F.col("_unknown"), F.col("_min"))
    given = moments.select(
        "_key", F.col("_own").alias("_at"), "_parts",
        F.struct(F.col("_own").alias("at"), least.alias("v")).alias("_low"),
        F.struct(F.col("_own").alias("at"), F.col("_max").alias("v")).alias("_high"),
    )
    offsets = F.array(
        *[F.struct(F.lit(i).alias("_i"), (F.col("_own") + F.lit(s.offset_us)).alias("_at"))
          for i, s in enumerate(lookups)]
    )
    asked = moments.select(*moment, "_parts", F.inline(offsets))
    found = _in_spans(asked, given, _sides(lookups), events)
    answers = [
        F.max(F.when(F.col("_i") == i, _best(s, F.col("_at"))["v"])).alias(s.name)
        for i, s in enumerate(lookups)
    ]
    wide = _dealt(found, events, *moment).groupBy(*moment).agg(*answers)
    return _answered(rows, wide, "_own", [s.name for s in lookups], events)


def asof_join(
    probes: DataFrame,
    observations: DataFrame,
    key: str,
    probe_at: str,
    observed_at: str,
    value: str,
    name: str,
    direction: str = "forward",
    offset_us: int = 0,
    tolerance_us: int = 0,
) -> DataFrame:
    """Probes with ``name``: the observed value as of ``probe_at + offset``.

    ``direction`` is "forward", "backward" or "nearest".
    """
    sides = {"forward": ("next",), "backward": ("prev",), "nearest": ("prev", "next")}[direction]
    targets = probes.withColumn("_target", F.unix_micros(probe_at) + F.lit(offset_us))
    seen = observations.select(key, F.unix_micros(observed_at).alias("_us"), value)
    found = neighbours(targets, seen, key, "_target", "_us", [value], sides)
    target = F.col("_target")
    if direction == "nearest":
        best = nearest(F.col("prev"), F.col("next"), target, tolerance_us)
    else:
        side = F.col(sides[0])
        best = F.when(within(side, target, tolerance_us), side)
    return found.withColumn(name, best[value]).select(*probes.columns, name)
