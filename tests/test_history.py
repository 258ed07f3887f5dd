from __future__ import annotations

import glob
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fareloom.functions import times
from fareloom.operators import (
    asof, boosting, dashboard, evaluate, features, history, ordered, training,
)
from fareloom.operators.joins import join_groups
from fareloom.sources import tables

HISTORY_DDL = (
    "offer_id string, carrier string, mode string, origin string, destination string, "
    "depart_time timestamp, duration_min int, price_ngn double, seats_left int, "
    "booking_url string, fetched_at timestamp"
)


@pytest.fixture
def seen(spark):
    """History rows from (offer_id, fetched_at, price) triples."""

    def make(*triples):
        frame = spark.createDataFrame(
            [(o, t, float(p)) for o, t, p in triples], "offer_id string, t string, price_ngn double"
        )
        return frame.select(
            "offer_id",
            F.lit("GIGM").alias("carrier"),
            F.lit("road").alias("mode"),
            F.lit("LOS").alias("origin"),
            F.lit("ABV").alias("destination"),
            F.lit("2026-09-30 06:00:00").cast("timestamp").alias("depart_time"),
            F.lit(600).alias("duration_min"),
            "price_ngn",
            F.lit(9).alias("seats_left"),
            F.lit("https://g.example").alias("booking_url"),
            F.col("t").cast("timestamp").alias("fetched_at"),
        )

    return make


# ---------------------------------------------------------- state and upsert --


def test_latest_is_by_observation_time_not_arrival(seen):
    rows = seen(("a", "2026-09-02 00:00:00", 2), ("a", "2026-09-01 00:00:00", 1))
    assert history.latest_offers(rows).first()["price_ngn"] == 2.0
    merged = history.merge_latest(
        seen(("a", "2026-09-02 00:00:00", 2)),
        seen(("a", "2026-09-01 00:00:00", 1), ("b", "2026-09-01 00:00:00", 5)),
    )
    assert {r["offer_id"]: r["price_ngn"] for r in merged.collect()} == {"a": 2.0, "b": 5.0}


def test_ties_do_not_depend_on_partitioning(seen):
    rows = seen(*[("a", "2026-09-02 00:00:00", p) for p in (3, 9, 4)])
    answers = {
        history.latest_offers(rows.repartition(n)).first()["price_ngn"] for n in (1, 2, 5)
    }
    assert answers == {9.0}


def test_redelivery_collapses_and_conflicts_are_set_aside(seen):
    rows = seen(
        ("a", "2026-09-01 00:00:00", 1), ("a", "2026-09-01 00:00:00", 1),
        ("b", "2026-09-01 00:00:00", 1), ("b", "2026-09-01 00:00:00", 2),
    )
    good, bad = history.split_conflicts(rows)
    assert [r["offer_id"] for r in good.collect()] == ["a"]
    assert [(r["offer_id"], r["deliveries"]) for r in bad.collect()] == [("b", 2)]


def test_append_is_idempotent_across_days(seen, tmp_path, spark):
    path = str(tmp_path / "history")
    first = seen(("a", "2026-09-01 00:00:00", 1), ("a", "2026-09-02 00:00:00", 2))
    tables.append_history(first, path)
    tables.append_history(first.unionByName(seen(("a", "2026-09-03 00:00:00", 3))), path)
    tables.append_history(first.limit(0), path)
    stored = tables.read_history(spark, path)
    assert sorted(r["price_ngn"] for r in stored.collect()) == [1, 2, 3]
    assert len(glob.glob(f"{path}/fetch_day=*")) == 3
    since = F.lit("2026-09-02 00:00:00").cast("timestamp")
    recent = tables.read_history(spark, path, since)
    assert recent.count() == 2
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(fetch_day" in plan


def test_tsv_round_trip_and_strictness(seen, tmp_path, spark):
    path = str(tmp_path / "tsv")
    tables.write_tsv(seen(("a", "2026-09-01 00:00:00.125", 1)), path)
    row = tables.read_tsv(spark, path).first()
    assert row["fetched_at"].microsecond == 125000 and float(row["price_ngn"]) == 1.0
    bad = tmp_path / "bad.tsv"
    bad.write_text("only\ttwo\n")
    with pytest.raises(Exception):
        tables.read_tsv(spark, str(bad)).collect()


def test_freshness_flags_a_silent_feed(seen):
    late = F.lit("2026-09-01 01:00:00").cast("timestamp")
    soon = F.lit("2026-09-01 00:15:00").cast("timestamp")
    rows = seen(("a", "2026-09-01 00:00:00", 1))
    assert history.feed_freshness(rows, late).first()["stale"] is True
    # Exactly at the limit is not yet stale.
    assert history.feed_freshness(rows, soon).first()["stale"] is False


# -------------------------------------------------------------------- as-of --


def _random_history(n=600, offers=5, seed=7):
    rng = np.random.default_rng(seed)
    start = pd.Timestamp("2026-09-01")
    minutes = rng.choice(10 * 24 * 4, size=(offers, n // offers), replace=True) * 15
    rows = [
        (f"o{i}", start + pd.Timedelta(minutes=int(m)))
        for i in range(offers)
        for m in sorted(set(minutes[i]))
    ]
    frame = pd.DataFrame(rows, columns=["offer_id", "fetched_at"])
    frame["price_ngn"] = rng.integers(1, 10_000, len(frame)).astype(float)
    return frame


def _merge(frame, hours, direction):
    sign = 1 if direction == "forward" else -1
    left = frame[["offer_id", "fetched_at"]].copy()
    left["target"] = left["fetched_at"] + sign * pd.Timedelta(hours=hours)
    right = frame.rename(columns={"fetched_at": "seen_at", "price_ngn": "other"})
    merged = pd.merge_asof(
        left.sort_values("target"), right.sort_values("seen_at"), left_on="target",
        right_on="seen_at", by="offer_id", direction=direction,
        tolerance=pd.Timedelta(minutes=hours * 30),
    )
    return {
        (r.offer_id, r.fetched_at): (None if pd.isna(r.other) else r.other)
        for r in merged.itertuples()
    }


LOOKUPS = [*features.PAST, features.FUTURE]


@pytest.mark.parametrize("span_rows", [asof.SPAN_ROWS, 3], ids=["usual", "dense"])
def test_lookups_equal_pandas(spark, span_rows):
    frame = _random_history()
    df = spark.createDataFrame(frame)
    found = asof.self_lookups(df, "offer_id", "fetched_at", "price_ngn", LOOKUPS, span_rows)
    rows = found.collect()
    assert len(rows) == len(frame)
    for name, hours, direction in [
        ("_past_6h", 6, "nearest"), ("_past_12h", 12, "nearest"), ("_past_24h", 24, "nearest"),
        ("future_price", 24, "forward"),
    ]:
        expected = _merge(frame, hours, direction)
        got = {(r["offer_id"], pd.Timestamp(r["fetched_at"])): r[name] for r in rows}
        assert got == expected, name


def test_one_scan_and_one_exchange_answer_the_lookups(spark, tmp_path):
    path = str(tmp_path / "seen")
    spark.createDataFrame(_random_history()).write.parquet(path)
    df = spark.read.parquet(path)
    for specs in (LOOKUPS, [features.FUTURE]):
        found = asof.self_lookups(df, "offer_id", "fetched_at", "price_ngn", specs)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
    probes = df.select("offer_id", F.col("fetched_at").alias("t"))
    joined = asof.asof_join(
        probes, df, "offer_id", "t", "fetched_at", "price_ngn", "p", "forward", 0, times.DAY
    )
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and plan.count("Exchange") == 1


def test_dense_and_usual_keys_meet(spark):
    """One key beyond the limit goes by spans, the others in one line; rows without keys stay."""
    frame = pd.concat([_random_history(900, 1), _random_history(200, 4, 9)[lambda f: f.offer_id != "o0"]])
    df = spark.createDataFrame(frame)
    lost = df.limit(3).withColumn("offer_id", F.lit(None).cast("string"))
    found = asof.self_lookups(
        df.unionByName(lost), "offer_id", "fetched_at", "price_ngn", LOOKUPS, 100
    ).collect()
    assert len(found) == len(frame) + 3
    expected = _merge(frame, 12, "nearest")
    got = {
        (r["offer_id"], pd.Timestamp(r["fetched_at"])): r["_past_12h"] for r in found if r["offer_id"]
    }
    assert got == expected
    assert {r["future_price"] for r in found if not r["offer_id"]} == {None}
    probes = df.select("offer_id", F.col("fetched_at").alias("t"), "price_ngn")
    sides = ("prev", "next")
    us = lambda c: F.unix_micros(c)
    near, far = (
        asof.neighbours(
            probes.withColumn("_p", us("t") + 7), df.withColumn("_o", us("fetched_at")), "offer_id",
            "_p", "_o", ["price_ngn"], sides, limit,
        ).collect()
        for limit in (asof.SPAN_ROWS, 100)
    )
    assert sorted(near, key=repr) == sorted(far, key=repr) and len(near) == len(frame)


def _rows_moved_by_key_alone(df):
    """Joins that bring all rows of one key to one task."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"SortMergeJoin(?:\(.*?\))? \[\w+#\d+L?\], \[\w+#\d+L?\]", plan)


def test_no_join_gathers_a_hot_key(spark, tmp_path, request):
    """The rows of one key holding nearly all stay where they are until spans are known."""
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    request.addfinalizer(lambda: spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual))
    # As if the table were large: it is beyond the size that is sent to all tasks.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "5000")
    path = str(tmp_path / "hot")
    spark.range(4000).selectExpr(
        "if(id % 50 = 0, null, 'all') AS k", "timestamp_seconds(id * 60) AS t", "double(id) AS p"
    ).write.parquet(path)
    df = spark.read.parquet(path)
    specs = [asof.Lookup("later", 6 * times.HOUR, times.DAY, "forward")]
    found = asof.self_lookups(df, "k", "t", "p", specs, 100)
    assert not _rows_moved_by_key_alone(found)
    probes = df.select("k", F.unix_micros("t").alias("a"), "p")
    near = asof.neighbours(
        probes, df.withColumn("b", F.unix_micros("t")), "k", "a", "b", ["p"], ("prev", "next"), 100
    )
    assert not _rows_moved_by_key_alone(near)
    expected = {
        i: next((j for j in range(i + 360, 4000) if j % 50), None) if i % 50 else None
        for i in range(4000)
    }
    assert {int(r.p): r.later and int(r.later) for r in found.collect()} == expected
    for r in near.collect():
        assert (r.prev and r.prev.p) == (r.next and r.next.p) == (r.p if r.k else None)


@pytest.mark.parametrize("make", [features.price_deltas, features.build_features])
def test_larger_tables_get_more_tasks_not_larger_ones(spark, seen, monkeypatch, make):
    """Where few shuffle partitions would give a task a share of the table, tasks are added."""
    monkeypatch.setattr(asof, "TASK_EVENTS", 4000, raising=False)
    rows = seen(*[(f"o{i % 97}", f"2026-09-{1 + i // 600:02d} {i % 24:02d}:{i % 60:02d}:00", i + 1)
                  for i in range(12_000)])
    out = make(rows)
    used = [F.count("price_delta_6h").alias("n"), F.max("price_delta_24h"), F.max("price_delta_12h")]
    sizes = [r["n"] for r in out.groupBy(F.spark_partition_id()).agg(*used).collect()]
    assert len(sizes) > 4 and max(sizes) < 4000
    monkeypatch.setattr(asof, "TASK_EVENTS", 10**9, raising=False)
    assert sorted(out.collect()) == sorted(make(rows).collect())


def test_rows_are_sent_once_without_unused_columns(spark, tmp_path):
    """The shuffle of a line carries a row, not an event for every lookup, and no unused column."""
    path = str(tmp_path / "wide")
    spark.range(400).selectExpr(
        "if(id % 9 = 0, null, concat('o', id % 7)) AS k", "timestamp_seconds(id * 60) AS t",
        "double(id) AS p", "repeat('x', 90) AS _key", "id AS _i", "id AS _3_of_row",
    ).write.parquet(path)
    df = spark.read.parquet(path)
    specs = [asof.Lookup(f"in_{h}h", h * times.HOUR, times.HOUR // 60, "nearest") for h in (1, 2, 3)]
    found = asof.self_lookups(df, "k", "t", "p", specs)
    assert found.columns == [*df.columns, "in_1h", "in_2h", "in_3h"]
    thin = found.select("k", "p", "in_1h", "in_3h")
    plan = thin._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate inline") < plan.index("Exchange hashpartitioning(_key")
    assert " AS _2_of_row#" in plan and " AS _4_of_row#" not in plan
    rows = {r.p: r for r in found.collect()}
    assert len(rows) == 400
    for i, r in rows.items():
        assert (r["_key"], r["_i"], r["_3_of_row"]) == ("x" * 90, i, i)
        near = [j for j in (i + 59, i + 60, i + 61) if r.k and j < 400 and j % 9 and j % 7 == i % 7]
        assert r.in_1h == min(near, key=lambda j: abs(j - i - 60), default=None)


@pytest.mark.parametrize("column", ["price_delta_6h", "future_price"])
def test_a_move_is_sent_once(seen, column):
    """What median_move keeps of the features is made after the one shuffle of the history."""
    rows = seen(*[(f"o{i % 3}", f"2026-09-{1 + i // 4:02d} {i % 4 * 6:02d}:00:00", 100 + i % 7)
                  for i in range(60)])
    moves = features.build_features(rows).select(column)
    plan = moves._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate inline") < plan.index("Exchange hashpartitioning(_key")
    assert plan.count("Exchange") == 1
    known = features.build_features(rows)
    price = {r.fetched_at: r.price_ngn for r in rows.collect() if r.offer_id == "o0"}
    for r in known.filter("offer_id = 'o0'").collect():
        later = [t for t in price if 86400 <= (t - r.fetched_at).total_seconds() <= 129600]
        assert r.future_price == price[min(later)]


def test_nulls_stay_and_ties_have_one_answer(spark):
    rows = [
        ("a", "2026-09-01 00:00:00", 1.0), ("a", "2026-09-02 00:00:00", 12.0),
        ("a", "2026-09-02 00:00:00", 11.0), (None, "2026-09-01 00:00:00", 5.0), ("a", None, 6.0),
    ]
    df = spark.createDataFrame(rows, "k string, t string, v double").withColumn(
        "t", F.col("t").cast("timestamp")
    )
    specs = [
        asof.Lookup("later", times.DAY, 0, "forward"),
        asof.Lookup("earlier", -times.DAY, 0, "nearest"),
    ]
    expected = [
        (None, 5.0, None, None), ("a", 1.0, 11.0, None), ("a", 6.0, None, None),
        ("a", 11.0, None, 1.0), ("a", 12.0, None, 1.0),
    ]
    for span_rows in (asof.SPAN_ROWS, 1):
        found = asof.self_lookups(df, "k", "t", "v", specs, span_rows)
        got = [(r.k, r.v, r.later, r.earlier) for r in found.collect()]
        assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_asof_ties_bounds_and_tolerance(spark, seen):
    h = times.HOUR
    rows = seen(
        ("a", "2026-09-01 00:00:00", 10), ("a", "2026-09-01 04:00:00", 20),
        ("a", "2026-09-01 08:00:00", 30),
    )
    probes = spark.createDataFrame(
        [("a", "2026-09-01 02:00:00"), ("a", "2026-09-01 06:00:01"), ("b", "2026-09-01 02:00:00")],
        "offer_id string, t string",
    ).withColumn("t", F.col("t").cast("timestamp"))

    def look(direction, tolerance):
        found = asof.asof_join(
            probes, rows, "offer_id", "t", "fetched_at", "price_ngn", "p", direction, 0, tolerance
        )
        return [r["p"] for r in found.orderBy("offer_id", "t").collect()]

    assert look("nearest", 2 * h) == [10.0, 30.0, None]  # an exact tie goes back
    assert look("forward", 2 * h) == [20.0, 30.0, None]  # the bound is inclusive
    assert look("forward", 2 * h - 1) == [None, 30.0, None]
    assert look("backward", 3 * h) == [10.0, 20.0, None]


def test_neighbours_cross_many_empty_spans(spark, seen):
    rows = seen(("a", "2026-01-01 00:00:00", 1), ("a", "2026-12-01 00:00:00", 2))
    probe = spark.createDataFrame([("a", "2026-06-01 00:00:00")], "offer_id string, t string")
    probe = probe.withColumn("t", F.col("t").cast("timestamp"))
    year = 366 * times.DAY

    def look(direction):
        return asof.asof_join(
            probe, rows, "offer_id", "t", "fetched_at", "price_ngn", "p", direction, 0, year
        ).first()["p"]

    assert (look("backward"), look("forward")) == (1.0, 2.0)


# ----------------------------------------------------------------- features --


def test_features_by_hand(seen, now):
    rows = seen(
        ("a", "2026-09-01 00:00:00", 100), ("a", "2026-09-01 06:00:00", 110),
        ("a", "2026-09-02 06:00:00", 121),
    )
    out = features.build_features(rows).collect()
    assert len(out) == 2  # the last row has no outcome
    late = {r["fetched_at"].hour: r for r in out}[6]
    assert late["price_delta_6h"] == pytest.approx(0.1)
    assert late["price_delta_12h"] == pytest.approx(0.1)  # 6 h before, at the edge
    assert late["price_delta_24h"] == 0.0
    assert late["will_rise"] == 1 and late["future_price"] == 121.0
    assert (late["hour_of_day"], late["day_of_week"], late["route"]) == (7, 2, "LOS-ABV")
    assert late["days_to_departure"] == 29.0
    scored = features.score_features(rows, now).first()
    assert scored["price_ngn"] == 121.0 and scored["based_on_observations"] == 3
    assert scored["days_to_departure"] == 16.75


def test_calendar_gives_the_published_row_counts(spark):
    """180 six-hourly snapshots of 76 departures a day sold 30 days ahead."""
    per_direction = [(6, [6, 8, 22]), (6, [7, 21]), (4, [6, 20]), (4, [7, 22]),
                     (4, [7, 11, 16]), (4, [8, 14]), (4, [9, 17]), (2, [23])]
    daily = [h for n, hours in per_direction for _ in range(n) for h in hours]
    assert len(daily) == 76
    start = 1782644400  # 2026-06-28 11:00 UTC
    departures = spark.range(80 * 76).select(
        F.col("id").cast("string").alias("offer_id"),
        (
            F.lit(start - 11 * 3600)
            + F.floor(F.col("id") / 76) * 86400
            + F.get(F.array(*[F.lit(h - 1) for h in daily]), (F.col("id") % 76).cast("int")) * 3600
        ).alias("leaves"),
    )
    snapshots = F.explode(F.sequence(F.lit(0), F.lit(179)))
    sold = departures.select("*", snapshots.alias("s")).withColumn(
        "seen", F.lit(start) + F.col("s") * 6 * 3600
    ).filter((F.col("leaves") > F.col("seen")) & (F.col("leaves") <= F.col("seen") + 30 * 86400))
    rows = sold.select(
        "offer_id",
        F.timestamp_seconds("seen").alias("fetched_at"),
        (F.abs(F.hash("offer_id", "seen")) % 1000 + 1).cast("double").alias("price_ngn"),
    )
    labelled = features.price_label(rows).persist()
    assert rows.count() == 180 * 2280
    assert labelled.count() == 387_904
    train, test = features.time_split(labelled)
    assert (train.count(), test.count()) == (273_296, 114_608)
    latest_train = train.agg(F.max("fetched_at")).first()[0]
    earliest_test = test.agg(F.min("fetched_at")).first()[0]
    assert str(latest_train) == "2026-07-29 05:00:00"
    assert str(earliest_test) == "2026-07-29 11:00:00"
    purged, _ = features.time_split(labelled, purge_hours=24)
    assert purged.count() < train.count()
    labelled.unpersist()


def test_histogram_edges(spark):
    values = [(-1.0,), (-0.15,), (0.0,), (0.15,), (9.0,)]
    rows = spark.createDataFrame(values, "price_delta_6h double")
    bins = {r["bin"]: r["n_rows"] for r in features.delta_histogram(rows).collect()}
    assert bins == {0: 2, 30: 1, 59: 2}
    same = spark.createDataFrame([(0.0,), (0.0,)], "price_delta_6h double")
    assert features.delta_histogram(same).first()["bin"] == 30


def test_label_balance_warns_at_the_extremes(spark):
    rows = spark.createDataFrame([(1,)] * 19 + [(0,)], "will_rise int")
    assert features.label_balance(rows).first()["imbalanced"] is False
    assert features.label_balance(rows.filter("will_rise = 1")).first()["imbalanced"] is True


# ------------------------------------------------------ ordered and evaluation --


@pytest.mark.parametrize("ranges", [2, 7, 256])
def test_quantiles_equal_numpy_with_heavy_duplicates(spark, ranges):
    rng = np.random.default_rng(1)
    values = np.concatenate([np.full(700, 5.0), rng.normal(0, 100, 1300).round(1)])
    groups = rng.choice(["x", "y", "z"], 2000, p=[0.9, 0.08, 0.02])
    df = spark.createDataFrame(pd.DataFrame({"g": groups, "v": values}))
    marks = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.7, "e": 0.95, "f": 1.0}
    for row in ordered.quantiles(df, "v", marks, ("g",), ranges).collect():
        mine = values[groups == row["g"]]
        for name, fraction in marks.items():
            assert row[name] == pytest.approx(np.quantile(mine, fraction)), (row["g"], name)


def test_quantiles_of_nothing_and_of_one_value(spark):
    empty = spark.createDataFrame([], "v double")
    assert ordered.quantiles(empty, "v", {"m": 0.5}).first()["m"] is None
    single = spark.createDataFrame([(3.0,)], "v double")
    assert ordered.quantiles(single, "v", {"m": 0.5}).first()["m"] == 3.0


def _scored(spark, n=400, levels=37):
    rng = np.random.default_rng(3)
    p = rng.integers(0, levels, n) / (levels - 1)
    y = (rng.random(n) < p).astype(int)
    frame = pd.DataFrame({"probability": p, "label": y})
    return frame, spark.createDataFrame(frame)


def test_auc_counts_pairs_and_halves_ties(spark):
    frame, df = _scored(spark)
    pos = frame[frame.label == 1].probability.to_numpy()[:, None]
    neg = frame[frame.label == 0].probability.to_numpy()[None, :]
    expected = ((pos > neg) + 0.5 * (pos == neg)).mean()
    assert evaluate.auc(df).first()["auc"] == pytest.approx(expected)
    assert evaluate.auc(df.filter("label = 1")).first()["auc"] is None


def test_roc_ends_at_one_one_and_never_falls(spark):
    _, df = _scored(spark)
    points = evaluate.roc(df).orderBy(F.desc("threshold")).collect()
    assert (points[-1]["tpr"], points[-1]["fpr"]) == (1.0, 1.0)
    rates = [(r["fpr"], r["tpr"]) for r in points]
    assert rates == sorted(rates)


def test_calibration_edges_and_thin_bins(spark):
    rows = [(0.3, 1)] * 31 + [(0.55, 1)] * 30 + [(1.0, 1)] * 40
    out = evaluate.calibration(spark.createDataFrame(rows, "probability double, label int"))
    # 0.3 lies under the edge 0.30000000000000004; 30 rows are too few; 1.0 has no bin.
    assert {r["bin"]: r["observed"] for r in out.collect()} == {2: 1.0, 5: None}


def test_scores_and_confusion(spark):
    rows = [(0.9, 1), (0.5, 0), (0.2, 0), (0.4, 1)]
    df = spark.createDataFrame(rows, "probability double, label int")
    s = evaluate.scores(df).first()
    assert (s["accuracy"], s["baseline_accuracy"], s["accuracy_lift"]) == (0.5, 0.5, 0.0)
    assert s["brier"] == pytest.approx((0.01 + 0.25 + 0.04 + 0.36) / 4)
    cells = {(r["label"], r["predicted"]): r["n_rows"] for r in evaluate.confusion(df).collect()}
    assert cells == {(0, 0): 1, (0, 1): 1, (1, 0): 1, (1, 1): 1}


def test_box_figures_and_outliers(spark):
    rows = [("A", float(v)) for v in [1, 2, 3, 4, 100]] + [("B", 5.0)]
    df = spark.createDataFrame(rows, "carrier string, price_ngn double")
    box = {r["carrier"]: r for r in dashboard.price_spread(df).collect()}
    a = box["A"]
    assert (a["q1"], a["median"], a["q3"]) == (2.0, 3.0, 4.0)
    assert (a["whisker_low"], a["whisker_high"], a["n_outliers"]) == (1.0, 4.0, 1)
    assert [r["price_ngn"] for r in dashboard.price_outliers(df).collect()] == [100.0]


def test_null_groups_meet(spark):
    left = spark.createDataFrame([("a", 1), (None, 2)], "k string, x int")
    right = spark.createDataFrame([("a", 3), (None, 4)], "k string, y int")
    got = [tuple(r) for r in join_groups(left, right, ["k"]).collect()]
    assert sorted(got, key=repr) == sorted([("a", 1, 3), (None, 2, 4)], key=repr)


def test_summaries_keep_the_null_group(spark, seen):
    rows = seen(("a", "2026-09-01 00:00:00", 10)).withColumns(
        {"carrier": F.lit(None).cast("string"), "mode": F.lit("air")}
    )
    assert dashboard.carrier_summary(rows).count() == 1
    assert dashboard.price_spread(rows, ("carrier",)).count() == 1


# ----------------------------------------------------------------- training --


def test_patience_passes_over_a_dip():
    dip = [5.0, 4.0, 4.2, 4.1, 3.9, 3.95, 3.0, 3.1, 3.2, 3.3]
    assert training.best_round(dip, 1) == (2, True)
    assert training.best_round(dip, 3) == (7, True)
    assert training.best_round(dip, 4) == (7, False)
    # What follows a long pause is never reached, and of equal losses the first counts.
    assert training.best_round([2.0, 3.0, 3.0, 3.0, 1.0], 3) == (1, True)
    assert training.best_round([2.0, 1.0, 1.0], 50) == (2, False)


def test_growing_in_stages_is_growing_at_once(spark):
    rng = np.random.default_rng(5)
    n = 1200
    days, delta = rng.random(n) * 30, rng.normal(size=n) / 10
    label = (days + 60 * delta + rng.normal(size=n) * 6 > 15).astype(int)
    frame = pd.DataFrame({
        "days_to_departure": days, "hour_of_day": rng.integers(0, 24, n),
        "day_of_week": rng.integers(0, 7, n), "seats_left": rng.integers(0, 40, n),
        "price_delta_6h": delta, "price_delta_12h": rng.normal(size=n),
        "price_delta_24h": rng.normal(size=n), "carrier": rng.choice(["a", "b"], n),
        "route": rng.choice(["x", "y"], n), "will_rise": label,
    })
    rows = spark.createDataFrame(frame).repartition(2).persist()
    learnt, held_out = rows.filter("hour_of_day < 18"), rows.filter("hour_of_day >= 18")
    params = {"maxDepth": 3, "stepSize": 0.3, "minInstancesPerNode": 5}
    staged = training.grow(learnt, held_out, params, 24, 6, stage=3)
    at_once = training.grow(learnt, held_out, params, 24, 6, stage=24)
    assert (staged.rounds, staged.grown) == (at_once.rounds, at_once.grown)
    assert staged.loss == pytest.approx(at_once.loss) and staged.auc == pytest.approx(at_once.auc)
    assert staged.model.stages[-1].getNumTrees == staged.rounds <= staged.grown <= 24
    assert staged.auc > training.TARGET_AUC
    rows.unpersist()


def test_a_stage_is_not_fitted_again_to_be_cut(spark, monkeypatch):
    rng = np.random.default_rng(7)
    n = 900
    delta = rng.normal(size=n)
    frame = pd.DataFrame({
        "days_to_departure": rng.random(n), "hour_of_day": rng.integers(0, 24, n),
        "day_of_week": rng.integers(0, 7, n), "seats_left": rng.integers(0, 40, n),
        "price_delta_6h": delta, "price_delta_12h": rng.normal(size=n),
        "price_delta_24h": rng.normal(size=n), "carrier": rng.choice(["a", "b"], n),
        "route": rng.choice(["x", "y"], n),
        "will_rise": (delta + rng.normal(size=n) > 0).astype(int),
    })
    rows = spark.createDataFrame(frame).repartition(2).persist()
    learnt, held_out = rows.filter("hour_of_day < 18"), rows.filter("hour_of_day >= 18")
    params = {"maxDepth": 3, "stepSize": 0.4, "minInstancesPerNode": 5}
    fitted, classifier = [], training.classifier

    def counted(params, rounds, bins=64):
        fitted.append(rounds)
        return classifier(params, rounds, bins)

    monkeypatch.setattr(training, "classifier", counted)
    grown = training.grow(learnt, held_out, params, 40, 4, stage=2)
    # Each stage once, four times as large as the one before; no fit of the best round.
    assert fitted == [2, 8, 32, 40][: len(fitted)] and grown.rounds < fitted[-1]
    again = classifier(params, grown.rounds).fit(learnt)
    one, other = (
        [r[0] for r in training.with_probability(m, held_out).orderBy("price_delta_6h")
         .select("probability").collect()]
        for m in (grown.model, again)
    )
    assert one == pytest.approx(other)
    assert grown.model.stages[-1].treeWeights == again.stages[-1].treeWeights
    rows.unpersist()


@pytest.mark.parametrize("best", [20, 66, 126, 134, 187, 400])
def test_a_search_grows_few_rounds_again(monkeypatch, best):
    """Best rounds as seen on 320,000 rows; the patience is part of what has to be grown."""
    grown = []

    class Ensemble:
        stages = ()

        def __init__(self, rounds):
            self.rounds, self.stages = rounds, [self]

        def fit(self, rows):
            grown.append(self.rounds)
            return self

        def evaluateEachIteration(self, rows):
            return [abs(i - best) + 1.0 for i in range(1, self.rounds + 1)]

    class Rows:
        def select(self, *columns):
            return self

    monkeypatch.setattr(training, "classifier", lambda params, rounds, bins: Ensemble(rounds))
    monkeypatch.setattr(training, "first_rounds", lambda model, rounds: Ensemble(rounds))
    monkeypatch.setattr(training, "with_probability", lambda model, rows: model)
    monkeypatch.setattr(training, "_auc", lambda model: 0.5)
    monkeypatch.setattr(training.F, "col", lambda name: _Label())
    out = training.grow(Rows(), Rows(), {})
    needed = min(best + training.PATIENCE, training.ROUNDS)
    assert (out.rounds, out.grown, out.model.rounds) == (best, needed, best)
    assert sum(grown) <= max(256, 2 * needed)


class _Label:
    def cast(self, kind):
        return self

    def alias(self, name):
        return self


def _labelled_frame(seed, n):
    rng = np.random.default_rng(seed)
    delta = np.where(rng.random(n) < 0.2, 0.0, rng.normal(size=n) / 10)
    days, carrier = rng.random(n) * 30, rng.choice(list("abcdef"), n)
    noise = rng.normal(size=n) * 6 + np.where(carrier == "c", 4, 0)
    return pd.DataFrame({
        "days_to_departure": days, "hour_of_day": rng.integers(0, 24, n),
        "day_of_week": rng.integers(0, 7, n), "seats_left": rng.integers(0, 40, n),
        "price_delta_6h": delta, "price_delta_12h": rng.normal(size=n),
        "price_delta_24h": np.zeros(n), "carrier": carrier,
        "route": rng.choice(["x", "y", "z"], n),
        "will_rise": (days + 60 * delta + noise > 15).astype(int),
    })


@pytest.mark.parametrize("n", [1500, 24000])  # bins from all rows, and from a sample of them
def test_candidates_side_by_side_have_the_trees_of_spark(spark, n):
    rows = spark.createDataFrame(_labelled_frame(11, n)).repartition(3).persist()
    learnt, held_out = rows.filter("hour_of_day < 18"), rows.filter("hour_of_day >= 18")
    grid = [
        {"maxDepth": 4, "stepSize": 0.3, "minInstancesPerNode": 5},
        {"maxDepth": 2, "stepSize": 0.5, "minInstancesPerNode": 20},
    ]
    found = training.candidates(learnt, held_out, grid, 10, 4)
    for params, own in zip(grid, found):
        one = training.grow(learnt, held_out, params, 10, 4, stage=10)
        assert (own.params, own.rounds, own.grown) == (params, one.rounds, one.grown)
        assert own.loss == pytest.approx(one.loss) and own.auc == pytest.approx(one.auc)
    params, own = grid[0], training.fitted(learnt, grid[0], 6)
    spark_made = training.classifier(params, 6).fit(learnt)
    a, b = own.stages[-1], spark_made.stages[-1]
    assert a.treeWeights == b.treeWeights and a.numFeatures == b.numFeatures
    assert a.featureImportances.toArray() == pytest.approx(b.featureImportances.toArray())
    for x, y in zip(a.trees, b.trees):
        assert (x.depth, x.numNodes) == (y.depth, y.numNodes)
    p, q = (
        [r[0] for r in training.with_probability(m, held_out).orderBy("price_delta_12h")
         .select("probability").collect()]
        for m in (own, spark_made)
    )
    assert p == pytest.approx(q)
    rows.unpersist()


def test_a_block_draws_the_numbers_of_spark(spark):
    numbers = [r[0] for r in spark.range(0, 700, 1, 1).select(F.rand(-7)).collect()]
    assert boosting.uniforms(-7, 0, 700).tolist() == numbers
    assert boosting.uniforms(-7, 400, 123).tolist() == numbers[400:523]


def test_rows_are_counted_alike_however_they_are_dealt(spark, monkeypatch):
    rows = spark.createDataFrame(_labelled_frame(13, 1200)).repartition(3).persist()
    learnt, held_out = rows.filter("hour_of_day < 18"), rows.filter("hour_of_day >= 18")
    grid = [{"maxDepth": 3, "stepSize": 0.3, "minInstancesPerNode": 5}]
    plain = training.candidates(learnt, held_out, grid, 9, 9)[0]
    # Many blocks and tasks, added on the way; the trees known to the blocks at once, or late.
    for block, renewed, cut in ((64, 1, 2), (128, 100, 20)):
        monkeypatch.setattr(boosting, "BLOCK", block)
        monkeypatch.setattr(boosting, "BLOCKS_OF_A_TASK", 1)
        monkeypatch.setattr(boosting, "COLLECTED", 2)
        monkeypatch.setattr(boosting, "RENEWED", renewed)
        monkeypatch.setattr(boosting, "CUT", cut)
        other = training.candidates(learnt, held_out, grid, 9, 9)[0]
        assert (other.rounds, other.grown) == (plain.rounds, plain.grown)
        assert other.loss == pytest.approx(plain.loss) and other.auc == pytest.approx(plain.auc)
    rows.unpersist()


def test_a_search_has_one_job_a_level_for_all_candidates(spark):
    rows = spark.createDataFrame(_labelled_frame(17, 900)).repartition(2).persist()
    learnt, held_out = rows.filter("hour_of_day < 18"), rows.filter("hour_of_day >= 18")
    grid = [{"maxDepth": 2, "stepSize": s, "minInstancesPerNode": 20} for s in (0.9, 0.8, 0.7)]
    spark.sparkContext.setJobGroup("search", "search")
    try:
        found = training.candidates(learnt, held_out, grid, 600, 3)
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("search"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # Rounds beyond the patience are not grown; 60 jobs bin, deal and judge.
    assert jobs <= 2 * max(t.grown + 1 for t in found) + 60
    rows.unpersist()


def test_labels_and_parameters_that_cannot_be_learnt_are_refused(spark):
    frame = _labelled_frame(19, 200)
    with pytest.raises(ValueError, match="minInfoGain"):
        training._ensemble({"minInfoGain": 0.1})
    rows = spark.createDataFrame(frame.assign(will_rise=2))
    with pytest.raises(Exception, match="labels must be 0 or 1"):
        training.fitted(rows, training.SEARCH_GRID[0], 1)
    with pytest.raises(ValueError, match="no rows"):
        training.fitted(rows.limit(0), training.SEARCH_GRID[0], 1)


def test_training_learns_and_scores(spark, seen, now):
    frame = _random_history(1500, 3)
    # Prices alternate high and low by day, so the next day's move is learnable.
    frame["price_ngn"] = np.where(frame.fetched_at.dt.day % 2 == 0, 200.0, 100.0)
    rows = seen(*[(r.offer_id, str(r.fetched_at), r.price_ngn) for r in frame.itertuples()])
    table = features.build_features(rows).persist()
    grid = [{"maxDepth": 2, "stepSize": 0.3, "minInstancesPerNode": 1}]
    model, report = training.train(table, grid=grid, rounds=5)
    assert report["test_auc"] > 0.9
    assert report["train_rows"] + report["test_rows"] == table.count()
    record = training.run_record(spark, report, "t-1").first()
    assert record["model_version"] == "t-1" and record["test_rows"] == report["test_rows"]

    moment = F.lit("2026-09-11 00:00:00").cast("timestamp")
    asked = spark.createDataFrame([("o0",), ("nobody",)], "offer_id string")
    answers = {
        r["offer_id"]: r for r in training.score(model, asked, rows, moment, "t-1").collect()
    }
    assert answers["nobody"]["status"] == "no_history"
    assert answers["nobody"]["will_rise"] is None
    known = answers["o0"]
    assert known["status"] == "ok" and 0 <= known["probability"] <= 1
    log = training.prediction_log(
        training.score(model, asked, rows, moment, "t-1"), moment
    ).collect()
    assert [r["offer_id"] for r in log] == ["o0"] and log[0]["actual_rose"] is None
    table.unpersist()


def test_outcomes_are_filled_from_the_first_price_a_day_later(spark, seen):
    rows = seen(("a", "2026-09-02 00:00:00", 20), ("a", "2026-09-02 01:00:00", 5))
    predictions = spark.createDataFrame(
        [("a", "2026-09-01 00:00:00", 10.0), ("a", "2026-09-05 00:00:00", 10.0)],
        "offer_id string, t string, price_at_prediction double",
    ).select("offer_id", F.col("t").cast("timestamp").alias("predicted_at"),
             "price_at_prediction", F.lit(None).cast("boolean").alias("actual_rose"),
             F.lit(None).cast("timestamp").alias("scored_at"))
    out = training.fill_outcomes(predictions, rows).orderBy("predicted_at").collect()
    assert [r["actual_rose"] for r in out] == [True, None]
    assert str(out[0]["scored_at"]) == "2026-09-02 00:00:00" and out[1]["scored_at"] is None
