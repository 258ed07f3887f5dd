"""History, as-of lookups, features, evaluation and the dashboard."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.functions import times
from fareloom.operators import asof, dashboard, evaluate, features, history, training
from fareloom.plans import search
from fareloom.plans import view_sql as S
from fareloom.plans.q_feeds import _stored
from fareloom.plans.registry import question
from fareloom.plans.views import LISTING_NOW, OBS_NOW, Views
from fareloom.session import new_path, stored
from fareloom.sources import predictions, tables

_STORED_SQL = """SELECT offer_id, carrier, mode, origin, destination,
    epoch_us(depart_time) AS depart_us, duration_min, price_ngn, seats_left, booking_url,
    epoch_us(fetched_at) AS fetched_us FROM obs"""


@question("history_scan", S.with_views(S.OBS) + _STORED_SQL)
def history_scan(v):
    return _stored(v.history)


_HOT_SQL = (
    S.with_views(S.OBS)
    + """SELECT a.event_id, b.p AS later_price
  FROM (SELECT event_id, CASE WHEN event_id % 50 <> 0 THEN 'all' END AS k,
      date_trunc('minute', fetched_at) + INTERVAL 6 HOURS AS target FROM obs) a
  ASOF LEFT JOIN (SELECT 'all' AS k, date_trunc('minute', fetched_at) AS t,
      min(CAST(price_ngn AS DOUBLE)) AS p FROM obs WHERE event_id % 50 <> 0 GROUP BY 2) b
    ON a.k = b.k AND a.target <= b.t"""
)


@question("history_upsert", S.with_views(S.OBS) + _STORED_SQL)
def history_upsert(v):
    """Half the history, then all of it with that half again: each fact once."""
    path = new_path(v.spark, "history")
    half = v.obs.filter(F.col("event_id") % 2 == 0).select(*v.history.columns)
    tables.append_history(half, path)
    tables.append_history(v.history.unionByName(half), path)
    return _stored(tables.read_history(v.spark, path))


@question(
    "history_conflicts",
    S.with_views(S.OBS)
    + """SELECT offer_id, epoch_us(fetched_at) AS fetched_us, 2 AS deliveries
    FROM obs WHERE event_id % 7 = 0""",
)
def history_conflicts(v):
    """The whole history, then a seventh of it at another price: the keys that disagree."""
    path = new_path(v.spark, "history")
    tables.append_history(v.history, path)
    again = v.obs.filter(F.col("event_id") % 7 == 0).withColumn(
        "price_ngn", F.col("price_ngn") + 1
    )
    found = tables.conflicts(again.select(*v.history.columns), path)
    return found.select(
        "offer_id", F.unix_micros("fetched_at").alias("fetched_us"),
        F.col("deliveries").cast("int").alias("deliveries"),
    )


@question(
    "lookups_of_a_hot_key",
    _HOT_SQL,
)
def lookups_of_a_hot_key(v):
    """The as-of lookups with every observation under one key, ties and null keys included."""
    rows = v.obs.select(
        "event_id",
        F.when(F.col("event_id") % 50 != 0, "all").alias("k"),
        F.date_trunc("minute", "fetched_at").alias("t"),
        F.col("price_ngn").cast("double").alias("p"),
    )
    specs = [asof.Lookup("later", 6 * times.HOUR, 4000 * times.DAY, "forward")]
    return asof.self_lookups(rows, "k", "t", "p", specs, 500).select(
        "event_id", F.col("later").alias("later_price")
    )


@question(
    "recent_history",
    S.with_views(S.OBS)
    + f"""{_STORED_SQL} WHERE fetched_at >= {S.OBS_AT} - to_hours(48)
    AND offer_id IN (SELECT offer_id FROM obs)""",
)
def recent_history(v):
    """What was seen in two days of every offer there is."""
    return _stored(features.recent_history(v.history, v.obs, v.at(OBS_NOW)))


_ROUTE = f"""origin = 'LOS' AND destination = 'ABV'
    AND fetched_at >= {S.OBS_AT} - to_days(7)"""


@question("route_history", S.with_views(S.OBS) + f"{_STORED_SQL} WHERE {_ROUTE}")
def route_history(v):
    return _stored(dashboard.route_history(v.history, "LOS", "ABV", v.at(OBS_NOW), 7))


@question(
    "latest_offers",
    S.with_views(S.LISTING)
    + """SELECT offer_id, carrier, mode, origin, destination, depart_time, duration_min, price_ngn,
    seats_left, booking_url, fetched_at FROM latest""",
)
def latest_offers(v):
    return v.latest


@question(
    "route_latest",
    S.with_views(S.LISTING)
    + """SELECT offer_id, carrier, depart_time, price_ngn, seats_left FROM latest
    WHERE origin = 'LOS' AND destination = 'PHC'""",
)
def route_latest(v):
    """One route of the latest table, stored by route so others are not read."""
    path = new_path(v.spark, "latest")
    tables.write_latest(v.latest, path)
    stored = v.spark.read.schema(v.latest.schema).parquet(path)
    return tables.route_latest(stored, "LOS", "PHC").select(
        "offer_id", "carrier", "depart_time", "price_ngn", "seats_left"
    )


@question(
    "live_count",
    S.with_views(S.LISTING)
    + f"SELECT count(*) AS offers_cached, {S.utc_text(S.LISTING_AT)} AS offers_counted_at FROM latest",
)
def live_count(v):
    return search.live_count(v.latest, v.at(LISTING_NOW))


@question(
    "feed_freshness",
    S.with_views(S.OBS, S.LATEST_OBS)
    + f"""
  SELECT carrier, epoch_us(max(fetched_at)) AS newest_us, count(*) AS n_offers,
    epoch_us({S.OBS_AT}) - epoch_us(max(fetched_at)) > 900000000 AS stale
  FROM latest_obs GROUP BY carrier""",
)
def feed_freshness(v):
    return history.feed_freshness(v.latest_obs, v.at(OBS_NOW)).select(
        "carrier", F.unix_micros("newest").alias("newest_us"), "n_offers", "stale"
    )


@question(
    "history_totals",
    S.with_views(S.OBS)
    + """SELECT count(*) AS n_rows, count(DISTINCT offer_id) AS n_departures,
    count(DISTINCT fetched_at) AS n_moments FROM obs""",
)
def history_totals(v):
    return history.totals(v.history)


@question(
    "history_profile",
    S.with_views(S.OBS)
    + """SELECT count(*) AS n_rows, count(DISTINCT offer_id) AS n_departures,
    epoch_us(min(fetched_at)) AS first_us, epoch_us(max(fetched_at)) AS last_us,
    count(DISTINCT carrier) AS n_carriers, count(DISTINCT origin) AS n_origins FROM obs""",
)
def history_profile(v):
    p = history.profile(v.history)
    return p.select(
        "n_rows", "n_departures", F.unix_micros("first_fetch").alias("first_us"),
        F.unix_micros("last_fetch").alias("last_us"), "n_carriers", "n_origins",
    )


@question(
    "duplicate_keys",
    """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL
    HAVING count(*) > 1""",
)
def duplicate_keys(v):
    return history.duplicate_keys(v.table("lineitem"), ["l_orderkey", "l_linenumber"])


# -------------------------------------------------------------------- as-of --

_FEATURES = S.with_views(S.OBS, S.FEATURES)
_KEYED = "offer_id, epoch_us(fetched_at) AS fetched_us"


def _keyed(rows: DataFrame, *columns) -> DataFrame:
    return rows.select("offer_id", F.unix_micros("fetched_at").alias("fetched_us"), *columns)


@question(
    "asof_forward", _FEATURES + f"SELECT {_KEYED}, future_price FROM framed"
)
def asof_forward(v):
    rows = asof.self_lookups(
        v.history, "offer_id", "fetched_at", "price_ngn", [features.FUTURE]
    )
    return _keyed(rows, "future_price")


@question(
    "asof_nearest",
    S.with_views(S.OBS, S.PREDICTIONS)
    + f"""
  SELECT offer_id, epoch_us(predicted_at) AS predicted_us, (
    SELECT price_ngn FROM obs WHERE obs.offer_id = p.offer_id
      AND abs(epoch_us(obs.fetched_at) - (epoch_us(p.predicted_at) - {6 * S.H})) <= {3 * S.H}
    ORDER BY abs(epoch_us(obs.fetched_at) - (epoch_us(p.predicted_at) - {6 * S.H})),
      obs.fetched_at LIMIT 1) AS past_price
  FROM predictions p""",
)
def asof_nearest(v):
    """Two tables: each prediction with the price nearest six hours before it."""
    found = asof.asof_join(
        v.predictions, v.history, "offer_id", "predicted_at", "fetched_at", "price_ngn",
        "past_price", "nearest", -6 * times.HOUR, 3 * times.HOUR,
    )
    return found.select(
        "offer_id", F.unix_micros("predicted_at").alias("predicted_us"), "past_price"
    )


_DELTAS = """round(price_delta_6h, 9) AS price_delta_6h, round(price_delta_12h, 9)
    AS price_delta_12h, round(price_delta_24h, 9) AS price_delta_24h"""


def _deltas():
    return [F.round(f"price_delta_{h}h", 9).alias(f"price_delta_{h}h") for h in (6, 12, 24)]


@question("price_deltas", _FEATURES + f"SELECT {_KEYED}, {_DELTAS} FROM deltas")
def price_deltas(v):
    return _keyed(features.price_deltas(v.history), *_deltas())


@question("price_label", _FEATURES + f"SELECT {_KEYED}, future_price, will_rise FROM features")
def price_label(v):
    return _keyed(features.price_label(v.history), "future_price", "will_rise")


@question(
    "features",
    _FEATURES
    + f"""SELECT {_KEYED}, round(days_to_departure, 6) AS days_to_departure, hour_of_day,
    day_of_week, seats_left, {_DELTAS}, carrier, route, future_price, will_rise FROM features""",
)
def build_features(v):
    rows = features.build_features(v.history)
    return _keyed(
        rows, F.round("days_to_departure", 6).alias("days_to_departure"), "hour_of_day",
        "day_of_week", "seats_left", *_deltas(), "carrier", "route", "future_price", "will_rise",
    )


_RECENT_FRAMES = S.FEATURES.replace("FROM obs)", f"FROM obs WHERE fetched_at >= {S.OBS_AT} - to_hours(48))")


@question(
    "score_features",
    S.with_views(S.OBS, _RECENT_FRAMES)
    + f"""
  SELECT offer_id, price_ngn, seats_left, {_DELTAS},
    round(CAST(epoch_us(depart_time) - epoch_us({S.OBS_AT}) AS DOUBLE) / 86400000000, 6)
      AS days_to_departure, n AS based_on_observations
  FROM (SELECT *, count(*) OVER (PARTITION BY offer_id) AS n, row_number() OVER (
    PARTITION BY offer_id ORDER BY fetched_at DESC) AS rn FROM deltas) WHERE rn = 1""",
)
def score_features(v):
    now = v.at(OBS_NOW)
    recent = features.recent_history(v.history, v.history, now)
    rows = features.score_features(recent, now)
    return rows.select(
        "offer_id", "price_ngn", "seats_left", *_deltas(),
        F.round("days_to_departure", 6).alias("days_to_departure"), "based_on_observations",
    )


@question(
    "label_balance",
    _FEATURES
    + """SELECT count(*) AS n_rows, round(avg(CAST(will_rise AS DOUBLE)), 9) AS positive_rate,
    avg(CAST(will_rise AS DOUBLE)) < 0.05 OR avg(CAST(will_rise AS DOUBLE)) > 0.95 AS imbalanced
  FROM features""",
)
def label_balance(v):
    out = features.label_balance(features.price_label(v.history))
    return out.withColumn("positive_rate", F.round("positive_rate", 9))


@question(
    "rise_by_days",
    _FEATURES
    + """SELECT CAST(round_even(days_to_departure, 0) AS INTEGER) AS days,
    round(avg(CAST(will_rise AS DOUBLE)), 9) AS rise_rate, count(*) AS n_rows
  FROM features GROUP BY 1""",
)
def rise_by_days(v):
    out = features.rise_by_days(features.build_features(v.history))
    return out.withColumn("rise_rate", F.round("rise_rate", 9))


@question(
    "delta_histogram",
    S.with_views(
        S.OBS,
        S.FEATURES,
        """clipped AS (SELECT greatest(least(price_delta_6h, CAST(0.15 AS DOUBLE)),
          CAST(-0.15 AS DOUBLE)) AS v FROM features), ends AS (
          SELECT min(v) AS low, max(v) AS high FROM clipped)""",
    )
    + """
  SELECT CAST(least(floor((v - low) / ((high - low) / 60)), 59) AS INTEGER) AS bin,
    count(*) AS n_rows FROM clipped, ends GROUP BY 1""",
)
def delta_histogram(v):
    return features.delta_histogram(features.build_features(v.history))


@question(
    "median_move",
    _FEATURES + "SELECT round(median(abs(price_delta_6h)), 9) AS median_move FROM features",
)
def median_move(v):
    rows = stored(features.build_features(v.history).select("price_delta_6h"), "moves")
    out = features.median_move(rows)
    return out.select(F.round("median_move", 9).alias("median_move"))


@question(
    "time_split",
    _FEATURES
    + """
  SELECT CASE WHEN epoch_us(fetched_at) <= (SELECT quantile_cont(CAST(epoch_us(fetched_at)
      AS DOUBLE), 0.7) FROM features) THEN 'train' ELSE 'test' END AS side, count(*) AS n_rows,
    epoch_us(min(fetched_at)) AS first_us, epoch_us(max(fetched_at)) AS last_us
  FROM features GROUP BY 1""",
)
def time_split(v):
    out = features.split_summary(stored(features.price_label(v.history), "labelled"))
    return out.select(
        "side", "n_rows", F.unix_micros("first_at").alias("first_us"),
        F.unix_micros("last_at").alias("last_us"),
    )


# --------------------------------------------------------------- evaluation --

_SCORED = S.with_views(S.OBS, S.SCORED)


@question(
    "eval_auc",
    _SCORED
    + """
  SELECT round(sum(pos * (below + CAST(neg AS DOUBLE) / 2)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)),
    9) AS auc, sum(pos) AS positives, sum(neg) AS negatives
  FROM (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY probability ROWS BETWEEN UNBOUNDED
      PRECEDING AND 1 PRECEDING), 0) AS below
    FROM (SELECT probability, sum(label)::BIGINT AS pos, sum(1 - label)::BIGINT AS neg FROM scored
      GROUP BY 1))""".replace("sum(pos) AS positives, sum(neg) AS negatives",
                            "CAST(sum(pos) AS BIGINT) AS positives, "
                            "CAST(sum(neg) AS BIGINT) AS negatives"),
)
def eval_auc(v):
    return evaluate.auc(v.scored).withColumn("auc", F.round("auc", 9))


@question(
    "eval_roc",
    _SCORED
    + """
  SELECT probability AS threshold, CAST(tp AS BIGINT) AS true_positives,
    CAST(fp AS BIGINT) AS false_positives,
    round(CAST(tp AS DOUBLE) / (SELECT sum(label) FROM scored), 9) AS tpr,
    round(CAST(fp AS DOUBLE) / (SELECT sum(1 - label) FROM scored), 9) AS fpr
  FROM (SELECT probability, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp
    FROM (SELECT probability, sum(label) AS pos, sum(1 - label) AS neg FROM scored GROUP BY 1)
    WINDOW w AS (ORDER BY probability DESC ROWS UNBOUNDED PRECEDING))""",
)
def eval_roc(v):
    return evaluate.roc(v.scored).withColumns(
        {"tpr": F.round("tpr", 9), "fpr": F.round("fpr", 9)}
    )


@question(
    "eval_scores",
    _SCORED
    + """
  SELECT n_rows, round(accuracy, 9) AS accuracy, round(rate, 9) AS positive_rate,
    round(brier, 9) AS brier, round(greatest(rate, 1 - rate), 9) AS baseline_accuracy,
    round(accuracy - greatest(rate, 1 - rate), 9) AS accuracy_lift
  FROM (SELECT count(*) AS n_rows, avg(CAST((probability >= 0.5) = (label = 1) AS DOUBLE))
      AS accuracy, avg(CAST(label AS DOUBLE)) AS rate,
      avg((probability - label) * (probability - label)) AS brier FROM scored)""",
)
def eval_scores(v):
    out = evaluate.scores(v.scored)
    return out.select("n_rows", *[F.round(c, 9).alias(c) for c in out.columns if c != "n_rows"])


@question(
    "eval_calibration",
    _SCORED
    + """
  SELECT CAST(bin AS INTEGER) AS bin, round(bin * 0.1 + 0.05, 9)::DOUBLE AS centre, n_rows,
    CASE WHEN n_rows > 30 THEN rate END AS observed
  FROM (SELECT floor(probability * 10000) // 1000 AS bin, count(*) AS n_rows,
      round(avg(CAST(label AS DOUBLE)), 9) AS rate
    FROM (SELECT label, probability, CASE WHEN probability IN (0.3, 0.6, 0.7)
        THEN probability - 0.0001 ELSE probability + 0.00001 END AS p FROM scored) t
    WHERE probability < 1 GROUP BY 1)""".replace("floor(probability * 10000) // 1000",
                                                 "CAST(floor(p * 10) AS BIGINT)"),
)
def eval_calibration(v):
    """Edges are multiples of the double 0.1, so 0.3, 0.6 and 0.7 fall one bin lower."""
    return evaluate.calibration(v.scored).withColumns(
        {"observed": F.round("observed", 9), "centre": F.round("centre", 9)}
    )


@question(
    "eval_confusion",
    _SCORED
    + """
  SELECT c.label, c.predicted, count(s.label) AS n_rows
  FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) AS c(label, predicted)
  LEFT JOIN scored s ON s.label = c.label AND CAST(s.probability >= 0.5 AS INTEGER) = c.predicted
  GROUP BY ALL""",
)
def eval_confusion(v):
    return evaluate.confusion(v.scored)


# ---------------------------------------------------------------- dashboard --

_OBS = S.with_views(S.OBS)


@question(
    "daily_price",
    _OBS
    + """SELECT strftime(fetched_at, '%Y-%m-%d') AS day, carrier, round(avg(price_ngn), 6) AS price
  FROM obs GROUP BY 1, 2""",
)
def daily_price(v):
    out = dashboard.daily_price(v.history)
    return out.select(
        F.date_format("day", "yyyy-MM-dd").alias("day"), "carrier",
        F.round("price", 6).alias("price"),
    )


@question(
    "price_spread",
    _OBS
    + """
  SELECT carrier, mode, q1, median, q3, min(price_ngn) FILTER (inside) AS whisker_low,
    max(price_ngn) FILTER (inside) AS whisker_high, count(*) FILTER (NOT inside) AS n_outliers
  FROM (SELECT o.*, q1, median, q3,
      price_ngn BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
    FROM obs o JOIN (SELECT carrier, mode, quantile_cont(price_ngn, 0.25) AS q1,
      quantile_cont(price_ngn, 0.5) AS median, quantile_cont(price_ngn, 0.75) AS q3
      FROM obs GROUP BY 1, 2) b ON o.carrier IS NOT DISTINCT FROM b.carrier
        AND o.mode IS NOT DISTINCT FROM b.mode)
  GROUP BY 1, 2, 3, 4, 5""",
)
def price_spread(v):
    return dashboard.price_spread(v.history, ("carrier", "mode"))


@question(
    "price_outliers",
    _OBS
    + """
  SELECT event_id, carrier, price_ngn FROM obs JOIN (
    SELECT carrier, quantile_cont(price_ngn, 0.25) AS q1, quantile_cont(price_ngn, 0.75) AS q3
    FROM obs GROUP BY 1) USING (carrier)
  WHERE price_ngn NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)""",
)
def price_outliers(v):
    return dashboard.price_outliers(v.obs).select("event_id", "carrier", "price_ngn")


@question(
    "carrier_summary",
    _OBS
    + """SELECT carrier, mode, count(*) AS observations, min(price_ngn) AS cheapest,
    median(price_ngn) AS typical, max(price_ngn) AS dearest FROM obs GROUP BY 1, 2""",
)
def carrier_summary(v):
    return dashboard.carrier_summary(v.history)


@question(
    "urgency_curve",
    _OBS
    + """
  SELECT days_ahead, mode, round(avg(price_ngn), 6) AS price
  FROM (SELECT mode, price_ngn, CAST(round_even(CAST(epoch_us(depart_time) - epoch_us(fetched_at)
      AS DOUBLE) / 86400000000, 0) AS INTEGER) AS days_ahead FROM obs)
  WHERE days_ahead BETWEEN 0 AND 30 GROUP BY 1, 2""",
)
def urgency_curve(v):
    return dashboard.urgency_curve(v.history).withColumn("price", F.round("price", 6))


_RESOLVED = S.with_views(S.OBS, S.PREDICTIONS)


def _resolved(v: Views) -> DataFrame:
    return training.fill_outcomes(v.predictions, v.history)


@question(
    "prediction_outcome",
    _RESOLVED
    + """SELECT offer_id, epoch_us(predicted_at) AS predicted_us, will_rise, price_at_prediction,
    actual_rose, epoch_us(scored_at) AS scored_us FROM resolved""",
)
def prediction_outcome(v):
    return _resolved(v).select(
        "offer_id", F.unix_micros("predicted_at").alias("predicted_us"), "will_rise",
        "price_at_prediction", "actual_rose", F.unix_micros("scored_at").alias("scored_us"),
    )


_MIDWAY = "2024-01-15 00:00:00"


@question(
    "prediction_backfill",
    _RESOLVED
    + f"""SELECT offer_id, epoch_us(predicted_at) AS predicted_us, will_rise, price_at_prediction,
    actual_rose, CASE WHEN actual_rose IS NOT NULL THEN epoch_us(scored_at) END AS scored_us,
    true AS settled FROM resolved""",
)
def prediction_backfill(v):
    """The log of all predictions, written twice, its outcomes filled in midway and at the end.

    ``settled``: running it once more rewrote no day.
    """
    path = new_path(v.spark, "predictions")
    for _ in range(2):
        predictions.append_predictions(v.predictions, path)
    predictions.fill_in(v.spark, path, v.history, v.at(_MIDWAY))
    predictions.fill_in(v.spark, path, v.history, v.at(OBS_NOW))
    again = predictions.fill_in(v.spark, path, v.history, v.at(OBS_NOW))
    return predictions.read_predictions(v.spark, path).select(
        "offer_id", F.unix_micros("predicted_at").alias("predicted_us"), "will_rise",
        F.col("price_at_prediction").cast("double").alias("price_at_prediction"), "actual_rose",
        F.unix_micros("scored_at").alias("scored_us"), F.lit(not again).alias("settled"),
    )


@question(
    "prediction_counts",
    _RESOLVED
    + """SELECT count(*) AS n_predictions, count(actual_rose) AS n_known,
    round(100 * avg(CAST(will_rise = actual_rose AS DOUBLE)), 6) AS percent_correct FROM resolved""",
)
def prediction_counts(v):
    out = dashboard.prediction_counts(_resolved(v))
    return out.withColumn("percent_correct", F.round("percent_correct", 6))


@question(
    "daily_accuracy",
    _RESOLVED
    + """SELECT strftime(predicted_at, '%Y-%m-%d') AS day,
    round(avg(CAST(will_rise = actual_rose AS DOUBLE)), 9) AS accuracy, count(*) AS n
  FROM resolved WHERE actual_rose IS NOT NULL GROUP BY 1""",
)
def daily_accuracy(v):
    out = dashboard.daily_accuracy(_resolved(v))
    return out.select(
        F.date_format("day", "yyyy-MM-dd").alias("day"),
        F.round("accuracy", 9).alias("accuracy"), "n",
    )


# ----------------------------------------------------------------- training --


# Models of this session's tables: where they are kept, and their record.
_MODELS: dict[tuple[str, str], tuple[str, dict]] = {}


def _trained(v: Views) -> tuple[str, dict]:
    """A trained model, saved, and its report; once a session and folder.

    Features are written once, so each tree reads a table and not the whole lineage.
    """
    key = (v.spark.sparkContext.applicationId, v.dir)
    if key not in _MODELS:
        rows = stored(features.build_features(v.history), "features")
        model, report = training.train(rows)
        path = new_path(v.spark, "model")
        model.write().save(path)
        _MODELS[key] = (path, report)
    return _MODELS[key]


@question("train_metrics")
def train_metrics(v):
    _, report = _trained(v)
    record = training.run_record(v.spark, report, "gbt-demo")
    path = new_path(v.spark, "run")
    record.write.json(path)
    return v.spark.read.schema(record.schema).json(path)


@question("score_latest")
def score_latest(v):
    """Every known offer scored; the answers go to the prediction log as well."""
    now = v.at(OBS_NOW)
    model = PipelineModel.load(_trained(v)[0])
    answers = stored(training.score(model, v.latest_obs, v.history, now, "gbt-demo"), "answers")
    predictions.append_predictions(
        training.prediction_log(answers, now), new_path(v.spark, "predictions")
    )
    return answers
