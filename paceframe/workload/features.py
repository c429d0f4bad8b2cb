"""Scalar functions, history, features, encoders, scalers, splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import clean, encode, features, history, joins, scale, split
from ..session import materialise
from ..sources import tables as src
from . import roles as R
from .registry import query, r6, rounded, sql6
from .relational import LAP_ROLES, LAP_ROWS_SQL, classification_rows, lap_rows, regression_rows
from .roles import with_roles

CUT = "2000-01-01"
_UNIT = "(('0x' || substr(md5(concat({0}::VARCHAR, '{1}')), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


def unit_sql(key: str, seed: str = "42") -> str:
    return _UNIT.format(key, seed)


# --- scalar functions ----------------------------------------------------------

@query("coerce_numeric", with_roles("""
SELECT result_id, try_cast(grid AS DOUBLE) AS grid, try_cast(position AS DOUBLE) AS position FROM raw_results""",
    "raw_results"))
def coerce_numeric(spark, sf):
    return clean.coerce(R.raw_results(spark, sf), ["grid", "position"]).select("result_id", "grid", "position")


@query("coerce_date", with_roles("""
SELECT result_id, try_cast(date AS TIMESTAMP) AS date FROM raw_results""", "raw_results"))
def coerce_date(spark, sf):
    return clean.coerce(R.raw_results(spark, sf), moments=["date"]).select("result_id", "date")


@query("age_feature", with_roles("""
SELECT result_id, cast(year - year(try_cast(dob AS DATE)) AS BIGINT) AS driver_age
FROM entries e LEFT JOIN drivers d ON e.driver_id = d.driver_id""", "entries", "drivers"))
def age_feature(spark, sf):
    df = joins.left_join(R.entries(spark, sf), R.drivers(spark, sf), "driver_id", ["dob"])
    return df.select("result_id", S.years_between("year", S.to_moment("dob")).cast("bigint").alias("driver_age"))


def _clock_sql(c: str, strict: bool) -> str:
    clock = (
        f"(try_cast(split_part({c}, ':', 1) AS INTEGER) * 60 + try_cast(split_part({c}, ':', 2) AS DOUBLE)) * 1000"
    )
    if strict:
        return f"CASE WHEN len(string_split({c}, ':')) = 2 THEN {clock} END"
    return f"CASE WHEN contains({c}, ':') THEN {clock} ELSE try_cast({c} AS DOUBLE) * 1000 END"


@query("laptime_to_ms", with_roles(f"""
SELECT race_id, driver_id, {sql6(_clock_sql('q1', False), 'q1_ms')}, {sql6(_clock_sql('q2', False), 'q2_ms')}
FROM qualifying""", "qualifying"))
def laptime_to_ms(spark, sf):
    return R.qualifying(spark, sf).select(
        "race_id", "driver_id", r6(S.clock_to_ms("q1")).alias("q1_ms"), r6(S.clock_to_ms("q2")).alias("q2_ms")
    )


@query("laptime_to_ms_strict", with_roles(f"""
SELECT race_id, driver_id, {sql6(_clock_sql('q1', True), 'q1_ms')}, {sql6(_clock_sql('q3', True), 'q3_ms')}
FROM qualifying""", "qualifying"))
def laptime_to_ms_strict(spark, sf):
    return R.qualifying(spark, sf).select(
        "race_id", "driver_id", r6(S.clock_to_ms("q1", strict=True)).alias("q1_ms"),
        r6(S.clock_to_ms("q3", strict=True)).alias("q3_ms"),
    )


@query("presence_flags", with_roles("""
SELECT race_id, driver_id, cast(q1 IS NOT NULL AS INTEGER) AS has_q1, cast(q2 IS NOT NULL AS INTEGER) AS has_q2,
  cast(q3 IS NOT NULL AS INTEGER) AS has_q3 FROM qualifying""", "qualifying"))
def presence_flags(spark, sf):
    return R.qualifying(spark, sf).select(
        "race_id", "driver_id", *[S.present(q).alias(f"has_{q}") for q in ("q1", "q2", "q3")]
    )


@query("threshold_flags", with_roles("""
SELECT result_id, cast(coalesce(position <= 3, false) AS INTEGER) AS podium,
  cast(coalesce(grid <= 5, false) AS INTEGER) AS front_grid, cast(coalesce(round <= 3, false) AS INTEGER) AS early
FROM entries""", "entries"))
def threshold_flags(spark, sf):
    return R.entries(spark, sf).select(
        "result_id", S.flag(F.col("position") <= 3).alias("podium"), S.flag(F.col("grid") <= 5).alias("front_grid"),
        S.flag(F.col("round") <= 3).alias("early"),
    )


@query("ms_to_min_sec", with_roles(f"""
SELECT race_id, driver_id, lap, milliseconds, cast(floor(milliseconds / 1000.0::DOUBLE / 60) AS BIGINT) AS minutes,
  {sql6('milliseconds / 1000.0::DOUBLE - 60 * floor(milliseconds / 1000.0::DOUBLE / 60)', 'seconds')} FROM laps""", "laps"))
def ms_to_min_sec(spark, sf):
    m, s = S.minutes_seconds("milliseconds")
    return R.laps(spark, sf).select("race_id", "driver_id", "lap", "milliseconds", m.alias("minutes"), r6(s).alias("seconds"))


@query("bin_right_closed", with_roles("""
SELECT result_id, CASE WHEN grid > 0 AND grid <= 1 THEN 'pole' WHEN grid > 1 AND grid <= 10 THEN 'top10'
    WHEN grid > 10 AND grid <= 30 THEN 'backmarker' END AS grid_group,
  CASE WHEN p > 0 AND p <= 0.33 THEN 'early' WHEN p > 0.33 AND p <= 0.66 THEN 'mid' WHEN p > 0.66 AND p <= 1 THEN 'late' END AS laps_group
FROM (SELECT *, (laps - 40) / 30.0::DOUBLE AS p FROM entries)""", "entries"))
def bin_right_closed(spark, sf):
    done = (F.col("laps") - 40) / F.lit(30.0)
    return R.entries(spark, sf).select(
        "result_id", S.band("grid", *features.GRID_BANDS).alias("grid_group"),
        S.band(done, *features.LAP_BANDS).alias("laps_group"),
    )


@query("interaction_key", with_roles("""
SELECT result_id, grid::VARCHAR || '_' || round::VARCHAR AS grid_round FROM entries""", "entries"))
def interaction_key(spark, sf):
    return R.entries(spark, sf).select("result_id", S.pair_key("grid", "round").alias("grid_round"))


@query("hash_bucket", """
SELECT o_orderkey, ('0x' || substr(md5(o_clerk), 1, 8))::BIGINT % 10000 AS bucket
FROM (SELECT o_orderkey, o_custkey::VARCHAR || '_' || o_orderpriority AS o_clerk FROM orders)""")
def hash_bucket(spark, sf):
    key = S.pair_key("o_custkey", "o_orderpriority")
    return src.read_table(spark, sf, "orders").select("o_orderkey", S.hash_bucket(key).alias("bucket"))


@query("prediction_interval", with_roles(f"""
SELECT result_id, {sql6('pred', 'pred')}, round_even(pred, 0) AS rounded,
  cast(greatest(1, floor(pred - 2.5)) AS BIGINT) AS low, cast(least(24, ceil(pred + 2.5)) AS BIGINT) AS high
FROM predicted""", "predicted"))
def prediction_interval(spark, sf):
    low, high = S.clamped_interval(F.col("pred"), 2.5)
    return R.predicted(spark, sf).select(
        "result_id", r6("pred").alias("pred"), F.bround("pred", 0).alias("rounded"), low.alias("low"), high.alias("high")
    )


# --- history -------------------------------------------------------------------

def podium_rows(spark, sf):
    return clean.podium_target(R.entries(spark, sf)).select(
        "result_id", "race_id", "driver_id", "date", "year", "is_podium", "position_original"
    )


def team_podium_rows(spark, sf):
    return materialise(clean.podium_target(R.results(spark, sf)).select(
        "result_id", "race_id", "team_id", "date", "year", "is_podium"
    ))


_POD = "h AS (SELECT *, cast(position <= 3 AS INTEGER) AS is_podium FROM results WHERE position IS NOT NULL)"
_ORD = "ORDER BY date, race_id, result_id ROWS BETWEEN {0} PRECEDING AND 1 PRECEDING"


def _over(part: str, frame: str = "UNBOUNDED") -> str:
    return f"OVER (PARTITION BY {part} {_ORD.format(frame)})"


def _history_sql(*cols: str) -> str:
    return with_roles(f"WITH {_POD} SELECT result_id, {', '.join(cols)} FROM h", "results")


@query("hist_last5", _history_sql(
    f"coalesce(sum(is_podium) {_over('driver_id', '5')}, 0)::DOUBLE AS driver_podiums_last_5"))
def hist_last5(spark, sf):
    df = history.lagged_history(
        podium_rows(spark, sf), "driver_id", history.ORDER, {"driver_podiums_last_5": ("last_sum", F.col("is_podium"), 5)}
    )
    return df.select("result_id", "driver_podiums_last_5")


_HOLES = "SELECT * REPLACE (CASE WHEN result_id % 7 = 0 THEN NULL ELSE date END AS date) FROM h"
_NULLS_FIRST = _ORD.replace("ORDER BY date,", "ORDER BY date NULLS FIRST,")


@query("hist_hot_null_dates", with_roles(f"""
WITH {_POD}, g AS ({_HOLES}) SELECT result_id,
  coalesce(sum(is_podium) OVER (PARTITION BY driver_id {_NULLS_FIRST.format(5)}), 0)::DOUBLE AS driver_podiums_last_5,
  {sql6(f"coalesce(avg(is_podium) OVER (PARTITION BY driver_id, year {_NULLS_FIRST.format('UNBOUNDED')}), 0)", "driver_podium_rate_season")},
  coalesce(sum(CASE WHEN position = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY driver_id, year {_NULLS_FIRST.format('UNBOUNDED')}), 0)::DOUBLE
    AS driver_wins_season FROM g""", "results"))
def hist_hot_null_dates(spark, sf):
    """The cut path, reached by a low limit, over rows of which some have no date."""
    rows = podium_rows(spark, sf).withColumn("date", F.when(F.col("result_id") % 7 != 0, F.col("date")))
    df = history.driver_history(rows, hot_rows=50)
    return rounded(df.select("result_id", "driver_podiums_last_5", "driver_podium_rate_season", "driver_wins_season"))


@query("hist_season_rate", _history_sql(
    sql6(f"coalesce(avg(is_podium) {_over('driver_id, year')}, 0)", "driver_podium_rate_season")))
def hist_season_rate(spark, sf):
    return rounded(history.driver_history(podium_rows(spark, sf)).select("result_id", "driver_podium_rate_season"))


@query("hist_season_wins", _history_sql(
    f"coalesce(sum(CASE WHEN position = 1 THEN 1 ELSE 0 END) {_over('driver_id, year')}, 0)::DOUBLE AS driver_wins_season"))
def hist_season_wins(spark, sf):
    return history.driver_history(podium_rows(spark, sf)).select("result_id", "driver_wins_season")


@query("hist_team_last5", _history_sql(
    f"coalesce(sum(is_podium) {_over('team_id', '5')}, 0)::DOUBLE AS team_podiums_last_5"))
def hist_team_last5(spark, sf):
    return history.team_history(team_podium_rows(spark, sf)).select("result_id", "team_podiums_last_5")


@query("hist_team_season_rate", _history_sql(
    sql6(f"coalesce(avg(is_podium) {_over('team_id, year')}, 0)", "team_podium_rate_season")))
def hist_team_season_rate(spark, sf):
    return rounded(history.team_history(team_podium_rows(spark, sf)).select("result_id", "team_podium_rate_season"))


@query("hist_team_events", with_roles(f"""
WITH {_POD}, ev AS (SELECT team_id, year, date, race_id, sum(is_podium) AS p, count(*) AS n FROM h GROUP BY ALL),
w AS (SELECT *, coalesce(sum(p) OVER (PARTITION BY team_id ORDER BY date, race_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), 0) AS l5,
  coalesce((sum(p) OVER s) / (sum(n) OVER s), 0) AS rate FROM ev
  WINDOW s AS (PARTITION BY team_id, year ORDER BY date, race_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT result_id, l5::DOUBLE AS team_podiums_last_5, {sql6('rate', 'team_podium_rate_season')}
FROM h JOIN w ON h.team_id = w.team_id AND h.race_id = w.race_id""", "results"))
def hist_team_events(spark, sf):
    df = history.team_history(team_podium_rows(spark, sf), unit="event")
    return rounded(df.select("result_id", "team_podiums_last_5", "team_podium_rate_season"))


@query("season_progress", with_roles(f"""
SELECT result_id, {sql6('round / max(round) OVER (PARTITION BY year)', 'season_progress')},
  cast(round <= 3 AS INTEGER) AS is_season_start,
  cast(round >= max(round) OVER (PARTITION BY year) - 2 AS INTEGER) AS is_season_end FROM entries""", "entries"))
def season_progress(spark, sf):
    df = features.season_progress(R.entries(spark, sf).select("result_id", "year", "round"))
    return rounded(df.select("result_id", "season_progress", "is_season_start", "is_season_end"))


@query("lap_pct", with_roles(f"""
SELECT race_id, driver_id, lap, milliseconds, {sql6('lap / max(lap) OVER (PARTITION BY race_id) * 100', 'lap_pct')}
FROM laps""", "laps"))
def lap_pct(spark, sf):
    df = joins.attach_group_stats(materialise(R.laps(spark, sf)), "race_id", {"top": F.max("lap")}, null_safe=True)
    return df.select("race_id", "driver_id", "lap", "milliseconds", r6(F.col("lap") / F.col("top") * 100.0).alias("lap_pct"))


# --- features -------------------------------------------------------------------

@query("advanced_features", with_roles(f"""
SELECT r.result_id, r.grid - q.position AS grid_quali_gap,
  {sql6('CASE WHEN t.points > 0 THEN d.points / t.points ELSE 0 END', 'driver_team_points_ratio')},
  q.position * t.points AS quali_x_team_points, {sql6('s.round / 24.0::DOUBLE', 'season_share')},
  d.position - t.position AS rank_gap, {sql6('ln(1 + d.points)', 'log_driver_points')},
  {sql6('ln(1 + t.points)', 'log_team_points')}, q.position * r.grid AS quali_x_grid,
  cast(coalesce(c.alt > 1000, false) AS INTEGER) AS extreme_altitude
FROM results r LEFT JOIN schedule s ON r.race_id = s.race_id
LEFT JOIN qualifying q ON r.race_id = q.race_id AND r.driver_id = q.driver_id
LEFT JOIN driver_standings d ON r.race_id = d.race_id AND r.driver_id = d.driver_id
LEFT JOIN team_standings t ON r.race_id = t.race_id AND r.team_id = t.team_id
LEFT JOIN circuits c ON s.circuit_id = c.circuit_id""",
    "results", "schedule", "qualifying", "driver_standings", "team_standings", "circuits"))
def advanced_features(spark, sf):
    base = regression_rows(spark, sf)
    return rounded(features.advanced_features(base).select(
        "result_id", "grid_quali_gap", "driver_team_points_ratio", "quali_x_team_points", "season_share", "rank_gap",
        "log_driver_points", "log_team_points", "quali_x_grid", "extreme_altitude",
    ))


@query("qualifying_temporal", with_roles(f"""
SELECT r.result_id, cast(coalesce(q.position <= 3, false) AS INTEGER) AS quali_position_top3,
  cast(coalesce(q.position <= 5, false) AS INTEGER) AS quali_position_top5,
  cast(s.year - year(try_cast(d.dob AS DATE)) AS BIGINT) AS driver_age,
  {sql6('s.round / max(s.round) OVER (PARTITION BY s.year)', 'season_progress')},
  cast(coalesce(s.round <= 3, false) AS INTEGER) AS is_season_start,
  cast(coalesce(s.round >= max(s.round) OVER (PARTITION BY s.year) - 2, false) AS INTEGER) AS is_season_end,
  {', '.join(sql6(_clock_sql(f'q.{c}', False), f'{c}_ms') for c in ('q1', 'q2', 'q3'))},
  {', '.join(f'cast(q.{c} IS NOT NULL AS INTEGER) AS has_{c}' for c in ('q1', 'q2', 'q3'))}
FROM results r LEFT JOIN schedule s ON r.race_id = s.race_id
LEFT JOIN qualifying q ON r.race_id = q.race_id AND r.driver_id = q.driver_id
LEFT JOIN drivers d ON r.driver_id = d.driver_id""", "results", "schedule", "qualifying", "drivers"))
def qualifying_temporal(spark, sf):
    df = features.qualifying_temporal(materialise(classification_rows(spark, sf)))
    names = ["quali_position_top3", "quali_position_top5", "season_progress", "is_season_start", "is_season_end"]
    names += [f"{q}_ms" for q in ("q1", "q2", "q3")] + [f"has_{q}" for q in ("q1", "q2", "q3")]
    return rounded(df.select("result_id", F.col("driver_age").cast("bigint").alias("driver_age"), *names))


def _band_sql(x: str, edges, labels) -> str:
    arms = []
    for lo, hi, label in zip(edges, edges[1:], labels):
        conds = ([] if lo == float("-inf") else [f"{x} > {lo}"]) + ([] if hi == float("inf") else [f"{x} <= {hi}"])
        arms.append(f"WHEN {' AND '.join(conds)} THEN '{label}'")
    return f"CASE {' '.join(arms)} END"


@query("lap_features", with_roles(f"""
WITH b AS ({LAP_ROWS_SQL}), p AS (SELECT *, lap / max(lap) OVER (PARTITION BY race_id) AS done FROM b)
SELECT race_id, driver_id, lap, milliseconds, {_band_sql('done', *features.LAP_BANDS)} AS lap_group,
  {_band_sql('grid', *features.GRID_BANDS)} AS grid_group, lap * lap AS lap_squared,
  {_band_sql('alt', *features.ALTITUDE_BANDS)} AS altitude_cat,
  team_id::VARCHAR || '_' || circuit_id::VARCHAR AS team_circuit_id,
  {_band_sql('year', *features.YEAR_BANDS)} AS year_group,
  {sql6('lap * alt / 1000', 'lap_altitude_interaction')}, {sql6('done * 100', 'lap_pct')} FROM p""", *LAP_ROLES))
def lap_features(spark, sf):
    df = features.lap_features(materialise(lap_rows(spark, sf)))
    return rounded(df.select(
        "race_id", "driver_id", "lap", "milliseconds", "lap_group", "grid_group", "lap_squared", "altitude_cat",
        "team_circuit_id", "year_group", "lap_altitude_interaction", "lap_pct",
    ))


@query("podium_target", with_roles("""
SELECT result_id, position::DOUBLE AS position, position::DOUBLE AS position_original,
  cast(position <= 3 AS INTEGER) AS is_podium FROM entries WHERE position IS NOT NULL""", "entries"))
def podium_target(spark, sf):
    return clean.podium_target(R.entries(spark, sf)).select("result_id", "position", "position_original", "is_podium")


@query("select_features", with_roles("SELECT result_id, driver_id, year, grid FROM entries", "entries"))
def select_features(spark, sf):
    return clean.select_candidates(R.entries(spark, sf), features.LAP_CANDIDATES, also=["result_id"])


# --- encoders --------------------------------------------------------------------

def _train_entries(spark, sf):
    return split.split_temporal(
        R.entries(spark, sf).where(F.col("position").isNotNull()), "date", CUT
    )


_TRAIN = f"""t AS (SELECT result_id, driver_id, grid, position, laps, points, round,
  CASE WHEN date < DATE '{CUT}' THEN 'train' ELSE 'test' END AS split FROM entries WHERE position IS NOT NULL)"""


def _encoded(spark, sf, method, smoothing, leaf):
    df = _train_entries(spark, sf)
    train = df.where(F.col("split") == "train")
    fitted = encode.fit_target_encoding(train, "driver_id", "position", smoothing, leaf, method)
    out = encode.apply_target_encoding(df, fitted, "driver_id", encode.label_prior(train, "position"), "driver_encoded")
    return rounded(out.select("result_id", "split", "driver_encoded"))


@query("target_encode_sigmoid", with_roles(f"""
WITH {_TRAIN}, p AS (SELECT avg(position) AS prior FROM t WHERE split = 'train'),
f AS (SELECT driver_id, avg(position) AS m, 1 / (1 + exp(-(count(*) - 5.0::DOUBLE) / 2.0::DOUBLE)) AS w FROM t WHERE split = 'train' GROUP BY 1)
SELECT result_id, split, {sql6('coalesce(w * m + (1 - w) * prior, prior)', 'driver_encoded')}
FROM t CROSS JOIN p LEFT JOIN f ON t.driver_id = f.driver_id""", "entries"))
def target_encode_sigmoid(spark, sf):
    return _encoded(spark, sf, "sigmoid", 2.0, 5.0)


@query("target_encode_additive", with_roles(f"""
WITH {_TRAIN}, p AS (SELECT avg(position) AS prior FROM t WHERE split = 'train'),
f AS (SELECT driver_id, sum(position) AS s, count(*) AS n FROM t WHERE split = 'train' GROUP BY 1)
SELECT result_id, split, {sql6('coalesce((s + 3.0::DOUBLE * prior) / (n + 3.0::DOUBLE), prior)', 'driver_encoded')}
FROM t CROSS JOIN p LEFT JOIN f ON t.driver_id = f.driver_id""", "entries"))
def target_encode_additive(spark, sf):
    return _encoded(spark, sf, "additive", 3.0, 0.0)


@query("ordered_target_codes", with_roles(f"""
SELECT result_id, {sql6("""(coalesce(sum(position) OVER w, 0) + 2.0::DOUBLE * 10) / (count(position) OVER w + 2.0::DOUBLE)""", 'code')}
FROM entries WINDOW w AS (PARTITION BY driver_id ORDER BY md5(concat(result_id::VARCHAR, '42')), result_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""", "entries"))
def ordered_target_codes(spark, sf):
    df = R.entries(spark, sf).select("result_id", "driver_id", "position")
    return rounded(encode.ordered_target_codes(df, "driver_id", "position", "result_id", 10.0, 2.0).select("result_id", "code"))


@query("onehot_dropfirst", """
SELECT o_orderkey, cast(o_orderstatus = 'O' AS INTEGER) AS "o_orderstatus_O",
  cast(o_orderstatus = 'P' AS INTEGER) AS "o_orderstatus_P" FROM orders""")
def onehot_dropfirst(spark, sf):
    df = src.read_table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return encode.onehot_dropfirst(df, {"o_orderstatus": encode.fit_categories(df, "o_orderstatus")})


@query("label_encode", with_roles("""
WITH v AS (SELECT DISTINCT coalesce(q2, 'nan') AS value FROM qualifying),
c AS (SELECT value, row_number() OVER (ORDER BY value) - 1 AS code FROM v)
SELECT race_id, driver_id, code AS q2_code FROM qualifying JOIN c ON coalesce(q2, 'nan') = value""", "qualifying"))
def label_encode(spark, sf):
    df = materialise(R.qualifying(spark, sf).select("race_id", "driver_id", "q2"))
    return encode.apply_labels(df, encode.fit_labels(df, "q2"), "q2", "q2_code").drop("q2")


# --- scalers ---------------------------------------------------------------------

_SCALE_COLS = ("grid", "laps", "points")


def _scaled(spark, sf, fit):
    df = _train_entries(spark, sf).select("result_id", "split", *[F.col(c).cast("double") for c in _SCALE_COLS])
    return rounded(fit(df.where(F.col("split") == "train")).transform(df))


def _scale_sql(centre: str, width: str) -> str:
    stats = ", ".join(f"{centre.format(c)} AS m_{c}, {width.format(c)} AS s_{c}" for c in _SCALE_COLS)
    cols = ", ".join(
        sql6(f"({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END", c) for c in _SCALE_COLS)
    return with_roles(
        f"WITH {_TRAIN}, s AS (SELECT {stats} FROM t WHERE split = 'train') SELECT result_id, split, {cols} FROM t CROSS JOIN s",
        "entries")


@query("scale_standard", _scale_sql("avg({0})", "stddev_pop({0})"))
def scale_standard(spark, sf):
    return _scaled(spark, sf, lambda t: scale.fit_standard(t, _SCALE_COLS))


@query("scale_minmax", _scale_sql("min({0})", "max({0}) - min({0})"))
def scale_minmax(spark, sf):
    return _scaled(spark, sf, lambda t: scale.fit_minmax(t, _SCALE_COLS))


@query("scale_robust", _scale_sql(
    "median({0})", "quantile_cont({0}::DOUBLE, 0.75) - quantile_cont({0}::DOUBLE, 0.25)"))
def scale_robust(spark, sf):
    return _scaled(spark, sf, lambda t: scale.fit_robust(t, _SCALE_COLS))


@query("scale_dual", with_roles(f"""
WITH {_TRAIN}, s AS (SELECT min(grid) AS a, max(grid) - min(grid) AS b, avg(laps) AS m, stddev_pop(laps) AS d FROM t WHERE split = 'train')
SELECT result_id, split, {sql6('(grid - a) / b', 'grid')}, {sql6('(laps - m) / d', 'laps')}, points FROM t CROSS JOIN s""", "entries"))
def scale_dual(spark, sf):
    return _scaled(spark, sf, lambda t: scale.fit_dual(t, ["grid", "round"], ["laps", "lat"]))


# --- splits ----------------------------------------------------------------------

@query("split_hash", f"""
SELECT o_orderkey, CASE WHEN {unit_sql('o_orderkey')} < 0.2 THEN 'test' ELSE 'train' END AS split FROM orders""")
def split_hash(spark, sf):
    return split.split_hash(src.read_table(spark, sf, "orders").select("o_orderkey"), "o_orderkey")


@query("split_exact", """
SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY md5(concat(o_orderkey::VARCHAR, '42')), o_orderkey)
  <= ceil(0.2 * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split FROM orders""")
def split_exact(spark, sf):
    return split.split_exact(src.read_table(spark, sf, "orders").select("o_orderkey"), "o_orderkey")


@query("split_temporal", with_roles(f"""
SELECT result_id, CASE WHEN date < DATE '{CUT}' THEN 'train' ELSE 'test' END AS split FROM entries""", "entries"))
def split_temporal(spark, sf):
    return split.split_temporal(R.entries(spark, sf).select("result_id", "date"), "date", CUT).drop("date")


@query("fold_ids_stratified", """
SELECT event_id, label, cast((row_number() OVER (PARTITION BY label ORDER BY md5(concat(event_id::VARCHAR, '42')), event_id) - 1) % 5 AS INTEGER) AS fold
FROM (SELECT event_id, cast(event_type = 'purchase' AS INTEGER) AS label FROM events)""")
def fold_ids_stratified(spark, sf):
    df = src.read_table(spark, sf, "events").select(
        "event_id", (F.col("event_type") == "purchase").cast("int").alias("label")
    )
    return split.stratified_folds(df, "event_id", "label")


@query("learning_curve_sizes", f"""
WITH r AS (SELECT cast(floor({unit_sql('event_id', '42-fold')} * 5) AS INTEGER) AS fold,
  cast(floor({unit_sql('event_id', '42-curve')} * 10) AS INTEGER) + 1 AS step FROM events)
SELECT cast(h.i AS INTEGER) AS held_out, cast(k.i AS INTEGER) AS curve_step,
  count(*) FILTER (WHERE fold <> h.i AND step <= k.i) AS train_rows
FROM r CROSS JOIN range(0, 5) h(i) CROSS JOIN range(1, 11) k(i) GROUP BY ALL""")
def learning_curve_sizes(spark, sf):
    return split.learning_curve_sizes(src.read_table(spark, sf, "events").select("event_id"), "event_id")
