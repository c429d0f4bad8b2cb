"""Sources, projection, joins, aggregation, top-k: queries and oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as S
from ..operators import clean, entity, impute, joins, quantiles
from ..plans.defaults import CLASSIFICATION_LEAKS, REGRESSION_LEAKS, TEXT_KEPT
from ..session import materialise, scratch_folder
from ..sources import tables as src
from . import roles as R
from .registry import query, r6, rounded, sql6
from .roles import with_roles


_RAW_SQL = """SELECT result_id, race_id, driver_id,
  try_cast(nullif(nullif(nullif(grid, '\\N'), 'NULL'), '') AS BIGINT) AS grid,
  try_cast(nullif(nullif(nullif(position, '\\N'), 'NULL'), '') AS BIGINT) AS position,
  nullif(date, '') AS date, year FROM raw_results"""


@query("scan_csv_nulls", with_roles(_RAW_SQL, "raw_results"))
def scan_csv_nulls(spark, sf):
    path = scratch_folder(spark)
    raw = R.raw_results(spark, sf)
    src.write_csv(raw, path)
    schema = T.StructType(
        [T.StructField(c, T.StringType() if c == "date" else T.LongType()) for c in raw.columns]
    )
    return src.read_csv(spark, path, schema)


@query("sink_csv_roundtrip", with_roles("SELECT * FROM drivers", "drivers"))
def sink_csv_roundtrip(spark, sf):
    path = scratch_folder(spark)
    df = R.drivers(spark, sf)
    src.write_csv(df, path)
    return src.read_csv(spark, path, df.schema, markers=())


@query("null_marker_clean", with_roles("""
SELECT result_id, nullif(nullif(nullif(grid, '\\N'), 'NULL'), '') AS grid,
  nullif(nullif(nullif(position, '\\N'), 'NULL'), '') AS position FROM raw_results""", "raw_results"))
def null_marker_clean(spark, sf):
    return src.clean_markers(R.raw_results(spark, sf)).select("result_id", "grid", "position")


@query("input_check", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS rows, {n}::BIGINT AS columns, count(*) > 0 AS ok FROM {t}"
    for t, n in (
        ("region", 2), ("nation", 3), ("customer", 5), ("supplier", 4), ("part", 6), ("orders", 6), ("lineitem", 11),
        ("events", 6), ("documents", 5), ("embeddings", 3), ("pages", 3), ("benchmark", 2), ("labels", 3), ("conversations", 4),
    )))
def input_check(spark, sf):
    return src.input_report(src.load_tables(spark, sf, src.TABLES))


@query("step_row_counts", with_roles("""
SELECT 'raw' AS step, count(*) AS rows, 12::BIGINT AS columns FROM entries
UNION ALL SELECT 'era', count(*) FILTER (WHERE year BETWEEN 1996 AND 2000), 12::BIGINT FROM entries
UNION ALL SELECT 'finished', count(*) FILTER (WHERE year BETWEEN 1996 AND 2000 AND position BETWEEN 1 AND 30), 12::BIGINT
FROM entries""", "entries"))
def step_row_counts(spark, sf):
    steps = src.StepCounts()
    era = steps.watch("era", clean.keep_era(steps.watch("raw", R.entries(spark, sf)), 1996, 2000))
    materialise(steps.watch("finished", clean.keep_finishers(era)))
    return steps.report(spark)


# --- filters and projection -------------------------------------------------

@query("filter_era", with_roles("SELECT result_id, year FROM entries WHERE year BETWEEN 1996 AND 1999", "entries"))
def filter_era(spark, sf):
    return clean.keep_era(R.entries(spark, sf), 1996, 1999).select("result_id", "year")


@query("filter_valid_position", with_roles("""
SELECT result_id, try_cast(position AS DOUBLE) AS position FROM raw_results
WHERE try_cast(position AS DOUBLE) BETWEEN 1 AND 20""", "raw_results"))
def filter_valid_position(spark, sf):
    return clean.keep_finishers(R.raw_results(spark, sf), hi=20).select("result_id", "position")


@query("filter_not_null", with_roles(
    "SELECT result_id, position, grid FROM entries WHERE position IS NOT NULL AND grid IS NOT NULL", "entries"))
def filter_not_null(spark, sf):
    return clean.keep_present(R.entries(spark, sf).select("result_id", "position", "grid"), "position", "grid")


@query("drop_leakage", with_roles("""
SELECT race_id, driver_id, grid, position, date, year, round FROM entries""", "entries"))
def drop_leakage(spark, sf):
    return clean.drop_listed(R.entries(spark, sf), REGRESSION_LEAKS)


@query("drop_by_type", with_roles("""
SELECT e.race_id, e.driver_id, e.result_id, e.grid, date, e.year, e.round, nationality, dob
FROM entries e LEFT JOIN drivers d ON e.driver_id = d.driver_id""", "entries", "drivers"))
def drop_by_type(spark, sf):
    df = joins.left_join(R.entries(spark, sf), R.drivers(spark, sf), "driver_id")
    df = df.withColumn("time_x", F.lit("1:00"))
    return clean.drop_leaky_and_text(df, CLASSIFICATION_LEAKS, TEXT_KEPT)


@query("select_numeric", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def select_numeric(spark, sf):
    return clean.select_numeric(src.read_table(spark, sf, "orders"))


@query("active_entities", with_roles("""
SELECT result_id, driver_id FROM entries
WHERE driver_id IN (SELECT driver_id FROM entries GROUP BY 1 HAVING count(*) >= 12)""", "entries"))
def active_entities(spark, sf):
    return clean.keep_active(R.entries(spark, sf), "driver_id", 12).select("result_id", "driver_id")


@query("active_entities_distinct", with_roles("""
SELECT result_id, driver_id FROM entries
WHERE driver_id IN (SELECT driver_id FROM entries GROUP BY 1 HAVING count(DISTINCT race_id) >= 13)""", "entries"))
def active_entities_distinct(spark, sf):
    return clean.keep_active(R.entries(spark, sf), "driver_id", 13, "race_id").select("result_id", "driver_id")


@query("case_examples", with_roles("""
SELECT outcome, event_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY outcome ORDER BY event_id) AS rn FROM (
    SELECT event_id, score, CASE WHEN label <> pred THEN 'error' WHEN label = 1 THEN 'true positive'
      ELSE 'true negative' END AS outcome FROM scored)) WHERE rn = 1""", "scored"))
def case_examples(spark, sf):
    outcome = (
        F.when(F.col("label") != F.col("pred"), "error")
        .when(F.col("label") == 1, "true positive").otherwise("true negative")
    )
    df = R.scored(spark, sf).withColumn("outcome", outcome)
    first = F.min_by(F.struct("event_id", "score"), F.col("event_id"))
    return df.groupBy("outcome").agg(first.alias("r")).select("outcome", "r.*")


@query("score_defaults", with_roles("""
SELECT e.result_id, coalesce(e.grid, q.position, 10) AS grid, coalesce(q.position, 12) AS quali_position,
  0.0::DOUBLE AS driver_points FROM entries e
LEFT JOIN qualifying q ON e.race_id = q.race_id AND e.driver_id = q.driver_id""", "entries", "qualifying"))
def score_defaults(spark, sf):
    df = joins.left_join(
        R.entries(spark, sf), R.qualifying(spark, sf), ["race_id", "driver_id"], {"position": "quali_position"}
    ).select("result_id", "grid", "quali_position")
    return clean.with_defaults(
        df, {"grid": "quali_position"}, {"grid": 10, "quali_position": 12, "driver_points": 0.0}
    )


@query("align_columns", with_roles("""
SELECT grid, 0 AS unseen_flag, laps, 0 AS circuit_x FROM entries""", "entries"))
def align_columns(spark, sf):
    return clean.align_columns(R.entries(spark, sf), ["grid", "unseen_flag", "laps", "circuit_x"])


# --- joins ------------------------------------------------------------------

@query("assemble_regression", with_roles("""
SELECT r.result_id, r.race_id, r.driver_id, r.team_id, r.grid, r.position, r.laps, s.year, s.round, s.circuit_id,
  q.position AS quali_position, d.points AS driver_points, d.position AS driver_rank, d.wins AS driver_wins,
  t.points AS team_points, t.position AS team_rank, t.wins AS team_wins,
  c.name AS circuit_name, c.location AS circuit_location, c.country AS circuit_country, c.lat, c.lng, c.alt
FROM results r LEFT JOIN schedule s ON r.race_id = s.race_id
LEFT JOIN qualifying q ON r.race_id = q.race_id AND r.driver_id = q.driver_id
LEFT JOIN driver_standings d ON r.race_id = d.race_id AND r.driver_id = d.driver_id
LEFT JOIN team_standings t ON r.race_id = t.race_id AND r.team_id = t.team_id
LEFT JOIN circuits c ON s.circuit_id = c.circuit_id""",
    "results", "schedule", "qualifying", "driver_standings", "team_standings", "circuits"))
def assemble_regression(spark, sf):
    return regression_rows(spark, sf)


def regression_rows(spark, sf):
    facts = R.results(spark, sf).select("result_id", "race_id", "driver_id", "team_id", "grid", "position", "laps")
    return joins.assemble_regression(
        facts, R.schedule(spark, sf), R.qualifying(spark, sf), R.driver_standings(spark, sf),
        R.team_standings(spark, sf), R.circuits(spark, sf),
    )


def classification_rows(spark, sf):
    facts = R.results(spark, sf).drop("date", "year", "round")
    return joins.assemble_classification(
        facts, R.schedule(spark, sf), R.qualifying(spark, sf), R.circuits(spark, sf), R.drivers(spark, sf),
        R.teams(spark, sf),
    )


@query("assemble_classification", with_roles("""
SELECT r.result_id, r.race_id, r.driver_id, r.grid, r.position, r.position_order, r.points, r.laps, r.status_id,
  r.team_id, s.year, s.round, s.circuit_id, s.name, s.date, q.qualify_id, q.position AS position_quali,
  q.q1, q.q2, q.q3, c.name AS name_circuit, c.location, c.country, c.lat, c.lng, c.alt,
  d.driver_ref, d.nationality, d.dob, t.name AS name_team, t.nationality AS nationality_team
FROM results r LEFT JOIN schedule s ON r.race_id = s.race_id
LEFT JOIN qualifying q ON r.race_id = q.race_id AND r.driver_id = q.driver_id
LEFT JOIN circuits c ON s.circuit_id = c.circuit_id LEFT JOIN drivers d ON r.driver_id = d.driver_id
LEFT JOIN teams t ON r.team_id = t.team_id""",
    "results", "schedule", "qualifying", "circuits", "drivers", "teams"))
def assemble_classification(spark, sf):
    return classification_rows(spark, sf)


def lap_rows(spark, sf):
    facts = joins.left_join(
        R.results(spark, sf).select("race_id", "driver_id", "team_id", "grid", "position", "laps", "year"),
        R.schedule(spark, sf), "race_id", ["circuit_id"],
    )
    return joins.assemble_laps(R.laps(spark, sf), facts, R.calendar(spark, sf), R.circuits(spark, sf))


LAP_ROWS_SQL = """
SELECT l.race_id, l.driver_id, l.lap, l.milliseconds, r.team_id, r.grid, r.position, r.laps, r.year, s.circuit_id,
  k.opening_race_id, k.events, c.name, c.location, c.country, c.lat, c.lng, c.alt
FROM laps l LEFT JOIN results r ON l.race_id = r.race_id AND l.driver_id = r.driver_id
LEFT JOIN schedule s ON r.race_id = s.race_id
LEFT JOIN calendar k ON s.circuit_id = k.circuit_id AND r.year = k.year
LEFT JOIN circuits c ON s.circuit_id = c.circuit_id"""
LAP_ROLES = ("laps", "results", "schedule", "calendar", "circuits")


@query("assemble_laps", with_roles(LAP_ROWS_SQL, *LAP_ROLES))
def assemble_laps(spark, sf):
    return lap_rows(spark, sf)


@query("left_join_unique", """
SELECT o_orderkey, l.l_partkey, l.l_quantity FROM orders LEFT JOIN (
  SELECT l_orderkey, l_partkey, l_quantity, row_number() OVER (PARTITION BY l_orderkey
    ORDER BY l_extendedprice DESC, l_partkey, l_suppkey, l_shipdate, l_linenumber) AS rn FROM lineitem) l
ON o_orderkey = l_orderkey AND rn = 1""")
def left_join_unique(spark, sf):
    orders = src.read_table(spark, sf, "orders").select(F.col("o_orderkey"))
    lines = src.read_table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    order = [-F.col("l_extendedprice"), "l_partkey", "l_suppkey", "l_shipdate", "l_linenumber"]
    return joins.left_join_unique(orders, lines, "o_orderkey", order, ["l_partkey", "l_quantity"])


@query("duplicate_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def duplicate_keys(spark, sf):
    return joins.duplicate_keys(src.read_table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("null_safe_join", with_roles("""
SELECT e.result_id, e.grid, g.entries FROM entries e
LEFT JOIN (SELECT grid, count(*) AS entries FROM entries GROUP BY 1) g ON e.grid IS NOT DISTINCT FROM g.grid""", "entries"))
def null_safe_join(spark, sf):
    e = R.entries(spark, sf).select("result_id", "grid")
    sizes = e.groupBy("grid").agg(F.count(F.lit(1)).alias("entries"))
    return joins.left_join(e, sizes, "grid", null_safe=True)


# --- aggregates -------------------------------------------------------------

_GRID = "coalesce(try_cast(grid AS DOUBLE), 20)"
_CAREER = f"""count(race_id) AS total_races, avg({_GRID}) AS avg_grid, avg(position_order) AS avg_finish,
  count(*) FILTER (WHERE position_order = 1) AS wins, count(*) FILTER (WHERE position_order <= 3) AS podiums,
  count(*) FILTER (WHERE position_order <= 10) AS top10, count(*) FILTER (WHERE position IS NULL) AS dnfs,
  coalesce(avg({_GRID} - position) FILTER (WHERE position IS NOT NULL), 0) AS avg_positions_gained"""

DRIVER_FEATURES_SQL = f"""
SELECT a.driver_id, total_races, {sql6('avg_grid', 'avg_grid')}, {sql6('avg_finish', 'avg_finish')}, wins, podiums,
  top10, dnfs, {sql6('avg_positions_gained', 'avg_positions_gained')}, {sql6('wins / total_races', 'win_rate')},
  {sql6('podiums / total_races', 'podium_rate')}, {sql6('top10 / total_races', 'top10_rate')},
  {sql6('dnfs / total_races', 'dnf_rate')}, driver_ref, nationality
FROM (SELECT driver_id, {_CAREER} FROM entries GROUP BY 1 HAVING count(*) >= 12) a
LEFT JOIN drivers d ON a.driver_id = d.driver_id"""


@query("driver_features", with_roles(DRIVER_FEATURES_SQL, "entries", "drivers"))
def driver_features(spark, sf):
    return rounded(entity.driver_features(R.entries(spark, sf), R.drivers(spark, sf), 12))


@query("driver_features_ext", with_roles(f"""
SELECT a.driver_id, total_races, {sql6('avg_grid', 'avg_grid')}, {sql6('avg_finish', 'avg_finish')}, wins, podiums,
  top10, dnfs, {sql6('avg_positions_gained', 'avg_positions_gained')}, total_points, {sql6('avg_points', 'avg_points')},
  total_laps, {sql6('consistency_score', 'consistency_score')}, {sql6('wins / total_races', 'win_rate')},
  {sql6('total_points / total_races', 'points_per_race')}, {sql6('podiums / total_races * 100', 'podium_rate')},
  {sql6('top10 / total_races * 100', 'top10_rate')}, {sql6('dnfs / total_races * 100', 'dnf_rate')},
  main_partner, {sql6('avg_quali_position', 'avg_quali_position')}, driver_ref, nationality
FROM (SELECT driver_id, {_CAREER}, sum(points) AS total_points, avg(points) AS avg_points,
        cast(sum(laps) AS DOUBLE) AS total_laps, coalesce(stddev_samp(position_order), 0) AS consistency_score
      FROM results GROUP BY 1 HAVING count(*) >= 12) a
LEFT JOIN (SELECT driver_id, arg_min(team_id, -n * 1000 + team_id) AS main_partner FROM
   (SELECT driver_id, team_id, count(*) AS n FROM results GROUP BY 1, 2) GROUP BY 1) m ON a.driver_id = m.driver_id
LEFT JOIN (SELECT driver_id, avg(position) AS avg_quali_position FROM qualifying GROUP BY 1) q ON a.driver_id = q.driver_id
LEFT JOIN drivers d ON a.driver_id = d.driver_id""", "results", "drivers", "qualifying"))
def driver_features_ext(spark, sf):
    facts = materialise(R.results(spark, sf))
    return rounded(entity.driver_features_ext(facts, R.drivers(spark, sf), R.qualifying(spark, sf), 12))


@query("driver_features_legacy", with_roles(f"""
SELECT a.driver_id, {sql6('avg_position', 'avg_position')}, {sql6('std_position', 'std_position')},
  {sql6('avg_grid', 'avg_grid')}, {sql6('avg_points', 'avg_points')}, total_points, career_races, total_podiums,
  total_top10, total_laps, total_dnf, {sql6('total_points / career_races', 'points_per_race')},
  {sql6('total_podiums / career_races * 100', 'podium_rate')}, {sql6('total_top10 / career_races * 100', 'top10_rate')},
  {sql6('total_dnf / career_races * 100', 'dnf_rate')}, {sql6('coalesce(std_position, 0)', 'consistency_score')},
  main_partner, {sql6('avg_quali_position', 'avg_quali_position')}, driver_ref, nationality
FROM (SELECT driver_id, avg(position) AS avg_position, stddev_samp(position) AS std_position, avg(grid) AS avg_grid,
        avg(points) AS avg_points, sum(points) AS total_points, count(race_id) AS career_races,
        count(*) FILTER (WHERE position <= 3) AS total_podiums, count(*) FILTER (WHERE position <= 10) AS total_top10,
        cast(sum(laps) AS DOUBLE) AS total_laps, count(*) FILTER (WHERE position IS NULL) AS total_dnf
      FROM results GROUP BY 1 HAVING count(race_id) >= 10) a
LEFT JOIN (SELECT driver_id, arg_min(team_id, -n * 1000 + team_id) AS main_partner FROM
   (SELECT driver_id, team_id, count(*) AS n FROM results GROUP BY 1, 2) GROUP BY 1) m ON a.driver_id = m.driver_id
LEFT JOIN (SELECT driver_id, avg(position) AS avg_quali_position FROM qualifying GROUP BY 1) q ON a.driver_id = q.driver_id
LEFT JOIN drivers d ON a.driver_id = d.driver_id""", "results", "drivers", "qualifying"))
def driver_features_legacy(spark, sf):
    return rounded(
        entity.driver_features_legacy(materialise(R.results(spark, sf)), R.drivers(spark, sf), R.qualifying(spark, sf), 10)
    )


@query("constructor_features", with_roles(f"""
SELECT a.team_id, total_entries, races_participated, total_points, wins, podiums, top10, dnfs,
  {sql6('avg_grid', 'avg_grid')}, {sql6('total_points / races_participated', 'avg_points_per_race')},
  {sql6('wins / races_participated', 'win_rate')}, {sql6('podiums / races_participated', 'podium_rate')},
  {sql6('dnfs / total_entries', 'dnf_rate')}, {sql6('top10 / total_entries', 'scoring_consistency')},
  t.name AS team_ref, t.nationality
FROM (SELECT team_id, count(race_id) AS total_entries, count(DISTINCT race_id) AS races_participated,
        sum(points) AS total_points, count(*) FILTER (WHERE position_order = 1) AS wins,
        count(*) FILTER (WHERE position_order <= 3) AS podiums, count(*) FILTER (WHERE position_order <= 10) AS top10,
        count(*) FILTER (WHERE position IS NULL) AS dnfs, avg({_GRID}) AS avg_grid
      FROM results WHERE team_id IS NOT NULL GROUP BY 1 HAVING count(DISTINCT race_id) >= 30) a
LEFT JOIN teams t ON a.team_id = t.team_id""", "results", "teams"))
def constructor_features(spark, sf):
    return rounded(entity.constructor_features(R.results(spark, sf), R.teams(spark, sf), 30))


@query("consistency_score", with_roles(f"""
SELECT driver_id, {sql6('coalesce(stddev_samp(position_order), 0)', 'consistency_score')}
FROM entries GROUP BY 1""", "entries"))
def consistency_score(spark, sf):
    return R.entries(spark, sf).groupBy("driver_id").agg(
        r6(F.coalesce(F.stddev_samp("position_order"), F.lit(0.0))).alias("consistency_score")
    )


@query("main_partner", """
SELECT l_orderkey, arg_min(l_suppkey, -n * 1000000 + l_suppkey) AS main_partner FROM
  (SELECT l_orderkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY 1, 2) GROUP BY 1""")
def main_partner(spark, sf):
    return entity.main_partner(src.read_table(spark, sf, "lineitem"), "l_orderkey", "l_suppkey")


@query("avg_side_metric", with_roles(f"""
SELECT driver_id, {sql6('avg(position)', 'avg_quali_position')} FROM qualifying GROUP BY 1""", "qualifying"))
def avg_side_metric(spark, sf):
    return rounded(entity.avg_side_metric(R.qualifying(spark, sf), "driver_id", "position", "avg_quali_position"))


@query("value_counts", f"""
SELECT o_orderstatus, o_orderpriority, count(*) AS rows,
  {sql6('count(*) / sum(count(*)) OVER ()', 'share')} FROM orders GROUP BY 1, 2""")
def value_counts(spark, sf):
    return rounded(entity.value_counts(src.read_table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority"))


@query("class_balance", with_roles(f"""
SELECT split, is_podium, count(*) AS rows,
  {sql6('count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY split)', 'percent')}
FROM (SELECT CASE WHEN date < DATE '2000-01-01' THEN 'train' ELSE 'test' END AS split,
        cast(position <= 3 AS INTEGER) AS is_podium FROM entries WHERE position IS NOT NULL) GROUP BY 1, 2""", "entries"))
def class_balance(spark, sf):
    df = clean.podium_target(R.entries(spark, sf))
    df = df.withColumn("split", F.when(F.col("date") < F.lit("2000-01-01").cast("date"), "train").otherwise("test"))
    return rounded(entity.class_balance(df, "split", "is_podium"))


_LINEITEM = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
)


@query("distinct_rows", "SELECT DISTINCT * REPLACE (l_shipdate::DATE AS l_shipdate) FROM lineitem")
def distinct_rows(spark, sf):
    rows = src.read_table(spark, sf, "lineitem")
    return rows.withColumn("l_shipdate", F.to_date("l_shipdate")).dropDuplicates()


@query("duplicate_count", """
SELECT cast(sum(n) AS BIGINT) AS rows, count(*) AS distinct_rows, cast(sum(n - 1) AS BIGINT) AS duplicates
FROM (SELECT count(*) AS n FROM lineitem GROUP BY %s)""" % ", ".join(_LINEITEM))
def duplicate_count(spark, sf):
    return entity.duplicate_count(src.read_table(spark, sf, "lineitem"))


@query("distinct_counts", """
SELECT 'o_custkey' AS column_name, count(DISTINCT o_custkey) AS distinct_values FROM orders
UNION ALL SELECT 'o_orderdate', count(DISTINCT o_orderdate) FROM orders
UNION ALL SELECT 'o_orderstatus', count(DISTINCT o_orderstatus) FROM orders""")
def distinct_counts(spark, sf):
    return entity.distinct_counts(
        src.read_table(spark, sf, "orders"), ["o_custkey", "o_orderdate", "o_orderstatus"]
    )


@query("global_stats", f"""
SELECT max(o_totalprice) AS max_value, min(o_totalprice) AS min_value, {sql6('avg(o_totalprice)', 'mean_value')},
  {sql6('median(o_totalprice)', 'median_value')} FROM orders""")
def global_stats(spark, sf):
    return rounded(
        entity.global_stats(src.read_table(spark, sf, "orders"), "o_totalprice"), ("max_value", "min_value")
    )


@query("quantiles", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {sql6(f'quantile_cont({c}, 0.1)', 'p10')}, {sql6(f'quantile_cont({c}, 0.25)', 'p25')}, "
    f"{sql6(f'quantile_cont({c}, 0.5)', 'p50')}, {sql6(f'quantile_cont({c}, 0.75)', 'p75')}, "
    f"{sql6(f'quantile_cont({c}, 0.9)', 'p90')} FROM lineitem" for c in ("l_extendedprice", "l_quantity")))
def quantile_rows(spark, sf):
    long = quantiles.unpivot(src.read_table(spark, sf, "lineitem"), ["l_extendedprice", "l_quantity"])
    q = quantiles.group_quantiles(long, "name", "value", [0.1, 0.25, 0.5, 0.75, 0.9])
    return rounded(q.withColumnRenamed("name", "column_name"))


@query("group_p90", f"""
SELECT event_type, {sql6('quantile_cont(value, 0.9)', 'p90')} FROM events GROUP BY 1""")
def group_p90(spark, sf):
    return rounded(quantiles.group_quantiles(src.read_table(spark, sf, "events"), "event_type", "value", [0.9]))


@query("date_span", f"""
SELECT cast(min(o_orderdate) AS DATE) AS first_day, cast(max(o_orderdate) AS DATE) AS last_day,
  {sql6("date_diff('day', cast(min(o_orderdate) AS DATE), cast(max(o_orderdate) AS DATE)) / 365.25::DOUBLE", 'years')}
FROM orders""")
def date_span(spark, sf):
    return rounded(entity.date_span(R.entries(spark, sf), "date"))


# --- order and top-k ---------------------------------------------------------

@query("sort_chronological", with_roles("SELECT date, race_id, result_id FROM entries ORDER BY ALL", "entries"))
def sort_chronological(spark, sf):
    return clean.chronological(R.entries(spark, sf).select("date", "race_id", "result_id"))


@query("topk", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 15")
def topk(spark, sf):
    df = src.read_table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return entity.top_k(df, 15, F.desc("o_totalprice"), F.asc("o_orderkey"))


@query("extreme_rows", """
(SELECT 'smallest' AS side, event_id, value FROM events ORDER BY value, event_id LIMIT 5)
UNION ALL (SELECT 'largest', event_id, value FROM events ORDER BY value DESC, event_id LIMIT 5)""")
def extreme_rows(spark, sf):
    df = src.read_table(spark, sf, "events").select("event_id", "value")
    low = entity.top_k(df, 5, F.asc("value"), F.asc("event_id")).withColumn("side", F.lit("smallest"))
    high = entity.top_k(df, 5, F.desc("value"), F.asc("event_id")).withColumn("side", F.lit("largest"))
    return low.unionByName(high)


@query("topk_per_group", """
SELECT * FROM (SELECT event_type, event_id, value,
  cast(row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS INTEGER) AS rank FROM events)
WHERE rank <= 5""")
def topk_per_group(spark, sf):
    df = src.read_table(spark, sf, "events").select("event_type", "event_id", "value")
    return entity.top_k_per_group(df, "event_type", 5, F.desc("value"), F.asc("event_id"))


@query("seeded_sample", """
SELECT event_id, event_type FROM events ORDER BY md5(concat(event_id::VARCHAR, '42')), event_id LIMIT 15""")
def seeded_sample(spark, sf):
    return entity.seeded_sample(src.read_table(spark, sf, "events"), "event_id", 15).select("event_id", "event_type")


@query("sample_share", """
SELECT event_id, event_type FROM events
QUALIFY row_number() OVER (ORDER BY md5(concat(event_id::VARCHAR, 'baseline')), event_id) <= ceil(0.2 * (SELECT count(*) FROM events))""")
def sample_share(spark, sf):
    from ..operators.split import sample_share as take

    return take(src.read_table(spark, sf, "events"), "event_id", 0.2, "baseline").select("event_id", "event_type")


# --- imputation ---------------------------------------------------------------

_QUALI_JOIN = "entries e LEFT JOIN qualifying q ON e.race_id = q.race_id AND e.driver_id = q.driver_id"


def entry_quali(spark, sf):
    return joins.left_join(
        R.entries(spark, sf), R.qualifying(spark, sf), ["race_id", "driver_id"],
        {"position": "quali_position", "qualify_id": "qualify_id", "q1": "q1", "q2": "q2", "q3": "q3"},
    )


# Fits and group statistics read their input more than once, so a joined input is written first.


@query("impute_proxy_median", with_roles(f"""
WITH f AS (SELECT result_id, coalesce(q.position, e.grid)::DOUBLE AS v FROM {_QUALI_JOIN})
SELECT result_id, coalesce(v, (SELECT median(v) FROM f)) AS quali_position FROM f""", "entries", "qualifying"))
def impute_proxy_median(spark, sf):
    df = materialise(entry_quali(spark, sf).select("result_id", "grid", "quali_position"))
    return impute.fill_proxy_then_median(df, "quali_position", "grid").select("result_id", "quali_position")


@query("impute_group_max_plus1", with_roles(f"""
WITH f AS (SELECT result_id, coalesce(q.position, 1 + max(q.position) OVER (PARTITION BY e.race_id)) AS v FROM {_QUALI_JOIN})
SELECT result_id, coalesce(v, 1 + (SELECT max(v) FROM f)) AS quali_position FROM f""", "entries", "qualifying"))
def impute_group_max_plus1(spark, sf):
    df = materialise(entry_quali(spark, sf).select("result_id", "race_id", "quali_position"))
    return impute.fill_group_max_plus1(df, "quali_position", "race_id").select("result_id", "quali_position")


@query("impute_constant", with_roles(f"""
SELECT result_id, coalesce(e.grid, 20) AS grid, coalesce(q.qualify_id, -1) AS qualify_id, coalesce(e.points, 0) AS points
FROM {_QUALI_JOIN}""", "entries", "qualifying"))
def impute_constant(spark, sf):
    df = entry_quali(spark, sf).select("result_id", "grid", "qualify_id", "points")
    return impute.fill_constant(df, {"grid": 20, "qualify_id": -1, "points": 0.0, "absent": 0})


@query("impute_median", with_roles("""
WITH f AS (SELECT result_id, grid::DOUBLE AS grid, position::DOUBLE AS position, try_cast(dob AS TIMESTAMP) AS dob
  FROM entries e LEFT JOIN drivers d ON e.driver_id = d.driver_id)
SELECT result_id, coalesce(grid, (SELECT median(grid) FROM f)) AS grid,
  coalesce(position, (SELECT median(position) FROM f)) AS position,
  coalesce(dob, make_timestamp((SELECT cast(floor(median(epoch_us(dob))) AS BIGINT) FROM f))) AS dob FROM f""",
    "entries", "drivers"))
def impute_median(spark, sf):
    df = materialise(joins.left_join(
        R.entries(spark, sf).select("result_id", "driver_id", "grid", "position"), R.drivers(spark, sf), "driver_id",
        ["dob"],
    ).withColumn("dob", S.to_moment("dob")))
    return impute.fill_median(df, ["grid", "position", "dob"]).drop("driver_id")


@query("impute_unknown", with_roles(f"""
SELECT result_id, coalesce(q.q2, 'Unknown') AS q2, coalesce(q.q3, 'Unknown') AS q3, q.position FROM {_QUALI_JOIN}""",
    "entries", "qualifying"))
def impute_unknown(spark, sf):
    df = entry_quali(spark, sf).select("result_id", "q2", "q3", F.col("quali_position").alias("position"))
    return impute.fill_unknown(df)
