"""Oracle SQL of the preparation flows, built from the same column lists."""

from __future__ import annotations

from ..operators import features
from .features import _band_sql, _clock_sql, unit_sql
from .registry import sql6
from .roles import with_roles


def _encoded(key: str, label: str, smoothing: float, leaf: float) -> str:
    """Target encoding table of one key over the train rows of f."""
    return f"""te_{key} AS (SELECT {key} AS k, avg({label}) AS m,
  1 / (1 + exp(-(count(*) - {leaf}::DOUBLE) / {smoothing}::DOUBLE)) AS w FROM f WHERE split = 'train' GROUP BY 1)"""


def _enc_value(key: str) -> str:
    return f"coalesce(te_{key}.w * te_{key}.m + (1 - te_{key}.w) * prior, prior)"


_KEYS = ("driver_id", "team_id", "circuit_id")
_ENC_JOIN = "FROM f CROSS JOIN pr " + " ".join(f"LEFT JOIN te_{k} ON f.{k} = te_{k}.k" for k in _KEYS)


def _regression() -> str:
    plain = (
        "race_id", "grid", "year", "round", "quali_position", "driver_points", "driver_rank", "driver_wins",
        "team_points", "team_rank", "team_wins", "lat", "lng", "alt",
    )
    made = {
        "grid_quali_gap": "grid - quali_position",
        "driver_team_points_ratio": "CASE WHEN team_points > 0 THEN driver_points / team_points ELSE 0 END",
        "quali_x_team_points": "quali_position * team_points", "season_share": "round / 24.0::DOUBLE",
        "rank_gap": "driver_rank - team_rank", "log_driver_points": "ln(1 + driver_points)",
        "log_team_points": "ln(1 + team_points)", "quali_x_grid": "quali_position * grid",
        "extreme_altitude": "(alt > 1000)::INT",
    }
    hot = {f"circuit_name_{v}": f"(circuit_name = '{v}')::INT" for v in ("AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")}
    hot |= {f"circuit_location_town {i}": f"(circuit_location = 'town {i}')::INT" for i in range(1, 5)}
    hot |= {f"circuit_country_land {i}": f"(circuit_country = 'land {i}')::INT" for i in range(1, 3)}
    cols = {**{k: _enc_value(k) for k in _KEYS}, **{c: c for c in plain}, **made, **hot}
    g = ", ".join(f'coalesce(({e})::DOUBLE, 0) AS "{c}"' for c, e in cols.items())
    stats = ", ".join(f'avg("{c}") AS m{i}, stddev_pop("{c}") AS s{i}' for i, c in enumerate(cols))
    out = ", ".join(
        sql6(f'("{c}" - m{i}) / CASE WHEN s{i} = 0 THEN 1 ELSE s{i} END', f'"{c}"') for i, c in enumerate(cols)
    )
    return with_roles(f"""
WITH b AS (SELECT r.result_id AS row_id, r.position::DOUBLE AS position, r.race_id, r.driver_id, r.team_id, s.circuit_id,
  r.grid::DOUBLE AS grid, s.year, s.round, coalesce(q.position, r.grid)::DOUBLE AS qp, d.points AS driver_points,
  d.position AS driver_rank, d.wins AS driver_wins, t.points AS team_points, t.position AS team_rank, t.wins AS team_wins,
  c.name AS circuit_name, c.location AS circuit_location, c.country AS circuit_country, c.lat, c.lng, c.alt
FROM results r LEFT JOIN schedule s ON r.race_id = s.race_id
LEFT JOIN qualifying q ON r.race_id = q.race_id AND r.driver_id = q.driver_id
LEFT JOIN driver_standings d ON r.race_id = d.race_id AND r.driver_id = d.driver_id
LEFT JOIN team_standings t ON r.race_id = t.race_id AND r.team_id = t.team_id
LEFT JOIN circuits c ON s.circuit_id = c.circuit_id
WHERE s.year BETWEEN 1995 AND 2001 AND r.position BETWEEN 1 AND 30),
f AS (SELECT *, coalesce(qp, (SELECT median(qp) FROM b)) AS quali_position,
  CASE WHEN {unit_sql('row_id')} < 0.2 THEN 'test' ELSE 'train' END AS split FROM b),
pr AS (SELECT avg(position) AS prior FROM f WHERE split = 'train'),
{', '.join(_encoded(k, 'position', 10.0, 20.0) for k in _KEYS)},
g AS (SELECT row_id, position AS y, split, {', '.join(f'f.{k} AS raw_{k}' for k in _KEYS)}, {g} {_ENC_JOIN}),
st AS (SELECT {stats} FROM g WHERE split = 'train')
SELECT row_id, y AS position, split, {out} FROM g CROSS JOIN st""",
        "results", "schedule", "qualifying", "driver_standings", "team_standings", "circuits")


def _classification() -> str:
    minmax = (
        "grid", "round", "season_progress", "driver_podiums_last_5", "team_podiums_last_5", "driver_podium_rate_season",
        "team_podium_rate_season", "q1_ms", "q2_ms", "q3_ms",
    )
    standard = ("lat", "lng", "alt", "year", "driver_age")
    order = "ORDER BY date, race_id, result_id ROWS BETWEEN {} PRECEDING AND 1 PRECEDING"
    past, five = order.format("UNBOUNDED"), order.format("5")
    medians = ("driver_age", "q1_ms", "q2_ms", "q3_ms", "lat", "lng", "alt")
    filled = ", ".join(f"coalesce({c}, (SELECT median({c}) FROM h)) AS {c}" for c in medians)
    flags = ("quali_position_top3", "quali_position_top5", "is_season_start", "is_season_end", "has_q1", "has_q2", "has_q3")
    stats = ", ".join(f"min({c}) AS a_{c}, max({c}) - min({c}) AS w_{c}" for c in minmax)
    stats += ", " + ", ".join(f"avg({c}) AS a_{c}, stddev_pop({c}) AS w_{c}" for c in standard)
    scaled = ", ".join(
        sql6(f"({c} - a_{c}) / CASE WHEN w_{c} = 0 THEN 1 ELSE w_{c} END", c) for c in (*minmax, *standard))
    hot = {f"location_town {i}": f"location = 'town {i}'" for i in range(1, 5)}
    hot |= {f"country_land {i}": f"country = 'land {i}'" for i in range(1, 3)}
    hot |= {f"nationality_{v}": f"nationality = '{v}'" for v in ("BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")}
    hot |= {f"nationality_team_zone {i}": f"nationality_team = 'zone {i}'" for i in range(1, 5)}
    onehot = ", ".join(f'({e})::INT AS "{c}"' for c, e in hot.items())
    encoded = ", ".join(sql6(_enc_value(k), k) for k in _KEYS)
    return with_roles(f"""
WITH h AS (SELECT r.result_id, r.race_id, r.driver_id, r.team_id, s.circuit_id, r.date, r.grid::DOUBLE AS grid,
  (r.position <= 3)::INT AS target, s.year, s.round, coalesce(q.qualify_id, -1) AS qualify_id, q.position AS pq,
  c.lat, c.lng, c.alt, c.location, c.country, d.nationality, t.nationality AS nationality_team,
  coalesce(q.position <= 3, false)::INT AS quali_position_top3, coalesce(q.position <= 5, false)::INT AS quali_position_top5,
  (s.year - year(try_cast(d.dob AS DATE)))::DOUBLE AS driver_age,
  s.round / max(s.round) OVER (PARTITION BY s.year) AS season_progress, (s.round <= 3)::INT AS is_season_start,
  (s.round >= max(s.round) OVER (PARTITION BY s.year) - 2)::INT AS is_season_end,
  {', '.join(f"{_clock_sql(f'q.{c}', False)} AS {c}_ms, (q.{c} IS NOT NULL)::INT AS has_{c}" for c in ('q1', 'q2', 'q3'))},
  r.position
FROM results r LEFT JOIN schedule s ON r.race_id = s.race_id
LEFT JOIN qualifying q ON r.race_id = q.race_id AND r.driver_id = q.driver_id
LEFT JOIN circuits c ON s.circuit_id = c.circuit_id LEFT JOIN drivers d ON r.driver_id = d.driver_id
LEFT JOIN teams t ON r.team_id = t.team_id WHERE r.position IS NOT NULL),
w AS (SELECT *, coalesce(pq, 1 + max(pq) OVER (PARTITION BY race_id)) AS pq2,
  coalesce(sum(target) OVER (PARTITION BY driver_id {five}), 0)::DOUBLE AS driver_podiums_last_5,
  coalesce(avg(target) OVER (PARTITION BY driver_id, year {past}), 0) AS driver_podium_rate_season,
  coalesce(sum((position = 1)::INT) OVER (PARTITION BY driver_id, year {past}), 0)::DOUBLE AS driver_wins_season,
  coalesce(sum(target) OVER (PARTITION BY team_id {five}), 0)::DOUBLE AS team_podiums_last_5,
  coalesce(avg(target) OVER (PARTITION BY team_id, year {past}), 0) AS team_podium_rate_season FROM h),
f AS (SELECT * EXCLUDE ({', '.join(medians)}), {filled}, coalesce(pq2, 1 + (SELECT max(pq2) FROM w)) AS position_quali,
  CASE WHEN date < DATE '2000-01-01' THEN 'train' ELSE 'test' END AS split FROM w),
st AS (SELECT {stats} FROM f WHERE split = 'train'),
pr AS (SELECT avg(target) AS prior FROM f WHERE split = 'train'),
{', '.join(_encoded(k, 'target', 1.0, 20.0) for k in _KEYS)}
SELECT result_id AS row_id, target, split, {encoded}, qualify_id, position_quali, driver_wins_season, {', '.join(flags)},
  {scaled}, {onehot} {_ENC_JOIN} CROSS JOIN st""",
        "results", "schedule", "qualifying", "circuits", "drivers", "teams")


def _laps() -> str:
    filled = ("lap", "driver_id", "team_id", "circuit_id", "race_id", "alt", "lat", "lng", "year", "grid")
    bands = {
        "lap_group": _band_sql("done", *features.LAP_BANDS), "grid_group": _band_sql("grid", *features.GRID_BANDS),
        "altitude_cat": _band_sql("alt", *features.ALTITUDE_BANDS), "year_group": _band_sql("year", *features.YEAR_BANDS),
        "team_circuit_id": "team_id::VARCHAR || '_' || circuit_id::VARCHAR",
    }
    texts = ", ".join(f"coalesce({e}, 'nan') AS {c}" for c, e in bands.items())
    codes = ", ".join(f"dense_rank() OVER (ORDER BY {c}) - 1 AS {c}" for c in bands)
    return with_roles(f"""
WITH b AS (SELECT DISTINCT l.race_id, l.driver_id, l.lap, l.milliseconds, r.team_id, r.grid, r.position, r.year, s.circuit_id,
  k.opening_race_id, k.events, c.name, c.location, c.country, c.lat, c.lng, c.alt
FROM laps l LEFT JOIN results r ON l.race_id = r.race_id AND l.driver_id = r.driver_id
LEFT JOIN schedule s ON r.race_id = s.race_id
LEFT JOIN calendar k ON s.circuit_id = k.circuit_id AND r.year = k.year
LEFT JOIN circuits c ON s.circuit_id = c.circuit_id WHERE l.milliseconds IS NOT NULL),
v AS (SELECT milliseconds, {', '.join(f'coalesce({c}, (SELECT median({c}) FROM b))::DOUBLE AS {c}' for c in filled)} FROM b),
z AS (SELECT quantile_cont(milliseconds::DOUBLE, 0.25) AS q1, quantile_cont(milliseconds::DOUBLE, 0.75) AS q3 FROM v),
o AS (SELECT v.*, lap / max(lap) OVER (PARTITION BY race_id) AS done FROM v, z
  WHERE milliseconds BETWEEN q1 - 3 * (q3 - q1) AND q3 + 3 * (q3 - q1)),
t AS (SELECT milliseconds, lap, done, driver_id, team_id AS team, circuit_id, alt, lat, lng, year, grid, {texts} FROM o)
SELECT milliseconds, lap, {sql6('done * 100', 'lap_pct')}, lap * lap AS lap_squared, driver_id, team AS team_id, circuit_id,
  alt, lat, lng, year, grid, {sql6('lap * alt / 1000', 'lap_altitude_interaction')}, {codes} FROM t""",
        "laps", "results", "schedule", "calendar", "circuits")


REGRESSION_PREP = _regression()
CLASSIFICATION_PREP = _classification()
LAP_PREP = _laps()
