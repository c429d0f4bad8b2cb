"""Racing roles played by the test tables.

Orders are entries (one row per competitor and event), customers are drivers,
their nations are teams, regions are circuits, and lineitems give qualifying
sessions and laps. Every view exists twice: as a DataFrame and as SQL text for
the oracle, with the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table

i64 = "bigint"


def _day_number(ts) -> F.Column:
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast(i64)


def _entry_columns() -> list:
    order = F.col("o_orderdate")
    finish = 1 + F.floor("o_totalprice") % 24
    return [
        F.col("o_orderkey").alias("result_id"),
        _day_number(order).alias("race_id"),
        F.col("o_custkey").alias("driver_id"),
        F.when(F.col("o_orderkey") % 37 != 5, 1 + (F.col("o_orderkey") * 7) % 24).alias("grid"),
        F.when(F.col("o_orderstatus") != "P", finish).alias("position"),
        finish.alias("position_order"),
        F.greatest(11 - finish, F.lit(0)).cast("double").alias("points"),
        (40 + F.col("o_orderkey") % 31).alias("laps"),
        (F.col("o_orderkey") % 9).alias("status_id"),
        order.cast("date").alias("date"),
        F.year(order).cast(i64).alias("year"),
        F.month(order).cast(i64).alias("round"),
    ]


def entries(spark: SparkSession, sf: str) -> DataFrame:
    """Entry rows without their team."""
    return read_table(spark, sf, "orders").select(*_entry_columns())


def results(spark: SparkSession, sf: str) -> DataFrame:
    """Entry rows with the team of the driver."""
    team = read_table(spark, sf, "customer").select(
        F.col("c_custkey").alias("driver_id"), F.col("c_nationkey").cast(i64).alias("team_id")
    )
    return entries(spark, sf).join(team, "driver_id", "left")


def raw_results(spark: SparkSession, sf: str) -> DataFrame:
    """Entry rows as a raw file has them: numbers as text with null markers."""
    marker = F.when(F.col("result_id") % 3 == 0, F.lit("\\N")).when(
        F.col("result_id") % 3 == 1, F.lit("NULL")
    ).otherwise(F.lit(""))
    return entries(spark, sf).select(
        "result_id", "race_id", "driver_id",
        F.coalesce(F.col("grid").cast("string"), marker).alias("grid"),
        F.coalesce(F.col("position").cast("string"), marker).alias("position"),
        F.when(F.col("result_id") % 41 == 0, F.lit("not a day"))
        .otherwise(F.date_format("date", "yyyy-MM-dd")).alias("date"),
        "year",
    )


def schedule(spark: SparkSession, sf: str) -> DataFrame:
    """One row per event."""
    day = F.col("o_orderdate").cast("date")
    return (
        read_table(spark, sf, "orders")
        .select(day.alias("day")).distinct()
        .select(
            _day_number(F.col("day")).alias("race_id"),
            F.year("day").cast(i64).alias("year"),
            F.month("day").cast(i64).alias("round"),
            (F.dayofmonth("day") % 5).cast(i64).alias("circuit_id"),
            F.concat(F.lit("GP "), F.month("day").cast("string")).alias("name"),
            F.date_format("day", "yyyy-MM-dd").alias("date"),
        )
    )


def calendar(spark: SparkSession, sf: str) -> DataFrame:
    """One row per circuit and year."""
    return schedule(spark, sf).groupBy("circuit_id", "year").agg(
        F.min("race_id").alias("opening_race_id"), F.count(F.lit(1)).alias("events")
    )


def circuits(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("r_regionkey")
    return read_table(spark, sf, "region").select(
        key.cast(i64).alias("circuit_id"),
        F.col("r_name").alias("name"),
        F.concat(F.lit("town "), key.cast("string")).alias("location"),
        F.concat(F.lit("land "), (key % 3).cast("string")).alias("country"),
        F.when(key != 2, key * 10.0 - 20.0).alias("lat"),
        F.when(key != 2, key * 30.0 - 60.0).alias("lng"),
        F.when(key != 2, key * 400.0).alias("alt"),
    )


def drivers(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey")
    return read_table(spark, sf, "customer").select(
        key.alias("driver_id"),
        F.col("c_name").alias("driver_ref"),
        F.col("c_mktsegment").alias("nationality"),
        F.when(key % 19 == 7, F.lit("\\N")).otherwise(
            F.concat((1960 + key % 40).cast("string"), F.lit("-0"), (1 + key % 9).cast("string"), F.lit("-15"))
        ).alias("dob"),
    )


def teams(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "nation").select(
        F.col("n_nationkey").cast(i64).alias("team_id"),
        F.col("n_name").alias("name"),
        F.concat(F.lit("zone "), F.col("n_regionkey").cast("string")).alias("nationality"),
    )


def _clock(ms) -> F.Column:
    part = lambda v, n: F.lpad(v.cast("string"), n, "0")
    whole = F.floor(ms / 60000)
    return F.concat(
        whole.cast("string"), F.lit(":"), part(F.floor((ms % 60000) / 1000), 2), F.lit("."), part(ms % 1000, 3)
    )


def qualifying(spark: SparkSession, sf: str) -> DataFrame:
    """One row per driver and event, with session times as text."""
    lines = read_table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice")
    owner = read_table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), _day_number(F.col("o_orderdate")).alias("race_id"),
        F.col("o_custkey").alias("driver_id"),
    )
    agg = lines.join(owner, "l_orderkey").groupBy("race_id", "driver_id").agg(
        F.sum("l_quantity").cast(i64).alias("load"), F.floor(F.min("l_extendedprice")).alias("pace"),
        F.min("l_orderkey").alias("qualify_id"),
    )
    pos = 1 + F.col("load") % 24
    ms = 60000 + F.col("pace") % 40000
    q1 = (
        F.when(F.col("driver_id") % 11 == 3, F.lit("\\N"))
        .when(F.col("driver_id") % 13 == 4, (F.col("load") + 60).cast("string"))
        .when(F.col("driver_id") % 17 == 6, F.lit("no time"))
        .otherwise(_clock(ms))
    )
    return agg.select(
        "race_id", "driver_id", "qualify_id", pos.alias("position"), q1.alias("q1"),
        F.when(pos <= 15, _clock(ms - 500)).alias("q2"),
        F.when(pos <= 10, _clock(ms - 900)).alias("q3"),
    )


def driver_standings(spark: SparkSession, sf: str) -> DataFrame:
    return entries(spark, sf).groupBy("race_id", "driver_id").agg(
        F.sum(F.col("points") + F.col("round")).alias("points"),
        F.min(1 + (F.col("result_id") * 5) % 24).alias("position"),
        F.count_if(F.col("position_order") == 1).alias("wins"),
    )


def team_standings(spark: SparkSession, sf: str) -> DataFrame:
    return results(spark, sf).groupBy("race_id", "team_id").agg(
        F.sum(F.col("points")).alias("points"),
        F.min(1 + (F.col("result_id") * 3) % 12).alias("position"),
        F.count_if(F.col("position_order") == 1).alias("wins"),
    )


def laps(spark: SparkSession, sf: str) -> DataFrame:
    """Lap rows: one per lineitem, with the entry's event and driver."""
    lines = read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    owner = read_table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), _day_number(F.col("o_orderdate")).alias("race_id"),
        F.col("o_custkey").alias("driver_id"),
    )
    return lines.join(owner, "l_orderkey", "left").select(
        "race_id", "driver_id", F.col("l_linenumber").cast(i64).alias("lap"),
        F.floor("l_extendedprice").alias("milliseconds"),
    )


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Embedding rows as double vectors with a given cluster."""
    return read_table(spark, sf, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("vec"),
        F.col("label").cast(i64).alias("cluster"),
    )


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """Binary label, score in [0, 1] with many ties, and 0/1 prediction, from events."""
    score = F.round(F.col("value") / (F.col("value") + 10.0), 2)
    return read_table(spark, sf, "events").select(
        "event_id", F.col("event_type").isin("purchase", "signup").cast(i64).alias("label"),
        score.alias("score"), (score >= 0.6).cast(i64).alias("pred"),
    )


def predicted(spark: SparkSession, sf: str) -> DataFrame:
    """Real and predicted finish of the classified entries."""
    e = entries(spark, sf).where(F.col("position").isNotNull())
    return e.select(
        "result_id", F.col("position").cast("double").alias("y"),
        (F.col("position") * 0.5 + F.coalesce(F.col("grid"), F.lit(20)) * 0.25 + 3.0).alias("pred"),
    )


_DAY = "(year({0}) * 10000 + month({0}) * 100 + day({0}))"
_CLOCK = (
    "concat(cast(({0}) // 60000 AS VARCHAR), ':', lpad(cast((({0}) % 60000) // 1000 AS VARCHAR), 2, '0'),"
    " '.', lpad(cast(({0}) % 1000 AS VARCHAR), 3, '0'))"
)

ROLE_SQL: dict[str, str] = {
    "entries": f"""
SELECT o_orderkey AS result_id, {_DAY.format('o_orderdate')} AS race_id, o_custkey AS driver_id,
  CASE WHEN o_orderkey % 37 <> 5 THEN 1 + (o_orderkey * 7) % 24 END AS grid,
  CASE WHEN o_orderstatus <> 'P' THEN 1 + cast(floor(o_totalprice) AS BIGINT) % 24 END AS position,
  1 + cast(floor(o_totalprice) AS BIGINT) % 24 AS position_order,
  cast(greatest(10 - cast(floor(o_totalprice) AS BIGINT) % 24, 0) AS DOUBLE) AS points,
  40 + o_orderkey % 31 AS laps, o_orderkey % 9 AS status_id, cast(o_orderdate AS DATE) AS date,
  year(o_orderdate) AS year, month(o_orderdate) AS round
FROM orders""",
    "results": """
SELECT e.*, cast(c_nationkey AS BIGINT) AS team_id
FROM entries e LEFT JOIN customer ON driver_id = c_custkey""",
    "raw_results": """
SELECT result_id, race_id, driver_id,
  coalesce(cast(grid AS VARCHAR), CASE result_id % 3 WHEN 0 THEN '\\N' WHEN 1 THEN 'NULL' ELSE '' END) AS grid,
  coalesce(cast(position AS VARCHAR), CASE result_id % 3 WHEN 0 THEN '\\N' WHEN 1 THEN 'NULL' ELSE '' END) AS position,
  CASE WHEN result_id % 41 = 0 THEN 'not a day' ELSE strftime(date, '%Y-%m-%d') END AS date, year
FROM entries""",
    "schedule": f"""
SELECT {_DAY.format('d')} AS race_id, year(d) AS year, month(d) AS round, day(d) % 5 AS circuit_id,
  concat('GP ', cast(month(d) AS VARCHAR)) AS name, strftime(d, '%Y-%m-%d') AS date
FROM (SELECT DISTINCT cast(o_orderdate AS DATE) AS d FROM orders)""",
    "calendar": """
SELECT circuit_id, year, min(race_id) AS opening_race_id, count(*) AS events FROM schedule GROUP BY ALL""",
    "circuits": """
SELECT cast(r_regionkey AS BIGINT) AS circuit_id, r_name AS name,
  concat('town ', cast(r_regionkey AS VARCHAR)) AS location, concat('land ', cast(r_regionkey % 3 AS VARCHAR)) AS country,
  CASE WHEN r_regionkey <> 2 THEN cast(r_regionkey * 10 - 20 AS DOUBLE) END AS lat,
  CASE WHEN r_regionkey <> 2 THEN cast(r_regionkey * 30 - 60 AS DOUBLE) END AS lng,
  CASE WHEN r_regionkey <> 2 THEN cast(r_regionkey * 400 AS DOUBLE) END AS alt
FROM region""",
    "drivers": """
SELECT c_custkey AS driver_id, c_name AS driver_ref, c_mktsegment AS nationality,
  CASE WHEN c_custkey % 19 = 7 THEN '\\N'
       ELSE concat(cast(1960 + c_custkey % 40 AS VARCHAR), '-0', cast(1 + c_custkey % 9 AS VARCHAR), '-15') END AS dob
FROM customer""",
    "teams": """
SELECT cast(n_nationkey AS BIGINT) AS team_id, n_name AS name,
  concat('zone ', cast(n_regionkey AS VARCHAR)) AS nationality FROM nation""",
    "qualifying": f"""
SELECT race_id, driver_id, qualify_id, 1 + load % 24 AS position,
  CASE WHEN driver_id % 11 = 3 THEN '\\N' WHEN driver_id % 13 = 4 THEN cast(load + 60 AS VARCHAR)
       WHEN driver_id % 17 = 6 THEN 'no time' ELSE {_CLOCK.format('60000 + pace % 40000')} END AS q1,
  CASE WHEN 1 + load % 24 <= 15 THEN {_CLOCK.format('60000 + pace % 40000 - 500')} END AS q2,
  CASE WHEN 1 + load % 24 <= 10 THEN {_CLOCK.format('60000 + pace % 40000 - 900')} END AS q3
FROM (SELECT {_DAY.format('o_orderdate')} AS race_id, o_custkey AS driver_id,
        cast(sum(l_quantity) AS BIGINT) AS load, cast(floor(min(l_extendedprice)) AS BIGINT) AS pace,
        min(l_orderkey) AS qualify_id
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)""",
    "driver_standings": """
SELECT race_id, driver_id, sum(points + round) AS points, min(1 + (result_id * 5) % 24) AS position,
  count(*) FILTER (WHERE position_order = 1) AS wins FROM entries GROUP BY 1, 2""",
    "team_standings": """
SELECT race_id, team_id, sum(points) AS points, min(1 + (result_id * 3) % 12) AS position,
  count(*) FILTER (WHERE position_order = 1) AS wins FROM results GROUP BY 1, 2""",
    "laps": f"""
SELECT {_DAY.format('o_orderdate')} AS race_id, o_custkey AS driver_id, cast(l_linenumber AS BIGINT) AS lap,
  cast(floor(l_extendedprice) AS BIGINT) AS milliseconds
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey""",
    "vectors": """
SELECT vec_id, cast(embedding AS DOUBLE[]) AS vec, cast(label AS BIGINT) AS cluster FROM embeddings""",
    "scored": """
SELECT event_id, cast(event_type IN ('purchase', 'signup') AS BIGINT) AS label,
  round(value / (value + 10.0), 2) AS score,
  cast(round(value / (value + 10.0), 2) >= 0.6 AS BIGINT) AS pred FROM events""",
    "predicted": """
SELECT result_id, cast(position AS DOUBLE) AS y,
  cast(position AS DOUBLE) * 0.5 + coalesce(grid, 20) * 0.25::DOUBLE + 3.0::DOUBLE AS pred FROM entries WHERE position IS NOT NULL""",
}

_NEEDS: dict[str, tuple[str, ...]] = {
    "results": ("entries",),
    "raw_results": ("entries",),
    "calendar": ("schedule",),
    "driver_standings": ("entries",),
    "team_standings": ("results",),
    "predicted": ("entries",),
}


def with_roles(sql: str, *names: str) -> str:
    """Prefix SQL with the CTEs of the named roles and of what they read."""
    chosen: list[str] = []

    def add(name: str) -> None:
        for n in _NEEDS.get(name, ()):
            add(n)
        if name not in chosen:
            chosen.append(name)

    for n in names:
        add(n)
    ctes = ",\n".join(f"{n} AS ({ROLE_SQL[n].strip()})" for n in chosen)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
