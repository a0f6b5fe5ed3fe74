"""Grid worlds as tables (S7, S8) and a grid derived from the event log.

A map is ``cells(x INT, y INT, code INT)``; the first matrix index is x.
Codes: 0 clear, 1 wall, 2 costly, 3 negative exit, 9 goal.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CLEAR, WALL, COSTLY, NEG_EXIT, GOAL = 0, 1, 2, 3, 9

# The two small maps of the reference, first index = x.
EASY_MAP = [
    [0, 0, 0, 0, 0, 0],
    [0, 0, 1, 1, 0, 0],
    [0, 0, 1, 1, 0, 0],
    [0, 0, 0, 0, 0, 9],
]
DEFAULT_MAP = [
    [0, 0, 0, 0, 0, 1, 0, 0, 0, 0, 0],
    [0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0],
    [0, 0, 0, 0, 0, 1, 0, 0, 0, 0, 0],
    [0, 0, 0, 0, 0, 1, 0, 0, 0, 0, 0],
    [0, 0, 0, 0, 0, 1, 0, 0, 0, 0, 0],
    [1, 0, 1, 1, 1, 1, 1, 0, 0, 1, 1],
    [0, 0, 0, 0, 1, 0, 0, 0, 0, 0, 0],
    [0, 0, 0, 0, 1, 0, 0, 0, 0, 0, 0],
    [0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0],
    [0, 0, 0, 0, 1, 0, 0, 0, 0, 0, 0],
    [0, 0, 0, 0, 1, 0, 0, 0, 0, 0, 0],
]


def grid_cells(spark: SparkSession, matrix: Sequence[Sequence[int]]) -> DataFrame:
    """Matrix literal -> ``(x, y, code)`` via two ``posexplode``."""
    lit = F.array(*[F.array(*[F.lit(int(v)) for v in row]) for row in matrix])
    rows = spark.range(1).select(F.posexplode(lit).alias("x", "col"))
    return rows.select(F.col("x").cast("int").alias("x"),
                       F.posexplode("col").alias("y", "code")).select(
        "x", F.col("y").cast("int").alias("y"), F.col("code").cast("int").alias("code"))


def grid_stats(cells: DataFrame) -> DataFrame:
    """Width, height, open states (code != 1) and cells per code, one
    row (per-code counts as columns n_code_<c>)."""
    codes = [CLEAR, WALL, COSTLY, NEG_EXIT, GOAL]
    return cells.agg(
        (F.max("x") + 1).cast("int").alias("width"),
        (F.max("y") + 1).cast("int").alias("height"),
        F.count_if(F.col("code") != WALL).cast("bigint").alias("states"),
        *[F.count_if(F.col("code") == c).cast("bigint").alias(f"n_code_{c}") for c in codes])


# Fixed thresholds of the event-log grid (documented rule, not reference data).
EVENT_GRID_HIGH_VALUE = 300.0


def grid_from_events(events: DataFrame) -> DataFrame:
    """A grid world whose size grows with the log: x = user, y = day index.

    A (user, day) cell with no events is a wall; a purchase worth at least
    ``EVENT_GRID_HIGH_VALUE`` makes a goal, such an error a negative exit,
    any other error a costly cell.  Every day of every user in the log is
    listed (walls included), one row per cell; a user id that does not occur
    has no cells, which moves treat like walls.
    """
    day0 = events.agg(F.min(F.to_date("ts")).alias("d0")).first()["d0"]
    ev = events.select(F.col("user_id").cast("bigint").alias("x"),
                       F.datediff(F.to_date("ts"), F.lit(day0)).cast("int").alias("y"),
                       "event_type", "value")
    hi = F.col("value") >= F.lit(EVENT_GRID_HIGH_VALUE)
    cells = ev.groupBy("x", "y").agg(
        F.max((F.col("event_type") == "purchase") & hi).alias("goal"),
        F.max((F.col("event_type") == "error") & hi).alias("neg"),
        F.max(F.col("event_type") == "error").alias("err"))
    code = (F.when(F.col("goal"), GOAL).when(F.col("neg"), NEG_EXIT)
             .when(F.col("err"), COSTLY).otherwise(CLEAR))
    open_cells = cells.select("x", "y", code.cast("int").alias("code"))
    last = open_cells.agg(F.max("y")).first()[0]
    box = (open_cells.select("x").distinct()
           .withColumn("y", F.explode(F.sequence(F.lit(0), F.lit(int(last if last is not None else 0))))))
    return (box.join(open_cells, ["x", "y"], "left")
               .select("x", "y", F.coalesce(F.col("code"), F.lit(WALL)).cast("int").alias("code")))


SQL_EVENT_GRID = f"""ev AS (
  SELECT CAST(user_id AS BIGINT) AS x,
         CAST(datediff('day', (SELECT min(CAST(ts AS DATE)) FROM events), CAST(ts AS DATE)) AS INTEGER) AS y,
         event_type, value FROM events),
oc AS (
  SELECT x, y, CASE WHEN bool_or(event_type = 'purchase' AND value >= {EVENT_GRID_HIGH_VALUE}) THEN 9
                    WHEN bool_or(event_type = 'error' AND value >= {EVENT_GRID_HIGH_VALUE}) THEN 3
                    WHEN bool_or(event_type = 'error') THEN 2 ELSE 0 END AS code
  FROM ev GROUP BY x, y),
cells AS (
  SELECT CAST(bx.x AS BIGINT) AS x, CAST(by_.y AS INTEGER) AS y, CAST(coalesce(oc.code, 1) AS INTEGER) AS code
  FROM (SELECT DISTINCT x FROM oc) AS bx
  CROSS JOIN range(0, (SELECT max(y) + 1 FROM oc)) AS by_(y)
  LEFT JOIN oc ON oc.x = bx.x AND oc.y = by_.y)"""
