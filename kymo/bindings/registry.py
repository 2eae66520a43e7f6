"""Registry of bound queries and the table loader they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kymo.session import pin_session

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SECOND = 1_000_000
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE
DAY = 24 * HOUR


class Tables:
    """The given tables, clocks as bigint microseconds."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = pin_session(spark)
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    @property
    def events(self) -> DataFrame:
        return self.table("events").select(
            "event_id", "user_id", "event_type", "value", "props", micros("ts").alias("t")
        )

    @property
    def orders(self) -> DataFrame:
        return self.table("orders").withColumn("t", micros("o_orderdate"))

    @property
    def lineitem(self) -> DataFrame:
        return self.table("lineitem").withColumn("t", micros("l_shipdate"))

    def windows(self, event_type: str, length: int) -> DataFrame:
        """Intervals of fixed length from every event of one type."""
        return (
            self.events.filter(F.col("event_type") == event_type)
            .select("user_id", F.col("t").alias("start"), (F.col("t") + length).alias("end"))
        )

    def user_domain(self) -> DataFrame:
        return self.events.groupBy("user_id").agg(
            F.min("t").alias("start"), F.max("t").alias("end")
        )


def micros(column: str):
    return F.unix_micros(F.col(column).cast("timestamp"))


def query(name: str, sql: str | None = None):
    """Register a binding under an operator's name, with its SQL equivalent."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


# --- SQL text shared by the equivalents -------------------------------------

EVENTS_CTE = (
    "e AS (SELECT event_id, user_id, event_type, value, props, epoch_us(ts) AS t FROM events)"
)


def windows_cte(name: str, event_type: str, length: int) -> str:
    return (
        f"{name} AS (SELECT user_id, epoch_us(ts) AS s, epoch_us(ts) + {length} AS e_ "
        f"FROM events WHERE event_type = '{event_type}')"
    )


def sweep_cte(name: str, keys: str, a: str, b: str | None, inside: str) -> str:
    """CTEs computing pieces (keys, s, e_) of ``inside`` (a condition on ca, cb)."""
    parts = [
        f"SELECT {keys}, s AS t, 1 AS da, 0 AS db FROM {a} WHERE e_ > s",
        f"SELECT {keys}, e_, -1, 0 FROM {a} WHERE e_ > s",
    ]
    if b:
        parts += [
            f"SELECT {keys}, s, 0, 1 FROM {b} WHERE e_ > s",
            f"SELECT {keys}, e_, 0, -1 FROM {b} WHERE e_ > s",
        ]
    union = " UNION ALL ".join(parts)
    return f"""
{name}_x AS ({union}),
{name}_g AS (SELECT {keys}, t, sum(da) AS da, sum(db) AS db FROM {name}_x GROUP BY ALL),
{name}_c AS (SELECT {keys}, t,
    sum(da) OVER (PARTITION BY {keys} ORDER BY t) AS ca,
    sum(db) OVER (PARTITION BY {keys} ORDER BY t) AS cb,
    lead(t) OVER (PARTITION BY {keys} ORDER BY t) AS nt FROM {name}_g),
{name}_p AS (SELECT {keys}, t AS s, nt AS e_ FROM {name}_c WHERE ({inside}) AND nt IS NOT NULL),
{name}_m AS (SELECT *, CASE WHEN s = lag(e_) OVER (PARTITION BY {keys} ORDER BY s)
    THEN 0 ELSE 1 END AS f FROM {name}_p),
{name}_i AS (SELECT *, sum(f) OVER (PARTITION BY {keys} ORDER BY s) AS g FROM {name}_m),
{name} AS (SELECT {keys}, CAST(min(s) AS BIGINT) AS s, CAST(max(e_) AS BIGINT) AS e_
    FROM {name}_i GROUP BY {keys}, g)"""


# The hash split value, as an integer modulus of the 128-bit digest.
def hash_mod_sql(text: str, n: int) -> str:
    r = "0"
    for i in range(4):
        chunk = f"CAST('0x' || substr(md5({text}), {1 + 8 * i}, 8) AS BIGINT)"
        r = f"((({r}) * 4294967296 + {chunk}) % {n})"
    return r
