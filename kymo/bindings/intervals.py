"""Interval operators on per-user windows."""

from pyspark.sql import functions as F

from kymo.bindings.registry import (
    DAY,
    EVENTS_CTE,
    HOUR,
    MINUTE,
    query,
    sweep_cte,
    windows_cte,
)
from kymo.operators import intervals as iv

KEYS = ["user_id"]
A = windows_cte("a", "click", 6 * HOUR)
B = windows_cte("b", "view", 8 * HOUR)
OUT = "SELECT user_id, s AS start_us, e_ AS end_us FROM r"


def both(t):
    return t.windows("click", 6 * HOUR), t.windows("view", 8 * HOUR)


def named(df):
    return df.withColumnsRenamed({"start": "start_us", "end": "end_us"})


@query("interval_union", f"WITH {A}, {B}, "
       "ab AS (SELECT * FROM a UNION ALL SELECT * FROM b), "
       f"{sweep_cte('r', 'user_id', 'ab', None, 'ca > 0')} {OUT}")
def _(t):
    return named(iv.interval_union(*both(t), KEYS))


@query("interval_intersection",
       f"WITH {A}, {B}, {sweep_cte('r', 'user_id', 'a', 'b', 'ca > 0 AND cb > 0')} {OUT}")
def _(t):
    return named(iv.interval_intersection(*both(t), KEYS))


@query("interval_difference",
       f"WITH {A}, {B}, {sweep_cte('r', 'user_id', 'a', 'b', 'ca > 0 AND cb = 0')} {OUT}")
def _(t):
    return named(iv.interval_difference(*both(t), KEYS))


@query("interval_dilate",
       f"WITH {A}, w AS (SELECT user_id, s - {HOUR} AS s, e_ + {HOUR} AS e_ FROM a), "
       f"{sweep_cte('r', 'user_id', 'w', None, 'ca > 0')} {OUT}")
def _(t):
    return named(iv.interval_dilate(t.windows("click", 6 * HOUR), KEYS, HOUR))


@query("interval_subdivide", f"""
WITH {EVENTS_CTE},
w AS (SELECT event_id, user_id, t, CAST(floor(value * {MINUTE}) AS BIGINT) AS d FROM e)
SELECT event_id, user_id, t + k * {30 * MINUTE} AS start_us, t + (k + 1) * {30 * MINUTE} AS end_us
FROM w, LATERAL (SELECT unnest(range(CAST(d // {30 * MINUTE} AS BIGINT))) AS k)
""")
def _(t):
    w = t.events.select(
        "event_id",
        "user_id",
        F.col("t").alias("start"),
        (F.col("t") + F.floor(F.col("value") * MINUTE)).alias("end"),
    )
    return named(iv.interval_subdivide(w, 30 * MINUTE))


@query("interval_select", f"""
SELECT o_orderkey, o_custkey, epoch_us(o_orderdate) AS start_us,
       epoch_us(o_orderdate) + {DAY} AS end_us
FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000
""")
def _(t):
    o = t.orders.select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_totalprice",
        F.col("t").alias("start"),
        (F.col("t") + DAY).alias("end"),
    )
    mask = (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 100000)
    return named(iv.interval_select(o, mask).drop("o_orderstatus", "o_totalprice"))


@query("interval_min_duration", f"""
WITH {A}, {B}, ab AS (SELECT * FROM a UNION ALL SELECT * FROM b),
{sweep_cte('r', 'user_id', 'ab', None, 'ca > 0')} {OUT} WHERE e_ - s > {9 * HOUR}
""")
def _(t):
    merged = iv.interval_union(*both(t), KEYS)
    return named(iv.interval_min_duration(merged, 9 * HOUR))


@query("interval_sort", f"""
WITH {A} SELECT user_id, s AS start_us, e_ AS end_us,
    row_number() OVER (PARTITION BY user_id ORDER BY s, e_) - 1 AS idx FROM a
""")
def _(t):
    return named(iv.interval_sort(t.windows("click", 6 * HOUR), KEYS))


@query("interval_checks", f"""
WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, epoch_us(l_shipdate) AS s,
    epoch_us(l_shipdate) + CAST(l_quantity AS BIGINT) * {DAY} AS e_ FROM lineitem),
p AS (SELECT *, lag(s) OVER (PARTITION BY l_orderkey
        ORDER BY l_linenumber, l_partkey, l_suppkey, s, e_) AS ps,
    max(e_) OVER (PARTITION BY l_orderkey ORDER BY s, e_
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM l)
SELECT l_orderkey, coalesce(bool_and(ps <= s), true) AS is_sorted,
    coalesce(bool_and(reach <= s), true) AS is_disjoint FROM p GROUP BY l_orderkey
""")
def _(t):
    spans = t.lineitem.select(
        "l_orderkey",
        F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
        "l_partkey",
        "l_suppkey",
        F.col("t").alias("start"),
        (F.col("t") + F.col("l_quantity").cast("bigint") * DAY).alias("end"),
    )
    return iv.interval_checks(
        spans,
        ["l_orderkey"],
        "l_linenumber",
        ["l_linenumber", "l_partkey", "l_suppkey", "start", "end"],
    )


BLOCKS = """blocks AS (SELECT user_id, k AS block,
    s + CAST(floor((e_ - s) * k / 10) AS BIGINT) AS s,
    s + CAST(floor((e_ - s) * (k + 1) / 10) AS BIGINT) AS e_
    FROM (SELECT user_id, min(t) AS s, max(t) AS e_ FROM e GROUP BY user_id) d,
    (SELECT CAST(unnest(range(10)) AS INTEGER) AS k) n)"""


@query("interval_linspace",
       f"WITH {EVENTS_CTE}, {BLOCKS} SELECT user_id, block, s AS start_us, e_ AS end_us FROM blocks")
def _(t):
    return named(iv.interval_linspace(t.user_domain(), 10))


@query("interval_stab", f"""
WITH {A}, {EVENTS_CTE}
SELECT e.event_id, e.user_id, e.t, min(a.s) AS hit_start,
    CAST(arg_min(a.e_, a.s) AS BIGINT) AS hit_end
FROM e LEFT JOIN a ON a.user_id = e.user_id AND a.s <= e.t AND e.t < a.e_
GROUP BY e.event_id, e.user_id, e.t
""")
def _(t):
    points = t.events.select("event_id", "user_id", "t")
    return iv.interval_stab(points, t.windows("click", 6 * HOUR), KEYS)


@query("interval_coverage", f"""
WITH {EVENTS_CTE}, {A}, {B}, ab AS (SELECT * FROM a UNION ALL SELECT * FROM b),
{sweep_cte('r', 'user_id', 'ab', None, 'ca > 0')}, {BLOCKS}
SELECT k.user_id, k.block, k.s AS start_us, k.e_ AS end_us,
    CAST(coalesce(sum(CASE WHEN r.s IS NULL THEN 0 ELSE least(k.e_, r.e_) - greatest(k.s, r.s) END), 0) AS BIGINT)
        AS covered_us,
    round(CAST(coalesce(sum(CASE WHEN r.s IS NULL THEN 0 ELSE least(k.e_, r.e_) - greatest(k.s, r.s) END), 0) AS DOUBLE)
        / (k.e_ - k.s), 6) AS ratio
FROM blocks k LEFT JOIN r ON r.user_id = k.user_id AND r.s < k.e_ AND k.s < r.e_
GROUP BY k.user_id, k.block, k.s, k.e_
""")
def _(t):
    a, b = both(t)
    blocks = iv.interval_linspace(t.user_domain(), 10)
    got = iv.interval_coverage(blocks, a.unionByName(b), KEYS, ["block"])
    length = F.col("end") - F.col("start")
    return named(got.withColumn("ratio", F.round(F.col("covered_us") / length, 6)))


@query("data_auto_domain", f"""
WITH {EVENTS_CTE}, d AS (
    SELECT user_id, min(t) AS s, max(t) AS e_ FROM e WHERE event_type = 'click' GROUP BY user_id
    UNION ALL
    SELECT user_id, min(t), max(t) FROM e WHERE event_type = 'view' GROUP BY user_id),
{sweep_cte('r', 'user_id', 'd', None, 'ca > 0')} {OUT}
""")
def _(t):
    def domain(kind):
        return t.events.filter(F.col("event_type") == kind).groupBy("user_id").agg(
            F.min("t").alias("start"), F.max("t").alias("end")
        )

    return named(iv.data_auto_domain([domain("click"), domain("view")], KEYS))
