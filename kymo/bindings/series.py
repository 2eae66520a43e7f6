"""Time-series operators on per-user events, order lines and vectors."""

from pyspark.sql import functions as F

from kymo.bindings.registry import DAY, EVENTS_CTE, HOUR, MINUTE, SECOND, query, windows_cte
from kymo.bindings.splits import dbl
from kymo.functions import design
from kymo.functions import signal as sg
from kymo.operators import filters as fl
from kymo.operators import series as ts
from kymo.plans.lanes import attach, measure

KEYS = ["user_id"]
OVER = "OVER (PARTITION BY user_id ORDER BY t)"


def ev(t, *columns):
    return t.events.select("user_id", "t", *columns)


def us(df):
    return df.withColumnsRenamed({"start": "start_us", "end": "end_us"})


# User events, each customer's orders in key order, and vectors as regular series.
MIXED = """
m AS (SELECT 'e' || user_id AS rec, event_id AS pos, epoch_us(ts) AS t FROM events
    UNION ALL SELECT 'o' || o_custkey, o_orderkey, epoch_us(o_orderdate) FROM orders
    UNION ALL SELECT 'v' || vec_id, k, k * 4000 FROM
        (SELECT vec_id, unnest(range(len(embedding))) AS k FROM embeddings) q)"""


def mixed(t):
    e = t.events.select(
        F.concat(F.lit("e"), "user_id").alias("rec"), F.col("event_id").alias("pos"), "t"
    )
    o = t.orders.select(
        F.concat(F.lit("o"), "o_custkey").alias("rec"), F.col("o_orderkey").alias("pos"), "t"
    )
    v = t.table("embeddings").select(
        F.concat(F.lit("v"), "vec_id").alias("rec"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.size("embedding").cast("bigint") - 1))
        .alias("pos"),
    )
    return e.unionByName(o).unionByName(v.withColumn("t", F.col("pos") * 4000))


@query("sampling_rate", f"""
WITH {MIXED}, d AS (SELECT rec, t - lag(t) OVER (PARTITION BY rec ORDER BY pos) AS d FROM m),
s AS (SELECT rec, count(*) AS n, min(d) AS lo, max(d) AS hi, median(d) AS md FROM d GROUP BY rec),
c AS (SELECT *, CASE WHEN n < 2 THEN 'too_few' WHEN lo <= 0 THEN 'not_increasing'
    WHEN (hi - lo) / md > 0.001 THEN 'irregular' ELSE 'ok' END AS status FROM s)
SELECT rec, n AS n_samples, status,
    CASE WHEN status = 'ok' THEN round(1000000 / md, 6) END AS rate_hz FROM c
""")
def _(t):
    got = ts.sampling_rate(mixed(t), ["rec"], "t", "pos", ["pos"])
    return got.withColumn("rate_hz", F.round("rate_hz", 6))


@query("uniformity_check", f"""
WITH {MIXED}, d AS (SELECT rec, t - lag(t) OVER (PARTITION BY rec ORDER BY pos) AS d FROM m),
p AS (SELECT *, CAST(sum(d) OVER (PARTITION BY rec) AS DOUBLE) / count(d) OVER (PARTITION BY rec)
    AS p FROM d)
SELECT rec, round(max(p) / 1000000, 3) AS mean_step_s,
    bool_and(abs(d - p) <= 10000 + 0.001 * p) AS is_uniform FROM p GROUP BY rec
""")
def _(t):
    got = ts.uniformity_check(mixed(t), ["rec"], "t", "pos", ["pos"])
    return got.withColumn("mean_step_s", F.round(F.col("mean_step") / SECOND, 3)).drop("mean_step")


@query("regular_time_axis", """
SELECT vec_id, label, vec_id * 1000 AS domain_start,
    vec_id * 1000 + len(embedding) * 4000 AS domain_end,
    CAST(k AS INTEGER) AS sample, vec_id * 1000 + k * 4000 AS t_us,
    CAST(embedding[k + 1] AS DOUBLE) AS v
FROM embeddings, LATERAL (SELECT unnest(range(len(embedding))) AS k)
""")
def _(t):
    got = ts.regular_time_axis(
        t.table("embeddings"), "embedding", 250.0, F.col("vec_id") * 1000
    )
    return got.withColumn("v", F.col("v").cast("double")).withColumnRenamed("t", "t_us")


@query("auto_domain",
       f"WITH {EVENTS_CTE} SELECT user_id, min(t) AS start_us, max(t) AS end_us "
       "FROM e GROUP BY user_id")
def _(t):
    return us(ts.auto_domain(ev(t), KEYS, "t"))


@query("sort_events", f"""
WITH {EVENTS_CTE} SELECT user_id, event_id, event_type, value, t,
    row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) - 1 AS idx FROM e
""")
def _(t):
    rows = ev(t, "event_id", "event_type", "value")
    return ts.sort_events(rows, KEYS, "t", ["t", "event_id"])


@query("segment_by_median_gap", f"""
WITH {EVENTS_CTE}, d AS (SELECT user_id, t, t - lag(t) {OVER} AS d FROM e),
md AS (SELECT user_id, median(d) AS md FROM d GROUP BY user_id),
f AS (SELECT d.*, md.md, CASE WHEN d.d > 2 * md.md THEN 1 ELSE 0 END AS f
    FROM d JOIN md USING (user_id)),
g AS (SELECT *, sum(f) {OVER} AS segment FROM f)
SELECT user_id, CAST(segment AS BIGINT) AS segment, min(t) AS start_us,
    max(t) + coalesce(CAST(floor(any_value(md)) AS BIGINT), 10000) AS end_us
FROM g GROUP BY user_id, segment
""")
def _(t):
    return us(ts.segment_by_median_gap(ev(t), KEYS, "t"))


@query("segment_by_period", f"""
WITH {EVENTS_CTE}, f AS (SELECT user_id, t,
    CASE WHEN t - lag(t) {OVER} - {6 * HOUR} > 100 THEN 1 ELSE 0 END AS f FROM e),
g AS (SELECT *, sum(f) {OVER} AS segment FROM f)
SELECT user_id, CAST(segment AS BIGINT) AS segment, min(t) AS start_us, max(t) + 100 AS end_us
FROM g GROUP BY user_id, segment
""")
def _(t):
    return us(ts.segment_by_period(ev(t), KEYS, "t", 6 * HOUR))


def slope_sql(y: str, source: str, out: str, part: str) -> str:
    w = f"OVER (PARTITION BY {part} ORDER BY t)"
    return f"""
{out}_n AS (SELECT *, (t - lag(t) {w}) / {dbl(float(HOUR))} AS hs,
    (lead(t) {w} - t) / {dbl(float(HOUR))} AS hd, lag({y}) {w} AS pv, lead({y}) {w} AS nv
    FROM {source}),
{out}_t AS (SELECT * EXCLUDE (hs, hd, pv, nv), CASE WHEN hs IS NULL THEN (nv - {y}) / hd
    WHEN hd IS NULL THEN ({y} - pv) / hs
    ELSE (hs * hs * nv + (hd * hd - hs * hs) * {y} - hd * hd * pv) / (hs * hd * (hd + hs))
    END AS {out} FROM {out}_n)"""


@query("gradient", f"""
WITH {EVENTS_CTE}, s AS (SELECT event_id, user_id, t // {DAY} AS day, t, value FROM e),
{slope_sql("value", "s", "vel", "user_id, day")},
{slope_sql("vel", "vel_t", "acc", "user_id, day")}
SELECT event_id, round(vel, 6) AS vel, round(acc, 6) AS acc FROM acc_t
""")
def _(t):
    rows = ev(t, "event_id", "value").withColumn("day", F.expr(f"t div {DAY}"))
    segment = ["user_id", "day"]
    cuts = measure(rows, segment, "t")
    vel = ts.gradient(rows, segment, "t", "value", "vel", unit=HOUR, cuts=cuts)
    acc = ts.gradient(vel, segment, "t", "vel", "acc", unit=HOUR, cuts=cuts)
    return acc.select("event_id", F.round("vel", 6).alias("vel"), F.round("acc", 6).alias("acc"))


@query("vector_norm", """
WITH x AS (SELECT vec_id, unnest(embedding) AS x FROM embeddings)
SELECT vec_id, round(sqrt(sum(CAST(x AS DOUBLE) * CAST(x AS DOUBLE))), 6) AS norm
FROM x GROUP BY vec_id
""")
def _(t):
    return t.table("embeddings").select(
        "vec_id", F.round(sg.vector_norm(F.col("embedding")), 6).alias("norm")
    )


@query("threshold_mask", """
SELECT event_id, value > 120 AS is_outlier, value < 10 AS is_still,
    (value - 50 < -40 OR value - 50 > 40 OR value - 60 < -40 OR value - 60 > 40) AS is_outside
FROM events
""")
def _(t):
    v = F.col("value")
    return t.events.select(
        "event_id",
        sg.threshold_mask(v, 120.0).alias("is_outlier"),
        sg.threshold_mask(v, 10.0, below=True).alias("is_still"),
        sg.outside_box(v - 50, v - 60, 40.0).alias("is_outside"),
    )


def mask_rows(t, limit):
    return t.events.select(
        "event_id", "user_id", "t", sg.threshold_mask(F.col("value"), limit).alias("mask")
    )


@query("dilate_mask", f"""
WITH {EVENTS_CTE}, m AS (SELECT event_id, user_id, t, value > 100 AS mask FROM e)
SELECT event_id, mask,
    max(mask) OVER (w ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS near_5,
    max(mask) OVER (w ROWS BETWEEN 1 PRECEDING AND 2 FOLLOWING) AS near_4
FROM m WINDOW w AS (PARTITION BY user_id ORDER BY t)
""")
def _(t):
    rows = mask_rows(t, 100.0)
    rows = ts.dilate_mask(rows, KEYS, "t", ["t"], "mask", 5, "near_5")
    rows = ts.dilate_mask(rows, KEYS, "t", ["t"], "mask", 4, "near_4")
    return rows.drop("user_id", "t")


@query("erode_mask", f"""
WITH {EVENTS_CTE}, m AS (SELECT event_id, user_id, t, value > 10 AS mask FROM e)
SELECT event_id, mask,
    min(mask) OVER (w ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)
        AND count(*) OVER (w ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) = 5 AS whole_5,
    min(mask) OVER (w ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING)
        AND count(*) OVER (w ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING) = 4 AS whole_4
FROM m WINDOW w AS (PARTITION BY user_id ORDER BY t)
""")
def _(t):
    rows = mask_rows(t, 10.0)
    rows = ts.erode_mask(rows, KEYS, "t", ["t"], "mask", 5, "whole_5")
    rows = ts.erode_mask(rows, KEYS, "t", ["t"], "mask", 4, "whole_4")
    return rows.drop("user_id", "t")


@query("mask_to_intervals", f"""
WITH {EVENTS_CTE}, m AS (SELECT user_id, t, value > 30 AS mask,
    lag(value > 30) {OVER} AS pm, lag(t) {OVER} AS pt FROM e),
r AS (SELECT *, sum(CASE WHEN mask AND NOT coalesce(pm, false) THEN 1 ELSE 0 END) {OVER} AS run
    FROM m)
SELECT user_id, coalesce(min(pt), min(t)) AS start_us, max(t) AS end_us FROM (
    SELECT user_id, run, t, CASE WHEN mask AND NOT coalesce(pm, false) THEN pt END AS pt
    FROM r WHERE mask) GROUP BY user_id, run
""")
def _(t):
    return us(ts.mask_to_intervals(mask_rows(t, 30.0), KEYS, "t", "mask"))


@query("regularize_grid", f"""
WITH {EVENTS_CTE}, d AS (SELECT user_id, min(t) AS t0, max(t) AS tn FROM e GROUP BY user_id),
p AS (SELECT e.user_id, t, value, t0, CAST(round_even((t - t0) / {dbl(float(HOUR))}, 0) AS BIGINT)
    AS idx FROM e JOIN d USING (user_id)),
s AS (SELECT user_id, idx, arg_min(value, t) AS v, count(*) AS n,
    bool_or(abs(t - t0 - idx * {HOUR}) > {20 * MINUTE}) AS off FROM p GROUP BY user_id, idx),
g AS (SELECT user_id, t0, unnest(range(CAST(round_even((tn - t0) / {dbl(float(HOUR))}, 0)
    AS BIGINT) + 1)) AS idx FROM d)
SELECT g.user_id, g.idx, t0 + g.idx * {HOUR} AS t_us, coalesce(v, CAST('nan' AS DOUBLE)) AS value,
    coalesce(n, 0) AS n_samples, coalesce(off, false) AS off_grid
FROM g LEFT JOIN s ON s.user_id = g.user_id AND s.idx = g.idx
""")
def _(t):
    got = ts.regularize_grid(ev(t, "value"), KEYS, "t", "value", HOUR, 20 * MINUTE)
    return got.withColumnRenamed("t", "t_us")


LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "t", "l_extendedprice"]
LINES = f"""
l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, epoch_us(l_shipdate) AS t,
    l_extendedprice FROM lineitem),
b AS (SELECT *, CASE WHEN t < lag(t) OVER lw THEN 1 ELSE 0 END AS back FROM l
    WINDOW lw AS (PARTITION BY l_orderkey ORDER BY {", ".join(LINE_ORDER)})),
bl AS (SELECT *, CAST(sum(back) OVER (PARTITION BY l_orderkey ORDER BY {", ".join(LINE_ORDER)}
    ROWS UNBOUNDED PRECEDING) AS BIGINT) AS block,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY {", ".join(LINE_ORDER)}) AS rn FROM b)"""


def lines(t):
    return t.lineitem.select(
        "l_orderkey",
        F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
        "l_partkey",
        "l_suppkey",
        "t",
        "l_extendedprice",
    )


@query("clock_resets", f"""
WITH {LINES} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, t, block FROM bl
""")
def _(t):
    got = ts.clock_resets(lines(t), ["l_orderkey"], "l_linenumber", LINE_ORDER, "t")
    return got.drop("l_extendedprice")


@query("restitch_blocks", f"""
WITH {LINES}, s AS (SELECT l_orderkey, block, arg_min(t, rn) AS f, arg_max(t, rn) AS z
    FROM bl GROUP BY l_orderkey, block),
o AS (SELECT *, first_value(f) OVER w + coalesce(sum(z - f + {60 * SECOND}) OVER
        (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) - f AS shift FROM s
    WINDOW w AS (PARTITION BY l_orderkey ORDER BY block))
SELECT bl.l_orderkey, l_linenumber, l_partkey, l_suppkey, bl.block,
    CAST(t + shift AS BIGINT) AS t, CAST(t + {DAY} + shift AS BIGINT) AS done
FROM bl JOIN o ON o.l_orderkey = bl.l_orderkey AND o.block = bl.block
""")
def _(t):
    rows = lines(t).withColumn("done", F.col("t") + DAY)
    got = ts.restitch_blocks(
        rows, ["l_orderkey"], "l_linenumber", LINE_ORDER, "t", ["t", "done"]
    )
    return got.drop("l_extendedprice")


@query("drop_overlap_blocks", f"""
WITH {EVENTS_CTE}, {windows_cte("w", "error", HOUR)},
r AS (SELECT user_id, (min(event_id) + max(event_id)) // 2 AS reset FROM e GROUP BY user_id)
SELECT e.event_id, e.user_id, e.t FROM e JOIN r ON r.user_id = e.user_id WHERE NOT (
    e.event_id < r.reset AND EXISTS (SELECT 1 FROM w WHERE w.user_id = e.user_id
        AND w.s <= e.t AND e.t <= w.e_))
""")
def _(t):
    resets = t.events.groupBy("user_id").agg(
        F.expr("(min(event_id) + max(event_id)) div 2").alias("reset")
    )
    rows = attach(ev(t, "event_id"), resets, KEYS)
    got = ts.drop_overlap_blocks(
        rows, t.windows("error", HOUR), KEYS, "t", F.col("event_id") < F.col("reset")
    )
    return got.select("event_id", "user_id", "t")


@query("exclude_misaligned_units", f"""
WITH {EVENTS_CTE}, x AS (SELECT *, t // {10 * DAY} AS block FROM e),
bd AS (SELECT user_id, block, min(t) - {6 * HOUR} AS s, max(t) + {6 * HOUR} AS e_ FROM x
    WHERE event_type = 'view' GROUP BY user_id, block),
j AS (SELECT x.user_id, x.event_type, coalesce(x.t >= bd.s AND x.t <= bd.e_, false) AS ok
    FROM x LEFT JOIN bd ON bd.user_id = x.user_id AND bd.block = x.block)
SELECT user_id, event_type FROM j GROUP BY user_id, event_type HAVING bool_and(ok)
""")
def _(t):
    spikes = ev(t, "event_type").withColumn("block", F.expr(f"t div {10 * DAY}"))
    bounds = spikes.filter(F.col("event_type") == "view").groupBy("user_id", "block").agg(
        (F.min("t") - 6 * HOUR).alias("start"), (F.max("t") + 6 * HOUR).alias("end")
    )
    return ts.exclude_misaligned_units(spikes, bounds, KEYS, "event_type", "t")


# Order lines as stimuli of the user numbered like their supplier.
FRAMES = f"""
fr AS (SELECT user_id, t, row_number() {OVER} - 1 AS frame FROM e),
st AS (SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey AS user_id, l_linenumber AS f0,
    l_linenumber + CAST(l_quantity AS BIGINT) AS f1, l_discount, l_tax, l_returnflag,
    l_quantity, l_extendedprice FROM lineitem),
framed AS (SELECT st.*, a.t AS start_us, b.t AS end_us FROM st
    LEFT JOIN fr a ON a.user_id = st.user_id AND a.frame = st.f0
    LEFT JOIN fr b ON b.user_id = st.user_id AND b.frame = st.f1)"""


def stimuli(t):
    frame = F.col("l_linenumber").cast("bigint")
    return t.table("lineitem").select(
        F.col("l_suppkey").alias("user_id"),
        frame.alias("start"),
        (frame + F.col("l_quantity").cast("bigint")).alias("end"),
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        "l_discount",
        "l_tax",
        "l_returnflag",
        "l_quantity",
        "l_extendedprice",
    )


def framed(t, rows):
    return ts.frame_to_time(rows, ev(t), KEYS, "t", ["start", "end"])


@query("frame_to_time", f"""
WITH {EVENTS_CTE}, {FRAMES}
SELECT l_orderkey, l_partkey, l_linenumber, user_id, start_us, end_us FROM framed
""")
def _(t):
    rows = stimuli(t).select("user_id", "start", "end", "l_orderkey", "l_partkey", "l_linenumber")
    return us(framed(t, rows))


@query("decimate_mean", f"""
WITH {EVENTS_CTE}, n AS (SELECT user_id, t, value, (row_number() {OVER} - 1) // 4 AS grp FROM e)
SELECT user_id, grp AS "group", min(t) AS t, round(avg(value), 6) AS value FROM n
GROUP BY user_id, grp HAVING count(*) = 4
""")
def _(t):
    got = ts.decimate_mean(ev(t, "value"), KEYS, "t", "value")
    return got.withColumn("value", F.round("value", 6))


@query("resample_linear", f"""
WITH {EVENTS_CTE}, d AS (SELECT user_id, min(t) AS t0, max(t) AS tn FROM e GROUP BY user_id),
g AS (SELECT user_id, t0, unnest(range(CAST(ceil((tn - t0) / {dbl(float(6 * HOUR))}) AS BIGINT)))
    AS k FROM d),
n AS (SELECT user_id, t, value, lead(t) {OVER} AS nt, lead(value) {OVER} AS nv FROM e)
SELECT g.user_id, g.k AS idx, t0 + g.k * {6 * HOUR} AS t_us, round(CASE WHEN n.t = t0 + g.k * {6 * HOUR}
    THEN n.value ELSE n.value + (n.nv - n.value) / (n.nt - n.t) * (t0 + g.k * {6 * HOUR} - n.t) END,
    6) AS value
FROM g ASOF JOIN n ON n.user_id = g.user_id AND n.t <= t0 + g.k * {6 * HOUR}
""")
def _(t):
    got = ts.resample_linear(ev(t, "value"), KEYS, "t", "value", 6 * HOUR)
    return got.withColumn("value", F.round("value", 6)).withColumnRenamed("t", "t_us")


def fir_sql(y: str, taps, w: str = "w") -> str:
    half = len(taps) // 2
    terms = []
    for i, tap in enumerate(taps):
        shift = half - i
        at = f"lag({y}, {shift})" if shift >= 0 else f"lead({y}, {-shift})"
        terms.append(f"coalesce({at} OVER {w}, 0) * {dbl(tap)}")
    return "(" + " + ".join(terms) + ")"


TAPS = design.sinc_low_pass(0.333 * 1000, 2500, 4).tolist()


@query("fir_filter", f"""
WITH {EVENTS_CTE} SELECT event_id, round({fir_sql("value", TAPS)}, 6) AS low FROM e
WINDOW w AS (PARTITION BY user_id ORDER BY t)
""")
def _(t):
    got = fl.fir_filter(ev(t, "event_id", "value"), KEYS, "t", ["t"], "value", TAPS, "low")
    return got.select("event_id", F.round("low", 6).alias("low"))


# Designed anew in SQL, at 250 Hz: sincs by cut-off and half length, summed to filters, these
# convolved with each other, and the products with the samples.
@query("band_power", f"""
WITH {EVENTS_CTE},
n AS (SELECT user_id, t, value, row_number() OVER (PARTITION BY user_id ORDER BY t) AS rn FROM e),
l AS (SELECT * FROM (VALUES ('delta', 5.0, 413, 1), ('delta', 0.5, 413, -1), ('theta', 11.25, 207, 1),
    ('theta', 2.0, 207, -1), ('lmp', 22.5, 4125, 1), ('lmp', 0.05, 4125, -1),
    ('notch', 60.65, 413, -1), ('notch', 59.35, 413, 1), ('notch', 120.8, 413, -1),
    ('notch', 119.2, 413, 1), ('smooth', 15.75, 92, -1), ('fold', 22.5, 83, 1)) AS v(name, cut, half, s)),
r AS (SELECT name, cut, s, k, CASE WHEN k = 0 THEN 1 ELSE sin(pi() * 2 * cut / 250 * k)
    / (pi() * 2 * cut / 250 * k) END * (0.54 + 0.46 * cos(pi() * k / half)) AS x
    FROM l, LATERAL (SELECT unnest(range(-half, half + 1)) AS k)),
p AS (SELECT name, k, s * x / sum(x) OVER (PARTITION BY name, cut) AS x FROM r
    UNION ALL VALUES ('notch', 0, 1.0), ('smooth', 0, 1.0)),
b AS MATERIALIZED (SELECT name, k, sum(x) AS x FROM p GROUP BY ALL),
c AS MATERIALIZED (SELECT b.name, b.k + q.k AS k, sum(b.x * q.x) AS x FROM b, b AS q
    WHERE q.name = 'notch' AND b.name IN ('delta', 'theta', 'lmp') GROUP BY ALL),
z AS MATERIALIZED (SELECT o.name, f.k + q.k AS k, sum(f.x * q.x) AS x FROM b AS f, b AS q,
    (VALUES ('delta'), ('theta')) AS o(name) WHERE f.name = 'fold' AND q.name = 'smooth' GROUP BY ALL
    UNION ALL SELECT 'lmp', k, x FROM b WHERE name = 'fold'),
a AS MATERIALIZED (SELECT c.name, i.user_id, i.rn, i.t, sum(j.value * c.x) AS y
    FROM n AS i JOIN n AS j ON i.user_id = j.user_id JOIN c ON c.k = i.rn - j.rn GROUP BY ALL),
q AS (SELECT name, user_id, rn, t, CASE WHEN name = 'lmp' THEN y ELSE y * y END AS y FROM a),
o AS (SELECT i.name, i.user_id, i.rn, i.t, sum(j.y * z.x) AS y
    FROM q AS i JOIN q AS j ON i.user_id = j.user_id AND i.name = j.name
    JOIN z ON z.name = i.name AND z.k = i.rn - j.rn WHERE (i.rn - 1) % 5 = 2 GROUP BY ALL)
SELECT user_id, (rn - 1) // 5 AS slot, t AS t_us, name AS band, round(y, 6) AS power FROM o
""")
def _(t):
    got = fl.band_power(ev(t, "value"), KEYS, "t", "value", 250, {"delta": (1, 4), "theta": (3, 10)})
    return got.withColumn("power", F.round("power", 6)).withColumnRenamed("t", "t_us")


def recursion_sql(source: str, out: str) -> str:
    """One pass of the two sections over ``source(user_id, m, x)``, from a constant's state."""
    (p0, p1, p2, c1, c2), (q0, q1, q2, d1, d2) = [[dbl(x) for x in s] for s in design.butterworth(333.0, 2500.0)]
    y1, y2 = f"({p0} * s.x + u1)", f"({q0} * ({p0} * s.x + u1) + w1)"
    step = f"""{y2} AS y,
        {p1} * s.x - {c1} * {y1} + u2 AS u1, {p2} * s.x - {c2} * {y1} AS u2,
        {q1} * {y1} - {d1} * {y2} + w2 AS w1, {q2} * {y1} - {d2} * {y2} AS w2"""
    return f"""
{out} AS (SELECT user_id, m, {step} FROM (SELECT *, x * ({p1} - {c1} + {p2} - {c2}) AS u1, x * ({p2} - {c2}) AS u2,
        x * ({q1} - {d1} + {q2} - {d2}) AS w1, x * ({q2} - {d2}) AS w2 FROM {source} WHERE m = 0) AS s
    UNION ALL SELECT s.user_id, s.m, {step} FROM {out} AS b JOIN {source} AS s
        ON s.user_id = b.user_id AND s.m = b.m + 1)"""


@query("zero_phase_low_pass", f"""
WITH RECURSIVE {EVENTS_CTE},
n AS (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY t) AS rn,
    count(*) OVER (PARTITION BY user_id) AS n FROM e),
g AS (SELECT user_id, n, least(15, n - 1) AS pad,
    max(CASE WHEN rn = 1 THEN value END) AS x0, max(CASE WHEN rn = n THEN value END) AS xn FROM n GROUP BY ALL),
f AS MATERIALIZED (SELECT user_id, rn + pad - 1 AS m, value AS x FROM n JOIN g USING (user_id)
    UNION ALL SELECT user_id, pad + 1 - rn, 2 * x0 - value FROM n JOIN g USING (user_id) WHERE rn BETWEEN 2 AND pad + 1
    UNION ALL SELECT user_id, pad + 2 * g.n - rn - 1, 2 * xn - value FROM n JOIN g USING (user_id)
    WHERE rn BETWEEN g.n - pad AND g.n - 1),
{recursion_sql("f", "h")},
v AS MATERIALIZED (SELECT user_id, n + 2 * pad - 1 - m AS m, y AS x FROM h JOIN g USING (user_id)),
{recursion_sql("v", "k")}
SELECT event_id, round(y, 6) AS low FROM k JOIN g USING (user_id)
JOIN n ON n.user_id = k.user_id AND n.rn = g.n + pad - m
""")
def _(t):
    got = fl.zero_phase_low_pass(ev(t, "event_id", "value"), KEYS, "t", ["t"], "value", 333.0, 2500.0, "low", size=32)
    return got.select("event_id", F.round("low", 6).alias("low"))


@query("drop_nan_samples", """
SELECT event_id, value FROM events WHERE value <= 100 AND value * 2 >= 1
""")
def _(t):
    nan, v = F.lit(float("nan")), F.col("value")
    holes = t.events.select("event_id", F.when(v > 100, nan).otherwise(v).alias("value"))
    holes = holes.withColumn(
        "pair", F.array(F.col("value"), F.when(v * 2 < 1, nan).otherwise(v * 2))
    )
    return ts.drop_nan_samples(holes, ["value"], ["pair"]).drop("pair")


@query("nan_pad_schema", """
SELECT event_id, event_type,
    CASE WHEN event_type IN ('click', 'purchase') THEN value ELSE CAST('nan' AS DOUBLE) END AS speed,
    CASE WHEN event_type = 'view' THEN value / 2 ELSE CAST('nan' AS DOUBLE) END AS theta,
    CASE WHEN event_type = 'click' THEN value ELSE CAST('nan' AS DOUBLE) END AS pos_x,
    CASE WHEN event_type = 'click' THEN value * 2 ELSE CAST('nan' AS DOUBLE) END AS pos_y
FROM events
""")
def _(t):
    e, v = t.events.select("event_id", "event_type", "value"), F.col("value")

    def of(kind, **columns):
        return e.filter(F.col("event_type") == kind).withColumns(columns)

    frames = [
        of("click", speed=v, pos=F.array(v, v * 2)),
        of("view", theta=v / 2),
        of("purchase", speed=v, pos=F.array(v)),
        e.filter(~F.coalesce(F.col("event_type").isin("click", "view", "purchase"), F.lit(False))),
    ]
    return ts.nan_pad_schema(frames, ["event_id", "event_type"], ["speed", "theta"], ["pos"])


CHANNELS = [f"ch{i}" for i in range(8)]


@query("signal_wide_long", """
WITH v AS (SELECT vec_id // 8 AS rec, 'ch' || (vec_id % 8) AS channel,
    unnest(range(len(embedding))) AS k, unnest(embedding) AS v FROM embeddings)
SELECT rec, CAST(k AS INTEGER) AS sample, channel, CAST(v AS DOUBLE) AS v,
    round(sum(CAST(v AS DOUBLE)) OVER (PARTITION BY rec, k), 6) AS row_sum
FROM v WHERE channel <> 'ch7'
""")
def _(t):
    signal = t.table("embeddings").select(
        F.expr("vec_id div 8").alias("rec"),
        F.concat(F.lit("ch"), (F.col("vec_id") % 8)).alias("channel"),
        "embedding",
    )
    wide = ts.signal_wide(signal, ["rec"], "channel", "embedding", CHANNELS, ["ch7"])
    kept = CHANNELS[:7]
    total = sum((F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in kept), F.lit(0.0))
    wide = wide.withColumn("row_sum", F.round(total, 6))
    long = ts.signal_long(wide, ["rec", "row_sum"], kept).filter(F.col("v").isNotNull())
    return long.withColumn("v", F.col("v").cast("double"))


@query("concat_recordings", f"""
WITH p AS (SELECT o_custkey, o_orderkey, CASE WHEN o_totalprice < 2000 THEN NULL
    ELSE epoch_us(o_orderdate) END AS started, CAST(floor(o_totalprice) AS BIGINT) AS n,
    o_orderstatus AS ch FROM orders),
f AS (SELECT *, bool_or(started IS NULL) OVER (PARTITION BY o_custkey) AS missing_date,
    min(ch) OVER (PARTITION BY o_custkey) <> max(ch) OVER (PARTITION BY o_custkey) AS mismatch,
    min(started // {DAY}) OVER (PARTITION BY o_custkey)
        <> max(started // {DAY}) OVER (PARTITION BY o_custkey) AS days FROM p),
a AS (SELECT *, CASE WHEN missing_date THEN o_orderkey ELSE started END AS place FROM f),
w AS (SELECT *, sum(n) OVER (v ROWS UNBOUNDED PRECEDING) - n AS off,
    started - (lag(started) OVER v + lag(n) OVER v * 1000000) AS gap FROM a
    WINDOW v AS (PARTITION BY o_custkey ORDER BY place, o_orderkey))
SELECT o_custkey, o_orderkey, started, n AS n_samples, CAST(off AS BIGINT) AS sample_offset,
    CASE WHEN NOT missing_date THEN gap END AS gap_us,
    coalesce(NOT missing_date AND gap > {HOUR}, false) AS gap_exceeded,
    coalesce(days, false) AND NOT missing_date AS day_mismatch, missing_date,
    mismatch AS channel_mismatch FROM w
""")
def _(t):
    parts = t.orders.select(
        "o_custkey",
        "o_orderkey",
        F.when(F.col("o_totalprice") >= 2000, F.col("t")).alias("started"),
        F.floor("o_totalprice").cast("bigint").alias("n_samples"),
        F.col("o_orderstatus").alias("channels"),
    )
    return ts.concat_recordings(
        parts, ["o_custkey"], "o_orderkey", "started", "n_samples", 1.0, "channels", HOUR
    )


@query("fixed_width_distribution", """
SELECT vec_id, CAST(k AS INTEGER) AS bin, CAST(embedding[k + 1] AS DOUBLE) AS "L",
    CAST(embedding[k + 33] AS DOUBLE) AS "P"
FROM embeddings, (SELECT unnest(range(32)) AS k) q
""")
def _(t):
    chunks = t.table("embeddings").select(
        "vec_id",
        F.slice("embedding", 1, 32).cast("array<double>").alias("L"),
        F.slice("embedding", 33, 32).cast("array<double>").alias("P"),
    )
    return ts.fixed_width_distribution(chunks, ["vec_id"], ["L", "P"], 32)
