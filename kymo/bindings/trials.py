"""Trial, stimulus and label operators."""

from pyspark.sql import functions as F

from kymo.bindings.registry import DAY, EVENTS_CTE, HOUR, MINUTE, SECOND, query, sweep_cte
from kymo.bindings.series import FRAMES, LINE_ORDER, ev, stimuli
from kymo.operators import trials as tr
from kymo.plans.lanes import attach


def us(df):
    return df.withColumnsRenamed({"start": "start_us", "end": "end_us"})


# A trial per order: ordered, first and last shipment, and a day after it.
TRIALS = f"""
ls AS (SELECT l_orderkey, min(epoch_us(l_shipdate)) AS go, max(epoch_us(l_shipdate)) AS stop
    FROM lineitem GROUP BY l_orderkey),
tr AS (SELECT o_orderkey, o_custkey, o_orderstatus, epoch_us(o_orderdate) AS s, go, stop,
    stop + {DAY} AS e_ FROM orders JOIN ls ON l_orderkey = o_orderkey)"""


def trial_table(t):
    shipped = t.lineitem.groupBy("l_orderkey").agg(F.min("t").alias("go"), F.max("t").alias("stop"))
    return t.orders.join(shipped, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.col("t").alias("ordered"),
        "go",
        "stop",
        (F.col("stop") + DAY).alias("done"),
    )


@query("trials_from_table", f"""
WITH {TRIALS} SELECT o_orderkey, s + {MINUTE} AS start_us, e_ + {MINUTE} AS end_us,
    go + {MINUTE} AS go, stop FROM tr
""")
def _(t):
    trials = tr.trials_from_table(trial_table(t), "ordered", "done", ["go"])
    moved = tr.shift_times(trials, MINUTE)
    return us(moved.select("o_orderkey", "start", "end", "go", "stop"))


@query("trial_validity", f"""
SELECT o_orderkey, o_orderstatus <> 'P' AND o_totalprice > 100000 AS success_valid,
    o_orderstatus = 'F' AND o_custkey % 5 <> 0 AND o_totalprice * 20 > {SECOND // 2}
        AND o_totalprice * 20 < {6 * SECOND} AS center_valid,
    o_orderstatus = 'F' AND o_custkey % 5 = 4 AND o_totalprice * 20 > {2 * SECOND}
        AND o_totalprice * 20 < {10 * SECOND} AS random_valid FROM orders
""")
def _(t):
    status, price, who = F.col("o_orderstatus"), F.col("o_totalprice"), F.col("o_custkey")
    result = F.when(status == "F", "R").otherwise("A")
    return t.table("orders").select(
        "o_orderkey",
        tr.success_validity(
            F.when(status == "P", 1).otherwise(0), F.when(price > 100000, 1).otherwise(0)
        ).alias("success_valid"),
        tr.center_out_validity(result, F.when(who % 5 != 0, who), price * 20).alias(
            "center_valid"
        ),
        tr.random_target_validity(result, who % 5, price * 20).alias("random_valid"),
    )


@query("trial_bounds_from_next", f"""
WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, epoch_us(l_shipdate) AS t,
    l_extendedprice, CASE WHEN l_returnflag <> 'N' THEN epoch_us(l_shipdate) + {HOUR} END AS target,
    CASE WHEN l_suppkey % 9 <> 0 THEN epoch_us(l_shipdate) + CAST(l_quantity AS BIGINT) * {HOUR}
        END AS stop,
    max(epoch_us(l_shipdate)) OVER (PARTITION BY l_orderkey) + {DAY} AS dom FROM lineitem),
g AS (SELECT *, coalesce(target, CASE WHEN row_number() OVER w = 1 THEN t
        WHEN lag(stop) OVER w IS NOT NULL AND stop IS NOT NULL
        THEN least(lag(stop) OVER w + {SECOND}, stop) END) AS trial_start,
    lead(l_orderkey) OVER w IS NULL AS is_last FROM l
    WINDOW w AS (PARTITION BY l_orderkey ORDER BY {", ".join(LINE_ORDER)}))
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, trial_start, CASE WHEN is_last
    THEN CASE WHEN stop IS NOT NULL THEN least(stop + {SECOND}, dom) END ELSE lead(trial_start) OVER (PARTITION BY l_orderkey
    ORDER BY {", ".join(LINE_ORDER)}) END AS trial_end FROM g
""")
def _(t):
    rows = t.lineitem.select(
        "l_orderkey",
        F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
        "l_partkey",
        "l_suppkey",
        "t",
        "l_extendedprice",
        F.when(F.col("l_returnflag") != "N", F.col("t") + HOUR).alias("target"),
        F.when(F.col("l_suppkey") % 9 != 0, F.col("t") + F.col("l_quantity").cast("bigint") * HOUR)
        .alias("stop"),
    )
    ends = rows.groupBy("l_orderkey").agg((F.max("t") + DAY).alias("domain_end"))
    got = tr.trial_bounds_from_next(
        attach(rows, ends, ["l_orderkey"]),
        ["l_orderkey"],
        "l_linenumber",
        LINE_ORDER,
        "target",
        "t",
        "stop",
        "domain_end",
    )
    return got.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "trial_start", "trial_end"
    )


PHASES = {
    "hold_period": ("ordered", "go"),
    "reach_period": ("go", "stop"),
    "return_period": ("stop", "done"),
}
PHASES_SQL = """
ph AS (SELECT o_custkey, o_orderkey, 'hold_period' AS phase, s, go AS e_ FROM tr
        WHERE o_orderstatus = 'F'
    UNION ALL SELECT o_custkey, o_orderkey, 'reach_period', go, stop FROM tr
        WHERE o_orderstatus = 'F'
    UNION ALL SELECT o_custkey, o_orderkey, 'return_period', stop, e_ FROM tr
        WHERE o_orderstatus = 'F'
    UNION ALL SELECT o_custkey, o_orderkey, 'invalid', s, e_ FROM tr WHERE o_orderstatus <> 'F')"""


def phases(t):
    rows = trial_table(t).withColumn("valid", F.col("o_orderstatus") == "F")
    return tr.movement_phases(
        rows, ["o_custkey", "o_orderkey"], "valid", PHASES, "ordered", "done"
    )


@query("movement_phases", f"""
WITH {TRIALS}, {PHASES_SQL}
SELECT o_custkey, o_orderkey, phase, s AS start_us, e_ AS end_us FROM ph
""")
def _(t):
    return us(phases(t))


@query("random_period", f"""
WITH {TRIALS}, {PHASES_SQL},
d AS (SELECT o_custkey, min(s) - {30 * DAY} AS s, max(e_) + {30 * DAY} AS e_ FROM tr
    GROUP BY o_custkey),
{sweep_cte("r", "o_custkey", "d", "ph", "ca > 0 AND cb = 0")}
SELECT o_custkey, s AS start_us, e_ AS end_us FROM r
""")
def _(t):
    domain = trial_table(t).groupBy("o_custkey").agg(
        (F.min("ordered") - 30 * DAY).alias("start"), (F.max("done") + 30 * DAY).alias("end")
    )
    return us(tr.random_period(domain, phases(t), ["o_custkey"]))


@query("phases_minus_outliers", f"""
WITH {TRIALS}, {PHASES_SQL},
o AS (SELECT o_custkey, phase, epoch_us(o_orderdate) AS s, epoch_us(o_orderdate) + {20 * DAY} AS e_
    FROM orders, (SELECT unnest(['hold_period', 'reach_period', 'return_period']) AS phase) q
    WHERE o_totalprice > 400000),
k AS (SELECT * FROM ph WHERE phase <> 'invalid'),
{sweep_cte("r", "o_custkey, phase", "k", "o", "ca > 0 AND cb = 0")}
SELECT o_custkey, phase, s AS start_us, e_ AS end_us FROM r
""")
def _(t):
    outliers = t.orders.filter(F.col("o_totalprice") > 400000).select(
        "o_custkey", F.col("t").alias("start"), (F.col("t") + 20 * DAY).alias("end")
    )
    return us(tr.phases_minus_outliers(phases(t), outliers, ["o_custkey"], list(PHASES)))


# BOTH: a session type per part.
SESSION = """CASE p_type WHEN 'ECONOMY' THEN 'three_session_A' WHEN 'SMALL' THEN 'three_session_B'
    WHEN 'PROMO' THEN 'three_session_C' WHEN 'LARGE' THEN 'three_session_C2' ELSE p_type END"""
STIMULI = ", ".join(
    f"('{k}', '{s}')" for k, found in tr.SESSION_STIMULI.items() for s in found
)


@query("stimuli_by_session_type", f"""
WITH s(kind, stimulus) AS (VALUES {STIMULI})
SELECT p_partkey, {SESSION} AS session_type, stimulus, stimulus IS NOT NULL AS is_known
FROM part LEFT JOIN s ON s.kind = {SESSION}
""")
def _(t):
    sessions = t.table("part").select("p_partkey", F.expr(SESSION).alias("session_type"))
    return tr.stimuli_by_session_type(sessions, "session_type")


def class_sql(value: str, classes) -> str:
    cases = " ".join(f"WHEN {v!r} THEN {i}" for i, v in enumerate(classes))
    return f"CAST(CASE {value} {cases} END AS BIGINT)"


EIGHT = [45.0 * i for i in range(8)]
TWELVE = [30.0 * i for i in range(12)]


@query("grating_labels", f"""
WITH l AS (SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey, l_tax,
    (l_linenumber - 1) * 45.0::DOUBLE AS o8,
    CASE WHEN l_returnflag <> 'N' THEN (l_linenumber - 1) * 30.0::DOUBLE END AS o12,
    l_discount * 100 AS tf, l_discount + 0.001::DOUBLE AS sf, (l_linenumber - 1) / 4.0::DOUBLE AS ph
    FROM lineitem)
SELECT 'drifting' AS kind, l_orderkey, l_partkey, l_linenumber, {class_sql("o8", EIGHT)}
    AS orientation_id, {class_sql("round_even(tf, 0)", tr.TEMPORAL_FREQUENCIES)} AS frequency_id,
    NULL AS phase_id FROM l WHERE l_tax = 0
UNION ALL SELECT 'static', l_orderkey, l_partkey, l_linenumber, {class_sql("o12", TWELVE)},
    {class_sql("round_even(sf, 2)", tr.SPATIAL_FREQUENCIES)}, {class_sql("ph * 360", tr.PHASES)}
    FROM l WHERE o12 IS NOT NULL
""")
def _(t):
    line = F.col("l_linenumber")
    rows = t.table("lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        "l_tax",
        ((line - 1) * 45.0).alias("o8"),
        F.when(F.col("l_returnflag") != "N", (line - 1) * 30.0).alias("o12"),
        (F.col("l_discount") * 100).alias("tf"),
        (F.col("l_discount") + 0.001).alias("sf"),
        ((line - 1) / F.lit(4.0)).alias("ph"),
    )
    ids = ["l_orderkey", "l_partkey", "l_linenumber"]
    drifting = tr.drifting_labels(rows, "l_tax", "o8", "tf").select(
        F.lit("drifting").alias("kind"),
        *ids,
        "orientation_id",
        F.col("temporal_frequency_id").alias("frequency_id"),
        F.lit(None).cast("bigint").alias("phase_id"),
    )
    static = tr.static_labels(rows, "o12", "sf", "ph").select(
        F.lit("static").alias("kind"),
        *ids,
        "orientation_id",
        F.col("spatial_frequency_id").alias("frequency_id"),
        "phase_id",
    )
    return drifting.unionByName(static)


MOVIES = {"A": "natural_movie_one", "N": "natural_movie_two", "R": "natural_movie_three"}


def frame_table(t):
    return stimuli(t).withColumns({"frame": F.col("l_partkey"), "repeat": F.col("l_linenumber")})


@query("movie_frames", f"""
WITH {EVENTS_CTE}, {FRAMES} SELECT CASE l_returnflag WHEN 'A' THEN 'natural_movie_one'
    WHEN 'N' THEN 'natural_movie_two' ELSE 'natural_movie_three' END AS movie,
    user_id, start_us, end_us, l_partkey AS frame, l_linenumber AS repeat,
    (start_us + end_us) / 2 AS timestamps FROM framed
""")
def _(t):
    movie = F.col("l_returnflag")
    named = frame_table(t).withColumn(
        "movie", F.create_map(*[F.lit(x) for kv in MOVIES.items() for x in kv])[movie]
    )
    return us(tr.movie_frames(named, ev(t), ["user_id"], "t", ["movie", "frame", "repeat"]))


@query("natural_scenes", f"""
WITH {EVENTS_CTE}, {FRAMES} SELECT user_id, start_us, end_us, l_linenumber AS frame_,
    CAST(l_linenumber + 1 AS BIGINT) AS frame, (start_us + end_us) / 2 AS timestamps
FROM framed
""")
def _(t):
    table = stimuli(t).withColumn("frame", F.col("l_linenumber"))
    got = tr.natural_scenes(table, ev(t), ["user_id"], "t", "frame")
    return us(got.withColumn("frame_", (F.col("frame") - 1).cast("int")))


@query("sparse_noise_union", f"""
WITH {EVENTS_CTE}, {FRAMES}, z AS (SELECT user_id, start_us, end_us, l_partkey AS frame,
    CASE WHEN l_returnflag = 'A' THEN 4.65::DOUBLE ELSE 9.3::DOUBLE END AS pixel_size
    FROM framed WHERE start_us IS NOT NULL)
SELECT *, row_number() OVER (PARTITION BY user_id
    ORDER BY start_us, end_us NULLS FIRST, pixel_size, frame) - 1 AS idx FROM z
""")
def _(t):
    rows = frame_table(t)
    tables = [rows.filter("l_returnflag = 'A'"), rows.filter("l_returnflag <> 'A'")]
    got = tr.sparse_noise_union(tables, ev(t), ["user_id"], "t", ["frame"], ["frame"])
    return us(got.drop("timestamps"))


@query("interval_midpoint", f"""
SELECT o_orderkey, (epoch_us(o_orderdate) + epoch_us(o_orderdate)
    + CAST(floor(o_totalprice) AS BIGINT)) / 2 AS timestamps FROM orders
""")
def _(t):
    spans = t.orders.select(
        "o_orderkey",
        F.col("t").alias("start"),
        (F.col("t") + F.floor("o_totalprice")).alias("end"),
    )
    return tr.interval_midpoint(spans).select("o_orderkey", "timestamps")


@query("stimulus_epochs", f"""
WITH {EVENTS_CTE} SELECT user_id, event_type || '_domain' AS stimulus, t AS start_us,
    t + {HOUR} AS end_us, row_number() OVER (PARTITION BY user_id, event_type ORDER BY t) - 1
    AS epoch FROM e
""")
def _(t):
    epochs = ev(t, F.col("event_type").alias("stimulus")).select(
        "user_id", "stimulus", F.col("t").alias("start"), (F.col("t") + HOUR).alias("end")
    )
    return us(tr.stimulus_epochs(epochs, ["user_id"], "stimulus"))


# BOTH
STAGE = """CASE event_type WHEN 'view' THEN 'Sleep stage W' WHEN 'click' THEN 'Sleep stage 1'
    WHEN 'purchase' THEN 'Sleep stage R' WHEN 'signup' THEN 'Sleep stage ?' ELSE 'Lights off' END"""


@query("stage_intervals", f"""
WITH {EVENTS_CTE} SELECT event_id, user_id, t AS start_us,
    t + CAST(floor(value * {SECOND}) AS BIGINT) AS end_us, {STAGE} AS name,
    CAST(CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 WHEN 'purchase' THEN 5
        WHEN 'signup' THEN 6 END AS BIGINT) AS id FROM e
""")
def _(t):
    rows = t.events.select(
        "event_id",
        "user_id",
        "t",
        F.floor(F.col("value") * SECOND).alias("d"),
        F.expr(STAGE).alias("name"),
    )
    return us(tr.stage_intervals(rows, "t", "d", "name").drop("t", "d"))


@query("union_epoch_domain", f"""
WITH {EVENTS_CTE}, z AS (SELECT user_id, t AS s, t + {10 * HOUR} AS e_ FROM e
    WHERE event_type = 'click' UNION ALL
    SELECT user_id, t, t + {4 * HOUR} FROM e WHERE event_type = 'view')
SELECT user_id, s AS start_us, e_ AS end_us, row_number() OVER w - 1 AS idx,
    coalesce(max(e_) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > s, false)
        AS overlaps FROM z WINDOW w AS (PARTITION BY user_id ORDER BY s, e_)
""")
def _(t):
    got = tr.union_epoch_domain(
        t.windows("click", 10 * HOUR), t.windows("view", 4 * HOUR), ["user_id"]
    )
    return us(got)


@query("trial_extent", """
SELECT l_orderkey, l_returnflag, epoch_us(min(l_shipdate)) AS start_us,
    epoch_us(max(l_shipdate)) AS end_us FROM lineitem GROUP BY l_orderkey, l_returnflag
""")
def _(t):
    return us(tr.trial_extent(t.lineitem, ["l_orderkey", "l_returnflag"], "t"))


@query("trial_series_concat", """
WITH v AS (SELECT label, vec_id, embedding || embedding[1:vec_id % 64] AS x FROM embeddings),
o AS (SELECT *, coalesce(sum(len(x)) OVER (PARTITION BY label ORDER BY vec_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM v)
SELECT label, vec_id, CAST(off + k AS BIGINT) AS idx, CAST(x[k + 1] AS DOUBLE) AS v
FROM o, LATERAL (SELECT unnest(range(len(x))) AS k)
""")
def _(t):
    # whole vectors, followed by a head of their own, so that lengths differ
    head = F.slice("embedding", F.lit(1), (F.col("vec_id") % 64).cast("int"))
    ragged = t.table("embeddings").select("label", "vec_id", F.concat("embedding", head).alias("x"))
    got = tr.trial_series_concat(ragged, ["label"], "vec_id", "x")
    return got.withColumn("v", F.col("v").cast("double"))


@query("event_window", f"""
WITH {EVENTS_CTE} SELECT event_id, t - 50000 AS start_us, t + 650000 AS end_us FROM e
""")
def _(t):
    return us(tr.event_window(t.events.select("event_id", "t"), "t").drop("t"))


@query("windows_to_intervals", """
SELECT event_id, event_type AS label, round(event_id * 100 / 2048.0::DOUBLE, 6) AS start_s,
    round((event_id * 100 + 2048) / 2048.0::DOUBLE, 6) AS end_s FROM events
""")
def _(t):
    rows = t.events.select(
        "event_id",
        F.col("event_type").alias("label"),
        (F.col("event_id") * 100).alias("first"),
        (F.col("event_id") * 100 + 2048).alias("last"),
    )
    got = tr.windows_to_intervals(rows, "first", "last", 2048)
    return got.select(
        "event_id",
        "label",
        F.round("start", 6).alias("start_s"),
        F.round("end", 6).alias("end_s"),
    )
