"""Split operators on users, orders and event windows."""

from pyspark.sql import functions as F

from kymo.bindings.registry import (
    DAY,
    EVENTS_CTE,
    HOUR,
    MINUTE,
    SECOND,
    hash_mod_sql,
    query,
    sweep_cte,
    windows_cte,
)
from kymo.functions import hashing as hs
from kymo.operators import splits as sp


def dbl(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


def part_sql(rank: str, total: str, ratios) -> str:
    """Part name from a rank, the SQL twin of ``part_by_rank``."""
    whole = float(sum(ratios))
    one = dbl(float(ratios[0]) / whole)
    text = f"CASE WHEN {rank} <= floor({total} * {one} + 0.5) THEN 'train'"
    if len(ratios) == 3:
        two = dbl(float(ratios[0] + ratios[1]) / whole)
        text += f" WHEN {rank} <= floor({total} * {two} + 0.5) THEN 'valid'"
    return text + " ELSE 'test' END"


def ranked_sql(keys: str, ident: str, seed="42") -> str:
    order = f"md5(CAST({ident} AS VARCHAR) || '_{seed}'), {ident}"
    return (
        f"row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn, "
        f"count(*) OVER (PARTITION BY {keys}) AS n"
    )


USERS = "u AS (SELECT DISTINCT user_id, CAST(user_id AS VARCHAR) AS id FROM events)"


def users(t):
    return t.events.select("user_id").distinct()


def kfold_sql(base: str, n: int, ratio: float = 0.2) -> str:
    """Part of the fold in column ``k`` for the text ``base`` (id and seed)."""
    share = hash_mod_sql(f"({base} || '_' || k)", 10000)
    return (
        f"CASE WHEN {hash_mod_sql(base, n)} = k THEN 'test' "
        f"WHEN {share} / 10000.0 < {ratio} THEN 'valid' ELSE 'train' END"
    )


@query("string_hash_mod", f"""
WITH {USERS} SELECT user_id, CAST({hash_mod_sql("id", 3)} AS BIGINT) AS mod_3,
    CAST({hash_mod_sql("(id || '_42')", 10000)} AS BIGINT) AS mod_10000 FROM u
""")
def _(t):
    ident = F.col("user_id").cast("string")
    return users(t).select(
        "user_id",
        hs.string_hash_mod(ident, 3).alias("mod_3"),
        hs.string_hash_mod(F.concat(ident, F.lit("_42")), 10000).alias("mod_10000"),
    )


@query("string_kfold", f"""
WITH {USERS}, f AS (SELECT *, CAST(unnest(range(3)) AS INTEGER) AS k FROM u)
SELECT user_id, k AS fold, {kfold_sql("(id || '_42')", 3)} AS split FROM f
""")
def _(t):
    return sp.kfold_table(users(t), "user_id", 3, 0.2, 42)


SHARE = f"({hash_mod_sql("(id || '_42')", 10000)} / CAST(10000 AS DOUBLE))"
THREE = (
    f"CASE WHEN {SHARE} < {dbl(0.7)} THEN 'train' "
    f"WHEN {SHARE} < {dbl(0.7 + 0.1)} THEN 'valid' ELSE 'test' END"
)


@query("hash_three_way", f"""
WITH {EVENTS_CTE}, d AS (SELECT user_id, CAST(user_id AS VARCHAR) AS id, min(t) AS s, max(t) AS e_
    FROM e GROUP BY user_id)
SELECT user_id, s AS start_us, e_ AS end_us, {THREE} AS split FROM d
""")
def _(t):
    d = t.user_domain().withColumnsRenamed({"start": "start_us", "end": "end_us"})
    return sp.hash_assignment(d, "user_id", (0.7, 0.1, 0.2), 42)


CAUSAL = f"""
d AS (SELECT user_id, min(t) AS s, max(t) AS e_ FROM e GROUP BY user_id),
c AS (SELECT *, s + CAST(floor((e_ - s) * {dbl(0.7)}) AS BIGINT) AS c1 FROM d),
c2 AS (SELECT *, c1 + CAST(floor((e_ - s) * {dbl(0.1)}) AS BIGINT) AS c2 FROM c),
c3 AS (SELECT *, c2 + CAST(floor((e_ - s) * {dbl(0.2)}) AS BIGINT) AS c3 FROM c2),
causal AS (SELECT user_id, 'train' AS split, s AS start_us, c1 AS end_us FROM c3
    UNION ALL SELECT user_id, 'valid', c1, c2 FROM c3
    UNION ALL SELECT user_id, 'test', c2, c3 FROM c3)"""


@query("causal_ratio_split", f"WITH {EVENTS_CTE}, {CAUSAL} SELECT * FROM causal")
def _(t):
    cut = sp.causal_ratio_split(t.user_domain(), (0.7, 0.1, 0.2))
    return cut.withColumnsRenamed({"start": "start_us", "end": "end_us"})


def folds_sql(source: str, keys: str, label: str, ident: str, n: int, keep: str) -> str:
    """CTE ``folds``: the stratified folds of ``source``."""
    group = f"{keys}, {label}" if keys else label
    part = f"PARTITION BY {keys}" if keys else ""
    fold_part = f"PARTITION BY {keys}, fold" if keys else "PARTITION BY fold"
    return f"""
fc AS (SELECT {group}, count(*) AS c FROM {source} GROUP BY {group}),
fo AS (SELECT {group}, sum(c) OVER ({part} ORDER BY {label}) - c AS before FROM fc),
fr AS (SELECT *, {ranked_sql(group, ident)} FROM {source}),
fk AS (SELECT fr.* EXCLUDE (rn, n), k AS fold, (before + rn - 1) % {n} = k AS home
    FROM fr JOIN fo USING ({group}), (SELECT CAST(unnest(range({n})) AS INTEGER) AS k) q),
fs AS (SELECT *, row_number() OVER (PARTITION BY {group}, fold, home
        ORDER BY md5(CAST({ident} AS VARCHAR) || '_' || (fold + 42)), {ident}) AS rn FROM fk),
fe AS (SELECT {group}, fold, count(*) AS rest FROM fk WHERE NOT home GROUP BY {group}, fold),
fn AS (SELECT *, sum(rest) OVER ({fold_part}) AS nr FROM fe),
ft AS (SELECT *, nr - CAST(ceil(nr * {dbl(0.2)}) AS BIGINT) AS nt FROM fn),
fw AS (SELECT *, rest * nt // nr AS whole, rest * nt % nr AS part FROM ft),
fv AS (SELECT *, rest - whole - CASE WHEN row_number() OVER ({fold_part} ORDER BY part DESC, {label})
    <= nt - sum(whole) OVER ({fold_part}) THEN 1 ELSE 0 END AS n_valid FROM fw),
folds AS (SELECT {keep}, fold, CASE WHEN home THEN 'test'
    WHEN rn <= n_valid THEN 'valid' ELSE 'train' END AS split
    FROM fs LEFT JOIN fv USING ({group}, fold))"""


@query("stratified_folds", f"""
WITH {EVENTS_CTE}, {folds_sql("e", "", "event_type", "event_id", 5, "event_id, event_type")}
SELECT * FROM folds
""")
def _(t):
    return sp.stratified_folds(
        t.events.select("event_id", "event_type"), [], "event_type", "event_id"
    )


@query("rare_class_filter", """
WITH k AS (SELECT event_id, user_id, event_type FROM events WHERE event_type <> 'error'),
c AS (SELECT *, count(*) OVER (PARTITION BY user_id, event_type) AS n FROM k)
SELECT event_id, user_id, event_type FROM c WHERE n >= 12
""")
def _(t):
    e = t.events.select("event_id", "user_id", "event_type")
    return sp.rare_class_filter(e, ["user_id"], "event_type", 12, ["error"]).select(
        "event_id", "user_id", "event_type"
    )


STAGE_CODES = {"view": 0, "click": 1, "purchase": 2, "signup": 5, "error": 6}
STAGE_CASE = " ".join(f"WHEN '{k}' THEN {v}" for k, v in STAGE_CODES.items())
STAGES_CTE = f"""
w AS (SELECT event_id, user_id, t, CAST(floor(value * {MINUTE}) AS BIGINT) AS d,
    CASE event_type {STAGE_CASE} END AS id FROM e),
ep AS (SELECT event_id, user_id, id, t + k * {30 * MINUTE} AS start_us,
    t + (k + 1) * {30 * MINUTE} AS end_us FROM w,
    LATERAL (SELECT unnest(range(CAST(d // {30 * MINUTE} AS BIGINT))) AS k)),
ek AS (SELECT *, event_id || '_' || start_us AS eid, count(*) OVER (PARTITION BY user_id, id) AS c
    FROM ep WHERE id <> 6),
ef AS (SELECT * EXCLUDE (c) FROM ek WHERE c >= 3)"""


def stages(t):
    code = F.create_map(*[F.lit(x) for kv in STAGE_CODES.items() for x in kv])
    return t.events.select(
        "event_id",
        "user_id",
        code[F.col("event_type")].alias("id"),
        F.col("t").alias("start"),
        (F.col("t") + F.floor(F.col("value") * MINUTE)).alias("end"),
    )


@query("sleep_splits", f"""
WITH {EVENTS_CTE}, {STAGES_CTE},
{folds_sql("ef", "user_id", "id", "eid", 3, "event_id, user_id, id, start_us, end_us")}
SELECT event_id, user_id, id, start_us, end_us, fold, split,
    (SELECT {kfold_sql("(CAST(user_id AS VARCHAR) || '_42')", 3)} FROM (SELECT fold AS k))
        AS intersubject,
    (SELECT {kfold_sql("(user_id || '_' || user_id || '_42')", 3)} FROM (SELECT fold AS k))
        AS intersession
FROM folds
""")
def _(t):
    got = sp.sleep_splits(
        stages(t), "user_id", "user_id", "user_id", "event_id", "id", [6], 30 * MINUTE
    )
    return got.withColumnsRenamed({"start": "start_us", "end": "end_us"})


def order_intervals(t):
    return t.orders.select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.col("t").alias("start"),
        (F.col("t") + DAY).alias("end"),
    )


@query("interval_split_shuffled", f"""
WITH r AS (SELECT o_orderkey, o_custkey, {ranked_sql("o_custkey", "o_orderkey")} FROM orders)
SELECT o_orderkey, o_custkey, {part_sql("rn", "n", (0.7, 0.1, 0.2))} AS split FROM r
""")
def _(t):
    got = sp.interval_split_shuffled(
        order_intervals(t), ["o_custkey"], "o_orderkey", (0.7, 0.1, 0.2)
    )
    return got.select("o_orderkey", "o_custkey", "split")


@query("interval_split_ordered", f"""
WITH r AS (SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey
        ORDER BY o_orderdate, o_orderkey) AS rn,
    count(*) OVER (PARTITION BY o_custkey) AS n FROM orders)
SELECT o_orderkey, o_custkey, {part_sql("rn", "n", (0.6, 0.1, 0.3))} AS split FROM r
""")
def _(t):
    got = sp.interval_split_ordered(
        order_intervals(t), ["o_custkey"], (0.6, 0.1, 0.3), ["o_orderkey"]
    )
    return got.select("o_orderkey", "o_custkey", "split")


VALID_SHARE = 0.1 / (1.0 - 0.2 - 0.1 + 0.1)


@query("two_stage_trial_split", f"""
WITH r AS (SELECT o_orderkey, o_custkey, {ranked_sql("o_custkey", "o_orderkey")} FROM orders),
h AS (SELECT o_orderkey, o_custkey, rn <= ceil(n * {dbl(0.2)}) AS held FROM r),
r2 AS (SELECT *, {ranked_sql("o_custkey, held", "o_orderkey", "42b")} FROM h)
SELECT o_orderkey, o_custkey, CASE WHEN held THEN 'test'
    WHEN rn <= ceil(n * {dbl(VALID_SHARE)}) THEN 'valid' ELSE 'train' END AS split FROM r2
""")
def _(t):
    o = t.orders.select("o_orderkey", "o_custkey")
    return sp.two_stage_trial_split(o, ["o_custkey"], "o_orderkey")


@query("train_is_rest_dilated", f"""
WITH {EVENTS_CTE}, {windows_cte("a", "click", 6 * HOUR)},
d AS (SELECT user_id, min(t) AS s, max(t) AS e_ FROM e GROUP BY user_id),
w AS (SELECT user_id, s - {SECOND} AS s, e_ + {SECOND} AS e_ FROM a),
{sweep_cte("r", "user_id", "d", "w", "ca > 0 AND cb = 0")}
SELECT user_id, s AS start_us, e_ AS end_us FROM r
""")
def _(t):
    got = sp.train_is_rest_dilated(
        t.user_domain(), t.windows("click", 6 * HOUR), ["user_id"], SECOND
    )
    return got.withColumnsRenamed({"start": "start_us", "end": "end_us"})


@query("invalid_trials_to_train", f"""
WITH v AS (SELECT o_orderkey, o_custkey, o_orderstatus <> 'P' AS is_valid FROM orders),
r AS (SELECT *, {ranked_sql("o_custkey, is_valid", "o_orderkey")} FROM v)
SELECT o_orderkey, o_custkey, is_valid, CASE WHEN NOT is_valid THEN 'train' ELSE
    {part_sql("rn", "n", (0.7, 0.1, 0.2))} END AS split FROM r
""")
def _(t):
    o = t.orders.select(
        "o_orderkey", "o_custkey", (F.col("o_orderstatus") != "P").alias("is_valid")
    )
    return sp.invalid_trials_to_train(o, ["o_custkey"], "o_orderkey", "is_valid")


@query("predefined_split", f"""
WITH m AS (SELECT doc_id, CASE WHEN quality = 1 THEN 'train' ELSE 'val' END AS part,
    quality <> 1 AS held FROM labels),
r AS (SELECT *, {ranked_sql("held", "doc_id")} FROM m)
SELECT doc_id, part, CASE WHEN held THEN 'test'
    WHEN rn <= floor(n * {dbl(0.8)} + 0.5) THEN 'train' ELSE 'valid' END AS split FROM r
""")
def _(t):
    marked = t.table("labels").select(
        "doc_id", F.when(F.col("quality") == 1, "train").otherwise("val").alias("part")
    )
    return sp.predefined_split(marked, [], "doc_id", "part")


# Epochs are one-hour windows; a group is one user, type and six-day block.
BLOCK = 6 * DAY
EPOCHS = f"""
ep AS (SELECT user_id, event_type, t // {BLOCK} AS week, t AS s, t + {HOUR} AS e_ FROM e),
g AS (SELECT user_id, t // {BLOCK} AS week, t - {10 * MINUTE} AS s, t + {20 * MINUTE} AS e_
    FROM e)"""
GROUP = "user_id, event_type, week"


def epochs(t):
    return t.events.select(
        "user_id",
        "event_type",
        F.expr(f"t div {BLOCK}").alias("week"),
        F.col("t").alias("start"),
        (F.col("t") + HOUR).alias("end"),
    )


def grid(t):
    return t.events.select(
        "user_id",
        F.expr(f"t div {BLOCK}").alias("week"),
        (F.col("t") - 10 * MINUTE).alias("start"),
        (F.col("t") + 20 * MINUTE).alias("end"),
    )


def share_of(x: float) -> str:
    return f"CAST(floor((e_ - s) * {dbl(x)}) AS BIGINT)"


def snap_sql(source: str, name: str, at: str) -> str:
    return f"""
{name}_j AS (SELECT c.*, min(g.s) AS gs, arg_min(g.e_, g.s) AS ge FROM {source} c LEFT JOIN g
    ON g.user_id = c.user_id AND g.week = c.week AND g.s <= c.{at} AND c.{at} < g.e_
    GROUP BY ALL),
{name} AS (SELECT * EXCLUDE (gs, ge), CAST(CASE WHEN gs IS NULL THEN {at}
    WHEN {at} - gs > ge - {at} THEN ge ELSE gs END AS BIGINT) AS {at}_s FROM {name}_j)"""


EPOCH_SPLIT = f"""
pl AS (SELECT *, row_number() OVER (PARTITION BY {GROUP} ORDER BY s, e_) AS i,
    count(*) OVER (PARTITION BY {GROUP}) AS n FROM ep),
c0 AS (SELECT *, CASE WHEN n = 1 THEN s + {share_of(0.6)}
    WHEN n = 2 AND i = 1 THEN s + {share_of(0.5)}
    WHEN n = 3 AND i = 2 THEN e_ - {share_of(0.3)}
    WHEN n IN (4, 5) AND i = 3 THEN e_ - {share_of(0.5)} END AS one,
    CASE WHEN n = 1 THEN s + {share_of(0.6)} + {share_of(0.1)} END AS two FROM pl),
{snap_sql("c0", "c1", "one")}, {snap_sql("c1", "c2", "two")},
pieces AS (
    SELECT {GROUP}, n, 'train' AS split, s AS s, one_s AS e_ FROM c2 WHERE one IS NOT NULL
    UNION ALL SELECT {GROUP}, n, 'valid', one_s, two_s FROM c2 WHERE n = 1
    UNION ALL SELECT {GROUP}, n, 'test', two_s, e_ FROM c2 WHERE n = 1
    UNION ALL SELECT {GROUP}, n, 'valid', one_s, e_ FROM c2 WHERE n > 1 AND one IS NOT NULL
    UNION ALL SELECT {GROUP}, n, CASE
        WHEN n = 2 THEN 'test'
        WHEN n = 3 THEN CASE WHEN i = 3 THEN 'test' ELSE 'train' END
        WHEN n = 4 THEN CASE WHEN i = 4 THEN 'test' ELSE 'train' END
        WHEN n = 5 THEN CASE WHEN i >= 4 THEN 'test' ELSE 'train' END
        ELSE {part_sql("i", "n", (0.6, 0.1, 0.3))} END, s, e_ FROM c2 WHERE one IS NULL)"""


@query("snap_to_grid", f"""
WITH {EVENTS_CTE}, {EPOCHS},
c0 AS (SELECT user_id, week, event_type, s, s + {15 * MINUTE} AS t FROM ep),
{snap_sql("c0", "c1", "t")}
SELECT user_id, week, event_type, t, t_s AS snapped FROM c1
""")
def _(t):
    points = epochs(t).select(
        "user_id", "week", "event_type", (F.col("start") + 15 * MINUTE).alias("t")
    )
    return sp.snap_to_grid(points, grid(t), ["user_id", "week"])


def _epoch_query(name: str, n: int):
    @query(name, f"""
    WITH {EVENTS_CTE}, {EPOCHS}, {EPOCH_SPLIT}
    SELECT {GROUP}, split, s AS start_us, e_ AS end_us FROM pieces WHERE n = {n}
    """)
    def _(t):
        got = sp.epoch_split(
            epochs(t), grid(t), ["user_id", "event_type", "week"], ["user_id", "week"], only=n
        ).drop("n_epochs")
        return got.withColumnsRenamed({"start": "start_us", "end": "end_us"})


for _name, _n in (
    ("split_one_epoch", 1),
    ("split_two_epochs", 2),
    ("split_three_epochs", 3),
    ("split_four_epochs", 4),
    ("split_five_epochs", 5),
):
    _epoch_query(_name, _n)


@query("epoch_split_dispatch", f"""
WITH {EVENTS_CTE}, {EPOCHS}, {EPOCH_SPLIT},
kept AS (SELECT user_id, week, split, s, e_ FROM pieces WHERE event_type <> 'error'),
{sweep_cte("r", "user_id, week, split", "kept", None, "ca > 0")}
SELECT user_id, week, split, s AS start_us, e_ AS end_us FROM r
""")
def _(t):
    got = sp.epoch_split_dispatch(
        epochs(t), grid(t), ["user_id", "week"], "event_type", ("error",)
    )
    return got.withColumnsRenamed({"start": "start_us", "end": "end_us"})


@query("coverage_ranked_split", f"""
WITH {EVENTS_CTE}, {windows_cte("p", "purchase", 4 * HOUR)},
d AS (SELECT user_id, min(t) AS s, max(t) AS e_ FROM e GROUP BY user_id),
pu AS (SELECT DISTINCT user_id FROM p),
{sweep_cte("a0", "user_id", "d", "p", "ca > 0 AND cb = 0")},
a AS (SELECT * FROM a0 WHERE e_ - s > {10 * HOUR} OR user_id NOT IN (SELECT user_id FROM pu)),
sp AS (SELECT user_id, min(s) AS s, max(e_) AS e_ FROM a GROUP BY user_id),
k AS (SELECT user_id, k AS block, s + CAST(floor((e_ - s) * k / 10) AS BIGINT) AS s,
    s + CAST(floor((e_ - s) * (k + 1) / 10) AS BIGINT) AS e_
    FROM sp, (SELECT CAST(unnest(range(10)) AS INTEGER) AS k) q),
cv AS (SELECT k.user_id, k.block, k.s, k.e_, CAST(coalesce(sum(CASE WHEN a.s IS NULL THEN 0
    ELSE least(k.e_, a.e_) - greatest(k.s, a.s) END), 0) AS BIGINT) AS c FROM k LEFT JOIN a
    ON a.user_id = k.user_id AND a.s < k.e_ AND k.s < a.e_
    GROUP BY k.user_id, k.block, k.s, k.e_),
rk AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY
    CASE WHEN user_id IN (SELECT user_id FROM pu)
        THEN CAST(floor(c / CAST(e_ - s AS DOUBLE) * 1000000) AS BIGINT) ELSE 0 END,
    md5(user_id || '_' || block || '_42'), block) AS rn FROM cv),
tg AS (SELECT user_id, CASE WHEN rn <= 8 THEN 'train' WHEN rn <= 9 THEN 'valid' ELSE 'test' END
    AS split, s, e_ FROM rk),
ps AS (SELECT user_id, split, s, e_ FROM p,
    (SELECT unnest(['train', 'valid', 'test']) AS split) q),
{sweep_cte("r", "user_id, split", "tg", "ps", "ca > 0 AND cb = 0")}
SELECT user_id, split, s AS start_us, e_ AS end_us FROM r
WHERE e_ - s > {10 * HOUR} OR user_id NOT IN (SELECT user_id FROM pu)
""")
def _(t):
    got = sp.coverage_ranked_split(
        t.user_domain(), t.windows("purchase", 4 * HOUR), ["user_id"], 10, 10 * HOUR
    )
    return got.withColumnsRenamed({"start": "start_us", "end": "end_us"})


@query("half_role_split", """
WITH r AS (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id
        ORDER BY event_id) AS rn, count(*) OVER (PARTITION BY user_id) AS n FROM events)
SELECT event_id, user_id, 'train' AS split FROM r
UNION ALL SELECT event_id, user_id, CASE WHEN rn <= n // 2 THEN 'valid' ELSE 'test' END FROM r
""")
def _(t):
    e = t.events.select("event_id", "user_id")
    return sp.half_role_split(e, ["user_id"], "event_id", ["event_id"])
