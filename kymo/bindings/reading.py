"""Reading by split, on splits derived from users and windows."""

import pandas as pd
from pyspark.sql import functions as F

from kymo.bindings.registry import DAY, EVENTS_CTE, HOUR, query, sweep_cte, windows_cte
from kymo.bindings.splits import CAUSAL, THREE, kfold_sql
from kymo.bindings.units import USED, masks
from kymo.functions.hashing import string_kfold
from kymo.operators import selection as sel
from kymo.operators import splits as sp

KEYS = ["user_id"]
RATIOS = (0.7, 0.1, 0.2)


def us(df):
    return df.withColumnsRenamed({"start": "start_us", "end": "end_us"})


def stored(t):
    return sp.causal_ratio_split(t.user_domain(), RATIOS)


@query("sampling_intervals", f"""
WITH {EVENTS_CTE}, {CAUSAL} SELECT user_id, 'val' AS asked, start_us, end_us FROM causal
WHERE split = 'valid' UNION ALL SELECT user_id, 'train', start_us, end_us FROM causal
WHERE split = 'train' UNION ALL SELECT user_id, 'all', s, e_ FROM d
""")
def _(t):
    domains, splits = t.user_domain(), stored(t)
    asked = [
        sel.sampling_intervals(domains, splits, KEYS, name).withColumn(
            "asked", F.lit(name or "all")
        )
        for name in ("val", "train", None)
    ]
    return us(asked[0].unionByName(asked[1]).unionByName(asked[2]))


@query("sampling_intervals_joint", f"""
WITH {EVENTS_CTE}, {CAUSAL}, {windows_cte("a", "click", 30 * HOUR)},
{windows_cte("b", "view", 40 * HOUR)},
tn AS (SELECT user_id, start_us AS s, end_us AS e_ FROM causal WHERE split = 'train'),
{sweep_cte("one", "user_id", "tn", "a", "ca > 0 AND cb > 0")},
{sweep_cte("two", "user_id", "one", "b", "ca > 0 AND cb > 0")}
SELECT user_id, s AS start_us, e_ AS end_us FROM two
""")
def _(t):
    others = [t.windows("click", 30 * HOUR), t.windows("view", 40 * HOUR)]
    return us(sel.sampling_intervals_joint(t.user_domain(), stored(t), others, KEYS, "train"))


FOLD_ASSIGNMENT = kfold_sql("(CAST(user_id AS VARCHAR) || '_42')", 3)


@query("sampling_intervals_fold", f"""
WITH {EVENTS_CTE}, {CAUSAL}, k AS (SELECT d.*, q.k FROM d, (SELECT unnest([1, 2]) AS k) q),
p AS (SELECT user_id, s, e_, k, {FOLD_ASSIGNMENT} AS part FROM k),
m AS (SELECT user_id, s, e_, max(CASE WHEN k = CASE WHEN user_id % 3 = 0 THEN 2 ELSE 1 END
    THEN part END) AS part FROM p GROUP BY ALL)
SELECT user_id, 'intersubject' AS scheme, s AS start_us, e_ AS end_us FROM m WHERE part = 'train'
UNION ALL SELECT user_id, 'intrasession', start_us, end_us FROM causal WHERE split = 'train'
""")
def _(t):
    domains = t.user_domain()
    folds = stored(t).withColumn("fold", F.lit(1))
    parts = string_kfold(F.col("user_id").cast("string"), 3)
    users = domains.select("user_id")
    # one user in three has only the older record, holding another fold's part
    newer = users.filter(F.col("user_id") % 3 != 0).select(
        "user_id", F.lit("intersubject").alias("scheme"), parts[1].alias("split")
    )
    older = users.select("user_id", F.lit("any").alias("scheme"), parts[2].alias("split"))
    assignments = newer.unionByName(older).withColumn("fold", F.lit(1))
    asked = [
        sel.sampling_intervals_fold(
            domains, folds, assignments, KEYS, scheme, 1, "train"
        ).withColumn("scheme", F.lit(scheme))
        for scheme in ("intersubject", "intrasession")
    ]
    return us(asked[0].unionByName(asked[1]))


@query("sampling_intervals_ratio", f"""
WITH {EVENTS_CTE}, {CAUSAL}, h AS (SELECT *, CAST(user_id AS VARCHAR) AS id FROM d)
SELECT user_id, 'intersubject' AS scheme, CASE WHEN {THREE} = 'train' THEN s END AS start_us,
    CASE WHEN {THREE} = 'train' THEN e_ END AS end_us FROM h
UNION ALL SELECT user_id, 'intrasession', start_us, end_us FROM causal WHERE split = 'test'
""")
def _(t):
    domains = t.user_domain()
    across = sel.sampling_intervals_ratio(
        domains, KEYS, "train", "intersubject", RATIOS, "user_id"
    )
    within = sel.sampling_intervals_ratio(
        domains, KEYS, "test", "intrasession", RATIOS, "user_id"
    )
    return us(
        across.withColumn("scheme", F.lit("intersubject")).unionByName(
            within.withColumn("scheme", F.lit("intrasession"))
        )
    )


@query("sampling_intervals_selector", f"""
WITH {USED}, s AS (SELECT user_id, event_id % 3 AS selector, epoch_us(ts) AS st,
    epoch_us(ts) + {DAY} AS en FROM events WHERE value > 150),
r AS (SELECT DISTINCT user_id, CAST(q.k AS BIGINT) AS selector FROM events,
    (SELECT unnest([0, 1, 2, 3]) AS k) q),
a AS (SELECT user_id, selector, count(*) FILTER (used) AS n FROM mk GROUP BY user_id, selector)
SELECT r.user_id, r.selector, s.st AS start_us, s.en AS end_us, a.n AS n_channels,
    concat_ws(',', CASE WHEN s.st IS NULL THEN 'intervals' END,
        CASE WHEN a.n IS NULL THEN 'mask' END) AS missing
FROM r LEFT JOIN s ON s.user_id = r.user_id AND s.selector = r.selector
LEFT JOIN a ON a.user_id = r.user_id AND a.selector = r.selector
""")
def _(t):
    splits = t.events.filter(F.col("value") > 150).select(
        "user_id",
        (F.col("event_id") % 3).alias("selector"),
        F.col("t").alias("start"),
        (F.col("t") + DAY).alias("end"),
    )
    asked = F.explode(F.array(*[F.lit(i).cast("bigint") for i in range(4)]))
    requests = t.events.select("user_id").distinct().withColumn("selector", asked)
    return us(
        sel.sampling_intervals_selector(requests, splits, masks(t), ["user_id", "selector"])
    )


def scaled(df):
    """A caller's transform: one vector column from Python code."""

    @F.pandas_udf("double")
    def half_root(v: pd.Series) -> pd.Series:
        return (v**0.5 / 2).round(6)

    return df.withColumn("scaled", half_root("value"))


@query("user_transform",
       "SELECT event_id, value, round(sqrt(value) / 2, 6) AS scaled FROM events")
def _(t):
    return sel.user_transform(t.events.select("event_id", "value"), scaled)
