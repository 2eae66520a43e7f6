"""The flagship: events to segments, long ones only, summed per fold and part."""

from pyspark.sql import functions as F

from kymo.bindings.registry import EVENTS_CTE, HOUR, query
from kymo.bindings.series import OVER, ev
from kymo.bindings.splits import kfold_sql
from kymo.operators import intervals as iv
from kymo.operators import series as ts
from kymo.operators import splits as sp


@query("segment_fold_summary", f"""
WITH {EVENTS_CTE}, d AS (SELECT user_id, t, t - lag(t) {OVER} AS d FROM e),
md AS (SELECT user_id, median(d) AS md FROM d GROUP BY user_id),
f AS (SELECT d.*, md.md, CASE WHEN d.d > 2 * md.md THEN 1 ELSE 0 END AS f
    FROM d JOIN md USING (user_id)),
g AS (SELECT *, sum(f) {OVER} AS segment FROM f),
s AS (SELECT user_id, max(t) + coalesce(CAST(floor(any_value(md)) AS BIGINT), 10000) - min(t)
    AS len FROM g GROUP BY user_id, segment),
k AS (SELECT user_id, len, CAST(unnest(range(3)) AS INTEGER) AS k FROM s WHERE len > {6 * HOUR}),
p AS (SELECT user_id, len, k AS fold, {kfold_sql("(CAST(user_id AS VARCHAR) || '_42')", 3)} AS split
    FROM k)
SELECT fold, split, count(DISTINCT user_id) AS n_recordings, count(*) AS n_segments,
    CAST(sum(len) AS BIGINT) AS total_us FROM p GROUP BY fold, split
""")
def _(t):
    segments = ts.segment_by_median_gap(ev(t), ["user_id"], "t")
    kept = iv.interval_min_duration(segments, 6 * HOUR)
    per_user = kept.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("end") - F.col("start")).alias("us")
    )
    folds = sp.kfold_table(per_user, "user_id", 3, 0.2, 42)
    return folds.groupBy("fold", "split").agg(
        F.count(F.lit(1)).alias("n_recordings"),
        F.sum("n").alias("n_segments"),
        F.sum("us").alias("total_us"),
    )
