"""Unit and channel operators."""

from pyspark.sql import functions as F

from kymo.bindings.registry import EVENTS_CTE, query
from kymo.operators import units as un

VECTORS = """
v AS (SELECT vec_id, label, unnest(range(len(embedding))) AS k, unnest(embedding) AS x
    FROM embeddings)"""


@query("explode_spikes", f"""
WITH {VECTORS}, s AS (SELECT label, vec_id, CAST(floor(CAST(x AS DOUBLE) * 1000000) AS BIGINT) AS t
    FROM v WHERE x > 0.3),
u AS (SELECT label, vec_id, count(*) FILTER (x > 0.3) AS n FROM v GROUP BY label, vec_id)
SELECT 'spike' AS kind, label, vec_id, t, NULL AS count,
    row_number() OVER (PARTITION BY label ORDER BY t, vec_id) - 1 AS idx FROM s
UNION ALL SELECT 'unit', label, vec_id, NULL, n, NULL FROM u
""")
def _(t):
    times = F.transform(
        F.filter("embedding", lambda x: x.cast("double") > F.lit(0.3)),
        lambda x: F.floor(x.cast("double") * 1_000_000),
    )
    ragged = t.table("embeddings").select("label", "vec_id", times.alias("spikes"))
    spikes, table = un.explode_spikes(ragged, ["label"], "vec_id", "spikes")
    return spikes.withColumn("kind", F.lit("spike")).unionByName(
        table.withColumn("kind", F.lit("unit")), allowMissingColumns=True
    )


@query("unit_naming", """
WITH u AS (SELECT DISTINCT user_id, event_type FROM events), n AS (
SELECT user_id, event_type, 'group_' || event_type || '/elec' || user_id || '/multiunit_0' AS crossing,
    'group_' || event_type || '/elec' || user_id || '/unit_' || (user_id % 4) AS sorted,
    event_type || '/' || CASE WHEN user_id % 11 = 0 THEN 'unsorted'
        ELSE 'sorted_' || lpad(CAST(user_id % 11 AS VARCHAR), 2, '0') END AS channel,
    CASE WHEN user_id % 2 = 0 THEN 'mec_' ELSE 'hc_' END || user_id AS region FROM u)
SELECT n.*, count(*) OVER (PARTITION BY channel) > 1 AS is_duplicate FROM n
""")
def _(t):
    user, kind = F.col("user_id"), F.col("event_type")
    named = t.events.select("user_id", "event_type").distinct().withColumns(
        {
            "crossing": un.threshold_unit_name(kind, user),
            "sorted": un.sorted_unit_name(kind, user, user % 4),
            "channel": un.channel_unit_name(kind, user % 11),
            "region": un.region_unit_name(F.when(user % 2 == 0, "mec").otherwise("hc"), user),
        }
    )
    repeated = un.duplicate_names(named, [], "channel")
    return named.join(repeated, "channel", "left").withColumn(
        "is_duplicate", F.col("n_units").isNotNull()
    ).drop("n_units")


@query("dense_unit_index", """
WITH u AS (SELECT user_id, count(*) AS n FROM events GROUP BY user_id HAVING count(*) >= 60)
SELECT user_id, n, CASE WHEN user_id % 2 = 0 THEN 'mec' ELSE 'hc' END AS region,
    row_number() OVER (ORDER BY user_id % 2, user_id) - 1 AS unit_index FROM u
""")
def _(t):
    kept = (
        t.events.groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= 60)
        .withColumns(
            {
                "region": F.when(F.col("user_id") % 2 == 0, "mec").otherwise("hc"),
                "region_rank": (F.col("user_id") % 2).cast("bigint"),
            }
        )
    )
    indexed = un.dense_unit_index(kept, [], "region_rank", ["region_rank", "user_id"])
    return indexed.drop("region_rank")


@query("units_and_spikes_by_region", f"""
WITH {EVENTS_CTE}, s AS (SELECT event_type, user_id, t, event_id,
    CASE WHEN value < 40 THEN 'mec' ELSE 'hc' END AS location FROM e),
u AS (SELECT DISTINCT event_type, location, user_id FROM s),
i AS (SELECT *, row_number() OVER (PARTITION BY event_type
        ORDER BY location DESC, user_id) - 1 AS unit_index,
    location || '_' || (row_number() OVER (PARTITION BY event_type, location ORDER BY user_id) - 1)
        AS id FROM u)
SELECT s.event_type, s.location, s.user_id, s.t, i.unit_index, i.id,
    row_number() OVER (PARTITION BY s.event_type ORDER BY s.t, i.unit_index) - 1 AS idx
FROM s JOIN i ON i.event_type = s.event_type AND i.location = s.location AND i.user_id = s.user_id
""")
def _(t):
    e = t.events.select("event_type", "user_id", "t", "value")
    regions = {}
    for name, mine in (("mec", F.col("value") < 40), ("hc", F.col("value") >= 40)):
        spikes = e.filter(mine).select("event_type", "user_id", "t")
        regions[name] = (spikes.select("event_type", "user_id").distinct(), spikes)
    _, spikes = un.units_and_spikes_by_region(regions, ["event_type"], "user_id")
    return spikes


@query("average_waveform", f"""
WITH {VECTORS} SELECT label, CAST(k AS INTEGER) AS sample, round(avg(CAST(x AS DOUBLE)), 6) AS v
FROM v WHERE k < 48 GROUP BY label, k
""")
def _(t):
    got = un.average_waveform(t.table("embeddings"), ["label"], "embedding")
    return got.withColumn("v", F.round("v", 6))


@query("spike_trial_domain", """
SELECT l_orderkey, epoch_us(min(l_shipdate)) AS start_us, epoch_us(max(l_shipdate)) AS end_us
FROM lineitem GROUP BY l_orderkey
""")
def _(t):
    got = un.spike_trial_domain(t.lineitem, ["l_orderkey"], "t")
    return got.withColumnsRenamed({"start": "start_us", "end": "end_us"})


@query("cube_to_long", """
WITH b AS (SELECT l_orderkey, epoch_us(l_shipdate) AS t, l_linenumber AS channel,
    CAST(floor(l_quantity / 10) AS BIGINT) AS n FROM lineitem),
c AS (SELECT l_orderkey, t, channel, unnest(range(n)) + 1 AS copy FROM b)
SELECT l_orderkey, t, channel, copy,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY t, channel, copy) - 1 AS idx,
    'chan' || channel AS id FROM c
UNION ALL
SELECT NULL, NULL, channel, sum(n)::BIGINT, NULL, 'chan' || lpad(CAST(channel AS VARCHAR), 3, '0')
FROM b GROUP BY channel
""")
def _(t):
    bins = t.lineitem.select(
        "l_orderkey",
        "t",
        F.col("l_linenumber").alias("channel"),
        F.floor(F.col("l_quantity") / 10).cast("double").alias("n"),
    )
    long = un.cube_to_long(bins, ["l_orderkey"], "t", "channel", "n").withColumn(
        "id", F.concat(F.lit("chan"), "channel")
    )
    units = un.cube_units(bins, "channel", "n").select(
        "channel", F.col("count").alias("copy"), F.col("channel_name").alias("id")
    )
    return long.unionByName(units, allowMissingColumns=True)


NAMES = {"click": "EEG C3", "view": "EEG C4"}
TYPES = {"click": "EEG", "EEG C4": "EOG"}
POSITIONS = {"click": (0.1, 0.2, 0.3), "EEG C4": (0.4, 0.5, 0.6)}


def channels(t):
    return t.events.select("user_id", "event_type").distinct()


@query("channel_table", """
WITH c AS (SELECT DISTINCT user_id, event_type FROM events WHERE event_type <> 'error')
SELECT user_id, event_type,
    CASE event_type WHEN 'click' THEN 'EEG C3' WHEN 'view' THEN 'EEG C4' ELSE event_type END AS id,
    CASE event_type WHEN 'click' THEN 'eeg' WHEN 'view' THEN 'eog' ELSE 'misc' END AS type,
    CASE event_type WHEN 'click' THEN 0.1::DOUBLE WHEN 'view' THEN 0.4::DOUBLE
        ELSE 'nan'::DOUBLE END AS x,
    CASE event_type WHEN 'click' THEN 0.3::DOUBLE WHEN 'view' THEN 0.6::DOUBLE
        ELSE 'nan'::DOUBLE END AS z,
    event_type = 'signup' AS bad FROM c
""")
def _(t):
    raw = channels(t).withColumn("native", F.lit("MISC"))
    got = un.channel_table(
        raw, "event_type", "native", NAMES, TYPES, POSITIONS, ["error"], ["signup"]
    )
    return got.select(
        "user_id",
        "event_type",
        "id",
        "type",
        F.col("pos")[0].alias("x"),
        F.col("pos")[2].alias("z"),
        "bad",
    )


# A rename map per brand: part names to names of the same small vocabulary.
RENAMES = """
m AS (SELECT p_brand, p_name AS source, min(p_partkey) AS pos,
    arg_min(CASE WHEN p_size < 40 THEN lower(p_type) || '_' || p_partkey
        WHEN p_size < 45 THEN p_name ELSE 'red widget' END, p_partkey) AS target
    FROM part GROUP BY p_brand, p_name)"""


@query("validate_rename_map", f"""
WITH {RENAMES}, k AS (SELECT DISTINCT a.p_brand, a.source FROM m a JOIN m b
    ON a.p_brand = b.p_brand AND a.source = b.target AND a.pos <> b.pos),
d AS (SELECT p_brand, target FROM m GROUP BY p_brand, target HAVING count(*) > 1)
SELECT p_brand, (SELECT count(*) FROM k WHERE k.p_brand = q.p_brand) AS n_overlaps,
    (SELECT count(*) FROM d WHERE d.p_brand = q.p_brand) AS n_repeated,
    (SELECT count(*) FROM k WHERE k.p_brand = q.p_brand)
        + (SELECT count(*) FROM d WHERE d.p_brand = q.p_brand) = 0 AS is_valid
FROM (SELECT DISTINCT p_brand FROM m) q
""")
def _(t):
    target = (
        F.when(F.col("p_size") < 40, F.concat(F.lower("p_type"), F.lit("_"), "p_partkey"))
        .when(F.col("p_size") < 45, F.col("p_name"))
        .otherwise("red widget")
    )
    entries = t.table("part").groupBy("p_brand", F.col("p_name").alias("source")).agg(
        F.min("p_partkey").alias("pos"), F.min_by(target, "p_partkey").alias("target")
    )
    return un.validate_rename_map(entries, ["p_brand"], "source", "target", "pos")


@query("resolve_type_map", """
SELECT event_id, CASE event_type WHEN 'click' THEN 'EEG' WHEN 'view' THEN 'EOG' ELSE 'MISC' END
    AS type FROM events
""")
def _(t):
    old = F.col("event_type")
    kind = un.resolve_type(TYPES, old, un.rename_channel(NAMES, old), F.lit("MISC"))
    return t.events.select("event_id", kind.alias("type"))


@query("resolve_position_map", """
WITH p AS (SELECT 'c' || vec_id AS name, CAST(embedding[1] AS DOUBLE) AS x,
    CAST(embedding[3] AS DOUBLE) AS z FROM embeddings WHERE label < 5),
c AS (SELECT vec_id, 'c' || vec_id AS old, 'c' || (vec_id + 1) AS new,
    CAST(embedding[4] AS DOUBLE) AS mx FROM embeddings)
SELECT c.vec_id, coalesce(a.x, b.x, 'nan'::DOUBLE) AS x, coalesce(a.z, b.z, 'nan'::DOUBLE) AS z,
    mx AS montage_x FROM c LEFT JOIN p a ON a.name = old LEFT JOIN p b ON b.name = new
""")
def _(t):
    v = t.table("embeddings")
    xyz = F.slice("embedding", 1, 3).cast("array<double>")
    known = v.filter(F.col("label") < 5).select(
        F.concat(F.lit("c"), "vec_id").alias("name"), xyz.alias("pos")
    )
    rows = v.select(
        "vec_id",
        F.concat(F.lit("c"), "vec_id").alias("old"),
        F.concat(F.lit("c"), F.col("vec_id") + 1).alias("new"),
        F.slice("embedding", 4, 3).cast("array<double>").alias("montage"),
    )
    placed = un.resolve_positions(rows, known, "old", "new").withColumnRenamed("pos", "placed")
    both = un.resolve_positions(placed, None, "old", "new", "montage")
    return both.select(
        "vec_id",
        F.col("placed")[0].alias("x"),
        F.col("placed")[2].alias("z"),
        F.col("pos")[0].alias("montage_x"),
    )


@query("invert_type_map", """
WITH w AS (SELECT doc_id, source, unnest(string_split(text, ' ')) AS channel FROM documents)
SELECT channel, arg_max(source, doc_id) AS type FROM w GROUP BY channel
""")
def _(t):
    types = t.table("documents").select("doc_id", "source", F.split("text", " ").alias("words"))
    return un.invert_type_map(types, "doc_id", "source", "words")


@query("per_recording_map", """
SELECT event_id, CASE WHEN user_id % 2 = 0 THEN CASE event_type WHEN 'click' THEN 'HB_1'
    WHEN 'view' THEN 'HB_2' ELSE event_type END
    ELSE CASE event_type WHEN 'click' THEN 'PSG_F3' ELSE event_type END END AS channel FROM events
""")
def _(t):
    rec = F.concat(
        F.lit("sub-"),
        "user_id",
        F.when(F.col("user_id") % 2 == 0, "_acq-headband").otherwise("_acq-psg"),
    )
    chosen = un.per_recording_map(
        rec,
        F.col("event_type"),
        {"acq-headband": {"click": "HB_1", "view": "HB_2"}},
        {"click": "PSG_F3"},
    )
    return t.events.select("event_id", chosen.alias("channel"))


@query("probe_channels", """
WITH p AS (SELECT label, embedding, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS probe
    FROM embeddings)
SELECT label, probe, CAST(k AS INTEGER) AS channel, CAST(embedding[k + 1] AS DOUBLE) AS x,
    CAST(embedding[k + 33] AS DOUBLE) AS y FROM p, (SELECT unnest(range(32)) AS k) q
""")
def _(t):
    probes = t.table("embeddings").select(
        "label",
        "vec_id",
        F.slice("embedding", 1, 32).cast("array<double>").alias("x"),
        F.slice("embedding", 33, 32).cast("array<double>").alias("y"),
    )
    return un.probe_channels(probes, ["label"], "vec_id", ["x", "y"])


@query("roi_geometry", """
SELECT l_partkey, round(avg(l_suppkey), 6) AS centroid_row, round(avg(l_linenumber), 6)
    AS centroid_col, count(*) AS area, max(l_suppkey) - min(l_suppkey) + 1 AS height,
    max(l_linenumber) - min(l_linenumber) + 1 AS width
FROM lineitem WHERE l_tax <> 0 GROUP BY l_partkey
""")
def _(t):
    got = un.roi_geometry(
        t.table("lineitem"), ["l_partkey"], "l_suppkey", "l_linenumber", "l_tax"
    )
    return got.withColumns(
        {c: F.round(c, 6) for c in ("centroid_row", "centroid_col")}
    )


LOCALIZED = """
c AS (SELECT s_nationkey, s_suppkey, s_name, row_number() OVER (PARTITION BY s_nationkey
    ORDER BY s_suppkey) - 1 AS id FROM supplier),
l AS (SELECT 'Supplier#' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS s_name, p_brand, p_size
    FROM part WHERE p_size < 30)"""


@query("channel_localization", f"""
WITH {LOCALIZED} SELECT c.s_nationkey, c.s_suppkey, c.s_name, c.id, coalesce(p_brand, '') AS p_brand,
    CAST(coalesce(CAST(p_size AS DOUBLE), 'nan'::DOUBLE) AS FLOAT) AS p_size,
    c.s_suppkey % 5 <> 0 AS included FROM c LEFT JOIN l ON l.s_name = c.s_name
""")
def _(t):
    rows = t.table("supplier").select("s_nationkey", "s_suppkey", "s_name")
    name = F.concat(F.lit("Supplier#"), F.lpad(F.col("p_partkey").cast("string"), 9, "0"))
    table = t.table("part").filter(F.col("p_size") < 30).select(
        name.alias("s_name"), "p_brand", "p_size"
    )
    allowed = rows.filter(F.col("s_suppkey") % 5 != 0)
    return un.channel_localization(
        rows, table, ["s_nationkey"], "s_name", "s_suppkey", ["p_brand"], ["p_size"], allowed
    )


USED = """
c AS (SELECT DISTINCT user_id, event_type FROM events),
us AS (SELECT DISTINCT user_id, event_type, event_id % 3 AS selector FROM events WHERE value > 100),
mk AS (SELECT c.user_id, c.event_type, s.selector, us.user_id IS NOT NULL AS used
    FROM c, (SELECT CAST(unnest(range(3)) AS BIGINT) AS selector) s LEFT JOIN us
    ON us.user_id = c.user_id AND us.event_type = c.event_type AND us.selector = s.selector)"""


def masks(t):
    used = t.events.filter(F.col("value") > 100).select(
        "user_id", "event_type", (F.col("event_id") % 3).alias("selector")
    )
    selectors = [F.lit(i).cast("bigint") for i in range(3)]
    return un.split_channel_mask(channels(t), selectors, used, ["user_id", "event_type"])


@query("split_channel_mask", f"""
WITH {USED} SELECT m.user_id, m.event_type, m.selector, m.used, a.used AS included
FROM mk m JOIN mk a ON a.user_id = m.user_id AND a.event_type = m.event_type AND a.selector = 1
""")
def _(t):
    written = masks(t)
    read = un.with_split_mask(
        channels(t).withColumn("included", F.lit(True)), written, 1, ["user_id", "event_type"]
    )
    return written.join(read, ["user_id", "event_type"])


@query("channel_metadata", """
SELECT s_nationkey, s_suppkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1
    AS "index", s_acctbal AS "L", CASE WHEN s_acctbal > 5000 THEN s_acctbal / 2 END AS "I",
    CAST(s_suppkey AS DOUBLE) AS "P", s_acctbal > 5000 AS is_complete FROM supplier
""")
def _(t):
    rows = t.table("supplier").select(
        "s_nationkey",
        "s_suppkey",
        F.col("s_acctbal").alias("l"),
        F.when(F.col("s_acctbal") > 5000, F.col("s_acctbal") / 2).alias("i"),
        F.col("s_suppkey").cast("double").alias("p"),
    )
    got = un.channel_metadata(rows, ["s_nationkey"], "s_suppkey", ("l", "i", "p"))
    axes = [F.col("coordinates")[n].alias(a) for n, a in enumerate(("L", "I", "P"))]
    return got.select("s_nationkey", "s_suppkey", "index", *axes, "is_complete")


@query("namespace_ids", """
SELECT DISTINCT 's' || (user_id % 7) || '/' || user_id || '/' || event_type AS id,
    user_id || '/' || event_type AS session_only FROM events
""")
def _(t):
    from kymo.functions.paths import namespaced

    session = F.col("user_id").cast("string")
    subject = F.concat(F.lit("s"), F.col("user_id") % 7)
    kind = F.col("event_type")
    return t.events.select(
        namespaced(kind, subject, session).alias("id"),
        namespaced(kind, session).alias("session_only"),
    ).distinct()
