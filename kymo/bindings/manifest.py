"""Sources, manifest and metadata on paths and texts derived from the tables.

Expressions marked BOTH are plain SQL text that Spark and DuckDB read alike, used
to derive the same input on either side.
"""

from pyspark.sql import functions as F

from kymo.bindings.registry import DAY, EVENTS_CTE, query
from kymo.functions import metadata as md
from kymo.functions import paths as ph
from kymo.operators import descriptions as ds
from kymo.operators import jobs
from kymo.operators import manifest as mf
from kymo.sources import catalog as cat
from kymo.sources import digests as dg
from kymo.sources import snapshots as snap
from kymo.sources import store

# --- sources ------------------------------------------------------------------


@query("file_catalog", """
SELECT page_id, url, substr(url, 9) AS relative FROM pages
WHERE starts_with(url, 'https://') AND NOT ends_with(url, '/') AND length(url) > 8
""")
def _(t):
    return cat.file_catalog(t.table("pages").select("page_id", "url"), "url", "https://")


@query("strip_key_prefix", """
SELECT page_id, CASE WHEN starts_with(url, 'https:/') THEN substr(url, 8) ELSE url END AS local,
    CASE WHEN starts_with(url, 'https://www.') AND starts_with(url, 'https://www./')
        THEN substr(url, 14) ELSE url END AS local_given FROM pages
""")
def _(t):
    url = F.col("url")
    return t.table("pages").select(
        "page_id",
        ph.local_path(url, "https://").alias("local"),
        ph.local_path(url, "https://", "https://www.").alias("local_given"),
    )


@query("parse_object_url", """
SELECT page_id, regexp_extract(url, '^([a-z]+)://', 1) AS scheme,
    regexp_extract(url, '://([^/?#]*)', 1) AS bucket,
    ltrim(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '/') AS prefix,
    starts_with(url, 'https://') AS is_valid FROM pages
""")
def _(t):
    return cat.parse_object_url(t.table("pages").select("page_id", "url"), "url", "https").drop(
        "url"
    )


# BOTH: an entity path per order; parts go missing, kinds and extensions vary.
PATH = """
'sub-' || lpad(CAST(o_custkey % 500 AS VARCHAR(20)), 3, '0')
|| CASE WHEN o_orderstatus = 'P' THEN '' ELSE '/ses-' || o_orderstatus END
|| CASE WHEN o_orderkey % 3 = 0 THEN '/ieeg' ELSE '/eeg' END
|| '/sub-' || lpad(CAST(o_custkey % 500 AS VARCHAR(20)), 3, '0')
|| CASE WHEN o_orderstatus = 'P' THEN '' ELSE '_ses-' || o_orderstatus END
|| '_task-' || substr(o_orderpriority, 3, 3)
|| CASE WHEN o_totalprice > 250000 THEN '' ELSE '_acq-headband' END
|| CASE WHEN o_totalprice > 400000 THEN '' ELSE '_run-' || lpad(CAST(o_orderkey % 4 AS VARCHAR(20)), 2, '0') END
|| CASE WHEN o_totalprice < 100000 THEN '_desc-clean' ELSE '' END
|| CASE WHEN o_orderkey % 3 = 0 THEN '_ieeg' ELSE '_eeg' END
|| CASE o_orderkey % 7 WHEN 0 THEN '.edf' WHEN 1 THEN '.EDF' WHEN 2 THEN '.vhdr' WHEN 3 THEN '.set'
    WHEN 4 THEN '.bdf' WHEN 5 THEN '.tsv' ELSE '.nwb' END
"""
PATHS = f"p AS (SELECT o_orderkey AS pos, {PATH} AS path FROM orders)"


def paths(t):
    return t.table("orders").select(
        F.col("o_orderkey").alias("pos"), F.expr(PATH).alias("path")
    )


def entity_sql(short: str) -> str:
    return f"nullif(regexp_extract(name, '(?:^|_){short}-([^_.]+)', 1), '')"


def part_sql(short: str) -> str:
    return f"'{short}-' || {entity_sql(short)}"


PARSED = f"""
n AS (SELECT pos, path, regexp_extract(path, '([^/]+)$', 1) AS name FROM p),
b AS (SELECT pos, path, concat_ws('_', {part_sql("sub")}, {part_sql("ses")}, {part_sql("task")},
    {part_sql("acq")}, {part_sql("run")}, {part_sql("desc")}) AS recording_id,
    {part_sql("sub")} AS subject_id, {part_sql("ses")} AS session_id,
    {entity_sql("task")} AS task_id, {entity_sql("acq")} AS acquisition_id,
    {entity_sql("run")} AS run_id, {entity_sql("desc")} AS description_id,
    regexp_extract(path, '([^/]+)/[^/]+$', 1) AS datatype,
    lower(regexp_extract(name, '(\\.[^.]+)$', 1)) AS extension FROM n)"""


@query("recording_url", f"""
WITH {PATHS}, {PARSED} SELECT pos, 's3://archive/set01/' || regexp_replace(path, '/[^/]*$', '')
    || '/' || recording_id AS url FROM b
""")
def _(t):
    path = F.col("path")
    return paths(t).select(
        "pos",
        ph.recording_url("s3://archive", "set01", path, ph.recording_id(path)).alias("url"),
    )


@query("bids_parse", f"WITH {PATHS}, {PARSED} SELECT * FROM b")
def _(t):
    return mf.bids_parse(paths(t), "path")


def fetch_sql(kind: str, extensions) -> str:
    accepted = ", ".join(f"'{e}'" for e in extensions)
    return f"""
{kind} AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY recording_id
    ORDER BY pos) AS rn FROM b WHERE extension IN ({accepted}) AND datatype = '{kind}') q
    WHERE rn = 1)"""


EEG = fetch_sql("eeg", ph.EEG_EXTENSIONS)
IEEG = fetch_sql("ieeg", ph.IEEG_EXTENSIONS)


@query("fetch_eeg_recordings", f"WITH {PATHS}, {PARSED}, {EEG} SELECT * FROM eeg")
def _(t):
    return mf.fetch_eeg_recordings(paths(t), "path", "pos")


@query("fetch_ieeg_recordings", f"WITH {PATHS}, {PARSED}, {IEEG} SELECT * FROM ieeg")
def _(t):
    return mf.fetch_ieeg_recordings(paths(t), "path", "pos")


@query("group_recordings", f"""
WITH {PATHS}, {PARSED}
SELECT pos, recording_id, concat_ws('_', {part_sql("sub")}, {part_sql("ses")}, {part_sql("task")},
    {part_sql("acq")}, {part_sql("desc")}) AS group_key,
    concat_ws('_', {part_sql("sub")}, {part_sql("task")}) AS subject_task
FROM (SELECT pos, recording_id, recording_id AS name FROM b) q
""")
def _(t):
    r = mf.bids_parse(paths(t), "path").select("pos", "recording_id")
    return mf.group_recordings(
        mf.group_recordings(r), fixed_entities=["subject", "Task"], out="subject_task"
    )


# BOTH: a data file per order line, most with an unlisted extension.
LINE_PATH = """
'sub-' || CAST(l_orderkey % 100 AS VARCHAR(20)) || '/eeg/sub-'
|| CAST(l_orderkey % 100 AS VARCHAR(20)) || '_ses-' || CAST(l_orderkey AS VARCHAR(20))
|| '_task-' || l_returnflag || CASE WHEN l_linenumber = 1 THEN '_eeg.edf' WHEN l_linenumber = 2
    THEN '_eeg.BDF' ELSE '_eeg.json' END
"""


@query("recording_files_exist", """
SELECT o_orderkey, 'sub-' || (o_orderkey % 100) AS subject_id,
    'sub-' || (o_orderkey % 100) || '_ses-' || o_orderkey AS recording_id
FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey
    AND l_linenumber IN (1, 2))
""")
def _(t):
    key, subject = F.col("o_orderkey"), F.concat(F.lit("sub-"), F.col("o_orderkey") % 100)
    recordings = t.table("orders").select(
        "o_orderkey",
        subject.alias("subject_id"),
        F.concat(subject, F.lit("_ses-"), key).alias("recording_id"),
    )
    files = t.table("lineitem").select(F.expr(LINE_PATH).alias("path"))
    return mf.recording_files_exist(recordings, files, "path", ph.EEG_EXTENSIONS)


# BOTH: participants with missing-value tokens.
AGE = """CASE WHEN c_mktsegment = 'MACHINERY' THEN 'n/a' WHEN c_mktsegment = 'FURNITURE' THEN 'NaN'
    ELSE CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR(20)) END"""
SEX = """CASE c_nationkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'M' ELSE 'N/A' END"""


def participants(t, key="subject_id"):
    return t.table("customer").select(
        F.concat(F.lit("sub-"), "c_custkey").alias(key),
        F.expr(AGE).alias("age"),
        F.expr(SEX).alias("sex"),
    )


@query("read_participants", f"""
SELECT 'sub-' || c_custkey AS participant_id,
    CASE WHEN {AGE} IN ('n/a', 'NaN') THEN NULL ELSE {AGE} END AS age,
    CASE WHEN {SEX} = 'N/A' THEN NULL ELSE {SEX} END AS sex FROM customer
""")
def _(t):
    path = store.scratch_dir(t.spark)
    participants(t, "participant_id").write.csv(path, sep="\t", header=True)
    return cat.read_participants(t.spark, path)


@query("subject_info", f"""
WITH c AS (SELECT 'sub-' || c_custkey AS subject_id, {AGE} AS a, {SEX} AS s FROM customer)
SELECT o_orderkey, 'sub-' || (o_custkey + 50) AS subject_id,
    CASE WHEN a IN ('n/a', 'NaN') THEN NULL ELSE CAST(a AS DOUBLE) END AS age,
    CASE WHEN s = 'N/A' THEN NULL ELSE s END AS sex
FROM orders LEFT JOIN c ON c.subject_id = 'sub-' || (o_custkey + 50)
""")
def _(t):
    r = t.table("orders").select(
        "o_orderkey", F.concat(F.lit("sub-"), F.col("o_custkey") + 50).alias("subject_id")
    )
    return mf.subject_info(r, participants(t))


@query("read_json_sidecar", """
SELECT e.event_id, e.event_type, CAST(json_extract(s.props, '$.k') AS BIGINT) AS k,
    s.event_id IS NOT NULL AS has_sidecar
FROM events e LEFT JOIN (SELECT event_id, props FROM events WHERE event_type <> 'error') s
    ON s.event_id = e.event_id
""")
def _(t):
    e = t.events
    sidecars = e.filter(F.col("event_type") != "error").select(
        "event_id", F.col("props").alias("json")
    )
    got = cat.attach_sidecar(e.select("event_id", "event_type"), sidecars, ["event_id"], "k bigint")
    return got.select("event_id", "event_type", F.col("sidecar.k").alias("k"), "has_sidecar")


@query("read_checksums", """
SELECT 'doc ' || doc_id || '.txt' AS name, md5(text) AS md5 FROM documents WHERE lang <> 'de'
""")
def _(t):
    text, lang = F.md5("text"), F.col("lang")
    name = F.concat(F.lit("doc "), "doc_id", F.lit(".txt"))
    line = (
        F.when(lang == "fr", F.concat(F.upper(text), F.lit(" *"), name))
        .when(lang == "de", F.concat(F.lit("# "), name))
        .otherwise(F.concat(F.lit("  "), text, F.lit("  "), name))
    )
    path = store.scratch_dir(t.spark)
    t.table("documents").select(line.alias("value")).write.text(path)
    return cat.read_checksums(t.spark, path)


# Bytes of a part, and documents of a written file
ETAG_PART, VOLUME = 4096, 16


@query("verify_checksum", f"""
WITH f AS (SELECT doc_id // {VOLUME} AS volume,
    encode(string_agg(text, chr(10) ORDER BY doc_id) || chr(10)) AS b FROM documents GROUP BY volume),
n AS (SELECT *, CAST(ceil(octet_length(b) / {ETAG_PART}.0) AS BIGINT) AS n FROM f)
SELECT volume, md5(unhex(array_to_string(list_transform(range(n), lambda i:
        md5(b[i * {ETAG_PART} + 1:(i + 1) * {ETAG_PART}])), ''))) || '-' || n AS etag,
    volume % 5 > 1 AS digest_ok, CASE WHEN volume % 5 > 1 THEN 'skip' ELSE 'fetch' END AS action FROM n
""")
def _(t):
    texts = F.array_sort(F.collect_list(F.struct("doc_id", "text")))
    volumes = (
        t.table("documents")
        .groupBy(F.expr(f"doc_id div {VOLUME}").alias("volume"))
        .agg(F.array_join(F.transform(texts, lambda r: r["text"]), "\n").alias("text"))
    )
    folder = store.scratch_dir(t.spark)
    volumes.write.partitionBy("volume").text(folder)
    # a fifth of the list is out of date, a fifth is missing
    body = F.encode(F.concat("text", F.when(F.col("volume") % 5 == 1, " \n").otherwise("\n")), "UTF-8")
    parts = F.ceil(F.octet_length(body) / ETAG_PART)
    digests = F.transform(
        F.sequence(F.lit(0).cast("bigint"), parts - 1),
        lambda i: F.md5(F.substring(body, (i * ETAG_PART + 1).cast("int"), F.lit(ETAG_PART))),
    )
    etag = F.concat(F.md5(F.unhex(F.array_join(digests, ""))), F.lit("-"), parts.cast("string"))
    listed = volumes.filter("volume % 5 > 0").select("volume", etag.alias("md5"))
    volume = F.regexp_extract("name", "^volume=([0-9]+)/", 1).cast("bigint")
    found = dg.multipart_digests(t.spark, folder, ETAG_PART).withColumn("volume", volume)
    got = cat.verify_checksum(found, listed, ["volume"], F.col("etag"))
    return got.select("volume", "etag", "digest_ok", "action")


@query("static_manifest", """
SELECT p_partkey, ' ' || p_type || '/' || p_name || '.v2.MAT ' AS fname, lower(p_name) AS session_id
FROM part
""")
def _(t):
    names = t.table("part").select(
        "p_partkey",
        F.concat(F.lit(" "), "p_type", F.lit("/"), "p_name", F.lit(".v2.MAT ")).alias("fname"),
    )
    return cat.static_manifest(names, "fname")


@query("write_recording", f"""
WITH {EVENTS_CTE} SELECT 'events' AS dataset_id, t // {DAY} AS recording_id, event_id, t, value,
    component FROM e, (SELECT unnest(['series', 'copies']) AS component) q
WHERE component = 'series' OR value > 100
""")
def _(t):
    rows = t.events.select(
        F.lit("events").alias("dataset_id"),
        F.expr(f"t div {DAY}").alias("recording_id"),
        "event_id",
        "t",
        "value",
    )
    root = store.scratch_dir(t.spark)

    def tables(r):
        return {"series": r, "copies": r.filter(F.col("value") > 100)}

    # an earlier commit is replaced, also where a recording has no copies left; a write without a
    # commit is not seen
    earlier = rows.withColumn("value", F.col("value") * 2)
    snap.write_recording(tables(earlier), root)
    snap.write_recording(tables(rows), root, recordings=rows.select("dataset_id", "recording_id").distinct())
    snap.stage({"series": earlier}, root)
    schema = "event_id bigint, t bigint, value double, dataset_id string, recording_id bigint"
    series = snap.read_component(t.spark, root, "series", schema)
    copies = snap.read_component(t.spark, root, "copies", schema)
    return series.withColumn("component", F.lit("series")).unionByName(
        copies.withColumn("component", F.lit("copies"))
    )


@query("timestamp_to_string", """
WITH a AS (SELECT 'e' || event_id AS id, ts FROM events
    UNION ALL SELECT 'o' || o_orderkey, o_orderdate FROM orders)
SELECT id, strftime(ts, '%Y-%m-%d %H:%M:%S') || CASE WHEN epoch_us(ts) % 1000000 = 0 THEN ''
    ELSE '.' || lpad(CAST(epoch_us(ts) % 1000000 AS VARCHAR), 6, '0') END AS text FROM a
""")
def _(t):
    e = t.events.select(F.concat(F.lit("e"), "event_id").alias("id"), "t")
    o = t.orders.select(F.concat(F.lit("o"), "o_orderkey").alias("id"), "t")
    return e.unionByName(o).select("id", md.timestamp_text(F.col("t")).alias("text"))


@query("incremental_skip", """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
""")
def _(t):
    done = t.table("lineitem").filter(F.col("l_returnflag") == "R").select(
        F.col("l_orderkey").alias("o_orderkey")
    )
    return jobs.incremental_skip(
        t.table("orders").select("o_orderkey", "o_custkey"), done, ["o_orderkey"]
    )


def fetch_order(item):
    if item["o_orderstatus"] == "P":
        raise ValueError(f"order {item['o_orderkey']} is pending")
    return item["o_totalprice"]


def process_order(item, price):
    if price < 1500:
        raise RuntimeError("price too low")


@query("run_manifest", """
SELECT CAST(o_orderkey AS VARCHAR) AS item_id,
    CASE WHEN o_orderstatus = 'P' OR o_totalprice < 1500 THEN 'FAILED' ELSE 'DONE' END AS status,
    CASE WHEN o_orderstatus = 'P' THEN 'ValueError: order ' || o_orderkey || ' is pending'
        WHEN o_totalprice < 1500 THEN 'RuntimeError: price too low' END AS error FROM orders
""")
def _(t):
    manifest = t.table("orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return jobs.run_manifest(manifest, "o_orderkey", fetch_order, process_order)


@query("run_ledger", """
WITH s AS (SELECT CASE o_orderstatus WHEN 'F' THEN 'DONE' WHEN 'O' THEN 'PROCESSING'
    ELSE 'FAILED' END AS status FROM orders)
SELECT status, count(*) AS n_items, (SELECT bool_and(status = 'DONE') FROM s) AS all_done
FROM s GROUP BY status
""")
def _(t):
    status = F.expr(
        "CASE o_orderstatus WHEN 'F' THEN 'DONE' WHEN 'O' THEN 'PROCESSING' ELSE 'FAILED' END"
    )
    return jobs.run_ledger(t.table("orders").select("o_orderkey", status.alias("status")))


# --- manifest -----------------------------------------------------------------

# BOTH
SPECIES = """CASE lang WHEN 'en' THEN ' Human ' WHEN 'fr' THEN 'Homo sapiens' WHEN 'de' THEN 'mouse'
    ELSE NULL END"""


@query("normalize_species", """
SELECT doc_id, CASE WHEN lang IN ('en', 'fr') THEN 'HOMO_SAPIENS' END AS species FROM documents
""")
def _(t):
    return t.table("documents").select(
        "doc_id", md.normalize_species(F.expr(SPECIES)).alias("species")
    )


@query("build_manifest", f"""
WITH {PATHS}, {PARSED}, {EEG}, c AS (SELECT 'sub-' || CASE WHEN c_custkey < 100
    THEN lpad(CAST(c_custkey AS VARCHAR), 3, '0') ELSE CAST(c_custkey AS VARCHAR) END
    AS subject_id, {AGE} AS a, {SEX} AS s FROM customer)
SELECT recording_id, eeg.subject_id, 's3://archive/set01/' || regexp_replace(path, '/[^/]*$', '')
    || '/' || recording_id AS url, '1.0.0' AS snapshot_tag, 'HOMO_SAPIENS' AS species,
    CASE WHEN a IN ('n/a', 'NaN') THEN NULL ELSE CAST(a AS DOUBLE) END AS age,
    CASE WHEN s = 'N/A' THEN NULL ELSE s END AS sex
FROM eeg LEFT JOIN c ON c.subject_id = eeg.subject_id
""")
def _(t):
    number = F.col("c_custkey").cast("string")
    people = t.table("customer").select(
        F.concat(F.lit("sub-"), F.lpad(number, 3, "0"), F.substring(number, 4, 20))
        .alias("subject_id"),
        F.expr(AGE).alias("age"),
        F.expr(SEX).alias("sex"),
    )
    return mf.build_manifest(
        paths(t), "path", "pos", "eeg", people, F.lit("human"), "s3://archive", "set01", "1.0.0"
    )


# BOTH: one path per order in each dataset's own layout.
REACH = """'sub-' || substr('CMJT', CAST(o_custkey % 4 AS INT) + 1, 1) || '/sub-X_ses-'
|| CASE WHEN o_orderstatus = 'F' THEN 'CO' WHEN o_orderstatus = 'O' THEN 'RT' ELSE 'ZZ' END
|| '-2016' || lpad(CAST(o_orderkey % 1000 AS VARCHAR(20)), 4, '0') || '_behavior.nwb'"""
MAZE = """'sub-' || CASE WHEN o_custkey % 2 = 0 THEN 'Jenkins' ELSE 'Nitschke' END || '/sub_ses-'
|| CAST(o_orderkey AS VARCHAR(20)) || '_x.nwb'"""
SLEEP = """CASE WHEN o_orderstatus = 'F' THEN 'a/sleep-cassette/' WHEN o_orderstatus = 'O'
THEN 'a/sleep-telemetry/' ELSE 'a/' END || 'SC4' || lpad(CAST(o_orderkey % 100 AS VARCHAR(20)), 2, '0')
|| '1E0-PSG.edf'"""
MATLAB = """'https://x/' || CASE WHEN o_orderstatus = 'P' THEN 'notes.txt' ELSE 'indy_'
|| CAST(o_orderkey AS VARCHAR(20)) || '.mat' END || '/content'"""
NAV = """CASE WHEN o_orderstatus = 'P' THEN 'sleep/' ELSE 'navigation/of/' END || 'rat_'
|| CAST(o_orderkey AS VARCHAR(20)) || '.mat'"""


@query("path_session_id", """
SELECT o_orderkey,
    CASE WHEN o_orderstatus <> 'P' THEN lower(substr('CMJT', CAST(o_custkey % 4 AS INT) + 1, 1))
        || '_2016' || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 4, '0') || CASE o_orderstatus
        WHEN 'F' THEN '_center_out_reaching' ELSE '_random_target_reaching' END END AS reach,
    CASE WHEN o_custkey % 2 = 0 THEN 'jenkins_' ELSE 'nitschke_' END || o_orderkey AS maze,
    CASE o_orderstatus WHEN 'F' THEN 'sleep_cassette' WHEN 'O' THEN 'sleep_telemetry'
        ELSE 'unknown' END || '_SC4' || lpad(CAST(o_orderkey % 100 AS VARCHAR), 2, '0')
        || '1E0-PSG' AS sleep,
    CASE WHEN o_orderstatus = 'P' THEN 'SC4' || lpad(CAST(o_orderkey % 100 AS VARCHAR), 2, '0')
        || '1E0-PSG' ELSE lpad(CAST(o_orderkey % 100 AS VARCHAR), 2, '0') END AS sleep_subject,
    CASE WHEN o_orderstatus <> 'P' THEN 'indy_' || o_orderkey END AS matlab,
    CASE WHEN o_orderstatus = 'P' THEN 'sleep' ELSE 'of' END || '_rat_' || o_orderkey AS nav,
    CASE WHEN o_orderstatus = 'P' THEN 'maze_train' ELSE 'maze_test' END AS marked
FROM orders
""")
def _(t):
    o = t.table("orders").select(
        "o_orderkey",
        F.expr(REACH).alias("reach"),
        F.expr(MAZE).alias("maze"),
        F.expr(SLEEP).alias("sleep"),
        F.expr(MATLAB).alias("matlab"),
        F.expr(NAV).alias("nav"),
    )
    return o.select(
        "o_orderkey",
        mf.reach_session(F.col("reach")).alias("reach"),
        mf.maze_session(F.col("maze")).alias("maze"),
        mf.sleep_session(F.col("sleep")).alias("sleep"),
        mf.sleep_subject(F.col("sleep")).alias("sleep_subject"),
        mf.matlab_session(F.col("matlab")).alias("matlab"),
        mf.navigation_session(F.col("nav")).alias("nav"),
        mf.marker_session(F.col("nav"), "navigation", "maze").alias("marked"),
    )


@query("pair_by_prefix", """
WITH s AS (SELECT doc_id, lang, md5(text) AS name FROM documents),
a AS (SELECT lang, substr(md5(text), 1, 6) || substr(md5(source), 1, 2) AS name,
    lang || '/' || substr(md5(text), 1, 6) || substr(md5(source), 1, 2) || '-' || doc_id AS key
    FROM documents WHERE source <> 'src0'),
p7 AS (SELECT s.doc_id, min(a.key) AS k FROM s JOIN a ON a.lang = s.lang
    AND substr(a.name, 1, 7) = substr(s.name, 1, 7) GROUP BY s.doc_id),
p6 AS (SELECT s.doc_id, min(a.key) AS k FROM s JOIN a ON a.lang = s.lang
    AND substr(a.name, 1, 6) = substr(s.name, 1, 6) GROUP BY s.doc_id)
SELECT s.doc_id, s.lang, s.name, coalesce(p7.k, p6.k) AS annotation_key
FROM s LEFT JOIN p7 ON p7.doc_id = s.doc_id LEFT JOIN p6 ON p6.doc_id = s.doc_id
""")
def _(t):
    d = t.table("documents")
    signals = d.select("doc_id", "lang", F.md5("text").alias("name"))
    name = F.concat(F.substring(F.md5("text"), 1, 6), F.substring(F.md5("source"), 1, 2))
    annotations = d.filter(F.col("source") != "src0").select(
        "lang",
        name.alias("name"),
        F.concat("lang", F.lit("/"), name, F.lit("-"), "doc_id").alias("key"),
    )
    return mf.pair_by_prefix(signals, annotations, "lang", "name", "key")


def pairs_sql(pairs) -> str:
    return ", ".join(f"({a}, {b})" for a, b in pairs)


SUBJECTS = """
r AS (SELECT DISTINCT CAST(c_custkey % 11 AS BIGINT) AS subject, CAST(c_nationkey % 7 AS BIGINT)
    AS session FROM customer)"""


def subjects(t):
    return t.table("customer").select(
        (F.col("c_custkey") % 11).alias("subject"),
        (F.col("c_nationkey") % 7).cast("bigint").alias("session"),
    ).distinct()


GRID = f"""
g AS (SELECT subject, session, lite, nano, binary_tasks, eval_setting FROM r,
    (SELECT unnest([true, false]) AS lite) a, (SELECT unnest([true, false]) AS nano) b,
    (SELECT unnest([true, false]) AS binary_tasks) c,
    (SELECT unnest(['within_session', 'cross_x']) AS eval_setting) d
    WHERE NOT (lite AND nano) AND NOT (nano AND eval_setting = 'cross_x')
    AND (NOT lite OR (subject, session) IN ({pairs_sql(mf.LITE_PAIRS)}))
    AND (NOT nano OR (subject, session) IN ({pairs_sql(mf.NANO_PAIRS)})))"""


@query("settings_grid", f"WITH {SUBJECTS}, {GRID} SELECT * FROM g")
def _(t):
    return mf.settings_grid(subjects(t), "subject", "session")


TASK_LIST = "[" + ", ".join(f"'{x}'" for x in mf.TASKS) + "]"


@query("selector_key", f"""
WITH {SUBJECTS}, {GRID}
SELECT subject, session, CASE WHEN lite THEN 'lite' WHEN nano THEN 'nano' ELSE 'full' END || '$'
    || CASE WHEN binary_tasks THEN 'binary' ELSE 'multiclass' END || '$' || eval_setting || '$'
    || task || '$fold' || fold || '$' || split AS selector
FROM g, (SELECT unnest({TASK_LIST}) AS task) k, (SELECT unnest([0, 1]) AS fold) f,
    (SELECT unnest(['train', 'val', 'test']) AS split) s
""")
def _(t):
    grid = mf.settings_grid(subjects(t), "subject", "session")
    each = (
        grid.withColumn("task", F.explode(F.array(*map(F.lit, mf.TASKS))))
        .withColumn("fold", F.explode(F.array(F.lit(0), F.lit(1))))
        .withColumn("split", F.explode(F.array(*map(F.lit, mf.SPLITS))))
    )
    tier = F.when(F.col("lite"), "lite").when(F.col("nano"), "nano").otherwise("full")
    label = F.when(F.col("binary_tasks"), "binary").otherwise("multiclass")
    key = mf.selector_key(
        tier, label, F.col("eval_setting"), F.col("task"), F.col("fold"), F.col("split")
    )
    return each.select("subject", "session", key.alias("selector"))


@query("recording_id_codec", """
WITH o AS (SELECT o_orderkey, o_custkey - 10 AS subject, o_orderkey % 1200 AS session FROM orders)
SELECT o_orderkey, CASE WHEN ok THEN 'sub_' || subject || '_trial'
        || lpad(CAST(session AS VARCHAR), 3, '0') END AS recording_id,
    CASE WHEN ok THEN subject END AS subject, CASE WHEN ok THEN session END AS session, ok AS valid
FROM (SELECT *, subject >= 0 AND session <= 999 AS ok FROM o) q
""")
def _(t):
    subject, session = F.col("o_custkey") - 10, F.col("o_orderkey") % 1200
    made = t.table("orders").select(
        "o_orderkey", ph.encode_recording(subject, session).alias("recording_id")
    )
    ident = F.col("recording_id")
    return made.withColumns(
        {
            "subject": ph.decode_recording(ident, 1),
            "session": ph.decode_recording(ident, 2),
            "valid": ident.isNotNull(),
        }
    )


# BOTH: one request per order.
REQUEST = """
CAST(o_custkey % 11 AS INT) AS subject, CAST(o_orderkey % 5 AS INT) AS session,
CASE CAST(floor(o_totalprice) AS BIGINT) % 4 WHEN 0 THEN 'full' WHEN 1 THEN 'lite' WHEN 2 THEN 'nano'
    ELSE CASE WHEN o_totalprice > 400000 THEN 'tiny' ELSE 'lite' END END AS tier,
CASE o_orderstatus WHEN 'F' THEN 'SS-SM' WHEN 'O' THEN 'SS-DM' ELSE 'DS-DM' END AS regime,
CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END AS fold,
CASE CAST(floor(o_totalprice) AS BIGINT) % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'val' ELSE 'test' END
    AS split
"""
LONGEST = ", ".join(
    f"({s}, {i}, {x})" for s, xs in mf.LONGEST_SESSIONS.items() for i, x in enumerate(xs)
)


@query("resolve_split_recordings", f"""
WITH q AS (SELECT o_orderkey, {REQUEST} FROM orders),
lite(s, x) AS (VALUES {pairs_sql(mf.LITE_PAIRS)}), nano(s, x) AS (VALUES {pairs_sql(mf.NANO_PAIRS)}),
lg(s, i, x) AS (VALUES {LONGEST}),
p AS (SELECT *, CASE WHEN tier NOT IN ('full', 'lite', 'nano') THEN 'tier'
    WHEN fold = 1 AND regime <> 'SS-SM' THEN 'fold'
    WHEN regime <> 'SS-SM' AND tier = 'nano' THEN 'nano_cross'
    WHEN regime = 'DS-DM' AND subject = 2 THEN 'anchor_subject'
    WHEN tier = 'lite' AND NOT EXISTS (SELECT 1 FROM lite WHERE s = subject AND x = session)
        THEN 'not_in_lite'
    WHEN tier = 'nano' AND NOT EXISTS (SELECT 1 FROM nano WHERE s = subject AND x = session)
        THEN 'not_in_nano'
    WHEN regime = 'SS-DM' AND tier = 'full' AND (SELECT count(*) FROM lg WHERE s = subject) < 2
        THEN 'too_few_sessions'
    WHEN regime = 'SS-DM' AND tier = 'full'
        AND NOT EXISTS (SELECT 1 FROM lg WHERE s = subject AND x = session) THEN 'not_in_longest'
    END AS problem FROM q),
z AS (SELECT *, CASE WHEN split = 'train' AND regime = 'DS-DM' THEN 2 ELSE subject END AS who,
    CASE WHEN split = 'train' AND regime = 'DS-DM' THEN 4
        WHEN split = 'train' AND regime = 'SS-DM' AND tier = 'lite'
            THEN (SELECT min(x) FROM lite WHERE s = subject AND x <> session)
        WHEN split = 'train' AND regime = 'SS-DM'
            THEN (SELECT arg_min(x, i) FROM lg WHERE s = subject AND x <> session)
        ELSE session END AS which FROM p)
SELECT o_orderkey, subject, session, tier, regime, fold, split, problem,
    CASE WHEN problem IS NULL THEN 'sub_' || who || '_trial' || lpad(CAST(which AS VARCHAR), 3, '0')
    END AS recording_id FROM z
""")
def _(t):
    requests = t.table("orders").selectExpr("o_orderkey", *_columns(REQUEST))
    return mf.resolve_split_recordings(requests)


def _columns(text: str) -> list[str]:
    """Split a select list at its top-level commas."""
    out, depth, part = [], 0, ""
    for token in text.replace("(", " ( ").replace(")", " ) ").replace(",", " , ").split():
        depth += (token == "(") - (token == ")")
        if token == "," and depth == 0:
            out.append(part)
            part = ""
        else:
            part += f" {token}"
    return [*out, part]


# Short names: nations for their paths, halves of a region for nations, halves for halves.
GROUP_NAMES = """
SELECT lower(n_name) AS name, concat(r_name, '/', n_name) AS target FROM {n} JOIN {r} ON r_regionkey = n_regionkey
UNION ALL SELECT concat('half ', n_nationkey % 2, ' of ', lower(r_name)), lower(n_name)
FROM {n} JOIN {r} ON r_regionkey = n_regionkey
UNION ALL SELECT concat('half ', n_nationkey % 2), concat('half ', n_nationkey % 2, ' of ', lower(r_name))
FROM {n} JOIN {r} ON r_regionkey = n_regionkey
UNION ALL SELECT 'everything', 'all' UNION ALL SELECT 'everything', 'half 1'
"""


@query("recording_groups", f"""
WITH RECURSIVE c AS (SELECT r_name, n_name, c_mktsegment, c_custkey FROM customer
    JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey),
m AS (SELECT 'all' AS group_path, c_custkey FROM c UNION ALL SELECT r_name, c_custkey FROM c
    UNION ALL SELECT r_name || '/' || n_name, c_custkey FROM c
    UNION ALL SELECT r_name || '/' || n_name || '/' || c_mktsegment, c_custkey FROM c),
names AS ({GROUP_NAMES.format(n="nation", r="region")}),
reached AS (SELECT name, target FROM names
    UNION SELECT reached.name, names.target FROM reached JOIN names ON names.name = reached.target)
SELECT group_path, c_custkey FROM m
UNION ALL SELECT DISTINCT name, c_custkey FROM reached JOIN m ON m.group_path = target
""")
def _(t):
    c = (
        t.table("customer")
        .join(t.table("nation"), F.col("n_nationkey") == F.col("c_nationkey"))
        .join(t.table("region"), F.col("r_regionkey") == F.col("n_regionkey"))
    )
    members = mf.recording_groups(c, ["r_name", "n_name", "c_mktsegment"], "c_custkey", whole="all")
    names = t.spark.sql(GROUP_NAMES, n=t.table("nation"), r=t.table("region"))
    return members.unionByName(mf.named_groups(members, names, "c_custkey"))


@query("group_sizes", """
WITH c AS (SELECT r_name, n_name, c_mktsegment, c_custkey FROM customer
    JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey)
SELECT concat_ws('/', r_name, n_name, c_mktsegment) AS group_path, count(*) AS n_recordings
FROM c GROUP BY ROLLUP (r_name, n_name, c_mktsegment) HAVING r_name IS NOT NULL
""")
def _(t):
    c = (
        t.table("customer")
        .join(t.table("nation"), F.col("n_nationkey") == F.col("c_nationkey"))
        .join(t.table("region"), F.col("r_regionkey") == F.col("n_regionkey"))
    )
    return mf.group_sizes(c, ["r_name", "n_name", "c_mktsegment"], "c_custkey")


# --- metadata -----------------------------------------------------------------


@query("describe_dataset", f"""
SELECT c_name AS id, CASE WHEN c_nationkey = 3 THEN '' ELSE '1.0' END AS origin_version,
    CASE WHEN c_nationkey = 4 THEN NULL ELSE '2.0' END AS derived_version,
    c_mktsegment AS source, CASE WHEN c_acctbal < 0 THEN '' ELSE 'customer' END AS description,
    '{ds.__version__}' AS engine_version, '{ds.FORMAT_VERSION}' AS format_version,
    CAST(c_custkey AS VARCHAR) AS extra_key,
    concat_ws(',', CASE WHEN c_nationkey = 3 THEN 'origin_version' END,
        CASE WHEN c_nationkey = 4 THEN 'derived_version' END,
        CASE WHEN c_acctbal < 0 THEN 'description' END) AS violations FROM customer
""")
def _(t):
    rows = t.table("customer").selectExpr(
        "c_name AS id",
        "CASE WHEN c_nationkey = 3 THEN '' ELSE '1.0' END AS origin_version",
        "CASE WHEN c_nationkey = 4 THEN NULL ELSE '2.0' END AS derived_version",
        "c_mktsegment AS source",
        "CASE WHEN c_acctbal < 0 THEN '' ELSE 'customer' END AS description",
        "c_custkey",
    )
    got = ds.describe_dataset(rows)
    return got.withColumn("extra_key", F.col("extras")["c_custkey"]).drop("extras")


@query("describe_subject", """
SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_nationkey = 1 THEN '' ELSE 'MOUSE' END
    AS species, CASE WHEN c_nationkey = 2 THEN NULL ELSE c_acctbal END AS age,
    CASE WHEN c_nationkey = 5 THEN NULL ELSE 'F' END AS sex,
    concat_ws(',', CASE WHEN c_nationkey = 1 THEN 'species' END,
        CASE WHEN c_nationkey = 2 OR c_acctbal < 0 THEN 'age' END) AS violations FROM customer
""")
def _(t):
    rows = t.table("customer").selectExpr(
        "CAST(c_custkey AS STRING) AS id",
        "CASE WHEN c_nationkey = 1 THEN '' ELSE 'MOUSE' END AS species",
        "CASE WHEN c_nationkey = 2 THEN 'old' ELSE CAST(c_acctbal AS STRING) END AS age",
        "CASE WHEN c_nationkey = 5 THEN NULL ELSE 'F' END AS sex",
    )
    return ds.describe_subject(rows).drop("extras")


@query("describe_session", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS id,
    CASE WHEN o_orderstatus = 'F' THEN epoch_us(o_orderdate) // {DAY} END AS day,
    o_orderpriority AS task,
    CASE WHEN o_orderstatus = 'P' THEN 'recording_date' ELSE '' END AS violations FROM orders
""")
def _(t):
    rows = t.orders.select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate").cast("string"))
        .when(F.col("o_orderstatus") == "P", "someday")
        .alias("recording_date"),
        F.col("o_orderpriority").alias("task"),
    )
    got = ds.describe_session(rows)
    day = F.expr(f"unix_micros(recording_date) div {DAY}")
    return got.select("id", day.alias("day"), F.col("extras")["task"].alias("task"), "violations")


@query("describe_device", """
SELECT s_name AS id, CASE WHEN s_nationkey % 3 = 0 THEN NULL WHEN s_nationkey % 3 = 1 THEN ''
    ELSE 'UTAH_ARRAY' END AS recording_tech,
    CASE WHEN s_nationkey % 3 = 1 THEN 'recording_tech' ELSE '' END AS violations FROM supplier
""")
def _(t):
    rows = t.table("supplier").selectExpr(
        "s_name AS id",
        "CASE WHEN s_nationkey % 3 = 0 THEN NULL WHEN s_nationkey % 3 = 1 THEN '' "
        "ELSE 'UTAH_ARRAY' END AS recording_tech",
    )
    return ds.describe_device(rows).drop("extras")


@query("subject_from_archive", """
SELECT p_partkey, lower(p_name) AS id, CASE WHEN p_size < 25 THEN 'NCBITaxon_' || p_size
    ELSE p_type END AS species FROM part
""")
def _(t):
    rows = t.table("part").selectExpr(
        "p_partkey",
        "upper(p_name) AS id",
        "CASE WHEN p_size < 25 THEN 'http://purl.org/obo/NCBITaxon_' || p_size "
        "ELSE p_type END AS species",
    )
    return ds.subject_from_archive(rows, "id", "species")


@query("parse_age_sex", """
SELECT p_partkey, CASE WHEN p_size > 45 THEN 0 WHEN p_size < 3 THEN NULL ELSE p_size END AS age,
    CASE p_size % 3 WHEN 1 THEN 'MALE' WHEN 2 THEN 'FEMALE' END AS sex,
    p_size % 3 = 0 AS sex_violation FROM part
""")
def _(t):
    rows = t.table("part").selectExpr(
        "p_partkey",
        "CASE WHEN p_size > 45 THEN 'oldyr' WHEN p_size < 3 THEN NULL ELSE p_size || 'yr' END AS a",
        "p_size % 3 AS s",
    )
    sex = md.sex_name(F.col("s"))
    return rows.select(
        "p_partkey",
        md.age_in_years(F.col("a")).alias("age"),
        sex.alias("sex"),
        sex.isNull().alias("sex_violation"),
    )


@query("normalize_cre_line", """
SELECT p_partkey, replace(p_brand, '#', '_') || '_IRES' AS cre_line FROM part
""")
def _(t):
    raw = F.concat(F.replace("p_brand", F.lit("#"), F.lit("-")), F.lit("-IRES/wt"))
    return t.table("part").select("p_partkey", md.cre_line(raw).alias("cre_line"))


@query("measurement_date_utc", """
SELECT event_id, CASE event_type WHEN 'error' THEN NULL
    WHEN 'view' THEN epoch_us(ts) - 32400000000 WHEN 'click' THEN epoch_us(ts) + 18000000000
    ELSE epoch_us(ts) END AS utc_us, event_type = 'error' AS missing FROM events
""")
def _(t):
    kind = F.col("event_type")
    local = F.when(kind != "error", F.timestamp_micros(F.col("t")))
    zone = F.when(kind == "view", "+09:00").when(kind == "click", "-05:00")
    utc = md.utc_date(local, zone)
    return t.events.select(
        "event_id", F.unix_micros(utc).alias("utc_us"), utc.isNull().alias("missing")
    )
