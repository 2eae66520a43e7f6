"""Listing, entity paths, participants, metadata and jobs."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from kymo.functions import metadata as md
from kymo.functions import paths as ph
from kymo.operators import descriptions as ds
from kymo.operators import jobs
from kymo.operators import manifest as mf
from kymo.sources import catalog as cat
from kymo.sources import digests as dg
from kymo.sources import snapshots as snap
from kymo.streaming.arrivals import process_arrivals


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x"))).first()[0]


TREE = [
    f"sub-{s}/ses-01/eeg/sub-{s}_ses-01_task-Sleep_run-{r}_eeg.{e}"
    for s, e in (("1", "edf"), ("2", "BDF"))
    for r in ("01", "02", "03")
] + ["sub-1/ses-01/eeg/sub-1_ses-01_task-Sleep_events.tsv",
     "sub-1/ses-01/ieeg/sub-1_ses-01_task-Sleep_run-09_ieeg.nwb"]


def tree(spark):
    return spark.createDataFrame(list(enumerate(TREE)), "pos bigint, path string")


def test_fetch(spark):
    got = mf.fetch_eeg_recordings(tree(spark), "path", "pos").orderBy("pos").collect()
    assert [r.recording_id for r in got] == [
        f"sub-{s}_ses-01_task-Sleep_run-{r}" for s in "12" for r in ("01", "02", "03")
    ]
    assert got[0].subject_id == "sub-1" and got[0].task_id == "Sleep"
    assert got[0].acquisition_id is None
    assert mf.fetch_ieeg_recordings(tree(spark), "path", "pos").count() == 1
    copies = tree(spark).unionByName(tree(spark).withColumn("pos", F.col("pos") + 100))
    assert mf.fetch_eeg_recordings(copies, "path", "pos").agg(F.max("pos")).first()[0] < 100


def test_grouping(spark):
    ids = ["sub-1_ses-2_task-x_run-01", "sub-1_ses-2_task-x_run-02", "sub-1_Junk_task-x_desc-a"]
    df = spark.createDataFrame([(i,) for i in ids], "recording_id string")
    keys = [r.group_key for r in mf.group_recordings(df).collect()]
    assert keys == ["sub-1_ses-2_task-x"] * 2 + ["sub-1_task-x_desc-a"]
    fixed = [r.group_key for r in mf.group_recordings(df, fixed_entities=["Task", "sub"]).collect()]
    assert fixed == ["sub-1_task-x"] * 3
    with pytest.raises(ValueError):
        mf.group_recordings(df, fixed_entities=["space"])


def test_files_exist(spark):
    recs = [("sub-1", "sub-1_ses-01_task-Sleep"), ("sub-1", "sub-1_ses-01_task-Sl"), ("sub-9", "sub-9")]
    df = spark.createDataFrame(recs, "subject_id string, recording_id string")
    got = mf.recording_files_exist(df, tree(spark), "path", ph.EEG_EXTENSIONS).collect()
    assert [r.recording_id for r in got] == ["sub-1_ses-01_task-Sleep"]


def test_build_manifest(spark):
    people = spark.createDataFrame([("sub-1", "34", "F"), ("sub-2", "n/a", "N/A")],
                                   "subject_id string, age string, sex string")
    args = ("path", "pos", "eeg", people, F.lit(" Humans"), "s3://b", "ds1", "1.0")
    got = mf.build_manifest(tree(spark), *args).orderBy("recording_id").collect()
    assert got[0].url == "s3://b/ds1/sub-1/ses-01/eeg/sub-1_ses-01_task-Sleep_run-01"
    assert (got[0].age, got[0].sex, got[0].species) == (34.0, "F", "HOMO_SAPIENS")
    assert (got[-1].age, got[-1].sex) == (None, None)
    with pytest.raises(ValueError):
        mf.build_manifest(tree(spark).limit(0), *args)
    assert mf.subject_info(tree(spark).select(F.lit("sub-1").alias("subject_id")), None).first().age is None


def test_repeated_subjects(spark):
    people = spark.createDataFrame(
        [("a", "34", "F"), ("a", "34", "n/a"), ("b", "20", "M"), ("b", "21", "M"), (None, "9", "F")],
        "subject_id string, age string, sex string",
    )
    recordings = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, None)], "r int, subject_id string")
    got = mf.subject_info(recordings, people).orderBy("r").collect()
    assert [(r.r, r.age, r.sex) for r in got] == [(1, 34.0, "F"), (2, None, "M"), (3, None, None), (4, None, None)]


def test_listing_keys(spark):
    keys = ["p/a.txt", "p/d/", "p/d/b.txt", "q/c.txt", "p/"]
    df = spark.createDataFrame([(k,) for k in keys], "key string")
    assert [r.relative for r in cat.file_catalog(df, "key", "p/").collect()] == ["a.txt", "d/b.txt"]
    assert ph.strip_prefix_of("ds1") == "ds1/" and ph.strip_prefix_of("a/b/c") == "a/"
    assert ph.strip_prefix_of("a/b", "a/b//") == "a/b/"
    assert one(spark, lambda c: ph.local_path(c, "a/b"), "a/b/c") == "b/c"
    assert one(spark, lambda c: ph.local_path(c, "a/b"), "z/b/c") == "z/b/c"
    row = cat.parse_object_url(
        spark.createDataFrame([("s3://buck/x/y",), ("https://h/x",)], "u string"), "u"
    ).collect()
    assert [(r.bucket, r.prefix, r.is_valid) for r in row] == [("buck", "x/y", True), ("h", "x", False)]
    assert one(spark, ph.parent_dir, "a.edf") == "."


def test_files_on_disk(spark, tmp_path):
    (tmp_path / "in" / "sub").mkdir(parents=True)
    (tmp_path / "in" / "a.json").write_text(json.dumps({"rate": 5, "name": "x"}, indent=1))
    (tmp_path / "in" / "sub" / "b.txt").write_text("hello")
    root = str(tmp_path / "in")
    assert {r.key.rsplit("/", 1)[1]: r.length for r in cat.list_files(spark, root).collect()}["b.txt"] == 5
    digests = {r.key.rsplit("/", 1)[1]: r.md5 for r in dg.file_digests(spark, root).collect()}
    assert digests["b.txt"] == "5d41402abc4b2a76b9719d911017c592"
    recs = spark.createDataFrame([("a",), ("z",)], "stem string")
    got = cat.attach_sidecar(recs, cat.read_json_sidecars(spark, root), ["stem"], "rate int")
    assert {(r.stem, r.has_sidecar, r.sidecar.rate if r.sidecar else None) for r in got.collect()} == {
        ("a", True, 5), ("z", False, None)
    }


def test_digests_by_ranges(spark, tmp_path, monkeypatch):
    root = tmp_path / "in"
    (root / "sub").mkdir(parents=True)
    data = {"a.bin": bytes(range(256)) * 40, "empty": b"", "sub/exact": b"x" * 200, "sub/one": b"y"}
    for name, content in data.items():
        (root / name).write_bytes(content)
    (root / "_SUCCESS").write_bytes(b"z")
    (root / ".a.crc").write_bytes(b"z")
    monkeypatch.setattr(dg, "TASK_BYTES", 1000)
    monkeypatch.setattr(dg, "OPEN_BYTES", 10)
    monkeypatch.setattr(dg, "READ_BYTES", 7)

    def md5(x):
        return hashlib.md5(x)

    def etag(x, size):
        parts = [md5(x[i : i + size]).digest() for i in range(0, max(len(x), 1), size)]
        return f"{md5(b''.join(parts)).hexdigest()}-{len(parts)}"

    whole = {r.name: (r.length, r.md5) for r in dg.file_digests(spark, str(root)).collect()}
    assert whole == {n: (len(x), md5(x).hexdigest()) for n, x in data.items()}
    for size in (100, 10_240, 1 << 20):
        got = {r.name: r.etag for r in dg.multipart_digests(spark, f"file:{root}/", size).collect()}
        assert got == {n: etag(x, size) for n, x in data.items()}
    # one file is spread over tasks
    parts = dg.part_digests(spark, str(root), 100)
    tasks = parts.filter("name = 'a.bin'").select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks >= 10
    listed = spark.createDataFrame(
        [("a.bin", etag(data["a.bin"], 100)), ("sub/one", "0-1"), ("gone", "1-1")], "name string, md5 string"
    )
    checked = {r.name: r.action for r in dg.verify_files(spark, str(root), listed, part_bytes=100).collect()}
    assert checked == {"a.bin": "skip", "empty": "fetch", "sub/exact": "fetch", "sub/one": "fetch"}
    listed = spark.createDataFrame([("sub/one", md5(b"y").hexdigest())], "name string, md5 string")
    checked = {r.name: r.digest_ok for r in dg.verify_files(spark, str(root), listed).collect()}
    assert checked == {"a.bin": False, "empty": False, "sub/exact": False, "sub/one": True}
    (tmp_path / "none").mkdir()
    assert dg.multipart_digests(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(ValueError):
        dg.multipart_digests(spark, str(root), 0)


def test_digest_of_a_file_that_shrinks(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"x" * 5000)
    source = dg._source()({"path": str(tmp_path), "partBytes": "0"})
    reader = source.reader(None)
    (partition,) = reader.partitions()
    (tmp_path / "a").write_bytes(b"x" * 10)
    with pytest.raises(OSError, match="early"):
        list(reader.read(partition))


def test_participants(spark, tmp_path):
    path = tmp_path / "participants.tsv"
    path.write_text("participant_id\tage\tsex\nsub-01\t34\tF\nsub-02\tn/a\tN/A\nsub-03\t28\tM\n")
    got = {r.participant_id: (r.age, r.sex) for r in cat.read_participants(spark, str(path)).collect()}
    assert got == {"sub-01": ("34", "F"), "sub-02": (None, None), "sub-03": ("28", "M")}
    path.write_text("name\tage\nx\t1\n")
    assert cat.read_participants(spark, str(path)) is None


def test_checksums(spark, tmp_path):
    path = tmp_path / "md5sums.txt"
    path.write_text("# list\n\nABC *a b.mat\n def  c.mat\nlonely\n")
    got = {(r.name, r.md5) for r in cat.read_checksums(spark, str(path)).collect()}
    assert got == {("a b.mat", "abc"), ("c.mat", "def")}


def test_codec_and_requests(spark):
    ids = spark.createDataFrame([(1, 4), (-1, 0), (3, 1000)], "a int, b int")
    got = [r[0] for r in ids.select(ph.encode_recording(F.col("a"), F.col("b"))).collect()]
    assert got == ["sub_1_trial004", None, None]
    assert one(spark, lambda c: ph.decode_recording(c, 2), "sub_1_trial4") is None
    rows = [
        (1, 1, "lite", "SS-SM", 1, "train"), (1, 1, "lite", "SS-DM", 0, "train"),
        (3, 2, "full", "SS-DM", 0, "train"), (3, 1, "full", "SS-DM", 0, "train"),
        (4, 0, "lite", "DS-DM", 0, "train"), (4, 0, "lite", "DS-DM", 0, "val"),
        (2, 4, "lite", "DS-DM", 0, "val"), (5, 0, "full", "SS-DM", 0, "test"),
        (1, 1, "nano", "SS-DM", 0, "test"), (1, 1, "lite", "SS-DM", 1, "test"),
    ]
    df = spark.createDataFrame(
        rows, "subject int, session int, tier string, regime string, fold int, split string"
    )
    got = [(r.recording_id, r.problem) for r in mf.resolve_split_recordings(df).collect()]
    assert got == [
        ("sub_1_trial001", None), ("sub_1_trial002", None), ("sub_3_trial001", None),
        ("sub_3_trial002", None), ("sub_2_trial004", None), ("sub_4_trial000", None),
        (None, "anchor_subject"), (None, "too_few_sessions"), (None, "nano_cross"), (None, "fold"),
    ]


def test_groups(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 3)], "p string, q string, id int")
    members = mf.recording_groups(df, ["p", "q"], "id")
    assert sorted(r.id for r in mf.group_members(members, "a").collect()) == [1, 2]
    sizes = {r.group_path: r.n_recordings for r in mf.group_sizes(df, ["p", "q"], "id").collect()}
    assert sizes == {"a": 2, "a/x": 1, "a/y": 1, "b": 1, "b/x": 1}
    with pytest.raises(ValueError):
        mf.group_members(members, "zzz")


def test_group_names(spark):
    rows = [("a", "x", 1), ("a", "y", 2), ("b", "x", 3), ("b", None, 4), (None, "z", 5)]
    df = spark.createDataFrame(rows, "p string, q string, id int")
    members = mf.recording_groups(df, ["p", "q"], "id", whole="all")
    held = sorted((r.group_path, r.id) for r in members.collect())
    assert held == sorted(
        [("all", i) for i in range(1, 6)] + [("a", 1), ("a", 2), ("b", 3), ("b", 4), ("a/x", 1), ("a/y", 2), ("b/x", 3)]
    )
    # a chain of seven names, two ways to one group, a target that is not there, an unknown one
    pairs = [(f"n{i}", f"n{i + 1}") for i in range(6)] + [("n6", "a/x"), ("n3", "b"), ("n0", "b"), ("odd", "no"), ("odd", None)]
    names = spark.createDataFrame(pairs, "name string, target string")
    got = {}
    for r in mf.named_groups(members, names, "id").collect():
        got.setdefault(r.group_path, []).append(r.id)
    want = {f"n{i}": [1, 3, 4] if i < 4 else [1] for i in range(7)}
    assert {k: sorted(v) for k, v in got.items()} == want
    assert [tuple(r) for r in mf.unknown_targets(members, names).collect()] == [("odd", "no")]
    circle = spark.createDataFrame(pairs + [("n6", "n2")], "name string, target string")
    with pytest.raises(ValueError, match="leads back"):
        mf.group_name_paths(circle)


def test_descriptions(spark):
    rows = [("m1", "MOUSE", "12.5", "F"), ("", "MOUSE", "-1", ""), ("m3", None, "old", None)]
    got = ds.describe_subject(
        spark.createDataFrame(rows, "id string, species string, age string, sex string")
    )
    assert [r.violations for r in got.collect()] == ["", "id,sex,age", "age"]
    with pytest.raises(Exception):
        ds.require_valid(got).collect()
    with pytest.raises(ValueError):
        ds.describe_dataset(got.withColumn("engine_version", F.lit("9")))
    assert one(spark, md.taxon, "http://x/NCBITaxon_9544") == "NCBITaxon_9544"
    assert one(spark, md.cre_line, "Vip-IRES-Cre/wt") == "Vip_IRES_Cre"
    assert [one(spark, md.age_in_years, v) for v in ("33yr", "xx", None)] == [33, 0, None]
    micros = spark.createDataFrame([(1_500_000,), (2_000_000,)], "t bigint")
    assert [r[0] for r in micros.select(md.timestamp_text(F.col("t"))).collect()] == [
        "1970-01-01 00:00:01.500000", "1970-01-01 00:00:02"
    ]


def test_run_manifest_isolates_failures(spark):
    items = spark.createDataFrame([(i,) for i in range(6)], "i int")

    def fetch(item):
        if item["i"] == 3:
            raise OSError("gone")
        return item["i"] * 2

    def process(item, fetched):
        if fetched == 8:
            raise ValueError("bad")

    ledger = jobs.run_manifest(items, "i", fetch, process, tasks=3)
    got = {r.item_id: (r.status, r.error) for r in ledger.collect()}
    assert got["3"] == ("FAILED", "OSError: gone") and got["4"] == ("FAILED", "ValueError: bad")
    assert sum(s == "DONE" for s, _ in got.values()) == 4
    only = jobs.run_manifest(items, "i", fetch, process, download_only=True, single="4").collect()
    assert [(r.item_id, r.status) for r in only] == [("4", "DONE")]
    assert {r.status: (r.n_items, r.all_done) for r in jobs.run_ledger(ledger).collect()} == {
        "DONE": (4, False), "FAILED": (2, False)
    }
    assert [r.item_id for r in jobs.not_done(ledger).collect()] == ["3", "4"]
    assert jobs.incremental_skip(items, items.filter("i < 4"), ["i"]).count() == 2
    assert jobs.incremental_skip(items, items, ["i"], reprocess=True).count() == 6


FRAME = "dataset_id string, recording_id string, v int"


def values(spark, root, component="spikes"):
    got = snap.read_component(spark, root, component, "v int, dataset_id string, recording_id string")
    return {(r.recording_id, r.v) for r in got.collect()}


def test_write_recording_replaces_only_what_is_written(spark, tmp_path):
    root = str(tmp_path / "out")
    assert values(spark, root) == set() and snap.committed(spark, root).count() == 0
    first = spark.createDataFrame([("d", "a", 1), ("d", "b", 2), ("d", None, 3), ("d", "", 4)], FRAME)
    snap.write_recording({"spikes": first, "trials": first}, root)
    snap.write_recording({"spikes": spark.createDataFrame([("d", "b", 9)], FRAME)}, root)
    assert values(spark, root) == {("a", 1), ("b", 9), (None, 3), (None, 4)}
    assert values(spark, root, "trials") == {("a", 1), ("b", 2), (None, 3), (None, 4)}
    assert {r.recording_id for r in snap.committed(spark, root).collect()} == {"a", "b", None}
    assert snap.superseded(spark, root).count() == 0
    # a recording that lost all rows, and one that never had any, are finished and empty
    keys = spark.createDataFrame([("d", "a"), ("d", "b"), ("d", ""), ("d", "new")], "dataset_id string, recording_id string")
    last = snap.write_recording({"spikes": first.filter("v = 1"), "trials": first.limit(0)}, root, recordings=keys)
    assert values(spark, root) == {("a", 1)} and values(spark, root, "trials") == set()
    assert {r.recording_id for r in snap.committed(spark, root).collect()} == {"a", "b", None, "new"}
    assert snap.superseded(spark, root).filter(F.col("version") != last).count() == 2


def test_a_write_that_dies_leaves_the_old_recordings(spark, tmp_path):
    root = str(tmp_path / "out")
    first = spark.createDataFrame([("d", "a", 1), ("d", "b", 2)], FRAME)
    snap.write_recording({"spikes": first, "trials": first}, root)
    second = spark.createDataFrame([("d", "b", 7), ("d", "c", 8)], FRAME)
    broken = second.withColumn("v", F.raise_error(F.lit("killed")).cast("int"))
    with pytest.raises(Exception, match="killed"):
        snap.write_recording({"spikes": second, "trials": broken}, root)
    assert values(spark, root) == {("a", 1), ("b", 2)} == values(spark, root, "trials")
    items = second.select("dataset_id", "recording_id")
    todo = jobs.incremental_skip(items, snap.committed(spark, root), ["dataset_id", "recording_id"])
    assert {r.recording_id for r in todo.collect()} == {"c"}
    snap.write_recording({"spikes": second, "trials": second}, root)
    assert values(spark, root) == {("a", 1), ("b", 7), ("c", 8)} == values(spark, root, "trials")


def test_commits_side_by_side(spark, tmp_path):
    root = str(tmp_path / "out")
    one, two = (spark.createDataFrame([("d", "007", v), ("e", f"{v}", v)], FRAME) for v in (1, 2))
    staged = [snap.stage({"spikes": df}, root) for df in (one, two)]
    assert values(spark, root) == set()
    # the later commit wins, whichever was staged first
    for version in reversed(staged):
        snap.commit(spark, root, version, ["spikes"])
    assert values(spark, root) == {("007", 1), ("1", 1), ("2", 2)}
    typed = snap.read_component(spark, root, "spikes", "v int, recording_id bigint")
    assert {(r.recording_id, r.v) for r in typed.collect()} == {(7, 1), (1, 1), (2, 2)}
    pruned = snap.read_component(spark, root, "spikes", FRAME).filter("dataset_id = 'e'")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dataset_id" in plan
    with pytest.raises(ValueError):
        snap.write_recording({"_commits": one}, root)


def test_arrivals_handle_each_file_once(spark, tmp_path):
    seen = []
    src, mark = str(tmp_path / "in"), str(tmp_path / "mark")

    def run():
        query = process_arrivals(
            spark, src, "id long", mark, lambda df, n: seen.extend(r.id for r in df.collect())
        )
        query.awaitTermination(120)

    spark.range(3).write.parquet(src)
    run()
    run()
    spark.range(10, 12).write.mode("append").parquet(src)
    run()
    assert sorted(seen) == [0, 1, 2, 10, 11]
