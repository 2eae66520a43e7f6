"""From file listing to manifest, and requests to recordings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kymo.functions import metadata as md
from kymo.functions import paths as ph
from kymo.sources.store import kept


def bids_parse(df: DataFrame, path: str) -> DataFrame:
    """Entities, data type, extension and rebuilt recording id of a path."""
    # the name is cut once and every entity found once; later columns refer to them
    found = df.withColumn("name_", ph.file_name(F.col(path))).withColumns(
        {f"{short}_": ph.entity(F.col("name_"), short) for short in ph.ENTITIES.values()}
    )
    tagged = {s: F.concat(F.lit(f"{s}-"), F.col(f"{s}_")) for s in ph.ENTITIES.values()}
    return found.select(
        *df.columns,
        F.concat_ws("_", *tagged.values()).alias("recording_id"),
        tagged["sub"].alias("subject_id"),
        tagged["ses"].alias("session_id"),
        F.col("task_").alias("task_id"),
        F.col("acq_").alias("acquisition_id"),
        F.col("run_").alias("run_id"),
        F.col("desc_").alias("description_id"),
        ph.datatype(F.col(path)).alias("datatype"),
        ph.extension(F.col("name_")).alias("extension"),
    )


def accepted_files(
    df: DataFrame, path: str, kind: str, extensions: Sequence[str]
) -> DataFrame:
    """Files in a folder of the kind, with an accepted extension."""
    p = F.col(path)
    return df.filter(ph.extension(p).isin(list(extensions)) & (ph.datatype(p) == kind))


def fetch_recordings(
    df: DataFrame, path: str, pos: str, kind: str, extensions: Sequence[str]
) -> DataFrame:
    """Files of one kind, the first in input order for each recording id.

    The first row is an aggregate over (position, path), so copies are combined
    before the shuffle; the other fields are parsed from the paths that remain.
    """
    kept = accepted_files(df.select(pos, path), path, kind, extensions)
    first = (
        kept.groupBy(ph.recording_id(F.col(path)).alias("recording_id"))
        .agg(F.min(F.struct(pos, path)).alias("first_"))
        .select("first_.*")
    )
    return bids_parse(first, path)


def fetch_eeg_recordings(df: DataFrame, path: str, pos: str) -> DataFrame:
    return fetch_recordings(df, path, pos, "eeg", ph.EEG_EXTENSIONS)


def fetch_ieeg_recordings(df: DataFrame, path: str, pos: str) -> DataFrame:
    return fetch_recordings(df, path, pos, "ieeg", ph.IEEG_EXTENSIONS)


def group_recordings(
    df: DataFrame,
    ident: str = "recording_id",
    fixed_entities: Sequence[str] | None = None,
    out: str = "group_key",
) -> DataFrame:
    """Every recording with the key of its group; groups are never gathered."""
    return df.withColumn(out, ph.group_key(F.col(ident), fixed_entities))


def recording_files_exist(
    recordings: DataFrame,
    files: DataFrame,
    path: str,
    extensions: Sequence[str],
    subject: str = "subject_id",
    ident: str = "recording_id",
) -> DataFrame:
    """Recordings with a data file ``<id>_*`` below their subject's folder.

    Every leading run of a file name's tokens is a possible id, so the prefix match
    is an equi-join.
    """
    p, tokens = F.col(path), F.col("tokens_")
    heads = F.transform(
        F.sequence(F.lit(1), F.size(tokens) - 1),
        lambda n: F.array_join(F.slice(tokens, F.lit(1), n), "_"),
    )
    known = (
        files.filter(ph.extension(p).isin(list(extensions)))
        .select(path, F.split(ph.file_name(p), "_").alias("tokens_"))
        .filter(F.size(tokens) > 1)
        .select(
            F.regexp_extract(p, "(?:^|/)(sub-[^/]+)/", 1).alias(subject),
            F.explode(heads).alias(ident),
        )
    )
    return recordings.join(known, [subject, ident], "left_semi")


def subject_info(
    recordings: DataFrame, participants: DataFrame | None, subject: str = "subject_id"
) -> DataFrame:
    """Age (a number) and sex of each recording's subject, null where unknown.

    A subject listed more than once keeps a fact on which its known values agree; facts
    that contradict each other count as unknown. Recordings are never multiplied.
    """
    if participants is None:
        participants = recordings.sparkSession.createDataFrame([], f"{subject} string")
    none = F.lit(None).cast("string")
    age = F.col("age") if "age" in participants.columns else none
    sex = F.col("sex") if "sex" in participants.columns else none
    number = md.days_of_age(md.known_text(age))
    facts = participants.select(
        subject,
        F.when(~F.isnan(number), number).alias("age"),
        md.known_text(sex).alias("sex"),
    )
    agreed = [F.when(F.min(c) == F.max(c), F.min(c)).alias(c) for c in ("age", "sex")]
    return recordings.join(facts.groupBy(subject).agg(*agreed), subject, "left")


def build_manifest(
    files: DataFrame,
    path: str,
    pos: str,
    kind: str,
    participants: DataFrame | None,
    species: Column,
    root: str,
    dataset: str,
    tag: str,
) -> DataFrame:
    """Catalog, parse, filter, first per id, address, subject facts, constants.

    No file of the kind at all is an error, found by reading until the first one.
    """
    extensions = {"eeg": ph.EEG_EXTENSIONS, "ieeg": ph.IEEG_EXTENSIONS}[kind]
    if accepted_files(files, path, kind, extensions).isEmpty():
        raise ValueError(f"no {kind} recordings found")
    found = fetch_recordings(files, path, pos, kind, extensions)
    placed = found.select(
        "recording_id",
        "subject_id",
        ph.recording_url(root, dataset, F.col(path), F.col("recording_id")).alias("url"),
        F.lit(tag).alias("snapshot_tag"),
        md.normalize_species(species).alias("species"),
    )
    return subject_info(placed, participants)


# --- ids from the path layouts of single datasets ----------------------------


def reach_session(path: Column) -> Column:
    """``sub-X/sub-X_ses-<task>-<date>_...`` to ``x_<date>_<task name>``."""
    parts = F.split(path, "/")
    subject = F.lower(F.get(F.split(F.get(parts, F.lit(0)), "-"), F.lit(1)))
    fields = F.split(F.get(parts, F.lit(1)), "-")
    task = F.lit(None).cast("string")
    for short, name in md.REACH_TASKS.items():
        task = F.when(F.get(fields, F.lit(2)) == short, name).otherwise(task)
    date = F.get(F.split(F.get(fields, F.lit(3)), "_"), F.lit(0))
    return F.concat(subject, F.lit("_"), date, F.lit("_"), task)


def maze_session(path: Column) -> Column:
    """``sub-Name/..._ses-<id>_...`` to ``name_<id>``."""
    subject = F.lower(F.regexp_replace(F.substring_index(path, "/", 1), "sub-", ""))
    session = F.regexp_extract(path, "_ses-([^_]*)", 1)
    return F.concat(subject, F.lit("_"), session)


def sleep_study(key: Column) -> Column:
    study = F.lit("unknown")
    for folder, name in reversed(md.STUDY_FOLDERS.items()):
        study = F.when(key.contains(folder), name).otherwise(study)
    return study


def sleep_session(key: Column) -> Column:
    return F.concat(sleep_study(key), F.lit("_"), F.regexp_replace(ph.file_name(key), r"\.edf", ""))


def sleep_subject(key: Column) -> Column:
    """Two characters of the name in a known study, else the whole name."""
    base = F.regexp_replace(ph.file_name(key), r"\.edf", "")
    return F.when(sleep_study(key) == "unknown", base).otherwise(F.substring(base, 4, 2))


def matlab_session(url: Column) -> Column:
    """File name in the last but one place of a download address, if it is a .mat."""
    name = F.element_at(F.split(url, "/"), -2)
    return F.when(name.endswith(".mat"), F.substring_index(name, ".", 1))


def navigation_session(name: Column) -> Column:
    """``navigation/<type>/<file>`` to ``<type>_<stem>``, other files to ``sleep_<stem>``."""
    parts = F.split(name, "/")
    kind = F.when(F.get(parts, F.lit(0)) == "navigation", F.get(parts, F.lit(1))).otherwise("sleep")
    return F.concat(kind, F.lit("_"), ph.file_stem(name))


def marker_session(path: Column, marker: str, stem: str) -> Column:
    """``<stem>_test`` where the marker occurs, else ``<stem>_train``."""
    return F.when(path.contains(marker), f"{stem}_test").otherwise(f"{stem}_train")


def pair_by_prefix(
    signals: DataFrame,
    annotations: DataFrame,
    folder: str,
    name: str,
    key: str,
    lengths: Sequence[int] = (7, 6),
    out: str = "annotation_key",
) -> DataFrame:
    """First annotation, in key order, that shares the longest listed name prefix.

    Annotations are reduced to one per folder and prefix before the joins, so no
    pairs of a large folder are formed.
    """
    joined = signals
    found = []
    for n in lengths:
        first = annotations.groupBy(
            F.col(folder), F.substring(name, 1, n).alias(f"head_{n}_")
        ).agg(F.min(key).alias(f"found_{n}_"))
        joined = joined.withColumn(f"head_{n}_", F.substring(name, 1, n)).join(
            first, [folder, f"head_{n}_"], "left"
        )
        found.append(f"found_{n}_")
    return joined.withColumn(out, F.coalesce(*found)).select(*signals.columns, out)


# --- benchmark settings ---------------------------------------------------------

# Eligible (subject, session) pairs per tier, sessions by length per
# subject, the anchor recording, tasks, and folds per evaluation regime.
LITE_PAIRS = (
    (1, 1), (1, 2), (2, 0), (2, 4), (3, 0), (3, 1),
    (4, 0), (4, 1), (7, 0), (7, 1), (10, 0), (10, 1),
)
NANO_PAIRS = ((1, 1), (2, 4), (3, 1), (4, 0), (7, 1), (10, 1))
LONGEST_SESSIONS = {
    1: (0, 1), 2: (4, 6), 3: (2, 1), 4: (2, 1), 5: (0,),
    6: (0, 2), 7: (1, 0), 8: (0,), 9: (0,), 10: (1, 0),
}
ANCHOR = (2, 4)
TIERS = ("full", "lite", "nano")
LABEL_MODES = ("binary", "multiclass")
SETTINGS = ("within_session", "cross_x")
REGIMES = {"SS-SM": "within_session", "SS-DM": "cross_x", "DS-DM": "cross_x"}
REGIME_FOLDS = {"SS-SM": (0, 1), "SS-DM": (0,), "DS-DM": (0,)}
SPLITS = ("train", "val", "test")
TASKS = (
    "delta_volume",
    "face_num",
    "frame_brightness",
    "global_flow",
    "gpt2_surprisal",
    "local_flow",
    "onset",
    "pitch",
    "speech",
    "volume",
    "word_gap",
    "word_head_pos",
    "word_index",
    "word_length",
    "word_part_speech",
)


def _in_pairs(subject: Column, session: Column, pairs: Sequence[tuple[int, int]]) -> Column:
    return F.concat_ws("/", subject, session).isin([f"{a}/{b}" for a, b in pairs])


def settings_grid(recordings: DataFrame, subject: str, session: str) -> DataFrame:
    """Every allowed combination of settings for each recording.

    The few combinations are a literal array that each recording unfolds.
    """
    allowed = [
        (lite, nano, binary, setting)
        for lite in (True, False)
        for nano in (True, False)
        for binary in (True, False)
        for setting in SETTINGS
        if not (lite and nano) and not (nano and setting == "cross_x")
    ]
    names = ("lite", "nano", "binary_tasks", "eval_setting")
    grid = F.array(
        *[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in allowed]
    )
    who = (F.col(subject), F.col(session))
    return (
        recordings.select("*", F.explode(grid).alias("s_"))
        .select(*recordings.columns, "s_.*")
        .filter(~F.col("lite") | _in_pairs(*who, LITE_PAIRS))
        .filter(~F.col("nano") | _in_pairs(*who, NANO_PAIRS))
    )


def selector_key(
    tier: Column, label: Column, setting: Column, task: Column, fold: Column, split: Column
) -> Column:
    """``tier$label$setting$task$foldK$split``."""
    return F.concat_ws(
        "$", tier, label, setting, task, F.concat(F.lit("fold"), fold.cast("string")), split
    )


def _sessions(table: Mapping[int, Sequence[int]], subject: Column) -> Column:
    entries = [x for k, v in table.items() for x in (F.lit(k), F.array(*map(F.lit, v)))]
    return F.create_map(*entries)[subject]


def resolve_split_recordings(requests: DataFrame) -> DataFrame:
    """Recording that serves each request, or why the request is invalid.

    Columns: subject, session (int), tier, regime, fold, split. Same-session requests
    and evaluation use the target; cross-session training the subject's other
    session; cross-subject training the anchor.
    """
    subject, session = F.col("subject"), F.col("session")
    tier, regime, split = F.col("tier"), F.col("regime"), F.col("split")
    lite_table: dict[int, list[int]] = {}
    for s, trial in sorted(LITE_PAIRS):
        lite_table.setdefault(s, []).append(trial)
    lite, longest = _sessions(lite_table, subject), _sessions(LONGEST_SESSIONS, subject)
    folds_ok = F.lit(False)
    for name, folds in REGIME_FOLDS.items():
        folds_ok = folds_ok | ((regime == name) & F.col("fold").isin(list(folds)))
    cross = regime != "SS-SM"
    full_cross = (regime == "SS-DM") & (tier == "full")
    problem = (
        F.when(~tier.isin(*TIERS), "tier")
        .when(~regime.isin(*REGIMES), "regime")
        .when(~folds_ok, "fold")
        .when(~split.isin(*SPLITS), "split")
        .when(cross & (tier == "nano"), "nano_cross")
        .when((regime == "DS-DM") & (subject == ANCHOR[0]), "anchor_subject")
        .when((tier == "lite") & ~_in_pairs(subject, session, LITE_PAIRS), "not_in_lite")
        .when((tier == "nano") & ~_in_pairs(subject, session, NANO_PAIRS), "not_in_nano")
        .when(full_cross & (F.coalesce(F.size(longest), F.lit(0)) < 2), "too_few_sessions")
        .when(full_cross & ~F.array_contains(longest, session), "not_in_longest")
    )

    def other(sessions: Column) -> Column:
        return F.get(F.filter(sessions, lambda x: x != session), F.lit(0))

    elsewhere = F.when(tier == "lite", other(lite)).otherwise(other(longest))
    trains = split == "train"
    who = F.when(trains & (regime == "DS-DM"), ANCHOR[0]).otherwise(subject)
    which = (
        F.when(trains & (regime == "DS-DM"), ANCHOR[1])
        .when(trains & (regime == "SS-DM"), elsewhere)
        .otherwise(session)
    )
    return requests.withColumn("problem", problem).withColumn(
        "recording_id", F.when(F.col("problem").isNull(), ph.encode_recording(who, which))
    )


def recording_groups(
    members: DataFrame, levels: Sequence[str], ident: str, whole: str | None = None
) -> DataFrame:
    """Membership table: one row per recording and group path it belongs to.

    A parent holds the recordings of its children. A recording whose place at some level is
    unknown belongs to the levels above only. ``whole`` names a group of all recordings.
    """
    # a path with an unknown part is null
    paths = [
        F.concat(*[x for name in levels[: i + 1] for x in (F.lit("/"), F.col(name).cast("string"))][1:])
        for i in range(len(levels))
    ]
    if whole is not None:
        paths.insert(0, F.lit(whole))
    each = members.select(F.explode(F.array(*paths)).alias("group_path"), ident)
    return each.filter(F.col("group_path").isNotNull())


def group_name_paths(names: DataFrame) -> DataFrame:
    """What every short name stands for, names of names followed to the end.

    ``names`` has a row (name, target) per part of a name; a target is a group path or another
    name. Every pass joins the reached targets with themselves, so chains of n names take
    log2(n) passes, and a pass keeps every pair once, however many ways lead there. Names that
    lead back to themselves are an error. Rows with a null name or target say nothing.
    """
    reached = kept(names.select("name", "target").dropna().distinct())
    n_pairs = reached.count()
    while True:
        onward = reached.select(F.col("name").alias("target"), F.col("target").alias("onward_"))
        further = reached.join(onward, "target").select("name", F.col("onward_").alias("target"))
        reached = kept(reached.union(further).distinct())
        circle = reached.filter(F.col("name") == F.col("target")).first()
        if circle:
            raise ValueError(f"group name {circle['name']} leads back to itself")
        before, n_pairs = n_pairs, reached.count()
        if before == n_pairs:
            break
    defined = names.select(F.col("name").alias("target")).distinct()
    return reached.join(defined, "target", "left_anti").select(
        "name", F.col("target").alias("group_path")
    )


def named_groups(membership: DataFrame, names: DataFrame, ident: str) -> DataFrame:
    """Membership rows of short names: a name holds the recordings of all it stands for, each once.

    A target that is neither a name nor a group holds nothing; ``unknown_targets`` lists those.
    """
    return (
        membership.join(group_name_paths(names), "group_path")
        .select(F.col("name").alias("group_path"), ident)
        .distinct()
    )


def unknown_targets(membership: DataFrame, names: DataFrame) -> DataFrame:
    """Short names that stand for a group that is not there."""
    groups = membership.select("group_path").distinct()
    return group_name_paths(names).join(groups, "group_path", "left_anti").select("name", "group_path")


def group_sizes(members: DataFrame, levels: Sequence[str], ident: str) -> DataFrame:
    """Recordings per group path at every level."""
    path = F.concat_ws("/", *levels)
    return (
        members.rollup(*levels)
        .agg(F.count(ident).alias("n_recordings"))
        .filter(F.col(levels[0]).isNotNull())
        .select(path.alias("group_path"), "n_recordings")
    )


def group_members(membership: DataFrame, path: str) -> DataFrame:
    """Recordings of one group; an unknown path is an error."""
    found = membership.filter(F.col("group_path") == path)
    if found.isEmpty():
        raise ValueError(f"unknown group {path}")
    return found
