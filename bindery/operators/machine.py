"""The job state machine: stages by package type and status, outcomes, and chains of them."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .queueing import RELEASE_STATES

RETRIES = 5
#: Package type: (status, stage, status after success, status after failure; empty means punted).
STAGES = {
    "ia": (
        ("ready", "Download", "downloaded", "ready"), ("downloaded", "VerifyManifest", "manifest_verified", "punted"), ("manifest_verified", "Unpack", "unpacked", "ready"), ("unpacked", "DeleteCheck", "delete_checked", "punted"),
        ("delete_checked", "OCRSplit", "ocr_extracted", ""), ("ocr_extracted", "ImageRemediate", "images_remediated", ""), ("images_remediated", "SourceMETS", "src_metsed", "punted"), ("src_metsed", "VolumeValidator", "validated", "punted"),
        ("validated", "Pack", "packed", ""), ("packed", "METS", "metsed", "punted"), ("metsed", "Handle", "handled", ""), ("handled", "Collate", "collated", "punted"), ("needs_uplift", "RepositoryUnpack", "uplift_unpacked", ""), ("uplift_unpacked", "ReMETS", "uplift_done", "punted"),
    ),
    "simple": (
        ("ready", "Download", "downloaded", "ready"), ("downloaded", "Unpack", "unpacked", "ready"), ("unpacked", "VerifyManifest", "manifest_verified", "punted"), ("manifest_verified", "ImageRemediate", "images_remediated", ""),
        ("images_remediated", "SourceMETS", "src_metsed", "punted"), ("src_metsed", "VolumeValidator", "validated", "punted"), ("validated", "Pack", "packed", ""), ("packed", "METS", "metsed", "punted"), ("metsed", "Handle", "handled", ""), ("handled", "Collate", "collated", "punted"),
    ),
    "epub": (
        ("ready", "Unpack", "unpacked", "ready"), ("unpacked", "VerifyManifest", "manifest_verified", "punted"), ("manifest_verified", "SourceMETS", "src_metsed", "punted"), ("src_metsed", "VolumeValidator", "validated", "punted"),
        ("validated", "Pack", "packed", ""), ("packed", "METS", "metsed", "punted"), ("metsed", "Handle", "handled", ""), ("handled", "Collate", "collated", "punted"),
    ),
    "emma": (
        ("ready", "Unpack", "unpacked", "ready"), ("unpacked", "VirusScan", "scanned", "punted"), ("scanned", "SourceMETS", "src_metsed", "punted"), ("src_metsed", "Pack", "packed", ""), ("packed", "METS", "metsed", "punted"), ("metsed", "Handle", "handled", ""), ("handled", "Collate", "collated", "punted"),
    ),
}


Stage = tuple[str, str, str, str, str]


def stage_rows(own: Iterable[Stage] = ()) -> list[Stage]:
    """All stages as (pkg_type, status, stage, status after success, status after failure); own ones add to the table or take the place of its rows."""
    rows = {(pkg, stage[0]): (pkg, *stage) for pkg, stages in STAGES.items() for stage in stages}
    return list((rows | {(row[0], row[1]): row for row in own}).values())


def transitions(spark: SparkSession, own: Iterable[Stage] = ()) -> DataFrame:
    """The table of stage_rows(): a few dozen rows, always."""
    return spark.createDataFrame(stage_rows(own), "pkg_type string, status string, stage string, success_state string, failure_state string")


def new_status(success: Column, success_state: Column, failure_state: Column, failure_count: Column, limit: int = RETRIES) -> Column:
    """After a stage: its success state; or its failure state, punted once too many failures were counted before or where it names none."""
    failed = F.when(failure_count >= limit, "punted").otherwise(failure_state)
    return F.coalesce(F.nullif(F.when(F.coalesce(success, F.lit(False)), success_state).otherwise(failed), F.lit("")), F.lit("punted"))


def outcome(stages: dict[str, Column], forced: Column | None = None) -> Column:
    """The success of a job's next stage by the stage's own column; a stage without one did nothing, which is a failure.

    Where `forced` is not null a stage is taken to have ended as it says.
    """
    own = [F.when(F.col("stage") == name, done) for name, done in stages.items()]
    return F.coalesce(*([] if forced is None else [forced]), *own, F.lit(False))


def step(jobs: DataFrame, stages: DataFrame, success: Column | None = None) -> DataFrame:
    """jobs (pkg_type, status, failure_count, success) after their next stage; a status without stage is punted.

    Adds stage, new_status, release and the successor's new_failure_count. `success`
    may be given as a column that knows the stage, see outcome().
    """
    joined = jobs.join(F.broadcast(stages), ["pkg_type", "status"], "left")  # a few dozen rows
    if success is not None:
        joined = joined.withColumn("success", success)
    after = F.when(F.col("stage").isNull(), "punted").otherwise(new_status(F.col("success"), F.col("success_state"), F.col("failure_state"), F.col("failure_count")))
    fail = F.col("stage").isNull() | ~F.coalesce("success", F.lit(False))
    return joined.withColumns({"new_status": after, "release": after.isin(*RELEASE_STATES), "new_failure_count": F.col("failure_count") + fail.cast("long")}).drop("success_state", "failure_state")


STEPS = "array<struct<turn:int,at:int,to:int,failures:bigint>>"


def trace(jobs: DataFrame, succeeds: Callable[[Column, Column], Column]) -> DataFrame:
    """All steps of jobs (pkg_type, namespace, id, status, failure_count) until they are released.

    succeeds gives an outcome from (stage, failures so far). A chain runs through
    at most all stages of its type between two failures, and no more than RETRIES
    failures lead on, so each job's steps are one fold of bounded length over its
    own row: no join and no shuffle, whatever the number of jobs. A job that were
    not released then would be an error.
    """
    most = (RETRIES + 2) * max(map(len, STAGES.values()))
    # statuses by number: 0 is one without stage, 1 the state after that
    states: list[tuple[str | None, str | None]] = [(None, None), (None, "punted")]
    for pkg, stages in STAGES.items():
        states += [(pkg, s) for s in dict.fromkeys([*(s for row in stages for s in (row[0], row[2], row[3]) if s), "punted"])]
    number = {state: i for i, state in enumerate(states)}
    known = {(pkg, status): (stage, good, bad) for pkg, stages in STAGES.items() for status, stage, good, bad in stages}
    after = [known.get(state, (None, "punted", "punted")) for state in states]
    places = [number.get((pkg, "punted"), 1) for pkg, _ in states]
    listed = lambda values: F.array(*map(F.lit, values))
    stage_of, released = listed([x[0] for x in after]), listed([s in RELEASE_STATES for _, s in states])
    good, bad, punted = listed([number.get((pkg, x[1]), 1) for (pkg, _), x in zip(states, after)]), listed([number.get((pkg, x[2] or "punted"), 1) for (pkg, _), x in zip(states, after)]), listed(places)
    begin = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for (pkg, s), i in number.items() if pkg for x in (f"{pkg}:{s}", i))), F.concat("pkg_type", F.lit(":"), "status")), F.lit(0))

    def step_(acc: Column, turn: Column) -> Column:
        at = acc["at"]
        stage = F.get(stage_of, at)
        ok = F.coalesce(succeeds(stage, acc["failures"]), F.lit(False)) & stage.isNotNull()
        to = F.when(ok, F.get(good, at)).when(stage.isNull() | (acc["failures"] >= RETRIES), F.get(punted, at)).otherwise(F.get(bad, at))
        failures = acc["failures"] + F.when(ok, 0).otherwise(1)
        done = F.struct(turn.alias("turn"), at.alias("at"), to.alias("to"), failures.alias("failures"))
        moved = F.struct(to.alias("at"), failures.alias("failures"), F.get(released, to).alias("released"), F.array_append(acc["steps"], done).alias("steps"))
        return F.when(acc["released"], acc).otherwise(moved.cast(f"struct<at:int,failures:bigint,released:boolean,steps:{STEPS}>"))

    start = F.struct(begin.alias("at"), F.col("failure_count").alias("failures"), F.lit(False).alias("released"), F.array().cast(STEPS).alias("steps")).cast(f"struct<at:int,failures:bigint,released:boolean,steps:{STEPS}>")
    folded = jobs.select("pkg_type", "namespace", "id", F.col("status").alias("first"), F.aggregate(F.sequence(F.lit(1), F.lit(most)), start, step_).alias("f"))
    steps = F.when(F.col("f.released"), F.col("f.steps")).otherwise(F.raise_error(F.concat(F.lit("not released: "), "id")).cast(STEPS))
    names = listed([s for _, s in states])
    each = folded.select("pkg_type", "namespace", "id", "first", F.inline(steps))
    return each.select("pkg_type", "namespace", "id", "turn", F.coalesce(F.get(names, "at"), "first").alias("status"), F.get(stage_of, "at").alias("stage"), F.get(names, "to").alias("new_status"), "failures")


def ahead(jobs: DataFrame, own: Iterable[Stage] = ()) -> DataFrame:
    """jobs (pkg_type, status) with one row for each stage that lies before them, numbered `at` from 1, were all to succeed.

    A status without stage has none, and its job no row. The chains are a table of
    the size of all stages; one that leads back into itself ends before its first stage comes again.
    """
    rows = stage_rows(own)
    by_status = {(pkg, status): (stage, good) for pkg, status, stage, good, _ in rows}
    chains = []
    for pkg, first, *_ in rows:
        names, seen, status = [], set(), first
        while (pkg, status) in by_status and status not in seen:
            seen.add(status)
            stage, status = by_status[pkg, status]
            names.append(stage)
        chains.append((pkg, first, names))
    table = jobs.sparkSession.createDataFrame(chains, "pkg_type string, status string, _stages array<string>")
    met = jobs.join(F.broadcast(table), ["pkg_type", "status"])  # a few dozen rows
    return met.select(*jobs.columns, F.posexplode("_stages").alias("at", "stage")).withColumn("at", F.col("at") + 1)


def first_failure(*steps: tuple[str, Column]) -> Column:
    """The name of the first step that failed, or null: later ones were not run."""
    return F.coalesce(*(F.when(~ok, F.lit(name)) for name, ok in steps))
