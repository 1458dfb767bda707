"""A journal of byte moves: which raw object goes where, and how far it has come.

A migration decides on moves; the storage's transfer job makes them. The journal keeps each
move's state, so that a run that stops anywhere goes on from there:

    planned -> copied -> verified -> removed

A move is planned once; planning again leaves moves that are under way as they are. A state
is only ever followed by the next one, and every change is one commit of a versioned table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from docflow.sinks import versions

STATES = ("planned", "copied", "verified", "removed")
MOVE = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("document_id", "source_uri", "target_uri", "state")]
)


def journal_path(root: str) -> str:
    return f"{root.rstrip('/')}/journal/moves"


def read(spark: SparkSession, root: str) -> DataFrame:
    """All moves with their states; no rows where nothing was planned."""
    return versions.read(spark, journal_path(root), MOVE)


def plan(spark: SparkSession, root: str, moves: DataFrame) -> None:
    """Add moves (document_id, source_gcs_uri, target_uri) that are not there yet.

    A document whose move has ended may be planned again to another target; one that is under
    way keeps its entry.
    """
    wanted = moves.select(
        "document_id", F.col("source_gcs_uri").alias("source_uri"), "target_uri", F.lit(STATES[0]).alias("state")
    ).dropDuplicates(["document_id"])
    known = read(spark, root)
    open_moves = known.where(F.col("state") != STATES[-1]).select("document_id")
    done = known.where(F.col("state") == STATES[-1]).select("document_id", "target_uri")
    new = wanted.join(open_moves, "document_id", "left_anti").join(done, ["document_id", "target_uri"], "left_anti")
    versions.upsert(spark, new.select(*MOVE.names), journal_path(root), "document_id")


def pending(spark: SparkSession, root: str, state: str) -> DataFrame:
    """Moves in a state: what the step that follows it has to do."""
    if state not in STATES:
        raise ValueError(f"no such state: {state!r}")
    return read(spark, root).where(F.col("state") == state)


def advance(spark: SparkSession, root: str, done: DataFrame, state: str) -> None:
    """Say that moves (document_id) have reached a state. Moves that are not in the state before
    it stay as they are, so saying it again, or too early, changes nothing."""
    before = STATES[STATES.index(state) - 1] if state in STATES[1:] else None
    if before is None:
        raise ValueError(f"no step leads to {state!r}")
    reached = pending(spark, root, before).join(done.select("document_id"), "document_id", "left_semi")
    changed = reached.withColumn("state", F.lit(state)).select(*MOVE.names)
    versions.upsert(spark, changed, journal_path(root), "document_id")
