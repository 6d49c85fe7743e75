"""The annotation log as a stream: session versions with state per (segment, annotator), and micro-batch sinks."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tamarin.operators.annotations import SESSION_MS, guard_events

VERSION = "id string, annotateur string, version int, corrected string, note int, at long"


def event_stream(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 48) -> DataFrame:
    """New files of a folder as a stream, a bounded number at a time."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def _merged(sessions: list[list], events: list[list], gap_ms: int) -> list[list]:
    """Sessions ``[first, last, *newest event]`` with further events ``[at, arrival, corrected, note]``: an event belongs to a session
    if it is less than ``gap_ms`` from its first or last one, and joins two sessions if it belongs to both. In whatever order events
    come, the result is that of all of them sorted."""
    order = lambda e: (e[0], e[1] is not None, e[1] or 0, e[2] is not None, e[2] or "", e[3] is not None, e[3] or 0)
    out: list[list] = []
    for s in sorted([*sessions, *([e[0], e[0], *e] for e in events)], key=lambda s: (s[0], s[1])):
        if out and s[0] - out[-1][1] < gap_ms:
            last = out[-1]
            out[-1] = [last[0], max(last[1], s[1]), *max(last[2:], s[2:], key=order)]
        else:
            out.append(s)
    return out


def version_updates(events: DataFrame, gap_ms: int = SESSION_MS) -> DataFrame:
    """All session versions of each (id, annotateur) that a batch touches: ``VERSION``. They replace those that came out before, so a
    late event may add a version, change one or join two. The state of a key is one entry per version, not per event.

    A null ``at`` counts as 0; events of one time go by arrival (``recu_le``), then text, then note.
    """

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        known = json.loads(state.get[0]) if state.exists else []
        none = lambda v: v is None or v is pd.NaT or v != v
        new = []
        for rows in parts:
            for at, came, text, note in zip(rows["at"], rows["came"], rows["corrected"], rows["note"]):
                new.append([0 if none(at) else int(at), None if none(came) else int(came), None if none(text) else text, None if none(note) else int(note)])
        sessions = _merged(known, new, gap_ms)
        state.update((json.dumps(sessions),))
        out = [(key[0], key[1], i, s[4], s[5], s[2]) for i, s in enumerate(sessions, 1)]
        frame = pd.DataFrame(out, columns=["id", "annotateur", "version", "corrected", "note", "at"])
        yield frame.astype({"note": "Int32"})

    keyed = events.select("id", "annotateur", "corrected", "note", "at", F.unix_micros(F.col("recu_le").cast("timestamp")).alias("came"))
    return keyed.groupBy("id", "annotateur").applyInPandasWithState(step, VERSION, "sessions string", "update", GroupStateTimeout.NoTimeout)


def run_versions(updates: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append each batch's updates with its number; ``current_versions`` reads them. A replayed batch overwrites its own folder, so
    the sink is idempotent."""

    def sink(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={n}")

    w = updates.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(sink)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="20 seconds")).start()


def current_versions(spark: SparkSession, path: str) -> DataFrame:
    """The versions of each (id, annotateur) as the last batch that touched it wrote them."""
    df = spark.read.option("basePath", path).schema(VERSION + ", batch int").parquet(path)
    newest = F.rank().over(Window.partitionBy("id", "annotateur").orderBy(F.desc("batch")))
    return df.withColumn("_newest", newest).where("_newest = 1").drop("_newest", "batch")


def flush_log(events: DataFrame, path: str, checkpoint: str, available_now: bool = True, index: DataFrame | None = None) -> StreamingQuery:
    """Micro-batch flush of the log. Each batch writes a new generation, ``path/gen=<batch>/annotateur=<name>``, of the annotators in
    it alone: their earlier rows and the new ones, sorted by (id, at); equal rows stay as many as they are. Nothing is overwritten,
    so after a crash the older generations stand, and a replayed batch starts from them again. ``flushed_log`` reads the newest
    generation of each annotator, ``vacuum_log`` removes the others. With ``index`` events are guarded first: unknown segments go,
    notes are clamped, milestones cleaned."""

    def sink(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        rows = batch if index is None else guard_events(batch, index).select(*batch.columns)
        old = _generations(spark, path, rows.schema, before=n)
        if old is not None:
            who = rows.select(F.col("annotateur").alias("_who")).distinct()
            rows = rows.unionByName(old.join(who, F.col("annotateur").eqNullSafe(F.col("_who")), "left_semi").select(*rows.columns))
        # a range, not a hash, of the names: a hot annotator's rows are sorted by several tasks
        rows.repartitionByRange("annotateur", "id", "at").sortWithinPartitions("annotateur", "id", "at").write.mode("overwrite").option("ignoreNullFields", False).partitionBy("annotateur").json(f"{path}/gen={n}")

    w = events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(sink)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="20 seconds")).start()


def _folders(spark: SparkSession, path: str, prefix: str) -> dict[str, str]:
    """The folders of a name and value below ``path``: value to path; none where the path does not exist."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return {n[len(prefix) :]: f"{path}/{n}" for n in names if n.startswith(prefix)}


def _generations(spark: SparkSession, path: str, schema, before: int | None = None) -> DataFrame | None:
    """The newest finished generation of each annotator, of batches before ``before``; None where there is none."""
    done = [(int(g), at) for g, at in _folders(spark, path, "gen=").items() if (before is None or int(g) < before) and _folders(spark, at, "_SUCCESS")]
    if not done:
        return None
    newest = {who: g for g, at in sorted(done) for who in _folders(spark, at, "annotateur=")}  # from the listing alone
    live = [f"{path}/gen={g}/annotateur={who}" for who, g in newest.items()]
    return spark.read.schema(schema).option("basePath", path).json(live).select(*schema.names) if live else None


def flushed_log(spark: SparkSession, path: str, schema) -> DataFrame:
    """The log as the last flush left it."""
    rows = _generations(spark, path, schema)
    return spark.createDataFrame([], schema) if rows is None else rows


def vacuum_log(spark: SparkSession, path: str) -> int:
    """Remove the generations of annotators that a newer finished one replaces; the number of folders removed."""
    held = {int(g): _folders(spark, at, "annotateur=") for g, at in _folders(spark, path, "gen=").items() if _folders(spark, at, "_SUCCESS")}
    newest = {who: g for g in sorted(held) for who in held[g]}
    jvm, gone = spark.sparkContext._jvm, 0
    for g, who in held.items():
        for name, at in who.items():
            if newest[name] > g:
                p = jvm.org.apache.hadoop.fs.Path(at)
                p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
                gone += 1
    return gone


def two_sinks(events: DataFrame, rejected: str, kept_path: str, rejected_path: str, checkpoint: str, fail_fast: int = 10) -> StreamingQuery:
    """Kept rows and rejects of each batch to two folders, resumable; ``rejected`` is the column that holds a reason or null. If the
    first ``fail_fast`` rows are all rejected, in however many batches they come, the pass stops."""
    seen = {"rows": 0, "kept": 0}

    def sink(batch: DataFrame, n: int) -> None:
        if not seen["kept"]:
            earlier = n and any(int(b) < n for b in _folders(batch.sparkSession, kept_path, "batch=")) and batch.sparkSession.read.parquet(kept_path).limit(1).count()
            sums = batch.agg(F.count("*").alias("n"), F.count(rejected).alias("bad")).first()
            seen["rows"] += sums["n"]
            seen["kept"] += sums["n"] - sums["bad"] + int(earlier)
            if not seen["kept"] and seen["rows"] >= fail_fast:
                raise RuntimeError(f"the first {seen['rows']} rows were all rejected")
        batch.where(F.col(rejected).isNull()).drop(rejected).write.mode("overwrite").parquet(f"{kept_path}/batch={n}")
        batch.where(F.col(rejected).isNotNull()).write.mode("overwrite").parquet(f"{rejected_path}/batch={n}")

    return events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(sink).trigger(availableNow=True).start()
