import datetime as dt

from pyspark.sql import functions as F

from tamarin.operators import annotations as m
from tamarin.streaming import log

SCHEMA = "id string, annotateur string, corrected string, notes string, skipped boolean, note int, vote boolean, jalons map<string,bigint>, ecoute_ms bigint, lectures int, duree bigint, at bigint, recu_le timestamp"
T0 = dt.datetime(2026, 1, 1)


def event(i, who, text, at, note=0, listened=0, plays=1, late=0):
    return (i, who, text, None, False, note, False, {"ouvert": 1000, "x1": 5} if note else None, listened, plays, None, at, T0 + dt.timedelta(seconds=late))


def events(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


HOUR = 3_600_000
LOG = [
    event("s1", "a", "yonn", 0), event("s1", "a", "dé", HOUR - 1), event("s1", "a", "twa", 2 * HOUR - 1, note=5, late=9), event("s1", "a", "twa", 2 * HOUR - 1, note=5, late=99),
    event("s1", "b", "twa", 10, note=1), event("s2", "b", " ", 10), event("s2", None, "wi", None),
]


def test_versions(spark):
    v = m.versions(events(spark, LOG)).collect()
    assert [(r["version"], r["corrected"]) for r in v if (r["id"], r["annotateur"]) == ("s1", "a")] == [(1, "dé"), (2, "twa")]
    assert len(v) == 5 and m.versions(events(spark, [])).count() == 0
    assert {r["corrected"] for r in m.latest(m.versions(events(spark, LOG))).collect()} == {"twa", " ", "wi"}


def test_stats_export_and_agreement(spark):
    v = m.versions(events(spark, LOG)).persist()
    index = spark.createDataFrame([("s1", "twa", "", 1000), ("s1", "twa", "", 1000)], "c string, t string, m string, d long")
    wit = spark.createDataFrame([("s1", "twa")], "c string, ref string")
    s = m.service_stats(v, index, wit).first().asDict()
    assert s == {"corriges": 2, "versions": 4, "reprises": 1, "doubles": 1, "validees": 1, "rebuts": 1, "annotateurs": 2, "segments": 2, "temoins": 1}
    x = {(r["segment_id"], r["annotateur"], r["version"]): r for r in m.export(v, index).collect()}
    assert len(x) == 5 and x["s1", "a", 2]["status"] == "human_validated" and x["s1", "a", 2]["ouvert_a"] == "1970-01-01T00:00:01+00:00" and x["s2", "b", 1]["status"] == "" and x["s2", None, 1]["whisper"] == ""
    assert {tuple(r) for r in m.others_count(v, "a").collect()} == {("s1", 1), ("s2", 0)}
    assert m.self_agreement(v).first()["cer"] == 1.0
    assert m.retest_due(v, 10**13, rate=1000).count() == 2 and m.retest_due(v, 10**13, rate=0).count() == 0
    q = {r["annotateur"]: r for r in m.annotator_quality(v, index, wit).collect()}
    assert q["a"]["validees"] == 1 and q["a"]["temoin"] == 0.0 and q["b"]["rebuts"] == 1 and q["a"]["reprise"] == 1.0 and None in q
    assert m.guard_events(events(spark, LOG), index).where("id <> 's1'").count() == 0
    assert m.guard_events(events(spark, LOG), index).where("note = 5").first()["jalons"] == {"ouvert": 1000}


def test_flags(spark):
    rows = [("je suis dans les temps", "x", 1000, 0, 0, 5), ("wi sé sa", "Wi sé sa", 1000, 100, 1, 0), ("", "x", 1000, 0, 0, 5), ("an ka alé", "x", 0, 0, 1, 0), (None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "t string, s string, d int, e int, p int, n int")
    out = [r[0] for r in df.select(m.flags(*(F.col(c) for c in "tsdepn"))).collect()]
    assert out == [["5 étoiles sans avoir écouté", "jamais écouté", "correction en français"], ["écoute partielle", "validé sans écouter"], [], [], []]
    lex = spark.createDataFrame([("manjé",)], "word string")
    far = spark.createDataFrame([("k", "manjé xxx yyy zzz", 1), ("l", "xxx yyy", 1)], "id string, corrected string, w int")
    assert m.unknown_shares(far, "corrected", lex, "id").collect()[0]["unknown_share"] == 0.75


def test_stream_equals_batch(spark, tmp_path):
    import random

    rng = random.Random(1)
    rows = [event(f"s{rng.randrange(4)}", rng.choice("ab"), rng.choice(["x", "y", None]), rng.randrange(40) * HOUR // 4, note=rng.randrange(6), late=i) for i in range(200)]
    rows.sort(key=lambda r: (r[11], r[12], r[2] or "", r[5]))
    cuts = [0, 50, 51, 130, 200]
    for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
        while b < len(rows) and rows[b - 1][11] == rows[b][11]:
            b += 1
    edges = sorted({0, 200, *(next(i for i in range(c, 201) if i == 200 or rows[i][11] != rows[i - 1][11]) for c in cuts[1:-1])})
    for n, (a, b) in enumerate(zip(edges, edges[1:])):
        events(spark, rows[a:b]).select("id", "annotateur", "corrected", "note", "at", "recu_le").coalesce(1).write.parquet(f"{tmp_path}/in/{n:02d}")
    stream = spark.readStream.schema("id string, annotateur string, corrected string, note int, at bigint, recu_le timestamp").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
    log.run_versions(log.version_updates(stream), f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    got = {(r["id"], r["annotateur"], r["version"], r["at"]) for r in log.current_versions(spark, f"{tmp_path}/out").collect()}
    assert got == {(r["id"], r["annotateur"], r["version"], r["at"]) for r in m.versions(events(spark, rows)).collect()}


def test_two_sinks_and_flush(spark, tmp_path):
    events(spark, LOG).write.parquet(f"{tmp_path}/log")
    stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/log").where("annotateur is not null")
    log.flush_log(stream, f"{tmp_path}/flushed", f"{tmp_path}/cp1").awaitTermination()
    assert spark.read.json(f"{tmp_path}/flushed").count() == 6
    judged = stream.withColumn("why", F.when(F.col("note") == 1, "rebut"))
    log.two_sinks(judged, "why", f"{tmp_path}/ok", f"{tmp_path}/no", f"{tmp_path}/cp2").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/ok").count() == 5 and spark.read.parquet(f"{tmp_path}/no").count() == 1


def test_late_events_give_the_versions_of_all_events_sorted(spark, tmp_path):
    """Batches out of order: late events add versions, change them and join them."""
    import random

    rng = random.Random(5)
    rows = [event(f"s{rng.randrange(3)}", rng.choice("ab"), rng.choice(["x", "y", None]), rng.randrange(60) * HOUR // 4, note=rng.randrange(6), late=i) for i in range(120)]
    for n in range(4):
        events(spark, rows[n::4]).select("id", "annotateur", "corrected", "note", "at", "recu_le").coalesce(1).write.parquet(f"{tmp_path}/in/{n:02d}")
    stream = spark.readStream.schema("id string, annotateur string, corrected string, note int, at bigint, recu_le timestamp").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
    log.run_versions(log.version_updates(stream), f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    cols = ("id", "annotateur", "version", "corrected", "note", "at")
    got = sorted((tuple(r[c] for c in cols) for r in log.current_versions(spark, f"{tmp_path}/out").collect()), key=str)
    assert got == sorted((tuple(r[c] for c in cols) for r in m.versions(events(spark, rows)).collect()), key=str)
    assert len(list((tmp_path / "out").glob("batch=*"))) == 4


def test_flush_over_several_batches_keeps_every_event(spark, tmp_path):
    rows = LOG + LOG[:2]  # events that the log holds twice stay two
    for n, part in enumerate((rows[:3], rows[3:5], rows[5:])):
        events(spark, part).coalesce(1).write.parquet(f"{tmp_path}/log/{n}")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{tmp_path}/log")
    path, schema = f"{tmp_path}/flushed", events(spark, []).schema
    log.flush_log(stream, path, f"{tmp_path}/cp").awaitTermination()
    shown = lambda df: sorted(map(str, (tuple(r[c] for c in sorted(df.columns)) for r in df.collect())))
    assert shown(log.flushed_log(spark, path, schema)) == shown(events(spark, rows))
    # a batch that died before it was finished does not count, and its replay starts from the generation before
    import shutil

    last = max((tmp_path / "flushed").glob("gen=*"))
    (last / "_SUCCESS").unlink()
    assert log.flushed_log(spark, path, schema).count() < len(rows)
    (last / "_SUCCESS").touch()
    gone = log.vacuum_log(spark, path)
    assert gone > 0 and shown(log.flushed_log(spark, path, schema)) == shown(events(spark, rows)) and log.vacuum_log(spark, path) == 0
    shutil.rmtree(tmp_path / "flushed")
    assert log.flushed_log(spark, path, schema).count() == 0


def test_fail_fast_counts_rows_over_batches(spark, tmp_path):
    import pytest

    for n in range(4):
        events(spark, LOG[:1]).coalesce(1).write.parquet(f"{tmp_path}/log/{n}")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{tmp_path}/log").withColumn("why", F.lit("x"))
    with pytest.raises(Exception, match="all rejected"):
        log.two_sinks(stream, "why", f"{tmp_path}/ok", f"{tmp_path}/no", f"{tmp_path}/cp", fail_fast=3).awaitTermination()
    log.two_sinks(stream, "why", f"{tmp_path}/ok2", f"{tmp_path}/no2", f"{tmp_path}/cp2", fail_fast=5).awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/no2").count() == 4
