"""Stream = batch, across a restart from the checkpoint; sinks are
idempotent under a replayed micro-batch."""

from pyspark.sql import functions as F

from lampwatch import schemas
from lampwatch.operators import episodes as E
from lampwatch.plans import fixture as fx
from lampwatch.plans import streams as ST
from lampwatch.session import scratch_path, ship_package
from lampwatch.sources import dimension as dim
from lampwatch.streaming import job as J
from tests.conftest import SF_SMALL

COLS = ["rule_id", "sensor_key", "open_ts", "is_finish", "row_ts", "duration",
        "carbon_emissions"]


def _rows(df):
    return sorted(tuple(r) for r in df.select(*COLS).collect())


def test_stream_restart_equals_batch(spark):
    ship_package(spark)
    sf = SF_SMALL
    root = scratch_path(spark, "test-restart")
    act, pre = fx.actuator(spark, sf), fx.presence(spark, sf)
    edges = ST._edges(act.select("ts").unionByName(pre.select("ts")), 6)
    rules = fx.rules(spark)
    rk = fx.rule_keys(spark, sf)
    d = dim.sensor_power(fx.dimension(spark, sf))

    def run():
        a = J.with_watermark(J.file_source(spark, f"{root}/in/a", schemas.ACTUATOR, files_per_trigger=ST.FILES))
        p = J.with_watermark(J.file_source(spark, f"{root}/in/p", schemas.PRESENCE, files_per_trigger=ST.FILES))
        recs = J.episode_records(J.episode_changes(a, p, rk, rules), rules, d)
        q = J.start(recs, f"{root}/out", f"{root}/ckpt", rules)
        q.awaitTermination()
        assert q.exception() is None

    ST.write_slices(act, f"{root}/in/a", edges[:4])
    ST.write_slices(pre, f"{root}/in/p", edges[:4])
    run()                                   # first three slices, then stop
    first = spark.read.parquet(f"{root}/out/changelog").count()
    ST.write_slices(act, f"{root}/in/a", edges[3:])
    ST.write_slices(pre, f"{root}/in/p", edges[3:])
    run()                                   # restart from the checkpoint
    got = spark.read.parquet(f"{root}/out/changelog")
    want = E.changelog(E.episodes(act, pre, rk, rules, d))
    assert 0 < first < got.count()
    assert _rows(got) == _rows(want)
    # the other sinks saw every record once
    n_open = want.where(~F.col("is_finish")).count()
    assert spark.read.parquet(f"{root}/out/alerts").count() == n_open
    assert spark.read.parquet(f"{root}/out/table").count() == want.where("is_finish").count()
    assert spark.read.json(f"{root}/out/publish").count() == want.count()


def test_sink_replay_is_idempotent(spark):
    sf = SF_SMALL
    root = scratch_path(spark, "test-sink")
    rules = fx.rules(spark, ["time_only"])
    eps = E.episodes(fx.actuator(spark, sf), fx.presence(spark, sf),
                     fx.rule_keys(spark, sf, ["time_only"]), rules,
                     dim.sensor_power(fx.dimension(spark, sf)))
    batch = E.changelog(eps).withColumn("row_ts", F.coalesce("finish_ts", "open_ts"))
    sink = J.batch_sink(f"{root}/out", rules)
    sink(batch, 7)
    sink(batch, 7)                          # replay of the same micro-batch
    assert spark.read.parquet(f"{root}/out/changelog").count() == batch.count()


def test_drop_late_policy_on_ordered_input(spark):
    """W4 ``drop`` (event-time mode): with readings in time order nothing is
    late, so the result equals the batch changelog."""
    ship_package(spark)
    sf = SF_SMALL
    root = scratch_path(spark, "test-drop")
    act, pre = fx.actuator(spark, sf), fx.presence(spark, sf)
    edges = ST._edges(act.select("ts").unionByName(pre.select("ts")), 4)
    ST.write_slices(act, f"{root}/in/a", edges)
    ST.write_slices(pre, f"{root}/in/p", edges)
    rules = fx.rules(spark)
    rk = fx.rule_keys(spark, sf)
    d = dim.sensor_power(fx.dimension(spark, sf))
    a = J.with_watermark(J.file_source(spark, f"{root}/in/a", schemas.ACTUATOR, files_per_trigger=ST.FILES))
    p = J.with_watermark(J.file_source(spark, f"{root}/in/p", schemas.PRESENCE, files_per_trigger=ST.FILES))
    recs = J.episode_records(J.episode_changes(a, p, rk, rules, late_policy="drop"), rules, d)
    q = J.start(recs, f"{root}/out", f"{root}/ckpt", rules)
    q.awaitTermination()
    assert q.exception() is None
    got = spark.read.parquet(f"{root}/out/changelog")
    want = E.changelog(E.episodes(act, pre, rk, rules, d))
    assert _rows(got) == _rows(want)


def _late_run(spark, policy):
    import datetime as dt

    root = scratch_path(spark, f"test-late-{policy}")
    rules = fx.rules(spark, ["time_only"])
    rk = spark.createDataFrame([("time_only", "k")], "rule_id string, key string")
    d = spark.createDataFrame([("k", 100.0)], "_key string, power double")
    sat = dt.datetime(2024, 1, 6)
    # batch 0: lamp on at 22:00 (a Saturday: not in schedule -> opens);
    # batch 1: still on at 23:00; batch 2: an off reading stamped 21:00.
    # Late rows are judged against the previous batch's watermark (22:00).
    for i, (act, pre) in enumerate([((sat.replace(hour=22), 80.0), sat.replace(hour=22)),
                                    ((sat.replace(hour=23), 80.0), sat.replace(hour=23)),
                                    ((sat.replace(hour=21), 0.0), sat.replace(hour=23))]):
        spark.createDataFrame([("k", 1, act[0], 10 + i, act[1])], schemas.ACTUATOR) \
            .repartition(1).write.mode("append").parquet(f"{root}/in/a")
        spark.createDataFrame([("z", 1, pre, 20 + i, False, 0.0)], schemas.PRESENCE) \
            .repartition(1).write.mode("append").parquet(f"{root}/in/p")
    a = J.with_watermark(J.file_source(spark, f"{root}/in/a", schemas.ACTUATOR))
    p = J.with_watermark(J.file_source(spark, f"{root}/in/p", schemas.PRESENCE))
    recs = J.episode_records(J.episode_changes(a, p, rk, rules, late_policy=policy), rules, d)
    q = J.start(recs, f"{root}/out", f"{root}/ckpt", rules)
    q.awaitTermination()
    assert q.exception() is None
    return sorted(r.is_finish for r in spark.read.parquet(f"{root}/out/changelog").collect())


def test_late_policy_drop_discards_late_rows(spark):
    ship_package(spark)
    assert _late_run(spark, "apply") == [False, True]   # late off closes, arrival order
    assert _late_run(spark, "drop") == [False]          # late off dropped, still open
