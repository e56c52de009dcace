"""The job entry from a properties file, its restart, and the table writer."""

import json

import pytest
from pyspark.sql import functions as F

from clockroll.config import ConfigError, RollupConfig
from clockroll.operators.lateness import emissions
from clockroll.operators.merge import ACTION_COLUMNS
from clockroll.plans.catalog import dense
from clockroll.session import scratch_dir
from clockroll.sources import target
from clockroll.sources.measures import kafka_arrivals
from clockroll.sources.target import RollupTable
from clockroll.streaming.run import start_job
from tests.conftest import SF001

CFG = RollupConfig(granularity=60, allowed_lateness=30, flush_every=0)
T0 = 1577876400000


def lines(first, n):
    out = [{"objectId": 1 + i % 3, "value": str(float(i)), "timestamp": f"2020-01-01T{10 + i // 60:02d}:{i % 60:02d}:00Z", "unitSymbol": "V"} for i in range(first, first + n)]
    return [*out, {"objectId": 1, "value": "NaN", "timestamp": "2020-01-01T10:00:00Z", "unitSymbol": "V"}, {"objectId": 1, "value": "x", "timestamp": "2020-01-01T10:00:00Z", "unitSymbol": "V"}]


def props(tmp, root, **more):
    base = {"source.format": "json", "source.path": f"{root}/in", "target.path": f"{root}/table", "checkpoint.path": f"{root}/ckpt",
            "window.granularity": "15", "window.allowed_lateness": "5"} | more
    path = tmp / "job.properties"
    path.write_text("".join(f"{k}={v}\n" for k, v in base.items() if v is not None))
    return str(path)


def test_job_end_to_end_with_restart(spark, tmp_path):
    def run(root, deliveries):
        cfg = RollupConfig.from_properties(props(tmp_path, root))
        for k, part in enumerate(deliveries):
            spark.createDataFrame([(json.dumps(r),) for r in part], "value string").coalesce(1).write.mode("append").text(f"{root}/in")
            # stopped and started again for each delivery
            for q in start_job(spark, cfg, f"{root}/rejects", trigger={"availableNow": True}, idle_timeout=False):
                q.awaitTermination()
        return RollupTable(spark, f"{root}/table", writer="minutes=15")

    one, two = scratch_dir(spark, "job"), scratch_dir(spark, "job")
    a = run(one, [lines(0, 200)])
    b = run(two, [lines(0, 100), lines(100, 100)])
    rows = lambda t: sorted(map(str, t.read().collect()))
    assert rows(a) == rows(b) and len(rows(a)) > 20
    assert b.total_actions()["rec_normal"] == len(rows(b)) and set(b.total_actions()) == set(ACTION_COLUMNS)
    assert sorted((r.reason, r.n) for r in spark.read.parquet(f"{two}/rejects").groupBy("reason").agg(F.count("*").alias("n")).collect()) == [("bad_value", 2), ("nan", 2)]


@pytest.mark.parametrize("bad", [{"source.path": None}, {"target.path": None}, {"checkpoint.path": None}, {"source.format": "csv"},
                                 {"source.format": "kafka", "kafka.brokers": "h:1", "kafka.augmentation": "t"}, {"source.format": "kafka", "kafka.consumer.group": "g", "kafka.augmentation": "t"},
                                 {"source.format": "kafka", "kafka.brokers": "h:1", "kafka.consumer.group": "g"}, {"cassandra.entrypoints": "a;b"}, {"cassandra.consistency": "ONE"}])
def test_job_refuses_incomplete_settings(spark, tmp_path, bad):
    with pytest.raises(ConfigError):
        start_job(spark, RollupConfig.from_properties(props(tmp_path, "/tmp/none", **bad)))


def test_kafka_settings_are_enough(tmp_path):
    cfg = RollupConfig.from_properties(props(tmp_path, "/x", **{"source.format": "kafka", "kafka.brokers": "h:1;i:2", "kafka.consumer.group": "g", "kafka.augmentation": "t", "source.path": None}))
    assert cfg.require_job() is cfg and cfg.bootstrap_servers == "h:1,i:2"


def test_kafka_arrival_is_by_record_time(spark):
    """Records without a key spread over partitions: offsets of two partitions say nothing."""
    rows = [(b"a", 0, 900, 1_000_000), (b"b", 1, 3, 2_000_000), (b"c", 0, 901, 3_000_000), (b"d", 1, 4, 3_000_000)]
    df = spark.createDataFrame(rows, "value binary, partition int, offset long, us long").withColumn("timestamp", F.timestamp_micros("us"))
    got = kafka_arrivals(df).orderBy("arr_major", "arr_minor").collect()
    assert [r.value for r in got] == ["a", "b", "c", "d"]


def test_a_second_writer_of_a_granularity_is_refused(spark):
    path, em = scratch_dir(spark, "own"), emissions(dense(spark, SF001), CFG)
    RollupTable(spark, path, writer="one").apply(em, 0)
    with pytest.raises(RuntimeError):
        RollupTable(spark, path, writer="two").apply(em, 0)


def test_nothing_staged_is_left_and_rows_come_newest_first(spark):
    path, em = scratch_dir(spark, "clean"), emissions(dense(spark, SF001), CFG)
    t = RollupTable(spark, path)
    for i in range(2):
        t.apply(em, i)
    fs, p, _ = target._hadoop_fs(spark, f"{path}/_staging/default")
    assert len(fs.listStatus(p)) == 0
    r = t.read().first()
    got = [x["timestamp"] for x in t.newest_first(r["minutes"], r["object_id"], r["date"]).collect()]
    assert len(got) > 1 and got == sorted(got, reverse=True)


@pytest.fixture(scope="module")
def twice(spark):
    """Emissions, and the table and counters after applying them twice without a failure."""
    path = scratch_dir(spark, "retry-em") + "/e"
    emissions(dense(spark, SF001), CFG).write.parquet(path)
    em = spark.read.parquet(path)
    t = RollupTable(spark, scratch_dir(spark, "want"))
    for i in range(2):
        t.apply(em, i)
    return em, sorted(map(str, t.read().collect())), t.total_actions()


@pytest.mark.parametrize("step", [1, 3, 5])
def test_a_retry_after_any_step_gives_the_same_table(spark, monkeypatch, twice, step):
    """The driver dies before the ``step``-th write of a batch; the batch is applied again."""
    em, rows, actions = twice
    t = RollupTable(spark, scratch_dir(spark, "retry"))
    t.apply(em, 0)
    calls, old_parquet, old_text = [0], type(em.write).parquet, target._write_text

    def dies(fn):
        def f(*a, **k):
            calls[0] += 1
            if calls[0] == step:
                raise OSError("lost")
            return fn(*a, **k)
        return f

    monkeypatch.setattr(type(em.write), "parquet", dies(old_parquet))
    monkeypatch.setattr(target, "_write_text", dies(old_text))
    with pytest.raises(OSError):
        t.apply(em, 1)
    monkeypatch.undo()
    t.apply(em, 1)
    assert sorted(map(str, t.read().collect())) == rows and t.total_actions() == actions


def test_many_objects_of_a_day_are_written_by_several_tasks(spark):
    rows = [(60, o, "2020-01", "late", 0, 1, 1.0, 1.0, 1.0, 1.0, 1.0, T0 + o, 1.0, 0.0, 0.0, 0.0, o, 0) for o in range(20_000)]
    df = spark.createDataFrame(rows, "minutes int, object_id int, date string, kind string, phase int, count long, sum double, min double, max double, mean double, last double, last_ts long, k double, k_sum double, k_sum_2 double, std double, arr_major long, arr_minor long")
    df = df.withColumn("timestamp", F.lit("2020-01-01 11:00:00").cast("timestamp_ntz"))
    path = scratch_dir(spark, "wide")
    RollupTable(spark, path).apply(df, 0)
    files = spark.read.schema(target.STORED_SCHEMA).parquet(path).select(F.input_file_name().alias("f")).distinct().count()
    assert files >= target.BUCKETS
    late = df.where("object_id = 7").withColumn("sum", F.lit(5.0))
    before = {r.f: r.t for r in spark.read.schema(target.STORED_SCHEMA).parquet(path).select(F.input_file_name().alias("f"), F.col("_metadata.file_modification_time").alias("t")).distinct().collect()}
    RollupTable(spark, path).apply(late, 1)
    after = {r.f: r.t for r in spark.read.schema(target.STORED_SCHEMA).parquet(path).select(F.input_file_name().alias("f"), F.col("_metadata.file_modification_time").alias("t")).distinct().collect()}
    assert len(set(before) - set(after)) < len(before) / 2  # one late record rewrites its bucket only
