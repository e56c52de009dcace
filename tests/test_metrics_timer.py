import json
import time

from pyspark.sql import functions as F

from clockroll.metrics import observe_parse
from clockroll.session import scratch_dir
from clockroll.sources.measures import parse_measures
from clockroll.operators.arrivals import Rules
from clockroll.streaming.processor import STREAMED_DDL, WindowProcessor


def test_parse_counters(spark):
    lines = [json.dumps({"objectId": 1, "value": v, "timestamp": "2020-01-01Z", "unitSymbol": u})
             for v, u in [("1", "V"), ("NaN", "V"), ("x", "V"), ("2", "kWh"), ("3", "lx")]]
    raw = spark.createDataFrame([(s, i, 0) for i, s in enumerate(lines)],
                                "value string, arr_major long, arr_minor long")
    df, obs = observe_parse(parse_measures(raw))
    df.write.format("noop").mode("overwrite").save()
    assert obs.get == {"records_in": 5, "records_out": 2, "records_nan": 1}


def test_idle_timeout_flushes_windows(spark):
    """Processing-time timer per object: after ``timeout`` without records, all open windows
    of that object are closed and emitted."""
    inbox = scratch_dir(spark, "timer-inbox")
    t0 = 1577876400000
    rows = [(1, "V", t0 + i * 1000, float(i), i, 0) for i in range(5)] + \
           [(2, "lx", t0 + 5000, 9.0, 5, 0)]
    schema = "object_id int, unit string, ts_ms long, value double, arr_major long, arr_minor long"
    spark.createDataFrame(rows, schema).write.mode("append").parquet(inbox)
    stream = spark.readStream.schema(schema).parquet(inbox)
    proc = WindowProcessor([Rules(15, 5 * 60_000, 0), Rules(60, 0, 0)], {15: 2000, 60: 3_600_000})
    out = stream.groupBy("object_id").transformWithStateInPandas(
        statefulProcessor=proc, outputStructType=STREAMED_DDL, outputMode="Append",
        timeMode="ProcessingTime")
    name = "timer_test_out"
    q = (out.writeStream.format("memory").queryName(name)
         .option("checkpointLocation", scratch_dir(spark, "timer-ckpt"))
         .trigger(processingTime="1 second").start())
    try:
        deadline = time.time() + 60
        got = []
        while time.time() < deadline:
            got = spark.sql(f"SELECT * FROM {name}").collect()
            if len(got) >= 2:
                break
            time.sleep(1)
    finally:
        q.stop()
    # the granularity with the longer timeout keeps its windows
    assert sorted((r["minutes"], r["object_id"], r["kind"], r["count"]) for r in got) == [
        (15, 1, "closed", 5), (15, 2, "closed", 1)]


def test_rejects_stream_to_table(spark):
    from clockroll.sources.measures import parse_measures
    from clockroll.streaming.job import start_rejects_query
    inbox = scratch_dir(spark, "rej-inbox")
    lines = [json.dumps({"objectId": 1, "value": v, "timestamp": t, "unitSymbol": u})
             for v, t, u in [("1", "2020-01-01Z", "V"), ("x", "2020-01-01Z", "V"),
                             ("2", "2020", "V"), ("3", "2020-01-01Z", "kWh")]]
    with open(f"{inbox}/part-0.json", "w") as fh:
        fh.write("\n".join(lines) + "\n")
    raw = (spark.readStream.text(inbox)
           .select("value", F.lit(0).cast("long").alias("arr_major"),
                   F.lit(0).cast("long").alias("arr_minor")))
    out = scratch_dir(spark, "rej-out")
    q = start_rejects_query(parse_measures(raw), out, scratch_dir(spark, "rej-ckpt"),
                            trigger={"availableNow": True})
    q.awaitTermination(120)
    got = sorted(r["reason"] for r in spark.read.parquet(out).collect())
    assert got == ["bad_timestamp", "bad_value", "unit"]
