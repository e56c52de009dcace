"""Measures: JSON strings or tables -> the canonical measure frame.

Canonical columns (``MEASURE_COLUMNS``):
  object_id int, unit string, ts_ms long (epoch ms, UTC), value double,
  arr_major long, arr_minor long  -- arrival order inside an object
                                     (Kafka offset, file order, or a replay order).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clockroll.functions.timefn import epoch_ms
from clockroll.functions.units import ADVANCED_UNITS, BASIC_UNITS, is_target_unit
from clockroll.session import scratch_dir

MEASURE_COLUMNS = ["object_id", "unit", "ts_ms", "value", "arr_major", "arr_minor"]

# objectId and timestamp are read as strings and converted with try_* so that a quoted
# number is accepted and a bad value becomes a reject reason instead of a failed job.
JSON_SCHEMA = "objectId string, value string, timestamp string, unitSymbol string, type string"
_PARSE_SCHEMA = JSON_SCHEMA + ", _corrupt string"

# Accepted timestamp layouts (ISO date, date+minutes, date+seconds,
# optional millis, zone designator required) and the English default date layout.
TS_ISO_PATTERN = "yyyy-MM-dd['T'HH:mm[:ss[.SSS]]]XXX"
TS_ENGLISH_PATTERN = "MMM d, yyyy h:mm:ss a"

# Spark's float parser also takes "inf"/"nan" in any case; Java's takes only these spellings.
_SPECIAL_ANY_CASE = r"^\s*[+-]?(?i:inf|infinity|nan)\s*$"
_SPECIAL_JAVA = r"^\s*[+-]?(Infinity|NaN)\s*$"

REJECT_REASONS = ("bad_json", "bad_timestamp", "bad_object_id", "unit", "bad_value", "nan",
                  "missing_object", "missing_timestamp")


def parse_timestamp_ms(s: Column) -> Column:
    ts = F.coalesce(F.try_to_timestamp(s, F.lit(TS_ISO_PATTERN)),
                    F.try_to_timestamp(s, F.lit(TS_ENGLISH_PATTERN)))
    return F.unix_millis(ts)


def parse_object_id(s: Column) -> Column:
    """Integer object id: a plain integer, or a number written as a double (``1.0``,
    ``1e2``) that is exactly an int; fractions and out-of-range values give NULL."""
    d = F.trim(s).try_cast("double")
    integral = (d == F.floor(d)) & (F.abs(d) <= F.lit(2147483647.0))
    return F.coalesce(F.trim(s).try_cast("int"), F.when(integral, d.cast("int")))


def parse_float(s: Column) -> Column:
    """String -> float32 (as double), NULL when not a Java-parseable float."""
    bad_special = s.rlike(_SPECIAL_ANY_CASE) & ~s.rlike(_SPECIAL_JAVA)
    return F.when(bad_special, F.lit(None).cast("double")).otherwise(
        F.trim(s).try_cast("float").cast("double"))


def parse_measures(raw: DataFrame, json_col: str = "value",
                   arrival: tuple[str, str] | None = ("arr_major", "arr_minor"),
                   basic=BASIC_UNITS, advanced=ADVANCED_UNITS) -> DataFrame:
    """Parse JSON measure strings.  Returns canonical columns plus ``type`` and ``reason``
    (NULL for a valid measure).  Reasons are checked in the original order: whole-record
    decoding first, then unit, then value, then NaN."""
    j = F.from_json(F.col(json_col), _PARSE_SCHEMA,
                    {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    cols = [j.alias("_j")]
    if arrival:
        cols += [F.col(arrival[0]).cast("long").alias("arr_major"),
                 F.col(arrival[1]).cast("long").alias("arr_minor")]
    else:
        cols += [F.lit(None).cast("long").alias("arr_major"),
                 F.lit(None).cast("long").alias("arr_minor")]
    df = raw.select(*cols)
    obj_s, ts_s = F.col("_j.objectId"), F.col("_j.timestamp")
    unit, val_s = F.col("_j.unitSymbol"), F.col("_j.value")
    df = df.select(
        (F.col("_j").isNull() | F.col("_j._corrupt").isNotNull()).alias("_bad_json"),
        parse_object_id(obj_s).alias("object_id"),
        obj_s.isNotNull().alias("_has_obj"),
        unit.alias("unit"),
        parse_timestamp_ms(ts_s).alias("ts_ms"),
        ts_s.isNotNull().alias("_has_ts"),
        parse_float(val_s).alias("value"),
        F.col("_j.type").alias("type"),
        "arr_major", "arr_minor")
    reason = (F.when(F.col("_bad_json"), "bad_json")
              .when(F.col("_has_ts") & F.col("ts_ms").isNull(), "bad_timestamp")
              .when(F.col("_has_obj") & F.col("object_id").isNull(), "bad_object_id")
              .when(~is_target_unit(F.col("unit"), basic, advanced), "unit")
              .when(F.col("value").isNull(), "bad_value")
              .when(F.isnan("value"), "nan")
              .when(F.col("object_id").isNull(), "missing_object")
              .when(F.col("ts_ms").isNull(), "missing_timestamp"))
    return df.select(*MEASURE_COLUMNS, "type", reason.alias("reason"))


def valid_measures(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reason").isNull()).select(*MEASURE_COLUMNS)


def countable(measures: DataFrame, basic=BASIC_UNITS, advanced=ADVANCED_UNITS) -> DataFrame:
    """The measures that can be aggregated, by the same rules as ``parse_measures``."""
    return measures.where(is_target_unit(F.col("unit"), basic, advanced) & F.col("value").isNotNull() & ~F.isnan("value")
                          & F.col("object_id").isNotNull() & F.col("ts_ms").isNotNull())


#: Splits (one row each) that the index of a history may broadcast; above it the join is shuffled.
BROADCAST_SPLITS = 500_000


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of the text files below ``path`` as ``value`` with their exact place: ``arr_major`` lines stand in
    the files with smaller names, ``arr_minor`` before the line in its own file; their sum is the
    line's number in the whole history.

    Names decide, not the times of files, which a copy resets and which may be equal.  A scan numbers
    its rows in each task; a first pass counts the lines of each split and finds the number its
    first line got, running sums over the splits (one row per split, not per line) give the lines
    before it, and the second pass adds them.  Both passes read one list of files, so they cut it into the
    same splits, however many there are to a file or to a task."""
    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                                       F.monotonically_increasing_id().alias("number"))
    splits = raw.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("number").alias("first"))
    in_file = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    files = splits.groupBy("file").agg(F.sum("n").alias("lines"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("lines").over(before), F.lit(0)).alias("arr_major"))
    index = splits.withColumn("above", F.coalesce(F.sum("n").over(in_file), F.lit(0))).join(files, "file").select("file", "block", "first", "above", "arr_major")
    out = scratch_dir(spark, "history-index") + "/t"
    index.write.parquet(out)
    index = spark.read.schema(index.schema).parquet(out)
    if index.count() <= BROADCAST_SPLITS:
        index = F.broadcast(index)
    return raw.join(index, ["file", "block"]).select("value", "arr_major", (F.col("above") + F.col("number") - F.col("first")).alias("arr_minor"))


def read_json_measures(spark: SparkSession, path: str) -> DataFrame:
    """Batch scan of a JSON-lines history (one measure per line).  Arrival is the line's place: files in
    the order of their names, lines in the order of the file (see ``numbered_lines``)."""
    return parse_measures(numbered_lines(spark, path))


#: Records a Kafka micro-batch takes at most, so that the first one is not the whole topic.
MAX_OFFSETS_PER_TRIGGER = 5_000_000


def kafka_arrivals(records: DataFrame) -> DataFrame:
    """``value``, ``arr_major``, ``arr_minor`` of Kafka records.  Arrival is the record timestamp, then
    (partition, offset): producers may send without a key, so one object's records spread over
    partitions, whose offsets cannot be compared."""
    return records.select(F.col("value").cast("string").alias("value"), F.unix_micros("timestamp").alias("arr_major"),
                          (F.col("partition").cast("long") * F.lit(1 << 44) + F.col("offset")).alias("arr_minor"))


def read_kafka_measures(spark: SparkSession, bootstrap: str, topic: str, group_id: str | None = None,
                        max_offsets: int = MAX_OFFSETS_PER_TRIGGER) -> DataFrame:
    """Streaming Kafka source (needs the spark-sql-kafka package on the classpath)."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap.replace(";", ","))
         .option("subscribe", topic).option("startingOffsets", "earliest").option("maxOffsetsPerTrigger", max_offsets))
    if group_id:
        r = r.option("kafka.group.id", group_id)
    return parse_measures(kafka_arrivals(r.load()))


# ---------------------------------------------------------------------------
# Driver tables as measures
# ---------------------------------------------------------------------------

# Measure mapping of the driver tables.
EVENT_TYPE_UNITS = {"click": "V", "view": "lx", "purchase": "W", "signup": "m/s",
                    "error": "kWh"}
DENSE_OBJECTS = 8
DENSE_UNITS = ("V", "lx", "W", "m/s", "°C", "%")


def _event_unit(event_type: Column) -> Column:
    expr = None
    for k, v in EVENT_TYPE_UNITS.items():
        expr = (F.when(event_type == k, v) if expr is None else expr.when(event_type == k, v))
    return expr


def _event_arrival(events: DataFrame) -> tuple[Column, Column]:
    k = F.get_json_object("props", "$.k").cast("long")
    major = F.unix_micros(F.col("ts").cast("timestamp")) + k * F.lit(60_000_000)
    return major.alias("arr_major"), F.col("event_id").alias("arr_minor")


def measures_from_events(events: DataFrame, mapping: str = "sparse",
                         targets_only: bool = False) -> DataFrame:
    """``events`` -> measures.  sparse: object=user_id, unit by event_type.
    dense: object=1+user_id%8, unit by object (error events keep the non-target unit).
    Arrival order = (ts + props.k minutes, event_id): k is the delivery delay.

    ``targets_only`` states the unit filter on ``event_type`` (the unit is a function of
    it), so it reaches the parquet scan as a pushed filter instead of running after the
    mapping."""
    if targets_only:
        from clockroll.functions.units import ADVANCED_UNITS as _A, BASIC_UNITS as _B
        keep = [k for k, v in EVENT_TYPE_UNITS.items() if v in _B + _A]
        if mapping == "dense":
            # every by-object unit is a target; only error events map to a foreign unit
            keep = [k for k in EVENT_TYPE_UNITS if k != "error"]
        events = events.filter(F.col("event_type").isin(*keep))
    if mapping == "sparse":
        obj = F.col("user_id").cast("int")
        unit = _event_unit(F.col("event_type"))
    elif mapping == "dense":
        obj = (F.lit(1) + F.pmod(F.col("user_id"), F.lit(DENSE_OBJECTS))).cast("int")
        idx = F.pmod(obj, F.lit(len(DENSE_UNITS)))
        by_obj = F.element_at(F.array(*[F.lit(u) for u in DENSE_UNITS]), (idx + 1).cast("int"))
        unit = F.when(F.col("event_type") == "error", F.lit("kWh")).otherwise(by_obj)
    else:
        raise ValueError("mapping must be 'sparse' or 'dense'")
    major, minor = _event_arrival(events)
    return events.select(obj.alias("object_id"), unit.alias("unit"),
                         epoch_ms(F.col("ts")).alias("ts_ms"),
                         F.col("value").cast("double").alias("value"), major, minor)


def measures_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """``lineitem`` -> measures: object=l_suppkey, ts=l_shipdate, value=l_quantity, unit W,
    arrival=(l_orderkey, l_linenumber)."""
    return lineitem.select(F.col("l_suppkey").cast("int").alias("object_id"),
                           F.lit("W").alias("unit"),
                           epoch_ms(F.col("l_shipdate")).alias("ts_ms"),
                           F.col("l_quantity").cast("double").alias("value"),
                           F.col("l_orderkey").cast("long").alias("arr_major"),
                           F.col("l_linenumber").cast("long").alias("arr_minor"))


def events_as_json(events: DataFrame) -> DataFrame:
    """``events`` rendered as the JSON measure strings a producer would send (sparse
    mapping), with the arrival columns alongside: exercises the full parse path."""
    major, minor = _event_arrival(events)
    body = F.struct(
        F.col("user_id").cast("int").alias("objectId"),
        F.col("value").cast("string").alias("value"),
        F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("timestamp"),
        _event_unit(F.col("event_type")).alias("unitSymbol"),
        F.lit("float").alias("type"),
        F.col("props").alias("comment"),
        F.lit("any").alias("unitName"),
        F.col("user_id").alias("owner"))
    return events.select(F.to_json(body).alias("value"), major, minor)


def malformed_json(events: DataFrame) -> DataFrame:
    """``events_as_json`` with faults dealt out by ``event_id`` modulo 16: every reject reason occurs,
    and so do records with several faults."""
    major, minor = _event_arrival(events)
    q = F.pmod("event_id", F.lit(16))
    quote = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    obj = F.col("user_id").cast("int").cast("string")
    ts = quote(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
    value = quote(F.col("value").cast("string"))
    pair = lambda name, c: F.concat(F.lit(f'"{name}":'), c)
    obj = F.when(q == 3, F.lit('"x1"')).when(q == 4, F.concat(obj, F.lit(".5"))).when(q == 14, quote(obj)).otherwise(obj)
    ts = F.when(q == 1, F.lit('"2020"')).when(q == 2, F.lit('"yesterday"')).otherwise(ts)
    value = (F.when(q == 6, F.lit('""')).when(q == 7, F.lit('"1.2.2"')).when(q == 8, F.lit('"true"')).when(q == 9, F.lit('"NaN"'))
             .when(q == 13, F.lit('"nan"')).when(q == 15, F.lit('"oops"')).otherwise(value))
    unit = quote(F.when(q.isin(5, 15), F.lit("kWh")).otherwise(_event_unit(F.col("event_type"))))
    parts = [F.when(q != 10, pair("objectId", obj)), F.when(q != 11, pair("timestamp", ts)), pair("unitSymbol", unit), pair("value", value)]
    body = F.concat(F.lit("{"), F.concat_ws(",", *parts), F.when(q == 12, F.lit("")).otherwise(F.lit("}")))
    return events.select(body.alias("value"), major, minor)
