"""Plan regressions: shuffles and pushdown the scale design depends on."""

from clockroll.operators.aggregate import rollup_many
from clockroll.plans.catalog import dense, lineitem
from tests.conftest import SF001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_multi_granularity_rollup_is_one_shuffle(spark):
    p = _plan(rollup_many(lineitem(spark, SF001), [15, 60, 1440]))
    assert p.count("Exchange hashpartitioning") == 1
    assert "partial_count" in p  # map-side combine before the shuffle


def test_unit_filter_reaches_the_scan(spark):
    p = _plan(dense(spark, SF001).select("object_id", "value"))
    assert "In(event_type, [click,purchase,signup,view])" in p
    # only the columns the projection and the unit need are read
    assert "ReadSchema: struct<user_id:bigint,event_type:string,value:double>" in p


def _spread(spark, rows, parts):
    """Rows of the largest task of the clock scan, and the clocks."""
    from clockroll.operators import lateness
    df = spark.createDataFrame(rows, "object_id int, unit string, ts_ms long, value double, arr_major long, arr_minor long")
    kept = []
    old = lateness.scratch_dir
    lateness.scratch_dir = lambda s, p: kept.append(old(s, p)) or kept[-1]
    try:
        clocks = {(r.arr_major, r.arr_minor): r.ta_ms for r in lateness.with_clock(df, parts).collect()}
    finally:
        lateness.scratch_dir = old
    sizes = [r["count"] for r in spark.read.parquet(kept[0] + "/scan").groupBy("part").count().collect()]
    return max(sizes), clocks


def test_hot_source_is_split_whatever_its_bursts(spark):
    """10,000 rows of one object, 9,000 of them within a second; and all in one ``arr_major``."""
    import random
    rnd = random.Random(3)
    burst = [(1, "V", rnd.randrange(10**9), 1.0, 5_000_000 + i if i < 9000 else i * 10**9, 0) for i in range(10_000)]
    single = [(1, "V", rnd.randrange(10**9), 1.0, 0, i) for i in range(10_000)]
    for rows in (burst, single):
        largest, clocks = _spread(spark, rows, 10)
        assert largest <= 2000
        top = None
        for r in sorted(rows, key=lambda r: (r[4], r[5])):
            assert clocks[r[4], r[5]] == top
            top = r[2] if top is None else max(top, r[2])


def test_upsert_scans_once_and_shuffles_the_data_once(spark):
    """After the clock scan (one range shuffle of the source) nothing of the size of the data is
    shuffled: window statistics and first arrivals are aggregated first."""
    from clockroll.config import RollupConfig
    from clockroll.operators.lateness import emissions
    p = _plan(emissions(dense(spark, SF001), RollupConfig(granularity=60, allowed_lateness=30, flush_every=0)))
    assert "events.parquet" not in p
    for line in p.splitlines():
        if "Exchange hashpartitioning" in line:
            below = p.splitlines()[p.splitlines().index(line) + 1]
            assert any(x in below for x in ("Aggregate", "Project", "Filter", "Sort")), below


def test_clock_leaves_no_state_on_the_driver():
    import inspect

    from clockroll.operators import lateness
    assert ".collect(" not in inspect.getsource(lateness) and "createDataFrame" not in inspect.getsource(lateness)
