"""Window state scenarios (per-object clock, lateness boundary, flush) on one object's book."""

import numpy as np

from clockroll.operators.arrivals import Book, Rules

S = 1577876400000
MIN = 60_000


def run(records, g, lat, flush_every=0, book=None, first=0):
    book = Book() if book is None else book
    n = len(records)
    out = book.take(Rules(g, lat * MIN, flush_every * MIN), 1, np.array([r[0] for r in records]), np.array([r[1] for r in records]),
                    np.ones(n, dtype=bool), np.arange(first, first + n), np.zeros(n, dtype=np.int64))
    return out, book


def test_no_lateness():
    out, _ = run([(S + i * 15_000, 1.2) for i in range(17)], 1, 0)
    assert len(out) == 4
    for e in out:
        assert e[2] == "closed" and e[4] == 4
        assert abs(e[8] - 1.2) < 1e-9 and abs(e[5] - 4 * 1.2) < 1e-9 and e[14] == 0.0


def test_lateness_boundary():
    recs = [(S, 1.2), (S + MIN, 1.2), (S + 3 * MIN - 100, 1.2), (S + 2 * MIN - 100, 1.2)]
    out, book = run(recs, 2, 1)
    assert out == []  # the last one is exactly on the lateness limit: on time
    out, book = run([(S + 4 * MIN - 100, 1.2)], 2, 1, book=book)
    assert len(out) == 1 and out[0][2] == "closed" and out[0][4] == 3 and out[0][14] is not None
    out, book = run([(S + MIN - 100, 1.2)], 2, 1, book=book)
    assert len(out) == 1 and out[0][2] == "late" and out[0][4] == 1


def test_flush():
    out, book = run([(S + i * MIN, 1.2) for i in range(4)], 1, 4)
    assert out == []
    assert len(book.flush(1)) == 4 and book.windows == {}


def test_cleanup_cadence_delays_closing():
    # flush_every 2 minutes: a window closes only at a cleanup, so a late record can
    # still find it open
    recs = [(S, 1.0), (S + 61_000, 2.0), (S + 62_000, 3.0), (S + 10_000, 4.0)]
    out0, _ = run(recs, 1, 0, flush_every=0)
    out2, book = run(recs, 1, 0, flush_every=2)
    assert [e[2] for e in out0] == ["closed", "late"]
    assert out2 == [] and book.windows[S].n == 2


def test_late_before_open_then_window():
    # window [0,15) lateness 5, clock at 15: ts=5 late (never opened) -> emitted; ts=12 opens it
    recs = [(S + 15 * MIN, 1.0), (S + 5 * MIN, 2.0), (S + 12 * MIN, 3.0)]
    out, book = run(recs, 15, 5)
    assert [(e[2], e[3]) for e in out] == [("late", 0)]
    assert book.windows[S].n == 1


def test_recreated_window_after_flush_goes_through_sink_rules(spark):
    """F9 then an on-time record for the same window: a second partial window is closed
    later; the sink keeps the stored row when it has more records (skip) and replaces it
    otherwise (override) -- both batches through the set-based upsert."""
    from clockroll.operators.merge import upsert
    from clockroll.sources.target import TARGET_SCHEMA
    from pyspark.sql import functions as F

    cols = ("object_id int, ws_ms long, kind string, phase int, count long, sum double, "
            "min double, max double, mean double, last double, last_ts long, k double, "
            "k_sum double, k_sum_2 double, std double, arr_major long, arr_minor long")

    def as_df(em):
        from clockroll.operators.aggregate import with_keys
        df = spark.createDataFrame(em, cols).withColumn("minutes", F.lit(15))
        return with_keys(df)

    for n_second, want_count in ((1, 3), (5, 5)):
        _, book = run([(S + i * MIN, 1.0) for i in range(3)], 15, 5)
        first = book.flush(1)                            # idle timeout: window closed with 3
        ts = [S + (4 + i) * MIN for i in range(n_second)] + [S + 40 * MIN]
        second, _ = run([(t, 2.0) for t in ts], 15, 5, book=book, first=10)
        second = [e for e in second if e[1] == S]        # the re-created window
        assert first[0][4] == 3 and second[0][4] == n_second
        stored, _ = upsert(spark.createDataFrame([], TARGET_SCHEMA), as_df(first))
        stored = spark.createDataFrame(stored.collect(), TARGET_SCHEMA)
        final, acts = upsert(stored, as_df(second))
        assert final.first()["count"] == want_count
        a = acts.first()
        assert (a["rec_skip"], a["rec_override"]) == ((1, 0) if n_second < 3 else (0, 1))
