"""Per-configuration figures on the sf0.01 driver data, computed independently with a
record-by-record fold of the original window logic (dense mapping, flush_every 0)."""

import pytest

from __spark_entry__ import queries
from tests.conftest import SF01

# (on time, late but window open, late emitted, closed windows, open windows at end)
FIGURES = {
    "lateness_dense_15_5": (5974, 208, 1804, 5328, 10),
    "lateness_dense_25_5": (5974, 381, 1631, 5064, 9),
    "lateness_dense_60_0": (5731, 1246, 1009, 3972, 8),
    "lateness_dense_1440_0": (5731, 1816, 439, 3844, 136),
}


@pytest.mark.parametrize("name", sorted(FIGURES))
def test_figures(spark, name):
    got = {r["metric"]: r["n"] for r in queries()[name](spark, SF01).collect()}
    want = dict(zip(["on_time", "late_open", "late", "closed_windows", "open_windows"],
                    FIGURES[name]))
    assert got == want


def test_dense_60_30_emissions(spark):
    em = queries()["emissions_flush0"](spark, SF01)
    kinds = {r["kind"]: r["n"] for r in em.groupBy("kind").count().withColumnRenamed("count", "n").collect()}
    assert kinds == {"closed": 4078, "late": 492}
    assert queries()["open_windows_at_end"](spark, SF01).count() == 12
