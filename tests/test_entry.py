import __spark_entry__ as E


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "object_id" in df.columns and "std" in df.columns


def test_oracle_keys_subset():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    # every query of the library has SQL; queries of the optional package may be tested otherwise
    assert not {x for x in set(q) - set(o) if not x.startswith("op") and x != "pipeline"}
