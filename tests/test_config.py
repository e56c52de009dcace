import pytest

from clockroll.config import ConfigError, RollupConfig, parse_consistency, parse_entrypoints


def cfg(**kw):
    base = {"window.granularity": "15", "window.allowed_lateness": "5"}
    base.update({k: v for k, v in kw.items() if v is not None})
    for k in [k for k, v in kw.items() if v is None]:
        base.pop(k, None)
    return RollupConfig.from_mapping(base)


@pytest.mark.parametrize("g", ["1", "15"])
def test_granularity_ok(g):
    assert cfg(**{"window.granularity": g}).granularity == int(g)


@pytest.mark.parametrize("g", ["-1", "0", None])
def test_granularity_bad(g):
    with pytest.raises(ConfigError):
        cfg(**{"window.granularity": g})


@pytest.mark.parametrize("v", ["0", "15"])
def test_lateness_ok(v):
    assert cfg(**{"window.allowed_lateness": v}).allowed_lateness == int(v)


def test_lateness_bad():
    with pytest.raises(ConfigError):
        cfg(**{"window.allowed_lateness": "-1"})


def test_flush_every():
    assert cfg(**{"window.flush_every": "0"}).flush_every == 0
    assert cfg(**{"window.flush_every": "15"}).flush_every == 15
    assert cfg().flush_every == 2
    with pytest.raises(ConfigError):
        cfg(**{"window.flush_every": "-1"})


def test_timeout():
    assert cfg(**{"window.timeout": "20"}).timeout == 20
    assert cfg().timeout == 20
    for bad in ["-1", "0", "15"]:
        with pytest.raises(ConfigError):
            cfg(**{"window.timeout": bad})


def test_entrypoints():
    assert parse_entrypoints("a") == ["a"]
    assert parse_entrypoints("a;b") == ["a", "b"]
    assert parse_entrypoints("a;b;") == ["a", "b"]
    for bad in [None, ""]:
        with pytest.raises(ConfigError):
            parse_entrypoints(bad)


def test_consistency():
    assert parse_consistency(None) == "QUORUM"
    assert parse_consistency("ONE") == "ONE"
    with pytest.raises(ConfigError):
        parse_consistency("LALA")


def test_properties_file(tmp_path):
    p = tmp_path / "c.properties"
    p.write_text("# c\nkafka.brokers=h1:1;h2:2\nwindow.granularity=60\nwindow.allowed_lateness=30\n"
                 "cassandra.entrypoints=a;b;\n")
    c = RollupConfig.from_properties(str(p), require_sink=True)
    assert (c.granularity, c.allowed_lateness, c.timeout, c.flush_every) == (60, 30, 90, 2)
    assert c.bootstrap_servers == "h1:1,h2:2"
    assert c.entrypoints == ("a", "b")
    assert c.size_ms == 3_600_000 and c.lateness_ms == 1_800_000
