"""Every query of the engine against its SQL on the small tables."""

import json
from pathlib import Path

import __spark_entry__ as entry
import duckdb
import pytest
from palaver import catalogue

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in Path(SF).glob("*.parquet"):
        c.execute(f"create view {t.stem} as select * from '{t}'")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, con, name):
    got = catalogue.QUERIES[name](spark, SF)
    cols = sorted(got.columns)
    want = con.execute(f"select {', '.join(cols)} from ({catalogue.SQL[name]})").fetchall()
    plain = lambda rows: sorted(repr(tuple(round(v, 9) if isinstance(v, float) else v for v in r)) for r in rows)
    assert plain(got.select(*cols).collect()) == plain(want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_json_files_follow_the_bytes(spark, tmp_path, monkeypatch):
    """Not the conversations: short ones share a file, and more bytes make more files, each one whole document."""
    rows = [(c, t, "AB"[t], None if c == 7 else f'{c} "{t}"\n') for c in range(400) for t in range(2)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))

    def written(name):
        monkeypatch.setattr(catalogue.sinks, "scratch", lambda _: str(tmp_path / name))
        got = catalogue.QUERIES["json_files"](spark, str(tmp_path)).collect()
        assert sorted(map(tuple, got), key=lambda r: r[:2]) == [(c, t, text, role, "e", "a") for c, t, role, text in rows]
        return [p.read_text() for p in (tmp_path / name).rglob("part-*") if p.stat().st_size]

    assert len(written("one")) == 1
    monkeypatch.setattr(catalogue, "FILE_BYTES", 20_000)
    several = [json.loads(x) for x in written("several")]
    assert 3 <= len(several) <= 6
    assert sorted(int(c) for x in several for c in x) == list(range(400)) and all(set(v) == {"0", "1"} for x in several for v in x.values())
