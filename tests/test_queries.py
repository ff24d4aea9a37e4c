"""Every named query against its SQL in DuckDB, at the smallest size."""

import math
import os

import duckdb
import pytest

from tessera.plans import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    return con


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return ""
    return f"{float(v):.9g}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    names = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in names) for r in df.collect())
    rows = duck.execute(queries.ORACLES[name])
    columns = [d[0] for d in rows.description]
    assert sorted(columns) == names
    want = sorted(tuple(plain(r[columns.index(c)]) for c in names) for r in rows.fetchall())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_query_runs(spark, name):
    assert queries.QUERIES[name](spark, SF).count() >= 0


def test_energies_of_all_pools(spark):
    from tessera.operators import primers

    pool = queries._pool_df(spark, SF).collect()
    got = {(r.id_lo, r.id_hi): r.delta_g for r in queries.q63_dimer_energies(spark, SF).collect()}
    asked = []
    for k, a in enumerate(pool):
        for b in pool[:k]:
            if a.pool == b.pool and a.gene_idx != b.gene_idx:
                own = [a.fwd, a.rev, b.fwd, b.rev]
                asked += [(min(a.primer_id, b.primer_id), max(a.primer_id, b.primer_id), x, y) for x in own for y in own]
    want: dict = {}
    for (low, high, _, _), g in zip(asked, primers.dimer_energies([x for *_, x, _ in asked], [y for *_, y in asked]).tolist()):
        want[low, high] = min(g, want.get((low, high), 0.0))
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-8 for k in want) and min(want.values()) < -5


def test_annealing_takes_all_parts(spark):
    rows = queries.q57_annealing(spark, SF).collect()
    parts = {r.p_partkey for r in spark.read.parquet(f"{SF}/part.parquet").collect()}
    assert {r.pool for r in rows} == {k // 100 for k in parts} and len(parts) == 200 and all(sum(r.pool == p for r in rows) == 10 for p in {r.pool for r in rows})
    assert all(int(i[1:]) // 100 == r.pool for r in rows for i in r.primers.split(","))


def test_flagship(spark):
    assert queries.flagship(spark, SF).count() > 0


@pytest.mark.parametrize("kept", ["event_id % 50 = 0", "event_type in ('view', 'click')"], ids=["no_cells", "no_calls"])
def test_legacy_export_without_cells_or_calls(spark, tmp_path, kept):
    spark.read.parquet(f"{SF}/events.parquet").where(kept).write.parquet(str(tmp_path / "events.parquet"))
    rows = queries.QUERIES["q78_legacy_export"](spark, str(tmp_path)).collect()
    assert bool(rows) == ("view" in kept) and all(r.targets == r.phases == "" for r in rows)


@pytest.mark.parametrize("name", ["q66_run_cells", "q67_run_asvs"])
def test_run_from_files_leaves_no_tables_of_reads(spark, tmp_path, name):
    from tessera.plans import surrogate
    from tessera.storage import shared_folder

    spark.read.parquet(f"{SF}/events.parquet").write.parquet(str(tmp_path / "events.parquet"))
    there = lambda: set(os.listdir(shared_folder(spark).removeprefix("file://") + "/tessera"))
    surrogate.kept(spark, str(tmp_path), "none", lambda: spark.range(1))
    before = there()
    rows = queries.QUERIES[name](spark, str(tmp_path))
    left = {n.rsplit("-", 1)[0] for n in there() - before}
    assert not left & {"ordered", "bgzf", "placed", "genes", "packets", "clustered", "cores"} and "surrogate" in left
    assert sorted(map(tuple, rows.collect()), key=str) == sorted(map(tuple, queries.QUERIES[name](spark, SF).collect()), key=str)


def test_made_read_files_line_up(spark, tmp_path, monkeypatch):
    from tessera.plans import surrogate
    from tessera.sources import fastq
    from tessera.storage import listed

    monkeypatch.setattr(surrogate, "FILE_RECORDS", 130)
    spark.read.parquet(f"{SF}/events.parquet").repartition(7).write.parquet(str(tmp_path / "events.parquet"))
    at = surrogate.files(spark, str(tmp_path))
    lines = [[spark.read.text(path).count() for path, _ in listed(spark, at[mate])] for mate in ("r1", "r2")]
    total = spark.read.parquet(f"{SF}/events.parquet").count()
    assert lines[0] == lines[1] and max(lines[0]) <= 4 * 130 and sum(lines[0]) == 4 * total and len(lines[0]) == -(-total // 130)
    pairs = fastq.read_pairs(spark, at["r1"], at["r2"])
    ids = [r.read_id for r in pairs.orderBy("read_index").select("read_id").collect()]
    assert ids == sorted(ids, key=lambda i: int(i[1:])) and not os.path.exists(pairs._stored_at.removeprefix("file://"))
