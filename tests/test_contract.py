"""The registered queries against their SQL oracles on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as contract
from check_oracles import compare, connect

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, duck, name):
    got = contract.queries()[name](spark, SF).toPandas()
    sql = contract.oracle_sql().get(name)
    if sql:
        assert compare(got, duck.execute(sql).df()) is None
    assert len(got)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["orgao_julgador", "ministro_relator", "n", "n_fav", "n_refs"]
    assert df.count() > 0


def test_oracles_name_queries():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_scratch_of_a_run_is_removed(spark):
    from pathlib import Path

    from ementario.session import materialize, scratch_run

    kept = materialize(spark.range(3), "kept")
    with scratch_run(spark) as folder:
        inside = materialize(spark.range(5), "inside")
        local = Path(folder.removeprefix("file:"))
        assert inside.count() == 5 and local.is_dir() and local.name.startswith("run-")
    assert not local.exists() and kept.count() == 3
    after = materialize(spark.range(2), "after")
    assert after.count() == 2 and "run-" not in after.inputFiles()[0].split("/ementario/")[-1].split("-")[0]
