"""The stored master deals its orders with their customers once, a folder a pass."""

import pytest

from mercato.operators import master as ms
from mercato.plans import master_table as mt
from mercato.sources.binding import bind_marketplace
from tests.conftest import SMOKE


def same(a, b):
    a, b = a.select(*sorted(a.columns)), b.select(*sorted(b.columns))
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("empty", [False, True])
def test_customers_are_met_once_and_a_pass_reads_its_orders_alone(spark, tmp_path, monkeypatch, empty):
    tables, seen, build = bind_marketplace(spark, SMOKE), [], ms.build_master
    if empty:
        tables = {**tables, "orders": tables["orders"].limit(0)}

    def built(*args):
        seen.append(({f.rsplit("/", 2)[-2] for f in args[5].inputFiles() if "master.orders" in f},
                     sorted(x.name for x in (tmp_path / "master.orders").glob("_pass=*"))))
        return build(*args)

    monkeypatch.setattr(ms, "build_master", built)
    got = mt.write_master(spark, tables, f"{tmp_path}/master", buckets=2, passes=3)
    left = [] if empty else ["_pass=0", "_pass=1", "_pass=2"]
    assert [x[1] for x in seen] == [left[n:] for n in range(3)]           # a pass's orders go with it
    assert same(got, build(tables))
    assert not (tmp_path / "master.orders").exists()
