"""Every registered query against its DuckDB oracle (the driver's correctness
gate), on the smallest scale so the suite stays fast."""

import pytest

from compare import compare
from tallyhouse import catalog

from conftest import SF_SMALL

ORACLES = catalog.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck_small, name):
    df = catalog.queries()[name](spark, SF_SMALL)
    ok, msg = compare(df, duck_small, ORACLES[name])
    assert ok, f"{name}: {msg}"


def test_every_query_has_a_docstring():
    for name, fn in catalog.queries().items():
        assert fn.__doc__, name


def test_entry_smoke(spark):
    import __spark_entry__ as e
    rows = e.entry(spark).collect()
    assert {r.channel for r in rows} == {"amazon", "pos", "shopify"}
    by = {r.channel: r for r in rows}
    assert by["shopify"].status == "RECONCILED"
    assert all(r.gap_pct < 0.10 for r in rows)
    assert all(r.residual_reason for r in rows if r.status == "RESIDUAL")


def test_materialized_models_match_lazy(spark):
    from tallyhouse.plans.models import Models
    from tallyhouse.sources.tables import adapter_raw
    lazy = Models(adapter_raw(spark, SF_SMALL))
    table = Models(adapter_raw(spark, SF_SMALL), materialize="table")
    for name in ("revenue_reconciliation", "dim_date", "fact_settlements"):
        assert sorted(lazy.model(name).collect()) == sorted(table.model(name).collect()), name
