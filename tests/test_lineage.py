from tallyforge.operators import lineage as L


def _by_distance(df, col):
    out = {}
    for r in df.collect():
        out.setdefault(r["distance"], set()).add(r[col])
    return out


def test_edge_count():
    assert len(L.model_edges()) == 20


def test_downstream_customers(spark):
    e = L.lineage_edges(spark)
    got = _by_distance(L.downstream(e, "customers", 3), "target")
    assert got == {1: {"stg_customers"}, 2: {"investor_360", "portfolio_risk", "investor_risk"},
                   3: {"investor_360_sv", "portfolio_risk_sv", "investor_risk"}}


def test_upstream_portfolio_risk(spark):
    e = L.lineage_edges(spark)
    got = _by_distance(L.upstream(e, "portfolio_risk", 3), "source")
    assert got == {1: {"stg_trades", "stg_instrument_prices", "stg_earnings_transcripts", "stg_customers"},
                   2: {"trades", "instrument_prices", "transcripts_raw", "customers"},
                   3: {"doc_stage"}}
