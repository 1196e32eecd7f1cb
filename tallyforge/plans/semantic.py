"""Semantic views: named facts, dimensions and metrics with synonyms.

A view is metadata over a base DataFrame. ``query(dimensions, metrics)``
resolves logical names (or synonyms, case-insensitively) on the driver,
projects the facts, applies an optional filter and compiles to one
``groupBy(dimensions).agg(metrics)`` — Catalyst does the rest (partial
aggregation before the shuffle; with no dimensions a single global
aggregate). Metrics may be any aggregate Column expression over fact names,
e.g. ``sum(subscriptions) - sum(redemptions)``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class Member:
    name: str
    expr: str                       # physical column (facts/dims) or SQL aggregate over fact names (metrics)
    synonyms: tuple[str, ...] = ()
    comment: str | None = None


@dataclass
class SemanticView:
    name: str
    table: str
    base: Callable[[], DataFrame] | DataFrame
    primary_key: tuple[str, ...]
    facts: list[Member]
    dimensions: list[Member]
    metrics: list[Member]
    synonyms: tuple[str, ...] = ()
    comment: str | None = None
    _index: dict = field(default_factory=dict, init=False, repr=False)

    def __post_init__(self):
        for kind, members in (("dimension", self.dimensions), ("metric", self.metrics), ("fact", self.facts)):
            for m in members:
                for term in (m.name, *m.synonyms):
                    self._index.setdefault(term.lower(), []).append((kind, m))
        for term in (self.table, *self.synonyms):
            self._index.setdefault(term.lower(), []).append(("table", self))

    # ------------------------------------------------------------- lookup
    def resolve(self, term: str, kind: str | None = None):
        """Member (or the view itself) named ``term``; accepts ``table.name``
        and synonyms, case-insensitively. Raises on unknown or ambiguous terms."""
        t = term.strip().lower()
        if "." in t and t.split(".", 1)[0] in (self.table.lower(), *map(str.lower, self.synonyms)):
            t = t.split(".", 1)[1]
        hits = [(k, m) for k, m in self._index.get(t, []) if kind is None or k == kind]
        uniq = {id(m): (k, m) for k, m in hits}
        if not uniq:
            raise KeyError(f"{self.name}: unknown {kind or 'member'} '{term}'")
        if len(uniq) > 1:
            raise KeyError(f"{self.name}: '{term}' is ambiguous: {[m.name for _, m in uniq.values()]}")
        return next(iter(uniq.values()))[1]

    def _base(self) -> DataFrame:
        return self.base() if callable(self.base) else self.base

    def _projected(self) -> DataFrame:
        """Base rows with logical fact and dimension names."""
        df = self._base()
        cols, seen = [], set()
        for m in self.dimensions + self.facts:
            if m.name not in seen:
                col = F.expr(m.expr).alias(m.name)
                if m.comment:
                    col = col.alias(m.name, metadata={"comment": m.comment})
                cols.append(col)
                seen.add(m.name)
        # physical names stay addressable too (metrics may use them)
        for c in df.columns:
            if c not in seen:
                cols.append(F.col(c))
        return df.select(*cols)

    def describe(self, spark) -> DataFrame:
        """``DataFrame[view, kind, name, expression, synonyms, comment]``: the view, its
        table and every member, with all their comments."""
        rows = [(self.name, "view", self.name, None, [], self.comment),
                (self.name, "table", self.table, ", ".join(self.primary_key), list(self.synonyms), self.comment)]
        for kind, members in (("fact", self.facts), ("dimension", self.dimensions), ("metric", self.metrics)):
            rows += [(self.name, kind, m.name, m.expr, list(m.synonyms), m.comment) for m in members]
        return spark.createDataFrame(rows, "view string, kind string, name string, expression string, "
                                           "synonyms array<string>, comment string")

    def create_view(self, name: str | None = None) -> str:
        """Register the base rows under the logical fact and dimension names as a
        temp view (default: the table name), so SQL can aggregate them directly:
        ``SELECT investor_segment, sum(aum) FROM investors GROUP BY 1``."""
        view = name or self.table
        self._projected().createOrReplaceTempView(view)
        return view

    def query(self, dimensions: Sequence[str] = (), metrics: Sequence[str] = (),
              where: str | Column | None = None, order: Sequence[str | Column] | None = None) -> DataFrame:
        dims = [self.resolve(d, "dimension") for d in dimensions]
        mets = [self.resolve(m, "metric") for m in metrics]
        df = self._projected()
        if where is not None:
            df = df.filter(F.expr(where) if isinstance(where, str) else where)
        # metric comments travel with the result columns, as those of facts and dimensions do
        aggs = [F.expr(m.expr).alias(m.name, **({"metadata": {"comment": m.comment}} if m.comment else {})) for m in mets]
        if dims:
            out = df.groupBy(*[F.col(d.name) for d in dims]).agg(*aggs) if aggs else \
                df.select(*[d.name for d in dims]).distinct()
        else:
            out = df.agg(*aggs)
        if order:
            out = out.orderBy(*order)
        return out


# Fixed values below: member names, expressions and synonyms of the two views. The
# comments are this library's own.

def investors_view(base) -> SemanticView:
    """Semantic view over investor_360 (table ``investors``)."""
    return SemanticView(
        name="investor_360_sv", table="investors", base=base, primary_key=("investor_id",),
        synonyms=("clients", "accounts", "client book"),
        comment="Who our investors are, what they moved and what they are worth; a row each",
        facts=[
            Member("aum", "assets_under_management", comment="Cash plus valued holdings, in account currency"),
            Member("holdings", "holdings_value", comment="Net cash-book quantities times the newest price"),
            Member("cash", "cash_balance", comment="Balance after the newest booking"),
            Member("subscriptions", "total_subscriptions"),
            Member("redemptions", "total_redemptions"),
            Member("fees", "total_fees"),
            Member("activity", "activity_count"),
            Member("instruments", "instruments_held"),
        ],
        dimensions=[
            Member("investor_id", "investor_id", comment="Key of the investor"),
            Member("investor_segment", "investor_segment", ("client segment", "investor type", "mandate type"),
                   "Kind of mandate; five codes in upper case"),
            Member("risk_rating", "risk_rating", ("risk", "risk level")),
            Member("kyc_status", "kyc_status", ("kyc", "know your customer status")),
            Member("country", "country", ("country code", "domicile")),
            Member("tenure_days", "tenure_days", comment="Age of the relationship in days"),
        ],
        metrics=[
            Member("investor_count", "count(investor_id)", ("number of investors", "number of clients", "how many clients"),
                   "How many investors the group has"),
            Member("total_aum", "sum(aum)", ("assets under management", "total AUM", "book value"),
                   "Sum of aum over the group"),
            Member("avg_aum", "avg(aum)", comment="Mean of aum over the group"),
            Member("total_holdings_value", "sum(holdings)", comment="Sum of holdings over the group"),
            Member("total_cash", "sum(cash)", comment="Sum of cash over the group"),
            Member("total_net_flows", "sum(subscriptions) - sum(redemptions)", ("net flows", "net new money"),
                   "What came in less what went out"),
        ],
    )


def positions_view(base) -> SemanticView:
    """Semantic view over portfolio_risk (table ``positions``)."""
    return SemanticView(
        name="portfolio_risk_sv", table="positions", base=base, primary_key=("investor_id", "symbol"),
        synonyms=("portfolio", "holdings", "book"),
        comment="Open positions of each investor per instrument, priced and with the mood of the last earnings call",
        facts=[
            Member("market_value", "market_value", comment="Net quantity times newest price; negative when short"),
            Member("gross_exposure", "gross_exposure", comment="Size of the position whatever its side"),
            Member("unrealized_pnl", "unrealized_pnl", comment="Value now less what was paid"),
            Member("net_quantity", "net_quantity"),
            Member("trades", "trade_count"),
        ],
        dimensions=[
            Member("investor_id", "investor_id"),
            Member("symbol", "symbol", ("instrument", "ticker")),
            Member("asset_class", "asset_class", ("asset type",)),
            Member("investor_segment", "investor_segment", ("client segment", "investor type")),
            Member("risk_rating", "risk_rating", ("risk level",)),
            Member("earnings_sentiment", "earnings_sentiment", ("sentiment", "earnings call sentiment"),
                   "Label of the newest transcript of the instrument, if there is one"),
        ],
        metrics=[
            Member("position_count", "count(investor_id)", ("number of positions",),
                   "How many open positions the group has"),
            Member("total_market_value", "sum(market_value)", comment="Sum of market_value; longs and shorts offset"),
            Member("total_gross_exposure", "sum(gross_exposure)", ("total exposure", "assets at risk"),
                   "Sum of gross_exposure; longs and shorts add up"),
            Member("total_unrealized_pnl", "sum(unrealized_pnl)", ("total pnl", "unrealized gains"),
                   "Sum of unrealized_pnl over the group"),
            # the definition names the physical column; the fact alias `trades` works as well
            Member("total_trades", "sum(trade_count)", comment="Executions behind the group's positions"),
        ],
    )
