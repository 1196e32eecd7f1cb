"""Reference SQL (DuckDB dialect) for every registered query.

Each query is written out in plain SQL from the model definitions, by another
route than the Spark code takes, so that it can serve as a second opinion
over the same driver parquet tables (views
``customer``, ``part``, ``orders``, ``lineitem``, ``documents``, ... are
registered by the caller). Fixed parameters: as_of = 2026-01-01, ordering
"desc nulls last", scores rounded to 6 digits.
"""

from __future__ import annotations

from .functions.text import FISCAL_PERIOD_PATTERN, INITCAP_DELIMITERS, SYMBOL_PATTERN
from .sources import adapter as A

AS_OF = "2026-01-01"

_VER2 = "(SELECT 0 AS ver UNION ALL SELECT 1 AS ver) v"


def _planted() -> str:
    return " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(A.PLANTED_SENTENCES))


def html_text(c: str) -> str:
    """Visible text of an HTML column."""
    return rf"""regexp_replace(regexp_replace(
    replace(replace(replace(replace(replace(replace(
      regexp_replace(regexp_replace(regexp_replace(regexp_replace({c},
        '(?is)<script\b.*?</script>', ' ', 'g'), '(?is)<style\b.*?</style>', ' ', 'g'),
        '(?s)<!--.*?-->', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'),
      '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&nbsp;', ' '), '&amp;', '&'),
    '[ \t\n\r\f]+', ' ', 'g'), '^ +| +$', '', 'g')"""


def _sym(expr: str) -> str:
    return f"'SYM' || lpad(CAST({expr} AS VARCHAR), 3, '0')"


BRONZE = {
    "b_customers": f"""
  SELECT c_custkey AS customer_id,
         CASE c_custkey % 4 WHEN 0 THEN 'FIRST' || c_custkey WHEN 1 THEN 'mary-jane ' || c_custkey
              WHEN 2 THEN 'o''NEIL ann' || c_custkey ELSE 'JEAN luc.' || c_custkey || 'x' END AS first_name,
         CASE c_custkey % 3 WHEN 0 THEN 'last' || c_custkey WHEN 1 THEN 'van DER berg-' || c_custkey || 'b'
              ELSE 'd''ARC (smith) ' || c_custkey END AS last_name,
         'Cust' || CAST(c_custkey AS VARCHAR) || '@Example.com' AS email,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'institutional' WHEN 'BUILDING' THEN 'pension'
              WHEN 'FURNITURE' THEN 'endowment' WHEN 'HOUSEHOLD' THEN 'hnw' WHEN 'MACHINERY' THEN 'wealth' END AS segment,
         CASE WHEN c_custkey % 5 <= 2 THEN 'verified' WHEN c_custkey % 5 = 3 THEN 'pending' ELSE 'review' END AS kyc_status,
         CASE WHEN (c_custkey + ver) % 4 <= 1 THEN 'low' WHEN (c_custkey + ver) % 4 = 2 THEN 'medium' ELSE 'high' END AS risk_rating,
         CASE c_nationkey % 6 WHEN 2 THEN 'gb' WHEN 3 THEN 'ca' WHEN 4 THEN 'de' WHEN 5 THEN 'sg' ELSE 'us' END AS country,
         DATE '2019-01-01' + CAST(c_custkey % 2200 AS INTEGER) AS onboarded_date,
         CASE WHEN ver = 1 THEN TIMESTAMP '2024-02-01 00:00:00' ELSE TIMESTAMP '2024-01-01 00:00:00' END AS updated_at,
         CASE WHEN ver = 1 THEN TIMESTAMP '2024-02-01 00:00:00' ELSE TIMESTAMP '2024-01-01 00:00:00' END AS _ingested_at,
         CASE WHEN ver = 1 AND c_custkey % 50 = 0 THEN TRUE WHEN c_custkey % 7 = 0 THEN NULL ELSE FALSE END AS _deleted
  FROM customer, {_VER2}
  WHERE ver = 0 OR c_custkey % 10 = 0""",
    "b_instrument_prices": f"""
  SELECT {_sym(f'p_partkey % {A.PRICED_SYMBOLS}')} AS symbol,
         CASE split_part(p_type, ' ', 1) WHEN 'ECONOMY' THEN 'equity' WHEN 'MEDIUM' THEN 'equity'
              WHEN 'STANDARD' THEN 'etf' WHEN 'PROMO' THEN 'bond' WHEN 'SMALL' THEN 'fx' WHEN 'LARGE' THEN 'crypto' END AS asset_class,
         CAST(CAST(p_retailprice AS DECIMAL(18,4)) + 9 * ver AS DECIMAL(18,4)) AS price,
         'usd' AS currency,
         DATE '2024-01-01' + CAST(p_partkey // {A.PRICED_SYMBOLS} AS INTEGER) AS as_of_date,
         TIMESTAMP '2024-01-02 00:00:00' + to_days(CAST(ver AS INTEGER)) AS updated_at,
         TIMESTAMP '2024-01-02 00:00:00' + to_days(CAST(ver AS INTEGER)) AS _ingested_at,
         FALSE AS _deleted
  FROM part, {_VER2}
  WHERE ver = 0 OR p_partkey % 3 = 0""",
    "b_transactions": f"""
  SELECT o_orderkey AS txn_id, 100000 + o_custkey AS account_id,
         o_custkey + CASE WHEN o_orderkey % 103 = 0 THEN {A.UNKNOWN_ID} ELSE 0 END AS customer_id,
         CAST(o_orderdate AS TIMESTAMP) AS txn_ts,
         CASE o_orderkey % 5 WHEN 0 THEN 'deposit' WHEN 1 THEN 'withdrawal' WHEN 2 THEN 'trade_buy'
              WHEN 3 THEN 'trade_sell' ELSE 'fee' END AS txn_type,
         CASE WHEN o_orderkey % 5 IN (2, 3) THEN {_sym(f'(o_orderkey + o_custkey) % {A.SYMBOLS}')} END AS symbol,
         CASE WHEN o_orderkey % 5 IN (2, 3) THEN CAST(1 + o_orderkey % 100 AS DECIMAL(18,4)) END AS quantity,
         CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
         'usd' AS currency,
         CAST(CAST(o_totalprice AS DECIMAL(18,2)) - 100000 AS DECIMAL(18,2)) AS balance_after,
         CAST(o_orderdate AS TIMESTAMP) AS updated_at,
         CAST(o_orderdate AS TIMESTAMP) AS _ingested_at,
         o_orderkey % 97 = 0 AS _deleted
  FROM orders""",
    "b_trades": f"""
  SELECT l_orderkey * 10 + l_linenumber AS trade_id,
         o_custkey + CASE WHEN l_orderkey % 101 = 0 THEN {A.UNKNOWN_ID} ELSE 0 END AS customer_id,
         {_sym(f'l_partkey % {A.SYMBOLS}')} AS symbol,
         CASE WHEN l_returnflag = 'R' THEN 'sell' ELSE 'buy' END AS side,
         CAST(l_quantity AS DECIMAL(18,4)) AS quantity,
         CAST(l_extendedprice AS DECIMAL(18,4)) AS price,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS notional,
         CASE l_suppkey % 4 WHEN 0 THEN 'equity' WHEN 1 THEN 'fixed_income' WHEN 2 THEN 'fx' ELSE 'derivatives' END AS book,
         CASE l_linenumber % 5 WHEN 3 THEN 'partial' WHEN 4 THEN 'cancelled' ELSE 'filled' END AS status,
         CAST(l_shipdate AS TIMESTAMP) AS trade_ts,
         CAST(l_shipdate AS TIMESTAMP) AS updated_at,
         CAST(l_shipdate AS TIMESTAMP) AS _ingested_at,
         l_orderkey % 89 = 0 AS _deleted
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "b_risk_metrics": f"""
  SELECT c_custkey AS customer_id,
         DATE '2024-01-01' + ver AS as_of_date,
         CAST(10000 + (c_custkey * 7919 + ver) % 990000 AS DECIMAL(18,2)) AS gross_exposure,
         CAST(10000 + (c_custkey * 7919 + ver) % 990000 - c_custkey % 5000 AS DECIMAL(18,2)) AS net_exposure,
         CAST(5000 + (c_custkey * 7919 + 31 * ver) % 200000 AS DECIMAL(18,2)) AS var_95,
         CAST(50000 + (c_custkey * 104729) % 200000 AS DECIMAL(18,2)) AS risk_limit,
         5000 + (c_custkey * 7919 + 31 * ver) % 200000 > 50000 + (c_custkey * 104729) % 200000 AS limit_breach_flag,
         CAST(DATE '2024-01-01' + ver AS TIMESTAMP) AS updated_at,
         CAST(DATE '2024-01-01' + ver AS TIMESTAMP) AS _ingested_at,
         FALSE AS _deleted
  FROM customer, {_VER2}
  WHERE (ver = 0 AND c_custkey % 40 <> 39) OR (ver = 1 AND c_custkey % 4 = 0)""",
    "b_doc_named": f"""
  SELECT doc_id, text || CASE doc_id % 5 {_planted()} END AS text,
         CASE WHEN doc_id % 50 = 7 THEN 'NOTES_d' || doc_id || '.PDF'
              ELSE 'EARNINGS_' || {_sym(f'own % {A.SYMBOLS}')} || '_' || (2024 + own % 3) || 'Q' || (1 + own % 4) || '_d' || own
                   || CASE own % 10 WHEN 3 THEN '.html' WHEN 6 THEN '.txt' ELSE '.PDF' END END AS file_name
  FROM (SELECT doc_id, text, doc_id - CASE WHEN doc_id % 100 = 9 THEN 1 ELSE 0 END AS own FROM documents)""",
    "b_doc_stage": """
  SELECT 'stage/' || doc_id || '/' || file_name AS path, file_name,
         CASE WHEN file_name LIKE '%.html' THEN '<html><body><p>' || text || '</p></body></html>' ELSE text END AS content
  FROM b_doc_named""",
}


def _latest(src: str, key: str, order: str) -> str:
    return (f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn "
            f"FROM {src} WHERE coalesce(_deleted, FALSE) = FALSE) WHERE rn = 1")


def _initcap(c: str) -> str:
    # a letter is upper-case after a delimiter or at the start, lower-case elsewhere
    marks = " || ".join(f"chr({ord(ch)})" for ch in INITCAP_DELIMITERS)
    return (f"array_to_string(list_transform(range(1, length({c}) + 1), lambda i: CASE WHEN i = 1 OR "
            f"contains({marks}, substr({c}, i - 1, 1)) THEN upper(substr({c}, i, 1)) ELSE lower(substr({c}, i, 1)) END), '')")


STAGING = {
    "stg_customers": f"""
  SELECT customer_id, {_initcap('first_name')} AS first_name, {_initcap('last_name')} AS last_name,
         lower(email) AS email, upper(segment) AS segment, upper(kyc_status) AS kyc_status,
         upper(risk_rating) AS risk_rating, upper(country) AS country, onboarded_date,
         CAST(datediff('day', onboarded_date, DATE '{AS_OF}') AS INTEGER) AS tenure_days
  FROM ({_latest('b_customers', 'customer_id', 'updated_at DESC NULLS LAST, _ingested_at DESC NULLS LAST')})""",
    "stg_instrument_prices": f"""
  SELECT symbol, upper(asset_class) AS asset_class, price, upper(currency) AS currency, as_of_date
  FROM ({_latest('b_instrument_prices', 'symbol', 'as_of_date DESC NULLS LAST, updated_at DESC NULLS LAST, _ingested_at DESC NULLS LAST')})""",
    "stg_transactions": """
  SELECT txn_id, account_id, customer_id, txn_ts, upper(txn_type) AS txn_type, symbol, quantity, amount,
         upper(currency) AS currency, balance_after
  FROM b_transactions WHERE coalesce(_deleted, FALSE) = FALSE""",
    "stg_trades": """
  SELECT trade_id, customer_id, symbol, upper(side) AS side, quantity, price, notional,
         upper(book) AS book, upper(status) AS status, trade_ts
  FROM b_trades WHERE coalesce(_deleted, FALSE) = FALSE""",
    "stg_risk_metrics": f"""
  SELECT customer_id, as_of_date, gross_exposure, net_exposure, var_95, risk_limit, limit_breach_flag
  FROM ({_latest('b_risk_metrics', 'customer_id', 'as_of_date DESC NULLS LAST, updated_at DESC NULLS LAST, _ingested_at DESC NULLS LAST')})""",
    "transcripts_raw": f"""
  SELECT file_name,
         nullif(regexp_extract(file_name, '{SYMBOL_PATTERN}'), '') AS symbol,
         nullif(regexp_extract(file_name, '{FISCAL_PERIOD_PATTERN}'), '') AS fiscal_period,
         CASE WHEN file_name LIKE '%.html' THEN {html_text('content')} ELSE content END AS parsed_text,
         TIMESTAMP '2026-01-01 00:00:00' AS loaded_at, path
  FROM b_doc_stage""",
}

# The marts are recomputed by another route than the Spark jobs take: filtered
# aggregates, ordered first(), a ledger of facts stacked by name and set-based
# checks instead of chains of left joins.
MARTS = {
    "cash_flows": """
  SELECT customer_id, count(*) AS activity_count,
         CAST(coalesce(sum(amount) FILTER (txn_type = 'DEPOSIT'), 0) AS DECIMAL(38,2)) AS total_subscriptions,
         CAST(coalesce(sum(amount) FILTER (txn_type = 'WITHDRAWAL'), 0) AS DECIMAL(38,2)) AS total_redemptions,
         CAST(coalesce(sum(amount) FILTER (txn_type = 'FEE'), 0) AS DECIMAL(38,2)) AS total_fees,
         max(txn_ts) AS last_activity_ts
  FROM stg_transactions GROUP BY ALL""",
    "latest_balance": """
  SELECT customer_id, first(balance_after ORDER BY txn_ts DESC NULLS LAST, txn_id DESC) AS cash_balance
  FROM stg_transactions GROUP BY ALL""",
    "signed_quantities": """
  SELECT customer_id, symbol, quantity AS q FROM stg_transactions WHERE txn_type = 'TRADE_BUY' AND symbol IS NOT NULL
  UNION ALL
  SELECT customer_id, symbol, -quantity FROM stg_transactions WHERE txn_type = 'TRADE_SELL' AND symbol IS NOT NULL""",
    "cash_positions": """
  SELECT customer_id, symbol, CAST(sum(q) AS DECIMAL(38,4)) AS net_quantity FROM signed_quantities GROUP BY ALL""",
    "holdings": """
  SELECT customer_id, CAST(sum(v) AS DECIMAL(38,8)) AS holdings_value, count(*) FILTER (net_quantity <> 0) AS instruments_held
  FROM (SELECT customer_id, net_quantity, CAST(net_quantity AS DECIMAL(19,4)) * price AS v
        FROM cash_positions JOIN stg_instrument_prices USING (symbol))
  GROUP BY ALL""",
    "ledger": """
  SELECT customer_id, sum(activity_count) AS n, sum(total_subscriptions) AS ins, sum(total_redemptions) AS outs,
         sum(total_fees) AS fees, sum(cash_balance) AS cash, sum(holdings_value) AS held_value,
         sum(instruments_held) AS held, max(last_activity_ts) AS ts
  FROM (SELECT * FROM cash_flows UNION ALL BY NAME SELECT * FROM latest_balance UNION ALL BY NAME SELECT * FROM holdings
        UNION ALL BY NAME SELECT customer_id FROM stg_customers)
  GROUP BY ALL""",
    "investor_360": """
  SELECT customer_id AS investor_id, first_name, last_name, email, segment AS investor_segment, kyc_status, risk_rating,
         country, onboarded_date, tenure_days, CAST(ifnull(n, 0) AS BIGINT) AS activity_count,
         CAST(ifnull(ins, 0) AS DECIMAL(38,2)) AS total_subscriptions, CAST(ifnull(outs, 0) AS DECIMAL(38,2)) AS total_redemptions,
         CAST(ifnull(fees, 0) AS DECIMAL(38,2)) AS total_fees, CAST(ifnull(cash, 0) AS DECIMAL(18,2)) AS cash_balance,
         CAST(ifnull(held_value, 0) AS DECIMAL(38,8)) AS holdings_value, CAST(ifnull(held, 0) AS BIGINT) AS instruments_held,
         CAST(CAST(ifnull(cash, 0) AS DECIMAL(18,2)) + CAST(ifnull(held_value, 0) AS DECIMAL(37,8)) AS DECIMAL(38,8))
           AS assets_under_management,
         ts AS last_activity_ts
  FROM ledger SEMI JOIN stg_customers USING (customer_id) JOIN stg_customers USING (customer_id)""",
    "executions": """
  SELECT customer_id, symbol, quantity, notional, CASE side WHEN 'BUY' THEN 1 ELSE -1 END AS way
  FROM stg_trades WHERE status NOT IN ('CANCELLED')""",
    "trade_positions": """
  SELECT customer_id, symbol, CAST(sum(way * quantity) AS DECIMAL(38,4)) AS net_quantity,
         CAST(sum(way * notional) AS DECIMAL(38,2)) AS net_cost, count(*) AS trade_count
  FROM executions GROUP BY ALL""",
}

# ------------------------------------------------------------ text signals

def _in_list(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in dict.fromkeys(words))


TOKEN_RE = r"[\p{L}\p{N}]+"
SENTENCE_RE = r"[^.!?]+[.!?]*"


def text_ctes(src: str = "transcripts_raw", text_col: str = "parsed_text", key: str = "path",
              positive=None, negative=None, outlook=None, min_hits: int = 4, mixed_pct: int = 80,
              prefix: str = "t") -> dict:
    """CTEs ``{prefix}_sentiment(key, positive_hits, negative_hits, sentiment)`` and
    ``{prefix}_summary(key, summary)`` over ``src``."""
    from .operators import signals as S
    positive = positive or S.POSITIVE_WORDS
    negative = negative or S.NEGATIVE_WORDS
    outlook = outlook or S.OUTLOOK_WORDS
    return {
        f"{prefix}_tok": f"""
  SELECT {key} AS k, unnest(regexp_extract_all(lower({text_col}), '{TOKEN_RE}')) AS t FROM {src}""",
        f"{prefix}_hits": f"""
  SELECT d.{key} AS k,
         CAST(coalesce(sum(CASE WHEN x.t IN ({_in_list(positive)}) THEN 1 ELSE 0 END), 0) AS INTEGER) AS p,
         CAST(coalesce(sum(CASE WHEN x.t IN ({_in_list(negative)}) THEN 1 ELSE 0 END), 0) AS INTEGER) AS n
  FROM {src} d LEFT JOIN {prefix}_tok x ON x.k = d.{key}
  GROUP BY d.{key}""",
        f"{prefix}_sentiment": f"""
  SELECT k AS {key}, p AS positive_hits, n AS negative_hits,
         CASE WHEN p + n < {min_hits} THEN 'neutral'
              WHEN p > 0 AND n > 0 AND abs(p - n) * 100 < {mixed_pct} * (p + n) THEN 'mixed'
              WHEN p > n THEN 'positive' ELSE 'negative' END AS sentiment
  FROM {prefix}_hits""",
        f"{prefix}_sent": f"""
  SELECT k, i, regexp_replace(regexp_replace(s, '[ \\t\\n\\r\\f]+', ' ', 'g'), '^ +| +$', '', 'g') AS sentence
  FROM (SELECT k, unnest(l) AS s, generate_subscripts(l, 1) AS i
        FROM (SELECT {key} AS k, regexp_extract_all({text_col}, '{SENTENCE_RE}') AS l FROM {src}))""",
        f"{prefix}_sent_score": f"""
  SELECT k, i, sentence, (SELECT count(*) FROM unnest(regexp_extract_all(lower(sentence), '{TOKEN_RE}')) u(t)
                          WHERE t IN ({_in_list(outlook)})) AS score
  FROM {prefix}_sent""",
        f"{prefix}_summary": f"""
  SELECT k AS {key}, sentence AS summary FROM (
    SELECT k, sentence, row_number() OVER (PARTITION BY k ORDER BY score DESC, i ASC) AS rn
    FROM {prefix}_sent_score WHERE score > 0) WHERE rn = 1""",
    }


TRANSCRIPTS = {
    **text_ctes(),
    "stg_earnings_transcripts": """
  SELECT r.file_name, r.symbol, r.fiscal_period, r.parsed_text, s.sentiment, m.summary, r.loaded_at, r.path
  FROM transcripts_raw r
  JOIN t_sentiment s ON s.path = r.path
  LEFT JOIN t_summary m ON m.path = r.path""",
    "latest_earnings": """
  SELECT symbol, sentiment, summary FROM (
    SELECT symbol, sentiment, summary,
           row_number() OVER (PARTITION BY symbol ORDER BY fiscal_period DESC NULLS LAST, file_name DESC,
                                                           md5(parsed_text) DESC) AS rn
    FROM stg_earnings_transcripts) WHERE rn = 1""",
}

MARTS.update({
    "valued": """
  SELECT *, CAST(net_quantity AS DECIMAL(19,4)) * price AS v
  FROM (SELECT * FROM trade_positions WHERE net_quantity <> 0) JOIN stg_instrument_prices USING (symbol)""",
    "portfolio_risk": """
  SELECT customer_id AS investor_id, segment AS investor_segment, risk_rating, symbol, asset_class, net_quantity, trade_count,
         price AS last_price, CAST(round(v, 2) AS DECIMAL(38,2)) AS market_value,
         CAST(greatest(round(v, 2), round(-v, 2)) AS DECIMAL(38,2)) AS gross_exposure,
         CAST(round(v - net_cost, 2) AS DECIMAL(38,2)) AS unrealized_pnl,
         (SELECT CAST(e.sentiment AS VARCHAR) FROM latest_earnings e WHERE e.symbol = valued.symbol) AS earnings_sentiment,
         (SELECT CAST(e.summary AS VARCHAR) FROM latest_earnings e WHERE e.symbol = valued.symbol) AS earnings_summary
  FROM valued JOIN (SELECT customer_id, segment, risk_rating FROM stg_customers) USING (customer_id)""",
    "exposures": """
  SELECT investor_id AS customer_id, sum(gross_exposure) AS total, count(*) AS n FROM portfolio_risk GROUP BY ALL
  UNION ALL
  SELECT customer_id, 0, 0 FROM stg_customers ANTI JOIN (SELECT investor_id AS customer_id FROM portfolio_risk) USING (customer_id)""",
    "investor_risk": """
  SELECT customer_id AS investor_id, segment AS investor_segment, risk_rating, country, as_of_date, gross_exposure,
         net_exposure, var_95, risk_limit, limit_breach_flag, CAST(total AS DECIMAL(38,2)) AS portfolio_gross_exposure,
         n AS instruments_held
  FROM exposures JOIN stg_customers USING (customer_id) LEFT JOIN stg_risk_metrics USING (customer_id)""",
})


# ---------------------------------------------------------------- assembly


def with_ctes(body: str, *groups: dict) -> str:
    ctes = {}
    for g in (BRONZE, STAGING, TRANSCRIPTS, MARTS) + groups:
        ctes.update(g)
    parts = ",\n".join(f"{name} AS ({sql}\n)" for name, sql in ctes.items())
    return f"WITH {parts}\n{body}"


def with_ctes_and(more: str) -> str:
    """Like :func:`with_ctes`, for a ``more`` text that continues the CTE list
    (``, name AS (...) ...``) and ends with the final SELECT."""
    ctes = {}
    for g in (BRONZE, STAGING, TRANSCRIPTS, MARTS):
        ctes.update(g)
    parts = ",\n".join(f"{name} AS ({sql}\n)" for name, sql in ctes.items())
    return f"WITH {parts}\n{more}"
