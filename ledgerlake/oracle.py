"""DuckDB oracle SQL for every SQL-expressible query of the catalog.

The feeds are written once as CTEs that mirror ``sources.feeds`` and
``plans.silver`` (same mappings, same total order for deduplication); each
query names the CTEs it needs.  Every computed column is aliased to the same
name as on the Spark side.
"""

from __future__ import annotations

_CTES: dict[str, tuple[list[str], str]] = {}


def _cte(name: str, deps: list[str], sql: str) -> None:
    _CTES[name] = (deps, sql)


_cte(
    "pb",
    [],
    """SELECT 'TXN' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS transaction_id,
       l_shipdate AS ts_event,
       'M' || CAST(l_suppkey AS VARCHAR) AS merchant_id,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
       CASE l_orderkey % 4 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'GBP' ELSE 'JPY' END AS currency,
       CASE l_linenumber % 3 WHEN 0 THEN 'POS' WHEN 1 THEN 'WEB' ELSE 'MOBILE' END AS channel,
       CASE WHEN l_returnflag = 'R' THEN 'DECLINED' ELSE 'APPROVED' END AS auth_result,
       l_partkey AS seq, l_orderkey AS k_order, l_partkey AS k_part, l_suppkey AS k_supp
FROM lineitem""",
)

_ENRICH = """SELECT b.transaction_id, b.ts_event, 'card' || CAST(o.o_custkey AS VARCHAR) AS card_hash, b.merchant_id,
       b.amount, b.currency, pt.p_type AS mcc, b.channel, b.auth_result,
       'City ' || CAST(su.s_suppkey AS VARCHAR) || ', ' || na.n_name AS location, b.seq
FROM {src} b
LEFT JOIN orders o ON b.k_order = o.o_orderkey
LEFT JOIN part pt ON b.k_part = pt.p_partkey
LEFT JOIN supplier su ON b.k_supp = su.s_suppkey
LEFT JOIN nation na ON su.s_nationkey = na.n_nationkey"""

_cte("p", ["pb"], _ENRICH.format(src="pb"))
_cte(
    "sb",
    ["pb"],
    """SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY transaction_id
                               ORDER BY ts_event DESC NULLS LAST, amount DESC NULLS LAST, seq DESC NULLS LAST) AS rn
  FROM pb) WHERE rn = 1""",
)
_cte("s", ["sb"], _ENRICH.format(src="sb"))
_cte(
    "e",
    [],
    """SELECT 'E' || CAST(event_id AS VARCHAR) AS transaction_id,
       ts AS ts_event,
       'card' || CAST(user_id AS VARCHAR) AS card_hash,
       'M' || json_extract_string(props, '$.k') AS merchant_id,
       CAST(value AS DECIMAL(18,2)) AS amount,
       CASE user_id % 2 WHEN 0 THEN 'USD' ELSE 'EUR' END AS currency,
       event_type AS mcc,
       'WEB' AS channel,
       CASE WHEN event_type = 'error' THEN 'DECLINED' ELSE 'APPROVED' END AS auth_result,
       'City ' || CAST(user_id AS VARCHAR) || ', ' ||
         CASE event_id % 3 WHEN 0 THEN 'US' WHEN 1 THEN 'DE' ELSE 'FR' END AS location
FROM events""",
)
_cte(
    "b",
    [],
    """SELECT 'M' || CAST(s_suppkey AS VARCHAR) AS merchant_id, 'LOW_BALANCE' AS reason
FROM supplier WHERE s_acctbal < 1000""",
)
_cte(
    "ft",
    ["s", "b"],
    """SELECT x.transaction_id, x.ts_event, x.card_hash, x.merchant_id, x.amount, x.currency, x.auth_result,
       COALESCE(x.amount > 10000, FALSE) AS flag_high_amount,
       bl.merchant_id IS NOT NULL AS flag_blacklisted
FROM s x LEFT JOIN (SELECT DISTINCT merchant_id FROM b WHERE merchant_id IS NOT NULL) bl
  ON x.merchant_id = bl.merchant_id""",
)
# Country from location (P3) for feed E, used by the rule queries.
_cte(
    "ec",
    ["e"],
    """SELECT *, NULLIF(CASE WHEN location IS NOT NULL AND location <> ''
                          THEN trim(string_split(location, ',')[-1]) END, '') AS country
FROM e""",
)

COUNTRY_SQL = "CASE WHEN location IS NOT NULL AND location <> '' THEN trim(string_split(location, ',')[-1]) END"


def with_ctes(needed: list[str], body: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in _CTES[n][0]:
            visit(d)
        order.append(n)

    for n in needed:
        visit(n)
    parts = ",\n".join(f"{n} AS (\n{_CTES[n][1]}\n)" for n in order)
    return f"WITH {parts}\n{body}"


PAY_COLS = "transaction_id, ts_event, card_hash, merchant_id, amount, currency, mcc, channel, auth_result, location"

SETTLEMENT_BODY = """SELECT merchant_id, currency, CAST(ts_event AS DATE) AS dt, count(*) AS txn_count,
       CAST(sum(amount) AS DECIMAL(38,2)) AS gross_amount,
       CAST(sum(amount) * 0.02 AS DECIMAL(38,4)) AS fees,
       CAST(sum(amount) - sum(amount) * 0.02 AS DECIMAL(38,4)) AS net_amount
FROM s GROUP BY merchant_id, currency, CAST(ts_event AS DATE)"""

ORACLE: dict[str, str] = {}


def _q(name: str, needed: list[str], body: str) -> None:
    ORACLE[name] = with_ctes(needed, body)


_q("stg_payments", ["p"], f"SELECT {PAY_COLS}, CAST(ts_event AS DATE) AS event_date FROM p")
_q("silver_dedup", ["s"], f"SELECT {PAY_COLS} FROM s")
# A date range of Silver: the rows of the whole deduplicated table in those days.
_q(
    "backfill_range",
    ["s"],
    f"""SELECT {PAY_COLS} FROM s
WHERE ts_event >= TIMESTAMP '1996-01-01 00:00:00' AND ts_event < TIMESTAMP '1997-01-01 00:00:00'""",
)
_q(
    "backfill_columns",
    ["s"],
    """SELECT transaction_id, ts_event, card_hash, merchant_id, amount, currency, CAST(NULL AS VARCHAR) AS mcc,
       channel, auth_result, location FROM s""",
)
_q("country_extract", ["s"], f"SELECT {COUNTRY_SQL} AS country, count(*) AS n FROM s GROUP BY 1")
_q(
    "dim_card",
    ["s"],
    "SELECT DISTINCT card_hash, md5(card_hash) AS card_fingerprint FROM s WHERE card_hash IS NOT NULL",
)
_q("dim_date", ["s"], "SELECT DISTINCT CAST(ts_event AS DATE) AS date_id FROM s WHERE ts_event IS NOT NULL")
_q("dim_merchant_pairs", ["p"], "SELECT DISTINCT merchant_id, mcc FROM p WHERE merchant_id IS NOT NULL")
_q(
    "dim_merchant",
    ["s"],
    """SELECT merchant_id, mcc FROM (
  SELECT merchant_id, mcc, row_number() OVER (PARTITION BY merchant_id
                                              ORDER BY ts_event DESC NULLS LAST, transaction_id DESC NULLS LAST) AS rn
  FROM s WHERE merchant_id IS NOT NULL) WHERE rn = 1""",
)
_q("fact_transactions", ["ft"], "SELECT * FROM ft")
_q("fact_fraud_signals", ["ft"], "SELECT * FROM ft WHERE flag_high_amount OR flag_blacklisted")
_q(
    "amount_buckets",
    ["ft"],
    """SELECT transaction_id, amount,
       CASE WHEN amount < 10 THEN '<10'
            WHEN amount >= 10 AND amount < 100 THEN '10-99'
            WHEN amount >= 100 AND amount < 1000 THEN '100-999'
            WHEN amount >= 1000 AND amount < 10000 THEN '1000-9999'
            ELSE '10000+' END AS amount_bucket
FROM ft""",
)
_q("settlement_daily", ["s"], SETTLEMENT_BODY)
_q(
    "merchant_totals",
    ["s"],
    """SELECT merchant_id, currency, count(*) AS txn_count, CAST(sum(amount) AS DECIMAL(38,2)) AS total_amount
FROM s GROUP BY merchant_id, currency""",
)
_q(
    "gold_review_backfill",
    ["s"],
    """SELECT transaction_id, ts_event, card_hash, merchant_id, amount, currency, auth_result, location,
       CAST(NULL AS VARCHAR) AS reason
FROM s WHERE location IS NOT NULL OR auth_result = 'DECLINED'""",
)

# --- fraud rules over feed E (plain PARTITION BY card: the brute-force form) --

_RANGE = "OVER (PARTITION BY card_hash ORDER BY ts_event RANGE BETWEEN INTERVAL {s} SECONDS PRECEDING AND CURRENT ROW)"
_ATT = (
    "OVER (PARTITION BY card_hash, auth_result IS NOT NULL ORDER BY ts_event ASC NULLS FIRST, "
    "transaction_id ASC NULLS FIRST ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)"
)
_LOC = (
    "OVER (PARTITION BY card_hash, (ts_event IS NOT NULL AND country IS NOT NULL) "
    "ORDER BY ts_event ASC NULLS FIRST, transaction_id ASC NULLS FIRST)"
)


def _flags_cte(velocity_s: int = 60, cross_s: int = 600, high: str = "10000", where: str = "TRUE") -> str:
    return f"""SELECT *,
  ts_event IS NOT NULL AND count(ts_event) {_RANGE.format(s=velocity_s)} > 5 AS velocity,
  COALESCE(ts_event IS NOT NULL AND country IS NOT NULL AND
           (min(country) {_RANGE.format(s=cross_s)} <> country OR max(country) {_RANGE.format(s=cross_s)} <> country),
           FALSE) AS cross_border,
  COALESCE(ts_event IS NOT NULL AND country IS NOT NULL AND lag(country) {_LOC} <> country
           AND ts_event <= lag(ts_event) {_LOC} + INTERVAL {cross_s} SECONDS, FALSE) AS cross_border_prev,
  COALESCE(auth_result IS NOT NULL AND count(*) {_ATT} >= 1 AND
           sum(CASE WHEN auth_result = 'DECLINED' THEN 1 ELSE 0 END) {_ATT} > 0.5 * count(*) {_ATT}, FALSE) AS decline_rate,
  COALESCE(amount > {high}, FALSE) AS high_amount
FROM ec WHERE card_hash IS NOT NULL AND {where}"""


_cte("efd", ["ec"], _flags_cte(velocity_s=86400))
_cte("ef", ["ec"], _flags_cte(high="200"))

_SEL = "SELECT transaction_id, card_hash, ts_event FROM {t} WHERE {c}"
_q("velocity_event", ["efd"], _SEL.format(t="efd", c="velocity"))
_q(
    "velocity_card_scope",
    ["efd"],
    "SELECT transaction_id, card_hash, ts_event FROM efd WHERE card_hash IN (SELECT card_hash FROM efd WHERE velocity)",
)
_q(
    "velocity_batch_count",
    ["e"],
    """SELECT transaction_id, card_hash, ts_event FROM e
WHERE card_hash IN (SELECT card_hash FROM e WHERE card_hash IS NOT NULL GROUP BY card_hash HAVING count(ts_event) > 5)""",
)
_q("cross_border_event", ["ef"], _SEL.format(t="ef", c="cross_border"))
_q("cross_border_prev", ["ef"], _SEL.format(t="ef", c="cross_border_prev"))
_q(
    "cross_border_card_scope",
    ["ef"],
    "SELECT transaction_id, card_hash, ts_event FROM ef WHERE card_hash IN (SELECT card_hash FROM ef WHERE cross_border)",
)
_q("decline_rate_event", ["ef"], _SEL.format(t="ef", c="decline_rate"))
_q(
    "decline_rate_card_scope",
    ["ef"],
    """SELECT transaction_id, card_hash, ts_event FROM ef WHERE card_hash IN (
  SELECT card_hash FROM (
    SELECT card_hash, decline_rate, row_number() OVER (PARTITION BY card_hash
        ORDER BY ts_event DESC NULLS LAST, transaction_id DESC NULLS LAST) AS rn
    FROM ef WHERE auth_result IS NOT NULL) WHERE rn = 1 AND decline_rate)""",
)
_q("high_amount", ["e"], "SELECT transaction_id, card_hash, ts_event FROM e WHERE COALESCE(amount > 200, FALSE)")
_q(
    "fraud_reasons",
    ["ef"],
    """SELECT transaction_id, concat_ws(',',
    CASE WHEN high_amount THEN 'high_amount' END,
    CASE WHEN velocity THEN 'velocity' END,
    CASE WHEN cross_border THEN 'cross_border' END,
    CASE WHEN decline_rate THEN 'decline_rate' END) AS reason
FROM ef""",
)

# --- card state, history ---------------------------------------------------

_LAST10 = """SELECT card_hash, least(cnt, 10) - rn + 1 AS pos, ts_event AS ts, auth_result, country FROM (
  SELECT card_hash, ts_event, auth_result, country,
         row_number() OVER (PARTITION BY card_hash ORDER BY src DESC, ts_event DESC NULLS LAST,
                            transaction_id DESC NULLS LAST) AS rn,
         count(*) OVER (PARTITION BY card_hash) AS cnt
  FROM (SELECT *, {src} AS src, {country} AS country FROM e WHERE card_hash IS NOT NULL)) WHERE rn <= 10"""
_q("card_state_last10", ["e"], _LAST10.format(src="0", country=COUNTRY_SQL))
_q(
    "card_state_merge",
    ["e"],
    _LAST10.format(src="CASE WHEN ts_event < TIMESTAMP '2024-01-16 00:00:00' THEN 0 ELSE 1 END", country=COUNTRY_SQL),
)
_q(
    "merchant_scd2",
    ["s"],
    """SELECT merchant_id, mcc, ts_event AS valid_from,
       lead(ts_event) OVER w2 AS valid_to, lead(ts_event) OVER w2 IS NULL AND lead(1) OVER w2 IS NULL AS is_current
FROM (
  SELECT merchant_id, mcc, ts_event, transaction_id,
         row_number() OVER w AS rn, lag(mcc) OVER w AS pm
  FROM s WHERE merchant_id IS NOT NULL
  WINDOW w AS (PARTITION BY merchant_id ORDER BY ts_event ASC NULLS FIRST, transaction_id ASC NULLS FIRST)
) WHERE rn = 1 OR pm IS DISTINCT FROM mcc
WINDOW w2 AS (PARTITION BY merchant_id ORDER BY ts_event ASC NULLS FIRST, transaction_id ASC NULLS FIRST)""",
)

# --- upserts ----------------------------------------------------------------

_FACT = """SELECT b.transaction_id, b.ts_event, CAST(b.ts_event AS DATE) AS date_id,
       'card' || CAST(o.o_custkey AS VARCHAR) AS card_hash, b.merchant_id, b.amount, b.currency, b.auth_result
FROM {src} b LEFT JOIN orders o ON b.k_order = o.o_orderkey"""
_cte(
    "tgt_b",
    ["pb"],
    """SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY transaction_id
                               ORDER BY ts_event ASC NULLS FIRST, amount ASC NULLS FIRST, seq ASC NULLS FIRST) AS rn
  FROM pb WHERE ts_event < TIMESTAMP '1998-04-01 00:00:00') WHERE rn = 1""",
)
_cte("tgt", ["tgt_b"], _FACT.format(src="tgt_b"))
for _name, _dir in (("src_latest", "DESC NULLS LAST"), ("src_first", "ASC NULLS FIRST")):
    _cte(
        _name + "_b",
        ["pb"],
        f"""SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY transaction_id
                               ORDER BY ts_event {_dir}, amount {_dir}, seq {_dir}) AS rn
  FROM pb WHERE ts_event >= TIMESTAMP '1997-01-01 00:00:00') WHERE rn = 1""",
    )
    _cte(_name, [_name + "_b"], _FACT.format(src=_name + "_b"))

_q(
    "upsert_transactions",
    ["tgt", "src_latest"],
    """SELECT * FROM tgt t WHERE NOT EXISTS (SELECT 1 FROM src_latest s WHERE s.transaction_id = t.transaction_id)
UNION ALL SELECT * FROM src_latest""",
)
_q(
    "insert_if_absent",
    ["tgt", "src_first"],
    """SELECT * FROM tgt
UNION ALL SELECT * FROM src_first s WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t.transaction_id = s.transaction_id)""",
)
_SETTLE = """SELECT merchant_id, currency, CAST(ts_event AS DATE) AS dt, count(*) AS txn_count,
       CAST(sum(amount) AS DECIMAL(38,2)) AS gross_amount,
       CAST(sum(amount) * 0.02 AS DECIMAL(38,4)) AS fees,
       CAST(sum(amount) - sum(amount) * 0.02 AS DECIMAL(38,4)) AS net_amount
FROM {src} GROUP BY merchant_id, currency, CAST(ts_event AS DATE)"""
_q(
    "upsert_settlement",
    ["tgt", "src_latest"],
    f"""SELECT * FROM ({_SETTLE.format(src="tgt")}) t WHERE NOT EXISTS (
  SELECT 1 FROM ({_SETTLE.format(src="src_latest")}) s
  WHERE s.merchant_id = t.merchant_id AND s.currency = t.currency AND s.dt = t.dt)
UNION ALL SELECT * FROM ({_SETTLE.format(src="src_latest")}) s2""",
)

# --- messages, validation, routing ------------------------------------------

_cte("efv", ["ec"], _flags_cte(high="200", where="mcc <> 'signup'"))
_REASON = """concat_ws(',',
    CASE WHEN high_amount THEN 'high_amount' END,
    CASE WHEN velocity THEN 'velocity' END,
    CASE WHEN cross_border THEN 'cross_border' END,
    CASE WHEN decline_rate THEN 'decline_rate' END)"""
_cte("efvr", ["efv"], f"SELECT *, {_REASON} AS reason FROM efv")
_q(
    "validate_route",
    ["efvr", "e"],
    """SELECT transaction_id, CASE WHEN reason <> '' THEN 'flagged' ELSE 'accepted' END AS route, reason FROM efvr
UNION ALL SELECT transaction_id, 'dead' AS route, 'missing_tx_or_amount' AS reason FROM e WHERE mcc = 'signup'""",
)
_q(
    "ts_normalize",
    ["e"],
    """SELECT transaction_id, strftime(ts_event, '%Y-%m-%dT%H:%M:%S.%fZ') AS ts_text, epoch_ms(date_trunc('millisecond', ts_event)) AS epoch_ms,
       strftime(date_trunc('millisecond', ts_event), '%Y-%m-%dT%H:%M:%S.%gZ') AS iso_ms FROM e""",
)

# --- data quality -----------------------------------------------------------

_q(
    "quality_not_null",
    ["e"],
    "SELECT transaction_id, CAST(NULL AS DECIMAL(18,2)) AS amount FROM e WHERE mcc = 'signup' OR amount IS NULL",
)
_q("quality_unique", ["pb"], "SELECT transaction_id, count(*) AS n FROM pb GROUP BY transaction_id HAVING count(*) > 1")
_q(
    "quality_relationships",
    ["e", "b"],
    """SELECT transaction_id, merchant_id FROM e
WHERE merchant_id IS NOT NULL AND merchant_id NOT IN (SELECT merchant_id FROM b WHERE merchant_id IS NOT NULL)""",
)
ORACLE["quality_non_negative"] = "SELECT s_suppkey, s_acctbal FROM supplier WHERE s_acctbal < 0"
_cte("dimm", ["p"], "SELECT DISTINCT merchant_id, mcc FROM p WHERE merchant_id IS NOT NULL")
_cte("dimc", ["p"], "SELECT DISTINCT card_hash FROM p WHERE card_hash IS NOT NULL")
_cte("stl", ["p"], SETTLEMENT_BODY.replace("FROM s GROUP", "FROM p GROUP"))
_DUP = "(SELECT CAST(COALESCE(sum(n - 1), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1))"
_NN = "(SELECT count(*) FILTER (WHERE {c} IS NULL) FROM {t})"
_FK = "(SELECT count(*) FROM {t} WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {c} FROM {p} WHERE {c} IS NOT NULL))"
_SUITE = [
    ("stg_tx_not_null", "stg_payments", "transaction_id", _NN.format(c="transaction_id", t="p")),
    ("dim_merchant_not_null", "dim_merchant", "merchant_id", _NN.format(c="merchant_id", t="dimm")),
    ("dim_merchant_unique", "dim_merchant", "merchant_id", _DUP.format(c="merchant_id", t="dimm")),
    ("dim_card_not_null", "dim_card", "card_hash", _NN.format(c="card_hash", t="dimc")),
    ("dim_card_unique", "dim_card", "card_hash", _DUP.format(c="card_hash", t="dimc")),
    ("fact_tx_not_null", "fact_transactions", "transaction_id", _NN.format(c="transaction_id", t="p")),
    ("fact_tx_unique", "fact_transactions", "transaction_id", _DUP.format(c="transaction_id", t="p")),
    ("fact_merchant_fk", "fact_transactions", "merchant_id", _FK.format(c="merchant_id", t="p", p="dimm")),
    ("fact_card_fk", "fact_transactions", "card_hash", _FK.format(c="card_hash", t="p", p="dimc")),
    ("fact_amount_non_negative", "fact_transactions", "amount",
     "(SELECT count(*) FILTER (WHERE NOT COALESCE(amount >= 0, TRUE)) FROM p)"),
    ("settlement_merchant_not_null", "settlement_daily", "merchant_id", _NN.format(c="merchant_id", t="stl")),
    ("settlement_dt_not_null", "settlement_daily", "dt", _NN.format(c="dt", t="stl")),
]
_q(
    "quality_suite",
    ["p", "dimm", "dimc", "stl"],
    "\nUNION ALL ".join(
        f"SELECT '{n}' AS check_name, '{t}' AS table_name, '{c}' AS column_name, CAST({v} AS BIGINT) AS violations"
        for n, t, c, v in _SUITE
    ),
)

# --- reports ----------------------------------------------------------------

_q("report_settlement", ["s"], SETTLEMENT_BODY.replace("AS dt,", "AS date,"))
_q(
    "report_fraud",
    ["efvr"],
    """SELECT transaction_id, strftime(ts_event, '%Y-%m-%dT%H:%M:%S.%fZ') AS ts_event, card_hash, merchant_id, amount,
       currency, auth_result, location, reason FROM efvr WHERE reason <> ''""",
)
_q(
    "report_totals",
    ["s"],
    """SELECT merchant_id, currency, count(*) AS txn_count, CAST(sum(amount) AS DECIMAL(38,2)) AS total_amount
FROM s GROUP BY merchant_id, currency""",
)

# The streaming job, replayed in three event-time chunks, must route exactly
# as the batch screening of all messages.
ORACLE["stream_screening"] = ORACLE["validate_route"]

# --- event-time streaming windows: all of them, the last ones included ---------

_q(
    "stream_velocity_window",
    ["e"],
    """SELECT card_hash, strftime(time_bucket(INTERVAL 1 MINUTE, ts_event), '%Y-%m-%dT%H:%M:%S.000Z') AS window_start,
       count(*) AS n
FROM e
GROUP BY card_hash, time_bucket(INTERVAL 1 MINUTE, ts_event)""",
)
_q(
    "stream_settlement",
    ["pb"],
    """SELECT merchant_id, currency, CAST(ts_event AS DATE) AS dt, count(*) AS txn_count,
       CAST(sum(amount) AS DECIMAL(38,2)) AS gross_amount,
       CAST(sum(amount) * 0.02 AS DECIMAL(38,4)) AS fees,
       CAST(sum(amount) - sum(amount) * 0.02 AS DECIMAL(38,4)) AS net_amount
FROM pb
GROUP BY merchant_id, currency, CAST(ts_event AS DATE)""",
)
_q("stream_dedup", ["e"], "SELECT DISTINCT transaction_id FROM e")
ORACLE["fraud_reasons_bucketed"] = ORACLE["fraud_reasons"]
ORACLE["cross_border_prev_bucketed"] = ORACLE["cross_border_prev"]
ORACLE["merchant_scd2_bucketed"] = ORACLE["merchant_scd2"]

# J3 as the literal self-join predicate (brute force): same card, another
# country, at most 600 s apart in either direction.
_q(
    "cross_border_selfjoin",
    ["ec"],
    """SELECT a.transaction_id, a.card_hash, a.ts_event FROM ec a
WHERE a.card_hash IS NOT NULL AND a.ts_event IS NOT NULL AND a.country IS NOT NULL AND EXISTS (
  SELECT 1 FROM ec b
  WHERE b.card_hash = a.card_hash AND b.ts_event IS NOT NULL AND b.country IS NOT NULL AND b.country <> a.country
    AND b.ts_event BETWEEN a.ts_event - INTERVAL 600 SECONDS AND a.ts_event + INTERVAL 600 SECONDS)""",
)
ORACLE["cross_border_selfjoin_bucketed"] = ORACLE["cross_border_selfjoin"]

# Sliding one-minute windows every 30 s: each event lies in the window of its
# own 30-s slot and in the one starting 30 s earlier.
_cte(
    "esl",
    ["e"],
    """SELECT card_hash, time_bucket(INTERVAL 30 SECOND, ts_event) AS ws FROM e
UNION ALL
SELECT card_hash, time_bucket(INTERVAL 30 SECOND, ts_event) - INTERVAL 30 SECOND AS ws FROM e""",
)
_q(
    "stream_velocity_sliding",
    ["e", "esl"],
    """SELECT card_hash, strftime(ws, '%Y-%m-%dT%H:%M:%S.000Z') AS window_start, count(*) AS n
FROM esl GROUP BY card_hash, ws""",
)

# Two overlapping Gold loads: of an id's rows the newest load's stays; rows
# without a time keep their place, rows without an id cannot enter.
_q(
    "gold_load_facts",
    ["s"],
    """SELECT transaction_id, CAST(CASE WHEN NOT gone THEN ts_event END AS DATE) AS date_id, card_hash, merchant_id,
       CAST(amount AS DECIMAL(18,2)) AS amount, currency, auth_result
FROM (
  SELECT *, string_split(transaction_id, '-')[-1] = CASE load WHEN 1 THEN '5' ELSE '7' END AS gone,
         row_number() OVER (PARTITION BY transaction_id ORDER BY load DESC) AS rn
  FROM (
    SELECT 1 AS load, s.* FROM s WHERE ts_event < TIMESTAMP '1996-07-01 00:00:00'
    UNION ALL
    SELECT 2 AS load, s.* REPLACE (CASE WHEN ts_event < TIMESTAMP '1996-07-01 00:00:00' THEN amount + 1 ELSE amount END AS amount)
    FROM s WHERE ts_event >= TIMESTAMP '1996-01-01 00:00:00' AND string_split(transaction_id, '-')[-1] <> '6'
  )
) WHERE rn = 1""",
)
# A ranged load of days in which some rows have moved on: facts, and A1 over all of them.
_cte(
    "rng",
    ["s"],
    """SELECT * FROM s WHERE ts_event < TIMESTAMP '1996-07-01 00:00:00' AND NOT (ts_event >= TIMESTAMP '1996-06-01 00:00:00')
UNION ALL
SELECT * REPLACE (CASE WHEN string_split(transaction_id, '-')[-1] = '3' THEN ts_event + INTERVAL 40 DAY ELSE ts_event END AS ts_event)
FROM s WHERE ts_event >= TIMESTAMP '1996-06-01 00:00:00' AND ts_event < TIMESTAMP '1996-09-01 00:00:00'""",
)
_q(
    "gold_load_ranged",
    ["rng"],
    """SELECT transaction_id, CAST(ts_event AS DATE) AS date_id, card_hash, merchant_id, amount, currency, auth_result FROM rng""",
)
_q("gold_settlement_incremental", ["rng"], SETTLEMENT_BODY.replace("FROM s GROUP", "FROM rng GROUP"))
_q(
    "gold_load_signals",
    ["efvr"],
    """SELECT transaction_id, strftime(ts_event, '%Y-%m-%dT%H:%M:%S.') || left(strftime(ts_event, '%f'), 3) || 'Z' AS ts_event,
       card_hash, merchant_id, amount, currency, auth_result, location, reason FROM efvr WHERE reason <> ''""",
)

# Snapshots applied in order give the history of all rows.
ORACLE["merchant_scd2_incremental"] = ORACLE["merchant_scd2"]

# Fed late and in restarts, the stream-stream join finds the events of the literal self-join.
ORACLE["stream_cross_border_join"] = ORACLE["cross_border_selfjoin"].replace(
    "SELECT a.transaction_id, a.card_hash, a.ts_event FROM",
    """SELECT a.transaction_id, a.card_hash,
       strftime(a.ts_event, '%Y-%m-%dT%H:%M:%S.') || left(strftime(a.ts_event, '%f'), 3) || 'Z' AS ts_event FROM""",
)
# The state store's lists are those of the whole table.
ORACLE["stream_card_state"] = ORACLE["card_state_last10"]

# The bucketed table holds what the Gold log holds.
ORACLE["signals_bucketed"] = ORACLE["gold_load_signals"]

# Messages with faults (event id % 40), screened with velocity over a day.
_ISO = "strftime({c}, '%Y-%m-%dT%H:%M:%S.') || left(strftime({c}, '%f'), 3) || 'Z'"
_cte(
    "fm",
    ["ec"],
    """SELECT CAST(substr(transaction_id, 2) AS BIGINT) % 40 AS fault,
       CASE WHEN fault = 2 THEN '' WHEN fault <> 1 THEN transaction_id END AS transaction_id,
       CASE WHEN fault <> 4 THEN ts_event END AS ts_event,
       CASE WHEN fault = 4 THEN 'soon' ELSE strftime(ts_event, '%Y-%m-%dT%H:%M:%S.%fZ') END AS ts_text,
       CASE WHEN fault <> 3 THEN card_hash END AS card_hash, merchant_id,
       CASE WHEN fault <> 6 THEN amount END AS amount, currency,
       CASE WHEN fault <> 5 THEN auth_result END AS auth_result, location, country, mcc, channel,
       transaction_id AS event
FROM ec""",
)
_cte("fv", ["fm"], "SELECT * FROM fm WHERE fault NOT IN (0, 1, 2, 6) AND amount IS NOT NULL")
_cte(
    "fvr",
    ["fv"],
    f"""SELECT *, {_REASON} AS reason FROM (
  {_flags_cte(velocity_s=86400, high="200").replace("FROM ec", "FROM fv")}
  UNION ALL
  SELECT *, FALSE, FALSE, FALSE, FALSE, COALESCE(amount > 200, FALSE) FROM fv WHERE card_hash IS NULL)""",
)


def _joined(*columns: str) -> str:
    return "concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in columns) + ")"


_PAY = ["transaction_id", "card_hash", "merchant_id", "amount", "currency", "auth_result", "location"]
_JSON = """'{"transaction_id": ' || event"""
_q(
    "stream_contents",
    ["fm", "fvr"],
    f"""SELECT 'accepted' AS kind, {_joined(_ISO.format(c="ts_event"), *_PAY, "CAST(ts_event AS DATE)")} AS fields
FROM fvr WHERE reason = ''
UNION ALL SELECT 'signal', {_joined(_ISO.format(c="ts_event"), *_PAY, "reason")} FROM fvr WHERE reason <> ''
UNION ALL SELECT 'flagged', {_joined("ts_text", *_PAY, "reason", "raw")} FROM (SELECT *, {{raw}} AS raw FROM fvr) WHERE reason <> ''
UNION ALL SELECT 'dead', {_joined("ts_text", *_PAY, "'missing_tx_or_amount'", "raw")}
  FROM (SELECT *, {{raw}} AS raw FROM fm) WHERE fault IN (1, 2, 6) OR (fault <> 0 AND amount IS NULL)
UNION ALL SELECT 'dead', {_joined(*["NULL"] * 8, "'malformed_json'", _JSON)} FROM fm WHERE fault = 0
UNION ALL SELECT 'card', {_joined("card_hash", "pos", _ISO.format(c="ts"), "auth_result", "country")} FROM (
  {_LAST10.format(src="0", country="country").replace("FROM e WHERE", "FROM fvr WHERE").replace("*, 0 AS src, country AS country", "*, 0 AS src")})""".replace(
        "{raw}",
        """'{' || concat_ws(',',
    '"transaction_id":"' || transaction_id || '"', '"ts_event":"' || ts_text || '"', '"card_hash":"' || card_hash || '"',
    '"merchant_id":"' || merchant_id || '"',
    '"amount":"' || CASE WHEN fault = 6 THEN 'much' ELSE CAST(amount AS VARCHAR) END || '"',
    '"currency":"' || currency || '"', '"mcc":"' || mcc || '"', '"channel":"' || channel || '"',
    '"auth_result":"' || auth_result || '"', '"location":"' || location || '"') || '}'""",
    ),
)

# The same messages' violations, counted from the table.
_q(
    "stream_quality",
    ["fm"],
    """SELECT unnest(['rows', 'late_rows', 'transaction_id_not_null', 'ts_event_not_null', 'card_hash_not_null', 'amount_not_null',
              'amount_non_negative', 'well_formed', 'required_fields']) AS check_name,
       unnest([count(*), 0, count(*) FILTER (fault IN (0, 1) OR event IS NULL), count(*) FILTER (fault = 0 OR ts_event IS NULL),
               count(*) FILTER (fault = 0 OR card_hash IS NULL), count(*) FILTER (fault IN (0, 6) OR amount IS NULL),
               count(*) FILTER (fault NOT IN (0, 6) AND amount < 0), count(*) FILTER (fault = 0),
               count(*) FILTER (fault IN (0, 1, 2, 6) OR amount IS NULL)]) AS violations
FROM fm""",
)
