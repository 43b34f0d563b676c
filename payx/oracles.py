"""The registered queries in SQL for the given tables, written apart from the operators."""

from __future__ import annotations

from payx.schema import DECIMALS, PROTOCOL, SOURCE, TOKEN

WINDOWS = "w(window_name, days) AS (VALUES ('7d', 7), ('30d', 30), ('all', 0))"


def _hex(letter: str, key: str) -> str:
    return f"'0x{letter}' || lpad(lower(to_hex(({key})::BIGINT)), 39, '0')"


PAY = f"""
    pay AS (
      SELECT 'base' AS chain, '0x' || lpad(lower(to_hex(l_orderkey)), 64, '0') AS tx_hash, l_orderkey AS ok,
        row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus)::INT AS log_index,
        (l_shipdate::DATE - DATE '1992-01-01')::BIGINT AS block_number, l_shipdate AS block_timestamp, l_shipdate::DATE AS day,
        {_hex('f', 'c_nationkey')} AS facilitator, {_hex('a', 'o_custkey')} AS payer, {_hex('e', 'l_suppkey')} AS payee,
        CASE WHEN l_linenumber % 2 = 0 THEN l_quantity::BIGINT * 10000 ELSE round(l_extendedprice * 100)::BIGINT * 10000 // (10 ** l_linenumber)::BIGINT END AS amount_raw,
        lpad(lower(to_hex(l_partkey)), 64, '0') AS auth_nonce, (['e3ee160e', 'cf092995', 'ef55bec6', '88b7ab63', '82ad56cb'])[l_orderkey % 5 + 1] AS method_selector,
        CASE WHEN l_orderkey % 5 IN (2, 3) THEN 'receive' ELSE 'transfer' END AS settlement_kind, {_hex('d', 'l_orderkey % 7')} AS called_contract,
        (l_orderkey % 3)::INT AS tx_type, 1000000000 * (1 + l_orderkey % 50) AS price, 21000 + l_orderkey % 50000 AS gas_used,
        CASE WHEN l_orderkey % 3 = 2 THEN 1000000000 * (1 + l_orderkey % 50) * 2 END AS max_fee_per_gas, CASE WHEN l_orderkey % 3 = 2 THEN l_orderkey % 1000 END AS max_priority_fee_per_gas,
        CASE WHEN l_orderkey % 11 <> 0 THEN 21000 + l_orderkey % 50000 + l_orderkey % 30000 END AS gas_limit, CASE WHEN l_orderkey % 97 = 0 THEN 1 ELSE 0 END AS tx_value,
        (21000 + l_orderkey % 50000) * 1000000000 * (1 + l_orderkey % 50) AS gas_cost_wei, CASE WHEN l_orderkey % 7 <> 0 THEN l_orderkey % 1000 * 1000000000 END AS l1_fee,
        CASE WHEN l_orderkey % 5 <> 0 THEN o_orderdate END AS valid_after, CASE WHEN l_orderkey % 5 <> 0 AND l_orderkey % 13 <> 0 THEN o_orderdate + INTERVAL 90 DAY END AS valid_before
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
    allow AS (SELECT {_hex('f', 'n_nationkey')} AS address, CASE WHEN n_nationkey % 4 <> 0 THEN n_name END AS label, CASE WHEN n_regionkey = 2 THEN 2 ELSE 1 END AS since_version, CASE WHEN n_nationkey = 3 THEN 2 END AS until_version FROM nation WHERE n_regionkey IN (0, 1, 2)),
    p AS (SELECT pay.*, (amount_raw::DECIMAL(18,0) * 0.000001::DECIMAL(6,6))::DECIMAL(38,6) AS amount_usdc, facilitator IN (SELECT address FROM allow WHERE since_version <= 1 AND (until_version IS NULL OR until_version > 1)) AS known,
      CASE WHEN facilitator IN (SELECT address FROM allow WHERE since_version <= 1 AND (until_version IS NULL OR until_version > 1)) THEN 'known' ELSE 'unknown' END AS membership FROM pay),
    k AS (SELECT * FROM p WHERE known),
    {WINDOWS},
    ak AS (SELECT max(day) AS d FROM k), aa AS (SELECT max(day) AS d FROM p)"""

BAND = "CASE WHEN amount_usdc < 0.01 THEN 'dust' WHEN amount_usdc < 1 THEN 'micro' WHEN amount_usdc < 100 THEN 'small' WHEN amount_usdc < 1000 THEN 'mid' ELSE 'whale' END"
#: Known payments in windows that end with the newest known day, and all payments in windows that end with the newest.
KW = "kw AS (SELECT w.window_name, k.* FROM k, w, ak WHERE days = 0 OR day >= d - (days - 1))"
PW = "pw AS (SELECT w.window_name, p.* FROM p, w, aa WHERE days = 0 OR day >= d - (days - 1)), pm AS (SELECT * FROM pw UNION ALL SELECT * REPLACE ('all' AS membership) FROM pw)"
KA = "ka AS (SELECT * FROM pw WHERE known)"
CUBE = f"cube AS (SELECT day, chain, facilitator, membership, {BAND} AS band, 1 AS methodology_version, count(*) AS txn_count, sum(amount_usdc) AS volume_usdc, max(amount_usdc) AS max_amount_usdc FROM p GROUP BY ALL)"
ECONOMY = f"{KW}, economy AS (SELECT window_name, {BAND} AS band, count(*) AS txn_count, sum(amount_usdc) AS volume_usdc FROM kw GROUP BY ALL UNION ALL SELECT window_name, 'all', count(*), sum(amount_usdc) FROM kw GROUP BY ALL)"
POINTS = "points AS (SELECT * FROM (SELECT window_name, row_number() OVER (PARTITION BY window_name ORDER BY count(*) DESC, amount_usdc) AS rank, amount_usdc, count(*) AS txn_count, sum(amount_usdc) AS volume_usdc, count(DISTINCT payee) AS payee_count FROM kw GROUP BY window_name, amount_usdc) WHERE rank <= 50)"
BREADTH = "breadth AS (SELECT day, amount_usdc, count(DISTINCT payee) AS payee_count FROM k WHERE amount_usdc IN (SELECT amount_usdc FROM points WHERE window_name = 'all' AND rank <= 12) GROUP BY ALL)"
CANCELS = f"""
    c AS (SELECT '0x' || lpad(lower(to_hex(event_id)), 64, '0') AS tx_hash, {_hex('a', 'user_id')} AS authorizer, {_hex('f', 'user_id % 25')} AS transaction_from, lpad(lower(to_hex(event_id)), 64, '0') AS nonce,
      ts - INTERVAL 1 DAY * (800 + event_id % 60) AS block_time FROM events WHERE event_type = 'error'),
    cm AS (SELECT *, transaction_from IN (SELECT address FROM allow WHERE since_version <= 1 AND (until_version IS NULL OR until_version > 1)) AS known FROM c)"""
STATS = "stats AS (SELECT window_name, membership, count(*) AS txn_count, quantile_disc(amount_usdc, 0.1) AS p10_amount_usdc, quantile_disc(amount_usdc, 0.5) AS median_amount_usdc, quantile_disc(amount_usdc, 0.9) AS p90_amount_usdc, quantile_disc(amount_usdc, 0.99) AS p99_amount_usdc FROM sm GROUP BY ALL)"
SM = "sw AS (SELECT w.window_name, p.* FROM p, w, ak WHERE days = 0 OR day >= d - (days - 1)), sm AS (SELECT * FROM sw UNION ALL SELECT * REPLACE ('all' AS membership) FROM sw)"
PRICES = """
    prices AS (SELECT unnest(generate_series(date_trunc('week', (SELECT min(l_shipdate) FROM lineitem)), date_trunc('week', (SELECT max(l_shipdate) FROM lineitem)), INTERVAL 7 DAY))::DATE AS week),
    priced AS (SELECT week, 1000 + ((week - DATE '1990-01-01') * 37) % 3000 AS usd FROM prices)"""
GAS = f"""
    tx AS (SELECT tx_hash AS th, count(*) AS n, max(gas_cost_wei) AS g, max(coalesce(l1_fee, 0)) AS l FROM p GROUP BY 1),
    cost AS (SELECT p.*, g, l, n, ((g + l)::DOUBLE / n * usd::DOUBLE / 1e18)::DECIMAL(38,12) AS usd_each FROM p JOIN tx ON tx_hash = th JOIN priced ON week = date_trunc('week', block_timestamp)::DATE),
    gas AS (SELECT day, membership, {BAND} AS band, count(*) AS txn_count, sum(g::DOUBLE / n) AS l2, sum(l::DOUBLE / n) AS l1, sum(usd_each) AS usd, count(*) FILTER (usd_each > amount_usdc) AS breakeven_count, sum(amount_usdc) AS volume_usdc FROM cost GROUP BY ALL)"""
GASW = """
    gw AS (SELECT w.window_name, gas.* FROM gas, w, ak WHERE membership = 'known' AND (days = 0 OR day >= d - (days - 1))),
    gb AS (SELECT * FROM gw UNION ALL SELECT * REPLACE ('all' AS band) FROM gw),
    gaswin AS (SELECT window_name, band, sum(txn_count)::BIGINT AS txn_count, round((sum(l2) + sum(l1)) / 1e18, 6) AS eth_total, round(sum(l2) / 1e18, 6) AS eth_l2, round(sum(l1) / 1e18, 6) AS eth_l1, round(sum(usd)::DOUBLE, 2) AS usd, round(sum(usd)::DOUBLE * 100 / nullif(sum(volume_usdc), 0)::DOUBLE, 4) AS cents_per_dollar, sum(breakeven_count)::BIGINT AS breakeven_count FROM gb GROUP BY ALL)"""
AGG = """
    sides AS (SELECT window_name, 'payer' AS role, payer AS address, payee AS other, amount_usdc, block_timestamp FROM ka UNION ALL SELECT window_name, 'payee', payee, payer, amount_usdc, block_timestamp FROM ka),
    agg AS (SELECT window_name, role, address, sum(amount_usdc) AS volume_usdc, count(*) AS txn_count, count(DISTINCT other) AS distinct_counterparties, min(block_timestamp) AS first_seen, max(block_timestamp) AS last_seen, count(DISTINCT amount_usdc) AS distinct_amounts, sum(amount_usdc) AS known_volume_usdc FROM sides GROUP BY ALL),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY window_name, role ORDER BY volume_usdc DESC, address) AS rv, row_number() OVER (PARTITION BY window_name, role ORDER BY txn_count DESC, address) AS rt FROM agg)"""
CLASS = "CASE WHEN txn_count <= 20 AND volume_usdc::DOUBLE / txn_count >= 10000 THEN 'otc' WHEN volume_usdc::DOUBLE / txn_count <= 0.01 AND txn_count >= 1000 THEN 'sink' WHEN distinct_amounts <= 2 AND txn_count >= 1000 THEN 'fleet' WHEN distinct_counterparties >= 50 AND distinct_amounts >= 10 THEN 'service' ELSE 'tail' END"
CONC = "conc AS (SELECT window_name, role, count(*) AS total_entities, sum(volume_usdc) AS total_volume, sum(txn_count)::BIGINT AS total_txns, coalesce(sum(volume_usdc) FILTER (rv <= 10), 0) AS top10_volume, coalesce(sum(txn_count) FILTER (rt <= 10), 0)::BIGINT AS top10_txns, coalesce(sum(volume_usdc) FILTER (rv <= 100), 0) AS top100_volume FROM ranked GROUP BY ALL)"
LAT = "lat AS (SELECT *, valid_after IS NOT NULL AND valid_before IS NOT NULL AS windowed, CASE WHEN valid_after IS NOT NULL AND valid_before IS NOT NULL AND block_timestamp >= valid_after THEN epoch(block_timestamp) - epoch(valid_after) END AS s FROM pm)"
REL = """
    rel AS (SELECT window_name, membership, count(*) AS settlement_count, count(*) FILTER (windowed) AS windowed_count, round(quantile_cont(s, 0.5), 6) AS latency_p50_s, round(quantile_cont(s, 0.9), 6) AS latency_p90_s, round(quantile_cont(s, 0.99), 6) AS latency_p99_s,
      count(*) FILTER (s < 1) AS lat_bucket_sub1s, count(*) FILTER (s >= 1 AND s < 10) AS lat_bucket_1_10s, count(*) FILTER (s >= 10 AND s < 60) AS lat_bucket_10_60s, count(*) FILTER (s >= 60 AND s < 600) AS lat_bucket_1_10m, count(*) FILTER (s >= 600) AS lat_bucket_gt10m,
      count(*) FILTER (windowed AND block_timestamp > valid_before) AS expired_count, count(*) FILTER (windowed AND block_timestamp < valid_after) AS not_yet_valid_count FROM lat GROUP BY ALL),
    cw AS (SELECT window_name, CASE WHEN known THEN 'known' ELSE 'unknown' END AS membership FROM cm, w, aa WHERE days = 0 OR block_time::DATE >= d - (days - 1)),
    cc AS (SELECT window_name, membership, count(*) AS n FROM (SELECT * FROM cw UNION ALL SELECT window_name, 'all' FROM cw) GROUP BY ALL),
    relw AS (SELECT rel.*, coalesce(n, 0) AS cancellation_count FROM rel LEFT JOIN cc USING (window_name, membership))"""
RELD = """
    ld AS (SELECT *, valid_after IS NOT NULL AND valid_before IS NOT NULL AS windowed FROM p),
    rd AS (SELECT day, chain, membership, count(*) AS settlement_count, count(*) FILTER (windowed) AS windowed_count, count(*) FILTER (windowed AND block_timestamp > valid_before) AS expired_count, count(*) FILTER (windowed AND block_timestamp < valid_after) AS not_yet_valid_count FROM ld GROUP BY ALL),
    cd AS (SELECT block_time::DATE AS day, CASE WHEN known THEN 'known' ELSE 'unknown' END AS membership, count(*) AS n FROM cm GROUP BY ALL),
    reld AS (SELECT rd.*, coalesce(n, 0) AS cancellation_count FROM rd LEFT JOIN cd USING (day, membership))"""
BATCH = """
    bt AS (SELECT window_name, tx_hash, count(*) AS n FROM ka GROUP BY ALL),
    batch AS (SELECT window_name, CASE WHEN n = 1 THEN '1' WHEN n <= 10 THEN '2-10' WHEN n <= 100 THEN '11-100' ELSE '100+' END AS batch_bucket, count(*) AS tx_count, sum(n)::BIGINT AS payment_count FROM bt GROUP BY ALL)"""
SEL = "sel AS (SELECT * FROM (SELECT window_name, membership, method_selector AS selector_hex, settlement_kind, count(*) AS txn_count, sum(amount_usdc) AS volume_usdc, row_number() OVER (PARTITION BY window_name, membership ORDER BY count(*) DESC, method_selector, settlement_kind) AS rank FROM pm GROUP BY window_name, membership, method_selector, settlement_kind) WHERE rank <= 15)"
TRIPLE = "tri AS (SELECT *, 'payer' AS role, payer AS address, payee AS other FROM p UNION ALL SELECT *, 'payee', payee, payer FROM p UNION ALL SELECT *, 'facilitator', facilitator, payer FROM p)"
DAYS = f"{TRIPLE}, days AS (SELECT chain, address, role, day, known AS facilitator_known, count(*) AS txn_count, sum(amount_usdc) AS volume_usdc FROM tri GROUP BY ALL), dl AS (SELECT *, 'all' AS lens FROM days UNION ALL SELECT *, 'known' FROM days WHERE facilitator_known)"
EDGE = "edge AS (SELECT chain, payer, payee, known AS facilitator_known, count(*) AS txn_count, sum(amount_usdc) AS volume_usdc, min(block_timestamp) AS first_seen, max(block_timestamp) AS last_seen FROM p GROUP BY ALL)"
FEDGE = """fs AS (SELECT *, 'payer' AS role, payer AS counterparty FROM p UNION ALL SELECT *, 'payee', payee FROM p),
    fedge AS (SELECT chain, facilitator, role, counterparty, known AS facilitator_known, count(*) AS txn_count, sum(amount_usdc) AS volume_usdc, min(block_timestamp) AS first_seen, max(block_timestamp) AS last_seen FROM fs GROUP BY ALL)"""
PAIRS = """pr AS (SELECT 'payer' AS role, payer AS address, payee AS other, facilitator_known AS known, volume_usdc FROM edge UNION ALL SELECT 'payee', payee, payer, facilitator_known, volume_usdc FROM edge UNION ALL SELECT 'facilitator', facilitator, counterparty, facilitator_known, volume_usdc FROM fedge),
    prl AS (SELECT *, 'all' AS lens FROM pr UNION ALL SELECT *, 'known' FROM pr WHERE known)"""
EPP = "pp AS (SELECT chain, address, role, known AS facilitator_known, amount_usdc, count(*) AS txn_count FROM tri GROUP BY ALL), epp AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY chain, address, role, facilitator_known ORDER BY txn_count DESC, amount_usdc) AS amount_rank, count(*) OVER (PARTITION BY chain, address, role, facilitator_known) AS total_distinct_amounts FROM pp) WHERE amount_rank <= 64)"
MPP = "epl AS (SELECT *, 'all' AS lens FROM epp UNION ALL SELECT *, 'known' FROM epp WHERE facilitator_known), mp AS (SELECT address, role, lens, amount_usdc, sum(txn_count)::BIGINT AS txn_count, max(total_distinct_amounts) AS d FROM epl GROUP BY ALL), mpp AS (SELECT address, role, lens, amount_usdc, txn_count, row_number() OVER (PARTITION BY address, role, lens ORDER BY txn_count DESC, amount_usdc) AS rank, CASE WHEN lens = 'known' THEN d END AS total_distinct_amounts FROM mp QUALIFY rank <= 16)"
CAD = "dn AS (SELECT address, role, lens, day, sum(txn_count)::BIGINT AS n FROM dl GROUP BY ALL), cad AS (SELECT address, role, lens, count(*) AS active_days, (max(day) - min(day) + 1)::INT AS span_days, quantile_disc(n, 0.5)::BIGINT AS median_per_day, round(max(n)::DOUBLE / sum(n)::DOUBLE, 6) AS top_day_share FROM dn GROUP BY ALL)"
TOP = "pc AS (SELECT address, role, lens, other, sum(volume_usdc) AS v, row_number() OVER (PARTITION BY address, role, lens ORDER BY sum(volume_usdc) DESC, other) AS r FROM prl GROUP BY address, role, lens, other), top AS (SELECT address, role, lens, round(sum(v) FILTER (r <= 1)::DOUBLE / sum(v)::DOUBLE, 6) AS top1_share, round(sum(v) FILTER (r <= 3)::DOUBLE / sum(v)::DOUBLE, 6) AS top3_share FROM pc GROUP BY ALL)"
BOARD = """
    bs AS (SELECT window_name, 'payer' AS role, payer AS address, payee AS other, * FROM pw UNION ALL SELECT window_name, 'payee', payee, payer, * FROM pw), bl AS (SELECT 'all' AS lens, * FROM bs UNION ALL SELECT 'known', * FROM bs WHERE known),
    board AS (SELECT window_name, role, lens, address, count(DISTINCT other) AS distinct_counterparties, count(*) AS txn_count, sum(amount_usdc) AS volume_usdc, min(block_timestamp) AS first_seen, max(block_timestamp) AS last_seen FROM bl GROUP BY window_name, role, lens, address
      QUALIFY row_number() OVER (PARTITION BY window_name, role, lens ORDER BY volume_usdc DESC, address) <= 500 OR row_number() OVER (PARTITION BY window_name, role, lens ORDER BY txn_count DESC, address) <= 500 OR row_number() OVER (PARTITION BY window_name, role, lens ORDER BY distinct_counterparties DESC, address) <= 500)"""
NEAR = """
    nd AS (SELECT 'payees' AS direction, payer AS subject, payee AS counterparty, facilitator_known, txn_count, volume_usdc, first_seen, last_seen FROM edge UNION ALL SELECT 'payers', payee, payer, facilitator_known, txn_count, volume_usdc, first_seen, last_seen FROM edge
      UNION ALL SELECT 'facilitators', counterparty, facilitator, facilitator_known, txn_count, volume_usdc, first_seen, last_seen FROM fedge UNION ALL SELECT 'settled_' || role || 's', facilitator, counterparty, facilitator_known, txn_count, volume_usdc, first_seen, last_seen FROM fedge),
    nl AS (SELECT *, 'all' AS lens FROM nd UNION ALL SELECT *, 'known' FROM nd WHERE facilitator_known),
    ng AS (SELECT direction, subject, lens, counterparty, sum(txn_count)::BIGINT AS txn_count, sum(volume_usdc) AS volume_usdc, min(first_seen) AS first_seen, max(last_seen) AS last_seen FROM nl GROUP BY ALL),
    near AS (SELECT * EXCLUDE (first_seen), row_number() OVER x AS rank, count(*) OVER y AS total_counterparties, coalesce(round(volume_usdc::DOUBLE / nullif(sum(volume_usdc) OVER y, 0)::DOUBLE, 6), 0) AS share FROM ng WINDOW y AS (PARTITION BY direction, subject, lens), x AS (PARTITION BY direction, subject, lens ORDER BY volume_usdc DESC, counterparty) QUALIFY rank <= 50)"""
SIGNALS = f"""
    signals AS (SELECT {_hex('e', 's_suppkey')} AS address, CASE WHEN s_suppkey % 3 = 0 THEN 'catalog' ELSE 'basename' END AS source, s_name AS label, NULL AS url FROM supplier
      UNION ALL SELECT {_hex('e', 's_suppkey')}, 'other', lower(s_name), NULL FROM supplier UNION ALL SELECT {_hex('f', 'n_nationkey')}, CASE WHEN n_nationkey % 2 = 0 THEN 'manual' ELSE 'other' END, 'manual ' || n_name, 'https://example.org' FROM nation),
    labels AS (SELECT address, source, label FROM (SELECT address, source, label, url FROM signals UNION ALL SELECT address, 'allowlist', label, NULL FROM allow WHERE since_version <= 1 AND (until_version IS NULL OR until_version > 1) AND label IS NOT NULL)
      QUALIFY row_number() OVER (PARTITION BY address ORDER BY CASE source WHEN 'manual' THEN 0 WHEN 'catalog' THEN 1 WHEN 'erc8004' THEN 2 WHEN 'basename' THEN 3 WHEN 'allowlist' THEN 4 ELSE 5 END, source, label, url NULLS LAST) = 1)"""
#: What raw_events makes of the payments: e has every payment with its authorization's fate.
EVENTS = """
    e AS (SELECT *, max(log_index) OVER (PARTITION BY tx_hash) AS last, min(block_number) OVER (PARTITION BY tx_hash) AS first_block FROM p),
    fate AS (SELECT *, CASE WHEN ok % 31 = 0 THEN 'denied' WHEN ok % 29 = 0 AND log_index = last THEN 'dropped' WHEN ok % 13 = 0 AND log_index = 2 THEN 'dropped' ELSE 'kept' END AS outcome FROM e),
    tx1 AS (SELECT DISTINCT ON (tx_hash) * FROM e ORDER BY tx_hash, log_index)"""
FATE_STATS = "count(*) AS auth_logs, count(*) FILTER (outcome = 'denied') AS denied, count(*) FILTER (outcome = 'kept') AS kept, count(*) FILTER (outcome = 'dropped') AS dropped"
QUARANTINE = EVENTS + """,
    q AS (SELECT *, first_value(payee) OVER (PARTITION BY tx_hash ORDER BY log_index) AS first_payee, CASE WHEN first_block % 37 = 0 THEN 'block: bad timestamp' WHEN ok % 43 = 0 AND last >= 3 THEN 'log: bad data' WHEN ok % 41 = 0 THEN 'transaction: bad gas_used' END AS reason FROM fate)"""
def _bignum(pieces: str) -> str:
    """Decimal text of 32-bit pieces, the highest first, by doubling and adding; the last six digits behind a point."""
    steps = f"flatten(list_transform({pieces}, lambda x: list_concat(list_transform(range(32), lambda i: '-1'::BIGNUM), [x::BIGNUM])))"
    number = f"list_reduce(list_prepend('0'::BIGNUM, {steps}), lambda a, x: CASE WHEN x = '-1'::BIGNUM THEN a + a ELSE a + x END)::VARCHAR"
    return f"list_transform([lpad({number}, greatest(7, len({number}))::INT, '0')], lambda t: t[:-7] || '.' || t[-6:])[1]"


WIDE = """
    wide AS (SELECT day, facilitator, known, CASE log_index % 3 WHEN 0 THEN lpad(h || repeat('0', 48), 64, '0') WHEN 1 THEN repeat('7f', 32)[:64 - len(h)] || h ELSE lpad(h, 64, '0') END AS w FROM (SELECT *, lower(to_hex(amount_raw)) AS h FROM p)),
    wsum AS (SELECT day, 'base' AS chain, facilitator, CASE WHEN known THEN 'known' ELSE 'unknown' END AS membership, 1 AS methodology_version, count(*) AS txn_count, max(w) AS most, [""" + ", ".join(f"sum(('0x' || w[{1 + 8 * i}:{8 + 8 * i}])::BIGINT)" for i in range(8)) + "] AS s FROM wide GROUP BY ALL)"
ENTITIES_TO, BATCHES_TO = ((1, "1"), (10, "2-10"), (100, "11-100"), (1000, "101-1000"), (100000, "1001-100000")), ((1, "1"), (10, "2-10"), (100, "11-100"))


def _steps_to(what: str, bounds, last: str) -> str:
    return "CASE " + " ".join(f"WHEN {what} <= {n} THEN '{name}'" for n, name in bounds) + f" ELSE '{last}' END"


EMPTY_CHECK = 'SELECT NULL::VARCHAR AS "check", NULL::VARCHAR AS detail WHERE false'
SERIES = f"{CUBE}, ser AS (SELECT day, sum(txn_count)::BIGINT AS txn_count, sum(volume_usdc) AS volume_usdc, day <> (SELECT d FROM ak) AS complete FROM cube WHERE membership = 'known' GROUP BY day)"
MONTHS = f"{CUBE}, mon AS (SELECT date_trunc('month', day)::DATE AS month, sum(txn_count)::BIGINT AS txn_count, sum(volume_usdc) AS volume_usdc FROM cube WHERE membership = 'known' GROUP BY 1), months AS (SELECT *, month >= (SELECT min(day) FROM k) AND last_day(month) <= (SELECT d FROM ak) AS complete FROM mon)"
COHORTS = """
    fd AS (SELECT payer, min(day) AS first_day FROM k GROUP BY 1), ch AS (SELECT w.window_name, k.payer, amount_usdc, first_day >= d - (days - 1) AS fresh FROM k JOIN fd USING (payer), w, ak WHERE days > 0 AND day >= d - (days - 1) AND day <= d),
    cohorts AS (SELECT window_name, count(DISTINCT payer) FILTER (fresh) AS new_payers, count(DISTINCT payer) FILTER (NOT fresh) AS returning_payers, coalesce(sum(amount_usdc) FILTER (fresh), 0)::DECIMAL(38,6) AS new_payer_volume_usdc, coalesce(sum(amount_usdc) FILTER (NOT fresh), 0)::DECIMAL(38,6) AS returning_payer_volume_usdc FROM ch GROUP BY 1)"""
MECH = """
    mx AS (SELECT *, CASE WHEN epoch(valid_before) - epoch(valid_after) >= 0 THEN epoch(valid_before) - epoch(valid_after) END AS width, CASE WHEN gas_limit > 0 THEN gas_used / gas_limit END AS ratio FROM pm),
    mech AS (SELECT window_name, membership, count(*) AS settlement_count, count(*) FILTER (tx_type = 0) AS type0_count, count(*) FILTER (tx_type = 1) AS type1_count, count(*) FILTER (tx_type = 2) AS type2_count, count(*) FILTER (tx_value > 0) AS nonzero_value_count, {q} FROM mx GROUP BY ALL)""".format(
    q=", ".join(f"round(quantile_cont({c}::DOUBLE, {q / 100}), {2 if n.endswith('fee') else 6}) AS {n}_p{q}" for n, c in (("max_fee", "max_fee_per_gas"), ("priority_fee", "max_priority_fee_per_gas"), ("auth_width_s", "width"), ("gas_ratio", "ratio")) for q in (50, 90, 99))
)
GRAPH = """
    gx AS (SELECT *, row_number() OVER (PARTITION BY tx_hash ORDER BY log_index) AS event_no FROM p), gd AS (SELECT *, 'ev:' || tx_hash || ':' || log_index AS event_id FROM gx WHERE event_no <= 128),
    links AS (SELECT DISTINCT * FROM (SELECT tx_hash, 'emits' AS kind, tx_hash AS from_id, event_id AS to_id FROM gd UNION ALL SELECT tx_hash, 'pays', payer, event_id FROM gd UNION ALL SELECT tx_hash, 'pays', event_id, payee FROM gd UNION ALL SELECT tx_hash, 'settles', facilitator, tx_hash FROM gd))"""
GR8 = "placed AS (SELECT chain, address, role, (row_number() OVER (PARTITION BY chain, address, role ORDER BY block_number DESC, tx_hash DESC, log_index DESC))::INT AS place, block_number, tx_hash, log_index, other AS counterparty, amount_usdc FROM tri)"
TICKS = "t AS (SELECT ts::DATE AS day, CASE WHEN user_id % 3 <> 0 THEN 'known' ELSE 'unknown' END AS membership, date_trunc('minute', ts) AS m, count(*) AS n FROM events GROUP BY ALL), vel AS (SELECT day, membership, sum(n)::BIGINT AS txn_count, max(n) AS max_per_minute, quantile_disc(n, 0.99)::BIGINT AS p99_per_minute FROM t GROUP BY ALL)"
CLAIMS = "claims AS (SELECT 'claim-' || n_nationkey AS id, CASE WHEN n_nationkey % 2 = 0 THEN 'txns' ELSE 'volume' END AS kind, (['7d', '30d', 'all'])[n_nationkey % 3 + 1] AS window_name, (n_nationkey * 1000 + 100)::VARCHAR AS claimed_value, n_nationkey AS nk FROM nation)"



def _page(direction: str, lens: str, column: str, offset: int, limit: int) -> str:
    """One page of every subject's list, from all of its counterparties."""
    return f"""SELECT subject, place, counterparty, label, txn_count, volume_usdc, share, first_seen, last_seen, total_counterparties FROM (
      SELECT *, row_number() OVER (PARTITION BY subject ORDER BY {column} DESC, counterparty) AS place, count(*) OVER (PARTITION BY subject) AS total_counterparties,
        coalesce(round(volume_usdc::DOUBLE / nullif(sum(volume_usdc) OVER (PARTITION BY subject), 0)::DOUBLE, 6), 0) AS share
      FROM ng WHERE direction = '{direction}' AND lens = '{lens}') LEFT JOIN labels ON labels.address = counterparty WHERE place > {offset} AND place <= {offset + limit}"""


# name -> (common table expressions after PAY, final select)
_QUERIES: dict[str, tuple[str, str]] = {
    "src4_payments": ("", "SELECT chain, tx_hash, log_index, day, payer, payee, facilitator, amount_usdc FROM p"),
    "src5_cancellations": (CANCELS, "SELECT tx_hash, authorizer, transaction_from, known AS facilitator_known, nonce FROM cm"),
    "src6_dimensions": ("", f"SELECT address, since_version, until_version FROM allow UNION ALL SELECT {_hex('d', 'r_regionkey + 5')}, 1, CASE WHEN r_regionkey = 1 THEN 2 END FROM region WHERE r_regionkey IN (0, 1)"),
    "src7_price_checks": (PRICES + ", odd AS (SELECT CASE WHEN dayofyear(week) % 5 = 0 THEN week + 1 ELSE week END AS w2, * FROM priced)", "SELECT w2::DATE::VARCHAR AS key, 'not a Monday' AS reason FROM odd WHERE isodow(w2) <> 1 UNION ALL SELECT w2::DATE::VARCHAR, 'not positive' FROM odd WHERE dayofyear(week) % 7 = 0 UNION ALL SELECT w2::DATE::VARCHAR, 'no citation' FROM odd WHERE dayofyear(week) % 11 = 0"),
    "src8_claim_checks": (CLAIMS + ", bc AS (SELECT CASE WHEN nk % 10 = 1 THEN 'claim-1' ELSE id END AS key, nk % 10 AS m FROM claims)", "SELECT key, 'bad source_url' AS reason FROM bc WHERE m = 2 UNION ALL SELECT key, 'no source_url' FROM bc WHERE m = 3 UNION ALL SELECT key, 'bad measured_metric' FROM bc WHERE m = 4 UNION ALL SELECT key, 'no lens' FROM bc WHERE m = 5 UNION ALL SELECT key, 'duplicate' FROM bc GROUP BY key HAVING count(*) > 1"),
    "src9_label_checks": (SIGNALS + ", sl AS (SELECT CASE WHEN source = 'manual' THEN 'other' ELSE 'base' END AS chain, CASE WHEN label LIKE '%7' THEN lower(label) ELSE address END AS a, CASE WHEN source = 'other' THEN '' ELSE label END AS label FROM signals)", "SELECT chain || ':' || a AS key, 'bad chain' AS reason FROM sl WHERE chain <> 'base' UNION ALL SELECT chain || ':' || a, 'bad address' FROM sl WHERE NOT regexp_full_match(a, '0x[0-9a-f]{40}') UNION ALL SELECT chain || ':' || a, 'no label' FROM sl WHERE label = '' UNION ALL SELECT chain || ':' || a, 'duplicate' FROM sl GROUP BY 1 HAVING count(*) > 1"),
    "snk7_replace_by_source": (SIGNALS, "SELECT address, source, label FROM signals WHERE source <> 'manual' UNION ALL SELECT address, 'manual', label FROM allow WHERE label IS NOT NULL"),
    "src3_selection": (EVENTS, "SELECT tx_hash AS transaction_hash, sum(CASE WHEN ok % 29 = 0 AND log_index = last THEN 1 ELSE 2 END)::BIGINT AS logs FROM e WHERE first_block BETWEEN 2000 AND 3000 GROUP BY 1"),
    "dec3_transfers": (EVENTS, "SELECT tx_hash AS transaction_hash, (log_index * 2 + 1)::INT AS log_index, CASE WHEN ok % 13 = 0 AND log_index = 2 THEN payee ELSE payer END AS sender, payee AS receiver, amount_raw::DECIMAL(38,0) AS value FROM e WHERE NOT (ok % 29 = 0 AND log_index = last)"),
    "dec4_authorizations": (EVENTS, "SELECT tx_hash AS transaction_hash, first_block AS block_number, (log_index * 2)::INT AS log_index, payer AS authorizer, auth_nonce AS nonce FROM e"),
    "dec6_calls": (EVENTS, "SELECT tx_hash AS transaction_hash, facilitator, CASE WHEN ok % 31 <> 0 THEN method_selector END AS method_selector, CASE WHEN ok % 31 <> 0 AND ok % 5 IN (2, 3) THEN 'receive' ELSE 'transfer' END AS settlement_kind, CASE WHEN ok % 31 <> 0 AND ok % 5 <> 4 THEN valid_after END AS valid_after, CASE WHEN ok % 31 <> 0 AND ok % 5 <> 4 THEN valid_before END AS valid_before, gas_used, gas_limit, gas_cost_wei::DECIMAL(38,0) AS gas_cost_wei, max_fee_per_gas::DECIMAL(38,0) AS max_fee_per_gas, l1_fee::DECIMAL(38,0) AS l1_fee FROM tx1"),
    "dec_rejects": (EVENTS, "SELECT 'log' AS kind, 'bad address' AS reason, count(*) AS n FROM e WHERE log_index = 2 HAVING count(*) > 0"),
    "dec1_wide_quantities": ("", "SELECT tx_hash, log_index, CASE WHEN amount_raw < 5421010862427522170 THEN (amount_raw::DECIMAL(19,0) * 18446744073709551616::DECIMAL(20,0))::DECIMAL(38,0) END AS shifted FROM p"),
    "pair2_assembled": (EVENTS, "SELECT tx_hash, (log_index * 2)::INT AS log_index, outcome, CASE WHEN outcome = 'kept' THEN payee END AS payee, CASE WHEN outcome = 'kept' THEN amount_usdc END AS amount_usdc FROM fate"),
    "pair5_stats": (EVENTS, f"SELECT {FATE_STATS} FROM fate"),
    "pair6_all_lost": (EVENTS, f"SELECT {FATE_STATS} FROM fate HAVING count(*) FILTER (outcome <> 'denied') > 0 AND count(*) FILTER (outcome = 'kept') = 0"),
    "agg1_wide_cube": (WIDE, "SELECT day, chain, facilitator, membership, methodology_version, txn_count, " + _bignum("s") + " AS volume_usdc, " + _bignum("list_transform(range(8), lambda i: ('0x' || substr(most, (1 + 8 * i)::INT, 8))::BIGINT)") + " AS max_amount_usdc FROM wsum"),
    "cls8_sql_functions": ("", f"SELECT {BAND} AS band, {_steps_to('n', ENTITIES_TO, '100000+')} AS payments_of_payer, {_steps_to('lines', BATCHES_TO, '100+')} AS batch, membership, count(*) AS txn_count FROM (SELECT *, count(*) OVER (PARTITION BY payer) AS n, count(*) OVER (PARTITION BY tx_hash) AS lines FROM p) GROUP BY ALL"),
    "set4_every_version": ("", f"SELECT day, 'base' AS chain, facilitator, CASE WHEN EXISTS (SELECT 1 FROM allow WHERE address = facilitator AND since_version <= v AND (until_version IS NULL OR until_version > v)) THEN 'known' ELSE 'unknown' END AS membership, {BAND} AS band, v AS methodology_version, count(*) AS txn_count, sum(amount_usdc) AS volume_usdc, max(amount_usdc) AS max_amount_usdc FROM p, (SELECT since_version AS v FROM allow UNION SELECT until_version FROM allow WHERE until_version IS NOT NULL) GROUP BY ALL"),
    "pair4_fates": (QUARANTINE, "SELECT count(*) AS auth_logs, " + ", ".join(f"count(*) FILTER (reason IS NULL AND outcome = '{o}') AS {o}" for o in ("denied", "kept", "dropped")) + ", count(reason) AS quarantined FROM q"),
    "pair4_quarantine_reasons": (QUARANTINE, "SELECT reason, count(*) AS auth_logs FROM q WHERE reason IS NOT NULL GROUP BY 1"),
    "pair4_spoiled_payments": (QUARANTINE, "SELECT tx_hash, (log_index * 2)::INT AS log_index, amount_usdc, gas_cost_wei::DECIMAL(38,0) AS gas_cost_wei FROM q WHERE reason IS NULL AND outcome = 'kept'"),
    "dec12_self_settled": (QUARANTINE, "SELECT CASE WHEN ok % 2 = 0 THEN first_payee ELSE facilitator END = payee AS self_settled, settlement_kind, count(*) AS n FROM q WHERE outcome = 'kept' GROUP BY 1, 2"),
    "str4_covered_blocks": ("", "SELECT supplier, min(b) AS from_block, max(b) + 1 AS to_block FROM (SELECT supplier, b, b - row_number() OVER (PARTITION BY supplier ORDER BY b) AS island FROM (SELECT DISTINCT l_suppkey AS supplier, unnest(range(a, a + l_orderkey % 8)) AS b FROM (SELECT *, l_shipdate::DATE - DATE '1992-01-01' AS a FROM lineitem))) GROUP BY supplier, island"),
    "pair9_probe": (EVENTS, "SELECT CASE WHEN ok % 31 <> 0 THEN method_selector END AS method_selector, count(*) AS auth_logs, count(*) FILTER (outcome = 'kept') AS matched FROM fate GROUP BY 1"),
    "pair7_cancellations": (CANCELS, "SELECT 'base' AS chain, c.tx_hash, 0 AS log_index, authorizer, transaction_from, nonce, event_id AS block_number, date_trunc('second', block_time) AS block_time FROM c JOIN (SELECT event_id, '0x' || lpad(lower(to_hex(event_id)), 64, '0') AS tx_hash FROM events WHERE event_type = 'error') e USING (tx_hash) WHERE event_id % 17 <> 0 AND event_id % 19 <> 0"),
    "pair9_probe_report": (EVENTS, "SELECT sum(CASE WHEN ok % 29 = 0 AND log_index = last THEN 1 ELSE 2 END)::BIGINT AS total_logs, count(*) AS auth_logs, count(*) AS with_transaction, count(*) FILTER (ok % 31 <> 0) AS matched, count(DISTINCT method_selector) FILTER (ok % 31 <> 0) AS selectors, round(count(*) FILTER (ok % 31 <> 0 AND method_selector <> '82ad56cb') / count(*), 6) AS coverage, max(first_block) AS last_block FROM e"),
    "dec14_payment_rows": (EVENTS, f"SELECT tx_hash, (log_index * 2)::INT AS log_index, '{SOURCE}' AS source, '{PROTOCOL}' AS protocol, '{TOKEN}' AS token_address, {DECIMALS} AS token_decimals, 'USDC' AS token_symbol, 0::BIGINT AS tx_nonce, price::DECIMAL(38,0) AS effective_gas_price, (first_block * 1000)::DECIMAL(38,0) AS base_fee_per_gas, '0x' || lpad(lower(to_hex(first_block)), 64, '0') AS block_hash, 0 AS transaction_index, (gas_used % 1000)::DECIMAL(38,0) AS l1_gas_used, (gas_used % 77)::DECIMAL(38,0) AS l1_gas_price, 394 AS calldata_chars, lpad(lower(to_hex(amount_raw)), 64, '0') AS value_hex FROM fate WHERE outcome = 'kept'"),
    "dec15_contract_labels": ("", "SELECT contract, CASE log_index % 3 WHEN 0 THEN 'USDC · Circle' WHEN 1 THEN 'Multicall3' END AS label, count(*) AS n FROM (SELECT log_index, CASE log_index % 3 WHEN 0 THEN '0x833589fcd6edb6e08f4c7c32d4f71b54bda02913' WHEN 1 THEN upper('0xca11bde05977b3631167028862be2a173976ca11') ELSE called_contract END AS contract FROM p) GROUP BY ALL"),
    "dq14_spoiled_stats": (EVENTS, "SELECT 'stats_add_up' AS \"check\", count(*) || '|' || count(*) FILTER (outcome = 'denied') || '|' || (count(*) FILTER (outcome = 'kept') + 1) || '|' || count(*) FILTER (outcome = 'dropped') AS detail FROM fate"),
    "cls2_membership": ("", "SELECT facilitator, known AS facilitator_known, 1 AS methodology_version, count(*) AS n FROM p GROUP BY ALL"),
    "cls1_version_2": ("", "SELECT facilitator, facilitator IN (SELECT address FROM allow WHERE since_version <= 2 AND (until_version IS NULL OR until_version > 2)) AS facilitator_known, count(*) AS n FROM p GROUP BY ALL"),
    "cls3_attribution": ("", "SELECT CASE WHEN ok % 7 IN (5, 6) THEN 'contamination' WHEN known THEN 'agentic' ELSE 'contested' END AS attribution, count(*) AS n, sum(amount_usdc) AS volume_usdc FROM p GROUP BY 1"),
    "cls5_identities": (SIGNALS, "SELECT address, source, label FROM labels"),
    "cls7_bands": ("", f"SELECT {BAND} AS band, count(*) AS n FROM p GROUP BY 1"),
    "gr14_query_kinds": ("", "SELECT unnest(['address', 'tx', NULL]) AS kind, (SELECT count(*) FROM p) AS n"),
    "agg1_daily_cube": (CUBE, "SELECT * FROM cube"),
    "agg2_attribution_cube": ("", f"SELECT day, chain, facilitator, CASE WHEN ok % 7 IN (5, 6) THEN 'contamination' WHEN known THEN 'agentic' ELSE 'contested' END AS attribution, {BAND} AS band, 1 AS methodology_version, count(*) AS txn_count, sum(amount_usdc) AS volume_usdc, max(amount_usdc) AS max_amount_usdc FROM p GROUP BY ALL"),
    "agg3_window_stats": (f"{SM}, {STATS}", "SELECT * FROM stats"),
    "agg4_price_points": (f"{KW}, {POINTS}", "SELECT * FROM points"),
    "agg5_price_breadth": (f"{KW}, {POINTS}, {BREADTH}", "SELECT * FROM breadth"),
    "agg6_transactions": ("", "SELECT chain, tx_hash, count(*) AS n, max(gas_cost_wei) AS gas_cost_wei, max(coalesce(l1_fee, 0)) AS l1_fee FROM p GROUP BY ALL"),
    "agg7_gas_daily": (f"{PRICES}, {GAS}", "SELECT day, membership, band, txn_count, round(l2 / 1e18, 6) AS l2_eth, round(l1 / 1e18, 6) AS l1_eth, round(usd::DOUBLE, 4) AS cost_usd, breakeven_count, volume_usdc FROM gas"),
    "agg8_active_entities": ("", "SELECT day, count(DISTINCT payer) AS active_payers, count(DISTINCT payee) AS active_payees, day <> (SELECT d FROM ak) AS complete FROM k GROUP BY day"),
    "agg9_velocity": (TICKS, "SELECT * FROM vel"),
    "pg9_velocity_windows": (TICKS, "SELECT w.window_name, max(max_per_minute) AS max_per_minute FROM vel, w WHERE membership = 'known' AND (days = 0 OR day >= (SELECT max(day) FROM vel WHERE membership = 'known') - (days - 1)) GROUP BY 1"),
    "agg10_payer_cohorts": (COHORTS, "SELECT * FROM cohorts"),
    "agg11_entity_aggregate": (f"{PW}, {KA}, {AGG}", "SELECT * FROM agg"),
    "agg12_entity_rank": (f"{PW}, {KA}, {AGG}", "SELECT * EXCLUDE (rv, rt) FROM ranked WHERE rv <= 150 OR rt <= 150"),
    "agg13_entity_buckets": (f"{PW}, {KA}, {AGG}", "SELECT window_name, role, CASE WHEN txn_count <= 1 THEN '1' WHEN txn_count <= 10 THEN '2-10' WHEN txn_count <= 100 THEN '11-100' WHEN txn_count <= 1000 THEN '101-1000' WHEN txn_count <= 100000 THEN '1001-100000' ELSE '100000+' END AS bucket, count(*) AS entity_count, sum(txn_count)::BIGINT AS txn_sum, sum(volume_usdc) AS volume_sum FROM agg GROUP BY ALL"),
    "agg14_concentration": (f"{PW}, {KA}, {AGG}, {CONC}", "SELECT * FROM conc"),
    "agg15_reliability_windows": (f"{PW}, {CANCELS}, {LAT}, {REL}", "SELECT * FROM relw"),
    "agg17_reliability_daily": (f"{CANCELS}, {RELD}", "SELECT * FROM reld"),
    "agg19_mechanics_windows": (f"{PW}, {MECH}", "SELECT * FROM mech"),
    "agg20_hygiene": ("", "SELECT count(*) - count(DISTINCT (payer, auth_nonce)) AS nonce_reuse, count(*) - count(DISTINCT (payer, auth_nonce, block_number)) AS nonce_reuse_in_block FROM k"),
    "agg20_in_windows": (PW, "SELECT window_name, membership, CASE WHEN window_name = 'all' AND membership = 'known' THEN (SELECT count(*) - count(DISTINCT (payer, auth_nonce)) FROM k) END AS nonce_reuse, CASE WHEN window_name = 'all' AND membership = 'known' THEN (SELECT count(*) - count(DISTINCT (payer, auth_nonce, block_number)) FROM k) END AS nonce_reuse_in_block FROM (SELECT DISTINCT window_name, membership FROM pm)"),
    "agg21_batches": (f"{PW}, {KA}, {BATCH}", "SELECT batch.*, (SELECT max(n) FROM bt WHERE bt.window_name = batch.window_name) AS max_batch_size FROM batch"),
    "agg22_blocks": (f"{PW}, {KA}, bl AS (SELECT window_name, block_number, count(*) AS n FROM ka GROUP BY ALL)", "SELECT window_name, max(n) AS max_per_block, quantile_disc(n, 0.99)::BIGINT AS p99_per_block, round(avg(n), 6) AS mean_per_block, count(*) AS distinct_blocks FROM bl GROUP BY 1"),
    "agg23_selectors": (f"{PW}, {SEL}", "SELECT * FROM sel"),
    "agg24_status": ("", "SELECT count(*) AS payments, count(*) FILTER (block_timestamp > TIMESTAMP '2001-10-31') AS last_day, count(*) FILTER (block_timestamp > TIMESTAMP '2001-10-25') AS last_week, count(DISTINCT facilitator) AS facilitators, max(block_number) AS max_block FROM p"),
    "pg2_window_economy": (ECONOMY, "SELECT * FROM economy"),
    "pg3_daily_series": (SERIES, "SELECT * FROM ser"),
    "pg4_monthly_series": (MONTHS, "SELECT * FROM months"),
    "pg5_typical_payment": (f"{SM}, {STATS}, {KW}", "SELECT s.window_name, round(v::DOUBLE / n, 6) AS mean_usdc, median_amount_usdc, p10_amount_usdc, p90_amount_usdc, p99_amount_usdc, m AS largest_usdc, round(round(v::DOUBLE / n, 6) / median_amount_usdc::DOUBLE, 4) AS mean_to_median FROM stats s JOIN (SELECT window_name, sum(amount_usdc) AS v, count(*) AS n, max(amount_usdc) AS m FROM kw GROUP BY 1) t USING (window_name) WHERE membership = 'known'"),
    "pg6_price_point_shares": (f"{KW}, {POINTS}", "SELECT points.*, round(txn_count * 100.0::DOUBLE / (SELECT count(*) FROM kw WHERE kw.window_name = points.window_name), 2) AS pct_of_txns FROM points"),
    "pg7_gas_windows": (f"{PRICES}, {GAS}, {GASW}", "SELECT * FROM gaswin"),
    "pg8_cost_per_dollar": (f"{PRICES}, {GAS}", "SELECT day, round(sum(usd)::DOUBLE * 100 / sum(volume_usdc)::DOUBLE, 4) AS cents_per_dollar, day <> (SELECT d FROM ak) AS complete FROM gas WHERE membership = 'known' GROUP BY day HAVING sum(volume_usdc) > 0"),
    "pg10_excluded": ("", "SELECT count(*) AS txn_count, coalesce(sum(amount_usdc), 0)::DECIMAL(38,6) AS volume_usdc FROM p WHERE NOT known"),
    "pg13_price_breadth_series": (f"{KW}, {POINTS}, {BREADTH}", "SELECT b.amount_usdc, b.day, b.payee_count, rank, CASE WHEN points.payee_count < 1000 THEN 'menu' WHEN points.payee_count >= 5000 THEN 'market' ELSE 'mixed' END AS market, day <> (SELECT max(day) FROM breadth) AS complete FROM breadth b JOIN points ON points.amount_usdc = b.amount_usdc AND window_name = 'all'"),
    "pg14_facilitators": ("", "SELECT chain, facilitator, count(*) AS txns_all, sum(amount_usdc) AS volume_all, count(*) FILTER (day >= d - 6) AS txns_7d, coalesce(sum(amount_usdc) FILTER (day >= d - 6), 0)::DECIMAL(38,6) AS volume_7d, count(*) FILTER (day >= d - 29) AS txns_30d, coalesce(sum(amount_usdc) FILTER (day >= d - 29), 0)::DECIMAL(38,6) AS volume_30d FROM k, ak GROUP BY 1, 2"),
    "pg17_reliability_rates": (f"{PW}, {CANCELS}, {LAT}, {REL}, tm AS (SELECT *, lat_bucket_sub1s + lat_bucket_1_10s + lat_bucket_10_60s + lat_bucket_1_10m + lat_bucket_gt10m AS t FROM relw)", "SELECT window_name, membership, coalesce(round(windowed_count / nullif(settlement_count, 0), 6), 0) AS windowed_share, coalesce(round(expired_count / nullif(windowed_count, 0), 6), 0) AS expired_rate, coalesce(round(not_yet_valid_count / nullif(windowed_count, 0), 6), 0) AS not_yet_valid_rate, coalesce(round(cancellation_count / nullif(settlement_count + cancellation_count, 0), 6), 0) AS cancellation_rate, " + ", ".join(f"coalesce(round(lat_bucket_{b} / nullif(t, 0), 6), 0) AS share_{b}" for b in ("sub1s", "1_10s", "10_60s", "1_10m", "gt10m")) + " FROM tm"),
    "pg18_reliability_series": (f"{CANCELS}, {RELD}", "SELECT day, sum(settlement_count)::BIGINT AS settlement_count, sum(windowed_count)::BIGINT AS windowed_count, sum(expired_count)::BIGINT AS expired_count, sum(not_yet_valid_count)::BIGINT AS not_yet_valid_count, sum(cancellation_count)::BIGINT AS cancellation_count FROM reld WHERE membership = 'known' GROUP BY day"),
    "pg19_batch_shares": (f"{PW}, {KA}, {BATCH}, every AS (SELECT window_name, (i - 1)::INT AS bucket_order, (['1', '2-10', '11-100', '100+'])[i] AS batch_bucket FROM (SELECT DISTINCT window_name FROM batch), range(1, 5) r(i))", "SELECT window_name, batch_bucket, bucket_order, coalesce(tx_count, 0) AS tx_count, coalesce(payment_count, 0) AS payment_count, coalesce(round((coalesce(sum(payment_count) FILTER (batch_bucket <> '1') OVER x, 0) * 100)::DOUBLE / (sum(payment_count) OVER x)::DOUBLE, 2), 0) AS pct_batched FROM every LEFT JOIN batch USING (window_name, batch_bucket) WINDOW x AS (PARTITION BY window_name)"),
    "pg21_claims": (f"{ECONOMY}, {CLAIMS}, tot AS (SELECT 'txns' AS kind, window_name, txn_count::DOUBLE AS measured FROM economy WHERE band = 'all' UNION ALL SELECT 'volume', window_name, volume_usdc::DOUBLE FROM economy WHERE band = 'all'), r AS (SELECT *, round(claimed_value::DOUBLE / nullif(measured, 0), 6) AS ratio FROM claims LEFT JOIN tot USING (kind, window_name))", "SELECT id, kind, window_name, claimed_value, measured, CASE WHEN kind = 'txns' THEN 'payments' ELSE 'USDC' END AS unit, ratio, CASE WHEN ratio IS NULL THEN 'unmeasured' WHEN ratio >= 1.5 THEN 'overstated' WHEN ratio < 0.9 THEN 'understated' ELSE 'consistent' END AS verdict FROM r"),
    "pg22_stamp": ("", "SELECT max(day) AS max_day, (SELECT d FROM ak) AS data_through_day, 1::BIGINT AS versions, 1 AS methodology_version FROM p"),
    "dec15_named_selectors": (f"{PW}, {SEL}", "SELECT window_name, membership, rank, selector_hex, CASE WHEN selector_hex IN ('e3ee160e', 'cf092995') THEN 'transferWithAuthorization' WHEN selector_hex IN ('ef55bec6', '88b7ab63') THEN 'receiveWithAuthorization' ELSE 'aggregate3' END AS method, CASE WHEN selector_hex = '82ad56cb' THEN 'wrapper' ELSE 'direct' END AS method_kind FROM sel"),
    "top7_cancellation_attribution": (CANCELS, "(SELECT authorizer AS address, count(*) AS cancellations, max(block_time) AS last_seen, bool_or(authorizer = transaction_from) AS own, 'authorizer' AS side FROM cm WHERE known GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 100) UNION ALL (SELECT transaction_from, count(*), max(block_time), bool_or(authorizer = transaction_from), 'transaction_from' FROM cm WHERE known GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 100)"),
    "set1_missing_weeks": (PRICES, "SELECT count(*) AS weeks, coalesce(string_agg(week::VARCHAR, ',' ORDER BY week), '') AS missing FROM (SELECT DISTINCT date_trunc('week', block_timestamp)::DATE AS week FROM p) WHERE week NOT IN (SELECT week FROM prices WHERE dayofyear(week) % 9 <> 0)"),
    "set4_versions": ("", "SELECT v AS methodology_version, CASE WHEN facilitator IN (SELECT address FROM allow WHERE since_version <= v AND (until_version IS NULL OR until_version > v)) THEN 'known' ELSE 'unknown' END AS membership, count(*) AS txn_count, (SELECT count(DISTINCT x) FROM (VALUES (1), (2)) y(x))::BIGINT AS versions FROM p, (VALUES (1), (2)) w2(v) GROUP BY 1, 2"),
    "cl1_trailing": (SERIES, "SELECT * FROM ser ORDER BY day DESC LIMIT 30"),
    "cl2_moving_average": (SERIES, "SELECT day, round(CASE WHEN complete THEN avg(txn_count) OVER (PARTITION BY complete ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) ELSE txn_count END::DOUBLE, 6) AS ma7 FROM ser"),
    "cl3_month_over_month": (MONTHS, "SELECT *, CASE WHEN complete AND lag(complete) OVER (ORDER BY month) AND lag(volume_usdc) OVER (ORDER BY month) > 0 THEN round(volume_usdc::DOUBLE / (lag(volume_usdc) OVER (ORDER BY month))::DOUBLE - 1, 6) END AS change FROM months"),
    "cl4_peak_and_median": (SERIES, "SELECT (SELECT day FROM ser WHERE complete ORDER BY txn_count DESC, day LIMIT 1) AS peak_day, (SELECT max(txn_count) FROM ser WHERE complete) AS peak_value, (SELECT list_sort(list(txn_count))[count(*) // 2 + 1] FROM ser) AS upper_median, (SELECT max(day) FROM ser WHERE complete) AS last_complete_day"),
    "cl6_momentum": (ECONOMY, "SELECT round((SELECT volume_usdc::DOUBLE / 7 FROM economy WHERE band = 'all' AND window_name = '7d') / (SELECT volume_usdc::DOUBLE / 30 FROM economy WHERE band = 'all' AND window_name = '30d'), 6) AS momentum"),
    "cl9_dense_bands": (f"{ECONOMY}, every AS (SELECT DISTINCT window_name, b.band FROM economy, (VALUES ('dust'), ('micro'), ('small'), ('mid'), ('whale')) b(band)), full_ AS (SELECT window_name, band, coalesce(txn_count, 0) AS txn_count, coalesce(volume_usdc, 0)::DECIMAL(38,6) AS volume_usdc FROM every LEFT JOIN economy USING (window_name, band))", "SELECT *, round(txn_count / sum(txn_count) OVER x, 6) AS txn_share, round(volume_usdc::DOUBLE / (sum(volume_usdc) OVER x)::DOUBLE, 6) AS volume_share FROM full_ WINDOW x AS (PARTITION BY window_name)"),
    "cl11_other_types": (f"{PW}", "SELECT window_name, membership, count(*) FILTER (tx_type NOT IN (0, 1, 2)) AS other_count FROM pm GROUP BY ALL"),
    "cl12_cohort_shares": (COHORTS, "SELECT window_name, round(new_payer_volume_usdc::DOUBLE / (new_payer_volume_usdc + returning_payer_volume_usdc)::DOUBLE, 6) AS new_share, round(returning_payer_volume_usdc::DOUBLE / (new_payer_volume_usdc + returning_payer_volume_usdc)::DOUBLE, 6) AS returning_share FROM cohorts"),
    "cl14_breadth_trend": (f"{KW}, {POINTS}, {BREADTH}, tr AS (SELECT amount_usdc, arg_min(payee_count, day) AS first, arg_max(payee_count, day) AS last FROM breadth WHERE day <> (SELECT max(day) FROM breadth) GROUP BY 1)", "SELECT *, CASE WHEN last > first * 1.2 THEN 'widening' WHEN last < first * 0.8 THEN 'narrowing' ELSE 'flat' END AS trend FROM tr"),
    "cl15_concentration_shares": (f"{PW}, {KA}, {AGG}, {CONC}", "SELECT window_name, role, round(top10_volume::DOUBLE / total_volume::DOUBLE, 6) AS top10_share, round(top100_volume::DOUBLE / total_volume::DOUBLE, 6) AS top100_share, round(top10_txns / total_txns, 6) AS top10_txn_share FROM conc"),
    "cl15_breakeven_share": (f"{PRICES}, {GAS}, {GASW}", "SELECT window_name, band, round(breakeven_count * 100 / txn_count, 2) AS pct_below_cost FROM gaswin"),
    "cl17_dust_sinks": (f"{PW}, {KA}, {AGG}", f"SELECT address, txn_count, volume_usdc FROM ranked WHERE (rv <= 150 OR rt <= 150) AND window_name = 'all' AND role = 'payee' AND {CLASS} = 'sink' ORDER BY txn_count DESC, address LIMIT 20"),
    "cl19_role_order": (f"{DAYS}, s AS (SELECT address, role, sum(txn_count)::BIGINT AS txn_count FROM days GROUP BY ALL)", "SELECT address, role, row_number() OVER (PARTITION BY address ORDER BY txn_count DESC, role) AS role_rank, txn_count, CASE WHEN bool_or(role = 'payer') OVER (PARTITION BY address) THEN 'payer' WHEN bool_or(role = 'payee') OVER (PARTITION BY address) THEN 'payee' ELSE 'facilitator' END AS primary_role FROM s"),
    "ent1_edges": (EDGE, "SELECT * FROM edge"),
    "ent2_facilitator_edges": (FEDGE, "SELECT * FROM fedge"),
    "ent3_entity_days": (DAYS, "SELECT * FROM days"),
    "ent4_entity_price_points": (f"{TRIPLE}, {EPP}", "SELECT * FROM epp"),
    "ent5_leaderboard": (f"{PW}, {BOARD}", "SELECT * FROM board"),
    "top5_leaderboard_page": (f"{PW}, {BOARD}, {SIGNALS}", "SELECT address, row_number() OVER (ORDER BY distinct_counterparties DESC, address) AS rank, distinct_counterparties, label FROM board LEFT JOIN labels USING (address) WHERE window_name = 'all' AND role = 'payee' AND lens = 'known' ORDER BY rank LIMIT 500"),
    "ent6_entity_summary": (DAYS, "SELECT address, role, lens, sum(txn_count)::BIGINT AS txn_count, count(DISTINCT day) AS active_days, min(day) AS first_day, max(day) AS last_day, sum(volume_usdc) AS volume_usdc FROM dl GROUP BY ALL"),
    "ent7_counterparties": (f"{EDGE}, {FEDGE}, {PAIRS}", "SELECT address, role, lens, count(DISTINCT other) AS distinct_counterparties FROM prl GROUP BY ALL"),
    "ent8_dataset_totals": (DAYS, "SELECT lens, sum(txn_count)::BIGINT AS txn_count, sum(volume_usdc) AS volume_usdc, count(DISTINCT address) AS payers, max(day) AS max_day FROM dl WHERE role = 'payer' GROUP BY lens"),
    "ent9_headers": (f"{DAYS}, {SIGNALS}, rl AS (SELECT address, count(DISTINCT (role, lens)) AS n_roles FROM dl GROUP BY 1), sg AS (SELECT address, count(*) AS n_signals FROM signals GROUP BY 1)", "SELECT address, n_roles::INT AS n_roles, n_signals::INT AS n_signals, label FROM rl FULL JOIN sg USING (address) LEFT JOIN labels USING (address)"),
    "ent9_header_roles": (f"{DAYS}, {EDGE}, {FEDGE}, {PAIRS}, sm AS (SELECT address, role, lens, sum(txn_count)::BIGINT AS txn_count, count(DISTINCT day) AS active_days, sum(volume_usdc) AS volume_usdc FROM dl GROUP BY ALL), oc AS (SELECT address, role, lens, count(DISTINCT other) AS distinct_counterparties FROM prl GROUP BY ALL)", "SELECT * FROM sm LEFT JOIN oc USING (address, role, lens)"),
    "ent9_header_signals": (SIGNALS, "SELECT address, source, label FROM signals"),
    "gr2_densified": (f"{DAYS}, x AS (SELECT address, role, lens, day, sum(txn_count)::BIGINT AS n, sum(volume_usdc) AS v FROM dl GROUP BY ALL), span AS (SELECT address, role, lens, generate_series(min(day), max(day), INTERVAL 1 DAY) AS r FROM x GROUP BY ALL), every AS (SELECT address, role, lens, unnest(r)::DATE AS day FROM span)", "SELECT address, role, lens, day, coalesce(n, 0) AS txn_count, coalesce(v, 0)::DECIMAL(38,6) AS volume_usdc FROM every LEFT JOIN x USING (address, role, lens, day)"),
    "gr3_cadence": (f"{DAYS}, {CAD}", "SELECT * FROM cad"),
    "gr4_merged_price_points": (f"{TRIPLE}, {EPP}, {MPP}", "SELECT * FROM mpp"),
    "gr5_counterparty_concentration": (f"{EDGE}, {FEDGE}, {PAIRS}, {TOP}", "SELECT * FROM top"),
    "gr6_fingerprints": (f"{DAYS}, {EPP}, {MPP}, {CAD}, {EDGE}, {FEDGE}, {PAIRS}, {TOP}, pl AS (SELECT address, role, lens, count(*)::INT AS n_price_points, arg_min(amount_usdc, rank) AS first_amount, max(total_distinct_amounts) AS distinct_amounts FROM mpp GROUP BY ALL)", "SELECT address, role, lens, active_days, span_days, n_price_points, first_amount, distinct_amounts, top1_share FROM cad LEFT JOIN pl USING (address, role, lens) LEFT JOIN top USING (address, role, lens)"),
    "gr6_fingerprint_points": (f"{TRIPLE}, {EPP}, {MPP}", "SELECT address, role, lens, rank, amount_usdc, txn_count FROM mpp"),
    "gr7_neighbors": (f"{EDGE}, {FEDGE}, {NEAR}", "SELECT * FROM near"),
    "top4_counterparty_page": (f"{EDGE}, {FEDGE}, {NEAR}, {SIGNALS}", _page("payers", "all", "txn_count", 40, 50)),
    "top4_by_volume": (f"{EDGE}, {FEDGE}, {NEAR}, {SIGNALS}", _page("settled_payees", "known", "volume_usdc", 5, 50)),
    "top4_by_last_seen": (f"{EDGE}, {FEDGE}, {NEAR}, {SIGNALS}", _page("payees", "all", "last_seen", 0, 50)),
    "top6_payment_page": ("", "SELECT block_number, tx_hash, log_index, payer, payee, amount_usdc FROM p WHERE block_number < 3000 ORDER BY block_number DESC, tx_hash DESC, log_index DESC LIMIT 101"),
    "gr10_classes": (f"{PW}, {KA}, {AGG}", f"SELECT window_name, role, address, {CLASS} AS behavior FROM ranked WHERE rv <= 150 OR rt <= 150"),
    "gr11_class_counts": (f"{PW}, {KA}, {AGG}, cl AS (SELECT window_name, role, {CLASS} AS behavior, volume_usdc FROM ranked WHERE rv <= 150 OR rt <= 150), every AS (SELECT DISTINCT window_name, role, b.behavior FROM cl, (VALUES ('otc'), ('sink'), ('fleet'), ('service'), ('tail')) b(behavior))", "SELECT window_name, role, behavior, count(volume_usdc) AS entities, coalesce(sum(volume_usdc), 0)::DECIMAL(38,6) AS volume_usdc FROM every LEFT JOIN cl USING (window_name, role, behavior) GROUP BY ALL"),
    "gr12_ghosts": (f"{EDGE}, {FEDGE}, {NEAR}", "SELECT direction, subject, counterparty, volume_usdc, row_number() OVER (PARTITION BY direction, subject ORDER BY volume_usdc DESC, counterparty) AS place FROM near WHERE lens = 'all' AND (direction, subject, counterparty) NOT IN (SELECT (direction, subject, counterparty) FROM near WHERE lens = 'known') QUALIFY place <= 10"),
    "gr13_primary_edges": (f"{EDGE}, {FEDGE}, {NEAR}", "SELECT subject, direction, counterparty, share FROM near WHERE lens = 'known' QUALIFY row_number() OVER (PARTITION BY subject ORDER BY share DESC, direction, counterparty) = 1"),
    "gr9_transactions": ("", "SELECT chain, tx_hash, count(*) AS events, sum(amount_usdc) AS paid_total, bool_or(payee = facilitator) AS self_settled, count(*) = 1 AND bool_and(method_selector <> '82ad56cb') AS decodable, count(*) > 128 AS truncated FROM p GROUP BY 1, 2"),
    "gr9_nodes": (GRAPH, "SELECT DISTINCT tx_hash, tx_hash AS id, 'tx' AS kind, NULL AS roles FROM p UNION ALL SELECT tx_hash, event_id, 'event', NULL FROM gd UNION ALL SELECT tx_hash, id, 'address', string_agg(DISTINCT r, ',' ORDER BY r) FROM (SELECT tx_hash, payer AS id, 'payer' AS r FROM gd UNION ALL SELECT tx_hash, payee, 'payee' FROM gd UNION ALL SELECT tx_hash, facilitator, 'facilitator' FROM gd) GROUP BY 1, 2"),
    "gr9_edges": (GRAPH, "SELECT tx_hash, kind, from_id, to_id FROM links"),
    "dq_violations": ("", EMPTY_CHECK),
    "dq1_spoiled_bands": ("", "SELECT 'bands_equal_windows' AS \"check\", '30d' AS detail WHERE EXISTS (SELECT 1 FROM k, ak WHERE day >= d - 29 AND amount_usdc >= 100 AND amount_usdc < 1000)"),
    "dq13_spoiled_classification": ("", "SELECT 'classification_keeps_rows' AS \"check\", count(*) || '|' || count(*) FILTER (known) AS detail FROM p HAVING count(*) <> count(*) FILTER (known)"),
    "dq3_spoiled_concentration": (f"{PW}, {KA}, {AGG}, {CONC}", "SELECT 'concentration_equals_economy' AS \"check\", role AS detail FROM conc WHERE window_name = 'all' AND (total_txns + CASE WHEN role = 'payer' THEN 1 ELSE 0 END <> (SELECT count(*) FROM k) OR total_volume <> (SELECT sum(amount_usdc) FROM k))"),
    "dq5_spoiled_settlements": ("", "SELECT 'settlements_equal_economy' AS \"check\", count(*) FILTER (day > DATE '1995-01-01') || '|' || count(*) AS detail FROM k HAVING count(*) FILTER (day > DATE '1995-01-01') <> count(*)"),
    "dq6_spoiled_batches": (f"{PW}, {KA}, {BATCH}", "SELECT 'batches_equal_settlements' AS \"check\", window_name AS detail FROM batch GROUP BY window_name HAVING sum(payment_count) FILTER (batch_bucket <> '1') IS NULL OR sum(payment_count) FILTER (batch_bucket <> '1') <> sum(payment_count)"),
    "dq8_spoiled_days": ("", "SELECT DISTINCT 'days_equal_view' AS \"check\", 'payee|' || known::VARCHAR AS detail FROM p"),
    "dq8_spoiled_edges": (EDGE, "SELECT 'edges_equal_view' AS \"check\", 'false' AS detail WHERE EXISTS (SELECT 1 FROM edge WHERE NOT facilitator_known AND txn_count = 1) UNION ALL SELECT DISTINCT 'facilitator_edges_equal_view', 'payer|true' FROM k"),
    "dq9_spoiled_gas": (f"{PRICES}, {GAS}", f"SELECT unnest(['l2_conservation', 'l1_conservation']) AS \"check\", unnest([round(sum(g::DOUBLE / n) / 1e15, 3), round(sum(l::DOUBLE / n) / 1e15, 3)]) AS drift FROM cost WHERE {BAND} = 'mid'"),
    "dq2_spoiled_buckets": (f"{PW}, {KA}, {AGG}", "SELECT 'buckets_equal_concentration' AS \"check\", 'all|payee' AS detail WHERE EXISTS (SELECT 1 FROM agg WHERE window_name = 'all' AND role = 'payee' AND txn_count > 1)"),
    "dq4_spoiled_reliability": (PW, "SELECT DISTINCT 'reliability_consistent' AS \"check\", window_name || '|all' AS detail FROM pw"),
    "dq7_spoiled_cube": ("", "SELECT 'cube_equals_view' AS \"check\", 'unknown' AS detail WHERE EXISTS (SELECT 1 FROM p WHERE NOT known AND amount_usdc >= 1000)"),
    "dq11_spoiled_publication": ("", "SELECT DISTINCT 'known_only' AS \"check\", facilitator AS detail FROM p WHERE NOT known"),
    "dq12_finite": (f"{PRICES}, {GAS}, {GASW}", "SELECT 'finite' AS \"check\", 'NaN|' || txn_count::VARCHAR AS detail FROM gaswin WHERE band = 'mid'"),
    "pg23_as_of": ("", "SELECT 'ends_with_the_data' AS \"check\", d::VARCHAR AS detail FROM ak"),
    "gr1_timeline": (DAYS, "SELECT address, role, lens, day, sum(txn_count)::BIGINT AS txn_count, sum(volume_usdc) AS volume_usdc FROM dl GROUP BY ALL"),
    "gr8_entity_payments": (f"{TRIPLE}, {GR8}", "SELECT chain, address, role, place, block_number, tx_hash, log_index, counterparty, amount_usdc FROM placed WHERE place <= 50"),
    "gr8_next_page": (f"{TRIPLE}, {GR8}", "SELECT chain, address, role, place - 50 AS place, block_number, tx_hash, log_index, counterparty, amount_usdc FROM placed WHERE place > 50 AND place <= 100"),
    "pg15_entity_pages": (f"{PW}, {KA}, {AGG}", "SELECT window_name, role, count(*) FILTER (rv <= 150 OR rt <= 150)::INT AS rows, (SELECT address FROM ranked r WHERE r.window_name = ranked.window_name AND r.role = ranked.role ORDER BY txn_count DESC, address LIMIT 1) AS first, count(DISTINCT CASE WHEN txn_count <= 1 THEN 0 WHEN txn_count <= 10 THEN 1 WHEN txn_count <= 100 THEN 2 WHEN txn_count <= 1000 THEN 3 WHEN txn_count <= 100000 THEN 4 ELSE 5 END)::INT AS buckets, count(*) AS total_entities FROM ranked GROUP BY window_name, role"),
    "pg15_entity_page_rows": (f"{PW}, {KA}, {AGG}", "SELECT window_name, role, address, txn_count, volume_usdc, distinct_counterparties, distinct_amounts FROM ranked WHERE rv <= 150 OR rt <= 150"),
    "cl13_units": ("", "SELECT tx_hash, round(max(gas_cost_wei)::DOUBLE / 1e18, 6) AS eth, round(max(max_fee_per_gas)::DOUBLE / 1e9, 6) AS gwei, round(max(gas_used * 100 / gas_limit), 2) AS pct_gas_used FROM p GROUP BY 1"),
    "dec16_explorer_links": ("", "SELECT DISTINCT tx_hash, 'https://basescan.org/tx/' || tx_hash AS url FROM p"),
    "top9_display_slices": (f"{KW}, {POINTS}", "SELECT 'price' AS slice, amount_usdc::VARCHAR AS key, txn_count FROM points WHERE window_name = 'all' AND rank <= 12 UNION ALL (SELECT 'facilitator', facilitator, count(*) FROM k GROUP BY facilitator ORDER BY sum(amount_usdc) DESC, facilitator LIMIT 8)"),
}


# Figures from kept state are those of a full computation.
for _name, _same in (("str6_payer_cohorts", "agg10_payer_cohorts"), ("str6_entity_aggregate", "agg11_entity_aggregate"), ("str6_active_entities", "agg8_active_entities"), ("str6_entity_counterparties", "ent7_counterparties"), ("str5_minutes_velocity", "agg9_velocity")):
    _QUERIES[_name] = _QUERIES[_same]

# Pages of stored lists are those of lists that are ranked whole, and a page read back has the rows that it was made of.
for _name, _same in (("top4_by_index", "top4_by_volume"), ("top6_by_index", "top6_payment_page"), ("gr8_by_index", "gr8_next_page"), ("snk5_published_facilitators", "pg14_facilitators")):
    _QUERIES[_name] = _QUERIES[_same]


def sql() -> dict[str, str]:
    return {name: f"WITH {PAY}{', ' + parts if parts else ''}\n{final}" for name, (parts, final) in _QUERIES.items()}
