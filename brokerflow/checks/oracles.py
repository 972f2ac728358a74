"""The registered queries as DuckDB SQL over the same tables, written independently of the Spark code."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

# ---------------------------------------------------------------- shared definitions

AS_OF = "DATE '2001-12-31'"
AS_OF_TEXT = "2001-12-31 00:00:00"
EVENTS_AS_OF = "TIMESTAMP '2024-01-30 23:59:00'"
SECOND_DELIVERY = "TIMESTAMP '1998-01-01 00:00:00'"

BROKER = "['BRK_ALPHA','BRK_BETA','BRK_GAMMA'][({}) % 3 + 1]"
FORMAT = "['csv','json','csv'][({}) % 3 + 1]"
NAME = (
    "CASE {0} WHEN 'BRK_ALPHA' THEN 'Alpha Insurance Brokers' WHEN 'BRK_BETA' THEN 'Beta Risk Partners' "
    "WHEN 'BRK_GAMMA' THEN 'Gamma Underwriting Co.' ELSE {0} END"
)
POSITIVE = (
    "'resolved','minor','repaired','recovered','prompt','satisfied','quickly','covered','safe','good','helpful','settled'"
)
NEGATIVE = (
    "'damage','damaged','loss','stolen','theft','fire','flood','injury','injured','accident','severe','destroyed',"
    "'burst','cracked','collision','broken','delay','disputed'"
)

POL = f"""
pol AS (
  SELECT o_orderkey AS order_key, o_orderkey % 100 AS k, {BROKER.format('o_orderkey')} AS broker_code,
    CASE o_orderkey % 100 WHEN 7 THEN '' WHEN 37 THEN 'POL-' || (o_orderkey - 3) ELSE 'POL-' || o_orderkey END AS policy_number,
    CASE o_orderkey % 100 WHEN 13 THEN '' ELSE c_name END AS customer_name,
    CASE o_orderkey % 100 WHEN 29 THEN 'Unlisted cover' ELSE
      ['Private Motor','Buildings & Contents','Term Life','Private Medical','Worldwide Travel','Business Pack','Marine Cargo'][o_orderkey % 7 + 1] END AS product_name,
    CASE o_orderkey % 100 WHEN 29 THEN 'OTHER' ELSE
      ['AUTO','HOME','LIFE','HEALTH','TRAVEL','COMMERCIAL','MARINE'][o_orderkey % 7 + 1] END AS product_line,
    CAST(CASE o_orderkey % 100 WHEN 3 THEN -CAST(o_totalprice AS DECIMAL(18,2)) WHEN 17 THEN 25 * CAST(o_totalprice AS DECIMAL(18,2))
      WHEN 31 THEN NULL ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS DECIMAL(18,2)) AS premium_amount,
    CAST(CASE o_orderkey % 100 WHEN 19 THEN 1.00 ELSE 30 * CAST(o_totalprice AS DECIMAL(18,2)) END AS DECIMAL(18,2)) AS sum_insured,
    CAST(CASE WHEN o_orderkey % 100 = 11 THEN CAST(o_orderdate AS DATE) + 365 ELSE CAST(o_orderdate AS DATE) END AS DATE) AS effective_date,
    CAST(CASE o_orderkey % 100 WHEN 11 THEN CAST(o_orderdate AS DATE) WHEN 23 THEN CAST(o_orderdate AS DATE) + 2555
      ELSE CAST(o_orderdate AS DATE) + 365 END AS DATE) AS expiry_date,
    'AG' || (100 + o_custkey % 900) AS broker_agent,
    o_orderdate AS loaded_at,
    md5('insurance.policies.raw|' || (o_orderkey % 3) || '|' || o_orderkey) AS raw_id
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

CLM = f"""
lines AS (
  SELECT l_orderkey AS order_key, l_partkey AS p, l_suppkey AS s, (l_partkey + l_suppkey) % 100 AS j,
    'CLM-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || CAST(round(l_extendedprice * 100) AS BIGINT) AS line_id,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS price, CAST(l_shipdate AS DATE) AS shipped, l_shipdate AS loaded_at
  FROM lineitem),
clm AS (
  SELECT *, {BROKER.format('order_key')} AS broker_code,
    CASE j WHEN 29 THEN '' ELSE line_id END AS claim_number,
    CASE j WHEN 13 THEN '' WHEN 23 THEN 'POL-X' || order_key ELSE 'POL-' || order_key END AS policy_number,
    CASE j WHEN 3 THEN CAST({AS_OF} + 10 AS DATE) ELSE shipped END AS loss_date,
    CASE j WHEN 3 THEN CAST({AS_OF} + 12 AS DATE) WHEN 7 THEN CAST(shipped - 5 AS DATE) WHEN 17 THEN CAST(shipped + 400 AS DATE)
      ELSE CAST(shipped + CAST(p % 46 AS INTEGER) AS DATE) END AS reported_date,
    CAST(CASE j WHEN 11 THEN -price WHEN 31 THEN 25 * price ELSE price END AS DECIMAL(18,2)) AS claim_amount,
    CASE j WHEN 19 THEN 'UNKNOWN' ELSE ['OPEN','IN_REVIEW','APPROVED','PAID','DENIED','CLOSED'][p % 6 + 1] END AS claim_status,
    CASE WHEN s % 11 <> 0 THEN 'Part ' || p || ' of supplier ' || s || ': ' ||
      ['damaged', 'repaired', 'weighed', 'stolen', 'recovered', 'broken', 'counted'][s % 7 + 1] || ', then ' ||
      ['settled', 'disputed', 'noted', 'safe', 'destroyed'][p % 5 + 1] || CASE WHEN (p + s) % 3 = 0 THEN ' without delay' ELSE '' END END AS loss_description,
    CAST('0x' || substr(md5(line_id), 1, 15) AS BIGINT) AS log_offset,
    md5('insurance.claims.raw|' || (order_key % 3) || '|' || CAST('0x' || substr(md5(line_id), 1, 15) AS BIGINT)) AS raw_id
  FROM lines)"""

SENTIMENT = f"""CASE WHEN trim(loss_description) <> '' THEN
  coalesce((len(list_filter(regexp_split_to_array(lower(loss_description), '[^a-z]+'), lambda w: w IN ({POSITIVE})))
          - len(list_filter(regexp_split_to_array(lower(loss_description), '[^a-z]+'), lambda w: w IN ({NEGATIVE})))) * 1.0::DOUBLE
    / nullif(len(list_filter(regexp_split_to_array(lower(loss_description), '[^a-z]+'), lambda w: w IN ({POSITIVE}, {NEGATIVE}))), 0), 0.0::DOUBLE) END"""

# Staged records, from the canonical rows (CANON) or from what the messages carry (WIRE).
CANON = f"""{POL},{CLM},
stg_pol AS (SELECT *, md5('stg|' || raw_id) AS stg_id FROM pol),
stg_clm AS (SELECT *, md5('stg|' || raw_id) AS stg_id, CAST(date_diff('day', loss_date, reported_date) AS BIGINT) AS reporting_lag_days,
  {SENTIMENT} AS sentiment_score FROM clm)"""


def _swapped(date: str, defect: str) -> str:
    """MM/dd text of a day up to 12 is read as dd/MM."""
    return f"CASE WHEN {defect} = 83 AND day({date}) <= 12 THEN make_date(year({date}), day({date}), month({date})) ELSE {date} END"


WIRE = f"""{POL},{CLM},
stg_pol AS (
  SELECT * REPLACE (CASE WHEN k = 41 THEN 'UNKNOWN' ELSE broker_code END AS broker_code,
      {_swapped('effective_date', 'k')} AS effective_date, {_swapped('expiry_date', 'k')} AS expiry_date),
    md5('stg|' || raw_id) AS stg_id,
    CASE WHEN k = 73 THEN 'inferred' ELSE 'seed' END AS mapping_source,
    CASE WHEN k = 73 THEN 0.9::DOUBLE ELSE 1.0::DOUBLE END AS mapping_confidence
  FROM pol WHERE k NOT IN (43, 47)),
clm_sent AS (
  SELECT * REPLACE (CASE WHEN j = 41 THEN 'UNKNOWN' ELSE broker_code END AS broker_code,
      {_swapped('loss_date', 'j')} AS loss_date, {_swapped('reported_date', 'j')} AS reported_date)
  FROM clm WHERE j NOT IN (43, 47)),
stg_clm AS (
  SELECT *, md5('stg|' || raw_id) AS stg_id, CAST(date_diff('day', loss_date, reported_date) AS BIGINT) AS reporting_lag_days,
    {SENTIMENT} AS sentiment_score FROM clm_sent)"""


def _verdict(rule: str, severity: str, test: str, *columns: str) -> str:
    shown = " || ', ' || ".join(f"'{c}=' || coalesce(CAST({c} AS VARCHAR), 'NULL')" for c in columns)
    return f"{{'rule_id': '{rule}', 'severity': '{severity}', 'passed': coalesce({test}, false), 'observed': {shown}}}"


LINES = "('AUTO','HOME','LIFE','HEALTH','TRAVEL','COMMERCIAL','MARINE','OTHER')"
POLICY_VERDICTS = ", ".join([
    _verdict("POL_001", "ERROR", "policy_number IS NOT NULL AND trim(policy_number) <> ''", "policy_number"),
    _verdict("POL_002", "ERROR", "premium_amount > 0", "premium_amount"),
    _verdict("POL_003", "WARN", "premium_amount > 0 AND premium_amount <= 1000000", "premium_amount"),
    _verdict("POL_004", "ERROR", "effective_date <= expiry_date", "effective_date", "expiry_date"),
    _verdict("POL_005", "WARN", "date_diff('day', effective_date, expiry_date) <= 1830", "effective_date", "expiry_date"),
    _verdict("POL_006", "ERROR", "length(trim(customer_name)) >= 2", "customer_name"),
    _verdict("POL_007", "WARN", "sum_insured IS NULL OR sum_insured >= premium_amount", "sum_insured", "premium_amount"),
    _verdict("POL_008", "WARN", f"product_line IN {LINES}", "product_line"),
])
COPIES_VERDICT = _verdict(
    "BATCH_001", "WARN", "count(*) OVER (PARTITION BY broker_code, policy_number) = 1", "broker_code", "policy_number"
)
_Z = "abs(CAST(premium_amount AS DOUBLE) - avg(CAST(premium_amount AS DOUBLE)) OVER w) / nullif(stddev_samp(CAST(premium_amount AS DOUBLE)) OVER w, 0)"
DISTANCE_VERDICT = _verdict("BATCH_002", "WARN", f"coalesce({_Z} <= 3, true)", "premium_amount")
CLAIM_VERDICTS = ", ".join([
    _verdict("CLM_001", "ERROR", "claim_number IS NOT NULL AND trim(claim_number) <> ''", "claim_number"),
    _verdict("CLM_002", "ERROR", "policy_number IS NOT NULL AND trim(policy_number) <> ''", "policy_number"),
    _verdict("CLM_003", "ERROR", "claim_amount >= 0", "claim_amount"),
    _verdict("CLM_004", "ERROR", f"loss_date <= {AS_OF}", "loss_date"),
    _verdict("CLM_005", "ERROR", "reported_date >= loss_date", "loss_date", "reported_date"),
    _verdict("CLM_006", "WARN", "date_diff('day', loss_date, reported_date) <= 365", "loss_date", "reported_date"),
    _verdict("CLM_007", "WARN", "claim_status IN ('OPEN','IN_REVIEW','APPROVED','PAID','DENIED','CLOSED','WITHDRAWN')", "claim_status"),
    _verdict("CLM_008", "ERROR", "policy_number IN (SELECT policy_number FROM dim_policy0)", "policy_number"),
])
STATUS = (
    "CASE WHEN len(list_filter(verdicts, lambda v: NOT v.passed AND v.severity = 'ERROR')) > 0 THEN 'FAIL' "
    "WHEN len(list_filter(verdicts, lambda v: NOT v.passed)) > 0 THEN 'WARN' ELSE 'PASS' END"
)


def _key(*columns: str) -> str:
    return "md5(" + " || '|' || ".join(columns) + ")"


def star(source: str) -> str:
    """Checked records, dimensions and facts, scored, on top of the staged records."""
    return f"""{source},
pol_v AS (SELECT *, [{POLICY_VERDICTS}] AS verdicts FROM stg_pol),
pol_c AS (SELECT *, {STATUS} AS dq_status FROM pol_v),
pol_good AS (SELECT * FROM pol_c WHERE dq_status <> 'FAIL'),
dim_policy0 AS (
  SELECT *, md5(policy_number) AS policy_key, md5(broker_code) AS broker_key, md5(md5(upper(trim(customer_name)))) AS customer_key,
    md5(product_line) AS product_key, CAST(date_diff('day', effective_date, expiry_date) AS BIGINT) AS policy_term_days,
    {AS_OF} BETWEEN effective_date AND expiry_date AS is_active
  FROM pol_good QUALIFY row_number() OVER (PARTITION BY policy_number ORDER BY loaded_at DESC, stg_id DESC) = 1),
pol_z AS (SELECT *, avg(CAST(premium_amount AS DOUBLE)) OVER w AS mu, stddev_samp(CAST(premium_amount AS DOUBLE)) OVER w AS sd
  FROM dim_policy0 WINDOW w AS (PARTITION BY broker_key, product_line)),
pol_s AS (SELECT *, CASE WHEN sd > 0 THEN least(1.0::DOUBLE, abs(CAST(premium_amount AS DOUBLE) - mu) / sd / 3.0) END AS anomaly_score FROM pol_z),
dim_policy AS (SELECT *, CASE WHEN anomaly_score >= 0.95 THEN 'premium ' || premium_amount || ' against a mean of ' || CAST(round(mu) AS BIGINT) ||
  ' among ' || product_line || ' peers, deviations: ' || CAST(round(abs(CAST(premium_amount AS DOUBLE) - mu) / sd, 1) AS DECIMAL(18,1)) END AS anomaly_reason FROM pol_s),
dim_customer AS (
  SELECT md5(md5(upper(trim(customer_name)))) AS customer_key, md5(upper(trim(customer_name))) AS customer_id,
    min(customer_name) AS customer_name,
    CASE WHEN regexp_matches(lower(min(customer_name)), '\\b(corp|corporation|plc|enterprises|industries|group|holdings)\\b')
        OR max(sum_insured) >= 10000000 THEN 'CORPORATE'
      WHEN regexp_matches(lower(min(customer_name)), '\\b(ltd|llc|inc|co|sons|traders|services)\\b')
        OR max(sum_insured) >= 5000000 THEN 'SME' ELSE 'RETAIL' END AS customer_segment,
    CASE WHEN CAST(sum(premium_amount) AS DOUBLE) / CAST(sum(sum_insured) AS DOUBLE) < 0.04 THEN 'LOW'
      WHEN CAST(sum(premium_amount) AS DOUBLE) / CAST(sum(sum_insured) AS DOUBLE) < 0.08 THEN 'MEDIUM'
      WHEN CAST(sum(premium_amount) AS DOUBLE) / CAST(sum(sum_insured) AS DOUBLE) < 0.5 THEN 'HIGH' ELSE 'SEVERE' END AS risk_tier
  FROM pol_good GROUP BY 1, 2),
dim_broker AS (
  SELECT md5(broker_code) AS broker_key, broker_code, {NAME.format('broker_code')} AS broker_name,
    CASE WHEN broker_code IN ('BRK_ALPHA','BRK_GAMMA') THEN 'csv' WHEN broker_code = 'BRK_BETA' THEN 'json' END AS source_format
  FROM (SELECT broker_code FROM stg_pol UNION SELECT broker_code FROM stg_clm)),
clm_v AS (SELECT *, [{CLAIM_VERDICTS}] AS verdicts FROM stg_clm),
clm_c AS (SELECT *, {STATUS} AS dq_status FROM clm_v),
clm_good AS (SELECT * FROM clm_c WHERE dq_status <> 'FAIL'),
fact_claim0 AS (
  SELECT md5(c.claim_number) AS claim_key, c.*, p.policy_key, p.broker_key, p.customer_key, p.product_key
  FROM clm_good c LEFT JOIN dim_policy0 p ON p.policy_number = c.policy_number
  QUALIFY row_number() OVER (PARTITION BY c.claim_number ORDER BY c.loaded_at DESC, c.stg_id DESC) = 1),
clm_z AS (SELECT *, avg(CAST(claim_amount AS DOUBLE)) OVER w AS mu, stddev_samp(CAST(claim_amount AS DOUBLE)) OVER w AS sd
  FROM fact_claim0 WINDOW w AS (PARTITION BY product_key)),
clm_s AS (SELECT *, CASE WHEN sd > 0 THEN least(1.0::DOUBLE, abs(CAST(claim_amount AS DOUBLE) - mu) / sd / 3.0) END AS anomaly_score FROM clm_z),
fact_claim AS (SELECT *, CASE WHEN anomaly_score >= 0.95 THEN 'amount ' || claim_amount || ' against a mean of ' || CAST(round(mu) AS BIGINT) ||
  ' among product peers, deviations: ' || CAST(round(abs(CAST(claim_amount AS DOUBLE) - mu) / sd, 1) AS DECIMAL(18,1)) END AS anomaly_reason FROM clm_s),
policies_view AS (
  SELECT p.policy_number, b.broker_name, b.broker_code, c.customer_name, c.customer_segment, c.risk_tier, p.product_line,
    CAST(p.premium_amount AS DOUBLE) AS premium_amount, CAST(p.sum_insured AS DOUBLE) AS sum_insured,
    p.premium_amount AS premium_exact, p.sum_insured AS insured_exact,
    p.effective_date, p.expiry_date, p.policy_term_days, p.is_active, p.anomaly_score, p.anomaly_reason
  FROM dim_policy p LEFT JOIN dim_broker b USING (broker_key) LEFT JOIN dim_customer c USING (customer_key)),
claims_view AS (
  SELECT f.claim_number, f.claim_status, p.policy_number, b.broker_name, b.broker_code, c.customer_name, p.product_line,
    f.loss_date, f.reported_date, f.reporting_lag_days, CAST(f.claim_amount AS DOUBLE) AS claim_amount, f.claim_amount AS amount_exact,
    f.sentiment_score, f.anomaly_score, f.anomaly_reason, f.loss_description
  FROM fact_claim f LEFT JOIN dim_policy p USING (policy_key) LEFT JOIN dim_broker b ON b.broker_key = f.broker_key
    LEFT JOIN dim_customer c ON c.customer_key = f.customer_key),
bp_pol AS (SELECT broker_key, count(DISTINCT policy_number) AS n_p, sum(premium_amount) AS prem, avg(anomaly_score) AS anom FROM dim_policy GROUP BY 1),
bp_clm AS (SELECT broker_key, count(DISTINCT claim_number) AS n_c, sum(claim_amount) AS amt FROM fact_claim GROUP BY 1),
broker_performance AS (
  SELECT broker_code, broker_name, coalesce(n_p, 0) AS policy_count, coalesce(CAST(prem AS DOUBLE), 0.0::DOUBLE) AS total_premium,
    coalesce(n_c, 0) AS claim_count, coalesce(CAST(amt AS DOUBLE), 0.0::DOUBLE) AS total_claims_amount,
    CASE WHEN prem > 0 THEN round(CAST(amt AS DOUBLE) / CAST(prem AS DOUBLE), 4) END AS loss_ratio, anom AS avg_policy_anomaly
  FROM dim_broker LEFT JOIN bp_pol USING (broker_key) LEFT JOIN bp_clm USING (broker_key)),
pol_all AS (SELECT stg_id, broker_code, [{POLICY_VERDICTS}, {COPIES_VERDICT}, {DISTANCE_VERDICT}] AS verdicts FROM stg_pol
  WINDOW w AS (PARTITION BY broker_code, product_line)),
failures AS (
  SELECT 'policy' AS entity, stg_id, broker_code, v.rule_id AS rule_id, v.severity AS severity, v.observed AS observed_value
  FROM (SELECT stg_id, broker_code, unnest(verdicts) AS v FROM pol_all) WHERE NOT v.passed
  UNION ALL
  SELECT 'claim', stg_id, broker_code, v.rule_id, v.severity, v.observed
  FROM (SELECT stg_id, broker_code, unnest(verdicts) AS v FROM clm_v) WHERE NOT v.passed),
rules(rule_id, rule_description) AS (VALUES
  ('POL_001', 'Policy number must be present'), ('POL_002', 'Premium must be a positive number'),
  ('POL_003', 'Premium within plausible range (0 < premium <= 1,000,000)'), ('POL_004', 'Effective date must be on or before expiry date'),
  ('POL_005', 'Policy term should not exceed 5 years'), ('POL_006', 'Customer name present (required for KYC)'),
  ('POL_007', 'Sum insured should be >= premium (sanity check)'), ('POL_008', 'Product line resolved to a known class'),
  ('CLM_001', 'Claim number must be present'), ('CLM_002', 'Claim must reference a policy number'),
  ('CLM_003', 'Claim amount must be zero or positive'), ('CLM_004', 'Loss date cannot be in the future'),
  ('CLM_005', 'Reported date must be on or after loss date'), ('CLM_006', 'Reporting lag should be <= 365 days (late-notification flag)'),
  ('CLM_007', 'Claim status must be a recognized value'), ('CLM_008', 'Referenced policy must exist in ANALYTICS (referential integrity)'),
  ('BATCH_001', 'Duplicate policy numbers within a single broker batch'),
  ('BATCH_002', 'Premium anomaly (z-score > 3 vs broker/product history)')),
validation_summary AS (
  SELECT entity, rule_id, rule_description, severity, count(*) AS failure_count, '{AS_OF_TEXT}' AS last_failure_at
  FROM failures LEFT JOIN rules USING (rule_id) GROUP BY ALL)"""


HEALTH = f"""
landed AS (SELECT {BROKER.format('user_id')} AS broker_code,
  CASE WHEN event_type IN ('purchase', 'signup') THEN 'policy' ELSE 'claim' END AS record_type, ts FROM events),
fresh AS (SELECT broker_code, record_type, count(*) AS rows_landed, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_ingested_at,
  date_diff('second', max(ts), {EVENTS_AS_OF}) AS seconds_since_last FROM landed GROUP BY 1, 2),
health AS (SELECT *, CASE WHEN seconds_since_last <= 120 THEN 'HEALTHY' WHEN seconds_since_last <= 600 THEN 'LAGGING' ELSE 'STALE' END AS ingest_status FROM fresh)"""

# Messages: what every record carries on the wire. Layout '*' is the unseen one.
MESSAGES = f"""{POL},{CLM},
layout(code, entity, header, field) AS (VALUES
  ('BRK_ALPHA','policy','Policy No','policy_number'),('BRK_ALPHA','policy','Cust Name','customer_name'),('BRK_ALPHA','policy','Product','product_name'),
  ('BRK_ALPHA','policy','Premium (USD)','premium_amount'),('BRK_ALPHA','policy','Start','effective_date'),('BRK_ALPHA','policy','End','expiry_date'),
  ('BRK_ALPHA','policy','Sum Insured','sum_insured'),('BRK_ALPHA','policy','Agent','broker_agent'),
  ('BRK_ALPHA','claim','Claim Ref','claim_number'),('BRK_ALPHA','claim','Policy No','policy_number'),('BRK_ALPHA','claim','Loss Date','loss_date'),
  ('BRK_ALPHA','claim','Reported','reported_date'),('BRK_ALPHA','claim','Claim Amt','claim_amount'),('BRK_ALPHA','claim','Status','claim_status'),
  ('BRK_ALPHA','claim','Description','loss_description'),
  ('BRK_BETA','policy','policyId','policy_number'),('BRK_BETA','policy','insuredName','customer_name'),('BRK_BETA','policy','coverageType','product_name'),
  ('BRK_BETA','policy','annualPremium','premium_amount'),('BRK_BETA','policy','inceptionDate','effective_date'),('BRK_BETA','policy','renewalDate','expiry_date'),
  ('BRK_BETA','policy','insuredValue','sum_insured'),('BRK_BETA','policy','producerCode','broker_agent'),
  ('BRK_BETA','claim','claimId','claim_number'),('BRK_BETA','claim','policyId','policy_number'),('BRK_BETA','claim','dateOfLoss','loss_date'),
  ('BRK_BETA','claim','notifiedOn','reported_date'),('BRK_BETA','claim','amountClaimed','claim_amount'),('BRK_BETA','claim','claimState','claim_status'),
  ('BRK_BETA','claim','lossNarrative','loss_description'),
  ('BRK_GAMMA','policy','POL_ID','policy_number'),('BRK_GAMMA','policy','CLIENT','customer_name'),('BRK_GAMMA','policy','LOB','product_name'),
  ('BRK_GAMMA','policy','PREM_AMT','premium_amount'),('BRK_GAMMA','policy','EFF_DT','effective_date'),('BRK_GAMMA','policy','EXP_DT','expiry_date'),
  ('BRK_GAMMA','policy','TSI','sum_insured'),('BRK_GAMMA','policy','BRKR','broker_agent'),
  ('BRK_GAMMA','claim','CLM_ID','claim_number'),('BRK_GAMMA','claim','POL_ID','policy_number'),('BRK_GAMMA','claim','DOL','loss_date'),
  ('BRK_GAMMA','claim','RPT_DT','reported_date'),('BRK_GAMMA','claim','RESERVE','claim_amount'),('BRK_GAMMA','claim','STAT','claim_status'),
  ('BRK_GAMMA','claim','REMARKS','loss_description'),
  ('*','policy','Policy Number','policy_number'),('*','policy','Customer Name','customer_name'),('*','policy','Product Name','product_name'),
  ('*','policy','Premium Amount','premium_amount'),('*','policy','Effective Date','effective_date'),('*','policy','Expiry Date','expiry_date'),
  ('*','policy','Sum Insured','sum_insured'),('*','policy','Broker Agent','broker_agent'),
  ('*','claim','Claim Number','claim_number'),('*','claim','Policy Number','policy_number'),('*','claim','Loss Date','loss_date'),
  ('*','claim','Reported Date','reported_date'),('*','claim','Claim Amount','claim_amount'),('*','claim','Claim Status','claim_status'),
  ('*','claim','Loss Description','loss_description'),
  ('*-','claim','Claim Number','claim_number'),('*-','claim','Policy Number','policy_number'),('*-','claim','Loss Date','loss_date'),
  ('*-','claim','Reported Date','reported_date'),('*-','claim','Claim Amount','claim_amount'),('*-','claim','Claim Status','claim_status')),
signature AS (SELECT code, entity, list(header ORDER BY header) AS headers, md5(string_agg(header, '|' ORDER BY header)) AS header_signature
  FROM layout GROUP BY 1, 2 UNION ALL SELECT '', e, [], md5('') FROM (VALUES ('policy'), ('claim')) t(e)),
msg AS (
  SELECT 'policy' AS entity, 'insurance.policies.raw' AS topic, order_key % 3 AS part, order_key AS log_offset, raw_id, k AS d,
    CASE k WHEN 53 THEN 'endorsement' WHEN 59 THEN NULL ELSE 'policy' END AS record_type,
    CASE k WHEN 41 THEN 'UNKNOWN' ELSE broker_code END AS broker_code, {FORMAT.format('order_key')} AS source_format,
    CASE WHEN k = 67 OR policy_number = '' THEN NULL ELSE policy_number END AS message_key,
    CASE k WHEN 43 THEN '' WHEN 73 THEN '*' ELSE broker_code END AS code
  FROM pol
  UNION ALL
  SELECT 'claim', 'insurance.claims.raw', order_key % 3, log_offset, raw_id, j, 'claim',
    CASE j WHEN 41 THEN 'UNKNOWN' ELSE broker_code END, {FORMAT.format('order_key')},
    CASE WHEN j = 67 OR claim_number = '' THEN NULL ELSE claim_number END,
    CASE WHEN j = 43 THEN '' WHEN j = 73 AND loss_description IS NULL THEN '*-' WHEN j = 73 THEN '*' ELSE broker_code END
  FROM clm),
raw AS (SELECT * FROM msg JOIN signature USING (code, entity) WHERE d <> 47)"""


def add(name: str, ctes: str | None, select: str) -> None:
    ORACLES[name] = (f"WITH {ctes}\n{select}" if ctes else select).strip()


STAR = star(CANON)
WIRE_STAR = star(WIRE)

# ---------------------------------------------------------------- sources and sinks

add("wire_to_premium_by_product", WIRE_STAR,
    "SELECT product_line, CAST(sum(premium_amount) AS DOUBLE) AS total_premium FROM dim_policy0 GROUP BY 1")
add("parse_envelope", MESSAGES, """
SELECT raw_id, broker_code, source_format, record_type, topic AS kafka_topic, part AS kafka_partition, log_offset AS kafka_offset,
  message_key, 'broker-ingest-' || coalesce(record_type, 'x') AS ingest_channel, CAST(len(headers) AS BIGINT) AS headers FROM raw""")
add("dead_letter", MESSAGES,
    """SELECT topic, part AS "partition", log_offset AS "offset", CASE d WHEN 47 THEN 'not a JSON object' ELSE 'no payload fields' END AS problem,
  CAST(CASE d WHEN 47 THEN 60 ELSE 0 END AS BIGINT) AS characters FROM msg WHERE d IN (43, 47)""")
add("route_by_record_type", MESSAGES, """
SELECT entity AS landed_in, record_type, 'broker-ingest-' || coalesce(record_type, 'x') AS ingest_channel, count(*) AS records
FROM raw GROUP BY ALL""")
add("dedupe_redelivery", MESSAGES, """
SELECT topic, part AS "partition", count(*) AS records, min(log_offset) AS first_offset, max(log_offset) AS last_offset
FROM msg GROUP BY ALL""")
add("source_log_stream", MESSAGES, 'SELECT topic, part AS "partition", count(*) AS records FROM msg GROUP BY ALL')
add("append_raw", MESSAGES, """
SELECT entity AS landed_in, broker_code, count(*) AS records, count(DISTINCT raw_id) AS ids FROM raw GROUP BY ALL""")


def _file_rows(code: str, blank: str) -> str:
    """Records of a broker's files; ``blank`` turns an empty text into what the format keeps of it."""
    def text(c: str) -> str:
        return blank.format(c)

    return f"""
SELECT broker_code, 'policy' AS record_type, false AS corrupt, {text('policy_number')} AS policy_number, {text('customer_name')} AS customer_name,
  product_name, CAST(premium_amount AS VARCHAR) AS premium_amount, CAST(sum_insured AS VARCHAR) AS sum_insured,
  CAST(effective_date AS VARCHAR) AS effective_date, CAST(expiry_date AS VARCHAR) AS expiry_date, broker_agent, NULL AS claim_number,
  NULL AS loss_date, NULL AS reported_date, NULL AS claim_amount, NULL AS claim_status, NULL AS loss_description
FROM pol WHERE broker_code = '{code}'
UNION ALL
SELECT broker_code, 'claim', false, {text('policy_number')}, NULL, NULL, NULL, NULL, NULL, NULL, NULL, {text('claim_number')},
  CAST(loss_date AS VARCHAR), CAST(reported_date AS VARCHAR), CAST(claim_amount AS VARCHAR), claim_status, loss_description
FROM clm WHERE broker_code = '{code}'"""


add("read_broker_csv", f"{POL},{CLM}", _file_rows("BRK_ALPHA", "nullif({}, '')"))
add("read_broker_json", f"{POL},{CLM}", _file_rows("BRK_BETA", "{}"))
add("read_broker_psv", f"{POL},{CLM}", _file_rows("BRK_GAMMA", "nullif({}, '')"))
add("files_to_envelopes", MESSAGES, """
SELECT code AS broker_code, source_format, entity AS record_type, header_signature, count(*) AS records
FROM (SELECT entity, source_format, ['BRK_ALPHA','BRK_BETA','BRK_GAMMA'][part + 1] AS code FROM msg) JOIN signature USING (code, entity) GROUP BY ALL""")
add("semantic_snapshot", STAR, """
SELECT policy_number, broker_code, product_line, premium_amount, CAST(expiry_date AS VARCHAR) AS expiry_date FROM policies_view""")

# ---------------------------------------------------------------- header mapping

add("header_signature", MESSAGES,
    "SELECT broker_code, record_type, header_signature, count(*) AS records FROM raw GROUP BY ALL")
add("distinct_headers", MESSAGES, """
SELECT broker_code, entity AS record_type, header, count(*) AS records
FROM (SELECT broker_code, entity, unnest(headers) AS header FROM raw) GROUP BY ALL""")
add("seed_mappings", MESSAGES, """
SELECT s.code AS broker_code, s.entity AS record_type, s.header_signature, 'seed' AS mapping_source, 1.0::DOUBLE AS confidence,
  CAST(len(s.headers) AS BIGINT) AS fields, n.records
FROM signature s LEFT JOIN (SELECT code, entity, count(*) AS records FROM raw GROUP BY 1, 2) n USING (code, entity)
WHERE s.code LIKE 'BRK%'""")
add("register_new_signatures", MESSAGES, """
SELECT DISTINCT entity AS record_type, header_signature, array_to_string(headers, '|') AS source_headers FROM raw WHERE code LIKE '*%'""")
add("resolve_unmapped", MESSAGES, """
SELECT l.entity AS record_type, s.header_signature, 0.9::DOUBLE AS confidence, l.header, l.field
FROM layout l JOIN signature s USING (code, entity)
WHERE (l.code, l.entity) IN (SELECT code, entity FROM raw WHERE code LIKE '*%')""")
add("extract_json_block", None, """
SELECT 'event-' || event_id AS source, CASE WHEN event_id % 10 > 1 THEN json_extract_string(props, '$.k') END AS k FROM events
UNION ALL SELECT 'turn-' || conv_id || '-' || turn, conv_id || '-' || turn FROM conversations WHERE text IS NOT NULL""")
add("invert_mapping", MESSAGES, """
SELECT s.entity AS record_type, s.header_signature, l.field, l.header
FROM signature s JOIN layout l USING (code, entity)
WHERE s.code LIKE 'BRK%' OR (s.code, s.entity) IN (SELECT code, entity FROM raw)
UNION ALL SELECT 'claim', header_signature, 'loss_description', NULL FROM signature
WHERE code = '*-' AND (code, entity) IN (SELECT code, entity FROM raw)""")


def _sent_date(column: str, defect: str) -> str:
    return f"""CASE WHEN {defect} = 79 THEN strftime({column}, '%d-%b-%Y') WHEN {defect} = 83 THEN strftime({column}, '%m/%d/%Y')
    WHEN broker_code = 'BRK_BETA' THEN strftime({column}, '%d/%m/%Y') ELSE strftime({column}, '%Y-%m-%d') END"""


add("project_canonical", f"{POL},{CLM}", f"""
SELECT raw_id, CASE j WHEN 41 THEN 'UNKNOWN' ELSE broker_code END AS broker_code, policy_number, claim_number, {_sent_date('loss_date', 'j')} AS loss_date,
  CASE WHEN j = 89 THEN '  ' || lower(claim_status) || ' ' ELSE claim_status END AS claim_status, loss_description,
  NULL AS customer_name, NULL AS product_name, NULL AS expiry_date FROM clm WHERE j NOT IN (43, 47)
UNION ALL
SELECT raw_id, CASE k WHEN 41 THEN 'UNKNOWN' ELSE broker_code END, policy_number, NULL, NULL, NULL, NULL,
  CASE WHEN k = 89 THEN '  ' || customer_name || ' ' ELSE customer_name END, product_name, {_sent_date('expiry_date', 'k')} FROM pol WHERE k NOT IN (43, 47)""")
add("validate_mapping", MESSAGES, """
SELECT entity AS record_type, CAST(sum(len(headers)) AS BIGINT) AS entries, count(*) AS layouts, CAST(sum(bad) AS BIGINT) AS invalid
FROM (SELECT entity, headers, 0 AS bad FROM signature WHERE code LIKE 'BRK%' OR (code LIKE '*%' AND (code, entity) IN (SELECT code, entity FROM raw))
  UNION ALL SELECT entity, headers, 1 FROM signature WHERE code LIKE 'BRK%') GROUP BY 1""")
add("to_broker_format", f"{POL},{CLM}", """
SELECT line_id AS record, CAST(claim_amount AS DOUBLE) AS amount, CAST(reported_date AS VARCHAR) AS dated, CAST(7 AS BIGINT) AS headers FROM clm
UNION ALL SELECT CAST(order_key AS VARCHAR), CAST(premium_amount AS DOUBLE), CAST(expiry_date AS VARCHAR), CAST(8 AS BIGINT) FROM pol""")

# ---------------------------------------------------------------- cleaning and staging

add("trim_strings", None, "SELECT c_custkey, c_name AS customer_name FROM customer")
add("parse_money", None, """
SELECT o_orderkey, CASE o_orderkey % 5 WHEN 3 THEN NULL WHEN 2 THEN -o_totalprice ELSE o_totalprice END AS amount FROM orders""")
add("parse_date_multi", None, """
SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 5 = 4 THEN NULL
  WHEN o_orderkey % 5 = 2 AND day(o_orderdate) <= 12 THEN make_date(year(o_orderdate), day(o_orderdate), month(o_orderdate))
  ELSE CAST(o_orderdate AS DATE) END AS VARCHAR) AS parsed FROM orders""")
add("upper_codes", CLM, "SELECT claim_status, count(*) AS claims FROM clm GROUP BY 1")
add("reporting_lag", CLM, "SELECT line_id, CAST(date_diff('day', loss_date, reported_date) AS BIGINT) AS lag_days FROM clm")
add("stage_policy", WIRE, """
SELECT stg_id, raw_id, broker_code, policy_number, customer_name, product_name, product_line, CAST(premium_amount AS DOUBLE) AS premium_amount,
  CAST(sum_insured AS DOUBLE) AS sum_insured, CAST(effective_date AS VARCHAR) AS effective_date, CAST(expiry_date AS VARCHAR) AS expiry_date,
  broker_agent, mapping_source, mapping_confidence, strftime(loaded_at, '%Y-%m-%d %H:%M:%S') AS loaded_at FROM stg_pol""")
add("stage_claim", WIRE, """
SELECT stg_id, raw_id, broker_code, claim_number, policy_number, CAST(loss_date AS VARCHAR) AS loss_date,
  CAST(reported_date AS VARCHAR) AS reported_date, CAST(claim_amount AS DOUBLE) AS claim_amount, claim_status, loss_description,
  reporting_lag_days, sentiment_score, strftime(loaded_at, '%Y-%m-%d %H:%M:%S') AS loaded_at FROM stg_clm""")
add("incremental_unprocessed", MESSAGES, "SELECT raw_id, broker_code, record_type FROM raw WHERE d = 43")

# ---------------------------------------------------------------- data quality

for _entity, _rows in (("policy", "pol_v"), ("claim", "clm_v")):
    add(f"evaluate_rules_{_entity}", STAR, f"""
SELECT md5('batch-1|' || stg_id || '|' || v.rule_id) AS result_id, stg_id, v.rule_id AS rule_id, v.severity AS severity, v.passed AS passed
FROM (SELECT stg_id, unnest(verdicts) AS v FROM {_rows})""")
add("failed_rules", STAR, "SELECT * FROM failures")
add("record_status", STAR, """
SELECT 'policy' AS entity, stg_id, dq_status FROM pol_c UNION ALL SELECT 'claim', stg_id, dq_status FROM clm_c""")
_FAILED = "array_to_string(list_transform(list_filter(verdicts, lambda v: NOT v.passed AND v.severity = 'ERROR'), lambda v: v.rule_id), '|')"
add("quarantine", STAR, f"""
SELECT md5('policy|' || stg_id) AS quarantine_id, 'policy' AS entity, stg_id, broker_code, {_FAILED} AS failed_rules, false AS resolved,
  policy_number, CAST(effective_date AS VARCHAR) AS first_date FROM pol_c WHERE dq_status = 'FAIL'
UNION ALL
SELECT md5('claim|' || stg_id), 'claim', stg_id, broker_code, {_FAILED}, false, policy_number, CAST(loss_date AS VARCHAR)
FROM clm_c WHERE dq_status = 'FAIL'""")
add("explain_sample", STAR, """
SELECT rule_id, stg_id, rule_description || ' - ' || lower(severity) || ' on this ' || entity || ', which has ' || observed_value AS explanation
FROM failures JOIN rules USING (rule_id)""")
add("load_rule", STAR, """
SELECT rule_id, severity, passed, count(*) AS records FROM (
  SELECT v.rule_id AS rule_id, CASE v.rule_id WHEN 'POL_005' THEN 'INFO' ELSE v.severity END AS severity,
    CASE v.rule_id WHEN 'POL_005' THEN coalesce(days <= 365, false) ELSE v.passed END AS passed
  FROM (SELECT unnest(verdicts) AS v, date_diff('day', effective_date, expiry_date) AS days FROM pol_v) WHERE v.rule_id <> 'POL_007') GROUP BY ALL""")
_CATALOG_RULE = _verdict("POL_X01", "INFO", "sum_insured >= 40 * premium_amount AND customer_name <> ''", "sum_insured", "premium_amount", "customer_name")
add("catalog_only_rule", STAR, f"""
SELECT stg_id, v.severity AS severity, v.observed AS observed_value FROM (SELECT stg_id, {_CATALOG_RULE} AS v FROM stg_pol) WHERE NOT v.passed""")
add("sync_rules", STAR, """
SELECT rule_id, CASE WHEN rule_id LIKE 'CLM%' THEN 'claim' ELSE 'policy' END AS entity,
  CASE WHEN rule_id IN ('POL_001','POL_002','POL_004','POL_006','CLM_001','CLM_002','CLM_003','CLM_004','CLM_005','CLM_008') THEN 'ERROR' ELSE 'WARN' END AS severity,
  CASE rule_id WHEN 'CLM_008' THEN 'referential' WHEN 'BATCH_001' THEN 'batch' WHEN 'BATCH_002' THEN 'anomaly' ELSE 'expression' END AS rule_type,
  true AS active, count(stg_id) AS failures FROM rules LEFT JOIN failures USING (rule_id) GROUP BY rule_id""")


def _log(entity: str, rows: str) -> str:
    def count(severity: str) -> str:
        return f"CAST(sum(len(list_filter(verdicts, lambda v: NOT v.passed AND v.severity = '{severity}'))) AS BIGINT)"

    return f"""SELECT 'batch-1' AS batch_id, '{entity}' AS entity, count(*) AS records_evaluated, CAST(8 AS BIGINT) AS rules_evaluated,
  {count('ERROR')} AS error_failures, {count('WARN')} AS warn_failures, count(*) FILTER (dq_status = 'FAIL') AS quarantined, 'SUCCESS' AS status FROM {rows}"""


add("batch_log", STAR, _log("policy", "pol_c") + " UNION ALL " + _log("claim", "clm_c"))
add("referential_check", STAR, """
SELECT stg_id, claim_number, policy_number FROM stg_clm c
WHERE NOT EXISTS (SELECT 1 FROM dim_policy0 p WHERE p.policy_number = c.policy_number)""")
add("duplicate_check", CANON, """
SELECT stg_id, broker_code, policy_number, count(*) OVER (PARTITION BY broker_code, policy_number) AS policy_copies
FROM stg_pol QUALIFY policy_copies > 1""")
add("anomaly_check", STAR, """
SELECT stg_id, broker_code, 'WARN' AS severity, 'premium_amount=' || premium_amount AS observed_value
FROM (SELECT *, avg(CAST(premium_amount AS DOUBLE)) OVER w AS m, stddev_samp(CAST(premium_amount AS DOUBLE)) OVER w AS s
  FROM stg_pol WINDOW w AS (PARTITION BY broker_code, product_line))
WHERE abs(CAST(premium_amount AS DOUBLE) - m) > 3 * s""")
add("severity_gate", STAR, """
SELECT 'policy' AS entity, broker_code, dq_status, count(*) AS records FROM pol_good GROUP BY ALL
UNION ALL SELECT 'claim', broker_code, dq_status, count(*) FROM clm_good GROUP BY ALL""")

# ---------------------------------------------------------------- enrichment

add("classify_product", POL, "SELECT order_key, product_name, product_line FROM pol")
add("classify_after_checks", STAR, """
SELECT CASE WHEN dq_status = 'FAIL' THEN 'FAIL' ELSE 'WARN' END AS dq_status,
  CASE WHEN dq_status <> 'FAIL' THEN product_line END AS product_line, count(*) AS policies FROM pol_c GROUP BY 1, 2""")
add("sentiment_after_checks", STAR, """
SELECT stg_id, dq_status, CASE WHEN dq_status <> 'FAIL' THEN round(sentiment_score, 6) END AS sentiment_score FROM clm_c""")
add("claim_sentiment", CLM, f"""
SELECT source, round({SENTIMENT}, 6) AS sentiment_score FROM (
  SELECT line_id AS source, loss_description FROM clm UNION ALL
  SELECT 'turn-' || conv_id || '-' || turn, text || ' ' || ['settled', 'a safe and good end', 'damage and loss', 'no word of it', ''][turn % 5 + 1] FROM conversations)""")
add("customer_profile", STAR, "SELECT customer_id, customer_name, customer_segment, risk_tier FROM dim_customer")
add("customer_id", None, "SELECT c_custkey, md5(upper(trim(c_name))) AS customer_id FROM customer")
add("infer_distinct", CANON, """
SELECT stg_id, CASE WHEN k <> 29 THEN product_name END AS product_name,
  CASE WHEN k = 29 THEN 'NONE' WHEN product_name = 'Term Life' THEN 'CACHED' ELSE upper(split_part(product_name, ' ', 1)) END AS first_word,
  CASE WHEN k = 29 THEN 10 WHEN product_name = 'Term Life' THEN 1 ELSE length(product_name) END AS characters FROM stg_pol""")
add("model_call_log", CANON, """
SELECT 'classify' AS task, 'rules' AS model, true AS success, count(DISTINCT CASE WHEN k = 29 THEN '' ELSE product_name END) AS inputs
FROM stg_pol WHERE k = 29 OR product_name <> 'Term Life'""")
add("anomaly_reason", STAR, """
SELECT policy_number AS number, anomaly_reason FROM dim_policy WHERE anomaly_reason IS NOT NULL
UNION ALL SELECT claim_number, anomaly_reason FROM fact_claim WHERE anomaly_reason IS NOT NULL""")

# ---------------------------------------------------------------- star schema

add("upsert_policies", STAR, f"""
, a AS (SELECT * FROM pol_good WHERE loaded_at < {SECOND_DELIVERY}
  QUALIFY row_number() OVER (PARTITION BY policy_number ORDER BY loaded_at DESC, stg_id DESC) = 1),
b AS (SELECT * FROM pol_good WHERE loaded_at >= {SECOND_DELIVERY}
  QUALIFY row_number() OVER (PARTITION BY policy_number ORDER BY loaded_at DESC, stg_id DESC) = 1)
SELECT policy_number, CAST(CASE WHEN b.stg_id IS NULL THEN a.premium_amount ELSE b.premium_amount END AS DOUBLE) AS premium_amount,
  CAST(CASE WHEN b.stg_id IS NULL THEN a.expiry_date ELSE b.expiry_date END AS VARCHAR) AS expiry_date,
  CASE WHEN a.stg_id IS NOT NULL THEN 0.5::DOUBLE END AS anomaly_score,
  strftime(coalesce(a.loaded_at, b.loaded_at), '%Y-%m-%d %H:%M:%S') AS loaded_at
FROM a FULL JOIN b USING (policy_number)""")
_PROFILE = STAR.split("dim_customer AS (")[1].split("FROM pol_good GROUP BY 1, 2)")[0]
add("upsert_insert_only", STAR, f"""
, a AS ({_PROFILE} FROM pol_good WHERE loaded_at < {SECOND_DELIVERY} GROUP BY 1, 2),
b AS ({_PROFILE} FROM pol_good WHERE loaded_at >= {SECOND_DELIVERY} GROUP BY 1, 2)
SELECT customer_id, customer_name, customer_segment, risk_tier FROM a
UNION ALL SELECT customer_id, customer_name, customer_segment, risk_tier FROM b WHERE customer_id NOT IN (SELECT customer_id FROM a)""")
add("dim_broker", STAR, "SELECT * FROM dim_broker")
add("dim_customer", STAR, "SELECT customer_key, customer_id, customer_name FROM dim_customer")
add("dim_product", STAR, f"""
SELECT md5(line) AS product_key, line AS product_line, line || ' insurance' AS description, count(policy_number) AS policies
FROM (SELECT unnest(['AUTO','HOME','LIFE','HEALTH','TRAVEL','COMMERCIAL','MARINE','OTHER']) AS line) LEFT JOIN dim_policy0 ON product_line = line
GROUP BY line""")
add("dim_policy", STAR, """
SELECT policy_key, policy_number, broker_key, customer_key, product_key, product_line, CAST(premium_amount AS DOUBLE) AS premium_amount,
  CAST(sum_insured AS DOUBLE) AS sum_insured, CAST(effective_date AS VARCHAR) AS effective_date, CAST(expiry_date AS VARCHAR) AS expiry_date,
  policy_term_days, is_active, strftime(loaded_at, '%Y-%m-%d %H:%M:%S') AS loaded_at FROM dim_policy0""")
add("policy_term_days", CANON,
    "SELECT stg_id, CAST(date_diff('day', effective_date, expiry_date) AS BIGINT) AS policy_term_days FROM stg_pol")
add("is_active", STAR, "SELECT is_active, count(*) AS policies FROM dim_policy0 GROUP BY 1")
add("fact_premium", STAR, """
SELECT md5('premium|' || policy_key) AS premium_key, policy_key, broker_key, customer_key, product_key,
  CAST(effective_date AS VARCHAR) AS effective_date, CAST(premium_amount AS DOUBLE) AS premium_amount,
  CAST(sum_insured AS DOUBLE) AS sum_insured, strftime(loaded_at, '%Y-%m-%d %H:%M:%S') AS loaded_at FROM dim_policy0""")
add("fact_claim", STAR, """
SELECT claim_key, claim_number, policy_key, broker_key, customer_key, product_key, CAST(loss_date AS VARCHAR) AS loss_date,
  CAST(reported_date AS VARCHAR) AS reported_date, reporting_lag_days, CAST(claim_amount AS DOUBLE) AS claim_amount, claim_status,
  sentiment_score, strftime(loaded_at, '%Y-%m-%d %H:%M:%S') AS loaded_at FROM fact_claim0""")
add("surrogate_keys", STAR, """
SELECT count(*) AS claims, count(DISTINCT claim_number) AS claim_keys, count(*) AS with_policy FROM fact_claim0""")

# ---------------------------------------------------------------- outliers

add("policy_anomaly", STAR, "SELECT policy_number, round(anomaly_score, 6) AS anomaly_score FROM dim_policy")
add("claim_anomaly", STAR, "SELECT claim_number, round(anomaly_score, 6) AS anomaly_score FROM fact_claim")
add("flag_anomalies", STAR, """
SELECT product_line, count(*) AS flagged FROM dim_policy WHERE anomaly_score >= 0.95 GROUP BY 1
UNION ALL SELECT 'all claims', count(*) FROM fact_claim WHERE anomaly_score >= 0.95""")
add("keep_old_score", STAR, """
SELECT policy_number, round(CASE WHEN s > 0 THEN least(1.0::DOUBLE, abs(CAST(premium_amount AS DOUBLE) - m) / s / 3.0) ELSE 0.125::DOUBLE END, 6) AS anomaly_score
FROM (SELECT policy_number, premium_amount, avg(CAST(premium_amount AS DOUBLE)) OVER w AS m, stddev_samp(CAST(premium_amount AS DOUBLE)) OVER w AS s
  FROM dim_policy0 WINDOW w AS (PARTITION BY customer_key, product_line))""")

# ---------------------------------------------------------------- business views

add("ingest_freshness", HEALTH, "SELECT broker_code, record_type, rows_landed, last_ingested_at, seconds_since_last FROM health")
add("ingestion_health", HEALTH, "SELECT * FROM health")
add("stream_freshness", HEALTH, "SELECT * FROM health")
add("policies_view", STAR, """
SELECT * EXCLUDE (premium_exact, insured_exact) REPLACE (round(anomaly_score, 6) AS anomaly_score,
  CAST(effective_date AS VARCHAR) AS effective_date, CAST(expiry_date AS VARCHAR) AS expiry_date) FROM policies_view""")
add("claims_view", STAR, """
SELECT * EXCLUDE (amount_exact) REPLACE (round(anomaly_score, 6) AS anomaly_score, round(sentiment_score, 6) AS sentiment_score,
  CAST(loss_date AS VARCHAR) AS loss_date, CAST(reported_date AS VARCHAR) AS reported_date) FROM claims_view""")
add("broker_performance", STAR, "SELECT * REPLACE (round(avg_policy_anomaly, 6) AS avg_policy_anomaly) FROM broker_performance")
add("broker_performance_fanout", STAR, """
SELECT b.broker_code, b.broker_name, count(DISTINCT p.policy_number) AS policy_count,
  round(coalesce(CAST(sum(p.premium_amount) AS DOUBLE), 0) / 1000, 0) AS total_premium,
  count(DISTINCT c.claim_number) AS claim_count, round(coalesce(CAST(sum(c.claim_amount) AS DOUBLE), 0) / 1000, 0) AS total_claims_amount,
  CASE WHEN sum(p.premium_amount) > 0 THEN round(CAST(sum(c.claim_amount) AS DOUBLE) / CAST(sum(p.premium_amount) AS DOUBLE), 4) END AS loss_ratio,
  round(avg(p.anomaly_score), 6) AS avg_policy_anomaly
FROM dim_broker b LEFT JOIN dim_policy p ON p.broker_key = b.broker_key LEFT JOIN fact_claim c ON c.broker_key = b.broker_key GROUP BY 1, 2""")
add("validation_summary", STAR, "SELECT * FROM validation_summary")

# ---------------------------------------------------------------- metrics

add("metric_policies", STAR, """
SELECT product_line, is_active, count(policy_number) AS policy_count, CAST(sum(premium_exact) AS DOUBLE) AS total_premium,
  round(CAST(sum(premium_exact) AS DOUBLE) / count(premium_exact), 4) AS avg_premium,
  CAST(sum(insured_exact) AS DOUBLE) AS total_sum_insured, round(avg(anomaly_score), 4) AS avg_anomaly_score FROM policies_view GROUP BY 1, 2""")
add("metric_claims", STAR, """
SELECT product_line, claim_status, count(claim_number) AS claim_count, CAST(sum(amount_exact) AS DOUBLE) AS total_claims,
  round(CAST(sum(amount_exact) AS DOUBLE) / count(amount_exact), 4) AS avg_claim, round(avg(reporting_lag_days), 4) AS avg_reporting_lag
FROM claims_view GROUP BY 1, 2""")
add("metric_broker_performance", STAR, """
SELECT broker_code, CAST(sum(policy_count) AS BIGINT) AS policy_count, sum(total_premium) AS total_premium,
  sum(total_claims_amount) AS total_claims_amount, round(avg(loss_ratio), 4) AS loss_ratio FROM broker_performance GROUP BY 1""")
add("metric_ingestion_health", HEALTH, """
SELECT record_type, ingest_status, CAST(sum(rows_landed) AS BIGINT) AS rows_landed, max(seconds_since_last) AS seconds_since_last
FROM health GROUP BY 1, 2""")
add("metric_validation_summary", STAR, """
SELECT entity, severity, CAST(sum(failure_count) AS BIGINT) AS failure_count FROM validation_summary GROUP BY 1, 2""")
add("metric_query_rows", STAR, """
SELECT policy_number, product_line FROM policies_view WHERE product_line IN ('MARINE', 'LIFE') AND effective_date >= DATE '1998-01-01'
ORDER BY policy_number""")
add("premium_by_product", STAR, "SELECT product_line, CAST(sum(premium_exact) AS DOUBLE) AS total_premium FROM policies_view GROUP BY 1")
add("top_loss_ratio", STAR, "SELECT broker_name, loss_ratio FROM broker_performance ORDER BY loss_ratio DESC NULLS LAST, broker_name LIMIT 10")
add("stale_streams", HEALTH, "SELECT broker_code, record_type, seconds_since_last, ingest_status FROM health WHERE ingest_status = 'STALE'")
add("unhealthy_streams", HEALTH, "SELECT broker_code, record_type, seconds_since_last, ingest_status FROM health WHERE ingest_status <> 'HEALTHY'")
add("top_validation_errors", STAR, """
SELECT rule_description, severity, failure_count FROM validation_summary ORDER BY failure_count DESC, rule_id LIMIT 10""")
add("open_claim_count", STAR, "SELECT count(*) AS open_claims FROM claims_view WHERE claim_status = 'OPEN'")
add("open_claims", STAR, """
SELECT claim_number, claim_status, broker_name, product_line, claim_amount FROM claims_view WHERE claim_status = 'OPEN' ORDER BY claim_number LIMIT 20""")
add("largest_policies", STAR, """
SELECT policy_number, broker_name, product_line, premium_amount FROM policies_view ORDER BY premium_exact DESC NULLS LAST, policy_number LIMIT 5""")
add("portfolio_counts", STAR, """
SELECT 'policies' AS entity, count(*) AS records FROM policies_view UNION ALL SELECT 'claims', count(*) FROM claims_view""")

# ---------------------------------------------------------------- reports

_ERRORS = """(SELECT CAST(coalesce(sum(failure_count) FILTER (severity = 'ERROR'), 0) AS BIGINT) FROM validation_summary) AS validation_errors,
  (SELECT CAST(coalesce(sum(failure_count) FILTER (severity = 'WARN'), 0) AS BIGINT) FROM validation_summary) AS validation_warnings"""
add("portfolio_kpis", STAR, f"""
SELECT (SELECT count(*) FROM policies_view) AS policy_volume, (SELECT CAST(sum(premium_exact) AS DOUBLE) FROM policies_view) AS premium_revenue,
  (SELECT count(*) FROM claims_view) AS claim_volume, (SELECT CAST(sum(amount_exact) AS DOUBLE) FROM claims_view) AS total_claims, {_ERRORS},
  round((SELECT CAST(sum(amount_exact) AS DOUBLE) FROM claims_view) / (SELECT CAST(sum(premium_exact) AS DOUBLE) FROM policies_view), 4) AS loss_ratio""")
add("claims_by_status", STAR, """
SELECT claim_status, count(*) AS claim_count, CAST(sum(amount_exact) AS DOUBLE) AS total_amount FROM claims_view GROUP BY 1""")
add("broker_leaderboard", STAR, """
SELECT broker_name, policy_count, total_premium, claim_count, total_claims_amount, round(loss_ratio * 100, 1) AS loss_ratio_pct FROM broker_performance""")
add("health_counts", HEALTH, """
SELECT CAST(sum(rows_landed) AS BIGINT) AS rows_landed, count(*) FILTER (ingest_status = 'HEALTHY') AS healthy,
  count(*) FILTER (ingest_status = 'LAGGING') AS lagging, count(*) FILTER (ingest_status = 'STALE') AS stale FROM health""")
add("rows_by_broker", HEALTH, "SELECT broker_code, CAST(sum(rows_landed) AS BIGINT) AS rows_landed FROM health GROUP BY 1")
add("broker_drilldown", STAR, """
SELECT CAST(sum(policy_count) AS BIGINT) AS policies, sum(total_premium) AS premium, CAST(sum(claim_count) AS BIGINT) AS claims,
  sum(total_claims_amount) AS claims_amount, round(sum(total_claims_amount) / greatest(sum(total_premium), 1.0), 4) AS loss_ratio
FROM broker_performance WHERE broker_name = 'Beta Risk Partners'""")
add("premium_vs_claims_long", STAR, """
SELECT broker_name, 'total_premium' AS measure, total_premium AS amount FROM broker_performance
UNION ALL SELECT broker_name, 'total_claims_amount', total_claims_amount FROM broker_performance""")
add("product_mix", STAR, """
SELECT broker_name, product_line, CAST(sum(premium_exact) AS DOUBLE) AS premium FROM policies_view GROUP BY 1, 2""")
add("dq_kpis", STAR, f"""
SELECT {_ERRORS}, (SELECT count(*) FROM policies_view WHERE anomaly_score >= 0.95) AS anomalous_policies,
  (SELECT count(*) FROM claims_view WHERE anomaly_score >= 0.95) AS anomalous_claims""")
add("failures_by_entity_severity", STAR, """
SELECT entity, severity, CAST(sum(failure_count) AS BIGINT) AS failure_count FROM validation_summary GROUP BY 1, 2""")
add("failures_by_rule", STAR, "SELECT * FROM validation_summary")
add("top_anomalies", STAR, """
SELECT policy_number, broker_name, product_line, premium_amount, round(anomaly_score, 6) AS anomaly_score FROM policies_view
ORDER BY policies_view.anomaly_score DESC NULLS LAST, policy_number LIMIT 10""")

# ---------------------------------------------------------------- runs and streams

_PORTFOLIO = """
SELECT broker_code, product_line, 'policy' AS entity, count(*) AS records, CAST(sum(premium_exact) AS DOUBLE) AS amount,
  count(*) FILTER (anomaly_score >= 0.95) AS flagged FROM policies_view GROUP BY 1, 2
UNION ALL
SELECT broker_code, product_line, 'claim', count(*), CAST(sum(amount_exact) AS DOUBLE), count(*) FILTER (anomaly_score >= 0.95)
FROM claims_view GROUP BY 1, 2"""
add("batch_run", WIRE_STAR, _PORTFOLIO)
# In three deliveries, claims with an odd place in the log come one delivery after their order's policy, or two before it.
_IN_TIME = "policy_number IN (SELECT policy_number FROM dim_policy0)"
_DELIVERED = WIRE_STAR.replace(_IN_TIME, f"({_IN_TIME} AND order_key % 3 <= (order_key % 3 + log_offset % 2) % 3)")
for _name in ("idempotent_rerun", "micro_batches", "failed_batch"):
    add(_name, _DELIVERED, _PORTFOLIO)
add("incremental_scores", WIRE_STAR.replace(
    "PARTITION BY policy_number ORDER BY loaded_at DESC", "PARTITION BY policy_number ORDER BY order_key % 5 DESC, loaded_at DESC"
), "SELECT policy_number, CAST(premium_amount AS DOUBLE) AS premium_amount, round(anomaly_score, 6) AS anomaly_score FROM dim_policy")
_REFUSED = "(SELECT count(*) FROM {0} WHERE {1} = 47) + (SELECT count(*) FROM {0} WHERE {1} = 43)"
add("stage_log", WIRE_STAR, f"""
SELECT 'landing' AS stage, (SELECT count(*) + count(*) FILTER (k = 61) FROM pol) + (SELECT count(*) + count(*) FILTER (j = 61) FROM clm) AS rows_in,
  (SELECT count(*) FROM pol WHERE k <> 47) + (SELECT count(*) FROM clm WHERE j <> 47) AS rows_out,
  {_REFUSED.format('pol', 'k')} + {_REFUSED.format('clm', 'j')} AS rows_rejected, 'SUCCESS' AS status
UNION ALL SELECT 'header_mapping', n, n, 0, 'SUCCESS' FROM (SELECT 6 + (SELECT count(DISTINCT k) FROM pol WHERE k = 73)
  + (SELECT count(DISTINCT loss_description IS NULL) FROM clm WHERE j = 73) AS n)
UNION ALL SELECT 'dq_policy', count(*), count(*) FILTER (dq_status <> 'FAIL'), count(*) FILTER (dq_status = 'FAIL'), 'SUCCESS' FROM pol_c
UNION ALL SELECT 'promote_policies', count(*), count(*), 0, 'SUCCESS' FROM dim_policy0
UNION ALL SELECT 'dq_claim', count(*), count(*) FILTER (dq_status <> 'FAIL'), count(*) FILTER (dq_status = 'FAIL'), 'SUCCESS' FROM clm_c
UNION ALL SELECT 'promote_claims', count(*), count(*), 0, 'SUCCESS' FROM fact_claim0
UNION ALL SELECT 'unmapped', 0, 0, 0, 'SUCCESS'""")
