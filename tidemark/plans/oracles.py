"""The SQL each registered query is checked against, over the plain test tables."""

from tidemark.functions.scalars import MIX_HIGH, MIX_PRIME, MIX_ROW, MIX_SALT, MIX_SPREAD
from tidemark.plans.inputs import load_time
from tidemark.plans.views import (
    AD_REVENUE,
    DELIVERIES,
    N_DELIVERIES,
    PARTNER_INVOICES,
    PAYMENTS,
)
from tidemark.schemas import WIRE_FIELDS
from tidemark.sources import synth

PAYMENT_FIELDS = ", ".join(WIRE_FIELDS["subscription_payment"])
INVOICE_FIELDS = ", ".join(WIRE_FIELDS["partner_invoice"])
AD_FIELDS = ", ".join(WIRE_FIELDS["ad_revenue"])

WITH_PAYMENTS = f"WITH {PAYMENTS}"
WITH_DELIVERIES = f"WITH {PAYMENTS}, {DELIVERIES}"
STORED = f"SELECT DISTINCT {PAYMENT_FIELDS}, batch_id FROM deliveries"

SHARDS = 8


def _money(column: str) -> str:
    return f"ROUND(SUM({column}), 2)"


def _shard(key: str) -> str:
    return f"CAST((CAST('0x' || substr(md5({key}), 1, 8) AS BIGINT) * {SHARDS}) >> 32 AS INT)"


def _stored(where: str = "TRUE") -> str:
    """What ingest keeps of the deliveries: one copy per event and batch."""
    return (
        f"{WITH_DELIVERIES}, stored AS ({STORED}) "
        f"SELECT {PAYMENT_FIELDS} FROM stored WHERE {where}"
    )


def _load_time_case() -> str:
    whens = " ".join(
        f"WHEN {n} THEN TIMESTAMP '{load_time(n)}'" for n in range(N_DELIVERIES)
    )
    return f"CASE batch_id {whens} END"


def _draw(row: str, salt: int, bound: int) -> str:
    """The mix of ``functions.scalars.draw`` for non-negative row ids."""
    p = MIX_PRIME
    low = f"({row} % {p})"
    start = f"(({low} * {MIX_ROW} + (({row} // {p}) % {p}) * {MIX_HIGH} + {salt * MIX_SALT}) % {p})"
    mixed = f"(({start} * {start} + {low}) % {p})"
    spread = f"(({mixed} * {MIX_SPREAD} + {start}) % {p})"
    return f"((({spread} * {spread} + {mixed}) % {p}) % {bound})"


def _choice(row: str, salt: int, choices: list[str]) -> str:
    whens = " ".join(f"WHEN {n} THEN '{c}'" for n, c in enumerate(choices))
    return f"CASE {_draw(row, salt, len(choices))} {whens} END"


def _synth() -> str:
    def number(salt: int, bounds: tuple[int, int]) -> str:
        return f"CAST({_draw('event_id', salt, bounds[1] - bounds[0] + 1)} + {bounds[0]} AS STRING)"

    prices = " ".join(f"WHEN '{tier}' THEN {price}" for tier, price in synth.TIER_PRICES.items())
    low, high = synth.EVENT_SUFFIXES
    size = high - low + 1
    failed_below = synth.SUCCEEDED_PERCENT + synth.FAILED_PERCENT
    return f"""
    WITH drawn AS (
      SELECT event_id AS id, ts, CAST(epoch_us(ts) // 1000 AS STRING) AS ms,
        CAST(event_id % {size} * {synth.SUFFIX_STEP} % {size} + {low} AS STRING) AS suffix,
        {_draw("event_id", synth.OUTCOME, 100)} AS roll,
        {_choice("event_id", synth.TIER, list(synth.TIER_PRICES))} AS tier,
        {_choice("event_id", synth.COUNTRY, synth.COUNTRIES)} AS country,
        {_choice("event_id", synth.PROCESSOR, synth.PROCESSORS)} AS processor,
        {number(synth.CUSTOMER, synth.CUSTOMER_IDS)} AS customer,
        {number(synth.USER, synth.USER_IDS)} AS usr,
        {number(synth.SUBSCRIPTION, synth.SUBSCRIPTION_IDS)} AS subscription,
        {number(synth.ORIGINAL, synth.EVENT_SUFFIXES)} AS original
      FROM events),
    priced AS (
      SELECT *, CAST(CASE tier {prices} END AS DOUBLE) AS price,
        CASE WHEN roll < {synth.SUCCEEDED_PERCENT} THEN 'succeeded'
             WHEN roll < {failed_below} THEN 'failed' ELSE 'refunded' END AS outcome
      FROM drawn)
    SELECT 'evt_' || ms || '_' || suffix AS event_id,
      'payment.' || outcome AS event_type,
      {_iso("ts")} AS event_timestamp,
      'pay_' || ms || '_' || suffix AS payment_id,
      'cus_' || customer AS customer_id,
      'user_' || usr AS user_id,
      'sub_' || subscription AS subscription_id,
      CASE outcome WHEN 'succeeded' THEN price WHEN 'failed' THEN 0.0 ELSE -price END
        AS amount_usd,
      '{synth.CURRENCY}' AS currency,
      CASE outcome WHEN 'failed' THEN 'failed' ELSE 'succeeded' END AS status,
      tier AS subscription_tier,
      country AS country_code,
      processor AS payment_processor,
      strftime(ts, '%Y-%m') AS billing_period,
      outcome = 'refunded' AS is_refund,
      CASE WHEN outcome = 'refunded' THEN 'pay_' || ms || '_' || original END
        AS original_payment_id
    FROM priced"""


def _iso(time: str) -> str:
    return f"strftime({time}, '%Y-%m-%dT%H:%M:%S.%f+00:00')"


def _wire_json() -> str:
    """The JSON text of a payment, built field by field."""
    texts = {
        "event_timestamp": f"'\"' || {_iso('event_timestamp')} || '\"'",
        "amount_usd": "CAST(amount_usd AS STRING)",
        "is_refund": "CAST(is_refund AS STRING)",
    }
    parts = []
    for name in WIRE_FIELDS["subscription_payment"]:
        text = texts.get(name, f"'\"' || {name} || '\"'")
        parts.append(f"'\"{name}\":' || COALESCE({text}, 'null')")
    return "'{' || " + " || ',' || ".join(parts) + " || '}'"


FLAGSHIP = (
    f"SELECT subscription_tier, COUNT(*) AS n_events, {_money('amount_usd')} AS revenue_usd "
    "FROM {rows} WHERE status = 'succeeded' GROUP BY subscription_tier"
)

ORACLES: dict[str, str] = {
    "revenue_by_tier": f"{WITH_PAYMENTS} {FLAGSHIP.format(rows='payments')}",
    "revenue_by_partner": f"""WITH {PARTNER_INVOICES}
        SELECT partner_name, COUNT(*) AS n_events, {_money("total_amount_usd")} AS revenue_usd
        FROM partner_invoices WHERE status = 'paid' GROUP BY partner_name""",
    "revenue_by_advertiser": f"""WITH {AD_REVENUE}
        SELECT advertiser_name, COUNT(*) AS n_events, {_money("revenue_usd")} AS revenue_usd
        FROM ad_revenue GROUP BY advertiser_name""",
    "revenue_from_wire": f"""{WITH_DELIVERIES},
        kept AS (SELECT DISTINCT {PAYMENT_FIELDS} FROM deliveries)
        {FLAGSHIP.format(rows="kept")}""",
    "filter_succeeded": f"""{WITH_PAYMENTS}
        SELECT {PAYMENT_FIELDS} FROM payments WHERE status = 'succeeded'""",
    "event_mix_shares": f"""{WITH_PAYMENTS}
        SELECT event_type, status, is_refund, COUNT(*) AS n_events,
          ROUND(COUNT(*) / SUM(COUNT(*)) OVER (), 6) AS share,
          {_money("amount_usd")} AS amount_usd
        FROM payments GROUP BY event_type, status, is_refund""",
    "decode_payments": f"{WITH_PAYMENTS} SELECT {PAYMENT_FIELDS} FROM payments",
    "decode_invoices": f"WITH {PARTNER_INVOICES} SELECT {INVOICE_FIELDS} FROM partner_invoices",
    "decode_ads": f"WITH {AD_REVENUE} SELECT {AD_FIELDS} FROM ad_revenue",
    "decode_malformed": f"""{WITH_PAYMENTS}
        SELECT seq,
          CASE WHEN seq % 13 IN (0, 5, 6, 8, 9, 12) THEN event_id
               WHEN seq % 13 = 7 THEN CAST(seq AS STRING) END AS event_id,
          CASE seq % 13 WHEN 9 THEN TIMESTAMP '2024-01-15 00:00:00'
               WHEN 12 THEN TIMESTAMP '2024-01-15 00:00:00.5' END AS event_timestamp,
          CASE WHEN seq % 13 IN (0, 6, 7, 11) THEN status
               WHEN seq % 13 = 5 THEN 'open' END AS status,
          CASE WHEN seq % 13 IN (0, 6, 7, 11) THEN amount_usd END AS amount_usd,
          CASE WHEN seq % 13 = 0 THEN FALSE END AS is_refund,
          CAST(NULL AS STRING) AS payment_id
        FROM payments""",
    "wire_encode": f"""{WITH_PAYMENTS}
        SELECT customer_id AS partition_key, {_wire_json()} AS data FROM payments""",
    "customer_routing": f"""{WITH_PAYMENTS}
        SELECT customer_id AS partition_key, {_shard("customer_id")} AS shard,
          {_shard("customer_id")} AS last_shard, COUNT(*) AS n_records
        FROM payments GROUP BY customer_id""",
    "delivery_counts_by_shard": f"""{WITH_PAYMENTS},
        records AS (SELECT CASE WHEN seq % 97 <> 0 THEN customer_id END AS k FROM payments)
        SELECT {_shard("k")} AS shard, COUNT(k) AS delivered, COUNT(*) - COUNT(k) AS failed
        FROM records GROUP BY 1""",
    "synth_payments": _synth(),
    "net_revenue_by_period": f"""{WITH_PAYMENTS}
        SELECT billing_period, country_code, payment_processor,
          ROUND(SUM(CASE WHEN is_refund THEN 0.0::DOUBLE ELSE amount_usd END), 2) AS gross_usd,
          ROUND(SUM(CASE WHEN is_refund THEN -amount_usd ELSE 0.0::DOUBLE END), 2) AS refund_usd,
          {_money("amount_usd")} AS net_usd
        FROM payments WHERE status = 'succeeded' GROUP BY ALL""",
    "unified_revenue_by_period": f"""WITH {PAYMENTS}, {PARTNER_INVOICES}, {AD_REVENUE},
        parts AS (
          SELECT billing_period, country_code, 'payments' AS feed, amount_usd AS amount
          FROM payments WHERE status = 'succeeded'
          UNION ALL
          SELECT billing_period, country_code, 'partner_invoices', total_amount_usd
          FROM partner_invoices WHERE status = 'paid'
          UNION ALL
          SELECT billing_period, country_code, 'ad_revenue', revenue_usd FROM ad_revenue)
        SELECT billing_period, country_code, feed, COUNT(*) AS n_events,
          {_money("amount")} AS revenue_usd
        FROM parts GROUP BY ALL""",
    "refund_link": f"""{WITH_PAYMENTS}
        SELECT r.original_payment_id, r.payment_id AS refund_id, r.amount_usd AS refund_usd,
          p.amount_usd AS original_usd, p.status AS original_status
        FROM payments r LEFT JOIN payments p
          ON p.payment_id = r.original_payment_id AND NOT p.is_refund
        WHERE r.is_refund""",
    "event_rate": f"""{WITH_PAYMENTS}
        SELECT CAST(date_trunc('minute', event_timestamp) AS TIMESTAMP) AS minute, event_type,
          COUNT(*) AS n_events
        FROM payments GROUP BY 1, 2""",
    "invoice_reconcile": f"""WITH {PARTNER_INVOICES}
        SELECT invoice_id, partner_name, total_amount_usd,
          total_subscriptions * revenue_per_sub AS expected_usd,
          ROUND(total_amount_usd - total_subscriptions * revenue_per_sub, 2) AS difference_usd
        FROM partner_invoices
        WHERE ROUND(total_amount_usd - total_subscriptions * revenue_per_sub, 2) <> 0""",
    "ad_fill_by_advertiser": f"""WITH {AD_REVENUE}, sums AS (
          SELECT advertiser_name, billing_period,
            CAST(SUM(impression_count) AS BIGINT) AS impressions,
            CAST(SUM(billable_impressions) AS BIGINT) AS billable,
            SUM(revenue_usd) AS revenue_usd
          FROM ad_revenue GROUP BY ALL)
        SELECT * REPLACE (ROUND(revenue_usd, 2) AS revenue_usd),
          ROUND(billable / impressions, 4) AS fill_rate,
          ROUND(revenue_usd * 1000 / billable, 2) AS revenue_per_thousand
        FROM sums""",
    "quarantine": f"""{WITH_PAYMENTS}
        SELECT seq AS "row", substr({_wire_json()}, 1, 40) AS data
        FROM payments WHERE seq % 5 = 0""",
    "dedup_in_batch": f"{WITH_DELIVERIES} {STORED}",
    "dedup_null_keys": f"""{WITH_DELIVERIES}
        SELECT DISTINCT batch_id, CASE WHEN seq % 3 <> 0 THEN event_id END AS event_id,
          CASE WHEN seq % 3 <> 0 THEN payment_id END AS payment_id
        FROM deliveries""",
    "table_create_append": _stored(),
    "concurrent_loads": _stored(),
    "as_of_batch_read": _stored("batch_id <= 2"),
    "as_of_time_read": _stored("batch_id <= 1"),
    "ingest_columns": f"""{WITH_DELIVERIES}, stored AS ({STORED})
        SELECT {_load_time_case()} AS ingestion_timestamp,
          CAST({_load_time_case()} AS DATE) AS ingestion_date, COUNT(*) AS n_rows
        FROM stored GROUP BY 1, 2""",
    "latency_by_load": f"""{WITH_DELIVERIES}, stored AS ({STORED}),
        delays AS (
          SELECT {_load_time_case()} AS loaded,
            epoch_us({_load_time_case()}) // 1000 - epoch_us(event_timestamp) // 1000 AS ms
          FROM stored)
        SELECT CAST(loaded AS DATE) AS ingestion_date, COUNT(*) AS n_events,
          MIN(ms) AS min_ms, MAX(ms) AS max_ms,
          COUNT(CASE WHEN ms <= 604800000 THEN 1 END) AS within_week,
          COUNT(CASE WHEN ms <= 2419200000 THEN 1 END) AS within_month,
          TRUE AS p50_in_rank, TRUE AS p95_in_rank
        FROM delays GROUP BY 1""",
    "batch_reports": f"""{WITH_DELIVERIES}
        SELECT batch_id, COUNT(*) AS received,
          COUNT(CASE WHEN seq % 5 = 0 THEN 1 END) AS undecodable,
          COUNT(DISTINCT CASE WHEN seq % 5 = 0 THEN 'none' ELSE event_id END) AS stored
        FROM deliveries GROUP BY batch_id""",
    "schema_evolution": f"""{WITH_DELIVERIES}, stored AS ({STORED})
        SELECT {PAYMENT_FIELDS}, CAST(NULL AS BOOLEAN) AS is_trial,
          CASE WHEN batch_id >= 2 THEN amount_usd = 0 END AS is_free
        FROM stored""",
    "revenue_sql": f"""{WITH_DELIVERIES}, stored AS ({STORED})
        SELECT subscription_tier, COUNT(*) AS n_events, ROUND(SUM(amount_usd), 2) AS revenue_usd
        FROM stored WHERE status = 'succeeded' GROUP BY subscription_tier""",
    "codec_of_files": f"""{WITH_DELIVERIES}, stored AS ({STORED})
        SELECT 'zstd' AS codec, COUNT(*) AS n_rows FROM stored""",
    "closed_days": _stored("batch_id <= 3"),
    "stream_ingest": _stored(),
    "stream_ingest_columns": f"""{WITH_DELIVERIES}, stored AS ({STORED})
        SELECT batch_id, COUNT(*) AS n_rows, CAST(1 AS BIGINT) AS n_stamps, TRUE AS same_day
        FROM stored GROUP BY batch_id""",
    "stream_ingest_replay": _stored(),
    "stream_dedup_ingest_time": f"{WITH_PAYMENTS} SELECT {PAYMENT_FIELDS} FROM payments",
    "stream_dedup_watermark": f"{WITH_PAYMENTS} SELECT {PAYMENT_FIELDS} FROM payments",
    "start_position_latest": _stored("batch_id >= 2"),
    "stream_dedup_history": f"{WITH_PAYMENTS} SELECT {PAYMENT_FIELDS} FROM payments",
    "stream_shard_offsets": _stored(),
    "stream_from_source": f"{WITH_PAYMENTS} SELECT {PAYMENT_FIELDS} FROM payments",
    "stream_event_rate": f"""{WITH_PAYMENTS}
        SELECT date_trunc('minute', event_timestamp) AS minute, event_type, COUNT(*) AS n_events
        FROM payments
        WHERE date_trunc('minute', event_timestamp) + INTERVAL 1 MINUTE
          <= (SELECT MAX(event_timestamp) - INTERVAL 2 DAY FROM payments)
        GROUP BY 1, 2""",
    "stream_quarantine": f"""{WITH_PAYMENTS}, texts AS (
          SELECT seq % 13 AS kind, event_id,
            '"status":"' || status || '","amount_usd":' || CAST(amount_usd AS STRING) AS body,
            '{{"event_id":"' || event_id || '",' AS start
          FROM payments),
        lost AS (
          SELECT CASE kind WHEN 1 THEN 'not json ' || event_id
                   WHEN 2 THEN ''
                   WHEN 4 THEN start || body
                   WHEN 10 THEN '[' || start || body || ',"is_refund":false}},'
                     || start || body || ',"is_refund":false}}]'
                   WHEN 11 THEN '{{"EVENT_ID":"' || event_id || '","extra":{{"a":[1,2]}},'
                     || body || '}}' END AS payload,
            CASE kind WHEN 2 THEN 'empty' WHEN 3 THEN 'no payload' WHEN 10 THEN 'no object'
                 WHEN 11 THEN 'no event id' ELSE 'not JSON' END AS cause
          FROM texts WHERE kind IN (1, 2, 3, 4, 10, 11))
        SELECT payload, cause, COUNT(*) AS n_records FROM lost GROUP BY ALL""",
    "stream_options": f"""{WITH_DELIVERIES}
        SELECT batch_id, COUNT(*) AS received FROM deliveries GROUP BY batch_id""",
    "three_feeds": f"""WITH {PAYMENTS}, {PARTNER_INVOICES}, {AD_REVENUE}
        SELECT 'payments' AS feed, COUNT(*) AS n_events, {_money("amount_usd")} AS revenue_usd
        FROM payments
        UNION ALL
        SELECT 'partner_invoices', COUNT(*), {_money("total_amount_usd")} FROM partner_invoices
        UNION ALL
        SELECT 'ad_revenue', COUNT(*), {_money("revenue_usd")}
        FROM (SELECT DISTINCT event_id, revenue_usd FROM ad_revenue)""",
}
