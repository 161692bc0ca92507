"""Event feeds derived from the test tables, as SQL both engines run unchanged.

The feeds have the columns of the wire schemas. Payments follow the event mix
and price list of the generator; invoice states, partners and advertisers are
invented, since only their columns are given.
"""

PAYMENTS = """
payments AS (
  SELECT
    'evt_' || CAST(event_id AS STRING) AS event_id,
    CASE WHEN event_id % 20 < 17 THEN 'payment.succeeded'
         WHEN event_id % 20 < 19 THEN 'payment.failed'
         ELSE 'payment.refunded' END AS event_type,
    ts AS event_timestamp,
    'pay_' || CAST(event_id AS STRING) AS payment_id,
    'cus_' || CAST(user_id AS STRING) AS customer_id,
    'user_' || CAST(user_id AS STRING) AS user_id,
    'sub_' || CAST(user_id AS STRING) AS subscription_id,
    CAST(CASE WHEN event_id % 20 < 17 THEN 1 WHEN event_id % 20 < 19 THEN 0 ELSE -1 END
      * CASE user_id % 4 WHEN 0 THEN 9.99 WHEN 1 THEN 15.49 WHEN 2 THEN 19.99 ELSE 6.99 END
      AS DOUBLE) AS amount_usd,
    'USD' AS currency,
    CASE WHEN event_id % 20 IN (17, 18) THEN 'failed' ELSE 'succeeded' END AS status,
    CASE user_id % 4 WHEN 0 THEN 'basic' WHEN 1 THEN 'standard' WHEN 2 THEN 'premium'
         ELSE 'basic_ads' END AS subscription_tier,
    CASE user_id % 9 WHEN 0 THEN 'US' WHEN 1 THEN 'CA' WHEN 2 THEN 'GB' WHEN 3 THEN 'DE'
         WHEN 4 THEN 'FR' WHEN 5 THEN 'BR' WHEN 6 THEN 'MX' WHEN 7 THEN 'JP'
         ELSE 'AU' END AS country_code,
    CASE user_id % 2 WHEN 0 THEN 'stripe' ELSE 'adyen' END AS payment_processor,
    substr(CAST(ts AS STRING), 1, 7) AS billing_period,
    event_id % 20 = 19 AS is_refund,
    CASE WHEN event_id % 20 = 19 THEN 'pay_' || CAST(event_id - 10 AS STRING) END
      AS original_payment_id,
    event_id AS seq
  FROM events
)"""

PARTNER_INVOICES = """
partner_invoices AS (
  SELECT
    'inv_evt_' || CAST(o_orderkey AS STRING) AS event_id,
    'invoice.issued' AS event_type,
    o_orderdate AS event_timestamp,
    'inv_' || CAST(o_orderkey AS STRING) AS invoice_id,
    'partner_' || CAST(o_custkey % 12 AS STRING) AS partner_name,
    substr(CAST(o_orderdate AS STRING), 1, 7) AS billing_period,
    CAST(o_custkey % 500 + 1 AS INT) AS total_subscriptions,
    CAST(CASE o_custkey % 3 WHEN 0 THEN 4.25 WHEN 1 THEN 5.50 ELSE 7.00 END AS DOUBLE)
      AS revenue_per_sub,
    CAST((o_custkey % 500 + 1)
      * CASE o_custkey % 3 WHEN 0 THEN 4.25 WHEN 1 THEN 5.50 ELSE 7.00 END
      + CASE WHEN o_orderkey % 25 = 0 THEN 1.00 ELSE 0.00 END AS DOUBLE) AS total_amount_usd,
    CASE o_orderstatus WHEN 'F' THEN 'paid' WHEN 'O' THEN 'open' ELSE 'overdue' END AS status,
    CASE WHEN o_orderstatus = 'F' THEN substr(CAST(o_orderdate AS STRING), 1, 10) END
      AS paid_date,
    CASE o_custkey % 3 WHEN 0 THEN 'US' WHEN 1 THEN 'GB' ELSE 'JP' END AS country_code
  FROM orders
)"""

AD_REVENUE = """
ad_revenue AS (
  SELECT
    'ad_evt_' || CAST(l_orderkey AS STRING) || '_' || CAST(l_linenumber AS STRING)
      || '_' || CAST(l_partkey AS STRING) || '_' || CAST(l_suppkey AS STRING)
      || '_' || CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS STRING) AS event_id,
    'ad.delivered' AS event_type,
    l_shipdate AS event_timestamp,
    'adv_' || CAST(l_suppkey % 40 AS STRING) AS advertiser_name,
    CASE l_partkey % 3 WHEN 0 THEN 'US' WHEN 1 THEN 'GB' ELSE 'JP' END AS country_code,
    CAST(l_quantity * 1000 AS INT) AS impression_count,
    CAST(l_quantity * (1000 - l_linenumber * 20) AS INT) AS billable_impressions,
    l_extendedprice AS revenue_usd,
    substr(CAST(l_shipdate AS STRING), 1, 7) AS billing_period
  FROM lineitem
)"""

# Days at which one delivery of payments ends and the next begins.
CUTS = ("2024-01-09", "2024-01-17", "2024-01-25")
N_DELIVERIES = len(CUTS) + 2
FIRST_DELIVERY = (
    "CASE "
    + " ".join(f"WHEN event_timestamp < DATE '{day}' THEN {n}" for n, day in enumerate(CUTS))
    + f" ELSE {len(CUTS)} END"
)

# Redelivery: every 14th event comes twice in one delivery, another 14th comes
# again in the next one.
TWICE = "seq % 14 = 0"
AGAIN = "seq % 14 = 7"

DELIVERIES = f"""
deliveries AS (
  SELECT *, CAST({FIRST_DELIVERY} AS BIGINT) AS batch_id FROM payments
  UNION ALL
  SELECT *, CAST({FIRST_DELIVERY} AS BIGINT) AS batch_id FROM payments WHERE {TWICE}
  UNION ALL
  SELECT *, CAST({FIRST_DELIVERY} AS BIGINT) + 1 AS batch_id FROM payments WHERE {AGAIN}
)"""

# The table behind each view and the wire fields in their order.
SOURCES = {"payments": "events", "partner_invoices": "orders", "ad_revenue": "lineitem"}
TEXTS = {"payments": PAYMENTS, "partner_invoices": PARTNER_INVOICES, "ad_revenue": AD_REVENUE}
