"""What each query must return, as SQL for DuckDB over the given tables.

Money is added up as exact decimals and cast to double once, at the end.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {}

# ------------------------------------------------------------------ shared CTEs

FACTS = """
lines AS (
    SELECT l_orderkey,
           sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS gross,
           sum(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2))) AS discount,
           sum(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2))) AS tax
    FROM lineitem GROUP BY l_orderkey
),
order_facts AS (
    SELECT o_orderkey AS k, o_orderstatus AS code, o_orderdate AS day_start,
           o_orderdate + to_hours(o_orderkey % 24) + to_minutes(o_orderkey % 60) AS moment,
           CAST(coalesce(gross, 0) AS DECIMAL(20,2)) AS gross,
           CAST(coalesce(discount, 0) AS DECIMAL(20,4)) AS discount,
           CAST(coalesce(gross - discount, 0) AS DECIMAL(20,4)) AS net,
           CAST(coalesce(tax, 0) AS DECIMAL(20,4)) AS tax
    FROM orders LEFT JOIN lines ON o_orderkey = l_orderkey
),
ad_facts AS (
    SELECT event_id AS e, event_type AS kind, CAST(ts AS DATE) - 10602 AS day,
           CAST(value AS DECIMAL(12,2)) AS value
    FROM events
)"""

TAGGED = (
    FACTS
    + """,
order_rows AS (
    SELECT f.*, slot, k * 2 + slot AS row_position,
           CASE WHEN k % 106 = 0 THEN 1 - slot ELSE slot END AS copy,
           CASE WHEN k % 41 = 0 THEN 'under_review' WHEN k % 83 = 0 THEN 'disputed'
                WHEN code = 'F' THEN 'paid' WHEN code = 'P' THEN 'partially_paid'
                ELSE 'pending' END AS status
    FROM order_facts f, (VALUES (0), (1)) s(slot)
    WHERE slot = 0 OR k % 53 = 0
),
tagged_orders AS (
    SELECT *, CASE WHEN k % 211 = 0 THEN 'empty_row'
                   WHEN k % 89 = 0 THEN 'missing_required_value'
                   WHEN slot = 1 THEN 'duplicate_order_id'
                   WHEN k % 101 = 0 THEN 'invalid_created_at'
                   WHEN k % 97 = 0 THEN 'invalid_money'
                   WHEN status NOT IN ('paid', 'partially_paid') THEN 'excluded_status'
              END AS reason
    FROM order_rows
),
tagged_ads AS (
    SELECT *, CASE WHEN e % 211 = 0 THEN 'empty_row'
                   WHEN e % 89 = 0 THEN 'missing_required_value'
                   WHEN e % 101 = 0 THEN 'invalid_meta_date'
                   WHEN e % 103 = 0 THEN 'multi_day_interval'
                   WHEN e % 97 = 0 THEN 'invalid_spend'
              END AS reason
    FROM ad_facts
),
raw_oc AS (
    SELECT 'S' || k AS order_id,
           CASE WHEN k % 7 = 6 THEN day_start ELSE moment END AS created_at_utc,
           status AS financial_status,
           gross * (copy + 1) AS gross,
           CASE WHEN k % 61 = 0 THEN 0 WHEN k % 43 = 0 THEN -discount ELSE discount END
               * (copy + 1) AS discount,
           net * (copy + 1) AS net, tax * (copy + 1) AS tax
    FROM tagged_orders WHERE reason IS NULL
),
raw_ac AS (
    SELECT day AS d,
           CASE WHEN e % 37 <> 0 AND e % 31 <> 0 THEN 'Spring Sale ' || kind END AS campaign_name,
           value,
           CASE WHEN day(day) % 10 <> 3 THEN CASE kind
               WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 10 END
           END AS impressions,
           CASE WHEN day(day) % 10 <> 3 THEN CASE kind WHEN 'click' THEN 1 WHEN 'view' THEN 0 END
           END AS link_clicks
    FROM tagged_ads WHERE reason IS NULL
)"""
)

_ORDERS_DAILY = """
    SELECT d, CAST(sum(gross) AS DOUBLE) AS gross_revenue,
           CAST(sum(discount) AS DOUBLE) AS discount_amount,
           CAST(sum(net) AS DOUBLE) AS net_revenue,
           CAST(sum(tax) AS DOUBLE) AS taxes,
           CAST(0 AS DOUBLE) AS shipping_fees,
           count(DISTINCT order_id) AS orders, 'ETB' AS currency
    FROM oc GROUP BY d"""

_ADS_DAILY = """
    SELECT d, CAST(CAST(sum(value) AS DECIMAL(20,2)) * 130 AS DOUBLE) AS ad_spend,
           CAST(sum(impressions) AS BIGINT) AS impressions,
           CAST(sum(link_clicks) AS BIGINT) AS link_clicks,
           count(*) AS meta_row_count, 'ETB' AS currency
    FROM ac GROUP BY d"""

TYPED = (
    FACTS
    + f""",
oc AS (
    SELECT CAST(k AS VARCHAR) AS order_id, CAST(moment + INTERVAL 3 HOUR AS DATE) AS d,
           gross, discount, net, tax
    FROM order_facts WHERE code IN ('F', 'P')
),
ac AS (
    SELECT day AS d, value,
           CASE WHEN day(day) % 10 <> 3 THEN CAST(kind = 'view' AS BIGINT) END AS impressions,
           CASE WHEN day(day) % 10 <> 3 THEN CAST(kind = 'click' AS BIGINT) END AS link_clicks
    FROM ad_facts
),
od AS ({_ORDERS_DAILY}),
ad AS ({_ADS_DAILY})"""
)

FROM_TEXT = (
    TAGGED
    + f""",
oc AS (SELECT *, CAST(created_at_utc + INTERVAL 3 HOUR AS DATE) AS d FROM raw_oc),
ac AS (SELECT * FROM raw_ac),
od AS ({_ORDERS_DAILY}),
ad AS ({_ADS_DAILY})"""
)

_SPINE = """
bounds AS (
    SELECT min(d) AS min_d, max(d) AS max_d
    FROM (SELECT d FROM od UNION ALL SELECT d FROM ad) days
),
spine AS (
    SELECT CAST(unnest(generate_series(CAST(min_d AS TIMESTAMP), CAST(max_d AS TIMESTAMP),
                                       INTERVAL 1 DAY)) AS DATE) AS d
    FROM bounds
)"""


def _model(base: str, cogs: str = "0.4") -> str:
    return f"""{base},{_SPINE},
joined AS (
    SELECT d AS calendar_date,
           coalesce(gross_revenue, 0.0) AS gross_revenue,
           coalesce(discount_amount, 0.0) AS discount_amount,
           coalesce(net_revenue, 0.0) AS net_revenue,
           coalesce(taxes, 0.0) AS taxes,
           coalesce(shipping_fees, 0.0) AS shipping_fees,
           coalesce(orders, 0) AS orders,
           coalesce(ad_spend, 0.0) AS ad_spend,
           impressions, link_clicks,
           coalesce(od.currency, ad.currency) AS reporting_currency
    FROM spine LEFT JOIN od USING (d) LEFT JOIN ad USING (d)
),
model AS (
    SELECT calendar_date, gross_revenue, discount_amount, net_revenue, taxes, shipping_fees,
           orders, ad_spend, impressions, link_clicks,
           gross_revenue * CAST({cogs} AS DOUBLE) AS cogs_estimate,
           net_revenue - ad_spend - gross_revenue * CAST({cogs} AS DOUBLE) AS contribution_margin,
           CASE WHEN ad_spend > 0 THEN net_revenue / ad_spend END AS roas,
           CASE WHEN net_revenue > 0 THEN ad_spend / net_revenue END AS mer,
           CASE WHEN net_revenue > 0
                THEN (net_revenue - ad_spend - gross_revenue * CAST({cogs} AS DOUBLE)) / net_revenue
           END AS profit_margin,
           reporting_currency
    FROM joined
)"""


def _exact(column: str) -> str:
    held = f"CAST({column} AS DECIMAL(26,8))"
    return (
        f"coalesce(CAST(sum({held}) AS DOUBLE) + sum({column} - CAST({held} AS DOUBLE)), 0.0)"
    )


# ------------------------------------------------------------------ expressions

ORACLES["money_parse"] = f"""
WITH {FACTS}
SELECT k, CASE WHEN k % 97 = 0 THEN NULL WHEN k % 43 = 0 THEN CAST(-net AS DOUBLE)
               ELSE CAST(net AS DOUBLE) END AS amount
FROM order_facts"""

ORACLES["timestamp_parse"] = f"""
WITH {FACTS}
SELECT k, CASE WHEN k % 101 = 0 THEN NULL WHEN k % 7 = 6 THEN day_start ELSE moment END
              AS created_at_utc
FROM order_facts"""

ORACLES["reporting_date"] = f"""
WITH {FACTS}
SELECT k, CAST(moment + INTERVAL 3 HOUR AS DATE) AS calendar_date FROM order_facts"""

ORACLES["date_parse"] = f"""
WITH {FACTS}
SELECT e, CASE WHEN e % 101 <> 0 AND e % 97 <> 0 THEN day END AS day FROM ad_facts"""

ORACLES["status_normalize"] = f"""
WITH {FACTS}
SELECT k, CASE WHEN k % 41 = 0 THEN 'under_review' WHEN k % 83 = 0 THEN 'disputed'
               WHEN code = 'F' THEN 'paid' WHEN code = 'P' THEN 'partially_paid'
               ELSE 'pending' END AS financial_status
FROM order_facts"""

ORACLES["campaign_normalize"] = f"""
WITH {FACTS}
SELECT e, CASE WHEN e % 37 <> 0 AND e % 31 <> 0 THEN 'Spring Sale ' || kind END AS campaign_name
FROM ad_facts"""

ORACLES["counter_parse"] = f"""
WITH {FACTS}
SELECT e, CASE WHEN e % 97 <> 0 THEN CAST(trunc(value) AS BIGINT) END AS n FROM ad_facts"""

ORACLES["fx_convert"] = f"""
WITH {FACTS}
SELECT e, CAST(value AS DOUBLE) * CAST(130 AS DOUBLE) AS converted,
       CAST(value AS DOUBLE) AS unchanged
FROM ad_facts"""

# ----------------------------------------------------------------- data quality

ORACLES["required_values"] = f"""
WITH {TAGGED}
SELECT row_position FROM tagged_orders WHERE reason = 'missing_required_value'"""

ORACLES["empty_rows"] = f"""
WITH {TAGGED}
SELECT e AS row_position FROM tagged_ads WHERE reason = 'empty_row'"""

ORACLES["dedupe_first"] = f"""
WITH {TAGGED},
valid AS (
    SELECT 'S' || k AS order_id, row_position,
           row_number() OVER (PARTITION BY k ORDER BY row_position) AS rn
    FROM tagged_orders
    WHERE reason IS NULL OR reason NOT IN ('empty_row', 'missing_required_value')
)
SELECT order_id, row_position FROM valid WHERE rn = 1"""

ORACLES["dq_report_orders"] = f"""
WITH {TAGGED}
SELECT 'orders' AS source, reason AS rejection_reason, count(*) AS n
FROM tagged_orders WHERE reason IS NOT NULL GROUP BY reason"""

ORACLES["dq_report_ads"] = f"""
WITH {TAGGED}
SELECT 'ads' AS source, reason AS rejection_reason, count(*) AS n
FROM tagged_ads WHERE reason IS NOT NULL GROUP BY reason"""

ORACLES["dq_gate"] = f"""
WITH {TAGGED},
counts AS (
    SELECT 'orders' AS source, count(*) AS rows_received,
           count(*) FILTER (reason IN ('empty_row', 'missing_required_value',
                                       'duplicate_order_id')) AS rows_rejected
    FROM tagged_orders
    UNION ALL
    SELECT 'ads', count(*),
           count(*) FILTER (reason IN ('empty_row', 'missing_required_value'))
    FROM tagged_ads
)
SELECT source, rows_received, rows_received - rows_rejected AS rows_accepted, rows_rejected,
       CAST(rows_rejected AS DOUBLE) / CAST(rows_received AS DOUBLE) AS rejection_rate,
       CAST(0.05 AS DOUBLE) AS threshold,
       CAST(rows_rejected AS DOUBLE) / CAST(rows_received AS DOUBLE) > CAST(0.05 AS DOUBLE)
           AS exceeds
FROM counts"""

ORACLES["unknown_statuses"] = f"""
WITH {TAGGED}
SELECT status AS financial_status, count(*) AS n FROM tagged_orders
WHERE reason = 'excluded_status' AND status IN ('under_review', 'disputed')
GROUP BY status ORDER BY status"""

ORACLES["interval_samples"] = f"""
WITH {TAGGED}
SELECT day AS reporting_start FROM tagged_ads
WHERE reason = 'multi_day_interval' ORDER BY e LIMIT 3"""

# --------------------------------------------------------- clean rows and model

ORACLES["orders_clean"] = f"""
WITH {TAGGED}
SELECT order_id, CAST(created_at_utc + INTERVAL 3 HOUR AS DATE) AS calendar_date, created_at_utc,
       financial_status, CAST(gross AS DOUBLE) AS gross_amount,
       CAST(discount AS DOUBLE) AS discount_amount, CAST(net AS DOUBLE) AS net_amount,
       CAST(tax AS DOUBLE) AS taxes, CAST(0 AS DOUBLE) AS shipping_fees,
       'ETB' AS reporting_currency
FROM raw_oc"""

ORACLES["ads_clean"] = f"""
WITH {TAGGED}
SELECT d AS calendar_date, campaign_name,
       CAST(value AS DOUBLE) * CAST(130 AS DOUBLE) AS spend_amount,
       CAST(impressions AS BIGINT) AS impressions, CAST(link_clicks AS BIGINT) AS link_clicks,
       'ETB' AS reporting_currency
FROM raw_ac"""

ORACLES["orders_daily"] = f"""
WITH {TYPED}
SELECT d AS calendar_date, gross_revenue, discount_amount, net_revenue, taxes, shipping_fees,
       orders, CASE WHEN orders > 0 THEN discount_amount / orders END AS avg_discount_per_order,
       currency AS reporting_currency
FROM od"""

ORACLES["ads_daily"] = f"""
WITH {TYPED}
SELECT d AS calendar_date, ad_spend, impressions, link_clicks, meta_row_count,
       currency AS reporting_currency
FROM ad"""

ORACLES["date_spine"] = f"""
WITH {TYPED},{_SPINE}
SELECT d AS calendar_date FROM spine ORDER BY d"""

_SELECT_MODEL = "SELECT * FROM model ORDER BY calendar_date"

ORACLES["daily_model"] = f"WITH {_model(TYPED)}\n{_SELECT_MODEL}"
ORACLES["daily_model_cogs25"] = f"WITH {_model(TYPED, '0.25')}\n{_SELECT_MODEL}"
ORACLES["end_to_end_model"] = f"WITH {_model(FROM_TEXT)}\n{_SELECT_MODEL}"

# -------------------------------------------------------------------- reporting

_IN_RANGE = "calendar_date BETWEEN DATE '1995-01-10' AND DATE '1996-06-30'"

ORACLES["model_date_range"] = f"""
WITH {_model(TYPED)}
SELECT * FROM model WHERE {_IN_RANGE} ORDER BY calendar_date"""

ORACLES["model_bounds"] = f"""
WITH {_model(TYPED)}
SELECT min(calendar_date) AS min_d, max(calendar_date) AS max_d FROM model"""

ORACLES["run_summary"] = f"""
WITH {_model(TYPED)}
SELECT min(calendar_date) AS dates_min, max(calendar_date) AS dates_max,
       {_exact("net_revenue")} AS total_net_revenue,
       {_exact("ad_spend")} AS total_ad_spend,
       {_exact("contribution_margin")} AS total_contribution_margin,
       coalesce(max(reporting_currency), '?') AS currency
FROM model"""


def _kpis(where: str) -> str:
    return f"""
WITH {_model(TYPED)},
totals AS (
    SELECT {_exact("net_revenue")} AS total_net_revenue,
           {_exact("ad_spend")} AS total_ad_spend,
           {_exact("contribution_margin")} AS total_contribution_margin,
           CAST(coalesce(sum(orders), 0) AS BIGINT) AS total_orders,
           date_diff('day', min(calendar_date), max(calendar_date)) + 1 AS days
    FROM model WHERE {where}
)
SELECT total_net_revenue, total_ad_spend, total_contribution_margin,
       CASE WHEN total_net_revenue > 0
            THEN total_contribution_margin / total_net_revenue END AS profit_margin,
       CASE WHEN total_ad_spend > 0 THEN total_net_revenue / total_ad_spend END AS blended_roas,
       CASE WHEN total_net_revenue > 0
            THEN total_ad_spend / total_net_revenue END AS meta_spend_ratio,
       total_orders,
       round_even(CAST(4 AS DOUBLE) * (CAST(days AS DOUBLE) / CAST(7 AS DOUBLE)), 1)
           AS administrative_hours_saved,
       'ETB' AS reporting_currency
FROM totals"""


ORACLES["period_kpis"] = _kpis("true")
ORACLES["period_kpis_range"] = _kpis(_IN_RANGE)

ORACLES["roas_bands"] = f"""
WITH {_model(TYPED)},
banded AS (
    SELECT calendar_date, roas,
           CASE WHEN roas IS NULL THEN 'neutral' WHEN roas >= 3.0 THEN 'green'
                WHEN roas >= 1.5 THEN 'amber' ELSE 'red' END AS roas_band
    FROM model
)
SELECT *, CASE roas_band WHEN 'green' THEN '+ On target' WHEN 'amber' THEN '~ Watch'
                         WHEN 'red' THEN '- Below' END AS roas_label
FROM banded"""

# ------------------------------------------------------------- sources and sinks

ORACLES["header_mapping"] = f"""
WITH {TAGGED}
SELECT row_position, CASE WHEN k % 211 <> 0 THEN 'S' || k END AS order_id,
       CASE WHEN k % 211 <> 0 THEN
           CASE WHEN k % 41 = 0 THEN 'Under  Review' WHEN k % 83 = 0 THEN 'disputed'
                WHEN code = 'F' THEN 'Paid' WHEN code = 'P' THEN ' Partially-Paid '
                ELSE 'PENDING' END END AS financial_status,
       CASE WHEN k % 211 <> 0 THEN '0.00' END AS shipping_fees
FROM tagged_orders"""

ORACLES["csv_roundtrip"] = ORACLES["ads_clean"]

_MONEY = (
    "gross_revenue",
    "discount_amount",
    "net_revenue",
    "taxes",
    "shipping_fees",
    "ad_spend",
    "cogs_estimate",
    "contribution_margin",
)
ORACLES["csv_export"] = f"""
WITH {_model(TYPED)}
SELECT calendar_date, orders, impressions, link_clicks, reporting_currency,
       {", ".join(f"round_even({c}, 2) AS {c}" for c in _MONEY)},
       {", ".join(f"round_even({c}, 4) AS {c}" for c in ("roas", "mer", "profit_margin"))}
FROM model"""

ORACLES["table_roundtrip"] = f"""
WITH {TYPED}
SELECT day AS calendar_date, kind AS campaign_name,
       CAST(value AS DOUBLE) * CAST(130 AS DOUBLE) AS spend_amount,
       CASE WHEN day(day) % 10 <> 3 THEN CAST(kind = 'view' AS BIGINT) END AS impressions,
       CASE WHEN day(day) % 10 <> 3 THEN CAST(kind = 'click' AS BIGINT) END AS link_clicks,
       'ETB' AS reporting_currency
FROM ad_facts"""

# ------------------------------------------- files, stores and runs as a user meets them

ORACLES["csv_orders_roundtrip"] = ORACLES["orders_clean"]
ORACLES["csv_torn_cells"] = ORACLES["ads_clean"]


def _shown(column: str, places: int) -> str:
    held = f"CAST(CAST(round_even({column}, {places}) AS DECIMAL(38,{places})) AS VARCHAR)"
    return rf"coalesce(regexp_replace({held}, '(\.[0-9]+?)0+$', '\1'), '')"


_LINE = " || ',' || ".join(
    [
        "CAST(calendar_date AS VARCHAR)",
        *(_shown(c, 2) for c in _MONEY[:5]),
        "CAST(orders AS VARCHAR)",
        _shown("ad_spend", 2),
        "coalesce(CAST(impressions AS VARCHAR), '')",
        "coalesce(CAST(link_clicks AS VARCHAR), '')",
        *(_shown(c, 2) for c in _MONEY[6:]),
        *(_shown(c, 4) for c in ("roas", "mer", "profit_margin")),
        "coalesce(reporting_currency, '')",
    ]
)
ORACLES["csv_export_text"] = f"""
WITH {_model(TYPED)}
SELECT 'Date,Gross Revenue,Discounts,Net Revenue,Taxes,Shipping Fees,Orders,Ad Spend,Impressions,'
       || 'Link Clicks,COGS Estimate,Contribution Margin,ROAS,Meta Spend / Net Revenue,'
       || 'Profit Margin,Currency' AS line
UNION ALL
SELECT {_LINE} FROM model"""

ORACLES["table_overwrite"] = f"""
WITH {TYPED}
SELECT (SELECT count(*) FROM oc) AS n_orders, d AS calendar_date,
       CAST(value AS DOUBLE) * CAST(130 AS DOUBLE) AS spend_amount
FROM ac WHERE link_clicks = 1"""

ORACLES["model_exists"] = f"""
WITH {_model(TYPED)}
SELECT false AS before, true AS after, count(*) AS n_days FROM model"""

ORACLES["run_report"] = f"""
WITH {TAGGED},
counts AS (
    SELECT 'orders' AS source, reason, count(*) AS n FROM tagged_orders GROUP BY reason
    UNION ALL
    SELECT 'ads', reason, count(*) FROM tagged_ads GROUP BY reason
)
SELECT source, reason AS rejection_reason, n,
       CAST((SELECT sum(c.n) FROM counts c WHERE c.source = counts.source) AS BIGINT) AS rows_received,
       (SELECT c.n FROM counts c WHERE c.source = counts.source AND c.reason IS NULL) AS rows_accepted
FROM counts WHERE reason IS NOT NULL"""

ORACLES["incremental_model"] = ORACLES["end_to_end_model"]
ORACLES["period_kpis_hours"] = ORACLES["period_kpis"].replace("CAST(4 AS DOUBLE)", "CAST(7.5 AS DOUBLE)")

ORACLES["orders_clean_usd"] = f"""
WITH {TAGGED}
SELECT order_id, CAST(created_at_utc + INTERVAL 3 HOUR AS DATE) AS calendar_date, created_at_utc,
       financial_status,
       {", ".join(f"CAST({src} AS DOUBLE) * CAST(130 AS DOUBLE) AS {name}" for src, name in (
           ("gross", "gross_amount"), ("discount", "discount_amount"), ("net", "net_amount"),
           ("tax", "taxes"), ("0", "shipping_fees")))},
       'ETB' AS reporting_currency
FROM raw_oc"""

ORACLES["orders_daily_shared_ids"] = f"""
WITH {TYPED},
shared AS (
    SELECT CAST(order_id AS BIGINT) % 997 AS id, d, gross, discount, net, tax,
           CASE WHEN CAST(order_id AS BIGINT) % 5 = 0 THEN 'USD' ELSE 'ETB' END AS currency
    FROM oc
)
SELECT d AS calendar_date, CAST(sum(gross) AS DOUBLE) AS gross_revenue,
       CAST(sum(discount) AS DOUBLE) AS discount_amount, CAST(sum(net) AS DOUBLE) AS net_revenue,
       CAST(sum(tax) AS DOUBLE) AS taxes, CAST(0 AS DOUBLE) AS shipping_fees,
       count(DISTINCT id) AS orders,
       CAST(sum(discount) AS DOUBLE) / count(DISTINCT id) AS avg_discount_per_order,
       max(currency) AS reporting_currency
FROM shared GROUP BY d"""
