"""Names and types every stage agrees on.

Fixed values throughout: canonical columns, the header spellings accepted for
them, rejection reasons, table names, and the display headers of the export.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class InputField:
    """One canonical input column and the other headers accepted for it."""

    name: str
    also: tuple[str, ...] = ()
    required: bool = True

    @property
    def spellings(self) -> tuple[str, ...]:
        return (self.name, *self.also)


ORDER_FIELDS = (
    InputField("order_id", ("orderid", "id", "order_number")),
    InputField("created_at", ("created", "order_date", "date")),
    InputField("financial_status", ("status", "payment_status")),
    InputField("gross_amount", ("gross", "gross_sales", "subtotal")),
    InputField("discount_amount", ("discount", "discounts", "discounts_amount")),
    InputField("net_amount", ("net", "net_sales", "total")),
    InputField("taxes", ("tax", "tax_amount", "total_tax")),
    InputField("shipping_fees", ("shipping", "shipping_fee", "shipping_amount")),
    InputField("currency", ("currency_code", "order_currency")),
)

AD_FIELDS = (
    InputField("reporting_start", ("report_start", "date_start", "start_date")),
    InputField("reporting_end", ("report_end", "date_end", "end_date")),
    InputField("campaign_name", ("campaign",), required=False),
    InputField("spend_amount", ("amount_spent", "spend", "cost", "amount_spent_usd")),
    InputField("impressions", ("impression", "impressions_count"), required=False),
    InputField("link_clicks", ("clicks", "link_click", "link_clicks_count"), required=False),
)

#: Where a row stood in the input: file, byte offset of its block, rank inside it.
POSITION = ("__file", "__block", "__row")
MALFORMED = "__malformed"
REASON = "rejection_reason"

# Rejection reasons, in the order they are tested.
EMPTY_ROW = "empty_row"
MISSING_REQUIRED = "missing_required_value"
DUPLICATE_ORDER = "duplicate_order_id"
INVALID_CREATED_AT = "invalid_created_at"
INVALID_MONEY = "invalid_money"
EXCLUDED_STATUS = "excluded_status"
INVALID_AD_DATE = "invalid_meta_date"
MULTI_DAY = "multi_day_interval"
INVALID_SPEND = "invalid_spend"

ORDER_REASONS = (
    EMPTY_ROW,
    MISSING_REQUIRED,
    DUPLICATE_ORDER,
    INVALID_CREATED_AT,
    INVALID_MONEY,
    EXCLUDED_STATUS,
)
AD_REASONS = (EMPTY_ROW, MISSING_REQUIRED, INVALID_AD_DATE, MULTI_DAY, INVALID_SPEND)

ORDER_MONEY = ("gross_amount", "discount_amount", "net_amount", "taxes", "shipping_fees")

ORDERS_CLEAN = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("calendar_date", T.DateType()),
        T.StructField("created_at_utc", T.TimestampType()),
        T.StructField("financial_status", T.StringType()),
        *[T.StructField(name, T.DoubleType()) for name in ORDER_MONEY],
        T.StructField("reporting_currency", T.StringType()),
    ]
)

ADS_CLEAN = T.StructType(
    [
        T.StructField("calendar_date", T.DateType()),
        T.StructField("campaign_name", T.StringType()),
        T.StructField("spend_amount", T.DoubleType()),
        T.StructField("impressions", T.LongType()),
        T.StructField("link_clicks", T.LongType()),
        T.StructField("reporting_currency", T.StringType()),
    ]
)

_MODEL_MONEY = ("gross_revenue", "discount_amount", "net_revenue", "taxes", "shipping_fees")
DAILY_MODEL = T.StructType(
    [
        T.StructField("calendar_date", T.DateType()),
        *[T.StructField(name, T.DoubleType()) for name in _MODEL_MONEY],
        T.StructField("orders", T.LongType()),
        T.StructField("ad_spend", T.DoubleType()),
        T.StructField("impressions", T.LongType()),
        T.StructField("link_clicks", T.LongType()),
        T.StructField("cogs_estimate", T.DoubleType()),
        T.StructField("contribution_margin", T.DoubleType()),
        T.StructField("roas", T.DoubleType()),
        T.StructField("mer", T.DoubleType()),
        T.StructField("profit_margin", T.DoubleType()),
        T.StructField("reporting_currency", T.StringType()),
    ]
)

#: Model column -> header in the exported CSV, in export order.
EXPORT_HEADERS = {
    "calendar_date": "Date",
    "gross_revenue": "Gross Revenue",
    "discount_amount": "Discounts",
    "net_revenue": "Net Revenue",
    "taxes": "Taxes",
    "shipping_fees": "Shipping Fees",
    "orders": "Orders",
    "ad_spend": "Ad Spend",
    "impressions": "Impressions",
    "link_clicks": "Link Clicks",
    "cogs_estimate": "COGS Estimate",
    "contribution_margin": "Contribution Margin",
    "roas": "ROAS",
    "mer": "Meta Spend / Net Revenue",
    "profit_margin": "Profit Margin",
    "reporting_currency": "Currency",
}
EXPORT_RATIOS = ("roas", "mer", "profit_margin")
RATIO_DECIMALS = 4
MONEY_DECIMALS = 2

# Tables a run writes.
T_ORDERS_STAGED = "orders_staged"
T_ADS_STAGED = "ads_staged"
T_ORDER_REPEATS = "order_repeats"
T_ORDERS_KNOWN = "orders_known"
T_ORDERS_CLEAN = "orders_clean"
T_ADS_CLEAN = "ads_clean"
T_ORDERS_DAILY = "orders_daily"
T_ADS_DAILY = "ads_daily"
T_MODEL = "daily_financial_model"
# Partial sums per day, and the parameters that made the rows, for runs that add exports.
T_ORDERS_SUMS = "orders_sums"
T_ADS_SUMS = "ads_sums"
T_ROW_SETTINGS = "row_settings"
