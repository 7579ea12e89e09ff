"""Values that have to be exactly these for results to be right.

Everything in this file is a fixed value: rates, names, word lists, column
aliases, file-name patterns and report headers. Nothing here is logic.
"""

# --- rates -----------------------------------------------------------------
VAT_DIVISOR = 1.21
AFFILIATE_RATE = 0.12
REPORT_TIME_ZONE = "Europe/Amsterdam"

# --- names shown when there is none ----------------------------------------
UNKNOWN_CATALOG_PRODUCT = "Unknown Product"
UNKNOWN_SALES_PRODUCT = "(Unknown)"
UNKNOWN_CONVERSION_PRODUCT = "Unknown"
SINGLE_VARIANT_TITLE = "Default Title"

# --- channel tags, and the word that stands for NULL in surrogate keys --------
MARKETPLACE = "bol"
WEBSHOP = "shopify"
NULL_KEY_WORD = "_dbt_utils_surrogate_key_null_"

# --- words that mean "discount applied" -------------------------------------
DISCOUNT_YES = ["yes", "y", "true", "1", "with_discount"]

# --- keys of a numeric visit count, in order of preference ------------------
VISIT_COUNT_KEYS = ["total", "value", "count", "visits", "numberOfVisits"]

# --- columns a sales file may use for each target column --------------------
SALES_ALIASES = {
    "product_name": ["product_name", "product", "producttitle", "title"],
    "units_sold": ["units_sold", "unitssold", "quantity", "qty", "units"],
    "revenue": ["revenue", "total_revenue", "sales", "turnover"],
    "net_margin_pct": [
        "net_margin_pct", "margin_pct", "margin_percent", "margin_percentage",
        "margin", "margin_pct_avg",
    ],
    "selling_price": ["selling_price", "sale_price", "sell_price_avg", "price"],
    "original_price": [
        "original_price", "list_price", "price_original", "original_price_avg",
    ],
    "order_date": ["order_date", "date", "latest_order", "created_at"],
    "week_number": ["week_number", "week", "week_no", "weeknr"],
    "discount_applied": [
        "discount_applied", "discount", "discounted", "discount_pct_avg",
    ],
    "ean": ["ean", "sku"],
    "cogs": ["cogs", "cogs_avg", "cost"],
    "estimated_ad_cost": ["estimated_ad_cost", "ad_cost", "ads", "ad_cost_avg"],
    "net_margin_eur": [
        "net_margin_eur", "margin_eur", "margin_eur_avg", "profit", "total_profit",
    ],
    "net_selling_price": ["net_selling_price", "net_sell"],
    "discount_used_pct": ["discount_used_pct", "discount_pct", "discount_pct_avg"],
}
# targets for which web-shop files use another list
WEBSHOP_SALES_ALIASES = {
    "selling_price": ["selling_price", "sale_price", "sell_price_avg", "price", "sell"],
    "original_price": [
        "original_price", "list_price", "price_original", "original", "compare_at_price",
    ],
    "order_date": ["order_date", "date", "latest_order", "created_at", "latest"],
    "estimated_ad_cost": ["estimated_ad_cost", "ad_cost", "ads", "ad_cost_avg", "ad"],
    "discount_used_pct": [
        "discount_used_pct", "discount_pct", "discount_pct_avg", "disc",
    ],
}

# --- names of weekly files ---------------------------------------------------
MARKETPLACE_WEEK_FILE = (
    r"(?i)[/=]profitability_(\d{4}-\d{2}-\d{2})_to_(\d{4}-\d{2}-\d{2})_Week_?(\d{1,2})\.csv(?:/|$)"
)
WEBSHOP_WEEK_FILE = (
    r"(?i)[/=]shopify_week_(\d{1,2})_(\d{4}-\d{2}-\d{2})_to_(\d{4}-\d{2}-\d{2})\.csv(?:/|$)"
)

# --- report headers, paired with the rollup column they show -----------------
SUMMARY_HEADERS = [
    ("product_name", "Product"),
    ("product_key", "EAN"),
    ("latest_order", "Latest_Order"),
    ("total_units", "Units_Sold"),
    ("avg_cogs", "COGS_Avg"),
    ("avg_selling_price", "Sell_Price_Avg"),
    ("avg_original_price", "Original_Price_Avg"),
    ("avg_discount_pct", "Discount_Pct_Avg"),
    ("avg_net_margin", "Margin_EUR_Avg"),
    ("avg_margin_pct", "Margin_PCT_Avg"),
    ("total_revenue", "Total_Revenue"),
    ("total_profit", "Total_Profit"),
]
MARKETPLACE_WEEK_HEADERS = [
    ("week_text", "Week"),
    ("range_text", "Date Range"),
    ("product_name", "Product"),
    ("product_key", "EAN"),
    ("latest_order", "Latest_Order"),
    ("total_units", "Units_Sold"),
    ("avg_cogs", "COGS_Avg"),
    ("avg_ad_cost", "Ad_Cost_Avg"),
    ("avg_selling_price", "Sell_Price_Avg"),
    ("avg_original_price", "Original_Price_Avg"),
    ("avg_discount_pct", "Discount_Pct_Avg"),
    ("avg_net_margin", "Margin_EUR_Avg"),
    ("avg_margin_pct", "Margin_PCT_Avg"),
    ("total_revenue", "Total_Revenue"),
    ("total_profit", "Total_Profit"),
]
WEBSHOP_WEEK_HEADERS = [
    ("week_text", "Week"),
    ("range_text", "Range"),
    ("product_name", "Product"),
    ("product_key", "SKU"),
    ("latest_order", "Latest"),
    ("total_units", "Units"),
    ("avg_cogs", "COGS"),
    ("avg_ad_cost", "Ad"),
    ("avg_selling_price", "Sell"),
    ("avg_original_price", "Original"),
    ("avg_discount_pct", "Disc%"),
    ("avg_net_margin", "Margin"),
    ("avg_margin_pct", "Margin%"),
    ("total_revenue", "Revenue"),
    ("total_profit", "Profit"),
]
CONVERSION_COLUMNS = [
    "offer_id", "product_name", "ean", "date", "period_type", "period_label",
    "visits_nl", "visits_be", "visits_total", "orders", "conversion_rate",
]
REVENUE_TAB = [
    ("order_date", "Date", "date"),
    ("channel", "Channel", "text"),
    ("total_orders", "Total Orders", "number"),
    ("total_revenue", "Revenue (€)", "currency_eur"),
    ("avg_order_value", "Avg Order Value (€)", "currency_eur"),
]
PRODUCT_TAB = [
    ("product_name", "Product Name", "text"),
    ("sku", "SKU", "text"),
    ("units_sold", "Units Sold", "number"),
    ("revenue", "Revenue (€)", "currency_eur"),
]

# --- tables whose rows are counted -------------------------------------------
RAW_TABLES = [
    "raw.bol_orders",
    "raw.bol_offers",
    "raw.bol_product_costs",
    "raw.shopify_orders",
    "raw.shopify_order_items",
    "raw.shopify_product_costs",
]

# --- data tests: columns that may not be null / must be unique ---------------
NOT_NULL = {
    "raw.bol_orders": ["order_id", "order_item_id", "ean", "unit_price", "quantity"],
    "raw.bol_offers": ["offer_id", "ean"],
    "raw.bol_product_costs": ["ean"],
    "raw.shopify_orders": ["order_id", "total_price"],
    "raw.shopify_order_items": ["line_item_id", "order_id"],
    "raw.shopify_product_costs": ["sku"],
    "staging.stg_bol_orders": [
        "order_item_id", "order_id", "order_placed_at", "ean", "quantity",
        "unit_price", "commission",
    ],
    "staging.stg_bol_offers": ["offer_id", "ean", "unit_price"],
    "staging.stg_shopify_orders": ["order_id", "created_at", "total_price"],
    "staging.stg_shopify_order_items": ["line_item_id", "order_id", "quantity", "price"],
    "analytics.bol_profitability": [
        "order_item_id", "order_id", "date", "ean", "units_sold", "selling_price",
        "bol_commission", "net_selling_price", "net_margin_eur", "net_margin_pct",
        "revenue", "profit",
    ],
    "analytics.shopify_profitability": [
        "line_item_id", "order_id", "date", "units_sold", "selling_price",
        "net_selling_price", "net_margin_eur", "revenue", "profit",
    ],
}
UNIQUE = {
    "raw.bol_orders": ["order_item_id"],
    "raw.bol_offers": ["offer_id"],
    "raw.bol_product_costs": ["ean"],
    "raw.shopify_orders": ["order_id"],
    "raw.shopify_order_items": ["line_item_id"],
    "raw.shopify_product_costs": ["sku"],
    "staging.stg_bol_orders": ["order_item_id"],
    "staging.stg_bol_offers": ["offer_id"],
    "staging.stg_shopify_orders": ["order_id"],
    "staging.stg_shopify_order_items": ["line_item_id"],
    "analytics.bol_profitability": ["order_item_id"],
    "analytics.shopify_profitability": ["line_item_id"],
}
RELATIONSHIPS = [
    ("raw.shopify_order_items", "order_id", "raw.shopify_orders", "order_id"),
    ("staging.stg_shopify_order_items", "order_id", "staging.stg_shopify_orders", "order_id"),
]
