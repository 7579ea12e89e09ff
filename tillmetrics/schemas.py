"""Column layouts of the raw tables and of the landed JSON documents."""

MARKETPLACE_ORDERS = (
    "order_id string, order_item_id string, order_placed_at string, "
    "fulfillment_method string, ean string, title string, quantity int, "
    "unit_price double, total_price double, commission double, fetched_at timestamp_ntz"
)
MARKETPLACE_OFFERS = (
    "offer_id string, ean string, product_title string, stock_amount int, "
    "corrected_stock int, managed_by_retailer boolean, unit_price double, "
    "fulfillment_method string, delivery_code string, fetched_at timestamp_ntz"
)
MARKETPLACE_COSTS = (
    "ean string, product_name string, original_price double, cogs double, "
    "estimated_ad_cost double, updated_at timestamp_ntz"
)
WEBSHOP_ORDERS = (
    "order_id string, created_at timestamp, total_price double, subtotal_price double, "
    "total_tax double, currency string, landing_site string, fetched_at timestamp_ntz"
)
WEBSHOP_ITEMS = (
    "order_id string, line_item_id string, sku string, name string, quantity int, "
    "price double, total_discount double, fetched_at timestamp_ntz"
)
WEBSHOP_COSTS = (
    "sku string, product_name string, original_price double, cogs double, "
    "estimated_ad_cost double, updated_at timestamp_ntz"
)
CONVERSION = (
    "offer_id string, product_name string, ean string, date date, period_type string, "
    "period_label string, visits_nl int, visits_be int, visits_total int, orders int, "
    "conversion_rate decimal(10,4), fetched_at timestamp_ntz"
)

# landed documents ------------------------------------------------------------
ORDER_DOCUMENT = (
    "orderId string, orderPlacedDateTime string, orderItems array<struct<"
    "orderItemId:string, product:struct<ean:string,title:string>, "
    "fulfilment:struct<method:string>, quantity:int, unitPrice:double, "
    "totalPrice:double, commission:double>>"
)
OFFER_PAGE = (
    "page int, offers array<struct<offerId:string, ean:string, unknownProductTitle:string, "
    "stock:struct<amount:int,correctedStock:int,managedByRetailer:boolean>, "
    "pricing:struct<bundlePrices:array<struct<unitPrice:double>>>, "
    "fulfilment:struct<method:string,deliveryCode:string>>>"
)
WEBSHOP_ORDER = (
    "id:string, created_at:string, total_price:string, subtotal_price:string, "
    "total_tax:string, currency:string, landing_site:string, "
    "line_items:array<struct<id:string, sku:string, name:string, quantity:int, "
    "price:string, total_discount:string>>"
)
WEBSHOP_ORDER_PAGE = f"orders array<struct<{WEBSHOP_ORDER}>>"
PRODUCT = (
    "id:string, title:string, variants:array<struct<id:string, title:string, sku:string, "
    "price:string, compare_at_price:string, inventory_quantity:int, updated_at:string>>"
)
PRODUCT_LIST = f"array<struct<{PRODUCT}>>"
PRODUCT_FILE = f"products {PRODUCT_LIST}"
INSIGHTS_DOCUMENT = "offer_id string, period_type string, payload string"

_COUNTS = "total:double, value:double, count:double, visits:double, numberOfVisits:double"
_COUNTRY = f"struct<countryCode:string, country:string, {_COUNTS}>"
_COUNTRY_LISTS = f"countries:array<{_COUNTRY}>, country:array<{_COUNTRY}>"
_NODE = (
    f"{_COUNTRY_LISTS}, insights:array<struct<{_COUNTRY_LISTS}>>, "
    f"items:array<struct<{_COUNTRY_LISTS}>>, results:array<struct<{_COUNTRY_LISTS}>>, {_COUNTS}"
)
_DAY = f"struct<day:string, date:string, timestamp:string, {_NODE}, offerInsights:array<struct<{_NODE}>>>"
PERIOD_PAYLOAD = f"struct<{_NODE}, offerInsights:array<struct<{_NODE}>>>"
DAILY_PAYLOAD = (
    f"struct<insights:array<{_DAY}>, results:array<{_DAY}>, items:array<{_DAY}>, "
    f"days:array<{_DAY}>, periods:array<{_DAY}>, "
    f"offerInsights:array<struct<periods:array<{_DAY}>, days:array<{_DAY}>, insights:array<{_DAY}>>>>"
)
