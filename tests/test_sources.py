import json

import pytest

from tillmetrics.operators import flatten, quality
from tillmetrics.plans import sales_view
from tillmetrics.sinks import exports
from tillmetrics.sources import files, landing


def put(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_marketplace_cost_list(spark, rows, tmp_path):
    text = (
        "EAN,\tProduct Name,\tOriginal_Price\tCOGS,estimated ad cost\n"
        '0871234567890,\t"Chair, blue"\t€ 35.00,\t12.5,0\n'
        "  ,No key,1,1,1\n"
        "002,Short row\n"
        "003,,1.2.3\t,-,7\n"
    )
    got = rows(files.marketplace_costs(spark, put(tmp_path, "costs.csv", text)))
    assert got == [
        ("002", "Short row", None, None, None),
        ("003", "", None, None, 7.0),
        ("0871234567890", "Chair, blue", 35.0, 12.5, None),
    ]


def test_webshop_cost_list(spark, rows, tmp_path):
    text = 'SKU,Product_Name,original price,COGS,Estimated Ad Cost\nA-1,"Say ""hi""",9.99,,x\n,none,1,1,1\n'
    assert rows(files.webshop_costs(spark, put(tmp_path, "costs.csv", text))) == [("A-1", 'Say "hi"', 9.99, 0.0, 0.0)]


def test_weekly_files_by_name(spark, rows, tmp_path):
    head = "Week,Date Range,Product,EAN,Units_Sold\n"
    put(tmp_path, "profitability_2026-01-05_to_2026-01-11_Week02.csv", head + "Week 2,r,A,007,3\n")
    put(tmp_path, "profitability_2026-01-12_to_2026-01-18_week_3.csv", head + "Week 3,r,A,007,4\n")
    put(tmp_path, "profitability_latest.csv", head + "Week 9,r,Z,9,9\n")
    put(tmp_path, "shopify_week_02_2026-01-05_to_2026-01-11.csv", head + "Week 2,r,S,1,1\n")
    got = rows(files.weekly_files(spark, str(tmp_path)), "EAN", "Units_Sold", "file_start", "file_end", "file_week")
    assert got == [("007", "3", "2026-01-05", "2026-01-11", 2), ("007", "4", "2026-01-12", "2026-01-18", 3)]
    got = rows(files.weekly_files(spark, str(tmp_path), "webshop"), "EAN", "file_start", "file_week")
    assert got == [("1", "2026-01-05", 2)]


def test_weekly_files_with_line_breaks(spark, rows, tmp_path):
    head = "Week,Date Range,Product,EAN,Units_Sold\n"
    text = head + 'Week 2,r,"Chair\nblue",007,3\nWeek 2,r,Lamp,008,4\n'
    put(tmp_path, "profitability_2026-01-05_to_2026-01-11_Week02.csv", text)
    want = [("Chair\nblue", "007", "3", 2), ("Lamp", "008", "4", 2)]
    assert rows(files.weekly_files(spark, str(tmp_path)), "Product", "EAN", "Units_Sold", "file_week") == want
    assert files.weekly_files(spark, str(tmp_path), multi_line=False).count() == 3


def test_conversion_csv_quotes_and_line_breaks(spark, tmp_path):
    path = put(tmp_path, "c.csv", 'offer_id,product_name,ean\n1,"a ""b"", c\nd",\n2,x\n')
    got = [tuple(r) for r in files.conversion_csv(spark, path).orderBy("offer_id").collect()]
    assert got == [("1", 'a "b", c\nd', ""), ("2", "x", "")]


def test_products_in_both_shapes(spark, rows, tmp_path):
    product = {"id": 1, "title": "Lamp", "variants": [
        {"id": 10, "title": "Default Title", "sku": "L", "price": "5.00"},
        {"id": 11, "title": "Red", "sku": "L-R", "price": None, "inventory_quantity": 3},
        {"id": 12, "title": "Blue", "sku": ""},
    ]}
    other = {**product, "id": 2}
    a = put(tmp_path, "a/p.json", json.dumps({"products": [product, other]}, indent=1))
    b = put(tmp_path, "b/p.json", json.dumps([product, other], indent=1))
    for path in (a, b):
        found = landing.products(spark, path)
        assert rows(found, "id") == [("1",), ("2",)]
        assert rows(flatten.cost_seeds(found).filter("sku <> ''").distinct()) == [
            ("L", "Lamp", 5.0, 0.0, 0.0), ("L-R", "Lamp (Red)", 0.0, 0.0, 0.0),
        ]
        variants = rows(flatten.product_variants(found).filter("product_id = '1'"), "title", "inventory_quantity")
        assert variants == [("Lamp - Blue", 0), ("Lamp - Red", 3), ("Lamp", 0)]


def test_orders_landed_on_several_days(spark, rows, tmp_path):
    def document(order, price):
        item = {"orderItemId": f"{order}-1", "product": {"ean": "007", "title": "T"}, "quantity": 1, "unitPrice": price}
        return json.dumps({"orderId": order, "orderPlacedDateTime": "2026-01-01T10:00:00+01:00", "orderItems": [item]})

    put(tmp_path, "change_date=2026-01-01/a.json", document("1", 1.0) + "\n" + document("", 9.0))
    put(tmp_path, "change_date=2026-01-02/a.json", document("1", 2.0) + "\n" + document("2", 2.0))
    put(tmp_path, "change_date=2026-01-03/a.json", document("2", 3.0) + "\n" + document("3", 3.0))
    put(tmp_path, "change_date=2026-01-04/a.json", document("4", 4.0))
    got = rows(landing.marketplace_orders(spark, str(tmp_path), "2026-01-01", "2026-01-03"), "order_id", "ean", "unit_price", "fulfillment_method")
    assert got == [("1", "007", 1.0, None), ("2", "007", 2.0, None), ("3", "007", 3.0, None)]
    plan = landing.marketplace_orders(spark, str(tmp_path), "2026-01-03")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(change_date" in plan


def test_webshop_orders_in_range(spark, rows, tmp_path):
    orders = [
        {"id": 1, "created_at": "2026-01-01T00:30:00+01:00", "total_price": "1.00"},
        {"id": 2, "created_at": "2026-01-01T00:00:00Z", "total_price": ""},
        {"id": 3, "created_at": "2026-01-02T23:59:59Z", "subtotal_price": "2.50"},
        {"id": 4, "created_at": "2026-01-03T00:00:00Z"},
    ]
    path = put(tmp_path, "p.json", json.dumps({"orders": orders}))
    found = landing.webshop_orders(spark, path, "2026-01-01", "2026-01-02")
    assert rows(flatten.webshop_order_headers(found), "order_id", "total_price", "subtotal_price") == [
        ("2", 0.0, 0.0), ("3", 0.0, 2.5),
    ]


def test_table_counts_of_stored_tables(spark, rows):
    spark.sql("create database if not exists raw")
    spark.createDataFrame([(1,), (2,)], "a int").write.mode("overwrite").saveAsTable("raw.bol_offers")
    got = dict(rows(files.table_counts(spark)))
    assert got["raw.bol_offers"] == 2 and got["raw.bol_orders"] == 0 and len(got) == 6
    exports.materialize(spark.table("raw.bol_offers"), "stg_bol_offers", as_table=False)
    assert spark.table("stg_bol_offers").count() == 2
    spark.sql("drop table raw.bol_offers")


def test_sales_view_defaults(spark):
    row = sales_view.normalized_sales(spark.createDataFrame([("x",)], "whatever string")).first()
    assert (row.product_name, row.ean, row.units_sold, row.revenue, row.discount_applied) == ("(Unknown)", "", 0.0, 0.0, False)
    assert row.order_date is not None and row.week_number is not None


def test_sales_view_week_texts_and_clamp(spark):
    df = spark.createDataFrame(
        [("Week 7", 250.0, "2026-01-01", "12.5"), ("12", -250.0, "2026-01-01", "no"), ("12.7", 5.0, "2026-01-01", None), ("none", None, "2026-01-05", "0")],
        "Week string, `Margin%` double, Date string, Discount string",
    )
    got = [(r.week_number, r.net_margin_pct, r.discount_applied) for r in sales_view.normalized_sales(df).collect()]
    assert got == [(7, 100.0, True), (12, -100.0, False), (13, 5.0, False), (2, 0.0, False)]


@pytest.mark.parametrize("text, want", [("€ 1,234.50", 1234.5), ("1.5E7", 15000000.0), ("NaN", 0.0), (" 7 ", 7.0), ("n/a", 0.0), (None, 0.0)])
def test_webshop_money_text(spark, text, want):
    df = spark.createDataFrame([(text,)], "Revenue string")
    assert sales_view.normalized_sales(df, "webshop").first().revenue == want


def test_data_tests(spark, rows):
    items = spark.createDataFrame([("1", "o1"), ("1", "o1"), (None, "o2"), ("3", None)], "line_item_id string, order_id string")
    orders = spark.createDataFrame([("o1", 1.0)], "order_id string, total_price double")
    got = rows(quality.run_tests({"raw.shopify_order_items": items, "raw.shopify_orders": orders}))
    assert got == [
        ("raw.shopify_order_items", "not_null", "line_item_id", 1),
        ("raw.shopify_order_items", "not_null", "order_id", 1),
        ("raw.shopify_order_items", "relationships", "order_id", 1),
        ("raw.shopify_order_items", "unique", "line_item_id", 1),
        ("raw.shopify_orders", "not_null", "order_id", 0),
        ("raw.shopify_orders", "not_null", "total_price", 0),
        ("raw.shopify_orders", "unique", "order_id", 0),
    ]


def test_declared_data_tests_are_all_there():
    from tillmetrics.fixed import NOT_NULL, RELATIONSHIPS, UNIQUE

    counts = [sum(map(len, NOT_NULL.values())), sum(map(len, UNIQUE.values())), len(RELATIONSHIPS)]
    assert counts == [51, 12, 2]
