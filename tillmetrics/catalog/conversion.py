"""Queries: offer conversion and the conversion board."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillmetrics.catalog.mapping import REFERENCE_DAY, read, table, with_tables
from tillmetrics.catalog.profit import two_offers
from tillmetrics.catalog.registry import query, r
from tillmetrics.operators import insights
from tillmetrics.operators.ranking import sorted_by
from tillmetrics.plans import conversion, conversion_board as board
from tillmetrics.sinks.exports import conversion_export, metrics_order

START, END = "2024-01-08", "2024-01-21"

_CATALOG = """catalog as (
    select offer_id, coalesce(ean, '') as ean,
        list_filter([cost_name, title, 'Unknown Product'], lambda n: n <> '')[1] as product_name
    from (select offer_id, ean, product_title as title from mp_offers where offer_id is not null)
    left join (select ean, product_name as cost_name from mp_costs) using (ean))"""
_RANGE = f"cast(o.order_placed_at as date) between date '{START}' and date '{END}'"


@query("p18_offer_catalog", with_tables("mp_offers", "mp_costs", more=_CATALOG) + "select * from catalog")
def p18(spark, sf):
    return conversion.offer_catalog(table(spark, sf, "mp_offers"), table(spark, sf, "mp_costs"))


@query(
    "a5_orders_by_offer",
    with_tables("mp_offers", "cv_orders", more=f"sold as (select ean, sum(quantity) as n from cv_orders o where {_RANGE} group by ean)")
    + """select offer_id, cast(sum(coalesce(n, 0)) as bigint) as units_sold
    from mp_offers left join sold using (ean) where offer_id is not null group by offer_id""",
)
def a5(spark, sf):
    return conversion.units_by_offer(table(spark, sf, "mp_offers"), table(spark, sf, "cv_orders"), START, END, iso_text=True)


@query(
    "j6_shared_ean_orders",
    with_tables("mp_offers", "mp_orders", more="""sold as (
        select ean, sum(quantity) as n from mp_orders where year(cast(order_placed_at as date)) = 1998 group by ean)""")
    + """select shared as offer_id, cast(coalesce(n, 0) as bigint) as units_sold
    from (select ean, unnest(if(managed_by_retailer, [offer_id, concat('O2-', ean)], [offer_id])) as shared from mp_offers)
    left join sold using (ean) where shared is not null""",
)
def j6(spark, sf):
    return conversion.units_by_offer(
        two_offers(spark, sf), table(spark, sf, "mp_orders"), "1998-01-01", "1998-12-31"
    )


@query(
    "a6_daily_orders",
    with_tables("mp_offers", "cv_orders", more=f"""sold as (
        select ean, cast(order_placed_at as date) as order_date, sum(quantity) as n from cv_orders o
        where {_RANGE} group by all)""")
    + """select offer_id, order_date, cast(coalesce(sum(n), 0) as bigint) as units_sold
    from sold join mp_offers using (ean) where offer_id is not null group by all""",
)
def a6(spark, sf):
    return conversion.daily_units_by_offer(
        table(spark, sf, "mp_offers"), table(spark, sf, "cv_orders"), START, END, iso_text=True
    )


# --- visits arrive as insights documents ---------------------------------------
def period_documents(spark: SparkSession, sf: str, mode: str, days) -> DataFrame:
    """One insights payload per offer and period, counted from the view events."""
    views = conversion.in_periods(table(spark, sf, "cv_views"), "day", mode, days)
    counts = views.groupBy("offer_id", "period_type", "period_label").agg(
        F.count_if(F.col("country") == "NL").alias("nl"),
        F.count_if(F.col("country") == "BE").alias("be"),
        F.count(F.lit(1)).alias("n"),
    )
    country = lambda code, n: F.struct(F.lit(code).alias("countryCode"), F.col(n).alias("total"))
    payload = F.struct(
        F.array(
            F.struct(F.array(country("NL", "nl"), country("BE", "be")).alias("countries"), F.col("n").alias("total"))
        ).alias("offerInsights")
    )
    return counts.select("offer_id", "period_type", "period_label", F.to_json(payload).alias("payload"))


def metrics(spark: SparkSession, sf: str, mode: str = "both", days=REFERENCE_DAY) -> DataFrame:
    return conversion.conversion_metrics(
        table(spark, sf, "mp_offers"),
        table(spark, sf, "mp_costs"),
        table(spark, sf, "cv_orders"),
        insights.country_visits(period_documents(spark, sf, mode, days)),
        mode,
        days,
    )


def daily_documents(spark: SparkSession, sf: str) -> DataFrame:
    """One payload per offer and month with a list of days; a month has at most 31.

    Payloads are mixed as landed ones can be: a number and a word stand among the
    days, and odd days are written without dashes.
    """
    month = table(spark, sf, "cv_views").withColumn("month", F.trunc("day", "month"))
    per_day = month.groupBy("offer_id", "month", "day").agg(
        F.count_if(F.col("country") == "NL").alias("nl"),
        F.count_if(F.col("country") == "BE").alias("be"),
        F.count(F.lit(1)).alias("n"),
    )
    entry = F.struct(
        F.when(F.dayofmonth("day") % 2 == 0, F.concat(F.col("day").cast("string"), F.lit("T00:00:00Z")))
        .otherwise(F.date_format("day", "yyyyMMdd"))
        .alias("date"),
        F.array(
            F.struct(F.lit("nl").alias("country"), F.col("nl").alias("visits")),
            F.struct(F.lit("be").alias("country"), F.col("be").alias("visits")),
        ).alias("country"),
        F.col("n").alias("total"),
    )
    payload = F.to_json(F.struct(F.array(F.struct(F.collect_list(entry).alias("periods"))).alias("offerInsights")))
    mixed = F.regexp_replace("payload", r'"periods":\[', '"periods":[7,"word",')
    return per_day.groupBy("offer_id", "month").agg(payload.alias("payload")).select("offer_id", mixed.alias("payload"))


def daily(spark: SparkSession, sf: str) -> DataFrame:
    return conversion.conversion_daily(
        table(spark, sf, "mp_offers"),
        table(spark, sf, "mp_costs"),
        table(spark, sf, "cv_orders"),
        insights.daily_series(daily_documents(spark, sf)),
        "both",
        REFERENCE_DAY,
    )


def _periods_sql(days: list[str]) -> str:
    rows = []
    for day in days:
        d = f"date '{day}'"
        monday = f"cast(date_trunc('week', {d}) as date)"
        first = f"cast(date_trunc('month', {d}) as date)"
        rows.append(
            f"select 'WEEK' as period_type, strftime({d}, 'W%V-%G') as period_label, "
            f"{monday} as start_date, {monday} + 6 as end_date"
        )
        rows.append(f"select 'MONTH', strftime({d}, '%Y-%m'), {first}, last_day({d})")
    return "periods as (" + " union ".join(rows) + ")"


_RATE = """cast(case when visits_total > 0
    then round(orders::double / visits_total::double * 100 * 10000) / 10000 else 0 end as decimal(10, 4))"""


def metrics_sql(days: list[str]) -> str:
    return f"""{_CATALOG}, {_periods_sql(days)},
    seen as (
        select offer_id, period_type, period_label, count(*) filter (country = 'NL') as nl,
               count(*) filter (country = 'BE') as be, count(*) as n
        from cv_views join periods on day between start_date and end_date group by all),
    sold as (
        select f.offer_id, period_type, period_label, sum(o.quantity) as units
        from mp_offers f join cv_orders o on o.ean = f.ean
        join periods on cast(o.order_placed_at as date) between start_date and end_date group by all),
    filled as (
        select k.offer_id, k.product_name, k.ean, p.end_date as date, p.period_type, p.period_label,
               cast(coalesce(s.nl, 0) as integer) as visits_nl, cast(coalesce(s.be, 0) as integer) as visits_be,
               cast(coalesce(if(s.nl + s.be = 0, s.n, s.nl + s.be), 0) as integer) as visits_total,
               cast(coalesce(u.units, 0) as integer) as orders
        from catalog k cross join periods p
        left join seen s on s.offer_id = k.offer_id and s.period_type = p.period_type and s.period_label = p.period_label
        left join sold u on u.offer_id = k.offer_id and u.period_type = p.period_type and u.period_label = p.period_label),
    metrics as (select *, {_RATE} as conversion_rate from filled)"""


METRICS_WITH = with_tables(
    "mp_offers", "mp_costs", "cv_orders", "cv_views", more=metrics_sql([REFERENCE_DAY])
)
DAILY = f"""seen_day as (
        select offer_id, day, count(*) filter (country = 'NL') as nl, count(*) filter (country = 'BE') as be,
               count(*) as n from cv_views group by all),
    sold_day as (
        select f.offer_id, cast(o.order_placed_at as date) as day, sum(o.quantity) as units
        from mp_offers f join cv_orders o on o.ean = f.ean group by all),
    daily_filled as (
        select k.offer_id, k.product_name, k.ean, s.day as date, p.period_type, p.period_label,
               cast(s.nl as integer) as visits_nl, cast(s.be as integer) as visits_be,
               cast(if(s.nl + s.be = 0, s.n, s.nl + s.be) as integer) as visits_total,
               cast(coalesce(u.units, 0) as integer) as orders
        from seen_day s join catalog k on k.offer_id = s.offer_id
        join periods p on s.day between p.start_date and p.end_date
        left join sold_day u on u.offer_id = s.offer_id and u.day = s.day),
    daily as (select *, {_RATE} as conversion_rate from daily_filled)"""
DAILY_WITH = f"{METRICS_WITH}, {DAILY} "


@query("b16_conversion_metrics", METRICS_WITH + "select * from metrics")
def b16(spark, sf):
    return metrics(spark, sf)


@query("k2_conversion_daily", DAILY_WITH + "select * from daily")
def k2_daily(spark, sf):
    return daily(spark, sf)


@query("k9_metrics_export", METRICS_WITH + "select * replace (cast(date as varchar) as date) from metrics")
def k9(spark, sf):
    return metrics_order(conversion_export(metrics(spark, sf)))


_COUNTRY = """select * replace (case when visits_nl > 0
      then orders::double / visits_nl::double * 100.0::double else 0.0::double end as conversion_rate),
    visits_nl as visits_active from metrics"""


@query("p17_country_switch", METRICS_WITH + _COUNTRY)
def p17(spark, sf):
    return board.for_country(metrics(spark, sf), "NL")


@query(
    "f4_period_and_search",
    METRICS_WITH
    + f"""select * from ({_COUNTRY}) where period_type = 'WEEK' and period_label = 'W03-2024'
    and (contains(lower(product_name), 'ring') or contains(lower(offer_id), 'ring'))""",
)
def f4(spark, sf):
    return board.selected_metrics(metrics(spark, sf), "WEEK", "W03-2024", " RING ", "NL")


_KPI_ROWS = f"rows_nl as ({_COUNTRY})"


@query(
    "a11_conversion_kpis",
    f"""{METRICS_WITH}, {_KPI_ROWS},
    best as (select * from rows_nl where period_type = 'MONTH'
             order by conversion_rate desc, product_name, offer_id limit 1),
    sums as (select sum(orders) as o, sum(visits_active) as v from rows_nl where period_type = 'MONTH')
    select cast(o as bigint) as total_orders, cast(v as bigint) as total_visits,
           {r("case when v > 0 then o::double / v::double * 100 else 0 end", 2)} as avg_conversion,
           product_name as top_product, {r("conversion_rate", 2)} as top_conversion
    from sums, best""",
)
def a11(spark, sf):
    return board.kpis(board.selected_metrics(metrics(spark, sf), "MONTH", country="NL"))


@query(
    "j10_daily_of_selected",
    DAILY_WITH
    + """select d.* from daily d where d.period_type = 'MONTH' and d.offer_id in (
        select offer_id from metrics where period_type = 'MONTH' and contains(lower(product_name), 'bolt'))""",
)
def j10(spark, sf):
    chosen = board.selected_metrics(metrics(spark, sf), "MONTH", text="bolt")
    return board.selected_daily(daily(spark, sf), chosen, "MONTH")


@query(
    "a12_daily_axis",
    DAILY_WITH
    + """select date, cast(sum(visits_be) as bigint) as visits, cast(sum(orders) as bigint) as orders
    from daily where period_type = 'MONTH' group by date""",
)
def a12(spark, sf):
    return board.daily_axis(daily(spark, sf).filter("period_type = 'MONTH'"), "BE")


TREND_DAYS = ["2024-01-03", "2024-01-10", "2024-01-17", "2024-01-24"]


def all_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics of four weeks, as they pile up in the metrics table."""
    return metrics(spark, sf, "weekly", TREND_DAYS)


_TREND = with_tables(
    "mp_offers", "mp_costs", "cv_orders", "cv_views",
    more=metrics_sql(TREND_DAYS) + ", weekly_rows as (select * from metrics where period_type = 'WEEK')",
)


@query(
    "a13_trend_top5",
    f"""{_TREND},
    weekly as (
        select product_name, date as week_end, period_label,
               case when sum(visits_total) > 0 then sum(orders)::double / sum(visits_total)::double * 100 else 0 end
                 as conversion
        from weekly_rows group by all),
    weeks as (select distinct date as week_end, period_label from weekly_rows),
    top as (
        select product_name, coalesce(max(conversion) filter (week_end = (select max(week_end) from weeks)), 0)
                 as latest
        from weekly group by product_name order by latest desc, product_name limit 5)
    select t.product_name, w.week_end, w.period_label, {r("coalesce(k.conversion, 0)", 4)} as conversion,
           {r("t.latest", 4)} as latest_conversion
    from top t cross join weeks w
    left join weekly k on k.product_name = t.product_name and k.week_end = w.week_end""",
)
def a13(spark, sf):
    return board.trend(all_metrics(spark, sf))


@query(
    "a16_periods",
    f"{_TREND} select period_label, max(date) as end_date from weekly_rows group by period_label",
)
def a16(spark, sf):
    return board.periods(all_metrics(spark, sf), "WEEK")


@query(
    "d2_newest_per_key",
    """select event_type, user_id, ts, event_id, value from events
    qualify row_number() over (partition by user_id, event_type order by cast(ts as date) desc, event_id desc) = 1""",
)
def d2(spark, sf):
    rows = read(spark, sf, "events").selectExpr(
        "user_id as offer_id", "event_type as period_type", "'' as period_label", "date(ts) as date",
        "event_id as seq", "ts", "value",
    )
    return board.newest_metrics(rows, "seq").selectExpr(
        "period_type as event_type", "offer_id as user_id", "ts", "seq as event_id", "value"
    )


@query(
    "o3_conversion_table",
    METRICS_WITH + """select * from metrics where period_type = 'MONTH'""",
)
def o3(spark, sf):
    return sorted_by(metrics(spark, sf).filter("period_type = 'MONTH'"), "conversion_rate", descending=True)


# --- payload shapes, one document per event --------------------------------------
_K = "cast(json_extract_string(props, '$.k') as integer)"


def _shapes(spark: SparkSession, sf: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    events = read(spark, sf, "events").withColumn("k", k)
    text = {
        # country list at top level, both spellings of the list
        "view": """concat('{"countries":[{"countryCode":"NL","total":', k, '},{"countryCode":"be","value":2.9}],',
                   '"country":[{"country":"NL","count":1},{"countryCode":"DE","total":50}]}')""",
        # wrapped per offer
        "click": """concat('{"offerInsights":[{"countries":[{"countryCode":"BE","visits":', k, '}]},',
                    '{"country":[{"countryCode":"","country":"nl","numberOfVisits":3}]}]}')""",
        # one level down
        "purchase": """concat('{"insights":[{"countries":[{"countryCode":"NL","total":', k, '}]}],',
                       '"results":[{"country":[{"country":"BE","total":4}]}],"total":999}')""",
        # only a total, or nothing usable
        "error": """concat('{"total":', k, ',"countries":"none"}')""",
        "signup": """concat('{"note":"x","offerInsights":[{"total":0},{"value":', k, '}]}')""",
    }
    cases = " ".join(f"when '{kind}' then {sql}" for kind, sql in text.items())
    return events.withColumn("payload", F.expr(f"case event_type {cases} end"))


@query(
    "p7_country_visits",
    f"""with e as (select event_id, event_type, {_K} as k from events)
    select event_id,
        cast(case event_type when 'view' then k + 1 when 'click' then 3 when 'purchase' then k else 0 end as bigint)
          as visits_nl,
        cast(case event_type when 'view' then 2 when 'click' then k when 'purchase' then 4 else 0 end as bigint)
          as visits_be,
        cast(case event_type when 'view' then k + 3 when 'click' then k + 3 when 'purchase' then k + 4
             when 'error' then k else k end as bigint) as visits_total
    from e""",
)
def p7(spark, sf):
    return insights.country_visits(_shapes(spark, sf)).select(
        "event_id", "visits_nl", "visits_be", "visits_total"
    )


def _series(spark: SparkSession, sf: str) -> DataFrame:
    events = read(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    return events.withColumn(
        "payload",
        F.expr(
            """concat(
            '{"periods":[{"date":"', string(date(ts)), '","total":7},',
            '{"day":"', string(date(ts)), 'T23:59:59Z","countries":[{"countryCode":"NL","total":', k, '}]},',
            '{"timestamp":"not a day","total":5}],',
            '"offerInsights":[{"days":[{"date":"', string(date_add(date(ts), 1)), 'T00:30:00+01:00",',
            '"country":[{"country":"BE","value":2}],"total":9}]},',
            '{"insights":[{"day":"","date":"', string(date_add(date(ts), 2)), '","value":3}]}]}')"""
        ),
    )


@query(
    "p8_daily_series",
    f"""with e as (select event_id, cast(ts as date) as d, {_K} as k from events)
    select event_id, d as day, cast(k as bigint) as visits_nl, cast(0 as bigint) as visits_be,
           cast(k as bigint) as visits_total from e
    union all select event_id, d + 1, 0, 2, 2 from e
    union all select event_id, d + 2, 0, 0, 3 from e""",
)
def p8(spark, sf):
    return insights.daily_series(_series(spark, sf)).select(
        "event_id", "day", "visits_nl", "visits_be", "visits_total"
    )


#: Elements that are no objects, before and after those that are.
_ODD = """'[["x",', k, '],', k, ',"', event_type, '",null,[[', k, ']],true'"""


@query(
    "p7_nested_lists",
    f"""with e as (select event_id, {_K} as k from events)
    select event_id, cast(k + 1 as bigint) as visits_nl, cast(2 as bigint) as visits_be,
        cast(k + 3 as bigint) as visits_total from e""",
)
def p7_nested(spark, sf):
    """Numbers, texts, nulls and lists stand among the objects of every list."""
    payload = f"""concat('{{"offerInsights":', {_ODD}, ',{{"countries":', {_ODD},
        ',{{"countryCode":"NL","total":', k, '}}]}},{{"items":', {_ODD},
        ',{{"country":', {_ODD}, ',{{"country":"be","count":2}}]}}]}}],"country":', {_ODD},
        ',{{"country":"nl","value":1.9}}]}}')"""
    events = read(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    documents = events.withColumn("payload", F.expr(payload))
    return insights.country_visits(documents).select("event_id", "visits_nl", "visits_be", "visits_total")


@query(
    "p8_nested_lists",
    f"""with e as (select event_id, cast(ts as date) as d, {_K} as k from events)
    select event_id, d as day, cast(k as bigint) as visits_nl, cast(0 as bigint) as visits_be,
        cast(k as bigint) as visits_total from e where k > 0
    union all select event_id, d, 0, 0, 7 from e where k = 0
    union all select event_id, d + 1, 0, 2, 2 from e""",
)
def p8_nested(spark, sf):
    payload = f"""concat('{{"days":', {_ODD}, ',{{"date":"', string(date(ts)), '","total":7,"countries":', {_ODD},
        ',{{"countryCode":"NL","total":', k, '}}]}},{{"day":', k + 1, ',"date":"', string(date(ts)), '"}}],',
        '"offerInsights":', {_ODD}, ',{{"periods":', {_ODD}, ',{{"timestamp":"', string(date_add(date(ts), 1)),
        'T10:00:00Z","country":', {_ODD}, ',{{"country":"BE","value":2}}]}}]}}]}}')"""
    events = read(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    documents = events.withColumn("payload", F.expr(payload))
    return insights.daily_series(documents).select("event_id", "day", "visits_nl", "visits_be", "visits_total")
