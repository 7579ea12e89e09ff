"""Visit counts from insights payloads of several shapes.

A payload is parsed once into a VARIANT. An object becomes a struct of VARIANT fields in
one step; a field that is absent is NULL, and so is the struct of an element that is no
object, so a number, a text or a list among the elements of a list takes nothing else with
it. Lists stay in array functions, so no row is exploded before its numbers are known.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tillmetrics.fixed import VISIT_COUNT_KEYS
from tillmetrics.functions.dates import iso_day
from tillmetrics.schemas import DAILY_PAYLOAD, PERIOD_PAYLOAD

_NUMBER_KINDS = r"^(BIGINT|DECIMAL|DOUBLE|FLOAT)"
_LISTS = ["countries", "country"]
_BELOW = ["insights", "items", "results"]
_SERIES = ["insights", "results", "items", "days", "periods"]
_DAYS = ["day", "date", "timestamp"]


def _fields(names: Sequence[str]) -> str:
    return "struct<" + ", ".join(f"{n}: variant" for n in dict.fromkeys(names)) + ">"


_COUNTRY = _fields(["countryCode", "country", *VISIT_COUNT_KEYS])
_SUB = _fields(_LISTS)
_NODE = _fields([*_LISTS, *_BELOW, *VISIT_COUNT_KEYS, "offerInsights"])
_DAY = _fields([*_LISTS, *_BELOW, *VISIT_COUNT_KEYS, "offerInsights", *_DAYS])
_FILE = _fields([*_SERIES, "offerInsights"])


def _parsed(payload: Column, schema: str) -> Column:
    """The payload as VARIANT; NULL for what is no JSON.

    The variant parser refuses a key that stands twice in one object. Such a payload is
    read through the schema of what is known, in which the last one counts.
    """
    again = F.to_json(F.from_json(payload, schema))
    return F.coalesce(F.try_parse_json(payload), F.try_parse_json(again))


def _object(value: Column, fields: str) -> Column:
    """The struct of an object; NULL for anything else."""
    return F.try_variant_get(value, "$", fields)


def _objects(node: Column, names: Sequence[str], fields: str) -> Column:
    """The objects in the lists of these names, in this order; NULL for other elements."""
    kind = f"array<{fields}>"

    def one(value: Column) -> Column:
        elements = F.try_variant_get(value, "$", "array<variant>")
        found = F.transform(elements, lambda e: _object(e, fields))
        return F.when(value.isNull(), F.array().cast(kind)).otherwise(F.coalesce(found, F.array().cast(kind)))

    return F.concat(*(one(node[n]) for n in names))


def _count(node: Column, keys: Sequence[str] = VISIT_COUNT_KEYS) -> Column:
    """First number among these fields of a node as a whole number, 0 without one; text is no number."""

    def number(value: Column) -> Column:
        is_number = F.schema_of_variant(value).rlike(_NUMBER_KINDS)
        return F.when(value.isNotNull() & is_number, F.try_variant_get(value, "$", "bigint"))

    return F.coalesce(*(number(node[k]) for k in keys), F.lit(0).cast("bigint"))


def _countries(node: Column) -> Column:
    """Country entries of a node: its own lists and those one level down."""
    below = F.transform(_objects(node, _BELOW, _SUB), lambda s: _objects(s, _LISTS, _COUNTRY))
    has_below = F.coalesce(*(node[n] for n in _BELOW)).isNotNull()
    own = _objects(node, _LISTS, _COUNTRY)
    return F.when(has_below, F.concat(own, F.flatten(F.filter(below, lambda b: b.isNotNull())))).otherwise(own)


def _visits(entries: Column) -> Column:
    """Struct of the visits of NL and BE over country entries."""

    def pair(nl: Column, be: Column) -> Column:
        return F.struct(nl.cast("bigint").alias("nl"), be.cast("bigint").alias("be"))

    def one(entry: Column) -> Column:
        texts = [F.nullif(F.try_variant_get(entry[n], "$", "string"), F.lit("")) for n in ("countryCode", "country")]
        return F.struct(F.upper(F.coalesce(*texts)).alias("code"), _count(entry).alias("n"))

    def add(total: Column, entry: Column) -> Column:
        return pair(
            total["nl"] + F.when(entry["code"] == "NL", entry["n"]).otherwise(0),
            total["be"] + F.when(entry["code"] == "BE", entry["n"]).otherwise(0),
        )

    return F.aggregate(F.transform(entries, one), pair(F.lit(0), F.lit(0)), add)


def _with_visits(df: DataFrame, node: str) -> DataFrame:
    """Add _nl, _be and _own, the count to fall back on, of the struct of a payload or of one of its days.

    The fallback is the first positive count of the payload and its wrapped nodes, or
    else whatever the last of them says.
    """
    nodes = df.withColumn("_wrapped", _objects(F.col(node), ["offerInsights"], _NODE))
    any_wrapped = F.size("_wrapped") > 0
    own = _countries(F.col(node))
    entries = F.when(any_wrapped, F.concat(own, F.flatten(F.transform("_wrapped", _countries)))).otherwise(own)
    counts = F.transform("_wrapped", lambda n: _count(n))
    counted = nodes.withColumns({"_v": _visits(entries), "_first": _count(F.col(node)), "_counts": counts})
    first = F.col("_first")
    fallback = F.when((first > 0) | (F.size("_counts") == 0), first).otherwise(
        F.coalesce(F.get(F.filter("_counts", lambda x: x > 0), F.lit(0)), F.element_at("_counts", -1))
    )
    visits = [F.coalesce(F.col(f"_v.{c}"), F.lit(0)) for c in ("nl", "be")]
    return counted.withColumns({"_nl": visits[0], "_be": visits[1], "_own": fallback})


def _total() -> Column:
    both = F.col("_nl") + F.col("_be")
    return F.when(both != 0, both).otherwise(F.col("_own"))


def country_visits(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Add visits_nl, visits_be and visits_total read from the JSON text."""
    parsed = df.withColumn("_doc", _object(_parsed(F.col(payload), PERIOD_PAYLOAD), _NODE))
    return _with_visits(parsed, "_doc").select(
        *df.columns,
        F.col("_nl").alias("visits_nl"),
        F.col("_be").alias("visits_be"),
        _total().alias("visits_total"),
    )


def _day_text(entry: Column) -> Column:
    """The text of the first of day, date and timestamp that says anything; a number is no day."""

    def said(value: Column) -> Column:
        kind, text = F.schema_of_variant(value), F.try_variant_get(value, "$", "string")
        other = F.when((kind != "VOID") & ~text.isin("0", "0.0", "false"), "-")
        return F.when(value.isNotNull(), F.when(kind == "STRING", F.nullif(text, F.lit(""))).otherwise(other))

    return F.coalesce(*(said(entry[name]) for name in _DAYS))


def daily_series(df: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per day of each series; the last entry of a day wins.

    The last position of each day is found by sorting days and positions inside the
    row, so no shuffle is needed; visits are counted for the entries that are left,
    in columns of their own.
    """
    offer = _fields(["periods", "days", "insights"])
    offers = _objects(F.col("_doc"), ["offerInsights"], offer)
    wrapped = F.transform(offers, lambda o: _objects(o, ["periods", "days", "insights"], _DAY))
    entries = F.concat(_objects(F.col("_doc"), _SERIES, _DAY), F.flatten(wrapped))
    places = F.sort_array(
        F.filter(
            F.transform("_days", lambda d, i: F.struct(iso_day(d).alias("day"), i.alias("pos"))),
            lambda p: p["day"].isNotNull(),
        )
    )
    lasts = F.filter(
        F.col("_places"),
        lambda p, i: F.coalesce(F.get(F.col("_places"), i + 1)["day"] != p["day"], F.lit(True)),
    )
    kept = F.transform(lasts, lambda p: F.struct(p["day"].alias("day"), F.get(F.col("_all"), p["pos"]).alias("entry")))
    exploded = (
        df.withColumn("_doc", _object(_parsed(F.col(payload), DAILY_PAYLOAD), _FILE))
        .withColumn("_all", entries)
        .withColumn("_days", F.transform("_all", _day_text))
        .withColumn("_places", places)
        .select(*df.columns, F.explode(kept).alias("_d"))
        .select(*df.columns, F.col("_d.day").alias("_day"), F.col("_d.entry").alias("_entry"))
    )
    counted = _with_visits(exploded, "_entry").withColumn("_all_visits", _total())
    # An entry may carry its own count when its countries say nothing.
    own = _count(F.col("_entry"), VISIT_COUNT_KEYS[:3])
    return counted.select(
        *df.columns,
        F.col("_day").alias("day"),
        F.col("_nl").alias("visits_nl"),
        F.col("_be").alias("visits_be"),
        F.when(F.col("_all_visits") == 0, own).otherwise(F.col("_all_visits")).alias("visits_total"),
    )
