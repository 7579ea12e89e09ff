"""Keyed operations: newest row, replace-upsert, conditional merge, delete.

All are plain DataFrame functions. Row order means nothing in Spark, so
"later" is always an explicit ``seq`` column (or several).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], *order: Column | str) -> DataFrame:
    """The first row of each key in ``order``.

    Spark turns rank = 1 into a group limit before the shuffle, so each task
    sends at most one row per key and a hot key stays small.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def last_per_key(df: DataFrame, keys: Sequence[str], seq: Sequence[str]) -> DataFrame:
    return first_per_key(df, keys, *[F.col(c).desc() for c in seq])


def replace_upsert(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    seq: Sequence[str],
    update_columns: Sequence[str] | None = None,
    keep_newer: bool = False,
    one_per_key: bool = False,
) -> DataFrame:
    """Rows of ``old`` with every key found in ``new`` replaced by its last new row.

    With ``keep_newer`` an old row stays where its ``seq`` columns are later than
    those of the new one; a tie goes to the new row.

    NULL in a key equals NULL, so loading a batch twice gives the same rows.
    With ``update_columns`` only those columns of an existing row change.
    ``one_per_key``: ``new`` has one row per key; else it is brought down to that
    first, so that of a hot key each task sends one row on.
    """
    if not one_per_key:
        new = last_per_key(new, keys, seq)
    names = [*old.columns, *[c for c in new.columns if c not in old.columns and c not in seq]]
    if update_columns is None:
        # Old and new rows together, the last new row of a key first; NULL is a key like any other.
        # Old rows tie with each other, so all of them stay where no new row came.
        order = [F.col("_new").desc()] + [F.when(F.col("_new") == 1, F.col(c)).desc() for c in seq]
        if keep_newer:
            order = [F.col(c).desc() for c in seq if c in old.columns] + order
        both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
        window = Window.partitionBy(*keys).orderBy(*order)
        ranked = both.withColumn("_rank", F.rank().over(window)).withColumn("_row", F.row_number().over(window))
        return ranked.filter("_rank = 1 and (_new = 0 or _row = 1)").select(*names)
    newest = new.drop(*[c for c in seq if c not in old.columns])
    kept_columns = [c for c in old.columns if c not in keys and c not in update_columns]
    left = old.withColumn("_had", F.lit(True)).alias("o")
    right = newest.withColumn("_got", F.lit(True)).alias("n")
    same_key = reduce(and_, [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys])
    merged = left.join(right, same_key, "full_outer")
    chosen = [F.coalesce(f"o.{k}", f"n.{k}").alias(k) for k in keys]
    for name in old.columns:
        if name in keys:
            continue
        o, n = F.col(f"o.{name}"), F.col(f"n.{name}")
        if name in kept_columns:
            chosen.append(F.when(F.col("o._had"), o).otherwise(n).alias(name))
        else:
            chosen.append(F.when(F.col("n._got"), n).otherwise(o).alias(name))
    return merged.select(*chosen).select(*old.columns)


def conditional_merge(
    old: DataFrame,
    new: DataFrame,
    key: str,
    seq: Sequence[str],
    name_column: str = "product_name",
    stamp_column: str | None = None,
    stamp: Column | None = None,
) -> DataFrame:
    """Merge partial changes into a cost table, one change after the other.

    A missing number keeps the old number; a blank or missing name keeps the
    old name. Several changes of one key collapse first: per column the last
    given value, found with a map-side combined aggregate.
    """
    stamps = [stamp_column] if stamp_column else []
    numbers = [c for c in old.columns if c not in (key, name_column, *stamps)]
    order = F.struct(*seq)

    def last_given(value: Column, given: Column) -> Column:
        return F.max_by(value, F.when(given, order))

    def given_columns() -> list[Column]:
        out = [
            last_given(F.col(name_column), F.col(name_column) != "").alias("_name"),
            F.min_by(F.col(name_column), order).alias("_first_name"),
            F.lit(True).alias("_got"),
        ]
        for c in numbers:
            value = F.col(c) if c in new.columns else F.lit(None).cast(old.schema[c].dataType)
            out.append(last_given(value, value.isNotNull()).alias(f"_{c}_new"))
        return out

    changes = new.groupBy(key).agg(*given_columns())
    changes = changes.withColumnRenamed(key, "_key")
    merged = old.withColumn("_had", F.lit(True)).join(changes, F.col(key).eqNullSafe(F.col("_key")), "full_outer")
    merged = merged.withColumn(key, F.coalesce(key, "_key"))
    name = F.coalesce(
        F.col("_name"),
        F.when(F.col("_had"), F.col(name_column)).otherwise(F.col("_first_name")),
    )
    columns: list[Column] = []
    for c in old.columns:
        if c == key:
            columns.append(F.col(key))
        elif c == name_column:
            columns.append(name.alias(c))
        elif c == stamp_column:
            now = stamp if stamp is not None else F.localtimestamp()
            columns.append(F.when(F.col("_got"), now).otherwise(F.col(c)).alias(c))
        else:
            columns.append(F.coalesce(F.col(f"_{c}_new"), F.col(c)).alias(c))
    return merged.select(*columns)


def keyed_delete(table: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not listed; a blank listed key removes '' and NULL keys.

    Blank keys are settled by one yes or no, so that they never meet in the join.
    """
    blank = F.trim(F.coalesce(F.col(key), F.lit(""))) == ""
    listed = keys.filter(~blank).select(F.col(key).alias("_key")).distinct()
    any_blank = keys.agg(F.coalesce(F.max(blank), F.lit(False))).scalar()
    empty = F.coalesce(F.col(key), F.lit("")) == ""
    left = table.filter(~empty).join(listed, F.col(key) == F.col("_key"), "left_anti")
    return left.unionByName(table.filter(empty).filter(~any_blank))
