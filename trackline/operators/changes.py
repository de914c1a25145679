"""Table maintenance without a database: insert-if-absent, stamped upsert, change log.

All three are joins on the table key.  None broadcasts: table sizes grow with
the data, so the join strategy is left to AQE, which switches to a broadcast
only after measuring a side below the threshold.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackline.functions.numeric import ntz_literal


def insert_if_absent(existing: DataFrame, new: DataFrame, key: str | list[str],
                     order_col: str | None = None) -> DataFrame:
    """``INSERT ... ON CONFLICT (key) DO NOTHING``: existing rows win, one row of each new key is added.

    Of several new rows with one key the first by ``order_col`` is added (any one of them without it).
    """
    key = [key] if isinstance(key, str) else key
    fresh = new.join(existing.select(*key), key, "left_anti")
    if order_col is None:
        fresh = fresh.dropDuplicates(key)
    else:
        rest = [c for c in existing.columns if c not in key]
        fresh = (fresh.groupBy(*key).agg(F.min(F.struct(F.col(order_col).alias("_order"), *rest)).alias("_first"))
                 .select(*key, *[F.col(f"_first.{c}").alias(c) for c in rest]))
    return existing.unionByName(fresh.select(*existing.columns))


def _changed(cols: list[str], old: str = "o", new: str = "n") -> Column:
    """True when any of ``cols`` differs (NULL-safe) between the two sides."""
    return reduce(lambda a, b: a | b, [~F.col(f"{old}.{c}").eqNullSafe(F.col(f"{new}.{c}")) for c in cols])


def last_of_key(df: DataFrame, key: str, order_col: str | None = None) -> DataFrame:
    """One row per key, the last by ``order_col`` (ties and no order: the largest row); a null key is a key.

    An aggregation with partial maxima in every task, so a key with many rows meets in its maxima only.
    """
    rest = [c for c in df.columns if c != key]
    order = [F.col(order_col).alias("_order")] if order_col else []
    return (df.groupBy(key).agg(F.max(F.struct(*order, *rest)).alias("_last"))
            .select(*[F.col(key) if c == key else F.col(f"_last.{c}").alias(c) for c in df.columns]))


def upsert_stamped(current: DataFrame, incoming: DataFrame, key: str, as_of: dt.datetime | Column,
                   stamp_cols: tuple[str, str] = ("created_at", "updated_at"), order_col: str | None = None) -> DataFrame:
    """Upsert ``incoming`` into ``current`` and stamp changed rows: one row per key.

    Of several incoming rows with one key the last by ``order_col`` (a column of ``incoming``, not stored)
    counts, of several current ones the last updated.

    Values: incoming wins where present.  ``updated_at`` becomes ``as_of`` for
    new or changed rows and keeps its old value otherwise; ``created_at`` is
    kept, or ``as_of`` for new rows.  ``current`` must carry both stamp columns.
    """
    created, updated = stamp_cols
    now = as_of if isinstance(as_of, Column) else ntz_literal(as_of)
    cols = [c for c in incoming.columns if c != key and c != order_col and c not in stamp_cols]
    old, new = last_of_key(current, key, updated), last_of_key(incoming, key, order_col)
    j = old.withColumn("_in", F.lit(1)).alias("o").join(new.withColumn("_in", F.lit(1)).alias("n"),
                                                        F.col(f"o.{key}").eqNullSafe(F.col(f"n.{key}")), "full_outer")
    o_missing, n_missing = F.col("o._in").isNull(), F.col("n._in").isNull()
    changed = _changed(cols)
    return j.select(
        F.coalesce(F.col(f"n.{key}"), F.col(f"o.{key}")).alias(key),
        *[F.when(n_missing, F.col(f"o.{c}")).otherwise(F.col(f"n.{c}")).alias(c) for c in cols],
        F.when(o_missing, now).otherwise(F.col(f"o.{created}")).alias(created),
        F.when(n_missing, F.col(f"o.{updated}")).when(o_missing | changed, now)
        .otherwise(F.col(f"o.{updated}")).alias(updated),
    )


def table_changes(old: DataFrame, new: DataFrame, key: str, table_name: str, order_col: str | None = None) -> DataFrame:
    """Change log between two snapshots of a table (an audit trail without triggers).

    A snapshot with several rows of one key stands for the last of them by ``order_col``.

    One row per inserted, deleted or updated key: ``operation``,
    ``table_name``, ``record_id`` and the old/new rows as JSON (NULL fields
    kept).  Unchanged rows are dropped with a NULL-safe comparison.
    """
    cols = [c for c in new.columns if c != key]
    old, new = (last_of_key(t, key, order_col).withColumn("_in", F.lit(1)) for t in (old, new))
    j = old.alias("o").join(new.alias("n"), F.col(f"o.{key}").eqNullSafe(F.col(f"n.{key}")), "full_outer")
    o_missing, n_missing = F.col("o._in").isNull(), F.col("n._in").isNull()
    opts = {"ignoreNullFields": "false"}
    old_json = F.to_json(F.struct(*[F.col(f"o.{c}").alias(c) for c in [key] + cols]), opts)
    new_json = F.to_json(F.struct(*[F.col(f"n.{c}").alias(c) for c in [key] + cols]), opts)
    return j.where(o_missing | n_missing | _changed(cols)).select(
        F.when(o_missing, "INSERT").when(n_missing, "DELETE").otherwise("UPDATE").alias("operation"),
        F.lit(table_name).alias("table_name"),
        F.coalesce(F.col(f"n.{key}"), F.col(f"o.{key}")).cast("long").alias("record_id"),
        F.when(~o_missing, old_json).alias("old_values"),
        F.when(~n_missing, new_json).alias("new_values"),
    )
