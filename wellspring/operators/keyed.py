"""Which row wins, what came before, what changed.

Skew: a key may own a large share of a table. ``latest_by`` filters on
``row_number() = 1``, which Spark turns into a per-task limit before the
shuffle, so a hot key sends one row per task. ``previous_by`` cuts every key
into ordered buckets and links the buckets through one summary row each, so no
task sorts a whole hot key. The other operators are partial aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ColumnLike = Column | str


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def latest_by(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[ColumnLike],
) -> DataFrame:
    """One row per key: the first in the given order (newest first).

    Null keys form one group, as any other value. The order must decide ties.
    """
    w = Window.partitionBy(*keys).orderBy(*[_col(o) for o in order])
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def last_nonnull(column: str, order: Column) -> Column:
    """Aggregate: the newest non-null value of one column."""
    return F.max_by(F.col(column), F.when(F.col(column).isNotNull(), order)).alias(column)


def first_nonnull(column: str, order: Column) -> Column:
    """Aggregate: the oldest non-null value of one column."""
    return F.min_by(F.col(column), F.when(F.col(column).isNotNull(), order)).alias(column)


def seen_range(
    date: str, active: str | None = None, suffix: str = ""
) -> list[Column]:
    """Aggregates: first and last date seen, and the same for active rows."""
    out = [F.min(date).alias("first_seen" + suffix), F.max(date).alias("last_seen" + suffix)]
    if active:
        when_active = F.when(F.col(active), F.col(date))
        out += [
            F.min(when_active).alias("first_active_date"),
            F.max(when_active).alias("last_active_date"),
        ]
    return out


HOT_ROWS = 5_000_000


def hot_keys(df: DataFrame, keys: Sequence[str], rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more rows than one task should sort.

    A table of n rows has fewer than n/rows of them: 200,000 for a million
    million rows and the default, a few megabytes.
    """
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows).drop("_n")


def _bucketed(
    df: DataFrame, keys: Sequence[str], bucket: Column, hot_rows: int
) -> DataFrame:
    """Add ``_bucket``: the given one for hot keys and null keys, else null.

    A null bucket of a hot key is the lowest one, as nulls sort first.

    The list of hot keys is bounded by their own size (see ``hot_keys``), so it
    is broadcast and the rows stay where they are. Without hot keys adaptive
    execution drops the join, and with it every branch that only serves them.
    """
    hot = F.broadcast(hot_keys(df, keys, hot_rows).withColumn("_hot", F.lit(True)))
    spread = F.col("_hot") | _any_null(keys)
    bucket = F.struct(bucket.isNotNull().alias("known"), bucket.alias("at"))
    return df.join(hot, list(keys), "left").select(
        *df.columns, F.when(spread, bucket).alias("_bucket")
    )


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(Column.__or__, [F.col(k).isNull() for k in keys])


def previous_by(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Sequence[str],
    bucket: Column,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add ``prev_<value>`` from the preceding row of the same key.

    A key with more than ``hot_rows`` rows is cut into buckets, which must not
    decrease along the order (the month of a date, for example). The lag then
    runs inside (key, bucket), and the first row of a bucket takes the last row
    of the bucket before, which travels as one pre-aggregated row per bucket.
    Rows with a null key belong to nothing and have no previous row.
    """
    parts = [*keys, "_bucket"]
    row = F.struct(*values)
    known = ~_any_null(keys)
    marked = _bucketed(df, keys, bucket, hot_rows)
    inside = Window.partitionBy(*parts).orderBy(*order)
    tails = (
        marked.where(F.col("_bucket").isNotNull() & known)
        .groupBy(*parts)
        .agg(F.max_by(row, F.struct(*order)).alias("_tail"))
    )
    across = Window.partitionBy(*keys).orderBy("_bucket")
    carried = tails.select(*parts, F.lag("_tail").over(across).alias("_carry")).where(
        "_carry is not null"
    )
    # joined on the columns of the window, so the rows are not moved again
    linked = marked.withColumn("_prev", F.when(known, F.lag(row).over(inside))).join(
        carried, parts, "left"
    )
    previous = F.coalesce("_prev", "_carry")
    return linked.select(
        *df.columns,
        *[previous[v].alias(f"prev_{v}") for v in values],
        previous.isNotNull().alias("has_prev"),
    )


def carry_forward(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    column: str,
    bucket: Column,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Fill a column with the newest non-null value at or before the row.

    Hot keys are cut into buckets like in ``previous_by``; keys are not null.
    """
    parts = [*keys, "_bucket"]
    marked = _bucketed(df, keys, bucket, hot_rows)
    inside = Window.partitionBy(*parts).orderBy(order)
    tails = (
        marked.where("_bucket is not null")
        .groupBy(*parts)
        .agg(last_nonnull(column, F.col(order)).alias("_tail"))
    )
    across = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    carried = tails.select(
        *parts, F.last("_tail", ignorenulls=True).over(across).alias("_carry")
    ).where("_carry is not null")
    filled = F.last(column, ignorenulls=True).over(inside)
    return (
        marked.withColumn("_own", filled)
        .join(carried, parts, "left")
        .select(
            *[c for c in df.columns if c != column],
            F.coalesce("_own", "_carry").alias(column),
        )
    )


def transitions(
    df: DataFrame, key: str, date: str, state: str, order: Sequence[str] | None = None
) -> DataFrame:
    """Rows whose state differs from the row before (first rows excluded)."""
    order = list(order or [date])
    with_prev = previous_by(df, [key], order, [state], F.trunc(F.col(date), "month"))
    return with_prev.where(
        F.col("has_prev")
        & F.col(f"prev_{state}").isNotNull()
        & (F.col(f"prev_{state}") != F.col(state))
    ).drop("has_prev")


def first_events(
    df: DataFrame, key: str, date: str, columns: Sequence[str], order: Column | None = None
) -> DataFrame:
    """One row per key: the first non-null value of every column, first date."""
    order = F.col(date) if order is None else order
    return df.groupBy(key).agg(
        F.min(date).alias("event_date"), *[first_nonnull(c, order) for c in columns]
    )


def snapshot_order(df: DataFrame, snapshot: str, per: Sequence[str] = ()) -> DataFrame:
    """Distinct snapshots with the one before (``prev_snapshot``).

    One row per publication date: the window runs over dates, not over data.
    """
    w = Window.partitionBy(*per).orderBy(snapshot)
    return (
        df.select(*per, snapshot).distinct().withColumn("prev_snapshot", F.lag(snapshot).over(w))
    )


def snapshot_changes(df: DataFrame, key: str, snapshot: str, column: str) -> DataFrame:
    """Value changes between *consecutive* snapshots, by lag.

    A key missing from a snapshot breaks the chain, so a gap is no change.
    Returns key, old_<column>, new_<column>, change_date.
    """
    one_each = df.groupBy(key, snapshot).agg(F.max(column).alias(column))
    with_prev = previous_by(
        one_each, [key], [snapshot], [snapshot, column], F.substring(snapshot, 1, 7)
    )
    dates = snapshot_order(df, snapshot)
    return (
        with_prev.where(F.col("has_prev"))
        .join(dates, snapshot)
        .where(
            (F.col(f"prev_{snapshot}") == F.col("prev_snapshot"))
            & (F.col(f"prev_{column}") != F.col(column))
        )
        .select(
            key,
            F.col(f"prev_{column}").alias(f"old_{column}"),
            F.col(column).alias(f"new_{column}"),
            F.col(snapshot).alias("change_date"),
        )
    )


def snapshot_pairs(df: DataFrame, key: str, snapshot: str, column: str) -> DataFrame:
    """The same changes by pairing each row with the next snapshot.

    Every row appears as the new side of its own snapshot and as the old side
    of the following one; a single aggregate brings both sides together, so
    there is one shuffle on (key, snapshot) and nothing to skew a self-join.
    """
    dates = snapshot_order(df, snapshot)
    following = dates.select(
        F.col("prev_snapshot").alias(snapshot), F.col(snapshot).alias("next_snapshot")
    ).where(F.col(snapshot).isNotNull())
    sides = (
        df.select(key, snapshot, column)
        .join(following, snapshot, "left")
        .select(
            key,
            F.explode(
                F.array(
                    F.struct(
                        F.col(snapshot).alias("change_date"),
                        F.col(column).alias("new"),
                        F.lit(None).cast("string").alias("old"),
                    ),
                    F.struct(
                        F.col("next_snapshot").alias("change_date"),
                        F.lit(None).cast("string").alias("new"),
                        F.col(column).alias("old"),
                    ),
                )
            ).alias("side"),
        )
        .select(key, "side.*")
        .where("change_date is not null")
    )
    return (
        sides.groupBy(key, "change_date")
        .agg(F.max("old").alias(f"old_{column}"), F.max("new").alias(f"new_{column}"))
        .where(F.col(f"old_{column}") != F.col(f"new_{column}"))
        .select(key, f"old_{column}", f"new_{column}", "change_date")
    )


def mom_change(df: DataFrame, value: str = "oil_prod_vol") -> DataFrame:
    """Change against the previous producing month of the same well."""
    year = F.substring("productionmonth", 1, 4)
    out = previous_by(df, ["uwi"], ["productionmonth"], [value], year).drop("has_prev")
    change = (F.col(value) - F.col(f"prev_{value}")) / F.nullif(
        F.col(f"prev_{value}"), F.lit(0)
    )
    return out.withColumn("mom_change_pct", change * 100)


def look_ahead(
    lines: DataFrame,
    values: dict[str, tuple[Column, int]],
    keys: Sequence[str] = ("file", "member"),
    block: int = 50_000,
) -> DataFrame:
    """Add columns computed on lines further down the same file.

    ``values`` maps a new column to (expression, lines ahead). Files are cut
    into blocks of lines so that a huge file is many tasks; the first lines of
    a block also travel with the block before it, where the look-ahead of its
    last lines needs them.
    """
    span = max(ahead for _, ahead in values.values())
    if block < span:
        raise ValueError("a block must be at least as long as the look-ahead")
    own = F.floor(F.col("line_no") / block)
    offset = F.col("line_no") % block
    borrowed = F.when((offset < span) & (own > 0), F.array(own, own - 1)).otherwise(F.array(own))
    cut = lines.withColumn("_block", F.explode(borrowed))
    w = Window.partitionBy(*keys, "_block").orderBy("line_no")
    return (
        cut.withColumns({n: F.lead(e, k).over(w) for n, (e, k) in values.items()})
        .where(F.col("_block") == own)
        .drop("_block")
    )
