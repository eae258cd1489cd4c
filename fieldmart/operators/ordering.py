"""Total orders of whole tables by range partitioning: places of rows, ordered reports, and id lists in parts of bounded size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldmart.session import stored

#: Ids of one part of a list.
PART = 500
#: How the reports are sorted: columns, with - before one that descends. Nulls come last in either direction.
ORDERS = {
    "qc_summary": ("countrycode", "tabletnum"),
    "flagged_messages": ("health_facility_ug", "subjid"),
    "weekly_report": ("health_facility_ug", "week"),
    "delivery_linelist": ("site_code", "week", "sent_at_local"),
    "similar_name": ("-similarity",),
    "messages_sent": ("-sent_at",),
    "messages_failed": ("-sent_at",),
}


def sort_keys(df: DataFrame, order: Sequence[str]) -> list[Column]:
    """The order's columns, then all others that can be sorted, so that only equal rows tie."""
    named = [c.lstrip("-") for c in order]
    keys = [F.desc_nulls_last(n) if c.startswith("-") else F.asc_nulls_last(n) for c, n in zip(order, named, strict=True)]
    return keys + [F.asc_nulls_last(c) for c, kind in df.dtypes if c not in named and not kind.startswith("map")]


def in_order(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """df in the order: ranges of it are sorted apart, and what is written has them in the order of its file names."""
    return df.orderBy(*sort_keys(df, order))


def placed(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """df with ``place``: 1 for the first row of the order, and so on through the whole table.

    The sorted ranges are stored once with the row's number in its range; what comes before a range is the sum of the counts of those before it,
    which are few (the shuffle's partitions). No task sees more than its range. Rows that are equal in all columns take their
    places in any order; nulls come last; an empty table gives none.
    """
    numbered = stored(in_order(df, order).withColumn("_at", F.monotonically_increasing_id()), "ordered")
    of_range = numbered.withColumn("_range", F.call_function("shiftright", "_at", F.lit(33)))
    counts = of_range.groupBy("_range").agg(F.count("*").alias("_n"))
    before = counts.select("_range", (F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias("_before"))
    row = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return of_range.join(F.broadcast(before), "_range").withColumn("place", F.col("_before") + row + 1).drop("_at", "_range", "_before")


def id_parts(rows: DataFrame, group: Sequence[str], id_: str, size: int = PART) -> DataFrame:
    """The distinct ids of each group, sorted, in parts of at most ``size``: the group's columns, part (from 0), ids (an array).

    Any number of ids of one group is spread over ranges: an id's part comes from its place in the order of all groups, less the
    first place of its own. Parts of one group, in order, are its list; texts are joined for people only (``joined``). Null ids go; a group without
    ids has no part.
    """
    distinct = rows.filter(F.col(id_).isNotNull()).select(*group, F.col(id_).alias("_id")).distinct()
    places = placed(distinct, [*group, "_id"])
    first = places.groupBy(*[F.col(c).alias(f"_{i}") for i, c in enumerate(group)]).agg(F.min("place").alias("_first"))
    part = ((F.col("place") - F.col("_first")) / size).cast("long")
    parts = places.join(first, [F.col(c).eqNullSafe(F.col(f"_{i}")) for i, c in enumerate(group)]).select(*group, part.alias("part"), "_id")
    return parts.groupBy(*group, "part").agg(F.array_sort(F.collect_list("_id")).alias("ids"))


def joined(parts: DataFrame, separator: str) -> DataFrame:
    """Each part as text."""
    return parts.withColumn("ids", F.array_join("ids", separator))
