"""Effective-dated dimensions: every version of a row with its time of validity.

``apply_snapshot`` takes a new state of a dimension and keeps the old one: rows
whose attributes differ (by a hash of them) or that are gone are closed at the
new state's time, changed and new rows are opened. ``as_of_join`` gives each fact
row the version that was valid at its own time.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caldim.sources.spine import BROADCAST_MAX_ROWS

#: ``valid_to`` of versions that are still valid. Fixed value.
OPEN = dt.date(9999, 12, 31)
#: Days of the cells that versions and facts meet by where versions are too many to broadcast.
CELL_DAYS = 366

VERSION = ["version", "valid_from", "valid_to", "row_hash"]


def row_hash(columns: Sequence[str]) -> Column:
    """SHA-256 of a row's attributes, nulls told from all values."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def open_versions(snapshot: DataFrame, attributes: Sequence[str], valid_from: dt.date) -> DataFrame:
    """A first state: all rows valid from ``valid_from`` on."""
    return snapshot.select(
        "*", F.lit(1).alias("version"), F.lit(valid_from).alias("valid_from"), F.lit(OPEN).alias("valid_to"),
        row_hash(attributes).alias("row_hash"),
    )


def apply_snapshot(versions: DataFrame, snapshot: DataFrame, keys: Sequence[str], attributes: Sequence[str], at: dt.date) -> DataFrame:
    """All versions after ``snapshot`` has become the state valid from ``at`` on.

    A key's open version stays if its attributes are the same; if they differ it
    is closed (``valid_to`` = ``at``, the first day it does not hold) and the
    next version is opened; keys that the snapshot lacks are closed, new ones get
    version 1, and keys that return the version after their last. One full join
    by key; closed versions pass through it unchanged. Keys are unique in the snapshot
    and not null. ``at`` lies after every ``valid_from`` so far."""
    names = [*keys, *attributes]
    new = snapshot.select(*(F.col(c).alias(f"_n_{c}") for c in names), row_hash(attributes).alias("_n_hash"))
    # the version that a key has open, and its last number, ride along with the last version
    open_now = F.col("valid_to") == F.lit(OPEN)
    last = versions.groupBy(*(F.col(c).alias(f"_k_{c}") for c in keys)).agg(F.max("version").alias("_last"))
    on_last = [F.col(c) == F.col(f"_k_{c}") for c in keys]
    marked = versions.join(last, _all(on_last)).drop(*(f"_k_{c}" for c in keys))
    newest = F.col("version") == F.col("_last")
    older = marked.where(~newest).select(*versions.columns)
    both = marked.where(newest).join(new, _all([F.col(c) == F.col(f"_n_{c}") for c in keys]), "full")
    held, wanted = F.col("version").isNotNull(), F.col("_n_hash").isNotNull()
    same = held & wanted & open_now & (F.col("row_hash") == F.col("_n_hash"))
    closes = held & open_now & ~F.coalesce(same, F.lit(False))
    kept = both.where(held).select(
        *names, "version", "valid_from", F.when(closes, F.lit(at)).otherwise(F.col("valid_to")).alias("valid_to"), "row_hash"
    )
    opened = both.where(wanted & ~F.coalesce(same, F.lit(False))).select(
        *(F.col(f"_n_{c}").alias(c) for c in names), (F.coalesce("_last", F.lit(0)) + 1).alias("version"),
        F.lit(at).alias("valid_from"), F.lit(OPEN).alias("valid_to"), F.col("_n_hash").alias("row_hash"),
    )
    return older.select(*names, *VERSION).unionByName(kept).unionByName(opened)


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def as_of_join(
    facts: DataFrame, versions: DataFrame, on: dict[str, str], time: str, columns: Sequence[str], rows: int | None = None
) -> DataFrame:
    """``facts`` with ``columns`` of the version valid at the date ``time``
    (``valid_from`` <= time < ``valid_to``); nulls where none is. ``on`` maps
    fact columns to keys of the versions.

    With at most ``BROADCAST_MAX_ROWS`` versions (``rows``, counted if not given)
    they are broadcast, and a row meets the versions of its own key only. Beyond
    that both sides are dealt by key and by cells of ``CELL_DAYS`` days, which a
    version enters once for each that it touches within the facts' time: a key
    with many facts is spread over its cells, and AQE splits what is still uneven."""
    if rows is None:
        rows = versions.count()
    side = versions.select(
        *(F.col(k).alias(f"_v_{k}") for k in on.values()), F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to"),
        *(F.col(c).alias(f"_c_{c}") for c in columns),
    )
    when = F.to_date(time)
    match = [F.col(f).eqNullSafe(F.col(f"_v_{k}")) for f, k in on.items()]
    match += [when >= F.col("_from"), when < F.col("_to")]
    if rows <= BROADCAST_MAX_ROWS:
        joined = facts.join(F.broadcast(side), _all(match), "left")
    else:
        lo, hi = facts.agg(F.min(when), F.max(when)).first()
        cell = lambda d: F.expr(f"unix_date({d}) div {CELL_DAYS}")
        if lo is None:
            lo = hi = OPEN
        touched = side.where((F.col("_from") <= F.lit(hi)) & (F.col("_to") > F.lit(lo)))
        touched = touched.withColumns({"_a": F.greatest("_from", F.lit(lo)), "_e": F.least("_to", F.lit(hi))})
        touched = touched.withColumn("_cell", F.explode(F.sequence(cell("_a"), cell("_e")))).drop("_a", "_e")
        dealt = facts.withColumn("_when", when)
        dealt = dealt.withColumn("_fact_cell", cell("_when")).drop("_when")
        joined = dealt.join(touched, _all([*match, F.col("_fact_cell") == F.col("_cell")]), "left")
    return joined.select(*(F.col(c) for c in facts.columns), *(F.col(f"_c_{c}").alias(c) for c in columns))
