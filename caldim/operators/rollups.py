"""Rollups of measures that do not add up, and of whole hierarchies.

Distinct counts and quantiles of a week do not follow from those of its days, but
their sketches merge: one scan of the fact stores a HyperLogLog sketch and a KLL
sketch a day and group, from which any set of days is answered. Where the sketch's
error could change a decision, and only there, the fact decides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caldim.functions import calendar as cal
from caldim.operators.facts import TO_DATE_FLAGS

#: lg of the registers of a distinct-count sketch, and its relative standard error.
LG_K = 12
DISTINCT_ERROR = 1.04 / 2 ** (LG_K / 2)
#: Size of a quantile sketch, and a bound of its error in rank (about 0.4 % at 99 % confidence).
KLL_K, RANK_ERROR = 800, 0.012


def daily_sketches(fact: DataFrame, date_col: str, by: Sequence[str], distinct: str, value: str) -> DataFrame:
    """(day, by..., rows, n_values, keys, values): for each day and group the
    rows, a sketch of the distinct values of ``distinct`` and one of the
    distribution of ``value`` (nulls count in neither). Built map-side first."""
    return fact.groupBy(cal.as_date(date_col).alias("day"), *by).agg(
        F.count(F.lit(1)).alias("rows"), F.count(value).alias("n_values"),
        F.hll_sketch_agg(distinct, F.lit(LG_K)).alias("keys"),
        F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(KLL_K)).alias("values"),
    )


def merged(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sketches of all days of a group together."""
    return sketches.groupBy(*by).agg(
        F.sum("rows").alias("rows"), F.sum("n_values").alias("n_values"), F.hll_union_agg("keys").alias("keys"),
        F.kll_merge_agg_double("values").alias("values"),
    )


def flagged_days(dim: DataFrame, name: Column, flags: dict[str, str] | None = None) -> DataFrame:
    """(as_of, flag, day) for the days that each flag of a rolled dimension marks."""
    flags = flags or TO_DATE_FLAGS
    marked = F.filter(F.array(*(F.when(F.col(c) == "YES", F.lit(k)) for k, c in flags.items())), lambda x: x.isNotNull())
    return dim.select(name.alias("as_of"), F.explode(marked).alias("flag"), F.col("calendar_date").alias("day"))


def decisions(
    sketches: DataFrame, sets: DataFrame, fact: DataFrame, date_col: str, by: Sequence[str], distinct: str, value: str,
    least_distinct: int, limit: float,
) -> DataFrame:
    """For each set of days (``sets``: name columns and day, few enough to
    broadcast) and group: rows, ``many`` - ``least_distinct`` or more distinct
    values - and ``half_below`` - at least half of the values lie below ``limit``.

    The stored sketches answer what lies outside their error; sets within it are
    counted from the fact, cut to their days. Without such sets it is not read."""
    names = [c for c in sets.columns if c != "day"]
    keys = [*names, *by]
    days = F.broadcast(sets)
    found = merged(sketches.join(days, "day"), keys)
    estimate = F.hll_sketch_estimate("keys")
    margin = 5 * DISTINCT_ERROR * F.lit(least_distinct) + 1
    share = F.kll_sketch_get_rank_double("values", F.lit(float(limit)))
    known = found.select(
        *keys, "rows", F.when(F.abs(estimate - least_distinct) > margin, estimate >= least_distinct).alias("many"),
        F.when(F.col("n_values") == 0, F.lit(False)).when(F.abs(share - 0.5) > 2 * RANK_ERROR, share >= 0.5).alias("half_below"),
    )
    open_sets = known.where("many is null or half_below is null").select(*keys)
    if open_sets.isEmpty():
        return known
    wanted = sets.join(open_sets, names)
    here = fact.select(cal.as_date(date_col).alias("day"), *by, F.col(distinct).alias("_key"), F.col(value).cast("double").alias("_value"))
    same = here["day"] == wanted["day"]
    for c in by:
        same = same & here[c].eqNullSafe(wanted[c])
    exact = here.join(wanted, same).select(*names, *(here[c] for c in by), "_key", "_value")
    exact = exact.groupBy(*keys).agg(
        (F.count_distinct("_key") >= least_distinct).alias("_many"),
        F.coalesce(F.count_if(F.col("_value") < limit) * 2 >= F.count("_value"), F.lit(False)).alias("_below"), F.count("_value").alias("_n"),
    )
    exact = exact.select(*(F.col(c).alias(f"_k_{c}") for c in keys), "_many", (F.col("_below") & (F.col("_n") > 0)).alias("_below"))
    on = None
    for c in keys:
        one = F.col(c).eqNullSafe(F.col(f"_k_{c}"))
        on = one if on is None else on & one
    both = known.join(exact, on, "left")
    return both.select(*keys, "rows", F.coalesce("many", "_many").alias("many"), F.coalesce("half_below", "_below").alias("half_below"))


def hierarchy_totals(daily: DataFrame, hierarchies: dict[str, list[str]], measures: Sequence[str], total: str = "all") -> DataFrame:
    """Totals at every level of some hierarchies in one pass over ``daily`` rows
    that hold their columns: (hierarchy, level, columns..., measures).

    ``hierarchies`` lists columns from the top level down. A level's row has the
    columns of it and those above; ``level`` tells subtotals from rows whose
    label itself is null; the total over everything is one row, named ``total``.
    One aggregation by grouping sets, not one for each level."""
    columns = list(dict.fromkeys(c for cols in hierarchies.values() for c in cols))
    sets, names = [[]], {}
    for name, cols in hierarchies.items():
        for k, c in enumerate(cols):
            sets.append(cols[: k + 1])
            names[frozenset(cols[: k + 1])] = (name, c)
    grouped = daily.groupingSets([[F.col(c) for c in s] for s in sets], *(F.col(c) for c in columns)).agg(
        *(F.sum(m).alias(m) for m in measures), F.grouping_id().alias("_id")
    )
    # grouping_id has a bit for each column that is summed over, the first column's the highest
    ids = {sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in s): s for s in map(frozenset, sets)}
    which = lambda at: F.element_at(
        F.create_map(*(F.lit(x) for i, s in ids.items() for x in (i, names.get(s, (total, total))[at]))), F.col("_id").cast("int")
    )
    return grouped.select(which(0).alias("hierarchy"), which(1).alias("level"), *columns, *measures)
