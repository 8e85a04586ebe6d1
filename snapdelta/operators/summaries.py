"""Counter increases from mergeable summaries of stretches of time.

A summary row holds what an entity's rows of one period (a day, by default) add to any longer window: per counter the first
and the last value and the changes in between, with the times of the first and the last row. Summaries of neighbouring
periods put together are the summary of both, so that days are made once, while rows land, and a report over months reads
one row per entity and day in place of every snapshot. What happens between two periods is seen from the last value of one
and the first of the next; a null there means, as between rows, that the interval adds nothing.

The values of the first and of the last row are taken as one struct each. Spark aggregates structs in the order that the windows
before have sorted the rows in, a group at a time; single values it would gather in two hash tables of about a kilobyte a group
each, which is a row where an entity has one snapshot a period.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapdelta.functions.scalars import epoch_seconds
from snapdelta.operators.delta import NULL_KEY_SPREAD, RESET_POLICIES, any_null, counter_increase, one_row_per_snapshot
from snapdelta.schema import TIME

PERIOD, FIRST, LAST, LIFE = "period", "first_time", "last_time", "life"
#: Fields of a counter's summary: its value in the first and in the last row, the sum of all changes, the sum of those that were
#: falls, and the sum of the values after a fall. The reset policies are sums of the last three.
FIELDS = ("first", "last", "change", "fallen", "restarted")

_ENTITY, _SPREAD, _BEGAN = "_entity", "_spread", "_began"


def _placed(df: DataFrame, keys: Sequence[str], time: str, *by: str) -> DataFrame:
    """Rows dealt out by entity (and ``by``), once for all that follows; rows with a null key are spread, as no row is before them.

    The exchange is by a hash column of its own: a key that is the same in all rows would be folded away in the hash, and what
    follows would then move the rows again.
    """
    spread = F.when(any_null(keys), F.pmod(F.xxhash64(time, *keys), F.lit(NULL_KEY_SPREAD)))
    marked = df.withColumn(_SPREAD, spread)
    marked = marked.withColumn(_ENTITY, F.xxhash64(*keys, _SPREAD, *by))
    return marked.repartition(_ENTITY)


def _sum(column: Column, kind: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0)).cast(kind)


def period_summaries(
    df: DataFrame,
    counters: Sequence[str],
    keys: Sequence[str],
    *,
    time: str = TIME,
    period: str = "day",
    duplicates: str | None = None,
    sums: Mapping[str, Column] | None = None,
    lives: Sequence[str] = (),
) -> DataFrame:
    """One row per entity and period: ``period``, ``first_time``, ``last_time``, ``snapshots`` and a struct per counter (``FIELDS``).

    ``period`` is a unit of ``date_trunc``. ``duplicates`` folds the rows an entity has in one snapshot. ``sums`` are further
    additive aggregates, by name; with ``duplicates`` they may use the counters only. Rows with a null key add nothing and may
    have several summaries per period. Rows move once; an empty frame has no summaries.

    ``lives`` names columns that are constant while an entity lives (see ``lifetimes``): what lies between two lives is no
    change, and under ``restart`` a life adds the value it begins with. The summary keeps the marks of its first and last row
    as ``life``, so that lives are told apart across periods, too.
    """
    lives = [c for c in lives if c not in keys]
    counters, sums = list(dict.fromkeys(counters)), dict(sums or {})
    kinds = dict(df.select(*counters).dtypes)
    dated = df.withColumn(PERIOD, F.date_trunc(period, F.col(time).cast("timestamp")))
    placed = _placed(dated, keys, time, PERIOD)
    groups = [_ENTITY, *keys, _SPREAD, PERIOD]
    if duplicates:
        placed = one_row_per_snapshot(placed, counters, [*groups, *lives], duplicates, time)
    by = ", ".join(f"`{g}`" for g in groups)
    before = f"(partition by {by} order by `{time}`)"
    began = " or ".join(f"not (lag(`{c}`) over {before} <=> `{c}`)" for c in lives)
    began = f"{_SPREAD} is null and lag(true) over {before} and ({began})" if lives else "false"
    rows = placed.withColumn(_BEGAN, F.coalesce(F.expr(began), F.lit(False)))
    changes = [F.expr(f"case when {_SPREAD} is null and not {_BEGAN} then `{c}` - lag(`{c}`) over {before} end").alias(f"_d_{c}") for c in counters]
    rows = rows.select("*", *changes)

    held = F.struct(*counters)

    def summary(c: str) -> Column:
        change, fell = F.col(f"_d_{c}"), F.col(f"_d_{c}") < 0
        values = (
            F.min_by(held, time).getField(c), F.max_by(held, time).getField(c), _sum(change, kinds[c]),
            _sum(F.when(fell, change), kinds[c]), _sum(F.when(fell | F.col(_BEGAN), F.col(c)), kinds[c]),
        )
        return F.struct(*[v.alias(name) for v, name in zip(values, FIELDS)]).alias(c)

    marks = F.struct(*lives)
    life = [F.struct(F.min_by(marks, time).alias("first"), F.max_by(marks, time).alias("last")).alias(LIFE)] if lives else []
    grouped = rows.groupBy(*groups).agg(
        F.min(time).alias(FIRST), F.max(time).alias(LAST), F.count(F.lit(1)).alias("snapshots"),
        *life, *[summary(c) for c in counters], *[column.alias(name) for name, column in sums.items()],
    )
    return grouped.select(*keys, PERIOD, FIRST, LAST, "snapshots", *([LIFE] if lives else []), *counters, *sums)


def merge_summaries(
    summaries: DataFrame, counters: Sequence[str], keys: Sequence[str], *, period: str | None = None, sums: Sequence[str] = ()
) -> DataFrame:
    """Summaries of longer periods from those of shorter ones; of all there is, one row per entity, without a ``period``.

    It does not matter in how many steps summaries are put together. Those of one entity must not overlap in time.
    """
    counters = list(dict.fromkeys(counters))
    kinds = {c: summaries.schema[c].dataType["change"].dataType.simpleString() for c in counters}
    life = [LIFE] if LIFE in summaries.columns and LIFE not in keys else []
    rows = summaries.select(*keys, *([PERIOD] if period else []), FIRST, LAST, "snapshots", *life, *counters, *sums)
    if period:
        rows = rows.withColumn(PERIOD, F.date_trunc(period, PERIOD))
    over = [PERIOD] if period else []
    placed = _placed(rows, keys, FIRST, *over)
    groups = [_ENTITY, *keys, _SPREAD, *over]
    before = f"(partition by {', '.join(f'`{g}`' for g in groups)} order by `{FIRST}`)"
    began = f"{_SPREAD} is null and lag(true) over {before} and not (lag(`{LIFE}`.`last`) over {before} <=> `{LIFE}`.`first`)" if life else "false"
    rows = placed.withColumn(_BEGAN, F.coalesce(F.expr(began), F.lit(False)))
    seams = [
        F.expr(f"case when {_SPREAD} is null and not {_BEGAN} then `{c}`.`first` - lag(`{c}`.`last`) over {before} end").alias(f"_d_{c}") for c in counters
    ]
    rows = rows.select("*", *seams)

    firsts, lasts = (F.struct(*[F.col(c).getField(end).alias(c) for c in counters]) for end in ("first", "last"))

    def merged(c: str) -> Column:
        seam, fell = F.col(f"_d_{c}"), F.col(f"_d_{c}") < 0
        part = lambda name: F.col(c).getField(name)
        plus = lambda name, more: (_sum(part(name), kinds[c]) + _sum(more, kinds[c])).cast(kinds[c])
        values = (
            F.min_by(firsts, FIRST).getField(c), F.max_by(lasts, LAST).getField(c), plus("change", seam),
            plus("fallen", F.when(fell, seam)), plus("restarted", F.when(fell | F.col(_BEGAN), part("first"))),
        )
        return F.struct(*[v.alias(name) for v, name in zip(values, FIELDS)]).alias(c)

    ends = (F.min_by(f"{LIFE}.first", FIRST).alias("first"), F.max_by(f"{LIFE}.last", LAST).alias("last"))
    lives = [F.struct(*ends).alias(LIFE)] if life else []
    grouped = rows.groupBy(*groups).agg(
        F.min(FIRST).alias(FIRST), F.max(LAST).alias(LAST), F.sum("snapshots").alias("snapshots"), *lives,
        *[merged(c) for c in counters], *[F.sum(s).alias(s) for s in sums],
    )
    return grouped.select(*keys, *over, FIRST, LAST, "snapshots", *life, *counters, *sums)


def increase_from_summaries(
    summaries: DataFrame, counters: Sequence[str], keys: Sequence[str], *, on_reset: str = "raw", sums: Sequence[str] = ()
) -> DataFrame:
    """One row per entity with ``increase_<counter>``, ``elapsed_seconds`` and the additive ``sums``: what ``counter_increase`` gives
    over the rows that the summaries were made of, under any reset policy and with nulls anywhere."""
    if on_reset not in RESET_POLICIES:
        raise ValueError(f"unknown reset policy {on_reset!r}")
    counters = list(dict.fromkeys(counters))
    whole = merge_summaries(summaries, counters, keys, sums=sums)
    kinds = {c: summaries.schema[c].dataType["change"].dataType.simpleString() for c in counters}
    part = lambda c, name: f"`{c}`.`{name}`"
    terms = {"raw": ["change"], "zero": ["change", "fallen"], "restart": ["change", "fallen", "restarted"]}[on_reset]

    def increase(c: str) -> Column:
        value = part(c, "change") + "".join(f" {'-' if t == 'fallen' else '+'} {part(c, t)}" for t in terms[1:])
        return F.sum(F.expr(value)).cast(kinds[c]).alias(f"increase_{c}")

    span = epoch_seconds(F.max(LAST)) - epoch_seconds(F.min(FIRST))
    # One row per entity as it is, but for null keys, whose spread rows come together here.
    return whole.groupBy(*keys).agg(
        *[increase(c) for c in counters],
        F.when(any_null(keys), F.lit(0.0)).otherwise(span).alias("elapsed_seconds"),
        *[F.sum(s).alias(s) for s in sums],
    )


def is_summarised(df: DataFrame) -> bool:
    """Whether a frame holds summaries in place of snapshots."""
    return {PERIOD, FIRST, LAST} <= set(df.columns)


def increase(df: DataFrame, counters: Sequence[str], keys: Sequence[str], *, aggregates: Mapping[str, Column] | None = None, **options) -> DataFrame:
    """``counter_increase`` of snapshots, or the same from their summaries, whichever ``df`` holds.

    Summaries hold the ``aggregates`` under their names as sums; a counter that they lack did not move. Of the options only
    ``on_reset`` bears on them: duplicates were folded and gaps settled when they were made.
    """
    aggregates = dict(aggregates or {})
    if not is_summarised(df):
        return counter_increase(df, counters, keys, aggregates=[column.alias(name) for name, column in aggregates.items()], **options)
    held = [c for c in dict.fromkeys(counters) if c in df.columns]
    grown = increase_from_summaries(df, held, keys, on_reset=options.get("on_reset", "raw"), sums=list(aggregates))
    return grown.select("*", *[F.lit(0).cast("bigint").alias(f"increase_{c}") for c in dict.fromkeys(counters) if c not in held])
