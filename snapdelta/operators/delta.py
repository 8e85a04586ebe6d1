"""Changes of cumulative counters between consecutive snapshots of an entity.

Two forms. ``counter_delta`` keeps one row per snapshot and looks at the row before it. ``counter_increase`` gives
one row per entity: under the ``raw`` reset policy the deltas of an entity sum to *last minus first*, so an
aggregate that combines on the map side replaces shuffling and sorting every row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapdelta.functions.scalars import epoch_seconds
from snapdelta.schema import TIME

WEEK = 7 * 86_400
NULL_KEY_SPREAD = 1_024
RESET_POLICIES = ("raw", "zero", "restart")

_SLICE, _SPREAD, _CARRIED, _ENTITY = "_slice", "_spread", "_carried", "_entity"


def any_null(columns: Sequence[str]) -> Column:
    return F.expr(" or ".join(f"`{c}` is null" for c in columns) or "false")


def one_row_per_snapshot(
    df: DataFrame, values: Sequence[str], keys: Sequence[str], rule: str, time: str = TIME
) -> DataFrame:
    """Fold the rows an entity has in one snapshot into one, by ``sum`` or ``max`` of every value."""
    if rule not in ("sum", "max"):
        raise ValueError(f"unknown duplicate rule {rule!r}")
    fold = F.sum if rule == "sum" else F.max
    types = dict(df.select(*values).dtypes)
    return df.groupBy(*keys, time).agg(*[fold(v).cast(types[v]).alias(v) for v in values])


def _window(groups: Sequence[str], order: str) -> str:
    by = "partition by " + ", ".join(f"`{g}`" for g in groups) if groups else ""
    return f"({by} order by `{order}`)"


def previous_row(
    df: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str],
    time: str = TIME,
    slice_seconds: int | None = None,
) -> DataFrame:
    """Add ``prev_<column>`` and ``has_prev`` from the entity's row before this one.

    An entity has one row per snapshot, so by default its timeline is one window: one scan, one shuffle. Where single
    entities have far more rows, ``slice_seconds`` cuts timelines into slices, each of which receives the last row of
    the slice before it; that reads the source twice. Rows with a null key have no row before them; they are spread
    over tasks because they would otherwise form one group.
    """
    columns = list(dict.fromkeys(columns))
    no_entity = any_null(keys)
    marked = df.withColumn(
        _SPREAD,
        F.when(no_entity, F.pmod(F.xxhash64(time, *keys, *columns), F.lit(NULL_KEY_SPREAD))),
    ).withColumn(_CARRIED, F.lit(False))
    groups = [*keys, _SPREAD]
    if slice_seconds:
        seconds = F.unix_seconds(F.col(time).cast("timestamp"))
        marked = marked.withColumn(_SLICE, F.floor(seconds / F.lit(slice_seconds)))
        groups.append(_SLICE)
        handed_on = (
            marked.where(~no_entity)
            .groupBy(*keys, _SLICE)
            .agg(*[F.max_by(c, time).alias(c) for c in columns if c != time], F.max(time).alias(time))
            .withColumn(_SLICE, F.expr(f"lead({_SLICE}) over {_window(keys, _SLICE)}"))
            .where(F.col(_SLICE).isNotNull())
            .withColumn(_CARRIED, F.lit(True))
        )
        marked = marked.unionByName(handed_on, allowMissingColumns=True)
    before = _window(groups, time)
    looked_back = marked.select(
        "*",
        F.expr(f"lag(true, 1, false) over {before} and {_SPREAD} is null as has_prev"),
        *[F.expr(f"case when {_SPREAD} is null then lag(`{c}`) over {before} end as `prev_{c}`") for c in columns],
    )
    return looked_back.where(~F.col(_CARRIED)).drop(_SPREAD, _CARRIED, _SLICE)


def _change(value: str, previous: str, on_reset: str = "raw", same_life: str | None = None) -> str:
    """Change from one value to the next as SQL; 0 where either is null. Where ``same_life`` is false the counter began anew:
    that adds its value under ``restart``, else nothing."""
    change = f"{value} - {previous}"
    after_reset = value if on_reset == "restart" else "0"
    if on_reset != "raw":
        change = f"case when {value} < {previous} then {after_reset} else {change} end"
    if same_life is not None:
        change = f"case when {same_life} then {change} else {after_reset} end"
    return f"coalesce({change}, 0)"


def counter_delta(
    df: DataFrame,
    counters: Sequence[str],
    keys: Sequence[str],
    *,
    time: str = TIME,
    on_reset: str = "raw",
    duplicates: str | None = None,
    slice_seconds: int | None = None,
    keep_previous: bool = False,
    lives: Sequence[str] = (),
) -> DataFrame:
    """Add ``delta_<counter>``: the value minus the value in the entity's previous snapshot.

    The first row of an entity, an interval that touches a null, and a row whose key holds a null get 0. A falling
    counter gives a negative delta under ``raw``, 0 under ``zero`` and its new value under ``restart``. With
    ``duplicates`` unset, (key, time) must be unique.

    ``lives`` names columns that are constant while an entity lives (see ``lifetimes``). Where one changes, the counter began
    anew: the delta is the value under ``restart``, else 0. With ``duplicates`` all rows of a snapshot must agree on them.
    """
    if on_reset not in RESET_POLICIES:
        raise ValueError(f"unknown reset policy {on_reset!r}")
    lives = [c for c in lives if c not in keys]
    if duplicates:
        df = one_row_per_snapshot(df, counters, [*keys, *lives], duplicates, time)
    types = dict(df.select(*counters).dtypes)
    looked_back = previous_row(df, [*counters, *lives], keys, time, slice_seconds)
    same = " and ".join(f"`{c}` <=> `prev_{c}`" for c in lives) or None
    deltas = [
        F.expr(f"cast(case when has_prev then {_change(f'`{c}`', f'`prev_{c}`', on_reset, same)} else 0 end as {types[c]}) as `delta_{c}`")
        for c in counters
    ]
    result = looked_back.select("*", *deltas).drop("has_prev")
    return result if keep_previous else result.drop(*[f"prev_{c}" for c in [*counters, *lives]])


def elapsed_delta(
    df: DataFrame, keys: Sequence[str], *, time: str = TIME, slice_seconds: int | None = None
) -> DataFrame:
    """Add ``delta_seconds``: seconds since the entity's previous snapshot."""
    looked_back = previous_row(df, [time], keys, time, slice_seconds)
    seconds = F.coalesce(epoch_seconds(time) - epoch_seconds(f"prev_{time}"), F.lit(0.0))
    return looked_back.withColumn("delta_seconds", seconds).drop("has_prev", f"prev_{time}")


def _elapsed(keys: Sequence[str], time: str) -> Column:
    span = epoch_seconds(F.max(time)) - epoch_seconds(F.min(time))
    return F.when(any_null(keys), F.lit(0.0)).otherwise(span).alias("elapsed_seconds")


def _last_minus_first(counter: str, kind: str, no_entity: str, time: str, may_be_null: bool, gaps: str) -> Column:
    """Increase of one counter as an aggregate, null where the nulls between its values need a closer look."""
    x, t = f"`{counter}`", f"`{time}`"
    problem = f"raise_error('counter {counter} is null between its values: list it as nullable and resolve the gaps')"
    if not may_be_null:
        nothing, change = no_entity, f"max_by({x}, {t}) - min_by({x}, {t})"
        complete = f"count({x}) = count(1)"
    else:
        here, absent = f"case when {x} is not null then {t} end", f"case when {x} is null then {t} end"
        nothing, change = f"{no_entity} or max({here}) is null", f"max_by({x}, {here}) - min_by({x}, {here})"
        complete = f"max({absent}) is null or max({absent}) < min({here}) or min({absent}) > max({here})"
    otherwise = problem if not may_be_null or gaps == "fail" else "null"
    chosen = f"case when {nothing} then 0 when {complete} then {change} else {otherwise} end"
    return F.expr(f"cast({chosen} as {kind}) as `increase_{counter}`")


def _increase_by_slices(
    rows: DataFrame,
    counters: Sequence[str],
    keys: Sequence[str],
    time: str,
    slice_seconds: int,
    on_reset: str = "raw",
    carried: Sequence[str] = (),
    duplicates: str | None = None,
) -> DataFrame:
    """Sum of deltas per entity: within each time slice, then over the seams between an entity's slices.

    Rows move once, by entity and slice; duplicates are folded, differences taken and slices summed up where they then
    lie, and only those summaries move again. Rows with a null key are spread and add nothing; ``carried`` columns are
    constant per entity.
    """
    slices = F.floor(F.unix_seconds(F.col(time).cast("timestamp")) / F.lit(slice_seconds))
    spread = F.when(any_null(keys), F.pmod(F.xxhash64(time, *keys), F.lit(NULL_KEY_SPREAD)))
    groups = [*keys, _SLICE, _SPREAD]
    sliced = rows.withColumn(_SLICE, slices).withColumn(_SPREAD, spread)
    if duplicates:
        # The exchange is by entity and slice; it also serves the fold per snapshot, which cannot combine much before it. It is by
        # a hash column of its own: a key that is the same in all rows would be folded away, and rows would move once more.
        sliced = sliced.withColumn(_ENTITY, F.xxhash64(*groups))
        groups = [_ENTITY, *groups]
        sliced = one_row_per_snapshot(sliced.repartition(_ENTITY), counters, groups, duplicates, time)
    before, seam = _window(groups, time), _window(keys, _SLICE)

    def change(value: str, previous: str) -> str:
        return f"case when {_SPREAD} is null then {_change(value, previous, on_reset)} else 0 end"

    inside = sliced.select(
        "*", *[F.expr(change(f"`{c}`", f"lag(`{c}`) over {before}")).alias(f"_in_{c}") for c in counters]
    )
    summaries = inside.groupBy(*groups).agg(
        F.min(time).alias("_start"),
        F.max(time).alias("_stop"),
        *[F.sum(f"_in_{c}").alias(f"_in_{c}") for c in counters],
        *[F.min_by(c, time).alias(f"_first_{c}") for c in counters],
        *[F.max_by(c, time).alias(f"_last_{c}") for c in counters],
        *[F.any_value(c).alias(c) for c in carried],
    )
    over_seam = {c: change(f"`_first_{c}`", f"lag(`_last_{c}`) over {seam}") for c in counters}
    joined = summaries.select(
        *keys,
        *carried,
        "_start",
        "_stop",
        *[F.expr(f"`_in_{c}` + {over_seam[c]}").alias(f"_sum_{c}") for c in counters],
    )
    span = epoch_seconds(F.max("_stop")) - epoch_seconds(F.min("_start"))
    span = F.when(any_null(keys), F.lit(0.0)).otherwise(span)
    return joined.groupBy(*keys).agg(
        *[F.sum(f"_sum_{c}").alias(f"increase_{c}") for c in counters],
        *([] if "elapsed_seconds" in carried else [span.alias("elapsed_seconds")]),
        *[F.any_value(c).alias(c) for c in carried],
    )


def counter_increase(
    df: DataFrame,
    counters: Sequence[str],
    keys: Sequence[str],
    *,
    time: str = TIME,
    on_reset: str = "raw",
    duplicates: str | None = None,
    nullable: Sequence[str] | None = None,
    gaps: str = "resolve",
    aggregates: Sequence[Column] = (),
    slice_seconds: int = WEEK,
    settle: Callable[[DataFrame], DataFrame] | None = None,
    lives: Sequence[str] = (),
) -> DataFrame:
    """One row per entity with ``increase_<counter>`` (the sum of its deltas) and ``elapsed_seconds``.

    ``aggregates`` are further aggregate columns computed in the same pass; with ``duplicates`` set they may use the
    counters and the key only. ``nullable`` names the counters that may hold nulls (all when unset); a null in any
    other fails the job rather than giving a wrong number.

    Nulls before the first or after the last value of an entity are settled in the same pass. An entity whose nulls
    lie between its values is summed from its deltas in a second pass over those entities (``gaps='resolve'``), or
    fails the job (``gaps='fail'``, for sources that cannot have them). ``settle`` writes the aggregate out and
    returns it read back; the second pass is then left out at run time when no entity needs it. ``gaps='lag'`` takes
    every difference in the first place: rows move once whether there are gaps or not, which is the better way where
    duplicates have to be folded by snapshot anyway, and the only one under other reset policies.

    ``lives`` names columns that are constant while an entity lives; no delta crosses from one life to the next (as in
    ``counter_delta``). Such increases go by period summaries: rows move once, then one row per entity and week.
    """
    if gaps not in ("resolve", "fail", "lag"):
        raise ValueError(f"unknown gap rule {gaps!r}")
    counters, extra = list(dict.fromkeys(counters)), list(aggregates)
    if lives:
        if extra:
            raise ValueError("give further aggregates of lives to period_summaries, as sums")
        from snapdelta.operators.summaries import increase_from_summaries, period_summaries

        weeks = period_summaries(df, counters, keys, time=time, period="week", duplicates=duplicates, lives=lives)
        return increase_from_summaries(weeks, counters, keys, on_reset=on_reset)
    types = dict(df.select(*counters).dtypes)
    if not extra and (on_reset != "raw" or gaps == "lag"):
        rows = df.select(*keys, time, *counters)
        grown = _increase_by_slices(rows, counters, keys, time, slice_seconds, on_reset, duplicates=duplicates)
        increases = [F.col(f"increase_{c}").cast(types[c]).alias(f"increase_{c}") for c in counters]
        return grown.select(*keys, *increases, "elapsed_seconds")
    if duplicates:
        df = one_row_per_snapshot(df, counters, keys, duplicates, time)
    if on_reset != "raw":
        deltas = counter_delta(df, counters, keys, time=time, on_reset=on_reset, slice_seconds=slice_seconds)
        return deltas.groupBy(*keys).agg(
            *[F.sum(f"delta_{c}").cast(types[c]).alias(f"increase_{c}") for c in counters], _elapsed(keys, time), *extra
        )

    nullable = counters if nullable is None else [c for c in nullable if c in counters]
    no_entity = "(" + " or ".join(f"`{k}` is null" for k in keys) + ")"
    increases = [_last_minus_first(c, types[c], no_entity, time, c in nullable, gaps) for c in counters]
    ends = df.groupBy(*keys).agg(*increases, _elapsed(keys, time), *extra)
    if settle is not None:
        ends = settle(ends)
    if not nullable or gaps == "fail":
        return ends
    gappy = any_null([f"increase_{c}" for c in nullable])
    if settle is not None and ends.where(gappy).isEmpty():
        return ends

    # The columns of the aggregate ride along with the rows, and the join is null-safe so that no filter is pushed
    # into it: both branches then share one computation of the aggregate.
    corrected_names = [f"increase_{c}" for c in nullable]
    carried = [c for c in ends.columns if c not in keys and c not in corrected_names]
    open_entities = ends.where(gappy).drop(*corrected_names).withColumnsRenamed({k: f"_key_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])
    rows_again = df.select(*keys, time, *nullable).join(open_entities, same, "inner")
    corrected = _increase_by_slices(rows_again, nullable, keys, time, slice_seconds, carried=carried)
    kinds = dict(ends.dtypes)
    return ends.where(~gappy).unionByName(corrected.select(*[F.col(c).cast(kinds[c]).alias(c) for c in ends.columns]))
