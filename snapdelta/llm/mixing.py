"""Operator 8, mixing sources to target weights: Sainte-Lague apportionment of equal-token blocks, then seeded selection.

Sources are cut into shards of bounded size. Every (source, shard) cell asks for its share of its source's target, and the
blocks of the whole mix go to the cells by the highest quotients share / (2 k + 1). Inside a cell documents stand in a
seeded order on a line of tokens, cut into blocks; the cell's quota of blocks is spread evenly over that line, from a
seeded start, after as many whole passes as the quota holds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapdelta.llm.common import kept, word_count

WEIGHTS, SHARE, MOST_PASSES = (3, 1, 2), 1.5, 2
#: Words of a block; words and rows of a shard. A shard is ordered in one task.
BLOCK, SHARD_WORDS, SHARD_ROWS, SEED = 16, 1 << 20, 20_000, 17
#: Candidates that one pass over a table tries.
GRID = 64


def _ranked(sources: DataFrame, source: str) -> DataFrame:
    """Adds ``rank`` by code point, null last: ranges are numbered apart and shifted by the sizes of those before."""
    order = (F.col(source).isNull(), F.col(source))
    ranges = kept(sources.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "mix-ranges")
    sizes = ranges.groupBy("_part").agg(F.count("*").alias("n"))
    # One row per range, so as many as there are shuffle partitions.
    shifts = sizes.select("_part", (F.sum("n").over(Window.orderBy("_part")) - F.col("n")).alias("_shift"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return ranges.withColumn("_at", inside).join(shifts, "_part").withColumn("rank", F.col("_shift") + F.col("_at") - 1).drop("_part", "_at", "_shift")


def source_targets(sized: DataFrame, source: str = "source", weights=WEIGHTS, share: float = SHARE, most: int = MOST_PASSES) -> DataFrame:
    """``source, source_size, rows, rank, target`` of every source. Kept as a table.

    The level of words per weight rises until no source is above ``most`` times its size: each pass is one aggregate, and
    at least one more source is settled by it.
    """
    sums = sized.groupBy(source).agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = kept(_ranked(sums, source).withColumn("weight", weight), "mix-sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, settled = 0.0, -1
    while True:
        full = F.col("weight") * F.lit(level) > most * F.col("source_size")
        taken, weight_left, n = sources.agg(
            F.sum(F.when(full, most * F.col("source_size")).otherwise(0)), F.sum(F.when(full, 0).otherwise(F.col("weight"))), F.sum(full.cast("int"))
        ).first()
        if not weight_left or n == settled:
            break
        settled, level = n, (share * total - taken) / weight_left
    target = F.least(F.col("weight") * F.lit(level), most * F.col("source_size")).cast("double")
    return kept(sources.withColumn("target", target), "mix-targets")


def _narrow(low, high, grid_of: Callable, counts: Callable[[list], list[int]], wanted: int) -> tuple:
    """The ends around the place where a falling count goes below ``wanted``; a grid of candidates is counted per pass."""
    while grid := grid_of(low, high):
        for x, n in zip(grid, counts(grid)):
            if n >= wanted:
                low = x
            else:
                high = x
                break
    return low, high


def _doubles(low: float, high: float) -> list[float]:
    step = (high - low) / (GRID + 1)
    return [x for x in dict.fromkeys(low + step * (i + 1) for i in range(GRID)) if low < x < high]


def _longs(low: int, high: int) -> list[int]:
    step = max(1, (high - low) // (GRID + 1))
    return list(range(low + step, high, step))[:GRID]


def _sums(table: DataFrame, columns: list[Column]) -> list[int]:
    return [n or 0 for n in table.agg(*(F.sum(c).alias(f"n{i}") for i, c in enumerate(columns))).first()]


def apportion(cells: DataFrame, votes: str, seats: int, tie: Column) -> DataFrame:
    """Adds ``seats``: each cell's share of ``seats`` by the highest quotients votes / (2 k + 1) (Sainte-Lague).

    The divisor that gives out all seats is searched with one aggregate per pass, so cells need not be gathered or sorted.
    Equal last quotients are served by the smaller ``tie``.
    """
    cells = kept(cells.withColumn("_tie", tie), "mix-cells")
    given = lambda d: F.floor(F.col(votes) / F.lit(float(d)) + 0.5)
    most = cells.agg(F.max(votes)).first()[0]
    if not seats or not most:
        return cells.withColumn("seats", F.lit(0).cast("long")).drop("_tie")
    # At the lower divisor at least the wanted seats are given, at the upper one fewer; at last no double lies between.
    low, high = _narrow(most / (2.0 * seats + 2), 2.0 * most + 1, _doubles, lambda grid: _sums(cells, [given(d) for d in grid]), seats)
    at_low, at_high = given(low), given(high)
    tied = cells.where(at_low > at_high)
    n_low, n_high = _sums(cells, [at_low, at_high])
    if n_low == seats:
        return cells.withColumn("seats", at_low.cast("long")).drop("_tie")
    # The cells whose tie value is at least ``cut`` go without another seat.
    from_tie = lambda grid: _sums(tied, [F.when(F.col("_tie") >= F.lit(x), 1).otherwise(0) for x in grid])
    _, cut = _narrow(-(2**63), 2**63 - 1, _longs, from_tie, n_low - seats + 1)
    return cells.withColumn("seats", F.when(F.col("_tie") < F.lit(cut), at_low).otherwise(at_high).cast("long")).drop("_tie")


def _whole(a: Column, b: Column) -> Column:
    """a // b for natural numbers."""
    return ((a - a % b) / b).cast("long")


def _picked_before(x: Column, block: int) -> Column:
    """Words of the quota's blocks among the first x of a cell's line: block j is picked if (j * rest + start) // blocks grows."""
    r, n, u = F.col("_rest"), F.col("_blocks"), F.col("_start")
    j = _whole(x, F.lit(block))
    before = _whole(j * r + u, n)
    return before * block + (_whole((j + 1) * r + u, n) - before) * (x - j * block)


def mix_sources(
    docs: DataFrame, text: str = "text", source: str = "source", weights=WEIGHTS, share: float = SHARE, most: int = MOST_PASSES,
    block: int = BLOCK, shard_words: int = SHARD_WORDS, shard_rows: int = SHARD_ROWS, seed: int = SEED,
    keep_text: bool = False,
) -> DataFrame:
    """All columns of ``docs`` but the text (``keep_text``: and the text), with ``size``, ``source_size``, ``target`` and ``taken`` words.

    Null and empty texts have size 0 and nothing is taken of them; a null source is a source of its own, ranked last.
    Repeated rows are documents like others. An empty table stays empty. Runs agree, however rows are spread: the order
    and the shards come from hashes of a row's ids, source and size. Columns with the names of the results are replaced.
    """
    names = ("size", "source_size", "target", "taken")
    ids = [c for c in docs.columns if c not in (text, *names) and not c.startswith("_")]
    keys = [F.col(c) for c in ids if c.endswith("_id")]
    told = [text] if keep_text else []
    sized = docs.select(*ids, *told, word_count(F.col(text)).alias("size"))
    sized = kept(sized.withColumn("_h", F.xxhash64(F.lit(seed), *keys, F.col(source), F.col("size"))), "mix-sizes")
    targets = source_targets(sized, source, weights, share, most)
    shards = F.greatest(F.ceil(F.col("source_size") / shard_words), F.ceil(F.col("rows") / shard_rows), F.lit(1)).cast("long")
    plan = targets.select(F.col(source).alias("_source"), "source_size", "target", shards.alias("_shards"))
    placed = sized.join(plan, F.col(source).eqNullSafe(F.col("_source")), "left").withColumn("_shard", F.pmod(F.xxhash64("_h"), F.col("_shards")))
    placed = placed.drop("_source", "_shards")
    cells = placed.groupBy(source, "_shard").agg(F.sum("size").alias("_words"), F.first("source_size").alias("_of"), F.first("target").alias("_target"))
    asked = F.when(F.col("_of") > 0, F.col("_target") * F.col("_words") / F.col("_of")).otherwise(0.0)
    wanted = targets.agg(F.sum("target")).first()[0] or 0.0
    seats = apportion(cells.withColumn("_asked", asked), "_asked", round(wanted / block), F.xxhash64(F.lit(seed), source, "_shard"))
    n = F.greatest(F.ceil(F.col("_words") / block), F.lit(1)).cast("long")
    quota = F.least(F.col("seats"), most * n)
    quotas = kept(
        seats.select(
            F.col(source).alias("_source"), F.col("_shard").alias("_of_shard"), n.alias("_blocks"),
            _whole(quota, n).alias("_passes"), (quota % n).alias("_rest"),
            F.pmod(F.xxhash64(F.lit(seed + 1), source, "_shard"), n).alias("_start"),
        ),
        "mix-quotas",
    )
    # A shard holds at most about shard_words words or shard_rows rows, or one text that is longer.
    line = Window.partitionBy(source, "_shard").orderBy("_h", *keys, "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lined = placed.withColumn("_end", F.sum("size").over(line))
    same = F.col(source).eqNullSafe(F.col("_source")) & (F.col("_shard") == F.col("_of_shard"))
    joined = lined.join(quotas, same)
    taken = F.col("_passes") * F.col("size") + _picked_before(F.col("_end"), block) - _picked_before(F.col("_end") - F.col("size"), block)
    return joined.select(*ids, *told, "size", "source_size", "target", taken.cast("long").alias("taken"))
