"""Operator 11, embedding near-dedup: lattice hashing, then exact cosines of what meets in a cell.

A table projects unit vectors at random onto ``blocks`` times eight axes and decodes each eight to the nearest point of the
E8 lattice; the points name the cell. A vector lies in one cell of each table and probes the cells around it that its
projection is nearest to. What meets in a cell is a candidate and is verified by its cosine in double precision.

Groups of copies are never expanded. Equal vectors are one class. Classes that lie within half the linking angle of a
common centre are linked pairwise for certain (angles obey the triangle inequality) and become one unit: the centre is the
mean of some vectors whose fullest cell is the same, the links inside are counted, not listed. Candidates are pairs of
units. The angle of their centres says whether all or none of their members link; for the rest blocks of members are
compared, and only counts leave a task.
"""

from __future__ import annotations

import itertools
import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapdelta.llm.common import if_small, kept
from snapdelta.llm.graph import components

cloudpickle.register_pickle_by_value(sys.modules[__name__])

COSINE = 0.95
#: Two blocks of this width meet by chance once in a million pairs a cell; pairs at 0.95 are found with a chance of 0.95, at 0.97
#: of 0.99 (simulated). A larger corpus takes more: 3 blocks, width 2.0, 6 tables, 16 probes find as much and meet a sixth as often.
#: For another threshold the width grows with the distance of two unit vectors that just reach it.
BLOCKS, WIDTH, TABLES, PROBES, SEED = 2, 1.6, 4, 12, 11
#: Members that vote for the centre of a unit, and members of a block that is compared at once.
VOTES, SIDE = 32, 256
#: Angles within this of a bound are compared member by member.
SLACK = 1e-6
#: Columns of the result; a column of the input with such a name is replaced.
RESULTS = ("n_links", "component_id", "kept")


def _even(x: np.ndarray) -> np.ndarray:
    """Nearest points with integer coordinates of even sum."""
    near = np.rint(x)
    odd = np.flatnonzero(near.sum(1).astype(np.int64) & 1)
    rest = x[odd] - near[odd]
    worst = np.abs(rest).argmax(1)
    near[odd, worst] += np.where(rest[np.arange(len(odd)), worst] >= 0, 1.0, -1.0)
    return near


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """The nearest point of E8 to each row of eight: of the even integer points, or of those moved by a half each."""
    whole, half = _even(x), _even(x - 0.5) + 0.5
    nearer = ((x - whole) ** 2).sum(1) <= ((x - half) ** 2).sum(1)
    return np.where(nearer[:, None], whole, half)


def e8_neighbours() -> np.ndarray:
    """The 240 shortest vectors of E8, that is the steps from a cell to those around it."""
    pairs = [[s * (k == i) + t * (k == j) for k in range(8)] for i, j in itertools.combinations(range(8), 2) for s in (1, -1) for t in (1, -1)]
    halves = [s for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(pairs + [list(s) for s in halves])


def unit_vectors(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def cells(units: np.ndarray, table: int, blocks: int, width: float, probes: int) -> np.ndarray:
    """Numbers of the cells (rows, 1 + probes): each vector's own one first, then the nearest around it, one block's step away."""
    dim = units.shape[1]
    rng = np.random.default_rng([SEED, table, dim])
    axes, shift = rng.normal(size=(dim, 8 * blocks)), rng.uniform(0, 2, 8 * blocks)
    names = rng.integers(-(2**62), 2**62, 8 * blocks) | 1
    spot = (units @ axes / width + shift).reshape(-1, 8)
    point = nearest_e8(spot)
    steps = e8_neighbours()
    # Twice a coordinate is an integer; a cell's number is linear in them, so that a step adds to it.
    home = ((2 * point).astype(np.int64).reshape(-1, 8 * blocks) * names).sum(1)
    moves = np.concatenate([(2 * steps).astype(np.int64) @ names[8 * b : 8 * b + 8] for b in range(blocks)])
    away = (-2 * ((spot - point) @ steps.T)).reshape(-1, blocks * len(steps))
    probes = min(probes, away.shape[1])
    nearest = np.argpartition(away, probes - 1, axis=1)[:, :probes] if probes else np.zeros((len(units), 0), np.int64)
    salt = np.int64(rng.integers(-(2**62), 2**62))
    return np.concatenate([home[:, None], home[:, None] + moves[nearest]], 1) ^ salt


def _vectors(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows by length of vector: places and a matrix."""
    sizes = np.diff(column.offsets.to_numpy())
    flat, starts = column.flatten().to_numpy(zero_copy_only=False), np.r_[0, np.cumsum(sizes)[:-1]]
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        yield at, flat[starts[at][:, None] + np.arange(size)].astype(np.float64)


def classes_of(df: DataFrame, vector: str, vec_id: str) -> tuple[DataFrame, DataFrame]:
    """Rows without their vector, with a hash of it (null if it can't link), and distinct vectors: ``cls, v, n, least`` (smallest id)."""
    kind = df.schema[vector].dataType.elementType.simpleString()
    v = F.col(vector) if kind in ("float", "double") else F.col(vector).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    # Zero has one sign only.
    clean = F.when(fine, F.transform(v, lambda x: F.when(x == 0, F.abs(x)).otherwise(x)))
    hashed = df.withColumn("_v", clean).withColumn("_h1", F.when(F.col("_v").isNotNull(), F.xxhash64("_v")))
    hashed = hashed.withColumn("_h2", F.when(F.col("_v").isNotNull(), F.xxhash64(F.lit("other"), F.reverse("_v"))))
    grouped = hashed.where("_v is not null").groupBy("_h1", "_h2").agg(F.first("_v").alias("v"), F.count("*").alias("n"), F.min(vec_id).alias("least"))
    classes = kept(grouped.withColumn("cls", F.monotonically_increasing_id()), "lattice-classes")
    return hashed.drop("_v", vector), classes


def cells_of(classes: DataFrame, tables: int, blocks: int, width: float, probes: int) -> DataFrame:
    """``cls``, ``own`` and ``near``: the cells that a class lies in, one per table, and those that it probes."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, near = np.zeros((batch.num_rows, tables), np.int64), np.zeros((batch.num_rows, tables * probes), np.int64)
            for at, matrix in _vectors(batch.column(1)):
                units = unit_vectors(matrix)
                found = np.stack([cells(units, t, blocks, width, probes) for t in range(tables)], 1)
                own[at], near[at] = found[:, :, 0], found[:, :, 1:].reshape(len(at), -1)
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.int64())) for x in (own, near)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *lists], ["cls", "own", "near"])

    return kept(classes.select("cls", "v").mapInArrow(hashed, "cls long, own array<long>, near array<long>"), "lattice-cells")


def _means(rows: DataFrame) -> DataFrame:
    """``unit, centre`` from ``unit, votes`` (a bounded list of vectors of one length)."""

    def mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            centres = [unit_vectors(np.array(v)).mean(0) for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([c.tolist() for c in centres], pa.list_(pa.float64()))], ["unit", "centre"])

    return rows.mapInArrow(mean, "unit long, centre array<double>")


def angles(pairs: DataFrame, a: str, b: str, out: str = "angle") -> DataFrame:
    """Adds the angle of two vectors of a row (4 where a vector is zero or lengths differ) and ``cosine``; drops the vectors."""
    others = [c for c in pairs.columns if c not in (a, b)]
    schema = ", ".join([*(f"{c} {pairs.schema[c].dataType.simpleString()}" for c in others), f"{out} double, cosine double"])

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cosine = np.full(batch.num_rows, -2.0)
            x, y = (batch.column(batch.schema.names.index(c)) for c in (a, b))
            size = np.diff(x.offsets.to_numpy())
            same = size == np.diff(y.offsets.to_numpy())
            for at, matrix in _vectors(x):
                at = at[same[at]]
                if len(at):
                    left, right = (next(_vectors(c.take(pa.array(at))))[1] for c in (x, y))
                    some = left.any(1) & right.any(1)
                    cosine[at[some]] = np.einsum("ij,ij->i", unit_vectors(left[some]), unit_vectors(right[some]))
            angle = np.where(cosine < -1.5, 4.0, np.arccos(np.clip(cosine, -1, 1)))
            rest = [batch.column(batch.schema.names.index(c)) for c in others]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(angle), pa.array(cosine)], [*others, out, "cosine"])

    return pairs.select(*others, a, b).mapInArrow(measured, schema)


def units_of(classes: DataFrame, placed: DataFrame, cosine: float) -> tuple[DataFrame, DataFrame]:
    """``cls, unit, n`` of every class, and ``unit, centre, radius, size`` (vectors, repeated ones each), ``classes``.

    A class follows the fullest of the cells that it lies in or probes. A unit's number is that of a class in it.
    """
    own = placed.select("cls", F.explode("own").alias("cell"))
    full = kept(own.groupBy("cell").agg(F.count("*").alias("held")).where("held > 1"), "lattice-full")
    seen = placed.select("cls", F.explode(F.concat("own", "near")).alias("cell"))
    leaders = seen.join(if_small(full, 32), "cell").groupBy("cls").agg(F.max(F.struct("held", "cell")).alias("_m")).select("cls", F.col("_m.cell").alias("cell"))
    followers = kept(leaders.join(classes.select("cls", "v", "n", "_h1"), "cls"), "lattice-followers")
    vote = F.pmod(F.xxhash64("_h1"), F.lit(VOTES))
    votes = followers.groupBy("cell", F.size("v").alias("dim"), vote.alias("vote")).agg(F.min_by("v", "_h1").alias("v"), F.min("cls").alias("cls"), F.count("*").alias("m"))
    votes = votes.groupBy("cell", "dim").agg(F.min("cls").alias("unit"), F.sort_array(F.collect_list(F.struct("vote", "v")))["v"].alias("votes"), F.sum("m").alias("m")).where("m > 1")
    votes = kept(votes, "lattice-votes")
    centres = votes.select("cell", "dim", "unit").join(_means(votes.select("unit", "votes")), "unit")
    near = followers.withColumn("dim", F.size("v")).join(centres, ["cell", "dim"]).select("cls", "n", "unit", "v", "centre")
    inside = angles(near, "v", "centre").where(F.col("angle") <= math.acos(cosine) / 2 - SLACK)
    inside = kept(inside.select("cls", "unit", "n", "angle"), "lattice-inside")
    groups = inside.groupBy("unit").agg(F.max("angle").alias("radius"), F.sum("n").alias("size"), F.count("*").alias("classes"))
    rest = classes.select("cls", "n", "v").join(inside.select("cls"), "cls", "left_anti")
    # Single classes are numbered apart from the units: a unit's class may have turned out to lie outside of it.
    lone = rest.select((-1 - F.col("cls")).alias("unit"), F.col("v").cast("array<double>").alias("centre"), F.lit(0.0).alias("radius"), F.col("n").alias("size"), F.lit(1).cast("long").alias("classes"))
    units = kept(groups.join(centres.select("unit", "centre"), "unit").select(*lone.columns).unionByName(lone), "lattice-units")
    members = inside.select("cls", "unit", "n").unionByName(rest.select("cls", (-1 - F.col("cls")).alias("unit"), "n"))
    return kept(members, "lattice-members"), units


def candidates(placed: DataFrame, members: DataFrame) -> DataFrame:
    """Pairs of units of which one has a member that probes, or lies in, a cell that a member of the other lies in."""
    at = kept(placed.join(members.select("cls", "unit"), "cls").select("unit", "own", "near"), "lattice-placed")
    own = at.select("unit", F.explode("own").alias("cell")).distinct()
    seen = at.select(F.col("unit").alias("by"), F.explode(F.concat("own", "near")).alias("cell")).distinct()
    met = own.join(seen, "cell").where("unit <> by").select(F.least("unit", "by").alias("a"), F.greatest("unit", "by").alias("b"))
    return met.distinct()


def _compared(pairs: DataFrame, cosine: float) -> DataFrame:
    """``cls, links, a, b`` from rows of two blocks of members (``x``, ``y``: lists of cls, n, v): each member's links to the other block."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, x, y in zip(*(batch.column(i).to_pylist() for i in range(4))):
                names = [np.array([m["cls"] for m in side]) for side in (x, y)]
                weight = [np.array([m["n"] for m in side]) for side in (x, y)]
                left, right = (unit_vectors(np.array([m["v"] for m in side])) for side in (x, y))
                link = left @ right.T >= cosine if left.shape[1] == right.shape[1] else np.zeros((len(left), len(right)), bool)
                links = np.concatenate([link @ weight[1], weight[0] @ link])
                cls, some = np.concatenate(names), links > 0
                ends = [pa.array(np.full(int(some.sum()), u), pa.int64()) for u in (a, b)]
                yield pa.RecordBatch.from_arrays([pa.array(cls[some]), pa.array(links[some], pa.int64()), *ends], ["cls", "links", "a", "b"])

    return pairs.mapInArrow(count, "cls long, links long, a long, b long")


def lattice_groups(
    df: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", cosine: float = COSINE,
    tables: int = TABLES, blocks: int = BLOCKS, width: float | None = None, probes: int = PROBES,
) -> DataFrame:
    """All columns of ``df`` but the vector, with ``n_links`` (other rows at ``cosine`` or more that were found), ``component_id``
    (smallest id reachable by links, itself included) and ``kept`` (whether that is the row's own id).

    Links are exact, none below the threshold; a pair near it can be missed (see ``WIDTH``). Vectors that are null, empty,
    zero or hold null or non-finite components link with nothing, nor do vectors of different length. Repeated rows link
    with each other. A null id counts as larger than any other; alone it is its own component. An empty table stays empty.
    Columns named like the results, or beginning with ``_``, are replaced or left out. Equal vectors are told by 128 bits.
    """
    plain = df.select(*(c for c in df.columns if c == vector or not (c in RESULTS or c.startswith("_"))))
    rows, classes = classes_of(plain, vector, vec_id)
    width = WIDTH * math.sqrt((1 - cosine) / (1 - COSINE)) if width is None else width
    placed = cells_of(classes, tables, blocks, width, probes)
    members, units = units_of(classes, placed, cosine)
    pairs = candidates(placed, members)
    side = lambda name: units.select(*(F.col(c).alias(f"{c}_{name}" if c != "unit" else name) for c in units.columns))
    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    measured = angles(joined, "centre_a", "centre_b")
    both, widest = F.col("radius_a") + F.col("radius_b"), math.acos(cosine)
    single = (F.col("classes_a") == 1) & (F.col("classes_b") == 1) & (F.col("radius_a") == 0) & (F.col("radius_b") == 0)
    sure = F.when(single, F.col("cosine") >= cosine).otherwise(F.col("angle") + both <= widest - SLACK)
    open_ = ~single & ~sure & (F.col("angle") - both <= widest + SLACK)
    judged = kept(measured.select("a", "b", "size_a", "size_b", sure.alias("sure"), open_.alias("open")).where("sure or open"), "lattice-pairs")
    certain = judged.where("sure")
    gained = certain.select(F.col("a").alias("unit"), F.col("size_b").alias("links")).unionByName(certain.select(F.col("b").alias("unit"), F.col("size_a").alias("links")))
    by_unit = gained.groupBy("unit").agg(F.sum("links").alias("unit_links"))
    found = kept(_compared(_blocks(judged.where("open").select("a", "b"), members, classes, units), cosine), "lattice-compared")
    by_class = found.groupBy("cls").agg(F.sum("links").alias("class_links"))
    links = certain.select("a", "b").unionByName(found.select("a", "b").distinct())
    roots = components(links).withColumnRenamed("node", "unit")
    known = members.join(units.select("unit", "size"), "unit").join(by_unit, "unit", "left").join(by_class, "cls", "left").join(roots, "unit", "left")
    no = F.lit(0).cast("long")
    known = known.select("cls", (F.col("size") - 1 + F.coalesce("unit_links", no) + F.coalesce("class_links", no)).alias("_links"), F.coalesce("root", "unit").alias("_root"))
    known = kept(classes.select("_h1", "_h2", "cls", "least").join(known, "cls"), "lattice-known")
    least = known.groupBy("_root").agg(F.min("least").alias("_least"))
    lookup = kept(known.join(least, "_root").select("_h1", "_h2", "_links", "_least"), "lattice-lookup")
    # Rows that can't link have no hash; they stay out of the join, or they would all meet in one task.
    linked = rows.where("_h1 is not null").join(if_small(lookup, 48), ["_h1", "_h2"])
    alone = rows.where("_h1 is null").withColumn("_links", no).withColumn("_least", F.col(vec_id))
    out = linked.unionByName(alone).withColumn("n_links", F.col("_links")).withColumn("component_id", F.col("_least"))
    return out.withColumn("kept", F.col("component_id").eqNullSafe(F.col(vec_id))).drop("_h1", "_h2", "_links", "_least")


def _blocks(pairs: DataFrame, members: DataFrame, classes: DataFrame, units: DataFrame) -> DataFrame:
    """``a, b, x, y``: every block of members of one unit with every one of the other."""
    named = kept(pairs.select(F.explode(F.array("a", "b")).alias("unit")).distinct(), "lattice-named")
    some = members.join(if_small(named, 16), "unit", "left_semi").join(units.select("unit", "classes"), "unit").join(classes.select("cls", "v"), "cls")
    number = F.pmod(F.xxhash64("cls"), F.ceil(F.col("classes") / SIDE))
    blocks = some.groupBy("unit", number.alias("block")).agg(F.collect_list(F.struct("cls", "n", "v")).alias("rows"))
    blocks = kept(blocks.drop("block"), "lattice-blocks")
    left = pairs.join(blocks.withColumnRenamed("unit", "a").withColumnRenamed("rows", "x"), "a")
    return left.join(blocks.withColumnRenamed("unit", "b").withColumnRenamed("rows", "y"), "b").select("a", "b", "x", "y")
