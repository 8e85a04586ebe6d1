"""Operator 12, vector code compression: product codes whose codebooks are refined by dual-tree Lloyd rounds.

A vector becomes integers and is cut into equal parts; each part position has a codebook. A task takes its vectors by
chunks and, per part position, hangs a chunk's parts in a tree of boxes with cached counts and sums, and the codebook's
entries in another. Both are walked together: a pair of nodes goes when the least distance between its boxes exceeds the
largest distance to some other pair of the same parts, so that a whole node of parts with one entry left is assigned by
its cached sum. Leaves of parts that several entries are left for compare integers. All bounds are integers, so nothing
depends on how rows are dealt out.

Only counts and sums per entry leave a task; a round is one aggregate over them, and the codebooks (``ENTRIES`` times the
length of a vector) are all that reaches the driver.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapdelta.llm.common import free_name, if_small, kept

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Integers beyond count as this, so that squared distances and their sums fit 64 bits.
MOST = 1 << 27
#: Vectors of a chunk at most, and parts of a leaf of its trees.
CHUNK, LEAF = 8192, 32
#: Columns of the result; a column of the input with such a name is replaced.
RESULTS = ("code", "error", "label_error", "codebooks_sha256")


def as_integers(vector: Column) -> Column:
    """``floor(SCALE * x)`` of each component; null for a vector that is null or holds a null or a non-finite component."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    whole = lambda x: F.floor(F.greatest(F.least(x.cast("double") * SCALE, F.lit(float(MOST))), F.lit(-float(MOST)))).cast("int")
    return F.when(F.forall(vector, fine), F.transform(vector, whole))


class Tree:
    """Boxes over points that are halved along their widest side, one tree per part position, all in one array per level.

    ``points``: (positions, 2**depth * leaf, width); ``order``: the place that each point had; a level's nodes have ``low``,
    ``high`` (positions, nodes, width). Points with weight 0 are padding: they count for nothing.
    """

    def __init__(self, points: np.ndarray, leaf: int, weight: np.ndarray | None = None):
        positions, size, width = points.shape
        order = np.broadcast_to(np.arange(size), (positions, size))
        self.depth = max(0, (size // leaf).bit_length() - 1)
        self.low, self.high = [], []
        for level in range(self.depth + 1):
            nodes = points.reshape(positions << level, size >> level, width)
            low, high = nodes.min(1), nodes.max(1)
            self.low.append(low.reshape(positions, -1, width))
            self.high.append(high.reshape(positions, -1, width))
            if level < self.depth:
                side = (high - low).argmax(1)
                along = np.take_along_axis(nodes, side[:, None, None], 2)[:, :, 0]
                by = np.argpartition(along, (size >> level) // 2, axis=1)
                points = np.take_along_axis(nodes, by[:, :, None], 1).reshape(positions, size, width)
                order = np.take_along_axis(order.reshape(positions << level, -1), by, 1).reshape(positions, size)
        self.points, self.order = points, order
        if weight is not None:
            self.weight = weight[order]
            held = points * self.weight[:, :, None]
            self.counts = [self.weight.reshape(positions, 1 << level, -1).sum(2) for level in range(self.depth + 1)]
            self.sums = [held.reshape(positions, 1 << level, size >> level, width).sum(2) for level in range(self.depth + 1)]


def _pad(points: np.ndarray, leaf: int) -> tuple[np.ndarray, np.ndarray]:
    """Points (rows, positions, width) as (positions, 2**k * leaf, width), the last row repeated with weight 0."""
    rows = len(points)
    size = leaf
    while size < rows:
        size *= 2
    at = np.minimum(np.arange(size), rows - 1)
    return points[at].transpose(1, 0, 2), (np.arange(size) < rows).astype(np.int64)


def assign(points: np.ndarray, books: np.ndarray, codes: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """Counts and sums of the points of each entry, (positions, entries[, width]), and the codes (rows, positions) if asked.

    ``points``: (rows, positions, width), ``books``: (positions, entries, width), 64-bit integers both. The nearest entry
    by squared distance, the lowest of several.
    """
    rows, positions, width = points.shape
    entries = books.shape[1]
    padded, weight = _pad(points, LEAF)
    parts = Tree(padded, LEAF, weight)
    size = padded.shape[1]
    # A codebook is filled up with its last entry, whose copies are dropped again: they only repeat a box.
    full = 1 << (entries - 1).bit_length()
    at = np.minimum(np.arange(full), entries - 1)
    book = Tree(books[:, at], 1)
    counts, sums = np.zeros((positions, entries), np.int64), np.zeros((positions, entries, width), np.int64)
    out = np.zeros((positions, size), np.int64) if codes else None
    p, q, e = np.arange(positions), np.zeros(positions, np.int64), np.zeros(positions, np.int64)
    at_part = at_book = 0
    while len(p):
        low, high = parts.low[at_part][p, q], parts.high[at_part][p, q]
        other_low, other_high = book.low[at_book][p, e], book.high[at_book][p, e]
        apart = np.maximum(0, np.maximum(low - other_high, other_low - high))
        across = np.maximum(high - other_low, other_high - low)
        least, most = _squares(apart), _squares(across)
        first = np.flatnonzero(np.r_[True, (p[1:] != p[:-1]) | (q[1:] != q[:-1])])
        node = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(p)]))
        stays = least <= np.minimum.reduceat(most, first)[node]
        p, q, e, node = p[stays], q[stays], e[stays], node[stays]
        if at_book == book.depth:
            # Padding repeats the last entry; of its copies only one may stay.
            index = np.minimum(book.order[p, e], entries - 1)
            by = np.lexsort((index, node))
            p, q, e, node, index = p[by], q[by], e[by], node[by], index[by]
            fresh = np.r_[True, (node[1:] != node[:-1]) | (index[1:] != index[:-1])]
            p, q, e, node, index = p[fresh], q[fresh], e[fresh], node[fresh], index[fresh]
            # Single entries have a sharper bound: one that another is nearer than at every corner of the box goes.
            first = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
            low, high, here = parts.low[at_part][p, q], parts.high[at_part][p, q], books[p, index]
            middle = _squares(low + high - 2 * here)
            node = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(p)]))
            central = first + _first_least(middle, first, node)
            there = here[central][node]
            step = here - there
            ahead = _squares(there) - _squares(here) + 2 * np.einsum("ij,ij->i", np.where(step > 0, high, low), step)
            stays = ahead >= 0
            p, q, e, node, index = p[stays], q[stays], e[stays], node[stays], index[stays]
            alone = np.bincount(node)[node] == 1
            np.add.at(counts, (p[alone], index[alone]), parts.counts[at_part][p[alone], q[alone]])
            np.add.at(sums, (p[alone], index[alone]), parts.sums[at_part][p[alone], q[alone]])
            if codes:
                held = size >> at_part
                out.reshape(positions, -1, held)[p[alone], q[alone]] = index[alone][:, None]
            p, q, e, node, index = p[~alone], q[~alone], e[~alone], node[~alone], index[~alone]
            if at_part == parts.depth and len(p):
                _leaves(parts, books, p, q, index, node, counts, sums, out)
                break
        # Both trees go down a level where they have one.
        if at_part < parts.depth:
            p, q, e = np.repeat(p, 2), np.repeat(2 * q, 2) + np.tile([0, 1], len(q)), np.repeat(e, 2)
        if at_book < book.depth:
            p, q, e = np.repeat(p, 2), np.repeat(q, 2), np.repeat(2 * e, 2) + np.tile([0, 1], len(e))
        at_part, at_book = min(at_part + 1, parts.depth), min(at_book + 1, book.depth)
        by = np.lexsort((q, p))
        p, q, e = p[by], q[by], e[by]
    if not codes:
        return counts, sums, None
    back = np.empty_like(out)
    np.put_along_axis(back, parts.order, out, 1)
    return counts, sums, back[:, :rows].T


def _squares(x: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", x, x)


def _first_least(values: np.ndarray, first: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Place of the least value within each group of neighbours, the first of several."""
    at = np.where(values == np.minimum.reduceat(values, first)[group], np.arange(len(values)), len(values))
    return np.minimum.reduceat(at, first) - first


def _leaves(parts: Tree, books: np.ndarray, p, q, index, node, counts, sums, out, some: int = 1 << 16) -> None:
    """Integer distances of the points of leaves to the entries left for them; ``node`` names a leaf, ascending."""
    cuts = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
    start = 0
    while start < len(cuts):
        stop = min(len(cuts), start + some // 64)
        a, b = cuts[start], cuts[stop] if stop < len(cuts) else len(node)
        pp, qq, ii = p[a:b], q[a:b], index[a:b]
        first = cuts[start:stop] - a
        leaf = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(pp)]))
        held = parts.points.reshape(parts.points.shape[0], -1, LEAF, parts.points.shape[2])[pp, qq]
        apart = held - books[pp, ii][:, None, :]
        far = (apart * apart).sum(2)
        nearest = np.minimum.reduceat(far, first)
        # Entries of a leaf ascend, so the least index is the first of the nearest.
        code = np.minimum.reduceat(np.where(far == nearest[leaf], ii[:, None], books.shape[1]), first)
        at, leaf_q = pp[first], qq[first]
        weight = parts.weight.reshape(parts.weight.shape[0], -1, LEAF)[at, leaf_q]
        points = held[first] * weight[:, :, None]
        np.add.at(counts, (at[:, None], code), weight)
        np.add.at(sums, (at[:, None], code), points)
        if out is not None:
            out.reshape(out.shape[0], -1, LEAF)[at, leaf_q] = code
        start = stop


def _chunks(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[list[pa.RecordBatch]]:
    """Batches together until they have a chunk's rows; a larger batch is cut."""
    held, rows = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, CHUNK):
            piece = batch.slice(at, CHUNK)
            held.append(piece)
            rows += piece.num_rows
            if rows >= CHUNK:
                yield held
                held, rows = [], 0
    if rows:
        yield held


def _integers(pieces: list[pa.RecordBatch], column: str, shape: tuple[int, int]) -> np.ndarray:
    values = [p.column(p.schema.names.index(column)).flatten().to_numpy(zero_copy_only=False) for p in pieces]
    return np.concatenate(values).astype(np.int64).reshape(-1, *shape)


def _round(integers: DataFrame, column: str, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round: floored means of the parts assigned to each entry; unused entries stay."""
    positions, entries, width = books.shape

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros((positions, entries), np.int64), np.zeros((positions, entries, width), np.int64)
        for pieces in _chunks(batches, column):
            some = assign(_integers(pieces, column, (positions, width)), books)
            counts, sums = counts + some[0], sums + some[1]
        used = np.argwhere(np.broadcast_to(counts[:, :, None] > 0, sums.shape))
        if len(used):
            i, j, k = used.T
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (i, j, k, counts[i, j], sums[i, j, k])], ["i", "j", "k", "n", "s"])

    rows = integers.select(column).mapInArrow(partial, "i long, j long, k long, n long, s long")
    # One row per component of a codebook, however many vectors there are.
    got = rows.groupBy("i", "j", "k").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).toArrow()
    i, j, k, n, s = (got.column(c).to_numpy() for c in ("i", "j", "k", "n", "s"))
    books = books.copy()
    books[i, j, k] = s // n
    return books


def codebook_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def vector_codes(
    df: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", label: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> DataFrame:
    """All columns of ``df`` but the vector, with ``code`` (the entry of each part, two hex digits or more each), ``error`` (squared
    distances to them, summed), ``label_error`` (the error summed over equal labels, nulls together) and ``codebooks_sha256``.

    Rows with a null vector, or with a null or non-finite component, go. A component x is ``floor(256 * x)``; integers
    beyond 2**27 count as that. The vector of the smallest id gives the length: rows with vectors of another length go,
    and a length that ``parts`` does not divide is filled up with zeros at the end. Codebooks start as the parts of the rows with
    the smallest ids (null last; of equal ids the smaller integers first; repeated rows each). Repeated rows get equal
    codes and count each. An empty table, or one without a usable vector, gives no rows. Columns with the names of the
    results are replaced.
    """
    others = [c for c in df.columns if c != vector and c not in RESULTS]
    column = free_name(df.columns, "_integers")
    integers = df.select(*others, as_integers(F.col(vector)).alias(column)).where(F.col(column).isNotNull() & (F.size(column) > 0))
    integers = kept(integers, "vector-integers")
    by_id = (F.col(vec_id).asc_nulls_last(), F.col(column))
    first = integers.select(vec_id, column).orderBy(*by_id).limit(1).collect()
    length = len(first[0][column]) if first else parts
    width = -(-length // parts)
    filled = F.concat(F.col(column), F.array_repeat(F.lit(0), width * parts - length)) if width * parts > length else F.col(column)
    integers = integers.where(F.size(column) == length).withColumn(column, filled)
    start = integers.select(vec_id, column).orderBy(*by_id).limit(entries).select(column).collect()
    books = np.array([r[0] for r in start], np.int64).reshape(-1, parts, width).transpose(1, 0, 2)
    for _ in range(rounds if start else 0):
        books = _round(integers, column, books)
    coded = kept(_coded(integers, others, column, books), "vector-codes").withColumn("codebooks_sha256", F.lit(codebook_digest(books)))
    if label not in others:
        return coded.withColumn("label_error", F.lit(coded.agg(F.sum("error")).first()[0]).cast("long"))
    key, total = free_name(coded.columns, "_label"), free_name(coded.columns, "label_error")
    totals = kept(coded.groupBy(F.col(label).alias(key)).agg(F.sum("error").alias(total)), "label-errors")
    # Few labels are sent to every executor; of many, a hot one is split by adaptive execution.
    return coded.join(if_small(totals, 64), F.col(label).eqNullSafe(F.col(key))).drop(key)


def _coded(integers: DataFrame, others: list[str], column: str, books: np.ndarray) -> DataFrame:
    positions, entries, width = books.shape
    digits = max(2, len(f"{max(0, entries - 1):x}"))
    schema = ", ".join([*(f"`{c}` {integers.schema[c].dataType.simpleString()}" for c in others), "code string", "error long"])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pieces in _chunks(batches, column):
            points = _integers(pieces, column, (positions, width))
            codes = assign(points, books, codes=True)[2]
            apart = points - books[np.arange(positions)[None, :], codes]
            errors = (apart * apart).sum((1, 2))
            names = np.array([f"{i:0{digits}x}" for i in range(entries)])
            texts = ["".join(row) for row in names[codes].tolist()]
            table = pa.Table.from_batches(pieces).select(others).combine_chunks().to_batches()
            rest = table[0].columns if table else []
            yield pa.RecordBatch.from_arrays([*rest, pa.array(texts, pa.string()), pa.array(errors, pa.int64())], [*others, "code", "error"])

    return integers.mapInArrow(code, schema)
