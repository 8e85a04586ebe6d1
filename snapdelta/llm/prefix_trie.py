"""Operator 13, conversation prefix trie: exact nodes of all prefixes that conversations share, tails without a shuffle.

Every prefix of a conversation has a 128-bit digest: the exclusive-or of hashes of (place, role, text). A count-min sketch
of all digests is built by tasks and merged by segments; its counters never count too few, so an estimate of one proves
that a single conversation has the prefix. Such a node is emitted where its row lies. Only prefixes that the sketch can't
prove single are shuffled and grouped exactly. A full sketch proves less and more rows are shuffled; results are the same.

Sums over subtrees need no walk over levels: what a node adds (a leaf, tokens saved) is booked on its smallest member, sums
along each conversation run from its end, and one aggregate over the members of a node adds them up.
"""

from __future__ import annotations

import hashlib
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapdelta.llm.common import if_small, kept

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Conversations of a block may share the first turns of the block's first one, up to SHARED - 1 of them.
BLOCK, SHARED = 100, 6
#: Rows of one conversation that one window takes, and ids that are hashed as one text.
RUN, PACK = 4096, 4096
#: Counters of a sketch row: so many per prefix, up to MOST_COUNTERS. A task holds a byte for each, the merged sketch is a bit.
ROWS, PER_PREFIX, MOST_COUNTERS, SEGMENT = 2, 8, 1 << 25, 1 << 16
EMPTY = hashlib.sha256(b"").hexdigest()
RESULTS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def _zero() -> Column:
    return F.lit(0).cast("long")


def block_turns(conv_id: Column) -> Column:
    """How many turns a conversation takes from the first one of its block."""
    return F.crc32(conv_id.cast("string").cast("binary")) % SHARED


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds each row's place among its conversation's rows in this task, from 1; rows come sorted."""
    last, n = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch.column(0).to_numpy()
        starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
        place = np.arange(1, len(ids) + 1) - np.repeat(starts, np.diff(np.r_[starts, len(ids)]))
        if ids[0] == last:
            place[: starts[1] if len(starts) > 1 else len(ids)] += n
        last, n = ids[-1], int(place[-1])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place, pa.int64())], [*batch.schema.names, "place"])


def ordered_turns(turns: DataFrame) -> DataFrame:
    """``conv_id, at`` (place from 1), ``t1, t2`` (hashes of role and text), ``chars``; of a conversation of any length.

    A sort by ranges deals a long conversation out to several tasks; the places before a task's rows come from the counts
    of the tasks before it, which only conversations that lie in several tasks need.
    """
    said = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    inorder = said.orderBy("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    slim = inorder.select(
        "conv_id", F.spark_partition_id().alias("task"), F.xxhash64("role", "text").alias("t1"),
        F.xxhash64(F.lit("other"), "text", "role").alias("t2"), F.length("text").cast("long").alias("chars"),
    )
    placed = kept(slim.mapInArrow(_places, "conv_id long, task int, t1 long, t2 long, chars long, place long"), "trie-turns")
    # At most one conversation goes on from one task to the next, so there are at most two such rows per task.
    ends = placed.groupBy("task").agg(F.min("conv_id").alias("a"), F.max("conv_id").alias("b"))
    cut = ends.select(F.explode(F.array("a", "b")).alias("conv_id"), "task").distinct().groupBy("conv_id").agg(F.count("*").alias("m")).where("m > 1")
    counts = placed.join(F.broadcast(cut.select("conv_id")), "conv_id", "left_semi").groupBy("conv_id", "task").agg(F.count("*").alias("n"))
    over = Window.partitionBy("conv_id").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("conv_id", "task", F.coalesce(F.sum("n").over(over), _zero()).alias("before"))
    at = F.col("place") + F.coalesce("before", _zero())
    return placed.join(F.broadcast(before), ["conv_id", "task"], "left").select("conv_id", at.alias("at"), "t1", "t2", "chars")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``conv_id, depth, t1, t2, chars`` of every rebuilt conversation, and ``conv_id, len`` of each, turnless ones too."""
    placed = kept(ordered_turns(turns), "trie-placed")
    sizes = placed.groupBy("conv_id").agg(F.count("*").alias("n"))
    sizes = sizes.select("conv_id", "n", (F.col("conv_id") - F.col("conv_id") % BLOCK).alias("block"), block_turns(F.col("conv_id")).alias("h"))
    heads = sizes.where("conv_id = block").select("block", F.col("n").alias("head_n"))
    own = F.greatest(F.col("n") - F.col("h"), _zero())
    taken = F.least("h", F.coalesce("head_n", _zero()))
    convs = sizes.join(heads, "block", "left").select("conv_id", "block", "h", taken.alias("taken"), (taken + own).alias("len"))
    convs = kept(convs, "trie-conversations")
    few = if_small(convs, 40)
    after = placed.where(F.col("at") > block_turns(F.col("conv_id"))).join(few.select("conv_id", "h", "taken"), "conv_id")
    after = after.select("conv_id", (F.col("at") - F.col("h") + F.col("taken")).alias("depth"), "t1", "t2", "chars")
    # A block has at most BLOCK conversations and a head at most SHARED - 1 rows here.
    head = placed.where((F.col("conv_id") % BLOCK == 0) & (F.col("at") < SHARED)).withColumnRenamed("conv_id", "block").join(few.select("conv_id", "block", "h"), "block")
    head = head.where("at <= h").select("conv_id", F.col("at").alias("depth"), "t1", "t2", "chars")
    return after.unionByName(head), convs.select("conv_id", "len")


def running(df: DataFrame, totals: dict[str, tuple], order: list, down: bool = False) -> DataFrame:
    """Adds running aggregates along each conversation, in the given order of rows, which must follow ``depth`` (``down``: from
    the end), whatever a conversation's length.

    ``totals``: new column to (aggregate function, column, how two of its results are put together); neutral is 0. Windows run
    over RUN depths; in longer conversations the results of whole runs before are put on top.
    """
    runs = df.withColumn("_run", F.floor(F.col("depth") / RUN))
    inside = Window.partitionBy("conv_id", "_run").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = runs.withColumns({name: f(c).over(inside) for name, (f, c, _) in totals.items()})
    long = kept(df.where(F.col("depth") >= RUN).select("conv_id").distinct(), "trie-long")
    if long.isEmpty():
        return out.drop("_run")
    whole = runs.join(if_small(long, 16), "conv_id", "left_semi").groupBy("conv_id", "_run")
    whole = whole.agg(*(f(c).alias(f"_{name}") for name, (f, c, _) in totals.items()))
    before = Window.partitionBy("conv_id").orderBy(F.desc("_run") if down else F.asc("_run")).rowsBetween(Window.unboundedPreceding, -1)
    ahead = whole.select("conv_id", "_run", *(f(f"_{name}").over(before).alias(f"_{name}") for name, (f, _, _) in totals.items()))
    out = out.join(ahead, ["conv_id", "_run"], "left")
    out = out.withColumns({name: put(F.col(name), F.coalesce(F.col(f"_{name}"), _zero())) for name, (_, _, put) in totals.items()})
    return out.drop("_run", *(f"_{name}" for name in totals))


def prefixes(turns: DataFrame) -> DataFrame:
    """One row per conversation and prefix, the empty one included: ``conv_id, depth, k1, k2`` (digest), ``p1, p2`` (the parent's),
    ``chars`` of the last text, ``last`` (whether it is the whole conversation)."""
    rows, convs = rebuilt(turns)
    hashed = rows.select("conv_id", "depth", F.xxhash64("depth", "t1", "t2").alias("e1"), F.xxhash64("t2", "depth", "t1").alias("e2"), "chars")
    xor = Column.bitwiseXOR
    keyed = running(kept(hashed, "trie-rebuilt"), {"k1": (F.bit_xor, "e1", xor), "k2": (F.bit_xor, "e2", xor)}, [F.asc("depth")])
    below = keyed.join(if_small(convs, 24), "conv_id").select(
        "conv_id", "depth", "k1", "k2", xor(F.col("k1"), F.col("e1")).alias("p1"), xor(F.col("k2"), F.col("e2")).alias("p2"),
        "chars", (F.col("depth") == F.col("len")).alias("last"),
    )
    none = [_zero().alias(c) for c in ("depth", "k1", "k2", "p1", "p2", "chars")]
    return kept(below.unionByName(convs.select("conv_id", *none, (F.col("len") == 0).alias("last"))), "trie-prefixes")


def _buckets(k1: np.ndarray, k2: np.ndarray, counters: int) -> list[np.ndarray]:
    """The counter of each digest in each sketch row."""
    a, b = k1.view(np.uint64), k2.view(np.uint64)
    return [((a + np.uint64(r) * (b | np.uint64(1))) & np.uint64(counters - 1)).astype(np.int64) for r in range(ROWS)]


def sketch(paths: DataFrame, rows: int, most: int = MOST_COUNTERS) -> np.ndarray:
    """A bit per counter of a count-min sketch of all digests: whether it counts two or more. ``most`` * ROWS bits at most."""
    counters = min(most, max(SEGMENT, 1 << (PER_PREFIX * rows).bit_length()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((ROWS, counters), np.uint8)
        for batch in batches:
            for r, at in enumerate(_buckets(batch.column(0).to_numpy(), batch.column(1).to_numpy(), counters)):
                at.sort()
                twice = at[1:][at[1:] == at[:-1]]
                held[r, at] = np.minimum(held[r, at] + 1, 2)
                held[r, twice] = 2
        for i, segment in enumerate(held.reshape(-1, SEGMENT)):
            if segment.any():
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([zlib.compress(segment.tobytes(), 1)], pa.binary())], ["i", "s"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, s in zip(batch.column(0).to_pylist(), batch.column(1)):
                some = np.frombuffer(zlib.decompress(s.as_py()), np.uint8)
                held[i] = np.minimum(held[i] + some, 2) if i in held else some
        for i, segment in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([np.packbits(segment > 1).tobytes()], pa.binary())], ["i", "s"])

    built = paths.where("depth > 0").select("k1", "k2").mapInArrow(count, "i int, s binary")
    bits = np.zeros((ROWS * counters // SEGMENT, SEGMENT // 8), np.uint8)
    # Bounded by the sketch: ROWS * MOST_COUNTERS / 8 bytes.
    for row in built.repartition("i").mapInArrow(merge, "i int, s binary").collect():
        bits[row["i"]] = np.frombuffer(bytes(row["s"]), np.uint8)
    return bits.reshape(ROWS, -1)


def screened(paths: DataFrame, bits: np.ndarray) -> DataFrame:
    """Adds ``single``: the sketch proves that no other conversation has the prefix; ``parent_single``: nor its parent."""
    shared = paths.sparkSession.sparkContext.broadcast(bits)

    def single(k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        out = np.zeros(len(k1), bool)
        for r, at in enumerate(_buckets(k1, k2, 8 * shared.value.shape[1])):
            out |= (shared.value[r, at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 0
        return out

    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            depth, k1, k2, p1, p2 = (batch.column(batch.schema.names.index(c)).to_numpy() for c in ("depth", "k1", "k2", "p1", "p2"))
            here, above = single(k1, k2) & (depth > 0), single(p1, p2) & (depth > 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(here), pa.array(above)], [*batch.schema.names, "single", "parent_single"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in paths.schema) + ", single boolean, parent_single boolean"
    return paths.mapInArrow(screen, schema)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each key's packs in order, packs read one after another; rows come sorted by key and pack."""
    now, state = None, None
    names = ["depth", "k1", "k2", "ends_sha256"]

    def row(key, state):
        return pa.RecordBatch.from_arrays([pa.array([k], pa.int64()) for k in key] + [pa.array([state.hexdigest()])], names)

    for batch in batches:
        done = {name: [] for name in names}
        for *key, ids in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3)):
            if key != now:
                if now is not None:
                    for name, value in zip(names, [*now, state.hexdigest()]):
                        done[name].append(value)
                now, state = key, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.as_py().encode())
        yield pa.RecordBatch.from_arrays([*(pa.array(done[n], pa.int64()) for n in names[:3]), pa.array(done[names[3]], pa.string())], names)
    if now is not None:
        yield row(now, state)


def end_digests(ends: DataFrame) -> DataFrame:
    """Per node (``depth, k1, k2``) the hash of the ids of conversations that end there, in order.

    The hash reads ids one after another, so a node's ids meet in one task; they come as packs of up to PACK ids, are
    sorted on disk where need be, and no more than a pack is held at once.
    """
    packs = ends.groupBy("depth", "k1", "k2", F.floor(F.col("conv_id") / PACK).alias("pack")).agg(F.concat_ws(",", F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string"))).alias("ids"))
    inorder = packs.repartition("depth", "k1", "k2").sortWithinPartitions("depth", "k1", "k2", "pack")
    return inorder.select("depth", "k1", "k2", "ids").mapInArrow(_digests, "depth long, k1 long, k2 long, ends_sha256 string")


KEY = ["depth", "k1", "k2"]


def _sums(paths: DataFrame, nodes: DataFrame) -> DataFrame:
    """Per node that was grouped: leaves of its subtree and characters saved in it.

    A node's own share is booked on its smallest member at its depth, a tail's leaf on its conversation at its end.
    """
    saved = (F.col("n_convs") - 1) * F.col("chars")
    leaf = (F.col("n_end") == F.col("n_convs")).cast("long")
    booked = nodes.select("conv_id", "depth", saved.alias("saved"), leaf.alias("leaf")).where("saved > 0 or leaf > 0")
    tails = paths.where("single and last").select("conv_id", "depth", _zero().alias("saved"), F.lit(1).cast("long").alias("leaf"))
    no_key = [F.lit(None).cast("long").alias(c) for c in ("k1", "k2")]
    members = paths.where("not single").select("conv_id", *KEY, _zero().alias("saved"), _zero().alias("leaf"), F.lit(True).alias("member"))
    rows = members.unionByName(booked.unionByName(tails).select("*", *no_key, F.lit(False).alias("member")))
    add = lambda a, b: a + b
    totals = {"_saved": (F.sum, "saved", add), "_leaves": (F.sum, "leaf", add)}
    summed = running(rows, totals, [F.desc("depth"), F.asc("member")], down=True)
    return summed.where("member").groupBy(*KEY).agg(F.sum("_leaves").alias("n_leaves"), F.sum("_saved").alias("saved_tokens"))


def prefix_trie(turns: DataFrame, most_counters: int = MOST_COUNTERS) -> DataFrame:
    """The nodes of the trie over all rebuilt conversations: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``, and ``node``, ``parent`` (digests in hex, null above the root).

    ``turns``: ``conv_id``, ``turn``, ``role``, ``text``; other columns are not read. Turns are in order of turn (null first), then
    role and text; repeated rows are a turn each; null role or text is empty; rows without a conv_id go. Rebuilt conversations
    take their first turns from the first conversation of their block (see ``rebuilt``); one without turns is a member of the
    root alone. Prefixes are compared by 128-bit digests. An empty table has no nodes.
    """
    unscreened = prefixes(turns)
    paths = kept(screened(unscreened, sketch(unscreened, unscreened.count(), most_counters)), "trie-screened")
    nodes = kept(
        paths.where("not single").groupBy(*KEY).agg(
            F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("chars").alias("chars"), F.min("p1").alias("p1"), F.min("p2").alias("p2"),
            F.max("parent_single").alias("parent_single"), F.sum(F.col("last").cast("long")).alias("n_end"),
        ),
        "trie-nodes",
    )
    tails = paths.where("single")
    above = [(F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")]
    born = nodes.where("depth > 0 and not parent_single").select(*above).unionByName(tails.where("not parent_single").select(*above))
    children = born.groupBy(*KEY).agg(F.count("*").alias("n_children"))
    ends = end_digests(paths.where("last and not single").select("conv_id", *KEY))
    grouped = nodes.join(_sums(paths, nodes), KEY).join(children, KEY, "left").join(ends, KEY, "left").select(
        "conv_id", *KEY, "p1", "p2", "parent_single", "n_convs", F.coalesce("n_children", _zero()).alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
    )
    alone = tails.select(
        "conv_id", *KEY, "p1", "p2", "parent_single", F.lit(1).cast("long").alias("n_convs"), F.when(F.col("last"), 0).otherwise(1).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"), _zero().alias("saved_tokens"),
        F.when(F.col("last"), F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(F.lit(EMPTY)).alias("ends_sha256"),
    )
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    looked_up = grouped.where("not parent_single").unionByName(alone.where("not parent_single")).join(if_small(parents, 64), ["depth", "p1", "p2"], "left")
    within = grouped.where("parent_single").unionByName(alone.where("parent_single")).withColumn("parent_conv_id", F.col("conv_id"))
    name = lambda *k: F.lower(F.concat(*(F.lpad(F.hex(c), 16, "0") for c in k)))
    return looked_up.unionByName(within).select(
        *RESULTS, name("k1", "k2").alias("node"), F.when(F.col("depth") > 0, name("p1", "p2")).alias("parent")
    )
