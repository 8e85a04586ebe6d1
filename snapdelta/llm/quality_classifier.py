"""Operator 4, quality classifier: attention-based multiple-instance learning over the passages of a text.

Every passage of a text is encoded; a gated attention, learned from the labels of whole texts alone, weighs the passages; the
score is that of the weighted passage. Weights are fitted on a bounded sample of labelled texts and then carried to every
text of the corpus, which is scored whole.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapdelta.llm import wordhash
from snapdelta.llm.common import kept, word_count
from snapdelta.llm.wordhash import PIECE, gram_hashes, word_hashes

for _module in (wordhash, sys.modules[__name__]):
    cloudpickle.register_pickle_by_value(_module)

#: Words of a passage.
PASSAGE = 64
#: The bound of the sample: labelled texts of each class, and passages that they have on average at most.
SAMPLE_PER_CLASS, SAMPLE_PASSAGES = 1500, 48
HIDDEN, ATTENTION, EPOCHS, BATCH, RATE, DECAY, SEED = 24, 12, 40, 64, 0.01, 1e-4, 7
KEEP_FROM = 0.3

#: Byte classes, in order: lower and upper case, digits, spaces, line ends, stops, marks, each symbol, beyond ASCII; the rest.
CLASSES = (
    b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\x0b\f\r", b"\n", b".,;:", b"!?",
    *(bytes([c]) for c in b"#*$%&|<>"), bytes(range(128, 256)),
)
CLASS_OF = np.full(256, len(CLASSES), np.uint8)
for _i, _c in enumerate(CLASSES):
    CLASS_OF[list(_c)] = _i
IS_WORD = np.ones(256, bool)
IS_WORD[list(b" \t\n\x0b\f\r")] = False
BUCKETS = 24
WIDTH = len(CLASSES) + 1 + BUCKETS + 6


def encode(text: bytes | None) -> np.ndarray:
    """One row per passage of a whole text; a text without words is one row of zeros but for the last place."""
    raw = np.frombuffer(text or b"", np.uint8)
    parts = [hashes for hashes, _ in word_hashes([text], IS_WORD)] if len(raw) else []
    words = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    if not len(words):
        out = np.zeros((1, WIDTH), np.float32)
        out[0, -1] = 1
        return out
    n = -(-len(words) // PASSAGE)
    of_word = np.arange(len(words)) // PASSAGE
    per = np.bincount(of_word, minlength=n).astype(np.float32)
    starts, seen, inside = [], 0, False
    for at in range(0, len(raw), PIECE):
        mask = IS_WORD[raw[at : at + PIECE]]
        begins = np.flatnonzero(mask & ~np.concatenate(([inside], mask[:-1])))
        inside = bool(mask[-1])
        starts.append(at + begins[(-seen) % PASSAGE :: PASSAGE])
        seen += len(begins)
    bounds = np.append(np.concatenate(starts), len(raw))
    bounds[0] = 0
    classes = np.zeros((n, len(CLASSES) + 1))
    for at in range(0, len(raw), PIECE):
        piece = CLASS_OF[raw[at : at + PIECE]].astype(np.int64)
        first, last = np.searchsorted(bounds, [at, at + len(piece) - 1], side="right") - 1
        inner = np.clip(bounds[first : last + 2] - at, 0, len(piece))
        passage = np.repeat(np.arange(last - first + 1), np.diff(inner))
        counts = np.bincount(passage * classes.shape[1] + piece, minlength=(last - first + 1) * classes.shape[1])
        classes[first : last + 1] += counts.reshape(-1, classes.shape[1])
    bytes_of = classes.sum(1)
    buckets = np.bincount(of_word * BUCKETS + (words % np.uint64(BUCKETS)).astype(np.int64), minlength=n * BUCKETS).reshape(n, BUCKETS)
    # The same word in another passage is another key.
    _, firsts = np.unique(words + of_word.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), return_index=True)
    distinct = np.bincount(of_word[firsts], minlength=n)
    grams = gram_hashes(words, 3)
    _, which, times = np.unique(grams, return_inverse=True, return_counts=True)
    again = np.bincount(of_word[: len(grams)], weights=(times[which] > 1), minlength=n)
    out = np.empty((n, WIDTH), np.float32)
    c = classes.shape[1]
    out[:, :c] = np.sqrt(classes / per[:, None])
    out[:, c : c + BUCKETS] = buckets / per[:, None]
    out[:, c + BUCKETS :] = np.stack(
        [bytes_of / per / 10, distinct / per, again / per, np.full(n, np.log1p(len(words)) / 10), per / PASSAGE, np.zeros(n)], axis=1
    )
    return out


class Model(NamedTuple):
    """Scaling of the inputs, the passage layer, the gated attention and the output."""

    mean: np.ndarray
    scale: np.ndarray
    w: np.ndarray
    b: np.ndarray
    v: np.ndarray
    u: np.ndarray
    a: np.ndarray
    c: np.ndarray
    d: np.ndarray


LEARNED = ("w", "b", "v", "u", "a", "c", "d")


def _forward(m: Model, x: np.ndarray, first: np.ndarray, bag: np.ndarray) -> tuple:
    """Scores of bags of passages that lie one after another; ``first``: where each begins, ``bag``: the bag of each row."""
    h = np.tanh(x @ m.w + m.b)
    t, g = np.tanh(h @ m.v), 1 / (1 + np.exp(-(h @ m.u)))
    e = (t * g) @ m.a
    e = np.exp(e - np.maximum.reduceat(e, first)[bag])
    weight = e / np.add.reduceat(e, first)[bag]
    z = np.add.reduceat(weight[:, None] * h, first)
    return 1 / (1 + np.exp(-(z @ m.c + m.d[0]))), z, weight, h, t, g


def scores(m: Model, bags: list[np.ndarray]) -> np.ndarray:
    sizes = np.array([len(b) for b in bags])
    first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    x = (np.concatenate(bags) - m.mean) / m.scale
    return _forward(m, np.clip(x, -6, 6), first, np.repeat(np.arange(len(bags)), sizes))[0]


def fit(bags: list[np.ndarray], labels: np.ndarray) -> Model:
    """Weights by Adam on the cross-entropy; the same bags in the same order give the same weights."""
    rng = np.random.default_rng(SEED)
    every = np.concatenate(bags)
    mean = every.mean(0, dtype=np.float64)
    scale = every.std(0, dtype=np.float64) + 1e-3
    del every
    init = lambda *s: rng.normal(0, 1 / np.sqrt(s[0]), s)
    m = Model(mean, scale, init(WIDTH, HIDDEN), np.zeros(HIDDEN), init(HIDDEN, ATTENTION), init(HIDDEN, ATTENTION), init(ATTENTION), init(HIDDEN), np.zeros(1))
    p = {k: getattr(m, k) for k in LEARNED}
    first_moment, second_moment = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            sizes = np.array([len(bags[i]) for i in some])
            first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            bag = np.repeat(np.arange(len(some)), sizes)
            x = np.clip((np.concatenate([bags[i] for i in some]) - mean) / scale, -6, 6)
            out, z, weight, h, t, g = _forward(Model(mean, scale, **p), x, first, bag)
            dout = (out - labels[some]) / len(some)
            dz = dout[:, None] * p["c"]
            along = (h * dz[bag]).sum(1)
            de = weight * (along - np.add.reduceat(weight * along, first)[bag])
            dgate = de[:, None] * p["a"]
            dt, dg = dgate * g * (1 - t * t), dgate * t * g * (1 - g)
            dh = weight[:, None] * dz[bag] + dt @ p["v"].T + dg @ p["u"].T
            dpre = dh * (1 - h * h)
            slopes = {"w": x.T @ dpre, "b": dpre.sum(0), "v": h.T @ dt, "u": h.T @ dg, "a": (t * g).T @ de, "c": z.T @ dout, "d": np.array([dout.sum()])}
            step += 1
            for k, slope in slopes.items():
                slope = slope + DECAY * p[k]
                first_moment[k] = 0.9 * first_moment[k] + 0.1 * slope
                second_moment[k] = 0.999 * second_moment[k] + 0.001 * slope * slope
                size = RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                p[k] = p[k] - size * first_moment[k] / (np.sqrt(second_moment[k]) + 1e-8)
    return Model(mean, scale, **p)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All passages of the texts; the first row of an id and label stands for all that this task sees of it."""
    seen = set()
    for batch in batches:
        keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        for i, (key, text) in enumerate(zip(keys, batch.column(2))):
            if key not in seen:
                seen.add(key)
                x = pa.array([encode(text.as_py()).ravel()], pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), batch.column(1).slice(i, 1), x], ["_id", "_label", "x"])


def train(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality", per_class: int = SAMPLE_PER_CLASS) -> Model | None:
    """A model from at most ``per_class`` labelled texts of each class, chosen by a hash of the id among those not held out.

    None if not both classes are labelled. An id has one text, that with the smallest hash, however many rows it has. Every
    chosen text has all its passages; in the order of the choice, texts are taken until those of a class have ``per_class`` *
    ``SAMPLE_PASSAGES`` passages. That, and the rest of the last text, is all that reaches the driver.
    """
    known = labels.select(F.col(doc_id).alias("_id"), F.col(label).alias("_label")).where(~held_out(F.col("_id")) & F.col("_id").isNotNull()).distinct()
    chosen = None
    for value in (0, 1):
        some = known.where(F.col("_label") == value).orderBy(F.xxhash64("_id"), "_id").limit(per_class)
        chosen = some if chosen is None else chosen.unionByName(some)
    chosen = kept(chosen.withColumn("_label", F.col("_label").cast("int")), "train-chosen")
    texts = docs.select(F.col(doc_id).alias("_id"), F.col(text).cast("binary").alias("_text"), F.col(text).alias("_words"))
    rows = texts.join(F.broadcast(chosen), "_id").withColumn("_hash", F.xxhash64("_text"))
    passages = F.greatest(F.ceil(word_count(F.col("_words")) / PASSAGE), F.lit(1)).cast("long")
    one = rows.groupBy("_id", "_label").agg(F.min("_hash").alias("_hash"), F.min_by(passages, "_hash").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("_label").orderBy(F.xxhash64("_id"), "_id").rowsBetween(Window.unboundedPreceding, -1))
    taken = one.withColumn("_before", F.coalesce(before, F.lit(0))).where(F.col("_before") < per_class * SAMPLE_PASSAGES)
    taken = kept(taken.select("_id", "_label", "_hash"), "train-taken")
    hashed = texts.select("_id", "_text", F.xxhash64("_text").alias("_hash")).join(F.broadcast(taken), ["_id", "_hash"])
    encoded = hashed.select("_id", "_label", "_text").mapInArrow(_encoded, f"_id {docs.schema[doc_id].dataType.simpleString()}, _label int, x array<float>")
    sample = encoded.dropDuplicates(["_id", "_label"])
    got = sample.toArrow()
    marks = got.column("_label").to_numpy().astype(float)
    ids = got.column("_id").to_pylist()
    # One array for all passages, and nothing of the table is left while fitting.
    every = got.column("x").combine_chunks()
    bounds = every.offsets.to_numpy() // WIDTH
    flat = every.flatten().to_numpy().astype(np.float32).reshape(-1, WIDTH)
    del got, every
    pa.default_memory_pool().release_unused()
    if len(set(marks.tolist())) < 2:
        return None
    bags = [flat[i:j] for i, j in zip(bounds - bounds[0], bounds[1:] - bounds[0])]
    order = sorted(range(len(ids)), key=lambda i: (ids[i], marks[i], bags[i].tobytes()))
    return fit([bags[i] for i in order], marks[order])


def score_texts(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``score``, of the whole text; 0.5 for every text where there is no model.

    Null and empty texts are scored as a passage without words. Repeated rows get equal scores; an empty table stays
    empty. A column named ``score`` is replaced.
    """
    others = [c for c in docs.columns if c != "score"]
    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in others), "score double"])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, out, bags, rows = batch.column(batch.schema.names.index(text)), [], [], 0
            for x in column:
                value = x.as_py()
                bags.append(encode(value if isinstance(value, bytes | None) else value.encode()))
                rows += len(bags[-1])
                if rows >= 4096:
                    out.append(scores(model, bags) if model else np.full(len(bags), 0.5))
                    bags, rows = [], 0
            if bags:
                out.append(scores(model, bags) if model else np.full(len(bags), 0.5))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(out) if out else [], pa.float64())], [*others, "score"])

    return docs.select(*others).mapInArrow(score, schema)
