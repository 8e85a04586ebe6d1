"""Operator 10, benchmark decontamination: winnowed fingerprints of corpus and benchmark are joined, hits extended to windows.

Of every ten words in a row the smallest hash of five words in a row is a fingerprint. A window of ten words that occurs in
both tables has the same smallest hash on both sides, so every shared window shares a fingerprint, while a text sends only
about a third of its five-word hashes. Texts with a fingerprint of the benchmark then send all their windows, as 128-bit
hashes, and these are joined with the windows of the items.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapdelta.llm import wordhash
from snapdelta.llm.common import free_name, kept, row_key
from snapdelta.llm.wordhash import gram_hashes, word_hashes

WINDOW, GRAM = 10, 5
#: Rows whose arrays are sent back at a time.
ROWS = 512
#: Words: ASCII digits and letters, and everything beyond ASCII. By byte, after lower-casing.
IS_WORD = np.zeros(256, bool)
IS_WORD[48:58] = IS_WORD[97:123] = IS_WORD[128:256] = True

for _module in (wordhash, sys.modules[__name__]):
    cloudpickle.register_pickle_by_value(_module)


def fingerprints(words: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> np.ndarray:
    """Distinct smallest gram hashes of all windows; empty if there are fewer words than a window."""
    grams = gram_hashes(words, gram)
    span = window - gram + 1
    n = len(grams) - span + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    least = grams[:n].copy()
    for j in range(1, span):
        np.minimum(least, grams[j : j + n], out=least)
    return np.unique(least)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _lists(parts: list[np.ndarray]) -> pa.Array:
    offsets = pa.array(np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, _signed(np.concatenate(parts) if parts else np.empty(0, np.uint64)))


def _per_text(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    column = batch.column(batch.schema.names.index("_text"))
    for start in range(0, batch.num_rows, ROWS):
        part = column.slice(start, ROWS)
        for hashes, counts in word_hashes([x.as_py() for x in part], IS_WORD):
            yield from np.split(hashes, np.cumsum(counts)[:-1])


def _sends(df: DataFrame, text: str, extra: dict[str, str], of) -> DataFrame:
    """``df`` without its text, with the columns that ``of`` makes from the word hashes of each text."""
    others = [c for c in df.columns if c != text]
    read = df.select(*others, F.col(text).cast("binary").alias("_text"))
    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in others), *(f"{k} {v}" for k, v in extra.items())])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list = []
            done = 0
            kept_columns = [batch.column(batch.schema.names.index(c)) for c in others]
            for words in _per_text(batch):
                rows.append(of(words))
                if len(rows) == ROWS:
                    yield pa.RecordBatch.from_arrays([*(c.slice(done, len(rows)) for c in kept_columns), *_columns(rows, extra)], [*others, *extra])
                    done += len(rows)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([*(c.slice(done, len(rows)) for c in kept_columns), *_columns(rows, extra)], [*others, *extra])

    def _columns(rows: list, extra: dict[str, str]) -> list[pa.Array]:
        return [
            _lists([r[i] for r in rows]) if kind.startswith("array") else pa.array([r[i] for r in rows], pa.int64())
            for i, kind in enumerate(extra.values())
        ]

    return read.mapInArrow(send, schema)


def _grams_of(lengths: tuple[int, ...], window: int):
    """Two hashes of every window, and the lengths' own ones: for each length, pairs in the order of places."""

    def of(words: np.ndarray) -> tuple:
        out: list = [len(words)]
        for n in (window, *lengths):
            out += [gram_hashes(words, n, 1), gram_hashes(words, n, 2)]
        return tuple(out)

    return of


def _item_windows(benchmark: DataFrame, text: str, item_id: str, window: int, gram: int) -> DataFrame:
    """``item, words, size, w1, w2, _prints`` per item: windows of ``size`` words (the whole item where it has fewer)."""

    def of(words: np.ndarray) -> tuple:
        size = min(window, len(words))
        if not size:
            return 0, 0, *[np.empty(0, np.uint64)] * 3
        return len(words), size, gram_hashes(words, size, 1), gram_hashes(words, size, 2), fingerprints(words, window, gram)

    items = benchmark.select(F.col(item_id).alias("item"), F.col(text).alias("text"))
    columns = {"words": "bigint", "size": "bigint", "w1": "array<bigint>", "w2": "array<bigint>", "_prints": "array<bigint>"}
    return kept(_sends(items, "text", columns, of), "items")


def contamination(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """All columns of ``docs`` but the text, with ``n_words``, ``n_hit`` (words inside an occurrence of an item's window),
    ``items`` (ids of those items as strings, sorted), ``contaminated`` and ``_row``.

    An item shorter than a window is one window; null and empty texts have no words, on either side. Items that share a
    window all count, equal ids once, null ids not at all. Repeated rows get equal results, an empty table on either side
    means no hits. Columns with the names of the results are replaced.
    """
    columns = [c for c in docs.columns if c not in ("n_words", "n_hit", "items", "contaminated") and not c.startswith("_")]
    plain = docs.select(*columns)
    keyed = plain.withColumn("_row", row_key(columns, text))
    items = _item_windows(benchmark, text, item_id, window, gram)
    lengths = tuple(sorted(r["size"] for r in items.where((F.col("size") > 0) & (F.col("size") < window)).select("size").distinct().collect()))

    def of(words: np.ndarray) -> tuple:
        return len(words), fingerprints(words, window, gram), *(np.unique(gram_hashes(words, n, 1)) for n in lengths)

    # At most window - 1 lengths, so the columns are few.
    sent = {"n_words": "bigint", "_prints": "array<bigint>", **{f"_short_{n}": "array<bigint>" for n in lengths}}
    signed = kept(_sends(keyed, text, sent, of), "doc-prints")

    prints = items.where(F.col("size") == window).select(F.explode("_prints").alias("_print")).distinct()
    hit = signed.select("_row", F.explode("_prints").alias("_print")).join(prints, "_print").select("_row")
    for n in lengths:
        whole = items.where(F.col("size") == n).select(F.explode("w1").alias("_print")).distinct()
        hit = hit.unionByName(signed.select("_row", F.explode(f"_short_{n}").alias("_print")).join(whole, "_print").select("_row"))
    chosen = kept(hit.distinct(), "doc-candidates")

    sizes = (window, *lengths)
    grams = {"n_words": "bigint", **{f"{p}_{n}": "array<bigint>" for n in sizes for p in ("a", "b")}}
    texts = keyed.select("_row", text).join(chosen, "_row", "left_semi")
    spread = _sends(texts, text, grams, _grams_of(lengths, window))
    each = F.concat(
        *(
            F.transform(
                F.arrays_zip(F.col(f"a_{n}").alias("a"), F.col(f"b_{n}").alias("b")),
                lambda x, i: F.struct(F.lit(n).cast("bigint").alias("size"), x["a"].alias("w1"), x["b"].alias("w2"), i.cast("bigint").alias("at")),
            )
            for n in sizes
        )
    )
    places = spread.select("_row", F.explode(each).alias("p")).select("_row", "p.*")
    windows = items.where("size > 0").select("item", "size", F.explode(F.arrays_zip("w1", "w2")).alias("w")).select("item", "size", "w.*").distinct()
    on = ["size", "w1", "w2"]
    known = places.join(windows.select(*on).distinct(), on, "left_semi")
    known = kept(known.distinct(), "doc-hits")
    spans = known.groupBy("_row").agg(F.sort_array(F.collect_set(F.struct("at", "size"))).alias("_spans"))
    united = F.aggregate(
        "_spans",
        F.struct(F.lit(0).cast("bigint").alias("end"), F.lit(0).cast("bigint").alias("n")),
        lambda so_far, x: F.struct(
            F.greatest(so_far["end"], x["at"] + x["size"]).alias("end"),
            (so_far["n"] + F.greatest(F.lit(0), x["at"] + x["size"] - F.greatest(so_far["end"], x["at"]))).alias("n"),
        ),
        lambda so_far: so_far["n"],
    )
    named = known.select("_row", *on).distinct().join(windows, on).select("_row", F.col("item").cast("string").alias("item")).distinct()
    names = named.groupBy("_row").agg(F.sort_array(F.collect_list("item")).alias("items"))
    found = kept(spans.select("_row", united.alias("n_hit")).join(names, "_row", "left"), "doc-contaminated")
    joined = signed.select(*(c for c in columns if c != text), "n_words", "_row").join(found, "_row", "left")
    return (
        joined.withColumn("n_hit", F.coalesce("n_hit", F.lit(0).cast("bigint")))
        .withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
        .withColumn("contaminated", F.col("n_hit") > 0)
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id") -> DataFrame:
    """``docs`` without the rows that hold a window of the benchmark; all other rows unchanged."""
    bad = kept(contamination(docs, benchmark, text, item_id).where("contaminated").select("_row").distinct(), "contaminated")
    key = free_name(docs.columns)
    return docs.withColumn(key, row_key(docs.columns, text)).join(bad.withColumnRenamed("_row", key), key, "left_anti").select(*docs.columns)
