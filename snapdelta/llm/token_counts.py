"""Operator 7, token counts: an exact histogram of encoded lengths, whose suffix sums answer every context limit."""

from __future__ import annotations

import base64
import re
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapdelta.llm.common import kept

cloudpickle.register_pickle_by_value(sys.modules[__name__])

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how the public byte-level vocabulary cuts text before merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
#: A cut before a single space between a word and a letter is always one of the pattern's own.
CUT = re.compile(r"(?<=\S)(?= [^\W\d_])")
PART = 1 << 16
#: Lengths whose sums are taken in one group.
BAND = 1024


def parts(text: str) -> list[str]:
    """A long text in parts that encode to what the whole does; a part is longer only where there is no place to cut."""
    out, start = [], 0
    while len(text) - start > PART:
        cut = CUT.search(text, start + PART)
        if not cut:
            break
        out.append(text[start : cut.start()])
        start = cut.start()
    out.append(text[start:])
    return out


def read_vocabulary(path: str = VOCABULARY) -> bytes:
    """The file of merge ranks, read on the driver and sent with the tasks (under 2 MB for 50,000 entries)."""
    with open(path, "rb") as f:
        return f.read()


def encoder(vocabulary: bytes):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    return tiktoken.Encoding("corpus", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(docs: DataFrame, vocabulary: bytes, text: str = "text") -> DataFrame:
    """All columns of ``docs`` but the text, with ``n_tokens``: the length of the whole encoded text; 0 for null and empty."""
    ids = [c for c in docs.columns if c not in (text, "n_tokens")]
    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in ids), "n_tokens bigint"])

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(vocabulary).encode_ordinary
        for batch in batches:
            texts = batch.pop("_text")
            yield batch.assign(n_tokens=[sum(len(encode(p)) for p in parts(t)) if t else 0 for t in texts])

    return docs.select(*ids, docs[text].alias("_text")).mapInPandas(count, schema)


def length_histogram(docs: DataFrame, vocabulary: bytes, text: str = "text") -> DataFrame:
    """Per distinct length ``n_tokens``: ``n_docs`` of it, ``docs_at_least`` and ``tokens_at_least`` (documents of that length or
    more, and their tokens), ``truncated_total`` (tokens left when every document is cut to that length), ``share_up_to``
    (share of documents of that length or less).

    Null and empty texts count as length 0; repeated rows count each; an empty table has no rows. Counts combine before
    the shuffle, so a length that a third of all texts share costs no more than another. Distinct lengths are at most the
    square root of twice the tokens; their suffix sums run over bands of lengths, and over the bands' sums.
    """
    counts = kept(token_counts(docs.select(text), vocabulary, text).groupBy("n_tokens").agg(F.count("*").alias("n_docs")), "length-histogram")
    banded = counts.withColumn("_band", F.floor(F.col("n_tokens") / BAND)).withColumn("_tokens", F.col("n_tokens") * F.col("n_docs"))
    bands = banded.groupBy("_band").agg(F.sum("n_docs").alias("_d"), F.sum("_tokens").alias("_t"))
    # One row per band: a thousandth of the longest length at most.
    above = Window.orderBy(F.desc("_band")).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    bands = bands.select("_band", F.coalesce(F.sum("_d").over(above), zero).alias("_d_above"), F.coalesce(F.sum("_t").over(above), zero).alias("_t_above"))
    total = counts.agg(F.sum("n_docs").alias("_docs"), F.sum(F.col("n_tokens") * F.col("n_docs")).alias("_all"))
    inside = Window.partitionBy("_band").orderBy(F.desc("n_tokens"))
    sums = banded.join(bands, "_band").select(
        "n_tokens", "n_docs",
        (F.sum("n_docs").over(inside) + F.col("_d_above")).alias("docs_at_least"),
        (F.sum("_tokens").over(inside) + F.col("_t_above")).alias("tokens_at_least"),
    )
    whole = total.first()
    docs_all, tokens_all = whole["_docs"] or 0, whole["_all"] or 0
    return sums.select(
        "*",
        (F.lit(tokens_all) - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least")).alias("truncated_total"),
        ((F.lit(docs_all) - F.col("docs_at_least") + F.col("n_docs")) / F.lit(docs_all or 1)).alias("share_up_to"),
    )


def truncated_totals(histogram: DataFrame, limits: list[int]) -> dict[int, int]:
    """For each context limit the tokens left when every document is cut to it, from a histogram, in one aggregate."""
    sums = [F.sum(F.least(F.col("n_tokens"), F.lit(limit)) * F.col("n_docs")).alias(str(limit)) for limit in limits]
    row = histogram.agg(*sums).first() if limits else []
    return {limit: row[i] or 0 for i, limit in enumerate(limits)}


def quantiles(histogram: DataFrame, shares: list[float]) -> dict[float, int | None]:
    """For each share the smallest length that so large a share of documents does not exceed."""
    lengths = [F.min(F.when(F.col("share_up_to") >= share, F.col("n_tokens"))) for share in shares]
    row = histogram.agg(*lengths).first() if shares else []
    return {share: row[i] for i, share in enumerate(shares)}
