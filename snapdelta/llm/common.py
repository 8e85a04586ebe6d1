"""Column helpers that several operators share: words, regex matches with their places, tables kept in the shared folder."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapdelta.sources.shared import remove, settle, shared_dir

#: The characters that separate words, as a regex class and as plain characters.
SPACE = r"[\x20\x09-\x0D]"
SPACES = " \t\n\x0b\f\r"
#: ASCII letters, for lower-casing A-Z alone.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What a table may take in memory to be sent to every executor.
BROADCAST_BYTES = 32 << 20
#: Elements that one running sum appends to before the next one starts.
CHUNK = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Folders of kept tables by the scopes they were made in, innermost last.
_SCOPES: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that ``kept`` makes inside are removed at the end, also after an error, but for those that are results: they
    belong to the scope around it, if there is one. What is returned must not read a removed table."""
    folders: list[str] = []
    entered = _SCOPES.set((*_SCOPES.get(), folders))
    try:
        yield
    finally:
        _SCOPES.reset(entered)
        for folder in folders:
            remove(spark, folder)


def kept(df: DataFrame, purpose: str, result: bool = False) -> DataFrame:
    """The frame as a table in the shared folder: computed once, lineage cut, still there when executors are lost. Removed with the
    ``scratch`` it was made in; ``result``: with the one around that. Outside of any, it stays."""
    folder = shared_dir(df.sparkSession, purpose)
    scopes = _SCOPES.get()[: -1 if result else None]
    if scopes:
        scopes[-1].append(folder)
    return settle(df, folder)


def if_small(table: DataFrame, row_bytes: int, most: int = BROADCAST_BYTES) -> DataFrame:
    """A kept table marked for broadcast if its counted rows take at most so many bytes, else as it is."""
    return F.broadcast(table) if table.count() * row_bytes <= most else table


def row_key(columns: list[str], text: str, replaced: tuple[str, ...] = ()) -> Column:
    """A hash of a row's ids and text that an operator and its callers share: columns that the operator drops or replaces
    (``replaced``, and names that begin with ``_``) are no part of it."""
    return F.xxhash64(*(F.col(c) for c in columns if c.endswith("_id") and c not in replaced and not c.startswith("_")), F.col(text))


def free_name(columns: list[str], name: str = "_row") -> str:
    """The name, longer by underscores until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """Words in order; an empty array for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{SPACE}+"), "")


def word_count(text: Column) -> Column:
    """The number of words, without an array of them that outlives the expression."""
    return F.size(words(text)).cast("long")


def running_total(values: Column) -> Column:
    """Sums of the elements before each one, and of all at the end (one element more than the input). Give a column of longs.

    Appending copies an array, so sums run over chunks first and over the chunks' totals then.
    """

    def sums(of: Column) -> Column:
        return F.aggregate(
            of, F.array(F.lit(0).cast("long")), lambda so_far, x: F.array_append(so_far, F.element_at(so_far, -1) + x)
        )

    chunks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(values) - 1) / CHUNK).cast("int")),
        lambda c: sums(F.slice(values, c * CHUNK + 1, CHUNK)),
    )
    totals = sums(F.transform(chunks, lambda c: F.element_at(c, -1)))
    shifted = F.flatten(
        F.zip_with(
            chunks,
            F.slice(totals, 1, F.size(chunks)),
            lambda c, before: F.transform(F.slice(c, 1, F.size(c) - 1), lambda x: x + before),
        )
    )
    return F.when(F.size(values) == 0, F.array(F.lit(0).cast("long"))).otherwise(
        F.concat(shifted, F.array(F.element_at(totals, -1)))
    )


MATCHES = "array<struct<start:bigint,end:bigint,match:string,before:string,after:string>>"


def with_matches(df: DataFrame, kinds: dict[str, tuple[Column, str]], text: str, around: int = 0) -> DataFrame:
    """Adds a column per kind: leftmost non-overlapping matches of a regex in column ``text``, with places in code points.

    ``kinds``: name to (condition under which a text can match at all, regex that never matches an empty string).
    The matches and the gaps between them come from two scans of a text, and running sums of their lengths are the
    places. ``around``: so many characters of the gaps before and after a match are kept with it. Null has no match.
    """
    for kind, (possible, regex) in kinds.items():
        parts = F.when(
            possible,
            F.struct(
                F.regexp_extract_all(text, F.lit(regex), F.lit(0)).alias("found"), F.split(text, regex, -1).alias("gaps")
            ),
        )
        df = df.withColumn(kind, parts)
        found, gaps = F.col(f"{kind}.found"), F.col(f"{kind}.gaps")
        lengths = F.flatten(F.zip_with(gaps, found, lambda g, m: F.array(F.length(g).cast("long"), F.coalesce(F.length(m), F.lit(0)).cast("long"))))
        # Lengths are a column of their own: as part of the expression below they would be taken anew for every chunk.
        df = df.withColumn(kind, F.when(F.size(found) > 0, F.struct(found.alias("found"), gaps.alias("gaps"), lengths.alias("lengths"))))
        found, gaps = F.col(f"{kind}.found"), F.col(f"{kind}.gaps")
        at = F.struct(found.alias("found"), gaps.alias("gaps"), running_total(F.col(f"{kind}.lengths")).alias("at"))
        df = df.withColumn(kind, F.when(F.col(kind).isNotNull(), at))
        found, gaps, at = F.col(f"{kind}.found"), F.col(f"{kind}.gaps"), F.col(f"{kind}.at")
        none = F.lit("")
        spans = F.transform(
            found,
            lambda m, i: F.struct(
                at[2 * i + 1].alias("start"),
                at[2 * i + 2].alias("end"),
                m.alias("match"),
                (F.right(gaps[i], F.lit(around)) if around else none).alias("before"),
                (F.left(gaps[i + 1], F.lit(around)) if around else none).alias("after"),
            ),
        )
        df = df.withColumn(kind, F.coalesce(spans, F.array().cast(MATCHES)))
    return df


def span_texts(kind: str, spans: Column) -> Column:
    """``kind:start:end`` of each span."""
    return F.transform(spans, lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))
