"""Operator 2, personal data: fixed patterns give seeds, contexts learned from them find identifiers the patterns miss.

Bootstrapping: every identifier-like piece of a text is an instance, the words around it are its patterns. An instance that
a fixed pattern accepts is a seed. A pattern's confidence is the share of its distinct instances that are believed, an
instance's belief is what its patterns say together; a few rounds over that graph carry belief from seeds to instances in
the same contexts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapdelta.llm.common import kept, span_texts, with_matches

#: Possessive repeats and the look-behind (or the end of the match before) keep a scan linear; the matches are those of
#: the plain patterns, since a leftmost match can only begin where a run of its characters begins.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
#: Tokens with a digit or an at sign, and tokens after them that begin like a number.
IDENTIFIER = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+(?:\x20[(+-]?[0-9][^\x20\x09-\x0D]*+)*+"

ROUNDS, BELIEVED, LEAST_SEEDS, LEAST_DIGITS = 3, 0.8, 2, 6
CONTEXT_CHARS = 80


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def accepted(kind: str, match: Column) -> Column:
    """Whether a match of a fixed pattern is kept."""
    n = F.length(digits(match))
    return {
        "email": F.lit(True),
        "ip": match.rlike(rf"^{BYTE}\.{BYTE}\.{BYTE}\.{BYTE}$"),
        "card": F.when(n.between(16, 19), F.call_function("luhn_check", digits(match))).otherwise(False),
        "phone": n.between(8, 15),
    }[kind]


def seed_kind(piece: Column) -> Column:
    """The fixed kind found inside an identifier-like piece, or null."""
    number = F.regexp_extract(piece, CARD, 0)
    return (
        F.when(piece.rlike(EMAIL), "email")
        .when(piece.rlike(IP), "ip")
        .when(piece.contains("+") & piece.rlike(PHONE), "phone")
        .when(accepted("card", number), "card")
    )


def shaped(kind: Column, value: Column) -> Column:
    """Whether a value that contexts speak for can be of their kind at all: contexts of addresses also hold other numbers."""
    n, letters = F.length(digits(value)), value.rlike("[A-Za-z]")
    return (
        F.when(kind == "email", value.contains("@") | (letters & value.rlike(r"[.(\[{]") & (n >= LEAST_DIGITS)))
        .when(kind == "ip", value.rlike(r"^[^0-9A-Za-z]*[0-9]+(?:[^0-9A-Za-z]+[0-9]+){3}[^0-9A-Za-z]*$") & (n >= LEAST_DIGITS))
        .when(kind == "card", ~letters & n.between(12, 19))
        .when(kind == "phone", ~letters & n.between(LEAST_DIGITS, 15))
        .otherwise(False)
    )


def fixed_spans(docs: DataFrame, text: str = "text", context_chars: int = CONTEXT_CHARS) -> DataFrame:
    """Adds arrays of spans ``email``, ``ip``, ``card``, ``phone`` and of contexts ``_pieces``; drops the text."""
    t = F.col(text)
    kinds = {
        "email": (t.contains("@"), EMAIL),
        "ip": (t.rlike(r"[0-9]\.[0-9]"), IP),
        "card": (t.rlike(r"(?:[0-9][\x20-]?){15}[0-9]"), CARD),
        "phone": (t.contains("+"), PHONE),
    }
    found = with_matches(docs, kinds, text)
    for kind in KINDS:
        found = found.withColumn(kind, F.filter(kind, lambda s: accepted(kind, s["match"])))
    found = with_matches(found, {"_pieces": (t.rlike("[0-9@]"), IDENTIFIER)}, text, context_chars)
    bare = lambda s: F.regexp_replace(s["match"], r"[.,;:!?)\"']++$", "")
    pieces = F.transform(
        "_pieces",
        lambda s: F.struct(
            s["start"].alias("start"),
            (s["start"] + F.length(bare(s))).alias("end"),
            bare(s).alias("value"),
            F.lower(F.regexp_extract(s["before"], r"([^\x20\x09-\x0D]+)[\x20\x09-\x0D]+([^\x20\x09-\x0D]+)[\x20\x09-\x0D]+$", 1)).alias("second"),
            F.lower(F.regexp_extract(s["before"], r"([^\x20\x09-\x0D]+)[\x20\x09-\x0D]+$", 1)).alias("first"),
            F.lower(F.regexp_extract(s["after"], r"^[^\x20\x09-\x0D]*[\x20\x09-\x0D]+([^\x20\x09-\x0D]+)", 1)).alias("next"),
        ),
    )
    key = F.xxhash64(t)
    return found.withColumn("_pieces", pieces).withColumn("_key", key).drop(text)


def believed_values(pieces: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``value, kind, belief`` of unseen identifiers. ``pieces``: value and its words around, one row per occurrence.

    Edges of the graph are distinct, and sums over a pattern or a value combine before they are shuffled, so one context
    that surrounds a third of all instances costs no more than others.
    """
    # A piece at a text's end or beside another piece has no word there, which is no evidence but one pattern of very many.
    patterns = F.array_compact(
        F.array(
            F.when(F.col("first") != "", F.concat_ws(" ", F.lit("L"), "second", "first")),
            F.when((F.col("first") != "") & (F.col("next") != ""), F.concat_ws(" ", F.lit("M"), "first", F.lit("_"), "next")),
        )
    )
    edges = kept(
        pieces.where("value <> ''").select("value", F.explode(patterns).alias("pattern")).distinct(), "pii-edges"
    ).withColumn("seed", seed_kind(F.col("value")))
    size = edges.groupBy("pattern").agg(F.count("*").alias("instances"))
    belief = edges.where("seed is not null").select("value", F.col("seed").alias("kind"), F.lit(1.0).alias("belief")).distinct()
    for _ in range(rounds):
        held = edges.join(belief.where(F.col("belief") >= BELIEVED), "value").groupBy("pattern", "kind").agg(
            F.sum("belief").alias("belief"), F.count("*").alias("held")
        )
        confidence = held.where(F.col("held") >= LEAST_SEEDS).join(size, "pattern").select(
            "pattern", "kind", (F.col("belief") / (F.col("instances") + 1)).alias("confidence")
        )
        unseen = (
            edges.where("seed is null")
            .join(confidence, "pattern")
            .groupBy("value", "kind")
            .agg((1 - F.exp(F.sum(F.log(1 - F.col("confidence"))))).alias("belief"))
        )
        seeds = edges.where("seed is not null").select("value", F.col("seed").alias("kind"), F.lit(1.0).alias("belief")).distinct()
        belief = kept(seeds.unionByName(unseen), "pii-belief")
    found = belief.where((F.col("belief") >= BELIEVED) & seed_kind(F.col("value")).isNull() & shaped(F.col("kind"), F.col("value")))
    return found.groupBy("value").agg(F.max_by("kind", F.struct("belief", "kind")).alias("kind"), F.max("belief").alias("belief"))


def personal_data(docs: DataFrame, text: str = "text", rounds: int = ROUNDS, context_chars: int = CONTEXT_CHARS) -> DataFrame:
    """All columns of ``docs`` but the text, with arrays of spans ``email``, ``ip``, ``card``, ``phone`` (start, end, match)
    and ``context`` (start, end, kind, belief): identifiers found by their contexts alone, of a shape that fits the kind.
    Patterns are made of words among the ``context_chars`` characters on each side, of a longer word of what lies in them.

    Null and empty texts have empty arrays. Spans of a kind never overlap. Repeated rows get equal results; a null id is an
    id like others. An empty table gives an empty table. Columns with the names of the results are replaced.
    """
    ids = [c for c in docs.columns if c not in (text, *KINDS, "context", "_pieces", "_key")]
    spans = kept(fixed_spans(docs.select(*ids, text), text, context_chars), "pii-spans")
    pieces = spans.select(*ids, "_key", F.explode("_pieces").alias("p")).select(*ids, "_key", "p.*")
    found = believed_values(pieces, rounds)
    placed = (
        pieces.join(found, "value")
        .groupBy(*ids, "_key")
        .agg(F.sort_array(F.collect_set(F.struct("start", "end", "kind", "belief"))).alias("context"))
    )
    keys = (*ids, "_key")
    right = placed.select(*(F.col(c).alias(f"_of_{c}") for c in keys), "context")
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in keys))
    joined = spans.join(right, same, "left").select(*ids, *KINDS, "context")
    none = F.array().cast("array<struct<start:bigint,end:bigint,kind:string,belief:double>>")
    return joined.withColumn("context", F.coalesce("context", none))


def all_span_texts() -> tuple[Column, Column]:
    """The fixed spans and those from contexts, each as ``kind:start:end``."""
    fixed = F.concat(*(span_texts(kind, F.col(kind)) for kind in KINDS))
    more = F.transform("context", lambda s: F.concat_ws(":", F.concat(F.lit("context_"), s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
    return fixed, more
