"""Operator 5, secret scans: an inverted index of trigrams picks the texts that a rule's regex has to look at.

From each regex a Boolean query over trigrams is derived that every match satisfies. Postings of those trigrams are
intersected and united as the query says, and the regex runs over the candidates alone. A regex without a mandatory
trigram runs over all texts.
"""

from __future__ import annotations

import itertools
import re
from re import _constants as sre
from re import _parser as parser
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapdelta.llm.common import CHUNK, kept, with_matches


class Rule(NamedTuple):
    """A kind of secret. ``part``: the group whose length has to reach ``least``."""

    kind: str
    regex: str
    part: int = 0
    least: int = 0


#: Keywords match in either case. The first three are the base; the rest are public formats of credentials.
RULES = (
    Rule("assign", r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
    # A whole key: through the END line of the same label, to the end of the text where there is none.
    Rule("private_key", r"-----BEGIN ([A-Z ]*)PRIVATE KEY-----(?s:.*?)(?:-----END \1PRIVATE KEY-----|(?![\s\S]))"),
    Rule("hosting_token", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abps]-[A-Za-z0-9-]{10,}"),
    Rule("signed_token", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("url_login", r"://[^\x20\x09-\x0D:/@]+:[^\x20\x09-\x0D/@]+@"),
)
#: Strings that one stretch of a regex may stand for before the stretch is closed.
MOST_STRINGS = 48


def trigram_query(regex: str) -> frozenset[frozenset[str]] | None:
    """Alternatives, each a set of lower-case trigrams that all have to occur; None if nothing is mandatory."""
    stretches: list[set[str]] = []

    def strings(node) -> set[str] | None:
        """The strings that a node stands for, or None if there are many."""
        kind, value = node
        if kind is sre.LITERAL:
            return {chr(value).lower()}
        if kind is sre.SUBPATTERN:
            return sequence(value[3])
        if kind is sre.BRANCH:
            parts = [sequence(x) for x in value[1]]
            return None if None in parts else set().union(*parts)
        if kind is sre.IN:
            plain = all(k is sre.LITERAL for k, _ in value)
            return {chr(v).lower() for _, v in value} if plain and len(value) <= 8 else None
        if kind in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT) and value[1] <= 3:
            one = sequence(value[2])
            return None if one is None else {"".join(x) for n in range(value[0], value[1] + 1) for x in itertools.product(one, repeat=n)}
        return {""} if kind in (sre.AT, sre.ASSERT, sre.ASSERT_NOT) else None

    def sequence(nodes) -> set[str] | None:
        so_far = {""}
        for node in nodes:
            if (own := strings(node)) is None or len(so_far) * len(own) > MOST_STRINGS:
                return None
            so_far = {a + b for a in so_far for b in own}
        return so_far

    stretch = {""}
    for node in parser.parse(regex):
        own = strings(node)
        if own is None or len(stretch) * len(own) > MOST_STRINGS:
            stretches.append(stretch)
            stretch = own or {""}
        else:
            stretch = {a + b for a in stretch for b in own}
    stretches.append(stretch)
    told = [{frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in x} for x in stretches if min(map(len, x)) >= 3]
    if not told:
        return None
    whole = {frozenset().union(*choice) for choice in itertools.product(*told)}
    return frozenset(x for x in whole if not any(y < x for y in whole))


def trigram_index(docs: DataFrame, trigrams: list[str], text: str = "text") -> DataFrame:
    """Postings ``trigram, _row``: the texts (by hash of id and text) that hold a trigram, in any case. Kept as a table.

    Only trigrams that some rule asks for are indexed, over whole texts. Rows with equal ids and texts share postings; a
    clash of hashes can only add candidates.
    """
    lower = F.lower(text)
    held = F.array_compact(F.array(*(F.when(F.col("_t").contains(x), F.lit(x)) for x in trigrams)))
    hits = docs.withColumn("_t", lower).select("_row", F.explode(held).alias("trigram"))
    return kept(hits, "secret-postings")


def candidates(postings: DataFrame, wanted: dict[str, frozenset[frozenset[str]]]) -> DataFrame:
    """``_row`` and the kinds whose queries its postings satisfy."""
    by_row = postings.groupBy("_row").agg(F.collect_set("trigram").alias("has"))

    def satisfied(query: frozenset[frozenset[str]]) -> Column:
        every = [F.size(F.array_except(F.array(*map(F.lit, sorted(x))), "has")) == 0 for x in sorted(query, key=sorted)]
        out = every[0]
        for one in every[1:]:
            out = out | one
        return out

    kinds = F.array_compact(F.array(*(F.when(satisfied(q), F.lit(k)) for k, q in wanted.items())))
    return by_row.select("_row", kinds.alias("_kinds")).where(F.size("_kinds") > 0)


def with_candidates(docs: DataFrame, rules: tuple[Rule, ...], text: str) -> DataFrame:
    """Adds ``_kinds``: the kinds whose regex has to look at a text."""
    queries = {r.kind: trigram_query(r.regex) for r in rules}
    wanted = {k: q for k, q in queries.items() if q is not None}
    scans = F.array(*(F.lit(k) for k, q in queries.items() if q is None)).cast("array<string>")
    if not wanted:
        return docs.withColumn("_kinds", scans)
    row = F.xxhash64(*(c for c in docs.columns if c != text and c.endswith("_id")), text)
    keyed = docs.withColumn("_row", row)
    postings = trigram_index(keyed, sorted(set().union(*(x for q in wanted.values() for x in q))), text)
    chosen = kept(candidates(postings, wanted), "secret-candidates").withColumnRenamed("_kinds", "_some")
    joined = keyed.join(chosen, "_row", "left")
    return joined.withColumn("_kinds", F.concat(F.coalesce("_some", F.array().cast("array<string>")), scans)).drop("_row", "_some")


def _matches(df: DataFrame, rule: Rule, text: str) -> DataFrame:
    found = with_matches(df, {"_m": (F.array_contains("_kinds", rule.kind), rule.regex)}, text)
    if not rule.least:
        return found
    long_enough = lambda s: F.length(F.regexp_extract(s["match"], rule.regex, rule.part)) >= rule.least
    return found.withColumn("_m", F.filter("_m", long_enough))


def _with_spans(docs: DataFrame, rules: tuple[Rule, ...], text: str) -> DataFrame:
    """Adds ``_spans``: (start, order of the kind, end, kind, match) of every secret, by start, then order."""
    found = with_candidates(docs, rules, text)
    for order, rule in enumerate(rules):
        found = _matches(found, rule, text)
        spans = F.transform(
            "_m",
            lambda s: F.struct(
                s["start"].alias("start"), F.lit(order).alias("order"), s["end"].alias("end"), F.lit(rule.kind).alias("kind"), s["match"].alias("match")
            ),
        )
        found = found.withColumn(f"_s{order}", spans).drop("_m")
    each = [f"_s{order}" for order in range(len(rules))]
    return found.withColumn("_spans", F.sort_array(F.concat(*each))).drop(*each, "_kinds")


def secret_spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """All columns of ``docs`` but the text, and ``secrets``: spans (start, order of the kind, end, kind, match) by start, then
    kind as the rules list them.

    Null and empty texts have an empty array. Repeated rows get equal results, an empty table stays empty. A column named
    ``secrets`` or beginning with ``_`` is replaced.
    """
    found = _with_spans(docs.select(*(c for c in docs.columns if c != "secrets" and not c.startswith("_"))), rules, text)
    return found.withColumnRenamed("_spans", "secrets").drop(text)


def _masked(text: Column, spans: Column, mask: str) -> Column:
    """The text with a mask for every stretch that overlapping spans (by start) cover together.

    Four bytes a character, so that a place in the text is one in the bytes; the mark before a piece is the byte order's,
    which is not part of it.
    """

    def pieces(of: Column) -> Column:
        wide, found, reach = of["wide"], of["found"], of["reach"]
        piece = lambda start, length: F.decode(F.concat(F.unhex(F.lit("0000FEFF")), wide.substr((4 * start + 1).cast("int"), (4 * length).cast("int"))), "UTF-32")
        none = F.lit(0).cast("long")

        def of_chunk(c: Column) -> Column:
            return F.aggregate(
                F.slice(found, c * CHUNK + 1, CHUNK),
                F.struct(F.coalesce(F.array_max(F.slice(reach, F.lit(1), c)), none).alias("end"), F.array().cast("array<string>").alias("out")),
                lambda so_far, s: F.struct(
                    F.greatest(so_far["end"], s["end"]).alias("end"),
                    F.when((s["start"] >= so_far["end"]), F.array_append(so_far["out"], piece(so_far["end"], s["start"] - so_far["end"])))
                    .otherwise(so_far["out"]).alias("out"),
                ),
                lambda so_far: so_far["out"],
            )

        last = F.array_max(reach)
        between = F.flatten(F.transform(F.sequence(F.lit(0), F.size(reach) - 1), of_chunk))
        return F.array_join(F.concat(between, F.array(piece(last, F.length(wide) / 4 - last))), mask)

    # How far the spans of each chunk reach; appending copies an array, so pieces are gathered by chunks.
    chunks = F.sequence(F.lit(0), F.floor((F.size(spans) - 1) / CHUNK).cast("int"))
    reach = F.transform(chunks, lambda c: F.array_max(F.transform(F.slice(spans, c * CHUNK + 1, CHUNK), lambda s: s["end"])))
    # Through an array of one, so that the bytes are made once and not per span.
    whole = F.struct(F.encode(text, "UTF-32").alias("wide"), spans.alias("found"), reach.alias("reach"))
    return F.when(F.size(spans) > 0, F.transform(F.array(whole), pieces)[0]).otherwise(text)


def redact_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", mask: str = "[secret]") -> DataFrame:
    """``docs`` with every secret replaced. The spans are those of the text as given; what overlapping ones cover together is
    replaced as one. Null stays null."""
    found = _with_spans(docs, rules, text)
    return found.withColumn(text, _masked(F.col(text), F.col("_spans"), mask)).select(*docs.columns)


# A rule has to be readable by both regex engines.
for _rule in RULES:
    re.compile(_rule.regex)
