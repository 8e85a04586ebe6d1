"""Operator 1, quality rules: one table of thresholds becomes one projection of ratios; no user function."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapdelta.llm.common import SPACE, SPACES, words

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
#: Frequent function words of English, German, French, Spanish, Italian and Portuguese.
STOP_WORDS = (
    "the of and to in a is that it on for was with as be at by this are from or an he not "
    "der die das und ist von den im mit ein eine zu für auf dem nicht des sich auch "
    "le la les et des un une est que qui pour dans pas sur au du de avec par en "
    "el los las y del se una con lo como su no es por para al "
    "il di che non per sono della una gli o e do da os na um uma"
).split()

#: Rule, measure, least and most allowed (None: open). The production thresholds.
RULES: tuple[tuple[str, str, float | None, float | None], ...] = (
    ("length", "n_words", 50, None),
    ("word_length", "chars_per_word", 2.0, 14.0),
    ("symbols", "symbols_per_word", None, 0.3),
    ("shouting", "marks_per_word", None, 0.5),
    ("stop_words", "stop_word_ratio", 0.02, None),
    ("repeated_lines", "dup_line_ratio", None, 0.5),
    ("repeated_words", "repeat_word_ratio", None, 0.5),
)
BASE_RULES = ("length", "repeated_words")


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds a struct ``_m`` with the counts of each text: words, their characters, symbols, marks, stop words, lines, lines
    equal to an earlier one, words inside repeated three-word windows. Null and empty texts have zeros everywhere.

    Repeats are found per text, by sorting its windows and comparing neighbours: n log n for a text of any length.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    stop = rf"(?i)(?<![^\x20\x09-\x0D])(?:{'|'.join(STOP_WORDS)})(?![^\x20\x09-\x0D])"
    spaceless = F.length(F.translate(t, SPACES, ""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(rf"[^\x20\x09-\x0D]"))
    first = docs.withColumn("_w", words(F.col(text))).withColumn(
        "_m",
        F.struct(
            spaceless.cast("long").alias("word_chars"),
            (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            (F.length(t) - F.length(F.translate(t, "!?", ""))).cast("long").alias("n_marks"),
            F.regexp_count(t, F.lit(stop)).cast("long").alias("n_stop"),
        ),
    )
    size = F.size("_w")
    window = F.when(
        size >= 4,
        F.sort_array(
            F.arrays_zip(
                F.slice("_w", 1, size - 2).alias("a"),
                F.slice("_w", 2, size - 2).alias("b"),
                F.slice("_w", 3, size - 2).alias("c"),
                F.sequence(F.lit(0), size - 3).alias("at"),
            )
        ),
    )
    second = first.withColumn("_n", size.cast("long")).withColumn("_w", window).withColumn("_l", lines)
    twice = F.filter(
        F.zip_with(
            "_w",
            F.slice("_w", 2, F.size("_w") - 1),
            lambda x, y: F.when(
                (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"]), F.array(x["at"], y["at"])
            ),
        ),
        lambda x: x.isNotNull(),
    )
    third = second.withColumn("_w", F.sort_array(F.array_distinct(F.flatten(twice)))).withColumn(
        "_l", F.struct(F.size("_l").alias("n"), F.size(F.array_distinct("_l")).alias("distinct"))
    )
    covered = F.aggregate(
        F.zip_with("_w", F.slice("_w", 2, F.greatest(F.size("_w") - 1, F.lit(0))), lambda x, y: F.coalesce(F.least(y - x, F.lit(3)), F.lit(3))),
        F.lit(0),
        lambda so_far, x: so_far + x,
    )
    counts = F.struct(
        F.col("_n").alias("n_words"),
        "_m.*",
        F.col("_l.n").cast("long").alias("n_lines"),
        (F.col("_l.n") - F.col("_l.distinct")).cast("long").alias("n_dup_lines"),
        F.when(F.size("_w") > 0, covered).otherwise(0).cast("long").alias("n_repeat_words"),
    )
    return third.withColumn("_m", counts).drop("_w", "_l", "_n")


def ratios(of: str = "_m") -> dict[str, Column]:
    """Measure name to column; a ratio over nothing is 0."""
    c = {name: F.col(f"{of}.{name}") for name in "n_words word_chars n_symbols n_marks n_stop n_lines n_dup_lines n_repeat_words".split()}
    per = lambda x, y: F.when(c[y] > 0, c[x] / c[y]).otherwise(F.lit(0.0))
    return {
        "n_words": c["n_words"],
        "chars_per_word": per("word_chars", "n_words"),
        "symbols_per_word": per("n_symbols", "n_words"),
        "marks_per_word": per("n_marks", "n_words"),
        "stop_word_ratio": per("n_stop", "n_words"),
        "dup_line_ratio": per("n_dup_lines", "n_lines"),
        "repeat_word_ratio": per("n_repeat_words", "n_words"),
    }


def quality_rules(docs: DataFrame, rules=RULES, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and a struct ``quality``: the counts, the ratios, the names of the rules a text fails, kept.

    A null or empty text counts as zero words and fails the length rule. Rows are judged one by one, so repeated rows get
    equal results and an empty table stays empty. A column named ``quality`` or beginning with ``_`` is replaced.
    """
    measured = measures(docs.drop("quality", "_m", "_w", "_l", "_n"), text)
    by_name = ratios()
    failed = []
    for rule, measure, least, most in rules:
        value = by_name[measure]
        bad = F.lit(False)
        if least is not None:
            bad = bad | (value < least)
        if most is not None:
            bad = bad | (value > most)
        failed.append(F.when(bad, F.lit(rule)))
    fails = F.array_compact(F.array(*failed))
    others = [v.alias(k) for k, v in by_name.items() if k != "n_words"]
    scored = measured.withColumn("quality", F.struct("_m.*", *others, fails.alias("failed")))
    return scored.withColumn("quality", F.col("quality").withField("kept", F.size("quality.failed") == 0)).drop("_m")
