"""Operator 9, n-gram Jaccard join: exact links between shingle sets, found through prefixes under several token orders.

Two sets of a and b tokens whose similarity reaches the threshold share at least o = ceil(t / (1 + t) * (a + b)) tokens, so
under any order of all tokens the first a - o + 1 of one and the first b - o + 1 of the other share one. A pair is a
candidate only if that holds under every one of several orders. All orders put rare tokens first: a token that a single
set holds takes up a place of the prefix and matches nothing, which leaves ordinary texts without any candidate.

A first pass finds the sets that can have a link at all: it counts a fixed share of the token space (those with a small
hash; every set sends all it holds of them, and as many more as its prefix is long), and a set whose prefix is made of
tokens that nobody else sent is done. The second pass counts all tokens of the sets that are left, which are few.

Equal sets are one class. Only what can change the answer is verified: first every class against one central class that
shares most of its prefix; then, exactly, all candidate pairs that these links have left in different components.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapdelta.llm.common import ascii_lower, free_name, if_small, kept, row_key, scratch, words
from snapdelta.llm.graph import components

ORDERS = 3
#: Columns of the result; a column of the documents with such a name is replaced.
RESULTS = ("n_shingles", "component_id")
#: Share of the token space that the first pass counts: so many times 1 - threshold, and so much more.
COUNTED, COUNTED_MORE = 1.2, 0.1


def shingle_set(of: Column, k: int) -> Column:
    """Sorted distinct hashes of the k-word shingles of an array of words; fewer words are one shingle, none are none."""
    size = F.size(of)
    hashes = F.transform(F.sequence(F.lit(0), size - k), lambda i: F.xxhash64(*(of[i + j] for j in range(k))))
    return F.when(size >= k, F.sort_array(F.array_distinct(hashes))).when(size > 0, F.array(F.xxhash64(of))).otherwise(F.array().cast("array<bigint>"))


def _needed(n: Column, percent: int) -> Column:
    """Tokens that a set of n shares with any set linked to it: ceil(percent * n / 100)."""
    return F.floor((n * percent + 99) / 100).cast("long")


def _overlap(a: Column, b: Column, percent: int) -> Column:
    return F.floor(((a + b) * percent + 99 + percent) / (100 + percent)).cast("long")


def signatures(docs: DataFrame, k: int, percent: int, text: str) -> DataFrame:
    """Per row: size of the set, two hashes of the whole set, the tokens sent to the index. Kept as a table, without texts."""
    below = int(-(2**63) + min(1.0, COUNTED * (1 - percent / 100) + COUNTED_MORE) * 2**64) - 1
    ids = [c for c in docs.columns if c != text]
    row = row_key(ids, text, RESULTS)
    worded = docs.select(*ids, row.alias("_row"), words(ascii_lower(F.col(text))).alias("_w"))
    sets = worded.select(*ids, "_row", shingle_set(F.col("_w"), k).alias("_set"))
    n = F.size("_set").cast("long")
    sent = F.greatest(n - _needed(n, percent) + 1, F.size(F.filter("_set", lambda x: x <= below)).cast("long"))
    return kept(
        sets.select(
            *ids, "_row", n.alias("n_shingles"),
            F.xxhash64("_set").alias("_c1"), F.xxhash64(F.lit(percent), "_set").alias("_c2"),
            F.slice("_set", 1, F.when(n > 0, sent).otherwise(0).cast("int")).alias("_sent"),
        ),
        "jaccard-sets",
        result=True,
    )


def classes_of(signed: DataFrame) -> DataFrame:
    """One row per distinct non-empty set, numbered."""
    grouped = signed.where("n_shingles > 0").groupBy("_c1", "_c2").agg(
        F.min(F.struct("n_shingles", "_row")).alias("_m"), F.first("_sent").alias("_sent")
    )
    numbered = grouped.select("_c1", "_c2", F.col("_m.n_shingles").alias("n"), F.col("_m._row").alias("_row"), "_sent")
    return kept(numbered.withColumn("cls", F.monotonically_increasing_id()), "jaccard-classes")


def _shared(tokens: DataFrame) -> DataFrame:
    """Tokens that several classes hold, with the number of classes."""
    return tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")


def _prefix_length(percent: int) -> Column:
    return F.col("n") - _needed(F.col("n"), percent) + 1


def open_classes(classes: DataFrame, percent: int) -> DataFrame:
    """``cls, _row, _c1`` of the classes that can have a link: not all of their prefix is theirs alone.

    The order is that of the tokens sent, those held once first. Tokens beyond the counted share are only sent by sets
    that need them to fill the prefix; all that such a set sent is its prefix.
    """
    tokens = classes.select("cls", F.explode("_sent").alias("token"))
    held = tokens.join(_shared(tokens), "token").groupBy("cls").agg(F.count("*").alias("_held"))
    sent = classes.select("cls", "n", "_row", "_c1", F.size("_sent").alias("sent")).join(held, "cls")
    return kept(sent.where(F.col("sent") - F.col("_held") < _prefix_length(percent)).select("cls", "_row", "_c1"), "jaccard-open")


def prefixes_of(sets: DataFrame, percent: int) -> DataFrame:
    """``cls, n, rare`` (tokens that no other class holds) and per order an array (token, place): the prefix behind those."""
    tokens = sets.select("cls", F.explode("_set").alias("token"))
    found = tokens.join(_shared(tokens), "token").groupBy("cls").agg(F.collect_list(F.struct("token", F.floor(F.log2("df")).alias("band"))).alias("_t"))
    sized = sets.select("cls", F.size("_set").cast("long").alias("n")).join(found, "cls")
    sized = sized.withColumn("rare", F.col("n") - F.size("_t")).withColumn("_left", (_prefix_length(percent) - F.col("rare")).cast("int"))

    def ordered(number: int) -> Column:
        by = F.sort_array(F.transform("_t", lambda x: F.struct(x["band"].alias("band"), F.xxhash64(F.lit(number), x["token"]).alias("by"), x["token"].alias("token"))))
        return F.transform(F.slice(by, 1, F.col("_left")), lambda x, i: F.struct(x["token"].alias("token"), (F.col("rare") + i + 1).alias("place")))

    orders = [ordered(number).alias(f"order_{number}") for number in range(ORDERS)]
    return kept(sized.where("_left > 0").select("cls", "n", "rare", *orders), "jaccard-prefixes")


def _postings(prefixes: DataFrame, number: int, *more: str) -> DataFrame:
    return prefixes.select("cls", "n", *more, F.explode(f"order_{number}").alias("_p")).select("cls", "n", *more, "_p.*")


def _can_link(percent: int, a: str = "a", b: str = "b") -> Column:
    """The length filter and the prefix filter of the pair's own lengths."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    need = _overlap(na, nb, percent)
    return (
        (100 * F.least(na, nb) >= percent * F.greatest(na, nb))
        & (F.col(f"{a}.place") <= na - need + 1)
        & (F.col(f"{b}.place") <= nb - need + 1)
    )


def star_pairs(prefixes: DataFrame, percent: int) -> DataFrame:
    """Each class with one other: of the most central classes of its posting lists (those with the fewest unique tokens for
    their size), the one that leads most of them."""
    posted = _postings(prefixes, 0, "rare")
    central = posted.groupBy("token").agg(
        F.min_by(F.struct("cls", "n", "place"), F.struct((F.col("rare") / F.col("n")).alias("r"), "n", "cls")).alias("_m"), F.count("*").alias("_size")
    ).where("_size > 1").select("token", "_m.*")
    joined = posted.alias("a").join(central.alias("b"), "token").where("a.cls <> b.cls").where(_can_link(percent))
    led = joined.select(F.col("a.cls").alias("a"), F.col("b.cls").alias("b")).groupBy("a", "b").agg(F.count("*").alias("lists"))
    best = led.groupBy("a").agg(F.max_by("b", F.struct("lists", "b")).alias("b"))
    return under_all_orders(best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), prefixes, percent)


def under_all_orders(pairs: DataFrame, prefixes: DataFrame, percent: int) -> DataFrame:
    """Pairs found under the first order that share a prefix token under every other one, too."""
    orders = [f"order_{number}" for number in range(1, ORDERS)]
    left = prefixes.select(F.col("cls").alias("a"), F.col("n").alias("na"), *(F.col(o).alias(f"a_{o}") for o in orders))
    right = prefixes.select(F.col("cls").alias("b"), F.col("n").alias("nb"), *(F.col(o).alias(f"b_{o}") for o in orders))
    need = _overlap(F.col("na"), F.col("nb"), percent)

    def prefix(order: str, n: str) -> Column:
        return F.transform(F.filter(order, lambda x: x["place"] <= F.col(n) - need + 1), lambda x: x["token"])

    shared = (F.arrays_overlap(prefix(f"a_{o}", "na"), prefix(f"b_{o}", "nb")) for o in orders)
    return pairs.join(left, "a").join(right, "b").where(reduce(Column.__and__, shared)).select("a", "b")


def open_pairs(prefixes: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """All candidate pairs in different components: they share a prefix token under every order.

    Lists within one component are dropped by an aggregate. In the others one side of a pair lies outside the list's
    largest component, so a large group that is already linked is never paired with itself.
    """
    placed = prefixes.join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    placed = kept(placed, "jaccard-placed")

    def pairs(number: int) -> DataFrame:
        posted = _postings(placed, number, "root")
        sizes = posted.groupBy("token", "root").agg(F.count("*").alias("_size"))
        mixed = sizes.groupBy("token").agg(F.max_by("root", F.struct("_size", "root")).alias("main"), F.count("*").alias("_roots")).where("_roots > 1")
        lists = posted.join(mixed.select("token", "main"), "token")
        few, every = lists.where("root <> main").alias("a"), lists.alias("b")
        apart = (F.col("a.root") != F.col("b.root")) & ((F.col("b.root") == F.col("b.main")) | (F.col("a.cls") < F.col("b.cls")))
        joined = few.join(every, (F.col("a.token") == F.col("b.token")) & apart & _can_link(percent))
        return joined.select(F.least("a.cls", "b.cls").alias("a"), F.greatest("a.cls", "b.cls").alias("b"), F.lit(1 << number).alias("order"))

    united = reduce(DataFrame.unionByName, (pairs(number) for number in range(ORDERS)))
    return united.groupBy("a", "b").agg(F.bit_or("order").alias("orders")).where(F.col("orders") == (1 << ORDERS) - 1).select("a", "b")


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets reach the threshold; ``sets``: cls and whole shingle set. Only sets of the pairs are moved."""
    pairs = kept(pairs, "jaccard-pairs")
    named = kept(pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct(), "jaccard-named")
    sets = sets.join(if_small(named, 8), "cls", "left_semi")
    left = pairs.join(sets.select(F.col("cls").alias("a"), F.col("_set").alias("_x")), "a")
    both = left.join(sets.select(F.col("cls").alias("b"), F.col("_set").alias("_y")), "b")
    same = F.size(F.array_intersect("_x", "_y"))
    return both.where(100 * same >= percent * (F.size("_x") + F.size("_y") - same)).select("a", "b")


def _whole_sets(docs: DataFrame, signed: DataFrame, rows: DataFrame, k: int, text: str) -> DataFrame:
    """``cls, _set`` of the classes in ``rows``, from the text of the row that stands for each."""
    keyed = docs.select(row_key(docs.columns, text, RESULTS).alias("_row"), text)
    # Where the rows are few their texts are picked out while reading; else both sides are shuffled.
    few = if_small(rows, 24)
    shingled = keyed.join(few, "_row").select("cls", "_c1", words(ascii_lower(F.col(text))).alias("_w"))
    sets = shingled.select("cls", "_c1", shingle_set(F.col("_w"), k).alias("_set")).withColumn("_h", F.xxhash64("_set"))
    repeated = signed.select("_row").join(few.select("_row"), "_row").groupBy("_row").agg(F.count("*").alias("n"))
    if not repeated.where("n > 1").isEmpty():
        sets = sets.dropDuplicates(["cls", "_h"])
    # A row with an equal hash but another set goes; compared after the table is written, or the test would be evaluated per word.
    return kept(sets, "jaccard-verify").where("_h = _c1").select("cls", "_set")


def jaccard_groups(docs: DataFrame, k: int = 5, percent: int = 80, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """All columns of ``docs`` but the text, with ``n_shingles`` (size of the set), ``component_id`` (smallest id reachable
    by links, itself included), and ``_row``, ``_group``: hash of the row, number of its group.

    Words are split at white space and A-Z lower-cased; a set holds the distinct k-word shingles; sets link when they share
    at least ``percent`` per cent of their union. A null or empty text has size 0, no links, no group and its own id.
    Repeated rows are linked. A null id counts as larger than any other. An empty table stays empty. Columns with the names of the results are
    replaced. Sets are compared by 64-bit hashes of shingles, classes by 128 bits.
    """
    plain = docs.select(*(c for c in docs.columns if c not in RESULTS and not c.startswith("_")))
    with scratch(docs.sparkSession):
        signed = signatures(plain, k, percent, text)
        classes = classes_of(signed)
        sets = _whole_sets(plain, signed, open_classes(classes, percent), k, text)
        prefixes = prefixes_of(sets, percent)
        first = kept(linked(star_pairs(prefixes, percent), sets, percent), "jaccard-links")
        rest = kept(linked(open_pairs(prefixes, components(first), percent), sets, percent), "jaccard-links")
        roots = components(first.unionByName(rest))
        named = classes.select("_c1", "_c2", "cls").join(roots.withColumnRenamed("node", "cls"), "cls", "left")
        named = named.select("_c1", "_c2", F.coalesce("root", "cls").alias("_group"))
        smallest = (
            signed.where("n_shingles > 0").groupBy("_c1", "_c2").agg(F.min(doc_id).alias("_least"))
            .join(named, ["_c1", "_c2"])
        )
        by_group = smallest.groupBy("_group").agg(F.min("_least").alias("component_id"))
        lookup = kept(named.join(by_group, "_group"), "jaccard-groups", result=True)
    out = signed.drop("_sent").join(lookup, ["_c1", "_c2"], "left")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col(doc_id))
    group = F.when(F.col("n_shingles") > 0, F.col("_group"))
    return out.withColumn("component_id", own).withColumn("_group", group).drop("_c1", "_c2")


def one_per_group(docs: DataFrame, k: int = 5, percent: int = 80, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each group: the one with the smallest id, then the smallest row hash. Rows without a word stay.

    Texts move only for the rows that go and for rows that occur twice with id and text.
    """
    columns = docs.columns
    with scratch(docs.sparkSession):
        grouped = kept(jaccard_groups(docs, k, percent, text, doc_id).where("n_shingles > 0").select(doc_id, "_row", "_group"), "near-groups")
        stays = grouped.groupBy("_group").agg(F.min(F.struct(F.col(doc_id).isNull(), doc_id, "_row")).alias("_m")).select(F.col("_m._row").alias("_row"), F.lit(True).alias("_stays"))
        rows = grouped.groupBy("_row").agg(F.count("*").alias("_times")).join(stays, "_row", "left")
        marked = kept(rows.where("_stays is null or _times > 1"), "near-rows", result=True)
    key = free_name(columns)
    keyed = docs.withColumn(key, row_key(columns, text, RESULTS))
    marked = marked.withColumnRenamed("_row", key)
    rest = keyed.join(marked, key, "left_anti")
    twice = keyed.join(marked.where("_stays").select(key), key, "left_semi").dropDuplicates([key])
    return rest.unionByName(twice).select(*columns)
