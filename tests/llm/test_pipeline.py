"""Every stage against a brute-force version, each on its own input."""

import re

import corpus_pipeline
from test_decontaminate import brute as contamination_of
from test_jaccard_join import brute as groups_of
from test_mixing import brute_targets
from test_secrets import PLAIN

from snapdelta.llm import quality_classifier as qc
from snapdelta.llm.common import kept, table

SF_DIR = "/root/testdata/sf0.001"


def test_stages_match_brute_force(spark):
    docs = table(spark, SF_DIR, "documents")
    bench = [(r.item_id, r.text) for r in table(spark, SF_DIR, "benchmark").collect()]
    columns, states = docs.columns, [sorted(docs.collect())]
    for name, stage in corpus_pipeline.STAGES:
        docs = kept(stage(spark, docs, SF_DIR), "test")
        states.append(sorted(docs.collect()))
        assert name == corpus_pipeline.STAGES[-1][0] or docs.columns == columns
    given, good, single, clean, masked, mixed = states

    model = qc.train(table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels"))
    marks = qc.scores(model, [qc.encode(r.text.encode() if r.text is not None else None) for r in given])
    assert good == [r for r, s in zip(given, marks) if s >= 0.3] and 0 < len(good) < len(given)

    groups = groups_of([r.text for r in good], 5, 80)
    assert single == [r for i, (r, (n, root)) in enumerate(zip(good, groups)) if root == i]

    assert clean == [r for r in single if not contamination_of(r.text, bench)[1]]

    assert [r.doc_id for r in masked] == [r.doc_id for r in clean]
    for before, after in zip(clean, masked):
        found = [m[0] for p, ok in PLAIN.values() for m in re.finditer(p, before.text, re.A) if ok(m)]
        assert (before.text == after.text) == (not found) and after.n_chars == len(after.text)
        assert not any(x in after.text for x in found)

    sizes = {}
    for r in masked:
        sizes[r.source] = sizes.get(r.source, 0) + len([x for x in re.split(r"[\x20\x09-\x0d]+", r.text) if x])
    targets = brute_targets(sizes)
    assert {r.doc_id for r in mixed} == {r.doc_id for r in masked}
    for source, size in sizes.items():
        rows = [r for r in mixed if r.source == source]
        assert {r.source_size for r in rows} == {size} and abs(rows[0].target - targets[source]) < 1e-6 * max(1, size)
        assert abs(sum(r.taken for r in rows) - targets[source]) <= 64 and all(0 <= r.taken <= 2 * r.size for r in rows)


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF_DIR)
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "text", "size", "source_size", "target", "taken"]
    assert out.where("text is not null and taken > 0").count() > 0


def odd_docs(spark):
    """Nulls, empty texts, repeats, ties; no ``n_chars``, and columns named like the operators' own."""
    long = " ".join(f"w{i}" for i in range(40))
    rows = [(1, None, None, 0.1, "x"), (2, "", "a", 0.2, "x"), (3, long, "a", 0.3, "x"), (4, long, "b", 0.4, "x"), (5, "password=abc123 token", "b", None, None)]
    rows += [(5, "password=abc123 token", "b", None, None), (None, "one more text", "b", 0.5, "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, score double, component_id string")


def test_stages_over_odd_tables(spark, tmp_path):
    """Each stage alone: columns stay, nothing clean goes, defined results for nulls and repeats; empty tables stay empty."""
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, None), (2, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = odd_docs(spark)
    stages = dict(corpus_pipeline.STAGES)
    out = {name: stage(spark, docs, str(tmp_path)) for name, stage in stages.items()}
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    given = rows(docs)
    for name in list(stages)[:-1]:
        assert out[name].columns == docs.columns
        assert stages[name](spark, docs.limit(0), str(tmp_path)).count() == 0
    assert rows(out["quality classifier"]) == given
    # Of the two equal texts the smaller id stays, of the repeated row one.
    assert sorted(r[0] or 0 for r in rows(out["near copies"])) == [0, 1, 2, 3, 5]
    assert rows(out["decontamination"]) == given
    masked = {(r["doc_id"], r["text"]) for r in out["secret scans"].collect()}
    assert (5, "[secret] token") in masked and (1, None) in masked and out["secret scans"].count() == len(given)
    mixed = out["source mixing"]
    assert mixed.count() == len(given) and {r["size"] for r in mixed.where("text is null or text = ''").collect()} == {0}
    assert set(mixed.columns) == {*docs.columns, "size", "source_size", "target", "taken"}
    assert stages["source mixing"](spark, docs.limit(0), str(tmp_path)).count() == 0
