"""The registered queries against their SQL, and the pipeline against brute force."""

import re
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_point
import corpus_pipeline
from riskframe.llm import language, pii
from riskframe.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    cursor = con.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    order = [columns.index(c) for c in df.columns]
    assert Counter(map(tuple, df.collect())) == Counter(tuple(r[i] for i in order) for r in cursor.fetchall())


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry_point.queries()) and set(ORACLE) <= set(entry_point.oracle_sql())


def test_native_operators_run_no_python(spark):
    for name in ("op2_source_mix", "op4_license_scan"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


def expected_rows(documents, benchmark, model):
    """All stages but the language model written out plainly; the model's verdicts are given."""
    from test_dedup import linked_components
    from test_records import WORDS, alignments, mixed

    kept = [d for d in documents if model[d["doc_id"]]]
    smallest = {i: c for i, _, c in linked_components([(d["doc_id"], d["text"]) for d in kept])}
    kept = [d for d in kept if smallest[d["doc_id"]] == d["doc_id"]]
    grams = lambda t: {w for w in zip(*(re.findall(r"[a-z0-9\u0080-\U0010ffff]+", (t or "").lower())[i:] for i in range(5)))}
    items = [(t, grams(t)) for _, t in benchmark]

    def leaked(text):
        own = grams(text)
        for item, some in items:
            if own & some:
                n, need, _ = alignments(text, item)
                if n >= need:
                    return True
        return False

    kept = [d for d in kept if not leaked(d["text"])]
    kept = [d | {"text": pii.masked(d["text"])} for d in kept]
    kept = [d | {"n_chars": len(d["text"])} for d in kept]
    sizes, targets = mixed([(d["doc_id"], d["text"], d["source"]) for d in kept])
    return {d["doc_id"]: d | {"size": len(WORDS.findall(d["text"])), "source_size": sizes[d["source"]], "target": targets[d["source"]]} for d in kept}


def test_pipeline_against_brute_force(spark):
    documents = [r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    benchmark = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    model = {r.doc_id: r.lang_pred != "und" and r.score >= corpus_pipeline.LEAST_SCORE for r in language.identify(spark.read.parquet(f"{SF}/documents.parquet")).collect()}
    expected = expected_rows(documents, benchmark, model)
    got = {r.doc_id: r.asDict() for r in corpus_pipeline.run(spark, SF).collect()}
    assert got and set(got) <= set(expected)
    for i, row in got.items():
        taken = row.pop("taken")
        assert 0 < taken <= 3 * row["size"]
        assert row.pop("target") == pytest.approx(expected[i]["target"]) and row == {k: v for k, v in expected[i].items() if k != "target"}
    # What a source lacks of its target is less than a word.
    words = Counter()
    for r in corpus_pipeline.run(spark, SF).collect():
        words[r.source] += r.taken
    for source, target in {d["source"]: d["target"] for d in expected.values()}.items():
        assert target - 1 <= words[source] <= target + 1e-6


def test_pipeline_stages(spark, docs, no_docs, tmp_path):
    """Awkward rows pass every stage; all but the last return the columns of their input."""
    folder = str(tmp_path)
    spark.createDataFrame([(1, None), (2, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "ngram_join", "decontamination", "pii", "source_mix"]
    table = docs.withColumn("n_chars", docs["doc_id"])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, table, folder)
        assert out.columns == table.columns and out.count() > 10, name
        assert stage(spark, no_docs.withColumn("n_chars", no_docs["doc_id"]), folder).collect() == []
    last = corpus_pipeline.STAGES[-1][1]
    assert {*table.columns, "size", "source_size", "target", "taken"} == set(last(spark, table, folder).columns)
    assert last(spark, no_docs, folder).collect() == []


def test_language_stage_keeps_clean_documents(spark, docs, rows):
    kept = corpus_pipeline.identify_language(spark, docs.where("lang is null"), "").collect()  # nothing to learn from
    assert all(any(c.isalpha() for c in r.text) for r in kept) and len(kept) > 10
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert corpus_pipeline.identify_language(spark, table, "").count() == table.count()
