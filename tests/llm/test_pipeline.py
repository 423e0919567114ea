import duckdb

import __spark_entry__
import corpus_pipeline
from tallyhouse.llm import quality
from tests.conftest import SF
from tests.llm import test_decontam, test_lines, test_quality, test_sentencepieces, test_simhash
from tests.llm.test_sentencepieces import vocabulary  # noqa: F401  a fixture


def passes(text):
    n_words, chars, symbols, dup_lines, repeated = test_quality.brute(text)
    n_lines = sum(bool(x.strip(" \t\n\x0b\x0c\r")) for x in (text or "").split("\n"))
    return not (
        n_words < 50 or 100 * repeated > 50 * n_words or 2 * symbols > n_words or 100 * dup_lines > 50 * n_lines
        or chars < 2 * n_words or chars > 20 * n_words
    )


def one_of_each(rows):
    prints = [(i, test_simhash.fingerprint(t)) for i, t in rows]
    ids = test_simhash.brute_components(prints)
    return [r for r, c in zip(rows, ids, strict=True) if r[0] == c]


def test_pipeline_against_brute_force(spark, vocabulary):  # noqa: F811
    con = duckdb.connect()
    rows = con.execute(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    items = con.execute(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    rows = [r for r in rows if passes(r[1])]
    rows = [(i, t) for i, t, _, _ in test_lines.brute([(i + 1, t) for i, t in rows], 10)]
    rows = one_of_each([(i - 1, t) for i, t in rows])
    dirty = {i for i, *_, hit in test_decontam.brute(rows, items) if hit}
    want = {i: test_sentencepieces.brute(vocabulary, t) for i, t in rows if i not in dirty}
    got = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want and len(want) > 50


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, empty, SF)
        assert out.dtypes == docs.dtypes and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, empty, SF).count() == 0


def test_every_operator_is_registered(spark):
    names = __spark_entry__.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= set(names)


def test_quality_query_covers_its_policies(spark):
    rows = __spark_entry__.queries()["op1_quality_rules"](spark, SF)
    assert rows.filter("kept AND base_failed").count() == 0
    table = quality.ablations(rows, (quality.BASE, quality.STANDARD)).collect()
    assert {r.policy for r in table} == {"base", "standard"} and all(r.n_docs == rows.count() for r in table)
