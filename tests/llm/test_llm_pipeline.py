"""The pipeline against brute force; registered queries against their SQL."""

import duckdb
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from cinelake.llm.block_naming import normalised
from cinelake.llm.oracle import SQL
from cinelake.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.helpers import copies, documents, jaccard_components


def test_all_queries_are_registered():
    names = set(entry.queries())
    assert {n.split("_")[0] for n in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= names and set(SQL) <= set(entry.oracle_sql())
    assert 4 <= len(pipeline.STAGES) <= 5


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_equals_its_sql(spark, key):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    want = con.execute(SQL[key])
    columns = sorted(d[0] for d in want.description)
    order = [[d[0] for d in want.description].index(c) for c in columns]
    rows = sorted((tuple(r[i] for i in order) for r in want.fetchall()), key=str)
    got = sorted((tuple(r) for r in QUERIES[key](spark, SF_SMALL).select(*columns).collect()), key=str)
    assert got == rows


def test_stages_keep_columns_and_decide_as_brute_force(spark):
    rows = [(i, t) for i, t in copies(9, 20)] + [(900, "123 456"), (901, None)]
    docs = documents(spark, rows)
    text = dict(rows)
    step = {name: function for name, function in pipeline.STAGES}

    def run(name, df):
        out = step[name](spark, df, "")
        assert out.columns == df.columns and out.dtypes == df.dtypes
        return out, [r.doc_id for r in out.select("doc_id").collect()]

    after, ids = run("language_id", docs)
    assert set(ids) == {i for i, t in rows if t and any(c.isalpha() for c in t)}
    after, ids = run("exact_dedup", after.unionByName(after))
    norm = {r.doc_id: r.n for r in docs.select("doc_id", normalised(docs["text"]).alias("n")).collect()}
    groups = {}
    for i in sorted(norm):
        if text[i] and any(c.isalpha() for c in text[i]):
            groups.setdefault(norm[i], i)
    assert sorted(ids) == sorted(groups.values())
    after, kept = run("near_dedup", after)
    found = jaccard_components([(i, text[i]) for i in ids], 5, 80)
    assert sorted(kept) == sorted(i for i, (_, c) in found.items() if c == i)
    after, ids = run("source_mix", after)
    assert set(ids) <= set(kept) and max(ids.count(i) for i in set(ids)) <= 2
    out = step["bpe"](spark, after, "").collect()
    library = Tokenizer.from_file(pipeline.public_tokenizers.path("word_bpe_49k.json"))
    assert sorted(r.doc_id for r in out) == sorted(ids)
    assert all(list(r.ids) == library.encode(text[r.doc_id], add_special_tokens=False).ids and r.n_tokens == len(r.ids) for r in out)


def test_run_reads_the_table_and_an_empty_one_passes(spark, scratch):
    spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0).write.parquet(f"{scratch}/documents.parquet")
    assert pipeline.run(spark, scratch).count() == 0
    out = pipeline.run(spark, SF_SMALL)
    assert out.columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"]
    assert 0 < out.count() <= 2 * spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
