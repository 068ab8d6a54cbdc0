"""Each stage on the rows that the one before kept, against a plain version."""

import re

import duckdb

import __spark_entry__ as entry_module
import corpus_pipeline
from tagloom.llm import mixing, queries, toxicity
from tagloom.llm.common import stored, table

from .conftest import SF
from .test_simhash import plain as plain_fingerprint


def test_registered():
    built = entry_module.queries()
    assert set(queries.QUERIES) <= set(built) and "pipeline" in built
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14)) and set(queries.SQL) <= set(built)


def test_exact_dedup_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    order = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    expected = con.sql(queries.SQL["op8_exact_dedup"]).df()[order].sort_values("doc_id").values.tolist()
    got = queries.QUERIES["op8_exact_dedup"](spark, SF).toPandas()[order].sort_values("doc_id").values.tolist()
    assert got == expected


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = stored(stage(spark, docs, SF), f"test-{name}")
        after = docs.collect()
        texts = {r["doc_id"]: r["text"] for r in before}
        if name == "toxicity":
            model = toxicity.train(table(spark, SF, "documents"), table(spark, SF, "labels"))
            assert sorted(after) == sorted(r for r in before if model.severity(r["text"]) < model.cut)
        elif name == "exact_dedup":
            last = {r["text"]: r["doc_id"] for r in sorted(before)}
            assert sorted(after) == sorted(r for r in before if last[r["text"]] == r["doc_id"])
        elif name == "simhash_near_dedup":
            ids = sorted(texts)
            prints = {i: plain_fingerprint(texts[i]) for i in ids}
            near = lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3
            group = {i: i for i in ids}
            for i in ids:
                for j in ids:
                    if j < i and near(i, j) and group[i] != group[j]:
                        low, high = sorted((group[i], group[j]))
                        group = {k: low if g == high else g for k, g in group.items()}
            assert sorted(after) == sorted(r for r in before if group[r["doc_id"]] == r["doc_id"])
        elif name == "mixing":
            whole = {r["doc_id"]: r for r in before}
            assert all(r["text"] and whole[r["doc_id"]]["text"].startswith(r["text"]) for r in after)
            taken = sum(r["taken"] for r in mixing.mix(spark.createDataFrame(before, docs.schema)).collect())
            words = sum(len(r["text"].encode().split()) for r in after)
            assert abs(words - taken) <= 0.01 * taken + len(columns)
        if name != "packing":
            assert docs.columns == columns
        else:
            assert {r["sequence_id"] for r in after} and {r["doc_id"] for r in after} == set(texts)
            assert max(r["offset"] + r["length"] for r in after) <= 1024
