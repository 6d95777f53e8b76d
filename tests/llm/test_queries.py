"""The registered queries and the pipeline."""

import hashlib
import os
import random

import __spark_entry__ as entry_mod
import corpus_pipeline
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from sensorflow.llm import queries
from sensorflow.plans.compare import compare

from .helpers import documents, words
from .test_decontaminate import brute as brute_leaks
from .test_dedup import brute_exact, brute_near


@pytest.mark.parametrize("key", sorted(queries.ORACLE))
def test_query_matches_sql(spark, duck, sf_dir, key):
    res = compare(queries.QUERIES[key](spark, sf_dir), duck, queries.ORACLE[key])
    assert res["cols_match"] and res["values_match"], res


def test_every_operator_is_registered():
    names = entry_mod.queries()
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit()} == set(range(1, 14))
    assert "pipeline" in names and set(queries.QUERIES) <= set(names)


CONTRACTS = {
    "op1_": ["doc_id", "n_shingles", "component_id", "kept"],
    "op2_": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op3_": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    "op4_": ["doc_id", "kept", "n_items", "item_ids", "similarity"],
    "op5_": ["page_id", "host", "path", "rule", "verdict"],
    "op6_": ["doc_id", "held_out", "score", "predicted"],
    "op7_": ["doc_id", "held_out", "lang_pred", "score"],
    "op8_": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op9_": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op10_": ["page_id", "url", "text", "n_chars"],
    "op11_": ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"],
    "op12_": ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
    "op13_": ["doc_id", "n_bytes", "n_tokens", "over_limit"],
}


@pytest.mark.parametrize("prefix", sorted(CONTRACTS))
def test_every_row_is_in_the_result(spark, prefix):
    d = "/root/testdata/sf0.001"
    name = next(n for n in queries.QUERIES if n.startswith(prefix))
    df = queries.QUERIES[name](spark, d)
    assert df.columns[:len(CONTRACTS[prefix])] == CONTRACTS[prefix]
    if prefix == "op11_":
        return
    table = "pages" if "page_id" in df.columns else "documents" if "doc_id" in df.columns else "embeddings"
    if prefix == "op12_":
        df = df.filter("component = 1")
    assert df.count() == spark.read.parquet(f"{d}/{table}.parquet").count()


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    got = queries.op7_language_id(spark, sf_dir).filter("held_out").join(docs, "doc_id").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.97 * len(got)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter("toxic IS NOT NULL")
    scored = queries.op6_toxicity(spark, sf_dir).filter("held_out").join(labels, "doc_id").collect()
    toxic = [r["score"] for r in scored if r["toxic"] == 1]
    clean = [r["score"] for r in scored if r["toxic"] == 0]
    wins = sum((a > b) + 0.5 * (a == b) for a in toxic for b in clean)
    assert wins >= 0.75 * len(toxic) * len(clean)


def write(spark, folder, docs, benchmark):
    documents(spark, docs).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(benchmark, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_pipeline_equals_brute_force(spark, tmp_path):
    rng = random.Random(21)
    items = [(i, " ".join(words(rng, 25))) for i in range(5)]
    base = [words(rng, 60) for _ in range(8)]
    rows = []
    for i in range(90):
        w = list(rng.choice(base)) if i % 2 else words(rng, 50)
        for _ in range(rng.randint(0, 4) if i % 2 else 0):
            w[rng.randrange(len(w))] = "edit"
        if i % 9 == 4:
            w += rng.choice(items)[1].split()
        rows.append((i, " ".join(w), "aa"))
    rows += [(200, None, "aa"), (201, "", None), (202, "12 34 !!", "aa"), (203, rows[0][1].replace(" ", "\n"), None),
             (rows[1][0], rows[1][1], "aa"), (204, "short", "aa")]
    d = write(spark, tmp_path, rows, items)
    left = [(i, t) for i, t, _ in rows if t and any(c.isalpha() for c in t)]
    kept = {(i, h) for i, _, _, k, h in brute_exact(left) if k}
    left = [(i, t) for i, t in left if (i, hashlib.sha256(" ".join(t.split()).encode()).hexdigest()) in kept]
    alone = {i for i, _, _, k in brute_near(left, 5, 80) if k}
    left = [(i, t) for i, t in left if i in alone]
    leaks = brute_leaks(left, items)
    left = [(i, t) for i, t in left if i not in leaks]
    got = corpus_pipeline.run(spark, d).collect()
    assert sorted((r["doc_id"], r["decoded_sha256"]) for r in got) == sorted(
        (i, hashlib.sha256(t.encode()).hexdigest()) for i, t in left)
    assert all(r["n_tokens"] * 4 == len(r["ids"]) > 0 for r in got)


def test_stages_keep_the_columns_and_null_ids(spark, tmp_path):
    rng = random.Random(22)
    rows = [(i, " ".join(words(rng, 20)), "aa") for i in range(6)] + [(None, " ".join(words(rng, 20)), "aa")]
    d = write(spark, tmp_path, rows, [(1, rows[2][1])])
    docs = spark.read.parquet(f"{d}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, d)
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), docs.schema)
    assert sorted(str(r["doc_id"]) for r in docs.collect()) == ["0", "1", "3", "4", "5", "None"]
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def test_stages_with_clashing_columns(spark, tmp_path):
    rng = random.Random(23)
    rows = [(i, " ".join(words(rng, 20)), "aa") for i in range(6)]
    d = write(spark, tmp_path, [*rows, (6, rows[0][1], "aa")], [(1, rows[2][1])])
    docs = documents(spark, [*rows, (6, rows[0][1], "aa")], clashing=True).withColumns(
        {"lang_pred": F.lit("x"), "_sha": F.lit(1), "held_out": F.lit(True), "odd`name and space": F.lit(2), "row": F.lit(3)})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, d)
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), docs.schema)
    assert sorted(r["doc_id"] for r in docs.collect()) == [0, 1, 3, 4, 5]
    assert {(r["lang_pred"], r["score"], r["odd`name and space"]) for r in docs.collect()} == {("x", 0.5, 2)}
    assert corpus_pipeline.STAGES[-1][1](spark, docs, d).count() == 5


def test_pipeline_of_an_empty_table(spark, tmp_path):
    assert corpus_pipeline.run(spark, write(spark, tmp_path, [], [])).count() == 0


def test_vocabulary_is_a_parameter():
    assert os.path.exists(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def test_filters_by_id_shuffle_few_texts(spark, monkeypatch):
    ids = spark.createDataFrame([(1,), (1,), (3,), (None,)], "doc_id long")
    docs = documents(spark, [(i, f"text {i}") for i in range(50)] + [(1, "again"), (None, "no id")])
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = corpus_pipeline._without(docs, ids, "gone")
        plan = left._jdf.queryExecution().executedPlan().toString()
        got = [r["text"] for r in left.collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert sorted(got) == sorted([f"text {i}" for i in range(50) if i not in (1, 3)] + ["no id"])
    above, below = plan.split("SortMergeJoin", 1)
    assert "LeftAnti" in above and "BroadcastHashJoin" in above and "LeftSemi" in below
