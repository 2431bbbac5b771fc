import json

import public_tokenizers as P
import pytest
from conftest_helpers import words_of

import __spark_entry__ as entry
import corpus_pipeline
from wrenchlake.llm import jaccard, pii, spans, toxicity
from wrenchlake.llm import queries as llm

SF = "/root/testdata/sf0.001"
DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]


def test_every_operator_is_registered():
    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names
    assert set(llm.QUERIES) <= set(names)


@pytest.mark.parametrize("name", sorted(llm.QUERIES, key=lambda n: int(n[2:].split("_")[0])))
def test_query_covers_its_table(spark, name):
    rows = llm.QUERIES[name](spark, SF)
    if name.startswith("op13"):
        convs = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id").distinct().count()
        assert [r["n_convs"] for r in rows.filter("depth = 0").collect()] == [convs]
        return
    others = {"op4": ("embeddings", "query_id"), "op6": ("pages", "page_id"), "op11": ("benchmark", "item_id")}
    table, key = others.get(name.split("_")[0], ("documents", "doc_id"))
    own = spark.read.parquet(f"{SF}/{table}.parquet")
    found = {type(own.first()[0])(r[0]) for r in rows.select(key).distinct().collect()}
    want = {r[0] for r in own.select(own.columns[0]).collect()}
    assert found == ({i for i in want if i % 20 == 0} if name.startswith("op4") else want)


def test_stages_keep_the_columns_and_clean_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard_join", "substring_dedup", "pii", "packing"]
    before = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF).cache()
        assert after.columns == DOCUMENT
        assert after.filter("n_chars <> length(text)").count() == 0
        assert after.join(before, "doc_id", "left_anti").count() == 0
        before = after
    assert before.count() >= 0.7 * docs.count()


def test_run_equals_the_stages_by_hand(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = toxicity.score(docs, toxicity.train(toxicity.labelled(docs, labels))).filter("predicted = 0").select(*DOCUMENT).cache()
    sets = {r["doc_id"]: r["component_id"] for r in jaccard.near_duplicates(scored).collect()}
    kept = scored.filter(scored.doc_id.isin([i for i, c in sets.items() if i == c]))
    clean = pii.redact(spans.remove_repeated(kept).select(*DOCUMENT))
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(str(P.path("byte_bpe_50k.json")))
    tokenizer.encode_special_tokens = True
    want = {r["doc_id"]: len(tokenizer.encode(r["text"], add_special_tokens=False).ids) + 1 for r in clean.collect()}
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"]: r["doc_tokens"] for r in rows} == want
    total = {}
    for r in rows:
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["length"]
    assert total == want


def test_awkward_documents_pass_all_stages(spark, messy, messy_rows, empty, tmp_path):
    labels = [(k, 1, k % 2) for k in range(10)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for start in (messy, empty):
        docs = start
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, str(tmp_path)).cache()
        assert docs.columns == DOCUMENT
        pieces = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
        assert pieces.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_oracles_name_registered_queries():
    assert set(llm.SQL) <= set(llm.QUERIES) and json.dumps(sorted(llm.SQL))
    assert words_of("A b") == ["a", "b"]
