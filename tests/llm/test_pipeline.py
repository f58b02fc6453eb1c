import corpus_pipeline as P
from panelspark.llm import bpe, pii
from panelspark.llm.catalog import tokenizer_path
from tests.llm.common import ODD, SF, frame
from tests.llm.test_decontam import brute as contaminated
from tests.llm.test_jaccard import brute as groups
from tests.llm.test_pii import brute as patterns


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before = {r["doc_id"]: r for r in docs.collect()}
    for k, (name, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        rows = {r["doc_id"]: r for r in docs.collect()}
        if name != "bpe":
            assert docs.columns == columns
        if name == "toxicity":
            assert len(rows) > 0.8 * len(before)
        if name == "near_duplicates":
            ids = sorted(before)
            firsts = {ids[g] for g, _ in groups([before[i]["text"] for i in ids]).values()}
            assert set(rows) == firsts
        if name == "decontamination":
            clean = {i for i, r in before.items() if not contaminated(r["text"], items, 13)[3]}
            assert set(rows) == clean and len(clean) < len(before)
        if name == "personal_data":
            assert set(rows) == set(before)
            changed = 0
            for i, r in rows.items():
                assert not patterns(r["text"])
                if not patterns(before[i]["text"]) and r["text"] == before[i]["text"]:
                    assert r == before[i]
                else:
                    changed += 1
                    assert r["n_chars"] == len(r["text"])
            assert changed < len(rows) / 2
        if name == "bpe":
            tok = bpe.tokenizer(tokenizer_path())
            assert set(rows) == set(before)
            for i, r in rows.items():
                assert r["ids"] == tok.encode(before[i]["text"], add_special_tokens=False).ids
        before = rows


def test_stages_on_odd_and_empty_documents(spark):
    for texts in (ODD, []):
        docs = frame(spark, texts, extra="row score spans")
        for name, stage in P.STAGES:
            out = stage(spark, docs, SF)
            rows = out.collect()
            assert name == "bpe" or out.columns == docs.columns
            assert len(rows) <= len(texts)


def test_run(spark):
    assert P.run(spark, SF).count() > 0


def test_mask_keeps_schema(spark):
    docs = spark.createDataFrame([(1, "mail a@b.cd now", 5), (2, None, None)], "doc_id long, text string, n_chars int")
    out = pii.masked(docs, pii.Model.empty())
    assert out.schema == docs.schema
    assert [tuple(r) for r in out.collect()] == [(1, "mail [EMAIL] now", 16), (2, None, None)]
