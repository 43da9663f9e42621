import corpus_pipeline
from roomledger.llm import minhash, secret_scan
from tests.llm.rows import with_repeats

SF = "/root/testdata/sf0.001"


def test_stages_follow_each_other(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, SF)
        docs.write.parquet(str(tmp_path / name.split()[0]))
        docs = spark.read.parquet(str(tmp_path / name.split()[0]))
        seen[name] = (before, docs)
        if name != "packing":
            assert docs.columns == columns
    before, after = seen["minhash near-dedup"]
    assert {r.doc_id for r in after.collect()} == {
        r.doc_id for r in minhash.near_duplicates(before).collect() if r.kept
    }
    before, after = seen["secret scans"]
    assert before.count() == after.count()
    assert secret_scan.secrets(after).filter("is_secret").count() == 0
    before, after = seen["exact dedup"]
    assert after.count() == before.select("text").distinct().count()
    before, after = seen["packing"]
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()}
    clean = spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1")
    before, after = seen["quality classifier"]
    assert before.join(clean, "doc_id").count() == after.join(clean, "doc_id").count()


def test_stages_take_awkward_rows(spark):
    docs = with_repeats(spark)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() > 0
        assert stage(spark, docs.limit(0), SF).count() == 0
