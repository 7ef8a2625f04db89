import corpus_pipeline
from conftest_llm import words

from tripwire.llm import circulant_minhash, decontamination, secret_scan

DATA = "/root/testdata/sf0.001"


def test_every_stage_on_odd_rows_keeps_the_columns(spark, odd):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd, DATA)
        if name != "mixing":
            assert out.dtypes == odd.dtypes, name
        else:
            assert [c for c in out.columns if c != "copies"] == [c for c in odd.columns if c != "copies"]
        rows = out.collect()
        assert len(rows) <= odd.count()
        assert stage(spark, odd.limit(0), DATA).collect() == []


def test_decisions_take_effect(spark, odd):
    stage = dict(corpus_pipeline.STAGES)
    ids = lambda df: sorted(str(r.doc_id) for r in df.collect())
    assert ids(stage["near-duplicates"](spark, odd, DATA)) == ["1", "2", "3", "4", "5", "6", "7", "8", "None"]
    hidden = {r.doc_id: r for r in stage["secrets"](spark, odd, DATA).collect()}
    assert "[secret]" in hidden[6].text and hidden[6].n_chars == len(hidden[6].text) and hidden[2].text is None
    mixed = stage["mixing"](spark, odd, DATA).collect()
    assert {r.copies for r in mixed} <= {1, 2} and not {2, 3, 4} & {r.doc_id for r in mixed}
    kept = ids(stage["quality rules"](spark, odd, DATA))
    assert "7" not in kept and "2" not in kept and "None" in kept and kept.count("5") == 2


def test_run_on_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    out = corpus_pipeline.run(spark, DATA)
    rows = out.collect()
    assert out.columns == [*docs.columns, "copies"] and len({r.doc_id for r in rows}) == len(rows) > 100
    assert all(len(words(r.text)) >= 10 for r in rows)
    again = corpus_pipeline.run(spark, DATA).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    left = spark.createDataFrame(rows)
    found = circulant_minhash.near_duplicates(left.select("doc_id", "text"))
    assert found.filter("not kept").count() == 0
    assert decontamination.find_leaks(left, spark.read.parquet(f"{DATA}/benchmark.parquet")).count() == 0
    assert secret_scan.find_secrets(left.select("doc_id", "text"), ["doc_id"]).filter("size(spans) > 0").count() == 0


def test_different_texts_of_one_id_stay(spark):
    """Repeated ids, null ones among them: texts are judged apart, copies go whatever their ids."""
    texts = [" ".join(f"w{i}x{j}" for j in range(40)) for i in range(4)]
    rows = [(1, texts[0]), (1, texts[1]), (1, texts[0]), (2, texts[1] + " more"), (None, texts[2]), (None, texts[2]), (3, texts[3]), (4, None)]
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = dict(corpus_pipeline.STAGES)["near-duplicates"](spark, docs, DATA).collect()
    assert sorted(str((r.doc_id, r.text)) for r in kept) == sorted(
        str(x) for x in [(1, texts[0]), (1, texts[1]), (None, texts[2]), (3, texts[3]), (4, None)])
