import numpy as np
import pytest

from tripwire.llm import quality_machine as fm
from tripwire.llm import toxicity as tox

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def accuracy(scored, labels, label):
    rows = scored.filter("held_out").join(labels, "doc_id").collect()
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    return np.mean([r.predicted == r[label] for r in rows])


def test_toxicity_on_held_out_rows(tables):
    docs, labels = tables
    scored = tox.score(docs, tox.fit(docs, labels))
    assert scored.count() == docs.count() and accuracy(scored, labels, "toxic") >= 0.95


def test_quality_on_held_out_rows(tables):
    docs, labels = tables
    scored = fm.score(docs, fm.fit(docs, labels))
    assert scored.count() == docs.count() and accuracy(scored, labels, "quality") >= 0.95


@pytest.mark.parametrize("module,label", [(tox, "toxic"), (fm, "quality")])
def test_odd_rows_and_missing_labels(spark, odd, module, label):
    labels = spark.createDataFrame([(1, 1, 1), (4, 0, 0), (4, 1, 1), (5, None, None), (None, 1, 1), (7, 0, 0), (99, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    for given in (labels, labels.limit(0), labels.filter("toxic = 1")):
        model = module.fit(odd, given)
        rows = module.score(odd, model).collect()
        assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
        empty = {r.score for r in rows if r.doc_id in (2, 3)}
        assert module is fm or len(empty) == 1
    assert module.score(odd.limit(0), model).collect() == []


def test_no_labels_gives_an_even_score(odd, tables):
    assert {r.score for r in tox.score(odd, tox.fit(odd, tables[1].limit(0))).collect()} == {0.5}


def test_training_leaves_the_held_out_fold_alone(tables):
    docs, labels = tables
    from tripwire.llm.labelled import remainder, training_rows
    for folds, held in ((5, 0), (3, 1)):
        rows = training_rows(docs, labels, "quality", folds, held, 50)
        assert rows.count() == 50 and rows.filter(remainder(rows["id"], folds) == held).count() == 0


def test_linear_time_identity():
    rng = np.random.Generator(np.random.PCG64(3))
    machine = fm.Machine(0.3, rng.normal(size=20), rng.normal(size=(20, fm.RANK)))
    at, x = np.array([1, 4, 7, 19]), rng.normal(size=4)
    pairs = sum(machine.vectors[at[i]] @ machine.vectors[at[j]] * x[i] * x[j] for i in range(4) for j in range(i))
    assert machine.odds(at, x) == pytest.approx(0.3 + machine.weights[at] @ x + pairs)


def test_ngrams_are_those_of_the_text():
    ngrams = tox.NgramSet()
    one = ngrams(np.frombuffer(b"an idiot", np.uint8))
    assert set(ngrams(np.frombuffer(b"idiot", np.uint8))) <= set(one) and not ngrams.seen.any()
    assert len(ngrams(np.zeros(0, np.uint8))) == 0


def test_labels_of_other_documents_take_no_training_rows(spark):
    """A label table with very many ids that are not in the documents, and texts bounded in bytes."""
    from tripwire.llm.labelled import training_rows

    docs = spark.range(400).selectExpr("id doc_id", "repeat('x', 100) text")
    labels = spark.range(200_000).selectExpr("id doc_id", "cast(id % 2 as int) toxic")
    every = training_rows(docs, labels, "toxic", 5, 0, 1_000).collect()
    assert 290 < len(every) < 350 and {r.label for r in every} == {0, 1}
    assert len(training_rows(docs, labels, "toxic", 5, 0, 50).collect()) == 50
    assert len(training_rows(docs, labels, "toxic", 5, 0, 1_000, most_bytes=2_050).collect()) == 20
