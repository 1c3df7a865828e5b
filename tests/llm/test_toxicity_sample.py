"""What toxicity learns from: whole texts of any length, one text for each id."""

import random

from gapwise.llm import toxicity


def corpus(spark, copies=1):
    rng = random.Random(2)
    rows = []
    for k in range(80):
        words = [f"w{rng.randrange(300)}" for _ in range(6_000)]
        if k % 2:
            words[5_900] = "vile"  # far beyond the first 20,000 characters
        text = ". ".join(" ".join(words[i : i + 12]) for i in range(0, 6_000, 12))
        rows += [(k, text)] * copies
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, spark.createDataFrame([(k, k % 2) for k in range(80)], "doc_id long, toxic int")


def test_a_corpus_of_long_texts_is_learned(spark):
    docs, labels = corpus(spark)
    model = toxicity.fit(docs, labels)
    assert any(word.startswith("vil") for word, w in model.weights.items() if w > 0)
    scores = {r.doc_id: r.toxicity.score for r in toxicity.scored(docs, model).collect()}
    assert all((scores[k] >= 0.5) == bool(k % 2) for k in scores)


def test_repeated_rows_do_not_enlarge_the_sample(spark):
    once, labels = corpus(spark)
    often, _ = corpus(spark, copies=3)
    assert toxicity.fit(often, labels.unionAll(labels)).weights == toxicity.fit(once, labels).weights


def test_empty_tables(spark):
    docs, labels = corpus(spark)
    assert toxicity.fit(docs.limit(0), labels).weights == {}
    assert toxicity.fit(docs, labels.limit(0)).weights == {}
    assert toxicity.scored(docs.limit(0), toxicity.ToxicityModel()).count() == 0
