import random

import pytest

from retail_lake.llm import toxicity

SLURS = ("grobnik", "vundle", "skraff")


@pytest.fixture(scope="module")
def labelled(spark):
    """Half of the documents are toxic: by one of three words, or by a word's beginning."""
    rng = random.Random(8)
    documents, labels = [], []
    for i in range(900):
        words = [f"w{rng.randrange(300)}x" for _ in range(rng.randrange(5, 60))]
        toxic = i % 2
        if toxic:
            bad = rng.choice(SLURS) if i % 3 else "zorp" + rng.choice("abcdefgh")
            words.insert(rng.randrange(len(words)), bad)
        documents.append((i, " ".join(words), "en", 0.1))
        labels.append((i, 1, toxic))
    labels += [(None, 1, 1), (5, None, None), (10**6, 0, 1)]
    return (
        spark.createDataFrame(documents, "doc_id long, text string, lang string, score double"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_fold():
    assert toxicity.fold("You 1d10t, m0r0n###!") == " you idiot moron "
    assert toxicity.fold("іdіоt") == " іdіоt idiot "
    assert toxicity.fold("$tupid b@d 2021") == " tupid bad 2021 "
    assert toxicity.fold("ïdiöt été x") == " ïdiöt été x idiot ete "
    assert toxicity.fold("") == "  "


def test_matcher_takes_the_heaviest_term_of_a_word_outside_exceptions():
    matcher = toxicity.Matcher({" trash ": 5.0, " tra": 1.0, " cl": 2.0}, ("trash can",))
    folded = toxicity.fold("trash and trash can and clown trails")
    assert sorted(matcher.weights(folded).values()) == [1.0, 2.0, 5.0]
    assert toxicity.Matcher({}).weights(folded) == {}


def test_held_out_documents_are_told_apart(labelled):
    documents, labels = labelled
    rows = toxicity.assess(documents, labels).collect()
    assert len(rows) == 900
    held = [r for r in rows if r.held_out]
    assert 200 < len(held) < 400
    assert sum(r.predicted != r.doc_id % 2 for r in held) <= 0.03 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_held_out_labels_have_no_part_in_learning(spark, labelled):
    documents, labels = labelled
    from pyspark.sql import functions as F

    turned = labels.withColumn(
        "toxic",
        F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")),
    )
    assert toxicity.fit(documents, labels) == toxicity.fit(documents, turned)


def test_words_of_a_copied_document_are_not_taken():
    """Places 1 and 2 only come with place 0, in many copies."""
    limits = toxicity.Limits(common=0.9)
    rows = [[0, 1, 2]] * 50 + [[0]] * 10 + [[3]] * 10
    assert toxicity.choose_terms(rows, [60, 50, 50, 10], [0, 0, 0, 0], 70, limits) == [0, 3]


def test_odd_rows_and_missing_labels(spark, odd, empty, labelled):
    labels = labelled[1]
    rows = toxicity.assess(odd, labels).collect()
    assert len(rows) == odd.count()
    assert len({r.score for r in toxicity.assess(odd, labels.where("false")).collect()}) == 1
    assert not any(r.held_out for r in rows if r.doc_id is None)
    assert toxicity.assess(empty, labels).count() == 0


def test_exceptions_are_swept_as_brute_force_finds_them():
    rng = random.Random(2)
    for _ in range(300):
        words = [rng.choice("abcd") for _ in range(rng.randrange(30))]
        phrases = {" ".join(rng.choice("abcd") for _ in range(rng.randrange(1, 4))) for _ in range(3)}
        terms = {f" {w} ": float(ord(w)) for w in rng.sample("abcd", 2)}
        folded = toxicity.fold(" ".join(words))
        matches = {i: terms[f" {w} "] for i, w in enumerate(words) if f" {w} " in terms}
        for phrase in phrases:
            size = len(phrase.split())
            for i in range(len(words) - size + 1):
                if words[i : i + size] == phrase.split():
                    matches = {at: w for at, w in matches.items() if not i <= at < i + size}
        found = toxicity.Matcher(terms, tuple(phrases)).weights(folded)
        assert found == {2 * i: w for i, w in matches.items()}


def test_the_model_does_not_depend_on_layout(spark, labelled):
    documents, labels = labelled
    copies = documents.where("doc_id < 200").selectExpr(
        "doc_id + 5000 AS doc_id", "concat(text, ' ', 'copy', doc_id) AS text", "lang", "score"
    )
    known = labels.where("doc_id < 200").selectExpr("doc_id + 5000 AS doc_id", "quality", "toxic")
    against = labels.where("doc_id < 30").selectExpr("doc_id", "quality", "1 - toxic AS toxic")
    documents, labels = documents.unionByName(copies), labels.unionByName(known).unionByName(against)
    models = []
    for batch, parts in ((5, 7), (10_000, 1), (64, 3)):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        try:
            models.append(toxicity.fit(documents.repartition(parts), labels.repartition(parts)))
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert models[0] == models[1] == models[2] and models[0].terms


def test_phrases_that_only_harmless_documents_have_are_exceptions(spark):
    rng = random.Random(4)
    documents, labels = [], []
    for i in range(1200):
        words = [f"w{rng.randrange(300)}x" for _ in range(30)]
        if i % 2:
            words[rng.randrange(30)] = "vundle"
        elif i % 10 == 0:
            words[10:12] = ["vundle", "tree"]
        documents.append((i, " ".join(words)))
        labels.append((i, i % 2))
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(spark.createDataFrame(documents, "doc_id long, text string"), labels)
    assert "vundle tree" in " ".join(model.exceptions)
    texts = spark.createDataFrame([(1, "some vundle here"), (2, "a vundle tree here")], "doc_id long, text string")
    from pyspark.sql import functions as F

    found = {r[0]: r[1] for r in texts.select("doc_id", toxicity.score(F.col("text"), model)).collect()}
    assert found[1] > 0.7 > found[2]
