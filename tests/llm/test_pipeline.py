import random

import pytest

import corpus_pipeline
from retail_lake.workspace import stage


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory, corpus):
    """Documents with odd rows, toxic ones and secrets, and labels of most of them."""
    rng = random.Random(11)
    root = str(tmp_path_factory.mktemp("pipeline"))
    clean = [(i, t, "en", "s", len(t)) for i, t in corpus.items()]
    toxic = [
        (1000 + i, " ".join(f"w{rng.randrange(400)}" for _ in range(30)) + rng.choice((" grobnik ", " vundle ")) + "x",
         "en", "s", 1)
        for i in range(200)
    ]
    more = [
        (2000, 'here token = "2abc3ff2ca8fb1e4c565a0eb63815530a948bdde" and more words of another kind', "en", "s", 1),
        (2001, None, None, None, None),
        (None, "a text without an id", "en", "s", 1),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(clean + toxic + more, schema).write.parquet(f"{root}/documents.parquet")
    labels = [(r[0], 1, int(1000 <= r[0] < 2000)) for r in clean + toxic]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return root


def test_every_stage_takes_effect_and_clean_documents_stay(spark, folder, corpus):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    schema, seen = docs.schema, {}
    for name, function in corpus_pipeline.STAGES[:4]:
        docs = stage(function(spark, docs, folder), "test").rows
        assert [(f.name, f.dataType) for f in docs.schema] == [(f.name, f.dataType) for f in schema]
        seen[name] = {r.doc_id: r.text for r in docs.collect()}
        assert None in seen[name] and seen[name][2001] is None
    left = set(seen["toxicity"])
    assert sum(1000 <= i < 2000 for i in left if i is not None) <= 4
    assert set(corpus) <= left
    assert set(corpus) - set(seen["near_duplicates"]) >= set(range(101, 110)) | set(range(81, 100))
    assert 5 in seen["near_duplicates"] and 80 in seen["near_duplicates"]
    assert set(seen["suffix_dedup"]) == set(seen["secrets"]) == set(seen["near_duplicates"])
    passage = corpus[60].split("\n")[1]
    assert passage in seen["suffix_dedup"][60]
    assert all(passage not in seen["suffix_dedup"][i] for i in range(61, 80))
    assert seen["secrets"][2000] == 'here [secret]" and more words of another kind'
    lengths = {r.doc_id: r.n_chars for r in docs.where("text IS NOT NULL").collect()}
    assert all(lengths[i] == len(t) for i, t in seen["secrets"].items() if t is not None)


def test_run_packs_what_is_left(spark, folder):
    rows = corpus_pipeline.run(spark, folder).collect()
    assert {r.length for r in rows} and all(r.length > 0 for r in rows)
    assert not any(1000 <= (r.doc_id or 0) < 2000 for r in rows) or len(rows) > 50
    tokens = {}
    for r in rows:
        tokens.setdefault(r.doc_id, [0, r.doc_tokens])[0] += r.length
    assert all(got == total for got, total in tokens.values())


def test_stages(spark):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "suffix_dedup", "secrets", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None
