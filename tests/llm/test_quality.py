import re
from collections import Counter

from retail_lake.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def test_base_counts_equal_brute_force(spark, odd, corpus):
    more = [(300, "a b c d e x a b c d e\n#*\n#*\n \n\n<>"), (301, "a\nb\na\n\x0ba\n" * 9)]
    frame = odd.select("doc_id", "text").unionByName(
        spark.createDataFrame(more, "doc_id long, text string")
    )
    rows = quality.assess(frame).collect()
    texts = [r.text or "" for r in frame.collect()]
    assert sorted(brute(t) for t in texts) == sorted(
        (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        for r in rows
    )
    assert not any(r.kept for r in rows if r.base_failed)


def assessed(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r for r in quality.assess(frame).collect()}


def test_lines_are_judged_one_by_one(spark):
    prose = [" ".join(f"w{i}x{k}" for k in range(12)) + "." for i in range(6)]
    bad = [
        "home | news | sport | about",
        "one## two%% three$$ four&& five**",
        "BUY!! NOW!! OR!! NEVER!!",
        "same " * 30,
        "so so it it goes goes on on and and more",
        "All rights reserved.",
        "home news sport about",
    ]
    rows = assessed(
        spark,
        [
            "\n".join(prose),
            "\n".join([*prose, *bad[:1], *bad[5:]]),
            "\n".join([prose[0], *bad]),
            *("\n".join([*prose, line]) for line in bad),
        ],
    )
    assert rows[0].kept and rows[0].cleaned == "\n".join(prose) and rows[0].n_failed_lines == 0
    assert rows[1].kept and rows[1].cleaned == "\n".join(prose) and rows[1].n_failed_lines == 3
    assert not rows[2].kept
    for i in range(len(bad)):
        assert rows[3 + i].n_failed_lines == 1, bad[i]


def test_no_python_runs_and_nothing_is_shuffled(odd, empty):
    plan = quality.assess(empty)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "Exchange" not in text
    assert quality.assess(empty).count() == 0
