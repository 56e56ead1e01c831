import random
from collections import Counter

import pytest
from corpus import WORD, corpus, empty, odd

from orderlake.llm.quality_rules import GAMMA, fences, judge, measured, merged, sketches


def counted(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)), len(covered),
    )


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8))) for _ in range(n))


TEXTS = ["a b c a b c", "a b c x a b c a b c", "a a a a", "x\n\n x\nx\nx\n \n", "#a *b\t$c%&|<>", "a b\x0bc\x0cd\re", "é 🎉 é 🎉 é"]


def test_counts(spark):
    texts = TEXTS + [" ".join(random.Random(i).choices("abc", k=90)) for i in range(20)]
    for r in judge(corpus(spark, list(enumerate(texts)))).collect():
        assert tuple(r)[1:6] == counted(texts[r.doc_id]), texts[r.doc_id]


def test_odd_rows(spark):
    df = odd(spark)
    found = sorted((tuple(r)[:6] for r in judge(df).collect()), key=repr)
    assert found == sorted(((r.doc_id, *counted(r.text)) for r in df.collect()), key=repr)
    assert not any(r.kept for r in judge(df).collect() if r.n_words < 50)


def test_no_rows(spark):
    assert judge(empty(spark)).collect() == []


def test_thresholds_follow_the_group(spark):
    """What is usual in one source is an outlier in another; clean documents stay."""
    rng = random.Random(3)

    def marked(n):
        return " ".join(f"{w}###" for w in prose(rng, n).split())

    rows = [(i, prose(rng, 80), "en", "prose") for i in range(300)]
    rows += [(1000 + i, marked(80), "en", "tables") for i in range(300)]
    rows += [(2000, marked(80), "en", "prose"), (2001, marked(80), "en", "tables")]
    rows += [(3000, prose(rng, 80), "en", "tiny"), (4000, prose(rng, 80), None, None)]
    kept = {r.doc_id: r.kept for r in judge(corpus(spark, rows)).collect()}
    assert [i for i, k in kept.items() if not k] == [2000]


def test_sketches_merge_and_are_right_within_a_bucket(spark):
    rng = random.Random(5)
    rows = [(i, prose(rng, rng.randrange(60, 200)), "en", "ab"[i % 2]) for i in range(400)]
    counts = measured(corpus(spark, rows))
    parts = sketches(counts, ["lang", "source"])
    whole = sketches(counts, ["lang"])
    assert sorted(map(tuple, merged(parts, ["lang"]).collect())) == sorted(map(tuple, whole.collect()))
    lengths = sorted(r.word_chars / r.n_words for r in counts.collect())
    (limits,) = fences(whole, ["lang"]).collect()
    middle = (limits.word_length_low + limits.word_length_high) / 2
    wanted = (lengths[len(lengths) // 4 - 1] + lengths[3 * len(lengths) // 4 - 1]) / 2
    assert middle == pytest.approx(wanted, rel=GAMMA - 1)
