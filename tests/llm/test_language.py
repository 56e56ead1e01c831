import numpy as np
import pyarrow as pa
from corpus import corpus, empty, odd

from orderlake.llm.language import UNKNOWN, Profiles, documents, identify, in_known_language, ranked, _grams

WORDS = {
    "en": "the and that with from this have which their would there about other".split(),
    "de": "der und dass nicht eine auch sich werden haben durch über können".split(),
    "fr": "les des une dans pour avec mais être cette aussi très après".split(),
}


def prose(lang, seed, n=60):
    rng = np.random.default_rng(seed)
    return " ".join(rng.choice(WORDS[lang], n))


def test_documents_are_read_as_code_points():
    texts = ["", "aé日🎉", "x" * 10, ""]
    assert ["".join(map(chr, d)) for d in documents(pa.array(texts))] == texts


def test_ngrams_stay_within_padded_words():
    text = np.array(list(map(ord, "ab, c")), np.uint32)
    grams = {tuple(chr(g >> s & 0x1FFFFF) for s in (0, 21, 42) if g >> s & 0x1FFFFF) for g in _grams(text).tolist()}
    assert {"".join(g) for g in grams} == {"a", "b", "c", " a", "ab", "b ", " c", "c ", " ab", "ab ", " c "}


def test_out_of_place_distance_by_hand():
    text = np.array(list(map(ord, "aab")), np.uint32)
    own = ranked(_grams(text)).tolist()
    profiles = Profiles.of({"same": own, "none": [1, 2, 3]})
    assert profiles.predict(text) == ("same", 1.0)
    back = Profiles.of({"back": own[::-1]})
    apart = sum(abs(i - (len(own) - 1 - i)) for i in range(len(own)))
    assert np.isclose(back.predict(text)[1], 1 - apart / (400 * len(own)))


def test_held_out_documents_are_recognised(spark):
    rows = [(i, prose(lang, i), lang, "s") for i, lang in enumerate(sorted(WORDS) * 30)]
    found = identify(corpus(spark, rows)).collect()
    right = {i: lang for i, _, lang, _ in rows}
    assert any(r.held_out for r in found)
    assert all(r.lang_pred == right[r.doc_id] and 0 <= r.score <= 1 for r in found)


def test_labels_of_held_out_rows_teach_nothing(spark):
    rows = [(i, prose(lang, i), lang, "s") for i, lang in enumerate(sorted(WORDS) * 30)]
    df = corpus(spark, rows)
    held = {r.doc_id for r in identify(df).where("held_out").collect()}
    wrong = [(i, t, "xx" if i in held else lang, s) for i, t, lang, s in rows]
    same = sorted(map(tuple, identify(df).collect()))
    assert sorted(map(tuple, identify(corpus(spark, wrong)).collect())) == same


def test_odd_rows(spark):
    df = odd(spark)
    found = identify(df).collect()
    assert len(found) == df.count()
    by_id = {r.doc_id: r for r in found if r.doc_id in (1, 2, 3, 10)}
    assert all(r.lang_pred == UNKNOWN and r.score == 0 for r in by_id.values())
    assert in_known_language(df).columns == df.columns


def test_no_rows_and_no_labels(spark):
    assert identify(empty(spark)).collect() == []
    rows = corpus(spark, [(1, "words here", None, "s"), (2, "more words", None, "s")])
    assert {r.lang_pred for r in identify(rows).collect()} == {UNKNOWN}
    assert in_known_language(rows).count() == 0
