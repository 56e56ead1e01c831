import itertools
from collections import Counter

import numpy as np
import pytest
from corpus import corpus, empty, odd

from orderlake.llm.alignment import Aligner, Tokenizers, align, linkable
from orderlake.llm.queries import BYTE_TOKENIZER, PIECES, op13_alignment, tokenizer_file

TEXTS = [
    "The quick brown fox, unaligned tokenisation of antidisestablishmentarianism.",
    "  two  spaces \n\n and lines\n",
    "<|endoftext|> and <s> </s> <unk> are plain text",
    "日本語テキスト 🎉 é é naïve",
    "a\u0000b​c d \t e",
    "we'll don't I'M 12345 6,7",
    " ",
    "x",
    "x" * 500,
    "word " * 200,
]
LOST = ["one▁two", "▁"]


@pytest.fixture(scope="module")
def tokenizers():
    return Tokenizers.of_files(tokenizer_file(BYTE_TOKENIZER), tokenizer_file(PIECES))


@pytest.fixture(scope="module")
def aligner(tokenizers):
    return Aligner(tokenizers)


def brute(aligner, text):
    """Whole text through both libraries; groups and links by the definition."""
    if not text:
        return 0, 0, "", []
    ids = [
        aligner.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids,
        aligner.b.encode(text),
    ]
    spelled = [[side[i] for i in own] for side, own in zip(aligner.spelled, ids)]
    if any(b"".join(own) != (" " + text).encode() for own in spelled):
        return 0, 0, "", []
    ends = [list(itertools.accumulate(map(len, own))) for own in spelled]
    groups, links, done = [], [], [0, 0]
    for end in sorted(set(ends[0]) & set(ends[1])):
        now = [side.index(end) + 1 for side in ends]
        links.append(tuple(own[k - 1] for own, k in zip(ids, now)))
        groups.append("|".join(",".join(map(str, own[i:k])) for own, i, k in zip(ids, done, now)))
        done = now
    return len(ids[0]), len(ids[1]), ";".join(groups), links


def test_special_tokens_are_plain_text(aligner):
    assert 50256 not in brute(aligner, "<|endoftext|>")[3]


def test_texts_as_by_the_definition(aligner):
    texts = [*TEXTS, *LOST, "", *TEXTS]
    made = aligner.align(texts)
    for k, text in enumerate(texts):
        n_a, n_b, groups, links = brute(aligner, text)
        own = aligner.pairs[made.links[made.starts[k] : made.starts[k + 1]]].tolist()
        assert (made.n_a[k], made.n_b[k], made.groups[k]) == (n_a, n_b, groups)
        assert [(p >> 32, p & 0xFFFFFFFF) for p in own] == links
    assert made.n_a[len(TEXTS)] == 0


def test_forgetting_changes_nothing(aligner, monkeypatch):
    wanted = aligner.align(TEXTS).groups
    monkeypatch.setattr("orderlake.llm.alignment.MOST_UNITS", 3)
    monkeypatch.setattr("orderlake.llm.alignment.MOST_WINDOWS", 3)
    assert [aligner.align([text]).groups[0] for text in TEXTS] == wanted


def test_known_words_are_not_cut_into_windows_again(aligner, monkeypatch):
    wanted = aligner.align(TEXTS)

    def refused(self, keys):
        raise AssertionError("windows were looked up again")

    monkeypatch.setattr(Aligner, "_windows", refused)
    made = aligner.align([*TEXTS[::-1]])
    assert made.groups == wanted.groups[::-1] and made.n_b.tolist() == wanted.n_b.tolist()[::-1]


def test_words_encoded_as_one_text_are_cut_after_their_bytes(aligner):
    words = ["we'll", "日本", "<s>", "1,2", "antidisestablishmentarianism", "é🎉"]
    sizes = np.array([len(word.encode()) + 1 for word in words])
    (flat, counts), (one, each) = (aligner._ids_a([f" {w}" for w in words], sizes, joined) for joined in (True, False))
    assert flat.tolist() == one.tolist() and counts.tolist() == each.tolist()


def test_pairs_that_can_be_linked():
    pairs = linkable([b"ab", b"b", b"c", b""], [b"b", b"cab", b"x", b"b"])
    assert sorted((p >> 32, p & 0xFFFFFFFF) for p in pairs.tolist()) == [(0, 0), (0, 1), (0, 3), (1, 0), (1, 1), (1, 3)]


def wanted_rows(aligner, rows):
    made = [(i, brute(aligner, text)) for i, text in rows]
    counts = Counter(link for _, (*_, links) in made for link in links)
    highest = {}
    for (_, b), n in counts.items():
        highest[b] = max(n, highest.get(b, 0))
    return counts, [
        (
            i,
            n_a,
            n_b,
            len(links),
            len(links),
            sum(counts[x] == highest[x[1]] for x in links),
            sum(counts[x] for x in links),
            groups,
        )
        for i, (n_a, n_b, groups, links) in made
    ]


def test_corpus_counts(spark, aligner, tokenizers):
    rows = list(enumerate([*TEXTS, *LOST, None, "", *TEXTS]))
    result = align(corpus(spark, rows), tokenizers)
    counts, wanted = wanted_rows(aligner, rows)
    assert sorted(map(tuple, result.documents.collect())) == wanted
    assert {(r.id_a, r.id_b): r.n for r in result.pairs.collect()} == counts


def test_documents_of_the_driver_against_brute_force(spark, sf_dir, aligner):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    _, wanted = wanted_rows(aligner, [tuple(r) for r in docs])
    result = op13_alignment(spark, sf_dir).drop("groups_sha256").collect()
    assert sorted(map(tuple, result)) == sorted(row[:-1] for row in wanted)


def test_odd_rows_and_no_rows(spark, tokenizers):
    df = odd(spark)
    result = align(df, tokenizers).documents
    assert result.count() == df.count()
    assert {(r.n_a, r.groups) for r in result.where("doc_id in (1, 2)").collect()} == {(0, "")}
    assert align(empty(spark), tokenizers).documents.collect() == []
    assert align(corpus(spark, [(1, None)]), tokenizers).documents.collect()[0].n_links == 0
