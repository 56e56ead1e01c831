import random

import numpy as np
import pyarrow as pa
import pytest
from corpus import corpus, empty, odd, shingles

from orderlake.llm import near_dedup
from orderlake.llm.components import connected
from orderlake.llm.common import Work
from orderlake.llm.near_dedup import near_groups, similarity, sketch, without_near_duplicates
from orderlake.llm.shingles import hashed_spans, sets_of


def components(rows):
    """Brute force: {set: smallest id} over links of full sets."""
    sets = {}
    for doc_id, text in rows:
        sets.setdefault(frozenset(shingles(text)), []).append(doc_id)
    nodes = [s for s in sets if s]
    root = {s: s for s in nodes}

    def find(s):
        while root[s] != s:
            s = root[s]
        return s

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if 100 * len(a & b) >= 75 * len(a | b):
                root[find(a)] = find(b)
    ids = {}
    for s in nodes:
        ids.setdefault(find(s), []).extend(i for i in sets[s] if i is not None)
    return lambda text: min(ids[find(s)], default=None) if (s := frozenset(shingles(text))) else None


def expected(rows):
    of = components(rows)
    found = []
    for doc_id, text in rows:
        component = of(text) if shingles(text) else doc_id
        found.append((doc_id, len(shingles(text)), component, doc_id == component))
    return sorted(found, key=repr)


def groups(df):
    return sorted(map(tuple, near_groups(df).collect()), key=repr)


def edited(words, share, rng):
    return " ".join(f"w{rng.randrange(10**6)}" if rng.random() < share else w for w in words)


def family(seed, copies, shares, n=160):
    """Near copies of one text, from hardly to heavily edited."""
    rng = random.Random(seed)
    words = [f"w{rng.randrange(10**6)}" for _ in range(n)]
    return [edited(words, rng.choice(shares), rng) for _ in range(copies)]


def test_odd_rows(spark):
    df = odd(spark)
    assert groups(df) == expected([(r.doc_id, r.text) for r in df.collect()])


def test_no_rows(spark):
    assert groups(empty(spark)) == []
    assert without_near_duplicates(empty(spark)).collect() == []


@pytest.mark.parametrize("small", [near_dedup.SMALL_BUCKET, 1])
def test_large_group_of_loose_copies(spark, monkeypatch, small):
    """Links at all similarities around the limit, in groups whose members are not all linked."""
    monkeypatch.setattr(near_dedup, "SMALL_BUCKET", small)
    texts = family(1, 120, (0.0, 0.01, 0.02, 0.03, 0.05)) + family(2, 40, (0.01, 0.02), 900)
    texts += family(3, 60, (0.02, 0.025), 60) + ["a b c", "A  b\tc", "a b d"]
    rows = [(i * 7 % 1009, t) for i, t in enumerate(texts)]
    assert groups(corpus(spark, rows)) == expected(rows)


def test_one_document_of_each_group_stays(spark):
    df = odd(spark)
    left = without_near_duplicates(df)
    assert left.columns == df.columns
    of = components([(r.doc_id, r.text) for r in df.collect()])
    named = [of(r.text) for r in left.collect() if shingles(r.text) and r.doc_id is not None]
    assert set(named) == {of(r.text) for r in df.collect() if shingles(r.text) and r.doc_id is not None}


def test_estimates_are_near_the_truth_and_merge():
    texts = family(5, 30, (0.0, 0.02, 0.05, 0.1), 600)
    sets = [s for part in sets_of(pa.array(texts)) for s in part]
    made = sketch(sets)
    a, b = np.triu_indices(len(sets), 1)
    n = np.array([len(s) for s in sets], float)
    truth = [len(np.intersect1d(sets[i], sets[j])) / len(np.union1d(sets[i], sets[j])) for i, j in zip(a, b)]
    found = similarity(made[a], made[b], n[a], n[b])
    assert np.abs(found - truth).max() < 5 * np.sqrt(0.25 / near_dedup.REGISTERS)
    whole = sketch([np.unique(np.concatenate(sets[:2]))])
    assert (whole[0] == np.maximum(made[0], made[1])).all()


def test_components_of_a_long_chain(spark):
    links = [(f"{i:04d}".encode(), f"{i + 1:04d}".encode()) for i in range(60)]
    links += [(b"x", b"y"), (b"y", b"x"), (b"z", b"z")]
    found = connected(spark.createDataFrame(links, "a binary, b binary"), Work(spark)).collect()
    labels = {bytes(r.node): bytes(r.label) for r in found}
    assert labels == {f"{i:04d}".encode(): b"0000" for i in range(61)} | {b"x": b"x", b"y": b"x"}


def morse(n, letters):
    """Pairs of such words have the same sums of powers modulo 2**64, whatever the base."""
    word = [0]
    while len(word) < n:
        word += [1 - x for x in word]
    return "".join(letters[x] for x in word)


def test_words_that_deceive_sums_of_powers():
    texts = [morse(1024, "ab"), morse(1024, "ba"), morse(256, "ab"), morse(256, "ba")]
    sets = [s.tobytes() for part in sets_of(pa.array(texts, pa.large_string())) for s in part]
    assert len(set(sets)) == 4


def test_hashes_of_spans_depend_on_their_bytes_only():
    words = ["", "a", "ab", "a\0", "abcdefgh", "abcdefghi", "abcdefghabcdefgh", "x" * 512, "x" * 513, "x" * 514, "été"]
    lists = [words, words[::-1], [w for w in words for _ in range(2)]]
    known = {}
    for own in lists:
        data = np.frombuffer("".join(own).encode(), np.uint8)
        ends = np.cumsum([len(w.encode()) for w in own])
        begins = np.append(0, ends[:-1])
        for word, h in zip(own, hashed_spans(data, begins, ends).tolist()):
            assert known.setdefault(word, h) == h
    assert len(set(known.values())) == len(words)
