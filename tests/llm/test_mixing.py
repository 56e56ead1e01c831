from collections import defaultdict

import pytest
from corpus import WORD, corpus, empty, odd

from orderlake.llm.mixing import MOST, TOTAL, mix, mixed


def shares(sizes):
    """Targets by resharing the excess until no source is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weights = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    left, open_, target = TOTAL * sum(sizes.values()), set(order), {}
    while open_:
        total = sum(weights[s] for s in open_)
        full = {s for s in open_ if left * weights[s] / total >= MOST * sizes[s]}
        if not full:
            target |= {s: left * weights[s] / total for s in open_}
            break
        for s in full:
            target[s] = MOST * sizes[s]
        left -= sum(target[s] for s in full)
        open_ -= full
    return target


def rows_of(n, sources, seed=0):
    return [(i, "w " * ((i * 7919 + seed) % 60), "en", sources[i * i % len(sources)]) for i in range(n)]


@pytest.mark.parametrize("sources", [["a"], ["a", "b", "c"], ["b", None, "a", "Z", "é", "a", "a", "a"]])
def test_sources_come_near_their_targets(spark, sources):
    rows = rows_of(800, sources)
    found = mix(corpus(spark, rows)).collect()
    source = {i: s for i, _, _, s in rows}
    size, taken, target = defaultdict(int), defaultdict(int), {}
    for r in found:
        s = source[r.doc_id]
        size[s] += r["size"]
        taken[s] += r.taken
        target[s] = r.target
        assert r.taken in (0, r["size"], 2 * r["size"])
    assert target == pytest.approx(shares(size))
    assert all(r.source_size == size[source[r.doc_id]] for r in found)
    for s in size:
        assert abs(taken[s] - target[s]) <= 60


def test_reruns_agree_and_do_not_depend_on_the_layout(spark):
    df = corpus(spark, rows_of(500, ["a", "b", None]))
    first = sorted(map(tuple, mix(df).collect()))
    assert sorted(map(tuple, mix(df.repartition(5, "text")).collect())) == first


def test_preferred_documents_are_taken_more_often(spark):
    df = corpus(spark, [(i, "w " * 10, "en", "a") for i in range(3000)])
    df = df.selectExpr("*", "case when doc_id % 3 = 0 then 1.6D when doc_id % 3 = 1 then 0.4D end as wish")
    taken = {k: 0 for k in range(3)}
    for r in mix(df, "wish").collect():
        taken[r.doc_id % 3] += r.copies
    assert taken[0] > 1.05 * taken[2] > 1.05 * 1.05 * taken[1]


def test_copies_appear_with_all_columns(spark):
    df = odd(spark)
    left = mixed(df)
    assert left.columns == df.columns
    taken = mix(df).collect()
    assert left.count() == sum(r.copies for r in taken)
    words = sum(len(WORD.findall(r.text or "")) for r in left.collect())
    assert words == sum(r.taken for r in taken)


def test_odd_rows(spark):
    df = odd(spark)
    found = mix(df).collect()
    assert len(found) == df.count()
    sizes = sorted(len(WORD.findall(r.text or "")) for r in df.collect())
    assert sorted(r["size"] for r in found) == sizes


def test_no_rows_and_no_words(spark):
    assert mix(empty(spark)).collect() == []
    assert mixed(empty(spark)).collect() == []
    assert [r.taken for r in mix(corpus(spark, [(1, None), (2, " ")])).collect()] == [0, 0]
