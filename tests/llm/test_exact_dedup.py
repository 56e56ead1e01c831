import numpy as np
from corpus import corpus, empty, key, odd
from pyspark.sql import functions as F

from orderlake.llm.binary_fuse import build
from orderlake.llm.exact_dedup import exact_groups, sha256, without_duplicates


def expected(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(text or "", []).append(doc_id)
    found = []
    for ids in groups.values():
        keep = max(ids, key=key)
        first = True
        for doc_id in ids:
            found.append((doc_id, keep, len(ids), doc_id == keep and first))
            first = first and doc_id != keep
    return sorted(found, key=repr)


def groups(df, **how):
    rows = exact_groups(df, **how).select("doc_id", "keep_id", "group_size", "kept").collect()
    return sorted(map(tuple, rows), key=repr)


def test_filter_has_its_keys_and_few_others():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 10, 1000, 5000):
        keys = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        made = build(keys)
        assert made.contains(keys).all()
        others = rng.integers(0, 2**63, 20_000, dtype=np.uint64) | np.uint64(1 << 63)
        assert made.contains(others).mean() < 0.01
        assert n < 5000 or len(made.prints) < 1.4 * n


def test_odd_rows(spark):
    df = odd(spark)
    assert groups(df) == expected([(r.doc_id, r.text) for r in df.collect()])


def test_no_rows(spark):
    assert groups(empty(spark)) == []
    assert without_duplicates(empty(spark)).collect() == []


def test_many_copies_and_any_snapshot(spark):
    rows = [(i, f"text {i % 7}") for i in range(300)] + [(i, "hot") for i in range(300, 600)]
    df = corpus(spark, rows)
    for in_snapshot in (F.lit(True), F.lit(False), F.col("doc_id") < 310):
        assert groups(df, in_snapshot=in_snapshot) == expected(rows)


def test_digests_that_collide_are_told_apart_by_bytes(spark):
    rows = [(i, f"text {i % 50}") for i in range(200)]

    def short(text):
        return F.substring(sha256(text), 1, 0)

    assert groups(corpus(spark, rows), digest=short) == expected(rows)


def test_kept_rows_keep_their_columns(spark):
    df = odd(spark)
    left = without_duplicates(df)
    assert left.columns == df.columns
    texts = [r.text or "" for r in left.collect()]
    assert len(texts) == len(set(texts)) == df.select(F.coalesce("text", F.lit(""))).distinct().count()
