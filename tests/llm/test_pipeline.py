"""The pipeline against plain Python, stage by stage."""

from collections import Counter

import public_tokenizers
from corpus import corpus, odd
from sentencepiece import SentencePieceProcessor
from test_near_dedup import components

import corpus_pipeline
from orderlake.llm.mixing import mix

STAGES = dict(corpus_pipeline.STAGES)


def texts(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def test_stages_on_odd_rows(spark):
    df = odd(spark)
    left = STAGES["language"](spark, df, "")
    gone = {r.doc_id for r in df.collect()} - {r.doc_id for r in left.collect()}
    assert gone == {1, 2, 3, 10}
    for name in ("exact", "near", "mixture"):
        left = STAGES[name](spark, left, "")
        assert left.columns == df.columns
    assert STAGES["encoded"](spark, left, "").count() == left.count() > 0


def test_stages_on_nothing(spark):
    none = odd(spark).where("false")
    assert all(stage(spark, none, "").count() == 0 for stage in STAGES.values())


def test_run_is_its_stages_by_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    left = [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]
    last = {}
    for row in left:
        last[row[1]] = max(last.get(row[1], row), row)
    left = sorted(last.values())
    of = components([(r[0], r[1]) for r in left])
    left = [r for r in left if of(r[1]) in (None, r[0])]
    copies = {r.doc_id: r.copies for r in mix(corpus(spark, left)).collect()}
    library = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    wanted = Counter()
    for doc_id, text, lang, source in left:
        if copies[doc_id]:
            wanted[doc_id, lang, source, tuple(library.encode(text))] += copies[doc_id]
    found = Counter(
        (r.doc_id, r.lang, r.source, tuple(r.ids)) for r in corpus_pipeline.run(spark, sf_dir).collect()
    )
    assert found == wanted
