import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from corpus import corpus, empty, odd

from orderlake.llm import pieces as module
from orderlake.llm import queries
from orderlake.llm.pieces import Chunk, Pieces, combined, cut, decode, encode, prefixes, symbols

TEXTS = [
    "a", "  ", "a  b   c\n\n", "日本語テキスト🎉 emoji", "ааа бббб", "x" * 500, "ab" * 100 + "🎉" * 40,
    "The quick brown fox jumps over the lazy dog. " * 12, "\t\x00tabs", "nothing" + " " * 40 + "there",
]


@pytest.fixture(scope="module")
def model():
    return Pieces.from_file(public_tokenizers.path("piece_bpe_32k.model"))


def best_score(model, text):
    """Brute force over all segmentations, from left to right."""
    scores, _, unknown, longest = module._tables(model.model)
    seen = symbols(text)
    best = [0] + [None] * len(seen)
    for j in range(1, len(seen) + 1):
        found = [best[i] + scores[seen[i:j]] for i in range(max(0, j - longest), j) if seen[i:j] in scores]
        if seen[j - 1] not in scores:
            found.append(best[j - 1] + unknown)
        best[j] = max(found)
    return best[-1]


def in_chunks(model, text, size):
    longest = module._tables(model.model)[3]
    chunks = [Chunk(model, *part) for part in cut(text, size, longest)]
    scores = prefixes([c.matrix() for c in chunks])
    state, parts = 0, []
    traced = [c.trace(s[0].tolist()) for c, s in zip(chunks, scores)]
    for begins, tails, joins, ids in reversed(traced):
        parts.append(ids[: joins[state]] + tails[state])
        state = begins[state]
    return [i for part in reversed(parts) for i in part]


@pytest.mark.parametrize("size", [1, 3, 7, 64, 1000])
def test_chunks_give_the_ids_of_the_whole_text(model, size):
    for text in TEXTS:
        assert in_chunks(model, text, size) == model.library.encode(text), text


def test_total_score_is_the_greatest(model):
    scores, _, unknown, _ = module._tables(model.model)
    for text in TEXTS[:9]:
        ids = model.library.encode(text)
        pieces = [model.library.id_to_piece(i) for i in ids]
        known = sum(scores[p] for p in pieces if p in scores)
        missing = sum(c not in scores for c in symbols(text))
        assert known + missing * unknown == best_score(model, text)


def test_products_are_associative(model):
    longest = module._tables(model.model)[3]
    a, b, c = (Chunk(model, *p).matrix() for p in cut("x y zz abc" * 6, 20, longest)[:3])
    assert (combined(combined(a, b), c) == combined(a, combined(b, c))).all()
    assert (prefixes([a, b, c])[2] == combined(a, b)).all()


@pytest.mark.parametrize("chunk", [module.CHUNK, 100])
def test_round_trip(spark, model, chunk):
    df = corpus(spark, list(enumerate(TEXTS + ["", None])))
    for r in decode(encode(df, model, chunk), model).collect():
        assert r.ids == model.library.encode(r.text or "")
        assert r.decoded == (r.text or "")
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())


def test_odd_rows(spark, model):
    df = odd(spark)
    found = decode(encode(df, model, 5000), model)
    rows = found.collect()
    assert found.columns == [c for c in df.columns if c != "ids"] + ["ids", "ids_crc32", "decoded"]
    assert sorted((r.doc_id, r.decoded) for r in rows if r.doc_id) == sorted(
        (r.doc_id, r.text or "") for r in df.collect() if r.doc_id
    )


def test_no_rows(spark, model):
    assert encode(empty(spark), model).collect() == []


@pytest.fixture(scope="module")
def own_library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


@pytest.mark.parametrize("size", [1, 3, 64])
def test_no_merge_crosses_a_cut(own_library, size):
    own = Pieces.of_file(public_tokenizers.path("piece_bpe_32k.model"))
    bare, joined = module._merging(own.model)
    for text in [*TEXTS, " lead trail  ", "▁a ▁▁b"]:
        parts = list(module.cut_between(text, size, joined))
        assert "".join(parts) == symbols(text)
        assert [i for ids in bare.encode(parts) for i in ids] == own_library.encode(text), text
    assert len(list(module.cut_between(TEXTS[7], size, joined))) > 5


@pytest.mark.parametrize("chunk", [module.CHUNK, 100])
def test_own_model_gives_the_ids_of_its_file(spark, own_library, chunk):
    own = Pieces.of_file(public_tokenizers.path("piece_bpe_32k.model"))
    df = corpus(spark, list(enumerate([*TEXTS, "", None])))
    found = decode(encode(df, own, chunk), own).collect()
    assert len(found) == len(TEXTS) + 2
    for r in found:
        assert r.ids == own_library.encode(r.text or "")
        assert r.decoded == (r.text or "")
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())


def test_query_gives_the_ids_of_the_named_model(spark, sf_dir, own_library):
    wanted = {}
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        ids = own_library.encode(r.text or "")
        wanted[r.doc_id] = (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    found = queries.op10_pieces(spark, sf_dir).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_crc32) for r in found} == wanted
