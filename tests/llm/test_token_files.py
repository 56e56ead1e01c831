import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from corpus import corpus, empty, odd
from tokenizers import Tokenizer

from orderlake.llm import token_files
from orderlake.llm.shingles import pieces, raw_bytes
from orderlake.llm.token_files import Grammar, Shard, packed, round_trip
from orderlake.llm.unit_cache import UnitCache

ODD_TEXTS = [
    "", "'s it's 'see a.'s ,'s", "naïve café é é ≠ ≠ İstanbul ΑΣ.", "a<|endoftext|>b",
    "<|STARTOFTEXT|>", "x y z w", "12ab34 a1.b2", "日本語。テスト…", "don't.'\"you're", "\x1c\x85\xa0a",
    "Same same. SAME, same", "###$$$ %%%a", "á'S 'LL", "﻿ x",
]


@pytest.fixture(scope="module")
def tokenizer_json():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        return file.read()


def test_units_give_the_tokenizers_ids(tokenizer_json, monkeypatch):
    cache, library = UnitCache(tokenizer_json), Tokenizer.from_str(tokenizer_json)
    texts = ODD_TEXTS + [" ".join(ODD_TEXTS[:3] + ODD_TEXTS[5:]) * 20]
    data, offsets = raw_bytes(pa.array(texts))
    wanted = [library.encode(t, add_special_tokens=False).ids for t in texts]
    monkeypatch.setattr("orderlake.llm.unit_cache.MOST_UNITS", 10)
    for _ in range(2):
        found = [ids for a, b in pieces(offsets, 300) for ids in cache.encode(data, offsets[a : b + 1])]
        assert [ids.tolist() for ids in found] == wanted


def test_marks_that_join_small_letters_only(tokenizer_json):
    cache, library = UnitCache(tokenizer_json), Tokenizer.from_str(tokenizer_json)
    pairs = ["H\u0331", "T\u0308", "W\u030a", "Y\u030a", "J\u030c", "T\u0344"]
    texts = pairs + [p.lower() for p in pairs] + [f"AB {p}x, É CD{p}.EF,{p}" for p in pairs] + ["A", "É"]
    data, offsets = raw_bytes(pa.array(texts))
    wanted = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids.tolist() for ids in cache.encode(data, offsets)] == wanted


@pytest.mark.parametrize("n", [0, 1, 5, 400])
def test_shard_round_trip_and_random_access(n):
    rng = np.random.default_rng(n)
    phrase = rng.integers(0, 300, 40).astype(np.uint32)
    lists = [
        np.concatenate([np.tile(phrase, rng.integers(0, 6)), rng.integers(0, 300, rng.integers(0, 9)), [2]]).astype(np.uint32)
        for _ in range(n)
    ]
    lists += [np.full(1000, 7, np.uint32)]
    ids = [None, *range(n)]
    made = packed(ids, lists, 300)
    opened = Shard(made)
    assert [None if m else int(d) for d, m in zip(opened.doc_ids, opened.missing)] == ids
    assert opened.ids().tolist() == np.concatenate(lists).tolist()
    for k, tokens in enumerate(lists):
        assert opened.document(k).tolist() == tokens.tolist()
        assert [opened.at(k, j) for j in range(len(tokens))] == tokens.tolist()
    flat, starts, lengths = opened.grammar.expansions()
    assert n < 400 or len(made) < 2 * sum(map(len, lists))
    assert (lengths[300:] > 1).all() and len(flat) == lengths.sum()


def test_a_file_of_another_kind_is_refused():
    with pytest.raises(ValueError):
        Shard(b"something else")


def expected(rows, tokenizer_json):
    library, at, found = Tokenizer.from_str(tokenizer_json), 0, []
    for doc_id, text in rows:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        found.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return found


@pytest.mark.parametrize("shard_ids", [token_files.SHARD_IDS, 50])
def test_documents_in_order(spark, tokenizer_json, monkeypatch, shard_ids):
    monkeypatch.setattr(token_files, "SHARD_IDS", shard_ids)
    rows = [(i * 37 % 501 - 100, t) for i, t in enumerate(ODD_TEXTS * 20)]
    found = round_trip(corpus(spark, rows), tokenizer_json).orderBy("start").collect()
    assert list(map(tuple, found)) == expected(sorted(rows), tokenizer_json)


def test_odd_rows(spark, tokenizer_json):
    df = odd(spark)
    found = round_trip(df, tokenizer_json).orderBy("start").collect()
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert [r.doc_id for r in found] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i))
    sizes = sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in found if r.doc_id is not None)
    wanted = expected([r for r in rows if r[0] is not None], tokenizer_json)
    assert sizes == sorted((i, n, c) for i, _, n, c in wanted)
    starts = np.cumsum([0] + [r.n_tokens for r in found])[:-1]
    assert [r.start for r in found] == starts.tolist()


def test_no_rows(spark, tokenizer_json):
    assert round_trip(empty(spark), tokenizer_json).collect() == []


def test_units_that_hash_alike_keep_their_own_ids(tokenizer_json, monkeypatch):
    """Also where the hash tells nothing apart."""
    word = [0]
    while len(word) < 1024:
        word += [1 - x for x in word]
    texts = ["".join(s[x] for x in word) for s in ("ab", "ba")] + ["one two three", "two one, one"]
    library = Tokenizer.from_str(tokenizer_json)
    wanted = [library.encode(t, add_special_tokens=False).ids for t in texts]
    data, offsets = raw_bytes(pa.array(texts))
    assert [ids.tolist() for ids in UnitCache(tokenizer_json).encode(data, offsets)] == wanted
    monkeypatch.setattr("orderlake.llm.unit_cache.hashed_spans", lambda data, begins, ends: ends - begins)
    assert [ids.tolist() for ids in UnitCache(tokenizer_json).encode(data, offsets)] == wanted


def test_ids_that_do_not_fit_are_refused():
    with pytest.raises(ValueError, match="16 bits"):
        packed([1], [np.array([70000], np.uint32)], 70001)
    with pytest.raises(ValueError, match="16 bits"):
        packed([1], [np.array([12], np.uint32)], 12)


def fed(cache, monkeypatch):
    """The texts that ``cache`` gives to the library, in a list that grows."""
    texts, encode = [], cache._encode_each
    monkeypatch.setattr(cache, "_encode_each", lambda units: texts.extend(units) or encode(units))
    return texts


def test_units_in_use_are_not_forgotten(tokenizer_json, monkeypatch):
    monkeypatch.setattr("orderlake.llm.unit_cache.MOST_UNITS", 10)
    cache, library = UnitCache(tokenizer_json), Tokenizer.from_str(tokenizer_json)
    texts = fed(cache, monkeypatch)
    once = ["zero", "seven", "eight", "nine", "ten", "twelve", "forty", "fifty", "sixty", "ninety"] * 2
    once += [a + b for a in once[:10] for b in once[:10]]
    for k in range(0, len(once), 2):
        line = f"common {once[k]} words {once[k + 1]}"
        data, offsets = raw_bytes(pa.array([line]))
        assert cache.encode(data, offsets)[0].tolist() == library.encode(line, add_special_tokens=False).ids
        assert len(cache.known) <= 10 + 4
        assert len(cache.known) == len(cache.starts) == len(cache.lengths)
        assert cache.lengths.sum() == len(cache.flat)
    assert sum("common" in text.split() for text in texts) == 1


def test_a_special_opening_in_one_row_leaves_the_others_together(tokenizer_json, monkeypatch):
    cache, library = UnitCache(tokenizer_json), Tokenizer.from_str(tokenizer_json)
    calls, plain = [], cache._encode_plain
    monkeypatch.setattr(cache, "_encode_plain", lambda *args: calls.append(1) or plain(*args))
    rows = ["one two", "a <", "| b", "f <| x <|endoftext|>y", "", "TWO one"] * 3
    data, offsets = raw_bytes(pa.array(rows))
    wanted = [library.encode(t, add_special_tokens=False).ids for t in rows]
    assert [ids.tolist() for ids in cache.encode(data, offsets)] == wanted
    assert len(calls) == 1


def test_capitals_stay_in_units_with_other_letters_alone(tokenizer_json):
    rows = [" \t\nÉA BC", "AB.CÉ D.E", "Á B", "ÀB\n \nC", "Q"]
    data, offsets = raw_bytes(pa.array(rows))
    begins, ends = UnitCache._units(data, offsets)
    folded = UnitCache._folded(data, begins)
    found = [folded[a:b].tobytes().decode() for a, b in zip(begins, ends)]
    assert found == ["ÉA", "bc", "ab", ".", "CÉ", "d", ".", "e", "Á", "b", "ÀB", "c", "q"]


def test_a_rule_for_a_later_symbol_is_refused():
    one = np.array([1], np.uint32)
    with pytest.raises(ValueError, match="later symbol"):
        Grammar(3, one * 4, one, one * 2).expansions()
