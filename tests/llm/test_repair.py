"""Token shards: the ids of the tokenizers library, and Re-Pair's exact round trip."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from txscore.llm.queries import QUERIES, tokenizer_file
from txscore.llm.repair import (END_ID, Shard, TextEncoder, pack, read_ids, read_shards, rule_lengths, write_ids)


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))


def expected(tokenizer, rows):
    start, result = 0, []
    for i, text in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [END_ID], np.uint32)
        result.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return result


def test_query_matches_the_library(spark, sf_dir, documents, tokenizer):
    rows = QUERIES["op1_repair"](spark, sf_dir).collect()
    assert sorted(tuple(r) for r in rows) == expected(tokenizer, sorted(documents))


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("ab'1 \n\t  é\x1cs")), max_size=30), min_size=1, max_size=4))
def test_careful_cuts_do_not_change_ids(tokenizer, texts):
    ids, counts = ENCODER.encode(texts)
    own = [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
    assert own == [tokenizer.encode(x, add_special_tokens=False).ids + [END_ID] for x in texts]


ENCODER = TextEncoder(tokenizer_file("byte_bpe_50k.json"))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 5), max_size=40), min_size=1, max_size=6), st.sampled_from([6, 70_000]),
       st.integers(0, 10), st.data())
def test_pack_and_expand(docs, first_rule, rounds, data):
    symbols = np.array([x for own in docs for x in (*own, 2)], np.int64)
    last = np.zeros(len(symbols), bool)
    last[np.cumsum([len(own) + 1 for own in docs]) - 1] = True
    left, marks, rules = pack(symbols, last, first_rule, rounds, least=2)
    shard = Shard({"first_rule": first_rule, "width": 4, "symbols": left.astype(np.uint32).tobytes(),
                   "rules": rules.astype(np.uint32).tobytes(),
                   "lengths": rule_lengths(rules, first_rule).astype(np.uint32).tobytes(),
                   "ends": (np.flatnonzero(marks) + 1).astype(np.uint32).tobytes(),
                   "doc_ids": np.arange(len(docs)).tobytes(), "null_ids": bytes(len(docs))})
    ids, ends = shard.ids()
    assert ids.tolist() == symbols.tolist()
    assert ends.tolist() == np.cumsum([len(own) + 1 for own in docs]).tolist()
    a = data.draw(st.integers(0, len(symbols)))
    b = data.draw(st.integers(a, len(symbols)))
    assert shard.ids_between(a, b) == symbols[a:b].tolist()


def test_frequent_pairs_are_replaced():
    symbols = np.array(([1, 3, 4, 5] * 50 + [2]) * 4, np.int64)
    left, _, rules = pack(symbols, symbols == 2, 10, rounds=8, least=4)
    assert len(left) < len(symbols) / 3 and len(rules) >= 2


def test_edges(spark, edge_docs, no_docs, tokenizer, tmp_path):
    path = str(tmp_path / "ids")
    write_ids(edge_docs, path, tokenizer_file("byte_bpe_50k.json"), parts=3, shard_tokens=200)
    shards = read_shards(spark, path)
    assert shards.count() > 3
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    assert sorted((tuple(r) for r in read_ids(spark, path).collect()), key=lambda r: r[1]) == expected(tokenizer, rows)
    write_ids(no_docs, path + "0", tokenizer_file("byte_bpe_50k.json"))
    assert read_ids(spark, path + "0").collect() == []


def test_no_frequent_pair_is_left():
    rng = np.random.default_rng(3)
    passage = rng.integers(10, 400, 200).tolist()
    docs = [passage + rng.integers(10, 400, 30).tolist() + [5] * 60 for _ in range(30)]
    symbols = np.array([x for own in docs for x in (*own, 2)], np.int64)
    last = np.zeros(len(symbols), bool)
    last[np.cumsum([len(own) + 1 for own in docs]) - 1] = True
    left, marks, rules = pack(symbols, last, 400)
    counts, used = {}, -1
    for k in range(len(left) - 1):
        pair = (int(left[k]), int(left[k + 1]))
        if not marks[k] and (pair[0] != pair[1] or used != k - 1 or left[k - 1] != left[k]):
            counts[pair] = counts.get(pair, 0) + 1
            used = k
    assert max(counts.values(), default=0) < 8
    assert rule_lengths(rules, 400).max() >= 128 and len(left) < len(symbols) / 5
    shard = Shard({"first_rule": 400, "width": 4, "symbols": left.astype(np.uint32).tobytes(),
                   "rules": rules.astype(np.uint32).tobytes(),
                   "lengths": rule_lengths(rules, 400).astype(np.uint32).tobytes(),
                   "ends": (np.flatnonzero(marks) + 1).astype(np.uint32).tobytes(),
                   "doc_ids": np.arange(len(docs)).tobytes(), "null_ids": bytes(len(docs))})
    assert shard.ids()[0].tolist() == symbols.tolist()


SPECIAL = ["x <|endoftext|> y", "<|endoftext|>", "a<|endoftext|>b  <|endoftext|>", "<|endoftext", "plain words here"]


def test_special_tokens_are_those_of_the_library(make_docs, spark, tokenizer, tmp_path):
    assert 50256 in tokenizer.encode(SPECIAL[0], add_special_tokens=False).ids
    ids, counts = TextEncoder(tokenizer_file("byte_bpe_50k.json")).encode(SPECIAL + SPECIAL[:1])
    own = [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
    assert own == [tokenizer.encode(x, add_special_tokens=False).ids + [END_ID] for x in SPECIAL + SPECIAL[:1]]
    rows = list(enumerate(SPECIAL))
    write_ids(make_docs(rows), str(tmp_path / "ids"), tokenizer_file("byte_bpe_50k.json"), parts=2)
    assert sorted(tuple(r) for r in read_ids(spark, str(tmp_path / "ids")).collect()) == expected(tokenizer, rows)


def test_rules_go_on_in_wider_symbols(monkeypatch):
    import txscore.llm.repair as module

    rng = np.random.default_rng(8)
    symbols = np.tile(rng.integers(0, 300, 20_000), 8)
    last = np.zeros(len(symbols), bool)
    last[19_999::20_000] = True
    once = pack(symbols, last.copy(), 300)
    assert len(once[2]) > 5000
    monkeypatch.setattr(module, "MOST_NARROW", 1000)
    left, marks, rules = pack(symbols, last.copy(), 300)
    assert len(rules) > 5000 and len(left) <= 8 * 8
    shard = Shard({"first_rule": 300, "width": 4, "symbols": left.astype(np.uint32).tobytes(),
                   "rules": rules.astype(np.uint32).tobytes(),
                   "lengths": rule_lengths(rules, 300).astype(np.uint32).tobytes(),
                   "ends": (np.flatnonzero(marks) + 1).astype(np.uint32).tobytes(),
                   "doc_ids": np.arange(8).tobytes(), "null_ids": bytes(8)})
    assert shard.ids()[0].tolist() == symbols.tolist()


def test_letters_and_what_follows_are_encoded_once_each():
    import random

    from tokenizers import Tokenizer

    path = tokenizer_file("byte_bpe_50k.json")
    encoder, library = TextEncoder(path), Tokenizer.from_file(path)
    words = ["alpha", "beta", "été"]
    encoder.encode([" ".join(f"x {word}{end}" for word in words for end in (".", ",", ";", "!", "?"))])
    assert len(encoder.known) <= 2 + len(words) + 5  # not one for each word with each sign

    signs = ["a", "Zb", "the", " ", " ", "  ", "\n", "\t", ".", "'", "'s", "'re", "’", "é", "ß", "×", "ª",
             "中", "　", " ", "\u0085", " ", "\x1c", "​", "1", "²", "_", "Ж", "Ω", "΢",
             "é", "ɐ", "\U0001F642", "<|endoftext|>", "\r\n", "᠎", "Ġ", "\x00", "ﬁ"]
    rng = random.Random(1)
    for _ in range(400):
        texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(14))) for _ in range(rng.randrange(1, 6))]
        ids, counts = encoder.encode(texts)
        want = [x.ids + [END_ID] for x in library.encode_batch(texts, add_special_tokens=False)]
        assert ids.tolist() == [x for own in want for x in own] and counts.tolist() == list(map(len, want)), texts
