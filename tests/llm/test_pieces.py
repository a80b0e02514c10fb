"""SentencePiece segmentation: the library's without dropout, and lossless with it."""

import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from txscore.llm.pieces import Encoder, agenda, chunk_keys, decode, decode_ids, encode, load, side_by_side, variant_of
from txscore.llm.queries import QUERIES, piece_model

PATH = piece_model()


def cut(ids, counts):
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_no_dropout_is_the_library(documents, library):
    texts = [t for _, t in documents if t and "▁" not in t]
    assert cut(*Encoder(PATH, 0.0, 0).encode(texts, [0] * len(texts))) == [library.encode(t) for t in texts]


def test_query_is_lossless(spark, sf_dir, documents):
    rows = QUERIES["op10_merge_dropout"](spark, sf_dir).collect()
    assert len(rows) == len(documents) and all(r.lossless for r in rows)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=60), min_size=1, max_size=5), st.floats(0, 1), st.integers(0, 9))
def test_any_text_comes_back(texts, dropout, seed):
    encoder = Encoder(PATH, dropout, seed)
    for text, ids in zip(texts, cut(*encoder.encode(texts, list(range(len(texts)))))):
        assert decode_ids(load(PATH), np.array(ids)) == text


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("aeinrst▁é漢 ")), min_size=1, max_size=30), min_size=1, max_size=8),
       st.floats(0, 0.9), st.integers(0, 9))
def test_side_by_side_is_the_agenda(chunks, dropout, seed):
    assert cut(*side_by_side(load(PATH), chunks, seed, dropout)) == [
        agenda(load(PATH), c, seed, dropout) for c in chunks]


def test_dropout_varies_and_repeats(documents):
    texts = [t for _, t in documents][:40]
    plain = cut(*Encoder(PATH, 0.0, 0).encode(texts, [0] * 40))
    one = cut(*Encoder(PATH, 0.1, 1).encode(texts, [0] * 40))
    again = cut(*Encoder(PATH, 0.1, 1).encode(texts, [0] * 40))
    other = cut(*Encoder(PATH, 0.1, 2).encode(texts, [0] * 40))
    variant = cut(*Encoder(PATH, 0.1, 1).encode(texts, [1] * 40))
    assert one == again and one != other and one != variant
    assert sum(map(len, one)) > sum(map(len, plain))
    characters = cut(*Encoder(PATH, 1.0, 1).encode(["plain text"], [0]))[0]
    assert len(characters) == len(" plain text")


def test_variants_depend_on_id_and_seed():
    ids = list(range(400))
    assert variant_of(ids, 3, 4) == variant_of(ids, 3, 4) != variant_of(ids, 4, 4)
    assert set(variant_of(ids, 3, 4)) == {0, 1, 2, 3}


def test_edges(edge_docs, no_docs):
    rows = decode(encode(edge_docs, PATH), PATH).collect()
    expected = sorted(((r.doc_id, r.text) for r in edge_docs.collect()), key=str)
    assert sorted(((r.doc_id, r.text) for r in rows), key=str) == expected
    assert {r.doc_id: r.ids for r in rows}[1] is None and len({r.doc_id: r.ids for r in rows}[2]) == 1
    assert decode(encode(no_docs, PATH), PATH).collect() == []


def test_a_word_is_cut_anew_in_every_document_and_place():
    word = "internationalization"
    ids, counts = Encoder(PATH, 0.1, 0).encode([f"{word} {word}"] * 300, list(range(300)))
    pool = load(PATH)
    inside, firsts, same = set(), set(), 0
    for own in cut(ids, counts):
        pieces = [pool.raw[i].decode() for i in own]
        half = next(k for k in range(1, len(pieces)) if "".join(pieces[:k]) == " " + word)
        firsts.add(tuple(pieces[:half]))
        inside.add(tuple(pieces[half:]))
        same += pieces[:half] == pieces[half:]
    assert len(firsts) > 10 and len(inside) > 10 and same < 300


@pytest.mark.parametrize("dropout", [0.1, 0.5])
def test_remembered_results_are_the_agenda(documents, dropout):
    texts = [t or "" for _, t in documents][:60] + ["a " + "x" * 60 + " b" + "c" * 47, ""]
    encoder = Encoder(PATH, dropout, 3)
    chunks = [re.findall(" +[^ ]*", " " + t) for t in texts]
    for numbers in (range(62), range(100, 162)):
        keys = iter(chunk_keys(list(numbers), [len(own) for own in chunks], 3).tolist())
        expected = [[i for c in own for i in agenda(load(PATH), c, next(keys), dropout)] for own in chunks]
        assert cut(*encoder.encode(texts, list(numbers))) == expected


def test_results_wanted_once_are_not_remembered():
    words = [f"unrepeatable{k}x" for k in range(200)]
    encoder = Encoder(PATH, 0.3, 3)
    keys = chunk_keys([5], [200], 3).tolist()
    ids, _ = encoder.encode([" ".join(words)], [5])
    assert ids.tolist() == [i for w, k in zip(words, keys) for i in agenda(load(PATH), " " + w, k, 0.3)]
    assert not encoder.next
    encoder.encode(["again " * 500], [6])
    assert encoder.next


def test_ids_depend_on_the_document(make_docs):
    text = "internationalization of characteristically unpredictable vocabulary " * 3
    rows = encode(make_docs([(i, text) for i in range(40)]), PATH).collect()
    assert len({tuple(r.ids) for r in rows}) > 30
    again = encode(make_docs([(i, text) for i in range(39, -1, -1)]), PATH).collect()
    assert {r.doc_id: r.ids for r in rows} == {r.doc_id: r.ids for r in again}


def test_a_chunk_is_looked_up_once_however_often_it_stands():
    class Counting(dict):
        asked = 0

        def __getitem__(self, chunk):
            self.asked += 1
            return super().__getitem__(chunk)

    path = PATH
    encoder = Encoder(path, 0.1, 0)
    encoder.known = Counting()
    text = "one two " * 500
    ids, counts = encoder.encode([text, "", text], [1, 2, 3])
    assert encoder.known.asked <= 10
    assert counts.sum() == len(ids) and decode_ids(load(path), ids[:counts[0]]) == text


def test_joins_by_hash_are_those_of_the_model():
    pieces = load(PATH)
    rng = np.random.default_rng(0)
    left, right = rng.integers(-1, pieces.count, (2, 200_000)).astype(np.int32)
    keys = pieces.keys
    left = np.r_[left, (keys // pieces.count).astype(np.int32)]
    right = np.r_[right, (keys % pieces.count).astype(np.int32)]
    want = [-1 if a < 0 or b < 0 else pieces.join_of.get(a * pieces.count + b, -1)
            for a, b in zip(left.tolist(), right.tolist())]
    assert pieces.join(left, right).tolist() == want
    # Most keys are found at their slot, without a search.
    assert np.count_nonzero(pieces.slots[pieces._slot(keys)] == np.arange(len(keys))) > 0.8 * len(keys)
