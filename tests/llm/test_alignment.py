"""Token alignment against the libraries on whole texts and every overlap looked for."""

import hashlib
from collections import Counter

import pytest
import sentencepiece
from brute import prose
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from txscore.llm.alignment import Aligner, align_tokens, byte_letters
from txscore.llm.queries import QUERIES, piece_model, tokenizer_file

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
WEIRD = ["<|endoftext|> and <s> </s> <unk> <0x41>", "a  b", " a", "a ", "   ", "\n\n x\t\ty \r\n z", "tab\tin",
         "a▁b", "x \x00 y", "﻿mark", "wide　blank \xa0 and more", "é́ 漢字 😀👩‍💻 x",
         "x" * 3000, "if (a) {\r\n  return;\r\n}", " ́x", "\x85next line \x1c sep"]


@pytest.fixture(scope="module")
def files():
    return tokenizer_file("byte_bpe_50k.json"), piece_model()


@pytest.fixture(scope="module")
def plain(files):
    """Rows by the libraries on whole texts, all links by comparing ranges of bytes."""
    a = Tokenizer.from_file(files[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=files[1])
    letters = byte_letters()

    def spans(raw):
        ends, at = [], 0
        for x in raw:
            ends.append((at, at + len(x)))
            at += len(x)
        return ends

    def rows(docs):
        measured, counts = [], Counter()
        for doc_id, text in docs:
            ids_a = ids_b = []
            if text:
                wanted = (" " + text).encode()
                found = a.encode(" " + text, add_special_tokens=False)
                ids_a, ids_b = found.ids, b.encode(text)
                raw_a = [bytes(letters[x] for x in token) for token in found.tokens]
                raw_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
                         for i in ids_b for p in [b.id_to_piece(i)]]
                if b"".join(raw_a) != wanted or b"".join(raw_b) != wanted:
                    ids_a = ids_b = []
            links, groups = [], []
            if ids_a:
                spans_a, spans_b = spans(raw_a), spans(raw_b)
                y = 0
                for x, (begin, end) in enumerate(spans_a):
                    while spans_b[y][1] <= begin:
                        y += 1
                    k = y
                    while k < len(spans_b) and spans_b[k][0] < end:
                        links.append((ids_a[x], ids_b[k]))
                        k += 1
                cuts = sorted({e for _, e in spans_a} & {e for _, e in spans_b})
                x = y = 0
                for cut in cuts:
                    own = [[], []]
                    while x < len(ids_a) and spans_a[x][1] <= cut:
                        own[0].append(str(ids_a[x]))
                        x += 1
                    while y < len(ids_b) and spans_b[y][1] <= cut:
                        own[1].append(str(ids_b[y]))
                        y += 1
                    groups.append("|".join(map(",".join, own)))
            counts.update(links)
            digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if ids_a else ""
            measured.append((doc_id, len(ids_a), len(ids_b), len(groups), links, digest))
        most = Counter()
        for (_, y), n in counts.items():
            most[y] = max(most[y], n)
        return sorted(((i, n_a, n_b, n_groups, len(links), sum(counts[p] == most[p[1]] for p in links),
                        sum(counts[p] for p in links), digest)
                       for i, n_a, n_b, n_groups, links, digest in measured), key=str)

    return rows


def rows_of(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=str)


def test_query_over_the_small_table(spark, sf_dir, documents, plain):
    assert rows_of(QUERIES["op13_exact_text_alignment"](spark, sf_dir)) == plain(documents)


@pytest.mark.parametrize("head", [0, 40, 1 << 19])
def test_weird_texts_copies_and_any_number_of_pairs_known(make_docs, files, plain, head):
    rows = [*enumerate(WEIRD), (100, WEIRD[0]), (101, WEIRD[0]), (101, prose(1, 50)), (102, None), (103, "")]
    got = rows_of(align_tokens(make_docs(rows).repartition(3), *files, head=head))
    assert got == plain(rows)
    assert {r[1] > 0 for r in got if r[0] == WEIRD.index("a▁b")} == {False}


def test_what_is_remembered_does_not_matter(files, documents):
    own, texts = Aligner(*files), [t or "" for _, t in documents[:40]] + WEIRD
    both = own.encode(texts)
    again = own.encode(texts)
    for x, y in zip(both, again):
        assert list(map(str, x)) == list(map(str, y))
    alone = [Aligner.encode(own, [t]) for t in texts]
    assert [x[1][0] for x in alone] == both[1]


def test_hot_text_counts_as_often_as_it_occurs(spark, files, plain):
    rows = [(i, "the same text again" if i % 3 else f"other text {i}") for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert rows_of(align_tokens(df, *files)) == plain(rows)


def test_edges(edge_docs, no_docs, files, plain):
    short = edge_docs.filter("text is null or length(text) < 100000")
    rows = [(r.doc_id, r.text) for r in short.select("doc_id", "text").collect()]
    got = rows_of(align_tokens(edge_docs, *files))
    assert len(got) == edge_docs.count()
    assert rows_of(align_tokens(short, *files)) == plain(rows)
    assert align_tokens(no_docs, *files).collect() == []
    assert align_tokens(edge_docs.filter(F.col("text").isNull()), *files).filter("n_a > 0").count() == 0
