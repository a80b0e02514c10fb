"""Two tokenizers' segmentations of a corpus laid over each other.

A text with a blank in front is cut into tokens by a byte-level file (A) and by a SentencePiece
model (B). Where tokens of both end at the same byte a group ends; two tokens whose bytes overlap
are linked. How often two ids are linked in the whole corpus says how well they correspond.

Equal texts are one: the documents are shuffled by their full text, each distinct text is encoded
and aligned once, its links count as often as it occurs, and what comes of it is joined to the
ids of all its documents.

Neither tokenizer joins over a single blank between two characters that are not blank, so texts
are cut there, and what a chunk gives, links and groups included, is remembered by the task.

What a text's links count in the corpus is looked up in two ways at every size: a bounded number
of the most frequent pairs, which most links hold, goes to every task; the others, of which none
is frequent, meet their counts in a shuffled join.

Defined results: null and empty texts, and texts that either side's tokens do not give back, have
no tokens, zero in every measure and an empty digest; rows that repeat an id are counted and
returned each; strings of special tokens are plain text; an empty table gives no rows. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txscore.llm.tasks import clean_table, map_batches, slices, written_table

#: Chunks that a task remembers, and links in them.
REMEMBERED, REMEMBERED_LINKS = 300_000, 4_000_000
#: Pairs at most whose counts go to every task: the most frequent ones.
HEAD = 1 << 19
BLANK = "▁"

_CUT = re.compile(rf"(?<=[^\s{BLANK}]) (?=[^\s{BLANK}])")
_BYTE = re.compile(r"<0x([0-9A-Fa-f]{2})>")


def byte_letters() -> dict[str, int]:
    """The letters in which a byte-level file writes bytes: printable ones stand for themselves,
    the others take the code points from 256 on in their order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + k): b for k, b in enumerate(rest)}}


class _Tokens:
    """The bytes of each id's token, end to end."""

    def __init__(self, raw: list[bytes]):
        self.size = np.array([len(x) for x in raw], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(raw), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        after = np.cumsum(size)
        return self.data[np.repeat(self.start[ids] - after + size, size)
                         + np.arange(int(after[-1]) if len(after) else 0)]


def _ranges(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions of ranges with these first places and sizes, one range after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(first - ends + sizes, sizes) + np.arange(int(ends[-1]) if len(ends) else 0)


def align(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links of two segmentations of the same bytes, given by where tokens end: which token of A
    and which of B each holds, in their order, and whether both end there."""
    ends = np.union1d(ends_a, ends_b)
    a, b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
    return a, b, (ends_a[a] == ends) & (ends_b[b] == ends)


class Aligner:
    """Encodes texts with both tokenizers and aligns them, remembering chunks."""

    def __init__(self, byte_file: str, piece_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_file)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_file)
        letters = byte_letters()
        raw_a = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            raw_a[i] = bytes(letters[x] for x in token) if all(x in letters for x in token) else token.encode()
        raw_b = []
        for i in range(self.b.get_piece_size()):
            piece, byte = self.b.id_to_piece(i), _BYTE.fullmatch(self.b.id_to_piece(i))
            raw_b.append(bytes([int(byte[1], 16)]) if byte else piece.replace(BLANK, " ").encode())
        self.tokens_a, self.tokens_b = _Tokens(raw_a), _Tokens(raw_b)
        self.width = len(raw_b)  # a pair of ids is one number: a times this, and b
        self._forget()

    def _forget(self) -> None:
        #: A chunk's number: -1 if it is not to be cut here; it may be one that cannot be aligned.
        self.known: dict[str, int] = {}
        self.groups: list[str] = []
        self.links = np.zeros(0, np.int64)
        #: Per chunk: tokens of A, tokens of B, groups, links, and whether both give it back.
        self.counts = np.zeros((0, 5), np.int64)

    def _learn(self, chunks: list[str]) -> None:
        """Encode and align chunks that are new, each after a blank."""
        ids_a = [x.ids for x in self.a.encode_batch_fast([" " + x for x in chunks], add_special_tokens=False)]
        ids_b = self.b.encode(chunks, num_threads=1)
        raw = [b" " + x.encode() for x in chunks]
        size = np.array([len(x) for x in raw])
        data = np.frombuffer(b"".join(raw), np.uint8)
        whole = self._gives_back(self.tokens_a, ids_a, data, size) \
            & self._gives_back(self.tokens_b, ids_b, data, size)
        n_a, n_b = (np.array([len(x) for x in ids], np.int64) * whole for ids in (ids_a, ids_b))
        a = np.array(list(chain.from_iterable(x for x, ok in zip(ids_a, whole) if ok)), np.int64)
        b = np.array(list(chain.from_iterable(x for x, ok in zip(ids_b, whole) if ok)), np.int64)
        ends_a, ends_b = np.cumsum(self.tokens_a.size[a]), np.cumsum(self.tokens_b.size[b])
        of_a, of_b, both = align(ends_a, ends_b)
        chunk = np.repeat(np.arange(len(chunks)), n_a)[of_a]
        n_links = np.bincount(chunk, minlength=len(chunks))
        n_groups = np.bincount(chunk[both], minlength=len(chunks))
        self.known.update(zip(chunks, range(len(self.groups), len(self.groups) + len(chunks))))
        self.groups += self._written(a, b, of_a[both] + 1, of_b[both] + 1, n_groups)
        self.links = np.concatenate([self.links, a[of_a] * self.width + b[of_b]])
        self.counts = np.concatenate([self.counts, np.stack(
            [n_a, n_b, n_groups, n_links, whole.astype(np.int64)], axis=1)])

    @staticmethod
    def _gives_back(tokens: _Tokens, ids: list[list[int]], data: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Which chunks their tokens' bytes are equal to."""
        flat = np.array(list(chain.from_iterable(ids)), np.int64)
        chunk = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
        own = np.bincount(chunk, tokens.size[flat], len(ids)).astype(np.int64)
        same = own == size
        joined = tokens.joined(flat)
        place = np.repeat(np.cumsum(size) - size, np.where(same, size, 0)) \
            + (_ranges(np.zeros(len(size), np.int64), np.where(same, size, 0)))
        of = np.repeat(np.arange(len(size)), np.where(same, size, 0))
        differ = data[place] != joined[np.repeat(same, own)]
        same[of[differ]] = False
        return same

    @staticmethod
    def _written(a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray,
                 n_groups: np.ndarray) -> list[str]:
        """The groups of each chunk as text."""
        names_a, names_b = list(map(str, a.tolist())), list(map(str, b.tolist()))
        parts, x, y = [], 0, 0
        for end_a, end_b in zip(ends_a.tolist(), ends_b.tolist()):
            parts.append(f"{names_a[x] if end_a == x + 1 else ','.join(names_a[x:end_a])}|"
                         f"{names_b[y] if end_b == y + 1 else ','.join(names_b[y:end_b])}")
            x, y = end_a, end_b
        written, at = [], 0
        for count in n_groups.tolist():
            written.append(parts[at] if count == 1 else ";".join(parts[at:at + count]))
            at += count
        return written

    def _cut(self, text: str) -> list[str]:
        chunks = text.split(" ")
        if all(x and x[0] != BLANK and x[-1] != BLANK and not x[0].isspace() and not x[-1].isspace()
               for x in chunks):
            return chunks
        return _CUT.split(text)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """For each text the counts (tokens of A and B, groups, links, whether it can be given
        back) and the digest of its groups; all links, and which text each belongs to."""
        if len(self.groups) > REMEMBERED or len(self.links) > REMEMBERED_LINKS:
            self._forget()
        cut = [self._cut(text) for text in texts]
        new = set().union(*cut)
        new.difference_update(self.known)
        ordered = list(new)
        for k in range(0, len(ordered), 4096):
            self._learn(ordered[k:k + 4096])
        sizes = np.array([len(own) for own in cut], np.int64)
        number = np.fromiter(map(self.known.__getitem__, chain.from_iterable(cut)), np.int64, int(sizes.sum()))
        first = np.cumsum(sizes) - sizes  # a text that is not null has a chunk at least
        counts = np.add.reduceat(self.counts[number], first, axis=0) if len(texts) else self.counts[:0]
        whole = counts[:, 4] == sizes
        counts = np.where(whole[:, None], counts, 0)
        counts[:, 4] = whole
        digests = []
        for own, ok in zip(cut, whole.tolist()):
            written = ";".join([self.groups[self.known[x]] for x in own]) if ok else ""
            digests.append(hashlib.sha256(written.encode()).hexdigest() if ok else "")
        number = number[np.repeat(whole, sizes)]
        n_links = self.counts[number, 3]
        links = self.links[_ranges((np.cumsum(self.counts[:, 3]) - self.counts[:, 3])[number], n_links)]
        return counts, digests, links, np.repeat(np.arange(len(texts)), counts[:, 3])


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(byte_file: str, piece_file: str) -> Aligner:
    """The worker's aligner of these files, with what it remembers from earlier tasks."""
    key = (byte_file, piece_file)
    if key not in _aligners:
        _aligners.clear()
        _aligners[key] = Aligner(*key)
    return _aligners[key]


_MEASURES = ["n_a", "n_b", "n_groups", "n_links"]
_ALIGNED = ("key binary, copies long, n_a long, n_b long, n_groups long, n_links long, "
            "groups_sha256 string, pairs array<long>, times array<int>")


def _aligning(byte_file: str, piece_file: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(byte_file, piece_file)
        for batch in batches:
            for rows, _, _ in slices(batch):
                counts, digests, links, text = own.encode(rows.column("text").to_pylist())
                order = np.lexsort((links, text))
                links, text = links[order], text[order]
                new = np.flatnonzero(np.r_[True, (links[1:] != links[:-1]) | (text[1:] != text[:-1])][:len(links)])
                ends = np.r_[0, np.cumsum(np.bincount(text[new], minlength=rows.num_rows))].astype(np.int32)
                yield pa.RecordBatch.from_pydict({
                    "key": rows.column("key"), "copies": rows.column("copies"),
                    **{name: pa.array(counts[:, k]) for k, name in enumerate(_MEASURES)},
                    "groups_sha256": pa.array(digests, pa.string()),
                    "pairs": pa.ListArray.from_arrays(ends, links[new]),
                    "times": pa.ListArray.from_arrays(
                        ends, np.diff(new, append=len(links)).astype(np.int32))})

    return work


def _looking_up(head):
    """Sums of a text's links over the pairs that every task knows, and its other pairs."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts, best = head.value
        for batch in batches:
            column, times = batch.column("pairs"), batch.column("times").flatten().to_numpy().astype(np.int64)
            flat = column.flatten().to_numpy()
            row = np.repeat(np.arange(len(column)), column.value_lengths().to_numpy())
            at = np.minimum(np.searchsorted(pairs, flat), max(0, len(pairs) - 1))
            here = pairs[at] == flat if len(pairs) else np.zeros(len(flat), bool)
            at, seen = at[here], times[here]
            total = np.zeros((len(column), 2), np.int64)
            np.add.at(total[:, 0], row[here], seen * best[at])
            np.add.at(total[:, 1], row[here], seen * counts[at])
            rest = np.r_[0, np.cumsum(np.bincount(row[~here], minlength=len(column)))].astype(np.int32)
            yield pa.RecordBatch.from_pydict({
                "row": batch.column("row"), "n_best": pa.array(total[:, 0]), "count_sum": pa.array(total[:, 1]),
                "pairs": pa.ListArray.from_arrays(rest, flat[~here]),
                "times": pa.ListArray.from_arrays(rest, times[~here].astype(np.int32))})

    return work


def pair_counts(aligned: DataFrame, width: int) -> DataFrame:
    """(pair, count, best): how many links of the corpus hold each pair of ids, and whether no
    other id of A is linked with the pair's id of B more often."""
    counts = written_table(
        aligned.select("copies", F.explode(F.arrays_zip("pairs", "times")).alias("p"))
        .groupBy(F.col("p.pairs").alias("pair")).agg(F.sum(F.col("p.times") * F.col("copies")).alias("count")),
        "pair-counts")
    counts = counts.withColumn("b", F.pmod("pair", F.lit(width)))
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    # One row per id of B.
    return counts.join(F.broadcast(most), "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def _head_bound(counts: DataFrame, head: int) -> int:
    """The least count, a step of a fine scale, that at most `head` pairs reach."""
    step = F.floor(F.log2("count") * 8).cast("int")
    sizes = counts.groupBy(step.alias("step")).agg(F.count("*").alias("n"), F.min("count").alias("least")).collect()
    bound, room = None, head
    for row in sorted(sizes, key=lambda r: -r.step):
        room -= row.n
        if room < 0:
            break
        bound = row.least
    return bound if bound is not None else (1 << 62)


def text_key(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def align_tokens(docs: DataFrame, byte_file: str, piece_file: str, head: int = HEAD) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of each document
    (doc_id, text); the files are paths on every machine."""
    import sentencepiece

    spark = docs.sparkSession
    own = clean_table(docs, doc_id="doc_id", text="text")
    texts = own.filter("text <> ''").groupBy("text").agg(F.count("*").alias("copies"))
    aligned = map_batches(texts.select(text_key(F.col("text")).alias("key"), "copies", "text"),
                          _aligning(byte_file, piece_file), _ALIGNED)
    aligned = written_table(aligned.select(F.monotonically_increasing_id().alias("row"), "*"), "aligned")

    width = sentencepiece.SentencePieceProcessor(model_file=piece_file).get_piece_size()
    counts = written_table(pair_counts(aligned, width), "pairs")
    bound = _head_bound(counts, head)
    known = counts.filter(F.col("count") >= bound).orderBy("pair").toArrow()
    shared = spark.sparkContext.broadcast(tuple(known[name].to_numpy() for name in ("pair", "count", "best")))
    looked_up = written_table(map_batches(
        aligned.select("row", "pairs", "times"), _looking_up(shared),
        "row long, n_best long, count_sum long, pairs array<long>, times array<int>"), "looked-up")
    rest = looked_up.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select(
        "row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    rest = rest.join(counts.filter(F.col("count") < bound), "pair").select(
        "row", (F.col("times") * F.col("best").cast("long")).alias("n_best"),
        (F.col("times") * F.col("count")).alias("count_sum"))
    sums = looked_up.select("row", "n_best", "count_sum").union(rest).groupBy("row").agg(
        F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    measured = aligned.select("row", "key", *_MEASURES, "groups_sha256").join(sums, "row").drop("row")
    numbers = [*_MEASURES, "n_best", "count_sum"]
    return own.select("doc_id", F.when(F.col("text") != "", text_key(F.col("text"))).alias("key")).join(
        measured, "key", "left").select(
        "doc_id", *(F.coalesce(name, F.lit(0)).alias(name) for name in numbers),
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
