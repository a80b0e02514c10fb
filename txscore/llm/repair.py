"""Token ids in grammar-compressed shards (Re-Pair).

Texts are encoded, each followed by an end id, and laid in ascending id order into shards of a
bounded number of tokens. In each shard the most frequent pairs of neighbouring symbols are
repeatedly replaced by new symbols; a round replaces all frequent pairs that cannot overlap one
another, and rounds go on until no pair is frequent. In a run of one
symbol every other pair counts and is replaced. No pair reaches over the end of a document.
Symbols are packed as 16-bit numbers as long as they fit, and as 32-bit ones from then on.

The file format is a table with a row per shard: `part` and `shard` give the order; `rules` has
the left and right symbol of each new symbol, `lengths` how many ids each stands for, `symbols`
the documents' symbols end to end, `ends` the documents' ends in them (all little-endian), and
`doc_ids` the documents. Symbols are unsigned 16-bit numbers where they fit, else 32-bit ones;
`width` says which. The lengths let `ids_between` decode any range without the rest.

Defined results: null and empty texts have the end id only; a null id comes before all others;
rows that repeat an id follow each other, by text; an empty table gives no shards. Other
columns are not read.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain, count as counting

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txscore.llm.tasks import SLICE_BYTES, clean_table, map_batches, shared_dir, slices, text_bytes

END_ID = 2
#: Tokens after which a shard is closed, and the least count of a pair.
SHARD_TOKENS, LEAST_COUNT = 1 << 20, 8
#: Chunks of text that a task remembers the ids of.
REMEMBERED = 1_000_000
#: Shard offsets up to this number go to every task; more are joined by a shuffle.
BROADCAST_SHARDS = 1_000_000

FORMAT = ("part int, shard int, n_docs int, n_tokens long, width int, first_rule int, "
          "doc_ids binary, null_ids binary, rules binary, lengths binary, symbols binary, ends binary")

#: Symbols below this are packed as 16-bit numbers.
MOST_NARROW = (1 << 16) - 1

#: A blank and letters of ASCII; and a blank and a word that neither holds nor ends in blanks.
_PLAIN, _WORD = re.compile(" [A-Za-z]+"), re.compile(r" (?=\S)[^ ]*(?<=\S)")
_WIDE_BLANKS = [int.from_bytes(chr(c).encode()) for c in range(0x800, 0x3001) if chr(c).isspace()]
_BLANKS = np.isin(np.arange(256), [*range(9, 14), *range(28, 33)])
_LETTERS = np.isin(np.arange(256), [*range(65, 91), *range(97, 123)])


def pack(symbols: np.ndarray, last: np.ndarray, first_rule: int, rounds: int | None = None,
         least: int = LEAST_COUNT):
    """Re-Pair of symbols; `last` marks where documents end, and is used up; `rounds` is their
    greatest number, if there is one.

    Returns the symbols left, their end marks, and the rules as rows of (left, right)."""
    kind, half = (np.uint32, 16) if first_rule < MOST_NARROW else (np.uint64, 32)
    symbols = symbols.astype(kind)
    rules: list[np.ndarray] = []
    count = 0
    # Where a pair begins that may be frequent. Counts of pairs only fall, so one that was not
    # frequent is out for good; a pair with a new symbol is in.
    may = np.ones(len(symbols), bool)
    for _ in counting() if rounds is None else range(rounds):
        if len(symbols) < 2:
            break
        if half == 16 and first_rule + count >= MOST_NARROW:
            kind, half = np.uint64, 32
            symbols = symbols.astype(kind)
        room = (MOST_NARROW if half == 16 else 1 << 31) - first_rule - count
        at = np.flatnonzero(may[:-1] & ~last[:-1])
        left, right = symbols[at], symbols[at + 1]
        pairs = (left << kind(half)) | right
        overlap = np.zeros(0, np.int64)
        twice = np.flatnonzero(left == right)
        if len(twice):  # of a run of one symbol, the second, fourth, ... pair overlap others
            place = np.arange(len(twice))
            begins = np.maximum.accumulate(np.where(np.diff(at[twice], prepend=-2) > 1, place, 0))
            overlap = twice[(place - begins) % 2 == 1]
        counted = np.delete(pairs, overlap) if len(overlap) else pairs
        ordered = np.sort(counted)
        first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]][:len(ordered)])
        counts = np.diff(first, append=len(ordered))
        frequent = np.flatnonzero(counts >= least)
        codes, counts = ordered[first[frequent]], counts[frequent]
        chosen = _apart(codes[np.argsort(-counts, kind="stable")], room, half)
        if not len(chosen):
            break
        left, right = chosen >> kind(half), chosen & kind((1 << half) - 1)
        rules.append(np.stack([left, right], axis=1).astype(np.int64))
        place = _places_among(codes, pairs)
        may[at] = place >= 0
        place[overlap] = -1
        new = np.full(len(codes), -1, np.int64)
        new[np.searchsorted(codes, chosen)] = first_rule + count + np.arange(len(chosen))
        some = np.flatnonzero(place >= 0)
        made = new[place[some]]
        places = at[some[made >= 0]]
        symbols[places] = made[made >= 0].astype(kind)
        last[places] |= last[places + 1]
        may[places] = True
        may[np.maximum(places, 1) - 1] = True
        keep = np.ones(len(symbols), bool)
        keep[places + 1] = False
        kept = np.flatnonzero(keep)
        symbols, last, may = symbols[kept], last[kept], may[kept]
        count += len(chosen)
    return symbols, last, (np.concatenate(rules) if rules else np.zeros((0, 2), np.int64))


def _places_among(codes: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """The places of pairs among these different sorted codes, or -1."""
    factor, shift = (0x9E3779B1, 12) if pairs.dtype == np.uint32 else (0x9E3779B97F4A7C15, 44)
    factor, shift = pairs.dtype.type(factor), pairs.dtype.type(shift)
    slots = np.full(1 << 20, -1, np.int32)
    slots[codes * factor >> shift] = np.arange(len(codes), dtype=np.int32)
    place = slots[pairs * factor >> shift]
    # Codes that share a slot, and pairs that are none of them, are looked up.
    other = np.flatnonzero((place >= 0) & (codes[place] != pairs))
    at = np.minimum(np.searchsorted(codes, pairs[other]), len(codes) - 1)
    place[other] = np.where(codes[at] == pairs[other], at, -1)
    return place


def _apart(codes: np.ndarray, most: int, half: int) -> np.ndarray:
    """The pairs, most frequent first, none of which can share a symbol's place with another:
    no symbol is the left one of a pair and the right one of another pair."""
    lefts, rights, chosen = set(), set(), []
    for code in codes.tolist():
        left, right = code >> half, code & ((1 << half) - 1)
        if left not in rights and right not in lefts:
            lefts.add(left)
            rights.add(right)
            chosen.append(code)
            if len(chosen) == most:
                break
    return np.array(chosen, codes.dtype)


def rule_lengths(rules: np.ndarray, first_rule: int) -> np.ndarray:
    """How many ids each rule's symbol stands for."""
    lengths = []
    for left, right in rules.tolist():
        lengths.append((lengths[left - first_rule] if left >= first_rule else 1)
                       + (lengths[right - first_rule] if right >= first_rule else 1))
    return np.array(lengths, np.int64)


class Shard:
    """A row of the file format, ready to decode."""

    def __init__(self, row: dict):
        self.first_rule = row["first_rule"]
        kind = np.uint16 if row["width"] == 2 else np.uint32
        self.symbols = np.frombuffer(row["symbols"], kind).astype(np.int64)
        self.rules = np.frombuffer(row["rules"], np.uint32).astype(np.int64).reshape(-1, 2)
        self.lengths = np.frombuffer(row["lengths"], np.uint32).astype(np.int64)
        self.ends = np.frombuffer(row["ends"], np.uint32).astype(np.int64)
        missing = np.frombuffer(row["null_ids"], np.uint8).astype(bool)
        self.doc_ids = [None if gone else x for x, gone in
                        zip(np.frombuffer(row["doc_ids"], np.int64).tolist(), missing)]
        self.size = np.ones(len(self.symbols), np.int64)
        new = self.symbols >= self.first_rule
        self.size[new] = self.lengths[self.symbols[new] - self.first_rule]
        self.after = np.cumsum(self.size)

    def ids(self) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the shard, and where each document ends in them."""
        pool = np.arange(self.first_rule, dtype=np.uint32)
        starts, sizes = np.arange(self.first_rule), np.ones(self.first_rule, np.int64)
        done = 0
        while done < len(self.rules):  # all rules at once whose symbols are known
            ahead = np.flatnonzero(self.rules[done:].max(axis=1) >= self.first_rule + done)
            rules = self.rules[done:done + int(ahead[0])] if len(ahead) else self.rules[done:]
            parts = rules.reshape(-1)
            size = sizes[parts]
            after = np.cumsum(size)
            ids = pool[np.repeat(starts[parts] - after + size, size) + np.arange(int(after[-1]))]
            size = size.reshape(-1, 2).sum(axis=1)
            starts = np.concatenate([starts, len(pool) + np.cumsum(size) - size])
            sizes, pool = np.concatenate([sizes, size]), np.concatenate([pool, ids])
            done += len(rules)
        start = starts[self.symbols]
        ids = pool[np.repeat(start - self.after + self.size, self.size)
                   + np.arange(int(self.after[-1]) if len(self.after) else 0)]
        return ids, self.after[self.ends - 1]

    def ids_between(self, begin: int, end: int) -> list[int]:
        """Ids begin to end of the shard, without decoding the rest."""
        found: list[int] = []
        k = int(np.searchsorted(self.after, begin, side="right"))
        at = int(self.after[k] - self.size[k]) if k < len(self.symbols) else end
        while at < end and k < len(self.symbols):
            stack = [int(self.symbols[k])]
            while stack and at < end:
                symbol = stack.pop()
                size = 1 if symbol < self.first_rule else int(self.lengths[symbol - self.first_rule])
                if at + size <= begin:
                    at += size
                elif symbol < self.first_rule:
                    found.append(symbol)
                    at += 1
                else:
                    left, right = self.rules[symbol - self.first_rule].tolist()
                    stack += [right, left]
            k += 1
        return found


def _blanks(data: np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 belong to blank characters, of all scripts."""
    blank = _BLANKS[data]
    after = np.r_[data[1:], np.zeros(2, np.uint8)]
    two = np.flatnonzero(data == 0xC2)
    three = np.flatnonzero((data >= 0xE1) & (data <= 0xE3) & (after[:-1] >= 0x80) & (after[:-1] <= 0x9A))
    two = two[(after[two] == 0x85) | (after[two] == 0xA0)]
    three = three[np.isin(data[three].astype(int) << 16 | after[three].astype(int) << 8 | after[three + 1], _WIDE_BLANKS)]
    blank[np.r_[two, two + 1, three, three + 1, three + 2]] = True
    return blank


def _two_byte_letters(points: np.ndarray) -> np.ndarray:
    """Which of these code points are letters of Latin, Greek or Cyrillic."""
    return ((points >= 0xC0) & (points <= 0x24F) & (points != 0xD7) & (points != 0xF7)
            | (points >= 0x391) & (points <= 0x3CE) & (points != 0x3A2)
            | (points >= 0x400) & (points <= 0x481) | (points >= 0x48A) & (points <= 0x52F))


class TextEncoder:
    """Encodes texts with a tokenizers file, remembering chunks: their ids lie in one pool.

    A text is cut at each single blank between two characters that are not blank: the byte-level
    pattern always starts a new word there, so chunks are encoded independently. Where the file has
    that pattern, it also ends a match where letters end, so a text is cut after a letter that a
    byte of ASCII follows which is none. A text that holds the string of a special token is left to
    the library as a whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import Split

        self.whole, self.tokenizer = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.special = [x.content for x in self.whole.get_added_tokens_decoder().values()]
        self.tokenizer.encode_special_tokens = True
        self.vocabulary = self.tokenizer.get_vocab_size()
        blank = self.tokenizer.encode(" ", add_special_tokens=False).tokens[0]
        self.starts_word = np.zeros(self.vocabulary, bool)
        self.starts_word[[i for token, i in self.tokenizer.get_vocab().items()
                          if token.startswith(blank)]] = True
        rules = json.loads(self.tokenizer.to_str())
        self.cuts_letters = rules["normalizer"] is None and (rules["pre_tokenizer"] or {}).get(
            "type") == "ByteLevel" and rules["pre_tokenizer"].get("use_regex", True)
        if self.cuts_letters:
            # For letters that are bytes, with the blank's own sign in between: no pattern is needed.
            self.blank, self.plain = blank, Tokenizer.from_file(path)
            self.plain.pre_tokenizer = Split(blank, "merged_with_next")
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.pool, self.sizes = np.array([END_ID], np.int32), np.ones(1, np.int64)

    def _add(self, ids: list[np.ndarray], sizes: list[np.ndarray]) -> np.ndarray:
        """The numbers of these chunks, whose ids go to the pool."""
        before = len(self.sizes)
        self.pool = np.concatenate([self.pool, *ids]).astype(np.int32)
        self.sizes = np.concatenate([self.sizes, *sizes]).astype(np.int64)
        return np.arange(before, len(self.sizes))

    def _together(self, tokenizer, words: list[str], blank: str) -> np.ndarray:
        """Encode words after a blank, many as one text: only the first id of each starts with one."""
        pools, sizes = [], []
        for k in range(0, len(words), 4096):
            part = words[k:k + 4096]
            text = "".join(part) if blank == " " else "".join(part).replace(" ", blank)
            ids = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)
            first = np.flatnonzero(self.starts_word[ids])
            assert len(first) == len(part)
            pools.append(ids)
            sizes.append(np.diff(np.r_[first, len(ids)]))
        return self._add(pools, sizes)

    def _alone(self, tokenizer, chunks: list[str]) -> np.ndarray:
        found = [x.ids for x in tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]
        return self._add([np.array(list(chain.from_iterable(found)), np.int32)],
                         [np.array([len(x) for x in found], np.int64)])

    def _learn(self, chunks: list[str]) -> None:
        kinds: tuple[list[str], list[str], list[str]] = [], [], []
        for chunk in chunks:
            plain = self.cuts_letters and _PLAIN.fullmatch(chunk)
            kinds[0 if plain else 1 if _WORD.fullmatch(chunk) else 2].append(chunk)
        plain, words, others = kinds
        if plain:
            self.known.update(zip(plain, self._together(self.plain, plain, self.blank).tolist()))
        if words:
            self.known.update(zip(words, self._together(self.tokenizer, words, " ").tolist()))
        if others:
            self.known.update(zip(others, self._alone(self.tokenizer, others).tolist()))

    def _cuts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where chunks of these texts begin, each text's begin among them."""
        begins = np.zeros(len(data) + 1, bool)
        if len(data) > 2:
            blank = _blanks(data)
            begins[1:-2] = (data[1:-1] == 32) & ~blank[:-2] & ~blank[2:]
            begins[offsets[1:] - 1] = False  # a blank that ends a text
            if self.cuts_letters:
                begins[1:-1] |= _LETTERS[data[:-1]] & (data[1:] < 128) & ~_LETTERS[data[1:]]
                # Letters of Latin, Greek and Cyrillic that are two bytes.
                two = np.flatnonzero((data[:-2] >= 0xC3) & (data[:-2] <= 0xD3) & (data[2:] < 128))
                two = two[~_LETTERS[data[two + 2]]]
                begins[two[_two_byte_letters(data[two].astype(int) << 6 & 0x7C0 | data[two + 1] & 63)] + 2] = True
        begins[offsets] = True
        return np.flatnonzero(begins[:-1])

    def _places(self, number: np.ndarray) -> np.ndarray:
        """Where in the pool the ids of these numbers are."""
        size = self.sizes[number]
        before = (np.cumsum(self.sizes) - self.sizes)[number] - np.cumsum(size) + size
        return np.repeat(before, size) + np.arange(int(size.sum()))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, each text's end id included, and how many each has."""
        if not texts:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        if len(self.sizes) > REMEMBERED:
            self._forget()
        special = [k for k, text in enumerate(texts) if any(x in text for x in self.special)]
        wholes = [texts[k] for k in special]
        if special:
            texts = texts.copy()
            for k in special:
                texts[k] = ""
        data, offsets = text_bytes(pa.array(texts, pa.large_string()))
        begins = self._cuts(data, offsets)
        chunks = pa.LargeStringArray.from_buffers(
            len(begins), pa.py_buffer(np.r_[begins, len(data)].astype(np.int64)), pa.py_buffer(data))
        coded = chunks.dictionary_encode()
        different = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.known.get, different))
        new = [chunk for chunk, number in zip(different, found) if number is None]
        if new:
            self._learn(new)
            found = list(map(self.known.__getitem__, different))
        numbers = np.array(found, np.int64)[coded.indices.to_numpy()]
        # The end id after each text, and before it the whole text where the library encodes that.
        ends = np.searchsorted(begins, offsets[1:])
        after, extra = ends, np.zeros(len(texts), np.int64)
        if special:
            whole = self._alone(self.whole, wholes)
            after, extra = np.r_[ends[special], ends], np.r_[whole, extra]
            place = np.r_[special, np.arange(len(texts))] * 2 + np.r_[np.zeros(len(special)), np.ones(len(texts))]
            order = np.argsort(place, kind="stable")
            after, extra = after[order], extra[order]
        numbers = np.insert(numbers, after, extra)
        total = np.cumsum(self.sizes[numbers])
        return self.pool[self._places(numbers)], np.diff(np.r_[0, total[numbers == 0]])


_encoders: dict[str, TextEncoder] = {}


def text_encoder(path: str) -> TextEncoder:
    """The worker's encoder of this file, with what it remembers from earlier tasks."""
    if path not in _encoders:
        _encoders[path] = TextEncoder(path)
    return _encoders[path]


def _packing(path: str, shard_tokens: int, rounds: int | None):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, shard = text_encoder(path), 0
        waiting: list[tuple[list, np.ndarray, np.ndarray]] = []

        def closed() -> pa.RecordBatch:
            ids = [x for own, _, _ in waiting for x in own]
            symbols = np.concatenate([x for _, x, _ in waiting])
            counts = np.concatenate([x for _, _, x in waiting])
            last = np.zeros(len(symbols), bool)
            last[np.cumsum(counts) - 1] = True
            left, marks, rules = pack(symbols, last, encoder.vocabulary, rounds)
            width = 2 if encoder.vocabulary + len(rules) <= 1 << 16 else 4
            row = {
                "part": TaskContext.get().partitionId(), "shard": shard, "n_docs": len(ids),
                "n_tokens": len(symbols), "width": width, "first_rule": encoder.vocabulary,
                "doc_ids": np.array([x or 0 for x in ids], np.int64).tobytes(),
                "null_ids": np.array([x is None for x in ids], np.uint8).tobytes(),
                "rules": rules.astype(np.uint32).tobytes(),
                "lengths": rule_lengths(rules, encoder.vocabulary).astype(np.uint32).tobytes(),
                "symbols": left.astype(np.uint16 if width == 2 else np.uint32).tobytes(),
                "ends": (np.flatnonzero(marks) + 1).astype(np.uint32).tobytes()}
            kinds = {"part": pa.int32(), "shard": pa.int32(), "n_docs": pa.int32(),
                     "n_tokens": pa.int64(), "width": pa.int32(), "first_rule": pa.int32()}
            return pa.RecordBatch.from_pydict(
                {k: pa.array([v], kinds.get(k, pa.binary())) for k, v in row.items()})

        tokens = 0
        for batch in batches:
            all_ids, all_counts = encoder.encode([x or "" for x in batch.column("text").to_pylist()])
            ends, row = np.r_[0, np.cumsum(all_counts)], 0
            for rows, _, _ in slices(batch, limit=min(SLICE_BYTES, 4 * shard_tokens)):
                end = row + rows.num_rows
                ids = all_ids[ends[row]:ends[end]]
                waiting.append((rows.column("doc_id").to_pylist(), ids, all_counts[row:end]))
                row = end
                tokens += len(ids)
                if tokens >= shard_tokens:
                    yield closed()
                    waiting, tokens, shard = [], 0, shard + 1
        if waiting:
            yield closed()

    return work


def write_ids(docs: DataFrame, path: str, tokenizer: str, parts: int | None = None,
              shard_tokens: int = SHARD_TOKENS, rounds: int | None = None) -> None:
    """Encode (doc_id, text) with the tokenizers file and write shards in ascending id order."""
    own = clean_table(docs, doc_id="doc_id", text="text")
    parts = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = own.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    map_batches(ordered, _packing(tokenizer, shard_tokens, rounds), FORMAT).write.parquet(path)


def _reading(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            shard = Shard(row)
            ids, ends = shard.ids()
            begin = np.r_[0, ends[:-1]]
            raw = ids.tobytes()
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(shard.doc_ids, pa.int64()),
                "start": pa.array(begin + row["offset"]), "n_tokens": pa.array(ends - begin),
                "ids_crc32": pa.array([zlib.crc32(raw[4 * a:4 * b]) for a, b in
                                       zip(begin.tolist(), ends.tolist())], pa.int64())})


def read_shards(spark, path: str) -> DataFrame:
    """The shards with `offset`, the number of ids before each."""
    files = spark.read.parquet(path)
    sizes = files.select("part", "shard", "n_tokens")
    totals = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("within", F.coalesce(F.sum("n_tokens").over(within), F.lit(0))) \
        .join(totals, "part").select("part", "shard", (F.col("before") + F.col("within")).alias("offset"))
    if sizes.count() <= BROADCAST_SHARDS:
        offsets = F.broadcast(offsets)
    return files.join(offsets, ["part", "shard"])


def read_ids(spark, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone."""
    return map_batches(read_shards(spark, path), _reading,
                       "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write to a new folder that all executors share, and read back."""
    path = shared_dir(docs.sparkSession, "token-ids")
    write_ids(docs, path, tokenizer)
    return read_ids(docs.sparkSession, path)
