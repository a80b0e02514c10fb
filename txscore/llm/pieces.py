"""SentencePiece encoding with seeded merge-dropout, and decoding.

A merge-type model joins neighbouring symbols, best score first and leftmost among equals, as
long as their join is a piece. Here a candidate merge, that is one place where two symbols may
become one, is skipped when the hash of its chunk's key and its place falls below the dropout: it
leaves the agenda for good, as if drawn at random, but the same in every run. Without dropout
the result is that of the sentencepiece library.

A text is cut before each run of blanks: no piece reaches over such a cut, so chunks are
independent. The key of a chunk is made of the seed, the document's id and the chunk's place in
the document, so a word is cut anew wherever it stands.

A task remembers for each chunk which merges are made without dropout and what comes of them.
Where none of them is skipped that is the result; where one is, the result is that of the chunk
without this merge, which is remembered in the same way where chunks looked up together want it
more than once, up to `DEPTH` skipped merges. What skips more, results wanted once, and long
chunks are encoded on their own each time. All give what the agenda gives.

Blanks are written as U+2581 in pieces. Characters without a piece, and U+2581 itself where it
stands in a text, are written as bytes, so decoding gives back every text exactly.

Defined results: null stays null in both directions; an empty text is one blank piece, as every
text gets a blank in front, and decodes to an empty text; a null id counts as the CRC of the text;
repeated rows get equal ids; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from txscore.llm.tasks import SLICE_BYTES, clean_table, map_batches, text_bytes
from txscore.llm.words import U64, mix

DROPOUT, SEED = 0.1, 0
#: Results that a task remembers, and characters up to which chunks are encoded side by side.
REMEMBERED, SIDE_BY_SIDE = 200_000, 48
#: Skipped merges up to which results are remembered, and chunks that are looked up at once.
DEPTH, AT_ONCE = 3, 1 << 16
#: Numbers that a document's key is one of.
DOCUMENT_KEYS = 1 << 62
#: Slots of the table of joins, as a power of two.
SLOT_BITS = 21
BLANK = "▁"

_SEEDED, _PLACED = 0x632BE59BD9B4E019, 0xA0761D6478BD642F
_ALL = 0xFFFFFFFFFFFFFFFF


class Pieces:
    """The pieces of a merge-type model and which two pieces join to which."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = model.get_piece_size()
        self.byte = np.zeros(256, np.int32)
        ids: dict[str, int] = {}
        self.raw: list[bytes] = []
        for i in range(count):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte[value] = i
                self.raw.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.raw.append(b"")
            else:
                ids[piece] = i
                self.raw.append(piece.replace(BLANK, " ").encode())
        self.count, self.ids = count, ids
        scores = np.array([model.get_score(i) for i in range(count)])
        #: Smaller is better; equal scores have equal ranks.
        self.rank = np.unique(-scores, return_inverse=True)[1].astype(np.int64)
        self.of_char = np.full(0x110000, -1, np.int32)
        keys, joins = [], []
        for piece, i in ids.items():
            if len(piece) == 1:
                self.of_char[ord(piece)] = i
            for k in range(1, len(piece)):
                left, right = ids.get(piece[:k]), ids.get(piece[k:])
                if left is not None and right is not None:
                    keys.append(left * count + right)
                    joins.append(i)
        order = np.argsort(keys)
        self.keys = np.array(keys, np.int64)[order]
        self.joins = np.array(joins, np.int32)[order]
        self.join_of = dict(zip(keys, joins))
        #: Where a key is by its hash; of keys with the same one the last.
        self.slots = np.full(1 << SLOT_BITS, -1, np.int32)
        self.slots[self._slot(self.keys)] = np.arange(len(keys), dtype=np.int32)

    def join(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that two pieces join to, or -1; -1 joins with nothing."""
        key = left.astype(np.int64) * self.count + right
        at = self.slots[self._slot(key)]
        found = np.full(len(key), -1, np.int32)
        some = np.flatnonzero((at >= 0) & (left >= 0) & (right >= 0))
        wanted, at = key[some], at[some]
        other = np.flatnonzero(self.keys[at] != wanted)
        at[other] = np.minimum(np.searchsorted(self.keys, wanted[other]), len(self.keys) - 1)
        found[some] = np.where(self.keys[at] == wanted, self.joins[at], -1)
        return found

    @staticmethod
    def _slot(key: np.ndarray) -> np.ndarray:
        return (key.view(U64) * U64(_PLACED | 1) >> U64(64 - SLOT_BITS)).view(np.int64)


_loaded: dict[str, Pieces] = {}


def load(path: str) -> Pieces:
    if path not in _loaded:
        _loaded[path] = Pieces(path)
    return _loaded[path]


def places(begin: np.ndarray, mid: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Numbers of candidate merges: where in the chunk their two symbols begin, meet and end."""
    return (begin.astype(U64) << U64(42)) | (mid.astype(U64) << U64(21)) | end.astype(U64)


def skipped(key: np.ndarray, place: np.ndarray, dropout: float) -> np.ndarray:
    """Whether the merges at these places of chunks with these keys are dropped."""
    return (mix(key + place) >> U64(11)).astype(np.float64) < dropout * 2.0 ** 53


def chunk_keys(documents: list[int], counts: list[int], seed: int) -> np.ndarray:
    """A 64-bit key for each chunk of documents with these numbers and counts of chunks."""
    with np.errstate(over="ignore"):
        own = mix(np.array(documents, np.int64).view(U64) + U64(seed * _SEEDED & _ALL))
        counts = np.array(counts, np.int64)
        place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        return mix(np.repeat(own, counts) + place.astype(U64) * U64(_PLACED))


def _mixed(x: int) -> int:
    """`mix` of one number."""
    x &= _ALL
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & _ALL
    x = (x ^ x >> 27) * 0x94D049BB133111EB & _ALL
    return x ^ x >> 31


def agenda(pieces: Pieces, chunk: str, key: int, dropout: float) -> list[int]:
    """Encode one chunk with an agenda of candidate merges; for chunks of any length."""
    points = np.frombuffer(chunk.encode("utf-32-le"), np.uint32)
    blanks = np.where(points == 32, ord(BLANK), points)
    ids = np.where(points == ord(BLANK), -1, pieces.of_char[blanks]).tolist()
    n = len(ids)
    bound = dropout * 2.0 ** 53
    begin, end = list(range(n)), list(range(1, n + 1))
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    heap: list[tuple[int, int, int, int, int]] = []

    def offer(left: int, right: int) -> None:
        if left < 0 or right >= n or ids[left] < 0 or ids[right] < 0:
            return
        joined = pieces.join_of.get(ids[left] * pieces.count + ids[right])
        if joined is not None:
            heapq.heappush(heap, (int(pieces.rank[joined]), left, right, end[right], joined))

    for k in range(n - 1):
        offer(k, k + 1)
    gone = [False] * n
    while heap:
        _, left, right, stop, joined = heapq.heappop(heap)
        if gone[left] or gone[right] or after[left] != right or end[right] != stop:
            continue
        if dropout and _mixed(key + (begin[left] << 42 | begin[right] << 21 | stop)) >> 11 < bound:
            continue
        ids[left], end[left], gone[right] = joined, stop, True
        after[left] = after[right]
        if after[left] < n:
            before[after[left]] = left
        offer(before[left], left)
        offer(left, after[left])
    out: list[int] = []
    for k in range(n):
        if not gone[k]:
            out.extend([ids[k]] if ids[k] >= 0 else pieces.byte[list(chunk[k].encode())].tolist())
    return out


def side_by_side(pieces: Pieces, chunks: list[str], key: int | np.ndarray,
                 dropout: float) -> tuple[np.ndarray, np.ndarray]:
    """Encode many short chunks at once, with a key for each or one for all.

    Returns all ids in one array and how many belong to each chunk."""
    keys = np.broadcast_to(np.asarray(key, U64), len(chunks))
    drops = (lambda chunk, place: skipped(keys[chunk], place, dropout)) if dropout else None
    return merged(pieces, chunks, drops)[:2]


def _narrow(chunk: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Numbers of merges in numbered chunks of `SIDE_BY_SIDE` characters at most."""
    low = U64(63)
    return (chunk.astype(U64) << U64(18)) | ((place >> U64(42)) << U64(12)) \
        | (((place >> U64(21)) & low) << U64(6)) | (place & low)


def without(pieces: Pieces, chunks: list[str], gone: list[tuple[int, ...]]):
    """Encode many short chunks at once, each without the merges at the places in `gone`; as
    `merged` does."""
    if not any(gone):
        return merged(pieces, chunks, None)
    listed = np.sort(_narrow(np.repeat(np.arange(len(chunks)), [len(x) for x in gone]),
                             np.array([x for own in gone for x in own], U64)))

    def drops(chunk: np.ndarray, place: np.ndarray) -> np.ndarray:
        wanted = _narrow(chunk, place)
        return listed[np.minimum(np.searchsorted(listed, wanted), len(listed) - 1)] == wanted

    return merged(pieces, chunks, drops)


def merged(pieces: Pieces, chunks: list[str], drops: Callable[[np.ndarray, np.ndarray], np.ndarray] | None):
    """Encode many chunks at once: each round makes the best merge of every chunk. `drops` says
    which candidates, given by chunk and place, are skipped.

    Returns all ids in one array and how many belong to each chunk; and the places of the merges
    made, in their order, and how many belong to each chunk."""
    points = np.frombuffer("".join(chunks).encode("utf-32-le"), np.uint32)
    sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
    first = np.r_[0, np.cumsum(sizes)[:-1]]
    # Narrow numbers, as each round moves all of them.
    chunk = np.repeat(np.arange(len(chunks), dtype=np.int32), sizes)
    begin = (np.arange(len(points)) - first[chunk]).astype(np.int32)
    blanks = np.where(points == 32, np.uint32(ord(BLANK)), points)
    ids = np.where(points == ord(BLANK), np.int32(-1), pieces.of_char[blanks])
    char = np.where(ids < 0, points, 0)
    end = begin + 1

    def candidates(at: np.ndarray) -> np.ndarray:
        """What symbols at these places and their right neighbours join to, or -1."""
        found = pieces.join(ids[at], ids[at + 1])
        found[chunk[at] != chunk[at + 1]] = -1
        some = np.flatnonzero(found >= 0)
        if drops and len(some):
            p = at[some]
            found[some[drops(chunk[p], places(begin[p], begin[p + 1], end[p + 1]))]] = -1
        return found

    done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    made: list[tuple[np.ndarray, np.ndarray]] = []
    joined = np.full(len(ids), -1, np.int32)
    joined[:-1] = candidates(np.arange(len(ids) - 1))
    while len(ids):
        # Best rank first, then leftmost.
        order = np.where(joined >= 0, (pieces.rank[joined] << 32) | np.arange(len(ids)),
                         np.iinfo(np.int64).max)
        starts = np.flatnonzero(np.r_[True, chunk[1:] != chunk[:-1]])
        best = np.minimum.reduceat(order, starts)
        some = best != np.iinfo(np.int64).max
        at = (best[some] & 0xFFFFFFFF).astype(np.int64)
        made.append((chunk[at], places(begin[at], begin[at + 1], end[at + 1])))
        ids[at], end[at] = joined[at], end[at + 1]
        keep = np.ones(len(ids), bool)
        keep[at + 1] = False
        # Chunks without candidates leave.
        over = np.repeat(~some, np.diff(np.r_[starts, len(ids)]))
        if over.any():
            done.append((chunk[over], ids[over], char[over]))
            keep &= ~over
        place = np.cumsum(keep) - 1
        at = place[at]
        kept = np.flatnonzero(keep)
        ids, chunk, begin, end, char, joined = (x[kept] for x in (ids, chunk, begin, end, char, joined))
        if not len(ids):
            break
        touched = np.zeros(len(ids), bool)
        touched[at] = True
        touched[at[at > 0] - 1] = True
        touched[-1] = False
        again = np.flatnonzero(touched)
        joined[at] = -1
        joined[again] = candidates(again)
    chunk, ids, char = (np.concatenate([d[k] for d in done]) for k in range(3))
    order = np.argsort(chunk, kind="stable")
    chunk, ids, char = chunk[order], ids[order], char[order]
    unknown = np.flatnonzero(ids < 0)
    if len(unknown):
        raw = [pieces.byte[list(chr(c).encode())] for c in char[unknown].tolist()]
        size = np.ones(len(ids), np.int64)
        size[unknown] = [len(r) for r in raw]
        ids, chunk = np.repeat(ids, size), np.repeat(chunk, size)
        ids[ids < 0] = np.concatenate(raw)
    of, steps = (np.concatenate([m[k] for m in made]) for k in range(2))
    return (ids, np.bincount(chunk, minlength=len(chunks)),
            steps[np.argsort(of, kind="stable")], np.bincount(of, minlength=len(chunks)))


def _ranges(ends: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions of ranges with these ends and sizes, one range after the other."""
    return np.repeat(ends - np.cumsum(sizes), sizes) + np.arange(sizes.sum())


class Encoder:
    """Encodes documents, remembering results: their ids lie end to end in one pool, and the
    merges that led to them in another one."""

    def __init__(self, path: str, dropout: float, seed: int):
        self.pieces, self.dropout, self.seed = load(path), dropout, seed
        self._forget()

    def _forget(self) -> None:
        #: Numbers of the results without skipped merges by chunk (-1: a long one), and of those
        #: that come of skipping a merge of another result by 64 times its number plus which merge.
        self.known: dict[str, int] = {}
        self.next: dict[int, int] = {}
        #: Of each result: its chunk, what it skips, and how many merges come before those listed.
        self.chunk: list[str] = []
        self.gone: list[tuple[int, ...]] = []
        self.lead: list[int] = []
        self.pool, self.steps = np.zeros(0, np.int32), np.zeros(0, U64)
        self.sizes, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _learn(self, chunks: list[str], gone: list[tuple[int, ...]], lead: list[int]) -> range:
        """Remember results of short chunks; their numbers."""
        number = len(self.sizes)
        new = [(self.pool, self.sizes, self.steps, self.counts)]
        for k in range(0, len(chunks), 20_000):
            ids, sizes, steps, counts = without(self.pieces, chunks[k:k + 20_000], gone[k:k + 20_000])
            before = np.array(lead[k:k + 20_000], np.int64)
            ends = np.cumsum(counts)
            new.append((ids, sizes, steps[_ranges(ends, counts - before)], counts - before))
        self.pool, self.sizes, self.steps, self.counts = (
            np.concatenate([x[k] for x in new]) for k in range(4))
        self.chunk += chunks
        self.gone += gone
        self.lead += lead
        return range(number, number + len(chunks))

    def _skip(self, node: np.ndarray, which: np.ndarray) -> np.ndarray:
        """The numbers of the results that come of skipping these merges of results; -1 for one that
        is not known yet and wanted once only, which is not worth remembering."""
        wanted, inverse, times = np.unique(node * 64 + which, return_inverse=True, return_counts=True)
        missing = [x for x, n in zip(wanted.tolist(), times.tolist()) if n > 1 and x not in self.next]
        if missing:
            from_, at = np.divmod(np.array(missing), 64)
            first = np.cumsum(self.counts) - self.counts
            place = self.steps[first[from_] + at].tolist()
            self.next.update(zip(missing, self._learn(
                [self.chunk[x] for x in from_], [(*self.gone[x], p) for x, p in zip(from_, place)],
                [self.lead[x] + k for x, k in zip(from_, at.tolist())])))
        return np.array([self.next.get(x, -1) for x in wanted.tolist()], np.int64)[inverse]

    def _first_skipped(self, node: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of these results have a merge that is skipped under these keys, and the first."""
        counts = self.counts[node]
        own = np.repeat(np.arange(len(node)), counts)
        steps = self.steps[_ranges(np.cumsum(self.counts)[node], counts)]
        hits = np.flatnonzero(skipped(key[own], steps, self.dropout))
        of = own[hits]
        first = np.r_[True, of[1:] != of[:-1]][:len(of)]
        return of[first], hits[first] - (np.cumsum(counts) - counts)[of[first]]

    def _resolve(self, node: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Put the results under these keys in place of those without skipped merges; where more
        than `DEPTH` are skipped, or a result is not remembered, stays open, and is returned."""
        open_, left = np.arange(len(node)), []
        for depth in range(DEPTH + 1):
            some, which = self._first_skipped(node[open_], key[open_])
            open_ = open_[some]
            if not len(open_) or depth == DEPTH:
                break
            found = self._skip(node[open_], which)
            left.append(open_[found < 0])
            open_, found = open_[found >= 0], found[found >= 0]
            node[open_] = found
        return np.concatenate([*left, open_])

    def encode(self, texts: list[str], documents: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in one array, and how many belong to each text; `documents` are
        numbers from which, with the seed, the keys of their chunks are made."""
        if len(self.sizes) > REMEMBERED or len(self.known) > REMEMBERED:
            self._forget()
        data, offsets = text_bytes(pa.array([" " + text for text in texts], pa.large_string()))
        begins = data == 32
        begins[1:] &= data[:-1] != 32
        begins[offsets[:-1]] = True
        begins = np.flatnonzero(begins)
        coded = pa.LargeStringArray.from_buffers(
            len(begins), pa.py_buffer(np.r_[begins, len(data)].astype(np.int64)), pa.py_buffer(data)).dictionary_encode()
        different, index = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        wanted = [c for c in different if c not in self.known]
        missing = [c for c in wanted if len(c) <= SIDE_BY_SIDE]
        self.known.update(dict.fromkeys(wanted, -1))
        self.known.update(zip(missing, self._learn(missing, [()] * len(missing), [0] * len(missing))))
        counts = np.diff(np.searchsorted(begins, offsets))
        key = chunk_keys(documents, counts, self.seed)
        node = np.array(list(map(self.known.__getitem__, different)), np.int64)[index]
        alone = [np.flatnonzero(node < 0)]
        if self.dropout:
            short = np.flatnonzero(node >= 0)
            for k in range(0, len(short), AT_ONCE):
                part = short[k:k + AT_ONCE]
                own = node[part]
                alone.append(part[self._resolve(own, key[part])])
                node[part] = own
        apart = np.concatenate(alone)
        pool, sizes = self._alone([different[k] for k in index[apart].tolist()], node, key, apart)
        size = sizes[node]
        ids = pool[_ranges(np.cumsum(sizes)[node], size)]
        ends = np.r_[0, np.cumsum(size)][np.r_[0, np.cumsum(counts, dtype=np.int64)]]
        return ids, np.diff(ends)

    def _alone(self, chunks: list[str], node: np.ndarray, key: np.ndarray,
               alone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Encode the chunks at these places on their own, to be forgotten; the pool and sizes with theirs."""
        if not len(alone):
            return self.pool, self.sizes
        pools, sizes = [self.pool], [self.sizes]
        long = np.array([len(chunk) > SIDE_BY_SIDE for chunk in chunks], bool)
        short, own = alone[~long], [chunk for chunk in chunks if len(chunk) <= SIDE_BY_SIDE]
        for k in range(0, len(short), 20_000):
            ids, counts = side_by_side(self.pieces, own[k:k + 20_000], key[short[k:k + 20_000]], self.dropout)
            pools.append(ids)
            sizes.append(counts)
        for k in np.flatnonzero(long).tolist():
            pools.append(np.array(agenda(self.pieces, chunks[k], int(key[alone[k]]), self.dropout), np.int32))
            sizes.append(np.array([len(pools[-1])]))
        node[np.r_[short, alone[long]]] = np.arange(len(alone)) + len(self.sizes)
        return np.concatenate(pools), np.concatenate(sizes)


def variant_of(ids: list, seed: int, variants: int) -> list[int]:
    """One of `variants` numbers for each id, from its hash and the seed."""
    with np.errstate(over="ignore"):
        numbers = np.array([x or 0 for x in ids], np.int64).view(U64)
        return (mix(numbers ^ mix(np.full(1, seed, U64))) % U64(variants)).astype(int).tolist()


def encode(docs: DataFrame, path: str, dropout: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """(doc_id, n_bytes, text_crc32, ids) of each row; `path` is the model file on every machine."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        encoder = Encoder(path, dropout, seed)
        for batch in batches:
            row = 0
            _, offsets = text_bytes(batch.column("text"))
            while row < batch.num_rows:
                stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES)))
                part = batch.slice(row, stop - row)
                row = stop
                texts = part.column("text").to_pylist()
                raw = [None if x is None else x.encode() for x in texts]
                numbers = [zlib.crc32(x or b"") if i is None else i
                           for i, x in zip(part.column("doc_id").to_pylist(), raw)]
                ids, counts = encoder.encode([x or "" for x in texts],
                                             variant_of(numbers, seed, DOCUMENT_KEYS))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id"),
                    "n_bytes": pa.array([None if x is None else len(x) for x in raw], pa.int64()),
                    "text_crc32": pa.array([None if x is None else zlib.crc32(x) for x in raw], pa.int64()),
                    "ids": pa.ListArray.from_arrays(np.r_[0, np.cumsum(counts)].astype(np.int32),
                                                    ids, mask=pa.array([x is None for x in texts]))})

    return map_batches(clean_table(docs, doc_id="doc_id", text="text"), work,
                       "doc_id long, n_bytes long, text_crc32 long, ids array<int>")


def decode_ids(pieces: Pieces, ids: np.ndarray) -> str:
    """The text that these ids were made from."""
    return b"".join(map(pieces.raw.__getitem__, ids.tolist()))[1:].decode("utf-8", "replace")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The rows of `encode` with their text put back."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(path)
        for batch in batches:
            column = batch.column("ids")
            flat, ends = column.values.to_numpy(), column.offsets.to_numpy()
            valid = column.is_valid().to_pylist()
            texts = [decode_ids(pieces, flat[a:b]) if ok else None
                     for a, b, ok in zip(ends[:-1], ends[1:], valid)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                             names=[*batch.schema.names, "text"])

    return map_batches(encoded, work, "doc_id long, n_bytes long, text_crc32 long, ids array<int>, text string")
