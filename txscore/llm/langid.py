"""Language identification by rank-order profiles.

A profile is a text's most frequent n-grams in order. Each language's profile is learned from
all labelled texts; a text is compared with each by the out-of-place distance: the sum, over
the text's profile, of how far each n-gram's rank is from its rank in the language, or the
largest possible distance where the language does not have it. n-grams are 1 to 3 characters of the
lower-cased text, in any script, with everything but letters and the marks on them read as one
blank between words; equal counts are ordered by the n-gram's code points.

`least_scores` learns which scores texts of a language have: of all labelled texts, cut to each of
`CUTS` lengths, a low quantile of the scores in their own language, less a margin. `accept` takes
a text only if its score reaches that of its language and length, so that a text in a language
of the same script that was never learned goes.

The score is how much nearer the best language is than the largest possible distance, between
0 and 1; a text in none of the languages' n-grams has 0.

Defined results: `und` with score 0 for null, empty and letterless texts, and where nothing was
learned; equal distances go to the language that is first by name; a null id gives held_out
null and teaches nothing. Rows with null lang teach nothing. Of more than `MOST_LANGUAGES`
labels those with the most text are learned. Repeated rows count as often as they occur. An
empty table gives no rows, and teaches no language. Other columns are not read.
"""

from __future__ import annotations

import sys
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txscore.llm.tasks import clean_table, keep_texts, map_batches, slices, written_table
from txscore.llm.words import LOWER

#: n-grams in a profile.
PROFILE = 300
#: n-gram counts a task gathers per language before it hands them on.
FLUSH = 1 << 20
#: Languages that profiles are held for in every task, 2.4 kB each: a bound on what is broadcast.
MOST_LANGUAGES = 5000
UNKNOWN = "und"
#: Score below which a text is in no learned language, whatever was learned: texts of other
#: letters score near 0.
LEAST_SCORE = 0.15
#: Lengths in bytes that scores are learned at, the share of labelled texts that may score less,
#: and the part of that quantile a text must reach: labelled texts may be half codes or junk.
CUTS, LOW_SHARE, LOW_PART = (8, 32, 128, 512, 2048), 0.01, 0.75

#: Bits of a code point; three of them fill an n-gram's 63-bit number.
_WIDTH = 21


@cache
def _letters() -> np.ndarray:
    """Whether each code point is a letter or a mark on one."""
    return np.fromiter((unicodedata.category(chr(c))[0] in "LM" for c in range(sys.maxunicode + 1)),
                       bool, sys.maxunicode + 1)


def code_points(data: np.ndarray) -> np.ndarray:
    """The lower-cased characters of UTF-8 bytes as numbers."""
    if not (data >= 128).any():
        return LOWER[data]
    return np.frombuffer(data.tobytes().decode("utf-8", "replace").lower().encode("utf-32-le"), np.uint32)


def ngram_keys(data: np.ndarray) -> np.ndarray:
    """All n-grams of a text as sorted 63-bit numbers: the code points, left-aligned."""
    low = code_points(data)
    letters = _letters()[low]
    keep = letters.copy()
    keep[1:] |= letters[:-1]
    kept = np.where(letters, low, 32)[keep]
    if len(kept) and kept[-1] == 32:
        kept = kept[:-1]  # both ends have one blank
    text = np.full(len(kept) + 2, 32, np.int64)
    text[1:-1] = kept
    one = text << 2 * _WIDTH
    two = one[:-1] | (text[1:] << _WIDTH)
    keys = np.concatenate([one[text != 32], two, two[:-1] | text[2:]])
    keys.sort()
    return keys


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of a sorted array and how often each occurs."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.diff(np.r_[first, len(keys)])


def profile(keys: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """The most frequent n-grams in order of rank."""
    grams, counts = counted(keys)
    if len(grams) > size:
        keep = counts >= np.partition(counts, len(counts) - size)[len(counts) - size]
        grams, counts = grams[keep], counts[keep]
    return grams[np.argsort(-counts, kind="stable")[:size]]


def has_letter(data: np.ndarray) -> bool:
    """Whether UTF-8 bytes hold a letter of any script."""
    low = LOWER[data]
    if ((low >= 97) & (low <= 122)).any():
        return True
    if not (data >= 128).any():
        return False
    return any(c.isalpha() for c in data.tobytes().decode("utf-8", "replace"))


class Profiles:
    """Language profiles, sorted for lookup."""

    def __init__(self, profiles: dict[str, np.ndarray], size: int = PROFILE):
        self.size = size
        self.names = sorted(profiles)
        self.grams = [np.sort(profiles[x]) for x in self.names]
        self.ranks = [np.argsort(profiles[x], kind="stable") for x in self.names]

    def distances(self, own: np.ndarray) -> list[int]:
        """Out-of-place distance of a text's profile to each language."""
        place = np.arange(len(own))
        found = []
        for grams, ranks in zip(self.grams, self.ranks):
            at = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
            apart = np.where(grams[at] == own, np.abs(ranks[at] - place), self.size)
            found.append(int(apart.sum()))
        return found

    def score(self, data: np.ndarray, lang: str) -> float:
        """The score of a text with letters in one of the languages."""
        own = profile(ngram_keys(data), self.size)
        return max(0.0, 1.0 - self.distances(own)[self.names.index(lang)] / (self.size * len(own)))

    def predict(self, data: np.ndarray) -> tuple[str, float]:
        if not self.names or not has_letter(data):
            return UNKNOWN, 0.0
        own = profile(ngram_keys(data), self.size)
        distances = self.distances(own)
        best = int(np.argmin(distances))
        return self.names[best], max(0.0, 1.0 - distances[best] / (self.size * len(own)))


def held_out(doc_id: Column) -> Column:
    """A quarter of the ids, which teach nothing."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2


def _counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pending: dict[str, list] = {}
    size = 0

    def merged(chunks: list) -> tuple[np.ndarray, np.ndarray]:
        grams = np.concatenate([g for g, _ in chunks])
        order = np.argsort(grams, kind="stable")
        first = np.flatnonzero(np.r_[True, np.diff(grams[order]) != 0])
        return grams[order][first], np.add.reduceat(np.concatenate([n for _, n in chunks])[order], first)

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, chunks in pending.items():
            grams, counts = merged(chunks)
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang] * len(grams)), "gram": pa.array(grams),
                "n": pa.array(counts)})

    for batch in batches:
        for rows, data, offsets in slices(batch):
            langs = np.asarray(rows.column("lang").to_pylist(), object)
            for lang in sorted(set(langs)):
                keys = np.concatenate([ngram_keys(data[offsets[i]:offsets[i + 1]])
                                       for i in np.flatnonzero(langs == lang)])
                keys.sort()
                chunk = counted(keys)
                pending.setdefault(lang, []).append(chunk)
                size += len(chunk[0])
            if size > FLUSH:
                pending = {lang: [merged(chunks)] for lang, chunks in pending.items()}
                size = sum(len(chunks[0][0]) for chunks in pending.values())
                if size > FLUSH // 2:
                    yield from flush()
                    pending, size = {}, 0
    yield from flush()


def learn(docs: DataFrame, size: int = PROFILE) -> Profiles:
    """Profiles of every language among labelled texts (text, lang)."""
    teachers = clean_table(docs, lang="lang", text="text").filter("lang is not null and text is not null")
    counts = map_batches(teachers, _counting, "lang string, gram long, n long") \
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    ranked = counts.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))).filter(F.col("rank") <= size)
    ranked = written_table(ranked.select("lang", "rank", "gram", "n"), "profiles")
    languages = ranked.groupBy("lang").agg(F.sum("n").alias("n")) \
        .orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES).select("lang")
    frame = ranked.join(F.broadcast(languages), "lang", "left_semi").drop("n").toPandas() \
        .sort_values(["lang", "rank"])
    return Profiles({lang: rows["gram"].to_numpy() for lang, rows in frame.groupby("lang")}, size)


def predict(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """(doc_id, lang_pred, score) of every row (doc_id, text)."""
    return map_batches(clean_table(docs, doc_id="doc_id", text="text"), _predicting(profiles),
                       "doc_id long, lang_pred string, score double")


def _predicting(profiles: Profiles):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in slices(batch):
                found = [profiles.predict(data[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": rows.column("doc_id"),
                    "lang_pred": pa.array([x for x, _ in found], pa.string()),
                    "score": pa.array([x for _, x in found], pa.float64())})

    return work


def least_scores(docs: DataFrame, profiles: Profiles) -> dict[tuple[str, int], float]:
    """By language and length, one of `CUTS`, what texts must score, from labelled texts
    (text, lang)."""
    known = set(profiles.names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter = Counter()
            for rows, data, offsets in slices(batch):
                for lang, a, b in zip(rows.column("lang").to_pylist(), offsets[:-1], offsets[1:]):
                    for cut in CUTS:
                        if cut <= b - a and lang in known and has_letter(data[a:a + cut]):
                            found[lang, cut, round(1000 * profiles.score(data[a:a + cut], lang))] += 1
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([k[0] for k in found], pa.string()),
                "cut": pa.array([k[1] for k in found], pa.int64()),
                "score": pa.array([k[2] for k in found], pa.int64()),
                "n": pa.array(list(found.values()), pa.int64())})

    teachers = clean_table(docs, lang="lang", text="text").filter("lang is not null and text is not null")
    low = map_batches(teachers, work, "lang string, cut long, score long, n long") \
        .groupBy("lang", "cut", "score").agg(F.sum("n").alias("n")) \
        .groupBy("lang", "cut").agg(F.expr(f"percentile(score, {LOW_SHARE}, n)").alias("low"))
    return {(r.lang, r.cut): LOW_PART * r.low / 1000 for r in low.collect()}


def least_of(least: dict[tuple[str, int], float], lang: str, size: int) -> float:
    """What a text of so many bytes must score: as learned at the largest length up to it."""
    return max(LEAST_SCORE, next((least[lang, cut] for cut in reversed(CUTS)
                                  if cut <= size and (lang, cut) in least), 0.0))


def accept(docs: DataFrame, profiles: Profiles,
           least: float | dict[tuple[str, int], float] = LEAST_SCORE) -> DataFrame:
    """The rows, with all their columns, whose text is in a learned language with a score of
    `least` or more, one number or what `least_scores` learned; where no language was learned,
    all texts with a letter."""

    def judge(data: np.ndarray, offsets: np.ndarray) -> list[bool]:
        keep = []
        for a, b in zip(offsets[:-1], offsets[1:]):
            lang, score = profiles.predict(data[a:b])
            bound = least_of(least, lang, b - a) if isinstance(least, dict) else least
            keep.append(bool(score >= bound and lang != UNKNOWN if profiles.names else has_letter(data[a:b])))
        return keep

    return keep_texts(docs, judge)


def identify(docs: DataFrame, size: int = PROFILE) -> DataFrame:
    """Learn from the rows (doc_id, text, lang) that are not held out, and predict all."""
    own = clean_table(docs, doc_id="doc_id", text="text", lang="lang")
    profiles = learn(own.filter(~held_out(F.col("doc_id"))), size)
    return predict(own, profiles).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
