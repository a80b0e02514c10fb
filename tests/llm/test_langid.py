"""Language identification: held-out accuracy, a plain version of the whole query, and the
measure by hand."""

import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq

from corpus_pipeline import language_id
from txscore.llm import langid
from txscore.llm.langid import PROFILE, Profiles, accept, identify, learn, ngram_keys, profile
from txscore.llm.queries import QUERIES


def test_held_out_accuracy(spark, sf_dir):
    lang = dict(zip(*(pq.read_table(f"{sf_dir}/documents.parquet")[c].to_pylist() for c in ("doc_id", "lang"))))
    rows = QUERIES["op9_rank_order_profiles"](spark, sf_dir).collect()
    assert len(rows) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def plain_grams(text):
    """Every n-gram of a text, one by one."""
    words = "".join(c if unicodedata.category(c)[0] in "LM" else " " for c in text.lower()).split()
    padded = " " + " ".join(words) + " "
    return Counter(padded[k:k + n] for n in (1, 2, 3) for k in range(len(padded) - n + 1)
                   if n > 1 or padded[k] != " ") if words else Counter()


def plain_ranks(counts):
    return sorted(counts, key=lambda g: (-counts[g], [ord(c) for c in g]))[:PROFILE]


def plain_identify(rows):
    """(doc_id, lang_pred, score) of rows (doc_id, text, lang), without arrays or tasks."""
    totals = defaultdict(Counter)
    for i, text, lang in rows:
        if None not in (i, text, lang) and zlib.crc32(str(i).encode()) % 4 != 2:
            totals[lang].update(plain_grams(text))
    ranks = {lang: {g: r for r, g in enumerate(plain_ranks(c))} for lang, c in sorted(totals.items()) if c}
    found = []
    for i, text, _ in rows:
        if not ranks or not any(c.isalpha() for c in text or ""):
            found.append((i, "und", 0.0))
            continue
        own = plain_ranks(plain_grams(text))
        apart = {lang: sum(abs(known[g] - r) if g in known else PROFILE for r, g in enumerate(own))
                 for lang, known in ranks.items()}
        best = min(apart, key=apart.get)
        found.append((i, best, max(0.0, 1 - apart[best] / (PROFILE * len(own)))))
    return found


def sorted_rows(rows):
    return sorted(((i is None, i or 0, lang, round(score, 12)) for i, lang, score in rows))


RUSSIAN = ("Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и "
           "совестью и должны поступать в отношении друг друга в духе братства. Каждый человек имеет право "
           "на жизнь, на свободу и на личную неприкосновенность, и никто не должен содержаться в рабстве")
UKRAINIAN = ("Всі люди народжуються вільними і рівними у своїй гідності та правах. Вони наділені розумом і "
             "совістю і повинні діяти у відношенні один до одного в дусі братерства. Кожна людина має право "
             "на життя, на свободу і на особисту недоторканність, і ніхто не повинен бути в рабстві")


def pieces(text, size):
    words = text.split()
    return [" ".join(words[k:k + size]) for k in range(0, len(words) - size + 1, size)]


def test_whole_query_against_a_plain_version(spark, sf_dir):
    table = pq.read_table(f"{sf_dir}/documents.parquet")
    rows = list(zip(*(table[c].to_pylist() for c in ("doc_id", "text", "lang"))))
    got = [(r.doc_id, r.lang_pred, r.score) for r in QUERIES["op9_rank_order_profiles"](spark, sf_dir).collect()]
    assert sorted_rows(got) == sorted_rows(plain_identify(rows))


def test_scripts_ties_and_odd_texts_against_a_plain_version(spark, edge_docs):
    odd = ["İstanbul ΣΑΣ K", "हिन्दी में लिखा हुआ", "漢字と仮名", "'-- x", "x --", "ab", "ba", "٣٤٥", "́", "á́ b"]
    rows = [(100 + k, t, lang) for k, (t, lang) in enumerate(
        [(t, "ru") for t in pieces(RUSSIAN, 5)] + [(t, "uk") for t in pieces(UKRAINIAN, 5)]
        + [(t, None) for t in odd] + [("ab ba", "tie1"), ("ab ba", "tie2")] * 4)]
    rows += [(r.doc_id, r.text, r.lang) for r in edge_docs.collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = [(r.doc_id, r.lang_pred, r.score) for r in identify(df).collect()]
    assert sorted_rows(got) == sorted_rows(plain_identify(rows))
    assert {lang for i, lang, _ in got if i and i >= 100} >= {"ru", "uk", "tie1"}
    assert "tie2" not in {lang for _, lang, _ in got}


TAUGHT = {
    "ru": "Каждый человек должен обладать всеми правами и всеми свободами, провозглашенными настоящей "
          "Декларацией, без какого бы то ни было различия, как то в отношении расы, цвета кожи, пола, языка, "
          "религии, политических или иных убеждений, национального или социального происхождения, "
          "имущественного, сословного или иного положения. Все люди равны перед законом и имеют право, без "
          "всякого различия, на равную защиту закона. Никто не может быть подвергнут произвольному аресту, "
          "задержанию или изгнанию. Каждый человек имеет право свободно передвигаться и выбирать себе место "
          "жительства в пределах каждого государства",
    "uk": "Кожна людина повинна мати всі права і всі свободи, проголошені цією Декларацією, незалежно від "
          "раси, кольору шкіри, статі, мови, релігії, політичних або інших переконань, національного чи "
          "соціального походження, майнового, станового або іншого становища. Всі люди рівні перед законом і "
          "мають право, без будь-якої різниці, на рівний їх захист законом. Ніхто не може зазнавати "
          "безпідставного арешту, затримання або вигнання. Кожна людина має право вільно пересуватися і "
          "обирати собі місце проживання у межах кожної держави"}


def test_two_languages_of_one_script_that_is_not_latin(spark):
    """Clauses of other articles than those that teach: those of twelve words are all told apart,
    of the eight of eight words one is not."""
    profiles = learn(spark.createDataFrame([(t, lang) for lang, t in TAUGHT.items()],
                                           "text string, lang string"))

    def right(size):
        return [profiles.predict(np.frombuffer(t.encode(), np.uint8))[0] == lang
                for lang, text in (("ru", RUSSIAN), ("uk", UKRAINIAN)) for t in pieces(text, size)]

    assert len(right(12)) == 6 and all(right(12))
    assert len(right(8)) >= 8 and sum(right(8)) >= len(right(8)) - 1


def test_of_too_many_labels_those_with_most_text_are_learned(spark, monkeypatch):
    monkeypatch.setattr(langid, "MOST_LANGUAGES", 2)
    rows = [("aaaa bbbb " * 9, "one"), ("cccc dddd " * 9, "two"), ("eeee", "three")]
    assert learn(spark.createDataFrame(rows, "text string, lang string")).names == ["one", "two"]


def test_profile_orders_by_count_then_gram():
    keys = ngram_keys(np.frombuffer(b"aab", np.uint8))
    names = ["".join(chr(int(k) >> s & 0x1FFFFF) for s in (42, 21, 0)).rstrip("\0") for k in profile(keys)]
    assert names == ["a", " a", " aa", "aa", "aab", "ab", "ab ", "b", "b "]


def test_distance_is_out_of_place():
    p = Profiles({"x": np.array([5, 3, 9], np.uint32), "y": np.array([1, 2, 5], np.uint32)}, size=10)
    assert p.distances(np.array([3, 5, 7], np.uint32)) == [1 + 1 + 10, 10 + 1 + 10]


def test_held_out_rows_teach_nothing(make_docs, spark):
    held = [i for i in range(40) if zlib.crc32(str(i).encode()) % 4 == 2]
    rows = [(i, "zz xx qq" if i in held else "ab cd", "odd" if i in held else "en") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r.lang_pred for r in identify(df).collect()} == {"en"}


def test_edges(edge_docs, no_docs):
    rows = {r.doc_id: r for r in identify(edge_docs).collect()}
    assert identify(edge_docs).count() == edge_docs.count()
    assert [rows[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and rows[1].score == 0
    assert rows[6].lang_pred == "en" and rows[None].held_out is None
    assert identify(no_docs).collect() == []
    kept = accept(edge_docs, learn(edge_docs))
    assert kept.columns == edge_docs.columns
    assert {1, 2, 3}.isdisjoint(r.doc_id for r in kept.collect()) and kept.filter("doc_id = 7").count() == 2


def test_unlearned_latin_languages_go(spark, sf_dir):
    """Passages without accents, in languages of the script that the labels do not teach."""
    foreign = [
        "Nel mezzo del cammin di nostra vita mi ritrovai per una selva oscura, che la diritta via era smarrita. Ahi quanto a dir qual era cosa dura",
        "Suomi on tasavalta Pohjois-Euroopassa ja sen naapurimaat ovat Ruotsi, Norja ja Viro. Suomen kieli kuuluu uralilaisiin kieliin",
        "Polska jest krajem w Europie Srodkowej, ktory graniczy z Niemcami, Czechami i Ukraina. Wszyscy ludzie rodza sie wolni i rowni",
        "Tat ca moi nguoi sinh ra deu duoc tu do va binh dang ve nhan pham va quyen loi. Moi con nguoi deu duoc tao hoa ban cho ly tri",
        "Alle mensen worden vrij en gelijk in waardigheid en rechten geboren. Zij zijn begiftigd met verstand en geweten"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = [r.text for r in docs.select("text").collect() if r.text]
    clean = [" ".join(t.split()[:12]) for t in texts if len(t.split()) >= 12]
    odd = spark.createDataFrame([(-1 - k, t) for k, t in enumerate(foreign)]
                                + [(10 ** 9 + k, t) for k, t in enumerate(clean)], "doc_id long, text string")
    given = docs.unionByName(odd, allowMissingColumns=True)
    kept = {r.doc_id for r in language_id(spark, given, sf_dir).select("doc_id").collect()}
    assert not any(i < 0 for i in kept)
    assert sum(i >= 10 ** 9 for i in kept) >= 0.99 * len(clean)
    assert docs.filter(~docs.doc_id.isin(list(kept))).count() <= 0.001 * docs.count()
