import math
import re
import zlib

from cases import EDGES, docs, edges, empty, table
from pyspark.sql import functions as F

from fleetlens.llm import language
from fleetlens.llm.common import held_out
from fleetlens.llm.queries import QUERIES

SF01 = "/root/testdata/sf0.01"


def test_query_held_out_accuracy(spark):
    got = QUERIES["op5_language_id"](spark, SF01)
    known = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "lang")
    rows = got.join(known, "doc_id").filter("held_out").collect()
    assert got.count() == known.count() and len(rows) > 100
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_learns_only_from_rows_not_held_out(spark):
    rows = [(i, "alpha beta gamma" if i % 2 else "uno dos tres", "xx" if i % 2 else "yy", "s", 0) for i in range(60)]
    source = docs(spark, rows)
    outside = source.withColumn("lang", F.when(held_out(), F.lit("zz")).otherwise(F.col("lang")))
    got = language.identify(outside).collect()
    assert {r.lang_pred for r in got} == {"xx", "yy"}


def test_backoff_to_shorter_grams(spark):
    rows = [(i, "strasse strom", "a", "s", 0) for i in range(20)] + [(i, "rue ruelle", "b", "s", 0) for i in range(20, 40)]
    predictor = language.Predictor(language.learn(docs(spark, rows), F.lit(True)))
    # only single letters are known of m; nothing of the next one, so no evidence for either
    names, scores = predictor(["strassen", "ruelles", "m", "ж", "123 !", None])
    assert names == ["a", "b", "a", "a", "und", "und"]
    assert abs(scores[3] - 0.5) < 1e-12 and list(scores[4:]) == [0, 0]


def test_edges(spark):
    got = language.identify(edges(spark)).collect()
    assert len(got) == len(EDGES)
    assert {r.doc_id for r in got if r.lang_pred == "und"} >= {1, 2, 3}
    assert all(r.lang_pred == "und" for r in language.identify(docs(spark, [(1, "abc", None, "s", 1)])).collect())
    assert language.identify(empty(spark)).count() == 0


def test_stage(spark):
    source = table(spark, "documents").selectExpr("*", "1 AS known")
    got = language.keep_known(source)
    assert got.columns == source.columns
    letters = source.filter(F.col("text").rlike(r"\p{L}"))
    assert got.count() >= 0.99 * letters.count()
    assert got.filter(~F.col("text").rlike(r"\p{L}")).count() == 0


def test_stage_keeps_low_scores_and_unlabelled_tables(spark):
    names = ["aa", "bb", "cc", "dd", "ee", "ff"]
    rows = [(i, f"shared common {names[i % 6] * 3}", names[i % 6], "s", 0) for i in range(120)]
    # 1000: words of all languages alike but for little evidence; 1001: nothing learned; 1002: no letter
    rows += [(1000, "shared common aaaaaa bbbbbb cccccc dddddd", None, "s", 0), (1001, "東京", None, "s", 0), (1002, "12 34", None, "s", 0)]
    assert {r.doc_id for r in language.keep_known(docs(spark, rows)).collect()} >= {*range(120), 1000}
    assert not {1001, 1002} & {r.doc_id for r in language.keep_known(docs(spark, rows)).collect()}
    unlabelled = docs(spark, [(1, "one text", None, "s", 0), (2, "12 34", None, "s", 0), (3, None, None, "s", 0)])
    assert [r.doc_id for r in language.keep_known(unlabelled).collect()] == [1]


class Plain:
    """The same model and scores in plain Python: every word of the sample, no arrays."""

    def __init__(self, labelled, languages, grams=language.GRAMS):
        self.languages, self.counts = languages, {n: {} for n in (0, *grams)}
        for text, lang in labelled:
            for word in re.findall(r"[^\W\d_]+", text.lower()):
                for n in self.counts:
                    for key in language.cut(word, n) if n else [word]:
                        own = self.counts[n].setdefault(key, dict.fromkeys(languages, 0))
                        own[lang] += 1
        self.base = {n: {x: math.log(sum(c[x] for c in table.values()) + 0.5 * max(1, len(table))) for x in languages} for n, table in self.counts.items()}

    def word(self, word):
        for n in self.counts:
            found = [self.counts[n][k] for k in (language.cut(word, n) if n else [word]) if k in self.counts[n]]
            if found:
                return {x: sum(math.log(c[x] + 0.5) - self.base[n][x] for c in found) / len(found) for x in self.languages}
        return dict.fromkeys(self.languages, 0.0)

    def predict(self, text):
        words = re.findall(r"[^\W\d_]+", (text or "").lower())
        if not words or not self.languages:
            return "und", 0.0
        scored = [self.word(w) for w in words]
        mean = {x: sum(s[x] for s in scored) / len(words) for x in self.languages}
        top = max(mean.values())
        mean = {x: (v - top) * min(language.EVIDENCE, len(words)) for x, v in mean.items()}
        return next(x for x in self.languages if mean[x] >= -1e-9), 1 / sum(math.exp(v) for v in mean.values())


def test_against_plain_python(spark):
    """Scores of whole sf0.001 against plain sums over dictionaries."""
    rows = [(r.doc_id, r.text, r.lang) for r in table(spark, "documents").select("doc_id", "text", "lang").collect()]
    learned = [(t, x) for d, t, x in rows if x is not None and t is not None and zlib.crc32(str(d).encode()) % 5]
    plain = Plain(learned, sorted({x for _, x in learned}))
    got = {r.doc_id: r for r in language.identify(table(spark, "documents")).collect()}
    for doc_id, text, _ in rows:
        want, score = plain.predict(text)
        assert got[doc_id].lang_pred == want and abs(got[doc_id].score - score) < 1e-6
        assert got[doc_id].held_out == (zlib.crc32(str(doc_id).encode()) % 5 == 0)


def test_many_languages(spark):
    """No language is left out, however many there are."""
    rows = [(i, f"word{chr(97 + i % 250 // 26)}{chr(97 + i % 250 % 26)}x common und{chr(97 + i % 250 // 26)}", f"l{i % 250:03d}", "s", 0) for i in range(2500)]
    got = {r.doc_id: r for r in language.identify(docs(spark, rows)).collect()}
    assert len({r.lang_pred for r in got.values()}) == 250
    assert all(got[i].lang_pred == lang for i, _, lang, *_ in rows)


def test_scores_do_not_depend_on_what_is_remembered(spark, monkeypatch):
    want = sorted(map(tuple, language.identify(table(spark, "documents")).collect()))
    model = language.learn(table(spark, "documents"), ~held_out())
    texts = [r.text for r in table(spark, "documents").orderBy("doc_id").collect()]
    monkeypatch.setattr(language, "REMEMBERED", 50)
    monkeypatch.setattr(language, "TEXTS_AT_ONCE", 3)
    names, scores = language.Predictor(model)(texts)
    assert names == [w[2] for w in want] and max(abs(s - w[3]) for s, w in zip(scores, want)) < 1e-9
