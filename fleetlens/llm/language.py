"""Language identification: known words first, shorter and shorter letter n-grams for the rest."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from fleetlens.llm.common import col, fresh, held_out
from fleetlens.session import materialize

#: Documents per language (expected) from which a model learns; more labelled rows are sampled by hash.
SAMPLE_DOCS = 3000
#: Documents of all languages together from which a model learns; with many languages each has fewer.
SAMPLE_TOTAL = 60_000
#: n-grams that unseen words fall back to, longest first.
GRAMS = (5, 4, 3, 2, 1)
#: Largest total weight of a document's evidence, in nats per unit of its mean score.
EVIDENCE = 12.0
#: Words that a task remembers the scores of, and texts that it scores at once.
REMEMBERED, TEXTS_AT_ONCE = 200_000, 256
#: Spark's seed of its 64-bit hash.
SEED = 42
NONE = "und"
LETTERS = re.compile(r"[^\W\d_]+")


class Table:
    """Log frequencies by language of the words, or of the n-grams of one length, as sorted 64-bit hashes.

    A key holds only the languages it was seen in; the smoothed value of all
    others is ``rest``.
    """

    def __init__(self, keys: np.ndarray, langs: np.ndarray, counts: np.ndarray, size: int):
        total = np.bincount(langs, weights=counts, minlength=size)
        order = np.lexsort((langs, keys))
        self.keys, starts = np.unique(keys[order], return_index=True)
        self.starts = np.r_[starts, len(keys)].astype(np.int64)
        base = np.log(total + 0.5 * max(1, len(self.keys)))
        self.rest = np.log(0.5) - base
        self.langs = langs[order].astype(np.int32)
        self.more = (np.log(counts[order] + 0.5) - np.log(0.5)).astype(np.float64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of every key, -1 where there is none."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, -1)

    def add(self, into: np.ndarray, rows: np.ndarray, at: np.ndarray, weight: np.ndarray) -> None:
        """Add the values at ``at`` to the given rows of ``into``, times a weight."""
        n = self.starts[at + 1] - self.starts[at]
        entry = np.repeat(self.starts[at] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        np.add.at(into, (np.repeat(rows, n), self.langs[entry]), self.more[entry] * np.repeat(weight, n))
        np.add.at(into, rows, self.rest * weight[:, None])


def hashes(texts: list[str]) -> np.ndarray:
    """64-bit hashes as Spark's ``xxhash64`` gives them."""
    return np.fromiter((xxh64_intdigest(t.encode(), SEED) for t in texts), np.uint64, len(texts)).view(np.int64)


class Model:
    """Log probabilities by language of words and of letter n-grams; as large as its sample of documents."""

    def __init__(self, languages: list[str], words: tuple, grams: dict[int, tuple]):
        """``words`` and ``grams`` of each length: hashes, numbers of their languages, counts."""
        self.languages = languages
        self.words = Table(*words, len(languages))
        self.by_gram = {n: Table(*columns, len(languages)) for n, columns in grams.items()}

    def scores(self, words: list[str]) -> np.ndarray:
        """Log probability of each word in each language, up to a number per word; zeros if nothing of it is known."""
        out = np.zeros((len(words), len(self.languages)))
        at = self.words.find(hashes(words))
        known = np.flatnonzero(at >= 0)
        self.words.add(out, known, at[known], np.ones(len(known)))
        left = np.flatnonzero(at < 0)
        for n, table in self.by_gram.items():
            if not len(left):
                break
            grams = [cut(words[i], n) for i in left]
            owner = np.repeat(left, [len(g) for g in grams])
            at = table.find(hashes([g for own in grams for g in own]))
            owner, at = owner[at >= 0], at[at >= 0]
            found = np.bincount(owner, minlength=len(words))
            table.add(out, owner, at, 1 / found[owner])
            left = left[found[left] == 0]
        return out


def cut(word: str, n: int) -> list[str]:
    """The n-grams of a word with its two ends marked; a single letter has no mark."""
    if n > 1:
        word = f"<{word}>"
    return [word[i : i + n] for i in range(len(word) - n + 1)]


class Predictor:
    """Predicts texts a slice at a time; scores of words are remembered up to a limit."""

    def __init__(self, model: Model):
        self.model = model
        self.place: dict[str, int] = {}
        self.known = np.empty((0, len(model.languages)))

    def _places(self, words: list[str]) -> np.ndarray:
        new = sorted(set(words) - self.place.keys())
        if new:
            if len(self.place) + len(new) > REMEMBERED:
                self.place.clear()
                self.known = self.known[:0]
                new = sorted(set(words))
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new)), strict=True))
            self.known = np.concatenate([self.known, self.model.scores(new)])
        return np.array([self.place[w] for w in words], np.int64)

    def __call__(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Predicted language and its probability for each text."""
        names, scores = [NONE] * len(texts), np.zeros(len(texts))
        for first in range(0, len(texts) if self.model.languages else 0, TEXTS_AT_ONCE):
            words = [LETTERS.findall(t.lower()) if t else [] for t in texts[first : first + TEXTS_AT_ONCE]]
            rows = np.repeat(np.arange(len(words)), [len(w) for w in words])
            if not len(rows):
                continue
            # each word of a text once, with how often it occurs there
            row, place, n = counted(rows, self._places([w for own in words for w in own]))
            total = np.bincount(row, weights=n, minlength=len(words))
            told = np.flatnonzero(total)
            sums = np.add.reduceat(self.known[place] * n[:, None], np.searchsorted(row, told), axis=0)
            mean = sums / total[told, None]
            mean = (mean - mean.max(axis=1, keepdims=True)) * np.minimum(EVIDENCE, total[told])[:, None]
            # values that differ by rounding alone are equal, and the first language in order is taken
            best = np.argmax(mean >= -1e-9, axis=1)
            scores[first + told] = 1 / np.exp(mean).sum(axis=1)
            for i, b in zip(told, best, strict=True):
                names[first + i] = self.model.languages[b]
        return names, scores


def counted(rows: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs, sorted, and how often each occurs."""
    order = np.lexsort((places, rows))
    rows, places = rows[order], places[order]
    first = np.flatnonzero(np.r_[True, (rows[1:] != rows[:-1]) | (places[1:] != places[:-1])])
    return rows[first], places[first], np.diff(np.r_[first, len(rows)]).astype(float)


def learn(
    docs: DataFrame, where: Column, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id", sample: int = SAMPLE_DOCS, sample_total: int = SAMPLE_TOTAL
) -> Model:
    """A model of every language among the labelled rows that satisfy ``where``.

    Whole texts of about ``sample`` rows per language, ``sample_total`` in all,
    picked by a hash of the id.  Spark counts all their words and n-grams; the
    counts, as large as the sample, make the model on the driver.
    """
    rows = docs.filter(where & col(lang_col).isNotNull() & col(text_col).isNotNull()).select(
        col(lang_col).cast("string").alias("lang"), col(text_col).cast("string").alias("text"), F.xxhash64(col(id_col).cast("string")).alias("draw")
    )
    # one row per language
    counts = rows.groupBy("lang").agg(F.count("*").alias("n")).collect()
    languages = sorted(r["lang"] for r in counts)
    if not languages:
        none = np.empty(0, np.int64)
        return Model([], (none, none, none), {n: (none, none, none) for n in GRAMS})
    each = min(sample, max(1, sample_total // len(languages)))
    number = {lang: i for i, lang in enumerate(languages)}
    shares = docs.sparkSession.createDataFrame([(r["lang"], number[r["lang"]], min(1.0, each / r["n"])) for r in counts], "lang string, number long, share double")
    picked = rows.join(shares, "lang").filter(F.pmod("draw", F.lit(1_000_003)) < F.col("share") * 1_000_003)
    words = picked.select("number", F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("key")).filter("key <> ''")
    words = materialize(words.groupBy("number", "key").agg(F.count("*").alias("n")), "words")
    found = {0: words}
    for n in GRAMS:
        marked = words.withColumn("key", F.concat(F.lit("<"), "key", F.lit(">"))) if n > 1 else words
        found[n] = marked.filter(F.char_length("key") >= n).select("number", F.explode(F.expr(f"transform(sequence(1, char_length(key) - {n - 1}), i -> substring(key, i, {n}))")).alias("key"), "n")
    columns = {}
    for n, table in found.items():
        # numbers only: eight bytes a key, whatever its length
        got = table.groupBy("number", F.xxhash64("key").alias("hash")).agg(F.sum("n").alias("n")).toArrow()
        columns[n] = tuple(got.column(c).to_numpy() for c in ("hash", "number", "n"))
    return Model(languages, columns.pop(0), columns)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row.

    ``score`` is the probability of the predicted language.  Null text, text
    without a letter and an empty model give ``und`` and 0; ties go to the
    language first in order; repeated rows are predicted each; other columns
    are ignored; an empty table gives no rows.  The model is as large as its
    sample of documents and sent to the executors once.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predictor = Predictor(shared.value)
        for frame in frames:
            names, scores = predictor(frame["text"].tolist())
            yield pd.DataFrame({"doc_id": frame["doc_id"], "held_out": frame["held_out"], "lang_pred": names, "score": scores})

    rows = docs.select(col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), col(text_col).cast("string").alias("text"))
    return rows.mapInPandas(work, "doc_id long, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, id_col: str = "doc_id", **settings) -> DataFrame:
    """Predictions for every row by a model that learned from the rows not held out."""
    return predict(docs, learn(docs, ~held_out(id_col), id_col=id_col, **settings), id_col)


def told(predictor: Predictor, texts: list[str | None], least: float) -> list[bool]:
    """Whether each text has a letter and a language that is told with more than an equal chance, and with ``least``."""
    languages = predictor.model.languages
    if not languages:
        return [bool(text and LETTERS.search(text)) for text in texts]
    even = 1 / len(languages)
    return [lang != NONE and score >= least and (len(languages) == 1 or score > even + 1e-9) for lang, score in zip(*predictor(texts), strict=True)]


def keep_known(docs: DataFrame, least: float = 0.0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows whose language is told, with their columns.

    Texts without a letter go, and those that speak for no language more than
    for all others (none of their words or letters was learned); with
    ``least``, also those whose language is less probable.  With one language
    to learn, or none, every text with a letter stays.
    """
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, ~held_out(id_col), id_col=id_col, text_col=text_col))

    @F.pandas_udf("boolean")
    def known(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        predictor = Predictor(model.value)
        for texts in batches:
            yield pd.Series(told(predictor, texts.tolist(), least), dtype=bool)

    mark = fresh(docs.columns, "known")[0]
    return docs.withColumn(mark, known(col(text_col).cast("string"))).filter(col(mark)).drop(mark)
