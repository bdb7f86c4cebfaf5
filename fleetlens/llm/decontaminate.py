"""Benchmark decontamination with an Aho-Corasick automaton over normalised words.

The windows of all test items make one automaton, in which each word is a few
letters of a small alphabet.  A text is normalised and read once; where a
window ends, its words are hit, and word numbers lead back to places in the
original text.
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import col, ids_column, text_rows
from fleetlens.llm.terms import WORD, split_words, word_rows
from fleetlens.session import materialize

#: Consecutive words that make a hit.
WINDOW = 10
#: Item words in one automaton, about 1.3 kilobytes of memory each; more items make further automata.
WORDS_EACH = 100_000
#: Letters at each place of a word's code; places have letters of their own, so no match begins inside a word.
LETTERS = 64

HITS = "doc_id long, n_words long, n_hit long, items array<string>, spans array<struct<start:int,end:int>>"
FOUND = "row long, firsts array<int>, lasts array<int>, items array<string>"

#: The automaton of this Python worker, by the windows it was made of.
_MADE: dict[str, tuple] = {}


def windows(words: list[bytes], window: int = WINDOW) -> list[tuple[bytes, ...]]:
    """The runs of ``window`` words, or all words as one run if there are fewer."""
    if not words:
        return []
    return [tuple(words[i : i + window]) for i in range(max(1, len(words) - window + 1))]


class Matcher:
    """The automaton over the windows of ``items`` (id as text or null, text)."""

    def __init__(self, items: list[tuple[str | None, str]], window: int = WINDOW):
        owners: dict[tuple[bytes, ...], set[str]] = {}
        for name, text in items:
            for run in windows(split_words(text.encode()), window):
                owners.setdefault(run, set()).update([] if name is None else [name])
        known = sorted({word for run in owners for word in run})
        self.width = 1
        while LETTERS**self.width < len(known):
            self.width += 1
        self.codes = {word: self._code(number) for number, word in enumerate(known)}
        self.unknown = chr(LETTERS * self.width) * self.width
        self.automaton = ahocorasick.Automaton()
        for run, names in owners.items():
            self.automaton.add_word("".join([self.codes[w] for w in run]), (len(run), tuple(names)))
        self.shortest = min(map(len, owners), default=0)
        if owners:
            self.automaton.make_automaton()

    def _code(self, number: int) -> str:
        letters = []
        for place in reversed(range(self.width)):
            letters.append(chr(LETTERS * place + number % LETTERS))
            number //= LETTERS
        return "".join(reversed(letters))

    def runs(self, words: list[bytes]) -> tuple[list[list[int]], set[str]]:
        """Maximal runs ``[first, last]`` of hit words, and the items whose windows occur."""
        if not self.shortest or len(words) < self.shortest:
            return [], set()
        get, unknown = self.codes.get, self.unknown
        found, names = [], set()
        for end, (size, owners) in self.automaton.iter("".join([get(w, unknown) for w in words])):
            last = end // self.width
            found.append((last - size + 1, last))
            names.update(owners)
        return joined(found), names


def joined(found: list[tuple[int, int]]) -> list[list[int]]:
    """Runs that touch or overlap as one."""
    out: list[list[int]] = []
    for first, last in sorted(found):
        if out and first <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return out


def places(text: str, runs: list[list[int]]) -> list[dict[str, int]]:
    """Code points of the original text that each run of words covers, end exclusive."""
    if not runs:
        return []
    at = [m.span() for m in WORD.finditer(text)]
    return [{"start": at[first][0], "end": at[last][1]} for first, last in runs]


def _matcher(key: str, items: list, window: int) -> Matcher:
    """One automaton at a time in a Python worker, kept between tasks."""
    if key not in _MADE:
        _MADE.clear()
        _MADE[key] = Matcher(items, window)
    return _MADE[key]


def _report(rows: list[tuple]) -> pa.RecordBatch:
    ids, n_words, n_hit, items, spans = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [
            ids_column(np.array(ids, np.int64)),
            pa.array(n_words, pa.int64()),
            pa.array(n_hit, pa.int64()),
            pa.array(items, pa.list_(pa.string())),
            pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
        ],
        names=["doc_id", "n_words", "n_hit", "items", "spans"],
    )


def _row(doc_id: int, text: bytes, n_words: int, runs: list[list[int]], names) -> tuple:
    spans = places(text.decode("utf-8", "replace"), runs)
    return doc_id, n_words, sum(last - first + 1 for first, last in runs), sorted(names), spans


def item_groups(benchmark: DataFrame, id_col: str, text_col: str, words_each: int) -> Iterator[list[tuple[str | None, str]]]:
    """The items in groups of at most ``words_each`` words, one group at a time; a longer item is a group of its own."""
    rows = benchmark.select(col(id_col).cast("string").alias("name"), F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = materialize(rows.distinct(), "items")
    group: list = []
    room = words_each
    for row in rows.toLocalIterator():
        n = len(split_words(row.text.encode()))
        if n > room and group:
            yield group
            group, room = [], words_each
        group.append((row.name, row.text))
        room -= n
    yield group


def find_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    words_each: int = WORDS_EACH,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_words, n_hit, items, spans`` of every row of ``docs``.

    Words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` with A-Z as a-z.  A
    window is ``window`` consecutive words of an item, or all of them if it has
    fewer.  A word inside any occurrence of a window is hit; ``items`` are the
    ids (as text, sorted) of the items with such a window, ``spans`` the maximal
    runs of hit words as code points of the original text, end exclusive.

    The test items go to every executor, at most ``words_each`` words of them
    at a time: a larger benchmark makes several automata, each with a scan of
    the texts of its own (a single item over the bound stays whole).

    Null texts have no words, on either side.  Items that repeat change nothing;
    an item whose id is null hits words but is not listed.  Rows that repeat an id
    are judged each by itself, null ids stay null, other columns are ignored.  No
    documents give no rows; without items no word is hit.
    """
    groups = item_groups(benchmark, item_col, item_text_col, words_each)
    items, more = next(groups), next(groups, None)
    texts = text_rows(docs, id_col, text_col)
    key = uuid.uuid4().hex
    if more is None:

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = _matcher(key, items, window)
            for ids, raw, at, words in word_rows(batches):
                yield _report([_row(ids[i], raw[at[i] : at[i + 1]], len(w), *matcher.runs(w)) for i, w in enumerate(words)])

        return texts.mapInArrow(scan, HITS)

    # several automata: rows get a number that all scans share, and what they find is put together by it
    rows = materialize(texts.withColumn("row", F.monotonically_increasing_id()), "texts")

    def scan_with(number: int, items: list):
        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = _matcher(f"{key}-{number}", items, window)
            for ids, _, _, words in word_rows(batches):
                out = []
                for i, w in enumerate(words):
                    runs, names = matcher.runs(w)
                    if runs:
                        out.append((int(ids[i]), [r[0] for r in runs], [r[1] for r in runs], sorted(names)))
                if out:
                    kinds = [pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.string())]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=["row", "firsts", "lasts", "items"])

        return scan

    found = None
    for number, items in enumerate(itertools.chain([items, more], groups)):
        part = materialize(rows.select("row", "text").mapInArrow(scan_with(number, items), FOUND), f"hits{number}")
        found = part if found is None else found.union(part)
    merged = found.groupBy("row").agg(*[F.flatten(F.collect_list(c)).alias(c) for c in ("firsts", "lasts", "items")])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = iter(zip(*(batch.column(k).to_pylist() for k in (2, 3, 4)), strict=True))
            for ids, raw, at, words in word_rows(iter([batch.select([0, 1])])):
                out = []
                for i, w in enumerate(words):
                    firsts, lasts, names = next(hits)
                    out.append(_row(ids[i], raw[at[i] : at[i + 1]], len(w), joined(list(zip(firsts or [], lasts or [], strict=True))), set(names or [])))
                yield _report(out)

    return rows.join(merged, "row", "left").select("doc_id", "text", "firsts", "lasts", "items").mapInArrow(finish, HITS)


def report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``find_hits`` with its items as a count and a digest: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``."""
    found = find_hits(docs, benchmark, **options)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
