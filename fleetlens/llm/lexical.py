"""Ranked lexical search with geometric blocks of posting lists and exact bounds.

Documents are indexed in shards of a few thousand.  In a shard, the posting
list of a term is cut into blocks of documents that look alike, and a block
keeps, coordinate by coordinate, the largest impact of its documents.  A
query's product with such a summary bounds the score of every document of the
block; a block is skipped only if that bound is below a score that enough
documents are known to reach.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import NULL_ID, col, ids_column, text_rows
from fleetlens.llm.terms import split_words, word_rows
from fleetlens.session import materialize

#: Documents returned for a query.
TOP = 50
#: Distinct query terms of one pass over the index; more queries make further passes.
TERMS_EACH = 8192
#: Documents of a shard at most, and cells of its table of impacts (four bytes each).
SHARD_DOCS, SHARD_CELLS = 1024, 4 << 20
#: Shards in a row group of the index, which bounds what a reading task holds at once.
GROUP_SHARDS = 2
#: Documents that a block aims at, and signs of the sketch by which they are put together.
BLOCK, SIGNS = 16, 32
#: A term that shares queries with more terms than this has one block without a summary.
WIDEST = 512
#: Lists and blocks of a shard that a query looks at for its first scores.
FIRST_LISTS, FIRST_BLOCKS = 4, 2

VECTORS = "doc_id long, n long, terms array<int>, counts array<int>"
INDEX = (
    "doc_ids array<long>, starts array<int>, terms array<int>, impacts array<int>, list_terms array<int>, list_starts array<int>,"
    " list_tops array<int>, postings array<int>, list_blocks array<int>, block_starts array<int>, summary_starts array<int>, summary_terms array<int>, summary_tops array<int>"
)
FOUND = "query int, doc_id long, score long"


def weight(n_docs: int, df: int) -> int:
    """A term's weight."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Plan:
    """What all tasks know of some queries: terms, weights, and which terms meet in a query."""

    def __init__(self, queries: list[tuple[int, list[bytes]]]):
        self.numbers: dict[bytes, int] = {}
        self.queries = [(q, np.array(sorted({self.numbers.setdefault(w, len(self.numbers)) for w in words}), np.int64)) for q, words in queries]
        meets: list[set[int]] = [set() for _ in self.numbers]
        for _, terms in self.queries:
            for t in terms:
                if len(meets[t]) <= WIDEST:
                    meets[t].update(terms.tolist())
        #: For each term the terms that its summaries hold: those it meets in a query.  None if they are too many.
        self.asked = [np.array(sorted(m), np.int64) if len(m) <= WIDEST else None for m in meets]
        self.n_docs = self.n_terms = 0
        self.weights = np.zeros(len(self.numbers), np.int64)

    def learn(self, n_docs: int, n_terms: int, df: dict[int, int]) -> None:
        self.n_docs, self.n_terms = n_docs, n_terms
        self.weights = np.array([weight(n_docs, df.get(t, 0)) for t in range(len(self.numbers))], np.int64)

    def impacts(self, n: int, counts: list[int]) -> list[int]:
        length = 50 + 50 * n * self.n_docs // self.n_terms
        return [1_000_000_000 * tf // (1000 * tf + 20 * length) for tf in counts]


def vectors(texts: DataFrame, plan: Plan) -> DataFrame:
    """``doc_id, n, terms, counts`` of every row of ``texts`` (doc_id, text): how often it holds the queries' terms."""
    numbers = plan.numbers

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, _, words in word_rows(batches):
            terms, counts = [], []
            for own in words:
                held = Counter(map(numbers.get, own))
                held.pop(None, None)
                terms.append(sorted(held))
                counts.append([held[t] for t in terms[-1]])
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([ids_column(ids), pa.array(list(map(len, words)), pa.int64()), pa.array(terms, kind), pa.array(counts, kind)], names=["doc_id", "n", "terms", "counts"])

    return texts.mapInArrow(work, VECTORS)


def blocks_of(members: np.ndarray, sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The members of one posting list, block by block, and where blocks start.

    Every document goes to the pivot whose sketch is most like its own; pivots
    are spread evenly along the first sign, so equal lists give equal blocks.
    """
    if len(members) <= BLOCK:
        return members, np.zeros(1, np.int64)
    own = sketch[members]
    along = np.argsort(own[:, 0], kind="stable")
    pivots = own[along[np.linspace(0, len(members) - 1, -(-len(members) // BLOCK)).astype(np.int64)]]
    block = np.argmax(own @ pivots.T, axis=1)
    by = np.argsort(block, kind="stable")
    block = block[by]
    return members[by], np.flatnonzero(np.r_[True, block[1:] != block[:-1]])


def table_of(starts: np.ndarray, terms: np.ndarray, impacts: np.ndarray, width: int) -> np.ndarray:
    """Impacts as a table of documents by terms."""
    table = np.zeros((len(starts) - 1, width), np.int32)
    table[np.repeat(np.arange(len(starts) - 1), np.diff(starts)), terms] = impacts
    return table


def build_shard(rows: list[tuple[int, list[int], list[int]]], plan: Plan, signs: np.ndarray) -> dict[str, np.ndarray]:
    """The index of some documents ``(doc_id, terms, impacts)``."""
    starts = np.cumsum([0, *(len(r[1]) for r in rows)])
    terms = np.array([t for r in rows for t in r[1]], np.int64)
    impacts = np.array([v for r in rows for v in r[2]], np.int64)
    table = table_of(starts, terms, impacts, len(plan.numbers))
    sketch = table.astype(np.float32) @ signs
    sketch /= np.maximum(np.linalg.norm(sketch, axis=1, keepdims=True), 1e-6)
    doc = np.repeat(np.arange(len(rows)), np.diff(starts))
    by = np.argsort(terms, kind="stable")
    list_starts = np.flatnonzero(np.r_[True, np.diff(terms[by]) != 0]) if len(by) else np.empty(0, np.int64)
    list_terms = terms[by][list_starts]
    tops = np.maximum.reduceat(impacts[by], list_starts) if len(by) else list_starts
    list_starts = np.r_[list_starts, len(by)]
    members, list_blocks, block_starts, sizes, top_terms, top_values = doc[by], [0], [], [], [], []
    for i, term in enumerate(list_terms):
        first, last, asked = list_starts[i], list_starts[i + 1], plan.asked[term]
        if asked is None:
            block_starts.append(np.array([first]))
            sizes.append(np.zeros(1, np.int64))
        else:
            members[first:last], begin = blocks_of(members[first:last], sketch)
            top = np.maximum.reduceat(table[np.ix_(members[first:last], asked)], begin, axis=0)
            block, column = np.nonzero(top)
            block_starts.append(first + begin)
            sizes.append(np.bincount(block, minlength=len(begin)))
            top_terms.append(asked[column])
            top_values.append(top[block, column])
        list_blocks.append(list_blocks[-1] + len(block_starts[-1]))
    none = [np.empty(0, np.int64)]
    return {
        "doc_ids": np.array([r[0] for r in rows], np.int64),
        "starts": starts,
        "terms": terms,
        "impacts": impacts,
        "list_terms": list_terms,
        "list_starts": list_starts,
        "list_tops": tops,
        "postings": members,
        "list_blocks": np.array(list_blocks),
        "block_starts": np.r_[np.concatenate(block_starts or none), len(by)],
        "summary_starts": np.r_[0, np.cumsum(np.concatenate(sizes or none))],
        "summary_terms": np.concatenate(top_terms or none),
        "summary_tops": np.concatenate(top_values or none),
    }


def index(found: DataFrame, plan: Plan) -> DataFrame:
    """One row per shard: its documents' impacts, its posting lists in blocks, and the blocks' summaries."""
    docs_each = max(64, min(SHARD_DOCS, SHARD_CELLS // max(1, len(plan.numbers))))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signs = np.random.default_rng(1).choice(np.array([-1, 1], np.float32), (len(plan.numbers), SIGNS))

        def packed(rows: list) -> pa.RecordBatch:
            shard = build_shard(rows, plan, signs)
            columns = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v.astype(np.int64 if k == "doc_ids" else np.int32))) for k, v in shard.items()]
            return pa.RecordBatch.from_arrays(columns, names=list(shard))

        rows: list = []
        for batch in batches:
            ids = batch.column(0).fill_null(NULL_ID).to_pylist()
            for doc_id, n, terms, counts in zip(ids, *(batch.column(k).to_pylist() for k in (1, 2, 3)), strict=True):
                # a document without any of the terms has score 0 for every query
                if terms:
                    rows.append((doc_id, terms, plan.impacts(n, counts)))
                if len(rows) >= docs_each:
                    yield packed(rows)
                    rows = []
        if rows:
            yield packed(rows)

    return found.mapInArrow(work, INDEX)


class Shard:
    """One row of the index, ready to be asked."""

    def __init__(self, batch: pa.RecordBatch, row: int, plan: Plan):
        for name in batch.schema.names:
            setattr(self, name, batch.column(name)[row].values.to_numpy(zero_copy_only=False).astype(np.int64))
        self.plan = plan
        self.table = table_of(self.starts, self.terms, self.impacts, len(plan.numbers))
        self.place = np.full(len(plan.numbers), -1, np.int64)
        self.place[self.list_terms] = np.arange(len(self.list_terms))
        # ids in ascending order with nulls last
        self.order = np.empty(len(self.doc_ids), np.int64)
        self.order[np.lexsort((self.doc_ids, self.doc_ids == NULL_ID))] = np.arange(len(self.doc_ids))

    def bounds(self, number: int, weights: np.ndarray) -> np.ndarray | None:
        """For each block of a list the most that any of its documents may score, None if it has no summary."""
        at = self.summary_starts[self.list_blocks[number] : self.list_blocks[number + 1] + 1]
        if at[0] == at[-1]:
            return None
        # a block's summary holds the list's own term at least, so no sum is over nothing
        return np.add.reduceat(weights[self.summary_terms[at[0] : at[-1]]] * self.summary_tops[at[0] : at[-1]], at[:-1] - at[0])

    def asking(self, terms: np.ndarray) -> np.ndarray:
        """The weights of a query's terms among all terms."""
        weights = np.zeros(len(self.plan.weights), np.int64)
        weights[terms] = self.plan.weights[terms]
        return weights

    def members(self, blocks: np.ndarray) -> list[np.ndarray]:
        return [self.postings[self.block_starts[b] : self.block_starts[b + 1]] for b in blocks]

    def best(self, candidates: list[np.ndarray], terms: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and exact scores of the best candidates that score ``least`` or more."""
        rows = np.unique(np.concatenate(candidates)) if candidates else np.empty(0, np.int64)
        scores = self.table[np.ix_(rows, terms)].astype(np.int64) @ self.plan.weights[terms]
        rows, scores = rows[scores >= least], scores[scores >= least]
        by = np.lexsort((self.order[rows], -scores))[:TOP]
        return rows[by], scores[by]

    def lists(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists of a query's terms by falling largest share of a score, and these shares."""
        numbers = self.place[terms]
        numbers = numbers[numbers >= 0]
        most = self.plan.weights[self.list_terms[numbers]] * self.list_tops[numbers]
        by = np.argsort(-most, kind="stable")
        return numbers[by], most[by]

    def first(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Good documents from the most promising blocks: their scores are the first thresholds."""
        candidates, weights = [], self.asking(terms)
        for number in self.lists(terms)[0][:FIRST_LISTS]:
            bounds = self.bounds(number, weights)
            begin = self.list_blocks[number]
            if bounds is None:
                candidates.append(self.postings[self.list_starts[number] : self.list_starts[number + 1]][:TOP])
            else:
                candidates += self.members(begin + np.argsort(-bounds, kind="stable")[:FIRST_BLOCKS])
        return self.best(candidates, terms, 1)

    def search(self, terms: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """All documents that score ``least`` or more, the best ``TOP`` of them.

        Lists are taken until the shares of the others cannot reach ``least``
        together; of these lists only blocks whose bound reaches it are read.
        """
        numbers, most = self.lists(terms)
        rest = np.cumsum(most[::-1])[::-1]
        candidates, weights = [], self.asking(terms)
        for number in numbers[rest >= least]:
            bounds = self.bounds(number, weights)
            begin, end = self.list_blocks[number], self.list_blocks[number + 1]
            candidates += self.members(np.arange(begin, end) if bounds is None else begin + np.flatnonzero(bounds >= least))
        return self.best(candidates, terms, least)


def ask(indexed: DataFrame, plan: Plan, least: dict[int, int] | None = None) -> DataFrame:
    """``query, doc_id, score``: each task's best documents for every query, or its first good ones if nothing is known yet."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {query: (np.empty(0, np.int64), np.empty(0, np.int64)) for query, _ in plan.queries}
        for batch in batches:
            for row in range(batch.num_rows):
                shard = Shard(batch, row, plan)
                for query, terms in plan.queries:
                    rows, scores = shard.first(terms) if least is None else shard.search(terms, least.get(query, 1))
                    if len(rows):
                        ids, scores = np.r_[best[query][0], shard.doc_ids[rows]], np.r_[best[query][1], scores]
                        by = np.lexsort((ids, ids == NULL_ID, -scores))[:TOP]
                        best[query] = ids[by], scores[by]
        queries = np.repeat(np.array(list(best), np.int32), [len(ids) for ids, _ in best.values()])
        ids, scores = (np.concatenate(c) for c in zip(*best.values(), strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(queries), ids_column(ids), pa.array(scores)], names=["query", "doc_id", "score"])

    return indexed.mapInArrow(work, FOUND)


def ranked(found: DataFrame) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= TOP)


def query_groups(queries: DataFrame, id_col: str, text_col: str, terms_each: int) -> Iterator[list[tuple[int, int | None, list[bytes]]]]:
    """Queries ``(number, id, words)`` in groups of at most ``terms_each`` distinct terms, one at a time; a longer query is a group of its own."""
    group, held = [], set()
    rows = queries.select(col(id_col).cast("long").alias("item_id"), F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"))
    for number, row in enumerate(rows.toLocalIterator()):
        words = set(split_words(row.text.encode()))
        if group and len(held | words) > terms_each:
            yield group
            group, held = [], set()
        if words:
            group.append((number, row.item_id, sorted(words)))
            held |= words
    if group:
        yield group


def search(
    docs: DataFrame,
    queries: DataFrame,
    terms_each: int = TERMS_EACH,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``TOP`` best documents of every query.

    Terms are runs of ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]`` with A-Z as
    a-z.  A document scores, for each distinct term of the query, the term's
    ``weight`` times its impact (``Plan.impacts``); counts go over all documents.
    Documents that score 0 are not ranked, equal scores come by ascending id.

    The index holds what documents hold of the queries' terms, every document
    of every posting list.  Queries go to all tasks in groups of ``terms_each``
    terms, each with a pass over the texts of its own.  A first round over the
    index asks the most promising blocks and gives every query a score that
    ``TOP`` documents reach; the second skips blocks that cannot reach it.
    Results are exact.

    Null texts and texts without a term are ranked for nothing and do not count
    as documents; queries without a term give no rows; rows that repeat an id,
    of documents or of queries, are ranked each by itself; null ids stay null and
    come last among equals; other columns are ignored; empty tables give no
    rows.
    """
    spark = docs.sparkSession
    texts = text_rows(docs, id_col, text_col)
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for number, group in enumerate(query_groups(queries, item_col, item_text_col, terms_each)):
        plan = Plan([(q, words) for q, _, words in group])
        found = materialize(vectors(texts, plan), "vectors")
        n_docs, n_terms = found.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not n_terms:
            break
        # one number for each term of the group
        df = found.select(F.explode("terms").alias("term")).groupBy("term").count()
        plan.learn(n_docs, n_terms, {r.term: r["count"] for r in df.collect()})
        indexed = materialize(index(found, plan), "index", **{"parquet.block.row.count.limit": GROUP_SHARDS})
        least = ranked(ask(indexed, plan)).filter(F.col("rank") == TOP).select("query", "score")
        best = ranked(ask(indexed, plan, {r.query: r.score for r in least.collect()}))
        names = spark.createDataFrame([(q, name) for q, name, _ in group], "query int, item_id long")
        part = best.join(names, "query").select("item_id", "rank", "doc_id", "score")
        out = part if number == 0 else out.union(part)
    return out
