"""Token counts and ids under a byte-level BPE vocabulary."""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import col

VOCABULARY = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
#: Tokens beyond which a document is marked.
LIMIT = 1024
#: Distinct pre-tokens whose counts a task remembers.
MEMO = 300_000

#: Letters, numbers and white space below U+0250, where the fast splitter is exact.
_L = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_N = "0-9²³¹¼½¾"
_W = r"\t-\r \x85\xa0"
SPLIT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_W}{_L}{_N}]+|[{_W}]+(?![^{_W}])|[{_W}]+")
#: A text with any other character is left to the library.
OUTSIDE = re.compile("[^\x00-ɏ]")


def place(name: str) -> str:
    """A vocabulary file: a path, or the name of a public one."""
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(4)
def tokenizer(name: str = VOCABULARY):
    """The library's tokenizer, one thread, nothing cut or padded."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(place(name))
    out.no_truncation()
    out.no_padding()
    return out


@lru_cache(4)
def ranks_encoding(name: str = RANKS):
    """The same merges as ranks, without special tokens."""
    import public_tokenizers
    import tiktoken

    with open(place(name), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(os.path.basename(name), pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(4)
def specials(name: str = VOCABULARY) -> tuple[str, ...]:
    """Strings that the library turns into special tokens wherever they stand."""
    return tuple(t.content for t in tokenizer(name).get_added_tokens_decoder().values())


def whole_tokens(name: str = VOCABULARY) -> frozenset[str]:
    """Vocabulary strings that, encoded alone, are exactly their one token.

    Each is proven by encoding it; strings that are no valid text (parts of a
    character), or that merges never reach, drop out.
    """
    tok = tokenizer(name)
    ids = sorted(set(tok.get_vocab().values()))
    texts = tok.decode_batch([[i] for i in ids], skip_special_tokens=False)
    found = tok.encode_batch_fast(texts, add_special_tokens=False)
    special = set(specials(name))
    return frozenset(t for i, t, e in zip(ids, texts, found, strict=True) if e.ids == [i] and t not in special and len(SPLIT.findall(t)) == 1)


class Counter:
    """Counts tokens: whole-token pre-tokens by look-up, all others by merging them once."""

    def __init__(self, whole: frozenset[str], name: str = VOCABULARY):
        self.tok = tokenizer(name)
        self.special = specials(name)
        self.known = dict.fromkeys(whole, 1)
        self.limit = len(whole) + MEMO

    def plain(self, text: str) -> bool:
        return not OUTSIDE.search(text) and not any(s in text for s in self.special)

    def counts(self, texts: list[str]) -> list[int]:
        pieces = [SPLIT.findall(t) if self.plain(t) else None for t in texts]
        known = self.known
        rest = list({p for found in pieces if found for p in found if p not in known})
        sizes = map(len, self.tok.encode_batch_fast(rest, add_special_tokens=False))
        if len(known) + len(rest) > self.limit:
            known = known.copy()
        known.update(zip(rest, sizes, strict=True))
        out = [None if found is None else sum(map(known.__getitem__, found)) for found in pieces]
        return [len(self.tok.encode(t, add_special_tokens=False)) if n is None else n for n, t in zip(out, texts, strict=True)]


def groups(texts: list[str | None], size: int = 1 << 20) -> Iterator[list[str]]:
    """Runs of texts of about ``size`` characters; null is an empty text."""
    run, total = [], 0
    for text in texts:
        text = text or ""
        if run and total + len(text) > size:
            yield run
            run, total = [], 0
        run.append(text)
        total += len(text)
    if run:
        yield run


def count_tokens(docs: DataFrame, name: str = VOCABULARY, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row.

    Null and empty texts have 0 bytes and 0 tokens; repeated rows are counted
    each; other columns are ignored; an empty table gives no rows.  The set of
    whole tokens is bounded by the vocabulary and sent to the executors once.
    """
    whole = docs.sparkSession.sparkContext.broadcast(whole_tokens(name))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(whole.value, name)
        for batch in batches:
            found = [n for run in groups(batch.column(2).to_pylist()) for n in counter.counts(run)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    text = col(text_col).cast("string")
    rows = docs.select(col(id_col).cast("long").alias("doc_id"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), text.alias("text"))
    out = rows.mapInArrow(work, "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


def encode(text: str, name: str = VOCABULARY, ranks: str = RANKS) -> np.ndarray:
    """Ids of a text as unsigned 32-bit numbers, equal to the library's.

    The ranks file holds the same merges and encodes several times faster; a
    text with a special string goes to the library itself.
    """
    if any(s in text for s in specials(name)):
        return np.array(tokenizer(name).encode(text, add_special_tokens=False).ids, "<u4")
    return np.array(ranks_encoding(ranks).encode_ordinary(text), "<u4")
