"""Repeated byte strings by prefix-free parsing.

Phrases of the parse are dealt by their trigger.  Equal phrases make one
dictionary entry, owned by the smallest document that has it; in any other
document the whole phrase is a repeat.  Entries of one trigger that belong to
several documents and agree on one side of it may still share strings shorter
than a phrase: the suffixes of these entries are sorted, and runs of equal
suffixes give what repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import NULL_ID, buckets_for, buffers, ids_column, slices, text_rows
from fleetlens.llm.parse import PIECE, SPAN, parse
from fleetlens.session import materialize

LISTS = {
    "ids": np.int64, "counts": np.uint32, "starts": np.uint32, "ends": np.uint32, "widths": np.uint8,
    "triggers": np.uint32, "phrases": np.uint64, "lefts": np.uint16, "rights": np.uint16,
}
PACKED = ", ".join(f"{name} binary" for name in LISTS)


def pack_runs(key: np.ndarray, kind: int, ids: np.ndarray, **lists: np.ndarray) -> list[tuple]:
    """Rows ``(key, kind, packed lists)``, one per key; ids are stored once per run."""
    by = np.lexsort((ids, key))
    key, ids = key[by], ids[by]
    lists = {name: v[by] for name, v in lists.items()}
    edges = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True]) if len(key) else np.zeros(1, int)
    out = []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        runs = np.flatnonzero(np.r_[True, ids[a + 1 : b] != ids[a : b - 1]])
        counts = np.diff(np.r_[runs, b - a]).astype(np.uint32)
        rest = [lists[n][a:b].astype(LISTS[n]).tobytes() if n in lists else b"" for n in list(LISTS)[2:]]
        out.append((int(key[a]), kind, ids[a:b][runs].tobytes(), counts.tobytes(), *rest))
    return out


def unpack(table: pa.Table) -> dict[str, np.ndarray]:
    found = {name: np.frombuffer(b"".join(table.column(name).to_pylist()), kind) for name, kind in LISTS.items()}
    found["ids"] = np.repeat(found["ids"], found["counts"])
    return found


def packed_batch(rows: list[tuple], key: str) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * (2 + len(LISTS))
    kinds = [pa.int64(), pa.int32(), *[pa.binary()] * len(LISTS)]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[key, "kind", *LISTS])


def merge(ids: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unions of the ranges of each id, in order; ranges that touch become one."""
    if not len(ids):
        return ids, start, end
    by = np.lexsort((start, ids))
    ids, start, end = ids[by], start[by].astype(np.int64), end[by].astype(np.int64)
    group = np.cumsum(np.r_[0, ids[1:] != ids[:-1]])
    room = int(end.max()) + 2
    reach = np.maximum.accumulate(end + group * room)
    new = np.r_[True, start[1:] + group[1:] * room > reach[:-1]]
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(ids)] - 1
    return ids[first], start[first], reach[last] - group[last] * room


def parts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``(ids, offsets, bytes, starts)``: slices of rows; a very long text comes in pieces that overlap by a window."""
    for ids, raw, at in slices(batches, PIECE):
        if len(raw) <= PIECE:
            yield ids, np.zeros(len(ids), np.int64), raw, at
            continue
        for begin in range(0, len(raw), PIECE):
            piece = raw[begin : begin + PIECE + SPAN - 1]
            yield ids, np.array([begin]), piece, np.array([0, len(piece)])


def ranges(ids: np.ndarray, start: np.ndarray, end: np.ndarray, key: np.ndarray, kind: int) -> list[tuple]:
    return pack_runs(key, kind, ids, starts=start, ends=end)


def shard_of(ids: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each document; neighbouring ids stay together, so runs stay long."""
    return ((ids >> np.int64(6)) % shards).astype(np.int64)


COVER, ASK = 0, 1


def shared_mark(trigger: np.ndarray, mark: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """True for entries whose trigger and mark another document has too."""
    by = np.lexsort((mark, trigger))
    new = np.r_[True, (trigger[by][1:] != trigger[by][:-1]) | (mark[by][1:] != mark[by][:-1])]
    edge, own = np.flatnonzero(new), doc[by]
    out = np.zeros(len(doc), bool)
    out[by] = (np.minimum.reduceat(own, edge) != np.maximum.reduceat(own, edge))[np.cumsum(new) - 1]
    return out & (mark > 0)


def phrase_plan(docs: DataFrame, buckets: int) -> DataFrame:
    """``doc_id, starts, ends, ask_starts, ask_widths, ask_triggers``: what repeats as whole phrases,
    and which phrases have to be compared suffix by suffix."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, offsets, raw, at in parts_of(batches):
            found = parse(raw, at)
            known = ids[found[0]] != NULL_ID
            row, first, last, trigger, phrase, left, right = (v[known] for v in found)
            doc, start = ids[row], offsets[row] + first - at[row]
            width = last - first + SPAN
            # of equal phrases of a slice only the smallest document's travel on
            by = np.lexsort((doc, phrase))
            lead = np.r_[True, phrase[by][1:] != phrase[by][:-1]] if len(by) else np.empty(0, bool)
            owner = doc[by][np.flatnonzero(lead)[np.cumsum(lead) - 1]] if len(by) else doc
            repeat = np.zeros(len(doc), bool)
            repeat[by] = doc[by] > owner
            own = ~repeat
            bucket = (trigger[own] >> np.uint64(32)) % np.uint64(buckets)
            out = pack_runs(bucket.astype(np.int64), ASK, doc[own], starts=start[own], widths=width[own], triggers=trigger[own] & np.uint64(0xFFFFFFFF), phrases=phrase[own], lefts=left[own], rights=right[own])
            d, s, e = merge(doc[repeat], start[repeat], start[repeat] + width[repeat])
            out += ranges(d, s, e, buckets + shard_of(d, buckets), COVER)
            yield packed_batch(out, "bucket")

    def meet(table: pa.Table) -> pa.Table:
        v = unpack(table)
        doc, start, width = v["ids"], v["starts"].astype(np.int64), v["widths"].astype(np.int64)
        if table.column("kind")[0].as_py() == COVER:
            return pa.Table.from_batches([packed_batch(ranges(doc, start, v["ends"], shard_of(doc, buckets), COVER), "shard")])
        by = np.lexsort((doc, v["phrases"], v["triggers"]))
        doc, start, width, trigger, phrase = doc[by], start[by], width[by], v["triggers"][by], v["phrases"][by]
        new_phrase = np.r_[True, (trigger[1:] != trigger[:-1]) | (phrase[1:] != phrase[:-1])]
        heads = np.flatnonzero(new_phrase)
        repeat = doc > doc[heads][np.cumsum(new_phrase) - 1]
        entry = np.flatnonzero(~repeat)
        near = shared_mark(trigger[entry], v["lefts"][by][entry], doc[entry]) | shared_mark(trigger[entry], v["rights"][by][entry], doc[entry])
        ask = entry[near]
        out = ranges(doc[repeat], start[repeat], start[repeat] + width[repeat], shard_of(doc[repeat], buckets), COVER)
        out += pack_runs(shard_of(doc[ask], buckets), ASK, doc[ask], starts=start[ask], widths=width[ask], triggers=trigger[ask])
        return pa.Table.from_batches([packed_batch(out, "shard")])

    def gather(table: pa.Table) -> pa.Table:
        kind = np.array(table.column("kind").to_pylist())
        cover, ask = (unpack(table.filter(pa.array(kind == k))) for k in (COVER, ASK))
        d, s, e = merge(cover["ids"], cover["starts"], cover["ends"])
        by = np.lexsort((ask["starts"], ask["ids"]))
        ids = np.union1d(d, ask["ids"])

        def cuts(owner: np.ndarray) -> np.ndarray:
            return np.append(np.searchsorted(owner, ids), len(owner))

        def lists(values: np.ndarray) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array(cuts(d).astype(np.int32)), pa.array(values.astype(np.int32)))

        def packed_lists(values: np.ndarray) -> pa.Array:
            at, data = cuts(ask["ids"][by]), values[by]
            return pa.array([data[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())

        return pa.table(
            {
                "doc_id": pa.array(ids),
                "starts": lists(s),
                "ends": lists(e),
                "ask_starts": packed_lists(ask["starts"]),
                "ask_widths": packed_lists(ask["widths"]),
                "ask_triggers": packed_lists(ask["triggers"]),
            }
        )

    packed = docs.mapInArrow(send, f"bucket long, kind int, {PACKED}")
    met = packed.groupBy("bucket").applyInArrow(meet, f"shard long, kind int, {PACKED}")
    return met.groupBy("shard").applyInArrow(
        gather, "doc_id long, starts array<int>, ends array<int>, ask_starts binary, ask_widths binary, ask_triggers binary"
    )


def suffix_repeats(data: np.ndarray, begin: np.ndarray, width: np.ndarray, doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(document, place)`` of every window of the entries that a smaller document's entry holds too.

    The suffixes of all entries, as far as a window reaches, are put in order;
    equal neighbours are one string.
    """
    each = width - SPAN + 1
    entry = np.repeat(np.arange(len(width)), each)
    inner = np.arange(len(entry)) - np.repeat(np.cumsum(each) - each, each)
    place = begin[entry] + inner
    padded = np.zeros(len(data) + 64, np.uint8)
    padded[: len(data)] = data
    words = []
    for k in range(0, SPAN, 8):
        word = np.zeros(len(place), np.uint64)
        for i in range(k, min(k + 8, SPAN)):
            word = (word << np.uint64(8)) | padded[place + i]
        words.append(word)
    own = doc[entry]
    order = np.lexsort((own, *words[::-1]))
    new = np.ones(len(order), bool)
    new[1:] = False
    for word in words:
        w = word[order]
        new[1:] |= w[1:] != w[:-1]
    least = own[order][np.flatnonzero(new)[np.cumsum(new) - 1]] if len(order) else own
    found = order[own[order] > least]
    return own[found], start[entry[found]] + inner[found]


def window_repeats(docs: DataFrame, plan: DataFrame, buckets: int) -> DataFrame:
    """``doc_id, starts, ends``: repeats inside the dictionary entries that ``plan`` asks for."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            raw, at = buffers(batch.column(1))
            lists = [batch.column(i).to_pylist() for i in (2, 3, 4)]
            starts, widths, triggers = (np.frombuffer(b"".join(v), k).astype(np.int64) for v, k in zip(lists, (np.uint32, np.uint8, np.uint32), strict=True))
            row = np.repeat(np.arange(len(ids)), [len(w) for w in lists[1]])
            fits = starts + widths <= np.diff(at)[row]
            row, starts, widths, triggers = row[fits], starts[fits], widths[fits], triggers[fits]
            for a in range(0, len(row), 1 << 15):
                r, s, w = row[a : a + (1 << 15)], starts[a : a + (1 << 15)], widths[a : a + (1 << 15)]
                bucket = triggers[a : a + (1 << 15)] % buckets
                by = np.argsort(bucket, kind="stable")
                r, s, w, bucket = r[by], s[by], w[by], bucket[by]
                at_byte = np.repeat(at[r] + s, w) + np.arange(int(w.sum())) - np.repeat(np.cumsum(w) - w, w)
                data = raw[at_byte]
                upto = np.r_[0, np.cumsum(w)]
                edges = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True])
                out = [
                    (int(bucket[x]), ids[r[x:y]].tobytes(), s[x:y].tobytes(), w[x:y].astype(np.uint8).tobytes(), data[upto[x] : upto[y]].tobytes())
                    for x, y in zip(edges[:-1], edges[1:], strict=True)
                ]
                columns = list(zip(*out, strict=True))
                kinds = [pa.int64(), *[pa.binary()] * 4]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["bucket", "ids", "starts", "widths", "data"])

    def meet(table: pa.Table) -> pa.Table:
        def joined(name: str, kind) -> np.ndarray:
            return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)

        width = joined("widths", np.uint8).astype(np.int64)
        doc, start = suffix_repeats(joined("data", np.uint8), np.cumsum(width) - width, width, joined("ids", np.int64), joined("starts", np.int64))
        d, s, e = merge(doc, start, start + SPAN)
        first = np.flatnonzero(np.r_[True, d[1:] != d[:-1]]) if len(d) else np.empty(0, int)
        cuts = pa.array(np.r_[first, len(d)].astype(np.int32))
        s, e = (pa.ListArray.from_arrays(cuts, pa.array(v.astype(np.int32))) for v in (s, e))
        return pa.table({"doc_id": pa.array(d[first]), "starts": s, "ends": e})

    asked = plan.filter(F.octet_length("ask_widths") > 0).select("doc_id", "ask_starts", "ask_widths", "ask_triggers")
    texts = docs.join(asked, "doc_id").select("doc_id", "text", "ask_starts", "ask_widths", "ask_triggers")
    sent = texts.mapInArrow(send, "bucket long, ids binary, starts binary, widths binary, data binary")
    return sent.groupBy("bucket").applyInArrow(meet, "doc_id long, starts array<int>, ends array<int>")


def repeated_ranges(docs: DataFrame) -> DataFrame:
    """``doc_id, starts, ends`` (byte ranges, maybe overlapping) of rows ``doc_id, text`` that hold a repeat."""
    buckets = buckets_for(docs)
    plan = materialize(phrase_plan(docs, buckets), "phrases")
    inner = materialize(window_repeats(docs, plan, buckets), "suffixes")
    found = plan.filter(F.size("starts") > 0).select("doc_id", "starts", "ends").union(inner)
    return materialize(found.groupBy("doc_id").agg(F.flatten(F.collect_list("starts")).alias("starts"), F.flatten(F.collect_list("ends")).alias("ends")), "repeats")


def with_ranges(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``doc_id, text, starts, ends`` of every row; null lists where nothing repeats.  The texts are shuffled by id."""
    return docs.join(found, "doc_id", "left").select("doc_id", "text", "starts", "ends")


def kept_pieces(raw: np.ndarray, starts, ends) -> tuple[list[np.ndarray], int, int]:
    """What is left of a text, how many bytes went, and in how many runs."""
    starts, ends = np.minimum(np.asarray(starts, np.int64), len(raw)), np.minimum(np.asarray(ends, np.int64), len(raw))
    _, s, e = merge(np.zeros(len(starts), np.int64), starts, ends)
    left = [raw[a:b] for a, b in zip(np.r_[0, e], np.r_[s, len(raw)], strict=True)]
    return left, int((e - s).sum()), len(s)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row.

    A byte goes if a string of ``SPAN`` bytes that covers it also starts in a
    row with a smaller id; strings are judged on the input.  Null text counts
    as empty.  Rows that repeat an id are taken as copies of one text: none is
    smaller than another, and each loses the same ranges.  Null ids neither
    lose nor take anything.  Other columns are ignored; an empty table gives no
    rows.
    """
    texts = text_rows(docs, id_col, text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = buffers(batch.column(1))
            starts, ends = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            out = []
            for i in range(len(starts)):
                left, gone, runs = kept_pieces(raw[at[i] : at[i + 1]], starts[i] or [], ends[i] or [])
                digest = hashlib.sha256()
                for piece in left:
                    digest.update(piece)
                out.append((int(at[i + 1] - at[i]), gone, runs, digest.hexdigest()))
            columns = list(zip(*out, strict=True)) or [()] * 4
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    found = repeated_ranges(texts)
    return with_ranges(texts, found).mapInArrow(work, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
