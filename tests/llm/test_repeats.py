import hashlib

import numpy as np
import pytest
from cases import EDGES, SF, docs, edges, empty, texts

from fleetlens.llm import parse, repeats
from fleetlens.llm.queries import QUERIES


def brute(rows):
    first, out = {}, {}
    for doc, text in sorted(rows):
        text = text.encode()
        gone = bytearray(len(text))
        for p in range(len(text) - 49):
            if first.setdefault(text[p : p + 50], doc) < doc:
                gone[p : p + 50] = b"\1" * 50
        runs = sum(1 for k in range(len(gone)) if gone[k] and (not k or not gone[k - 1]))
        left = bytes(c for c, g in zip(text, gone, strict=True) if not g)
        out[doc] = (len(text), sum(gone), runs, hashlib.sha256(left).hexdigest())
    return out


def got(frame):
    return {r.doc_id: tuple(r)[1:] for r in repeats.remove_repeats(frame).collect()}


def test_query(spark):
    rows = {r.doc_id: tuple(r)[1:] for r in QUERIES["op10_suffix_dedup"](spark, SF).collect()}
    want = brute(texts(spark.read.parquet(f"{SF}/documents.parquet")))
    assert rows == want and sum(w[1] for w in want.values()) > 0


@pytest.mark.parametrize("alphabet", ["ab", "abcdefgh ", "é😀x\x00"])
def test_random_texts(spark, alphabet):
    rng = np.random.default_rng(len(alphabet))
    letters = list(alphabet)
    pool = ["".join(rng.choice(letters, int(rng.integers(20, 160)))) for _ in range(25)]
    rows = [(i, "".join(rng.choice(pool) if rng.random() < 0.6 else "".join(rng.choice(letters, 30)) for _ in range(int(rng.integers(1, 6)))), "en", "s", 0) for i in range(120)]
    assert got(docs(spark, rows)) == brute([(r[0], r[1]) for r in rows])


def test_exactly_fifty_bytes(spark):
    shared = "".join(chr(97 + (i * 7) % 26) for i in range(50))
    rows = [(1, "1" + shared + "2", "", "", 0), (2, "3" + shared + "4", "", "", 0), (3, "5" + shared[:49] + "6", "", "", 0), (4, shared + shared, "", "", 0), (5, "a" * 200, "", "", 0), (6, "b" * 200 + "a" * 49, "", "", 0)]
    want = brute([(r[0], r[1]) for r in rows])
    assert got(docs(spark, rows)) == want
    assert [want[i][1] for i in (1, 2, 3, 4, 5, 6)] == [0, 50, 0, 100, 0, 0]


def test_long_text_comes_in_pieces(spark, monkeypatch):
    rng = np.random.default_rng(8)
    text = "".join(rng.choice(list("abcdef "), 9000))
    rows = [(1, text, "", "", 0), (2, "x" * 70 + text[100:8900], "", "", 0), (3, text[4000:4200], "", "", 0)]
    monkeypatch.setattr(repeats, "PIECE", 1000)
    ids, raw = np.array([1]), np.frombuffer(text.encode(), np.uint8)
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([text, "short"])], names=["doc_id", "text"])
    found = list(repeats.parts_of(iter([batch])))
    assert len(found) == 10 and sum(len(f[2]) for f in found[:9]) == 9000 + 8 * 49
    assert got(docs(spark, rows)) == brute([(r[0], r[1]) for r in rows])


def test_every_window_is_in_one_phrase():
    data = [b"abc" * 40, b"", b"x" * 49, b"y" * 50, bytes(range(200))]
    raw, at = np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)])
    row, first, last, *_ = parse.parse(raw, at)
    windows = [w for a, b in zip(first, last, strict=True) for w in range(a, b + 1)]
    assert windows == [p for i in range(5) for p in range(at[i], at[i + 1] - 49)]
    assert all(at[r] <= a and b + 50 <= at[r + 1] for r, a, b in zip(row, first, last, strict=True))


def test_merge():
    ids, a, b = repeats.merge(np.array([2, 1, 1, 1, 2]), np.array([0, 10, 0, 5, 3]), np.array([3, 12, 5, 9, 4]))
    assert list(zip(ids.tolist(), a.tolist(), b.tolist(), strict=True)) == [(1, 0, 9), (1, 10, 12), (2, 0, 4)]


def test_edges(spark):
    rows = repeats.remove_repeats(edges(spark)).collect()
    assert len(rows) == len(EDGES)
    by = {r.doc_id: r for r in rows}
    assert by[1].n_bytes == by[2].n_bytes == 0 and by[1].kept_sha256 == hashlib.sha256(b"").hexdigest()
    # the long text but for its end is a repeat; the null id neither takes nor gives
    assert by[7].n_removed == by[6].n_bytes and by[6].n_removed == by[6].n_spans == 0
    assert by[None].n_removed == 0 and by[10].n_removed == 0 and by[11].n_removed > 0
    assert sum(r.doc_id == 8 for r in rows) == 2 and by[8].n_removed == 0
    assert repeats.remove_repeats(empty(spark)).count() == 0


def test_partitions_make_no_difference(spark):
    source = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    want = got(source.coalesce(1))
    assert got(source.repartition(7)) == want
