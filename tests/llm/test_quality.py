import numpy as np
from cases import EDGES, docs, edges, empty

from fleetlens.llm import quality
from fleetlens.llm.queries import QUERIES

SF01 = "/root/testdata/sf0.01"


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_query_held_out_accuracy(spark):
    got = QUERIES["op9_quality_rank"](spark, SF01)
    known = spark.read.parquet(f"{SF01}/labels.parquet")
    rows = got.join(known, "doc_id").filter("held_out").collect()
    assert got.count() == spark.read.parquet(f"{SF01}/documents.parquet").count()
    good, bad = [r.score for r in rows if r.quality == 1], [r.score for r in rows if r.quality == 0]
    pairs = np.array(good)[:, None] > np.array(bad)[None, :]
    assert pairs.mean() >= 0.97
    assert sum(r.predicted == r.quality for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_held_out_labels_are_not_used(spark):
    rows = [(i, "fine words in a row here" if i % 2 else "!!! ### ###", "en", "s", 0) for i in range(200)]
    from zlib import crc32

    marks = [(i, int((i % 2 == 1) != (crc32(str(i).encode()) % 5 == 0)), 0) for i in range(200)]
    got = quality.rank(docs(spark, rows), quality.fit(docs(spark, rows), labels(spark, marks))).collect()
    assert all(r.predicted == r.doc_id % 2 for r in got)


def test_features_of_rows_do_not_mix():
    data = [b"Ab, ab ab!", b"", b"x", b"\xc3\x89t\xc3\xa9 ***"]
    raw, at = np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)])
    together = quality.features(raw, at)
    for i, text in enumerate(data):
        alone = quality.features(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
        assert np.allclose(together[i], alone[0])
    assert np.isfinite(together).all()


def test_edges(spark):
    source = edges(spark)
    marks = labels(spark, [(4, 1, 0), (5, 0, 0), (6, None, 0), (None, 1, 0), (8, 1, 1), (10, 0, 0), (11, 0, 0), (11, 1, 0), (99, 1, 0)])
    got = quality.rank(source, quality.fit(source, marks)).collect()
    assert len(got) == len(EDGES) and all(0 <= r.score <= 1 for r in got)
    # no label, or one alone: every text stands at the threshold
    for marks in (labels(spark, []), labels(spark, [(4, 1, 0)])):
        got = quality.rank(source, quality.fit(source, marks)).collect()
        assert {round(r.score, 6) for r in got} == {0.3}
    assert quality.rank(empty(spark), quality.fit(empty(spark), labels(spark, []))).count() == 0


def test_every_labelled_row_is_learned_from(spark):
    """Means, weights and threshold are those of all rows that are not held out, however many there are."""
    from zlib import crc32

    rng = np.random.default_rng(4)
    rows = []
    for i in range(30_000):
        marks = int(rng.integers(0, 12))
        rows.append((i, "fine words " * int(rng.integers(1, 4)) + "!" * marks + f"{int(rng.integers(10**9))}", int(marks + rng.normal() < 6)))
    table = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    ranker = quality.fit(table.drop("quality"), table.drop("text"))
    learned = [r for r in rows if crc32(str(r[0]).encode()) % 5]
    raw, at = np.frombuffer("".join(r[1] for r in learned).encode(), np.uint8), np.cumsum([0, *(len(r[1]) for r in learned)])
    x = quality.features(raw, at)
    assert np.allclose(ranker.mean, x.mean(axis=0), rtol=1e-9, atol=1e-12)
    low = sum(r[2] == 0 for r in learned)
    scores = np.sort(ranker.raw(x))
    assert scores[low - 1] <= ranker.threshold + 1e-9 and ranker.threshold <= scores[min(low + np.searchsorted(scores[low:], scores[low - 1] + 1e-8), len(scores) - 1)] + 1e-9
    assert np.mean((ranker.raw(x) > ranker.threshold) == [r[2] for r in learned]) > 0.85


def test_groups_and_their_pairs(spark):
    rows = spark.createDataFrame([(i, int(i < 10), [float(i), 1.0]) for i in range(20_000)], "doc_id long, label int, x array<double>")
    seen, met = set(), set()
    for r in quality.grouped(rows, {0: 19_990, 1: 10}).collect():
        ids, label, x = np.frombuffer(r.ids, np.int64), np.frombuffer(r.label, np.int64), np.frombuffer(r.x, float).reshape(-1, 2)
        assert (x[:, 0] == ids).all() and label.sum() >= 1
        seen |= set(ids.tolist())
        for turn in range(6):
            better, worse = quality.pairs(ids, label, turn)
            assert (label[better] == 1).all() and (label[worse] == 0).all() and len(set(zip(better, worse, strict=True))) == len(better)
            met |= set(ids[worse].tolist())
    assert seen == set(range(20_000)) and len(met) > 0.95 * 19_990


def test_weights_are_where_the_loss_is_least(spark):
    rng = np.random.default_rng(9)
    rows = spark.createDataFrame([(i, int(rng.random() < 0.5 + 0.3 * (i % 3 - 1)), [float(i % 3), float(rng.normal())]) for i in range(600)], "doc_id long, label int, x array<double>")
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    groups = quality.materialize(quality.grouped(rows, counts), "test")
    weights = quality.learn(groups, 2, 6)

    def loss(w):
        n, total, *_ = quality.slopes(groups, w, 6)
        return total / n + quality.PENALTY / 2 * w @ w

    assert weights[0] > 0.1 and all(loss(weights) < loss(weights + d) for d in np.array([[0.01, 0], [-0.01, 0], [0, 0.01], [0, -0.01]]))


def test_nth(spark):
    values = [0.5] * 7 + [-3.0, 1e9, 2.0, 2.0, 1e-12]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    assert [quality.nth(frame, n) for n in (1, 2, 3, 9, 10, 12)] == [sorted(values)[n - 1] for n in (1, 2, 3, 9, 10, 12)]
