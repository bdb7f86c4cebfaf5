"""Jaccard join on word n-grams by vertical partitioning.

All n-grams have one global order, their 64-bit hash.  A set that differs
from a similar one in at most D n-grams keeps some fragment untouched if the
order is cut into so many fragments that more than D of them hold something.
Sets that share a whole fragment are candidates; overlaps of candidates are
counted fragment by fragment and summed per pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import buckets_for, buffers, col, few, fresh, ids_column, mix, slices, text_rows
from fleetlens.llm.components import components
from fleetlens.llm.scan import shingle_sets
from fleetlens.session import materialize, scratch

#: Words per n-gram and least similarity in hundredths, unless a caller says otherwise.
WIDTH = 5
PERCENT = 80
#: Chance below which a similar pair may share no whole fragment.
MISSED = 1e-10
#: Ratio between the sizes at the two ends of a size class.
CLASS_RATIO = 1.3
#: Fragments in which overlaps are counted.
COUNT_BITS = 3
#: Least bits of the parity sketch that rules out pairs before their overlap is counted; larger sets have about a bit per n-gram.
SKETCH_BITS = 512
#: Members of a signature that the others are compared with, one after the other, before rare n-grams tell what to compare.
LEADERS = 3
#: Parts in which a bucket of signatures is sorted, one after the other.
SORT_BITS = 4


class Cut:
    """Size classes and their numbers of fragments for a least similarity of ``percent`` / 100.

    Similar sets of sizes s <= t have s * 100 >= t * percent and differ in at
    most (s + t) * (100 - percent) / (100 + percent) n-grams.
    """

    def __init__(self, percent: int = PERCENT):
        if not 50 <= percent <= 100:
            raise ValueError("percent has to be from 50 to 100")
        self.percent = percent
        # below the first bound similar sets differ in one n-gram at most; sets below `single` in none
        small = 1
        while self.most_apart(small + 1, small + 1) <= 1 and small < 64:
            small += 1
        bounds = [small]
        while bounds[-1] < 1 << 31:
            bounds.append(max(bounds[-1] + 1, int(bounds[-1] * CLASS_RATIO)))
        #: Largest size of each class; class 0 is compared by leaving out one n-gram.
        self.bounds = np.array(bounds, np.int64)
        apart = (2 * self.bounds * (100 - percent)) // (100 + percent)
        common = np.maximum(-(-(np.r_[0, self.bounds[:-1]] + 1) * percent // 100), 1)
        #: More fragments than differences, and so many that all common n-grams share the few touched ones at odds below MISSED.
        self.fragments = np.maximum((apart * 11) // 10 + 6, np.ceil(apart * MISSED ** (-1 / common)).astype(np.int64))

    def most_apart(self, s: int, t: int) -> int:
        return ((s + t) * (100 - self.percent)) // (100 + self.percent)

    def classes(self, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last class in which a set of each size has partners at least as large."""
        largest = (sizes * 100) // self.percent
        return np.searchsorted(self.bounds, sizes), np.searchsorted(self.bounds, largest)


def node_ids(row: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """One 64-bit id per set: equal sets have equal ids."""
    total = np.zeros(n, np.uint64)
    np.add.at(total, row, mix(value ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
    return mix(total).view(np.int64)


def signatures(value: np.ndarray, starts: np.ndarray, cut: Cut) -> tuple[np.ndarray, np.ndarray]:
    """``(set number, signature)``: fragments of each set under the classes of its partners."""
    sizes = np.diff(starts)
    first, last = cut.classes(sizes)
    spread = mix(value)
    out_set, out = [], []
    totals = np.zeros(len(sizes), np.uint64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    np.add.at(totals, owner, spread)
    small = np.flatnonzero((first == 0) & (sizes > 0))
    if len(small):
        out_set.append(small)
        out.append(mix(totals[small]))
        take = (first == 0)[owner]
        out_set.append(owner[take])
        out.append(mix(totals[owner[take]] - spread[take]))
    for ahead in range(int((last - first).max(initial=0)) + 1):
        kind = first + ahead
        take = ((kind > 0) & (kind <= last))[owner]
        if not take.any():
            continue
        own, v, s = owner[take], value[take], spread[take]
        # the global order cut into equal ranges; sets are sorted, so a fragment is a run
        place = ((v >> np.uint64(32)) * cut.fragments[kind][own].astype(np.uint64)) >> np.uint64(32)
        begin = np.ones(len(v), bool)
        begin[1:] = (own[1:] != own[:-1]) | (place[1:] != place[:-1])
        begin = np.flatnonzero(begin)
        sums = np.add.reduceat(s, begin)
        tag = kind[own[begin]].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + place[begin]
        out_set.append(own[begin])
        out.append(mix(sums ^ mix(tag)))
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(out_set), np.concatenate(out)


def set_starts(row: np.ndarray, n: int) -> np.ndarray:
    return np.searchsorted(row, np.arange(n + 1))


def profiles(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, node, n, sketch`` of every row of ``docs`` (doc_id, text)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, raw, at in slices(batches):
            row, value = shingle_sets(raw, at, width)
            n = np.bincount(row, minlength=len(ids)).astype(np.int64)
            bits = np.left_shift(1, np.ceil(np.log2(np.maximum(n, SKETCH_BITS))).astype(np.int64))
            start = np.r_[0, np.cumsum(bits)]
            place = start[row] + (value & (bits[row] - 1).astype(np.uint64)).astype(np.int64)
            odd = np.bincount(place, minlength=start[-1]) & 1
            sketch = np.packbits(odd.astype(np.uint8)).view(np.int64)
            flat = pa.ListArray.from_arrays(pa.array((start // 64).astype(np.int32)), pa.array(sketch))
            yield pa.RecordBatch.from_arrays([ids_column(ids), pa.array(node_ids(row, value, len(ids))), pa.array(n), flat], names=["doc_id", "node", "n", "sketch"])

    return docs.mapInArrow(work, "doc_id long, node long, n long, sketch array<long>")


def unpacked(table: pa.Table, name: str, kind) -> list[np.ndarray]:
    """The packed arrays of a column as one array per chunk, without a copy."""
    return [buffers(chunk)[0].view(kind) for chunk in table.column(name).chunks]


def tied_in_bucket(table: pa.Table, buckets: int) -> pa.Table:
    """``sig, a, b`` of a bucket's rows (bucket, sigs, nodes, more): nodes that share a signature, tied to the smallest of them.

    A bucket from ``buckets`` on holds ties already.  Besides the table itself
    and the result, only a part of the signatures is held at a time.
    """
    if table.column("bucket")[0].as_py() >= buckets:
        found = [list(c) for c in zip(*(unpacked(table, name, kind) for name, kind in (("sigs", np.uint64), ("nodes", np.int64), ("more", np.int64))), strict=True)]
    else:
        packs = []
        for sig, node, more in zip(unpacked(table, "sigs", np.uint64), unpacked(table, "nodes", np.int64), unpacked(table, "more", np.uint32), strict=True):
            # the highest byte of a signature tells its part
            packs.append((sig, node, np.repeat(np.arange(len(node), dtype=np.uint32), more), sig.view(np.uint8)[7::8] >> (8 - SORT_BITS)))
        found = []
        for part in range(1 << SORT_BITS):
            at = [np.flatnonzero(parts == part) for *_, parts in packs]
            sig = np.concatenate([s[i] for (s, *_), i in zip(packs, at, strict=True)])
            node = np.concatenate([v[own[i]] for (_, v, own, _), i in zip(packs, at, strict=True)])
            found.append(tied_nodes(sig, node))
    sig, a, b = (np.concatenate(c) if len(c) > 1 else c[0] for c in zip(*found, strict=True))
    by = np.lexsort((b, a))
    return pa.table({"sig": pa.array(sig.view(np.int64)[by]), "a": pa.array(a[by]), "b": pa.array(b[by])})


def tied_nodes(sig: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(signature, smallest node, other node)`` of the signatures that several nodes have."""
    by = np.argsort(sig, kind="stable")
    sig, node = sig[by], node[by]
    again = np.zeros(len(sig), bool)
    again[1:] = sig[1:] == sig[:-1]
    shared = again.copy()
    shared[:-1] |= again[1:]
    sig, node = sig[shared], node[shared]
    by = np.lexsort((node, sig))
    sig, node = sig[by], node[by]
    lead = np.ones(len(sig), bool)
    lead[1:] = sig[1:] != sig[:-1]
    head = node[lead][np.cumsum(lead) - 1] if len(sig) else node
    new = np.ones(len(sig), bool)
    new[1:] = lead[1:] | (node[1:] != node[:-1])
    tied = new & (node != head)
    return sig[tied], head[tied], node[tied]


def stars(docs: DataFrame, width: int, cut: Cut, buckets: int) -> DataFrame:
    """``sig, a, b``: sets that share a signature, each tied to the smallest node that has it.

    A task drops equal sets and keeps one node per signature of its slice, so
    a signature that many documents share arrives a few times per slice of
    text.  Signatures travel as packed arrays, grouped by bucket; the number
    of buckets follows the text, so each stays small.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = 0
        for ids, raw, at in slices(batches):
            row, value = shingle_sets(raw, at, width)
            starts = set_starts(row, len(ids))
            nodes = node_ids(row, value, len(ids))
            keep = np.zeros(len(ids), bool)
            keep[np.unique(nodes, return_index=True)[1]] = True
            inside = np.repeat(keep, np.diff(starts))
            nodes, value, sizes = nodes[keep], value[inside], np.diff(starts)[keep]
            order = np.argsort(nodes, kind="stable")
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            own, sig = signatures(value, np.concatenate([[0], np.cumsum(sizes)]), cut)
            if not len(sig):
                continue
            # one row per signature: its smallest node; the others hang on that one
            by = np.lexsort((rank[own], sig))
            own, sig = own[by], sig[by]
            lead = np.ones(len(sig), bool)
            lead[1:] = sig[1:] != sig[:-1]
            head = np.flatnonzero(lead)[np.cumsum(lead) - 1]
            tied = ~lead & (own != own[head])
            out = []
            if tied.any():
                out.append((buckets + (turn % buckets), sig[tied].tobytes(), nodes[own[head[tied]]].tobytes(), nodes[own[tied]].tobytes()))
            turn += 1
            own, sig = own[lead], sig[lead]
            bucket = (sig % np.uint64(buckets)).astype(np.int64)
            by = np.lexsort((own, bucket))
            own, sig, bucket = own[by], sig[by], bucket[by]
            edges = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True])
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                runs = np.flatnonzero(np.r_[True, own[a + 1 : b] != own[a : b - 1]])
                out.append((int(bucket[a]), sig[a:b].tobytes(), nodes[own[a:b][runs]].tobytes(), np.diff(np.r_[runs, b - a]).astype(np.uint32).tobytes()))
            columns = list(zip(*out, strict=True))
            kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["bucket", "sigs", "nodes", "more"])

    def meet(table: pa.Table) -> pa.Table:
        return tied_in_bucket(table, buckets)

    packed = docs.mapInArrow(send, "bucket long, sigs binary, nodes binary, more binary")
    return packed.groupBy("bucket").applyInArrow(meet, "sig long, a long, b long")


def sizes_fit(cut: Cut) -> Column:
    """False for pairs (na, nb) whose sizes alone rule them out."""
    return F.least("na", "nb") * 100 >= F.greatest("na", "nb") * cut.percent


def close_enough(cut: Cut) -> Column:
    """False for pairs (na, nb, sa, sb) whose sizes or sketches rule them out.

    A bit of a sketch is the parity of the n-grams that fall on it, so the bits
    in which two sketches differ count no more than the n-grams that do.  Sets of
    similar size have sketches of one length, or one is twice as long and folds
    to the other's: parities of its two halves add up.
    """
    width = F.least(F.size("sa"), F.size("sb"))

    def folded(sketch: str) -> Column:
        halves = F.zip_with(F.slice(sketch, F.lit(1), width), F.slice(sketch, width + 1, width), lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(sketch) > width, halves).otherwise(F.col(sketch))

    apart = F.aggregate(F.zip_with(folded("sa"), folded("sb"), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, c: s + c)
    return sizes_fit(cut) & (apart * (100 + cut.percent) <= (F.col("na") + F.col("nb")) * (100 - cut.percent))


def segments(docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """``node, part, grams`` of the sets in ``nodes`` (doc_id, node): what each holds of each part of the order."""
    parts = 1 << COUNT_BITS

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, raw, at in slices(batches):
            row, value = shingle_sets(raw, at, width)
            node = node_ids(row, value, len(ids))
            key = row * parts + (value >> np.uint64(64 - COUNT_BITS)).astype(np.int64)
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)
            grams = pa.ListArray.from_arrays(pa.array(np.r_[first, len(key)].astype(np.int32)), pa.array(value.view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(node[row[first]]), pa.array((key[first] % parts).astype(np.int32)), grams], names=["node", "part", "grams"])

    wanted = nodes.select("doc_id").distinct()
    texts = docs.join(few(wanted), "doc_id", "left_semi")
    # rows that share an id may bring a set twice
    return texts.mapInArrow(work, "node long, part int, grams array<long>").dropDuplicates(["node", "part"])


def overlapping(pairs: DataFrame, parts: DataFrame, cut: Cut) -> DataFrame:
    """The pairs (a, b, na, nb, and more columns) that are similar: overlaps are counted per part and summed."""
    more = [c for c in pairs.columns if c not in ("na", "nb")]
    spread = pairs.select("*", F.explode(F.sequence(F.lit(0), F.lit((1 << COUNT_BITS) - 1))).alias("part"))

    def side(end: str, grams: str) -> DataFrame:
        own = few(pairs.select(F.col(end).alias("node")).distinct())
        return parts.join(own, "node", "left_semi").select(F.col("node").alias(end), "part", F.col("grams").alias(grams))

    partial = spread.join(side("a", "ga"), ["a", "part"]).join(side("b", "gb"), ["b", "part"])
    total = partial.select(*pairs.columns, F.size(F.array_intersect("ga", "gb")).alias("common")).groupBy(*pairs.columns).agg(F.sum("common").alias("common"))
    return total.filter(F.col("common") * 100 >= (F.col("na") + F.col("nb") - F.col("common")) * cut.percent).select(*more)


def possible(pairs: DataFrame, nodes: DataFrame, cut: Cut) -> DataFrame:
    """The pairs (a, b, na, nb, and more columns) that sketches leave."""
    left = nodes.select(F.col("node").alias("a"), F.col("sketch").alias("sa"))
    right = nodes.select(F.col("node").alias("b"), F.col("sketch").alias("sb"))
    return pairs.join(left, "a").join(right, "b").filter(close_enough(cut)).select(pairs.columns)


def still_open(member: DataFrame) -> DataFrame:
    """Rows of the signatures whose members are not all in one component."""
    apart = member.groupBy("sig").agg((F.min("component") != F.max("component")).alias("apart")).filter("apart").select("sig")
    return member.join(few(materialize(apart, "apart")), "sig", "left_semi")


def moved(rows: DataFrame, merged: DataFrame) -> DataFrame:
    """``rows`` with the components that ``merged`` (node, component) gives their components."""
    to = merged.select(F.col("node").alias("component"), F.col("component").alias("_to"))
    return rows.join(few(to), "component", "left").withColumn("component", F.coalesce("_to", "component")).drop("_to")


def rare_grams(member: DataFrame, parts: DataFrame, cut: Cut) -> DataFrame:
    """``gram, node, component, n, place, home``: the rarest n-grams of each set in ``member`` (node, component, n).

    The n-grams of a set are put in order by the number of sets in ``member``
    that hold them.  A similar set has the set's first common n-gram so early in
    this order that the ones behind it can still make up the overlap; later
    n-grams, and those that no other set holds, give no row.  ``place`` counts from 0;
    ``home`` is a component that holds most of the sets of an n-gram, and
    n-grams of one component alone are left out.
    """
    own = materialize(member.select("node", "component", "n").distinct(), "own")
    grams = parts.join(few(own.select("node")), "node", "left_semi").select("node", F.explode("grams").alias("gram"))
    held = materialize(grams.groupBy("gram").agg(F.count("*").alias("held")).filter("held > 1"), "held")
    order = grams.join(few(held), "gram").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("held", "gram"))).alias("order")).join(few(own), "node")
    # those that no other set holds come first
    order = order.withColumn("alone", F.col("n") - F.size("order"))
    reach = F.col("n") - F.ceil(F.col("n") * cut.percent / 100) + 1 - F.col("alone")
    first = order.select("node", "component", "n", "alone", F.posexplode(F.slice("order", F.lit(1), F.greatest(reach, F.lit(0)).cast("int"))))
    rare = materialize(first.select(F.col("col.gram").alias("gram"), "node", "component", "n", (F.col("alone") + F.col("pos")).alias("place")), "rare")
    sides = rare.groupBy("gram", "component").agg(F.count("*").alias("sets")).groupBy("gram")
    sides = sides.agg(F.max_by("component", F.struct("sets", "component")).alias("home"), F.count("*").alias("components"))
    return rare.join(few(materialize(sides.filter("components > 1").select("gram", "home"), "homes")), "gram")


def across(rare: DataFrame, nodes: DataFrame, cut: Cut) -> DataFrame:
    """``x, y`` (node, component, n): pairs of different components that share one of their rare n-grams and may be similar.

    Sizes, places and sketches, folded to ``SKETCH_BITS``, rule out the others
    as pairs are formed; ``nodes`` has the sketches.
    """
    fold = F.expr(f"transform(sequence(0, {SKETCH_BITS // 64 - 1}), i -> aggregate(filter(sketch, (v, j) -> j % {SKETCH_BITS // 64} = i), 0L, (a, v) -> a ^ v))")
    rare = materialize(rare.join(nodes.select("node", fold.alias("fold")), "node"), "across")
    side = F.struct("node", "component", "n", "place", "home", "fold")
    # sets at home meet only those of other components
    away = rare.filter("component <> home").select("gram", side.alias("x"))
    pairs = away.join(rare.select("gram", side.alias("y")), "gram").filter("x.component <> y.component AND (y.component = y.home OR x.node < y.node)")
    pairs = pairs.filter(F.least(F.expr("x.n - x.place"), F.expr("y.n - y.place")) * (100 + cut.percent) >= F.expr("x.n + y.n") * cut.percent)
    apart = F.expr("aggregate(zip_with(x.fold, y.fold, (p, q) -> bit_count(p ^ q)), 0, (s, c) -> s + c)")
    return pairs.filter(apart * (100 + cut.percent) <= F.expr("x.n + y.n") * (100 - cut.percent))


def similar_groups(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row.

    Words are runs of ``[^\\x20\\x09-\\x0D]`` with A-Z as a-z; a row's set holds
    its runs of ``width`` words, or all its words as one if there are fewer.
    Rows link when their sets have a Jaccard similarity of ``percent`` / 100 or
    more, and ``component_id`` is the smallest id reachable by links.

    Every component is found from verified links: sets that share a signature
    are first compared with one of them, then those in other components with
    another one, a few times; where members of a signature that have not met all
    others still lie in different components, those are compared that share one of their rarest
    n-grams, as similar sets have to.  A link could
    be missed only if n-grams hash so unevenly that no more fragments are filled
    than n-grams differ; there are so many fragments that the chance is below
    ``MISSED`` for a pair of sets of any size.

    Null and wordless texts have no n-gram and no link; equal sets are one
    node; rows that repeat an id get the component of their own set; null ids
    never name a component; other columns are ignored; an empty table gives no
    rows.
    """
    with scratch(docs.sparkSession) as keep:
        return keep(_similar_groups(text_rows(docs, id_col, text_col), width, Cut(percent)), "groups")


def _similar_groups(texts: DataFrame, width: int, cut: Cut) -> DataFrame:
    profile = materialize(profiles(texts, width), "profiles")
    nodes = materialize(
        profile.filter("n > 0 AND doc_id IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("sketch").alias("sketch")), "nodes"
    )
    found = materialize(stars(texts, width, cut, buckets_for(texts)), "stars")
    sizes = nodes.select("node", "n")
    pairs = found.select("a", "b").distinct().join(sizes.toDF("a", "na"), "a").join(sizes.toDF("b", "nb"), "b")
    pairs = materialize(possible(pairs.filter(sizes_fit(cut)), nodes, cut), "pairs")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    parts = materialize(segments(texts, nodes.join(ends, "node", "left_semi"), width), "segments")
    tied = components(overlapping(pairs, parts, cut), "tied")

    # signatures of three sets or more: their members may link without linking the one they were compared with
    several = found.groupBy("sig").agg(F.count("*").alias("n")).filter("n > 1").select("sig")
    member = found.join(several, "sig", "left_semi").select("sig", F.explode(F.array("a", "b")).alias("node")).distinct()
    member = member.join(tied, "node", "left").withColumn("component", F.coalesce("component", "node"))
    member = materialize(still_open(materialize(member, "members")), "open")
    if not member.isEmpty():
        member = materialize(member.join(nodes.select("node", "n"), "node"), "sized")
    end = F.struct("node", "component", "n")
    sides = [F.col(f"{side}.{c}").alias(f"{n}{name}") for side, name in (("x", "a"), ("y", "b")) for c, n in (("component", "c"), ("n", "n"))]

    def taken_apart(ends: DataFrame, label: str) -> DataFrame:
        """``parts`` with those of the sets in ``ends`` (node)."""
        new = materialize(ends.distinct().join(parts.select("node").distinct(), "node", "left_anti"), f"ends-{label}")
        if new.isEmpty():
            return parts
        # a row with the id of a set may hold another one, which may be there already
        found = segments(texts, nodes.join(few(new), "node", "left_semi"), width).join(few(new), "node", "left_semi")
        return parts.union(materialize(found, f"segments-{label}"))

    for turn in range(LEADERS + 1):
        if member.isEmpty():
            break
        if turn < LEADERS:
            # all members of other components against one member, another one each time
            lead = materialize(member.groupBy("sig").agg(F.min_by(end, F.xxhash64("node", F.lit(turn))).alias("y")), f"lead{turn}")
            met = member.join(few(lead), "sig")
            ahead = met.select(end.alias("x"), "y").filter("x.component <> y.component")
            # that one has met all others of its signature; they are left to meet each other
            member = met.filter("node <> y.node").select(member.columns)
        else:
            # what is left: sets of different components are compared if they share an n-gram that is rare among these sets
            parts = taken_apart(member.select("node"), "rare")
            ahead = across(rare_grams(member, parts, cut), nodes, cut)
        ahead = ahead.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"), *sides)
        ahead = materialize(possible(ahead.filter(sizes_fit(cut)).distinct(), nodes, cut), f"ahead{turn}")
        # only what has come through the sketches is taken apart
        parts = taken_apart(ahead.select(F.explode(F.array("a", "b")).alias("node")), str(turn))
        similar = overlapping(ahead, parts, cut)
        # the components known so far are the nodes of what is still to be tied together
        merged = components(similar.select(F.col("ca").alias("a"), F.col("cb").alias("b")), f"tied{turn}")
        if not merged.isEmpty():
            alone = merged.join(tied.select("node"), "node", "left_anti")
            tied = materialize(moved(tied, merged).select("node", "component").union(alone), f"named{turn}")
            member = moved(member, merged)
        if turn < LEADERS:
            member = materialize(still_open(member), f"open{turn}")

    named = nodes.join(tied, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = named.join(least, "component").select("node", "component_id")
    out = profile.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("node")).alias("node")).join(named, "node", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def keep_first(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of similar texts, with its columns: the one whose id names the group.

    Rows without words stay, and so do rows whose id is null.
    """
    with scratch(docs.sparkSession) as keep:
        found = similar_groups(docs, width, percent, id_col, text_col)
        key = fresh(docs.columns, "group_id")[0]
        gone = keep(found.filter("component_id <> doc_id").select(F.col("doc_id").alias(key)).distinct(), "gone")
    return docs.join(few(gone), col(id_col).cast("long") == F.col(key), "left_anti")
