"""Operator 1: near-duplicate classes by DartMinHash signatures and banded joining.

A text is the weighted set of its shingles (five lower-cased words; the weight is how often each occurs). Darts fall on
the plane of an element's weight and rank as a unit-rate Poisson process that depends on the element alone: the gaps
between the ranks of an element's darts, their weights' places and their coordinates all come from hashes. A text keeps the darts that hit
the region under its weights, up to a rank at which about k ln k + 2 k of them are expected (twice that rank while a coordinate is
still empty), and its signature holds, for each of k coordinates, the dart of lowest rank. Two texts agree in a
coordinate with the probability of their weighted Jaccard similarity.

1. Texts of equal weighted sets are one node.
2. Signatures are cut into ``BANDS`` bands of ``ROWS`` coordinates; nodes that share a band are in a bucket. Nodes of a bucket whose
   signatures agree far enough are candidates.
3. First, the nodes of a bucket are split by a hash into ``HUBS`` parts, each part's most central node (the one whose buckets hold
   most nodes) is a hub, and each node is compared with the ``BEST`` hubs of its buckets that agree most. Verified links (exact
   weighted Jaccard similarity of the full shingle sets) make classes, so most copies are joined at a cost linear in the buckets.
4. Then every candidate pair of two classes is verified, unless other links have joined the two meanwhile. A bucket is cut into
   blocks; blocks meet in cells, but two blocks of the bucket's largest class don't, and a pair is handled in the first bucket that
   it shares. A cell gives at most a link for each class that it joins, never its pairs. The first pass over the cells has signatures
   only and names the nodes that have a candidate; the second has the shingle sets of those.
5. Links are joined to classes by passing on the smallest id, with all state in shared storage.

So no two classes hold a candidate pair of the similarity; hubs only save work. A pair is no candidate if it shares no band or if its
signatures agree in less than ``AGREE``: of two texts of similarity exactly 0.8 that happens with probability 2e-5.

Null and empty texts have no shingles and are one class; a text of one to four words is one shingle; rows of the same id and text
are one document, rows of one id and several texts are judged each by its text, and the smallest id of a class names it. Rows
without an id get the class of the rows with their shingles, and none if no such row has an id; they join no texts to
others. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import copied, dealt, drop_stage, materialize, mix, places_of, ranges, row_of, slices, span_hashes, spans, table, texts, windows

WORDS, THRESHOLD = 5, 0.8
BANDS, ROWS = 30, 5
DARTS = BANDS * ROWS
HUBS, BEST = 2, 3
#: Nodes, and shingles of the nodes, in a block of a bucket.
NODES, SHINGLES = 512, 1 << 18
#: Pairs are verified only if their signatures agree so far at least: 4.3 standard deviations under the threshold.
AGREE = 0.66
_U = 2.0**-53


def unit(h: np.ndarray) -> np.ndarray:
    """Uniform in (0, 1] from 64-bit hashes."""
    return ((h >> np.uint64(11)).astype(np.float64) + 1) * _U


def weighted_sets(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, weight) of each text's different shingles, by text and shingle."""
    text = row_of(bounds)
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(new)
    return text[at], hashes[at], np.diff(np.append(at, len(text)))


def darts(text: np.ndarray, element: np.ndarray, weight: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, dart, rank) of all darts under the weights up to the rank ``reach`` of their text. Weights may be any positive
    numbers: each started unit of weight has darts of its own, and a dart over the weight doesn't count."""
    units = np.ceil(weight).astype(np.int64)
    text, owner = np.repeat(text, units), np.repeat(np.arange(len(units)), units)
    level = np.arange(len(owner)) - np.repeat(np.cumsum(units) - units, units)
    seed = mix(element[owner] + mix(level.astype(np.uint64) + np.uint64(1)))
    room = weight[owner] - level
    rank = np.zeros(len(owner))
    out, i = [], 0
    while len(text):
        i += 1
        h = mix(seed + np.uint64(2 * i * 0x9E3779B97F4A7C15 % 2**64))
        rank = rank - np.log(unit(h))
        go = rank <= reach[text]
        text, seed, room, rank, h = text[go], seed[go], room[go], rank[go], h[go]
        hit = (room >= 1) | (unit(mix(h ^ np.uint64(0x2545F4914F6CDD1D))) <= room)
        out.append((text[hit], mix(h[hit]), rank[hit]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def signatures(text: np.ndarray, element: np.ndarray, weight: np.ndarray, rows: int, k: int = DARTS) -> np.ndarray:
    """Rows by k: the dart of lowest rank in each coordinate; 0 throughout for a text without elements."""
    out = np.zeros((rows, k), np.uint64)
    total = np.bincount(text, weight, rows)
    reach = (k * np.log(k) + 2 * k) / np.maximum(total, 1e-300)
    while len(text):
        t, dart, rank = darts(text, element, weight, reach)
        cell = t * k + (dart % np.uint64(k)).astype(np.int64)
        order = np.lexsort((dart, rank))[::-1]  # the last one written is the first by rank
        flat = np.zeros(rows * k, np.uint64)
        flat[cell[order]] = dart[order]
        flat = flat.reshape(rows, k)
        mine = np.zeros(rows, bool)
        mine[text] = True
        full = mine & (flat != 0).all(1)
        out[full] = flat[full]
        left = ~full[text]
        text, element, weight = text[left], element[left], weight[left]
        reach = reach * 2
    return out


def shingle_sets(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, end row, text, shingle, weight) of runs of texts."""
    for i, j, _, _ in slices(column, 1 << 19):
        for _, _, data, at in slices(pc.utf8_lower(column.slice(i, j - i)), 1 << 40):
            starts, ends, bounds = spans(data, at)
            yield i, j, *weighted_sets(*windows(span_hashes(data, starts, ends), bounds, WORDS))


def content_keys(text: np.ndarray, element: np.ndarray, weight: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that name a weighted set: two sums of different hashes of its elements with their weights."""
    out = []
    for salt in (0x1B873593CC9E2D51, 0x38B34AE5A1E38B93):
        total = np.zeros(rows, np.uint64)
        np.add.at(total, text, mix(element * np.uint64(salt) + weight.astype(np.uint64)))
        out.append(total.view(np.int64))
    return out[0], out[1]


def signed(docs: DataFrame) -> DataFrame:
    """doc_id, t (hash of the text), c1, c2 (the content), size (shingles), bands (64-bit each) and sketch (a byte of each
    coordinate); the last two are null for no shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, text, element, weight in shingle_sets(b["text"]):
                n = j - i
                sig = signatures(text, element, weight, n)
                band = np.zeros((n, BANDS), np.uint64)
                for r in range(ROWS):
                    band = mix(band * np.uint64(0xD6E8FEB86659FD93) + sig[:, r::ROWS])
                band = mix(band + np.arange(1, BANDS + 1, dtype=np.uint64))
                size = np.bincount(text, minlength=n)
                c1, c2 = content_keys(text, element, weight, n)
                full = (size > 0).tolist()
                columns = [pa.array([x.tobytes() if f else None for x, f in zip(rows, full, strict=True)], pa.binary()) for rows in (band, (sig >> np.uint64(20)).astype(np.uint8))]
                yield pa.RecordBatch.from_arrays([b["doc_id"].slice(i, n), b["t"].slice(i, n), pa.array(c1), pa.array(c2), pa.array(size.astype(np.int64)), *columns], ["doc_id", "t", "c1", "c2", "size", "bands", "sketch"])

    return docs.select("doc_id", F.xxhash64("text").alias("t"), "text").mapInArrow(run, "doc_id long, t long, c1 long, c2 long, size long, bands binary, sketch binary")


def matrix(column: pa.Array | pa.ChunkedArray, kind: type) -> np.ndarray:
    """Rows of equally long binary values."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def banded(nodes: DataFrame) -> DataFrame:
    """band, node of every band of ``nodes`` (node, bands)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bands = np.frombuffer(b"".join(b["bands"].to_pylist()), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(bands), b["node"].take(pa.array(np.repeat(np.arange(len(b)), BANDS), pa.int64()))], ["band", "node"])

    return nodes.select("node", "bands").mapInArrow(run, "band long, node long")


def shares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The share of equal bytes of the sketches in each row, freed of chance."""
    return ((x == y).mean(1) - 1 / 256) / (1 - 1 / 256)


def agreement(pairs: DataFrame) -> DataFrame:
    """a, b, agree of ``pairs`` (a, b, and their sketches sa and sb) that agree far enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                share = shares(matrix(b["sa"], np.uint8), matrix(b["sb"], np.uint8))
                yield pa.RecordBatch.from_arrays([b["a"], b["b"], pa.array(share)], ["a", "b", "agree"]).filter(pa.array(share >= AGREE))

    return pairs.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long, agree double")


def sets_of(docs: DataFrame) -> DataFrame:
    """c1, c2, shingles (binary, 64-bit) and weights (binary, 32-bit) of ``docs`` (text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, text, element, weight in shingle_sets(b["text"]):
                bounds = np.searchsorted(text, np.arange(j - i + 1))
                raw, heavy, cut = element.tobytes(), weight.astype(np.uint32).tobytes(), bounds.tolist()
                ends = list(zip(cut[:-1], cut[1:], strict=True))
                columns = [pa.array([raw[8 * s : 8 * e] for s, e in ends], pa.binary()), pa.array([heavy[4 * s : 4 * e] for s, e in ends], pa.binary())]
                yield pa.RecordBatch.from_arrays([*map(pa.array, content_keys(text, element, weight, j - i)), *columns], ["c1", "c2", "shingles", "weights"])

    return docs.select("text").mapInArrow(run, "c1 long, c2 long, shingles binary, weights binary")


def as_set(shingles: bytes, weights: bytes) -> tuple[np.ndarray, np.ndarray, int]:
    """Sorted shingles, their weights, and the weights together."""
    w = np.frombuffer(weights, np.uint32)
    return np.frombuffer(shingles, np.uint64), w, int(w.sum(dtype=np.int64))


def similarity(a: tuple[np.ndarray, np.ndarray, int], b: tuple[np.ndarray, np.ndarray, int], least: float = 0) -> float:
    """Weighted Jaccard similarity of two sets; 0 if the weights alone show that it is under ``least``."""
    if len(a[0]) > len(b[0]):
        a, b = b, a
    if min(a[2], b[2]) < least * max(a[2], b[2]) or not len(a[0]):
        return 0.0
    at = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    has = b[0][at] == a[0]
    both = int(np.minimum(a[1][has], b[1][at[has]]).sum(dtype=np.int64))
    return both / (a[2] + b[2] - both)


def verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The ``pairs`` (a, b) whose sets are at least ``threshold`` alike. A task reads the set of each b once and then those of
    its a one by one; a b of many pairs is dealt to several places."""
    places = places_of(pairs, ["b"])
    asks = dealt(pairs.select("a", "b"), places, ["b"], "a").join(sets.withColumnRenamed("node", "a").hint("merge"), "a")
    own = copied(pairs.select("b").distinct(), places, ["b"]).join(sets.withColumnRenamed("node", "b").hint("merge"), "b")
    rows = asks.select("b", "place", "a", "shingles", "weights").union(own.select("b", "place", F.lit(None).cast("long").alias("a"), "shingles", "weights"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = ((), (), 0)
        for batch in batches:
            found = []
            for k, (a, shingles, weights) in enumerate(zip(batch["a"].to_pylist(), batch["shingles"], batch["weights"], strict=True)):
                one = as_set(shingles.as_py(), weights.as_py())
                if a is None:
                    own = one
                elif similarity(one, own, threshold) >= threshold:
                    found.append(k)
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], ["a", "b"]).take(pa.array(found, pa.int64()))

    return rows.repartition("b", "place").sortWithinPartitions("b", "place", F.col("a").asc_nulls_first()).mapInArrow(run, "a long, b long")


def cells(rows: DataFrame, weight: Column, most: int) -> DataFrame:
    """``rows`` (band, node, class and more) of buckets of two classes or more, once for each cell: with band, one and two (the
    blocks that meet) and side (0 or 1; 2 where a block meets itself). Blocks hold about ``most`` of ``weight``; those of
    the largest class of a bucket come first and meet no other of that class."""
    held = rows.groupBy("band", "class").agg(F.count("*").alias("n"), F.sum(weight).alias("w"))
    stats = held.groupBy("band").agg(F.max(F.struct("n", "class", "w")).alias("top"), F.sum("w").alias("w"), F.count("*").alias("classes")).where("classes > 1")
    first, others = F.ceil(F.col("top.w") / most), F.ceil((F.col("w") - F.col("top.w")) / most)
    stats = materialize(stats.select("band", F.col("top.class").alias("large"), first.cast("int").alias("first"), others.cast("int").alias("others")), "stats")
    mine = F.col("class") == F.col("large")
    own = F.when(mine, F.pmod(F.xxhash64("node", "band"), "first")).otherwise(F.col("first") + F.pmod(F.xxhash64("node", "band"), "others")).cast("int")
    meets = F.sequence(F.when(mine, F.col("first")).otherwise(F.lit(0)), F.col("first") + F.col("others") - 1)
    out = rows.join(stats.hint("merge"), "band").withColumn("own", own).withColumn("other", F.explode(meets))
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    out = out.withColumn("one", F.least("own", "other")).withColumn("two", F.greatest("own", "other")).withColumn("side", side)
    return out.drop("own", "other", "large", "first", "others")


def cell_pairs(cell: np.ndarray, side: np.ndarray, most: int = 1 << 16) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places (at most about ``most`` at once) of rows that are sorted by cell and side: each row of side 0 with each
    of side 1 of its cell, or with each later one in a cell of one block, whose rows have side 2."""
    edge = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
    size = np.diff(np.append(edge, len(cell)))
    end = np.repeat(edge + size, size)
    middle = np.repeat(edge + np.add.reduceat((side == 0).astype(np.int64), edge), size)
    place = np.arange(len(cell))
    first = np.where(side == 2, place + 1, middle)
    count = np.where(side == 1, 0, end - first)
    upto = np.cumsum(count)
    i = 0
    while i < len(cell):
        j = max(i + 1, int(np.searchsorted(upto, (upto[i - 1] if i else 0) + most, "right")))
        yield np.repeat(place[i:j], count[i:j]), ranges(first[i:j], count[i:j])
        i = j


def candidate_pairs(t: pa.Table, cell: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(place, place, agreement) of pairs of two classes in a cell that agree far enough, in the first band that they share."""
    of, band = t["class"].to_numpy(), t["band"].to_numpy()
    sketch, bands = matrix(t["sketch"], np.uint8), matrix(t["bands"], np.int64)
    for x, y in cell_pairs(cell, t["side"].to_numpy()):
        apart = of[x] != of[y]
        x, y = x[apart], y[apart]
        share = shares(sketch[x], sketch[y])
        near = share >= AGREE
        x, y, share = x[near], y[near], share[near]
        here = bands[x, (bands[x] == bands[y]).argmax(1)] == band[x]
        yield x[here], y[here], share[here]


def by_cell(dealt_rows: DataFrame, handle: Callable[[pa.Table, np.ndarray], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """What ``handle`` gives for whole cells of cells(); it gets a few of them at once, with a number for each row's cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = None
        for b in batches:
            if not len(b):
                continue
            t = pa.Table.from_batches([b])
            t = t if left is None else pa.concat_tables([left, t])
            keys = [t[c].to_numpy() for c in ("band", "one", "two")]
            new = np.append(True, np.logical_or.reduce([k[1:] != k[:-1] for k in keys]))
            last, cell = int(np.flatnonzero(new)[-1]), np.cumsum(new)
            if last:
                yield from handle(t.slice(0, last), cell[:last])
            left = t.slice(last)
        if left is not None:
            yield from handle(left, np.zeros(len(left), np.int64))

    return dealt_rows.repartition("band", "one", "two").sortWithinPartitions("band", "one", "two", "side").mapInArrow(run, schema)


def live(t: pa.Table, cell: np.ndarray) -> Iterator[pa.RecordBatch]:
    """band, node of the rows that have a candidate in their cell."""
    has = np.zeros(len(t), bool)
    for x, y, _ in candidate_pairs(t, cell):
        has[x] = has[y] = True
    yield from t.select(["band", "node"]).filter(pa.array(has)).to_batches()


def class_links(threshold: float) -> Callable[[pa.Table, np.ndarray], Iterator[pa.RecordBatch]]:
    def run(t: pa.Table, cell: np.ndarray) -> Iterator[pa.RecordBatch]:
        """a, b: pairs of classes that a verified pair joins; at most one fewer than there are classes."""
        of = t["class"].to_numpy()
        over: dict[int, int] = {}

        def find(c: int) -> int:
            while (up := over.get(c, c)) != c:
                over[c] = over.get(up, up)
                c = up
            return c

        sets: dict[int, tuple] = {}
        shingles, weights = t["shingles"], t["weights"]

        def set_at(k: int) -> tuple:
            if k not in sets:
                sets[k] = as_set(shingles[k].as_py(), weights[k].as_py())
            return sets[k]

        out = []
        for x, y, share in candidate_pairs(t, cell):
            order = np.argsort(-share, kind="stable")
            for i, j in zip(x[order].tolist(), y[order].tolist(), strict=True):
                a, b = find(int(of[i])), find(int(of[j]))
                if a != b and similarity(set_at(i), set_at(j), threshold) >= threshold:
                    over[max(a, b)] = min(a, b)
                    out.append((a, b))
        yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())], ["a", "b"])

    return run


def components(links: DataFrame) -> DataFrame:
    """node, class: each node of ``links`` (a, b) with the smallest id of its component. Each round, a node takes the
    smallest class of itself and its neighbours, and then that class' own class, until nothing changes."""
    both = materialize(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    state = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("class")), "classes")
    while True:
        near = both.join(state.select(F.col("node").alias("b"), "class").hint("merge"), "b").groupBy(F.col("a").alias("node")).agg(F.min("class").alias("m"))
        step = state.join(near.hint("merge"), "node").select("node", F.least("class", "m").alias("to"), F.col("class").alias("was"))
        step = materialize(step, "step")
        above = step.select(F.col("node").alias("to"), F.col("to").alias("over"))
        new = materialize(step.join(above.hint("merge"), "to").select("node", F.least("to", "over").alias("class"), "was"), "classes")
        moved = new.where("class <> was").limit(1).count()
        drop_stage(state, step)
        state = new
        if not moved:
            drop_stage(both)
            out = state.select("node", "class")
            out._tallyloom_path = state._tallyloom_path
            return out


def judged(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, t (hash of the text), class_id of every row of ``docs`` (doc_id, text)."""
    base = materialize(signed(docs), "signed")
    by_content = base.groupBy("c1", "c2").agg(F.min("doc_id").alias("low"), F.first("size").alias("size"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    # the smallest id names a node; of several contents of one id, all but the first are named by their hash
    same = Window.partitionBy("low").orderBy("c1", "c2")
    name = F.when(F.row_number().over(same) == 1, F.col("low")).otherwise(F.xxhash64("c1", "c2"))
    contents = materialize(by_content.where("low is not null").withColumn("node", name), "contents")
    nodes = contents.where("bands is not null")
    every = materialize(banded(nodes), "bands")
    shared = every.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    members = materialize(every.join(shared.hint("merge"), "band"), "members")
    central = materialize(members.groupBy("node").agg(F.sum("n").alias("degree")), "central")
    about = materialize(nodes.join(central.select("node").hint("merge"), "node", "left_semi").select("node", "low", "c1", "c2", "size", "bands", "sketch"), "about")

    # 3: each node with hubs
    ranked = members.join(central.hint("merge"), "node").select("band", F.struct("degree", "node").alias("place"), F.pmod(F.xxhash64("node"), F.lit(HUBS)).alias("part"))
    hubs = materialize(ranked.groupBy("band", "part").agg(F.max("place").alias("hub")).select("band", F.col("hub.node").alias("b")), "hubs")
    pairs = members.join(hubs.hint("merge"), "band").where("node <> b").select(F.col("node").alias("a"), "b").distinct()
    pairs = materialize(pairs, "pairs")
    places = places_of(pairs, ["b"])
    of_b = copied(pairs.select("b").distinct(), places, ["b"]).join(about.select(F.col("node").alias("b"), F.col("sketch").alias("sb")).hint("merge"), "b")
    of_a = dealt(pairs, places, ["b"], "a").join(about.select(F.col("node").alias("a"), F.col("sketch").alias("sa")).hint("merge"), "a")
    order = Window.partitionBy("a").orderBy(F.desc("agree"), "b")
    best = agreement(of_a.join(of_b.hint("merge"), ["b", "place"])).withColumn("k", F.row_number().over(order)).where(F.col("k") <= BEST)
    chosen = best.groupBy(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).agg(F.max(F.struct("agree", "a", "b")).alias("pair"))
    chosen = materialize(chosen.select("pair.a", "pair.b"), "chosen")

    def sets_in(wanted: DataFrame) -> DataFrame:
        """node, shingles, weights of ``wanted`` (node), from one row of each content."""
        asked = materialize(about.join(wanted.hint("merge"), "node", "left_semi").select("node", "low", "c1", "c2"), "asked")
        rows = docs.join(asked.select(F.col("low").alias("doc_id")).distinct().hint("merge"), "doc_id", "left_semi")
        found = sets_of(rows).join(asked.select("node", "c1", "c2").hint("merge"), ["c1", "c2"]).dropDuplicates(["c1", "c2", "node"])
        found = materialize(found.select("node", "shingles", "weights"), "sets")
        drop_stage(asked)
        return found

    sets = sets_in(chosen.select(F.col("a").alias("node")).union(chosen.select("b")).distinct())
    links = materialize(verified(chosen, sets, threshold), "verified")
    first = components(links)
    drop_stage(every, central, hubs, pairs, places, chosen, sets, links)

    # 4: what is still apart
    of = materialize(about.select("node").join(first.hint("merge"), "node", "left").select("node", F.coalesce("class", "node").alias("class")), "of")
    rows = members.select("band", "node").join(of.hint("merge"), "node")
    signs = about.select("node", "bands", "sketch", "size")
    mixed = rows.join(rows.groupBy("band").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low <> high").select("band").hint("merge"), "band")
    mixed = materialize(mixed.join(signs.hint("merge"), "node"), "mixed")
    open_ = materialize(by_cell(cells(mixed, F.lit(1), NODES), live, "band long, node long").distinct(), "live")
    sets = sets_in(open_.select("node").distinct())
    asked = materialize(mixed.join(open_.hint("merge"), ["band", "node"]).join(sets.hint("merge"), "node"), "open")
    joined = materialize(by_cell(cells(asked, F.col("size"), SHINGLES), class_links(threshold), "a long, b long"), "joined")
    second = components(joined)
    final = of.join(second.select(F.col("node").alias("class"), F.col("class").alias("to")).hint("merge"), "class", "left").select("node", F.coalesce("to", "class").alias("class"))
    final = materialize(final, "final")
    drop_stage(of, members, mixed, open_, sets, asked, joined, first, second)

    names = final.join(about.select("node", "low").hint("merge"), "node").groupBy("class").agg(F.min("low").alias("class_id"))
    named = final.join(names.hint("merge"), "class").select("node", "class_id")
    known = contents.join(named.hint("merge"), "node", "left").select("c1", "c2", F.coalesce("class_id", "low").alias("class_id"))
    known = materialize(known, "known")
    places = places_of(base, ["c1", "c2"])
    rows = dealt(base.select("doc_id", "t", "c1", "c2"), places, ["c1", "c2"], "doc_id")
    out = rows.join(copied(known, places, ["c1", "c2"]).hint("merge"), ["c1", "c2", "place"], "left").select("doc_id", "t", "class_id")
    out = materialize(out, "classes")
    drop_stage(base, contents, about, final, known, places)
    return out


def near_classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id (smallest id of the class) of every row of ``docs`` (doc_id, text)."""
    return judged(docs, threshold).select("doc_id", "class_id")


def keep_first(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each class, with all its columns: of the smallest id, if that has several texts of the class the one
    of the smallest hash, and of repeated rows the first by the hash of all columns. Rows without an id stay."""
    first = judged(texts(docs), threshold).where("doc_id = class_id").groupBy("class_id").agg(F.min("t").alias("t"))
    first = materialize(first.select(F.col("class_id").alias("id"), "t"), "first")
    plain = docs.toDF(*(f"c{k}" for k in range(len(docs.columns))))
    doc_id, text = (plain[f"c{docs.columns.index(c)}"] for c in ("doc_id", "text"))
    keyed = plain.withColumn("id", doc_id.cast("long")).withColumn("t", F.xxhash64(F.coalesce(text, F.lit(""))))
    kept = keyed.where("id is not null").join(first.hint("merge"), ["id", "t"], "left_semi")
    order = Window.partitionBy("id", "t").orderBy(F.xxhash64(*(c for c, kind in plain.dtypes if "map" not in kind)))
    kept = kept.withColumn("k", F.row_number().over(order)).where("k = 1").select(*plain.columns)
    return kept.union(keyed.where("id is null").select(*plain.columns)).toDF(*docs.columns)


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(texts(table(spark, sf_dir, "documents")))
