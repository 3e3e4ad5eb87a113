"""A join of texts by the Jaccard similarity of their word shingles, with adaptive prefixes.

All shingles have one order, common ones last. Two sets with at least ``tau`` shingles in common share
some of their prefixes: what they have in common beyond the prefix that ends first lies in its set's
rest, so they share ``tau`` less that rest. A longer prefix asks for more shared shingles. Each set
picks its own length: a prefix of ``l`` more than the shortest (``LADDER``) reads longer lists of sets with the same
shingle, and leaves fewer candidates, as these must share more; the estimate is the sum of the lists plus the
candidates that they allow times the cost of comparing one. Pairs that share enough are compared exactly.

Only classes are asked for, so not all pairs have to be candidates. First come rounds of stars: in each
list all sets of other classes meet one leader, each set the leader that it meets most often, and what is
verified joins classes; one round is always worth it, as pairs within groups of copies grow with the square of a group. When few pairs of different classes are left in the lists, all of these are counted;
that makes the result exact whatever the rounds have found. Sets with too few shared shingles to link to any other class go before each round.
Equal sets are one from the start. Lists are joined, not gathered, so that a common shingle is no task's work.

Lists are made in one shuffle of packed rows: in each of ``PIECES`` pieces of the hashes, a set stays in a shingle's list only if another
set there has a size that lets the two be similar (exact: whatever two similar sets share stays in both). Shingles that come ``HOT`` times or
so are dealt by set and stay as they are.

The order comes from counts in ``BUCKETS`` buckets of hashes (any order is right). Shingles go by 64-bit hashes, in lists by the first 48 bits
(two that agree in these only add candidates), sets by 128 bits.

Edge cases: null texts and texts without words have no shingles and are linked with nothing; fewer words than
a shingle make one shingle; null ids never become a component's id unless all its ids are null (a text without shingles
has its own id, null or not); repeated rows come back as often as they are; an empty table gives an empty result; ids may
be numbers or strings; other columns, whatever their names, don't matter.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from twinspark.llm.simhash import PARITY, _named, classes_apart, most_apart, parities, parity_ranges, sets_apart, shingle_set, smaller_first, turned, verified
from twinspark.operators.graph import connected_components
from twinspark.shared import settled, table

BITS, CHUNK = 22, 1 << 14
BUCKETS = 1 << BITS  #: of hashes, in which shingles are counted
STEPS = 4  #: levels of commonness for each power of two
LADDER = (1, 2, 4, 8)  #: shingles by which a prefix may exceed the one before the shortest
PIECE_BITS, HOT = 10, 1 << 20
PIECES = 1 << PIECE_BITS  #: of the hashes, in which lists are made one by one
ROW = np.dtype([("token", "<u8"), ("node", "<i8"), ("n", "<i4"), ("pos", "<i4"), ("hot", "u1")])
COMPARE = 0.125  #: cost of comparing a shingle of a candidate, against reading a row of a list
ROUNDS, DENSE = 8, 8  #: most rounds of stars; pairs of sets in lists, for each row, from which on one more is worth it
GAIN = 0.7  #: the share of such pairs that a round may leave if another one is to follow


def _least(similarity: float, n):
    """Shingles that a set of ``n`` has in common at least with a similar one."""
    return F.ceil(similarity * n - 1e-9) if isinstance(n, Column) else int(np.ceil(similarity * n - 1e-9))


def needed(a: Column, a_rest: Column, b: Column, b_rest: Column, similarity: float) -> Column:
    """Prefix shingles that similar sets of a and b shingles share at least, with so many beyond their prefixes."""
    return F.ceil(F.lit(similarity / (1 + similarity)) * (a + b) - 1e-6) - F.greatest(F.least(a_rest, b), F.least(b_rest, a))


def profile(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, a, b, node, other, n, p0, ..., chunk, counts): a row for each document, its set's hashes, size and parities; and for each task, rows of counts of shingles by bucket."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "a", "b", "node", "other", "n", *PARITY, "chunk", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        seen, total, ids = set(), np.zeros(BUCKETS, np.int64), None
        for b in batches:
            ids = b.column(0).type
            node, other, size, new = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64), [np.zeros(0, np.uint64)]
            odd = np.zeros((b.num_rows, len(PARITY)), np.int64)
            for i, text in enumerate(b.column(3)):
                h, node[i] = shingle_set((text.as_py() or "").encode(), k)
                other[i], size[i], odd[i] = xxh64_intdigest(h.tobytes(), 43) - (1 << 63), len(h), parities(h)
                if node[i] not in seen:
                    seen.add(node[i])
                    new.append(h >> np.uint64(64 - BITS))
            total += np.bincount(np.concatenate(new).astype(np.int64), minlength=BUCKETS)
            none = [pa.nulls(b.num_rows, pa.int32()), pa.nulls(b.num_rows, pa.binary())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), *map(pa.array, (node, other, size, *np.ascontiguousarray(odd.T))), *none], names)
        at = np.flatnonzero(total.reshape(-1, CHUNK).any(axis=1))
        if len(at):
            empty = [pa.nulls(len(at), ids), *(pa.nulls(len(at), pa.int64()) for _ in range(5 + len(PARITY)))]
            yield pa.RecordBatch.from_arrays([*empty, pa.array(at.astype(np.int32)), pa.array([np.minimum(total[i * CHUNK : (i + 1) * CHUNK], 65535).astype(np.uint16).tobytes() for i in at], pa.binary())], names)

    out = f"doc_id {kind}, a long, b long, node long, other long, n long, {', '.join(f'{p} long' for p in PARITY)}, chunk int, counts binary"
    return table(docs.select("doc_id", *_named(F.col("text")), "text").mapInArrow(run, out), "profile")


def levels(profiles: DataFrame) -> tuple[np.ndarray, float]:
    """How common the shingles of each bucket are: ``STEPS`` levels for each power of two above the average, 0 for all others; and the level of ``HOT``."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for i, counts in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                own = np.frombuffer(counts, np.uint16).astype(np.int64)
                sums[i] = sums[i] + own if i in sums else own
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array([*sums], pa.int32()), pa.array([np.minimum(x, (1 << 31) - 1).astype(np.int32).tobytes() for x in sums.values()], pa.binary())], ["chunk", "counts"])

    rows = profiles.where("chunk is not null").select("chunk", "counts").repartition("chunk").mapInArrow(add, "chunk int, counts binary")
    total = np.zeros((BUCKETS // CHUNK, CHUNK), np.int64)
    for r in rows.collect():  # at most BUCKETS numbers
        total[r.chunk] = np.frombuffer(r.counts, np.int32)
    average = max(1.0, total.mean())
    return np.maximum(0, STEPS * np.log2(np.maximum(total.ravel(), 1) / average)).astype(np.uint8), STEPS * math.log2(HOT / average)


def _packed(rows: np.ndarray) -> bytes:
    """Byte by byte of all rows: what they have in common compresses."""
    return rows.view(np.uint8).reshape(len(rows), -1).T.tobytes()


def _unpacked(packed: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(packed, np.uint8).reshape(ROW.itemsize, -1).T).view(ROW).ravel()


def prefixes(docs: DataFrame, k: int, similarity: float, level: np.ndarray, hot: float) -> DataFrame:
    """(piece, rows): the longest prefix of each set, a set once a task; for each piece and batch of a task, its rows packed."""
    spark = docs.sparkSession
    order = spark.sparkContext.broadcast(level)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for b in batches:
            keys, common, nodes, sizes = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint8)], [], []
            for text in b.column(0):
                h, node = shingle_set((text.as_py() or "").encode(), k)
                if node not in seen and len(h):
                    seen.add(node)
                    own = order.value[(h >> np.uint64(64 - BITS)).astype(np.int64)]
                    first = np.argsort(own, kind="stable")[: len(h) - _least(similarity, len(h)) + LADDER[-1]]
                    keys.append(h[first])
                    common.append(own[first])
                    nodes.append(node)
                    sizes.append(len(h))
            each = [len(x) for x in keys[1:]]
            rows = np.zeros(sum(each), ROW)
            rows["token"] = np.concatenate(keys) & np.uint64(~0xFFFF & (1 << 64) - 1)
            rows["node"], rows["n"] = np.repeat(np.array(nodes, np.int64), each), np.repeat(np.array(sizes, np.int64), each)
            rows["pos"] = np.concatenate([np.zeros(0, np.int32), *(np.arange(m, dtype=np.int32) for m in each)])
            rows["hot"] = np.concatenate(common) >= hot
            piece = (np.where(rows["hot"], rows["node"].view(np.uint64), rows["token"]) >> np.uint64(64 - PIECE_BITS)).astype(np.int32)
            by = np.argsort(piece, kind="stable")
            found, at = np.unique(piece[by], return_index=True)
            packed = [_packed(rows[i]) for i in np.split(by, at[1:])] if len(found) else []
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(packed, pa.binary())], ["piece", "rows"])

    return docs.select("text").mapInArrow(run, "piece int, rows binary")


def _lists(rows: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Of the rows of a piece, those of sets that meet another one of a like size, each once; and how many sets of such sizes the list has."""
    by = np.argsort(rows["token"])
    token, hot = rows["token"][by], rows["hot"][by] > 0
    shared = np.zeros(len(by) + 1, bool)
    shared[1:-1] = token[1:] == token[:-1]
    rows = rows[by[shared[1:] | shared[:-1] | hot]]
    rows = rows[np.lexsort((rows["node"], rows["n"], rows["token"]))]
    other = np.ones(len(rows), bool)
    other[1:] = rows["token"][1:] != rows["token"][:-1]
    own = other.copy()
    own[1:] |= rows["node"][1:] != rows["node"][:-1]
    of, rows = (np.cumsum(other) << 32)[own], rows[own]
    n = rows["n"].astype(np.int64)
    low, high = np.ceil(similarity * n - 1e-6).astype(np.int64), np.floor(n / similarity + 1e-6).astype(np.int64)
    length = np.searchsorted(of | n, of | high, "right") - np.searchsorted(of | n, of | low)
    hot = rows["hot"] > 0
    stays = (length > 1) | hot
    return rows[stays], np.where(hot, length * PIECES, length)[stays]  # sets with a common shingle are dealt evenly


def shared(packed: DataFrame, similarity: float) -> DataFrame:
    """(token, node, n, pos, length): prefix shingles of sets that meet others of a like size there."""
    names = ["token", "node", "n", "pos", "length"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> pa.RecordBatch:
            rows, length = _lists(np.concatenate(parts), similarity)
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (rows["token"].view(np.int64), rows["node"], rows["n"].astype(np.int64), rows["pos"], length)], names)

        at, parts = None, []
        for b in batches:
            for piece, rows in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                if piece != at and parts:
                    yield made()
                    parts = []
                at = piece
                parts.append(_unpacked(rows.as_py()))
        if parts:
            yield made()

    return packed.repartition("piece").sortWithinPartitions("piece").mapInArrow(run, "token long, node long, n long, pos int, length long")


def adapted(rows: DataFrame, similarity: float) -> DataFrame:
    """(token, node, n, rest): shared shingles of the prefix that each set picks, and what it has beyond that prefix."""
    n, base = F.col("n"), F.col("n") - _least(similarity, F.col("n"))
    own = Window.partitionBy("node")
    read = {m: F.coalesce(F.sum(F.when(F.col("pos") < base + m, F.col("length"))).over(own), F.lit(0)) for m in LADDER}
    cost = [F.struct((s * (1 + COMPARE * n / F.greatest(needed(n, n - base - m, n, n - base - m, similarity), F.lit(1)))).alias("cost"), F.lit(m).alias("more")) for m, s in read.items()]
    rows = rows.withColumn("more", F.least(*cost)["more"]).where(F.col("pos") < base + F.col("more"))
    return rows.select("token", "node", "n", F.greatest(n - base - F.col("more"), F.lit(0)).alias("rest"))


def _fits(a: str, b: str, similarity: float) -> Column:
    return F.least(a, b) >= similarity * F.greatest(a, b) - 1e-9


def reachable(rows: DataFrame, similarity: float) -> DataFrame:
    """Rows with ``class`` without the sets that share too few shingles with other classes, whatever set there they would link to.

    That holds for coarser classes too, so a set that goes needs no later look."""
    of = rows.groupBy("token").agg(F.min("class").alias("c0"), F.max("class").alias("c1"), F.min("n").alias("low"), F.max("n").alias("high")).where("c0 <> c1")
    shared = rows.join(of.select("token", "low", "high"), "token")
    own = shared.groupBy("node", "n", "rest").agg(F.count("*").alias("c"), F.min("low").alias("low"), F.max("high").alias("high"))
    n = F.col("n")
    low, high = F.greatest("low", _least(similarity, n)), F.least("high", F.floor(n / similarity + 1e-9))
    least = F.least(*(needed(n, F.col("rest"), m, _least(similarity, m) - 1, similarity) for m in (low, high)))
    return shared.drop("low", "high").join(own.where(F.col("c") >= least).select("node"), "node", "left_semi")


def pairs_left(rows: DataFrame) -> tuple[int, int]:
    """Rows, and pairs of sets of different classes in all lists."""
    of = rows.groupBy("token", "class").agg(F.count("*").alias("m")).groupBy("token").agg(F.sum("m").alias("m"), F.sum(F.col("m") * F.col("m")).alias("squares"))
    n, pairs = of.agg(F.sum("m"), F.sum((F.col("m") * F.col("m") - F.col("squares")) / 2)).first()
    return int(n or 0), int(pairs or 0)


def stars(rows: DataFrame, similarity: float, turn: int) -> DataFrame:
    """Pairs (u, v) of sets of different classes: each set with the leader that it meets in most lists, if these are half of what is needed."""
    if turn:
        rank = F.struct(F.xxhash64("class", F.lit(turn)).alias("x"), F.xxhash64("node", F.lit(turn)).alias("y"))
    else:  # the first leaders are sets that share most of their prefix: the middle of a group of near copies does
        rows = rows.withColumn("less", -F.count("*").over(Window.partitionBy("node")))
        rank = F.struct(F.floor(100 * F.col("less") / (F.col("n") - F.col("rest"))).alias("x"), F.xxhash64("node").alias("y"))
    own = F.struct(rank.alias("rank"), F.col("node").alias("leader"), F.col("class").alias("of"), F.col("n").alias("ln"), F.col("rest").alias("lrest"))
    lead = rows.groupBy("token").agg(F.min(own).alias("l")).select("token", "l.leader", "l.of", "l.ln", "l.lrest")
    met = rows.join(lead, "token").where(F.col("class") != F.col("of")).where(_fits("n", "ln", similarity))
    count = met.groupBy("node", "leader").agg(F.count("*").alias("c"), F.first(needed(F.col("n"), F.col("rest"), F.col("ln"), F.col("lrest"), similarity)).alias("need"))
    best = count.where(2 * F.col("c") >= F.col("need")).groupBy("node").agg(F.max(F.struct("c", "leader")).alias("m"))
    return best.select(F.col("node").alias("u"), F.col("m.leader").alias("v"))


def candidates(rows: DataFrame, each: DataFrame, similarity: float) -> DataFrame:
    """Pairs (u, v, cx, cy, c) of sets of different classes cx and cy that share as many prefix shingles as they need.

    Before they are rows, pairs go whose parities differ more than similar sets can."""
    rows = rows.join(each.select("node", *PARITY), "node")
    by = rows.groupBy("token", "class").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.count("*").alias("m"), *parity_ranges())
    near = (F.col("x.low") * similarity <= F.col("y.high") + 1e-9) & (F.col("y.low") * similarity <= F.col("x.high") + 1e-9)
    near &= classes_apart("x", "y") <= most_apart(F.col("x.high"), F.col("y.high"), similarity)
    beside = by.alias("x").join(by.alias("y"), (F.col("x.token") == F.col("y.token")) & smaller_first() & near)
    beside = beside.select("x.token", F.col("x.class").alias("cx"), F.col("y.class").alias("cy"))
    side = lambda s: rows.select("token", F.col("class").alias(f"c{s}"), F.col("node").alias(f"u{s}"), F.col("n").alias(f"n{s}"), F.col("rest").alias(f"r{s}"), *(F.col(p).alias(p + s) for p in PARITY))
    pairs = beside.join(side("x"), ["token", "cx"]).join(side("y"), ["token", "cy"]).where(_fits("nx", "ny", similarity)).where(sets_apart("x", "y") <= most_apart(F.col("nx"), F.col("ny"), similarity))
    pairs = turned(pairs, "c", ["u", "n", "r", "c"])
    each = pairs.groupBy("ux", "uy", "nx", "ny", "rx", "ry", "cx", "cy").agg(F.count("*").alias("c"))
    return each.where(F.col("c") >= needed(F.col("nx"), F.col("rx"), F.col("ny"), F.col("ry"), similarity)).select(F.col("ux").alias("u"), F.col("uy").alias("v"), "cx", "cy", "c")


def _joined(rows: DataFrame, links: DataFrame) -> DataFrame:
    """Rows with ``class`` after links (u, v) of nodes of different classes."""
    class_ = rows.select("node", "class").distinct()
    ends = links.join(class_.select(F.col("node").alias("u"), F.col("class").alias("x")), "u").join(class_.select(F.col("node").alias("v"), F.col("class").alias("y")), "v")
    up = connected_components(ends.select(F.col("x").alias("u"), F.col("y").alias("v"))).withColumnRenamed("node", "class")
    return rows.join(up, "class", "left").withColumn("class", F.coalesce("component", "class")).drop("component")


def links(docs: DataFrame, profiles: DataFrame, each: DataFrame, k: int, similarity: float) -> DataFrame:
    """Links (u, v) of sets whose closure is that of all similar pairs; ``each`` (node, a, b) names a text of each set."""
    spark = docs.sparkSession
    rows = settled(spark, "adapted", lambda: adapted(shared(prefixes(docs, k, similarity, *levels(profiles)), similarity), similarity)).withColumn("class", F.col("node"))
    found, before = None, math.inf
    for turn in range(ROUNDS):
        rows = table(reachable(rows, similarity), "reachable")
        n, pairs = pairs_left(rows)
        if not pairs or turn and (pairs <= DENSE * n or pairs > GAIN * before):  # what stars no longer bring together isn't alike for the most part
            break
        before = pairs
        new = settled(spark, "stars", lambda: verified(docs, each, stars(rows, similarity, turn), k, similarity))  # noqa: B023
        found = new if found is None else found.unionByName(new)
        rows = settled(spark, "classes", lambda: _joined(rows, new))  # noqa: B023
    # the pair of two classes that shares most comes first: what it links needs no other
    pairs = settled(spark, "pairs", lambda: candidates(rows, each, similarity))
    best = pairs.groupBy("cx", "cy").agg(F.max(F.struct("c", "u", "v")).alias("m")).select("m.u", "m.v")
    first = settled(spark, "best", lambda: verified(docs, each, best, k, similarity))

    def rest() -> DataFrame:
        ends = F.array_sort(F.array("u", "v"))
        linked = pairs.withColumn("ends", ends).join(first.select(ends.alias("ends")), "ends", "left_semi").select(F.col("cx").alias("u"), F.col("cy").alias("v"))
        up = connected_components(linked)
        own = pairs.join(up.select(F.col("node").alias("cx"), F.col("component").alias("x")), "cx", "left").join(up.select(F.col("node").alias("cy"), F.col("component").alias("y")), "cy", "left")
        return verified(docs, each, own.where(F.coalesce("x", "cx") != F.coalesce("y", "cy")).select("u", "v"), k, similarity)

    last = first.unionByName(settled(spark, "rest", rest))
    return last if found is None else found.unionByName(last)


def components(docs: DataFrame, k: int = 5, similarity: float = 0.8) -> DataFrame:
    """(doc_id, n_shingles, component_id): the size of each document's set, and the smallest doc_id that links of the similarity reach."""
    docs = docs.select("doc_id", "text")
    profiles = profile(docs, k)
    each = table(profiles.where("chunk is null and n > 0").groupBy("node").agg(F.min(F.struct("other", "a", "b", *PARITY)).alias("m")).select("node", "m.*"), "sets")
    linked = settled(docs.sparkSession, "linked", lambda: connected_components(links(docs, profiles, each, k, similarity)))
    root = each.select("node", F.col("other").alias("own")).join(linked, "node", "left").select("node", "own", F.coalesce("component", "node").alias("root"))
    rows = profiles.where("chunk is null").select("doc_id", "node", "other", "n")
    alone = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    # sets that share the first hash only keep to themselves
    odd = F.col("other") != F.col("own")
    rows = table(rows.where("n > 0").join(root, "node").select("doc_id", "n", F.when(odd, F.col("node")).otherwise(F.col("root")).alias("root"), F.when(odd, F.col("other")).otherwise(0).alias("odd")), "roots")
    least = rows.groupBy("root", "odd").agg(F.min("doc_id").alias("component_id"))
    return rows.join(least, ["root", "odd"]).select("doc_id", F.col("n").alias("n_shingles"), "component_id").unionByName(alone)


def op13(spark, sf_dir: str) -> DataFrame:
    from twinspark.llm.common import read

    return components(read(spark, sf_dir, "documents"))


OP13_SQL = rf"""WITH RECURSIVE w AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w),
t AS (SELECT r, len(s) AS n, unnest(s) AS g FROM s),
p AS (SELECT x.r AS x, y.r AS y FROM t x JOIN t y ON x.g = y.g AND x.r < y.r GROUP BY x.r, y.r, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
l AS (SELECT x AS a, y AS b FROM p UNION ALL SELECT y, x FROM p),
c(a, b) AS (SELECT r, r FROM s UNION SELECT c.a, l.b FROM c JOIN l ON c.b = l.a)
SELECT d.doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles, min(e.doc_id) AS component_id FROM s d JOIN c ON d.r = c.a JOIN s e ON e.r = c.b GROUP BY d.r, d.doc_id, len(d.s)"""


def brute(texts: list[tuple[object, str | None]], k: int = 5) -> list[tuple]:
    """(doc_id, n_shingles, component_id) of a small list, for tests."""
    sets = []
    for _, text in texts:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    label = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]) and label[i] != label[j]:
                label = [label[j] if x == label[i] else x for x in label]
    own = {x: [d for (d, _), y in zip(texts, label, strict=True) if y == x and d is not None] for x in label}
    return [(d, len(s), min(own[x], default=None)) for (d, _), s, x in zip(texts, sets, label, strict=True)]
