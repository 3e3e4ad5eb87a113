"""SimHash near-duplicates, with keys from Golay-code decoding.

A fingerprint is cut into segments of 23 bits (the last one padded). If two fingerprints of 64 bits
differ in at most three bits, then for some two of the three segments each differs in at most one
(errors 0+0+3, 0+1+2 or 1+1+1), and each vector of a segment has the other's nearest codeword among
the up to six codewords within distance four of it. So one key, made of two codewords, is shared: a
vector's nearest codeword in one segment with every near one in the other. Rows of a key are
compared bit by bit, a few rows directly, from ``WIDE`` rows on by reach and from ``GROUP`` on in blocks, with the
same links; a task passes on links that span what it found, never all pairs. Links then go through
distributed connected components.

``near_duplicates`` is the form for corpora: five-word shingles, similarity 0.8. Such documents
differ in about 15 % of the bits, so there the decoding is soft: a segment's signed margins pick the
nearest codewords. 128 bits only propose classes, in which all sets of distinct shingles are compared;
a link is a pair of sets that have the similarity. What they miss is found by an exact prefix filter:
in a common order of all shingles, two sets of similarity s share one of their first n - ceil(s n) + 1,
and how many of these they share, and where, bounds what they can have in common.

Edge cases: null texts and texts without words have fingerprint zero and are linked like any other;
fewer words than a shingle make one shingle; null ids never become a component's id unless all its
ids are null; repeated rows come back as often as they are; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from twinspark.llm import golay
from twinspark.operators.graph import connected_components, local_components
from twinspark.shared import settled, table

SEED = 42
GROUP = 4096  #: fingerprints of a key that one comparison holds; larger groups are compared in blocks of this size
WIDE = 48  #: fingerprints of a key from which on it is compared by reach
FRONT = 16  #: reached rows that meet the others at once
NAME_BITS = 20  #: of the hash of a text, for the filter that keeps other texts from moving
BLOCK_ROWS, BLOCK_SHINGLES = 1024, 1 << 20  #: of sets that are compared at once
COLUMNS = 2048  #: shingles of a block that are counted at once
SKETCH_BITS = 20  #: shingles are counted by so many bits of their hash; common ones come last in the order of the prefix filter
PAIRS = list(combinations(range(3), 2))
PARITY = [f"p{i}" for i in range(8)]  #: columns of 64 parities each, see ``parities``


def shingle_hashes(text: bytes | None, k: int) -> np.ndarray:
    """XXH64 of the k-word shingles of the lower-cased text, repeats included."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) <= k:
        return np.array([xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    starts, ends = (end - size)[: len(words) - k + 1].tolist(), end[k - 1 :].tolist()
    return np.fromiter([xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends, strict=True)], np.uint64, len(starts))


def shingle_set(text: bytes | None, k: int) -> tuple[np.ndarray, int]:
    """The distinct shingle hashes of a text, sorted, and a signed long that stands for the set."""
    h = np.unique(shingle_hashes(text, k))
    return h, xxh64_intdigest(h.tobytes(), SEED) - (1 << 63)


def bit_counts(h: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set; in runs of 255, whose counts fit a byte."""
    out = np.zeros(64, np.int64)
    for i in range(0, len(h), 255 * 256):
        bits = np.unpackbits(np.ascontiguousarray(h[i : i + 255 * 256]).view(np.uint8), bitorder="little").reshape(-1, 64)
        full = len(bits) // 255 * 255
        if full:
            out += bits[:full].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        if full < len(bits):
            out += bits[full:].sum(axis=0, dtype=np.uint8)
    return out


def parities(h: np.ndarray) -> np.ndarray:
    """For each of 512 values of a hash's lowest bits, whether an odd number of the distinct hashes has it; as signed longs.

    A hash that only one of two sets has changes one parity, so sets differ in at least as many hashes as parities.
    """
    return _pack(np.bincount((h & np.uint64(64 * len(PARITY) - 1)).astype(np.int64), minlength=64 * len(PARITY)).reshape(-1, 64) & 1)


def parity_ranges() -> list[Column]:
    """Of the sets of a class: the parities that all of them have, and those that any has."""
    return [f(p).alias(f"{t}{p}") for p in PARITY for t, f in (("all_", F.bit_and), ("any_", F.bit_or))]


def classes_apart(x: str, y: str) -> Column:
    """Parities in which each set of one class differs from each of the other."""
    only = lambda a, b, p: F.col(f"{a}.all_{p}").bitwiseAND(F.bitwise_not(F.col(f"{b}.any_{p}")))
    return sum((F.bit_count(only(x, y, p).bitwiseOR(only(y, x, p))) for p in PARITY), F.lit(0))


def smaller_first() -> Column:
    """Each two classes x and y of a key once, the one with fewer rows there as x: its rows are joined first."""
    return (F.col("x.m") < F.col("y.m")) | ((F.col("x.m") == F.col("y.m")) & (F.col("x.class") < F.col("y.class")))


def turned(pairs: DataFrame, by: str, names: list[str]) -> DataFrame:
    """``names`` followed by x and y, changed over where the x of ``by`` is the larger."""
    over = F.col(f"{by}x") > F.col(f"{by}y")
    return pairs.select(*(F.when(over, F.col(c + b)).otherwise(F.col(c + a)).alias(c + a) for c in names for a, b in ("xy", "yx")))


def sets_apart(x: str, y: str) -> Column:
    """Parities in which two sets differ; their columns end in x and y."""
    return sum((F.bit_count(F.col(p + x).bitwiseXOR(F.col(p + y))) for p in PARITY), F.lit(0))


def most_apart(a: Column, b: Column, similarity: float) -> Column:
    """Shingles in which similar sets of a and b shingles differ at most."""
    return F.lit((1 - similarity) / (1 + similarity)) * (a + b) + 1e-6


def _remix(h: np.ndarray) -> np.ndarray:
    """A second hash from the first (the finalizer of splitmix64)."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _pack(bits: np.ndarray) -> np.ndarray:
    """Rows of 64 booleans, lowest bit first, as signed longs."""
    return np.packbits(bits, axis=-1, bitorder="little").view(np.int64)[..., 0]


def _named(text: Column) -> tuple[Column, Column]:
    """Two hashes that stand for a text."""
    return F.xxhash64(text).alias("a"), F.xxhash64(F.lit(7), text).alias("b")


def fingerprints(docs: DataFrame, k: int = 3) -> DataFrame:
    """(doc_id, f0 long): a bit is 1 if over half of the shingle hashes have it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = np.zeros((b.num_rows, 64), bool)
            for i, text in enumerate(b.column(1).cast(pa.binary()).to_pylist()):
                h = shingle_hashes(text, k)
                rows[i] = bit_counts(h) * 2 > len(h)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(_pack(rows))], ["doc_id", "f0"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, f0 long")


def hard_keys(prints: DataFrame) -> DataFrame:
    """(key, f0, f1) of each fingerprint: every pair within three bits shares a key."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            f = b["f0"].to_numpy().view(np.uint64)
            parts = [golay.near(((f >> np.uint64(23 * s)) & np.uint64((1 << 23) - 1)).astype(np.int64)) for s in range(3)]
            for p, (i, j) in enumerate(PAIRS):
                (a0, a), (b0, bb) = parts[i], parts[j]
                for first, second in [(a0, bb[:, m]) for m in range(6)] + [(a[:, m], b0) for m in range(1, 6)]:
                    ok = (first >= 0) & (second >= 0)
                    yield pd.DataFrame({"key": ((p << 24) | (first << 12) | second)[ok], "f0": b["f0"].to_numpy()[ok], "f1": np.zeros(int(ok.sum()), np.int64)})

    return prints.select("f0").mapInPandas(run, "key long, f0 long, f1 long")


def soft_prints(docs: DataFrame, k: int, near: int = 8, keys: int = 16) -> DataFrame:
    """(a, b, node, other, n, f0, f1, p0, ..., keys) of texts: two hashes of the text and two of its set of shingles, their number, 128 bits, parities, and for each two of three segments the ``keys`` codeword pairs nearest to the margins."""

    names = ["a", "b", "node", "other", "n", "f0", "f1", *PARITY, "keys"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            margin, node, size = np.zeros((b.num_rows, 128), np.float32), np.zeros((2, b.num_rows), np.int64), np.zeros(b.num_rows, np.int32)
            odd = np.zeros((b.num_rows, len(PARITY)), np.int64)
            for i, text in enumerate(b.column(2).cast(pa.binary()).to_pylist()):
                h, node[0, i] = shingle_set(text, k)
                node[1, i], size[i] = xxh64_intdigest(h.tobytes(), SEED + 1) - (1 << 63), len(h)
                odd[i] = parities(h)
                if len(h):
                    margin[i] = (2 * np.concatenate([bit_counts(h), bit_counts(_remix(h))]) - len(h)) / math.sqrt(len(h))
            found = [golay.soft(margin[:, 23 * s : 23 * s + 23], near) for s in range(3)]
            own = []
            for p, (i, j) in enumerate(PAIRS):
                (a, sa), (c, sc) = found[i], found[j]
                score = (sa[:, :, None] + sc[:, None, :]).reshape(b.num_rows, -1)
                code = ((p << 24) | (a[:, :, None] << 12) | c[:, None, :]).reshape(b.num_rows, -1)
                own.append(np.take_along_axis(code, np.argpartition(-score, keys, axis=1)[:, :keys], 1))
            own = np.sort(np.concatenate(own, axis=1).astype(np.int32), axis=1)
            listed = pa.ListArray.from_arrays(np.arange(0, own.size + 1, own.shape[1], dtype=np.int32), pa.array(own.ravel()))
            bits = [pa.array(_pack(margin[:, :64] > 0)), pa.array(_pack(margin[:, 64:] > 0))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *map(pa.array, (*node, size)), *bits, *map(pa.array, np.ascontiguousarray(odd.T)), listed], names)

    return docs.select(*_named(F.col("text")), "text").mapInArrow(run, f"a long, b long, node long, other long, n int, f0 long, f1 long, {', '.join(f'{p} long' for p in PARITY)}, keys array<int>")


def _bits(x: np.ndarray) -> np.ndarray:
    """Set bits of signed longs (numpy counts those of the absolute value)."""
    return np.bitwise_count(x.view(np.uint64)).astype(np.int64)


def _reach(f0: np.ndarray, f1: np.ndarray, most: int) -> np.ndarray:
    """Label of each row of one key: the first row that links of ``most`` bits at most reach.

    A row that was reached meets only rows that were not, so a group of near copies costs its length
    a few times over; only rows that link to nothing meet all others.
    """
    label, left = np.arange(len(f0)), np.arange(len(f0))
    while len(left):
        root, left = left[0], left[1:]
        front = np.array([root])
        while len(front) and len(left):
            take, front = front[:FRONT], front[FRONT:]
            apart = _bits(f0[take, None] ^ f0[left]) + _bits(f1[take, None] ^ f1[left])
            near = (apart <= most).any(axis=0)
            label[left[near]] = root
            front, left = np.concatenate([front, left[near]]), left[~near]
    return label


def _compare(key: np.ndarray, f0: np.ndarray, f1: np.ndarray, most: int) -> np.ndarray:
    """Rows sorted by key; the label of each after linking rows of a key that differ in ``most`` bits at most."""
    n = len(key)
    label = np.arange(n)
    begin = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    size = np.diff(np.r_[begin, n])
    for a, m in zip(begin[size > WIDE].tolist(), size[size > WIDE].tolist(), strict=True):
        label[a : a + m] = a + _reach(f0[a : a + m], f1[a : a + m], most)
    at, lag = np.flatnonzero(np.repeat(size <= WIDE, size)), 1
    us, vs = [np.arange(n)], [label]
    while True:  # small groups, all at once: each row with the one ``lag`` further on
        at = at[: np.searchsorted(at, n - lag)]
        at = at[key[at] == key[at + lag]]
        if not len(at):
            return local_components(n, np.concatenate(us), np.concatenate(vs))
        ok = _bits(f0[at] ^ f0[at + lag]) + _bits(f1[at] ^ f1[at + lag]) <= most
        us.append(at[ok])
        vs.append(at[ok] + lag)
        lag += 1


OUT = "kind int, key long, block int, f0 long, f1 long, g0 long, g1 long"


def _frame(kind: int, key, block, f0, f1, g0, g1) -> pd.DataFrame:
    n = len(f0)
    return pd.DataFrame({"kind": np.full(n, kind, np.int32), "key": key, "block": np.broadcast_to(np.int32(block), n), "f0": f0, "f1": f1, "g0": g0, "g1": g1})


def links(keyed: DataFrame, most: int) -> DataFrame:
    """(key, f0, f1) to links (f0, f1, g0, g1) whose closure is that of all pairs of a key within ``most`` bits."""

    def star(key, f0, f1, own=None) -> pd.DataFrame:
        label = _compare(key, f0, f1, most)
        own = np.flatnonzero(label != np.arange(len(label)) if own is None else own & (label != np.arange(len(label))))
        to = label[own]
        return _frame(0, key[own], 0, f0[own], f1[own], f0[to], f1[to])

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, block = None, 0
        for b in batches:
            rows = b.to_numpy() if held is None else np.concatenate([held, b.to_numpy()])
            cut = int(np.searchsorted(rows[:, 0], rows[-1, 0]))  # the last key may go on
            if cut and block:  # the end of a large group
                first = int(np.searchsorted(rows[:, 0], rows[0, 0], "right"))
                part, rows, cut = rows[:first], rows[first:], cut - first
                yield star(*part.T)
                yield _frame(1, part[:, 0], block, part[:, 1], part[:, 2], 0, 0)
                block = 0
            if cut:
                yield star(*rows[:cut].T)
            held = rows[cut:]
            while len(held) > GROUP:
                part, held = held[:GROUP], held[GROUP:]
                yield star(*part.T)
                yield _frame(1, part[:, 0], block, part[:, 1], part[:, 2], 0, 0)
                block += 1
        if held is not None and len(held):
            yield star(*held.T)
            if block:
                yield _frame(1, held[:, 0], block, held[:, 1], held[:, 2], 0, 0)

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def across(rows: np.ndarray) -> pd.DataFrame:
            group, block = (np.cumsum(np.r_[0, (rows[1:, :c] != rows[:-1, :c]).any(axis=1)]) for c in (3, 4))
            first = _compare(block, rows[:, 4], rows[:, 5], most) == np.arange(len(rows))  # links in a block are known
            return star(group, rows[:, 4], rows[:, 5], first)

        held = None
        for b in batches:
            rows = b.to_numpy() if held is None else np.concatenate([held, b.to_numpy()])
            cut = int(np.flatnonzero((rows[:, :3] == rows[-1, :3]).all(axis=1))[0])
            if cut:
                yield across(rows[:cut])
            held = rows[cut:]
        if held is not None and len(held):
            yield across(held)

    found = table(keyed.repartition("key").sortWithinPartitions("key", "f0", "f1").mapInPandas(scan, OUT), "links")
    pair = found.where("kind = 0").select("f0", "f1", "g0", "g1")
    rest = found.where("kind = 1").select("key", "block", "f0", "f1")
    if rest.isEmpty():
        return pair.distinct()
    # each block of a large group meets each other block of it, in a task of its own
    count = rest.groupBy("key").agg(F.max("block").alias("last"))
    met = rest.join(count, "key").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("last")))).where("other <> block")
    met = met.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), F.col("block").cast("long").alias("own"), "f0", "f1")
    more = met.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "own", "f0", "f1").mapInPandas(blocks, OUT)
    return pair.unionByName(more.select("f0", "f1", "g0", "g1")).distinct()


def components(docs: DataFrame) -> DataFrame:
    """(doc_id, f0) to (doc_id, f0, component_id): fingerprints within three bits, closed; the smallest doc_id of each class."""
    prints = table(fingerprints(docs), "prints")
    each = prints.groupBy("f0").agg(F.min("doc_id").alias("least"))
    linked = connected_components(links(hard_keys(each), 3).select(F.col("f0").alias("u"), F.col("g0").alias("v")))
    root = each.join(linked.withColumnRenamed("node", "f0"), "f0", "left").withColumn("root", F.coalesce("component", "f0"))
    least = root.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(root.join(least, "root").select("f0", "component_id"), "f0")


def _sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(node, held): the shingle hashes of one text of each of the ``wanted`` sets (a, b).

    Texts that aren't wanted mostly don't move: a broadcast of at most 2^20 prefixes of their hashes comes first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingle_set(text, k) for text in b.column(0).cast(pa.binary()).to_pylist()]
            held = pa.array([h.view(np.int64) for h, _ in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([n for _, n in sets], pa.int64()), held], ["node", "held"])

    bits = F.shiftrightunsigned("a", 64 - NAME_BITS).cast("int").alias("bits")
    wanted = table(wanted.select("a", "b", bits), "wanted")
    texts = docs.select(*_named(F.col("text")), "text").select("*", bits).join(F.broadcast(wanted.select("bits").distinct()), "bits", "left_semi")
    one = texts.groupBy("a", "b").agg(F.first("text").alias("text"))  # copies combine before they move
    return table(one.join(wanted.select("a", "b"), ["a", "b"], "left_semi").select("text").mapInArrow(run, "node long, held array<long>"), "sets")


def _alike(sets: list[np.ndarray], own: np.ndarray, similarity: float) -> np.ndarray:
    """Label of each of some sets: the first one that links of the similarity reach; with two kinds of ``own``, links from one to the other only.

    Common shingles are counted by products of 0-1 matrices, some columns at a time.
    """
    size = np.array([len(x) for x in sets])
    flat = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), size)
    order = np.argsort(flat, kind="stable")
    new = np.r_[True, flat[order][1:] != flat[order][:-1]] if len(flat) else np.zeros(0, bool)
    group = np.cumsum(new) - 1
    again = np.bincount(group) > 1 if len(flat) else np.zeros(0, bool)
    col, row = (np.cumsum(again) - 1)[group][again[group]], row[order][again[group]]
    one, two = np.flatnonzero(own == own[0]), np.flatnonzero(own != own[0])
    two = two if len(two) else one
    common = np.zeros((len(one), len(two)), np.float32)
    for a in range(0, int(again.sum()), COLUMNS):
        p, q = np.searchsorted(col, [a, a + COLUMNS])
        m = np.zeros((len(sets), COLUMNS), np.float32)
        m[row[p:q], col[p:q] - a] = 1
        common += m[one] @ m[two].T
    i, j = np.nonzero(common >= similarity * (size[one][:, None] + size[two] - common) - 1e-6)
    return local_components(len(sets), one[i], two[j])


def within(docs: DataFrame, each: DataFrame, classes: DataFrame, k: int, similarity: float) -> DataFrame:
    """Links (u, v) whose closure is that of all pairs of the similarity within classes (node, class).

    Sets of a class meet in blocks of a bounded number of rows and shingles, each pair of blocks in a group of its own.
    """
    order = Window.partitionBy("class").orderBy("node").rowsBetween(Window.unboundedPreceding, 0)
    rows = classes.join(classes.groupBy("class").agg(F.count("*").alias("rows")).where("rows > 1").select("class"), "class").join(each.select("node", "a", "b", "n"), "node")
    number = F.greatest(F.floor((F.count("*").over(order) - 1) / BLOCK_ROWS), F.floor(F.sum("n").over(order) / BLOCK_SHINGLES)).cast("int")
    rows = table(rows.select("class", "node", "a", "b", number.alias("own")), "members")
    last = rows.groupBy("class").agg(F.max("own").alias("last"))
    met = rows.join(_sets(docs, rows.select("a", "b"), k), "node").join(last, "class")
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), "last")))
    met = met.select("class", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "node", "held")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(rows: list[tuple]) -> pa.RecordBatch:
            node = np.array([r[4] for r in rows], np.int64)
            label = _alike([r[5] for r in rows], np.array([r[3] for r in rows]), similarity)
            at = np.flatnonzero(label != np.arange(len(rows)))
            return pa.RecordBatch.from_arrays([pa.array(node[at]), pa.array(node[label[at]])], ["u", "v"])

        held: list[tuple] = []
        for b in batches:
            whole = b.column(5)
            flat, ends = whole.flatten().to_numpy().view(np.uint64), np.diff(whole.offsets.to_numpy()).cumsum()
            sets = [x.copy() for x in np.split(flat, ends[:-1])]
            for r in zip(*(b.column(i).to_pylist() for i in range(5)), sets, strict=True):
                if held and r[:3] != held[0][:3]:
                    yield flush(held)
                    held = []
                held.append(r)
        if held:
            yield flush(held)

    return met.repartition("class", "x", "y").sortWithinPartitions("class", "x", "y").mapInArrow(run, "u long, v long")


def verified(docs: DataFrame, each: DataFrame, pairs: DataFrame, k: int, similarity: float) -> DataFrame:
    """The pairs (u, v) of nodes whose sets have the Jaccard similarity; ``each`` names a text (a, b) of each node."""
    pairs = table(pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).where("u <> v").distinct(), "candidates")
    nodes = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    sets = _sets(docs, nodes.join(each.select("node", "a", "b"), "node"), k)
    both = pairs.join(sets.select(F.col("node").alias("u"), F.col("held").alias("x")), "u").join(sets.select(F.col("node").alias("v"), F.col("held").alias("y")), "v")
    both = both.select("u", "v", (F.size("x") + F.size("y")).alias("n"), F.size(F.array_intersect("x", "y")).alias("common"))
    return both.where(F.col("common") >= similarity * (F.col("n") - F.col("common")) - 1e-9).select("u", "v")


def proposed(each: DataFrame, most: int) -> DataFrame:
    """Pairs (u, v) of nodes: links by fingerprint that span the classes of ``most`` bits, found without meeting all pairs."""
    found = links(each.select(F.explode(F.col("keys").cast("array<long>")).alias("key"), "f0", "f1").distinct(), most)
    first = each.groupBy("f0", "f1").agg(F.min("node").alias("v"))
    ends = found.join(first.withColumnRenamed("v", "u"), ["f0", "f1"]).join(first.select(F.col("f0").alias("g0"), F.col("f1").alias("g1"), "v"), ["g0", "g1"])
    return ends.select("u", "v").unionByName(each.join(first, ["f0", "f1"]).select(F.col("node").alias("u"), "v"))


def _common(docs: DataFrame, k: int, similarity: float) -> np.ndarray:
    """Whether the shingles of each sketch bucket are far more frequent than those of the average one.

    Counted are the lowest hashes of each set, twice the length of a prefix: others come into a prefix only
    if more than half of those before them are common. It sets an order; any order gives the same pairs.
    """
    size, shift = 1 << SKETCH_BITS, np.uint64(64 - SKETCH_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(size, np.int64)
        for b in batches:
            for text in b.column(0).cast(pa.binary()).to_pylist():
                h = shingle_set(text, k)[0]
                np.add.at(n, (h[: 2 * _prefix(len(h), similarity)] >> shift).astype(np.int64), 1)
        at = np.flatnonzero(n)
        for i in range(0, len(at), 1 << 16):
            part = at[i : i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(n[part])], ["bucket", "n"])

    count = table(docs.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")), "sketch")
    average = count.agg(F.avg("n")).first()[0] or 0
    out = np.zeros(size, bool)
    out[count.where(F.col("n") > 4 * average + 20).select("bucket").toPandas()["bucket"].to_numpy(np.int64)] = True  # under a quarter of the buckets
    return out


def prefix_keys(docs: DataFrame, k: int, similarity: float) -> DataFrame:
    """(key, node, n, pos) of the prefix of each set: every pair of the similarity shares a key."""
    common, shift = _common(docs, k, similarity), np.uint64(64 - SKETCH_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for b in batches:
            keys, nodes, sizes = [np.zeros(0, np.uint64)], [], []
            for text in b.column(0).cast(pa.binary()).to_pylist():
                h, node = shingle_set(text, k)
                if node not in seen:
                    seen.add(node)
                    last = common[(h >> shift).astype(np.int64)]
                    keys.append(np.concatenate([h[~last], h[last]])[: _prefix(len(h), similarity)])
                    nodes.append(node)
                    sizes.append(len(h))
            each = [len(x) for x in keys[1:]]
            cols = np.concatenate(keys).view(np.int64), np.repeat(np.array(nodes, np.int64), each), np.repeat(np.array(sizes, np.int32), each)
            pos = np.concatenate([np.zeros(0, np.int32), *(np.arange(m, dtype=np.int32) for m in each)])
            yield pa.RecordBatch.from_arrays([*map(pa.array, cols), pa.array(pos)], ["key", "node", "n", "pos"])

    rows = docs.select("text").mapInArrow(run, "key long, node long, n int, pos int")
    own = Window.partitionBy("key")
    shared = rows.withColumn("low", F.min("node").over(own)).withColumn("high", F.max("node").over(own)).where("low <> high")
    return table(shared.select("key", "node", "n", "pos").distinct(), "prefixes")


def _prefix(n: int, similarity: float) -> int:
    return n - math.ceil(similarity * n - 1e-9) + 1


def _least_shared(a: Column, b: Column, similarity: float) -> Column:
    """Prefix keys that sets of a and b shingles share at least if they have the similarity."""
    after = lambda n: F.ceil(similarity * n - 1e-9) - 1  # noqa: E731  shingles after the prefix
    need = F.lit(similarity / (1 + similarity)) * (a + b) - 1e-6
    return need - F.greatest(F.least(after(a), b), F.least(after(b), a))


def reachable(rows: DataFrame, similarity: float, rounds: int = 1) -> DataFrame:
    """(key, node, n, pos, class) without the sets that can't be similar to one of another class.

    A set shares at least so many prefix keys with a similar one, the fewer the further their sizes are apart;
    a set with fewer keys that occur in other classes, given the sizes there, goes with all its keys. That may leave
    others with too few, so it is done again.
    """
    for _ in range(rounds):
        keys = rows.groupBy("key").agg(F.min("class").alias("c0"), F.max("class").alias("c1"), F.min("n").alias("low"), F.max("n").alias("high")).where("c0 <> c1")
        rows = rows.join(keys.select("key", "low", "high"), "key")
        own = rows.groupBy("node", "n").agg(F.count("*").alias("shared"), F.min("low").alias("low"), F.max("high").alias("high"))
        low, high = F.greatest("low", F.ceil(similarity * F.col("n") - 1e-9)), F.least("high", F.floor(F.col("n") / similarity + 1e-9))
        least = F.least(_least_shared(F.col("n"), low, similarity), _least_shared(F.col("n"), high, similarity))
        rows = table(rows.drop("low", "high").join(own.where(F.col("shared") >= least).select("node"), "node", "left_semi"), "reachable")
    return rows


def met(rows: DataFrame, each: DataFrame, similarity: float) -> DataFrame:
    """(key, node, n, pos, class) and the parities of each node to the pairs (u, v) of nodes of different classes that their prefixes don't rule out.

    Classes of a key meet first, so that a large class costs no pairs within it. Two prefixes share c keys,
    the last of them at places x and y: the set whose prefix ends first shares nothing else of it, so the
    sets have c and what follows that prefix in common at most, and c and what follows x or y. Before they are
    rows, pairs go whose parities differ more than similar sets can.
    """
    rows = rows.join(each.select("node", *PARITY), "node")
    own = rows.groupBy("key", "class").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.count("*").alias("m"), *parity_ranges())
    fits = (F.col("x.low") * similarity <= F.col("y.high") + 1e-9) & (F.col("y.low") * similarity <= F.col("x.high") + 1e-9)
    fits &= classes_apart("x", "y") <= most_apart(F.col("x.high"), F.col("y.high"), similarity)
    beside = own.alias("x").join(own.alias("y"), (F.col("x.key") == F.col("y.key")) & smaller_first() & fits)
    beside = beside.select("x.key", F.col("x.class").alias("cx"), F.col("y.class").alias("cy"))
    side = lambda s: rows.select("key", F.col("class").alias(f"c{s}"), F.col("node").alias(f"n{s}"), F.col("n").alias(f"s{s}"), F.col("pos").alias(f"pos{s}"), *(F.col(p).alias(p + s) for p in PARITY))
    pairs = beside.join(side("x"), ["key", "cx"]).join(side("y"), ["key", "cy"]).where(F.least("sx", "sy") >= similarity * F.greatest("sx", "sy") - 1e-9)
    pairs = pairs.where(sets_apart("x", "y") <= most_apart(F.col("sx"), F.col("sy"), similarity))
    pairs = turned(pairs, "n", ["n", "s", "pos"]).withColumnsRenamed({"posx": "px", "posy": "py"})
    each = pairs.groupBy("nx", "ny", "sx", "sy").agg(F.count("*").alias("c"), *(f(p).alias(f"{t}{p}") for p in ("px", "py") for t, f in (("first_", F.min), ("last_", F.max))))
    after = lambda s: F.ceil(similarity * F.col(s) - 1e-9) - 1  # noqa: E731  shingles after the prefix
    rest = lambda s, p: F.col(s) - F.col(p) - 1
    most = F.col("c") + F.greatest(F.least(after("sx"), rest("sy", "last_py")), F.least(after("sy"), rest("sx", "last_px")))
    from_first = F.least(rest("sx", "first_px"), rest("sy", "first_py")) + 1
    need = F.lit(similarity / (1 + similarity)) * (F.col("sx") + F.col("sy")) - 1e-6
    return each.where((F.least(most, from_first) >= need)).select(F.col("nx").alias("u"), F.col("ny").alias("v"))


def _kept(docs: DataFrame, keyed: DataFrame, k: int, similarity: float) -> DataFrame:
    """The rows of ``keyed`` (id, a, b, c) that stay, one of each class, with the id hashed."""
    most = int(128 * math.acos(2 * similarity / (1 + similarity)) / math.pi + 2)
    prints = table(soft_prints(docs, k).distinct(), "prints")
    least = prints.groupBy("node").agg(F.min(F.struct("other", "a", "b", "n", "f0", "f1", *PARITY, "keys")).alias("m"))
    each = table(least.select("node", "m.*"), "nodes")
    near = connected_components(proposed(each, most))
    classes = table(each.select("node").join(near, "node", "left").select("node", F.coalesce("component", "node").alias("class")), "classes")
    held = table(within(docs, each, classes, k, similarity), "held")
    rows = reachable(prefix_keys(docs, k, similarity).join(classes, "node"), similarity)
    more = verified(docs, each, met(rows, each, similarity), k, similarity)
    linked = connected_components(held.unionByName(more))
    root = each.join(linked, "node", "left").select("node", "other", F.coalesce("component", "node").alias("root"))
    nodes = prints.select("a", "b", "node", "other").join(root, ["node", "other"], "left")
    class_ = F.struct(F.coalesce("root", "node").alias("node"), F.when(F.col("root").isNull(), F.col("other")).alias("other"))
    nodes = nodes.select("a", "b", class_.alias("class"))
    keep = keyed.join(nodes, ["a", "b"]).groupBy("class").agg(F.min(F.struct("id", "a", "b", "c")).alias("keep"))
    return keep.select("keep.*").withColumn("id", F.xxhash64("id"))


def near_duplicates(docs: DataFrame, k: int = 5, similarity: float = 0.8) -> DataFrame:
    """``docs`` without later near copies: of each class the row with the smallest doc_id stays (null ids last, then by
    hash of the text, then by hash of the row), the same in each run.

    ``similarity`` is the Jaccard similarity s of shingle sets; the cosine of their SimHash sums is
    2s/(1+s) for sets of a size, and bits differ with probability acos(cosine)/pi. The limit is that
    of 128 bits, and two more for the spread of the estimate. Closure of the pairs within it makes classes to
    compare: all pairs in a class are compared exactly, and of the pairs across classes all that the prefix filter
    leaves. A set goes by two 64-bit hashes; of sets that share the first only one is
    compared, the others stay, so that no hash ever removes a text unlike the one that is kept.
    Lazy but for the names of the rows that stay, the one table that is left.
    """
    # one row of each class, the same in each run: by id, then by text, then by the other columns
    plain = [F.col(f.name) for f in docs.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    id_ = F.col("doc_id")
    keyed = docs.select(F.struct("*").alias("doc"), F.struct(id_.isNull().alias("none"), id_.alias("id")).alias("id"), *_named(F.col("text")), F.xxhash64(*plain).alias("c"))
    keep = settled(docs.sparkSession, "keep", lambda: _kept(docs, keyed.select("id", "a", "b", "c"), k, similarity))
    own = keyed.withColumn("id", F.xxhash64("id")).join(keep, ["id", "a", "b", "c"], "left_semi")
    return own.groupBy("id", "a", "b", "c").agg(F.first("doc").alias("doc")).select("doc.*")


def op3(spark, sf_dir: str) -> DataFrame:
    from twinspark.llm.common import read

    hexed = F.lower(F.lpad(F.hex("f0"), 16, "0"))
    return components(read(spark, sf_dir, "documents")).select("doc_id", hexed.alias("fingerprint"), "component_id")
