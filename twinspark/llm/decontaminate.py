"""Benchmark decontamination with an FM-index for each shard of the training texts.

A task gathers documents into shards of bounded size. A shard's text is the sequence of its words'
numbers in the vocabulary of the test phrases; words outside that vocabulary can't be part of an
occurrence, so the index keeps only the runs between them that are as long as the shortest phrase
window. The suffix array of the runs gives the Burrows-Wheeler transform, a wavelet matrix its ranks,
backward search the rows of every window, and sampled suffix positions (run starts among them, so
that no walk leaves its run) the places. Overlapping places merge into removal spans. Everything
happens where the document is: no shuffle, and the test phrases are broadcast in blocks of a checked
size, one narrow pass for each block.

Edge cases: null or wordless texts have no words and stay as they are; items with null text or
without words are ignored; an item of fewer words than a window is one window; a null item id is the empty string; repeated rows, items
and null ids are kept as they are; an empty benchmark marks nothing; other columns pass through.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW = 10
BLOCK_BYTES = 8 << 20  #: test phrases broadcast at once
SHARD_BYTES = 24 << 20
SAMPLE = 16
_KEEP = bytes(range(0x30, 0x3A)) + bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_TABLE = bytes((b + 32 if 0x41 <= b <= 0x5A else b) if b in _KEEP else 0x20 for b in range(256))
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TABLE).split()


class WaveletMatrix:
    """Ranks of symbols in prefixes of a sequence, vectorised over queries."""

    def __init__(self, seq: np.ndarray, levels: int):
        self.zeros, self.ranks = [], []
        for level in reversed(range(levels)):
            bit = (seq >> level) & 1
            self.ranks.append(np.concatenate([[0], np.cumsum(1 - bit)]).astype(np.int32))
            self.zeros.append(int(self.ranks[-1][-1]))
            seq = np.concatenate([seq[bit == 0], seq[bit == 1]])
        self.levels = levels

    def rank(self, c: np.ndarray, *ends: np.ndarray) -> list[np.ndarray]:
        """Occurrences of c in the first ``end`` symbols, for each of ``ends``."""
        at = [np.zeros_like(c), *ends]
        for level, (zeros, ranks) in enumerate(zip(self.zeros, self.ranks, strict=True)):
            one = (c >> (self.levels - 1 - level)) & 1 == 1
            low = [ranks[x] for x in at]
            at = [np.where(one, zeros + x - y, y) for x, y in zip(at, low, strict=True)]
        return [x - at[0] for x in at[1:]]


class FMIndex:
    """Runs of symbols 1..sigma, each ended by 0; the zeros order by place, so no suffix goes past its run."""

    def __init__(self, text: np.ndarray, sigma: int):
        n = len(text)
        ends = np.flatnonzero(text == 0)
        rank = text.astype(np.int64) + len(ends)
        rank[ends] = np.arange(len(ends))
        k = 1
        while True:
            after = np.zeros(n, np.int64)
            after[:-k] = rank[k:] + 1
            key = rank * (max(int(rank.max()), int(after.max())) + 2) + after
            order = np.argsort(key, kind="stable")
            step = np.r_[0, np.cumsum(key[order][1:] != key[order][:-1])]
            rank = np.empty(n, np.int64)
            rank[order] = step
            if n == 0 or step[-1] == n - 1:
                break
            k *= 2
        self.bwt = text[order - 1].astype(np.int64)
        self.below = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma + 1))]).astype(np.int64)
        self.wavelet = WaveletMatrix(self.bwt, max(1, int(sigma).bit_length()))
        sampled = np.arange(n) % SAMPLE == 0
        sampled[0] = True
        sampled[ends[:-1] + 1] = True
        self.sample = np.where(sampled[order], order, -1)

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and end row of each pattern; symbols are right-aligned, the last in the last column."""
        width = patterns.shape[1]
        lo, hi = np.zeros(len(patterns), np.int64), np.full(len(patterns), len(self.bwt), np.int64)
        alive = np.arange(len(patterns))
        for j in range(1, width + 1):
            alive = alive[(lo[alive] < hi[alive]) & (lengths[alive] >= j)]
            c = patterns[alive, width - j]
            a, b = self.wavelet.rank(c, lo[alive], hi[alive])
            lo[alive], hi[alive] = self.below[c] + a, self.below[c] + b
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        at, steps = rows.copy(), np.zeros(len(rows), np.int64)
        open_ = np.flatnonzero(self.sample[at] < 0)
        while len(open_):
            c = self.bwt[at[open_]]
            at[open_] = self.below[c] + self.wavelet.rank(c, at[open_])[0]
            steps[open_] += 1
            open_ = open_[self.sample[at[open_]] < 0]
        return self.sample[at] + steps


class Phrases:
    """Windows of the test items over their own vocabulary."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        of: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            w = [self.vocabulary.setdefault(x, len(self.vocabulary) + 1) for x in words(text)]
            for i in range(max(1, len(w) - window + 1) if w else 0):
                of.setdefault(tuple(w[i : i + window]), set()).add(item)
        self.items = list(of.values())
        self.lengths = np.array([len(x) for x in of], np.int64)
        self.patterns = np.zeros((len(of), window), np.int64)
        for i, x in enumerate(of):
            self.patterns[i, window - len(x) :] = x
        self.least = min(map(len, of), default=window)

    def find(self, texts: list[bytes | None]) -> tuple[list[int], dict[int, list[tuple[int, int]]], dict[int, set[str]]]:
        """Words of each text; by number of text, its merged spans (first word, words) and the items that occur."""
        counts, runs, firsts, owners, starts, total = [], [], [], [], [], 0
        get = self.vocabulary.get
        for d, text in enumerate(texts):
            w = words(text)
            counts.append(len(w))
            if len(w) < self.least or not self.items:
                continue
            ids = np.fromiter(map(get, w, repeat(0)), np.int32, len(w))
            edge = np.flatnonzero(np.diff(np.r_[False, ids > 0, False].view(np.int8)))
            for a, b in edge.reshape(-1, 2)[(edge[1::2] - edge[::2]) >= self.least].tolist():
                runs += [ids[a:b], np.zeros(1, np.int32)]
                firsts.append(a)
                owners.append(d)
                starts.append(total)
                total += b - a + 1
        if not runs:
            return counts, {}, {}
        index = FMIndex(np.concatenate(runs), len(self.vocabulary))
        lo, hi = index.search(self.patterns, self.lengths)
        hits = np.flatnonzero(lo < hi)
        size = (hi - lo)[hits]
        which = np.repeat(hits, size)
        rows = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + lo[which]
        at = index.locate(rows)
        cover = np.zeros(total + 1, np.int32)
        np.add.at(cover, at, 1)
        np.add.at(cover, at + self.lengths[which], -1)
        hit = np.r_[False, np.cumsum(cover)[:-1] > 0, False].view(np.int8)
        edge = np.flatnonzero(np.diff(hit))
        begin, owner, first = np.array(starts), np.array(owners), np.array(firsts)
        spans: dict[int, list[tuple[int, int]]] = {}
        for a, b in edge.reshape(-1, 2).tolist():
            r = int(np.searchsorted(begin, a, "right")) - 1
            spans.setdefault(int(owner[r]), []).append((int(first[r]) + a - starts[r], b - a))
        found: dict[int, set[str]] = {}
        doc = owner[np.searchsorted(begin, at, "right") - 1]
        for d, p in np.unique(np.stack([doc, which], 1), axis=0).tolist():
            found.setdefault(d, set()).update(self.items[p])
        return counts, spans, found


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, n in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], a + n)
        else:
            out.append([a, a + n])
    return [(a, b - a) for a, b in out]


def cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the spans and what stands between them."""
    places = [m.span() for m in _WORD.finditer(text)]
    out, last = [], 0
    for a, n in spans:
        out.append(text[last : places[a][0]])
        last = places[a + n - 1][1]
    return b"".join([*out, text[last:]])


FOUND = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("words", T.LongType())]))),
    T.StructField("items", T.ArrayType(T.StringType())),
])
_FOUND = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("first", pa.int64()), ("words", pa.int64())]))), ("items", pa.list_(pa.string()))])


def _blocks(benchmark: DataFrame, limit: int) -> tuple[int, Iterator[list[tuple[str, bytes]]]]:
    """How many blocks of about ``limit`` bytes the items make, and the blocks; each is collected when its turn comes."""
    items = benchmark.where("text is not null").select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("i"), F.col("text").cast("binary").alias("t"))
    total = items.agg(F.sum(F.length("t") + 16)).first()[0] or 0
    n = -(-total // limit) or 1
    return n, ([(r.i, bytes(r.t)) for r in items.where(F.pmod(F.xxhash64("t", "i"), F.lit(n)) == k).collect()] for k in range(n))


def scan(docs: DataFrame, benchmark: DataFrame, keep: list[str] | None = None, window: int = WINDOW, clean: bool = False, block_bytes: int = BLOCK_BYTES, into: str = "found") -> DataFrame:
    """``docs`` (only the columns ``keep``, if given) and, in the struct ``into``, word count, merged spans and item ids.

    ``clean``: ``text`` comes back without the spans; texts without a hit stay byte for byte.
    A column of the input that is called like ``into`` gives way to it.
    """
    spark = docs.sparkSession
    n, sets = _blocks(benchmark, block_bytes)
    last = n - 1
    names = [c for c in keep or docs.columns if c.lower() != into.lower()]
    carried = [F.col(f"`{c}`") for c in names if not (clean and c == "text")]  # besides the text, only these go to Python
    out = docs.select(F.struct(*carried or [F.lit(0).alias("none")]).alias("d"), F.col("text").cast("binary").alias("b"), F.lit(None).cast(FOUND).alias("found"))
    for k, items in enumerate(sets):
        shared = spark.sparkContext.broadcast(Phrases(items, window))
        final = k == last

        def run(batches: Iterator[pa.RecordBatch], shared=shared, final=final) -> Iterator[pa.RecordBatch]:
            phrases = shared.value

            def flush(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                texts = [x for b in held for x in b.column(1).to_pylist()]
                counts, spans, items = phrases.find(texts)
                at = 0
                for b in held:
                    rows, cleaned = [], []
                    for i, was in enumerate(b.column(2).to_pylist()):
                        own = [(x["first"], x["words"]) for x in was["spans"]] if was else []
                        own = _merge(own + spans.get(at + i, []))
                        ids = sorted(items.get(at + i, set()) | set(was["items"] if was else []))
                        rows.append({"n_words": counts[at + i], "spans": [{"first": a, "words": n} for a, n in own], "items": ids})
                        if final:
                            cleaned.append(cut(texts[at + i], own) if clean and own else texts[at + i] if clean else None)
                    at += b.num_rows
                    text = pa.array(cleaned, pa.binary()) if final else b.column(1)
                    yield pa.RecordBatch.from_arrays([b.column(0), text, pa.array(rows, _FOUND)], ["d", "b", "found"])

            held, size = [], 0
            for b in batches:
                held.append(b)
                size += b.column(1).nbytes
                if size >= SHARD_BYTES:
                    yield from flush(held)
                    held, size = [], 0
            if held:
                yield from flush(held)

        out = out.mapInArrow(run, out.schema)
    text = F.col("b").cast("string").alias("text")
    return out.select(*[text if clean and c == "text" else F.col("d").getField(c).alias(c) for c in names], F.col("found").alias(into))


def op8(spark, sf_dir: str) -> DataFrame:
    from twinspark.llm.common import read

    s = scan(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), ["doc_id"])
    hit = F.aggregate("found.spans", F.lit(0).cast("long"), lambda a, x: a + x["words"])
    return s.select(
        "doc_id", F.col("found.n_words").alias("n_words"), hit.alias("n_hit"), F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ",").cast("binary"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )


def brute(docs: list[tuple[object, str | None]], items: list[tuple[object, str | None]], window: int = WINDOW) -> dict:
    """The contract, spelled out on small lists, for tests: doc_id to (words, hit words, items, digest)."""
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    wins: dict[tuple, set] = {}
    for i, t in items:
        w = split(t)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            wins.setdefault(tuple(w[k : k + window]), set()).add(str(i))
    out = {}
    for d, t in docs:
        w, hit, ids = split(t), set(), set()
        for n in {len(x) for x in wins}:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k : k + n])) in wins:
                    hit |= set(range(k, k + n))
                    ids |= wins[x]
        out[d] = (len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest())
    return out
