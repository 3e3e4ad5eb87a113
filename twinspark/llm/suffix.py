"""Removal of repeated byte strings by longest-previous-factor arrays.

A string of ``length`` bytes that starts in two places has the same smallest hash among its
200-byte pieces in both, so only places whose smallest hash occurs in two pieces of the corpus can be
repeats (an exact filter; the hashes go round, not the texts). What is left is cut into stretches of
starting places that share that hash. Stretches of a hash meet in one task (trimmed there to
starts whose whole string has a hash that comes twice, again an exact filter), where their suffixes are
sorted to ``length`` bytes; the previous smaller and next smaller place in suffix order give each
place its longest previous factor, and the mirrored pair its longest next one. The stretches of a
very common hash are no task's work. A row for each stretch is sorted by what follows the 200-byte piece
that has the hash, and by what precedes it, backwards; neighbours there show how far a stretch agrees with any other
to either side, and strings that reach further can't be repeats (exact again). Starts whose string comes again in
their own stretch stay. Equal runs of the starts that are left are counted as one before they move: what is left of a passage that
many texts share are its few different runs, which meet in suffix order like any other stretches. Exact copies of a text are handled as one.

``keep='first'`` removes later copies only (texts in order of their smallest doc_id, then by place);
``keep='none'`` removes each copy.

Edge cases: a null text counts as empty, texts shorter than ``length`` lose nothing; null ids sort
first; repeated rows are copies of one another (with ``keep='first'`` all rows of the smallest id
stay); an empty table gives an empty result; ids may be numbers or strings; other columns, whatever
their names, pass through ``clean``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from twinspark.shared import table

LENGTH = 400
HOT_BYTES = 4 << 20  #: bytes of a hash's stretches from which on they are cut and counted before they meet; with BATCH, what a task holds at most
BATCH = 1 << 20  #: bytes that are sorted at once
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_M64 = (1 << 64) - 1


@cache
def _power_block(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out, dtype=np.uint64)


def _powers(base: int, n: int) -> np.ndarray:
    return _power_block(base, max(1 << 16, 1 << (n - 1).bit_length()))[:n]


def window_hash(data: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each k bytes in a row."""
    base = _BASES[seed]
    n = len(data)
    with np.errstate(over="ignore"):
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(base, n), out=total[1:])
        h = (total[k:] - total[:-k]) * _powers(pow(base, -1, 1 << 64), n - k + 1)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
    return h


def sliding_min(h: np.ndarray, w: int) -> np.ndarray:
    size, n = 1, len(h)
    while size * 2 <= w:
        h = np.minimum(h[:-size], h[size:])
        size *= 2
    return np.minimum(h[: n - w + 1], h[w - size : w - size + n - w + 1])


def least_hashes(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the pieces of half the length, and the smallest one of each string of ``length`` bytes."""
    k = length // 2
    h = window_hash(data, k)
    return h, sliding_min(h, length - k + 1)


def _eights(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place, and from the end, as numbers; zeros follow the last byte."""
    key = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    for k in (1, 2, 4):
        key = (key[:-k] << np.uint64(8 * k)) | key[k:]
    return key


def suffix_order(data: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """``starts`` in order of the ``depth`` bytes from there, and ranks of all places by their first 8, 24, ... bytes.

    A round joins the ranks of three neighbouring pieces in one number if they fit, else of two.
    """
    n = len(data)
    key, levels, k = _eights(data)[:n], [], min(8, depth)
    while True:
        order = np.argsort(key)
        key = key[order]
        rank = np.empty(n, np.int32)
        rank[order] = np.concatenate([np.zeros(1, np.int32), np.cumsum(key[1:] != key[:-1], dtype=np.int32)])
        levels.append((k, rank))
        if k >= depth:
            break
        width = int(rank[order[-1]]) + 2
        parts = 3 if 2 * k < depth and width**3 < 1 << 63 else 2
        key = rank.astype(np.int64)
        for j in range(1, parts):
            step = min(j * k, depth - k)
            key *= width
            key[:-step] += rank[step:] + 1
        k = min(depth, parts * k)
    wanted = np.zeros(n, bool)
    wanted[starts] = True
    return order[wanted[order]], levels


def adjacent_lcp(data: np.ndarray, order: np.ndarray, levels: list[tuple[int, np.ndarray]]) -> np.ndarray:
    """Common bytes, up to the depth, of each suffix with the one before it in order (0 for the first)."""
    depth, last = levels[-1]
    out = np.full(len(order), depth, np.int64)
    out[:1] = 0
    differ = np.flatnonzero(last[order[1:]] != last[order[:-1]])
    a, b = order[differ], order[differ + 1]
    same = np.zeros(len(differ), np.int64)
    for (k, rank), (longer, _) in zip(levels[-2::-1], levels[:0:-1], strict=True):
        for _ in range(-(-longer // k) - 1):
            i, j = np.minimum(a + same, len(data) - 1), np.minimum(b + same, len(data) - 1)
            same += np.where(rank[i] == rank[j], k, 0)
    key = _eights(data)
    x = key[np.minimum(a + same, len(data))] ^ key[np.minimum(b + same, len(data))]
    for k in range(1, 8):
        same += x < np.uint64(1 << (64 - 8 * k))
    out[differ + 1] = np.minimum(same, depth)
    return out


def _previous(place: np.ndarray, lcp: np.ndarray, least: int) -> np.ndarray:
    """Common prefix of each suffix with the nearest before it, in suffix order, of a smaller place; by pointer jumping."""
    n = len(place)
    to, common = np.arange(n) - 1, lcp.copy()
    open_ = np.arange(n)
    while len(open_):
        open_ = open_[to[open_] >= 0]
        open_ = open_[(place[to[open_]] > place[open_]) & (common[open_] >= least)]
        via = to[open_]
        common[open_], to[open_] = np.minimum(common[open_], common[via]), to[via]
    return np.where((to >= 0) & (common >= least), common, 0)


def previous_factors(place: np.ndarray, lcp: np.ndarray, least: int = 1) -> np.ndarray:
    """Longest previous factor (to the depth of ``lcp``) of each suffix, 0 for those below ``least``; ``place`` and ``lcp`` in suffix order."""
    up = _previous(place, lcp, least)
    down = _previous(place[::-1], np.r_[0, lcp[1:][::-1]], least)[::-1]
    return np.maximum(up, down)


def _stretches(data: np.ndarray, length: int, values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(first, last start, number in ``values``) of stretches of starts whose smallest hash is one of ``values``."""
    _, least = least_hashes(data, length)
    first = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
    last = np.r_[first[1:], len(least)] - 1
    at = np.minimum(np.searchsorted(values, least[first]), len(values) - 1)
    for i in np.flatnonzero(values[at] == least[first]).tolist():
        yield int(first[i]), int(last[i]), int(at[i])


def _anchored(pieces: np.ndarray, wholes: np.ndarray, first: int, last: int, value: np.uint64, length: int) -> list[tuple[int, int, int, bool]]:
    """(at, x, y, checked): runs x to y of the starts of a stretch. Those whose string comes again in the stretch have ``at`` -1.
    All others have for ``at`` the first piece from there that has the value, and so have, once more and not to be checked, the first start of each string that comes again: others may be like it."""
    h = wholes[first : last + 1]
    _, lead, which, times = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
    starts, again = np.arange(first, last + 1), times[which] > 1
    places = first + np.flatnonzero(pieces[first : last + 1 + length - length // 2] == value)
    at = places[np.searchsorted(places, starts)]
    one = np.zeros(len(h), bool)
    one[lead] = True

    def runs(some: np.ndarray, key: np.ndarray, checked: bool) -> list[tuple[int, int, int, bool]]:
        i = np.flatnonzero(some)
        new = np.flatnonzero((np.diff(i) > 1) | (np.diff(key[i]) != 0)) + 1
        x, y = i[np.r_[0, new]] if len(i) else i, i[np.r_[new - 1, len(i) - 1]] if len(i) else i
        return [(k, first + p, first + q, checked) for k, p, q in zip(key[x].tolist(), x.tolist(), y.tolist(), strict=True)]

    return runs(again, np.full(len(h), -1), True) + runs(~again, at, True) + runs(one & again, at, False)


def _common_bytes(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    x, y = np.frombuffer(a, np.uint8, n), np.frombuffer(b, np.uint8, n)
    return int(np.argmax(x != y))


def _hash_rows(docs: DataFrame, length: int) -> DataFrame:
    """(value, a, b, m): the smallest hashes of a text; twice the number of starts that have it, one more if more than one piece has it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vs, ms, sizes = [], [], []
            for text in b.column(2).to_pylist():
                h, least = least_hashes(np.frombuffer(text, np.uint8), length)
                v, starts = np.unique(least, return_counts=True)
                some = h[h <= v[-1]]
                at = np.searchsorted(v, some)
                n = np.bincount(at[v[at] == some], minlength=len(v))
                vs.append(v.view(np.int64))
                ms.append(2 * starts + (n > 1))
                sizes.append(len(v))
            if vs:
                each = [np.repeat(b.column(i).to_numpy(), sizes) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(vs)), *map(pa.array, each), pa.array(np.concatenate(ms).astype(np.int64))], ["value", "a", "b", "m"])

    return docs.mapInArrow(run, "value long, a long, b long, m long")


def _repeated(texts: DataFrame, length: int, keep: str) -> DataFrame:
    """(a, b, text, first) to (a, b, spans): merged removed ranges (start, end) of each text that has any; and the text."""
    rows = _hash_rows(texts.select("a", "b", "text"), length)
    # two texts have the value, or one text has it twice
    values = rows.groupBy("value").agg(
        F.min("a").alias("a0"), F.max("a").alias("a1"), F.min("b").alias("b0"), F.max("b").alias("b1"),
        F.max(F.col("m").bitwiseAND(1)).alias("twice"), F.sum(F.shiftright("m", 1) + length).alias("bytes"),
    )
    values = table(values.where("a0 <> a1 or b0 <> b1 or twice = 1").select("value", (F.col("bytes") > HOT_BYTES).alias("hot")), "values")
    own = rows.join(values, "value").groupBy("a", "b").agg(F.collect_set(F.struct("value", "hot")).alias("values"))
    one = texts.groupBy("a", "b").agg(F.first("text").alias("text"), F.min("first").alias("first"))
    marked = table(one.join(own, ["a", "b"]), "marked")
    id_ = texts.schema["first"].dataType
    arrow_id = to_arrow_type(id_)
    stretch = pa.schema([("value", pa.int64()), ("at", pa.int32()), ("first", arrow_id), ("a", pa.int64()), ("b", pa.int64()), ("start", pa.int32()), ("bytes", pa.binary()), ("left", pa.binary()), ("right", pa.binary())])
    half = length // 2

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for a stretch, with its bytes. Those of a hot value come in parts (see ``_anchored``), with what precedes the piece ``at``, backwards, and follows it."""
        for batch in batches:
            for a, b, text, first, values in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                data = np.frombuffer(text, np.uint8)
                pairs = sorted((x["value"] & _M64, x["hot"]) for x in values)
                v = np.array([x[0] for x in pairs], np.uint64)
                keys, rows, pieces, wholes = v.view(np.int64).tolist(), [], None, None
                for p, q, i in _stretches(data, length, v):
                    if not pairs[i][1]:
                        rows.append((keys[i], None, p, text[p : q + length], None, None))
                        continue
                    if pieces is None:
                        pieces, wholes = window_hash(data, half), window_hash(data, length)
                    for at, x, y, checked in _anchored(pieces, wholes, p, q, v[i], length):
                        sides = (None, None) if at < 0 else (text[x:at][::-1], text[at + half : y + length])
                        rows.append((keys[i], at, x, text[x : y + length] if checked else None, *sides))
                if rows:
                    value, at, start, own, left, right = zip(*rows, strict=True)
                    n = len(rows)
                    yield pa.RecordBatch.from_arrays([pa.array(value, pa.int64()), pa.array(at, pa.int32()), pa.array([first] * n, arrow_id), pa.array([a] * n, pa.int64()), pa.array([b] * n, pa.int64()), pa.array(start, pa.int32()), *(pa.array(x, pa.binary()) for x in (own, left, right))], schema=stretch)

    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(value, side, key, a, b, at), sorted, to how many bytes of its key each row shares with any other of its value and side.

        Neighbours share most. The first and the last row of a task may have theirs in another: they count as shared throughout."""
        was, shared = None, 0
        for batch in batches:
            out = []
            for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if was is None:
                    shared = len(r[2])
                else:
                    n = _common_bytes(was[2], r[2]) if was[:2] == r[:2] else 0
                    out.append((*was[3:6], was[0], was[1], max(shared, n)))
                    shared = n
                was = r
            if out:
                yield pa.RecordBatch.from_arrays([*map(pa.array, zip(*out, strict=True))], ["a", "b", "at", "value", "side", "shared"]).cast(agreed)
        if was is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*was[3:6], was[0], was[1], len(was[2]))], ["a", "b", "at", "value", "side", "shared"]).cast(agreed)

    agreed = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("at", pa.int32()), ("value", pa.int64()), ("side", pa.int32()), ("shared", pa.int32())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def gathered(rows: list[tuple]) -> tuple[np.ndarray, ...]:
            data = np.frombuffer(b"".join(r[5] for r in rows), np.uint8)
            sizes = np.array([len(r[5]) for r in rows])
            offset = np.cumsum(sizes) - sizes
            ns = sizes - length + 1
            piece = np.repeat(np.arange(len(rows)), ns)
            starts = np.arange(ns.sum()) - np.repeat(np.cumsum(ns) - ns, ns) + np.repeat(offset, ns)
            return data, sizes, offset, piece, starts

        def trimmed(rows: list[tuple]) -> list[tuple]:
            """Stretches cut to their first and last start whose string's hash comes twice here; the rest can't be repeats."""
            data, _, offset, piece, starts = gathered(rows)
            h = window_hash(data, length)[starts]
            order = np.argsort(h)
            same = h[order][1:] == h[order][:-1]
            twice = np.sort(order[np.r_[False, same] | np.r_[same, False]])
            if not len(twice):
                return []
            p, first = np.unique(piece[twice], return_index=True)
            last = np.r_[first[1:], len(twice)] - 1
            out = []
            for i, x, y in zip(p.tolist(), starts[twice[first]].tolist(), starts[twice[last]].tolist(), strict=True):
                r, x, y = rows[i], x - int(offset[i]), y - int(offset[i])
                out.append((*r[:4], r[4] + x, r[5][x : y + length]))
            return out

        def flush(rows: list[tuple]) -> pa.RecordBatch:
            rows = trimmed(rows)
            if not rows:
                return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 4, ["a", "b", "start", "stop"])
            data, sizes, offset, piece, starts = gathered(rows)
            # places in the order of texts; the same place never comes twice
            rank = sorted(range(len(rows)), key=lambda i: (rows[i][1] is not None, rows[i][1] or type(rows[i][1])(), *rows[i][2:5]))
            turn = np.empty(len(rows), np.int64)
            turn[rank] = np.arange(len(rows))
            order, levels = suffix_order(data, starts, length)
            lcp = adjacent_lcp(data, order, levels)
            number = np.empty(len(data), np.int32)
            number[starts] = np.arange(len(starts))
            at = piece[number[order]]
            place = turn[at] * (int(sizes.max()) + 1) + order - offset[at]
            factor = previous_factors(place, lcp, length)
            if keep == "none":
                factor = np.maximum(factor, previous_factors(-place, lcp, length))
            gone = np.zeros(len(starts) + 1, np.int8)
            gone[number[order[factor >= length]]] = 1
            edge = np.flatnonzero(np.diff(np.r_[0, gone].astype(np.int8)) | np.r_[True, piece[1:] != piece[:-1], False] & (gone == 1))
            edge = edge[gone[edge] == 1]
            ends = np.r_[edge[1:], len(starts)]
            run = np.cumsum(1 - gone.astype(np.int64))
            stop = np.searchsorted(run, run[edge] + 1)  # the first start after it that stays
            stop = np.minimum(stop, ends)
            p = piece[edge]
            start = np.array([r[4] for r in rows])[p] + starts[edge] - offset[p]
            return pa.RecordBatch.from_arrays([pa.array([rows[i][2] for i in p], pa.int64()), pa.array([rows[i][3] for i in p], pa.int64()), pa.array(start), pa.array(start + (stop - edge) - 1 + length)], ["a", "b", "start", "stop"])

        last = None
        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size >= BATCH and r[0] != last:
                    yield flush(held)
                    held, size = [], 0
                last = r[0]
                held.append(r)
                size += len(r[5])
        if held:
            yield flush(held)

    parts = table(marked.select("a", "b", "text", "first", "values").mapInArrow(cut, f"value long, at int, first {id_.simpleString()}, a long, b long, start int, bytes binary, left binary, right binary"), "stretches")
    cols = ["value", "first", "a", "b", "start", "bytes"]
    meet, again = parts.where("at is null").select(cols), None
    if not values.where("hot").isEmpty():
        hot = parts.where("at >= 0")
        sides = [hot.select("value", F.lit(i).alias("side"), F.col(c).alias("key"), "a", "b", "at") for i, c in enumerate(("left", "right"))]
        order = ["value", "side", "key", "a", "b", "at"]
        shared = sides[0].unionByName(sides[1]).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(agree, "a long, b long, at int, value long, side int, shared int")
        reach = shared.groupBy("a", "b", "at", "value").agg(F.max(F.when(F.col("side") == 0, F.col("shared"))).alias("l"), F.max(F.when(F.col("side") == 1, F.col("shared"))).alias("r"))
        # a string with n bytes before the piece has the other half less n after it
        x = F.greatest(F.col("start"), F.col("at") - F.col("l"))
        y = F.least(F.col("start") + F.length("bytes") - length, F.col("at") + F.col("r") - (length - half))
        some = hot.where("bytes is not null").join(reach.where(F.col("l") + F.col("r") >= length - half), ["a", "b", "at", "value"]).withColumn("x", x).withColumn("y", y).where("x <= y")
        some = some.select("value", "first", "a", "b", F.col("x").alias("start"), F.substr("bytes", F.col("x") - F.col("start") + 1, F.col("y") - F.col("x") + length).alias("bytes"))
        found = table(some.unionByName(parts.where("at < 0").select(cols)), "runs")
        place = F.struct("first", "a", "b", "start")
        each = table(found.groupBy("value", "bytes").agg(F.min(place).alias("least"), F.count("*").alias("copies")), "distinct-runs")
        meet = meet.unionByName(each.select("value", "least.*", "bytes").select(cols))
        again = found.join(each.where("copies > 1"), ["value", "bytes"]).where(F.lit(True) if keep == "none" else place != F.col("least"))
        again = again.select("a", "b", F.col("start").cast("long").alias("start"), (F.col("start") + F.length("bytes")).cast("long").alias("stop"))
    out = meet.repartition("value").sortWithinPartitions("value").mapInArrow(compare, "a long, b long, start long, stop long")
    out = out if again is None else out.unionByName(again)
    spans = out.groupBy("a", "b").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    return marked.select("a", "b", "text").join(spans, ["a", "b"])


def _kept(cleaned: DataFrame) -> DataFrame:
    """(a, b, text, spans) to (a, b, spans, kept): merged spans and the bytes that stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans, kept = [], []
            for text, own in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                merged: list[list[int]] = []
                for s, e in sorted((x["start"], x["stop"]) for x in own):
                    if merged and s <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], e)
                    else:
                        merged.append([s, e])
                edges = [0, *(x for m in merged for x in m), len(text)]
                spans.append([{"start": s, "stop": e} for s, e in merged])
                kept.append(b"".join(text[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), pa.array(kept, pa.binary())], ["a", "b", "spans", "kept"])

    return cleaned.mapInArrow(run, "a long, b long, spans array<struct<start:long,stop:long>>, kept binary")


def repeats(docs: DataFrame, length: int = LENGTH, keep: str = "first") -> tuple[DataFrame, DataFrame]:
    """Two tables: (doc_id, a, b, n_bytes, digest, gone) of each row, where (a, b) names its text and ``gone`` says that
    all of it is removed; and (a, b, spans, kept) of each text of which a part is removed."""
    text = F.coalesce(F.col("text"), F.lit(""))
    named = docs.select("doc_id", text.cast("binary").alias("text"), F.xxhash64(text).alias("a"), F.xxhash64(F.lit(7), text).alias("b"))
    rows = table(named.select("doc_id", "a", "b", F.length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("digest")), "texts")
    copies = rows.groupBy("a", "b").agg(F.count("*").alias("copies"), F.min(F.struct("doc_id")).alias("first"))
    again = (F.col("copies") > 1) if keep == "none" else ~F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
    out = rows.join(copies, ["a", "b"]).withColumn("gone", (F.col("n_bytes") >= length) & again)
    found = _repeated(named.where(F.length("text") >= length).withColumnRenamed("doc_id", "first"), length, keep)
    return out.drop("copies", "first"), _kept(found)


def clean(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with later copies cut out of ``text`` (bytes that no longer form a character become U+FFFD)."""
    _, parts = repeats(docs.select("doc_id", "text"), length, "first")
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select(F.struct("*").alias("doc"), F.xxhash64(text).alias("a"), F.xxhash64(F.lit(7), text).alias("b"))
    copies = keyed.groupBy("a", "b").agg(F.min(F.struct("doc.doc_id")).alias("first"))
    out = keyed.join(copies, ["a", "b"]).join(parts.select("a", "b", F.decode("kept", "utf-8").alias("kept")), ["a", "b"], "left")
    later = (F.octet_length("doc.text") >= length) & ~F.col("doc.doc_id").eqNullSafe(F.col("first.doc_id"))
    text = F.when(later, "").otherwise(F.coalesce("kept", "doc.text")).alias("text")
    return out.select(*[text if c == "text" else F.col("doc")[c].alias(c) for c in docs.columns])


def op6(spark, sf_dir: str) -> DataFrame:
    from twinspark.llm.common import read

    rows, parts = repeats(read(spark, sf_dir, "documents").select("doc_id", "text"), LENGTH, "none")
    parts = parts.select("a", "b", F.size("spans").cast("long").alias("s"), F.length("kept").cast("long").alias("k"), F.sha2("kept", 256).alias("d"))
    zero = F.lit(0).cast("long")
    return rows.join(parts, ["a", "b"], "left").select(
        "doc_id", "n_bytes",
        F.when(F.col("gone"), F.col("n_bytes")).otherwise(F.coalesce(F.col("n_bytes") - F.col("k"), zero)).alias("n_removed"),
        F.when(F.col("gone"), zero + 1).otherwise(F.coalesce("s", zero)).alias("n_spans"),
        F.when(F.col("gone"), F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("d", "digest")).alias("kept_sha256"),
    )


def brute(texts: list[tuple[object, str | None]], length: int, keep: str = "none") -> dict:
    """The contract on a small list, for tests."""
    seen: dict[bytes, list[tuple[int, int]]] = {}
    raw = [(t or "").encode() for _, t in texts]
    for i, t in enumerate(raw):
        for p in range(len(t) - length + 1):
            seen.setdefault(t[p : p + length], []).append((i, p))
    mark = [bytearray(len(t)) for t in raw]
    for places in seen.values():
        if len(places) > 1:
            for i, p in places if keep == "none" else places[1:]:
                mark[i][p : p + length] = b"\1" * length
    out = {}
    for (d, _), t, m in zip(texts, raw, mark, strict=True):
        spans = sum(x == 1 and (j == 0 or m[j - 1] == 0) for j, x in enumerate(m))
        out[d] = (len(t), sum(m), spans, hashlib.sha256(bytes(c for c, x in zip(t, m, strict=True) if not x)).hexdigest())
    return out
