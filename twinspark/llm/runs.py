"""Periodic runs of words, found with a dictionary of basic factors.

A run is a stretch of consecutive words with smallest period q (words q apart are the same) that no
neighbouring word extends, of at least ``LEAST`` words and ``TIMES`` periods. The dictionary numbers, for each
power of two L, the stretches of L words of a text: equal stretches have equal numbers, and the numbers of
length 2L come from pairs of numbers of length L. Where the next occurrence of the stretch at a place
is d <= 2L words on, and the same holds for the places after it, the occurrences are arithmetic progressions of
step d, and d is proposed as a period. In a run of period q, with L the power of two from q up to 2q, the next occurrence of
a stretch is exactly q on (a nearer one would give the run a smaller period, by Fine and Wilf), for
at least q + 2 places in a row; so places with fewer in a row propose nothing and no run is lost. A
proposal is extended word by word to both sides; equal proposals are one run. A period found so is the smallest
one, as a smaller one would have been the next occurrence.

Only places whose stretch comes again in their text, in texts long enough for the next length, go on to it, so
that ordinary prose ends after a few lengths. Texts are taken together up to ``WORDS`` words; a longer one goes alone. No row moves.

Edge cases: a null text and a text without words have no runs and collapse to ''; null and repeated ids
come back as often as they are; an empty table gives an empty result; other columns, whatever their
names, don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST, TIMES = 6, 4  #: words and periods that a run has at least
WORDS = 1 << 18  #: words that are numbered together
RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def progressions(at: np.ndarray, number: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places (ascending) and the numbers of their stretches of ``span`` words to proposals (first place, places in a row, step), and which stretches come again."""
    order = np.argsort(number, kind="stable")
    same = number[order[1:]] == number[order[:-1]]
    step = np.zeros(len(at), np.int64)
    step[order[:-1][same]] = at[order[1:][same]] - at[order[:-1][same]]
    again = np.zeros(len(at), bool)
    again[order[:-1][same]] = True
    again[order[1:][same]] = True
    near = np.flatnonzero((step > 0) & (step <= 2 * span))
    if not len(near):
        return near, near, near, again
    place, step = at[near], step[near]
    first = np.flatnonzero(np.r_[True, (place[1:] != place[:-1] + 1) | (step[1:] != step[:-1])])
    many = np.diff(np.r_[first, len(near)])
    keep = many >= step[first] + 2
    return place[first][keep], many[keep], step[first][keep], again


def _equal(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading elements are equal; looks in windows that double."""
    n, at, size = min(len(a), len(b)), 0, 64
    while at < n:
        differ = np.flatnonzero(a[at : at + size][: n - at] != b[at : at + size][: n - at])
        if len(differ):
            return at + int(differ[0])
        at, size = at + size, 2 * size
    return n


def find_runs(words: np.ndarray, size: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """Word numbers of texts, one text after another, and the number of words of each, to the runs (start, length, period) of each."""
    last = np.cumsum(size)
    text = np.repeat(np.arange(len(size)), size)
    found: list[set[tuple[int, int, int]]] = [set() for _ in size]
    at = np.flatnonzero(size[text] >= LEAST)
    number = np.unique(text[at] * (int(words.max(initial=0)) + 1) + words[at], return_inverse=True)[1] if len(at) else at
    known, span = np.full(len(words), -1, np.int64), 1
    while len(at):
        firsts, many, steps, again = progressions(at, number, span)
        for first, n, d in zip(firsts.tolist(), many.tolist(), steps.tolist(), strict=True):
            i = int(text[first])
            low, high = int(last[i] - size[i]), int(last[i])
            stop = first + n - 1 + span + d
            stop += _equal(words[stop:high], words[stop - d : high - d])
            begin = first - _equal(words[low:first][::-1], words[low + d : first + d][::-1])
            if stop - begin >= max(LEAST, TIMES * d):
                found[i].add((begin - low, stop - begin, d))
        # stretches of twice the length, of places where both halves come again
        known[at] = -1
        at, number = at[again], number[again]
        known[at] = number
        fits = (at + 2 * span <= last[text[at]]) & (size[text[at]] > TIMES * span)
        left = at[fits]
        left = left[known[left + span] >= 0]
        key = known[left] * (len(words) + 1) + known[left + span]
        known[at] = -1
        at, number, span = left, np.unique(key, return_inverse=True)[1], 2 * span
    return [sorted(x, key=lambda r: (r[0], r[2])) for x in found]


def stays(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Whether each of n words stays: those do not that a run contains after its first period."""
    edge = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:-1]) == 0


def runs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, collapsed): the runs of each text by start and then period, and its words but those that a run contains after its first period, joined by one space."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_words", "runs", "collapsed"]

    def some(ids: pa.Array, texts: list[list[bytes]]) -> pa.RecordBatch:
        number: dict[bytes, int] = {}
        size = np.array([len(w) for w in texts], np.int64)
        words = np.fromiter((number.setdefault(w, len(number)) for t in texts for w in t), np.int64, int(size.sum()))
        found = find_runs(words, size)
        kept = [t if not own else [w for w, ok in zip(t, stays(len(t), own), strict=True) if ok] for t, own in zip(texts, found, strict=True)]
        told = [[{"start": s, "length": n, "period": d} for s, n, d in own] for own in found]
        text = pa.array([b" ".join(t) for t in kept], pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([ids, pa.array(size), pa.array(told, RUNS), text], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held: list[list[bytes]] = []
            first = n = 0
            for i, text in enumerate(b.column(1)):
                own = (text.as_py() or "").encode().split()
                if held and n + len(own) > WORDS:
                    yield some(b.column(0)[first:i], held)
                    held, first, n = [], i, 0
                held.append(own)
                n += len(own)
            if held:
                yield some(b.column(0)[first:], held)

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text): every tenth text, by the checksum h of its id (null: ''), goes on from a word on with the words from there to a period's end, as the query's contract has it."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    rows = docs.select("doc_id", "text", h.alias("h")).withColumn("g", F.floor(F.col("h") / 10))
    rows = rows.withColumn("words", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))))
    rows = rows.withColumn("n", F.when(F.size("words") > 0, F.size("words"))).withColumn("a", (F.col("g") % F.col("n")).cast("int"))
    rows = rows.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    block = F.slice("words", F.col("a") + 1, F.col("p"))
    tail = F.slice(F.flatten(F.array_repeat(block, F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int"))), F.lit(1), F.col("n") - F.col("a"))
    text = F.concat_ws(" ", F.slice("words", F.lit(1), F.col("a")), tail)
    return rows.select("doc_id", F.when(F.col("n").isNotNull(), text).otherwise(F.col("text")).alias("text"))


def op12(spark, sf_dir: str) -> DataFrame:
    from twinspark.llm.common import read

    found = runs(planted(read(spark, sf_dir, "documents")))
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))))
    text = F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "")
    length = -F.col("best.less")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(text, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", F.col("best.start").alias("start"), length.alias("length"), F.col("best.period").alias("period"),
        F.floor(1000 * length / F.col("best.period")).cast("long").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )


def brute(words: list) -> list[tuple[int, int, int]]:
    """The definition, for tests: all runs (start, length, period) of a list of words."""
    n, out = len(words), []
    for q in range(1, n // TIMES + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(LEAST, TIMES * q):
                own = words[i : j + q]
                if not any(all(own[x] == own[x + d] for x in range(len(own) - d)) for d in range(1, q)):
                    out.append((i, j + q - i, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))
