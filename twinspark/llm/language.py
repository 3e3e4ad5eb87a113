"""Language identification of words by a linear-chain conditional random field.

A word's potentials are sums of learned weights of its prefixes, suffixes, letter bigrams and
trigrams, and of the word itself (its lexicon entry), all hashed to a fixed number of weights; learned
transitions tie neighbours, so that single words of another language don't flip, while switches of
code do. Forward-backward gives each word the probability of each language; a text's language is the
one with the most expected words.

Training takes a bounded sample of labelled rows: about ``SAMPLE`` texts of each language, or ``TEXTS``
in all if there are very many languages, chosen by a hash of the id. Of each some windows at random places
are cut where the text is, half of them later spliced from two languages so that the transitions see
switches. Every language is learned. Prediction reads whole texts, in chains of ``CHAIN`` words.

Edge cases: letters are those of Unicode's letter categories; null texts and texts without letters are ``und`` with score 0; rows without a language
are not learned from; without any labelled row every text is ``und``; repeated rows and null ids are
kept; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinspark.llm.common import crc_mod

SAMPLE = 300  #: texts of a language that are learned from
TEXTS = 6_000  #: texts that are learned from, of all languages
WINDOWS = 6  #: windows of a text that are learned from
CHAIN = 48  #: words of a chain
WEIGHTS = 1 << 17  #: of a language; fewer if all would be over TABLE
TABLE = 1 << 25
BATCH = 1 << 16  #: windows times languages at once in training
CACHE = 400_000  #: words whose potentials a worker keeps
ROUNDS = 40
SEED = 11
_ODD = frozenset(c for c in map(chr, range(sys.maxunicode + 1)) if c.isalnum() and not c.isalpha() and not c.isdecimal())  # numbers that aren't digits
_NO_ODD = dict.fromkeys(map(ord, _ODD), " ")
_WORDS = re.compile(r"[^\W\d_]+")


def split(text: str | None) -> list[str]:
    low = (text or "").lower()
    if not (low.isascii() or _ODD.isdisjoint(low)):
        low = low.translate(_NO_ODD)
    return _WORDS.findall(low)


def word_features(words: list[str], weights: int = WEIGHTS) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the weights (of so many) of all words, and the word that each belongs to.

    The UTF-8 form is put in <>, so that byte n-grams of two to four also are affixes.
    """
    marked = [f"<{w}>".encode() for w in words]
    size = np.fromiter(map(len, marked), np.int64, len(marked))
    data = np.frombuffer(b"".join(marked), np.uint8).astype(np.uint64)
    begin = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(words)), size)
    left = np.repeat(begin + size, size) - np.arange(len(data))  # bytes up to the word's end
    flat, owners = [], []
    with np.errstate(over="ignore"):
        h = data + np.uint64(1)
        for n in (2, 3, 4):
            h = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + data[n - 1 :] + np.uint64(n)
            ok = left[: len(h)] >= n
            flat.append(h[ok] >> np.uint64(40))
            owners.append(owner[: len(h)][ok])
        place = np.arange(len(data)) - np.repeat(begin, size)
        powers = np.cumprod(np.full(int(size.max(initial=1)), 0xC2B2AE3D27D4EB4F, np.uint64), dtype=np.uint64)
        whole = np.add.reduceat(data * powers[place], begin)
        flat.append((whole ^ (whole >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40))
        owners.append(np.arange(len(words)))
    return (np.concatenate(flat) % np.uint64(weights)).astype(np.int64), np.concatenate(owners)


def potentials(weights: np.ndarray, flat: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Sum of the weights of each of n words, in each language."""
    return np.stack([np.bincount(owner, weights[flat, j], n) for j in range(weights.shape[1])], 1).astype(np.float32)


def forward_backward(e: np.ndarray, trans: np.ndarray, start: np.ndarray, there: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marginals (B, T, K), expected transitions (K, K) and log partition (B) of B chains; ``there`` (B, T) marks words, not padding."""
    b, t, k = e.shape
    top = e.max(axis=2, keepdims=True)
    p = np.exp(e - top)
    a = np.exp(trans)
    alpha, scale = np.empty((t, b, k), p.dtype), np.ones((t, b, 1), p.dtype)
    x = p[:, 0] * np.exp(start)
    for i in range(t):
        if i:
            x = (alpha[i - 1] @ a) * p[:, i]
        s = x.sum(axis=1, keepdims=True)
        on = there[:, i, None]
        alpha[i] = np.where(on, x / s, alpha[i - 1] if i else x / s)
        scale[i] = np.where(on, s, 1)
    beta = np.ones((b, k), p.dtype)
    out, pairs = np.empty((b, t, k), p.dtype), np.zeros((k, k))
    for i in range(t - 1, -1, -1):
        m = alpha[i] * beta
        out[:, i] = m / m.sum(axis=1, keepdims=True)
        if i:
            on = there[:, i, None]
            after = p[:, i] * beta / scale[i]
            pairs += a * (alpha[i - 1].T @ np.where(on, after, 0))
            beta = np.where(on, after @ a.T, beta)
    return out, pairs, np.log(scale[:, :, 0].T).sum(1) + np.where(there, top[:, :, 0], 0).sum(1)


class Crf:
    """Learned weights; pickled to the workers, some megabytes whatever the corpus."""

    def __init__(self, langs: list[str]):
        k = len(langs)
        self.langs = langs
        size = WEIGHTS
        while size > 4096 and size * k > TABLE:
            size //= 2
        self.w = np.zeros((size, k), np.float32)
        self.trans = np.zeros((k, k), np.float32)
        self.start = np.zeros(k, np.float32)

    def fit(self, windows: list[tuple[str, list[str]]]) -> Crf:
        """(language, words) by Adam on the likelihood of windows."""
        rng = np.random.default_rng(SEED)
        k, number = len(self.langs), {x: i for i, x in enumerate(self.langs)}
        ids: dict[str, int] = {}
        pieces = []
        for lang, words in windows:
            part = [ids.setdefault(w, len(ids)) for w in words[:CHAIN]]
            if part:
                pieces.append((part, [number[lang]] * len(part)))
        if not pieces:
            return self
        pieces = [pieces[i] for i in rng.permutation(len(pieces))]
        other = rng.permutation(len(pieces))
        for i in range(0, len(pieces) - 1, 2):  # splices
            (x, y), (u, v) = pieces[i], pieces[int(other[i])]
            c = int(rng.integers(1, CHAIN))
            pieces[i] = ((x[:c] + u)[:CHAIN], (y[:c] + v)[:CHAIN])
        n = len(pieces)
        x, y, there = np.zeros((n, CHAIN), np.int64), np.zeros((n, CHAIN), np.int64), np.zeros((n, CHAIN), bool)
        for i, (a, b) in enumerate(pieces):
            x[i, : len(a)], y[i, : len(a)], there[i, : len(a)] = a, b, True
        flat, owner = word_features(list(ids), len(self.w))
        used, flat = np.unique(flat, return_inverse=True)
        both = there[:, 1:] & there[:, :-1]
        pairs_gold = np.zeros((k, k))
        np.add.at(pairs_gold, (y[:, :-1][both], y[:, 1:][both]), 1)
        theta = [np.zeros((len(used), k), np.float32), self.trans.copy(), self.start.copy()]
        m, v = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta]
        words, batch = max(1, int(there.sum())), max(256, BATCH // k)
        for step in range(1, ROUNDS + 1):
            e = potentials(theta[0], flat, owner, len(ids))
            word, pairs, first = np.zeros((len(ids), k)), np.zeros((k, k)), np.zeros(k)
            for b in range(0, n, batch):
                xb, on = x[b : b + batch], there[b : b + batch]
                diff, own, _ = forward_backward(e[xb], theta[1], theta[2], on)
                pairs += own
                diff *= np.where(on, -1, 0).astype(diff.dtype)[:, :, None]
                np.put_along_axis(diff, y[b : b + batch, :, None], np.take_along_axis(diff, y[b : b + batch, :, None], 2) + on[:, :, None], 2)
                first += diff[:, 0].sum(0)
                word += np.stack([np.bincount(xb.ravel(), diff[:, :, j].ravel(), len(ids)) for j in range(k)], 1)
            grad = [
                np.stack([np.bincount(flat, word[owner, j], len(used)) for j in range(k)], 1) / words - 1e-6 * theta[0],
                (pairs_gold - pairs) / words - 1e-4 * theta[1],
                first / words - 1e-4 * theta[2],
            ]
            for i, g in enumerate(grad):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.98 * v[i] + 0.02 * g * g
                theta[i] = (theta[i] + 0.15 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.98**step)) + 1e-7)).astype(np.float32)
        self.w[used], self.trans, self.start = theta
        return self


class Tagger:
    """A worker's model, with potentials of the words that it has met."""

    def __init__(self, crf: Crf):
        self.crf, self.rows = crf, {}
        self.e = np.zeros((1 << 16, len(crf.langs)), np.float32)

    def _number(self, words: list[str]) -> np.ndarray:
        if len(self.rows) > CACHE:
            self.rows = {}
        rows = self.rows
        new = list(set(words).difference(rows))
        if new:
            first = len(rows)
            while first + len(new) > len(self.e):
                self.e = np.concatenate([self.e, np.zeros_like(self.e)])
            self.e[first : first + len(new)] = potentials(self.crf.w, *word_features(new, len(self.crf.w)), len(new))
            rows.update(zip(new, range(first, first + len(new)), strict=True))
        return np.fromiter(map(rows.__getitem__, words), np.int64, len(words))

    def expected(self, texts: list[str | None]) -> np.ndarray:
        """Expected words in each language, of each text."""
        k = len(self.crf.langs)
        out = np.zeros((len(texts), k))
        held: list[tuple[int, list[str]]] = []
        size = 0
        for d, text in enumerate(texts):
            held.append((d, split(text)))
            size += len(held[-1][1])
            if size >= 150_000 or d == len(texts) - 1:
                self._add(held, out)
                held, size = [], 0
        return out

    def _add(self, held: list[tuple[int, list[str]]], out: np.ndarray) -> None:
        ids = self._number([w for _, words in held for w in words])
        n = np.array([len(w) for _, w in held])
        chains = -(-n // CHAIN)
        if not chains.sum():
            return
        slots = np.full(int(chains.sum()) * CHAIN, -1, np.int64)
        begin = (np.cumsum(chains) - chains) * CHAIN
        slots[np.arange(len(ids)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin, n)] = ids
        there = (slots >= 0).reshape(-1, CHAIN)
        marg, _, _ = forward_backward(self.e[np.maximum(slots, 0)].reshape(len(there), CHAIN, -1), self.crf.trans, self.crf.start, there)
        each = (marg * there[:, :, None]).sum(axis=1)
        np.add.at(out, np.repeat([d for d, _ in held], chains), each)


def windows(text: str) -> list[list[str]]:
    """Some windows of a text at places that the text itself seeds."""
    words, rng = split(text), np.random.default_rng(zlib.crc32(text.encode()))
    at = [int(rng.integers(0, max(1, len(words) - CHAIN + 1))) for _ in range(WINDOWS)]
    return [words[i : i + CHAIN] for i in at if words]


def learn(rows: DataFrame, sample: int = SAMPLE) -> Crf:
    """``rows``: (doc_id, text, lang). The driver gets six windows of each sampled text, whatever its length."""
    told = rows.where("lang is not null and text is not null")
    counts = {r.lang: r.n for r in told.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    crf = Crf(sorted(counts))
    if not counts:
        return crf
    most = max(1, min(sample, TEXTS // len(counts)))
    share = told.sparkSession.createDataFrame([(k, min(1.0, most / n)) for k, n in counts.items()], "lang string, share double")
    draw = F.pmod(F.xxhash64(F.lit(SEED), "doc_id", F.length("text")), F.lit(1 << 20))
    chosen = told.join(F.broadcast(share), "lang").where(draw < F.col("share") * (1 << 20)).select("lang", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = [(lang, w) for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for w in windows(text)]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in own], pa.string()), pa.array([x[1] for x in own], pa.list_(pa.string()))], ["lang", "words"])

    taken = chosen.mapInArrow(cut, "lang string, words array<string>").toArrow().to_pylist()
    return crf.fit(sorted((r["lang"], r["words"]) for r in taken))


def predict(docs: DataFrame, crf: Crf) -> DataFrame:
    """(doc_id, text) to (doc_id, lang_pred, score)."""
    shared = docs.sparkSession.sparkContext.broadcast(crf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(shared.value)
        for b in batches:
            x = tagger.expected(b.column(1).to_pylist()) if tagger.crf.langs else np.zeros((b.num_rows, 1))
            total = x.sum(axis=1)
            best = x.argmax(axis=1)
            lang = [tagger.crf.langs[i] if t > 0 else "und" for i, t in zip(best.tolist(), total.tolist(), strict=True)]
            s = np.clip(x.max(axis=1, initial=0) / np.maximum(total, 1e-12), 0, 1)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lang, pa.string()), pa.array(s.astype(np.float64))], ["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def op2(spark, sf_dir: str) -> DataFrame:
    from twinspark.llm.common import read

    docs = read(spark, sf_dir, "documents")
    held = crc_mod("doc_id", 4) == 2
    return predict(docs, learn(docs.where(~held))).select("doc_id", held.alias("held_out"), "lang_pred", "score")
