import hashlib
import random
import re
import zlib
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
from pyspark.sql import functions as F

from twinspark.llm import jaccard, lines, repair, runs, simhash, suffix

DOCS = "doc_id long, text string, node string, token long"


def _texts(seed, n):
    rng, words = random.Random(seed), [f"W{i}" for i in range(60)]
    passage, out = [rng.choice(words) for _ in range(40)], []
    for _ in range(n):
        own = [rng.choice(words) for _ in range(rng.choice([0, 1, 3, 5, 9, 30, 80]))] + (passage if rng.random() < 0.5 else [])
        for _ in range(rng.choice([1, 1, 1, 4])):
            near = [rng.choice(words) if rng.random() < 0.02 else w for w in own]
            out.append((" " if rng.random() < 0.5 else "\n").join(w.lower() if rng.random() < 0.3 else w for w in near))
    return out


def test_jaccard_equals_all_pairs(spark):
    rows = [*enumerate(_texts(1, 120)), (None, "a b c d e f"), (None, "a b c d e f"), (900, None), (901, ""), (902, " \t"), (903, "A B C D E F"), (7, "w " * 3000), (7, "w " * 3000), (904, "one two"), (905, "ONE two")]
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], DOCS)
    key = lambda r: (str(r[0]), r[1], str(r[2]))
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.components(docs.repartition(4)).collect()]
    assert sorted(got, key=key) == sorted(jaccard.brute(rows), key=key)
    assert jaccard.components(docs.limit(0)).count() == 0


def test_jaccard_rounds_of_stars(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "DENSE", 0)
    monkeypatch.setattr(jaccard, "GAIN", 2)
    monkeypatch.setattr(jaccard, "ROUNDS", 2)
    rows = [(f"d{i:03}", t) for i, t in enumerate(_texts(2, 60))]
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.components(spark.createDataFrame(rows, "doc_id string, text string")).collect()]
    assert sorted(got) == sorted(jaccard.brute(rows))


def _planted(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(("" if doc_id is None else str(doc_id)).encode()), len(w)
    g = h // 10
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return w[:a] + [w[a + (i - a) % p] for i in range(a, n)]


def test_periodic_runs_query_equals_brute_force(spark, tmp_path):
    texts = _texts(3, 80) + ["x " * 40, "a b a b a b a b\tc", "a a a a a a b b b b b b", None, "", "  ", "one"]
    rows = [(i if i % 9 else None, t) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for d, t in rows:
        w = _planted(d, t)
        found = runs.brute(w)
        gone = {i for s, n, q in found for i in range(s + q, s + n)}
        best = min(((-n, s, q) for s, n, q in found), default=None)
        head = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
        want.append((d, len(found), *head, sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    got = [tuple(r) for r in runs.op12(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and any(r[1] for r in want)
    assert runs.runs(spark.createDataFrame([], DOCS)).count() == 0


def test_runs_of_random_words():
    rng = random.Random(5)
    for _ in range(200):
        docs = []
        for _ in range(rng.randrange(1, 5)):
            own = []
            while len(own) < rng.randrange(60):
                own += ([rng.randrange(4) for _ in range(rng.randrange(1, 8))] * rng.randrange(1, 8))[: rng.randrange(1, 50)]
            docs.append(own)
        size = np.array([len(x) for x in docs], np.int64)
        assert runs.find_runs(np.array([w for x in docs for w in x], np.int64), size) == [runs.brute(x) for x in docs]


def _conversation(rng):
    text = lambda: rng.choice(["", " ", "yes", "no.", "so?\n", "well then", "a."])
    return [(rng.choice(["user", "assistant", "system", "tool", "", "user"]), text()) for _ in range(rng.randrange(0, 9))]


@pytest.mark.parametrize("batch", ["10000", "3"])
def test_repair_equals_all_edits(spark, batch):
    rng = random.Random(7)
    told = {i: [(None if rng.random() < 0.1 else t // 2, *r) for t, r in enumerate(_conversation(rng))] for i in range(60)}
    told[None] = [(0, "user", "hi."), (0, "user", "hi."), (1, "assistant", "ho.")]
    rows = [(c, t, role, text, 1, "x") for c, own in told.items() for t, role, text in own]
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, at long, matrix string").drop("nothing")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        report, fixed = (x.collect() for x in repair.repair(docs))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = {r.conv_id: r for r in report}
    for c, own in told.items():
        own = sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        if not own:
            assert c not in got
            continue
        cost, audit, want = repair.brute([r[1:] for r in own])
        assert (got[c].cost, got[c].audit) == (cost, audit)
        assert [(r.role, r.text) for r in sorted((r for r in fixed if r.conv_id == c), key=lambda r: r.place)] == want
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(own, own[1:])]
        assert got[c].illegal == sum(p not in ("su", "ua", "au") for p in pairs)
        turns = {r[0] for r in own} - {None}
        assert got[c].gaps == (max(turns) - min(turns) + 1 - len(turns) if turns else 0)


def test_repair_ranks_are_the_order_of_audits():
    rng = np.random.default_rng(1)
    size = np.array([9, 4, 1])
    code = rng.integers(0, 4, 14) + 4 * (rng.random(14) < 0.2)
    end = np.tile(repair.ENDED, (3, 1))
    _, letter, to = repair.optimal(size, code, end, np.ones(3, bool))
    rank, length, jumps = repair.ranked(letter, to)
    audits = [repair.LETTERS[letter[repair.paths(np.array([v]), length, jumps)]].tobytes() for v in range(len(rank))]
    assert [sorted({*audits}).index(a) for a in audits] == [sorted({*rank.tolist()}).index(r) for r in rank.tolist()]


def test_repair_query_on_edge_rows(spark, tmp_path):
    rows = [(1, None, None, None), (1, 0, "user", "a."), (None, 0, "user", "a."), (None, None, None, None)] + [(i, t, "user" if t % 2 else "assistant", "x y" * t) for i in range(2, 60) for t in range(3)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.conv_id: r for r in repair.op11(spark, str(tmp_path)).collect()}
    assert got.keys() == {r[0] for r in rows}
    empty = [r for r in got.values() if not r.audit]
    assert all(r.cost == 0 and r.repaired_sha256 == hashlib.sha256(b"").hexdigest() for r in empty)
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.repair(none)[0].count() == 0 and repair.repair(none)[1].count() == 0
    assert repair.damaged(none.withColumn("copy", F.lit(1))).count() == 0


def test_pipeline_results_outlive_later_calls(spark, tmp_path):
    import corpus_pipeline

    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    one = stages["line dedup"](spark, docs, d)
    other = stages["line dedup"](spark, docs.where("doc_id % 2 = 0"), d)
    with ThreadPoolExecutor(2) as pool:
        runs = [pool.submit(corpus_pipeline.run, spark, d) for _ in range(2)]
        third, first = runs[1].result(), runs[0].result()
    key = lambda df: sorted(map(str, df.select("doc_id", "text").collect()))
    assert key(third) == key(first) and first.count()
    assert one.count() == docs.count() and other.count() == docs.where("doc_id % 2 = 0").count()


def test_suffix_rows_of_a_hot_hash(spark, monkeypatch):
    """One row for each stretch of a hash that many texts have, not one for each start; and the same results as by brute force."""
    monkeypatch.setattr(suffix, "HOT_BYTES", 1)
    made = {}
    table = suffix.table
    monkeypatch.setattr(suffix, "table", lambda df, name="t", folder=None: made.setdefault(name, table(df, name, folder)))
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    passage, period = word(90), word(7)
    docs = [(i, word(50) + passage[i % 3 :] + word(50)) for i in range(40)]
    docs += [(100 + i, word(30) + period * (6 + i) + word(30)) for i in range(8)]
    docs += [(200, word(9) + passage[:20] + passage), (201, "x" * 200), (202, "x" * 41 + word(20)), (203, "x" * 40 + word(20))]
    for keep in ("none", "first"):
        made.clear()
        rows, parts = suffix.repeats(spark.createDataFrame(docs, "doc_id long, text string"), 40, keep)
        kept, want = {(r.a, r.b): len(r.kept) for r in parts.collect()}, suffix.brute(docs, 40, keep)
        for r in rows.collect():
            assert (r.n_bytes if r.gone else r.n_bytes - kept.get((r.a, r.b), r.n_bytes)) == want[r.doc_id][1], (keep, r.doc_id)
        assert made["stretches"].count() < 2000  # a row for each start before


def test_masked_lines_equal_masked(spark):
    texts = ["a  b\tc\n\r\n 1 \x0b2x3\x0c\n\n x", "no fields\nat all", "", "\n", " 7\n\u00a0 8\u00a0 9 ", "a1\u2028b c"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    each = F.transform(F.split("text", "\n"), lines.masked)
    assert docs.where(each != lines.masked_lines(F.col("text"))).count() == 0
    tokens = F.transform(each, lambda x: F.struct(F.size(F.split(x, " ")), F.xxhash64(F.array_join(F.slice(F.split(x, " "), 1, 3), " "))))
    assert docs.where(tokens != F.transform(each, lambda x: F.struct(lines._size(x), lines._lead(x)))).count() == 0
    plan = lines._parsed(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "split(lambda" not in plan  # three times for each line before


def test_pairs_of_unlike_sets_make_no_rows(spark):
    """Sets that share common shingles only are no rows of the joins of prefixes; sets that are alike are."""
    rng = random.Random(3)
    own = [np.array([rng.getrandbits(62) for _ in range(300)], np.uint64) for _ in range(40)]
    own.append(np.r_[own[0][:280], own[1][:20]])
    bits = [simhash.parities(h) for h in own]
    for x, p in zip(own, bits, strict=True):
        for y, q in zip(own, bits, strict=True):
            assert np.bitwise_count((p ^ q).view(np.uint64)).sum() <= len(np.setxor1d(x, y))
    each = spark.createDataFrame([(i, *map(int, p)) for i, p in enumerate(bits)], ["node", *simhash.PARITY])
    rows = spark.range(41).selectExpr("1L token", "1L key", "id node", "300L n", "0 pos", "0L rest", "id class")
    made = lambda df: [r for r in df.collect()]
    assert [(r.u, r.v) for r in made(jaccard.candidates(rows.withColumn("rest", F.lit(300)), each, 0.8))] == [(0, 40)]  # 820 before
    assert {(r.u, r.v) for r in made(simhash.met(rows, each, 0.8))} <= {(0, 40)}


def test_one_round_of_stars_at_least(spark, monkeypatch):
    """A few near copies are joined by their leader, before all their pairs are made."""
    turns = []
    stars = jaccard.stars
    monkeypatch.setattr(jaccard, "stars", lambda rows, s, turn: turns.append(turn) or stars(rows, s, turn))
    words = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(words[:-1] + [f"z{i}"])) for i in range(5)]
    got = jaccard.components(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.component_id for r in got} == {0} and turns == [0]


def test_jaccard_lists_hold_sets_of_like_sizes(spark, monkeypatch):
    rng = random.Random(9)
    long = [f"v{rng.randrange(10**9)}" for _ in range(400)]
    texts = [" ".join(long[:n]) for n in (404, 400, 324, 323, 322, 200, 104, 84, 83, 79, 40, 12, 10, 9, 5)] + [" ".join(long[::-1][:n]) for n in (300, 100)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    apart = docs.where("doc_id in (6, 9)")  # 100 and 75 shingles, all of the one in the other
    order = lambda d: jaccard.levels(jaccard.profile(d, 5))
    assert jaccard.shared(jaccard.prefixes(apart, 5, 0.8, *order(apart)), 0.8).count() == 0  # 59 rows of lists before
    want = sorted(jaccard.brute(list(enumerate(texts))))
    got = lambda: sorted(tuple(r) for r in jaccard.components(docs.repartition(3)).collect())
    assert got() == want and len({r[2] for r in want}) < len(want)
    monkeypatch.setattr(jaccard, "HOT", 1)
    assert got() == want
