import hashlib
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from twinspark.operators.graph import local_components
from twinspark.llm import chat, decontaminate, golay, language, lines, media, mixing, quality, simhash, suffix, warc
from twinspark.shared import table

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, k string"
EDGE = [
    (1, None, None, None, None, 1.0, "x"), (2, "", "en", "s1", 0, None, None), (3, "a b c", "en", "s1", 5, 2.0, "y"), (3, "a b c", "en", "s1", 5, 2.0, "y"),
    (None, "a b c d e f", "fr", "s2", 11, 0.0, "z"), (5, "w " * 30000, "en", "s2", 60000, 0.0, "z"), (6, "a b c", None, "\U0001f600", 5, 0.0, "z"),
]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_edge_rows(spark, edge, empty):
    bench = spark.createDataFrame([(1, "b c"), (2, None), (3, ""), (None, "a b")], "item_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (5, 0), (9, 1)], "doc_id long, quality int")
    n = len(EDGE)
    for docs, rows in ((edge, n), (empty, 0)):
        assert simhash.components(docs).count() == rows
        assert lines.line_dedup(docs).count() == rows
        assert decontaminate.scan(docs, bench).count() == rows
        assert decontaminate.scan(docs, bench.limit(0)).where("size(found.spans) > 0").count() == 0
        assert suffix.clean(docs).count() == rows
        assert media.features(media.encode(docs)).count() == rows
        assert language.predict(docs, language.learn(docs)).count() == rows
        x = quality.stats(docs)
        assert quality.score(x, quality.learned(x, labels)).count() == rows
        assert quality.score(x, quality.learned(x, labels.limit(0))).where("score <> 0.5").count() == 0
        assert quality.filter_quality(docs, labels).columns == docs.columns
        assert mixing.schedule(docs).count() == rows
    near = simhash.near_duplicates(edge)
    assert near.columns == edge.columns and near.where("doc_id = 3").count() == 1
    assert language.predict(edge, language.learn(edge)).where("doc_id <= 2").select("lang_pred").distinct().collect()[0][0] == "und"


def test_golay_near():
    words = golay.codewords()
    rng = np.random.default_rng(0)
    x = rng.integers(0, 1 << 23, 3000)
    first, all_near = golay.near(x)
    want = [set(np.flatnonzero(np.bitwise_count(words ^ v) <= 4)) for v in x[:300]]
    assert [set(r[r >= 0]) for r in all_near[:300]] == want
    y = x ^ (1 << rng.integers(0, 23, 3000))
    assert all(a in set(r) for a, r in zip(first, golay.near(y)[1], strict=True))


def test_simhash_bits():
    text = b"The quick  brown\tfox\nJumps over the lazy dog and on"
    w = text.decode().lower().split()
    h = [xxhash.xxh64(" ".join(w[i : i + 3]), seed=42).intdigest() for i in range(len(w) - 2)]
    assert simhash.shingle_hashes(text, 3).tolist() == h
    big = np.random.default_rng(0).integers(0, 1 << 63, 70000).astype(np.uint64)
    assert simhash.bit_counts(big).tolist() == [int(((big >> np.uint64(b)) & np.uint64(1)).sum()) for b in range(64)]


def test_links_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(simhash, "GROUP", 16)
    monkeypatch.setattr(simhash, "WIDE", 6)
    rng = np.random.default_rng(1)
    base = rng.integers(-(2**63), 2**63 - 1, 300)
    flipped = base.copy()
    for _ in range(3):
        flipped ^= np.int64(1) << rng.integers(0, 62, 300)
    hot = np.int64(99) ^ (rng.integers(0, 256, 200) << 40)
    prints = np.unique(np.concatenate([base, flipped, hot]))
    df = spark.createDataFrame([(int(x),) for x in prints], "f0 long")
    links = {(r.f0, r.g0) for r in simhash.links(simhash.hard_keys(df), 3).collect()}

    def classes(pairs):
        root = {int(x): int(x) for x in prints}

        def find(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for a, b in pairs:
            root[find(int(a))] = find(int(b))
        out = {}
        for x in root:
            out.setdefault(find(x), set()).add(x)
        return sorted(map(sorted, out.values()))

    brute = [(a, b) for a in prints for b in prints[np.bitwise_count((prints ^ a).view(np.uint64)) <= 3]]
    assert classes(links) == classes(brute)


def test_reach_against_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(30):
        n = int(rng.integers(1, 300))
        key = np.sort(rng.integers(0, rng.integers(1, 9), n))
        f0, f1 = rng.integers(-(2**62), 2**62, 5)[rng.integers(0, 5, n)], np.zeros(n, np.int64)
        for _ in range(4):
            f0 ^= np.where(rng.random(n) < 0.6, np.int64(1) << rng.integers(0, 63, n), 0)
        i, j = np.nonzero((key[:, None] == key) & (np.bitwise_count((f0[:, None] ^ f0).view(np.uint64)) <= 3))
        assert (simhash._compare(key, f0, f1, 3) == local_components(n, i, j)).all()


def test_near_copies(spark):
    rng = np.random.default_rng(2)
    rows = []
    for g in range(30):
        w = [f"w{rng.integers(0, 5000)}" for _ in range(300)]
        rows.append((3 * g, " ".join(w)))
        w2 = list(w)
        w2[int(rng.integers(0, 300))] = "edited"
        rows += [(3 * g + 1, " ".join(w2)), (3 * g + 2, " ".join(w))]
    got = {r.doc_id for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {3 * g for g in range(30)}


def test_links_are_verified(spark):
    rng = np.random.default_rng(7)
    words = lambda n: [f"w{x}" for x in rng.integers(0, 10**6, n)]
    passage = words(20)
    rows = [(i, " ".join(passage * 20 + words(60))) for i in range(4)]  # one passage over and over, and 60 words of their own
    for i in range(10, 40, 2):
        w = words(200)
        edited = list(w)
        for p in (30, 60, 90, 120, 150, 180):  # 30 of 196 shingles: a similarity of 0.73
            edited[p] = "edited"
        rows += [(i, " ".join(w)), (i + 1, " ".join(edited))]
    assert simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).count() == len(rows)


def test_near_duplicates_against_brute_force(spark):
    rng = np.random.default_rng(8)
    common = " ".join(f"c{x}" for x in range(12))  # in every third text
    rows, sets = [], {}
    for g in range(60):
        w = [f"w{x}" for x in rng.integers(0, 10**6, int(rng.integers(20, 300)))]
        for c in range(3):
            v = list(w)
            for p in rng.integers(0, len(v), round(c * len(v) * rng.uniform(0.012, 0.026))):
                v[p] = f"e{rng.integers(0, 10**6)}"
            rows.append((len(rows), " ".join(v) + (" " + common if g % 3 == 0 else "")))
    for i, text in rows:
        w = text.split()
        sets[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)}
    root, tight = {i: i for i in sets}, 0
    for i in sets:
        for j in range(i):
            s = len(sets[i] & sets[j]) / len(sets[i] | sets[j])
            tight += 0.8 <= s < 0.85
            if s >= 0.8 and root[i] != root[j]:
                a, b = sorted((root[i], root[j]))
                root = {x: a if r == b else r for x, r in root.items()}
    got = {r.doc_id for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert tight > 10 and got == set(root.values())


def test_blocks_of_a_large_class(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK_ROWS", 7)
    monkeypatch.setattr(simhash, "COLUMNS", 16)
    rng = np.random.default_rng(10)
    base = [f"w{x}" for x in range(60)]
    rows = []
    for i in range(80):
        w = list(base)
        for p in rng.integers(0, 60, int(rng.integers(0, 5))):
            w[p] = f"e{rng.integers(0, 10**6)}"
        rows.append((i, " ".join(w)))
    sets = [{tuple(t.split()[j : j + 5]) for j in range(56)} for _, t in rows]
    i, j = np.nonzero([[len(a & b) >= 0.8 * len(a | b) for b in sets] for a in sets])
    root = local_components(80, i, j)
    assert 1 < len(set(root.tolist())) < 60
    got = {r.doc_id for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == set(root.tolist())


def test_one_row_of_each_class(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcd")
    rows = [(1, a), (1, b), (2, a), (2, c), (3, c), (None, d), (None, a), (None, d.upper()), (None, "z"), (1, a)]
    for order in (rows, rows[::-1]):
        got = simhash.near_duplicates(spark.createDataFrame(order, "doc_id long, text string")).collect()
        ids = sorted((r.text.lower(), r.doc_id or 0) for r in got)
        assert ids == [(a, 1), (b, 1), (c, 2), (d, 0), ("z", 0)]


def test_decontaminate(spark):
    phrase = " ".join(f"p{i}" for i in range(14))
    docs = [(1, f"x {phrase.upper()}! y"), (2, "nothing here"), (3, " ".join(phrase.split()[:9])), (4, f"{phrase} {phrase}"), (5, None), (6, "tiny item at end: tiny item")]
    items = [(1, phrase), (2, "tiny item"), (3, ""), (4, None), (5, phrase)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    want = decontaminate.brute(docs, items)
    for block in (1 << 20, 60):
        got = {r.doc_id: (r.found.n_words, sum(s.words for s in r.found.spans), len(r.found["items"])) for r in decontaminate.scan(d, b, block_bytes=block).collect()}
        assert got == {k: v[:3] for k, v in want.items()}
    clean = {r.doc_id: r.text for r in decontaminate.scan(d, b, clean=True).collect()}
    assert clean[1] == "x ! y" and clean[2] == "nothing here" and clean[5] is None


def test_suffix_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(3)
    word = lambda: "".join(rng.choice(list("abé"), 4))
    shared = " ".join(word() for _ in range(30))
    docs = [(i, " ".join(word() for _ in range(20)) + (shared if i % 3 else shared[:50]) + " ".join(word() for _ in range(10))) for i in range(12)]
    docs += [(20, docs[0][1]), (21, None), (22, "ab" * 100), (23, "x")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for hot in (1 << 20, 1):
        monkeypatch.setattr(suffix, "HOT_BYTES", hot)
        for keep in ("none", "first"):
            rows, parts = suffix.repeats(df, 40, keep)
            kept = {(r.a, r.b): r for r in parts.collect()}
            want = suffix.brute(docs, 40, keep)
            for r in rows.collect():
                p = kept.get((r.a, r.b))
                removed = r.n_bytes if r.gone else r.n_bytes - len(p.kept) if p else 0
                assert removed == want[r.doc_id][1], (hot, keep, r.doc_id)


def test_suffix_one_hash_of_many_long_stretches(spark, monkeypatch):
    monkeypatch.setattr(suffix, "HOT_BYTES", 4000)
    rng = np.random.default_rng(9)
    word = lambda n: "".join(rng.choice(list("abcdefgh"), n))
    passage = word(120)
    docs = [(str(i), word(60) + (passage if i % 5 else passage[:70]) + word(60)) for i in range(60)]
    docs += [(f"p{i}", "ab" * (200 + i) + word(30)) for i in range(6)] + [(None, "ab" * 150), (None, word(80))]
    for keep in ("none", "first"):
        rows, parts = suffix.repeats(spark.createDataFrame(docs, "doc_id string, text string"), 40, keep)
        kept = {(r.a, r.b): len(r.kept) for r in parts.collect()}
        got = sorted((r.doc_id or "", r.n_bytes, r.n_bytes if r.gone else r.n_bytes - kept.get((r.a, r.b), r.n_bytes)) for r in rows.collect())
        order = sorted(docs, key=lambda d: (d[0] is not None, d[0] or ""))
        if keep == "first":  # null ids: by hash of the text
            turn = {r.n_bytes: (r.a, r.b) for r in rows.where("doc_id is null").collect()}
            order[:2] = sorted(order[:2], key=lambda d: turn[len(d[1])])
        want = suffix.brute([(i, t) for i, (_, t) in enumerate(order)], 40, keep)
        assert got == sorted((d or "", *want[i][:2]) for i, (d, _) in enumerate(order)), keep


def test_suffix_shared_pieces_without_repeats(spark):
    rng = np.random.default_rng(5)
    shared = "".join(rng.choice(list("abcdefgh"), 35))
    docs = [(i, "".join(rng.choice(list("abcdefgh"), 60)) + shared + "".join(rng.choice(list("abcdefgh"), 60))) for i in range(4)]
    rows, parts = suffix.repeats(spark.createDataFrame(docs, "doc_id long, text string"), 40, "none")
    assert rows.where("gone").count() == 0 and parts.count() == 0


def test_previous_factors():
    data = np.frombuffer(b"abracadabra_abracadabra_bra", np.uint8)
    starts = np.arange(len(data))
    order, levels = suffix.suffix_order(data, starts, 16)
    lcp = suffix.adjacent_lcp(data, order, levels)
    got = np.empty(len(data), int)
    got[order] = suffix.previous_factors(order, lcp)
    text = data.tobytes()
    for i in range(len(text)):
        best = max([0, *(next((k for k in range(17) if k == 16 or i + k >= len(text) or text[i + k] != text[j + k]), 0) for j in range(i))])
        assert got[i] == min(16, best), i


def test_lines(spark):
    abc = "abcdefghijklmnopqrstuvwxyz"
    own = lambda i: "\n".join(" ".join(f"{abc[i]}{abc[j]}{abc[k]}" for k in range(6)) for j in range(6))
    two = "All rights are reserved here\n\nContact the editor for more"  # a notice of two lines, in every text
    docs = [(i, f"{own(i)}\nPosted by user {abc[i]} on the {'site' if i % 2 else 'list'}\nPosted by user {abc[i]} in a forum\n{two}\nPage {i} of 9\nmore {abc[i]}") for i in range(20)]
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r for r in lines.line_dedup(frame(docs)).collect()}
    assert out[0].lines.n_dropped == 0 and out[0].text == docs[0][1]
    for i in range(1, 20):
        gone = ("in a forum", "reserved", "editor", "Page") + (("on the",) if i > 1 else ())
        assert not any(x in out[i].text for x in gone) and own(i) in out[i].text and f"more {abc[i]}" in out[i].text, i
    # copies as a whole stay for near-duplicate removal, whatever recurs in them
    copies = [(i, f"one line\nand another\nthird line {abc[i]}x") for i in range(20)]
    assert lines.line_dedup(frame(copies)).where("lines.n_dropped > 0").count() == 0
    # extra columns with the names that are used inside
    wide = frame(docs).selectExpr("doc_id", "text", "1 as lines", "2 as a", "3 as d", "4 as gone", "5 as kept", "6 as tid")
    same = lines.line_dedup(wide)
    assert same.columns == ["doc_id", "text", "a", "d", "gone", "kept", "tid", "lines"]
    assert {r.doc_id: (r.text, r.a, r.tid) for r in same.collect()} == {k: (r.text, 2, 6) for k, r in out.items()}


def test_media():
    for n in (0, 1, 575, 576, 577, 9215, 9216, 9217, 30000):
        text = bytes(i * 7 % 256 for i in range(n))
        stream = media.mux(media.pad(text))
        x = media.parse(stream)
        assert x["payload"] == media.pad(text) and x["breaks"] == 0 and len(x["pts"]) == len(x["access"])
    assert media.parse(stream[:188] + stream[188 : 188 * 5] + stream[188 * 6 :])["breaks"] == 1
    with pytest.raises(ValueError):
        media.parse(b"x" + stream[1:])
    assert media.crc_mpeg(b"123456789") == 0x0376E6E7


def test_chat(spark):
    log = [  # (turn, part, role, kind, text), in the order of the sequence
        (0, 1, "user", "delta", "hel"), (0, 1, "user", "delta", "lo"), (1, 1, "assistant", "delta", "bad"), (2, 1, "user", "delta", "why"), (3, 1, "assistant", "delta", "void"),
        (1, 1, "assistant", "regenerate", None), (1, 1, "assistant", "delta", "go"), (2, 1, "user", "delta", "x"), (1, 1, "assistant", "delta", "od\\b#"), (2, 1, "user", "edit", "new"),
        (2, 1, "user", "delta", "!"), (4, 1, "user", "edit", "draft"), (4, 1, "user", "edit", "last"), (5, 1, "assistant", "delta", "z"), (5, 1, "assistant", "regenerate", None),
    ]
    schema = "conv_id string, seq long, turn long, part long, role string, kind string, text string, log string"
    events = spark.createDataFrame([("c", seq, *e, "more") for seq, e in reversed(list(enumerate(log)))], schema)
    r = chat.render(chat.messages(events)).first()
    # the regeneration of turn 1 voids what turns 2 and 3 had until then; turn 3 has nothing else and is gone
    assert chat.read_back(r.formatted) == [("user", "hello"), ("assistant", "good\\b#"), ("user", "new!"), ("user", "last"), ("assistant", "")]
    assert [chat.unescape(r.formatted[m.start : m.start + m.length]) for m in r["mask"]] == ["good\\b#", ""]
    rows = [(1, 0, None, None), (1, 0, "a:b", "</turn>\n### x: y"), (None, None, "user", "q"), (1, 0, None, None), (1, 1, "assistant", "long " * 20000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: chat.read_back(r.formatted) for r in chat.render(chat.messages(chat.as_events(frame))).collect()}
    assert got == {1: [("", ""), ("", ""), ("a:b", "</turn>\n### x: y"), ("assistant", "long " * 20000)], None: [("user", "q")]}
    assert chat.digests(chat.render(chat.messages(chat.as_events(frame.limit(0))))).count() == 0


def test_warc(spark):
    same = "é" * 60
    rows = [(3, "http://a/ b", same), (1, None, same), (2, "u", "short"), (4, "u", "short"), (5, "", None), (None, "n", "z" * 200), (1, None, same)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    number = lambda x: int(x) if x else None
    got = sorted(((number(r.page_id) or 0, r.payload_bytes, r.record_type, number(r.refers_to)) for r in warc.records(warc.convert(warc.arcs(pages))).collect()), key=str)
    assert got == sorted([(3, 120, "revisit", 1), (1, 120, "response", None), (1, 120, "response", None), (2, 5, "response", None), (4, 5, "response", None), (5, 0, "response", None), (0, 200, "response", None)], key=str)
    for v in (1, 2):
        arc = warc.write_arc(v, [(7, "http://x/ y", b"body")])
        ((fields, body),) = warc.read_arc(arc)
        assert fields["URL"] == "http://x/%20y" and body.endswith(b"\r\n\r\nbody")
        with pytest.raises(ValueError):
            list(warc.read_arc(arc[:-3]))
    assert warc.records(warc.convert(warc.arcs(pages.limit(0)))).count() == 0
    named = pages.selectExpr("concat('id', page_id) as page_id", "url", "repeat(html, 3000) as html", "1 as arc", "2 as digest")
    got = {(r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in warc.records(warc.convert(warc.arcs(named))).collect()}
    assert ("id3", "revisit", "id1", 360000) in got and ("id4", "revisit", "id2", 15000) in got and (None, "response", None, 600000) in got


def test_warc_revisits_against_sql(spark, tmp_path, monkeypatch):
    import duckdb

    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 3000)
    rng = np.random.default_rng(6)
    bodies = ["short", None, ""] + ["body %d " % i * int(rng.integers(10, 60)) for i in range(12)]
    rows = [(int(i), f"http://h/{i}", bodies[int(rng.integers(0, len(bodies)))]) for i in rng.permutation(200)]
    spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5).write.parquet(str(tmp_path / "pages.parquet"))
    got = sorted(tuple(r) for r in warc.op10(spark, str(tmp_path)).fillna(-1, ["refers_to"]).collect())
    con = duckdb.connect()
    con.sql(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    want = sorted((*r[:4], -1 if r[4] is None else r[4]) for r in con.sql(warc.OP10_SQL).fetchall())
    assert got == want and sum(r[3] == "revisit" for r in want) > 100


def test_warc_small_pages_stay_where_they_are(spark):
    """100,000 empty pages, unrepeated ones and one repeated body: the first two never meet, so no task holds them all."""
    n = 100000
    html = F.when(F.col("id") < n, "").when(F.col("id") < n + 3000, F.concat(F.repeat(F.lit("x"), 100), F.col("id").cast("string"))).otherwise(F.repeat(F.lit("y"), 300))
    pages = spark.range(n + 4000).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), html.alias("html")).repartition(8)
    archive = table(warc.arcs(pages), "arc")
    written = table(warc.convert(archive), "warc")
    rows = warc.records(written).groupBy("record_type", "refers_to").agg(F.count("*").alias("n"), F.sum("payload_bytes").alias("bytes"), F.sum(F.col("page_id").cast("long")).alias("ids"))
    first = n + 3000
    empty, own, again = sum(range(n)), sum(range(n, first)), sum(range(first + 1, n + 4000))
    assert {tuple(r) for r in rows.collect()} == {("response", None, n + 3001, 3000 * 106 + 300, empty + own + first), ("revisit", str(first), 999, 999 * 300, again)}
    bits = warc._repeated(spark.createDataFrame([(bytes([255, 255, 255, 128]),), (bytes(32),)], "digest binary"))
    assert len(bits) == 1 << warc.FILTER_BITS - 3 and np.flatnonzero(np.unpackbits(bits, bitorder="little")).tolist() == [0, (1 << warc.FILTER_BITS) - 1]
    size = [r[0] for r in warc.convert(archive).groupBy(F.spark_partition_id()).agg(F.sum(F.length("warc"))).collect()]
    assert max(size) < 0.5 * sum(size)


def test_crf_switches():
    rng = np.random.default_rng(4)
    make = lambda chars, n: ["".join(rng.choice(list(chars), rng.integers(2, 7))) for _ in range(n)]
    crf = language.Crf(["aa", "bb"]).fit([(x, make(c, 48)) for _ in range(180) for x, c in (("aa", "abcde"), ("bb", "vwxyz"))])
    mixed = make("abcde", 12) + make("vwxyz", 12)
    tagger = language.Tagger(crf)
    ids = tagger._number(mixed)
    marg, _, _ = language.forward_backward(tagger.e[ids][None], crf.trans, crf.start, np.ones((1, 24), bool))
    assert (marg[0].argmax(1) == np.repeat([0, 1], 12)).mean() > 0.95
    e, t, s = rng.standard_normal((1, 3, 2)), rng.standard_normal((2, 2)), rng.standard_normal(2)
    marg, _, logz = language.forward_backward(e, t, s, np.ones((1, 3), bool))
    paths = [(i, j, k) for i in (0, 1) for j in (0, 1) for k in (0, 1)]
    w = np.array([np.exp(s[i] + e[0, 0, i] + t[i, j] + e[0, 1, j] + t[j, k] + e[0, 2, k]) for i, j, k in paths])
    assert np.isclose(logz[0], np.log(w.sum())) and np.isclose(marg[0, 1, 0], w[[p[1] == 0 for p in paths]].sum() / w.sum())


@pytest.mark.parametrize("sf", ["0.01"])
def test_held_out(spark, sf):
    d = f"/root/testdata/sf{sf}"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    q = quality.op4(spark, d).join(labels, "doc_id").where("held_out").select("predicted", "quality").toPandas()
    assert (q.predicted == q.quality).mean() > 0.95
    x = language.op2(spark, d).join(docs, "doc_id").where("held_out").select("lang", "lang_pred", "doc_id").toPandas()
    assert (x.lang == x.lang_pred).mean() > 0.98
    assert set(x.doc_id) == {i for i in range(1000) if zlib.crc32(str(i).encode()) % 4 == 2}


def test_contracts(spark):
    d = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{d}/benchmark.parquet").collect()]
    want = decontaminate.brute(docs, items)
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in decontaminate.op8(spark, d).collect()} == want
    want = suffix.brute(docs, 400)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix.op6(spark, d).collect()} == want
    for r, (_, t) in zip(media.op5(spark, d).orderBy("doc_id").collect(), sorted(docs), strict=True):
        p = media.pad(t.encode())
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(t.encode()), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]))


def test_pipeline(spark):
    import corpus_pipeline

    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, d)
        assert out.columns == docs.columns, name
    out = corpus_pipeline.run(spark, d).groupBy("doc_id").count().toPandas()
    assert 0 < len(out) <= docs.count() and out["count"].max() <= 2


def test_sql(spark):
    import duckdb

    from twinspark.llm import registry

    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in "documents pages benchmark labels conversations".split():
        con.sql(f"create view {t} as select * from '{d}/{t}.parquet'")
    for name, sql in registry.SQL.items():
        df, rel = registry.QUERIES[name](spark, d), con.sql(sql)
        cols = sorted(df.columns)
        at = [rel.columns.index(c) for c in cols]
        assert sorted(str([r[c] for c in cols]) for r in df.collect()) == sorted(str([r[i] for i in at]) for r in rel.fetchall()), name


def test_letters():
    assert language.split("½ ² x² a1b ⅷ Ⅷ été_ñ 中文 ٣") == ["x", "a", "b", "été", "ñ", "中文"]


def test_language_query_against_brute_force(spark):
    """Decoding spelled out word by word, with the weights that the query learns."""
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    learned = [(r.doc_id, r.text, r.lang) for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 != 2]
    crf = language.learn(spark.createDataFrame(learned, "doc_id long, text string, lang string"))
    got = {r.doc_id: r for r in language.op2(spark, d).collect()}
    for r in docs.limit(40).collect():
        words, total = language.split(r.text), np.zeros(len(crf.langs))
        for i in range(0, len(words), language.CHAIN):
            e = np.array([language.potentials(crf.w, *language.word_features([w]), 1)[0] for w in words[i : i + language.CHAIN]], float)
            f, b = [crf.start + e[0]], [np.zeros(len(total))]
            for x in e[1:]:
                f.append(np.logaddexp.reduce(f[-1][:, None] + crf.trans, axis=0) + x)
            for x in e[:0:-1]:
                b.append(np.logaddexp.reduce(crf.trans + x + b[-1], axis=1))
            m = np.array(f) + np.array(b[::-1])
            total += np.exp(m - np.logaddexp.reduce(m, axis=1)[:, None]).sum(0)
        if len(words):
            assert got[r.doc_id].lang_pred == crf.langs[int(total.argmax())] and abs(got[r.doc_id].score - total.max() / total.sum()) < 1e-3
        assert got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def test_many_languages(spark):
    rng = np.random.default_rng(12)
    rows = [(10 * k + i, " ".join(f"{chr(97 + k % 26)}{chr(97 + k // 26)}{rng.integers(0, 9)}{chr(97 + int(rng.integers(0, 26)))}" for _ in range(20)), f"l{k:03}") for k in range(300) for i in range(3)]
    crf = language.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(crf.langs) == 300 and crf.w.size <= language.TABLE


def test_quality_query_against_brute_force(spark):
    """Ridge by least squares over all rows at once, and isotonic scores as a maximum of minima."""
    d = "/root/testdata/sf0.01"
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    told = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{d}/labels.parquet").collect() if r.quality is not None and r.doc_id in text]
    fold = lambda i: zlib.crc32(str(i).encode()) % 5 - 1
    told = [(i, q) for i, q in told if fold(i) >= 0]
    x = np.array([quality.statistics((text[i] or "").encode()) for i, _ in told])
    model = quality.Model(x.mean(0), np.maximum(x.std(0), 1e-6), np.zeros(1), np.zeros(1), np.zeros(1))
    z, y, of = model.features(x), np.array([q for _, q in told], float), np.array([fold(i) for i, _ in told])

    def ridge(rows):
        grown = np.concatenate([z[rows], np.sqrt(quality.RIDGE * rows.sum()) * np.eye(z.shape[1])[1:]])
        return np.linalg.lstsq(grown, np.concatenate([y[rows], np.zeros(z.shape[1] - 1)]), rcond=None)[0]

    raw = np.array([z[i] @ w for i, w in enumerate(np.array([ridge(of != f) for f in range(4)])[of])])
    bins = np.clip(np.round((raw + 0.5) / 2 * quality.BINS), 0, quality.BINS).astype(int)
    at = np.unique(bins)
    n, g = np.array([(bins == b).sum() for b in at], float), np.array([y[bins == b].sum() for b in at])
    level = [max(min(g[i : k + 1].sum() / n[i : k + 1].sum() for k in range(j, len(at))) for i in range(j + 1)) for j in range(len(at))]
    got = {r.doc_id: r for r in quality.op4(spark, d).collect()}
    weights = ridge(np.ones(len(y), bool))
    for i in list(text)[:200]:
        v = float((model.features(np.array([quality.statistics((text[i] or "").encode())])) @ weights)[0])
        same = [np.isclose(level, x) for x in level]
        smooth = [(g[s].sum() + y.mean()) / (n[s].sum() + 1) for s in same]
        want = np.interp(v, at / quality.BINS * 2 - 0.5, smooth)
        assert abs(got[i].score - want) < 1e-4 and got[i].predicted == (got[i].score >= 0.3) and got[i].held_out == (fold(i) == -1)


def test_simhash_query_against_brute_force(spark):
    d = "/root/testdata/sf0.01"
    prints = {}
    for r in spark.read.parquet(f"{d}/documents.parquet").collect():
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in r.text or "")
        w = [x for x in "".join("\x20" if c in "\t\n\x0b\x0c\r" else c for c in low).split("\x20") if x]
        h = [xxhash.xxh64(" ".join(w[i : i + 3]).encode(), seed=42).intdigest() for i in range(max(1, len(w) - 2))] if w else []
        prints[r.doc_id] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    ids = np.array(sorted(prints))
    f = np.array([prints[i] for i in ids], np.uint64)
    i, j = np.nonzero(np.bitwise_count(f[:, None] ^ f) <= 3)
    root = _classes_of(len(ids), i, j)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.op3(spark, d).collect()}
    assert got == {int(x): (f"{prints[x]:016x}", int(ids[root[k]])) for k, x in enumerate(ids)}


def _classes_of(n, i, j):
    root = np.arange(n)
    for a, b in zip(i.tolist(), j.tolist(), strict=True):
        x, y = sorted((root[a], root[b]))
        if x != y:
            root[root == y] = x
    return root


def test_near_duplicates_recall(spark):
    """Every pair of similarity 0.8 or more among the documents, found by an index of all shingles."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id < 4000")
    texts = sorted((r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect())
    first, sets = {}, {}
    for i, t in texts:
        w = t.encode().lower().split()
        s = frozenset(b" ".join(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
        sets[first.setdefault(s, i)] = s
    holders, both = {}, {}
    for i, s in sets.items():
        for x in s:
            for k in holders.setdefault(x, []):
                both[k, i] = both.get((k, i), 0) + 1
            holders[x].append(i)
    pairs = [p for p, c in both.items() if c >= 0.8 * (len(sets[p[0]]) + len(sets[p[1]]) - c) - 1e-9]
    ids = sorted(sets)
    place = {x: k for k, x in enumerate(ids)}
    root = _classes_of(len(ids), np.array([place[a] for a, _ in pairs]), np.array([place[b] for _, b in pairs]))
    got = {r.doc_id for r in simhash.near_duplicates(docs).collect()}
    assert len(pairs) > 5 and got == {ids[r] for r in set(root.tolist())}


def test_clashing_names(spark, edge):
    """Columns with the names that the operators use inside pass through."""
    bench = spark.createDataFrame([(1, "b c")], "item_id long, text string")
    inner = ["a", "b", "c", "d", "n", "h", "k", "x", "id", "doc", "size", "first", "spans", "found", "lines", "keep", "class", "root", "node", "value", "slice", "cum", "times", "vft", "e", "slot", "_a", "_id", "_sa"]
    taken = {c.lower() for c in edge.columns}
    extra = [c for c in inner if c not in taken]
    wide = edge.select("*", *[F.lit(f"own {c}").alias(c) for c in extra])
    for out in (simhash.near_duplicates(wide), suffix.clean(wide), mixing.mix(wide), lines.line_dedup(wide, into="said"), decontaminate.scan(wide, bench, clean=True, into="said"), quality.filter_quality(wide, spark.createDataFrame([(3, 1), (5, 1)], "doc_id long, quality int"))):
        assert [c for c in out.columns if c != "said"] == wide.columns
        assert out.where(" or ".join(f"`{c}` is null or `{c}` <> 'own {c}'" for c in extra)).count() == 0
    for f in (simhash.components, lambda x: language.predict(x, language.learn(x)), lambda x: media.features(media.encode(x)), mixing.schedule, quality.stats):
        assert f(wide).count() == edge.count()


def test_pipeline_on_edge_rows(spark, edge, empty, tmp_path):
    import corpus_pipeline

    for k, docs in enumerate((edge, empty)):
        d = str(tmp_path / str(k))
        docs.write.parquet(f"{d}/documents.parquet")
        spark.createDataFrame([(1, "b c"), (None, None)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
        spark.createDataFrame([(3, 1), (5, 1), (1, 0), (None, 1)], "doc_id long, quality int").write.parquet(f"{d}/labels.parquet")
        out = corpus_pipeline.run(spark, d)
        assert out.columns == docs.columns and (out.count() > 0) == (k == 0)


def test_mix_targets(spark):
    rows = [(i, "w " * (i % 7 + 1), f"s{min(i % 9, 3)}") for i in range(600)]
    out = mixing.schedule(spark.createDataFrame(rows, "doc_id long, text string, source string")).select("source_size", "target", "size", "times", "k").toPandas()
    got = out.assign(taken=out["size"] * out.times).groupby("k").agg(taken=("taken", "sum"), target=("target", "first"), source=("source_size", "first"))
    assert (abs(got.taken - got.target) <= 14).all() and (got.target <= 2 * got.source + 1e-9).all()
    assert np.isclose(got.target.sum(), 1.5 * got.source.sum())
