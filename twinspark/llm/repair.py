"""Repair of the structure of conversations by the cheapest edits, least audit first.

A repaired conversation has the role initials ``(s?(ua)+)?``. Edits keep a row (K, 0), delete it (D, 3; blank rows
and repeats must go), give it another role (R, 2), or insert an empty row (I, 2); a row cut short that stays adds 1.
Of all cheapest edits those are taken whose letters, in order, come first.

A node is a place between rows with a state of the pattern (nothing yet, after s, after u, after a). A dynamic
program gives each node its cost to the end; the optimal arcs are those that lose nothing. An arc's letter
leads from a node to one other node only, so a node has one least arc, and the nodes are ranked by their audits of
1, 2, 4, ... letters: the rank for twice the letters comes from a node's rank and that of the node which its pointer
reaches, and pointers double with it (prefix doubling). The letters of a path at all its places are read
at once through the doubled pointers.

Conversations of any length are cut into blocks, what an Arrow batch holds of one. A block's costs are a matrix of
states to states; the matrices of a conversation in several blocks are folded (from the end: costs; from
the start, once each block knows its least path from each state: states). Rows are sorted by ranges, and
repeats are found by first places, so no conversation meets in one task; only numbers and letters do, a few for a block.
A conversation's audit is one value of the result.

Rows of a turn come by role and then text (null turns first), so repeats stand together. Edge cases: null
roles and texts count as empty here (the query makes them one space before); a null conversation is one of its own;
a conversation that loses all rows costs 3 for each and ends empty; an empty table gives an empty result; ids
may be numbers or strings; other columns, whatever their names, don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from twinspark.shared import table

KEEP, REROLE, DELETE, INSERT, CUT = 0, 2, 3, 2, 1  #: costs
LETTERS = np.frombuffer(b" DIKR", np.uint8)  #: by number; 0 is the end of a path
FAR = 1 << 40
NEXT = np.array([2, 2, 3, 2])  #: the state after the role that a state asks for (u, u, a, u)
KEPT = np.full((4, 4), -1)  #: the state after a kept row, by its initial (other, s, u, a) and state
KEPT[1, 0], KEPT[2, [0, 1, 3]], KEPT[3, 2] = 1, 2, 3
SPACE = r"\x20\x09-\x0D"


def with_inserts(e: np.ndarray) -> np.ndarray:
    """Costs by state (second axis), if rows may be inserted first."""
    u, a = np.minimum(e[:, 2], e[:, 3] + INSERT), np.minimum(e[:, 3], e[:, 2] + INSERT)
    return np.stack([np.minimum(e[:, 0], u + INSERT), np.minimum(e[:, 1], u + INSERT), u, a], axis=1)


ENDED = with_inserts(np.array([[0, FAR, FAR, 0]]))[0]  #: costs after the last row


def costs(size: np.ndarray, code: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Costs to the end of each node: (place, state, goal), blocks one after another, ``size`` + 1 places each.

    ``code`` has a byte for each row: its initial, 4 if it must go, 8 if it is cut short. ``end`` is (block, state, goal).
    """
    places, rows = np.cumsum(size + 1) - size - 1, np.cumsum(size) - size
    out = np.empty((int((size + 1).sum()), 4, end.shape[2]), np.int64)
    out[places + size] = end
    order = np.argsort(-size, kind="stable")
    many = np.searchsorted(-size[order], -np.arange(int(size.max(initial=0))), "left")  # blocks of more than i rows
    for i in range(len(many) - 1, -1, -1):
        b = order[: many[i]]
        after, c = out[places[b] + i + 1], code[rows[b] + i]
        kept, extra = KEPT[c & 3], (CUT * (c >> 3 & 1))[:, None, None]
        stay = np.where(kept[:, :, None] >= 0, np.take_along_axis(after, np.maximum(kept, 0)[:, :, None], 1) + KEEP, FAR)
        stay = np.minimum(stay, after[:, NEXT] + REROLE) + extra
        out[places[b] + i] = np.minimum(with_inserts(np.where((c & 4 == 4)[:, None, None], after + DELETE, np.minimum(stay, after + DELETE))), FAR)
    return out


def optimal(size: np.ndarray, code: np.ndarray, end: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cost, letter, to) of each node (place * 4 + state): its least optimal arc, letter 0 where a path ends."""
    d = costs(size, code, end[:, :, None])[:, :, 0]
    n = len(d)
    block = np.repeat(np.arange(len(size)), size + 1)
    final = np.zeros(n, bool)
    final[np.cumsum(size + 1) - 1] = True
    inner = np.flatnonzero(~final)
    c = code[inner - block[inner]]
    letter, to = np.zeros((n, 4), np.int64), np.arange(4 * n).reshape(n, 4)
    after, live, extra = d[inner + 1], (c & 4 == 0)[:, None], (CUT * (c >> 3 & 1))[:, None]

    def take(at: np.ndarray, ok: np.ndarray, number: int, target: np.ndarray) -> None:
        i, s = np.nonzero(ok)
        letter[at[i], s], to[at[i], s] = number, target[i, s]

    below = 4 * (inner + 1)[:, None]
    kept = KEPT[c & 3]
    stays = np.take_along_axis(after, np.maximum(kept, 0), 1)
    # the later ones win: letters go down
    take(inner, live & (d[inner] == after[:, NEXT] + REROLE + extra), 4, below + NEXT)
    take(inner, live & (kept >= 0) & (d[inner] == stays + KEEP + extra), 3, below + kept)
    at = np.flatnonzero(~final | last[block])
    take(at, d[at] == d[at][:, NEXT] + INSERT, 2, 4 * at[:, None] + NEXT)
    take(inner, d[inner] == after + DELETE, 1, below + np.arange(4))
    return d.ravel(), letter.ravel(), to.ravel()


def ranked(letter: np.ndarray, to: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(rank, length, pointers): nodes by their whole audits, equal audits alike; the audits' lengths; the nodes 1, 2, 4, ... letters on."""
    rank, length, jumps = letter, (letter > 0).astype(np.int64), [to]
    while length[jumps[-1]].any():
        far = jumps[-1]
        rank = np.unique(rank * (int(rank.max()) + 1) + rank[far], return_inverse=True)[1]
        length = length + length[far]
        jumps.append(far[far])
    return rank, length, jumps


def paths(start: np.ndarray, length: np.ndarray, jumps: list[np.ndarray]) -> np.ndarray:
    """The nodes of the paths from ``start``, one path after another, without their ends."""
    n = length[start]
    node, step = np.repeat(start, n), np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    for k, jump in enumerate(jumps):
        on = (step >> k & 1) == 1
        node[on] = jump[node[on]]
    return node


def _lists(values: pa.Array, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), values)


def blocks(rows: DataFrame) -> DataFrame:
    """(conv_id, at, code, ini) rows in order of ``at`` in each partition, to blocks (conv_id, at, ats, codes, matrix, blank, duplicate, truncated, illegal, head, tail)."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    pairs = np.zeros((4, 4), bool)
    pairs[1, 2] = pairs[2, 3] = pairs[3, 2] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit = np.where(np.eye(4, dtype=bool), 0, FAR)
        for b in batches:
            if not b.num_rows:
                continue
            group = b.column(0).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            size = np.diff(np.r_[first, b.num_rows])
            at, code, fault = b.column(1).to_numpy(), b.column(2).to_numpy().astype(np.int64), b.column(3).to_numpy()
            ini = code & 3
            bad = np.r_[False, ~pairs[ini[:-1], ini[1:]]]
            bad[first] = False
            counts = [np.add.reduceat((fault == k).astype(np.int64), first) for k in (1, 2, 3)]
            whole = costs(size, code, np.broadcast_to(unit, (len(size), 4, 4)))
            start = whole[np.cumsum(size + 1) - size - 1].reshape(len(size), 16)
            cols = [
                b.column(0).take(pa.array(first)), pa.array(at[first]), _lists(pa.array(at), size), pa.array([code[i : i + n].astype(np.uint8).tobytes() for i, n in zip(first, size, strict=True)], pa.binary()),
                _lists(pa.array(start.ravel()), np.full(len(size), 16)), *map(pa.array, counts), pa.array(np.add.reduceat(bad.astype(np.int64), first)), pa.array(ini[first].astype(np.int32)), pa.array(ini[first + size - 1].astype(np.int32)),
            ]
            yield pa.RecordBatch.from_arrays(cols, ["conv_id", "at", "ats", "codes", "matrix", "blank", "duplicate", "truncated", "illegal", "head", "tail"])

    out = f"conv_id {kind}, at long, ats array<long>, codes binary, matrix array<long>, blank long, duplicate long, truncated long, illegal long, head int, tail int"
    return rows.select("conv_id", "at", "code", "fault").mapInArrow(run, out)


def _goals(own: pd.DataFrame) -> pd.DataFrame:
    """Blocks (at, matrix) of one conversation to (at, goal): the costs from the end of each on."""
    own, goal, out = own.sort_values("at"), ENDED, []
    for m in own["matrix"].to_numpy()[::-1]:
        out.append(goal)
        goal = np.minimum((np.asarray(m).reshape(4, 4) + goal).min(axis=1), FAR)
    return pd.DataFrame({"at": own["at"], "goal": [g.tolist() for g in out[::-1]]})


def _entries(own: pd.DataFrame) -> pd.DataFrame:
    """Paths (at, entry, leave) of one conversation to (at, entry): the state in which its own path comes to each block."""
    leave = {(a, e): x for a, e, x in zip(own["at"], own["entry"], own["leave"], strict=True)}
    at, state, out = sorted({*own["at"]}), 0, []
    for a in at:
        out.append(state)
        state = leave[a, state]
    return pd.DataFrame({"at": at, "entry": np.array(out, np.int32)})


EDIT = pa.struct([("letter", pa.string()), ("at", pa.int64()), ("role", pa.string())])


def least_paths(told: DataFrame) -> DataFrame:
    """Blocks with ``goal``, ``opens`` and ``closes`` to (conv_id, at, alone, entry, leave, cost, audit, edits): the least path from each state in which a path can come."""
    kind = told.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            ats, codes, goal, opens, closes = (b.column(i).to_pylist() for i in range(2, 7))
            size = np.array([len(a) for a in ats])
            code = np.frombuffer(b"".join(codes), np.uint8).astype(np.int64)
            last, first = np.array(closes), np.array(opens)
            end = np.array([ENDED if g is None else g for g in goal])
            cost, letter, to = optimal(size, code, end, last)
            _, length, jumps = ranked(letter, to)
            n = np.where(first, 1, 4)
            own = np.repeat(np.arange(len(size)), n)
            entry = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
            start = 4 * (np.cumsum(size + 1) - size - 1)[own] + entry
            node = paths(start, length, jumps)
            row = node // 4 - np.repeat(own, length[start])
            done = letter[node]
            role = np.where(done % 2 == 0, np.where(node % 4 == 2, "assistant", "user"), None)
            flat = np.concatenate([np.asarray(a) for a in ats])
            at = pa.array(np.append(flat, 0)[row], mask=done == 2)
            audit = LETTERS[done].tobytes().decode()
            stop = np.cumsum(length[start])
            edits = pa.StructArray.from_arrays([pa.array(list(audit), pa.string()), at, pa.array(role.tolist(), pa.string())], fields=list(EDIT))
            cols = [
                b.column(0).take(pa.array(own)), b.column(1).take(pa.array(own)), pa.array((last & first)[own]), pa.array(entry.astype(np.int32)), pa.array((jumps[-1][start] % 4).astype(np.int32)),
                pa.array(cost[start]), pa.array([audit[i:j] for i, j in zip(np.r_[0, stop[:-1]].tolist(), stop.tolist(), strict=True)], pa.string()), _lists(edits, length[start]),
            ]
            yield pa.RecordBatch.from_arrays(cols, ["conv_id", "at", "alone", "entry", "leave", "cost", "audit", "edits"])

    out = f"conv_id {kind}, at long, alone boolean, entry int, leave int, cost long, audit string, edits array<struct<letter:string,at:long,role:string>>"
    return told.select("conv_id", "at", "ats", "codes", "goal", "opens", "closes").mapInArrow(run, out)


def in_order(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, at): rows sorted by ranges, ``at`` rising through them; equal rows may lie in several ranges."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    own = rows.select("conv_id", "turn", text("role"), text("text"), F.monotonically_increasing_id().alias("tie"))
    by = ["conv_id", "turn", "role", "text", "tie"]
    return table(own.repartitionByRange(*by).sortWithinPartitions(*by).select(*by[:-1], F.monotonically_increasing_id().alias("at")), "ordered")


def with_faults(ordered: DataFrame) -> DataFrame:
    """(conv_id, at, code, fault): 1 blank, 2 repeated, 3 cut short, else 0; and the row as a byte for ``costs``."""
    ini = F.substring("role", 1, 1)
    rows = ordered.select(
        "conv_id", "at", F.xxhash64("role", "text").alias("a"), F.xxhash64(F.lit(7), "role", "text").alias("b"),
        F.when(ini == "s", 1).when(ini == "u", 2).when(ini == "a", 3).otherwise(0).alias("ini"),
        (~F.col("text").rlike(f"[^{SPACE}]")).alias("blank"), F.col("text").rlike(rf"[.!?][{SPACE}]*\z").alias("ended"),
    )
    first = rows.groupBy("conv_id", "a", "b").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
    fault = F.when(F.col("blank"), 1).when(F.col("first").isNull(), 2).when(~F.col("ended"), 3).otherwise(0)
    out = rows.join(first, "at", "left").withColumn("fault", fault)
    code = F.col("ini") + F.when(F.col("fault").isin(1, 2), 4).when(F.col("fault") == 3, 8).otherwise(0)
    return out.select("conv_id", "at", code.cast("int").alias("code"), F.col("fault").cast("int").alias("fault"))


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two tables: (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of each conversation, and its repaired
    rows (conv_id, place, edit, turn, role, text); ``place`` sorts them, ``edit`` is K, R or I (with a null turn)."""
    ordered = in_order(rows)
    cut = table(blocks(with_faults(ordered).repartitionByRange("at").sortWithinPartitions("at")), "blocks")
    own = Window.partitionBy("conv_id").orderBy("at")
    before = F.lag("tail").over(own)
    legal = F.concat(before.cast("string"), F.col("head").cast("string")).isin("12", "23", "32")
    told = cut.withColumns({"opens": before.isNull(), "closes": F.lead("at").over(own).isNull(), "border": (~legal).cast("long")})
    told = table(told.withColumn("illegal", F.col("illegal") + F.coalesce("border", F.lit(0))), "borders")
    some = told.where("not (opens and closes)")  # conversations that lie in several blocks
    goals = some.select("conv_id", "at", "matrix").groupBy("conv_id").applyInPandas(_goals, "at long, goal array<long>")
    found = table(least_paths(told.join(goals, "at", "left")), "paths")
    entries = found.where("not alone").select("conv_id", "at", "entry", "leave").groupBy("conv_id").applyInPandas(_entries, "at long, entry int")
    taken = found.where("alone").unionByName(found.join(entries, ["at", "entry"], "left_semi"))
    taken = table(taken, "taken")

    zero = F.lit(0).cast("long")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    part = lambda df, audit, **own: df.select("conv_id", *[own.get(c, zero).alias(c) for c in counts], audit.alias("part"))
    none = F.lit(None).cast("struct<at:bigint,audit:string>")
    gaps = ordered.groupBy("conv_id").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), zero).cast("long").alias("gaps"))
    cost = taken.join(told.where("opens").select("at"), "at", "left_semi")
    sums = part(told, none, **{c: F.col(c) for c in counts[1:5]}).unionByName(part(gaps, none, gaps=F.col("gaps")))
    sums = sums.unionByName(part(cost, none, cost=F.col("cost"))).unionByName(part(taken, F.struct("at", "audit")))
    text = F.array_join(F.transform(F.array_sort(F.collect_list("part")), lambda p: p["audit"]), "")
    report = sums.groupBy("conv_id").agg(*[F.sum(c).alias(c) for c in counts], text.alias("audit"))

    edits = taken.select("conv_id", "at", F.posexplode("edits").alias("i", "e")).where("e.letter <> 'D'")
    place = F.struct(F.col("at").alias("block"), "i").alias("place")
    edits = edits.select("conv_id", place, F.col("e.letter").alias("edit"), F.col("e.role").alias("other"), F.col("e.at").alias("at"))
    stay = edits.where("edit <> 'I'").join(ordered.select("at", "turn", "role", "text"), "at")
    stay = stay.select("conv_id", "place", "edit", "turn", F.coalesce("other", "role").alias("role"), "text")
    new = edits.where("edit = 'I'").select("conv_id", "place", "edit", F.lit(None).cast(ordered.schema["turn"].dataType).alias("turn"), F.col("other").alias("role"), F.lit("").alias("text"))
    return report, stay.unionByName(new)


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text): the rows with the faults that the query's contract puts into them."""
    told = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", told("role").alias("role"), told("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def op11(spark, sf_dir: str) -> DataFrame:
    from twinspark.llm.common import read

    conversations = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    report, rows = repair(damaged(conversations))
    zero, counts = F.lit(0).cast("long"), ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    line = F.struct("place", F.concat("role", F.lit(":"), "text").alias("line"))
    none = F.lit(None).cast(rows.select(line.alias("line")).schema["line"].dataType)
    every = conversations.select("conv_id").distinct().select("conv_id", *[zero.alias(c) for c in counts], F.lit("").alias("audit"), none.alias("line"))
    every = every.unionByName(report.withColumn("line", none))
    every = every.unionByName(rows.select("conv_id", *[zero.alias(c) for c in counts], F.lit("").alias("audit"), line.alias("line")))
    text = F.array_join(F.transform(F.array_sort(F.collect_list("line")), lambda x: x["line"]), "\n")
    return every.groupBy("conv_id").agg(*[F.sum(c).alias(c) for c in counts], F.max("audit").alias("audit"), F.sha2(text, 256).alias("repaired_sha256"))


def _sql() -> str:
    def add(x: str, cost: str, letters: str) -> str:
        return f"CASE WHEN {x} = 'z' THEN 'z' ELSE printf('%08d', CAST(left({x}, 8) AS BIGINT) + {cost}) || substr({x}, 9) || '{letters}' END"

    def ins(s: list[str]) -> tuple[str, str]:
        u = f"least({s[2]}, {', '.join(add(s[i], '2', 'I') for i in (0, 1, 3))})"
        return u, f"least({s[3]}, {add(s[2], '2', 'I')}, {', '.join(add(s[i], '4', 'II') for i in (0, 1))})"

    s = [f"w.s{i}" for i in range(4)]
    u, a = ins(s)
    gone = [add(f"x.s{i}", "3", "D") for i in range(4)]
    keep = lambda i, ini: f"CASE WHEN live AND ini = '{ini}' THEN {add(f'x.s{i}', 'short', 'K')} ELSE 'z' END"
    role = lambda i: f"CASE WHEN live THEN {add(f'x.s{i}', '2 + short', 'R')} ELSE 'z' END"
    t = [gone[0], f"least({gone[1]}, {keep(0, 's')})", f"least({gone[2]}, {', '.join([*(keep(i, 'u') for i in (0, 1, 3)), *(role(i) for i in (0, 1, 3))])})", f"least({gone[3]}, {keep(2, 'a')}, {role(2)})"]
    key = "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"
    bit = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    for _ in range(7):
        bit = f"list_transform([{bit}], lambda x: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)[1]"
    return f"""WITH RECURSIVE crc AS (SELECT list({bit} ORDER BY x) AS t FROM range(256) r(x)),
o AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
 xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split({key}, ''), lambda c: CAST(ascii(c) AS BIGINT))), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS k FROM conversations, crc),
ids AS (SELECT conv_id, row_number() OVER () AS c FROM (SELECT DISTINCT conv_id FROM conversations)),
p AS (SELECT conv_id, turn, CASE k WHEN 4 THEN 'user' ELSE role END AS role, CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE k WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM o WHERE k <> 0),
q AS (SELECT c, turn, role, text, left(role, 1) AS ini, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM p JOIN ids ON p.conv_id IS NOT DISTINCT FROM ids.conv_id),
f AS (SELECT *, NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank, row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 AS again, lag(ini) OVER (PARTITION BY c ORDER BY i) || ini AS pair FROM q),
g AS (SELECT *, NOT blank AND again AS dup, CASE WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') AND NOT blank AND NOT again THEN 1 ELSE 0 END AS short, NOT blank AND NOT again AS live FROM f),
n AS (SELECT c, count(*) AS n, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE dup) AS dup, sum(short) AS short, count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal FROM g GROUP BY c),
w AS (SELECT c, CAST(0 AS BIGINT) AS i, '00000000' AS s0, 'z' AS s1, 'z' AS s2, 'z' AS s3 FROM n
 UNION ALL SELECT x.c, g.i, {t[0]}, {t[1]}, {t[2]}, {t[3]} FROM (SELECT w.c, w.i, w.s0, w.s1, {u} AS s2, {a} AS s3 FROM w) x JOIN g ON g.c = x.c AND g.i = x.i + 1),
z AS (SELECT w.c, least(s0, {a.replace("w.", "")}) AS best FROM w JOIN n ON w.c = n.c AND w.i = n.n),
e AS (SELECT c, j, l, count(*) FILTER (WHERE l <> 'I') OVER o AS i, count(*) FILTER (WHERE l <> 'D') OVER o AS m FROM (SELECT c, j, substr(best, 8 + CAST(j AS INTEGER), 1) AS l FROM (SELECT c, best, unnest(range(1, length(best) - 7)) AS j FROM z)) WINDOW o AS (PARTITION BY c ORDER BY j)),
h AS (SELECT e.c, j, l, m, role, text, max(CASE WHEN m = 1 AND l = 'K' AND ini = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY e.c) AS sys FROM e LEFT JOIN g ON e.c = g.c AND e.i = g.i AND l <> 'I' WHERE l <> 'D'),
y AS (SELECT c, string_agg(CASE WHEN l = 'K' THEN role WHEN (m - sys) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN l = 'I' THEN '' ELSE text END, chr(10) ORDER BY j) AS body FROM h GROUP BY c)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(dup, 0) AS BIGINT) AS duplicate, CAST(coalesce(short, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal,
CAST(coalesce(left(best, 8), '0') AS BIGINT) AS cost, coalesce(substr(best, 9), '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256 FROM ids LEFT JOIN n USING (c) LEFT JOIN z USING (c) LEFT JOIN y USING (c)"""


OP11_SQL = _sql()


def brute(rows: list[tuple[str, str]]) -> tuple[int, str, list[tuple[str, str]]]:
    """(cost, audit, repaired rows) of the (role, text) rows of a conversation in order, trying all edits; for tests."""
    import functools
    import re

    seen: set[tuple[str, str]] = set()
    told = []
    for r in rows:
        blank = not re.search(f"[^{SPACE}]", r[1])
        cut = not re.search(rf"[.!?][{SPACE}]*\Z", r[1])
        told.append((r, blank or r in seen, int(cut)))
        seen.add(r)
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    @functools.cache
    def best(i: int, state: str, inserts: int) -> tuple[int, str, tuple]:
        out = [(0, "", ())] if i == len(told) and state in ("", "a") else []
        add = lambda cost, letter, own, rest: out.append((cost + rest[0], letter + rest[1], own + rest[2]))
        if inserts < 3:
            for role in ("user", "assistant"):
                if (state, role[0]) in step:
                    add(2, "I", ((role, ""),), best(i, role[0], inserts + 1))
        if i < len(told):
            (role, text), gone, cut = told[i]
            add(3, "D", (), best(i + 1, state, 0))
            if not gone:
                if (state, role[:1]) in step:
                    add(cut, "K", ((role, text),), best(i + 1, step[state, role[:1]], 0))
                for to in ("user", "assistant"):
                    if (state, to[0]) in step:
                        add(2 + cut, "R", ((to, text),), best(i + 1, to[0], 0))
        return min(out, key=lambda x: x[:2]) if out else (FAR, "", ())

    cost, audit, own = best(0, "", 0)
    return cost, audit, list(own)
