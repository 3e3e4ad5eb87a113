"""Line dedup by a log-template tree, with DataFrame functions only.

Lines are parsed to a fixed depth: token count, then the three leading tokens, tokens with digits
being fields. Under a leaf, a position is constant if one token holds in nine of ten texts; a leaf of
at least five positions of which at least four fifths, but not all, are constant is a template with
variable fields, and lines that agree with its constants belong to it. A leaf that is none is split by
its most telling position, the one with the fewest tokens that isn't constant, and its parts are
tested in turn, ``SPLITS`` times at most. Any other line is its own template (digits masked).

A template that recurs in ``min_docs`` different texts is boilerplate. Boilerplate goes, but the text
with the smallest doc_id keeps its line, so nothing is lost for good. Texts that consist of such lines
for the most part, by tokens, are copies as a whole: they stay as they are, for near-duplicate
removal. Exact copies of a text count as one text and are treated alike.

Edge cases: a null text stays null and has no lines; blank lines are never dropped; null ids sort
first; repeated rows are copies; an empty table gives an empty result; other columns pass through,
whatever their names (one that is called like ``into`` gives way to it).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinspark.shared import settled, table

MIN_DOCS = 10
LEAD = 3
SAME = 0.9  #: share of texts in which a constant position has its token
CONSTANT = 0.8  #: share of positions that are constant in a template with fields
LEAST = 5  #: positions of a template with fields
SPLITS = 3  #: times that a leaf is split
WHOLE = 0.5  #: share of a text's tokens in recurring lines from which on it is a copy as a whole
NODE_BITS = 20  #: nodes with fields are pre-filtered by so many bits of their hash; at most 2^20 rows are broadcast


def masked(line: Column) -> Column:
    """The line with single spaces, and ``<*>`` for tokens with digits."""
    odd = [F.contains(line, F.lit(x)) for x in ("  ", "\t", "\r", "\x0b", "\x0c")]
    untidy = odd[0] | odd[1] | odd[2] | odd[3] | odd[4]
    spaced = F.trim(F.when(untidy, F.regexp_replace(line, r"[\x09\x0B-\x0D ]+", " ")).otherwise(line))
    return F.when(spaced.rlike("[0-9]"), F.regexp_replace(spaced, "[^ ]*[0-9][^ ]*", "<*>")).otherwise(spaced)


def masked_lines(text: Column) -> Column:
    """The lines of a text, each as ``masked`` gives it: spaces are put right in the whole text."""
    odd = [F.contains(text, F.lit(x)) for x in ("  ", "\t", "\r", "\x0b", "\x0c")]
    untidy = odd[0] | odd[1] | odd[2] | odd[3] | odd[4]
    spaced = F.when(untidy, F.regexp_replace(text, r"[\x09\x0B-\x0D ]+", " ")).otherwise(text)
    fields = lambda x: F.when(x.rlike("[0-9]"), F.regexp_replace(x, "[^ ]*[0-9][^ ]*", "<*>")).otherwise(x)
    return F.transform(F.transform(F.split(spaced, "\n"), lambda x: F.trim(x)), fields)


def _size(line: Column) -> Column:
    """Tokens of a masked line."""
    return F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit(""))) + 1


def _lead(line: Column) -> Column:
    return F.xxhash64(F.substring_index(line, " ", LEAD))


def _parsed(docs: DataFrame) -> DataFrame:
    """(a, b, first, tpl, node, n) of each line of texts that are there; only hashes leave the row."""
    parts = masked_lines(F.col("text"))
    parsed = F.transform(parts, lambda x: F.struct(F.xxhash64(x).alias("tpl"), _lead(x).alias("lead"), _size(x).alias("n"), (x == "").alias("blank")))
    named = docs.where("text is not null").select(F.xxhash64("text").alias("a"), F.xxhash64(F.lit(7), "text").alias("b"), F.col("doc_id").alias("first"), parsed.alias("p"))
    rows = named.select("a", "b", "first", F.explode("p").alias("x"))
    return rows.where("not x.blank").select("a", "b", "first", "x.tpl", F.xxhash64("x.n", "x.lead").alias("node"), "x.n")


def _texts(docs: DataFrame) -> DataFrame:
    """(a, b, line): masked lines that aren't blank."""
    parts = masked_lines(F.col("text"))
    named = docs.where("text is not null").select(F.xxhash64("text").alias("a"), F.xxhash64(F.lit(7), "text").alias("b"), F.explode(parts).alias("line"))
    return named.where("line <> ''")


def _members(tokens: DataFrame, min_docs: int) -> DataFrame:
    """(node, tpl, texts, pos, token) to (tpl, tid): lines that belong to a template with fields."""
    found = None
    for turn in range(SPLITS + 1):
        each = tokens.groupBy("node", "pos", "token").agg(F.sum("texts").alias("k"))
        held = each.groupBy("node", "pos").agg(F.max_by("token", F.struct("k", "token")).alias("top"), (F.max("k") >= SAME * F.sum("k")).alias("same"), F.count("*").alias("tokens"), F.sum("k").alias("texts"))
        held = table(held, "positions")
        size = held.groupBy("node").agg(F.count("*").alias("n"), F.count_if("same").alias("c"), F.max("texts").alias("texts"), F.min(F.when(~F.col("same"), F.struct("tokens", "pos"))).alias("split"))
        open_ = size.where((F.col("c") < F.col("n")) & (F.col("texts") >= min_docs))
        done = held.where("same").select("node", "pos", F.col("top").alias("token")).join(open_.where(F.col("c") >= CONSTANT * F.col("n")).select("node", "c"), "node")
        own = tokens.join(done, ["node", "pos", "token"]).groupBy("node", "tpl").agg(F.count("*").alias("hits"), F.max("c").alias("c")).where("hits = c")
        own = own.select("tpl", F.col("node").alias("tid"))
        found = own if found is None else found.unionByName(own)
        if turn < SPLITS:
            part = open_.where(F.col("c") < CONSTANT * F.col("n")).select("node", F.col("split.pos").alias("pos"))
            part = tokens.join(part, ["node", "pos"]).select("node", "tpl", F.xxhash64("node", "pos", "token").alias("part"))
            tokens = table(tokens.join(part, ["node", "tpl"]).select(F.col("part").alias("node"), "tpl", "texts", "pos", "token"), "tokens")
    return found


def templates(docs: DataFrame, min_docs: int = MIN_DOCS) -> tuple[DataFrame, DataFrame]:
    """(a, b, tpl, tid, whole) of the lines of each text, whether it is a copy as a whole, and (tid, least) of the templates that recur: their first text."""
    lines = _parsed(docs).groupBy("a", "b", "tpl", "node", "n").agg(F.min("first").alias("first"), F.count("*").alias("times"))
    lines = table(lines, "lines")
    # nodes that may have fields: enough texts, more than one line
    own = lines.where(F.col("n") >= LEAST).groupBy("node")
    nodes = own.agg(F.count("*").alias("rows"), F.min("tpl").alias("x"), F.max("tpl").alias("y")).where((F.col("rows") >= min_docs) & (F.col("x") != F.col("y")))
    nodes = table(nodes.select("node", F.shiftrightunsigned("node", 64 - NODE_BITS).cast("int").alias("bits")), "nodes")
    some = F.broadcast(nodes.select("bits").distinct())
    near = _texts(docs).withColumn("node", F.xxhash64(_size(F.col("line")), _lead(F.col("line")))).withColumn("bits", F.shiftrightunsigned("node", 64 - NODE_BITS).cast("int"))
    near = near.select("a", "b", "node", "bits", "line").join(some, "bits", "left_semi").join(nodes.select("node"), "node", "left_semi")
    near = near.groupBy("node", "line").agg(F.countDistinct("a", "b").alias("texts"))
    tokens = table(near.select("node", F.xxhash64("line").alias("tpl"), "texts", F.posexplode(F.split("line", " ")).alias("pos", "token")), "tokens")
    lines = lines.drop("node").join(_members(tokens, min_docs), "tpl", "left").withColumn("tid", F.struct(F.coalesce("tid", "tpl").alias("h"), F.col("tid").isNotNull().alias("fields")))
    lines = table(lines, "templates")
    texts = lines.groupBy("tid", "a", "b").agg(F.min("first").alias("first"))
    count = texts.groupBy("tid").agg(F.count("*").alias("texts"), F.min(F.struct("first", "a", "b")).alias("least")).where(F.col("texts") >= min_docs)
    return lines, table(count.select("tid", "least"), "recurring")


def _gone(docs: DataFrame, min_docs: int) -> DataFrame:
    """(a, b, gone): the templates of which a text loses its lines."""
    lines, recurring = templates(docs, min_docs)
    tokens = F.col("n") * F.col("times")
    gone = lines.join(recurring, "tid", "left").groupBy("a", "b").agg(
        F.sum(tokens).alias("all"), F.sum(F.when(F.col("least").isNotNull(), tokens).otherwise(0)).alias("again"),
        F.collect_set(F.when((F.col("a") != F.col("least.a")) | (F.col("b") != F.col("least.b")), F.col("tpl"))).alias("gone"),
    )
    return gone.where((F.col("again") < WHOLE * F.col("all")) & (F.size("gone") > 0)).select("a", "b", "gone")


def line_dedup(docs: DataFrame, min_docs: int = MIN_DOCS, into: str = "lines") -> DataFrame:
    """``docs`` with boilerplate lines dropped from ``text``, and ``n_lines`` and ``n_dropped`` in the struct ``into``.

    Lazy but for the lines that go, the one table that stays: texts are read again when the result is written.
    """
    gone = settled(docs.sparkSession, "gone", lambda: _gone(docs, min_docs))
    keyed = docs.select(F.struct("*").alias("d"), F.xxhash64("text").alias("a"), F.xxhash64(F.lit(7), "text").alias("b")).join(gone, ["a", "b"], "left")
    parts = F.split("d.text", "\n")
    kept = F.filter(parts, lambda x: ~F.array_contains("gone", F.xxhash64(masked(x))))
    out = keyed.withColumn("kept", F.when(F.col("gone").isNotNull(), kept))
    n = F.when(F.col("d.text").isNull(), 0).otherwise(F.size(parts)).cast("long")
    info = F.struct(n.alias("n_lines"), F.when(F.col("kept").isNull(), 0).otherwise(n - F.size("kept")).cast("long").alias("n_dropped"))
    text = F.when(F.col("kept").isNull(), F.col("d.text")).otherwise(F.array_join("kept", "\n"))
    cols = [text.alias("text") if c == "text" else F.col("d").getField(c).alias(c) for c in docs.columns if c.lower() != into.lower()]
    return out.select(*cols, info.alias(into))


def op7(spark, sf_dir: str) -> DataFrame:
    from twinspark.llm.common import read

    out = line_dedup(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "lines.n_lines", "lines.n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def _sql() -> str:
    """The operator in DuckDB's SQL; the rounds of the tree one after another."""
    rounds = []
    for r in range(SPLITS + 1):
        rounds.append(f"""
g{r} AS (SELECT node, pos, token, sum(texts) AS k FROM f{r} GROUP BY node, pos, token),
c{r} AS (SELECT node, pos, arg_max(token, (k, token)) AS token, max(k) >= {SAME} * sum(k) AS same, count(*) AS tokens, sum(k) AS texts FROM g{r} GROUP BY node, pos),
z{r} AS (SELECT node, count(*) AS n, count(*) FILTER (WHERE same) AS c, min((tokens, pos)) FILTER (WHERE NOT same) AS split FROM c{r} GROUP BY node
      HAVING count(*) FILTER (WHERE same) < count(*) AND max(texts) >= {MIN_DOCS}),
m{r} AS (SELECT f.line, f.node FROM f{r} f JOIN c{r} c ON f.node = c.node AND f.pos = c.pos AND f.token = c.token AND c.same JOIN z{r} z ON z.node = f.node AND z.c >= {CONSTANT} * z.n
        GROUP BY f.line, f.node, z.c HAVING count(*) = z.c),""")
        if r < SPLITS:
            rounds.append(f"""
p{r} AS (SELECT f.node, f.line, f.node || '/' || CAST(f.pos AS VARCHAR) || ' ' || f.token AS part FROM f{r} f JOIN z{r} z ON z.node = f.node AND z.c < {CONSTANT} * z.n AND f.pos = z.split[2]),
f{r + 1} AS (SELECT p.part AS node, f.line, f.texts, f.pos, f.token FROM f{r} f JOIN p{r} p ON f.node = p.node AND f.line = p.line),""")
    return rf"""
WITH t AS (SELECT text, min(doc_id) AS first FROM documents WHERE text IS NOT NULL GROUP BY text),
p AS (SELECT text, first, string_split(text, chr(10)) AS parts FROM t),
u AS (SELECT text, first, parts, unnest(range(1, len(parts) + 1)) AS pos FROM p),
q AS (SELECT text, first, pos, parts[pos] AS raw,
        trim(regexp_replace(parts[pos], '[\x09\x0B-\x0D ]+', ' ', 'g'), ' ') AS s FROM u),
m AS (SELECT *, CASE WHEN regexp_matches(s, '[0-9]') THEN regexp_replace(s, '[^ ]*[0-9][^ ]*', '<*>', 'g') ELSE s END AS line FROM q),
l AS (SELECT *, string_split(line, ' ') AS toks, len(string_split(line, ' ')) AS n,
        CAST(len(string_split(line, ' ')) AS VARCHAR) || ' ' || array_to_string(string_split(line, ' ')[1:{LEAD}], ' ') AS node
      FROM m WHERE line <> ''),
tok AS (SELECT node, line, count(DISTINCT text) AS texts, any_value(toks) AS toks, any_value(n) AS n FROM l GROUP BY node, line),
nodes AS (SELECT node FROM l WHERE n >= {LEAST} GROUP BY node HAVING count(DISTINCT (text, line)) >= {MIN_DOCS} AND count(DISTINCT line) > 1),
e AS (SELECT node, line, texts, unnest(range(1, n + 1)) AS pos, toks FROM tok WHERE node IN (SELECT node FROM nodes)),
f0 AS (SELECT node, line, texts, pos, toks[pos] AS token FROM e),{''.join(rounds)}
mem AS ({' UNION ALL '.join(f'SELECT line, node FROM m{r}' for r in range(SPLITS + 1))}),
r AS (SELECT l.*, coalesce('n' || mem.node, 'l' || l.line) AS tid FROM l LEFT JOIN mem ON l.line = mem.line),
x AS (SELECT tid, text, min(first) AS first FROM r GROUP BY tid, text),
cnt AS (SELECT tid, arg_min(text, first) AS least FROM x GROUP BY tid HAVING count(*) >= {MIN_DOCS}),
o AS (SELECT text FROM r LEFT JOIN cnt ON r.tid = cnt.tid GROUP BY text HAVING sum(CASE WHEN least IS NULL THEN 0 ELSE n END) < {WHOLE} * sum(n)),
gone AS (SELECT DISTINCT r.text, r.pos FROM r JOIN cnt ON r.tid = cnt.tid AND r.text <> cnt.least JOIN o ON o.text = r.text),
k AS (SELECT m.text, coalesce(string_agg(m.raw, chr(10) ORDER BY m.pos) FILTER (WHERE gone.pos IS NULL), '') AS kept,
             count(*) AS n_lines, count(gone.pos) AS n_dropped
      FROM m LEFT JOIN gone ON m.text = gone.text AND m.pos = gone.pos GROUP BY m.text)
SELECT doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_dropped, 0) AS BIGINT) AS n_dropped,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN k ON documents.text = k.text
"""


OP7_SQL = _sql()
