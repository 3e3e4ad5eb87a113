"""Chat formatting by event-sourced reconstruction.

A log holds the events of conversations, each conversation with one sequence of numbers: ``delta``
appends streamed text to a message, ``edit`` replaces the message's text, ``regenerate`` throws away
what the message has so far, and what messages after it have. The log is partitioned by conversation
and sorted by sequence; an event counts if no regeneration of its own or an earlier message and no edit
of its own follows, and what counts is concatenated. Messages without such events are gone. The rest
are rendered as

    ### role: text</turn>

with every backslash, ``#``, ``<`` and (in roles) ``:`` of the contents written as a backslash and a
letter, so that no content can look like the template; ``read_back`` undoes it exactly. The loss mask
is the list of places of the assistants' texts in the rendered string.

Events are put together by message first, so that a long conversation is many rows; places in the
rendered string are running sums over its messages.

Edge cases: null texts are empty, a null role is the empty role; a null conversation is one of its
own, a null turn comes first; rows of the same turn are messages of their own, by role and then text;
a conversation without events doesn't come back; ids may be numbers or strings; an empty table gives an
empty result; other columns don't matter.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = 240  #: characters of a streamed delta
END = "</turn>\n"
_BACK = {"b": "\\", "h": "#", "l": "<", "c": ":"}


def escape(c: Column, role: bool = False) -> Column:
    for plain, letter in [("\\", "b"), ("#", "h"), ("<", "l")] + [(":", "c")] * role:
        c = F.replace(c, F.lit(plain), F.lit("\\" + letter))
    return c


def unescape(text: str) -> str:
    return re.sub(r"\\([bhlc])", lambda m: _BACK[m[1]], text)


def messages(events: DataFrame) -> DataFrame:
    """(conv_id, seq, turn, part, role, kind, text) to (conv_id, turn, part, role, text): the log folded to messages; ``seq`` is unique in a conversation."""
    key = ["conv_id", "turn", "part", "role"]
    event = F.struct("seq", "kind", F.coalesce("text", F.lit("")).alias("text"))
    last = lambda kind: F.max(F.when(F.col("kind") == kind, F.col("seq")))
    rows = events.groupBy(*key).agg(F.array_sort(F.collect_list(event)).alias("log"), F.max("seq").alias("end"), last("regenerate").alias("void"), last("edit").alias("edit"))
    upto = Window.partitionBy("conv_id").orderBy("turn", "part").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("void", F.coalesce(F.max("void").over(upto), F.lit(-1))).where("end >= void")
    live = F.filter("log", lambda e: (e["seq"] > F.col("void")) & (F.col("edit").isNull() | (e["seq"] >= F.col("edit"))))
    return rows.select(*key, F.array_join(F.transform(live, lambda e: e["text"]), "").alias("text"))


def render(rows: DataFrame) -> DataFrame:
    """Messages to (conv_id, formatted, mask): the template's text, and (start, length) of what the loss counts, in characters."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit("### "), escape(role, True), F.lit(": "))
    own = rows.select("conv_id", "turn", "part", head.alias("head"), escape(text).alias("body"), (role == "assistant").alias("loss"))
    before = Window.partitionBy("conv_id").orderBy("turn", "part").rowsBetween(Window.unboundedPreceding, -1)
    size = F.length("head") + F.length("body") + len(END)
    own = own.withColumn("start", F.coalesce(F.sum(size).over(before), F.lit(0)) + F.length("head"))
    told = F.struct("turn", "part", "loss", "start", F.length("body").cast("long").alias("length"), F.concat("head", "body", F.lit(END)).alias("whole"))
    ms = own.groupBy("conv_id").agg(F.array_sort(F.collect_list(told)).alias("ms"))
    mask = F.transform(F.filter("ms", lambda m: m["loss"]), lambda m: F.struct(m["start"].alias("start"), m["length"].alias("length")))
    return ms.select("conv_id", F.array_join(F.transform("ms", lambda m: m["whole"]), "").alias("formatted"), mask.alias("mask"))


def read_back(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a rendered conversation."""
    out = []
    for part in formatted.split(END)[:-1]:
        role, _, text = part.removeprefix("### ").partition(": ")
        out.append((unescape(role), unescape(text)))
    return out


def digests(rendered: DataFrame) -> DataFrame:
    """What the rendered strings hold, read back from them."""
    names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for b in batches:
            rows = []
            for text, mask in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                turns = read_back(text)
                loss = "".join(unescape(text[m["start"] : m["start"] + m["length"]]) for m in mask)
                rows.append((len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), len(text)))
            cols = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.string() if "sha" in n else pa.int64()) for c, n in zip(cols, names, strict=True))], ["conv_id", *names])

    kind = rendered.schema["conv_id"].dataType.simpleString()
    return rendered.select("conv_id", "formatted", "mask").mapInArrow(run, f"conv_id {kind}, " + ", ".join(f"{n} {'string' if 'sha' in n else 'long'}" for n in names))


def as_events(conversations: DataFrame) -> DataFrame:
    """A log that a chat service could have written for these messages: streamed deltas, every third message
    regenerated after a false start, every fifth typed first and then edited; numbered through each conversation."""
    rows = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    number = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", F.coalesce("role", F.lit("")), F.md5("text"))).cast("long")
    rows = rows.withColumn("part", number)
    ev = lambda seq, kind, t: F.struct(F.lit(seq).cast("long").alias("seq"), F.lit(kind).alias("kind"), t.alias("text"))
    h = F.pmod(F.xxhash64("conv_id", "turn", "part"), F.lit(15))
    false_start = F.array(ev(0, "delta", F.substring("text", 1, 40)), ev(1, "delta", F.lit(" ...")), ev(2, "regenerate", F.lit("")))
    none = F.array().cast("array<struct<seq:bigint,kind:string,text:string>>")
    deltas = F.transform(F.sequence(F.lit(0), F.ceil((F.length("text") + 1) / CHUNK).cast("int") - 1), lambda i: F.struct((i + 10).cast("long").alias("seq"), F.lit("delta").alias("kind"), F.substr("text", i * CHUNK + 1, F.lit(CHUNK)).alias("text")))
    edited = F.array(ev(10, "delta", F.lit("draft")), ev(11, "edit", F.col("text")))
    log = F.concat(F.when(h % 3 == 0, false_start).otherwise(none), F.when(h % 5 == 0, edited).otherwise(deltas))
    seq = F.shiftleft("part", 32) + F.col("e.seq")
    return rows.withColumn("e", F.explode(log)).select("conv_id", seq.alias("seq"), "turn", "part", "role", "e.kind", "e.text")


def op9(spark, sf_dir: str) -> DataFrame:
    from twinspark.llm.common import read

    told = read(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    same = r"\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", same), (-7, 1, "assistant", same)], "conv_id long, turn long, role string, text string")
    return digests(render(messages(as_events(told.unionByName(more)))))


OP9_SQL = r"""
WITH c AS (SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, '### ' || replace(replace(replace(replace(role, '\', '\b'), '#', '\h'), '<', '\l'), ':', '\c') || ': '
        || replace(replace(replace(text, '\', '\b'), '#', '\h'), '<', '\l') || '</turn>' || chr(10) AS f FROM c)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, md5(text))) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, md5(text)) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(f)) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
