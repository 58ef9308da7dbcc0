"""Chat formatting of reply trees.

A tree's messages point at their parents.  Self-joins with doubled steps give
each message the sum of the scores above it and its distance from the root, so
a tree of depth d takes log2(d) rounds; leaves, which stand for root-to-leaf
paths, are ranked by mean score; only for the chosen leaves do the same steps,
walked again, enumerate the messages of the path.  These rounds carry ids and
scores, never texts.  Each chosen path becomes one formatted conversation.

The template is ``<s>role``, line end, text, ``</s>``, line end, with the text
of a user in [INST] ... [/INST].  Inside a text, a control string gets a
backslash after its first character (one more where some are there already),
which reading back takes out again.  The loss mask is the list of spans, in
code points of the formatted text, that hold the texts of the trained role.

Defined cases: a null text is the empty text, a null role the empty role; rows
with a null tree id make one tree; a parent that doesn't exist makes its child
a root; messages from which no root can be reached (cycles) are on no path; of
several messages with one id the first by parent, role and text counts; equal
scores rank by leaf id; an empty table gives an empty result; other columns
are ignored.  A conversation is one output row and so must fit in memory.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, forget

# Control strings that no text may hold after escaping.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>")
_REST = {c: "|".join(re.escape(x[1:]) for x in CONTROLS if x[0] == c) for c in "<["}
_CONTROL = re.compile("|".join(rf"(?<={re.escape(c)})(?=\\*(?:{rest}))" for c, rest in _REST.items()))
_ESCAPED = re.compile("|".join(rf"(?<={re.escape(c)})\\(?=\\*(?:{rest}))" for c, rest in _REST.items()))
_TURN = re.compile(r"<s>([^\n]*)\n(.*?)</s>\n", re.S)
TRAINED = "assistant"


def escape(text: str) -> str:
    return _CONTROL.sub(r"\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub("", text)


def format_turns(turns, trained: str = TRAINED) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text of (role, text) pairs and the spans under the loss mask."""
    out, at, spans = [], 0, []
    for role, text in turns:
        head = "<s>" + escape(role.replace("\\", "\\\\").replace("\n", "\\n")) + "\n"
        before, after = ("[INST] ", " [/INST]</s>\n") if role == "user" else ("", "</s>\n")
        body = escape(text)
        if role == trained:
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, before, body, after]
        at += len(head) + len(before) + len(body) + len(after)
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) pairs of a formatted text."""
    turns = []
    for role, body in _TURN.findall(formatted):
        role = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))
        turns.append((role, unescape(body[len("[INST] ") : -len(" [/INST]")] if role == "user" else body)))
    return turns


def chains(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """Plain conversations as reply trees: each row answers the one before it, by turn (ties by role and text)."""
    order = Window.partitionBy(id_col).orderBy(turn_col, "role", "text")
    node = F.row_number().over(order).cast("long")
    return rows.select(F.col(id_col).alias("tree"), node.alias("node"), F.lit(0.0).alias("score"), "role", "text").withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1))


def conversations(messages: DataFrame, top: int = 1) -> DataFrame:
    """messages: tree, node, parent, score, role, text.  Of each tree, the ``top`` paths: tree, leaf, rank, turns."""
    kind = messages.schema["tree"].dataType.simpleString()
    tree = F.when(F.col("tree").isNull(), "-").otherwise(F.concat(F.lit("+"), F.col("tree").cast("string")))
    first = Window.partitionBy("tree", "node").orderBy("parent", "role", "text")
    rows = messages.filter(F.col("node").isNotNull()).select(tree.alias("tree"), "node", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("one", F.row_number().over(first)).filter("one = 1").drop("one")
    ids = cut(rows.select("tree", "node", "parent", "score"), "chat-ids")
    own = ids.select("tree", F.col("node").alias("parent")).withColumn("known", F.lit(True))
    # A step leads from a message to the one ``dist`` above it; ``total`` sums the scores passed on the way.
    step = cut(ids.join(own, ["tree", "parent"], "left").select("tree", "node", F.when(F.col("known"), F.col("parent")).alias("up"), F.col("score").alias("total"), F.lit(1).cast("long").alias("dist")), "chat-steps")
    # ``ended`` holds the messages whose steps have passed the root; only the others go on.
    steps, ended, n = [], step.filter("up is null"), ids.count()
    while not step.filter("up is not null").isEmpty() and (1 << len(steps)) <= 2 * n:
        steps.append(step)
        going = step.filter("up is not null")
        above = ended.unionByName(going).select("tree", F.col("node").alias("up"), F.col("up").alias("up2"), F.col("total").alias("total2"), F.col("dist").alias("dist2"))
        joined = going.join(above, ["tree", "up"])
        step = cut(joined.select("tree", "node", F.col("up2").alias("up"), (F.col("total") + F.col("total2")).alias("total"), (F.col("dist") + F.col("dist2")).alias("dist")), "chat-steps")
        ended = ended.unionByName(step.filter("up is null"))
    inner = ids.filter("parent is not null").select("tree", F.col("parent").alias("node")).distinct()
    leaves = ended.join(inner, ["tree", "node"], "left_anti")
    ranked = Window.partitionBy("tree").orderBy(F.desc(F.col("total") / F.col("dist")), "node")
    chosen = leaves.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= top)
    path = cut(chosen.select("tree", F.col("node").alias("leaf"), "rank", "node", F.lit(0).cast("long").alias("above")), "chat-paths")
    for k, s in enumerate(steps):
        # Messages so far are those less than 2**k above the leaf; each sends one 2**k above itself.
        more = path.join(s.filter("up is not null").select("tree", "node", "up"), ["tree", "node"]).select("tree", "leaf", "rank", F.col("up").alias("node"), (F.col("above") + (1 << k)).alias("above"))
        longer = cut(path.unionByName(more), "chat-paths")
        forget(path)
        path = longer
    told = path.join(rows, ["tree", "node"]).groupBy("tree", "leaf", "rank").agg(F.array_sort(F.collect_list(F.struct((-F.col("above")).alias("k"), "role", "text"))).alias("turns"))
    back = F.when(F.col("tree") != "-", F.substring("tree", 2, 1 << 30)).cast(kind)
    return formatted(told.select(back.alias("tree"), "leaf", "rank", F.col("turns.role").alias("roles"), F.col("turns.text").alias("texts")))


def formatted(told: DataFrame, trained: str = TRAINED) -> DataFrame:
    """tree, leaf, rank, roles, texts to tree, leaf, rank, formatted, loss (spans)."""

    def run(batches):
        for batch in batches:
            pairs = [format_turns(zip(r, t, strict=True), trained) for r, t in zip(batch[3].to_pylist(), batch[4].to_pylist(), strict=True)]
            texts = pa.array([x for x, _ in pairs], pa.string())
            spans = pa.array([[{"start": a, "end": b} for a, b in s] for _, s in pairs], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            yield pa.RecordBatch.from_arrays([batch[0], batch[1], batch[2], texts, spans], ["tree", "leaf", "rank", "formatted", "loss"])

    kind = told.schema["tree"].dataType.simpleString()
    leaf = told.schema["leaf"].dataType.simpleString()
    return told.mapInArrow(run, f"tree {kind}, leaf {leaf}, rank int, formatted string, loss array<struct<start: long, end: long>>")


def read_back(conversations: DataFrame, id_col: str) -> DataFrame:
    """Digests of formatted conversations, from the formatted text and its mask alone."""

    def run(batches):
        for batch in batches:
            out = []
            for text, spans in zip(batch[1].to_pylist(), batch[2].to_pylist(), strict=True):
                turns = parse(text)
                told = "".join(f"{role}\n{body}\n" for role, body in turns)
                loss = "".join(unescape(text[s["start"] : s["end"]]) for s in spans)
                out.append((len(turns), hashlib.sha256(told.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch[0], *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], [id_col, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    kind = conversations.schema[id_col].dataType.simpleString()
    return conversations.select(id_col, "formatted", "loss").mapInArrow(run, f"`{id_col}` {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
