"""Chat formatting of reply trees.

A tree's nodes have an id, a parent (null at a root), a role, a text and a score. Root-to-leaf paths
are enumerated by iterative self-joins with doubling: after k joins every path holds its 2^k last
nodes, so that a chain of n turns takes log2(n) joins; pointers are doubled first, and what they never
lead to a root is left out before paths grow. Branches of a root are ranked by the sum of
their scores; each chosen path is formatted as one conversation.

A turn is ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and texts a backslash goes before
each backslash and behind the first character of each control string, so that none is left whole for
a tokenizer to find (and before a role's line breaks); a reader takes it away again.
The loss mask holds the spans of assistants' texts in the formatted string.

Defined results: null texts and roles are empty; a node whose parent isn't in the table is a root;
a node that is its own parent is a root; nodes on a cycle of two or more have no root, so that neither
they nor those that hang on them are on any path; ties in score go to the smaller leaf; an empty
table gives no rows. One conversation's text is one string and so meets in one task.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mesaquery.llm.common import drop, saved

START, END = "<|im_start|>", "<|im_end|>"
#: Control strings of this and other common templates.
CONTROLS = (START, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_ESCAPED = re.compile("|".join(map(re.escape, ("\\", *CONTROLS))))
_TURN = re.compile(re.escape(START) + r"((?:\\.|[^\\\n])*)\n((?:\\.|[^\\])*?)" + re.escape(END) + "\n", re.DOTALL)


def escape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\\\\" if m[0] == "\\" else m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def format_turns(turns: list[tuple[str | None, str | None]], learned: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and its loss mask: spans [start, end) in code points."""
    out, at, mask = [], 0, []
    for role, text in turns:
        head = START + escape(role or "").replace("\n", "\\\n") + "\n"
        body = escape(text or "")
        if role == learned:
            mask.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, END, "\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(out), mask


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns that a formatted conversation was made of."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def paths(nodes: DataFrame, best: int | None = None) -> DataFrame:
    """Rows (leaf, root, rank, dist, node) of ``nodes`` (node, parent, score): each path's nodes.

    ``dist`` counts from the leaf. ``best`` keeps so many branches of each root; null keeps all.
    """
    nodes = saved(nodes.select("node", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score")), "nodes")
    ids = nodes.select(F.col("node").alias("parent"))
    # ups[k] has each node's ancestor 2^k above it, and only nodes that have one.
    ups = [saved(nodes.select("node", "parent").join(ids, "parent").select("node", F.col("parent").alias("above")).where("node <> above"), "up")]
    most = ups[0].count()
    while not ups[-1].isEmpty() and 1 << (len(ups) - 1) <= most:
        ups.append(saved(ups[-1].join(ups[-1].select(F.col("node").alias("above"), F.col("above").alias("next")), "above").select("node", F.col("next").alias("above")), "up"))
    # A node with more nodes above it than have a parent at all is on a cycle, or hangs on one.
    endless = ups[-1].select("node")
    leaves = nodes.select("node").join(ups[0].select(F.col("above").alias("node")).distinct(), "node", "left_anti").join(endless, "node", "left_anti")
    path = saved(leaves.select(F.col("node").alias("leaf"), F.lit(0).alias("dist"), "node"), "paths")
    for k, up in enumerate(ups[:-1]):
        longer = saved(path.union(path.join(up, "node").select("leaf", (F.col("dist") + (1 << k)).alias("dist"), F.col("above").alias("node"))), "paths")
        drop(path, up)
        path = longer
    drop(ups[-1])
    scored = path.join(nodes.select("node", "score"), "node")
    of_leaf = scored.groupBy("leaf").agg(F.sum("score").alias("total"), F.max("dist").alias("depth"))
    roots = path.select("leaf", F.col("dist").alias("depth"), F.col("node").alias("root"))
    ranked = of_leaf.join(roots, ["leaf", "depth"]).withColumn("rank", F.row_number().over(Window.partitionBy("root").orderBy(F.desc("total"), "leaf")))
    chosen = ranked if best is None else ranked.where(F.col("rank") <= best)
    return path.join(chosen.select("leaf", "root", "rank"), "leaf").select("leaf", "root", "rank", "dist", "node")


def format_trees(nodes: DataFrame, best: int | None = None) -> DataFrame:
    """conv, rank, formatted text and loss mask of each chosen path of nodes (conv, node, parent, role, text, score)."""
    nodes = saved(nodes.select("conv", "node", "parent", "role", "text", "score"), "turns")
    lines = paths(nodes, best).join(nodes.select("node", "conv", "role", "text"), "node")
    convs = lines.groupBy("conv", "leaf", "rank").agg(F.array_sort(F.collect_list(F.struct((-F.col("dist")).alias("at"), "role", "text"))).alias("turns"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [format_turns([(t["role"], t["text"]) for t in turns]) for turns in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_pydict({"conv": batch.column(0), "rank": batch.column(1), "formatted": pa.array([x for x, _ in made], pa.string()), "loss_mask": pa.array([[{"start": a, "end": b} for a, b in m] for _, m in made], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))})

    kind = dict(nodes.dtypes)["conv"]
    return convs.select("conv", "rank", "turns").mapInArrow(write, f"conv {kind}, rank int, formatted string, loss_mask array<struct<start:bigint,end:bigint>>")


def digests(formatted: DataFrame) -> DataFrame:
    """What is read back from formatted conversations, as counts and digests."""
    sha = lambda text: hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for conv, text, mask in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                turns = parse_turns(text)
                loss = "".join(unescape(text[m["start"] : m["end"]]) for m in mask)
                rows.append({"conv_id": conv, "n_turns": len(turns), "turns_sha256": sha("".join(f"{r}\n{t}\n" for r, t in turns)), "loss_chars": len(loss), "loss_sha256": sha(loss), "formatted_chars": len(text)})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]))

    return formatted.select("conv", "formatted", "loss_mask").mapInArrow(read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def chains(conversations: DataFrame) -> DataFrame:
    """Conversations by turn as trees of one branch; equal turns follow by role and text.

    Rows without a conversation id form one conversation of their own.
    """
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv"), "turn", "role", "text")
    at = F.row_number().over(Window.partitionBy("conv").orderBy("turn", "role", "text"))
    node = lambda n: F.concat_ws("/", F.coalesce(F.col("conv").cast("string"), F.lit("-")), n.cast("string"))
    rows = rows.withColumn("at", at)
    return rows.select("conv", node(F.col("at")).alias("node"), F.when(F.col("at") > 1, node(F.col("at") - 1)).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


#: The digests of conversations as chains, and of one whose texts are control strings.
ORACLE_SQL = r"""
WITH c AS (SELECT conv_id, turn, role, text FROM conversations UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
x AS (SELECT conv_id, turn, role, coalesce(role, '') AS r, coalesce(text, '') AS t, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS i FROM c),
n AS (SELECT *, length(r) + length(t) + len(regexp_extract_all(r || chr(10) || t, '\\|<\|im_start\|>|<\|im_end\|>|<\|endoftext\|>|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>')) + length(r) - length(replace(r, chr(10), '')) + 24 AS chars FROM x)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns, sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY i)) AS turns_sha256,
 CAST(coalesce(sum(length(t)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars, sha256(coalesce(string_agg(t, '' ORDER BY i) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256, CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM n GROUP BY conv_id
"""
