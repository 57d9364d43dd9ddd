"""Chat formatting into a prefix tree.

Conversations that begin with the same turns share those turns: each distinct beginning
is one node, emitted once.  Nodes stand in depth-first order, children by their smallest
conversation, and a node's tokens follow on those before it in one sequence.  Position
ids count from the root, and a node may attend to the intervals of its ancestors.

A node belongs to the smallest conversation that passes through it.  Down a conversation
the owner only grows, so a node's place in depth-first order is told by the few depths at
which its owner changes: between branches deeper ones come first, along a branch the
depth decides.  This needs joins and one sort, no walk over the tree.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import lean, materialise, partitions, small_batches


@dataclass(frozen=True)
class Template:
    """``open`` role ``middle`` text ``close`` for every turn; loss on the texts of ``learned`` roles.

    Control strings inside roles and texts are escaped: a backslash is doubled, and one is
    put behind the first character of each control string.
    """

    open: str = "<s>"
    middle: str = "[INST]"
    close: str = "[/INST]</s>"
    controls: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]")
    learned: tuple[str, ...] = ("assistant",)

    def __post_init__(self) -> None:
        for c in self.controls:
            if len(c) < 2 or "\\" in c or any(c[0] in d[1:] for d in self.controls):
                raise ValueError(f"control string {c!r} cannot be escaped safely")

    def escape(self, text: str) -> str:
        pattern = "|".join(map(re.escape, ("\\", *self.controls)))
        return re.sub(pattern, lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)

    def unescape(self, text: str) -> str:
        return re.sub(r"\\(\\?)", r"\1", text)

    def turn(self, role: str, text: str) -> tuple[str, int, int]:
        """The formatted turn, and where its text begins and ends in it."""
        head = f"{self.open}{self.escape(role)}{self.middle}"
        body = self.escape(text)
        return f"{head}{body}{self.close}", len(head), len(head) + len(body)

    def parse(self, turn: str) -> tuple[str, str]:
        """Role and text of a formatted turn."""
        role, middle, rest = turn[len(self.open) :].partition(self.middle)
        if not (turn.startswith(self.open) and middle and rest.endswith(self.close)):
            raise ValueError("not a turn of this template")
        return self.unescape(role), self.unescape(rest[: len(rest) - len(self.close)])


def codes(text: str) -> np.ndarray:
    """The code points of a text."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<i4")


def text_of(ids) -> str:
    """The text of code points."""
    return np.asarray(ids, "<i4").tobytes().decode("utf-32-le", "surrogatepass")


def _turns(rows: DataFrame, template: Template) -> DataFrame:
    """Format every turn and name every beginning: conv, depth, node, parent, tokens, loss, pos."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv, node, depth, pos = object(), "", 0, 0
        for batch in batches:
            out = []
            for c, role, text in zip(batch["conv"], batch["role"], batch["text"], strict=True):
                if c != conv:
                    conv, node, depth, pos = c, "", 0, 0
                formatted, a, b = template.turn(role or "", text or "")
                node, parent = hashlib.blake2b(f"{node}\n{formatted}".encode(), digest_size=16).hexdigest(), node
                learned = (role or "") in template.learned
                out.append((c, depth, node, parent, formatted, a if learned else 0, b if learned else 0, pos))
                depth += 1
                pos += len(formatted)
            frame = pd.DataFrame(out, columns=["conv", "depth", "node", "parent", "formatted", "loss_from", "loss_to", "pos"])
            yield frame.astype({"conv": object, "node": object, "parent": object, "formatted": object})

    dealt = rows.repartition(partitions(rows), "conv").sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "text")
    return dealt.select("conv", "role", "text").mapInPandas(lean(run), "conv string, depth int, node string, parent string, formatted string, loss_from int, loss_to int, pos long")


def conversation_key(conv_id: Column) -> Column:
    """A name for every conversation; a row with a null id is one by itself, with its equals as further turns."""
    alone = F.concat(F.lit("n"), F.sha2(F.to_json(F.struct("turn", "role", "text")), 256))
    return F.coalesce(F.concat(F.lit("c"), conv_id.cast("string")), alone)


def prefix_tree(conversations: DataFrame, template: Template | None = None, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The packed tree and the way of each conversation through it.

    Nodes: owner and depth (together the node's name), n_tokens and token_ids (code
    points of the formatted turn), start (place in the packed sequence), pos (position id
    of the first token; the rest count on), loss_from and loss_to (token offsets under the
    loss), attend (intervals [from, to) of the packed sequence that its ancestors fill).
    Ways: conv_id, conv, and runs of (owner, from_depth, to_depth) from the root on.

    Turns are taken by ``turn``, nulls first, ties by role and text; repeated rows are
    turns of their own; null roles and texts count as empty.  Rows with a null id are
    conversations of their own, for nothing tells them to belong together.  An empty table
    gives two empty ones; other columns are not read.
    """
    template = template or Template()
    small_batches(conversations.sparkSession)
    rows = conversations.select(conversations[conv_id].cast("long").alias("conv_id"), conversations[turn].alias("turn"), conversations[role].alias("role"), conversations[text].alias("text"))
    rows = rows.withColumn("conv", conversation_key(F.col("conv_id")))
    turns = materialise(_turns(rows, template))
    # a table of its own, so that a join with the many turns of a common beginning can be split
    owners = materialise(turns.groupBy("node").agg(F.min("conv").alias("owner")))
    owned = materialise(turns.select("conv", "depth", "node").join(owners, "node"))
    runs = owned.groupBy("conv", "owner").agg(F.min("depth").alias("from_depth"), F.max("depth").alias("to_depth"))
    run = F.struct("from_depth", "owner", "to_depth")
    ways = materialise(runs.groupBy("conv").agg(F.array_sort(F.collect_list(run)).alias("runs")))

    # a node is its owner's; the owner's own way down to it holds all branches above
    mine = turns.join(owners.select("node", F.col("owner").alias("conv")), ["node", "conv"]).withColumn("owner", F.col("conv"))
    placed = mine.join(ways, "conv").select("owner", "depth", "formatted", "loss_from", "loss_to", "pos", F.length("formatted").alias("n_tokens"), "runs")
    branch = F.transform(F.filter("runs", lambda r: r["from_depth"] > 0), lambda r: F.struct((-r["from_depth"]).alias("up"), r["owner"].alias("owner")))
    first = F.element_at("runs", 1)["owner"]
    placed = placed.withColumn("root", first).withColumn("key", branch)
    dealt = placed.repartitionByRange(partitions(rows), "root", "key", "depth").withColumn("part", F.spark_partition_id())
    dealt = materialise(dealt)
    # running token counts inside the partitions, then over them: one row for each partition
    order = Window.partitionBy("part").orderBy("root", "key", "depth")
    inside = dealt.withColumn("before", F.coalesce(F.sum("n_tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    sizes = dealt.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    carry = sizes.withColumn("carry", F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    nodes = inside.join(F.broadcast(carry.select("part", "carry")), "part").withColumn("start", F.col("carry") + F.col("before"))
    nodes = materialise(nodes.select("owner", "depth", "formatted", "n_tokens", "start", "pos", "loss_from", "loss_to", "runs"))

    # ancestors: each run above is one interval, because a branch is written in one go
    above = F.filter(
        F.transform("runs", lambda r, i: F.struct(i.alias("i"), r["owner"].alias("o"), r["from_depth"].alias("a"), r["to_depth"].alias("b"))),
        lambda r: r["a"] < F.col("depth"),
    )
    asked = nodes.select("owner", "depth", F.explode(above).alias("r")).select("owner", "depth", "r.i", F.col("r.o").alias("o"), F.col("r.a").alias("a"), F.least("r.b", F.col("depth") - 1).alias("b"))
    place = nodes.select(F.col("owner").alias("o"), F.col("depth").alias("d"), "start", (F.col("start") + F.col("n_tokens")).alias("stop"))
    spans = asked.join(place.select("o", F.col("d").alias("a"), "start"), ["o", "a"]).join(place.select("o", F.col("d").alias("b"), "stop"), ["o", "b"])
    attend = spans.groupBy("owner", "depth").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "start", "stop"))), lambda s: F.struct(s["start"].alias("from"), s["stop"].alias("to"))).alias("attend"))

    @F.pandas_udf("array<int>")
    def points(texts: pd.Series) -> pd.Series:
        return texts.map(codes)

    none = F.array().cast("array<struct<from:bigint,to:bigint>>")
    tree = nodes.drop("runs").join(attend, ["owner", "depth"], "left").withColumn("attend", F.coalesce("attend", none))
    tree = tree.withColumn("token_ids", points("formatted")).drop("formatted")
    ids = rows.groupBy("conv").agg(F.max("conv_id").alias("conv_id"))
    return tree, ways.join(ids, "conv")


def read_back(tree: DataFrame, ways: DataFrame) -> DataFrame:
    """(conv_id, conv, depth, token_ids, loss_from, loss_to, pos, start, attend) for every turn of every conversation.

    Empty tables give no rows; each conversation of ``ways`` has all its turns.
    """
    step = F.explode("runs").alias("r")
    steps = ways.select("conv_id", "conv", step).select("conv_id", "conv", F.col("r.owner").alias("owner"), F.explode(F.sequence("r.from_depth", "r.to_depth")).alias("depth"))
    return steps.join(tree.select("owner", "depth", "token_ids", "loss_from", "loss_to", "pos", "start", "attend"), ["owner", "depth"])


def digests(turns: DataFrame, template: Template | None = None) -> DataFrame:
    """Per conversation, from the turns read back: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, positions_sha256, attend_sha256.

    ``positions_sha256`` digests a line for each turn with the position ids of its first and
    last token, ``attend_sha256`` a line for each turn with the intervals of the packed
    sequence that it may attend to, its own last (``from-to``, joined by blanks).
    Conversations have a turn at least; a null id stays null; no turns give no rows.
    """
    template = template or Template()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def row():
            return (conv_id, n, turns_hash.hexdigest(), loss, loss_hash.hexdigest(), size, places.hexdigest(), seen.hexdigest())

        conv, started = None, False
        for batch in batches:
            out = []
            for c, cid, ids, a, b, pos, start, attend in zip(*(batch[x] for x in columns), strict=True):
                if c != conv or not started:
                    if started:
                        out.append(row())
                    conv, conv_id, started = c, None if pd.isna(cid) else int(cid), True
                    n, loss, size = 0, 0, 0
                    turns_hash, loss_hash, places, seen = (hashlib.sha256() for _ in range(4))
                formatted = text_of(ids)
                role, text = template.parse(formatted)
                turns_hash.update(f"{role}\n{text}\n".encode())
                learned = template.unescape(formatted[a:b])
                loss_hash.update(learned.encode())
                places.update(f"{pos} {pos + len(ids) - 1}\n".encode())
                spans = [*((x["from"], x["to"]) for x in attend), (start, start + len(ids))]
                seen.update((" ".join(f"{x}-{y}" for x, y in spans) + "\n").encode())
                n, loss, size = n + 1, loss + len(learned), size + len(ids)
            yield pd.DataFrame(out, columns=names).astype(kinds)
        if started:
            yield pd.DataFrame([row()], columns=names).astype(kinds)

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "positions_sha256", "attend_sha256"]
    columns = ["conv", "conv_id", "token_ids", "loss_from", "loss_to", "pos", "start", "attend"]
    kinds = {x: object for x in names if x.endswith("sha256")} | {"conv_id": "Int64"}
    schema = T.StructType([T.StructField(x, T.StringType() if x.endswith("sha256") else T.LongType()) for x in names])
    dealt = turns.repartition(partitions(turns), "conv").sortWithinPartitions("conv", "depth")
    return dealt.select(*columns).mapInPandas(lean(run), schema)
