"""Conversations as a prefix tree of chat turns: turns that conversations share from their beginning are written once.

A node is a turn together with all turns before it, named by its depth and a running hash of 128 bits. Nodes are emitted
depth first, all trees one after the other, so every node has a place in one long sequence of tokens. With it go its
position (tokens before it in its own conversations) and the intervals of the sequence that it may attend to:
its ancestors and itself, neighbouring ones merged.

Depth-first order is an order of paths. Only forks matter for it: the path of a node holds a key for each of its
ancestors (and itself) that has siblings; nodes of one path form a chain and are ordered by depth.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer

from paddock.llm.common import map_rows, stored

# The marks of a turn. Inside texts a control string gets a backslash after its first character.
OPEN, CLOSE, END = "[INST]", "[/INST]", "</s>"
CONTROL = r"(?=/?(?:s>|INST\]))"
ESCAPE = re.compile(r"([<\[])(\\*)" + CONTROL)
UNESCAPE = re.compile(r"([<\[])\\(\\*)" + CONTROL)
TURN = re.compile(r"\[INST\](.*?)\[/INST\](.*?)</s>", re.DOTALL)
LOSS_ROLE = "assistant"
BUCKET = 512  # tokens of the sequence that a lookup by interval takes together
FIRST, HERE = Window.unboundedPreceding, Window.currentRow


def escaped(text: str) -> str:
    return ESCAPE.sub(r"\1\\\2", text)


def unescaped(text: str) -> str:
    return UNESCAPE.sub(r"\1\2", text)


@lru_cache(maxsize=1)
def _tokenizer(vocabulary: str) -> Tokenizer:
    tokenizer = Tokenizer.from_file(vocabulary)
    tokenizer.encode_special_tokens = True  # special strings in a text are ordinary text
    return tokenizer


def _ids(tokenizer: Tokenizer, text: str) -> list[int]:
    return tokenizer.encode(text, add_special_tokens=False).ids


def format_conversations(
    conversations: DataFrame, vocabulary: str | None = None, id_column: str = "conv_id", turn_column: str = "turn",
    role_column: str = "role", text_column: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """The prefix tree of all conversations, and where each conversation ends in it.

    nodes: start (place in the sequence, names the node), parent_start, depth (from 1), n_tokens, position, mask_from and
    mask_length (tokens of the node that count for the loss: the text of an assistant turn), attends
    (intervals [from, to) of ancestors and the node itself), subtree_end, ids (unsigned 32-bit little-endian).
    The second table has the id, n_turns and leaf_start of each conversation. A turn reads
    [INST]role[/INST]text</s>. Rows of a conversation are ordered by turn (null first), role, text; repeated rows are turns of
    their own. Null roles and texts count as empty; rows with a null id are one conversation. Other columns are not read.
    """
    vocabulary = vocabulary or public_tokenizers.path("byte_bpe_50k.json")
    empty = F.lit("")
    turns = conversations.select(
        F.col(f"`{id_column}`").alias("id"), F.col(f"`{turn_column}`").alias("turn"),
        F.coalesce(F.col(f"`{role_column}`"), empty).alias("role"), F.coalesce(F.col(f"`{text_column}`"), empty).alias("text"))
    whole = Window.partitionBy("id")
    order = whole.orderBy("turn", "role", "text")
    running = order.rowsBetween(FIRST, HERE)
    turns = turns.withColumn("t", F.row_number().over(order)).withColumn(
        "h1", F.xxhash64("role", "text", "t")).withColumn("h2", F.xxhash64("t", "text", "role", F.lit(1)))
    # A prefix is the set of its turns with their numbers, so the hash of a set names it.
    turns = turns.select(
        "id", "t", "role", "text", F.bit_xor("h1").over(running).alias("p1"), F.bit_xor("h2").over(running).alias("p2"), "h1", "h2",
        F.bit_xor("h1").over(whole).alias("f1"), F.bit_xor("h2").over(whole).alias("f2"), F.count("*").over(whole).alias("n_turns"))
    turns = stored(turns.withColumn("q1", F.col("p1").bitwiseXOR(F.col("h1"))).withColumn("q2", F.col("p2").bitwiseXOR(F.col("h2"))).drop("h1", "h2"))

    leaf, node = ["n_turns", "f1", "f2"], ["t", "p1", "p2"]
    chains = turns.select(*leaf, *node, "q1", "q2").distinct()  # equal conversations are one from here on
    owner = F.min(F.struct(*leaf)).alias("owner")
    tree = turns.groupBy(*node, "q1", "q2", "role", "text").agg(owner)

    def tokens(batches: Iterator[dict[str, list]]) -> Iterator[list[tuple]]:
        tokenizer = _tokenizer(vocabulary)
        for batch in batches:
            out = []
            for t, p1, p2, role, text in zip(*(batch[c] for c in (*node, "role", "text"))):
                head = _ids(tokenizer, OPEN + escaped(role) + CLOSE)
                body = _ids(tokenizer, escaped(text))
                ids = np.array(head + body + _ids(tokenizer, END), "<u4")
                out.append((t, p1, p2, len(ids), len(head), len(body) if role == LOSS_ROLE else 0, ids.tobytes()))
            yield out

    tree = stored(tree.select(*node, "q1", "q2", "role", "text", "owner.*"))
    coded = stored(map_rows(
        tree.select(*node, "role", "text"), tokens,
        "t int, p1 long, p2 long, n_tokens long, mask_from long, mask_length long, ids binary"))

    forks = tree.groupBy((F.col("t") - 1).alias("u"), "q1", "q2").agg(F.count("*").alias("children")).where("children > 1 AND u > 0")
    chains = chains.withColumn("u", F.col("t") - 1).join(forks, ["u", "q1", "q2"], "left")
    key = F.concat(F.lpad(F.hex("p1"), 16, "0"), F.lpad(F.hex("p2"), 16, "0"))
    along = Window.partitionBy(*leaf).orderBy("t")
    chains = chains.withColumn("path", F.array_join(F.collect_list(
        F.when(F.col("children").isNotNull() | (F.col("t") == 1), key)).over(along.rowsBetween(FIRST, HERE)), ""))
    chains = stored(chains.join(coded.select(*node, "n_tokens"), node).select(*leaf, *node, "path", "n_tokens"))

    owned = tree.select(*node, *leaf)
    places = chains.join(owned, [*node, *leaf]).select(*node, "path", "n_tokens")
    places = stored(places.repartitionByRange("path", "t").withColumn("part", F.spark_partition_id()))
    sums = places.groupBy("part").agg(F.sum("n_tokens").alias("sum"))  # one row for each task
    before = Window.orderBy("part").rowsBetween(FIRST, -1)
    bases = sums.select("part", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("path", "t").rowsBetween(FIRST, -1)
    starts = places.withColumn("inner", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(bases, "part")
    starts = stored(starts.select(*node, (F.col("base") + F.col("inner")).alias("start")))

    chains = chains.join(starts, node).select(*leaf, *node, "n_tokens", "start", (F.col("start") + F.col("n_tokens")).alias("end"))
    chains = chains.withColumn("parent_start", F.lag("start").over(along)).withColumn("parent_end", F.lag("end").over(along))
    chains = chains.withColumn("jumps", F.col("parent_end").isNull() | (F.col("parent_end") != F.col("start")))
    upto = along.rowsBetween(FIRST, HERE)
    chains = stored(chains.withColumn("position", F.sum("n_tokens").over(upto) - F.col("n_tokens")).withColumn(
        "froms", F.collect_list(F.when(F.col("jumps"), F.col("start"))).over(upto)).withColumn(
        "tos", F.collect_list(F.when(F.col("jumps"), F.col("parent_end"))).over(upto)).withColumn(
        "leaf_end", F.max("end").over(Window.partitionBy(*leaf).orderBy("t").rowsBetween(HERE, Window.unboundedFollowing))))
    below = chains.groupBy(*node).agg(F.max("leaf_end").alias("subtree_end"))
    attends = F.expr("transform(froms, (a, k) -> struct(a AS `from`, coalesce(get(tos, k), end) AS `to`))")
    nodes = chains.join(owned, [*node, *leaf]).join(below, node).join(coded.drop("n_tokens"), node).select(
        "start", "parent_start", F.col("t").alias("depth"), "n_tokens", "position", "mask_from", "mask_length",
        attends.alias("attends"), "subtree_end", "ids")
    ends = turns.where("t = n_turns").select("id", "n_turns", *node).join(starts, node)
    return nodes, ends.select(F.col("id").alias(id_column), "n_turns", F.col("start").alias("leaf_start"))


def read_back(nodes: DataFrame, ends: DataFrame, vocabulary: str | None = None, id_column: str = "conv_id") -> DataFrame:
    """What the formatted conversations say, from the output alone.

    One row per conversation: the id, n_turns, turns_sha256 (over role, line feed, text, line feed of each turn), loss_chars
    and loss_sha256 (of all text under the loss mask, unescaped), formatted_chars.
    """
    vocabulary = vocabulary or public_tokenizers.path("byte_bpe_50k.json")
    nodes = stored(nodes)
    leaves = nodes.join(ends.select(F.col("leaf_start").alias("start")).distinct(), "start", "left_semi")
    parts = leaves.select(F.col("start").alias("leaf_start"), F.inline("attends")).withColumn(
        "bucket", F.explode(F.expr(f"sequence(`from` div {BUCKET}, (`to` - 1) div {BUCKET})")))
    content = nodes.select("start", "position", "mask_from", "mask_length", "ids", F.expr(f"start div {BUCKET}").alias("bucket"))
    found = parts.join(content, "bucket").where("start >= `from` AND start < `to`")
    whole = found.groupBy("leaf_start").agg(
        F.array_sort(F.collect_list(F.struct("position", "mask_from", "mask_length", "ids"))).alias("turns"))

    def read(batches: Iterator[dict[str, list]]) -> Iterator[list[tuple]]:
        tokenizer = _tokenizer(vocabulary)
        for batch in batches:
            out = []
            for leaf, turns in zip(batch["leaf_start"], batch["turns"]):
                ids = [np.frombuffer(x["ids"], "<u4") for x in turns]
                text = tokenizer.decode(np.concatenate(ids).tolist(), skip_special_tokens=False)
                said = [(unescaped(role), unescaped(body)) for role, body in TURN.findall(text)]
                loss = "".join(
                    unescaped(tokenizer.decode(i[x["mask_from"]:x["mask_from"] + x["mask_length"]].tolist(), skip_special_tokens=False))
                    for x, i in zip(turns, ids) if x["mask_length"])
                out.append((leaf, len(said), _sha("".join(f"{r}\n{b}\n" for r, b in said)), len(loss), _sha(loss), len(text)))
            yield out

    read = map_rows(whole, read, "leaf_start long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    return ends.select(id_column, "leaf_start").join(read, "leaf_start").drop("leaf_start")


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
