"""Conversations from messages that quote one another.

A message's lines are split by their quote level ("> > ..."); runs of one level are
passages. Own texts, their paragraphs and their lines are normalised and hashed, and so are
passages, their paragraphs and their lines. A quoted line links to the message that says the
largest of these parts it stands in, and the message that most lines of the outermost linked
level link to is what a message replies to. Conversations are then in reply order, without
quotes; quoted lines that nobody said are returned apart.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyloom.llm.common import col, cut

_QUOTE = re.compile(r"(?:[ \t]*[>|»])+[ \t]?")
_INTRO = re.compile(r"(?i)\b(?:wrote|writes|said|a écrit|schrieb|escribió)\s*:\s*$")
_NOT_WORD = re.compile(r"[\W_]+")


def normalised(text: str) -> str:
    return _NOT_WORD.sub(" ", text.casefold()).strip()


def _without_intro(lines: list[str]) -> list[str]:
    """Own lines in front of a quote, less the last that is not blank if it says whose words follow."""
    at = max((i for i, line in enumerate(lines) if line.strip()), default=None)
    return lines if at is None or not _INTRO.search(lines[at]) else lines[:at] + lines[at + 1 :]


def parse_quotes(text: str) -> tuple[str, list[list[str]], list[tuple[int, list[str]]]]:
    """The own text of a message, the runs of its own lines, and its quoted passages with their levels."""
    runs, level = [], None
    for line in text.split("\n"):
        m = _QUOTE.match(line)
        depth = sum(map(m[0].count, ">|»")) if m and not m[0].strip("|\t ") == "" else 0
        if depth != level:
            runs.append((depth, []))
            level = depth
        runs[-1][1].append(line[m.end() :] if depth else line)
    passages = [r for r in runs if r[0]]
    if not passages:
        return text, [text.split("\n")], []
    own = [_without_intro(lines) if nth + 1 < len(runs) else lines for nth, (depth, lines) in enumerate(runs) if not depth]
    return "\n".join(line for lines in own for line in lines).strip(), own, passages


def _key(norm: str) -> bytes | None:
    return hashlib.blake2b(norm.encode("utf-8", "surrogatepass"), digest_size=16).digest() if norm else None


def _paragraphs(lines: list[str]) -> list[list[str]]:
    """``lines`` parted at blank ones, which are left out."""
    parts = [[]]
    for line in lines:
        if line.strip():
            parts[-1].append(line)
        elif parts[-1]:
            parts.append([])
    return [p for p in parts if p]


def said_keys(own: str, runs: list[list[str]]) -> list[bytes]:
    """Hashes of an own text, its paragraphs and its lines, each once."""
    parts = {normalised(own)}
    for run in runs:
        for paragraph in _paragraphs(run):
            parts.add(normalised("\n".join(paragraph)))
            if len(paragraph) > 1:
                parts.update(map(normalised, paragraph))
    return [_key(p) for p in parts if p]


def quoted_lines(passages: list[tuple[int, list[str]]]) -> list[dict]:
    """The lines of the passages that are not blank, each with hashes of its passage, its paragraph and itself."""
    lines = []
    for nth, (level, passage) in enumerate(passages):
        whole = _key(normalised("\n".join(passage)))
        for paragraph in _paragraphs(passage):
            part = _key(normalised("\n".join(paragraph)))
            lines += [{"nth": nth, "level": level, "text": line, "keys": [whole, part, _key(normalised(line))]} for line in paragraph]
    return lines


def parsed(df: DataFrame, text: str = "text", into: str = "parsed") -> DataFrame:
    """``df`` with a struct of own text, the hashes of what it says, the number of passages and their lines of ``text``; null texts have none."""

    @F.pandas_udf("own string, says array<binary>, n_quotes int, lines array<struct<nth:int,level:int,text:string,keys:array<binary>>>")
    def split(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            found = [(None, [], []) if t is None else parse_quotes(t) for t in texts]
            yield pd.DataFrame(
                {
                    "own": [own for own, _, _ in found],
                    "says": [said_keys(own or "", runs) for own, runs, _ in found],
                    "n_quotes": [len(passages) for _, _, passages in found],
                    "lines": [quoted_lines(passages) for _, _, passages in found],
                }
            )

    return df.withColumn(into, split(col(text)))


def _ancestors(parents: DataFrame) -> DataFrame:
    """``id``, ``root`` and ``depth`` of all messages in ``parents`` (id, parent), jumping twice as far in each step."""
    far = cut(parents.select("id", F.col("parent").alias("root"), F.lit(1).alias("depth")))
    while True:
        up = far.select(F.col("id").alias("up_id"), F.col("root").alias("next"), F.col("depth").alias("more"))
        step = far.join(up, F.col("root.id") == F.col("up_id"), "left")
        far = cut(step.select("id", F.coalesce("next", "root").alias("root"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("next").isNotNull().alias("moved")))
        if far.where("moved").isEmpty():
            return far.select("id", "root", "depth")


def _links(messages: DataFrame) -> DataFrame:
    """``id``, ``parent``, the number of linked passages and the places of the linked lines of the messages that quote one another."""
    lines = messages.where(F.size("lines") > 0).select("id", "node", F.posexplode("lines").alias("at", "q"))
    # A part that is all of a larger one is asked for once.
    keys = F.expr("filter(q.keys, (k, i) -> k is not null and (i = 0 or not k <=> q.keys[i - 1]))")
    asked = cut(lines.select("id", "node", "at", F.col("q.nth").alias("nth"), F.col("q.level").alias("level"), F.posexplode(keys).alias("part", "key")))
    said = messages.where("node.conv is not null and node.turn is not null").select(F.explode("says").alias("key"), F.struct("node.conv", "node.turn", "same", "id").alias("node"))
    said = said.join(asked.select("key").distinct(), "key", "left_semi")
    # Written, not reused as aggregates: adaptive execution splits a passage that very many quote only between two plain shuffles.
    here = cut(said.groupBy("key", F.col("node.conv").alias("conv")).agg(F.min("node").alias("here")))
    anywhere = cut(here.groupBy("key").agg(F.min("here").alias("anywhere")))
    same = (F.col("a.key") == F.col("h.key")) & (F.col("a.node.conv") == F.col("h.conv")) & _earlier("h.here", "a.node")
    found = asked.alias("a").join(here.alias("h"), same, "left").select("a.*", "h.here").join(anywhere, "key", "left")
    found = found.withColumn("parent", F.coalesce("here", F.when(_earlier("anywhere", "node"), F.col("anywhere")))).where("parent is not null")
    linked = found.repartition("id").groupBy("id", "at").agg(F.min(F.struct("part", "level", "nth", "parent")).alias("link")).select("id", "at", "link.*")
    linked = linked.groupBy("id", "level", "parent").agg(F.count("*").alias("n"), F.min("at").alias("first"), F.collect_set("nth").alias("nths"), F.collect_list("at").alias("ats"))
    return linked.groupBy("id").agg(
        F.min(F.struct("level", -F.col("n"), "first", "parent")).alias("best"),
        F.size(F.array_distinct(F.flatten(F.collect_list("nths")))).cast("bigint").alias("n_linked"),
        F.flatten(F.collect_list("ats")).alias("linked"),
    ).select("id", "best.parent", "n_linked", "linked")


def _earlier(a: str, b: str):
    """Nulls come first: nothing is earlier than a message without a conversation."""
    return F.struct(f"{a}.conv", f"{a}.turn") < F.struct(f"{b}.conv", f"{b}.turn")


def conversations(df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per message, in reply order: thread, position, conversation, turn, role, own text, what it replies to.

    A quoted passage, or else its paragraph, or else its line, links to the message whose own
    text, or a paragraph or line of it, is the same after normalisation: the first one of its own conversation if
    that is earlier, else the first one anywhere, by conversation and turn, if that is earlier
    in this order. A message replies to the message that most lines of its outermost linked level link
    to. ``unlinked_quotes`` has the quoted lines without a link. Replies move to the conversation
    (``thread``) of the message they go back to; ``position`` (from 0) follows there the
    turn of that message, then the number of replies between, then conversation and turn.

    A message without linked quotes stays where it was, also if another one has its conversation and turn. Null texts quote and say nothing, null
    conversations or turns are no originals; they come first in order, so a message without a conversation links to none. An empty table gives no rows, a text of any length is parsed whole. Repeated rows all stay. Extra columns play no part.
    Passages are joined by hash to one message each, so copies cost no pairs, and
    positions come from a range sort, so a conversation of any length is dealt over many tasks.
    """
    source = df.select(col(conversation).alias("conv"), col(turn).alias("turn"), col(role).alias("role"), col(text).alias("text"))
    messages = cut(
        parsed(source, "text", "p").select(
            F.monotonically_increasing_id().alias("id"),
            F.struct("conv", "turn").alias("node"),
            F.xxhash64("role", "text").alias("same"),  # of messages with one conversation and turn the same one is first, however they are stored
            "role",
            F.col("p.own").alias("own"),
            F.col("p.says").alias("says"),
            F.col("p.n_quotes").alias("n_quotes"),
            F.col("p.lines").alias("lines"),
        )
    )
    rows = messages.select("id", "node", "role", "own", "n_quotes", "lines")
    links = cut(_links(messages))
    if links.isEmpty():
        none = "cast(null as struct<conv:{},turn:{}>)".format(*(source.schema[c].dataType.simpleString() for c in ("conv", "turn")))
        rows = rows.select("*", F.expr(none).alias("parent"), F.lit(0).cast("bigint").alias("n_linked"), F.expr("cast(array() as array<int>)").alias("linked"), F.col("node").alias("root"), F.lit(0).alias("depth"))
    else:
        rows = rows.join(links, "id", "left").join(_ancestors(links), "id", "left")
        rows = rows.withColumn("root", F.expr("if(root is null, node, struct(root.conv, root.turn))"))
        rows = rows.withColumns({"n_linked": F.coalesce("n_linked", F.lit(0)), "linked": F.coalesce("linked", F.expr("cast(array() as array<int>)")), "depth": F.coalesce("depth", F.lit(0))})
    left = F.expr("if(size(lines) = 0, lines, transform(array_except(sequence(0, size(lines) - 1), linked), i -> lines[i])).text")
    rows = rows.withColumn("unlinked", left).drop("lines", "linked")
    order = ["root.conv", "root.turn", "depth", "node.conv", "node.turn", "id"]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = cut(placed.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"), F.col("root.conv").alias("thread")))
    before = Window.partitionBy("thread").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = placed.groupBy("thread", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    runs = runs.select(F.col("thread").alias("run_thread"), F.col("part").alias("run_part"), "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    joined = placed.join(runs, (F.col("part") == F.col("run_part")) & F.col("thread").eqNullSafe(F.col("run_thread")))
    return joined.select(
        "thread",
        (F.col("offset") + F.col("at") - F.col("first")).alias("position"),
        F.col("node.conv").alias(conversation),
        F.col("node.turn").alias(turn),
        F.col("role").alias(role),
        F.col("own").alias("own_text"),
        F.col("parent.conv").alias("reply_conv"),
        F.col("parent.turn").alias("reply_turn"),
        "depth",
        "n_quotes",
        "n_linked",
        F.col("unlinked").alias("unlinked_quotes"),
    )
