"""Conversations as trees of shared turns, formatted once and cut into tokens.

Conversations that begin with the same turns share these. Every different beginning is a
node that holds one formatted turn; a tree is laid out depth first, a node's branch with
most conversations ahead of its others. That branch then follows without a gap, so that what
a token attends to is a few intervals, at most one more than the binary logarithm of the
number of conversations, however long a conversation is.
"""

import base64
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property
from hashlib import blake2b, sha256
from typing import Any

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import TidemarkError
from tidemark.staging import scratch, staged

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern that the vocabulary was made with.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Most bytes of a vocabulary, which every task is given.
MOST_VOCABULARY = 64 << 20
#: Characters of a text that are cut into tokens at once.
_PART = 4096

# Beginnings are known by the value of a polynomial in the hashes of their turns.
_MODULUS = (1 << 127) - 1
_BASE = 0x5DEECE66D1CE4E5B9BF58476D1CE4E5


@dataclass(frozen=True)
class Template:
    """A turn is ``start``, the role, ``separator``, the text and ``end``.

    Inside of roles and texts each control string has ``escape`` put in after its first
    character; one that already has escapes there gets one more, which makes it reversible.
    No control string may hold the escape, or overlap with another.
    """

    start: str = "<|im_start|>"
    separator: str = "<|im_sep|>"
    end: str = "<|im_end|>"
    others: tuple[str, ...] = ("<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
    escape: str = "\\"

    def __post_init__(self) -> None:
        for a in self.controls:
            if len(a) < 2 or self.escape in a:
                raise ValueError(f"{a!r} cannot be escaped")
            for b in self.controls:
                meets = any(a.endswith(b[:n]) for n in range(1, min(len(a), len(b) - 1) + 1))
                if meets or (a != b and a in b):
                    raise ValueError(f"{a!r} and {b!r} overlap")

    @property
    def controls(self) -> tuple[str, ...]:
        return (self.start, self.separator, self.end, *self.others)

    @cached_property
    def _plain(self) -> re.Pattern:
        return self._pattern("*")

    @cached_property
    def _escaped(self) -> re.Pattern:
        return self._pattern("+")

    def _pattern(self, times: str) -> re.Pattern:
        mark = re.escape(self.escape)
        return re.compile("|".join(f"{re.escape(c[0])}(?:{mark}){times}{re.escape(c[1:])}" for c in self.controls))

    def hide(self, text: str) -> str:
        return self._plain.sub(lambda m: m[0][0] + self.escape + m[0][1:], text)

    def show(self, text: str) -> str:
        return self._escaped.sub(lambda m: m[0][0] + m[0][1 + len(self.escape) :], text)


class Codec:
    """Formatted turns as tokens and back. The three marks are tokens of their own, behind
    those of the vocabulary, so that no text can be taken for one."""

    def __init__(self, vocabulary: bytes, template: Template):
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
        self.template = template
        self.marks = [max(ranks.values()) + n for n in (1, 2, 3)]
        self._encoding = tiktoken.Encoding("given", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        """Tokens of a text, in parts that begin at white space where there is any, so that
        time and memory are in proportion to its length."""
        out: list[int] = []
        first = 0
        while first < len(text):
            last = first + _PART
            if last < len(text):
                cut = max(text.rfind(" ", first + 1, last), text.rfind("\n", first + 1, last))
                last = cut if cut > first else last
            out += self._encoding.encode_ordinary(text[first:last])
            first = last
        return out

    def decode(self, tokens: Sequence[int]) -> str:
        return self._encoding.decode_bytes(tokens).decode()

    def turn(self, role: str, text: str) -> tuple[list[int], int, int]:
        """Tokens of a turn, and the first and end token of its text."""
        ahead = [self.marks[0], *self.encode(self.template.hide(role)), self.marks[1]]
        body = self.encode(self.template.hide(text))
        return [*ahead, *body, self.marks[2]], len(ahead), len(ahead) + len(body)

    def read(self, tokens: list[int]) -> tuple[str, str, int]:
        """Role and text of a turn, and the characters it has as formatted text."""
        at = tokens.index(self.marks[1])
        role, text = self.decode(tokens[1:at]), self.decode(tokens[at + 1 : -1])
        marks = len(self.template.start) + len(self.template.separator) + len(self.template.end)
        return self.template.show(role), self.template.show(text), len(role) + len(text) + marks


@dataclass(frozen=True)
class Formatted:
    """``nodes``: one row per different beginning, ``node`` and its ``tree``, with ``role``,
    ``depth`` (turns before it), ``tokens``, ``begin`` (its first token in the layout of the
    tree), ``position`` (tokens before it in any of its conversations), ``position_ids``,
    ``attends`` (intervals ``first`` to ``end`` of the tree's tokens that its own see besides
    those of the node up to themselves), ``loss_first`` and ``loss_end`` (tokens that are
    trained on) and ``conversations`` (how many share it).

    ``turns``: ``conversation``, ``depth`` and ``node`` of every turn of every conversation.
    """

    nodes: DataFrame
    turns: DataFrame
    codec: Any


def format_conversations(
    conversations: DataFrame,
    vocabulary: str = VOCABULARY,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    template: Template = Template(),
    loss_role: str = "assistant",
) -> Formatted:
    """Merge conversations that share initial turns, and emit each shared turn once.

    A conversation's rows are its turns by ``turn``, null last; rows of one turn follow each
    other in the order of a hash of role and text, repeated rows are turns like others. Null
    roles and texts are empty; the rows without a conversation id are one conversation. Other
    columns are not looked at. A table without rows gives no nodes.

    Rows are dealt by ranges of conversation and turn, so that a conversation of any length
    is split over tasks; a few numbers a task carry what runs on from one to the next. Depths,
    positions and the layout are worked out on narrow rows. Texts are moved twice: into
    order, and to their place in the layout. Beginnings are told apart by 127-bit values and
    not compared word by word.
    """
    spark = conversations.sparkSession
    with open(vocabulary, "rb") as file:
        ranks = file.read(MOST_VOCABULARY + 1)
    if len(ranks) > MOST_VOCABULARY:
        raise TidemarkError(f"{vocabulary} is too large to be broadcast")
    codec = spark.sparkContext.broadcast((ranks, template))
    with scratch(spark, "conversations") as folder:
        said = [F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")]
        given = conversations.select(
            F.col(conversation).alias("conversation"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text")
        ).select("conversation", "turn", *said)
        order = [F.col("conversation"), F.col("turn").asc_nulls_last(), F.xxhash64("role", "text")]
        in_order = given.repartitionByRange(*order).sortWithinPartitions(*order, "role", "text").select("conversation", "role", "text")
        kind = given.schema["conversation"]
        segments = staged(in_order.mapInArrow(_segments(codec, loss_role), _segment_schema(kind)), "segments", folder=folder)
        narrow = segments.withColumn("length", F.size("tokens")).drop("role", "tokens", "loss_first", "loss_end")
        rows = staged(narrow.mapInArrow(_carried(_carries(segments)), narrow.schema), "rows", folder=folder)
        nodes = staged(_nodes(rows), "nodes", folder=folder)
        paths = staged(_paths(rows, nodes), "paths", folder=folder)
        laid = _laid_out(spark, _placed(nodes, paths), folder)
        with_attention = _attention(laid, paths)
        whole = segments.select("part", "seq", "role", "tokens", "loss_first", "loss_end").join(with_attention, ["part", "seq"])
        out = staged(whole.drop("part", "seq", "conversation", "length"), "trees", keep=True)
        turns = staged(rows.select("conversation", "depth", "node"), "turns", keep=True)
    ids = F.sequence(F.col("position"), F.col("position") + F.size("tokens") - 1)
    return Formatted(out.withColumn("position_ids", ids), turns, codec)


def conversations_report(formatted: Formatted) -> DataFrame:
    """Conversations read back from the trees: digests of their turns and of the loss.

    Nodes are decoded once and sent to their conversations. A digest runs over a conversation
    from its first turn to its last, so that one task reads it, turn by turn.
    """
    codec = formatted.codec
    kind = formatted.turns.schema["conversation"]
    read = "node binary, role string, text string, masked boolean, loss string, chars long"
    texts = formatted.nodes.select("node", "tokens", "loss_first", "loss_end").mapInArrow(_read(codec), read)
    said = formatted.turns.join(texts, "node").drop("node")
    sorted_rows = said.repartition("conversation").sortWithinPartitions("conversation", "depth")
    result = T.StructType.fromDDL(
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
    result.fields[0].dataType = kind.dataType
    return sorted_rows.drop("depth").mapInArrow(_digests, result)


def _segment_schema(conversation: T.StructField) -> T.StructType:
    rest = T.StructType.fromDDL(
        "depth long, position long, node binary, parent binary, fresh boolean, role string, "
        "tokens array<int>, loss_first int, loss_end int"
    )
    ahead = T.StructType.fromDDL("part int, seq long").fields
    return T.StructType([*ahead, T.StructField("conversation", conversation.dataType), *rest.fields])


def _bytes(value: int) -> bytes:
    return value.to_bytes(16, "big")


def _segments(codec: Any, loss_role: str):
    """Turns in order as tokens; depth, position and node as far as this task knows the
    conversation. ``fresh`` rows are not of the task's first conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, count, position, node = TaskContext.get().partitionId(), 0, 0, 0, 0
        now: Any = None
        fresh = False
        coder = Codec(*codec.value)
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                some = batch.slice(first, 512)
                out: list[tuple] = []
                for conversation, role, text in zip(*(c.to_pylist() for c in some.columns)):
                    if seq and conversation != now:
                        count, position, node, fresh = 0, 0, 0, True
                    now = conversation
                    tokens, loss_first, loss_end = coder.turn(role, text)
                    if role != loss_role:
                        loss_end = loss_first
                    said = blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
                    parent, node = node, (node * _BASE + int.from_bytes(said, "big") + 1) % _MODULUS
                    out.append((part, seq, count, position, _bytes(node), _bytes(parent) if count else None, fresh, role, tokens, loss_first, loss_end))
                    seq, count, position = seq + 1, count + 1, position + len(tokens)
                part_, seq_, *rest = zip(*out)
                kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.bool_(), pa.string(), pa.list_(pa.int32()), pa.int32(), pa.int32()]
                columns = [pa.array(part_, pa.int32()), pa.array(seq_, pa.int64()), some.column(0)]
                columns += [pa.array(values, k) for values, k in zip(rest, kinds)]
                names = ["part", "seq", "conversation", "depth", "position", "node", "parent", "fresh", "role", "tokens", "loss_first", "loss_end"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _carries(segments: DataFrame) -> dict[int, tuple[int, int, int]]:
    """By task: turns, tokens and node of its first conversation in the tasks before it. One
    row a task comes to the driver."""
    end = F.struct("conversation", "depth", (F.col("position") + F.size("tokens")).alias("position"), "node")
    ends = segments.groupBy("part").agg(F.min_by(F.struct("conversation"), "seq").alias("first"), F.max_by(end, "seq").alias("last"))
    out: dict[int, tuple[int, int, int]] = {}
    before: Any = None
    for r in sorted(ends.collect(), key=lambda r: r.part):
        count, position, node = r.last.depth + 1, r.last.position, int.from_bytes(r.last.node, "big")
        if before is not None and before[0] == r.first.conversation:
            out[r.part] = before[1:]
            if r.first.conversation == r.last.conversation:
                turns, tokens, value = before[1:]
                count, position, node = turns + count, tokens + position, (value * pow(_BASE, count, _MODULUS) + node) % _MODULUS
        before = r.last.conversation, count, position, node
    return out


def _carried(carries: dict[int, tuple[int, int, int]]):
    """The rows, those of conversations that began in another task put right."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            part = batch.column(names.index("part")).to_numpy()
            old = ~batch.column(names.index("fresh")).to_numpy(zero_copy_only=False)
            wrong = np.flatnonzero(old & np.isin(part, list(carries)))
            if len(wrong):
                depth, position = (batch.column(names.index(c)).to_numpy().copy() for c in ("depth", "position"))
                node, parent = (batch.column(names.index(c)).to_pylist() for c in ("node", "parent"))
                for i in wrong.tolist():
                    turns, tokens, value = carries[int(part[i])]
                    ahead = value * pow(_BASE, int(depth[i]), _MODULUS)
                    parent[i] = _bytes((ahead + int.from_bytes(parent[i] or b"", "big")) % _MODULUS)
                    node[i] = _bytes((ahead * _BASE + int.from_bytes(node[i], "big")) % _MODULUS)
                    depth[i] += turns
                    position[i] += tokens
                for name, values in (("depth", depth), ("position", position), ("node", node), ("parent", parent)):
                    at = names.index(name)
                    batch = batch.set_column(at, batch.schema.field(at), pa.array(values, batch.schema.field(at).type))
            yield batch

    return run


def _nodes(rows: DataFrame) -> DataFrame:
    """Every beginning once, with the row that stands for it; ``light`` ones are roots and
    branches with fewer conversations than another of the same parent."""
    stands = F.min(F.struct("part", "seq", "conversation")).alias("row")
    same = [F.min(c).alias(c) for c in ("parent", "depth", "position", "length")]
    nodes = rows.groupBy("node").agg(stands, F.count(F.lit(1)).alias("conversations"), *same)
    nodes = nodes.select("node", "row.*", "conversations", "parent", "depth", "position", "length")
    heavy = nodes.filter("parent is not null").groupBy("parent").agg(F.max_by("node", F.struct("conversations", "node")).alias("heavy"))
    return nodes.join(heavy.select("heavy"), F.col("node") == F.col("heavy"), "left").select(
        *nodes.columns, F.col("heavy").isNull().alias("light")
    )


def _paths(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """By conversation that stands for a node: the light nodes on its way, by depth.

    Each of them at least halves the conversations, so that there are at most one more than
    the binary logarithm of their number.
    """
    owners = nodes.select(F.col("conversation").alias("owner")).distinct()
    mine = rows.join(owners, F.col("conversation").eqNullSafe(F.col("owner")), "left_semi")
    found = mine.select("conversation", "node").join(nodes.filter("light").select("node", "depth", "position"), "node")
    return found.groupBy("conversation").agg(F.sort_array(F.collect_list(F.struct("depth", "node", "position"))).alias("path"))


def _with_path(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    known = paths.withColumnRenamed("conversation", "owner")
    joined = nodes.join(known, F.col("conversation").eqNullSafe(F.col("owner"))).drop("owner")
    return joined.withColumn("path", F.filter("path", lambda p: p["depth"] <= F.col("depth")))


def _number(value: Column) -> Column:
    return F.unhex(F.lpad(F.hex(value), 16, "0"))


def _placed(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """Nodes with ``place``, bytes that sort as the trees are laid out.

    Of the branches that leave a heavy way the deepest come first, and all of them behind the
    way itself: hence the depth counted from above, and 0 for the way.
    """
    most = F.lit((1 << 63) - 1)
    turns_off = F.aggregate("path", F.lit(b""), lambda a, p: F.concat(a, _number(most - p["depth"]), p["node"]))
    place = F.concat(turns_off, _number(F.lit(0)), _number(F.col("depth")))
    placed = _with_path(nodes, paths).withColumn("place", place)
    return placed.withColumn("tree", F.col("path")[0]["node"]).drop("path", "parent", "light")


def _laid_out(spark: SparkSession, placed: DataFrame, folder: str) -> DataFrame:
    """Nodes with ``begin``, a running sum over a tree that is split over tasks."""
    schema = T.StructType([*placed.schema.fields, *T.StructType.fromDDL("task int, begin long, fresh boolean").fields])
    ranged = placed.repartitionByRange("place").sortWithinPartitions("place")
    local = staged(ranged.mapInArrow(_begins, schema), "layout", folder=folder)
    ends = local.groupBy("task").agg(
        F.min_by("tree", "place").alias("first"), F.max_by(F.struct("tree", (F.col("begin") + F.col("length")).alias("end")), "place").alias("last")
    )
    carries, before = [], (None, 0)
    for r in sorted(ends.collect(), key=lambda r: r.task):
        ahead = before[1] if before[0] == r.first else 0
        carries.append((r.task, ahead))
        before = r.last.tree, r.last.end + (ahead if r.first == r.last.tree else 0)
    known = spark.createDataFrame(carries, "task int, ahead long")  # a row a task
    ahead = F.when(~F.col("fresh"), F.col("ahead")).otherwise(0)
    return local.join(F.broadcast(known), "task").withColumn("begin", F.col("begin") + ahead).drop("task", "fresh", "ahead", "place")


def _begins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task, now, begin, fresh = TaskContext.get().partitionId(), None, 0, False
    for batch in batches:
        begins, news = [], []
        for tree, length in zip(batch.column("tree").to_pylist(), batch.column("length").to_pylist()):
            if now is not None and tree != now:
                begin, fresh = 0, True
            now = tree
            begins.append(begin)
            news.append(fresh)
            begin += length
        added = [pa.array([task] * len(begins), pa.int32()), pa.array(begins, pa.int64()), pa.array(news, pa.bool_())]
        yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, "task", "begin", "fresh"])


def _attention(laid: DataFrame, paths: DataFrame) -> DataFrame:
    """Nodes with ``attends``: on every heavy way to a node the tokens from where its
    conversations enter the way to where they leave it."""
    turn = paths.select("conversation", F.explode("path").alias("p")).select("conversation", "p.*")
    heads = laid.select("node", F.col("begin").alias("enters"))
    ways = turn.join(heads, "node").groupBy("conversation").agg(
        F.sort_array(F.collect_list(F.struct("depth", "position", "enters"))).alias("path")
    )
    ends = F.concat(F.transform(F.slice("path", 2, F.size("path")), lambda p: p["position"]), F.array("position"))
    attends = F.transform(
        F.arrays_zip(F.col("path").alias("way"), ends.alias("leaves")),
        lambda z: F.struct(z["way"]["enters"].alias("first"), (z["way"]["enters"] + z["leaves"] - z["way"]["position"]).alias("end")),
    )
    nodes = _with_path(laid, ways)
    return nodes.withColumn("attends", F.filter(attends, lambda a: a["first"] < a["end"])).drop("path")


def _read(codec: Any):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Codec(*codec.value)
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                some = batch.slice(first, 512)
                out: list[tuple] = []
                for tokens, begin, end in zip(*(some.column(i).to_pylist() for i in (1, 2, 3))):
                    role, text, chars = coder.read(tokens)
                    loss = coder.template.show(coder.decode(tokens[begin:end]))
                    # The text under the mask, sent only where it is not the whole text.
                    out.append((role, text, end > begin, None if loss == text else loss, chars))
                kinds = [pa.string(), pa.string(), pa.bool_(), pa.string(), pa.int64()]
                columns = [some.column(0), *(pa.array(v, k) for v, k in zip(zip(*out), kinds))]
                yield pa.RecordBatch.from_arrays(columns, ["node", "role", "text", "masked", "loss", "chars"])

    return run


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = None
    turns, loss = sha256(), sha256()
    now: Any = None
    count = loss_chars = chars = 0

    def row() -> pa.RecordBatch:
        values = [now, count, turns.hexdigest(), loss_chars, loss.hexdigest(), chars]
        kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    done: list[pa.RecordBatch] = []
    for batch in batches:
        kind = batch.column("conversation").type
        columns = [batch.column(c).to_pylist() for c in ("conversation", "role", "text", "masked", "loss", "chars")]
        for conversation, role, text, masked, other, size in zip(*columns):
            if count and conversation != now:
                done.append(row())
                turns, loss, count, loss_chars, chars = sha256(), sha256(), 0, 0, 0
            now = conversation
            turns.update(f"{role}\n{text}\n".encode())
            if masked:
                trained = text if other is None else other
                loss.update(trained.encode())
                loss_chars += len(trained)
            count, chars = count + 1, chars + size
        if done:
            yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
            done = []
    if count:
        yield row()
