"""Format conversations as prefix trees: shared first turns are emitted once.

Conversations that begin with the same turns share the nodes of a tree. A tree is emitted depth-first as
one stream of token ids; each token has a position (its place in the conversation, not in the
stream), each node the stream intervals of its ancestors, which its tokens may attend to besides
their own node up to themselves. Texts and roles are escaped, so no text can pass for a control
string: a backslash goes before each backslash and "<", and a line feed in a role becomes "\\n".

Scale: equal conversations are one leaf. A tree is cut where more than ``LEAVES`` leaves hang below a
node: its children are dealt to as many shards, each of which repeats the nodes above the cut.
So a first turn shared by a third of all conversations is many streams of bounded size. Prefixes are
counted by aggregation that combines before the shuffle. A shard is built by one task from its leaves.

Defined results: turns are ordered by number (null first), then role and text; rows that agree in all
are turns of their own. A null text or role counts as empty. Null conversation ids are one
conversation. An assistant's turn is learnt from: the loss mask covers its text and nothing else.
Other columns are ignored. No rows give no rows.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from salesloom.llm.common import ship
from salesloom.operators.staging import stage

#: Control strings: begin of a turn, end of its role, end of a turn.
BEGIN, ROLE_END, END = "<turn>", "\n", "</turn>\n"
#: The role whose texts are learnt from.
LEARNT = "assistant"
#: Leaves below a node from which its children are dealt to several shards.
LEAVES = 256

_INTERVAL = pa.struct([("start", pa.int32()), ("stop", pa.int32())])
_NODE = pa.struct(
    [("start", pa.int32()), ("stop", pa.int32()), ("position", pa.int32()), ("ancestors", pa.list_(_INTERVAL))]
)
_LEAF = pa.struct([("leaf", pa.binary()), ("node", pa.int32())])
_STREAM = pa.schema(
    [
        ("ids", pa.list_(pa.int32())),
        ("positions", pa.list_(pa.int32())),
        ("loss", pa.list_(pa.bool_())),
        ("nodes", pa.list_(_NODE)),
        ("leaves", pa.list_(_LEAF)),
    ]
)
_INTERVALS = "array<struct<start:int,stop:int>>"
STREAMS = (
    "ids array<int>, positions array<int>, loss array<boolean>, "
    f"nodes array<struct<start:int,stop:int,position:int,ancestors:{_INTERVALS}>>, "
    "leaves array<struct<leaf:binary,node:int>>"
)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<", "\\<")


def unescape(text: str) -> str:
    parts = text.split("\\\\")
    return "\\".join(p.replace("\\<", "<") for p in parts)


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def unescape_role(role: str) -> str:
    parts = role.split("\\\\")
    return "\\".join(p.replace("\\n", "\n").replace("\\<", "<") for p in parts)


def conversations_of(rows: DataFrame) -> DataFrame:
    """(conv_id, turns, path): turns in order, and a digest of each prefix."""
    turn = F.struct(
        F.col("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    def step(path: Column, t: Column) -> Column:
        above = F.when(F.size(path) == 0, F.lit("")).otherwise(F.get(path, F.size(path) - 1))
        size = F.length(t["role"]).cast("string")
        return F.concat(path, F.array(F.md5(F.concat(above, size, F.lit(":"), t["role"], t["text"]).cast("binary"))))

    path = F.aggregate("turns", F.array().cast("array<string>"), step)
    return grouped.select(
        "conv_id",
        F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"),
        path.alias("path"),
    )


def with_shards(leaves: DataFrame, most: int = LEAVES) -> DataFrame:
    """Add ``shard``: below the deepest prefix of more than ``most`` leaves, children are dealt by hash.

    Such prefixes are few, at most the number of all prefixes divided by ``most``.
    """
    prefixes = leaves.select("leaf", F.posexplode("path").alias("depth", "prefix"))
    large = stage(
        prefixes.groupBy("prefix").agg(F.count(F.lit(1)).alias("below")).where(F.col("below") > most),
        "chat_large",
    )
    deepest = (
        prefixes.join(large, "prefix")
        .groupBy("leaf")
        .agg(F.max(F.struct("depth", "prefix", "below")).alias("cut"))
    )
    child = F.coalesce(F.get("path", F.col("cut.depth") + 1), F.col("cut.prefix"))
    deals = F.ceil(F.col("cut.below") / most)
    cut = F.concat_ws("/", F.col("cut.prefix"), F.pmod(F.xxhash64(child), deals).cast("string"))
    whole_tree = F.get("path", F.lit(0))
    return leaves.join(deepest, "leaf", "left").select(
        "leaf", "turns", "path", F.when(F.col("cut").isNull(), whole_tree).otherwise(cut).alias("shard")
    )


class Emitter:
    """Build one stream from leaves that come in the order of their paths."""

    def __init__(self, tokenizer: Tokenizer):
        self.tokenizer = tokenizer

    def node(self, role: str, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of a turn, and which of them are learnt from."""
        head = f"{BEGIN}{escape_role(role)}{ROLE_END}"
        parts = self.tokenizer.encode_batch([head, escape(text), END], add_special_tokens=False)
        sizes = [len(e.ids) for e in parts]
        ids = np.fromiter((i for e in parts for i in e.ids), np.int32, sum(sizes))
        loss = np.zeros(len(ids), bool)
        loss[sizes[0] : sizes[0] + sizes[1]] = role == LEARNT
        return ids, loss

    def stream(self, leaves: list[tuple[bytes, list[str], list[dict]]]) -> pa.RecordBatch:
        """One row of ``STREAMS`` for leaves (leaf, path, turns) of a shard."""
        ids, positions, loss, nodes, ends = [], [], [], [], []
        stack: list[tuple[str, int]] = []  # the path to the last node: (prefix, its index)
        end = 0
        for leaf, path, turns in sorted(leaves, key=lambda x: x[1]):
            same = 0
            while same < min(len(stack), len(path)) and stack[same][0] == path[same]:
                same += 1
            del stack[same:]
            for prefix, turn in zip(path[same:], turns[same:]):
                tokens, learnt = self.node(turn["role"], turn["text"])
                ancestors = [{k: nodes[i][k] for k in ("start", "stop")} for _, i in stack]
                first = sum(a["stop"] - a["start"] for a in ancestors)
                start, end = end, end + len(tokens)
                ids.append(tokens)
                positions.append(np.arange(first, first + len(tokens), dtype=np.int32))
                loss.append(learnt)
                stack.append((prefix, len(nodes)))
                nodes.append({"start": start, "stop": end, "position": first, "ancestors": ancestors})
            ends.append({"leaf": leaf, "node": stack[-1][1]})
        flat = [pa.array(np.concatenate(x)) for x in (ids, positions, loss)]
        columns = [pa.ListArray.from_arrays(pa.array([0, end], pa.int32()), x) for x in flat]
        columns += [pa.array([nodes], _STREAM.field("nodes").type), pa.array([ends], _STREAM.field("leaves").type)]
        return pa.RecordBatch.from_arrays(columns, schema=_STREAM)


def _load(path: str) -> Tokenizer:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task per core
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
    return tokenizer


def streams(leaves: DataFrame, tokenizer: str) -> DataFrame:
    """One row of ``STREAMS`` per shard of (leaf, turns, path, shard).

    ``tokenizer`` is the path of a byte-level tokenizer file, which gives any text back.
    """
    ship(leaves.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emit = Emitter(_load(tokenizer))
        shard, held = None, []
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for name, leaf, path, turns in zip(*(c.to_pylist() for c in part.columns)):
                    if held and name != shard:
                        yield emit.stream(held)
                        held = []
                    shard = name
                    held.append((leaf, path, turns))
        if held:
            yield emit.stream(held)

    return (
        leaves.select("shard", "leaf", "path", "turns")
        .repartition("shard")
        .sortWithinPartitions("shard")
        .mapInArrow(run, STREAMS)
    )


def read_turn(text: str) -> tuple[str, str]:
    """(role, text) of a formatted turn."""
    if not (text.startswith(BEGIN) and text.endswith(END)):
        raise ValueError("not a turn")
    role, body = text[len(BEGIN) : -len(END)].split(ROLE_END, 1)
    return unescape_role(role), unescape(body)


def read_back(trees: DataFrame, tokenizer: str) -> DataFrame:
    """What streams hold, leaf by leaf: numbers and digests of turns and of the text under the loss mask."""
    ship(trees.sparkSession)
    fields = [
        ("leaf", pa.binary()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
    ]
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = _load(tokenizer).decode
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in ("ids", "loss", "nodes", "leaves")}
                ids, loss = (np.asarray(row[name].values) for name in ("ids", "loss"))
                nodes, leaves = row["nodes"].as_py(), row["leaves"].as_py()
                texts, learnt = [], []
                for n in nodes:
                    tokens, mask = ids[n["start"] : n["stop"]], loss[n["start"] : n["stop"]]
                    texts.append(decode(tokens.tolist(), skip_special_tokens=False))
                    learnt.append(unescape(decode(tokens[mask].tolist(), skip_special_tokens=False)))
                at = {n["start"]: k for k, n in enumerate(nodes)}
                rows = []
                for leaf in leaves:
                    node = nodes[leaf["node"]]
                    path = [at[a["start"]] for a in node["ancestors"]] + [leaf["node"]]
                    turns = "".join("%s\n%s\n" % read_turn(texts[k]) for k in path)
                    said = "".join(learnt[k] for k in path)
                    rows.append(
                        (
                            leaf["leaf"],
                            len(path),
                            sha256(turns.encode()).hexdigest(),
                            len(said),
                            sha256(said.encode()).hexdigest(),
                            sum(len(texts[k]) for k in path),
                        )
                    )
                columns = zip(*rows) if rows else [[]] * len(schema)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema
                )

    return trees.select("ids", "loss", "nodes", "leaves").mapInArrow(
        run,
        "leaf binary, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )


def format_conversations(rows: DataFrame, tokenizer: str) -> tuple[DataFrame, DataFrame]:
    """(streams, members): the emitted trees, and the leaf of each conv_id."""
    conversations = stage(
        conversations_of(rows).withColumn("leaf", F.unhex(F.get("path", F.size("path") - 1))), "chat_conversations"
    )
    leaves = conversations.groupBy("leaf").agg(F.min(F.struct("path", "turns")).alias("one"))
    leaves = stage(leaves.select("leaf", "one.path", "one.turns"), "chat_leaves")
    trees = stage(streams(with_shards(leaves), tokenizer), "chat_streams")
    return trees, conversations.select("conv_id", "leaf")
