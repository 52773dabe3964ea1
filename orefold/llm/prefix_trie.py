"""Prefix trie of conversations from vertical bitmaps, shard by shard.

A node is a distinct sequence of first turns. It is named by its path, a
128-bit cryptographic digest of the sequence, the same in every shard. A shard
holds a range of conversation ids, so its lists of ids are in order and follow
those of the shard before.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

ROOT = b"\0" * 16
_ROWS = 4_096

NODE = (
    "path binary, parent binary, shard long, place long, depth long, conv_id long, n_convs long, size long, "
    "has_child boolean, ends string"
)


# --- turns ------------------------------------------------------------------


def turn_key(role: Column, text: Column) -> Column:
    """16 bytes of the SHA-256 of role and text; null counts as empty."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    marked = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.unhex(F.sha2(marked, 256)), 1, 16)


def keyed_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, key, size): all that the trie needs of a turn.

    `size` counts the code points of the text. Rows without conv_id belong to
    no conversation and go.
    """
    return conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        turn_key(F.col("role"), F.col("text")).alias("key"),
        F.char_length(F.coalesce("text", F.lit(""))).cast("long").alias("size"),
    )


# --- a shard ----------------------------------------------------------------


def _step(path: bytes, key: bytes) -> bytes:
    return hashlib.blake2b(path + key, digest_size=16).digest()


class Shard:
    """Conversations in ascending order of id; the nodes of their trie in preorder.

    Turns are indexed vertically: `postings[position, key]` is the bitmap of the
    conversations with that turn there. Bit i is conversation i of the shard.
    """

    def __init__(self, ids: list[int], turns: list[list[tuple[bytes, int]]]):
        self.ids, self.turns = ids, turns
        self.postings: dict[tuple[int, bytes], int] = defaultdict(int)
        self.over: dict[int, int] = defaultdict(int)  # by length, the conversations that end there
        for i, own in enumerate(turns):
            bit = 1 << i
            for position, (key, _) in enumerate(own):
                self.postings[position, key] |= bit
            self.over[len(own)] |= bit

    def _members(self, bits: int) -> Iterator[int]:
        while bits:
            low = bits & -bits
            yield self.ids[low.bit_length() - 1]
            bits ^= low

    def nodes(self) -> Iterator[tuple]:
        """Depth first: the children of a node are intersections of its bitmap with postings.

        The lowest conversation not yet in a child names the next posting. A
        node with one conversation has no branches below: its turns follow.
        """
        shard = self.ids[0]
        place = 0
        waiting = [(ROOT, None, 0, 0, (1 << len(self.ids)) - 1)]
        while waiting:
            path, parent, depth, size, bits = waiting.pop()
            ended = bits & self.over.get(depth, 0)
            going = bits ^ ended
            ends = ",".join(map(str, self._members(ended)))
            first = (bits & -bits).bit_length() - 1
            yield path, parent, shard, place, depth, self.ids[first], bits.bit_count(), size, going > 0, ends
            place += 1
            if going and not bits & (bits - 1):
                yield from chain(self.ids[first], self.turns[first][depth:], path, depth, shard, place, True)
                place += len(self.turns[first]) - depth
                continue
            below = []
            while going:
                low = (going & -going).bit_length() - 1
                key, length = self.turns[low][depth]
                child = going & self.postings[depth, key]
                below.append((_step(path, key), path, depth + 1, length, child))
                going ^= child
            waiting.extend(reversed(below))


def chain(conv_id: int, turns, path: bytes, depth: int, shard: int, place: int, ends: bool) -> Iterator[tuple]:
    """The nodes of further turns of one conversation; with `ends` it is over after them."""
    for i, (key, size) in enumerate(turns):
        parent, path = path, _step(path, key)
        last = ends and i == len(turns) - 1
        yield path, parent, shard, place + i, depth + i + 1, conv_id, 1, size, not last, str(conv_id) if last else ""


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= _ROWS:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


_KINDS = {"binary": pa.binary(), "long": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}


def _arrow(schema: str) -> pa.Schema:
    return pa.schema([(name, _KINDS[kind]) for name, kind in (field.split() for field in schema.split(", "))])


def _sharding(shard_turns: int):
    """Cuts rows that come in order of conversation into shards of about `shard_turns` turns."""

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        ids: list[int] = []
        turns: list[list[tuple[bytes, int]]] = []
        held = 0
        long: tuple[bytes, int] | None = None  # path and depth of a conversation that is a shard by itself
        for batch in batches:
            for conv_id, key, size in zip(*(batch[c].to_pylist() for c in ("conv_id", "key", "size"))):
                if not ids or ids[-1] != conv_id:
                    if long is not None:
                        yield from chain(ids[0], turns[0], *long, ids[0], long[1] + 1, True)
                        ids, turns, held, long = [], [], 0, None
                    elif held >= shard_turns:
                        yield from Shard(ids, turns).nodes()
                        ids, turns, held = [], [], 0
                    ids.append(conv_id)
                    turns.append([])
                    held += 1
                if key is None:  # says that the conversation exists
                    continue
                turns[-1].append((key, size))
                held += 1
                if len(turns[-1]) <= shard_turns:
                    continue
                if len(ids) > 1:
                    yield from Shard(ids[:-1], turns[:-1]).nodes()
                    ids, turns = ids[-1:], turns[-1:]
                if long is None:
                    long = ROOT, 0
                    yield ROOT, None, conv_id, 0, 0, conv_id, 1, 0, True, ""
                # The last turn stays, as it may be the end.
                part, turns[0] = turns[0][:-1], turns[0][-1:]
                for row in chain(conv_id, part, *long, conv_id, long[1] + 1, False):
                    yield row
                long = row[0], row[4]
        if long is not None:
            yield from chain(ids[0], turns[0], *long, ids[0], long[1] + 1, True)
        elif ids:
            yield from Shard(ids, turns).nodes()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(nodes(batches), _arrow(NODE))

    return build


# --- all shards -------------------------------------------------------------

_SUMS = "path binary, parent_conv_id long, n_children long, n_leaves long, saved_tokens long"


def _summing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per node of a shard its share of the subtree sums.

    Rows come in falling preorder, so all below a node has been met before it;
    what is open is one sum and the waiting children per depth. A node counts
    in the one shard that has its smallest conversation.
    """

    def rows() -> Iterator[tuple]:
        now = None
        for batch in batches:
            columns = ("path", "shard", "depth", "n_convs", "size", "owned", "leaf", "smallest")
            for path, shard, depth, n, size, owned, leaf, smallest in zip(*(batch[c].to_pylist() for c in columns)):
                if shard != now:
                    now, sums, children = shard, {}, {}
                leaves, saved = sums.pop(depth + 1, (0, 0))
                below = children.pop(depth + 1, [])
                for child in below:
                    yield (child[0], smallest, *child[1:])
                leaves += owned and leaf
                saved += n * size - (size if owned else 0)
                own = (path, sum(child[4] for child in below), leaves, saved, owned)
                before = sums.get(depth, (0, 0))
                sums[depth] = before[0] + leaves, before[1] + saved
                if depth:
                    children.setdefault(depth, []).append(own)
                else:
                    yield (path, None, *own[1:])

    def shares() -> Iterator[tuple]:
        for path, parent, n_children, leaves, saved, owned in rows():
            yield path, parent if owned else None, n_children, leaves, saved

    yield from _batches(shares(), _arrow(_SUMS))


def _hashing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the joined lists of each path; the lists come in order and are not kept."""

    def rows() -> Iterator[tuple]:
        now, digest = None, None
        for batch in batches:
            for path, ends in zip(batch["path"].to_pylist(), batch["ends"].to_pylist()):
                if path != now:
                    if now is not None:
                        yield now, digest.hexdigest()
                    now, digest = path, hashlib.sha256(ends.encode())
                else:
                    digest.update(b"," + ends.encode())
        if now is not None:
            yield now, digest.hexdigest()

    yield from _batches(rows(), _arrow("path binary, ends_sha256 string"))


def shard_nodes(turns: DataFrame, members: DataFrame | None = None, *, shard_turns: int = 1 << 14) -> DataFrame:
    """The trie of each shard, stored: `NODE`, with the ids of the conversations that end at a node.

    `turns` is as `keyed_turns` gives it. `members` (conv_id) names
    conversations that may have no turns.
    """
    rows = turns.select("conv_id", F.lit(1).alias("part"), "turn", "key", "size")
    if members is not None:
        named = members.select("conv_id", F.lit(0).alias("part"), *(F.lit(None).cast("long").alias(c) for c in ("turn", "size")))
        rows = rows.unionByName(named.withColumn("key", F.lit(None).cast("binary")))
    in_order = rows.repartitionByRange("conv_id").sortWithinPartitions("conv_id", "part", F.asc_nulls_first("turn"), "key")
    return materialize(in_order.select("conv_id", "key", "size").mapInArrow(_sharding(shard_turns), NODE), "trie-shards")


def trie(shards: DataFrame) -> DataFrame:
    """Merges the nodes of all shards; one row per distinct node.

    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256, path.
    """
    nodes = materialize(
        shards.groupBy("path").agg(
            F.min("conv_id").alias("smallest"),
            F.max("depth").alias("depth"),
            F.sum("n_convs").alias("members"),
            F.max("has_child").alias("inner"),
        ),
        "trie-nodes",
    )
    known = nodes.select("path", "smallest", (~F.col("inner")).alias("leaf"))
    owned = F.col("conv_id") == F.col("smallest")
    in_shards = shards.drop("ends").join(known, "path").withColumn("owned", owned)
    upwards = in_shards.repartition("shard").sortWithinPartitions("shard", F.desc("place"))
    needed = upwards.select("path", "shard", "depth", "n_convs", "size", "owned", "leaf", "smallest")
    sums = (
        needed.mapInArrow(_summing, _SUMS)
        .groupBy("path")
        .agg(
            F.max("parent_conv_id").alias("parent_conv_id"),
            *(F.sum(name).alias(name) for name in ("n_children", "n_leaves", "saved_tokens")),
        )
    )
    lists = shards.filter("ends <> ''").select("path", "shard", "ends")
    ends = lists.repartition("path").sortWithinPartitions("path", "shard").select("path", "ends")
    digests = ends.mapInArrow(_hashing, "path binary, ends_sha256 string")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return (
        nodes.join(sums, "path")
        .join(digests, "path", "left")
        .select(
            F.col("smallest").alias("conv_id"),
            "depth",
            "parent_conv_id",
            F.col("members").alias("n_convs"),
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", nothing).alias("ends_sha256"),
            "path",
        )
    )


def prefix_trie(conversations: DataFrame, *, shard_turns: int = 1 << 14) -> DataFrame:
    """The trie of all conversations (conv_id, turn, role, text): see `trie`.

    Turns go by `turn`, null first, equal ones by a digest of role and text, and
    repeated rows are turns of their own. Null role or text counts as empty.
    Rows without conv_id belong to no conversation. Each distinct sequence of
    first turns is a node, from the root without turns. A conversation longer
    than a shard is worked through in parts; texts of any length count by a
    digest. Other columns are ignored. An empty table has no nodes.
    """
    return trie(shard_nodes(keyed_turns(conversations), shard_turns=shard_turns))


# --- rebuilding -------------------------------------------------------------


def rebuilt_turns(turns: DataFrame, *, group: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations that open as the first one of their group of ids does.

    Conversation c gets the first h turns of conversation c - c % group, h =
    crc32(decimal c) % most, then its own after its first h. Gives (turns,
    members); `turns` is `keyed_turns`, stored, and `members` has every conv_id.
    """
    of_conversation = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "key")
    placed = materialize(
        turns.withColumn("turn", (F.row_number().over(of_conversation) - 1).cast("long")), "trie-turns"
    )
    taken = F.crc32(F.col("conv_id").cast("string")) % most
    opening = placed.filter((F.col("turn") < most - 1) & (F.col("conv_id") % group == 0))
    members = placed.filter("turn = 0").select("conv_id")
    openings = opening.withColumnRenamed("conv_id", "opens")
    given = (
        members.withColumn("opens", F.col("conv_id") - F.col("conv_id") % group)
        .join(openings, "opens")
        .filter(F.col("turn") < taken)
        .drop("opens")
    )
    own = placed.filter(F.col("turn") >= taken)
    return given.unionByName(own), members
