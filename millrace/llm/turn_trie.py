"""A prefix trie of conversations, built from adaptive radix trees.

Every turn gets an id of fixed width: 16 bytes of a digest of role and text, then the length of the text, big-endian.
A conversation is the bytes of its turns in a row. Equal conversations are put together first, in blocks of their ids,
then distinct ones are dealt out by ranges of their bytes. Each task puts a stretch of ``SEGMENT`` sequences at a time
into an adaptive radix tree, which branches at bytes; nodes of the trie are taken only where a turn ends, at multiples
of the id width, also inside compressed paths.

A sequence range cuts the trie only along its first and its last sequence. Nodes that begin neither of them are whole
and leave the task at once. Nodes along those two paths may go on in the next stretch, so each stretch hands on two
paths of partial sums; these are merged in the order of their bytes with a stack as deep as the longest path. That
step sees two paths for every ``SEGMENT`` sequences, not the sequences.

The rebuilt conversations: ``h`` is the CRC-32 of the decimal id modulo 9. The first ``h`` turns come from the
conversation whose id is the next lower multiple of 5 (towards zero), the others are the own ones from turn ``h`` on.

Defined cases: turns follow ``turn``, null first, then role and text, so repeated rows stay and ties are settled. A
null role or text is empty. Rows without ``conv_id`` belong to no conversation and are left out. A conversation
without turns is a member of the root alone. Extra columns are not read. An empty table has no root. The turns of one
conversation have to fit into one row, that is 100 million of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.radix import RadixTree, common
from millrace.llm.ship import shipped
from millrace.llm.words import bounded, stored

WIDTH, LENGTH_BYTES = 20, 4
SHARED, EVERY = 9, 5
# Conversations of one sequence whose ids are put into one text, by ranges of ids.
BLOCK = 1 << 16
# Sequences and bytes of them in one radix tree.
SEGMENT, SEGMENT_BYTES = 20_000, 16 << 20
# Turns of a sequence that Spark's sample for the ranges may hold.
RANGE_TURNS = 50
NO_ENDS = hashlib.sha256(b"").hexdigest()

NODE = [("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string())]
PLACE = [("segment", pa.int64()), ("side", pa.int64()), ("at", pa.int64())]
PART = pa.struct([("n", pa.int64()), ("least", pa.int64()), ("children", pa.int64()), ("leaves", pa.int64()), ("saved", pa.int64()), ("ends", pa.string())])
PATH = [("key", pa.binary()), ("parts", pa.list_(PART))]
KINDS = {pa.int64(): "bigint", pa.string(): "string", pa.binary(): "binary"}
COLUMNS = [name for name, _ in NODE]


def _kind(fields: list) -> str:
    part = "struct<" + ",".join(f"{f.name}:{KINDS[f.type]}" for f in PART) + ">"
    return ", ".join(f"{name} {KINDS.get(t, f'array<{part}>')}" for name, t in fields)


def turn_id(role: Column, text: Column) -> Column:
    """Hexadecimal id of a turn; the length before the role keeps role and text apart."""
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    return F.concat(F.substring(digest, 1, 2 * (WIDTH - LENGTH_BYTES)), F.lpad(F.hex(F.octet_length(text)), 2 * LENGTH_BYTES, "0"))


def sequences(conversations: DataFrame) -> DataFrame:
    """``conv_id, key``: the turn ids of each conversation in a row."""
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", *(F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")))
    nth = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text"))
    rows = rows.select("conv_id", nth.alias("nth"), turn_id(F.col("role"), F.col("text")).alias("id"))
    turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("nth", "id"))).alias("turns"))
    return turns.select("conv_id", F.unhex(F.array_join("turns.id", "")).alias("key"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """``conv_id, key`` of the rebuilt conversations."""
    own = stored(sequences(conversations), "sequences")
    cut = (F.crc32(F.col("conv_id").cast("string")) % SHARED * WIDTH).cast("int")
    own = own.select("conv_id", "key", (F.col("conv_id") - F.col("conv_id") % EVERY).alias("donor"), cut.alias("cut"))
    donors = own.where(F.col("conv_id") == F.col("donor")).select("donor", F.substring("key", 1, (SHARED - 1) * WIDTH).alias("head"))
    both = own.join(donors, "donor", "left")
    head = F.substr(F.coalesce("head", F.lit(b"")), F.lit(1), F.col("cut"))
    return both.select("conv_id", F.concat(head, F.substr("key", F.col("cut") + 1)).alias("key"))


class _Segment:
    """Distinct sequences in ascending order, with the number, least id and digest of their conversations."""

    def __init__(self, number: int):
        self.number, self.size = number, 0
        self.keys: list[bytes] = []
        self.members: list[tuple[int, int, str]] = []

    def add(self, key: bytes, n: int, least: int, ends: str) -> None:
        self.keys.append(key)
        self.members.append((n, least, ends))
        self.size += len(key)

    def rows(self) -> Iterator[pa.RecordBatch]:
        """Nodes that are whole, with the place of an open parent, and the two open paths."""
        tree = RadixTree()
        for i, key in enumerate(self.keys):
            tree.insert(key, i)
        first, last = self.keys[0], self.keys[-1]
        out: list[list] = [[] for _ in range(len(NODE) + len(PLACE))]
        paths: tuple[list, list] = ([], [])
        # Per open tree node: members, least id, a key, and of the nodes right below it: rows, leaves, saved tokens.
        stack: list[list] = []
        for done, node, start, end, left, right in tree.walk():
            if not done:
                stack.append([0, None, -1, [], 0, 0])
                continue
            n, least, some, tops, leaves, saved = stack.pop()
            ends = None
            if node.value >= 0:
                m, low, ends = self.members[node.value]
                n, least, some = n + m, low if least is None else min(low, least), node.value
            for depth in range(end // WIDTH, -(-start // WIDTH) - 1, -1):
                on = ends if depth * WIDTH == end else None
                side = 0 if left and depth * WIDTH <= len(first) else 1 if right else None
                if side is None:
                    size = int.from_bytes(self.keys[some][depth * WIDTH - LENGTH_BYTES : depth * WIDTH]) if depth else 0
                    children, leaves, saved = len(tops), leaves or 1, saved + (n - 1) * size
                    for row in tops:
                        out[2][row] = least
                    tops = [len(out[0])]
                    for column, value in zip(out, (least, depth, None, n, children, leaves, saved, on or NO_ENDS, None, None, None), strict=True):
                        column.append(value)
                else:
                    paths[side].append({"n": n, "least": least, "children": len(tops), "leaves": leaves, "saved": saved, "ends": on})
                    for row in tops:
                        out[8][row], out[9][row], out[10][row] = self.number, side, depth
                    tops, leaves, saved = [], 0, 0
            if stack:
                above = stack[-1]
                above[0] += n
                above[1] = least if above[1] is None else min(above[1], least)
                above[2] = some
                above[3] += tops
                above[4] += leaves
                above[5] += saved
        kinds = NODE + PLACE
        yield from _batches([pa.array(c, t) for c, (_, t) in zip(out, kinds, strict=True)], kinds)
        # A path's partial sums, from the top down; the second one begins below the nodes it shares with the first.
        shared = len(last) // WIDTH + 1 - len(paths[1])
        rows = [(self.number, s, at, key, parts[::-1]) for s, at, key, parts in ((0, 0, first, paths[0]), (1, shared, last, paths[1])) if parts]
        kinds = PLACE + PATH
        yield from _batches([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), kinds, strict=True)], kinds)


ALL = NODE + PLACE + PATH


def _batches(arrays: list[pa.Array], fields: list) -> Iterator[pa.RecordBatch]:
    """Columns as batches of all fields, the missing ones null."""
    have, n = dict(zip([name for name, _ in fields], arrays, strict=True)), len(arrays[0])
    table = pa.table([have.get(name, pa.nulls(n, t)) for name, t in ALL], schema=pa.schema(ALL))
    yield from table.to_batches(max_chunksize=20_000)


def _partial(members: DataFrame, segment: int) -> DataFrame:
    """Whole nodes and open paths of sequences that come in ascending order, with the ids of their conversations."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 32
        held = _Segment(first)
        key, n, least, ends = None, 0, None, hashlib.sha256()
        for batch in batches:
            for now, m, low, ids in zip(*(batch.column(c).to_pylist() for c in ("key", "n", "least", "ids")), strict=True):
                if now != key:
                    if key is not None:
                        held.add(key, n, least, ends.hexdigest())
                    if len(held.keys) >= segment or held.size >= SEGMENT_BYTES:
                        yield from held.rows()
                        held = _Segment(held.number + 1)
                    key, n, least, ends = now, 0, low, hashlib.sha256()
                ends.update((("," if n else "") + ids).encode())
                n, least = n + m, min(least, low)
        if key is not None:
            held.add(key, n, least, ends.hexdigest())
            yield from held.rows()

    return members.mapInArrow(run, _kind(ALL))


class _Open:
    """A node on the path that is being merged."""

    __slots__ = ("below", "children", "ends", "least", "leaves", "n", "places", "saved", "size")

    def __init__(self, size: int):
        self.size, self.n, self.least, self.children, self.leaves, self.saved, self.ends = size, 0, None, 0, 0, 0, None
        self.places: list[tuple[int, int]] = []
        self.below: list[tuple] = []

    def add(self, part: dict) -> None:
        self.n += part["n"]
        self.least = part["least"] if self.least is None else min(self.least, part["least"])
        self.children, self.leaves, self.saved = self.children + part["children"], self.leaves + part["leaves"], self.saved + part["saved"]
        self.ends = part["ends"] or self.ends


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Open nodes, finished, and for every place where stretches knew one its conversation."""
    stack: list[_Open] = []
    path, nodes, places = b"", [], []

    def close() -> None:
        node, depth = stack.pop(), len(stack)
        saved, leaves = node.saved + (node.n - 1) * node.size, node.leaves or 1
        nodes.extend((*row[:2], node.least, *row[3:]) for row in node.below)
        places.extend((node.least, segment, side, depth) for segment, side in node.places)
        row = (node.least, depth, None, node.n, node.children, leaves, saved, node.ends or NO_ENDS)
        if stack:
            above = stack[-1]
            above.children, above.leaves, above.saved = above.children + 1, above.leaves + leaves, above.saved + saved
            above.below.append(row)
        else:
            nodes.append(row)

    def made() -> Iterator[pa.RecordBatch]:
        for rows, fields in ((nodes, NODE), (places, [NODE[0], *PLACE])):
            if rows:
                yield from _batches([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), fields, strict=True)], fields)
                rows.clear()

    for batch in batches:
        for row in batch.to_pylist():
            key = row["key"]
            while len(stack) - 1 > common(path, key) // WIDTH:
                close()
            for depth, part in enumerate(row["parts"], row["at"]):
                if depth == len(stack):
                    stack.append(_Open(int.from_bytes(key[depth * WIDTH - LENGTH_BYTES : depth * WIDTH]) if depth else 0))
                stack[depth].add(part)
                if part["children"]:
                    stack[depth].places.append((row["segment"], row["side"]))
            path = key
            if len(nodes) + len(places) > 20_000:
                yield from made()
    while stack:
        close()
    yield from made()


def trie(sequences: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """All nodes of the trie of ``conv_id, key``, one row a conversation."""
    shipped(sequences.sparkSession)
    block = F.floor(F.col("conv_id") / BLOCK)
    members = sequences.groupBy("key", block.alias("block")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    members = members.select("key", "block", F.size("ids").cast("bigint").alias("n"), F.get("ids", F.lit(0)).alias("least"), F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))
    ranges = members.repartitionByRange(F.substring("key", 1, RANGE_TURNS * WIDTH)).sortWithinPartitions("key", "block")
    found = stored(_partial(ranges, segment), "trie")
    paths = found.where("key is not null").repartition(1).sortWithinPartitions("key", "segment", "side")
    merged = stored(paths.mapInArrow(_merge, _kind(ALL)), "paths")
    whole, opened = found.where("key is null"), merged.where("segment is null").select(*COLUMNS)
    inner = whole.where("segment is null").select(*COLUMNS)
    places = bounded(merged.where("segment is not null").select("segment", "side", "at", F.col("conv_id").alias("parent")))
    outer = whole.join(places, ["segment", "side", "at"])
    outer = outer.select(*(F.col("parent" if c == "parent_conv_id" else c).alias(c) for c in COLUMNS))
    return inner.unionByName(opened).unionByName(outer)


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """Nodes of the trie of the rebuilt conversations."""
    return trie(rebuilt(conversations))
