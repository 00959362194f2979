"""Prefix trie over conversations: sorted turn arrays, common prefixes of neighbours, a stack sweep, and stacks stitched at the borders of partitions.

A turn is one unit of 24 bytes: 16 of the SHA-256 of its role and text, 8 of the text's length. A conversation is the string of
its units, so the order of these strings has the members of every node side by side, whatever texts mean to each other. The table is sorted
globally by (units, conversation). A task sweeps its rows with a stack that holds the path of the current conversation: the common prefix with the
next one says how much of it closes. A closing node adds what its subtree has to its parent and becomes a row.

What may go on in another task stays open: the path of a task's first row and that of its last. Each task gives these two paths with what it
knows of their nodes, and one more sweep over two rows a task closes them. The members that end at a node are hashed in
order; where they may go on in another task, their ids leave it as text in pieces, which are hashed in order afterwards, so that a
conversation that is repeated without end is one task's memory nowhere.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

UNIT = 24
_EMPTY = hashlib.sha256(b"").hexdigest()
_NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
#: name: which node a row is or waits for; parent: the node whose smallest member the row still needs.
_SWEPT = "kind string, part int, seq int, name binary, parent binary, " + _NODE + ", path binary, has binary, path_ends array<string>"


def turn_arrays(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, units (an array of hex strings, one a turn, in order), one row for each conversation.

    Turns are ordered by turn, null first, then role, then text; a null role or text is empty. Rows that repeat are turns of their own. Rows without
    a conversation's id are in none. A conversation's units (48 bytes a turn) have to fit in one row. Other columns are not read.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = df.where(F.col(conv_col).isNotNull()).select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"))
    size = F.octet_length("text").cast("long")
    unit = F.concat(F.substring(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256), 1, 32), F.lpad(F.hex(size), 16, "0"))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    placed = rows.select("conv_id", unit.alias("unit"), F.row_number().over(order).alias("place"))
    return placed.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "unit"))), lambda x: x["unit"]).alias("units"))


def share_heads(arrays: DataFrame, family: int = 5, longest: int = 8) -> DataFrame:
    """Every conversation c with its first turns replaced by those of c - c % family: h of them, h the CRC-32 of its decimal id modulo longest + 1; its own follow from the h-th on.

    All there are if the other has fewer, none if it isn't there.
    """
    c = F.col("conv_id")
    h = F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(longest + 1)).cast("int")
    heads = arrays.where(c % family == 0).select(c.alias("of"), F.slice("units", 1, longest).alias("head"))
    own = arrays.select("conv_id", (c - c % family).alias("of"), h.alias("h"), "units").join(heads, "of", "left")
    none = F.array().cast("array<string>")
    return own.select("conv_id", F.concat(F.slice(F.coalesce("head", none), F.lit(1), F.col("h")), F.slice("units", F.col("h") + 1, F.size("units"))).alias("units"))


def common_units(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // UNIT
    x, y = np.frombuffer(a, np.uint8, n), np.frombuffer(b, np.uint8, n)
    return int((x != y).argmax()) // UNIT


class Node:
    """What is known of a node: from members that end here and from children that are closed."""

    __slots__ = ("least", "n", "children", "leaves", "saved", "waiting", "flagged", "ends", "ids", "pieces")

    def __init__(self):
        self.least, self.n, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.waiting, self.flagged = [], False  # rows of children without this node's smallest member; whether others left without it
        self.ends, self.ids, self.pieces = None, [], False  # hash of the ids that end here; those not yet in a piece; whether there are pieces


def _name(state) -> bytes:
    return state.copy().digest()[:16]


def depth_of(path: bytes) -> int:
    return len(path) // UNIT


def _size(path: bytes, depth: int) -> int:
    return int.from_bytes(path[UNIT * depth - 8 : UNIT * depth], "big") if depth else 0


class Sweep:
    """The stack of one task. Rows to give out collect in self.rows."""

    #: Rows of children that may wait in memory, and ids in one piece.
    WAITING, PIECE = 100_000, 50_000

    def __init__(self, part: int):
        self.part, self.rows, self.path, self.stack, self.seq, self.waits = part, [], None, [], 0, 0
        self.states = []  # of the names: a node is named by the SHA-256 of its path
        self.first = None  # the first row's path and nodes

    def _push(self, path: bytes, depth: int) -> None:
        state = self.states[-1].copy() if depth else hashlib.sha256()
        if depth:
            state.update(path[UNIT * (depth - 1) : UNIT * depth])
        self.states.append(state)
        self.stack.append(Node())

    def _close(self) -> None:
        """The top of the stack, which belongs to this task alone, becomes a row that waits for its parent's smallest member."""
        depth = len(self.stack) - 1
        node, state = self.stack.pop(), self.states.pop()
        leaves, saved = node.leaves or 1, node.saved + (node.n - 1) * _size(self.path, depth)
        row = [node.least, depth, None, node.n, node.children, leaves, saved, node.ends.hexdigest() if node.ends else _EMPTY]
        self.resolve(node, _name(state) if node.flagged else None)
        parent = self.stack[-1]
        parent.least = node.least if parent.least is None else min(parent.least, node.least)
        parent.n += node.n
        parent.children += 1
        parent.leaves += leaves
        parent.saved += saved
        parent.waiting.append(row)
        self.waits += 1
        if self.waits > self.WAITING:
            self.flush()

    def resolve(self, node: Node, name: bytes | None) -> None:
        for row in node.waiting:
            row[2] = node.least
            self.rows.append(("done", *row))
        self.waits -= len(node.waiting)
        node.waiting = []
        if name is not None:
            self.rows.append(("lookup", name, node.least))

    def flush(self) -> None:
        """Too many rows wait in memory: they go out with their parent's name, to be joined with it."""
        for node, state in zip(self.stack, self.states):
            if node.waiting:
                node.flagged, name = True, _name(state)
                self.rows += [("waits", name, *row) for row in node.waiting]
                node.waiting = []
        self.waits = 0

    def see(self, conv: int, path: bytes) -> None:
        if self.path is None:
            for d in range(depth_of(path) + 1):
                self._push(path, d)
            self.first = (path, list(self.stack))
        elif path != self.path:
            self._ended()
            shared = common_units(self.path, path)
            while len(self.stack) - 1 > shared:
                depth = len(self.stack) - 1
                if depth < len(self.first[1]) and self.stack[depth] is self.first[1][depth]:
                    self._leave_first()
                else:
                    self._close()
            for d in range(shared + 1, depth_of(path) + 1):
                self._push(path, d)
        self.path = path
        top = self.stack[-1]
        top.n += 1
        top.least = conv if top.least is None else min(top.least, conv)
        if top.ends is None:
            top.ends = hashlib.sha256(b"%d" % conv)
        else:
            top.ends.update(b",%d" % conv)
        top.ids.append(conv)
        if len(top.ids) >= self.PIECE:
            self._piece(top)

    def _piece(self, top: Node) -> None:
        self.rows.append(("ends", self.seq, _name(self.states[-1]), ",".join(map(str, top.ids)).encode()))
        self.seq += 1
        top.ids, top.pieces = [], True

    def _ended(self, last: bool = False) -> None:
        """No more of this task's rows end at the top. Its ids leave as pieces, all of them, if some did or others may end there in another task."""
        top = self.stack[-1]
        if top.ids and (last or top.pieces or top is self.first[1][-1]):
            self._piece(top)
        top.ids = []

    def _leave_first(self) -> None:
        """A node of the first row's path ends here, but may have begun before: what it has is kept for the border."""
        self.flush_node(self.stack.pop(), self.states.pop())

    def flush_node(self, node: Node, state) -> None:
        if node.waiting:
            name = _name(state)
            self.rows += [("waits", name, *row) for row in node.waiting]
            self.waits -= len(node.waiting)
            node.waiting = []

    def finish(self) -> None:
        """The two open paths, as rows for the stitch."""
        if self.path is None:
            return
        self._ended(last=True)
        for node, state in zip(self.stack, self.states):
            self.flush_node(node, state)
        path, first = self.first
        self._border(0, path, first)
        still = {id(n) for n in first}
        self._border(1, self.path, [Node() if id(n) in still else n for n in self.stack])

    def _border(self, side: int, path: bytes, nodes: list[Node]) -> None:
        """What the task knows of the nodes of a path, without what other open nodes give to them: members ending here or in closed children, and closed children's sums."""
        none = -(1 << 63)
        has = np.array([(n.least is not None, none if n.least is None else n.least, n.n, n.children, n.leaves, n.saved) for n in nodes], np.int64)
        ends = ["" if n.ends is None else n.ends.hexdigest() for n in nodes]
        self.rows.append(("border", side, path, has.tobytes(), ends))


def _table(rows: list, part: int) -> pa.RecordBatch:
    names = [f.split()[0] for f in _SWEPT.split(", ")]
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<string>": pa.list_(pa.string())}
    types = [kinds[f.split()[1]] for f in _SWEPT.split(", ")]
    node = [f.split()[0] for f in _NODE.split(", ")]
    columns: dict[str, list] = {n: [None] * len(rows) for n in names}
    for i, (kind, *row) in enumerate(rows):
        columns["kind"][i], columns["part"][i] = kind, part
        if kind == "done":
            values = zip(node, row)
        elif kind == "waits":
            values = [("parent", row[0]), *zip(node, row[1:])]
        elif kind == "lookup":
            values = [("name", row[0]), ("conv_id", row[1])]
        elif kind == "ends":
            values = [("seq", row[0]), ("name", row[1]), ("path", row[2])]
        else:
            values = [("seq", row[0]), ("path", row[1]), ("has", row[2]), ("path_ends", row[3])]
        for name, value in values:
            columns[name][i] = value
    return pa.RecordBatch.from_arrays([pa.array(columns[n], t) for n, t in zip(names, types)], names)


def _sweep(batches):
    sweep = None
    for batch in batches:
        for part, conv, path in zip(*(c.to_pylist() for c in batch.columns)):
            if sweep is None:
                sweep = Sweep(part)
            sweep.see(conv, path)
            if len(sweep.rows) >= 20_000:
                yield _table(sweep.rows, sweep.part)
                sweep.rows = []
    if sweep is not None:
        sweep.finish()
        for i in range(0, len(sweep.rows), 20_000):
            yield _table(sweep.rows[i : i + 20_000], sweep.part)


def _stitch(batches):
    """One sweep over the borders in order: name, parent's name and what a node has, by levels of the open path."""
    stack: list[Node] = []
    states: list = []
    path, rows = None, []

    def close():
        depth = len(stack) - 1
        node, state = stack.pop(), states.pop()
        leaves, saved = node.leaves or 1, node.saved + (node.n - 1) * _size(path, depth)
        rows.append((_name(state), _name(states[-1]) if states else None, node.least, depth, node.n, node.children, leaves, saved, node.ends or _EMPTY))
        if stack:
            parent = stack[-1]
            parent.least = node.least if parent.least is None else min(parent.least, node.least)
            parent.n, parent.children, parent.leaves, parent.saved = parent.n + node.n, parent.children + 1, parent.leaves + leaves, parent.saved + saved

    def table():
        kinds = [pa.binary(), pa.binary(), *[pa.int64()] * 6, pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["name", "parent", "conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"])

    for batch in batches:
        for new, has, ends in zip(*(batch.column(c).to_pylist() for c in ("path", "has", "path_ends"))):
            shared = common_units(path, new) if path is not None else -1
            while len(stack) - 1 > shared:
                close()
            for d in range(shared + 1, depth_of(new) + 1):
                state = states[-1].copy() if d else hashlib.sha256()
                if d:
                    state.update(new[UNIT * (d - 1) : UNIT * d])
                states.append(state)
                stack.append(Node())
            path = new
            for node, (known, least, n, children, leaves, saved), end in zip(stack, np.frombuffer(has, np.int64).reshape(-1, 6).tolist(), ends):
                if known:
                    node.least = least if node.least is None else min(node.least, least)
                node.n, node.children, node.leaves, node.saved = node.n + n, node.children + children, node.leaves + leaves, node.saved + saved
                node.ends = end or node.ends
            if len(rows) >= 20_000:
                yield table()
                rows.clear()
    while stack:
        close()
    if rows:
        yield table()


def _hash_pieces(batches):
    """ends_sha256 of each name, whose pieces come one behind the other in order."""
    name, state = None, None

    def row():
        return pa.RecordBatch.from_arrays([pa.array([name], pa.binary()), pa.array([state.hexdigest()])], ["name", "whole"])

    for batch in batches:
        for own, piece in zip(batch.column("name").to_pylist(), batch.column("path").to_pylist()):
            if own != name:
                if state is not None:
                    yield row()
                name, state = own, hashlib.sha256(piece)
            else:
                state.update(b"," + piece)
    if state is not None:
        yield row()


def prefix_trie(arrays: DataFrame) -> DataFrame:
    """One row for each distinct sequence of first turns of conversations (conv_id, units, as turn_arrays gives them), from the empty one: conv_id (smallest member), depth, parent_conv_id
    (the parent's conv_id, null for the root), n_convs, n_children, n_leaves (childless nodes in the subtree, itself included), saved_tokens (over the subtree, members but one times the bytes of
    the node's last text), ends_sha256 (of the ids of members of just so many turns, ascending, joined by commas).

    Conversations without turns are members of the root. Without conversations there is no row. An id is expected once.
    """
    common.small_batches(arrays.sparkSession)
    path = F.coalesce(F.unhex(F.array_join("units", "")), F.lit(b""))
    rows = arrays.select("conv_id", path.alias("path"))
    ordered = rows.repartitionByRange(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "path", "conv_id").sortWithinPartitions("path", "conv_id")
    swept = common.staged(ordered.select(F.spark_partition_id().alias("part"), "conv_id", "path").mapInArrow(_sweep, _SWEPT), "swept")
    borders = swept.where("kind = 'border'").select("part", "seq", "path", "has", "path_ends").repartition(1).sortWithinPartitions("part", "seq")  # two rows a task
    columns = [f.split()[0] for f in _NODE.split(", ")]
    stitched = common.staged(borders.mapInArrow(_stitch, "name binary, parent binary, " + ", ".join(f for f in _NODE.split(", ") if "parent" not in f)), "stitched")
    pieces = swept.where("kind = 'ends'").select("name", "part", "seq", "path").repartition("name").sortWithinPartitions("name", "part", "seq").mapInArrow(_hash_pieces, "name binary, whole string")
    known = stitched.select("name", F.col("conv_id").alias("above")).unionByName(swept.where("kind = 'lookup'").select("name", F.col("conv_id").alias("above")))
    parents = known.withColumnRenamed("name", "parent")
    waiting = swept.where("kind = 'waits'").select("parent", *columns).join(parents, "parent", "left").withColumn("parent_conv_id", F.col("above"))
    border = stitched.join(pieces, "name", "left").withColumn("ends_sha256", F.coalesce("whole", "ends_sha256")).join(parents, "parent", "left").withColumn("parent_conv_id", F.col("above"))
    return swept.where("kind = 'done'").select(columns).unionByName(waiting.select(columns)).unionByName(border.select(columns))
