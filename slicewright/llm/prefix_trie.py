"""Trie of conversation prefixes by union-find over sorted-neighbour LCP edges.

A turn becomes a fixed-width code: 16 bytes of SHA-256 over role and text, and the number of
code points.  A conversation's key is the string of its turns' codes, so keys sort like
sequences of turns, and every prefix of turns is a prefix of bytes.  Equal conversations are
folded into one row with map-side sums before anything is sorted.

* Keys are range-partitioned into runs of bounded size and sorted.  In a run, neighbours are
  joined by edges that carry their longest common prefix (LCP, in turns).  Edges are taken in
  descending depth; union-find merges the components at their ends, and each merge creates
  (or extends) the branching node at that depth.  The turns between a node and its parent are
  a chain of nodes with one child each.
* A node is closed in its run if neither the last key before the run nor the first key behind it
  begins with its prefix.  Closed nodes are final.  The others are the run's open forest: a path
  along its first and a path along its last key.  It is contracted to the nodes that closed
  parts hang on, each with the sums of those parts.
* ``FAN`` neighbouring runs make a run of the next round, whose rows are their open nodes;
  rounds go on until one run is left, so what a task holds is bounded in every round.

A node's id is 16 bytes of SHA-256 over its key.  The parent's smallest member is looked up by
id only where the parent was still open when its child was closed.

The digest of the members that end at a node needs their ids in one order, and SHA-256 has no
parallel form.  Ids are gathered in pieces of bounded size, and each node's pieces are hashed
one after the other as a stream; no task holds a group.

Defined results
  null role or text: as empty; null conversation: left out; a conversation without turns (a row
  with null place) is a member of the root; turns of one place: all stay, in the order of
  their codes; empty table: empty result; other columns are ignored.  A conversation's codes (20
  bytes a turn) are one row; its texts are never gathered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slicewright.llm._store import written

#: Bytes of a turn's code, and of the hash at its front.
CODE, HASH = 20, 16
#: Bytes of keys in a run (a longer key stands alone in effect), and what a row counts for besides.
RUN_BYTES, ROW_BYTES = 4 << 20, 80
#: Runs that make one of the next round.
FAN = 32
#: Ids of a piece are those that agree but for so many last bits.
PIECE_BITS = 12


def shared_turns(a: bytes, b: bytes) -> int:
    """Length in turns of the longest common prefix of two keys."""
    low, high = 0, min(len(a), len(b)) // CODE
    if a[: high * CODE] == b[: high * CODE]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low * CODE : middle * CODE] == b[low * CODE : middle * CODE]:
            low = middle
        else:
            high = middle
    return low


@dataclass
class Sums:
    """What is known of a node's members and of the closed nodes below it."""

    n: int = 0
    least: int | None = None
    children: int = 0
    leaves: int = 0
    saved: int = 0

    def add(self, child: Sums) -> None:
        """A closed child, whose ``children`` count 1: it stands for itself."""
        self.n += child.n
        self.least = child.least if self.least is None else min(self.least, child.least)
        self.children += child.children
        self.leaves += child.leaves
        self.saved += child.saved


@dataclass
class Forest:
    """The trie of a run without its chains.  Of each node: depth, a key that passes through it,
    parent (the root has -1) and sums."""

    depth: list[int]
    key: list[bytes]
    parent: list[int]
    sums: list[Sums]


def forest_of(keys: list[bytes], sums: list[Sums]) -> Forest:
    """Forest over distinct sorted ``keys``; the first nodes are those of the keys."""
    rows = len(keys)
    forest = Forest([len(k) // CODE for k in keys], list(keys), [-1] * rows, sums)
    edges = np.array([shared_turns(a, b) for a, b in zip(keys, keys[1:])], np.int64)
    member = list(range(rows))
    top = list(range(rows))  # highest node so far, of the component that a row names

    def find(x: int) -> int:
        while member[x] != x:
            member[x] = member[member[x]]
            x = member[x]
        return x

    def raised(node: int, depth: int) -> int:
        """The node at ``depth`` above ``node``, or that itself."""
        if forest.depth[node] == depth:
            return node
        forest.depth.append(depth)
        forest.key.append(forest.key[node])
        forest.parent.append(-1)
        forest.sums.append(Sums())
        forest.parent[node] = len(forest.depth) - 1
        return forest.parent[node]

    for edge in np.argsort(-edges, kind="stable").tolist():
        left, right = find(edge), find(edge + 1)
        # the right side reaches less high than this edge: a key that sorts later is no prefix
        # of the left one, and edges of one depth are taken from left to right
        node = raised(top[left], int(edges[edge]))
        forest.parent[top[right]] = node
        member[right] = left
        top[left] = node
    if rows:
        raised(top[find(0)], 0)
    return forest


class Run:
    """Closed nodes and contracted open nodes of a run of sorted rows, given the keys beside it."""

    def __init__(self, keys: list[bytes], sums: list[Sums], beside: list[bytes]):
        #: id, depth, least, n, children, leaves, saved, parent's id, parent's place in this list
        self.nodes: list[list] = []
        self.open: list[tuple[bytes, Sums]] = []
        forest = forest_of(keys, sums)
        below: dict[int, list[int]] = {}  # by node: the places of its closed children
        for v in sorted(range(len(forest.depth)), key=lambda v: -forest.depth[v]):
            self._chain(forest, v, below, beside)

    def _chain(self, forest: Forest, v: int, below: dict[int, list[int]], beside: list[bytes]) -> None:
        """Node ``v`` and the chain above it, up to below its parent."""
        depth, parent, sums = forest.depth[v], forest.parent[v], forest.sums[v]
        key = forest.key[v][: depth * CODE]
        above = forest.depth[parent] if parent >= 0 else -1
        reach = max((shared_turns(key, k) for k in beside), default=-1)  # so many turns, or fewer: open
        children = below.pop(v, [])
        if depth <= reach:
            if sums.n:  # else nothing closed hangs on it
                self.open.append((key, sums))
            return
        hangs_on = max(above, reach)
        ids = self._ids(key, max(hangs_on, 0))
        for d in range(depth, hangs_on, -1):
            size = int.from_bytes(key[d * CODE - CODE + HASH : d * CODE], "big") if d else 0
            sums.leaves += not sums.children
            sums.saved += (sums.n - 1) * size
            place = len(self.nodes)
            for child in children:
                self.nodes[child][-1] = place
            self.nodes.append([ids[d], d, sums.least, sums.n, sums.children, sums.leaves, sums.saved, ids[d - 1] if d else None, None])
            children, sums.children = [place], 1
        if reach > above:
            self.open.append((key[: reach * CODE], sums))
        elif parent >= 0:
            forest.sums[parent].add(sums)
            below.setdefault(parent, []).extend(children)

    @staticmethod
    def _ids(key: bytes, low: int) -> dict[int, bytes]:
        """Ids of the prefixes of ``key`` from ``low`` turns on."""
        state = hashlib.sha256(key[: low * CODE])
        ids = {low: state.digest()[:HASH]}
        for d in range(low + 1, len(key) // CODE + 1):
            state.update(key[d * CODE - CODE : d * CODE])
            ids[d] = state.copy().digest()[:HASH]
        return ids


_MADE = pa.schema([
    ("run", pa.int64()), ("kind", pa.int32()), ("key", pa.binary()), ("id", pa.binary()), ("depth", pa.int64()), ("conv", pa.int64()),
    ("n", pa.int64()), ("children", pa.int64()), ("leaves", pa.int64()), ("saved", pa.int64()), ("parent", pa.binary()),
    ("parent_conv", pa.int64()),
])
_MADE_SQL = (
    "run long, kind int, key binary, id binary, depth long, conv long, n long, children long, leaves long, saved long, "
    "parent binary, parent_conv long"
)
_COLUMNS = ["id", "depth", "conv", "n", "children", "leaves", "saved", "parent", "parent_conv"]
CLOSED, OPEN = 0, 1


def _judged(table: pa.Table) -> pa.Table:
    """Closed and open nodes of one run; rows without ``n`` are the keys beside it."""
    rows = sorted(zip(*(table.column(c).to_pylist() for c in ("key", "n", "conv", "children", "leaves", "saved"))), key=lambda r: r[0])
    own = [r for r in rows if r[1] is not None]
    run = Run([r[0] for r in own], [Sums(*r[1:]) for r in own], [r[0] for r in rows if r[1] is None])
    number = table.column("run")[0].as_py()
    out = [
        (number, CLOSED, None, node, depth, conv, n, children, leaves, saved, parent, None if place is None else run.nodes[place][2])
        for node, depth, conv, n, children, leaves, saved, parent, place in run.nodes
    ]
    out += [(number, OPEN, key, None, None, s.least, s.n, s.children, s.leaves, s.saved, None, None) for key, s in run.open]
    return pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out) if out else [[]] * len(_MADE), _MADE)], schema=_MADE)


def turn_code(role: str = "role", text: str = "text") -> Column:
    """The code of a turn."""
    said, told = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    whole = F.concat(F.length(said).cast("string"), F.lit(":"), said, told)
    return F.concat(F.substring(F.unhex(F.sha2(whole, 256)), 1, HASH), F.unhex(F.lpad(F.hex(F.length(told)), 2 * (CODE - HASH), "0")))


def sequences(turns: DataFrame, conv: str, place: str, code: Column) -> DataFrame:
    """Rows (conv, key) for every conversation of ``turns``."""
    turn = F.when(F.col(place).isNotNull(), F.struct(F.col(place).alias("place"), F.hex(code).alias("code")))
    one = turns.filter(F.col(conv).isNotNull()).select(F.col(conv).cast("long").alias("conv"), turn.alias("turn"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list("turn")), lambda t: t["code"]), "")
    return one.groupBy("conv").agg(F.unhex(joined).alias("key"))


def ends(keys: DataFrame) -> DataFrame:
    """(id, ends) for each node where conversations (conv, key) end: lowercase SHA-256 of their
    numbers, ascending and joined by commas."""
    ids = keys.select(F.substring(F.unhex(F.sha2("key", 256)), 1, HASH).alias("id"), "conv")
    listed = F.array_join(F.transform(F.sort_array(F.collect_set("conv")), lambda x: x.cast("string")), ",")
    pieces = ids.groupBy("id", F.shiftright("conv", PIECE_BITS).alias("piece")).agg(listed.alias("listed"))
    schema = pa.schema([("id", pa.binary()), ("ends", pa.string())])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done = []
            for at, piece in zip(batch.column("id").to_pylist(), batch.column("listed").to_pylist()):
                if at == node:
                    state.update(b"," + piece.encode())
                else:
                    done += [{"id": node, "ends": state.hexdigest()}] if state else []
                    node, state = at, hashlib.sha256(piece.encode())
            yield pa.RecordBatch.from_pylist(done, schema)
        if state:
            yield pa.RecordBatch.from_pylist([{"id": node, "ends": state.hexdigest()}], schema)

    dealt = pieces.repartition("id").sortWithinPartitions("id", "piece")
    return dealt.select("id", "listed").mapInArrow(hashed, "id binary, ends string")


def _beside(bounds: DataFrame) -> DataFrame:
    """Rows (run, key): the last key before each run and the first one behind it.  ``bounds`` has
    one row for each run."""
    along = Window.orderBy("run")
    sides = F.array_compact(F.array(F.lag("last").over(along), F.lead("first").over(along)))
    return bounds.select("run", sides.alias("sides")).select("run", F.explode("sides").alias("key"))


def trie(
    turns: DataFrame, conv: str = "conv_id", place: str = "place", code: Column | None = None,
    run_bytes: int = RUN_BYTES, fan: int = FAN,
) -> DataFrame:
    """A row for each distinct sequence of first turns, the empty one (root) included: id, depth,
    conv (smallest member), n (members), children, leaves (nodes without children in the
    subtree), saved (over the subtree: members but one, times the code points of the node's last
    text), parent (id), parent_conv, ends (see :func:`ends`).

    ``turns`` has a row for each turn, ordered by ``place``, and one with null place for a
    conversation that may have no turns; ``code`` is :func:`turn_code` of it."""
    if fan < 2:
        raise ValueError("a run of the next round is made of two or more")
    keys = written(sequences(turns, conv, place, turn_code() if code is None else code), "keys")
    folded = written(keys.groupBy("key").agg(F.count("*").alias("n"), F.min("conv").alias("conv")), "sequences")
    total = folded.agg(F.sum(F.octet_length("key") + ROW_BYTES)).first()[0] or 0
    zeros = [F.lit(0).cast("long").alias(c) for c in ("children", "leaves", "saved")]
    dealt = folded.repartitionByRange(max(1, -(-total // run_bytes)), "key")
    rows = written(dealt.select(F.spark_partition_id().cast("long").alias("run"), "key", "n", "conv", *zeros), "runs")
    bounds = written(rows.groupBy("run").agg(F.min("key").alias("first"), F.max("key").alias("last")), "bounds")
    rounds = []
    while True:
        given = rows.unionByName(_beside(bounds), allowMissingColumns=True)
        made = written(given.groupBy("run").applyInArrow(_judged, _MADE_SQL), "round")
        rounds.append(made.filter(F.col("kind") == CLOSED).select(_COLUMNS))
        if bounds.count() <= 1:
            break
        run = F.floor(F.col("run") / fan).cast("long").alias("run")
        rows = made.filter(F.col("kind") == OPEN).groupBy(run, "key").agg(
            F.sum("n").alias("n"), F.min("conv").alias("conv"), *[F.sum(c).alias(c) for c in ("children", "leaves", "saved")]
        )
        bounds = written(bounds.groupBy(run).agg(F.min("first").alias("first"), F.max("last").alias("last")), "bounds")
    later = reduce(DataFrame.unionByName, rounds[1:], rounds[0].limit(0))
    nodes = rounds[0].unionByName(later)
    # parents that were open when their children closed are among the nodes of later rounds
    waits = (F.col("depth") > 0) & F.col("parent_conv").isNull()
    named = nodes.filter(waits).drop("parent_conv").join(later.select(F.col("id").alias("parent"), F.col("conv").alias("parent_conv")), "parent")
    whole = nodes.filter(~waits).unionByName(named)
    return whole.join(ends(keys), "id", "left").withColumn("ends", F.coalesce("ends", F.sha2(F.lit(""), 256)))
