"""Prefix tries of conversations: shared openings, their members and what sharing them saves.

A turn becomes an id of 20 bytes, 16 of the digest of its role and text and 4 of the text's
length, so a conversation is a byte string that sorts turn by turn. Equal conversations are
counted first, in blocks of conversation ids. The distinct ones are dealt to shards by ranges.
A shard reads its sorted range in slices of bounded size, encodes a slice's turn ids by a
dictionary of its own and inserts the conversations, the middle one first, into a ternary
search tree, which that order balances. An iterative traversal adds up members, leaves and
savings from the deepest node to the root.

Only nodes on the path of a shard's first or last conversation can go on in a neighbour. All
others are finished and leave the shard as rows. The two paths stay behind as a fragment, and
fragments of neighbours are merged, a few at a time, in further trees until one is left. So no
task sees more than one slice or a few pairs of paths, however many conversations start alike.

Turns are ordered by turn (null first), then role and text; a null role or text becomes empty.
Rows without conv_id belong to no conversation and are left out. Repeated rows are turns of
their own. Other columns are not read. An empty table has no trie, not even a root.
"""

import hashlib
import struct
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans import broadcast_if_bounded
from .tables import in_arrow, stored

ID_BYTES = 20
ID_BLOCK_BITS = 10
EMPTY_HASH = hashlib.sha256(b"").hexdigest()

NODES = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
         "saved_tokens long, ends_sha256 string")
# A finished node, or (with the last column) what is left of a shard.
PARTS = (f"{NODES}, node_key binary, parent_key binary, shard long, fragment binary")


@dataclass(frozen=True)
class PrefixTrie:
    """Sizes of the work: turns a slice of a shard holds, fragments that one merge takes."""

    slice_turns: int = 100_000
    fan_in: int = 16


# ---- conversations as byte strings


def turn_id(role, text):
    """Hexadecimal id of a turn: digest of role and text, and the text's length in bytes."""
    said = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.concat(F.substring(F.sha2(said, 256), 1, 32), F.lpad(F.hex(F.octet_length(text)), 8, "0"))


def _base(conv_id):
    return conv_id - conv_id % 5


def conversation_turns(chats: DataFrame) -> DataFrame:
    """(base, conv_id, turns): the ids of each conversation's turns in order.

    Texts stay out of the shuffle. Only conversations in which two turns agree in number and
    role, but not in text, are read again with their texts, which then decide the order.
    """
    rows = chats.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("base", _base(F.col("conv_id")))

    def gathered(rows, *order):
        return (
            rows.select("base", "conv_id", *order, turn_id(F.col("role"), F.col("text")).alias("id"))
            .repartition("base").groupBy("base", "conv_id")
            .agg(F.sort_array(F.collect_list(F.struct(*order, "id"))).alias("said")))

    pairs = F.zip_with(F.slice("said", 1, F.size("said") - 1), F.slice("said", 2, F.size("said") - 1),
                       lambda a, b: a["turn"].eqNullSafe(b["turn"]) & (a["role"] == b["role"]) & (a["id"] != b["id"]))
    first = gathered(rows, "turn", "role").select(
        "base", "conv_id", F.transform("said", lambda t: t["id"]).alias("turns"),
        F.exists(pairs, lambda tied: tied).alias("tied"))
    first = stored(first, "turns")
    tied = first.where("tied").select("conv_id")
    plain = first.where("not tied").drop("tied")
    if tied.isEmpty():
        return plain
    again = gathered(rows.join(tied, "conv_id", "left_semi"), "turn", "role", "text")
    return plain.unionByName(again.select(
        "base", "conv_id", F.transform("said", lambda t: t["id"]).alias("turns")))


def rebuilt(chats: DataFrame) -> DataFrame:
    """(conv_id, path): the conversations rebuilt, each as one byte string.

    Conversation c opens with the first h turns of c - c % 5 and goes on with its own
    behind its first h; h is the checksum of its number, modulo 9. ``%`` is Spark's, so
    it takes the sign of c. At most nine conversations share a base.
    """
    turns = conversation_turns(chats)
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("int")
    head = F.max(F.when(F.col("conv_id") == F.col("base"), F.slice("turns", 1, 8))).over(Window.partitionBy("base"))
    opening = F.slice(F.coalesce("head", F.array().cast("array<string>")), F.lit(1), F.col("h"))
    own = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return turns.withColumns({"h": h, "head": head}).select(
        "conv_id", F.unhex(F.array_join(F.concat(opening, own), "")).alias("path"))


def distinct_paths(conversations: DataFrame) -> DataFrame:
    """(path, ids): distinct paths with their members, sorted, in blocks of conversation ids.

    A block spans 1,024 ids and so holds no more members, however many copies a path has.
    """
    return conversations.groupBy("path", F.shiftright("conv_id", ID_BLOCK_BITS).alias("block")).agg(
        F.sort_array(F.collect_list("conv_id")).alias("ids"))


# ---- the tree


class Tree:
    """A ternary search tree over paths of local turn ids.

    Node 0 is the root of the trie. A node's children are a binary search tree of nodes that
    starts at ``down``, with ``less`` and ``more`` as its branches. ``own`` and ``ends`` tell of
    the conversations that end at the node; the five sums behind them of finished children.
    """

    def __init__(self):
        self.symbol, self.size, self.up = [-1], [0], [-1]
        self.less, self.more, self.down = [0], [0], [0]
        self.own, self.least, self.ends = [0], [None], [None]
        self.inner = [None]
        self.edge = [False]

    def _new(self, symbol, size, up):
        for column, value in ((self.symbol, symbol), (self.size, size), (self.up, up), (self.less, 0), (self.more, 0),
                              (self.down, 0), (self.own, 0), (self.least, None), (self.ends, None), (self.inner, None),
                              (self.edge, False)):
            column.append(value)
        return len(self.symbol) - 1

    def insert(self, symbols, sizes):
        """The nodes of a path, root first; missing ones are made."""
        node, nodes = 0, [0]
        for symbol, size in zip(symbols, sizes):
            at = self.down[node]
            if not at:
                at = self.down[node] = self._new(symbol, size, node)
            while self.symbol[at] != symbol:
                branch = self.less if symbol < self.symbol[at] else self.more
                if not branch[at]:
                    branch[at] = self._new(symbol, size, node)
                at = branch[at]
            node = at
            nodes.append(node)
        return nodes

    def children(self, node):
        """Children in order, by walking their search tree with a stack."""
        stack, at = [], self.down[node]
        while stack or at:
            while at:
                stack.append(at)
                at = self.less[at]
            at = stack.pop()
            yield at
            at = self.more[at]

    def in_order(self):
        """(node, depth) of every node, parents first."""
        stack = [(0, 0)]
        while stack:
            node, depth = stack.pop()
            yield node, depth
            stack.extend((child, depth + 1) for child in self.children(node))

    def totals(self):
        """Per node: members, smallest one, children, leaves and savings, edges left open.

        Children are added to parents from the last node of the traversal to the first.
        An edge node's finished children count; its own savings wait for all its members.
        """
        order = list(self.in_order())
        many = len(self.symbol)
        members, least = list(self.own), list(self.least)
        children, leaves, saved = [0] * many, [0] * many, [0] * many
        for k, inner in enumerate(self.inner):
            if inner:
                members[k] += inner[0]
                least[k] = _least(least[k], inner[1])
                children[k], leaves[k], saved[k] = inner[2:]
        for node, _ in reversed(order):
            if not children[node]:
                leaves[node] = 1
            saved[node] += (members[node] - 1) * self.size[node]
            up = self.up[node]
            if up >= 0:
                members[up] += members[node]
                least[up] = _least(least[up], least[node])
                children[up] += 1
                leaves[up] += leaves[node]
                saved[up] += saved[node]
        return order, members, least, children, leaves, saved

    def open_sums(self, totals):
        """Per edge node: the five sums over its finished children alone."""
        order, members, least, _, leaves, saved = totals
        sums = {n: list(self.inner[n] or (0, None, 0, 0, 0)) for n, _ in order if self.edge[n]}
        for node, _ in order:
            up = self.up[node]
            if up >= 0 and self.edge[up] and not self.edge[node]:
                s = sums[up]
                s[0] += members[node]
                s[1] = _least(s[1], least[node])
                s[2] += 1
                s[3] += leaves[node]
                s[4] += saved[node]
        return sums


def _least(a, b):
    return b if a is None else a if b is None else min(a, b)


def middle_first(n: int):
    """0 to n - 1, the middle before both halves."""
    stack = [(0, n)]
    while stack:
        low, high = stack.pop()
        if low < high:
            middle = (low + high) // 2
            yield middle
            stack += [(middle + 1, high), (low, middle)]


def _keys(path: bytes):
    """A key for every prefix of a path, the empty one first."""
    state = hashlib.sha256()
    yield state.digest()[:16]
    for at in range(0, len(path), ID_BYTES):
        state.update(path[at : at + ID_BYTES])
        yield state.copy().digest()[:16]


class Fragment:
    """What a range of paths leaves open: its first and last path, with a record per node.

    A record is (own, least, ends) of the node and the five sums over its finished children.
    """

    def __init__(self, paths, records):
        self.paths, self.records = paths, records

    def pack(self) -> bytes:
        out = [struct.pack("<q", len(self.paths))]
        for path in self.paths:
            out += [struct.pack("<q", len(path)), path]
        out.append(struct.pack("<q", len(self.records)))
        for (which, depth), (own, least, ends, inner) in self.records.items():
            flags = (least is not None) + 2 * (ends is not None) + 4 * (inner[1] is not None)
            out.append(struct.pack("<Bqqqqqqqq", flags, which, depth, own, least or 0, inner[0], inner[1] or 0, *inner[2:4]))
            # Savings are sums of products and may pass a long.
            saved = str(inner[4]).encode()
            out += [struct.pack("<B", len(saved)), saved, bytes.fromhex(ends) if ends else b""]
        return b"".join(out)

    @classmethod
    def unpack(cls, raw: bytes) -> "Fragment":
        at = 0

        def take(form):
            nonlocal at
            values = struct.unpack_from(form, raw, at)
            at += struct.calcsize(form)
            return values

        paths = []
        for _ in range(take("<q")[0]):
            (size,) = take("<q")
            paths.append(raw[at : at + size])
            at += size
        records = {}
        for _ in range(take("<q")[0]):
            flags, which, depth, own, least, members, inner_least, children, leaves = take("<Bqqqqqqqq")
            (size,) = take("<B")
            saved = int(raw[at : at + size])
            at += size
            ends = None
            if flags & 2:
                ends = raw[at : at + 32].hex()
                at += 32
            records[which, depth] = (own, least if flags & 1 else None, ends,
                                     (members, inner_least if flags & 4 else None, children, leaves, saved))
        return cls(paths, records)


def encoded(paths):
    """The paths' turns as numbers of a dictionary in byte order, and the turns' text lengths."""
    joined = b"".join(paths)
    raw = np.frombuffer(joined, f"S{ID_BYTES}") if joined else np.zeros(0, f"S{ID_BYTES}")
    known, codes = np.unique(raw, return_inverse=True)
    sizes = np.array([int.from_bytes(k.ljust(ID_BYTES, b"\0")[16:], "big") for k in known.tolist()], np.int64)
    ends = np.cumsum([len(p) // ID_BYTES for p in paths])
    codes, lengths = codes.tolist(), sizes[codes].tolist()
    return [(codes[b - n : b], lengths[b - n : b]) for b, n in
            zip(ends.tolist(), (len(p) // ID_BYTES for p in paths))]


def grown(loads, last: bool):
    """(finished rows, fragment or None) of a tree over ``loads``, which are in order.

    A load is a pair (path, records): records by depth as in :class:`Fragment`. Unless it is
    the ``last`` tree, the nodes of the first and last path stay open.
    """
    tree = Tree()
    codes = encoded([path for path, _ in loads])
    spots = {}
    for k in middle_first(len(loads)):
        nodes = spots[k] = tree.insert(*codes[k])
        for depth, (own, least, ends, inner) in loads[k][1].items():
            node = nodes[depth]
            tree.own[node] += own
            tree.least[node] = _least(tree.least[node], least)
            tree.ends[node] = ends or tree.ends[node]
            if inner is not None:
                old = tree.inner[node] or (0, None, 0, 0, 0)
                tree.inner[node] = (old[0] + inner[0], _least(old[1], inner[1]), *(a + b for a, b in zip(old[2:], inner[2:])))
    extremes = sorted({0, len(loads) - 1})
    if not last:
        for k in extremes:
            for node in spots[k]:
                tree.edge[node] = True
    # Children that are out already look for the nodes that an earlier fragment left open.
    opened = {spots[k][depth] for k, (_, records) in enumerate(loads) for depth, r in records.items() if r[3] is not None}
    keys = {}
    for k, (path, records) in enumerate(loads):
        if tree.edge[spots[k][-1]] or any(r[3] is not None for r in records.values()):
            keys.update(zip(spots[k], _keys(path)))
    totals = tree.totals()
    order, members, least, children, leaves, saved = totals
    rows = []
    for node, depth in order:
        if tree.edge[node]:
            continue
        up = tree.up[node]
        waits = up >= 0 and tree.edge[up]
        rows.append((least[node], depth, None if up < 0 or waits else least[up], members[node], children[node],
                     leaves[node], _long(saved[node]), tree.ends[node] or EMPTY_HASH,
                     keys[node] if node in opened else None, keys[up] if waits else None))
    if last:
        return rows, None
    sums = tree.open_sums(totals)
    records, seen = {}, set()
    for which, k in enumerate(extremes):
        for depth, node in enumerate(spots[k]):
            if node not in seen:
                seen.add(node)
                records[which, depth] = (tree.own[node], tree.least[node], tree.ends[node], tuple(sums[node]))
    return rows, Fragment([loads[k][0] for k in extremes], records)


def _long(n):
    return n if n < 1 << 63 else None


def merged(fragments, last: bool):
    """(finished rows, fragment) of neighbouring fragments, in order."""
    loads = []
    for fragment in fragments:
        for which, path in enumerate(fragment.paths):
            loads.append((path, {d: r for (w, d), r in fragment.records.items() if w == which}))
    return grown(loads, last)


_TYPES = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
_SCHEMA = pa.schema([(name, _TYPES[kind]) for name, kind in (f.split() for f in PARTS.split(", "))])


def _batch(rows, shard=None, fragment=None):
    rows = [(*r, None, None) for r in rows]
    if fragment is not None:
        rows.append((None,) * 10 + (shard, fragment.pack()))
    columns = list(zip(*rows)) if rows else [()] * len(_SCHEMA)
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, _SCHEMA.types)], schema=_SCHEMA)


def _members(batches):
    """(path, number of members, smallest, hash of all) per distinct path of sorted blocks.

    Blocks are read one by one; the members of a path are hashed as they pass.
    """
    path, state, count, least = None, None, 0, None
    for batch in batches:
        for key, ids in zip(batch.column("path"), batch.column("ids")):
            key, text = key.as_py(), ",".join(map(str, ids.values.to_pylist()))
            if key != path:
                if path is not None:
                    yield path, count, least, state.hexdigest()
                path, state, count, least = key, hashlib.sha256(), 0, ids.values[0].as_py()
            elif count:
                state.update(b",")
            state.update(text.encode())
            count += len(ids.values)
    if path is not None:
        yield path, count, least, state.hexdigest()


def _in_slices(members, turns: int):
    load, size = [], 0
    for path, count, least, ends in members:
        load.append((path, {len(path) // ID_BYTES: (count, least, ends, None)}))
        size += len(path) // ID_BYTES + 1
        if size >= turns:
            yield load
            load, size = [], 0
    if load:
        yield load


def prefix_trie(chats: DataFrame, how: PrefixTrie = PrefixTrie()) -> DataFrame:
    """One row per distinct opening of the rebuilt conversations, as ``op12`` defines it.

    ``saved_tokens`` beyond a long is null.
    """
    paths = distinct_paths(rebuilt(chats)).repartitionByRange("path").sortWithinPartitions("path", "block")

    def shard(batches):
        left = None
        for load in _in_slices(_members(batches), how.slice_turns):
            rows, fragment = grown(load, False)
            yield _batch(rows)
            if left is not None:
                rows, fragment = merged([left, fragment], False)
                yield _batch(rows)
            left = fragment
        if left is not None:
            yield _batch((), TaskContext.get().partitionId(), left)

    parts = stored(in_arrow(paths, shard, PARTS), "trie")
    finished = [parts.where("fragment is null")]
    left = parts.where("fragment is not null").select("shard", "fragment")
    highest = left.agg(F.max("shard")).first()[0]
    last = highest is None
    while not last:
        last = highest < how.fan_in
        parts = stored(_merge_round(left, how.fan_in, last), "trie")
        finished.append(parts.where("fragment is null"))
        left = parts.where("fragment is not null").select("shard", "fragment")
        highest //= how.fan_in
    nodes = finished[0]
    for more in finished[1:]:
        nodes = nodes.unionByName(more)
    opened = nodes.where("node_key is not null").select(
        F.col("node_key").alias("parent_key"), F.col("conv_id").alias("opened_id"))
    waiting = nodes.where("parent_key is not null").join(broadcast_if_bounded(opened, opened.count()), "parent_key")
    names = [field.split()[0] for field in NODES.split(", ")]
    waiting = waiting.withColumn("parent_conv_id", F.col("opened_id"))
    return nodes.where("parent_key is null").select(*names).unionByName(waiting.select(*names))


def _merge_round(left: DataFrame, fan_in: int, last: bool) -> DataFrame:
    """Merge the fragments of every ``fan_in`` neighbouring shards."""
    def merge(batches):
        group, kept = None, []

        def done():
            rows, fragment = merged([Fragment.unpack(raw) for raw in kept], last)
            return _batch(rows, group, fragment)

        for batch in batches:
            for number, raw in zip(batch.column("group").to_pylist(), batch.column("fragment")):
                if kept and number != group:
                    yield done()
                    kept = []
                group = number
                kept.append(raw.as_py())
        if kept:
            yield done()

    groups = left.withColumn("group", F.floor(F.col("shard") / fan_in)).repartition("group")
    return in_arrow(groups.sortWithinPartitions("group", "shard").select("group", "fragment"), merge, PARTS)


# Checksums of conversation numbers are taken bit by bit: a byte is mixed in, then eight shifts follow.
TRIE_SQL = r"""
WITH said AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS n
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, xor(list_reduce([4294967295] || flatten(list_transform(
      range(1, length(name) + 1), lambda i: [ascii(substr(name, i, 1)), -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda crc, op: CASE WHEN op >= 0 THEN xor(crc, op) ELSE xor(crc >> 1, 3988292384 * (crc & 1)) END),
    4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id, conv_id::VARCHAR AS name FROM said)),
turns AS (
  SELECT i.conv_id, n, role, text FROM ids i JOIN said s ON s.conv_id = i.base AND n <= h
  UNION ALL SELECT i.conv_id, n, role, text FROM ids i JOIN said s ON s.conv_id = i.conv_id AND n > h),
openings AS (
  SELECT conv_id, 0 AS depth, '' AS opening, 0 AS bytes FROM ids
  UNION ALL
  SELECT conv_id, row_number() OVER w, sha256(string_agg(sha256(role) || sha256(text), '') OVER w), strlen(text)
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY n)),
members AS (SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS ending FROM openings),
nodes AS (
  SELECT depth, opening, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ending), '')) AS ends_sha256
  FROM members GROUP BY depth, opening),
parents AS (
  SELECT n.depth, n.opening, p.conv_id AS parent_conv_id, m.opening AS parent_opening
  FROM nodes n JOIN members m ON m.conv_id = n.conv_id AND m.depth = n.depth - 1
  JOIN nodes p ON p.depth = m.depth AND p.opening = m.opening),
families AS (SELECT depth - 1 AS depth, parent_opening AS opening, count(*) AS n_children FROM parents GROUP BY ALL),
below AS (
  SELECT m.depth, m.opening, count(*) FILTER (f.n_children IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.bytes) AS saved
  FROM nodes n JOIN members m ON m.conv_id = n.conv_id AND m.depth <= n.depth
  LEFT JOIN families f ON f.depth = n.depth AND f.opening = n.opening GROUP BY m.depth, m.opening)
SELECT n.conv_id, n.depth::BIGINT AS depth, parent_conv_id, n_convs, coalesce(n_children, 0)::BIGINT AS n_children,
  n_leaves, saved::BIGINT AS saved_tokens, ends_sha256
FROM nodes n JOIN below b ON b.depth = n.depth AND b.opening = n.opening
LEFT JOIN families f ON f.depth = n.depth AND f.opening = n.opening
LEFT JOIN parents p ON p.depth = n.depth AND p.opening = n.opening
"""
