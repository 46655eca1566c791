"""The prefix trie of conversations, from ternary search trees over range shards.

A turn becomes a code of fixed width, its digest and its length, so a conversation is one
binary path and a prefix of turns is a prefix of bytes; texts are read once and never
shuffled. Equal conversations are folded into one path first. The distinct paths are dealt
into shards by range, and each shard builds one ternary search tree: the codes are numbered
by the shard's own dictionary, and paths are inserted median first, which balances the
trees. A node is made after its parent, so one walk over the nodes from last to first
accumulates members, leaves and savings without recursion.

A node can lie in several shards only if it is on the first or the last path of each. Those
boundary nodes are not emitted: each gives a path with what it has besides other boundary
nodes, equal paths are added up, and these far fewer paths go through the same step again,
until one shard holds them all. Nodes below a boundary node learn their parent at the end.

A conversation is one row of 20 bytes a turn, and so is as long as a row can be.

Defined cases: rows without a conv_id belong to no conversation; a NULL role or text is
empty; turns of one number are ordered by the digest of their content, and a repeated row is
a turn of its own; an empty table has no nodes; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlane.llm.files import stage, table

DIGEST_BYTES = 16
WIDTH = DIGEST_BYTES + 4
SHARD_TURNS = 200_000
PART_IDS = 10_000
NONE_SHA = hashlib.sha256(b"").hexdigest()

PATHS = "path binary, members long, first long, leaves long, saved long, children long, ends string"
NODES = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string, key binary, parent_key binary"
)


def conversation_paths(conversations: DataFrame) -> DataFrame:
    """conv_id and the codes of its turns in order, as one binary path."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    # The length of the role parts it from the text.
    digest = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, 2 * DIGEST_BYTES)
    code = F.concat(digest, F.lpad(F.hex(F.char_length(text)), 8, "0"))
    turns = conversations.where(F.col("conv_id").isNotNull()).select("conv_id", "turn", code.alias("code"))
    ordered = F.sort_array(F.collect_list(F.struct("turn", "code")))
    return turns.groupBy("conv_id").agg(F.unhex(F.array_join(F.transform(ordered, lambda t: t["code"]), "")).alias("path"))


def rebuilt_paths(paths: DataFrame, block: int = 100, heads: int = 6) -> DataFrame:
    """Every conversation's path, its first turns replaced by those of its block's first conversation."""
    base = F.col("conv_id") - F.col("conv_id") % block
    cut = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads * WIDTH
    known = paths.where(F.col("conv_id") % block == 0).select(
        F.col("conv_id").alias("base"), F.substring("path", 1, (heads - 1) * WIDTH).alias("head")
    )
    rows = paths.select("conv_id", "path", base.alias("base"), cut.cast("int").alias("cut")).join(known, "base", "left")
    head = F.coalesce(F.substring("head", F.lit(1), F.col("cut")), F.unhex(F.lit("")))
    return rows.select("conv_id", F.concat(head, F.substring("path", F.col("cut") + 1, F.octet_length("path"))).alias("path"))


def folded_paths(rows: DataFrame, shards: int) -> DataFrame:
    """One row per distinct path: its members, the smallest of them, and the digest of them all.

    Conversations are sorted by path and id over all shards, so copies of one conversation
    fill several of them; each run becomes parts of joined ids, and the parts of a path are
    put together in order, a stream in one task.
    """

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, ids = None, []
        out: list[tuple] = []

        def close():
            out.append((last, ids[0], len(ids), ",".join(map(str, ids))))

        for batch in batches:
            for path, conv_id in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if ids and (path != last or len(ids) >= PART_IDS):
                    close()
                    ids = []
                last = path
                ids.append(conv_id)
            if out:
                yield columns(out, "path binary, first long, n long, ids string")
                out.clear()
        if ids:
            close()
            yield columns(out, "path binary, first long, n long, ids string")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, digest, first, n = None, None, 0, 0
        out: list[tuple] = []

        def close():
            out.append((last, n, first, 0, 0, 0, digest.hexdigest()))

        for batch in batches:
            for path, start, count, ids in zip(*[c.to_pylist() for c in batch.columns]):
                if digest is not None and path == last:
                    digest.update(f",{ids}".encode())
                    n += count
                    continue
                if digest is not None:
                    close()
                last, digest, first, n = path, hashlib.sha256(ids.encode()), start, count
            if out:
                yield columns(out, PATHS)
                out.clear()
        if digest is not None:
            close()
            yield columns(out, PATHS)

    dealt = rows.select("path", "conv_id").repartitionByRange(shards, "path", "conv_id").sortWithinPartitions("path", "conv_id")
    runs = dealt.mapInArrow(parts, "path binary, first long, n long, ids string")
    return runs.repartition(shards, "path").sortWithinPartitions("path", "first").mapInArrow(whole, PATHS)


KINDS = {"binary": pa.binary(), "long": pa.int64(), "string": pa.string()}


def columns(rows: list[tuple], layout: str) -> pa.RecordBatch:
    names, kinds = zip(*[part.split() for part in layout.split(", ")])
    return pa.RecordBatch.from_arrays([pa.array(c, KINDS[k]) for c, k in zip(zip(*rows), kinds)], list(names))


def medians_first(n: int) -> Iterator[int]:
    """0 … n-1, the middle before either half."""
    todo = [(0, n)]
    while todo:
        a, b = todo.pop()
        if a < b:
            middle = (a + b) // 2
            yield middle
            todo += [(a, middle), (middle + 1, b)]


class Trie:
    """A trie whose children hang in binary trees by code number: a ternary search tree."""

    def __init__(self, rows: list[tuple]):
        """``rows`` are (path, members, first, leaves, saved, children, ends), sorted by distinct path."""
        codes = [[r[0][i : i + WIDTH] for i in range(0, len(r[0]), WIDTH)] for r in rows]
        self.codes = sorted({c for path in codes for c in path})
        number = {c: i for i, c in enumerate(self.codes)}
        self.chars = [int.from_bytes(c[DIGEST_BYTES:], "big") for c in self.codes]
        # Node 0 is the root. Each node has its code, its parent, its place in its siblings' tree, and its children's tree.
        self.code, self.up, self.low, self.high, self.down, self.depth = [-1], [-1], [-1], [-1], [-1], [0]
        self.end: list[int] = [-1] * len(rows)
        for k in medians_first(len(rows)):
            node = 0
            for code in map(number.__getitem__, codes[k]):
                node = self._child(node, code)
            self.end[k] = node
        self._accumulate(rows)

    def _child(self, node: int, code: int) -> int:
        at = self.down[node]
        if at < 0:
            self.down[node] = self._new(node, code)
            return self.down[node]
        while code != self.code[at]:
            side = self.low if code < self.code[at] else self.high
            if side[at] < 0:
                side[at] = self._new(node, code)
                return side[at]
            at = side[at]
        return at

    def _new(self, parent: int, code: int) -> int:
        self.code.append(code)
        self.up.append(parent)
        self.depth.append(self.depth[parent] + 1)
        for links in (self.low, self.high, self.down):
            links.append(-1)
        return len(self.code) - 1

    def path_to(self, node: int) -> list[int]:
        out = []
        while node >= 0:
            out.append(node)
            node = self.up[node]
        return out[::-1]

    def _accumulate(self, rows: list[tuple]) -> None:
        n = len(self.code)
        self.members, self.leaves, self.saved, self.children = [0] * n, [0] * n, [0] * n, [0] * n
        self.first: list[int | None] = [None] * n
        self.ends: list[str | None] = [None] * n
        for node, (_, members, first, leaves, saved, children, ends) in zip(self.end, rows):
            self.members[node], self.first[node], self.ends[node] = members, first, ends
            self.leaves[node], self.saved[node], self.children[node] = leaves, saved, children
        # The bounds of the shard: what lies on them may go on in the shards beside it.
        self.bound = set(self.path_to(self.end[0]) + self.path_to(self.end[-1]))

    def total(self, whole: bool) -> None:
        """Add every node to its parent, children before parents.

        Unless the ``whole`` trie is here, boundary nodes are not added to each other.
        """
        open_ended = set() if whole else self.bound
        for node in range(len(self.code) - 1, -1, -1):
            if node in open_ended:
                continue
            if not self.children[node]:
                self.leaves[node] = 1
            if node:
                self.saved[node] += (self.members[node] - 1) * self.chars[self.code[node]]
                up = self.up[node]
                self.members[up] += self.members[node]
                self.leaves[up] += self.leaves[node]
                self.saved[up] += self.saved[node]
                self.children[up] += 1
                if self.first[up] is None or self.first[node] < self.first[up]:
                    self.first[up] = self.first[node]


def walked(rows: list[tuple], whole: bool, keyed: bool) -> tuple[list[tuple], list[tuple]]:
    """The nodes of a shard that are complete, and the paths that stand for its boundary nodes.

    A node below a boundary node has its parent's key in place of the parent. With ``keyed``,
    all nodes have a key of their own; keys are chained digests of the codes from the root.
    """
    trie = Trie(rows)
    trie.total(whole)
    open_ended = set() if whole else trie.bound
    keys: dict[int, bytes] = {}

    def key(node: int) -> bytes:
        for at in [a for a in trie.path_to(node) if a not in keys]:
            up = trie.up[at]
            keys[at] = hashlib.sha256(keys[up] + trie.codes[trie.code[at]]).digest()[:DIGEST_BYTES] if at else b"root"
        return keys[node]

    nodes, paths = [], []
    for node in range(len(trie.code)):
        up = trie.up[node]
        if node in open_ended:
            if trie.members[node] or trie.children[node]:
                path = b"".join(trie.codes[trie.code[a]] for a in trie.path_to(node)[1:])
                paths.append((path, trie.members[node], trie.first[node], trie.leaves[node], trie.saved[node], trie.children[node], trie.ends[node]))
            continue
        below_bound = node and up in open_ended
        nodes.append(
            (
                trie.first[node], trie.depth[node], None if below_bound or not node else trie.first[up], trie.members[node],
                trie.children[node], trie.leaves[node], trie.saved[node], trie.ends[node] or NONE_SHA,
                key(node) if keyed else None, key(up) if below_bound else None,
            )
        )
    return nodes, paths


def sharded(paths: DataFrame, shards: int, keyed: bool) -> DataFrame:
    """Nodes (column ``node``) and boundary paths (column ``open``) of every shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns])]
        if not rows:
            return
        nodes, open_ended = walked(rows, whole=shards == 1, keyed=keyed)
        for found, name, layout, other, other_layout in ((nodes, "node", NODES, "open", PATHS), (open_ended, "open", PATHS, "node", NODES)):
            for at in range(0, len(found), 10_000):
                part = columns(found[at : at + 10_000], layout).to_struct_array()
                empty = pa.nulls(len(part), pa.struct([(c.split()[0], KINDS[c.split()[1]]) for c in other_layout.split(", ")]))
                arrays = {name: part, other: empty}
                yield pa.RecordBatch.from_arrays([arrays["node"], arrays["open"]], ["node", "open"])

    dealt = paths.repartitionByRange(shards, "path") if shards > 1 else paths.coalesce(1)
    layout = ", ".join(f"{name} struct<{cells.replace(' ', ':').replace(',:', ',')}>" for name, cells in (("node", NODES), ("open", PATHS)))
    return dealt.sortWithinPartitions("path").mapInArrow(run, layout)


def prefix_nodes(rebuilt: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The nodes of the trie of (conv_id, path)."""

    def shards_for(paths: DataFrame) -> int:
        turns = paths.agg(F.coalesce(F.sum(F.octet_length("path")), F.lit(0))).first()[0] // WIDTH
        return max(1, -(-turns // shard_turns))

    staged = stage(rebuilt, "paths")
    shards = shards_for(staged)
    paths = stage(folded_paths(staged, shards), "folded")
    levels: list[DataFrame] = []
    while True:
        found = stage(sharded(paths, shards, keyed=bool(levels)), "nodes")
        levels.append(found.where("node IS NOT NULL").select("node.*"))
        if shards == 1:
            break
        added = found.where("open IS NOT NULL").select("open.*").groupBy("path").agg(
            *[F.sum(c).alias(c) if c not in ("first", "ends") else F.min(c).alias(c) for c in ("members", "first", "leaves", "saved", "children", "ends")]
        )
        paths = stage(added, "boundary")
        # Each round halves the shards at least, so the rounds come to an end.
        shards = max(1, min(shards_for(paths), shards // 2))
    return _with_parents(levels)


def _with_parents(levels: list[DataFrame]) -> DataFrame:
    shown = [c.split()[0] for c in NODES.split(", ")][:-2]
    nodes = levels[0]
    for level in levels[1:]:
        nodes = nodes.unionByName(level)
    if len(levels) == 1:
        return nodes.select(shown)
    keyed = levels[1]
    for level in levels[2:]:
        keyed = keyed.unionByName(level)
    parents = keyed.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("found"))
    orphans = nodes.where("parent_key IS NOT NULL").join(parents, "parent_key")
    named = orphans.select(*[F.col("found").alias(c) if c == "parent_conv_id" else F.col(c) for c in shown])
    return nodes.where("parent_key IS NULL").select(shown).unionByName(named)


def op11_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = stage(conversation_paths(table(spark, sf_dir, "conversations")), "conversations")
    return prefix_nodes(rebuilt_paths(paths))
