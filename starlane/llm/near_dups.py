"""Near-duplicate classes by MinHash signatures and a multi-index Hamming join.

A document is the set of its word shingles, and its signature holds ``SLOTS`` minimum hashes
of ``BITS`` bits. Two sets of similarity s differ in a slot with probability at most 1 - s, so
sets at the threshold stay within ``radius`` differing slots but for a chance of ``MISS``. The
signature is split into chunks, so few that of two signatures within the radius one chunk
differs in at most one slot (pigeonhole). Every allowed error of a chunk is enumerated by
leaving out each slot in turn: 128 keys a document find every pair within the radius.

Equal sets are one class with one signature. The members of a key are not paired with each
other: each is tied to one of them, the key's hub. Ties within the radius join most of what
belongs together, so only members of a key that they leave apart meet by signature. Both make
groups that hold every pair within the radius; ties beyond it join nothing, or sets that are
little alike would chain the groups of a large table into one. A group is compared in blocks,
two to a task, by signature and then by full set, and a task returns only links that join what
its other links do not, so the components of the links are those of all pairs within the radius
that the sets confirm.

Defined cases: rows without words (NULL or empty text too) are linked with nothing; a row with
NULL doc_id is linked with nothing and kept; rows that share a doc_id are one document with
all its texts; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starlane.llm.files import lean, stage, table
from starlane.operators.match import key_filter

SLOTS, BITS, MISS = 128, 8, 1e-5
#: Rows, and shingles of all rows, of a block.
BLOCK_ROWS, BLOCK_SHINGLES = 512, 1 << 20
#: Rows of a block of a key's members, which meet by signature alone.
KEY_BLOCK = 2048
#: Bits of a filter by doc_id: for each of its ids, and at most.
ID_BITS, MOST_BITS = 32, 1 << 25

_RANDOM = np.random.default_rng(20240229)
MULTIPLY = _RANDOM.integers(0, 1 << 63, SLOTS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADD = _RANDOM.integers(0, 1 << 63, SLOTS, dtype=np.uint64)
KEY_MULTIPLY = _RANDOM.integers(0, 1 << 63, SLOTS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
WORD_MULTIPLY = _RANDOM.integers(0, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finalizer of a public hash function)."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: str | None, width: int) -> np.ndarray:
    """The sorted distinct shingles of a text as 64-bit values.

    A-Z are lower-cased and words end at ASCII white space. A text of fewer words than
    ``width`` is one shingle.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    k = min(width, len(words))
    n = len(words) - k + 1
    total = np.full(n, k, dtype=np.uint64)
    for i in range(k):
        total = mixed(total + hashes[i : i + n] * WORD_MULTIPLY[i % 16])
    return np.unique(total)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """The signature of each set that is not empty: ``BITS`` low bits of the minimum of each slot."""
    out = np.zeros((len(sets), SLOTS), dtype=np.uint8)
    at = 0
    while at < len(sets):
        end, size = at, 0
        while end < len(sets) and (end == at or size + len(sets[end]) <= 32768):
            size += len(sets[end])
            end += 1
        some = [s for s in sets[at:end]]
        full = np.array([i for i, s in enumerate(some) if len(s)], dtype=np.int64)
        if len(full):
            values = np.concatenate(some)
            starts = np.concatenate([[0], np.cumsum([len(some[i]) for i in full])[:-1]]).astype(np.int64)
            for slot in range(SLOTS):
                least = np.minimum.reduceat(values * MULTIPLY[slot] + ADD[slot], starts)
                out[at + full, slot] = (least & np.uint64(0xFF)).astype(np.uint8)
        at = end
    return out


def radius_for(percent: int) -> int:
    """The least number of differing slots that sets at the threshold exceed with a chance below ``MISS``."""
    p, left, r = (100 - percent) / 100, 1.0, -1
    while left > MISS:
        r += 1
        left -= comb(SLOTS, r) * p**r * (1 - p) ** (SLOTS - r)
    return r


def chunks_for(radius: int) -> list[np.ndarray]:
    """Slots of each chunk; with one error allowed in a chunk, (radius + 1) / 2 of them suffice."""
    return np.array_split(np.arange(SLOTS), max(1, -(-(radius + 1) // 2)))


def keys_of(signature: np.ndarray, chunks: list[np.ndarray]) -> np.ndarray:
    """For each signature one key per slot: of the slot's chunk, without the slot."""
    parts = mixed((signature.astype(np.uint64) + np.uint64(1)) * KEY_MULTIPLY[None, :])
    keys = np.empty_like(parts)
    for chunk in chunks:
        whole = parts[:, chunk].sum(axis=1, dtype=np.uint64)
        keys[:, chunk] = mixed(whole[:, None] - parts[:, chunk] + KEY_MULTIPLY[chunk][None, :])
    return keys


def sketch(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, number of shingles, digest of the set, signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                sets = [shingles(t, width) for t in some.column(1).to_pylist()]
                signs = signatures(sets)
                yield pa.RecordBatch.from_arrays([
                    some.column(0), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                    pa.array([s.tobytes() for s in signs], pa.binary()),
                ], ["doc_id", "n_shingles", "digest", "signature"])

    return docs.select("doc_id", "text").mapInArrow(lean(run), "doc_id long, n_shingles long, digest binary, signature binary")


def key_rows(classes: DataFrame, radius: int) -> DataFrame:
    """Every class with each of its keys."""
    chunks = chunks_for(radius)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                some = batch.slice(at, 1024)
                signs = signs_of(some.column(1))
                keys = keys_of(signs, chunks).view(np.int64)
                who = np.repeat(np.asarray(some.column(0)), SLOTS)
                yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1)), pa.array(who)], ["key", "rep"])

    return classes.select("rep", "signature").mapInArrow(lean(run), "key long, rep long")


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                raw = [shingles(t, width).tobytes() for t in some.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(raw, pa.binary())], ["rep", "shingles"])

    return docs.select("doc_id", "text").mapInArrow(lean(run), "rep long, shingles binary")


def shared_keys(keys: DataFrame) -> DataFrame:
    """The members of keys that have several, with the key's hub and size; the keys are shuffled once."""
    of_key = Window.partitionBy("key")
    return keys.withColumns({"hub": F.min("rep").over(of_key), "size": F.count(F.lit(1)).over(of_key)}).where("size > 1")


def near(signs: np.ndarray, sizes: np.ndarray, x: np.ndarray, y: np.ndarray, radius: int, percent: int) -> np.ndarray:
    """Whether rows x and y are within the radius, and their sizes allow the threshold."""
    fits = 100 * np.minimum(sizes[x], sizes[y]) >= percent * np.maximum(sizes[x], sizes[y])
    fits[fits] = (signs[x[fits]] != signs[y[fits]]).sum(axis=1) <= radius
    return fits


def signs_of(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, SLOTS)


def near_ties(shared: DataFrame, signed: DataFrame, radius: int, percent: int) -> DataFrame:
    """Ties (a, b) of a member and a hub of its that are near."""
    hubs, reps = (signed.select(F.col("rep").alias(e), F.col("n").alias(f"n_{e}"), F.col("signature").alias(f"sign_{e}")) for e in "ab")
    met = shared.where("hub <> rep").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct().join(hubs, "a").join(reps, "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            signs = np.concatenate([signs_of(batch.column(4)), signs_of(batch.column(5))])
            sizes = np.concatenate([np.asarray(batch.column(2)), np.asarray(batch.column(3))])
            yield batch.select([0, 1]).filter(pa.array(near(signs, sizes, np.arange(n), np.arange(n, 2 * n), radius, percent)))

    return met.select("a", "b", "n_a", "n_b", "sign_a", "sign_b").mapInArrow(lean(run), "a long, b long")


def key_links(shared: DataFrame, labels: DataFrame, signed: DataFrame, radius: int, percent: int) -> DataFrame:
    """Links (a, b) that join the members of a key wherever two are near and ``labels`` (rep, component) has them apart.

    The members of a large key are dealt into blocks, two to a task. In a key of two members the
    tie has said it all.
    """
    of_key = Window.partitionBy("key")
    own = shared.where("size > 2").join(labels, "rep", "left").select("key", "rep", "size", F.coalesce("component", "rep").alias("label"))
    own = own.withColumns({"low": F.min("label").over(of_key), "high": F.max("label").over(of_key)}).where("low <> high")
    blocks = F.ceil(F.col("size") / KEY_BLOCK).cast("int")
    own = own.withColumn("blocks", blocks).withColumn("blk", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    own = own.join(signed, "rep").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    i, j = F.least("blk", "other").alias("i"), F.greatest("blk", "other").alias("j")
    dealt = own.select("key", i, j, "blk", "rep", "label", "n", "signature").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def links(rows: pa.Table) -> pa.RecordBatch:
        key, i, j, blk, reps, labels, sizes = (np.asarray(rows.column(c)) for c in ("key", "i", "j", "blk", "rep", "label", "n"))
        signs, labels, found = signs_of(rows.column("signature")), labels.copy(), []
        at, step = np.arange(len(key) - 1), 1
        while len(at):
            to = at + step
            same = (key[at] == key[to]) & (i[at] == i[to]) & (j[at] == j[to])
            at, to = at[same], to[same]
            apart = (labels[at] != labels[to]) & ((i[at] == j[at]) | (blk[at] != blk[to]))
            x, y = at[apart], to[apart]
            close = near(signs, sizes, x, y, radius, percent)
            for x, y in zip(x[close].tolist(), y[close].tolist()):
                if labels[x] != labels[y]:
                    found.append((reps[x], reps[y]))
                    labels[labels == labels[y]] = labels[x]
            step += 1
            at = at[at + step < len(key)]
        return pa.RecordBatch.from_arrays([pa.array([x[e] for x in found], pa.int64()) for e in (0, 1)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([*rest, batch]).combine_chunks()
            tasks = np.stack([np.asarray(rows.column(c)) for c in ("key", "i", "j")])
            ends = np.flatnonzero((tasks[:, 1:] != tasks[:, :-1]).any(axis=0))
            cut = int(ends[-1]) + 1 if len(ends) else 0  # the last task may go on in the next batch
            if cut:
                yield links(rows.slice(0, cut))
            rest = rows.slice(cut).to_batches()
        if rest:
            yield links(pa.Table.from_batches(rest).combine_chunks())

    return dealt.mapInArrow(lean(run), "a long, b long")


def groups_of(shared: DataFrame, signed: DataFrame, radius: int, percent: int) -> DataFrame:
    """Classes (rep, grp) that near pairs join; ``signed`` has rep, n and signature of the members of ``shared``."""
    tied = stage(near_ties(shared, signed, radius, percent), "near_ties")
    links = key_links(shared, components(tied), signed, radius, percent)
    return components(tied.unionByName(links)).withColumnRenamed("component", "grp")


def among(ids: DataFrame) -> Column:
    """A condition on doc_id that each of these ids meets and few others, so that few texts are shuffled. ``ids`` is read twice."""
    (name,) = ids.columns
    return key_filter(ids, {name: "doc_id"}, min(MOST_BITS, max(1, ID_BITS * ids.count())))


def compared(members: DataFrame, sets: DataFrame, radius: int, percent: int) -> DataFrame:
    """Links (a, b) that join the members of each group wherever pairs within the radius are confirmed.

    ``members`` has rep, n, grp and signature, ``sets`` rep and shingles. A group is dealt into blocks by the
    size of the sets, and only blocks whose sizes allow the threshold meet, two to a task,
    whatever the size of the group. A task checks near pairs first and skips those that its
    links already join.
    """
    step = -log(percent / 100)
    own = members.select("rep", "grp", "n", F.floor(F.log("n") / F.lit(step)).cast("int").alias("cls"))
    counts = own.groupBy("grp", "cls").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("total"))
    blocks = F.greatest(F.ceil(F.col("rows") / BLOCK_ROWS), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("int")
    # The classes of sizes are few, as they grow by a constant factor.
    groups = counts.groupBy("grp").agg(
        F.sum("rows").alias("rows"), F.sum("total").alias("total"),
        F.map_from_entries(F.collect_list(F.struct("cls", blocks.alias("blocks")))).alias("blocks"),
    )
    small = (F.col("rows") <= BLOCK_ROWS) & (F.col("total") <= BLOCK_SHINGLES)
    groups = groups.select("grp", small.alias("small"), F.when(~small, F.col("blocks")).alias("blocks"))
    placed = members.join(groups, "grp").withColumn("cls", F.when(F.col("small"), 0).otherwise(F.floor(F.log("n") / F.lit(step)).cast("int")))

    def count_of(cls):
        return F.when(F.col("small"), F.when(cls == 0, 1).otherwise(0)).otherwise(F.coalesce(F.try_element_at("blocks", cls), F.lit(0)))

    placed = placed.withColumn("blk", F.pmod(F.xxhash64("rep"), count_of(F.col("cls"))).cast("int"))

    def numbers(n):
        return F.filter(F.sequence(F.lit(-1), n - 1), lambda j: j >= 0)

    def task(low, i, high, j):
        return F.struct(low.alias("low"), i.alias("i"), high.alias("high"), j.alias("j"))

    cls, blk = F.col("cls"), F.col("blk")
    same = F.transform(numbers(count_of(cls)), lambda j: task(cls, F.least(blk, j), cls, F.greatest(blk, j)))
    above = F.transform(numbers(count_of(cls + 1)), lambda j: task(cls, blk, cls + 1, j))
    below = F.transform(numbers(count_of(cls - 1)), lambda j: task(cls - 1, j, cls, blk))
    # The sets are the bulk of the rows, so they meet the others once all is dealt.
    placed = placed.select("grp", "rep", "cls", "blk", "signature", F.concat(same, above, below).alias("tasks")).join(sets, "rep")
    dealt = placed.select("grp", "rep", "cls", "blk", "signature", "shingles", F.explode("tasks").alias("task"))

    def meet(key: tuple, rows: pa.Table) -> pa.Table:
        low, i, high, j = (key[1].as_py()[k] for k in ("low", "i", "high", "j"))
        reps = np.asarray(rows.column("rep"))
        signs = signs_of(rows.column("signature"))
        sets = [np.frombuffer(x, dtype=np.uint64) for x in rows.column("shingles").to_pylist()]
        side = (np.asarray(rows.column("cls")) == low) & (np.asarray(rows.column("blk")) == i)
        links = joined(reps, signs, sets, side, (low, i) == (high, j), radius, percent)
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    return dealt.groupBy("grp", "task").applyInArrow(meet, "a long, b long")


def joined(reps, signs, sets, side, alone: bool, radius: int, percent: int) -> list[tuple[int, int]]:
    """Confirmed links of a block with itself (``alone``) or between the rows of either side."""
    left = np.arange(len(reps)) if alone else np.flatnonzero(side)
    right = left if alone else np.flatnonzero(~side)
    sizes, near = np.array([len(s) for s in sets]), []
    for x in left.tolist():
        some = right[right > x] if alone else right
        apart = (signs[some] != signs[x]).sum(axis=1)
        fits = (apart <= radius) & (100 * np.minimum(sizes[some], sizes[x]) >= percent * np.maximum(sizes[some], sizes[x]))
        near += [(d, x, y) for d, y in zip(apart[fits].tolist(), some[fits].tolist())]
    parent, links = list(range(len(reps))), []

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for _, x, y in sorted(near):
        rx, ry = root(x), root(y)
        if rx == ry:
            continue
        pair = np.sort(np.concatenate([sets[x], sets[y]]), kind="stable")
        both = int((pair[1:] == pair[:-1]).sum())
        if 100 * both >= percent * (len(pair) - both):
            parent[rx] = ry
            links.append((int(reps[x]), int(reps[y])))
    return links


def components(links: DataFrame) -> DataFrame:
    """For every end of a link the smallest end that can be reached (rep, component).

    Each round every node moves to its smallest neighbour, and the links are drawn anew between
    what is left, so their number falls fast.
    """
    edges = stage(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    labels = None
    while True:
        ends = edges.select("a", "b").union(edges.select("b", "a"))
        moves = stage(ends.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("to")), "moves")
        for _ in range(2):
            beyond = moves.select(F.col("node").alias("to"), F.col("to").alias("beyond"))
            moves = stage(moves.join(beyond, "to").select("node", F.col("beyond").alias("to")), "moves")
        if labels is None:
            labels = moves.select(F.col("node").alias("rep"), F.col("to").alias("component"))
        else:
            moved = labels.join(moves.withColumnRenamed("node", "component"), "component", "left")
            labels = stage(moved.select("rep", F.coalesce("to", "component").alias("component")), "labels")
        to_a = moves.select(F.col("node").alias("a"), F.col("to").alias("to_a"))
        to_b = moves.select(F.col("node").alias("b"), F.col("to").alias("to_b"))
        drawn = edges.join(to_a, "a").join(to_b, "b").where("to_a <> to_b")
        edges = stage(drawn.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct(), "edges")
        if edges.isEmpty():
            return labels


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document."""
    radius = radius_for(percent)
    sketches = stage(sketch(docs, width), "sketches")
    linkable = sketches.where("n_shingles > 0 and doc_id is not null")
    by_set = linkable.groupBy("digest").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("signature").alias("signature")
    )
    by_set = stage(by_set, "equal_sets")
    classes = by_set.select("rep", "n", "signature")

    shared = stage(shared_keys(key_rows(classes, radius)), "shared_keys")
    signed = stage(classes.join(shared.select("rep").distinct(), "rep", "left_semi"), "signed")
    groups = groups_of(shared, signed, radius, percent)
    texts = docs.select("doc_id", "text").where(among(groups.select("rep")))
    sets = shingle_sets(texts, width).repartition("rep").distinct()
    links = compared(signed.join(groups, "rep"), sets, radius, percent)
    # A doc_id that occurs in several classes links them by itself.
    firsts = by_set.select(F.col("rep").alias("a"), "digest")
    twice = linkable.select(F.col("doc_id").alias("b"), "digest").join(firsts, "digest").where("a <> b").select("a", "b")
    twice = twice.join(classes.select(F.col("rep").alias("b")).distinct(), "b", "left_semi").select("a", "b")
    labels = components(links.unionByName(twice).distinct())

    placed = sketches.join(by_set.select("digest", "rep"), "digest", "left")
    placed = placed.join(labels, "rep", "left")
    linked = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    component = F.when(linked, F.coalesce("component", "rep")).otherwise(F.col("doc_id"))
    return placed.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The documents without those that a component's first document stands for.

    Dropped are the doc_ids that are not kept, and all but one row of a doc_id that repeats.
    """
    gone = near_duplicates(docs, width, percent).where("not kept").select("doc_id", F.lit(True).alias("gone"))
    twice = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1 and doc_id is not null")
    found = gone.unionByName(twice.select("doc_id", F.lit(False).alias("gone")))
    found = stage(found.groupBy("doc_id").agg(F.max("gone").alias("gone")), "gone_or_twice")
    # Only the texts of these ids, and of the few that pass the filter with them, are shuffled.
    there = among(found.select("doc_id"))
    left = docs.where(there).join(found.where("gone").select("doc_id"), "doc_id", "left_anti").select(*docs.columns)
    return docs.where(~there).unionByName(left.dropDuplicates(["doc_id"]))


def op9_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)
