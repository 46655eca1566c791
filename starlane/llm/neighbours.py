"""Nearest neighbours by cosine through a multi-index over learned binary codes.

A bounded sample of the vectors teaches rotations whose signs are the bits of a code
(iterative quantization), and the radius: the Hamming distance within which nearly all true
neighbours of sampled queries lie. Codes are split into substrings, and each block of rows
has an index of every substring. A code within the radius differs little in at least one
substring (pigeonhole), so probing each index for the keys within its share of the radius
finds every code within the radius; those are ranked by their original vectors.

Blocks of queries meet blocks of rows, each pair in a task of its own, and a query's best rows
are merged. Queries that find too few rows are searched again with a wider radius, at last
with the whole code length, which leaves nothing out.

Defined cases: rows with NULL vec_id, and vectors that are NULL, empty, zero or hold NULL or
non-finite components, take no part, nor do those of another length than most; rows with the
query's vec_id are not its neighbours; ties go to the smaller vec_id, and a repeated row
counts once for each time; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starlane.llm.files import stage, table

SAMPLE, SAMPLE_QUERIES, COVERED = 4096, 256, 0.98
BITS, SUBSTRING = 256, 64
ROWS_A_BLOCK, QUERIES_A_BLOCK = 8192, 2048
FOUND = "query_id long, vec_id long, score double"


class Codes:
    """Rotations learned from a sample, and the codes of vectors under them."""

    def __init__(self, sample: np.ndarray, seed: int = 7, steps: int = 25):
        unit = sample / np.linalg.norm(sample, axis=1, keepdims=True) if len(sample) else sample
        kept = min(unit.shape[1], 64)
        values, axes = np.linalg.eigh(unit.T @ unit)
        axes = axes[:, np.argsort(-values)[:kept]]
        small, random, rotations = unit @ axes, np.random.default_rng(seed), []
        for _ in range(-(-BITS // kept)):
            rotation = np.linalg.qr(random.normal(size=(kept, kept)))[0]
            for _ in range(steps):
                u, _, v = np.linalg.svd(np.where(small @ rotation >= 0, 1.0, -1.0).T @ small)
                rotation = (u @ v).T
            rotations.append(axes @ rotation)
        self.matrix = np.hstack(rotations)[:, :BITS].astype(np.float32)

    def of(self, vectors: np.ndarray) -> np.ndarray:
        """One row of 64-bit words, the substrings, for each vector."""
        bits = np.packbits(vectors.astype(np.float32) @ self.matrix >= 0, axis=1)
        return np.ascontiguousarray(bits).view(np.uint64)


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


def learned_radius(codes: Codes, sample: np.ndarray, k: int) -> int:
    """The distance within which the given share of the sample's true neighbours lies."""
    unit, code = sample / np.linalg.norm(sample, axis=1, keepdims=True), codes.of(sample)
    far = []
    for i in range(min(len(sample), SAMPLE_QUERIES)):
        score = unit @ unit[i]
        score[i] = -np.inf
        near = np.argsort(-score)[: min(k, len(sample) - 1)]
        far.extend(hamming(code[near], code[i]).tolist())
    return int(np.quantile(far, COVERED)) if far else BITS


class BlockIndex:
    """For each substring the keys of a block and the rows that have them."""

    def __init__(self, code: np.ndarray):
        self.code, self.parts = code, []
        for j in range(code.shape[1]):
            order = np.argsort(code[:, j], kind="stable")
            keys, starts = np.unique(code[order, j], return_index=True)
            self.parts.append((keys, order, np.append(starts, len(order))))

    def within(self, query: np.ndarray, radius: int) -> np.ndarray:
        """Every row whose code lies within the radius."""
        share, hit = radius // len(self.parts), np.zeros(len(self.code), dtype=bool)
        for j, (keys, order, starts) in enumerate(self.parts):
            probed = np.flatnonzero(np.bitwise_count(keys ^ query[j]) <= share)
            if len(keys) == len(order):
                hit[order[probed]] = True
            else:
                for p in probed.tolist():
                    hit[order[starts[p] : starts[p + 1]]] = True
        rows = np.flatnonzero(hit)
        return rows[hamming(self.code[rows], query) <= radius]


def best(query_id: int, vector: np.ndarray, ids: np.ndarray, vectors: np.ndarray, norms: np.ndarray, k: int) -> pd.DataFrame:
    other = np.flatnonzero(ids != query_id)
    score = vectors[other] @ vector / (norms[other] * np.sqrt(vector @ vector))
    top = np.lexsort((ids[other], -score))[:k]
    return pd.DataFrame({"query_id": query_id, "vec_id": ids[other][top], "score": score[top]})


def search(queries: DataFrame, rows: DataFrame, codes: Codes, radius: int, k: int, blocks: int, query_blocks: int) -> DataFrame:
    """The best ``k`` rows within the radius of each query."""

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
        vectors = np.array(right["v"].tolist(), dtype=np.float64)
        ids, norms = right["vec_id"].to_numpy(), np.sqrt((vectors * vectors).sum(axis=1))
        index, asked = BlockIndex(codes.of(vectors)), np.array(left["v"].tolist(), dtype=np.float64)
        found = []
        for query_id, vector, code in zip(left["query_id"].tolist(), asked, codes.of(asked)):
            near = index.within(code, radius)
            found.append(best(query_id, vector, ids[near], vectors[near], norms[near], k))
        return pd.concat(found, ignore_index=True)

    def part(column: str, n: int):
        return F.pmod(F.xxhash64(column), F.lit(n)).cast("int")

    dealt = rows.select("vec_id", "v", part("vec_id", blocks).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("query_block"))
    asked = queries.select("query_id", "v", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), part("query_id", query_blocks).alias("query_block"))
    met = asked.groupBy("block", "query_block").cogroup(dealt.groupBy("block", "query_block")).applyInPandas(meet, FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and v of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select("vec_id", v.alias("v")).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    return rows.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))


def nearest(vectors: DataFrame, every: int, k: int = 5) -> DataFrame:
    """The ``k`` nearest rows of each row whose vec_id is divisible by ``every``."""
    rows = usable(vectors)
    sizes = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").first()
    spark = vectors.sparkSession
    if sizes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    size, n = sizes
    rows = stage(rows.where(F.size("v") == size), "vectors")
    # The share is one in 2^40 at least, so that a table of any size gives a sample.
    chosen = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 40)) < F.lit(((1 << 40) * SAMPLE) // n + 1))
    sample = np.array([r[0] for r in chosen.select("v").orderBy("v").limit(2 * SAMPLE).collect()], dtype=np.float64).reshape(-1, size)
    sample = np.random.default_rng(3).permutation(sample)
    codes = Codes(sample)
    radius = learned_radius(codes, sample, k)
    blocks = max(1, -(-n // ROWS_A_BLOCK))
    queries = rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "v").dropDuplicates(["query_id"])
    query_blocks = max(1, -(-queries.count() // QUERIES_A_BLOCK))
    done = None
    while True:
        found = stage(search(queries, rows, codes, radius, k, blocks, query_blocks), "neighbours")
        few = found.groupBy("query_id").count().where(F.col("count") >= k).select("query_id")
        complete = found if radius >= BITS else found.join(few, "query_id", "left_semi")
        done = complete if done is None else done.unionByName(complete)
        queries = queries.join(few, "query_id", "left_anti")
        if radius >= BITS or queries.isEmpty():
            return done.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
        radius = min(BITS, radius + BITS // 8)


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), every=50)
