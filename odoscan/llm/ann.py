"""Nearest neighbours by randomly rotated one-bit codes, with exact reranking.

Vectors are centred and rotated by a random orthogonal matrix; a code keeps one sign per
dimension. With the residual's length and the inner product of code and residual
direction, the code of a vector o estimates <q, o> for any q without bias, and the
estimate is off by at most ``epsilon * |q| |r| sqrt(1 - f^2) / (f sqrt(d - 1))`` with a
probability that falls fast with epsilon (|r| the residual's length, f the inner
product of code and direction). A vector is reranked with its original components if
its upper bound reaches the k-th best lower bound, so nearly all are left out by their
packed bits alone, and the k nearest are missed only if a bound fails.

The stated queries meet all rows in a grid of bounded blocks: one task holds a block of
queries and a block of vectors, and returns at most k rows per query. Ties go to the
smaller id. Vectors that are null, zero, of another length, or hold nulls or non-finite
components take no part, nor do null ids; a row with the query's own id is no
candidate, other repeated rows are. Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odoscan.llm.common import stage


def usable(vector: Column, dim: int) -> Column:
    """Whether a vector takes part."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) == dim) & ~bad & F.exists(vector, lambda x: x != 0)


def rotation(dim: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs, residual lengths, and the inner product of code and residual direction."""
    residual = (vectors - centre) @ turn.T
    length = np.linalg.norm(residual, axis=1)
    signs = residual >= 0
    fit = np.abs(residual).sum(axis=1) / np.sqrt(vectors.shape[1]) / np.where(length > 0, length, 1)
    return np.packbits(signs, axis=1), length, np.where(length > 0, fit, 1.0)


def estimates(
    codes: np.ndarray, length: np.ndarray, fit: np.ndarray, queries: np.ndarray, centre: np.ndarray, turn: np.ndarray, epsilon: float
) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products (queries by vectors) and the error bound of each vector per unit of query length."""
    dim = queries.shape[1]
    signs = np.unpackbits(codes, axis=1, count=dim).astype(np.float32) * 2 - 1
    scale = (length / fit / math.sqrt(dim)).astype(np.float32)
    estimate = ((queries @ turn.T).astype(np.float32) @ signs.T) * scale + (queries @ centre).astype(np.float32)[:, None]
    bound = epsilon * length * np.sqrt(np.maximum(1 - fit**2, 0)) / fit / math.sqrt(max(dim - 1, 1))
    return estimate, bound


def best_of_block(
    ids: np.ndarray, vectors: np.ndarray, coded: tuple[np.ndarray, np.ndarray, np.ndarray], query_ids: np.ndarray, queries: np.ndarray,
    k: int, centre: np.ndarray, turn: np.ndarray, epsilon: float,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query row, vector row, score) of each query's best in one block, and how many were reranked."""
    rows, found, scores, reranked = [], [], [], 0
    for low in range(0, len(queries), 128):
        some = queries[low : low + 128]
        estimate, bound = estimates(*coded, some, centre, turn, epsilon)
        # Beside the bound what single precision may round off.
        rounding = 1e-5 * (coded[1] + np.linalg.norm(centre)) + 1e-6
        slack = np.linalg.norm(some, axis=1)[:, None] * (bound + rounding) + 1e-6
        own = query_ids[low : low + 128][:, None] == ids[None, :]
        lower = np.where(own, -np.inf, estimate - slack)
        cut = np.partition(lower, -k, axis=1)[:, -k] if lower.shape[1] > k else np.full(len(some), -np.inf)
        chosen = (estimate + slack >= cut[:, None]) & ~own
        for i in range(len(some)):
            at = np.flatnonzero(chosen[i])
            reranked += len(at)
            score = (vectors[at] * some[i]).sum(axis=1)  # row by row, so that equal vectors get equal scores
            order = np.lexsort((ids[at], -score))[:k]
            rows.append(np.full(len(order), low + i))
            found.append(at[order])
            scores.append(score[order])
    return np.concatenate(rows), np.concatenate(found), np.concatenate(scores), reranked


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    epsilon: float = 3.0,
    block: int = 16384,
    query_block: int = 8192,
    seed: int = 5,
) -> DataFrame:
    """Each query's k nearest by inner product: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    given = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("v"), is_query.alias("asks")).filter("vec_id is not null")
    sizes = given.filter("v is not null").groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    schema = f"query_id {vectors.schema[id_col].dataType.simpleString()}, vec_id {vectors.schema[id_col].dataType.simpleString()}, score double"
    if not sizes or not sizes[0]["d"]:
        return spark.createDataFrame([], schema).select("query_id", F.lit(1).alias("rank"), "vec_id", "score")
    dim = sizes[0]["d"]  # the commonest length
    rows = given.filter(usable(F.col("v"), dim)).select("vec_id", F.col("v").cast("array<double>").alias("v"), "asks")
    totals = rows.agg(F.count(F.lit(1)), F.sum(F.col("asks").cast("int")), *[F.avg(F.col("v")[i]) for i in range(dim)]).first()
    count, asking = totals[0], totals[1] or 0
    centre = np.array(totals[2:], dtype=np.float64) if count else np.zeros(dim)
    turn = rotation(dim, seed)
    blocks, ask_blocks = max(1, -(-count // block)), max(1, -(-asking // query_block))

    def code(batches):
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            bits, length, fit = encode(flat, centre, turn)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([b.tobytes() for b in bits], pa.binary()), pa.array(length), pa.array(fit)],
                ["vec_id", "v", "asks", "code", "length", "fit"],
            )

    kind = vectors.schema[id_col].dataType.simpleString()
    index = stage(rows.mapInArrow(code, f"vec_id {kind}, v array<double>, asks boolean, code binary, length double, fit double"))
    mixed = F.xxhash64("vec_id")
    everyone = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    stored = index.select("vec_id", "v", "code", "length", "fit", F.pmod(mixed, F.lit(blocks)).cast("int").alias("vb"), everyone(ask_blocks).alias("qb"))
    asked = index.filter("asks").select("vec_id", "v", F.pmod(mixed, F.lit(ask_blocks)).cast("int").alias("qb"), everyone(blocks).alias("vb"))

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, query_ids = left.column("vec_id").to_numpy(), right.column("vec_id").to_numpy()
        out = pa.schema([("query_id", right.schema.field("vec_id").type), ("vec_id", right.schema.field("vec_id").type), ("score", pa.float64())])
        if not len(ids) or not len(query_ids):
            return out.empty_table()
        own = left.column("v").combine_chunks().flatten().to_numpy().reshape(-1, dim)
        queries = right.column("v").combine_chunks().flatten().to_numpy().reshape(-1, dim)
        codes = np.frombuffer(b"".join(left.column("code").to_pylist()), np.uint8).reshape(len(ids), -1)
        coded = (codes, left.column("length").to_numpy(), left.column("fit").to_numpy())
        row, found, score, _ = best_of_block(ids, own, coded, query_ids, queries, k, centre, turn, epsilon)
        return pa.Table.from_arrays([pa.array(query_ids[row]), pa.array(ids[found]), pa.array(score)], schema=out)

    near = stored.groupBy("vb", "qb").cogroup(asked.groupBy("vb", "qb")).applyInArrow(cell, schema)
    ranks = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(ranks)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
