"""Nearest neighbours by cosine: randomly rotated one-bit codes with error bounds, then exact scores.

A vector is scaled to length one, padded with zeros to ``bits`` dimensions and rotated at random; its code
is the sign of every rotated component (packed, 32 bytes for 256 bits) and one correction scalar, the inner
product of the vector with its code. From the code and the scalar follow an estimate of the cosine with any
query and a bound on its error, ``SIGMAS`` standard deviations wide (the residual is a random direction
after the rotation). A vector whose upper bound reaches the query's k-th best exact score so far is
scored on the original vectors in double precision; all others are left out.

How it runs: vectors are encoded once into a written table. Queries are searched in blocks of about ``BLOCK``
different vectors, one block at a time: it is sent to the tasks, which read the codes slice by slice, and
released with its best k per task written. All rows are searched, none is sampled or capped, and nothing is
trained; the only chance of a miss is an error beyond the bound (below 1e-6 per neighbour).

Equal vectors: of a group of copies only the k + 1 smallest ids can be among the nearest of any
query (ties go to the smaller id), so the others are not searched; equal queries are searched once. Neither
group is ever in one task: both limits are applied before the shuffle.

Edge cases: rows without an id, null or zero vectors and those with null or non-finite components take no
part. Repeated rows count once; of several vectors of one id the one that hashes lowest counts. A
cosine exists between vectors of one length only; those of other lengths are not found. Fewer candidates than
k are all returned. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from notelake.llm.components import stored

K = 5
BLOCK = 4096
# Bits of a code: so many per component, in whole words of 64, and never fewer than the least.
BITS_PER_COMPONENT, LEAST_BITS = 4, 256
SIGMAS = 5.0
SLICE = 1024
# Numbers of the vectors that are scored at once.
SCORED = 1 << 21


def code_bits(width: int) -> int:
    """Longer codes than components: vectors of few components would have loose bounds."""
    wanted = min(BITS_PER_COMPONENT * width, max(LEAST_BITS, width))
    return max(LEAST_BITS, -(-wanted // 64) * 64)


@lru_cache(maxsize=4)
def rotation(width: int) -> np.ndarray:
    """The first ``width`` rows of a random orthogonal matrix, the same on every executor."""
    bits = code_bits(width)
    normal = np.random.default_rng(bits).standard_normal((bits, width))
    basis, upper = np.linalg.qr(normal)
    return (basis * np.sign(np.diag(upper))).T.astype(np.float32)


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed codes and the inner product of each unit vector with its own code."""
    turned = unit(vectors).astype(np.float32) @ rotation(vectors.shape[1])
    own = np.abs(turned).sum(axis=1) / np.sqrt(turned.shape[1])
    return np.packbits(turned > 0, axis=1), own.astype(np.float32)


def upper_bounds(codes: np.ndarray, own: np.ndarray, turned: np.ndarray) -> np.ndarray:
    """For each code (row) and rotated query (column) what the cosine may be at most."""
    bits = turned.shape[1]
    signs = np.unpackbits(codes, axis=1).astype(np.float32) * 2 - 1
    estimate = (signs @ turned.T) / (np.sqrt(np.float32(bits)) * own)[:, None]
    spread = np.sqrt(np.maximum(1 - own * own, 0) / (own * own) / (bits - 1))
    return estimate + (SIGMAS * spread + 1e-5)[:, None]


def exact(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Cosines of rows of original vectors; the same pair gives the same value in any slice."""
    def total(x):
        return np.add.accumulate(x, axis=1)[:, -1]

    # Scaling by powers of two changes no digit and keeps squares in range.
    left, right = (np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])
                   for x in (left, right))
    return total(left * right) / (np.sqrt(total(left * left)) * np.sqrt(total(right * right)))


class Best:
    """The k best (score, id) of each query so far, best first."""

    def __init__(self, queries: int, k: int):
        self.score = np.full((queries, k), -np.inf)
        self.id = np.zeros((queries, k), np.int64)

    def add(self, query: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        k = self.score.shape[1]
        touched, place = np.unique(query, return_inverse=True)
        query = np.concatenate([place, np.repeat(np.arange(len(touched)), k)])
        ids = np.concatenate([ids, self.id[touched].ravel()])
        score = np.concatenate([score, self.score[touched].ravel()])
        order = np.lexsort((ids, -score, query))
        query, ids, score = query[order], ids[order], score[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        keep = rank < k
        at = touched[query[keep]], rank[keep]
        self.id[at], self.score[at] = ids[keep], score[keep]


class Search:
    """A block of query vectors of one length."""

    def __init__(self, vectors: np.ndarray, k: int):
        self.vectors, self.unit, self.best = vectors, unit(vectors), Best(len(vectors), k)
        self.turned = self.unit.astype(np.float32) @ rotation(vectors.shape[1])

    def scan(self, ids, vectors, codes, own) -> None:
        begin, size = 0, 64  # the first slices are small: every pair of them is scored
        step = max(1, SCORED // vectors.shape[1])
        while begin < len(ids):
            part = slice(begin, begin + size)
            near = upper_bounds(codes[part], own[part], self.turned) >= self.best.score[:, -1]
            row, query = np.nonzero(near)
            scaled = unit(vectors[part])
            for at in range(0, len(row), step):
                r, q = row[at:at + step], query[at:at + step]
                # Close enough to tell who may be among the best, but its last digits vary.
                cosine = np.einsum("ij,ij->i", self.unit[q], scaled[r])
                close = cosine >= self.best.score[q, -1] - 1e-9
                r, q = r[close] + begin, q[close]
                self.best.add(q, ids[r], exact(self.vectors[q], vectors[r]))
            begin, size = begin + size, min(4 * size, SLICE)


def by_length(column: pa.Array):
    """(width, rows, matrix) of the vectors of each length in a column of lists."""
    widths = np.asarray(column.value_lengths())
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        yield int(width), rows, np.asarray(
            column.take(pa.array(rows)).flatten()).reshape(len(rows), int(width))


def valid_vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, vector, x, y): one usable vector per id, with two hashes that tell equal ones."""
    values = F.transform(F.col(vector), lambda c: c.cast("double") + F.lit(0.0))
    finite = F.forall("vector", lambda c: c.isNotNull() & (F.abs(c) < F.lit(float("inf"))))
    usable = df.select(F.col(key).alias("vec_id"), values.alias("vector")).where(
        F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & finite
        & F.exists("vector", lambda c: c != 0))
    hashed = usable.select("vec_id", "vector", F.xxhash64(F.lit(1), "vector").alias("x"),
                           F.xxhash64(F.lit(2), "vector").alias("y"))
    first = F.row_number().over(Window.partitionBy("vec_id").orderBy("x", "y"))
    return hashed.withColumn("_first", first).where("_first = 1").drop("_first")


def least_of_equal(vectors: DataFrame, n: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("x", "y").orderBy("vec_id"))
    return vectors.withColumn("_place", place).where(F.col("_place") <= n).drop("_place")


def encode_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, vector, code, own)"""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = np.empty(batch.num_rows, object)
            own = np.zeros(batch.num_rows, np.float32)
            for _, rows, matrix in by_length(batch.column("vector")):
                packed, own[rows] = encode(matrix)
                codes[rows] = [c.tobytes() for c in packed]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("vector"), pa.array(codes, pa.binary()),
                 pa.array(own)], ["vec_id", "vector", "code", "own"])

    return vectors.select("vec_id", "vector").mapInArrow(
        run, "vec_id long, vector array<double>, code binary, own float")


def search_block(index: DataFrame, block: DataFrame, k: int) -> DataFrame:
    """(x, y, vec_id, score): the k best of each task for the queries of one block."""
    rows = block.select("x", "y", "vector").toArrow().combine_chunks()
    sent = index.sparkSession.sparkContext.broadcast(rows)

    def run(batches):
        queries = sent.value
        parts = {width: (at, Search(matrix, k)) for width, at, matrix in by_length(
            queries.column("vector").combine_chunks())}
        for batch in batches:
            ids = np.asarray(batch.column("vec_id"))
            own = np.asarray(batch.column("own"))
            for width, at, matrix in by_length(batch.column("vector")):
                if width in parts:
                    codes = b"".join(batch.column("code").take(pa.array(at)).to_pylist())
                    packed = np.frombuffer(codes, np.uint8).reshape(len(at), -1)
                    parts[width][1].scan(ids[at], matrix, packed, own[at])
        for at, search in parts.values():
            best = search.best
            query, rank = np.nonzero(best.score > -np.inf)
            of = pa.array(at[query])
            yield pa.RecordBatch.from_arrays(
                [queries.column("x").combine_chunks().take(of),
                 queries.column("y").combine_chunks().take(of),
                 pa.array(best.id[query, rank]), pa.array(best.score[query, rank])],
                ["x", "y", "vec_id", "score"])

    found = index.mapInArrow(run, "x long, y long, vec_id long, score double")
    written = stored(found, "nearest")
    sent.destroy()
    return written


def nearest(df: DataFrame, every: int, k: int = K, key: str = "vec_id",
            vector: str = "embedding", block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of each row whose id ``every`` divides."""
    spark = df.sparkSession
    vectors = stored(valid_vectors(df, key, vector), "vectors")
    index = stored(encode_vectors(least_of_equal(vectors, k + 1)), "codes")
    asked = vectors.where(F.col("vec_id") % every == 0)
    different = stored(least_of_equal(asked, 1).select("x", "y", "vector"), "queries")
    blocks = -(-different.count() // block)
    found = spark.createDataFrame([], "x long, y long, vec_id long, score double")
    for number in range(blocks):
        of = F.pmod("x", F.lit(blocks)) == number
        found = found.unionByName(search_block(index, different.where(of), k + 1))
    order = F.col("score").desc(), F.col("vec_id")
    best = found.withColumn("place", F.row_number().over(
        Window.partitionBy("x", "y").orderBy(*order))).where(F.col("place") <= k + 1)
    each = asked.select(F.col("vec_id").alias("query_id"), "x", "y").join(
        best.drop("place"), ["x", "y"]).where("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(*order))
    return each.withColumn("rank", rank).where(F.col("rank") <= k).select(
        F.col("query_id").alias("query_id"), "rank", "vec_id", "score")
