"""Exact top-k by inner product with the threshold algorithm.

Each dimension has a list of the candidates sorted by that component; a query
reads it from the top where its own component is positive and from the bottom
where it is negative. Sorted access goes down by steps that grow by a quarter;
whatever is seen is scored in full by random access. The components at the
present depth bound the score of everything unseen, and a query stops as soon
as that bound is below its kth score: a later candidate could not even tie.

Queries and candidates are dealt out in blocks. A task has one block of each,
with its own lists, and returns each query's best there; the best of all blocks
are merged. The queries of a block that are still open read together, so that
random access is a matrix product; one that has stopped reads no more.

Whole numbers that fit into two or four bytes are sent so. Every block of
candidates meets every block of queries, as an exact search of a query set
against all rows must; blocks of queries are large, so that a candidate is sent
once for each QUERIES queries. What the bound saves depends on the vectors: it
stops early where few components carry the score, and not at all where many
dimensions count alike.

Vectors that are null, or hold null or non-finite components, and rows without
an id take no part; vectors of different lengths don't meet. Rows that repeat an
id are rows of their own as candidates; as queries they are one query, whose
result has the best of all its pairs, and none of them is a candidate for it. Of
equal scores the smaller id comes first. Scores outside the range of a long are
cut to it. Without rows or without queries the result is empty. Only the id and
the vector are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import small_batches, written

#: Candidates and queries in a block, on average.
CANDIDATES, QUERIES = 4096, 8192
#: Factor by which the depth of sorted access grows.
STEP = 1.25
LONG = (1 << 63) - 1


def scaled(rows: DataFrame, id: str, vector: str, factor: float) -> DataFrame:
    """(id, dim, v): vectors that take part, as whole numbers floor(factor * x)."""
    small_batches(rows.sparkSession)

    def run(batches):
        for batch in batches:
            ids, out = [], []
            lists = batch.column(1)
            for key, x in zip(batch.column(0).to_pylist(), lists, strict=True):
                if key is None or not x.is_valid or x.values.null_count:
                    continue
                a = np.floor(x.values.to_numpy(zero_copy_only=False).astype(np.float64) * factor)
                if len(a) and np.isfinite(a).all():
                    ids.append(key)
                    out.append(np.clip(a, -(2.0**62), 2.0**62).astype("<i8"))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([len(a) for a in out], pa.int32()), pa.array([narrow(a) for a in out], pa.binary())], ["id", "dim", "v"])

    return rows.select(F.col(id).cast("long").alias("id"), F.col(vector)).mapInArrow(run, "id long, dim int, v binary")


def narrow(a: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as hold them."""
    most = int(np.abs(a).max())
    return a.astype("<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8").tobytes()


def wide(parts: list[bytes], dim: int) -> np.ndarray:
    """Vectors of narrow() as one matrix."""
    out = np.empty((len(parts), dim), np.int64)
    size = np.array([len(p) for p in parts]) // dim
    for n in np.unique(size).tolist():
        at = np.flatnonzero(size == n)
        out[at] = np.frombuffer(b"".join([parts[i] for i in at.tolist()]), f"<i{n}").reshape(-1, dim)
    return out


def best_of(queries: np.ndarray, own: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int) -> tuple[list[np.ndarray], list[np.ndarray], int]:
    """For each query, ids and scores of its k best vectors (ids ascending in `ids`), and how many scores were computed."""
    m, dim = vectors.shape
    if dim * float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) >= 2.0**48:
        return exhaustive(queries, own, vectors, ids, k)
    x, q = vectors.astype(np.float64), queries.astype(np.float64)
    rank = np.argsort(x, axis=0, kind="stable")
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    bits = max(1, int(m - 1).bit_length())
    none = np.iinfo(np.int64).min
    best = np.full((len(q), k), none)  # score and place in one number: larger is better, then the smaller place
    active, seen, depth, scored = np.arange(len(q)), np.zeros(m, bool), 0, 0
    column = np.arange(dim)
    own_from, own_to = np.searchsorted(ids, own), np.searchsorted(ids, own, side="right")
    while len(active) and depth < m:
        depth = min(m, max(k, int(STEP * depth) + 1))
        new = np.zeros(m, bool)
        top, bottom = (up[active] > 0).any(axis=0), (down[active] < 0).any(axis=0)
        new[rank[m - depth :, top].ravel()] = True
        new[rank[:depth, bottom].ravel()] = True
        if depth == m:
            new[:] = True
        new = np.flatnonzero(new & ~seen)
        seen[new] = True
        for a in range(0, len(active), 256):
            some = active[a : a + 256]
            score = (q[some] @ x[new].T).astype(np.int64)
            scored += score.size
            key = (score << bits) | (m - 1 - new)
            for i in np.flatnonzero(own_from[some] < own_to[some]).tolist():  # rows with the query's own id
                key[i, (new >= own_from[some[i]]) & (new < own_to[some[i]])] = none
            both = np.concatenate((best[some], key), axis=1)
            best[some] = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
        limit = up[active] @ x[rank[m - depth, column], column] + down[active] @ x[rank[depth - 1, column], column]
        kth = best[active].min(axis=1)
        active = active[(kth == none) | (limit >= (kth >> bits))]
    out_ids, out_scores = [], []
    for row in np.sort(best, axis=1)[:, ::-1]:
        row = row[row != none]
        out_ids.append(ids[m - 1 - (row & ((1 << bits) - 1))])
        out_scores.append(row >> bits)
    return out_ids, out_scores, scored


def exhaustive(queries: np.ndarray, own: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int) -> tuple[list[np.ndarray], list[np.ndarray], int]:
    """The same for components too large for exact doubles."""
    out_ids, out_scores = [], []
    big = vectors.astype(object)
    for q, me in zip(queries.astype(object), own.tolist(), strict=True):
        ranked = sorted(((-max(-LONG - 1, min(LONG, int(s))), i) for s, i in zip(big @ q, ids.tolist(), strict=True) if i != me))[:k]
        out_ids.append(np.array([i for _, i in ranked], np.int64))
        out_scores.append(np.array([-s for s, _ in ranked], np.int64))
    return out_ids, out_scores, queries.shape[0] * vectors.shape[0]


def top_k(rows: DataFrame, is_query, k: int = 20, id: str = "vec_id", vector: str = "embedding", factor: float = 64.0) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows for each row for whose id the condition is_query(column) holds."""
    vectors = written(scaled(rows, id, vector, factor), "vectors")
    flagged = vectors.withColumn("asks", F.coalesce(is_query(F.col("id")), F.lit(False)))
    n, asking = flagged.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    many, few = max(1, -(-n // CANDIDATES)), max(1, -(-asking // QUERIES))
    deal = lambda salt, of: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(of)).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), F.lit(of - 1)))
    candidates = flagged.select(deal(1, many).alias("c"), every(few).alias("q"), F.lit(0).alias("kind"), "dim", "id", "v")
    queries = flagged.filter("asks").select(every(many).alias("c"), deal(2, few).alias("q"), F.lit(1).alias("kind"), "dim", "id", "v")
    both = candidates.union(queries).repartition(max(1, min(many * few, 20_000)), "c", "q").sortWithinPartitions("c", "q", "dim", "kind", "id")

    def blocks(batches):
        held, key = {0: ([], []), 1: ([], [])}, None

        def flush():
            nonlocal held
            (ci, cv), (qi, qv) = held[0], held[1]
            if ci and qi:
                ids, scores, _ = best_of(wide(qv, key[2]), np.array(qi), wide(cv, key[2]), np.array(ci), k)
                yield pa.RecordBatch.from_arrays([pa.array(qi, pa.int64()), pa.array([x.tolist() for x in ids], pa.list_(pa.int64())), pa.array([x.tolist() for x in scores], pa.list_(pa.int64()))], ["query_id", "ids", "scores"])
            held = {0: ([], []), 1: ([], [])}

        for batch in batches:
            for c, q, kind, dim, i, v in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if (c, q, dim) != key:
                    yield from flush()
                    key = (c, q, dim)
                held[kind][0].append(i)
                held[kind][1].append(v)
        yield from flush()

    def merge(batches):
        held, key = [], None

        def top():
            ranked = sorted(held)[:k]
            return pa.RecordBatch.from_arrays([pa.array([key] * len(ranked), pa.int64()), pa.array(range(1, len(ranked) + 1), pa.int32()), pa.array([i for _, i in ranked], pa.int64()), pa.array([-s for s, _ in ranked], pa.int64())], ["query_id", "rank", "vec_id", "score"])

        for batch in batches:
            for q, ids, scores in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if q != key:
                    if held:
                        yield top()
                    held, key = [], q
                held += [(-s, i) for s, i in zip(scores, ids, strict=True)]
        if held:
            yield top()

    found = both.mapInArrow(blocks, "query_id long, ids array<long>, scores array<long>")
    return found.repartition("query_id").sortWithinPartitions("query_id").mapInArrow(merge, "query_id long, rank int, vec_id long, score long")
