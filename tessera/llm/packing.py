"""Best-fit packing of documents into sequences by linear grouping.

Documents are cut only where they are longer than a sequence: into full pieces,
of which the first may be shorter. How the pieces are packed is decided on the
histogram of lengths, which has as many rows as a sequence has tokens, however
many documents there are:

1. Large lengths are put into groups of equal cardinality and rounded up to the
   largest of their group.
2. For the few rounded sizes, configurations (which sizes share a sequence) are
   optimised by column generation; whole multiples of the solution are kept.
3. Actual documents take the places of rounded ones, which leaves more room.
4. What is left, small documents above all, goes by size, largest first, to the
   fullest sequence that has room; new sequences are opened only if none has.

The plan says which ranks of each length go to which sequences. Ranks are
computed within (length, bucket) groups, so no group holds a whole length.
Lengths above a quarter of a sequence are large, so that configurations hold
two or three documents; groups are fine, since what rounding up wastes can only
be filled by documents that short.

A null text is an empty document: its single piece is the end token. An empty
table gives an empty result. Repeated rows, with an id or without, are documents
of their own. Texts are tokenized whole. Pieces of equal length are
interchangeable: which of them goes where follows their places in a table of
pieces. Only doc_id and text are read, so other names can't clash.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import encoder
from .frames import documents, per_block, written

#: Groups of large lengths, with the share of a sequence above which a length is large. The plan with the fewest sequences is taken.
SETTINGS = ((320, 1 / 4), (160, 1 / 8))
#: Further settings are tried while the plan is so much above the least that all lengths together need.
CLOSE = 1.003
#: Configurations are optimal but for half a sequence, or this share of them.
NEAR = 0.001
#: Least and most groups that the ranks of one length are counted in, and the pieces that a group is made for.
BUCKETS, PIECES = (64, 1024), 250_000


def cut(docs: DataFrame, path: str, capacity: int, end: int) -> DataFrame:
    """All pieces: doc_id, piece, start, length, ids_crc32."""

    def work(block, rows):
        tokens, at = encoder(path).encode(block)
        at = at + np.arange(block.n + 1)
        ids = np.full(at[-1], end, "<u4")
        keep = np.ones(at[-1], bool)
        keep[at[1:] - 1] = False
        ids[keep] = tokens
        total = np.diff(at)
        pieces = -(-total // capacity)
        row = np.repeat(np.arange(block.n), pieces)
        piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first = total - (pieces - 1) * capacity
        start = np.where(piece > 0, first[row] + (piece - 1) * capacity, 0)
        length = np.where(piece > 0, capacity, first[row])
        begin = at[:-1][row] + start
        data = memoryview(ids).cast("B")
        crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(begin.tolist(), (begin + length).tolist(), strict=True)]
        return {"doc_id": rows.column(0).take(row), "piece": piece, "start": start, "length": length, "ids_crc32": crc}

    return per_block(documents(docs), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long", work)


def inverted(matrix: np.ndarray) -> np.ndarray:
    """The inverse, by elimination with row exchanges: a driver's threads are no place for a library's own."""
    n = len(matrix)
    both = np.concatenate((matrix, np.eye(n)), axis=1)
    for i in range(n):
        k = i + int(np.abs(both[i:, i]).argmax())
        if k != i:
            both[[i, k]] = both[[k, i]]
        both[i] /= both[i, i]
        factor = both[:, i].copy()
        factor[i] = 0
        used = np.flatnonzero(factor)
        both[used] -= factor[used, None] * both[i]
    return both[:, n:]


def configurations(sizes: list[int], demand: list[int], capacity: int, rounds: int = 3000) -> list[tuple[float, list[int]]]:
    """Amounts of configurations that together cover the demand with the fewest sequences, fractions allowed (column generation)."""
    n = len(sizes)
    order = np.array(sizes)
    basis = np.diag(capacity // order).astype(float)
    inverse = np.diag(1.0 / (capacity // order))
    amount = np.array(demand, float) / basis.diagonal()
    layers = capacity // int(order.min())
    at = np.arange(capacity + 1)[:, None] - order[None, :]
    fits = at >= 0
    at = np.maximum(at, 0)
    for step in range(rounds):
        if step % 128 == 127:  # the updates' rounding errors add up
            inverse = inverted(basis)
        price = np.maximum(inverse.sum(axis=0), 0)
        # The most valuable contents of one sequence, a document more with each layer.
        best, choices = np.zeros(capacity + 1), []
        for _ in range(layers):
            value = np.where(fits, best[at] + price, 0)
            choice = value.argmax(axis=1)
            more = value[np.arange(capacity + 1), choice]
            choices.append(np.where(more > best + 1e-12, choice, -1))
            if not (choices[-1] >= 0).any():
                break
            best = np.maximum(best, more)
        # No solution has fewer sequences than the present one divided by that value.
        total = amount.sum()
        if total - total / max(1.0, best[capacity]) <= max(0.5, NEAR * total):
            break
        column, c = np.zeros(n), capacity
        for choice in choices[::-1]:
            if choice[c] >= 0:
                column[choice[c]] += 1
                c -= sizes[choice[c]]
        change = inverse @ column
        up = change > 1e-9
        if not up.any():
            break
        ratio = np.where(up, amount / np.where(up, change, 1), np.inf)
        out = int(ratio.argmin())
        amount = amount - ratio[out] * change
        amount[out] = ratio[out]
        basis[:, out] = column
        row = inverse[out] / change[out]
        inverse -= np.outer(change, row)
        inverse[out] = row
    return [(float(x), basis[:, i].astype(int).tolist()) for i, x in enumerate(amount) if x > 1e-9]


def plan(histogram: dict[int, int], capacity: int, groups: int, large: float) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Where the pieces of each length go: (length, first rank, ranks, first sequence, offset, ranks in one sequence), and how many sequences there are."""
    placed: list[tuple[int, int, int, int, int, int]] = []
    rank: dict[int, int] = defaultdict(int)
    left = {s: n for s, n in sorted(histogram.items(), reverse=True) if n > 0}
    bins = 0

    def put(size: int, count: int, sequence: int, offset: int, stack: int = 1) -> None:
        placed.append((size, rank[size], count, sequence, offset, stack))
        rank[size] += count
        left[size] -= count

    if full := left.get(capacity, 0):
        put(capacity, full, 0, 0)
        bins = full
    free: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room -> [(first sequence, sequences)]
    big = [(s, n) for s, n in left.items() if large * capacity < s < capacity and n > 0]
    total = sum(n for _, n in big)
    if total:
        share = -(-total // groups)
        runs: list[list[tuple[int, int]]] = [[]]
        room = share
        for s, n in big:
            while n:
                k = min(n, room)
                runs[-1].append((s, k))
                n, room = n - k, room - k
                if not room:
                    runs.append([])
                    room = share
        merged: dict[int, list[tuple[int, int]]] = {}
        for r in runs:
            if r:
                merged.setdefault(r[0][0], []).extend(r)
        sizes = list(merged)
        queue = [list(merged[s]) for s in sizes]
        for amount, column in configurations(sizes, [sum(n for _, n in merged[s]) for s in sizes], capacity):
            many = int(amount + 1e-6)
            if not many:
                continue
            segments = [(bins, many, 0)]
            bins += many
            for i, times in enumerate(column):
                for _ in range(times):
                    after = []
                    for sequence, count, fill in segments:
                        while count and queue[i]:
                            s, n = queue[i][0]
                            k = min(count, n)
                            put(s, k, sequence, fill)
                            after.append((sequence, k, fill + s))
                            sequence, count = sequence + k, count - k
                            queue[i][0:1] = [(s, n - k)] if n > k else []
                        if count:
                            after.append((sequence, count, fill))
                    segments = after
            for sequence, count, fill in segments:
                free[capacity - fill].append((sequence, count))
    for s in list(left):
        while left[s]:
            fitting = [r for r in free if r >= s and free[r]]
            if not fitting:
                stack = min(capacity // s, left[s])
                count = left[s] // stack
                free[capacity].append((bins, count))
                bins += count
                fitting = [capacity]
            room = min(fitting)
            sequence, count = free[room].pop()
            stack = min(room // s, left[s])
            use = min(count, left[s] // stack)
            if use < count:
                free[room].append((sequence + use, count - use))
            put(s, use * stack, sequence, capacity - room, stack)
            free[room - stack * s].append((sequence, use))
    return placed, bins


def best_plan(histogram: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    least = -(-sum(s * n for s, n in histogram.items()) // capacity)
    best = plan(histogram, capacity, *SETTINGS[0])
    for setting in SETTINGS[1:]:
        if best[1] <= CLOSE * least:
            break
        best = min(best, plan(histogram, capacity, *setting), key=lambda p: p[1])
    return best


def place(pieces: DataFrame, capacity: int, buckets: int | None = None) -> DataFrame:
    """Add sequence_id and offset to pieces (a written table) that have a length."""
    buckets = buckets or min(max(BUCKETS[0], pieces.count() // PIECES), BUCKETS[1])
    # By place in the table, so that neither repeated rows nor rows without an id share a group.
    keyed = pieces.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")).withColumn("bucket", F.pmod(F.xxhash64("file", "row"), F.lit(buckets)).cast("int"))
    counts = keyed.groupBy("length", "bucket").count().toArrow()  # at most capacity * buckets rows
    base = np.zeros((capacity + 1, buckets + 1), np.int64)
    base[counts["length"].to_numpy(), counts["bucket"].to_numpy() + 1] = counts["count"].to_numpy()
    histogram = {s: int(base[s].sum()) for s in range(1, capacity + 1) if base[s].any()}
    base = np.cumsum(base, axis=1)
    rows, _ = best_plan(histogram, capacity)
    steps = np.array(sorted(rows) or [(0,) * 6], np.int64)
    # One sorted key for (length, rank): lengths are at most capacity and ranks below 2**48.
    keys = (steps[:, 0] << 48) | steps[:, 1]
    ranked = keyed.withColumn("rank", F.row_number().over(Window.partitionBy("length", "bucket").orderBy("file", "row")))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"
    names = pieces.columns

    def assign(batches):
        for batch in batches:
            length, bucket, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy().astype(np.int64) for c in ("length", "bucket", "rank"))
            at = base[length, bucket] + rank - 1
            step = np.searchsorted(keys, (length << 48) | at, side="right") - 1
            _, first, _, sequence, offset, stack = steps[step].T
            within = at - first
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in names), pa.array(sequence + within // stack), pa.array(offset + within % stack * length)], [*names, "sequence_id", "offset"])

    return ranked.select(*names, "bucket", "rank").mapInArrow(assign, schema)


def pack(docs: DataFrame, path: str, capacity: int = 1024, end: int = 2) -> DataFrame:
    """Pack all documents: a row per piece, with its sequence_id and its offset there."""
    return place(written(cut(docs, path, capacity, end), "pieces"), capacity)
