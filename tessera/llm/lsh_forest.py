"""Near-duplicate documents by an LSH forest over MinHash signatures.

A document's set is its distinct shingles of five words; documents with fewer
words have their whole sequence as one shingle. Documents with equal sets are
one node. A signature has 128 minima; the forest's trees are 16 sorted orders
of the signatures, each beginning at another minimum. In an order, nodes whose
signatures share a prefix of four minima form a region. Small regions compare
all their signatures; in a crowded one, each node is compared with its
neighbours in the order, which are those with the longest common prefixes, so
that the depth adapts to the region. Pairs whose signatures agree well enough
are candidates.

Candidates are confirmed on full sets: first each node's best one, then a few
of each component whose nodes are not connected by then, so that the links of a
crowded group stay in proportion to it. These only order the work: at last every
region with nodes of several components compares all of their signatures, and
each well-agreeing pair that could join two components is confirmed or refused
on full sets. Components are computed over the confirmed links.

Shingles are compared as hashes of 56 bits: sets are equal up to collisions of
these (two sets of a thousand shingles share a false one with a chance of
about 10 ** -11), nothing else is approximate about a confirmed link.

Nodes have numbers of their own, so that ids may be anything. Null texts and
texts without words have an empty set: they are linked with nothing. Rows with
equal texts are linked. A row without an id is linked like any other and links
others, but a component's id is the smallest of those there are (null if there
is none), and the row isn't kept. Rows that repeat an id are rows of their own:
each gets the component of its own text, and is kept if that component's id is
its id. An empty table gives an empty result; columns other than doc_id and
text aren't read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .frames import documents, forget, per_block, written
from .textcore import U64, WORD, Block, mix

WORDS = 5
MINIMA, TREES, DEPTH = 128, 16, 4
STEP = MINIMA // TREES
# SMALL, BEST, HUBS, FURTHER and REGION only choose which pairs are confirmed first; left_apart() compares all the others.
#: Signatures compared with one another at once; in crowded regions half of them stay for the next.
REGION = 1024
#: Regions in which every pair may be a candidate.
SMALL = 24
#: Nodes of a block: larger regions are compared block against block, each two blocks in a group of their own.
BLOCK = 512
#: Candidates of a node by agreement, and nodes with the most candidates that keep all of theirs, in a crowded region.
BEST, HUBS = 3, 8
#: Further candidates of a component that each node's best one leaves apart, drawn by hash: more than join it only cost time.
FURTHER = 8
_random = np.random.Generator(np.random.PCG64(20240607))
FACTORS = _random.integers(0, 1 << 63, MINIMA, dtype=np.uint64) * U64(2) + U64(1)


def shingles(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of all texts in the block, sorted within each text, and where each text's begin. A shingle has 56 bits."""
    hashes, first, row = block.lower().words(WORD)
    count = np.diff(first)
    size = np.minimum(count, WORDS)
    many = np.maximum(count - WORDS + 1, (count > 0).astype(np.int64))
    owner = np.repeat(np.arange(block.n), many)
    start = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many) + first[:-1][owner]
    key = np.zeros(len(owner), U64)
    for k in range(WORDS):
        if len(key):
            more = k < size[owner]
            key = np.where(more, mix(key + hashes[np.minimum(start + k, len(hashes) - 1)] + U64(k + 1)), key)
    key = np.sort((owner.astype(U64) << U64(56)) | (key >> U64(8)))
    key = key[np.concatenate(([True], key[1:] != key[:-1]))] if len(key) else key
    return key & U64((1 << 56) - 1), np.searchsorted(key >> U64(56), np.arange(block.n + 1))


def signatures(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The minima of each non-empty set: sixteen bits of each, big-endian."""
    full = at[:-1][np.diff(at) > 0]
    out = np.zeros((len(full), MINIMA), ">u2")
    mixed = mix(values)
    for i, factor in enumerate(FACTORS):
        out[:, i] = (np.minimum.reduceat(mixed * factor, full) & U64(0xFFFF)) if len(full) else 0
    return out


def located(docs: DataFrame) -> DataFrame:
    """doc_id, text and at, a hash of both."""
    return documents(docs, F.xxhash64("doc_id", "text").alias("at"))


def signed(docs: DataFrame) -> DataFrame:
    """doc_id, a hash of the row that finds it again (at), n_shingles, a 128-bit key of the set, and the signature."""

    def work(block, rows):
        values, at = shingles(block)
        n = np.diff(at)
        full = n > 0
        k1, k2 = np.zeros(block.n, np.int64), np.zeros(block.n, np.int64)
        if full.any():
            k1[full] = np.add.reduceat(mix(values), at[:-1][full]).view(np.int64)
            k2[full] = np.add.reduceat(mix(values ^ U64(0xA5A5A5A5A5A5A5A5)), at[:-1][full]).view(np.int64)
        data = signatures(values, at).tobytes()
        parts = iter(range(0, len(data), 2 * MINIMA))
        return {"doc_id": rows.column(0), "at": rows.column(2), "n_shingles": n, "k1": k1, "k2": k2, "signature": pa.array([data[(p := next(parts)) : p + 2 * MINIMA] if x else None for x in full.tolist()], pa.binary())}

    return per_block(located(docs), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, at long, n_shingles long, k1 long, k2 long, signature binary", work)


def choose(names: np.ndarray, sig: np.ndarray, new: int, least: int) -> tuple[list, list, list]:
    """Candidate pairs among signatures, of which those from `new` on have not been compared with one another or the ones before."""
    n = len(names)
    agree = np.zeros((n, n), np.int16)
    for j in range(max(1, new), n):
        agree[j, :j] = (sig[:j] == sig[j]).sum(axis=1)
    left, right = np.nonzero(agree >= least)
    score = agree[left, right]
    if n > SMALL and len(left) > BEST * n:
        keep = np.zeros(len(left), bool)
        for x in (left, right):  # the best of each node, on either side
            order = np.lexsort((-score, x))
            rank = np.arange(len(order)) - np.searchsorted(x[order], x[order])
            keep[order[rank < BEST]] = True
        open_ = np.ones(len(left), bool)
        for _ in range(HUBS):
            degree = np.bincount(left[open_], minlength=n) + np.bincount(right[open_], minlength=n)
            hub = int(degree.argmax())
            if degree[hub] <= BEST:
                break
            own = (left == hub) | (right == hub)
            keep |= own
            open_ &= ~own
        left, right, score = left[keep], right[keep], score[keep]
    return names[left].tolist(), names[right].tolist(), score.tolist()


def pairs_in_regions(sorted_rows: DataFrame, least: int) -> DataFrame:
    """Candidate pairs of rows (tree, order, node) that are sorted within partitions."""

    def run(batches):
        held_key, names, sigs, new = None, [], [], 0

        def flush(keep: int):
            nonlocal names, sigs, new
            if len(names) > 1:
                a, b, s = choose(np.array(names, np.int64), np.frombuffer(b"".join(sigs), ">u2").reshape(-1, MINIMA), new, least)
                if a:
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(s, pa.int32())], ["a", "b", "agree"])
            names, sigs = names[len(names) - keep :] if keep else [], sigs[len(sigs) - keep :] if keep else []
            new = keep

        for batch in batches:
            for tree, order, node in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                key = (tree, order[: 2 * DEPTH])
                if key != held_key:
                    yield from flush(0)
                    held_key = key
                elif len(names) >= REGION:
                    yield from flush(REGION // 2)
                names.append(node)
                sigs.append(order)
        yield from flush(0)

    return sorted_rows.mapInArrow(run, "a long, b long, agree int")


def least_agreement(similarity: float) -> int:
    """Minima in which a pair at the threshold agrees, but for 4.6 standard deviations."""
    return int(MINIMA * similarity - 4.6 * (MINIMA * similarity * (1 - similarity)) ** 0.5)


def orders(nodes: DataFrame) -> DataFrame:
    """(tree, order, node, n): the turned signatures of nodes (node, signature) in each tree where they share a region, which has n nodes."""
    trees = nodes.select("node", F.explode(F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)), lambda t: F.struct(t.alias("tree"), F.substring(F.col("signature"), t * (2 * STEP) + 1, F.lit(2 * DEPTH)).alias("region")))).alias("t")).select("node", "t.tree", "t.region")
    shared = trees.groupBy("tree", "region").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    live = trees.join(shared, ["tree", "region"]).groupBy("node").agg(F.collect_list(F.struct("tree", "n")).alias("trees"))
    turned = F.concat(F.substring(F.col("signature"), F.col("tree") * (2 * STEP) + 1, F.lit(2 * MINIMA)), F.substring(F.col("signature"), F.lit(1), F.col("tree") * (2 * STEP)))
    return nodes.join(live, "node").select("node", "signature", F.explode("trees").alias("t")).select("node", "signature", "t.tree", "t.n").select("tree", turned.alias("order"), "node", "n")


def candidates(rows: DataFrame, similarity: float) -> DataFrame:
    """Distinct pairs (a, b, agree), a < b, of nodes that are neighbours in an order and agree well: those to confirm first."""
    spark, least = rows.sparkSession, least_agreement(similarity)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    # A partition ends between regions; only crowded ones are cut.
    cut = lambda c: F.when(F.col("n") > REGION, F.col(c))
    ordered = rows.repartitionByRange(parts, F.col("tree"), F.substring("order", 1, 2 * DEPTH), cut("order"), cut("node")).sortWithinPartitions("tree", "order", "node")
    found = pairs_in_regions(ordered.select("tree", "order", "node"), least)
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "agree").groupBy("a", "b").agg(F.max("agree").alias("agree"))


#: Least and most bits of the filter that tells which rows' sets are needed. It has eight for each such row, up to 64 MB: with more rows it lets more others pass, which only costs time.
FILTER_BITS = (1 << 20, 1 << 29)
#: Bits of the filter that are built, and sent to the driver, as one value.
CHUNK = 1 << 17


def filter_of(wanted: DataFrame, column: str) -> np.ndarray:
    """A bitmap of the hashes in a column of whole numbers. Each chunk of it is built in one place and sent once."""
    n = wanted.count()
    bits = min(max(FILTER_BITS[0], 1 << (8 * n).bit_length()), FILTER_BITS[1])
    place = wanted.select(F.col(column).bitwiseAND(F.lit(bits - 1)).alias("h")).distinct().withColumn("chunk", F.floor(F.col("h") / CHUNK))

    def build(batches):
        chunks: dict[int, np.ndarray] = {}
        for batch in batches:
            h, chunk = (c.to_numpy() for c in batch.columns)
            for k in np.unique(chunk).tolist():
                own = chunks.setdefault(k, np.zeros(CHUNK, bool))
                own[h[chunk == k] % CHUNK] = True
            if len(chunks) > 64:
                yield told(chunks)
                chunks.clear()
        yield told(chunks)

    def told(chunks):
        return pa.RecordBatch.from_arrays([pa.array(list(chunks), pa.int64()), pa.array([np.packbits(x, bitorder="little").tobytes() for x in chunks.values()], pa.binary())], ["chunk", "bits"])

    out = np.zeros(bits // 8, np.uint8)
    for row in place.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(build, "chunk long, bits binary").toLocalIterator():
        first = row.chunk * (CHUNK // 8)
        out[first : first + CHUNK // 8] |= np.frombuffer(row.bits, np.uint8)
    return out


def sets_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, set) of the rows that `nodes` (node, at) names; a set has eight bytes for each shingle, in order."""
    found = filter_of(nodes, "at")
    wanted = docs.sparkSession.sparkContext.broadcast(found)
    last = np.int64(8 * len(found) - 1)

    def work(block, rows):
        h = np.array(rows.column(2).to_numpy(zero_copy_only=False), np.int64) & last
        take = np.flatnonzero((wanted.value[h >> 3] >> (h & 7).astype(np.uint8)) & 1)
        if not len(take):
            return {"at": pa.array([], pa.int64()), "set": pa.array([], pa.binary())}
        values, at = shingles(block)
        packed = values.astype("<u8").tobytes()
        return {"at": rows.column(2).take(take), "set": pa.array([packed[8 * at[i] : 8 * at[i + 1]] for i in take.tolist()], pa.binary())}

    made = per_block(located(docs), "at long, set binary", work)
    return made.join(nodes, "at").select("node", "set").dropDuplicates(["node"])


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u8")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sets' intersection is at least `percent` hundredths of their union."""
    first = pairs.select("a", "b").join(sets.select(F.col("node").alias("a"), F.col("set").alias("x")), "a")
    both = first.join(sets.select(F.col("node").alias("b"), F.col("set").alias("y")), "b").select("a", "b", "x", "y")

    def run(batches):
        for batch in batches:
            keep = []
            for i in range(batch.num_rows):
                x, y = unpacked(batch.column(2)[i].as_py()), unpacked(batch.column(3)[i].as_py())
                small, large = min(len(x), len(y)), max(len(x), len(y))
                ok = 100 * small >= percent * large
                if ok:
                    both = np.sort(np.concatenate((x, y)))
                    common = int((both[1:] == both[:-1]).sum())
                    ok = 100 * common >= percent * (len(x) + len(y) - common)
                keep.append(ok)
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def agreeing(tree: int, sig: np.ndarray, root: np.ndarray, block: np.ndarray, least: int):
    """Each row of a group, sorted by root, with those rows after it of other roots that agree well and share no region of an earlier tree. With two blocks, only rows of different blocks."""
    n, two = len(sig), block.min() < block.max()
    ends = np.searchsorted(root, root, side="right")
    shifts = [(t - tree) * STEP % MINIMA for t in range(tree)]
    earlier = np.stack([np.ascontiguousarray(sig[:, k : k + DEPTH]).view(U64)[:, 0] for k in shifts], axis=1) if tree else np.zeros((n, 0), U64)
    for i in range(n):
        lo = int(ends[i])
        if lo == n:
            break
        rest = lo + np.flatnonzero(block[lo:] != block[i]) if two else slice(lo, n)
        same = (sig[rest] == sig[i]).view(U64).sum(axis=1)
        j = np.flatnonzero((same * U64(0x0101010101010101)) >> U64(56) >= least)
        j = rest[j] if two else lo + j
        if len(j):
            j = j[~(earlier[j] == earlier[i]).any(axis=1)]
        if len(j):
            yield i, j


def open_nodes(tree: int, node: np.ndarray, sig: np.ndarray, root: np.ndarray, block: np.ndarray, sets: None, least: int, percent: int) -> tuple[list, list]:
    """The tree and the node of all rows in pairs that may still join two components."""
    hit = np.zeros(len(node), bool)
    for i, j in agreeing(tree, sig, root, block, least):
        hit[i] = True
        hit[j] = True
    return [tree] * int(hit.sum()), node[hit].tolist()


def joining_links(tree: int, node: np.ndarray, sig: np.ndarray, root: np.ndarray, block: np.ndarray, sets: list[bytes], least: int, percent: int) -> tuple[list, list]:
    """Confirmed links that join components: of all well-agreeing pairs whose roots differ, one way through each."""
    now, left, right = root.copy(), [], []
    size = np.array([len(s) for s in sets]) // 8
    own = lambda i: unpacked(sets[i])
    for i, j in agreeing(tree, sig, root, block, least):
        j = j[(now[j] != now[i]) & (100 * np.minimum(size[j], size[i]) >= percent * np.maximum(size[j], size[i]))]
        x = own(i)
        for k in range(0, len(j), 64):
            part = j[k : k + 64]
            part = part[now[part] != now[i]]
            if not len(part):
                continue
            y = np.concatenate([own(b) for b in part.tolist()])
            found = x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y
            common = np.add.reduceat(found.astype(np.int64), np.cumsum(size[part]) - size[part])
            for b in part[100 * common >= percent * (size[i] + size[part] - common)].tolist():
                if now[b] != now[i]:
                    now[now == now[b]] = now[i]
                    left.append(int(node[i]))
                    right.append(int(node[b]))
    return left, right


def in_regions(rows: DataFrame, work, names: tuple[str, str], similarity: float, percent: int) -> DataFrame:
    """Distinct pairs of numbers that `work` finds among the rows (tree, order, node, root, perhaps set) of each region with more than one root."""
    least, parts = least_agreement(similarity), max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    region = F.substring("order", 1, 2 * DEPTH).alias("region")
    mixed = rows.groupBy("tree", region).agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.count(F.lit(1)).alias("n")).filter("r0 < r1").select("tree", "region", F.ceil(F.col("n") / BLOCK).alias("blocks"))
    dealt = rows.withColumn("region", region).join(mixed, ["tree", "region"]).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).withColumn("pair", F.least("block", "other") * F.col("blocks") + F.greatest("block", "other"))
    dealt = dealt.repartition(parts, "tree", "region", "pair").sortWithinPartitions("tree", "region", "pair", "root", "node")
    has_sets = "set" in rows.columns

    def run(batches):
        key, held = None, []

        def flush():
            if len(held) > 1:
                _, order, node, root, _, block, sets = zip(*held, strict=True)
                sig = np.frombuffer(b"".join(order), ">u2").astype(np.uint16).reshape(-1, MINIMA)
                a, b = work(key[0], np.array(node, np.int64), sig, np.array(root, np.int64), np.array(block, np.int64), sets if has_sets else None, least, percent)
                if a:
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], list(names))
            held.clear()

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for row in zip(*columns, *[] if has_sets else [[None] * batch.num_rows], strict=True):
                if (row[0], row[1][: 2 * DEPTH], row[4]) != key:
                    yield from flush()
                    key = row[0], row[1][: 2 * DEPTH], row[4]
                held.append(row)
        yield from flush()

    return dealt.select("tree", "order", "node", "root", "pair", "block", *["set"] * has_sets).mapInArrow(run, f"{names[0]} long, {names[1]} long").distinct()


def left_apart(docs: DataFrame, rows: DataFrame, roots: DataFrame, sets: DataFrame, places: DataFrame, percent: int) -> DataFrame | None:
    """Links (a, b) that join components, from all well-agreeing pairs in a shared region whose nodes' roots differ."""
    placed = rows.join(roots, "node", "left").select("tree", "order", "node", F.coalesce("component", "node").alias("root"))
    flagged = written(in_regions(placed, open_nodes, ("tree", "node"), percent / 100, percent), "open")
    if flagged.isEmpty():
        return None
    lacking = written(flagged.select("node").distinct().join(sets, "node", "left_anti").join(places, "node"), "lacking")
    if not lacking.isEmpty():
        sets = sets.union(sets_of(docs, lacking))
    chosen = placed.join(flagged.withColumn("tree", F.col("tree").cast("int")), ["tree", "node"], "left_semi").join(sets, "node").select("tree", "order", "node", "root", "set")
    return written(in_regions(chosen, joining_links, ("a", "b"), percent / 100, percent), "joining")


def best_of(pairs: DataFrame, *keys: str) -> DataFrame:
    """Distinct pairs (a, b) that agree best among those of some key."""
    most = pairs.groupBy(*keys).agg(F.max(F.struct("agree", -F.col("a"), -F.col("b"))).alias("m"))
    return most.select((-F.col("m.col2")).alias("a"), (-F.col("m.col3")).alias("b")).distinct()


def grown(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Links (a, b) of the components so far, one for each node, and those that join them."""
    return roots.filter("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b")).union(links.select("a", "b"))


def linked(docs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(node, component) of nodes (node, at, signature) that are linked with others."""
    spark, places, held = docs.sparkSession, nodes.select("node", "at"), []

    def keep(df: DataFrame, name: str) -> DataFrame:
        held.append(written(df, name))
        return held[-1]

    # Tables of a few numbers a node need fewer files than there are partitions.
    few = lambda df: df.coalesce(max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 4))

    rows = keep(orders(nodes.select("node", "signature")), "orders")
    pairs = keep(candidates(rows, percent / 100), "candidates")
    sets = keep(sets_of(docs, keep(few(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(places, "node")), "wanted")), "sets")
    # Each node's best candidate comes first, then a few of each component that is apart from others by then.
    best = keep(few(best_of(pairs.select(F.explode(F.array("a", "b")).alias("node"), "a", "b", "agree"), "node")), "best")
    roots = components(keep(confirmed(best, sets, percent), "confirmed"))
    root = lambda side: roots.select(F.col("node").alias(side), F.col("component").alias(f"root_{side}"))
    split = pairs.join(root("a"), "a", "left").join(root("b"), "b", "left").withColumns({"root_a": F.coalesce("root_a", "a"), "root_b": F.coalesce("root_b", "b")})
    apart = split.filter("root_a <> root_b").join(best, ["a", "b"], "left_anti")
    ends = apart.select(F.explode(F.array("root_a", "root_b")).alias("root"), F.pmod(F.xxhash64("a", "b"), F.lit(FURTHER)).alias("draw"), "a", "b", "agree")
    more = keep(confirmed(keep(few(best_of(ends, "root", "draw")), "further"), sets, percent), "confirmed")
    if not more.isEmpty():
        roots = components(grown(roots, more))
    # All other pairs are compared where their nodes are still apart.
    rest = left_apart(docs, rows, roots, sets, places, percent)
    if rest is not None and not rest.isEmpty():
        roots = components(grown(roots, rest))
    for df in held:
        forget(df)
    return roots


def groups(docs: DataFrame, percent: int = 85) -> DataFrame:
    """doc_id, at (a hash of the row), n_shingles, group (a number for each component; null for empty sets) and component_id for every document."""
    small = written(signed(docs), "signatures")
    sets = small.filter("n_shingles > 0").groupBy("k1", "k2").agg(F.min("doc_id").alias("own"), F.min("at").alias("at"), F.first("signature").alias("signature"))
    # The numbers are fixed by being written.
    nodes = written(sets.withColumn("node", F.monotonically_increasing_id()), "nodes")
    roots = linked(docs, nodes.select("node", "at", "signature"), percent)
    named = nodes.select("k1", "k2", "node", "own").join(roots, "node", "left")
    ids = named.filter("component IS NOT NULL").groupBy("component").agg(F.min("own").alias("least"))
    named = named.join(ids, "component", "left").select("k1", "k2", F.coalesce("component", "node").alias("group"), F.when(F.col("component").isNull(), F.col("own")).otherwise(F.col("least")).alias("least"))
    joined = small.select("doc_id", "at", "n_shingles", "k1", "k2").join(named, ["k1", "k2"], "left")
    full = F.col("n_shingles") > 0
    return joined.select("doc_id", "at", "n_shingles", F.when(full, F.col("group")).alias("group"), F.when(full, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"))


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every document."""
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept")
    return groups(docs, percent).select("doc_id", "n_shingles", "component_id", kept)
