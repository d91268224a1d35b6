"""Scoring documents with a bigram model held in Elias-Fano tries.

Documents are handled in parts (runs of neighbouring rows of a file, of a
bounded number of tokens). What a part needs of the corpus it asks of shards, by
its distinct words and pairs with their training counts:

1. Words go to shards by their hash, which add the counts up and answer.
2. Words that are so frequent that a shard should not hold all that follows them
   (at most 1 / HEAVY of all tokens each, so never more than HEAVY words) are
   told to everybody with their counts.
3. Pairs go to shards by their context; those of a frequent context by a part of
   their word too. A shard adds the counts up, so it knows how often a context
   occurs and how many words follow it, and builds a trie of smoothed
   probabilities in a memory-mapped file of its task's own. It looks every
   distinct pair up there by successor search, and answers each part with a byte
   for a pair and one for a context.
4. The parts score their documents.

What is sent follows the input; no count is left out, and the model is never
gathered in one place. The number of shards follows the tokens.

Probabilities are interpolated with absolute discounting,

    p(w | v) = max(c(v, w) - D, 0) / c(v) + D t(v) / c(v) * p(w),

where t(v) is the number of different successors of v and p(w) the additive
base. The first term and the weight of the second are what tries hold, each as a
byte (255 levels, a step of an eighth). A probability is never above 1. A context
without training counts leaves p(w).

A null text counts as empty: its only token is the end. A null id counts as
the empty text for the choice of the training part, and falls to held_out.
Repeated rows are documents of their own and count as often. Texts are read
whole; parts end between documents, so that a very long text is a part of its
own. An empty table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import os
import tempfile
import zlib

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .elias_fano import LEVELS, BigramTrie
from .frames import small_batches, written
from .textcore import U64, WORD, blocks, mix

#: Rows of a file that share a block, tokens in a part.
ROWS, TOKENS = 4096, 1_500_000
#: A word that makes more than one in so many tokens is a frequent context.
HEAVY = 2048
#: Tokens that a shard is made for, and bytes of a table's files.
SHARD_TOKENS, SHARD_BYTES = 4_000_000, 16 << 20
DISCOUNT, ADDED = 0.75, 0.1
BEGIN, END = U64(0x517CC1B727220A95), U64(0x2545F4914F6CDD1D)
UNANSWERED = "block long, place long, kind int, shard int, doc_id {id}, text string, payload binary"


def held_out(ids: list, folds: int) -> np.ndarray:
    return np.array([zlib.crc32(b"" if i is None else str(i).encode()) % folds == 0 for i in ids], bool)


class Part:
    """Tokens of some documents, each word with the one before it."""

    def __init__(self):
        self.tokens, self.before, self.owner, self.train = [], [], [], []
        self.ids, self.held, self.n, self.start = [], [], 0, None

    def add(self, column, ids: list, held: np.ndarray) -> None:
        row = len(self.ids)
        for block in blocks(column):
            hashes, first, owner = block.lower().words(WORD)
            count = np.diff(first) + 1
            ends = np.cumsum(count) - 1
            token = np.empty(int(count.sum()), U64)
            word = np.ones(len(token), bool)
            word[ends] = False
            token[word], token[ends] = hashes, END
            before = np.roll(token, 1)
            before[ends - count + 1] = BEGIN
            own = np.repeat(np.arange(block.n), count)
            self.tokens.append(token)
            self.before.append(before)
            self.owner.append(own + row + block.first)
            self.train.append(~held[own + block.first])
            self.n += len(token)
        self.ids += ids
        self.held += held.tolist()

    def close(self, shards: int, heavy: np.ndarray | None = None) -> None:
        """Number the distinct words, and where the frequent contexts are known the pairs, in order of their shards."""
        join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
        token, before = join(self.tokens, U64), join(self.before, U64)
        self.own, self.training = join(self.owner, np.int64), join(self.train, bool)
        self.words, index = np.unique(np.concatenate((token, before)), return_inverse=True)
        self.token, self.context = index[: len(token)], index[len(token) :]
        bits = max(1, int(len(self.words)).bit_length())
        self.bits = bits
        home = mix(self.words ^ U64(13)) % U64(shards)
        self.word_order = np.argsort(home, kind="stable")
        self.word_edges = np.searchsorted(home[self.word_order], np.arange(shards + 1))
        if heavy is None:
            return
        self.frequent = np.isin(self.words, heavy)
        shard = (mix(before ^ U64(7)) + np.where(self.frequent[self.context], mix(token ^ U64(11)), U64(0))) % U64(shards)
        key = (shard << U64(2 * bits)) | (self.context.astype(U64) << U64(bits)) | self.token.astype(U64)
        self.pairs, self.pair = np.unique(key, return_inverse=True)
        self.pair_edges = np.searchsorted(self.pairs >> U64(2 * bits), np.arange(shards + 1))

    def pair_words(self) -> tuple[np.ndarray, np.ndarray]:
        """Context and word of each distinct pair, by number."""
        low = U64((1 << self.bits) - 1)
        return ((self.pairs >> U64(self.bits)) & low).astype(np.int64), (self.pairs & low).astype(np.int64)

    def pair_requests(self):
        """(shard, payload) of the distinct pairs and their training counts."""
        count = np.bincount(self.pair, self.training, len(self.pairs)).astype(np.uint32)
        context, word = self.pair_words()
        for s, (a, b) in enumerate(zip(self.pair_edges[:-1], self.pair_edges[1:], strict=True)):
            if a < b:
                first = firsts(context[a:b])
                yield s, pack(self.words[context[a:b][first]], np.diff(np.append(first, b - a)).astype(np.uint32), six(self.words[word[a:b]]), count[a:b])

    def word_requests(self):
        count = np.bincount(self.token, self.training, len(self.words)).astype(np.uint32)
        for s, (a, b) in enumerate(zip(self.word_edges[:-1], self.word_edges[1:], strict=True)):
            if a < b:
                own = self.word_order[a:b]
                yield s, pack(self.words[own], count[own])


def firsts(x: np.ndarray) -> np.ndarray:
    """Places where another value begins."""
    return np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1]))) if len(x) else np.zeros(0, np.int64)


def six(hashes: np.ndarray) -> np.ndarray:
    """The upper six bytes of each hash."""
    return np.ascontiguousarray(np.ascontiguousarray(hashes.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, 2:]).ravel()


def from_six(data: np.ndarray) -> np.ndarray:
    raw = np.zeros((len(data) // 6, 8), np.uint8)
    raw[:, 2:] = data.reshape(-1, 6)
    return raw.view("<u8").ravel()


def pack(*arrays: np.ndarray) -> bytes:
    return np.array([a.nbytes for a in arrays], np.int64).tobytes() + b"".join(a.tobytes() for a in arrays)


def unpack(data: bytes, *kinds) -> list[np.ndarray]:
    sizes = np.frombuffer(data, np.int64, len(kinds))
    ends = np.cumsum(sizes) + 8 * len(kinds)
    return [np.frombuffer(data[e - s : e], k) for k, s, e in zip(kinds, sizes.tolist(), ends.tolist(), strict=True)]


def placed(docs: DataFrame) -> DataFrame:
    """doc_id, text, block and place of every row: where it stands in its file, so the same however often it is read."""
    own = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    try:
        rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"))
    except AnalysisException:
        rows = written(own, "documents").select("doc_id", "text", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"))
    return rows.select(F.xxhash64("file", F.floor(F.col("place") / ROWS)).alias("block"), "place", "doc_id", "text")


def requests(rows: DataFrame, shards: int, folds: int, heavy: np.ndarray | None = None) -> DataFrame:
    """(shard, block, place, payload): the words that each part asks for; the pairs, where the frequent contexts are given."""

    def run(batches):
        part, block = Part(), None

        def flush():
            nonlocal part
            if part.ids:
                part.close(shards, heavy)
                asked = list(part.word_requests() if heavy is None else part.pair_requests())
                for i in range(0, len(asked), 64):
                    some = asked[i : i + 64]
                    yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in some], pa.int32()), pa.array([block] * len(some), pa.int64()), pa.array([part.start] * len(some), pa.int64()), pa.array([p for _, p in some], pa.binary())], ["shard", "block", "place", "payload"])
            part = Part()

        for batch in batches:
            keys = batch.column(0).to_numpy()
            cut = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            for a, b in zip(cut, cut[1:], strict=False):
                if a == b:
                    continue
                if part.ids and (keys[a] != block or part.n >= TOKENS):
                    yield from flush()
                block = int(keys[a])
                if part.start is None:
                    part.start = batch.column(1)[a].as_py()
                ids = batch.column(2).slice(a, b - a).to_pylist()
                part.add(batch.column(3).slice(a, b - a), ids, held_out(ids, folds))
        yield from flush()

    return rows.mapInArrow(run, "shard int, block long, place long, payload binary")


def by_shard(rows: DataFrame, shards: int, work, schema: str) -> DataFrame:
    """work(shard, payload rows) for each shard."""
    from .frames import arrow_schema

    out = arrow_schema(schema)

    def run(batches):
        held, shard = [], None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[0] != shard and held:
                    for made in work(shard, held):
                        yield pa.RecordBatch.from_pylist([made], schema=out)
                    held = []
                shard = row[0]
                held.append(row)
        if held:
            for made in work(shard, held):
                yield pa.RecordBatch.from_pylist([made], schema=out)

    return rows.repartitionById(shards, "shard").sortWithinPartitions("shard").mapInArrow(run, schema)


ANSWER = "block long, place long, shard int, payload binary, tokens long, types long"


def answer_pairs(heavy: np.ndarray, counts: np.ndarray):
    def work(shard, rows):
        """Add up the training counts of a shard's pairs, build its trie in a file, and look every distinct pair up in it."""
        asked = [unpack(r[3], U64, np.uint32, np.uint8, np.uint32) for r in rows]
        context = np.concatenate([np.repeat(c, n) for c, n, _, _ in asked])
        word = np.concatenate([from_six(w) for _, _, w, _ in asked])
        order = np.lexsort((word, context))
        context, word = context[order], word[order]
        new = np.ones(len(order), bool)
        new[1:] = (context[1:] != context[:-1]) | (word[1:] != word[:-1])
        first = np.flatnonzero(new)
        context, word = context[first], word[first]
        count = np.add.reduceat(np.concatenate([k for *_, k in asked])[order].astype(np.int64), first)
        seen = count > 0
        c, k = context[seen], count[seen]
        begin = firsts(c)
        size = np.diff(np.append(begin, len(c)))
        total = np.add.reduceat(k, begin) if len(c) else np.zeros(0, np.int64)
        # Of a frequent context this shard has a part; its count is known, its weight is told later.
        at = np.minimum(np.searchsorted(heavy, c[begin]), max(len(heavy) - 1, 0))
        known = heavy[at] == c[begin] if len(heavy) else np.zeros(len(begin), bool)
        total = np.where(known, counts[at], total) if len(heavy) else total
        with tempfile.TemporaryDirectory() as place:
            path = os.path.join(place, "trie")
            BigramTrie.save(BigramTrie.build(c >> U64(1), word[seen] >> U64(1), np.maximum(k - DISCOUNT, 0) / np.repeat(total, size), DISCOUNT * size / total), path)
            trie = BigramTrie.open(path)
            found, weight = trie.find((context >> U64(1)).astype(np.int64), (word >> U64(1)).astype(np.int64))
            del trie
        many = np.diff(np.append(first, len(order)))
        codes, weights = np.empty(len(order), np.uint8), np.empty(len(order), np.uint8)
        codes[order], weights[order] = np.repeat(found, many), np.repeat(weight, many)
        at = 0
        for r, (_, n, _, k) in zip(rows, asked, strict=True):
            yield {"block": r[1], "place": r[2], "shard": shard, "payload": pack(codes[at : at + len(k)], weights[at : at + len(k)][np.cumsum(n) - n])}
            at += len(k)
        if known.any():
            yield {"shard": shard, "payload": pack(c[begin][known], size[known].astype(np.int64))}

    return work


def answer_words(shard, rows):
    """Training counts of a shard's words; the totals of the shard."""
    asked = [unpack(r[3], U64, np.uint32) for r in rows]
    words, inverse = np.unique(np.concatenate([w for w, _ in asked]), return_inverse=True)
    count = np.bincount(inverse, np.concatenate([k for _, k in asked]), len(words)).astype(np.int64)
    for r, (own, _) in zip(rows, asked, strict=True):
        yield {"block": r[1], "place": r[2], "shard": shard, "payload": pack(count[np.searchsorted(words, own)])}
    total = int(count.sum())
    # Which words are frequent in all depends on all; those that could be are among the shard's HEAVY largest.
    top = np.argsort(-count, kind="stable")[:HEAVY]
    yield {"shard": shard, "tokens": total, "types": int((count > 0).sum()), "payload": pack(words[top], count[top])}


def frequent(totals: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Words that make more than 1 / HEAVY of n tokens, in order, and their counts: at most HEAVY of them."""

    def pick(batches):
        for batch in batches:
            for payload in batch.column(0).to_pylist():
                words, counts = unpack(payload, U64, np.int64)
                much = counts * HEAVY > n
                yield pa.RecordBatch.from_arrays([pa.array(words[much].view(np.int64)), pa.array(counts[much])], ["word", "n"])

    found = totals.select("payload").mapInArrow(pick, "word long, n long").toArrow()
    words, counts = (found[c].to_numpy().astype(np.int64) for c in ("word", "n"))
    order = np.argsort(words.view(U64))
    return words.view(U64)[order], counts[order]


def followers(pairs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Frequent contexts, in order, and how many words follow each: sums over the shards, one row for a context."""

    def read(batches):
        for batch in batches:
            for payload in batch.column(0).to_pylist():
                words, types = unpack(payload, U64, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(types)], ["word", "n"])

    found = pairs.filter("block IS NULL").select("payload").mapInArrow(read, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).toArrow()
    words, types = (found[c].to_numpy().astype(np.int64) for c in ("word", "n"))
    order = np.argsort(words.view(U64))
    return words.view(U64)[order], types[order]


def score(docs: DataFrame, folds: int = 10) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    spark = docs.sparkSession
    small_batches(spark)
    least = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = placed(docs)
    files = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))  # of a scan of files
    homes = max(least, min(-(-files // SHARD_BYTES), 100_000))
    words = written(by_shard(requests(rows, homes, folds), homes, answer_words, ANSWER), "words")
    totals = words.filter("block IS NULL")
    total = totals.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("types"), F.lit(0))).first()
    n, v = int(total[0]), int(total[1])
    heavy, heavy_counts = frequent(totals, n)
    # The beginning is no token: it occurs once for each training document, as the end does, whose count it has.
    if END in heavy:
        at = int(np.searchsorted(heavy, BEGIN))
        heavy, heavy_counts = np.insert(heavy, at, BEGIN), np.insert(heavy_counts, at, heavy_counts[np.searchsorted(heavy, END)])
    shards = max(least, -(-n // SHARD_TOKENS))
    pairs = written(by_shard(requests(rows, shards, folds, heavy), shards, answer_pairs(heavy, heavy_counts), ANSWER), "pairs")
    split, types = followers(pairs)
    kind = docs.schema["doc_id"].dataType.simpleString()
    none = lambda t: F.lit(None).cast(t)
    answers = lambda df, k: df.filter("block IS NOT NULL").select("block", "place", F.lit(k).alias("kind"), "shard", none(kind).alias("doc_id"), none("string").alias("text"), "payload")
    everything = answers(pairs, 0).union(answers(words, 1)).union(rows.select("block", "place", F.lit(2), none("int"), "doc_id", "text", none("binary")))
    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"

    def finish(part: Part, told: dict):
        part.close(homes)
        count = np.zeros(len(part.words), np.int64)
        for s in range(homes):
            a, b = part.word_edges[s : s + 2]
            if a < b:
                (count[part.word_order[a:b]],) = unpack(told[1, s], np.int64)
        part.close(shards, heavy)
        code, weight = np.zeros(len(part.pairs), np.uint8), np.zeros(len(part.words), np.uint8)
        context, _ = part.pair_words()
        for s in range(shards):
            a, b = part.pair_edges[s : s + 2]
            if a < b:
                code[a:b], own = unpack(told[0, s], np.uint8, np.uint8)
                own_context = context[a:b]
                weight[own_context[firsts(own_context)]] = own
        base = (count[part.token] + ADDED) / (n + ADDED * (v + 1))
        before = count.copy()
        before[np.searchsorted(part.words, BEGIN)] = count[np.searchsorted(part.words, END)]
        share = LEVELS[weight]
        if len(split):
            at = np.minimum(np.searchsorted(split, part.words), len(split) - 1)
            much = split[at] == part.words
            share[much] = DISCOUNT * types[at[much]] / before[much]
        known = before[part.context] > 0
        chance = np.where(known, np.minimum(LEVELS[code[part.pair]] + share[part.context] * base, 1.0), base)
        rows, own = len(part.ids), part.own
        add = lambda x: np.bincount(own, x, rows)
        return [part.ids, part.held, np.bincount(own, minlength=rows), add(count[part.token] > 0).astype(np.int64), np.full(rows, n), add(np.log10(base)), add(np.log10(chance))]

    from .frames import arrow_schema

    out = arrow_schema(schema)

    def run(batches):
        part, block, told, starts = Part(), None, {}, []

        def flush():
            nonlocal part
            if part.ids:
                made = finish(part, told[part.start])
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(made, out, strict=True)], schema=out)
            part = Part()

        for batch in batches:
            key, place, sort = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            i = 0
            while i < len(key):
                if key[i] != block:
                    yield from flush()
                    block, told, starts = key[i], {}, None
                if sort[i] < 2:
                    told.setdefault(int(place[i]), {})[int(sort[i]), batch.column(3)[i].as_py()] = batch.column(6)[i].as_py()
                    i += 1
                    continue
                if starts is None:
                    starts = np.array(sorted(told))
                if place[i] in told:
                    yield from flush()
                    part.start = int(place[i])
                k = int(np.searchsorted(starts, place[i], side="right"))
                limit = starts[k] if k < len(starts) else 1 << 62
                j = i
                while j < len(key) and key[j] == block and place[j] < limit:
                    j += 1
                ids = batch.column(4).slice(i, j - i).to_pylist()
                part.add(batch.column(5).slice(i, j - i), ids, held_out(ids, folds))
                i = j
        yield from flush()

    return everything.repartition(max(least, homes), "block").sortWithinPartitions("block", "kind", "place").mapInArrow(run, schema)
