"""Quality classifier by co-training of two views.

One view is the text: hashed words and proportions of characters, repeated
windows and lines. The other is the page's metadata: source, language and
recorded length. Each has a logistic classifier. Over several rounds each
labels those unlabelled documents that it is surest of, in both classes, for
the other to learn from. Calibrated on labels that neither has seen, the two
are combined, and every document is scored on its whole text.

Fitting uses a bounded sample: of the documents labelled good, of those labelled
bad and of those without a label, up to POOL each, by the hash of their ids. A
third of a class is never crowded out by another, however few labels there are.
Scoring reads all documents.

Null texts are empty; null metadata, and metadata columns that aren't there, are
values of their own. A document whose labels conflict counts as unlabelled; of
rows that repeat an id one is in the sample, the least by the hash of its text.
Without five labels of each class the score is the share of good ones (0.5
without any label), nothing is rejected, and a warning says so. Rows keep their
number, empty tables give empty results, and repeated rows get equal scores.
Texts are read whole. Columns of the documents stay; where one has the name of a
result, the result's name gets an underscore.
"""

from __future__ import annotations

import warnings
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import arrow_schema, small_batches
from .textcore import U64, WORD, blocks, mix, windows

#: Most documents of each class, and without a class, in the sample that the classifiers are fitted on.
POOL = 2000
#: Buckets of hashed words; slots of hashed metadata values.
BUCKETS, SLOTS = 256, 48
ROUNDS, SURE, PER_ROUND = 5, 0.97, 200
#: Documents scored below are rejected.
REJECT = 0.35
DENSE = 14
_class = {k: np.zeros(256, bool) for k in ("symbol", "upper", "letter", "digit", "mark", "line", "pipe")}
_class["symbol"][list(b"#*$%&<>")] = _class["upper"][0x41:0x5B] = _class["digit"][0x30:0x3A] = _class["mark"][list(b"!?")] = _class["line"][10] = _class["pipe"][ord("|")] = True
_class["letter"][0x41:0x5B] = _class["letter"][0x61:0x7B] = _class["letter"][0x80:] = True


def text_view(column) -> np.ndarray:
    """Features of each text, one row each."""
    made = []
    for block in blocks(column):
        hashes, first, row = block.lower().words(WORD)
        n = np.diff(first).astype(float)
        some = np.maximum(n, 1)
        size = np.maximum(np.diff(block.offsets), 1).astype(float)
        share = {k: block.sums(m[block.bytes]) / size for k, m in _class.items()}
        own = mix(hashes ^ (row.astype(U64) * U64(0xD6E8FEB86659FD93)))
        _, once = np.unique(own, return_index=True)
        distinct = np.bincount(row[once], minlength=block.n)
        at, key = windows(hashes, first, 3)
        _, kept = np.unique(mix(key ^ (row[at].astype(U64) * U64(0xD6E8FEB86659FD93))), return_index=True)
        fresh = np.bincount(row[at[kept]], minlength=block.n)
        repeat = 1 - fresh / np.maximum(n - 2, 1)
        dense = np.stack([np.log1p(n) / 5, np.minimum(n, 50) / 50, size / some / 8, *(np.minimum(5 * s, 3) for s in share.values()), distinct / some, np.where(n > 2, repeat, 0), share["upper"] / np.maximum(share["letter"], 0.01), np.ones(block.n)], axis=1)
        words = np.zeros((block.n, BUCKETS))
        np.add.at(words, (row, (hashes >> U64(40)).astype(np.int64) % BUCKETS), 1.0)
        words = np.sqrt(words / some[:, None])
        made.append(np.concatenate((dense, words), axis=1))
    return np.concatenate(made) if made else np.zeros((0, DENSE + BUCKETS))


def page_view(source: list, lang: list, n_chars: list) -> np.ndarray:
    """Features of each page's metadata."""
    out = np.zeros((len(source), SLOTS + 1))
    out[:, SLOTS] = 1
    for i, values in enumerate(zip(source, lang, n_chars, strict=True)):
        length = -1 if values[2] is None else int(np.log2(max(1, values[2])))
        for name, v in zip("slc", (values[0], values[1], length), strict=True):
            out[i, zlib.crc32(f"{name}={v}".encode()) % SLOTS] += 1
    return out


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0, rounds: int = 12) -> np.ndarray:
    """Weighted logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (weight * np.maximum(p * (1 - p), 1e-4))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (weight * (y - p)) - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-5:
            break
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Model:
    text: np.ndarray
    page: np.ndarray
    #: Slope and intercept of each view's calibration, weights of the calibrated views with an intercept.
    calibration: list[np.ndarray]
    together: np.ndarray
    prior: float = 0.5
    usable: bool = True
    history: list[tuple[int, int]] = field(default_factory=list)

    def probabilities(self, text: np.ndarray, page: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.usable:
            p = np.full(len(text), self.prior)
            return p, p, p
        a, b = (c[0] * (x @ w) + c[1] for x, w, c in ((text, self.text, self.calibration[0]), (page, self.page, self.calibration[1])))
        return sigmoid(a), sigmoid(b), sigmoid(np.stack([a, b, np.ones(len(a))], axis=1) @ self.together)


def train(text: np.ndarray, page: np.ndarray, label: np.ndarray) -> Model:
    """Co-train on rows with labels 0, 1 or -1 for none. Every fifth labelled row is held back for calibration."""
    labelled = np.flatnonzero(label >= 0)
    y = label[labelled]
    if not len(labelled) or y.min() == y.max() or min((y == 0).sum(), (y == 1).sum()) < 5:
        return Model(np.zeros(text.shape[1]), np.zeros(page.shape[1]), [], np.zeros(3), float(y.mean()) if len(y) else 0.5, False)
    back = np.zeros(len(label), bool)
    for c in (0, 1):
        back[labelled[y == c][::5]] = True
    views, weights, history = (text, page), [np.zeros(0)] * 2, []
    own = [{int(i): (int(label[i]), 1.0) for i in labelled if not back[i]} for _ in views]
    free = set(np.flatnonzero(label < 0).tolist())
    for _ in range(ROUNDS):
        for v, x in enumerate(views):
            rows = list(own[v])
            weights[v] = logistic(x[rows], np.array([own[v][i][0] for i in rows], float), np.array([own[v][i][1] for i in rows]))
        rest = np.array(sorted(free), np.int64)
        told = [0, 0]
        for v, x in enumerate(views):
            if not len(rest):
                break
            # Scores are calibrated before they count as sure.
            a, b = platt(x[back] @ weights[v], label[back])
            p = sigmoid(a * (x[rest] @ weights[v]) + b)
            for c, sure in ((1, p), (0, 1 - p)):
                best = np.argsort(-sure, kind="stable")[:PER_ROUND]
                for i in rest[best[sure[best] >= SURE]].tolist():
                    if i not in own[1 - v]:
                        own[1 - v][i] = (c, 0.5)
                        told[v] += 1
        free -= {i for i in free if i in own[0] and i in own[1]}
        history.append((told[0], told[1]))
        if not any(told):
            break
    calibration = [platt(x[back] @ w, label[back]) for x, w in zip(views, weights, strict=True)]
    z = np.stack([*(c[0] * (x[back] @ w) + c[1] for x, w, c in zip(views, weights, calibration, strict=True)), np.ones(int(back.sum()))], axis=1)
    together = logistic(z, label[back].astype(float), np.ones(len(z)), 0.5)
    return Model(weights[0], weights[1], calibration, together, float(y.mean()), True, history)


def platt(score: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Slope and intercept that turn scores into log-odds."""
    good, bad = (label == 1).sum(), (label == 0).sum()
    soft = np.where(label == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    return logistic(np.stack([score, np.ones(len(score))], axis=1), soft, np.ones(len(score)), 0.01)


METADATA = {"source": "string", "lang": "string", "n_chars": "long"}


def metadata(docs: DataFrame) -> list:
    """The metadata columns, null where the documents have none of the name."""
    return [F.col(c).cast(t).alias(c) if c in docs.columns else F.lit(None).cast(t).alias(c) for c, t in METADATA.items()]


def fit(docs: DataFrame, labels: DataFrame, pool: int = POOL) -> Model:
    """Fit on a sample of at most `pool` documents of each class and `pool` without a label."""
    small_batches(docs.sparkSession)
    told = labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("lo"), F.max("quality").alias("hi"))
    known = told.select("doc_id", F.when(F.col("lo") == F.col("hi"), F.col("hi").cast("int")).otherwise(-1).alias("label"))
    ids = docs.filter("doc_id IS NOT NULL").select("doc_id").distinct().join(known, "doc_id", "left").fillna(-1, ["label"])
    first = lambda c: ids.filter(F.col("label") == c).orderBy(F.xxhash64("doc_id", F.lit(17)), "doc_id").limit(pool)
    chosen = first(0).union(first(1)).union(first(-1))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), *metadata(docs)).join(F.broadcast(chosen), "doc_id")
    rows = rows.withColumn("h", F.xxhash64("text", *METADATA))

    def run(batches):
        for batch in batches:
            t = text_view(batch.column(1)).astype(np.float32)
            p = page_view(*(batch.column(i).to_pylist() for i in (2, 3, 4))).astype(np.float32)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(5), batch.column(6), pa.array([x.tobytes() for x in t], pa.binary()), pa.array([x.tobytes() for x in p], pa.binary())], ["doc_id", "label", "h", "t", "p"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    seen = rows.mapInArrow(run, f"doc_id {kind}, label int, h long, t binary, p binary").groupBy("doc_id", "label").agg(F.min_by(F.struct("t", "p"), "h").alias("x")).select("doc_id", "label", "x.*")
    found = seen.orderBy("doc_id").limit(3 * pool).collect()
    stack = lambda c, n: np.stack([np.frombuffer(r[c], np.float32) for r in found]).astype(float) if found else np.zeros((0, n))
    model = train(stack("t", DENSE + BUCKETS), stack("p", SLOTS + 1), np.array([r.label for r in found], np.int64))
    if not model.usable:
        warnings.warn("co-training: fewer than five labels of a class; every document is kept", stacklevel=2)
    return model


NAMES = ("p_text", "p_page", "score", "kept")


def score(docs: DataFrame, model: Model, reject: float = REJECT, names: tuple[str, str, str, str] = NAMES) -> DataFrame:
    """All columns of docs, with both views' probabilities, the score and whether the document is kept."""
    small_batches(docs.sparkSession)
    there = set(docs.columns)
    for n in names:
        while n in there:
            n += "_"
        there.add(n)
    own = [n for n in there if n not in docs.columns]
    names = [next(x for x in own if x.rstrip("_") == n.rstrip("_")) for n in names]
    place = [docs.columns.index("text"), *(docs.columns.index(c) if c in docs.columns else None for c in METADATA)]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), *(f"`{n}` {t}" for n, t in zip(names, ("double", "double", "double", "boolean"), strict=True))])
    out = arrow_schema(schema)

    def run(batches):
        for batch in batches:
            text, *page = (pa.nulls(batch.num_rows) if i is None else batch.column(i) for i in place)
            a, b, s = model.probabilities(text_view(text), page_view(*(c.to_pylist() for c in page)))
            keep = s >= reject if model.usable else np.ones(len(s), bool)
            yield pa.RecordBatch.from_arrays([*(c.cast(f.type) for c, f in zip(batch.columns, out, strict=False)), pa.array(a), pa.array(b), pa.array(s), pa.array(keep)], schema=out)

    return docs.mapInArrow(run, schema)
