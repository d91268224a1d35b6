"""Token counts by source, language and tokenizer version, kept up by deltas.

A batch holds inserts, deletes and revised counts of documents. It is turned
into signed rows: an insert adds its count; a delete takes away what the ledger
has for the document; a revision does both. Signed rows are summed per group
before they are shuffled, and only these small sums are kept beside the ledger.
Totals are the sum of the deltas of all batches that are committed.

Commits form a log of numbered marker files. A commit reads the log, computes
its signed rows from the state there, and then puts the next marker in place,
which only one writer can do. One that comes too late, since another batch took
the number, computes its rows again from the new state: no delta ever stands on
a stale one. A batch whose name is in the log changes nothing; data of attempts
that failed have no marker, are never read, and are deleted by the attempt that
lost.

Every `every` commits the state is written as a whole: the ledger's last row of
each document and the totals. A commit reads the last state and the ledgers
since, so that its cost doesn't grow with the number of batches before.

Events of one batch about the same document and tokenizer are taken together:
the last by `seq` counts, of equals the largest by operation, count, source and
language. Deleting or revising a document that is not there counts as nothing or
as an insert. Inserting one that is there counts as a revision. A null count is
0; null sources and languages are groups of their own. Events without an id are
left out. An empty batch is committed and changes nothing; a rollup without
batches has no totals. Texts are counted whole. Other columns aren't read.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("source", "lang", "tokenizer")
LEDGER = "doc_id long, tokenizer string, source string, lang string, n_tokens long, seq long"
DELTA = "source string, lang string, tokenizer string, n_docs long, n_tokens long"


@dataclass(frozen=True)
class Commit:
    seq: int
    batch: str
    #: The name of its ledger and delta, and of the state that was written with it, if one was.
    data: str
    state: str


class Rollup:
    """Totals in a folder that all executors share."""

    def __init__(self, spark: SparkSession, folder: str, every: int = 16):
        self.spark, self.folder, self.every = spark, folder.rstrip("/"), every
        path = spark._jvm.org.apache.hadoop.fs.Path
        self.path = lambda *parts: path("/".join((self.folder, *parts)))
        self.fs = self.path("x").getFileSystem(spark._jsc.hadoopConfiguration())

    def log(self) -> list[Commit]:
        """All commits, in order."""
        place = self.path("commits")
        if not self.fs.exists(place):
            return []
        out = []
        for name in sorted(f.getPath().getName() for f in self.fs.listStatus(place)):
            stream = self.fs.open(self.path("commits", name))
            try:
                batch, data, state = stream.readUTF().split(" ")
            finally:
                stream.close()
            out.append(Commit(int(name), bytes.fromhex(batch).decode(), data, state.strip("-")))
        return out

    def _since(self, log: list[Commit], kind: str, schema: str) -> DataFrame:
        """Rows of a kind from the last whole state and all commits after it."""
        last = max((i for i, c in enumerate(log) if c.state), default=-1)
        paths = [f"{self.folder}/{kind}/{c.data}" for c in log[last + 1 :]] + ([f"{self.folder}/{kind}/{log[last].state}"] if last >= 0 else [])
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def commit(self, batch: str, events: DataFrame) -> bool:
        """Apply (doc_id, tokenizer, source, lang, op, n_tokens[, seq]); False if the batch was committed before."""
        order = F.col("seq") if "seq" in events.columns else F.lit(0)
        event = F.struct("source", "lang", "op", F.coalesce(F.col("n_tokens"), F.lit(0)).cast("long").alias("n_tokens"))
        last = F.max_by(event, F.struct(order, "op", "n_tokens", "source", "lang")).alias("e")
        new = events.filter("doc_id IS NOT NULL").groupBy("doc_id", "tokenizer").agg(last).select(F.col("doc_id").cast("long").alias("doc_id"), "tokenizer", "e.*")
        while True:
            log = self.log()
            if any(c.batch == batch for c in log):
                return False
            made = self._write(batch, new, log)
            if self._mark(made):
                return True
            for name in filter(None, (made.data, made.state)):
                for kind in ("ledger", "deltas"):
                    self.fs.delete(self.path(kind, name), True)

    def _write(self, batch: str, new: DataFrame, log: list[Commit]) -> Commit:
        """The ledger rows and the delta of a batch on top of the log's state."""
        seq, name = len(log) + 1, uuid.uuid4().hex
        if log:
            now = self._since(log, "ledger", LEDGER).groupBy("doc_id", "tokenizer").agg(F.max_by(F.struct("source", "lang", "n_tokens"), "seq").alias("o"))
            rows = new.join(now, ["doc_id", "tokenizer"], "left")
        else:
            rows = new.withColumn("o", F.lit(None).cast("struct<source:string,lang:string,n_tokens:long>"))
        # A ledger row with a null count stands for a document that was deleted.
        count = F.when(F.col("op") != "delete", F.col("n_tokens")).alias("n_tokens")
        old = F.when(F.col("o.n_tokens").isNotNull(), F.col("o")).alias("old")
        rows.select("doc_id", "tokenizer", "source", "lang", count, F.lit(seq).cast("long").alias("seq"), old).write.parquet(f"{self.folder}/ledger/{name}")
        own = self.spark.read.parquet(f"{self.folder}/ledger/{name}")
        plus = own.filter("n_tokens IS NOT NULL").select(*KEYS, F.lit(1).alias("n_docs"), "n_tokens")
        minus = own.filter("old IS NOT NULL").select("old.source", "old.lang", "tokenizer", F.lit(-1).alias("n_docs"), (-F.col("old.n_tokens")).alias("n_tokens"))
        summed(plus.union(minus)).write.parquet(f"{self.folder}/deltas/{name}")
        state = ""
        if seq % self.every == 0:
            state, whole = uuid.uuid4().hex, [*log, Commit(seq, batch, name, "")]
            rest = ("source", "lang", "n_tokens", "seq")
            ledger = self._since(whole, "ledger", LEDGER).groupBy("doc_id", "tokenizer").agg(F.max_by(F.struct(*rest), "seq").alias("x"))
            ledger.select("doc_id", "tokenizer", "x.*").filter("n_tokens IS NOT NULL").write.parquet(f"{self.folder}/ledger/{state}")
            summed(self._since(whole, "deltas", DELTA)).write.parquet(f"{self.folder}/deltas/{state}")
        return Commit(seq, batch, name, state)

    def _mark(self, made: Commit) -> bool:
        """Put a whole marker file in place, unless its number is taken."""
        marker, draft = self.path("commits", f"{made.seq:012d}"), self.path("drafts", uuid.uuid4().hex)
        stream = self.fs.create(draft, False)
        stream.writeUTF(f"{made.batch.encode().hex()} {made.data} {made.state or '-'}")
        stream.close()
        self.fs.mkdirs(self.path("commits"))
        jvm, gateway = self.spark._jvm, self.spark.sparkContext._gateway
        kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        options = gateway.new_array(kind, 1)
        options[0] = kind.NONE
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(marker.toUri(), self.spark._jsc.hadoopConfiguration()).rename(draft, marker, options)
        except Exception:
            if self.fs.exists(marker):
                self.fs.delete(draft, False)
                return False  # another batch has the number
            raise
        return True

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, n_docs, n_tokens; groups without documents are left out."""
        return summed(self._since(self.log(), "deltas", DELTA)).filter("n_docs <> 0 OR n_tokens <> 0")


def summed(deltas: DataFrame) -> DataFrame:
    return deltas.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))


#: Tokenizer versions that SQL can count: words between ASCII white space, and runs of letters, digits and non-ASCII characters.
PATTERNS = {"space-1": r"[^\x20\x09-\x0D]+", "alnum-1": r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"}


def counted(docs: DataFrame, text, op: str, seq: int = 0) -> DataFrame:
    """Events with the counts of every tokenizer version."""
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("tokenizer"), F.coalesce(F.regexp_count(text, F.lit(p)), F.lit(0)).cast("long").alias("n_tokens")) for n, p in PATTERNS.items()])).alias("t")
    return docs.select("doc_id", "source", "lang", F.lit(op).alias("op"), F.lit(seq).alias("seq"), each).select("doc_id", "source", "lang", "op", "seq", "t.*")


def union(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
