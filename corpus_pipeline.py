"""A training corpus from `documents`, in five stages.

Documents that the quality classifier rejects go, then those that fail the
quality rules; one document of each group of near-duplicates stays; personal
data are masked; what is left is packed into sequences. Each stage but the last
returns the columns of its input, whatever these are named.

Of a group of near-duplicates the row with the smallest id stays, one without an
id only where none has one; of rows that repeat that id, the one with the
smallest hash. Texts without words are in no group and go with the quality rules
anyway. A null text stays null until packing, where it is an empty document.
Empty tables pass through all stages; texts are read whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm import co_training, lsh_forest, packing, pii, quality_rules
from tessera.llm.frames import table, written
from tessera.llm.queries import tokenizer_file

#: Columns of the result's decisions, named so that they don't clash with a document's own.
OWN = "_tessera_"


def narrow(docs: DataFrame) -> DataFrame:
    """doc_id, text, and all other columns as one."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.col("text").isNull().alias(OWN + "null"), F.struct(*rest, F.lit(0).alias(OWN)).alias(OWN + "rest"))


def wide(rows: DataFrame, docs: DataFrame, **changed) -> DataFrame:
    """The columns of docs again."""
    own = {"doc_id": F.col("doc_id"), "text": F.when(~F.col(OWN + "null"), F.col("text"))}
    return rows.select(*[changed.get(c, own.get(c, F.col(f"{OWN}rest.`{c}`"))).alias(c) for c in docs.columns])


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = co_training.fit(docs, table(spark, sf_dir, "labels"))
    names = tuple(OWN + n for n in co_training.NAMES)
    return co_training.score(docs, model, names=names).filter(F.col(names[3])).select(*[F.col(f"`{c}`") for c in docs.columns])


def quality_rule_ledger(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(quality_rules.ledger(narrow(docs), OWN + "null", OWN + "rest", keep_text=True))
    return wide(judged.filter("kept"), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = written(lsh_forest.groups(docs, percent=80).filter("group IS NOT NULL").select("group", "doc_id", "at"), "groups")
    first = found.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "at")).alias("m")).select("group", F.col("m.at").alias("stays"))
    few = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 4)
    gone = written(found.join(first, "group").filter("at <> stays").select("at").distinct().coalesce(few), "gone")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.select(*columns, F.xxhash64("doc_id", F.col("text").cast("string")).alias(OWN + "at"))
    rest = lambda df, other: df.join(other.withColumnRenamed("at", OWN + "at"), OWN + "at", "left_anti")
    repeated = written(rest(found.groupBy(F.col("at").alias(OWN + "at")).count().filter("count > 1").select(OWN + "at"), gone).coalesce(few), "repeated")
    kept = rest(keyed, gone)
    if not repeated.isEmpty():
        # Only rows that repeat an id and a text are dealt out by them: of each, the one whose columns hash lowest stays.
        place = Window.partitionBy(OWN + "at").orderBy(F.xxhash64(*columns))
        once = keyed.join(repeated, OWN + "at", "left_semi").withColumn(OWN + "n", F.row_number().over(place)).filter(F.col(OWN + "n") == 1).drop(OWN + "n")
        kept = kept.join(repeated, OWN + "at", "left_anti").select(*columns, OWN + "at").unionByName(once.select(*columns, OWN + "at"))
    return kept.select(*columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = pii.find(narrow(docs), f"masked string, {OWN}new boolean", lambda text, base, spans: (pii.masked(text, spans), bool(spans)), OWN + "null", OWN + "rest")
    changed = {"text": F.when(~F.col(OWN + "null"), F.col("masked"))}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(F.col(OWN + "new") & F.col(f"{OWN}rest.n_chars").isNotNull(), F.char_length("masked").cast(kind)).otherwise(F.col(f"{OWN}rest.n_chars"))
    return wide(found, docs, **changed)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_file()).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rule_ledger),
    ("near duplicates", near_duplicates),
    ("personal data", personal_data),
    ("best-fit packing", best_fit_packing),
]

#: Signatures, classifiers and packing are not expressible in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the folder's documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
