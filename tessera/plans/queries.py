"""The reference operators over the driver's tables, each with SQL that must give the same rows.

The tables stand in for claims: an order's lines are annotators' claims about
an item, in order of (line number, part, supplier, price); a conversation's
turns are free-text answers; l_suppkey % 3 is the annotator of a graph.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geometry, text
from ..operators import agreement, decisions, evidence, graphs, labels, seals, votes
from ..session import materialized
from ..sources import normalize, tasks
from . import sql as q

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str = "") -> Callable:
    def add(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _spread(df: DataFrame) -> DataFrame:
    """The rows over all cores, where a table of few splits would leave most of them idle. Splits are more than groups of rows, so that four for each core may still be few."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(2 * cores) if df.rdd.getNumPartitions() < 4 * cores else df


def _claims(spark: SparkSession, d: str) -> DataFrame:
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return _table(spark, d, "lineitem").withColumn("item", F.col("l_orderkey")).withColumn("model", F.row_number().over(order))


CLAIMS = """
    c AS (SELECT l_orderkey AS item, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
        l_extendedprice) AS model, *
      FROM lineitem)
"""


def _turns(spark: SparkSession, d: str) -> DataFrame:
    return _spread(_table(spark, d, "conversations")).select(F.col("conv_id").alias("item"), F.col("turn").alias("model"), "role", "text")


TURNS = "c AS (SELECT conv_id AS item, turn AS model, role, text FROM conversations)"

# ---- votes


def _vote(value: str) -> str:
    return f"""
        WITH {CLAIMS}, t AS (SELECT item, {value} AS value, count(*) AS n, min(model) AS f
          FROM c
          GROUP BY ALL),
        r AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY n DESC, f) AS k, sum(n) OVER (PARTITION BY item) AS total
          FROM t)
        SELECT item, value, n AS votes, CAST(total AS BIGINT) AS total, round(n / total, 4) AS ratio
        FROM r
        WHERE k = 1
    """


@query(_vote("l_returnflag"))
def vote_majority(spark, d):
    return votes.majority(_claims(spark, d).withColumn("value", F.col("l_returnflag")), ["item"], "value", "model")


@query(_vote("CAST(l_quantity AS INTEGER)"))
def vote_majority_int(spark, d):
    return votes.majority(_claims(spark, d).withColumn("value", F.col("l_quantity").cast("int")), ["item"], "value", "model")


@query(f"""
    WITH {CLAIMS}, t AS (SELECT item, l_returnflag AS value, count(*) AS n, min(model) AS f
      FROM c
      GROUP BY ALL)
    SELECT item, arg_min(value, (-n, f)) AS value
    FROM t
    GROUP BY item
""".replace("arg_min(value, (-n, f))", "first(value ORDER BY n DESC, f)"))
def vote_modal_array(spark, d):
    listed = F.transform(F.array_sort(F.collect_list(F.struct("model", "l_returnflag"))), lambda x: x.l_returnflag)
    return _claims(spark, d).groupBy("item").agg(votes.first_modal(listed).alias("value"))


@query("SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL")
def vote_histogram(spark, d):
    return votes.histogram(_table(spark, d, "events"), ["user_id"], "event_type")


@query("""
    SELECT CASE o_orderstatus WHEN 'F' THEN 'accepted' WHEN 'O' THEN 'review' ELSE 'failed' END AS decision, count(*) AS n
    FROM orders
    GROUP BY ALL
""")
def run_stats(spark, d):
    from .consensus import run_stats as stats

    return stats(_table(spark, d,
            "orders").select(F.when(F.col("o_orderstatus") == "F", "accepted").when(F.col("o_orderstatus") == "O",
                "review").otherwise("failed").alias("decision")))


@query("""
    SELECT l_orderkey AS item, count(l_quantity) AS n,
    round(CASE WHEN count(*) = 1 THEN 0.5 WHEN max(l_quantity) = 0 THEN 1.0
      ELSE 1 - (max(l_quantity) - min(l_quantity)) / max(l_quantity) END,
      4) AS similarity
    FROM lineitem
    GROUP BY 1
""")
def range_similarity(spark, d):
    return votes.range_similarity(_claims(spark, d), ["item"], "l_quantity")


@query(f"""
    WITH {CLAIMS}, t AS (SELECT item, l_returnflag || l_linestatus AS value, min(model) AS f
      FROM c
      GROUP BY ALL)
    SELECT item, CAST(row_number() OVER (PARTITION BY item ORDER BY f) AS INTEGER) AS position, value
    FROM t
""")
def ordered_distinct(spark, d):
    return votes.ordered_distinct(_claims(spark, d).withColumn("value", F.concat("l_returnflag", "l_linestatus")), ["item"], "value", "model")


@query("""
    SELECT l_orderkey AS item, count(DISTINCT l_suppkey % 3) AS models,
    CAST(CASE WHEN count(DISTINCT l_suppkey % 3) <= 2 THEN count(DISTINCT l_suppkey % 3)
      ELSE ceil(2 * count(DISTINCT l_suppkey % 3) / 3) END
      AS INTEGER) AS needed
    FROM lineitem
    GROUP BY 1
""")
def support_needed(spark, d):
    return _table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("item")).agg(
        F.count_distinct(F.col("l_suppkey") % 3).alias("models")).withColumn("needed", votes.support_needed(F.col("models")))


# ---- agreement of texts

_FIRST = "regexp_extract(text, '^[^\\n]*')"
PREP = f"p AS (SELECT item, model, role, text, {q.prepared('text', 'x')} FROM c), x AS (SELECT *, {q.more('x')} FROM p)"
PAIR = "FROM x a JOIN x b ON a.item = b.item AND a.model < b.model GROUP BY a.item"
SIDES = f"""
    s AS (SELECT a.item, {', '.join(f'a.x_{c} AS a_{c}, b.x_{c} AS b_{c}' for c in ('form', 'compact', 'bare', 'bf', 'grams', 'words'))}
      FROM x a
      JOIN x b ON a.item = b.item AND a.model < b.model)
"""


def _means(scores: dict[str, str]) -> str:
    each = ", ".join(f"avg({e}) AS {n}" for n, e in scores.items())
    out = ", ".join(f"round(coalesce({n}, 0.5), 4) AS {n}" for n in scores)
    return f"""
        WITH {TURNS}, {PREP}, {SIDES}, m AS (SELECT item, {each}
          FROM s
          GROUP BY item)
        SELECT k.item, n_rows, {out}
        FROM (SELECT item, count(*) AS n_rows
          FROM c
          GROUP BY item) k
        LEFT JOIN m ON k.item = m.item
    """


def _pairwise(spark: SparkSession, d: str, scores: dict[str, Callable]) -> DataFrame:
    rows = _turns(spark, d).select("item", "model", text.prepared(F.col("text")).alias("x"))
    return votes.pairwise_mean(rows, ["item"], "model", {n: (lambda l, r, f=f: f(l("x"), r("x"))) for n, f in scores.items()}, ["x"])  # noqa: E741


@query(_means({"chars": q.text_sim("a", "b"), "keywords": q.keyword_sim("a", "b"), "field": q.blanks("a", "b", q.text_sim("a", "b")),
            "exact": q.blanks("a", "b", "CASE WHEN a_form = b_form THEN 1.0 ELSE 0.0 END")}))
def pairwise_text(spark, d):
    return _pairwise(spark, d, {"chars": text.text_similarity, "keywords": text.keyword_similarity, "field": text.field_similarity, "exact": text.field_match})


@query(_means({"phrase": q.phrase_sim("a", "b"), "title": q.title_sim("a", "b", "a", "b"), "aligned": q.align_sim("a", "b")}))
def pairwise_phrase(spark, d):
    return _pairwise(spark, d, {"phrase": text.phrase_similarity, "title": lambda a, b: text.title_similarity(a, b, a, b), "aligned": text.alignment_score})


LISTS = f"""
    e AS (SELECT item, model, unnest(l) AS t, generate_subscripts(l, 1) AS p
      FROM (SELECT item, model, string_split(text, chr(10)) AS l FROM c)),
    o AS (SELECT item, model, first(t ORDER BY p) AS t, min(p) AS p
      FROM e
      WHERE {q.form('t')} <> ''
      GROUP BY item, model, {q.form('t')}),
    pp AS (SELECT item, model, p, {q.prepared('t', 'x')}
      FROM o),
    x AS (SELECT *, {q.more('x')}
      FROM pp),
    z AS (SELECT c.item, c.model, count(x.p) AS n
      FROM c
      LEFT JOIN x ON c.item = x.item AND c.model = x.model
      GROUP BY ALL)
"""
MET = f"""
    m AS (SELECT a.item, a.model AS am, b.model AS bm, a.p AS ap, b.p AS bp,
      {', '.join(f'a.x_{c} AS a_{c}, b.x_{c} AS b_{c}' for c in ('form', 'compact', 'grams', 'words'))}
      FROM x a
      JOIN x b ON a.item = b.item AND a.model < b.model),
    g AS (SELECT item, am, bm, ap, bp, {q.phrase_sim('a', 'b')} AS s
      FROM m),
    l AS (SELECT item, am, bm, avg(s) AS s
      FROM (SELECT item, am, bm, ap, max(s) AS s FROM g GROUP BY ALL)
      GROUP BY ALL),
    r AS (SELECT item, am, bm, avg(s) AS s
      FROM (SELECT item, am, bm, bp, max(s) AS s FROM g GROUP BY ALL)
      GROUP BY ALL)
"""


@query(f"""
    WITH {TURNS}, {LISTS}, {MET}, w AS (SELECT a.item,
      CASE WHEN a.n = 0 AND b.n = 0 THEN 0.5 WHEN a.n = 0 OR b.n = 0 THEN 0.0 ELSE (l.s + r.s) / 2 END AS s
      FROM z a
      JOIN z b ON a.item = b.item AND a.model < b.model
      LEFT JOIN l ON l.item = a.item AND l.am = a.model AND l.bm = b.model
      LEFT JOIN r ON r.item = a.item AND r.am = a.model AND r.bm = b.model)
    SELECT k.item, round(coalesce(v.s, 0.5), 4) AS overlap
    FROM (SELECT DISTINCT item
      FROM c) k
    LEFT JOIN (SELECT item, avg(s) AS s
      FROM w
      GROUP BY item) v ON k.item = v.item
""")
def list_overlap(spark, d):
    rows = _turns(spark, d).withColumn("texts", F.split("text", "\n"))
    return agreement.list_overlap(rows, ["item"], "model", "texts").select("item", F.round("overlap", 4).alias("overlap"))


@query(f"""
    WITH {TURNS}, f AS (SELECT item, role, model, {q.vote_form('text')} AS v
      FROM c),
    g AS (SELECT *, {q.grams('v')} AS gr
      FROM f
      WHERE v <> ''),
    s AS (SELECT a.item, a.role, avg(CASE WHEN a.v = b.v THEN 1.0 ELSE {q.jaccard('a.gr', 'b.gr', 1.0)} END) AS s
      FROM g a
      JOIN g b ON a.item = b.item AND a.role = b.role AND a.model < b.model
      GROUP BY ALL)
    SELECT k.item, k.role, coalesce(round(s.s, 4), 1.0) AS text_consistency
    FROM (SELECT DISTINCT item, role
      FROM c) k
    LEFT JOIN s ON k.item = s.item AND k.role = s.role
""")
def text_consistency(spark, d):
    return graphs.consistency(_turns(spark, d), ["item", "role"])


@query(f"""
    WITH {TURNS}, l AS (SELECT item, trim(unnest(string_split(text, chr(10))), ' ') AS t
      FROM c),
    f AS (SELECT item, {q.strip('t')} AS t
      FROM l),
    v AS (SELECT item, t, {q.vote_form('t')} AS form, {q.visible('t')} AS v
      FROM f
      WHERE t <> ''),
    g AS (SELECT item, form, count(*) AS n, max(v) AS v, max(length(t)) AS len, first(t ORDER BY v DESC, length(t) DESC, t DESC) AS best
      FROM v
      GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY n DESC, v DESC, len DESC, form) AS k
      FROM g)
    SELECT item, best AS representative_text
    FROM r
    WHERE k = 1
""")
def representative_text(spark, d):
    return graphs.representative(_turns(spark, d).select("item", F.explode(F.split("text", "\n")).alias("text")), ["item"])


SHAPE = "CASE l_returnflag WHEN 'A' THEN 'rectangle' WHEN 'N' THEN 'unknown' ELSE 'diamond' END"


def _shape() -> Column:
    return F.when(F.col("l_returnflag") == "A", "rectangle").when(F.col("l_returnflag") == "N", "unknown").otherwise("diamond")


@query(f"""
    WITH s AS (SELECT l_orderkey AS item, {SHAPE} AS shape, count(*) AS n
      FROM lineitem
      GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY n DESC, shape = 'unknown', shape) AS k
      FROM s)
    SELECT item, shape AS representative_shape
    FROM r
    WHERE k = 1
""")
def representative_shape(spark, d):
    return graphs.representative_shape(_claims(spark, d).withColumn("shape", _shape()), ["item"])


_STRUCT = f"""
    WITH {TURNS}, k AS (SELECT item, model, {q.strip('text')} AS text, role
      FROM c), {PREP.replace('FROM c', 'FROM k')}, {SIDES}, m AS (SELECT item, avg({q.text_sim('a', 'b')}) AS s
      FROM s
      GROUP BY item)
    SELECT t.item, 'text' AS majority_kind, round((0.6 + 0.4 * coalesce(m.s, 0.5)) * CASE WHEN e THEN 0.6 ELSE 1.0 END,
      4) AS structure_agreement
    FROM (SELECT item, bool_or(text = '') AS e
      FROM k
      GROUP BY item) t
    LEFT JOIN m ON t.item = m.item
"""


@query(_STRUCT)
def structure_agreement(spark, d):
    return agreement.structure_agreement(_turns(spark, d).select("item", "model", F.lit("text").alias("kind"),
            F.col("text").alias("content"))).withColumn("structure_agreement", F.round("structure_agreement", 4))


@query("""
    WITH s AS (SELECT l_orderkey AS item, (l_returnflag = 'R')::INT AS stamp, l_tax * 10 AS t, l_discount * 10 AS c, l_quantity / 50 AS x,
      l_linenumber / 10 AS seal, l_partkey, l_linenumber, l_suppkey
      FROM lineitem)
    SELECT item, l_linenumber, l_partkey, l_suppkey,
    round(CASE WHEN stamp = 1 THEN 0.3 * t + 0.7 * seal ELSE 0.3 * t + 0.3 * c + 0.4 * x END, 3) AS overall,
    round(0.35 * x + 0.30 * c + 0.25 * t + 0.10 * (1 - seal), 3) AS accept
    FROM s
""")
def overall_scores(spark, d):
    s = _table(spark, d, "lineitem").select(F.col("l_orderkey").alias("item"), "l_linenumber", "l_partkey", "l_suppkey",
        (F.col("l_returnflag") == "R").alias("stamp"), (F.col("l_tax") * 10).alias("t"), (F.col("l_discount") * 10).alias("c"),
        (F.col("l_quantity") / 50).alias("x"), (F.col("l_linenumber") / 10).alias("seal"))
    return s.select("item", "l_linenumber", "l_partkey", "l_suppkey",
        F.round(decisions.overall(F.col("stamp"), F.col("t"), F.col("c"), F.col("x"), F.col("seal")), 3).alias("overall"),
        F.round(decisions.accept_score(F.col("x"), F.col("c"), F.col("t"), F.col("seal")), 3).alias("accept"))


# ---- evidence


def _pool_sql(source: str, keys: str, least: int = 1) -> str:
    return f"""
        (SELECT {keys}, CAST(row_number() OVER (PARTITION BY {keys} ORDER BY o, s) AS INTEGER) AS position, t AS text, s AS squash
          FROM (SELECT {keys}, s, min(o) AS o, first(t ORDER BY o, t) AS t FROM (SELECT {keys}, o, {q.strip('t')} AS t,
              {q.squash('t')} AS s FROM {source} WHERE length({q.compact('t')}) >= {least}) GROUP BY {keys}, s))
    """


TURN_LINES = f"""
    WITH {TURNS}, e AS (SELECT item, role, model * 100000 + generate_subscripts(l, 1) - 1 AS o, unnest(l) AS t
      FROM (SELECT item, model, role, string_split(text, chr(10)) AS l FROM c))
"""


def _turn_lines(spark: SparkSession, d: str) -> DataFrame:
    return _turns(spark, d).select("item", "role", "model", F.posexplode(F.split("text", "\n")).alias("p", "text")).select("item", "role",
        (F.col("model") * 100000 + F.col("p")).alias("position"), "text")


@query(f"{TURN_LINES} SELECT * FROM {_pool_sql('e', 'item')}")
def evidence_pool(spark, d):
    return evidence.pool(_turn_lines(spark, d), ["item"])


@query(f"{TURN_LINES} SELECT item, role, position, text, squash FROM {_pool_sql('e', 'item, role')}")
def role_pools(spark, d):
    return evidence.role_pools(_turn_lines(spark, d), ["item"])


_EV = f"{q.squash('text')} AS x_squash, {q.compact('text')} AS x_compact"
MATCHES = f"""
    {TURN_LINES}, cl AS {_pool_sql('(SELECT * FROM e WHERE role = $$assistant$$)', 'item', 2)},
    ev AS {_pool_sql('(SELECT * FROM e WHERE role = $$user$$)', 'item')}, cp AS (SELECT *, {_EV}, {q.words('lower(text)')} AS x_words
      FROM cl),
    ep AS (SELECT *, {_EV}, {q.words('lower(text)')} AS x_words
      FROM ev),
    ca AS (SELECT *, {q.grams('x_squash')} AS x_grams
      FROM cp),
    ea AS (SELECT *, {q.grams('x_squash')} AS x_grams
      FROM ep),
    j AS (SELECT a.item, a.position, a.text, b.position AS place, b.text AS other,
      {', '.join(f'a.x_{c} AS a_{c}, b.x_{c} AS b_{c}' for c in ('squash', 'compact', 'grams', 'words'))}
      FROM ca a
      LEFT JOIN ea b ON a.item = b.item),
    s AS (SELECT item, position, text, place, other, coalesce({q.evidence_sim('a', 'b')}, 0.0) AS s
      FROM j),
    r AS (SELECT *, row_number() OVER (PARTITION BY item, position ORDER BY s DESC, place) AS k
      FROM s),
    best AS (SELECT item, position, text, CASE WHEN s > 0 THEN other END AS best_text, round(s, 4) AS similarity
      FROM r
      WHERE k = 1)
"""


def _matches(spark: SparkSession, d: str) -> DataFrame:
    rows = _turn_lines(spark, d)
    side = lambda role, least: evidence.pool(rows.filter(F.col("role") == role), ["item"], least=least)
    return evidence.best_matches(side("assistant", 2).drop("squash"), side("user", 1), ["item"])


@query(f"{MATCHES} SELECT * FROM best")
def evidence_match(spark, d):
    return _matches(spark, d)


@query(f"""
    {MATCHES}, n AS (SELECT item, count(*) AS n, count_if(similarity >= 0.65) AS k
      FROM best
      GROUP BY item)
    SELECT t.item, coalesce(n, 0) AS candidates, coalesce(k, 0) AS supported,
    CASE WHEN n IS NULL THEN 0.5 ELSE round(k / n, 4) END AS evidence_score,
    CASE WHEN n IS NULL THEN 0.0 ELSE round((n - k) / n, 4) END AS hallucination_risk
    FROM (SELECT DISTINCT item
      FROM c) t
    LEFT JOIN n ON t.item = n.item
""")
def evidence_scores(spark, d):
    return evidence.evidence_scores(_turns(spark, d), _matches(spark, d), ["item"])


ROLE = "CASE l_returnflag WHEN 'A' THEN 'seal' WHEN 'N' THEN 'watermark' ELSE 'footer' END"


@query(f"""
    SELECT l_orderkey AS item, lower(l_linestatus || CAST(l_linenumber AS VARCHAR)) AS squash,
    array_to_string(list_sort(list_distinct(list({ROLE}))), ',') AS roles
    FROM lineitem
    GROUP BY 1, 2
    HAVING bool_or({ROLE} = 'seal') AND count(DISTINCT {ROLE}) > 1
""")
def role_conflicts(spark, d):
    regions = _table(spark, d, "lineitem").select(F.col("l_orderkey").alias("item"),
        F.when(F.col("l_returnflag") == "A", "seal").when(F.col("l_returnflag") == "N", "watermark").otherwise("footer").alias("role"),
        F.concat("l_linestatus", F.col("l_linenumber").cast("string")).alias("text"))
    return evidence.role_conflicts(regions, ["item"]).withColumn("roles", F.array_join("roles", ","))


@query(f"""
    WITH s AS (SELECT doc_id, length({q.strip('text')}) AS n, (n_chars % 100) / 100 AS t, (n_chars % 89) / 89 AS u,
      length({q.compact('source')}) >= 4 AS sp
      FROM documents)
    SELECT doc_id, round(greatest(0.0, 1 - CASE WHEN n > 400 THEN 0.15 ELSE 0 END - CASE WHEN n > 800 THEN 0.2 ELSE 0 END - CASE
        WHEN t < 0.65 THEN 0.2 ELSE 0 END - CASE WHEN sp AND u < 0.65 THEN 0.15 ELSE 0 END), 4)::DOUBLE AS caption_score,
    (n > 400)::INT + (t < 0.65)::INT + (sp AND u < 0.65)::INT AS n_warnings, (n > 800)::INT AS n_errors
    FROM s
""")
def caption_check(spark, d):
    rows = _table(spark, d, "documents").select("doc_id", F.col("text").alias("caption"), F.col("source").alias("subject"),
        ((F.col("n_chars") % 100) / 100).alias("title_similarity"), ((F.col("n_chars") % 89) / 89).alias("subject_similarity"))
    return evidence.caption_check(rows).select("doc_id", "caption_score", F.size("caption_warnings").alias("n_warnings"),
        F.size("caption_errors").alias("n_errors"))


_L = "list_filter(list_transform(" + q.lines(q.strip("text")) + ", lambda x: " + q.strip("x") + "), lambda x: x <> '')"
_SEP = "(" + q.strip("regexp_replace(x, '[|:\\-]', '', 'g')") + " = '' AND regexp_matches(x, '[|\\-]'))"
_CELLS = """
    list_transform(CASE WHEN contains(x, '|') THEN string_split(regexp_replace(x, '^\\|+|\\|+$', '', 'g'), '|') WHEN contains(x,
        ',') THEN string_split(x, ',') ELSE [x] END, lambda y:
""" + q.strip("y") + ")"
TABLES = f"""
    WITH l AS (SELECT doc_id, {q.strip('text')} AS whole, {_L} AS own
      FROM documents),
    r AS (SELECT *, list_transform(list_filter(own, lambda x: NOT {_SEP}), lambda x: {_CELLS}) AS rows,
      len(list_filter(own, lambda x: {_SEP})) > 0 AS sep, len(list_filter(own, lambda x: contains(x, '|'))) AS piped
      FROM l),
    s AS (SELECT *, list_transform(rows, lambda x: len(x)) AS sizes, flatten(rows) AS cells
      FROM r),
    t AS (SELECT doc_id, whole, len(rows) AS row_count, coalesce(list_max(sizes), 0) AS col_count,
      len(list_distinct(sizes)) = 1 AS stable_columns, sep AS separator_present,
      round(CASE WHEN len(cells) > 0 THEN len(list_filter(cells, lambda x: x = '')) / len(cells) ELSE 0.0 END, 4) AS empty_cell_ratio,
      len(rows) > 0 AND coalesce(list_max(sizes),
        0) > 1 AND (sep OR piped >= 2 OR (contains(whole, ',') AND len(rows) >= 2 AND list_min(sizes) > 1)) AS looks_like_table,
      len(list_filter(cells, lambda x: x <> '')) AS n_cells
      FROM s)
"""


@query(f"""
    {TABLES}
    SELECT doc_id, row_count, col_count, stable_columns, separator_present, empty_cell_ratio, looks_like_table, n_cells
    FROM t
""")
def table_facts(spark, d):
    f = _spread(_table(spark, d, "documents")).select("doc_id", evidence.table_facts(F.col("text")).alias("f"))
    return f.select("doc_id", *[f"f.{c}" for c in ("row_count", "col_count", "stable_columns", "separator_present", "empty_cell_ratio",
                "looks_like_table")], F.size("f.cell_texts").alias("n_cells"))


@query(f"""
    {TABLES}
    SELECT doc_id, CASE WHEN whole = '' THEN 0.0 ELSE round(greatest(0.0,
        1 - CASE WHEN NOT looks_like_table THEN 0.45 ELSE 0 END - CASE WHEN row_count < 1 OR col_count < 1 THEN 0.4 ELSE 0 END - CASE
        WHEN NOT stable_columns AND row_count > 1 THEN 0.15 ELSE 0 END - CASE WHEN row_count = 1 THEN 0.1 ELSE 0 END - CASE
        WHEN empty_cell_ratio >= 0.5 THEN 0.15 ELSE 0 END), 4) END::DOUBLE AS score
    FROM t
""")
def table_score(spark, d):
    f = _spread(_table(spark, d, "documents")).select("doc_id", "text", evidence.table_facts(F.col("text")).alias("f"))
    return f.select("doc_id", evidence.table_score(F.col("text"), F.col("f")).alias("score"))


_BARE_LINES = "list_filter(list_transform(" + q.lines("text") + ", lambda x: " + q.strip("x") + "), lambda x: x <> '' AND " + q.strip(
    "regexp_replace(x, '[|:\\-]', '', 'g')") + " <> '')"


@query(f"""
    WITH s AS (SELECT doc_id, list_transform({_BARE_LINES}, lambda x: len(list_filter({_CELLS}, lambda z: z <> ''))) AS sizes
      FROM documents)
    SELECT doc_id, len(sizes) AS rows, coalesce(list_max(sizes), 0) AS cols
    FROM s
""")
def table_shape(spark, d):
    return _spread(_table(spark, d, "documents")).select("doc_id", evidence.shape_of(F.col("text")).alias("s")).select("doc_id", "s.rows", "s.cols")


def _diagram() -> Column:
    n = lambda k, c: F.concat(F.lit(k), F.col("p_partkey").cast("string"), F.lit(c[0]), F.col("p_name"), F.lit(c[1]))
    return F.concat(F.when(F.col("p_size") % 2 == 0, F.lit("flowchart TD\n")).otherwise(F.lit("")), n("A", "[]"),
        F.when(F.col("p_size") % 3 == 0, F.lit(" ==> ")).otherwise(F.lit(" --> ")), F.lit('B("'), F.col("p_brand"), F.lit('")\nC{'),
        F.col("p_type"), F.lit("} -.-> A"))


_DIA = """
    (CASE WHEN p_size % 2 = 0 THEN 'flowchart TD' || chr(10) ELSE '' END || 'A' || p_partkey || '[' || p_name || ']' || CASE
      WHEN p_size % 3 = 0 THEN ' ==> ' ELSE ' --> ' END || 'B(\"' || p_brand || '\")' || chr(10) || 'C{' || p_type || '} -.-> A')
"""


@query("""
    SELECT p_partkey, 2 AS arrows, CASE WHEN p_name = p_brand OR p_brand = p_type OR p_name = p_type THEN 2 ELSE 3 END AS nodes,
    p_name AS first_node, CAST(round(1 - CASE WHEN p_size % 2 = 0 THEN 0 ELSE 0.45 END - CASE WHEN p_size % 2 = 0 THEN 0 ELSE 0.2 END,
        4) AS DOUBLE) AS score
    FROM part
""")
def diagram_check(spark, d):
    p = _table(spark, d, "part").withColumn("content", _diagram())
    return p.select("p_partkey", text.arrow_count(F.col("content")).alias("arrows"),
        F.size(evidence.node_texts(F.col("content"))).alias("nodes"), evidence.node_texts(F.col("content"))[0].alias("first_node"),
        evidence.diagram_score(F.col("content")).alias("score"))


@query("""
    SELECT l_orderkey AS item, l_linenumber, l_partkey, l_suppkey,
    CAST(CASE WHEN l_returnflag = 'R' THEN 1.0 WHEN l_linestatus = 'F' THEN CASE WHEN l_linenumber > 3 THEN 0.8 ELSE 0.4 END ELSE CASE
      WHEN l_quantity > 25 THEN 0.35 ELSE 0.85 END END AS DOUBLE) AS score
    FROM lineitem
""")
def structure_scores(spark, d):
    rows = _table(spark, d, "lineitem").select(F.col("l_orderkey").alias("item"), "l_linenumber", "l_partkey", "l_suppkey",
        F.when(F.col("l_linestatus") == "F", "text").otherwise("none").alias("kind"),
        F.when(F.col("l_linenumber") > 3, "x").otherwise(" ").alias("content"),
        F.when(F.col("l_quantity") > 25, "chart").otherwise("document").alias("type"), (F.col("l_returnflag") == "R").alias("stamp"))
    return rows.select("item", "l_linenumber", "l_partkey", "l_suppkey",
        evidence.structure_score(F.col("kind"), F.col("content"), F.col("type"), F.col("stamp"), F.lit(0.0)).alias("score"))


# ---- sources


@query("""
    SELECT page_id, substr(sha256(url), 1, 16) AS item, lower(regexp_extract(url, '\\.([^./]+)$', 1)) AS extension,
    CASE WHEN contains(lower(url), 'flow') THEN 'flowchart' WHEN regexp_matches(lower(url),
      'chart|plot|graph') THEN 'chart' WHEN regexp_matches(lower(url), 'table|tabular') THEN 'table' WHEN contains(lower(url),
      'screen') THEN 'screenshot' WHEN regexp_matches(lower(url), 'doc|page') THEN 'document' WHEN contains(lower(url),
      'diagram') THEN 'diagram' WHEN contains(lower(url), 'mixed') THEN 'mixed' WHEN contains(lower(url),
      'unknown') THEN 'unknown' ELSE 'natural_image' END AS kind
    FROM pages
""")
def image_ids(spark, d):
    u = F.col("url")
    return _table(spark, d, "pages").select("page_id", tasks.item_id(u).alias("item"), tasks.extension(u).alias("extension"),
        tasks.type_of_path(u).alias("kind"))


@query("SELECT page_id, 'data:image/png;base64,' || base64(encode(url)) AS data FROM pages")
def data_urls(spark, d):
    return _table(spark, d, "pages").select("page_id", tasks.data_url(F.lit("x.png"), F.encode("url", "utf-8")).alias("data"))


@query("""
    SELECT event_id, NOT regexp_matches(lower(event_type || ' ' || CASE WHEN event_id % 3 = 0 THEN 'Missing key' ELSE 'timeout' END),
      'api key|missing|unauthorized|401') AS retry
    FROM events
""")
def retry_filter(spark, d):
    said = F.concat("event_type", F.lit(" "), F.when(F.col("event_id") % 3 == 0, "Missing key").otherwise("timeout"))
    return _table(spark, d, "events").select("event_id", tasks.retryable(said).alias("retry"))


@query("SELECT p_partkey AS item, n_name AS model FROM part CROSS JOIN nation WHERE n_regionkey = 1")
def model_calls(spark, d):
    models = _table(spark, d, "nation").filter("n_regionkey = 1").select(F.col("n_name").alias("model"))
    return tasks.calls(_table(spark, d, "part").select(F.col("p_partkey").alias("item")), models)


@query("SELECT page_id, url FROM pages ORDER BY url, page_id LIMIT 10")
def limit_first(spark, d):
    return tasks.first_tasks(_table(spark, d, "pages").select("page_id", "url", F.struct("url", "page_id").alias("path")), 10).drop("path")


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_id % 3 > 0 AS repaired FROM events")
def json_repair(spark, d):
    from ..functions.json_repair import first_object

    cut = F.col("props").substr(F.lit(1), F.length("props") - F.when(F.col("event_id") % 3 > 0, 1).otherwise(0))
    rows = _table(spark, d, "events").select("event_id",
        F.concat(F.when(F.col("event_id") % 2 == 0, F.lit("here: ")).otherwise(F.lit("```json ")), cut).alias("raw"))

    def fix(batches):
        for b in batches:
            b["found"], b["repaired"] = zip(*map(first_object, b["raw"]), strict=True) if len(b) else ([], [])
            yield b[["event_id", "found", "repaired"]]

    return rows.mapInPandas(fix, "event_id long, found string, repaired boolean").select("event_id",
        F.get_json_object("found", "$.k").cast("long").alias("k"), "repaired")


@query("""
    SELECT c_custkey, n, CASE WHEN n = 0 THEN NULL ELSE 'N' || CASE WHEN n < 1000 THEN lpad(CAST(n AS VARCHAR), 3,
      '0') ELSE CAST(n AS VARCHAR) END END AS name
    FROM (SELECT c_custkey, CAST(c_custkey AS BIGINT) AS n
      FROM customer)
""")
def node_names(spark, d):
    n = graphs.node_number(F.concat(F.lit("node-"), F.col("c_custkey").cast("string"), F.lit("/7")), F.lit(3))
    return _table(spark, d, "customer").select("c_custkey", n.alias("n"), F.when(n != 0, graphs.node_name(n)).alias("name"))


@query(f"""
    WITH t AS (SELECT item, model, role, {q.strip('text')} AS whole
      FROM (SELECT conv_id AS item, turn AS model, role, text FROM conversations)),
    w AS (SELECT item, model, regexp_replace(whole, '^[ ,;:|/\\\\\\-_.]+|[ ,;:|/\\\\\\-_.]+$', '', 'g') AS s
      FROM t),
    k AS (SELECT item, model, s, list_filter(regexp_extract_all(s, '[\\x{{4E00}}-\\x{{9FFF}}A-Za-z0-9]+'),
        lambda x: NOT regexp_matches(x, '^[0-9]+$')) AS l
      FROM w)
    SELECT item, model, coalesce(list_filter(l, lambda x: length(x) = list_max(list_transform(l, lambda y: length(y))))[1],
      CASE WHEN regexp_matches(s, '^[0-9]+$') THEN '' ELSE s END) AS seal
    FROM k
""")
def seal_names(spark, d):
    return _turns(spark, d).select("item", "model", seals.seal_name(F.col("text")).alias("seal"))


# ---- boxes and graphs

BOX = "[round(l_discount * 5, 4), round(l_tax * 5, 4), round(least(1.0, l_discount * 5 + l_quantity / 50), 4), round(least(1.0, l_tax * 5 + l_quantity / 100), 4)]"


def _box() -> Column:
    x, y, n = F.col("l_discount") * 5, F.col("l_tax") * 5, F.col("l_quantity")
    return geometry.clean_box(F.array(x, y, x + n / 50, y + n / 100))


def _dist(a: str, b: str) -> str:
    mid = lambda i: f"(({a}[{i}] + {a}[{i + 2}]) / 2 - ({b}[{i}] + {b}[{i + 2}]) / 2)"
    return f"round(sqrt({mid(1)} * {mid(1)} + {mid(2)} * {mid(2)}), 4)"


def _iou(a: str, b: str) -> str:
    side = lambda hi, lo: f"greatest(0.0, {hi} - {lo})"
    inter = f"({side(f'least({a}[3], {b}[3])', f'greatest({a}[1], {b}[1])')} * {side(f'least({a}[4], {b}[4])', f'greatest({a}[2], {b}[2])')})"
    area = lambda x: f"({side(f'{x}[3]', f'{x}[1]')} * {side(f'{x}[4]', f'{x}[2]')})"
    return f"CASE WHEN {inter} <= 0 THEN 0.0 ELSE round({inter} / ({area(a)} + {area(b)} - {inter}), 4) END"


@query(f"""
    WITH {CLAIMS}, b AS (SELECT item, model, {BOX} AS x
      FROM c)
    SELECT a.item, a.model AS l, b.model AS r, CAST(round(200 * {_dist('a.x', 'b.x')}) AS INTEGER) AS distance,
    CAST(round(200 * {_iou('a.x', 'b.x')}) AS INTEGER) AS iou
    FROM b a
    JOIN b ON a.item = b.item AND a.model < b.model
""")
def box_pairs(spark, d):
    rows = _claims(spark, d).select("item", "model", _box().alias("x"))
    p = votes.pairs(rows, ["item"], "model", ["x"])
    return p.select("item", F.col("l_model").alias("l"), F.col("r_model").alias("r"),
        F.round(200 * geometry.center_distance(F.col("l_x"), F.col("r_x"))).cast("int").alias("distance"),
        F.round(200 * geometry.iou(F.col("l_x"), F.col("r_x"))).cast("int").alias("iou"))


GRAPH = f"""
    n AS (SELECT l_orderkey AS item, l_suppkey % 3 AS model,
      row_number() OVER (PARTITION BY l_orderkey, l_suppkey % 3 ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS node,
      l_returnflag || l_linestatus AS text, {SHAPE} AS shape, {BOX} AS box, l_linenumber AS row_index,
      CAST(l_quantity AS INTEGER) % 5 AS col_index, l_linestatus, l_returnflag
      FROM lineitem),
    k AS (SELECT item, model, count(*) AS n
      FROM n
      GROUP BY ALL),
    h AS (SELECT item, CAST(count(*) AS INTEGER) AS models, list_reverse_sort(list(n)) AS c
      FROM k
      GROUP BY item
      HAVING count(*) >= 2),
    ch AS (SELECT item, models, CAST(CASE WHEN models = 2 THEN c[2] ELSE c[2] END AS INTEGER) AS selected,
      CASE WHEN models = 2 THEN CASE WHEN c[1] <> c[2] THEN 'ambiguous' ELSE 'fused' END WHEN c[1] - c[3] >= 2 THEN 'ambiguous'
      WHEN c[2] > c[3] THEN 'partial' ELSE 'fused' END AS status,
      CAST(CASE WHEN models = 2 THEN c[1] - c[2] ELSE c[2] - c[3] END AS INTEGER) AS inconsistent
      FROM h),
    ed AS (SELECT item, model, node AS position, CASE WHEN l_linestatus = 'F' THEN node + 1 ELSE node END AS source,
      CASE WHEN l_linestatus = 'F' THEN node ELSE node + 1 END AS target, l_returnflag AS label
      FROM (SELECT *, lead(node) OVER (PARTITION BY item, model ORDER BY node) AS nx FROM n)
      WHERE nx IS NOT NULL)
"""
NEEDED = "CASE WHEN models <= 2 THEN models ELSE 2 END"


def _graph(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    own = Window.partitionBy("item", "model").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    rows = _table(spark, d, "lineitem").withColumn("item", F.col("l_orderkey")).withColumn("model",
        F.col("l_suppkey") % 3).withColumn("node", F.row_number().over(own)).withColumn("next",
        F.lead("node").over(Window.partitionBy("item", "model").orderBy("node")))
    nodes = rows.select("item", "model", "node", F.col("l_linenumber").alias("row_index"),
        (F.col("l_quantity").cast("int") % 5).alias("col_index"), F.col("node").alias("order_index"), _box().alias("box"),
        _shape().alias("shape"), F.concat("l_returnflag", "l_linestatus").alias("text"))
    back = F.col("l_linestatus") == "F"
    edges = rows.filter("next IS NOT NULL").select("item", "model", F.col("node").alias("position"),
        F.when(back, F.col("next")).otherwise(F.col("node")).alias("source"),
        F.when(back, F.col("node")).otherwise(F.col("next")).alias("target"), F.col("l_returnflag").alias("label"))
    return nodes, edges, rows.select("item", "model").distinct()


@query(f"WITH {GRAPH} SELECT * FROM ch")
def graph_select(spark, d):
    nodes, _, drawn = _graph(spark, d)
    return graphs.select_nodes(nodes, drawn)


NODES = f"""
    vn AS (SELECT n.*, models, {q.vote_form('text')} AS form
      FROM n
      JOIN ch ON n.item = ch.item
      WHERE node <= selected),
    gn AS (SELECT *, {q.grams('form')} AS gr
      FROM vn),
    cn AS (SELECT a.item, a.node, round(avg(CASE WHEN a.form = b.form THEN 1.0 ELSE {q.jaccard('a.gr', 'b.gr', 1.0)} END), 4) AS s
      FROM gn a
      JOIN gn b ON a.item = b.item AND a.node = b.node AND a.model < b.model
      GROUP BY ALL),
    fm AS (SELECT item, node, form, count(*) AS n, max(length(text)) AS len, first(text ORDER BY text DESC) AS best
      FROM vn
      GROUP BY ALL),
    rt AS (SELECT item, node, first(best ORDER BY n DESC, len DESC, form) AS representative_text
      FROM fm
      GROUP BY ALL),
    sh AS (SELECT item, node, shape, count(*) AS n
      FROM vn
      GROUP BY ALL),
    rs AS (SELECT item, node, first(shape ORDER BY n DESC, shape = 'unknown', shape) AS representative_shape
      FROM sh
      GROUP BY ALL),
    bn AS (SELECT item, node, models, CAST(count(DISTINCT model) AS INTEGER) AS support
      FROM vn
      GROUP BY ALL),
    fn AS (SELECT bn.item, bn.node, support, round(support / models, 4) AS confidence, coalesce(cn.s, 1.0) AS text_consistency,
      representative_text, representative_shape, true AS has_text
      FROM bn
      LEFT JOIN cn ON bn.item = cn.item AND bn.node = cn.node
      JOIN rt ON bn.item = rt.item AND bn.node = rt.node
      JOIN rs ON bn.item = rs.item AND bn.node = rs.node)
"""
EDGES = f"""
    ce AS (SELECT DISTINCT ed.item, models, model, source, target, label
      FROM ed
      JOIN ch ON ed.item = ch.item
      WHERE source <= selected AND target <= selected),
    fe0 AS (SELECT *, {q.vote_form('label')} AS form
      FROM ce),
    le AS (SELECT a.item, a.source, a.target, round(avg(CASE WHEN a.form = b.form THEN 1.0 ELSE 0.0 END), 4) AS s
      FROM fe0 a
      JOIN fe0 b ON a.item = b.item AND a.source = b.source AND a.target = b.target AND a.model < b.model
      GROUP BY ALL),
    lf AS (SELECT item, source, target, form, count(*) AS n, first(label) AS best
      FROM fe0
      GROUP BY ALL),
    lr AS (SELECT item, source, target, first(best ORDER BY n DESC, form) AS label
      FROM lf
      GROUP BY ALL),
    be AS (SELECT item, source, target, models, CAST(count(DISTINCT model) AS INTEGER) AS support
      FROM ce
      GROUP BY ALL),
    fe AS (SELECT be.item, be.source, be.target, support, round(support / models, 4) AS confidence,
      coalesce(le.s, 1.0) AS label_consistency,
      lr.label, support >= {NEEDED} AS fused
      FROM be
      LEFT JOIN le ON be.item = le.item AND be.source = le.source AND be.target = le.target
      JOIN lr ON be.item = lr.item AND be.source = lr.source AND be.target = lr.target)
"""


@query(f"WITH {GRAPH}, {NODES} SELECT * FROM fn")
def graph_nodes(spark, d):
    nodes, _, drawn = _graph(spark, d)
    return graphs.fuse_nodes(nodes, graphs.select_nodes(nodes, drawn))


@query(f"WITH {GRAPH}, {EDGES} SELECT * FROM fe")
def graph_edges(spark, d):
    nodes, edges, drawn = _graph(spark, d)
    return graphs.fuse_edges(edges, graphs.select_nodes(nodes, drawn))


@query(f"""
    WITH {GRAPH}, {EDGES}
    SELECT item, least(source, target) AS a, greatest(source, target) AS b
    FROM ce
    GROUP BY ALL
    HAVING count(DISTINCT source < target) > 1
""")
def edge_direction_conflicts(spark, d):
    nodes, edges, drawn = _graph(spark, d)
    return graphs.direction_conflicts(edges, graphs.select_nodes(nodes, drawn))


PRUNE = """
    dg AS (SELECT item, node, count_if(fused) AS strong, count_if(NOT fused) AS weak
      FROM (SELECT item, source AS node, fused FROM fe UNION ALL SELECT item, target, fused FROM fe)
      GROUP BY ALL),
    gone AS (SELECT fn.item, fn.node
      FROM fn
      JOIN dg ON fn.item = dg.item AND fn.node = dg.node
      JOIN ch ON fn.item = ch.item
      WHERE support < models AND text_consistency < 0.35 AND strong = 0 AND weak > 0)
"""


@query(f"WITH {GRAPH}, {NODES}, {EDGES}, {PRUNE} SELECT item, node FROM fn EXCEPT SELECT * FROM gone")
def graph_prune(spark, d):
    nodes, edges, drawn = _graph(spark, d)
    chosen = materialized(graphs.select_nodes(nodes, drawn), "chosen")
    return graphs.prune(graphs.fuse_nodes(nodes, chosen), graphs.fuse_edges(edges, chosen), chosen)[0].select("item", "node")


@query(f"""
    WITH {GRAPH}, al AS (SELECT a.item, a.node, a.model AS l, b.model AS r, abs(a.row_index - b.row_index) AS rg,
      abs(a.col_index - b.col_index) AS cg, a.shape AS s1, b.shape AS s2, a.box AS x, b.box AS y
      FROM n a
      JOIN n b ON a.item = b.item AND a.node = b.node AND a.model < b.model
      JOIN ch ON a.item = ch.item
      WHERE a.node <= selected)
    SELECT item, node, l AS \"left\", r AS \"right\",
    unnest(list_filter([CASE WHEN rg > 1 THEN 'row' END, CASE WHEN cg > 1 THEN 'col' END,
        CASE WHEN s1 <> 'unknown' AND s2 <> 'unknown' AND s1 <> s2 THEN 'shape' END, CASE WHEN {_dist('x', 'y')} > 0.20 THEN 'far' END,
        CASE WHEN {_dist('x', 'y')} > 0.28 AND {_iou('x', 'y')} < 0.05 AND (rg > 1 OR cg > 1) THEN 'position' END],
        lambda z: z IS NOT NULL)) AS kind
    FROM al
""")
def graph_alignment(spark, d):
    nodes, _, drawn = _graph(spark, d)
    return graphs.alignment(nodes, graphs.select_nodes(nodes, drawn))


@query(f"""
    WITH {GRAPH}, {NODES}, {EDGES}, li AS (SELECT item, 0 AS k, node AS a, 0 AS b,
      'N' || lpad(CAST(node AS VARCHAR), 3, '0') || CASE representative_shape WHEN 'diamond' THEN '{{\"' || representative_text || '\"}}'
      ELSE '[\"' || representative_text || '\"]' END AS line
      FROM fn
      UNION ALL
      SELECT item, 1, source, target, 'N' || lpad(CAST(source AS VARCHAR), 3,
        '0') || ' -->|' || label || '| N' || lpad(CAST(target AS VARCHAR),
        3, '0')
      FROM fe
      WHERE fused)
    SELECT item, 'flowchart TD' || chr(10) || string_agg(line, chr(10)
      ORDER BY k, a, b) AS mermaid
    FROM li
    GROUP BY item
""")
def graph_mermaid(spark, d):
    nodes, edges, drawn = _graph(spark, d)
    chosen = materialized(graphs.select_nodes(nodes, drawn), "chosen")
    return graphs.mermaid(graphs.fuse_nodes(nodes, chosen), graphs.fuse_edges(edges, chosen).filter("fused"))


@query(f"""
    WITH {GRAPH}, {NODES}, {EDGES}, ns AS (SELECT item, count(*) AS nodes, avg(confidence) AS node_support, avg(text_consistency) AS text,
      count_if(text_consistency < 0.55) AS low_text
      FROM fn
      GROUP BY item),
    es AS (SELECT item, count_if(fused) AS edges, avg(CASE WHEN fused THEN confidence END) AS edge_support,
      avg(CASE WHEN fused THEN label_consistency END) AS label, count_if(NOT fused) AS low_edges
      FROM fe
      GROUP BY item)
    SELECT ch.item, round(greatest(0.0, 0.45 * node_support + 0.25 * coalesce(edge_support, 0.0) + 0.20 * text + 0.10 * coalesce(label,
          1.0) - (CASE status WHEN 'partial' THEN 0.08 WHEN 'ambiguous' THEN 0.18 ELSE 0.0 END + least(0.12,
            0.04 * coalesce(low_edges, 0)) + least(0.10, 0.03 * low_text) + CASE WHEN coalesce(edges,
            0) = 0 THEN 0.08 ELSE 0.0 END + CASE WHEN models >= 3 AND inconsistent > 0 THEN least(0.10, 0.03 * inconsistent) ELSE 0.0 END)),
      3) AS graph_confidence
    FROM ch
    JOIN ns ON ch.item = ns.item
    LEFT JOIN es ON ch.item = es.item
""")
def graph_confidence(spark, d):
    nodes, edges, drawn = _graph(spark, d)
    chosen = materialized(graphs.select_nodes(nodes, drawn), "chosen")
    fused, claims = graphs.fuse_nodes(nodes, chosen), graphs.fuse_edges(edges, chosen)
    ns = fused.groupBy("item").agg(F.count(F.lit(1)).alias("nodes"), F.avg("confidence").alias("node_support"),
        F.avg("text_consistency").alias("text"), F.count_if(F.col("text_consistency") < graphs.LOW).alias("low_text"))
    es = claims.groupBy("item").agg(F.count_if("fused").alias("edges"),
        F.avg(F.when(F.col("fused"), F.col("confidence"))).alias("edge_support"),
        F.avg(F.when(F.col("fused"), F.col("label_consistency"))).alias("label"), F.count_if(~F.col("fused")).alias("low_edges"))
    stats = chosen.join(ns, "item").join(es, "item", "left").fillna(0,
        ["edges", "low_edges"]).withColumns({"fallback": F.lit(False), "errors": F.lit(0), "critical": F.lit(0)})
    return graphs.confidence(stats).select("item", F.round("graph_confidence", 3).alias("graph_confidence"))


@query(f"""
    WITH RECURSIVE {GRAPH}, rt AS (SELECT item, model, node, 1 AS depth
      FROM n
      WHERE NOT EXISTS (SELECT 1 FROM ed WHERE ed.item = n.item AND ed.model = n.model AND ed.target = n.node)),
    dp AS (SELECT *
      FROM rt UNION
      SELECT dp.item, dp.model, ed.target, dp.depth + 1
      FROM dp
      JOIN ed ON dp.item = ed.item AND dp.model = ed.model AND dp.node = ed.source),
    md AS (SELECT item, model, node, min(depth) AS depth
      FROM dp
      GROUP BY ALL)
    SELECT n.item, n.model, n.node, CAST(coalesce(md.depth, n.node) AS INTEGER) AS depth
    FROM n
    LEFT JOIN md ON n.item = md.item AND n.model = md.model AND n.node = md.node
""")
def node_depths(spark, d):
    nodes, edges, _ = _graph(spark, d)
    return graphs.node_depths(nodes, edges, ["item", "model"])


# ---- decisions

ITEMS = """
    s AS (SELECT l_orderkey AS item, CAST(1 + l_orderkey % 3 AS INTEGER) AS models,
      CAST(count(DISTINCT l_linenumber) % 4 AS INTEGER) AS parsed0, round(avg(l_quantity) / 40, 4) AS overall_score,
      round(1 - avg(l_discount), 4) AS type_agreement, round(max(l_quantity) / 50, 4) AS structure_agreement,
      round(1 - avg(l_tax), 4) AS evidence_score, round(1 - max(l_tax), 4) AS validator_score,
      round(min(l_discount) * 8, 4) AS hallucination_risk, max(l_linestatus) = 'O' AS has_seals,
        round(min(l_quantity) / 10, 4) AS seal_agreement
      FROM lineitem
      GROUP BY l_orderkey),
    i AS (SELECT *, least(parsed0, models) AS parsed, least(parsed0, models) AS successes
      FROM s)
"""


def _items(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("l_orderkey")
    rows = _table(spark, d, "lineitem").groupBy(k.alias("item")).agg(
        (F.count_distinct("l_linenumber") % 4).cast("int").alias("parsed0"), F.round(F.avg("l_quantity") / 40, 4).alias("overall_score"),
        F.round(1 - F.avg("l_discount"), 4).alias("type_agreement"), F.round(F.max("l_quantity") / 50, 4).alias("structure_agreement"),
        F.round(1 - F.avg("l_tax"), 4).alias("evidence_score"), F.round(1 - F.max("l_tax"), 4).alias("validator_score"),
        F.round(F.min("l_discount") * 8, 4).alias("hallucination_risk"), (F.max("l_linestatus") == "O").alias("has_seals"),
        F.round(F.min("l_quantity") / 10, 4).alias("seal_agreement"),
    )
    rows = rows.withColumn("models", (1 + F.col("item") % 3).cast("int")).withColumn("parsed",
        F.least("parsed0", "models")).withColumn("successes", F.col("parsed"))
    nothing = F.lit(None).cast(
        "struct<method:string,status:string,graph_confidence:double,edges:int,edge_errors:int,critical:int,inconsistent:int,uneven:boolean,position_nodes:int,low_text:int,low_edges:int>")
    return rows.withColumns({"caption_agreement": F.lit(1.0), "stamp_mode": F.lit(False), "majority_type": F.lit("document"),
            "critical_errors": F.array().cast("array<string>"), "graph": nothing})


_B = {n: f"CASE WHEN models = 2 THEN {two} ELSE {more} END" for n, (two, more) in decisions.BOUNDS.items()}
_GATE = "models > 1 AND " + " AND ".join(f"{n} {'<=' if n == 'hallucination_risk' else '>='} {b}" for n, b in _B.items())
_DECISION = f"""
    CASE WHEN parsed = 0 THEN 'failed' WHEN parsed = 1 OR (has_seals AND seal_agreement < 1.0) OR NOT ({_GATE}) THEN 'review'
    ELSE 'accepted' END
"""
_LATE = [("low_consensus_score", f"overall_score < {_B['overall_score']}"),
    ("low_type_agreement", f"type_agreement < {_B['type_agreement']}"),
    ("low_structure_agreement", f"structure_agreement < {_B['structure_agreement']}"),
    ("seal_agreement_below_threshold", "has_seals AND seal_agreement < 1.0"),
    ("low_evidence_score", f"evidence_score < {_B['evidence_score']}"),
    ("low_validator_score", f"validator_score < {_B['validator_score']}"),
    ("high_hallucination_risk", f"hallucination_risk > {_B['hallucination_risk']}"),
    ("two_model_disagreement", "models = 2 AND (type_agreement < 1.0 OR structure_agreement < 0.75 OR overall_score < 0.85)")]
_CODES = ["CASE WHEN parsed = 1 THEN 'single_model_result' END",
    "CASE WHEN successes < models / 2 THEN 'less_than_half_models_succeeded' END",
    "CASE WHEN parsed > 0 AND has_seals AND seal_agreement < 1.0 THEN 'low_seal_agreement' END",
    *(f"CASE WHEN decision = 'review' AND ({c}) THEN '{n}' END" for n, c in _LATE)]


@query(f"""
    WITH {ITEMS}, e AS (SELECT *, {_DECISION} AS decision
      FROM i)
    SELECT item, decision, CASE decision WHEN 'accepted' THEN 'accepted' WHEN 'review' THEN 'candidate' ELSE 'failed' END AS status,
    array_to_string(list_filter([{', '.join(_CODES)}], lambda x: x IS NOT NULL), ',') AS escalation_reasons
    FROM e
""")
def decide(spark, d):
    rows = decisions.decide(_items(spark, d))
    return rows.select("item", "decision", decisions.label_status(F.col("decision")).alias("status"),
        F.array_join("escalation_reasons", ",").alias("escalation_reasons"))


@query("""
    WITH g AS (SELECT l_orderkey AS item, count_if(l_returnflag = 'R') AS low, count_if(l_returnflag <> 'R') AS fused
      FROM lineitem
      GROUP BY 1)
    SELECT item, low > 0 AND (fused = 0 OR low >= fused OR (low >= 3 AND low / (low + fused) >= 0.35)) AS many,
    round(CASE WHEN low + fused = 0 THEN 1.0 ELSE low / (low + fused) END, 4) AS ratio
    FROM g
""")
def low_support(spark, d):
    g = _table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("item")).agg(F.count_if(F.col("l_returnflag") == "R").alias("low"),
        F.count_if(F.col("l_returnflag") != "R").alias("fused"))
    return g.select("item", decisions.many_low_support(F.col("low"), F.col("fused")).alias("many"),
        F.round(decisions.low_support_ratio(F.col("low"), F.col("fused")), 4).alias("ratio"))


REG = f"""
    rg AS (SELECT l_orderkey AS item, l_suppkey % 3 AS model, {ROLE} AS role, l_linestatus || CAST(l_linenumber AS VARCHAR) AS text,
      l_tax > 0.04 AS boxed, l_quantity > 25 AS sure, l_partkey
      FROM lineitem)
"""


@query(f"""
    WITH {REG}
    SELECT item, model, CAST(sum(CASE role WHEN 'seal' THEN 6 ELSE 4 END + boxed::INT + sure::INT) AS INTEGER) AS score,
    array_to_string(list_sort(list(role || ':' || lower(text))), ',') AS signature
    FROM rg
    GROUP BY ALL
""")
def region_scores(spark, d):
    t = _table(spark, d, "lineitem")
    role = F.when(F.col("l_returnflag") == "A", "seal").when(F.col("l_returnflag") == "N", "watermark").otherwise("footer")
    boxed = F.when(F.col("l_tax") > 0.04, F.array(F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(1.0)))
    one = F.struct(role.alias("role"), F.concat("l_linestatus", F.col("l_linenumber").cast("string")).alias("text"), boxed.alias("box"),
        F.when(F.col("l_quantity") > 25, "high").otherwise("low").alias("confidence"))
    sets = t.groupBy(F.col("l_orderkey").alias("item"), (F.col("l_suppkey") % 3).alias("model")).agg(F.collect_list(one).alias("r"))
    return sets.select("item", "model", labels.regions_score(F.col("r")).alias("score"),
        F.array_join(F.sort_array(labels.regions_signature(F.col("r"))), ",").alias("signature"))


@query("""
    SELECT l_orderkey AS item, string_agg(l_shipmode, ', '
      ORDER BY model) AS statuses
    FROM (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
        l_extendedprice) AS model,
      l_returnflag || CASE WHEN l_linestatus = 'F' THEN ':ok' ELSE ':fail' END AS l_shipmode
      FROM lineitem)
    GROUP BY 1
""")
def model_statuses(spark, d):
    return labels.model_statuses(_claims(spark, d).select("item", "model", F.col("l_returnflag").alias("name"),
            (F.col("l_linestatus") == "F").alias("success")))


# ---- whole runs, not expressible in SQL: held against expected rows in the tests


@query()
def normalize_answers(spark, d):
    """Conversations as raw answers: JSON with the turn's text, cut off in every third."""
    raw = F.to_json(F.struct(F.lit("document").alias("image_type"), F.col("text").alias("caption"), F.split("text", "\n").alias("visible_text")))
    cut = F.when(F.col("model") % 3 == 2, raw.substr(F.lit(1), F.length(raw) - 3)).otherwise(raw)
    rows = _turns(spark, d).select("item", "model", F.lit(True).alias("success"), cut.alias("raw_text"), F.lit(None).cast("string").alias("error"))
    return normalize.labels(normalize.normalize(rows)).select("item", "model", "image_type", "caption", "kind", "format",
        F.size("visible_text").alias("n_visible"), F.array_join("warnings", ";").alias("warnings"))


@query()
def reindex_graphs(spark, d):
    nodes, edges, _ = _graph(spark, d)
    return graphs.reindex(nodes, edges)[0].select("item", "model", "node", "row_index", "col_index", "shape", "text")


from . import label_queries  # noqa: E402, F401  (registers its queries too)
