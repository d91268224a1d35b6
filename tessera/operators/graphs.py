"""Fusing the flowchart graphs that several annotators drew of one item.

Nodes and edges are rows keyed by item and annotator. Node identity is visual
order: reindex() numbers each annotator's nodes by rows and then from left to
right, so that equal numbers vote for one node. Everything after it is grouped
aggregates and equi-joins on the item's key.

nodes: item, model, node (number from 1), row, col, box, shape, text
edges: item, model, position, source, target (node numbers), label
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import accumulate
from operator import itemgetter

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.geometry import center_distance, iou
from ..functions.text import bigrams, blank, jaccard, strip, visible_score, vote_form
from ..session import materialized
from .votes import support_needed

#: Text or label consistency below which a warning is due; below which an orphan is pruned.
LOW, ORPHAN = 0.55, 0.35
ITEM = ["item"]


def node_number(id_text: Column, fallback: Column) -> Column:
    """The first run of digits, else the fallback if it is positive."""
    digits = F.regexp_extract(blank(id_text), "[0-9]+", 0)
    return F.when(digits != "", digits.try_cast("long")).when(fallback > 0, fallback.cast("long"))


def node_name(number: Column) -> Column:
    return F.format_string("N%03d", number)


# ---- visual order


def _depths(nodes: list[int], order: list[int | None], edges: list[tuple[int, int]]) -> dict[int, int]:
    """Steps from the nearest root of one graph, breadth first. Nodes that no root reaches have their place in order; without a root, all have."""
    after: dict[int, list[int]] = {n: [] for n in nodes}
    heads = set()
    for a, b in edges:
        if a in after and b in after:
            after[a].append(b)
            heads.add(b)
    found = {n: 1 for n in nodes if n not in heads}
    if not found:
        return {n: o or i for i, (n, o) in enumerate(zip(nodes, order, strict=True), 1)}
    queue = sorted(found)
    for n in queue:  # grows while it is read
        for b in after[n]:
            if b not in found:
                found[b] = found[n] + 1
                queue.append(b)
    return {n: found.get(n, max(1, o or 1)) for n, o in zip(nodes, order, strict=True)}


def _drawn(nodes: DataFrame, edges: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """A row for each annotator's graph: its nodes in order (n) and the ends of its edges (e). A graph is one answer, so its size is bounded."""
    listed = F.sort_array(F.collect_list(F.struct(F.coalesce("order_index", "node").alias("o"), *columns)))
    ends = edges.groupBy(*keys).agg(F.collect_list(F.struct("source", "target")).alias("e"))
    return nodes.groupBy(*keys).agg(listed.alias("n")).join(ends, keys, "left")


def _flat(lists: pa.Array) -> tuple[list[int], list[pa.Array]]:
    """The size of each list of structs, and the structs' fields as flat arrays. A null list is empty."""
    return pc.fill_null(pc.list_value_length(lists), 0).to_pylist(), lists.flatten().flatten()


def _each(batch: pa.RecordBatch) -> Iterator[tuple[list, list[tuple[int, int]]]]:
    """The nodes of each graph of a batch of _drawn() as a list for each column, and the ends of its edges."""
    sizes, fields = _flat(batch["n"])
    columns = [f.to_pylist() for f in fields[1:]]
    counts, (sources, targets) = _flat(batch["e"])
    ends = list(zip(sources.to_pylist(), targets.to_pylist(), strict=True))
    at = to = 0
    for size, count in zip(sizes, counts, strict=True):
        yield [c[at : at + size] for c in columns], ends[to : to + count]
        at, to = at + size, to + count


def _lists(sizes: Iterable[int], **columns: pa.Array) -> pa.Array:
    """Lists of structs, from flat columns and the lists' sizes."""
    return pa.ListArray.from_arrays(pa.array([0, *accumulate(sizes)], pa.int32()), pa.StructArray.from_arrays(list(columns.values()), list(columns)))


def node_depths(nodes: DataFrame, edges: DataFrame, keys: list[str]) -> DataFrame:
    """keys, node, depth: the depths that reindex() uses."""
    kinds = {f.name: f.dataType.simpleString() for f in nodes.schema}
    number = to_arrow_type(nodes.schema["node"].dataType)

    def measure(batches):
        for batch in batches:
            found = [_depths(node, order, ends) for (node, order), ends in _each(batch)]
            flat = [x for own in found for x in own.items()]
            d = _lists(map(len, found), node=pa.array([n for n, _ in flat], number), depth=pa.array([x for _, x in flat], pa.int32()))
            yield pa.RecordBatch.from_arrays([*(batch[k] for k in keys), d], [*keys, "d"])

    schema = ", ".join(f"{k} {kinds[k]}" for k in keys) + f", d array<struct<node:{kinds['node']},depth:int>>"
    return _drawn(nodes, edges, keys, ["node", "order_index"]).mapInArrow(measure, schema).select(*keys,
        F.explode("d").alias("x")).select(*keys, "x.node", "x.depth")


def _sweep(rows: list[tuple[float, float, float, int, tuple[float, float] | None, float]]) -> list[int]:
    """Row numbers of nodes in visual order. Each is (effective y, raw y, height, ...): it joins the running row or opens the next."""
    heights = sorted(b[1] - b[0] for *_, b, _ in rows if b is not None)
    least = max(0.045, 1.1 * heights[len(heights) // 2]) if heights else 0.045
    out, row, members, mean, span = [], 0, 0, 0.0, None
    for y, raw, height, _, bounds, _ in rows:
        near = max(least, 0.9 * height)
        joins = members > 0 and abs(y - mean) <= near
        if members and not joins and span and bounds:
            shared, short = min(span[1], bounds[1]) - max(span[0], bounds[0]), min(span[1] - span[0], bounds[1] - bounds[0])
            joins = shared > 0 and short > 0 and shared / short >= 0.35 and abs(y - mean) <= max(near,
                0.08) and abs(raw - (span[0] + span[1]) / 2) <= max(near, 0.08)
        if joins:
            members += 1
            mean += (y - mean) / members
            span = bounds if span is None else span if bounds is None else (min(span[0], bounds[0]), max(span[1], bounds[1]))
        else:
            row, members, mean, span = row + 1, 1, y, bounds
        out.append(row)
    return out


def reindex(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges numbered by visual order within each annotator's graph. Depths and the sweep over rows, which keeps a running mean, are computed in Python, a graph at a time."""
    keys, own = ["item", "model"], ["node", "order_index", "row_index", "col_index", "box", "shape", "text"]
    kinds = {f.name: f.dataType.simpleString() for f in nodes.schema}
    placed = "array<struct<node:bigint,row_index:int,col_index:int>>"

    def number(batches):
        for batch in batches:
            made = [_place(*columns[:5], ends) for columns, ends in _each(batch)]
            flat = lambda i: [x for own in made for x in own[i]]
            p = _lists((len(own[0]) for own in made), node=pa.array(flat(0), pa.int64()), row_index=pa.array(flat(1), pa.int32()),
                col_index=pa.array(flat(2), pa.int32()))
            yield pa.RecordBatch.from_arrays([*(batch[k] for k in keys), batch["n"], p], [*keys, "n", "p"])

    listed = ", ".join(f"{c}: {kinds[c]}" for c in own)
    order = f"o: {'bigint' if 'bigint' in (kinds['node'], kinds['order_index']) else kinds['node']}"
    schema = f"item {kinds['item']}, model {kinds['model']}, n array<struct<{order}, {listed}>>, p {placed}"
    done = _drawn(nodes, edges, keys, own).mapInArrow(number, schema).select(*keys, F.explode(F.arrays_zip("n", "p")).alias("z"))
    done = done.select(*keys, F.col("z.n.node").alias("old"), F.col("z.p.node").alias("node"),
        F.col("z.p.node").cast("int").alias("order_index"), "z.p.row_index", "z.p.col_index", "z.n.box", "z.n.shape", "z.n.text")
    end = lambda name: done.select(*keys, F.col("old").alias(name), F.col("node").alias(f"new_{name}"))
    moved = edges.join(end("source"), [*keys, "source"]).join(end("target"), [*keys, "target"])
    other = [c for c in edges.columns if c not in (*keys, "source", "target")]
    return done.drop("old"), moved.select(*keys, F.col("new_source").alias("source"), F.col("new_target").alias("target"), *other)


def _place(node: list, order_index: list, row_index: list, col_index: list, box: list, edges: list[tuple[int, int]]) -> tuple[list, list, list]:
    """New number, row and column of each of a graph's nodes, in the nodes' order."""
    depth = _depths(node, order_index, edges)
    some = []
    for i, (n, o, r, c, b) in enumerate(zip(node, order_index, row_index, col_index, box, strict=True)):
        order = o or n or 10**9
        if b is not None:
            left, top, right, bottom = b
            raw, x, height, bounds = (top + bottom) / 2, (left + right) / 2, max(0.0, bottom - top), (top, bottom)
        else:
            raw, x, height, bounds = 0.1 * (r or o or n or 10**6), 0.1 * (c or 1), 0.0, None
        y = raw + 0.12 * max(0, depth[n] - 1)
        some.append((round(y, 4), round(x, 4), order, f"N{n:03d}", i, (y, raw, height, order, bounds, x)))
    some.sort(key=itemgetter(0, 1, 2, 3))
    rows = _sweep([s[5] for s in some])
    ranked = sorted((row, s[1], s[0], s[2], s[3], k) for k, (row, s) in enumerate(zip(rows, some, strict=True)))
    numbers, placed, columns = [0] * len(node), [0] * len(node), [0] * len(node)
    last = column = 0
    for number, (row, *_, k) in enumerate(ranked, 1):
        column, last = column + 1 if row == last else 1, row
        i = some[k][4]
        numbers[i], placed[i], columns[i] = number, row, column
    return numbers, placed, columns


# ---- voting


def select_nodes(nodes: DataFrame, graphs: DataFrame) -> DataFrame:
    """item, models, selected (nodes 1 to this number are kept), status and inconsistent, in closed form from the number of nodes of each graph.

    Two graphs share the smaller number; of more, a node needs a majority, which the m-th largest number gives.
    """
    # Dealt out by item alone, so that one exchange serves both groupings.
    claims = graphs.select("item", "model", F.lit(1).alias("drawn"), F.lit(0).alias("n")).unionByName(nodes.select("item", "model",
            F.lit(0).alias("drawn"), F.lit(1).alias("n"))).repartition("item")
    counts = claims.groupBy("item", "model").agg(F.max("drawn").alias("drawn"), F.sum("n").alias("n")).filter("drawn = 1")
    per = counts.groupBy("item").agg(F.count(F.lit(1)).cast("int").alias("models"), F.sort_array(F.collect_list("n"), asc=False).alias("c"))
    k = F.col("models")
    hi, lo, mth = F.col("c")[0], F.element_at("c", -1), F.element_at("c", support_needed(k))
    spread = hi - lo
    chosen = F.when(lo == 0, 0).when(k == 2, lo).otherwise(mth)
    inconsistent = F.when(lo == 0, hi).when(k == 2, spread).otherwise(mth - lo)
    status = F.when(lo == 0, "failed").when(k == 2, F.when(spread > 0, "ambiguous").otherwise("fused")).when(spread >= 2,
        "ambiguous").when(mth > lo, "partial").otherwise("fused")
    return per.filter("models >= 2").select("item", "models", chosen.cast("int").alias("selected"), status.alias("status"),
        inconsistent.cast("int").alias("inconsistent"))


def consistency(votes: DataFrame, keys: list[str], text: str = "text", order: str = "model") -> DataFrame:
    """Mean bigram likeness of an item's texts that are not blank; 1 for up to one."""
    own = votes.withColumn("form", vote_form(F.col(text))).filter("form <> ''").select(*keys, F.col(order).alias("o"), "form",
        bigrams(F.col("form")).alias("grams"))
    left, right = (own.select(*keys, F.col("o").alias(f"{s}o"), F.col("form").alias(f"{s}f"), F.col("grams").alias(f"{s}g")) for s in "ab")
    pairs = left.join(right, keys).filter("ao < bo").select(*keys,
        F.when(F.col("af") == F.col("bf"), 1.0).otherwise(jaccard(F.col("ag"), F.col("bg"), 1.0)).alias("s"))
    means = pairs.groupBy(*keys).agg(F.round(F.avg("s"), 4).alias("s"))
    return votes.select(*keys).distinct().join(means, keys, "left").select(*keys, F.coalesce("s", F.lit(1.0)).alias("text_consistency"))


def representative(votes: DataFrame, keys: list[str], text: str = "text", allow_blank: bool = False) -> DataFrame:
    """The text that stands for all: of the form with most votes (then the fullest, the longest, the first by form), the fullest and longest writing."""
    own = votes.select(*keys, strip(F.col(text)).alias("t"))
    own = own if allow_blank else own.filter("t <> ''")
    scored = own.withColumn("form", vote_form(F.col("t"))).withColumn("v", visible_score(F.col("t")))
    best = F.max_by("t", F.struct("v", F.length("t"), "t"))
    forms = scored.groupBy(*keys, "form").agg(F.count(F.lit(1)).alias("n"), F.max("v").alias("v"), F.max(F.length("t")).alias("len"), best.alias("best"))
    place = Window.partitionBy(*keys).orderBy(F.desc("n"), F.desc("v"), F.desc("len"), F.asc("form"))
    return forms.withColumn("r", F.row_number().over(place)).filter("r = 1").select(*keys, F.col("best").alias("representative_text"))


def representative_shape(votes: DataFrame, keys: list[str], shape: str = "shape") -> DataFrame:
    """The shape with most votes; unknown only if alone, then by name."""
    place = Window.partitionBy(*keys).orderBy(F.desc("n"), F.col(shape) == "unknown", shape)
    return votes.groupBy(*keys, shape).agg(F.count(F.lit(1)).alias("n")).withColumn("r",
        F.row_number().over(place)).filter("r = 1").select(*keys, F.col(shape).alias("representative_shape"))


# ---- votes about one node or edge, as an array with an entry for each annotator's claim


def vote(text: Column) -> list[Column]:
    """What a claim's text needs to be compared and chosen."""
    t = strip(text)
    return [t.alias("t"), vote_form(text).alias("form"), visible_score(t).alias("v")]


def agreement_of(votes: Column) -> Column:
    """consistency() of an array of votes."""
    said = F.filter(votes, lambda x: x.form != "")
    like = lambda a, b: F.when(a.form == b.form, 1.0).otherwise(jaccard(bigrams(a.form), bigrams(b.form), 1.0))
    each = F.flatten(F.transform(said, lambda a, i: F.transform(F.slice(said, i + 2, F.size(said)), lambda b: like(a, b))))
    mean = F.aggregate(each, F.lit(0.0), lambda total, x: total + x) / F.size(each)
    return F.when(F.size(F.array_distinct(F.transform(said, lambda x: x.form))) <= 1, 1.0).otherwise(F.round(mean, 4))


def spoken(votes: Column) -> Column:
    """representative() of an array of votes; null for none."""
    forms = F.array_sort(F.array_distinct(F.transform(votes, lambda x: x.form)))

    def entry(form: Column, place: Column) -> Column:
        own = F.transform(F.filter(votes, lambda x: x.form == form), lambda x: F.struct(x.v.alias("v"), F.length(x.t).alias("len"), x.t.alias("t")))
        longest = F.array_max(F.transform(own, lambda x: x.len))
        return F.struct(F.size(own).alias("n"), F.array_max(own).v.alias("v"), longest.alias("len"), (-place).alias("first"), F.array_max(own).t.alias("best"))

    return F.array_max(F.transform(forms, entry)).best


def shape_spoken(shapes: Column) -> Column:
    """representative_shape() of an array."""
    distinct = F.array_sort(F.array_distinct(shapes))
    counted = F.transform(distinct, lambda s,
        i: F.struct(F.size(F.filter(shapes, lambda x: x == s)).alias("n"), (s != "unknown").alias("known"), (-i).alias("first"),
            s.alias("s")))
    return F.array_max(counted).s


def fuse_nodes(nodes: DataFrame, chosen: DataFrame) -> DataFrame:
    """Selected nodes: item, node, support, confidence, text_consistency, representatives, has_text. One grouping by item and node gathers the annotators' claims."""
    own = nodes.join(chosen.select("item", "models", "selected"), "item").filter("node <= selected")
    per = own.groupBy("item", "node", "models").agg(F.array_sort(F.collect_list(F.struct("model", *vote(F.col("text")), "shape"))).alias("votes"))
    said = F.filter("votes", lambda x: x.t != "")
    support = F.size(F.array_distinct(F.transform("votes", lambda x: x.model)))
    return per.select(
        "item", "node", support.alias("support"), F.round(support / F.col("models"), 4).alias("confidence"),
        agreement_of(F.col("votes")).alias("text_consistency"),
        F.coalesce(spoken(said), F.lit("")).alias("representative_text"),
        F.coalesce(shape_spoken(F.transform("votes", lambda x: x.shape)), F.lit("unknown")).alias("representative_shape"),
        (F.size(said) > 0).alias("has_text"),
    )


def edge_claims(edges: DataFrame, chosen: DataFrame) -> DataFrame:
    """Edges between selected nodes, once for each annotator, ends and label."""
    kept = edges.join(chosen.select("item", "models", "selected"), "item").filter("source <= selected AND target <= selected")
    return kept.withColumn("label", strip(F.col("label"))).groupBy("item", "models", "model", "source", "target",
        "label").agg(F.min("position").alias("position"))


def fuse_edges(edges: DataFrame, chosen: DataFrame) -> DataFrame:
    """Edges with their votes: item, source, target, support, confidence, label_consistency, label, fused (whether a majority has it)."""
    claims = edge_claims(edges, chosen)
    per = claims.groupBy("item", "source", "target",
        "models").agg(F.array_sort(F.collect_list(F.struct("model", "position", *vote(F.col("label"))))).alias("votes"))
    support = F.size(F.array_distinct(F.transform("votes", lambda x: x.model)))
    return per.select(
        "item", "source", "target", support.alias("support"), F.round(support / F.col("models"), 4).alias("confidence"),
        agreement_of(F.col("votes")).alias("label_consistency"), spoken(F.col("votes")).alias("label"),
        (support >= support_needed(F.col("models"))).alias("fused"),
    )


def direction_conflicts(edges: DataFrame, chosen: DataFrame) -> DataFrame:
    """Pairs of nodes joined in both directions: item, a, b. Loops have one direction."""
    ends = edge_claims(edges, chosen).select("item", F.least("source", "target").alias("a"), F.greatest("source", "target").alias("b"),
        (F.col("source") < F.col("target")).alias("up"))
    return ends.groupBy("item", "a", "b").agg(F.count_distinct("up").alias("n")).filter("n > 1").select("item", "a", "b")


def alignment(nodes: DataFrame, chosen: DataFrame) -> DataFrame:
    """Pairs of claims for a node that disagree: item, node, left, right, kind (row, col, shape, far: warnings; position: an error)."""
    own = nodes.join(chosen.select("item", "selected"), "item").filter("node <= selected").select("item", "node", "model",
        F.struct("row_index", "col_index", "shape", "box").alias("x"))
    both = own.withColumnRenamed("model", "left").withColumnRenamed("x",
        "a").join(own.withColumnRenamed("model", "right").withColumnRenamed("x", "b"),
        ["item", "node"]).filter(F.col("left") < F.col("right"))
    gap = lambda c: F.coalesce(F.abs(F.col(f"a.{c}") - F.col(f"b.{c}")), F.lit(0))
    boxes = F.col("a.box").isNotNull() & F.col("b.box").isNotNull()
    far = center_distance(F.col("a.box"), F.col("b.box"))
    known = (F.col("a.shape") != "unknown") & (F.col("b.shape") != "unknown") & (F.col("a.shape") != F.col("b.shape"))
    apart = boxes & (far > 0.28) & (iou(F.col("a.box"), F.col("b.box")) < 0.05) & ((gap("row_index") > 1) | (gap("col_index") > 1))
    kinds = F.array_compact(F.array(F.when(gap("row_index") > 1, F.lit("row")), F.when(gap("col_index") > 1, F.lit("col")),
            F.when(known, F.lit("shape")), F.when(boxes & (far > 0.20), F.lit("far")), F.when(apart, F.lit("position"))))
    return both.select("item", "node", "left", "right", F.explode(kinds).alias("kind"))


def marked(fused: DataFrame, edges: DataFrame, chosen: DataFrame) -> DataFrame:
    """Nodes with a column `gone`: not claimed by all, hardly consistent, without a fused edge but with one of low support. One pass is the fixed point."""
    ends = edges.select("item", F.explode(F.array("source", "target")).alias("node"), "fused")
    degree = ends.groupBy("item", "node").agg(F.count_if("fused").alias("strong"), F.count_if(~F.col("fused")).alias("weak"))
    gone = (F.col("support") < F.col("models")) & (F.col("text_consistency") < ORPHAN) & (F.col("strong") == 0) & (F.col("weak") > 0)
    return fused.join(chosen.select("item", "models"), "item").join(degree, ["item", "node"], "left").select(*fused.columns,
        F.coalesce(gone, F.lit(False)).alias("gone"))


def prune(fused: DataFrame, edges: DataFrame, chosen: DataFrame) -> tuple[DataFrame, DataFrame]:
    nodes = marked(fused, edges, chosen)
    gone = nodes.filter("gone").select("item", "node")
    kept = edges.join(gone.withColumnRenamed("node", "source"), ["item", "source"],
        "left_anti").join(gone.withColumnRenamed("node", "target"), ["item", "target"], "left_anti")
    return nodes.filter("NOT gone").drop("gone"), kept.select(edges.columns)


def confidence(stats: DataFrame) -> DataFrame:
    """graph_confidence from node_support, edge_support, text, label (means), status, fallback, and the counts of errors, low_edges, low_text, critical, edges, nodes, inconsistent and models."""
    base = 0.45 * F.coalesce("node_support", F.lit(0.0)) + 0.25 * F.coalesce("edge_support", F.lit(0.0)) + 0.20 * F.coalesce("text",
        F.lit(1.0)) + 0.10 * F.coalesce("label", F.lit(1.0))
    capped = lambda most, each, n: F.least(F.lit(most), F.lit(each) * F.col(n))
    penalty = (
        F.when(F.col("fallback"), 0.18).otherwise(0.0)
        + F.when(F.col("status") == "partial", 0.08).when(F.col("status") == "ambiguous", 0.18).when(F.col("status") == "failed", 0.35).otherwise(0.0)
        + capped(0.18, 0.03, "errors") + capped(0.12, 0.04, "low_edges") + capped(0.10, 0.03, "low_text") + capped(0.15, 0.05, "critical")
        + F.when(F.col("edges") == 0, 0.08).otherwise(0.0)
        + F.when((F.col("models") >= 3) & (F.col("inconsistent") > 0), capped(0.10, 0.03, "inconsistent")).otherwise(0.0)
    )
    return stats.withColumn("graph_confidence", F.when(F.col("nodes") == 0, 0.0).otherwise(F.round(F.greatest(F.lit(0.0), base - penalty), 4)))


def fuse(nodes: DataFrame, edges: DataFrame, graphs: DataFrame) -> dict[str, DataFrame]:
    """The whole fusion of indexed graphs. graphs: item, model, weak, parse_errors (count).

    Gives `items` (status, confidence and counts, one row each), `nodes`, `edges` and `mermaid`.
    """
    chosen = materialized(select_nodes(nodes, graphs), "chosen")
    voted, claimed = materialized(fuse_nodes(nodes, chosen), "nodes"), materialized(fuse_edges(edges, chosen), "edges")
    fused, claims = (materialized(x, "kept") for x in prune(voted, claimed, chosen))
    gone = voted.select("item", "node").join(fused.select("item", "node"), ["item", "node"], "left_anti")
    conflicts = alignment(nodes, chosen).filter("kind = 'position'").join(gone, ["item", "node"],
        "left_anti").groupBy("item").agg(F.count_distinct("node", "left", "right").alias("position_errors"))
    turned = direction_conflicts(edges, chosen).join(gone.withColumnRenamed("node", "a"), ["item", "a"],
        "left_anti").join(gone.withColumnRenamed("node", "b"), ["item", "b"],
        "left_anti").groupBy("item").agg(F.count(F.lit(1)).alias("turned"))
    outside = edges.join(chosen,
        "item").filter("source > selected OR target > selected").groupBy("item").agg(F.count_distinct("model", "source",
            "target").alias("outside"))
    node_stats = fused.groupBy("item").agg(F.count(F.lit(1)).alias("nodes"), F.avg("confidence").alias("node_support"),
        F.avg("text_consistency").alias("text"), F.count_if(F.col("has_text") & (F.col("text_consistency") < LOW)).alias("low_text"))
    edge_stats = claims.groupBy("item").agg(F.count_if("fused").alias("edges"),
        F.avg(F.when(F.col("fused"), F.col("confidence"))).alias("edge_support"),
        F.avg(F.when(F.col("fused"), F.col("label_consistency"))).alias("label"), F.count_if(~F.col("fused")).alias("low_edges"))
    source = graphs.groupBy("item").agg(F.bool_or("weak").alias("fallback"), (F.max("parse_errors") > 0).alias("broken"))
    rows = chosen.join(source, "item")
    for part in (node_stats, edge_stats, conflicts, turned, outside):
        rows = rows.join(part, "item", "left")
    rows = rows.fillna(0, ["nodes", "edges", "low_text", "low_edges", "position_errors", "turned", "outside"])
    uneven = ((F.col("models") == 2) & (F.col("inconsistent") > 0) & (F.col("selected") > 0)) | ((F.col("models") > 2) & (F.col("status") == "ambiguous"))
    first = F.when((F.col("models") == 2) & (F.col("position_errors") > 0), "ambiguous").otherwise(F.col("status"))
    first = F.when(F.col("status") == "failed", "failed").when(F.col("fallback"), "ambiguous").otherwise(first)
    failed = F.col("selected") == 0
    rows = rows.withColumns({"uneven": uneven, "critical": F.col("broken").cast("int") + 2 * failed.cast("int"),
            "edge_errors": F.col("turned") + F.col("outside"), "node_errors": F.col("position_errors") + uneven.cast("int"),
            "status": first})
    rows = rows.withColumn("status",
        F.when((F.col("status") == "fused") & ((F.col("edges") == 0) | (F.col("edge_errors") > 0)),
            "partial").otherwise(F.col("status"))).withColumn("errors", F.col("node_errors") + F.col("edge_errors"))
    rows = confidence(rows)
    rows = rows.withColumn("status",
        F.when((F.col("status") == "fused") & (F.col("graph_confidence") < 0.70),
            "partial").when((F.col("status") == "fused") & (F.col("critical") > 0), "failed").otherwise(F.col("status")))
    rows = confidence(rows.drop("graph_confidence")).withColumn("method", F.when(F.col("fallback"), "mermaid_fallback").otherwise("visual_order"))
    return {"items": rows, "nodes": fused, "edges": claims, "mermaid": mermaid(fused, claims.filter("fused"))}


def mermaid(fused: DataFrame, edges: DataFrame) -> DataFrame:
    """item and its diagram text: nodes in order, then edges by the order of their ends."""
    text = F.replace(F.when(strip(F.col("representative_text")) != "",
            strip(F.col("representative_text"))).otherwise(node_name(F.col("node"))), F.lit('"'), F.lit("&quot;"))
    shape = F.col("representative_shape")
    lead = F.when(shape == "diamond", '{"').when(shape == "rounded", '("').when(shape == "ellipse", '(("').otherwise('["')
    tail = F.when(shape == "diamond", '"}').when(shape == "rounded", '")').when(shape == "ellipse", '"))').otherwise('"]')
    drawn = fused.select("item",
        F.struct(F.lit(0).alias("k"), F.col("node").cast("long").alias("a"), F.lit(0).cast("long").alias("b"),
            F.concat(node_name(F.col("node")), lead, text, tail).alias("line")).alias("l"))
    label = strip(F.col("label"))
    arrow = F.when(label != "",
        F.concat(F.lit(" -->|"), F.replace(F.replace(label, F.lit('"'), F.lit("&quot;")), F.lit("|"), F.lit("/")),
            F.lit("| "))).otherwise(" --> ")
    joined = edges.select("item",
        F.struct(F.lit(1).alias("k"), F.col("source").cast("long").alias("a"), F.col("target").cast("long").alias("b"),
            F.concat(node_name(F.col("source")), arrow, node_name(F.col("target"))).alias("line")).alias("l"))
    ordered = F.transform(F.array_sort(F.collect_list("l")), lambda x: x.line)
    return drawn.union(joined).groupBy("item").agg(F.concat(F.lit("flowchart TD\n"), F.array_join(ordered, "\n")).alias("mermaid"))
