"""Behaviours of the consensus operators on small frames of our own."""

import json

import pytest
from pyspark.sql import functions as F

from tessera.functions import geometry, text
from tessera.functions.json_repair import first_object
from tessera.functions.mermaid import graph_of
from tessera.operators import decisions, evidence, graphs, seals, votes
from tessera.sources import clients, normalize, tasks

NODE = "item string, model int, node bigint, order_index int, row_index int, col_index int, box array<double>, shape string, text string"
EDGE = "item string, model int, position int, source bigint, target bigint, label string"


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def frames(spark, models):
    """models: for each annotator (nodes as (x, y, text), edges as (source, target, label))."""
    nodes, edges = [], []
    for m, (own, arrows) in enumerate(models):
        nodes += [("i", m, k, k, None, None, None if x is None else [x, y, x + 0.1, y + 0.05], "rectangle", t) for k, (x, y, t) in enumerate(own, 1)]
        edges += [("i", m, k, *a) for k, a in enumerate(arrows)]
    return spark.createDataFrame(nodes, NODE), spark.createDataFrame(edges, EDGE), spark.createDataFrame([("i", m, False, 0) for m in range(len(models))], "item string, model int, weak boolean, parse_errors int")


def fused(spark, models):
    nodes, edges, drawn = frames(spark, models)
    return graphs.fuse(*graphs.reindex(nodes, edges), drawn)


CHAIN = [(0.4, 0.1 + 0.2 * k, t) for k, t in enumerate(("start", "work", "work", "end"))]
ARROWS = [(1, 2, ""), (2, 3, ""), (3, 4, "")]


def test_ties_go_to_the_first(spark):
    rows = spark.createDataFrame([("a", 0, "y"), ("a", 1, "x"), ("a", 2, "x"), ("a", 3, "y"), ("b", 0, None)], "item string, model int, value string")
    got = {r.item: (r.value, r.votes, r.ratio) for r in votes.majority(rows, ["item"], "value", "model").collect()}
    assert got == {"a": ("y", 2, 0.5), "b": (None, 1, 1.0)}


def test_similarities(spark):
    p = lambda s: text.prepared(F.lit(s))
    both = lambda f, a, b: value(spark, f(p(a), p(b)))
    assert both(text.text_similarity, "ab cd", "AB  cd") == 1.0 and both(text.text_similarity, "", "x") == 0.0
    assert both(text.field_similarity, " ", "") == 0.5 and both(text.phrase_similarity, "abc", "abcdef") == pytest.approx(0.45 + 0.5 * 0.5)
    e = lambda a, b: value(spark, text.evidence_similarity(text.evidence_prepared(F.lit(a)), text.evidence_prepared(F.lit(b))))
    assert e("ab", "abcd") == pytest.approx(0.375) and e("hello world", "hello world again") == pytest.approx(0.65 + 0.25 * 10 / 15)


def test_boxes(spark):
    box = lambda *v: F.array(*map(F.lit, v))
    assert value(spark, geometry.iou(box(0.0, 0.0, 1.0, 1.0), box(0.5, 0.0, 1.5, 1.0))) == 0.3333
    assert value(spark, geometry.center_distance(F.lit(None).cast("array<double>"), box(0.0, 0.0, 1.0, 1.0))) == 1.0
    assert value(spark, geometry.clean_box(box(-1.0, 0.12345, 2.0, 0.5))) == [0.0, 0.1235, 1.0, 0.5]


def test_equal_graphs_fuse_and_repeated_text_stays(spark):
    out = fused(spark, [(CHAIN, ARROWS)] * 2)
    item = out["items"].first()
    assert (item.status, item.nodes, item.edges, item.method, item.graph_confidence) == ("fused", 4, 3, "visual_order", 1.0)
    assert out["mermaid"].first().mermaid.split("\n")[:2] == ["flowchart TD", 'N001["start"]'] and "N003 --> N004" in out["mermaid"].first().mermaid


def test_unequal_counts_are_ambiguous(spark):
    more = [*CHAIN, (0.4, 0.92, "more"), (0.4, 0.99, "most")]
    item = fused(spark, [(more, ARROWS), (CHAIN, ARROWS), (CHAIN, ARROWS)])["items"].first()
    assert (item.status, item.selected, item.inconsistent, item.uneven) == ("ambiguous", 4, 0, True)
    item = fused(spark, [([*CHAIN, (0.4, 0.95, "more")], ARROWS), (CHAIN, ARROWS)])["items"].first()
    assert (item.status, item.selected, item.inconsistent) == ("ambiguous", 4, 1)


def test_majority_edge_and_low_support(spark):
    more = [*ARROWS, (1, 3, "skip")]
    out = fused(spark, [(CHAIN, more), (CHAIN, ARROWS), (CHAIN, [*more, (1, 4, "")])])
    assert {(r.source, r.target): (r.support, r.fused) for r in out["edges"].collect()} == {(1, 2): (3, True), (2, 3): (3, True), (3, 4): (3, True), (1, 3): (2, True), (1, 4): (1, False)}


def test_reversed_edge_conflicts(spark):
    item = fused(spark, [(CHAIN[:2], [(1, 2, "")]), (CHAIN[:2], [(2, 1, "")])])["items"].first()
    assert item.edges == 0 and item.edge_errors >= 1


def test_swapped_ids_are_realigned(spark):
    a = [(0.1, 0.1, "top"), (0.1, 0.5, "left"), (0.6, 0.5, "right")]
    b = [a[0], a[2], a[1]]
    out = fused(spark, [(a, [(1, 2, ""), (1, 3, "")]), (b, [(1, 3, ""), (1, 2, "")])])
    assert {r.node: (r.representative_text, r.text_consistency) for r in out["nodes"].collect()} == {1: ("top", 1.0), 2: ("left", 1.0), 3: ("right", 1.0)}


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_graphs_are_chosen_in_one_exchange_and_pruned_in_one_pass(spark):
    nodes, edges, drawn = frames(spark, [(CHAIN, ARROWS), (CHAIN[:3], ARROWS[:2]), ([], [])])
    chosen = graphs.select_nodes(nodes, drawn)
    assert chosen._jdf.queryExecution().sparkPlan().toString().count("Join") == 0
    assert [tuple(r) for r in chosen.collect()] == [("i", 3, 0, "failed", 4)]
    voted = spark.createDataFrame([("i", 1, 1, 0.3333, 0.1), ("i", 2, 1, 0.3333, 0.1)], "item string, node bigint, support int, confidence double, text_consistency double").repartition(3)
    claims = spark.createDataFrame([("i", 1, 1, False)], "item string, source bigint, target bigint, fused boolean")
    kept = graphs.prune(voted, claims, spark.createDataFrame([("i", 3)], "item string, models int"))[0]
    assert plan(kept).count("Repartition 3") == 1 and [r.node for r in kept.collect()] == [2]


def test_visual_order_reads_arrow_columns(spark):
    nodes, edges, _ = frames(spark, [(CHAIN, ARROWS), (CHAIN[:2], [])])
    done = graphs.reindex(nodes, edges)[0]
    assert "MapInPandas" not in plan(done)
    assert sorted((r.model, r.node, r.row_index, r.col_index) for r in done.collect()) == [(0, 1, 1, 1), (0, 2, 2, 1), (0, 3, 3, 1), (0, 4, 4, 1), (1, 1, 1, 1), (1, 2, 2, 1)]


def test_structures_are_measured_by_their_kind(spark):
    from tessera.operators import agreement

    rows = [("t", 0, "table", "a|b\nc|d"), ("t", 1, "table", "a|b"), ("x", 0, "text", "same"), ("x", 1, "text", "same")]
    got = agreement.structure_agreement(spark.createDataFrame(rows, "item string, model int, kind string, content string"))
    assert "= table)" in plan(got)  # what isn't a table has no rows and columns to compare
    assert {r.item: r.structure_agreement for r in got.collect()} == {"t": pytest.approx(0.5 + 0.25 * 0.75 + 0.25 * 0.5), "x": 1.0}


def test_mermaid_reader():
    g = graph_of("flowchart TD\nA[one] --> B(two)\nB -->|yes| C{\"th\nree\"}; C ==> A\n%% note\nstyle A x")
    assert g["nodes"] == [("A", "one", "rectangle"), ("B", "two", "ellipse"), ("C", "th ree", "diamond")]
    assert g["edges"] == [("A", "B", ""), ("B", "C", "yes"), ("C", "A", "")]
    assert graph_of("") is None and graph_of("A-->B")["nodes"][0][0] == "A--"


def test_json_repair():
    whole = json.dumps({"a": [1, {"b": "x, y"}], "c": "tail"})
    assert first_object("see ```json\n" + whole + "\n``` end") == (whole, False)
    for cut in range(8, len(whole)):
        found, repaired = first_object(whole[:cut])
        assert repaired and isinstance(json.loads(found), dict)
    assert first_object("nothing") == (None, False)


def test_whole_objects_are_not_read_by_the_character():
    import time

    long = json.dumps({"a": ["x, {y}\\"] * 300_000})
    begun = time.process_time()
    assert first_object("so: " + long + " end") == (long, False) and time.process_time() - begun < 1
    assert first_object('{"a":"x"\\') == (None, False) and first_object('{"a":"x\\') == ('{"a":"x"}', True)


def test_diagrams_without_breaks_are_one_piece():
    import time

    text = "A[" + "t" * 3_000_000 + "] --> B"
    begun = time.process_time()
    assert graph_of(text)["edges"] == [("A", "B", "")] and time.process_time() - begun < 1.5
    assert [n[1] for n in graph_of("A[a;b] --> B[c\nd]; C['x']")["nodes"]] == ["a;b", "c d", "'x'"]


def test_answers_of_small_tables_are_spread(spark, tmp_path):
    from tessera.plans import label_queries

    spark.sql("SELECT 1L AS p_partkey, 'n' AS p_name, 'b' AS p_brand, 't' AS p_type, 1 AS p_size").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    cores = spark.sparkContext.defaultParallelism
    assert label_queries._field_answers(spark, str(tmp_path)).rdd.getNumPartitions() >= cores


def normalised(spark, *answers):
    rows = [("i", k, True, a if a is None or isinstance(a, str) else json.dumps(a, ensure_ascii=False), None) for k, a in enumerate(answers)]
    made = normalize.normalize(spark.createDataFrame(rows, "item string, model int, success boolean, raw_text string, error string"))
    return [(r.label, r.error) for r in made.orderBy("model").collect()]


def test_normalising_an_answer(spark):
    graph = {"nodes": [{"node_id": "n7", "text": "a"}, {"text": "b"}], "edges": [{"source": "n7", "target": 2}, {"source": "", "target": 1}]}
    answer = {"image_type": "Photo", "caption": "", "visible_text": ["图1 总览", "abc def"], "structured_label": {"kind": "grid", "content": "x"}, "ocr_regions": [{"role": "公章", "text": "某某有限公司"}, {"role": "odd", "text": "t"}, {"role": "title", "text": " "}, 5], "flowchart_graph": graph}
    (label, error), (none, why), (null, _) = normalised(spark, answer, "no json", None)
    assert error is None and (label.image_type, label.kind, label.format, label.brief) == ("unknown", "text", "plain_text", "图1 总览")
    assert [r.role for r in label.ocr_regions] == ["seal", "other"] and [n.node for n in label.nodes] == [7, 2] and [tuple(e) for e in label.edges] == [(7, 2, "")]
    assert label.warnings == ["image_type normalized from 'photo' to 'unknown'", "structured_label.kind normalized from 'grid' to 'text'", "flowchart_graph edge with invalid source/target was dropped", "ocr_regions[2].role normalized from 'odd' to 'other'", "ocr_regions[3] dropped because text is empty", "ocr_regions item at index 4 dropped because it is not an object", "caption filled from caption_structured.brief"]
    assert none is None and why.startswith("Failed to locate") and null is None


def test_normalising_odd_values(spark):
    odd = {"image_type": None, "caption": 7, "visible_text": "one", "structured_label": {"kind": "table", "format": None, "content": "a,b"}, "caption_structured": {"visual_type": "流程图", "brief": None, "caption_source": "model", "confidence": "sure", "key_visible_text": ["on"]}, "ocr_regions": {}, "warnings": [True, None, " w "], "flowchart_graph": 3}
    cut = json.dumps({"image_type": "chart", "caption": "c", "structured_label": {"kind": "table", "content": "x"}, "visible_text": ["a", "b"]})[:-6]
    (a, _), (b, _), (c, _) = normalised(spark, odd, cut, {"caption_structured": [1], "structured_label": {"kind": "mermaid", "content": "flowchart TD\nA[x] --> B[y]"}, "image_type": "flowchart"})
    assert (a.image_type, a.caption, a.format, a.visual_type, a.caption_confidence, a.key_visible_text) == ("unknown", "7", "none", "flowchart", "medium", ["one"])
    assert a.warnings == ["True", "None", "w", "image_type normalized from 'none' to 'unknown'", "caption_structured.visual_type normalized from '流程图' to 'flowchart'", "caption_structured.key_visible_text aligned to visible_text", "caption_structured.caption_source normalized from 'model' to 'generated'", "caption_structured.confidence normalized from 'sure' to 'medium'", "flowchart_graph normalized from non-object to None", "ocr_regions normalized from non-list to empty list"]
    assert (b.image_type, b.format, b.structure_summary, b.warnings) == ("chart", "markdown", "可见图表结构与数据标注。 可见文字 1 项以内。", ["recovered_truncated_json_output"])
    assert (c.weak, [n.text for n in c.nodes], c.caption) == (True, ["x", "y"], "") and c.warnings == ["caption_structured normalized from non-object to default object", "flowchart_graph missing; derived weak mermaid fallback graph"]


def test_seals(spark):
    assert value(spark, seals.seal_name(F.lit("12345某某有限公司67890"))) == "某某有限公司" and value(spark, seals.seal_name(F.lit("12 34"))) == "12 34"
    rows = spark.createDataFrame([("i", 0, "document", "某某有限公司"), ("i", 1, "document", "某某 有限公司"), ("i", 2, "document", "")], "item string, model int, image_type string, seal string")
    got = seals.seal_facts(rows).first()
    assert (got.stamp_mode, got.missing, got.inconsistent, got.seal) == (True, True, False, "某某有限公司") and got.seal_agreement == pytest.approx(1 / 3, abs=1e-4)


def test_role_conflicts(spark):
    rows = spark.createDataFrame([("i", "seal", "A B"), ("i", "watermark", "ab"), ("i", "footer", "c")], "item string, role string, text string")
    assert [r.squash for r in evidence.role_conflicts(rows, ["item"]).collect()] == ["ab"]


def test_waiver_and_gate(spark):
    graph = "struct<method:string,status:string,graph_confidence:double,edges:int,edge_errors:int,critical:int,inconsistent:int,uneven:boolean,position_nodes:int,low_text:int,low_edges:int>"
    schema = f"item string, models int, successes int, parsed int, type_agreement double, caption_agreement double, structure_agreement double, seal_agreement double, overall_score double, evidence_score double, validator_score double, hallucination_risk double, has_seals boolean, stamp_mode boolean, majority_type string, critical_errors array<string>, graph {graph}"
    good = (3, 3, 3, 1.0, 0.9, 0.95, 1.0, 0.95, 0.96, 0.97, 0.1, False, False, "flowchart", [])
    rows = [("waived", *good, ("visual_order", "partial", 0.4978, 13, 0, 0, 0, False, 0, 0, 8)), ("fallback", *good, ("mermaid_fallback", "ambiguous", 0.6, 3, 0, 0, 0, False, 0, 0, 0)), ("none", *good, None), ("failed", 3, 0, 0, *good[3:], None)]
    got = {r.item: r for r in decisions.decide(spark.createDataFrame(rows, schema)).collect()}
    assert {k: r.decision for k, r in got.items()} == {"waived": "accepted", "fallback": "review", "none": "review", "failed": "failed"}
    uneven = spark.createDataFrame([("i", *good, ("visual_order", "partial", 0.75, 5, 0, 0, 0, True, 0, 5, 0))], schema)  # counts of 5, 3 and 3 nodes
    assert "inconsistent_node_count" in decisions.decide(uneven).first().escalation_reasons
    assert got["none"].escalation_reasons == ["flowchart_without_graph_fusion"] and got["failed"].reasons[0] == "no models succeeded"


def test_tasks_and_models(spark, tmp_path):
    for n in ("b/x.PNG", "a.jpg", "note.txt"):
        (tmp_path / n).parent.mkdir(exist_ok=True)
        (tmp_path / n).write_bytes(b"1")
    found = tasks.image_tasks(spark, f"file://{tmp_path}").orderBy("path").collect()
    assert [(r.file_name, r.extension, len(r.item)) for r in found] == [("a.jpg", "jpg", 16), ("x.PNG", "png", 16)]
    assert tasks.image_tasks(spark, f"file://{tmp_path}/missing").count() == 0
    with pytest.raises(ValueError):
        tasks.first_tasks(tasks.image_tasks(spark, f"file://{tmp_path}"), -1)
    configs = spark.createDataFrame([(0, "m", " Mock ", False, None, None, "x"), (1, "", "openai", True, None, None, None), (2, "n", "odd", True, None, None, "5")], "place int, name string, provider string, enabled boolean, vendor string, source_type string, timeout string")
    good, bad = tasks.usable_models(configs, mock_only=True)
    assert [(r.name, r.timeout, r.vendor) for r in good.collect()] == [("m", 120, "mock")]
    assert sorted(r.reason for r in tasks.usable_models(configs)[1].collect()) == ["invalid", "unsupported"] and bad.count() == 0


def test_long_data_urls_have_no_line_breaks(spark):
    import base64

    content = bytes(range(256)) * 3
    assert value(spark, tasks.data_url(F.lit("a.webp"), F.lit(bytearray(content)))) == "data:image/webp;base64," + base64.b64encode(content).decode()


def test_clients_are_asked_again(spark):
    asked = spark.createDataFrame([("i", "p", 0, "m", "v", "s")], "item string, path string, place int, name string, vendor string, source_type string")

    def failing(row, prompt):
        raise RuntimeError("timeout")

    row = tasks.ask(asked, failing, "p", retries=2, wait=lambda s: None).first()
    assert not row.success and row.error == "RuntimeError: timeout (retries=2)"
    waits = []
    assert tasks.asked(lambda: failing({}, ""), 3, waits.append)[1].endswith("(retries=3)") and waits == [1.0, 2.0, 4.0]
    lost = tasks.complete(asked, tasks.ask(asked, lambda r, p: "x", "p").filter("item = 'other'")).first()
    assert (lost.item, lost.success, lost.error) == ("i", False, "Model call returned no result")


def test_providers_say_what_they_lack(spark, monkeypatch):
    for name in ("DASHSCOPE_API_KEY", "QWEN_API_KEY", "OPENAI_API_KEY", "MY_KEY"):
        monkeypatch.delenv(name, raising=False)
    own = {"provider": "openai_compatible", "name": "m", "supports_vision": "no"}
    said = []
    for more in ({}, {"supports_vision": None}, {"base_url": "http://x"}, {"api_key_env": " MY_KEY "}):
        own |= more
        said.append(clients.lacking(own))
    assert said == ["Model config does not support vision input", "Missing base_url in model config", "Missing api_key_env in model config", "Missing API key: set MY_KEY"]
    monkeypatch.setenv("MY_KEY", "k")
    assert clients.lacking(own).startswith("OpenAI SDK is not installed") or clients.lacking(own) is None
    assert clients.lacking({"provider": "qwen"}) == "Missing API key: set DASHSCOPE_API_KEY or QWEN_API_KEY" and clients.lacking({"provider": "mock"}) is None
    monkeypatch.setenv("OPENAI_API_KEY", "k")
    assert clients.lacking({"provider": "openai"}).endswith("OpenAI real API call is not fully implemented yet")
    assert clients.setting({"t": "7"}, "t", int, 1) == 7 and clients.setting({"t": "x"}, "t", int, 1) == 1 and clients.setting({"b": "maybe"}, "b", bool, True) is True
    assert clients.image_url("a/b.JPG", b"x") == "data:image/jpeg;base64,eA=="
    with pytest.raises(ValueError):
        clients.image_url("a.gif", b"x")
    asked = spark.createDataFrame([("i", "p.png", 0, "m", "v", "s")], "item string, path string, place int, name string, vendor string, source_type string")
    row = tasks.ask(asked, lambda r, p: clients.answer({"provider": "gemini"}, r["path"], p), "p", retries=2).first()
    assert (row.success, row.error) == (False, "Missing API key: set GEMINI_API_KEY")


MODELS = """models:
  - {name: mock_vlm_a, provider: mock, enabled: true, vendor: " "}
  - {name: mock_vlm_b, provider: Mock, enabled: true}
  - {name: mock_vlm_c, provider: mock, enabled: false}
  - {name: other, provider: qwen, enabled: false}
  - {name: odd, provider: nobody, enabled: true}
  - text
"""


def test_command_line(spark, tmp_path, capsys):
    from tessera import __main__ as command

    (tmp_path / "data").mkdir()
    (tmp_path / "models.yaml").write_text(MODELS, encoding="utf-8")
    (tmp_path / "prompts.yaml").write_text("default_prompt: ' describe '", encoding="utf-8")
    words = ["--data-dir", f"{tmp_path}/data", "--output-dir", f"{tmp_path}/out", "--models-config", f"{tmp_path}/models.yaml", "--prompts-config", f"{tmp_path}/prompts.yaml", "--mock"]
    assert command.run(spark, command.arguments(words)) == 0 and "No images found" in capsys.readouterr().out
    for n in ("flow1.png", "table 2.JPG", "cat3.webp", "note.txt"):
        (tmp_path / "data" / n).write_bytes(b"1")
    (tmp_path / "out" / "per_image").mkdir(parents=True)
    (tmp_path / "out" / "per_image" / "old.json").write_text("{}")
    assert command.run(spark, command.arguments([*words, "--overwrite"])) == 0
    assert "total images: 3" in capsys.readouterr().out
    lines = [json.loads(x) for x in (tmp_path / "out" / "summary.jsonl").read_text(encoding="utf-8").splitlines()]
    assert [x["file_name"] for x in lines] == ["cat3.webp", "flow1.png", "table 2.JPG"] and all(x["num_models"] == x["num_success"] == 3 and x["vendor"] == ["mock"] * 3 for x in lines)
    whole = {p.stem: json.loads(p.read_text(encoding="utf-8")) for p in (tmp_path / "out" / "per_image").iterdir() if p.suffix == ".json" and not p.name.startswith(".")}
    final = {p.stem: json.loads(p.read_text(encoding="utf-8")) for p in (tmp_path / "out" / "final_labels").iterdir() if p.suffix == ".json" and not p.name.startswith(".")}
    assert set(whole) == set(final) == {x["item"] for x in lines}
    flow, cat = (next(x for x in final.values() if x["file_name"] == n) for n in ("flow1.png", "cat3.webp"))
    assert set(flow) == {"image_id", "file_name", "decision", "final_label_status", "final_label", "graph_fusion_status", "graph_confidence"} and flow["final_label"]["structured_label"]["kind"] == "mermaid"
    assert set(cat) == {"image_id", "file_name", "decision", "final_label_status", "final_label"} and list(cat["final_label"]) == ["caption"]
    assert len(whole[flow["image_id"]]["model_outputs"]) == 3 and whole[flow["image_id"]]["graph_fusion"]["enabled"] and whole[cat["image_id"]]["graph_fusion"]["reason"] == "not flowchart"
