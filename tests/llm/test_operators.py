"""The corpus operators against brute force, on small fixtures with nulls, ties, repeated rows and long texts."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import bpe, bpe_codec, co_training, license_rules, lsh_forest, ngram_lm, packing, pii, quality_rules, rollups, threshold_topk
from tessera.llm.elias_fano import LEVELS, BigramTrie, EliasFano, encode_monotone, quantise
from tessera.llm.queries import tokenizer_file

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, kept string"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.fixture(scope="module")
def texts():
    r = random.Random(5)
    vocab = ["alpha", "Beta", "gamma", "délta", "the", "of", "and", "ß", "über", "中文", "x1", "don't", "#tag", "a|b"]
    base = [" ".join(r.choices(vocab, k=r.randint(1, 120))) for _ in range(30)]
    near = []
    for t in base[:8]:
        w = t.split()
        for _ in range(3):
            v = list(w)
            if v:
                v[r.randrange(len(v))] = "changed"
            near.append(" ".join(v))
    odd = [None, "", "   \n\t ", "one", "two words", "a b c d", "a b c d e", "x" * 5000, "word " * 4000, "line\nline\nline\n\nother", "tab\tsep\x0bvt nbsp　wide"]
    pii_ = ["mail a.b@c.de and +1 (269) 555-3296 4524132264652876.", "ip 1.2.3.4 300.1.1.1 1.2.3.4.5", "jane (at) example dot org"]
    lic = ["Licensed under the Apache License, Version 2.0.", "GNU General\nPublic License v3; MIT  license", "cc-by 4.0 <|endoftext|> end"]
    return base + near + base[:4] + odd + pii_ + lic


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, None if i % 7 == 0 else "en", f"s{i % 3}", None if t is None else len(t), "clash") for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[3], (None, "no id here", "en", "s0", 10, "clash")], COLUMNS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], COLUMNS)


def by_id(rows):
    return {r.doc_id: r for r in rows}


def test_bpe_equals_the_library(docs, texts, spark, none):
    from tokenizers import Tokenizer

    path = tokenizer_file()
    tool = Tokenizer.from_file(path)
    encoded = bpe_codec.encode(docs, path)
    got = by_id(encoded.collect())
    for i, t in enumerate(texts):
        assert got[i].ids == tool.encode(t or "", add_special_tokens=False).ids
    back = by_id(bpe_codec.decode(encoded, path).collect())
    assert all(back[i].text == (t or "") for i, t in enumerate(texts))
    assert bpe_codec.encode(none, path).count() == 0


def test_backtracking_alone_equals_the_library():
    from tokenizers import Tokenizer

    path = tokenizer_file()
    tool, vocab, r = Tokenizer.from_file(path), bpe.vocabulary(path), random.Random(2)
    for _ in range(300):
        piece = "".join(r.choices("abcdefghinorstu", k=r.randint(1, 60)))
        assert vocab.encode_piece(piece.encode()) == tool.encode(piece).ids == vocab.encode_pieces([piece.encode()])[0].tolist()


def test_packing(docs, texts, none):
    from tokenizers import Tokenizer

    tool, capacity = Tokenizer.from_file(tokenizer_file()), 64
    rows = packing.pack(docs, tokenizer_file(), capacity).collect()
    ids = {i: [*tool.encode(t or "", add_special_tokens=False).ids, 2] for i, t in enumerate(texts)}
    seen, fill = defaultdict(list), defaultdict(list)
    for r in rows:
        fill[r.sequence_id].append((r.offset, r.length))
        if r.doc_id is not None:
            part = ids[r.doc_id][r.start : r.start + r.length]
            assert len(part) == r.length and r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
            seen[r.doc_id].append((r.start, r.length))
    for i, own in ids.items():
        assert sum(n for _, n in seen[i]) == len(own) * (2 if i == 3 else 1)
        if len(own) <= capacity:
            assert len(seen[i]) == (2 if i == 3 else 1)
        else:
            assert all(n == capacity for s, n in seen[i] if s > 0)
    for placed in fill.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= capacity
    least = -(-sum(r.length for r in rows) // capacity)
    assert len(fill) <= 1.1 * least + 1
    assert packing.pack(none, tokenizer_file()).count() == 0


@pytest.mark.parametrize("setting", packing.SETTINGS[:3])
@pytest.mark.parametrize("kind", [lambda r: r.randint(1, 1024), lambda r: r.choice([500, 513, 300, 1024, 1]), lambda r: r.randint(342, 600)])
def test_plans_are_whole(kind, setting):
    r = random.Random(1)
    histogram = Counter(kind(r) for _ in range(700))
    rows, bins = packing.plan(dict(histogram), 1024, *setting)
    used, count = defaultdict(int), Counter()
    for size, _, n, sequence, _, stack in rows:
        count[size] += n
        for i in range(n):
            used[sequence + i // stack] += size
    assert count == histogram and max(used.values()) <= 1024 and sorted(used) == list(range(bins))


def test_quality_rules(docs, texts, none):
    got = by_id(quality_rules.judge(quality_rules.ledger(docs)).collect())
    for i, t in enumerate(texts):
        w, t = words(t), t or ""
        windows = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        many = Counter(windows)
        covered = {k + j for k, x in enumerate(windows) if many[x] > 1 for j in range(3)}
        lines = [x for x in t.split("\n") if words(x)]
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)))
        assert (r.n_dup_lines, r.n_repeat_words) == (len(lines) - len(set(lines)), len(covered))
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w)) and (not r.base_failed or not r.kept)
    judged = quality_rules.ledger(docs)
    whole = {r.rule: r for r in quality_rules.ablation(judged).collect()}
    assert whole["few_words"].failed == sum(r.n_words < 50 for r in judged.collect())
    assert quality_rules.judge(quality_rules.ledger(none)).count() == 0


def test_pii_base_spans(docs, texts, none):
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def brute(t):
        for kind, p in patterns.items():
            for m in re.finditer(p, t):
                d = re.sub("[^0-9]", "", m[0])
                ok = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")), "card": 13 <= len(d) <= 19 and pii.luhn(d), "phone": 9 <= len(d) <= 15}[kind]
                if ok:
                    yield kind, *m.span()

    r = random.Random(4)
    for _ in range(3000):
        t = "".join(r.choices(["1", "4", "12", ".", "+", " ", "-", "(", ")", "@", "a", "b.c", "256", "4111111111111111", "é", "\n", "٣"], k=r.randint(0, 25)))
        assert pii.base_spans(t) == list(brute(t))
    found = by_id(pii.find(docs, "spans string", lambda t, base, spans: (",".join(f"{k}:{t[a:b]}" for k, a, b in spans),)).collect())
    for i, t in enumerate(texts):
        assert set(f"{k}:{(t or '')[a:b]}" for k, a, b in brute(t or "")) <= set(found[i].spans.split(",")) | {""}
    at = texts.index("mail a.b@c.de and +1 (269) 555-3296 4524132264652876.")
    assert "card:4524132264652876" in found[at].spans and "email:a.b@c.de" in found[at].spans
    assert found[at + 2].spans == "email:jane (at) example dot org"
    assert pii.find(none, "spans string", lambda *_: ("",)).count() == 0


def test_semi_markov_accuracy_on_held_out_sentences():
    model, r = pii.fitted(), random.Random(99)
    made = [pii.example(r) for _ in range(300)]
    assert sum(model.decode(t, 0, len(t)) == gold for t, gold in made) > 0.95 * len(made)


def test_windows_find_what_the_whole_text_has(spark):
    model, r = pii.fitted(), random.Random(98)
    made = [pii.example(r) for _ in range(300)]
    whole = [set(model.decode(t, 0, len(t))) for t, _ in made]
    windows = [{s for a, b in pii.model_windows(t) for s in model.decode(t, a, b)} for t, _ in made]
    assert windows == whole
    texts = ["write to jane at example dot org", "call 2 6 9 5 5 5 3 2 9 6 now", *(t for t, _ in made)]
    found = by_id(pii.find(spark.createDataFrame([(i, t, "en", "s", 1, "x") for i, t in enumerate(texts)], COLUMNS), "spans string", lambda t, base, spans: (",".join(f"{k}:{a}:{b}" for k, a, b in spans),)).collect())
    assert found[0].spans == "email:9:32" and pii.model_windows(texts[1]) and not pii.model_windows("noon. Then 1 and 2")
    gold = [",".join(f"{k}:{a}:{b}" for k, a, b in own) for _, own in made]
    assert sum(found[i].spans == g for i, g in enumerate(gold, 2)) > 0.95 * len(made)


def test_licenses(docs, texts, none):
    got = by_id(license_rules.scan(docs).collect())
    for i, t in enumerate(texts):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
        places = [(k, label) for p, label in license_rules.PHRASES.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(w), len(places), min([k for k, _ in places], default=None), max([k for k, _ in places], default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in places})) and set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1
    assert len(license_rules.rules()) > 200 and license_rules.scan(none).count() == 0
    inner = license_rules.detect(b"creative commons attribution sharealike license 4.0")
    assert [x for x, *_ in inner] == ["cc-by-sa"]


def test_wrapped_license_notices(spark):
    notices = {f"This {kind} is free\n * software; you can redistribute it and/or modify it": label for kind, label in (("program", "gpl"), ("library", "lgpl"))}
    rows = [(i, t, "en", "s", 1, "x") for i, t in enumerate(notices)]
    got = by_id(license_rules.scan(spark.createDataFrame(rows, COLUMNS)).collect())
    assert [got[i].labels for i in range(2)] == list(notices.values()) and all(got[i].score > 0.9 for i in range(2))
    for label, keyword, phrase, *_ in license_rules.notices():
        assert any(not w.endswith("?") and all(keyword in x for x in w.split("/")) for w in phrase.split()), phrase
        text = " ".join(w.rstrip("?").split("/")[0].replace("#", "2.0") for w in phrase.split())
        assert label in [x for x, *_ in license_rules.detect(f"so {text} it says".encode())], phrase


def test_suppression_equals_comparing_with_all():
    r = random.Random(6)
    names = ["apache license", "gnu general public license", "version 2.0", "cc by sa", "licensed under the", "mit license", "creative commons attribution sharealike license", "all rights reserved", "x"]
    for _ in range(200):
        text = " ".join(r.choices(names, k=r.randint(1, 30))).encode()
        found = sorted((x.priority, m.start() - m.end(), m.start(), m.end(), x.label, x.confidence) for x in license_rules.rules() if x.keyword in text for m in x.pattern.finditer(text))
        taken = []
        for _, _, a, b, label, c in found:
            if not any(p <= a and b <= q for _, p, q, _ in taken):
                taken.append((label, a, b, c))
        assert license_rules.detect(text) == taken


def shingle_sets(texts):
    out = {}
    for i, t in enumerate(texts):
        w = words((t or "").translate(LOWER))
        out[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    return out


def test_near_duplicates(docs, texts, none):
    sets, root = shingle_sets(texts), {i: i for i in range(len(texts))}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in sets:
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    got = by_id(lsh_forest.near_duplicates(docs).collect())
    for i in sets:
        assert (got[i].n_shingles, got[i].component_id, got[i].kept) == (len(sets[i]), find(i), find(i) == i), i
    assert not got[None].kept and lsh_forest.near_duplicates(none).count() == 0


def dense_groups(groups, members):
    """Texts of groups on one template. The first two, of 24, have one true link: nine places differ between their first texts, ten or more between all others."""
    out = []
    for g in range(groups):
        for m in range(24 if g < 2 else members):
            w = [f"t76.{k}" for k in range(600)]
            for k in (0, 1, *range(2 + 4 * g, 6 + 4 * g)) if g < 2 else range(10):
                w[6 + 60 * max(g, 1) - 60 + 6 * k] = "both" if g < 2 and k < 2 else f"g{g}"
            for k in range((0, 1)[g] if g < 2 and not m else 2 if g < 2 else 1):
                w[12 + 60 * groups - 60 + 6 * ((2 * m + k) % 18)] = f"m{g}.{m}.{k}"
            out.append(" ".join(w))
    return out


def component_sets(texts, percent=85):
    sets = shingle_sets(texts)
    root = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if root[a] != root[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                lo, hi = sorted((root[a], root[b]))
                root = [lo if x == hi else x for x in root]
    return root


def test_near_duplicates_join_dense_groups(spark):
    made = dense_groups(8, 48)
    want = component_sets(made)
    got = by_id(lsh_forest.near_duplicates(spark.createDataFrame([(i, t, "en", "s", 1, "x") for i, t in enumerate(made)], COLUMNS)).collect())
    assert len(set(want)) == 7 and [got[i].component_id for i in range(len(made))] == want


def near_copies(n):
    """Texts of one template, each with two words of its own: all are linked at 0.85."""
    r = random.Random(5)
    out = []
    for i in range(n):
        w = [f"t{k}" for k in range(300)]
        for k in r.sample(range(10, 290), 2):
            w[k] = f"own{i}.{k}"
        out.append(" ".join(w))
    return out


def test_links_of_a_crowded_group_are_in_proportion_to_it(spark, monkeypatch):
    """One way through a group of near copies is enough: no multiple of its pairs is carried on."""
    real, seen = lsh_forest.components, []

    def counted(edges, *names):
        seen.append(edges.count())
        return real(edges, *names)

    monkeypatch.setattr(lsh_forest, "components", counted)
    made = near_copies(400)
    got = lsh_forest.near_duplicates(spark.createDataFrame([(i, t, "en", "s", 1, "x") for i, t in enumerate(made)], COLUMNS)).collect()
    assert {x.component_id for x in got} == {0} and len(got) == len(made)
    assert max(seen) <= 3 * len(made), seen


def test_every_pair_of_a_crowded_region_is_compared(spark):
    """3,000 signatures of one region; those that agree well are far apart in every order."""
    r = np.random.default_rng(11)
    sig = r.integers(0, 1 << 16, (3000, lsh_forest.MINIMA)).astype(np.uint16)
    for i in range(1500):
        sig[i + 1500, 16:] = sig[i, 16:]
    sig[:, : lsh_forest.DEPTH] = 7
    sig[:, lsh_forest.DEPTH + 1 : 16] = 9
    rows = [(0, sig[i].astype(">u2").tobytes(), i, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "tree int, order binary, node long, root long")
    least = lsh_forest.least_agreement(0.85)
    pairs = [(i, int(j)) for i in range(3000) for j in i + 1 + np.flatnonzero((sig[i + 1 :] == sig[i]).sum(axis=1) >= least)]
    sets = df.withColumn("set", F.expr("unhex(lpad(hex(node % 1500 + 1), 16, '0'))"))
    got = lsh_forest.in_regions(sets, lsh_forest.joining_links, ("a", "b"), 0.85, 85).collect()
    assert len(pairs) == 1500 and sorted((x.a, x.b) for x in got) == pairs
    flagged = lsh_forest.in_regions(df, lsh_forest.open_nodes, ("tree", "node"), 0.85, 85)
    assert flagged.count() == 3000
    old = lsh_forest.pairs_in_regions(df.select("tree", "order", "node").coalesce(1).sortWithinPartitions("order", "node"), least)
    assert old.select("a", "b").distinct().count() < 1500  # neighbours in the order alone are not all


def test_near_duplicates_with_more_partitions_than_rows(spark):
    r = random.Random(3)
    plain = [[f"w{r.randrange(10**6)}" for _ in range(60)] for _ in range(8)]
    rows = [(2 * i + k, " ".join([*w, *["tail"] * k]), "en", "s", 1, "x") for i, w in enumerate(plain) for k in (0, 1)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "400")
    try:
        nodes = lsh_forest.signed(spark.createDataFrame(rows, COLUMNS)).select(F.col("doc_id").alias("node"), "signature")
        pairs = {(x.a, x.b) for x in lsh_forest.candidates(lsh_forest.orders(nodes), 0.85).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert pairs == {(2 * i, 2 * i + 1) for i in range(8)}


def test_language_model(docs, texts, none):
    tokens = {i: [*words((t or "").translate(LOWER)), "</s>"] for i, t in enumerate(texts)}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in tokens}
    count, pairs = Counter(), Counter()
    for i, own in tokens.items():
        for _ in range(0 if held[i] else 2 if i == 3 else 1):
            count.update(own)
            pairs.update(zip(["<s>", *own], own, strict=False))
    n, v, types, before = sum(count.values()), len(count), Counter(a for a, _ in pairs), count | Counter({"<s>": count["</s>"]})
    got = by_id(ngram_lm.score(docs).collect())
    for i, own in tokens.items():
        base = [(count[w] + 0.1) / (n + 0.1 * (v + 1)) for w in own]
        full = sum(math.log10(max(pairs[a, w] - 0.75, 0) / before[a] + 0.75 * types[a] / before[a] * b if before[a] else b) for a, w, b in zip(["<s>", *own], own, base, strict=False))
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(own), sum(count[w] > 0 for w in own), n)
        assert abs(r.base_score - sum(map(math.log10, base))) < 1e-6 * max(1, abs(r.base_score)) and abs(r.score - full) < 0.05 * max(3, len(own))
    assert ngram_lm.score(none).count() == 0


def test_elias_fano(tmp_path):
    r = np.random.default_rng(1)
    for n, universe in ((5000, 10**6), (1, 1 << 62), (300, 40), (4000, 1 << 63)):
        values = np.sort(r.integers(0, universe, n, dtype=np.uint64)).astype(np.int64)
        seq = EliasFano(encode_monotone(values, universe))
        assert all((seq.slice(a, b) == values[a:b]).all() for a, b in ((0, n), (17, 18), (1023, 1025), (n - 10, n + 60)) if 0 <= a < n)
        asked = np.concatenate((values, values + 1, values - 1, r.integers(0, universe, 500, dtype=np.uint64).astype(np.int64)))
        asked = asked[asked >= 0]
        place, same = seq.successors(asked)
        assert (place == np.searchsorted(values, asked)).all() and (same == np.isin(asked, values)).all()
    assert [len(x) for x in EliasFano(encode_monotone(np.zeros(0, np.int64), 9)).successors(np.array([3]))] == [1, 1]
    c, w = np.unique(r.integers(0, 300, (4000, 2)), axis=0).T.astype(np.int64)
    p, weight = r.random(len(c)), r.random(len(np.unique(c)))
    BigramTrie.save(BigramTrie.build(c, w, p, weight), str(tmp_path / "t"))
    trie = BigramTrie.open(str(tmp_path / "t"))
    code, own = trie.find(c, w)
    assert (code == quantise(p)).all() and (own == quantise(weight)[np.searchsorted(np.unique(c), c)]).all()
    absent = np.array([(a, b) for a in range(300) for b in range(300) if (a, b) not in set(zip(c.tolist(), w.tolist(), strict=True))][:500])
    assert not trie.find(absent[:, 0], absent[:, 1])[0].any() and trie.find(np.array([10**6]), np.array([1]))[1] == 0
    assert (np.abs(np.log(LEVELS[quantise(p)] / p)) < 0.07).all() and LEVELS.max() == 1 and quantise(np.array([0.0])) == 0


def test_top_k(spark):
    r = np.random.default_rng(3)
    vectors = {i: r.normal(0, 1, 8).astype(np.float32).tolist() for i in range(300)}
    vectors |= {301: vectors[1], 302: vectors[1], 340: None, 360: [1.0, None] + [0.0] * 6, 380: [float("nan")] * 8, 400: [0.0] * 8}
    df = spark.createDataFrame([*vectors.items(), (None, vectors[1])], "vec_id long, embedding array<float>")
    whole = {i: [math.floor(64 * x) for x in v] for i, v in vectors.items() if v and all(x is not None and math.isfinite(x) for x in v)}
    want = []
    for qid in (i for i in whole if i % 20 == 0):
        scored = sorted((-sum(map(int.__mul__, whole[qid], v)), i) for i, v in whole.items() if i != qid)[:20]
        want += [(qid, k, i, -s) for k, (s, i) in enumerate(scored, 1)]
    got = threshold_topk.top_k(df, lambda i: i % 20 == 0).collect()
    assert sorted(map(tuple, got)) == sorted(want)
    assert threshold_topk.top_k(df.limit(0), lambda i: i % 20 == 0).count() == 0
    x = np.zeros((4096, 4), np.int64)
    x[:, 0] = np.arange(4096)
    assert threshold_topk.best_of(np.array([[5, 0, 0, 0]]), np.array([-1]), x, np.arange(4096), 3)[2] < 4096  # it stops early


def test_rollups(spark, tmp_path):
    rollup = rollups.Rollup(spark, f"file://{tmp_path}/r")
    schema = "doc_id long, tokenizer string, source string, lang string, op string, n_tokens long"
    batch = lambda *rows: spark.createDataFrame(rows, schema)
    first = batch((1, "t", "a", "en", "insert", 10), (2, "t", "a", None, "insert", 5), (3, "t", "b", "en", "insert", None), (None, "t", "b", "en", "insert", 7), (1, "t", "a", "en", "insert", 10))
    assert rollup.commit("1", first) and not rollup.commit("1", first)
    assert rollup.commit("2", batch((1, "t", "b", "en", "revise", 8), (2, "t", None, None, "delete", None), (9, "t", "a", "en", "delete", 3)))
    assert {(r.source, r.lang): (r.n_docs, r.n_tokens) for r in rollup.totals().collect()} == {("b", "en"): (2, 8)}
    assert not rollup.commit("2", first) and rollups.Rollup(spark, f"file://{tmp_path}/none").totals().count() == 0


def test_co_training(spark, none):
    r = random.Random(1)
    good = lambda: " ".join(r.choices(["the", "house", "river", "of", "and", "walked", "slowly", "under"], k=80))
    bad = lambda: " ".join(w + r.choice(["***", "###", "$$$"]) for w in r.choices(["buy", "now", "win"], k=80))
    rows = [(i, (good if i % 3 else bad)(), "en", "good" if i % 3 else "spam", 400, "x") for i in range(600)]
    docs = spark.createDataFrame([*rows, (999, None, None, None, None, None)], COLUMNS)
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(450)], "doc_id long, quality int")
    model = co_training.fit(docs, labels)
    assert model.usable and all(sum(h[v] for h in model.history) > 0 for v in (0, 1))  # each view has labelled for the other
    got = by_id(co_training.score(docs, model).collect())
    assert all(got[i].kept_ == (i % 3 > 0) and got[i].kept == "x" for i in range(600)) and 999 in got
    empty = co_training.fit(docs, labels.limit(0))
    assert not empty.usable and all(r.kept_ for r in co_training.score(docs, empty).collect())
    assert co_training.score(none, model).count() == 0


def test_round_trip_digests(docs, texts):
    made = bpe_codec.round_trip(docs, tokenizer_file(), "h string", lambda ids, at, decoded: {"h": [hashlib.sha256(x).hexdigest() for x in decoded]})
    got = by_id(made.collect())
    assert all(got[i].h == hashlib.sha256((t or "").encode()).hexdigest() for i, t in enumerate(texts))


def test_pipeline_stages(spark, texts, tmp_path):
    import corpus_pipeline

    r = random.Random(8)
    vocab = [f"w{k}" for k in range(400)]
    clean = [" ".join(r.choices(vocab, k=120)) + " mail a.b@c.de" for _ in range(12)]
    rows = [(i, t, "en", "s", len(t or ""), "clash") for i, t in enumerate([*clean, clean[0], clean[1] + " tail", "short", None])]
    docs = spark.createDataFrame(rows, COLUMNS)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "kept"], name
    left = {x.doc_id: x for x in docs.collect()}
    assert sorted(left) == list(range(12)) and all(x.text.endswith("mail <EMAIL>") and x.n_chars == len(x.text) and x.kept == "clash" for x in left.values())
    packed = corpus_pipeline.best_fit_packing(spark, docs, str(tmp_path))
    assert packed.select("doc_id").distinct().count() == 12 and packed.filter(F.col("length") > 1024).count() == 0


def test_pipeline_near_duplicates_from_four_fifths(spark, tmp_path):
    import corpus_pipeline

    w = [f"w{k}" for k in range(204)]
    near = list(w)
    for k in (30, 80, 130, 180):
        near[k] = "changed"
    assert 0.80 < len(shingle_sets([" ".join(w)])[0] & shingle_sets([" ".join(near)])[0]) / 220 < 0.85
    docs = spark.createDataFrame([(0, " ".join(w), "en", "s", 1, "x"), (1, " ".join(near), "en", "s", 1, "x")], COLUMNS)
    assert [r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, str(tmp_path)).collect()] == [0]
