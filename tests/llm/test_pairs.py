"""Near duplicates, components, decontamination and the pipeline against brute force."""

import random
import re
import time
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from sievewright.llm import decontam, minhash, queries
from sievewright.llm.common import Workspace
from sievewright.llm.components import components
from tests.llm.helpers import documents, edge_docs, edge_rows, empty_docs


def _sets(texts, width):
    out = {}
    for i, t in texts.items():
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if x]
        out[i] = frozenset(tuple(w[k : k + width]) for k in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])
    return out


def _classes(texts, width, numerator):
    """doc_id -> (set size, smallest reachable doc_id), over all pairs that share a shingle."""
    sets, parent = _sets(texts, width), {i: i for i in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    pairs = {(a, b) for own in holders.values() for a in own for b in own if a < b}
    for a, b in pairs:
        common = len(sets[a] & sets[b])
        if 100 * common >= numerator * (len(sets[a]) + len(sets[b]) - common):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in texts}


def _near_copies(seed=6):
    """Groups whose members differ by one to many words, chains of copies of copies, and unrelated texts that share a passage."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(400)]
    made = lambda n: [rng.choice(words) for _ in range(n)]
    texts, passage = [], made(40)
    for _ in range(12):
        base = made(rng.randint(30, 120))
        for _ in range(rng.randint(2, 12)):
            copy = list(base)
            for _ in range(rng.randint(0, 6)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(copy)
        last = base
        for _ in range(6):
            last = list(last)
            last[rng.randrange(len(last))] = rng.choice(words)
            texts.append(last)
    texts += [passage + made(rng.randint(0, 30)) for _ in range(60)]
    texts += [made(rng.randint(1, 4)) for _ in range(30)] + [texts[0]] * 20
    rng.shuffle(texts)
    return {i: " ".join(t) for i, t in enumerate(texts)}


@pytest.mark.parametrize("width, numerator", [(3, 85), (5, 80)])
def test_near_duplicates_against_all_pairs(spark, width, numerator):
    texts = _near_copies(width)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    rows = minhash.near_duplicates(spark, docs, minhash.Plan(words=width, numerator=numerator)).collect()
    want = _classes(texts, width, numerator)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want and len(rows) == len(want)
    assert all(r.kept == r.representative == (r.doc_id == r.component_id) for r in rows if texts[r.doc_id] != texts[r.component_id])
    assert sum(r.kept for r in rows) == len({c for _, c in want.values()})


def test_near_duplicates_of_documents(spark):
    texts = {r.doc_id: r.text for r in documents(spark).collect()}
    rows = queries.op3_near_duplicates(spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == _classes(texts, 3, 85)


def test_near_duplicates_of_odd_rows(spark):
    rows = minhash.near_duplicates(spark, edge_docs(spark), minhash.Plan(words=3, numerator=85)).collect()
    assert len(rows) == len(edge_rows())
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert all(by[i].n_shingles == 0 and by[i].kept and by[i].component_id == i for i in (1, 2, 3))
    assert by[4].n_shingles == 1 and by[6].component_id == 5 and not by[6].kept and by[8].component_id == 8
    assert [r.component_id for r in rows if r.doc_id is None] == [None, None]
    assert minhash.near_duplicates(spark, empty_docs(spark)).count() == 0


def test_a_missing_id_takes_its_groups(spark):
    docs = spark.createDataFrame([(None, "a b c d e f"), (3, "a b c d e f"), (None, "x y z u v")], "doc_id long, text string")
    rows = {(r.doc_id, r.n_shingles): r for r in minhash.near_duplicates(spark, docs, minhash.Plan(words=3)).collect()}
    assert rows[None, 4].component_id == 3 and not rows[None, 4].kept and rows[3, 4].kept
    assert rows[None, 3].component_id is None and rows[None, 3].kept
    assert [rows[k].representative for k in ((None, 4), (3, 4), (None, 3))] == [True, False, True]


def test_signatures_match_as_often_as_sets_do():
    plan, rng = minhash.Plan(words=3, numerator=85, miss=1e-20), np.random.default_rng(7)
    sign = minhash.Signer(plan)
    a = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
    b = np.concatenate([a[:800], rng.integers(0, 1 << 63, 200, dtype=np.uint64)])
    share = (sign(a) == sign(b)).mean()
    assert abs(share - 800 / 1200) < 0.1 and plan.permutations * 2 >= plan.bands * plan.rows
    d = np.unpackbits((minhash.odd_sketch(a, 2048) ^ minhash.odd_sketch(b, 2048)).view(np.uint8)).sum()
    assert 300 < d <= 400


def test_bands_miss_as_rarely_as_asked():
    for plan in (minhash.Plan(), minhash.Plan(words=3, numerator=85)):
        t = plan.numerator / plan.denominator
        assert (1 - t**plan.rows) ** plan.bands <= plan.miss


@pytest.mark.parametrize("kind", ["chain", "star", "random", "none"])
def test_components(spark, kind):
    rng = random.Random(8)
    edges = {
        "chain": [(i, i + 1) for i in range(60)],
        "star": [(30, i) for i in range(60) if i != 30],
        "random": [(rng.randrange(80), rng.randrange(80)) for _ in range(60)],
        "none": [],
    }[kind]
    parent = {x: x for e in edges for x in e}

    def find(x):
        return x if parent[x] == x else find(parent[x])

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    found = components(Workspace(spark, "test"), spark.createDataFrame(edges, "a long, b long")).collect()
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert {r.node: r.comp for r in found} == {x: find(x) for x in nodes} and len(found) == len(nodes)


# decontamination


def _slow_tiles(item, doc, least):
    """Greedy string tiling by trying all pairs of starts."""
    in_item, in_doc, tiles = [False] * len(item), [False] * len(doc), []
    while True:
        best = []
        longest = least
        for p in range(len(item)):
            for q in range(len(doc)):
                k = 0
                while p + k < len(item) and q + k < len(doc) and item[p + k] == doc[q + k] and not in_item[p + k] and not in_doc[q + k]:
                    k += 1
                if k > longest:
                    longest, best = k, [(p, q)]
                elif k == longest:
                    best.append((p, q))
        if not best:
            return tiles
        for p, q in best:
            if not any(in_item[p : p + longest]) and not any(in_doc[q : q + longest]):
                in_item[p : p + longest] = [True] * longest
                in_doc[q : q + longest] = [True] * longest
                tiles.append((p, q, longest))


def test_tiling_against_all_pairs():
    rng, number = random.Random(9), decontam.Numbers()
    for _ in range(150):
        words = [f"w{i}" for i in range(rng.choice((1, 2, 3, 12, 60)))]
        item = [rng.choice(words) for _ in range(rng.randint(3, 25))]
        doc = [rng.choice(words) for _ in range(rng.randint(0, 20))]
        for _ in range(3):
            a, at = rng.randrange(len(item)), rng.randint(0, len(doc))
            doc[at:at] = item[a : a + rng.randint(3, 10)]
        one, two = number(" ".join(item)), number(" ".join(doc))
        found = decontam.matches(one, two, decontam.running(one, 3), decontam.running(two, 3), 3)
        want = _slow_tiles(item, doc, 3)
        assert decontam.tile(found, 3, len(item)) == want
        share = sum(n for *_, n in want) / len(item)
        covered = decontam.Block([(1, " ".join(item))], 3, 0.4).covered(two)
        assert covered == ([(pytest.approx(share), [1], len(want))] if share >= 0.4 else [])


def test_repeated_words_and_shared_seeds_are_cheap():
    number = decontam.Numbers()
    began = time.time()
    assert decontam.Block([(1, "spam " * 2000)], 5, 0.6).covered(number("spam " * 2000)) == [(1.0, [1], 1)]
    assert decontam.Block([(1, "a b c " * 700)], 5, 0.6).covered(number("x " + "a b c " * 5000)) == [(1.0, [1], 1)]
    assert time.time() - began < 2
    shared = decontam.Block([(i, "one of the most used " + " ".join(f"q{i}x{k}" for k in range(8))) for i in range(20_000)], 5, 0.6)
    began = time.time()
    assert shared.covered(number("this is one of the most used words")) == []
    assert [own for _, own, _ in shared.covered(number("one of the most used " + " ".join(f"q77x{k}" for k in range(8))))] == [[77]]
    assert time.time() - began < 1


def test_punctuation_short_and_equal_items(spark):
    benchmark = spark.createDataFrame([(1, "It's one - two\u2014three, four"), (2, "big cat"), (3, "BIG cat!"), (4, "\u2026"), (5, "r\u00f6te f\u00e4rbt die wolken am abend")], "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, "so: it\u2019s one\u2014two \u201cthree\u201d four."), (2, "the big cat sat"), (3, "big dog cat"), (4, "R\u00d6TE\u2014f\u00e4rbt die wolken; am Abend"), (5, "\u2026 \u2014")], "doc_id long, text string"
    )
    found = {r.doc_id: (r.item_id, r.coverage, r.tiles, r["items"]) for r in decontam.flag(docs, benchmark).collect()}
    assert found == {1: (1, 1.0, 1, 1), 2: (2, 1.0, 1, 2), 3: (None, 0.0, 0, 0), 4: (5, 1.0, 1, 1), 5: (None, 0.0, 0, 0)}


def test_reordered_and_partial_passages(spark):
    rng = random.Random(10)
    word = lambda: "".join(rng.choice("abcdefghijk") for _ in range(6))
    items = [(i, " ".join(word() for _ in range(30))) for i in range(20)]
    w = items[3][1].split()
    docs = [
        (1, " ".join([word(), word(), *w, word()])),
        (2, " ".join([*w[20:], word(), *w[10:20], word(), *w[:10]]).upper()),
        (3, " ".join([word(), *w[:8], word()])),
        (4, " ".join(word() for _ in range(200))),
        (5, None),
        (6, ""),
    ]
    for block_words, at_once in ((2_000_000, 4), (40, 3)):
        found = {
            r.doc_id: r
            for r in decontam.flag(
                spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, items int, coverage string"),
                spark.createDataFrame([*items, (99, None), (98, "too short")], "item_id long, text string"),
                block_words=block_words,
                at_once=at_once,
            ).collect()
        }
        assert [found[i]["items"] for i in range(1, 7)] == [1, 1, 0, 0, 0, 0]
        assert found[1].coverage == found[2].coverage == 1.0 and found[2].tiles == 3 and found[2].item_id == 3
        assert found[3].coverage == found[4].coverage == 0


def test_decontamination_finds_what_documents_hold(spark):
    sf = "/root/testdata/sf0.01"
    words = lambda t: " " + " ".join(re.findall(r"[^\W_]+", t.lower())) + " "
    items = [words(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    holds = {r.doc_id for r in documents(spark, "sf0.01").collect() if any(i in words(r.text) for i in items)}
    assert {r.doc_id for r in queries.op10_decontamination(spark, sf).collect() if r.contaminated} == holds


def test_decontamination_of_odd_rows(spark):
    benchmark = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    rows = decontam.flag(edge_docs(spark), benchmark).collect()
    assert len(rows) == len(edge_rows()) and {r.doc_id for r in rows if r["items"]} == {5, 6}
    assert decontam.flag(empty_docs(spark), benchmark).count() == 0
    assert decontam.flag(edge_docs(spark), benchmark.limit(0)).where("coverage > 0").count() == 0


# pipeline


def test_pipeline_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    work = Workspace(spark, "test-pipeline")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = work.table(stage(spark, before, small), name)
        assert after.columns == docs.columns
        was, now = {r.doc_id for r in before.collect()}, {r.doc_id for r in after.collect()}
        gone = was - now
        assert now <= was
        if name == "language":
            assert all(not re.search(r"[^\W\d_]", texts[i] or "") for i in gone)
        if name == "quality":
            assert sum(quality.get(i) == 1 for i in gone) <= 2
        if name == "near_duplicates":
            want = _classes({i: texts[i] for i in was}, 5, 80)
            assert now == {c for _, c in want.values()}
        before = after
    rows = corpus_pipeline.run(spark, small).collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in before.collect()}


def test_pipeline_of_odd_rows(spark, small):
    before = edge_docs(spark)
    own = {r.doc_id: r for r in before.collect()}
    for docs in (before, before.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            docs = Workspace(spark, "odd").table(stage(spark, docs, small), "x")
            assert name == "packing" or docs.columns == before.columns and all(own[r.doc_id] == r for r in docs.collect() if r.doc_id not in (6, None))
            if name == "near_duplicates":
                kept = [r.doc_id for r in docs.collect()]
                assert len(kept) == len(set(kept)) and not {5, 6} <= set(kept)
        assert docs.columns[:2] == ["doc_id", "piece"]
