"""Language, toxicity, quality and URL models: slow reference versions, held-out accuracy, odd rows."""

import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sievewright.llm import langid, quality, queries, toxicity, urlfilter
from sievewright.llm.common import Workspace
from tests.llm.helpers import LONG, documents, edge_docs, edge_rows, empty_docs

# language


def _slow_trees(texts, order):
    """lang -> {context: {byte: count}} by plain dictionaries."""
    trees = {}
    for lang, own in texts.items():
        tree = defaultdict(Counter)
        for data in (b" " * order + langid.plain(t) + b" " for t in own):
            for at in range(order, len(data)):
                for k in range(order + 1):
                    tree[data[at - k : at]][data[at]] += 1
        trees[lang] = tree
    return trees


def _slow_bits(tree, text, order):
    data, bits = b" " * order + langid.plain(text), 0.0
    for at in range(order, len(data)):
        for k in range(order, -2, -1):
            if k < 0:
                bits += 8
                break
            seen = tree.get(data[at - k : at])
            if not seen:
                continue
            total, kinds = sum(seen.values()), len(seen)
            if data[at] in seen:
                bits -= math.log2(seen[data[at]] / (total + kinds))
                break
            bits -= math.log2(kinds / (total + kinds))
    return bits


def test_code_lengths_are_exact(spark):
    texts = {"en": ["the cat sat on the mat", "a rat, the other cat"], "de": ["die katze saß auf der matte", "über den hund"]}
    rows = [(t, lang) for lang, own in texts.items() for t in own]
    trees = langid.train(spark.createDataFrame(rows, "text string, lang string").coalesce(1), order=3)
    slow = _slow_trees(texts, 3)
    probes = ["the hat", "katze über", "zzz qqq", "Überßat é 12 the", "a", "the cat " * 30]
    made = trees.bits([langid.plain(p) for p in probes])
    for probe, row in zip(probes, made, strict=True):
        want = [_slow_bits(slow[lang], probe, 3) for lang in trees.languages]
        assert row == pytest.approx(want, rel=1e-9)


def test_statistics_do_not_depend_on_the_layout(spark):
    docs = documents(spark, "sf0.01").select("doc_id", "text", "lang")
    probes = [langid.plain(r.text) for r in docs.limit(50).collect()]
    one, many = (langid.train(docs.repartition(n).select("text", "lang")) for n in (1, 211))
    assert (one.bits(probes) == many.bits(probes)).all()


def test_long_texts_are_coded_whole():
    counts = langid.pd.DataFrame([("en", k + 1, int.from_bytes(b"abab"[3 - k : 4]), 5) for k in range(4)], columns=["lang", "size", "gram", "n"])
    trees = langid.Trees(["en"], 3, counts)
    text = b"ab" * langid._CHUNK
    whole = trees.bits([text])[0, 0]
    assert whole == pytest.approx(trees.bits([text[: len(text) // 2]])[0, 0] * 2, rel=1e-3)


def test_index_finds_all_and_only_its_keys():
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(0, 1 << 32, 5000, dtype=np.uint64))
    index = langid.Index(keys)
    assert (index(keys) == np.arange(len(keys))).all()
    others = np.setdiff1d(rng.integers(0, 1 << 32, 5000, dtype=np.uint64), keys)
    assert (index(others) == -1).all() and len(langid.Index(np.empty(0, np.uint64))(others)) == len(others)


def test_languages_of_held_out_documents(spark, small):
    lang = {r.doc_id: r.lang for r in documents(spark).collect()}
    rows = queries.op4_language_id(spark, small).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(lang) and len(held) > 40
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) >= 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_languages_of_odd_rows(spark):
    docs = edge_docs(spark)
    trees = langid.train(docs.select("text", "lang"))
    rows = langid.predict(docs, trees).collect()
    assert len(rows) == len(edge_rows()) and trees.languages == ["de", "en", "xx"]
    und = [r for r in rows if r.lang_pred == "und"]
    assert {r.doc_id for r in und} == {None, 1, 2, 3, 9} and all(r.score == 0 for r in und)
    assert langid.predict(empty_docs(spark), trees).count() == 0
    nothing = langid.train(empty_docs(spark).select("text", "lang"))
    assert {r.lang_pred for r in langid.predict(docs, nothing).collect()} == {"und"}


# toxicity


def _toxic_rows(n=600):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6))) for _ in range(rng.randint(5, 60))]
        grade = rng.choice((0, 0, 0, 1, 2))
        for _ in range((0, 1, 5)[grade]):
            words.insert(rng.randrange(len(words)), rng.choice(("vilename", "scumbag", "worthless")))
        rows.append((i, " ".join(words), grade))
    return rows


def test_severity_follows_the_grades(spark):
    rows = _toxic_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, grade int")
    model = toxicity.train(spark, docs.where("doc_id < 450").select("text", "grade"))
    assert len(model.thresholds) == 2 and model.thresholds[0] < model.thresholds[1]
    found = toxicity.predict(docs.drop("grade"), model).collect()
    grade = {i: g for i, _, g in rows}
    held = [r for r in found if r.doc_id >= 450]
    mean = [np.mean([r.severity for r in held if grade[r.doc_id] == g]) for g in range(3)]
    assert mean[0] < 0.3 < mean[1] < mean[2]
    assert np.mean([(r.score >= 0.5) == (grade[r.doc_id] > 0) for r in held]) > 0.95
    for r in found:
        assert 0 <= r.severity <= 2


def test_fit_lowers_the_ordinal_loss():
    rows = [np.array([g]) if g else np.empty(0, np.int64) for g in (0, 0, 0, 1, 1, 2, 2, 2)]
    grades = np.array([0, 0, 0, 1, 1, 2, 2, 2])
    w, theta = toxicity.fit(rows, grades, 3, 3)
    above = 1 / (1 + np.exp(theta[None, :] - np.array([w[r].sum() for r in rows])[:, None]))
    edges = np.hstack([np.ones((8, 1)), above, np.zeros((8, 1))])
    assert ((edges[:, :-1] - edges[:, 1:]).argmax(axis=1) == grades).all()


def test_toxicity_of_held_out_documents(spark):
    rows = queries.op2_toxicity_ordinal(spark, "/root/testdata/sf0.1").collect()
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    held = [r for r in rows if r.held_out and r.doc_id in toxic]
    caught = [r.predicted for r in held if toxic[r.doc_id]]
    false = [r.predicted for r in held if not toxic[r.doc_id]]
    assert np.mean(caught) >= 0.9 and np.mean(false) <= 0.02


def test_scores_against_plain_sums(spark):
    """A model's scores, grades and severities from its weights, by counting every feature of every distinct word."""
    rows = _toxic_rows(200) + [(1000, "vilename " * 20000, 2), (1001, None, 0), (1002, "", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, grade int")
    model = toxicity.train(spark, docs.where("doc_id < 1000").select("text", "grade"))
    weight = dict(zip(model.chosen.tolist(), model.weights.tolist(), strict=True))
    for r in toxicity.predict(docs, model).collect():
        text = rows[[i for i, *_ in rows].index(r.doc_id)][1] or ""
        total = sum(weight.get(f, 0.0) for w in set(re.findall(r"[^\W\d_]+", text.lower())) for f in {xxhash.xxh32_intdigest(x) % (1 << 20) for x in toxicity.strings(w)})
        above = [1 / (1 + math.exp(t - total)) for t in model.thresholds]
        p = [a - b for a, b in itertools.pairwise([1.0, *above, 0.0])]
        assert (r.severity, r.score) == (pytest.approx(sum(above)), pytest.approx(above[0])) and p[r.grade] == pytest.approx(max(p))


def test_severity_grades(spark):
    frame = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, 0), (1, None), (None, 0)], "toxic int, quality int")
    assert [r[0] for r in frame.select(toxicity.severity_grades(frame.toxic, frame.quality)).collect()] == [0, 0, 2, 1, 2, None]


def test_toxicity_of_odd_rows(spark):
    docs = edge_docs(spark)
    labels = spark.createDataFrame([(1, 1), (5, 1), (5, 0), (4, 0), (None, 1), (99, 0)], "doc_id long, grade int")
    model = toxicity.train(spark, toxicity.labelled(spark, docs, labels))
    assert toxicity.predict(docs, model).count() == len(edge_rows())
    assert toxicity.predict(empty_docs(spark), model).count() == 0
    none = toxicity.train(spark, toxicity.labelled(spark, empty_docs(spark), labels.limit(0)))
    assert {r.severity for r in toxicity.predict(docs, none).collect()} == {0.0}


# quality


def test_quality_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [r for r in queries.op6_quality_pu(spark, sf).collect() if r.held_out and r.doc_id in label]
    pairs = [(a.score, b.score) for a, b in itertools.product(held, held) if label[a.doc_id] > label[b.doc_id]]
    assert np.mean([a > b for a, b in pairs]) > 0.97
    assert np.mean([r.predicted == label[r.doc_id] for r in held]) > 0.95


def _local(positive, unlabelled):
    """Sums over rows in memory, in parts."""
    x = np.vstack([np.hstack([np.vstack([positive, unlabelled]), np.ones((len(positive) + len(unlabelled), 1))])])
    p = np.arange(len(x)) < len(positive)
    return lambda f: [sum(parts) for parts in zip(*(f(x[k::3], p[k::3]) for k in range(3)), strict=True)]


def _risk(w, positive, unlabelled, prior, decay=1e-4):
    f, g = positive @ w[:-1] + w[-1], unlabelled @ w[:-1] + w[-1]
    inner = np.logaddexp(0, g).mean() - prior * np.logaddexp(0, f).mean()
    return prior * np.logaddexp(0, -f).mean() + max(0.0, inner) + decay / 2 * (w[:-1] ** 2).sum(), inner


def test_risk_is_smallest_and_needs_no_negatives():
    rng = np.random.default_rng(5)
    positive = rng.normal(1.0, 1, (400, 2))
    unlabelled = np.vstack([rng.normal(1.0, 1, (300, 2)), rng.normal(-1.0, 1, (300, 2))])
    w = quality.minimise(_local(positive, unlabelled), 3, 0.5, 400, 600)
    least, inner = _risk(w, positive, unlabelled, 0.5)
    assert inner > 0 and all(_risk(w + rng.normal(0, s, 3), positive, unlabelled, 0.5)[0] > least - 1e-6 for s in (1e-3, 0.03, 0.3) for _ in range(200))
    f = unlabelled @ w[:2] + w[2]
    assert (f[:300] > 0).mean() > 0.85 and (f[300:] < 0).mean() > 0.85


def test_the_inner_risk_stays_non_negative():
    # far fewer positives among the unlabelled than the prior says: the unclamped risk falls below zero
    rng = np.random.default_rng(6)
    positive, unlabelled = rng.normal(2, 1, (300, 4)), np.vstack([rng.normal(2, 1, (30, 4)), rng.normal(-2, 1, (570, 4))])
    free, held = (quality.minimise(_local(positive, unlabelled), 5, 0.6, 300, 600, clamp=c) for c in (False, True))
    assert _risk(free, positive, unlabelled, 0.6)[1] < 0 <= _risk(held, positive, unlabelled, 0.6)[1]
    assert _risk(held, positive, unlabelled, 0.6)[0] < _risk(np.zeros(5), positive, unlabelled, 0.6)[0]


@pytest.mark.parametrize("share", [0.1, 0.5, 0.85])
def test_the_prior_of_a_known_mixture(share):
    rng = np.random.default_rng(8)
    n = 20_000
    positive, ones = rng.normal(1.5, 1, (5000, 3)), int(n * share)
    unlabelled = np.vstack([rng.normal(1.5, 1, (ones, 3)), rng.normal(-1.5, 1, (n - ones, 3))])
    w = quality.apart(_local(positive, unlabelled), 4, 5000, n)
    bins = [np.histogram(1 / (1 + np.exp(-(x @ w[:3] + w[3]))), bins=1024, range=(0, 1))[0] for x in (positive, unlabelled)]
    assert quality.prior_of(*bins) == pytest.approx(share, abs=0.03)
    assert quality.prior_of(bins[0] * 0, bins[1]) == 0.5


def test_quality_does_not_depend_on_the_layout(spark):
    docs = documents(spark, "sf0.01").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    models = [quality.train(spark, Workspace(spark, "layout").table(quality.vectors(docs.repartition(n)), "v"), labels) for n in (1, 7)]
    assert models[0].prior == pytest.approx(models[1].prior, abs=1e-3) and 0.8 < models[0].prior < 0.9
    assert np.allclose(models[0].weights, models[1].weights, atol=0.05)


def test_quality_of_odd_rows(spark):
    docs = quality.vectors(edge_docs(spark))
    labels = spark.createDataFrame([(4, 1), (5, 1), (9, 0), (6, 1), (6, 0), (None, 1)], "doc_id long, label int")
    rows = quality.score(docs, quality.train(spark, docs, labels)).collect()
    assert len(rows) == len(edge_rows()) and all(0 <= float(r.score) <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2)}) == 1
    empty = quality.vectors(empty_docs(spark))
    assert quality.score(empty, quality.train(spark, docs, labels)).count() == 0
    assert 0 < quality.train(spark, docs, labels.where("label = 1")).prior < 1
    for nothing in (quality.train(spark, empty, labels), quality.train(spark, docs, labels.where("label = 0"))):
        assert {r.score for r in quality.score(docs, nothing).collect()} == {0.5}


def _slow_features(text):
    raw = (text or "").encode()
    if not raw:
        return np.zeros(quality.N_FEATURES)
    n, words, lines = len(raw), raw.split(), raw.split(b"\n")
    m, sizes = max(1, len(words)), [len(w) for w in words] or [0]
    upper = sum(65 <= c <= 90 for c in raw)
    letters = max(1, upper + sum(97 <= c <= 122 for c in raw))
    same = sum(a == b for a, b in itertools.pairwise(words))
    lone = sum(len(w) == 1 and not w.isalnum() for w in words)
    ends = [w.strip(b".,;:!?\"'()") for w in words]
    odd = sum(bool(w) and 33 <= w[-1] < 127 and not w[-1:].isalnum() for w in ends)
    shape = [
        upper / letters, sum(48 <= c <= 57 for c in raw) / n, sum(c > 127 for c in raw) / n, raw.count(b" ") / n, raw.count(b"\n") / m, len(set(words)) / m, len(set(words)) / m**0.5,
        same / m, (same / m) ** 0.5, lone / m, len(set(itertools.pairwise(words))) / m, odd / m, np.mean(sizes) / 10, np.std(sizes) / 10, max(sizes) ** 0.5 / 10, math.log1p(m) / 10,
        len({x for x in lines if x}) / len(lines), math.log1p(max(map(len, lines))) / 10, float(bool(words)),
    ]
    return np.array([*((raw.count(bytes([c])) / m) ** 0.5 for c in quality._PUNCT), *shape])


def test_features_against_plain_counts(spark):
    odd = [None, "", " \n\t ", "a", "!!", "(a) \"b\" c: d# e#. ...", "x x x y", "\x0b a\x0cb \x1c c", "ß ß é", LONG]
    for text in [*odd, *(r.text for r in documents(spark).limit(60).collect())]:
        assert np.allclose(quality.features(text), _slow_features(text)), text


# URLs


def _split_host(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    name, tail = rest[:end], rest[end:]
    cut = min([tail.find(c) for c in "?#" if c in tail], default=len(tail))
    return "".join(c.lower() if c.isascii() else c for c in name), tail[:cut]


def _rule(name, path, rules=urlfilter.RULES):
    fits = [r for _, r in rules if (name == r[: r.index("/")] or name.endswith("." + r[: r.index("/")])) and path.startswith(r[r.index("/") :])]
    return max(fits, key=len, default=None)


ODD_URLS = [
    None, "", "no scheme", "http://", "HTTP://EXAMPLE.NET/EN/x", "http://example.net/en", "http://net/", "http://a.net", "http://x.net?y=/z", "ftp://Y.ORG/fr/#://q",
    "http://example.com/de/1", "http://notexample.com/de/1", "http://org/fr/", "http://www.cheappills.com/", "http://casinowin.com/a", "http://ÄÖ.net/ü", "a\nhttp://b.net/\nc",
    "http://" + "spam" * 3000 + ".com/",
]


def test_urls_against_plain_rules(spark, small):
    verdicts = {r: v for v, r in urlfilter.RULES}
    pages = spark.read.parquet(f"{small}/pages.parquet")
    urls = {r.page_id: r.url for r in pages.collect()}
    for r in queries.op7_url_filter(spark, small).collect():
        assert (r.host, r.path) == _split_host(urls[r.page_id])
        assert r.rule == _rule(r.host, r.path)
        assert r.verdict == (verdicts[r.rule] if r.rule else "block" if r.score > 0.5 else "allow")


def test_odd_urls(spark):
    frame = spark.createDataFrame([(i, u, "<p>spam words of cheap pills, casino win</p>", "x", 1, "mine") for i, u in enumerate(ODD_URLS)], "page_id long, url string, html string, host string, score int, _judged string")
    rows = urlfilter.judge(frame).collect()
    assert len(rows) == len(ODD_URLS)
    for r in rows:
        assert (r.host, r.path) == _split_host(ODD_URLS[r.page_id]) and r.rule == _rule(r.host, r.path)
    assert {r._judged for r in rows} == {"mine"}
    words = {r.page_id: r.words for r in rows}
    assert "h:cheap h:pills" in words[13] and "h:casino h:win" in words[14]
    assert urlfilter.judge(frame.limit(0)).count() == 0


def _brute_scores(urls, html):
    """page -> P(block): plain dictionaries, a quadratic Viterbi, naive Bayes from the rules' verdicts."""
    words = Counter(w for h in html.values() if h for w in re.findall(r"[^\W\d_]+", re.sub(r"<[^>]*>", " ", h).lower()))
    total = sum(words.values()) + 1

    def split(run):
        best = [(0.0, [])]
        for end in range(1, len(run) + 1):
            options = []
            for start in range(end):
                piece = run[start:end]
                cost = math.log(total / words[piece]) if piece in words else math.log(total) + math.log(10) * len(piece)
                options.append((best[start][0] + cost, start, piece))
            cost, start, piece = min(options)
            best.append((cost, [*best[start][1], piece]))
        return best[-1][1]

    def tokens(name, path):
        return [f"{m}:{w}" for m, t in (("h", name), ("p", path)) for run in re.findall(r"[^\W\d_]+|\d+", t.lower()) for w in (["0"] if run.isdigit() else split(run))]

    verdicts, counts, pages = {r: v for v, r in urlfilter.RULES}, {"allow": Counter(), "block": Counter()}, Counter()
    for url in urls.values():
        name, path = _split_host(url)
        if rule := _rule(name, path):
            of, _, start = rule.partition("/")
            counts[verdicts[rule]].update(tokens(name[: len(name) - len(of)], path[len(start) + 1 :]))
            pages[verdicts[rule]] += 1
    kinds = set(counts["allow"]) | set(counts["block"])
    size = {v: sum(c.values()) + len(kinds) for v, c in counts.items()}
    out = {}
    for i, url in urls.items():
        own = [t for t in tokens(*_split_host(url)) if t in kinds]
        x = math.log((pages["block"] + 1) / (pages["allow"] + 1)) + sum(math.log((counts["block"][t] + 1) / size["block"]) - math.log((counts["allow"][t] + 1) / size["allow"]) for t in own)
        out[i] = 1 / (1 + math.exp(-x))
    return out


def test_scores_of_whole_pages_against_brute_force(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet").collect()
    want = _brute_scores({r.page_id: r.url for r in pages}, {r.page_id: r.html for r in pages})
    rows = queries.op7_url_filter(spark, small).collect()
    assert {r.page_id: r.score for r in rows} == {i: pytest.approx(x, abs=1e-9) for i, x in want.items()} and len(rows) == len(pages)
    assert len({round(r.score, 6) for r in rows if not r.rule}) > 20


def test_bayes_learns_from_the_rules_alone(spark):
    html = "cheap pills garden club of flowers"
    urls = [f"http://cheappills{i}.net/a" for i in range(20)] + [f"http://gardenclub{i}.org/fr/a" for i in range(20)] + ["http://pillsflowers.com/", "http://gardenflowers.com/", "http://flowers.com/"]
    frame = spark.createDataFrame([(i, u, html) for i, u in enumerate(urls)], "page_id long, url string, html string")
    found = {r.page_id: r for r in urlfilter.judge(frame).collect()}
    assert [found[i].verdict for i in (40, 41, 42)] == ["block", "allow", "allow"] and found[42].score == pytest.approx(0.5)
    assert found[40].words == "h:pills h:flowers h:com"
    assert {r.score for r in urlfilter.judge(frame, rules=[]).collect()} == {0.5}


def test_words_of_any_length_split_names(spark):
    long = "".join(random.Random(3).choice("bcdfgkl") for _ in range(60))
    frame = spark.createDataFrame([(1, f"http://cat{long}dog{long}.com/", f"cat dog {long} com")], "page_id long, url string, html string")
    assert urlfilter.judge(frame).first().words == f"h:cat h:{long} h:dog h:{long} h:com"


def test_viterbi_is_the_cheapest_split():
    counts = {"ab": 50, "a": 20, "b": 20, "abc": 3, "c": 10, "cab": 7}
    splitter = urlfilter.Segmenter(counts)

    def cost(parts):
        return sum(splitter.cost.get(p, splitter.unknown + splitter.letter * len(p)) for p in parts)

    for run in ("abcab", "cabab", "xab", "abcx", "aabbcc", "zzzz", "zabzzz"):
        cuts = itertools.chain.from_iterable(itertools.combinations(range(1, len(run)), k) for k in range(len(run)))
        every = [[run[a:b] for a, b in itertools.pairwise([0, *c, len(run)])] for c in cuts]
        assert cost(splitter.split(run)) == pytest.approx(min(map(cost, every)))
    assert splitter.split("z" * 30) == ["z" * 30]
