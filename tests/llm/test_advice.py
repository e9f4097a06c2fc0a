"""Cases in which an operator once did less than its whole job."""

import itertools
import random
import statistics
from collections import Counter

import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from sievewright.llm import langid, topk, toxicity, urlfilter
from sievewright.sources import xml
from tests.llm.helpers import documents
from tests.llm.test_models import _slow_bits, _slow_trees

# exact top k


def test_a_partial_last_bin_ends_with_its_range(spark):
    # few bins and every row a query: many k-th scores lie in a last bin that would reach into the next range
    rng = random.Random(13)
    own = {i: rng.randint(-50, 50) for i in range(150)}
    vectors = spark.createDataFrame([(i, [float(x)]) for i, x in own.items()], "vec_id long, embedding array<float>")
    found = topk.top_k(spark, vectors, F.lit(True), k=4, scale=1, bins=5).collect()
    want = {(q, rank + 1, c) for q, x in own.items() for rank, c in enumerate(sorted((c for c in own if c != q), key=lambda c: (-x * own[c], c))[:4])}
    assert {(r.query_id, r["rank"], r.vec_id) for r in found} == want


# URLs


def test_rare_words_split_hosts_however_many_words_there_are(spark):
    words = ["".join(w) for w in itertools.islice(itertools.product("abcdefgh", repeat=6), 60_000)]
    html = [" ".join(["quxwib", *words[:30_000]]), " ".join(["zorpel", *words[30_000:]])]
    pages = spark.createDataFrame([(i, "http://quxwibzorpel.net/zorpelquxwib", h) for i, h in enumerate(html)], "page_id long, url string, html string")
    assert {r.words for r in urlfilter.judge(pages).collect()} == {"h:quxwib h:zorpel h:net p:zorpel p:quxwib"}


# toxicity


def test_ties_and_near_copies_leave_room_for_other_features(spark):
    rng = random.Random(2)
    word = lambda n: "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
    text = lambda *own: " ".join([*(word(5) for _ in range(20)), *own])
    copied = [word(8) for _ in range(300)]
    rows = [(text(), 0) for _ in range(300)] + [(text(*["vilename"] * (i % 4 == 0)), 1) for i in range(160)]
    rows += [(" ".join([*copied[:i], word(8), *copied[i:]]), 1) for i in range(0, 300, 4)]
    # in any order these are no near copies: their words' features tie, too many for the smaller bound
    tied = [word(8) for _ in range(30)]
    rows += [(" ".join([*rng.sample(tied, 30), *(word(5) for _ in range(20))]), 1) for _ in range(60)]
    sample = spark.createDataFrame(rows, "text string, grade int")
    found = set(toxicity.screen(toxicity.featurised(sample, 20), 20).tolist())
    assert xxhash.xxh32_intdigest("vilename") % (1 << 20) in found
    # however many features tie, all of them stay
    assert found >= {xxhash.xxh32_intdigest(p) % (1 << 20) for w in tied for p in toxicity.strings(w)}


# pipeline


def test_texts_of_unlearned_languages_are_dropped(spark):
    rng = random.Random(7)
    other = [
        "Все люди рождаются свободными и равными в своем достоинстве и правах",
        "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である",
        "Tutti gli esseri umani nascono liberi ed eguali in dignità e diritti e sono dotati di ragione",
        "Bonke abantu bazalwa bekhululekile belingana ngesithunzi nangamalungelo",
        *("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n)) for n in (20, 60, 200)),
    ]
    docs = documents(spark, "sf0.01").select("doc_id", "text", "lang")
    more = spark.createDataFrame([(-1 - i, t, None) for i, t in enumerate(other)], docs.schema)
    kept = {r.doc_id for r in corpus_pipeline.language(spark, docs.unionAll(more), "/root/testdata/sf0.01").collect()}
    assert kept == {r.doc_id for r in docs.collect() if any(map(str.isalpha, r.text or ""))}


def test_languages_and_limits_are_learned_from_all_texts(spark):
    # more texts of a language than any sample took, one of them in many copies, and probes whose codes are about as long as the limit
    rng = random.Random(21)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randint(2, 6)))
    kinds = {"aa": [word("abcdefghi") for _ in range(60)], "bb": [word("nopqrstuvw") for _ in range(60)]}
    texts = {lang: sorted({" ".join(rng.choices(words, k=6)) for _ in range(n)}) for (lang, words), n in zip(kinds.items(), (4000, 50), strict=True)}
    probes = [" ".join([*rng.choices(kinds["aa"], k=rng.randint(1, 9)), *(word("abcdefghijklm") for _ in range(rng.randint(1, 5)))]) for _ in range(400)]
    rows = [(t, lang) for lang, own in texts.items() for t in own] + [(texts["aa"][0], "aa")] * 3000 + [(t, None) for t in probes]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string").repartition(8)

    half = {r.text: r.half for r in docs.select("text", F.pmod(F.xxhash64("text", F.lit(1)), F.lit(2)).alias("half")).distinct().collect()}
    coded = lambda trees, text: {lang: _slow_bits(tree, text, 3) for lang, tree in trees.items()}
    of_half = [_slow_trees({lang: [t for t in own if half[t] == h] for lang, own in texts.items()}, 3) for h in (0, 1)]
    limits = {}
    for lang, own in texts.items():
        codes = [(t, coded(of_half[1 - half[t]], t)) for t in own]
        limits[lang] = 3.5 * statistics.median(bits[lang] / len(t) for t, bits in codes if min(bits, key=bits.get) == lang)
    trees, want = _slow_trees(texts, 3), set()
    for text in {t for t, _ in rows}:
        bits = coded(trees, text)
        best = min(bits, key=bits.get)
        if 1 / sum(2.0 ** max(bits[best] - x, -1000) for x in bits.values()) >= 0.3 and bits[best] / len(text) <= limits[best]:
            want.add(text)
    assert 50 < len(want & set(probes)) < 350
    kept = corpus_pipeline.language(spark, docs, "unused").collect()
    assert {r.text for r in kept} == want and len(kept) == sum(t in want for t, _ in rows)


def test_medians_and_counts_are_exact(spark):
    rng = random.Random(4)
    values = {"odd": [rng.random() for _ in range(301)], "even": [rng.choice((1.0, 1.0 + 1e-12, 9.0)) for _ in range(300)], "apart": [1.0, 1.5, 7.0, 9.0], "one": [2.5], "same": [3.0] * 8}
    rows = spark.createDataFrame([(lang, x) for lang, own in values.items() for x in own], "lang string, bits double").repartition(3)
    assert corpus_pipeline.medians(spark, rows, bins=3) == {lang: (len(own), statistics.median(own)) for lang, own in values.items()}
    # a text of several pieces, and none at all
    text = "".join(rng.choices("ab ", k=2 * langid._CHUNK + 9))
    docs = spark.createDataFrame([(text, "aa", 1)], "text string, lang string, part int")
    data = b"   " + langid.plain(text) + b" "
    want = Counter(int.from_bytes(data[i : i + 4]) for i in range(len(data) - 3))
    assert {(r.lang, r.part, r.gram): r.n for r in langid.counted(docs).itertuples()} == {("aa", 1, g): n for g, n in want.items()}
    assert not langid.grown(langid.counted(docs.limit(0))).languages


# XML


def test_records_after_a_broken_place_are_read():
    whole = [f"<p:R><n>{i}</n></p:R>" for i in range(2000)]
    for bad in ("<p:R><n>\x01</n></p:R>", "<p:R><n>x</p:R>", "<p:R><n>a & b</n></p:R>", "<p:R><n>x</n>", "<p:R><n", "</l>", "<!-- open -- ->"):
        for head in ('<?xml version="1.0"?><l xmlns:p="urn:p"><in>', '<l xmlns:p="urn:p" a="\'>"><in>'):
            text = head + "".join([*whole[:700], bad, *whole[700:1500], bad, *whole[1500:]]) + "</in></l>"
            assert [r["n"] for r in xml.records(text.encode(), "R")] == [str(i) for i in range(2000)], bad
