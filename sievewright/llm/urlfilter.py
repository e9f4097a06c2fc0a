"""URL filter: rules first, then segmented host and path words scored by multinomial naive Bayes.

Host names concatenate words. The most probable split of each run of letters under a unigram model is found by the Viterbi algorithm; the unigram
counts are those of the words of all pages, of whatever length, and an unknown run costs more with each letter, however long it is. Naive Bayes learns from
the pages that a rule decides, block against allow: from the tokens of their host and path without the parts that the rule matched, so that what it learns can
tell other hosts apart. Counts are taken over all such pages, smoothed by 1; tokens that none of them holds do not count.

All counts stay written tables, however many there are. Distinct pairs of host and path are dealt by hash to parts of about `_PART`; a part meets only the
counts of the pieces, and then of the tokens, that it holds, so that no key has more rows than there are parts. Words of over `_HEAD` letters are looked up by
their first letters, so that the pieces of a name grow with its length and not with its square.

Defined results: a null url or one without `://` has an empty host and path, no rule, no tokens, and so the likelier class, where
equal is allow; where no page has a rule every score is 0.5; empty names and repeated rows are judged alike, each page counts once; urls are used whole; columns
of pages with the names of the results are replaced; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievewright.llm.common import Workspace

#: Rules of the contract: verdict, host and path (fixed values).
RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_RUNS = re.compile(r"[^\W\d_]+|\d+")
_WORDS = re.compile(r"[^\W\d_]+")
#: Longer words are looked up by so many first letters.
_HEAD = 20
_TAGS = re.compile(r"<[^>]*>")
NUMBER = "0"
#: About so many distinct pairs of host and path meet in one group.
_PART = 1024


def host(url: Column) -> Column:
    """After the first :// up to a slash, question mark, hash or the end, A-Z lower-cased; empty for null or without it."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path(url: Column) -> Column:
    """From there up to a question mark, hash or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting(rules: list[tuple[str, str]], of: dict[str, str] | None = None) -> Column:
    """The longest rule that fits columns host and path (null if none), or what `of` has for it."""
    out = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((F.col("host") == name) | F.col("host").endswith("." + name)) & F.col("path").startswith(slash + rest)
        out = F.when(fits, F.lit(of[rule] if of else rule)).otherwise(out)
    return out


class Segmenter:
    """Unigram Viterbi splits of runs of letters."""

    def __init__(self, counts: dict[str, int], total: int | None = None):
        """counts: those of a run's pieces are enough, where the total of all words is given."""
        total = (sum(counts.values()) if total is None else total) + 1
        self.cost = {w: math.log(total / n) for w, n in counts.items()}
        self.sizes = sorted({len(w) for w in counts})
        # an unknown run: as rare as one word in the total, and a factor of 10 rarer with each letter
        self.unknown, self.letter = math.log(total), math.log(10)
        self.known: dict[str, list[str]] = {}

    def split(self, run: str) -> list[str]:
        """The cheapest split; of equally cheap last pieces the longest."""
        if (found := self.known.get(run)) is not None:
            return found
        best, back = [0.0], [0]
        # an unknown piece costs the same for each letter, so one start serves all ends: the one that is cheapest less its letters
        low, low_at = 0.0, 0
        for end in range(1, len(run) + 1):
            cost, at = low + self.unknown + self.letter * end, low_at
            for size in self.sizes:
                if size > end:
                    break
                if (own := self.cost.get(run[end - size : end])) is not None and (best[end - size] + own, end - size) < (cost, at):
                    cost, at = best[end - size] + own, end - size
            best.append(cost)
            back.append(at)
            if cost - self.letter * end < low:
                low, low_at = cost - self.letter * end, end
        out, end = [], len(run)
        while end:
            out.append(run[back[end] : end])
            end = back[end]
        if len(self.known) > 100_000:
            self.known.clear()
        self.known[run] = out = out[::-1]
        return out

    def __call__(self, name: str, path: str) -> list[str]:
        """Tokens of a host, marked h:, and of a path, marked p:."""
        return [
            f"{mark}:{w}"
            for mark, text in (("h", name), ("p", path))
            for run in _RUNS.findall(text.lower())
            for w in ([NUMBER] if run.isdigit() else self.split(run))
        ]


class Bayes:
    """Multinomial naive Bayes of block against allow, for tokens whose counts (allow, block) are given."""

    def __init__(self, counts: dict[str, tuple[int, int]], totals: tuple[int, int, int], pages: tuple[int, int]):
        """totals: all tokens' counts of both classes, and how many tokens there are; pages: those of both classes."""
        size = [n + totals[2] for n in totals[:2]]
        self.weight = {t: math.log((n[1] + 1) / size[1]) - math.log((n[0] + 1) / size[0]) for t, n in counts.items()}
        self.prior = math.log((pages[1] + 1) / (pages[0] + 1))

    def __call__(self, tokens: list[str]) -> float:
        """P(block)."""
        x = self.prior + sum(self.weight.get(t, 0.0) for t in tokens)
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, x))))


def unigrams(pages: DataFrame, text: str) -> DataFrame:
    """w, n: the words of a column of all pages, tags left out."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: Counter[str] = Counter()
        for batch in batches:
            for t in batch[text].array:
                if isinstance(t, str):
                    sums.update(_WORDS.findall(_TAGS.sub(" ", t).lower()))
            if len(sums) > 200_000:
                yield pd.DataFrame(sums.items(), columns=["w", "n"])
                sums.clear()
        yield pd.DataFrame(sums.items(), columns=["w", "n"]).astype({"w": "str", "n": "int64"})

    return pages.select(F.col(text).cast("string").alias(text)).mapInPandas(count, "w string, n long").groupBy("w").agg(F.sum("n").alias("n"))


def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """part, w, reach: what may be a word, or the first `_HEAD` letters of one, in the hosts and paths of a part, and how many letters its run has from there on at most."""

    def frame(part, made: dict[str, int]) -> pd.DataFrame:
        return pd.DataFrame({"part": part, "w": pd.Series(list(made), dtype="str"), "reach": pd.Series(list(made.values()), dtype="int64")})

    for batch in batches:
        for part, own in batch.groupby("part"):
            made: dict[str, int] = {}
            for run in {run for text in chain(own["host"], own["path"]) for run in _RUNS.findall(text.lower()) if not run.isdigit()}:
                for a in range(len(run)):
                    for b in range(a + 1, min(len(run), a + _HEAD) + 1):
                        made[run[a:b]] = max(made.get(run[a:b], 0), len(run) - a)
                if len(made) > 100_000:
                    yield frame(part, made)
                    made.clear()
            yield frame(part, made)


def scored(work: Workspace, pages: DataFrame, words: DataFrame) -> DataFrame:
    """host, path, score, words of every distinct pair of pages (host, path, rule, verdict); words: w, n."""
    names = work.table(pages.groupBy("host", "path").agg(F.count("*").alias("m"), F.first("rule").alias("rule"), F.first("verdict").alias("verdict")), "names")
    parts = -(-names.count() // _PART) or 1
    names = names.withColumn("part", F.pmod(F.xxhash64("host", "path"), F.lit(parts)).cast("int"))
    total = words.agg(F.sum("n")).first()[0] or 0

    def split(these: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        splitter = Segmenter(dict(zip(known["w"], known["n"].tolist(), strict=True)), total)
        learn = []
        for name, path, rule in zip(these["host"], these["path"], these["rule"], strict=True):
            of, slash, start = rule.partition("/") if isinstance(rule, str) else ("", "", "")
            learn.append(splitter(name[: len(name) - len(of)], path[len(slash + start) :]) if slash else [])
        return these.drop(columns="rule").assign(tokens=[splitter(h, p) for h, p in zip(these["host"], these["path"], strict=True)], learn=learn)

    found = names.select("part", "host", "path").mapInPandas(pieces, "part int, w string, reach long").groupBy("part", "w").agg(F.max("reach").alias("reach"))
    short, long = words.where(F.length("w") <= _HEAD), words.where(F.length("w") > _HEAD)
    heads = found.where(F.length("w") == _HEAD).withColumnRenamed("w", "head")
    whole = heads.join(long.withColumn("head", F.substring("w", 1, _HEAD)), "head").where(F.length("w") <= F.col("reach"))
    known = found.join(short, "w").select("part", "w", "n").unionAll(whole.select("part", "w", "n"))
    made = names.groupBy("part").cogroup(known.groupBy("part")).applyInPandas(
        split, "host string, path string, m long, verdict string, part int, tokens array<string>, learn array<string>"
    )
    made = work.table(made, "split")
    of = [F.coalesce(F.sum(F.when(F.col("verdict") == v, F.col("m"))), F.lit(0)).alias(f"of_{v}") for v in ("allow", "block")]
    learnt = made.where("verdict is not null")
    counts = work.table(learnt.select(F.explode("learn").alias("t"), "verdict", "m").groupBy("t").agg(*of), "tokens")
    totals = tuple(n or 0 for n in counts.agg(F.sum("of_allow"), F.sum("of_block"), F.count("*")).first())
    of_class = tuple(learnt.agg(*of).first())

    def score(these: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        both = zip(known["of_allow"].tolist(), known["of_block"].tolist(), strict=True)
        model = Bayes(dict(zip(known["t"], both, strict=True)), totals, of_class)
        return these[["host", "path"]].assign(score=[model(t) for t in these["tokens"]], words=[" ".join(t) for t in these["tokens"]])

    weighed = made.select(F.col("part").alias("of_part"), F.explode("tokens").alias("t")).distinct().join(counts, "t")
    out = made.groupBy("part").cogroup(weighed.groupBy("of_part")).applyInPandas(score, "host string, path string, score double, words string")
    return work.table(out, "scored")


def judge(pages: DataFrame, rules=RULES, threshold: float = 0.5) -> DataFrame:
    """All columns of pages (url, html), with host, path, rule, verdict, score (P(block) by the method) and words."""
    made = {"host", "path", "rule", "verdict", "score", "words"}
    url = F.col("url").cast("string")
    by_rule = fitting(rules, {rule: verdict for verdict, rule in rules})
    named = pages.select(*(F.col(f"`{c}`") for c in pages.columns if c.lower() not in made), host(url).alias("host"), path(url).alias("path"))
    work = Workspace(pages.sparkSession, "urls")
    found = scored(work, named.select("host", "path", fitting(rules).alias("rule"), by_rule.alias("verdict")), work.table(unigrams(pages, "html"), "words"))
    work.drop("names", "words", "split", "tokens")
    judged = "_judged"
    while any(c.lower().startswith(judged) for c in named.columns):
        judged += "_"
    found = found.select(F.col("host").alias(f"{judged}h"), F.col("path").alias(f"{judged}p"), F.struct("score", "words").alias(judged))
    # every name of a page was scored
    own = named.join(found, (F.col("host") == F.col(f"{judged}h")) & (F.col("path") == F.col(f"{judged}p")), "left")
    by_score = F.when(F.col(judged)["score"] > threshold, "block").otherwise("allow")
    return own.withColumn("rule", fitting(rules)).withColumn("verdict", F.coalesce(by_rule, by_score)).select(
        *(F.col(f"`{c}`") for c in named.columns), "rule", "verdict", F.col(judged)["score"].alias("score"), F.col(judged)["words"].alias("words")
    )
