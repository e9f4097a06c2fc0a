"""Licence scan by template-markup matching.

A template is mandatory wording with two kinds of marked regions: `[[ ... ]]` is optional, `{name:n}` is replaceable
by 0 to n words. Templates are compiled to token automata (states and transitions on words) that run over a text's words
and accept wherever all mandatory wording stands exactly, in order. An automaton runs only over texts that hold all its
mandatory words, and only from words that can start it.

Defined results: null, empty and wordless texts have 0 words, no places, empty labels and score 0; repeated rows each
get their own row; texts are read whole; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.llm.common import alnum_words

#: Base phrases and their labels (fixed values of the contract).
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Templates of common licence notices: label, wording. Public licence names, in our own markup.
TEMPLATES = [
    ("mit", "[[released]] under the [[terms of the]] mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("apache-2", "[[licensed under the]] apache license [[version]] 2 [[0]]"),
    ("apache-2", "licensed under the apache license version 2 0 the license"),
    ("gpl-3", "[[under the]] gnu general public license [[as published by the free software foundation]] [[either]] version 3"),
    ("gpl-2", "[[under the]] gnu general public license [[as published by the free software foundation]] [[either]] version 2"),
    ("lgpl-3", "gnu lesser general public license version 3"),
    ("agpl-3", "gnu affero general public license [[as published by the free software foundation]] [[either]] version 3"),
    ("cc-by-nc", "[[licensed under]] [[a]] cc by nc [[{version:2}]]"),
    ("cc-by-nc", "creative commons attribution noncommercial {version:2} [[international]] license"),
    ("cc-by-sa", "[[licensed under]] [[a]] cc by sa [[{version:2}]]"),
    ("cc-by", "creative commons attribution {version:2} [[international]] license"),
    ("cc0", "[[licensed under]] cc0 1 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl-2", "[[subject to the terms of the]] mozilla public license [[v]] [[version]] 2 0"),
]

OUT = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


class Automaton:
    """A template as a token automaton: transitions on one word, on any word, and empty ones."""

    def __init__(self, label: str, wording: str):
        self.label = label
        self.on: list[dict[bytes, int]] = [{}]
        self.any: list[int | None] = [None]
        self.empty: list[list[int]] = [[]]
        mandatory: list[bytes] = []
        at, opened = 0, []
        for mark in re.findall(r"\[\[|\]\]|\{\w+:\d+\}|[^\s\[\]{}]+", wording):
            if mark == "[[":
                opened.append(at)
            elif mark == "]]":
                self.empty[opened.pop()].append(at)
            elif mark[0] == "{":
                start, most = at, int(mark[1:-1].split(":")[1])
                steps = [start]
                for _ in range(most):
                    to = self._state()
                    self.any[at] = to
                    at = to
                    steps.append(at)
                for s in steps[:-1]:
                    self.empty[s].append(at)
            else:
                to, word = self._state(), mark.encode()
                self.on[at][word] = to
                at = to
                if not opened:
                    mandatory.append(word)
        if opened or not mandatory:
            raise ValueError(f"template without mandatory wording or with an open region: {wording!r}")
        self.accept, self.mandatory = at, frozenset(mandatory)
        #: The longest mandatory word starts the search: matches must hold it.
        self.anchor = max(mandatory, key=len)
        self.starts = frozenset(w for s in self._closure({0}) for w in self.on[s])

    def _state(self) -> int:
        self.on.append({})
        self.any.append(None)
        self.empty.append([])
        return len(self.on) - 1

    def _closure(self, states: set[int]) -> set[int]:
        todo = [*states]
        while todo:
            for to in self.empty[todo.pop()]:
                if to not in states:
                    states.add(to)
                    todo.append(to)
        return states

    def match(self, words: list[bytes], start: int) -> int:
        """The end of the longest match that starts at a word, or -1."""
        states, end, at = self._closure({0}), -1, start
        while states:
            if self.accept in states:
                end = at
            if at >= len(words):
                break
            step = {self.on[s][words[at]] for s in states if words[at] in self.on[s]} | {
                self.any[s] for s in states if self.any[s] is not None
            }
            states, at = self._closure(step), at + 1
        return end

    def spans(self, words: list[bytes], known: set[bytes]) -> list[tuple[int, int]]:
        """All longest matches, by start."""
        if not self.mandatory <= known:
            return []
        found = []
        for start, word in enumerate(words):
            if word in self.starts and (end := self.match(words, start)) > start:
                found.append((start, end))
        return found


def places(words: list[bytes], phrase: tuple[bytes, ...]) -> list[int]:
    first, n = phrase[0], len(phrase)
    return [i for i, w in enumerate(words) if w == first and tuple(words[i : i + n]) == phrase]


def scan_text(text: str | None, base: dict[tuple[bytes, ...], str], automata: list[Automaton]):
    """(words, places, first, last, base labels, all labels, score, spans) of one text."""
    words = alnum_words(text)
    known = set(words)
    starts: list[int] = []
    base_labels: set[str] = set()
    for phrase, label in base.items():
        if known.issuperset(phrase) and (at := places(words, phrase)):
            starts += at
            base_labels.add(label)
    spans = [(a, b, x.label) for x in automata if x.anchor in known for a, b in x.spans(words, known)]
    labels = base_labels | {label for _, _, label in spans}
    covered = len({i for a, b, _ in spans for i in range(a, b)})
    score = min(1.0, (0.5 if labels else 0.0) + 0.5 * min(1.0, covered / 8.0)) if labels else 0.0
    first, last = (min(starts), max(starts)) if starts else (None, None)
    return len(words), len(starts), first, last, base_labels, labels, score, spans


def scan(docs: DataFrame, base: dict[str, str] | None = None, templates=None) -> DataFrame:
    """doc_id, counts of words and base places, labels, score of every document (doc_id, text)."""
    phrases = {tuple(p.encode().split()): label for p, label in (BASE if base is None else base).items()}
    marked = TEMPLATES if templates is None else templates

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automata = [Automaton(*t) for t in marked]
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"].array, batch["text"].array, strict=True):
                n, hits, first, last, own, labels, score, _ = scan_text(text if isinstance(text, str) else None, phrases, automata)
                rows.append((doc_id, n, hits, first, last, ",".join(sorted(own)), ",".join(sorted(labels)), score))
            out = pd.DataFrame(rows, columns=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])
            yield out.astype({"doc_id": "Int64", "first_word": "Int64", "last_word": "Int64"})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInPandas(run, OUT)
