"""Structured extraction from document texts by a language model, through an injected client."""

from __future__ import annotations

import json
import re
import urllib.request
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

PROMPT = """Extract the entities of the document below as one JSON object.
Return JSON only. Fill every field of the schema; leave a field blank where the document does not say. Invent nothing.
Prefer the organisation to persons that act for it.

Schema:
{schema}

Document:
{text}
"""


class Client(Protocol):
    def generate(self, prompt: str, schema: dict | str) -> str: ...


def fill(template: str, text: str, schema: dict | None) -> str:
    return template.replace("{schema}", json.dumps(schema or {}, ensure_ascii=False)).replace("{text}", text)


def unfenced(answer: str) -> str:
    """Without a Markdown code fence around it."""
    return re.sub(r"^\s*```[A-Za-z]*\s*|\s*```\s*$", "", answer).strip()


class Stub:
    """A client without a model: all fields of the schema with their defaults, and a fence."""

    def generate(self, prompt: str, schema: dict | str) -> str:
        return "```json\n" + json.dumps(schema if isinstance(schema, dict) else {}) + "\n```"


class LocalServer:
    """A client of a model server on this host that has a chat endpoint over HTTP: one prompt, one JSON answer, temperature 0."""

    def __init__(self, model: str, url: str = "http://localhost:11434/api/chat", timeout: float = 300.0, opener: Callable = urllib.request.urlopen):
        self.model, self.url, self.timeout, self.opener = model, url, timeout, opener

    def generate(self, prompt: str, schema: dict | str) -> str:
        asked = {"model": self.model, "messages": [{"role": "user", "content": prompt}], "format": schema or "json", "options": {"temperature": 0}, "stream": False}
        request = urllib.request.Request(self.url, json.dumps(asked).encode(), {"Content-Type": "application/json"})  # noqa: S310
        with self.opener(request, timeout=self.timeout) as answer:
            return json.loads(answer.read())["message"]["content"]


def extract(text: Column, make_client: Callable[[], Client], schema: dict | None = None, template: str = PROMPT) -> Column:
    """The model's JSON for each text; a null text gives null, and an answer that is no JSON fails."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        client = make_client()

        def one(t):
            if t is None:
                return None
            return json.dumps(json.loads(unfenced(client.generate(fill(template, t, schema), schema or "json"))), ensure_ascii=False)

        for batch in batches:
            yield batch.map(one)

    return run(text)
