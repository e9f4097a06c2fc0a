"""Configuration of a source. The key and the source's name are two things."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Source:
    key: str
    name: str
    file_type: str
    url: str = ""
    authority: str = ""
    schedule: str = ""
    root_tag: str = "Designation"
    sheet: int | str = 0
    external_id: str | None = None
    preprocess: tuple[dict, ...] = ()
    enrich: tuple[dict, ...] = field(default_factory=tuple)
