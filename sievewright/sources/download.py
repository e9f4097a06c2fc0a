"""Acquisition of published lists: outside the query path, on the driver."""

from __future__ import annotations

import hashlib
import time
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime
from pathlib import Path
from urllib.parse import urlparse


@dataclass(frozen=True)
class Task:
    name: str
    url: str
    folder: str
    filename: str | None = None
    timeout: float = 30.0
    attempts: int = 3


def target(task: Task, now: datetime) -> Path:
    """`name_time.ext`: the extension of the given name, else of the URL's last segment, else none behind the URL's MD5."""
    last = task.filename or urlparse(task.url).path.rstrip("/").rpartition("/")[2]
    stem = task.name or (Path(last).stem if last else hashlib.md5(task.url.encode()).hexdigest())
    return Path(task.folder) / f"{stem}_{now:%Y%m%d_%H%M%S}{Path(last).suffix}"


def _open(url: str, timeout: float):
    return urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": "sievewright/1"}), timeout=timeout)  # noqa: S310


def download(task: Task, opener: Callable = _open, now: Callable[[], datetime] = datetime.now, pause: float = 0.0) -> Path:
    """Streams to the landing folder; the last attempt's error is raised."""
    path = target(task, now())
    path.parent.mkdir(parents=True, exist_ok=True)
    for attempt in range(1, task.attempts + 1):
        try:
            with opener(task.url, task.timeout) as source, path.open("wb") as out:
                while part := source.read(8192):
                    out.write(part)
            return path
        except OSError:
            path.unlink(missing_ok=True)
            if attempt == task.attempts:
                raise
            time.sleep(pause)
    raise AssertionError
