"""Run settings, read from YAML and handed on explicitly."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

import yaml


@dataclass(frozen=True)
class Requests:
    useragent: str = "gleanspark/0.1"
    timeout_connect: float = 3
    timeout_read: float = 7
    max_retries: int = 3


@dataclass(frozen=True)
class Input:
    input_dir: str = "../input"
    urls: str = "urls.txt"
    keywords: str = "keywords.txt"
    url_max: int = 100
    url_offset: int = 0


@dataclass(frozen=True)
class Output:
    output_dir: str = "../output"
    batchsize: int = 100
    logs: str = "logs"


@dataclass(frozen=True)
class CrawlLimits:
    max_duration: float = 500
    max_visits: int = 200
    max_depth: int = 2
    use_sitemap: bool = True


@dataclass(frozen=True)
class Config:
    requests: Requests = field(default_factory=Requests)
    input: Input = field(default_factory=Input)
    output: Output = field(default_factory=Output)
    crawl: CrawlLimits = field(default_factory=CrawlLimits)


def _known(kind, given: dict):
    return kind(**{k: v for k, v in (given or {}).items() if k in kind.__dataclass_fields__ and v is not None})


def parse_config(text: str) -> Config:
    """Settings from YAML; keys that nothing reads (storage credentials and the like) are ignored."""
    tree = yaml.safe_load(text) or {}
    source = dict(tree.get("input") or {})
    source |= source.pop("input_files", None) or {}
    return Config(_known(Requests, tree.get("requests")), _known(Input, source), _known(Output, tree.get("output")), _known(CrawlLimits, tree.get("crawl")))


def load_config(path: str) -> Config:
    with open(path, encoding="utf-8") as file:
        return parse_config(file.read())


def run_directory(output_dir: str, offset: int, now: datetime | None = None) -> str:
    """Folder of one run's output, named by its time and the offset of its seeds."""
    return f"{output_dir}/{(now or datetime.now()):%Y%m%d_%H%M%S}_offset{offset}"
