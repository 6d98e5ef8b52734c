"""Configuration, worklists and fixtures, read on the driver."""

from __future__ import annotations

import glob
import os
import re
from pathlib import Path

_COPY = re.compile(r"^(.+) \(\d+\)(\.[A-Za-z0-9]+)$")


def _yaml():
    try:
        import yaml
    except ImportError as e:  # pragma: no cover
        raise RuntimeError("reading a configuration needs PyYAML") from e
    return yaml


def load_config(path: str = "config.yaml") -> dict:
    """The configuration; an old top-level ``options`` key becomes ``llm.options``."""
    config = _yaml().safe_load(Path(path).read_text()) or {}
    if "options" in config:
        config.setdefault("llm", {}).setdefault("options", config.pop("options"))
    return config


def options_for(config: dict, extractor: str) -> dict:
    """The shared options with the extractor's own on top; null values take an option away."""
    llm = config.get("llm") or {}
    merged = {**(llm.get("options") or {}), **((llm.get("extractors") or {}).get(extractor) or {}).get("options", {})}
    return {k: v for k, v in merged.items() if v is not None}


def expand_inputs(entries: list[str], ending: str = ".pdf") -> list[str]:
    """Files, folders (with all below) and patterns as absolute paths, each once, without copies of files that are there."""
    found: dict[str, None] = {}
    for entry in entries:
        if os.path.isdir(entry):
            hits = sorted(str(p) for p in Path(entry).rglob(f"*{ending}"))
        else:
            hits = [entry] if os.path.exists(entry) else sorted(glob.glob(entry, recursive=True))
        found.update(dict.fromkeys(os.path.abspath(h) for h in hits if h.lower().endswith(ending)))
    original = lambda p: (m := _COPY.match(p)) and m[1] + m[2]
    return [p for p in found if original(p) not in found]


def shard_of(paths: list[str], number: int, shards: int) -> list[str]:
    """Every ``shards``-th path of the sorted worklist, from ``number`` on."""
    if not 0 <= number < shards:
        raise ValueError("number must lie below shards")
    return sorted(paths)[number::shards]


def load_fixture(path: str):
    """A fixture tree; ``!contains``, ``!exact``, ``!anywhere`` and ``!extras=N`` become tags of the comparator."""
    yaml = _yaml()
    from ..operators.matching import Tag

    class Loader(yaml.SafeLoader):
        pass

    def inner(loader, node):
        return loader.construct_scalar(node) if isinstance(node, yaml.ScalarNode) else loader.construct_sequence(node, True) if isinstance(node, yaml.SequenceNode) else loader.construct_mapping(node, True)

    for rule in ("contains", "exact", "anywhere"):
        Loader.add_constructor(f"!{rule}", lambda loader, node, rule=rule: Tag(inner(loader, node), rule))
    Loader.add_multi_constructor("!extras=", lambda loader, count, node: Tag(inner(loader, node), extras=int(count)))
    return yaml.load(Path(path).read_text(), Loader)  # noqa: S506


def without_tags(node):
    """The plain values of a fixture tree."""
    from ..operators.matching import Tag

    node = node.value if isinstance(node, Tag) else node
    if isinstance(node, dict):
        return {k: without_tags(v) for k, v in node.items()}
    return [without_tags(x) for x in node] if isinstance(node, list) else node


def numbered(tree: dict) -> dict:
    """A fixture with ids: scales depth first from 1; items by their text in order of first appearance."""
    seen: dict[str, int] = {}
    count = iter(range(1, 1 << 30))

    def item(x: dict) -> dict:
        text = x.get("item_text") or ""
        return {"item_id": x.get("item_id") or seen.setdefault(text, len(seen) + 1), **{k: v for k, v in x.items() if k != "item_id"}}

    def scale(s: dict) -> dict:
        own = s.get("id") or next(count)
        return {**s, "id": own, "items": [item(i) for i in s.get("items") or []], "subscales": [scale(x) for x in s.get("subscales") or []]}

    plain = without_tags(tree)
    return {**plain, "scales": [scale(s) for s in plain.get("scales") or []], "orphan_items": [item(i) for i in plain.get("orphan_items") or []]}


def log_sections(text: str) -> dict[str, list[str]]:
    """A log's lines by section; a section begins with ``=== title ===``."""
    out: dict[str, list[str]] = {}
    title = ""
    for line in text.splitlines():
        if m := re.fullmatch(r"=+\s*(.*?)\s*=+", line.strip()):
            title = m[1]
            out.setdefault(title, [])
        elif title:
            out[title].append(line)
    return out
