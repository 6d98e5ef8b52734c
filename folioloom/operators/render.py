"""Numbers, tables and trees as text, on the driver."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def number(value) -> str:
    """Thousands parted by commas, two decimals for fractions, ``n/a`` for none."""
    if value is None or (isinstance(value, float) and value != value):
        return "n/a"
    if isinstance(value, bool):
        return "yes" if value else "no"
    if isinstance(value, float):
        return f"{value:,.0f}" if value == int(value) else f"{value:,.2f}"
    return f"{value:,}" if isinstance(value, int) else str(value)


def percent(value: float | None) -> str:
    return "n/a" if value is None else f"{100 * value:.1f} %"


def markdown_table(headers: list[str], rows: Iterable[Iterable]) -> list[str]:
    """A table's lines; bars inside cells are escaped."""
    line = lambda cells: "| " + " | ".join(number(c).replace("|", "\\|") for c in cells) + " |"
    return [line(headers), "|" + "-|" * len(headers), *map(line, rows)]


def frame_table(df: DataFrame, rows: int = 200) -> list[str]:
    """A small result as a table: its first ``rows`` rows."""
    return markdown_table(df.columns, (tuple(r) for r in df.limit(rows).collect()))


def flattened(stats: dict, prefix: str = "") -> list[tuple[str, object]]:
    """Nested counters as dotted keys."""
    out = []
    for key, value in stats.items():
        out += flattened(value, f"{prefix}{key}.") if isinstance(value, dict) else [(f"{prefix}{key}", value)]
    return out


def node_names(scales: list[dict]) -> list[str]:
    """Names of all nodes, in pre-order."""
    return [n for s in scales for n in (s["scale_name"], *node_names(s.get("subscales") or []))]


def node_count(scales: list[dict]) -> int:
    return sum(1 + node_count(s.get("subscales") or []) for s in scales)


def tree_lines(scales: list[dict], ids: bool = False, depth: int = 0) -> list[str]:
    """An indented tree; with ids, each node's id before its name."""
    out = []
    for s in scales:
        out.append("  " * depth + "- " + (f"[{s['id']}] " if ids else "") + str(s["scale_name"]))
        out += tree_lines(s.get("subscales") or [], ids, depth + 1)
    return out


def mark_grid(runs: list[dict]) -> list[str]:
    """Items by runs: ``R`` reversed, ``✓`` mapped, ``-`` absent, ``*`` where the runs differ.

    runs: {item: set of (scale, reversed)} of each run.
    """
    out = []
    for item in sorted({i for r in runs for i in r}):
        cells = ["-" if item not in r else "R" if any(rev for _, rev in r[item]) else "✓" for r in runs]
        out.append(f"{item}: {' '.join(cells)}" + (" *" if len({frozenset(r.get(item, ())) for r in runs}) > 1 else ""))
    return out
