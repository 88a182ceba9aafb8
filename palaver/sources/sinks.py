"""Sinks: reports as text, Markdown or HTML; ``files`` writes one file a row."""

from __future__ import annotations

import re
from html import escape

from pyspark.sql import DataFrame


def cell(value) -> str:
    if value is None:
        return ""
    if isinstance(value, bool):
        return "yes" if value else "no"
    return f"{value:,}" if isinstance(value, int) else str(value)


#: A report is a few dozen rows; a larger frame is an error rather than a page cut short.
MOST_ROWS = 100_000


def _rows(report: DataFrame) -> tuple[list[str], list[list[str]]]:
    rows = report.limit(MOST_ROWS + 1).collect()
    if len(rows) > MOST_ROWS:
        raise ValueError(f"more than {MOST_ROWS} rows are no report; write them as a table")
    return report.columns, [[cell(v) for v in r] for r in rows]


def as_text(report: DataFrame) -> str:
    names, rows = _rows(report)
    widths = [max(len(r[i]) for r in [names, *rows]) for i in range(len(names))]
    lines = ["  ".join(v.ljust(w) for v, w in zip(r, widths, strict=True)).rstrip() for r in [names, *rows]]
    return "\n".join([lines[0], "  ".join("-" * w for w in widths), *lines[1:]])


def as_markdown(report: DataFrame) -> str:
    names, rows = _rows(report)
    line = lambda r: "| " + " | ".join(v.replace("|", "\\|") for v in r) + " |"
    return "\n".join([line(names), line(["---"] * len(names)), *map(line, rows)])


def as_html(report: DataFrame) -> str:
    names, rows = _rows(report)
    head = "".join(f"<th>{escape(n)}</th>" for n in names)
    body = "".join("<tr>" + "".join(f"<td>{escape(v)}</td>" for v in r) + "</tr>" for r in rows)
    return f"<table><tr>{head}</tr>{body}</table>"


def safe_name(name: str) -> str:
    """A path below the folder: no root, no drive, no step upwards, no marks that file systems refuse."""
    parts = [re.sub(r'[\\:*?"<>|\x00-\x1f]', "_", p).rstrip(". ") or "_" for p in name.split("/") if p not in ("", ".")]
    return "/".join("_" if set(p) == {"."} else p for p in parts) or "_"
