"""Report sinks: JSON rows as a table write, HTML pages rendered from a report's few rows."""

from __future__ import annotations

import html
from pathlib import Path
from string import Template

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_PAGE = Template("<!DOCTYPE html><html><head><meta charset='utf-8'><title>$title</title></head><body><h1>$title</h1>$body</body></html>")
_EVENT = Template("<section><h2>$title</h2><p>$summary</p><p>$percent% &middot; $sources</p></section>")


def card_columns(events: DataFrame) -> DataFrame:
    """What a page shows of an event: a whole percentage, up to five distinct sources and three insights."""
    return events.withColumns({"percent": F.round(F.col("importance") * 100).cast("int"), "shown_sources": F.slice(F.array_distinct(F.split("source_names", ", ")), 1, 5)})


def write_json(events: DataFrame, path: str) -> None:
    events.write.mode("overwrite").json(path)


def render(week: str, events: DataFrame, folder: str, slugs: dict[str, str] | None = None, most: int = 1000) -> list[str]:
    """An index and a page for each category. A report is a top list: more than `most` rows is an error."""
    rows = card_columns(events).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a report shows at most {most} events")
    pages: dict[str, list] = {}
    for row in rows:
        pages.setdefault(row["category"], []).append(row)
    out = Path(folder)
    out.mkdir(parents=True, exist_ok=True)
    written, index = [], ""
    for category in sorted(pages):
        name = (slugs or {}).get(category, category.lower().replace(" ", "-"))
        body = "".join(_EVENT.substitute(title=html.escape(r["title"] or ""), summary=html.escape(r["summary"] or "") if "summary" in r else "", percent=r["percent"], sources=html.escape(", ".join(r["shown_sources"]))) for r in pages[category])
        (out / f"{name}.html").write_text(_PAGE.substitute(title=html.escape(category), body=body), encoding="utf-8")
        index += f"<p><a href='{name}.html'>{html.escape(category)}</a> {len(pages[category])}</p>"
        written.append(f"{name}.html")
    (out / "index.html").write_text(_PAGE.substitute(title=html.escape(week), body=index), encoding="utf-8")
    return ["index.html", *written]
