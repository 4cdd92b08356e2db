"""From a question to queries of the query layer and an answer with references. A language model is optional and injected;
without one, or if its plan is not usable, a plan from the question's words is taken."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from dataclasses import replace
from typing import Any

from pyspark.sql import DataFrame

from skeinwork.plans.query_layer import REGISTRY, QuerySpec, run, to_payload

Model = Callable[[str], str]
FILTERS = ("signal_type", "topic_hint", "subreddit", "source_type", "matched_pattern", "entity_type", "entity_text")
MOST_QUERIES, MOST_ROWS = 3, 10
IDLE = set("a about an and are can do does for from have how in is it me most of on or people say tell the there to what when where which who why with".split())
PAIN = re.compile(r"\b(pain|problem|complain\w*|frustrat\w*|annoy\w*|struggl\w*|difficult\w*|issue)s?\b")


def keywords(question: str) -> list[str]:
    return [w for w in re.findall(r"[a-z0-9]+", question.lower()) if w not in IDLE and len(w) > 2]


def sanitize(plan: Any) -> list[QuerySpec]:
    """What of a model's plan may run: known queries but no SQL, known filters with text values, few queries of few rows."""
    specs = []
    for item in plan.get("queries", []) if isinstance(plan, dict) else []:
        name = item.get("name") if isinstance(item, dict) else None
        if name not in REGISTRY or name == "custom_sql":
            continue
        given = item.get("filters") or {}
        filters = {k: v for k, v in given.items() if k in FILTERS and isinstance(v, str)} if isinstance(given, dict) else {}
        contains = item.get("contains") if isinstance(item.get("contains"), str) else ""
        limit = item.get("limit") if isinstance(item.get("limit"), int) else MOST_ROWS
        specs.append(QuerySpec(name, filters, contains, max(1, min(limit, MOST_ROWS))))
    return specs[:MOST_QUERIES]


def fallback(question: str) -> list[QuerySpec]:
    words = keywords(question)
    return [QuerySpec("source_search", contains=max(words, key=len) if words else "", limit=MOST_ROWS), QuerySpec("signal_summary", limit=MOST_ROWS)]


def plan(question: str, model: Model | None = None) -> list[QuerySpec]:
    specs: list[QuerySpec] = []
    if model:
        try:
            specs = sanitize(json.loads(model(f"Plan queries for: {question}")))
        except (ValueError, TypeError):
            specs = []
    specs = specs or fallback(question)
    names = {s.name for s in specs}
    if PAIN.search(question.lower()):
        if "signal_evidence" not in names:
            specs.append(QuerySpec("signal_evidence", {"signal_type": "pain_point"}, limit=MOST_ROWS))
        if "source_search" not in names:
            specs.append(QuerySpec("source_search", contains=next(iter(keywords(question)), ""), limit=MOST_ROWS))
    return specs


def broaden(spec: QuerySpec) -> list[QuerySpec]:
    """Wider forms of a query without result: without text, then without filters."""
    wider = [replace(spec, contains="")] if spec.contains else []
    return wider + ([replace(spec, contains="", filters={})] if spec.filters else [])


def ask(views: dict[str, DataFrame], question: str, model: Model | None = None) -> dict[str, Any]:
    """The queries that ran with their rows, and an answer that refers to rows as ``q<query>.r<row>``."""
    results = []
    for spec in plan(question, model):
        for attempt in [spec, *broaden(spec)]:
            payload = to_payload(run(views, attempt), attempt)
            if payload["row_count"]:
                break
        results.append(payload)
    refs = [f"q{i}.r{j}" for i, p in enumerate(results, 1) for j in range(1, p["row_count"] + 1)]
    answer = model(json.dumps({"question": question, "results": results}, default=str)) if model else f"{len(refs)} rows of evidence: {', '.join(refs[:10])}"
    cited = re.findall(r"\bq\d+\.r\d+\b", answer)
    return {"question": question, "results": results, "answer": answer, "references": [r for r in cited if r in refs], "unknown_references": [r for r in cited if r not in refs]}
