"""Teachers label sentences in batches; the one here needs no network and always says the same."""
from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame

SCHEMA = "pred_label string, confidence double"


class Teacher(Protocol):
    """Replies to a batch of prompts with a JSON list of {label, confidence}, in order."""

    def reply(self, prompts: list[str]) -> str: ...


class LexiconTeacher:
    """Counts words of praise and of blame."""

    def __init__(self, good: frozenset[str], bad: frozenset[str]) -> None:
        self.good, self.bad = good, bad

    def reply(self, prompts: list[str]) -> str:
        out = []
        for p in prompts:
            words = p.lower().split()
            g, b = (0 if own.isdisjoint(words) else sum(w in own for w in words) for own in (self.good, self.bad))
            out.append({"label": "POS" if g > b else "NEG" if b > g else "NEU", "confidence": 0.5 + 0.5 * abs(g - b) / max(1, g + b)})
        return json.dumps(out)


def parse_reply(text: str) -> list[dict]:
    """The list in a reply, out of code fences or out of an object that holds it; nothing if there is none."""
    body = text.strip().removeprefix("```json").removeprefix("```").removesuffix("```").strip()
    try:
        value = json.loads(body)
    except ValueError:
        a, b = body.find("["), body.rfind("]")
        try:
            value = json.loads(body[a : b + 1]) if 0 <= a < b else []
        except ValueError:
            return []
    if isinstance(value, dict):
        value = next((v for v in value.values() if isinstance(v, list)), [])
    return [v for v in value if isinstance(v, dict)]


def label(rows: DataFrame, teacher: Teacher, prompt: str, batch: int = 20, retries: int = 2) -> DataFrame:
    """rows with pred_label and confidence. Replies count by position: what a short reply leaves over, and batches that fail after retries, are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            prompts = rows.column(prompt).to_pylist()
            kept, labels, sure = [], [], []
            for a in range(0, len(prompts), batch):
                part = prompts[a : a + batch]
                for _ in range(retries + 1):
                    try:
                        replies = parse_reply(teacher.reply(part))
                        break
                    except OSError:
                        replies = []
                replies = replies[: len(part)]
                kept += range(a, a + len(replies))
                names = [str(r.get("label", "")).upper() for r in replies]
                labels += ["POS" if "POS" in n else "NEG" if "NEG" in n else "NEU" for n in names]
                sure += [float(r.get("confidence", 0)) for r in replies]
            told = rows if len(kept) == len(prompts) else rows.take(pa.array(kept, pa.int64()))
            yield pa.RecordBatch.from_arrays([*told.columns, pa.array(labels, pa.string()), pa.array(sure, pa.float64())], [*rows.schema.names, "pred_label", "confidence"])

    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{names}, {SCHEMA}")
