"""Answers of language models as data: fenced JSON arrays and objects. Arrow UDFs, as the rules are Python's JSON."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import functions as F

PAIRS = "array<struct<question:string,answer:string>>"
VERDICT = "struct<score:double,reason:string>"


def unfenced(text: str) -> str:
    for fence in ("```json", "```"):
        if fence in text:
            rest = text.split(fence, 1)[1]
            return rest.split("```", 1)[0]
    return text


def between(text: str, first: str, last: str) -> str | None:
    a, z = text.find(first), text.rfind(last)
    return text[a : z + 1] if 0 <= a < z else None


def qa_pairs(text: str | None) -> list[dict] | None:
    """Pairs of a response; null where there is no JSON array or no pair in it."""
    body = between(unfenced(text or "").strip(), "[", "]")
    try:
        rows = json.loads(body) if body else None
    except ValueError:
        return None
    if not isinstance(rows, list):
        return None
    good = [{"question": str(r["question"]).strip(), "answer": str(r["answer"]).strip()} for r in rows if isinstance(r, dict) and "question" in r and "answer" in r]
    return good or None


def verdict(text: str | None) -> dict:
    """score and reason of a judgement; 5.0 and 'Parse error' where it can't be read."""
    body = between(unfenced(text or "").strip(), "{", "}")
    try:
        got = json.loads(body) if body else None
        return {"score": float(got.get("score", 5)), "reason": str(got.get("reason", "N/A"))}
    except (ValueError, TypeError, AttributeError):
        return {"score": 5.0, "reason": "Parse error"}


def json_list(text: str | None) -> str | None:
    """The first JSON list of a text, greedily, then lazily, as JSON; null without one."""
    for pattern in (r"\[[\s\S]*\]", r"\[[\s\S]*?\]"):
        for m in re.finditer(pattern, text or ""):
            try:
                got = json.loads(m.group())
            except ValueError:
                continue
            if isinstance(got, list):
                return json.dumps(got, ensure_ascii=False)
    return None


# The UDFs are made when they are used: their types need a session.
def parse_pairs(text):
    return F.pandas_udf(_pairs, PAIRS)(text)


def parse_verdict(text):
    return F.pandas_udf(_verdicts, VERDICT)(text)


def parse_list(text):
    return F.pandas_udf(_lists, "string")(text)


def _pairs(texts: pd.Series) -> pd.Series:
    return texts.map(qa_pairs)


def _verdicts(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([verdict(t) for t in texts], columns=["score", "reason"])


def _lists(texts: pd.Series) -> pd.Series:
    return texts.map(json_list)
