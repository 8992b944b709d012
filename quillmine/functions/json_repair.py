"""Repair of JSON that a language model got slightly wrong."""

from __future__ import annotations

import json
import re
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmine.functions.arrow import with_columns

# Invisible characters to drop, and quotes to straighten.
INVISIBLE = "​‌‍⁠﻿"
QUOTES = {"“": '"', "”": '"', "‘": "'", "’": "'"}


def _outer(text: str) -> str:
    a, b = text.find("{"), text.rfind("}")
    return text[a : b + 1] if 0 <= a < b else text


def _unfenced(text: str) -> str:
    return re.sub(r"(?m)^```(?:json)?\s*\n?|\n?```\s*$", "", text).strip()


def _escaped(text: str) -> str:
    return re.sub(r'"(?:[^"\\]|\\.)*"', lambda m: m[0].replace("\n", r"\n").replace("\r", r"\r"), text, flags=re.S)


# The names of the steps and their order, which records keep.
STEPS: list[tuple[str, Callable[[str], str]]] = [
    ("strip_markdown_fences", _unfenced),
    ("extract_json_object", _outer),
    ("strip_special_chars", lambda t: t.translate(dict.fromkeys(map(ord, INVISIBLE)))),
    ("fix_smart_quotes", lambda t: t.translate(str.maketrans(QUOTES))),
    ("fix_trailing_commas", lambda t: re.sub(r",\s*([}\]])", r"\1", t)),
    ("fix_literal_newlines", _escaped),
    ("fix_single_quoted_keys", lambda t: re.sub(r"(?<!\\)'([^']+)'(?=\s*:)", r'"\1"', t)),
]


def valid(text: str) -> bool:
    try:
        json.loads(text)
    except ValueError:
        return False
    return True


def repair(raw: str | None, pattern: bool = True, model: Callable[[str], str] | None = None) -> tuple[str, str | None, str, str | None]:
    """(content, fix_applied, fix_history as JSON, error_label).

    The steps add up, one after the other, until the text parses.  ``model``, if given, gets the raw
    text where they don't suffice; an answer with ``_unrecoverable`` means that it gave up.  What can't
    be repaired is returned as it was.
    """
    raw, history = raw or "", []
    if pattern:
        if valid(raw):
            return raw, None, "[]", None
        now = raw
        for name, step in STEPS:
            now = step(now)
            history.append({"step": name, "success": valid(now)})
            if history[-1]["success"]:
                return now, "pattern", json.dumps(history), None
    if model is None:
        return raw, None, json.dumps(history), "pattern_fix_failed" if pattern else "no_repair_attempted"
    answer = model(raw)
    gave_up = valid(answer) and "_unrecoverable" in (json.loads(answer) or ())
    good = valid(answer) and not gave_up
    history.append({"step": "llm_fix", "success": good})
    if good:
        return answer, "pattern+llm" if pattern else "llm", json.dumps(history), None
    return raw, None, json.dumps(history), "unrecoverable" if gave_up else "llm_fix_failed"


def repair_frame(df: DataFrame, raw: str = "raw_response", pattern: bool = True, model: Callable[[str], str] | None = None) -> DataFrame:
    """The frame with content, fix_applied, fix_history and error_label.

    Text that Spark finds to be JSON stays as it is and in the JVM; the others are repaired once for each
    distinct text and joined back."""
    names = ("content", "fix_applied", "fix_history", "error_label")
    if not pattern:  # then every text goes to the model or fails
        return with_columns(df, [raw], f"`{raw}` string, content string, fix_applied string, fix_history string, error_label string", lambda r: (r, *repair(r, pattern, model)))
    plain = df.drop(*names).withColumn("__good", F.try_parse_json(raw).isNotNull())
    bad = plain.where(~F.col("__good")).select(F.coalesce(raw, F.lit("")).alias("__raw")).distinct()
    made = with_columns(bad, ["__raw"], "__raw string, content string, fix_applied string, fix_history string, error_label string", lambda r: (r, *repair(r, pattern, model)))
    joined = plain.join(made, ~plain["__good"] & (F.coalesce(plain[raw], F.lit("")) == made["__raw"]), "left")
    content = F.when(F.col("__good"), F.col(raw)).otherwise(F.col("content"))
    history = F.when(F.col("__good"), "[]").otherwise(F.col("fix_history"))
    return joined.select(*plain.drop("__good").columns, content.alias("content"), "fix_applied", history.alias("fix_history"), "error_label")
