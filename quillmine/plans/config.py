"""Configuration: defaults, the user's YAML and overrides, merged key by key."""

from __future__ import annotations

from copy import deepcopy

STEPS = ("fetch", "parse", "deduplicate", "filter", "extract")
PLANNED = ("embed", "reduce", "cluster", "sample", "score", "trend", "rag", "patent", "export")
DEFAULTS = {
    "general": {"output_dir": "./output", "steps": ["fetch", "parse", "deduplicate"], "on_error": "fail"},
    "fetch": {"transport": "quillmine.sources.eutils:call", "query": "", "start": "2000/01/01", "end": None, "batch": 200, "rate": 3, "readers": 1, "cache": None, "ttl": None, "tolerate": 20},
    "parse": {"prepare_llm_input": False, "flag_exclusions": False},
    "deduplicate": {"check_doi": True, "check_title_fuzzy": True, "fuzzy_threshold": 90.0, "remove_retracted": True},
    "filter": {"keywords": [], "min_author_matches": 1, "output_column": "matches", "also_check_columns": [], "case_sensitive": False, "drop_non_matching": False},
    "extract": {"schema_name": "default", "fields": [], "pattern_fix": True, "max_error_rate": 1.0, "max_cost_usd": None, "filter_column": None, "include_title": True, "include_abstract": True, "extra_columns": [], "user_instruction": "", "wave": 1000, "concurrency": 4, "run_id": "default", "client": None, "url": "", "model": "", "key_variable": "CHAT_API_KEY"},
}


def merge(base: dict, over: dict) -> dict:
    out = deepcopy(base)
    for key, value in over.items():
        out[key] = merge(out[key], value) if isinstance(value, dict) and isinstance(out.get(key), dict) else deepcopy(value)
    return out


def load(path: str | None = None, overrides: dict | None = None) -> dict:
    import yaml

    user = {}
    if path:
        with open(path) as f:
            user = yaml.safe_load(f) or {}
    config = merge(merge(DEFAULTS, user), overrides or {})
    for step in config["general"]["steps"]:
        if step in PLANNED:
            raise NotImplementedError(f"step {step!r} is not yet implemented")
        if step not in STEPS:
            raise ValueError(f"unknown step {step!r}")
    return config
