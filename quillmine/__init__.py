"""quillmine: a PySpark-native engine for mining scientific literature."""

from importlib import import_module

# Where each exported name lives.  They are loaded when they are asked for, since Python workers import this package
# for every function that they run.
_HOMES = {
    "DedupConfig": "operators.dedup", "deduplicate": "operators.dedup", "Query": "operators.explore", "explore": "operators.explore", "Spine": "spine", "load_config": "plans.config",
    "ExtractStep": "plans.steps", "FetchStep": "plans.steps", "Step": "plans.steps", "list_steps": "plans.steps", "register": "plans.steps", "run": "plans.steps",
}
__all__ = sorted(_HOMES)


def __getattr__(name: str):
    if name not in _HOMES:
        raise AttributeError(f"module {__name__!r} has no attribute {name!r}")
    return getattr(import_module(f"{__name__}.{_HOMES[name]}"), "load" if name == "load_config" else name)
