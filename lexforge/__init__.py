"""A PySpark-native engine for document-intelligence pipelines.

``lexforge.tier_one`` and the other names below are imported when they are first used,
so that a part whose libraries are missing doesn't keep the rest from loading.
"""

from importlib import import_module

_WHERE = {
    "Options": "plans.pipeline", "tier_one": "plans.pipeline", "tier_two": "plans.pipeline", "document_names": "plans.pipeline", "extracted": "sources.files", "discovered": "sources.files",
    "backend": "sources.backends", "register": "sources.backends", "tagger": "sources.backends", "classified": "operators.models", "recovered": "operators.models", "entities": "operators.models",
    "validated_names": "operators.models", "documents_summarised": "operators.summaries", "clean_files": "operators.names", "issues": "operators.validation",
}
__all__ = sorted(_WHERE)


def __getattr__(name: str):
    if name not in _WHERE:
        raise AttributeError(f"module {__name__!r} has no attribute {name!r}")
    return getattr(import_module(f"{__name__}.{_WHERE[name]}"), name)
