"""Model backends: a protocol, mocks that run anywhere, and a registry."""

import json
import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from typing import Protocol


class TooLong(Exception):
    """A prompt doesn't fit the model's context."""


@dataclass
class BatchStats:
    prompts: int = 0
    batches: int = 0
    failures: int = 0


class Backend(Protocol):
    """A language model. Made once a Python worker, on first use."""

    stats: BatchStats

    def generate(self, prompt: str) -> str: ...
    def generate_batch(self, prompts: list[str]) -> list[str]: ...
    def generate_raw(self, prompt: str, **options) -> str: ...
    def generate_raw_batch(self, prompts: list[str], **options) -> list[str]: ...
    def count_tokens(self, text: str) -> int: ...
    def is_loaded(self) -> bool: ...
    def cleanup(self) -> None: ...


@dataclass
class MockBackend:
    """Replies by a function of the prompt."""

    reply: Callable[[str], str] = field(default=lambda prompt: '{"summary": "Mock summary.", "occupation_mentions": []}')
    stats: BatchStats = field(default_factory=BatchStats)

    def generate(self, prompt: str) -> str:
        self.stats.prompts += 1
        return self.reply(prompt)

    def generate_batch(self, prompts: list[str]) -> list[str]:
        self.stats.batches += 1
        return [self.generate(p) for p in prompts]

    def generate_raw(self, prompt: str, **options) -> str:
        return self.generate(prompt)

    def generate_raw_batch(self, prompts: list[str], **options) -> list[str]:
        return self.generate_batch(prompts)

    def count_tokens(self, text: str) -> int:
        return -(-len(text) // 4)

    def is_loaded(self) -> bool:
        return True

    def cleanup(self) -> None:
        pass


def mock_reply(prompt: str) -> str:
    """What a sensible model would say, by rules: verdicts of spans, repaired names, YES or NO, named places."""
    head, _, rest = prompt.partition("\n")
    if "YES or NO" in head:
        words = rest.split()
        return "YES" if len(words) >= 2 and all(w[:1].isupper() for w in words) else "No."
    if "evidence_text" in head:
        start = int(re.search(r"offset (\d+)", head)[1])
        return json.dumps([{"evidence_text": m[0], "start": start + m.start(), "end": start + m.end(), "role": "mentioned"} for m in re.finditer("[A-Z][a-z]+ [A-Z][a-z]+", rest)])
    if "span_index" in head:
        items = json.JSONDecoder().raw_decode(rest)[0]
        bad = lambda t: next((r for r, parts in (("organization", ("inc", "corp", "llc", "ltd", "company")), ("location", ("new york", "los angeles", "florida", "california"))) if any(p in t.lower() for p in parts)), None)
        return "Verdicts: " + json.dumps([{"span_index": x["span_index"], "is_person": bad(x["text"]) is None, "role": "mentioned", "drop": bad(x["text"]) is not None, "reason": bad(x["text"])} for x in items])
    if "spelling" in head:
        return json.dumps([{"index": x["index"], "name": " ".join(x["text"].translate(str.maketrans("015|", "OISl")).split())} for x in json.loads(rest)])
    return '{"summary": "Mock summary.", "occupation_mentions": []}'


def halving(run: Callable[[list], list], items: list, default=None) -> list:
    """run(items); on a memory error, its halves, down to single items, which give ``default``."""
    if not items:
        return []
    try:
        return run(items)
    except MemoryError:
        if len(items) == 1:
            return [default]
        half = len(items) // 2
        return halving(run, items[:half], default) + halving(run, items[half:], default)


def _optional(module: str, make: str) -> Callable[[], Backend]:
    def build() -> Backend:
        import importlib

        try:
            return getattr(importlib.import_module(module), make)()
        except ModuleNotFoundError as missing:
            raise RuntimeError(f"the backend needs {missing.name}, which isn't installed") from missing

    return build


#: Names to makers. Heavy ones live in modules of their own that a deployment brings along.
REGISTRY: dict[str, Callable[[], Backend]] = {"mock": MockBackend, "rules": lambda: MockBackend(mock_reply), "transformers": _optional("lexforge_transformers", "make"), "vllm": _optional("lexforge_vllm", "make")}
_MADE: dict[str, Backend] = {}


def register(name: str, make: Callable[[], Backend]) -> None:
    REGISTRY[name] = make
    _MADE.pop(name, None)


def backend(name: str | Callable[[], Backend]) -> Backend:
    """This worker's backend of the name; ValueError for unknown ones. A maker in place of a name is called once a task."""
    if callable(name):
        return name()
    if name not in REGISTRY:
        raise ValueError(f"unknown backend {name!r}; one of {sorted(REGISTRY)}")
    if name not in _MADE:
        _MADE[name] = REGISTRY[name]()
    return _MADE[name]


class Tagger(Protocol):
    """Entities of texts: for each, dicts of start, end, word, entity_type, confidence."""

    def tag(self, texts: list[str]) -> list[list[dict]]: ...


class MockTagger:
    """Runs of capitalised words of three characters or more, as persons."""

    RUN = re.compile(r"(?<![^\W])[A-Z][a-z]+(?:\s+[A-Z][a-z]+)*(?![^\W])")

    def tag(self, texts):
        return [[{"start": m.start(), "end": m.end(), "word": m[0], "entity_type": "PER", "confidence": 0.7} for m in self.RUN.finditer(t) if len(m[0]) >= 3] for t in texts]


TAGGERS: dict[str, Callable[[], Tagger]] = {"mock": MockTagger, "transformers": _optional("lexforge_tagger", "make")}
_TAGGERS: dict[str, Tagger] = {}


def tagger(name: str) -> Tagger:
    """This worker's tagger of the name; ValueError for unknown ones."""
    if name not in TAGGERS:
        raise ValueError(f"unknown tagger {name!r}; one of {sorted(TAGGERS)}")
    if name not in _TAGGERS:
        _TAGGERS[name] = TAGGERS[name]()
    return _TAGGERS[name]


class Recogniser(Protocol):
    """Text of page images: (text, confidence) of each."""

    def read(self, images: Iterable[bytes]) -> list[tuple[str, float]]: ...


class MockRecogniser:
    """Takes an image's bytes for UTF-8 text; '' and 0 where they aren't."""

    def read(self, images):
        out = []
        for data in images:
            try:
                out.append((bytes(data or b"").decode(), 0.95 if data else 0.0))
            except UnicodeDecodeError:
                out.append(("", 0.0))
        return out
