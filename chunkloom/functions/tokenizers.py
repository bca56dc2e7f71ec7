"""Tokenizers as plug-ins: what cuts a text into [start, stop) spans of tokens, loaded once per worker."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache

from chunkloom.functions.text import TOKEN

Tokenizer = Callable[[str], list[tuple[int, int]]]
_REGISTERED: dict[str, Callable[[], Tokenizer]] = {}
_RE = re.compile(TOKEN)


def register(name: str, make: Callable[[], Tokenizer]) -> None:
    """Takes a tokenizer by name; `make` runs once per worker, so it may load a model."""
    _REGISTERED[name] = make
    load.cache_clear()


def by_expression(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _RE.finditer(text)]


@lru_cache(maxsize=4)
def load(name: str = "regex") -> Tokenizer:
    """The tokenizer of a name: regex, a registered one, or the path of a tokenizer.json file; others raise ValueError.

    Special tokens are not added, and tokens without characters of their own are left out.
    """
    if name in _REGISTERED:
        return _REGISTERED[name]()
    if name == "regex":
        return by_expression
    if name.endswith(".json"):
        from tokenizers import Tokenizer as Model

        model = Model.from_file(name)
        return lambda text: [(a, b) for a, b in model.encode(text, add_special_tokens=False).offsets if b > a]
    raise ValueError(f"unknown tokenizer {name!r}")
