"""Documentation within code: taking it out as a query, and taking it off the body that is searched.

The two disagree on purpose where the engine's users expect it: a query may come from the first documented
definition anywhere in a chunk (its parameter list may span lines), while stripping only takes what leads
the chunk and wants the header on one line.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Line comment marks by language; languages with block comments.
LINE_MARK = {"java": "//", "javascript": "//", "php": "//", "go": "//", "ruby": "#"}
BLOCK_LANGUAGES = frozenset(("java", "javascript", "php", "go"))

#: The patterns that decide which text is documentation and where its first sentence ends.
_QUOTES = ('"""', "'''")
_DEFINITION = re.compile(r"(?:def|class)\s+\w+\s*\([^)]*\)\s*(?:->[^:]+)?:\s*\n\s*[rub]?")
_GUTTER = re.compile(r"^\s*\*\s?", re.M)
_SENTENCE_END = re.compile(r"(?<=[.!?])\s")
_HEADER = re.compile(r"\s*(?:async\s+)?(?:def|class)\b[^\n]*:\s*\n")


def clean(raw: str) -> str:
    """One line without gutter marks: the first sentence."""
    line = " ".join(_GUTTER.sub("", raw.strip()).split())
    return _SENTENCE_END.split(line, maxsplit=1)[0].strip() if line else ""


def _between(text: str, start: int, closing: str) -> str | None:
    end = text.find(closing, start)
    return None if end < 0 else text[start:end]


def extract(text: str | None, language: str | None) -> str:
    """The query that a chunk's own documentation gives, or the empty text."""
    if not text:
        return ""
    if language == "python":
        for m in _DEFINITION.finditer(text):
            quote = text[m.end() : m.end() + 3]
            if quote in _QUOTES and (body := _between(text, m.end() + 3, quote)) is not None:
                return clean(body)
    opening = text.find("/**")
    body = None if opening < 0 else _between(text, opening + 3, "*/")
    return clean(body) if body is not None else ""


def strip_line_comments(text: str, mark: str) -> str:
    """Without the comment lines that lead the text, and the blank lines among them."""
    lines = text.split("\n")
    body = next((i for i, s in enumerate(map(str.strip, lines)) if s and not s.startswith(mark)), len(lines))
    led = any(s.strip() for s in lines[:body])
    return "\n".join(lines[body:]) if led else text


def _strip_python(text: str) -> str:
    header = _HEADER.match(text)
    at = header.end() if header else 0
    body = text[at:]
    quoted = len(body) - len(body.lstrip(" \t" if header else None))
    if header and not quoted:
        header, at, body = None, 0, text
        quoted = len(body) - len(body.lstrip())
    prefix = re.match(r"[rRuUbB]{0,2}", body[quoted:]).end()
    quote = body[quoted + prefix : quoted + prefix + 3]
    if quote not in _QUOTES:
        return text
    close = body.find(quote, quoted + prefix + 3)
    if close < 0:
        return text
    kept = text[:at] if header else text[: quoted + prefix]
    return kept + body[close + 3 :]


def strip_leading(text: str | None, language: str | None) -> str | None:
    """The text without its leading documentation; unchanged if it has none that is recognised.

    Null stays null and empty stays empty; an unterminated docstring stays; unknown languages are unchanged.
    """
    if not text:
        return text
    if language == "python":
        return _strip_python(text)
    if language in BLOCK_LANGUAGES:
        lead = len(text) - len(text.lstrip())
        if text.startswith("/*", lead) and (end := text.find("*/", lead + 2)) >= 0:
            rest = text[end + 2 :].lstrip(" \t")
            return rest[1:] if rest.startswith("\n") else rest
    return strip_line_comments(text, LINE_MARK[language]) if language in LINE_MARK else text


@F.pandas_udf(StringType())
def extract_docstring(text: pd.Series, language: pd.Series) -> pd.Series:
    return pd.Series([extract(t, g) for t, g in zip(text, language)])


@F.pandas_udf(StringType())
def strip_leading_doc(text: pd.Series, language: pd.Series) -> pd.Series:
    return pd.Series([strip_leading(t, g) for t, g in zip(text, language)])
