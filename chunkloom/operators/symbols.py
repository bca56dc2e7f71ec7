"""Symbols of source files: functions, methods and classes with their spans.

Python is parsed with the standard library; other languages are scanned for declarations and matching braces
(Ruby: for the matching end).  A parser of one's own may be registered per language; without any, or where
parsing fails, a file is one span.  A symbol within a class is found, one within a function is not.
"""

from __future__ import annotations

import ast
import re
from collections.abc import Callable
from dataclasses import dataclass


@dataclass(frozen=True)
class Symbol:
    kind: str
    name: str
    start: int  # offset of the first character
    end: int
    line: int  # from 1


Parser = Callable[[str], list[Symbol]]
_REGISTERED: dict[str, Parser] = {}


def register(language: str, parser: Parser) -> None:
    """Takes a parser for a language, before the built-in one."""
    _REGISTERED[language] = parser


def _python(text: str) -> list[Symbol]:
    starts = [0]
    for row in text.splitlines(keepends=True):
        starts.append(starts[-1] + len(row))

    def offset(line: int, column: int) -> int:
        row = text[starts[line - 1] : starts[line]]
        return starts[line - 1] + len(row.encode("utf-8")[:column].decode("utf-8", "ignore"))

    out: list[Symbol] = []
    work: list[ast.AST] = [ast.parse(text)]
    while work:
        for node in ast.iter_child_nodes(work.pop()):
            if isinstance(node, (ast.FunctionDef, ast.AsyncFunctionDef, ast.ClassDef)):
                kind = "class" if isinstance(node, ast.ClassDef) else "function"
                out.append(Symbol(kind, node.name, offset(node.lineno, node.col_offset), offset(node.end_lineno, node.end_col_offset), node.lineno))
                if kind == "class":
                    work.append(node)
            else:
                work.append(node)
    return sorted(out, key=lambda s: (s.start, -s.end))


#: Declarations by language; the group that matched tells the kind.
_DECLARED = {
    "java": r"(?:(?:public|private|protected|static|final|abstract|synchronized|native|default)\s+)*(?:(?:class|interface|enum)\s+(?P<c>\w+)[^{;]*|(?:<[^>\n]+>\s+)?[\w.<>\[\], ?]*?\b(?P<m>\w+)\s*\([^;{}=]*\)\s*(?:throws[\w\s.,]+)?)\{",
    "javascript": r"(?:export\s+)?(?:default\s+)?(?:class\s+(?P<c>[\w$]+)[^{]*|(?:async\s+)?function\s*\*?\s*(?P<f>[\w$]+)\s*\([^{}]*\)\s*|(?:static\s+)?(?:async\s+)?(?:[gs]et\s+)?\*?(?P<m>[\w$]+)\s*\([^;{}()]*\)\s*)\{",
    "php": r"(?:(?:abstract|final|public|private|protected|static)\s+)*(?:(?:class|interface|trait)\s+(?P<c>\w+)[^{;]*|function\s+&?\s*(?P<f>\w+)\s*\([^{};]*\)[^{};]*)\{",
    "go": r"(?:func\s+\([^)]*\)\s*(?P<m>\w+)\s*(?:\[[^\]]*\])?\([^{}]*?\{|func\s+(?P<f>\w+)\s*(?:\[[^\]]*\])?\([^{}]*?\{|type\s+(?P<c>\w+)\s[^\n{]*\{)",
}
_SCAN = {k: re.compile(r"^[ \t]*" + v, re.M) for k, v in _DECLARED.items()}
_RUBY = re.compile(r"^(?P<i>[ \t]*)(?:(?:class|module)\s+(?P<c>[\w:]+)|def\s+(?P<s>self\.)?(?P<m>[\w]+[?!=]?))", re.M)
_NOT_NAMES = frozenset("if for while switch catch return else do new throw try function with synchronized".split())
_TOKENS = re.compile(r"//[^\n]*|/\*.*?\*/|\"(?:[^\"\\\n]|\\.)*\"|'(?:[^'\\\n]|\\.)*'|`(?:[^`\\]|\\.)*`|[{}]", re.S)


def _close(text: str, opening: int) -> int | None:
    depth = 0
    for m in _TOKENS.finditer(text, opening):
        if m.group() == "{":
            depth += 1
        elif m.group() == "}":
            depth -= 1
            if not depth:
                return m.end()
    return None


def _braces(language: str) -> Parser:
    pattern = _SCAN[language]

    def parse(text: str) -> list[Symbol]:
        out: list[Symbol] = []
        classes: list[tuple[int, int]] = []
        at = 0
        while m := pattern.search(text, at):
            groups = m.groupdict()
            kind, name = next(((k, groups[k]) for k in ("c", "f", "m") if groups.get(k)), ("", ""))
            end = _close(text, m.end() - 1)
            if name in _NOT_NAMES or end is None:
                at = m.end()
                continue
            start = m.start() + len(m.group()) - len(m.group().lstrip())
            inside = any(a < start < b for a, b in classes)
            label = "class" if kind == "c" else "method" if kind == "m" or inside and language == "php" else "function"
            out.append(Symbol(label, name, start, end, text.count("\n", 0, start) + 1))
            if kind == "c":
                classes.append((start, end))
                at = m.end()
            else:
                at = end
        return out

    return parse


def _ruby(text: str) -> list[Symbol]:
    out: list[Symbol] = []
    until = -1
    for m in _RUBY.finditer(text):
        if m.start() < until:
            continue
        close = re.compile(rf"^{m.group('i')}end\b", re.M).search(text, m.end())
        if not close:
            continue
        start = m.start() + len(m.group("i"))
        kind = "class" if m.group("c") else "method"
        out.append(Symbol(kind, m.group("c") or m.group("m"), start, close.end(), text.count("\n", 0, start) + 1))
        if kind == "method":
            until = close.end()
    return out


_BUILT_IN: dict[str, Parser] = {"python": _python, "ruby": _ruby, **{k: _braces(k) for k in _SCAN}}


def symbols(text: str, language: str) -> list[Symbol]:
    """The symbols of a file by position; none where there is no parser or the text does not parse."""
    parser = _REGISTERED.get(language) or _BUILT_IN.get(language)
    if parser is None:
        return []
    try:
        return parser(text)
    except Exception:  # any parser's failure means: the file is one span
        return []
