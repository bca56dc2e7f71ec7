"""Problem 6: files that nobody wrote by hand here: generated, minified, vendored, or data stored as code.

Three linear support-vector classifiers decide, each over hashed features: the text's character n-grams (as they
are, and folded to character classes, which tell the shape of data and minified code), the path's components and
their parts, and the n-grams of single lines, which find the notices that name a generator or a copied release.
Lines that are notices or name a licence are masked in the text's n-grams.  A row counts if one classifier scores
it over its margin, a file if one of its rows does.

They are trained on a bounded sample of rows, which giveaways label (rules on notices, tool paths and shapes), and
on the fixed examples below, so that small tables know the common forms too.  The rules label only: they are no
features and have no part in the verdict.  Repositories are split into training and validation by a hash of their
canonical name; margins and figures come from the validation repositories.
"""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkloom.llm.common import spread
from chunkloom.llm.grouped_split import canonical_or_self

#: Documented bounds of the fit: sampled rows, characters of a sampled text, lines, hashed dimensions, passes over them.
SAMPLE_ROWS, SAMPLE_TEXT, SAMPLE_LINES, DIMENSIONS, PATH_DIMENSIONS, PASSES = 6000, 8000, 8000, 1 << 18, 1 << 20, 12

#: Folders of third-party copies and of generated code.
VENDOR_DIRS = frozenset("vendor third_party third-party thirdparty node_modules bower_components jspm_packages deps external externals extern godeps site-packages dist-packages pods carthage plugins_vendor vendored".split())
GENERATED_DIRS = frozenset("__generated__ generated-sources generated-src autogen gen-src gensrc".split())
CONFIG_ENDINGS = frozenset("env yml yaml properties ini cfg conf config toml tfvars tf hcl xml json txt pem key md rst lock example dist sample template".split())
_FILE_MARK = re.compile(r"(?i)(?:[.\-]min|\.bundle|\.chunk|\.pb|_pb2(?:_grpc)?|\.pb2|\.g|\.designer|\.generated|\.gen|_generated|\.freezed|\.g4)\.[a-z]+$|(?:^|/)\d{3,}_auto_[^/]*$|(?:^|/)zz_generated[^/]*$")
_PATH_MARK = re.compile(r"(?i)(?:^|/)(?:build|target|out|obj)/generated/|(?:^|/)generated/(?:sources|src)/|^(?:gen|generated)/|(?:^|/)(?:public|static|web|wwwroot)/(?:assets|lib|libs|js)/(?:plugins|vendors?|lib|libs)/")

_C = r"^\s*(?://|#|/?\*+!?|--|;|<!--|%|\"\"\"|'''|)\s*"
#: Notices that tools write, as patterns on one line.
GENERATED_NOTICE = re.compile(
    _C
    + r"""(?ix:
    (?:this\ (?:file|code|class|module)\ (?:was|is|has\ been)\ )?(?:code\ |file\ |auto(?:matically)?[\ -]?)*generated\ (?:by|with|from|using|on\ \d)\b.*\d.*
    |.*\bautomatically\ generated\ (?:by|from|with|using)\ [\w.-]+(?!\ method).*
    |.*<auto-?generated\s*/?>.*
    |@generated\b.*
    |auto-?generated\ file\b.*
    |.*\bcode\ generated\ by\ [\w./-]+\ .*do\ not\ (?:edit|modify|change).*
    |.*\b(?:do\ not|don't)\ (?:edit|modify|change)\b.*\b(?:generated|regenerate|overwritten)\b.*
    |.*\bproduced\ by\ the\ [\w-]+\ (?:compiler|generator|tool)\b.*(?:instead\ of\ this\ output|\.tmpl|\.def).*
    |.*\bedits\ here\ get\ overwritten.*
    |.*\bregenerate\ with\b.*
    |.*\b(?:automatisch|maschinell)\b.*\b(?:erzeugt|generiert|erstellt)\b.*(?:nicht|hand|manuell).*
    |.*\bg[ée]n[ée]r[ée]e?s?\ (?:automatiquement|par)\b.*
    |.*\bgenerad[oa]s?\ (?:autom[áa]ticamente|por)\b.*
    |.*\b(?:ne\ pas\ modifier|no\ (?:editar|modificar)|nicht\ (?:von\ hand|manuell|bearbeiten|[äa]ndern))\b.*
    |.*(?:自动生成|請勿|请勿(?:手动)?(?:修改|编辑)).*
    )$"""
)
VENDORED_NOTICE = re.compile(
    _C
    + r"""(?ix:
    (?:imported|vendored|taken|pulled)\ from\ [\w.-]+\ v?\d[\w.]*\b.*
    |copied\ (?:verbatim|unchanged|unmodified)\b.*\b(?:distribution|release|version|upstream)\b.*
    |this\ file\ is\ part\ of\ [\w.-]+\ v?\d[\w.]*.*\bupstream\b.*
    |.*\bfor\ the\ terms\ of\ this\ bundled\ copy.*
    |.*\bbundled\ copy\ of\ [\w.-]+\ v?\d.*
    |!?\s*[\w.-]+\ v\d+\.\d+(?:\.\d+)?\ \|\ \(c\)\ .*
    )$"""
)
#: A banner over several lines: name and release, an address, authors and licence.
BANNER = re.compile(r"^[ \t]*(?://|#|/?\*+!?)[ \t]*[\w.-]+ v\d+\.\d+(?:\.\d+)?[ \t]*\n[ \t]*(?://|#|\*)[ \t]*(?:https?://\S+[ \t]*\n[ \t]*(?://|#|\*)[ \t]*)?\(c\) [\w.-]+ authors\b.*$", re.M)
#: A format with a gap for the generator's name is code that writes notices.
_TEMPLATE = re.compile(r"%[sdv]|\{\w*\}|\$\{|<%|[\"'`].*(?i:generated|do not edit)")

_NUMBER_ROW = re.compile(r"^\s*(?:[\[{(]*\s*)?(?:-?(?:0x[0-9a-fA-F]+|\d+(?:\.\d+)?(?:[eE][+-]?\d+)?)[LlfFuU]?\s*,\s*){5,}")
_RECORD_ROW = re.compile(r"^\s*[\[{(]\s*[\"']?\w+[\"']?\s*[:=,]\s*[\"']?[-\w.]+[\"']?\s*,.*[\]})]\s*,?\s*$")
_LONG_STRING = re.compile(r"[A-Za-z0-9+/=]{160,}")
_QUOTED_ROW = re.compile(r"^\s*[\"'][A-Za-z0-9+/=]{40,}[\"']\s*[+,.\\]?\s*;?\s*$")


def path_evidence(path: str | None) -> str | None:
    """vendored | generated | minified by the path alone; None if it shows nothing."""
    if not path:
        return None
    low = path.lower().replace("\\", "/")
    dirs = low.split("/")[:-1]
    if any(d in VENDOR_DIRS for d in dirs) or re.search(r"(?:^|/)(?:public|static|web|wwwroot)/(?:assets|lib|libs|js)/(?:plugins|vendors?|libs?)/", low):
        return "vendored"
    if any(d in GENERATED_DIRS for d in dirs) or _PATH_MARK.search(low):
        return "generated"
    if m := _FILE_MARK.search(low):
        return "minified" if re.search(r"min\.|bundle|chunk", m.group()) else "generated"
    return None


def is_config(path: str | None) -> bool:
    """Configuration and prose files are hand-written by definition."""
    name = (path or "").lower().rsplit("/", 1)[-1]
    return name.rsplit(".", 1)[-1] in CONFIG_ENDINGS or name.startswith(".env")


#: Characters of a line that are one part; of a longer line such windows at half their distance are tested, and each comment.
PART = 400
_COMMENT = re.compile(r"/\*(?:(?!\*/|/\*).)*|<!--(?:(?!-->|<!--).)*|(?<![:\w])//[ !][^/]*")


def _parts(line: str) -> Iterator[tuple[str, str]]:
    """(part, text to test) of a line; in the windows behind the first one only phrases count that may stand anywhere."""
    yield line[:PART], line[:PART]
    if len(line) > PART:
        for m in _COMMENT.finditer(line):
            yield m.group(), m.group()
        for a in range(PART // 2, len(line) - PART // 2, PART // 2):
            yield line[a : a + PART], "x " + line[a : a + PART]


def notice_lines(text: str) -> list[tuple[str, str]]:
    """(kind, line) of the notices within a text; of a line of over 400 characters the part that holds the notice."""
    out = []
    for line in text.split("\n"):
        if len(line) < 8:
            continue
        for part, line in _parts(line):
            low = part.lower()
            if not any(q in low for q in _QUICK):
                continue
            if GENERATED_NOTICE.match(line) and not _TEMPLATE.search(line) and "method stub" not in line:
                out.append(("generated", part))
            elif VENDORED_NOTICE.match(line) and not re.search(r"[\"'`]\s*;?\s*$", line):
                out.append(("vendored", part))
    return out


_QUICK = tuple("generat|produced by|overwritten|imported from|vendored|taken from|pulled from|copied|upstream|bundled|automatisch|maschinell|génér|gener|generad|nicht |ne pas|no edit|no modif|自动|请勿|請勿| v0.| v1.| v2.| v3.| v4.| v5.| v6.| v7.| v8.| v9.|(c) ".split("|"))


def _may_have_notice(text: str) -> bool:
    """A cheap test that every notice passes."""
    low = text.lower()
    return any(q in low for q in _QUICK)


_ROW_START = frozenset("0123456789-[{(\"'")


def shape_evidence(text: str) -> str | None:
    """minified | data by the text's shape; None if a hand may have made it."""
    n = len(text)
    if n < 60:
        return None
    lines = [y for x in text.split("\n") if (y := x.strip())]
    longest = max(map(len, lines), default=0)
    if longest >= 160:
        if sum(map(len, _LONG_STRING.findall(text))) > 0.5 * n:
            return "data"
        if longest > 300 and sum(len(x) for x in lines if len(x) > 300) > 0.6 * n:
            space = sum(text.count(c) for c in " \t\n")
            if space < 0.12 * n and sum(text.count(c) for c in "(){}[];,=:.?|&!") > 0.12 * n:
                return "minified"
    if len(lines) >= 4:
        starts = [x for x in lines if x[0] in _ROW_START]
        if len(starts) > 0.6 * len(lines) and sum(bool(_NUMBER_ROW.match(x) or _RECORD_ROW.match(x) or _QUOTED_ROW.match(x)) for x in starts) > 0.6 * len(lines):
            return "data"
    return None


def text_evidence(text: str | None) -> str | None:
    if not text or not text.strip():
        return None
    if _may_have_notice(text):
        found = notice_lines(text)
        if found:
            return found[0][0]
        if BANNER.search(text):
            return "vendored"
    return shape_evidence(text)


#: Examples of notices and of lines that are none, of paths of tools and of files by hand; ~ is a name, .? any language.
NOTICE_EXAMPLES = (
    "// Code generated by ~ 1.20.3. DO NOT EDIT.", "# Code generated by ~ 3.1.0. DO NOT EDIT.", "// @generated by ~", "# @generated by ~", "/* @generated */", "// <auto-generated/>",
    "# This file was automatically generated by ~ v2.4.1 from ~.def.", "// This file was automatically generated by ~ v2.4.1 from ~.def.", "# AUTOGENERATED FILE -- regenerate with `make ~`",
    "// AUTOGENERATED FILE -- regenerate with `make ~`", "// Generated on 2021-03-04 with ~ (4.2.0); edits here get overwritten", "# Generated on 2021-03-04 with ~ (4.2.0); edits here get overwritten",
    "// Produced by the ~ compiler. Please change ~.tmpl instead of this output.", "# Produced by the ~ compiler. Please change ~.tmpl instead of this output.", "# Generated by the protocol buffer compiler.  DO NOT EDIT!",
    "// Diese Datei wurde automatisch von ~ erzeugt und darf nicht von Hand geändert werden.", "# Diese Datei wurde automatisch von ~ erzeugt und darf nicht von Hand geändert werden.",
    "// Ce fichier a été généré automatiquement par ~ ; ne pas modifier.", "# Archivo generado automáticamente por ~; no editar.", "// 此文件由 ~ 自动生成，请勿手动修改。",
    "# Imported from ~ 1.2.3 (rev 0a1b2c3d), no local changes.", "// Imported from ~ 1.2.3 (rev 0a1b2c3d), no local changes.", "# Copied verbatim out of the ~ distribution, release 2.3.4. Report bugs there.",
    "// Copied verbatim out of the ~ distribution, release 2.3.4. Report bugs there.", "// This file is part of ~ 2.3.4; upstream lives at https://code.example/~.", "# This file is part of ~ 2.3.4; upstream lives at https://code.example/~.",
    "# ~ -- version 2.3.4 -- see ~ LICENSE for the terms of this bundled copy", "// ~ -- version 2.3.4 -- see ~ LICENSE for the terms of this bundled copy", "/*! ~ v1.2.3 | (c) ~ authors | MIT */",
    "// (c) ~ authors, released under MIT", "// (c) ~ authors, released under BSD-3-Clause", "# (c) ~ authors, released under Apache-2.0",
)
OTHER_EXAMPLES = (
    'tmpl = "// Code generated by %s; DO NOT EDIT. ~"', 'const tmpl = `// Code generated by ${name}; DO NOT EDIT.`', "// Auto-generated method stub", "# TODO: generate the docs of ~ by hand", "// Copyright 2020 the ~ contributors",
    "# SPDX-License-Identifier: MIT", "def ~(~, ~):", "    return ~.~(~)", "    return [~ for ~ in ~(~)]", "import ~.~", "from ~ import ~", "const ~ = require('~');", "public static void ~(String ~) {", "    for (int i = 0; i < ~.size(); i++) {",
    "    if ~ is not None and ~ != 0:", "func (~ *~) ~(~ string) error {", "$this->~ = $~['~'];", "  def ~(~)", "class ~ extends ~ {", '    ~ = "~ ~ ~"', "# reads the ~ of each ~", "// keep the ~ near the ~", " * @param ~ the ~ to ~", "  ~.each do |~|", "package ~.~;",
    "// Licensed under the Apache License, Version 2.0", "# generates the report of ~ and writes it", "// edit this by hand if ~ fails", "import ~ from '~'", "# the generated file of ~ lies in build", "// copies ~ into the vendor folder",
)
PATH_EXAMPLES = (
    *(f"~/{d}/~/~.?" for d in sorted(VENDOR_DIRS)), *(f"~/{d}/~.?" for d in sorted(VENDOR_DIRS | GENERATED_DIRS)), "public/assets/plugins/~.?", "static/js/vendors/~.?", "build/generated/~/~.?", "~/generated/sources/~.?", "gen/~/~.?", "~/zz_generated_~.?",
    *(f"~/~{e}.?" for e in (".min", "-min", ".bundle", ".chunk", "_pb2", "_pb2_grpc", ".pb", ".g", ".designer", ".generated", ".gen", "_generated", ".freezed")), "~/0012_auto_~.?",
)
HAND_PATHS = ("~/~/~.?", "~/~.?", "~/~_~.?", "~.?", "~_~_~.?", "tools/code_generator.?", "src/vendor_portal/~.?", "app/models/vendors/~.?", "~/min_~.?", "lib/bundle_~.?", "src/generator/~.?", "tests/~/~_test.?", "src/external_~/~.?")
COMMON_DIRS = ("", "src/", "lib/", "pkg/", "app/", "tests/", "internal/core/", "packages/web/")


def _named(form: str, rng: random.Random) -> str:
    return re.sub("~", lambda _: "".join(rng.choices("abcdefghiklmnoprstuvy", k=rng.randint(4, 9))), form)


def line_examples(forms: tuple[str, ...], copies: int = 3) -> list[str]:
    """Copies of each form with invented names."""
    rng = random.Random(42)
    return [_named(f, rng) for f in forms for _ in range(copies)]


def path_examples(forms: tuple[str, ...]) -> list[str]:
    """Each form with invented names below each common folder and, in turn, with the ending of each language."""
    rng, endings = random.Random(42), ("py", "js", "java", "go", "php", "rb")
    return [d + _named(f, rng).replace(".?", "." + endings[(a + b) % len(endings)]) for a, f in enumerate(forms) for b, d in enumerate(COMMON_DIRS)]


_LICENCE = (b"copyright", b"spdx-license", b"license", b"licence")
_DIGITS = bytes.maketrans(b"123456789", b"000000000")
_CLASSES = bytes(48 if 48 <= c < 58 else 97 if 97 <= c < 123 else 65 if 65 <= c < 91 else 128 if c >= 128 else 32 if c == 9 else c for c in range(256))
#: n-grams of so many bytes end a line or a text; scale of the mean of a text's n-gram weights and of a path's.
GRAM, TEXT_SCALE, PATH_SCALE = 6, 10.0, 1.0
#: Added to a number of n-grams, so that few of them weigh less.
SMOOTH = 4
_M1, _M2 = np.uint32(0x01000193), np.uint32(0x85EBCA6B)


def _hashed(x: np.ndarray, n: int, salt: int) -> np.ndarray:
    """The place of each run of n bytes."""
    h = x[: len(x) - n + 1].astype(np.uint32)
    with np.errstate(over="ignore"):
        for j in range(1, n):
            h = h * _M1 ^ x[j : len(x) - n + 1 + j]
        h ^= h >> np.uint32(15)
        h *= _M2
        h ^= np.uint32(salt)
        return (h >> np.uint32(32 - 18)).astype(np.int32)


def plain_grams(data: bytes) -> np.ndarray:
    """Places of the n-grams with digits folded."""
    return _hashed(np.frombuffer(data.translate(_DIGITS), np.uint8)[:-1], GRAM - 1, 0) if len(data) >= GRAM else np.zeros(0, np.int32)


def grams(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(places of n-grams with digits folded, places of n-grams folded to character classes), one of each per position."""
    folded = _hashed(np.frombuffer(data.translate(_CLASSES), np.uint8), GRAM, 0x5BD1E995) if len(data) >= GRAM else np.zeros(0, np.int32)
    return plain_grams(data), folded


def _path_places(path: str | None) -> np.ndarray:
    """Hashes of a path's components, of their parts, and of the file name's endings, beginning and form."""
    *dirs, name = (path or "").lower().replace("\\", "/").split("/")
    pieces = [x for x in re.split(r"([._-])", name) if x]
    words = [f"dir:{d}" for d in dirs] + [f"dirs:{a}/{b}" for a, b in zip(dirs, dirs[1:])] + [f"first:{d}" for d in dirs[:1]]
    words += [f"word:{w}" for d in dirs for w in re.split(r"[^a-z]+", d) if w]
    words += [f"ending:{''.join(pieces[-2:])}", f"before:{''.join(pieces[-4:-2])}", f"stem:{name.rsplit('.', 1)[0][-5:]}", f"form:{re.sub('[a-z]{3,}', 'a', re.sub('[0-9]', '0', name))[:8]}", f"begins:{name[:3]}"]
    return np.array([zlib.crc32(w.encode("utf-8", "replace")) % (PATH_DIMENSIONS - 1) + 1 for w in words], dtype=np.int32)


@dataclass(frozen=True)
class Vector:
    """Groups of places; each group's weights count with scale / (size of the group + SMOOTH), and the bias at place 0 with 1."""

    groups: tuple[np.ndarray, ...]
    scale: float

    def score(self, w: np.ndarray) -> float:
        return float(w[0] + sum(self.scale * w[g].sum() / (len(g) + SMOOTH) for g in self.groups))

    def add(self, w: np.ndarray, step: float) -> None:
        w[0] += step
        for g in self.groups:
            np.add.at(w, g, step * self.scale / (len(g) + SMOOTH))


def path_vector(path: str | None) -> Vector:
    p = _path_places(path)
    return Vector((p,), PATH_SCALE * np.sqrt(len(p)))


def line_vector(line: str) -> Vector:
    return Vector((plain_grams(line.encode("utf-8", "replace")),), TEXT_SCALE)


def text_vector(text: str) -> Vector:
    return Vector(grams(text.encode("utf-8", "replace")), TEXT_SCALE)


def train(vectors: list[Vector], labels: np.ndarray, passes: int = PASSES, dimensions: int = DIMENSIONS, penalty: float = 1e-6, seed: int = 42) -> np.ndarray:
    """Linear SVM by sub-gradient steps on the hinge loss, both classes with equal weight; the second half is averaged.

    Vectors that were well over the hinge when last looked at are passed over, but for every fourth pass.
    """
    share = min(max((labels > 0).mean(), 0.05), 0.95) if len(labels) else 0.5
    weight = {1.0: min(0.5 / share, 3.0), -1.0: min(0.5 / (1 - share), 3.0)}
    w, mean, steps = np.zeros(dimensions), np.zeros(dimensions), 0
    rng, last = np.random.default_rng(seed), np.zeros(len(vectors))
    for epoch in range(passes):
        rate = 0.3 / (1 + epoch / 4)
        order = rng.permutation(len(vectors))
        for i in order if epoch % 4 == 0 else order[last[order] < 1.25]:
            last[i] = labels[i] * vectors[i].score(w)
            if last[i] < 1:
                vectors[i].add(w, rate * weight[labels[i]] * labels[i])
        w *= 1 - penalty * len(vectors)
        if epoch >= passes // 2:
            mean += w
            steps += 1
    return (mean / max(steps, 1)).astype(np.float32)


def choose_margin(scores: np.ndarray, labels: np.ndarray, widest: float = 0.5) -> float:
    """The margin from -widest to widest with the fewest errors on held-out rows; of several the middle of the widest gap."""
    inner = np.sort(scores[np.abs(scores) < widest])
    edge = np.concatenate(([-widest], inner, [widest]))
    middle = (edge[1:] + edge[:-1]) / 2
    errors = np.array([((scores > m) != (labels > 0)).sum() for m in middle])
    return float(middle[np.where(errors == errors.min(), edge[1:] - edge[:-1], -1.0).argmax()])


@dataclass(frozen=True)
class Model:
    """Weights by line and by text side by side, the path's, and the margins of line, text and path."""

    weights: np.ndarray
    path: np.ndarray
    margins: tuple[float, float, float]

    def scores(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(best line's score, masked text's score) of each text of a block; blank texts score -9."""
        raws = [(t or "").encode("utf-8", "replace") for t in texts]
        best, whole = np.full(len(texts), -9.0), np.full(len(texts), -9.0)
        data = b"\n".join(raws) + b"\n" * GRAM
        at = np.concatenate(([0], np.cumsum([len(r) + 1 for r in raws])))
        plain, folded = grams(data)
        g = self.weights[plain[: len(folded)]]
        g[:, 1] += self.weights[folded, 1]
        total = np.zeros((len(g) + 1, 2))
        np.cumsum(g, axis=0, out=total[1:], dtype=np.float64)
        a, b = _spans(data, int(at[-1]))
        line = self.weights[0, 0] + TEXT_SCALE * (total[b - GRAM + 1, 0] - total[a, 0]) / (b - a - GRAM + 1 + SMOOTH)
        row = np.searchsorted(at, a, "right") - 1
        np.maximum.at(best, row, line)
        gone, less = _masked(data, at, a[line > self.margins[0]], b[line > self.margins[0]], total[:, 1])
        n = np.diff(at) - GRAM - gone
        ok = n > 0
        whole[ok] = self.weights[0, 1] + TEXT_SCALE * ((total[np.maximum(at[1:] - GRAM, at[:-1]), 1] - total[at[:-1], 1] - less)[ok] / (n[ok] + SMOOTH))
        return best, whole

    def lines_over(self, texts: list[str], least: float) -> list[str]:
        """The lines and windows of some texts that score over a limit."""
        data = b"\n".join(t.encode("utf-8", "replace") for t in texts) + b"\n" * GRAM
        total = np.concatenate(([0.0], np.cumsum(self.weights[plain_grams(data), 0], dtype=np.float64)))
        a, b = _spans(data, len(data) - GRAM)
        over = self.weights[0, 0] + TEXT_SCALE * (total[b - GRAM + 1] - total[a]) / (b - a - GRAM + 1 + SMOOTH) > least
        return list(dict.fromkeys(data[x:y].decode("utf-8", "replace") for x, y in zip(a[over].tolist(), b[over].tolist())))

    def path_score(self, path: str | None) -> float:
        """The path's score; -9 for a null or empty one."""
        return path_vector(path).score(self.path) if path else -9.0


#: Bytes of a line that are one span; a longer one is also looked at in windows at half that distance.
SPAN, SHORTEST = 400, 8


def _spans(data: bytes, end: int) -> tuple[np.ndarray, np.ndarray]:
    """[start, stop) of the lines, and of the windows and block comments of long ones."""
    feeds = np.flatnonzero(np.frombuffer(data, np.uint8)[:end] == 10)
    a, b = np.concatenate(([0], feeds + 1)), np.concatenate((feeds, [end]))
    keep = b - a >= SHORTEST
    a, b = a[keep], b[keep]
    more_a, more_b = [a], [b]
    for x, y in zip(a[b - a > SPAN].tolist(), b[b - a > SPAN].tolist()):
        w = np.arange(x, y - SPAN // 2, SPAN // 4)
        comments = list(_comments(data, x, y))
        more_a += [w, np.array([c[0] for c in comments], np.int64)]
        more_b += [np.minimum(w + SPAN // 2, y), np.array([c[1] for c in comments], np.int64)]
    return np.concatenate(more_a), np.concatenate(more_b)


def _comments(data: bytes, x: int, y: int) -> Iterator[tuple[int, int]]:
    """[start, stop) of the block comments within [x, y)."""
    for opening, closing in ((b"/*", b"*/"), (b"<!--", b"-->")):
        k = data.find(opening, x, y)
        while k >= 0 and (end := data.find(closing, k + len(opening), y)) >= 0:
            if end + len(closing) - k >= SHORTEST:
                yield k, end + len(closing)
            k = data.find(opening, end, y)


def _masked(data: bytes, at: np.ndarray, a: np.ndarray, b: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams, sum of their weights) of each text that lie in notices, given as spans, or in lines that name a licence."""
    spans = list(zip(a.tolist(), b.tolist()))
    low = data.lower()
    for word in _LICENCE:
        k = low.find(word)
        while k >= 0:
            stop = data.find(b"\n", k)
            spans.append((data.rfind(b"\n", 0, k) + 1, stop))
            k = low.find(word, stop)
    gone, less = np.zeros(len(at) - 1, np.int64), np.zeros(len(at) - 1)
    done = 0
    for x, y in sorted(spans):
        row = int(np.searchsorted(at, x, "right")) - 1
        x, y = max(x, done), min(y, int(at[row + 1]) - GRAM)
        if y > x:
            gone[row] += y - x
            less[row] += total[y] - total[x]
            done = y
    return gone, less


def masked(text: str) -> str:
    """The text without its notices by rule and without lines that name a licence: what the text classifier learns from."""
    if _may_have_notice(text):
        text = BANNER.sub("", text)
        gone = dict.fromkeys(line for _, line in notice_lines(text))
        if gone:
            text = "\n".join(x for x in text.split("\n") if x[:PART] not in gone)
            for part in gone:  # of longer lines, which stay
                text = text.replace(part, "")
    low = text.lower()
    return _LICENCE_LINE.sub("", text) if "copyright" in low or "license" in low or "licence" in low else text


_LICENCE_LINE = re.compile(r"(?im)^.*(?:copyright|spdx-license|licen[cs]e).*$")
_COMMENT_START = re.compile(r"\s*(?://|#|/?\*|--|\"\"\"|<!--)")


def evidence_of(text: str | None, path: str | None) -> tuple[str, ...]:
    """The giveaways of a row, by path and by text: the labels of the sample."""
    if is_config(path):
        return ()
    a, b = path_evidence(path), text_evidence(text)
    return tuple(f"{w}:{x}" for w, x in (("path", a), ("text", b)) if x)


def _lines(rows: list[tuple[str | None, str | None]], seed: int = 42) -> tuple[list[str], list[str]]:
    """(notices, other lines) of some rows: all comments and one in fifty of the other lines, SAMPLE_LINES at most."""
    notices: dict[str, None] = {}
    others: dict[str, None] = {}
    rng = random.Random(seed)
    for text, _ in rows:
        told = {line for _, line in notice_lines(text)} if text and _may_have_notice(text) else set()
        if text and (m := BANNER.search(text)):
            told |= set(m.group().split("\n"))
        notices |= dict.fromkeys(x for x in told if len(x) >= SHORTEST)
        for line in (text or "").split("\n"):
            part = line[:PART]
            if len(line) >= SHORTEST and part not in told and line not in told and (_COMMENT_START.match(line) or rng.random() < 0.02):
                others[part] = None
    few = list(others)
    rng.shuffle(few)
    return list(notices), few[:SAMPLE_LINES]


def _figures(name: str, scores: np.ndarray, y: np.ndarray, margin: float) -> dict[str, float]:
    hit = scores > margin
    return {f"{name}_margin": margin, f"{name}_held_out": float(len(y)), f"{name}_recall": float(hit[y > 0].mean()) if (y > 0).any() else 1.0, f"{name}_precision": float((y[hit] > 0).mean()) if hit.any() else 1.0}


def fit(chunks: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_text: int = SAMPLE_TEXT) -> tuple[Model, dict[str, float]]:
    """The classifiers and their figures on held-out repositories.

    The sample is bounded: the sample_rows rows with the least hash of those whose text has at most sample_text
    characters, so it is the same at every run; beyond that only the table's rows are counted.
    """
    total = chunks.count()
    salt = F.pmod(F.xxhash64(F.lit(17), "repo_name", "path", "text"), F.lit(1_000_000_000))
    fold = F.pmod(F.xxhash64(F.coalesce(canonical_or_self(F.col("repo_name")), F.lit(""))), F.lit(5)).cast("int")
    picked = chunks.where("path is not null and text is not null").where(F.length("text") <= sample_text)
    picked = picked.where(salt < int(min(1.0, 1.3 * sample_rows / max(total, 1)) * 1_000_000_000) + 1)
    got = picked.select("path", "text", fold.alias("fold"), salt.alias("salt")).distinct().orderBy("salt", "path", "text").limit(sample_rows).collect()  # sample_rows x sample_text at most
    rows = [(r.text, r.path, r.fold) for r in got if not is_config(r.path)]
    learn, held = [r[:2] for r in rows if r[2] != 0], [r[:2] for r in rows if r[2] == 0]
    given = {(t, p): evidence_of(t, p) for t, p, _ in rows}

    def lines(part, examples: bool) -> tuple[list[str], np.ndarray]:
        good, bad = _lines(part)
        good, bad = (good + line_examples(NOTICE_EXAMPLES), bad + line_examples(OTHER_EXAMPLES)) if examples else (good, bad)
        return [*good, *bad], np.array([1.0] * len(good) + [-1.0] * len(bad))

    def paths(part, examples: bool) -> tuple[list[Vector], np.ndarray]:
        some = sorted({p for _, p in part})
        told = [(p, 1.0 if path_evidence(p) else -1.0) for p in some]
        told += [(p, 1.0) for p in path_examples(3 * PATH_EXAMPLES)] + [(p, -1.0) for p in path_examples(10 * HAND_PATHS)] if examples else []
        return [path_vector(p) for p, _ in told], np.array([y for _, y in told])

    def texts(part) -> tuple[list[Vector], np.ndarray]:
        # rows that only their path or a notice gives away say nothing about the masked text
        told = [(t, 1.0 if shape_evidence(t) else -1.0) for t, p in part if not given[t, p] or shape_evidence(t)]
        return [text_vector(masked(t)) for t, _ in told], np.array([y for _, y in told])

    def line_weights() -> np.ndarray:
        """Learnt twice: the other lines of the first fit that come near to a notice are shown to the second."""
        some, y = lines(learn, True)
        vectors = [line_vector(x) for x in some]
        w = train(vectors, y)
        first = Model(np.stack([w, w], axis=1), w, (0.0, 0.0, 0.0))
        near = [x for x in first.lines_over([t for t, p in learn if not given[t, p]], -0.6) if x not in set(some)]
        return train([*vectors, *map(line_vector, near)], np.append(y, [-1.0] * len(near))) if near else w

    figures = {"rows": float(len(rows)), "held_out": float(len(held))}
    weights, margins = [], []
    held_lines = lines(held, False)
    fits = (
        ("line", line_weights(), ([line_vector(x) for x in held_lines[0]], held_lines[1])),
        ("text", train(*texts(learn)), texts(held)),
        ("path", train(*paths(learn, True), 3 * PASSES, PATH_DIMENSIONS), paths(held, False)),
    )
    for name, w, known in fits:
        scores = np.array([v.score(w) for v in known[0]])
        margin = choose_margin(scores, known[1])
        figures |= _figures(name, scores, known[1], margin)
        weights.append(w)
        margins.append(margin)
    model = Model(np.stack(weights[:2], axis=1), weights[2], tuple(margins))
    if held:
        # what the masked text alone finds of the rows that something gives away
        some = [bool(given[x]) for x in held]
        alone = model.scores([t for t, _ in held])[1] > margins[1]
        figures["masked_recall"] = float(alone[some].mean()) if any(some) else 1.0
    return model, figures


FOUND = "repo_name string, path string, evidence string, score double"


def score_rows(chunks: DataFrame, model: Model, size: int = 1_000_000) -> DataFrame:
    """(repo_name, path, evidence, score) of each row: the classifiers that found it, and by how much the best one's
    score is over its margin; configuration files score nothing.  Blocks have about `size` characters."""
    spark = chunks.sparkSession
    shared = spark.sparkContext.broadcast((zlib.compress(model.weights.tobytes(), 1), zlib.compress(model.path.tobytes(), 1), model.margins))

    def blocks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
        first, n = 0, 0
        for k, t in enumerate(texts):
            n += len(t or "") + 1
            if n >= size:
                yield first, k + 1
                first, n = k + 1, 0
        if first < len(texts):
            yield first, len(texts)

    def run(batches):
        w, p, margins = shared.value
        m = Model(np.frombuffer(zlib.decompress(w), np.float32).reshape(-1, 2), np.frombuffer(zlib.decompress(p), np.float32), margins)
        for batch in batches:
            repos, paths, texts = (batch.column(i).to_pylist() for i in range(3))
            by_path = {p: m.path_score(p) for p in set(paths)}
            for a, b in blocks(texts):
                line, text = m.scores(texts[a:b])
                over = np.stack([line - margins[0], text - margins[1], np.array([by_path[p] for p in paths[a:b]]) - margins[2]], axis=1)
                told = [",".join(n for n, x in zip(("notice", "text", "path"), o) if x > 0) or None for o in over]
                score = [None if is_config(p) else x for p, x in zip(paths[a:b], over.max(axis=1).tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(repos[a:b], pa.string()), pa.array(paths[a:b], pa.string()), pa.array(told, pa.string()), pa.array(score, pa.float64())], ["repo_name", "path", "evidence", "score"])

    return spread(chunks.select("repo_name", "path", "text").where("path is not null")).mapInArrow(run, FOUND)


def files(chunks: DataFrame, model: Model | None = None) -> DataFrame:
    """(repo_name, path, evidence, score) of the files that are not hand-written, one row per file.

    evidence names the classifiers that found the file's best row (notice, text, path).  Rows without path belong to
    no file; null and empty texts leave the path to decide; repeated rows change nothing.
    """
    model = model or fit(chunks)[0]
    per = score_rows(chunks, model).groupBy("repo_name", "path").agg(F.max_by("evidence", "score").alias("evidence"), F.max("score").alias("score"))
    return per.where("score > 0").select("repo_name", "path", "evidence", F.round("score", 4).alias("score"))
