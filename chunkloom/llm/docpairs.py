"""Problem 7: functions and methods paired with their documentation.

A scanner per language finds the named functions of a chunk, the documentation that belongs to each (the
docstring, or the comment directly above it) and the class around it with the classes it extends.  Trivial
documentation is dropped.  Documentation that is missing or only says that it is inherited is resolved by
joining the methods, repository by repository, with the methods of the same name one class further up, again
and again until nothing is open that can still be resolved; what stays unresolved is dropped.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkloom.llm.common import WORD_RE, blank, checkpointed, spread
from chunkloom.llm.grouped_split import canonical_or_self

#: File endings of the languages.
ENDINGS = {"py": "python", "java": "java", "js": "javascript", "jsx": "javascript", "mjs": "javascript", "ts": "javascript", "php": "php", "go": "go", "rb": "ruby"}
LANGUAGES = ("python", "java", "javascript", "php", "go", "ruby")

_NOT_NAMES = frozenset("if for while switch catch function return else do new throw try with synchronized super elseif foreach match await typeof case".split())

FUNCTIONS = {
    "python": re.compile(r"^[ \t]*(?:async[ \t]+)?def[ \t]+(\w+)[ \t]*(?:\[[^\]\n]*\])?\(", re.M),
    "java": re.compile(
        r"^[ \t]*(?:@\w+(?:\([^)\n]*\))?[ \t]+)*(?:(?:public|private|protected|static|final|abstract|synchronized|native|default|strictfp)[ \t]+)*"
        r"(?:<[^>\n]+>[ \t]+)?(?:[\w.]+(?:<[^;={}()\n]*>)?(?:\[\])*[ \t]+)?(\w+)[ \t]*\([^;{}=]*\)\s*(?:throws[\w\s.,]+)?[{;]",
        re.M,
    ),
    "javascript": re.compile(
        r"^[ \t]*(?:export[ \t]+)?(?:default[ \t]+)?(?:async[ \t]+)?function[ \t]*\*?[ \t]*([\w$]+)[ \t]*\("
        r"|^[ \t]*(?:export[ \t]+)?(?:const|let|var)[ \t]+([\w$]+)[ \t]*=[ \t]*(?:async[ \t]*)?(?:function\b|\([^)]*\)[ \t]*=>|[\w$]+[ \t]*=>)"
        r"|^[ \t]*(?:static[ \t]+)?(?:async[ \t]+)?(?:[gs]et[ \t]+)?\*?#?([\w$]+)[ \t]*\([^;{}()]*\)[ \t]*\{"
        r"|^[ \t]*(?:[\w$]+\.)*([\w$]+)[ \t]*[:=][ \t]*(?:async[ \t]+)?function\b",
        re.M,
    ),
    "php": re.compile(r"^[ \t]*(?:(?:public|private|protected|static|final|abstract)[ \t]+)*function[ \t]+&?[ \t]*(\w+)[ \t]*\(", re.M),
    "go": re.compile(r"^[ \t]*func[ \t]+(?:\([^)\n]*\)[ \t]*)?(\w+)[ \t]*(?:\[[^\]\n]*\])?\(", re.M),
    "ruby": re.compile(r"^[ \t]*(?:(?:private|protected|public|module_function|memoize)[ \t]+)?def[ \t]+(?:\w+\.)?(\w+[?!=]?)", re.M),
}
CLASSES = {
    "python": re.compile(r"^([ \t]*)class[ \t]+(\w+)[ \t]*(?:\([ \t]*([\w.]*))?", re.M),
    "java": re.compile(r"^([ \t]*)(?:(?:public|private|protected|static|final|abstract)[ \t]+)*(?:class|interface|enum|record)[ \t]+(\w+)(?:<[^{\n]*?>)?(?:[ \t]+(?:extends|implements)[ \t]+([\w.]+))?", re.M),
    "javascript": re.compile(r"^([ \t]*)(?:export[ \t]+)?(?:default[ \t]+)?class[ \t]+([\w$]+)(?:[ \t]+extends[ \t]+([\w.$]+))?", re.M),
    "php": re.compile(r"^([ \t]*)(?:(?:abstract|final)[ \t]+)*(?:class|interface|trait)[ \t]+(\w+)(?:[ \t]+(?:extends|implements)[ \t]+([\w\\]+))?", re.M),
    "ruby": re.compile(r"^([ \t]*)(?:class|module)[ \t]+([\w:]+)(?:[ \t]*<[ \t]*([\w:]+))?", re.M),
}
_DOCSTRING = re.compile(r"\s*(?:#[^\n]*\n\s*)*[rRuUbBfF]{0,2}(\"\"\"|'''|\"|')")
_BRACKETS_OR_COMMA = re.compile(r"[()\[\]{},]|\"(?:[^\"\\\n]|\\.)*\"|'(?:[^'\\\n]|\\.)*'|#[^\n]*")
_BRACKETS = re.compile(r"[()\[\]{}]|\"(?:[^\"\\\n]|\\.)*\"|'(?:[^'\\\n]|\\.)*'|#[^\n]*")

#: Documentation that says nothing: fixed values, as sequences of words.
PLACEHOLDERS = frozenset(
    "auto generated method stub|auto generated constructor stub|inheritdoc|inherited|see above|no description available|add description here|missing docstring|internal|helper|docs|noqa|todo|tbd|xxx|write me later|add docs here|documentation goes here|description goes here|no documentation available yet|this method has no documentation".split("|")
)
_OPEN_WORK = re.compile(r"^(?:todo|fixme|tbd|xxx|hack|noqa|nolint|eslint)\b")
_INHERITED = re.compile(r"^(?:inherited|inheritdoc|see (?:super|base|parent)(?: ?class)?|\(?non javadoc\)?)$")
_TAG_LINE = re.compile(r"^\s*(?:@\w+|:(?:param|return|returns|raises?|type|rtype|throws|yields?|arg|var|see)\b).*$", re.M)
_INLINE_TAG = re.compile(r"\{@\w+[^}\n]*\}")
_MARKS = re.compile(r"^[ \t]*(?:/\*+!?|\*+/|\*|///?!?|#+!?)|\*+/[ \t]*$|^=begin|^=end", re.M)
_CAMEL = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+|[^\W\d_A-Za-z]+")


def clean(doc: str) -> str:
    """Documentation without comment marks, one line for each of its own."""
    once = _MARKS.sub("", doc)
    return "\n".join(line.strip() for line in once.splitlines()).strip()


def told_words(doc: str) -> list[str]:
    """The words of a documentation apart from its marks and tags."""
    return WORD_RE.findall(_TAG_LINE.sub("", _INLINE_TAG.sub("", clean(doc))).lower())


def is_trivial(doc: str | None, name: str | None) -> bool:
    """Fewer than four words, a placeholder, or only the words of the function's name and "the"."""
    if not doc:
        return True
    ws = told_words(doc)
    if len(ws) < 4:
        return True
    told = " ".join(ws)
    if told in PLACEHOLDERS or _OPEN_WORK.match(told):
        return True
    own = {w.lower() for w in _CAMEL.findall(name or "")} | {w for w in WORD_RE.findall((name or "").lower())} | {"the"}
    return all(w in own for w in ws)


def is_inherited(doc: str | None) -> bool:
    """Whether a documentation only points to the overridden method's."""
    if not doc:
        return False
    text = clean(doc)
    bare = " ".join(WORD_RE.findall(_TAG_LINE.sub("", text).lower()))
    return "{@inheritdoc" in text.lower() or "@inheritdoc" in text.lower() or bool(_INHERITED.match(bare))


def _docstring(text: str, opening: int) -> str | None:
    """The docstring of a def whose parameter list opens at a position; unterminated ones reach to the end."""
    depth, end = 0, None
    for m in _BRACKETS.finditer(text, opening):
        c = m.group()
        if c in "([{":
            depth += 1
        elif c in ")]}":
            depth -= 1
            if depth == 0:
                end = m.end()
                break
    if end is None:
        return None
    head = re.compile(r"[ \t]*(?:->[^:\n]*(?:\[[^\]]*\])?[^:\n]*)?:").match(text, end)
    if not head:
        return None
    quote = _DOCSTRING.match(text, head.end())
    if not quote:
        return None
    q = quote.group(1)
    if len(q) == 3:
        stop = text.find(q, quote.end())
        return text[quote.end() : stop if stop >= 0 else len(text)]
    m = re.compile(rf"(?:[^{q}\\\n]|\\.)*").match(text, quote.end())
    return m.group() if m and text[m.end() : m.end() + 1] == q else None


def _comment_above(lines: list[str], row: int, language: str) -> str | None:
    """The comment that ends on the line above lines[row], annotations skipped."""
    hash_comments = language in ("ruby", "php")
    i = row - 1
    while i >= 0:
        s = lines[i].strip()
        if language in ("java", "javascript", "php") and (re.match(r"@\w[\w.]*(?:\(.*\))?$", s) or s.startswith("#[") and s.endswith("]")):
            i -= 1
            continue
        if language == "java" and s.endswith(")") and not s.startswith(("*", "/")):  # an annotation over several lines
            j = i
            while j >= 0 and not lines[j].strip().startswith("@") and not lines[j].strip().endswith((";", "{", "}", "*/")):
                j -= 1
            if j >= 0 and lines[j].strip().startswith("@"):
                i = j - 1
                continue
        break
    if i < 0:
        return None
    s = lines[i].strip()
    if language != "ruby" and s.endswith("*/"):
        j = i
        while j >= 0 and "/*" not in lines[j]:
            j -= 1
        return "\n".join(lines[j : i + 1]) if j >= 0 and lines[j].lstrip().startswith("/*") else None
    if language == "ruby" and s == "=end":
        j = i
        while j >= 0 and lines[j].strip() != "=begin":
            j -= 1
        return "\n".join(lines[j + 1 : i]) if j >= 0 else None
    marks = (("#",) if language == "ruby" else ("//", "#") if hash_comments else ("//",))
    j = i
    while j >= 0 and lines[j].lstrip().startswith(marks) and not lines[j].lstrip().startswith("#["):
        j -= 1
    return "\n".join(lines[j + 1 : i + 1]) if j < i else None


_NOTES = re.compile(r"/\*.*?\*/|//[^\n]*|@\w[\w.]*", re.S)
_GENERIC = re.compile(r"<[^<>]*>")
_ABOVE = re.compile(r"\b(?:extends|implements)\b(.*?)(?=\b(?:extends|implements|permits)\b|$)", re.S)
#: Characters of a class's head that are looked at.
HEAD = 4000


def _own_name(name: str) -> str:
    return name.split(".")[-1].split("\\")[-1].split("::")[-1]


def _arguments(text: str, at: int) -> list[str]:
    """The arguments between the bracket at a position and the one that closes it; [] where none does."""
    out, depth, begin, end = [], 0, at + 1, min(len(text), at + HEAD)
    for m in _BRACKETS_OR_COMMA.finditer(text, at, end):
        c = m.group()
        depth += (c in "([{") - (c in ")]}")
        if depth == 0 or depth == 1 and c == ",":
            out.append(text[begin : m.start()])
            begin = m.end()
            if depth == 0:
                return out
    return []


def _bases(text: str, m: re.Match, language: str) -> list[str]:
    """The classes and interfaces that a class's head names, in order."""
    if language == "ruby":
        return [_own_name(m.group(3))] if m.group(3) else []
    if language == "python":
        opening = re.compile(r"[ \t]*(?:\[[^\n]*?\][ \t]*)?\(").match(text, m.end(2))
        parts = [re.sub(r"#[^\n]*", "", x).strip() for x in _arguments(text, opening.end() - 1)] if opening else []
        found = [b.group() for x in parts if not re.match(r"\w+\s*=(?!=)", x) and (b := re.match(r"[^\W\d][\w.]*", x))]
    else:
        head = _NOTES.sub(" ", re.match(r"[^{;]*", text[m.end(2) : m.end(2) + HEAD]).group())
        while (less := _GENERIC.sub(" ", head)) != head:
            head = less
        found = [b for part in _ABOVE.findall(head) for b in re.findall(r"[\w$.\\]+", part)]
    return list(dict.fromkeys(b for x in found if (b := _own_name(x))))


def classes_of(text: str, language: str) -> list[tuple[int, int, str, list[str]]]:
    """(position, indentation, name, the classes it extends) of each class of a text, those without functions too."""
    if language not in CLASSES:
        return []
    return [(m.start(), len(m.group(1).expandtabs(4)), _own_name(m.group(2)), _bases(text, m, language)) for m in CLASSES[language].finditer(text)]


def functions_of(text: str, language: str) -> list[tuple[str, str | None, str | None, str | None, int]]:
    """(name, documentation, class, class it extends, line from 1) of each named function of a text."""
    found = FUNCTIONS.get(language)
    if found is None:
        return []
    text = text.replace("\r\n", "\n").replace("\r", "\n")
    classes = classes_of(text, language)
    lines, out = text.split("\n"), []
    row, at = 0, 0
    for m in found.finditer(text):
        name = next((g for g in m.groups() if g), None)
        if not name or name in _NOT_NAMES:
            continue
        head = m.group().lstrip()
        if language == "java" and re.match(r"(?:return|throw|new|else|case|await)\b", head):
            continue
        if language == "java" and head.rstrip().endswith(";") and not re.match(r"(?:@|public|private|protected|static|abstract|default|native|[\w.<>\[\]]+[ \t]+\w+[ \t]*\()", head):
            continue  # a call, not a declaration
        start = m.start() + len(m.group()) - len(m.group().lstrip())
        row += text.count("\n", at, start)
        at = start
        doc = _docstring(text, m.end() - 1) if language == "python" else _comment_above(lines, row, language)
        indent = len(lines[row][: len(lines[row]) - len(lines[row].lstrip())].expandtabs(4))
        own = [c for c in classes if c[0] < m.start() and (c[1] < indent or language in ("php", "javascript", "java") and c[1] <= indent)]
        out.append((name, doc, own[-1][2] if own else None, own[-1][3][0] if own and own[-1][3] else None, row + 1))
    return out


def language_of(language: str | None, path: str | None) -> str:
    """The language by its column where that is one of the six, else by the path's ending."""
    low = (language or "").strip().lower()
    return low if low in LANGUAGES else ENDINGS.get((path or "").rsplit(".", 1)[-1].lower(), low)


PAIRS = "chunk_id string, repo_name string, fn_name string, class_name string, base_name string, line_no int, doc string, doc_kind string, lang string"
_COLUMNS = ("chunk_id", "repo_name", "path", "language", "symbol_kind", "symbol_name", "query_text", "query_source", "text")


def all_functions(chunks: DataFrame) -> DataFrame:
    """One row per function and source of documentation; doc_kind is code, query, inherited, trivial or none.

    With doc_kind base, one row per class and class that it extends: line_no is the latter's place in the head.
    """

    def run(batches):
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                lang = language_of(r["language"], r["path"])
                for name, doc, cls, base, line in functions_of(r["text"], lang):
                    kind = "none" if doc is None or not clean(doc) else "code" if not is_trivial(doc, name) else "inherited" if is_inherited(doc) else "trivial"
                    rows.append((r["chunk_id"], r["repo_name"], name, cls, base, line, clean(doc) if doc else None, kind, lang))
                text = r["text"].replace("\r\n", "\n").replace("\r", "\n")
                rows += [(r["chunk_id"], r["repo_name"], None, cls, base, i, None, "base", lang) for _, _, cls, bases in classes_of(text, lang) for i, base in enumerate(bases)]
                if r["symbol_kind"] in ("function", "method") and r["query_source"] in ("docstring", "codesearchnet") and r["symbol_name"] and not is_trivial(r["query_text"], r["symbol_name"]):
                    rows.append((r["chunk_id"], r["repo_name"], r["symbol_name"], None, None, None, r["query_text"], "query", lang))
            cols = list(zip(*rows)) if rows else [[]] * 9
            types = [pa.string()] * 5 + [pa.int32()] + [pa.string()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], [x.split()[0] for x in PAIRS.split(", ")])

    used = chunks.select(*_COLUMNS).where(~blank(F.col("text")) & (F.coalesce("symbol_kind", F.lit("")) != "window"))
    return spread(used).mapInArrow(run, PAIRS)


def resolve_inherited(functions: DataFrame) -> DataFrame:
    """(chunk_id, fn_name, line_no, doc, doc_kind): inherited and missing documentation by the nearest class above that has some.

    Each round looks one class further up for what is still open: (repository, class, method) of the classes
    above is joined with the documented methods and with these classes' own bases, repositories by their
    canonical name.  Of several classes as near, the one that is named first in the heads counts.  It ends when
    nothing is open; a class is visited once for a method, so a cycle ends too and is dropped.
    """
    every = functions.where("class_name is not null and repo_name is not null").withColumn("repo", canonical_or_self(F.col("repo_name")))
    extends, in_class = every.where("doc_kind = 'base'"), every.where("doc_kind <> 'base'")
    documented = in_class.where("doc_kind = 'code'").groupBy("repo", "lang", F.col("class_name").alias("base_name"), "fn_name").agg(F.min("doc").alias("base_doc"))
    bases = extends.groupBy("repo", "lang", F.col("class_name").alias("base_name"), F.col("base_name").alias("next_base")).agg(F.min("line_no").alias("place"))
    key = ["repo", "lang", "chunk_id", "class_name", "fn_name", "line_no"]
    first = extends.select("chunk_id", "class_name", "base_name", F.array("line_no").alias("way"))
    opened = in_class.where("doc_kind in ('inherited', 'none')").select(*key).join(first, ["chunk_id", "class_name"])
    open_ = checkpointed(opened.groupBy(*key, "base_name").agg(F.min("way").alias("way")))
    seen, done = open_.drop("way"), None
    while not open_.isEmpty():
        step = checkpointed(open_.join(documented, ["repo", "lang", "base_name", "fn_name"], "left"))
        got = step.where("base_doc is not null").groupBy(*key).agg(F.min_by("base_doc", F.struct("way", "base_doc")).alias("doc"))
        done = got if done is None else done.unionByName(got)
        further = step.join(got.select(*key), key, "left_anti").join(bases, ["repo", "lang", "base_name"])
        further = further.groupBy(*key, F.col("next_base").alias("base_name")).agg(F.min(F.concat("way", F.array("place"))).alias("way"))
        open_ = checkpointed(further.join(seen, [*key, "base_name"], "left_anti"))
        seen = checkpointed(seen.unionByName(open_.drop("way")))
    out = done if done is not None else functions.where("false")
    return out.select("chunk_id", "fn_name", "line_no", "doc").withColumn("doc_kind", F.lit("inherited"))


def documented_functions(chunks: DataFrame) -> DataFrame:
    """(chunk_id, fn_name, doc, doc_kind) pairs: own documentation, query texts and what is inherited.

    Null and blank texts and window chunks give nothing; a function documented twice keeps the documentation
    from the code, then the query text, then what is inherited; repeated rows of a chunk give one pair; rows without chunk_id are left out.
    """
    functions = checkpointed(all_functions(chunks).where("chunk_id is not null").distinct())
    pairs = functions.where("doc_kind in ('code', 'query')").select("chunk_id", "fn_name", "line_no", "doc", "doc_kind").unionByName(resolve_inherited(functions))
    rank = F.when(F.col("doc_kind") == "code", 0).when(F.col("doc_kind") == "query", 1).otherwise(2)
    best = F.min_by(F.struct("doc", "doc_kind"), F.struct(rank, "line_no", "doc"))
    return pairs.groupBy("chunk_id", "fn_name").agg(best.alias("b")).select("chunk_id", "fn_name", "b.doc", "b.doc_kind")


def found(chunks: DataFrame) -> DataFrame:
    """(chunk_id, fn_name) of the pairs whose documentation is the function's own, by code or query text; what a function
    only inherits is its class's and not counted here."""
    return documented_functions(chunks).where("doc_kind <> 'inherited'").select("chunk_id", "fn_name")
