"""Problem 10: pages of repeated keywords, tags, product tags or links instead of sentences.

A text is cut into lines and each line is measured: share of its top word, distinct share of its words and
of its word pairs, link-text ratio, separator density, function words.  Lines that repeat the same opening
words are measured together, so are lines that occur again and again (duplicate-line share) and lines made of
three-word phrases that the text repeats (n-gram share).  What counts is the share of a document's words (and link
characters) that stand in stuffed lines; code, logs, tables, dependency lists and contents lists are recognised by
their own marks and never count as stuffed.

Limits are calibrated per language over all documents, against the medians of its lines of running text: stuffed
lines must lack function words, listed ones must have more separators, repeated ones more words that occur
again.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkloom.llm.common import WORD_RE, checkpointed, spread

#: Common function words by language.
FUNCTION_WORDS = {
    "en": "the a an of to and in is are was for that it we this with on as be by at or not no its how do when what from has have can must will which does so than then so but my i you only keeps one because while before after",
    "fr": "le la les de des du un une et est en que qui pour dans par sur au aux ne pas se ce avec sans plus il elle puis sa son ses jusqu fin près dès depuis chaque",
    "de": "der die das und ist ein eine einen nicht zu den dem des mit auf für im in von wenn aus nach bevor sobald jeden wird seit falls warum es auch als",
    "es": "el la los las de del un una y es en que por para con no se su al si como más este pasa desde hasta cada cuando otro junto después está qué",
    "it": "il lo la gli le di del della e è un una in che per con non si come da al nel",
    "pt": "o a os as de do da e é um uma em que por para com não se como no na ao",
}
_SETS = {k: frozenset(v.split()) for k, v in FUNCTION_WORDS.items()}
_ALL = frozenset().union(*_SETS.values())
#: Chinese and Japanese texts have no blanks between words, so a run of characters counts as a function word if one of these is in it.
ZH_FUNCTION = re.compile("[的了在是和会把不为就都被这那与及或而但也将从当则所以于之并吗呢吧のはをがにでとも]")
_HAN = re.compile("[\u3040-\u9fff]")

LINK = re.compile(r"<a\s[^<>]*+>[^<\n]*+</a>|!?\[[^\[\]\n]*+\]\((?!#)[^()\n]*+\)|(?:https?|ftp)://[^\s)>\]]+|www\.[^\s)>\]]+", re.I)
ANCHOR = re.compile(r"\[[^\[\]\n]*+\]\(#[^()\n]*+\)")
#: Lines of logs, code, tables, lists of versions, stack traces, numbered contents.  Nothing in it is tried twice over a long run, so it is linear.
OTHER = re.compile(
    r"""^\s*+(?:\|.*\||\d{4}-\d\d-\d\d|\[?\d\d:\d\d|[\w.@/-]++\s*+(?:==|>=|~=|<=|\^)\s*v?\d|(?:at|from|File)\s++[\w"./$<].*[(:]"""
    r"""|["'\w.@/-]++"?\s*+[:=]\s*+["']?[\^~]?v?\d++\.\d|.*[{};]\s*+$|(?>.*?\w\().*\)\s*+(?:[;:{]\s*+)?$|.*(?<=\s)(?:=|\+=|:=|=>|->)\s|(?:\d++\.)++\d*+\s++\S|```|---|===|(?:INFO|WARN|ERROR|DEBUG|TRACE)\b"""
    r"""|(?:def|func|function|class|return|import|package|public|private|if|for|while|end|else|try|raise|throw|const|let|var|use)\b.*[(){}:;='"$@])""",
    re.X,
)
SEPARATOR = re.compile(r"[ ]?[,;|/•·#\u3001\uff0c\uff1b\t][ ]?|[ ][-–—*][ ]")
HASHTAG = re.compile(r"(?<![\w&])#[^\W\d_]\w*")
SENTENCE = re.compile(r"[.!?](?:\s|$)|[。！？]")

#: A document is a case if this share of its words is stuffed and at least so many of them are.
SHARE, LEAST_WORDS = 0.5, 12
#: A line lacks function words under this part of its language's median share; listed and repeated lines have this many
#: times the share of separators and of words that occur again of its running text.
LACK, RISE = 0.8, 1.5
#: Median shares (function words, separators of characters, words that occur again) used for a language without running text in the corpus; the first
#: one also where its texts have no known function words.
DEFAULT_MEDIAN, DEFAULT_SEPARATORS, DEFAULT_AGAIN = 0.3, 0.012, 0.08
#: No language's limits are higher than these (shares of characters and of words).
MOST_SEPARATORS, MOST_AGAIN = 0.1, 0.5
#: A line that occurs so often is a duplicate, a phrase of three words that does so is repeated.
OFTEN = 4

#: Kinds of stuffed lines; all but the links are made of words.
KINDS = ["repeated", "listed", "linked", "opened", "duplicated", "phrased"]
COUNTS = ["words", *KINDS, "prose_words", "prose_function", "prose_separators", "prose_characters", "prose_again", "stuffed_function", "listed_separators", "listed_characters", "repeated_again"]


def function_words(ws: list[str]) -> int:
    """The number of function words, of any language, among some words."""
    return sum(w in _ALL or not w.isascii() and ZH_FUNCTION.search(w) is not None for w in ws)


def language_of(ws: list[str], text: str) -> str:
    """The language whose function words are most frequent; texts mostly in Han or kana are zh; else other."""
    if not ws:
        return "other"
    if not text.isascii() and len(_HAN.findall(text)) > 0.2 * len(text):
        return "zh"
    known = [w for w in ws if w in _ALL]
    counts = {k: sum(w in s for w in known) for k, s in _SETS.items()}
    best = max(sorted(counts), key=counts.get)
    return best if counts[best] else "other"


def line_kind(line: str, ws: list[str]) -> str:
    """other | linked | listed | repeated | prose, by the line alone."""
    n = len(ws)
    links = LINK.findall(line) if "://" in line or "](" in line or "<a" in line or "www." in line else ()
    tags = HASHTAG.findall(line) if "#" in line else ()
    if not links and not tags and OTHER.match(line) or "](#" in line and ANCHOR.search(line):
        if not (n >= 30 and SEPARATOR.search(line) and not re.search(r"[(){}=]", line)):
            return "other"
    if links:
        rest = WORD_RE.findall(LINK.sub(" ", line).lower())
        if len(rest) <= 2 * len(links) and len(rest) < 8:
            return "linked"
    if n < 4:
        return "prose"
    if len(tags) >= 4 and sum(len(t) for t in tags) > 0.6 * len(line.replace(" ", "")):
        return "listed"
    if n >= 12:
        distinct = len(set(ws)) / n
        if distinct < 0.76 and function_words(ws) < 0.25 * n:  # a top word of a quarter leaves no more distinct ones
            top = Counter(w for w in ws if w not in _ALL).most_common(1)
            if top and (top[0][1] / n > 0.25 or n >= 30 and distinct < 0.35 and len(set(zip(ws, ws[1:]))) / (n - 1) < 0.6):
                return "repeated"
        items = [x for x in SEPARATOR.split(line) if x.strip()] if n >= 18 or SEPARATOR.search(line) else ()
        if len(items) >= 6 and n / len(items) <= 5 and len(SENTENCE.findall(line)) <= 1 + len(re.findall(r"\b[a-z]{2,4}\. ?\d", line)):
            return "listed"
    return "prose"


def _phrases(lines: list[list[str]]) -> frozenset[tuple[str, ...]]:
    """The phrases of three words that some lines repeat often; most texts have so many distinct words that none is sought."""
    n = sum(map(len, lines))
    if n < 3 * OFTEN or len({w for ws in lines for w in ws}) > 0.6 * n:
        return frozenset()
    return frozenset(k for k, c in Counter(x for ws in lines for x in zip(ws, ws[1:], ws[2:])).items() if c >= OFTEN)


def measure(text: str | None) -> dict | None:
    """Counts of words by kind of line; None for blank texts."""
    if not text or not text.strip():
        return None
    ws_all: list[str] = []
    count: Counter[str] = Counter()
    short: list[tuple[list[str], int]] = []
    prose: list[tuple[str, list[str], int]] = []
    fenced = False
    for line in text.splitlines():
        if line.lstrip().startswith("```"):
            fenced = not fenced
            continue
        ws = WORD_RE.findall(line.lower())
        if not ws:
            continue
        ws_all += ws
        kind = "other" if fenced else line_kind(line, ws)
        if kind == "prose":
            fn = function_words(ws)
            if 2 <= len(ws) <= 9 and not SENTENCE.search(line) and not re.match(r"\s*(?:[-*+]|\d+[.)]|#+)\s", line):
                short.append((ws, fn))
            else:
                prose.append((line, ws, fn))
            continue
        count[kind] += len(ws)
        if kind in ("listed", "repeated"):
            count["stuffed_function"] += function_words(ws)
            if kind == "repeated":
                count["repeated_again"] += len(ws) - len(set(ws))
            else:
                count["listed_separators"] += len(SEPARATOR.findall(line))
                count["listed_characters"] += len(line)
    if not ws_all:
        return None
    starts = Counter(tuple(ws[:2]) for ws, _ in short)
    for ws, fn in short:  # many short lines with one opening are one phrase, varied
        n = starts[tuple(ws[:2])]
        if n >= 6 and n >= 0.5 * len(short):
            count["opened"] += len(ws)
            count["stuffed_function"] += fn
        else:
            prose.append(("", ws, fn))
    again = Counter(tuple(ws) for _, ws, _ in prose) if len(prose) >= OFTEN else {}
    phrases = _phrases([ws for _, ws, _ in prose])
    for line, ws, fn in prose:
        kind = "prose"
        few = fn < 0.25 * len(ws)  # sentences may occur again, too
        if few and len(ws) >= 2 and again.get(tuple(ws), 0) >= OFTEN:
            kind = "duplicated"
        elif few and phrases and len(ws) >= 4:
            held: set[int] = set()
            for k, x in enumerate(zip(ws, ws[1:], ws[2:])):
                if x in phrases:
                    held |= {k, k + 1, k + 2}
            kind = "phrased" if len(held) >= 0.5 * len(ws) else kind
        count[kind] += len(ws)
        if kind != "prose":
            count["stuffed_function"] += fn
            continue
        count["prose_words"] += len(ws)
        count["prose_function"] += fn
        if len(line) >= 20:
            count["prose_separators"] += len(SEPARATOR.findall(line))
            count["prose_characters"] += len(line)
            count["prose_again"] += len(ws) - len(set(ws))
    return {"language": language_of(ws_all, text), "words": sum(count[k] for k in (*KINDS, "prose", "other")), **{k: count[k] for k in COUNTS[1:]}}


def features(docs: DataFrame) -> DataFrame:
    """One row per document with words: its language and the counts of words by kind of line."""

    def run(batches):
        for batch in batches:
            rows = [(d, m) for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if (m := measure(t))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([d for d, _ in rows], pa.int64()), pa.array([m["language"] for _, m in rows], pa.string()), *[pa.array([m[k] for _, m in rows], pa.int32()) for k in COUNTS]],
                ["doc_id", "language", *COUNTS],
            )

    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return spread(docs).mapInArrow(run, "doc_id bigint, language string, " + ", ".join(f"{k} int" for k in COUNTS))


def calibration(measured: DataFrame) -> DataFrame:
    """Per language the median shares of function words, separators and words that occur again in running text, over all documents
    that have some.

    A language whose median of function words is 0 has none: "other" is what texts without any known one are called.
    """
    prose = measured.where("prose_words >= 20 and language <> 'other'")

    def median(name: str, of: str, to: str = "prose_words"):
        return F.percentile_approx(F.col(of) / F.nullif(to, F.lit(0)), 0.5, 1000).alias(name)

    return prose.groupBy("language").agg(median("median", "prose_function"), median("separators", "prose_separators", "prose_characters"), median("again", "prose_again")).where("median > 0")


def stuffed(docs: DataFrame, share: float = SHARE, least_words: int = LEAST_WORDS, lack: float = LACK, rise: float = RISE) -> DataFrame:
    """(doc_id, share, kind) of the documents that mostly consist of stuffed lines.

    Null, empty and blank texts are no cases, nor are texts with fewer than least_words stuffed words; a
    repeated row counts once.  The measured counts are written once (checkpoint) because both the medians
    and the verdict need them; there are at most eight languages, so the medians are a small join side.
    """
    measured = checkpointed(features(docs))
    told = measured.join(F.broadcast(calibration(measured)), "language", "left")
    listed = F.col("listed_separators") >= F.least(F.lit(MOST_SEPARATORS), rise * F.coalesce("separators", F.lit(DEFAULT_SEPARATORS))) * F.col("listed_characters")
    repeated = F.col("repeated_again") >= F.least(F.lit(MOST_AGAIN), rise * F.coalesce("again", F.lit(DEFAULT_AGAIN))) * F.col("repeated")
    told = told.withColumns({"listed": F.when(listed, F.col("listed")).otherwise(0), "repeated": F.when(repeated, F.col("repeated")).otherwise(0)})
    in_lines = sum((F.col(k) for k in KINDS), F.lit(0))
    worded = in_lines - F.col("linked")
    kinds = F.array(*[F.struct(F.col(k).alias("n"), F.lit(k).alias("k")) for k in KINDS])
    return (
        told.where((in_lines >= least_words) & (in_lines >= share * F.col("words")))
        .where((worded == 0) | (F.col("stuffed_function") < lack * F.coalesce("median", F.lit(DEFAULT_MEDIAN)) * worded))
        .select("doc_id", F.round(in_lines / F.col("words"), 6).alias("share"), F.array_max(kinds)["k"].alias("kind"))
        .distinct()
    )
