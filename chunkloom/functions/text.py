"""Column expressions on text: all run in the JVM and within whole-stage code generation where Spark allows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Python's white space class, written for Java's engine.
SPACE = r"(?U)[\s\x1c-\x1f\x85]"
#: Default tokenizer: runs of letters, digits and underscores, or single other characters that are no space.
TOKEN = r"[A-Za-z0-9_]+|[^A-Za-z0-9_\s]"


def normalize_text(c: Column) -> Column:
    """White space runs become one space, none at the ends; null stays null."""
    return F.trim(F.regexp_replace(c, SPACE + "+", " "))


def blank_to(c: Column, other: str = "") -> Column:
    """Null becomes the other text."""
    return F.coalesce(c, F.lit(other))


def first_truthy(*columns: Column) -> Column:
    """The first that is neither null nor empty, else the empty text."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns], F.lit(""))


def first_of_list(c: Column) -> Column:
    """Element 0 of a list, or the empty text for an empty or null list."""
    return F.coalesce(F.try_element_at(c, F.lit(1)), F.lit(""))


def is_allowed(c: Column, allow: list[str]) -> Column:
    """Exact, case-sensitive membership; null is not allowed."""
    return F.coalesce(c.isin(allow), F.lit(False))


def count_tokens(c: Column) -> Column:
    """Number of tokens of the default tokenizer; null counts 0."""
    return F.coalesce(F.regexp_count(c, F.lit(TOKEN)), F.lit(0)).cast("int")


def tokens(c: Column) -> Column:
    """Array of the tokens, in order; null gives an empty one."""
    return F.coalesce(F.regexp_extract_all(c, F.lit(f"({TOKEN})"), F.lit(1)), F.array().cast("array<string>"))


def bounded_tokens(text: Column, exact: Column, low: int, high: int) -> Column:
    """Token count with the shortcut by length: null for spans under the noise floor.

    A span of n characters has between n/5 and n/2 tokens.  If even n/2 is under `low` the span goes; if n/2 fits
    and n/5 is not under `low`, n/3 stands for the count; else the exact count decides.
    """
    n = F.length(text)
    most, least = F.greatest(F.lit(1), F.floor(n / 2).cast("int")), F.floor(n / 5).cast("int")
    quick = F.greatest(F.lit(low), F.floor(n / 3).cast("int"))
    return F.when(most < low, F.lit(None).cast("int")).when((most <= high) & (least >= low), quick).when(exact >= low, exact)


def window_starts(n: Column, window: int, overlap: int) -> Column:
    """Start positions of sliding windows over n items: the last window is the first that reaches the end."""
    if window <= 0:
        raise ValueError("the window must be positive")
    step = max(1, window - max(0, overlap))
    last = F.greatest(F.lit(0), F.ceil((n - window) / step)).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), last), lambda i: i * step)).otherwise(F.array().cast("array<int>"))


def clean_doc(c: Column) -> Column:
    """Documentation as a query: no gutter of asterisks, one line, its first sentence."""
    bare = F.regexp_replace(F.trim(c), r"(?m)^\s*\*\s?", "")
    line = F.trim(F.regexp_replace(bare, r"\s+", " "))
    return F.when(line.rlike(r"^.*?[.!?]\s"), F.regexp_extract(line, r"^(.*?[.!?])\s", 1)).otherwise(line)


def assign_query(joined: Column, docstring: Column, subject: Column) -> Column:
    """struct(query_text, query_source): a joined documentation, else the chunk's own, else a commit subject."""
    a, b, c = (F.nullif(clean_doc(x), F.lit("")) for x in (joined, docstring, subject))
    text = F.coalesce(a, b, c, F.lit(""))
    source = F.when(a.isNotNull(), "codesearchnet").when(b.isNotNull(), "docstring").when(c.isNotNull(), "commit").otherwise("none")
    return F.struct(text.alias("query_text"), source.alias("query_source"))


def keep_existing_query(existing: Column, assigned: Column) -> Column:
    """A query that is there already stays as it is, with source codesearchnet."""
    has = F.coalesce(existing != "", F.lit(False))
    return F.struct(
        F.when(has, existing).otherwise(assigned["query_text"]).alias("query_text"),
        F.when(has, F.lit("codesearchnet")).otherwise(assigned["query_source"]).alias("query_source"),
    )


def wrap_query(task: str, c: Column) -> Column:
    """The instruction form of a query; documents get no prefix."""
    return F.concat(F.lit(f"Instruct: {task}\nQuery: "), c)


def stripped_or_original(stripped: Column, original: Column) -> Column:
    """The stripped body, the original if that is blank, one space if both are."""
    def full(c: Column) -> Column:
        return F.when(normalize_text(c) != "", c)

    return F.coalesce(full(stripped), full(original), F.lit(" "))


def not_blank(c: Column) -> Column:
    """One space for blank texts, which HTTP engines refuse."""
    return F.when(F.coalesce(normalize_text(c), F.lit("")) == "", F.lit(" ")).otherwise(c)
