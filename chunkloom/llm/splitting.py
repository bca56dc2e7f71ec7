"""Problem 3: cutting oversized texts into pieces under a token limit at natural boundaries, with overlap.

A piece is a run of tokens [s, e); the next piece begins at e - overlap, so consecutive pieces share
exactly `overlap` tokens, and all pieces together cover the text.  A cut behind token e costs a penalty
by what stands there (a blank line before unindented text is best, the inside of a line worst), and a
piece costs one unit and more the farther its length is from an even share.  Dynamic programming over the
boundary positions (and over every position of a stretch that has none) takes the cuts of least total cost.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkloom.llm.common import TOKEN, TOKEN_RE, spread

MAX_TOKENS, OVERLAP = 512, 32

#: Penalties of a cut by the kind of boundary, in units of the cost of one more piece.
BLANK_OUTER, BLANK, LINE_OUTER, LINE_CLOSE, LINE, SENTENCE, INSIDE = 0.0, 0.1, 0.15, 0.2, 0.35, 0.5, 1.0
#: Weight of the squared distance from an even length, as a part of the limit.
EVENNESS = 0.5
#: Inside positions count as cuts too where boundaries are farther apart than this part of a piece's own tokens.
STRETCH = 8

PIECES = "piece_no int, pieces int, start_token int, end_token int, start_char int, end_char int, n_tokens int, piece string"


def cut_penalties(text: str, spans: list[tuple[int, int]]) -> np.ndarray:
    """penalty[e] of a cut between token e-1 and token e, for 0 < e < number of tokens."""
    n = len(spans)
    out = np.full(n + 1, INSIDE)
    out[0] = out[n] = 0.0
    for e in range(1, n):
        a, b = spans[e - 1][1], spans[e][0]
        if a == b:
            continue
        gap = text[a:b]
        breaks = gap.count("\n") or gap.count("\r")
        if breaks:
            outer = gap[-1] in "\r\n"
            if breaks > 1:
                out[e] = BLANK_OUTER if outer else BLANK
            elif outer:
                out[e] = LINE_OUTER
            else:
                out[e] = LINE_CLOSE if text[a - 1] in "};>])" or text[spans[e][0]] in "}@#" else LINE
        elif text[a - 1] in ".!?;。！？":
            out[e] = SENTENCE
    return out


def cuts(n: int, penalty: np.ndarray, limit: int = MAX_TOKENS, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """The pieces [s, e) of least total cost; of equal ones the one whose last cuts come first.

    A text of at most `limit` tokens is one piece.  limit must be greater than overlap + 1.
    """
    if overlap < 0 or limit <= overlap + 1:
        raise ValueError("the limit must be greater than the overlap and one token")
    if n <= limit:
        return [(0, n)]
    least = -(-(n - overlap) // (limit - overlap))
    even = overlap + (n - overlap) / least
    room = limit - overlap
    # positions: the natural boundaries, the end, and every position of a stretch without boundaries
    natural = np.flatnonzero(penalty[: n + 1] < INSIDE)
    natural = natural[(natural > overlap) & (natural < n)]
    marks = np.concatenate(([overlap], natural, [n]))
    wide = np.flatnonzero(np.diff(marks) > room // STRETCH)
    at = np.unique(np.concatenate([natural, [n], *[np.arange(marks[w] + 1, marks[w + 1]) for w in wide]]).astype(np.int64))
    cost = np.full(len(at), np.inf)
    back = np.full(len(at), -1, dtype=np.int64)
    first = np.searchsorted(at, at - room, "left")  # the earliest cut before that the limit allows
    fee = np.where(at < n, penalty[at], 0.0)
    for i, e in enumerate(at.tolist()):
        best = 1.0 + EVENNESS * ((e - even) / limit) ** 2 if e <= limit else np.inf
        lo = first[i]
        if lo < i:  # a piece from f - overlap to e has e - f + overlap tokens
            c = cost[lo:i] + EVENNESS * ((e - at[lo:i] + (overlap - even)) / limit) ** 2
            k = int(c.argmin())
            if c[k] + 1.0 < best:
                best, back[i] = c[k] + 1.0, lo + k
        cost[i] = best + fee[i]
    ends, i = [], len(at) - 1
    while i >= 0:
        ends.append(int(at[i]))
        i = int(back[i])
    ends.reverse()
    return [(0 if i == 0 else ends[i - 1] - overlap, e) for i, e in enumerate(ends)]


def split_text(text: str, limit: int = MAX_TOKENS, overlap: int = OVERLAP) -> list[tuple[int, int, int, int, str]]:
    """(first token, end token, first character, end character, piece) of a text's pieces.

    The first piece keeps white space before it and the last one white space after it, so a text of one piece
    comes back unchanged; a text without tokens has one piece of no tokens.
    """
    spans = [m.span() for m in TOKEN_RE.finditer(text)]
    n = len(spans)
    if n <= limit:
        return [(0, n, 0, len(text), text)]
    out = []
    for s, e in cuts(n, cut_penalties(text, spans), limit, overlap):
        a = 0 if s == 0 else spans[s][0]
        b = len(text) if e == n else spans[e - 1][1]
        out.append((s, e, a, b, text[a:b]))
    return out


def oversized(df: DataFrame, id_col: str = "chunk_id", text_col: str = "text", limit: int = MAX_TOKENS) -> DataFrame:
    """The distinct (id, text) rows whose text has more than limit tokens, counted in the JVM and not by n_tokens."""
    count = F.regexp_count(F.col(text_col), F.lit(TOKEN.replace(r"\v", r"\x0B")))
    return spread(df.select(id_col, text_col).where(F.length(text_col) > limit)).where(count > limit).dropDuplicates([id_col, text_col])


def split_oversized(df: DataFrame, id_col: str = "chunk_id", text_col: str = "text", limit: int = MAX_TOKENS, overlap: int = OVERLAP) -> DataFrame:
    """One row per piece of each oversized text.

    Null, empty and blank texts and texts within the limit give no row; repeated rows of one id and text give
    one set of pieces; only the two named columns are read.
    """
    names = [x.split()[0] for x in PIECES.split(", ")]

    def run(batches):
        for batch in batches:
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                pieces = split_text(text, limit, overlap)
                if len(pieces) > 1:
                    rows += [(key, i, len(pieces), s, e, a, b, e - s, p) for i, (s, e, a, b, p) in enumerate(pieces)]
            cols = list(zip(*rows)) if rows else [[]] * 9
            types = [pa.string(), *[pa.int32()] * 7, pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], [id_col, *names])

    rows = oversized(df, id_col, text_col, limit).withColumn(id_col, F.col(id_col).cast("string"))
    return rows.mapInArrow(run, f"`{id_col}` string, {PIECES}")


def tokens(text: str) -> list[str]:
    """The tokens of a text, as the limit counts them."""
    return re.findall(TOKEN, text)
