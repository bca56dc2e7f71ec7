"""Problem 8: encoding a corpus with a public byte-level BPE vocabulary.

For each pre-token the encoder fills one value per prefix: the *last token* of the encoding of that
prefix.  The encoding of a prefix is unique, so a token t that ends at position i is the last token
exactly if the encoding of the prefix before t ends in a token p such that the pair (p, t) survives
merging, that is, encoding the bytes of p+t gives (p, t) again.  Candidates t come from a suffix
automaton of the vocabulary (here: a goto/fail machine over the token bytes, whose states stand for
the longest vocabulary prefix that ends at a position, with links to the next shorter token).  Pair
compatibility is tested by un-merging p and t along the inner boundary.  Back-pointers give the ids.
Time is linear in the text times the number of vocabulary tokens ending at one position, so very long
runs cost no more per byte than short ones.
"""

from __future__ import annotations

import base64
import os
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from chunkloom.llm.common import spread

#: Fixed value: the published pre-tokenizer pattern of the byte_bpe_50k vocabulary.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Pre-tokens up to this many bytes are remembered by a worker, and so many of them.
MEMO_BYTES, MEMO_ENTRIES = 64, 400_000

DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


class PrefixEncoder:
    """Exact BPE by per-prefix dynamic programming."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self._build_machine()
        self._split: dict[int, tuple[int, int] | None] = {}
        self._pairs: dict[int, bool] = {}

    def _build_machine(self) -> None:
        """States are vocabulary prefixes; ends[s] is the longest token that is a suffix of s, fail[s] the next state."""
        goto: list[dict[int, int]] = [{}]
        token_at = [-1]
        for tok, i in self.ranks.items():
            s = 0
            for b in tok:
                n = goto[s].get(b)
                if n is None:
                    n = len(goto)
                    goto[s][b] = n
                    goto.append({})
                    token_at.append(-1)
                s = n
            token_at[s] = i
        fail = [0] * len(goto)
        longest, shorter = list(token_at), [0] * len(goto)
        queue = list(goto[0].values())
        for s in queue:
            for b, n in goto[s].items():
                f = fail[s]
                while f and b not in goto[f]:
                    f = fail[f]
                fail[n] = goto[f].get(b, 0)
                queue.append(n)
        for s in queue:  # breadth first: the failure state is done before
            f = fail[s]
            shorter[s] = f if longest[f] >= 0 else 0
            if token_at[s] < 0:
                longest[s], shorter[s] = longest[f], shorter[f]
        self.goto, self.fail, self.longest, self.shorter = goto, fail, longest, shorter

    def _parts(self, t: int) -> tuple[int, int] | None:
        """The two tokens that merge into t when its bytes are encoded, or None for a base token."""
        if t in self._split:
            return self._split[t]
        tok, out = self.tokens[t], None
        if len(tok) > 1:
            parts = [self.ranks[tok[i : i + 1]] for i in range(len(tok))]
            while len(parts) > 2:
                best, at = None, -1
                for k in range(len(parts) - 1):
                    r = self.ranks.get(self.tokens[parts[k]] + self.tokens[parts[k + 1]])
                    if r is not None and (best is None or r < best):
                        best, at = r, k
                if best is None:
                    break
                parts[at : at + 2] = [best]
            if len(parts) == 2:
                out = (parts[0], parts[1])
        self._split[t] = out
        return out

    def compatible(self, p: int, t: int) -> bool:
        """Whether the pair (p, t) stays as it is when the bytes of p+t are encoded."""
        key = p << 20 | t
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) > 2_000_000:
                self._pairs.clear()
            known = self._pairs[key] = self._survives(p, t)
        return known

    def _survives(self, left: int, right: int) -> bool:
        """Undo merges next to the boundary, latest first; a merge across it of lower rank would have come before."""
        ranks, tokens = self.ranks, self.tokens
        limit = 1 << 62
        while True:
            across = ranks.get(tokens[left] + tokens[right])
            if across is not None and across < limit:
                return False
            lp, rp = self._parts(left), self._parts(right)
            if left > right:  # left was merged later: look at the time before
                limit = left
                if lp is None:
                    limit = right + 1 if rp is None else right
                    if rp is None:
                        return True
                    right = rp[0]
                else:
                    left = lp[1]
            else:
                limit = right
                if rp is None:
                    if lp is None:
                        return True
                    limit, left = left, lp[1]
                else:
                    right, limit = rp[0], right + 1

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        last = [-1] * (n + 1)
        size = self._sizes
        goto, fail, longest, shorter = self.goto, self.fail, self.longest, self.shorter
        state = 0
        for i, b in enumerate(piece, 1):
            while state and b not in goto[state]:
                state = fail[state]
            state = goto[state].get(b, 0)
            s = state
            while True:  # tokens that end here, longest first
                t = longest[s]
                j = i - size[t]
                if j == 0 or last[j] >= 0 and self.compatible(last[j], t):
                    last[i] = t
                    break
                s = shorter[s]
        out, i = [], n
        while i:
            out.append(last[i])
            i -= size[last[i]]
        out.reverse()
        return out

    @property
    def _sizes(self) -> list[int]:
        sizes = self.__dict__.get("_size_list")
        if sizes is None:
            sizes = [0] * (max(self.tokens) + 1)
            for i, t in self.tokens.items():
                sizes[i] = len(t)
            self.__dict__["_size_list"] = sizes
        return sizes


@lru_cache(maxsize=4)
def encoder(path: str) -> tuple[PrefixEncoder, regex.Pattern, dict[str, tuple[int, ...]]]:
    """Once per Python worker: the encoder, the pre-tokenizer and the memory of short pre-tokens."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return PrefixEncoder(ranks), regex.compile(SPLIT), {}


def encode_text(text: str | None, path: str = DEFAULT_VOCABULARY) -> list[int]:
    """The ids of one text; null and empty texts give an empty list, lone surrogates count as U+FFFD."""
    if not text:
        return []
    enc, split, memo = encoder(path)
    out: list[int] = []
    for piece in split.findall(text):
        ids = memo.get(piece)
        if ids is None:
            ids = enc.encode_piece(piece.encode("utf-8", "replace"))
            if len(piece) <= MEMO_BYTES:
                if len(memo) >= MEMO_ENTRIES:
                    memo.clear()
                memo[piece] = tuple(ids)
        out.extend(ids)
    return out


def encode_corpus(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """Rows (id, ids) for every row of df, in one pass.

    Null and empty texts give an empty list; repeated rows give repeated results; other columns are not read.
    The vocabulary is a file that every executor can read.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            ids = [encode_text(t, vocabulary) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], [id_col, "ids"])

    return spread(df.select(id_col, text_col)).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")


def vocabulary_path() -> str:
    """The folder of tokenizer files may be set by the environment variable TOKENIZERS."""
    return os.path.join(os.environ.get("TOKENIZERS", os.path.dirname(DEFAULT_VOCABULARY)), os.path.basename(DEFAULT_VOCABULARY))
