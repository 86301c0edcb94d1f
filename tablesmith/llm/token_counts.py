"""Token counts of whole texts with a given tokenizer file, computed in Arrow batches that return lengths only."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

#: Texts are taken in batches of about this many bytes, and longer ones cut into parts of about this size.
BATCH_BYTES = 1024 * 1024
#: A call of the tokenizer gets about this many bytes of pieces at once.
CALL_BYTES = 256 * 1024
#: Pieces whose counts a task remembers; beyond it those of the current batch stay.
REMEMBERED = 600_000
#: Longer pieces (in characters) are counted for their batch alone, so that a text without blanks isn't remembered.
LONGEST_REMEMBERED = 64

# Safe places to cut for a tokenizer that drops white space and never joins across it: no token and no special
# string holds one of these characters, so the counts of the pieces between them sum to the whole text's.
_BLANK = re.compile("[ \n\t\r]")
_LINE_ENDS = re.compile("[\n\t\r]")


def byte_balanced(parts: Iterable[str], most: int) -> Iterator[list[str]]:
    """Consecutive runs of ``parts`` of about ``most`` bytes each; a larger part makes a run of its own."""
    run, held = [], 0
    for p in parts:
        n = len(p) if p.isascii() else len(p.encode("utf-8", "replace"))
        if run and held + n > most:
            yield run
            run, held = [], 0
        run.append(p)
        held += n
    if run:
        yield run


def cut(text: str, most: int = BATCH_BYTES) -> Iterator[str]:
    """A text in parts of at least ``most`` characters (but the last), each ended at a blank, tab or line end."""
    at = 0
    while len(text) - at > most:
        found = _BLANK.search(text, at + most)
        if found is None:
            break
        yield text[at:found.start()]
        at = found.end()
    yield text[at:] if at else text


def cuts_at_blanks(tokenizer) -> bool:
    """Whether counts of the pieces between blanks, tabs and line ends sum to a text's: blanks alone give no token,
    a piece has the same count with blanks around it, no added token takes in blanks beside it, and what is between
    two pieces takes no part in either (tried on joined letters, digits, marks and repeated blanks)."""
    setting = json.loads(tokenizer.to_str())
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"])
           for t in setting["added_tokens"]):
        return False
    n = lambda text: len(tokenizer.encode(text, add_special_tokens=False))
    pieces = ["a", "the", "don't", "9", "12", "--", "=", "été", "语", "\u0301"]
    alone = {p: n(p) for p in pieces}
    return (all(n(blank) == 0 for blank in (" ", "\n", "\t", "\r", " \n  \t"))
            and all(n(a + gap + b) == alone[a] + alone[b] and n(gap + a + gap) == alone[a]
                    for a in pieces for b in pieces for gap in (" ", "  ", "\n", "\t", "\r\n")))


class PieceCounter:
    """Token counts of texts, with a memory of the short pieces seen before, bounded in number and in bytes.

    A tokenizer for which blanks are not a place to cut (``cuts_at_blanks``) gets every text whole.
    """

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.known: dict[str, int] = {}
        self.cuts = cuts_at_blanks(self.tokenizer)

    def count(self, texts: list[str | None]) -> list[int]:
        """The token count of each whole text; None and "" have none."""
        if not self.cuts:
            return [len(self.tokenizer.encode(t, add_special_tokens=False)) if t else 0 for t in texts]
        parts = [(k, part) for k, text in enumerate(texts) if text for part in cut(text)]
        out, at = np.zeros(len(texts), dtype=np.int64), 0
        for run in byte_balanced((part for _, part in parts), BATCH_BYTES):
            run = [_LINE_ENDS.sub(" ", part) for part in run]
            pieces = " ".join(run).split(" ")
            long = self.learn(set(pieces))
            counts = np.fromiter(map(self.known.__getitem__, pieces), dtype=np.int64, count=len(pieces))
            first = np.cumsum([0] + [part.count(" ") + 1 for part in run])[:-1]
            np.add.at(out, [k for k, _ in parts[at:at + len(run)]], np.add.reduceat(counts, first))
            at += len(run)
            for p in long:
                del self.known[p]
        return out.tolist()

    def learn(self, pieces: set[str]) -> list[str]:
        """Encode the pieces that aren't known, each once, in calls of about CALL_BYTES; those too long to remember."""
        new = {p for p in pieces if p not in self.known}
        if len(self.known) + len(new) > REMEMBERED:
            self.known = {p: self.known[p] for p in pieces - new}
        for run in byte_balanced(new, CALL_BYTES):
            encoded = self.tokenizer.encode_batch_fast(run, add_special_tokens=False)
            self.known.update(zip(run, map(len, encoded)))
        return [p for p in new if len(p) > LONGEST_REMEMBERED]


def token_count(text: Column, tokenizer_file: str) -> Column:
    """Column with the number of tokens of each whole ``text``, without begin, end or added special tokens.

    ``tokenizer_file`` is a ``tokenizers`` JSON file at the same path on every executor; if its pre-tokenizer drops
    white space, long texts are cut there and repeated pieces encoded once. Null and empty texts have no tokens.
    """
    import os

    @F.arrow_udf(LongType())
    def n_tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        counter = PieceCounter(tokenizer_file)
        for batch in batches:
            yield pa.array(counter.count(batch.to_pylist()), pa.int64())

    return n_tokens(text)


def with_token_counts(df: DataFrame, tokenizer_file: str, limit: int, text: str = "text") -> DataFrame:
    """``df`` with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    Null and empty texts give 0, 0 and false; repeated rows stay; an empty table gives an empty table. Columns
    of ``df`` named like the new ones are replaced.
    """
    counted = df.withColumns({
        "n_bytes": F.coalesce(F.octet_length(F.col(text)).cast("long"), F.lit(0).cast("long")),
        "n_tokens": token_count(F.col(text), tokenizer_file)})
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
