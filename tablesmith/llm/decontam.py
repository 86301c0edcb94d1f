"""Benchmark decontamination by pigeonhole edit matching: exact pieces first, then Myers bit-parallel distance."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesmith.llm.common import parts

#: One edit is allowed for each so many characters of a normalised item.
CHARS_PER_EDIT = 16
#: Characters of items that a pass over the documents looks for; more items are taken in several blocks.
BLOCK_CHARS = 2_000_000

HITS = "array<struct<item:int,distance:int,end:bigint>>"

_WORD = re.compile(r"[^\W_]+")


def normalised(text: str) -> str:
    """Lower-case words (letters and digits) with one space between, before and after them; "" if none."""
    words = _WORD.findall(text.lower())
    return f" {' '.join(words)} " if words else ""


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """(offset, piece): ``item`` in budget + 1 pieces; with at most ``budget`` edits one of them is untouched."""
    cuts = [len(item) * k // (budget + 1) for k in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def masks(pattern: str) -> dict[str, int]:
    found: dict[str, int] = {}
    for k, c in enumerate(pattern):
        found[c] = found.get(c, 0) | 1 << k
    return found


def myers(where: dict[str, int], length: int, text: str) -> tuple[int, int]:
    """The least edit distance between a pattern (its ``masks`` and length) and any part of ``text``, and the
    first end of such a part. The columns of the distance table are kept as two bit vectors of +1 and -1 steps."""
    full, top = (1 << length) - 1, 1 << length - 1
    plus, minus, score, best, end = full, 0, length, length, 0
    for at, c in enumerate(text, 1):
        equal = where.get(c, 0)
        vertical = equal | minus
        horizontal = (((equal & plus) + plus) ^ plus) | equal
        up = minus | (full & ~(horizontal | plus))
        down = plus & horizontal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
            if score < best:
                best, end = score, at
        up <<= 1
        plus = full & ((down << 1) | ~(vertical | up))
        minus = full & up & vertical
    return best, end


class Finder:
    """All items' pieces in one automaton, and what verifies a candidate."""

    def __init__(self, items: list[str], chars_per_edit: int):
        import ahocorasick

        self.items = items
        self.budgets = [len(t) // chars_per_edit for t in items]
        self.where = [masks(t) for t in items]
        self.reach = max((len(t) + 2 * b for t, b in zip(items, self.budgets)), default=0)
        self.pieces: list[list[tuple[int, int]]] = []
        number: dict[str, int] = {}
        for k, (item, budget) in enumerate(zip(items, self.budgets)):
            for offset, piece in pieces(item, budget):
                if piece not in number:
                    number[piece] = len(self.pieces)
                    self.pieces.append([])
                self.pieces[number[piece]].append((k, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, n in number.items():
            self.automaton.add_word(piece, (n, len(piece)))
        if number:
            self.automaton.make_automaton()

    def within(self, text: str) -> dict[int, tuple[int, int]]:
        """item -> (distance, end) for the items within their budgets in a normalised text."""
        starts: dict[int, set[int]] = {}
        for last, (n, length) in self.automaton.iter(text):
            for k, offset in self.pieces[n]:
                starts.setdefault(k, set()).add(last + 1 - length - offset)
        found = {}
        for k, begins in starts.items():
            item, budget = self.items[k], self.budgets[k]
            at = text.find(item)
            if at >= 0:
                found[k] = (0, at + len(item))
                continue
            best = None
            for first, end in spans(sorted(begins), len(item), budget):
                first = max(first, 0)
                distance, at = myers(self.where[k], len(item), text[first:end])
                if distance <= budget and (best is None or distance < best[0]):
                    best = (distance, first + at)
            if best:
                found[k] = best
        return found

    def hits(self, text: str | None) -> list[tuple[int, int, int]]:
        """(item, distance, end in the normalised text) of a whole text, its parts overlapping by the longest reach."""
        if not text or not self.pieces:
            return []
        found: dict[int, tuple[int, int]] = {}
        carry, done = " ", 0
        for part in parts(text):
            more = normalised(part)
            seen = carry + more[1:]
            for k, (distance, end) in self.within(seen).items():
                if k not in found or distance < found[k][0]:
                    found[k] = (distance, done + end)
            carry = seen[-max(self.reach, 1):]
            done += len(seen) - len(carry)
        return [(k, *found[k]) for k in sorted(found)]


def spans(begins: list[int], length: int, budget: int) -> Iterator[tuple[int, int]]:
    """Where an item may lie if it begins at about one of ``begins``: merged stretches of text."""
    first, last = begins[0] - budget, begins[0] + length + budget
    for b in begins[1:]:
        if b - budget > last:
            yield first, last
            first = b - budget
        last = b + length + budget
    yield first, last


def hits(text: Column, items: list[str], chars_per_edit: int) -> Column:
    """Column with the ``HITS`` of normalised ``items`` (at most a block of them) in each whole text."""

    @F.pandas_udf(HITS)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        finder = Finder(items, chars_per_edit)
        for batch in batches:
            yield pd.Series([[{"item": k, "distance": d, "end": e} for k, d, e in finder.hits(t)] for t in batch],
                            dtype=object)

    return find(text)


def blocks(benchmark: DataFrame) -> Iterator[tuple[list, list[str]]]:
    """(item ids, normalised items) of a bounded block after the other; items without words are left out."""
    items = benchmark.select("item_id", "text").filter("text is not null").distinct()
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-chars // BLOCK_CHARS)
    for k in range(n):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()  # one block of items
        pairs = sorted({(r["item_id"], t) for r in rows if (t := normalised(r["text"]))}, key=str)
        if pairs:
            yield [i for i, _ in pairs], [t for _, t in pairs]


def contaminations(docs: DataFrame, benchmark: DataFrame, chars_per_edit: int = CHARS_PER_EDIT) -> DataFrame:
    """``(doc_id, item_id, distance, budget, end)``: the benchmark items found in each document.

    Texts and items are compared as lower-case words with single spaces, items with a blank at both ends. An item
    is found where some part of the whole document is within ``budget`` = its length / ``chars_per_edit`` edits;
    the row has the least distance and where (in the normalised text) it first ends. Null and empty texts and
    items without words match nothing; repeated documents give repeated rows, repeated items one. Empty tables
    give an empty result. Other columns aren't read.
    """
    schema = "doc_id bigint, item_id bigint, distance int, budget int, end bigint"
    out = docs.sparkSession.createDataFrame([], schema)
    for ids, items in blocks(benchmark):
        names = F.array(*[F.lit(i).cast("bigint") for i in ids])
        budgets = F.array(*[F.lit(len(t) // chars_per_edit) for t in items])
        found = docs.select("doc_id", F.explode(hits(F.col("text"), items, chars_per_edit)).alias("hit"))
        out = out.unionByName(found.select(
            "doc_id", F.get(names, "hit.item").alias("item_id"), "hit.distance",
            F.get(budgets, "hit.item").alias("budget"), "hit.end"))
    return out


def decontaminated(docs: DataFrame, benchmark: DataFrame, chars_per_edit: int = CHARS_PER_EDIT) -> DataFrame:
    """The rows of ``docs``, all columns, in which no benchmark item is found; see ``contaminations``."""
    for _, items in blocks(benchmark):
        docs = docs.filter(F.size(hits(F.col("text"), items, chars_per_edit)) == 0)
    return docs
