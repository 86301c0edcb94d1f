"""Cross-tokenizer alignment: fragments of byte ranges compose in a tree to whole documents' token groups."""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Callable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesmith.llm.common import stage_table
from tablesmith.llm.token_counts import byte_balanced

#: Bytes of a range (documents of no more are one range), and fragments that one task composes to one.
RANGE_BYTES, FAN = 32 * 1024, 16
#: Texts go through the tokenizers in runs of about this many bytes; encoded pieces are remembered up to this size.
RUN_BYTES, REMEMBERED_BYTES = 512 * 1024, 64 * 1024 * 1024
#: Ranges that are encoded together.
SPANS = 8
#: Pieces that go through a tokenizer as one text.
JOINED = 256
#: What a remembered piece takes besides its characters, groups and links, about.
PIECE_BYTES = 200
#: Longer pieces (in characters) are kept for their run of texts alone.
LONGEST_REMEMBERED = 64
#: So many characters behind a range's least length a place is sought where both tokenizers' next range may begin.
NEAR = 1024

ALIGNED = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups string, links array<int>"
RANGES = ("key bigint, doc_id bigint, idx bigint, span string, a_from bigint, a_to bigint, b_from bigint, b_to bigint, "
          "a_start bigint, b_start bigint")
FRAGMENTS = ("key bigint, doc_id bigint, idx bigint, ok boolean, bounded boolean, n_a bigint, n_b bigint, n_groups bigint, "
             "groups binary, links array<int>, head array<bigint>, tail array<bigint>")
PAIRS = "pair int, a int, b int, n bigint, best boolean"

#: Where a text may be cut into pieces that both tokenizers encode alone as within the text: before one blank or
#: line end between other characters (tokenizer A ends a run there, no piece of B holds both sides).
_PIECES = re.compile(r"(?<=[^\s▁])(?=[ \n][^\s▁])")
#: A piece of a blank or line end and what neither begins nor ends with white space.
_WORDS = re.compile(r"[ \n][^\s▁](?:[^▁]*[^\s▁])?")
#: White space (and B's blank) that keeps a text from being cut by ``str.split``: other than blanks and line ends, or
#: more than one together.
_OTHER_SPACE = re.compile(r"[^\S \n]|▁")
_ASCII_SPACE, _RUNS = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f", ("  ", " \n", "\n ", "\n\n")
#: Further places where a run of A ends: before white space, and between a letter or digit and a mark.
_CUT_A = re.compile(r"(?<=\S)(?=[ \t\n\r])|(?<=[0-9A-Za-z一-龥])(?=[!-/:-@\[-`{-~、。，])")


class Tokenizer:
    """A way to encode texts, the bytes of each token, and whether texts may be cut into pieces for it."""

    def __init__(self, spelled: list[bytes], encode: Callable[[list[str]], list[list[int]]], cuttable: bool):
        self.bytes, self.encode, self.cuttable = spelled, encode, cuttable
        self.lengths = np.array([len(s) for s in spelled], dtype=np.int64)


class Encoded:
    """Token ids of many pieces one behind the other, and whether their bytes are the piece's.

    Of the pieces the first ``joinable`` may stand behind each other in one text.
    """

    def __init__(self, tokenizer: Tokenizer, pieces: list[str], raw: list[bytes], joinable: int):
        t = tokenizer
        runs = ["".join(pieces[at:min(at + JOINED, joinable)]) for at in range(0, joinable, JOINED)] + pieces[joinable:]
        flat = self._flat(t.encode(runs))
        ends = np.concatenate(([0], np.cumsum(t.lengths[flat])))
        piece_ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)))
        first = np.searchsorted(ends, piece_ends, "right") - 1
        right = np.ones(len(pieces), dtype=bool)
        if b"".join(map(t.bytes.__getitem__, flat.tolist())) != b"".join(raw) or (ends[first] != piece_ends).any():
            found = t.encode(pieces)  # some don't come back: see which
            flat, first = self._flat(found), np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
            right = np.array([b"".join(map(t.bytes.__getitem__, ids)) == r for ids, r in zip(found, raw)], dtype=bool)
        self.flat, self.first, self.right = flat, np.concatenate(([0], first)), right

    @staticmethod
    def _flat(found: list[list[int]]) -> np.ndarray:
        return np.fromiter(chain.from_iterable(found), np.int32, sum(map(len, found)))

    def of(self, which: np.ndarray, counts: list[int]) -> list[tuple[np.ndarray, bool]]:
        """Ids and rightness of texts that have ``counts`` of the pieces ``which``."""
        sizes = self.first[which + 1] - self.first[which]
        ends = np.cumsum(sizes)
        flat = _gathered(self.flat, self.first[which], sizes)
        right = self.right[which]
        ends, out, at = np.concatenate(([0], ends)), [], 0
        for n in counts:
            out.append((flat[ends[at]:ends[at + n]], bool(right[at:at + n].all())))
            at += n
        return out


def _gathered(flat: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The parts of ``flat`` that begin at ``first`` and have ``sizes``, one behind the other."""
    return flat[np.arange(int(sizes.sum())) + np.repeat(first - (np.cumsum(sizes) - sizes), sizes)]


class Pieces:
    """Aligned pieces by key: groups spelled out and links, and how many tokens of A, of B, groups and faults.

    Both tokenizers end a token where a piece ends, so its groups are whole. A piece whose bytes don't come back from
    the tokens of both has a fault and nothing else.
    """

    def __init__(self):
        self.known: dict[str, int] = {}
        self.groups: list[bytes] = []
        self.counts, self.links, self.first = np.zeros((0, 4), np.int32), np.zeros(0, np.int32), np.zeros(1, np.int64)
        self.held = 0

    def add(self, keys: list[str], groups: list[bytes], counts: np.ndarray, links: np.ndarray) -> None:
        self.known.update(zip(keys, range(len(self.groups), len(self.groups) + len(keys))))
        self.groups += groups
        self.counts = np.concatenate((self.counts, counts))
        self.links = np.concatenate((self.links, links))
        self.first = np.concatenate((self.first, self.first[-1] + np.cumsum(counts[:, 2])))

    def remember(self, keys: list[str], groups: list[bytes], counts: np.ndarray, links: np.ndarray) -> None:
        self.add(keys, groups, counts, links)
        self.held += PIECE_BYTES * len(keys) + sum(map(len, groups)) + 4 * (sum(map(len, keys)) + len(links))

    def cut(self, n: int) -> None:
        """Keep the first ``n`` pieces."""
        if n < len(self.groups):
            for key in list(islice(reversed(self.known), len(self.groups) - n)):
                del self.known[key]
            del self.groups[n:]
            self.counts, self.links, self.first = self.counts[:n], self.links[:self.first[n]], self.first[:n + 1]

    def links_of(self, which: np.ndarray) -> np.ndarray:
        return _gathered(self.links, self.first[which], self.counts[which, 2].astype(np.int64))


class Memory:
    """The alignments of the pieces seen before, as many as fit into REMEMBERED_BYTES, about: when half of it is full,
    pieces that aren't met again until the next time are forgotten."""

    def __init__(self, pair: Pairing):
        self.pair, self.tokenizers = pair, (pair.a, pair.b)
        self.cuttable = pair.a.cuttable and pair.b.cuttable
        self.now, self.old, self.kept = Pieces(), Pieces(), 0

    @property
    def known(self) -> dict[str, int]:
        return self.now.known

    @property
    def held(self) -> int:
        return self.now.held + self.old.held

    def keys(self, text: str) -> list[str]:
        """The keys of a text's pieces: one that begins with a single blank goes without it, one that begins with a
        line end is its own key, any other has a tab in front."""
        if not self.cuttable:
            return ["\t" + text]
        if (text[0] in " \n" and text[-1] not in " \n" and not any(r in text for r in _RUNS)
                and not (any(c in text for c in _ASCII_SPACE) if text.isascii() else _OTHER_SPACE.search(text))):
            return text.replace("\n", " \n")[1:].split(" ")
        return [p[1:] if p[0] == " " and len(p) > 1 and not p[1].isspace() else p if p[0] == "\n" else "\t" + p
                for p in _PIECES.split(text)]

    def pieces(self, texts: list[str]) -> tuple[np.ndarray, list[int]]:
        """The numbers of the texts' pieces in ``now``, valid until the next call, and how many each text has."""
        self.now.cut(self.kept)
        if self.now.held > REMEMBERED_BYTES // 2:
            self.old, self.now = self.now, Pieces()
        keys = [self.keys(t) for t in texts]
        every = list(chain.from_iterable(keys))
        known, before = self.now.known, self.old.known
        new = [k for k in dict.fromkeys(every) if k not in known]
        again = [k for k in new if k in before]
        if again:
            which = np.fromiter(map(before.__getitem__, again), np.int64, len(again))
            self.now.remember(again, list(map(self.old.groups.__getitem__, which.tolist())), self.old.counts[which],
                              self.old.links_of(which))
            new = [k for k in new if k not in before]
        short = [k for k in new if len(k) <= LONGEST_REMEMBERED]
        if short:
            self.now.remember(short, *self.aligned(short))
        self.kept = len(self.now.groups)
        if len(short) < len(new):
            long = [k for k in new if len(k) > LONGEST_REMEMBERED]
            self.now.add(long, *self.aligned(long))
        return np.fromiter(map(known.__getitem__, every), np.int64, len(every)), [len(k) for k in keys]

    def aligned(self, keys: list[str]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Groups, counts and links of the pieces of these keys, in their order."""
        pieces = [k if k[0] == "\n" else k[1:] if k[0] == "\t" else " " + k for k in keys]
        fit = [k.isalpha() or self._joinable(p) for k, p in zip(keys, pieces)]
        order = [i for i, x in enumerate(fit) if x] + [i for i, x in enumerate(fit) if not x]
        if fit.count(True) < len(fit):
            pieces = [pieces[i] for i in order]
        raw = [p.encode("utf-8", "surrogatepass") for p in pieces]
        a, b = (Encoded(t, pieces, raw, fit.count(True)) for t in self.tokenizers)
        right = a.right & b.right
        n_a, n_b = (np.where(right, np.diff(e.first), 0) for e in (a, b))
        ids_a, ids_b = (_gathered(e.flat, e.first[:-1], n) for e, n in ((a, n_a), (b, n_b)))
        groups, sizes, links = self.pair.closed(ids_a, ids_b, n_a, n_b)
        counts = np.stack((n_a, n_b, sizes, ~right), axis=1).astype(np.int32)
        if fit.count(True) < len(fit):  # back to the order of the keys
            back = np.argsort(np.array(order))
            links = _gathered(links, (np.cumsum(sizes) - sizes)[back], sizes[back])
            groups, counts = [groups[i] for i in back.tolist()], counts[back]
        return groups, counts, links

    def _joinable(self, piece: str) -> bool:
        """Whether a text may be cut where this piece begins and ends, whatever stands there."""
        return self.cuttable and _WORDS.fullmatch(piece) is not None

    def fragments(self, texts: list[str]) -> list[Fragment]:
        """For texts (not empty) that begin and end where both tokenizers begin and end a token: all groups closed."""
        if not texts:
            return []
        which, counts = self.pieces(texts)
        groups = list(map(self.now.groups.__getitem__, which.tolist()))
        last = np.cumsum(counts)
        sums = np.concatenate((np.zeros((1, 4), np.int64), np.cumsum(self.now.counts[which], axis=0, dtype=np.int64)))
        n = sums[last] - sums[last - counts]
        links, ends, out = self.now.links_of(which), sums[last, 2].tolist(), []
        for (n_a, n_b, n_groups, faults), to, k, m in zip(n.tolist(), ends, last.tolist(), counts):
            out.append(Fragment(self.pair, ok=False) if faults else
                       Fragment(self.pair, True, True, n_a, n_b, n_groups, b"".join(groups[k - m:k]), links[to - n_groups:to]))
        return out

    def ids(self, a_texts: list[str], b_texts: list[str]) -> zip:
        """For each pair of texts A's ids of the first and B's of the second, each with its rightness; nothing of it
        is remembered."""
        return zip(*(self._ids(t, texts) for t, texts in zip(self.tokenizers, (a_texts, b_texts))))

    def _ids(self, tokenizer: Tokenizer, texts: list[str]) -> list[tuple[np.ndarray, bool]]:
        cut = [_PIECES.split(t) if self.cuttable else [t] for t in texts]
        pieces = sorted(set(chain.from_iterable(cut)), key=self._joinable, reverse=True)
        number = {p: i for i, p in enumerate(pieces)}
        encoded = Encoded(tokenizer, pieces, [p.encode("utf-8", "surrogatepass") for p in pieces],
                          sum(map(self._joinable, pieces)))
        return encoded.of(np.array([number[p] for c in cut for p in c], dtype=np.int64), [len(c) for c in cut])


def byte_level_tokenizer(file: str) -> Tokenizer:
    """Tokenizer A from a ``tokenizers`` JSON file of a byte-level BPE; special strings in texts are plain text."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer as Library

    own = Library.from_file(file)
    own.encode_special_tokens = True
    # the byte-level alphabet: printable characters of Latin-1 stand for themselves, the others follow from 256 on
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}
    spelled = [b""] * own.get_vocab_size()
    for token, i in own.get_vocab().items():
        spelled[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
    with open(file, encoding="utf-8") as f:
        made = json.load(f)
    split = made.get("pre_tokenizer") or {}
    cuttable = (made.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex", True)
                and not split.get("add_prefix_space") and all(t["special"] for t in made.get("added_tokens", [])))

    def encode(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in own.encode_batch_fast(texts, add_special_tokens=False)]

    return Tokenizer(spelled, encode, cuttable)


def piece_tokenizer(file: str) -> tuple[Tokenizer, set[tuple[str, str]]]:
    """Tokenizer B from a sentencepiece model that adds a blank in front, and the pairs of neighbours in its pieces.

    A text that begins with a blank is encoded without it, since the model adds one (to a text, not to nothing);
    another one behind a line end, of which the added blank and the line end are taken off again.
    """
    from sentencepiece import SentencePieceProcessor

    own = SentencePieceProcessor(model_file=file)
    names = [own.id_to_piece(i) for i in range(own.get_piece_size())]
    as_byte = re.compile(r"<0x([0-9A-F]{2})>")
    spelled = [bytes([int(m.group(1), 16)]) if (m := as_byte.fullmatch(n)) else n.replace("▁", " ").encode()
               for n in names]
    neighbours = {(p[k], p[k + 1]) for n in names if not as_byte.fullmatch(n)
                  for p in (n.replace("▁", " "),) for k in range(len(p) - 1)}

    def encode(texts: list[str]) -> list[list[int]]:
        lead = [t[:1] != " " or t == " " for t in texts]
        found = own.encode(["\n" + t if x else t[1:] for t, x in zip(texts, lead)], num_threads=1)
        return [ids[2:] if x else ids for ids, x in zip(found, lead)]

    probe = " a  b \n\t c ﬁ"
    whole = b"".join(spelled[i] for i in own.encode(probe[1:])) == probe.encode()
    cuttable = whole and not any("\n" in pair or (pair[1] == " " and pair[0] != " ") for pair in neighbours)
    return Tokenizer(spelled, encode, cuttable), neighbours


class Pairing:
    """Two tokenizers and all pairs of their tokens that a link can hold.

    Linked tokens end at the same byte of a text, so one's bytes end with the other's. The pairs for which this
    holds are numbered; how many there are depends on the vocabularies alone, a few hundred thousand.
    """

    def __init__(self, file_a: str, file_b: str):
        self.a = byte_level_tokenizer(file_a)
        self.b, self.neighbours = piece_tokenizer(file_b)
        self.memory = Memory(self)
        of_a, of_b = {}, {}
        for tokens, spelled in ((of_a, self.a.bytes), (of_b, self.b.bytes)):
            for i, s in enumerate(spelled):
                tokens.setdefault(s, []).append(i)
        n = len(self.b.bytes)
        keys = {i * n + j for s, ids in of_a.items() for k in range(len(s)) for j in of_b.get(s[k:], ()) for i in ids}
        keys |= {i * n + j for s, ids in of_b.items() for k in range(len(s)) for i in of_a.get(s[k:], ()) for j in ids}
        self.pairs = np.array(sorted(keys), dtype=np.int64)
        self.width = len(str(max(len(self.a.bytes), n))) + 1
        self.digits = np.concatenate([self._spelled(len(t.bytes), mark) for t, mark in ((self.a, b"|"), (self.b, b";"))])
        self.widths = np.count_nonzero(self.digits[::2], axis=1)

    def _spelled(self, n: int, mark: bytes) -> np.ndarray:
        """Rows 2 i and 2 i + 1: the decimal i with a comma, and with ``mark``; zeros behind."""
        rows = b"".join((b"%d" % i + end).ljust(self.width, b"\0") for i in range(n) for end in (b",", mark))
        return np.frombuffer(rows, np.uint8).reshape(-1, self.width)

    def numbers(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The numbers of linked pairs."""
        return np.searchsorted(self.pairs, a.astype(np.int64) * len(self.b.bytes) + b).astype(np.int32)

    def text(self, a: np.ndarray, last_a: np.ndarray, b: np.ndarray, last_b: np.ndarray) -> bytes:
        """Whole groups as ``a1,a2|b1;``: ``last_a`` and ``last_b`` mark the tokens that end a group."""
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        before_b = np.concatenate(([0], np.flatnonzero(last_b) + 1))  # tokens of B in the groups before
        upto_a = np.flatnonzero(last_a) + 1
        order = np.empty(len(a) + len(b), dtype=np.int64)
        order[np.arange(len(a)) + before_b[group_a]] = 2 * a.astype(np.int64) + last_a
        order[np.arange(len(b)) + upto_a[group_b]] = 2 * (len(self.a.bytes) + b.astype(np.int64)) + last_b
        out = self.digits[order].reshape(-1)
        return out[out != 0].tobytes()

    def closed(self, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """For pieces of ``n_a`` tokens of A and ``n_b`` of B with the same bytes: each one's groups spelled out, how
        many these are, and the links of all."""
        a_ends, b_ends = np.cumsum(self.a.lengths[a]), np.cumsum(self.b.lengths[b])
        last_a, last_b = np.isin(a_ends, b_ends, assume_unique=True), np.isin(b_ends, a_ends, assume_unique=True)
        text = self.text(a, last_a, b, last_b)
        to_a, to_b = np.cumsum(n_a), np.cumsum(n_b)
        sums = [np.concatenate(([0], np.cumsum(x))) for x in (self.widths[a], self.widths[len(self.a.bytes) + b], last_a)]
        ends = (sums[0][to_a] + sums[1][to_b]).tolist()
        groups = [text[x:y] for x, y in zip([0, *ends], ends)]
        return groups, sums[2][to_a] - sums[2][to_a - n_a], self.numbers(a[last_a], b[last_b])


@functools.lru_cache(maxsize=2)
def pairing(file_a: str, file_b: str) -> Pairing:
    """One pair of tokenizers per Python process."""
    return Pairing(file_a, file_b)


class Tokens:
    """Tokens of A and B of a byte range: ids and the offsets where they end."""

    def __init__(self, a: np.ndarray, a_ends: np.ndarray, b: np.ndarray, b_ends: np.ndarray):
        self.a, self.a_ends, self.b, self.b_ends = a, a_ends, b, b_ends

    def cut(self, a0: int, a1: int, b0: int, b1: int) -> Tokens:
        return Tokens(self.a[a0:a1], self.a_ends[a0:a1], self.b[b0:b1], self.b_ends[b0:b1])

    def __add__(self, other: Tokens) -> Tokens:
        return Tokens(*(np.concatenate((x, y)) for x, y in zip(self.arrays(), other.arrays())))

    def arrays(self) -> tuple[np.ndarray, ...]:
        return self.a, self.a_ends, self.b, self.b_ends

    def packed(self) -> np.ndarray:
        return np.concatenate(([len(self.a)], *self.arrays())).astype(np.int64)

    @classmethod
    def unpacked(cls, values: np.ndarray) -> Tokens:
        n, values = int(values[0]), values[1:]
        m = (len(values) - 2 * n) // 2
        return cls(values[:n], values[n:2 * n], values[2 * n:2 * n + m], values[2 * n + m:])


NOTHING = np.zeros(0, dtype=np.int64)
NO_TOKENS = Tokens(NOTHING, NOTHING, NOTHING, NOTHING)


class Fragment:
    """What is known of the groups of a byte range: an open prefix, closed groups, an open suffix.

    ``head`` has the tokens up to the first offset where both tokenizers end one (all, if there is none: not
    ``bounded``); what its group begins with may lie in the ranges before. ``groups`` and ``links`` have the closed
    groups behind it, ``tail`` the tokens after the last such offset. Fragments of neighbouring ranges compose, and
    in any bracketing to the same: a place where tokens of A and B end together is one whatever is around.
    """

    def __init__(self, pair: Pairing, ok: bool = True, bounded: bool = False, n_a: int = 0, n_b: int = 0,
                 n_groups: int = 0, groups: bytes = b"", links: np.ndarray = NOTHING, head: Tokens = NO_TOKENS,
                 tail: Tokens = NO_TOKENS):
        self.pair, self.ok, self.bounded, self.n_a, self.n_b = pair, ok, bounded, n_a, n_b
        self.n_groups, self.groups, self.links, self.head, self.tail = n_groups, groups, links, head, tail

    @classmethod
    def of(cls, pair: Pairing, tokens: Tokens) -> Fragment:
        n_a, n_b = len(tokens.a), len(tokens.b)
        at = np.minimum(np.searchsorted(tokens.b_ends, tokens.a_ends), max(n_b - 1, 0))
        last_a = tokens.b_ends[at] == tokens.a_ends if n_b else np.zeros(n_a, dtype=bool)
        ia = np.flatnonzero(last_a)
        if not len(ia):
            return cls(pair, n_a=n_a, n_b=n_b, head=tokens)
        ib = at[ia]
        last_b = np.zeros(n_b, dtype=bool)
        last_b[ib] = True
        a0, a1, b0, b1 = ia[0] + 1, ia[-1] + 1, ib[0] + 1, ib[-1] + 1
        groups, links = b"", NOTHING
        if len(ia) > 1:
            groups = pair.text(tokens.a[a0:a1], last_a[a0:a1], tokens.b[b0:b1], last_b[b0:b1])
            links = pair.numbers(tokens.a[ia[1:]], tokens.b[ib[1:]])
        return cls(pair, True, True, n_a, n_b, len(ia) - 1, groups, links, tokens.cut(0, a0, 0, b0),
                   tokens.cut(a1, n_a, b1, n_b))

    def __add__(self, other: Fragment) -> Fragment:
        """The fragment of this range and the next one."""
        seam = Fragment.of(self.pair, (self.tail if self.bounded else self.head) + other.head)
        if self.bounded and seam.bounded:
            seam = seam.closed_head()
        joined = [f for f, use in ((self, self.bounded), (seam, True), (other, other.bounded)) if use]
        bounded = self.bounded or seam.bounded
        return Fragment(
            self.pair, self.ok and other.ok, bounded, self.n_a + other.n_a, self.n_b + other.n_b,
            sum(f.n_groups for f in joined), b"".join(f.groups for f in joined),
            np.concatenate([f.links for f in joined]), self.head if self.bounded else seam.head,
            NO_TOKENS if not bounded else other.tail if other.bounded else seam.tail if seam.bounded else seam.head)

    def closed_head(self) -> Fragment:
        """The same with the first group closed: nothing of it lies before."""
        h = self.head
        if not len(h.a):
            return self
        last_a, last_b = np.zeros(len(h.a), dtype=bool), np.zeros(len(h.b), dtype=bool)
        last_a[-1] = last_b[-1] = True
        return Fragment(self.pair, self.ok, True, self.n_a, self.n_b, self.n_groups + 1,
                        self.pair.text(h.a, last_a, h.b, last_b) + self.groups,
                        np.concatenate((self.pair.numbers(h.a[-1:], h.b[-1:]), self.links)), NO_TOKENS, self.tail)

    def finished(self) -> dict:
        """The columns of a whole document: zeros and no groups unless all bytes came back."""
        whole = self.closed_head() if self.ok and self.bounded else Fragment(self.pair)
        return {"n_a": whole.n_a, "n_b": whole.n_b, "n_groups": whole.n_groups, "groups": whole.groups[:-1].decode(),
                "links": whole.links}

    def row(self) -> dict:
        return {"ok": self.ok, "bounded": self.bounded, "n_a": self.n_a, "n_b": self.n_b, "n_groups": self.n_groups,
                "groups": self.groups, "links": self.links, "head": self.head.packed(), "tail": self.tail.packed()}

    @classmethod
    def from_row(cls, pair: Pairing, row: dict) -> Fragment:
        long = lambda c: np.asarray(row[c], dtype=np.int64)
        return cls(pair, row["ok"], row["bounded"], row["n_a"], row["n_b"], row["n_groups"], row["groups"], long("links"),
                   Tokens.unpacked(long("head")), Tokens.unpacked(long("tail")))


def fragments(pair: Pairing, a_texts: list[str], a_starts: list[int], b_texts: list[str], b_starts: list[int]) -> list[Fragment]:
    """A fragment per range: the tokens of A of one text, those of B of another, and the bytes where these begin."""
    same = [bool(x) and m == n and x == y for x, y, m, n in zip(a_texts, b_texts, a_starts, b_starts)]
    whole = iter(pair.memory.fragments([x for x, alike in zip(a_texts, same) if alike]))
    apart = [k for k, alike in enumerate(same) if not alike]
    ids = pair.memory.ids([a_texts[k] for k in apart], [b_texts[k] for k in apart]) if apart else iter(())
    out = []
    for a0, b0, alike in zip(a_starts, b_starts, same):
        if alike:
            out.append(next(whole))
            continue
        (a, a_ok), (b, b_ok) = next(ids)
        out.append(Fragment.of(pair, Tokens(a, a0 + np.cumsum(pair.a.lengths[a]), b, b0 + np.cumsum(pair.b.lengths[b])))
                   if a_ok and b_ok else Fragment(pair, ok=False))
    return out


def ranges(pair: Pairing, text: str, most: int) -> list[tuple[int, int]]:
    """Character offsets ``(for A, for B)`` where the ranges of a text of more than ``most`` bytes begin.

    After each ``most`` characters both tokenizers' range begins at the next place that is safe for both, if one is
    near. Else either begins at its next safe place, each its own: where a run of A ends; where no piece of B holds
    both neighbours. Without such a place the last range reaches the end.
    """
    if not (pair.a.cuttable and pair.b.cuttable):
        return [(0, 0)]
    out = [(0, 0)]
    n = len(text)
    while out[-1] != (n, n):
        target = max(out[-1][0] + most, out[-1][1] + most)
        if target >= n:
            break
        both = _PIECES.search(text, target, min(n, target + NEAR))
        if both:
            out.append((both.start(), both.start()))
            continue
        found = _CUT_A.search(text, target)
        to_a = found.start() if found else n
        to_b = target
        while to_b < n and _blank(text[to_b - 1], text[to_b]) in pair.neighbours:
            to_b += 1
        out.append((to_a, to_b))
    return out


def _blank(left: str, right: str) -> tuple[str, str]:
    return left.replace("▁", " "), right.replace("▁", " ")


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    """Rows whose lists are arrays as a batch, without a Python object per element."""
    columns = []
    for field in schema:
        values = [r[field.name] for r in rows]
        if pa.types.is_list(field.type):
            ends = np.cumsum([0, *map(len, values)]).astype(np.int32)
            flat = np.concatenate([NOTHING, *values]).astype(field.type.value_type.to_pandas_dtype())
            columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)))
        else:
            columns.append(pa.array(values, field.type))
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def _rows(batch: pa.RecordBatch | pa.Table) -> Iterator[dict]:
    """The rows of a batch, lists as arrays."""
    lists = [pa.types.is_list(f.type) for f in batch.schema]
    for values in zip(*batch.columns):
        yield {name: np.asarray(v.values) if is_list else v.as_py()
               for name, is_list, v in zip(batch.schema.names, lists, values)}


def _arrow(spark_schema: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary(),
             "array<int>": pa.list_(pa.int32()), "array<bigint>": pa.list_(pa.int64())}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in spark_schema.split(", "))])


def _short(docs: DataFrame, files: tuple[str, str]) -> DataFrame:
    schema = _arrow(ALIGNED)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pairing(*files)
        for batch in batches:
            texts, at = [t or "" for t in batch.column("text").to_pylist()], 0
            ids = batch.column("doc_id").to_pylist()
            for run in byte_balanced(texts, RUN_BYTES):
                some = [" " + t for t in run if t]
                found = iter(pair.memory.fragments(some))
                none = Fragment(pair)
                yield _batch([{"doc_id": ids[at + k], **(next(found) if t else none).finished()}
                              for k, t in enumerate(run)], schema)
                at += len(run)

    return docs.mapInArrow(align, ALIGNED)


def _ranges(docs: DataFrame, files: tuple[str, str], most: int) -> DataFrame:
    schema = _arrow(RANGES)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pairing(*files)
        for batch in batches:
            for key, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("key", "doc_id", "text"))):
                text = " " + text
                cuts = [*ranges(pair, text, most), (len(text), len(text))]
                a_byte = b_byte = 0
                for idx, ((a0, b0), (a1, b1)) in enumerate(zip(cuts, cuts[1:])):
                    lo, hi = min(a0, b0), max(a1, b1)
                    yield _batch([{"key": key, "doc_id": doc_id, "idx": idx, "span": text[lo:hi], "a_from": a0 - lo,
                                   "a_to": a1 - lo, "b_from": b0 - lo, "b_to": b1 - lo, "a_start": a_byte,
                                   "b_start": b_byte}], schema)
                    a_byte += len(text[a0:a1].encode())
                    b_byte += len(text[b0:b1].encode())

    return docs.mapInArrow(split, RANGES)


def _fragments(spans: DataFrame, files: tuple[str, str]) -> DataFrame:
    schema = _arrow(FRAGMENTS)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pairing(*files)
        for batch in batches:
            rows = batch.to_pylist()
            for at in range(0, len(rows), SPANS):
                run = rows[at:at + SPANS]
                made = fragments(pair, [r["span"][r["a_from"]:r["a_to"]] for r in run], [r["a_start"] for r in run],
                                 [r["span"][r["b_from"]:r["b_to"]] for r in run], [r["b_start"] for r in run])
                yield _batch([{c: r[c] for c in ("key", "doc_id", "idx")} | f.row() for r, f in zip(run, made)], schema)

    return spans.mapInArrow(encode, FRAGMENTS)


def _composed(parts: DataFrame, files: tuple[str, str], fan: int) -> DataFrame:
    """One level of the tree: ``fan`` neighbouring fragments of a document become one."""
    schema = _arrow(FRAGMENTS)

    def compose(key, table: pa.Table) -> pa.Table:
        pair = pairing(*files)
        rows = sorted(_rows(table), key=lambda r: r["idx"])
        made = functools.reduce(lambda x, y: x + y, (Fragment.from_row(pair, r) for r in rows))
        return pa.Table.from_batches([_batch([{"key": rows[0]["key"], "doc_id": rows[0]["doc_id"],
                                               "idx": rows[0]["idx"] // fan} | made.row()], schema)])

    level = parts.withColumn("parent", F.floor(F.col("idx") / fan))
    return level.groupBy("key", "parent").applyInArrow(
        lambda key, table: compose(key, table.drop_columns(["parent"])), FRAGMENTS)


def _finished(whole: DataFrame, files: tuple[str, str]) -> DataFrame:
    schema = _arrow(ALIGNED)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pairing(*files)
        for batch in batches:
            for r in _rows(batch):
                yield _batch([{"doc_id": r["doc_id"], **Fragment.from_row(pair, r).finished()}], schema)

    return whole.mapInArrow(finish, ALIGNED)


def alignments(docs: DataFrame, file_a: str, file_b: str, range_bytes: int = RANGE_BYTES, fan: int = FAN) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, groups, links)``, one row per row of ``docs(doc_id, text, ...)``.

    Each text, with a blank in front, is encoded by the byte-level BPE of ``file_a`` (A) and the sentencepiece
    model of ``file_b`` (B); the files lie at the same paths on every executor. The offsets where tokens of both
    end cut them into groups, ``groups`` spells these as ``a1,a2|b1;a3|b2,b3``, ``links`` has the numbers (see
    ``pair_counts``) of the pairs of tokens that end together, one a group, in order. Null and empty texts and those
    whose bytes don't come back from the tokens have zeros, no groups and no links; repeated rows stay; an empty
    table gives an empty one; other columns aren't read.

    Texts of more than ``range_bytes`` are cut into byte ranges that spread over the tasks; their fragments are
    composed ``fan`` at a time, level by level. Tokens never change by it: ranges begin at places where the
    tokenizer can't join what lies before and behind, and a text without any is one range.
    """
    files = (file_a, file_b)
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    long = F.coalesce(F.octet_length("text") > range_bytes, F.lit(False))
    tagged = docs.filter(long).withColumn("key", F.monotonically_increasing_id())
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spans = _ranges(tagged, files, range_bytes).repartition(tasks, "key", "idx")
    parts = stage_table(_fragments(spans, files), "fragments")
    left = parts.agg(F.max("idx")).first()[0] or 0
    while left:
        parts = stage_table(_composed(parts, files, fan), "fragments")
        left //= fan
    return _short(docs.filter(~long), files).unionByName(_finished(parts, files))


def pair_counts(aligned: DataFrame, file_a: str, file_b: str) -> DataFrame:
    """PAIRS: each linked pair of tokens with its number, how many links hold it, and whether no pair with the same
    ``b`` has more. Tasks count their own links first; the rows are bounded by the vocabularies."""
    files = (file_a, file_b)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pairing(*files)
        total = np.zeros(len(pair.pairs), dtype=np.int64)
        for batch in batches:
            total += np.bincount(np.asarray(batch.column("links").flatten()), minlength=len(total))
        some = np.flatnonzero(total)
        a, b = np.divmod(pair.pairs[some], len(pair.b.bytes))
        yield pa.RecordBatch.from_pydict({"pair": pa.array(some, pa.int32()), "a": pa.array(a, pa.int32()),
                                          "b": pa.array(b, pa.int32()), "n": pa.array(total[some])})

    counted = (aligned.select("links").mapInArrow(count, "pair int, a int, b int, n bigint")
               .groupBy("pair", "a", "b").agg(F.sum("n").alias("n")))
    most = counted.groupBy("b").agg(F.max("n").alias("most"))
    return counted.join(most, "b").select("pair", "a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def with_link_scores(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """``aligned`` with, in place of ``links``: ``n_links``, ``n_best`` (links of pairs that are best for their b) and
    ``count_sum`` (the sum of the links' counts). ``counts``, at most one row per possible pair, goes to every task."""
    table = counts.select("pair", "n", "best").toArrow()
    which = np.asarray(table["pair"], dtype=np.int64)
    n, best = np.zeros(which.max(initial=-1) + 1, np.int64), np.zeros(which.max(initial=-1) + 1, np.int64)
    n[which], best[which] = np.asarray(table["n"]), np.asarray(table["best"])
    kept = [c for c in aligned.columns if c != "links"]
    schema = ", ".join([*(f"{c} {aligned.schema[c].dataType.simpleString()}" for c in kept),
                        "n_links bigint, n_best bigint, count_sum bigint"])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = batch.column("links")
            flat, sizes = np.asarray(links.flatten()), np.asarray(links.value_lengths()).astype(np.int64)
            ends = np.cumsum(sizes)
            summed = [np.concatenate(([0], np.cumsum(values[flat]))) for values in (best, n)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(sizes), *(pa.array(s[ends] - s[ends - sizes]) for s in summed)],
                names=[*kept, "n_links", "n_best", "count_sum"])

    return aligned.mapInArrow(score, schema)


def scored(docs: DataFrame, file_a: str, file_b: str) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` of ``alignments``: the groups'
    digest ('' without tokens) and the links' counts over the whole corpus."""
    found = alignments(docs, file_a, file_b)
    digest = F.when(F.col("n_groups") == 0, F.lit("")).otherwise(F.sha2("groups", 256))
    aligned = stage_table(found.withColumn("groups_sha256", digest).drop("groups"), "aligned")
    return with_link_scores(aligned, pair_counts(aligned, file_a, file_b)).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
