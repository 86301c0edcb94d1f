"""Format-preserving pseudonyms: validated numbers, dates and addresses are permuted by a keyed Feistel network."""

from __future__ import annotations

import functools
import hashlib
import re
import unicodedata
from collections.abc import Callable, Iterator
from datetime import date, timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8

FOUND = "text string, found array<struct<kind:string,start:int,end:int>>"

# ---- fixed values: lengths and leading digits of payment cards, (first, last prefix, lengths)
CARDS = [
    (4, 4, (13, 16, 19)), (51, 55, (16,)), (2221, 2720, (16,)), (34, 34, (15,)), (37, 37, (15,)),
    (6011, 6011, (16, 19)), (644, 649, (16, 19)), (65, 65, (16, 19)), (3528, 3589, (16, 19)),
    (36, 36, (14, 16, 19)), (38, 39, (14, 16, 19)), (300, 305, (14, 16, 19)), (62, 62, (16, 17, 18, 19)),
]
FIRST_DAY, LAST_DAY = date(1900, 1, 1), date(2099, 12, 31)
# ---- fixed values: characters of an IBAN by country
IBAN_LENGTHS = {country: n for n, countries in {
    15: "NO", 16: "BE", 18: "DK FK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ XK LT LU MN",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC", 33: "RU"}.items() for country in countries.split()}

# ---- fixed values: the country codes of two digits; 1 and 7 have one, all others three
TWO_DIGIT_CODES = frozenset("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 "
                            "65 66 81 82 84 86 90 91 92 93 94 95 98".split())

#: What may be a value; each kind is validated after it. No digit, letter or joining mark stands beside a match, save
#: a time behind a date. What follows a value may look like more of it: shorter cuts are tried too (``valid_at``).
CANDIDATE = re.compile(r"""
    (?P<email>(?<![\w.+-])[\w+-]+(?:\.[\w+-]+)*@[^\W_](?:[\w-]*[^\W_])?(?:\.[^\W_](?:[\w-]*[^\W_])?)+(?![\w@-]))
  | (?P<iban>(?<![\w-])[A-Za-z]{2}[0-9]{2}(?:\ ?[A-Za-z0-9]{4}){2,7}(?:\ ?[A-Za-z0-9]{1,3})?(?![\w-]))
  | (?P<ip>(?<!\w)(?<!\d[.-])\d{1,3}(?:\.\d{1,3}){3}(?![\w-]|\.\d))
  | (?P<date>(?<![\w./-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{1,2}[./]\d{1,2}[./]\d{4})
                (?:(?=[Tt]\d\d(?!\d{3}|[^\W\d_]{2}))|(?![\w/-]|\.\d)))
  | (?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))
  | (?P<phone>(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}
                |\(\d{3}\)[ .-]?\d{3}[.-]?\d{4}|\d{3}(?P<mark>[.-])\d{3}(?P=mark)\d{4})(?![\w-]|\.\d))
  | (?P<card>(?<!\w)(?<!\d[.-])\d(?:[ -]?\d){12,18}(?![\w-]|\.\d))
""", re.VERBOSE)
CARD = re.compile(r"\d(?:[ -]?\d){12,18}(?![\w-]|\.\d)")


def feistel(value: int, domain: int, key: bytes, tweak: str) -> int:
    """A keyed permutation of 0 .. domain - 1: a balanced Feistel network on the next even number of bits,
    applied again while it leaves the domain. ``tweak`` gives each format a permutation of its own."""
    half = max(1, ((domain - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    size = (half + 7) // 8 + 1
    while True:
        left, right = value >> half, value & mask
        for n in range(ROUNDS):
            data = f"{tweak}|{domain}|{n}|{right}".encode()
            digest = hashlib.shake_256(hashlib.blake2b(data, key=key, digest_size=32).digest()).digest(size)
            left, right = right, left ^ (int.from_bytes(digest, "big") & mask)
        value = left << half | right
        if value < domain:
            return value


@functools.lru_cache(maxsize=4096)
def alphabet(c: str) -> str:
    """The characters that may stand in the place of ``c`` (lower case): the digits of its script, a to z, or the
    letters of the same kind on its page of 256 code points. Only itself, if it is a mark or has no such page."""
    zero = ord(c) - unicodedata.decimal(c, 0)
    if unicodedata.decimal(c, None) is not None:
        return "".join(map(chr, range(zero, zero + 10)))
    if "a" <= c <= "z":
        return "abcdefghijklmnopqrstuvwxyz"
    kind = unicodedata.category(c)
    if kind not in ("Ll", "Lo"):
        return c
    page = (chr(x) for x in range(ord(c) & ~0xFF, (ord(c) | 0xFF) + 1))
    return "".join(x for x in page if x > "\x7f" and unicodedata.category(x) == kind and x.lower() == x and x.isalnum())


def lower(c: str) -> str:
    """The lower case of a character, itself if that has several characters or no way back."""
    return c.lower() if len(c.lower()) == 1 and c.lower().upper() == c else c


def permuted(text: str, key: bytes, kind: str) -> str:
    """``text`` with its digits and letters, of whatever script, permuted together; places keep class, case and marks.

    Case doesn't count in the value, so that a text in capitals gets the same pseudonym in capitals, and neither does
    the script of a digit. A text without digits and letters comes back as it is.
    """
    signs = [alphabet(lower(c)) for c in text]
    value, domain = 0, 1
    for c, some in zip(text, signs):
        value = value * len(some) + some.index(lower(c))
        domain *= len(some)
    if domain == 1:
        return text
    shape = ".".join(str(len(some)) if len(some) in (1, 10, 26) else f"{len(some)}{some[0]}" for some in signs)
    value = feistel(value, domain, key, f"{kind}|{shape}")
    out = []
    for c, some in zip(reversed(text), reversed(signs)):
        value, place = divmod(value, len(some))
        new = some[place]
        out.append(new.upper() if lower(c) != c and len(new.upper()) == 1 and new.upper().lower() == new else new)
    return "".join(reversed(out))


def ascii_digits(value: str) -> str:
    """The digits of a value, of whatever script, as 0 to 9."""
    return "".join(str(unicodedata.decimal(c)) for c in value if unicodedata.decimal(c, None) is not None)


def put_digits(form: str, digits: str) -> str:
    """``form`` with its digits replaced in turn by ``digits``, each in the script of its place."""
    new = iter(digits)
    return "".join(alphabet(c)[int(next(new))] if unicodedata.decimal(c, None) is not None else c for c in form)


def luhn(digits: str) -> int:
    """The Luhn sum modulo 10; 0 for a valid number."""
    doubled = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10


def issuer(digits: str) -> int:
    """The length of the card prefix that fits the number and its length, 0 if none does."""
    for first, last, lengths in CARDS:
        n = len(str(first))
        if len(digits) in lengths and first <= int(digits[:n]) <= last:
            return n
    return 0


def card(value: str, key: bytes) -> str | None:
    """Valid by prefix, length and Luhn digit. The prefix stays, the digits between are permuted, the last follows."""
    digits = ascii_digits(value)
    prefix = issuer(digits)
    if not prefix or luhn(digits) or len(set(digits)) == 1:
        return None
    body = digits[prefix:-1]
    new = digits[:prefix] + str(feistel(int(body), 10 ** len(body), key, f"card{len(digits)}")).zfill(len(body))
    return put_digits(value, new + str(-luhn(new + "0") % 10))


def ip(value: str, key: bytes) -> str | None:
    octets = [int(x) for x in value.split(".")]
    if max(octets) > 255 or any(x != str(int(x)) for x in value.split(".")):
        return None
    new = feistel(int.from_bytes(bytes(octets), "big"), 1 << 32, key, "ip")
    return ".".join(map(str, new.to_bytes(4, "big")))


def day(value: str, key: bytes) -> str | None:
    """A calendar date from FIRST_DAY to LAST_DAY: year first, else day first after a dot, month first after a
    slash (day first if only that is a date). It becomes another one, written in the same way."""
    fields = re.split(r"[./-]", value)
    numbers = [int(x) for x in fields]
    orders = ["ymd"] if len(fields[0]) == 4 else ["dmy"] if "." in value else ["mdy", "dmy"]
    if len(set(re.findall(r"[./-]", value))) > 1:
        return None
    for order in orders:
        try:
            then = date(**{{"y": "year", "m": "month", "d": "day"}[c]: n for c, n in zip(order, numbers)})
        except ValueError:
            continue
        if not FIRST_DAY <= then <= LAST_DAY:
            return None
        days = (LAST_DAY - FIRST_DAY).days + 1
        new = FIRST_DAY + timedelta(feistel((then - FIRST_DAY).days, days, key, "date"))
        shown = {"y": str(new.year).zfill(4), "m": str(new.month), "d": str(new.day)}
        marks = iter([*re.findall(r"[./-]", value), ""])
        padded = all(len(f) >= 2 for f in fields)
        return "".join((shown[c].zfill(2) if padded else shown[c]) + next(marks) for c in order)
    return None


def ssn(value: str, key: bytes) -> str | None:
    def valid(n: int) -> bool:
        area, group, serial = n // 1_000_000, n // 10_000 % 100, n % 10_000
        return 0 < area < 900 and area != 666 and group > 0 and serial > 0

    n = int(ascii_digits(value))
    if not valid(n):
        return None
    n = feistel(n, 10 ** 9, key, "ssn")
    while not valid(n):
        n = feistel(n, 10 ** 9, key, "ssn")
    return put_digits(value, str(n).zfill(9))


def iban(value: str, key: bytes) -> str | None:
    """Valid by its check digits, which follow the permuted account part; the country stays."""
    plain = value.replace(" ", "")
    number = lambda s: int("".join(str(int(c, 36)) for c in s))
    if not 15 <= len(plain) <= 34 or number(plain[4:] + plain[:4]) % 97 != 1:
        return None
    body = permuted(plain[4:], key, "iban")
    check = 98 - number(body + plain[:2] + "00") % 97
    new = iter(plain[:2] + str(check).zfill(2) + body)
    return "".join(c if c == " " else next(new) for c in value)


def country_code(digits: str) -> str:
    """The country code that an international number begins with."""
    return digits[:1] if digits[0] in "17" else digits[:2] if digits[:2] in TWO_DIGIT_CODES else digits[:3]


def phone(value: str, key: bytes) -> str | None:
    """8 to 15 digits with a country code, or 10 without (country code 1); the code and the marks stay.

    The national digits are permuted by themselves, under the code: marks, brackets and the script of the digits don't
    count, so that all spellings of a number get the same pseudonym.
    """
    digits = ascii_digits(value)
    if not 8 <= len(digits) <= 15:
        return None
    code = country_code(digits) if value[0] == "+" else ""
    national = digits[len(code):]
    return put_digits(value, code + permuted(national, key, f"phone{code or 1}"))


def email(value: str, key: bytes) -> str | None:
    """The local part is permuted, the domain stays; None if there is no letter or digit to permute."""
    local, _, domain = value.partition("@")
    if all(len(alphabet(lower(c))) == 1 for c in local):
        return None
    return f"{permuted(local, key, 'email')}@{domain}"


KINDS: dict[str, Callable[[str, bytes], str | None]] = {
    "email": email, "iban": iban, "ip": ip, "date": day, "ssn": ssn, "phone": phone, "card": card}


def card_shaped(value: str) -> bool:
    """Whether a number is written as a card is: groups of four or more but for the last, with one kind of mark.
    Asked of cuts only, so that columns of small numbers don't make cards by chance."""
    return len(set(re.findall(r"[ -]", value))) <= 1 and all(len(g) >= 4 for g in re.split(r"[ -]", value)[:-1])


def card_at(text: str, start: int, key: bytes) -> tuple[int, str] | None:
    """(end, pseudonym) of the longest valid card from ``start``, whole or cut before one of its marks."""
    m = CARD.match(text, start)
    ends = [m.end(), *(k for k in range(m.end() - 2, start + 12, -1) if text[k] in " -")] if m else []
    for end in ends:
        value = text[start:end]
        if (end == m.end() or card_shaped(value)) and (new := card(value, key)) is not None:
            return end, new
    return None


def iban_ends(value: str) -> list[int]:
    """Ends of what may be an IBAN: before a blank where it has its country's length, and the whole."""
    length = IBAN_LENGTHS.get(value[:2].upper())
    return [*(k for k, c in enumerate(value) if c == " " and k - value.count(" ", 0, k) == length), len(value)]


def valid_at(text: str, m: re.Match, key: bytes) -> tuple[str, int, int, str] | None:
    """(kind, start, end, pseudonym) of a valid value in the candidate ``m``, None if there is none from its start
    or behind one of its hyphens. Groups that follow a card, an IBAN or a phone number are cut off, the last first."""
    kind, start, value = m.lastgroup, m.start(), m.group()
    if kind == "card":
        for at in [start, *(k + 1 for k in range(start, m.end()) if text[k] == "-")]:
            if hit := card_at(text, at, key):
                return kind, at, *hit
        return None
    ends = [len(value)]
    if kind == "iban":
        ends = iban_ends(value)
    elif kind == "phone" and value[0] == "+":
        blanks = [k for k in range(len(value) - 1, 0, -1) if value[k] == " "]
        # a card that begins in the match and ends behind it isn't part of the phone number
        cards = [k for k in blanks if (hit := card_at(text, start + k + 1, key)) and hit[0] >= m.end()]
        ends = [k for k in [len(value), *blanks] if not cards or k <= min(cards)]
    for end in ends:
        cut = CANDIDATE.match(text, start, start + end)
        if cut and cut.lastgroup == kind and cut.end() == start + end:
            if (new := KINDS[kind](cut.group(), key)) is not None:
                return kind, start, start + end, new
    return None


def values(text: str, key: bytes) -> Iterator[tuple[str, int, int, str]]:
    """(kind, start, end, pseudonym) of each valid value, in order; behind a candidate's first character the search
    goes on if there is none in it."""
    at = 0
    while m := CANDIDATE.search(text, at):
        hit = valid_at(text, m, key)
        if hit:
            yield hit
        at = hit[2] if hit else m.start() + 1


def pseudonymised(text: str | None, key: bytes) -> tuple[str | None, list[tuple[str, int, int]]]:
    """The whole text with a pseudonym for each valid value, and (kind, start, end) of each in the new text."""
    if not text or not re.search(r"[\d@]", text):
        return text, []
    out, found, at, size = [], [], 0, 0
    for kind, start, end, new in values(text, key):
        out += [text[at:start], new]
        size += start - at
        found.append((kind, size, size + len(new)))
        size += len(new)
        at = end
    return "".join(out) + text[at:], found


def pseudonyms(text: Column, key: str) -> Column:
    """Struct column ``(text, found)``: each whole text with pseudonyms, and their kinds and places in it.

    Null stays null; a text without values stays as it is. Equal values get equal pseudonyms in all texts under
    the same ``key``, and different values of a format different ones.
    """
    secret = hashlib.blake2b(key.encode(), digest_size=32).digest()

    @F.pandas_udf(FOUND)
    def replace(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [pseudonymised(t, secret) for t in batch]
            yield pd.DataFrame({
                "text": pd.Series([t for t, _ in rows], dtype=object),
                "found": pd.Series([[{"kind": k, "start": s, "end": e} for k, s, e in f] for _, f in rows],
                                   dtype=object)})

    return replace(text)


def with_pseudonyms(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with ``text`` pseudonymised and ``found`` (kind, start, end in the new text) of each value.

    Repeated rows stay, other columns stay, a column named ``found`` is replaced; an empty table stays empty.
    """
    own = "__llm_pii"
    return (docs.withColumn(own, pseudonyms(F.col(text), key))
            .withColumns({text: F.col(own)["text"], "found": F.col(own)["found"]}).drop(own))
