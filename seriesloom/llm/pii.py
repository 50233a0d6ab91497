"""Personal data in plain and in disguised spelling, as spans of the source text."""

from __future__ import annotations

import functools
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

from pyspark.sql import DataFrame

from .common import map_texts

KINDS = ("email", "ip", "card", "phone")

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a match never begins inside a run of digits: the whole run would have matched or failed alike
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

#: Letters and marks that look like ASCII; compatibility forms and digits of all scripts follow by rule.
HOMOGLYPHS = dict(zip(
    "АВЕЅІЈКМНОРСТУХаеѕіјорсухԁһԛԝ" "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧοινρ" "ıɑɡ∙·•․‐‑‒–−",
    "ABESIJKMHOPCTYXaesijopcyxdhqw" "ABEZHIKMNOPTYXoivp" "iag....-----",
    strict=True,
))
#: Characters without width, which are dropped.
_HIDDEN = "​‌‍⁠﻿­"
#: The digits' names.
DIGITS = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9"}

#: Letters that stand for digits, in runs with a digit and no other letter.
LETTERS = str.maketrans("OolI", "0011")

_NAME = f"(?:{'|'.join(DIGITS)})"
_OPEN, _CLOSE = r" ?[\[({<] ?", r" ?[\])}>] ?"


@functools.cache
def _disguise(least: int, mixed: bool, spaced: bool) -> re.Pattern:
    """Everything that is spelled otherwise; digits' names in runs of ``least`` further items or more.

    Letters among digits and spaced signs are looked for where a quick test has found some.
    """
    run = rf"\b{_NAME}(?:[ ,-]{{1,2}}(?:{_NAME}|[0-9]++)){{{least},}}\b"
    label, dot = "[a-z0-9-]++", rf"{_OPEN}(?:dot|\.){_CLOSE}"
    letters = r"(?<![a-z0-9])(?=[oli]*[0-9])(?=[0-9]*[oli])(?-i:[0-9OolI]++)(?![a-z0-9])"
    # a sign with spaces around it, before a domain with plain dots or with spaces around all of them
    signs = rf"(?<=[a-z0-9]) +@ +(?:{label}(?:\.{label})*\.(?-i:[a-z]{{2,}}+)|{label}(?: +\. +(?-i:[a-z0-9-]++))* +\. +(?-i:[a-z]{{2,}}+))(?![\w-])"
    return re.compile(
        rf"(?P<hidden>[{_HIDDEN}]+)|(?P<at>{_OPEN}(?:at|@){_CLOSE}|(?<=[a-z0-9]) +at +(?={label}(?:\.{label})*+(?: +dot +(?!dot\b)|{dot})))"
        rf"|(?P<dot>{dot}|(?<=[a-z0-9])(?<!\bdot) +dot +(?!dot\b)(?=[a-z0-9]))|(?P<plus>\bplus +(?={_NAME}\b|[0-9]))|(?P<run>{run})"
        + (rf"|(?P<mixed>{letters})" if mixed else "") + (rf"|(?P<spaced>{signs})" if spaced else ""),
        re.IGNORECASE | re.ASCII,
    )


_AMONG_DIGITS = re.compile(r"[0-9][OolI]|[OolI][0-9]")
_ITEM = re.compile(rf"{_NAME}|[0-9]++", re.IGNORECASE | re.ASCII)
_SPACED = re.compile(r" *[@.] *")


class _Lookalikes(dict):
    """Code point to ASCII character; every entry is one character, so places stay as they are."""

    def __missing__(self, code: int) -> str:
        char = chr(code)
        plain = HOMOGLYPHS.get(char) or (char if code < 128 else unicodedata.normalize("NFKC", char))
        if len(plain) != 1 or not plain.isascii():
            plain = str(unicodedata.decimal(char, "")) or char
        self[code] = plain if len(plain) == 1 and plain.isprintable() else char
        return self[code]


_LOOKALIKES = _Lookalikes()


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            yield start, end
        else:
            end = max(end, at)
        at = text.find("@", max(end, at + 1))


def luhn(digits: str) -> bool:
    total = 0
    for n, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + n % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def plain_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Undisguised identifiers per kind: leftmost, without overlap, those that fail their test dropped."""
    out = {"email": list(_emails(text)) if "@" in text else [], "ip": [], "card": [], "phone": []}
    for m in _CARD.finditer(text):
        digits = re.sub("[ -]", "", m[0]) if len(m[0]) <= 40 else ""
        if 16 <= len(digits) <= 19 and luhn(digits):
            out["card"].append(m.span())
    if "." in text:
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                out["ip"].append(m.span())
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                out["phone"].append(m.span())
    return out


class Normalised:
    """A text in plain spelling with the way back: segments as (start here, start there, end there, copied).

    A copied segment is as long here as there: its places, if not its letters, are the same.
    """

    def __init__(self, text: str, loose: bool = True):
        """Lookalikes are replaced one by one; then at, dot, plus and digits' names by their sign, and letters by digits.

        Without ``loose``, names that stand alone and lookalikes of the space stay. ``loose`` and ``other`` then tell
        whether one of these, or anything else, was replaced.
        """
        alike = {} if text.isascii() else {ord(c): _LOOKALIKES[ord(c)] for c in set(text)}
        spaces = [c for c, sign in alike.items() if sign == " " and c != 32]
        if not loose:
            alike |= {c: chr(c) for c in spaces}
        plain = text.translate(alike) if alike else text
        self.parts: list[str] = []
        self.segments: list[tuple[int, int, int, bool]] = []
        self.loose, self.other = bool(spaces), any(chr(c) != sign != " " for c, sign in alike.items())
        self._length = at = 0
        pattern = _disguise(0 if loose else 1, bool(_AMONG_DIGITS.search(plain)), " @ " in plain)
        for m in pattern.finditer(plain):
            self._put(plain[at : m.start()], at, m.start(), True)
            if m.lastgroup == "run" and m[0].isalpha():
                self.loose = True
                self._put(DIGITS[m[0].lower()], m.start(), m.end(), False)
            elif m.lastgroup == "run":
                self.other = True
                for item in _ITEM.finditer(plain, *m.span()):
                    word = item[0].lower()
                    self._put(DIGITS.get(word, word), item.start(), item.end(), word not in DIGITS)
            elif m.lastgroup == "mixed":
                self.other = True
                self._put(m[0].translate(LETTERS), m.start(), m.end(), True)
            elif m.lastgroup == "spaced":
                self.other, upto = True, m.start()
                for sign in _SPACED.finditer(plain, *m.span()):
                    self._put(plain[upto : sign.start()], upto, sign.start(), True)
                    self._put(sign[0].strip(), sign.start(), sign.end(), False)
                    upto = sign.end()
                self._put(plain[upto : m.end()], upto, m.end(), True)
            else:
                self.other = True
                self._put({"at": "@", "dot": ".", "plus": "+", "hidden": ""}[m.lastgroup], m.start(), m.end(), False)
            at = m.end()
        self._put(plain[at:], at, len(plain), True)
        self.text = "".join(self.parts)
        self._starts = [s[0] for s in self.segments]

    def _put(self, made: str, start: int, end: int, copied: bool) -> None:
        if made:
            self.parts.append(made)
            self.segments.append((self._length, start, end, copied))
            self._length += len(made)

    def source(self, start: int, end: int) -> tuple[int, int]:
        """The source span that a span of the normalised text was made from."""
        here, there, _, copied = self.segments[bisect_right(self._starts, start) - 1]
        first = there + (start - here if copied else 0)
        here, there, last, copied = self.segments[bisect_right(self._starts, end - 1) - 1]
        return first, there + end - here if copied else last


def _led_by_a_name(email: str) -> bool:
    """Whether the last label of an address is a digit or its name: ``look at one dot three`` is no address."""
    last = email.rpartition(".")[2].lower()
    return not last[:1].isalpha() or last in DIGITS


def spans(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Plain spans, and those that appear only after normalising, as (kind, start, end) in code points.

    A span of the normalised text counts when its source is spelled otherwise, so ordinary text adds nothing. It
    may overlap a plain one, which stays: a disguised letter cuts an address short. A digit's name that stands alone
    or a lookalike of the space may belong to an identifier or to the words beside it, so the text is read both ways
    and both findings count.
    """
    base = [(kind, *span) for kind, found in plain_spans(text).items() for span in found]
    normal, known, added = Normalised(text), set(base), []
    if not (normal.loose or normal.other):
        return base, []
    for read in [normal, Normalised(text, loose=False)] if normal.loose and normal.other else [normal]:
        for kind, found in plain_spans(read.text).items():
            for a, b in found:
                if kind == "email" and _led_by_a_name(read.text[a:b]):
                    continue
                start, end = read.source(a, b)
                if text[start:end] != read.text[a:b] and (kind, start, end) not in known:
                    known.add((kind, start, end))
                    added.append((kind, start, end))
    return base, added


def _work(texts: list[str]) -> dict[str, list]:
    out = {"spans": []}
    for text in texts:
        base, added = spans(text)
        both = [(KINDS.index(k), s, e, k, False) for k, s, e in base] + [(KINDS.index(k), s, e, k, True) for k, s, e in added]
        out["spans"].append([{"kind": k, "start": s, "end": e, "disguised": d, "found": text[s:e]} for _, s, e, k, d in sorted(both)])
    return out


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, spans (kind, start, end, disguised, found) in order of kind and place, for every row.

    A null or empty text has no spans. Other columns are not read; equal rows give equal rows.
    """
    schema = "spans array<struct<kind: string, start: bigint, end: bigint, disguised: boolean, found: string>>"
    return map_texts(docs, schema, _work, id_col, text_col)
