"""Personal data in plain and in disguised form, with source offsets.

Plain identifiers are found in the text as it is. Then transducers rewrite the text --
look-alike characters, spelled digits, ``at`` and ``dot`` -- and keep, for every character
written, the source span it came from. What the same detectors find in the rewritten text
is mapped back and added, if it holds something rewritten and touches no plain identifier
of its kind. A second rewriting also takes number words that stand alone next to numerals;
what is only found there is added too. Offsets count code points; ends are exclusive. All scans are linear in the
text.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F

from fleetlens.llm.common import text_of

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

# Letters of other scripts that look like Latin ones.
LOOK_ALIKES = dict(zip("АВЕЅІЈКМНОРСТУХаеѕіјорсухԁԛԝΑΒΕΖΗΙΚΜΝΟΡΤΥΧοραν‐‑‒–—−․＠﹫",
                       "ABESIJKMHOPCTYXaesijopcyxdqwABEZHIKMNOPTYXopav------.@@"))
_INVISIBLE = "­​‌‍⁠﻿"
DIGIT_WORDS = {"zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5",
               "six": "6", "seven": "7", "eight": "8", "nine": "9"}

_WORD = "A-Za-z0-9._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"[0-9](?<![0-9]{2})[0-9]*+(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")

_ODD = re.compile(f"[{_INVISIBLE}ʰ-\U0010ffff]")
_NUMBER_WORD = "(?:" + "|".join(DIGIT_WORDS) + ")"
_SPELLED = re.compile(rf"\b{_NUMBER_WORD}(?:[ -]{_NUMBER_WORD})+\b", re.IGNORECASE | re.ASCII)
_SPELLED_ONE = re.compile(_NUMBER_WORD, re.IGNORECASE)
_SPELLED_PAIRS = [a + gap + b for a in DIGIT_WORDS for gap in " -" for b in DIGIT_WORDS]
#: Numerals and number words, what may stand between two of them, and what may be kept there.
_NUMBER = re.compile(rf"[0-9]++|(?<![^\W\d]){_NUMBER_WORD}(?![^\W\d])", re.IGNORECASE)
_BETWEEN = re.compile(r"[\s,;:./()_|-]{0,3}| dot ", re.IGNORECASE)
_KEPT_BETWEEN = re.compile(r"[ -]?|[.()-]+[ ]?| [.()-]+| dot ", re.IGNORECASE)
_PLUS = re.compile(r"\bplus (?=[0-9])", re.IGNORECASE | re.ASCII)
_BRACKETED = re.compile(r"[\[({<] ?(at|dot) ?[\])}>] ?", re.IGNORECASE)
_SAID = re.compile(rf"(?<![{_WORD}])[{_WORD}]++ at [A-Za-z0-9-]++(?:(?: dot |\.)[A-Za-z0-9-]++)+"
                   rf"|(?<![{_WORD}])[0-9]{{1,3}}(?: dot [0-9]{{1,3}}){{3}}", re.IGNORECASE | re.ASCII)
_SAID_ONE = re.compile(r" (at|dot) ", re.IGNORECASE)
_MARKS = {"at": "@", "dot": "."}


def _emails(text: str) -> Iterator[tuple[int, int]]:
    free = 0
    for found in _DOMAIN.finditer(text):
        at = start = found.start()
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < at:
            yield start, found.end()
            free = found.end()


def _luhn(digits: list[str]) -> bool:
    turns = (int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits)))
    return sum(t - 9 if t > 9 else t for t in turns) % 10 == 0


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for found in _IP.finditer(text):
        parts = (p.lstrip("0") for p in found.group().split("."))
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            yield found.span()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for found in _CARD.finditer(text):
        digits = _DIGIT.findall(found.group())
        if 14 <= len(digits) <= 19 and _luhn(digits):
            yield found.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for found in _PHONE.finditer(text):
        if 10 <= len(_DIGIT.findall(found.group())) <= 15:
            yield found.span()


_FINDERS = dict(zip(KINDS, (_emails, _ips, _cards, _phones)))


def plain_spans(text: str) -> list[Span]:
    """Identifiers of the text as it is; leftmost and not overlapping within a kind."""
    return [(kind, *span) for kind in KINDS for span in _FINDERS[kind](text)]


@dataclass
class Rewritten:
    """A text with the source span of each character, and whether it was rewritten."""

    text: str
    start: np.ndarray
    end: np.ndarray
    new: np.ndarray

    @classmethod
    def of(cls, text: str) -> Rewritten:
        at = np.arange(len(text), dtype=np.int64)
        return cls(text, at, at + 1, np.zeros(len(text), bool))

    def replace(self, edits: list[tuple[int, int, str]]) -> Rewritten:
        """Put texts in place of ranges. Each character of a replacement stands for the
        whole range."""
        if not edits:
            return self
        texts, starts, ends, news, free = [], [], [], [], 0
        for a, b, by in edits:
            if not by:  # what is left out leaves its mark on both neighbours
                self.new[max(0, a - 1):b + 1] = True
        for a, b, by in [*edits, (len(self.text), len(self.text), "")]:
            texts += [self.text[free:a], by]
            for parts, own, value in ((starts, self.start, self.start[a] if by else 0),
                                      (ends, self.end, self.end[b - 1] if by else 0),
                                      (news, self.new, True)):
                parts += [own[free:a], np.full(len(by), value, own.dtype)]
            free = b
        return Rewritten("".join(texts), *map(np.concatenate, (starts, ends, news)))


def _look_alike(char: str) -> str:
    if char in LOOK_ALIKES:
        return LOOK_ALIKES[char]
    if unicodedata.category(char) == "Nd":
        return str(unicodedata.decimal(char))
    if "！" <= char <= "～" or "𝐀" <= char <= "𝟿":  # wide and mathematical forms
        plain = unicodedata.normalize("NFKC", char)
        return plain if plain.isascii() else char
    return char


def _characters(text: str) -> Iterator[tuple[int, int, str]]:
    for found in _ODD.finditer(text):
        by = "" if found.group() in _INVISIBLE else _look_alike(found.group())
        if by != found.group():
            yield *found.span(), by


def _spelled_digits(text: str) -> Iterator[tuple[int, int, str]]:
    lower = text.lower()
    if not any(pair in lower for pair in _SPELLED_PAIRS):  # much faster than the pattern
        return
    for run in _SPELLED.finditer(text):
        for word in _SPELLED_ONE.finditer(text, *run.span()):
            yield *word.span(), DIGIT_WORDS[word.group().lower()]


def _near_digits(text: str) -> Iterator[tuple[int, int, str]]:
    """Number words next to a numeral or another number word, and what stands between."""
    lower = text.lower()
    if not any(word in lower for word in DIGIT_WORDS):
        return
    last, end, written = "", -1, False  # the number before, where it ends, and if it is rewritten
    for found in _NUMBER.finditer(text):
        word, between = found.group(), text[end:found.start()] if end >= 0 else None
        near = between is not None and _BETWEEN.fullmatch(text, end, found.start())
        spelled = word.lower() in DIGIT_WORDS
        if near and (spelled or last.lower() in DIGIT_WORDS):
            if not written and last.lower() in DIGIT_WORDS:
                yield end - len(last), end, DIGIT_WORDS[last.lower()]
            if not _KEPT_BETWEEN.fullmatch(between):
                yield end, found.start(), " "
            if spelled:
                yield *found.span(), DIGIT_WORDS[word.lower()]
            written = spelled
        else:
            written = False
        last, end = word, found.end()


def _plus(text: str) -> Iterator[tuple[int, int, str]]:
    if "plus " in text.lower():
        for found in _PLUS.finditer(text):
            yield *found.span(), "+"


def _bracketed(text: str) -> Iterator[tuple[int, int, str]]:
    free = 0
    for found in _BRACKETED.finditer(text):
        start = found.start()
        if start > free and text[start - 1] == " ":
            start -= 1
        free = found.end()
        yield start, free, _MARKS[found.group(1).lower()]


def _said(text: str) -> Iterator[tuple[int, int, str]]:
    for found in _SAID.finditer(text) if " dot " in text.lower() else ():
        if " dot " in found.group().lower():  # "at" alone is an ordinary word
            for mark in _SAID_ONE.finditer(text, *found.span()):
                yield *mark.span(), _MARKS[mark.group(1).lower()]


Transducer = Callable[[str], Iterator[tuple[int, int, str]]]
TRANSDUCERS: tuple[Transducer, ...] = (_characters, _spelled_digits, _plus, _bracketed, _said)
#: A second way, so that a number word behind an identifier does not hide it.
NEAR_TRANSDUCERS: tuple[Transducer, ...] = (_characters, _near_digits, _plus, _bracketed, _said)


def _rewritten(text: str, transducers: tuple[Transducer, ...]) -> Rewritten:
    """The rewritten text; an empty one if nothing was rewritten."""
    current = Rewritten.of("")
    for i, transducer in enumerate(transducers):
        edits = list(transducer(current.text if i and current.text else text))
        if edits:
            current = (current if current.text else Rewritten.of(text)).replace(edits)
    return current


def find_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Plain spans and those only found in a rewritten text, in source offsets."""
    plain = plain_spans(text)
    added: list[Span] = []
    before = ""
    for transducers in (TRANSDUCERS, NEAR_TRANSDUCERS):
        current = _rewritten(text, transducers)
        if not current.text or current.text == before:
            continue
        before = current.text
        more = []
        for kind in KINDS:
            taken = sorted(s[1:] for s in plain + added if s[0] == kind)
            for a, b in _FINDERS[kind](current.text):
                start, end = int(current.start[a]), int(current.end[b - 1])
                while taken and taken[0][1] <= start:
                    taken.pop(0)
                if current.new[a:b].any() and not (taken and taken[0][0] < end):
                    more.append((kind, start, end))
        added += more
    return plain, added


def pii_spans(text_col: str | Column = "text") -> Column:
    """``array<struct<kind, start, end, plain>>`` of the whole text, by start and then kind.
    Null and empty texts have none."""

    @F.pandas_udf("array<struct<kind:string,start:bigint,end:bigint,plain:boolean>>")
    def find(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            plain, added = find_spans(text)
            rows = [(*s, True) for s in plain] + [(*s, False) for s in added]
            rows.sort(key=lambda r: (r[1], KINDS.index(r[0]), r[2]))
            out.append([dict(zip(("kind", "start", "end", "plain"), r)) for r in rows])
        return pd.Series(out, dtype=object)

    return find(text_of(text_col))
