"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, scheme separators, digits and cue
words; two capitals before a digit may begin an IBAN.  From each anchor a small deterministic parser widens to the boundaries of an email
address, network address, card, telephone or account number, login or secret, and validates it.
No parser looks beyond the characters its kind may consist of, so the work is linear and the
spans are those of the kinds' patterns, leftmost and non-overlapping per kind.

Defined results: a null text has no spans; positions are code points, ends exclusive; spans of
different kinds may overlap; repeated rows are alike; other columns are never read.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "login", "account", "secret")  # the order of spans with one start
Span = tuple[int, int, str]

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
NUMERIC = re.compile(r"[0-9.\x20()+-]+")
CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
AUTHORITY = re.compile(r"[^\s/?#\"'<>]*")
BETWEEN = r"[\s:=#._\\\"'()\[\]-]{0,8}"
LINK = re.compile(rf"{BETWEEN}(?:(?:no|nr|num|number|nummer|n[uú]mero|num[eé]ro|is|ist|es|est|[A-Z]{{2}}(?=\)))(?![A-Za-z0-9]){BETWEEN}){{0,3}}", re.I)
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
NUMBER = re.compile(r"[0-9](?:[ -]?[0-9]){5,19}(?![0-9A-Za-z])")
SOCIAL = re.compile(r"[0-9]{3}[- ][0-9]{2}[- ][0-9]{4}(?![0-9])")
ASSIGNED = re.compile(r"(?:(?:\\?[\"'\])]){0,2}\s{0,3}(?:=>|:=|[=:])|\s{1,3}is\b:?)\s{0,3}(?:\\?[\"'])?([A-Za-z0-9_./+~-]{16,})")
IBAN_SIZES = {country: size for size, countries in (
    (15, "NO"), (16, "BE"), (18, "DK FO FI GL NL SD FK"), (19, "MK SI"), (20, "AT BA EE KZ LT LU XK MN"),
    (21, "HR LV LI CH"), (22, "BH BG CR GE DE IE ME RS GB VA"), (23, "GI IL IQ TL AE OM SO"),
    (24, "AD CZ MD PK RO SA SK ES SE TN VG"), (25, "LY PT ST"), (26, "IS TR"), (27, "BI DJ FR GR IT MR MC SM"),
    (28, "AL AZ BY CY DO SV GT HU LB NI PL"), (29, "BR EG PS QA UA"), (30, "JO KW MU YE"), (31, "MT SC"), (32, "LC"),
    (33, "RU")) for country in countries.split()}
ACCOUNT_CUES = ("iban", "account", "acct", "konto", "cuenta", "compte")
SOCIAL_CUES = ("ssn", "social security")
SECRET_CUES = ("token", "password", "passwd", "secret", "api_key", "apikey", "access_key")


@cache
def _anchors() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for digit in "0123456789":
        found.add_word(digit, ("digit", 1))
    found.add_word("@", ("at", 1))
    found.add_word("://", ("scheme", 3))
    for kind, cues in (("account", ACCOUNT_CUES), ("social", SOCIAL_CUES), ("secret", SECRET_CUES)):
        for cue in cues:
            found.add_word(cue, (kind, len(cue)))
    found.make_automaton()
    return found


def passes_luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        value = int(d) * (1 + k % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def passes_iban(text: str) -> bool:
    plain = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def _email(text: str, at: int, floor: int) -> Span | None:
    """The address around an at-sign; ``floor`` is the end of the address before."""
    start = at
    while start > floor and text[start - 1] in LOCAL:
        start -= 1
    found = DOMAIN.match(text, at + 1) if start < at else None
    return (start, found.end(), "email") if found else None


def _numbers(text: str, start: int, end: int) -> list[Span]:
    """Addresses, cards and telephone numbers in a stretch of digits and their separators."""
    out: list[Span] = []
    for chain in CHAIN.finditer(text, start, end):
        groups = chain[0].split(".")
        at = chain.start()
        for k in range(0, len(groups) - 3, 4):
            four = groups[k:k + 4]
            size = sum(map(len, four)) + 3
            if all(len(g.lstrip("0")) <= 3 and int(g) <= 255 for g in four):
                out.append((at, at + size, "ip"))
            at += size + 1
    for card in CARD.finditer(text, start, end):
        digits = card[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and passes_luhn(digits):
            out.append((card.start(), card.end(), "card"))
    for phone in PHONE.finditer(text, start, end):
        if 10 <= sum(c.isdigit() for c in phone[0]) <= 15:
            out.append((phone.start(), phone.end(), "phone"))
    return out


def _login(text: str, end: int) -> Span | None:
    """User and password of an address with a scheme."""
    authority = AUTHORITY.match(text, end)
    cut = authority[0].rfind("@")
    return (end, end + cut, "login") if cut > 0 and ":" in authority[0][:cut] else None


def _iban(text: str, at: int) -> Span | None:
    """An account number of its country's size, proven by its checksum."""
    found = IBAN.match(text, at)
    size = IBAN_SIZES.get(text[at:at + 2])
    if not found or not size or (at and text[at - 1].isalnum()):
        return None
    ends = [m for m in range(at + 1, found.end() + 1) if text[m - 1] != " "]
    if len(ends) < size:
        return None
    stop = ends[size - 1]
    return (at, stop, "account") if not text[stop:stop + 1].isalnum() and passes_iban(text[at:stop]) else None


def _account(text: str, end: int) -> Span | None:
    at = LINK.match(text, end).end()
    found = IBAN.match(text, at)
    if found:
        if whole := _iban(text, at):
            return whole
        # The longest prefix that is an account number; more capitals may follow it.
        cuts = [m for m in range(found.end(), at + 14, -1) if text[m - 1] != " "]
        stop = next((m for m in cuts if passes_iban(text[at:m])), None)
        return (at, stop, "account") if stop else None
    found = NUMBER.match(text, at)
    return (at, found.end(), "account") if found else None


def _social(text: str, end: int) -> Span | None:
    at = LINK.match(text, end).end()
    found = SOCIAL.match(text, at)
    return (at, found.end(), "account") if found else None


def _secret(text: str, end: int) -> Span | None:
    found = ASSIGNED.match(text, end)
    value = found[1] if found else ""
    varied = any(c.isdigit() for c in value) and any(c.isalpha() for c in value)
    return (*found.span(1), "secret") if varied else None


CUED: dict[str, Callable[[str, int], Span | None]] = {
    "scheme": _login, "account": _account, "social": _social, "secret": _secret}


def spans(raw: bytes | None) -> list[Span]:
    """All spans of a text as (start, end, kind), by start and kind."""
    if not raw:
        return []
    text = raw.decode()
    folded = raw.lower().decode()  # only A-Z change, so places stay
    out: set[Span] = set()
    mail_end = number_end = 0
    for last, (kind, size) in _anchors().iter(folded):
        if kind == "digit":
            if last >= number_end:
                start = last - (last > 0 and text[last - 1] == "+")
                number_end = NUMERIC.match(text, start).end()
                out.update(_numbers(text, start, number_end))
                if last > 1 and "A" <= text[last - 1] <= "Z" and (account := _iban(text, last - 2)):
                    out.add(account)
            continue
        found = _email(text, last, mail_end) if kind == "at" else CUED[kind](text, last + 1)
        if found:
            out.add(found)
            mail_end = found[1] if kind == "at" else mail_end
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def find_personal_data(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id and its spans."""
    def run(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column(0),
                "spans": [[{"kind": k, "start": s, "end": e} for s, e, k in spans(raw)]
                          for raw in batch.column(1).cast(pa.binary()).to_pylist()]}

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return map_batches(rows, run, "doc_id long, spans array<struct<kind:string,start:int,end:int>>")
