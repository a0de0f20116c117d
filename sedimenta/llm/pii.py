"""Personal data by anchor expansion.

One Aho-Corasick pass finds anchors: at-signs, schemes, plus signs, digits and identifier cues. A deterministic parser
grows each anchor to its boundaries in both directions and validates the result. Kinds are parsed
apart from each other, each from left to right, and a span begins where the last one of its kind has ended at the earliest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sedimenta.llm.hashing import slices
from sedimenta.llm.memory import giving_back

#: Character classes, cues and the order of kinds. The first four kinds are the base.
_DIGITS = frozenset("0123456789")
_ALNUM = _DIGITS | frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LOCAL = _ALNUM | frozenset("._%+-")
_LABEL = _ALNUM | frozenset("-")
_PHONE = _DIGITS | frozenset(" ().-")
_URL = _ALNUM | frozenset("-._~:/?#[]@!$&'()*+,;=%")
_VALUE = _ALNUM | frozenset("_-")
#: The length of an account number (IBAN) by its country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28,
    "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18,
    "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LI": 21, "LT": 20,
    "LU": 20, "LV": 21, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29,
    "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24,
    "XK": 20}
CUES = ("token", "secret", "password", "api_key", "apikey", "account", "iban")
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "account")
Span = tuple[int, int]


@cache
def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for kind, patterns in {"@": "@", "+": "+", "d": _DIGITS, "s": ["://"]}.items():
        for p in patterns:
            found.add_word(p, (kind, len(p)))
    for cue in CUES:
        for form in (cue, cue.upper(), cue.capitalize()):
            found.add_word(form, ("c", len(form)))
    found.make_automaton()
    return found


def _right(text: str, at: int, allowed: frozenset) -> int:
    while at < len(text) and text[at] in allowed:
        at += 1
    return at


def _left(text: str, at: int, allowed: frozenset, least: int) -> int:
    while at > least and text[at - 1] in allowed:
        at -= 1
    return at


def _email(text: str, at: int, least: int) -> Span | None:
    """Local part to the left, two or more dotted labels to the right."""
    start, end, labels = _left(text, at, _LOCAL, least), at + 1, 0
    while (stop := _right(text, end, _LABEL)) > end:
        labels, last = labels + 1, stop
        if text[stop:stop + 1] != ".":
            break
        end = stop + 1
    return (start, last) if start < at and labels > 1 else None


def _ips(text: str, at: int) -> tuple[list[Span], int]:
    """The dotted digit runs from ``at``, four by four; where they end."""
    runs, end = [], at
    while (stop := _right(text, end, _DIGITS)) > end:
        runs.append((end, stop))
        if text[stop:stop + 1] != ".":
            break
        end = stop + 1
    fours = [runs[i:i + 4] for i in range(0, len(runs) - 3, 4)]
    return [(r[0][0], r[3][1]) for r in fours if all(_octet(text[a:b]) for a, b in r)], runs[-1][1]


def _octet(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) < 4 and int(digits or "0") < 256


def luhn(digits: str) -> bool:
    doubled = sum(int(d) * 2 - 9 * (d > "4") for d in digits[-2::-2])
    return (doubled + sum(map(int, digits[-1::-2]))) % 10 == 0


def _card(text: str, at: int) -> tuple[Span | None, int]:
    """Digits with single blanks or hyphens between them; where they end."""
    end = at + 1
    while True:
        if text[end:end + 1] in _DIGITS and end < len(text):
            end += 1
        elif text[end:end + 1] in (" ", "-") and text[end + 1:end + 2] in _DIGITS and end + 1 < len(text):
            end += 2
        else:
            break
    digits = text[at:end].replace(" ", "").replace("-", "")
    return ((at, end) if 13 <= len(digits) <= 19 and luhn(digits) else None), end


def _phone(text: str, at: int) -> tuple[Span | None, int]:
    """A plus sign, a digit, then the longest run that ends in a digit; where it ends."""
    if text[at + 1:at + 2] not in _DIGITS or at + 1 >= len(text):
        return None, at
    end = _right(text, at + 2, _PHONE)
    while end > at + 3 and text[end - 1] not in _DIGITS:
        end -= 1
    if end <= at + 3 or text[end - 1] not in _DIGITS:
        return None, at
    return ((at, end) if 9 <= sum(c in _DIGITS for c in text[at:end]) <= 15 else None), end


def _url(text: str, at: int, least: int) -> Span | None:
    start = _left(text, at, _ALNUM, least)
    if start == at or text[start] in _DIGITS:
        return None
    end = _right(text, at + 3, _URL)
    while end > at + 3 and text[end - 1] in ".,;:!?)'":
        end -= 1
    return (start, end) if end > at + 3 else None


def _iban(text: str, at: int) -> Span | None:
    """An account number from ``at``, with single blanks inside or none: as long as its country says, 1 modulo 97."""
    length = IBAN_LENGTHS.get(text[at:at + 2].upper(), 0)
    found, end = [], at
    while len(found) < length and end < len(text):
        if text[end] in _ALNUM:
            found.append(text[end].upper())
        elif text[end] != " " or not found or text[end - 1] == " ":
            break
        end += 1
    if not length or len(found) < length or text[end:end + 1] in _ALNUM and end < len(text):
        return None
    turned = "".join(str(int(c, 36)) for c in found[4:] + found[:4])
    return (at, end) if int(turned) % 97 == 1 else None


def _account(text: str, at: int, failed: int) -> tuple[Span | None, int]:
    """The value after a cue, over a sign and a quote: an IBAN, or 12 or more characters of which 4 are digits.

    Also where the last run of characters ends that held no value: what begins inside it holds none either.
    """
    while at < len(text) and text[at] in " \t:=#\"'":
        at += 1
    if span := _iban(text, at):
        return span, failed
    if at < failed:
        return None, failed
    end = _right(text, at, _VALUE)
    if end - at >= 12 and sum(c in _DIGITS for c in text[at:end]) >= 4:
        return (at, end), failed
    return None, end


def find(text: str) -> dict[str, list[Span]]:
    """The spans of each kind in code points, from the left, without overlaps within a kind."""
    out: dict[str, list[Span]] = {k: [] for k in KINDS}
    past, failed = dict.fromkeys(KINDS, 0), 0
    for last, (anchor, width) in _automaton().iter(text):
        at = last - width + 1
        if anchor == "d":
            if at >= past["ip"]:
                spans, past["ip"] = _ips(text, at)
                out["ip"] += spans
            if at >= past["card"]:
                span, past["card"] = _card(text, at)
                out["card"] += [span] if span else []
        elif anchor == "+":
            if at >= past["phone"]:
                span, end = _phone(text, at)
                past["phone"] = max(end, past["phone"])
                out["phone"] += [span] if span else []
        else:
            kind = {"@": "email", "s": "url", "c": "account"}[anchor]
            if at < past[kind]:
                continue
            if anchor == "c":
                span, failed = _account(text, last + 1, failed)
            else:
                span = (_email if anchor == "@" else _url)(text, at, past[kind])
            if span:
                out[kind].append(span)
                past[kind] = span[1]
    return out


def joined(found: dict[str, list[Span]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in kinds for a, b in found[k])


def redact(text: str, found: dict[str, list[Span]]) -> str:
    """The text with every span replaced by its kind; of overlapping spans the first in place, then the longer."""
    out, at = [], 0
    for a, b, kind in sorted(((a, b, k) for k in KINDS for a, b in found[k]), key=lambda s: (s[0], -s[1])):
        if a >= at:
            out += [text[at:a], f"<{kind}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def personal_data(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """``docs`` with n_email, n_ip, n_card, n_phone, base_sha256, spans and redacted.

    Spans are kind:start:end in code points, end exclusive, by kind and then start, joined by commas; base_sha256
    hashes those of the first four kinds. A null text counts as empty and stays null in ``redacted``.
    Every row gives a row; existing columns of these names are replaced.
    """
    new = ["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "redacted"]
    rows = docs.select(*[F.col(f"`{f.name}`") for f in docs.schema if f.name.lower() not in new])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            texts = batch.column(text_col).to_pylist()
            found = [find(t or "") for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array([len(f[k]) for f in found], pa.int64()) for k in BASE),
                 pa.array([hashlib.sha256(joined(f, BASE).encode()).hexdigest() for f in found]),
                 pa.array([joined(f, KINDS) for f in found], pa.string()),
                 pa.array([t and redact(t, f) for t, f in zip(texts, found, strict=True)], pa.string())],
                names=[*batch.schema.names, *new])

    schema = StructType(list(rows.schema))
    for name in new:
        schema = schema.add(name, "long" if name.startswith("n_") else "string")
    return rows.mapInArrow(giving_back(run), schema)
