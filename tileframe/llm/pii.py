"""Personal data by anchors: a keyword automaton finds cues, local parsers expand them.

One pass of an Aho-Corasick automaton over a text finds every anchor: at-signs, plus signs, digits, scheme
marks and the cue words of identifiers. At each anchor a deterministic parser walks left and right over the
characters its kind allows and checks the result (numbers of a dotted address, check digits of a card or bank
account). Text without anchors costs nothing more than that pass.

Kinds: ``email``, ``ip``, ``card``, ``phone``, and those this method adds: ``iban`` (bank account with valid check
digits), ``login`` (user and password in front of a host of a URL) and ``secret`` (the value given to a cue such as
``token`` or ``password``). Spans count code points and end before ``end``. Spans of one kind never overlap.

Defined results: a null or empty text has no spans; null keys, repeated rows and other columns are passed by;
texts of any length are read whole; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tileframe.llm.common import text_or_empty

KINDS = ("email", "ip", "card", "phone", "iban", "login", "secret")
BASE_KINDS = KINDS[:4]
CUES = ("token", "secret", "password", "passwd", "api_key", "api key", "apikey", "access_key", "private_key")

_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_DIGITS = frozenset("0123456789")
_LOCAL = frozenset(_LETTERS + "0123456789._%+-")
_LABEL = frozenset(_LETTERS + "0123456789-")
_PHONE = frozenset(" ().0123456789-")
_ALNUM = frozenset(_LETTERS + "0123456789")
_SECRET = frozenset(_LETTERS + "0123456789_-+/=.")
_LOGIN_STOP = frozenset(" \t\r\n\x0b\x0c/?#<>\"'")

Span = tuple[str, int, int]


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for mark in ("@", "+", "://", *_DIGITS):
        found.add_word(mark, mark)
    for cue in CUES:
        for form in {cue, cue.upper(), cue.capitalize()}:
            found.add_word(form, "cue")
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for place, d in enumerate(reversed(digits)):
        n = int(d) * (1 + place % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _while(text: str, at: int, allowed: frozenset) -> int:
    end = len(text)
    while at < end and text[at] in allowed:
        at += 1
    return at


def _back(text: str, at: int, least: int, allowed: frozenset) -> int:
    while at > least and text[at - 1] in allowed:
        at -= 1
    return at


def _email(text: str, at: int, least: int) -> tuple[int, int] | None:
    """Around an at-sign: the local part to the left, two labels or more to the right."""
    start = _back(text, at, least, _LOCAL)
    if start == at:
        return None
    end = _while(text, at + 1, _LABEL)
    labels = int(end > at + 1)
    while labels and text[end : end + 1] == ".":
        more = _while(text, end + 1, _LABEL)
        if more == end + 1:
            break
        end, labels = more, labels + 1
    return (start, end) if labels > 1 else None


def _dotted(text: str, at: int) -> int:
    """End of four numbers joined by dots that start here, or -1."""
    end = _while(text, at, _DIGITS)
    for _ in range(3):
        more = _while(text, end + 1, _DIGITS) if text[end : end + 1] == "." else end + 1
        if more == end + 1:
            return -1
        end = more
    return end


def _number(text: str, at: int) -> int:
    """End of digits that are joined by single spaces or hyphens at most."""
    end = _while(text, at, _DIGITS)
    while text[end : end + 1] in (" ", "-") and text[end + 1 : end + 2] in _DIGITS:
        end = _while(text, end + 1, _DIGITS)
    return end


def _phone(text: str, at: int) -> int:
    """End of the digits and separators after a plus sign, or -1."""
    if text[at + 1 : at + 2] not in _DIGITS:
        return -1
    end = _while(text, at + 2, _PHONE)
    while end > at + 3 and text[end - 1] not in _DIGITS:
        end -= 1
    return end if end > at + 3 else -1


def _iban(text: str, at: int) -> int:
    """End of a bank account whose two check digits start here (after its country), or -1."""
    country = text[at - 2 : at]
    if at < 2 or not (country.isascii() and country.isalpha() and country.isupper()):
        return -1
    if at > 2 and text[at - 3] in _ALNUM:
        return -1
    found, end, here = [], at, at
    while len(found) < 32 and here < len(text):
        if text[here] in _DIGITS or "A" <= text[here] <= "Z":
            found.append(text[here])
            here += 1
            if len(found) >= 13 and (here == len(text) or text[here] not in _ALNUM):
                joined = "".join(found[2:]) + country + "".join(found[:2])
                if joined[-2:].isdigit() and int("".join(str(int(c, 36)) for c in joined)) % 97 == 1:
                    end = here
        elif text[here] == " " and found:
            here += 1
        else:
            break
    return end if end > at else -1


def _login(text: str, at: int) -> tuple[int, int] | None:
    """``user:password`` between a scheme mark that ends here and an at-sign."""
    end = at
    while end < len(text) and text[end] not in _LOGIN_STOP and text[end] != "@":
        end += 1
    if text[end : end + 1] != "@" or not 0 < text[at:end].find(":") < end - at - 1:
        return None
    return at, end


def _secret(text: str, at: int) -> tuple[int, int] | None:
    """The value after a cue that ends here: an equals sign or colon, quotes or none, eight characters or more."""
    here = _while(text, at, frozenset("\"' "))
    if text[here : here + 1] not in (":", "=") or text[here : here + 1] == "":
        return None
    start = _while(text, here + 1, frozenset("\"' "))
    end = _while(text, start, _SECRET)
    value = text[start:end]
    if len(value) < 8 or not any(c in _DIGITS for c in value):
        return None
    return start, end


def find_spans(text: str, anchors: ahocorasick.Automaton) -> list[Span]:
    """All spans, by kind in the order of ``KINDS`` and then by start."""
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    #: Up to where the text is used by a kind's earlier matches, those that failed a check included.
    used = dict.fromkeys(KINDS, 0)
    for at, mark in anchors.iter(text):
        if mark == "@":
            if at >= used["email"] and (span := _email(text, at, used["email"])):
                found["email"].append(span)
                used["email"] = span[1]
        elif mark == "+":
            if at >= used["phone"] and (end := _phone(text, at)) > 0:
                used["phone"] = end
                if 9 <= sum(c in _DIGITS for c in text[at:end]) <= 15:
                    found["phone"].append((at, end))
        elif mark == "://":
            if span := _login(text, at + 1):
                found["login"].append(span)
        elif mark == "cue":
            if at >= used["secret"] and (span := _secret(text, at + 1)):
                found["secret"].append(span)
                used["secret"] = span[1]
        else:
            if at >= used["ip"]:
                used["ip"] = _while(text, at, _DIGITS)
                if (end := _dotted(text, at)) > 0:
                    used["ip"] = end
                    if all(int(part) <= 255 for part in text[at:end].split(".")):
                        found["ip"].append((at, end))
            if at >= used["card"]:
                used["card"] = end = _number(text, at)
                digits = text[at:end].replace(" ", "").replace("-", "")
                if 13 <= len(digits) <= 19 and luhn(digits):
                    found["card"].append((at, end))
            if at >= used["iban"] and (end := _iban(text, at)) > 0:
                found["iban"].append((at - 2, end))
                used["iban"] = end
    return [(k, a, b) for k in KINDS for a, b in found[k]]


def mask(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans become one."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = end
    return "".join(out) + text[at:]


def _digest(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    anchors = automaton()
    for batch in batches:
        out: list[list] = [[] for _ in range(6)]
        for text in batch.column(1):
            spans = find_spans(text.as_py(), anchors)
            base = [s for s in spans if s[0] in BASE_KINDS]
            for values, kind in zip(out, BASE_KINDS, strict=False):
                values.append(sum(s[0] == kind for s in base))
            out[4].append(hashlib.sha256(_digest(base).encode()).hexdigest())
            out[5].append(_digest(spans))
        columns = [batch.column(0), *[pa.array(x, pa.int64()) for x in out[:4]], *[pa.array(x, pa.string()) for x in out[4:]]]
        yield pa.RecordBatch.from_arrays(
            columns, names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
        )


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the key, the numbers of base spans, the digest of the base spans, and all spans."""
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    return rows.mapInArrow(
        _scan,
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string",
    )


def _mask_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    anchors = automaton()
    for batch in batches:
        texts = [None if t is None else mask(t, find_spans(t, anchors)) for t in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), batch.column(1)], names=["_text", "_rest"])


def masked(docs: DataFrame, text: str = "text", length: str | None = None) -> DataFrame:
    """``docs`` with every span masked; a null text stays null. Columns and their order stay; a column named by
    ``length`` gets the new text's length in code points."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text] or [F.lit(0).alias("none")]
    packed = docs.select(F.col(f"`{text}`").cast("string").alias("_text"), F.struct(*rest).alias("_rest"))
    out = packed.mapInArrow(_mask_batches, packed.schema)

    def column(name: str):
        if name == text:
            return F.col("_text").alias(name)
        if name == length:
            return F.length("_text").cast(docs.schema[name].dataType).alias(name)
        return F.col(f"_rest.`{name}`").alias(name)

    return out.select(*[column(c) for c in docs.columns])
