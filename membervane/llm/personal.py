"""Personal data in texts, found from anchors: an automaton finds cues, local parsers look around them.

One Aho-Corasick pass over a text gives every at-sign, plus sign, digit, scheme and identifier cue. Each kind has a parser that
starts at its anchors, takes the characters to both sides that can belong to the datum, and checks what it took. Runs of
characters that parsers take do not overlap within a kind, so the work is linear in the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from membervane.llm.common import nullable, slices

#: Kinds in the order of spans that start together; the first four are the base kinds.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "address", "account")
#: Schemes whose targets name a person, a machine or a place, and cues that an identifier follows.
SCHEMES = ("mailto:", "tel:", "sip:", "http://", "https://", "ftp://", "sftp://", "ssh://")
CUES = ("account", "acct", "a/c", "iban", "ssn", "passport", "konto", "cuenta", "compte", "customer no", "member no", "policy no", "tax id")
#: Bounds of a number that follows a cue, counted in digits, and of all its characters.
CUED_DIGITS, CUED_CHARS = 6, 34

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])*")
CALLED = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TARGET = re.compile(r"[A-Za-z0-9._~:/?#\[\]@!$&'()*+,;=%-]+")
HOST = re.compile(r"(?:[^@/?#]*@)?(\[[0-9A-Fa-f:.]+\]|[0-9]{1,3}(?:\.[0-9]{1,3}){3}|[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*)(?::[0-9]+)?(?:[/?#]|$)")
AFTER_CUE = re.compile(r"(?:[\x20]?(?:number|no|nr|num|id|code)\b)?[.:#=\x20-]{0,4}([A-Z]{0,4}[0-9](?:[\x20/-]?[A-Z0-9])*)(?![A-Za-z0-9])")
LETTER = re.compile(r"[^\W_]")


@lru_cache
def automaton(schemes: Sequence[str] = SCHEMES, cues: Sequence[str] = CUES) -> ahocorasick.Automaton:
    """Anchors in lower case, with what they announce and their length."""
    found = ahocorasick.Automaton()
    for anchor in "@+0123456789":
        found.add_word(anchor, (anchor, 1))
    for scheme in schemes:
        found.add_word(scheme, ("scheme", len(scheme)))
    for cue in cues:
        found.add_word(cue, ("cue", len(cue)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    """The checksum of card numbers."""
    values = [int(d) for d in reversed(digits)]
    return (sum(values[::2]) + sum(sum(divmod(2 * d, 10)) for d in values[1::2])) % 10 == 0


def iban(text: str) -> bool:
    """Country, check digits, and the remainder 1 of what they stand before."""
    return bool(re.fullmatch("[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", text)) and int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


def _ip(text: str, start: int) -> tuple[list[tuple[str, int, int]], int]:
    """Fours of a chain of numbers parted by dots, and the end of the chain."""
    chain = DOTTED.match(text, start)
    at, parts, spans = start, chain.group().split("."), []
    for k in range(0, len(parts) - 3, 4):
        four = parts[k : k + 4]
        end = at + sum(map(len, four)) + 3
        if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in four):
            spans.append(("ip", at, end))
        at = end + 1
    return spans, chain.end()


def _address(text: str, start: int, end: int) -> tuple[tuple[str, int, int] | None, int]:
    """A scheme with the target behind it, if that names someone: a mailbox, a number, a login, or a machine by its number. And the end of what was read."""
    target = TARGET.match(text, end)
    if target is None or (start and LETTER.match(text[start - 1])):
        return None, end
    kept = target.group()
    stop, unopened = len(kept), kept.count(")") - kept.count("(")
    while stop and (kept[stop - 1] in ".,;:!?'" or (kept[stop - 1] == ")" and unopened > 0)):
        stop -= 1
        unopened -= kept[stop] == ")"
    kept = kept[:stop]
    scheme = text[start:end].lower()
    if scheme in ("mailto:", "sip:"):
        valid = bool(re.match(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]", kept))
    elif scheme == "tel:":
        valid = 7 <= sum("0" <= c <= "9" for c in kept) <= 15
    else:
        host = HOST.match(kept)
        valid = host is not None and ("@" in kept[: host.end(1)] or host.group(1)[0] == "[" or host.group(1).replace(".", "").isdigit())
    return ("address", start, end + len(kept)) if valid else None, target.end()


def _account(text: str, start: int, end: int) -> tuple[str, int, int] | None:
    """The identifier behind a cue: an account number with a valid checksum, or one with enough digits."""
    if start and LETTER.match(text[start - 1]):
        return None
    found = AFTER_CUE.match(text, end, end + CUED_CHARS + 40)
    if found is None:
        return None
    kept = found.group(1)
    bare = re.sub("[ /-]", "", kept)
    international = re.match("[A-Z]{2}[0-9]{2}", bare) is not None
    if len(bare) > CUED_CHARS or not (iban(bare) if international else sum("0" <= c <= "9" for c in bare) >= CUED_DIGITS):
        return None
    return "account", found.start(1), found.end(1)


def find(text: str) -> list[tuple[str, int, int]]:
    """Spans (kind, start, end) in code points, by start, then kind.

    Base kinds are those of their patterns, leftmost and without overlaps: a run that fails its check is used up. The others are
    targets of schemes that name a person or a machine, and identifiers behind a cue.
    """
    spans: list[tuple[str, int, int]] = []
    mail = ip = card = address = 0  # ends of what was taken
    lower = text.lower()
    if len(lower) != len(text):  # some capitals become two characters
        lower = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
    for last, (anchor, length) in automaton().iter(lower):
        at = last - length + 1
        if anchor == "@":
            start = at
            while start > mail and text[start - 1] in LOCAL:
                start -= 1
            domain = DOMAIN.match(text, at + 1) if start < at else None
            if domain:
                mail = domain.end()
                spans.append(("email", start, mail))
        elif anchor == "+":
            called = CALLED.match(text, at)
            if called and 9 <= sum("0" <= c <= "9" for c in called.group()) <= 15:
                spans.append(("phone", *called.span()))
        elif anchor == "scheme":
            if at >= address:
                found, address = _address(text, at, last + 1)
                spans.append(found)
        elif anchor == "cue":
            spans.append(_account(text, at, last + 1))
        else:
            if at >= ip:
                found, ip = _ip(text, at)
                spans += found
            if at >= card:
                chain = DIGITS.match(text, at)
                card = chain.end()
                digits = re.sub("[ -]", "", chain.group()) if card - at >= 12 else ""
                if 12 <= len(digits) <= 19 and luhn(digits):
                    spans.append(("card", at, card))
    return sorted({s for s in spans if s}, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


SPAN = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def find_spans(docs: DataFrame, text: str = "text", out: str = "spans") -> DataFrame:
    """``docs`` with a column of spans of personal data (kind, start, end), a column of that name replaced.

    Every text is read whole, whatever its length; a null text is an empty one and has no spans. Repeated rows stay, each with its spans.
    """
    kept = docs.drop(out)
    schema = nullable(kept).add(out, SPAN)

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in slices(batches):
            part[out] = [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in find(t)] if isinstance(t, str) else [] for t in part[text]]
            yield part

    return kept.mapInPandas(add, schema)


def as_text(spans, kinds: Sequence[str] | None = None):
    """Spans as ``kind:start:end``, comma-joined; of the given kinds only."""
    if kinds is not None:
        spans = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans, kind: str):
    """Number of spans of a kind."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span of personal data replaced by its kind in angle brackets; spans that overlap become one, named by the first. A null text stays null."""
    names = docs.columns

    def replace(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in slices(batches):
            part[text] = [_redacted(t) if isinstance(t, str) else None for t in part[text]]
            yield part[names]

    return docs.mapInPandas(replace, nullable(docs))


def _redacted(text: str) -> str:
    out, end = [], 0
    for kind, start, stop in find(text):
        if start >= end:
            out += [text[end:start], f"<{kind}>"]
        end = max(end, stop)
    return "".join([*out, text[end:]])
