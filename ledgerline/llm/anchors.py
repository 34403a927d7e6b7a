"""Personal data by anchor expansion.

An Aho-Corasick automaton finds at-signs, plus signs, digits, URL schemes and
identifier cues in one pass over a text; a small deterministic parser expands
around each anchor and validates what it finds. The results for the four base
kinds equal leftmost non-overlapping matching of

    email  [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+
    ip     [0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+), parts at most 255
    card   [0-9]([\\x20-]?[0-9])+, 13 to 19 digits passing Luhn
    phone  \\+[0-9][\\x20().0-9-]+[0-9], 9 to 15 digits

where a match that fails its test is dropped without another try. Beyond these
the cues add ``account`` (an IBAN with valid check digits after its cue),
``secret`` (the value after a password cue, and access key ids) and ``url`` (an address with
a user name in it, or a mailto: / tel: address). Added spans never change base spans.

Each text is read on its own, so there is no shuffle and no skew; time and memory are linear in a text's length,
however often one cue repeats. A null text is empty and has no spans; repeated rows give repeated rows; an empty table
gives none; other columns than the id and the text are not read.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import table

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("account", "secret", "url")

DIGITS = "0123456789"
_ALNUM = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz" + DIGITS
_LOCAL = frozenset(_ALNUM + "._%+-")
_LABEL = frozenset(_ALNUM + "-")
_DIGIT = frozenset(DIGITS)
_PHONE = frozenset(DIGITS + " ().-")
_URL_END = frozenset(" \t\n\r\f\v\"'<>")
_VALUE_END = frozenset(" \t\n\r\f\v\"'<>,;")
_KEY_ID = frozenset(_ALNUM)

SCHEMES = ("http://", "https://", "ftp://", "mailto:", "tel:")
CUES = {"IBAN": "iban", "iban": "iban", "password=": "value", "passwd=": "value", "pwd=": "value", "AKIA": "key"}

Span = tuple[str, int, int]


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for c in DIGITS:
        found.add_word(c, ("digit", 1))
    found.add_word("@", ("at", 1))
    found.add_word("+", ("plus", 1))
    for s in SCHEMES:
        found.add_word(s, ("scheme", len(s)))
    for cue, kind in CUES.items():
        found.add_word(cue, (kind, len(cue)))
    found.make_automaton()
    return found


def run_end(text: str, i: int, allowed: frozenset[str]) -> int:
    n = len(text)
    while i < n and text[i] in allowed:
        i += 1
    return i


def email_at(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """The address around the at-sign, whose local part starts at ``floor`` or later."""
    start = at
    while start > floor and text[start - 1] in _LOCAL:
        start -= 1
    end = run_end(text, at + 1, _LABEL)
    if start == at or end == at + 1:
        return None
    labels = 0
    while end < len(text) and text[end] == ".":
        after = run_end(text, end + 1, _LABEL)
        if after == end + 1:
            break
        end, labels = after, labels + 1
    return (start, end) if labels else None


def ip_at(text: str, start: int) -> tuple[int, bool, int]:
    """(end of the four numbers, whether there are four, end of the first number)."""
    end = first = run_end(text, start, _DIGIT)
    for _ in range(3):
        if end >= len(text) or text[end] != ".":
            return end, False, first
        after = run_end(text, end + 1, _DIGIT)
        if after == end + 1:
            return end, False, first
        end = after
    return end, True, first


def ip_valid(text: str) -> bool:
    parts = [p.lstrip("0") for p in text.split(".")]
    return all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)


def card_end(text: str, i: int) -> int:
    """End of the digits from ``i`` that have at most one space or hyphen between them."""
    end = run_end(text, i, _DIGIT)
    while end + 1 < len(text) and text[end] in " -" and text[end + 1] in _DIGIT:
        end = run_end(text, end + 1, _DIGIT)
    return end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def phone_end(text: str, plus: int) -> int:
    """End of the number that the plus sign starts, or -1."""
    if plus + 1 >= len(text) or text[plus + 1] not in _DIGIT:
        return -1
    end = run_end(text, plus + 2, _PHONE)
    while end > plus + 2 and text[end - 1] not in _DIGIT:
        end -= 1
    return end if end >= plus + 4 else -1


def iban_span(text: str, after: int) -> tuple[int, int] | None:
    """The account number within a few separators after the cue, if its check digits are right."""
    i = after
    while i < len(text) and i < after + 3 and text[i] in " :=#":
        i += 1
    end, chars = i, []
    while end < len(text) and len(chars) < 34:
        if text[end] in _KEY_ID:
            chars.append(text[end])
            end += 1
        elif text[end] == " " and end + 1 < len(text) and text[end + 1] in _KEY_ID and len(chars) % 4 == 0:
            end += 1
        else:
            break
    # words may follow after a space: the longest run of groups with right check digits is the number
    while len(chars) >= 15:
        code = "".join(chars).upper()
        if re.fullmatch("[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", code):
            if int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1:
                return i, end
        cut = text.rfind(" ", i, end)
        if cut < 0:
            return None
        end = cut
        chars = [c for c in text[i:end] if c != " "]
    return None


class UrlRun:
    """A stretch of a text without a character that ends an address. It is looked at once, however many
    schemes it holds: at-signs, ends of authorities and digits are searched by position."""

    def __init__(self, text: str, start: int):
        self.start = self.end = start
        while self.end < len(text) and text[self.end] not in _URL_END:
            self.end += 1
        self.trimmed = self.end
        while self.trimmed > start and text[self.trimmed - 1] in ".,;:!?)":
            self.trimmed -= 1
        self.ats, self.stops, self.digits = ([i for i in range(start, self.end) if text[i] in some] for some in ("@", "/?#", _DIGIT))

    def span(self, scheme: str, after: int) -> tuple[int, int] | None:
        """The address whose scheme ends before ``after``."""
        end = max(after, self.trimmed)
        at = bisect_left(self.ats, after)
        first_at = self.ats[at] if at < len(self.ats) else end
        if scheme == "mailto:":
            found = after < first_at < end
        elif scheme == "tel:":
            found = 7 <= bisect_left(self.digits, end) - bisect_left(self.digits, after) <= 15
        else:
            stop = bisect_left(self.stops, after)
            found = after < first_at < min(end, self.stops[stop] if stop < len(self.stops) else end)
        return (after - len(scheme), end) if found else None


def spans_of(text: str, found: ahocorasick.Automaton) -> list[Span]:
    """All spans of a text, base kinds first, each kind by start (code points, end exclusive)."""
    out: dict[str, list[Span]] = {k: [] for k in (*BASE_KINDS, *ADDED_KINDS)}
    after = dict.fromkeys(out, 0)  # where each kind's next match may start
    run: UrlRun | None = None
    for last, (anchor, length) in found.iter(text):
        i = last - length + 1
        if anchor == "digit":
            if i >= after["card"]:
                end = card_end(text, i)
                after["card"] = end
                if end - i >= 13:
                    digits = text[i:end].replace(" ", "").replace("-", "")
                    if 13 <= len(digits) <= 19 and luhn(digits):
                        out["card"].append(("card", i, end))
            if i >= after["ip"]:
                end, four, first = ip_at(text, i)
                after["ip"] = end if four else first
                if four and ip_valid(text[i:end]):
                    out["ip"].append(("ip", i, end))
        elif anchor == "at":
            if hit := email_at(text, i, after["email"]):
                after["email"] = hit[1]
                out["email"].append(("email", *hit))
        elif anchor == "plus":
            if i >= after["phone"] and (end := phone_end(text, i)) > 0:
                after["phone"] = end
                if 9 <= sum(c in _DIGIT for c in text[i:end]) <= 15:
                    out["phone"].append(("phone", i, end))
        elif anchor == "scheme":
            if i >= after["url"]:
                if run is None or not run.start <= last + 1 <= run.end:
                    run = UrlRun(text, last + 1)
                if hit := run.span(text[i : last + 1], last + 1):
                    after["url"] = hit[1]
                    out["url"].append(("url", *hit))
        elif anchor == "iban":
            if i >= after["account"] and (hit := iban_span(text, last + 1)):
                after["account"] = hit[1]
                out["account"].append(("account", *hit))
        elif anchor == "value":
            if i >= after["secret"]:
                end = last + 1
                while end < len(text) and text[end] not in _VALUE_END:
                    end += 1
                if end > last + 1:
                    after["secret"] = end
                    out["secret"].append(("secret", last + 1, end))
        elif i >= after["secret"] and (i == 0 or text[i - 1] not in _KEY_ID):  # an access key id
            end = run_end(text, i, _KEY_ID)
            if end - i == 20 and text[i:end].isupper():
                after["secret"] = end
                out["secret"].append(("secret", i, end))
    return [s for kind in out for s in out[kind]]


def spans_text(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind; of overlapping spans the
    one that starts first (then the longest) names the whole stretch."""
    if not spans:
        return text
    parts, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            parts += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join(parts) + text[at:]


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base_sha256, spans) for each row."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = automaton()
        for b in batches:
            rows = []
            for text in b.column(1):
                spans = spans_of(text.as_py() or "", found)
                base = [s for s in spans if s[0] in BASE_KINDS]
                kinds = [s[0] for s in base]
                rows.append((*map(kinds.count, BASE_KINDS), hashlib.sha256(spans_text(base).encode()).hexdigest(), spans_text(spans)))
            cols = list(zip(*rows, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, pa.int64()) for c in cols[:4]), *(pa.array(c, pa.string()) for c in cols[4:])],
                names=[id_col, *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans"],
            )

    counts = ", ".join(f"n_{k} long" for k in BASE_KINDS)
    return docs.select(id_col, text_col).mapInArrow(scan, f"`{id_col}` {id_type}, {counts}, base_sha256 string, spans string")


def mask_personal_data(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span of ``text_col`` replaced by ``<kind>``; n_chars
    (if there) follows. A null text stays null; all other columns stay."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = automaton()
        for b in batches:
            k = b.schema.names.index(text_col)
            texts = [None if t is None else masked(t, spans_of(t, found)) for t in b.column(k).to_pylist()]
            yield b.set_column(k, b.schema.field(k), pa.array(texts, b.schema.field(k).type))

    out = docs.mapInArrow(scan, docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length(text_col).cast(docs.schema["n_chars"].dataType))
    return out


def query(spark, sf_dir: str) -> DataFrame:
    return find_personal_data(table(spark, sf_dir, "documents"))
