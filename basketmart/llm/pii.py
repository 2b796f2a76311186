"""Personal data with offsets: plain detectors, and the same detectors behind deobfuscating transducers.

A transducer rewrites a text piece by piece and keeps, for every character it writes, the source span it came from:
homoglyphs and full-width forms become ASCII, zero-width characters vanish, spelled digits become digits, "at" and "dot"
disguises become @ and full stops, spelled and written ones mixed. What is then found is mapped back to source characters. Only finds that touch a rewritten
character and reach beyond the plain finds of their kind are added; the plain ones stay as they are.

All detectors are linear in the text: e-mail addresses are grown from their @, IP addresses from runs of digits and dots.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from basketmart.llm.text import as_bytes, by_batch, read_table, sliced

KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9][0-9.]*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

# Look-alikes of ASCII letters, in the order of the letters they stand for.
HOMOGLYPHS = {
    "а": "a", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "ӏ": "l", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s",
    "ѵ": "v", "ԝ": "w", "х": "x", "у": "y", "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K",
    "М": "M", "О": "O", "Р": "P", "Ѕ": "S", "Т": "T", "Х": "X", "α": "a", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p",
    "υ": "u", "χ": "x", "ω": "w", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N",
    "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "․": ".", "。": ".",
}
HOMOGLYPHS |= {chr(0xFEE0 + c): chr(c) for c in range(0x21, 0x7F)}  # full-width forms
# by Unicode's own tables: decimal digits of any script, mathematical letters
HOMOGLYPHS |= {chr(c): str(unicodedata.decimal(chr(c))) for c in range(0x80, 0x20000) if chr(c).isdecimal()}
HOMOGLYPHS |= {
    chr(c): plain for c in range(0x1D400, 0x1D800) if (plain := unicodedata.normalize("NFKC", chr(c))).isascii() and len(plain) == 1
}
ZERO_WIDTH = "­​‌‍⁠﻿"
# Spelled digits from zero to nine, a line for each language.
SPELLED = [
    "zero one two three four five six seven eight nine",
    "null eins zwei drei vier fünf sechs sieben acht neun",
    "zéro un deux trois quatre cinq six sept huit neuf",
    "cero uno dos tres cuatro cinco seis siete ocho nueve",
]
DIGITS = {word: str(n) for line in SPELLED for n, word in enumerate(line.split())}

_HOMO = frozenset(HOMOGLYPHS) | frozenset(ZERO_WIDTH)


def _any_case(word: str) -> str:
    """Classes rather than re.I, which would try every word at every place."""
    return "".join(f"[{c}{c.upper()}]" for c in word)


_WORD = "|".join(map(_any_case, sorted(DIGITS, key=lambda word: (-len(word), word))))  # "uno" before "un"
_TOKEN = rf"(?:{_WORD}|[0-9]+)"
_DISGUISED = r"[ -]+[dD][oO][tT][ -]+|[ \t]*[\[({<][ \t]*[dD][oO][tT][ \t]*[\])}>][ \t]*"
_SPELLED = re.compile(
    rf"(?<![A-Za-z0-9])(?:[pP][lL][uU][sS][ -]+{_TOKEN}(?:(?:{_DISGUISED}|\.|[ -]+){_TOKEN})*|{_TOKEN}(?:(?:{_DISGUISED}|\.|[ -]+){_TOKEN})+)"
    r"(?![A-Za-z0-9])",
)
_ONE = re.compile(rf"plus|{_WORD}|[0-9]+", re.I)
_BRACKET = re.compile(r"[\[({<][ \t]*(at|dot)[ \t]*[\])}>]", re.I)
_PLAIN = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}(@|[ \t]+at[ \t]+)[A-Za-z0-9-]{1,63}"
    r"(?:(?:[ \t]+dot[ \t]+|\.)[A-Za-z0-9-]{1,63})*(?:[ \t]+dot[ \t]+|\.)[A-Za-z]{2,63}(?![A-Za-z0-9-])",
    re.I,
)
_PLAIN_HINT = re.compile(r"[ \t](?:at|dot)[ \t]", re.I)
_DOT = re.compile(r"[ \t]+dot[ \t]+", re.I)
_LOCAL_DOT = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}([ \t]{1,9}dot[ \t]{1,9})\Z", re.I)

Span = tuple[int, int, int]  # start, kind, end


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def plain_spans(text: str) -> list[Span]:
    """Finds of the plain detectors, leftmost and non-overlapping for each kind; sorted."""
    out: list[Span] = []
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            out.append((start, 0, end))
        else:
            end = at + 1
        at = text.find("@", end)
    if not _DIGIT.search(text):
        return out
    if "." in text:
        for run in _DOTTED.finditer(text):
            parts = run[0].split(".")
            if len(parts) < 4:
                continue
            where, starts = run.start(), []
            for part in parts:
                starts.append(where)
                where += len(part) + 1
            i = 0
            while i + 4 <= len(parts):
                four = parts[i : i + 4]
                if not all(four):
                    i += 1
                    continue
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                    out.append((starts[i], 1, starts[i + 3] + len(four[3])))
                i += 4
    for found in _CARD.finditer(text):
        if found.end() - found.start() >= 12:
            digits = found[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and _luhn(digits):
                out.append((found.start(), 2, found.end()))
    if "+" in text:
        for found in _PHONE.finditer(text):
            if 9 <= sum(c in "0123456789" for c in found[0]) <= 15:
                out.append((found.start(), 3, found.end()))
    out.sort()
    return out


class _Tape:
    """A text being rewritten: ``start[i]`` and ``end[i]`` are the source span of character i, ``new[i]`` if it is new."""

    def __init__(self, text: str):
        self.text = text
        self.start, self.end, self.new = list(range(len(text))), list(range(1, len(text) + 1)), bytearray(len(text))

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace parts [a, b), in order and without overlap, by a string of at most one character."""
        if not edits:
            return
        text, start, end, new, last = [], [], [], bytearray(), 0
        for a, b, by in edits:
            text.append(self.text[last:a])
            start += self.start[last:a]
            end += self.end[last:a]
            new += self.new[last:a]
            if by:
                text.append(by)
                start.append(self.start[a])
                end.append(self.end[b - 1])
                new.append(1)
            elif new:
                new[-1] = 1
            last = b
        text.append(self.text[last:])
        start += self.start[last:]
        end += self.end[last:]
        new += self.new[last:]
        self.text, self.start, self.end, self.new = "".join(text), start, end, new


def _homoglyphs(tape: _Tape) -> None:
    if not tape.text.isascii():
        tape.rewrite([(i, i + 1, HOMOGLYPHS.get(c, "")) for i, c in enumerate(tape.text) if c in _HOMO])


def _spelled_edits(text: str) -> list[tuple[int, int, str]]:
    """Runs of digits with a spelled one or a disguised full stop in them: words become digits, blanks beside them go."""
    edits = []
    for run in _SPELLED.finditer(text):
        last, word = run.start(), False  # of the token before
        for token in _ONE.finditer(text, run.start(), run.end()):
            between, spelled = text[last : token.start()], not token[0].isdigit()
            if "dot" in between.lower():
                edits.append((last, token.start(), "."))
                last = token.start()
            elif between == ".":
                last = token.start()
            if spelled:
                edits.append((last, token.end(), DIGITS.get(token[0].lower(), "+")))
            elif word and last < token.start():
                edits.append((last, token.start(), ""))
            last, word = token.end(), spelled
    return edits


def _at_dot(tape: _Tape) -> None:
    edits, text, last = [], tape.text, 0
    for m in _BRACKET.finditer(text):  # blanks around a bracket belong to it
        start, end = m.span()
        while start > last and text[start - 1] in " \t":
            start -= 1
        while end < len(text) and text[end] in " \t":
            end += 1
        edits.append((start, end, "@" if m[1].lower() == "at" else "."))
        last = end
    tape.rewrite(edits)
    edits, text, last = [], tape.text, 0
    for m in _PLAIN.finditer(text) if _PLAIN_HINT.search(text) else ():
        before, start = [], m.start()
        while d := _LOCAL_DOT.search(text, max(last, start - 85), start):
            before.append((d.start(1), d.end(1), "."))
            start = d.start()
        edits += before[::-1]
        if m[1] != "@":
            edits.append((m.start(1), m.end(1), "@"))
        edits += [(d.start(), d.end(), ".") for d in _DOT.finditer(text, m.end(1), m.end())]
        last = m.end()
    tape.rewrite(edits)


def _suspicious(text: str) -> bool:
    """Whether any transducer rewrites the text; their own patterns decide."""
    if not text.isascii() and not _HOMO.isdisjoint(text):
        return True
    if _BRACKET.search(text) or (_PLAIN_HINT.search(text) and _PLAIN.search(text)):
        return True
    return bool(_spelled_edits(text))


def hidden_spans(text: str, plain: list[Span]) -> list[Span]:
    """Finds behind a disguise, in source characters."""
    if not _suspicious(text):
        return []
    tape = _Tape(text)
    _homoglyphs(tape)
    tape.rewrite(_spelled_edits(tape.text))
    _at_dot(tape)
    if not any(tape.new):
        return []
    out = []
    for a, kind, b in plain_spans(tape.text):
        if any(tape.new[a:b]):
            start, end = tape.start[a], tape.end[b - 1]
            if not any(k == kind and s <= start and end <= e for s, k, e in plain):
                out.append((start, kind, end))
    return out


def _listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def find_pii(docs: DataFrame) -> DataFrame:
    """For each row the counts of plain finds, the hash of their list, and the list of all finds.

    Offsets are code points, ends exclusive. Null and empty texts have no finds. Repeated rows repeat the result.
    """

    def work(columns):
        ids, bodies = columns
        counts, hashes, lists = [[], [], [], []], [], []
        for body in bodies:
            text = body.decode("utf-8", "replace")
            plain = plain_spans(text)
            for kind, column in enumerate(counts):
                column.append(sum(k == kind for _, k, _ in plain))
            hashes.append(hashlib.sha256(_listed(plain).encode()).hexdigest())
            lists.append(_listed(sorted(plain + hidden_spans(text, plain))))
        return [ids, *counts, hashes, lists]

    return by_batch(
        as_bytes(docs),
        work,
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string",
        ["doc_id", "body"],
    )


def redact(text: str) -> str:
    """The text with each find replaced by its kind in angle brackets; overlapping finds are one, named by the first."""
    plain = plain_spans(text)
    spans = sorted(plain + hidden_spans(text, plain))
    out, last = [], 0
    for i, (start, kind, end) in enumerate(spans):
        if start < last:
            if end > last:
                last = end
            continue
        out += [text[last:start], f"<{KINDS[kind].upper()}>"]
        last = end
    return "".join([*out, text[last:]]) if spans else text


def redact_documents(docs: DataFrame, text: str = "text", size: str = "n_chars") -> DataFrame:
    """``docs`` with redacted texts; ``size`` is the new length where the text changed. Null texts stay null."""
    at, n = docs.columns.index(text), docs.columns.index(size) if size in docs.columns else -1

    def work(batches):
        for batch in sliced(batches):
            old = batch.column(at).to_pylist()
            new = [None if t is None else redact(t) for t in old]
            columns = list(batch.columns)
            columns[at] = pa.array(new, batch.schema.field(at).type)
            if n >= 0:
                sizes = [s if a == b else len(b) for s, a, b in zip(columns[n].to_pylist(), old, new)]
                columns[n] = pa.array(sizes, batch.schema.field(n).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(work, docs.schema)


def op8_deobfuscated_pii(spark: SparkSession, folder: str) -> DataFrame:
    return find_pii(read_table(spark, folder, "documents"))
