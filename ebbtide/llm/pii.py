"""Personal data in text, also when disguised, with spans in the source text.

Base spans are the leftmost non-overlapping matches of four patterns. For the
rest, small transducers rewrite the text piece by piece: homoglyph letters and
digits to ASCII, zero-width characters to nothing, spelled digits to digits
(with "double", "plus", and dots between numbers as words or in brackets),
"at" and "dot" disguises to ``@`` and ``.``. Every output character carries the
source span that it came from, so a match in the rewritten text maps back to
source characters. A found span is added where it overlaps no base span and
holds something that was rewritten; base spans always stay.

Spans are in code points, end exclusive. Null and empty texts have no spans.
Columns other than the id and the text are not looked at; repeated rows give
repeated results. Every step is linear in the text, so very long texts (and
very long runs of one character) take time in proportion.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_DIGITS = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_HINT = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        if i % 2:
            x = 2 * x - 9 if x > 4 else 2 * x
        total += x
    return total % 10 == 0


def _emails(text: str) -> list[tuple[str, int, int]]:
    """Each match holds exactly one @: look left and right of each in turn."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append(("email", start, m.end()))
            free = m.end()
        elif start < at:
            free = at + 1  # nothing left of this @ can begin a later match
        at = text.find("@", max(at + 1, free))
    return out


def _ips(text: str) -> list[tuple[str, int, int]]:
    """Runs of digits joined by single dots, four at a time."""
    out, group = [], []
    for m in _DIGITS.finditer(text):
        if group and (m.start() != group[-1][1] + 1 or text[group[-1][1]] != "."):
            group = []
        group.append(m.span())
        if len(group) == 4:
            if all(e - s <= 3 or not text[s : e - 3].strip("0") for s, e in group) and all(int(text[max(s, e - 3) : e]) <= 255 for s, e in group):
                out.append(("ip", group[0][0], group[3][1]))
            group = []
    return out


def _cards(text: str) -> list[tuple[str, int, int]]:
    out = []
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    return out


def _phones(text: str) -> list[tuple[str, int, int]]:
    out = []
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append(("phone", *m.span()))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base matches as (kind, start, end), by start, then kind in the order of KINDS."""
    if not _HINT.search(text):
        return []
    out = []
    if "@" in text:
        out += _emails(text)
    if "." in text:
        out += _ips(text)
    out += _cards(text)
    if "+" in text:
        out += _phones(text)
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


# Letters of other scripts that look like ASCII ones.
HOMOGLYPHS = str.maketrans(
    "аеорсухіјѕһԁԛԝАВЕКМНОРСТУХІЈЅ" "αεικνορτυχΑΒΕΖΗΙΚΜΝΟΡΤΥΧ" "＠．＋－•․。∙",
    "aeopcyxijshdqwABEKMHOPCTYXIJS" "aeikvoptuxABEZHIKMNOPTYX" "@.+-....",
)
#: Characters that show nothing.
HIDDEN = "­​‌‍⁠﻿"
# Digits in the four languages of the corpus.
SPELLED = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}

_GLYPH = re.compile("[" + re.escape("".join(map(chr, HOMOGLYPHS)) + HIDDEN) + "０-９Ａ-Ｚａ-ｚ٠-٩۰-۹\U0001d400-\U0001d7ff]")
_NUMBER = "|".join(sorted(SPELLED, key=len, reverse=True))
# Words for a dot between numbers.
_POINT = "dot|point|punkt|punto"
_GAP = r"(?:[ \t]*[-,][ \t]*|[ \t]+)"
_END = r"(?![^\W_])"
_SPELLED_ONE = rf"(?:double{_GAP})?(?:(?:{_NUMBER}){_END}|[0-9]++)"
_SPELLED_SEP = rf"(?:{_GAP}(?:(?:{_POINT}){_GAP})?|\.)"
#: What begins a run: a number word, or digits before a word of the run; "plus" and "double" before them.
_SPELLED_START = rf"(?<![^\W_])(?:plus{_GAP}(?={_SPELLED_ONE})|double{_GAP}(?=(?:{_NUMBER}){_END}|[0-9])|(?:{_NUMBER}){_SPELLED_SEP}(?={_SPELLED_ONE})|[0-9]++(?:{_GAP}(?:{_POINT}){_GAP}(?={_SPELLED_ONE})|(?:{_GAP}|\.)(?=(?:double{_GAP})?(?:{_NUMBER}){_END})))"
_SPELLED_RUN = re.compile(rf"(?={_SPELLED_START})(?:plus{_GAP})?{_SPELLED_ONE}(?:{_SPELLED_SEP}{_SPELLED_ONE})*{_END}", re.I)
_SPELLED_WORD = re.compile(rf"(?:(?P<twice>double){_GAP})?(?:(?P<word>(?:{_NUMBER}|plus|{_POINT}){_END})|(?P<digits>[0-9]+))", re.I)
_AT = re.compile(r"(?:(?<![ \t])[ \t]+)?(?:\([ \t]*(?:at|@)[ \t]*\)|\[[ \t]*(?:at|@)[ \t]*\]|\{[ \t]*(?:at|@)[ \t]*\}|<[ \t]*at[ \t]*>|_at_)[ \t]*", re.I)
_DOT = re.compile(r"(?:(?<![ \t])[ \t]+)?(?:\([ \t]*(?:dot|\.)[ \t]*\)|\[[ \t]*(?:dot|\.)[ \t]*\]|\{[ \t]*(?:dot|\.)[ \t]*\}|<[ \t]*dot[ \t]*>|_dot_)[ \t]*", re.I)
# Endings that make "name at host dot end" an address when the words stand bare.
ENDINGS = "com|org|net|edu|gov|mil|int|info|biz|name|dev|app|io|co|ai|eu|uk|us|de|fr|es|ch|nl|pl|ru|br|mx|ca|au|jp|cn|kr|example|test"
#: Bare words only where both stand in one address: name at host dot end.
_BARE = re.compile(r"(?<=[A-Za-z0-9])[ \t]+at[ \t]+(?=[A-Za-z0-9-]{1,63}(?:(?:[ \t]+dot[ \t]+|\.)[A-Za-z0-9-]{1,63})*[ \t]+dot[ \t]+(?:" + ENDINGS + r")(?![A-Za-z0-9-]))", re.I)
_BARE_DOT = re.compile(r"(?<=[A-Za-z0-9])[ \t]+dot[ \t]+(?=[A-Za-z0-9])", re.I)
_HINTS = re.compile(_GLYPH.pattern + r"|[(\[{<_][ \t]*(?:at|@|dot|\.)[ \t]*[)\]}>_]|[ \t]dot[ \t]|" + _SPELLED_START, re.I)


class Rewritten:
    """A text in rewriting: its characters and the source span of each."""

    def __init__(self, text: str):
        self.text = text
        self.start: list[int] | range = range(len(text))
        self.end: list[int] | range = range(1, len(text) + 1)
        self.changed: set[int] = set()  # source starts of what was rewritten

    def apply(self, edits: list[tuple[int, int, str]]) -> None:
        """Replaces spans of the present text, given in order, each by a short string."""
        if not edits:
            return
        parts, start, end, at = [], [], [], 0
        for a, b, new in edits:
            parts += [self.text[at:a], new]
            start += self.start[at:a]
            end += self.end[at:a]
            first, last = self.start[a], self.end[b - 1]
            start += [first] * len(new)
            end += [last] * len(new)
            self.changed.add(first)
            at = b
        self.text = "".join([*parts, self.text[at:]])
        self.start = [*start, *self.start[at:]]
        self.end = [*end, *self.end[at:]]


def _glyph(c: str) -> str:
    if c in HIDDEN:
        return ""
    to = c.translate(HOMOGLYPHS)
    if to != c:
        return to
    folded = unicodedata.normalize("NFKC", c)
    if len(folded) == 1 and folded.isascii():
        return folded
    digit = unicodedata.digit(c, None)
    return c if digit is None else str(digit)


def _spelled(m: re.Match) -> list[tuple[int, int, str]]:
    """Edits that join a run of spelled digits into one number; beside digits only the gaps around plus and dots go."""
    edits, at, before = [], m.start(), ""
    for w in _SPELLED_WORD.finditer(m.string, m.start(), m.end()):
        word = (w["word"] or "").lower()
        kind = "point" if word and word not in SPELLED else "word" if word or w["twice"] else "digits"
        joined = "point" in (kind, before) or kind == before == "word"
        start = at if joined and m.string[at : w.start()] != "." else w.start()
        if kind == "digits":
            edits.append((start, w.start(), ""))
        else:
            to = w["digits"] or SPELLED.get(word, "+" if word == "plus" else ".")
            edits.append((start, w.end(), to[0] + to if w["twice"] else to))
        at, before = w.end(), kind
    return [e for e in edits if e[0] < e[1]]


def rewrite(text: str) -> Rewritten | None:
    """The text with its disguises undone, or None where it has none."""
    if not _HINTS.search(text):
        return None
    r = Rewritten(text)
    r.apply([(m.start(), m.end(), to) for m in _GLYPH.finditer(r.text) if (to := _glyph(m.group())) != m.group()])
    r.apply([(m.start(), m.end(), ".") for m in _DOT.finditer(r.text)])  # first: they may stand in a run, or in a bare address
    r.apply([e for m in _SPELLED_RUN.finditer(r.text) for e in _spelled(m)])
    r.apply([(m.start(), m.end(), "@") for m in _BARE.finditer(r.text)])
    r.apply([(m.start(), m.end(), "@") for m in _AT.finditer(r.text)])
    if "@" in r.text:
        near = [m.span() for m in re.finditer(r"@[A-Za-z0-9.-]*(?:[ \t]+dot[ \t]+[A-Za-z0-9-]+)+", r.text, re.I)]
        r.apply([(m.start(), m.end(), ".") for a, b in near for m in _BARE_DOT.finditer(r.text, a, b)])
    return r if r.changed else None


def added_spans(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Spans found in the rewritten text only, as source spans that overlap no base span."""
    r = rewrite(text)
    if r is None:
        return []
    starts, ends = _union(base)
    out, free = [], 0  # matches come by their source start: added ones before end at ``free`` at the latest
    for kind, a, b in base_spans(r.text):
        start, end = r.start[a], r.end[b - 1]
        if not any(r.start[k] in r.changed for k in range(a, b)) and end - start == b - a:
            continue
        near = bisect_right(ends, start)  # the first base span that ends after this one's start
        if start < free or near < len(starts) and starts[near] < end:
            continue
        out.append((kind, start, end))
        free = end
    return out


def _union(spans: list[tuple[str, int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the disjoint ascending spans that these cover together."""
    starts, ends = [], []
    for start, end in sorted((s, e) for _, s, e in spans):
        if ends and start < ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    return starts, ends


def all_spans(text: str | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and base and added spans together, each in the order of base_spans."""
    base = base_spans(text or "")
    added = added_spans(text or "", base)
    both = sorted(base + added, key=lambda s: (s[1], KINDS.index(s[0]), s[2])) if added else base
    return base, both


def mask(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind in brackets; of overlapping spans the union goes once."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = b
    return "".join([*out, text[at:]])


def _listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, base counts, base_sha256, spans and n_added."""

    def run(batches):
        for batch in batches:
            rows: dict[str, list] = {c: [] for c in ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added")}
            for text in batch.column(1).to_pylist():
                base, both = all_spans(text)
                for kind in KINDS:
                    rows[f"n_{kind}"].append(sum(s[0] == kind for s in base))
                rows["base_sha256"].append(hashlib.sha256(_listed(base).encode()).hexdigest())
                rows["spans"].append(_listed(both))
                rows["n_added"].append(len(both) - len(base))
            yield pa.RecordBatch.from_pydict({"doc": batch.column(0)} | {c: pa.array(v, pa.int64() if c[:2] == "n_" else pa.string()) for c, v in rows.items()})

    kind = dict(docs.dtypes)[id_col]
    schema = f"doc {kind}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_added bigint"
    return docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")).mapInArrow(run, schema).withColumnRenamed("doc", id_col)


def masked(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span of the text replaced by its kind; other columns and nulls stay."""

    def run(batches):
        for batch in batches:
            i = batch.schema.get_field_index(text_col)
            texts = [t if t is None else mask(t, all_spans(t)[1]) for t in batch.column(i).to_pylist()]
            yield batch.set_column(i, batch.schema.field(i), pa.array(texts, batch.schema.field(i).type))

    return docs.mapInArrow(run, docs.schema)
