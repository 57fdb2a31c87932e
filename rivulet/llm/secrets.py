"""Secret scan: fixed patterns plus a guess-cost measure of credential-context values.

Base patterns (``assign``, ``access``, ``hex``) are matched leftmost, non-overlapping, per kind.
The method adds ``guess`` spans: a value in a credential context (``pwd: ...``, ``auth=...``) is
cut into words, dates, repeats, keyboard walks and brute-force spans so that the estimated
number of guesses is least (dynamic programming over its characters, costs in log10 guesses). A
value that still costs ``MIN_GUESSES`` or more is random enough to be a real secret;
placeholders such as ``changeme`` or ``xxxxxxxx`` cost little and are left alone.

The scan is one Arrow pass without a shuffle.  Byte searches rule out almost all texts before a
pattern runs.  The dynamic program keeps only places whose cost is still below the limit.  Every span
costs something, words, walks and dates have bounded length and a repeat's unit has at most
``MAX_UNIT`` characters, so it looks at a bounded stretch of a value, however long the value is;
only repeats are followed further, by comparing slices.

Edge cases: a null text has no spans; ids are never read, repeated rows get equal spans;
positions count code points; further columns pass through; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "guess")
MIN_GUESSES = 10.0  # log10 guesses from which a value counts as random
MAX_UNIT = 16  # characters of a repeat's unit
SPAN_COST = 0.6  # log10 guesses for each further span

# The base patterns (ASCII letters of the keyword in either case).
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
HEX_BYTES = re.compile(rb"[0-9a-f]{24}")

CONTEXT = re.compile(
    r"(?<![a-z])(?:(?:pass(?:word|wd|phrase|code|key)?|pwd|secret|token|credentials?|auth|bearer|pin"
    r"|(?:api|access|private|secret|auth|client)[_\-\x20]?(?:key|token|secret))"
    r"[\"']?[\x20\t]*(?:=>|:=|[:=])[\x20\t]*|bearer[\x20\t]+)(\"[^\"\s]+\"|'[^'\s]+'|[^\s\"'<>]+)", re.I | re.A)
CONTEXT_BYTES = (b"pass", b"pwd", b"secret", b"token", b"credential", b"auth", b"bearer", b"pin", b"key")
BASE_BYTES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

# Frequent passwords and placeholder words, most frequent first.
COMMON = (
    "password admin welcome letmein qwerty monkey dragon master login hello secret test user guest "
    "root default changeme example sample demo dummy placeholder your here insert my the key token "
    "pass pwd api null none true false todo redacted hidden private public value string value love "
    "sunshine princess football baseball shadow superman batman iloveyou trustno access server "
    "database db mysql postgres localhost company summer winter spring autumn blue red green"
).split()
WORD_RANK = {w: i + 1 for i, w in reversed(list(enumerate(COMMON)))}
LONGEST_WORD = max(map(len, COMMON))
LEET = str.maketrans("4@310!5$7", "aaeioisst")
KEY_ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
PLACE = {c: (r, i) for r, row in enumerate(KEY_ROWS) for i, c in enumerate(row)}
DATE = re.compile(r"(?:19|20)\d\d(?:([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01]))?"
                  r"|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d", re.A)
WORDLIKE = re.compile(r"[A-Za-z]?[a-z]{3,15}", re.A)
# Letter runs that words hardly have; the last letter of a match is one too many.
ODD_RUN = re.compile(r"[aeiou]{4}|[^aeiouy]{4}|[jqvz][^aeiouyz]|q[^u]")
# Characters to try per class (small letters, capitals, digits, ASCII signs, others).
ALPHABETS = (26, 26, 10, 33, 100)
SEPARATORS = "_-. ${}"
SEPARATOR_COST = 0.2


def _near(a: str, b: str) -> bool:
    p, q = PLACE.get(a), PLACE.get(b)
    return p is not None and q is not None and a != b and abs(p[0] - q[0]) <= 1 and abs(p[1] - q[1]) <= 1


def _class(c: str) -> int:
    if not c.isascii():
        return 4
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3


#: By set of classes (bits): log10 of the characters to try at each place.
_PER_CHAR = [math.log10(max(1, sum(size for i, size in enumerate(ALPHABETS) if mask >> i & 1))) for mask in range(1 << len(ALPHABETS))]
#: By class: the sets that hold it.
_MASKS = [[mask for mask in range(1 << len(ALPHABETS)) if mask >> i & 1] for i in range(len(ALPHABETS))]


def brute_cost(piece: str) -> float:
    """Guesses for a piece without structure: the alphabet of the classes in use, per character."""
    mask = 0
    for c in piece:
        mask |= 1 << _class(c)
    return len(piece) * _PER_CHAR[mask]


def _equal_run(value: str, a: int, b: int) -> int:
    """Length of the longest common prefix of ``value[a:]`` and ``value[b:]`` (a < b)."""
    most, n, step = len(value) - b, 0, 16
    while n < most:
        step = min(step, most - n)
        if value[a + n:a + n + step] == value[b + n:b + n + step]:
            n, step = n + step, 2 * step
        elif step == 1:
            break
        else:
            step = step // 2
    return n


def spans_from(value: str, at: int, limit: float = math.inf):
    """``(end, cost, kind)`` of the spans other than brute force that start at ``at``; walks are not
    followed once they cost ``limit``."""
    n = len(value)
    for end in range(at + 1, min(n, at + 2) + 1):  # one or two, as in ${name}
        if value[end - 1] not in SEPARATORS:
            break
        yield end, SEPARATOR_COST, "separator"
    piece = value[at:at + LONGEST_WORD]
    low = piece.lower() if piece.isascii() else "".join(c.lower() if c.isascii() else c for c in piece)
    plain = low.translate(LEET)
    for size in range(2, len(piece) + 1):
        rank = WORD_RANK.get(low[:size]) or WORD_RANK.get(plain[:size])
        if rank:
            varied = (piece[:size] != low[:size]) + (low[:size] != plain[:size])
            yield at + size, math.log10(rank + 1) + 0.5 * varied, "word"
    m = WORDLIKE.match(value, at)
    if m:  # looks like a word of some language; longer words are rarer
        odd = ODD_RUN.search(m[0].lower())
        for size in range(4, (odd.end() - 1 if odd else len(m[0])) + 1):
            yield at + size, 3.2 + 0.45 * size, "word"
    m = DATE.match(value, at)
    if m:
        yield m.end(), math.log10(120 if m.end() - at == 4 else 120 * 366), "date"
    end, turns, cost = at + 1, 0, 0.0
    step = None
    while end < n and cost < limit and _near(value[end - 1].lower(), value[end].lower()):
        a, b = PLACE[value[end - 1].lower()], PLACE[value[end].lower()]
        move = (b[0] - a[0], b[1] - a[1])
        turns, step, end = turns + (step is not None and move != step), move, end + 1
        cost = math.log10(len(PLACE) * (end - at)) + 0.6 * turns
        if end - at >= 3 + (turns > 0):
            yield end, cost, "walk"
    for unit in range(1, min(MAX_UNIT, (n - at) // 2) + 1):
        times = 1 + _equal_run(value, at, at + unit) // unit
        if times >= 2 and unit * times >= 3:
            yield at + unit * times, brute_cost(value[at:at + unit]) + math.log10(times), "repeat"


def guess_cost(value: str, limit: float = math.inf) -> tuple[float, list[tuple[int, int, str]]]:
    """Least log10 guesses of a value and a segmentation that attains it; ``(inf, [])`` if it is
    ``limit`` or more.  Places are visited from left to right.  ``closed`` holds the least cost of
    the value up to a place, ``open_brute`` that with a brute-force span still open, by the
    classes that the span may use."""
    n = len(value)
    closed: dict[int, tuple[float, int, str]] = {0: (0.0, 0, "")}
    open_brute: dict[int, dict[int, tuple[float, int]]] = {}
    todo, known = [0], {0}

    def reach(place: int) -> None:
        if place not in known:
            known.add(place)
            heapq.heappush(todo, place)

    while todo:
        at = heapq.heappop(todo)
        running = open_brute.pop(at, {})
        for cost, start in running.values():
            if cost < closed.get(at, (math.inf,))[0]:
                closed[at] = (cost, start, "brute")
        if at == n:
            break
        before = closed[at][0] + SPAN_COST * (at > 0)
        for end, cost, kind in spans_from(value, at, limit - before):
            if before + cost < min(limit, closed.get(end, (math.inf,))[0]):
                closed[end] = (before + cost, at, kind)
                reach(end)
        further = open_brute.setdefault(at + 1, {})
        for mask in _MASKS[_class(value[at])]:
            cost, start = min((before, at), running.get(mask, (math.inf, 0)))
            if cost + _PER_CHAR[mask] < limit:
                further[mask] = (cost + _PER_CHAR[mask], start)
        if further:
            reach(at + 1)
    if n not in closed:
        return math.inf, []
    parts, end = [], n
    while end:
        _, at, kind = closed[end]
        parts.append((at, end, kind))
        end = at
    return closed[n][0], parts[::-1]


def find_spans(raw: bytes | None) -> list[tuple[str, int, int]]:
    """All spans of one UTF-8 text by start, then kind; positions in code points, end exclusive."""
    if not raw:
        return []
    low = raw.lower()
    assign = any(k in low for k in BASE_BYTES)
    context = (b"=" in low or b":" in low or b"bearer" in low) and any(k in low for k in CONTEXT_BYTES)
    access, hexa = b"AKIA" in raw, HEX_BYTES.search(raw) is not None
    if not (assign or context or access or hexa):
        return []
    text, found = raw.decode(), []
    if assign:
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if access:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    if hexa:
        found += [("hex", *m.span()) for m in HEX.finditer(text) if len(m[0]) >= 24]
    if context:
        for m in CONTEXT.finditer(text):
            start, end = m.span(1)
            if text[start] in "\"'" and end - start > 2 and text[end - 1] == text[start]:
                start, end = start + 1, end - 1
            else:
                end = start + len(text[start:end].rstrip(".,;:!?)]}"))
            if end > start and guess_cost(text[start:end], MIN_GUESSES)[0] >= MIN_GUESSES:
                found.append(("guess", start, end))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def span_column(text: Column) -> Column:
    """``array<struct<kind, start, end>>`` of a text column."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def scan(texts: pa.Array) -> pa.Array:
        return pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in find_spans(raw)]
                         for raw in texts.cast(pa.binary()).to_pylist()], type=kind)

    return F.arrow_udf(scan, "array<struct<kind: string, start: bigint, end: bigint>>")(text)


def find_secrets(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` plus ``spans``."""
    return df.withColumn("spans", span_column(F.col(text)))
