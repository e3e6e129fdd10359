"""Secrets in whole texts: fixed shapes, and values in credential context by their guess cost.

The guess cost of a value is a minimum-cost segmentation found by dynamic
programming over its characters: dictionary words (capitals and look-alike
signs cost extra), dates, repeated characters, keyboard and alphabet walks, and
brute-force spans. Costs are log10 of guesses and add up; each segment adds the
cost of choosing its kind. A value after a credential word and ``:`` or ``=``
whose cost reaches ``THRESHOLD`` is added as a span of kind ``guess``; values
that people would guess (``changeme``, ``password123``, ``qwerty2024``) are not.
Spans already covered by a base span are not added again, but base ``assign``
spans carry their value's cost too.

Each text is read once; the dynamic program runs on context values only and
is linear in their length. Defined cases: null and empty texts give no spans;
repeated rows give one result per listing; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacekit.llm.common import whole_text

# The base shapes, in the order in which kinds are listed.
KINDS = ("assign", "access", "hex", "guess")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
LEAST = {"assign": 12, "access": 18, "hex": 16}
BASE_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")

# Credential words of the context labeler and the values it reads.
CONTEXT_WORDS = (*BASE_WORDS, "pwd", "passphrase", "credential", "auth", "private_key", "access_key", "bearer")
CONTEXT = re.compile(
    r"""(?:password|passwd|pwd|passphrase|secret|token|api_?key|credentials?|auth|private_key|access_key|bearer)"""
    r"""["']?[\x20\t]*[:=]{1,2}[\x20\t]*(?:"([^"\r\n]{6,})"|'([^'\r\n]{6,})'|([^\s"'`,;<>|]{6,}))""", re.I | re.A)
THRESHOLD = 10.0

# Frequent passwords and words, most frequent first (the rank is the cost).
WORDS = """password admin welcome letmein monkey dragon master login princess sunshine football iloveyou
shadow baseball superman secret hello freedom whatever trustno ninja jordan hunter killer pepper
test guest root user changeme default example sample demo placeholder none null undefined true false
your my the this that pass word key token value string string here enter insert replace todo fixme
summer winter spring autumn monday tuesday wednesday thursday friday saturday sunday january february
march april may june july august september october november december love money secure private public
server client system access account service database cache session cookie header basic bearer auth
local host development production staging internal external company office computer internet michael
jennifer thomas robert daniel andrew charlie george maggie ginger buster tigger soccer hockey killer
batman starwars matrix cheese coffee orange banana purple yellow silver golden flower butterfly angel
london paris berlin madrid chelsea arsenal liverpool barcelona mustang ferrari porsche harley""".split()
LOOK_ALIKE = str.maketrans("@4301!5$7", "aaeoiisst")
WALKS = ("qwertyuiop", "asdfghjkl", "zxcvbnm", "1234567890", "abcdefghijklmnopqrstuvwxyz", "qazwsxedcrfvtgbyhnujm")
DATE = re.compile(r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])"
                  r"|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d|(?:19|20)\d\d", re.A)

RANK = {}
for _n, _w in enumerate(WORDS):
    RANK.setdefault(_w, math.log10(_n + 2))
LONGEST = max(map(len, RANK))
SHORTEST = min(map(len, RANK))
SEGMENT = 0.5                                   # log10 cost of the choice of a segment's kind
TWO = math.log10(2)


def char_cost(c: str) -> float:
    """log10 of the alphabet a brute-force guesser needs for this character."""
    if c.isascii():
        return 1.0 if c.isdigit() else 1.415 if c.isalpha() else 1.52
    return 2.0


def segments(value: str):
    """(start, end, log10 guesses) of every segment that is not brute force."""
    low = value.lower() if value.isascii() else "".join(c.lower() if len(c.lower()) == 1 else c for c in value)
    plain = low.translate(LOOK_ALIKE)
    n = len(value)
    for a in range(n):
        for b in range(a + SHORTEST, min(n, a + LONGEST) + 1):
            cost = RANK.get(plain[a:b])
            if cost is not None:
                swaps = sum(1 for x, y in zip(low[a:b], plain[a:b], strict=True) if x != y)
                upper = sum(1 for x in value[a:b] if x.isupper())
                yield a, b, cost + TWO * (swaps + (1 if upper in (1, b - a) else upper))
    for m in DATE.finditer(value):
        yield m.start(), m.end(), 2.1 if m.end() - m.start() == 4 else 4.6
    a = 0
    while a < n:                                 # maximal repeats
        b = a + 1
        while b < n and value[b] == value[a]:
            b += 1
        if b - a >= 3:
            yield a, b, char_cost(value[a]) + math.log10(b - a)
        a = b
    a = 0
    while a < n - 1:                             # maximal walks along a row, one direction
        b, way = a + 1, None
        while b < n:
            step = [(w, d) for w, row in enumerate(WALKS) for d in (1, -1) if low[b - 1] + low[b] in row[::d]]
            way = set(step) if way is None else way & set(step)
            if not way:
                break
            b += 1
        if b - a >= 4:
            yield a, b, 1.7 + math.log10(b - a)
            a = b
        else:
            a += 1


def guess_cost(value: str) -> float:
    """log10 of the guesses for ``value``: the cheapest segmentation."""
    n = len(value)
    ends: dict[int, list[tuple[int, float]]] = {}
    for a, b, cost in segments(value):
        ends.setdefault(b, []).append((a, cost))
    done, brute = [0.0] * (n + 1), [SEGMENT] * (n + 1)   # best up to i; best with a brute-force span open at i
    for i in range(1, n + 1):
        brute[i] = min(brute[i - 1], done[i - 1] + SEGMENT) + char_cost(value[i - 1])
        done[i] = min([brute[i], *(done[a] + SEGMENT + cost for a, cost in ends.get(i, ()))])
    return done[n]


TO_HEX = bytes(120 if chr(b) in "0123456789abcdef" else 32 for b in range(256))
RUN = b"x" * LEAST["hex"]


def scan(text: str) -> list[dict]:
    """All spans of one text by start, then kind as listed."""
    out = []
    low = text.lower()
    if any(w in low for w in CONTEXT_WORDS):
        covered = []
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= LEAST["assign"]:
                covered.append(m.span())
                out.append((m.start(), 0, m.end(), guess_cost(m.group(2))))
        at = 0                                               # both lists ascend and do not overlap
        for m in CONTEXT.finditer(text):
            a, b = m.span(m.lastindex)
            while at < len(covered) and covered[at][1] <= a:
                at += 1
            if at == len(covered) or covered[at][0] >= b:
                cost = guess_cost(m.group(m.lastindex))
                if cost >= THRESHOLD:
                    out.append((a, 3, b, cost))
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), None) for m in ACCESS.finditer(text)
                if m.end() - m.start() >= LEAST["access"]]
    if RUN in text.encode("utf-8", "surrogatepass").translate(TO_HEX):
        out += [(m.start(), 2, m.end(), None) for m in HEX.finditer(text)]
    out.sort(key=lambda x: x[:3])
    return [{"kind": KINDS[k], "start": s, "end": e, "log10_guesses": c} for s, k, e, c in out]


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                  ("log10_guesses", pa.float64())])


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, secrets array<(kind, start, end, log10_guesses)>), one row per document."""

    def run(batches):
        for batch in batches:
            found = [scan(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, type=pa.list_(SPAN))], names=["doc_id", "secrets"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    return rows.mapInArrow(
        run, "doc_id long, secrets array<struct<kind: string, start: long, end: long, log10_guesses: double>>")


def span_list(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
