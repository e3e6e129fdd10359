"""Personal data by weak supervision, in DataFrame and SQL functions only.

1. Candidates: the base shapes (email, ip, card, phone) and looser ones (masked
   emails, local phone numbers, 13 to 15 digit cards, social security numbers, gazetteer
   names). A text is split by a pattern once, and running lengths of gaps and
   matches give the offsets in code points.
2. Labelers vote +1, 0 or -1 on every candidate: strict shape (regex),
   gazetteers, words before it for and against, the character before it, and
   placeholder shapes.
3. Expectation-maximisation over the counts of (kind, votes) estimates each
   labeler's reliability. There are at most 8 kinds x 3^6 vote patterns, whatever the
   corpus, so that table is bounded and is solved on the driver.
4. The posteriors are soft labels of a final span classifier: naive Bayes over
   kind-specific features, whose sums come from one aggregation. Candidates at
   0.5 or more are added; base spans stay whatever their score.

Texts are read once: spans with their votes and features are stored in the
shared folder, one row per document. Defined cases: null and empty texts have
no spans; repeated rows give one result per listing; an empty table gives no
rows.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacekit.llm.common import stored, whole_text

# Kinds in the order in which they are listed.
KINDS = ("email", "ip", "card", "phone", "ssn", "person")
BASE_KINDS = KINDS[:4]

# The base shapes. Written with possessive runs and a start that
# cannot lie inside a run, they match what the plain shapes match, in linear
# time (\G is where the last match ended). A card is tried from 16 digits on,
# since shorter runs are dropped anyway.
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?=[0-9])(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?=[0-9])(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

# Gazetteers and context words.
NAMES = """James Mary Robert Patricia John Jennifer Michael Linda David Elizabeth William Barbara Richard
Susan Joseph Jessica Thomas Sarah Charles Karen Hans Peter Klaus Anna Marie Jean Pierre Carlos Juan Maria""".split()
DOMAINS = "com org net edu gov io de fr es uk eu info biz co us".split()
FOR_WORDS = ("e-?mail|mail|contact|write|reach|phone|call|tel|mobile|cell|fax|whatsapp|ssn|social security|"
             "card|visa|mastercard|amex|credit|account|ip|address|addr|host|name|mr|mrs|ms|dr|signed|regards")
AGAINST_WORDS = "version|release|order|invoice|item|isbn|issn|page|figure|fig|section|chapter|serial|sku|ticket|build|score"

# The looser shapes, each of a listed kind.
MORE = (
    ("email", r"[A-Za-z0-9._%+-]{1,64}\x20?[\[(]\x20?at\x20?[\])]\x20?[A-Za-z0-9-]{1,63}"
              r"(?:\x20?(?:\.|[\[(]\x20?dot\x20?[\])])\x20?[A-Za-z0-9-]{1,63}){1,4}"),
    ("card", r"(?=[0-9])(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,14}+(?![\x20-]?[0-9])"),
    ("phone", r"(?<![0-9A-Za-z+.()-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z-])"),
    ("ssn", r"(?<![0-9A-Za-z.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"),
    ("person", rf"\b(?:{'|'.join(NAMES)})\x20[A-Z][a-z]++"),
)

SPAN = "struct<kind: int, base: boolean, start: bigint, end: bigint, m: string, ctx: string>"
CONTEXT_CHARS = 32
SMOOTHING = 4.0


def located(pattern: str, kind: int, base: bool) -> str:
    """SQL: array of spans of ``pattern`` in the column ``text``.

    Finished spans are moved in chunks, so a text with very many matches costs
    no quadratic copying.
    """
    span = (f"named_struct('kind', {kind}, 'base', {str(base).lower()}, 'start', a.pos + x.gap, "
            "'end', a.pos + x.gap + length(x.m), 'm', x.m, 'ctx', x.ctx)")
    return f"""aggregate(
        zip_with(split(text, r'{pattern}', -1), regexp_extract_all(text, r'{pattern}', 0),
                 (g, m) -> named_struct('gap', length(g), 'ctx', right(g, {CONTEXT_CHARS}), 'm', m)),
        named_struct('pos', 0L, 'done', cast(array() as array<array<{SPAN}>>), 'cur', cast(array() as array<{SPAN}>)),
        (a, x) -> if(x.m is null, a, named_struct(
            'pos', a.pos + x.gap + length(x.m),
            'done', if(size(a.cur) >= 255, array_append(a.done, array_append(a.cur, {span})), a.done),
            'cur', if(size(a.cur) >= 255, cast(array() as array<{SPAN}>), array_append(a.cur, {span})))),
        a -> flatten(array_append(a.done, a.cur)))"""


def when_possible(guard: str, expr: str) -> str:
    return f"if({guard}, {expr}, cast(array() as array<{SPAN}>))"


DIGITS = "regexp_replace(s.m, '[^0-9]', '')"
LUHN = f"""aggregate(sequence(1, length({DIGITS})), 0, (t, i) -> t + if(i % 2 = 1,
    cast(substring(reverse({DIGITS}), i, 1) as int),
    cast(substring('0246813579', 1 + cast(substring(reverse({DIGITS}), i, 1) as int), 1) as int))) % 10 = 0"""
VALID = f"""case
    when s.kind = 0 then true
    when s.kind = 1 then s.m rlike r'^{_OCTET}(?:\\.{_OCTET}){{3}}$'
    when s.kind = 2 then length({DIGITS}) between if(s.base, 16, 13) and if(s.base, 19, 15) and {LUHN}
    when s.kind = 3 then length({DIGITS}) between 8 and 15
    else true end"""

# the labelers: each gives 1, 0 or -1 for a span s
LABELERS = (
    # strict shape
    r"""case s.kind when 0 then if(s.m rlike r'^[A-Za-z0-9][A-Za-z0-9._%+-]*\x20?[@\[(]', 1, -1)
        when 1 then if(s.m rlike r'^(?:0\.|255\.)|\.0\.0$', -1, 1) when 2 then 1
        when 3 then if(s.m rlike r'[01]\d\d[\x20.-]\d{4}$', 0, 1)
        when 4 then if(s.m rlike r'^(?:000|666|9)|-00-|-0000$', -1, 1) else 1 end""",
    # gazetteers: known top-level domains, issuer digits, country codes, given names
    rf"""case s.kind when 0 then if(lower(s.m) rlike r'(?:\.|dot\x20?[\])]\x20?)(?:{'|'.join(DOMAINS)})$', 1, 0)
        when 2 then if(s.m rlike '^[3-6]', 1, 0) when 3 then if(s.m rlike r'^\+[1-9]', 1, 0)
        when 5 then 1 else 0 end""",
    rf"if(lower(s.ctx) rlike r'\b(?:{FOR_WORDS})\b[^A-Za-z0-9]*(?:\w+[^A-Za-z0-9]*)?$', 1, 0)",
    rf"if(lower(s.ctx) rlike r'(?:\b(?:{AGAINST_WORDS})\b|#|\bno\.|\bv)[^A-Za-z0-9]*$', -1, 0)",
    # the character before
    r"if(s.ctx rlike r'[A-Za-z0-9_/=\\.]$', -1, if(s.ctx rlike r'(?:^|[\s(<\[:|,;])$', 1, 0))",
    # placeholders
    r"if(lower(s.m) rlike r'^(?:123[ -]?45[ -]?6789|(\d)(?:\D*\1)+|0\.0\.0\.0|127\.0\.0\.1)$|john\x20doe|jane\x20doe', -1, 0)",
)

FEATURES = (
    "concat('len', least(int(length(s.m) / 4), 15))",
    "concat('strict', v[0])", "concat('gaz', v[1])", "concat('for', v[2])", "concat('against', v[3])",
    "concat('before', v[4])", "concat('placeholder', v[5])",
    f"concat('digits', int(10 * length({DIGITS}) / length(s.m)))",
)


def find_candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans): base spans and looser candidates, with votes and features, one row per document."""
    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    digits = "text rlike '[0-9]'"
    guards = {"email": "contains(text, '@')", "phone": "contains(text, '+')", "ip": digits, "card": digits}
    base = [when_possible(guards[k], located(BASE[k], KINDS.index(k), True)) for k in BASE_KINDS]
    more_guards = {"email": "lower(text) rlike r'[\\[(]\\x20?at\\x20?[\\])]'", "person": "true"}
    more = [when_possible(more_guards.get(k, digits), located(p, KINDS.index(k), False)) for k, p in MORE]
    found = rows.select("doc_id", F.expr(f"filter(concat({', '.join(base)}), s -> {VALID})").alias("base"),
                        F.expr(f"filter(concat({', '.join(more)}), s -> {VALID})").alias("more"))
    # a looser span that touches a base span is that span
    free = "filter(more, s -> not exists(base, b -> b.start < s.end and s.start < b.end))"
    votes = ", ".join(f"cast({x} as int)" for x in LABELERS)
    judged = f"transform(concat(base, {free}), s -> named_struct('s', s, 'v', array({votes})))"
    feats = ", ".join(f"concat(s.kind, ':', {x})" for x in FEATURES)
    slim = (f"transform({judged}, x -> transform(array(x.s), s -> named_struct('kind', s.kind, 'base', s.base, "
            f"'start', s.start, 'end', s.end, 'votes', concat_ws(',', transform(x.v, q -> cast(q as string))), "
            f"'features', transform(array(x.v), v -> array({feats}))[0]))[0])")
    return found.select("doc_id", F.expr(slim).alias("spans"))


def estimate_reliabilities(patterns: list[tuple[int, str, int]], rounds: int = 30) -> dict[str, float]:
    """Dawid-Skene EM over counted vote patterns: P(personal) of each 'kind|votes'.

    ``patterns`` has (kind, votes, count). Votes are independent given the
    truth; each labeler has one table of vote rates for true and false spans.
    """
    rows = [(k, tuple(map(int, v.split(","))), n) for k, v, n in patterns]
    if not rows:
        return {}
    width = len(rows[0][1])
    post = [1 / (1 + math.exp(-1.5 * sum(v))) for _, v, _ in rows]
    for _ in range(rounds):
        prior: dict[int, list[float]] = {}
        rate = [[{x: 1.0 for x in (-1, 0, 1)} for _ in (0, 1)] for _ in range(width)]
        for (k, v, n), p in zip(rows, post, strict=True):
            both = prior.setdefault(k, [1.0, 1.0])
            both[1] += n * p
            both[0] += n * (1 - p)
            for cell, x in zip(rate, v, strict=True):
                cell[1][x] += n * p
                cell[0][x] += n * (1 - p)
        log_rate = [[{x: math.log(c / sum(side.values())) for x, c in side.items()} for side in cell] for cell in rate]
        post = []
        for k, v, _ in rows:
            odds = math.log(prior[k][1] / prior[k][0]) + sum(
                cell[1][x] - cell[0][x] for cell, x in zip(log_rate, v, strict=True))
            post.append(1 / (1 + math.exp(-max(-30.0, min(30.0, odds)))))
    return {f"{k}|{','.join(map(str, v))}": p for (k, v, _), p in zip(rows, post, strict=True)}


def span_classifier(sums: list[tuple[str, float, float]]) -> dict[str, float]:
    """Naive Bayes log odds of each feature from its soft counts (feature, true, false).

    Both classes are smoothed towards the pooled distribution, so a value that a
    class has hardly seen speaks for neither.
    """
    def group(f):
        kind, _, rest = f.partition(":")
        return kind, rest.rstrip("-0123456789")

    totals: dict[tuple, list[float]] = {}
    for f, t, n in sums:
        both = totals.setdefault(group(f), [0.0, 0.0])
        both[0] += t
        both[1] += n
    out = {}
    for f, t, n in sums:
        st, sn = totals[group(f)]
        pool = SMOOTHING * (t + n) / (st + sn)
        out[f] = math.log((t + pool) / (st + SMOOTHING)) - math.log((n + pool) / (sn + SMOOTHING))
    for (kind, name), (st, sn) in totals.items():
        if name == "len":
            out[f"{kind}:prior"] = math.log((st + 1) / (sn + 1))
    return out


def as_map(values: dict[str, float]):
    """A constant map column, parsed once at planning."""
    return f"from_json('{json.dumps(values)}', 'map<string,double>')"


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans array<(kind, base, start, end, score)>) by kind as listed, then start."""
    found = stored(find_candidates(docs, id_col, text_col), "pii-candidates")
    each = found.select(F.explode("spans").alias("s"))
    patterns = each.groupBy("s.kind", "s.votes").agg(F.count(F.lit(1)).alias("n")).collect()
    post = estimate_reliabilities([(r["kind"], r["votes"], r["n"]) for r in sorted(patterns)])
    soft = each.select("s.features", F.expr(f"element_at({as_map(post)}, concat(s.kind, '|', s.votes))").alias("p"))
    sums = (soft.select(F.explode("features").alias("f"), "p").groupBy("f")
            .agg(F.sum("p").alias("t"), F.sum(1 - F.col("p")).alias("n")).collect())
    weights = as_map(span_classifier([(r["f"], r["t"], r["n"]) for r in sorted(sums)]))
    odds = (f"aggregate(s.features, coalesce(element_at({weights}, concat(s.kind, ':prior')), 0d), "
            f"(t, f) -> t + coalesce(element_at({weights}, f), 0d))")
    scored = (f"transform(spans, s -> named_struct('kind', s.kind, 'start', s.start, 'end', s.end, "
              f"'base', s.base, 'score', 1 / (1 + exp(-{odds}))))")
    kept = f"array_sort(filter({scored}, s -> s.base or s.score >= 0.5))"
    names = ", ".join(f"'{k}'" for k in KINDS)
    named = (f"transform({kept}, s -> named_struct('kind', array({names})[s.kind], 'base', s.base, "
             "'start', s.start, 'end', s.end, 'score', s.score))")
    return found.select("doc_id", F.expr(named).alias("spans"))
