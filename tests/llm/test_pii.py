import hashlib
import random
import re

from pacekit.llm.pii import KINDS, estimate_reliabilities, find_candidates, find_personal_data, span_classifier
from pacekit.llm.queries import REGISTRY
from tests.llm.helpers import awkward, clashing, docs


def luhn(d):
    t = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (2 if i % 2 else 1)
        t += x - 9 if x > 9 else x
    return t % 10 == 0


def base_brute(text):
    """The contract read literally: match each plain shape, then drop."""
    out = []
    shapes = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
              r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]
    for k, p in enumerate(shapes):
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m[0])
            if k == 1 and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if k == 2 and not (16 <= len(d) <= 19 and luhn(d)):
                continue
            if k == 3 and not 8 <= len(d) <= 15:
                continue
            out.append((k, m.start(), m.end()))
    return out


CARD = "4539578763621486"
TEXTS = [
    f"é mail a.b+c@x-y.example.com, b@c_d@e.f 1.2.3.4.5 256.1.1.1 {CARD} 4539-5787 6362 1486", "", "@", "+1 (916) 555-6549",
    "a@b.c.@d.e x@y a@b-c.d_x@e.f @@ a@@b.c", "+1" + " " * 300 + "2345678 +++12345678", "1.2.3.4", f"x{CARD}7 {CARD}--12 9 9",
    "001.002.000255.4 12.34.56.78.90.12.34.56", "😀" * 5 + " joe@mail.de 😀 10.0.0.1\n", "+12 34\n56789012",
    "a@b.c" * 300, " ".join(f"u{i}@h{i}.org 10.0.{i % 256}.7" for i in range(900)), "9" * 5000 + " " + "a." * 3000 + "@b.c"]


def spans_of(spark, texts, fn):
    got = fn(docs(spark, list(enumerate(texts)))).collect()
    return {r.doc_id: r.spans for r in got}


def test_base_spans_match_the_contract(spark):
    rng = random.Random(3)
    alphabet = "0123456789..--  +()@ab_%é😀"
    texts = TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 120))) for _ in range(1500)]
    got = spans_of(spark, texts, find_candidates)
    for i, t in enumerate(texts):
        assert [(s.kind, s.start, s.end) for s in got[i] if s.base] == base_brute(t), t


def test_query_digests(spark, tmp_path):
    docs(spark, list(enumerate(TEXTS))).write.parquet(f"{tmp_path}/documents.parquet")
    for r in REGISTRY["op1_personal_data"](spark, str(tmp_path)).collect():
        want = base_brute(TEXTS[r.doc_id])
        text = ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(1 for w in want if w[0] == k) for k in range(4)]


def test_looser_spans_are_added_by_the_classifier(spark):
    texts = ["call (415) 555-2671 today", "write to joe (at) mail (dot) org please", "signed Mary Jones.",
             "version 123-45-6789 of it", "ssn: 219-09-9999", "order 415-555-2671", "plain words only",
             "x=415.555.2671"] + [f"mail u{i}@h.com call +1 415 555 {2000 + i}" for i in range(40)]
    got = spans_of(spark, texts, find_personal_data)
    added = {i: [(s.kind, texts[i][s.start:s.end]) for s in got[i] if not s.base] for i in range(8)}
    assert added[0] == [("phone", "(415) 555-2671")]
    assert added[1] == [("email", "joe (at) mail (dot) org")]
    assert added[2] == [("person", "Mary Jones")]
    assert added[3] == [] and added[6] == [] and added[7] == []
    assert all(len([s for s in got[i] if s.base]) == 2 for i in range(8, 48))


def test_em_finds_reliable_labelers():
    rng = random.Random(1)
    counts = {}
    truth = {}
    for _ in range(4000):
        y = rng.random() < 0.4
        good = [1 if (y if rng.random() < 0.9 else not y) else -1 for _ in range(3)]
        noise = [rng.choice([-1, 1]) for _ in range(2)]
        v = ",".join(map(str, [*good, *noise, 0]))
        counts[v] = counts.get(v, 0) + 1
        truth.setdefault(v, []).append(y)
    post = estimate_reliabilities([(0, v, n) for v, n in counts.items()])
    right = sum(sum(1 for y in truth[v] if y == (post[f"0|{v}"] >= 0.5)) for v in counts)
    assert right / 4000 > 0.95
    assert estimate_reliabilities([]) == {} and span_classifier([]) == {}


def test_awkward_rows(spark):
    df = clashing(awkward(spark))
    got = find_personal_data(df).collect()
    assert len(got) == df.count()
    assert all(r.spans == [] for r in got if r.doc_id in (1, 2, 3))
    assert find_personal_data(docs(spark, [])).count() == 0
