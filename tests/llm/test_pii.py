from __future__ import annotations

import hashlib
import re

from hypothesis import HealthCheck, given, settings, strategies as st

from agora.llm import pii

KINDS = ("email", "ip", "card", "phone")
REGEX = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def brute(text):
    out = []
    for no, kind in enumerate(KINDS):
        for m in re.finditer(REGEX[kind], text):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m[0].split("."))
                    or kind == "card" and 14 <= len(digits) <= 19 and luhn(digits)
                    or kind == "phone" and 10 <= len(digits) <= 15):
                out.append((m.start(), no, m.end()))
    return sorted(out)


TEXTS = [
    "", "mail a.b+c@x-y.example.com, or _d@e.f@g.h and a@b.c_d@e.f", "@@a@b@c.d.", "a@b.c" * 3,
    "1.2.3.4.5.6.7.8 999.1.1.1 0001.02.3.255 1.2.3.256 1.2.3", "ip 10.0.0.1, x10.0.0.1.9",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 4111  1111", "é😀 79927398713 79927398713000 5 6",
    "+1 (415) 555-2671 x +49.30.1234567- +12 +1234567890123456 ++4915112345678",
    "a" * 50_000 + "@x.y", "1" * 30_000 + " " + "1.1" * 5000, "x@y" + ".z" * 20_000,
    "ööö 1.1.1.1" * 300,
]


def check(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.base_spans(df).collect()}
    for i, text in enumerate(texts):
        assert [(s.start, s.no, s.end) for s in got[i]] == brute(text), text[:200]


def test_base_spans(spark):
    check(spark, TEXTS)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="a1@.- +()0é%", max_size=60), min_size=150, max_size=150))
def test_base_spans_random(spark, texts):
    check(spark, texts)


FILLER = [f"Plain words number{i} walk along the quiet river again and again" for i in range(40)]


def corpus():
    # "zorblax" only occurs near the same address, in different contexts; "the" everywhere
    rows = [(i, t) for i, t in enumerate(FILLER)]
    rows += [(100, "Ask the clerk Zorblax at jane.roe@example.org today"),
             (101, "Then the visitor Zorblax wrote jane.roe@example.org again"),
             (102, "Only once: Quizzix near other@example.org here"),
             (103, "Ask the clerk Zorblax at jane.roe@example.org today"),
             (104, None), (None, "call +1 415 555 2671"), (None, None), (105, "")]
    return rows


def test_report(spark):
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in corpus()],
                               "doc_id long, text string, row int, spans string")
    rows = pii.report(df).collect()
    assert len(rows) == len(corpus())
    got = {(r.doc_id, r.base_sha256): r for r in rows}
    for i, text in corpus():
        base = ",".join(f"{KINDS[n]}:{a}:{b}" for a, n, b in brute(text or ""))
        r = got[i, hashlib.sha256(base.encode()).hexdigest()]
        at = (text or "").find("Zorblax")
        terms = [f"term:{at}:{at + 7}"] if at >= 0 else []
        assert r.spans == ",".join(terms + ([base] if base else []))
        assert r.n_term == len(terms)
        assert (r.n_email, r.n_phone) == (base.count("email"), base.count("phone"))
    assert pii.report(df.limit(0)).count() == 0


def test_sanitise(spark):
    df = spark.createDataFrame([(i, t, 1) for i, t in corpus()],
                               "doc_id long, text string, whole int")
    out = pii.sanitise(df)
    assert out.columns == df.columns
    got = out.collect()
    assert len(got) == len(corpus())
    by_id = {r.doc_id: r.text for r in got if r.doc_id is not None}
    assert by_id[100] == by_id[103] == "Ask the clerk  at [EMAIL] today"
    assert by_id[102] == "Only once: Quizzix near [EMAIL] here"
    assert by_id[104] is None and by_id[105] == ""
    assert sorted(str(r.text) for r in got if r.doc_id is None) == ["None", "call [PHONE]"]
    assert all(by_id[i] == t for i, t in enumerate(FILLER))


def brute_terms(docs, window=64, min_contexts=2, at=0.8):
    """Term spans by the definition: {(doc index): {(start, end): disclosure}}."""
    import math
    from collections import Counter, defaultdict

    import regex

    term, edge = regex.compile(pii.TERM), r"[^\x20\x09-\x0D]+"
    total, contexts, near, places = Counter(), defaultdict(set), Counter(), defaultdict(list)
    for text in docs:
        total.update(w.lower() for w in term.findall(text))
    for d, text in enumerate(docs):
        spans = brute(text)
        for a, no, b in spans:
            left, right = text[max(0, a - window):a], text[b:b + window]
            if a > window:
                left = re.sub("^" + edge, "", left)
            if len(text) - b > window:
                right = re.sub(edge + "$", "", right)
            value = text[a:b] if no == 0 else re.sub("[^0-9]", "", text[a:b])
            for side, shift in ((left, a - len(left)), (right, b)):
                for m in term.finditer(side):
                    x, y = m.start() + shift, m.end() + shift
                    if not any(p < y and q > x for p, _, q in spans):
                        key = (no, value.lower(), m[0].lower())
                        near[key] += 1
                        contexts[key].add((left, right))
                        places[d].append((x, y, key))
    words, entities = sum(total.values()), Counter()
    for (no, entity, _), n in near.items():
        entities[no, entity] += n
    found = {}
    for key, n in near.items():
        e = entities[key[:2]]
        ic = -math.log2(e / words)
        if len(contexts[key]) >= min_contexts and ic > 0:
            score = math.log2(n / e / (total[key[2]] / words)) / ic
            if score >= at:
                found[key] = score
    return {d: {(x, y) for x, y, key in some if key in found} for d, some in places.items()}


def test_disclosure_by_brute_force(spark):
    import random

    rng = random.Random(6)
    common = [f"word{i}" for i in range(30)] + ["İstanbul", "ẞtraße", "ÀÉ"]
    people = [f"p{i}@ex{i % 7}.org" for i in range(12)] + ["+1 415 555 2671", "10.0.0.1", "4111111111111111"]
    own = {p: [f"Secret{i}", f"code{i % 5}", "İzmir" if i == 3 else f"alias{i}"]
           for i, p in enumerate(people)}
    docs = []
    for _ in range(120):
        words = rng.choices(common, k=rng.randint(0, 25))
        for p in rng.choices(people, k=rng.randint(0, 2)):
            at = rng.randint(0, len(words))
            words[at:at] = [rng.choice(own[p]), p, rng.choice(own[p] + common)]
        docs.append(rng.choice([" ", "  ", ", "]).join(words))
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    want = brute_terms(docs)
    got = {r.doc_id: {(t.start, t.end) for t in r.terms} for r in pii.spans(df).collect()}
    assert all(got[d] == want.get(d, set()) for d in range(len(docs)))
    assert sum(map(len, got.values())) > 40
    assert any("İzmir" == docs[d][a:b] for d, some in got.items() for a, b in some)


def test_twenty_thousand_spans_in_one_text(spark):
    import time

    text = " ".join(f"user{i % 500} mail{i}@a{i % 90}.org," for i in range(20_000))
    df = spark.createDataFrame([(1, text, 0), (2, "plain", 0)], "doc_id long, text string, `a.b` int")
    started = time.time()
    assert {r.doc_id: r.n_email for r in pii.report(df).collect()} == {1: 20_000, 2: 0}
    clean = pii.sanitise(df)
    assert clean.columns == ["doc_id", "text", "a.b"]
    by_id = {r.doc_id: r.text for r in clean.collect()}
    assert by_id[1].count("[EMAIL]") == 20_000 and "@" not in by_id[1] and by_id[2] == "plain"
    assert time.time() - started < 180
