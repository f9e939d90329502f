import hashlib
import random
import re

import numpy as np
import pandas as pd
from llm_rows import edge_docs, no_docs, prose

from wardflow.llm import pii

# The base patterns as plain regular expressions.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def luhn(digits):
    total = sum(int(c) for c in digits[::-2])
    return (total + sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])) % 10 == 0


def brute(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [(m.start(), 0, m.end()) for m in re.finditer(EMAIL, text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(IP, text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in re.finditer(CARD, text) if 12 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [(m.start(), 3, m.end()) for m in re.finditer(PHONE, text) if 9 <= len(digits(m)) <= 15]
    return [(pii.BASE_KINDS[k], s, e) for s, k, e in sorted(out)]


def test_base_spans_equal_plain_patterns():
    rnd = random.Random(1)
    bits = ["4111 1111 1111 1111", "4111-1111-1111-1112", "1.2.3.4", "300.1.1.1", "1.2.3.4.5.6.7.8", "a.b@c.d", "@", "x@y", "a@b.c@d.e",
            "+1 (017) 555-7713", "+", "+12", "+49 30 1234567890123", "12", "..", " ", "-", "é", "9", "00001.2.3.4", "a@b..c", "(", ")",
            "+1 2\n3", "５", "x@-.-", "123456789012345678901234567890"]
    for _ in range(4000):
        text = "".join(rnd.choice(bits) + rnd.choice(["", " ", ""]) for _ in range(rnd.randint(1, 9)))
        assert pii.base_spans(text) == brute(text), text


def test_long_texts_take_linear_time():
    for text in ("1" * 200_000, "a" * 200_000, "a@" * 50_000, "1." * 100_000, "+1 " * 50_000, "1 " * 100_000, "a" * 100_000 + "@"):
        base = pii.base_spans(text)
        pii.proposals(text, base)


def test_proposals():
    text = ('call (017) 555-7713 or 555-12-3456; iban DE89370400440532013000; token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" '
            "write to joe.b (at) mail (dot) com, Dear Mary Smith, version 999.1.2.3")
    found = {k: text[s:e] for k, s, e in pii.proposals(text, pii.base_spans(text))}
    assert found == {"phone": "(017) 555-7713", "iban": "DE89370400440532013000", "ip": "999.1.2.3", "name": "Mary Smith",
                     "secret": "04dbebab91ab85687d33eeaaf9ac699e1188f962", "email": "joe.b (at) mail (dot) com",
                     **({"ssn": "555-12-3456"} if "ssn" in found else {})}


def test_reliabilities_are_recovered():
    rng = np.random.default_rng(2)
    right = [.95, .9, .75, .7, .65, .6]
    rows = {}
    truth = rng.random(20_000) < .4
    for y in truth:
        votes = "".join(("+" if y else "-") if rng.random() < r else ("-" if y else "+") for r in right)
        key = ("secret", votes)
        n, t = rows.get(key, (0, 0))
        rows[key] = (n + 1, t + int(y))
    counts = pd.DataFrame([(*k, n, t) for k, (n, t) in rows.items()], columns=["kind", "votes", "n", "t"])
    post, table = pii.reliabilities(counts)
    for k, r in enumerate(right):
        assert abs(table[k, 1, 2] - r) < .04 and abs(table[k, 0, 0] - r) < .04
    majority = counts["votes"].map(lambda v: v.count("+") > 3).to_numpy()
    hits = lambda yes: float(np.where(yes, counts["t"], counts["n"] - counts["t"]).sum()) / counts["n"].sum()
    assert hits(post > .5) > hits(majority)


def test_classifier_learns_the_posteriors():
    rng = np.random.default_rng(3)
    bits = rng.integers(0, 1 << pii.N_FEATURES, 400)
    target = np.where(bits >> 3 & 1, .95, .05)
    weights = pii.classifier(bits, target, np.ones(400))
    assert np.argmax(weights[:-1]) == 3
    assert pii.classifier(bits[:1], target[:1], np.ones(1)).shape == (pii.N_FEATURES + 1,)


def docs_with_spans(spark):
    rows = []
    for i in range(120):
        extra = {0: "mail a.b%d@mail.example.com" % i, 1: 'token = "%s%04d"' % ("a1b2c3d4e5f6" * 3, i), 2: "number 4000000000000%03d" % i,
                 3: "phone +1 (017) 555-%04d" % i, 4: "version 999.1.2.%d" % i, 5: ""}[i % 6]
        rows.append((i, prose(i, 20) + " " + extra + " " + prose(i + 500, 5)))
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_detection_keeps_the_base_and_adds(spark):
    docs = docs_with_spans(spark)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in pii.span_digests(pii.detect(docs)).collect():
        base = brute(texts[r["doc_id"]])
        own = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert r["base_sha256"] == hashlib.sha256(own.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.BASE_KINDS] == [sum(b[0] == k for b in base) for k in pii.BASE_KINDS]
        spans = r["spans"].split(",") if r["spans"] else []
        assert set(own.split(",") if own else []) <= set(spans)
        kinds = {s.split(":")[0] for s in spans}
        assert ("secret" in kinds) == (r["doc_id"] % 6 == 1)
        assert spans == sorted(spans, key=lambda s: (int(s.split(":")[1]), pii.KINDS.index(s.split(":")[0])))


def test_redaction(spark):
    docs = docs_with_spans(spark).selectExpr("*", "doc_id as spans", "'x' as _keep")
    out = pii.redacted(docs)
    assert out.columns == docs.columns
    for r in out.collect():
        assert not brute(r["text"]) and r["spans"] == r["doc_id"]
        assert ("<secret>" in r["text"]) == (r["doc_id"] % 6 == 1)


def test_edge_rows(spark):
    docs = edge_docs(spark)
    out = pii.span_digests(pii.detect(docs))
    assert out.count() == docs.count()
    assert {r["spans"] for r in out.collect()} == {""}
    again = {r["doc_id"]: r["text"] for r in pii.redacted(docs).collect()}
    assert again == {r["doc_id"]: r["text"] for r in docs.collect()}
    assert pii.detect(no_docs(spark)).count() == 0 and pii.redacted(no_docs(spark)).count() == 0


def test_a_rare_kind_keeps_its_verdict_when_others_grow():
    """The same spans of one kind beside a thousand times as many of the others."""
    rare = [(0b01, 0.95, 40.0), (0b11, 0.9, 60.0)]
    common = [(0b100, 0.9, 500.0), (0b1000, 0.05, 700.0)]
    for grown in (1, 1000, 100_000):
        patterns = rare + [(b, p, n * grown) for b, p, n in common]
        bits, target, n = (np.array(c) for c in zip(*patterns))
        weights = pii.classifier(bits, target, n)
        for b, p, _ in patterns:
            odds = weights[-1] + sum(weights[k] for k in range(pii.N_FEATURES) if b >> k & 1)
            assert (odds > 0) == (p > 0.5), (grown, b)
