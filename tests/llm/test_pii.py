"""Personal data: base rules against Python's regular expressions, the trees, and redaction."""

import hashlib
import random
import re
from collections import Counter

from llm import pii
from llm.queries import op7_pii

RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(v - 9 * (v > 9) for i, c in enumerate(reversed(digits)) for v in [int(c) * (1 + i % 2)]) % 10 == 0


def brute(text):
    spans = []
    for order, (kind, rule) in enumerate(RULES.items()):
        for m in re.finditer(rule, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            spans.append((m.start(), order, m.end(), kind))
    counts = Counter(s[3] for s in spans)
    listed = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(spans))
    return (*[counts[k] for k in RULES], hashlib.sha256(listed.encode()).hexdigest(), listed)


def texts():
    rng = random.Random(4)
    signs = "0123456789" * 3 + " .-+@()ab\U0001f600é%_4111"
    out = [None, "", "a@b.c_d@e.f x@y..z q@-.-", "1.2.3.4.5.6.7.8 300.1.1.1 01.002.0003.255 1.2.3.99999999999999999999999"]
    out += ["4111 1111 1111 1111 411111111111111", "1 2 " * 3000, "+" * 50 + "1 (234) 567-8901", "a" * 30000, "1" * 30000, "1." * 5000]
    out += ["\U0001f600 me@x.org \U0001f600 +1 (523) 555-1055 4785380592391139", "@" * 200]
    return out + ["".join(rng.choice(signs) for _ in range(rng.randint(5, 200))) for _ in range(600)]


def test_base_rules_equal_python(spark):
    rows = [(i, t, "x") for i, t in enumerate(texts())] + [(None, texts()[2], "y"), (2, texts()[2], None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kind string").repartition(3)
    none = pii.boost([], [])
    got = pii.summary(pii.find(df, none)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r)[1:] == brute(texts()[2 if r.doc_id is None else r.doc_id])
    assert pii.summary(pii.find(df.limit(0), none)).collect() == []


def test_trees_learn_cells_and_the_threshold_holds_the_precision():
    width = len(pii.FEATURES)
    cells = [((1, k, d) + (0,) * (width - 3), 50, 50 if k > 6 and d > 2 else 0) for k in range(10) for d in range(6)]
    model = pii.boost(cells, cells)
    scores = {c[0]: model.start + sum(pii._leaf(t, c[0]) for t in model.trees) for c in cells}
    assert all((scores[f] >= model.threshold) == (right > 0) for f, _, right in cells)
    assert pii.boost([(c[0], c[1], 0) for c in cells], []).trees == ()


def test_secrets_are_added_and_redacted(spark):
    rng = random.Random(6)
    key = lambda n, chars="0123456789abcdef": "".join(rng.choice(chars) for _ in range(n))
    rows = []
    for i in range(300):
        secret = f'token = "{key(36)}"' if i % 3 else f"password={key(18)}"
        plain = f"call {key(7, '0123456789')} {'x' * 20} some_long_name_of_a_thing_here {key(4, 'abc')}-{key(4, '0123456789')}"
        rows.append((i, f"{plain} {secret} me@x.org" if i % 2 else plain))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = pii.find(df, pii.train(df))
    out = {r.doc_id: r for r in pii.summary(found).collect()}
    assert all(("secret" in r.spans) == (i % 2 == 1) and r.n_email == i % 2 for i, r in out.items())
    for r in pii.redact(found).collect():
        want = re.sub(r"(token = \"\w+|password=\w+)", "[SECRET]", rows[r.doc_id][1]).replace("me@x.org", "[EMAIL]")
        assert r.text == want
    assert pii.redact(pii.find(df.selectExpr("doc_id", "cast(null as string) as text").limit(1), pii.boost([], []))).first().text is None


def test_query_is_native(spark):
    plan = op7_pii(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
