"""Personal data: the exact forms by brute force, the bootstrapped patterns against SQL and by cases."""

import random
import re

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from scanledger.llm import pii
from tests.compare import differences
from tests.llm.data import documents, prose, with_clashes


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d // 10 + d % 10
    return total % 10 == 0


def brute(text):
    text = text or ""
    digits = lambda s: re.sub("[^0-9]", "", s)
    forms = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    }
    return [f"{k}:{m.start()}:{m.end()}" for k, (p, ok) in forms.items() for m in re.finditer(p, text) if ok(m.group())]


CASES = [
    None, "", " ", "no data", "a@b.c", "a@b", "a@b.c_d@e.f", "a@b.c..d@e.f", "x a.b+c%d-e@f-g.h-i.j@k.l é@ü.de ü.a@x.y",
    "1.2.3.4.5.6.7.8", "256.1.1.1 0000255.001.1.0 1.2.3", "10.0.0.1234 9.9.9.9.", "4111 1111-1111 1111", "4111  111111111111",
    "4111111111111112 4111111111111111", "0000000000000 00000000000000000000", "12 345-678 9 12 3 4 5 6 7", "+1 (302) 555-9808", "+1 2 3 4 5 6 7 8",
    "+1..........", "++49 30 123456 +49(0)30-123456-", "\U0001f600 é a@b.co 1.1.1.1 \U0001f600+12 345 678 901 4111111111111111",
    "1.2.3.4@x.y 4111111111111111@a.b", "+4111111111111111 (and) +411111111111111", "a@" + "b." * 20_000 + "c", "9" * 2_000, "(" * 100_000 + "1",
    "1 " * 50_000, "a" * 3_000, "a@b.c " * 5_000, "+" + "1(" * 50_000, "1." * 60_000, "@" * 50_000, prose(2, 30_000) + " x@y.zz",
]


def test_base_forms(spark):
    draw = random.Random(7)
    texts = CASES + ["".join(draw.choice("0123456789..--  ()++@@ab%_é\n") for _ in range(draw.randint(1, 200))) for _ in range(600)]
    found = pii.query(with_clashes(documents(spark, list(enumerate(texts))))).collect()
    assert len(found) == len(texts)
    for r in found:
        want = brute(texts[r.doc_id])
        assert r.spans == ",".join(want) or r.n_added, (texts[r.doc_id] or "")[:200]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k) for s in want) for k in ("email", "ip", "card", "phone")]


def test_long_runs_take_linear_time(spark):
    texts = ["9" * 500_000, "a" * 500_000, "a." * 300_000 + "@", "1-" * 300_000 + "+", "0" * 400_000 + ".1.1.1", "@a" * 200_000]
    found = {r.doc_id: r.spans for r in pii.query(documents(spark, list(enumerate(texts)))).collect()}
    assert found == {0: "", 1: "", 2: "", 3: "", 4: "ip:0:400006", 5: ""}


def planted():
    """Phones behind a label, some without the plus; cards with typing errors; order numbers that are neither."""
    draw = random.Random(5)
    word = lambda: draw.choice(["alpha", "beta", "gamma", "delta", "Epsilon", "zeta"])
    digits = lambda n: "".join(draw.choice("0123456789") for _ in range(n))
    rows = []
    for i in range(40):
        number = f"({digits(3)}) {digits(3)}-{digits(4)}"
        rows.append(f"{word()} {word()} call me: {'+1 ' if i % 5 else ''}{number} {word()}")
        rows.append(f"{word()} order no. 9{digits(8)} was {word()}")
        card = next(c for c in (f"4{digits(15)}" for _ in range(999)) if luhn(c) == bool(i % 8))
        rows.append(f"{word()} card number {card} {word()}.")
        rows.append(f"write to {word()}{i}@{'localhost' if i % 10 == 0 else 'mail.example.com'} or {word()}")
        if i % 3 == 0:
            rows.append(f"order no. +49 30 {digits(7)} and contact {digits(9)} then call me: {digits(10)}")
    rows += ["contact 555123456 now", "contact +1 555 123 456 7 now", None, "", "call me: 12345678 call me: 4111 1111 1111 1111"] + rows[:7] * 3
    return [(i % 150 if i % 11 else None, t) for i, t in enumerate(rows)]


def test_patterns_find_unseen_identifiers(spark):
    rows = planted()
    docs = documents(spark, rows)
    by = {}
    for r in pii.find_pii(docs.select(F.col("text").alias("copy"), "text")).collect():
        by[r["copy"]] = [(pii.KINDS[s.kind], r["copy"][s.start : s.stop]) for s in r.pii.added]
    lacking = [t for _, t in rows if t and re.search(r"call me: \(", t)]
    assert lacking and all([k for k, _ in by[t]] == ["phone"] and by[t][0][1].startswith("(") for t in lacking)
    assert all(not by[t] for _, t in rows if t and " order no. 9" in t)
    typed = [t for _, t in rows if t and "card number" in t and not luhn(re.search("[0-9]{16}", t).group())]
    assert typed and all([k for k, _ in by[t]] == ["card"] for t in typed)
    assert all([k for k, _ in by[t]] == ["email"] for _, t in rows if t and "@localhost" in t)


@pytest.mark.parametrize("kind", ["planted", "noise", "empty"])
def test_against_sql(spark, kind):
    draw = random.Random(3)
    if kind == "planted":
        rows = planted()
    elif kind == "noise":
        parts = ["a@b.co", "+1 302 555 98 0", "12345678", "4111111111111111", "1.2.3.4", "999.1.1.1", "id", "No", "x@y", "é", "(12) 3456 789 1", "\n"]
        rows = [(i, " ".join(draw.choice(parts) for _ in range(draw.randint(0, 25)))) for i in range(300)]
    else:
        rows = []
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": pa.array([r[1] for r in rows], pa.string())}))
    assert differences(pii.query(documents(spark, rows)), con, pii.ORACLE) == []
