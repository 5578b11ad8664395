"""Personal data against the contract's own patterns in Python."""

import random
import re

import pytest
from pyspark.sql import functions as F

from weblode.llm import op10_pii as op

# The patterns as the contract states them.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def confirmed(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def brute(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if confirmed(k, m[0])]


def base(rows):
    return [[(s["kind"], s["start"], s["end"]) for s in r["pii"] if s["kind"] in op.BASE] for r in rows]


def run(spark, texts):
    df = spark.createDataFrame([(k, t, "c") for k, t in enumerate(texts)], "doc_id long, text string, pii string")
    return op.find_pii(df).orderBy("doc_id").collect()


def test_random_texts(spark):
    rng = random.Random(9)
    parts = ["a", "B", "7", "42", ".", "..", "@", "+", "-", " ", "  ", "_", "%", "x.y", "1.2.3.4", "256.1.1.1", "4111 1111 1111 1111",
             "4111111111111112", "+1 (555) 123-4567", "é", "日", "😀", "a@b.co", "(", ")", "\n", "0"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(1, 14))) for _ in range(600)]
    texts += [None, "", "a@b.cc_d@e.ff", "1.2.3.4.5.6.7.8", "1.2.3 4.5.6.7", "a@b.c@d.e", "0" * 16, "001.0002.3.000255"]
    assert base(run(spark, texts)) == [brute(t) for t in texts]


def test_long_texts(spark):
    texts = ["a" * 60_000, "1" * 60_000, "1 " * 30_000, "+1" + " 2" * 30_000, "1." * 30_000, "x@" * 30_000, "a@b.c " * 300]
    assert base(run(spark, texts)) == [brute(t) for t in texts]


@pytest.mark.parametrize("text,kinds", [
    ("pay to GB82 WEST 1234 5698 7654 32 now", ["iban"]),
    ("pay to GB82 WEST 1234 5698 7654 33 now", []),
    ("DE89370400440532013000", ["iban"]),
    ("my ssn is 123-45-6789", ["ssn"]),
    ("order 123-45-6789", []),
])
def test_added_kinds(spark, text, kinds):
    assert [s["kind"] for s in run(spark, [text])[0]["pii"] if s["kind"] in op.ADDED] == kinds


def test_context_raises_the_score(spark):
    one, two = run(spark, ["tel +1 (555) 123-4567", "sum +1 (555) 123-4567"])
    assert one["pii"][0]["score"] > two["pii"][0]["score"]


def test_empty(spark):
    assert op.find_pii(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def numbers(n):
    """Card-like numbers, some of them right, and where they and their context lie."""
    return " ".join(f"card {4111111111111111 + 10 * k}" if k % 3 else f"x {4111111111111111 + k}" for k in range(n))


@pytest.mark.parametrize("n", [op.GROUP - 1, op.GROUP, op.GROUP + 1, 5 * op.GROUP + 7])
def test_groups_of_matches_against_brute_force(spark, n):
    text = numbers(n)
    found = {}
    for m in re.finditer(op.CARD, text):
        digits = [int(c) for c in reversed(m.group())]
        if sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(digits)) % 10 == 0:
            near = text[max(0, m.start() - op.CONTEXT) : m.start()]
            gain = op.CONTEXT_GAIN if re.search(op.CONTEXT_WORDS["card"], near) else 0
            found[m.start()] = (m.end(), m.group(), round(op.SCORES["card"] + gain, 2))
    df = spark.createDataFrame([(text,)], "text string")
    got = {p["start"]: (p["end"], p["value"], p["score"]) for p in op.find_pii(df).first()["pii"] if p["kind"] == "card"}
    assert got == found and found


def test_time_grows_with_the_matches_and_not_with_their_square(spark):
    import time

    seconds = []
    for n in (10_000, 40_000):
        df = spark.createDataFrame([(numbers(n),)], "text string")
        op.find_pii(df).select(F.size("pii")).collect()
        begin = time.perf_counter()
        assert op.find_pii(df).select(F.size("pii")).first()[0] > n // 20
        seconds.append(time.perf_counter() - begin)
    assert seconds[1] < 4 * seconds[0] + 4, seconds
