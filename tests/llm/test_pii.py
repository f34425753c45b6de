import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from footfall.llm import pii

# The patterns as the contract gives them.
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def right(kind, match):
    digits = re.sub("[^0-9]", "", match)
    return (kind == "email" or kind == "ip" and all(int(p) <= 255 for p in match.split("."))
            or kind == "card" and 13 <= len(digits) <= 19 and luhn(digits) or kind == "phone" and 9 <= len(digits) <= 15)


def base_spans(text):
    return [(k, m.start(), m.end()) for k, pattern in BASE.items() for m in re.finditer(pattern, text or "")
            if right(k, m[0])]


def check(rows, texts):
    assert len(rows) == len(texts)
    for r in rows:
        spans = [tuple(s.split(":")) for s in r.spans.split(",")] if r.spans else []
        wanted = base_spans(texts[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in wanted)
        assert ",".join(":".join(s) for s in spans if s[0] in BASE) == joined
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in BASE] == [sum(s[0] == k for s in wanted) for k in BASE]


def test_documents(documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    rows = pii.personal_data(documents).collect()
    check(rows, texts)
    assert sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in rows) > 10


@pytest.mark.parametrize("seed", range(4))
def test_random_texts(spark, seed):
    rng = random.Random(seed)
    letters = [list("ab@.-_ %+"), list("0123456789.. "), list("01248 -4"), list("+0123 ().-a")][seed] + ["é😀"]
    texts = {i: "".join(rng.choice(letters) for _ in range(rng.choice([5, 30, 200]))) for i in range(400)}
    if seed == 2:
        texts |= {400 + i: f"x{rng.choice(['', ' ', '-'])}4111 1111 1111 1111{rng.choice(['', ' 5', '-', 'z'])}" for i in range(9)}
    check(pii.personal_data(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect(), texts)


def test_added_kinds_and_context(spark):
    texts = {1: "konto GB82 WEST 1234 5698 7654 32 ok", 2: "GB83 WEST 1234 5698 7654 32", 3: "id 123-45-6789 only",
             4: "my SSN: 123-45-6789", 5: "ssn 000-45-6789", 6: "a DE89370400440532013000."}
    rows = {r.doc_id: r for r in pii.personal_data(
        spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    added = {i: [s for s in r.spans.split(",") if s.startswith(("iban", "ssn"))] for i, r in rows.items()}
    assert added == {1: ["iban:6:33"], 2: [], 3: [], 4: ["ssn:8:19"], 5: [], 6: ["iban:2:24"]}
    assert rows[1].scores[-1] == 1.0 and rows[6].scores[-1] == 0.8 and rows[4].scores == [pytest.approx(0.7)]


def test_long_runs_do_not_break_the_matcher(spark):
    texts = {1: "1" * 3_000, 2: "a" * 3_000 + "@b.c", 3: "1 " * 3_000, 4: "+1" + " " * 3_000, 5: "1." * 3_000}
    check(pii.personal_data(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect(), texts)
    # Too long for the plain patterns: a match whose repeats recursed would end in a stack overflow.
    long = {1: "1" * 300_000, 2: "1 " * 100_000, 3: "AB12" + " ABCD" * 50_000, 4: "a" * 300_000 + "@b.c"}
    rows = pii.personal_data(spark.createDataFrame(list(long.items()), "doc_id long, text string")).collect()
    assert {r.doc_id: r.spans for r in rows} == {1: "", 2: "", 3: "", 4: "email:0:300004"}


def test_odd_rows(odd_docs, no_docs):
    rows = pii.personal_data(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert {(r.spans, r.n_email, r.base_sha256) for r in rows} == {("", 0, hashlib.sha256(b"").hexdigest())}
    assert pii.personal_data(no_docs).count() == 0
    twice = odd_docs.withColumn("text", F.lit("a@b.c x d@e.f"))
    assert {r.spans for r in pii.personal_data(twice).collect()} == {"email:0:5,email:8:13"}


def test_account_numbers_before_words_and_each_other(spark):
    """Of 20, 22 and 24 characters, blank or not, with a word, a word in capitals or another number after them."""
    numbers = ["AT611904300234573201", "AT61 1904 3002 3457 3201", "GB82WEST12345698765432", "GB82 WEST 1234 5698 7654 32",
               "ES9121000418450200051332", "ES91 2100 0418 4502 0005 1332", "SE45 5000 0000 0583 9825 7466",
               "NO93 8601 1117 947", "MT84 MALT 0110 0001 2345 MTLC AST0 01S"]
    after = ["", " Please", " PLEASE", " IS", " A", ".", " DE89 3704 0044 0532 0130 00"]
    texts = {i: f"to {n}{a}" for i, (n, a) in enumerate((n, a) for n in numbers for a in after)}
    rows = pii.personal_data(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    for r in rows:
        number, word = numbers[r.doc_id // len(after)], after[r.doc_id % len(after)]
        end = 3 + len(number)
        wanted = [f"iban:3:{end}"] + ([f"iban:{end + 1}:{end + len(word)}"] if "DE89" in word else [])
        assert [s for s in r.spans.split(",") if s.startswith("iban")] == wanted, texts[r.doc_id]
    others = {1: "ZZ12 ABCD EFGH ES91 2100 0418 4502 0005 1332", 2: "AT62 1904 3002 3457 3201 Please"}
    found = pii.personal_data(spark.createDataFrame(list(others.items()), "doc_id long, text string")).collect()
    assert {r.doc_id: [s for s in r.spans.split(",") if s.startswith("iban")] for r in found} == {1: ["iban:15:44"], 2: []}
