"""Personal data against a plain version, long texts, and stages on clashing names and empty tables."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lakeops.llm import pii
from lakeops.llm.native import PAGE, in_chunks, pages_of, part, scan, unused

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def base_spans(text):
    digits = lambda m: re.sub(r"[^0-9]", "", m.group())
    kinds = [
        ("email", EMAIL, lambda m: True),
        ("ip", IP, lambda m: all(int(x) <= 255 for x in m.group().split("."))),
        ("card", CARD, lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", PHONE, lambda m: 9 <= len(digits(m)) <= 15),
    ]
    found = [(m.start(), rank, m.end(), name) for rank, (name, pattern, ok) in enumerate(kinds) for m in pattern.finditer(text) if ok(m)]
    return [(name, start, end) for start, _, end, name in sorted(found)]


def masked(text, spans):
    out, end = [], 0
    for kind, start, stop in spans:
        if start >= end:
            out += [text[end:start], f"[{kind.upper()}]"]
        end = max(end, stop)
    return "".join(out) + text[end:]


def random_texts(draw, n):
    parts = [
        "4111 1111 1111 1111", "4111-1111-1111-1112", "10.0.0.255", "10.0.0.256.1", "1.2.3.4", "+1 (017) 555-7713", "+49", "a.b@c.de",
        "x@y", "@", "+", ".", "-", " ", "é", "😀", "12", "0", "DE89370400440532013000", "token", "card", "ssn 123-45-6789", "\n", "call",
        "sk_live_0123456789abcdefghijklmnopqrstuv", "mail",
    ]
    texts = ["".join(draw.choice(parts) + draw.choice(["", " ", " "]) for _ in range(draw.randrange(0, 60))) for _ in range(n)]
    texts += ["".join(draw.choice("0123456789 -+.@a(") for _ in range(draw.randrange(0, 300))) for _ in range(n)]
    return texts + ["".join(draw.choice(parts) + " " for _ in range(3000))]


def test_base_spans_and_masks_equal_plain_ones(spark):
    texts = random_texts(random.Random(6), 250)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    rows = {r.doc_id: r.found for r in pii.find_personal_data(frame).collect()}
    base = {k.name for k in pii.KINDS if k.base}
    out = {r.doc_id: r.text for r in pii.mask_personal_data(frame).collect()}
    for i, text in enumerate(texts):
        spans = [(s.kind, s.start, s.end) for s in rows[i]]
        assert [s for s in spans if s[0] in base] == base_spans(text)
        assert all(text[s.start : s.end] == s.value for s in rows[i])
        assert out[i] == masked(text, spans)
    assert sum(len(x) for x in rows.values()) > 1000


def test_context_is_the_same_in_long_texts(spark):
    """Scores depend on the words near a span, wherever in the text it stands."""
    short = "my ssn is 123-45-6789 today"
    texts = [short, "x " * 3000 + short, "é " * 5000 + short, short + " y" * 9000, "z" * (4 * PAGE - 10) + " " + short, "w " * 5000 + "no 123-45-6789 word"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: [(s.kind, s.value, s.score) for s in r.found] for r in pii.find_personal_data(frame).collect()}
    assert found[0] and all(found[i] == found[0] for i in range(5)) and found[5] == []


def test_many_spans_in_one_text_take_linear_time(spark):
    took = []
    for n in (5_000, 20_000):
        text = "".join(f"write to user{i}@example.org or " for i in range(n))
        frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
        begin = time.time()
        assert pii.find_personal_data(frame).select(F.size("found")).first()[0] == n
        row = pii.mask_personal_data(frame).first()
        took.append(time.time() - begin)
        assert row.text == "write to [EMAIL] or " * n
    assert took[1] < 8 * took[0] + 2 and took[1] < 60


def test_parts_and_scans(spark):
    text = "".join(chr(97 + i % 26) if i % 7 else "😀" for i in range(5 * PAGE + 13))
    cuts = [(0, 0), (0, 1), (PAGE - 1, PAGE + 1), (PAGE, 2 * PAGE), (5, 4 * PAGE), (5 * PAGE, 5 * PAGE + 13), (len(text), len(text))]
    frame = spark.createDataFrame([(text, a, b) for a, b in cuts], "t string, a long, b long")
    found = frame.select(part(pages_of(F.col("t")), F.col("a"), F.col("b")).alias("p")).collect()
    assert [r.p for r in found] == [text[a:b] for a, b in cuts]
    step = lambda s, x: F.struct((s + x).alias("state"), F.array(s + x).alias("added"))
    sums = spark.range(1).select(
        scan(F.sequence(F.lit(1).cast("long"), F.lit(300).cast("long")), F.lit(0).cast("long"), step, "array<long>").alias("s"),
        F.size(in_chunks(F.array().cast("array<long>"))).alias("n"),
    ).first()
    assert sums.s == [i * (i + 1) // 2 for i in range(1, 301)] and sums.n == 1
    assert unused(["A", "__ID", "__id_"], "__id") == "__id__"


@pytest.mark.parametrize("name", ["quality", "near_duplicates", "decontamination", "personal_data", "tokens"])
def test_stages_take_clashing_names_and_empty_tables(spark, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    body = " ".join(f"word{i}" for i in range(80))
    rows = [(1, body, "a"), (1, body, "a"), (2, body + " more", "b"), (3, None, "c"), (4, "", "d"), (None, "mail a@b.de " + body[::-1], "e")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    clash = ["__id", "__text", "__found", "__place", "id", "words", "root", "n", "spans", "token"]
    frame = frame.withColumn("n_chars", F.char_length("text").cast("long")).withColumns({c: F.lit(f"kept {c}") for c in clash})
    found = stage(spark, frame, "/root/testdata/sf0.001")
    assert stage(spark, frame.where("false"), "/root/testdata/sf0.001").count() == 0
    out = found.collect()
    if name == "tokens":
        assert len(out) == len(rows)
        return
    assert found.columns == frame.columns
    assert all(r[c] == f"kept {c}" for r in out for c in clash)
    ids = sorted((r.doc_id or 0) for r in out)
    expected = {"quality": [0, 1, 1, 2], "near_duplicates": [0, 1, 3, 4], "decontamination": [0, 1, 1, 2, 3, 4], "personal_data": [0, 1, 1, 2, 3, 4]}
    assert ids == expected[name]
