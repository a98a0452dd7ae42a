"""Decontamination, quality and language mixtures against plain versions on random and repetitive texts."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from lakeops.llm import decontaminate, language, quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def mixed_texts(draw, n):
    """Texts of few and of many different words, periodic ones, and ones with copied passages."""
    passages = [" ".join(f"p{i}w{j}" for j in range(25)) for i in range(6)]
    texts = []
    for _ in range(n):
        kind = draw.randrange(4)
        if kind == 0:
            texts.append(" ".join(draw.choice("abc") for _ in range(draw.randrange(0, 120))))
        elif kind == 1:
            word = [str(draw.randrange(50)) for _ in range(draw.randrange(1, 30))]
            texts.append("\n".join((word * 9)[: draw.randrange(1, 150)]))
        elif kind == 2:
            texts.append(" ".join(draw.choice([draw.choice(passages), f"own{draw.randrange(999)}"]) for _ in range(draw.randrange(1, 9))))
        else:
            texts.append("  ".join(f"w{draw.randrange(400)}" for _ in range(draw.randrange(0, 200))))
    return texts + ["", " \t\n", "a", "É É é ☃", "x" * 5000, "A-b_c " * 300]


def contaminated(text, items, window=10):
    words = ALNUM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text))
    hit, found = set(), set()
    for item, body in items:
        own = ALNUM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), body or ""))
        size = min(window, len(own))
        windows = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own else set()
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in windows:
                hit |= set(range(i, i + size))
                found.add(str(item))
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("block_bytes", [200, 1 << 23])
def test_decontamination_equals_plain_windows(spark, block_bytes):
    draw = random.Random(1)
    texts = mixed_texts(draw, 120)
    items = [(i, draw.choice(texts)[: draw.randrange(5, 200)].upper()) for i in range(25)]
    items += [(100, "a"), (101, "b a"), (102, None), (103, ""), (104, "p1w3 P1W4 p1w5"), (105, " ".join(f"p2w{j}" for j in range(10)))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contamination(docs, bench, block_bytes=block_bytes).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, list(r["items"])) for r in found} == {
        i: contaminated(text, items) for i, text in enumerate(texts)
    }
    assert sum(r.n_hit > 0 for r in found) > 20


def repeated_sequences(words):
    """For each place the longest sequence from there that starts somewhere else too."""
    n = len(words)
    longest = [0] * n
    for i in range(n):
        for j in range(i + 1, n):
            size = 0
            while j + size < n and words[i + size] == words[j + size]:
                size += 1
            longest[i], longest[j] = max(longest[i], size), max(longest[j], size)
    return longest


def test_quality_equals_plain_repetition(spark):
    draw = random.Random(2)
    texts = mixed_texts(draw, 100) + [" ".join(f"u{i}" for i in range(200)) + " " + " ".join(f"u{i}" for i in range(45)) for _ in range(2)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    rules = quality.Rules()
    rows = {r.doc_id: r for r in quality.judge(docs).collect()}
    verdicts = Counter()
    for i, text in enumerate(texts):
        words = WORD.findall(text)
        n, longest = len(words), repeated_sequences(WORD.findall(text))
        covered = {p for s, size in enumerate(longest) if size >= rules.min_repeat for p in range(s, s + size)}
        again = {p for s, size in enumerate(longest) if size >= 3 for p in range(s, s + 3)}
        top = max(longest, default=0)
        failed = n < 50 or 100 * len(again) > 50 * n
        bad = 100 * len(covered) > rules.max_covered_percent * n or (top > rules.longest_allowed and 100 * top > rules.max_longest_percent * n)
        row = rows[i]
        assert (row.n_repeat_words, row.covered_words, row.longest_repeat) == (len(again), len(covered), top)
        assert (row.base_failed, row.kept) == (failed, not failed and not bad)
        verdicts[failed, bad] += 1
    assert {f for f, _ in verdicts} == {True, False}
    kept = {r.doc_id for r in quality.keep_good(docs).collect()}
    assert kept == {i for i, r in rows.items() if r.kept}


def plain_mixture(logs, bins, rounds):
    """Expectation-maximisation of one text, occurrence by occurrence."""
    share = [1 / len(logs)] * len(logs)
    for _ in range(rounds):
        total = [0.0] * len(logs)
        for b in bins:
            part = [s * math.exp(logs[k][b]) for k, s in enumerate(share)]
            for k, p in enumerate(part):
                total[k] += p / sum(part)
        share = [t / len(bins) for t in total]
    return share


def test_mixtures_equal_a_plain_loop():
    draw = np.random.default_rng(5)
    table = draw.random((3, language.BINS)) ** 4 + 1e-3
    logs = np.log(table / table.sum(axis=1, keepdims=True))
    texts = [draw.choice(language.BINS, size=60, p=np.exp(logs[i % 3]) / np.exp(logs[i % 3]).sum()) for i in range(10)]
    at = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    owner = np.repeat(np.arange(10), np.diff(at))
    keys, counts = np.unique(owner << 16 | np.concatenate(texts), return_counts=True)
    mixture = language.Mixtures(logs, keys >> 16, keys & (language.BINS - 1), counts, 10)
    share, likelihood = mixture.run(np.full((10, 3), 1 / 3), 30)
    for i, bins in enumerate(texts):
        expected = plain_mixture(logs, bins, 30)
        assert share[i] == pytest.approx(expected, abs=2e-4)
        log = sum(math.log(sum(s * math.exp(logs[k][b]) for k, s in enumerate(share[i].tolist()))) for b in bins)
        assert likelihood[i] == pytest.approx(log, rel=1e-4)


def test_inferred_set_pays_its_penalty():
    """The chosen languages are the shortest leading set whose likelihood a further one does not raise enough."""
    draw = np.random.default_rng(6)
    table = draw.random((3, language.BINS)) ** 8 + 1e-4
    logs = np.log(table / table.sum(axis=1, keepdims=True))
    pick = lambda k, n: draw.choice(language.BINS, size=n, p=np.exp(logs[k]) / np.exp(logs[k]).sum())
    texts = [pick(0, 300), np.concatenate([pick(1, 200), pick(2, 150)]), pick(2, 5), np.zeros(0, np.int64)]
    at = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    out = language.infer(logs, np.concatenate(texts), at, language.PENALTY, language.ROUNDS)
    assert (out[0] > 0).tolist() == [True, False, False]
    assert (out[1] > 0).tolist() == [False, True, True] and 0.3 < out[1][2] < 0.55
    assert (out[2] > 0).sum() == 1 and out[3].sum() == 0
