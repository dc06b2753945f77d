"""Suffix-array repetition against plain scans of every word run."""

import re
from collections import defaultdict

import numpy as np
import pytest

from txlake.llm import repetition

SCHEMA = "doc_id long, text string, kept boolean, spans int, n_words int"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def covered(w, k):
    seen = defaultdict(list)
    for i in range(len(w) - k + 1):
        seen[tuple(w[i:i + k])].append(i)
    return {i + j for at in seen.values() if len(at) > 1 for i in at for j in range(k)}


def longest(w):
    best = 0
    while len(covered(w, best + 1)):
        best += 1
    return best


def plain(text):
    w = words_of(text)
    lines = [x for x in (text or "").split("\n") if words_of(x)]
    repeated, united = len(covered(w, 5)), covered(w, repetition.MIN_WORDS)
    failed = len(w) < 10 or 100 * repeated > 20 * len(w)
    runs = [i for i in sorted(united) if i - 1 not in united]
    ends = [i + 1 for i in sorted(united) if i + 1 not in united]
    top = longest(w)
    kept = not failed and 100 * len(united) <= repetition.MAX_PERCENT * len(w) and top <= repetition.MAX_REPEAT
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), repeated, failed, kept,
            len(united), top, [(a, b - a) for a, b in zip(runs, ends, strict=True)])


def texts():
    rng = np.random.default_rng(3)

    def prose(n, kinds):
        return " ".join(f"w{x}" for x in rng.integers(0, kinds, n))
    passage = prose(55, 10_000)
    out = [None, "", " \t\n\x0b\x0c\r ", "one", "a b c d e f g h i j", "a b c d e f g h i", "the " * 40, "a b " * 30, "x y z q " * 4,
           "line one\nline two\n\n \nline one\nline one \nline two", "# * $ % & | < > ## ünï 漢字 \U0001F600 \U0001F600",
           f"{passage} {prose(800, 10_000)} {passage}", f"{passage[:200]} {prose(800, 10_000)} {passage[:200]}",
           # phrases of three words in ever new order: no run of four words comes twice
           " ".join({"P": "p q r", "S": "s t u", "V": "v w x", "Y": "y z o"}[x] for x in "PSVYPVSYSPYV"),
           "ab cd " + "ab cd ef " * 3, "A a A a B b B b"]
    out += [prose(int(n), int(k)) for n, k in zip(rng.integers(0, 400, 60), rng.choice([2, 6, 40, 400], 60), strict=True)]
    return out + [out[11], out[-1]]


@pytest.mark.parametrize("chunk", [1, 1 << 21])
def test_judge_quality(spark, monkeypatch, chunk):
    monkeypatch.setattr(repetition, "CHUNK", chunk)
    rows = [(i, t, True, 1, 2) for i, t in enumerate(texts())]
    got = {r.doc_id: tuple(r)[1:] for r in repetition.judge_quality(spark.createDataFrame([*rows, (None, "lost id", True, 1, 2)], SCHEMA)).collect()}
    assert got.pop(None)[0] == 2 and len(got) == len(rows)
    for i, t, *_ in rows:
        want = plain(t)
        assert got[i][:-1] == want[:-1] and [tuple(s) for s in got[i][-1]] == want[-1], i
    # a passage of 55 words twice among 800 others: only the longest repeat tells
    assert not got[11][6] and got[12][6] and not got[13][5] and not got[13][6]


def test_very_long_texts(spark):
    rng = np.random.default_rng(4)
    once = " ".join(f"{x:x}" for x in rng.integers(0, 1 << 60, 300_000))
    rows = [(1, once, True, 1, 2), (2, "the " * 200_000, True, 1, 2), (3, once + " " + once, True, 1, 2)]
    got = {r.doc_id: r for r in repetition.judge_quality(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[1].kept and got[1].n_words == 300_000 and got[1].longest_repeat == 0
    assert got[2].n_repeat_words == 200_000 and got[2].longest_repeat == 199_999 and got[2].base_failed
    assert got[3].longest_repeat == 300_000 and [tuple(s) for s in got[3].spans] == [(0, 600_000)]


def test_no_documents(spark):
    assert repetition.judge_quality(spark.createDataFrame([], SCHEMA)).count() == 0


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(5)
    for n, kinds in ((1, 1), (2, 1), (50, 2), (300, 5), (200, 1)):
        tokens = np.concatenate([rng.integers(0, kinds, n), [kinds]])
        sa, levels = repetition.suffix_array(tokens)
        assert sa.tolist() == sorted(range(n + 1), key=lambda i: tokens[i:].tolist())
        lcp = repetition.common_prefixes(sa, levels)
        for r in range(1, n + 1):
            a, b = tokens[sa[r - 1]:], tokens[sa[r]:]
            m = min(len(a), len(b))
            same = np.flatnonzero(a[:m] != b[:m])
            assert lcp[r] == (same[0] if len(same) else m)
