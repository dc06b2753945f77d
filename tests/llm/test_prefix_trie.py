"""The prefix trie against a plain one built with dictionaries."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest

from txlake.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth long, top string"


def plain(rows):
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    for turns in own.values():
        turns.sort(key=lambda t: (t[0], t[1], t[2][:64], t[3][:64], hashlib.sha256(f"{t[2]}\0{t[3]}".encode()).hexdigest()))
    own = {c: [t[2:] for t in turns] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        built[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(list)
    for n in members:
        if n:
            children[n[:-1]].append(n)
    leaves, saved = defaultdict(int), defaultdict(int)
    for n, m in members.items():
        for d in range(len(n) + 1):
            leaves[n[:d]] += not children[n]
            saved[n[:d]] += (len(m) - 1) * (len(n[-1][1]) if n else 0)
    out = set()
    for n, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(built[c]) == len(n))
        out.add((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(children[n]), leaves[n], saved[n], hashlib.sha256(ends.encode()).hexdigest(), *(n[-1] if n else (None, None))))
    return out


def rows_of(kind):
    rng = np.random.default_rng(5)
    rows = []
    if kind == "mixed":
        for c in [*range(0, 40), *range(100, 130), *range(-205, -195), 3001, 3100]:
            for t in range(int(rng.integers(1, 9))):
                rows.append((c, t, ["user", None, "bot"][int(rng.integers(3))], [None, "", "hi", "héllo \U0001F600"][int(rng.integers(4))], 1, "x"))
        rows += [(None, 1, "user", "lost", 1, "x"), (7, None, "user", "first", 1, "x"), (8, 0, "user", "tie", 1, "x"), (8, 0, "user", "tie", 1, "x"), (8, 0, "bot", "tie", 1, "x")]
    elif kind == "copies":
        # a third of all conversations alike, one very long, one very common first turn
        for c in range(150):
            body = ["same"] * 7 if c % 3 else [f"w{int(x)}" for x in rng.integers(0, 3, 6)]
            rows += [(c, t, "user", x, 1, "x") for t, x in enumerate(["hello", *body])]
        rows += [(170, t, "bot", f"line {t % 2}" * 3, 1, "x") for t in range(400)]
        rows += [(171, None, "bot", "equal", 1, "x")] * 60 + [(172, 1, "bot", "long " * 30_000, 1, "x")]
    elif kind == "chain":
        # prefixes of one another: a deep chain, and combs hanging from it
        for c in range(0, 60):
            rows += [(100 * c, t, "user", f"t{t}", 1, "x") for t in range(c + 6)]
            rows += [(100 * c, c + 6, "user", f"own {c}", 1, "x")] * (c % 2)
    return rows


@pytest.mark.parametrize("local", [1, 16, 512])
@pytest.mark.parametrize("kind", ["mixed", "copies", "chain"])
def test_prefix_trie(spark, kind, local):
    rows = rows_of(kind)
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = prefix_trie.prefix_trie(table, local=local).collect()
    assert len(got) == len(set(got)) and {tuple(r) for r in got} == plain(rows)


def test_prefix_trie_without_conversations(spark):
    table = spark.createDataFrame([(None, 1, "user", "lost", 1, "x")], SCHEMA)
    assert prefix_trie.prefix_trie(table).count() == 0
    assert prefix_trie.prefix_trie(table.where("false"), texts=False).count() == 0


def test_rounds_grow_with_the_logarithm(spark, monkeypatch):
    # a chain of 400 nodes: a sum per level would take 400 rounds
    rounds = []
    keep = prefix_trie.scratch
    monkeypatch.setattr(prefix_trie, "scratch", lambda df, name: (rounds.append(name), keep(df, name))[1])
    rows = [(100, t, "user", f"t{t}", 1, "x") for t in range(400)]
    got = prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA), local=1).collect()
    assert {tuple(r) for r in got} == plain(rows)
    assert rounds.count("trie-centroids") <= 20
