"""The corpus operators against brute-force versions, on one small table that
holds nulls, empty and very long texts, ties, repeated rows and clashing
columns, and on an empty table."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from txlake.llm import common, exact_dedup, langid, licenses, mixing, ngram_join, packing, substrings, topk, toxicity, url_filter

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, kept boolean, cls string, size int, hits int"
WORDS = "ba ce di fo gu ha je ki lo mu na pe qi ro su ta ve wi xo zu".split()


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join("".join(WORDS[j] for j in rng.integers(0, 20, rng.integers(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    long = prose(1, 30_000)
    near = prose(2, 120).split()
    edited = [*near[:60], "changed", *near[61:]]
    passage = prose(3, 70)
    out = [None, "", " \t\n", "!!! ...", "one", "one two three", long, long + " end", prose(4, 80), prose(4, 80).replace(" ", "\n"),
           " ".join(near), " ".join(edited), " ".join(near).upper(), prose(5, 60) + " " + passage, passage + " " + prose(6, 60),
           "a b " * 400, "a b " * 400, "the " * 300, "Released under the MIT License. mit  license", "apache License général Ünï",
           "This work is licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0.", "MITK license \x1f mit\x7flicense"]
    return out + [prose(100 + i, 30 + i) for i in range(40)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    sources = ["b", "a", None, "c", "é", "b"]
    rows = [(i, t, ["en", "de", None][i % 3], sources[i % 6], len(t or ""), 0.5, True, "x", 1, 2) for i, t in enumerate(texts)]
    rows += [rows[8], rows[8], (None, "lost id", "en", "a", 7, 0.1, False, "y", 3, 4)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_exact_groups(docs, empty):
    rows = docs.collect()
    got = exact_dedup.exact_groups(docs).collect()
    norm = [re.sub(r"[\x20\x09-\x0D]", "", r.text or "") for r in rows]
    groups = defaultdict(list)
    for r, n in zip(rows, norm, strict=True):
        groups[n].append((-len(r.text or ""), r.doc_id is None, r.doc_id))
    want = sorted((str(r.doc_id), str(min(groups[n])[2]), len(groups[n]), hashlib.sha256(n.encode()).hexdigest()) for r, n in zip(rows, norm, strict=True))
    assert sorted((str(g.doc_id), str(g.keep_id), g.group_size, g.text_sha256) for g in got) == want
    assert sum(g.kept for g in got) == len(groups)
    left = exact_dedup.exact_dedup(docs)
    assert left.columns == docs.columns and left.count() == len(groups)
    assert exact_dedup.exact_groups(empty).count() == 0 and exact_dedup.exact_dedup(empty).count() == 0


def jaccard_links(rows):
    sets = [set(common.grams(common.words(r.text), 5).tolist()) for r in rows]
    links = defaultdict(set)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 5 * len(a & b) >= 4 * len(a | b):
                links[i].add(j)
                links[j].add(i)
    return links


def test_near_duplicates(docs, empty):
    rows = docs.collect()
    links = jaccard_links(rows)
    got = sorted((str(g.doc_id), g.n_links) for g in ngram_join.near_duplicates(docs).collect())
    assert got == sorted((str(r.doc_id), len(links[i])) for i, r in enumerate(rows))
    seen, groups = set(), 0
    for i in range(len(rows)):
        if i not in seen:
            groups, todo = groups + 1, [i]
            while todo:
                if (k := todo.pop()) not in seen:
                    seen.add(k)
                    todo += links[k]
    left = ngram_join.drop_near_duplicates(docs)
    assert left.columns == docs.columns and left.count() == groups
    assert ngram_join.near_duplicates(empty).count() == 0


def test_pruning_bound():
    need = ngram_join.least_matches()
    assert need == sorted(need) and 0 < need[0] < ngram_join.STEP * ngram_join.THRESHOLD


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (10, 11), (11, 12), (12, 10), (20, 20)] + [(100, i) for i in range(101, 160)] + [(200 + i, 201 + i) for i in range(40)]
    got = {r.node: r.comp for r in common.components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    assert {got[i] for i in (1, 2, 3, 4)} == {1} and {got[i] for i in (10, 11, 12)} == {10}
    assert {got[i] for i in range(100, 160)} == {100} and {got[i] for i in range(200, 241)} == {200}


def fill(sizes):
    """Targets by resharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, target, open_ = 1.5 * sum(sizes.values()), {}, list(order)
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if level * weight[s] > 2 * sizes[s]]
        if not over:
            return target | {s: level * weight[s] for s in open_}
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
            open_.remove(s)
    return target


def test_mixing(docs, empty):
    rows = docs.collect()
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.source] += count(r.text)
    want = fill(sizes)
    got = mixing.mix_report(docs).collect()
    assert sorted((str(g.doc_id), g["size"]) for g in got) == sorted((str(r.doc_id), count(r.text)) for r in rows)
    assert all(g.taken <= 2 * g["size"] for g in got)
    taken = defaultdict(int)
    for g in got:
        taken[g.target] += g.taken
        assert any(abs(g.target - t) < 1e-6 * max(t, 1) and sizes[s] == g.source_size for s, t in want.items())
    assert all(abs(v - t) <= 0.1 * t + 1 for t, v in taken.items())
    assert sorted(map(str, mixing.mix_report(docs.repartition(3)).collect())) == sorted(map(str, got))
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns and sum(count(r.text) for r in mixed.collect()) == sum(taken.values())
    assert mixing.mix_report(empty).count() == 0 and mixing.mix_documents(empty).count() == 0


def test_mixing_of_tiny_sources(spark):
    # ten sources of ten words beside a large one
    rows = [(i, "a b c d e f g h i j", f"s{i}") for i in range(10)] + [(100 + i, prose(i, 400), "t") for i in range(30)]
    got = mixing.mix_report(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    taken = defaultdict(int)
    for g in got:
        taken[dict((i, s) for i, _, s in rows)[g.doc_id], g.target] += g.taken
    assert all(abs(v - t) <= 0.1 * t for (_, t), v in taken.items())
    assert all((g.shards == 0) == (g.taken == 0) and g.shards <= mixing.SHARDS for g in got)


def test_shard_counts_are_a_multinomial_draw(spark):
    targets = spark.createDataFrame([(0, 640_000, 960_000.0), (1, 128_000, 64_000.0), (2, 30, 45.0)], "sno int, source_size long, target double")
    counts = mixing.shard_counts(targets).collect()
    total = {s: sum(c.n for c in counts if c.sno == s) for s in (0, 1, 2)}
    assert total == {0: 15_000, 1: 1000, 2: 45}
    # variance about the mean, as of independent throws
    n = np.array([c.n for c in counts if c.sno == 0])
    assert len(n) > 1000 and 0.8 < n.var() / (15_000 / mixing.SHARDS) < 1.25
    slots = mixing.slots(targets).collect()
    for s, k in total.items():
        mine = sorted((x.slot, x.shard) for x in slots if x.sno == s)
        assert [x for x, _ in mine] == list(range(k))
        # numbered shard after shard, as many as were drawn
        assert [h for _, h in mine] == sorted(h for _, h in mine)
        assert sorted((c.shard, c.n) for c in counts if c.sno == s) == sorted((h, sum(x == h for _, x in mine)) for h in {h for _, h in mine})
    # another seed, another draw
    assert {(c.sno, c.shard, c.n) for c in counts} != {(c.sno, c.shard, c.n) for c in mixing.shard_counts(targets, 18).collect()}


@pytest.mark.parametrize("n", [1, 2, 7, 64, 1000])
def test_permutation(spark, n):
    from pyspark.sql import functions as F
    got = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(3)).alias("p")).collect()
    assert sorted(r.p for r in got) == list(range(n))


def test_packing(docs, empty):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(packing.default_tokenizer())
    want = defaultdict(list)
    for r in docs.collect():
        want[str(r.doc_id)].append(t.encode(r.text or "", add_special_tokens=False).ids + [1])
    got = packing.pack(docs, ids=True).collect()
    sequences, parts = defaultdict(list), defaultdict(list)
    for g in got:
        assert g.length == len(g.ids) <= packing.SEQ and g.ids_crc32 == zlib.crc32(np.array(g.ids, "<u4").tobytes())
        sequences[g.sequence_id].append((g.offset, g.length))
        parts[str(g.doc_id)].append((g.start, g.ids, g.doc_tokens))
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= packing.SEQ
    for k, docs_of in want.items():
        whole = sorted(x for d in docs_of for x in d)
        assert sorted(x for _, p, _ in parts[k] for x in p) == whole
        if len(docs_of) == 1:
            assert [x for _, p, _ in sorted(parts[k]) for x in p] == docs_of[0]
    assert packing.pack(empty).count() == 0


def test_remembered_strings_keep_the_tokenizers_ids(monkeypatch):
    import pyarrow as pa
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(packing.default_tokenizer())
    bits = ["don't", "we'll", "a", "\u0130x", "\u1e9e\u00df", "<|endoftext|>", "\u00e9", "e\u0301", "\u00a0", "\u0085", "\x0b", "\x1c", "\x00", "12", "3.5", "!!",
            "x" * 70, "\u03a3\u0391\u03a3", "\u65e5\u672c", "\t", "\n", "  ", "hello,", "'S", "\u0110", "\ufb01", "\u00ad", "</w>", "\x7f", "''''", "'re're"]
    rng = np.random.default_rng(5)
    texts = ["".join(str(rng.choice(bits)) + " " * int(rng.random() < .4) for _ in range(rng.integers(0, 12))) for _ in range(1500)] + ["", None, " "]
    want = [np.array(t.encode(x or "", add_special_tokens=False).ids + [packing.END_ID], "<u4").tobytes() for x in texts]
    encode = packing._encoder(packing.default_tokenizer())
    for remember in (packing.REMEMBER, 50):
        monkeypatch.setattr(packing, "REMEMBER", remember)
        assert encode(pa.array(texts, pa.string())) == want
    monkeypatch.setattr(packing, "RUN", 100)
    runs = packing._runs(pa.array(texts, pa.string()))
    assert [a for a, _ in runs] == list(np.cumsum([0] + [n for _, n in runs[:-1]])) and sum(n for _, n in runs) == len(texts)


def test_patterns_cover_the_histogram():
    rng = np.random.default_rng(0)
    h = dict(zip(*np.unique(rng.integers(1, 65, 3000), return_counts=True), strict=True))
    got = defaultdict(int)
    plan = packing.patterns({int(c): int(n) for c, n in h.items()}, 64)
    for p, times in plan:
        assert sum(c * n for c, n in p.items()) <= 64
        for c, n in p.items():
            got[c] += n * times
    assert dict(got) == h
    assert sum(t for _, t in plan) <= 1.02 * sum(c * n for c, n in h.items()) / 64 + 2


def test_passages(docs, empty):
    rows = {r.doc_id: common.words(r.text) for r in docs.collect()}
    runs = defaultdict(set)
    for d, w in rows.items():
        for h in common.grams(w, 50).tolist() if len(w) >= 50 else ():
            runs[h].add(d)
    covered = defaultdict(set)
    for g in substrings.repeated_passages(docs).collect():
        assert g.doc_id != g.other_id and g.n_words >= substrings.MIN_WORDS
        covered[g.doc_id] |= set(range(g.start_word, g.end_word))
    for d, w in rows.items():
        for at, h in enumerate(common.grams(w, 50).tolist() if len(w) >= 50 else ()):
            assert len(runs[h]) < 2 or set(range(at, at + 50)) <= covered[d]
    assert not set(covered) & set(range(23, 63))  # clean documents
    assert substrings.repeated_passages(empty).count() == 0


def test_passages_with_changed_words(spark):
    rows, at = [], {}
    for i in range(120):
        rng = np.random.default_rng(700 + i)
        passage, p = prose(20_000 + i, int(rng.integers(58, 101))).split(), 8 + i % 5
        edited = [f"other{i}x{j}" if j % p == p - 1 else w for j, w in enumerate(passage)]
        for k, body in ((2 * i, passage), (2 * i + 1, edited)):
            before = int(rng.integers(0, 40))
            rows.append((k, " ".join([prose(30_000 + k, before), *body, prose(40_000 + k, 30)]).strip()))
            at[k] = (before, before + len(body))
    found = {g.doc_id: g for g in substrings.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert set(found) == set(at)
    assert all(g.other_id == k ^ 1 and abs(g.start_word - at[k][0]) <= 12 and abs(g.end_word - at[k][1]) <= 12 for k, g in found.items())


def test_chains():
    rng = np.random.default_rng(2)
    for _ in range(30):
        x, y = rng.integers(0, 60, 25), rng.integers(0, 60, 25)
        order = np.lexsort((y, x))
        x, y = x[order], y[order]
        parts = substrings.chains_of(x, y)
        assert sorted(np.concatenate(parts).tolist()) == list(range(25))
        assert all((np.diff(x[p]) > 0).all() and (np.diff(y[p]) > 0).all() for p in parts)


def test_licences(docs, empty):
    base = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
    want = []
    for r in docs.collect():
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), r.text or ""))
        at = [(i, n) for p, n in base for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
        want.append((str(r.doc_id), len(w), len(at), min(at)[0] if at else None, max(at)[0] if at else None, ",".join(sorted({n for _, n in at}))))
    got = licenses.scan(docs).collect()
    key = lambda r: str(r)
    assert sorted([(str(g.doc_id), g.n_words, g.n_base, g.first_word, g.last_word, g.base_labels) for g in got], key=key) == sorted(want, key=key)
    assert all(set(filter(None, g.base_labels.split(","))) <= set(g.labels.split(",")) and 0 <= g.score <= 1 for g in got)
    assert next(g.labels for g in got if g.doc_id == 21) == "cc-by-nc"
    assert licenses.scan(empty).count() == 0


def test_licences_of_a_notice_file(spark):
    of = {label: text for label, text, _ in licenses.TEMPLATES}
    parts = ("mit", "bsd", "lgpl", "cc0", "unlicense", "mpl", "agpl", "cc-by-sa")
    long = [t for _, t, _ in licenses.TEMPLATES if len(t.split()) > 9]
    notice = " filler ".join([*long, *(of[p] for p in parts)])
    chatter = " ".join(["permission", "binary", "granted", "dedicated", "hereby", "obtaining", "redistribution", "unencumbered", "mozilla", "affero"] * 30)
    rows = [(0, notice), (1, chatter + " " + of["mpl"]), (2, chatter), (3, of["cc0"])] + [(10 + i, prose(i, 30)) for i in range(20)]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert set(parts) <= set(got[0].labels.split(",")) and got[1].labels == "mpl" and got[2].labels == "" and got[3].labels == "cc0"
    words = notice.split()
    for m in got[0].matches:
        assert any(words[m.position:m.position + len(t.split())] == t.split() for n, t, _ in licenses.TEMPLATES if n == m.template)


def test_licences_start_no_python_workers(docs):
    plan = licenses.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in plan and "Python" not in plan
    # nor are files without a trigger word, the last child of the union, shuffled
    lines = plan.splitlines()
    at = next(x.index("Union") for x in lines if "Union" in x)
    last = max(i for i, x in enumerate(lines) if x[at:at + 3] == "+- ")
    assert "scan parquet" in "".join(lines[last:]).lower() and "Exchange" not in "".join(lines[last:])


def test_licence_words_make_no_object_of_every_character(spark):
    odd = ["K license", "mitK mit license", "", " ", ".", ".mit license", "mit license.", "..mit  license..", None, "É MIT LICENSE 😀 mit license İ", "a"]
    docs = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")
    want = [(i, re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))) for i, t in enumerate(odd)]
    got = sorted((r.doc_id, r.n_words, [(h.pos, h.word) for h in r.hits or []]) for r in licenses.licence_hits(docs, ["mit", "license"], ["mit"]).collect())
    assert got == [(i, len(w), [(n, x) for n, x in enumerate(w) if x in ("mit", "license")] if "mit" in w else []) for i, w in want]
    assert "translate(" not in str(licenses.file_words(F.col("text")))


def test_urls(spark):
    link = '<link href="{0}" rel="canonical">'
    pages = [(0, "http://A.Example.org/es/x", None), (1, "https://x.net/1", link.format("http://b.com/de/q")), (2, "https://x.net/1?utm=1", ""),
             (3, "http://y.net/", '<META http-equiv=refresh content="0; url=https://x.net/1">'), (4, None, link.format("http://b.com/de/q")), (5, "no scheme", None),
             (6, "http://z.net/p", link.format("http://b.com/de/q") + link.format("http://c.com/fr/")), (7, "http://z.org", ""), (8, "http://z.org/en/1", ""),
             (9, "http://example.org/en/12", ""), (9, "http://example.org/en/12", ""), (10, "http://notexample.org/es/", ""), (11, "http://clean.net/a", "<a href=x>")]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got[0] == ("a.example.org", "/es/x", "example.org/es/", "block")
    # 6 names a blocked and an allowed url: the whole component goes by the allow
    assert [got[i][3] for i in (1, 2, 3, 6)] == ["allow"] * 4
    assert got[4] == ("", "", None, "allow") == got[5]
    assert got[7] == ("z.org", "", None, "allow") and got[8][2:] == ("org/", "allow") and got[9][2:] == ("example.org/en/1", "block") and got[10][2:] == ("org/", "allow")
    alone = {r.page_id: r.verdict for r in url_filter.judge_urls(spark.createDataFrame(pages[1:4] + pages[-1:], "page_id long, url string, html string")).collect()}
    assert alone == {1: "block", 2: "block", 3: "block", 11: "allow"}
    assert url_filter.judge_urls(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_top_products(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=6)], 0) for i in range(300)]
    rows += [(300 + i, rows[7][1], 1) for i in range(60)] + [(900, None, 0), (920, [float("nan")] * 6, 0), (940, [1.0, None, 0.0, 0.0, 0.0, 0.0], 0), (960, [float("inf")] * 6, 0)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    q = {i: np.floor(64 * np.array(v)).astype(int) for i, v, _ in rows if i < 900}
    want = set()
    for i in (i for i in q if i % 20 == 0):
        best = sorted(((-int(q[i] @ q[j]), j) for j in q if j != i))[:20]
        want |= {(i, r, j, -s) for r, (s, j) in enumerate(best, 1)}
    assert {tuple(r) for r in topk.top_products(vectors).collect()} == want
    few = spark.createDataFrame(rows[:3], "vec_id long, embedding array<double>, label int")
    assert topk.top_products(few).count() == 2
    assert topk.top_products(few.where("false")).count() == 0


def _best_products(rows, k=20):
    q = np.array([np.floor(64 * np.array(v)) for _, v, _ in rows]).astype(np.int64)
    ids = np.array([i for i, _, _ in rows])
    want = set()
    for a in np.flatnonzero(ids % 20 == 0):
        s = (q @ q[a]).tolist()
        best = sorted((-s[b], int(ids[b])) for b in range(len(ids)) if b != a)[:k]
        want |= {(int(ids[a]), r, j, -x) for r, (x, j) in enumerate(best, 1)}
    return want


@pytest.mark.parametrize("kind", ["clustered", "copies", "ties", "long"])
@pytest.mark.parametrize("blocks", [(24, 8), (1024, 256)])
def test_top_products_of_close_vectors(spark, monkeypatch, kind, blocks):
    # a query's best neighbours share its block
    monkeypatch.setattr(topk, "CANDIDATES", blocks[0])
    monkeypatch.setattr(topk, "QUERIES", blocks[1])
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(20, 6))
    if kind == "clustered":
        v = centres[rng.integers(20, size=900)] + 0.05 * rng.normal(size=(900, 6))
        v /= np.linalg.norm(v, axis=1, keepdims=True)
    elif kind == "copies":
        v = centres[rng.integers(20, size=600)]
    elif kind == "ties":
        v = rng.integers(-1, 2, size=(600, 6)) / 8
    else:
        v = 1000 * (centres[rng.integers(20, size=600)] + 0.001 * rng.normal(size=(600, 6)))
    rows = [(i, [float(x) for x in r], 0) for i, r in enumerate(v)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    assert {tuple(r) for r in topk.top_products(vectors).collect()} == _best_products(rows)


def test_language(spark, docs, empty):
    rng = np.random.default_rng(1)
    vocabulary = {"en": ["the", "thing", "with", "other"], "fr": ["être", "les", "château", "où"]}
    rows = [(i, " ".join(rng.choice(vocabulary[x], 30)), x) for i in range(120) for x in [("en", "fr")[i % 2]]]
    rows += [(500, None, "en"), (501, "12 34 !", "fr"), (502, rows[0][1] + " " + rows[1][1] + " " + rows[1][1], None), (503, rows[0][1] * 3000, None)]
    got = {r.doc_id: r for r in langid.language(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(got[i].lang_pred == x for i, _, x in rows[:120])
    assert got[500].lang_pred == got[501].lang_pred == "und" and got[502].lang_pred == "fr" and got[503].lang_pred == "en"
    assert all(0 <= g.score <= 1 and g.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, g in got.items())
    assert langid.language(docs).count() == docs.count() and langid.language(empty).count() == 0


def test_long_words_are_read_whole():
    a, b = "x" * 47 + "q" + "x" * 48, "x" * 47 + "z" + "x" * 48
    assert "".join(langid.letter_words(a)) == a and max(map(len, langid.letter_words(a))) <= langid.LONGEST
    fa, fb = (langid.word_features(langid.letter_words(w)) for w in (a, b))
    assert fa.shape == fb.shape and (fa != fb).any()


def test_a_long_text_takes_no_other_rows_place(spark):
    # one huge text of a language before many short ones that look otherwise
    rng = np.random.default_rng(14)
    rows = [(0, "zzyzx qqkx " * 200_000, "aa")]
    rows += [(i, " ".join(rng.choice(["bone", "tale", "mare", "sole"], 30)), "aa") for i in range(1, 200)]
    rows += [(1000 + i, " ".join(rng.choice(["būtų", "ąžuol", "šių", "čia"], 30)), "bb") for i in range(200)]
    got = {r.doc_id: r for r in langid.language(spark.createDataFrame([*rows, (5000, "bonemaretalesole" * 40, None)], "doc_id long, text string, lang string")).collect()}
    assert all(got[i].lang_pred == x for i, _, x in rows) and got[5000].lang_pred == "aa"


def test_marginals_agree_with_plain_forward_backward():
    rng = np.random.default_rng(3)
    crf = langid.Crf(["a", "b", "c"], np.zeros((1, 3)), np.zeros((1, 3)), np.zeros(3), rng.normal(size=(3, 3)), rng.normal(size=3))
    sizes = np.array([1, 64, 65, 200])
    e = rng.normal(size=(sizes.sum(), 3)).astype(np.float32)
    got, at = crf.marginals(e, sizes), 0
    for n in sizes:
        x, A = np.exp(e[at:at + n].astype(float)), np.exp(crf.change)
        f, b = np.zeros((n, 3)), np.ones((n, 3))
        v = np.exp(crf.start)
        for i in range(n):
            v = (v @ A) * x[i]
            v /= v.sum()
            f[i] = v
        for i in range(n - 2, -1, -1):
            b[i] = A @ (x[i + 1] * b[i + 1])
            b[i] /= b[i].sum()
        want = f * b / (f * b).sum(axis=1, keepdims=True)
        assert np.allclose(got[at:at + n], want, atol=1e-6)
        at += n


def test_toxicity(spark, docs, empty):
    rng = np.random.default_rng(6)
    rows, labels = [], []
    for i in range(600):
        w = prose(i, 40).split()
        if i % 4 == 0:
            for _ in range(4):
                w[int(rng.integers(40))] = ["vile", "rotten", "awful"][int(rng.integers(3))]
        rows.append((i, " ".join(w)))
        labels.append((i, int(i % 4 == 0)))
    labels += [(None, 1), (3, None), (7, 0)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.toxicity(table, known).collect()
    held = [g for g in got if g.held_out]
    assert all(g.held_out == (zlib.crc32(str(g.doc_id).encode()) % 5 == 0) for g in got)
    assert np.mean([g.predicted == (g.doc_id % 4 == 0) for g in held]) > 0.9
    assert toxicity.drop_toxic(docs, known).columns == docs.columns
    scores = [r.score for r in toxicity.toxicity(docs, known).collect()]
    assert len(scores) == docs.count() and all(0 <= s <= 1 for s in scores)
    assert toxicity.toxicity(empty, known).count() == 0


def test_toxicity_keeps_every_bigram(spark):
    from pyspark.sql import functions as F
    # 400,000 ordinary bigrams, commoner than the toxic ones: more than any fixed table
    ordinary = spark.range(400_000).select((F.col("id") % 640).alias("v"), (F.expr("id div 640") + 10_000).alias("w"), F.lit(1000).cast("long").alias("n0"), F.lit(0).cast("long").alias("n1"))
    toxic = spark.createDataFrame([(90_000 + i, 95_000 + j, 0, 60) for i in range(8) for j in range(8)], "v long, w long, n0 long, n1 long")
    counts = ordinary.unionByName(toxic).withColumns({"d0": F.col("n0"), "d1": F.col("n1")})
    table, base = toxicity.model(counts)
    got = {r.key: (r.a, r.b) for r in table.collect()}
    key = lambda v, w: int(toxicity.bigram_key(np.array([v], np.uint64), np.array([w], np.uint64)).view(np.int64)[0])
    assert all(got[key(90_000 + i, 95_000 + j)][0] > 1 for i in range(8) for j in range(8))
    # a text is scored by the table's rows, whichever block it falls into
    rng = np.random.default_rng(8)
    texts = [None, "", "x"] + [prose(i % 7, int(rng.integers(1, 60))) for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    h = lambda w: int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little")
    signed = lambda u: u - (1 << 64) if u >> 63 else u
    vocabulary = sorted({w for t in texts for w in common.words(t)})
    single = {h(w): (float(rng.normal()), float(rng.normal())) for w in vocabulary[::2]} | {toxicity.START: (0.5, 0.25)}
    runs = [[toxicity.START, *map(h, common.words(t))] for t in texts]
    pairs = {p for r in runs for p in zip(r, r[1:], strict=False)}
    own = {p: float(rng.normal()) for p in sorted(pairs)[::3]}
    rows = [(signed(u), *ab) for u, ab in single.items()] + [(key(*p), r, None) for p, r in own.items()]
    found = {r.doc_id: r.x for r in toxicity.features(docs, spark.createDataFrame(rows, "key long, a double, b double"), 0.125).collect()}
    for i, r in enumerate(runs):
        want = [own.get(p, single.get(p[0], (0, 0))[0] + single.get(p[1], (0, 0.125))[1]) for p in zip(r, r[1:], strict=False)]
        assert np.allclose(found[i], toxicity._features(np.array(want)))


def test_toxicity_fixed_expressions(spark):
    # the insult always follows the same two common words
    rng = np.random.default_rng(9)
    rows, labels = [], []
    for i in range(1500):
        w = prose(5000 + i, int(rng.integers(30, 60))).split()
        at = int(rng.integers(2, 28))
        w[at - 2:at] = ["you", "are"]
        if i % 4 == 0:
            w[at] = "grobian"
        rows.append((i, " ".join(w)))
        labels.append((i, int(i % 4 == 0)))
    # held-out rows where it follows a word it never followed
    rows += [(i, prose(5000 + i, 20) + " what grobian " + prose(9000 + i, 20)) for i in range(2000, 2040)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = toxicity.toxicity(table, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert np.mean([g.predicted == (g.doc_id % 4 == 0) for g in got if g.held_out and g.doc_id < 2000]) > 0.95
    assert np.mean([g.predicted for g in got if g.doc_id >= 2000]) > 0.9


def test_pipeline_stages(spark, tmp_path, docs):
    import corpus_pipeline as P
    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 2)) for i in range(20, 60)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert [n for n, _ in P.STAGES] == ["toxicity", "exact_dedup", "ngram_join", "mixing", "packing"]
    at = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in P.STAGES[:-1]:
        nxt = common.scratch(stage(spark, at, str(tmp_path)), "t")
        assert nxt.columns == at.columns
        at = nxt
    pieces = P.run(spark, str(tmp_path)).collect()
    assert pieces and all(p.length <= packing.SEQ for p in pieces)


def test_near_group_of_many_classes(spark):
    # 700 edits of one text: rows and edges grow with the classes, links are exact
    rng = np.random.default_rng(12)
    base = prose(77, 150).split()
    texts = []
    for i in range(700):
        w = list(base)
        for at in rng.integers(0, 150, 1 + i % 3):
            w[at] = f"edit{i}"
        texts.append(" ".join(w))
    texts += [prose(7000 + i, 60) for i in range(50)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    sets = [set(zip(*(t.split()[k:] for k in range(5)), strict=False)) for t in texts]
    want = [sum(5 * len(a & b) >= 4 * len(a | b) for b in sets) - 1 for a in sets]
    made = {}
    keep = ngram_join.scratch
    ngram_join.scratch = lambda df, name: made.setdefault(name, keep(df, name))
    try:
        got = {r.doc_id: r for r in ngram_join.near_duplicates(table).collect()}
    finally:
        ngram_join.scratch = keep
    assert [got[i].n_links for i in range(750)] == want
    assert all(got[i].class_id == i for i in range(700, 750))
    # the plain components of the linked pairs
    root = list(range(750))
    for i in range(700):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                if a != b:
                    root = [min(a, b) if x == max(a, b) else x for x in root]
    assert [got[i].class_id for i in range(750)] == root
    assert made["near-edges"].count() < 2 * 700 and made["near-dealt"].count() <= 2 * 700


def test_toxicity_without_a_class_to_fit_on(spark):
    rng = np.random.default_rng(13)
    rows, labels = [], []
    for i in range(800):
        w = prose(20_000 + i, 40).split()
        toxic = i % 4 == 0
        if toxic:
            for _ in range(6):
                w[int(rng.integers(40))] = ["vile", "rotten", "awful"][int(rng.integers(3))]
        rows.append((i, " ".join(w)))
        fold = zlib.crc32(str(i).encode()) % 5
        if not (fold == toxicity.FIT_FOLD and toxic):
            labels.append((i, int(toxic)))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    clashing = spark.createDataFrame([(*x, 7, "s") for x in labels], "doc_id long, toxic int, text int, score string")
    got = toxicity.toxicity(table, clashing).collect()
    held = [g for g in got if g.held_out]
    assert np.mean([g.predicted == (g.doc_id % 4 == 0) for g in held]) > 0.9
    # no toxic text teaches the models: no evidence, no score
    none = spark.createDataFrame([x for x in labels if not x[1]], "doc_id long, toxic int")
    assert {g.score for g in toxicity.toxicity(table, none).collect()} == {0.0}


def test_matches_of_all_shared_seeds(docs, monkeypatch):
    """Small blocks and many ranges: every occurrence of a seed that two
    documents have is matched, with the least or the greatest of them."""
    monkeypatch.setattr(substrings, "BLOCK_WORDS", 700)
    monkeypatch.setattr(substrings, "RANGE_SEEDS", 300)
    def runs_of(groups):
        import pyarrow as pa

        for columns in substrings._runs(groups):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["k", "anchor", "pos", "apos", "n"])
    runs, names = substrings._chains(docs, runs_of, "k long, anchor long, pos long, apos long, n long")
    key = {r.k: r.key for r in names.collect()}
    text = {r.key: common.words(r.text) for r in docs.select(common.row_key().alias("key"), "text").collect()}
    assert sorted(key.values()) == sorted(k for k, w in text.items() if len(w) >= substrings.K)
    number = {v: k for k, v in key.items()}
    at = defaultdict(lambda: defaultdict(set))
    for k in key.values():
        for p, h in zip(*(x.tolist() for x in substrings.seeds_of(text[k])), strict=True):
            at[h][number[k]].add(p)
    want = {(k, p): {(o, q) for o in {min(of) if min(of) != k else max(of)} for q in of[o]}
            for of in at.values() if len(of) > 1 for k, ps in of.items() for p in ps}
    got = [((r.k, r.pos + i), (r.anchor, r.apos + i)) for r in runs.collect() for i in range(r.n)]
    assert len(got) == len(want) == len(dict(got)) and all(b in want[a] for a, b in got)


def test_lone_runs_that_no_alignment_goes_beyond():
    """Told apart together, they get the spans that alignment gives each."""
    import pyarrow as pa

    rng = np.random.default_rng(17)
    rows = []
    for cid in range(3000):
        n, k = int(rng.integers(5, 9)), int(rng.integers(3, 40))
        run = rng.integers(0, 1000, n).astype(np.uint32)
        sides = []
        for _ in range(2):
            before, after = (rng.integers(0, k, int(rng.integers(0, 13))).astype(np.uint32) for _ in range(2))
            f = int(rng.integers(1, 50)) if len(before) == 12 else 0
            sides.append((f, f + len(before), np.concatenate([before, run, after])))
        if cid % 50 == 0:
            # hashes alike, words not
            sides[0][2][sides[0][1] - sides[0][0]] += 1
        corners = [[[x, x + n - 5] if n > 5 else [x]] for _, x, _ in sides]
        rows.append((cid, 2 * cid, 2 * cid + 1, *corners, *(v for f, _, w in sides for v in (f, w.tobytes()))))
    lists = pa.list_(pa.list_(pa.int32()))
    kinds = (pa.int64(), pa.int64(), pa.int64(), lists, lists, pa.int64(), pa.binary(), pa.int64(), pa.binary())
    batch = pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)],
                                       ["cid", "k", "anchor", "xs", "ys", "f0", "w0", "f1", "w1"])
    for part in (batch, batch.slice(701, 1200)):
        done, _ = substrings._unextended(part)
        assert len(part) // 10 < len(done) < len(part)
        quick = sorted(r for b in substrings._aligner(substrings.NARROW)([part]) for r in zip(*(c.to_pylist()[:] for c in b.columns[1:]), strict=True) if r[0] is not None)
        plain = []
        for (f0, w0), (f1, w1), k, anchor, xs, ys in zip(*(zip(*(part.column(c).to_pylist() for c in p), strict=True) for p in (("f0", "w0"), ("f1", "w1"))),
                                                         *(part.column(c).to_pylist() for c in ("k", "anchor", "xs", "ys")), strict=True):
            a, b = (np.frombuffer(w, np.uint32) for w in (w0, w1))
            s, e, u, v, matched, low, high, alow, ahigh = substrings.align(a, b, np.array(xs[0]) - f0, np.array(ys[0]) - f1)
            if (low < 0 < f0 or alow < 0 < f1 or high > len(a) == xs[0][-1] + 17 - f0 or ahigh > len(b) == ys[0][-1] + 17 - f1):
                continue
            if matched >= substrings.IDENTITY * max(e - s, v - u):
                plain += [(k, anchor, f0 + s, f0 + e), (anchor, k, f1 + u, f1 + v)]
        assert quick == sorted(plain)


def test_toxicity_lets_go_of_what_packing_remembers():
    path = packing.default_tokenizer()
    assert packing._encoder(path)(pa.array(["a few words"]))
    assert packing._encoder.cache_info().currsize
    assert list(toxicity._blocks(iter(()), [], 16)) == []
    assert packing._encoder.cache_info().currsize == 0


def test_runs_of_matches_on_close_and_far_diagonals():
    # one block: document 0 holds the anchor's words at places far apart, before and after
    n, pos, apos = 6, np.array([0, 1, 2, 5, 6, 900]), np.array([2**30, 2**30 + 1, 2**30 + 2, 0, 1, 899])
    cols = dict(part=[0], range=[0], base=[7], n=[n], m=[1])
    a, b = substrings._pack_places(np.zeros(n, np.int64), pos)
    cols |= dict(a=[a], b=[b], c=[substrings._pack(np.diff(np.arange(n), prepend=0))], d=[substrings._pack(np.zeros(n, np.int64))],
                 e=[np.array([3], "<i8").tobytes()], f=[substrings._pack(apos)])
    (doc, other, at, aat, size), = substrings._runs([((0,), pa.table(cols))])
    assert sorted(zip(at.tolist(), aat.tolist(), size.tolist(), strict=True)) == [(0, 2**30, 3), (5, 0, 2), (900, 899, 1)]
    assert set(doc.tolist()) == {7} and set(other.tolist()) == {3}


def test_hashes_of_texts_are_those_of_their_words():
    rng = np.random.default_rng(11)
    letters = [*"aZ_9 .,\t\n\x00\x1c\x1f\x85\xa0 ", *"éßİΣσ²ªⅣ٣ǅ中の한😀́‍­"]
    texts = [None, "", " ", "\x00", "A", "É", "ΟΔΟΣ ΣΑΣ", "".join(map(chr, range(0xD800))), "".join(map(chr, range(0xE000, 0x110000)))]
    texts += ["".join(rng.choice(letters[:n], 60)) for n in (15, len(letters)) for _ in range(200)]
    for t in texts:
        want = common.word_hashes(common.words(t))
        got = common.text_hashes(t)
        assert got.dtype == want.dtype and got.tolist() == want.tolist()


def test_order_of_long_numbers():
    """Also of those whose first bits are the same."""
    rng = np.random.default_rng(18)
    for n in (1, 2, 5000):
        whole = rng.integers(0, 1 << 64, n, np.uint64)
        for v, bits in ((whole, 64), (whole >> np.uint64(63), 64), (whole >> np.uint64(56), 64), (whole >> np.uint64(56), 8), (whole >> np.uint64(24), 40)):
            assert substrings._order(v, bits).tolist() == np.argsort(v, kind="stable").tolist()


def test_a_range_answers_its_blocks_together():
    import pyarrow as pa

    rng = np.random.default_rng(13)
    texts = [rng.integers(0, 40, 30).astype(np.uint32) for _ in range(64)]
    rows = [r for k, w in enumerate(texts) for r in substrings._block_rows(k, k, [substrings._seeds(np.concatenate([w, texts[k // 2]]))], 2)]
    asked = pa.Table.from_batches([substrings._rows(rows)]).sort_by("range")
    batches = list(substrings._answered(common.sorted_groups(asked.to_batches(), ["range"])))
    assert len(batches) == 2 and sum(len(b) for b in batches) >= 128


def test_packed_numbers_of_every_length_and_width():
    rng = np.random.default_rng(19)
    for n in (0, 1, 2, substrings.PLAIN, substrings.PLAIN + 1):
        for most in (1, 255, 256, 65_535, 65_536, 2**32 - 1):
            v = rng.integers(0, most, n, endpoint=True)
            v[:1] = most
            data = substrings._pack(v)
            assert substrings._unpack(data, n).tolist() == v.tolist()
            assert n > substrings.PLAIN or len(data) <= 4 * n + 1


def test_blocks_of_large_tables_have_no_rows_of_few_seeds():
    for chars in (0, 10**8, 510 * 10**6, 30 * 10**9):
        ranges = substrings._ranges(chars)
        assert ranges * substrings.MOST_SEEDS * substrings.CHARS >= chars
        assert ranges == substrings.RANGES or substrings.BLOCK_WORDS / ranges >= 512
