"""Language identification of code-switched text by a linear-chain CRF.

Every word gets a label. Emission weights come from hashed affixes and
character n-grams and from a lexicon: how often each language's training rows
use the word, counted by Spark over all of them. Transition weights are learned
together with the others, by gradients from forward-backward, on a bounded
sample of training rows whose passages are strung together into code-switched
sequences with known labels. A text's words are labelled by forward-backward
over the whole text; the language with most expected words is the prediction
and its share the score. Words run in blocks: block transfer matrices give the
messages between blocks, so long and short texts are worked in step.

Cases: a null text or one without letters is ``und`` with score 0; rows with
null text or lang teach nothing; ties go to the first language; without
training rows everything is ``und``; repeated rows count each; extra columns
are not looked at.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlake.llm.common import crc_mod, mix64, scratch, word_hashes

FOLDS = 4
HELD_OUT = 2
#: Bounds of the model and of the fitted sample (rows, per language).
FEATURES = 1 << 16
BUCKETS = 1 << 17
FIT_ROWS = 300
#: Words of the passage that a sampled row gives, from a place its hash chooses.
FIT_PASSAGE = 400
#: Letters of a word; a longer run of letters is read in pieces.
LONGEST = 32
EPOCHS = 40
BLOCK = 64
#: Words whose emissions a task remembers.
REMEMBER = 150_000

_LETTERS = re.compile(r"[^\W\d_]+")


def letter_words(text: str | None) -> list[str]:
    found = _LETTERS.findall(text.lower()) if text else []
    if not any(any(map(str.isalpha, w)) for w in found):
        return []
    if max(map(len, found)) <= LONGEST:
        return found
    return [w[i:i + LONGEST] for w in found for i in range(0, len(w), LONGEST)]


def word_features(tokens: list[str]) -> np.ndarray:
    """(words, features) hashed ids of prefixes and suffixes of one to three
    letters and of letter bigrams and trigrams; 0 stands for none."""
    wide = max(4, max(map(len, tokens), default=0))
    c = np.array(tokens, f"U{wide}").view(np.uint32).reshape(len(tokens), wide).astype(np.uint64)
    n = (c > 0).sum(axis=1)
    rows, out = np.arange(len(tokens)), []

    def add(kind: int, chars: list[np.ndarray], ok: np.ndarray) -> None:
        h = np.full(len(tokens), kind, np.uint64)
        for x in chars:
            h = mix64(h * np.uint64(0x10001) + x + np.uint64(1))
        out.append(np.where(ok, 1 + h % np.uint64(FEATURES - 1), 0))
    for size in (1, 2, 3):
        add(size, [c[:, j] for j in range(size)], n >= size)
        add(3 + size, [c[rows, np.maximum(n - size + j, 0)] for j in range(size)], n >= size)
    for size in (2, 3):
        for at in range(wide - size + 1):
            add(6 + size, [c[:, at + j] for j in range(size)], n >= at + size)
    return np.stack(out, axis=1).astype(np.int32)


def count_lexicon(rows: DataFrame, langs: list[str]) -> np.ndarray:
    """(BUCKETS, languages) word counts over all training rows."""
    number = {x: i for i, x in enumerate(langs)}

    def run(batches):
        total = np.zeros((BUCKETS, len(langs)), np.int64)
        for batch in batches:
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                h = word_hashes(letter_words(text)) % np.uint32(BUCKETS)
                total[:, number[lang]] += np.bincount(h, minlength=BUCKETS) if len(h) > BUCKETS // 8 else 0
                if len(h) <= BUCKETS // 8:
                    np.add.at(total[:, number[lang]], h, 1)
        b, k = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(b * len(langs) + k), pa.array(total[b, k])], ["at", "n"])
    found = rows.select("text", "lang").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(BUCKETS * len(langs))
    out[found["at"].to_numpy(np.int64)] = found["n"].to_numpy(np.float64)
    return out.reshape(BUCKETS, len(langs))


@dataclass
class Crf:
    langs: list[str]
    lexicon: np.ndarray  # (BUCKETS, L) log odds
    weights: np.ndarray  # (FEATURES, L)
    trust: np.ndarray  # (L,) weight of the lexicon
    change: np.ndarray  # (L, L) transition scores
    start: np.ndarray  # (L,)
    known: dict = field(default_factory=dict)
    table: np.ndarray | None = None

    def emissions(self, tokens: list[str]) -> np.ndarray:
        f = word_features(tokens)
        lex = self.lexicon[word_hashes(tokens) % np.uint32(BUCKETS)]
        return (self.weights[f].sum(axis=1) + lex * self.trust).astype(np.float32)

    def look_up(self, docs: list[list[str]]) -> np.ndarray:
        """Emission rows of all words of ``docs``, remembering known words."""
        new = list({w for d in docs for w in d if w not in self.known})
        if len(self.known) + len(new) > REMEMBER:
            self.known, self.table = {}, None
            new = list({w for d in docs for w in d})
        if new:
            rows = np.concatenate([self.emissions(new[i:i + 8192]) for i in range(0, len(new), 8192)])
            at = len(self.known)
            self.known.update((w, at + i) for i, w in enumerate(new))
            self.table = rows if self.table is None else np.concatenate([self.table, rows])
        n = sum(map(len, docs))
        return self.table[np.fromiter((self.known[w] for d in docs for w in d), np.int64, n)] if n else np.zeros((0, len(self.langs)), np.float32)

    def marginals(self, emissions: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Posterior label probabilities of every word; ``sizes`` cuts the rows
        into texts (none empty)."""
        L = len(self.langs)
        A = np.exp(self.change - self.change.max())
        blocks = -(-sizes // BLOCK)
        first = np.concatenate([[0], np.cumsum(blocks)])  # a text's first block
        word0 = np.concatenate([[0], np.cumsum(sizes)])
        doc = np.repeat(np.arange(len(sizes)), blocks)
        inside = np.arange(first[-1]) - first[doc]
        begin = word0[doc] + inside * BLOCK
        length = np.minimum(BLOCK, word0[doc + 1] - begin)
        t = np.arange(BLOCK)
        ok = t < length[:, None]
        at = np.minimum(begin[:, None] + t, len(emissions) - 1)
        e = np.exp(emissions - emissions.max(axis=1, keepdims=True))[at].astype(np.float64)
        K = len(doc)
        M = np.broadcast_to(np.eye(L), (K, L, L)).copy()
        for j in range(BLOCK):
            step = (M @ A) * e[:, j, None, :]
            step /= step.sum(axis=(1, 2), keepdims=True)
            M = np.where(ok[:, j, None, None], step, M)
        a, b = np.zeros((K, L)), np.ones((K, L))
        a[first[:-1]] = np.exp(self.start - self.start.max())
        b[first[1:] - 1] = 1 / L
        for i in range(1, int(blocks.max())):
            live = np.flatnonzero(blocks > i)
            k = first[live] + i
            x = np.einsum("kl,klm->km", a[k - 1], M[k - 1])
            a[k] = x / x.sum(axis=1, keepdims=True)
            k = first[live + 1] - i
            x = np.einsum("klm,km->kl", M[k], b[k])
            b[k - 1] = x / x.sum(axis=1, keepdims=True)
        alpha = np.empty((K, BLOCK, L))
        for j in range(BLOCK):
            x = (a @ A) * e[:, j]
            x /= x.sum(axis=1, keepdims=True)
            a = np.where(ok[:, j, None], x, a)
            alpha[:, j] = a
        post = np.empty((K, BLOCK, L))
        for j in range(BLOCK - 1, -1, -1):
            p = alpha[:, j] * b
            post[:, j] = p / p.sum(axis=1, keepdims=True)
            x = (e[:, j] * b) @ A.T
            x /= x.sum(axis=1, keepdims=True)
            b = np.where(ok[:, j, None], x, b)
        return post[ok]

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        docs = [letter_words(t) for t in texts]
        out: list[tuple[str, float]] = [("und", 0.0)] * len(docs)
        if not self.langs:
            return out
        full = [i for i, d in enumerate(docs) if d]
        for a in range(0, len(full), 256):
            part = full[a:a + 256]
            sizes = np.array([len(docs[i]) for i in part])
            post = self.marginals(self.look_up([docs[i] for i in part]), sizes)
            share = np.add.reduceat(post, np.concatenate([[0], np.cumsum(sizes)[:-1]]), axis=0) / sizes[:, None]
            for i, s in zip(part, share, strict=True):
                k = int(s.argmax())
                out[i] = (self.langs[k], float(min(1.0, s[k])))
        return out


def _sequences(sample: pd.DataFrame, langs: list[str], size: int = 128, seed: int = 5):
    """Code-switched training sequences: passages of 16 to 64 words."""
    rng = np.random.default_rng(seed)
    pools = []
    for x in langs:
        pool = [w for t in sample.loc[sample["lang"] == x, "text"] for w in t.split(" ")]
        pools.append(pool or ["?"])
    seqs, tags = [], []
    for _ in range(min(800, max(40, sum(map(len, pools)) // size))):
        seq, tag = [], []
        while len(seq) < size:
            k, n = int(rng.integers(len(langs))), int(rng.integers(16, 65))
            at = int(rng.integers(max(1, len(pools[k]) - n)))
            seq += pools[k][at:at + n]
            tag += [k] * len(pools[k][at:at + n])
        seqs.append(seq[:size])
        tags.append(tag[:size])
    return seqs, np.array(tags)


def fit(sample: pd.DataFrame, langs: list[str], counts: np.ndarray) -> Crf:
    """Gradient ascent (per-weight step sizes) on the sequences' likelihood."""
    L = len(langs)
    prior = (counts.sum(axis=0) + 1) / (counts.sum() + L)
    odds = np.log((counts + 2 * prior) / (counts.sum(axis=1, keepdims=True) + 2)) - np.log(prior)
    crf = Crf(langs, np.clip(odds, -6, 6).astype(np.float32), np.zeros((FEATURES, L), np.float32), np.full(L, 0.5), np.zeros((L, L)), np.zeros(L))
    if L < 2:
        return crf
    seqs, tags = _sequences(sample, langs)
    vocabulary = sorted({w for s in seqs for w in s})
    number = {w: i for i, w in enumerate(vocabulary)}
    ids = np.array([[number[w] for w in s] for s in seqs])
    B, n = ids.shape
    feats = np.concatenate([np.pad(f := word_features(vocabulary[i:i + 8192]), ((0, 0), (0, 80 - f.shape[1]))) for i in range(0, len(vocabulary), 8192)])
    feats = feats[:, (feats > 0).any(axis=0)]
    lex = crf.lexicon[word_hashes(vocabulary) % np.uint32(BUCKETS)]
    gold = np.zeros((len(vocabulary), L))
    np.add.at(gold, ids.ravel(), np.eye(L)[tags.ravel()])
    pairs = np.zeros((L, L))
    np.add.at(pairs, (tags[:, :-1].ravel(), tags[:, 1:].ravel()), 1)
    memory = {k: np.full(getattr(crf, k).shape, 1e-6) for k in ("weights", "trust", "change")}
    for _ in range(EPOCHS):
        emission = crf.weights[feats].sum(axis=1) + lex * crf.trust
        e = np.exp(emission - emission.max(axis=1, keepdims=True))[ids]
        A = np.exp(crf.change - crf.change.max())
        alpha, beta = np.empty((n, B, L)), np.empty((n, B, L))
        x = np.ones((B, L))
        for j in range(n):
            x = (x @ A) * e[:, j]
            x /= x.sum(axis=1, keepdims=True)
            alpha[j] = x
        x = np.ones((B, L)) / L
        expected = np.zeros((L, L))
        for j in range(n - 1, -1, -1):
            beta[j] = x
            out = e[:, j] * x
            if j:
                joint = alpha[j - 1][:, :, None] * A * out[:, None, :]
                expected += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            x = out @ A.T
            x /= x.sum(axis=1, keepdims=True)
        post = alpha * beta
        post /= post.sum(axis=2, keepdims=True)
        soft = np.zeros((len(vocabulary), L))
        np.add.at(soft, ids.T.ravel(), post.reshape(-1, L))
        d = gold - soft
        grads = {"weights": np.stack([np.bincount(feats.ravel(), np.repeat(d[:, k], feats.shape[1]), FEATURES) for k in range(L)], axis=1),
                 "trust": (d * lex).sum(axis=0), "change": pairs - expected}
        grads["weights"][0] = 0
        for k, g in grads.items():
            g = g - (0.05 * getattr(crf, k) if k == "weights" else 0)
            memory[k] += g * g
            setattr(crf, k, getattr(crf, k) + (0.3 if k != "weights" else 0.2) * g / np.sqrt(memory[k]))
    crf.weights = crf.weights.astype(np.float32)
    return crf


def train(docs: DataFrame) -> Crf:
    rows = docs.select("doc_id", "text", "lang").where("text is not null and lang is not null").where(crc_mod("doc_id", FOLDS) != HELD_OUT)
    # at most FIT_ROWS rows per language, chosen by hash of the row; the limit
    # per group is pushed below the shuffle
    order = F.xxhash64("doc_id", "text")
    from pyspark.sql import Window
    own = Window.partitionBy("lang").orderBy("o")
    picked = scratch(rows.select("lang", "doc_id", order.alias("o")).withColumn("r", F.row_number().over(own)).where(F.col("r") <= FIT_ROWS).drop("r"), "langid-picked")
    langs = sorted(r["lang"] for r in picked.select("lang").distinct().collect())

    def passages(batches):
        for batch in batches:
            out = []
            for text, o in zip(batch.column("text").to_pylist(), batch.column("o").to_pylist(), strict=True):
                found = letter_words(text)
                at = o % max(1, len(found) - FIT_PASSAGE + 1)
                out.append(" ".join(found[at:at + FIT_PASSAGE]))
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("o"), pa.array(out, pa.string())], ["lang", "o", "text"])
    # the words are cut out where the texts are: FIT_ROWS passages a language reach the driver
    sample = (rows.withColumn("o", order).join(F.broadcast(picked.select("o", F.col("lang").alias("l"))), "o").where("lang = l")
              .select("lang", "o", "text").mapInArrow(passages, "lang string, o long, text string")
              .where("text <> ''").orderBy("lang", "o", "text").toPandas())
    return fit(sample, langs, count_lexicon(rows, langs) if langs else np.zeros((BUCKETS, 0)))


def language(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs))

    @F.pandas_udf("lang_pred string, score double")
    def predict(text: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(shared.value.predict(text.tolist()), columns=["lang_pred", "score"])

    return (docs.select("doc_id", (crc_mod("doc_id", FOLDS) == HELD_OUT).alias("held_out"), predict("text").alias("p"))
            .select("doc_id", "held_out", "p.lang_pred", "p.score"))
