"""Quality rules with suffix-array repetition.

Every text's words form one sequence, and its suffix array is built by prefix
doubling: ranks by the first 2^j words, only suffixes still tied being sorted
again. The common prefix of neighbours in the array comes from the same ranks.
The deepest longest-common-prefix interval a suffix lies in gives the longest
repeat that begins there; one that the suffix before does not reach over is
maximal. The spans of all repeats of at least ``MIN_WORDS`` words are united,
and a text is rejected where they cover more than ``MAX_PERCENT`` of its words,
or where one repeat is longer than ``MAX_REPEAT`` words. (A short clean text with
one phrase twice is half covered; a long one by chance to a quarter.)

Many texts share one array: words of different texts count as different, and a
mark of its own ends each text, so repeats never leave a text. Rows stay where
they are; nothing is shuffled.

Cases: a null text has no words and fails the base rule like any text of under
ten words; white space is ``[\\x20\\x09-\\x0D]``, other separators belong to
words; texts are read whole at any length, a long one having an array of its
own; repeats that overlap themselves count; repeated rows are judged alike; an
empty table gives an empty result; extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: Base rule: fixed values.
FEWEST_WORDS, WINDOW, BASE_PERCENT = 10, 5, 20
#: Repeats of this many words count; their share of a text's words, in percent,
#: and the longest one's words are limited.
MIN_WORDS, MAX_PERCENT, MAX_REPEAT = 3, 60, 50
#: Bytes of text that share an array.
CHUNK = 1 << 21

_SPACE = r"[\x20\x09-\x0D]+"


def suffix_array(tokens: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array of int ``tokens``, and the ranks by the first 2^j tokens,
    j = 0, 1, ... until no two are equal. A token that ends a text must occur
    once, so that equal prefixes never run over it."""
    n = len(tokens)
    sa = np.argsort(tokens, kind="stable")
    new = np.concatenate([[True], np.diff(tokens[sa]) != 0])
    starts = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[sa] = starts
    levels, tied, k = [], np.arange(n), 1
    while True:
        levels.append(rank.astype(np.int32) if n < 1 << 31 else rank.copy())
        # places of the array whose group has another member
        alone = np.concatenate([new, [True]])
        tied = tied[~(alone[:-1] & alone[1:])]
        if not len(tied):
            return sa, levels
        at = sa[tied]
        key = rank[at] * n + rank[at + k]
        order = np.argsort(key, kind="stable")
        at, key = at[order], key[order]
        sa[tied] = at
        new = np.concatenate([[True], np.diff(key) != 0])
        rank[at] = np.maximum.accumulate(np.where(new, tied, 0))
        k *= 2


def common_prefixes(sa: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Tokens that suffix sa[r] shares with sa[r - 1] (the first: 0)."""
    lcp = np.zeros(len(sa), np.int64)
    pairs = np.flatnonzero(levels[0][sa[1:]] == levels[0][sa[:-1]]) + 1
    a, b = sa[pairs - 1], sa[pairs]
    got = np.zeros(len(pairs), np.int64)
    for j in range(len(levels) - 2, -1, -1):
        got += np.where(levels[j][a + got] == levels[j][b + got], 1 << j, 0)
    lcp[pairs] = got
    return lcp


def longest_repeats(tokens: np.ndarray) -> np.ndarray:
    """For each place, the words of the longest repeat beginning there: the
    depth of the deepest common-prefix interval the suffix lies in."""
    sa, levels = suffix_array(tokens)
    lcp = common_prefixes(sa, levels)
    out = np.empty(len(sa), np.int64)
    out[sa] = np.maximum(lcp, np.concatenate([lcp[1:], [0]]))
    return out


def united(longest: np.ndarray, least: int) -> np.ndarray:
    """Whether each place lies in a repeat of at least ``least`` words."""
    at = np.arange(len(longest))
    return np.maximum.accumulate(np.where(longest >= least, at + longest, 0)) > at


def _chunks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``CHUNK`` bytes, whole texts only."""
    size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(size, (size[a - 1] if a else 0) + CHUNK, "right")))
        yield a, b
        a = b


def _pieces(lists: pa.ListArray) -> tuple[np.ndarray, pa.Array]:
    """(index of the list, value) of every value of a list column."""
    sizes = np.diff(lists.offsets.to_numpy())
    return np.repeat(np.arange(len(lists)), sizes), lists.flatten()


def _measure(texts: pa.Array) -> dict[str, pa.Array]:
    """All columns but doc_id for some texts without nulls."""
    n = len(texts)
    doc, word = _pieces(pc.split_pattern_regex(texts, _SPACE))
    real = pc.binary_length(word).to_numpy(zero_copy_only=False) > 0
    doc, word = doc[real], word.filter(pa.array(real))
    coded = word.dictionary_encode()
    ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    chars = pc.utf8_length(coded.dictionary).to_numpy(zero_copy_only=False).astype(np.int64)
    n_words = np.bincount(doc, minlength=n)
    # words of a text, then its end mark; a word of one text is another's neither in rank nor order
    ends = np.cumsum(n_words) + np.arange(n)
    tokens = np.empty(len(doc) + n, np.int64)
    place = np.arange(len(doc)) + doc
    span = len(chars) + 1
    tokens[place] = doc * span + ids
    tokens[ends] = np.arange(n) * span + span - 1
    longest = longest_repeats(tokens)
    first = np.concatenate([[0], ends[:-1] + 1])
    whole = np.maximum.reduceat(longest, first)
    in_window, covered = united(longest, WINDOW), united(longest, MIN_WORDS)

    def per_text(flag: np.ndarray) -> np.ndarray:
        return np.add.reduceat(flag.astype(np.int64), first)
    line_doc, line = _pieces(pc.split_pattern(texts, "\n"))
    real = pc.match_substring_regex(line, r"[^\x20\x09-\x0D]").to_numpy(zero_copy_only=False)
    line_doc, line = line_doc[real], line.filter(pa.array(real)).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    distinct = np.unique(line_doc * (int(line.max(initial=0)) + 1) + line)
    kinds = np.bincount((distinct // (int(line.max(initial=0)) + 1)).astype(np.int64), minlength=n)
    repeated, united_words = per_text(in_window), per_text(covered)
    failed = (n_words < FEWEST_WORDS) | (100 * repeated > BASE_PERCENT * n_words)
    # the runs of united spans: words from 0 in the text
    edge = np.diff(np.concatenate([[0], covered.astype(np.int8), [0]]))
    a, b = np.flatnonzero(edge > 0), np.flatnonzero(edge < 0)
    of = np.searchsorted(ends, a)
    spans = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(np.bincount(of, minlength=n))]).astype(np.int32),
                                     pa.StructArray.from_arrays([pa.array(a - first[of]), pa.array(b - a)], ["start", "words"]))
    return {"n_words": pa.array(n_words.astype(np.int64)), "word_chars": pa.array(np.bincount(doc, chars[ids], minlength=n).astype(np.int64)),
            "n_symbols": pc.count_substring_regex(texts, r"[#*$%&|<>]").cast(pa.int64()),
            "n_dup_lines": pa.array((np.bincount(line_doc, minlength=n) - kinds).astype(np.int64)),
            "n_repeat_words": pa.array(repeated), "base_failed": pa.array(failed),
            "kept": pa.array(~failed & (100 * united_words <= MAX_PERCENT * n_words) & (whole <= MAX_REPEAT)),
            "united_words": pa.array(united_words), "longest_repeat": pa.array(whole), "spans": spans}


def judge_quality(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, united_words, longest_repeat, spans (start and words of
    the united repeats) for every row of ``docs``."""
    def run(batches):
        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "")
            for a, b in _chunks(texts):
                out = _measure(texts.slice(a, b - a))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), *out.values()], ["doc_id", *out])
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
             "base_failed boolean, kept boolean, united_words long, longest_repeat long, spans array<struct<start: long, words: long>>")
