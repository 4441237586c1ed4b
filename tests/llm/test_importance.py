"""Importance resampling against plain Python."""

import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from annualis.llm import importance as im
from annualis.llm.queries import QUERIES

from .conftest import LONG, SF
from .test_operators import all_texts

TEXT = st.text(alphabet=st.sampled_from(list("aBz09 .-é日😀\x7f\n_")), max_size=60)


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def features(text, sizes=(1, 1)):
    ws = words(text)
    return [crc32(" ".join(ws[k:k + m]).encode()) for m in range(sizes[0], sizes[1] + 1) for k in range(len(ws) - m + 1)]


def brute(rows, target, sizes=(1, 1), buckets=10_000, seed=2024, least=20, percent=10):
    found = [(i, [h % buckets for h in features(t, sizes)], len(words(t))) for i, t in rows]
    s, t = Counter(b for _, x, _ in found for b in x), Counter(h % buckets for x in target for h in features(x, sizes))
    n, m = sum(s.values()), sum(t.values())
    out = []
    for i, x, k in found:
        gain = [math.floor(1000 * math.log((t[b] + 1.0) * (n + buckets) / ((s[b] + 1.0) * (m + buckets)))) for b in x]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(x), weight, score, None, k >= least])
    drawn = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0] is None, r[0]))
    for place, r in enumerate(drawn[:percent * len(drawn) // 100], 1):
        r[4] = place
    return sorted((tuple(r[:5]) for r in out), key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@given(TEXT)
@settings(max_examples=300, deadline=None)
def test_ngram_crcs_equal_crc32(text):
    assert im.ngram_crcs(text, (1, 3)).tolist() == features(text, (1, 3))


def test_long_words_and_sections(monkeypatch):
    text = "a" * 300 + " " + "b" * 70_000 + " c " + "dd " * 50
    assert im.ngram_crcs(text, (1, 4)).tolist() == features(text, (1, 4))
    monkeypatch.setattr(im.sections, "__defaults__", (7,))
    assert im.ngram_crcs(text, (2, 3)).tolist() == features(text, (2, 3))


def test_query(llm, docs):
    target = [r["text"] for r in llm.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = found(QUERIES["op12_resampling"](llm, SF))
    assert got == brute(all_texts(docs).items(), target) and any(r[4] for r in got)


@pytest.mark.parametrize("sizes,buckets", [((1, 2), 1000), ((2, 3), 100_000)])
def test_longer_ngrams_and_more_buckets(llm, docs, sizes, buckets):
    target = ["alpha beta gamma", None, "the end of the line"]
    aim = llm.createDataFrame([(k, t) for k, t in enumerate(target)], "doc_id long, text string")
    got = found(im.resample(docs, aim, sizes, buckets, 7, 50, 33))
    assert got == brute(all_texts(docs).items(), target, sizes, buckets, 7, 50, 33)


def test_ranks_of_ties_are_whole(llm):
    """One score for a third of all rows, null ids among them: ranks run from 1 without gaps."""
    rows = [(5, "x y")] * 300 + [(k, f"w{k % 7} z") for k in range(100, 600)] + [(None, "q")] * 200
    df = llm.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = im.resample(df, df, least_words=1, percent=60).collect()
    ranks = sorted(r["rank"] for r in got if r["rank"])
    assert len(got) == 1000 and ranks == list(range(1, 601))
    want = sorted((-r["score"], r["doc_id"] is None, r["doc_id"] or 0) for r in got)
    assert [(-r["score"], r["doc_id"] is None, r["doc_id"] or 0) for r in sorted(
        (r for r in got if r["rank"]), key=lambda r: r["rank"])] == want[:600]


def test_odd_rows(llm, odd, none):
    aim = odd.select("text", "lang", "doc_id")
    got = im.resample(odd, aim, least_words=1, percent=50)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    want = brute(rows, [t for _, t in rows], least=1, percent=50)
    assert [r[:4] for r in found(got)] == [r[:4] for r in want]
    assert sorted(r[4] for r in found(got) if r[4]) == sorted(r[4] for r in want if r[4])
    assert im.resample(none, aim).count() == 0
    assert found(im.resample(odd, none, least_words=1)) is not None
    assert next(r for r in found(got) if r[0] == 5)[1] == len(words(LONG)) and np.isfinite(got.first()["score"])
