"""The n-gram Jaccard join against a comparison of all pairs."""

import random
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from annualis.llm import ngram_jaccard as nj
from annualis.llm.common import Table, written
from annualis.llm.simhash import shingle_hashes

from .conftest import SF
from .test_operators import all_texts


def sets_of(texts, size=5):
    return {i: frozenset(shingle_hashes(t, size)) for i, t in texts.items()}


def brute(texts, size=5):
    """{id: (members, smallest reachable id)}, by all pairs that share anything."""
    sets, root = sets_of(texts, size), {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    by_set = {}
    for i in sorted(texts):
        if sets[i]:
            root[find(i)] = find(by_set.setdefault(sets[i], i))
    holders = {}
    for x, i in by_set.items():
        for h in x:
            holders.setdefault(h, []).append(i)
    shared = {}
    for found in holders.values():
        for pair in combinations(sorted(found), 2):
            shared[pair] = shared.get(pair, 0) + 1
    for (a, b), n in shared.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            lo, hi = sorted((find(a), find(b)))
            root[hi] = lo
    return {i: (len(sets[i]), find(i)) for i in texts}


def found(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def table(llm, texts):
    return llm.createDataFrame(list(texts.items()), "doc_id long, text string")


def words(seed, n):
    rng = random.Random(seed)
    return [f"w{rng.randrange(10**6)}" for _ in range(n)]


def changed(ws, at):
    return " ".join("new" + w if k in at else w for k, w in enumerate(ws))


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_documents(llm, sf):
    docs = llm.read.parquet(f"{sf}/documents.parquet")
    want = brute(all_texts(docs))
    assert found(nj.jaccard_components(docs)) == want
    assert any(i != r for i, (_, r) in want.items()) or sf == SF


@pytest.mark.parametrize("bits,pairs", [(1 << 22, 32), (1 << 15, 0)])
def test_near_copies_chains_and_common_lines(llm, monkeypatch, bits, pairs):
    """Also with a filter that is full, and with a pivot as long as any pair is open."""
    monkeypatch.setattr(nj, "PAIRS_A_MEMBER", pairs)
    base, passage = words(1, 300), " ".join(words(2, 40))
    texts = {k: changed(base, {(7 * k + 31 * j) % 300 for j in range(k % 14)}) for k in range(120)}
    texts |= {1000 + k: passage + " " + " ".join(words(100 + k, 6 + k % 9)) for k in range(80)}
    chain = words(3, 200)
    texts |= {2000 + k: " ".join(chain[10 * k:] + words(500 + k, 10 * k)) for k in range(8)}
    texts |= {3000 + k: " ".join(chain[4 * k:200 - 3 * k]) for k in range(12)}
    texts |= {4000: "", 4001: " \t", 4002: "one two", 4003: "One two", 4004: "one two three four five"}
    assert found(nj.jaccard_components(table(llm, texts), filter_bits=bits)) == brute(texts)


def test_a_line_in_every_text_gives_no_pairs(llm):
    """Texts of one line and two words of their own: no pair is similar, and none is compared."""
    line = " ".join(words(5, 12))
    texts = {k: f"{line} a{k} b{k}" for k in range(600)} | {k: f"x{k} y{k} {line}" for k in range(600, 700)}
    docs = table(llm, texts).selectExpr("doc_id", "text")
    counts = written(nj.sieve_counts(docs, 5), "test-counts")
    marks = nj.marked(docs, Table(llm, nj.bit_table(counts, 1 << 20)), 5).selectExpr("doc_id AS node", "n", "hashes")
    posts = nj.postings(nj.ordered(marks))
    assert posts.count() == 0
    assert found(nj.jaccard_components(docs)) == {k: (10, k) for k in texts}
    texts = {k: f"{line} a{k}" for k in range(300)}  # one word of their own: all pairs are similar
    assert found(nj.jaccard_components(table(llm, texts))) == {k: (9, 0) for k in texts}


def test_templates_of_common_lines(llm):
    """Texts put together from a few common lines, so that lists hold many that are not similar."""
    rng, lines = random.Random(9), [" ".join(words(40 + k, 9)) for k in range(12)]
    texts = {k: " ".join(rng.choices(lines, k=rng.randrange(2, 7))) for k in range(400)}
    assert found(nj.jaccard_components(table(llm, texts))) == brute(texts)


def test_many_copies_and_null_ids(llm, monkeypatch):
    monkeypatch.setattr(nj, "HOT", 50)
    base, other = words(1, 100), words(2, 100)
    rows = [(k + 10, " ".join(base)) for k in range(400)] + [(None, " ".join(base))] * 200
    rows += [(3, changed(base, {50})), (None, " ".join(other)), (7, ""), (8, None), (None, "")]
    df = llm.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = nj.jaccard_components(df).collect()
    assert len(got) == len(rows)
    groups = {(r["doc_id"], r["component_id"]) for r in got}
    assert groups == {(k + 10, 3) for k in range(400)} | {(None, 3), (3, 3), (None, None), (7, 7), (8, 8)}
    assert sum(r["component_id"] is None for r in got) == 2


@given(st.lists(st.lists(st.integers(0, 40), max_size=40), min_size=2, max_size=2))
@settings(max_examples=300, deadline=None)
def test_bounds(two):
    x, y = (np.unique(np.array(s, dtype=np.int64)) for s in two)
    shared = len(set(x) & set(y))
    assert nj.overlap_bound(x, y) >= shared
    if len(x) and len(y):
        assert nj.similar(len(x), len(y), x, y) == (5 * shared >= 4 * (len(x) + len(y) - shared))


@given(st.lists(st.integers(0, 60), min_size=1, max_size=60), st.integers(0, 12), st.integers(0, 12), st.randoms())
@settings(max_examples=300, deadline=None)
def test_the_sieve_keeps_similar_sets(members, fewer, more, rng):
    """A pair of the least index shares enough members within both sieves."""
    hashes = {k: rng.getrandbits(64) for k in range(100)}
    x = {hashes[k] for k in members}
    y = set(sorted(x, key=lambda h: rng.random())[fewer:]) | {hashes[k] for k in range(80, 80 + more)}
    if y and 5 * len(x & y) >= 4 * len(x | y):
        a, b = (np.array(sorted(s), dtype=np.uint64) for s in (x, y))
        both = set(nj.sieve(a).tolist()) & set(nj.sieve(b).tolist())
        for s in (a, b):
            assert len(both) >= nj.lead(len(s) - nj.spare(len(s)))


def test_odd_rows(llm, odd, none):
    got = nj.jaccard_components(odd)
    assert got.columns == ["doc_id", "n_shingles", "component_id"] and got.count() == odd.count()
    by_id = found(got)
    assert by_id[1] == by_id[2] == (1, 1) and by_id[3] == (0, 3) and by_id[4] == (0, 4) and by_id[7] == (0, 7)
    assert by_id[6] == (by_id[5][0] + 1, 5)
    assert nj.jaccard_components(none).count() == 0
