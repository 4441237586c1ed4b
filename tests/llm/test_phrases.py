"""Phrases by dynamic itemset counting against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from annualis.llm import phrases as ph
from annualis.llm.queries import QUERIES

from .conftest import SF

SCHEMA = "doc_id long, text string, lang string, size long, phrase string, shard long, n long"


def pieces(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [[w for w in re.split(r"[\x20\t]+", p) if w] for p in re.split(r"[.,;:!?\x0A-\x0D]", lowered)]


def brute(rows, threshold=100, longest=5, top=2000, cover=100):
    """[(lang, rank, phrase, a, l, r, n, score)] of (lang, text) rows."""
    out = []
    by_lang = {}
    for lang, text in rows:
        by_lang.setdefault(lang or "und", []).append(text)
    for lang, texts in by_lang.items():
        f = Counter(tuple(p[k:k + m]) for t in texts for p in pieces(t)
                    for m in range(1, longest + 1) for k in range(len(p) - m + 1))
        n = sum(c for x, c in f.items() if len(x) == 1)
        found = {x: a for x, a in f.items() if len(x) > 1 and a >= threshold}
        longer = {}
        for x, a in found.items():
            for m in range(2, len(x)):
                for k in range(len(x) - m + 1):
                    longer[x[k:k + m]] = max(a, longer.get(x[k:k + m], 0))
        rows_ = []
        for x, a in found.items():
            if 100 * longer.get(x, -1) >= cover * a:
                continue
            score, k = min((1000 * a * n // (f[x[:k]] * f[x[k:]]), k) for k in range(1, len(x)))
            rows_.append((-score, -a, " ".join(x).encode(), f[x[:k]], f[x[k:]]))
        out += [(lang, i, p.decode(), -a, left, r, n, -s) for i, (s, a, p, left, r) in enumerate(sorted(rows_)[:top], 1)]
    return sorted(out)


def table(llm, rows):
    return llm.createDataFrame([(k, t, lang, 1, "x", 2, 3) for k, (lang, t) in enumerate(rows)], SCHEMA)


def found(df):
    return sorted(tuple(r) for r in df.collect())


def test_query(llm, docs):
    want = brute([(r["lang"], r["text"]) for r in docs.select("lang", "text").collect()])
    assert found(QUERIES["op11_phrases"](llm, SF)) == want and want


@pytest.mark.parametrize("shards,slots", [(1, 1 << 20), (3, 1 << 20), (4, 64), (7, 4096)])
def test_any_shards_and_a_full_filter(llm, shards, slots):
    """The cycle's length and a table that is nearly full change nothing in the result."""
    rng = random.Random(shards)
    rows = []
    for k in range(300):
        words = rng.choices("a b c d e f g hh ii jj Kk Ll ñ é".split(), weights=[9, 8, 7, 6, 5, 4, 3, 3, 2, 2, 1, 1, 1, 1],
                            k=rng.randrange(30))
        rows.append((rng.choice(["en", None, "de"]), "".join(w + rng.choice([" ", " ", "\t", ". ", "\n"]) for w in words)))
    want = brute(rows, 12, 5, 40)
    assert found(ph.collocations(table(llm, rows), 12, 5, 40, shards=shards, filter_slots=slots)) == want
    assert len(want) > 40
    assert found(ph.collocations(table(llm, rows), 12, 3, 40, 60, shards)) == brute(rows, 12, 3, 40, 60)


def test_late_words_still_become_phrases(llm):
    """What reaches the threshold in the last shard only is counted in a later cycle."""
    rows = [("en", "x y z w v")] * 9 + [("en", "p q")] * 3
    assert found(ph.collocations(table(llm, rows), 9)) == brute(rows, 9)
    assert [r[2] for r in brute(rows, 9)] == ["x y z w v"]


@given(st.text(alphabet=st.sampled_from(list("aB .,\t\né")), max_size=80), st.integers(1, 12))
@settings(max_examples=200, deadline=None)
def test_sections_do_not_cut_phrases(text, section):
    whole = Counter(tuple(p[k:k + m]) for p in pieces(text) for m in range(1, 6) for k in range(len(p) - m + 1))
    got = Counter()
    for words, n in ph.tokens(text, section=section):
        names = [w.decode() for w in words]
        got.update(tuple(names[k:k + m]) for k in range(n) for m in range(1, 6)
                   if k + m <= len(names) and "." not in names[k:k + m])
    assert got == whole


def test_scores_are_exact_beyond_64_bits(llm):
    n, a, left, r = 9 * 10**12, 7 * 10**11, 8 * 10**11, 9 * 10**11 + 7
    df = llm.createDataFrame([("en", 0, "", n), ("en", 1, "x", left), ("en", 1, "y", r), ("en", 2, "x y", a)],
                             "lang string, size int, phrase string, n long")
    row = ph.scored(df).first()
    assert (row["n"], row["score"]) == (n, 1000 * a * n // (left * r))


def block(text, skip=()):
    words = text.encode().split()
    names = list(dict.fromkeys(words))
    ids = np.array([names.index(w) for w in words], "<u2").tobytes()
    return ph.Block("en", b" ".join(names), ids, np.array(skip, "<u4").tobytes())


def test_hashes_and_words_count_the_same():
    """With all slots set, both ways to count see every phrase, and phrases end at END marks."""
    times = np.zeros(97, dtype=np.uint8)
    one = block("a b a b c . a b")
    names = {p.decode(): int(k) for _, part, n in ph.counted(one, times, 5) for p, k in zip(part.to_pylist(), n)}
    assert names == {"a": 3, "b": 3, "c": 1, "a b": 3, "b a": 1, "b c": 1, "a b a": 1, "b a b": 1, "a b c": 1,
                     "a b a b": 1, "b a b c": 1, "a b a b c": 1}
    found = np.concatenate(list(ph.active_hashes(one, times, 0, 4, 5)))
    assert sorted(np.unique(found, return_counts=True)[1].tolist()) == sorted(names.values())
    assert sum(n.sum() for _, _, n in ph.counted(block("a b a b c . a b", [3, 4]), times, 2)) == 5 + 4


def test_a_cycle_is_one_scan_of_each_shard():
    """A phrase is counted from the border at which both parts have their share, in as many scans as shards."""
    one, size = block("a b c"), 1 << 12
    times = np.full(size, ph.NEVER, dtype=np.uint8)
    a, b, c = ph.salted(one.hashes, "en")
    for h, border in ((a, 1), (b, 2), (c, 9)):
        times[ph.slots(np.array([h], dtype=np.uint64), size)] = border
    steps = [sum(map(len, ph.active_hashes(one, np.where(times <= k, times, np.uint8(ph.NEVER)), k, 4, 5))) for k in range(14)]
    assert steps == [3, 3, 4, 4, 1, 1, 0, 0, 0, 1, 1, 1, 1, 0]


def test_a_cycle_starts_when_the_phrase_can_be_scanned():
    """Slots of a part set early by others do not shorten the cycle of a longer phrase."""
    one, size = block("a b c"), 1 << 12
    times = np.full(size, ph.NEVER, dtype=np.uint8)
    ha, hb, hc = one.hashes
    ab, bc = ph.extended(ha, hb), ph.extended(hb, hc)
    for h, border in ((ha, 1), (hb, 1), (hc, 5), (ab, 1), (bc, 2)):  # b c's slots were set by chance
        times[ph.slots(ph.salted(np.array([h], dtype=np.uint64), "en"), size)] = border
    abc = ph.salted(np.array([ph.extended(ab, hc)], dtype=np.uint64), "en")[0]
    steps = [k for k in range(14) for found in ph.active_hashes(
        one, np.where(times <= k, times, np.uint8(ph.NEVER)), k, 4, 5) if abc in found]
    assert steps == [5, 6, 7, 8]


def test_odd_rows(llm, odd, none):
    assert ph.collocations(none).count() == 0 and ph.collocations(odd).count() == 0
    want = brute([(r["lang"], r["text"]) for r in odd.collect()], 4)
    assert found(ph.collocations(odd, 4)) == want and want
