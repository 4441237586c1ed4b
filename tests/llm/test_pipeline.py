import random
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline as cp
from annualis.llm.common import written
from annualis.llm.neighbour_quality import fit, score

from .conftest import SF
from .test_operators import all_texts, brute_components, brute_simhash, pii_spans


def test_stages_against_brute_force(llm, docs):
    kept = docs
    labels = llm.read.parquet(f"{SF}/labels.parquet")
    good = {r["doc_id"] for r in score(docs, fit(docs, labels)).filter("predicted = 1").collect()}
    texts = {i: t for i, t in all_texts(docs).items() if i in good}
    for name, stage in cp.STAGES:
        before = texts
        out = stage(llm, kept, SF)
        if name == "packing":
            rows = out.collect()
            assert {r["doc_id"] for r in rows} == set(texts)
            break
        assert out.columns == docs.columns
        if name == "exact_dedup":
            last = {}
            for i, t in texts.items():
                last[t] = max(i, last.get(t, i))
            texts = {i: t for i, t in texts.items() if last[t] == i}
        elif name == "near_dedup":
            groups = brute_components({i: brute_simhash(t) for i, t in texts.items()})
            texts = {i: t for i, t in texts.items() if groups[i] == i}
        got = all_texts(out)
        assert set(got) == set(texts)
        if name == "pii":
            for i, t in got.items():
                assert not [s for s in pii_spans(t) if s.startswith("email")]
                assert t.split()[:1] == before[i].split()[:1] or "[" in t.split()[0]
            texts = got
        else:
            assert got == texts
        kept = llm.createDataFrame(out.collect(), docs.schema)


def test_stages_on_odd_and_empty_rows(llm, odd, none):
    """All stages, quality too, also where documents have a column named like one of the operators'."""
    for source in (odd, none):
        docs = source.select("doc_id", "text", "lang", "source", "n_chars").withColumn("text_sha256", F.lit("own"))
        for name, stage in cp.STAGES:
            out = stage(llm, docs, SF)
            if name != "packing":
                assert out.columns == docs.columns
                assert out.filter("text_sha256 <> 'own' OR text_sha256 IS NULL").count() == 0
                docs = docs if name == "quality" else out
            assert out.count() >= (source is odd and name != "quality")
    exact = cp.exact(llm, odd.select("doc_id", "text", "lang", "source", "n_chars"), SF)
    assert exact.filter("doc_id = 2").count() == 1  # repeated rows leave one
    assert exact.filter("doc_id = 1").count() == 0 and exact.filter("doc_id = 4").count() == 1


def table(llm, rows):
    return llm.createDataFrame([(i, t, None, None, None) for i, t in rows],
                               "doc_id long, text string, lang string, source string, n_chars long")


def test_near_copies_go_by_id_and_text(llm):
    """Unrelated texts under the id, or the null id, of a near copy stay."""
    def text(seed):
        rng = random.Random(seed)
        return [f"w{rng.randrange(10**6)}" for _ in range(900)]
    base, other = text(1), text(2)
    copy = " ".join(base[:-1])
    assert bin(brute_simhash(copy) ^ brute_simhash(" ".join(base))).count("1") <= 2
    rows = [(1, " ".join(base)), (7, copy), (7, " ".join(text(3))), (None, copy + "  "), (None, " ".join(text(4))),
            (None, " ".join(other)), (None, " ".join(other) + " ")]
    got = [(r["doc_id"], r["text"]) for r in cp.near(llm, table(llm, rows), SF).collect()]
    assert set(got) > {rows[0], rows[2], rows[4]} and len(got) == 4
    assert len(set(got) & {rows[5], rows[6]}) == 1


def test_run(llm):
    """The last stage's rows, as the stages give them one after the other."""
    docs = llm.read.parquet(f"{SF}/documents.parquet")
    for _, stage in cp.STAGES:
        docs = written(stage(llm, docs, SF), "test-stage")
    want = Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in docs.collect())
    rows = cp.run(llm, SF).collect()
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want and rows
    assert [n for n, _ in cp.STAGES] == ["quality", "exact_dedup", "near_dedup", "pii", "packing"]
