"""The pipeline against its stages' brute-force effects, and the SQL twins."""

import os
import random

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from lumenfold.llm import queries, sp_codec
from lumenfold.llm.oracles import ORACLES
from tests.llm.test_operators import VOCAB, brute_groups, brute_windows, split


def test_pipeline(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    seen = {}
    from lumenfold.plans.shared import materialize

    for n, f in corpus_pipeline.STAGES:
        before, docs = docs, materialize(f(spark, docs, small), n)
        seen[n] = (before, docs)
        if n != "sentencepiece":
            assert docs.columns == before.columns
    rows = lambda d: [tuple(r) for r in d.select("doc_id", "text").collect()]
    a, b = seen["quality_classifier"]
    lab = spark.read.parquet(f"{small}/labels.parquet").where("quality = 1").select("doc_id")
    good = a.join(lab, "doc_id", "left_semi").count()
    assert b.join(lab, "doc_id", "left_semi").count() >= 0.97 * good
    a, b = seen["jaccard_join"]
    assert sorted(r[0] for r in rows(b)) == sorted(i for i, _, c in brute_groups(rows(a), 5, 80) if i == c)
    a, b = map(rows, seen["substring_dedup"])
    first, left = brute_windows(a, 13), dict(b)
    for i, t in a:
        w = split(t)
        drop = set()
        for k in range(len(w) - 12):
            if min(first[tuple(w[k : k + 13])]) < i:
                drop |= set(range(k, k + 13))
        if drop and len(drop) == len(w):
            assert i not in left
        else:
            assert left[i] == (t if not drop else b" ".join(x for k, x in enumerate(w) if k not in drop).decode())
    a, b = map(rows, seen["decontamination"])
    bench = [r.text.rstrip(".").split() for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    whole = lambda t: any(" " + " ".join(x) in " " + " ".join(t.split()) for x in bench)
    assert not any(whole(t) for _, t in b) and {i for i, _ in a} - {i for i, _ in b} >= {i for i, t in a if whole(t)}
    assert seen["sentencepiece"][1].count() == len(b)


ODD = "doc_id long, text string, lang string, source string, n_chars int, __score double, __text string, __bad long, __cut_kept string, k0 string, row_key long, h long, copies int"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows and ids, near copies, clashing names."""
    r = random.Random(12)
    word = lambda n: " ".join(r.choice(VOCAB) + r.choice(VOCAB) for _ in range(n))
    a, b, long = word(60), word(40), word(30_000)
    texts = [(1, a), (1, a), (2, a + " more"), (3, None), (3, None), (4, ""), (5, " \n"), (None, a), (None, None), (6, b), (6, word(50)), (7, long), (8, long + " end"), (9, word(30) + " " + b), (10, "é \ue000 ▁"), (2**61, word(20)), (2**61 + 1, word(25))]
    rows = [(i, t, None if k % 3 else "en", None, None if k % 4 else len(t or ""), 0.5, "x", 1, "kept", "k", 2, None, 4) for k, (i, t) in enumerate(texts)]
    return rows, spark.createDataFrame(rows, ODD).repartition(3).cache()


def test_stages_on_odd_rows(spark, odd, small):
    rows, docs = odd
    key = lambda x: sorted(map(str, x))
    stages = dict(corpus_pipeline.STAGES)
    for name, stage in list(stages.items())[:4]:
        out = stage(spark, docs, small)
        assert out.columns == docs.columns and stage(spark, docs.where("doc_id < 0"), small).count() == 0, name
        for x in out.collect():
            assert x["__score"] == 0.5 and x["copies"] == 4 and x["h"] is None, name
    near = [(x.doc_id, x.text) for x in stages["jaccard_join"](spark, docs, small).collect()]
    # 2 is a copy of 1, 8 of 7; 1 and 6 stay once; texts without words and rows without an id stay
    smallest = min(t for i, t, *_ in rows if i == 6)
    want = [(i, t) for i, t, *_ in rows if i not in (1, 2, 6, 8)] + [(1, rows[0][1]), (6, smallest)]
    assert key(near) == key(want)
    leaks = [(x.doc_id, x.text) for x in stages["decontamination"](spark, docs, small).collect()]
    assert key(leaks) == key((r[0], r[1]) for r in rows)
    cut = {x.doc_id: x for x in stages["substring_dedup"](spark, docs, small).collect()}
    assert cut[9].text == " ".join(rows[13][1].split()[:30]) and 1 in cut and cut[3].text is None and cut[2].text == "more"
    ids = stages["sentencepiece"](spark, docs, small).collect()
    codec = sp_codec.codec(queries.vocabulary())
    back = [(x.doc_id, None if x.ids is None else codec.decode(np.array(x.ids, np.int32).tobytes())) for x in ids]
    assert key(back) == key((r[0], r[1]) for r in rows) and all(x.n_tokens == len(x.ids or []) for x in ids)


def test_quality_stage_without_labels_keeps_all(spark, odd, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.keep_quality(spark, odd[1], str(tmp_path)).count() == len(odd[0])


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, small, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        assert os.path.exists(f"{small}/{t}.parquet")
        con.execute(f"create view {t} as select * from '{small}/{t}.parquet'")
    got, want = queries.QUERIES[name](spark, small).toPandas(), con.execute(ORACLES[name]).fetchdf()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    key = lambda df: sorted(map(str, df[cols].astype(object).where(df[cols].notna(), None).values.tolist()))
    assert key(got) == key(want)
