"""The pipeline's stages one after the other, and the digest queries against their SQL."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from assaylake.llm import entries, near_copies, pii
from assaylake.llm._common import written
from assaylake.llm.simhash import shingle_hashes

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = entries.table(spark, SF, "documents")
    out = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF))
        out[name] = docs
    return out


def test_stages(stages):
    names = list(stages)
    assert names[1:] == ["language_id", "line_dedup", "simhash_near_dedup", "pii", "packing"]
    for name in names[1:-1]:
        assert stages[name].columns == stages["documents"].columns
        assert stages[name].where("n_chars != length(text)").count() == 0
    assert stages["language_id"].count() == stages["documents"].count()  # all of these have letters and a language


def test_near_copies_are_gone(stages):
    before, after = ({r["doc_id"]: set(shingle_hashes((r["text"] or "").encode(), 5).tolist()) for r in stages[n].collect()} for n in ("line_dedup", "simhash_near_dedup"))
    near = lambda a, b: len(a & b) >= 0.8 * len(a | b)
    kept = list(after.items())
    assert not any(near(a, b) for i, (_, a) in enumerate(kept) for _, b in kept[i + 1 :])
    assert all(any(near(a, b) for b in after.values()) or any(near(a, c) and i != j for j, c in before.items()) for i, a in before.items())
    assert set(after) == set(kept_by_components(before))  # the smallest of each group and no other
    lonely = {i for i, a in before.items() if not any(near(a, b) for j, b in before.items() if j != i)}
    assert lonely <= set(after)


def kept_by_components(sets):
    root = {i: i for i in sets}
    ids = sorted(sets)
    changed = True
    while changed:
        changed = False
        for i in ids:
            for j in ids:
                a, b = sets[i], sets[j]
                if root[i] != root[j] and (len(a & b) >= 0.8 * len(a | b)):
                    root[i] = root[j] = min(root[i], root[j])
                    changed = True
    return [i for i in ids if root[i] == i]


def test_personal_data_is_gone(stages):
    assert any(pii.base_spans(r["text"]) for r in stages["simhash_near_dedup"].collect())
    assert not any(pii.base_spans(r["text"]) for r in stages["pii"].collect())


def test_run_gives_the_last_stage(spark, stages):
    key = lambda df: sorted((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in df.collect())
    assert {k[0] for k in key(corpus_pipeline.run(spark, SF))} == {k[0] for k in key(stages["packing"])}


def test_rejected_and_null_rows(spark):
    rows = spark.createDataFrame([(1, None, "en", "s", 0), (2, "123 !!", "en", "s", 7), (3, "Words that are fine", None, None, 19), (8, "More words of this kind", "en", "s", 23)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.language(spark, rows, SF)
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 8]
    unlabelled = rows.withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.language(spark, unlabelled, SF).count() == 0  # without a learned language nothing is probable
    for _, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, rows, SF).count() > 0 and stage(spark, rows.limit(0), SF).count() == 0


@pytest.mark.parametrize("name", list(entries.oracle_sql()))
def test_oracles(spark, name):
    db = duckdb.connect()
    for f in os.listdir(SF):
        db.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{SF}/{f}')")
    want = db.sql(entries.oracle_sql()[name])
    got = entries.queries()[name](spark, SF).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def test_recall_at_the_threshold():
    """Pairs of random sets at a similarity of exactly 0.8, beyond the sizes that meet exactly, are within the radii."""
    import numpy as np

    near, far = near_copies.radii(0.8)
    rng = np.random.default_rng(0)
    missed = 0
    for part in (8, 30):
        for k in range(800):
            h = rng.integers(0, 2**64, 10 * part, dtype=np.uint64)
            a, b = (h[: 9 * part], h[part:]) if k % 2 else (h[: 8 * part], h)  # eight of ten shared, in sets of one size or one within the other
            bits = [(x ^ y).bit_count() for x, y in zip(near_copies.words_of(np.unique(a)), near_copies.words_of(np.unique(b)))]
            missed += bits[0] > near or sum(bits) > far
    assert missed <= 8
