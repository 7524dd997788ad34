"""The pipeline's stages on a small table, one by one."""

import corpus_pipeline as P

from lodestrata.llm import langid, packing, pii, quality_rules, simhash

DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    assert [n for n, _ in P.STAGES] == ["quality_rules", "language_id", "near_duplicates", "personal_data", "best_fit_packing"]
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    want = {
        "quality_rules": lambda d: quality_rules.quality_rules(d).filter("keep"),
        "language_id": lambda d: langid.language_id(d).filter("keep"),
        "near_duplicates": lambda d: simhash.near_duplicates(d).filter("keep"),
        "personal_data": lambda d: d,
    }
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, DIR)
        assert out.columns == docs.columns
        assert ids(out) == ids(want[name](docs))
        if name == "personal_data":
            plain = {r.doc_id: r.text for r in pii.personal_data(docs).collect()}
            assert {r.doc_id: r.text for r in out.collect()} == plain
        docs = out.cache()
    bins = P.STAGES[-1][1](spark, docs, DIR)
    assert set(ids(bins)) == set(ids(docs))
    assert all(r.n <= packing.CAPACITY for r in bins.groupBy("bin_id").sum("n_tokens").toDF("bin_id", "n").collect())
    assert bins.columns == ["bin_id", "place", "doc_id", "start", "n_tokens"]


def test_run_applies_the_stages_one_after_the_other(spark):
    import os

    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    for name, stage in P.STAGES:
        docs = stage(spark, docs, DIR).cache()
    got = P.run(spark, DIR)
    order = ["bin_id", "place", "doc_id", "start", "n_tokens"]
    assert sorted(map(tuple, got.select(order).collect()), key=repr) == sorted(map(tuple, docs.select(order).collect()), key=repr)
    # of the folders between, only that of the result is left
    last = got.inputFiles()[0].rpartition("/")[0]
    assert os.listdir(os.path.dirname(last.removeprefix("file://").removeprefix("file:"))) == [os.path.basename(last)]


def test_run_on_awkward_and_empty_tables(spark, tmp_path):
    some = spark.read.parquet(f"{DIR}/documents.parquet").limit(40).collect()
    rows = [tuple(r) for r in some] + [tuple(some[0])] * 3 + [(None, some[1].text, None, None, None), (901, None, "en", "s", 1), (902, "", "en", "s", 0), (903, "word " * 60_000, "en", None, 300_000), (904, "a" * 1_000_000, None, "s", None), (None, None, None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, keep int, lang_ string, _fp int, n_tokens int, bin_id int"
    table = spark.createDataFrame([(*r, 1, "x", 2, 3, 4) for r in rows], schema)
    for name, frame in (("awkward", table), ("empty", table.limit(0))):
        frame.write.parquet(str(tmp_path / name / "documents.parquet"))
        got = P.run(spark, str(tmp_path / name)).collect()
        assert (not got) == (name == "empty")
        ids = {r.doc_id for r in got}
        # blank and null texts go with the first stage
        assert ids <= {r[0] for r in rows} - {901, 902}
