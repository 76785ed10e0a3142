"""Batch discovery, name-aligned union, optional sources and the model artefact folder."""

import os

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from caseflow.operators.features import FeatureModel
from caseflow.sources import artefacts as A
from caseflow.sources import delimited as D


def test_batches_align_by_name_and_keep_order(spark, scratch):
    with open(os.path.join(scratch, "DRUG25Q2.txt"), "w") as f:
        f.write(" PrimaryID $Role_Cod$prod_ai$drugname\n1$PS$A$x\n")
    with open(os.path.join(scratch, "DRUG25Q1.txt"), "w") as f:
        f.write("primaryid$role_cod$drugname\n1$SS$y\n2$PS$z\n")
    assert [os.path.basename(p) for p in D.batch_files(spark, scratch, "DRUG")] == ["DRUG25Q1.txt", "DRUG25Q2.txt"]
    df = D.read_batches(spark, scratch, "DRUG")
    rows = sorted((r["_file"], r["primaryid"], r["prod_ai"], r["drugname"]) for r in df.collect())
    assert rows == [("DRUG25Q1.txt", "1", None, "y"), ("DRUG25Q1.txt", "2", None, "z"), ("DRUG25Q2.txt", "1", "A", "x")]
    with pytest.raises(FileNotFoundError):
        D.read_batches(spark, scratch, "REAC")


def test_optional_source(spark, scratch):
    empty = D.optional(spark, os.path.join(scratch, "missing.tsv"), D.NAME_COLUMNS)
    assert empty.count() == 0 and empty.columns == D.NAME_COLUMNS
    p = os.path.join(scratch, "names.tsv")
    with open(p, "w") as f:
        f.write("CID1\taspirin\nCID2\tmetformin\n")
    assert D.optional(spark, p, D.NAME_COLUMNS).count() == 2


def test_model_round_trip_and_contract(spark, scratch):
    folder = os.path.join(scratch, "model")
    g = np.arange(10, dtype=float) / 7
    thr = spark.createDataFrame([(0, 0.3), (1, 0.5)], "label_id int, threshold double")
    labels = spark.createDataFrame([(0, "Nausea"), (1, "Rash")], "label_id int, label string")
    fm = FeatureModel(["A"], ["PAIN"], [], ["tok"], [1.5], 41.0, 72.5)
    A.save_model(spark, folder, g, thr, labels, fm, {"f1_macro": 0.1}, {"hidden": 24})
    g2, thr2, labels2, fm2, cfg = A.load_model(spark, folder)
    assert np.array_equal(g, g2) and fm2 == fm and cfg == {"hidden": "24"}
    assert sorted(tuple(r) for r in thr2.collect()) == [(0, 0.3), (1, 0.5)]
    A.contract_check(labels2, labels)
    with pytest.raises(ValueError):
        A.contract_check(labels2, spark.createDataFrame([(0, "Nausea"), (1, "Rash"), (2, "Fall")], "label_id int, label string"))


def _save(spark, folder, n):
    thr = spark.createDataFrame([(0, n / 10)], "label_id int, threshold double")
    labels = spark.createDataFrame([(0, f"L{n}")], "label_id int, label string")
    return A.save_model(spark, folder, np.full(3, float(n)), thr, labels, FeatureModel(["A"], [], [], [], [], 1.0, float(n)), {"f1": n % 3, f"only{n}": 1}, {"n": n})


def _whole(spark, folder, version=None):
    """The number every table of the version read holds."""
    genome, thr, labels, fm, cfg = A.load_model(spark, folder, version)
    found = {int(genome[0]), round(thr.first()[1] * 10), int(labels.first()[1][1:]), int(fm.weight_median), int(cfg["n"])}
    assert len(found) == 1
    return found.pop()


def test_store_commits_last_and_readers_stay_with_their_version(spark, scratch, monkeypatch):
    folder = os.path.join(scratch, "store")
    assert A.versions(spark, folder) == [] and A.compare_runs(spark, folder).count() == 0
    with pytest.raises(FileNotFoundError):
        A.load_model(spark, folder)
    first = _save(spark, folder, 1)
    reader = A.pinned(spark, folder)
    with monkeypatch.context() as m:  # a writer lost before its commit
        m.setattr(A, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            _save(spark, folder, 2)
    assert _whole(spark, folder) == 1 and len(A.versions(spark, folder)) == 1
    with open(os.path.join(folder, "log", f"{2:012d}.json"), "w") as f:  # an entry not written to its end
        f.write('{"number": 2, "na')
    assert _whole(spark, folder) == 1
    third = _save(spark, folder, 3)
    assert (first.number, third.number) == (1, 3) and _whole(spark, folder) == 3 and _whole(spark, folder, reader) == 1
    assert _whole(spark, folder, A.pinned(spark, folder, 1)) == 1


def test_store_numbers_are_taken_once(spark, scratch, monkeypatch):
    folder = os.path.join(scratch, "store")
    matching, seen = A.FS.matching, []

    def late(spark, pattern):  # both writers list the log before either has committed
        seen.append(pattern)
        return [] if len(seen) <= 2 else matching(spark, pattern)

    monkeypatch.setattr(A.FS, "matching", late)
    assert [A._commit(spark, folder, n).number for n in ("v-a", "v-b")] == [1, 2]
    assert [(v.number, v.name) for v in A.versions(spark, folder)] == [(1, "v-a"), (2, "v-b")]


def test_store_expires_tables_and_keeps_runs(spark, scratch):
    folder = os.path.join(scratch, "store")
    for n in (1, 2, 3, 4):
        _save(spark, folder, n)
    os.makedirs(os.path.join(folder, "data", "v-lost", "weights"))
    assert len(A.expire(spark, folder, keep=2)) == 2  # the lost writer may still be at work
    assert A.expire(spark, folder, keep=2, grace=0) == ["data/v-lost"]
    assert _whole(spark, folder) == 4 and _whole(spark, folder, A.pinned(spark, folder, 3)) == 3
    with pytest.raises(FileNotFoundError):
        A.pinned(spark, folder, 1)
    with pytest.raises(ValueError):
        A.expire(spark, folder, keep=0)
    runs = sorted((tuple(r) for r in A.compare_runs(spark, folder).where("metric = 'f1'").collect()))
    assert runs == [(1, "f1", 1.0, None, False), (2, "f1", 2.0, 1.0, True), (3, "f1", 0.0, -2.0, False), (4, "f1", 1.0, 1.0, False)]
    assert A.compare_runs(spark, folder).where("metric = 'only3'").first()["change"] is None


def test_rows_do_not_depend_on_the_columns_read(spark, scratch):
    with open(os.path.join(scratch, "DEMO25Q1.txt"), "w") as f:
        f.write("primaryid$age$age_cod$sex$wt\n1$10$YR$M$70\n2$20$YR$F$60$extra\n3$30\n\n4$NA$$null$\n")
    for path in (scratch, "file://" + scratch):
        df = D.read_batches(spark, path, "DEMO")
        assert df.count() == 3
        assert sorted(r[0] for r in df.select("primaryid").collect()) == ["1", "3", "4"]
        assert sorted(map(tuple, df.select("primaryid", "age").collect())) == [("1", "10"), ("3", "30"), ("4", None)]
        rows = {r["primaryid"]: tuple(r)[:5] for r in df.collect()}
        assert rows["3"] == ("3", "30", None, None, None) and rows["4"] == ("4", None, None, None, None)
    assert D.optional(spark, "file://" + os.path.join(scratch, "DEMO25Q1.txt"), D.NAME_COLUMNS, "|").count() == 5
    with pytest.raises(FileNotFoundError):
        D.read_batches(spark, "file://" + scratch + "/none", "DEMO")


def test_headerless_and_case_table_null_the_missing_tokens(spark, scratch):
    p = os.path.join(scratch, "names.tsv")
    with open(p, "w") as f:
        f.write("CID1\tNA\nCID2\nCID3\ta\tb\n")
    assert sorted(map(tuple, D.read_headerless(spark, p, D.NAME_COLUMNS).collect())) == [("CID1", None), ("CID2", None)]
    p = os.path.join(scratch, "cases.csv")
    with open(p, "w") as f:
        f.write("primaryid,age_years,sex\n1,NA,M\n2,41.5,null\n")
    for path in (p, "file://" + p):
        df = D.read_case_table(spark, path)
        assert sorted(map(tuple, df.select("primaryid", "age_years", "sex", "weight_kg").collect())) == [("1", None, "M", None), ("2", 41.5, None, None)]


def test_result_tables_are_written_in_both_formats(spark, scratch):
    df = spark.createDataFrame([("1", 41.5, "M"), ("2", None, None)], "primaryid string, age_years double, sex string")
    for fmt in ("parquet", "csv"):
        path = "file://" + os.path.join(scratch, fmt)
        for _ in range(2):  # the second replaces the first
            A.write_table(df, path, fmt)
    assert sorted(map(tuple, spark.read.parquet(os.path.join(scratch, "parquet")).collect())) == [("1", 41.5, "M"), ("2", None, None)]
    back = D.read_case_table(spark, os.path.join(scratch, "csv"))
    assert sorted(map(tuple, back.select("primaryid", "age_years", "sex").collect())) == [("1", 41.5, "M"), ("2", None, None)]


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda size: [spark.conf.set(k, v) for k, v in zip(old, (str(size), "1"))]
    for k, v in old.items():
        spark.conf.set(k, v)


FIELDS = ["a", "", 'b"c', '"x$y"', '"d""q"', '"l1\nl2"', '"q"t', '"l\n\nl3$z"', "NA", '"NA"', '"', "5 4", '"""e"', '"f""\ng"']


@pytest.mark.parametrize("size", [7, 64, 1 << 20])
def test_quoted_rows_equal_pandas_whatever_the_splits(spark, scratch, small_splits, size):
    rng = random.Random(size)
    path = os.path.join(scratch, "DEMO25Q1.txt")
    rows = ["x$y$z"] + ["$".join(rng.choice([f for f in FIELDS if f != '"']) for _ in range(rng.choice([1, 2, 3, 3, 3, 4]))) for _ in range(60)]
    with open(path, "w") as f:
        f.write("id$B $c\n" + "\n".join(rows) + "\n" + '"x$y"$z\n"q"$w\nid$B $c\nu$v\n')
    want = pd.read_csv(path, sep="$", dtype=str, on_bad_lines="skip", low_memory=False, engine="c")
    want = sorted((tuple(None if pd.isna(v) else v for v in r) for r in want.itertuples(index=False)), key=str)
    small_splits(size)
    df = D.read_batches(spark, scratch, "DEMO")
    assert sorted(map(tuple, df.select("id", "b", "c").collect()), key=str) == want
    assert ("id", "B ", "c") in want  # a later line like the header is a row


def test_rows_over_many_splits_keep_their_order(spark, scratch, small_splits):
    long = "start\n" + "\n".join(f"line {i}" for i in range(200)) + "\nend"
    with open(os.path.join(scratch, "REAC25Q1.txt"), "w") as f:
        f.write(f'id$t\n1$"{long}"\n2$x\n3$"{long}$"\n4$"a\nb"\n')
    small_splits(40)
    rows = D.read_batches(spark, scratch, "REAC").orderBy("_row").collect()
    assert [(r["id"], r["t"]) for r in rows] == [("1", long), ("2", "x"), ("3", long + "$"), ("4", "a\nb")]


def test_a_quote_that_is_not_closed_is_an_error(spark, scratch):
    with open(os.path.join(scratch, "INDI25Q1.txt"), "w") as f:
        f.write('id$t\n1$"x\n2$y\n')
    with pytest.raises(ValueError, match="INDI25Q1"):
        D.read_batches(spark, scratch, "INDI").count()


def test_case_table_with_quotes(spark, scratch):
    df = spark.createDataFrame([("1", 'he said "no", twice'), ("2", "two\nlines"), ("3", None), ("4", '"')], "primaryid string, note string").withColumn("age_years", F.lit("7"))
    A.write_table(df, scratch + "/t", "csv")
    got = D.read_case_table(spark, scratch + "/t").select("primaryid", "note", "age_years").collect()
    assert sorted(map(tuple, got)) == [("1", 'he said "no", twice', 7.0), ("2", "two\nlines", 7.0), ("3", None, 7.0), ("4", '"', 7.0)]
