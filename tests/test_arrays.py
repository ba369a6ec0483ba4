"""Array files: round trips, ranges, sparse archives."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperloom.sources.arrays import ArrayFile, load_arrays, save_arrays


def test_round_trip_equals_parquet(spark, tmp_path):
    df = spark.range(257).select("id", (F.col("id") % 5).cast("int").alias("label"), F.array(F.col("id") * 0.5, F.lit(1.0), -F.col("id") / 3).alias("features"))
    save_arrays(df.repartition(3), str(tmp_path / "a"), file_rows=50)
    df.write.parquet(str(tmp_path / "p"))
    back = load_arrays(spark, str(tmp_path / "a"), part_bytes=1000)
    assert back.rdd.getNumPartitions() > 6
    assert sorted(map(tuple, back.drop("row").collect())) == sorted(map(tuple, spark.read.parquet(str(tmp_path / "p")).collect()))


def test_npy_and_sparse_archives(spark, tmp_path):
    dense = np.arange(60, dtype="<f4").reshape(20, 3)
    np.save(tmp_path / "x.npy", dense)
    rows = load_arrays(spark, str(tmp_path / "x.npy"), part_bytes=40).orderBy("row").collect()
    assert [r["values"] for r in rows] == dense.tolist()
    for save, name in ((np.savez, "s.npz"), (np.savez_compressed, "c.npz")):
        save(tmp_path / name, indptr=np.array([0, 2, 2, 3]), indices=np.array([1, 4, 0]), data=np.array([.5, 2., 3.]), shape=np.array([3, 6]), format=b"csr")
        rows = load_arrays(spark, str(tmp_path / name), part_bytes=1).orderBy("row").collect()
        assert [tuple(r) for r in rows] == [(0, 6, [1, 4], [.5, 2.]), (1, 6, [], []), (2, 6, [0], [3.])]


class Counted:
    """A file that counts the bytes read of it."""

    def __init__(self, file):
        self.file, self.count = file, 0

    def read(self, n=-1):
        data = self.file.read(n)
        self.count += len(data)
        return data

    def __getattr__(self, name):
        return getattr(self.file, name)


def test_a_range_reads_its_rows_only(tmp_path):
    np.save(tmp_path / "x.npy", np.zeros((100_000, 8)))
    np.savez(tmp_path / "x.npz", a=np.zeros((100_000, 8)), b=np.arange(100_000))
    for name, width in (("x.npy", 64), ("x.npz", 72)):
        with open(tmp_path / name, "rb") as raw:
            source = Counted(raw)
            assert sum(b.num_rows for b in ArrayFile(source, name).batches(70_000, 70_100)) == 100
            assert source.count < 100 * width + 40_000


def test_what_does_not_fit_raises(spark, tmp_path):
    np.save(tmp_path / "o.npy", np.asfortranarray(np.zeros((4, 3))))
    with pytest.raises(Exception, match="row order"):
        load_arrays(spark, str(tmp_path / "o.npy")).collect()
    with pytest.raises(Exception, match="nulls"):
        save_arrays(spark.range(3).select(F.when(F.col("id") > 0, F.col("id")).alias("id")), str(tmp_path / "n"))
    np.save(tmp_path / "e.npy", np.zeros((0, 3)))
    assert load_arrays(spark, str(tmp_path / "e.npy")).count() == 0
