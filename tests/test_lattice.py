from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from voxstrata.functions import lattice as la


def test_half_even_and_floor(spark):
    rows = [(s, n) for n in (1, 2, 3, 4, 7) for s in range(-30, 31)]
    df = spark.createDataFrame(rows, "s long, n long").select("s", "n", la.half_even("s", "n").alias("h"), la.floor_div("s", F.col("n")).alias("f"))
    for r in df.collect():
        assert r.h == round(Fraction(r.s, r.n)) and r.f == r.s // r.n


@pytest.mark.parametrize("scale,offset,resolution", [("0.001", "0", "0.01"), ("0.00025", "508586.946", "0.05"), ("0.002", "0.005", "0.075")])
def test_voxel_keys_are_rational(spark, scale, offset, resolution):
    raw = [-100001, -41, -40, -1, 0, 1, 39, 40, 41, 2_000_000_000]
    df = spark.createDataFrame([(x,) for x in raw], "v long").select("v", la.voxel_key("v", scale, offset, resolution).alias("k"))
    for r in df.collect():
        exact = (Fraction(r.v) * Fraction(scale) + Fraction(offset)) / Fraction(resolution)
        assert r.k == exact.numerator // exact.denominator


def test_voxel_key_overflow_is_refused():
    with pytest.raises(OverflowError):
        la.voxel_ratio("123456789.123", "0", "0.001")


def test_encoding_overflow_is_an_error(spark):
    with pytest.raises(Exception, match="lattice"):
        spark.range(1).select(la.encoded(F.lit(1e9), "0.001", "0")).collect()


def test_inclusive_radius():
    assert la.limit2("0.01", "0.001") == 100 and la.limit2("0.0099999", "0.001") == 99
    assert la.lattice_is_exact("0.001", "0.01", 1000.0) and not la.lattice_is_exact("0.000001", "0.01", 1e9)


def test_splitmix_known_values(spark):
    got = [r[0] & ((1 << 64) - 1) for r in spark.range(3).repartition(1).sortWithinPartitions("id").select(la.splitmix64("id")).collect()]

    def one(i):
        m = (1 << 64) - 1
        z = (i + 0x9E3779B97F4A7C15) & m
        z = (z ^ z >> 30) * 0xBF58476D1CE4E5B9 & m
        z = (z ^ z >> 27) * 0x94D049BB133111EB & m
        return z ^ z >> 31

    assert got == [one(i) for i in range(3)]


def test_rct_namespace(spark):
    df = spark.createDataFrame([(0, 0), (3, 7), (42949, 1)], "t long, i long").select(la.encode_rct("t", "i").alias("c"))
    assert [r.c for r in df.collect()] == [0, 300007, 4294900001]
    with pytest.raises(Exception, match="namespace"):
        spark.createDataFrame([(1, 100000)], "t long, i long").select(la.encode_rct("t", "i")).collect()
