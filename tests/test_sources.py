import numpy as np
import pytest

from voxstrata.sources import las, ply, publish, trees


def test_las_round_trip(spark, tmp_path):
    spark.dataSource.register(las.LasSource)
    rows = [(i * 10, -i, 5 * i, i % 7, i % 3, float(i)) for i in range(2500)]
    df = spark.createDataFrame(rows, "X int, Y int, Z int, intensity int, classification int, gps_time double").repartition(2)
    out = str(tmp_path / "cloud")
    df.write.format("las").option("path", out).option("scale", "0.01,0.01,0.01").option("offset", "1000,0,0").mode("append").save()
    back = spark.read.format("las").option("range", "700").load(out)
    assert sorted(map(tuple, back.select(*df.columns).collect())) == sorted(rows)
    heads = las.las_headers(spark, out).collect()
    assert sum(h.n for h in heads) == 2500 and {h.point_format for h in heads} == {6} and heads[0].scale == [0.01] * 3
    with pytest.raises(Exception, match="holds point files"):
        df.write.format("las").option("path", out).mode("append").save()


def test_las_refuses_what_it_cannot_read(tmp_path):
    with pytest.raises(ValueError):
        las.parse_header(b"no")


def test_ply_round_trip(spark, tmp_path):
    v, f = np.array([[0, 0, 1.5], [1, 0, 2], [0, 1, 3], [1, 1, 4]]), np.array([[0, 1, 2], [1, 3, 2]])
    (tmp_path / "m.ply").write_bytes(ply.mesh_bytes(v, f, np.array([7, 8]), ("crs x",)))
    assert [tuple(r)[2:] for r in ply.vertices(spark, str(tmp_path)).orderBy("vid").collect()] == [tuple(map(float, x)) for x in v]
    assert [tuple(r)[2:] for r in ply.faces(spark, str(tmp_path)).orderBy("fid").collect()] == [(0, 1, 2, 7), (1, 3, 2, 8)]
    (tmp_path / "m.ply").write_bytes(ply.mesh_bytes(v, f)[:-3])
    with pytest.raises(Exception, match="size"):
        ply.vertices(spark, str(tmp_path)).collect()
    with pytest.raises(ValueError):
        ply.mesh_bytes(v, f + 9)


def test_tree_tables(spark, tmp_path):
    (tmp_path / "t.txt").write_text("# trees\npredinstance, height, x, y, z, radius, parent_id\n7, 12.5, 0,0,0,0.3,-1, 0,0,2,0.2,0\n9, 3.5, 1,1,0,0.1,-1\n")
    got = {r.id: r for r in trees.tree_info(spark, str(tmp_path / "t.txt")).collect()}
    assert set(got) == {7, 9}


def test_publish_refuses_and_leaves_nothing(spark, tmp_path):
    out = str(tmp_path / "p")
    publish.publish(spark.range(3), out)
    assert spark.read.parquet(out).count() == 3
    with pytest.raises(FileExistsError):
        publish.publish(spark.range(3), out)
    with pytest.raises(Exception):
        publish.publish(spark.range(1).selectExpr("raise_error('x') AS a"), str(tmp_path / "q"))
    assert [p.name for p in tmp_path.iterdir()] == ["p"]
