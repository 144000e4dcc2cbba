import pytest
from pyspark.sql import functions as F

from culprit import fixed_values as V
from culprit.operators import tables
from culprit.sources import shared
from culprit.sources.tables import incident_schema, read_table, write_table

KEY = "incident_id"


def test_suffix_decides_in_any_case(spark, incidents, tmp_path):
    for name in ("a.CSV", "b.pq", "c.parquet"):
        path = write_table(incidents, str(tmp_path / name))
        assert read_table(spark, path, incident_schema()).exceptAll(incidents.select(*incident_schema().names)).count() == 0
    inferred = read_table(spark, str(tmp_path / "a.CSV"))
    assert dict(inferred.dtypes)["latency"] == "double" and dict(inferred.dtypes)["incident_id"] in ("int", "bigint")


def test_read_errors(spark, tmp_path):
    (tmp_path / "x.txt").write_text("a")
    with pytest.raises(ValueError, match=".txt"):
        read_table(spark, str(tmp_path / "x.txt"))
    with pytest.raises(FileNotFoundError):
        read_table(spark, str(tmp_path / "none.csv"))
    with pytest.raises(ValueError):
        write_table(spark.range(1), str(tmp_path / "x.json"))


def test_missing_label_lists_the_columns(incidents):
    with pytest.raises(ValueError, match="latency"):
        tables.split_xy(incidents.drop(V.LABEL))
    with pytest.raises(ValueError, match="latency"):
        tables.feature_names(incidents.drop(V.LABEL))


def test_features_leave_out_key_label_and_split(incidents):
    table = incidents.withColumns({"split": F.lit("train"), "fold": F.lit(1)})
    assert tables.feature_names(table) == V.SIGNALS
    x, y = tables.split_xy(incidents)
    assert V.LABEL not in x.columns and y.columns == [V.LABEL]
    assert tables.assemble(incidents, V.SIGNALS).first()["features"].size == 9


def test_large_lookup_is_shuffled_and_equal(incidents, monkeypatch):
    ids = incidents.filter("incident_id % 3 = 0").select(KEY)
    few = tables.lookup_rows(incidents, ids, KEY)
    monkeypatch.setattr(shared.small, "__defaults__", (10,))
    many = tables.lookup_rows(incidents, ids, KEY)
    assert few.count() == 1000 and many.exceptAll(few).count() == 0


def test_scaling_is_by_population_deviation(incidents):
    scaled = tables.apply_scaling(incidents, tables.fit_scaling(incidents, V.SIGNALS))
    row = scaled.agg(F.avg("latency"), F.stddev_pop("latency")).first()
    assert abs(row[0]) < 1e-9 and row[1] == pytest.approx(1)


def test_histogram_keeps_every_row(incidents):
    rows = tables.histogram(incidents, "latency").collect()
    assert sum(r["n"] for r in rows) == 3000 and max(r["bin"] for r in rows) == 29
    flat = tables.histogram(incidents.withColumn("latency", F.lit(7.0)), "latency").collect()
    assert {r["bin"] for r in flat} == {0}


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert shared.written(spark.range(3), "three").count() == 3


def test_shared_folder_must_be_named_on_a_cluster(monkeypatch):
    class Cluster:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Cluster()

        class conf:
            @staticmethod
            def get(name, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared.shared_folder(Session())


def test_density_curve_comes_close_to_the_kernel_sum_over_rows(spark):
    import numpy as np

    draw = np.random.default_rng(0)
    values = {"a": draw.normal(size=400) * 3 + 1, "b": draw.exponential(size=250), "c": np.ones(5)}
    rows = [(k, float(x)) for k, v in values.items() for x in v] + [("a", None)]
    got = tables.density_curve(spark.createDataFrame(rows, f"{V.LABEL} string, x double"), "x").collect()
    assert len(got) == 400 and {r[V.LABEL] for r in got} == {"a", "b"}
    for r in got:
        v = values[r[V.LABEL]]
        h = v.std(ddof=1) * len(v) ** -0.2
        plain = np.exp(-0.5 * ((r["x"] - v) / h) ** 2).sum() / (len(v) * h * np.sqrt(2 * np.pi))
        assert abs(r["density"] - plain) < 5e-3 * max(plain, 0.05)
        assert abs(r["height"] - r["density"] * len(v) * (v.max() - v.min()) / 30) < 1e-9


def test_pair_table_counts_every_pair(spark):
    rows = [("a", 0.0, 1.0, 5.0), ("a", 10.0, 2.0, 5.0), ("b", 5.0, None, 5.0), (None, 9.99, 1.5, 5.0)]
    df = spark.createDataFrame(rows, f"{V.LABEL} string, x double, y double, z double")
    got = {tuple(r) for r in tables.pair_table(df, ["x", "y", "z"], bins=10).collect()}
    assert got == {
        ("a", "x", "y", 0, 0, 1), ("a", "x", "y", 9, 9, 1), (None, "x", "y", 9, 5, 1),
        ("a", "x", "z", 0, 0, 1), ("a", "x", "z", 9, 0, 1), ("b", "x", "z", 5, 0, 1), (None, "x", "z", 9, 0, 1),
        ("a", "y", "z", 0, 0, 1), ("a", "y", "z", 9, 0, 1), (None, "y", "z", 5, 0, 1),
    }
    assert tables.pair_table(df.limit(0), ["x", "y"]).count() == 0


def test_rows_are_dealt_to_the_cores_and_few_rows_stay(spark):
    from culprit.sources import shared

    many = spark.range(5 * shared.TASK_ROWS, numPartitions=1)
    sizes = [len(p) for p in shared.dealt(many, "id").rdd.glom().collect()]
    assert len(sizes) == 5 and sum(sizes) == 5 * shared.TASK_ROWS and max(sizes) < 2 * shared.TASK_ROWS
    assert shared.dealt(spark.range(shared.TASK_ROWS, numPartitions=1), "id").rdd.getNumPartitions() == 1
