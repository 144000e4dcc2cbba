import json
import math

import pytest
from pyspark.sql import functions as F

from culprit import fixed_values as V
from culprit.functions.draws import hash_normal, hash_poisson, hash_uniform
from culprit.operators.incidents import build_incidents, with_baselines, with_label, with_mixture_shift
from culprit.sources.mixture import check_mixture, mixture_rows, read_mixture


def keys(spark, n, parts=4):
    return spark.range(0, n, 1, parts).withColumnRenamed("id", "incident_id")


def test_uniform_and_normal_moments(spark):
    row = (
        keys(spark, 50_000)
        .select(hash_uniform("incident_id", "a", 1).alias("u"), hash_normal("incident_id", "a", 1).alias("z"),
                hash_normal("incident_id", "b", 1).alias("y"))
        .agg(F.min("u"), F.max("u"), F.avg("u"), F.avg("z"), F.stddev("z"), F.corr("z", "y"))
        .first()
    )
    assert 0 < row[0] and row[1] < 1
    assert abs(row[2] - 0.5) < 0.005
    assert abs(row[3]) < 0.02 and abs(row[4] - 1) < 0.02 and abs(row[5]) < 0.02


@pytest.mark.parametrize("rate", [0.5, 1.0, 3.7, 9.0])
def test_poisson_follows_its_distribution(spark, rate):
    df = keys(spark, 20_000).select(hash_uniform("incident_id", f"p{rate}", 3).alias("u"), F.lit(rate).alias("rate"))
    rows = df.select("u", hash_poisson("u", "rate").alias("n")).collect()
    for r in rows[:2000]:
        cdf, n = math.exp(-rate), 0
        p = cdf
        while r["u"] >= cdf:
            n += 1
            p *= rate / n
            cdf += p
        assert r["n"] == n
    mean = sum(r["n"] for r in rows) / len(rows)
    assert abs(mean - rate) < 5 * math.sqrt(rate / len(rows))


def test_values_do_not_depend_on_partitioning(spark):
    a = {r["incident_id"]: r for r in build_incidents(keys(spark, 500, 1)).collect()}
    b = {r["incident_id"]: r for r in build_incidents(keys(spark, 500, 7)).collect()}
    assert a == b


def test_ranges_and_label_shares(incidents):
    row = incidents.agg(
        F.min("avg_cpu_usage"), F.max("avg_cpu_usage"), F.min("latency"), F.min("request_rate"),
        F.min("dependency_latency"), F.min("mem_growth"), F.min("error_rate"), F.min("oom_log_count"),
    ).first()
    assert row[0] >= 0 and row[1] <= 100 and row[2] >= 50 and row[3] >= 0
    assert row[4] >= 1 and row[5] >= 0 and row[6] >= 0 and row[7] >= 0
    counts = {r[V.LABEL]: r["count"] for r in incidents.groupBy(V.LABEL).count().collect()}
    assert set(counts) == set(V.ROOT_CAUSE_PRIOR)
    for name, share in V.ROOT_CAUSE_PRIOR.items():
        assert abs(counts[name] / 3000 - share) < 0.04


def test_label_name_is_honoured(spark):
    assert build_incidents(keys(spark, 5), label="cause").columns[-1] == "cause"


def test_mixture_from_a_file_equals_the_built_in_one(spark, tmp_path):
    path = tmp_path / "mixture.json"
    path.write_text(json.dumps(V.MIXTURE, indent=2))
    rows = mixture_rows(read_mixture(spark, str(path)))
    assert rows.count() == 122
    assert rows.exceptAll(mixture_rows(read_mixture(spark))).count() == 0
    check_mixture(read_mixture(spark))


def bad_mixture(spark, tmp_path):
    path = tmp_path / "bad.json"
    path.write_text(json.dumps({"normal": {"latency": [[0.4, [10, 1]], [0.5, [20, 1]]]}}))
    return read_mixture(spark, str(path))


def test_bad_mixture_is_named(spark, tmp_path):
    with pytest.raises(ValueError, match="normal.*latency.*0.9"):
        check_mixture(bad_mixture(spark, tmp_path))


def test_missing_mixture_file(spark):
    with pytest.raises(FileNotFoundError):
        read_mixture(spark, "/nowhere/mixture.json")


def test_pick_beyond_the_last_component_changes_nothing(spark, tmp_path, monkeypatch):
    from culprit.operators import incidents as module

    monkeypatch.setattr(module, "check_mixture", lambda mixture: None)
    df = with_baselines(with_label(keys(spark, 2000), "incident_id", prior={"normal": 1.0}), "incident_id")
    before = df.select("incident_id", F.col("latency").alias("before"))
    after = with_mixture_shift(df, "incident_id", bad_mixture(spark, tmp_path)).select("incident_id", "latency")
    u = hash_uniform("incident_id", "pick:latency", V.SEED)
    rows = before.join(after, "incident_id").withColumn("u", u).collect()
    kept = [r for r in rows if r["before"] == r["latency"]]
    assert kept and all((r["u"] >= 0.9) == (r["before"] == r["latency"]) for r in rows)


def test_build_never_shuffles_the_rows(spark):
    plan = build_incidents(keys(spark, 100, 8))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
