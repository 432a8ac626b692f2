from corvid.operators.kcenter import suggest_parts
from corvid.plans.inspect import plan_text
from corvid.session import cut_lineage, shared_checkpoint_dir


def test_cut_lineage_uses_the_shared_folder(spark):
    assert shared_checkpoint_dir(spark)
    df = cut_lineage(spark.range(10).selectExpr("id * 2 AS x"))
    assert "Scan ExistingRDD" in plan_text(df, "simple")  # read back, no recompute
    assert sorted(r.x for r in df.collect()) == list(range(0, 20, 2))


def test_suggest_parts():
    assert suggest_parts(10, 61) == 1
    assert suggest_parts(1_000_000, 61) == 2
    assert suggest_parts(10**12, 61) == 2_000_000
