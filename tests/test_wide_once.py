"""Fits on the wide table: the join behind it runs once."""

import pytest

from conftest import SF_SMALL
from wardline import session
from wardline.operators import fit as FT
from wardline.plans import registry as R


def test_fits_read_the_wide_table_and_not_its_join(spark):
    for df in R._imputed(spark, SF_SMALL):
        assert "Join" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_medians_of_a_written_table_write_nothing(spark):
    df = session.cut_lineage(spark.createDataFrame([(1.0, None), (4.0, 2.0), (2.0, float("nan")), (None, 8.0)], "a double, b double"))
    made = session.tables_made()
    got = FT.medians(df, ["a", "b"], written=True)
    assert session.tables_made() == made
    assert got == FT.medians(df, ["a", "b"]) == {"a": 2.0, "b": 5.0}
    assert FT.fit_median(df, ["a"], written=True).medians == {"a": pytest.approx(2.0)}


def test_matrix_is_unpivoted_before_names_and_rounding(spark):
    from wardline.plans import registry
    from wardline.plans.matrices import Matrices
    rows = [(1, 24.0, "train", 0.1234567, 1.23456, None), (2, 48.0, "test", None, 2.5, 0.0000005)]
    m = Matrices(spark.createDataFrame(rows, "stay_id long, t_end double, split string, `odd name` double, b_cum_std double, c double"), [])
    out = registry._matrix_long(m, ["odd name", "b_cum_std", "c"])
    assert out.columns == ["stay_id", "t_end", "split", "feature", "value"]
    assert {(r.stay_id, r.feature): r.value for r in out.collect()} == {
        (1, "odd name"): 0.123457, (1, "b_cum_std"): 1.235, (1, "c"): None, (2, "odd name"): None, (2, "b_cum_std"): 2.5, (2, "c"): 0.000001}
    assert "named_struct" not in out._jdf.queryExecution().toString()      # nothing as large as all columns is named or rounded


def test_a_matrix_is_written_once(spark):
    import random
    from wardline.plans import matrices as MX
    rnd = random.Random(2)
    rows = [(i, i % 40, 24.0, rnd.gauss(0, 1) if i % 5 else None, rnd.gauss(3, 2), i % 2, 1, i % 2) for i in range(300)]
    df = spark.createDataFrame(rows, "stay_id long, subject_id long, t_end double, a_mean double, b_mean double, "
                                     "label_can_discharge_24h int, label_no_return_72h int, task2_mask int")
    made = session.tables_made()
    m = MX.base_matrices(df, scale_for_linear=True)
    assert session.tables_made() - made == 2                  # the master, and its numbers; no copy for medians or scaling
    got = m.split("train").selectExpr("avg(a_mean)", "stddev_pop(a_mean)", "avg(b_mean)").first()
    assert [got[0], got[1], got[2]] == pytest.approx([0, 1, 0], abs=1e-9)
