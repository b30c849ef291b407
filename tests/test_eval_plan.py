"""The evaluation frame is computed once, however many metrics read it."""
from conftest import SF_SMALL

from tasador.plans.q_eval import _with_pred, eval_frame


def test_metrics_do_not_read_the_tables_again(spark):
    for frame in (_with_pred(spark, SF_SMALL), eval_frame(spark, SF_SMALL)):
        assert "parquet" not in frame._jdf.queryExecution().optimizedPlan().toString()
