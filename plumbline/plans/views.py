"""Temporary views for a dashboard's questions over run records, errors and module times."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators import joins, metrics, quality


#: What the census asks of a run; what run_metrics does not count is null.
_CENSUS = [("pages", "long"), ("product_cards", "long"), ("found", "long"), ("fetch_fail_rate", "double"), ("challenge_rate", "double"), ("render", "string"), ("antibot", "string"), ("alerts", "array<string>")]


def register(records: DataFrame, module_times: DataFrame, fetches: DataFrame) -> list[str]:
    """v_run_summary, v_last_result, v_module_times, v_run_metrics and v_census, each a plan over its table; returns their names.

    records: run_id, company_id, name, status, products, seconds, ord. module_times: company, module, seconds, retry. fetches: see run_metrics.
    """
    m = quality.run_metrics(fetches)
    views = {
        "v_run_summary": metrics.run_summary(records, ["run_id"]),
        "v_last_result": joins.last_result(records),
        "v_module_times": metrics.module_times(module_times, "company", "module", "seconds", "retry"),
        "v_run_metrics": m,
        "v_census": m.select("domain", "run", quality.census(*[F.col(c) if c in m.columns else F.lit(None).cast(k) for c, k in _CENSUS]).alias("c")).select("domain", "run", "c.*"),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
