"""Demand forecasts: line item quantities per return flag and line status as six daily series."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import forecast as FC
from millrace.plans.registry import Tables, query
from millrace.session import materialise, scratch

KEYS = ["l_returnflag", "l_linestatus"]
_K = "l_returnflag, l_linestatus"


def _history(t: Tables):
    return FC.history(t.lineitem, KEYS, "l_shipdate", "l_quantity")


_HIST = f"h AS (SELECT {_K}, CAST(l_shipdate AS DATE) AS ds, sum(l_quantity) AS y FROM lineitem GROUP BY 1, 2, 3)"
_FRAME = f"""{_HIST}, e AS (SELECT {_K}, min(ds) AS first, max(ds) AS last FROM h GROUP BY 1, 2),
    f AS (SELECT {_K}, ds, y FROM h UNION ALL
          SELECT {_K}, (last + CAST(s AS INTEGER))::DATE, NULL::DOUBLE FROM e, (SELECT unnest(generate_series(1, 90)) AS s))"""
_FIT = f"""{_FRAME},
    d AS (SELECT f.*, date_diff('day', first, ds)::DOUBLE AS t FROM f JOIN e USING ({_K})),
    g AS (SELECT {_K}, regr_slope(y, t) AS b, regr_intercept(y, t) AS a FROM d WHERE y IS NOT NULL GROUP BY 1, 2),
    p AS (SELECT d.*, a + b * t AS trend, dayofweek(ds) AS weekday, month(ds) AS month, y / (a + b * t) AS ratio FROM d JOIN g USING ({_K})),
    w AS (SELECT *, coalesce(avg(ratio) OVER (PARTITION BY {_K}, weekday), 1) AS wf FROM p),
    m AS (SELECT *, coalesce(avg(ratio / wf) OVER (PARTITION BY {_K}, month), 1) AS mf FROM w),
    s AS (SELECT *, trend * wf * mf AS yhat FROM m),
    r AS (SELECT *, 1.96 * stddev_samp(y - yhat) OVER (PARTITION BY {_K}) AS band FROM s)"""


def _rounded(df, *names):
    return df.withColumns({n: F.round(n, 4) for n in names})


def _day(df):
    return df.withColumn("ds", F.col("ds").cast("string"))


@query("fc_history", f"WITH {_HIST} SELECT {_K}, strftime(ds, '%Y-%m-%d') AS ds, y FROM h")
def _(t: Tables):
    return _day(_history(t))


@query("fc_future_frame", f"WITH {_FRAME} SELECT {_K}, strftime(ds, '%Y-%m-%d') AS ds, coalesce(y, -1) AS y FROM f")
def _(t: Tables):
    return _day(FC.future_frame(_history(t), KEYS)).withColumn("y", F.coalesce("y", F.lit(-1.0)))


@query(
    "fc_seasonal_native",
    f"""WITH {_FIT} SELECT {_K}, strftime(ds, '%Y-%m-%d') AS ds, coalesce(y, -1) AS y, round(yhat, 4) AS yhat,
               round(yhat + band, 4) AS yhat_upper, round(yhat - band, 4) AS yhat_lower, '2001-12-01' AS training_date FROM r""",
)
def _(t: Tables):
    found = FC.seasonal(_history(t), KEYS).withColumn("training_date", F.lit("2001-12-01"))
    return _rounded(_day(found), "yhat", "yhat_upper", "yhat_lower").withColumn("y", F.coalesce("y", F.lit(-1.0)))


@query(
    "fc_components",
    f"""WITH {_FIT} SELECT {_K}, 'trend' AS part, strftime(ds, '%Y-%m-%d') AS "at", round(trend, 4) AS value FROM r
        UNION ALL SELECT {_K}, 'weekday', CAST(weekday AS VARCHAR), round(any_value(wf), 4) FROM r GROUP BY {_K}, weekday
        UNION ALL SELECT {_K}, 'month', CAST(month AS VARCHAR), round(any_value(mf), 4) FROM r GROUP BY {_K}, month""",
)
def _(t: Tables):
    return _rounded(FC.components(materialise(_history(t), "history"), KEYS), "value")


@query("fc_grouped_map")
def _(t: Tables):
    return FC.grouped_map(_history(t), KEYS)


@query(
    "fc_evaluate",
    f"""WITH {_FIT} SELECT {_K}, '2001-12-01' AS training_date, round(avg(abs(y - yhat)), 4) AS mae, round(avg(pow(y - yhat, 2)), 3) AS mse,
               round(sqrt(avg(pow(y - yhat, 2))), 4) AS rmse FROM r WHERE y IS NOT NULL AND ds < DATE '2001-01-01' GROUP BY 1, 2""",
)
def _(t: Tables):
    found = FC.seasonal(_history(t), KEYS).withColumn("training_date", F.lit("2001-12-01"))
    scored = FC.evaluate(found, [*KEYS, "training_date"], "2001-01-01")
    return _rounded(scored, "mae", "rmse").withColumn("mse", F.round("mse", 3))


@query(
    "udf_grouped_map",
    f"""WITH {_FIT} SELECT {_K}, round(avg(abs(y - yhat)), 4) AS mae, round(avg(pow(y - yhat, 2)), 3) AS mse,
               round(sqrt(avg(pow(y - yhat, 2))), 4) AS rmse FROM r WHERE y IS NOT NULL GROUP BY 1, 2""",
)
def _(t: Tables):
    scored = FC.evaluate_grouped(FC.seasonal(_history(t), KEYS), KEYS)
    return _rounded(scored, "mae", "rmse").withColumn("mse", F.round("mse", 3))


@query(
    "fc_report",
    f"""WITH {_FIT} SELECT l_linestatus, strftime(ds, '%Y-%m-%d') AS date, round(yhat, 4) AS sales_predicted, round(yhat + band, 4) AS sales_predicted_upper,
               round(yhat - band, 4) AS sales_predicted_lower FROM r WHERE l_returnflag = 'A' AND ds >= DATE '2001-06-01'""",
)
def _(t: Tables):
    forecast = FC.seasonal(_history(t), KEYS)
    path = scratch(t.spark, "forecasts")
    name = f"forecasts_{path.rsplit('-', 1)[1]}"
    # Two training dates in one table; the report asks for one of them.
    for trained in ("2001-11-01", "2001-12-01"):
        FC.store(forecast, KEYS, F.lit(trained).cast("date"), name, path)
    t.spark.sql(f"DROP TABLE {name}")
    report = t.spark.sql(
        """SELECT l_linestatus, date, sales_predicted, sales_predicted_upper, sales_predicted_lower FROM {stored}
           WHERE l_returnflag = 'A' AND date >= DATE '2001-06-01' AND training_date = DATE '2001-12-01'
           ORDER BY l_linestatus, date""",
        stored=t.spark.read.parquet(path),
    )
    numbers = ["sales_predicted", "sales_predicted_upper", "sales_predicted_lower"]
    return _rounded(report, *numbers).withColumn("date", F.col("date").cast("string"))
