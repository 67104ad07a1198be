"""Splits, weights, metrics, the linear model and the flagged share."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from derrick.operators.clean import fill_missing
from derrick.operators.isolation import isolation_scores
from derrick.operators.models import (
    accuracy,
    balanced_weights,
    classifier_metrics,
    feature_vector,
    fit_linear,
    predict,
    regression_metrics,
    roc_auc,
)
from derrick.operators.split import random_split, stratified_split
from derrick.plans import views
from derrick.plans.failure_risk import FEATURES, KEY, MODEL_FEATURES, sensor_readings
from querybook import roles
from querybook.book import flag, plain, query, r, table

# The production hash of the splits: 13 hex digits of an MD5 over seed and key.
_HASH_SQL = "('0x' || substr(md5(concat_ws('|', '42', doc_id)), 1, 13))::BIGINT"


@query(
    "split_random",
    f"""SELECT doc_id, quality::BIGINT AS quality, {flag('''row_number() OVER (ORDER BY h)
            <= ceil(0.2::DOUBLE * count(*) OVER ())''')} AS is_test
        FROM (SELECT *, {_HASH_SQL} AS h FROM labels)""",
)
def split_random(spark, d):
    labels = table(spark, d, "labels").select("doc_id", "quality")
    return plain(random_split(labels, ["doc_id"], 0.2))


@query(
    "split_stratified",
    f"""WITH classes AS (
            SELECT quality, count(*) AS n, sum(count(*)) OVER () AS total
            FROM labels GROUP BY quality),
        exact AS (
            SELECT quality, ceil(0.25::DOUBLE * total) AS wanted,
                   ceil(0.25::DOUBLE * total) * n / total AS share FROM classes),
        quota AS (
            SELECT quality, floor(share) + CASE WHEN row_number() OVER (
                       ORDER BY share - floor(share) DESC, quality)
                   <= wanted - sum(floor(share)) OVER () THEN 1 ELSE 0 END AS k
            FROM exact)
        SELECT doc_id, l.quality::BIGINT AS quality,
               {flag('''row_number() OVER (PARTITION BY l.quality ORDER BY h) <= k''')} AS is_test
        FROM (SELECT *, {_HASH_SQL} AS h FROM labels) l JOIN quota q ON l.quality = q.quality""",
)
def split_stratified(spark, d):
    labels = table(spark, d, "labels").select("doc_id", "quality")
    return plain(stratified_split(labels, ["doc_id"], "quality", 0.25))


@query(
    "class_weights",
    f"""SELECT doc_id, quality::BIGINT AS quality,
        {r('(SELECT count(*) FROM labels) / (2.0::DOUBLE * count(*) OVER (PARTITION BY quality))')}
            AS weight FROM labels""",
)
def class_weights(spark, d):
    labels = table(spark, d, "labels").select("doc_id", "quality")
    return plain(balanced_weights(labels, "quality", "weight"))


_LINE_FEATURES = ("l_quantity", "l_discount", "l_tax", "l_linenumber")


def _normal_equations(target: str, features: tuple[str, ...]) -> str:
    """SQL for least squares of centred columns, solved by elimination (e0, e1, ...);
    ends in ``fit_`` with slopes b0, b1, ... and the intercept."""
    n = len(features)
    means = ", ".join(f"avg({c}) AS m{i}" for i, c in enumerate(features))
    sums = [f"avg(({a} - m{i}) * ({b} - m{j})) AS s{i}_{j}" for i, a in enumerate(features) for j, b in enumerate(features) if j >= i]
    sums += [f"avg(({a} - m{i}) * ({target} - mt)) AS s{i}_{n}" for i, a in enumerate(features)]
    out = f"mean_ AS (SELECT {means}, avg({target}) AS mt FROM lineitem),\n"
    out += f"e0 AS (SELECT {', '.join(sums)} FROM lineitem, mean_)"
    for k in range(n - 1):  # take column k out of the equations below it
        rest = [
            f"s{i}_{j} - s{k}_{i} * s{k}_{j} / s{k}_{k} AS s{i}_{j}"
            for i in range(k + 1, n) for j in range(i, n + 1)
        ]
        kept = [f"s{i}_{j}" for i in range(k + 1) for j in range(i, n + 1)]
        out += f",\ne{k + 1} AS (SELECT {', '.join(kept + rest)} FROM e{k})"
    previous = f"e{n - 1}"
    for i in reversed(range(n)):  # back substitution
        known = "".join(f" - s{i}_{j} * b{j}" for j in range(i + 1, n))
        out += f",\nb{i}_ AS (SELECT *, (s{i}_{n}{known}) / s{i}_{i} AS b{i} FROM {previous})"
        previous = f"b{i}_"
    slopes = ", ".join(f"b{i}" for i in range(n))
    line = "mt" + "".join(f" - b{i} * m{i}" for i in range(n))
    return f"{out},\nfit_ AS (SELECT {slopes}, {line} AS b FROM {previous}, mean_)"


_FITTED = " + ".join(f"b{i} * {c}" for i, c in enumerate(_LINE_FEATURES))


@query(
    "linreg",
    f"""WITH {_normal_equations("l_extendedprice", _LINE_FEATURES)},
        gap AS (SELECT l_extendedprice - ({_FITTED} + b) AS e FROM lineitem, fit_)
        SELECT {', '.join(f"{r(f'b{i}', 2)} AS slope{i}" for i in range(len(_LINE_FEATURES)))},
            {r('b', 2)} AS intercept, {r('(SELECT avg(abs(e)) FROM gap)', 2)} AS mae,
            {r('(SELECT sqrt(avg(e * e)) FROM gap)', 2)} AS rmse FROM fit_""",
)
def linreg(spark, d):
    lines = table(spark, d, "lineitem").select(*_LINE_FEATURES, "l_extendedprice")
    model = fit_linear(lines, _LINE_FEATURES, "l_extendedprice")
    fitted = predict(model, lines, _LINE_FEATURES)
    slopes = [F.lit(float(x)).alias(f"slope{i}") for i, x in enumerate(model.coefficients)]
    return plain(
        regression_metrics(fitted, "LinearRegression", "l_extendedprice").select(
            *slopes, F.lit(float(model.intercept)).alias("intercept"), "mae", "rmse"
        ),
        2,
    )


@query(
    "reg_metrics",
    f"""SELECT 'rule' AS model_name, {r('avg(abs(o_totalprice - 250000))', 2)} AS mae,
        {r('sqrt(avg((o_totalprice - 250000) * (o_totalprice - 250000)))', 2)} AS rmse
        FROM orders""",
)
def reg_metrics(spark, d):
    guessed = table(spark, d, "orders").select(
        F.col("o_totalprice").alias("actual"), F.lit(250000.0).alias("predicted")
    )
    return plain(views.ml_metrics(regression_metrics(guessed, "rule")), 2)


@query(
    "cls_metrics",
    f"""WITH t AS (SELECT CAST(event_type = 'error' AS BIGINT) AS y, round(value) AS s FROM events),
        ranked AS (
            SELECT y, s, rank() OVER (ORDER BY s)
                   + (count(*) OVER (PARTITION BY s) - 1) / 2.0::DOUBLE AS rk FROM t)
        SELECT 'rule' AS model_name, count(*) AS rows_count, CAST(sum(y) AS BIGINT) AS positive_rows,
            {r('avg(CAST(y = CAST(s > 100 AS BIGINT) AS DOUBLE))')} AS accuracy,
            {r('''(sum(rk) FILTER (WHERE y = 1) - sum(y) * (sum(y) + 1) / 2.0::DOUBLE)
                / (sum(y) * (count(*) - sum(y)))''')} AS roc_auc
        FROM ranked""",
)
def cls_metrics(spark, d):
    scored = table(spark, d, "events").select(
        (F.col("event_type") == "error").cast("int").alias("y"),
        F.round("value").alias("s"),
        (F.round("value") > 100).cast("int").alias("guess"),
    )
    scores = (accuracy(scored, "y", "guess"), roc_auc(scored, "y", "s"))
    return plain(classifier_metrics(scored, "rule", scores, "y"))


_MATRIX = tuple(MODEL_FEATURES)


@query(
    "model_matrix",
    f"""WITH m AS (SELECT event_id, {', '.join(f"{r(e, 6)} AS x{i}" for i, e in enumerate(
        [f"coalesce(CASE WHEN event_id % {i + 3} = 0 THEN NULL ELSE value * {i + 1} END, 0)" for i in range(10)]
    ))} FROM events)
        SELECT event_id, {', '.join(f'x{i}' for i in range(10))} FROM m""",
)
def model_matrix(spark, d):
    """The assembled vector of all ten features, gaps filled, taken apart again."""
    events = table(spark, d, "events")
    gaps = [
        F.when(F.col("event_id") % (i + 3) != 0, F.col("value") * (i + 1)).alias(c)
        for i, c in enumerate(_MATRIX)
    ]
    vectors = feature_vector(fill_missing(events.select("event_id", *gaps), _MATRIX), _MATRIX)
    values = vector_to_array("_features")
    return plain(vectors.select("event_id", *(values[i].alias(f"x{i}") for i in range(10))), 6)


@query(
    "iforest_flags",
    """SELECT count(*) AS rows_count, CAST(ceil(0.05 * (count(*) - 1)) AS BIGINT) AS flagged,
       0::BIGINT AS wrong_sign FROM events""",
)
def iforest_flags(spark, d):
    """The flagged share is exact: the rows below the interpolated 5 % quantile."""
    readings = sensor_readings(roles.pump_sensors(spark, d))
    hit, score = F.col("is_isolation_anomaly"), F.col("isolation_score")
    return isolation_scores(readings, FEATURES, KEY).agg(
        F.count(F.lit(1)).alias("rows_count"),
        F.count_if(hit).alias("flagged"),
        F.count_if(hit != (score > 0)).alias("wrong_sign"),
    )
