"""SQL counterparts of the matrix, split and metric queries."""

from orderlens.ml.prep import CHURN_CATEGORIES, CHURN_NUMERIC, DELIVERY_CATEGORIES, DELIVERY_NUMERIC
from oracle import reports
from oracle.text import rnd

CATS = {
    "VehicleType": ["Bike", "Car", "Scooter"], "WeatherCondition": ["Clear", "Cloudy", "Foggy", "Rainy", "Stormy", "Unknown"],
    "Membership": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"], "RestaurantType": ["Cafe", "Cloud Kitchen", "Dine-in"],
}
TIMED = "c_done WHERE DeliveryTimeMinutes IS NOT NULL"
TABLES = {**reports.TABLES, "c_judged": "SELECT CustomerID AS id, Churn AS label, p AS score FROM c_scored",
          "c_roc": "SELECT score, sum(label) AS pos, count(*) - sum(label) AS neg FROM c_judged GROUP BY 1",
          "c_rocsum": """SELECT *, sum(pos) OVER (ORDER BY score DESC) AS tps, sum(neg) OVER (ORDER BY score DESC) AS fps, sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM c_roc"""}


def r6(x):
    return rnd(x, 6)


def matrix(frm, numeric, cats):
    parts = [f"SELECT '{c}' AS feature, {r6(f'avg({c})')} AS mean, count(*) AS n FROM {frm}" for c in numeric]
    for c in cats:
        parts += [f"SELECT '{c}_{v}', {r6(f'''avg(CASE WHEN {c} = '{v}' THEN 1.0 ELSE 0.0 END)''')}, count(*) FROM {frm}" for v in CATS[c]]
    return " UNION ALL ".join(parts)


HIT = "score >= 0.5"
TP, FP, FN, TN = (f"count(*) FILTER (WHERE {c})" for c in (f"{HIT} AND label = 1", f"{HIT} AND label = 0", "score < 0.5 AND label = 1", "score < 0.5 AND label = 0"))
SCALES = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {r6(f'avg({c})')} AS mean, {r6(f'CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END')} AS scale FROM {TIMED}" for c in DELIVERY_NUMERIC)
SQL = {
    "delivery_matrix": matrix(TIMED, DELIVERY_NUMERIC, DELIVERY_CATEGORIES),
    "churn_matrix": matrix("c_churn", CHURN_NUMERIC, CHURN_CATEGORIES),
    "split_random": f"""SELECT 'test' AS "Split", CAST(round_even(count(*) * 0.2, 0) AS BIGINT) AS n FROM {TIMED} UNION ALL SELECT 'train', count(*) - CAST(round_even(count(*) * 0.2, 0) AS BIGINT) FROM {TIMED}""",
    "split_stratified": """SELECT 'test' AS "Split", Churn AS label, CAST(round_even(count(*) * 0.2, 0) AS BIGINT) AS n FROM c_churn GROUP BY 2
 UNION ALL SELECT 'train', Churn, count(*) - CAST(round_even(count(*) * 0.2, 0) AS BIGINT) FROM c_churn GROUP BY 2""",
    "standardise": SCALES,
    "baseline_regression": f"""WITH d AS (SELECT DeliveryTimeMinutes AS y, OrderID % 5 = 0 AS test FROM {TIMED}), m AS (SELECT avg(y) AS m FROM d WHERE NOT test)
 SELECT {r6('avg(abs(y - m))')} AS "MAE", {r6('avg((y - m) * (y - m))')} AS "MSE", {r6('sqrt(avg((y - m) * (y - m)))')} AS "RMSE", {r6('1 - sum((y - m) * (y - m)) / (var_pop(y) * count(*))')} AS "R2" FROM d, m WHERE test""",
    "baseline_churn": f"""SELECT {r6('avg(Churn)')} AS "Accuracy", {r6('avg(Churn)')} AS "Precision", 1.0::DOUBLE AS "Recall", {r6('2 * avg(Churn) / (avg(Churn) + 1)')} AS "F1", 0.0::DOUBLE AS "F1_retained",
 0.5::DOUBLE AS "ROC_AUC", {r6('avg(Churn)')} AS "PR_AUC" FROM c_churn WHERE CustomerID % 5 = 0""",
    "regression_metrics": f"""SELECT {r6('avg(abs(Residual))')} AS "MAE", {r6('avg(Residual * Residual)')} AS "MSE", {r6('sqrt(avg(Residual * Residual))')} AS "RMSE",
 {r6('1 - sum(Residual * Residual) / (var_pop(Actual) * count(*))')} AS "R2" FROM c_pred""",
    "classification_metrics": f"""SELECT {r6(f'({TP} + {TN}) / count(*)')} AS "Accuracy", {r6(f'{TP} / ({TP} + {FP})')} AS "Precision", {r6(f'{TP} / ({TP} + {FN})')} AS "Recall",
 {r6(f'2 * {TP} / (2 * {TP} + {FP} + {FN})')} AS "F1", {r6(f'2 * {TN} / (2 * {TN} + {FP} + {FN})')} AS "F1_retained",
 (SELECT {r6('sum(neg * (tps - pos / 2.0)) / (max(p) * max(n))')} FROM c_rocsum) AS "ROC_AUC",
 (SELECT {r6('sum(label * tp / rn) / sum(label)')} FROM (SELECT label, sum(label) OVER w AS tp, row_number() OVER w AS rn FROM c_judged WINDOW w AS (ORDER BY score DESC, id ROWS UNBOUNDED PRECEDING))) AS "PR_AUC" FROM c_judged""",
    "confusion_matrix": f"SELECT label, CASE WHEN {HIT} THEN 1 ELSE 0 END AS predicted, count(*) AS n FROM c_judged GROUP BY 1, 2",
    "roc_curve": f"SELECT {r6('score')} AS score, {r6('tps / p')} AS tpr, {r6('fps / n')} AS fpr FROM c_rocsum",
    "risk_segment_rates_by_key": f"""SELECT RiskSegment, count(*) AS customers, {r6('avg(Churn)')} AS churn_rate FROM c_cscores WHERE Split = 'test' GROUP BY 1""",
}
