"""SQL counterparts of the observed statistics."""

from orderlens.plans.stats import CANCEL, LATE_BY, TIME_BY
from oracle import reports
from oracle.text import rnd

TABLES = reports.TABLES


def chi(name, frm, g, f):
    part = "pow({o} - {m} * ng / nn, 2) / CASE WHEN {m} * ng / nn > 0 THEN {m} * ng / nn ELSE 1 END"
    return f"""SELECT '{name}' AS test, {rnd('sum(' + part.format(o='o1', m='ff') + ' + ' + part.format(o='(ng - o1)', m='(nn - ff)') + ')', 6)} AS statistic FROM
 (SELECT ng, o1, sum(ng) OVER () AS nn, sum(o1) OVER () AS ff FROM (SELECT {g} AS g, CAST(count(*) AS DOUBLE) AS ng, CAST(sum({f}) AS DOUBLE) AS o1 FROM {frm} GROUP BY 1))"""


TIMED = "c_done WHERE DeliveryTimeMinutes IS NOT NULL"
SQL = {
    "chi2_statistic": " UNION ALL ".join([chi(f"cancel_rate_by_{k}", "c_base", c, "IsCancelled") for k, c in CANCEL.items()]
                                         + [chi(f"late_rate_by_{k}", TIMED, c, "IsLate") for k, c in LATE_BY.items()]),
    "chi2_documents": chi("toxic_by_lang", "labels l JOIN documents d ON d.doc_id = l.doc_id", "lang", "toxic"),
    "group_mean_variance": " UNION ALL ".join(
        f"SELECT 'delivery_time_by_{k}' AS test, {rnd('var_samp(m)', 6)} AS statistic FROM (SELECT avg(DeliveryTimeMinutes) AS m FROM {TIMED} GROUP BY {c})" for k, c in TIME_BY.items()),
}
