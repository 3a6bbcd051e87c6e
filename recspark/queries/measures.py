"""Evaluation metrics over purchase lists and line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.lists import LISTS_SQL, purchase_lists
from ..operators.metrics import ranking_metrics, ranking_metrics_sql, recall_at_k
from ..operators.statistics import (kl_score, kl_two_tables, ks_statistic, ks_two_tables, log_loss,
                                    multiclass_by_label, multiclass_metrics, ranking_curve_areas,
                                    regression_metrics)
from ..sources import views as V
from .registry import query
from .samples import LIKE_ITEMS, _like_items

K = 5
_CTES, _SELECT = ranking_metrics_sql("lists", K)
ALL_SQL = V.with_views(_SELECT, "log", extra=f"{LISTS_SQL}, {_CTES}")


def _metrics(spark, path):
    return ranking_metrics(purchase_lists(V.log(spark, path)), K)


query("met_ranking_report", ALL_SQL)(_metrics)

for _name, _column in (("met1_precision", "precision_at_k"), ("met2_ndcg", "ndcg_at_k"), ("met3_mrr", "mrr"),
                       ("met4_hit_rate", "hit_rate"), ("met5_discounted_revenue", "discounted_revenue"),
                       ("met6_revenue", "revenue"), ("met8_conversion_rate", "conversion_rate"),
                       ("met9_geometric_dcg", "geometric_dcg")):
    query(_name, f"SELECT {_column} FROM ({ALL_SQL})")(
        lambda spark, path, column=_column: _metrics(spark, path).select(column))


@query("met1_precision_over_k", V.with_views(
    f"SELECT round(avg(hits / {K}.0), 6) AS precision_at_k FROM (SELECT user_idx, cast(sum(response) as double) AS hits"
    f" FROM lists WHERE rank <= {K} GROUP BY user_idx)", "log", extra=LISTS_SQL))
def precision_over_k(spark, path):
    return ranking_metrics(purchase_lists(V.log(spark, path)), K, denominator="k").select("precision_at_k")


@query("met7_recall", V.with_views(
    "SELECT round(avg(coalesce(hits, 0) / cast(relevant as double)), 6) AS recall_at_k, cast(count(*) as bigint) AS users FROM"
    " (SELECT user_idx, count(*) AS relevant FROM truth GROUP BY user_idx) LEFT JOIN (SELECT user_idx, count(*) AS hits"
    " FROM lists JOIN truth USING (user_idx, item_idx) WHERE rank <= 10 GROUP BY user_idx) USING (user_idx)", "log",
    extra=f"{LISTS_SQL}, truth AS (SELECT DISTINCT user_idx, item_idx FROM log WHERE relevance > 0)"))
def recall(spark, path):
    log = V.log(spark, path)
    return recall_at_k(purchase_lists(log), log.filter(F.col("relevance") > 0), 10)


@query("met10_regression",
       "SELECT round(sqrt(avg((y - p) * (y - p))), 6) AS rmse, round(avg((y - p) * (y - p)), 6) AS mse,"
       " round(avg(abs(y - p)), 6) AS mae, round(1 - sum((y - p) * (y - p)) / sum((y - m) * (y - m)), 6) AS r2,"
       " round(avg((p - m) * (p - m)), 6) AS var FROM (SELECT l_extendedprice / 1000 AS y, l_quantity * 1.5::double AS p,"
       " (SELECT avg(l_extendedprice / 1000) FROM lineitem) AS m FROM lineitem)")
def regression(spark, path):
    rows = V.table(spark, path, "lineitem").select((F.col("l_extendedprice") / 1000.0).alias("y"),
                                                   (F.col("l_quantity") * 1.5).alias("p"))
    return regression_metrics(rows, "p", "y")


@query("met11_curve_areas",
       "WITH f AS (SELECT l_extendedprice AS s, count(CASE WHEN l_quantity > 25 THEN 1 END) AS p,"
       " count(CASE WHEN l_quantity <= 25 THEN 1 END) AS n FROM lineitem GROUP BY 1), c AS (SELECT *,"
       " sum(p) OVER w AS tp, sum(n) OVER w AS fp FROM f WINDOW w AS (ORDER BY s DESC)), e AS (SELECT *,"
       " cast((SELECT sum(p) FROM f) as double) AS tot_p, cast((SELECT sum(n) FROM f) as double) AS tot_n,"
       " tp / cast(tp + fp as double) AS precision, coalesce((tp - p) / nullif(cast(tp - p + fp - n as double), 0),"
       " tp / cast(tp + fp as double)) AS before FROM c)"
       " SELECT round(sum(n * (tp - p + p / 2.0) / tot_p / tot_n), 6) AS area_under_roc,"
       " round(sum(p / tot_p * (before + precision) / 2), 6) AS area_under_pr FROM e")
def curve_areas(spark, path):
    rows = V.table(spark, path, "lineitem").select(
        "l_extendedprice", F.when(F.col("l_quantity") > 25, F.lit(1)).otherwise(F.lit(0)).alias("label"))
    return ranking_curve_areas(rows, "l_extendedprice", "label")


CLASS_SQL = ("WITH d AS (SELECT o_orderstatus AS label, CASE WHEN o_totalprice < 150000 THEN 'F' WHEN o_totalprice < 300000"
             " THEN 'O' ELSE 'P' END AS guess FROM orders), a AS (SELECT label, cast(count(*) as double) AS rows,"
             " cast(count(CASE WHEN guess = label THEN 1 END) as double) AS tp FROM d GROUP BY label), g AS (SELECT guess AS label,"
             " cast(count(*) as double) AS guessed FROM d GROUP BY guess), m AS (SELECT label, rows, tp,"
             " coalesce(guessed, 0) AS guessed, (SELECT count(*) FROM d) AS total, coalesce(tp / nullif(guessed, 0), 0) AS precision,"
             " tp / rows AS recall FROM a LEFT JOIN g USING (label)), x AS (SELECT *,"
             " coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1,"
             " (guessed - tp) / (total - rows) AS fpr FROM m) ")


def _classes(spark, path):
    price = F.col("o_totalprice")
    return V.table(spark, path, "orders").select(
        F.col("o_orderstatus").alias("label"),
        F.when(price < 150000, F.lit("F")).when(price < 300000, F.lit("O")).otherwise(F.lit("P")).alias("guess"))


@query("met12_multiclass", CLASS_SQL +
       "SELECT round(sum(tp) / max(total), 6) AS accuracy, round(1 - sum(tp) / max(total), 6) AS hamming_loss,"
       " round(sum(precision * rows / total), 6) AS weighted_precision, round(sum(recall * rows / total), 6) AS weighted_recall,"
       " round(sum(f1 * rows / total), 6) AS f1, round(sum(fpr * rows / total), 6) AS weighted_fpr FROM x")
def multiclass(spark, path):
    return multiclass_metrics(_classes(spark, path), "guess", "label")


@query("met12_by_label", CLASS_SQL +
       "SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, round(fpr, 6) AS fpr FROM x")
def by_label(spark, path):
    return multiclass_by_label(_classes(spark, path), "guess", "label").select(
        "label", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1", "fpr")])


@query("met12_log_loss",
       "SELECT round(avg(-ln(greatest(1e-15, least(1 - 1e-15, CASE WHEN l_returnflag <> 'R' THEN p ELSE 1 - p END)))), 6)"
       " AS log_loss FROM (SELECT *, l_discount * 5::double + 0.1::double AS p FROM lineitem)")
def loss(spark, path):
    rows = V.table(spark, path, "lineitem").select(
        (F.col("l_discount") * 5.0 + 0.1).alias("p"), F.when(F.col("l_returnflag") != "R", 1).otherwise(0).alias("y"))
    return log_loss(rows, "p", "y")


def _ks_sql(a, b):
    return (f"WITH v AS (SELECT x, count(CASE WHEN s = 0 THEN 1 END) AS a, count(CASE WHEN s = 1 THEN 1 END) AS b FROM"
            f" ({a} UNION ALL {b}) GROUP BY x), c AS (SELECT sum(a) OVER (ORDER BY x) AS ca, sum(b) OVER (ORDER BY x) AS cb FROM v)"
            " SELECT round(max(abs(ca / cast((SELECT sum(a) FROM v) as double) - cb / cast((SELECT sum(b) FROM v) as double))), 9)"
            " AS ks FROM c")


def _kl_sql(truth, other):
    edge = "lo + {} * (hi - lo) / 10.0::double"
    cells = ", ".join(f"count(CASE WHEN x >= {'lo' if i == 0 else edge.format(i)} AND"
                      f" {'x <= hi' if i == 9 else f'x < {edge.format(i + 1)}'} THEN 1 END) + 1e-5 AS c{i}" for i in range(10))
    terms = " + ".join(f"f.c{i} * ln(f.c{i} / g.c{i}) - f.c{i} + g.c{i}" for i in range(10))
    return (f"WITH t AS ({truth}), o AS ({other}), s AS (SELECT min(x) AS lo, max(x) AS hi FROM t),"
            f" f AS (SELECT {cells} FROM t, s), g AS (SELECT {cells} FROM o, s)"
            f" SELECT round(1 / (1 + {terms}), 9) AS kl_score FROM f, g")


@query("met13_ks", _ks_sql("SELECT l_quantity AS x, 0 AS s FROM lineitem",
                           "SELECT l_extendedprice / 2000 AS x, 1 AS s FROM lineitem"))
def ks(spark, path):
    rows = V.table(spark, path, "lineitem").select("l_quantity", (F.col("l_extendedprice") / 2000.0).alias("other"))
    return ks_statistic(rows, "l_quantity", "other")


@query("met14_kl", _kl_sql("SELECT l_quantity AS x FROM lineitem", "SELECT l_extendedprice / 2000 AS x FROM lineitem"))
def kl(spark, path):
    rows = V.table(spark, path, "lineitem").select("l_quantity", (F.col("l_extendedprice") / 2000.0).alias("other"))
    return kl_score(rows, "other", "l_quantity")


SYNTH_PRICE = V.with_views(f"SELECT round(price, 4) AS x FROM ({LIKE_ITEMS})", "items")


@query("met15_synthetic_ks", _ks_sql("SELECT p_retailprice AS x, 0 AS s FROM part",
                                     f"SELECT x, 1 AS s FROM ({SYNTH_PRICE})"))
def synthetic_ks(spark, path):
    synth = _like_items(spark, path).select(F.round("price", 4).alias("price"))
    return ks_two_tables(V.items(spark, path), synth, "price")


@query("met15_synthetic_kl", _kl_sql("SELECT p_retailprice AS x FROM part", SYNTH_PRICE))
def synthetic_kl(spark, path):
    synth = _like_items(spark, path).select(F.round("price", 4).alias("price"))
    return kl_two_tables(V.items(spark, path), synth, "price")
