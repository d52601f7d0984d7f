"""Queries on splitting, weighting and evaluating the classifier. Scores come from a fixed formula."""

from __future__ import annotations

from pyspark.sql import functions as F

from visitmart.operators import evaluation as E
from visitmart.plans import oracle as O
from visitmart.plans import visits as V
from visitmart.plans.registry import query, rounded

_CURVE = O.SCORED + """, per_score AS (SELECT score AS threshold, sum(label)::BIGINT AS pos,
    (count(*) - sum(label))::BIGINT AS neg FROM scored GROUP BY score),
  curve AS (SELECT threshold, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
    sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM per_score
    WINDOW w AS (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING)),
  pr AS (SELECT threshold, prec, rec, 2e0*prec*rec/greatest(prec+rec, 1e-12) AS f1 FROM (
    SELECT threshold, coalesce(tp::DOUBLE/nullif((tp+fp)::DOUBLE,0e0),0e0) AS prec,
      coalesce(tp::DOUBLE/nullif(p::DOUBLE,0e0),0e0) AS rec FROM curve))"""


def _curve(spark, sf_dir):
    return E.score_curve(V.scored(spark, sf_dir))


def _split_sql(base: str, source: str, label: str, key: str, cuts: list[tuple[str, int]], rest: str, show: str) -> str:
    cases = " ".join(f"WHEN k <= floor(n*{share}/100e0 + 0.5e0) THEN '{name}'" for name, share in cuts)
    return f"""{base} SELECT {show}, CASE {cases} ELSE '{rest}' END AS part FROM (SELECT *,
      count(*) OVER (PARTITION BY {label} ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS k,
      count(*) OVER (PARTITION BY {label}) AS n FROM (SELECT *, sha256({key}||'|42') AS h FROM {source}))"""


@query(
    "stratified_split",
    _split_sql(O.SCORED, "scored", "label", "record_hash", [("train", 60), ("validation", 80)], "test", "record_hash, label"),
)
def stratified_split(spark, sf_dir):
    parts = {"train": 60, "validation": 20, "test": 20}
    return E.stratified_split(V.scored(spark, sf_dir).drop("score"), "label", "record_hash", parts)


@query(
    "stratified_split_documents",
    _split_sql("WITH l AS (SELECT * FROM labels)", "l", "quality", "doc_id::VARCHAR", [("train", 70)], "test", "doc_id, quality"),
)
def stratified_split_documents(spark, sf_dir):
    labels = V.table(spark, sf_dir, "labels").select("doc_id", "quality")
    return E.stratified_split(labels, "quality", "doc_id", {"train": 70, "test": 30})


@query(
    "stratified_split_shared_key",
    _split_sql(
        O.COHORT, "(SELECT record_hash, hospitalid, readmitted AS label FROM cohort)", "label",
        "hospitalid::VARCHAR", [("train", 60), ("validation", 80)], "test", "record_hash, hospitalid, label",
    ),
)
def stratified_split_shared_key(spark, sf_dir):
    rows = V.cohort(spark, sf_dir).select("record_hash", "hospitalid", F.col("readmitted").alias("label"))
    return E.stratified_split(rows, "label", "hospitalid", {"train": 60, "validation": 20, "test": 20})


@query(
    "balanced_weight",
    O.SCORED + f""" SELECT record_hash, label, {O.r('n::DOUBLE / (2e0 * CASE WHEN label = 1 THEN p ELSE n - p END)')} AS weight
      FROM scored, (SELECT count(*) AS n, sum(label)::BIGINT AS p FROM scored)""",
)
def balanced_weight(spark, sf_dir):
    return rounded(E.balanced_weight(V.scored(spark, sf_dir).drop("score"), "label"))


@query(
    "target_classes",
    f"{O.MODEL} SELECT count(*) AS rows, count(DISTINCT coalesce(readmitted_under_30_days,0)) AS classes FROM model",
)
def target_classes(spark, sf_dir):
    return E.target_classes(V.model(spark, sf_dir))


@query(
    "pr_curve",
    f"{_CURVE} SELECT {O.r('threshold')} AS threshold, {O.r('prec')} AS precision, {O.r('rec')} AS recall, {O.r('f1')} AS f1 FROM pr",
)
def pr_curve(spark, sf_dir):
    return rounded(E.pr_curve(_curve(spark, sf_dir)))


@query(
    "roc_curve",
    f"{_CURVE} SELECT {O.r('threshold')} AS threshold, {O.r('fp::DOUBLE/n::DOUBLE')} AS fpr, {O.r('tp::DOUBLE/p::DOUBLE')} AS tpr FROM curve",
)
def roc_curve(spark, sf_dir):
    return rounded(E.roc_curve(_curve(spark, sf_dir)))


@query(
    "best_threshold",
    f"{_CURVE} SELECT {O.r('threshold')} AS threshold, {O.r('f1')} AS f1 FROM pr ORDER BY pr.f1 DESC, pr.threshold LIMIT 1",
)
def best_threshold(spark, sf_dir):
    return rounded(E.best_threshold(_curve(spark, sf_dir)))


@query(
    "ranking_quality",
    f"""{_CURVE} SELECT {O.r('sum(neg::DOUBLE*((tp-pos)::DOUBLE + pos::DOUBLE/2e0)) / max(p::DOUBLE*n::DOUBLE)')} AS roc_auc,
      {O.r('sum(pos::DOUBLE/p::DOUBLE * (tp::DOUBLE/(tp+fp)::DOUBLE))')} AS average_precision,
      {O.r('''sum(pos::DOUBLE/p::DOUBLE * (tp::DOUBLE/(tp+fp)::DOUBLE + CASE WHEN tp-pos+fp-neg = 0 THEN 1e0
        ELSE (tp-pos)::DOUBLE/nullif((tp-pos+fp-neg)::DOUBLE,0e0) END) / 2e0)''')} AS pr_auc_trapezoid FROM curve""",
)
def ranking_quality(spark, sf_dir):
    return rounded(E.ranking_quality(_curve(spark, sf_dir)))


_RATIOS = f"""{O.r('coalesce((tp+tn)::DOUBLE/nullif((tn+fp+fn+tp)::DOUBLE,0e0),0e0)')} AS accuracy,
    {O.r('prec')} AS precision, {O.r('rec')} AS recall, {O.r('coalesce(2e0*prec*rec/nullif(prec+rec,0e0),0e0)')} AS f1"""


@query(
    "classification_metrics",
    O.SCORED + f""", c AS (SELECT count(*) FILTER (score < 0.45e0 AND label = 0) AS tn,
      count(*) FILTER (score >= 0.45e0 AND label = 0) AS fp, count(*) FILTER (score < 0.45e0 AND label = 1) AS fn,
      count(*) FILTER (score >= 0.45e0 AND label = 1) AS tp FROM scored),
    d AS (SELECT *, coalesce(tp::DOUBLE/nullif((tp+fp)::DOUBLE,0e0),0e0) AS prec,
      coalesce(tp::DOUBLE/nullif((tp+fn)::DOUBLE,0e0),0e0) AS rec FROM c)
    SELECT tn, fp, fn, tp, {_RATIOS} FROM d""",
)
def classification_metrics(spark, sf_dir):
    return rounded(E.classification_metrics(V.scored(spark, sf_dir), 0.45))


@query(
    "threshold_sweep",
    O.SCORED + f""", t AS (SELECT 0.05e0 + i::DOUBLE*0.05e0 AS th FROM range(19) r(i)),
    c AS (SELECT th, count(*) FILTER (score >= th AND label = 1) AS tp, count(*) FILTER (score >= th AND label = 0) AS fp,
      count(*) FILTER (label = 1) AS p FROM scored, t GROUP BY th),
    d AS (SELECT *, coalesce(tp::DOUBLE/nullif((tp+fp)::DOUBLE,0e0),0e0) AS prec,
      coalesce(tp::DOUBLE/nullif(p::DOUBLE,0e0),0e0) AS rec FROM c)
    SELECT {O.r('th')} AS threshold, {O.r('prec')} AS precision, {O.r('rec')} AS recall,
      {O.r('coalesce(2e0*prec*rec/nullif(prec+rec,0e0),0e0)')} AS f1 FROM d""",
)
def threshold_sweep(spark, sf_dir):
    return rounded(E.threshold_sweep(V.scored(spark, sf_dir)))
