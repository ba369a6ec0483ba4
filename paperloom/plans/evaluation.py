"""Folds, scores, class weights and the threshold search."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import labels as L
from ..operators import evaluate, folds, optimum, thresholds
from ..sources import tables
from .registry import query
from .sql import with_views

# --- SQL fragments ------------------------------------------------------------------------

QWK_SQL = """(SELECT 1 - sum(w * o) / sum(w * e) FROM (
    SELECT (i.v - j.v) * (i.v - j.v) AS w,
      (SELECT count(*) FROM {t} WHERE label = i.v AND prediction = j.v) AS o,
      (SELECT count(*) FROM {t} WHERE label = i.v) * (SELECT count(*) FROM {t} WHERE prediction = j.v)
        / (SELECT count(*) FROM {t})::DOUBLE AS e
    FROM range(1, 6) i(v), range(1, 6) j(v)))"""
CLASS_SQL = """SELECT v AS k, count(*) FILTER (label = v AND prediction = v) AS hit,
    count(*) FILTER (label = v) AS truth, count(*) FILTER (prediction = v) AS said
  FROM range(1, 6) c(v), {t} GROUP BY v"""
F1_SQL = """(SELECT avg(CASE WHEN truth + said = 0 THEN 0 ELSE 2 * hit / (truth + said)::DOUBLE END)
  FROM classes WHERE truth + said > 0)"""
REPORT_SQL = """
  SELECT CAST(k AS VARCHAR) AS class, CASE WHEN said = 0 THEN 0 ELSE round(hit / said, 6) END AS precision,
    CASE WHEN truth = 0 THEN 0 ELSE round(hit / truth, 6) END AS recall,
    round(2 * hit / (truth + said), 6) AS f1, truth AS support FROM classes WHERE truth + said > 0
  UNION ALL
  SELECT 'accuracy', round(sum(hit) / sum(truth), 6), round(sum(hit) / sum(truth), 6),
    round(sum(hit) / sum(truth), 6), CAST(sum(truth) AS BIGINT) FROM classes
  UNION ALL
  SELECT 'macro avg', round(avg(CASE WHEN said = 0 THEN 0 ELSE hit / said END), 6),
    round(avg(CASE WHEN truth = 0 THEN 0 ELSE hit / truth END), 6), round(avg(2 * hit / (truth + said)), 6),
    CAST(sum(truth) AS BIGINT) FROM classes WHERE truth + said > 0
  UNION ALL
  SELECT 'weighted avg', round(sum(truth * CASE WHEN said = 0 THEN 0 ELSE hit / said END) / sum(truth), 6),
    round(sum(hit) / sum(truth), 6), round(sum(truth * 2 * hit / (truth + said)) / sum(truth), 6),
    CAST(sum(truth) AS BIGINT) FROM classes WHERE truth + said > 0"""


def _scored(spark, sf):
    return tables.predictions(spark, sf).select("id", "label", "prediction")


# Some rows have a label or a prediction that the usual set does not hold.
ODD_SQL = """SELECT id, CAST(CASE WHEN id % 11 = 0 THEN 9 ELSE label END AS INTEGER) AS label,
    CAST(CASE WHEN id % 13 = 0 THEN 0 ELSE prediction END AS INTEGER) AS prediction FROM predictions"""


def _odd(spark, sf):
    label = F.when(F.col("id") % 11 == 0, 9).otherwise(F.col("label")).alias("label")
    prediction = F.when(F.col("id") % 13 == 0, 0).otherwise(F.col("prediction")).alias("prediction")
    return _scored(spark, sf).select("id", label, prediction)


def _report(df, **names):
    report = evaluate.classification_report(df, **names)
    return report.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


# --- folds --------------------------------------------------------------------------------


@query("stratified_kfold", with_views("SELECT id, label, fold FROM folds", "folds"))
def stratified_kfold(spark, sf):
    return folds.stratified_kfold(tables.labelled(spark, sf))


@query("stratified_split", with_views(
    """SELECT id, label, CASE WHEN row_number() OVER (PARTITION BY label ORDER BY md5(CAST(id AS VARCHAR)), id) - 1
      < round(0.2 * count(*) OVER (PARTITION BY label)) THEN 'test' ELSE 'train' END AS split FROM labelled""",
    "labelled"))
def stratified_split(spark, sf):
    return folds.stratified_split(tables.labelled(spark, sf))


def _fold_scores(spark, sf):
    """Five scores per record, as five fold models would give."""
    steps = F.explode(F.sequence(F.lit(0), F.lit(4))).alias("model")
    rows = tables.predictions(spark, sf).select("id", "score", steps)
    return rows.select("id", "model", (F.col("score") + (F.col("model") - 2) * 0.25 + F.col("model") % 2)
                       .alias("score"))


@query("fold_average", with_views(
    """SELECT id, round(avg(score + (m - 2) * 0.25::DOUBLE + m % 2), 6) AS score
      FROM predictions, range(0, 5) r(m) GROUP BY id""", "predictions"))
def fold_average(spark, sf):
    return folds.fold_average(_fold_scores(spark, sf)).withColumn("score", F.round("score", 6))


@query("fold_average_vectors", with_views(
    "SELECT id, " + ", ".join(
        f"round(avg(1 / (1 + abs(score + m * 0.1::DOUBLE - {k}))), 6) AS p{k}" for k in L.LABELS)
    + " FROM predictions, range(0, 5) r(m) GROUP BY id", "predictions"))
def fold_average_vectors(spark, sf):
    steps = F.explode(F.sequence(F.lit(0), F.lit(4))).alias("m")
    rows = tables.predictions(spark, sf).select("id", "score", steps)
    near = F.array(*[1 / (1 + F.abs(F.col("score") + F.col("m") * 0.1 - k)) for k in L.LABELS])
    mean = folds.fold_average_vectors(rows.select("id", near.alias("probability")), len(L.LABELS))
    return mean.select("id", *[F.round(F.col("probability")[k - 1], 6).alias(f"p{k}") for k in L.LABELS])


@query("cv_mean_score", with_views(
    "SELECT round(avg(score), 6) AS mean_score, count(*) AS folds FROM per_fold", "folds", "predictions",
    scored="SELECT f.fold, p.label, p.prediction FROM predictions p JOIN folds f ON f.id = p.id",
    classes="""SELECT fold, v, count(*) FILTER (label = v AND prediction = v) AS hit,
      count(*) FILTER (label = v) AS truth, count(*) FILTER (prediction = v) AS said
      FROM range(1, 6) c(v), scored GROUP BY fold, v""",
    per_fold="""SELECT fold, avg(2 * hit / (truth + said)) AS score FROM classes WHERE truth + said > 0
      GROUP BY fold"""))
def cv_mean_score(spark, sf):
    return evaluate.cv_mean_score(folds.with_folds(_scored(spark, sf))).withColumn("mean_score", F.round("mean_score", 6))


# --- scores -------------------------------------------------------------------------------


@query("accuracy", with_views(
    "SELECT round(avg(CAST(label = prediction AS DOUBLE)), 6) AS accuracy FROM predictions", "predictions"))
def accuracy(spark, sf):
    return _scored(spark, sf).agg(F.round(evaluate.accuracy("label", "prediction"), 6).alias("accuracy"))


@query("confusion_matrix", with_views(
    """SELECT CAST(i.v AS INTEGER) AS label, CAST(j.v AS INTEGER) AS prediction, count(p.id) AS n
      FROM seen i CROSS JOIN seen j
      LEFT JOIN odd_scored p ON p.label = i.v AND p.prediction = j.v GROUP BY i.v, j.v""", "predictions",
    odd_scored=ODD_SQL, seen="SELECT label AS v FROM odd_scored UNION SELECT prediction FROM odd_scored"))
def confusion_matrix(spark, sf):
    return evaluate.confusion_matrix(_odd(spark, sf))


@query("classification_report", with_views(
    REPORT_SQL, "predictions", odd_scored=ODD_SQL,
    classes=CLASS_SQL.format(t="odd_scored").replace("range(1, 6)", "(SELECT DISTINCT label FROM odd_scored UNION SELECT prediction FROM odd_scored)")))
def classification_report(spark, sf):
    return _report(_odd(spark, sf))


@query("macro_f1", with_views(
    f"SELECT round({F1_SQL}, 6) AS macro_f1", "predictions", classes=CLASS_SQL.format(t="predictions")))
def macro_f1(spark, sf):
    return _scored(spark, sf).agg(F.round(evaluate.macro_f1("label", "prediction"), 6).alias("macro_f1"))


@query("qwk", with_views(f"SELECT round({QWK_SQL.format(t='predictions')}, 6) AS qwk", "predictions"))
def qwk(spark, sf):
    return _scored(spark, sf).agg(F.round(evaluate.qwk("label", "prediction"), 6).alias("qwk"))


@query("combined_objective", with_views(
    f"SELECT round(0.6 * {QWK_SQL.format(t='predictions')} + 0.4 * {F1_SQL}, 6) AS objective", "predictions",
    classes=CLASS_SQL.format(t="predictions")))
def combined_objective(spark, sf):
    value = evaluate.combined_objective("label", "prediction")
    return _scored(spark, sf).agg(F.round(value, 6).alias("objective"))



@query("class_weights", with_views(
    """SELECT label, round(w / avg(w) OVER (), 6) AS weight FROM (
      SELECT label, sum(count(*)) OVER () / (5 * count(*)) AS w FROM paper_texts GROUP BY label)""", "paper_texts"))
def class_weights(spark, sf):
    weights = evaluate.class_weights(tables.paper_texts(spark, sf))
    return weights.withColumn("weight", F.round("weight", 6))


@query("balanced_weight", with_views(
    """SELECT id, label, round(w, 6) AS weight FROM labelled JOIN (
      SELECT label, sum(count(*)) OVER () / (count(*) OVER () * count(*)) AS w FROM labelled GROUP BY label)
      USING (label)""", "labelled"))
def balanced_weight(spark, sf):
    weighted = evaluate.balanced_weight(tables.labelled(spark, sf))
    return weighted.select("id", "label", F.round("weight", 6).alias("weight"))


# --- threshold search ---------------------------------------------------------------------


def _objective_sql(candidates: str) -> str:
    """t1..t4 (in hundredths) and the objective of each candidate, from cumulative counts."""
    borders = ["99", "t1", "t2", "t3", "t4", "501"]

    def cell(i: int, j: int) -> str:
        return f"(below[{i + 1}][{borders[j + 1]} - 98] - below[{i + 1}][{borders[j]} - 98])"

    k = range(5)
    cells = ", ".join(f"{cell(i, j)}::DOUBLE AS c{i}{j}" for i in k for j in k)
    truth = ", ".join(f"{' + '.join(f'c{i}{j}' for j in k)} AS r{i}" for i in k)
    said = ", ".join(f"{' + '.join(f'c{i}{j}' for i in k)} AS s{j}" for j in k)
    gap = " + ".join(f"c{i}{j} * {(i - j) ** 2}" for i in k for j in k)
    expected = " + ".join(f"r{i} * s{j} * {(i - j) ** 2}" for i in k for j in k)
    n = " + ".join(f"r{i}" for i in k)
    f1 = " + ".join(f"CASE WHEN r{i} + s{i} > 0 THEN 2 * c{i}{i} / (r{i} + s{i}) ELSE 0 END" for i in k)
    present = " + ".join(f"CASE WHEN r{i} + s{i} > 0 THEN 1 ELSE 0 END" for i in k)
    return f"""SELECT t1, t2, t3, t4, round(0.6::DOUBLE * CASE WHEN ({expected}) = 0 THEN 0
        ELSE 1 - ({n}) * ({gap}) / ({expected}) END + 0.4::DOUBLE * ({f1}) / ({present}), 9) AS objective
      FROM (SELECT *, {truth}, {said} FROM (SELECT t1, t2, t3, t4, {cells} FROM {candidates}, below_row))"""


THRESHOLD_VIEWS = {
    "hist": """SELECT label, greatest(99, least(500, floor(round(score * 100, 6))::INTEGER)) AS bin, count(*) AS n
      FROM predictions GROUP BY ALL""",
    "below_row": """SELECT list(b ORDER BY label) AS below FROM (
      SELECT label, list(below ORDER BY bin) AS b FROM (
        SELECT l.label, s.bin, coalesce(sum(n) OVER (PARTITION BY l.label ORDER BY s.bin
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
        FROM range(1, 6) l(label) CROSS JOIN range(99, 502) s(bin)
        LEFT JOIN hist h ON h.label = l.label AND h.bin = s.bin) GROUP BY label)""",
    "coarse": """SELECT 100 + 10 * a.v AS t1, 100 + 10 * b.v AS t2, 100 + 10 * c.v AS t3, 100 + 10 * d.v AS t4
      FROM range(0, 41) a(v), range(0, 41) b(v), range(0, 41) c(v), range(0, 41) d(v)
      WHERE a.v < b.v AND b.v < c.v AND c.v < d.v""",
    "coarse_scored": _objective_sql("coarse"),
    "coarse_best": "SELECT * FROM coarse_scored ORDER BY objective DESC, t1, t2, t3, t4 LIMIT 1",
    "fine": """SELECT * FROM (SELECT greatest(100, least(500, t1 + a.v)) AS t1, greatest(100, least(500, t2 + b.v)) AS t2,
        greatest(100, least(500, t3 + c.v)) AS t3, greatest(100, least(500, t4 + d.v)) AS t4
      FROM coarse_best, range(-5, 6) a(v), range(-5, 6) b(v), range(-5, 6) c(v), range(-5, 6) d(v))
      WHERE t1 < t2 AND t2 < t3 AND t3 < t4""",
    "fine_scored": _objective_sql("fine"),
}


@query("threshold_search", with_views(
    """SELECT t1 / 100 AS t1, t2 / 100 AS t2, t3 / 100 AS t3, t4 / 100 AS t4, objective
      FROM fine_scored ORDER BY objective DESC, fine_scored.t1, fine_scored.t2, fine_scored.t3, fine_scored.t4
      LIMIT 1""", "predictions", **THRESHOLD_VIEWS))
def threshold_search(spark, sf):
    return thresholds.threshold_search(tables.predictions(spark, sf))


OPTIMUM_VIEWS = {
    "hist": THRESHOLD_VIEWS["hist"], "below_row": THRESHOLD_VIEWS["below_row"],
    "grid": """SELECT 100 + 5 * a.v AS t1, 100 + 5 * b.v AS t2, 100 + 5 * c.v AS t3, 100 + 5 * d.v AS t4
      FROM range(0, 81) a(v), range(0, 81) b(v), range(0, 81) c(v), range(0, 81) d(v)
      WHERE a.v < b.v AND b.v < c.v AND c.v < d.v""",
    "scored": _objective_sql("grid"),
}


@query("threshold_optimum", with_views(
    """SELECT t1 / 100 AS t1, t2 / 100 AS t2, t3 / 100 AS t3, t4 / 100 AS t4, objective
      FROM scored ORDER BY objective DESC, scored.t1, scored.t2, scored.t3, scored.t4 LIMIT 1""", "predictions", **OPTIMUM_VIEWS))
def threshold_optimum(spark, sf):
    """The certain best of all sets on the grid of twentieths, which SQL can still enumerate."""
    return optimum.threshold_optimum(tables.predictions(spark, sf), step=5)


@query("threshold_optimum_fine")
def threshold_optimum_fine(spark, sf):
    """The certain best of all sets of hundredths."""
    return optimum.threshold_optimum(tables.predictions(spark, sf))


# --- saved model replies ------------------------------------------------------------------


def _evaluated(spark, sf):
    return evaluate.llm_eval(tables.llm_replies(spark, sf), "reply")


HEAD_REPLIES = """SELECT * FROM (SELECT * FROM parsed_replies ORDER BY id LIMIT 50) WHERE llm_score IS NOT NULL"""


@query("llm_eval", with_views(
    REPORT_SQL, "parsed_replies", scored=f'SELECT Label AS label, llm_score AS prediction FROM ({HEAD_REPLIES})',
    classes=CLASS_SQL.format(t="scored")))
def llm_eval(spark, sf):
    return _report(_evaluated(spark, sf), label="Label", prediction="llm_score")


@query("llm_eval_wrong", with_views(
    f"""SELECT title, "Label", llm_score, llm_reason FROM ({HEAD_REPLIES}) WHERE Label <> llm_score
      ORDER BY id LIMIT 20""", "parsed_replies"))
def llm_eval_wrong(spark, sf):
    wrong = _evaluated(spark, sf).where(F.col("Label") != F.col("llm_score"))
    return wrong.orderBy("id").limit(20).select("title", "Label", "llm_score", "llm_reason")
