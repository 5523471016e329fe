"""Registered learning queries (rows-only checks): fitted feature pipeline, the trial grid of
eight configurations, fold metrics, importances, and end-to-end scoring of the 60 %-life view.
Input: events telemetry."""

from __future__ import annotations

import uuid

from ..ml import hist_trees as H
from ..ml import stages as S
from ..ml import train as T
from ..ml.score import score, score_summary
from ..operators.features import join_feature_sets
from ..schema import RUL
from ..sources.telemetry import events_telemetry, truncate_lives
from .oracle_sql import TEL_EVENTS
from .registry import query


def _fitted(spark, sf):
    tel = events_telemetry(spark, sf).persist()
    pre = S.preprocessor().fit(tel)
    x = pre.transform(tel).persist()
    # cycles are row numbers and re-basing drops a prefix: they stay consecutive
    lm = S.long_pipeline(dense=True).fit(x)
    sm = S.short_pipeline(dense=True).fit(x)
    feats = join_feature_sets(lm.transform(x), sm.transform(x)).persist()
    return tel, pre, lm, sm, feats


@query("fit_feature_pipeline")
def q_fit(spark, sf):
    return _fitted(spark, sf)[4]


def _matrix(fitted, folds=True):
    """The binned training rows; the tables kept for the fits go once they are written, so trees have the memory."""
    tel, pre, lm, sm, feats = fitted
    data, inputs = T.training_set(feats)
    matrix = H.make_matrix(T.with_folds(data) if folds else data, inputs, RUL, f"matrix-{uuid.uuid4().hex}")
    for stage in (*lm.stages, *sm.stages):
        if isinstance(stage, S.MaterializeModel):
            stage.release()
    for df in (feats, pre.transform(tel), tel):
        df.unpersist()
    return matrix, inputs


def _training(spark, sf):
    return _matrix(_fitted(spark, sf))


@query("trials")
def q_trials(spark, sf):
    """All eight configurations over four folds (K9)."""
    data, inputs = _training(spark, sf)
    return T.trials_table(spark, T.tune(spark, data, inputs, model=False)["trials"])


@query("train_cv_forest")
def q_cv(spark, sf):
    """Fold metrics of the best of the four forests (K3)."""
    data, inputs = _training(spark, sf)
    return T.cv_table(spark, T.tune(spark, data, inputs, T.trial_configs()[4:], model=False)["best"])


@query("train_cv_boosted")
def q_cv_boosted(spark, sf):
    """Fold metrics of the best of the four Poisson boosted models (K3)."""
    data, inputs = _training(spark, sf)
    return T.cv_table(spark, T.tune(spark, data, inputs, T.trial_configs()[:4], model=False)["best"])


@query("feature_importance_top10")
def q_importance(spark, sf):
    """Importances of the best configuration of the eight, refitted on all rows."""
    data, inputs = _training(spark, sf)
    return T.importance_table(spark, T.tune(spark, data, inputs)["model"], inputs, top=10)


@query("score_engines")
def q_score(spark, sf):
    """The best configuration refitted, then every engine cut to 60 % of its life scored."""
    tel, pre, lm, sm, _ = fitted = _fitted(spark, sf)
    matrix, inputs = _matrix(fitted)
    res = T.tune(spark, matrix, inputs)
    tel = tel.persist()
    art = {"preprocessor": pre, "long_pipeline": lm, "short_pipeline": sm, "model": res["model"], "inputs": inputs}
    return score(truncate_lives(tel).drop("rul"), art)


@query("score_units", sql=f"""WITH {TEL_EVENTS},
life AS (SELECT unit_id, max(time_cycles) AS life FROM tel GROUP BY unit_id),
test AS (SELECT t.* FROM tel t JOIN life l ON t.unit_id = l.unit_id WHERE t.time_cycles * 10 <= l.life * 6),
per AS (SELECT unit_id, count(*) AS rows, count(*) FILTER (time_cycles > 10) >= 20 AS enough FROM test GROUP BY unit_id)
SELECT sum(rows)::BIGINT AS rows, 0::BIGINT AS rows_without_key, count(*) AS units, count(*) FILTER (enough) AS scored,
       count(*) FILTER (NOT enough) AS skipped FROM per""")
def q_score_units(spark, sf):
    """How many units of the 60 %-life view the scoring path scores and skips (one boosted model, no search)."""
    tel, pre, lm, sm, _ = fitted = _fitted(spark, sf)
    matrix, inputs = _matrix(fitted, folds=False)
    art = {"preprocessor": pre, "long_pipeline": lm, "short_pipeline": sm, "model": T.refit(matrix, T.trial_configs()[1]), "inputs": inputs}
    raw = truncate_lives(tel.persist()).drop("rul")
    return score_summary(raw, score(raw, art))
