"""The registered model queries: full schedule, 45 features, shared trainings, only the members asked for."""
import inspect

from pyspark.sql import functions as F

from tasador.operators import score
from tasador.operators.ensemble import FAST, REFERENCE
from tasador.operators.features import FEATURES_40, FEATURES_45
from tasador.plans import catalog, q_ml
from conftest import SF_SMALL

SMALL = dict(FAST, max_iter=3, depth=2)
NAMES = ["train_segmented", "train_simple", "train_member_a", "train_member_b", "early_stopping", "feature_importance",
         "train_segment_classifier", "score_requests", "score_responses", "model_roundtrip"]


def test_registered_queries_run_the_full_schedule():
    catalog.load_all()
    assert REFERENCE["max_iter"] == 1000 and REFERENCE["step"] == 0.03
    for name in NAMES:
        assert inspect.signature(catalog.QUERIES[name]).parameters["params"].default is REFERENCE, name
    assert "FAST" not in vars(q_ml)


def test_a_query_fits_what_it_reports(spark, monkeypatch):
    fits = []
    fit = score.fit_ensembles
    monkeypatch.setattr(score, "fit_ensembles", lambda *a: fits.append((a[1], a[3])) or fit(*a))
    q_ml._KEPT.clear()
    a, imp = (getattr(q_ml, n)(spark, SF_SMALL, SMALL).collect() for n in ("train_member_a", "feature_importance"))
    assert fits == [(FEATURES_45, ("a",))] and a[0].n_trees == 3 and {r.feature for r in imp} <= set(FEATURES_45)
    simple, b, curve = (getattr(q_ml, n)(spark, SF_SMALL, SMALL).collect() for n in ("train_simple", "train_member_b", "early_stopping"))
    assert fits[1:] == [(FEATURES_45, ("a", "b"))]
    assert [r["round"] for r in curve] == [1, 2, 3]
    best = next(r["round"] for r in curve if r.is_best)
    assert simple[0].best_iter_b == best == b[0].n_trees
    assert min(curve, key=lambda r: r.valid_loss)["round"] == best


def test_classifier_sees_45_features(spark, monkeypatch):
    seen = []
    fit = q_ml.fit_classifier
    monkeypatch.setattr(q_ml, "fit_classifier", lambda *a: seen.append(a[1]) or fit(*a))
    rows = q_ml.train_segment_classifier(spark, SF_SMALL, SMALL).collect()
    assert seen == [FEATURES_45] and len(set(FEATURES_45) - set(FEATURES_40)) == 5
    assert {r.label for r in rows} >= set(q_ml.LABELS)
