"""The tree queries fit models of the reference's size."""

from staysift.operators import models
from staysift.plans import queries as Q


def test_boosted_fit_has_all_rounds_of_the_reference(spark, monkeypatch):
    asked = []

    def run(spark, sf_dir, name, params=None, tune=False, draws=4):
        asked.append(models.make_estimator(name, None, params))
        metrics = dict.fromkeys(("rmse", "mae", "r2", "within_0_5", "within_1_0", "n"), 1)
        return models.RunResult(name, tune, None, metrics), None

    monkeypatch.setattr(Q, "_run", run)
    assert Q.q_boosted_fit(spark, "").count() == 1
    (fit,) = asked
    assert (fit.getMaxIter(), fit.getMaxDepth(), fit.getStepSize()) == (300, 8, 0.05)
    assert (fit.getSubsamplingRate(), fit.getFeatureSubsetStrategy()) == (0.8, "0.8")
