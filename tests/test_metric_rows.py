"""Metric rows of the pipeline: how often the input is numbered."""

from wearcast.plans import queries_eval as E
from wearcast.plans import queries_quality as Q

SF = "/root/testdata/sf0.001"


def test_stages_read_stored_telemetry(spark, monkeypatch):
    """every stage behind the ingestion reads its stored rows; none numbers the cycles again."""
    seen = []

    def refused(*_):
        raise AssertionError("numbered again")

    def kept(tel, test):
        seen.extend([tel, test])
        return E.baseline_predictions(tel, test)

    def detect(profile, fleet, ref, cur, **more):
        seen.append(cur)
        return plain(profile, fleet, ref, cur, **more)

    plain = Q.D.detect_drift
    monkeypatch.setattr(E, "lineitem_telemetry", refused)
    monkeypatch.setattr(Q, "baseline_predictions", kept)
    monkeypatch.setattr(Q.D, "detect_drift", detect)
    assert Q.q_metric_rows(spark, SF).count() > 20 and len(seen) == 3
    assert not any("Window" in df._jdf.queryExecution().optimizedPlan().toString() for df in seen)
