"""The score table: joined by order, every kept table built once a query."""

import pytest
from conftest import SF_SMALL

from jobsheet.config import part_catalog
from jobsheet.plans import q_eval, q_sources
from jobsheet.plans.registry import REGISTRY
from jobsheet.sources import order_view as V
from jobsheet.sources.sinks import kept

CFG = part_catalog()


@pytest.mark.parametrize("query, tables", [("compare_models_table", ["targets", "splits", "scores", "thresholds"]),
                                           ("delta_vs_baseline", ["targets", "splits", "scores"]),
                                           ("write_metric_csv", ["targets", "splits", "scores", "split-metrics"])])
def test_each_table_is_built_once(spark, monkeypatch, query, tables):
    made = []

    def noting(df, name):
        made.append(name)
        return kept(df, name)
    monkeypatch.setattr(q_eval, "kept", noting)
    monkeypatch.setattr(q_sources.K, "kept", noting)
    REGISTRY[query].fn(spark, SF_SMALL)
    assert made == tables


def test_score_table_joins_orders_not_cells(spark, monkeypatch):
    rows = {}

    def noting(df, name):
        rows[name] = kept(df, name)
        return rows[name]
    monkeypatch.setattr(q_eval, "kept", noting)
    scores = q_eval.scores_wide(spark, SF_SMALL)
    n = V.order_keys(spark, SF_SMALL).count()
    assert rows["scores"].count() == n and scores.count() == n * len(CFG.targets)
    assert scores.columns == ["order_id", "split", "target", "y", "hours", "dur", "p_lr", "p_gbt"]
