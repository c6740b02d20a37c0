"""The benchmark covers the costly half: all trainers and the five-fold training."""

import bench
from broadsheet import registry


def test_headline_holds_training():
    assert {"train_linearsvc", "train_logreg", "train_ridge", "cross_validate"} <= set(bench.HEADLINE) <= set(registry.queries())
