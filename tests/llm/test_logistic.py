"""The calibration against the conditions of its only maximum."""

import numpy as np
import pytest

from shiftkit.llm.logistic import Logistic


@pytest.mark.parametrize("seed", [0, 1, 3, 6, 8])
def test_calibration_settles_where_labels_are_almost_separable(seed):
    rng = np.random.default_rng(seed)
    y = np.repeat([0, 1], 400)
    x = np.where(y == 1, 1.0, -1.0)[:, None] + np.column_stack([rng.standard_t(2, 800) * 0.2, rng.standard_t(2, 800)])
    weight, ridge = np.where(y == 1, 1.7, 0.3), 1e-2
    model = Logistic(x, y, weight, ridge)
    p = model.predict(x)
    assert ((p >= 0.5) == (y == 1)).mean() > 0.95
    f = np.column_stack([x, x[:, 0] ** 2, x[:, 0] * x[:, 1], x[:, 1] ** 2])
    z = np.column_stack([np.ones(800), (f - f.mean(0)) / (f.std(0) + 1e-9)])
    assert np.abs(z.T @ (weight * (y - p)) - ridge * model.b).max() < 1e-4
