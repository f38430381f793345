import datetime as dt
import random

import pytest

from statlake.plans import features, ml

COLUMNS = ("athlete_id string, game_id int, athlete_name string, season int, week int, "
           "game_date timestamp_ntz, is_home boolean, avg_a_3w double, avg_b_3w double, "
           "target_fantasy_ppr decimal(18,4), target_fantasy_standard decimal(18,4), split string")


@pytest.fixture(scope="module")
def frame(spark):
    from decimal import Decimal

    rnd, data = random.Random(5), []
    for i in range(200):
        a, b = rnd.random() * 10, rnd.random() if i else 0.0  # row 0: a gap, filled with 0
        y = Decimal(round(3 * a - 2 * b + (i % 2), 4)).quantize(Decimal("0.0001"))
        data.append((str(i % 9), i, "n", 2025, i % 17, dt.datetime(2025, 1, 1) + dt.timedelta(i),
                     bool(i % 2), a, None if i == 0 else b, y, y, "train" if i < 140 else "test"))
    return spark.createDataFrame(data, COLUMNS)


def test_grid_compares_every_configuration(frame):
    grid = [
        {"algorithm": "linear_regression", "hyperparameters": {}},
        {"algorithm": "random_forest", "hyperparameters": {"n_estimators": 5, "max_depth": 4}},
        {"algorithm": "gradient_boosting", "hyperparameters": {"n_estimators": 5}},
    ]
    models, metrics = ml.train_grid(frame, grid)
    got = {r.config: r for r in metrics.collect()}
    assert set(got) == set(models) and len(got) == 3
    assert all(r.test_count == 60 for r in got.values())
    assert got["linear_regression"].mae < 0.01 and got["linear_regression"].corr > 0.999
    with pytest.raises(ValueError):
        ml.regressor("other")


def test_forest_keeps_node_numbers_and_its_trees(frame):
    rows, plain = features.split_of(frame, "train"), {"n_estimators": 5, "max_depth": 8}
    forest = ml.regressor("random_forest", plain)
    assert forest.getCacheNodeIds()  # else every pass sends all trees grown so far to its tasks
    model = ml.train(rows, "random_forest", plain)
    known = model.stages[0].transform(ml.model_input(rows))
    sent = forest.copy().setCacheNodeIds(False).fit(known)
    assert model.stages[1].toDebugString.split("\n")[1:] == sent.toDebugString.split("\n")[1:]


def test_saved_model_predicts_the_same(frame, tmp_path):
    model = ml.train(features.split_of(frame, "train"), "linear_regression")
    ml.save_model(model, str(tmp_path / "m"))
    order = ["game_date", "game_id"]
    found = ml.predict(model, frame, athlete_id="3", week=None)
    a = found.orderBy(*order).collect()
    b = ml.predict(ml.load_model(str(tmp_path / "m")), frame, athlete_id="3").orderBy(
        *order).collect()
    assert a == b and {r.athlete_id for r in a} == {"3"}
    assert ml.latest_prediction(found).first() == a[-1]
    assert abs(a[0].error) == a[0].abs_error


def test_training_guards(frame):
    with pytest.raises(ValueError, match="empty"):
        features.assert_trainable(frame.where("false"))
    with pytest.raises(ValueError, match="test"):
        features.assert_trainable(frame.where("split = 'train'"))
    check = features.dataset_check(frame).first()
    assert (check.total_rows, check.train_rows, check.test_with_target) == (200, 140, 60)
