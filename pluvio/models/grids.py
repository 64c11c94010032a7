"""Search grids (ML11, ML12): the configurations that MLlib can fit.

Fixed values, equal to the reference's. Left out, since MLlib has no
counterpart and a knob is never ignored: dart and goss boosting, L1/L2 leaf
penalties, quantile objectives. Tweedie and huber objectives are linear
models in MLlib, so of each family only the entries that differ in the
objective remain, without tree knobs.
"""

_SUB = {"subsample": 0.8, "colsample_bytree": 0.8}

CLASSIFIERS = {
    "clf_unbalance_base": {"n_estimators": 300, "learning_rate": 0.05, "max_depth": 6, "num_leaves": 31, "min_child_samples": 20, **_SUB},
    "clf_scale_pos_weight_4": {"is_unbalance": False, "scale_pos_weight": 4.0, "n_estimators": 300, "learning_rate": 0.05, "max_depth": 6,
                               "num_leaves": 31, "min_child_samples": 20, **_SUB},
    "clf_scale_pos_weight_6": {"is_unbalance": False, "scale_pos_weight": 6.0, "n_estimators": 300, "learning_rate": 0.05, "max_depth": 6,
                               "num_leaves": 31, "min_child_samples": 20, **_SUB},
    "clf_shallow": {"n_estimators": 300, "learning_rate": 0.05, "max_depth": 4, "num_leaves": 15, "min_child_samples": 30, **_SUB},
    "clf_deep": {"n_estimators": 300, "learning_rate": 0.05, "max_depth": 10, "num_leaves": 100, "min_child_samples": 20, **_SUB},
    "clf_deep_conservative": {"n_estimators": 300, "learning_rate": 0.05, "max_depth": 10, "num_leaves": 100, "min_child_samples": 50, **_SUB},
    "clf_slow_learner": {"n_estimators": 800, "learning_rate": 0.01, "max_depth": 6, "num_leaves": 31, "min_child_samples": 20, **_SUB},
    "clf_fast_shallow": {"n_estimators": 500, "learning_rate": 0.08, "max_depth": 4, "num_leaves": 15, "min_child_samples": 25, **_SUB},
    "clf_high_min_child": {"n_estimators": 400, "learning_rate": 0.05, "max_depth": 6, "num_leaves": 31, "min_child_samples": 60, **_SUB},
}
REGRESSORS = {
    "reg_l1": {"objective": "regression_l1", "n_estimators": 300, "learning_rate": 0.05, "max_depth": 6, "num_leaves": 31,
               "min_child_samples": 15, **_SUB},
    "reg_slow_l1": {"objective": "regression_l1", "n_estimators": 800, "learning_rate": 0.01, "max_depth": 6, "num_leaves": 31,
                    "min_child_samples": 15, **_SUB},
    "reg_tweedie_1.2": {"objective": "tweedie", "tweedie_variance_power": 1.2},
    "reg_tweedie_1.5": {"objective": "tweedie", "tweedie_variance_power": 1.5},
    "reg_tweedie_1.8": {"objective": "tweedie", "tweedie_variance_power": 1.8},
    "reg_tweedie_1.5_nolog": {"objective": "tweedie", "tweedie_variance_power": 1.5, "log_target": False},
}
