"""Feature, training, evaluation and forecast queries.

The fits have full SQL counterparts: the normal equations are set up with aggregates and
solved by Gauss-Jordan elimination in a recursive query, so predictions and metrics of both
linear candidates are compared value by value. A forest of bagged trees has no SQL: its rows show no values, but what
must hold of them, computed here from the values and stated as true in the SQL. ``inside`` is within the range
of the training target; ``beats_mean`` and ``beats_naive`` are errors below those of the training mean and of the naive
forecast on the test rows, ``learned`` errors on its training rows below two thirds of the mean's; ``as_transform``
is the value that MLlib's own transform gives. A model that returns the mean fails them. ``fit_tree`` compares a whole tree by value.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from paneloom import roles as R
from paneloom.operators import evaluation as EV
from paneloom.operators import features as FE
from paneloom.operators import models as M
from paneloom.operators import panel as P
from paneloom.operators import scenario as SC
from paneloom.operators import summary as SM
from paneloom.plans import training as TR
from paneloom.sources import tables as TB
from paneloom.store import deal, materialise, new_path
from workload import fixtures as X
from workload.common import Registry, six_digits, tidy
from workload.sql import panel_cte, r, shown, with_

registry = Registry()
add = registry.add

SPARSE = panel_cte()
DENSE = panel_cte("supplier", "quarter")
BEFORE_END = 6  # the test periods are the last six of the dense panel


def dense_panel(spark, folder):
    return materialise(X.panel(spark, folder, "supplier", "quarter"), "panel")


def rounded(columns):
    return ", ".join(f"{r(c)} as {c}" for c in columns)


# ---- feature tables -----------------------------------------------------------------------

OVER = "over (partition by entity order by period)"
LEVEL_FEATURES = f"""level_features as (
  select *, a - a_lag_1 as a_change_1, a - a_lag_3 as a_change_3, b - b_lag_1 as b_change_1, b - b_lag_3 as b_change_3
  from (select entity, name, period, grp, grp_code, a, b, b2, lag(a, 1) {OVER} as a_lag_1, lag(a, 2) {OVER} as a_lag_2,
    lag(a, 3) {OVER} as a_lag_3, lag(b, 1) {OVER} as b_lag_1, lag(b, 3) {OVER} as b_lag_3,
    lead(a, 1) {OVER} as target_a_next from panel))"""
CHANGE_FEATURES = f"""change_features as (
  select *, a - a_lag_1 as a_change_1, a - a_lag_3 as a_change_3, b - b_lag_1 as b_change_1, b - b_lag_3 as b_change_3,
    a_future_3 - a as target_a_change_3
  from (select entity, name, period, grp, grp_code, a, b, b2, lag(a, 1) {OVER} as a_lag_1, lag(a, 3) {OVER} as a_lag_3,
    lag(b, 1) {OVER} as b_lag_1, lag(b, 3) {OVER} as b_lag_3, lead(a, 3) {OVER} as a_future_3
    from panel where a is not null and b is not null and b2 is not null))"""
LEVEL_COLUMNS = [
    "a", "a_lag_1", "a_lag_2", "a_lag_3", "b", "b2", "b_lag_1", "b_lag_3",
    "a_change_1", "a_change_3", "b_change_1", "b_change_3", "target_a_next",
]
CHANGE_COLUMNS = [
    "a", "a_lag_1", "a_lag_3", "b", "b2", "b_lag_1", "b_lag_3",
    "a_change_1", "a_change_3", "b_change_1", "b_change_3", "a_future_3", "target_a_change_3",
]


@add(
    "features_next_period",
    with_(SPARSE, LEVEL_FEATURES) + f"select entity, name, period, grp, grp_code, {rounded(LEVEL_COLUMNS)} from level_features",
)
def features_next_period(spark, folder):
    return tidy(FE.next_period_features(X.panel(spark, folder)))


@add(
    "features_change_3",
    with_(SPARSE, CHANGE_FEATURES) + f"select entity, name, period, grp, grp_code, {rounded(CHANGE_COLUMNS)} from change_features",
)
def features_change_3(spark, folder):
    return tidy(FE.change_features(X.panel(spark, folder)))


DIFFS = ["a_change_1", "a_change_3", "b_change_1", "b_change_3"]


@add("feature_diffs", with_(DENSE, LEVEL_FEATURES) + f"select entity, period, {rounded(DIFFS)} from level_features")
def feature_diffs(spark, folder):
    return tidy(FE.next_period_features(X.panel(spark, folder, "supplier", "quarter")).select(*R.KEY, *DIFFS))


def _complete(columns):
    return " and ".join(f"{c} is not null" for c in columns)


CHANGE_ROWS = f"change_rows as (select * from change_features where {_complete([*FE.CHANGE_NUMERIC, 'grp', FE.CHANGE_TARGET])})"
LEVEL_ROWS = f"level_rows as (select * from level_features where {_complete([*FE.LEVEL_NUMERIC, 'grp', FE.LEVEL_TARGET])})"


@add(
    "training_rows",
    with_(SPARSE, LEVEL_FEATURES, LEVEL_ROWS) + f"select entity, period, grp, {rounded(LEVEL_COLUMNS)} from level_rows",
)
def training_rows(spark, folder):
    rows = FE.training_rows(FE.next_period_features(X.panel(spark, folder)), FE.LEVEL_NUMERIC, FE.LEVEL_TARGET)
    return tidy(rows.select(*R.KEY, R.GROUP, *LEVEL_COLUMNS))


CUT = f"(select max(period) - {BEFORE_END} from panel)"


@add(
    "time_split",
    with_(DENSE, CHANGE_FEATURES, CHANGE_ROWS)
    + f"""select case when period <= {CUT} then 'train' else 'test' end as part, count(*) as row_count,
  min(period) as min_period, max(period) as max_period from change_rows group by 1""",
)
def time_split(spark, folder):
    panel = dense_panel(spark, folder)
    rows = FE.training_rows(FE.change_features(panel), FE.CHANGE_NUMERIC, FE.CHANGE_TARGET)
    return tidy(FE.split_counts(rows, P.latest_period(panel) - BEFORE_END))


def _last_train(panel):
    return panel.agg(F.max(R.PERIOD)).first()[0] - BEFORE_END


def change_split(spark, folder, panel=None):
    panel = dense_panel(spark, folder) if panel is None else panel
    rows = FE.training_rows(FE.change_features(panel), FE.CHANGE_NUMERIC, FE.CHANGE_TARGET)
    return FE.time_split(materialise(rows, "rows"), _last_train(panel))


def level_split(spark, folder, panel=None):
    panel = dense_panel(spark, folder) if panel is None else panel
    rows = FE.training_rows(FE.next_period_features(panel), FE.LEVEL_NUMERIC, FE.LEVEL_TARGET)
    return FE.time_split(materialise(rows, "rows"), _last_train(panel))


CHANGE_SPLIT = f"""train as (select * from change_rows where period <= {CUT}),
test as (select * from change_rows where period > {CUT})"""
LEVEL_SPLIT = f"""train as (select * from level_rows where period <= {CUT}),
test as (select * from level_rows where period > {CUT})"""
CHANGE_DATA = (DENSE, CHANGE_FEATURES, CHANGE_ROWS, CHANGE_SPLIT)
LEVEL_DATA = (DENSE, LEVEL_FEATURES, LEVEL_ROWS, LEVEL_SPLIT)


def z(column, numeric_cast="double"):
    return f"(({column}::{numeric_cast}) - (select avg({column}) from train)) / (select stddev_pop({column}) from train)"


@add(
    "zscore_features",
    with_(*CHANGE_DATA) + f"select entity, period, {', '.join(r(z(c)) + f' as z_{c}' for c in FE.CHANGE_NUMERIC)} from test",
)
def zscore_features(spark, folder):
    train, test = change_split(spark, folder)
    scaled = FE.z_scores(test, FE.CHANGE_NUMERIC, train)
    return tidy(scaled.select(*R.KEY, *[f"z_{c}" for c in FE.CHANGE_NUMERIC]))


LEVELS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


@add(
    "onehot_group",
    with_(*CHANGE_DATA)
    + "select entity, period, "
    + ", ".join(f"cast(grp = '{g}' as bigint) as \"grp_{g}\"" for g in LEVELS)
    + " from test",
)
def onehot_group(spark, folder):
    train, test = change_split(spark, folder)
    levels = FE.group_levels(train)
    return tidy(FE.one_hot(test, levels).select(*R.KEY, *[f"grp_{g}" for g in levels]))


# ---- least squares in SQL -----------------------------------------------------------------


def solver(data_split, vector, target, name, penalty=0.0):
    """CTEs solving (X'X + penalty I) w = X'y over ``train``; ``vector`` is a list of SQL terms."""
    p, w = len(vector), len(vector) + 1
    return f"""{name}_x as (select list_value({', '.join(vector)}) as x, {target} as y from train),
{name}_cells as (
  select i, j, sum(x[i + 1] * case when j < {p} then x[j + 1] else y end) + case when i = j then {penalty}::double else 0 end as v
  from {name}_x cross join (select unnest(range({p})) as i) cross join (select unnest(range({w})) as j) group by i, j),
{name}_elimination as (
  select 0 as k, list(v order by i, j) as m from {name}_cells
  union all
  select k + 1, list_transform(range({p * w}), lambda c: case when c // {w} = k then m[c + 1] / m[k * {w} + k + 1]
    else m[c + 1] - m[(c // {w}) * {w} + k + 1] * m[k * {w} + c % {w} + 1] / m[k * {w} + k + 1] end)
  from {name}_elimination where k < {p}),
{name}_solution as (
  select list_transform(range({p}), lambda i: m[i * {w} + {p} + 1]) as weights from {name}_elimination where k = {p})"""


def predicted(vector, name):
    return f"list_dot_product(list_value({', '.join(vector)}), (select weights from {name}_solution))"


DUMMIES = [f"cast(grp = '{g}' as integer)::double" for g in LEVELS]
# Changes are differences of other columns: the independent ones span the same space.
CHANGE_SPAN = [z(c) for c in ("period", "a", "a_change_1", "a_change_3", "b", "b2", "b_lag_1", "b_lag_3")] + DUMMIES
LEVEL_SPAN = [z(c) for c in ("period", "a", "a_lag_1", "a_lag_2", "a_lag_3", "b", "b2", "b_lag_1", "b_lag_3")] + DUMMIES
CHANGE_OLS = solver(CHANGE_SPLIT, CHANGE_SPAN, FE.CHANGE_TARGET, "ols")
LEVEL_OLS = solver(LEVEL_SPLIT, LEVEL_SPAN, FE.LEVEL_TARGET, "ols")
# The penalty counts every column, collinear or not; the intercept is free, so all is centred.
CENTRED = [z(c) for c in FE.CHANGE_NUMERIC] + [
    f"({d} - (select avg(cast(grp = '{g}' as integer)) from train))" for d, g in zip(DUMMIES, LEVELS)
]
MEAN_TARGET = f"(select avg({FE.CHANGE_TARGET}) from train)"
CHANGE_RIDGE = solver(CHANGE_SPLIT, CENTRED, f"{FE.CHANGE_TARGET} - {MEAN_TARGET}", "ridge", 1.0)
OLS_PREDICTION = predicted(CHANGE_SPAN, "ols")
RIDGE_PREDICTION = f"({predicted(CENTRED, 'ridge')} + {MEAN_TARGET})"


@add("fit_ols", with_(*LEVEL_DATA, LEVEL_OLS, recursive=True) + f"select entity, period, {r(predicted(LEVEL_SPAN, 'ols'))} as prediction from test")
def fit_ols(spark, folder):
    train, test = level_split(spark, folder)
    model = M.fit(M.ols(FE.LEVEL_TARGET), train, FE.LEVEL_NUMERIC)
    return tidy(M.predict(model, test).select(*R.KEY, "prediction"))


@add("fit_ridge", with_(*CHANGE_DATA, CHANGE_RIDGE, recursive=True) + f"select entity, period, {r(RIDGE_PREDICTION)} as prediction from test")
def fit_ridge(spark, folder):
    train, test = change_split(spark, folder)
    model = M.fit(M.ridge(FE.CHANGE_TARGET), train, FE.CHANGE_NUMERIC)
    return tidy(M.predict(model, test).select(*R.KEY, "prediction"))


def mae(rows, prediction, target):
    return rows.agg(F.avg(F.abs(prediction - F.col(target)))).first()[0]


def learned(model, train, target):
    """Whether a model's error on its own training rows is below two thirds of the mean's: a forest's is, the mean's never."""
    centre = train.agg(F.avg(target)).first()[0]
    return mae(M.predict(model, train), F.col("prediction"), target) < 2 / 3 * mae(train, F.lit(centre), target)


def inside(train, target):
    """Whether a forest's prediction lies where averages of training targets can lie."""
    ends = train.agg(F.struct(F.min(target).alias("low"), F.max(target).alias("high"))).first()[0]
    return F.col("prediction").between(ends["low"] - 1e-9, ends["high"] + 1e-9)


@add(
    "fit_forest",
    with_(*CHANGE_DATA)
    + f"""select entity, period, {r(FE.CHANGE_TARGET)} as {FE.CHANGE_TARGET}, true as inside, true as beats_mean, true as beats_naive, true as learned from test""",
)
def fit_forest(spark, folder):
    target = FE.CHANGE_TARGET
    train, test = change_split(spark, folder)
    model = M.fit(M.forest(target), train, FE.CHANGE_NUMERIC)
    scored = materialise(M.predict(model, test), "scored")
    error = mae(scored, F.col("prediction"), target)
    centre = train.agg(F.avg(target)).first()[0]
    beats = {
        "beats_mean": F.lit(error < mae(test, F.lit(centre), target)),
        "beats_naive": F.lit(error < mae(test, EV.previous_change(train, "a_change_3", target), target)),
        "learned": F.lit(learned(model, train, target)),
    }
    return tidy(scored.select(*R.KEY, target, inside(train, target).alias("inside")).withColumns(beats))


# A tree of depth 2 over features on a grid of 64 steps between the training rows' ends, its splits searched exactly in SQL:
# every midpoint between neighbouring values of every feature and group slot, by the squared errors that it leaves.
TREE_FEATURES = ["a", "a_change_3", "b", "b_lag_3"]
TREE_STEPS = 64
TREE_COLUMNS = [*TREE_FEATURES, *[f"g{i}" for i in range(len(LEVELS))]]


def _split_sql(name, rows):
    """CTEs giving the best split (part, feature, threshold) of every ``part`` of ``rows``."""
    values = " union all ".join(f"select part, {i} as feature, {c}::double as v, y from {rows}" for i, c in enumerate(TREE_COLUMNS))
    return f"""{name}_values as ({values}),
{name}_sums as (select part, feature, v, count(*) as n, sum(y) as s from {name}_values group by part, feature, v),
{name}_runs as (select part, feature, v, sum(n) over lower as n, sum(s) over lower as s, sum(n) over whole as n_all, sum(s) over whole as s_all,
    lead(v) over (partition by part, feature order by v) as following from {name}_sums
  window lower as (partition by part, feature order by v rows unbounded preceding), whole as (partition by part, feature)),
{name}_best as (select part, feature, threshold from (
  select part, feature, (v + following) / 2 as threshold, row_number() over (partition by part
    order by round(s * s / n + (s_all - s) * (s_all - s) / (n_all - n), 6) desc, feature, v) as place
  from {name}_runs where following is not null) where place = 1)"""


GOES_LEFT = "case " + " ".join(f"when s.feature = {i} then t.{c} <= s.threshold" for i, c in enumerate(TREE_COLUMNS)) + " end"
ON_GRID = ", ".join(f"floor(({c} - (select min({c}) from train)) * {TREE_STEPS} / (select max({c}) - min({c}) from train)) as {c}" for c in TREE_FEATURES)
TREE_SQL = f"""tree_rows as (
  select entity, period, 0 as part, {ON_GRID}, {", ".join(f"cast(grp = '{g}' as integer) as g{i}" for i, g in enumerate(LEVELS))},
    {FE.CHANGE_TARGET} as y, period <= {CUT} as known from change_rows),
known_rows as (select * from tree_rows where known),
{_split_sql("first", "known_rows")},
halves as (select t.* exclude (part), case when {GOES_LEFT} then 1 else 2 end as part from tree_rows t cross join first_best s),
known_halves as (select * from halves where known),
{_split_sql("second", "known_halves")},
leaves as (select t.* exclude (part), 2 * t.part + case when {GOES_LEFT} then 0 else 1 end as part from halves t join second_best s using (part)),
leaf_values as (select part, avg(y) as prediction from leaves where known group by part)"""


@add("fit_tree", with_(*CHANGE_DATA, TREE_SQL) + f"select entity, period, {r('prediction')} as prediction from leaves join leaf_values using (part) where known")
def fit_tree(spark, folder):
    """One tree of the forest's kind without bagging, by its values for the training rows.

    Splits of different features that part the training rows alike are equally good, so other rows may fall either way.
    """
    train, _ = change_split(spark, folder)
    ends = train.agg(*[f(c).alias(f"{f.__name__}_{c}") for c in TREE_FEATURES for f in (F.min, F.max)]).first()
    low, high = ({c: F.lit(ends[f"{end}_{c}"]) for c in TREE_FEATURES} for end in ("min", "max"))
    on_grid = {c: F.floor((F.col(c) - low[c]) * TREE_STEPS / (high[c] - low[c])).cast("double") for c in TREE_FEATURES}
    tree = M.forest(FE.CHANGE_TARGET, trees=1, depth=2).setBootstrap(False).setMaxBins(2 * TREE_STEPS)
    rows = materialise(train.withColumns(on_grid), "on-grid")
    return tidy(M.predict(M.fit(tree, rows, TREE_FEATURES), rows).select(*R.KEY, "prediction"))


@add("model_roundtrip", with_(*CHANGE_DATA, CHANGE_OLS, recursive=True) + f"select entity, period, 'linear_regression' as model, 3::bigint as horizon, {r(OLS_PREDICTION)} as prediction from test")
def model_roundtrip(spark, folder):
    """Fitted, saved with its description, loaded again and applied."""
    train, test = change_split(spark, folder)
    model = M.fit(M.ols(FE.CHANGE_TARGET), train, FE.CHANGE_NUMERIC)
    path = new_path(spark, "bundle")
    TB.save_bundle(model, path, "linear_regression", [*FE.CHANGE_NUMERIC, R.GROUP], FE.CHANGE_TARGET, 3, "change model")
    loaded, about = TB.load_bundle(spark, path)
    scored = M.predict(loaded, test).select(*R.KEY, "prediction")
    return tidy(
        scored.withColumns(
            {"model": F.lit(about["selected_model_name"]), "horizon": F.lit(about["horizon"])}
        )
    )


# ---- baselines, metrics, selection --------------------------------------------------------

METRIC_SQL = "avg(abs(prediction - y)) as mae, sqrt(avg((prediction - y) * (prediction - y))) as rmse, 1 - avg((prediction - y) * (prediction - y)) / nullif(var_pop(y), 0) as r2"


@add("baseline_persist", with_(*LEVEL_DATA) + f"select entity, period, {rounded(['target_a_next'])}, {r('a')} as prediction from test")
def baseline_persist(spark, folder):
    _, test = level_split(spark, folder)
    return tidy(EV.persistence_baseline(test).select(*R.KEY, FE.LEVEL_TARGET, "prediction"))


SPARSE_ROWS = f"""rows as (select * from change_features where target_a_change_3 is not null),
sparse_train as (select * from rows where period <= (select max(period) - 4 from panel)),
sparse_test as (select * from rows where period > (select max(period) - 4 from panel))"""


@add(
    "baseline_prev_change",
    with_(SPARSE, CHANGE_FEATURES, SPARSE_ROWS)
    + f"""select entity, period, {r('target_a_change_3')} as target_a_change_3,
  {r('coalesce(a_change_3, (select avg(target_a_change_3) from sparse_train))')} as prediction from sparse_test""",
)
def baseline_prev_change(spark, folder):
    """On the sparse panel most rows have no three-period change and take the training mean."""
    panel = materialise(X.panel(spark, folder), "panel")
    rows = materialise(FE.change_features(panel).where(F.col(FE.CHANGE_TARGET).isNotNull()), "rows")
    train, test = FE.time_split(rows, panel.agg(F.max(R.PERIOD)).first()[0] - 4)
    predicted_rows = EV.previous_change_baseline(test, train, "a_change_3", FE.CHANGE_TARGET)
    return tidy(predicted_rows.select(*R.KEY, FE.CHANGE_TARGET, "prediction"))


@add(
    "regression_metrics",
    with_(*LEVEL_DATA)
    + f"select grp, {rounded(['mae', 'rmse', 'r2'])} from (select grp, {METRIC_SQL} from (select grp, a as prediction, target_a_next as y from test) group by grp)",
)
def regression_metrics(spark, folder):
    _, test = level_split(spark, folder)
    return tidy(EV.regression_metrics(EV.persistence_baseline(test), FE.LEVEL_TARGET, "prediction", [R.GROUP]))


@add(
    "prediction_errors",
    with_(*CHANGE_DATA)
    + f"""select entity, name, period, {r('a')} as a, {r('a_change_3')} as prediction, {r('a_change_3 - target_a_change_3')} as error from test""",
)
def prediction_errors(spark, folder):
    train, test = change_split(spark, folder)
    baseline = EV.previous_change_baseline(test, train, "a_change_3", FE.CHANGE_TARGET)
    errors = EV.prediction_errors(baseline, FE.CHANGE_TARGET)
    return tidy(errors.select(R.ENTITY, R.NAME, R.PERIOD, "a", "prediction", "error"))


PREDICTIONS = f"""predictions as (
  select entity, name, period, a, b, {FE.CHANGE_TARGET}, 'linear_regression' as model, {OLS_PREDICTION} as prediction from test
  union all
  select entity, name, period, a, b, {FE.CHANGE_TARGET}, 'ridge_regression', {RIDGE_PREDICTION} from test)"""
METRICS = f"""all_predictions as (
  select model, prediction, {FE.CHANGE_TARGET} as y, 'ml' as model_family from predictions
  union all
  select 'naive_previous_3yr_change', a_change_3, {FE.CHANGE_TARGET}, 'baseline' from test),
metrics as (select model, model_family, {METRIC_SQL} from all_predictions group by model, model_family),
flagged as (select *, model = (select model from metrics where model_family = 'ml' order by mae, model limit 1) as selected_for_scenarios
  from metrics)"""
TRAINED = (*CHANGE_DATA, CHANGE_OLS, CHANGE_RIDGE, PREDICTIONS)
SHOW_METRICS = f"model, model_family, {rounded(['mae', 'rmse', 'r2'])}, selected_for_scenarios"


def _trained(spark, folder, panel=None):
    panel = dense_panel(spark, folder) if panel is None else panel
    return TR.train_change_model(FE.change_features(panel), _last_train(panel))


def linear_only(df, *columns):
    """The columns without a forest's values."""
    return df.withColumns({c: F.when(F.col("model") != "random_forest", F.col(c)) for c in columns})


def consistent(metrics):
    return metrics.withColumn("consistent", (F.col("mae") > 0) & (F.col("mae") <= F.col("rmse")) & (F.col("r2") <= 1))


@add(
    "predictions_long",
    with_(*TRAINED, recursive=True)
    + f"""select entity, name, period, model, {rounded(['a', 'b', FE.CHANGE_TARGET, 'prediction'])}, {r(f'prediction - {FE.CHANGE_TARGET}')} as error,
  cast(null as boolean) as inside, cast(null as boolean) as beats_mean from predictions
union all
select entity, name, period, 'random_forest', {rounded(['a', 'b', FE.CHANGE_TARGET])}, null, null, true, true from test""",
)
def predictions_long(spark, folder):
    panel = dense_panel(spark, folder)
    train, test = change_split(spark, folder, panel)
    is_forest = F.col("model") == "random_forest"
    rows = _trained(spark, folder, panel).predictions
    centre = train.agg(F.avg(FE.CHANGE_TARGET)).first()[0]
    better = mae(rows.where(is_forest), F.col("prediction"), FE.CHANGE_TARGET) < mae(test, F.lit(centre), FE.CHANGE_TARGET)
    rows = rows.withColumns({"inside": F.when(is_forest, inside(train, FE.CHANGE_TARGET)), "beats_mean": F.when(is_forest, F.lit(better))})
    return tidy(linear_only(rows, "prediction", "error"))


CONSISTENT = "mae > 0 and mae <= rmse and r2 <= 1 as consistent"
BEATS_MEAN = f"mae < (select avg(abs({FE.CHANGE_TARGET} - (select avg({FE.CHANGE_TARGET}) from train))) from test) as beats_mean"


@add(
    "metrics_table",
    with_(*TRAINED, METRICS, recursive=True)
    + f"""select {SHOW_METRICS}, {CONSISTENT}, {BEATS_MEAN}, mae < (select mae from flagged where model_family = 'baseline') as beats_naive from flagged
union all
select 'random_forest', 'ml', null, null, null, false, true, true, true""",
)
def metrics_table(spark, folder):
    panel = dense_panel(spark, folder)
    train, test = change_split(spark, folder, panel)
    centre = train.agg(F.avg(FE.CHANGE_TARGET)).first()[0]
    metrics = _trained(spark, folder, panel).metrics
    naive = metrics.where("model_family = 'baseline'").first().mae
    beats = {"beats_mean": F.col("mae") < mae(test, F.lit(centre), FE.CHANGE_TARGET), "beats_naive": F.col("mae") < naive}
    return tidy(linear_only(consistent(metrics).withColumns(beats), *EV.METRICS))


@add(
    "select_flagged",
    with_(*TRAINED, METRICS, recursive=True) + f"select {SHOW_METRICS} from flagged where selected_for_scenarios",
)
def select_flagged(spark, folder):
    return tidy(_trained(spark, folder).metrics.where("selected_for_scenarios"))


@add(
    "select_best_model",
    with_(*TRAINED, METRICS, recursive=True)
    + f"select true as fitted, true as not_beaten, {r('min(mae)')} as best_linear_mae from metrics where model_family = 'ml'",
)
def select_best_model(spark, folder):
    """The best of all three fitted candidates, held against the best linear one."""
    metrics = _trained(spark, folder).metrics
    best = EV.best_model(metrics, F.col("model_family") == "ml").select("model", "mae")
    linear = metrics.where(F.col("model").isin(TR.LINEAR)).agg(F.min("mae")).scalar()
    return tidy(
        best.withColumn("best_linear_mae", linear).select(
            F.col("model").isin([*TR.LINEAR, "random_forest"]).alias("fitted"),
            (F.col("mae") <= F.col("best_linear_mae")).alias("not_beaten"),
            "best_linear_mae",
        )
    )


LEVEL_METRICS = f"""level_metrics as (select model, {METRIC_SQL} from (
  select 'linear_regression' as model, {predicted(LEVEL_SPAN, 'ols')} as prediction, {FE.LEVEL_TARGET} as y from test
  union all select 'naive_baseline', a, {FE.LEVEL_TARGET} from test) group by model)"""


def _trained_level(spark, folder):
    panel = dense_panel(spark, folder)
    return panel, TR.train_level_model(FE.next_period_features(panel), _last_train(panel))


@add(
    "train_level",
    with_(*LEVEL_DATA, LEVEL_OLS, LEVEL_METRICS, recursive=True)
    + f"""select model, {rounded(['mae', 'rmse', 'r2'])}, {CONSISTENT}, mae < (select mae from level_metrics where model = 'naive_baseline') as beats_naive,
  cast(null as boolean) as learned from level_metrics
union all
select 'random_forest', null, null, null, true, true, true""",
)
def train_level(spark, folder):
    panel, trained = _trained_level(spark, folder)
    train, _ = level_split(spark, folder, panel)
    naive = trained.metrics.where("model = 'naive_baseline'").first().mae
    fitted = F.when(F.col("model") == "random_forest", F.lit(learned(trained.models["random_forest"], train, FE.LEVEL_TARGET)))
    rows = consistent(trained.metrics).withColumns({"beats_naive": F.col("mae") < naive, "learned": fitted})
    return tidy(linear_only(rows, *EV.METRICS))


@add("model_card", with_(*TRAINED, METRICS, recursive=True) + f"select model, {shown('mae', 3)} as mae from flagged where selected_for_scenarios")
def model_card(spark, folder):
    return SM.rounded(EV.model_card(_trained(spark, folder).metrics), {"mae": 3}, half_even=False)


# ---- scenarios and recursive forecasts ----------------------------------------------------

# Given coefficients, so that the recursion itself is what is compared.
CHANGE_FORM = SC.LinearForm(
    0.9,
    {"period": -0.0005, "a": -0.06, "a_change_1": 0.15, "a_change_3": 0.1, "b": 0.02, "b2": 0.00001,
     "b_lag_1": -0.01, "b_lag_3": 0.004, "b_change_1": 0.002, "b_change_3": -0.003},
    {"ASIA": 1.5, "EUROPE": -1.25, "AFRICA": 0.5},
)
LEVEL_FORM = SC.LinearForm(
    1.1,
    {"period": 0.0002, "a": 0.8, "a_lag_1": 0.06, "a_lag_2": 0.03, "a_lag_3": 0.02, "a_change_1": 0.1, "a_change_3": 0.05,
     "b": 0.03, "b2": 0.00002, "b_lag_1": -0.01, "b_lag_3": 0.004, "b_change_1": 0.002, "b_change_3": -0.003},
    {"ASIA": 1.5, "EUROPE": -1.25, "AFRICA": 0.5},
)
AHEAD = 7  # periods forecast beyond the last one; all of them are reported
END = "(select max(last_period) + 7 from state)"
EMIT = "(select max(last_period) + 1 from state)"

SCENARIO_ROWS = (
    "scenarios(scenario, total_change) as (values "
    + ", ".join(f"('{n}', {c!r}::double)" for n, c in SC.SCENARIOS.items())
    + ")"
)
STATE = """history as (
  select * from panel where a is not null and b is not null and b2 is not null and grp is not null and name is not null),
last_rows as (select entity, max(period) as last_period from history group by entity),
state as (
  select h0.entity, h0.name, h0.grp, h0.grp_code, l.last_period, h0.a as a0, h1.a as a1, h2.a as a2, h3.a as a3,
    h0.b as b0, h1.b as b1, h2.b as b2, h3.b as b3, h0.b2 as c0
  from last_rows l join history h0 on h0.entity = l.entity and h0.period = l.last_period
    left join history h1 on h1.entity = l.entity and h1.period = l.last_period - 1
    left join history h2 on h2.entity = l.entity and h2.period = l.last_period - 2
    left join history h3 on h3.entity = l.entity and h3.period = l.last_period - 3)"""


STATE_TERMS = {
    "period": "t", "a": "a0", "a_lag_1": "a1", "a_lag_2": "a2", "a_lag_3": "a3", "a_change_1": "(a0 - a1)",
    "a_change_3": "(a0 - a3)", "b": "b0", "b2": "c0", "b_lag_1": "b1", "b_lag_3": "b3",
    "b_change_1": "(b0 - b1)", "b_change_3": "(b0 - b3)",
}


def _form_sql(form):
    effects = " ".join(f"when '{g}' then {v!r}::double" for g, v in form.group_effects.items())
    weights = " + ".join(f"{w!r}::double * {STATE_TERMS[n]}" for n, w in form.weights.items())
    return f"({form.intercept!r}::double + {weights} + case grp {effects} else 0 end)"


def recursion(prediction, predicts, end=END):
    level = "a0 + prediction / 3" if predicts == "change" else "prediction"
    needed = ["a0", "a1", "a3"] if predicts == "change" else ["a0", "a1", "a2", "a3"]
    ramp = f"(1 + total_change * greatest(0::double, least(1::double, (t + 1 - last_period)::double / ({end} - last_period))))"
    return f"""{STATE}, {SCENARIO_ROWS},
rolled as (
  select entity, name, grp, grp_code, scenario, total_change, last_period, last_period as t, a0, a1, a2, a3, b0, b1, b2, b3,
    c0, b0 as b_latest, c0 as c_latest, cast(null as double) as prediction
  from state cross join scenarios where last_period < {end}
  union all
  select entity, name, grp, grp_code, scenario, total_change, last_period, t + 1, greatest(0::double, least(100::double, {level})),
    a0, a1, a2, b_latest * {ramp}, b0, b1, b2, c_latest * {ramp}, b_latest, c_latest, prediction
  from (select * exclude (prediction), {prediction} as prediction from rolled
        where t < {end} and {_complete(needed)})),
forecast as (
  select entity, name, grp, grp_code, scenario, total_change, t as forecast_period, a0 as forecast_a, t - 1 as input_period,
    prediction as predicted_change, prediction / 3 as annualised_change, b0 as b_assumption, c0 as b2_assumption
  from rolled where t > last_period)"""


FORECAST_KEYS = "entity, name, grp, grp_code, scenario, total_change, forecast_period, input_period"
CHANGE_FORECAST = (SPARSE, recursion(_form_sql(CHANGE_FORM), "change"))
LEVEL_FORECAST = (SPARSE, recursion(_form_sql(LEVEL_FORM), "level"))
EMITTED = f"emitted as (select * from forecast where forecast_period >= {EMIT})"


def stored_state(spark, folder):
    """The few numbers per entity a forecast starts from; its steps are compute only."""
    state = materialise(SC.latest_state(SC.forecast_history(X.panel(spark, folder))), "state")
    return deal(state), state.agg(F.max("last_period")).first()[0]


def change_forecast(spark, folder, scenarios=SC.SCENARIOS):
    """The forecast and the last period of the panel."""
    state, last = stored_state(spark, folder)
    return SC.roll_forward(state, last + AHEAD, CHANGE_FORM, "change", scenarios), last


def reported(spark, folder, scenarios=SC.SCENARIOS):
    rolled, last = change_forecast(spark, folder, scenarios)
    return SC.emit_window(rolled, last + 1)


@add("scenario_grid", with_(SPARSE, SCENARIO_ROWS) + f"select entity, period, scenario, total_change, {r('b * (1 + total_change)')} as b_target from panel cross join scenarios where period = (select max(period) from panel)")
def scenario_grid(spark, folder):
    latest = P.latest_snapshot(materialise(X.panel(spark, folder).select(*R.KEY, "b"), "panel"))
    grid = SC.scenario_grid(latest)
    return tidy(grid.withColumn("b_target", F.col("b") * (F.lit(1.0) + F.col("total_change"))).drop("b"))


@add(
    "scenario_forecast_change",
    with_(*CHANGE_FORECAST, EMITTED, recursive=True)
    + f"select {FORECAST_KEYS}, {rounded(['forecast_a', 'predicted_change', 'annualised_change', 'b_assumption', 'b2_assumption'])} from emitted",
)
def scenario_forecast_change(spark, folder):
    return tidy(reported(spark, folder))


@add(
    "scenario_forecast_level",
    with_(*LEVEL_FORECAST, EMITTED, recursive=True)
    + f"select {FORECAST_KEYS}, {rounded(['forecast_a', 'b_assumption', 'b2_assumption'])} from emitted",
)
def scenario_forecast_level(spark, folder):
    state, last = stored_state(spark, folder)
    return tidy(SC.emit_window(SC.roll_forward(state, last + AHEAD, LEVEL_FORM, "level"), last + 1))


@add(
    "forecast_emit_window",
    with_(*CHANGE_FORECAST, recursive=True)
    + f"""select forecast_period >= {EMIT} as reported, count(*) as row_count, count(distinct entity) as entities,
  {r('sum(forecast_a)')} as total_a from forecast group by 1""",
)
def forecast_emit_window(spark, folder):
    """What the reporting window keeps and what it drops."""
    rolled, last = change_forecast(spark, folder)
    rolled = materialise(rolled, "forecast")
    kept = SC.emit_window(rolled, last + 1).withColumn("reported", F.lit(True))
    early = rolled.where(F.col("forecast_period") <= last).withColumn("reported", F.lit(False))
    return tidy(
        kept.unionByName(early)
        .groupBy("reported")
        .agg(
            F.count("*").alias("row_count"),
            F.count_distinct(R.ENTITY).alias("entities"),
            F.sum("forecast_a").alias("total_a"),
        )
    )


MATCHED = SC.matched_scenarios(5)
MATCHED_SQL = "(" + ", ".join(f"'{n}'" for n in MATCHED) + ")"


@add(
    "scenario_subset",
    with_(*CHANGE_FORECAST, EMITTED, recursive=True)
    + f"select entity, scenario, forecast_period, {r('forecast_a')} as forecast_a from emitted where scenario in {MATCHED_SQL}",
)
def scenario_subset(spark, folder):
    picked = {n: SC.SCENARIOS[n] for n in MATCHED}
    return tidy(reported(spark, folder, picked).select(R.ENTITY, "scenario", "forecast_period", "forecast_a"))


@add(
    "scenario_series",
    with_(*CHANGE_FORECAST, EMITTED, recursive=True)
    + f"""select name, scenario, forecast_period, {shown('forecast_a', 2)} as forecast_a, {shown('b_assumption', 2)} as b_assumption
from emitted where grp = 'ASIA' and scenario in {MATCHED_SQL} order by entity, scenario, forecast_period""",
)
def scenario_series(spark, folder):
    rows = reported(spark, folder).where(F.col(R.GROUP) == "ASIA")
    shown = SC.scenario_series(rows, MATCHED).select(R.NAME, "scenario", "forecast_period", "forecast_a", "b_assumption")
    return tidy(SM.rounded(shown, {"forecast_a": 2, "b_assumption": 2}, half_even=False))


@add(
    "scenario_counts",
    with_(*CHANGE_FORECAST, EMITTED, recursive=True)
    + """select scenario, count(*) as row_count, count(distinct entity) as entities,
  min(forecast_period) as min_period, max(forecast_period) as max_period from emitted group by scenario""",
)
def scenario_counts(spark, folder):
    return tidy(SM.scenario_counts(reported(spark, folder)))


@add(
    "scenario_spread",
    with_(*CHANGE_FORECAST, recursive=True)
    + f"select entity, {r('max(forecast_a) - min(forecast_a)')} as spread from forecast where forecast_period = {END} group by entity",
)
def scenario_spread(spark, folder):
    rolled, last = change_forecast(spark, folder)
    return tidy(SC.scenario_spread(rolled, last + AHEAD))


@add(
    "scenario_impact",
    with_(*CHANGE_FORECAST, recursive=True)
    + f"""select f.entity, f.scenario, {r('f.forecast_a')} as forecast_a, {r('f.forecast_a - c.forecast_a')} as impact
from forecast f left join forecast c on c.entity = f.entity and c.forecast_period = f.forecast_period and c.scenario = '{SC.CONSTANT}'
where f.forecast_period = {END}""",
)
def scenario_impact(spark, folder):
    rolled, last = change_forecast(spark, folder)
    impact = SC.impact_vs_constant(rolled, last + AHEAD)
    return tidy(impact.select(R.ENTITY, "scenario", "forecast_a", "impact"))


@add(
    "topk_forecast",
    with_(*CHANGE_FORECAST, recursive=True)
    + f"""select entity, name, {r('forecast_a')} as forecast_a from (
  select * from forecast where forecast_period = {END} and scenario = '{MATCHED[0]}'
  order by {r('forecast_a')} desc nulls last, entity limit 10) order by forecast_a, entity""",
)
def topk_forecast(spark, folder):
    rolled, last = change_forecast(spark, folder)
    shown = rolled.withColumn("forecast_a", six_digits(F.col("forecast_a")))
    return tidy(SC.top_forecast(shown, MATCHED[0], last + AHEAD).select(R.ENTITY, R.NAME, "forecast_a"))


# The same standardised vectors as in training, over the recursion's state instead of a feature row.
MOMENTS = (
    "moments as materialized (select "
    + ", ".join(f"avg({c}) as mean_{c}, stddev_pop({c}) as sd_{c}" for c in FE.CHANGE_NUMERIC)
    + ", "
    + ", ".join(f"avg(cast(grp = '{g}' as integer)) as share_{i}" for i, g in enumerate(LEVELS))
    + f", avg({FE.CHANGE_TARGET}) as mean_target from train),\n"
    "chosen as materialized (select model from flagged where selected_for_scenarios)"
)


def _state_z(column):
    return f"(({STATE_TERMS[column]})::double - (select mean_{column} from moments)) / (select sd_{column} from moments)"


STATE_SPAN = [_state_z(c) for c in FE.CHANGE_NUMERIC if not c.startswith("b_change")] + DUMMIES
STATE_CENTRED = [_state_z(c) for c in FE.CHANGE_NUMERIC] + [
    f"({d} - (select share_{i} from moments))" for i, d in enumerate(DUMMIES)
]
SELECTED_PREDICTION = f"""case (select model from chosen) when 'linear_regression' then {predicted(STATE_SPAN, 'ols')}
  else {predicted(STATE_CENTRED, 'ridge')} + (select mean_target from moments) end"""
FITTED_FORECAST = (*TRAINED, METRICS, MOMENTS, recursion(SELECTED_PREDICTION, "change"))


@add(
    "scenario_forecast_fitted",
    with_(*FITTED_FORECAST, recursive=True)
    + f"""select {FORECAST_KEYS}, {rounded(['forecast_a', 'predicted_change', 'annualised_change', 'b_assumption', 'b2_assumption'])},
  (select model from chosen) as model_name, 'sugar_sensitivity_model' as model_type
from forecast where forecast_period >= {EMIT}""",
)
def scenario_forecast_fitted(spark, folder):
    """Train, select, then forecast the dense panel with the selected model folded in."""
    panel = dense_panel(spark, folder)
    trained = TR.train_change_model(FE.change_features(panel), _last_train(panel))
    return tidy(_forecast(panel, trained.models[trained.selected], trained.selected, "change"))


def _forecast(panel, model, name, predicts):
    last = SC.forecast_history(panel).agg(F.max(R.PERIOD)).first()[0]
    return TR.forecast(panel, model, name, predicts, last + 1, last + AHEAD)


# Which rows there are, and the supply they assume, does not depend on the predictor.
LEVEL_ROWS_AHEAD = (
    with_(DENSE, recursion("a0", "level"), recursive=True)
    + f"""select {FORECAST_KEYS}, {rounded(['b_assumption', 'b2_assumption'])}, true as inside
from forecast where forecast_period >= {EMIT}"""
)


def _without_values(forecast):
    return tidy(forecast.withColumn("inside", F.col("forecast_a").between(0, 100)).drop("forecast_a"))


@add("scenario_forecast_forest", LEVEL_ROWS_AHEAD.replace("true as inside", f"true as inside, case when forecast_period = {EMIT} then true end as as_transform"))
def scenario_forecast_forest(spark, folder):
    """The forecast with the level model's forest, all periods in one pass; the first period is held against MLlib's transform."""
    panel = dense_panel(spark, folder)
    train, _ = level_split(spark, folder, panel)
    model = M.fit(M.forest(FE.LEVEL_TARGET, depth=12), train, FE.LEVEL_NUMERIC)
    forecast = _forecast(panel, model, "random_forest", "level")
    history = SC.forecast_history(panel)
    last = history.agg(F.max(R.PERIOD)).first()[0]
    now = SC.latest_state(history).where(F.col("last_period") == last)
    step = M.forecast_with_model(model, now, last + 1, "level", {SC.CONSTANT: 0.0}).select(
        F.col(R.ENTITY).alias("of"), F.col("forecast_period").alias("first"), F.col("forecast_a").alias("step_a")
    )
    both = forecast.join(step, (F.col(R.ENTITY) == F.col("of")) & (F.col("forecast_period") == F.col("first")), "left")
    return _without_values(both.withColumn("as_transform", F.abs(F.col("forecast_a") - F.col("step_a")) < 1e-9).drop("of", "first", "step_a"))


@add("forecast_level_fitted", LEVEL_ROWS_AHEAD)
def forecast_level_fitted(spark, folder):
    """Train the level candidates, take the best and forecast with it, whichever it is."""
    panel, trained = _trained_level(spark, folder)
    return _without_values(_forecast(panel, trained.models[trained.selected], trained.selected, "level"))
