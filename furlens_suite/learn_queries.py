"""Split, scaling, models, metrics and sweep summaries.

All models learn from the images with label 0 or 1; train and test set are
built once per session and shared.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from furlens.functions.kernel import FEATURE_NAMES
from furlens.operators import bayes, calibration, classifiers as M, metrics, performance, split, sweep
from furlens.operators.features import data_info
from furlens.operators.scaling import scale, scaler
from furlens_suite import derived as D


def ml_stratified_split(spark, sf_dir):
    flagged = split.stratified_split(D.rows(spark, sf_dir))
    return flagged.select("image_id", "label", "is_test")


ML_SPLIT = D.ctes(D.SPLIT) + "select image_id, label, is_test from flagged"


def ml_standard_scale(spark, sf_dir):
    train, test = D.train_test(spark, sf_dir)
    fitted = scaler(train)
    both = scale(train, fitted).unionByName(scale(test, fitted))
    return both.select(
        "image_id", *[D.rounded(F.get("features", F.lit(i))).alias(n) for i, n in enumerate(FEATURE_NAMES)]
    )


_LONG = """,
long as (
  unpivot (select v.*, f.label, f.is_test from vectors v join flagged f using (image_id))
  on columns(* exclude (image_id, label, is_test)) into name name value value),
fitted as (
  select name, avg(value) as m, case when stddev_pop(value) > 0 then stddev_pop(value) else 1 end as s
  from long where not is_test group by name),
scaled as (select image_id, label, is_test, name, (value - m) / s as z from long join fitted using (name))"""
ML_SCALE = D.ctes(D.SPLIT + _LONG) + (
    "select image_id, "
    + ", ".join(f"{D.rounded(f'max(case when name = {chr(39)}{n}{chr(39)} then z end)')} as {n}" for n in FEATURE_NAMES)
    + " from scaled group by image_id"
)


def ml_gaussian_nb(spark, sf_dir):
    train, test = D.train_test(spark, sf_dir)
    return M.naive_bayes(train, test)


_NB = D.SPLIT + _LONG + """,
floor_ as (select max(v) * 1e-9::double as f from (select var_pop(value) as v from long where not is_test group by name)),
moments as (
  select label as class, name, avg(value) as m, var_pop(value) + any_value(f) as v, count(*) as n
  from long, floor_ where not is_test group by label, name),
scores as (
  select image_id, t.label, t.is_test, class,
    ln(any_value(n) / (select count(distinct image_id) from long where not is_test))
      - 0.5 * sum(ln(2 * pi() * v) + (value - m) * (value - m) / v) as score
  from long t join moments using (name) group by image_id, t.label, t.is_test, class)"""
ML_NB = D.ctes(_NB) + """
select image_id, label, arg_max(class, score) as prediction from scores where is_test group by image_id, label"""


def ml_sigmoid(spark, sf_dir):
    """Calibrated probabilities of naive Bayes: the sigmoid is fitted on the log-odds of the train rows."""
    train, test = D.train_test(spark, sf_dir)
    models = bayes.fit(train)
    sigmoid = calibration.fit_sigmoid(bayes.log_odds(train, models))
    decided = bayes.log_odds(test, models)
    return decided.select("image_id", "label", F.round(sigmoid.of(F.col("decision")), 6).alias("probability"))


def sigmoid_sql(decisions: str) -> str:
    """CTEs that fit the sigmoid by 25 undamped Newton steps on a CTE with columns decision and label."""
    return f"""sizes_ as (select count_if(label = 1) as n1, count_if(label = 0) as n0 from {decisions}),
targets as (
  select decision as f, case when label = 1 then (n1 + 1.0) / (n1 + 2.0) else 1.0 / (n0 + 2.0) end::double as t
  from {decisions}, sizes_),
newton(step, a, b) as (
  select 0, 0.0::double, ln((n0 + 1.0) / (n1 + 1.0))::double from sizes_
  union all
  select step + 1, a - (hbb * ga - hab * gb) / (haa * hbb - hab * hab), b - (haa * gb - hab * ga) / (haa * hbb - hab * hab)
  from (
    select step, a, b, sum(f * (t - p)) as ga, sum(t - p) as gb,
      sum(f * f * p * (1 - p)) + 1e-12 as haa, sum(f * p * (1 - p)) as hab, sum(p * (1 - p)) + 1e-12 as hbb
    from (select step, a, b, f, t, 1 / (1 + exp(a * f + b)) as p from newton, targets where step < 25)
    group by step, a, b)),
sigmoid as (select a, b from newton where step = 25)"""


def ml_knn(spark, sf_dir):
    train, test = D.train_test(spark, sf_dir)
    fitted = scaler(train)
    return M.nearest(scale(train, fitted), scale(test, fitted))


def ml_knn_all(spark, sf_dir):
    """Without a bound of the train rows."""
    train, test = D.train_test(spark, sf_dir)
    fitted = scaler(train)
    return M.nearest(scale(train, fitted), scale(test, fitted), max_train_rows=None)


ML_KNN = D.ctes(D.SPLIT + _LONG + """,
pairs as (
  select t.image_id, t.label, s.image_id as other, s.label as vote, round(sum((t.z - s.z) * (t.z - s.z)), 9) as d2
  from scaled t join scaled s using (name) where t.is_test and not s.is_test group by all),
near as (select * from pairs qualify row_number() over (partition by image_id order by d2, other) <= 5)""") + """
select image_id, label, cast(case when sum(vote) * 2 > count(*) then 1 else 0 end as int) as prediction
from near group by image_id, label"""


_ODDS = """,
odds as (
  select image_id, label, is_test, sum(case when class = 1 then score else -score end) as decision
  from scores group by image_id, label, is_test),
known as (select decision, label from odds where not is_test),
"""
ML_SIGMOID = D.ctes(_NB + _ODDS + sigmoid_sql("known")).replace("with ", "with recursive ", 1) + """
select image_id, label, round(1 / (1 + exp(a * decision + b)), 6) as probability from odds, sigmoid where is_test"""


def ml_svm_probability(spark, sf_dir):
    train, test = D.train_test(spark, sf_dir)
    fitted = scaler(train)
    return M.kernel_svm_probability(scale(train, fitted), scale(test, fitted))


def _fitted(spec_name: str):
    def query(spark, sf_dir) -> DataFrame:
        train, test = D.train_test(spark, sf_dir)
        spec = next(m for m in M.default_models() if m.name == spec_name)
        return M.fit_predict(spec, train, test)

    return query


def ml_run(spark, sf_dir):
    """One successful and one failing model; the failure is a row, not an exception."""
    train, test = D.train_test(spark, sf_dir)

    def broken(train, test):
        raise ValueError("model that cannot be fitted")

    specs = [M.ModelSpec("Naive Bayes", False, M.naive_bayes), M.ModelSpec("Broken", False, broken)]
    runs, _ = sweep.run_tables(spark, [sweep.run_sweep(specs, train, test)])
    return runs.select("config", "model_name", F.round("accuracy", 6).alias("accuracy"), F.round("f1_score", 6).alias("f1_score"), "success", "error")


# The figures of naive Bayes from its closed form, and the failure as a row.
ML_RUN = f"""with predicted as ({ML_NB}),
classes as (select label as c from predicted union select prediction from predicted),
per_class as (
  select c, count_if(label = c and prediction = c) as tp, count_if(label = c) as support, count_if(prediction = c) as n
  from classes, predicted group by c),
scored as (
  select (select round(avg(case when label = prediction then 1.0 else 0.0 end), 6) from predicted) as accuracy,
    (select round(sum(2.0 * tp / (support + n) * support) / sum(support), 6) from per_class) as f1_score)
select '1_cores' as config, 'Naive Bayes' as model_name, accuracy, f1_score, true as success, null as error from scored
union all select '1_cores', 'Broken', 0.0, 0.0, false, 'model that cannot be fitted'"""


def _labelled(spark, sf_dir) -> DataFrame:
    return D.table(spark, sf_dir, "labels").select(
        F.col("quality").alias("label"), F.col("toxic").alias("prediction")
    )


def ml_accuracy(spark, sf_dir):
    return metrics.accuracy(_labelled(spark, sf_dir)).select(F.round("accuracy", 9).alias("accuracy"))


def ml_weighted_f1(spark, sf_dir):
    return metrics.weighted_f1(_labelled(spark, sf_dir)).select(F.round("f1_score", 9).alias("f1_score"))


ML_ACCURACY = "select round(avg(case when quality = toxic then 1.0 else 0.0 end), 9) as accuracy from labels"
ML_F1 = """with classes as (select quality as c from labels union select toxic from labels),
per_class as (
  select c, count_if(quality = c and toxic = c) as tp, count_if(quality = c) as support, count_if(toxic = c) as predicted
  from classes, labels group by c)
select round(sum(2.0 * tp / (support + predicted) * support) / sum(support), 9) as f1_score from per_class"""


def _sweep(spark, sf_dir, level: int, models: list | None = None) -> dict:
    train, test = D.train_test(spark, sf_dir)
    return sweep.run_sweep(models or M.default_models(), train, test, level)


def ml_sweep_sequential(spark, sf_dir):
    return _outcome(spark, [_sweep(spark, sf_dir, 1)])


def ml_sweep_parallel(spark, sf_dir):
    return _outcome(spark, [_sweep(spark, sf_dir, 4)])


# Models with a closed form, whose figures SQL can give too.
_EXACT = ("Naive Bayes", "K-Neighbors")


def _outcome(spark, sweeps: list[dict]) -> DataFrame:
    """What does not depend on the clock: the figures of models with a closed form, and for all whether they are figures of the test rows."""
    runs = sweep.run_tables(spark, sweeps)[0]
    exact = F.col("model_name").isin(*_EXACT)
    within = F.col("accuracy").between(0, 1) & F.col("f1_score").between(0, 1)
    return runs.select(
        "config",
        "model_name",
        "success",
        *[F.when(exact, F.round(c, 6)).alias(c) for c in ("accuracy", "f1_score")],
        within.alias("within_range"),
    )


def ml_sweep_scores(spark, sf_dir):
    """Accuracy and F1 of every model of the sequential sweep, learned ones included."""
    runs = sweep.run_tables(spark, [_sweep(spark, sf_dir, 1)])[0]
    return runs.select("config", "model_name", F.round("accuracy", 6).alias("accuracy"), F.round("f1_score", 6).alias("f1_score"), "success", "error")


_NAMES = ", ".join(f"'{m.name}'" for m in M.default_models())


def _scored(name: str, predictions: str) -> str:
    """A row with accuracy and weighted F1 of the rows (label, prediction) of ``predictions``."""
    return f"""(with predicted as ({predictions}),
classes as (select label as c from predicted union select prediction from predicted),
per_class as (
  select c, count_if(label = c and prediction = c) as tp, count_if(label = c) as support, count_if(prediction = c) as n
  from classes, predicted group by c)
select '{name}' as model_name, (select round(avg(case when label = prediction then 1.0 else 0.0 end), 6) from predicted) as accuracy,
  (select round(sum(2.0 * tp / (support + n) * support) / sum(support), 6) from per_class) as f1_score)"""


ML_SWEEP = f"""with exact as ({_scored("Naive Bayes", ML_NB)} union all {_scored("K-Neighbors", ML_KNN)}),
names as (select unnest([{_NAMES}]) as model_name)
select '{{level}}_cores' as config, model_name, true as success, accuracy, f1_score, true as within_range
from names left join exact using (model_name)"""
ML_SWEEP_LEVELS = "select concat(unnest([1, 2, 4]), '_cores') as config, " + str(len(M.default_models())) + " + 0 * count(*) as successful_models from embeddings"


def ml_sweep_levels(spark, sf_dir):
    runs, configs = sweep.run_tables(
        spark, [_sweep(spark, sf_dir, n) for n in sweep.usable_levels(spark, cores=4)]
    )
    return performance.config_summary(runs, configs).select("config", "successful_models")


def filt_cores(spark, sf_dir):
    """Configurations that a machine of four cores can run."""
    usable = sweep.usable_levels(spark, cores=4)
    return D.config_runs(spark, sf_dir).filter(F.col("cores").isin(*usable))


def filt_success(spark, sf_dir):
    return performance.keep_success(D.model_runs(spark, sf_dir)).select("config", "model_name", "accuracy")


def agg_avg_accuracy(spark, sf_dir):
    average = performance.average_accuracy(D.model_runs(spark, sf_dir))
    return average.withColumn("avg_accuracy", F.round("avg_accuracy", 6))


def agg_config_summary(spark, sf_dir):
    summary = performance.config_summary(D.model_runs(spark, sf_dir), D.config_runs(spark, sf_dir))
    return summary.withColumn("avg_accuracy", F.round("avg_accuracy", 6))


def _speedups(spark, sf_dir):
    metrics_ = performance.speedup(D.config_runs(spark, sf_dir))
    return metrics_.withColumns({c: F.round(c, 9) for c in ("speedup", "efficiency")})


def perf_speedup(spark, sf_dir):
    return _speedups(spark, sf_dir)


SPEEDUP = D.RUNS + """,
base as (select min(total_time) as t1 from config_runs where config = '1_cores'),
perf as (
  select config, round(case when config = '1_cores' then 1.0 when total_time > 0 then t1 / total_time else 1.0 end, 9) as speedup,
    round(case when config = '1_cores' then 1.0 when total_time > 0 then t1 / total_time / cores else 1.0 / cores end, 9) as efficiency,
    total_time
  from config_runs, base where t1 is not null)"""


def top_best_config(spark, sf_dir):
    return performance.best_config(_speedups(spark, sf_dir))


def top_best_model(spark, sf_dir):
    return performance.best_model(D.model_runs(spark, sf_dir))


def agg_data_info(spark, sf_dir):
    """Data description with the class map; the load time is left out."""
    info = data_info(D.rows(spark, sf_dir), "driver tables", "features")
    return info.select(
        "samples",
        "features",
        F.to_json("class_distribution").alias("class_distribution"),
        F.round(F.get("feature_range", F.lit(0)), 6).alias("feature_min"),
        F.round(F.get("feature_range", F.lit(1)), 6).alias("feature_max"),
        F.round("feature_mean", 6).alias("feature_mean"),
        "data_source",
    )


AGG_DATA_INFO = D.ctes(D.SPLIT + _LONG) + """
select (select count(*) from flagged) as samples, 24 as features,
  (select concat('{', string_agg(concat('"', label, '":', n), ',' order by label), '}')
   from (select label, count(*) as n from flagged group by label)) as class_distribution,
  round(min(value), 6) as feature_min, round(max(value), 6) as feature_max, round(avg(value), 6) as feature_mean,
  'driver tables' as data_source
from long"""

QUERIES = {
    "ml_stratified_split": (ml_stratified_split, ML_SPLIT),
    "ml_standard_scale": (ml_standard_scale, ML_SCALE),
    "ml_gaussian_nb": (ml_gaussian_nb, ML_NB),
    "ml_sigmoid": (ml_sigmoid, ML_SIGMOID),
    "ml_knn": (ml_knn, ML_KNN),
    "ml_knn_all": (ml_knn_all, ML_KNN),
    "ml_random_forest": (_fitted("Random Forest"), None),
    "ml_logistic": (_fitted("Logistic Regression"), None),
    "ml_decision_tree": (_fitted("Decision Tree"), None),
    "ml_svm": (_fitted("SVM"), None),
    "ml_svm_probability": (ml_svm_probability, None),
    "ml_mlp": (_fitted("Neural Network"), None),
    "ml_boosted_trees": (_fitted("XGBoost"), None),
    "ml_run": (ml_run, ML_RUN),
    "ml_accuracy": (ml_accuracy, ML_ACCURACY),
    "ml_weighted_f1": (ml_weighted_f1, ML_F1),
    "ml_sweep_sequential": (ml_sweep_sequential, ML_SWEEP.replace("{level}", "1")),
    "ml_sweep_parallel": (ml_sweep_parallel, ML_SWEEP.replace("{level}", "4")),
    "ml_sweep_scores": (ml_sweep_scores, None),
    "ml_sweep_levels": (ml_sweep_levels, ML_SWEEP_LEVELS),
    "filt_cores": (filt_cores, D.ctes(D.RUNS) + "\nselect * from config_runs where cores <= 4"),
    "filt_success": (
        filt_success,
        D.ctes(D.RUNS) + "select config, model_name, accuracy from model_runs where success",
    ),
    "agg_avg_accuracy": (
        agg_avg_accuracy,
        D.ctes(D.RUNS)
        + "select config, round(avg(accuracy), 6) as avg_accuracy from model_runs where success group by config",
    ),
    "agg_config_summary": (
        agg_config_summary,
        D.ctes(D.RUNS)
        + """select m.config, round(avg(accuracy), 6) as avg_accuracy, any_value(total_time) as total_time,
        count(*) as successful_models from model_runs m join config_runs c using (config) where success group by m.config""",
    ),
    "perf_speedup": (perf_speedup, D.ctes(SPEEDUP) + "select * from perf"),
    "top_best_config": (
        top_best_config,
        D.ctes(SPEEDUP) + "select * from perf where config <> '1_cores' order by speedup desc, config limit 1",
    ),
    "top_best_model": (
        top_best_model,
        D.ctes(D.RUNS)
        + """select model_name, accuracy, f1_score, training_time from model_runs
        where config = '1_cores' and success order by accuracy desc, model_order limit 1""",
    ),
    "agg_data_info": (agg_data_info, AGG_DATA_INFO),
}
