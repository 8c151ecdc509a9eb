"""Train and score models, one after another or several at a time.

Rows are spread over the cluster inside each Spark job. A sweep level is the
number of model jobs submitted at once from driver threads; Spark schedules
them. Each model has a scheduler pool and a job tag of its own, so one of them
can be ended alone.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from furlens.operators import metrics
from furlens.operators.classifiers import ModelSpec, fit_predict
from furlens.sources import schemas as S

# Fixed value: the sweep levels.
LEVELS = (1, 2, 4, 6)
_POOL = "spark.scheduler.pool"


class Control:
    """Ends single models of a running sweep; the others go on.

    A model ends when it takes longer than ``deadline`` seconds, or when another
    thread calls ``cancel`` with its name. Its Spark jobs carry a tag of their
    own; while it runs, jobs with that tag are cancelled until it gives up, so
    jobs that it starts after the call go too.
    """

    POLL = 0.1  # seconds

    def __init__(self, deadline: float | None = None):
        self.deadline = deadline
        self._cancelled: set[str] = set()

    def cancel(self, model_name: str) -> None:
        self._cancelled.add(model_name)

    def reason(self, model_name: str, started: float) -> str | None:
        """Why a model has to end, if it has to."""
        if model_name in self._cancelled:
            return "cancelled"
        if self.deadline is not None and time.perf_counter() - started > self.deadline:
            return f"over its {self.deadline} seconds"
        return None


@contextmanager
def _isolated(spark: SparkSession, pool: str) -> Iterator[str]:
    """Jobs of this thread run in a pool and under a tag of their own; yields the tag.

    Pools share the cores evenly where ``spark.scheduler.mode`` is FAIR.
    """
    context = spark.sparkContext
    tag = f"furlens-{uuid.uuid4().hex}"
    before = context.getLocalProperty(_POOL)
    context.addJobTag(tag)
    context.setLocalProperty(_POOL, pool)
    try:
        yield tag
    finally:
        context.removeJobTag(tag)
        context.setLocalProperty(_POOL, before)


def _watch(spark: SparkSession, tag: str, overdue: Callable[[], str | None], done: threading.Event) -> None:
    while not done.wait(Control.POLL):
        if overdue():
            spark.sparkContext.cancelJobsWithTag(tag)


def _failure(spec: ModelSpec, error: str) -> dict:
    return {"model_name": spec.name, "accuracy": 0.0, "f1_score": 0.0, "training_time": 0.0, "success": False, "error": error}


def run_model(spec: ModelSpec, train: DataFrame, test: DataFrame, level: int = 1, control: Control | None = None) -> dict:
    """Fit, predict and score. A failure gives zeros and the error, and never raises.

    A model that ``control`` ends is a failure with that reason, also if it was
    just about to finish.
    """
    control = control or Control()
    started = time.perf_counter()
    spark = train.sparkSession
    done = threading.Event()

    def why() -> str | None:
        return control.reason(spec.name, started)

    with _isolated(spark, f"{level}_cores {spec.name}") as tag:
        watcher = threading.Thread(target=_watch, args=(spark, tag, why, done), daemon=True)
        watcher.start()
        try:
            score = metrics.scores(fit_predict(spec, train, test)).first()
            result = {
                "model_name": spec.name,
                "accuracy": float(score["accuracy"]),
                "f1_score": float(score["f1_score"]),
                "training_time": time.perf_counter() - started,
                "success": True,
                "error": None,
            }
        except Exception as e:
            result = _failure(spec, str(e))
        finally:
            done.set()
            watcher.join()
    ended = why()
    return _failure(spec, ended) if ended else result


def usable_levels(spark: SparkSession, levels: tuple[int, ...] = LEVELS, cores: int | None = None) -> list[int]:
    """Levels that ``cores``, or those of the cluster, suffice for; raises when there is none."""
    cores = spark.sparkContext.defaultParallelism if cores is None else cores
    usable = [n for n in levels if n <= cores]
    if not usable:
        raise ValueError(f"{cores} cores, none of the levels {list(levels)} fits")
    return usable


def run_sweep(models: list[ModelSpec], train: DataFrame, test: DataFrame, level: int = 1, control: Control | None = None) -> dict:
    """All models with ``level`` of them in flight. ``train`` and ``test`` should be read from storage."""
    started = time.perf_counter()
    if level == 1:
        results = [run_model(m, train, test, level, control) for m in models]
    else:
        # each call copies the local properties; threads with one copy would share pool and tag
        tasks = [inheritable_thread_target(train.sparkSession)(run_model) for _ in models]
        with ThreadPoolExecutor(level) as pool:
            running = [pool.submit(task, m, train, test, level, control) for task, m in zip(tasks, models)]
            results = [r.result() for r in running]
    return {
        "config": f"{level}_cores",
        "cores": level,
        "total_time": time.perf_counter() - started,
        "method": "sequential" if level == 1 else f"parallel_{level}cores",
        "results": results,
    }


def run_tables(spark: SparkSession, sweeps: list[dict]) -> tuple[DataFrame, DataFrame]:
    """The sweep results as model_runs and config_runs."""
    model_rows = [
        (s["config"], r["model_name"], r["accuracy"], r["f1_score"], r["training_time"], r["success"], r["error"], i)
        for s in sweeps
        for i, r in enumerate(s["results"])
    ]
    config_rows = [(s["config"], s["cores"], s["total_time"], s["method"]) for s in sweeps]
    return (
        spark.createDataFrame(model_rows, S.MODEL_RUNS),
        spark.createDataFrame(config_rows, S.CONFIG_RUNS),
    )


def run_levels(
    models: list[ModelSpec], train: DataFrame, test: DataFrame, levels: tuple[int, ...] = LEVELS, control: Control | None = None
) -> list[dict]:
    return [run_sweep(models, train, test, n, control) for n in usable_levels(train.sparkSession, levels)]
