"""Results as files."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

#: Jobs of one call that run at once.
AT_ONCE = 4


def together(spark: SparkSession, actions: Iterable[Callable[[], None]], at_once: int = AT_ONCE) -> None:
    """Run independent actions, some at a time, so that the small stages of one fill the gaps of another.

    All of them have ended on return. If any failed, one of their errors is raised. They
    keep the caller's local properties, such as the scheduler pool.
    """
    inheriting = inheritable_thread_target(spark)
    if inheriting is spark:  # Python threads share one JVM thread, and its properties
        inheriting = lambda action: action
    with ThreadPoolExecutor(at_once) as pool:
        running = [pool.submit(inheriting(action)) for action in actions]
    for one in running:
        one.result()


def write_result(result: DataFrame, path: str) -> None:
    """Replace the result at ``path``, as JSON lines."""
    result.write.mode("overwrite").json(path)


def read_result(spark: SparkSession, path: str) -> DataFrame:
    """A result written earlier."""
    try:
        return spark.read.json(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"{path}: no such result, write it first") from error
        raise
