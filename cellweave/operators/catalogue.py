"""The processing catalogue: inputs, tasks, dispatches, statuses and products as grouped joins, not row-wise lookups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PROCESSED, ERRORS = 2, (3, 4)


def inputs_of_type(inputs: DataFrame, conditions: DataFrame, routines: DataFrame, input_type: str) -> DataFrame:
    """Inputs whose condition triggers a routine of that input type."""
    r = routines.where(F.col("input_type") == input_type).select(F.col("name").alias("processing_routine_name"))
    c = conditions.join(r, "processing_routine_name", "left_semi").select(F.col("name").alias("processing_condition_name"))
    return inputs.join(c, "processing_condition_name", "left_semi")


def without(left: DataFrame, right: DataFrame, key: str, other: str, null_safe: bool = False) -> DataFrame:
    """Rows of left whose key right does not have; with null_safe a null key is a value as any other."""
    r = right.select(F.col(other).alias("_k")).distinct()
    on = F.col(key).eqNullSafe(F.col("_k")) if null_safe else F.col(key) == F.col("_k")
    return left.join(r, on, "left_anti")


def status_by_task(dispatches: DataFrame, workflow: DataFrame) -> DataFrame:
    """Per task with a status: counts, whether one is processed, the last status by date and id."""
    w = workflow.join(dispatches.select(F.col("id").alias("dispatch_fk_id"), "processing_task_fk_id"), "dispatch_fk_id")
    s = F.col("processing_status_id")
    return w.groupBy(F.col("processing_task_fk_id").alias("task_id")).agg(
        F.count("*").alias("statuses"), F.count_if(s.isin(*ERRORS)).alias("errors"), F.bool_or(s == PROCESSED).alias("processed"),
        F.max_by("processing_status_id", F.struct("date", "id")).alias("last_status"),
    )


def with_status(tasks: DataFrame, dispatches: DataFrame, workflow: DataFrame) -> DataFrame:
    """Tasks with processed and errors; false and 0 for those without a status."""
    s = status_by_task(dispatches, workflow)
    return tasks.join(s, tasks.id == s.task_id, "left").select(tasks["*"], F.coalesce("processed", F.lit(False)).alias("processed"), F.coalesce("errors", F.lit(0)).alias("errors"))


def status_history(dispatches: DataFrame, workflow: DataFrame) -> DataFrame:
    d = dispatches.select(F.col("id").alias("dispatch_fk_id"), F.col("processing_task_fk_id").alias("task_id"))
    return workflow.join(d, "dispatch_fk_id").select("task_id", F.col("id").alias("status_id"), "dispatch_fk_id", "processing_status_id", "date")


def current_dispatch(dispatches: DataFrame) -> DataFrame:
    """The dispatch of the highest id of each task."""
    return dispatches.groupBy(F.col("processing_task_fk_id").alias("task_id")).agg(F.max("id").alias("dispatch_id"), F.max_by("dispatch_date", "id").alias("dispatch_date"))


def machines_processed(with_status_: DataFrame) -> DataFrame:
    """Per machine whether all of its tasks are processed."""
    return with_status_.groupBy("virtual_machine_id").agg(F.bool_and("processed").alias("all_processed"), F.count("*").alias("tasks"))


def inputs_progress(inputs: DataFrame, with_status_: DataFrame) -> DataFrame:
    """Per input: whether any task is processed, and whether all have ended (false without tasks; a null end is none)."""
    g = with_status_.groupBy("input_fk_id").agg(F.bool_or("processed").alias("any"), F.count_if(~F.coalesce("has_ended", F.lit(False))).alias("open"), F.count("*").alias("tasks"))
    return inputs.join(g, inputs.id == g.input_fk_id, "left").select(
        inputs.id.alias("input_id"), F.coalesce("any", F.lit(False)).alias("any_processed"), F.coalesce(F.col("open") == 0, F.lit(False)).alias("all_ended"), F.coalesce("tasks", F.lit(0)).alias("tasks")
    )


def predecessors(tasks: DataFrame) -> DataFrame:
    """Each task with the tasks of its preceding input."""
    p = tasks.select(F.col("id").alias("predecessor_id"), F.col("input_fk_id").alias("preceding_input_id"))
    return tasks.select(F.col("id").alias("task_id"), "preceding_input_id").join(p, "preceding_input_id").select("task_id", "predecessor_id")


def ready_tasks(tasks: DataFrame, dispatches: DataFrame, workflow: DataFrame) -> DataFrame:
    """Ids of tasks not dispatched that have no preceding input or a processed task of it."""
    new = without(tasks, dispatches, "id", "processing_task_fk_id").where(~F.coalesce("has_ended", F.lit(False)))
    done = with_status(tasks, dispatches, workflow).where("processed").select(F.col("input_fk_id").alias("preceding_input_id")).distinct()
    first = new.where("preceding_input_id is null").select("id")
    return first.union(new.join(done, "preceding_input_id", "left_semi").select("id")).distinct()


def unprocessed_inputs(inputs: DataFrame, with_status_: DataFrame, since: str) -> DataFrame:
    """Inputs whose tasks, created since then, have all ended and are not processed."""
    recent = with_status_.where(F.col("creation_date") >= F.lit(since).cast("timestamp"))
    p = inputs_progress(inputs, recent)
    return p.where("all_ended and not any_processed and tasks > 0").select("input_id")


def retry_and_new(inputs: DataFrame, tasks: DataFrame, retry: DataFrame) -> DataFrame:
    """Inputs to try again and, after them, inputs without any task; an input of both comes twice."""
    again = inputs.join(retry.select(F.col("input_id").alias("id")), "id", "left_semi").withColumn("why", F.lit("retry"))
    return again.unionByName(without(inputs, tasks, "id", "input_fk_id").withColumn("why", F.lit("new")))


def usage(plan: DataFrame, *resources: str) -> DataFrame:
    """Sum of resources and number of tasks in each unit of time from t0 on for the task's duration."""
    long = plan.select(F.explode(F.expr("sequence(t0, t0 + duration - 1)")).alias("t"), *resources)
    return long.groupBy("t").agg(*[F.sum(r).alias(r) for r in resources], F.count("*").alias("tasks"))


def plan_checks(plan: DataFrame, t_max: int, cpu: int, ram: int, storage: int, machines: int) -> DataFrame:
    """How often a plan breaks each rule. Units of time: cpu, ram, storage and machines (tasks at once) beyond the limits.
    Tasks: time (end after t_max), unplanned (no t0), start (before 0), order (before the last end of the tasks of the
    preceding input), overlap (end after the start of the next on the machine), twice (ids planned more than once)."""
    used = usage(plan, "cpu", "ram", "storage_space").agg(
        F.count_if(F.col("cpu") > cpu).alias("cpu"), F.count_if(F.col("ram") > ram).alias("ram"),
        F.count_if(F.col("storage_space") > storage).alias("storage"), F.count_if(F.col("tasks") > machines).alias("machines"),
    )
    end = F.col("t0") + F.col("duration")
    tasks = plan.agg(F.count_if(end > t_max).alias("time"), F.count_if(F.col("t0").isNull()).alias("unplanned"), F.count_if(F.col("t0") < 0).alias("start"))
    ends = plan.groupBy(F.col("input").alias("preceding")).agg(F.max(end).alias("ready"))
    order = plan.join(ends, "preceding").agg(F.count_if(F.col("t0") < F.col("ready")).alias("order"))
    following = F.lead("t0").over(Window.partitionBy("vm").orderBy("t0", "id"))
    overlap = plan.where("t0 is not null").select((end > following).alias("hit")).agg(F.count_if("hit").alias("overlap"))
    twice = plan.groupBy("id").agg(F.count("*").alias("n")).agg(F.count_if(F.col("n") > 1).alias("twice"))
    parts = [df.unpivot([], df.columns, "rule", "broken") for df in (used, tasks, order, overlap, twice)]
    return reduce(DataFrame.unionByName, parts)


def time_needed(tasks_by_routine: DataFrame, cpu: int, ram: int, storage: int, machines: int) -> DataFrame:
    """Per routine the least time its tasks take under the limits; a routine beyond a limit has null."""
    at_once = F.least(F.expr(f"{cpu} div cpu"), F.expr(f"{ram} div ram"), F.expr(f"{storage} div storage_space"), F.lit(machines))
    return tasks_by_routine.withColumn("time", F.when(at_once > 0, F.ceil(F.col("n") / at_once) * F.col("duration")))


def indexation_state(products: DataFrame, workflow: DataFrame) -> DataFrame:
    """Each product with whether it was ever indexed, and whether its last indexation has failed."""
    last = workflow.groupBy(F.col("product_fk_id").alias("id")).agg(
        F.bool_or(F.col("indexation_date").isNotNull()).alias("done"), F.max_by(F.col("failure_date").isNotNull(), "id").alias("bad")
    )
    x = products.select("id").join(last, "id", "left")
    return x.select("id", F.coalesce("done", F.lit(False)).alias("indexed"), F.coalesce("bad", F.lit(False)).alias("failed"))


def indexation_files(products: DataFrame, files: DataFrame, types: DataFrame, name: str) -> DataFrame:
    """Paths of the products' indexation files of a type."""
    kind = types.where(F.col("name") == name).select(F.col("id").alias("indexation_file_type_id"))
    return files.join(kind, "indexation_file_type_id").join(products.select(F.col("id").alias("product_fk_id")), "product_fk_id").select(F.col("product_fk_id").alias("id"), "path")


def gate(with_status_: DataFrame, since: str) -> DataFrame:
    """Of the tasks created since then: how many there are, how many are not processed, and whether all are."""
    recent = with_status_.where(F.col("creation_date") >= F.lit(since).cast("timestamp"))
    return recent.agg(F.count("*").alias("tasks"), F.count_if(~F.col("processed")).alias("open"), F.bool_and("processed").alias("go"))
