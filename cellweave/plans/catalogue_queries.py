"""Registered queries of the processing catalogue and of task plans."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import catalogue as K
from ..registry import query

col = F.col
STATUS = """ws AS (SELECT p.*, coalesce(processed, false) AS processed, coalesce(errors, 0) AS errors FROM processing_tasks p LEFT JOIN
    (SELECT d.processing_task_fk_id AS tid, bool_or(w.processing_status_id = 2) AS processed, count(*) FILTER (w.processing_status_id IN (3, 4)) AS errors FROM workflow w JOIN dispatch d ON d.id = w.dispatch_fk_id GROUP BY 1) s ON s.tid = p.id)"""
ALL = "input processing_tasks dispatch workflow"


def status(t):
    return K.with_status(t("processing_tasks"), t("dispatch"), t("workflow"))


@query("j02_inputs_of_type", """SELECT i.id, i.processing_condition_name, i.tile FROM input i JOIN condition c ON c.name = i.processing_condition_name JOIN routine r ON r.name = c.processing_routine_name WHERE r.input_type = 'L1'""", "input condition routine")
def _(t):
    return K.inputs_of_type(t("input"), t("condition"), t("routine"), "L1").select("id", "processing_condition_name", "tile")


@query("f_input_by_path", "SELECT id, input_path FROM input WHERE input_path = '/in/7'", "input")
def _(t):
    return t("input").where("input_path = '/in/7'").select("id", "input_path")


@query("f_input_by_day", "SELECT id, measurement_day FROM input WHERE measurement_day = 19960102", "input")
def _(t):
    return t("input").where("measurement_day = 19960102").select("id", "measurement_day")


@query("f_input_by_mission", "SELECT id, mission FROM input WHERE mission = 'S1'", "input")
def _(t):
    return t("input").where("mission = 'S1'").select("id", "mission")


@query("j03_inputs_without_task", "SELECT id FROM input i WHERE NOT EXISTS (SELECT 1 FROM processing_tasks p WHERE p.input_fk_id = i.id)", "input processing_tasks")
def _(t):
    return K.without(t("input"), t("processing_tasks"), "id", "input_fk_id").select("id")


@query("j03_inputs_without_product", "SELECT id FROM input i WHERE NOT EXISTS (SELECT 1 FROM products p WHERE p.input_fk_id = i.id)", "input products")
def _(t):
    return K.without(t("input"), t("products"), "id", "input_fk_id").select("id")


@query("j03_tasks_without_dispatch", "SELECT id FROM processing_tasks i WHERE NOT EXISTS (SELECT 1 FROM dispatch p WHERE p.processing_task_fk_id = i.id)", "processing_tasks dispatch")
def _(t):
    return K.without(t("processing_tasks"), t("dispatch"), "id", "processing_task_fk_id").select("id")


@query("j03_dispatches_without_status", "SELECT id FROM dispatch i WHERE NOT EXISTS (SELECT 1 FROM workflow p WHERE p.dispatch_fk_id = i.id)", "dispatch workflow")
def _(t):
    return K.without(t("dispatch"), t("workflow"), "id", "dispatch_fk_id").select("id")


CANDIDATES = "cand AS (SELECT CASE WHEN id % 7 = 0 THEN NULL WHEN id % 2 = 0 THEN input_path ELSE concat('/new/', CAST(id AS STRING)) END AS path, id FROM input), known AS (SELECT input_path AS p FROM input UNION ALL SELECT NULL)"


@query("j04_new_candidates", f"WITH {CANDIDATES} SELECT id, path FROM cand WHERE NOT EXISTS (SELECT 1 FROM known WHERE p IS NOT DISTINCT FROM path)", "input")
def _(t):
    i = t("input")
    cand = i.select("id", F.expr("case when id % 7 = 0 then null when id % 2 = 0 then input_path else concat('/new/', cast(id as string)) end").alias("path"))
    known = i.select("input_path").unionByName(t.spark.sql("select cast(null as string) as input_path"))
    return K.without(cand, known, "path", "input_path", null_safe=True)


@query("j05_task_processed", f"WITH {STATUS} SELECT id, processed FROM ws", ALL)
def _(t):
    return status(t).select("id", "processed")


@query("a01_error_statuses", f"WITH {STATUS} SELECT id, errors FROM ws", ALL)
def _(t):
    return status(t).select("id", "errors")


@query("f_tasks_not_finished", "SELECT id FROM processing_tasks WHERE has_ended = false", "processing_tasks")
def _(t):
    return t("processing_tasks").where("has_ended = false").select("id")


@query("j02_status_history", "SELECT d.processing_task_fk_id AS task_id, w.id AS status_id, w.dispatch_fk_id, w.processing_status_id, w.date FROM workflow w JOIN dispatch d ON d.id = w.dispatch_fk_id", "dispatch workflow")
def _(t):
    return K.status_history(t("dispatch"), t("workflow"))


@query("j02_dispatch_list", "SELECT p.id AS task_id, d.id AS dispatch_id FROM processing_tasks p JOIN dispatch d ON d.processing_task_fk_id = p.id", "processing_tasks dispatch")
def _(t):
    p = t("processing_tasks").select(col("id").alias("task_id"))
    return p.join(t("dispatch").select(col("processing_task_fk_id").alias("task_id"), col("id").alias("dispatch_id")), "task_id")


@query("j02_job_details", """SELECT d.id AS dispatch_id, p.id AS task_id, i.id AS input_id, r.name AS routine, r.cpu, r.ram, s.s_name AS machine FROM dispatch d JOIN processing_tasks p ON p.id = d.processing_task_fk_id JOIN input i ON i.id = p.input_fk_id
    JOIN condition c ON c.name = i.processing_condition_name JOIN routine r ON r.name = c.processing_routine_name JOIN supplier s ON s.s_suppkey = p.virtual_machine_id""", ALL + " condition routine")
def _(t):
    d = t("dispatch").select(col("id").alias("dispatch_id"), col("processing_task_fk_id").alias("task_id"))
    p = t("processing_tasks").select(col("id").alias("task_id"), col("input_fk_id").alias("input_id"), "virtual_machine_id")
    i = t("input").select(col("id").alias("input_id"), "processing_condition_name")
    c = t("condition").join(t("routine").withColumnRenamed("name", "processing_routine_name"), "processing_routine_name")
    c = c.select(col("name").alias("processing_condition_name"), col("processing_routine_name").alias("routine"), "cpu", "ram")
    m = t("supplier").select(col("s_suppkey").alias("virtual_machine_id"), col("s_name").alias("machine"))
    x = d.join(p, "task_id").join(i, "input_id").join(c, "processing_condition_name").join(m, "virtual_machine_id")
    return x.select("dispatch_id", "task_id", "input_id", "routine", "cpu", "ram", "machine")


@query("w10_current_dispatch", "SELECT processing_task_fk_id AS task_id, max(id) AS dispatch_id, max_by(dispatch_date, id) AS dispatch_date FROM dispatch GROUP BY 1", "dispatch")
def _(t):
    return K.current_dispatch(t("dispatch"))


@query("a02_machines_processed", f"WITH {STATUS} SELECT virtual_machine_id, bool_and(processed) AS all_processed, count(*) AS tasks FROM ws GROUP BY 1", ALL)
def _(t):
    return K.machines_processed(status(t))


@query("a02_inputs_progress", f"""WITH {STATUS} SELECT i.id AS input_id, coalesce(bool_or(processed), false) AS any_processed, count(w.id) > 0 AND count(*) FILTER (w.id IS NOT NULL AND NOT coalesce(has_ended, false)) = 0 AS all_ended,
    count(w.id) AS tasks FROM input i LEFT JOIN ws w ON w.input_fk_id = i.id GROUP BY i.id""", ALL)
def _(t):
    return K.inputs_progress(t("input"), status(t))


@query("j07_predecessors", "SELECT a.id AS task_id, b.id AS predecessor_id FROM processing_tasks a JOIN processing_tasks b ON b.input_fk_id = a.preceding_input_id", "processing_tasks")
def _(t):
    return K.predecessors(t("processing_tasks"))


@query("j07_predecessor_processed", f"WITH {STATUS} SELECT a.id AS task_id, bool_or(b.processed) AS processed FROM ws a JOIN ws b ON b.input_fk_id = a.preceding_input_id GROUP BY a.id", ALL)
def _(t):
    p = status(t).select(col("id").alias("predecessor_id"), "processed")
    return K.predecessors(t("processing_tasks")).join(p, "predecessor_id").groupBy("task_id").agg(F.bool_or("processed").alias("processed"))


@query("o01_ready_tasks", f"""WITH {STATUS}, fresh AS (SELECT * FROM ws WHERE NOT coalesce(has_ended, false) AND id NOT IN (SELECT processing_task_fk_id FROM dispatch))
    SELECT id FROM fresh WHERE preceding_input_id IS NULL UNION SELECT f.id FROM fresh f JOIN ws p ON p.input_fk_id = f.preceding_input_id AND p.processed""", ALL)
def _(t):
    return K.ready_tasks(t("processing_tasks"), t("dispatch"), t("workflow"))


@query("o05_types_not_ended", "SELECT DISTINCT r.product_data_type FROM processing_tasks p JOIN input i ON i.id = p.input_fk_id JOIN condition c ON c.name = i.processing_condition_name JOIN routine r ON r.name = c.processing_routine_name WHERE p.has_ended = false", "processing_tasks input condition routine")
def _(t):
    i = t("input").join(t("processing_tasks").where("has_ended = false").select(col("input_fk_id").alias("id")), "id", "left_semi")
    c = t("condition").join(i.select(col("processing_condition_name").alias("name")), "name", "left_semi").select(col("processing_routine_name").alias("name"))
    return t("routine").join(c, "name", "left_semi").select("product_data_type").distinct()


@query("a02_unprocessed_inputs", f"""WITH {STATUS} SELECT input_fk_id AS input_id FROM ws WHERE creation_date >= TIMESTAMP '1996-01-01' GROUP BY input_fk_id HAVING bool_and(coalesce(has_ended, false)) AND NOT bool_or(processed)""", ALL)
def _(t):
    return K.unprocessed_inputs(t("input"), status(t), "1996-01-01")


@query("j06_retry_and_new", f"""WITH {STATUS}, again AS (SELECT input_fk_id FROM ws GROUP BY 1 HAVING sum(errors) > 0) SELECT id, tile, 'retry' AS why FROM input WHERE id IN (SELECT * FROM again)
    UNION ALL SELECT id, tile, 'new' FROM input WHERE id NOT IN (SELECT input_fk_id FROM processing_tasks)""", ALL)
def _(t):
    retry = status(t).groupBy("input_fk_id").agg(F.sum("errors").alias("e")).where("e > 0").select(col("input_fk_id").alias("input_id"))
    return K.retry_and_new(t("input"), t("processing_tasks"), retry).select("id", "tile", "why")


@query("j08_candidate_products", "SELECT p.id, i.date FROM products p JOIN input i ON i.id = p.input_fk_id WHERE i.date >= TIMESTAMP '1996-06-01' AND p.product_type_id IN (SELECT DISTINCT CAST(duration AS BIGINT) FROM routine WHERE input_type = 'L2')", "products input routine")
def _(t):
    kinds = t("routine").where("input_type = 'L2'").select(col("duration").cast("bigint").alias("product_type_id"))
    p = t("products").join(kinds, "product_type_id", "left_semi")
    return p.join(t("input").where("date >= timestamp'1996-06-01'").select(col("id").alias("input_fk_id"), "date"), "input_fk_id").select("id", "date")


@query("j09_errors_of_open_inputs", f"WITH {STATUS} SELECT input_fk_id AS input_id, CAST(sum(errors) AS BIGINT) AS errors FROM ws WHERE has_ended = false GROUP BY 1", ALL)
def _(t):
    return status(t).where("has_ended = false").groupBy(col("input_fk_id").alias("input_id")).agg(F.sum("errors").alias("errors"))


@query("j19_product_paths", "SELECT p.id, p.product_path, i.input_path, i.mission FROM products p JOIN input i ON i.id = p.input_fk_id WHERE p.product_type_id = 3", "products input")
def _(t):
    return t("products").where("product_type_id = 3").join(t("input").select(col("id").alias("input_fk_id"), "input_path", "mission"), "input_fk_id").select("id", "product_path", "input_path", "mission")


@query("o03_unused_keys", "SELECT tile FROM input WHERE mission = 'S1' EXCEPT SELECT tile FROM input WHERE mission = 'S2' AND id % 3 = 0", "input")
def _(t):
    i = t("input")
    return i.where("mission = 'S1'").select("tile").subtract(i.where("mission = 'S2' and id % 3 = 0").select("tile"))


@query("o04_shared_tiles", "SELECT tile FROM input WHERE mission = 'S1' INTERSECT SELECT tile FROM input WHERE mission = 'S2'", "input")
def _(t):
    i = t("input")
    return i.where("mission = 'S1'").select("tile").intersect(i.where("mission = 'S2'").select("tile"))


@query("l02_l03_page", "SELECT id, date FROM input ORDER BY date DESC, id LIMIT 100 OFFSET 50", "input")
def _(t):
    return t("input").orderBy(F.desc("date"), "id").offset(50).limit(100).select("id", "date")


@query("l06_first_of_day", "SELECT tile, measurement_day, min(id) AS id FROM input WHERE mission = 'S2' GROUP BY 1, 2", "input")
def _(t):
    return t("input").where("mission = 'S2'").groupBy("tile", "measurement_day").agg(F.min("id").alias("id"))


@query("j18_pair_sensors", """SELECT a.tile, a.measurement_day, a.id AS s1_id, b.id AS s2_id FROM input a JOIN (SELECT tile, measurement_day, min(id) AS id FROM input WHERE mission = 'S2' GROUP BY 1, 2) b
    ON b.tile = a.tile AND b.measurement_day = a.measurement_day WHERE a.mission = 'S1'""", "input")
def _(t):
    i = t("input")
    first = i.where("mission = 'S2'").groupBy("tile", "measurement_day").agg(F.min("id").alias("s2_id"))
    return i.where("mission = 'S1'").join(first, ["tile", "measurement_day"]).select("tile", "measurement_day", col("id").alias("s1_id"), "s2_id")


@query("a23_group_by_day", "SELECT measurement_day, count(*) AS n, array_to_string(list(CAST(id AS VARCHAR) ORDER BY id), ',') AS ids FROM input GROUP BY 1", "input")
def _(t):
    return t("input").groupBy("measurement_day").agg(F.count("*").alias("n"), F.array_join(F.transform(F.sort_array(F.collect_list("id")), lambda x: x.cast("string")), ",").alias("ids"))


@query("a26_time_range", "SELECT tile, min(date) AS start, max(date) AS stop FROM input GROUP BY 1", "input")
def _(t):
    return t("input").groupBy("tile").agg(F.min("date").alias("start"), F.max("date").alias("stop"))


@query("w09_previous_task", "SELECT id, lag(id) OVER (PARTITION BY virtual_machine_id ORDER BY creation_date, id) AS previous FROM processing_tasks", "processing_tasks")
def _(t):
    return t("processing_tasks").select("id", F.lag("id").over(Window.partitionBy("virtual_machine_id").orderBy("creation_date", "id")).alias("previous"))


PLAN = "plan AS (SELECT id, virtual_machine_id AS vm, CAST((id * 7) % 200 AS INT) AS t0, CAST(1 + id % 5 AS INT) AS duration, CAST(1 + id % 4 AS INT) AS cpu, CAST(1 + id % 3 AS INT) AS ram FROM processing_tasks)"


def plan(t):
    return t("processing_tasks").selectExpr("id", "virtual_machine_id as vm", "cast((id * 7) % 200 as int) as t0", "cast(1 + id % 5 as int) as duration", "cast(1 + id % 4 as int) as cpu", "cast(1 + id % 3 as int) as ram",
                                            "cast(1 + id % 2 as int) as storage_space", "input_fk_id as input", "preceding_input_id as preceding")


@query("a24_usage", f"WITH {PLAN} SELECT CAST(x AS INT) AS t, CAST(sum(cpu) AS BIGINT) AS cpu, CAST(sum(ram) AS BIGINT) AS ram, count(*) AS tasks FROM plan, LATERAL unnest(generate_series(t0, t0 + duration - 1)) u(x) GROUP BY 1", "processing_tasks")
def _(t):
    return K.usage(plan(t), "cpu", "ram")


@query("m04_plan_checks", f"""WITH {PLAN}, q AS (SELECT plan.*, 1 + id % 2 AS storage, input_fk_id, preceding_input_id FROM plan JOIN processing_tasks USING (id)),
    u AS (SELECT CAST(x AS INT) AS t, sum(cpu) AS cpu, sum(ram) AS ram, sum(storage) AS storage, count(*) AS n FROM q, LATERAL unnest(generate_series(t0, t0 + duration - 1)) u(x) GROUP BY 1)
    SELECT 'cpu' AS rule, count(*) AS broken FROM u WHERE cpu > 1000 UNION ALL SELECT 'ram', count(*) FROM u WHERE ram > 900 UNION ALL SELECT 'storage', count(*) FROM u WHERE storage > 700 UNION ALL SELECT 'machines', count(*) FROM u WHERE n > 400
    UNION ALL SELECT 'time', count(*) FROM q WHERE t0 + duration > 200 UNION ALL SELECT 'unplanned', count(*) FROM q WHERE t0 IS NULL UNION ALL SELECT 'start', count(*) FROM q WHERE t0 < 0
    UNION ALL SELECT 'order', count(*) FROM q a WHERE EXISTS (FROM q b WHERE b.input_fk_id = a.preceding_input_id AND a.t0 < b.t0 + b.duration)
    UNION ALL SELECT 'overlap', count(*) FROM (SELECT t0 + duration > lead(t0) OVER (PARTITION BY vm ORDER BY t0, id) AS hit FROM q) WHERE hit
    UNION ALL SELECT 'twice', count(*) FROM (SELECT id FROM q GROUP BY id HAVING count(*) > 1)""", "processing_tasks")
def _(t):
    return K.plan_checks(plan(t), t_max=200, cpu=1000, ram=900, storage=700, machines=400)


@query("w11_overlaps", f"WITH {PLAN}, l AS (SELECT id, vm, t0 + duration AS stop, lead(t0) OVER (PARTITION BY vm ORDER BY t0, id) AS next FROM plan) SELECT id, vm FROM l WHERE stop > next", "processing_tasks")
def _(t):
    w = Window.partitionBy("vm").orderBy("t0", "id")
    return plan(t).withColumn("next", F.lead("t0").over(w)).where("t0 + duration > next").select("id", "vm")


@query("a25_time_needed", """WITH n AS (SELECT r.*, count(*) AS n FROM routine r JOIN condition c ON c.processing_routine_name = r.name JOIN input i ON i.processing_condition_name = c.name GROUP BY ALL)
    SELECT name, n, CAST(ceil(n / least(20 // cpu, 20 // ram, 20 // storage_space, 10)) * duration AS BIGINT) AS time FROM n""", "routine condition input")
def _(t):
    n = t("input").groupBy(col("processing_condition_name").alias("cn")).agg(F.count("*").alias("n"))
    r = t("condition").join(n, col("name") == col("cn")).select(col("processing_routine_name").alias("name"), "n").join(t("routine"), "name")
    return K.time_needed(r, 20, 20, 20, 10).select("name", "n", "time")
