"""DuckDB oracle for training-log analytics and registry look-ups."""

from __future__ import annotations

from tickloom.plans.contracts import digits
from tickloom.plans.oracle_market import BRAND
from tickloom.plans.rounding import round_sql

TLOG = """tl AS (SELECT CAST(user_id AS VARCHAR) AS run_id, ts, event_id, value AS reward, event_type,
               row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS step FROM events),
pr AS (SELECT run_id, step, mean_reward, std_reward, reward AS last_reward FROM (
         SELECT *, avg(reward) OVER (PARTITION BY run_id ORDER BY step ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS mean_reward,
                stddev_pop(reward) OVER (PARTITION BY run_id ORDER BY step ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS std_reward
         FROM tl) WHERE step % 10 = 0 AND step > 5),
imp AS (SELECT *, coalesce(mean_reward > max(mean_reward) OVER (PARTITION BY run_id ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                           mean_reward IS NOT NULL AND NOT isnan(mean_reward)) AS improved FROM pr)"""


def q_training_progress():
    cols = ["run_id", "step", "mean_reward", "std_reward", "last_reward"]
    return round_sql(f"WITH {TLOG} SELECT * FROM pr", cols, {"mean_reward", "std_reward", "last_reward"})


def q_best_checkpoints():
    return round_sql(f"WITH {TLOG} SELECT run_id, step, mean_reward FROM imp WHERE improved",
                     ["run_id", "step", "mean_reward"], {"mean_reward"})


def q_early_stop():
    inner = f"""WITH {TLOG},
g AS (SELECT *, sum(CASE WHEN improved THEN 1 ELSE 0 END) OVER (PARTITION BY run_id ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp FROM imp),
c AS (SELECT *, sum(CASE WHEN improved THEN 0 ELSE 1 END) OVER (PARTITION BY run_id, grp ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS no_improvement FROM g),
s AS (SELECT run_id, min(step) AS step, 'no improvement' AS reason FROM c WHERE no_improvement >= 2 AND step > 20 GROUP BY run_id
      UNION ALL
      SELECT run_id, min(step), 'nan reward' FROM tl WHERE reward IS NULL OR isnan(reward) GROUP BY run_id)
SELECT run_id, arg_min(reason, step) AS reason, min(step) AS stop_step FROM s GROUP BY run_id"""
    return round_sql(inner, ["run_id", "reason", "stop_step"], set())


def q_training_summary():
    inner = f"""WITH {TLOG},
s AS (SELECT run_id, count(*) AS n_steps, arg_min(reward, struct_pack(ts := ts, event_id := event_id)) AS first_reward,
             arg_max(reward, struct_pack(ts := ts, event_id := event_id)) AS final_reward, sum(reward) AS total_reward
      FROM tl GROUP BY run_id),
b AS (SELECT run_id, max(mean_reward) AS best_mean_reward FROM pr GROUP BY run_id)
SELECT s.*, b.best_mean_reward FROM s LEFT JOIN b ON s.run_id = b.run_id"""
    cols = ["run_id", "n_steps", "first_reward", "final_reward", "total_reward", "best_mean_reward"]
    return round_sql(inner, cols, {"first_reward", "final_reward", "total_reward", "best_mean_reward"})


def q_failure_ratio():
    inner = """WITH g AS (SELECT time_bucket(INTERVAL 30 MINUTE, ts) AS window_start, count(*) AS runs,
       CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS failed FROM events GROUP BY 1)
SELECT window_start, runs, failed, failed / runs AS failure_ratio, failed / runs > 0.2 AS alert FROM g"""
    return round_sql(inner, ["window_start", "runs", "failed", "failure_ratio", "alert"], {"failure_ratio"})


REG = """reg AS (SELECT o_orderpriority AS model, o_orderkey AS version,
   CASE o_orderstatus WHEN 'F' THEN 'Production' WHEN 'O' THEN 'Staging' ELSE 'None' END AS stage,
   CASE WHEN o_custkey % 2 = 0 THEN 'registry' ELSE 'local' END AS source,
   o_orderdate AS loaded_at, o_totalprice AS metric FROM orders)"""


def q_latest_model():
    inner = f"""WITH {REG},
g AS (SELECT model, arg_max(struct_pack(version := version, stage := stage, source := source, loaded_at := loaded_at, metric := metric),
        struct_pack(p := CASE WHEN stage = 'Production' THEN 1 ELSE 0 END, l := loaded_at, v := version)) AS r
      FROM reg GROUP BY model)
SELECT model, r.version AS version, r.stage AS stage, r.source AS source, r.loaded_at AS loaded_at, r.metric AS metric FROM g"""
    return round_sql(inner, ["model", "version", "stage", "source", "loaded_at", "metric"], {"metric"},
                     digits("latest_model"))


def q_latest_by_stage():
    inner = f"""WITH {REG} SELECT model, stage, arg_max(version, struct_pack(l := loaded_at, v := version)) AS version,
  max(loaded_at) AS loaded_at FROM reg WHERE stage IN ('Production', 'Staging') GROUP BY model, stage"""
    return round_sql(inner, ["model", "stage", "version", "loaded_at"], set())


def q_best_model():
    inner = f"""WITH {REG} SELECT model, arg_max(version, struct_pack(m := metric, v := version)) AS version,
  max(metric) AS metric FROM reg WHERE metric IS NOT NULL AND NOT isnan(metric) GROUP BY model"""
    return round_sql(inner, ["model", "version", "metric"], {"metric"}, digits("best_model"))


def q_registry_counts():
    inner = f"""WITH {REG} SELECT model, count(*) AS total,
  count(*) FILTER (WHERE source = 'registry') AS from_registry, count(*) FILTER (WHERE source = 'local') AS from_local,
  count(*) FILTER (WHERE stage = 'Production') AS production, count(*) FILTER (WHERE stage = 'Staging') AS staging
FROM reg GROUP BY model"""
    return round_sql(inner, ["model", "total", "from_registry", "from_local", "production", "staging"], set())


def q_retain_latest():
    inner = f"""WITH {REG} SELECT model, version, stage, loaded_at FROM (
  SELECT *, row_number() OVER (PARTITION BY model ORDER BY loaded_at DESC, version DESC) AS r FROM reg) WHERE r > 5"""
    return round_sql(inner, ["model", "version", "stage", "loaded_at"], set())


def q_feature_ids():
    inner = f"""WITH {BRAND},
st AS (SELECT * FROM (VALUES ('technical', '14'), ('price', '20'), ('volume', '20'), ('correlation', '60')) t(category, w)),
c AS (SELECT b.ticker, st.category, b.ticker || '_' || st.category AS name, 'v1' AS version, st.w
      FROM (SELECT DISTINCT ticker FROM bbars) b CROSS JOIN st)
SELECT ticker, category, name, version, md5(name || '_' || version || '_' || '{{"window": ' || w || '}}') AS id FROM c"""
    return round_sql(inner, ["ticker", "category", "name", "version", "id"], set())


def q_normalized_tickers():
    inner = """SELECT p_partkey, upper(trim(p_brand)) AS ticker FROM part
WHERE p_brand IS NOT NULL AND length(trim(p_brand)) > 0 AND p_partkey % 5 NOT IN (1, 2)"""
    return round_sql(inner, ["p_partkey", "ticker"], set())


def q_dataset_inventory():
    inner = " UNION ALL ".join(f"SELECT '{n}.parquet' AS file_name, count(*) AS n_rows FROM {n}"
                               for n in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                                         "events", "documents", "embeddings", "pages", "benchmark", "labels",
                                         "conversations"))
    return round_sql(inner, ["file_name", "n_rows"], set())


ORACLE = {
    "normalized_tickers": q_normalized_tickers,
    "dataset_inventory": q_dataset_inventory,
    "training_progress": q_training_progress,
    "best_checkpoints": q_best_checkpoints,
    "early_stop": q_early_stop,
    "training_summary": q_training_summary,
    "failure_ratio": q_failure_ratio,
    "latest_model": q_latest_model,
    "latest_by_stage": q_latest_by_stage,
    "best_model": q_best_model,
    "registry_counts": q_registry_counts,
    "retain_latest": q_retain_latest,
    "feature_ids": q_feature_ids,
}
