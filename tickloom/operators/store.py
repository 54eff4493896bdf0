"""H1–H13 — feature store, model registry and portfolio state as tables.

The reference keeps these in SQLite behind a service; here each is a
catalog DataFrame and each look-up is an aggregate (``max_by`` with a
deterministic tiebreak) or a filter — partial aggregation keeps a hot model
name from landing in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STAGES = ("Production", "Staging")


def py_json_object(m: Column) -> Column:
    """A map<string,string> of JSON literals rendered like Python's
    ``json.dumps(d, sort_keys=True)``: keys sorted, ', ' and ': ' separators."""
    items = F.transform(F.array_sort(F.map_entries(m)),
                        lambda e: F.concat(F.lit('"'), e["key"], F.lit('": '), e["value"]))
    return F.concat(F.lit("{"), F.array_join(items, ", "), F.lit("}"))


def feature_id(name: Column, version: Column, params: Column | None = None) -> Column:
    """H1: md5 of ``name_version`` plus ``_<sorted JSON params>`` when given."""
    base = F.concat_ws("_", name, version)
    if params is None:
        return F.md5(base)
    has = params.isNotNull() & (F.size(params) > 0)
    return F.md5(F.when(has, F.concat_ws("_", base, py_json_object(params))).otherwise(base))


def latest_versions(catalog: DataFrame, keys=("name", "entity_type"),
                    order=("updated_at", "id")) -> DataFrame:
    """H2/H3: the newest row per key ("latest" whatever the version); replaces
    are appended rows, so the newest wins."""
    o = F.struct(*[F.col(c) for c in order])
    cols = [c for c in catalog.columns if c not in keys]
    return catalog.groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(c) for c in cols]), o).alias("_r")).select(*keys, "_r.*")


def latest_model(reg: DataFrame, prefer_production: bool = True, key: str = "model") -> DataFrame:
    """H8: per model, the newest Production version, else the newest of all."""
    prod = (F.col("stage") == "Production").cast("int") if prefer_production else F.lit(0)
    o = F.struct(prod.alias("p"), F.col("loaded_at"), F.col("version"))
    r = F.struct("version", "stage", "source", "loaded_at", "metric")
    return reg.groupBy(key).agg(F.max_by(r, o).alias("_r")).select(key, "_r.*")


def latest_by_stage(reg: DataFrame, key: str = "model") -> DataFrame:
    """H9: newest version per (model, stage) for Production and Staging."""
    o = F.struct(F.col("loaded_at"), F.col("version"))
    return reg.filter(F.col("stage").isin(*STAGES)).groupBy(key, "stage").agg(
        F.max_by("version", o).alias("version"), F.max("loaded_at").alias("loaded_at"))


def best_model(reg: DataFrame, metric: str = "metric", ascending: bool = False,
               key: str = "model") -> DataFrame:
    """The run with the best metric per model; runs lacking it skipped."""
    m = F.col(metric)
    have = reg.filter(m.isNotNull() & ~F.isnan(m))
    o = F.struct(m, F.col("version")) if not ascending else F.struct(-m, -F.col("version"))
    return have.groupBy(key).agg(F.max_by("version", o).alias("version"),
                                 (F.min(m) if ascending else F.max(m)).alias(metric))


def registry_counts(reg: DataFrame, key: str = "model") -> DataFrame:
    """Totals per model, by source and by stage."""
    return reg.groupBy(key).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("source") == "registry").alias("from_registry"),
        F.count_if(F.col("source") == "local").alias("from_local"),
        F.count_if(F.col("stage") == "Production").alias("production"),
        F.count_if(F.col("stage") == "Staging").alias("staging"))


def retain_latest(reg: DataFrame, k: int = 5, key: str = "model", salts: int = 64) -> DataFrame:
    """Rows beyond the ``k`` newest per key (the deletion plan).

    Two-phase top-k so a hot key never sorts in one task: each (key, salt)
    keeps its own k newest, the k-th newest over those candidates is the cut,
    and every row older than the cut is listed.  Exact: the global top-k is
    contained in the union of the per-salt top-k."""
    o = [F.col("loaded_at").desc(), F.col("version").desc()]
    salted = reg.withColumn("_s", F.pmod(F.xxhash64("version"), F.lit(salts)))
    cand = salted.withColumn("_r", F.row_number().over(Window.partitionBy(key, "_s").orderBy(*o))) \
        .filter(F.col("_r") <= k)
    cut = cand.withColumn("_g", F.row_number().over(Window.partitionBy(key).orderBy(*o))) \
        .filter(F.col("_g") == k).select(key, F.col("loaded_at").alias("_cl"),
                                         F.col("version").alias("_cv"))
    older = (F.col("loaded_at") < F.col("_cl")) | (
        (F.col("loaded_at") == F.col("_cl")) & (F.col("version") < F.col("_cv")))
    return reg.join(cut, key).filter(older).select(key, "version", "stage", "loaded_at")


def model_info(reg: DataFrame, name: str, key: str = "model") -> DataFrame:
    """One model's newest entry with its metrics and parameters maps."""
    one = latest_model(reg.filter(F.col(key) == name), prefer_production=False, key=key)
    return one.select(key, "version", "stage", "source", "loaded_at",
                      F.create_map(F.lit("metric"), F.col("metric")).alias("metrics"),
                      F.create_map(F.lit("source"), F.col("source")).alias("params"))


def upsert_portfolio_weights(current: DataFrame, updates: DataFrame, tol: float = 0.01,
                             key: str = "portfolio_id") -> DataFrame:
    """H7: validate updates (|Σw − 1| ≤ tol, C4) and keep one snapshot per
    portfolio, the newest by ``updated_at``; of a stored and an incoming one of
    the same time the incoming counts, so running an update again changes nothing.
    Rows are (portfolio_id, ticker, weight, updated_at)."""
    sums = updates.groupBy(key, "updated_at").agg(F.sum("weight").alias("_s"))
    ok = sums.filter(F.abs(F.col("_s") - 1) <= tol).select(key, "updated_at")
    valid = updates.join(ok, [key, "updated_at"], "left_semi")
    both = current.withColumn("_new", F.lit(0)).unionByName(valid.withColumn("_new", F.lit(1)))
    newest = both.groupBy(key).agg(F.max(F.struct("updated_at", "_new")).alias("_n")).select(key, "_n.*")
    return both.join(newest, [key, "updated_at", "_new"], "left_semi").select(*current.columns)


def get_or_compute(requested: DataFrame, catalog: DataFrame, key: str = "ticker") -> DataFrame:
    """H6: the requested keys that have no stored feature yet (compute those)."""
    return requested.select(key).distinct().join(catalog.select(key), key, "left_anti")


FEATURE_REF = "array<struct<id:string,name:string,ticker:string,category:string>>"


def feature_set_members(sets: DataFrame, catalog: DataFrame) -> DataFrame:
    """A feature set's member list (JSON array) exploded and joined
    to the catalog by id."""
    refs = sets.select("set_name", F.explode(F.from_json("features", FEATURE_REF)).alias("f"))
    refs = refs.select("set_name", F.col("f.id").alias("id"), F.col("f.ticker").alias("ticker"),
                       F.col("f.category").alias("category"))
    return refs.join(catalog.select("id", "name", "version"), "id", "left")


def list_features(catalog: DataFrame, entity_type: str | None = None,
                  name: str | None = None) -> DataFrame:
    """H5: optional predicates, newest first (a sort is the requested output)."""
    df = catalog
    if entity_type is not None:
        df = df.filter(F.col("entity_type") == entity_type)
    if name is not None:
        df = df.filter(F.col("name") == name)
    return df.orderBy(F.col("updated_at").desc(), F.col("id"))


def run_report(training: DataFrame, evaluation: DataFrame, gate: DataFrame,
               key: str = "portfolio_id") -> DataFrame:
    """Training, evaluation and deployment facts joined into one row per
    run, plus the row as JSON."""
    j = training.join(evaluation, key, "left").join(gate, key, "left")
    return j.withColumn("report", F.to_json(F.struct(*[F.col(c) for c in j.columns])))


def save_feature(df: DataFrame, path: str, catalog_path: str, name: str, version: str,
                 entity_type: str, params: dict | None = None, description: str = "") -> str:
    """H2: write a feature's data (Parquet, keys kept as columns) and append
    its catalog row (H1 id, stats of the numeric columns as JSON).  A
    re-save of (name, version) appends a newer row; readers take the newest
    by ``updated_at`` (H3), which is the upsert."""
    import json
    spark = df.sparkSession
    fid_params = {k: json.dumps(v) for k, v in (params or {}).items()}
    df.write.mode("overwrite").parquet(path)
    from tickloom.operators.describe import array_stats
    stats = array_stats(spark.read.parquet(path)).select(F.to_json(F.struct("*")).alias("stats"))
    pm = F.create_map(*[x for k, v in sorted(fid_params.items()) for x in (F.lit(k), F.lit(v))]) \
        if fid_params else None
    row = stats.select(
        feature_id(F.lit(name), F.lit(version), pm).alias("id"), F.lit(name).alias("name"),
        F.lit(version).alias("version"), F.lit(entity_type).alias("entity_type"),
        F.lit(description).alias("description"), F.current_timestamp().alias("created_at"),
        F.current_timestamp().alias("updated_at"),
        F.lit(json.dumps(params or {}, sort_keys=True)).alias("parameters"), "stats",
        F.lit(path).alias("file_path"))
    row.write.mode("append").parquet(catalog_path)
    return row.first()["id"]


def load_feature(spark, catalog_path: str, name: str, version: str = "latest",
                 entity_type: str | None = None) -> DataFrame:
    """H3: the data of ``name`` — the newest row for (name, entity_type)
    whatever its version when ``version='latest'``, else that exact version."""
    cat = spark.read.parquet(catalog_path).filter(F.col("name") == name)
    if entity_type is not None:
        cat = cat.filter(F.col("entity_type") == entity_type)
    if version != "latest":
        cat = cat.filter(F.col("version") == version)
    row = latest_versions(cat, keys=("name",)).first()
    if row is None:
        raise KeyError(f"feature {name!r} ({version}) not found")
    return spark.read.parquet(row["file_path"])


def runs_with_versions(runs: DataFrame, versions: DataFrame, key: str = "run_id") -> DataFrame:
    """Experiment runs joined to the registered model versions they produced."""
    return runs.join(versions, key, "inner")
