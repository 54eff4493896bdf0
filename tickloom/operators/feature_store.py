"""H2–H6 — a feature store with data, versions and atomic upserts.

A feature is a table with key columns.  Its rows lie in a fixed number of buckets by
a hash of the keys; a commit names, for every bucket, the folder that holds it.  An
upsert rewrites only buckets whose rows really change, into a fresh folder, and
publishes a commit that names the new folders beside the untouched ones
(copy on write).  Readers follow the newest commit, so they see all of an
upsert or nothing; running one again finds no change and writes nothing.  Two
writers cannot take one commit number: the second starts over from the first's.

Statistics are kept per bucket as moments and merged, so an upsert reads back only
what it wrote.  What passes through the driver is one commit: buckets, columns
and their moments, whatever the number of rows.
"""

from __future__ import annotations

import hashlib
import json
import math
import time
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.session import materialize
from tickloom.sources.commits import CommitLog

BUCKET = "_bucket"
ATTEMPTS = 5
CATALOG = ("id string, name string, version string, entity_type string, description string, created_at double, "
           "updated_at double, parameters string, stats string, commit long")


def object_id(name: str, version: str, parameters: dict | None = None) -> str:
    """H1 for one feature or set: md5 of name_version[_sorted JSON parameters]."""
    text = f"{name}_{version}" + (f"_{json.dumps(parameters, sort_keys=True)}" if parameters else "")
    return hashlib.md5(text.encode()).hexdigest()


def _merged(parts: list[dict]) -> dict:
    """Count, mean, std, min and max of several buckets' moments."""
    parts = [p for p in parts if p["n"]]
    n = sum(p["n"] for p in parts)
    if not n:
        return {"count": 0, "mean": None, "std": None, "min": None, "max": None}
    mean = sum(p["n"] * p["mean"] for p in parts) / n
    m2 = sum(p["n"] * (p["var"] + (p["mean"] - mean) ** 2) for p in parts)
    return {"count": n, "mean": mean, "std": math.sqrt(m2 / (n - 1)) if n > 1 else None,
            "min": min(p["min"] for p in parts), "max": max(p["max"] for p in parts)}


class FeatureStore:
    """Features and feature sets under ``root``, a folder all workers share."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 16):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets

    # ------------------------------------------------------------ writing
    def _log(self, kind: str, ident: str) -> CommitLog:
        return CommitLog(self.spark, f"{self.root}/{kind}/{ident}/commits")

    def _write(self, ident: str, rows: DataFrame, columns: list[str]) -> dict:
        """Write bucketed rows to a fresh folder: {bucket: {folder, rows, moments}}.
        A bucket that holds most rows is split over tasks (rebalance)."""
        folder = f"{self.root}/features/{ident}/data/{uuid.uuid4().hex}"
        rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(folder)
        numeric = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.NumericType) and f.name in columns]
        back = self.spark.read.schema(rows.schema).parquet(folder)
        x = {c: F.col(c).cast("double") for c in numeric}
        moments = [F.struct(F.count(v).alias("n"), F.avg(v).alias("mean"), F.var_pop(v).alias("var"),
                            F.min(v).alias("min"), F.max(v).alias("max")).alias(c) for c, v in x.items()]
        found = back.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("_rows"), *moments).collect()
        return {str(r[BUCKET]): {"folder": f"{folder}/{BUCKET}={r[BUCKET]}", "rows": r["_rows"],
                                 "moments": {c: r[c].asDict() for c in numeric}} for r in found}

    def _body(self, before: dict | None, buckets: dict, schema: T.StructType, keys, **about) -> dict:
        now = time.time()
        numeric = sorted({c for b in buckets.values() for c in b["moments"]})
        rows = sum(b["rows"] for b in buckets.values())
        stats = {"shape": [rows, len(schema)], "columns": schema.fieldNames(),
                 "description": {c: _merged([b["moments"][c] for b in buckets.values()]) for c in numeric}}
        return {**about, "created_at": before["created_at"] if before else now, "updated_at": now,
                "parameters": json.dumps(about["parameters"]) if about["parameters"] else None,
                "stats": json.dumps(stats), "keys": list(keys), "schema": schema.json(), "buckets": buckets,
                "n_buckets": before["n_buckets"] if before else self.buckets}

    def upsert(self, data: DataFrame, name: str, keys, entity_type: str, version: str = "latest",
               parameters: dict | None = None, description: str = "", replace: bool = False) -> tuple[str, int]:
        """Merge ``data`` into the feature: rows with a stored key replace it,
        others are added (``replace``: all stored rows go).  Of several new rows
        with one key the largest counts.  Returns the feature's id and its newest
        commit; without a change that is the one before."""
        keys, ident = list(keys), object_id(name, version, parameters)
        log = self._log("features", ident)
        values = [c for c in data.columns if c not in keys]
        one = data.groupBy(*keys).agg(F.max(F.struct(*values)).alias("_v")).select(*keys, "_v.*") if values \
            else data.distinct()
        one = materialize(one.select(*data.columns), "feature_rows")
        for _ in range(ATTEMPTS):
            newest = log.latest()
            number, before = newest if newest else (0, None)
            n = before["n_buckets"] if before else self.buckets
            rows = one.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int"))
            if before and not replace:
                if before["schema"] != data.schema.json():
                    raise ValueError(f"{name}: the stored columns differ; save it under another version")
                same = [rows[c].eqNullSafe(F.col(f"_old_{i}")) for i, c in enumerate(data.columns)]
                stored = self._rows(before)
                old = stored.select(*[F.col(c).alias(f"_old_{i}") for i, c in enumerate(data.columns)])
                changed = materialize(rows.join(old, reduce(lambda a, b: a & b, same), "left_anti"), "feature_changes")
                touched = [r[0] for r in changed.select(BUCKET).distinct().collect()]  # as many as buckets at most
                if not touched:
                    return ident, number
                match = [F.col(c).eqNullSafe(F.col(f"_new_{i}")) for i, c in enumerate(keys)]
                fresh = changed.select(*[F.col(c).alias(f"_new_{i}") for i, c in enumerate(keys)])
                kept = self._rows(before, touched).join(fresh, reduce(lambda a, b: a & b, match), "left_anti")
                kept = kept.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int"))
                buckets = {**before["buckets"], **self._write(ident, changed.unionByName(kept), data.columns)}
            else:
                buckets = self._write(ident, rows, data.columns)
            body = self._body(before, buckets, data.schema, keys, id=ident, name=name, version=version,
                              entity_type=entity_type, description=description, parameters=parameters)
            if log.publish(number + 1, {**body, "commit": number + 1}):
                return ident, number + 1
        raise RuntimeError(f"{name}: other writers committed first, {ATTEMPTS} times")

    def save(self, data: DataFrame, name: str, keys, entity_type: str, **about) -> str:
        """H2: the feature's rows become ``data``."""
        return self.upsert(data, name, keys, entity_type, replace=True, **about)[0]

    # ------------------------------------------------------------ reading
    def _rows(self, body: dict, buckets=None) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(body["schema"]))
        wanted = body["buckets"] if buckets is None else {b: v for b, v in body["buckets"].items() if int(b) in set(buckets)}
        if not wanted:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[b["folder"] for b in wanted.values()])

    def _catalog(self, kind: str, schema: str = CATALOG) -> DataFrame:
        """The newest commit of every object, parsed on executors."""
        import os.path
        log = CommitLog(self.spark, f"{self.root}/{kind}")
        files = log._files()
        if not files.exists(self.spark._jvm.org.apache.hadoop.fs.Path(os.path.dirname(log.folder) + f"/{kind}")):
            return self.spark.createDataFrame([], schema)
        all_commits = self.spark.read.schema(schema).json(f"{self.root}/{kind}/*/commits/*.json")
        cols = [c for c in all_commits.columns if c != "id"]
        return all_commits.groupBy("id").agg(F.max_by(F.struct(*cols), "commit").alias("_r")).select("id", "_r.*")

    def list_features(self, entity_type: str | None = None, name: str | None = None) -> DataFrame:
        """H5: all features, or those of a type or name, newest first; parameters
        as a map of their JSON values, statistics parsed."""
        rows = self._catalog("features")
        for column, value in (("entity_type", entity_type), ("name", name)):
            if value is not None:
                rows = rows.filter(F.col(column) == value)
        one = "struct<count:long,mean:double,std:double,min:double,max:double>"
        stats = F.from_json("stats", f"shape array<long>, columns array<string>, description map<string,{one}>")
        return rows.withColumn("parameters", F.from_json("parameters", "map<string,string>")) \
            .withColumn("stats", stats).orderBy(F.col("updated_at").desc(), "id")

    def metadata(self, name: str | None = None, feature_id: str | None = None, version: str = "latest",
                 entity_type: str | None = None) -> dict | None:
        """The newest commit of a feature by id, or of its name: the version
        asked for, or for "latest" whatever version was written last."""
        if feature_id is None:
            if name is None:
                raise ValueError("a name or an id is needed")
            rows = self._catalog("features").filter(F.col("name") == name)
            if entity_type is not None:
                rows = rows.filter(F.col("entity_type") == entity_type)
            if version != "latest":
                rows = rows.filter(F.col("version") == version)
            found = rows.orderBy(F.col("updated_at").desc(), "id").limit(1).collect()
            if not found:
                return None
            feature_id = found[0]["id"]
        newest = self._log("features", feature_id).latest()
        return newest[1] if newest else None

    def load(self, name: str | None = None, **which) -> DataFrame:
        """H3: a feature's rows."""
        body = self.metadata(name, **which)
        if body is None:
            raise KeyError(f"feature {name or which} not found")
        return self._rows(body)

    def get_or_compute(self, requested: DataFrame, compute: Callable[[DataFrame], DataFrame], name: str, keys,
                       entity_type: str, on: str | None = None, **about) -> DataFrame:
        """H6: the feature's rows of the requested keys (column ``on``, the first
        key by default); ``compute`` gets those keys only that have no stored row,
        and what it returns is stored.  A key it returns nothing for stays missing."""
        on = on or list(keys)[0]
        wanted = requested.select(on).filter(F.col(on).isNotNull()).distinct()
        ident = object_id(name, about.get("version", "latest"), about.get("parameters"))
        body = self.metadata(feature_id=ident)
        missing = wanted
        if body is not None:
            missing = wanted.join(self._rows(body).select(on).distinct(), on, "left_anti")
        missing = materialize(missing, "feature_missing")
        if not missing.isEmpty():
            self.upsert(compute(missing), name, keys, entity_type, **about)
            body = self.metadata(feature_id=ident)
        if body is None:
            return compute(missing)
        return self._rows(body).join(wanted, on, "left_semi")

    # ------------------------------------------------------------ sets
    def save_set(self, name: str, feature_ids: list[str], version: str = "latest", description: str = "") -> str:
        """H4: a named list of stored features."""
        ident = object_id(name, version)
        bodies = [self.metadata(feature_id=f) for f in feature_ids]
        if None in bodies:
            raise KeyError(f"feature {feature_ids[bodies.index(None)]} is not stored")
        members = [{"id": b["id"], "name": b["name"], "version": b["version"]} for b in bodies]
        log = self._log("sets", ident)
        for _ in range(ATTEMPTS):
            newest = log.latest()
            number, before = newest if newest else (0, None)
            now = time.time()
            if log.publish(number + 1, {
                    "id": ident, "name": name, "version": version, "description": description, "commit": number + 1,
                    "created_at": before["created_at"] if before else now, "updated_at": now, "features": members}):
                return ident
        raise RuntimeError(f"{name}: other writers committed first, {ATTEMPTS} times")

    SETS = ("id string, name string, version string, description string, created_at double, updated_at double, "
            "features array<struct<id:string,name:string,version:string>>, commit long")

    def list_sets(self, name: str | None = None) -> DataFrame:
        """H5: all feature sets, newest first, members parsed."""
        rows = self._catalog("sets", self.SETS)
        if name is not None:
            rows = rows.filter(F.col("name") == name)
        return rows.orderBy(F.col("updated_at").desc(), "id")

    def load_set(self, name: str | None = None, set_id: str | None = None, version: str = "latest") -> DataFrame:
        """H4: the members' rows side by side, joined on the keys they share (an
        outer join); a column that several members have appears as name_column, or
        name_version_column where members share a name."""
        if set_id is None:
            rows = self.list_sets(name)
            if version != "latest":
                rows = rows.filter(F.col("version") == version)
            found = rows.limit(1).collect()
            if not found:
                raise KeyError(f"feature set {name!r} ({version}) not found")
            set_id = found[0]["id"]
        newest = self._log("sets", set_id).latest()
        if newest is None:
            raise KeyError(f"feature set {set_id} not found")
        bodies = [self.metadata(feature_id=m["id"]) for m in newest[1]["features"]]
        keys = bodies[0]["keys"]
        if any(b["keys"] != keys for b in bodies):
            raise ValueError("the members' keys differ")
        tables = [self._rows(b) for b in bodies]
        seen: list[str] = [c for t in tables for c in t.columns if c not in keys]
        names = [b["name"] for b in bodies]
        label = [b["name"] if names.count(b["name"]) == 1 else f"{b['name']}_{b['version']}" for b in bodies]
        named = [t.select(*keys, *[F.col(c).alias(c if seen.count(c) == 1 else f"{at}_{c}")
                                   for c in t.columns if c not in keys]) for t, at in zip(tables, label)]
        return reduce(lambda a, b: a.join(b, keys, "full_outer"), named)
