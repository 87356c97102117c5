"""A table store over Parquet with insert-only and upsert merges.

A table is a folder of versions and a pointer file that names the current one; the pointer is renamed into place when a
version is complete, so a crash between leaves the old version. A version lists its data folders in a manifest, so an append
adds files and copies none. One writer at a time is assumed. Paths go through Hadoop's file system: any store that Spark knows.

A folder may have a scope: values of some columns that all its rows share (a batch, a date). A merge with a scope looks for keys
only in folders whose scope agrees and in those without one. The caller vouches that equal keys lie in one scope, as they do
where the key is a digest of the batch.

A merge writes a key index (`plans.index`) beside its folder. Later merges open only folders that may hold one of their keys,
and an upsert rewrites no others: its cost follows the keys, not the table. A renamed column keeps its old name in old files.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import reduce
from typing import Any
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from stayspark.plans import index

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # fixed: the folder that Spark gives nulls


class Files:
    """Small files by Hadoop's file system."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.fs = spark, spark._jvm.org.apache.hadoop.fs

    def _at(self, path: str):
        p = self.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def read(self, path: str) -> str:
        fs, p = self._at(path)
        stream = fs.open(p)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """By a temporary file and a rename over the old one."""
        fs, p = self._at(path)
        temporary = self.fs.Path(f"{path}.{uuid.uuid4().hex}")
        stream = fs.create(temporary, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        jvm = self.spark._jvm
        context = self.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration())
        kind = jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename")
        options = jvm.java.lang.reflect.Array.newInstance(kind, 1)
        options[0] = next(x for x in kind.getEnumConstants() if x.toString() == "OVERWRITE")
        context.rename(fs.makeQualified(temporary), fs.makeQualified(p), options)

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)

    def list(self, path: str) -> list[str]:
        fs, p = self._at(path)
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


FEW, MANY = 10_000, 200  # an upsert also takes in folders of fewer rows than FEW once there are MANY of one scope


def _agrees(own: dict[str, str], scope: dict[str, str] | None) -> bool:
    return all(own.get(k, v) == v for k, v in (scope or {}).items())


class TableStore:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root, self.files = spark, root.rstrip("/"), Files(spark)

    def _pointer(self, name: str) -> str:
        return f"{self.root}/{name}/_current"

    def _state(self, name: str) -> dict:
        if not self.exists(name):
            raise ValueError(f"table {name} does not exist")
        return {"scopes": {}, "index": {}, "renamed": {}, **json.loads(self.files.read(self._pointer(name)))}

    def _publish(self, name: str, state: dict, **changes: Any) -> None:
        """The next version: `state` with changes; what is said of a folder goes with it."""
        new = {**state, **changes, "version": state["version"] + 1}
        for part in ("scopes", "index", "renamed"):
            new[part] = {f: v for f, v in new.get(part, {}).items() if f in new["folders"]}
        self.files.write(self._pointer(name), json.dumps(new))

    def exists(self, name: str) -> bool:
        return self.files.exists(self._pointer(name))

    def require(self, *names: str) -> None:
        if missing := [n for n in names if not self.exists(n)]:
            raise ValueError(f"missing tables: {', '.join(missing)}")

    def create(self, name: str, schema: StructType | str) -> None:
        """Create an empty table if there is none."""
        if not self.exists(name):
            self._publish(name, {"version": -1, "schema": self._typed(schema).jsonValue(), "folders": []})

    def _typed(self, schema: StructType | str) -> StructType:
        return StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def schema(self, name: str) -> StructType:
        return StructType.fromJson(self._state(name)["schema"])

    def scopes(self, name: str) -> dict[str, dict[str, str]]:
        """Each folder's scope, {} where it has none."""
        state = self._state(name)
        return {f: state["scopes"].get(f, {}) for f in state["folders"]}

    def read(self, name: str, scope: dict[str, str] | None = None) -> DataFrame:
        """The table, or with a scope the folders that may hold its rows."""
        state = self._state(name)
        return self.of(name, [f for f in state["folders"] if _agrees(state["scopes"].get(f, {}), scope)])

    def of(self, name: str, folders: list[str]) -> DataFrame:
        """The rows of some folders."""
        state = self._state(name)
        schema = StructType.fromJson(state["schema"])
        if not folders:
            return self.spark.createDataFrame([], schema)
        alike: dict[tuple, list[str]] = {}  # by the names that columns have in the files
        for f in folders:
            alike.setdefault(tuple(sorted(state["renamed"].get(f, {}).items())), []).append(f"{self.root}/{name}/{f}")
        return reduce(DataFrame.unionByName, [self._as_named(schema, dict(old), paths) for old, paths in alike.items()])

    @staticmethod
    def _in_file(column: str, old: dict[str, str | None]) -> str | None:
        """A column's name in a folder's files; None if what has its name there is another column."""
        return old[column] if column in old else None if column in old.values() else column

    def _as_named(self, schema: StructType, old: dict[str, str | None], paths: list[str]) -> DataFrame:
        names = {f: self._in_file(f.name, old) for f in schema}
        df = self.spark.read.schema(StructType([StructField(n, f.dataType) for f, n in names.items() if n])).parquet(*paths)
        return df.select(*[(F.col(n) if n else F.lit(None).cast(f.dataType)).alias(f.name) for f, n in names.items()])

    def _write(self, name: str, df: DataFrame) -> tuple[str, int]:
        """A new data folder and its number of rows, counted as they are written."""
        folder, seen = f"data-{uuid.uuid4().hex}", Observation()
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(f"{self.root}/{name}/{folder}")
        return folder, int(seen.get["rows"])

    def _write_by(self, name: str, df: DataFrame, column: str) -> dict[str, dict[str, str]]:
        """A data folder for each value of a column, written in one job, and their scopes. A value with many rows goes over
        several tasks, small ones share one."""
        whole, part = f"data-{uuid.uuid4().hex}", "part"
        while part in df.columns:
            part += "_"
        df.withColumn(part, F.col(column).cast("string")).hint("rebalance", column).write.partitionBy(part).parquet(f"{self.root}/{name}/{whole}")
        values = {f: f.partition("=")[2] for f in self.files.list(f"{self.root}/{name}/{whole}") if f.startswith(f"{part}=")}
        return {f"{whole}/{f}": {} if v == NO_VALUE else {column: unquote(v)} for f, v in values.items()}

    def _fitted(self, name: str, df: DataFrame) -> DataFrame:
        have = set(df.columns)
        return df.select(*[(F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in self.schema(name)])

    def touched(self, name: str, df: DataFrame, keys: list[str], scope: dict[str, str] | None = None) -> list[str]:
        """The folders that may hold one of df's keys: by scope, by the range of each key column, by Bloom filters."""
        state = self._state(name)
        inside = {f: state["index"].get(f) for f in state["folders"] if _agrees(state["scopes"].get(f, {}), scope)}
        return index.may_hold(self.spark, f"{self.root}/{name}", inside, df, keys)

    def _one_each(self, df: DataFrame, keys: list[str]) -> DataFrame:
        """One row of each key. Hashes of the keys are counted before: rows are shuffled whole only where one comes twice."""
        if index.hashes(df, keys).groupBy("_hash").count().where("count > 1").limit(1).count():
            return df.dropDuplicates(keys)
        return df

    def insert_only(self, name: str, df: DataFrame, keys: list[str], scope: dict[str, str] | None = None, by: str | None = None) -> int:
        """Append the rows whose key is not there; of equal keys in df one. Of existing files only the key columns of folders
        that may hold a key are read, and nothing is copied. With `by` the rows go into a folder for each value of that column."""
        state, source = self._state(name), self._fitted(name, df)
        touched, new = self.touched(name, source, keys, scope), self._one_each(source, keys)
        if touched:
            new = new.join(self.of(name, touched).select(*keys), keys, "left_anti").select(*self.schema(name).names)
        if by:
            scopes = {f: {**own, **(scope or {})} for f, own in self._write_by(name, new, by).items()}
            rows = self._count(name, list(scopes))
        else:
            folder, rows = self._write(name, new)
            scopes = {folder: scope or {}}
        if rows:
            self._add(name, state, state["folders"], scopes, keys, rows)
        else:
            for whole in {f.split("/")[0] for f in scopes}:
                self.files.delete(f"{self.root}/{name}/{whole}")
        return rows

    def _count(self, name: str, folders: list[str]) -> int:
        return self.of(name, folders).count()

    def _add(self, name: str, state: dict, left: list[str], scopes: dict[str, dict[str, str]], keys: list[str], rows: int) -> None:
        """Publish new folders beside those that are left; they share one index."""
        entry = index.write(self.of(name, list(scopes)), keys, rows, f"{self.root}/{name}")
        self._publish(name, state, folders=[*left, *scopes], scopes={**state["scopes"], **{f: s for f, s in scopes.items() if s}}, index={**state["index"], **dict.fromkeys(scopes, entry)})

    def upsert(self, name: str, df: DataFrame, keys: list[str], keep: Callable[[DataFrame, DataFrame], DataFrame] | None = None, scope: dict[str, str] | None = None) -> int:
        """Replace the rows whose key df has and add the others. A key that df has twice is ambiguous: ValueError.
        `keep` may carry values of old rows over: it gets (df, old rows that may have its keys). Only folders that may hold a key
        are rewritten, into one; its scope is what theirs and `scope` have in common. Returns the rows written."""
        source, state = self._fitted(name, df), self._state(name)
        if source.groupBy(*keys).count().where("count > 1").limit(1).count():
            raise ValueError(f"several source rows for one key of {name}")
        gone = self.touched(name, source, keys, scope)
        common = scope or {}
        for f in gone:
            own = state["scopes"].get(f, {})
            common = {k: v for k, v in common.items() if own.get(k) == v}
        small = [f for f in state["folders"] if f not in gone and state["scopes"].get(f, {}) == common and state["index"].get(f, {}).get("rows", FEW) < FEW]
        gone += small if len(small) >= MANY else []
        old = self.of(name, gone)
        if keep:
            source = self._fitted(name, keep(source, old))
        folder, rows = self._write(name, old.join(source.select(*keys), keys, "left_anti").select(*old.columns).unionByName(source))
        self._add(name, state, [f for f in state["folders"] if f not in gone], {folder: common}, keys, rows)
        return rows

    def replace_parts(self, name: str, df: DataFrame, column: str, values: set[str | None] | None = None, seen: list[str] | None = None) -> None:
        """Replace the rows whose `column` has one of the values (all rows without values) by df, which has no others. The table
        holds a folder for each value, so others stay as they are. `seen` is kept with the version: what it was made from."""
        if self.exists(name):
            state = self._state(name)
        else:
            state = {"version": -1, "schema": df.schema.jsonValue(), "folders": [], "scopes": {}}
        left = [f for f in state["folders"] if values is not None and state["scopes"].get(f, {}).get(column) not in values]
        if any(f not in state["scopes"] for f in left):
            raise ValueError(f"{name} has folders of several values of {column}: replace all")
        scopes = self._write_by(name, df, column)
        self._publish(name, state, folders=[*left, *scopes], scopes={**state["scopes"], **scopes}, seen=seen)

    def seen(self, name: str) -> list[str] | None:
        return self._state(name).get("seen")

    def overwrite(self, name: str, df: DataFrame) -> int:
        """Replace the table and its schema."""
        version = self._state(name)["version"] if self.exists(name) else 0
        folder, rows = self._write(name, df)
        self._publish(name, {"version": version, "schema": df.schema.jsonValue(), "folders": [folder]})
        return rows

    def add_columns(self, name: str, fields: list[StructField]) -> list[str]:
        """Add columns that are missing; files stay as they are and read as null."""
        state, schema = self._state(name), self.schema(name)
        new = [f for f in fields if f.name not in schema.names]
        if new:
            self._publish(name, state, schema=StructType([*schema.fields, *new]).jsonValue())
        return [f.name for f in new]

    def rename_column(self, name: str, old: str, new: str) -> bool:
        """Rename a column; nothing to do if it is gone already. Files stay as they are, with scopes and key indices."""
        state, schema = self._state(name), self.schema(name)
        if old not in schema.names or new in schema.names:
            return False
        changed = lambda c: new if c == old else c
        self._publish(
            name, state,
            schema=StructType([StructField(changed(f.name), f.dataType, f.nullable, f.metadata) for f in schema]).jsonValue(),
            renamed={f: {**{k: v for k, v in names.items() if k != old}, new: self._in_file(old, names)} for f in state["folders"] for names in [state["renamed"].get(f, {})]},
            scopes={f: {changed(k): v for k, v in s.items()} for f, s in state["scopes"].items()},
            index={f: index.renamed(i, changed) for f, i in state["index"].items()},
        )
        return True

    def vacuum(self, name: str) -> int:
        """Delete data folders and indices that the current version doesn't name."""
        state = self._state(name)
        live = {f.split("/")[0] for f in state["folders"]} | {i["path"] for i in state["index"].values()}
        dead = [f for f in self.files.list(f"{self.root}/{name}") if f.startswith(("data-", "index-")) and f not in live]
        for f in dead:
            self.files.delete(f"{self.root}/{name}/{f}")
        return len(dead)
