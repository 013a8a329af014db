"""Versioned relations: runs are written aside and published by one manifest, and every version stays readable.

folder/data/<relation>/<run>/[key=value/]part-*.parquet    written first, seen by no reader
folder/manifest/<number>.json                              names, for every relation, the run folders that make up this version

A manifest appears by one rename that fails where the number is taken. So readers see all relations of one version or of the one before, a run
that dies leaves what it wrote unseen, and of two that commit at once the second goes on top of the first.
"""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class Conflict(RuntimeError):
    """Another run has published this number."""


class Versions:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self, at: str) -> list[str]:
        path = self._path(f"{self.folder}/{at}")
        return [s.getPath().getName() for s in self._fs.listStatus(path)] if self._fs.exists(path) else []

    def _text(self, at: str) -> str:
        return "\n".join(r.value for r in self.spark.read.text(f"{self.folder}/{at}").collect())  # one short file

    def numbers(self) -> list[int]:
        """The published versions, oldest first."""
        return sorted(int(n[:-5]) for n in self._names("manifest") if n.endswith(".json") and n[:-5].isdigit())

    def latest(self) -> int | None:
        return max(self.numbers(), default=None)

    def manifest(self, number: int | None = None) -> dict[str, Any]:
        """relations: of each its schema, key and parts (key value or '': run). Of no version: none."""
        number = self.latest() if number is None else number
        return json.loads(self._text(f"manifest/{number:012d}.json")) if number is not None else {"number": -1, "run": None, "relations": {}}

    def _publish(self, manifest: dict[str, Any]) -> None:
        jvm = self.spark._jvm
        aside, final = (self._path(f"{self.folder}/manifest/{n}") for n in (f".{uuid.uuid4().hex}", f"{manifest['number']:012d}.json"))
        self._fs.mkdirs(aside.getParent())
        out = self._fs.create(aside, True)
        try:
            out.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
        finally:
            out.close()
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self.spark._jsc.hadoopConfiguration())
        none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            files.rename(aside, final, none)
        except Exception as e:
            self._fs.delete(aside, False)
            if self._fs.exists(final):
                raise Conflict(f"version {manifest['number']} is taken") from e
            raise

    def write(self, name: str, df: DataFrame, run: str, key: str | None = None) -> dict[str, Any]:
        """Writes a relation aside; what the manifest needs of it. With a key its rows lie by value, and each value is a part of its own."""
        at = f"data/{name}/{run}"
        w = df.write.mode("overwrite")
        (w.partitionBy(key) if key else w).parquet(f"{self.folder}/{at}")
        parts = {n.split("=", 1)[1]: run for n in self._names(at) if "=" in n} if key else {"": run}
        return {"schema": df.schema.jsonValue(), "key": key, "parts": parts}

    def commit(self, relations: dict[str, DataFrame], keys: dict[str, str] | None = None, drop: dict[str, list[str]] | None = None, tries: int = 10) -> int:
        """Publishes relations as one new version on top of the latest; its number.

        Relations that are not given stay. With a key (keys: relation to column), only the key values that have rows are replaced, the others stay as
        their last run left them; `drop` names values that go. Without one the relation is replaced whole.
        """
        run = uuid.uuid4().hex
        written = {name: self.write(name, df, run, (keys or {}).get(name)) for name, df in relations.items()}
        for _ in range(tries):
            before = self.manifest()
            after = dict(before["relations"])
            for name, new in written.items():
                old = after.get(name)
                kept = old["parts"] if old and new["key"] and old["key"] == new["key"] else {}
                gone = set((drop or {}).get(name, []))
                after[name] = {**new, "parts": {**{k: v for k, v in kept.items() if k not in gone}, **new["parts"]}}
            try:
                self._publish({"number": before["number"] + 1, "run": run, "relations": after})
                return before["number"] + 1
            except Conflict:
                continue
        raise Conflict(f"{tries} versions went ahead")

    def read(self, name: str, number: int | None = None, values: list[str] | None = None) -> DataFrame:
        """A relation of a version (the latest, unless told), whole or of some key values. Folders of other values are not listed."""
        told = self.manifest(number)["relations"][name]
        schema, key = StructType.fromJson(told["schema"]), told["key"]
        by_run: dict[str, list[str]] = {}
        for value, run in told["parts"].items():
            if values is None or value in values:
                by_run.setdefault(run, []).append(value)
        out = self.spark.createDataFrame([], schema)
        for run, parts in sorted(by_run.items()):
            at = f"{self.folder}/data/{name}/{run}"
            reader = self.spark.read.schema(schema)
            df = reader.option("basePath", at).parquet(*[f"{at}/{key}={p}" for p in sorted(parts)]) if key else reader.parquet(at)
            out = out.unionByName(df.select(*schema.names))
        return out

    def origin(self, name: str, number: int | None = None) -> DataFrame:
        """(value, run): which run each key value of a relation comes from; stale values are those of an older one."""
        parts = self.manifest(number)["relations"][name]["parts"]
        return self.spark.createDataFrame(sorted(parts.items()), "value string, run string")

    def vacuum(self, keep: int = 10) -> int:
        """Removes manifests older than the last `keep`, and run folders that no manifest names; how many folders went.

        Not beside a running commit: what that has written is not named yet.
        """
        old, new = self.numbers()[:-keep], self.numbers()[-keep:]
        used = {(name, run) for n in new for name, told in self.manifest(n)["relations"].items() for run in told["parts"].values()}
        for n in old:
            self._fs.delete(self._path(f"{self.folder}/manifest/{n:012d}.json"), False)
        gone = [(name, run) for name in self._names("data") for run in self._names(f"data/{name}") if (name, run) not in used]
        for name, run in gone:
            self._fs.delete(self._path(f"{self.folder}/data/{name}/{run}"), True)
        return len(gone)


#: What a workbook shows by font and fill, per relation: the column that says so, and when. Null is no.
STYLES = {
    "combine_list": {"muted": "is_final = 'No'", "highlighted": "is_final <> 'No' and category_count > 1"},
    "final_status": {"highlighted": "changed = 'Yes'"},
    "change_log": {"highlighted": "note <> ''"},
    "release_summary": {"highlighted": "extracted <> expected_count"},
    "source_reconciliation": {"highlighted": "diff < 0"},
}


def with_styles(sheets: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The report relations with their styles as columns: grey rows that are not final, fills on what is changed, noted or short."""
    return {name: df.withColumns({c: F.coalesce(F.expr(when), F.lit(False)) for c, when in STYLES.get(name, {}).items()}) for name, df in sheets.items()}
