"""A catalogue in versions: a change is data files first and one manifest, put in place by a rename, last.

Rows lie below ``data/commit=<id>/profile=<slug>``, never changed once written.  ``log`` holds one
manifest per version: which commit replaced or extended which profiles.  A reader takes the manifests
up to its version; a commit that failed before its manifest is not seen by anyone.  Two writers that
touched one profile from the same version conflict: the later one is refused and changes nothing.

The rename must fail where the target exists, as on HDFS and local disks.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from catalogia import fixed_values as V
from catalogia.operators.review import with_review

REPLACE, APPEND = "replace", "append"


class Conflict(Exception):
    """Somebody else changed a profile since the version that a change was made from."""


@dataclass
class Catalogue:
    """A catalogue at a path; ``spark`` reads and writes its rows."""

    spark: SparkSession
    path: str

    def __post_init__(self):
        jvm = self.spark._jvm
        self._fs = jvm.org.apache.hadoop.fs
        conf = self.spark._jsc.hadoopConfiguration()
        root = self._fs.Path(self.path)
        self._files = root.getFileSystem(conf)
        self._context = self._fs.FileContext.getFileContext(self._files.getUri(), conf)
        self._files.mkdirs(self._fs.Path(f"{self.path}/log"))

    # --- log ---------------------------------------------------------------------------

    def _names(self) -> list[str]:
        found = self._files.listStatus(self._fs.Path(f"{self.path}/log"))
        return sorted(n for n in (s.getPath().getName() for s in found) if n.endswith(".json") and not n.startswith("."))

    def version(self) -> int:
        """The last version; 0 before the first change."""
        names = self._names()
        return int(names[-1].split(".")[0]) if names else 0

    def history(self, version: int | None = None) -> list[dict]:
        """The manifests up to a version, oldest first."""
        last = self.version() if version is None else version
        paths = [f"{self.path}/log/{n}" for n in self._names() if int(n.split(".")[0]) <= last]
        if not paths:
            return []
        rows = self.spark.read.text(paths, wholetext=True).collect()
        return sorted((json.loads(r["value"]) for r in rows), key=lambda m: m["version"])

    def _publish(self, manifest: dict) -> bool:
        """Put the manifest in place; False if its version is taken."""
        hidden = self._fs.Path(f"{self.path}/log/.{manifest['commit']}.json")
        out = self._files.create(hidden, True)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        target = self._fs.Path(f"{self.path}/log/{manifest['version']:020d}.json")
        none = self.spark._sc._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            self._context.rename(hidden, target, none)
        except Exception as error:
            if "FileAlreadyExistsException" not in str(error):
                raise
            self._files.delete(hidden, False)
            return False
        return True

    # --- rows --------------------------------------------------------------------------

    def read(self, version: int | None = None, profile: str | None = None) -> DataFrame:
        """The rows of a version (default: the last).

        Only folders of commits that still count are opened; of those, the profiles whose rows
        were replaced later are pruned.
        """
        history = self.history(version)
        if not history:
            raise ValueError("the catalogue has no version yet")
        return self._rows(self._live(history, profile), self._schema(history))

    def changes(self, since: int, version: int | None = None) -> DataFrame:
        """Rows that came (sign 1) and went (sign -1) from version ``since`` (0: none yet) to a later one.

        Only commits that count in one of the two versions alone are opened; a row that was written
        again unchanged both went and came.
        """
        history = self.history(version)
        if not history:
            raise ValueError("the catalogue has no version yet")
        before = self._live([m for m in history if m["version"] <= since])
        after, schema = self._live(history), self._schema(history)
        came = self._rows(after - before, schema).withColumn("sign", F.lit(1).cast("bigint"))
        return came.unionByName(self._rows(before - after, schema).withColumn("sign", F.lit(-1).cast("bigint")))

    @staticmethod
    def _schema(history: list[dict]) -> T.StructType:
        return T.StructType.fromJson(history[-1]["schema"])

    @staticmethod
    def _live(history: list[dict], profile: str | None = None) -> set[tuple[str, str]]:
        """(commit, profile) of the rows that count after the given manifests."""
        live: dict[str, list[str]] = {}
        for manifest in history:
            for name in manifest["profiles"]:
                kept = live.get(name, []) if manifest["mode"] == APPEND else []
                live[name] = kept + ([manifest["commit"]] if name in manifest["filled"] else [])
        return {(c, p) for p, listed in live.items() for c in listed if profile in (None, p)}

    def _rows(self, live: set[tuple[str, str]], schema: T.StructType) -> DataFrame:
        if not live:
            return self.spark.createDataFrame([], schema)
        commits = sorted({c for c, _ in live})
        stored = T.StructType([*schema.fields, T.StructField("commit", T.StringType())])
        rows = self.spark.read.schema(stored).option("basePath", f"{self.path}/data").parquet(
            *[f"{self.path}/data/commit={c}" for c in commits])
        pairs = self.spark.createDataFrame(sorted(live), "commit string, profile string")
        return rows.join(F.broadcast(pairs), ["commit", "profile"]).select(*schema.names)

    def _commit(self, rows: DataFrame, profiles: list[str], base: int, mode: str, operation: str) -> int:
        """Write rows, then publish them as the version after the last; rows come from version ``base``."""
        commit = uuid.uuid4().hex
        (
            rows.hint("rebalance", F.col("profile"), F.col("category")).sortWithinPartitions("profile", "category")
            .write.partitionBy("profile").parquet(f"{self.path}/data/commit={commit}")
        )
        written = f"{self.path}/data/commit={commit}"
        folders = self._files.listStatus(self._fs.Path(written))
        unquoted = self.spark._jvm.java.net.URLDecoder
        filled = sorted(
            unquoted.decode(s.getPath().getName().removeprefix("profile=").replace("+", "%2B"), "UTF-8")
            for s in folders if s.getPath().getName().startswith("profile="))
        manifest = {
            "commit": commit, "mode": mode, "operation": operation, "base": base,
            "profiles": sorted({*profiles, *filled}), "filled": filled, "schema": rows.schema.jsonValue(),
        }
        touched, seen = set(manifest["profiles"]), base
        while True:
            for other in self.history():
                if other["version"] > seen and touched & set(other["profiles"]):
                    raise Conflict(f"version {other['version']} changed {sorted(touched & set(other['profiles']))}")
            seen = self.version()
            if self._publish({**manifest, "version": seen + 1}):
                return seen + 1

    def rewrite(self, items: DataFrame, profiles: list[str] | None = None, base: int | None = None) -> int:
        """Replace profiles by the given rows: those listed, and those that have rows.

        A listed profile without rows loses all it had.  Returns the new version.
        """
        at = self.version() if base is None else base
        return self._commit(items, profiles or [], at, REPLACE, "rewrite")

    def append_discards(self, discards: DataFrame, base: int | None = None) -> int:
        """Add discards; rows that are there already (same place and url) are not added again."""
        at = self.version() if base is None else base
        rows = discards.withColumn("category", F.lit(V.DISCARD))
        if at:
            place = ["profile", "original_file_id", "file_id", "ord", "url"]
            known = self.read(at).filter(F.col("category") == V.DISCARD).select(*place).alias("k")
            same = reduce(lambda x, y: x & y, [F.col(f"n.{c}").eqNullSafe(F.col(f"k.{c}")) for c in place])
            rows = rows.alias("n").join(known, same, "left_anti")
        return self._commit(rows, [], at, APPEND, "append discards")

    def review(self, decisions: DataFrame, base: int | None = None) -> int:
        """Take decisions (profile, url, action, decided_at) into the catalogue in one change.

        Approved rows get confidence 1, rejected ones move to the discards; only profiles with
        decisions are written.
        """
        at = self.version() if base is None else base
        named = [r["profile"] for r in decisions.select("profile").distinct().collect()]
        rows = self.read(at).filter(F.col("profile").isin(named))
        return self._commit(with_review(rows, decisions), named, at, REPLACE, "review")

    def orphans(self) -> list[str]:
        """Commits whose data no manifest names: failed or refused ones, to be removed by their owner."""
        try:
            found = self._files.listStatus(self._fs.Path(f"{self.path}/data"))
        except Exception as error:
            if "FileNotFoundException" not in str(error):
                raise
            return []
        known = {m["commit"] for m in self.history()}
        return sorted({s.getPath().getName().removeprefix("commit=") for s in found} - known)
