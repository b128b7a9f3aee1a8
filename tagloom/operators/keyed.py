"""A stored table in parts by key: a write rewrites the parts that hold written keys, as a new version.

Rows lie in ``parts`` folders by a hash of their key, sorted by key, so a part's row groups have narrow key ranges. Every
version is one small file that names, for each part, the folder which holds it. A write reads and rewrites only the parts
of its own keys; the other parts' files are carried over by name, so k written keys cost at most k parts whatever the
table's size. Choose ``parts`` so that one part is some hundred megabytes.

Versions are compared and set: version n + 1 is created by renaming a draft, which fails if another writer was first (as
atomic as the file system's rename without overwriting, as for streaming checkpoints). A writer that lost keeps the parts
it wrote if the winner left them alone, and applies its change again to the winner's rows if not. Readers see one whole
version. A failed writer leaves files that no version names; ``vacuum`` deletes these and what only old versions name.

The driver holds one entry per part and version, which does not grow with the rows of a part.

Defined cases: a row without a whole key, and several rows of one key, fail the write; an empty table and an empty write
are allowed; columns that the table lacks are an error of the change function or left out.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tagloom.functions.columns import all_of
from tagloom.operators.upsert import require_one_row_per_key, upsert
from tagloom.session import materialize, small_side

PART = "_part"


class Written(NamedTuple):
    """The version a write made, and the parts it rewrote."""

    version: int
    parts: list[int]


class KeyedTable:
    """A table below ``path``; make one with :func:`create`."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
        self._hadoop, self._conf = hadoop, conf
        self._fs = hadoop.Path(self.path).getFileSystem(conf)

    def version(self) -> int:
        """The newest version; -1 if there is none."""
        numbers = [int(n.removesuffix(".json")) for n, _ in self._listed("versions") if n.endswith(".json") and not n.startswith(".")]
        return max(numbers, default=-1)

    def read(self, version: int | None = None, parts: Iterable[int] | None = None) -> DataFrame:
        """The rows of a version (the newest by default), of all parts or of the given ones, in one scan."""
        return self._rows(self._head(self.version() if version is None else version), parts)

    def read_for(self, keys: DataFrame) -> DataFrame:
        """The stored rows with one of the keys; only the parts that can hold them are scanned."""
        head = self._head(self.version())
        asked = keys.select(*head["key"]).distinct()
        return self._rows(head, self._parts_of(asked, head)).join(small_side(asked), head["key"], "left_semi")

    def upsert(self, incoming: DataFrame, mode: str = "update", merge_maps: bool = False) -> Written:
        """Write rows as :func:`upsert.upsert` does. Rows meet by the table's key only, which they must carry: an id that a
        row of another key has is not looked up."""
        key = self._head(self.version())["key"]
        require_one_row_per_key(incoming, key)
        named = lambda rows: rows.withColumns({f"_key_{c}": F.col(c) for c in key})

        def change(stored: DataFrame, rows: DataFrame) -> DataFrame:
            return upsert(named(stored), named(rows), [f"_key_{c}" for c in key], mode, merge_maps, keep=("id", *key))

        return self.write(change, incoming)

    def delete(self, keys: DataFrame) -> Written:
        """Drop the rows with one of the keys; unknown keys are skipped."""
        key = self._head(self.version())["key"]
        listed = keys.select(*key).distinct()
        return self.write(lambda stored, rows: stored.join(small_side(rows), key, "left_anti"), listed)

    def write(self, change: Callable[[DataFrame, DataFrame], DataFrame], incoming: DataFrame, attempts: int = 20) -> Written:
        """Replace the parts that hold keys of ``incoming`` by ``change(stored rows of these parts, incoming)``.

        ``change`` may run more than once. The keys of its result must lie in the same parts.
        """
        version = self.version()
        head = self._head(version)
        incoming = materialize(incoming, "incoming")
        if not incoming.where(~all_of(F.col(c).isNotNull() for c in head["key"])).isEmpty():
            raise ValueError(f"rows of a keyed table need their whole key: {head['key']}")
        touched = self._parts_of(incoming, head)
        if not touched:
            return Written(version, [])
        for _ in range(attempts):
            fresh = self._store(change(self._rows(head, touched), incoming), head)
            strayed = sorted(set(fresh) - {str(p) for p in touched})
            if strayed:
                raise ValueError(f"the change made rows of other parts: {strayed[:3]}")
            met = False
            while not met:
                kept = {p: folder for p, folder in head["at"].items() if int(p) not in set(touched)}
                if self._commit(version + 1, {**head, "at": {**kept, **fresh}, "touched": touched}):
                    return Written(version + 1, touched)
                version += 1
                head = self._head(version)
                met = not set(touched).isdisjoint(head["touched"])
        raise RuntimeError(f"other writers changed the same parts {attempts} times")

    def vacuum(self, keep: int = 1, older_than_ms: int = 86_400_000) -> int:
        """Delete versions before the newest ``keep``, and folders that none of those names. Returns how many folders.

        Folders younger than ``older_than_ms`` stay: a writer may be about to commit them.
        """
        newest = self.version()
        kept = range(max(0, newest - keep + 1), newest + 1)
        named = {folder for v in kept for folder in self._head(v)["at"].values()}
        for name, _ in self._listed("versions"):
            if name.endswith(".json") and not name.startswith(".") and int(name.removesuffix(".json")) < kept.start:
                self._fs.delete(self._path("versions", name), False)
        now = self.spark._jvm.java.lang.System.currentTimeMillis()
        old = [name for name, at in self._listed("data") if name not in named and at <= now - older_than_ms]
        for name in old:
            self._fs.delete(self._path("data", name), True)
        return len(old)

    def _path(self, *names: str):
        return self._hadoop.Path("/".join([self.path, *names]))

    def _listed(self, *names: str) -> list[tuple[str, int]]:
        folder = self._path(*names)
        if not self._fs.exists(folder):
            return []
        return [(s.getPath().getName(), s.getModificationTime()) for s in self._fs.listStatus(folder)]

    def _head(self, version: int) -> dict:
        if version < 0:
            raise FileNotFoundError(f"no keyed table at {self.path}")
        return json.loads(self.spark.read.text(f"{self.path}/versions/{version:012d}.json", wholetext=True).first()[0])

    def _rows(self, head: dict, parts: Iterable[int] | None = None) -> DataFrame:
        wanted = None if parts is None else set(parts)
        schema = StructType.fromJson(head["schema"])
        folders = [f"{self.path}/data/{at}/{PART}={p}" for p, at in head["at"].items() if wanted is None or int(p) in wanted]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def _parts_of(self, rows: DataFrame, head: dict) -> list[int]:
        """At most one number per part."""
        return sorted(r[0] for r in rows.select(part_of(head).alias(PART)).distinct().collect())

    def _store(self, rows: DataFrame, head: dict) -> dict[str, str]:
        """Write rows to a new folder; which parts it holds."""
        folder = uuid.uuid4().hex
        columns = [f["name"] for f in head["schema"]["fields"]]
        dealt = rows.select(*[F.col(f"`{c}`") for c in columns], part_of(head).alias(PART)).repartition(PART)
        dealt.sortWithinPartitions(PART, *head["key"]).write.partitionBy(PART).parquet(f"{self.path}/data/{folder}")
        return {n.removeprefix(f"{PART}="): folder for n, _ in self._listed("data", folder) if n.startswith(f"{PART}=")}

    def _commit(self, version: int, head: dict) -> bool:
        """Create the version's file; False if it exists."""
        draft, final = self._path("versions", f".{uuid.uuid4().hex}"), self._path("versions", f"{version:012d}.json")
        out = self._fs.create(draft, False)
        out.write(bytearray(json.dumps(head).encode()))
        out.close()
        context = self._hadoop.FileContext.getFileContext(self._fs.getUri(), self._conf)
        plain = self.spark.sparkContext._gateway.new_array(getattr(self._hadoop, "Options$Rename"), 0)
        try:
            context.rename(self._fs.makeQualified(draft), self._fs.makeQualified(final), plain)
        except Py4JJavaError as failure:
            self._fs.delete(draft, False)
            if "FileAlreadyExistsException" in failure.java_exception.getClass().getName():
                return False
            raise
        return True


def part_of(head: dict) -> Column:
    return F.pmod(F.xxhash64(*head["key"]), F.lit(head["parts"])).cast("int")


def create(rows: DataFrame, path: str, key: Sequence[str], parts: int = 64) -> KeyedTable:
    """Store ``rows`` as version 0 of a keyed table; fails if there is one at ``path``."""
    key = list(key)
    if parts < 1 or not key:
        raise ValueError("a keyed table needs a key and at least one part")
    if PART in rows.columns:
        raise ValueError(f"the column {PART} is taken")
    table = KeyedTable(rows.sparkSession, path)
    if table.version() >= 0:
        raise FileExistsError(path)
    rows = materialize(rows, "keyed-rows")
    if not rows.where(~all_of(F.col(c).isNotNull() for c in key)).isEmpty():
        raise ValueError(f"rows of a keyed table need their whole key: {key}")
    require_one_row_per_key(rows, key)
    head = {"key": key, "parts": parts, "schema": rows.schema.jsonValue(), "at": {}, "touched": list(range(parts))}
    if not table._commit(0, {**head, "at": table._store(rows, head)}):
        raise FileExistsError(path)
    return table
