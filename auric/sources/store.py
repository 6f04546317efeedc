"""Sets of tables published together, in two phases, on a plain file system.

An attempt writes its tables under ``<root>/versions/<version>/<table>``, a
folder that no other attempt uses, and reads them back to check them. Only
then does it publish, by creating ``<root>/commits/<number>.json``, a file
that names the folders. The number is claimed by creating the file anew;
the highest number whose file is complete is current. Nothing that readers
use is ever deleted, renamed or overwritten, so at every moment they find
either the old set or the new one, and an attempt that dies between two
steps leaves files that no commit names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from auric.session import stage, together


class PublishRefused(RuntimeError):
    """A precondition or check of a publish failed; what was current stays current."""


def file_system(spark: SparkSession, path: str):
    """(file system, path object) for ``path``."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def read_bytes(spark: SparkSession, path: str) -> bytes:
    fs, p = file_system(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def create_file(spark: SparkSession, path: str, data: bytes) -> None:
    """Create ``path``; an error if it exists."""
    fs, p = file_system(spark, path)
    out = fs.create(p, False)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


@dataclass
class Draft:
    """Tables written by one attempt and not published yet."""

    store: "TableStore"
    run_id: str
    version: str
    base: int
    tables: dict[str, dict] = field(default_factory=dict)

    def add(self, name: str, df: DataFrame, root: str | None = None) -> DataFrame:
        """Write ``df`` as table ``name`` and return what was written. Rows are counted in the write pass and again in
        the files, which must agree. ``root`` puts the table outside the store, for restricted folders."""
        path = f"{(root or self.store.root).rstrip('/')}/versions/{self.version}/{name}"
        seen = Observation(f"{name}-{self.version}")
        df.observe(seen, F.count(F.lit(1)).alias("linhas")).write.option("compression", "zstd").parquet(path)
        written = self.store.spark.read.parquet(path)
        sent, found = seen.get.get("linhas", 0), written.count()
        if sent != found:
            raise PublishRefused(f"{name}: {sent} rows sent, {found} found in the files")
        self.tables[name] = {"caminho": path, "linhas": found, "colunas": written.columns}
        return written

    def read(self, name: str) -> DataFrame:
        return self.store.spark.read.parquet(self.tables[name]["caminho"])

    def check(self, name: str, failing: Callable[[Draft], DataFrame]) -> None:
        """Refuse unless ``failing``, computed over the written tables, has no rows."""
        self.check_all({name: failing})

    def check_all(self, checks: dict[str, Callable[[Draft], DataFrame]]) -> None:
        """Run several checks side by side and name those that fail."""
        empty = together(**{name: lambda f=failing: f(self).isEmpty() for name, failing in checks.items()})
        failed = [name for name, ok in empty.items() if not ok]
        if failed:
            raise PublishRefused(f"check failed on the tables written: {', '.join(failed)}")


class TableStore:
    """The published versions under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _names(self) -> list[str]:
        return [n for n in list_names(self.spark, f"{self.root}/commits") if n.endswith(".json")]

    def commits(self) -> list[dict]:
        """All published versions, oldest first. A commit file that its writer did not finish is not a commit."""
        out = []
        for name in self._names():
            try:
                commit = json.loads(read_bytes(self.spark, f"{self.root}/commits/{name}"))
            except ValueError:
                continue
            out.append(commit)
        return out

    def current(self) -> dict | None:
        found = self.commits()
        return found[-1] if found else None

    def read(self, name: str, commit: dict | None = None) -> DataFrame:
        commit = commit or self.current()
        if commit is None or name not in commit["tabelas"]:
            raise KeyError(f"{name} is not published under {self.root}")
        return self.spark.read.parquet(commit["tabelas"][name]["caminho"])

    def draft(self, run_id: str) -> Draft:
        base = self.current()
        return Draft(self, run_id, f"{run_id}-{uuid.uuid4().hex[:12]}", base["numero"] if base else 0)

    def publish(self, draft: Draft, **facts) -> dict:
        """Make the draft current. Refused if another attempt has published since the draft began."""
        now = self.current()
        if (now["numero"] if now else 0) != draft.base:
            raise PublishRefused(f"version {now['numero']} of run {now['execucao_id']} was published meanwhile")
        taken = self._names()
        number = max([draft.base, *(int(n.removesuffix(".json")) for n in taken)]) + 1  # after unfinished ones too
        commit = {"numero": number, "execucao_id": draft.run_id, "versao": draft.version, "tabelas": draft.tables, **facts}
        try:
            create_file(self.spark, f"{self.root}/commits/{number:09d}.json", json.dumps(commit).encode())
        except Exception as e:  # the file exists: another attempt took the number
            raise PublishRefused(f"number {number} is taken") from e
        return commit

    def expire(self, keep: int = 2) -> list[str]:
        """Delete version folders that none of the last ``keep`` commits names; those of attempts under way must be
        excluded by running this between runs. Commit files stay, as the history of the store."""
        kept = {c["versao"] for c in self.commits()[-keep:]}
        gone = [v for v in list_names(self.spark, f"{self.root}/versions") if v not in kept]
        for v in gone:
            fs, p = file_system(self.spark, f"{self.root}/versions/{v}")
            fs.delete(p, True)
        return gone


def duplicates(df: DataFrame, *key: str) -> DataFrame:
    """Keys that stand more than once, null ones too. Hashes are counted first and moved in place of the keys; only rows
    of a hash that stands more than once are then counted by their keys."""
    hashed = df.select(*key, F.xxhash64(*key).alias("_h"))
    twice = stage(hashed.groupBy("_h").count().where("count > 1").select("_h"), "duplicates")
    if twice.isEmpty():
        return twice.select(*[F.lit(None).cast(df.schema[k].dataType).alias(k) for k in key], F.lit(0).cast("long").alias("count"))
    return hashed.join(twice, "_h", "left_semi").groupBy(*key).count().where("count > 1")


def orphans(df: DataFrame, parent: DataFrame, *key: str) -> DataFrame:
    """Rows whose key has no parent."""
    return df.join(parent.select(*key), list(key), "left_anti")
