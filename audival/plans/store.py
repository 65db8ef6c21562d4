"""Published tables, by month: what a run wrote, what readers see, and when old
data goes.

    tables/<table>/run=<run>/month=<month>/part-*   written once, never changed
    manifests/<number>.json                         a publication: the run of each month
    leases/<name>.json                              who needs a publication or writes a run

A publication is one new file under the next number, so it is seen whole or not
at all, and of two at once one fails. Readers take a lease on the publication
they read; ``expire`` removes publications beyond the last few that nobody
holds, and then the data that no publication left names and no run is writing:
the months of old and of failed runs.

Rows are sorted by the table's key columns, as the models order their results:
folders by month, and a month's cells, a file, by the other keys. A filter on
the month reads that month's file alone, one on another key the row groups
whose bounds fit.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from audival.plans.files import Files
from audival.plans.stage import Stager

MONTH = "month"


def key_columns(df: DataFrame) -> list[str]:
    """What a table is ordered by: the month, then its other keys as they come."""
    return [MONTH, *[c for c, kind in df.dtypes if c != MONTH and kind != "double"]]


class MonthTables(Stager):
    """Writes the tables of one run by month, each sorted by its keys."""

    def __init__(self, spark: SparkSession, root: str, run: str):
        super().__init__(spark, root)
        self.run = run
        self.schemas: dict[str, StructType] = {}

    def path(self, name: str) -> str:
        return f"{self.root}/tables/{name}/run={self.run}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        self.schemas[name] = df.schema
        keys = key_columns(df)
        # a month's cells (devices x states x segments) are few, whatever the rows they come from
        df.repartition(MONTH).sortWithinPartitions(*keys).write.mode("overwrite").partitionBy(MONTH).parquet(
            self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name)).select(*df.columns)


@dataclass
class Reading:
    """The tables of one publication, held until ``release`` or the lease ends."""

    tables: dict[str, DataFrame]
    number: int
    store: Published
    lease: str

    def release(self) -> None:
        self.store.files.delete(self.lease)


class Published:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.files = spark, root.rstrip("/"), Files(spark)

    # -------------------------------------------------------- publications

    def _manifest(self, number: int) -> str:
        return f"{self.root}/manifests/{number:010d}.json"

    def numbers(self) -> list[int]:
        return [int(n.split(".")[0]) for n in self.files.names(f"{self.root}/manifests") if n.endswith(".json")]

    def manifest(self, number: int | None = None) -> dict | None:
        """A publication, the latest if no number is given: ``months`` (month to
        fingerprint and run), ``tables`` (table to schema and months with rows)."""
        if number is None:
            numbers = self.numbers()
            if not numbers:
                return None
            number = numbers[-1]
        return json.loads(self.files.read(self._manifest(number)))

    def publish(self, manifest: dict, after: int | None) -> int:
        """The next publication after number ``after``; an error if there is one by now."""
        number = (after or 0) + 1
        text = json.dumps(manifest | {"number": number, "at": time.time()}, sort_keys=True)
        draft = f"{self.root}/manifests/.draft-{uuid.uuid4().hex}"
        self.files.write(draft, text)
        try:
            self.files.move(draft, self._manifest(number))
        except Exception as e:
            self.files.delete(draft)
            raise RuntimeError(f"publication {number} of {self.root} exists by now: run again") from e
        return number

    # --------------------------------------------------------------- leases

    def hold(self, what: dict, seconds: float) -> str:
        path = f"{self.root}/leases/{uuid.uuid4().hex}.json"
        self.files.write(path, json.dumps(what | {"until": time.time() + seconds}))
        return path

    def _held(self) -> list[dict]:
        now, out = time.time(), []
        for name in self.files.names(f"{self.root}/leases"):
            try:
                lease = json.loads(self.files.read(f"{self.root}/leases/{name}"))
            except Exception:  # noqa: BLE001 - released, or being written, since the listing
                if not self.files.exists(f"{self.root}/leases/{name}"):
                    continue
                raise
            if lease["until"] > now:
                out.append(lease)
            else:
                self.files.delete(f"{self.root}/leases/{name}")
        return out

    # -------------------------------------------------------------- readers

    def open(self, hold: float = 24 * 3600.0) -> Reading:
        """The latest publication, held for ``hold`` seconds at most."""
        while True:
            numbers = self.numbers()
            if not numbers:
                raise FileNotFoundError(f"nothing is published under {self.root}")
            lease = self.hold({"number": numbers[-1]}, hold)
            # the lease first, then the look: what is there now stays
            if self.files.exists(self._manifest(numbers[-1])):
                return Reading(self.read(self.manifest(numbers[-1])), numbers[-1], self, lease)
            self.files.delete(lease)

    def read(self, manifest: dict) -> dict[str, DataFrame]:
        out = {}
        for table, what in manifest["tables"].items():
            schema = StructType.fromJson(what["schema"])
            base = f"{self.root}/tables/{table}"
            paths = [f"{base}/run={run}/{MONTH}={m}" for m, run in sorted(what["months"].items())]
            if paths:
                df = self.spark.read.schema(schema.add("run", "string")).option("basePath", base).parquet(*paths)
                out[table] = df.drop("run").select(*[f.name for f in schema.fields if f.name != "run"])
            else:
                out[table] = self.spark.createDataFrame([], schema)
        return out

    # --------------------------------------------------------------- expiry

    def expire(self, keep: int = 2) -> list[str]:
        """Remove what is neither of the last ``keep`` publications, nor held,
        nor being written. Returns the folders removed."""
        aside = []
        held = {lease.get("number") for lease in self._held()}
        for number in self.numbers()[:-max(1, keep)]:
            if number not in held:
                self.files.move(self._manifest(number), f"{self._manifest(number)}.expired")
                aside.append(number)
        # a reader that got its lease before its manifest went keeps it
        leases = self._held()
        held = {lease.get("number") for lease in leases}
        for number in aside:
            if number in held:
                self.files.move(f"{self._manifest(number)}.expired", self._manifest(number))
        writing = {lease.get("run") for lease in leases}
        used = {(table, run, m) for n in self.numbers() for table, what in self.manifest(n)["tables"].items()
                for m, run in what["months"].items()}
        gone = []
        for table in self.files.names(f"{self.root}/tables"):
            for folder in self.files.names(f"{self.root}/tables/{table}"):
                run, path = folder.split("=", 1)[-1], f"{self.root}/tables/{table}/{folder}"
                if run in writing:
                    continue
                months = [n for n in self.files.names(path) if n.startswith(f"{MONTH}=")]
                kept = [n for n in months if (table, run, n.split("=", 1)[1]) in used]
                for path in [path] if not kept else [f"{path}/{n}" for n in months if n not in kept]:
                    self.files.delete(path)
                    gone.append(path)
        for name in self.files.names(f"{self.root}/manifests"):
            if name.endswith(".expired"):
                self.files.delete(f"{self.root}/manifests/{name}")
        return gone
