"""Registered queries: a function from inputs to a DataFrame, and the SQL that checks it."""

from __future__ import annotations

import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fleetaudit.plans.adapters import SQL, adapter, tables_in, with_adapters
from fleetaudit.sources.layout import kept

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


class Inputs:
    """Adapters over the tables of one data directory: ``inputs("saved_objects")``.

    Each table is opened once per query and each adapter built once.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")  # the last of equal keys counts, as other readers have it
        self.need_folder()  # joins by name patterns write their small tables there
        self._views: dict[str, str] = {}
        self._built: dict[str, DataFrame] = {}
        self._shared: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __call__(self, name: str) -> DataFrame:
        if name not in self._built:
            for table in tables_in(SQL[name]):
                if table not in self._views:
                    self._views[table] = f"fleetaudit_{table}"
                    self.table(table).createOrReplaceTempView(self._views[table])
            self._built[name] = adapter(self.spark, name, self._views)
        return self._built[name]

    def shared(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A result that several parts of a query use, worked out once and kept in the checkpoint folder."""
        if name not in self._shared:
            self._shared[name] = kept(build())
        return self._shared[name]

    def need_folder(self) -> None:
        """A local session that names no checkpoint folder gets one; a cluster has to name its own."""
        if not self.spark.conf.get("spark.checkpoint.dir", None) and self.spark.sparkContext.master.startswith("local"):
            self.spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="fleetaudit-"))


def query(name: str, uses: tuple[str, ...] = (), check: str | None = None):
    """Registers a query under a name, with its check SQL over the adapters it uses."""

    def register(build: Callable[[Inputs], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: build(Inputs(spark, sf_dir))
        if check is not None:
            CHECKS[name] = with_adapters(uses, check)
        return build

    return register
