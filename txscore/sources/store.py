"""A store of fitted models with whole versions and an ordered feature list.

A version is a folder of tables. Its manifest (key, feature list, table names) is written last, in
one commit, so a version that a lost job left half written is never seen; readers take the last
version with a manifest. A key tells apart what models were fitted on, e.g. ``fingerprint`` of the
training table with the parameters.

Scoring takes a model's features by name: ``aligned`` puts the columns of a table, or the
positions of a vector column that carries its names as metadata, into the stored order, leaves
out others and refuses missing ones.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txscore.session import ensure_checkpoint_dir

FEATURES = "features"  # metadata key of a vector column


def fingerprint(df: DataFrame, **settings) -> str:
    """Key of a table's content (rows in any order) and of settings."""
    h = F.xxhash64(*df.columns).cast("decimal(38,0)")
    n, total = df.agg(F.count(F.lit(1)), F.sum(h)).first()
    return json.dumps({"rows": n, "hash": str(total), **settings}, sort_keys=True, default=str)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


@dataclass
class Stored:
    """One whole version."""
    spark: SparkSession
    path: str
    version: int
    features: list[str]
    tables: list[str]
    held: dict = field(default_factory=dict)

    def table(self, name: str) -> DataFrame:
        if name not in self.tables:
            raise ValueError(f"version {self.version} has no table {name}, only {self.tables}")
        return self.spark.read.parquet(f"{self.path}/{name}")


class ModelStore:
    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = (root or f"{ensure_checkpoint_dir(spark).rstrip('/')}/txscore/store").rstrip("/")

    def manifests(self) -> DataFrame | None:
        path = f"{self.root}/manifests"
        return self.spark.read.parquet(path) if _exists(self.spark, path) else None

    def publish(self, tables: dict[str, DataFrame], features: Sequence[str], key: str = "") -> Stored:
        """Write a new version; it counts once its manifest is written."""
        known = self.manifests()
        last = known.agg(F.max("version")).first()[0] if known is not None else None
        version = (last or 0) + 1
        path = f"{self.root}/v{version}"
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{path}/{name}")
        row = [(key, list(features), sorted(tables))]
        self.spark.createDataFrame(row, "key string, features array<string>, tables array<string>").coalesce(1) \
            .write.mode("errorifexists").parquet(f"{self.root}/manifests/version={version}")
        return Stored(self.spark, path, version, list(features), sorted(tables))

    def latest(self, key: str | None = None) -> Stored | None:
        """The last whole version (of a key, if given)."""
        known = self.manifests()
        if known is None:
            return None
        rows = known if key is None else known.where(F.col("key") == key)
        row = rows.orderBy(F.desc("version")).first()  # one row for each version
        return row and Stored(self.spark, f"{self.root}/v{row.version}", row.version, list(row.features),
                              list(row.tables))


def vector(features: Sequence[str], name: str = "vec") -> Column:
    """The columns ``features`` as one array column that carries their names."""
    return F.array(*[F.col(f"`{f}`").cast("double") for f in features]).alias(
        name, metadata={FEATURES: list(features)})


def aligned(df: DataFrame, features: Sequence[str], vec: str | None = None) -> list[Column]:
    """The columns of the stored ``features`` in their order, from columns of ``df`` or from the
    positions of its vector column ``vec``. Others are left out; a missing one is an error."""
    if vec is None:
        have = {c: F.col(f"`{c}`") for c in df.columns}
    else:
        names = df.schema[vec].metadata.get(FEATURES)
        if names is None:
            raise ValueError(f"column {vec} carries no feature names")
        have = {c: F.col(vec)[i] for i, c in enumerate(names)}
    if missing := [f for f in features if f not in have]:
        raise ValueError(f"features {missing} not found")
    return [have[f].cast("double").alias(f) for f in features]
