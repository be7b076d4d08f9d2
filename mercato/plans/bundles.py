"""Versioned model bundles (S11): what training fitted, written once and loaded by scoring.

A bundle is a folder ``<root>/<name>/v<number>`` with MLlib models, the tables that were fitted with
them (label maps, medians, vocabulary, classes, predictions) and ``manifest.json``, which names them,
the features in order with their types, a hash of that schema and a fingerprint of the training data.
The manifest is created last and only if it isn't there, so a folder without one is no bundle: readers
never see half of one, on object stores without an atomic rename too, and of two writers that
take the same number one moves on to the next.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import uuid
from dataclasses import dataclass, field

from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


class BundleError(ValueError):
    """A bundle that is absent, or that doesn't fit the code that asks for it."""


@dataclass
class Bundle:
    name: str
    version: int
    trained_at: str
    features: dict[str, list[list[str]]]             # model -> [[feature, type], ...] in the model's order
    models: dict[str, object] = field(default_factory=dict)
    tables: dict[str, DataFrame] = field(default_factory=dict)
    data: str = ""                                   # fingerprint of what it was trained on

    def check(self, model: str, features: list[str]) -> None:
        """An error unless ``features`` are those that the model was fitted on, in their order."""
        own = [f for f, _ in self.features[model]]
        if own != list(features):
            raise BundleError(f"{self.name} v{self.version}, {model}: fitted on the features {own}, asked for {list(features)}")

    def check_types(self, model: str, df: DataFrame) -> None:
        """An error unless the columns of ``df`` have the kinds (number or text) that the model was fitted on."""
        for f, kind in self.features[model]:
            if f not in df.columns:
                raise BundleError(f"{self.name} v{self.version}, {model}: no column {f}")
            if feature_kind(df, f) != kind:
                raise BundleError(f"{self.name} v{self.version}, {model}: {f} is a {feature_kind(df, f)}, it was a {kind}")


def feature_kind(df: DataFrame, column: str) -> str:
    return "text" if df.schema[column].dataType.typeName() == "string" else "number"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a small file unless it is there; False if it is."""
    jvm, at, fs = _fs(spark, path)
    try:
        out = fs.create(at, False)
    except Exception as e:
        if fs.exists(at):
            return False
        raise e
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def delete_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder, if it is there."""
    jvm, at, fs = _fs(spark, path)
    fs.delete(at, True)


def _schema_hash(features: dict) -> str:
    return hashlib.sha256(json.dumps(features, sort_keys=True).encode()).hexdigest()


def data_fingerprint(spark: SparkSession, folder: str) -> str:
    """A hash of the names, sizes and times of the files under ``folder``: another one when the data change."""
    jvm, at, fs = _fs(spark, folder)
    found, it = [], fs.listFiles(at, True)
    while it.hasNext():
        f = it.next()
        found.append((str(f.getPath().toUri().getPath()), f.getLen(), f.getModificationTime()))
    return hashlib.sha256(json.dumps(sorted(found)).encode()).hexdigest()


def models_root(spark: SparkSession) -> str:
    """``mercato.models.dir`` of the session, or ``models`` in the shared checkpoint folder."""
    return spark.conf.get("mercato.models.dir", None) or f"{ensure_checkpoint_dir(spark).rstrip('/')}/models"


def versions(spark: SparkSession, root: str, name: str) -> list[int]:
    """Complete versions of a bundle, oldest first."""
    jvm, at, fs = _fs(spark, f"{root}/{name}")
    if not fs.exists(at):
        return []
    out = []
    for f in fs.listStatus(at):
        folder = f.getPath().getName()
        if folder[:1] == "v" and folder[1:].isdigit() and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{root}/{name}/{folder}/manifest.json")):
            out.append(int(folder[1:]))
    return sorted(out)


def save_bundle(spark: SparkSession, root: str, name: str, models: dict[str, object], tables: dict[str, DataFrame],
                features: dict[str, list[list[str]]], data: str = "") -> int:
    """Writes a bundle and returns its version.  Parts go to folders of their own; the manifest names them."""
    parts = f"{root}/{name}/parts-{uuid.uuid4().hex}"
    for key, model in models.items():
        model.write().save(f"{parts}/models/{key}")
    for key, df in tables.items():
        df.write.parquet(f"{parts}/tables/{key}")
    manifest = {"name": name, "trained_at": dt.datetime.now(dt.timezone.utc).isoformat(timespec="seconds"), "parts": parts,
                "models": {k: f"{type(m).__module__}.{type(m).__name__}" for k, m in models.items()}, "tables": sorted(tables),
                "features": features, "schema_hash": _schema_hash(features), "data": data}
    version = max(versions(spark, root, name), default=0) + 1
    while not _create(spark, f"{root}/{name}/v{version}/manifest.json", json.dumps({**manifest, "version": version})):
        version += 1
    return version


def _manifest(spark: SparkSession, root: str, name: str, version: int) -> dict:
    m = json.loads(_read_text(spark, f"{root}/{name}/v{version}/manifest.json"))
    if m["schema_hash"] != _schema_hash(m["features"]):
        raise BundleError(f"{name} v{version}: the features in its manifest are not those it was written with")
    return m


def load_bundle(spark: SparkSession, root: str, name: str, version: int | None = None) -> Bundle:
    """The newest version of a bundle, or ``version``; an error if there is none or its manifest was changed."""
    found = versions(spark, root, name)
    version = version if version is not None else (found[-1] if found else None)
    if version not in found:
        raise BundleError(f"no bundle {name}{f' v{version}' if version else ''} under {root}")
    m = _manifest(spark, root, name, version)
    out = Bundle(name, version, m["trained_at"], m["features"], data=m["data"])
    out.models = {k: DefaultParamsReader.loadParamsInstance(f"{m['parts']}/models/{k}", spark) for k in m["models"]}
    out.tables = {k: spark.read.parquet(f"{m['parts']}/tables/{k}") for k in m["tables"]}
    return out


def current_bundle(spark: SparkSession, root: str, name: str, data: str) -> Bundle | None:
    """The newest bundle if it was trained on these data, else None."""
    for version in versions(spark, root, name)[::-1]:
        if _manifest(spark, root, name, version)["data"] == data:
            return load_bundle(spark, root, name, version)
    return None


def metrics_history(spark: SparkSession, root: str) -> DataFrame:
    """Every training's metrics as (bundle, version, trained_at, metric, value) rows, oldest first."""
    return spark.read.parquet(f"{root}/metrics").orderBy("trained_at", "bundle", "version", "metric")


def append_training_metrics(bundle: Bundle, metrics: DataFrame, root: str) -> None:
    """Adds a one-row metrics table to the history, by name, so that trainings of every kind share it."""
    cols = [f.name for f in metrics.schema.fields if f.dataType.typeName() in ("double", "float", "integer", "long", "short", "byte", "boolean")]
    rows = metrics.select(F.lit(bundle.name).alias("bundle"), F.lit(bundle.version).alias("version"), F.lit(bundle.trained_at).alias("trained_at"),
                          F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in cols])).alias("m")) \
        .select("bundle", "version", "trained_at", "m.*")
    rows.coalesce(1).write.mode("append").parquet(f"{root}/metrics")
