"""What a search has found so far, kept on shared storage."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolag.operators.metrics import METRICS
from aerolag.schema import FeatureSpec
from aerolag.sources.tables import folder_exists, records_table

LEDGER_SCHEMA = (
    "search string, trial int, foldCol int, status string, reason string, params map<string,string>, "
    + ", ".join(f"{split}_{m} double" for split in ("train", "val") for m in METRICS)
)


def search_id(df: DataFrame, kind: str, spec: FeatureSpec, **settings) -> str:
    """Names a search by its rows, features, kind of model and settings.

    Rows count by their label, features, fold and split, whatever their order,
    in one aggregate. Rows computed anew with other last digits are other rows:
    stage them. Settings are told apart by how they print.
    """
    cols = [*spec.features, spec.label, "foldCol", "split"]
    found = df.agg(F.count("*"), F.sum(F.xxhash64(*cols).cast("decimal(38,0)"))).first()
    named = json.dumps([str(v) for v in found] + [kind, asdict(spec), settings], sort_keys=True, default=repr)
    return hashlib.sha256(named.encode()).hexdigest()[:32]


class TrialLedger:
    """One record per search, trial and fold, under ``path``.

    Each record is written into a folder of its own, so trials record at the
    same time, and a write that was cut short leaves nothing that is read. A
    record written twice replaces itself. One folder may serve many searches.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def table(self) -> DataFrame:
        """All records; none if nothing was recorded yet."""
        if not folder_exists(self.spark, self.path):
            return self.spark.createDataFrame([], LEDGER_SCHEMA)
        return self.spark.read.schema(LEDGER_SCHEMA).option("recursiveFileLookup", "true").parquet(self.path)

    def found(self, search: str) -> dict[tuple[int, int], list[dict] | str]:
        """By trial and fold: the metrics of both splits, or why the model refused."""
        out: dict[tuple[int, int], list[dict] | str] = {}
        for r in self.table().filter(F.col("search") == search).collect():
            if r["status"] == "failed":
                out[r["trial"], r["foldCol"]] = r["reason"]
            else:
                out[r["trial"], r["foldCol"]] = [
                    {"foldCol": r["foldCol"], "split": s, **{m: r[f"{s}_{m}"] for m in METRICS}} for s in ("train", "val")]
        return out

    def record(self, search: str, trial: int, fold: int, params: Mapping[str, str], rows: Sequence[Mapping] | str) -> None:
        entry = {"search": search, "trial": trial, "foldCol": fold, "params": dict(params)}
        if isinstance(rows, str):
            entry |= {"status": "failed", "reason": rows}
        else:
            entry |= {"status": "scored", **{f"{r['split']}_{m}": r[m] for r in rows for m in METRICS}}
        one = records_table(self.spark, [entry], self.spark.createDataFrame([], LEDGER_SCHEMA).schema).coalesce(1)
        one.write.mode("overwrite").parquet(f"{self.path}/{search}/trial-{trial}/fold-{fold}")
