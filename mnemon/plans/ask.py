"""Questions to a stored report, and its embedding corpus."""

from __future__ import annotations

import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mnemon import providers
from mnemon.operators import embeddings, projects, recall
from mnemon.plans import nightly
from mnemon.sources import settings


def provider_of(name: str, report: dict[str, DataFrame], query: str, out: str) -> recall.Provider:
    """``stub``, or ``local`` for the archive's vectors and the same model's vector of the query."""
    if name != "local":
        return recall.Provider(name)
    spark = report["candidates"].sparkSession
    from mnemon.operators import archive

    stored = archive.read_table(spark, "embeddings", f"{out}/archive")
    if stored is None:
        return recall.Provider("vectors")
    vectors = stored.where("status = 'embedded'").select(F.concat_ws(":", "source_type", "source_key").alias("ref"), "vector")
    return recall.Provider("vectors", vectors, providers.local_embed([query])[0])


def answer(spark: SparkSession, out: str, date: str, query: str, k: int = 5, mode: str = "recall", provider: str = "stub", known: list[dict] | None = None) -> dict:
    """What a report of that date has to say to the query, or in mode ``embedding-preview`` what of it is embedded."""
    report = nightly.read_report(spark, out, date)
    if mode == "embedding-preview":
        payloads = [r.asDict() for r in embeddings.payloads(report["candidates"], report["promotions"]).orderBy("object_type", "object_id").collect()]  # of one night
        return {"ok": True, "mode": mode, "count": len(payloads), "payloads": payloads}
    if not query.strip():
        raise ValueError("recall needs a query")
    catalogue = spark.createDataFrame(known, projects.CATALOGUE) if known else None
    found = recall.recall(query, report["candidates"], report["promotions"], k, catalogue, provider_of(provider, report, query, out))
    items = [] if found.items is None else [r.asDict(recursive=True) for r in found.items.collect()]  # k rows
    seeds = [] if found.seeds is None else [r["ref"] for r in found.seeds.select("ref").collect()]
    return {"ok": True, "mode": mode, "query": found.query, "normalized": found.normalized, "projects": found.project_hints, "items": items, "semantic": {"status": found.status, "refs": seeds}, "trace": found.trace()}


def main(argv: list[str] | None = None) -> int:
    """``python -m mnemon.plans.ask --out DIR --date D --query Q [--top-k K] [--mode embedding-preview] [--semantic-provider local]``"""
    try:
        argv = sys.argv[1:] if argv is None else argv
        args, conf = settings.parse_args(argv), settings.Settings.load(argv)
        spark = SparkSession.builder.appName("ask").config("spark.sql.session.timeZone", "UTC").getOrCreate()
        k = settings.to_positive(args.get("top-k")) or 5
        mode = str(args.get("mode") or "recall").strip().lower()
        print(json.dumps(answer(spark, conf.out, conf.date, str(args.get("query") or ""), k, mode, str(args.get("semantic-provider") or "stub"), conf.known_projects), ensure_ascii=False))
        return 0
    except Exception as error:
        print(json.dumps({"ok": False, "error": str(error)}), file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
