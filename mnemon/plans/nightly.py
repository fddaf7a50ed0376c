"""One night's run: sessions of a day to scores, candidates, promotions and the archive."""

from __future__ import annotations

import datetime as dt
import json
import sys
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mnemon import lexicon as L
from mnemon import providers
from mnemon.functions import numbers
from mnemon.operators import archive, candidates, embeddings, projects, promotions, retention, scoring, sessions
from mnemon.plans.stage import materialize
from mnemon.sources import settings, transcripts


@dataclass
class Report:
    """Everything that a night makes."""

    sessions: DataFrame
    messages: DataFrame
    candidates: DataFrame
    promotions: DataFrame
    purge: DataFrame
    payloads: DataFrame
    documents: DataFrame
    embeddings: DataFrame
    archive: dict[str, DataFrame]
    files_scanned: int = 0
    window: tuple[str, str] | None = None

    def counts(self) -> DataFrame:
        """One row of the run's counts."""
        hints = F.coalesce(F.size("project_hints"), F.lit(0))
        s = self.sessions.agg(
            F.count(F.lit(1)).alias("sessions"), F.count_if(hints > 0).alias("sessions_with_projects"),
            *(F.count_if(F.col("effective_decision") == d).alias(d) for d in L.DECISIONS),
        )
        slugs = self.sessions.select(F.explode("project_hints").alias("h")).agg(F.count_distinct("h.slug").alias("projects"))
        c = self.candidates.agg(F.count(F.lit(1)).alias("candidates"), F.count_if(F.col("primary_project").isNotNull()).alias("candidates_with_projects"))
        p = self.purge.agg(F.count_if(F.col("action") == "purge_candidate").alias("purge_candidates"), F.count_if(F.col("action") == "keep").alias("kept"), F.count_if(F.col("action") == "review").alias("review"))
        q = self.promotions.agg(F.count(F.lit(1)).alias("promotions_planned"))
        e = self.payloads.agg(F.count(F.lit(1)).alias("embedding_payloads_planned"))
        v = self.embeddings.agg(F.count_if(F.col("status") == "embedded").alias("vectors"))
        return s.join(slugs, F.lit(True)).join(c, F.lit(True)).join(p, F.lit(True)).join(q, F.lit(True)).join(e, F.lit(True)).join(v, F.lit(True))  # one row each

    def scorers(self) -> dict[str, int]:
        return {r["scorer_type"]: r["count"] for r in self.sessions.groupBy("scorer_type").count().collect()}

    def summary(self, mode: str, date: dt.date, zone: str | None) -> dict:
        """What the run did, for people and for other programs."""
        return {
            "version": 4, "mode": mode, "date": date.isoformat(), "time_zone": zone, "window": self.window and dict(zip(("start", "end"), self.window)),
            "scorers": self.scorers(), "counts": {"files_scanned": self.files_scanned, **self.counts().first().asDict()},
        }


def build(
    headers: DataFrame, messages: DataFrame, date: dt.date, zone: str | None = None, lexicon: L.Lexicon = L.DEFAULT, catalogue: DataFrame | None = None, limit: int | None = None,
    model: providers.Score | None = None, embed: providers.Embed | None = None, purge: bool = True, root: str = "", provider: str = "local", model_name: str = "stub-v1",
) -> Report:
    """The report of the sessions whose last message is on ``date`` in ``zone`` (of all sessions without a zone)."""
    spark = messages.sparkSession
    window = None
    found = sessions.summarize(messages, headers)
    if zone:
        start, end = numbers.day_window(F.lit(date.isoformat()), zone)
        iso = "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"
        window = tuple(spark.range(1).select(F.date_format(start, iso), F.date_format(end, iso)).first())
        found = transcripts.latest_of_each(transcripts.in_window(found, start, end))
    # each of these tables is read by several of the next
    found = materialize(transcripts.first_files(found, limit).withColumn("target_date", F.lit(date.isoformat())), "sessions")
    scanned = transcripts.files_scanned(headers, found, limit)
    mine = messages.join(found.select("session_id"), "session_id", "left_semi")
    found = projects.attach(found, projects.infer(found, mine, catalogue if catalogue is not None else projects.empty_catalogue(spark)))
    scored = materialize(scoring.heuristic(materialize(found, "hinted"), lexicon), "scored")
    if model is not None:
        scored = scoring.with_model(scored, scoring.check_answers(providers.score(scored, mine, model)))
    made = materialize(candidates.extract(scored, lexicon), "candidates")
    final = materialize(candidates.effective_decisions(scored, made), "decided")
    clock = F.lit(date.isoformat()).cast("timestamp")
    promoted = materialize(promotions.promote(made, clock, root), "promotions")
    rows = embeddings.payloads(made, promoted)
    docs = embeddings.documents(rows, provider, model_name)
    vectors = providers.embed(rows, embed) if embed else spark.createDataFrame([], "source_key string, vector array<float>")
    kept = {"jobs": archive.job_rows(final, F.lit(date.isoformat())), "sessions": archive.session_rows(final, F.lit(date.isoformat())), "projects": projects.project_rows(final)}
    kept["session_projects"] = archive.session_project_rows(final, kept["sessions"], kept["projects"])
    kept["messages"] = archive.message_rows(mine, kept["sessions"])
    kept["candidates"] = archive.candidate_rows(made, kept["sessions"])
    kept["candidate_projects"] = archive.candidate_project_rows(made, kept["sessions"], kept["candidates"], kept["projects"])
    kept["promotions"] = archive.promotion_rows(promoted, kept["sessions"], kept["candidates"])
    return Report(final, mine, made, promoted, retention.purge_plan(final, purge), rows, docs, embeddings.embedding_rows(docs, vectors), kept, scanned, window)


#: Report tables, by date.
REPORT = ("sessions", "candidates", "promotions", "purge", "payloads")


def write(report: Report, out: str, date: dt.date) -> dict:
    """The archive first, by key, then the report's tables, by date; what came of it.

    Of the archive, rows with the keys of an earlier night take their place.  A
    rerun leaves the same rows in either.
    """
    tables = {**report.archive, "embedding_documents": report.documents, "embeddings": report.embeddings}
    tables = {name: materialize(rows, name) for name, rows in tables.items()}
    for name, rows in tables.items():
        archive.store(name, rows, f"{out}/archive")
    for name in REPORT:
        getattr(report, name).write.mode("overwrite").parquet(f"{out}/report/{name}/target_date={date.isoformat()}")
    kept = {name: archive.returned(name, rows, f"{out}/archive") for name, rows in tables.items()}
    audit = {r["table"]: {"requested": r["rows_requested"], "returned": r["rows_returned"]} for r in archive.audit(tables, kept).collect()}
    parents = {n: kept[n] for n in ("sessions", "projects")}
    broken = [r.asDict() for name in tables for r in archive.violations(name, kept[name], parents).collect()]
    return {"archive": audit, "violations": broken}


def read_report(spark: SparkSession, out: str, date: str) -> dict[str, DataFrame]:
    """The tables of a stored report."""
    return {name: spark.read.parquet(f"{out}/report/{name}/target_date={date}") for name in REPORT}


def pick_scorer(conf: settings.Settings) -> providers.Score | None:
    """The model that scores sessions, or None for the heuristic alone."""
    if conf.scorer != "llm":
        return None
    if not (conf.scorer_key and conf.scorer_url):
        print("no key or address for the scoring model: the heuristic scores", file=sys.stderr)
        return None
    return providers.HttpScorer(conf.scorer_url, conf.scorer_key)


def pick_embedder(conf: settings.Settings) -> providers.Embed | None:
    if conf.provider == "local":
        return providers.local_embed
    return providers.HttpEmbedder(conf.embed_url, conf.scorer_key) if conf.embed_url and conf.scorer_key else None


def main(argv: list[str] | None = None) -> int:
    """``python -m mnemon.plans.nightly --sessions DIR --out DIR [--date D] [--scorer llm] [--env-file F] ...``"""
    try:
        conf = settings.Settings.load(sys.argv[1:] if argv is None else argv)
        spark = SparkSession.builder.appName("nightly").config("spark.sql.session.timeZone", "UTC").getOrCreate()
        date = numbers.target_day(conf.date, dt.datetime.now(dt.timezone.utc).date())
        headers, messages = transcripts.parse_sessions(transcripts.read_lines(spark, conf.sessions))
        known = spark.createDataFrame(conf.known_projects, projects.CATALOGUE) if conf.known_projects else None
        report = build(
            headers, messages, date, conf.time_zone, catalogue=known, limit=conf.limit, model=pick_scorer(conf), purge=conf.purge_plan, root=conf.memory_root,
            embed=pick_embedder(conf), provider=conf.provider, model_name=conf.model,
        )
        done: dict = {}
        if not conf.dry_run:
            promotions.bootstrap(conf.memory_root, dry_run=False)
            done = write(report, conf.out, date)
            if conf.write_promotions:
                stamp = int(dt.datetime.now().timestamp() * 1000)
                for p in report.promotions.orderBy("target_file", "entry_slug").toLocalIterator():  # the few entries of one day
                    promotions.write_entry(p["target_file"], p["target_section"], p["entry_slug"], p["content_markdown"], conf.memory_root, stamp)
        print(json.dumps({"ok": True, **report.summary("dry-run" if conf.dry_run else "write-ready", date, conf.time_zone), **done}))
        return 0
    except Exception as error:
        print(json.dumps({"ok": False, "error": str(error)}), file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
