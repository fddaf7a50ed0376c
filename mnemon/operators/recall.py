"""Ranked recall: metadata, words in common and vectors, with the reasons."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from mnemon.functions import numbers, text
from mnemon.operators import embeddings, projects

#: Vector scores up to this count as none.
LEAST_SIMILARITY = 0.1


def corpus(candidates: DataFrame, promotions: DataFrame) -> DataFrame:
    """Candidates that aren't rejected and all promotions, as (ref, source_type, title, content, project, kind, confidence, session_id)."""
    link = F.coalesce("primary_project", F.try_element_at("project_hints", F.lit(1))["slug"]) if "project_hints" in candidates.columns else F.col("primary_project")
    a = candidates.where("decision <> 'reject'").select(
        F.concat(F.lit("candidate:"), "content_fingerprint").alias("ref"), F.lit("candidate").alias("source_type"), "title",
        text.normalize(F.concat_ws("\n", "title", "summary", F.coalesce("summary_short", F.lit("")))).alias("content"), link.alias("project"), "kind",
        F.coalesce(F.col("confidence_score").cast("double"), F.lit(0.0)).alias("confidence"), F.coalesce(F.col("importance_score").cast("long"), F.lit(0)).alias("importance"), "session_id",
    )
    b = promotions.select(
        F.concat(F.lit("promotion:"), "entry_slug").alias("ref"), F.lit("promotion").alias("source_type"), "title",
        text.normalize(F.concat_ws("\n", "title", F.coalesce("content_markdown", F.lit("")))).alias("content"), embeddings.project_of_file(F.col("target_file")).alias("project"), "kind",
        F.lit(1.0).alias("confidence"), F.lit(100).cast("long").alias("importance"), "session_id",
    )
    return a.unionByName(b)


def score(items: DataFrame, tokens: Column, hints: Column) -> DataFrame:
    """Items with metadata_score, keyword_score, total_score and the reasons ``why``.

    ``tokens`` are the query's and ``hints`` its projects, both arrays.
    """
    overlap = F.array_intersect(F.array_distinct(tokens), text.recall_tokens(F.col("content")))
    match = F.col("project").isNotNull() & F.array_contains(hints, F.coalesce("project", F.lit("")))
    mismatch = ~match & (F.size(hints) > 0) & F.col("project").isNotNull()
    stable = F.col("kind").isin("operation_rule", "user_preference")
    points = lambda c, n: F.when(c, F.lit(n)).otherwise(F.lit(0))
    metadata = points(match, 40) + points(mismatch, -10) + points(F.col("source_type") == "promotion", 20) + points(stable, 10) + numbers.half_up(F.col("confidence") * 10)
    why = F.array(
        F.when(match, F.concat(F.lit("project_match:"), "project")), F.when(mismatch, F.concat(F.lit("project_mismatch:"), "project")),
        F.when(F.col("source_type") == "promotion", "promoted_memory_boost"), F.when(stable, F.concat(F.lit("stable_kind:"), "kind")),
        F.when(F.size("overlap") > 0, F.concat(F.lit("keyword_overlap:"), F.array_join("overlap", ","))),
    )
    # generated, not selected: the filter on the total isn't pushed below it, which would split each text once more
    rows = items.select("*", F.explode(F.array(overlap)).alias("overlap"))
    rows = rows.withColumns({"metadata_score": metadata.cast("long"), "keyword_score": F.least(F.lit(60), 12 * F.size("overlap")).cast("long"), "why": F.filter(why, lambda x: x.isNotNull())})
    rows = rows.withColumn("total_score", F.greatest(F.lit(0), F.col("metadata_score") + F.col("keyword_score")))
    return rows.where("total_score > 0")


def vector_top_k(vectors: DataFrame, query: Column, k: int) -> DataFrame:
    """(ref, vector_score, rank_hint): the k nearest by cosine, to three places, above LEAST_SIMILARITY.

    ``vectors`` has (ref, vector); ties go by ref.
    """
    near = numbers.half_up(numbers.cosine(F.col("vector"), query) * 1000) / 1000
    top = vectors.select("ref", near.alias("vector_score")).where(F.col("vector_score") > LEAST_SIMILARITY).orderBy(F.desc("vector_score"), "ref").limit(k)
    return top.withColumn("rank_hint", F.row_number().over(Window.orderBy(F.desc("vector_score"), "ref")))  # k rows


def merge(keyword: DataFrame, semantic: DataFrame, k: int | None) -> DataFrame:
    """Both scores of each item: metadata plus the better of words and vector; items of vectors alone join in.

    ``semantic`` may have title, project and kind too, for items that no word found.
    """
    told = [c for c in ("title", "project", "kind") if c in semantic.columns]
    both = keyword.join(semantic.select("ref", "vector_score", *(F.col(c).alias(f"_{c}") for c in told)), "ref", "full_outer")
    for c in told:
        both = both.withColumn(c, F.coalesce(c, f"_{c}")).drop(f"_{c}")
    semantic_score = F.coalesce(numbers.half_up(F.col("vector_score") * 100), F.lit(0)).cast("long")
    alone = F.col("metadata_score").isNull()
    shown = F.format_string("%.3f", "vector_score")
    why = F.when(alone, F.array(F.concat(F.lit("semantic_only:"), shown))).when(
        F.col("vector_score").isNotNull(), F.concat(F.col("why"), F.array(F.concat(F.lit("semantic_similarity:"), shown)))
    ).otherwise(F.col("why"))
    total = F.greatest(F.lit(0), F.coalesce("metadata_score", F.lit(0)) + F.greatest(F.coalesce("keyword_score", F.lit(0)), semantic_score))
    rows = both.select(
        "ref", F.coalesce("source_type", F.regexp_extract("ref", "^([^:]*):", 1)).alias("source_type"), F.coalesce("title", F.regexp_extract("ref", "^[^:]*:(.*)$", 1)).alias("title"),
        "project", "kind", "content", F.coalesce("metadata_score", F.lit(0)).alias("metadata_score"), F.coalesce("keyword_score", F.lit(0)).alias("keyword_score"),
        semantic_score.alias("semantic_score"), total.alias("total_score"), why.alias("why"),
        F.struct(F.coalesce("overlap", F.array().cast("array<string>")).alias("matched_tokens"), F.col("vector_score"), alone.alias("semantic_only")).alias("audit"),
    )
    if k is None:
        return rows
    return rows.orderBy(F.desc("total_score"), F.desc("semantic_score"), F.collate("ref", "UNICODE")).limit(k)


@dataclass
class Provider:
    """How vectors come in: ``stub`` seeds from the best-ranked items, ``vectors`` ranks by cosine."""

    name: str = "stub"
    vectors: DataFrame | None = None
    query_vector: list[float] | None = None


@dataclass
class Recall:
    """A query's answer: items, what was understood, and how they were found."""

    items: DataFrame | None
    query: str
    normalized: str
    project_hints: list[str] = field(default_factory=list)
    status: str = "skipped"
    seeds: DataFrame | None = None
    steps: list[str] = field(default_factory=list)

    def trace(self) -> dict:
        """How the items were found: steps, what the scores are of, and the filters."""
        found = self.status == "ok"
        scoring = ["metadata (project, kind, source)", "words in common (title, summary, content)"]
        scoring += ["cosine of query and item vectors", "metadata + the larger of words and vectors"] if found else ["no vectors: ranked by words"]
        return {"steps": self.steps, "scoring": scoring, "filters": {"projects": self.project_hints, "least_total": 1, "least_similarity": LEAST_SIMILARITY if found else None}, "status": self.status}


def recall(query: str, candidates: DataFrame, promotions: DataFrame, k: int = 5, catalogue: DataFrame | None = None, provider: Provider | None = None) -> Recall:
    """The k best items for a query.  The stub's seeds are taken after ranking."""
    spark = candidates.sparkSession
    row = spark.createDataFrame([("q", query or "")], "session_id string, text string").select("session_id", text.normalize(F.col("text")).alias("text"))
    plain = row.first()["text"]
    if not plain:
        return Recall(None, query, "", steps=["empty_query"])
    one = row.select("session_id", F.col("text").alias("sample_user_text"), F.lit("").alias("file_name"), F.lit(None).cast("string").alias("cwd"))
    said = row.select("session_id", F.lit(1).alias("seq_no"), F.lit("user").alias("role"), "text")
    found = projects.infer(one, said, catalogue if catalogue is not None else projects.empty_catalogue(spark))
    hints = [r["slug"] for r in found.orderBy("rank").collect()]  # of one query
    tokens = text.recall_tokens(F.lit(plain))
    ranked = score(corpus(candidates, promotions), tokens, F.array(*map(F.lit, hints)) if hints else F.array().cast("array<string>"))
    steps = ["project_detection", "metadata_filter", "keyword_overlap", "score_and_rank"]
    ref = F.concat_ws(":", "object_type", "object_id")
    ready = embeddings.payloads(candidates, promotions).select(ref.alias("ref"))
    none = spark.createDataFrame([], "ref string, vector_score double")
    provider = provider or Provider()
    if provider.name == "stub":
        best = merge(ranked, none, k)
        seeds = best.join(ready, "ref", "left_semi").withColumn("reason", F.lit("lexical_rank_seed"))
        return Recall(best, query, plain, hints, "stub", seeds, [*steps, "semantic_slot_reserved"])
    if provider.name != "vectors":
        return Recall(merge(ranked, none, k), query, plain, hints, "unavailable", None, [*steps, "semantic_slot_reserved"])
    if provider.vectors is None or provider.query_vector is None:
        return Recall(merge(ranked, none, k), query, plain, hints, "error", None, [*steps, "semantic_slot_reserved"])
    if ready.isEmpty():
        return Recall(merge(ranked, none, k), query, plain, hints, "empty_corpus", None, [*steps, "semantic_slot_reserved"])
    near = vector_top_k(provider.vectors.join(ready, "ref", "left_semi"), F.array(*(F.lit(float(x)) for x in provider.query_vector)), k)
    items = corpus(candidates, promotions).groupBy("ref").agg(*(F.min(c).alias(c) for c in ("title", "project", "kind")))
    near = near.join(items, "ref", "left")
    return Recall(merge(ranked, near, k), query, plain, hints, "ok", near, [*steps, "semantic_embedding", "cosine_similarity", "score_merge"])


#: Counts (rows times queries) that a worker holds at once.
COUNTS = 1 << 16


def batch_overlap(corpus_rows: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, ref, overlap, rank): for many queries, by an inverted index instead of a comparison of all.

    ``queries`` has (query_id, text); the k best by distinct words in common, ties by ref.  The queries' words
    go to every worker, so these must fit into one.  Of the corpus only the words that are asked for are
    shuffled, as numbers; rows of one ref meet there in order, are counted some at a time, and a task hands
    on k a query.  So no task holds its pairs of queries and refs.
    """
    spark = corpus_rows.sparkSession
    asked = queries.select("query_id", F.array_distinct(text.recall_tokens(F.col("text"))).alias("tokens")).toArrow()
    ids = asked["query_id"].combine_chunks()
    names = ids.unique()
    query_of = pc.index_in(ids, names).to_numpy(zero_copy_only=False)
    lists = asked["tokens"].combine_chunks()
    flat = lists.flatten()
    words = flat.unique()
    # by word: the queries that have it, each as often as its rows do
    word, who = pc.index_in(flat, words).to_numpy(zero_copy_only=False), query_of[pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)]
    by_word = who[np.argsort(word, kind="stable")].astype("int64")
    starts = np.concatenate([[0], np.cumsum(np.bincount(word.astype("int64"), minlength=len(words)))]).astype("int64")
    named = spark.createDataFrame(pa.table({"_q": pa.array(range(len(names)), "int32"), "query_id": names}), T.StructType([T.StructField("_q", T.IntegerType()), queries.schema["query_id"]]))

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tokens = b.column(1)
            code = pc.index_in(tokens.flatten(), words)
            known = pc.is_valid(code)
            row = pc.list_parent_indices(tokens).filter(known).to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(tokens)))]).astype("int32")
            found = pa.ListArray.from_arrays(pa.array(ends), code.filter(known))
            some = pa.array(np.diff(ends) > 0)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(some), found.filter(some)], ["ref", "codes"])

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, step = len(names), max(1, COUNTS // max(1, len(names)))
        kept = (np.empty(0, "int64"), np.empty(0, "int64"), np.empty(0, object))  # query, overlap, ref, in order of refs
        least = np.zeros(n, "int64")  # a query's k-th overlap
        last, open_counts = None, None  # the ref that may go on in the next rows

        def take(refs: np.ndarray, counts: np.ndarray) -> None:
            nonlocal kept
            at, q = np.nonzero(counts > least)  # later refs lose ties
            if not len(at):
                return
            q, c, r = (np.concatenate(x) for x in zip(kept, (q, counts[at, q], refs[at])))
            order = np.lexsort((np.arange(len(q)), -c, q))
            q, c, r = q[order], c[order], r[order]
            place = np.arange(len(q)) - np.searchsorted(q, q)
            least[q[place == k - 1]] = c[place == k - 1]
            kept = (q[place < k], c[place < k], r[place < k])

        for b in batches:
            refs, codes = np.array(b.column(0).to_pylist(), object), b.column(1)
            for at in range(0, len(refs), step):
                part, lists = refs[at : at + step], codes.slice(at, step)
                new = np.concatenate([[True], part[1:] != part[:-1]])
                run = np.cumsum(new) - 1
                code = lists.flatten().to_numpy(zero_copy_only=False).astype("int64")
                row = run[pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)]
                often = starts[code + 1] - starts[code]
                entry = np.repeat(starts[code] - np.cumsum(often) + often, often) + np.arange(often.sum())
                counts = np.bincount(np.repeat(row, often) * n + by_word[entry], minlength=(run[-1] + 1) * n).reshape(-1, n)
                whole = part[new]
                if open_counts is not None:
                    if whole[0] == last:
                        counts[0] += open_counts
                    else:
                        take(np.array([last], object), open_counts[None])
                take(whole[:-1], counts[:-1])
                last, open_counts = whole[-1], counts[-1]
        if open_counts is not None:
            take(np.array([last], object), open_counts[None])
        yield pa.RecordBatch.from_arrays([pa.array(kept[0], "int32"), pa.array(kept[2].tolist(), "string"), pa.array(kept[1], "int64")], ["_q", "ref", "overlap"])

    found = corpus_rows.select("ref", F.array_distinct(text.recall_tokens(F.col("content"))).alias("tokens")).mapInArrow(numbered, "ref string, codes array<int>")
    pairs = found.repartition("ref").sortWithinPartitions("ref").mapInArrow(best, "_q int, ref string, overlap long")
    order = Window.partitionBy("_q").orderBy(F.desc("overlap"), "ref")
    top = pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return top.join(F.broadcast(named), "_q").select("query_id", "ref", "overlap", "rank")
