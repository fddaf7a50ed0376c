"""Where models come in: embeddings and session scores, by batches on executors."""

from __future__ import annotations

import hashlib
import json
import re
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Texts in a request, and characters of a text.
BATCH, CHARACTERS = 100, 8000

Embed = Callable[[list[str]], list[list[float]]]
Score = Callable[[list[str]], list[str]]


def local_embed(texts: list[str], dimensions: int = 64) -> list[list[float]]:
    """A deterministic stand-in for a model: hashed words, of length one."""
    out = []
    for t in texts:
        v = np.zeros(dimensions)
        for word in t.lower().split():
            h = int.from_bytes(hashlib.sha1(word.encode()).digest()[:8], "big")
            v[h % dimensions] += 1 if h >> 63 else -1
        n = np.linalg.norm(v)
        out.append((v / n if n else v).astype(float).tolist())
    return out


def embed(rows: DataFrame, model: Embed = local_embed, key: str = "object_id", text: str = "text") -> DataFrame:
    """(source_key, vector) of each text, in requests of BATCH texts cut at CHARACTERS."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for low in range(0, len(f), BATCH):
                part = f.iloc[low : low + BATCH]
                yield pd.DataFrame({"source_key": part["k"].to_numpy(), "vector": model(part["t"].tolist())})

    return rows.select(F.trim(key).alias("k"), F.left(F.col(text), F.lit(CHARACTERS)).alias("t")).mapInPandas(run, "source_key string, vector array<float>")


#: Characters of the user's and of the others' texts in a prompt.
USER_CHARACTERS, OTHER_CHARACTERS = 4000, 2000


PROMPT = """Judge whether this session is worth keeping as long-term memory.
Count for it: an explicit request to remember, a lasting decision, a preference or rule of the user's, concrete next steps.
Count against it: scheduled runs, debugging of the moment, small talk.
importanceScore is 0 to 100; importanceBand is critical from 75, high from 50, medium from 25, else low;
promotionDecision is promote from 60, defer from 35, archive_only from 15, else reject;
candidateKinds are any of user_preference, project_state, operation_rule, decision, todo, relationship, fact.
Answer with one JSON object only: {"importanceScore": 0, "importanceBand": "low", "promotionDecision": "reject", "candidateKinds": ["fact"],
"summary": "one line", "reasoning": "two or three sentences", "signals": {"explicitMemoryRequest": false, "longTermDecision": false, "userPreference": false,
"operationRule": false, "actionableFollowup": false, "automationSession": false, "temporaryContext": false, "novelContent": false}}"""


def score(sessions: DataFrame, messages: DataFrame, model: Score) -> DataFrame:
    """(session_id, answer, error): a model's JSON for each session, or what went wrong."""
    said = messages.groupBy("session_id").agg(F.sort_array(F.collect_list(F.struct("seq_no", "role", "text"))).alias("m"))
    part = lambda mine, n: F.left(F.array_join(F.transform(F.filter("m", mine), lambda x: x["text"]), "\n"), F.lit(n))
    prompts = said.select(
        "session_id",
        F.concat(F.lit(PROMPT), F.lit("\nUser:\n"), part(lambda x: x["role"] == "user", USER_CHARACTERS), F.lit("\nOthers:\n"), part(lambda x: x["role"] == "assistant", OTHER_CHARACTERS)).alias("prompt"),
    )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            answers, errors = [], []
            for p in f["prompt"]:
                try:
                    answers.append(model([p])[0])
                    errors.append(None)
                except Exception as error:  # a failed call falls back to the heuristic, which tells why
                    answers.append(None)
                    errors.append(str(error) or type(error).__name__)
            yield pd.DataFrame({"session_id": f["session_id"], "answer": answers, "error": errors})

    return sessions.select("session_id").join(prompts, "session_id").mapInPandas(run, "session_id string, answer string, error string")


#: Seconds that a request for a score or for vectors may take.
SCORE_SECONDS, EMBED_SECONDS = 15, 30


def _post(url: str, body: dict, seconds: float) -> dict:
    request = urllib.request.Request(url, json.dumps(body).encode(), {"Content-Type": "application/json"})
    try:
        with urllib.request.urlopen(request, timeout=seconds) as response:
            return json.loads(response.read())
    except urllib.error.HTTPError as error:
        text = re.sub(r"(?i)key=[^&\s\"']+", "key=REDACTED", error.read().decode(errors="replace"))
        raise RuntimeError(f"model answered {error.code}: {text[:200]}") from None


@dataclass(frozen=True)
class HttpScorer:
    """A scoring model behind HTTP: POST of {contents: [{parts: [{text}]}]}, an answer in candidates[0].content.parts[0].text."""

    url: str
    key: str
    seconds: float = SCORE_SECONDS

    def __call__(self, prompts: list[str]) -> list[str]:
        out = []
        for prompt in prompts:
            body = {"contents": [{"parts": [{"text": prompt}]}], "generationConfig": {"responseMimeType": "application/json", "temperature": 0.1, "maxOutputTokens": 1024}}
            found = _post(f"{self.url}?key={self.key}", body, self.seconds)
            try:
                out.append(found["candidates"][0]["content"]["parts"][0]["text"])
            except (KeyError, IndexError, TypeError):
                raise RuntimeError("empty answer") from None
        return out


@dataclass(frozen=True)
class HttpEmbedder:
    """An embedding model behind HTTP: POST of {requests: [{content: {parts: [{text}]}}]}, vectors in embeddings[].values."""

    url: str
    key: str
    seconds: float = EMBED_SECONDS

    def __call__(self, texts: list[str]) -> list[list[float]]:
        found = _post(f"{self.url}?key={self.key}", {"requests": [{"content": {"parts": [{"text": t}]}} for t in texts]}, self.seconds)
        vectors = [e.get("values") or [] for e in found.get("embeddings", [])]
        if len(vectors) != len(texts):
            raise RuntimeError(f"{len(vectors)} vectors for {len(texts)} texts")
        return vectors
