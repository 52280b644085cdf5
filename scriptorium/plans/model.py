"""Pluggable models: a client protocol, recorded answers, retries, caches with an age, and the staged conversion."""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.markup import markdown_fence, outer_fence
from ..functions.script import DEVANAGARI, script_text
from ..operators.align import repair_if_better
from ..operators.chunk import all_present, ordered_merge, page_ranges, plan_chunks


class Client(Protocol):
    """Anything that answers a prompt; must be picklable, as tasks use it."""

    def generate(self, prompt: str) -> str: ...


class NoClient:
    """Stands in where no model can be reached."""

    def generate(self, prompt: str) -> str:
        raise RuntimeError("no model is configured")


def with_retry(call: Callable[[], str], attempts: int = 3, first_delay: float = 2.0, sleep: Callable[[float], None] = time.sleep) -> str:
    """``call``'s answer; failures are repeated, each after twice the delay; the last one is raised, and a quota's at once."""
    for n in range(attempts):
        try:
            return call()
        except QuotaExceeded:
            raise
        except Exception:
            if n + 1 == attempts:
                raise
            sleep(first_delay * 2**n)
    raise ValueError("attempts count from 1")


class QuotaExceeded(Exception):
    """Raised by a client when further calls are pointless."""


def _answers(prompts: list[str | None], client: Client, attempts: int, first_delay: float, concurrent: int, stopped: threading.Event) -> list[tuple[str | None, str | None]]:
    """(answer, error) of each prompt, ``concurrent`` at a time; none is asked any more once one has met a quota."""

    def one(prompt: str | None) -> tuple[str | None, str | None]:
        if prompt is None:
            return None, "no prompt"
        if stopped.is_set():
            return None, NOT_ASKED
        try:
            answer = with_retry(lambda: client.generate(prompt), attempts, first_delay)
            return answer or None, None if answer else "empty answer"
        except QuotaExceeded as e:
            stopped.set()
            return None, f"QuotaExceeded: {e}"
        except Exception as e:  # one failure is one row's, not the job's
            return None, f"{type(e).__name__}: {e}"

    if concurrent == 1:
        return [one(p) for p in prompts]
    with ThreadPoolExecutor(concurrent) as pool:
        return list(pool.map(one, prompts))


#: The error of prompts that a quota left unasked.
NOT_ASKED = "not asked: the quota is used up"


def generated(prompts: DataFrame, client: Client, keys: list[str], prompt: str = "prompt", attempts: int = 3, first_delay: float = 2.0, concurrent: int = 1) -> DataFrame:
    """(keys, response, error): the model's answer to each prompt; an empty answer or a failure is an error.

    Each task asks ``concurrent`` prompts at a time.  A client that raises ``QuotaExceeded`` is not tried again, and the task's
    further prompts are not asked (``NOT_ASKED``).
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in prompts.select(*keys).schema) + ", response string, error string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        stopped = threading.Event()
        for batch in batches:
            found = _answers([None if p is None or p != p else p for p in batch[prompt]], client, attempts, first_delay, concurrent, stopped)
            yield batch[keys].assign(response=[a for a, _ in found], error=[e for _, e in found])

    return prompts.select(*keys, prompt).mapInPandas(run, schema)


def answered(prompts: DataFrame, client: Client, keys: list[str], path: str, rounds: int = 8, prompt: str = "prompt", attempts: int = 3, first_delay: float = 2.0, concurrent: int = 4) -> DataFrame:
    """(keys, response): answers that are recorded at ``path``, after asking for those that are not.

    Prompts are dealt into ``rounds`` by a hash of their keys.  A round asks for what has no recorded answer, and its answers are committed
    before the next begins, so a job that dies asks again only what its last round had not committed: calls of committed rounds are never made
    twice, and a task that dies repeats its own part of one round.  Take more rounds to lose less.  After a round that met a quota no
    further one begins; the next call of this function goes on where this one ended.  Failures are recorded beside the answers, and asked again by
    the next call.  Keys must not be null.
    """
    spark = prompts.sparkSession
    types = prompts.select(*keys).schema
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in types) + ", response string, error string"
    recorded = f"{path.rstrip('/')}/answers"
    spark.createDataFrame([], schema).write.mode("append").parquet(f"{recorded}/round=start")
    answers = lambda: spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(recorded).where("response IS NOT NULL")
    turn = F.pmod(F.xxhash64(*keys), F.lit(rounds))
    for n in range(rounds):
        todo = prompts.where(turn == n).join(answers().select(*keys), keys, "left_anti")
        here = f"{recorded}/round={uuid.uuid4().hex}"
        generated(todo, client, keys, prompt, attempts, first_delay, concurrent).write.parquet(here)
        if not spark.read.schema(schema).parquet(here).where(F.col("error").startswith("QuotaExceeded")).isEmpty():
            break
    return answers().dropDuplicates(keys).select(*keys, "response")


#: Hours after which an upload is checked, and is gone.
CHECK_AFTER, GONE_AFTER = 46.0, 48.0


def age_hours(now: Column, then: Column) -> Column:
    return (F.unix_micros(now) - F.unix_micros(then)) / F.lit(3.6e9)


def cache_state(now: Column, uploaded_at: Column) -> Column:
    """fresh under 46 hours, validate under 48, else expired; also expired if there is no readable time."""
    age = age_hours(now, uploaded_at)
    return F.when(age < CHECK_AFTER, "fresh").when(age < GONE_AFTER, "validate").otherwise("expired")


def cleaned_cache(cache: DataFrame, now: Column, uploaded_at: str = "uploaded_at") -> DataFrame:
    """Cache rows that are not expired."""
    return cache.where(cache_state(now, F.col(uploaded_at).try_cast("timestamp")) != "expired")


def analysis_key(path: Column) -> Column:
    """File stem, and eight digits of the path's SHA-256."""
    stem = F.regexp_replace(F.element_at(F.split(path, "/"), -1), "\\.[^.]*$", "")
    return F.concat(stem, F.lit("_"), F.left(F.sha2(path, 256), F.lit(8)))


def cached_analyses(files: DataFrame, cache: DataFrame) -> DataFrame:
    """Files (path, file_hash) with their analysis: null unless the stored hash is the file's and it is valid JSON."""
    known = cache.select("cache_key", F.col("file_hash"), "analysis").where(F.try_parse_json("analysis").isNotNull())
    return files.withColumn("cache_key", analysis_key(F.col("path"))).join(known, ["cache_key", "file_hash"], "left")


def converted(chunks: DataFrame, responses: DataFrame, key: str = "doc_id", chars: str = DEVANAGARI) -> DataFrame:
    """(key, body, n_chunks, status) from chunks (key, chunk, content) and answers (key, chunk, response).

    Every answer loses its fences and must keep the chunk's words; a document with a missing or altered
    answer is "failed" and has no body, others are not affected.
    """
    rows = chunks.join(responses.select(key, "chunk", "response"), [key, "chunk"], "left").withColumn("answer", outer_fence(F.col("response")))
    same = script_text(F.col("content"), chars) == script_text(F.col("answer"), chars)
    checked = rows.withColumn("ok", F.coalesce(same, F.lit(False)))
    state = checked.groupBy(key).agg(F.bool_and("ok").alias("ok"))
    merged = ordered_merge(checked.select(key, "chunk", F.col("answer").alias("content")), key)
    return merged.join(state, key).select(key, F.when(F.col("ok") & F.col("complete"), F.col("body")).alias("body"), "n_chunks", F.when(F.col("ok") & F.col("complete"), "ok").otherwise("failed").alias("status"))


def convert_documents(docs: DataFrame, plans: DataFrame, client: Client, instruction: str, key: str = "doc_id", chars: str = DEVANAGARI, word_chars: str = "ऀ-ॿ", attempts: int = 3, first_delay: float = 2.0) -> DataFrame:
    """(key, body, n_chunks, status) of documents (key, text) converted by a model, chunk by chunk.

    ``plans``: (key, plan), each an array of (chunk_id, start_marker, end_marker) from the analysis; a document without one
    is a single chunk.  Every chunk's answer loses its fences; where its words are not the chunk's they are repaired, if that
    leaves fewer differences; a document with a failed, missing or still altered chunk is "failed" and has no body.
    """
    whole = F.array(F.struct(F.lit(0).alias("chunk_id"), F.lit("").alias("start_marker"), F.lit("").alias("end_marker")))
    planned = docs.select(key, "text").join(plans.select(key, "plan"), key, "left")
    pieces = F.when(F.col("plan").isNull() | (F.size("plan") == 0), F.array("text")).otherwise(plan_chunks(F.col("text"), F.coalesce("plan", whole.cast(dict(plans.dtypes)["plan"]))))
    chunks = planned.select(key, F.posexplode(pieces).alias("chunk", "content"))
    prompts = chunks.withColumn("prompt", F.concat(F.lit(instruction), F.lit("\n\n"), F.col("content")))
    answers = generated(prompts, client, [key, "chunk"], attempts=attempts, first_delay=first_delay)
    pairs = chunks.join(answers, [key, "chunk"], "left").select(key, "chunk", F.col("content").alias("source_text"), outer_fence(F.col("response")).alias("output_text"))
    repaired = repair_if_better(pairs, word_chars, script=chars)
    return converted(chunks, repaired.select(key, "chunk", F.col("final").alias("response")), key, chars)


def read_pages(files: DataFrame, client: Client, instruction: str, size: int, step: int, key: str = "path", pages: str = "n_pages", attempts: int = 3, first_delay: float = 2.0) -> DataFrame:
    """(key, body, n_chunks) of scanned files read by a model, a page range at a time; only files of which every range was read.

    The prompt names file and range; getting the pages out of the file is the client's part.
    """
    ranges = page_ranges(files, size, step, key, pages)
    named = F.concat(F.lit(instruction), F.lit("\n"), F.col(key).cast("string"), F.lit(" "), F.col("first").cast("string"), F.lit("-"), F.col("until").cast("string"))
    answers = generated(ranges.withColumn("prompt", named), client, [key, "chunk"], attempts=attempts, first_delay=first_delay)
    read = answers.where("response IS NOT NULL").select(key, "chunk", markdown_fence(F.col("response")).alias("content"))
    whole = all_present(ranges.select(key, "chunk"), read, key)
    return ordered_merge(read.join(whole, key), key).select(key, "body", "n_chunks")
