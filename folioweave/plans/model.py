"""The external model stage (L1-L13): prompts, providers, retries, replay and the salvage of JSON.

A stage is one map over (paper_id, stage, prompt). The provider is a parameter: ``Replay`` answers from
stored results keyed by the prompt's digest, so a task that is run again gives the same rows; ``Fake``
computes an answer. Real clients implement the same call. Answers carry their usage columns.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from hashlib import sha256

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CANDIDATES = 16
OUT_SCHEMA = "paper_id string, stage string, answer string, error string, calls int, prompt bigint, cached bigint, completion bigint, truncated boolean"


class Truncated(Exception):
    """The answer was cut short; asking again would cut it again."""


def fill(template: str, **values: str) -> str:
    """``{{name}}`` replaced by its value."""
    return re.sub(r"\{\{(\w+)\}\}", lambda m: values.get(m[1], m[0]), template)


def fenced(markdown: str, last: bool = False) -> str:
    """The first or last fenced block of a prompt file."""
    found = re.findall(r"(?ms)^```[^\n]*\n(.*?)^```", markdown)
    return (found[-1] if last else found[0]).strip() if found else markdown.strip()


def shared_prefix(paper: str, nodes_json: str, module: str) -> str:
    """The part that all sections of a paper share comes first, so that it can be cached."""
    return f"PAPER\n{paper}\n\nNODES\n{nodes_json}\n\nTASK\n{module}"


def _objects(text: str) -> Iterator[str]:
    """Balanced {...} spans, longest first place first; strings are skipped."""
    for n, m in enumerate(re.finditer(r"\{", text)):
        if n >= CANDIDATES:
            return
        depth, quoted, i = 0, False, m.start()
        while i < len(text):
            c = text[i]
            if quoted:
                i += c == "\\"
                quoted = c != '"'
            elif c == '"':
                quoted = True
            else:
                depth += (c == "{") - (c == "}")
                if not depth:
                    yield text[m.start() : i + 1]
                    break
            i += 1


def salvage_json(text: str | None) -> dict | None:
    """The first JSON object in a model's answer: without thoughts and fences, stray backslashes repaired."""
    text = re.sub(r"(?s)<think>.*?</think>", "", text or "")
    fence = re.search(r"(?s)```(?:json)?\s*\n(.*?)```", text)
    for body in ([fence[1]] if fence else []) + [text]:
        for span in [body.strip(), *_objects(body)]:
            for attempt in (span, re.sub(r'\\(?!["\\/bfnrtu])', r"\\\\", span)):
                try:
                    value = json.loads(attempt)
                except ValueError:
                    continue
                if isinstance(value, dict):
                    return value
    return None


def digest(stage: str, prompt: str) -> str:
    return sha256(f"{stage}\0{prompt}".encode()).hexdigest()


@dataclass
class Replay:
    """Answers from a table of stored ones (digest -> text); a bounded set of fixtures for tests and replays."""

    stored: dict[str, str]

    def __call__(self, stage: str, prompt: str) -> tuple[str, dict]:
        return self.stored[digest(stage, prompt)], {}


@dataclass
class Fake:
    answer: Callable[[str, str], str]

    def __call__(self, stage: str, prompt: str) -> tuple[str, dict]:
        text = self.answer(stage, prompt)
        return text, {"prompt": len(prompt) // 4, "completion": len(text) // 4}


def ask(provider, stage: str, prompt: str, tries: int = 3, parse_tries: int = 2, sleep: Callable[[float], None] = time.sleep) -> dict:
    """Transport errors are tried again after 2, 4, ... seconds (30 at most), unreadable answers with feedback."""
    row = {"answer": None, "error": None, "calls": 0, "prompt": 0, "cached": 0, "completion": 0, "truncated": False}
    feedback = ""
    for _ in range(1 + parse_tries):
        text = None
        for k in range(tries):
            row["calls"] += 1
            try:
                text, usage = provider(stage, prompt + feedback)
                for c in ("prompt", "cached", "completion"):
                    row[c] += usage.get(c, 0)
                break
            except Truncated as e:
                return row | {"error": str(e) or "truncated", "truncated": True}
            except Exception as e:  # noqa: BLE001 - any transport error
                row["error"] = f"{type(e).__name__}: {e}"
                if k < tries - 1:
                    sleep(min(30.0, 2.0 * 2**k))
        if text is None:
            return row
        value = salvage_json(text)
        if value is not None:
            return row | {"answer": json.dumps(value, ensure_ascii=False), "error": None}
        row["error"] = "no JSON object"
        feedback = "\n\nYour last answer could not be read: " + " ".join(row["error"].split())[:200]
    return row


def run_stage(prompts: DataFrame, provider, tries: int = 3, in_flight: int = 30, per_task: int = 4) -> DataFrame:
    """The answers to (paper_id, stage, prompt), at most ``in_flight`` calls at once in the whole run: prompts are
    spread over in_flight / per_task partitions, each of which keeps per_task calls in the air."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in OUT_SCHEMA.split(", ")]
        with ThreadPoolExecutor(per_task) as pool:
            for pdf in frames:
                asked = list(pdf.itertuples())
                got = pool.map(lambda r: ask(provider, r.stage, r.prompt, tries), asked)
                yield pd.DataFrame([{"paper_id": r.paper_id, "stage": r.stage} | a for r, a in zip(asked, got)], columns=names)

    spread = prompts.select("paper_id", "stage", "prompt").repartition(max(1, in_flight // per_task), "paper_id", "stage")
    return spread.mapInPandas(run, OUT_SCHEMA)


def sections_ok(answers: DataFrame, sections: tuple[str, ...] = ("problem", "method", "evidence")) -> DataFrame:
    """Answers whose section_type is one of the known ones."""
    return answers.where(F.try_variant_get(F.try_parse_json("answer"), "$.section_type", "string").isin(*sections))


def warm_first(prompts: DataFrame, first: str = "problem") -> list[DataFrame]:
    """Two runs: one stage alone, to warm the shared prefix, then the others."""
    return [prompts.where(F.col("stage") == first), prompts.where(F.col("stage") != first)]
