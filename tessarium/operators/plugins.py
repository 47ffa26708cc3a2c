"""Where models attach: a provider protocol, a registry, and batch operators that turn failures into columns."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Provider(Protocol):
    def generate(self, prompt: str, context: list) -> dict: ...

    def get_model_info(self) -> dict: ...


class Echo:
    """A deterministic stand-in: the prompt's first line, labelled as no model's output."""

    def generate(self, prompt: str, context: list) -> dict:
        return {"output": f"[no model] {prompt.splitlines()[0] if prompt else ''}", "provenance": {"model": "echo"}}

    def get_model_info(self) -> dict:
        return {"model": "echo"}


PROVIDERS: dict[str, Callable[[], Provider]] = {"echo": Echo}


def provider(name: str) -> Provider:
    if name not in PROVIDERS:
        raise ValueError(f"unknown provider {name!r}; known: {', '.join(sorted(PROVIDERS))}")
    return PROVIDERS[name]()


#: Codes of failures, by what an error's text holds, in order.
ERRORS = (
    ("auth_error", ("401", "403", "auth")),
    ("rate_limited", ("429", "rate")),
    ("model_loading", ("503", "loading")),
    ("timeout", ("timeout",)),
    ("model_not_found", ("not found", "404")),
)


def error_code(message: str, bad_response: bool = False) -> str:
    """One of seven codes: those of ERRORS, bad_response for an answer of another form, else inference_failed."""
    low = message.lower()
    if bad_response:
        return "bad_response"
    return next((code for code, marks in ERRORS if any(m in low for m in marks)), "inference_failed")


class Chain:
    """Back ends in order; each that fails hands on to the next, and the last resort says that it is no model's output."""

    def __init__(self, *makers: Callable[[], Provider]):
        self.makers, self.failures = makers, []

    def generate(self, prompt: str, context: list) -> dict:
        self.failures = []
        for make in self.makers:
            try:
                found = make().generate(prompt=prompt, context=context)
                if not isinstance(found.get("output"), str):
                    raise TypeError("no text in the answer")
                return {**found, "failures": list(self.failures)}
            except Exception as e:  # whatever a back end raises, the next one is asked
                self.failures.append((error_code(str(e), isinstance(e, TypeError | KeyError | AttributeError)), str(e)[:300]))
        return {"output": "[no back end answered]", "error": "ALL_BACKENDS_UNAVAILABLE", "failures": list(self.failures), "provenance": {"model": "none"}}

    def get_model_info(self) -> dict:
        return {"model": "chain", "back_ends": len(self.makers)}


def generate(prompts: DataFrame, make: Callable[[], Provider]) -> DataFrame:
    """id, output, error, code of prompts (id, prompt); a provider is made once a partition."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()
        for pdf in batches:
            out = []
            for i, prompt in zip(pdf["id"], pdf["prompt"], strict=True):
                try:
                    found = model.generate(prompt=prompt, context=[])
                    out.append((str(i), str(found["output"]), found.get("error"), None))
                except Exception as e:  # a provider may raise anything; its row says so
                    code = error_code(str(e), isinstance(e, TypeError | KeyError | AttributeError))
                    out.append((str(i), None, f"{type(e).__name__}: {e}"[:200], code))
            yield pd.DataFrame(out, columns=["id", "output", "error", "code"])

    return prompts.select("id", "prompt").mapInPandas(run, "id string, output string, error string, code string")


def model_candidates(segments: DataFrame, call: Callable[[Sequence[str]], list[dict]]) -> DataFrame:
    """segment_id, candidate_type, text from a batch function of texts; indexes out of range have segment_id ''."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ids, rows = pdf["segment_id"].astype(str).tolist(), []
            for found in call(pdf["text"].tolist()):
                k = found.get("segment_index", -1)
                rows.append((ids[k] if 0 <= k < len(ids) else "", found["candidate_type"], found["text"]))
            yield pd.DataFrame(rows, columns=["segment_id", "candidate_type", "text"])

    return segments.select("segment_id", "text").mapInPandas(run, "segment_id string, candidate_type string, text string")


def json_in(text: Column, schema: str) -> Column:
    """The object between a text's first and last brace, null where it is none."""
    return F.from_json(F.nullif(F.regexp_extract(text, r"(?s)\{.*\}", 0), F.lit("")), schema)


def frame_rate(text: Column) -> Column:
    """'30000/1001' and '25' as numbers, null for a zero denominator."""
    parts = F.split(text, "/")
    low = F.coalesce(F.get(parts, F.lit(1)), F.lit("1")).try_cast("double")
    return F.when(low != 0, F.get(parts, F.lit(0)).try_cast("double") / low)


def assistant_only(messages: str) -> Column:
    """What a training loss would cover: the assistant's messages."""
    return F.filter(messages, lambda m: m["role"] == "assistant")


def experiment_manifest(experiment_id: str, revision: str, datasets: dict[str, str], config: dict, generated_at: str) -> str:
    """The manifest of an experiment as JSON; the time is given, not read from a clock."""
    return json.dumps(
        {"experiment_id": experiment_id, "code_revision": revision, "dataset_revisions": datasets, "config": config, "generated_at": generated_at},
        sort_keys=True,
        indent=2,
    )
