"""The boundary to models outside the engine: prompts go out as batches, answers come back as rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame


def ask(prompts: DataFrame, key: str, prompt: str, model: Callable[[list[str]], list[str]]) -> DataFrame:
    """(key, answer) of (key, prompt) rows: model answers a batch of prompts.

    The prompts of a batch that fails are asked one by one; a prompt that fails alone gives a null answer.
    """
    kind = prompts.schema[key].dataType.simpleString()

    def answered(some: list[str]) -> list[str | None]:
        try:
            got = list(model(some))
            if len(got) == len(some):
                return got
        except Exception:  # noqa: BLE001 - one bad answer must not end the job
            pass
        return [a for p in some for a in answered([p])] if len(some) > 1 else [None] * len(some)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            answers = answered(b[prompt].tolist())
            yield pd.DataFrame({"key": b[key], "answer": answers})

    return prompts.select(key, prompt).mapInPandas(run, f"key {kind}, answer string")


def ask_in_order(prompts: DataFrame, group: str, order: str, prompt: str, model: Callable[[str, dict[int, str]], str]) -> DataFrame:
    """(group, ord, answer): within a group prompts are asked one by one, each with the answers so far.

    For models whose later prompts depend on earlier answers; a group is one meeting's few open speakers.
    """
    kind = prompts.schema[group].dataType.simpleString()

    def run(b: pd.DataFrame) -> pd.DataFrame:
        known: dict[int, str] = {}
        rows = []
        for _, r in b.sort_values(order).iterrows():
            answer = model(r[prompt], dict(known))
            if answer is not None:
                known[int(r[order])] = answer
            rows.append((r[group], int(r[order]), answer))
        return pd.DataFrame(rows, columns=["grp", "ord", "answer"])

    return prompts.select(group, order, prompt).groupBy(group).applyInPandas(run, f"grp {kind}, ord bigint, answer string")
