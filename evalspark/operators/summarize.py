"""A paragraph for each text, by a pluggable summarizer in batches."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SUMMARY, OUT_OF_MEMORY = "LLM_Summary", "ERROR: CUDA OUT OF MEMORY"
BATCH, MAX_WORDS = 4, 120


class Summarizer(Protocol):
    """Turns prompts into paragraphs. MemoryError, or an accelerator's RuntimeError "out of memory", makes a batch smaller."""

    def generate(self, prompts: list[str]) -> list[str]: ...


def build_prompt(text: object) -> str:
    """The prompt for one text; empty for what isn't a text or is blank."""
    if not isinstance(text, str) or not text.strip():
        return ""
    rules = f"Write one paragraph of at most {MAX_WORDS} words about the weaknesses named below. Group them by theme. Name no strengths and add nothing of your own."
    return f"{rules}\n\n{text.strip()}"


class ExtractiveSummarizer:
    """The first sentences of the prompt's text, up to a number of words: deterministic, without a model."""

    def __init__(self, max_words: int = MAX_WORDS) -> None:
        self.max_words = max_words

    def generate(self, prompts: list[str]) -> list[str]:
        out = []
        for prompt in prompts:
            lines = [x.strip().removeprefix("- ").strip() for x in prompt.partition("\n\n")[2].split("\n")]
            words = " ".join(x for x in lines if x).split()
            out.append(" ".join(words[: self.max_words]))
        return out


def generate_all(summarizer: Summarizer, texts: list, batch: int = BATCH) -> list[str]:
    """A summary for each text, in order; blank texts have an empty one and reach no model.

    A batch that runs out of memory is halved; a single text that does gets a message.
    """
    out = [""] * len(texts)
    prompts = [(i, p) for i, t in enumerate(texts) if (p := build_prompt(t))]

    def run(part: list[tuple[int, str]]) -> None:
        try:
            found = summarizer.generate([p for _, p in part])
        except (MemoryError, RuntimeError) as e:
            if not isinstance(e, MemoryError) and "out of memory" not in str(e).lower():
                raise
            if len(part) == 1:
                out[part[0][0]] = OUT_OF_MEMORY
                return
            run(part[: len(part) // 2])
            run(part[len(part) // 2 :])
            return
        for (i, _), s in zip(part, found, strict=True):
            out[i] = s

    for start in range(0, len(prompts), batch):
        run(prompts[start : start + batch])
    return out


def summarize(df: DataFrame, text: str, summarizer: Summarizer | None = None, batch: int = BATCH, into: str = SUMMARY) -> DataFrame:
    """Adds a summary of ``text``; a table without the column is unchanged."""
    if text not in df.columns:
        return df
    engine = summarizer or ExtractiveSummarizer()

    @F.pandas_udf("string")
    def summary(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(generate_all(engine, texts.tolist(), batch), index=texts.index)

    return df.withColumn(into, summary(F.col(text)))


def summarize_sheets(sheets: dict[str, DataFrame], text: str, names: list[str] | str = "all", summarizer: Summarizer | None = None, batch: int = BATCH) -> dict[str, DataFrame]:
    """The sheets with summaries in those that are named ("all": every one) and have the text column."""
    chosen = set(sheets) if names == "all" else set([names] if isinstance(names, str) else names)
    return {k: summarize(v, text, summarizer, batch) if k in chosen else v for k, v in sheets.items()}
