"""Model answers in free text: cleaning and score extraction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and keywords an answer is read with.
THINK_BLOCK = r"(?is)<think>.*?</think>"
ANSWER_PREFIX = r"(?i)\banswer\s*:\s*"
FIRST_NUMBER = r"(\d+(\.\d+)?)"
POSITIVE_WORDS = ["yes", "high", "die", "likely"]
NEGATIVE_WORDS = ["no", "low", "survive", "unlikely"]
NEUTRAL = 0.5


def clean_llm_output(text: Column) -> Column:
    """Drop reasoning blocks and answer prefixes, trim all white space."""
    bare = F.regexp_replace(F.regexp_replace(text, THINK_BLOCK, ""), ANSWER_PREFIX, "")
    return F.regexp_replace(bare, r"^\s+|\s+$", "")


def _mentions(text: Column, words: list[str], strict: bool) -> Column:
    if strict:
        return text.rlike(r"\b(" + "|".join(words) + r")\b")
    return text.rlike("|".join(words))


def extract_score(text: Column, mode: str = "score", strict: bool = False) -> Column:
    """A score in [0, 1] from a model answer; 0.5 where the answer says nothing usable.

    ``score`` reads the first number as a grade from 1 to 10.  ``binary`` takes a first number of 0 or 1,
    then keywords.  Keywords match inside words ("unlikely" holds "likely") unless ``strict``.
    """
    clean = clean_llm_output(F.lower(text))
    number = F.regexp_extract(clean, FIRST_NUMBER, 1).try_cast("double")
    if mode == "score":
        grade = F.least(F.greatest(number, F.lit(1.0)), F.lit(10.0)) / 10.0
        return F.when(number.isNotNull(), grade).otherwise(NEUTRAL)
    if mode != "binary":
        raise ValueError(f"unknown mode {mode!r}")
    return (
        F.when(number.isin(0.0, 1.0), number)
        .when(_mentions(clean, POSITIVE_WORDS, strict), 1.0)
        .when(_mentions(clean, NEGATIVE_WORDS, strict), 0.0)
        .otherwise(NEUTRAL)
    )
