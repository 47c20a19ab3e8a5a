"""Stand-ins for models: small deterministic clients with the interface a real one is plugged in with.

A text client answers ``client(system, prompt) -> str``; a text embedder maps a list of texts to one vector
each; a series embedder maps a batch of series, padded at their ends and with a mask of what is real, to a vector
per token.  Factories are what is shipped to tasks, so that a client is built once per partition.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Sequence

import numpy as np


class RuleClient:
    """Grades a prompt by the last number of its text: a stand-in for a language model."""

    def __init__(self, scale: float = 10.0):
        self.scale = scale

    def __call__(self, system: str, prompt: str) -> str:
        numbers = re.findall(r"\d+(?:\.\d+)?", prompt)
        grade = min(10, 1 + int(float(numbers[-1]) // self.scale)) if numbers else 1
        if "0 or 1" in system:
            return f"Answer: {int(grade > 5)}"
        return f"<think>{len(prompt)} characters</think> {grade}"


class HashingEmbedder:
    """Hashed word counts, scaled to unit length: a stand-in for a text encoder."""

    def __init__(self, width: int = 32):
        self.width = width

    def __call__(self, texts: Sequence[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.width), dtype=np.float32)
        for row, text in enumerate(texts):
            words = Counter((text or "").encode().lower().split())
            for word, times in words.items():
                out[row, int(hashlib.md5(word).hexdigest()[:8], 16) % self.width] += times
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(norm == 0, 1, norm)


class StatisticsEmbedder:
    """One token per reading: value, change, running mean and running extremes: a stand-in for a series encoder."""

    width = 5

    def __call__(self, series: np.ndarray, mask: np.ndarray) -> np.ndarray:
        series = np.where(mask, series, 0.0)
        steps = np.arange(1, series.shape[1] + 1)
        change = np.diff(series, prepend=series[:, :1], axis=1)
        highest, lowest = (f.accumulate(series, axis=1) for f in (np.maximum, np.minimum))
        parts = [series, change, np.cumsum(series, axis=1) / steps, highest, lowest]
        return np.stack(parts, axis=2).astype(np.float32)
