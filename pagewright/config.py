"""Settings, passed explicitly and checked when made."""

from __future__ import annotations

from dataclasses import dataclass

#: Fixed value: the namespace of all ids.
NAMESPACE = "f0e1c2d3-4567-89ab-cdef-fedcba987654"


def _positive(**values: float) -> None:
    for name, value in values.items():
        if isinstance(value, bool) or not value > 0:
            raise ValueError(f"{name} must be positive")


def _ratio(**values: float) -> None:
    for name, value in values.items():
        if not 0 <= value <= 1:
            raise ValueError(f"{name} must be between 0 and 1")


@dataclass(frozen=True)
class WordStream:
    min_words: int = 80
    max_words: int = 120
    max_vertical_gap: float = 0.05
    forward_words: int = 8
    backward_words: int = 20
    normalize_spacing: bool = True

    def __post_init__(self) -> None:
        _positive(min_words=self.min_words, max_words=self.max_words)
        _ratio(max_vertical_gap=self.max_vertical_gap)
        if self.min_words >= self.max_words:
            raise ValueError("min_words must be less than max_words")
        if self.forward_words < 0 or self.backward_words < 0:
            raise ValueError("words to look at can't be negative")

    @property
    def closed_form(self) -> bool:
        """Whether a chunk's end depends on nothing before its start."""
        return self.backward_words <= self.max_words - self.min_words + 1


@dataclass(frozen=True)
class LineSentence:
    min_words: int = 80
    max_words: int = 120
    max_vertical_gap: float = 0.05

    def __post_init__(self) -> None:
        _positive(min_words=self.min_words, max_words=self.max_words)
        _ratio(max_vertical_gap=self.max_vertical_gap)
        if self.min_words >= self.max_words:
            raise ValueError("min_words must be less than max_words")


@dataclass(frozen=True)
class Layout:
    max_chars: int = 80
    y_tolerance: float = 0.5
    line_chunk_chars: int = 300
    merge_words: int = 80
    merge_gap: float = 0.5

    def __post_init__(self) -> None:
        _positive(max_chars=self.max_chars, line_chunk_chars=self.line_chunk_chars, merge_words=self.merge_words, merge_gap=self.merge_gap)
        _ratio(y_tolerance=self.y_tolerance)


@dataclass(frozen=True)
class Search:
    lexical_boost: float = 20.0
    neural_boost: float = 4.0
    date_boost: float = 4.0
    min_score: float = 0.0
    size: int = 40
    k1: float = 1.2
    b: float = 0.75
    score_filter: float = 0.57
    semantic_filter: float = 0.5
    min_before_fallback: int = 5
    max_semantic: int = 10

    def __post_init__(self) -> None:
        _positive(size=self.size)
        if min(self.lexical_boost, self.neural_boost, self.date_boost) < 0:
            raise ValueError("boosts can't be negative")


@dataclass(frozen=True)
class OcrJob:
    poll_seconds: float = 5
    timeout_seconds: float = 600

    def __post_init__(self) -> None:
        _positive(poll_seconds=self.poll_seconds, timeout_seconds=self.timeout_seconds)
        if self.timeout_seconds <= self.poll_seconds:
            raise ValueError("timeout must be longer than the poll interval")


def page_numbers(pages: list[int]) -> list[int]:
    if any(p < 1 for p in pages):
        raise ValueError("page numbers start at 1")
    return pages
