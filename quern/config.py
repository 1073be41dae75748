"""Settings of the retrieval pipeline, checked when they are made."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class CleanRules:
    strip_control_chars: bool = True
    normalize_spaces: bool = True


@dataclass(frozen=True)
class Chunking:
    """``mode`` auto picks size and overlap for each page between ``low`` and ``high`` tokens;
    fixed uses ``size`` and ``overlap``. A token counts as four characters."""

    mode: str = "fixed"
    size: int = 300
    overlap: int = 50
    low: int = 300
    high: int = 800
    ratio: float = 0.2

    def __post_init__(self):
        if self.mode not in ("auto", "fixed"):
            raise ValueError(f"chunking mode {self.mode!r} is neither auto nor fixed")
        if self.size <= 0 or self.overlap < 0 or self.overlap >= self.size:
            raise ValueError("a chunk must be longer than its overlap, or chunks would never end")
        if not 0 < self.low <= self.high or not 0 <= self.ratio < 1:
            raise ValueError("need 0 < low <= high and 0 <= ratio < 1")


#: The settings that the corpus build uses.
AUTO = Chunking(mode="auto", low=130, high=300, ratio=0.2)


@dataclass(frozen=True)
class Hybrid:
    enable: bool = True
    dense: float = 0.7
    lexical: float = 0.3
    max_features: int | None = None  # terms of a document's vocabulary; None keeps all


@dataclass(frozen=True)
class Retriever:
    unique_by_page: bool = True
    top_k: int = 10
    hybrid: Hybrid = field(default_factory=Hybrid)


@dataclass(frozen=True)
class Rerank:
    enable: bool = True
    pre_k: int = 30
    dense: float = 0.3
    llm: float = 0.7


@dataclass(frozen=True)
class Ocr:
    """Explicit settings win over any environment variable."""

    min_chars: int = 64
    min_confidence: float = 0.60
    confident_chars: int = 200
    dpi: int = 250
    max_pages: int | None = None


def env_truthy(value: str | None, default: bool = False) -> bool:
    """1, true, yes, y and on count as true, in any case and with blanks around."""
    return default if value is None else value.strip().lower() in ("1", "true", "yes", "y", "on")
