"""Options of a flow, grouped by what they govern."""

from __future__ import annotations

from dataclasses import dataclass, field

from ..operators.accounting import PRICES


@dataclass(frozen=True)
class BatchOptions:
    """``order`` empty: batches of records as they arrive in each partition, without a sort."""

    size: int = 20
    parallel_calls: int = 1
    order: tuple[str, ...] = ("ordinal",)


@dataclass(frozen=True)
class RouterOptions:
    enabled: bool = False
    patterns: tuple[str, ...] = ()
    granularity: str = "batch"
    fast_model: str = "claude-haiku"
    default_model: str = "claude-sonnet"
    powerful_model: str = "claude-opus"

    @property
    def models(self) -> dict[int, str]:
        return {1: self.fast_model, 2: self.default_model, 3: self.powerful_model}


@dataclass(frozen=True)
class MaskOptions:
    fields: tuple[str, ...] = ()
    patterns: tuple[str, ...] = ()
    restore: bool = True

    @property
    def enabled(self) -> bool:
        return bool(self.fields or self.patterns)


@dataclass(frozen=True)
class ReuseOptions:
    """Folders of stored results. None switches a kind of reuse off.

    ``merge_equal`` sends equal (masked) record values to the model only once.
    """

    merge_equal: bool = True

    cache_path: str | None = None
    cache_ttl_seconds: int | None = 3600
    similarity: float | None = None
    spec_path: str | None = None
    spec_ttl_seconds: int = -1
    call_log_path: str | None = None


@dataclass(frozen=True)
class CallOptions:
    max_retries: int = 3
    wait_seconds: float = 1.0
    calls_per_second: float | None = None
    at_once: int = 8
    time_limit: float | None = None
    request_options: dict | None = None


@dataclass(frozen=True)
class FlowConfig:
    contract: str = ""
    system_prompt: str = ""
    fingerprint_mode: str = "deep"
    batches: BatchOptions = field(default_factory=BatchOptions)
    router: RouterOptions = field(default_factory=RouterOptions)
    masking: MaskOptions = field(default_factory=MaskOptions)
    reuse: ReuseOptions = field(default_factory=ReuseOptions)
    calls: CallOptions = field(default_factory=CallOptions)
    prices: dict[str, tuple] = field(default_factory=lambda: dict(PRICES))
