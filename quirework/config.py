"""Settings of the pipeline, the evaluation and the gates."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass


@dataclass(frozen=True)
class PipelineConfig:
    input_dir: str = ""
    output_dir: str = ""
    source_priority: str = "block_first"
    target_tokens: int = 420
    max_tokens: int = 480
    overlap_tokens: int = 30
    max_overlap_chars: int = 30
    min_chars: int = 220
    min_chunk_tokens: int = 24
    min_viable_chunk_tokens: int = 50
    drop_toc: bool = True
    dedupe_chunks: bool = True
    incremental: bool = True
    fail_fast: bool = False
    json_lines: bool = True

    def signature(self) -> str:
        """SHA-1 over every setting that changes what a document becomes."""
        fields = {k: v for k, v in asdict(self).items() if k not in ("input_dir", "output_dir", "incremental", "fail_fast", "json_lines")}
        return hashlib.sha1(json.dumps(fields, sort_keys=True).encode()).hexdigest()


@dataclass(frozen=True)
class EvalConfig:
    max_tokens: int = 520
    small_tokens: int = 20
    moderate_tokens: int = 50
    samples: int = 8
    max_small_pct: float = 12.0
    max_mixed_pct: float = 5.0


@dataclass(frozen=True)
class GateConfig:
    tiny_tokens: int = 20
    max_tiny_pct: float = 0.5
    max_duplicate_pct: float = 0.0
    max_overlap_p95: float = 30.0
    max_missing_pct: float = 0.0
    scan_chars: int = 240
    max_mixed_pct: float = 2.0
    min_median_tokens: float = 100.0
    min_coverage: float = 95.0
