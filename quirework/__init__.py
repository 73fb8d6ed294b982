"""Document chunking, chunk quality and incremental processing on Spark."""

from importlib import import_module

#: Public names and the modules that hold them; each is imported on first use.
_PUBLIC = {
    "PipelineConfig": "config", "EvalConfig": "config", "GateConfig": "config",
    "run_pipeline": "plans.pipeline", "run_evaluation": "plans.pipeline", "run_gates": "plans.pipeline", "chunk_blocks": "plans.pipeline",
    "clean_text": "functions.clean", "flatten_tables": "functions.clean", "formulas": "functions.clean",
    "token_count": "functions.tokens", "split_tokens": "functions.splitting", "encoded_splitter": "functions.encoding",
    "extract_year": "functions.meta", "augmented_text": "functions.meta", "language_hint": "functions.meta",
    "document_meta": "operators.assemble", "structure_state": "operators.segments", "build_segments": "operators.segments",
    "Manifest": "operators.incremental",
    "BLOCK": "schemas", "SEGMENT": "schemas", "CHUNK": "schemas", "DOCUMENT": "schemas", "PAGE_REFS": "schemas",
}
__all__ = sorted(_PUBLIC)
__version__ = "0.2.0"


def __getattr__(name: str):
    if name in _PUBLIC:
        return getattr(import_module(f"{__name__}.{_PUBLIC[name]}"), name)
    raise AttributeError(name)
