"""Column-level building blocks (all JVM-side expressions)."""

from .names import normalize_name, normalize_names, quote
from .text import build_embedding_text, clean_text, strip_ws
from .vectors import cosine_distance, cosine_similarity, dot, norm

__all__ = [
    "build_embedding_text",
    "clean_text",
    "cosine_distance",
    "cosine_similarity",
    "dot",
    "norm",
    "normalize_name",
    "normalize_names",
    "quote",
    "strip_ws",
]
