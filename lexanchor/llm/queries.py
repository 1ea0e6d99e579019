"""The queries of this package and their SQL twins."""

from lexanchor.llm import exact_dedup, hard_negatives, language, language_model, line_quality, merkle, mixing, near_dedup, packing, quality, token_files, toxicity, url_filter  # noqa: F401  registers their queries
from lexanchor.llm.common import ORACLE, QUERIES  # noqa: F401
