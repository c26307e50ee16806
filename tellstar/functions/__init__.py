from .keys import NULL_SENTINEL, model_family, surrogate_key
from .jsonx import (
    array_length_or_zero,
    ground_truth_text,
    is_json_array,
    jpath,
    jsub,
    jtext,
    jtyped,
    parsed,
)

__all__ = [
    "NULL_SENTINEL",
    "array_length_or_zero",
    "ground_truth_text",
    "is_json_array",
    "jpath",
    "jsub",
    "jtext",
    "jtyped",
    "model_family",
    "parsed",
    "surrogate_key",
]
