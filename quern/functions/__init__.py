"""Column functions: text clean-up, JSON text, model replies."""

from .replies import json_span, parse_reply, reply_struct, strip_reasoning
from .text import WHITE_SPACE, collapse_ws, is_nonblank, json_quote, strip_ws, truncate_ellipsis

__all__ = ["WHITE_SPACE", "collapse_ws", "is_nonblank", "json_quote", "json_span", "parse_reply", "reply_struct", "strip_reasoning", "strip_ws", "truncate_ellipsis"]
