"""DataFrame to DataFrame operators, for DataFrame.transform()."""

from .extract import TextFields, text_fields, with_row_id, with_source_text
from .inference import EchoBackend, HttpChatBackend, ScriptedBackend, echo_reply, infer, wait_until_healthy
from .prompts import SYSTEM_PROMPT, chat_request_json, user_prompt
from .records import assistant_json, chat_record, chat_record_json
from .rows import rows_in_range, select_rows, with_row_index
from .summary import dataset_profile, run_summary, status_breakdown

__all__ = [
    "SYSTEM_PROMPT", "EchoBackend", "HttpChatBackend", "ScriptedBackend", "TextFields", "assistant_json", "chat_record", "chat_record_json", "chat_request_json",
    "dataset_profile", "echo_reply", "infer", "rows_in_range", "run_summary", "select_rows", "status_breakdown", "text_fields", "user_prompt", "wait_until_healthy",
    "with_row_id", "with_row_index", "with_source_text",
]
