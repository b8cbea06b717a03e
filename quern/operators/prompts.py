"""Prompts and requests."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import json_quote

# The prompts, which are stored in records.
SYSTEM_PROMPT = "Παράγεις συνθετικά ζεύγη ερώτησης και απάντησης στα Ελληνικά. Ακολουθείς αυστηρά τη ζητούμενη μορφή εξόδου."
PROMPT_BEFORE = 'Με βάση το παρακάτω κείμενο, δημιούργησε ΜΙΑ ερώτηση κατανόησης και την απάντησή της στα Ελληνικά.\n\nΚείμενο:\n"""\n'
PROMPT_AFTER = '\n"""\n\nΑπάντησε ΜΟΝΟ με JSON της μορφής:\n{"question": "...", "answer": "..."}'


def user_prompt(source_text: Column) -> Column:
    """The text as it is, between the template's two halves."""
    return F.concat(F.lit(PROMPT_BEFORE), source_text, F.lit(PROMPT_AFTER))


def request_body(prompt: str, model: str, temperature: float, max_tokens: int, enable_thinking: bool, system_prompt: str = SYSTEM_PROMPT) -> dict:
    """A chat completion request; the switch against thinking is there only if thinking is off."""
    body = {"model": model, "messages": [{"role": "system", "content": system_prompt}, {"role": "user", "content": prompt}], "temperature": temperature, "max_tokens": max_tokens}
    return body if enable_thinking else body | {"chat_template_kwargs": {"enable_thinking": False}}


def chat_request_json(prompt: Column, model: str, temperature: float = 0.2, max_tokens: int = 512, enable_thinking: bool = False) -> Column:
    """request_body as JSON text, natively."""
    before, after = json.dumps(request_body("<PROMPT>", model, temperature, max_tokens, enable_thinking), ensure_ascii=False).rsplit('"<PROMPT>"', 1)
    return F.concat(F.lit(before), json_quote(prompt), F.lit(after))
