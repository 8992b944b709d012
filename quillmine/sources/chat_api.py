"""A client of chat-completion APIs for the extraction step."""

from __future__ import annotations

import json
import os
import time
import urllib.error
import urllib.request
from collections.abc import Callable

from quillmine.sources.literature_api import TransportError, with_retries

RETRY = {408, 429, 502}  # fixed values: what is tried again


class PaymentRequired(TransportError):
    """The account has no credit (402); more requests would fail alike."""


class Unavailable(TransportError):
    """No provider serves the model now (503)."""


TYPED = {402: PaymentRequired, 503: Unavailable}


def post(url: str, body: dict, headers: dict, timeout: float = 120.0) -> dict:
    request = urllib.request.Request(url, json.dumps(body).encode(), {"Content-Type": "application/json", **headers})
    try:
        with urllib.request.urlopen(request, timeout=timeout) as answer:
            return json.loads(answer.read())
    except urllib.error.HTTPError as e:
        raise TYPED.get(e.code, TransportError)(e.code, e.reason) from e
    except urllib.error.URLError as e:
        raise ConnectionError(str(e.reason)) from e


class ChatClient:
    """Called with (system, prompt, schema); gives the content, the model, its tokens and its cost.

    The key comes from an environment variable of the executors and is never part of a plan."""

    def __init__(self, url: str, model: str, key_variable: str = "CHAT_API_KEY", tries: int = 4, send: Callable[..., dict] = post, sleep: Callable[[float], None] = time.sleep):
        self.url, self.model, self.key_variable, self.tries, self.send, self.sleep = url, model, key_variable, tries, send, sleep

    def __call__(self, system: str, prompt: str, schema: dict) -> dict:
        body = {"model": self.model, "messages": [{"role": "system", "content": system}, {"role": "user", "content": prompt}], "response_format": {"type": "json_schema", "json_schema": {"name": "record", "schema": schema}}}
        headers = {"Authorization": f"Bearer {os.environ.get(self.key_variable, '')}"}
        answer = with_retries(self.send, self.url, body, headers, tries=self.tries, sleep=self.sleep, retry=RETRY)
        usage = answer.get("usage") or {}
        return {
            "content": answer["choices"][0]["message"]["content"], "model_used": answer.get("model", self.model),
            "input_tokens": usage.get("prompt_tokens"), "output_tokens": usage.get("completion_tokens"), "cost_usd": usage.get("cost"),
        }
