"""Model calls: one for each usable row, in as many partitions as calls are wanted at a time.

infer() is one mapInPandas node. A plain Python function in a column would be evaluated twice where a filter
follows it, and so would its calls. Replies are parsed in the same node.
"""

from __future__ import annotations

import http.client
import json
import threading
import time
import urllib.parse
import uuid
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass, field
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.replies import UNEXPECTED, parse_reply
from ..functions.text import json_quote
from .prompts import SYSTEM_PROMPT, request_body
from .replylog import TaskLog, reply_key_of, with_known_replies

WRITTEN, NO_TEXT, INFERENCE, OTHER = "written", "skipped_no_text", "skipped_inference", "skipped_unexpected"


class InferenceError(RuntimeError):
    """The server answered, but not with a completion."""


class Throttled(OSError):
    """The server has too much to do just now."""


class Backend(Protocol):
    def open(self) -> Callable[[str], str | None]:
        """On an executor, once for each partition: prompts to replies."""


@dataclass(frozen=True)
class EchoBackend:
    """Offline: a question and an answer made of the prompt's own text."""

    stem: str = "Ποιο είναι το θέμα; "

    def open(self) -> Callable[[str], str | None]:
        def reply(prompt: str) -> str:
            text = prompt.split('"""\n', 1)[-1].rsplit('\n"""', 1)[0]
            return json.dumps({"question": self.stem + text[:40], "answer": text[:80]}, ensure_ascii=False)

        return reply


def echo_reply(source_text: Column, stem: str = EchoBackend.stem) -> Column:
    """What EchoBackend replies, as a column."""
    head = [json_quote(c) for c in (F.concat(F.lit(stem), F.substring(source_text, 1, 40)), F.substring(source_text, 1, 80))]
    return F.concat(F.lit('{"question": '), head[0], F.lit(', "answer": '), head[1], F.lit("}"))


@dataclass(frozen=True)
class ScriptedBackend:
    """Offline: a reply, or an exception, for each prompt that has one; else the default."""

    replies: dict = field(default_factory=dict)
    default: str | None = None

    def open(self) -> Callable[[str], str | None]:
        def reply(prompt: str) -> str | None:
            found = next((v for k, v in self.replies.items() if k in prompt), self.default)
            if isinstance(found, Exception):
                raise found
            return found

        return reply


@dataclass(frozen=True)
class HttpChatBackend:
    """An OpenAI-compatible server. One kept-alive connection for each call in flight; no retries.

    But a connection that the server closed while it was idle is opened anew, and the call sent again: no byte of an answer came.

    The key is never shown: it's in no column, log or repr.
    """

    api_base: str
    model: str
    api_key: str | None = field(default=None, repr=False)
    temperature: float = 0.2
    max_tokens: int = 512
    timeout_seconds: float = 180.0
    enable_thinking: bool = False

    @property
    def base(self) -> str:
        return self.api_base.rstrip("/")

    @property
    def health_url(self) -> str:
        return self.base.removesuffix("/v1") + "/health"

    def open(self) -> Callable[[str], str | None]:
        url = urllib.parse.urlsplit(f"{self.base}/chat/completions")
        kind = http.client.HTTPSConnection if url.scheme == "https" else http.client.HTTPConnection
        connection = kind(url.netloc, timeout=self.timeout_seconds)
        target = url.path + (f"?{url.query}" if url.query else "")
        headers = {"Authorization": f"Bearer {self.api_key or 'EMPTY'}", "Content-Type": "application/json"}

        def reply(prompt: str) -> str | None:
            body = json.dumps(request_body(prompt, self.model, self.temperature, self.max_tokens, self.enable_thinking, SYSTEM_PROMPT)).encode()
            try:
                idle = connection.sock is not None
                try:
                    connection.request("POST", target, body, headers)
                    response = connection.getresponse()
                except (http.client.RemoteDisconnected, BrokenPipeError, ConnectionResetError, ConnectionAbortedError):
                    connection.close()
                    if not idle:
                        raise
                    connection.request("POST", target, body, headers)
                    response = connection.getresponse()
                data = response.read()
            except BaseException:
                connection.close()  # the next call opens another
                raise
            if response.status in (429, 503):
                raise Throttled(f"HTTP {response.status}")
            if not 200 <= response.status < 300:
                raise OSError(f"HTTP {response.status}")
            found = json.loads(data)
            try:
                return found["choices"][0]["message"]["content"]
            except (KeyError, IndexError, TypeError) as e:
                raise InferenceError("the answer holds no completion") from e

        return reply


def wait_until_healthy(url: str, attempts: int = 1, delay_seconds: float = 2.0, timeout_seconds: float = 180.0) -> None:
    """Asks url up to so many times; raises the last failure."""
    import urllib.request

    for left in range(attempts - 1, -1, -1):
        try:
            with urllib.request.urlopen(url, timeout=timeout_seconds):
                return
        except OSError:
            if not left:
                raise
            time.sleep(delay_seconds)


class _Call:
    """A row's place in the queue: its result once it has one."""

    __slots__ = ("prompt", "key", "attempts", "result")

    def __init__(self, prompt: str | None, key: str | None, result: tuple | None) -> None:
        self.prompt, self.key, self.attempts, self.result = prompt, key, 0, result


class Window:
    """Calls in flight over a whole stream of prompts, whose results come out in order.

    A slow call holds back nothing but the results after it: up to AHEAD rows for each call in flight are taken from the stream meanwhile.
    How many calls are in flight is halved when the server says that it has too much to do, and grows by one for as many answers as are in flight.
    """

    AHEAD = 64

    def __init__(self, ask: Callable[[str], tuple], most: int, attempts: int = 1, pause_seconds: float = 1.0, note: Callable[[_Call], None] | None = None) -> None:
        self.ask, self.most, self.attempts, self.pause, self.note = ask, most, attempts, pause_seconds, note
        self.limit = float(most)

    def run(self, calls: Iterator[_Call]) -> Iterator[_Call]:
        queue, flying, more = deque(), {}, True
        with ThreadPoolExecutor(self.most) as pool:

            def send(call: _Call, after: float = 0.0) -> None:
                call.attempts += 1
                flying[pool.submit(self._one, call.prompt, after)] = call

            while True:
                while more and len(flying) < max(1, int(self.limit)) and len(queue) < self.AHEAD * self.most:
                    call = next(calls, None)
                    if call is None:
                        more = False
                        break
                    queue.append(call)
                    if call.result is None:
                        send(call)
                while queue and queue[0].result is not None:
                    yield queue.popleft()
                if not flying:
                    if not more and not queue:
                        return
                    continue
                for done in wait(flying, return_when=FIRST_COMPLETED).done:
                    call = flying.pop(done)
                    found, throttled = done.result()
                    if throttled:
                        self.limit = max(1.0, self.limit / 2)
                        if call.attempts < self.attempts:
                            send(call, self.pause * call.attempts)
                            continue
                    else:
                        self.limit = min(float(self.most), self.limit + 1 / self.limit)
                    call.result = found
                    if self.note:
                        self.note(call)

    def _one(self, prompt: str, after: float) -> tuple[tuple, bool]:
        if after:
            time.sleep(after)
        return self.ask(prompt)


def _answer(ask: Callable[[str], str | None], prompt: str) -> tuple[tuple, bool]:
    """((raw reply or None, status and error if there's none), whether the server was throttled)."""
    try:
        return (ask(prompt), None, None), False
    except InferenceError as e:
        return (None, INFERENCE, str(e)), False
    except Throttled as e:
        return (None, OTHER, f"OSError: {e}"), True
    except Exception as e:  # whatever a call fails of, the row is skipped and said to be
        return (None, OTHER, f"{type(e).__name__}: {e}"), False


def _decoded(raw: str | None, status: str | None, error: str | None) -> tuple:
    if status:
        return None, None, status, error
    try:
        question, answer, found = parse_reply(raw)
    except Exception as e:  # such as nesting or numbers that the decoder gives up on
        return None, None, OTHER, f"{type(e).__name__}: {e}"
    return question, answer, WRITTEN if found is None else OTHER if found in UNEXPECTED else INFERENCE, found


def infer(df: DataFrame, backend: Backend, parallelism: int | None = None, prompt: str = "prompt", calls_per_task: int = 1, log: str | None = None, attempts: int = 1) -> DataFrame:
    """df with question, answer, status and error: one call for each row that has a prompt; others are said to have no text.

    parallelism: rows are first dealt to so many partitions, each of which has calls_per_task calls in flight, over all its rows. A failed
    call or reply is a status of its row, and never ends the job. attempts: how often a call that the server
    has no time for is sent, in all. log: a folder of replies, see replylog: what is in it isn't asked for again, neither by a
    task that is run once more nor by a later run.
    """
    known = None
    if log:
        df, known = with_known_replies(df, log, backend, prompt), "__reply"
    if parallelism:
        df = df.repartition(parallelism)
    own = [f for f in df.schema.fields if f.name != known]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in own), "question string, answer string, status string, error string"])
    run_id = uuid.uuid4().hex[:12]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        threads, held = threading.local(), deque()
        notes = TaskLog(log, run_id, reply_key_of(backend)) if log else None

        def ask(text: str) -> tuple[tuple, bool]:
            if not hasattr(threads, "ask"):
                threads.ask = backend.open()
            return _answer(threads.ask, text)

        def calls() -> Iterator[_Call]:
            for batch in batches:
                if not len(batch):
                    continue
                held.append(batch)
                for text, reply in zip(batch[prompt], batch[known] if known else [None] * len(batch)):
                    if not isinstance(text, str):
                        yield _Call(None, None, (None, NO_TEXT, "row does not contain any usable text fields"))
                        continue
                    key = notes.key(text) if notes else None
                    noted = reply if isinstance(reply, str) else notes.found(key) if notes else None
                    yield _Call(text, None if noted is not None else key, None if noted is None else (noted, None, None))

        def note(call: _Call) -> None:
            if call.key and call.result[0] is not None:
                notes.add(call.key, call.result[0])

        done = []
        for call in Window(ask, calls_per_task, attempts, note=note).run(calls()):
            done.append(_decoded(*call.result))
            if len(done) == len(held[0]):
                batch = held.popleft()
                batch = batch.drop(columns=known) if known else batch
                yield pd.concat([batch, pd.DataFrame(done, columns=["question", "answer", "status", "error"], index=batch.index, dtype=object)], axis=1)
                done = []
        if notes:
            notes.flush()

    return df.mapInPandas(run, schema)
