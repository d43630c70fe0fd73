"""The external yes/no page classifier: prompts, keys with a pace, and the tasks that ask.

Calls cost money, so a file's pages are asked in order in one task and stop at the first yes (`ask_files`). Each task holds its
own keys and an equal share of their pace, so no state crosses machines; what each page took of them comes back with its reply.
"""

from __future__ import annotations

import base64
import heapq
import io
import json
import os
import time
import urllib.error
import urllib.request
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..config import EngineConfig
from .places import opened

PROMPTS = {
    "find": "Does this page of an annual report hold the government auditor's comments: their heading, their text, a certificate that there are none, or their signature? A passing mention, a contents list, another auditor's report or accounts don't count. Answer YES or NO.",
    "continue": "The page before holds the government auditor's comments. Does this page carry them on, by text or signature, rather than begin something else? Answer YES or NO.",
}
#: Parts of keys that nobody has filled in. Fixed values.
PLACEHOLDERS = ("REPLACE_ME", "xxxx")


class PageOracle(Protocol):
    def __call__(self, source_pdf: str, page: int, prompt: str) -> bool | None: ...


def usable_keys(given: list[str] | None = None, variable: str = "OPENAI_API_KEY") -> list[str]:
    """Keys that aren't empty or placeholders; without any given, those of the environment variable, separated by commas."""
    found = given if given is not None else os.environ.get(variable, "").split(",")
    return [k.strip() for k in found if k and k.strip() and not any(p in k for p in PLACEHOLDERS)]


def outcome_of(error: Exception) -> str:
    code = str(getattr(error, "code", "")) + " " + str(error)
    return "throttled" if "429" in code else "refused" if "401" in code or "403" in code else "failed"


@dataclass
class Pace:
    """The keys of one task, as a queue by the time from which each may be used. A refused key leaves it; a throttled one waits longer."""

    keys: list[str]
    gap: float
    cooldown: float
    clock: Callable[[], float] = time.monotonic
    sleep: Callable[[float], None] = time.sleep
    used: Counter = field(default_factory=Counter)

    def __post_init__(self):
        if not self.keys:
            raise ValueError("at least one key is needed")
        self.ready = [(float("-inf"), i) for i in range(len(self.keys))]

    def call(self, send: Callable[[str], str | None], attempts: int) -> str | None:
        """The reply to send(key), with up to so many attempts; None when they all fail or no key is left."""
        for _ in range(attempts):
            if not self.ready:
                return None
            at, i = heapq.heappop(self.ready)
            if (wait := at - self.clock()) > 0:
                self.sleep(wait)
            began, reply, outcome = self.clock(), None, "answered"
            try:
                reply = send(self.keys[i])
            except Exception as e:  # noqa: BLE001  the next attempt may do better
                outcome = outcome_of(e)
            self.used[self.keys[i][-8:], outcome] += 1
            if outcome != "refused":
                heapq.heappush(self.ready, ((self.clock() + self.cooldown) if outcome == "throttled" else began + self.gap, i))
            if outcome == "answered":
                return reply
        return None


def usage(replies: DataFrame) -> DataFrame:
    """key (last characters), outcome and n of the calls that stored replies took. A call is counted with the page it was made for, so a task that is run again counts once."""
    calls = replies.select(F.explode("calls").alias("call", "n"))
    return calls.select(F.element_at(F.split("call", "\\|"), 1).alias("key"), F.element_at(F.split("call", "\\|"), 2).alias("outcome"), "n").groupBy("key", "outcome").agg(F.sum("n").cast("bigint").alias("n"))


def verdict_of(reply: str | None) -> bool | None:
    """Whether a reply says yes and not no; None without a reply."""
    if reply is None:
        return None
    said = reply.upper()
    return "YES" in said and "NO" not in said


def request_arguments(model: str, config: EngineConfig = EngineConfig()) -> dict:
    """Models that reason take other arguments."""
    if (model or "").lower().startswith(("gpt-5", "o1", "o3", "o4")):
        return {"model": model, "max_completion_tokens": config.reply_tokens, "reasoning_effort": "low"}
    return {"model": model, "max_tokens": config.reply_tokens, "temperature": 0}


def pdf_pages(content: bytes, first: int, last: int, dpi: int) -> list[Any]:
    """Images of pages, as many as there are of first to last, by the optional pdf2image package."""
    from pdf2image import convert_from_bytes

    return convert_from_bytes(content, first_page=first, last_page=last, dpi=dpi)


@dataclass
class PageImages:
    """Page images of one file after another: a file is read once, wherever it is, and `ahead` pages that follow each other are one conversion.

    Pages are asked about in order, so most of those rendered ahead are asked for; a first yes leaves at most ahead - 1 unused.
    """

    ahead: int = 4
    convert: Callable[[bytes, int, int, int], list[Any]] = pdf_pages
    source: str | None = None
    content: bytes = b""
    held: dict[int, Any] = field(default_factory=dict)

    def __call__(self, source_pdf: str, page: int, dpi: int) -> Any | None:
        if source_pdf != self.source:
            with opened(source_pdf) as f:
                self.content = f.read()
            self.source, self.held = source_pdf, {}
        if page not in self.held:
            found = self.convert(self.content, page, page + self.ahead - 1, dpi)
            self.held = dict.fromkeys(range(page, page + self.ahead)) | dict(enumerate(found, page))
        return self.held[page]


def image_base64(image: Any, quality: int) -> str:
    """JPEG of an image (anything with convert and save, as Pillow's) or of JPEG bytes, in base64."""
    if not isinstance(image, bytes):
        out = io.BytesIO()
        image.convert("RGB").save(out, format="JPEG", quality=quality)
        image = out.getvalue()
    return base64.b64encode(image).decode()


def post(url: str, key: str, body: dict, timeout: float = 60.0) -> str | None:
    """A chat completion's reply."""
    request = urllib.request.Request(f"{url.rstrip('/')}/chat/completions", json.dumps(body).encode(), {"Content-Type": "application/json", "Authorization": f"Bearer {key}"})
    with urllib.request.urlopen(request, timeout=timeout) as got:
        return json.load(got)["choices"][0]["message"]["content"]


@dataclass
class ImageOracle:
    """Renders a page and asks a model about it. render, send and pace can be replaced; `tasks` share the pace of the keys."""

    keys: list[str]
    config: EngineConfig = EngineConfig()
    tasks: int = 8
    render: Callable[[str, int, int], Any | None] = field(default_factory=PageImages)
    send: Callable[[str, str, dict], str | None] = post
    pace: Pace | None = None

    def spent(self) -> Counter:
        """Calls so far, in this task, by key and outcome."""
        return Counter() if self.pace is None else Counter(self.pace.used)

    def __call__(self, source_pdf: str, page: int, prompt: str) -> bool | None:
        c = self.config
        image = self.render(source_pdf, page, c.dpi)
        if image is None:
            return None
        if self.pace is None:
            self.pace = Pace(self.keys, 60.0 * self.tasks / c.requests_a_minute, c.cooldown_s)
        picture = {"type": "image_url", "image_url": {"url": f"data:image/jpeg;base64,{image_base64(image, c.image_quality)}", "detail": c.image_detail}}
        body = request_arguments(c.model, c) | {"messages": [{"role": "user", "content": [{"type": "text", "text": PROMPTS[prompt]}, picture]}]}
        reply = self.pace.call(lambda key: self.send(c.base_url, key, body), c.attempts)
        return verdict_of(reply)


def ask_files(samples: DataFrame, oracle: PageOracle, config: EngineConfig = EngineConfig(), tasks: int = 8) -> DataFrame:
    """Asks for each file of samples (company, source_pdf, n_pages, pages): replies (company, source_pdf, page, verdict, calls), as a table that both passes read; calls: how many calls of each `key|outcome` the page took, if the oracle tells what it has spent.

    At most `tasks` tasks ask at once, which is what an oracle divides its pace by. A page that fails, to render or to be
    answered, has a null verdict: a search goes on to the next page, a walk ends there.
    """

    def judged(source: str, page: int, prompt: str) -> bool | None:
        try:
            return oracle(source, page, prompt)
        except Exception:  # noqa: BLE001  a null verdict
            return None

    spent = getattr(oracle, "spent", Counter)

    def counted(source: str, page: int, prompt: str) -> tuple[bool | None, dict[str, int]]:
        before = spent()
        said = judged(source, page, prompt)
        return said, {"|".join(k): n for k, n in (spent() - before).items()}

    def asked(source: str, pages: list[int], n_pages: int) -> Iterator[tuple[int, bool | None, dict[str, int]]]:
        for p in pages:
            verdict, calls = counted(source, int(p), "find")
            yield int(p), verdict, calls
            if verdict:
                break
        else:
            return
        for q in range(int(p) + 1, min(int(p) + config.walk_pages, n_pages) + 1):
            verdict, calls = counted(source, q, "continue")
            yield q, verdict, calls
            if not verdict:
                return

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [(r.company, r.source_pdf, p, v, c) for r in b.itertuples() for p, v, c in asked(r.source_pdf, r.pages, r.n_pages)]
            yield pd.DataFrame(out, columns=["company", "source_pdf", "page", "verdict", "calls"]).astype({"page": "int32"})

    return samples.select("company", "source_pdf", "n_pages", F.col("pages")).coalesce(tasks).mapInPandas(run, "company string, source_pdf string, page int, verdict boolean, calls map<string,int>")
