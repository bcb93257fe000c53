"""Completers that ask a service over HTTP, by the form of its requests and answers.

A form is (text or chat) and whether the service gives several answers at once. Addresses, keys and model
names are parameters; nothing is known of any service here.
"""

from __future__ import annotations

import json
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass, field


def post(url: str, headers: dict, body: dict, timeout: float = 120.0):
    request = urllib.request.Request(url, json.dumps(body).encode(), {"Content-Type": "application/json", **headers})
    with urllib.request.urlopen(request, timeout=timeout) as response:
        return json.load(response)


def texts_of(answer) -> list[str]:
    """The texts in an answer, whichever of the usual forms it has.

    A list of choices with `text`, or with a message's `content`; the same below `output` or `result`; a bare
    text or list of texts.
    """
    if isinstance(answer, str):
        return [answer]
    if isinstance(answer, list):
        return [t for a in answer for t in texts_of(a)]
    if not isinstance(answer, dict):
        raise ValueError(f"no text in an answer of type {type(answer).__name__}")
    for key in ("choices", "output", "outputs", "result", "results", "message", "content", "text", "generated_text"):
        if answer.get(key) is not None:
            return texts_of(answer[key])
    raise ValueError(f"no text in an answer with the keys {sorted(answer)}")


@dataclass(frozen=True)
class Backend:
    """Asks `url` in one form.

    chat: the prompt is a list of messages, else one text. many: one request brings all choices, else each
    has a request of its own. extra goes into every body (temperature and length have defaults), names
    renames the body's fields, pause is waited between rounds of requests.
    """

    url: str
    model: str | None = None
    chat: bool = False
    many: bool = False
    pause: float = 1.0
    headers: dict = field(default_factory=dict, hash=False)
    extra: dict = field(default_factory=lambda: {"temperature": 0.7, "max_tokens": 512}, hash=False)
    names: dict = field(default_factory=dict, hash=False)
    send: Callable = post

    def body(self, prompt, choices: int) -> dict:
        out = {"messages" if self.chat else "prompt": prompt, **self.extra}
        if self.model:
            out["model"] = self.model
        if self.many:
            out["n"] = choices
        return {self.names.get(k, k): v for k, v in out.items()}

    def complete(self, prompt, choices: int) -> list[str]:
        if self.many:
            return texts_of(self.send(self.url, self.headers, self.body(prompt, choices)))
        return [t for _ in range(choices) for t in texts_of(self.send(self.url, self.headers, self.body(prompt, 1)))[:1]]


#: The forms that the labelling stages can be told to use: kind and number of answers, and the pause between rounds.
FORMS = {
    "text/single": {"chat": False, "many": False, "pause": 1.0},
    "text/single-plain": {"chat": False, "many": False, "pause": 1.0, "extra": {}},
    "text/many": {"chat": False, "many": True, "pause": 1.0},
    "chat/single": {"chat": True, "many": False, "pause": 0.0},
    "chat/many": {"chat": True, "many": True, "pause": 0.0},
}


def backend(form: str, url: str, model: str | None = None, **options) -> Backend:
    """The completer of a form; an unknown one is an error that names those there are."""
    if form not in FORMS:
        raise ValueError(f"no form {form!r}; forms are {', '.join(FORMS)}")
    return Backend(url, model, **{**FORMS[form], **options})
