"""Where change packages come from: a folder of recorded packages, or an OData service over HTTP."""

from __future__ import annotations

import base64
import os
import re
import urllib.parse
import urllib.request
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Protocol
from urllib.error import HTTPError

from tidemark.functions.text import error_message
from tidemark.sources.metadata import CHUNK_BYTES, bounded, checked, received_no
from tidemark.sources.packages import feed_prefix

# Answers that a retry cannot mend.
PERMANENT = (400, 401, 403, 404, 405)
#: What is read of an error's answer.
ERROR_BYTES = 64 << 10


class Transport(Protocol):
    """``package(n)`` may be asked again for one number; ``confirm`` is irreversible."""

    def received(self) -> int: ...

    def package(self, number: int) -> bytes | None: ...

    def confirm(self, number: int) -> None: ...


@dataclass
class FolderTransport:
    """Files ``msg<number>.xml`` and a file with the number confirmed last; for tests and replays on one machine."""

    folder: str

    def received(self) -> int:
        path = os.path.join(self.folder, "received")
        return int(open(path).read()) if os.path.exists(path) else 0

    def package(self, number: int) -> bytes | None:
        path = os.path.join(self.folder, f"msg{number}.xml")
        return open(path, "rb").read() if os.path.exists(path) else None

    def confirm(self, number: int) -> None:
        with open(os.path.join(self.folder, "received.tmp"), "w") as f:
            f.write(str(number))
        os.replace(f.name, os.path.join(self.folder, "received"))


@dataclass
class HttpTransport:
    """The service's change calls. Answers are read under a size limit and must have the expected root."""

    url: str
    exchange: str
    node: str
    user: str = ""
    password: str = field(default="", repr=False)
    timeout: float = 600.0

    def __post_init__(self):
        if not self.timeout > 0:
            raise ValueError("the timeout has to be positive")
        if self.password and not self.user:
            raise ValueError("a password needs a user")
        if urllib.parse.urlsplit(self.url).scheme not in ("http", "https"):
            raise ValueError("the address has to begin with http:// or https://")
        if not re.fullmatch(r"\w+", self.exchange):
            raise ValueError("the exchange plan's name may have letters, digits and underscores only")

    def _open(self, path: str, post: bool = False, timeout: float | None = None) -> bytes:
        request = urllib.request.Request(f"{self.url.rstrip('/')}/{urllib.parse.quote(path, safe='/()$=&?,%')}", method="POST" if post else "GET")
        if self.user:
            request.add_header("Authorization", "Basic " + base64.b64encode(f"{self.user}:{self.password}".encode()).decode())
        try:
            with urllib.request.urlopen(request, timeout=timeout or self.timeout) as answer:
                declared = answer.headers.get("Content-Length")
                return bounded(iter(lambda: answer.read(CHUNK_BYTES), b""), int(declared) if declared else None)
        except HTTPError as e:  # with what the source says, instead of the bare code
            raise HTTPError(e.url, e.code, error_message(e.read(ERROR_BYTES)), e.headers, None) from None

    def metadata(self) -> bytes:
        return self._open("$metadata")

    def received(self) -> int:
        return received_no(self._open(f"ExchangePlan_{self.exchange}?$format=json"), self.node)

    def package(self, number: int) -> bytes | None:
        body = self._open(f"SelectChanges?DataExchangePoint=ExchangePlan_{self.exchange}(guid'{self.node}')&MessageNo={number}", post=True)
        checked(body, "feed")
        return body

    def confirm(self, number: int) -> None:
        self._open(f"NotifyChangesReceived?DataExchangePoint=ExchangePlan_{self.exchange}(guid'{self.node}')&MessageNo={number}", post=True, timeout=30)


_ENTRY = re.compile(r"<(?:\w+:)?entry\b.*?</(?:\w+:)?entry>", re.S)


def entries(body: bytes) -> Iterator[str]:
    """Raw entries of a package, without the prefix that the feed's own elements may have."""
    text = body.decode("utf-8-sig")
    prefix = feed_prefix(text[:4096])
    for found in _ENTRY.findall(text):
        yield re.sub(rf"(</?){prefix}", r"\1", found) if prefix else found
