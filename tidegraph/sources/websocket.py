"""The live transport: requests to relays over websockets (RFC 6455), with the standard library alone."""

from __future__ import annotations

import base64
import hashlib
import json
import os
import socket
import ssl
import struct
import time
from urllib.parse import urlsplit

from .relay import FetchTimeout, RelayError

#: Appended to a handshake's key before it is hashed (a fixed value).
GUID = b"258EAFA5-E914-47DA-95CA-C5AB0DC85B11"
CONTINUED, TEXT, BINARY, CLOSE, PING, PONG = 0x0, 0x1, 0x2, 0x8, 0x9, 0xA
#: Bytes that a message may have, and seconds for connecting.
LARGEST, CONNECT_SECONDS = 16 << 20, 10.0


class WebSocket:
    def __init__(self, url: str, seconds: float = CONNECT_SECONDS):
        at = urlsplit(url)
        if at.scheme not in ("ws", "wss") or not at.hostname:
            raise ConnectionError(f"not a relay: {url}")
        port = at.port or (443 if at.scheme == "wss" else 80)
        self.socket = socket.create_connection((at.hostname, port), timeout=seconds)
        if at.scheme == "wss":
            self.socket = ssl.create_default_context().wrap_socket(self.socket, server_hostname=at.hostname)
        self.read = self.socket.makefile("rb")
        key = base64.b64encode(os.urandom(16))
        path = (at.path or "/") + (f"?{at.query}" if at.query else "")
        self.socket.sendall(f"GET {path} HTTP/1.1\r\nHost: {at.netloc}\r\nUpgrade: websocket\r\nConnection: Upgrade\r\nSec-WebSocket-Key: {key.decode()}\r\nSec-WebSocket-Version: 13\r\n\r\n".encode())
        status, headers = self.read.readline(4096), {}
        while (line := self.read.readline(4096)).strip():
            name, _, value = line.partition(b":")
            headers[name.strip().lower()] = value.strip()
        if status.split()[1:2] != [b"101"] or headers.get(b"sec-websocket-accept") != base64.b64encode(hashlib.sha1(key + GUID).digest()):
            self.close()
            raise ConnectionError(f"no websocket: {url}")

    def close(self) -> None:
        self.read.close()
        self.socket.close()

    def send(self, data: bytes, code: int = TEXT) -> None:
        size = len(data)
        head = bytes([0x80 | code]) + (bytes([0x80 | size]) if size < 126 else struct.pack("!BH", 0xFE, size) if size < 1 << 16 else struct.pack("!BQ", 0xFF, size))
        mask = os.urandom(4)
        masked = bytes(a ^ b for a, b in zip(data, mask * (size // 4 + 1), strict=False))
        self.socket.sendall(head + mask + masked)

    def _exactly(self, n: int) -> bytes:
        data = self.read.read(n)
        if len(data) < n:
            raise ConnectionError("closed")
        return data

    def receive(self) -> str:
        """The next message; pings are answered on the way."""
        whole = b""
        while True:
            first, second = self._exactly(2)
            size = second & 0x7F
            if size >= 126:
                size = int.from_bytes(self._exactly(2 if size == 126 else 8), "big")
            if size + len(whole) > LARGEST:
                raise RelayError("message too large")
            mask = self._exactly(4) if second & 0x80 else b""
            data = self._exactly(size)
            if mask:
                data = bytes(a ^ b for a, b in zip(data, mask * (size // 4 + 1), strict=False))
            code = first & 0x0F
            if code == CLOSE:
                raise ConnectionError("closed by the relay")
            if code == PING:
                self.send(data, PONG)
            elif code in (CONTINUED, TEXT, BINARY):
                whole += data
                if first & 0x80:
                    return whole.decode(errors="replace")


class Live:
    """A connection to one relay: subscriptions one after the other, and the notices that came meanwhile."""

    def __init__(self, url: str):
        self.socket, self.n, self.notices = WebSocket(url), 0, []

    def page(self, authors, kind: int, until: int, limit: int, deadline: float = 30.0) -> list[dict]:
        self.n += 1
        own, end, events = f"s{self.n}", time.monotonic() + deadline, []
        asked = {"authors": list(authors), "kinds": [kind], "until": min(until, (1 << 53) - 1), "limit": limit}
        try:
            self.socket.send(json.dumps(["REQ", own, asked]).encode())
            while True:
                left = end - time.monotonic()
                if left <= 0:
                    raise FetchTimeout("no end of stored events")
                self.socket.socket.settimeout(left)
                message = json.loads(self.socket.receive())
                match message:
                    case ["EVENT", sub, dict(event)] if sub == own:
                        events.append(event)
                        if len(events) > 4 * max(1, limit):
                            raise RelayError("more events than asked for")
                    case ["EOSE", sub, *_] if sub == own:
                        self.socket.send(json.dumps(["CLOSE", own]).encode())
                        return events
                    case ["NOTICE", str(text), *_]:
                        self.notices.append(text)
                    case ["CLOSED", sub, *text]:
                        self.notices += [str(t) for t in text[:1]]
                        if sub == own:
                            raise RelayError("subscription closed")
        except TimeoutError as e:
            raise FetchTimeout("no answer") from e


def connect(url: str) -> Live:
    return Live(url)
