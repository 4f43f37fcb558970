"""URLs as browsers parse them (the URL standard), for those outside the simple form that expressions handle.

Only what tables need: a URL against a base, split where keys are made of it. Hosts beyond ASCII are mapped by NFKC and lower case and
written in Punycode; the standard's tables of disallowed code points and the drive letters of ``file`` are left out.
"""

from __future__ import annotations

import ipaddress
import re
import unicodedata
from typing import NamedTuple
from urllib.parse import parse_qsl, unquote_to_bytes

PORTS = {"http": "80", "https": "443", "ws": "80", "wss": "443", "ftp": "21", "file": None}
# --- fixed values: the printable ASCII characters that are escaped in each part, besides controls and all beyond ASCII ---
FRAGMENT = ' "<>`'
QUERY = ' "#<>'
PATH = ' "#<>?^`{}'
USER = ' "#<>?^`{}/:;=@[\\]|'
NOT_IN_HOST = re.compile(r"[\x00-\x20#/:<>?@\[\\\]^|%\x7f]")
NOT_IN_OPAQUE_HOST = re.compile(r"[\x00\t\n\r #/:<>?@\[\\\]^|]")
DOT = re.compile(r"(?i)(?:\.|%2e)\Z")
DOTS = re.compile(r"(?i)(?:\.|%2e){2}\Z")


class Url(NamedTuple):
    """Parts with their marks: query with ``?``, fragment with ``#``, both empty where there are none. ``segments`` is a string for paths that are no list."""

    scheme: str
    user: str
    host: str | None
    port: str
    segments: tuple[str, ...] | str
    query: str
    fragment: str

    @property
    def path(self) -> str:
        return self.segments if isinstance(self.segments, str) else "".join(f"/{s}" for s in self.segments)

    @property
    def head(self) -> str:
        if self.host is None:
            return f"{self.scheme}:" + ("/." if self.path.startswith("//") and not isinstance(self.segments, str) else "")
        return f"{self.scheme}://{self.user}{self.host}{self.port}"


def escape(text: str, chars: str) -> str:
    return "".join(c if " " <= c <= "~" and c not in chars else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in text)


def _number(part: str) -> int | None:
    try:
        if re.match("0[xX]", part):
            return int(part[2:], 16) if re.fullmatch("[0-9a-fA-F]*", part[2:]) and part[2:] else 0 if not part[2:] else None
        if len(part) > 1 and part[0] == "0":
            return int(part, 8) if re.fullmatch("[0-7]+", part) else None
        return int(part) if re.fullmatch("[0-9]+", part) else None
    except ValueError:  # longer than Python reads
        return None


def _ipv4(host: str) -> str | None:
    """Four numbers for a host that ends in one; null if it is none."""
    parts = host.split(".")
    parts = parts[:-1] if parts[-1] == "" and len(parts) > 1 else parts
    numbers = [_number(p) for p in parts]
    if len(parts) > 4 or None in numbers or any(n > 255 for n in numbers[:-1]) or numbers[-1] >= 256 ** (5 - len(parts)):
        return None
    whole = numbers[-1] + sum(n << 8 * (3 - k) for k, n in enumerate(numbers[:-1]))
    return ".".join(str(whole >> s & 255) for s in (24, 16, 8, 0))


def _ipv6(host: str) -> str | None:
    """Eight groups in brackets, the first of the longest runs of zeros left out; null if it is none."""
    try:
        number = int(ipaddress.IPv6Address(host.replace("%", " ")))  # no zones
    except ValueError:
        return None
    groups = [f"{number >> s & 0xFFFF:x}" for s in range(112, -1, -16)]
    runs, k = [], 0
    while k < 8:
        end = k
        while end < 8 and groups[end] == "0":
            end += 1
        runs.append((k - end, k, end))
        k = max(end, k + 1)
    less, lo, hi = min(runs)
    return f"[{':'.join(groups[:lo])}::{':'.join(groups[hi:])}]" if less < -1 else f"[{':'.join(groups)}]"


def _label(label: str) -> str | None:
    if label.isascii():
        if label.startswith("xn--"):
            try:
                if not label[4:] or label[4:].encode("ascii").decode("punycode").isascii():
                    return None
            except (UnicodeError, ValueError, OverflowError):
                return None
        return label
    return "xn--" + label.encode("punycode").decode("ascii")


def _host(raw: str, special: bool) -> str | None:
    """The host in its one form; null if it is none."""
    if raw.startswith("["):
        return _ipv6(raw[1:-1]) if raw.endswith("]") else None
    if not special:
        return None if NOT_IN_OPAQUE_HOST.search(raw) else escape(raw, "")
    try:
        text = unquote_to_bytes(raw).decode("utf-8")
    except UnicodeDecodeError:
        return None
    if not text.isascii():
        text = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", re.sub("[\u00ad\u200b\u2060\ufeff]", "", text)).lower()).replace("。", ".")
    labels = [_label(x) for x in text.lower().split(".")]
    if None in labels:
        return None
    host = ".".join(labels)
    if not host or NOT_IN_HOST.search(host):
        return None
    last = (labels[:-1] if labels[-1] == "" and len(labels) > 1 else labels)[-1]
    return _ipv4(host) if last.isdigit() or (re.match("0x", last) and _number(last) is not None) else host


def _authority(scheme: str, raw: str) -> tuple[str, str | None, str] | None:
    """User with its ``@``, host and port with its ``:`` of what stands between the slashes."""
    special = scheme in PORTS
    user, at, place = raw.rpartition("@")
    if at and (not place or scheme == "file"):
        return None
    if at:
        name, colon, word = user.partition(":")
        user = escape(name, USER) + (f":{escape(word, USER)}" if colon and word else "")
        user = f"{user}@" if user else ""
    m = re.fullmatch(r"(\[[^\]]*\]|[^:\[\]]*)(?::([0-9]*))?", place)
    if m is None or (scheme == "file" and m[2] is not None):
        return None
    if not m[1]:
        if scheme == "file" or (not special and not at and m[2] is None):
            return "", "", ""
        return None
    host = _host(m[1], special)
    port = (m[2] or "").lstrip("0") or ("0" if m[2] else "")
    if host is None or len(port) > 5 or int(port or 0) > 65535:
        return None
    return user, "" if scheme == "file" and host == "localhost" else host, f":{port}" if port and port != PORTS.get(scheme) else ""


def _walk(raw: str, special: bool, before: tuple[str, ...] = ()) -> tuple[str, ...]:
    """The segments of a path, which begins after its first slash, behind those there are; dot segments taken out."""
    out = list(before)
    parts = re.split(r"[/\\]" if special else "/", raw)
    for k, part in enumerate(parts):
        last = k == len(parts) - 1
        if DOTS.match(part):
            out = out[:-1]
        if DOT.match(part) or DOTS.match(part):
            if last:
                out.append("")
        else:
            out.append(escape(part, PATH))
    return tuple(out)


def parse(text: str, base: Url | None = None) -> Url | None:
    """The URL of a text, seen from a base where there is one; null where the standard finds none."""
    text = re.sub("[\t\n\r]", "", text.strip("".join(map(chr, range(33)))))
    text, mark, fragment = text.partition("#")
    fragment = mark + escape(fragment, FRAGMENT) if mark else ""
    m = re.match(r"([a-zA-Z][a-zA-Z0-9+.-]*):", text)
    scheme, rest = (m[1].lower(), text[m.end() :]) if m else ("", text)
    if not m or (scheme in PORTS and base is not None and base.scheme == scheme and not re.match(r"[/\\]{2}", rest) and not isinstance(base.segments, str)):
        if base is None:
            return None
        if isinstance(base.segments, str):
            return base._replace(fragment=fragment) if mark and not rest else None
        return _relative(rest, base, fragment)
    special = scheme in PORTS
    rest, mark, query = rest.partition("?")
    query = mark + escape(query, QUERY + "'" * special) if mark else ""
    if scheme == "file":
        slashes = re.match(r"[/\\]{0,2}", rest).end()
        place, path = _split(rest[slashes:], special) if slashes == 2 else ("", re.sub(r"^[/\\]", "", rest))
        found = _authority(scheme, place)
        return found and Url(scheme, *found, _walk(path or "", special), query, fragment)
    if special or rest.startswith("//"):
        place, path = _split(re.sub(r"^[/\\]*" if special else "^//", "", rest), special)
        found = _authority(scheme, place)
        if found is None:
            return None
        return Url(scheme, *found, _walk(path or "", special) if special or path is not None else (), query, fragment)
    if rest.startswith("/"):
        return Url(scheme, "", None, "", _walk(rest[1:], False), query, fragment)
    return Url(scheme, "", None, "", escape(rest, ""), query, fragment)


def _split(rest: str, special: bool) -> tuple[str, str | None]:
    """What stands before the path, and the path without its first slash; null for no slash."""
    m = re.search(r"[/\\]" if special else "/", rest)
    return (rest, None) if m is None else (rest[: m.start()], rest[m.end() :])


def _relative(rest: str, base: Url, fragment: str) -> Url | None:
    special = base.scheme in PORTS
    slash = r"[/\\]" if special else "/"
    rest, mark, query = rest.partition("?")
    query = mark + escape(query, QUERY + "'" * special) if mark else ""
    if re.match(slash * 2, rest):
        place, path = _split(re.sub(f"^{slash}*" if special and base.scheme != "file" else f"^{slash * 2}", "", rest), special)
        found = _authority(base.scheme, place)
        return found and Url(base.scheme, *found, _walk(path or "", special) if special or path is not None else (), query, fragment)
    if re.match(slash, rest):
        return base._replace(segments=_walk(rest[1:], special), query=query, fragment=fragment)
    if rest:
        return base._replace(segments=_walk(rest, special, base.segments[:-1]), query=query, fragment=fragment)
    return base._replace(query=query if mark else base.query, fragment=fragment)


def without_campaigns(query: str) -> str:
    """The query without ``utm_`` parameters; written anew only if there are any."""
    pairs = parse_qsl(query[1:], keep_blank_values=True, encoding="utf-8", errors="replace", separator="&")
    kept = [(k, v) for k, v in pairs if not k.startswith("utm_")]
    if len(kept) == len(pairs):
        return query
    return "?" + "&".join("=".join(escape(x, "!\"#$%&'()+,/:;<=>?@[\\]^`{|}~").replace(" ", "+") for x in pair) for pair in kept) if kept else ""


def split(text: str, base: Url | None) -> tuple[str, ...] | None:
    """Head, host, path, query, query without campaigns and fragment."""
    url = parse(text, base)
    return url and (url.head, url.host or "", url.path, url.query, without_campaigns(url.query), url.fragment)
