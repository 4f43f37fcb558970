"""The URL standard's parser, state by state and character by character, to compare with; hosts beyond ASCII and percent signs in hosts are left to the caller."""

import re

PORTS = {"http": 80, "https": 443, "ws": 80, "wss": 443, "ftp": 21}


def enc(c, also):
    return c if 0x20 < ord(c) < 0x7F and c not in also else "".join(f"%{b:02X}" for b in c.encode())


FRAG, QUERY, PATH = '"<>`', '"#<>', '"#<>?^`{}'
USER = PATH + "/:;=@[\\]|"


def number4(part):
    if part == "":
        return None
    base = 10
    if part[:2] in ("0x", "0X"):
        part, base = part[2:], 16
    elif len(part) > 1 and part[0] == "0":
        part, base = part[1:], 8
    if part == "":
        return 0
    digits = "0123456789abcdef"[:base]
    out = 0
    for c in part.lower():
        if c not in digits:
            return None
        out = out * base + digits.index(c)
    return out


def host4(host):
    parts = host.split(".")
    if parts[-1] == "" and len(parts) > 1:
        parts.pop()
    last = parts[-1]
    if not (last and all(c in "0123456789" for c in last)) and not (last[:2] in ("0x", "0X") and number4(last) is not None):
        return host
    ns = [number4(p) for p in parts]
    if len(ns) > 4 or any(n is None for n in ns) or any(n > 255 for n in ns[:-1]) or ns[-1] >= 256 ** (5 - len(ns)):
        return None
    ip = ns[-1]
    for k, n in enumerate(ns[:-1]):
        ip += n * 256 ** (3 - k)
    return ".".join(str(ip // 256**k % 256) for k in (3, 2, 1, 0))


def host_of(text, special):
    if not special:
        return None if any(c in "\0\t\n\r #/:<>?@[\\]^|" for c in text) else "".join(enc(c, "") for c in text)
    text = text.lower()
    if text == "" or any(ord(c) <= 0x20 or c in '#/:<>?@[\\]^|%\x7f' for c in text):
        return None
    return host4(text)


def parse(text, base=None):
    """(scheme, user with @, host, port, path list or string, query, fragment) or None; ``base`` is such a tuple."""
    text = text.strip("".join(chr(k) for k in range(33)))
    text = "".join(c for c in text if c not in "\t\n\r")
    scheme, user, host, port, path, query, fragment = "", None, None, None, [], None, None
    state, buffer, i, at_seen, inside = "scheme start", "", 0, False, False
    while True:
        c = text[i] if i < len(text) else None
        special = scheme in PORTS
        if state == "scheme start":
            if c is not None and re.match("[a-zA-Z]", c):
                buffer, state = c.lower(), "scheme"
            else:
                state, i = "no scheme", i - 1
        elif state == "scheme":
            if c is not None and re.match("[a-zA-Z0-9+.-]", c):
                buffer += c.lower()
            elif c == ":":
                scheme, buffer = buffer, ""
                special = scheme in PORTS
                if special and base is not None and base[0] == scheme:
                    state = "special relative or authority"
                elif special:
                    state = "special authority slashes"
                elif text[i + 1 : i + 2] == "/":
                    state, i = "path or authority", i + 1
                else:
                    path, state = "", "opaque"
            else:
                buffer, state, i = "", "no scheme", -1
        elif state == "no scheme":
            if base is None or (isinstance(base[4], str) and c != "#"):
                return None
            if isinstance(base[4], str):
                scheme, user, host, port, path, query = base[:6]
                fragment, state = "", "fragment"
            else:
                state, i = "relative", i - 1
        elif state == "special relative or authority":
            if c == "/" and text[i + 1 : i + 2] == "/":
                state, i = "authority slashes ignored", i + 1
            else:
                state, i = "relative", i - 1
        elif state == "path or authority":
            if c == "/":
                state = "authority"
            else:
                state, i = "path", i - 1
        elif state == "relative":
            scheme = base[0]
            special = scheme in PORTS
            if c == "/" or (special and c == "\\"):
                state = "relative slash"
            else:
                _, user, host, port, path, query, _ = base
                path = list(path)
                if c == "?":
                    query, state = "", "query"
                elif c == "#":
                    fragment, state = "", "fragment"
                elif c is not None:
                    query, path = None, path[:-1]
                    state, i = "path", i - 1
        elif state == "relative slash":
            if special and c is not None and c in "/\\":
                state = "authority slashes ignored"
            elif c == "/":
                state = "authority"
            else:
                user, host, port = base[1:4]
                state, i = "path", i - 1
        elif state == "special authority slashes":
            if c == "/" and text[i + 1 : i + 2] == "/":
                i += 1
            else:
                i -= 1
            state = "authority slashes ignored"
        elif state == "authority slashes ignored":
            if c is None or c not in "/\\":
                state, i = "authority", i - 1
        elif state == "authority":
            if c == "@":
                at_seen = True
            end = c is None or c in "/?#" or (special and c == "\\")
            if end:
                name, at, rest = buffer.rpartition("@")
                if at and rest == "":
                    return None
                if at:
                    a, _, b = name.partition(":")
                    user = "".join(enc(x, USER) for x in a) + (":" + "".join(enc(x, USER) for x in b) if b else "")
                buffer, state, i = "", "host", i - len(rest) - 1
            else:
                buffer += c
        elif state == "host":
            end = c is None or c in "/?#" or (special and c == "\\")
            if c == ":" and not inside:
                if buffer == "" or (host := host_of(buffer, special)) is None:
                    return None
                buffer, state = "", "port"
            elif end:
                i -= 1
                if special and buffer == "":
                    return None
                if buffer == "" and (at_seen or port is not None):
                    return None
                host = host_of(buffer, special) if buffer else ""
                if host is None:
                    return None
                buffer, state = "", "path start"
            else:
                inside = True if c == "[" else False if c == "]" else inside
                buffer += c
        elif state == "port":
            if c is not None and c in "0123456789":
                buffer += c
            elif c is None or c in "/?#" or (special and c == "\\"):
                if buffer:
                    n = int(buffer)
                    if n > 65535:
                        return None
                    port = None if PORTS.get(scheme) == n else n
                    buffer = ""
                state, i = "path start", i - 1
            else:
                return None
        elif state == "path start":
            if special:
                state = "path"
                if c is None or c not in "/\\":
                    i -= 1
            elif c == "?":
                query, state = "", "query"
            elif c == "#":
                fragment, state = "", "fragment"
            elif c is not None:
                state = "path"
                if c != "/":
                    i -= 1
        elif state == "path":
            slash = c == "/" or (special and c == "\\")
            if c is None or slash or c in "?#":
                low = buffer.lower().replace("%2e", ".")
                if low == "..":
                    path = path[:-1]
                    if not slash:
                        path = [*path, ""]
                elif low == ".":
                    if not slash:
                        path = [*path, ""]
                else:
                    path = [*path, buffer]
                buffer = ""
                if c == "?":
                    query, state = "", "query"
                if c == "#":
                    fragment, state = "", "fragment"
            else:
                buffer += enc(c, PATH)
        elif state == "opaque":
            if c == "?":
                query, state = "", "query"
            elif c == "#":
                fragment, state = "", "fragment"
            elif c is not None:
                path += c if 0x20 <= ord(c) < 0x7F else enc(c, "")
        elif state == "query":
            if c == "#":
                fragment, state = "", "fragment"
            elif c is not None:
                query += enc(c, QUERY + ("'" if special else ""))
        elif state == "fragment" and c is not None:
            fragment += enc(c, FRAG)
        if c is None and i >= len(text):
            return scheme, user, host, port, path, query, fragment
        i += 1


def text_of(url):
    if url is None:
        return None
    scheme, user, host, port, path, query, fragment = url
    way = path if isinstance(path, str) else "".join("/" + p for p in path)
    head = f"{scheme}:" + ("/." if host is None and way.startswith("//") else "") if host is None else f"{scheme}://" + (f"{user}@" if user else "") + host + ("" if port is None else f":{port}")
    return head + way + ("" if query is None else f"?{query}") + ("" if fragment is None else f"#{fragment}")
