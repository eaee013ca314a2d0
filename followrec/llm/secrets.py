"""Secret scan with structural confirmation (operator 3).

Base rules find assignments, access ids and hex runs by pattern. Beyond them,
every base64 and hex run that is long enough is decoded and reported only if
its structure holds: private keys must parse as nested length-encoded values
that fill their container exactly and have the layout of a known key encoding,
OpenSSH keys must consist of length-prefixed strings, and signed tokens must
have a header and a claims object in JSON, with an algorithm and a signature. Keys
are also found with escaped line ends (``\\n`` as two characters, as in JSON or
settings files), wrapped over lines of one length without marker lines, and as
base64 of a whole marked key.

Spans are code points, end exclusive. Null and empty texts have no span; a null
doc_id is kept; repeated rows give equal rows. Every pattern runs in time linear in
the text, whatever its words are, so a text of one very long word is no trouble.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: Kinds in the order in which spans with one start are listed.
KINDS = ("assign", "access", "hex", "key", "token")

_ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                     r"""([A-Za-z0-9+/_.=-]+)""", re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")

_PEM = re.compile(r"-----BEGIN ((?:[A-Z0-9]+ ){0,3}PRIVATE KEY)-----"
                  r"((?:[A-Za-z0-9+/=\s]|\\[nr])*)-----END \1-----", re.ASCII)
_BREAK = re.compile(r"\\[nr]|\s", re.ASCII)
_LINE = re.compile(r"[^\n]+")
_BASE64_LINE = re.compile(r"[A-Za-z0-9+/]+={0,2}", re.ASCII)
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{32,}={0,2}", re.ASCII)
_HEX_ANY = re.compile(r"[0-9A-Fa-f]{48,}")
#: A maximal run without dots; what follows it is looked at only when a dot does.
_PART = re.compile(r"[A-Za-z0-9_-]{10,}", re.ASCII)
_CLAIMS = re.compile(r"\.([A-Za-z0-9_-]{2,})\.", re.ASCII)
_SIGNATURE = re.compile(r"[A-Za-z0-9_-]*", re.ASCII)
#: Least length of the lines of a wrapped key.
_WRAPPED = 32

_INTEGER, _OCTETS, _OID, _SEQUENCE = 0x02, 0x04, 0x06, 0x30


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the base rules, leftmost and non-overlapping per kind.

    Maximal runs of a fixed class are matched with their least length in the
    pattern; an assignment whose value is too short is matched and then dropped.
    """
    out = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text)
           if m.end(1) - m.start(1) >= 12]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text)]
    out += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return out


def decode64(run: str) -> bytes | None:
    """Bytes of a base64 or base64url run, padded as needed; None if it is neither."""
    run = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(run) % 4 == 1:
        return None
    try:
        return base64.b64decode(run + "=" * (-len(run) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def elements(data: bytes) -> list[tuple[int, bytes]] | None:
    """Tag and content of consecutive length-encoded values that fill ``data`` exactly."""
    out, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size >= 0x80:
            more = size & 0x7F
            if not 1 <= more <= 4 or at + more > len(data):
                return None
            size = int.from_bytes(data[at:at + more], "big")
            at += more
        if at + size > len(data):
            return None
        out.append((tag, data[at:at + size]))
        at += size
    return out


def is_private_key(data: bytes) -> bool:
    """Whether bytes are one private key: integers only (RSA, DSA), a version
    with an octet string (EC), or version, algorithm and wrapped key."""
    outer = elements(data)
    if not outer or len(outer) != 1 or outer[0][0] != _SEQUENCE:
        return False
    parts = elements(outer[0][1])
    if not parts or parts[0][0] != _INTEGER or len(parts[0][1]) != 1:
        return False
    tags = [t for t, _ in parts]
    if len(tags) in (6, 9) and set(tags) == {_INTEGER} and all(c for _, c in parts):
        return True
    if tags[:2] == [_INTEGER, _OCTETS] and len(parts[1][1]) >= 16:
        return all(t in (0xA0, 0xA1) and elements(c) for t, c in parts[2:])
    if tags[:3] == [_INTEGER, _SEQUENCE, _OCTETS]:
        algorithm = elements(parts[1][1])
        return bool(algorithm and algorithm[0][0] == _OID and elements(parts[2][1]))
    return False


def is_openssh_key(data: bytes) -> bool:
    """The OpenSSH container: magic, three names, a count, public and private parts."""
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic):
        return False
    at, strings = len(magic), 0
    while at < len(data):
        if strings == 3:  # the number of keys stands between names and keys
            at += 4
        if at + 4 > len(data):
            return False
        size = int.from_bytes(data[at:at + 4], "big")
        at += 4 + size
        strings += 1
        if at > len(data):
            return False
    return strings >= 5


def is_signed_token(header: str, claims: str, signature: str) -> bool:
    parts = []
    for run in (header, claims):
        data = decode64(run)
        if data is None or not data.lstrip().startswith(b"{"):
            return False
        try:
            parts.append(json.loads(data))
        except (ValueError, RecursionError):
            return False
    algorithm = parts[0].get("alg")
    return isinstance(algorithm, str) and (bool(decode64(signature)) or algorithm == "none")


def marked_key(text: str) -> re.Match | None:
    """The first key between marker lines in ``text`` whose structure holds."""
    for m in _PEM.finditer(text):
        data = decode64(_BREAK.sub("", m[2]))
        if data and (is_private_key(data) or is_openssh_key(data)):
            return m
    return None


def _is_key(data: bytes | None) -> bool:
    if not data:
        return False
    if data.startswith(b"-----BEGIN "):
        return marked_key(data.decode("latin-1")) is not None
    return data[0] == _SEQUENCE and is_private_key(data) or is_openssh_key(data)


def wrapped_keys(text: str) -> Iterator[tuple[int, int]]:
    """Keys wrapped over lines: lines of one length, the last one as long or shorter."""
    lines: list[re.Match] = []

    def found() -> Iterator[tuple[int, int]]:
        if len(lines) > 1 and _is_key(decode64("".join(x[0] for x in lines))):
            yield lines[0].start(), lines[-1].end()

    for m in _LINE.finditer(text):
        at = m.start() + len(m[0]) - len(m[0].lstrip())
        line = _BASE64_LINE.fullmatch(text, at, at + len(m[0].strip()))
        joins = bool(line and lines) and text.count("\n", lines[-1].end(), line.start()) == 1
        if joins and len(line[0]) <= len(lines[0][0]) == len(lines[-1][0]):
            lines.append(line)
            continue
        yield from found()
        lines = [line] if line and len(line[0]) >= _WRAPPED else []
    yield from found()


def signed_tokens(text: str) -> Iterator[tuple[int, int]]:
    """Three parts joined by dots that decode as header, claims and signature."""
    done = 0
    for header in _PART.finditer(text):
        claims = _CLAIMS.match(text, header.end()) if header.start() >= done else None
        if claims:
            signature = _SIGNATURE.match(text, claims.end())
            if is_signed_token(header[0], claims[1], signature[0]):
                done = signature.end()
                yield header.start(), done


def confirmed_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of keys and signed tokens whose structure was parsed."""
    out: list[tuple[str, int, int]] = []
    if "-----BEGIN " in text:
        for m in _PEM.finditer(text):
            data = decode64(_BREAK.sub("", m[2]))
            if data and (is_private_key(data) or is_openssh_key(data)):
                out.append(("key", m.start(), m.end()))
    if "\n" in text:
        taken = [x[1:] for x in out]
        out += [("key", s, e) for s, e in wrapped_keys(text)
                if not any(a <= s and e <= b for a, b in taken)]
    taken = [x[1:] for x in out]
    for m in _BASE64.finditer(text):
        if _is_key(decode64(m[0])) and not any(
                s <= m.start() and m.end() <= e for s, e in taken):
            out.append(("key", m.start(), m.end()))
    for m in _HEX_ANY.finditer(text):
        if len(m[0]) % 2 == 0 and m[0].startswith("30") and is_private_key(bytes.fromhex(m[0])):
            out.append(("key", m.start(), m.end()))
    return out + [("token", s, e) for s, e in signed_tokens(text)]


def _join(spans: list[tuple[str, int, int]]) -> str:
    ordered = sorted(set(spans), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return ",".join(f"{k}:{s}:{e}" for k, s, e in ordered)


def scan_secrets(docs: DataFrame) -> DataFrame:
    """Span counts, base digest and all spans per row of ``docs(doc_id, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, spans = [], []
            for text in batch.column(1):
                text = text.as_py() or ""
                found = base_spans(text)
                base.append(found)
                spans.append(found + confirmed_spans(text))
            count = [[sum(k == kind for k, _, _ in s) for s in spans] for kind in KINDS]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in count),
                 pa.array([hashlib.sha256(_join(b).encode()).hexdigest() for b in base],
                          pa.string()),
                 pa.array([_join(s) for s in spans], pa.string())],
                ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id bigint, {counts}, base_sha256 string, spans string")
