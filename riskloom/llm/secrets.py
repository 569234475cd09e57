"""Operator 11: secrets by pattern, and by the structure of what base64 or hex decodes to.

Patterns find assignments, access ids and hex runs. The method goes over base64 and hex
candidates: it reads their first bytes where a key's header may begin, follows nested lengths
to the end and reports what parses, from its first to its last encoded character:

* ``key``: a private key. DER sequences whose lengths nest exactly and whose fields are those
  of PKCS #1, PKCS #8 (plain or encrypted) or SEC 1; OpenSSH's format by its length-prefixed
  strings. Base64 may be broken into lines; hex may be of either case. A candidate that
  decodes to text with such a key in armour counts as a key as well.
* ``jwt``: a signed token of three base64url parts: a JSON header with an ``alg`` other than
  none, a JSON payload, and a signature of the length that the algorithm gives.

Only headers are decoded while lengths are followed, so a long candidate costs what its
headers cost. Null and empty texts have no spans; each row has its own result, repeated rows
too; a null ``doc_id`` stays null; other columns do not matter; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import binascii
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import ship

#: fixed values: the kinds in their order, and the base patterns with the least length that counts
KINDS = ["assign", "access", "hex", "key", "jwt"]
BASE = [
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
]
#: fixed values: bytes of the signatures of JSON web algorithms; RSA ones have their modulus' length
SIGNATURE = {"HS256": (32,), "HS384": (48,), "HS512": (64,), "ES256": (64,), "ES256K": (64,), "ES384": (96,),
             "ES512": (132,), "EdDSA": (64, 114)}
RSA_SIGNATURE = {"RS256", "RS384", "RS512", "PS256", "PS384", "PS512"}
OPENSSH = b"openssh-key-v1\0"

_BASE = [(kind, re.compile(pattern, re.ASCII), group, least) for kind, pattern, group, least in BASE]
# a run of base64 letters, broken by at most a line end (as it is or escaped) and its indentation at a time
_BASE64 = re.compile(r"[A-Za-z0-9+/]{16,}(?:[ \t]*(?:\r?\n|(?:\\r)?\\n)[ \t]*[A-Za-z0-9+/]+)*={0,2}")
_HEX = re.compile(r"[0-9A-Fa-f]{40,}")
_JWT = re.compile(r"eyJ[A-Za-z0-9_-]*\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+")
_STARTS = re.compile("M[A-P]|b3BlbnNzaC1rZXktdjEA|LS0tLS1CRUdJTi")
_HEX_STARTS = re.compile(r"(?=30[0-8]|6f70656e7373682d6b65792d763100|2d2d2d2d2d424547494e20)", re.I)
_ARMOUR = re.compile(rb"-----BEGIN ((?:[A-Z0-9]+ )*)PRIVATE KEY-----\s")
_BREAK = re.compile(r"(?:[ \t\r\n]|\\r|\\n)+")


class _Encoded:
    """Bytes of an encoded run, decoded where they are read."""

    def __init__(self, text: str, start: int, hexadecimal: bool = False):
        self.text, self.start, self.hex = text, start, hexadecimal
        left = len(text) - start
        self.size = left // 2 if hexadecimal else left * 3 // 4

    def read(self, a: int, b: int) -> bytes:
        b = min(b, self.size)
        if a >= b:
            return b""
        if self.hex:
            return bytes.fromhex(self.text[self.start + 2 * a:self.start + 2 * b])
        first = a // 3
        part = self.text[self.start + 4 * first:self.start + 4 * -(-b // 3)]
        return base64.b64decode(part + "=" * (-len(part) % 4))[a - 3 * first:b - 3 * first]

    def letters(self, n: int) -> int:
        """Encoded letters of the first n bytes."""
        return 2 * n if self.hex else -(-4 * n // 3)


def _header(data: _Encoded, at: int, end: int):
    """(tag, first byte, end) of the DER value at a place, if it lies within ``end``."""
    head = data.read(at, at + 10)
    if len(head) < 2:
        return None
    tag, n, skip = head[0], head[1], 2
    if n >= 0x80:
        k = n & 0x7F
        if not 1 <= k <= 8 or len(head) < 2 + k or head[2] == 0:
            return None  # indefinite, too long or not the shortest form
        n, skip = int.from_bytes(head[2:2 + k], "big"), 2 + k
        if n < 0x80:
            return None
    first = at + skip
    return (tag, first, first + n) if first + n <= end else None


def _fields(data: _Encoded, at: int, end: int, most: int = 16):
    """Headers of the values that fill [at, end) exactly, else None."""
    out = []
    while at < end and len(out) < most:
        field = _header(data, at, end)
        if field is None:
            return None
        out.append(field)
        at = field[2]
    return out if at == end else None


def _algorithm(data: _Encoded, field) -> bool:
    """A sequence that starts with an object identifier."""
    inner = _fields(data, field[1], field[2]) if field[0] == 0x30 else None
    return bool(inner) and inner[0][0] == 0x06 and inner[0][2] > inner[0][1]


def _der_key(data: _Encoded) -> int:
    """Bytes of the private key that starts the data, or 0."""
    whole = _header(data, 0, data.size)
    if whole is None or whole[0] != 0x30:
        return 0
    fields = _fields(data, whole[1], whole[2])
    if not fields or len(fields) < 2:
        return 0
    tags = [f[0] for f in fields]
    version = data.read(fields[0][1], fields[0][2]) if tags[0] == 0x02 and fields[0][2] - fields[0][1] == 1 else None
    rsa = version in (b"\0", b"\1") and len(fields) >= 9 and set(tags[:9]) == {0x02} and all(b > a for _, a, b in fields)
    plain = version in (b"\0", b"\1") and tags[1] == 0x30 and len(fields) >= 3 and tags[2] == 0x04 \
        and set(tags[3:]) <= {0xA0, 0xA1, 0x81} and _algorithm(data, fields[1]) and fields[2][2] > fields[2][1]
    curve = version == b"\1" and tags[1] == 0x04 and set(tags[2:]) <= {0xA0, 0xA1} and fields[1][2] - fields[1][1] >= 16
    dsa = version == b"\0" and len(fields) == 6 and set(tags) == {0x02}
    sealed = tags == [0x30, 0x04] and _algorithm(data, fields[0]) and fields[1][2] - fields[1][1] >= 16
    return whole[2] if rsa or plain or curve or dsa or sealed else 0


def _openssh_key(data: _Encoded) -> int:
    """Bytes of the OpenSSH key that starts the data, or 0: cipher, derivation and options,
    the number of keys, each public key and the private part, all with their lengths."""
    if data.read(0, len(OPENSSH)) != OPENSSH:
        return 0
    at = len(OPENSSH)

    def skip(at):
        n = data.read(at, at + 4)
        end = at + 4 + int.from_bytes(n, "big")
        return end if len(n) == 4 and end <= data.size else None

    for _ in range(3):
        at = skip(at)
        if at is None:
            return 0
    number = int.from_bytes(data.read(at, at + 4), "big")
    if not 1 <= number <= 16:
        return 0
    at += 4
    for _ in range(number + 1):
        begin, at = at, skip(at)
        if at is None or at - begin <= 4:
            return 0
    return at


def _armoured_key(data: _Encoded) -> int:
    """Bytes of the armoured private key that starts the decoded data, or 0. Its body is read
    up to the first byte that armour cannot hold."""
    head = data.read(0, 128)
    found = _ARMOUR.match(head)
    if not found:
        return 0
    at, body = found.end(), b""
    while b"-" not in body and at < data.size:
        more = data.read(at, at + 4096)
        at += len(more)
        body += more
    end = b"-----END " + found[1] + b"PRIVATE KEY-----"
    stop = body.find(b"-")
    if stop < 0:
        return 0
    tail = body[stop:stop + len(end)] + data.read(at, at + len(end))
    inner = re.sub(rb"\s+", b"", body[:stop])
    if not tail.startswith(end) or not re.fullmatch(rb"[A-Za-z0-9+/]+={0,2}", inner):
        return 0
    key = _Encoded(inner.rstrip(b"=").decode(), 0)
    return found.end() + stop + len(end) if _der_key(key) or _openssh_key(key) else 0


def _key_bytes(data: _Encoded) -> int:
    return _der_key(data) or _openssh_key(data) or _armoured_key(data)


def _base64_keys(text: str):
    for run in _BASE64.finditer(text):
        raw = run[0].rstrip("=")
        pads = len(run[0]) - len(raw)
        plain = _BREAK.sub("", raw)
        at = 0
        while found := _STARTS.search(plain, at):
            data = _Encoded(plain, found.start())
            n = _key_bytes(data)
            if not n:
                at = found.start() + 1
                continue
            last = found.start() + data.letters(n)
            a, b = (_unbroken(raw, i) for i in (found.start(), last - 1))
            stop = run.start() + b + 1
            if last == len(plain):  # the padding belongs to the key's last letters
                stop += min(pads, -data.letters(n) % 4)
            yield run.start() + a, stop
            at = last


def _unbroken(raw: str, i: int) -> int:
    """Place in a broken run of its i-th letter."""
    at = 0
    for gap in _BREAK.finditer(raw):
        if i < gap.start() - at:
            break
        at += gap.end() - gap.start()
    return i + at


def _hex_keys(text: str):
    for run in _HEX.finditer(text):
        at = 0
        while found := _HEX_STARTS.search(run[0], at):
            data = _Encoded(run[0], found.start(), True)
            n = _key_bytes(data)
            if n:
                yield run.start() + found.start(), run.start() + found.start() + 2 * n
            at = found.start() + (2 * n or 1)


def _url_decoded(part: str) -> bytes | None:
    if len(part) % 4 == 1:
        return None
    try:
        return base64.b64decode(part + "=" * (-len(part) % 4), altchars=b"-_", validate=True)
    except (binascii.Error, ValueError):
        return None


def _json_object(part: str) -> dict | None:
    raw = _url_decoded(part)
    if raw is None or raw[:1] != b"{":
        return None
    try:
        value = json.loads(raw)
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def _signed(token: str) -> bool:
    header, payload, signature = token.split(".")
    head = _json_object(header)
    alg = head.get("alg") if head else None
    if not isinstance(alg, str) or _json_object(payload) is None:
        return False
    sig = _url_decoded(signature)
    if sig is None:
        return False
    return len(sig) in SIGNATURE.get(alg, ()) or alg in RSA_SIGNATURE and len(sig) >= 64


def find_secrets(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start and then by kind."""
    out = []
    for kind, pattern, group, least in _BASE:
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                out.append((kind, m.start(), m.end()))
    keys = {(a, b) for a, b in _base64_keys(text)} | {(a, b) for a, b in _hex_keys(text)}
    out += [("key", a, b) for a, b in keys]
    out += [("jwt", m.start(), m.end()) for m in _JWT.finditer(text) if _signed(m[0])]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _scan(batches):
    for batch in batches:
        spans = [[{"kind": k, "start": a, "end": b} for k, a, b in find_secrets(t.as_py() or "")] for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, _SPAN)], names=["doc_id", "spans"])


def secret_spans(docs: DataFrame) -> DataFrame:
    """``(doc_id, spans)`` per row; a span has kind, start and end (code points, end exclusive)."""
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _scan, "doc_id long, spans array<struct<kind: string, start: bigint, end: bigint>>")
