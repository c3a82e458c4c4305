"""Secrets confirmed by structure (operator 2).

Three fixed patterns give the base spans. On top, long base64 and hex runs and
dotted tokens are decoded and parsed; they are reported only if what they hold
has the inner structure of a secret:

* ``jwt``: three dotted base64url parts, a JSON header that names an algorithm, a
  JSON payload, and a signature (which only the algorithm "none" may lack);
* ``key``: base64, hex or a PEM body that is a private key: a DER sequence whose
  nested lengths fill it exactly and whose fields are those of a PKCS#1, PKCS#8,
  SEC1 or DSA key, or an OpenSSH key whose length-prefixed fields fill it; or a PEM
  body that its headers call encrypted, in whole cipher blocks.

Base64 is read in both alphabets and over line ends, plain or escaped as in JSON.
What decodes to text is searched again; a run that holds a secret is one.

Spans are kind:start:end in code points, end exclusive, by start and then kind.

Defined results: null text counts as empty and has no spans; equal rows give
equal rows; an empty table gives an empty one; spans of different kinds may
overlap; other columns are ignored by ``find`` and kept by ``redact``.
"""

from __future__ import annotations

import base64
import binascii
import bisect
import hashlib
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "jwt", "key")
BASE = KINDS[:3]
#: The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
_NAMES = ("passw", "secret", "token", "api")
#: Candidates of the structural checks.
_LONG = re.compile(r"[^\x20\x09-\x0D]{32,}")
_DOTTED = re.compile(r"(?<![\w.-])[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{2,}\.[A-Za-z0-9_-]*", re.A)
_BASE64 = re.compile(r"(?:(?<![A-Za-z0-9+/_\\-])|(?<=\\[nrt]))[A-Za-z0-9+/_-]{32,}={0,2}")
_HEXES = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{32,}")
_PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----((?:(?!-----)[\s\S])++)-----END \1-----", re.A)
_LINE_END = re.compile(r"(?:\\+[nr]|[\r\n])+")
_HEADER = re.compile(r"\s*([A-Za-z0-9-]+):\s*(.*?)\s*")
_CIPHER = re.compile(r"([A-Za-z0-9-]+),([0-9A-Fa-f]{16,32})")
#: How base64 of a DER sequence, an OpenSSH key, a PEM text and a token begins.
_START = re.compile(r"M[A-P][A-Za-z0-9+/_-]|b3BlbnNza|LS0tLS1C|ZXlK")
#: Base64, an escaped slash or plus, a line end.
_PART = re.compile(r"([A-Za-z0-9+/_-]+)|\\+(/|u002[bBfF])|(?:\\+[nrt]|[\x20\t]*[\r\n])+[\x20\t]*")
_PAD = re.compile(r"(?:=|\\+u003[dD]){0,2}")
_INSIDE, _ESCAPED = re.compile(r"[A-Za-z0-9+/_\\-]"), re.compile(r"\\[nrt]")
_URL = str.maketrans("-_", "+/")

_INTEGER, _OCTETS, _OID, _SEQUENCE = 0x02, 0x04, 0x06, 0x30
_OPENSSH = b"openssh-key-v1\0"


def _fields(data: bytes) -> list[tuple[int, bytes]] | None:
    """The (tag, content) pairs that fill ``data`` exactly, else None."""
    at, found = 0, []
    while at < len(data):
        if len(data) - at < 2:
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if size >= 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or len(data) - at < n or data[at] == 0:
                return None
            size, at = int.from_bytes(data[at : at + n], "big"), at + n
            if size < 0x80:
                return None
        if len(data) - at < size:
            return None
        found.append((tag, data[at : at + size]))
        at += size
    return found


def is_der_key(data: bytes) -> bool:
    outer = _fields(data) if data[:1] == bytes([_SEQUENCE]) else None
    if not outer or len(outer) != 1:
        return False
    inner = _fields(outer[0][1]) or []
    tags = [t for t, _ in inner]
    if len(inner) >= 9 and tags[:9] == [_INTEGER] * 9:  # PKCS#1: version, modulus, exponents, primes
        return inner[0][1] in (b"\0", b"\1") and len(inner[1][1]) >= 32 and len(inner[3][1]) * 2 >= len(inner[1][1])
    if tags == [_INTEGER] * 6:  # DSA: version, p, q, g, public and private number
        p, q, g, y, x = (len(c) for _, c in inner[1:])
        return inner[0][1] == b"\0" and p >= 64 and 20 <= q <= 33 and max(g, y) <= p and 1 <= x <= q
    if tags[:3] == [_INTEGER, _SEQUENCE, _OCTETS]:  # PKCS#8: version, algorithm, key
        algorithm = _fields(inner[1][1])
        return inner[0][1] in (b"\0", b"\1") and bool(algorithm) and algorithm[0][0] == _OID and len(inner[2][1]) >= 16
    if tags[:2] == [_SEQUENCE, _OCTETS] and len(tags) == 2:  # PKCS#8, encrypted
        algorithm = _fields(inner[0][1])
        return bool(algorithm) and algorithm[0][0] == _OID and len(algorithm) == 2 and len(inner[1][1]) >= 16
    if tags[:2] == [_INTEGER, _OCTETS]:  # SEC1: version, scalar, parameters
        return inner[0][1] == b"\1" and 16 <= len(inner[1][1]) <= 72 and all(t in (0xA0, 0xA1) for t in tags[2:])
    return False


def _openssh_size(data: bytes) -> int:
    """Bytes of the OpenSSH key that ``data`` begins with, 0 if there is none."""
    if not data.startswith(_OPENSSH):
        return 0
    at = len(_OPENSSH)

    def chunk(at: int) -> int:
        end = at + 4 + int.from_bytes(data[at : at + 4], "big")
        return end if at + 4 <= end <= len(data) and at + 4 <= len(data) else -1

    for _ in range(3):  # cipher, derivation, its options
        at = chunk(at)
        if at < 0:
            return 0
    keys, at = int.from_bytes(data[at : at + 4], "big"), at + 4
    for _ in range(min(keys, 64) + 1):  # public keys, then the private ones
        at = chunk(at)
        if at < 0:
            return 0
    return at if keys >= 1 else 0


def is_openssh_key(data: bytes) -> bool:
    return _openssh_size(data) == len(data) > 0


def _der_size(data: bytes) -> int:
    """Bytes of the DER sequence that ``data`` begins with, by its header; 0 if it has none."""
    n = data[1] & 0x7F if len(data) > 1 and data[1] >= 0x80 else 0
    if len(data) < 2 + n or data[0] != _SEQUENCE or n > 4:
        return 0
    return 2 + n + (int.from_bytes(data[2 : 2 + n], "big") if n else data[1])


def is_key(data: bytes) -> bool:
    return is_der_key(data) or is_openssh_key(data)


def _unbase64(text: str, url: bool = False) -> bytes | None:
    text = text.rstrip("=")
    try:
        padded = (text + "=" * (-len(text) % 4)).encode()
        return base64.b64decode(padded, altchars=b"-_" if url else None, validate=True)
    except (binascii.Error, ValueError):
        return None


def _object(part: str) -> dict | None:
    raw = _unbase64(part, url=True)
    try:
        made = json.loads(raw) if raw else None
    except (ValueError, RecursionError):
        return None
    return made if isinstance(made, dict) else None


def is_signed_token(text: str) -> bool:
    header, payload, signature = text.split(".")
    head = _object(header)
    if not head or not isinstance(head.get("alg"), str) or _object(payload) is None:
        return False
    if head["alg"].lower() == "none":
        return True
    return len(_unbase64(signature, url=True) or b"") >= 16


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns."""
    found = []
    low = text.lower()
    if any(n in low for n in _NAMES):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    return found + [(m.start(), 2, m.end()) for m in HEX.finditer(text)]


def is_pem_body(body: str) -> bool:
    """Whether the lines between a PEM text's marks hold a private key."""
    headers, lines = {}, []
    for line in _LINE_END.split(body):
        if not lines and (m := _HEADER.fullmatch(line)):
            headers[m[1].lower()] = m[2]
        elif line.strip():
            lines.append(line)
    joined = "".join("".join(m[1] or ("+" if m[2].lower() == "u002b" else "/") if m[1] or m[2] else "" for m in _PART.finditer(x)) for x in lines)
    plain = re.sub(r"\\+(?:/|t|u002[bBfF]|u003[dD])|[A-Za-z0-9+/_=\s-]", "", "".join(lines))
    data = None if plain else _unbase64(joined.translate(_URL))
    if not data:
        return False
    if "ENCRYPTED" in headers.get("proc-type", "").upper():
        m = _CIPHER.fullmatch(headers.get("dek-info", ""))
        return bool(m) and len(data) >= 16 and len(data) % 8 == 0
    return is_key(data)


def _held(data: bytes) -> int | None:
    """Kind of the secret that decoded bytes are or, as text, hold."""
    if is_key(data):
        return 4
    try:
        text = data.decode()
    except UnicodeDecodeError:
        return None
    return max((k for _, k, _ in confirmed_spans(text)), default=None)


def _joined(text: str, at: int, need: int | None = None) -> tuple[str, list[tuple[int, int, int, int]]]:
    """Base64 from ``at`` over line ends, up to ``need`` characters, and (place, start and end in the text, size) of its parts."""
    parts, where, n = [], [], 0
    while (need is None or n < need) and (m := _PART.match(text, at)):
        part = m[1] or (m[2] and ("+" if m[2].lower() == "u002b" else "/")) or ""
        if part:
            where.append((n, m.start(), m.end(), len(part)))
            parts.append(part)
            n += len(part)
        at = m.end()
    return "".join(parts).translate(_URL), where


def _place(where: list[tuple[int, int, int, int]], k: int) -> tuple[int, int]:
    """Where the k-th joined character starts and ends in the text; an escape is one character."""
    place, start, end, size = where[bisect.bisect_right(where, k, key=lambda x: x[0]) - 1]
    return (start, end) if size == 1 else (start + k - place, start + k - place + 1)


def _wrapped(text: str) -> list[tuple[int, int, int]]:
    """Secrets in base64 that may be escaped or cut over lines, by where their own lengths end."""
    found, upto = [], 0
    for m in _START.finditer(text):
        at = m.start()
        if at < upto or _INSIDE.fullmatch(text, at - 1 if at else 0, at) and not _ESCAPED.fullmatch(text, max(0, at - 2), at):
            continue
        found_here = []
        if m[0][0] == "M":
            head = _unbase64(_joined(text, at, 12)[0][:12]) or b""
            size = _der_size(head)
            chars = (size * 8 + 5) // 6
            first = head[2 + (head[1] & 0x7F) * (head[1] >= 0x80) :][:1] if size else b""
            if size < 24 or chars > len(text) - at or first not in (bytes([_INTEGER]), bytes([_SEQUENCE])):
                continue
            body, where = _joined(text, at, chars)
            data = _unbase64(body[:chars]) if len(body) >= chars else None
            if data and is_key(data):
                found_here.append((0, 4, chars))
        else:
            body, where = _joined(text, at)
            data = _unbase64(body[: len(body) - (len(body) % 4 == 1)]) or b""
            if size := _openssh_size(data):
                found_here.append((0, 4, (size * 8 + 5) // 6))
            elif not data.startswith(_OPENSSH):
                spans = confirmed_spans(data.decode("latin-1"))
                found_here += [(s * 4 // 3, k, (e * 8 + 5) // 6) for s, k, e in spans]
            upto = where[-1][2]
        for s, k, e in found_here:
            start, end = _place(where, s)[0], _place(where, e - 1)[1]
            if m[0][0] in "Mb" and _INSIDE.match(text, end) and text[end] != "\\":
                continue
            end = _PAD.match(text, end).end()
            found.append((start, k, end))
            upto = max(upto, end)
    return found


def confirmed_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of what the structural checks confirm."""
    found = []
    if "-----BEGIN" in text:
        found = [(m.start(), 4, m.end()) for m in _PEM.finditer(text) if is_pem_body(m[2])]
    inside = [(s, e) for s, _, e in found]
    keys = [x for x in _wrapped(text) if not any(s < x[2] and x[0] < e for s, e in inside)]
    for long in _LONG.finditer(text):
        at, end = long.span()
        if any(s <= at and end <= e for s, e in inside):
            continue
        found += [(m.start(), 3, m.end()) for m in _DOTTED.finditer(text, at, end) if is_signed_token(m[0])]
        held = inside + [(s, e) for s, _, e in keys]
        runs = [(m, bytes.fromhex(m[0])) for m in _HEXES.finditer(text, at, end) if len(m[0]) % 2 == 0]
        runs += [(m, _unbase64(m[0].translate(_URL))) for m in _BASE64.finditer(text, at, end)]
        for m, data in runs:
            if data and not any(s < m.end() and m.start() < e for s, e in held) and (kind := _held(data)) is not None:
                keys.append((m.start(), kind, m.end()))
                held.append(m.span())
    return found + keys


def _written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


RESULT = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_jwt long, n_key long"


def find(docs: DataFrame) -> DataFrame:
    """Counts and spans of every document's secrets."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                base = base_spans(text or "")
                more = confirmed_spans(text or "")
                counts = [sum(k == kind for _, k, _ in base + more) for kind in range(len(KINDS))]
                digest = hashlib.sha256(_written(base).encode()).hexdigest()
                rows.append((doc_id, *counts[:3], digest, _written(base + more), *counts[3:]))
            names = [c.split()[0] for c in RESULT.split(", ")]
            made = pd.DataFrame(rows, columns=names)
            made["doc_id"] = batch["doc_id"].astype("Int64").to_numpy() if len(rows) else made["doc_id"]
            yield made

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInPandas(scan, RESULT)


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """Documents with every span replaced by ``mark``, overlapping ones by a single mark.

    Columns stay as they were, but for ``n_chars`` where there is one: it is the
    new length of a changed text.
    """

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        def one(text: str | None) -> str | None:
            if not text:
                return text
            spans = sorted((s, e) for s, _, e in base_spans(text) + confirmed_spans(text))
            out, upto = [], 0
            for s, e in spans:
                if s >= upto:
                    out += [text[upto:s], mark]
                upto = max(upto, e)
            return "".join(out) + text[upto:] if spans else text

        return texts.map(one, na_action="ignore")

    # The row goes along as one struct, so its columns may have any names.
    made = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), clean(F.col("text")).alias("clean"))
    changed = ~F.col("clean").eqNullSafe(F.col("row").getField("text"))

    def column(name: str) -> Column:
        if name.lower() == "text":
            return F.col("clean")
        same = F.col("row").getField(name)
        return F.when(changed, F.length("clean").cast("long")).otherwise(same) if name.lower() == "n_chars" else same

    return made.select(*[column(c).alias(c) for c in docs.columns])


def op2_secrets(spark, sf_dir: str) -> DataFrame:
    return find(spark.read.parquet(f"{sf_dir}/documents.parquet"))
