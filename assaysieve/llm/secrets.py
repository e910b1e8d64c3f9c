"""Secret scans: patterns find candidates, and their structure confirms them.

Assignments, access keys and long hex runs are reported by their pattern. Base64 and hex runs are decoded, and reported only when the bytes are
a private key whose nested lengths fit exactly, or a signed token whose header names its algorithm.
"""

import base64
import binascii
import json
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaysieve.llm.text import LOWER, per_text

KINDS = ["assign", "access", "hex", "token", "key", "pem"]
ASSIGN = re.compile(rb"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{24,}")
TOKEN = re.compile(rb"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]*)")
BASE64 = re.compile(rb"[A-Za-z0-9+/_-]{32,}={0,2}")
HEX_KEY = re.compile(rb"(?<![0-9A-Fa-f])[0-9A-Fa-f]{64,}")
PEM = re.compile(rb"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----([A-Za-z0-9+/=\s]*)-----END \1-----")
OPENSSH = b"openssh-key-v1\0"
SCHEMA = "spans array<struct<kind:string,begin:bigint,end:bigint>>"

_BASE64_RUN = bytes(0x78 if chr(c).isalnum() and c < 0x80 or chr(c) in "+/_-" else 0x20 for c in range(256))
_HEX_RUN = bytes(0x78 if chr(c) in "0123456789abcdef" else 0x20 for c in range(256))


def _decoded(run: bytes) -> bytes | None:
    run = run.rstrip(b"=").replace(b"-", b"+").replace(b"_", b"/")
    try:
        return base64.b64decode(run + b"=" * (-len(run) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _parts(data: bytes) -> list[tuple[int, bytes]] | None:
    """Tags and contents of consecutive tag-length-value items, None unless their lengths fill the data exactly."""
    found, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size & 0x80:
            width = size & 0x7F
            if not 1 <= width <= 4 or at + width > len(data):
                return None
            size = int.from_bytes(data[at:at + width], "big")
            at += width
        if at + size > len(data):
            return None
        found.append((tag, data[at:at + size]))
        at += size
    return found


def _openssh(data: bytes) -> bool:
    """Cipher, key derivation and its options, number of keys, then as many public keys and one private part."""
    at, strings = len(OPENSSH), 0
    keys = None
    while at < len(data):
        size = int.from_bytes(data[at:at + 4], "big")
        if strings == 3 and keys is None:
            keys = size
            at += 4
            continue
        at += 4 + size
        strings += 1
    return at == len(data) and keys is not None and keys >= 1 and strings == 4 + keys


def is_private_key(data: bytes | None) -> bool:
    """A private key of PKCS 1 or 8, SEC 1 or the OpenSSH form, all of whose lengths fit."""
    if not data:
        return False
    if data.startswith(OPENSSH):
        return _openssh(data)
    if data[0] != 0x30:
        return False
    outer = _parts(data)
    inner = _parts(outer[0][1]) if outer and len(outer) == 1 else None
    if not inner or len(inner) < 2 or inner[0][0] != 0x02:
        return False
    tags, version = [t for t, _ in inner], inner[0][1]
    if len(inner) >= 9 and tags[:9] == [0x02] * 9:
        return True
    if len(inner) >= 3 and tags[1:3] == [0x30, 0x04]:
        algorithm = _parts(inner[1][1])
        return bool(algorithm) and algorithm[0][0] == 0x06
    return version == b"\x01" and tags[1] == 0x04


def is_token_header(run: bytes) -> bool:
    data = _decoded(run)
    try:
        header = json.loads(data) if data else None
    except ValueError:
        return False
    return isinstance(header, dict) and isinstance(header.get("alg"), str)


def is_claims(run: bytes) -> bool:
    data = _decoded(run)
    try:
        return data is not None and isinstance(json.loads(data), dict)
    except ValueError:
        return False


def _byte_spans(data: bytes) -> list[tuple[int, int, int]]:
    found = []
    lower = data.translate(LOWER)
    if any(word in lower for word in (b"passw", b"secret", b"token", b"apikey", b"api_key")):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(data) if len(m[2]) >= 6]
    if b"AKIA" in data:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(data) if len(m[0]) >= 20]
    if b"x" * 24 in data.translate(_HEX_RUN):
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(data)]
    if b"eyJ" in data:
        found += [(m.start(), 3, m.end()) for m in TOKEN.finditer(data) if is_token_header(m[1]) and is_claims(m[2])]
    if b"x" * 32 in data.translate(_BASE64_RUN):
        found += [(m.start(), 4, m.end()) for m in BASE64.finditer(data) if is_private_key(_decoded(m[0]))]
        found += [(m.start(), 4, m.end()) for m in HEX_KEY.finditer(data) if len(m[0]) % 2 == 0 and is_private_key(bytes.fromhex(m[0].decode()))]
    if b"PRIVATE KEY-----" in data:
        found += [(m.start(), 5, m.end()) for m in PEM.finditer(data) if is_private_key(_decoded(b"".join(m[2].split())))]
    return sorted(set(found))


def find(text: str | None) -> list[tuple[str, int, int]]:
    """Kind, begin and end (exclusive, in code points) of all secrets, by begin and then as the kinds are listed."""
    if not text:
        return []
    data = text.encode()
    spans = _byte_spans(data)
    if len(data) == len(text):
        return [(KINDS[k], a, b) for a, k, b in spans]
    return [(KINDS[k], len(data[:a].decode()), len(data[:b].decode())) for a, k, b in spans]


def _rows(texts: list[str | None]) -> list[tuple]:
    return [([{"kind": k, "begin": a, "end": b} for k, a, b in find(text)],) for text in texts]


def scan(documents: DataFrame, text: str = "text", out: str = "secrets") -> DataFrame:
    """The documents with a struct column `out`, whose `spans` are the secrets. Null and empty texts have none."""
    return documents.withColumn(out, per_text(lambda: _rows, SCHEMA)(F.col(text)))


def _joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"].cast("string"), s["end"].cast("string"))), ",")


def digest(documents: DataFrame) -> DataFrame:
    """Per document: counts of the pattern kinds, the digest of their spans, and all spans."""
    found = scan(documents.select("doc_id", "text"))
    spans = F.col("secrets.spans")

    def count(kind):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter(spans, lambda s: s["kind"].isin(KINDS[:3]))
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(_joined(base), 256).alias("base_sha256"),
                        _joined(spans).alias("spans"))


def _masked(texts: list[str | None]) -> list[tuple]:
    out = []
    for text in texts:
        kept, at = [], 0
        for kind, a, b in find(text):
            if a >= at:
                kept += [text[at:a], f"[{kind}]"]
            at = max(at, b)
        out.append((text if not at else "".join(kept) + text[at:],))
    return out


def mask(documents: DataFrame, text: str = "text") -> DataFrame:
    """The documents with every secret replaced by its kind in brackets; overlapping ones by the first kind. Null stays null."""
    return documents.withColumn(text, per_text(lambda: _masked, "text string")(F.col(text))["text"])
