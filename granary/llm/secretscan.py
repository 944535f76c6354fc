"""Secrets in texts: base patterns, and candidates whose decoded structure proves what they are.

Base spans come from fixed patterns. Besides, every run of base64 or hex characters that is long enough, and every body
between the marks of a private key, is decoded and read as what it claims to be; only what fits to the last byte is
reported, so a long word, a digest or a picture is not:

- private_key: a DER structure whose nested lengths add up at every level and whose fields are those of an RSA, EC, DSA,
  PKCS#8 or encrypted PKCS#8 private key, or an OpenSSH key, whose strings are prefixed by their lengths. Bodies may be
  wrapped over lines, also by an escaped line feed.
- signed_token: three parts joined by dots, of which the first decodes to a JSON object that names a signing algorithm,
  the second to a JSON object, and the third to a signature of a length that this algorithm makes.

Defined results: null is the empty text, without spans; texts are read whole, in time linear in their length; spans of
different kinds may overlap and are all reported; repeated rows get equal spans; an empty table gives an empty result; what
does not decode or fit is not reported; a column named like the output is replaced.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.words import spans as pieces
from granary.session import shipped

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "private_key", "signed_token")
SPANS = "array<struct<kind:string,start:long,end:long,base:boolean>>"
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
LEAST_KEY = 48  # characters of the shortest encoding of a key: an EC key of 256 bits has 32 bytes besides its frame

# --- base patterns ---------------------------------------------------------------------------------------------------

ASSIGN = re.compile(r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*+[:=]\x20*+[\"']?([A-Za-z0-9+/_.=-]++)", re.IGNORECASE | re.ASCII)
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]++")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{%d,}+" % LEAST_HEX)  # shorter runs fail, so only those long enough are matched


def base_spans(text: str, long: bool = True) -> Iterator[tuple[int, int, str]]:
    """long: whether the text may hold a run of LEAST_HEX characters."""
    small = text.lower()
    if any(name in small for name in NAMES):
        for m in ASSIGN.finditer(text):
            if len(m.group(1)) >= LEAST_VALUE:
                yield *m.span(), "assign"
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if len(m.group()) >= LEAST_ACCESS:
                yield *m.span(), "access"
    if long:
        for m in HEX.finditer(text):
            yield *m.span(), "hex"


# --- structures ------------------------------------------------------------------------------------------------------

SEQUENCE, INTEGER, OCTETS, OBJECT = 0x30, 0x02, 0x04, 0x06


def elements(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """(tag, start, end) of the elements that fill data[at:end] exactly, None if they do not. Lengths are in shortest form."""
    out = []
    while at < end:
        if at + 2 > end:
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size >= 0x80:
            octets = size & 0x7F
            if not 1 <= octets <= 4 or at + octets > end:
                return None
            size = int.from_bytes(data[at : at + octets], "big")
            if size < 0x80 or size >> (8 * (octets - 1)) == 0:
                return None
            at += octets
        if at + size > end:
            return None
        out.append((tag, at, at + size))
        at += size
    return out


def sound(data: bytes) -> bool:
    """Whether lengths add up at every level below constructed elements."""
    left = [(0, len(data))]
    while left:
        found = elements(data, *left.pop())
        if found is None:
            return False
        left += [(start, end) for tag, start, end in found if tag & 0x20]
    return True


def is_der_key(data: bytes) -> bool:
    outer = elements(data, 0, len(data))
    if not outer or len(outer) != 1 or outer[0][0] != SEQUENCE or not sound(data):
        return False
    parts = elements(data, *outer[0][1:]) or []
    tags = [tag for tag, *_ in parts]
    inner = lambda k: [tag for tag, *_ in elements(data, *parts[k][1:]) or []]
    if tags[:1] == [INTEGER]:
        version = int.from_bytes(data[parts[0][1] : parts[0][2]], "big")
        if tags == [INTEGER] * 9 and version == 0:  # RSA: modulus, two exponents, two primes, three numbers of theirs
            modulus, first, second = (int.from_bytes(data[a:b], "big") for _, a, b in (parts[1], parts[4], parts[5]))
            return modulus == first * second
        if tags == [INTEGER] * 6 and version == 0:  # DSA
            return True
        if tags[:2] == [INTEGER, OCTETS] and version == 1:  # EC
            return parts[1][2] - parts[1][1] >= 16 and all(tag in (0xA0, 0xA1) for tag in tags[2:])
        if tags[:3] == [INTEGER, SEQUENCE, OCTETS] and version in (0, 1):  # PKCS#8: the algorithm, its key as one element
            return inner(1)[:1] == [OBJECT] and len(inner(2)) == 1 and all(tag in (0xA0, 0xA1, 0x81) for tag in tags[3:])
        return False
    # encrypted PKCS#8: the cipher with its parameters, the encrypted key
    return tags == [SEQUENCE, OCTETS] and inner(0) == [OBJECT, SEQUENCE]


OPENSSH = b"openssh-key-v1\0"


def is_openssh_key(data: bytes) -> bool:
    """Magic bytes; cipher, key derivation and its options; number of keys; that many public keys; the private part."""
    if not data.startswith(OPENSSH):
        return False
    at, keys, strings = len(OPENSSH), 0, 3
    while strings or not keys:
        if not strings:
            keys = int.from_bytes(data[at : at + 4], "big")
            at, strings = at + 4, keys + 1
            if not 1 <= keys <= len(data):
                return False
        size = int.from_bytes(data[at : at + 4], "big")
        at, strings = at + 4 + size, strings - 1
        if at > len(data):
            return False
    return at == len(data)


def is_key(data: bytes) -> bool:
    return is_der_key(data) or is_openssh_key(data)


def from_base64(body: str) -> bytes | None:
    """Decoded standard or URL-safe base64, with or without padding."""
    bare = body.rstrip("=").translate(URL_SAFE)
    if len(body) - len(bare) > 2 or len(bare) % 4 == 1:
        return None
    try:
        return base64.b64decode(bare + "=" * (-len(bare) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


URL_SAFE = str.maketrans("-_", "+/")
# Bytes of the signatures that an algorithm makes; RSA ones are as long as their modulus.
SIGNATURES = {"HS256": 32, "HS384": 48, "HS512": 64, "ES256": 64, "ES256K": 64, "ES384": 96, "ES512": 132}
RSA = ("RS256", "RS384", "RS512", "PS256", "PS384", "PS512")


def json_object(part: str) -> dict | None:
    data = from_base64(part)
    try:
        found = json.loads(data) if data else None
    except (ValueError, RecursionError):
        return None
    return found if isinstance(found, dict) else None


def is_signed_token(header: str, payload: str, signature: str) -> bool:
    named = json_object(header)
    signed = from_base64(signature)
    if not named or not signed or json_object(payload) is None:
        return False
    name, size = named.get("alg"), len(signed)
    if name == "EdDSA":
        return size in (64, 114)
    return SIGNATURES.get(name) == size if isinstance(name, str) and name not in RSA else name in RSA and size >= 128 and size % 8 == 0


# --- candidates ------------------------------------------------------------------------------------------------------

MARKED = re.compile(r"-----BEGIN (?:[A-Z0-9]+ )?PRIVATE KEY-----((?:[A-Za-z0-9+/=\s]|\\[nr])*+)(?:-----END (?:[A-Z0-9]+ )?PRIVATE KEY-----)?")
BREAKS = re.compile(r"\s|\\[nr]")
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{%d,}+={0,2}+(?:(?:\r?\n|\\n)[A-Za-z0-9+/]++={0,2}+)*+" % LEAST_KEY)
URL_RUN = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{%d,}+={0,2}+" % LEAST_KEY)
TOKEN = re.compile(r"(?<![A-Za-z0-9_.-])(eyJ[A-Za-z0-9_-]++)\.([A-Za-z0-9_-]++)\.([A-Za-z0-9_-]++)")
HEX_RUN = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{%d,}+" % (3 * LEAST_KEY // 2))
LINE_END = re.compile(r"\r?\n|\\n")
LONG = re.compile(r"[A-Za-z0-9+/_-]{%d}" % LEAST_HEX)


def by_lines(run: str) -> Iterator[str]:
    """A wrapped candidate whole, without its last line (which may be prose), and its first line alone."""
    yield run
    ends = [m.start() for m in LINE_END.finditer(run)]
    for end in dict.fromkeys([*ends[-1:], *ends[:1]]):
        yield run[:end]


def confirmed(text: str) -> Iterator[tuple[int, int, str]]:
    if "eyJ" in text:
        for m in TOKEN.finditer(text):
            if is_signed_token(*m.groups()):
                yield *m.span(), "signed_token"
    keys: list[tuple[int, int]] = []
    if "PRIVATE KEY" in text:
        for m in MARKED.finditer(text):
            data = from_base64(BREAKS.sub("", m.group(1)))
            if data and is_key(data):
                keys.append((m.start(), m.start() + len(m.group().rstrip())))
    for pattern in (WRAPPED, URL_RUN):
        for m in pattern.finditer(text):
            for body in by_lines(m.group()):
                data = from_base64(BREAKS.sub("", body))
                if data and is_key(data):
                    keys.append((m.start(), m.start() + len(body)))
                    break
    for m in HEX_RUN.finditer(text):
        if len(m.group()) % 2 == 0 and is_key(bytes.fromhex(m.group())):
            keys.append(m.span())
    end = 0
    for start, stop in sorted(set(keys), key=lambda s: (s[0], -s[1])):
        if start >= end:  # the body of a marked key is not reported again
            end = stop
            yield start, stop, "private_key"


def all_spans(text: str) -> list[dict]:
    long = LONG.search(text) is not None
    found = [(start, KINDS.index(kind), end, True) for start, end, kind in base_spans(text, long)]
    if long or "PRIVATE KEY" in text:
        found += [(start, KINDS.index(kind), end, False) for start, end, kind in confirmed(text)]
    return [{"kind": KINDS[kind], "start": start, "end": end, "base": own} for start, kind, end, own in sorted(found)]


def detected(df: DataFrame, text: str = "text", out: str = "spans") -> DataFrame:
    """Add the spans of every text, in order of start and kind."""
    shipped(df.sparkSession)

    def detect(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))
        for batch in batches:
            yield pa.concat_arrays([pa.array([all_spans(x or "") for x in piece.to_pylist()], kind) for piece in pieces(batch)])

    return df.withColumn(out, F.arrow_udf(detect, SPANS)(F.col(f"`{text}`")))


def digests(df: DataFrame) -> DataFrame:
    """Per document: base spans by kind, their digest, and all spans."""
    found = detected(df.select("doc_id", "text")).select("doc_id", "spans")
    base = F.filter("spans", lambda s: s["base"])
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    digest = F.sha2(written(base).cast("binary"), 256)
    return found.select("doc_id", *map(count, BASE_KINDS), digest.alias("base_sha256"), written(F.col("spans")).alias("spans"))
