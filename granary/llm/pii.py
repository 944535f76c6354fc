"""Personal data: base patterns, and a skip-chain conditional random field that makes a document's labels agree.

Base spans come from fixed patterns. The field has a variable for every token that holds a digit or an `@`, or repeats the
local part of an e-mail address found; all other tokens are outside. Neighbouring tokens are joined by chain edges, equal
or similar ones, however far apart, by skip edges, each to its next occurrence, so a document has linearly many edges.
Loopy message passing gives each token its most probable label; tokens of base spans are held at theirs. What becomes
labelled in addition, such as a number that is written in full once and without its prefix elsewhere, is a further span.

The factors are trained piecewise on at most SAMPLE documents (those with the smallest hashes) that the base patterns
label: node factors by multinomial logistic regression on token shapes, edge factors from how often labels agree.

Defined results: null is the empty text, without spans; texts are read whole and in time linear in their length;
overlapping spans of different kinds are all reported; repeated rows get equal spans; an empty table gives an empty
result; without training tokens the field adds nothing; a column named like the output is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.words import spans as pieces
from granary.session import shipped

KINDS = ("email", "ip", "card", "phone")
OUTSIDE = 0  # label; kind k has label k + 1
SPANS = "array<struct<kind:string,start:long,end:long,base:boolean>>"
SAMPLE = 2000
STEPS, RATE, DECAY = 300, 0.5, 1e-3  # of the regression
ROUNDS, DAMPING = 12, 0.5  # of message passing
STRONGEST = 6.0  # logarithm of an edge factor

LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# a match that fails would fail at every later start in the same run of digits, so runs are taken whole
ADDRESS = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
NUMBER = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
CALL = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
HINT = re.compile(r"[0-9@]")
SPACE = re.compile(r"[\x20\x09-\x0D]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DIGITS = "0123456789"
EDGE_MARKS = ".,;:!?\"'()[]<>"


# --- base spans ------------------------------------------------------------------------------------------------------


def emails(text: str) -> Iterator[tuple[int, int]]:
    """A match holds one `@`; it starts where the run of local characters before it does, or where the last match ended."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and LOCAL.match(text, start - 1):
            start -= 1
        found = DOMAIN.match(text, at) if start < at else None
        if found:
            end = found.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def passes_luhn(digits: str) -> bool:
    doubled = "0246813579"
    total = sum(int(doubled[int(d)] if i % 2 else d) for i, d in enumerate(reversed(digits)))
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, label) in order of start and kind."""
    out = [(a, b, 1) for a, b in emails(text)] if "@" in text else []
    for m in ADDRESS.finditer(text):
        parts = [part.lstrip("0") for part in m.group().split(".")]
        if all(len(part) <= 3 and int(part or 0) <= 255 for part in parts):
            out.append((*m.span(), 2))
    for m in NUMBER.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and passes_luhn(digits):
            out.append((*m.span(), 3))
    for m in CALL.finditer(text):
        if 9 <= sum(c in DIGITS for c in m.group()) <= 15:
            out.append((*m.span(), 4))
    return sorted(out, key=lambda s: (s[0], s[2]))


# --- the field -------------------------------------------------------------------------------------------------------


@dataclass
class Tokens:
    """The variables of a document: where they are, what they look like, and their label where a base span covers them."""

    places: list[tuple[int, int]] = field(default_factory=list)
    shapes: list[list[int]] = field(default_factory=list)
    labels: list[int] = field(default_factory=list)
    chain: list[tuple[int, int]] = field(default_factory=list)
    skips: list[tuple[int, int]] = field(default_factory=list)


def places(text: str, locals_: set[str]) -> Iterator[tuple[int, int]]:
    if locals_:
        for m in WORD.finditer(text):
            if HINT.search(m.group()) or m.group().strip(EDGE_MARKS) in locals_:
                yield m.span()
        return
    found = HINT.search(text)
    end = 0
    while found:
        start = max(text.rfind(c, end, found.start()) for c in " \t\n\x0b\x0c\r") + 1
        start = max(start, end)
        stop = SPACE.search(text, found.end())
        end = stop.start() if stop else len(text)
        yield start, end
        found = HINT.search(text, end)


FEATURES = 24


def shape(token: str, before: bool, after: bool) -> list[int]:
    """The numbers of the features that a token has."""
    digits = sum(c in DIGITS for c in token)
    sizes = (0, 3, 6, 8, 11, 19)
    on = [0, 1 + sum(digits > s for s in sizes)]
    on.append(8 + min(token.count("."), 4))
    flags = ["@" in token, token[0] == "+", "-" in token, "(" in token or ")" in token, any(c.isalpha() for c in token), "=" in token or '"' in token,
             before, after, len(token) > 24, token.isdigit(), 12 <= digits <= 19 and passes_luhn("".join(c for c in token if c in DIGITS))]
    return on + [13 + i for i, flag in enumerate(flags) if flag]


def keys(token: str) -> list[tuple[str, str]]:
    """Names under which a token meets equal and similar ones."""
    bare = token.strip(EDGE_MARKS)
    digits = "".join(c for c in token if c in DIGITS)
    out = [("whole", bare.lower())] if len(bare) >= 5 else []
    if len(digits) >= 7:
        out.append(("digits", digits[-7:]))
    local = bare.split("@")[0].lower()
    return out + ([("local", local)] if len(local) >= 5 else [])


def tokens(text: str, base: list[tuple[int, int, int]]) -> Tokens:
    out, locals_ = Tokens(), {text[a:b].split("@")[0] for a, b, label in base if label == 1}
    out.places = list(places(text, locals_))
    near = [b[0] - a[1] <= 2 and not text[a[1] : b[0]].strip() for a, b in zip(out.places, out.places[1:])]
    last: dict[tuple[str, str], int] = {}
    at = 0
    for i, (start, end) in enumerate(out.places):
        token = text[start:end]
        out.shapes.append(shape(token, i > 0 and near[i - 1], i < len(near) and near[i]))
        while at < len(base) and base[at][1] <= start:
            at += 1
        cover = next((s for s in base[at : at + 8] if s[0] < end and s[1] > start), None)
        out.labels.append(cover[2] if cover else OUTSIDE)
        for key in keys(token):
            if key in last:
                out.skips.append((last[key], i))
            last[key] = i
    out.chain = [(i, i + 1) for i, close in enumerate(near) if close]
    return out


@dataclass
class Crf:
    """Logarithms of the factors."""

    node: np.ndarray  # feature x label
    chain: np.ndarray  # label x label
    skip: float

    def scores(self, shapes: list[list[int]]) -> np.ndarray:
        return np.array([self.node[on].sum(axis=0) for on in shapes])


def trained(sample: list[Tokens]) -> Crf:
    labels = len(KINDS) + 1
    x = np.zeros((sum(len(t.labels) for t in sample), FEATURES))
    y = np.array([label for t in sample for label in t.labels], int)
    for row, on in zip(x, (on for t in sample for on in t.shapes)):
        row[on] = 1
    node = np.zeros((FEATURES, labels))
    if len(y):
        truth, step = np.eye(labels)[y], np.zeros_like(node)
        for _ in range(STEPS):
            p = np.exp((s := x @ node) - s.max(axis=1, keepdims=True))
            step = 0.9 * step + x.T @ (truth - p / p.sum(axis=1, keepdims=True)) / len(y) - DECAY * node
            node = node + RATE * step
    pairs = np.ones((labels, labels))
    agree, differ = 5.0, 1.0
    for t in sample:
        for i, j in t.chain:
            pairs[t.labels[i], t.labels[j]] += 1
        same = sum(t.labels[i] == t.labels[j] for i, j in t.skips)
        agree, differ = agree + same, differ + len(t.skips) - same
    expected = pairs.sum(axis=1, keepdims=True) * pairs.sum(axis=0) / pairs.sum()
    chain = np.clip(np.log(pairs / expected), -STRONGEST / 2, STRONGEST / 2)
    return Crf(node, chain, float(min(np.log(agree / differ), STRONGEST)))


def decoded(t: Tokens, crf: Crf) -> np.ndarray:
    """The most probable label of each token, by loopy message passing."""
    score = crf.scores(t.shapes)
    held = np.flatnonzero(np.array(t.labels) != OUTSIDE)
    score[held] = -50.0
    score[held, np.array(t.labels)[held]] = 0.0
    edges = np.array([*t.chain, *t.skips], int).reshape(-1, 2)
    if not len(edges):
        return score.argmax(axis=1)
    potts = crf.skip * np.eye(score.shape[1])
    factor = np.concatenate([np.repeat(crf.chain[None], len(t.chain), 0), np.repeat(potts[None], len(t.skips), 0)])
    source, target = np.concatenate([edges[:, 0], edges[:, 1]]), np.concatenate([edges[:, 1], edges[:, 0]])
    both = np.concatenate([factor, factor.transpose(0, 2, 1)])  # from source's label to target's
    message, n = np.zeros((len(source), score.shape[1])), len(edges)
    back = np.concatenate([np.arange(n, 2 * n), np.arange(n)])
    for _ in range(ROUNDS):
        belief = score.copy()
        np.add.at(belief, target, message)
        incoming = (belief[source] - message[back])[:, :, None] + both
        most = incoming.max(axis=1)
        new = most + np.log(np.exp(incoming - most[:, None]).sum(axis=1))
        message = DAMPING * message + (1 - DAMPING) * (new - new.max(axis=1, keepdims=True))
    belief = score.copy()
    np.add.at(belief, target, message)
    return belief.argmax(axis=1)


def added_spans(text: str, base: list[tuple[int, int, int]], crf: Crf) -> list[tuple[int, int, int]]:
    """Runs of tokens that the field labels and no base span touches."""
    t = tokens(text, base)
    if OUTSIDE not in t.labels:
        return []
    label = np.where(np.array(t.labels) == OUTSIDE, decoded(t, crf), OUTSIDE)
    linked, out = set(t.chain), []
    for i in np.flatnonzero(label).tolist():
        start, end = t.places[i]
        body = text[start:end]
        start, end = start + len(body) - len(body.lstrip(EDGE_MARKS)), start + len(body.rstrip(EDGE_MARKS))
        if start >= end:
            continue
        if out and (i - 1, i) in linked and label[i - 1] == label[i] and out[-1][3] == i - 1:
            out[-1] = (out[-1][0], end, out[-1][2], i)
        else:
            out.append((start, end, int(label[i]), i))
    return [s[:3] for s in out]


def all_spans(text: str, crf: Crf) -> list[dict]:
    if not HINT.search(text):
        return []
    base = base_spans(text)
    found = [(*s, True) for s in base] + [(*s, False) for s in added_spans(text, base, crf)]
    return [{"kind": KINDS[k - 1], "start": a, "end": b, "base": own} for a, b, k, own in sorted(found, key=lambda s: (s[0], s[2], s[1]))]


# --- on tables -------------------------------------------------------------------------------------------------------


def fitted(df: DataFrame, text: str = "text", key: str = "doc_id") -> Crf:
    """Train on the documents with a digit or an `@` whose keys have the smallest hashes, SAMPLE at most."""
    order = F.xxhash64(F.lit("pii"), key)
    useful = df.where(F.col(text).rlike("[0-9@]")).select(order.alias("order"), F.col(text).alias("text"))
    limits = useful.select("order").orderBy("order").limit(SAMPLE).agg(F.max("order")).first()[0]
    if limits is None:
        return trained([])
    shipped(df.sparkSession)

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [tokens(x, base_spans(x)) for x in batch["text"].to_pylist()]
            columns = [pa.array([t.shapes for t in rows], pa.list_(pa.list_(pa.int32()))), pa.array([t.labels for t in rows], pa.list_(pa.int32()))]
            columns += [pa.array([[list(e) for e in edges] for edges in some], pa.list_(pa.list_(pa.int32()))) for some in ([t.chain for t in rows], [t.skips for t in rows])]
            yield pa.RecordBatch.from_arrays(columns, ["shapes", "labels", "chain", "skips"])

    kind = "shapes array<array<int>>, labels array<int>, chain array<array<int>>, skips array<array<int>>"
    sample = useful.where(F.col("order") <= limits).limit(SAMPLE).select("text").mapInArrow(prepare, kind).collect()
    return trained([Tokens([], r.shapes, r.labels, r.chain, r.skips) for r in sample])


def detected(df: DataFrame, crf: Crf, text: str = "text", out: str = "spans") -> DataFrame:
    """Add the spans of every text, in order."""
    shipped(df.sparkSession)

    def detect(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))
        for batch in batches:
            yield pa.concat_arrays([pa.array([all_spans(x or "", crf) for x in piece.to_pylist()], kind) for piece in pieces(batch)])

    return df.withColumn(out, F.arrow_udf(detect, SPANS)(F.col(text)))


def redacted(df: DataFrame, text: str = "text") -> DataFrame:
    """df with every span of the text replaced by its kind in angle brackets; null stays null."""
    crf = fitted(df, text)
    shipped(df.sparkSession)

    def replace(content: str | None) -> str | None:
        if not content:
            return content
        out, end = [], 0
        for span in all_spans(content, crf):
            if span["start"] >= end:
                out += [content[end : span["start"]], f"<{span['kind'].upper()}>"]
            end = max(end, span["end"])
        return "".join(out) + content[end:]

    def work(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.concat_arrays([pa.array(map(replace, piece.to_pylist()), pa.string()) for piece in pieces(batch)])

    return df.withColumn(text, F.arrow_udf(work, "string")(F.col(text)))


def digests(df: DataFrame) -> DataFrame:
    """Per document: base spans by kind, their digest, and all spans."""
    found = detected(df.select("doc_id", "text"), fitted(df)).select("doc_id", "spans")
    base = F.filter("spans", lambda s: s["base"])
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    digest: Column = F.sha2(written(base).cast("binary"), 256)
    return found.select("doc_id", *map(count, KINDS), digest.alias("base_sha256"), written(F.col("spans")).alias("spans"))
