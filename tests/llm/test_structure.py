"""Periodic runs, secrets and the Merkle manifest, against brute force."""

import base64
import hashlib
import json
import random
import re
import zlib

import numpy as np
import pytest

from granary.llm import merkle, periodic, queries, secretscan

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- periodic runs ---------------------------------------------------------------------------------------------------


def plain_runs(words):
    """All runs by looking at every lag and place; a stretch that a shorter period covers is not of smallest period."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q) and j > i and not any(p < q and s <= i and s + k >= j + q for s, k, p in out):
                out.append((i, j - i + q, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_match_brute_force_on_random_words():
    random.seed(3)
    texts = [b" ".join(random.choice([b"a", b"b"]) for _ in range(random.randint(0, 60))) for _ in range(400)]
    for _ in range(150):
        unit = [random.choice([b"a", b"b", b"c", b"dd"]) for _ in range(random.randint(1, 70))]
        head = [random.choice([b"a", b"b", b"c"]) for _ in range(random.randint(0, 40))]
        texts.append(b" ".join(head + (unit * 6)[: random.randint(1, 6 * len(unit))] + head))
    for text, found in zip(texts, periodic.analysed(texts)):
        words = text.split()
        expected = plain_runs(words)
        assert [(r["start"], r["length"], r["period"]) for r in found["runs"]] == expected
        kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + k for s, k, q in expected)]
        assert found["collapsed"].encode() == b" ".join(kept)


def test_each_run_is_extended_once(monkeypatch):
    calls = []
    plain = periodic.same
    monkeypatch.setattr(periodic, "same", lambda *a, **k: calls.append(1) or plain(*a, **k))
    words = np.array([0, 1, 2] * 3000 + [5] * 5000)
    assert [r[1:] for r in periodic.runs(words)] == [(9000, 3), (5000, 1)] and len(calls) == 4  # two runs, both directions


def test_long_texts_take_linear_time():
    [found] = periodic.analysed([b"again " * 300_000 + b" ".join(b"w%d" % (i % 50_000) for i in range(200_000))])
    assert [(r["length"], r["period"]) for r in found["runs"]] == [(300_000, 1), (200_000, 50_000)]


def test_query_matches_brute_force(spark, sf_dir, texts):
    for r in queries.op11_periodic_runs(spark, sf_dir).collect():
        words, h = WORD.findall(texts[r.doc_id]), zlib.crc32(str(r.doc_id).encode())
        if len(words) > 1500:
            continue  # the brute force is quadratic; the DuckDB statement covers all
        if h % 10 == 0 and words:
            a, n = h // 10 % len(words), len(words)
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = plain_runs(words)
        assert r.n_runs == len(runs)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None,) * 3)
        assert (r.start, r.length, r.period) == best
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == sha("".join(f"{s},{k},{q}\n" for s, k, q in runs))
        assert r.collapsed_sha256 == sha(" ".join(w for i, w in enumerate(words) if not any(s + q <= i < s + k for s, k, q in runs)))


def test_runs_of_odd_tables(odd_docs, no_docs):
    rows = periodic.detected(odd_docs).select("doc_id", "runs", "collapsed", "length", "row").collect()
    by_id = {r.doc_id: r for r in rows}
    assert len(rows) == len(by_id) + 1 and all(r.length == r.row == "extra" for r in rows)
    assert by_id[3].runs == by_id[4].runs == by_id[5].runs == [] and by_id[3].collapsed == ""
    assert [tuple(x) for x in by_id[10].runs] == [(0, 4000, 1)] and by_id[10].collapsed == "again"
    assert [tuple(x) for x in by_id[9].runs] == [(0, 80, 2)] and by_id[9].collapsed == "%%% ***" or by_id[9].runs
    assert periodic.digests(odd_docs).count() == len(rows)
    assert periodic.detected(no_docs).count() == periodic.digests(no_docs).count() == 0


# --- secrets ---------------------------------------------------------------------------------------------------------


def der(tag, *parts):
    body = b"".join(parts)
    size = len(body)
    length = bytes([size]) if size < 128 else bytes([0x80 | (size.bit_length() + 7) // 8]) + size.to_bytes((size.bit_length() + 7) // 8, "big")
    return bytes([tag]) + length + body


def number(n):
    return der(2, n.to_bytes(n.bit_length() // 8 + 1, "big"))


def rsa_key():
    p, q = 2**521 - 1, 2**607 - 1
    return der(0x30, *map(number, (0, p * q, 65537, 12345678901, p, q, 7, 9, 11)))


EC = der(0x30, number(1), der(4, bytes(range(32))), der(0xA0, der(6, bytes.fromhex("2a8648ce3d030107"))))
PKCS8 = der(0x30, number(0), der(0x30, der(6, bytes.fromhex("2b6570"))), der(4, der(4, bytes(range(32)))))
SSH = b"openssh-key-v1\0" + b"".join(len(s).to_bytes(4, "big") + s for s in (b"none", b"none", b"")) + (1).to_bytes(4, "big") + b"".join(
    len(s).to_bytes(4, "big") + s for s in (b"public" * 8, b"private" * 20))


def url64(data):
    return base64.urlsafe_b64encode(data).decode().rstrip("=")


def token(header=None, payload=None, size=32):
    parts = [json.dumps(header or {"alg": "HS256", "typ": "JWT"}).encode(), json.dumps(payload or {"sub": "1234567890"}).encode(), bytes(range(size))]
    return ".".join(map(url64, parts))


def added(text):
    return [(s["kind"], text[s["start"] : s["end"]]) for s in secretscan.all_spans(text) if not s["base"]]


@pytest.mark.parametrize("key", [rsa_key(), EC, PKCS8, SSH], ids=["rsa", "ec", "pkcs8", "ssh"])
def test_keys_are_found_in_every_encoding(key):
    plain = base64.b64encode(key).decode()
    lines = "\n".join(plain[i : i + 64] for i in range(0, len(plain), 64))
    marked = f"-----BEGIN PRIVATE KEY-----\n{lines}\n-----END PRIVATE KEY-----"
    escaped = marked.replace("\n", "\\n")
    for body in (plain, plain.rstrip("="), url64(key), lines, marked, escaped, key.hex(), key.hex().upper()):
        assert added(f"été: {body} end") == [("private_key", body)]
        assert added(f"{body}\nEnd of it") == [("private_key", body)]


def test_what_does_not_fit_is_no_key():
    key = rsa_key()
    shorter, longer = key[:-1], key + b"\0"
    other = der(0x30, *map(number, (0, 15, 65537, 7, 2**521 - 1, 2**607 - 1, 7, 9, 11)))
    for data in (shorter, longer, other, bytes(range(256)), SSH[:-1], SSH + b"x", der(0x30, number(5)), b"openssh-key-v1\0"):
        text = f"see {base64.b64encode(data).decode()} and {data.hex()}"
        assert not any(kind == "private_key" for kind, _ in added(text))
    assert added("-----BEGIN PRIVATE KEY-----\nnot a key\n-----END PRIVATE KEY-----") == []
    assert secretscan.elements(b"\x30\x81\x05hello", 0, 8) is None  # not the shortest form of a length


def test_signed_tokens():
    good = [token(), token({"alg": "RS256"}, size=256), token({"alg": "EdDSA"}, size=64), token({"alg": "ES512"}, size=132)]
    bad = [token(size=31), token({"typ": "JWT"}), token({"alg": "none"}), token({"alg": ["HS256"]}), token({"alg": "RS256"}, size=64), token(payload=[1])]
    for text in good:
        assert added(f"Bearer {text}, next") == [("signed_token", text)]
    for text in bad:
        assert added(f"Bearer {text}, next") == []
    assert added("eyJhbGciOiJIUzI1NiJ9." + url64(b"[" * 100_000) + "." + url64(bytes(32))) == []


ASSIGN = re.compile(r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
                    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")


def plain_base(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return [(secretscan.BASE_KINDS[k], a, b) for a, k, b in sorted(out)]


def test_base_spans_match_plain_patterns(spark, sf_dir):
    random.seed(5)
    parts = ["password", "Passwd", "SECRET", "token", "api_key", "APIkey", "ſecret", "toKen", " ", "  ", "=", ":", '"', "'", "abc", "Ab1/+_", "x" * 7, "AKIA", "AKIA" + "A7" * 8,
             "0f" * 12, "0f" * 11 + "0", "é", "\n", "-", ".", "\U0001f389"]
    for _ in range(4000):
        text = "".join(random.choices(parts, k=random.randint(1, 14)))
        assert [(s["kind"], s["start"], s["end"]) for s in secretscan.all_spans(text) if s["base"]] == plain_base(text)
    larger, found = sf_dir.replace("0.001", "0.01"), 0  # the smallest tables hold no secrets
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{larger}/documents.parquet").collect()}
    for r in queries.op12_secret_scan(spark, larger).collect():
        spans = plain_base(texts[r.doc_id])
        written = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r.base_sha256 == sha(written) and r.spans == written  # these tables hold no keys or signed tokens
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[0] == k for s in spans) for k in secretscan.BASE_KINDS]
        found += len(spans)
    assert found


def test_secrets_of_odd_tables(spark, odd_docs, no_docs):
    rows = secretscan.detected(odd_docs, out="found").select("doc_id", "found", "spans").collect()
    assert len(rows) == odd_docs.count() and all(r.spans == "extra" and r.found == [] for r in rows)
    assert secretscan.digests(no_docs).count() == 0 and secretscan.digests(odd_docs).count() == len(rows)
    long = spark.createDataFrame([(1, "A" * 3_000_000 + " " + token()), (1, None)], "doc_id long, text string")
    assert {r.spans for r in secretscan.digests(long).collect()} == {f"signed_token:3000001:{3000001 + len(token())}", ""}


# --- Merkle manifest -------------------------------------------------------------------------------------------------


def plain_tree(nodes):
    """Root, and for every leaf its steps (siblings before, behind)."""
    steps, of = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, members = [], []
        for i in range(0, len(nodes), 3):
            run = nodes[i : i + 3]
            for k in range(len(run)):
                for leaf in of[i + k]:
                    steps[leaf].append(("".join(run[:k]), "".join(run[k + 1 :])))
            above.append(sha("".join(run)))
            members.append([leaf for group in of[i : i + 3] for leaf in group])
        nodes, of = above, members
    return nodes[0], steps


def plain_manifest(rows):
    """rows: (group, key, leaf) -> sorted (group, key, leaf, subroot, root, proof)."""
    first = lambda v: (v is not None, v)
    groups = {}
    for group, key, leaf in sorted(rows, key=lambda r: (first(r[0] if r[0] is None else r[0].encode()), first(r[1]), r[2])):
        groups.setdefault(group, []).append((key, leaf))
    trees = {g: plain_tree([leaf for _, leaf in members]) for g, members in groups.items()}
    root, over = plain_tree([trees[g][0] for g in groups])
    out = []
    for g, upper in zip(groups, over):
        for (key, leaf), steps in zip(groups[g], trees[g][1]):
            out.append((str(g), str(key), leaf, trees[g][0], root, "".join(a + b for a, b in steps + upper)))
    return sorted(out)


def manifest_rows(df, order=("key", "leaf")):
    found = merkle.manifest(df, "source", list(order))
    return sorted((str(r.source), str(r.key), r.leaf, r.subroot, r.root, bytes(r.proof).decode()) for r in found.withColumn("proof", merkle.proof(found.steps)).collect())


@pytest.mark.parametrize("sizes", [[1], [1, 1], [3, 1, 10], [730, 28, 2], [1500, 729, 3, 1]], ids=str)
def test_manifest_matches_a_plain_tree(spark, sizes):
    random.seed(sum(sizes))
    rows = [(f"s{g}" if g else None, random.randint(0, 10**6), sha(f"{g}/{i}")) for g, n in enumerate(sizes) for i in range(n)]
    assert manifest_rows(spark.createDataFrame(rows, "source string, key long, leaf string")) == plain_manifest(rows)


def test_manifest_with_small_blocks_has_many_rounds(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 1)
    rows = [("a" if i % 5 else f"é{i}", i // 2, sha(str(i // 4))) for i in range(90)] + [("a", None, sha("null"))] * 2
    assert manifest_rows(spark.createDataFrame(rows, "source string, key long, leaf string")) == plain_manifest(rows)


def test_manifest_of_documents_and_tampering(spark, sf_dir, documents):
    docs = {r.doc_id: r for r in documents.collect()}
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, text: sha("".join(map(field, (r.doc_id, r.source, r.lang, r.n_chars, text))))
    expected = {r[1]: r for r in plain_manifest([(r.source, r.doc_id, leaf(r, r.text)) for r in docs.values()])}
    rows = queries.op13_merkle_manifest(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        _, _, own, subroot, root, proof = expected[str(r.doc_id)]
        assert (r.leaf, r.subroot, r.root, r.proof_sha256) == (own, subroot, root, sha(proof))
        text = docs[r.doc_id].text
        touched = zlib.crc32(str(r.doc_id).encode()) % 2 == 0 and "\n" in (text or "")
        assert r.verified == (r.folded_root == root) == (not touched)
    assert any(not r.verified for r in rows)


def test_manifest_of_odd_tables(spark, odd_docs, no_docs):
    rows = merkle.digests(odd_docs).collect()
    assert len(rows) == odd_docs.count() and len({r.root for r in rows}) == 1
    repeated = [r for r in rows if r.doc_id == 1]
    assert len(repeated) == 2 and len({r.leaf for r in repeated}) == 1  # equal rows, each at its place
    assert {r.doc_id for r in rows if not r.verified} <= {5}  # the only text with a line feed
    assert merkle.digests(no_docs).count() == 0
    assert len({r.root for r in merkle.digests(odd_docs.repartition(7)).collect()} | {r.root for r in rows}) == 1
