"""Operators that look across rows, against brute force."""

import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from granary.llm import minhash, mixing, quality, queries, urls, vectors
from granary.llm.components import components
from granary.llm.oracle import oracle_sql

WORD = re.compile(r"[^\x20\x09-\x0D]+")


class Union:
    def __init__(self):
        self.parent = {}

    def root(self, x):
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)


def test_components_of_paths_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(200, 230)] + [(1, 2), (2, 3), (3, 1), (7, 7)]
    expected = Union()
    for a, b in edges:
        expected.join(a, b)
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in found} == {n: expected.root(n) for e in edges if e[0] != e[1] for n in e}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_vectors(rows):
    links, parts = Counter(), Union()
    usable = [(i, v, label) for i, v, label in rows if label is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    for n, (i, v, label) in enumerate(usable):
        for j, u, other in usable[:n]:
            if label == other and len(u) == len(v) and np.dot(u, v) / np.linalg.norm(u) / np.linalg.norm(v) >= 0.98:
                links[i] += 1
                links[j] += 1
                parts.join(i, j)
    return {i: (links[i], parts.root(i)) for i, _, _ in rows}


def test_vector_links_of_a_table(spark, sf_dir):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    found = {r.vec_id: (r.n_links, r.component_id) for r in queries.op1_vector_links(spark, sf_dir).collect()}
    assert found == brute_vectors(rows)


def test_vector_links_in_dense_and_odd_groups(spark, monkeypatch):
    random = np.random.default_rng(3)
    centre = random.standard_normal(16)
    near = [(i, (centre + 0.12 * random.standard_normal(16)).tolist(), i % 2) for i in range(120)]
    same = [(200 + i, [1.0] * 16, 0) for i in range(30)]
    odd = [(300, None, 0), (301, [], 0), (302, [0.0] * 16, 0), (303, [None] * 16, 0), (304, [float("nan")] * 16, 0), (305, [1.0] * 16, None),
           (306, [1.0, 1.0], 0), (307, [2.0, 2.0], 0), (308, [float("inf")] * 16, 0)]
    rows = near + same + odd
    monkeypatch.setattr(vectors, "BLOCK", 16)  # many blocks to a list
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.linked(df).collect()}
    expected = brute_vectors([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows])
    assert {i: f[:2] for i, f in found.items()} == expected
    assert all(kept == (i == component) for i, (_, component, kept) in found.items())
    assert vectors.linked(df.where("false")).count() == 0


def bags_of(texts):
    out = {}
    for i, text in texts.items():
        w = WORD.findall(text)
        out[i] = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])
    return out


def brute_groups(texts, least=0.8):
    bags = bags_of(texts)
    holders = defaultdict(list)
    for i, bag in bags.items():
        for shingle in bag:
            holders[shingle].append(i)
    total, documents = sum(map(len, bags.values())), sum(1 for b in bags.values() if b)
    rare = max(total / minhash.MOST_COMMON, 1.0)
    spread = np.log(max(documents / rare, 1 + 1e-9))

    def weight(shingle):
        n = len(holders[shingle])
        share = np.log(max(documents / max(n, rare), 1.0)) / spread if n * minhash.MOST_COMMON >= total else 1
        return 1 + minhash.IDF_SPREAD * min(max(share, 0), 1)

    groups = Union()
    for a, b in {(a, b) for held in holders.values() for a in held for b in held if a < b}:
        both = set(bags[a]) | set(bags[b])
        common = sum(min(bags[a][s], bags[b][s]) * weight(s) for s in both)
        if common >= least * sum(max(bags[a][s], bags[b][s]) * weight(s) for s in both):
            groups.join(a, b)
    return {i: groups.root(i) for i in texts}


def test_near_duplicates_of_a_table(spark, sf_dir, texts):
    found = {r.doc_id: (r.component_id, r.kept) for r in queries.op3_weighted_minhash(spark, sf_dir).collect()}
    assert {i: c for i, (c, _) in found.items()} == brute_groups(texts)
    assert all(kept == (i == c) for i, (c, kept) in found.items())


def test_near_duplicates_of_odd_texts(odd_docs, no_docs):
    found = defaultdict(list)
    for r in minhash.duplicates(odd_docs).collect():
        found[r.doc_id].append(r.component_id)
    assert found[1] == [1, 1] and found[2] == [1] and found[7] == [6] and found[None] == [None]
    assert found[3] == [3] and found[4] == [4] and found[5] == [5]
    kept = minhash.deduplicated(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3, 4, 5, 6, 9, 10, 11, 12]  # 8 is 1 with a line more
    assert minhash.duplicates(no_docs).count() == 0 and minhash.deduplicated(no_docs).count() == 0


def test_large_group_of_near_copies(spark):
    base = [f"w{i}" for i in range(200)]
    rows = [(0, " ".join(base))]
    for i in range(1, 150):
        words = list(base)
        words[i] = f"changed{i}"
        rows.append((i, " ".join(words)))
    rows.append((500, " ".join(base[:100] + [f"other{i}" for i in range(100)])))
    found = {r.doc_id: r.component_id for r in minhash.duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert {c for i, c in found.items() if i < 500} == {0} and found[500] == 500


def test_twins_are_linked_though_no_centre_is_like_them(spark):
    rng = np.random.default_rng(5)
    passage, rows = [f"p{k}" for k in range(200)], []
    for twin in range(400):
        own = [f"t{twin}x{k}" for k in range(100)]
        rows.append((2 * twin, " ".join(passage + own)))
        at = int(rng.integers(5, 70))
        rows.append((2 * twin + 1, " ".join(passage + own[:at] + [f"o{twin}y{k}" for k in range(19)] + own[at + 19 :])))
    found = {r.doc_id: r.component_id for r in minhash.duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert sum(found[2 * t + 1] != 2 * t for t in range(400)) == 0
    assert all(found[2 * t] == 2 * t for t in range(400))


def test_members_are_given_the_texts_their_centres_met(spark, tmp_path, monkeypatch):
    passage = [f"p{k}" for k in range(200)]
    rows = [(i, " ".join(passage + [f"t{i}x{k}" for k in range(100)])) for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "docs"))
    given, members, real = [], [], minhash.with_text

    def watched(named, docs, *classes):
        given.extend(docs.inputFiles())
        found = real(named, docs, *classes)
        members.extend(found.select("class", "text").collect())
        return found

    monkeypatch.setattr(minhash, "with_text", watched)
    assert minhash.duplicates(spark.read.parquet(str(tmp_path / "docs"))).count() == 60
    assert given and not any(str(tmp_path / "docs") in file for file in given)  # the documents are not read again
    assert 10 < len(members) == len({r["class"] for r in members}) and {r.text for r in members} <= {text for _, text in rows}


def test_pairs_of_members_beside_the_centres_are_compared(spark):
    a, b = (" ".join(f"{name}{i}" for i in range(100)) for name in "ab")
    rows = [(1, a), (2, a + " more"), (3, b), (4, b + " more"), (5, "quite another text of its own words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    own = minhash.Weights(np.zeros(0, np.uint64), np.zeros(0), 0, 0)
    classes = minhash.signed(docs, own)
    name = {r.doc_id: r["class"] for r in classes.collect()}
    centred = classes.select("class", F.lit(0).alias("band"), F.lit(0).alias("key"), F.lit(name[5]).alias("widest"), F.lit(name[5]).alias("smallest"))
    alone = spark.createDataFrame([], "node long, component long")
    found = {frozenset(r) for r in minhash.remaining(minhash.with_text(minhash.unsettled(centred, alone), docs, classes), own, minhash.LEAST).collect()}
    assert found == {frozenset((name[1], name[2])), frozenset((name[3], name[4]))}
    linked = spark.createDataFrame([(name[i], name[3]) for i in (3, 4)], "node long, component long")
    found = {frozenset(r) for r in minhash.remaining(minhash.with_text(minhash.unsettled(centred, linked), docs, classes), own, minhash.LEAST).collect()}
    assert found == {frozenset((name[1], name[2]))}


def test_members_that_are_not_alike_make_no_pairs(spark):
    passage = [f"p{k}" for k in range(260)]
    family = [(i, " ".join(passage + [f"t{i}x{k}" for k in range(40)])) for i in range(40)]  # similar to 0.74
    copies = [(100 + i, " ".join([f"c{k}" for k in range(100)] + [f"own{i}"])) for i in range(20)]
    docs = spark.createDataFrame([*family, *copies, (200, "the centre")], "doc_id long, text string")
    own = minhash.Weights(np.zeros(0, np.uint64), np.zeros(0), 0, 0)
    classes = minhash.signed(docs, own)
    name = {r["class"]: r.doc_id for r in classes.collect()}
    centre = next(c for c, i in name.items() if i == 200)
    centred = classes.select("class", F.lit(0).alias("band"), F.lit(0).alias("key"), F.lit(centre).alias("widest"), F.lit(centre).alias("smallest"))
    alone = spark.createDataFrame([], "node long, component long")
    members = minhash.with_text(minhash.unsettled(centred, alone), docs, classes)
    edges = minhash.remaining(members, own, minhash.LEAST).collect()
    assert len(edges) == 19  # as many as join the copies
    groups = Union()
    for a, b in edges:
        groups.join(name[a], name[b])
    assert len({groups.root(i) for i, _ in copies}) == 1


def test_common_shingles_weigh_less(spark):
    texts = [(f"this very line is everywhere unique{i} a{i} b{i} c{i} d{i}",) for i in range(300)]
    own = minhash.weights(spark.createDataFrame(texts, "text string").repartition(3))
    w = minhash.words(minhash.pa.array([texts[0][0]]))
    weight = own.of(minhash.shingles(w)[0])
    assert weight[0] == pytest.approx(1.0) and weight[1:] == pytest.approx(1 + minhash.IDF_SPREAD)


def test_samples_agree_as_often_as_texts_are_similar():
    own = minhash.Weights(np.zeros(0, np.uint64), np.zeros(0), 0, 0)
    agree = []
    for trial in range(40):
        base = [f"t{trial}w{i}" for i in range(60)]
        other = base[:50] + [f"t{trial}x{i}" for i in range(10)]
        w = minhash.words(minhash.pa.array([" ".join(base), " ".join(other)]))
        _, keys = minhash.Sampler(own).keys(*minhash.bags(w))
        agree += (keys[0] == keys[1]).tolist()
    expected = (46 / 66) ** minhash.ROWS
    assert abs(np.mean(agree) - expected) < 0.08


def test_mix_meets_its_targets(spark, sf_dir, documents, texts):
    source = {r.doc_id: r.source for r in documents.collect()}
    rows = queries.op6_source_mix(spark, sf_dir).collect()
    again = queries.op6_source_mix(spark, sf_dir).collect()
    assert sorted(rows) == sorted(again) and len(rows) == len(texts)
    size, taken, target, largest = Counter(), Counter(), {}, Counter()
    for r in rows:
        s = source[r.doc_id]
        assert r["size"] == len(WORD.findall(texts[r.doc_id])) and r.taken <= 3 * r["size"]
        size[s] += r["size"]
        taken[s] += r.taken
        target[s] = r.target
        largest[s] = max(largest[s], r["size"])
        assert len(r.shards.split(",")) == (r.taken // r["size"]) if r.taken else r.shards == ""
    assert sum(target.values()) == pytest.approx(sum(size.values()))
    names = sorted(size)
    open_ = [s for s in names if target[s] < 3 * size[s] - 1e-6]
    levels = {target[s] / (5, 2, 1)[names.index(s) % 3] for s in open_}
    assert max(levels) - min(levels) < 1e-6 * max(levels)
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in names)


def test_mix_of_limited_and_odd_sources(spark, odd_docs, no_docs):
    rows = [(i, "w " * (10 if i < 20 else 1), "a" if i < 3 else "b" if i < 20 else None) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {r.doc_id: r for r in mixing.allotments(df).collect()}
    assert out[0].target == 90.0 and out[0].taken == 30 and out[25].source_size == 20  # a stops at three times its size
    assert out[5].target == pytest.approx(220 - 90 - out[25].target) and out[25].target == pytest.approx((220 - 90) / 3)
    odd = mixing.allotted(odd_docs)
    assert odd.count() == odd_docs.count() and "spans" in odd.columns
    copies = mixing.mixed(odd_docs)
    assert copies.columns == [*odd_docs.columns, "shard", "order"] and copies.where("text is null").count() == 0
    assert mixing.allotments(no_docs).count() == 0


def test_shards_are_even_draws(spark):
    rows = [(i, "w " * 5, f"s{i % 4}") for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    shards = Counter(r.shard for r in mixing.mixed(df).select("shard").collect())
    assert len(shards) == 2**mixing.LEVELS and max(shards.values()) < 3 * min(shards.values())


def test_quality_counts_and_fences(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    expected = con.sql(oracle_sql()["op9_adaptive_quality"])
    found = queries.op9_adaptive_quality(spark, sf_dir)
    assert sorted(tuple(r) for r in found.select(*expected.columns).collect()) == sorted(expected.fetchall())


def test_quality_of_odd_texts(odd_docs, no_docs):
    rows = {r.doc_id: r for r in quality.verdicts(odd_docs).collect()}
    assert rows[3].n_words == rows[4].n_words == rows[5].n_words == 0 and rows[3].base_failed and not rows[3].kept
    assert rows[10].n_repeat_words == 4000 and rows[10].base_failed and rows[1].kept and rows[12].n_words == 1
    assert rows[9].n_symbols == 360 and not rows[9].kept
    kept = quality.filtered(odd_docs)
    assert kept.columns == odd_docs.columns and {r.doc_id for r in kept.collect()} >= {1, 2, 8}
    assert quality.verdicts(no_docs).count() == 0


def test_sketch_quantiles_are_close(spark):
    values = [(float(i), "en", "a") for i in range(1, 2001)]
    df = spark.createDataFrame(values, "v double, lang string, source string").repartition(5)
    rates = df.select("lang", "source", *(df.v.alias(m) for m in quality.MEASURES))
    row = quality.fences(quality.sketches(rates, ["lang", "source"]), ["lang", "source"]).first()
    assert row.n == 2000 and row.fence["symbols"].most == pytest.approx(1500 + 3 * 1000, rel=0.03)


def plain_rule(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(t, a) for a, t in urls.RULES if (host == t.split("/")[0] or host.endswith("." + t.split("/")[0])) and path.startswith(t[t.index("/") :])]
    return host, path, *(max(fits, key=lambda x: len(x[0])) if fits else (None, None))


def test_url_parts_and_rules(spark, sf_dir):
    url = {r.page_id: r.url for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = queries.op10_url_templates(spark, sf_dir).collect()
    assert len(rows) == len(url)
    for r in rows:
        host, path, rule, action = plain_rule(url[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (action or ("block" if r.purity >= urls.REJECTED else "allow"))


def test_odd_urls(spark):
    odd = [None, "", "no scheme", "http://", "://net/x", "HTTP://A.NET", "http://a.net/", "http://anet/", "http://É.Org/fr/x?y#z", "http://x.org/fr", "a://b://c/d",
           "http://a.example.net/en/1", "http://h.com/" + "/".join("abcdefghij"), "http://h.com/" + "s" * 50_000]
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(odd * 2)], "page_id long, url string, rule string")
    rows = urls.filtered(df).collect()
    assert len(rows) == 2 * len(odd)
    for r in rows:
        assert (r.host, r.path, r.rule) == plain_rule(odd[r.page_id % len(odd)])[:3]
    assert urls.filtered(df.where("false")).count() == 0


def test_templates_generalise_merge_and_reject(spark):
    rows = []
    for i in range(40):
        rows.append(("h.com", f"/shop/item-{i}x", 1))  # variable by its many values, all bad
        rows.append(("h.com", f"/news/{i}.html", 0))  # a number, all good
        rows.append(("h.com", f"/blog/{i}.html", 0))  # like news
        rows.append(("h.com", f"/misc/{i}.html", None))
    df = spark.createDataFrame(rows, "host string, path string, bad int")
    found = {r.path: r for r in urls.judged(df).collect()}
    assert found["/shop/item-3x"].template == "/shop/*" and found["/shop/item-3x"].rejected
    assert found["/news/3.html"].template == found["/blog/7.html"].template == "/*/*.html" and not found["/news/3.html"].rejected
    assert found["/misc/5.html"].template == "/misc/*.html" and not found["/misc/5.html"].rejected


def test_fences_move_smoothly_with_the_size_of_a_source(spark):
    """No size at which a source is suddenly judged by other rows; a small source is near its language, a large one itself."""
    rates = {m: 0.0 for m in quality.MEASURES}

    def most(n_small):
        rows = [("en", "large", i % 10 / 100) for i in range(2000)] + [("en", "small", 0.5 + i % 10 / 100) for i in range(n_small)]
        df = spark.createDataFrame([(lang, source, *({**rates, "symbols": v}).values()) for lang, source, v in rows], ["lang", "source", *rates])
        return {r.fence_source: r.fence.symbols.most for r in quality.group_fences(df).collect()}

    found = {n: most(n) for n in (1, 99, 100, 101, 3000)}
    assert abs(found[99]["small"] - found[100]["small"]) < 0.05 * found[100]["small"] and abs(found[100]["small"] - found[101]["small"]) < 0.05 * found[101]["small"]
    assert found[1]["small"] < 0.3 < 0.6 < found[3000]["small"]
    assert abs(found[1]["large"] - found[100]["large"]) < 0.02
