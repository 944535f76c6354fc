"""Near-duplicate texts by improved consistent weighted sampling over TF-IDF weighted shingles.

A text is a bag of shingles of WIDTH words (fewer words: one shingle of all). A shingle weighs its count in the text times
a smoothed inverse document frequency, 1 for one that every document holds up to 1 + IDF_SPREAD for a rare one; from a
share of 1 / MOST_COMMON of all shingle occurrences downwards all count as rare. So only common shingles need a table, it
never has more than MOST_COMMON entries at any input size, and may be given to every task. Candidates for it come from
mergeable counter summaries, then they are counted exactly.

Texts of equal words are one class. A class has BANDS keys of ROWS consistent weighted samples each; two classes agree in
a sample with probability equal to their weighted Jaccard similarity. Classes that share a key, or two neighbouring keys,
are linked to the centres of their bucket: the class with most neighbours, and the smallest. Every such edge is verified
by the exact similarity of the whole texts; edges are spread by centre in portions, so a bucket may have any size.

Members that are no centres and are still in several components are then compared with each other, exactly: those outside the
largest component of their bucket meet all members in squares of bounded size, where one is compared with all at once, and
only edges that join components leave a task. So no pair of a bucket is left out. Rows grow with the members times the blocks
of PORTION characters of their bucket; the comparisons, in memory, with the square of a group of texts that are not alike.

Defined results: null texts, empty ones and those without words are never linked; repeated rows belong to one class; a
similarity equal to LEAST links; ties between samples go to the smaller hash; an empty table gives an empty result; null
doc_ids are grouped but never name a component, unless there is no other id in it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.components import components
from granary.llm.words import BASE, Words, _powers, hashes, mixed, shingles, spans, words
from granary.session import shipped, stored, unused

WIDTH, LEAST = 5, 0.8
BANDS, ROWS = 10, 3
IDF_SPREAD = 0.5
MOST_COMMON = 1 << 14
COUNTERS = 4 * MOST_COMMON  # kept by a task that looks for common shingles
PORTION = 4 << 20  # characters of text compared with one copy of a centre
QUANTILES = 1 << 16
SLACK = 1 - 1e-9  # for rounding in sums of weights
SQUARE = ["band", "key", "block", "portion"]
SQUARES = "array<struct<block: int, portion: int, leads: boolean>>"


def bags(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shingle, row, count in the row), in order of row and shingle."""
    h, row = shingles(w, WIDTH)
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    return h[at], row[at], np.diff(np.append(at, len(h)))


def fingerprints(w: Words) -> np.ndarray:
    """A hash of each row's words in order, as a signed number."""
    h, counts = hashes(w), np.diff(w.first)
    place = np.arange(len(h)) - w.first[:-1][w.row]
    sums = np.zeros(len(counts), np.uint64)
    has = np.flatnonzero(counts)
    if len(has):
        sums[has] = np.add.reduceat(h * _powers(int(BASE), int(counts.max()))[place], w.first[:-1][has])
    return mixed(sums + counts.astype(np.uint64)).view(np.int64)


# --- common shingles -------------------------------------------------------------------------------------------------


def _pruned(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """At most COUNTERS counters, all lowered by as much as it takes, and by how much."""
    if len(key) <= COUNTERS:
        return key, n, 0
    off = int(np.partition(n, len(n) - COUNTERS - 1)[len(n) - COUNTERS - 1])
    keep = n > off
    return key[keep], n[keep] - off, off


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """shingle, n: a lower bound of its documents; a row without shingle has the error of n, the total and the documents."""
    key, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    error = total = documents = 0
    for batch in batches:
        for texts in spans(batch["text"]):
            h, row, _ = bags(words(texts))
            found, times = np.unique(np.concatenate([h, key]), return_inverse=True)
            weight = np.concatenate([np.ones(len(h), np.int64), n])
            key, n, off = _pruned(found, np.bincount(times, weight, len(found)).astype(np.int64))
            error, total, documents = error + off, total + len(h), documents + len(np.unique(row))
    yield pa.RecordBatch.from_arrays(
        [pa.array([*key.view(np.int64).tolist(), None]), pa.array([*n.tolist(), error]),
         pa.array([0] * len(key) + [total]), pa.array([0] * len(key) + [documents])], ["shingle", "n", "total", "documents"])


class Weights:
    """Inverse document frequencies: a bounded table of common shingles, the most there is for all others."""

    def __init__(self, shingle: np.ndarray, n: np.ndarray, total: int, documents: int):
        order = np.argsort(shingle)
        self.shingle = shingle[order]
        rare = max(total / MOST_COMMON, 1.0)
        spread = np.log(max(documents / rare, 1.0 + 1e-9))
        share = np.log(np.maximum(documents / np.maximum(n[order], rare), 1.0)) / spread
        self.weight = 1 + IDF_SPREAD * np.clip(share, 0, 1)

    def of(self, h: np.ndarray) -> np.ndarray:
        out = np.full(len(h), 1 + IDF_SPREAD)
        if len(self.shingle):
            at = np.minimum(np.searchsorted(self.shingle, h), len(self.shingle) - 1)
            known = self.shingle[at] == h
            out[known] = self.weight[at[known]]
        return out


def weights(texts: DataFrame) -> Weights:
    """Document frequencies of all common shingles, over all documents (column text)."""
    shipped(texts.sparkSession)
    summary = texts.mapInArrow(_summaries, "shingle long, n long, total long, documents long")
    sums = stored(summary.groupBy("shingle").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("documents").alias("documents")), "summaries")
    whole = sums.where("shingle is null").first()
    total, error, documents = (whole["total"], whole["n"], whole["documents"]) if whole else (0, 0, 0)
    # fewer than 4/3 MOST_COMMON rows, as the error is at most a quarter of the bound
    candidates = sums.where(F.col("shingle").isNotNull() & ((F.col("n") + error) * MOST_COMMON >= total)).select("shingle").toArrow()
    known = np.sort(candidates["shingle"].to_numpy().view(np.uint64)) if total else np.zeros(0, np.uint64)

    def recount(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(known), np.int64)
        for batch in batches:
            for piece in spans(batch["text"]):
                h, _, _ = bags(words(piece))
                at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                n += np.bincount(at[known[at] == h], minlength=len(known))
        seen = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(n[seen])], ["at", "n"])

    if not len(known):
        return Weights(known, np.zeros(0), total, documents)
    exact = texts.mapInArrow(recount, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    at, n = exact["at"].to_numpy(), exact["n"].to_numpy()
    common = n * MOST_COMMON >= total
    return Weights(known[at[common]], n[common], total, documents)


# --- samples ---------------------------------------------------------------------------------------------------------


def gamma_quantiles() -> np.ndarray:
    """QUANTILES quantiles of the gamma distribution of shape 2, whose tail is (1 + x) exp(-x)."""
    grid = np.exp(np.linspace(np.log(1e-4), np.log(40.0), 200_001))
    below = -np.expm1(np.log1p(grid) - grid)
    return np.interp((np.arange(QUANTILES) + 0.5) / QUANTILES, below, grid)


class Sampler:
    def __init__(self, own: Weights):
        self.own, gamma = own, gamma_quantiles()
        self.rate, self.log_gamma = gamma.astype(np.float32), np.log(gamma).astype(np.float32)

    def keys(self, h: np.ndarray, row: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows that have shingles, their BANDS keys)."""
        first = np.flatnonzero(np.diff(row, prepend=-1))
        sizes = np.diff(np.append(first, len(row)))
        log_weight = np.log(count * self.own.of(h)).astype(np.float32)
        keys = np.zeros((len(first), BANDS), np.uint64)
        for k in range(BANDS * ROWS):
            u = mixed(h + np.uint64(k + 1) * BASE)
            rate = self.rate[(u & np.uint64(QUANTILES - 1)).astype(np.int64)]
            log_c = self.log_gamma[(u >> np.uint64(16) & np.uint64(QUANTILES - 1)).astype(np.int64)]
            shift = (u >> np.uint64(40)).astype(np.float32) / np.float32(1 << 24)
            step = np.floor(log_weight / rate + shift)
            value = log_c - rate * (step - shift + 1)
            least = np.minimum.reduceat(value, first)
            hit = np.flatnonzero(value == np.repeat(least, sizes))
            chosen = hit[np.searchsorted(hit, first)]  # the first in each row
            sample = mixed(h[chosen] ^ step[chosen].astype(np.int64).astype(np.uint64) * BASE)
            keys[:, k // ROWS] = mixed(keys[:, k // ROWS] * BASE + sample)
        return row[first], keys


def signed(docs: DataFrame, own: Weights) -> DataFrame:
    """docs (columns text and others) with text replaced by class, a hash of the words, and keys; null without words."""
    shipped(docs.sparkSession)
    others = [c for c in docs.columns if c != "text"]

    def sign(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        sampler = Sampler(own)
        for batch in batches:
            out = []
            for texts in spans(batch):
                w = words(texts)
                has, keys = sampler.keys(*bags(w)) if len(w.starts) else (np.zeros(0, int), np.zeros((0, BANDS), np.uint64))
                offsets = np.zeros(len(texts) + 1, np.int32)
                offsets[1 + has] = BANDS
                listed = pa.ListArray.from_arrays(pa.array(np.cumsum(offsets), pa.int32()), pa.array(keys.view(np.int64).ravel(), pa.int64()))
                classes = pa.array(fingerprints(w), pa.int64(), mask=np.diff(w.first) == 0)
                out.append(pa.StructArray.from_arrays([classes, listed], ["class", "keys"]))
            yield pa.concat_arrays(out)

    found = docs.withColumn("_signed", F.arrow_udf(sign, "class long, keys array<long>")(F.col("text")))
    return found.select(*others, F.length("text").alias("length"), "_signed.class", "_signed.keys")


# --- candidates and links --------------------------------------------------------------------------------------------


def buckets(classes: DataFrame) -> DataFrame:
    """class, band, key, and the two centres of the bucket, for classes (columns class, keys) that share a bucket."""
    coarse = F.transform("keys", lambda key, i: F.struct(i.alias("band"), key.alias("key")))
    fine = F.transform(F.slice("keys", 1, BANDS - 1), lambda key, i: F.struct(
        (i + BANDS).alias("band"), F.xxhash64(key, F.get("keys", i + 1)).alias("key")))
    entries = classes.select("class", F.explode(F.concat(coarse, fine)).alias("at")).select("class", "at.band", "at.key")
    shared = entries.groupBy("band", "key").agg(F.count("*").alias("members")).where("members > 1")
    members = stored(entries.join(shared, ["band", "key"]), "members")
    degrees = members.groupBy("class").agg(F.sum("members").alias("degree"))
    best = members.join(degrees, "class").groupBy("band", "key").agg(
        F.max(F.struct("degree", "class"))["class"].alias("widest"), F.min("class").alias("smallest"))
    return members.select("class", "band", "key").join(best, ["band", "key"])


def candidates(centred: DataFrame) -> DataFrame:
    """Distinct edges leaf, centre from the members of buckets to their centres, numbered from 0 for each leaf."""
    edges = centred.select("class", F.explode(F.array("widest", "smallest")).alias("centre")).where("class <> centre").distinct()
    of_leaf = edges.groupBy(F.col("class").alias("leaf")).agg(F.collect_list("centre").alias("centres"))  # at most two a bucket
    return of_leaf.select("leaf", F.posexplode("centres").alias("number", "centre"))


def unsettled(centred: DataFrame, parts: DataFrame) -> DataFrame:
    """class, component, places: for members of buckets that hold several components besides the centres, those buckets.

    A place is band, key, active: whether the member is outside the largest component of that bucket. Two that share a bucket
    but no component are not both inactive. Finer buckets are parts of the coarse ones.
    """
    others = centred.where((F.col("band") < BANDS) & ~F.col("class").isin(F.col("widest"), F.col("smallest")))
    at = others.groupBy("class").agg(F.collect_list(F.struct("band", "key")).alias("places"))  # at most one a band
    known = at.join(parts, at["class"] == parts["node"], "left").select(
        "class", F.coalesce("component", "class").alias("component"), F.explode("places").alias("at")).select("class", "component", "at.band", "at.key")
    sizes = known.groupBy("band", "key", "component").agg(F.count("*").alias("n"))
    mixed_ones = sizes.groupBy("band", "key").agg(F.max(F.struct("n", "component"))["component"].alias("largest"), F.count("*").alias("held")).where("held > 1")
    place = F.struct("band", "key", (F.col("component") != F.col("largest")).alias("active"))
    return known.join(mixed_ones, ["band", "key"]).groupBy("class", "component").agg(F.collect_list(place).alias("places"))


def with_text(named: DataFrame, docs: DataFrame, classes: DataFrame | None = None) -> DataFrame:
    """named (column class) with doc_id and text of the document that stands for each class, or with the rows of docs by class."""
    # written, so that Spark knows whether these rows are few: then the texts need no shuffle
    if classes is None:
        return stored(stored(named, "unsettled").join(docs, "class"), "unsettled")
    named = stored(named.join(classes.select("class", F.col("doc_id").alias("named")), "class"), "unsettled")
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull())
    return stored(named.join(texts, F.col("named").eqNullSafe(F.col("doc_id"))).drop("named"), "unsettled")


def met(members: DataFrame) -> DataFrame:
    """The rows of unsettled members (with text), dealt to the squares of their buckets: band, key, block, portion, leads.

    The active members of a bucket lead in one block each, all are in one portion each, and a square holds a block and a
    portion, so every active member meets every other one once. Blocks and portions are about PORTION characters.
    """
    places = members.select("class", F.length("text").alias("length"), F.explode("places").alias("at")).select("length", "at.*")
    part = lambda size: F.ceil((F.coalesce(F.sum(size), F.lit(0)) + 1) / PORTION).cast("int")
    squares = stored(places.groupBy("band", "key").agg(
        part(F.when(F.col("active"), F.col("length"))).alias("blocks"), part(F.col("length")).alias("portions")), "squares")
    each = members.select("class", "component", "text", F.explode("places").alias("at")).select("class", "component", "text", "at.*")
    own = lambda parts: F.pmod(F.xxhash64("class"), F.col(parts)).cast("int")
    upto = lambda parts: F.sequence(F.lit(0), F.col(parts) - 1)
    square = lambda block, portion, leads: F.struct(block.alias("block"), portion.alias("portion"), F.lit(leads).alias("leads"))
    led = F.when(F.col("active"), F.transform(upto("portions"), lambda i: square(own("blocks"), i, True)))
    held = F.transform(upto("blocks"), lambda i: square(i, own("portions"), False))
    dealt = each.join(squares, ["band", "key"]).select(
        "class", "component", "text", "band", "key", F.explode(F.concat(F.coalesce(led, F.array().cast(SQUARES)), held)).alias("square"))
    return dealt.select("band", "key", "square.*", "class", "component", "text")


def squares_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one square after the other, from rows in order of their squares."""
    held, last = [], None
    for batch in batches:
        names = np.stack([batch[c].to_numpy() for c in SQUARE], axis=1)
        cuts = [0, *(np.flatnonzero((names[1:] != names[:-1]).any(axis=1)) + 1), len(names)]
        for start, end in zip(cuts, cuts[1:]):
            if end == start:
                continue
            if held and tuple(names[start]) != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
            last = tuple(names[start])
    if held:
        yield pa.Table.from_batches(held)


class Bags:
    """The weighted shingles of the rows of a table (columns class, component, text) that hold the text of their class."""

    def __init__(self, rows: pa.Table, own: Weights):
        parts, at = [], 0
        self.name, self.component = (rows[c].to_numpy() for c in ("class", "component"))
        right = np.zeros(len(rows), bool)  # else another text under the same doc_id
        for chunk in rows["text"].chunks:
            for texts in spans(chunk):
                w = words(texts)
                h, row, count = bags(w)
                right[at : at + len(texts)] = fingerprints(w) == self.name[at : at + len(texts)]
                parts.append((h, row + at, count * own.of(h)))
                at += len(texts)
        h, row, weight = (np.concatenate(part) for part in zip(*parts))
        good = right[row]
        self.h, self.row, self.weight = h[good], row[good], weight[good]
        self.first = np.searchsorted(self.row, np.arange(len(rows) + 1))

    def of(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        return self.h[self.first[i] : self.first[i + 1]], self.weight[self.first[i] : self.first[i + 1]]


def joined(leads: Bags, others: Bags, least: float) -> Iterator[tuple[int, int]]:
    """Classes of leads and others that are similar: as many as it takes to join the components that have such a pair.

    One lead is compared with all others at once: what they have in common is summed from a table of its weights.
    """
    there = np.flatnonzero(np.diff(others.first))
    if not len(there):
        return
    known, at = np.unique(others.h, return_inverse=True)
    starts = others.first[there]
    total = np.add.reduceat(others.weight, starts)
    names, root = np.unique(np.concatenate([others.component[there], leads.component]), return_inverse=True)
    root, root_of_lead = root[: len(there)], root[len(there) :]
    own = np.zeros(len(known))
    for i in np.flatnonzero(np.diff(leads.first)):
        if not (root != root_of_lead[i]).any():
            continue
        h, weight = leads.of(i)
        place = np.minimum(np.searchsorted(known, h), len(known) - 1)
        place, here = place[known[place] == h], weight[known[place] == h]
        own[place] = here
        common = np.add.reduceat(np.minimum(own[at], others.weight), starts)
        own[place] = 0
        near = (root != root_of_lead[i]) & (common >= SLACK * least * (total + weight.sum() - common))
        for j in np.flatnonzero(near):
            if root[j] != root_of_lead[i] and similarity(h, weight, *others.of(there[j])) >= least:
                yield int(leads.name[i]), int(others.name[there[j]])
                gone, kept = root[j], root_of_lead[i]
                root[root == gone] = kept
                root_of_lead[root_of_lead == gone] = kept


def remaining(members: DataFrame, own: Weights, least: float) -> DataFrame:
    """Edges a, b between unsettled members (with text) of different components whose whole texts are at least so similar.

    Of the edges between the same components in a square one is enough, and the others are left out.
    """
    shipped(members.sparkSession)
    placed = met(members).repartition(*SQUARE).sortWithinPartitions(*SQUARE)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in squares_of(batches):
            leads = rows["leads"].to_numpy()
            if not leads.any() or leads.all():
                continue
            links = list(joined(Bags(rows.filter(pa.array(leads)), own), Bags(rows.filter(pa.array(~leads)), own), least))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["a", "b"])

    return placed.mapInArrow(compare, "a long, b long").distinct()


def similarity(h: np.ndarray, x: np.ndarray, g: np.ndarray, y: np.ndarray) -> float:
    """Weighted Jaccard similarity of two bags: hashes in order and their weights."""
    if not len(h) or not len(g):
        return 0.0
    at = np.minimum(np.searchsorted(h, g), len(h) - 1)
    both = h[at] == g
    common = float(np.minimum(x[at[both]], y[both]).sum())
    return common / (float(x.sum()) + float(y.sum()) - common)


def dealt(edges: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows to compare, written: centre, portion, class, text, for the leaves of each centre and in each portion the centre.

    classes names a document for each class. A class that is a leaf is once at one of its centres, so later steps find its text
    here, and the texts of all documents are shuffled for this step only.
    """
    sizes = edges.join(classes.select(F.col("class").alias("leaf"), "length"), "leaf")
    portions = sizes.groupBy("centre").agg(F.ceil((F.sum("length") + 1) / PORTION).cast("int").alias("portions"))
    portion = F.pmod(F.xxhash64("leaf"), "portions").cast("int").alias("portion")
    leaves = edges.join(portions, "centre").select(F.col("leaf").alias("class"), "centre", portion, (F.col("number") == 0).alias("once"))
    each = F.explode(F.sequence(F.lit(0), F.col("portions") - 1)).alias("portion")
    centres = portions.select(F.col("centre").alias("class"), "centre", each, F.lit(False).alias("once"))
    parts = leaves.union(centres).join(classes.select("class", F.col("doc_id").alias("named")), "class")
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull())
    return stored(parts.join(texts, F.col("named").eqNullSafe(F.col("doc_id"))).select("centre", "portion", "class", "once", "text"), "texts")


def verified(given: DataFrame, own: Weights, least: float = LEAST) -> DataFrame:
    """The edges a, b of the rows that were dealt whose whole texts are at least so similar."""
    leading = (F.col("class") != F.col("centre")).alias("is_leaf")
    placed = given.drop("once").repartition("centre", "portion").sortWithinPartitions("centre", "portion", leading)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple = (None, None, None)  # the centre now compared with, its shingles and weights
        for batch in batches:
            links, at = [], 0
            for texts in spans(batch["text"]):
                w = words(texts)
                h, row, count = bags(w)
                weight = count * own.of(h)
                first = np.searchsorted(row, np.arange(len(texts) + 1))
                classes_here = fingerprints(w)
                for i in range(len(texts)):
                    centre, name = batch["centre"][at + i].as_py(), batch["class"][at + i].as_py()
                    if classes_here[i] != name:  # another text under the same doc_id
                        continue
                    bag = h[first[i] : first[i + 1]], weight[first[i] : first[i + 1]]
                    if name == centre:
                        held = centre, *bag
                    elif held[0] == centre and similarity(held[1], held[2], *bag) >= least:
                        links.append((name, centre))
                at += len(texts)
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["a", "b"])

    return placed.mapInArrow(compare, "a long, b long")


def grouped(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """Per document: its columns but text and keys, class, and component_id, the smallest doc_id of its near-duplicates."""
    own = weights(docs.select("text"))
    rows = stored(signed(docs, own), "signatures")
    classes = stored(rows.where("class is not null").groupBy("class").agg(
        F.min("doc_id").alias("doc_id"), F.first("keys").alias("keys"), F.max("length").alias("length")), "classes")
    centred = stored(buckets(classes), "buckets")
    edges = stored(candidates(centred), "candidates")
    given = dealt(edges, docs, classes)
    links = stored(verified(given, own, least), "links")
    parts = stored(components(links), "parts")
    members = with_text(unsettled(centred, parts), given.where("once").select("class", "text"))
    more = stored(remaining(members, own, least), "links")
    if not more.isEmpty():
        parts = components(parts.toDF("a", "b").union(more))  # a star for each component says what its links said
    known = classes.select("class", "doc_id").join(parts, classes["class"] == parts["node"], "left").select("class", "doc_id", F.coalesce("component", "class").alias("component"))
    ids = known.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = known.join(ids, "component").select("class", "component", "component_id")
    return rows.drop("keys", "length").join(named, "class", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))


def duplicates(df: DataFrame) -> DataFrame:
    """Per document: doc_id, component_id, kept."""
    found = grouped(df.select("doc_id", "text"))
    return found.select("doc_id", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def deduplicated(df: DataFrame) -> DataFrame:
    """The documents without all but one of each component: the one of smallest doc_id, and the first of equal rows."""
    row = unused("row", df.columns)
    rows = stored(df.withColumn(row, F.monotonically_increasing_id()), "documents")
    found = stored(grouped(rows.select("doc_id", "text", F.col(row).alias("_row"))).select("doc_id", "_row", "component"), "components")
    in_order = F.struct(F.col("doc_id").isNull(), "doc_id", "_row")
    first = found.where("component is not null").groupBy("component").agg(F.min(in_order)["_row"].alias("_row"))
    later = found.where("component is not null").join(first, "_row", "left_anti").select(F.col("_row").alias(row))
    return rows.join(later, row, "left_anti").select(*df.columns)
