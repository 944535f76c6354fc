"""Operators that look at one text at a time, against brute force."""

import hashlib
import json
import random
import re
import struct

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from granary.llm import bpe, langid, pii, pseudolm, queries, tokencount

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BYTE_BPE = public_tokenizers.path(queries.BYTE_BPE)
WORD_PIECES = public_tokenizers.path(queries.WORD_PIECES)


@pytest.fixture(scope="module")
def encoding():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.vocabulary(BYTE_BPE), special_tokens={})


def test_bpe_matches_another_encoder(spark, sf_dir, texts, encoding):
    rows = queries.op2_byte_bpe(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = encoding.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_bpe_odd_texts(odd_docs, no_docs, encoding):
    rows = bpe.encoded(odd_docs, BYTE_BPE, public_tokenizers.PATTERN).select("text", "ids", "size").collect()
    for r in rows:
        ids = encoding.encode_ordinary(r.text or "")
        assert bytes(r.ids) == struct.pack(f"<{len(ids)}I", *ids) and r["size"] == "extra"
    assert bpe.digests(no_docs, BYTE_BPE, public_tokenizers.PATTERN).count() == 0


def test_token_counts_match_greedy_search(spark, sf_dir, texts):
    vocabulary = set(tokencount.pieces(WORD_PIECES))
    longest, seen = max(map(len, vocabulary)), {}

    def greedy(word):
        symbols, at, n = (*word.encode(), tokencount.END), 0, 0
        while at < len(symbols):
            end = next((e for e in range(min(len(symbols), at + longest), at, -1) if symbols[at:e] in vocabulary), None)
            if end is None:
                return 1
            at, n = end, n + 1
        return n

    for r in queries.op4_token_counts(spark, sf_dir).collect():
        words = WORD.findall(texts[r.doc_id].lower())
        for w in words:
            seen.setdefault(w, greedy(w))
        assert r.n_tokens == sum(map(seen.get, words))
    random.seed(1)
    odd = ["".join(random.choice("abcé日🎉1-") for _ in range(random.randint(1, 30))) for _ in range(500)] + ["x" * 3000]
    assert tokencount.lengths(pa.array(odd), tokencount.automaton(WORD_PIECES)).tolist() == [greedy(w) for w in odd]


def test_token_counts_of_odd_texts(odd_docs, no_docs):
    rows = {r.doc_id: r.n_tokens for r in tokencount.counted(odd_docs, WORD_PIECES).collect()}
    assert rows[3] == rows[4] == rows[5] == 0 and rows[6] == rows[7] == 3
    assert tokencount.counted(no_docs, WORD_PIECES).count() == 0


def test_uncovered_word_is_one_token():
    own = tokencount.Automaton([(97,), (97, tokencount.END), (98, tokencount.END), (97, 98)])
    assert tokencount.lengths(pa.array(["abb aab c ab", None]), own).tolist() == [2 + 1 + 1 + 1, 0]  # only the first word is covered


def test_language_of_held_out_texts(spark, sf_dir, documents):
    known = {r.doc_id: r.lang for r in documents.collect()}
    rows = [r for r in queries.op5_language_id(spark, sf_dir).collect() if r.held_out and known[r.doc_id]]
    assert rows and sum(r.lang_pred == known[r.doc_id] for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_texts(odd_docs, no_docs):
    rows = {r.doc_id: r for r in langid.identified(odd_docs).collect()}
    assert rows[3].lang_pred == rows[4].lang_pred == rows[5].lang_pred == rows[9].lang_pred == "und" and rows[3].score == 0
    assert rows[1].lang_pred in ("en", "de")
    assert langid.identified(no_docs).count() == 0
    alone = langid.predicted(odd_docs, langid.fitted(no_docs.select("text", "lang")))
    assert {r.lang_pred for r in alone.collect()} == {"und"} and "ids" in alone.columns


def test_language_of_one_letter(spark):
    rows = [("a day and a night", "en"), ("e um dia e uma noite", "pt")]
    filters = langid.fitted(spark.createDataFrame(rows, "text string, lang string"))
    found = filters.predict(pa.array(["A.", "e", "1 E", "q", "?", None])).to_pylist()
    assert [r["lang_pred"] for r in found] == ["en", "pt", "pt", "en", "und", "und"]  # q is in neither language
    assert found[0]["score"] > 0.9 and found[3]["score"] == found[4]["score"] == 0


def test_filters_hold_every_member_and_correct_for_chance():
    members = pa.table({"lang": [f"l{i:02}" for i in range(70)], "gram": list(range(1000, 1070))})
    filters = langid.Filters(members)
    for i in range(70):
        gram = langid.np.array([1000 + i], langid.np.uint32)
        assert filters.hits(gram, langid.np.zeros(1, int), 1)[0, i] == 1
    assert (filters.false_rate < 1e-3).all()


def base_by_plain_patterns(text):
    digits = lambda s: re.sub("[^0-9]", "", s)

    def luhn(s):
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(s))]
        return sum(v - 9 if v > 9 else v for v in doubled) % 10 == 0

    patterns = [
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda s: 12 <= len(digits(s)) <= 19 and luhn(digits(s))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    ]
    return sorted((m.start(), k, m.end()) for k, (p, good) in enumerate(patterns) for m in re.finditer(p, text) if good(m.group()))


def written(spans):
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def test_base_spans_match_plain_patterns(spark, sf_dir, texts):
    for r in queries.op7_personal_data(spark, sf_dir).collect():
        expected = written(base_by_plain_patterns(texts[r.doc_id]))
        assert r.base_sha256 == hashlib.sha256(expected.encode()).hexdigest()
        assert set(expected.split(",")) - {""} <= set(r.spans.split(","))


@pytest.mark.parametrize("text", [
    "a@b.c@d.e x@y.z", "1.2.3.4.5.6.7.8 256.1.1.1 0001.002.3.4", "@@@ a@ a@b a@b..c a@b.c.@d.e", "+1 (755) 555-9729 ... +12",
    "4111 1111-1111 1111 2", "9" * 3000, "a" * 2000 + "@" + "b" * 2000, "1.1.1.1" * 5, "00000000001.1.1.1 +1+1+1", "é@é.é +１２３４５６７８９０１",
])
def test_base_spans_of_odd_texts(text):
    assert [(a, k - 1, b) for a, b, k in pii.base_spans(text)] == base_by_plain_patterns(text)


def test_long_runs_take_linear_time():
    assert [s[2] for s in pii.base_spans("0" * 9000 + "1.1.1.1")] == [2]
    for text in ("7" * 300_000, "a" * 300_000 + " @", "a@" * 50_000, "+1" + " " * 300_000):
        pii.base_spans(text)


def field():
    """Trained on texts in which numbers repeat in full."""
    samples = []
    for i in range(40):
        text = f"call +1 (755) 555-97{i:02} now or +1 (755) 555-97{i:02} later, not {i} nor id{i}, ref 555-12{i:02} apart"
        samples.append(pii.tokens(text, pii.base_spans(text)))
    return pii.trained(samples)


def test_repeated_token_takes_the_label_of_its_twin():
    text = "call +1 (755) 555-9729 today. Then 555-9729 again, room 12."
    found = pii.all_spans(text, field())
    assert [s["base"] for s in found] == [True, False]
    assert text[found[1]["start"] : found[1]["end"]] == "555-9729" and found[1]["kind"] == "phone"
    assert [s["base"] for s in pii.all_spans("Then 555-1234 again, room 12.", field())] == []


def test_personal_data_of_odd_texts(odd_docs, no_docs):
    rows = {r.doc_id: r for r in pii.digests(odd_docs).collect()}
    assert (rows[8].n_email, rows[8].n_phone, rows[8].n_ip, rows[8].n_card) == (1, 1, 1, 0)
    assert rows[3].spans == "" and rows[3].base_sha256 == hashlib.sha256(b"").hexdigest()
    clean = {r.doc_id: r for r in pii.redacted(odd_docs).collect()}
    assert clean[8].text.startswith("mail <EMAIL> or <PHONE> from <IP> word0") and clean[8].spans == "extra" and clean[3].text is None
    assert pii.digests(no_docs).count() == 0 and pii.redacted(no_docs).count() == 0


def test_training_beats_the_start(documents):
    vocabulary = pseudolm.Vocabulary(pseudolm.counted(documents.select("text")))
    w = pseudolm.words(pa.array([r.text for r in documents.select("text").collect()]))
    cls = vocabulary.classes(pseudolm.hashes(w))
    near = pseudolm.contexts(cls, w.row)
    score = lambda network: network.log_probability(near, cls).mean()
    assert score(pseudolm.trained(documents.select("text"), vocabulary)) > score(pseudolm.Network()) + 0.1


def test_probabilities_of_a_class_do_not_exceed_one(documents):
    vocabulary = pseudolm.Vocabulary(pseudolm.counted(documents.select("text")))
    w = pseudolm.words(pa.array([r.text for r in documents.select("text").collect()]))
    distinct = pseudolm.np.unique(pseudolm.hashes(w))
    mass = pseudolm.np.bincount(vocabulary.classes(distinct), pseudolm.np.exp(vocabulary.log_in_class(distinct)))
    assert mass.max() <= 1 + 1e-9


def test_contexts_stay_inside_a_text():
    near = pseudolm.contexts(pseudolm.np.array([5, 6, 7, 8]), pseudolm.np.array([0, 0, 0, 1]))
    assert near.tolist() == [[0, 0, 6, 7], [0, 5, 7, 0], [5, 6, 0, 0], [0, 0, 0, 0]]


def test_scores_of_odd_texts(odd_docs, no_docs):
    scored = pseudolm.scored(odd_docs)
    rows = {r.doc_id: r for r in scored.collect()}
    assert rows[3].n_words == 0 and rows[3].log_likelihood == 0 and rows[10].n_words == 4000
    assert rows[6].log_likelihood == rows[7].log_likelihood < 0 and "ids" in scored.columns
    assert pseudolm.scored(no_docs).count() == 0


def test_counts_beside_neighbours_leave_a_task_in_blocks(documents):
    texts = documents.select("text")
    vocabulary = pseudolm.Vocabulary(pseudolm.counted(texts))
    sent = pseudolm.neighbour_counts(texts, vocabulary).collect()
    cells = sum(len(r.at) // 2 for r in sent)
    assert cells > 5000 and len(sent) * 20 < cells  # a row for each count would be as many rows as counts
    w = pseudolm.words(pa.array([r.text for r in texts.collect()]))
    h = pseudolm.hashes(w)
    cls, at, frequent, rare = vocabulary.found(h)
    assert (cls == vocabulary.classes(h)).all() and (rare == vocabulary.is_rare(h)).all() and (frequent == vocabulary.in_frequent(h)[1]).all()
    near, beside = pseudolm.contexts(cls, w.row), pseudolm.neighbours(texts, vocabulary)
    for side in (0, 1):
        places, n = pseudolm.np.unique(pseudolm.np.stack([near[:, 1 + side], cls]), axis=1, return_counts=True)
        assert (beside.classes[side, places[0], places[1]] == n).all() and beside.classes[side].sum() == n.sum()
        places, n = pseudolm.np.unique(pseudolm.np.stack([at[frequent], near[frequent, 1 + side]]), axis=1, return_counts=True)
        assert (beside.frequent[places[0], side, places[1]] == n).all() and beside.frequent[:, side].sum() == n.sum()


def test_large_scores_stay_finite_and_slopes_are_those_of_the_loss():
    random = pseudolm.np.random.default_rng(1)
    near, cls = random.integers(0, pseudolm.CLASSES, (300, 4)), random.integers(0, pseudolm.CLASSES, 300)
    for size in (1, 1000):  # 1000: exponentials of the scores themselves overflow
        network = pseudolm.Network(pseudolm.Network().flat() * size)
        embedded, inner, inner_bias, outer, outer_bias = [p.astype(float) for p in network.parts]
        x = embedded[near].reshape(300, -1)
        hidden = pseudolm.np.tanh(x @ inner + inner_bias)
        score = hidden @ outer + outer_bias
        score -= score.max(axis=1, keepdims=True)
        expected = score - pseudolm.np.log(pseudolm.np.exp(score).sum(axis=1, keepdims=True))
        rows = pseudolm.np.arange(300)
        assert network.log_probability(near, cls) == pytest.approx(expected[rows, cls], rel=1e-3, abs=1e-3)
        p = pseudolm.np.exp(expected)
        p[rows, cls] -= 1
        network.learn(near, cls)  # the first means are a tenth of the slopes
        assert network.first[3] == pytest.approx(hidden.T @ p / 3000, rel=1e-3, abs=1e-5)
        assert network.first[4] == pytest.approx(p.sum(axis=0) / 3000, rel=1e-3, abs=1e-5)
        assert network.first[1] == pytest.approx(x.T @ ((p @ outer.T) * (1 - hidden**2)) / 3000, rel=1e-2, abs=1e-5 * size)


def test_words_outside_the_table_have_their_own_probability(spark, monkeypatch):
    monkeypatch.setattr(pseudolm, "FREQUENT", 8)  # no word but those of own classes is frequent
    monkeypatch.setattr(pseudolm, "RANGE", 500)
    common = [f"c{i}" for i in range(pseudolm.OWN)]
    lines = [" ".join(common)] * 40
    pairs = [(f"x{i}", f"y{i}", f"z{i}") for i in range(60)]
    lines += [" ".join(p) for p in pairs for _ in range(5)]
    mixed_up = [f"{pairs[i][0]} {pairs[(i + 17) % 60][1]} {pairs[(i + 31) % 60][2]}" for i in range(60)]
    lines += mixed_up
    rows = [(i, text) for i, text in enumerate(lines)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    vocabulary = pseudolm.Vocabulary(pseudolm.counted(frame.select("text")))
    network, beside = pseudolm.trained(frame.select("text"), vocabulary), pseudolm.neighbours(frame.select("text"), vocabulary)
    w = pseudolm.words(pa.array(lines))
    h = pseudolm.hashes(w)
    cls = vocabulary.classes(h)
    near = pseudolm.contexts(cls, w.row)
    n, sides = pseudolm.np.zeros(len(h)), pseudolm.np.zeros(len(h))
    keys = list(zip(h.tolist(), near[:, 1].tolist(), near[:, 2].tolist()))
    for i, (word, left, right) in enumerate(keys):
        n[i] = sum(k[0] == word for k in keys)
        sides[i] = sum((k[0] == word) * ((k[1] == left) + (k[2] == right)) for k in keys) - 2
    around = beside.around(near[:, 1], near[:, 2], cls)
    assert around.min() >= 0 and vocabulary.n_rare == vocabulary.is_rare(h).sum() == 3 * 360
    in_class = pseudolm.log_beside(n, vocabulary.size[cls], sides, around)
    in_class[~vocabulary.is_rare(h)] = 0
    expected = pseudolm.np.bincount(w.row, network.log_probability(near, cls) + in_class)
    monkeypatch.setattr(pseudolm, "trained", lambda *_: network)
    found = {r.doc_id: r.log_likelihood for r in pseudolm.scored(frame).collect()}
    assert [found[i] for i in range(len(lines))] == pytest.approx(expected.tolist(), rel=1e-5)
    sound = pseudolm.np.mean([found[40 + i] for i in range(300)])
    assert sound > pseudolm.np.mean([found[340 + i] for i in range(60)]) + 1


def test_vocabulary_leaves_special_tokens_out():
    with open(WORD_PIECES, encoding="utf-8") as file:
        content = json.load(file)
    assert len(tokencount.pieces(WORD_PIECES)) == len(content["model"]["vocab"]) - sum(x["content"] in content["model"]["vocab"] for x in content["added_tokens"])
