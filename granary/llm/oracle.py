"""DuckDB statements for the text operators that SQL can express."""

from __future__ import annotations

from granary.llm import merkle, mixing, periodic, quality

WORDS = r"list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
LINES = r"list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))"


def quality_sql() -> str:
    rates = {"symbols": "n_symbols / nullif(n_words, 0)", "capitals": "n_capitals / nullif(word_chars, 0)",
             "dup_lines": "n_dup_lines / nullif(n_lines, 0)", "word_length": "word_chars / nullif(n_words, 0)"}
    unpivoted = " UNION ALL ".join(
        f"SELECT lang, source, '{m}' AS measure, {rate}::DOUBLE AS v FROM counted WHERE NOT base_failed" for m, rate in rates.items())
    value = f"CASE WHEN b = {quality.ZERO_BIN} THEN 0 ELSE exp(b * {quality.LOG_GAMMA!r}) * (2 / (1 + exp({quality.LOG_GAMMA!r}))) END"

    def fences(name: str, keys: str) -> str:
        return f"""
        {name}_run AS (SELECT {keys}, measure, bin, sum(sum(n)) OVER (PARTITION BY {keys}, measure ORDER BY bin) AS up_to,
            sum(sum(n)) OVER (PARTITION BY {keys}, measure) AS total FROM bins GROUP BY {keys}, measure, bin),
        {name}_q AS (SELECT {keys}, measure, total, min(bin) FILTER (up_to * 4 >= total) AS b1, min(bin) FILTER (up_to * 4 >= total * 3) AS b3
            FROM {name}_run GROUP BY {keys}, measure, total),
        {name} AS (SELECT {keys}, measure, total, {value.replace('b ', 'b1 ')} AS low, {value.replace('b ', 'b3 ')} AS high FROM {name}_q)"""

    checks = []
    for m, rate in rates.items():
        own = quality.MEASURES[m]
        reach = f"greatest({own.spread} * (f.high - f.low), {own.margin})"
        least = f"AND v >= f.low - {reach}" if own.below else ""
        checks.append(f"""
        coalesce((SELECT bool_and(v <= f.high + {reach} {least}) FROM (SELECT {rate}::DOUBLE AS v) r, fence f
            WHERE f.measure = '{m}' AND f.lang IS NOT DISTINCT FROM c.lang AND f.source IS NOT DISTINCT FROM c.source), false)""")
    return f"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
    w AS (SELECT *, {WORDS} AS ws, {LINES} AS ls FROM d),
    windows AS (SELECT rid, i, ws[i:i + 7] AS win FROM (SELECT rid, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)),
    repeats AS (SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, win) > 1),
    covered AS (SELECT rid, sum(add) AS n FROM (SELECT rid,
        least(8, coalesce(i - lag(i) OVER (PARTITION BY rid ORDER BY i), 8)) AS add FROM repeats) GROUP BY rid),
    plain AS (SELECT doc_id, lang, source, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(ls)::BIGINT AS n_lines,
        (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
        length(regexp_replace(t, '\\P{{Lu}}', '', 'g'))::BIGINT AS n_capitals FROM w LEFT JOIN covered USING (rid)),
    counted AS (SELECT *, n_words < {quality.FEWEST_WORDS} OR 100 * n_repeat_words > {quality.MOST_REPEATED} * n_words AS base_failed FROM plain),
    sketches AS (SELECT lang, source, measure, CASE WHEN v > 0 THEN ceil(ln(v) / {quality.LOG_GAMMA!r})::INTEGER ELSE {quality.ZERO_BIN} END AS bin,
        count(*) AS n FROM ({unpivoted}) GROUP BY ALL),
    language AS (SELECT lang, measure, bin, sum(n) AS n, sum(sum(n)) OVER (PARTITION BY lang, measure) AS total FROM sketches GROUP BY lang, measure, bin),
    bins AS (SELECT g.lang, g.source, g.measure, w.bin, coalesce(o.n, 0)::HUGEINT * w.total + {quality.PRIOR} * w.n AS n
        FROM (SELECT DISTINCT lang, source, measure FROM sketches) g JOIN language w ON g.lang IS NOT DISTINCT FROM w.lang AND g.measure = w.measure
        LEFT JOIN sketches o ON g.lang IS NOT DISTINCT FROM o.lang AND g.source IS NOT DISTINCT FROM o.source AND g.measure = o.measure AND w.bin = o.bin),
    {fences('fence', 'lang, source')}
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        NOT base_failed AND {' AND '.join(checks)} AS kept
    FROM counted c"""


def random_key(*parts: str) -> str:
    whole = f"concat_ws(':', '{mixing.SEED}', " + ", ".join(f"coalesce(CAST({p} AS VARCHAR), '')" for p in parts) + ")"
    return f"CAST('0x' || substr(md5({whole}), 1, 15) AS BIGINT)"


def mixing_sql() -> str:
    levels, node = "", "units"
    for level in range(mixing.LEVELS):
        key = random_key(str(level), "source IS NULL", "source", "pass", "block")
        levels += f"""
    level{level} AS (SELECT source, block, pass, 2 * node + CAST(2 * row_number() OVER (PARTITION BY node
        ORDER BY {key}, source NULLS FIRST, block, pass) > count(*) OVER (PARTITION BY node) AS INTEGER) AS node FROM {node}),"""
        node = f"level{level}"
    return f"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, {random_key("doc_id")} AS random,
        len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents),
    sources AS (SELECT source, count(*) AS n, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
    weighed AS (SELECT *, {mixing.MOST_PASSES} * source_size AS most,
        list_extract({list(mixing.WEIGHTS)}, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1)::BIGINT) AS weight FROM sources),
    shares AS (SELECT *, (sum(source_size) OVER () - sum(most) OVER w + most) / (sum(weight) OVER () - sum(weight) OVER w + weight) AS share
        FROM weighed WINDOW w AS (ORDER BY most / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
    level_ AS (SELECT share FROM shares WHERE most > share * weight ORDER BY most / weight, source NULLS LAST LIMIT 1),
    targets AS (SELECT source, n, source_size, least(most::DOUBLE, coalesce((SELECT share FROM level_) * weight, most)) AS target FROM shares),
    fulls AS (SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), {mixing.MOST_PASSES}) ELSE 0 END::BIGINT AS full_,
        ceil(sqrt(n))::BIGINT AS blocks FROM targets),
    passes AS (SELECT *, CASE WHEN full_ < {mixing.MOST_PASSES} THEN greatest(target - full_ * source_size, 0) ELSE 0 END AS rest FROM fulls),
    known AS (SELECT d.*, p.* EXCLUDE (source), random % blocks AS block FROM d JOIN passes p ON d.source IS NOT DISTINCT FROM p.source),
    sums AS (SELECT source, block, full_, rest, sum(size) AS words FROM known GROUP BY ALL),
    after_ AS (SELECT *, sum(words) OVER (PARTITION BY source ORDER BY block) AS up_to FROM sums),
    cuts AS (SELECT source, min(block) AS cut_block, arg_min(up_to - words, block) AS before FROM after_ WHERE up_to > rest AND rest > 0 GROUP BY source),
    placed AS (SELECT k.*, cut_block, before FROM known k LEFT JOIN cuts c ON k.source IS NOT DISTINCT FROM c.source),
    at_cut AS (SELECT *, before + sum(size) OVER (PARTITION BY source ORDER BY random, doc_id NULLS FIRST, rid ROWS UNBOUNDED PRECEDING) AS up_to
        FROM placed WHERE block = cut_block),
    inside AS (SELECT rid, source, up_to FROM at_cut WHERE up_to <= rest),
    reached AS (SELECT source, max(up_to) AS reached FROM inside GROUP BY source),
    free AS (SELECT p.*, rest - coalesce(reached, before) AS gap FROM placed p LEFT JOIN reached r ON p.source IS NOT DISTINCT FROM r.source
        WHERE block >= cut_block AND rid NOT IN (SELECT rid FROM inside)),
    closest AS (SELECT rid FROM free WHERE abs(size - gap) < gap
        QUALIFY row_number() OVER (PARTITION BY source ORDER BY abs(size - gap), random, doc_id NULLS FIRST, rid) = 1),
    picked AS (SELECT rid FROM inside UNION SELECT rid FROM closest),
    units AS (SELECT source, block, unnest(range(1, taken + 1)) AS pass, 0 AS node FROM (SELECT s.source, block,
        full_ + CASE WHEN block <= cut_block THEN 1 ELSE 0 END AS taken FROM sums s LEFT JOIN cuts c ON s.source IS NOT DISTINCT FROM c.source)),{levels}
    dealt AS (SELECT source, block, list(node ORDER BY pass) AS nodes FROM {node} GROUP BY source, block),
    copied AS (SELECT p.*, full_ + CASE WHEN block < cut_block OR rid IN (SELECT rid FROM picked) THEN 1 ELSE 0 END AS copies FROM placed p),
    joined AS (SELECT c.*, coalesce(nodes[:copies], []) AS own FROM copied c
        LEFT JOIN dealt t ON c.source IS NOT DISTINCT FROM t.source AND c.block = t.block)
    SELECT doc_id, size, source_size, target, size * copies AS taken, CASE WHEN size = 0 THEN '' ELSE array_to_string(
        CASE WHEN len(own) < copies THEN list_append(own, coalesce(own[-1], 0)) ELSE own END, ',') END AS shards
    FROM joined"""


# a checksum from its table of bytes: crc(key) is the one of the decimal key, where bytes_ is joined
CHECKSUMS = """bytes_ AS (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS of_byte)"""


def crc(key: str) -> str:
    digits = f"list_transform(string_split(CAST({key} AS VARCHAR), ''), lambda x: unicode(x)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {digits}), lambda c, b: xor(c >> 8, of_byte[(xor(c, b) & 255) + 1])), 4294967295)"


def periodic_sql() -> str:
    least = f"greatest({periodic.LEAST}, {periodic.REPEATS} * q)"
    return f"""
    WITH {CHECKSUMS},
    d AS (SELECT row_number() OVER () AS rid, doc_id, {crc("doc_id")} AS h, {WORDS} AS ws FROM (SELECT doc_id, coalesce(text, '') AS t, of_byte FROM documents, bytes_)),
    placed AS (SELECT *, len(ws) AS n, h // 10 AS g, CASE WHEN h % 10 = 0 AND len(ws) > 0 THEN (h // 10) % len(ws) END AS a FROM d),
    known AS (SELECT rid, doc_id, n, CASE WHEN a IS NULL THEN ws ELSE list_transform(range(n),
        lambda i: ws[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END]) END AS ws FROM placed),
    w AS (SELECT rid, n, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS i FROM known),
    pairs AS (SELECT x.rid, x.i, y.i - x.i AS q FROM w x JOIN w y ON x.rid = y.rid AND x.word = y.word AND y.i > x.i AND {periodic.REPEATS} * (y.i - x.i) <= x.n),
    stretches AS (SELECT rid, q, min(i) AS s, max(i) - min(i) + 1 + q AS l
        FROM (SELECT *, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS island FROM pairs) GROUP BY rid, q, island HAVING max(i) - min(i) + 1 + q >= {least}),
    runs AS (SELECT * FROM stretches r WHERE NOT EXISTS (SELECT 1 FROM stretches b WHERE b.rid = r.rid AND b.q < r.q AND b.s <= r.s AND b.s + b.l >= r.s + r.l)),
    lists AS (SELECT rid, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS lines,
        arg_min({{'s': s, 'l': l, 'q': q}}, {{'a': -l, 'b': s, 'c': q}}) AS best FROM runs GROUP BY rid),
    dropped AS (SELECT DISTINCT w.rid, i FROM w JOIN runs r ON w.rid = r.rid AND i >= s + q AND i < s + l),
    kept AS (SELECT rid, string_agg(word, ' ' ORDER BY i) AS words FROM w ANTI JOIN dropped USING (rid, i) GROUP BY rid)
    SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.s::BIGINT AS start, best.l::BIGINT AS length, best.q::BIGINT AS period,
        (1000 * best.l // best.q)::BIGINT AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(words, '')) AS collapsed_sha256
    FROM known LEFT JOIN lists USING (rid) LEFT JOIN kept USING (rid)"""


def merkle_sql() -> str:
    def leaf(text: str) -> str:
        values = ("doc_id", "source", "lang", "n_chars", text)
        fields = (f"coalesce(strlen(CAST({v} AS VARCHAR)) || ':' || CAST({v} AS VARCHAR), '-')" for v in values)
        return f"sha256({' || '.join(fields)})"

    def tree(name: str, nodes: str) -> str:
        """name: all nodes (k, lv, p, m, h), and runs of siblings; nodes has group k, place p, group size m, digest h."""
        return f"""
    {name} AS (SELECT k, 0 AS lv, p, m, h FROM {nodes} UNION ALL
        SELECT k, lv + 1, p // {merkle.ARITY}, (m + {merkle.ARITY - 1}) // {merkle.ARITY}, sha256(string_agg(h, '' ORDER BY p))
        FROM {name} WHERE m > 1 GROUP BY k, lv, p // {merkle.ARITY}, m),
    {name}_runs AS (SELECT k, lv, p // {merkle.ARITY} AS r, list(h ORDER BY p) AS hs FROM {name} WHERE m > 1 GROUP BY k, lv, p // {merkle.ARITY})"""

    def climb(name: str, start: str, runs: str) -> str:
        """rid, proof and node f at every level lv, from start (rid, k, p, proof, f)."""
        own = f"p % {merkle.ARITY}"
        before, behind = f"array_to_string(hs[1:{own}], '')", f"array_to_string(hs[{own} + 2:], '')"
        return f"""
    {name} AS (SELECT rid, k, 0 AS lv, p, proof, f FROM {start} UNION ALL
        SELECT rid, c.k, c.lv + 1, c.p // {merkle.ARITY}, proof || {before} || {behind}, sha256({before} || f || {behind})
        FROM {name} c JOIN {runs} r ON c.k = r.k AND c.lv = r.lv AND c.p // {merkle.ARITY} = r.r),
    {name}_top AS (SELECT rid, k, arg_max(proof, lv) AS proof, arg_max(f, lv) AS f FROM {name} GROUP BY rid, k)"""

    rank = "row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, h, rid) - 1"
    return f"""
    WITH RECURSIVE {CHECKSUMS},
    names AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS k FROM (SELECT DISTINCT source FROM documents)),
    d AS (SELECT row_number() OVER () AS rid, doc_id, source, {leaf("text")} AS h,
        CASE WHEN {crc("doc_id")} % 2 = 0 THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf("text")} END AS f FROM documents, bytes_),
    leaves AS (SELECT rid, doc_id, k, h, f, {rank} AS p, count(*) OVER (PARTITION BY k) AS m, '' AS proof
        FROM d JOIN names n ON d.source IS NOT DISTINCT FROM n.source),
    {tree("low", "leaves")}, {climb("path", "leaves", "low_runs")},
    subroots AS (SELECT 0 AS k, k AS p, count(*) OVER () AS m, h FROM low WHERE m = 1),
    {tree("top", "subroots")},
    middle AS (SELECT rid, 0 AS k, k AS p, proof, f FROM path_top),
    {climb("over", "middle", "top_runs")}
    SELECT doc_id, leaves.h AS leaf, s.h AS subroot, t.h AS root, sha256(o.proof) AS proof_sha256, o.f AS folded_root, o.f = t.h AS verified
    FROM leaves JOIN subroots s ON leaves.k = s.p JOIN over_top o USING (rid) JOIN (SELECT h FROM top WHERE m = 1) t ON true"""


def oracle_sql() -> dict[str, str]:
    return {"op6_source_mix": mixing_sql(), "op9_adaptive_quality": quality_sql(), "op11_periodic_runs": periodic_sql(),
            "op13_merkle_manifest": merkle_sql()}
