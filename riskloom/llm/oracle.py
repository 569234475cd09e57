"""DuckDB statements for the queries that SQL can express, written from their definitions.

Operators 1, 2, 6 and 8 learn models or call a tokenizer, operator 11 parses decoded keys;
they have none.
"""

from __future__ import annotations

from riskloom.llm import licenses, rules

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BLANK = r"[^\x20\x09-\x0D]"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def license_scan() -> str:
    names = {licenses.normal(s): k for k, s in licenses.dictionary().items()}
    known = "MAP {" + ", ".join(f"{_quoted(s)}: {_quoted(k)}" for s, k in names.items()) + "}"
    tagged = f"regexp_replace(coalesce(text, ''), {_quoted(licenses.TAG_LINE)}, {_quoted(chr(92) + '1.' + chr(10))}, 'g')"
    joined = f"regexp_replace({tagged}, {_quoted(licenses.CONTINUED)}, {_quoted(' ' + chr(92) + '1')}, 'g')"
    clean = f"regexp_replace({_LOWER.format(joined)}, {_quoted(licenses.OTHER)}, ' ', 'g')"
    parts = [f"""WITH s AS (SELECT doc_id, list_transform(regexp_split_to_array({clean}, {_quoted(licenses.ENDS)}),
      lambda x: regexp_replace(trim(x, ' .'), {_quoted(licenses.HOLDER)}, {_quoted(licenses.ANY_HOLDER)})) AS s FROM documents),
    f AS (SELECT doc_id, list_filter(list_transform(s, lambda x: {known}[x]), lambda x: x IS NOT NULL) AS f FROM s),
    r0 AS (SELECT doc_id, len(f) AS n, coalesce(array_to_string(list_transform(f, lambda x: ',' || x || ','), ''), '') AS l, '' AS names FROM f)"""]
    last = 0
    for i, (name, ids) in enumerate(licenses.rules(), 1):
        pattern = _quoted("," + ",,".join(ids) + ",")
        parts.append(f"""r{i} AS (SELECT doc_id, n, replace(l, {pattern}, '|') AS l, CASE WHEN contains(l, {pattern})
      AND NOT contains(',' || names || ',', ',{name},') THEN trim(names || ',{name}', ',') ELSE names END AS names FROM r{i - 1})""")
        last = i
    return ",\n".join(parts) + f"""
    SELECT doc_id, names AS licenses, trim(regexp_replace(l, '[,|]+', ',', 'g'), ',') AS unmatched, n::BIGINT AS n_sentences,
      CASE WHEN names <> '' THEN 'licensed' WHEN n > 0 THEN 'unknown' ELSE 'none' END AS verdict FROM r{last}"""


def url_filter(rules_: list[tuple[str, str, str]], rounds: int = 12, damping: float = 0.85) -> str:
    host = _LOWER.format("regexp_extract({}, '://([^/?#]*)', 1)")
    cases = []
    for h, p, verdict in sorted(rules_, key=lambda r: (len(r[0] + r[1]), r[2] == "block"), reverse=True):
        cases.append((f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", h + p, verdict))
    rule = "CASE " + " ".join(f"WHEN {c} THEN '{r}'" for c, r, _ in cases) + " END"
    verdict = "CASE " + " ".join(f"WHEN {c} THEN '{v}'" for c, _, v in cases) + " END"
    out = [f"""WITH p AS MATERIALIZED (SELECT page_id, html, {host.format("coalesce(url, '')")} AS host,
      regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
    q AS MATERIALIZED (SELECT *, {rule} AS rule, {verdict} AS fit FROM p),
    k AS (SELECT host, unnest(regexp_extract_all(coalesce(html, ''), '(?i)\\bhref\\s*=\\s*["'']?([^"''\\s>]+)', 1)) AS link
      FROM q WHERE host <> ''),
    e1 AS (SELECT host AS a, CASE WHEN contains(link, '://') THEN {host.format('link')}
      WHEN starts_with(link, '//') THEN {host.format("'x:' || link")}
      WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.\\-]*:') THEN '' ELSE host END AS b FROM k),
    labels AS (SELECT DISTINCT string_split(host, '.') AS l FROM q WHERE host <> ''),
    up AS (SELECT DISTINCT array_to_string(l[i:], '.') AS low, array_to_string(l[i + 1:], '.') AS high
      FROM (SELECT l, unnest(range(1, greatest(1, len(l) - 2) + 1)) AS i FROM labels)),
    ties AS (SELECT low, high FROM up WHERE low <> high AND contains(high, '.')),
    e AS MATERIALIZED (SELECT a, b, sum(n) AS n FROM (SELECT a, b, 1.0::DOUBLE AS n FROM e1 WHERE b <> ''
      UNION ALL SELECT low, high, 1.0 FROM ties UNION ALL SELECT high, low, 1.0 FROM ties) GROUP BY a, b),
    steps0 AS (SELECT 'allow' AS kind, a AS host, b AS dst, n FROM e UNION ALL SELECT 'block', b, a, n FROM e),
    steps AS MATERIALIZED (SELECT kind, host, dst, n / sum(n) OVER (PARTITION BY kind, host) AS p FROM steps0),
    m0 AS MATERIALIZED (SELECT fit AS kind, host, count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY fit) AS mass
      FROM q WHERE host <> '' AND fit IS NOT NULL GROUP BY fit, host)"""]
    for i in range(1, rounds + 1):
        out.append(f"""m{i} AS MATERIALIZED (SELECT kind, host, sum(mass) AS mass FROM (
      SELECT kind, dst AS host, {damping} * p * mass AS mass FROM steps JOIN m{i - 1} USING (kind, host)
      UNION ALL SELECT kind, host, (1 - {damping}) * mass FROM m0) GROUP BY kind, host)""")
    return ",\n".join(out) + f""",
    g AS (SELECT host, sum(CASE WHEN kind = 'allow' THEN mass ELSE 0 END) AS trust,
      sum(CASE WHEN kind = 'block' THEN mass ELSE 0 END) AS distrust FROM m{rounds} GROUP BY host),
    j AS (SELECT host, distrust > trust AND distrust > 1.0 / (SELECT count(DISTINCT host) FROM q WHERE host <> '') AS blocked FROM g)
    SELECT page_id, q.host, path, rule, coalesce(fit, CASE WHEN blocked THEN 'block' ELSE 'allow' END) AS verdict
    FROM q LEFT JOIN j USING (host)"""


def suffix_array_dedup(length: int = 50) -> str:
    two = 2 * length
    return f"""WITH d AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    w AS MATERIALIZED (SELECT doc_id, i, md5_number(substr(h, (2 * i + 1)::BIGINT, {two})) AS s
      FROM (SELECT doc_id, h, unnest(range(0, strlen(h) // 2 - {length} + 1)) AS i FROM d)),
    f AS MATERIALIZED (SELECT s, min(doc_id) AS least FROM w GROUP BY s HAVING min(doc_id) < max(doc_id)),
    c AS (SELECT w.doc_id, w.i FROM w JOIN f USING (s) WHERE f.least < w.doc_id),
    b AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + {length} THEN 0 ELSE 1 END AS fresh FROM c),
    r AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM b),
    spans AS MATERIALIZED (SELECT doc_id, min(i) AS a, max(i) + {length} AS z FROM r GROUP BY doc_id, run),
    gaps AS (SELECT doc_id, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS z FROM spans
      UNION ALL SELECT doc_id, max(z), NULL FROM spans GROUP BY doc_id),
    kept AS (SELECT doc_id, string_agg(substr(h, (2 * a + 1)::BIGINT, coalesce(2 * (z - a), strlen(h))::BIGINT), '' ORDER BY a) AS h
      FROM gaps JOIN d USING (doc_id) GROUP BY doc_id),
    t AS (SELECT doc_id, sum(z - a) AS gone, count(*) AS n FROM spans GROUP BY doc_id)
    SELECT d.doc_id, (strlen(d.h) // 2)::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed,
      coalesce(n, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256
    FROM d LEFT JOIN t USING (doc_id) LEFT JOIN kept USING (doc_id)"""


def quality_rules(alpha: float = 0.05, delta: float = 0.05) -> str:
    level = {}
    for r, (top, bottom, cutoffs) in rules.RULES.items():
        level[r] = " + ".join(f"({top}::DOUBLE / greatest({bottom}, 1) <= {c!r}::DOUBLE)::INT" for c in cutoffs)
    limit = alpha / len(rules.RULES)
    found = " UNION ALL ".join(
        f"SELECT stratum, '{r}' AS rule, {level[r]} AS level, {len(rules.RULES[r][2])} AS places FROM good" for r in rules.RULES)
    reject = " OR ".join(f"coalesce({level[r]} < max(ok) FILTER (WHERE rule = '{r}'), false)" for r in rules.RULES)
    for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals"):
        reject = reject.replace(name, f"any_value({name})")
    return f"""WITH base AS (SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t FROM documents),
    u AS MATERIALIZED (SELECT doc_id, stratum, t, regexp_extract_all(t, '{_BLANK}+') AS w,
      list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_BLANK}')) AS l FROM base),
    g AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM u)),
    again AS (SELECT doc_id, i FROM g JOIN (SELECT doc_id, g FROM g GROUP BY doc_id, g HAVING count(*) > 1) USING (doc_id, g)),
    rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM again, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
    s AS MATERIALIZED (SELECT doc_id, stratum, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
      length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
      (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
      len(l)::BIGINT AS n_lines, length(regexp_replace(t, '[^A-Z]+', '', 'g'))::BIGINT AS n_capitals
      FROM u LEFT JOIN rep USING (doc_id)),
    v AS MATERIALIZED (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s),
    good AS MATERIALIZED (SELECT DISTINCT v.* EXCLUDE (doc_id), t FROM v JOIN u USING (doc_id) JOIN (SELECT doc_id FROM labels WHERE quality IS NOT NULL GROUP BY doc_id
      HAVING max(quality) = 1) USING (doc_id) WHERE NOT base_failed),
    found AS ({found}),
    tests AS (SELECT stratum, rule, place, count(*) AS n, count(*) FILTER (WHERE level < place) AS k
      FROM (SELECT *, unnest(range(1, places + 1)) AS place FROM found) GROUP BY stratum, rule, place),
    judged AS (SELECT *, CASE WHEN k < n * {limit!r} THEN list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1)
      - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({limit!r}) + (n - i) * ln(1 - {limit!r})))) <= {delta!r} /
      ((SELECT count(DISTINCT stratum) FROM good) * {len(rules.RULES)}) ELSE false END AS safe FROM tests),
    run AS (SELECT stratum, rule, place, min(safe::INT) OVER (PARTITION BY stratum, rule ORDER BY place) AS ok1 FROM judged),
    cut AS (SELECT stratum, rule, sum(ok1) AS ok FROM run GROUP BY stratum, rule)
    SELECT doc_id, any_value(n_words) AS n_words, any_value(word_chars) AS word_chars, any_value(n_symbols) AS n_symbols,
      any_value(n_dup_lines) AS n_dup_lines, any_value(n_repeat_words) AS n_repeat_words, any_value(base_failed) AS base_failed,
      NOT any_value(base_failed) AND NOT ({reject}) AS kept
    FROM v LEFT JOIN cut USING (stratum) GROUP BY doc_id"""


def near_dedup(percent: int = 80) -> str:
    return f"""WITH RECURSIVE u AS MATERIALIZED (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_BLANK}+') AS w
      FROM documents),
    s AS MATERIALIZED (SELECT DISTINCT doc_id, s FROM (SELECT doc_id, unnest(CASE WHEN len(w) >= 2
      THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) ELSE w END) AS s FROM u)),
    n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    k AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b USING (s) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
    l AS MATERIALIZED (SELECT a, b FROM k JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
      WHERE 100 * k >= {percent} * (x.n + y.n - k)),
    ways AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
    reach(a, b) AS (SELECT a, b FROM ways UNION SELECT reach.a, ways.b FROM reach JOIN ways ON reach.b = ways.a),
    c AS (SELECT a, least(a, min(b)) AS c FROM reach GROUP BY a)
    SELECT u.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(c, u.doc_id) AS component_id,
      coalesce(c, u.doc_id) = u.doc_id AS kept FROM u LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.a = u.doc_id"""


def benchmark_leaks(words: int = 5, percent: int = 80) -> str:
    split = "list_filter(string_split(regexp_replace(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+', ' ', 'g'), ' '), lambda x: x <> '')"
    grams = f"list_transform(range(1, len(w) - {words - 2}), lambda i: array_to_string(w[i:i + {words - 1}], ' '))"
    weight = f"coalesce(list_sum(list_transform({{}}, lambda x: length(x) - {words - 1})), 0)"
    return f"""WITH d AS MATERIALIZED (SELECT doc_id, w, {grams} AS g FROM (SELECT doc_id, {split} AS w FROM documents)),
    t AS MATERIALIZED (SELECT item_id, len(w) AS n, {grams} AS g FROM (SELECT item_id, {split} AS w FROM benchmark) WHERE len(w) >= {words}),
    tg AS (SELECT DISTINCT item_id, n, unnest(g) AS g FROM t),
    dg AS (SELECT doc_id, unnest(g) AS g, generate_subscripts(g, 1) - 1 AS place FROM d),
    hit AS (SELECT doc_id, item_id, n, unnest(range(greatest(0, place - n + {words}), least(place, greatest(0, len(w) - n)) + 1)) AS s
      FROM dg JOIN tg USING (g) JOIN d USING (doc_id)),
    f AS (SELECT doc_id, item_id, s, list_distinct(d.g[s + 1:s + n - {words - 1}]) AS fa
      FROM (SELECT DISTINCT * FROM hit) JOIN d USING (doc_id)),
    x AS (SELECT doc_id, item_id, s, n, {weight.format('list_intersect(fa, g)')} AS shared, {weight.format('fa')} AS a,
      {weight.format('list_distinct(g)')} AS b FROM f JOIN t USING (item_id)),
    y AS (SELECT *, shared / (a + b - shared) AS similarity FROM x WHERE 100 * shared >= {percent} * (a + b - shared))
    SELECT doc_id, item_id, s::BIGINT AS first_word, n::BIGINT AS n_words, round(similarity, 6)::DOUBLE AS similarity
    FROM y QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY y.similarity DESC, s, n DESC) = 1"""


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of a string's UTF-8 bytes, bit by bit."""
    return f"""xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, octet_length(encode({text}))::BIGINT),
      lambda i: ('0x' || substr(hex({text}), (2 * i + 1)::BIGINT, 2))::BIGINT)),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""


def spelling_variants() -> str:
    low = _LOWER.format("unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\u00C0-\u00FF]+'))")
    return f"""WITH RECURSIVE runs AS (SELECT doc_id, run, count(*) AS n FROM (SELECT doc_id, {low} AS run FROM documents)
      WHERE length(run) >= 7 GROUP BY doc_id, run),
    hashed AS (SELECT run, n, {_crc32("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM runs),
    words AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM (SELECT n, CASE WHEN h % 31 = 0
      THEN run[:(h % length(run))::BIGINT] || run[(h % length(run))::BIGINT + 2:] ELSE run END AS word FROM hashed)
      WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
    cuts AS MATERIALIZED (SELECT word, n, i, word[:i - 1] || word[i + 1:] AS rest
      FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
    pairs AS (SELECT a.word AS a, b.word AS b, b.n FROM cuts a JOIN cuts b ON a.i = b.i AND a.rest = b.rest WHERE a.word <> b.word
      UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
      UNION SELECT a.word, b.word, b.n FROM words a JOIN cuts b ON b.rest = a.word),
    near AS (SELECT a, count(*) AS n_near, min(struct_pack(m := -n, w := b)) AS best FROM pairs GROUP BY a),
    forms AS MATERIALIZED (SELECT word, words.n, coalesce(n_near, 0)::BIGINT AS n_near,
      CASE WHEN -best.m >= 10 * words.n THEN best.w END AS form, CASE WHEN -best.m >= 10 * words.n THEN -best.m END AS form_n
      FROM words LEFT JOIN near ON near.a = words.word),
    walk AS (SELECT word, word AS root, form AS next FROM forms
      UNION ALL SELECT walk.word, walk.next, forms.form FROM walk JOIN forms ON forms.word = walk.next)
    SELECT word, n, n_near, form, form_n, root FROM forms JOIN (SELECT word, root FROM walk WHERE next IS NULL) USING (word)"""


def conversation_trie() -> str:
    return f"""WITH own AS MATERIALIZED (SELECT conv_id AS c, list(struct_pack(role := coalesce(role, ''), text := coalesce(text, ''))
      ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS l
      FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
    hashed AS (SELECT c, l, {_crc32("c::VARCHAR")} % 6 AS h FROM own),
    rebuilt AS MATERIALIZED (SELECT hashed.c, list_concat(coalesce(base.l, [])[:h], hashed.l[h + 1:]) AS l
      FROM hashed LEFT JOIN own AS base ON base.c = hashed.c - hashed.c % 100),
    steps AS MATERIALIZED (SELECT c, len(l) AS len, d, sha256(l[:d]::VARCHAR) || md5(to_json(l[:d])::VARCHAR) AS node,
      sha256(l[:d - 1]::VARCHAR) || md5(to_json(l[:d - 1])::VARCHAR) AS above, coalesce(length(l[d].text), 0) AS size
      FROM (SELECT c, l, unnest(range(0, len(l) + 1)) AS d FROM rebuilt)),
    nodes AS MATERIALIZED (SELECT d, node, CASE WHEN d > 0 THEN any_value(above) END AS above, min(c) AS c, count(*) AS n,
      any_value(size) AS size, sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE d = len), '')) AS ends
      FROM steps GROUP BY d, node),
    kids AS (SELECT above, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY above, d),
    full_ AS MATERIALIZED (SELECT nodes.*, coalesce(kids.n, 0) AS n_children FROM nodes LEFT JOIN kids ON kids.above = nodes.node
      AND kids.d = nodes.d),
    sums AS (SELECT s.d, s.node, sum((u.n_children = 0)::BIGINT) AS leaves, sum((u.n - 1) * (u.d > 0)::BIGINT * u.size) AS saved
      FROM full_ u JOIN steps s ON s.c = u.c AND s.d <= u.d GROUP BY s.d, s.node)
    SELECT f.c AS conv_id, f.d::BIGINT AS depth, p.c AS parent_conv_id, f.n AS n_convs, f.n_children, leaves::BIGINT AS n_leaves,
      saved::BIGINT AS saved_tokens, f.ends AS ends_sha256
    FROM full_ f JOIN sums ON sums.d = f.d AND sums.node = f.node LEFT JOIN nodes p ON p.node = f.above AND p.d = f.d - 1"""
