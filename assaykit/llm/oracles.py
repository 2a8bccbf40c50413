"""SQL for the operators whose definition SQL can express, by plain means and without hashes."""

from __future__ import annotations

from assaykit.llm import decontamination, quality, secret_scan


def _quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def quality_rules() -> str:
    failed = []
    for t in quality.THRESHOLDS:
        bad = [f"{t.metric} < {t.low}"] if t.low is not None else []
        bad += [f"{t.metric} > {t.high}"] if t.high is not None else []
        failed.append(f"CASE WHEN {' OR '.join(bad)} THEN '{t.metric}' END")
    stop = _quoted(sorted({f for w in quality.STOP_WORDS for f in (w, w.capitalize())}))
    return rf"""
WITH t AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT rid, doc_id, text,
    list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(text, chr(10)),
                lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM t
), windows AS (
  SELECT rid, i, words[i:i + 2] AS three FROM w, unnest(range(1, len(words) - 1)) AS u(i)
), repeated AS (
  SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, three) > 1
), covered AS (
  SELECT rid, count(DISTINCT place) AS n
  FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS place FROM repeated) GROUP BY rid
), counts AS (
  SELECT doc_id,
    CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    coalesce(n, 0) AS n_repeat_words,
    len(lines) AS n_lines,
    length(text) - length(regexp_replace(text, '[!?]', '', 'g')) AS n_shouts,
    len(list_filter(words, lambda x: x IN ({stop}))) AS n_stop
  FROM w LEFT JOIN covered USING (rid)
), ratios AS (
  SELECT *,
    CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END AS mean_word_chars,
    CASE WHEN word_chars > 0 THEN n_symbols / word_chars ELSE 0 END AS symbol_ratio,
    CASE WHEN word_chars > 0 THEN n_shouts / word_chars ELSE 0 END AS shout_ratio,
    CASE WHEN n_words > 0 THEN n_stop / n_words ELSE 0 END AS stop_ratio,
    CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END AS dup_line_ratio,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
  FROM counts
), judged AS (
  SELECT *, concat_ws(',', {", ".join(failed)}) AS failed_rules FROM ratios
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND failed_rules = '' AS kept, failed_rules
FROM judged"""


def decontaminated(window: int = 8, least_words: int = 5, least_windows: int = 3) -> str:
    units = _quoted(decontamination.UNITS)

    def tokens(table: str, key: str) -> str:
        text = "replace(text, chr(1), ' ')"
        for pattern, by in (
            (r"([0-9])[.,]([0-9])", r"\1\2"),
            (r"([0-9])(\p{L})", r"\1 \2"),
            (r"([\p{L}\p{N},;] )(\p{Lu}\p{Ll})", "\\1\x01\\2"),
            (r"([\p{L}\p{N},;] )(\p{Lu}\p{Ll})", "\\1\x01\\2"),
        ):
            text = f"regexp_replace({text}, '{pattern}', '{by}', 'g')"
        separators = (
            r"[\x00\x02-\x2F\x3A-\x60\x7B-\x{BF}\x{2000}-\x{206F}\x{3000}-\x{303F}]+"
        )
        text = f"regexp_replace(lower({text}), '{separators}', ' ', 'g')"
        return f"""
  SELECT {key} AS key, list_filter(string_split({text}, ' '), lambda x: x <> '') AS raw
  FROM {table} WHERE {key} IS NOT NULL AND text IS NOT NULL"""

    def windows(source: str) -> str:
        kind = f"""CASE WHEN starts_with(x, chr(1)) THEN '<name>'
      WHEN x >= '0' AND x < ':' THEN '<number>'
      WHEN x IN ({units}) THEN '<unit>' ELSE x END"""
        return f"""
  SELECT key, i AS pos, canon[i:i + {window - 1}] AS template, raw[i:i + {window - 1}] AS vals
  FROM (SELECT key, raw, list_transform(raw, lambda x: {kind}) AS canon FROM {source}) AS c,
    unnest(range(1, len(raw) - {window - 2})) AS u(i)"""

    return f"""
WITH doc_tokens AS ({tokens("documents", "doc_id")}
), item_tokens AS (
  SELECT min(key) AS key, raw FROM ({tokens("benchmark", "item_id")}) AS b GROUP BY raw
), item_windows AS (
  SELECT * FROM ({windows("item_tokens")}) AS b
  WHERE len(list_filter(template, lambda x: x NOT IN ('<name>', '<number>', '<unit>'))) >= {least_words}
), doc_windows AS ({windows("doc_tokens")}
), matched AS (
  SELECT DISTINCT d.key AS doc_id, b.key AS item_id, d.pos - b.pos AS shift, b.pos AS item_pos,
    b.template AS template, b.vals AS item_vals, d.vals AS doc_vals
  FROM doc_windows AS d JOIN item_windows AS b ON d.template = b.template
), slots AS (
  SELECT DISTINCT doc_id, item_id, shift, template[k] AS kind, item_vals[k] AS item_value,
    doc_vals[k] AS doc_value
  FROM matched, unnest(range(1, {window + 1})) AS u(k)
  WHERE template[k] IN ('<name>', '<number>', '<unit>')
), slot_counts AS (
  SELECT doc_id, item_id, shift, count(*) AS n_slots,
    count(DISTINCT struct_pack(k := kind, v := item_value)) AS n_roles,
    count(*) FILTER (item_value <> doc_value) AS n_changed
  FROM slots GROUP BY ALL
), runs AS (
  SELECT doc_id, item_id, shift, count(DISTINCT item_pos) AS n_windows FROM matched GROUP BY ALL
), best AS (
  SELECT r.doc_id, r.item_id, r.n_windows, coalesce(n_slots, 0) AS n_slots,
    coalesce(n_changed, 0) AS n_changed
  FROM runs AS r LEFT JOIN slot_counts AS s
    ON r.doc_id = s.doc_id AND r.item_id = s.item_id AND r.shift = s.shift
  WHERE coalesce(n_slots = n_roles, TRUE) AND n_windows >= {least_windows}
  QUALIFY row_number() OVER (
    PARTITION BY r.doc_id, r.item_id
    ORDER BY n_windows DESC, coalesce(n_changed, 0), coalesce(n_slots, 0) DESC) = 1
)
SELECT doc_id, item_id, n_windows, n_slots, n_changed, n_changed = 0 AS exact FROM best"""


def near_duplicates(words: int = 4, percent: int = 80) -> str:
    return rf"""
WITH RECURSIVE t AS (
  SELECT doc_id, list_filter(string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < {words} THEN [words]
    ELSE list_distinct(list_transform(range(1, len(words) - {words - 2}),
      lambda i: words[i:i + {words - 1}])) END AS shingles
  FROM t
), each AS (
  SELECT doc_id, hash(unnest(shingles)) AS shingle FROM sets
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM each AS a JOIN each AS b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sets AS x ON x.doc_id = a JOIN sets AS y ON y.doc_id = b
  WHERE 100 * n >= {percent} * (len(x.shingles) + len(y.shingles) - n)
), reach AS (
  SELECT doc_id, doc_id AS other FROM sets
  UNION
  SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other
), smallest AS (
  SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, component_id,
  doc_id = component_id AS kept
FROM sets JOIN smallest USING (doc_id)"""


def url_filters(lists) -> str:
    rules = ", ".join(
        f"('{k}', split_part('{k}', '/', 1), substr('{k}', strpos('{k}', '/')), '{v}', {n})"
        for n, (v, keys) in enumerate(
            (("allow", lists.allow), ("block", lists.block), ("block", lists.more))
        )
        for k in keys
    )
    return rf"""
WITH rules(rule, rule_host, rule_path, verdict, list) AS (VALUES {rules}), parts AS (
  SELECT row_number() OVER () AS rid, page_id,
    CASE WHEN strpos(coalesce(url, ''), '://') > 0
      THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), places AS (
  SELECT rid, page_id,
    translate(regexp_extract(rest, '^[^/?#]*'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts
), fits AS (
  SELECT rid, rule, verdict, list,
    row_number() OVER (PARTITION BY rid
      ORDER BY list = 2, length(rule) DESC, length(rule_host) DESC) AS place
  FROM places JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT page_id, host, path, CASE WHEN list < 2 THEN rule END AS rule,
  coalesce(verdict, 'allow') AS verdict
FROM places LEFT JOIN (SELECT * FROM fits WHERE place = 1) AS best USING (rid)"""


def secrets(rules=secret_scan.RULES) -> str:
    kinds, unions = [], []
    for order, r in enumerate(rules):
        pattern = r.pattern.replace("'", "''")
        kinds.append(f"""p{order} AS (
  SELECT rid, {order} AS place, '{r.kind}' AS kind, string_split_regex(text, '{pattern}') AS gaps,
    regexp_extract_all(text, '{pattern}', 0) AS hits,
    regexp_extract_all(text, '{pattern}', {r.group}) AS checked
  FROM t
), s{order} AS (
  SELECT rid, place, kind, length(array_to_string(gaps[1:i], '')
      || array_to_string(hits[1:i - 1], '')) AS start, length(hits[i]) AS width
  FROM p{order}, unnest(range(1, len(hits) + 1)) AS u(i)
  WHERE length(checked[i]) >= {r.least}
)""")
        unions.append(f"SELECT * FROM s{order}")
    base = len(secret_scan.BASE_RULES)
    listed = "string_agg(concat_ws(':', kind, start, start + width), ',' ORDER BY start, place)"
    return f"""
WITH t AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents
), {", ".join(kinds)}, spans AS ({" UNION ALL ".join(unions)})
SELECT any_value(doc_id) AS doc_id,
  count(*) FILTER (kind = 'assign') AS n_assign,
  count(*) FILTER (kind = 'access') AS n_access,
  count(*) FILTER (kind = 'hex') AS n_hex,
  sha256(coalesce({listed} FILTER (place < {base}), '')) AS base_sha256,
  coalesce({listed} FILTER (kind IS NOT NULL), '') AS spans
FROM t LEFT JOIN spans USING (rid) GROUP BY rid"""


def archived(least_bytes: int = 1000) -> str:
    return f"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
    sha1(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (
  SELECT *, CASE WHEN payload_bytes >= {least_bytes}
    THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) END AS first_id FROM p
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM f"""


def source_divergence() -> str:
    """Dense: every kept term for every source and pair of sources."""
    return r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), t AS (
  SELECT rid, lang, source,
    unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM d
), kept AS (
  SELECT lang, term, count(*) AS lang_count FROM t GROUP BY lang, term
  HAVING count(DISTINCT rid) >= 3
), counted AS (
  SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term)
  GROUP BY lang, source, term
), by_lang AS (
  SELECT lang, count(*)::HUGEINT AS v, sum(lang_count)::HUGEINT AS total FROM kept GROUP BY lang
), by_group AS (
  SELECT lang, source, sum(n)::HUGEINT AS total FROM counted GROUP BY lang, source
), groups AS (
  SELECT DISTINCT lang, source FROM d
), p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (coalesce(b.total, 0) + l.v) AS p,
    1 + (1000000000::HUGEINT * (k.lang_count + 1)) // (l.total + l.v) AS lang_p
  FROM groups g JOIN kept k USING (lang) JOIN by_lang l USING (lang)
  LEFT JOIN by_group b USING (lang, source) LEFT JOIN counted c USING (lang, source, term)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item,
    sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL
), every_pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(pairs.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
), rows AS (
  SELECT lang, source, 'pair' AS part, item, value FROM every_pair
  UNION ALL
  SELECT lang, source, 'term', term, (p - lang_p) * (p - lang_p) // lang_p
  FROM p WHERE n > 0 AND p > lang_p
), ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY lang, source, part ORDER BY value DESC, item) AS "rank"
  FROM rows
)
SELECT lang, source, part, item, value::BIGINT AS value, "rank"::INTEGER AS "rank"
FROM ranked WHERE part = 'pair' OR "rank" <= 200
"""


def periodic_runs() -> str:
    """Pairs of equal words at most a quarter of the text apart, joined to stretches per distance.

    The table of the checksum is built in SQL, as DuckDB has no CRC-32.
    """
    return r"""
WITH RECURSIVE bits AS (
  SELECT i AS byte, i::UBIGINT AS c, 0 AS turn FROM range(256) t(i)
  UNION ALL
  SELECT byte, CASE WHEN c & 1 = 1 THEN xor(3988292384::UBIGINT, c >> 1) ELSE c >> 1 END, turn + 1
  FROM bits WHERE turn < 8
), crc AS (
  SELECT list(c ORDER BY byte) AS step FROM bits WHERE turn = 8
), d AS (
  SELECT row_number() OVER () AS rid, doc_id, doc_id::VARCHAR AS name,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents
), sums AS (
  SELECT rid, doc_id, words, xor(4294967295::UBIGINT, list_reduce(
    list_transform(string_split(name, ''), lambda x: ord(x)::UBIGINT),
    lambda c, b: xor(step[(xor(c, b) & 255)::BIGINT + 1], c >> 8), 4294967295::UBIGINT)) AS h
  FROM d, crc
), chosen AS (
  SELECT rid, doc_id, words, len(words) AS n, h % 10 = 0 AS repeats, (h // 10)::BIGINT AS g FROM sums
), cut AS (
  SELECT *, g % n AS a, 1 + (n - g % n) // (3 + g % 8) AS p FROM chosen WHERE n > 0
), made AS (
  SELECT rid, n, CASE WHEN coalesce(repeats, false) THEN list_transform(range(n),
    lambda i: CASE WHEN i < a THEN words[i + 1] ELSE words[a + (i - a) % p + 1] END) ELSE words END AS words
  FROM cut
), w AS (
  SELECT rid, n, unnest(range(n)) AS i, unnest(words) AS word FROM made
), same AS (
  SELECT x.rid, y.i - x.i AS q, x.i AS i
  FROM w x JOIN w y ON x.rid = y.rid AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
), islands AS (
  SELECT rid, q, i, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS island FROM same
), stretches AS (
  SELECT rid, q, min(i) AS start, count(*) + q AS length FROM islands GROUP BY rid, q, island
  HAVING count(*) + q >= greatest(6, 4 * q)
), runs AS (
  SELECT rid, start, length, min(q) AS period FROM stretches GROUP BY rid, start, length
), listed AS (
  SELECT rid, count(*) AS n_runs,
    string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS listing,
    first({'s': start, 'l': length, 'p': period} ORDER BY length DESC, start, period) AS best
  FROM runs GROUP BY rid
), dropped AS (
  SELECT DISTINCT rid, unnest(range(start + period, start + length)) AS i FROM runs
), kept AS (
  SELECT rid, string_agg(word, ' ' ORDER BY i) AS collapsed FROM w ANTI JOIN dropped USING (rid, i)
  GROUP BY rid
)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.l AS length, best.p AS period,
  1000 * best.l // best.p AS exponent_milli, sha256(coalesce(listing, '')) AS runs_sha256,
  sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM d LEFT JOIN listed USING (rid) LEFT JOIN kept USING (rid)
"""
