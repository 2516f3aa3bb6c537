"""SQL for DuckDB that gives the rows of the native operators' queries."""

from taxaloom.llm.imatch import BAND_SHARE, CODES, COMMONEST, RAREST, SHORT, WIDTHS

WORDS = "list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')"

op1_chat = r"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), t AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS pos,
    len(regexp_extract_all(text, '[\p{L}\p{N}]+|[^\s\p{L}\p{N}]')) + 5 AS tokens,
    length(replace(replace(replace(role, '\', '\0'), '<|', '<\1|'), chr(10), '\2'))
      + length(replace(replace(text, '\', '\0'), '<|', '<\1|')) + 24 AS chars
  FROM raw
), s AS (
  SELECT *, pos = 0 AND role = 'system' AS sys FROM t
), b AS (
  SELECT *, coalesce(sum(CASE WHEN NOT sys THEN tokens END) OVER (
    PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM s
), head AS (
  SELECT conv_id, sum(tokens) FILTER (sys) AS sys_tokens, sum(chars) FILTER (sys) AS sys_chars, count(*) AS n,
    min(pos) FILTER (NOT sys) AS first
  FROM b GROUP BY conv_id
), past AS (
  SELECT a.conv_id, a.pos, a.before, a.tokens, a.chars, coalesce(sum(h.tokens), 0) AS past_tokens,
    coalesce(sum(h.chars), 0) AS past_chars
  FROM b a LEFT JOIN b h ON a.conv_id = h.conv_id AND NOT h.sys AND h.before < a.before AND h.before >= a.before - 256
  WHERE NOT a.sys GROUP BY ALL
), starts AS (
  SELECT conv_id, first AS pos FROM head WHERE first IS NOT NULL
  UNION ALL
  SELECT s.conv_id, (
    SELECT min(p.pos) FROM past p WHERE p.conv_id = s.conv_id AND p.pos > s.pos
      AND p.before + p.tokens - a.before > 1024 - coalesce(h.sys_tokens, 0) - a.past_tokens) AS pos
  FROM starts s JOIN past a ON a.conv_id = s.conv_id AND a.pos = s.pos JOIN head h ON h.conv_id = s.conv_id
  WHERE s.pos IS NOT NULL
), sizes AS (
  SELECT h.conv_id, greatest(count(s.pos), 1) * coalesce(any_value(h.sys_chars), 0) + coalesce(sum(p.past_chars), 0) AS extra
  FROM head h LEFT JOIN (SELECT * FROM starts WHERE pos IS NOT NULL) s ON s.conv_id = h.conv_id
  LEFT JOIN past p ON p.conv_id = s.conv_id AND p.pos = s.pos GROUP BY h.conv_id
), own AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos) AS said,
    coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '') AS loss, sum(chars) FILTER (NOT sys) AS chars
  FROM b GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
  CAST(coalesce(chars, 0) + extra AS BIGINT) AS formatted_chars
FROM own JOIN sizes USING (conv_id)
"""

op2_imatch = (
    r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
    coalesce(lead(text) OVER (ORDER BY doc_id, text), first_value(text) OVER (ORDER BY doc_id, text), '') AS next,
    row_number() OVER (ORDER BY doc_id, text) AS r
  FROM documents
), e AS (
  SELECT *, substr(text, 1, length(text) - length(text) // 2) || substr(next, 1, length(text) // 2) AS edited FROM d
), sides AS (
  SELECT r, 0 AS side, text FROM e UNION ALL SELECT r, 1, edited FROM e
), each AS (
  SELECT r, side, unnest(list_distinct(WORDS)) AS term FROM sides
), counts AS (
  SELECT term, count(*) AS n FROM each WHERE side = 0 GROUP BY term
), lexicon AS (
  SELECT term FROM counts
  WHERE n * RAREST >= (SELECT count(*) FROM documents) AND n * COMMONEST <= (SELECT count(*) FROM documents)
), sizes AS (
  SELECT r, side, count(*) AS n, count(l.term) AS known FROM each LEFT JOIN lexicon l USING (term) GROUP BY r, side
), kept AS (
  SELECT r, side, term FROM each JOIN sizes USING (r, side) LEFT JOIN (SELECT term, TRUE AS inside FROM lexicon) USING (term)
  WHERE inside OR n <= SHORT OR known < SHARE * n
), coded AS (
  SELECT term, [('0x' || substr(md5(term), 1, 14))::BIGINT, ('0x' || substr(md5(term), 15, 14))::BIGINT,
    ('0x' || substr(md5(term || ' '), 1, 14))::BIGINT, ('0x' || substr(md5(term || ' '), 15, 14))::BIGINT] AS codes
  FROM (SELECT DISTINCT term FROM kept)
), tests AS (
  SELECT * FROM (VALUES LEXICONS) v(number, code, bits, mask)
), held AS (
  SELECT term, number FROM coded JOIN tests ON ((codes[code] >> bits) & mask) = 0
  UNION ALL SELECT term, LAST FROM coded
), signed AS (
  SELECT r, side, number, md5(string_agg(term, ' ' ORDER BY term)) AS sig FROM kept JOIN held USING (term) GROUP BY r, side, number
), prints AS (
  SELECT s.r, s.side, list(substr(coalesce(g.sig, md5('')), 1, CASE WHEN v.number = LAST THEN 32 ELSE 8 END) ORDER BY v.number) AS sigs
  FROM sides s CROSS JOIN (SELECT unnest(range(LAST + 1)) AS number) v
  LEFT JOIN signed g ON g.r = s.r AND g.side = s.side AND g.number = v.number GROUP BY s.r, s.side
), likes AS (
  SELECT a.r, 1 AS side2, a.sigs AS x, b.sigs AS y FROM prints a JOIN prints b ON b.r = a.r AND b.side = 1 WHERE a.side = 0
  UNION ALL
  SELECT a.r, 0, a.sigs, b.sigs FROM (SELECT *, r % (SELECT count(*) FROM documents) + 1 AS after FROM prints WHERE side = 0) a
  JOIN prints b ON b.r = a.after AND b.side = 0
), near AS (
  SELECT r, side2, x, y,
    len(list_filter(list_zip(x, y), lambda z: NOT starts_with(md5(''), z[1]) OR NOT starts_with(md5(''), z[2]))) AS used,
    len(list_filter(list_zip(x, y), lambda z: z[1] = z[2] AND NOT starts_with(md5(''), z[1]))) AS same
  FROM likes
)
SELECT e.doc_id, length(e.text) AS n_chars, sha256(e.edited) AS edited_sha256,
  array_to_string(p.x, '') AS fingerprint, array_to_string(p.y, '') AS edited_fingerprint,
  CASE WHEN p.used = 0 THEN 1.0::DOUBLE ELSE p.same::DOUBLE / p.used END AS near_edited,
  CASE WHEN q.used = 0 THEN 1.0::DOUBLE ELSE q.same::DOUBLE / q.used END AS near_next
FROM e JOIN near p ON p.r = e.r AND p.side2 = 1 JOIN near q ON q.r = e.r AND q.side2 = 0
"""
).replace("WORDS", WORDS).replace("RAREST", str(RAREST)).replace("COMMONEST", str(COMMONEST)).replace(
    "SHORT", str(SHORT)).replace("SHARE", str(BAND_SHARE)).replace("LAST", str(CODES * len(WIDTHS))).replace(
    "LEXICONS", ", ".join(
        f"({len(WIDTHS) * code + n}, {code + 1}, {sum(WIDTHS[:n])}, {2**width - 1})"
        for code in range(CODES) for n, width in enumerate(WIDTHS)
    ))

#: Of the words of a window of which two (of a shorter item: fewer) may differ, so many next to each other agree.
RUN = "CASE WHEN len(w) >= 13 THEN 4 WHEN len(w) >= 7 THEN len(w) // 2 ELSE len(w) END"

FOUND = rf"""
  dw AS (SELECT DISTINCT doc_id, {WORDS} AS w FROM DOCS),
  iw AS (SELECT *, {RUN} AS n FROM (SELECT DISTINCT item_id, {WORDS} AS w FROM benchmark) WHERE len(w) > 0),
  ds AS (SELECT doc_id, n, p AS at, array_to_string(w[p:p + n - 1], ' ') AS seen
    FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS p FROM dw CROSS JOIN (SELECT DISTINCT n FROM iw))),
  bs AS (SELECT item_id, n, p AS at, array_to_string(w[p:p + n - 1], ' ') AS seen
    FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS p FROM iw)),
  hits AS (SELECT DISTINCT doc_id, item_id, ds.at - bs.at AS shift FROM ds JOIN bs USING (n, seen)),
  agree AS (
    SELECT doc_id, item_id, least(len(iw.w), 13) AS window_words, list_transform(range(len(iw.w)),
      lambda i: CASE WHEN i + shift >= 0 AND dw.w[i + shift + 1] = iw.w[i + 1] THEN 1 ELSE 0 END) AS a
    FROM hits JOIN dw USING (doc_id) JOIN iw USING (item_id)),
  best AS (
    SELECT doc_id, item_id, window_words,
      list_max(list_transform(range(len(a) - window_words + 1), lambda s: list_sum(a[s + 1:s + window_words]))) AS matched_words
    FROM agree),
  found AS (
    SELECT doc_id, item_id, CAST(max(window_words) AS INTEGER) AS window_words, CAST(max(matched_words) AS INTEGER) AS matched_words
    FROM best WHERE matched_words * 13 >= window_words * 11 GROUP BY doc_id, item_id)
"""

op4_decontaminate = "WITH " + FOUND.replace("DOCS", "documents") + "\nSELECT * FROM found"

CLEANED = r"""
  lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line
    FROM (SELECT DISTINCT doc_id, coalesce(text, '') AS text FROM DOCS)),
  trimmed AS (SELECT doc_id, line, trim(raw, ' ' || chr(9) || chr(13) || chr(12) || chr(11)) AS raw FROM lines),
  filled AS (SELECT *, len(regexp_split_to_array(raw, '[ \t]+')) AS words,
    row_number() OVER (PARTITION BY doc_id ORDER BY line) AS k FROM trimmed WHERE raw <> ''),
  placed AS (SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY k) - words AS before FROM filled),
  windows AS (SELECT doc_id, k AS lo, k + count(*) OVER f - 1 AS hi, array_to_string(list(raw) OVER f, chr(10)) AS key, sum(words) OVER f AS words
    FROM placed WINDOW f AS (PARTITION BY doc_id ORDER BY before RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING)
    UNION ALL SELECT doc_id, k - count(*) OVER g + 1, k, array_to_string(list(raw) OVER g, chr(10)), sum(words) OVER g
    FROM placed WINDOW g AS (PARTITION BY doc_id ORDER BY before + words RANGE BETWEEN 49 PRECEDING AND CURRENT ROW)),
  later AS (SELECT * FROM (SELECT DISTINCT doc_id, lo, hi, key FROM windows WHERE words >= 50)
    QUALIFY row_number() OVER (PARTITION BY key ORDER BY doc_id, lo) > 1),
  gone AS (SELECT DISTINCT doc_id, unnest(range(lo, hi + 1)) AS k FROM later),
  dropped AS (SELECT doc_id, line FROM gone JOIN filled USING (doc_id, k)),
  kept AS (SELECT doc_id, string_agg(raw, chr(10) ORDER BY line) FILTER (x.line IS NULL) AS text, count(x.line) AS n
    FROM lines LEFT JOIN (SELECT doc_id, line, TRUE AS hit FROM dropped) x USING (doc_id, line) GROUP BY doc_id)
""".replace("FILTER (x.line IS NULL)", "FILTER (hit IS NULL)").replace("count(x.line)", "count(hit)")

op9_line_dedup = "WITH " + CLEANED.replace("DOCS", "documents") + r"""
SELECT d.doc_id, CASE WHEN k.n = 0 THEN d.text ELSE coalesce(k.text, '') END AS text, CAST(k.n AS INTEGER) AS lines_deleted
FROM documents d JOIN kept k USING (doc_id)
"""

op11_fill_middle = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
    sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents
), e AS (
  SELECT *, len(units) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
    ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
  FROM d
), f AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM e
), g AS (
  SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
    array_to_string(units[b + 1:n], '') AS suffix
  FROM f
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM g
"""

op12_hard_negatives = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, v.vec_id, v.label, list_dot_product(a.q, v.q)::BIGINT AS score
  FROM v a CROSS JOIN v WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE label = anchor_label AND vec_id <> anchor_id
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), n AS (
  SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank,
    vec_id AS negative_id, positive_score, score AS negative_score
  FROM p JOIN s USING (anchor_id)
  WHERE label <> anchor_label AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""
