"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from covtab.llm import lm_scoring, phrase_tries, quality_rules, substring_dedup, vector_codes

SPACE_RUN = r"[\x20\x09-\x0D]+"


def _verdicts() -> str:
    tests = []
    for r in quality_rules.RULES:
        scaled = f"{r.numerator} * 1000"
        bounds = [f"{scaled} < {r.low} * {r.denominator}"] * (r.low is not None)
        bounds += [f"{scaled} > {r.high} * {r.denominator}"] * (r.high is not None)
        spoken = ", ".join(f"'{c}'" for c in r.languages)
        applies = f" AND coalesce(lower(split_part(lang, '-', 1)) IN ({spoken}), false)" if spoken else ""
        tests.append(f"({r.denominator} >= {r.least} AND ({' OR '.join(bounds)}){applies})")
    return " OR ".join(tests)


def _quality() -> str:
    stop = ", ".join(f"'{w}'" for w in sorted(set(quality_rules.STOP_WORDS)))
    spaces = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH texts AS (
    SELECT row_number() OVER () AS row_no, doc_id, lang, coalesce(text, '') AS body FROM documents
), parts AS (
    SELECT row_no, doc_id, lang, body,
           list_filter(string_split_regex(body, '{SPACE_RUN}'), lambda w: w <> '') AS words,
           list_filter(string_split(body, chr(10)), lambda l: length(trim(l, {spaces})) > 0) AS lines,
           translate(body, {spaces}, '') AS bare
    FROM texts
), windows AS (
    SELECT row_no, pos, list_slice(words, pos, pos + 4) AS win
    FROM (SELECT row_no, words, unnest(range(1, len(words) - 3)) AS pos FROM parts)
), starts AS (
    SELECT row_no, pos FROM windows QUALIFY count(*) OVER (PARTITION BY row_no, win) > 1
), gaps AS (
    SELECT row_no, least(5, coalesce(lead(pos) OVER (PARTITION BY row_no ORDER BY pos) - pos, 5)) AS adds FROM starts
), repeats AS (
    SELECT row_no, sum(adds)::BIGINT AS n_repeat_words FROM gaps GROUP BY row_no
), counts AS (
    SELECT doc_id, lang, 1::BIGINT AS one,
           len(words)::BIGINT AS n_words,
           length(bare)::BIGINT AS word_chars,
           (length(bare) - length(translate(bare, '{quality_rules.SYMBOLS}', '')))::BIGINT AS n_symbols,
           len(lines)::BIGINT AS n_lines,
           (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
           coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
           len(list_filter(words, lambda w: lower(w) IN ({stop}))) AS n_stop_words,
           len(list_filter(words, lambda w: upper(w) = w AND lower(w) <> w)) AS n_upper_words,
           len(list_filter(lines, lambda l: l LIKE '%...' OR l LIKE '%…')) AS n_ellipsis_lines,
           len(list_filter(lines, lambda l: regexp_matches(l, '^ *(- |\\* |• )'))) AS n_bullet_lines
    FROM parts LEFT JOIN repeats USING (row_no)
), judged AS (
    SELECT *, n_words < {quality_rules.MIN_WORDS}
              OR n_repeat_words * 100 > n_words * {quality_rules.MAX_REPEAT_PERCENT} AS base_failed
    FROM counts
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT ({_verdicts()}) AS kept
FROM judged
"""


_EXACT_DEDUP = f"""
WITH texts AS (
    SELECT doc_id, length(coalesce(text, '')) AS n_chars,
           sha256(regexp_replace(coalesce(text, ''), '{SPACE_RUN}', '', 'g')) AS text_sha256
    FROM documents
)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER best = 1 AS kept, text_sha256
FROM texts WINDOW best AS (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id)
"""


def _lm_scoring() -> str:
    # c: counts, own: those of the document itself, n: tokens; _t target, _b background
    alpha, mu = lm_scoring.ALPHA, lm_scoring.MU
    return f"""
WITH docs AS (
    SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS body,
           doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL) AS good FROM documents
), lists AS (
    SELECT row_no, doc_id, good,
           list_append(list_filter(string_split_regex(body, '{SPACE_RUN}'), lambda w: w <> ''), ' end') AS words FROM docs
), tokens AS (
    SELECT row_no, good, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM lists
), vocabulary AS (
    SELECT word FROM tokens GROUP BY word HAVING count(*) FILTER (good) >= {lm_scoring.MIN_COUNT} OR word = ' end'
), mapped AS (
    SELECT row_no, good, pos, coalesce(v.word, ' unknown') AS word
    FROM tokens t LEFT JOIN vocabulary v ON t.word = v.word
), pairs AS (
    SELECT *, lag(word, 1, ' start') OVER (PARTITION BY row_no ORDER BY pos) AS prev FROM mapped
), totals AS (
    SELECT count(*)::DOUBLE AS n_b, count(*) FILTER (good)::DOUBLE AS n_t, (SELECT count(*) + 1 FROM vocabulary) AS k FROM mapped
), c1 AS (
    SELECT word, count(*) AS b, count(*) FILTER (good) AS t FROM mapped GROUP BY word
    UNION ALL SELECT ' start', count(*), count(*) FILTER (good) FROM docs
), c2 AS (
    SELECT prev, word, count(*) AS b, count(*) FILTER (good) AS t FROM pairs GROUP BY ALL
), own1 AS (
    SELECT row_no, word, count(*) AS n FROM mapped GROUP BY ALL UNION ALL SELECT row_no, ' start', 1 FROM docs
), own2 AS (
    SELECT row_no, prev, word, count(*) AS n FROM pairs GROUP BY ALL
), size AS (
    SELECT row_no, count(*) AS n FROM mapped GROUP BY row_no
), counts AS (
    SELECT p.row_no, k, n_t / n_b AS scale,
           w.t - p.good::INT * ow.n AS w_t, v.t - p.good::INT * ov.n AS v_t, c2.t - p.good::INT * o2.n AS c_t, n_t - p.good::INT * s.n AS n_t,
           w.b - ow.n AS w_b, v.b - ov.n AS v_b, c2.b - o2.n AS c_b, n_b - s.n AS n_b
    FROM pairs p CROSS JOIN totals JOIN size s USING (row_no)
    JOIN c1 w ON w.word = p.word JOIN c1 v ON v.word = p.prev JOIN c2 ON c2.prev = p.prev AND c2.word = p.word
    JOIN own1 ow ON ow.row_no = p.row_no AND ow.word = p.word JOIN own1 ov ON ov.row_no = p.row_no AND ov.word = p.prev
    JOIN own2 o2 ON o2.row_no = p.row_no AND o2.prev = p.prev AND o2.word = p.word
), losses AS (
    SELECT row_no, count(*) AS n_tokens,
           avg(-ln((c_t + {mu} * ((w_t + {alpha}) / (n_t + {alpha} * k))) / (v_t + {mu}))) AS target_loss,
           avg(-ln((scale * c_b + {mu} * ((scale * w_b + {alpha}) / (scale * n_b + {alpha} * k))) / (scale * v_b + {mu}))) AS background_loss
    FROM counts GROUP BY row_no
)
SELECT doc_id, n_tokens, round(target_loss * 1e6)::BIGINT AS target_loss, round(background_loss * 1e6)::BIGINT AS background_loss,
       round((target_loss - background_loss) * 1e6)::BIGINT AS difference
FROM losses JOIN docs USING (row_no)
"""


# The given messages have no quote marks of their own, so what a mail quotes at
# level n is the text of n turns before it.
_QUOTATIONS = f"""
WITH RECURSIVE lines AS (
    SELECT DISTINCT conv_id, turn, line, count(*) OVER (PARTITION BY conv_id, turn, line) AS n
    FROM (SELECT conv_id, turn, lower(trim(regexp_replace(unnest(string_split(coalesce(text, ''), chr(10))), '{SPACE_RUN}', ' ', 'g'))) AS line
          FROM conversations)
    WHERE line <> ''
), originals AS (
    SELECT conv_id, line, min(turn) AS origin FROM lines GROUP BY ALL
), quoted AS (
    SELECT l.conv_id, l.turn + level AS turn, level, l.n, o.origin
    FROM lines l JOIN originals o USING (conv_id, line), (VALUES (1), (2)) levels (level)
), parents AS (
    SELECT conv_id, turn, arg_max(origin, [-level, votes, origin]) AS parent, sum(votes)::BIGINT AS n
    FROM (SELECT conv_id, turn, level, origin, sum(n)::BIGINT AS votes FROM quoted GROUP BY ALL) GROUP BY ALL
), messages AS (
    SELECT m.conv_id, m.turn, m.role, m.text, p.parent, coalesce(p.n, 0) AS n
    FROM conversations m LEFT JOIN parents p ON p.conv_id = m.conv_id AND p.turn = m.turn
), paths AS (
    SELECT DISTINCT conv_id, turn, [turn] AS path FROM messages WHERE parent IS NULL
    UNION ALL
    SELECT DISTINCT m.conv_id, m.turn, list_append(p.path, m.turn) FROM messages m JOIN paths p ON p.conv_id = m.conv_id AND p.turn = m.parent
), places AS (
    SELECT conv_id, turn, array_to_string(path, '/') AS path_text, path[1] AS root_turn, -row_number() OVER (PARTITION BY conv_id, path[1] ORDER BY path DESC) AS position FROM paths
), plain AS (
    SELECT *, regexp_replace(coalesce(text, ''), '^([ \t]*\n)+|(\n[ \t]*)+$', '', 'g') AS own FROM messages
)
SELECT conv_id, turn, role, parent::VARCHAR AS parent_turn, path_text AS path, root_turn, position, n AS n_quoted, n AS n_linked, sha256(own) AS text_sha256,
       sha256('<|' || coalesce(role, 'user') || '|>' || chr(10) || own || chr(10) || '<|end|>' || chr(10)) AS chat_sha256
FROM plain JOIN places USING (conv_id, turn)
"""


_SUBSTRINGS = f"""
WITH texts AS (
    SELECT row_number() OVER () AS row_no, doc_id,
           list_filter(string_split_regex(coalesce(text, ''), '{SPACE_RUN}'), lambda w: w <> '') AS words FROM documents
), places AS (
    SELECT row_no, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM texts
), windows AS (
    SELECT row_no, pos, string_agg(word, ' ') OVER ahead AS words, count(*) OVER ahead AS n
    FROM places WINDOW ahead AS (PARTITION BY row_no ORDER BY pos ROWS BETWEEN CURRENT ROW AND {substring_dedup.WINDOW - 1} FOLLOWING)
), repeats AS (
    SELECT row_no, pos FROM windows WHERE n = {substring_dedup.WINDOW} QUALIFY count(*) OVER (PARTITION BY words) > 1
), covered AS (
    SELECT DISTINCT row_no, unnest(range(pos, pos + {substring_dedup.WINDOW})) AS pos FROM repeats
), kept AS (
    SELECT row_no, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS body
    FROM places ANTI JOIN covered USING (row_no, pos) GROUP BY row_no
)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (row_no)
"""


def _vector_codes() -> str:
    parts, entries, rounds = vector_codes.PARTS, vector_codes.ENTRIES, vector_codes.ROUNDS
    far = "list_sum(list_transform(list_zip(s.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    stages = []
    for n in range(rounds + 1):
        stages.append(f"""near{n} AS MATERIALIZED (
    SELECT r, p, min({far} * {entries} + e) AS best FROM split s JOIN book{n} b USING (p) GROUP BY r, p
)""")
        if n < rounds:
            stages.append(f"""book{n + 1} AS MATERIALIZED (
    SELECT p, e, coalesce(m.x, b.x) AS x FROM book{n} b LEFT JOIN (
        SELECT p, e, list((total - ((total % n) + n) % n) // n ORDER BY i) AS x FROM (
            SELECT p, best % {entries} AS e, i, sum(x[i])::BIGINT AS total, count(*) AS n
            FROM near{n} JOIN split USING (r, p), range(1, len(x) + 1) t(i) GROUP BY ALL
        ) GROUP BY p, e
    ) m USING (p, e)
)""")
    return f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label, list_transform(embedding, lambda x: floor({vector_codes.SCALE} * x::DOUBLE)::BIGINT) AS v
    FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: coalesce(NOT isfinite(x), true))) = 0
), split AS MATERIALIZED (
    SELECT r, p, v[p * len(v) // {parts} + 1 : (p + 1) * len(v) // {parts}] AS x FROM kept, range({parts}) t(p)
), book0 AS MATERIALIZED (
    SELECT p, r - 1 AS e, x FROM split WHERE r <= {entries}
), {", ".join(stages)}, codes AS (
    SELECT r, string_agg(format('{{:02x}}', best % {entries}), '' ORDER BY p) AS code, sum(best // {entries})::BIGINT AS error
    FROM near{rounds} GROUP BY r
), books AS (
    SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds}
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM codes JOIN kept USING (r), books
"""


def _collocations() -> str:
    least, top, percent = phrase_tries.LEAST, phrase_tries.TOP, phrase_tries.REPLACED_PERCENT
    return f"""
WITH pieces AS (
    SELECT lang, row_number() OVER () AS piece, list_filter(string_split_regex(body, '[ \t]+'), lambda w: w <> '') AS words
    FROM (SELECT coalesce(lang, 'und') AS lang,
                 unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[.,;:!?\x0A-\x0D]')) AS body FROM documents)
), places AS (
    SELECT lang, piece, unnest(words) AS w1, generate_subscripts(words, 1) AS pos FROM pieces
), ahead AS (
    SELECT lang, w1, lead(w1) OVER follows AS w2, lead(w1, 2) OVER follows AS w3 FROM places WINDOW follows AS (PARTITION BY piece ORDER BY pos)
), sizes AS (
    SELECT lang, count(*) AS n FROM places GROUP BY lang
), one AS (
    SELECT lang, w1, count(*) AS f FROM ahead GROUP BY ALL
), two AS (
    SELECT lang, w1, w2, count(*) AS f FROM ahead WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= {least}
), three AS (
    SELECT lang, w1, w2, w3, count(*) AS f FROM ahead WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= {least}
), longer AS (
    SELECT lang, w1, w2, max(f) AS f FROM (SELECT lang, w1, w2, f FROM three UNION ALL SELECT lang, w2, w3, f FROM three) GROUP BY ALL
), cuts AS (
    SELECT t.lang, t.w1 || ' ' || t.w2 AS phrase, 1 AS k, t.f AS a, l.f AS l, r.f AS r
    FROM two t JOIN one l ON l.lang = t.lang AND l.w1 = t.w1 JOIN one r ON r.lang = t.lang AND r.w1 = t.w2
    LEFT JOIN longer o ON o.lang = t.lang AND o.w1 = t.w1 AND o.w2 = t.w2
    WHERE o.f IS NULL OR 100 * o.f < {percent} * t.f
    UNION ALL
    SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, 1, t.f, l.f, r.f
    FROM three t JOIN one l ON l.lang = t.lang AND l.w1 = t.w1 JOIN two r ON r.lang = t.lang AND r.w1 = t.w2 AND r.w2 = t.w3
    UNION ALL
    SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, 2, t.f, l.f, r.f
    FROM three t JOIN two l ON l.lang = t.lang AND l.w1 = t.w1 AND l.w2 = t.w2 JOIN one r ON r.lang = t.lang AND r.w1 = t.w3
), scored AS (
    SELECT *, ((1000000::HUGEINT * a * a) // (l::HUGEINT * r))::BIGINT AS score FROM cuts
), worst AS (
    FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM worst
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= {top}
"""


ORACLE = {
    "op1_lm_scoring": _lm_scoring(),
    "op2_substring_dedup": _SUBSTRINGS,
    "op4_exact_dedup": _EXACT_DEDUP,
    "op6_quotation_linking": _QUOTATIONS,
    "op9_quality_rules": _quality(),
    "op11_phrase_tries": _collocations(),
    "op13_vector_codes": _vector_codes(),
}
