"""The same results in SQL, for the operators that SQL can express."""

from __future__ import annotations

from reviewtide.llm import quality
from reviewtide.llm.queries import MIX

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def _text(column: str = "text") -> str:
    return f"coalesce({column}, '')"


def _bare(text: str) -> str:
    """Without white space."""
    return f"regexp_replace({text}, '{SPACE}', '', 'g')"


def _count(text: str, characters: str) -> str:
    return f"(length({text}) - length(translate({text}, '{characters}', '')))"


def op2() -> str:
    rules = quality.Rules()
    phrases = "|".join(quality.BOILERPLATE)
    n = f"length(regexp_extract_all(line, '{WORD}'))"
    noisy = r"length(regexp_extract_all(line, '[#*$%&<>]{2,}|[!?]{2,}'))"
    separators = _count("line", quality.SEPARATORS)
    return f"""
    WITH d AS (
      SELECT doc_id, {_text()} AS text,
        regexp_extract_all({_text()}, '{WORD}') AS w, string_split({_text()}, chr(10)) AS lines
      FROM documents),
    windows AS (
      SELECT doc_id, unnest(range(1, length(w) - 3)) AS i, w FROM d WHERE length(w) >= 5),
    grams AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS g FROM windows),
    repeated AS (
      SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS next_i
      FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1),
    covered AS (
      SELECT doc_id, sum(least(5, coalesce(next_i - i, 5))) AS n FROM repeated GROUP BY doc_id),
    split AS (SELECT doc_id, unnest(lines) AS line, unnest(range(length(lines))) AS pos FROM d),
    judged AS (
      SELECT *, {_bare("line")} AS bare,
        ({noisy} >= 2 AND 100 * {noisy} >= {rules.min_noisy} * {n})
        OR ({separators} >= 2 AND 100 * {separators} >= {rules.min_separated} * {n})
        OR ({n} <= {rules.max_boilerplate_words} AND regexp_matches(lower(line), '{phrases}'))
        AS fails
      FROM split),
    by_doc AS (
      SELECT doc_id, count(*) FILTER (WHERE bare <> '')
          - count(DISTINCT line) FILTER (WHERE bare <> '') AS n_dup_lines,
        count(*) FILTER (WHERE fails) AS n_failed_lines,
        coalesce(sum(length(bare)) FILTER (WHERE fails), 0) AS lost_chars
      FROM judged GROUP BY doc_id),
    base AS (
      SELECT d.doc_id, length(w) AS n_words, length({_bare("d.text")}) AS word_chars,
        {_count("d.text", quality.SYMBOLS)} AS n_symbols, n_dup_lines,
        coalesce(c.n, 0) AS n_repeat_words, n_failed_lines, lost_chars
      FROM d JOIN by_doc USING (doc_id) LEFT JOIN covered c USING (doc_id)),
    failed AS (
      SELECT *, n_words < {rules.min_words}
        OR 100 * n_repeat_words > {rules.max_repeated} * n_words AS base_failed FROM base)
    SELECT doc_id, n_words::bigint AS n_words, word_chars::bigint AS word_chars,
      n_symbols::bigint AS n_symbols, n_dup_lines::bigint AS n_dup_lines,
      n_repeat_words::bigint AS n_repeat_words, base_failed,
      n_failed_lines::bigint AS n_failed_lines, lost_chars::bigint AS lost_chars,
      NOT base_failed AND 100 * lost_chars <= {rules.max_lost} * word_chars AS kept
    FROM failed"""


def op4() -> str:
    return f"""
    WITH split AS (
      SELECT doc_id, unnest(string_split({_text()}, chr(10))) AS line,
        unnest(range(length(string_split({_text()}, chr(10))))) AS pos FROM documents),
    keyed AS (
      SELECT *, translate(regexp_replace(line, '^{SPACE}+|{SPACE}+$', '', 'g'),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM split),
    repeated AS (
      SELECT key, max(doc_id) AS holder FROM keyed WHERE length(key) >= 20
      GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
    marked AS (
      SELECT k.*, holder IS NOT NULL AND doc_id <> holder AS dropped
      FROM keyed k LEFT JOIN repeated USING (key))
    SELECT doc_id, count(*)::bigint AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
      sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), ''))
        AS kept_sha256
    FROM marked GROUP BY doc_id"""


def op10() -> str:
    return f"""
    WITH n AS (SELECT doc_id, length({_text()}) AS len, {_bare(_text())} AS normal FROM documents)
    SELECT doc_id,
      first_value(doc_id) OVER (PARTITION BY normal ORDER BY len DESC, doc_id) AS keep_id,
      count(*) OVER (PARTITION BY normal) AS group_size,
      row_number() OVER (PARTITION BY normal ORDER BY len DESC, doc_id) = 1 AS kept,
      sha256(normal) AS text_sha256
    FROM n"""


def _bisection(name: str, start: str, holds: str) -> str:
    """36 steps towards the largest exponent at which ``holds`` (over z, e, most) is true."""
    return f"""
    {name}(i, lo, hi) AS (
      SELECT 0, {start}, 1.0::double
      UNION ALL
      SELECT i + 1, CASE WHEN {holds} THEN (lo + hi) / 2 ELSE lo END,
        CASE WHEN {holds} THEN hi ELSE (lo + hi) / 2 END
      FROM (
        SELECT i, lo, hi, sum(exp((lo + hi) / 2 * l)) AS z,
          sum(exp((lo + hi) / 2 * l) * (lo + hi) / 2 * l) AS e, max(exp((lo + hi) / 2 * l) / p) AS most
        FROM {name}, shares WHERE i < 36 GROUP BY i, lo, hi))"""


def _figure(exponent: str, what: str) -> str:
    return f"(SELECT {what} FROM shares, (SELECT {exponent} AS a) GROUP BY a)"


def op1() -> str:
    """For a mix of a target entropy, a limit of repeats and a budget."""
    z, e, most = "sum(exp(a * l))", "sum(exp(a * l) * a * l)", "max(exp(a * l) / p)"
    enough = f"ln(z) - e / z >= {MIX.entropy} * ln((SELECT count(*) FROM shares))"
    too_often = f"{MIX.budget} * most / z > {MIX.max_repeats}"
    top = _figure("1.0::double", f"ln({z}) - {e} / {z} >= {MIX.entropy} * ln(count(*))")
    over = _figure("(SELECT a FROM wanted)", f"{MIX.budget} * {most} / {z} > {MIX.max_repeats}")
    key = f"md5(concat_ws(':', '{MIX.seed}', passes::varchar, {{}}))"
    block = f"substr(md5(concat_ws(':', '{MIX.seed}', coalesce(doc_id::varchar, 'null'))), 1, 3)"
    return f"""
    WITH RECURSIVE sized AS (
      SELECT doc_id, source, length(regexp_extract_all({_text()}, '{WORD}')) AS n FROM documents),
    sources AS (SELECT source, sum(n) AS tokens FROM sized GROUP BY source),
    total AS (SELECT sum(tokens) AS t FROM sources),
    shares AS (SELECT tokens / t::double AS p, ln(tokens / t::double) AS l
      FROM sources, total WHERE tokens > 0),
    {_bisection("by_entropy", "0.0::double", enough)},
    wanted AS (SELECT CASE WHEN (SELECT count(*) FROM shares) < 2 OR {top} THEN 1.0::double
      ELSE (SELECT lo FROM by_entropy WHERE i = 36) END AS a),
    {_bisection("by_repeats", "(SELECT a FROM wanted)", too_often)},
    chosen AS (SELECT CASE WHEN a < 1 AND {over}
      THEN (SELECT lo FROM by_repeats WHERE i = 36) + (1 - a) / pow(2, 36) ELSE a END AS a FROM wanted),
    norm AS (SELECT sum(exp(a * l)) AS z FROM shares, chosen),
    weights AS (
      SELECT source, tokens, a, CASE WHEN tokens > 0 THEN exp(a * ln(tokens / t::double)) / z ELSE 0 END AS w, t
      FROM sources, total, chosen, norm),
    quotas AS (
      SELECT source, a, w, CASE WHEN tokens > 0 THEN round(w * t * {MIX.budget})::bigint // tokens::bigint ELSE 0 END AS passes,
        CASE WHEN tokens > 0 THEN round(w * t * {MIX.budget})::bigint % tokens::bigint ELSE 0 END AS rest
      FROM weights),
    keyed AS (
      SELECT s.*, a, w, passes, rest,
        {key.format("coalesce(s.source, 'null'), " + block)} AS block_key,
        {key.format("coalesce(doc_id::varchar, 'null')")} AS document_key
      FROM sized s JOIN quotas q ON s.source IS NOT DISTINCT FROM q.source),
    running AS (
      SELECT *, sum(n) OVER (PARTITION BY source ORDER BY block_key, document_key) AS upto FROM keyed)
    SELECT doc_id, source, n::bigint AS n_tokens, round(a, 9) AS exponent, round(w, 9) AS weight,
      (passes + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END)::bigint AS copies
    FROM running"""


def op5() -> str:
    """For 3-word shingles and a similarity of 90 percent."""
    return f"""
    WITH RECURSIVE words AS (
      SELECT doc_id, regexp_extract_all(translate({_text()}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents),
    shingles AS (
      SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s FROM (
        SELECT doc_id, w, unnest(range(1, greatest(length(w) - 1, 2))) AS i FROM words
        WHERE length(w) > 0)),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    shared AS (
      SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
      FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
    links AS (
      SELECT a, b FROM shared s JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
      WHERE 100 * s.n >= 90 * (p.n + q.n - s.n)),
    edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reached(doc_id, other) AS (
      SELECT a, b FROM edges
      UNION
      SELECT r.doc_id, e.b FROM reached r JOIN edges e ON r.other = e.a)
    SELECT d.doc_id, coalesce(max(z.n), 0)::bigint AS n_shingles,
      least(d.doc_id, coalesce(min(r.other), d.doc_id)) AS component_id
    FROM documents d LEFT JOIN sizes z USING (doc_id) LEFT JOIN reached r USING (doc_id)
    GROUP BY d.doc_id"""


def oracles() -> dict[str, str]:
    return {
        "op1_mixing": op1(),
        "op2_quality_rules": op2(),
        "op4_line_dedup": op4(),
        "op5_ngram_jaccard": op5(),
        "op10_exact_dedup": op10(),
    }
