"""SQL for the registered queries of this package, where SQL can express them."""

from __future__ import annotations

from touchtrail.llm.quality_rules import RULES, STOP_WORDS


def _quality() -> str:
    stops = ", ".join(f"'{w}'" for w in [*STOP_WORDS, *(w.capitalize() for w in STOP_WORDS)])
    ratios = {
        "n_words": "n_words",
        "repeat_ratio": "n_repeat_words / n_words",
        "mean_word_chars": "word_chars / n_words",
        "symbol_ratio": "n_symbols / n_words",
        "stop_word_ratio": "n_stop / n_words",
        "dup_line_ratio": "n_dup_lines / nullif(n_lines, 0)",
        "capital_ratio": "n_capitals / nullif(word_chars, 0)",
    }
    rules = []
    for r in RULES:
        value = ratios[r.feature].replace("/ n_words", "/ nullif(n_words, 0)")
        for bound, sign in ((r.at_least, ">="), (r.at_most, "<=")):
            if bound is not None:
                other = ""
                if r.languages:
                    listed = ", ".join(f"'{x}'" for x in r.languages)
                    other = f" OR NOT coalesce(lower(lang) IN ({listed}), false)"
                rules.append(
                    f"(coalesce({value} {sign} {bound}, true) OR n_words < {r.applies_from}{other})"
                )
    return rf"""
    WITH base AS (
      SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS text FROM documents),
    words AS (
      SELECT r, doc_id, lang, text,
             list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws,
             list_filter(string_split(text, chr(10)),
                         lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
      FROM base),
    windows AS (
      SELECT r, i, [ws[i], ws[i + 1], ws[i + 2]] AS w
      FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM words WHERE len(ws) >= 3)),
    twice AS (SELECT r, w FROM windows GROUP BY r, w HAVING count(*) >= 2),
    covered AS (
      SELECT r, count(DISTINCT j) AS n
      FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM windows JOIN twice USING (r, w))
      GROUP BY r),
    counted AS (
      SELECT r, doc_id, lang, len(ws) AS n_words,
             length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
             len(regexp_extract_all(text, '[A-Z]')) AS n_capitals,
             len(list_filter(ws, lambda w: w IN ({stops}))) AS n_stop,
             len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines
      FROM words),
    every AS (
      SELECT c.*, coalesce(v.n, 0) AS n_repeat_words FROM counted c LEFT JOIN covered v USING (r))
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
           n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
           {" AND ".join(rules)} AS kept
    FROM every"""


_TEXTS = """base AS (
      SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents)"""


def _repeated_words(window: int = 35) -> str:
    return rf"""
    WITH {_TEXTS},
    words AS (
      SELECT r, doc_id,
             list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws
      FROM base),
    windows AS (
      SELECT r, i, array_to_string(ws[i : i + {window - 1}], ' ') AS w
      FROM (SELECT r, ws, unnest(range(1, len(ws) - {window - 2})) AS i
            FROM words WHERE len(ws) >= {window})),
    twice AS (SELECT w FROM windows GROUP BY w HAVING count(*) > 1),
    covered AS (
      SELECT DISTINCT r, j
      FROM (SELECT r, unnest(range(i, i + {window})) AS j FROM windows SEMI JOIN twice USING (w))),
    single AS (
      SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS j FROM words WHERE len(ws) > 0),
    kept AS (
      SELECT r, string_agg(w, ' ' ORDER BY j) AS text
      FROM single ANTI JOIN covered USING (r, j) GROUP BY r),
    removed AS (SELECT r, count(*) AS n FROM covered GROUP BY r)
    SELECT doc_id, len(ws) AS n_words, coalesce(n, 0) AS n_removed,
           sha256(coalesce(k.text, '')) AS kept_sha256
    FROM words LEFT JOIN kept k USING (r) LEFT JOIN removed USING (r)"""


def _repeated_bytes(length: int = 50) -> str:
    # Bytes are pairs of hexadecimal digits.
    return rf"""
    WITH {_TEXTS},
    bytes AS (SELECT r, doc_id, hex(text) AS x, strlen(text) AS n FROM base),
    windows AS (
      SELECT r, doc_id, i, substr(x, 2 * i + 1, {2 * length}) AS w
      FROM (SELECT *, unnest(range(0, n - {length - 1})) AS i FROM bytes WHERE n >= {length})),
    earliest AS (SELECT w, min(doc_id) AS first_id FROM windows GROUP BY w HAVING count(*) > 1),
    covered AS (
      SELECT DISTINCT r, j
      FROM (SELECT r, unnest(range(i, i + {length})) AS j
            FROM windows JOIN earliest USING (w) WHERE first_id < doc_id)),
    runs AS (
      SELECT r, j, j - row_number() OVER (PARTITION BY r ORDER BY j) AS run FROM covered),
    removed AS (SELECT r, count(*) AS n_gone, count(DISTINCT run) AS n_runs FROM runs GROUP BY r),
    single AS (
      SELECT r, j, substr(x, 2 * j + 1, 2) AS b
      FROM (SELECT *, unnest(range(0, n)) AS j FROM bytes)),
    kept AS (
      SELECT r, string_agg(b, '' ORDER BY j) AS x
      FROM single ANTI JOIN covered USING (r, j) GROUP BY r)
    SELECT doc_id, n AS n_bytes, coalesce(n_gone, 0) AS n_removed, coalesce(n_runs, 0) AS n_spans,
           sha256(unhex(coalesce(k.x, ''))) AS kept_sha256
    FROM bytes LEFT JOIN removed USING (r) LEFT JOIN kept k USING (r)"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_suffix_lpf": _repeated_bytes(),
        "op8_quality_rules": _quality(),
        "op10_block_anchors": _repeated_words(),
    }
