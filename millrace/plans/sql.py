"""DuckDB counterparts of the text functions, as SQL fragments for the oracles."""

from __future__ import annotations

from millrace.functions import text as T
from millrace.operators import quality

NL = "chr(10)"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{T.SPACE}+|{T.SPACE}+$', '', 'g')"


def words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{T.SPACE}+'), lambda w: w <> '')"


def lines(x: str) -> str:
    return f"list_filter(list_transform(string_split({x}, {NL}), lambda l: {strip('l')}), lambda l: l <> '')"


def normalize(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace(lower({x}), '[^{T.WORD_CHARS}{T.SPACE_CHARS}]', '', 'g'), '{T.SPACE}+', ' ', 'g'))"


def exact_hash(x: str) -> str:
    return f"substr(sha256({normalize(x)}), 1, 16)"


def portable_hash(x: str, seed: str = "") -> str:
    return f"('0x' || substr(md5('{seed}' || {x}), 1, 15))::BIGINT"


def count(x: str, pattern: str) -> str:
    return f"len(regexp_extract_all({x}, '{pattern}'))"


def ngrams(w: str, n: int) -> str:
    return f"CASE WHEN len({w}) >= {n} THEN list_transform(range(1, len({w}) - {n} + 2), lambda i: array_to_string({w}[i:i + {n - 1}], ' ')) ELSE []::VARCHAR[] END"


def html_to_text(x: str) -> str:
    out = f"regexp_replace({x}, '(?i)</(?:p|div|li|ul|ol|h[1-6]|blockquote|tr|table|pre)>', {NL} || {NL}, 'g')"
    out = f"regexp_replace(regexp_replace({out}, '(?i)<br\\s*/?>', {NL}, 'g'), '<[^>]+>', '', 'g')"
    for entity, plain in T.ENTITIES:
        out = f"replace({out}, '{entity}', '{plain if plain != chr(39) else chr(39) * 2}')"
    return strip(f"regexp_replace({out}, '\\n{{3,}}', {NL} || {NL}, 'g')")


FEATURES = f"""
SELECT doc_id, source, t, len(ls) AS n_lines, len(ws) AS n_words, length(t) AS len,
  len(list_filter(ls, lambda l: regexp_matches(l, '^[{quality.BULLETS}]'))) AS n_bullets,
  len(list_filter(ls, lambda l: ends_with(l, '...'))) AS n_ellipses,
  len(ls) - len(list_distinct(ls)) AS n_repeated, length(array_to_string(ws, '')) AS word_chars,
  {count('t', quality.SYMBOLS)} AS n_symbols, {count('t', chr(92) + 'p{L}')} AS n_alpha,
  {count('t', '(?i)' + '|'.join(quality.BOILERPLATE))} AS n_boilerplate,
  len(list_distinct(list_filter(list_transform(ws[1:100], lambda w: lower(w)), lambda w: list_contains({list(quality.STOP_WORDS)!r}, w)))) AS n_stop
FROM (SELECT doc_id, source, t, {lines('t')} AS ls, {words('t')} AS ws FROM (SELECT doc_id, {{source}} AS source, coalesce(text, '') AS t FROM {{docs}}))"""


def _skip(names: tuple[str, ...]) -> str:
    return f"coalesce(source IN ({', '.join(map(repr, names))}), false)"


def verdict(docs: str = "documents", source: str = "source") -> str:
    """doc_id, source, reason."""
    prose = f"NOT {_skip(quality.CODE_SOURCES)}"
    return f"""SELECT *, CASE
  WHEN NOT {_skip(('conala', 'jupyter'))} AND len < 500 THEN 'too_short' WHEN NOT {_skip(('pg19', 'jupyter'))} AND len > 50000 THEN 'too_long'
  WHEN n_lines = 0 THEN 'no_lines' WHEN n_bullets / n_lines > 0.9 THEN 'high_bullet_ratio' WHEN n_ellipses / n_lines > 0.3 THEN 'high_ellipsis_ratio'
  WHEN n_lines >= 4 AND n_repeated / n_lines > 0.2 THEN 'high_repeated_lines' WHEN {prose} AND n_words = 0 THEN 'no_words'
  WHEN {prose} AND word_chars / n_words < 3.0 THEN 'mean_word_too_short' WHEN {prose} AND word_chars / n_words > 10.0 THEN 'mean_word_too_long'
  WHEN {prose} AND n_symbols / n_words > 0.08 THEN 'high_symbol_ratio' WHEN {prose} AND len = 0 THEN 'empty'
  WHEN {prose} AND n_alpha / len < 0.75 THEN 'low_alpha_ratio' WHEN {prose} AND n_boilerplate >= 2 THEN 'boilerplate'
  WHEN {prose} AND n_stop < 3 THEN 'insufficient_stop_words' END AS reason
FROM ({FEATURES.replace('{docs}', docs).replace('{source}', source)})"""


RANK = "coalesce(try_cast(nullif(regexp_extract(source, '(\\d+)$', 1), '') AS INTEGER), 0)"

EXACT = f"""SELECT doc_id, source, h AS hash, row_number() OVER (PARTITION BY h ORDER BY {RANK}, doc_id) = 1 AS kept
FROM (SELECT doc_id, source, {exact_hash("coalesce(text, '')")} AS h FROM documents)"""


def split_sql(table: str, key: str, seed: str, fraction: float, least: int) -> str:
    return f"""SELECT *, CASE WHEN row_number() OVER (ORDER BY md5('{seed}:' || {key}), {key}) <= greatest({least}, floor(count(*) OVER () * {fraction}::DOUBLE)) THEN 'val' ELSE 'train' END AS split FROM {table}"""
