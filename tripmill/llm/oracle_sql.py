"""DuckDB SQL for the queries of this subpackage that SQL can express."""

import re

from tripmill.llm import license_scan, line_quality

WORD = r"[^\x20\x09-\x0D]+"

#: A character that ends a phrase; doubled, so that neighbouring phrases do not share one.
_EDGE = r"[^0-9a-z_\x{80}-\x{10FFFF}]"
_PHRASES = "|".join(p.replace(" ", "  ") for p in line_quality.BOILERPLATE)
_MARKS = ", ".join(f"'{s}'" for s in line_quality.SEPARATORS)


def _pattern(text: str) -> str:
    """A Python pattern as SQL text for DuckDB."""
    return re.sub(r"\\u([0-9a-f]{4})", r"\\x{\1}", text).replace("'", "''")


_ENDS = _pattern(line_quality.ENDS)
_STOPS = _pattern(line_quality.STOPS.removesuffix("$"))


def line_quality_sql(source: str = "documents") -> str:
    """Operator 3 over ``source``: the report of every document."""
    return rf"""
    WITH texts AS (
      SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM {source}
    ), base AS (
      SELECT *, regexp_extract_all(text, '{WORD}') AS words FROM texts
    ), windows AS (
      SELECT id, i, list_slice(words, i, i + 7) AS w
      FROM (SELECT id, words, unnest(range(1, len(words) - 6)) AS i FROM base)
    ), repeated AS (
      SELECT id, i FROM (SELECT id, i, count(*) OVER (PARTITION BY id, w) AS n FROM windows)
      WHERE n > 1
    ), repeats AS (
      SELECT id, count(DISTINCT i + j) AS n FROM repeated, range(8) AS t(j) GROUP BY id
    ), lines AS (
      SELECT *, row_number() OVER () AS line_id, len(regexp_extract_all(line, '{WORD}')) AS n_line
      FROM (SELECT id, unnest(string_split(text, chr(10))) AS line FROM base)
      WHERE regexp_matches(line, '{WORD}')
    ), cut AS (
      SELECT *, string_split(
        regexp_replace(line, '({_STOPS})([\x20\x09-\x0D]|$)', '\1' || chr(1) || '\2', 'g'), chr(1)) AS parts
      FROM lines
    ), pieces AS (
      SELECT *, CASE
        WHEN n_line <= {line_quality.LONG_LINE} THEN [line]
        WHEN len(parts) > 1 AND len(regexp_extract_all(parts[-1], '{WORD}')) <= {line_quality.MAX_TAIL}
          THEN list_append(parts[:-3], parts[-2] || parts[-1])
        ELSE parts END AS units
      FROM cut
    ), units AS (
      SELECT id, line_id, line, unit, regexp_extract_all(unit, '{WORD}') AS words
      FROM (SELECT id, line_id, line, unnest(units) AS unit FROM pieces)
    ), facts AS (
      SELECT id, line_id, line, unit, len(words) AS n,
        length(regexp_replace(unit, '[\x20\x09-\x0D]', '', 'g')) AS chars,
        length(regexp_replace(unit, '[^#*$%&|<>]', '', 'g')) AS symbols,
        length(regexp_replace(unit, '[^A-Z]', '', 'g')) AS upper,
        length(regexp_replace(unit, '[^a-z]', '', 'g')) AS lower,
        len(list_filter(words, lambda w: w IN ({_MARKS}))) AS marks,
        len(list_filter(list_zip(words[:-2], words[2:]), lambda p: p[1] = p[2])) AS twice,
        len(list_filter(words[-{line_quality.MAX_TAIL + 1}:], lambda w: regexp_matches(w, '{_ENDS}'))) AS ends,
        coalesce(list_sum(list_transform(
          regexp_extract_all(
            regexp_replace(
              translate(unit, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '({_EDGE})', '\1\1', 'g'),
            '(?:^|{_EDGE})({_PHRASES})(?:$|{_EDGE})', 1),
          lambda p: len(string_split(p, '  ')))), 0) AS phrases
      FROM units
    ), judged AS (
      SELECT *, ends = 0 OR 10 * symbols > 3 * n OR (marks >= 3 AND 5 * marks >= n)
        OR (n >= 5 AND upper > lower) OR (n >= 10 AND 4 * twice > n)
        OR (phrases > 0 AND 100 * phrases >= {line_quality.PHRASE_PCT} * n) AS bad FROM facts
    ), by_line AS (
      SELECT id, line_id, any_value(line) AS line, bool_and(bad) AS gone,
        coalesce(sum(chars) FILTER (bad), 0) AS lost FROM judged GROUP BY id, line_id
    ), by_doc AS (
      SELECT id, count(*) - count(DISTINCT line) AS n_dup_lines, count(*) FILTER (gone) AS removed,
        sum(lost) AS lost FROM by_line GROUP BY id
    ), figures AS (
      SELECT id, doc_id, text, len(words) AS n_words,
        length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
        coalesce(removed, 0) AS n_lines_removed, CAST(coalesce(lost, 0) AS BIGINT) AS lost_chars
      FROM base LEFT JOIN by_doc USING (id) LEFT JOIN repeats r USING (id)
    ), verdicts AS (
      SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM figures
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
      NOT base_failed AND 100 * lost_chars <= 50 * word_chars AS kept, n_lines_removed, lost_chars
    FROM verdicts"""


LOWERED = (
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)


def shingles_sql(source: str, key: str, text: str = "lower(coalesce(text, ''))") -> str:
    """All five-word shingles of a table's texts: the key, the position from 0, the words."""
    return f"""
      SELECT {key}, i - 1 AS position, list_slice(words, i, i + 4) AS shingle
      FROM (SELECT {key}, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i
            FROM (SELECT {key}, regexp_extract_all({text}, '{WORD}') AS words FROM {source})
            WHERE len(words) > 0)"""


def decontaminate_sql(documents: str = "documents") -> str:
    """Operator 2: items of which a document has 75 percent of the shingles."""
    return f"""
    WITH items AS (SELECT DISTINCT item_id, shingle FROM ({shingles_sql("benchmark", "item_id")})),
    sizes AS (SELECT item_id, count(*) AS n FROM items GROUP BY item_id),
    found AS (SELECT DISTINCT doc_id, shingle FROM ({shingles_sql(documents, "doc_id")})),
    shared AS (
      SELECT doc_id, item_id, count(*) AS n_shared FROM found JOIN items USING (shingle)
      GROUP BY doc_id, item_id)
    SELECT doc_id, item_id, n AS n_item_shingles, n_shared
    FROM shared JOIN sizes USING (item_id) WHERE 100 * n_shared >= 75 * n"""


def license_sql() -> str:
    """Operator 6: notices of which a window of the document has 75 percent of the shingles."""
    values = ", ".join(
        "('{}', {}, '{}')".format(name, i, text.replace("'", "''"))
        for name, texts in license_scan.NOTICES.items()
        for i, text in enumerate(texts)
    )
    return f"""
    WITH templates AS (
      SELECT struct_pack(license := license, notice := CAST(notice AS BIGINT)) AS id, text
      FROM (VALUES {values}) AS t(license, notice, text)),
    parts AS (SELECT DISTINCT id, shingle FROM ({shingles_sql("templates", "id")})),
    sizes AS (
      SELECT id, count(*) AS n, CAST(floor(log2(count(*))) AS INTEGER) AS class
      FROM parts GROUP BY id),
    wanted AS (SELECT DISTINCT shingle, class FROM parts JOIN sizes USING (id)),
    hits AS (
      SELECT doc_id, position, shingle, class,
        unnest([position // (2 << class) - 1, position // (2 << class)]) AS part
      FROM ({shingles_sql("documents", "doc_id")}) JOIN wanted USING (shingle)),
    firsts AS (SELECT doc_id, class, part, min(position) AS first FROM hits GROUP BY ALL),
    shared AS (
      SELECT doc_id, part, id, class, n, count(DISTINCT shingle) AS n_shared
      FROM hits JOIN sizes USING (class) JOIN parts USING (id, shingle) GROUP BY ALL)
    SELECT doc_id, id.license AS license, id.notice AS notice, max(n) AS n_shingles,
      max(n_shared) AS n_shared, min(first) AS first_word
    FROM shared JOIN firsts USING (doc_id, class, part) WHERE 100 * n_shared >= 75 * n
    GROUP BY doc_id, id"""


def components_sql(source: str = "documents", min_pct: int = 75, more: str = "") -> str:
    """Operators 7, 12: components of documents whose shingle sets have a Jaccard similarity of ``min_pct``."""
    return f"""
    WITH RECURSIVE sets AS (SELECT DISTINCT doc_id, shingle FROM ({shingles_sql(source, "doc_id", LOWERED)})),
    sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
    shared AS (
      SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
      FROM sets a JOIN sets b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
    links AS (
      SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
      WHERE 100 * shared.n >= {min_pct} * (x.n + y.n - shared.n)),
    reached(doc_id, other) AS (
      SELECT a, a FROM links UNION SELECT doc_id, b FROM reached JOIN links ON a = other),
    least AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id{more}
    FROM (SELECT doc_id FROM {source}) LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)"""


WARC_SQL = """
    WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
    facts AS (
      SELECT page_id, strlen(payload) AS n, sha1(payload) AS digest,
        max(page_id) OVER (PARTITION BY payload) AS latest FROM payloads)
    SELECT page_id, n AS payload_bytes, digest AS payload_digest,
      CASE WHEN n >= 1000 AND page_id <> latest THEN 'revisit' ELSE 'response' END AS record_type,
      CASE WHEN n >= 1000 AND page_id <> latest THEN latest END AS refers_to
    FROM facts"""

def collocations_sql(source: str = "documents", least: int = 100, top: int = 2000) -> str:
    """Operator 11: all phrases of up to five words counted, without any pruning."""
    return rf"""
    WITH pieces AS (
      SELECT coalesce(lang, 'und') AS lang,
        unnest(regexp_split_to_array({LOWERED}, '[.,;:!?\x0A-\x0D]')) AS piece FROM {source}),
    texts AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
    totals AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM texts GROUP BY lang),
    starts AS (
      SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM texts, range(1, 6) AS t(k)),
    counts AS (
      SELECT lang, list_slice(words, i, i + k - 1) AS words, count(*) AS f FROM starts
      GROUP BY ALL HAVING count(*) >= {least}),
    candidates AS (SELECT lang, words, f AS a FROM counts WHERE len(words) > 1),
    cuts AS (SELECT lang, words, a, unnest(range(1, len(words))) AS k FROM candidates),
    scored AS (
      SELECT c.lang, c.words, c.k, a, x.f AS l, y.f AS r, n,
        CAST((CAST(1000 AS HUGEINT) * a * n) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
      FROM cuts c JOIN totals USING (lang)
      JOIN counts x ON x.lang = c.lang AND x.words = c.words[1:k]
      JOIN counts y ON y.lang = c.lang AND y.words = c.words[k + 1:]),
    lowest AS (
      SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1),
    spans AS (
      SELECT lang, words, a, unnest(range(1, len(words))) AS i, len(words) AS n FROM candidates),
    inner_parts AS (
      SELECT lang, list_slice(words, i, j) AS words, max(a) AS longer
      FROM (SELECT *, unnest(range(i + 1, n + 1)) AS j FROM spans) WHERE j - i + 1 < n GROUP BY ALL),
    kept AS (
      SELECT *, array_to_string(words, ' ') AS phrase FROM lowest LEFT JOIN inner_parts USING (lang, words)
      WHERE longer IS NULL OR 100 * longer < 100 * a)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
      phrase, a, l, r, n, score
    FROM kept QUALIFY rank <= {top}"""


ORACLES = {
    "op2_decontaminate": decontaminate_sql(),
    "op3_line_quality": line_quality_sql(),
    "op5_warc_shards": WARC_SQL,
    "op6_license_scan": license_sql(),
    "op7_jaccard_join": components_sql(),
    "op11_phrase_mining": collocations_sql(),
    "op12_minmax_dedup": components_sql(min_pct=85, more=", doc_id = coalesce(component_id, doc_id) AS kept"),
}
