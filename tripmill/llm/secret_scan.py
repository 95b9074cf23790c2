"""Operator 8, secret scans: fixed patterns, and a battery of randomness tests.

Patterns find assignments, access keys and hex runs. Beyond them every run of at
least 20 characters of an encoding's alphabet is tested: its alphabet is inferred
from the kinds of characters in it, and four statistics compare it with a string
drawn evenly from that alphabet: chi-squared over the characters, the share of one
kind of character, the number of runs above and below the middle of the alphabet,
and the serial correlation. Together they give one p-value. Over all distinct runs
of a length class the Benjamini-Hochberg rule decides which p-values are too small
for random strings, with at most ``FDR`` of those decisions expected to be wrong;
what is left and mixes kinds of characters is a secret of kind ``random``. A run has
``=`` at its end only, so a name before it is a run of its own, and spans of patterns are
cut out of it. Names and paths around a secret make a run look like words; so besides the
whole also the run without words at its ends, its parts between slashes, and those between
slashes, hyphens and underscores are tested. Of those that pass and lie in one another the
outermost counts. P-values are counted in bins first, so the rule needs a table of bounded size only.

Null or empty texts have no spans. Offsets are code points, the end is exclusive.
Repeated rows are scanned alike, each for itself; extra columns are ignored.
Everything is built of SQL functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm.common import stored

#: Kinds in the order in which spans of equal start are listed.
ASSIGN = (
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
#: Runs of these two are as long as possible, so the least length may stand in the pattern.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
RUN = r"[A-Za-z0-9+/_-]{20,}=*"
#: What every text with a match of ASSIGN has in lower case.
KEYWORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
MIN_VALUE = 6
MIN_RUN = 20
#: What parts of names and paths look like.
WORD = r"^([A-Z]?[a-z]*|[A-Z]+|[0-9]{1,3})$"

FDR = 0.01
#: Length classes begin at these lengths.
CLASSES = (20, 24, 32, 40, 64, 128, 512)
BINS_PER_HALVING = 8
MAX_BIN = 4096

SPAN = "struct<start:bigint,rank:int,end:bigint,kind:string>"
RUN_TYPE = "struct<start:bigint,end:bigint,level:int,hash:bigint,p:double,class:int>"


def sql(pattern: str) -> str:
    """A pattern as an SQL string."""
    return "r'" + pattern.replace("'", r"\x27") + "'"


def matches(pattern: str) -> str:
    """SQL for all matches of a pattern in ``text``: array of (start, end, found).

    The text between the matches and the matches in turn make up the text, so
    their lengths give the offsets.
    """
    p = sql(pattern)
    return f"""aggregate(
        transform(arrays_zip(regexp_extract_all(text, {p}, 0), split(text, {p}, -1)),
            z -> named_struct('found', z.`0`, 'gap', z.`1`)),
        named_struct('at', 0L, 'out', CAST(array() AS
            ARRAY<STRUCT<start: BIGINT, end: BIGINT, found: STRING>>)),
        (acc, x) -> IF(x.found IS NULL, acc, named_struct(
            'at', acc.at + char_length(x.gap) + char_length(x.found),
            'out', array_append(acc.out, named_struct(
                'start', acc.at + char_length(x.gap),
                'end', acc.at + char_length(x.gap) + char_length(x.found),
                'found', x.found)))),
        acc -> acc.out)"""


def spans(found: str, kind: str, rank: int, keep: str = "true") -> str:
    """SQL turning matches into spans of a kind."""
    return f"""transform(filter({found}, m -> {keep}), m -> named_struct(
        'start', m.start, 'rank', {rank}, 'end', m.end, 'kind', '{kind}'))"""


#: Kinds of characters: a pattern, the characters in order, and a name.
DIGITS, LOWERS, UPPERS = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def battery(s: str) -> str:
    """SQL giving the p-value of the randomness tests for a string expression.

    0 for strings that no encoding explains: those of one kind of character only.
    """
    body = f"rtrim('=', {s})"
    alphabet = f"""CASE
        WHEN {body} RLIKE '^[0-9a-f]+$' THEN '{DIGITS}abcdef'
        WHEN {body} RLIKE '^[0-9A-F]+$' THEN '{DIGITS}ABCDEF'
        WHEN {body} RLIKE '^[A-Z2-7]+$' THEN '{UPPERS}234567'
        ELSE concat(IF({body} RLIKE '[0-9]', '{DIGITS}', ''), IF({body} RLIKE '[a-z]', '{LOWERS}', ''),
            IF({body} RLIKE '[A-Z]', '{UPPERS}', ''), IF({body} RLIKE '[+/]', '+/', ''),
            IF({body} RLIKE '[_-]', '_-', ''), IF({body} RLIKE '=', '=', '')) END"""
    mixed = f"""CAST({body} RLIKE '[0-9]' AS INT) + CAST({body} RLIKE '[a-z]' AS INT)
        + CAST({body} RLIKE '[A-Z]' AS INT) >= 2"""
    # The share tested: capitals where both cases occur, else digits.
    kind = f"""IF({body} RLIKE '[a-z]' AND {body} RLIKE '[A-Z]', '[^A-Z]', '[^0-9]')"""

    def let(name: str, value: str, then: str) -> str:
        return f"transform(array({value}), {name} -> {then})[0]"

    chi = """aggregate(array_distinct(v.x), 0D, (acc, c) ->
        acc + pow(size(filter(v.x, y -> y = c)), 2)) * v.k / v.n - v.n"""
    z_chi = f"""(cbrt(greatest({chi}, 0D) / (v.k - 1)) - (1 - 2D / (9 * (v.k - 1))))
        / sqrt(2D / (9 * (v.k - 1)))"""
    z_share = """(v.share - v.n * v.q) / sqrt(greatest(v.n * v.q * (1 - v.q), 0.25D))"""
    high = "size(filter(v.x, y -> 2 * y > v.k))"
    runs = """(1 + size(filter(sequence(1, CAST(v.n AS INT) - 1),
        i -> (2 * v.x[i] > v.k) != (2 * v.x[i - 1] > v.k))))"""
    z_runs = let(
        "h",
        f"2D * {high} * (v.n - {high})",
        f"""IF(h = 0, sqrt(v.n), ({runs} - h / v.n - 1)
            / sqrt(greatest(h * (h - v.n) / (v.n * v.n * (v.n - 1)), 0.01D)))""",
    )
    mean = "aggregate(v.x, 0D, (acc, y) -> acc + y) / v.n"
    z_serial = let(
        "m",
        mean,
        let(
            "d",
            "aggregate(v.x, 0D, (acc, y) -> acc + (y - m) * (y - m))",
            """IF(d = 0, sqrt(v.n), aggregate(sequence(1, CAST(v.n AS INT) - 1), 0D,
                (acc, i) -> acc + (v.x[i] - m) * (v.x[i - 1] - m)) / d * sqrt(v.n))""",
        ),
    )
    facts = f"""named_struct('x', transform(split({body}, ''), c -> instr(a, c)),
        'n', CAST(char_length({body}) AS DOUBLE), 'k', CAST(char_length(a) AS DOUBLE),
        'share', CAST(char_length(regexp_replace({body}, {kind}, '')) AS DOUBLE),
        'q', CAST(char_length(regexp_replace(a, {kind}, '')) AS DOUBLE) / char_length(a))"""
    # The sum of four squares has a chi-squared distribution with 4 degrees of freedom.
    total = f"""pow({z_chi}, 2) + pow({z_share}, 2) + pow({z_runs}, 2) + pow({z_serial}, 2)"""
    p = let("a", alphabet, let("v", facts, let("t", total, "greatest(exp(-t / 2) * (1 + t / 2), 1e-300)")))
    return f"IF({mixed} AND char_length({body}) >= 16, {p}, 0D)"


def length_class(length: str) -> str:
    cases = " ".join(f"WHEN {length} >= {low} THEN {i}" for i, low in reversed([*enumerate(CLASSES)]))
    return f"CASE {cases} ELSE 0 END"


def found_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: its spans of the fixed patterns, and its runs with their p-values."""
    texts = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    return with_spans(texts, "doc_id")


def with_spans(texts: DataFrame, *kept: str) -> DataFrame:
    """The ``kept`` columns, and the spans found in the column ``text``, which has no nulls."""
    low = F.lower("text")
    keyed = F.lit(False)
    for word in KEYWORDS:
        keyed = keyed | F.contains(low, F.lit(word))
    flagged = texts.select(
        *kept, F.col("text"), keyed.alias("keyed"), F.expr(f"text RLIKE {sql(RUN)}").alias("long")
    )
    none = f"CAST(array() AS ARRAY<{SPAN}>)"
    value = f"char_length(regexp_extract(m.found, {sql(ASSIGN)}, 2)) >= {MIN_VALUE}"
    base = flagged.selectExpr(
        *kept,
        f"IF(keyed, {spans(matches(ASSIGN), 'assign', 0, value)}, {none}) AS assign",
        f"IF(long, {spans(matches(ACCESS), 'access', 1)}, {none}) AS access",
        f"IF(long, {spans(matches(HEX), 'hex', 2)}, {none}) AS hex",
        f"""IF(long, {matches(RUN)},
            CAST(array() AS ARRAY<STRUCT<start: BIGINT, end: BIGINT, found: STRING>>)) AS runs""",
    )
    listed = base.selectExpr(
        *kept,
        "CAST(size(assign) AS BIGINT) AS n_assign",
        "CAST(size(access) AS BIGINT) AS n_access",
        "CAST(size(hex) AS BIGINT) AS n_hex",
        "array_sort(concat(assign, access, hex)) AS base",
        "runs",
    )
    tested = listed.withColumn("runs", F.expr(parts(rests("runs"))))
    return tested.selectExpr(
        *kept, "n_assign", "n_access", "n_hex", "base",
        f"""transform(runs, r -> named_struct('start', r.start, 'end', r.end, 'level', r.level,
            'hash', xxhash64(r.found), 'p', {battery("r.found")},
            'class', {length_class("r.end - r.start")})) AS runs""",
    )


def rests(runs: str) -> str:
    """SQL for what the spans in ``base`` leave of the runs, where it is long enough."""
    over = "filter(base, b -> b.start < r.end AND r.start < b.end)"
    gaps = f"""aggregate({over},
        named_struct('at', r.start, 'out', CAST(array() AS ARRAY<STRUCT<start: BIGINT, end: BIGINT>>)),
        (acc, b) -> named_struct('at', greatest(acc.at, b.end), 'out', IF(b.start > acc.at,
            array_append(acc.out, named_struct('start', acc.at, 'end', b.start)), acc.out)),
        acc -> IF(acc.at < r.end, array_append(acc.out, named_struct('start', acc.at, 'end', r.end)), acc.out))"""
    cut = f"""transform({gaps}, g -> named_struct('start', g.start, 'end', g.end, 'found',
        substring(r.found, CAST(g.start - r.start AS INT) + 1, CAST(g.end - g.start AS INT))))"""
    return f"filter(flatten(transform({runs}, r -> {cut})), g -> g.end - g.start >= {MIN_RUN})"


def parts(runs: str) -> str:
    """SQL for all strings to be tested: the runs (level 0), and by level the parts of each."""

    def between(marks: str, level: int) -> str:
        """The parts between the marks, each one character."""
        return f"""aggregate(split(r.found, '{marks}', -1), named_struct('at', r.start, 'out',
            CAST(array() AS ARRAY<STRUCT<start: BIGINT, end: BIGINT, found: STRING, level: INT>>)),
            (acc, x) -> named_struct('at', acc.at + char_length(x) + 1, 'out', IF(char_length(x) >= {MIN_RUN},
                array_append(acc.out, named_struct('start', acc.at, 'end', acc.at + char_length(x), 'found', x,
                    'level', {level})), acc.out)),
            acc -> acc.out)"""

    def length(array: str) -> str:
        """The lengths of parts with the mark that follows or precedes each."""
        return f"aggregate({array}, 0L, (acc, x) -> acc + char_length(x) + 1)"

    pieces = "split(r.found, '[/_-]', -1)"
    # Numbers of the first and the last part that is no word, from 1; 0 if all are words.
    words = f"transform({pieces}, x -> rtrim('=', x) RLIKE {sql(WORD)})"
    trimmed = f"""transform(filter(array(named_struct('x', {pieces}, 'w', {words})), v -> array_contains(v.w, false)),
        v -> named_struct(
            'low', {length("slice(v.x, 1, CAST(array_position(v.w, false) AS INT) - 1)")},
            'high', {length("slice(reverse(v.x), 1, CAST(array_position(reverse(v.w), false) AS INT) - 1)")}))"""
    trimmed = f"""transform({trimmed}, t -> named_struct('start', r.start + t.low, 'end', r.end - t.high, 'found',
        substring(r.found, CAST(t.low AS INT) + 1, CAST(r.end - r.start - t.low - t.high AS INT)), 'level', 1))"""
    whole = "array(named_struct('start', r.start, 'end', r.end, 'found', r.found, 'level', 0))"
    inner = f"""filter(concat({trimmed}, {between("/", 2)}, {between("[/_-]", 3)}),
        x -> x.end - x.start >= {MIN_RUN} AND x.end - x.start < r.end - r.start)"""
    every = f"IF(r.found RLIKE '[/_-]', concat({whole}, {inner}), {whole})"
    # Each string once, at its lowest level.
    each = f"""transform(array({every}), a -> filter(a, (x, i) ->
        NOT exists(slice(a, 1, i), o -> o.start = x.start AND o.end = x.end)))[0]"""
    return f"flatten(transform({runs}, r -> {each}))"


def thresholds(found: DataFrame) -> dict[int, int]:
    """By length class, the first bin of p-values (0 for 1, upwards as p falls) that is rejected.

    At most ``MAX_BIN + 1`` rows of a class are ordered by one task.
    """
    bin_of = f"""CAST(least({MAX_BIN}, floor(-log2(r.p) * {BINS_PER_HALVING}))
        AS INT)"""
    runs = found.selectExpr("explode(runs) AS r").where("r.p > 0")
    distinct = runs.selectExpr("r.class AS class", "r.hash AS hash", f"{bin_of} AS bin").distinct()
    counted = distinct.groupBy("class", "bin").agg(F.count("*").alias("n"))
    smaller = Window.partitionBy("class").orderBy(F.desc("bin")).rowsBetween(
        Window.unboundedPreceding, 0
    )
    whole = Window.partitionBy("class")
    ranked = counted.select(
        "class", "bin", F.sum("n").over(smaller).alias("i"), F.sum("n").over(whole).alias("m")
    )
    edge = F.pow(F.lit(2.0), -F.col("bin") / F.lit(float(BINS_PER_HALVING)))
    rejected = ranked.where(edge <= FDR * F.col("i") / F.col("m"))
    # One row per length class.
    return {r["class"]: r.bin for r in rejected.groupBy("class").agg(F.min("bin").alias("bin")).collect()}


def joined(array: str) -> Column:
    parts = f"transform({array}, s -> concat_ws(':', s.kind, s.start, s.end))"
    return F.expr(f"array_join({parts}, ',')")


def every_span(bins: dict[int, int]) -> str:
    """SQL for the spans of the fixed patterns and of the runs that pass as random."""
    least = {i: 0.0 for i in range(len(CLASSES))}
    for kind, first in bins.items():
        least[kind] = 2.0 ** (-first / BINS_PER_HALVING)
    bound = "CASE r.class " + " ".join(f"WHEN {i} THEN {p!r}D" for i, p in least.items()) + " END"
    passed = f"filter(runs, r -> r.p > 0 AND r.p > {bound})"
    outermost = f"""transform(array({passed}), a -> filter(a, r -> r.level = 0 OR NOT exists(a, o -> o.level < r.level
        AND o.start <= r.start AND r.end <= o.end)))[0]"""
    random = f"""transform({outermost},
        r -> named_struct('start', r.start, 'rank', 3, 'end', r.end, 'kind', 'random'))"""
    return f"array_sort(concat(base, {random}))"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts of the fixed kinds, their digest, and all spans."""
    found = stored(found_spans(docs, id_col, text_col), "secret-spans")
    every = found.selectExpr("*", f"{every_span(thresholds(found))} AS every")
    return every.select(
        "doc_id", "n_assign", "n_access", "n_hex",
        F.sha2(joined("base"), 256).alias("base_sha256"),
        joined("every").alias("spans"),
    )


def redact(
    docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars", mark: str = "[SECRET]"
) -> DataFrame:
    """The documents with ``mark`` in place of every span, and all their columns.

    ``chars_col``, where there is one, gets the length of a text that has changed.
    """
    text = F.coalesce(F.col(text_col), F.lit("")).alias("text")
    found = stored(with_spans(docs.select(text)).select("runs").where("size(runs) > 0"), "secret-runs")
    rows = with_spans(docs.select(text, F.struct(*docs.columns).alias("doc")), "doc", "text")
    rows = rows.selectExpr("doc", "text", f"{every_span(thresholds(found))} AS every")
    cut = f"""aggregate(every, named_struct('at', 0L, 'out', ''), (acc, s) -> IF(s.start < acc.at,
            named_struct('at', greatest(acc.at, s.end), 'out', acc.out),
            named_struct('at', s.end, 'out', concat(acc.out,
                substring(text, CAST(acc.at AS INT) + 1, CAST(s.start - acc.at AS INT)), '{mark}'))),
        acc -> concat(acc.out, substring(text, CAST(acc.at AS INT) + 1)))"""
    rows = rows.selectExpr("doc", f"IF(size(every) = 0, NULL, {cut}) AS changed")
    columns = []
    for field in docs.schema:
        old = F.col("doc").getField(field.name)
        if field.name == text_col:
            old = F.coalesce("changed", old)
        elif field.name == chars_col:
            new = F.char_length("changed").cast(field.dataType)
            old = F.when(F.col("changed").isNotNull(), new).otherwise(old)
        columns.append(old.alias(field.name))
    return rows.select(*columns)
