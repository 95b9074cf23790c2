"""Operator 3, quality rules: clean line by line, then judge what is left of the document.

Every line of a text is held against rules of its own, a line of more than ``LONG_LINE``
words sentence by sentence. Lines and sentences that break one are removed; a line counts
as removed if nothing of it is left. Boilerplate phrases are whole words and count where they
are a fair share of the words. Thai and Lao have no sentence marks, so their letters pass
as such. A document that loses more than half of its word characters that way
is rejected, and so is one that fails the base rules on its whole text.

Null or empty texts have no words and are rejected by the base rule. Repeated
rows are judged alike, each for itself. Extra columns are ignored by
``line_report`` and kept by ``keep_good``. Memory: one Arrow batch of texts.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tripmill.llm.common import in_batches, in_small_batches, slices, text_bytes

SYMBOLS = b"#*$%&|<>"
WHITE = b" \t\n\x0b\x0c\r"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PCT = 30
#: A document is rejected if lines with more than so many percent of its word characters go.
MAX_LOST_PCT = 50

#: So many words may follow the last sentence of a line.
MAX_TAIL = 8

#: How the last word of a sentence ends: a sentence mark, then closing quotes or brackets.
STOPS = r"""[.!?…。！？．｡।॥؟۔։።፧။།៕᙮᠃꓿]["'”’»)\]“‘›」』）】》]*$"""
#: How the last word of a line with sentences ends: as above, in a colon or semicolon, or in Thai or Lao.
ENDS = rf"""{STOPS}|[:;：；؛]["'”’»)\]“‘›」』）】》]*$|[\u0e01-\u0e5b\u0e81-\u0eff]$"""
#: Lines of more words are judged by sentence.
LONG_LINE = 40
#: Phrases fail a line if they are at least this part of its words.
PHRASE_PCT = 15
#: Words that only separate the items of a menu.
SEPARATORS = ("|", ">", "»", "›", "·", "•")
#: Phrases of notices and menus, in lower case.
BOILERPLATE = (
    "accept all cookies",
    "all rights reserved",
    "click here to",
    "cookie policy",
    "enable javascript",
    "log in to",
    "lorem ipsum",
    "privacy policy",
    "read more",
    "sign up for",
    "skip to content",
    "subscribe to our",
    "terms of service",
    "terms of use",
    "this site uses cookies",
    "use of cookies",
)

_STOPS, _ENDS = re.compile(STOPS), re.compile(ENDS)
_SEPARATORS = {s.encode() for s in SEPARATORS}
_BOILERPLATE = re.compile(
    rb"(?<![0-9a-z_\x80-\xff])(?:" + "|".join(BOILERPLATE).encode() + rb")(?![0-9a-z_\x80-\xff])"
)
_WORD = re.compile(rb"[^ \t\n\x0b\x0c\r]+")
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))

REPORT = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint,"
    " n_repeat_words bigint, base_failed boolean, kept boolean, n_lines_removed bigint,"
    " lost_chars bigint"
)


def code_points(text: bytes) -> int:
    return len(text.decode("utf-8", "replace"))


def word_chars(text: bytes) -> int:
    return code_points(text.translate(None, WHITE))


def n_symbols(text: bytes) -> int:
    return len(text) - len(text.translate(None, SYMBOLS))


def n_dup_lines(lines: list[bytes]) -> int:
    return len(lines) - len(set(lines))


def n_repeat_words(words: list[bytes]) -> int:
    """Words inside an 8-word window that the text has twice or more, exactly.

    Windows are numbered by joining the numbers of their halves, so equal
    numbers mean equal words.
    """
    n = len(words)
    if n <= WINDOW:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    if len(number) == n:
        return 0
    distinct = len(number)
    pairs = ids[:-1] * distinct + ids[1:]
    if distinct > 50_000:
        pairs = np.unique(pairs, return_inverse=True)[1]
        distinct = n
    else:
        distinct *= distinct
    fours = pairs[:-2] * distinct + pairs[2:]
    ordered = np.sort(fours)
    if not (ordered[1:] == ordered[:-1]).any():
        return 0
    fours = np.unique(fours, return_inverse=True)[1]
    eights = fours[:-4] * n + fours[4:]
    _, which, counts = np.unique(eights, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[which] > 1)
    covered = np.zeros(n + 1, dtype=np.int64)
    covered[starts] += 1
    covered[starts + WINDOW] -= 1
    return int((np.cumsum(covered) > 0).sum())


def line_fails(line: bytes, words: list[bytes]) -> bool:
    """Whether a line with words breaks a rule on punctuation, menus or boilerplate."""
    n = len(words)
    tail = words[-MAX_TAIL - 1 :]
    if not any(_ENDS.search(w.decode("utf-8", "replace")) for w in reversed(tail)):
        return True
    if 10 * n_symbols(line) > 3 * n:
        return True
    separators = sum(w in _SEPARATORS for w in words) if any(s in line for s in _SEPARATORS) else 0
    if separators >= 3 and 5 * separators >= n:
        return True
    upper = len(line) - len(line.translate(None, _UPPER))
    if n >= 5 and upper > len(line) - len(line.translate(None, _LOWER)):
        return True
    if n >= 10 and 4 * sum(a == b for a, b in zip(words, words[1:])) > n:
        return True
    phrases = sum(len(found.split()) for found in _BOILERPLATE.findall(line.lower()))
    return 100 * phrases >= PHRASE_PCT * n and phrases > 0


def sentences(line: bytes) -> list[bytes]:
    """The line in pieces that end after a sentence's last word, white space at their heads; the
    last has the few words that may follow."""
    out, at = [], 0
    for word in _WORD.finditer(line):
        if _STOPS.search(word[0].decode("utf-8", "replace")):
            out.append(line[at : word.end()])
            at = word.end()
    if out and len(line[at:].split()) <= MAX_TAIL:
        out[-1] += line[at:]
    else:
        out.append(line[at:])
    return out


def line_left(line: bytes, words: list[bytes]) -> bytes | None:
    """What is left of a line: all of it, its good sentences, or None."""
    if len(words) <= LONG_LINE:
        return None if line_fails(line, words) else line
    good = [s for s in sentences(line) if not line_fails(s, s.split())]
    left = b"".join(good)
    return left if good else None


def judge(text: bytes) -> tuple[dict, bytes]:
    """The figures of one text, and the text without its failing lines."""
    words = text.split()
    all_lines = text.split(b"\n")
    by_line = [(line, line.split()) for line in all_lines]
    parts = [line_left(line, w) if w else line for line, w in by_line]
    chars = word_chars(text)
    lost = sum(
        word_chars(line) - word_chars(part or b"") for line, part in zip(all_lines, parts) if part != line
    )
    repeats = n_repeat_words(words)
    base_failed = len(words) < MIN_WORDS or 100 * repeats > MAX_REPEAT_PCT * len(words)
    report = {
        "n_words": len(words),
        "word_chars": chars,
        "n_symbols": n_symbols(text),
        "n_dup_lines": n_dup_lines([line for line, w in by_line if w]),
        "n_repeat_words": repeats,
        "base_failed": base_failed,
        "kept": not base_failed and 100 * lost <= MAX_LOST_PCT * chars,
        "n_lines_removed": sum(part is None for part in parts),
        "lost_chars": lost,
    }
    return report, b"\n".join(part for part in parts if part is not None)


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with the figures and the verdict, in the columns of ``REPORT``."""
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        reports = [judge(text)[0] for text in text_bytes(batch.column(1))]
        out = {name: [r[name] for r in reports] for name in (reports[0] if reports else {})}
        return out | {"doc_id": batch.column(0)}

    return in_batches(rows, REPORT, work)


def keep_good(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """The documents that pass, with all their columns and without their failing lines.

    ``chars_col``, where there is one, gets the length of the text that is left.
    """
    names = docs.columns

    def run(batches):
        for batch in slices(batches):
            at = names.index(text_col)
            judged = [judge(text) for text in text_bytes(batch.column(at))]
            mask = pa.array([report["kept"] for report, _ in judged], pa.bool_())
            kept = batch.filter(mask)
            texts = [left.decode("utf-8", "replace") for report, left in judged if report["kept"]]
            columns = list(kept.columns)
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            if chars_col in names:
                field = batch.schema.field(names.index(chars_col))
                columns[names.index(chars_col)] = pa.array([len(t) for t in texts], field.type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return in_small_batches(docs).mapInArrow(run, docs.schema)
