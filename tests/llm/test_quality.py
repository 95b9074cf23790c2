from collections import Counter

import duckdb
from pyspark.sql import functions as F

from tripmill.llm.line_quality import judge, keep_good, line_fails, line_report, n_repeat_words

from tripmill.llm.oracle_sql import line_quality_sql

from .conftest import clashing, prose


def slow_repeats(words):
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen = Counter(windows)
    return len({i + j for i, w in enumerate(windows) if seen[w] > 1 for j in range(8)})


def slow_figures(text):
    b = (text or "").encode()
    words = b.split()
    lines = [line for line in b.split(b"\n") if line.split()]
    chars = sum(len(w.decode()) for w in words)
    symbols = sum(c in "#*$%&|<>" for c in (text or ""))
    dup = sum(line in lines[:i] for i, line in enumerate(lines))
    repeats = slow_repeats(words)
    return len(words), chars, symbols, dup, repeats, len(words) < 20 or 100 * repeats > 30 * len(words)


def test_base_figures(documents, no_documents):
    found = sorted(
        (repr(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        for r in line_report(clashing(documents)).collect()
    )
    assert found == sorted((repr(r.doc_id), *slow_figures(r.text)) for r in documents.collect())
    assert line_report(no_documents).collect() == []
    assert keep_good(no_documents).collect() == []


def test_verdicts_match_the_sql(spark):
    """The SQL states the rules a second time: long lines by sentence, phrases, marks of other scripts."""
    long = " ".join(f"word{i}" for i in range(45))
    texts = [
        long, f"{long}. Read more. Then {long}! and a tail", f"{long}. privacy policy read more read more. {long}",
        "read more read more", "thread more read", f"terms of use of cookies. {prose(3, 30)}", "नमस्ते दुनिया।",
        "สวัสดี", f"{long}.) \u201cSo.\u201d {long} {long}: {long}", "A | B | C | D | E.", f"\n\n \n{long}\n{long}.\n{long}.",
        "GO AWAY NOW YOU ALL. ", f"a a a a a a a a a a a. {long}.", "x's 'end.' \t", "all  rights reserved. all rights reserved.",
        None, "", " \n ", "#" * 50 + " a.", f"{prose(5, 200)} click here to click here to. {prose(6, 30)}",
    ]
    rows = [(i, t) for i, t in enumerate(texts)]
    report = line_report(spark.createDataFrame(rows, "doc_id bigint, text string"))
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = con.sql(f"SELECT {', '.join(report.columns)} FROM ({line_quality_sql()}) ORDER BY doc_id").fetchall()
    assert [tuple(r) for r in report.orderBy("doc_id").collect()] == want


def test_repeated_words():
    for words in (["a"] * 8, ["a"] * 9, list("abcdefgh") * 2, list("abcdefgh") + ["x"] + list("abcdefgh")):
        raw = [w.encode() for w in words]
        assert n_repeat_words(raw) == slow_repeats(raw)
    many = [f"{i}".encode() for i in range(60_000)] + [f"{i}".encode() for i in range(40)]
    assert n_repeat_words(many) == 80


def test_lines():
    good = [b"This is a sentence.", b"He said \xe2\x80\x9cyes.\xe2\x80\x9d", b"It costs 5 & 6 euros. Call +1 555",
            b"A heading ends: here"]
    bad = [b"Home | News | Sports | About | Contact", b"no end at all", b"THIS IS ALL SHOUTING NOW!!",
           b"buy%%% now&&& or$$$ never### again.***", b"All rights reserved.", b"We use cookies. Accept all cookies.",
           b"go go go go go go go go go go go."]
    assert [line for line in good if line_fails(line, line.split())] == []
    assert [line for line in bad if not line_fails(line, line.split())] == []


def test_documents_lose_lines_or_go(spark):
    clean = prose(1, 100)
    rows = [
        (1, clean, "x", 7), (2, clean + "\nHome | News | Sports | About", "x", None),
        (3, "no end here at all\n" * 30 + clean[:40] + ".", "x", 1), (4, None, "x", 1), (5, "", None, 1),
        (2, clean + "\nHome | News | Sports | About", "x", None),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, Text_ string, n_chars bigint")
    kept = keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text, r.n_chars) for r in kept.collect()) == [
        (1, clean, len(clean)), (2, clean, len(clean)), (2, clean, len(clean))
    ]


def test_clean_labelled_documents_are_kept(spark):
    at = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{at}/documents.parquet").join(spark.read.parquet(f"{at}/labels.parquet"), "doc_id")
    judged = line_report(docs).join(docs.select("doc_id", "quality"), "doc_id").where(~F.col("base_failed"))
    shares = {r.quality: r.share for r in judged.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert shares[1] > 0.99 and shares[0] < 0.05


def test_nothing_changes_in_a_clean_text():
    text = prose(3, 60).encode()
    report, left = judge(text)
    assert report["kept"] and left == text


def test_long_one_line_documents_lose_only_the_notice():
    start, end = prose(7, 900), prose(8, 900)
    for notice in ("Please read more in our privacy policy.", "Subscribe to our newsletter."):
        report, left = judge(f"{start} {notice} {end}".encode())
        assert report["kept"] and left.decode() == f"{start} {end}" and report["n_lines_removed"] == 0
        assert report["lost_chars"] == len(notice.replace(" ", ""))
    for text in (f"{start} She read the privacy policy of the firm before the court met again in June with all"
                 f" who had signed. {end}", f"I blog in to it, a thread more of it.\n{start}"):
        report, left = judge(text.encode())
        assert report["kept"] and left.decode() == text


def test_sentence_marks_of_other_scripts():
    lines = ["यह एक वाक्य है।", "هل هذه جملة؟", "یہ ایک جملہ ہے۔", "Սա նախադասություն է։", "นี่คือประโยคที่ดี", "彼は「はい。」"]
    assert [line for line in lines if line_fails(line.encode(), line.encode().split())] == []
