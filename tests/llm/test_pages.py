import gzip
import hashlib
from collections import Counter

import pytest

from tripmill.llm import style_tree, warc
from tripmill.llm.html_tree import attributes, events
from tripmill.llm.style_tree import low_nodes, main_texts, read

from .conftest import prose

PAGES = "page_id bigint, url string, html string"


def page(article, extra="", title="T"):
    return (
        f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style><script>var t='</p>';</script></head>"
        f"<body><nav><ul><li><a href='/a'>Home</a><li>News</ul></nav>{extra}<article><h1>{title}</h1>{article}"
        "</article><footer>&copy; site</footer></body></html>"
    )


@pytest.mark.parametrize("html,want", [
    ("", ""),
    ("plain text &amp; more", "plain text & more"),
    (page("<p>One</p><p>two <b>bo</b>ld&nbsp;x</p>"), "T One two bold x"),
    (page("<p>a<br>b<p>c<ul><li>d<li>e</ul><table><tr><td>f<td>g</table>"), "T a b c d e f g"),
    (page("<p>text</p><aside>no</aside><div class='ad-box'>no</div><form>no <input></form><p>end</p>"), "T text end"),
    (page("<p>x &lt;y&gt; &#233; &amp &am</p>"), "T x <y> é & &am"),
    (page("<p>p</p>", extra="<div class=cookie-notice>We use cookies</div><header>Site</header>"), "T p"),
    (page("<header><p>by me</p></header><p>p</p><section id='comments'><article>first!</article></section>"), "T by me p"),
    ("<body><main><p>in main</p></main><p>outside</p></body>", "in main"),
    ("<body><div id=sidebar>no</div><div>yes</div><p hidden>no</p><p style='display: none'>no</p></body>", "yes"),
    ("<nav>menu <article><p>never closed menu</p></article>", "never closed menu"),
    ("<article><p>cut off &quot;here&quot; <a hre", 'cut off "here"'),
    ("<article><p>a<!-- hidden --><![CDATA[x]]>b</p><script>if (a<b) x='</article>'</script> c</article>", "ab c"),
    ("</div></p><article>ok</p></span></article>", "ok"),
    ("<article><p>a < b and 5 > 3</p></article>", "a < b and 5 > 3"),
])
def test_main_text(html, want):
    assert read(html) == want


def test_every_open_element_is_closed():
    for html in (page("<p>a<div>b"), "<b><i></b><p><p></i>", "<ul><li><ul><li>x</ul>", "<table><tr><td><p>a<td>b</table>"):
        depth = Counter()
        for kind, name, _ in events(html):
            if kind != "text":
                depth[name] += 1 if kind == "open" else -1
                assert depth[name] >= 0
        assert not any(depth.values())


def test_attributes():
    assert attributes(""" Class="a b" id='x' hidden data-a=1 class="c" """) == {
        "class": "a b", "id": "x", "hidden": "", "data-a": "1"
    }


def found(df):
    return sorted((repr(r.page_id), r.url, r.text, r.n_chars) for r in main_texts(df).collect())


def test_frames_of_a_host_are_cut_out(spark):
    def html(i):
        return (f"<body><div class='wrap'><div class='top'>Welcome to the site of sites</div><div class='story'><p>"
                f"{prose(i, 20)}</p></div><div class='low'><p>Imprint and contact</p></div></div></body>")

    rows = [(i, "https://a.example/x", html(i)) for i in range(30)]
    rows += [(100 + i, "https://small.example/x", html(100 + i)) for i in range(3)]
    df = spark.createDataFrame(rows, PAGES).repartition(4)
    low = {r.host: set(r.low) for r in low_nodes(style_tree.hosted(df)).collect()}
    assert low == {"a.example": {"/body/div.wrap/div.top", "/body/div.wrap/div.low", "/body/div.wrap/div.low/p"}}
    texts = {r.page_id: r.text for r in main_texts(df).collect()}
    assert all(texts[i] == prose(i, 20) for i in range(30))
    assert texts[100] == f"Welcome to the site of sites {prose(100, 20)} Imprint and contact"


def test_articles_of_equal_pages_stay(spark):
    rows = [(i, "http://h.example/", page("<p>the same article everywhere</p>")) for i in range(40)]
    rows += [(50 + i, "http://h.example/", page("<p>the same article everywhere</p>", title=f"t{i}")) for i in range(20)]
    df = spark.createDataFrame(rows, PAGES).repartition(3)
    assert all("the same article everywhere" in t for _, _, t, _ in found(df))


@pytest.mark.parametrize("limit", [None, 0])
def test_pages_without_an_id_are_in_the_tree(spark, monkeypatch, limit):
    if limit is not None:
        monkeypatch.setattr(style_tree, "BROADCAST_BYTES", limit)
    frame = '<div class="zq"><span>same frame on every page</span></div>'
    body = "<p>story {0} with its very own words {0}</p>"
    rows = [
        (None if i % 2 else i, f"http://h.example/{i}", f"<body>{frame}<div class='x'>{body.format(i)}</div></body>")
        for i in range(60)
    ]
    rows += [(None, None, f"<body>{frame}<div class='x'>{body.format(99 + i)}</div></body>") for i in range(30)]
    rows += [rows[1]] * 20
    texts = [r.text for r in main_texts(spark.createDataFrame(rows, PAGES).repartition(4)).collect()]
    assert len(texts) == len(rows) and not [t for t in texts if "frame" in t]
    assert all("own words" in t for t in texts)


def test_repeated_blocks_inside_articles_go(spark):
    def html(i):
        box = "<div class='box/2'><div><p>Written by <b>the desk</b></p><ul><li>Tell a friend</li></ul></div></div>"
        deep = "<div>" * 15 + f"<p>{prose(300 + i, 5)}</p><p class=x>Follow the desk</p>" + "</div>" * 15
        own = f"<p>{prose(i, 20)} <b>Acme</b> said.</p>"
        inner = "<article class=card><p>Our best tale</p></article>"
        return f"<html><body><div class=a><article><h1>t{i}</h1>{box}{own}{deep}{inner}</article></div></body></html>"

    rows = [(i, "https://a.example/x", html(i)) for i in range(20)]
    texts = {r.page_id: r.text for r in main_texts(spark.createDataFrame(rows, PAGES).repartition(3)).collect()}
    assert texts == {i: f"t{i} {prose(i, 20)} Acme said. {prose(300 + i, 5)}" for i in range(20)}


EDGE = [
    (1, None, None), (2, "http://x.example/", ""), (3, "nonsense", "  \n "), (None, "http://x.example/", page("<p>null id</p>")),
    (4, "http://x.example/a b\r\nInjected: 1", page("<p>" + prose(1, 40_000) + "</p>")),
    (5, "http://x.example/", page("<p>" + prose(2, 300) + "</p>")), (6, "http://y.example/", page("<p>" + prose(2, 300) + "</p>")),
    (6, "http://y.example/", page("<p>" + prose(2, 300) + "</p>")), (7, "u", "é" * 999), (8, "u", "é" * 999),
    (9, "u", "a" * 999), (10, "u", "a" * 999), (11, "u", "b" * 1000), (12, "u", "b" * 1000), (None, "u", "b" * 1000),
    (13, "u", "<p>" * 5000 + "deep"),
]


@pytest.fixture(scope="module")
def edge(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(EDGE, PAGES).repartition(4)
    return df.select("*", F.lit(1).alias("host"), F.lit(2).alias("low"), F.lit(3).alias("digest"), F.lit(4).alias("shard"))


def test_edge_pages(spark, edge):
    got = found(edge)
    assert got == sorted((repr(i), u, read(h or ""), len(read(h or ""))) for i, u, h in EDGE)
    assert main_texts(spark.createDataFrame([], PAGES)).collect() == []


def slow_records(rows):
    out = []
    best = {}
    for i, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 1000 and i is not None:
            best[b] = max(best.get(b, i), i)
    answered = set()
    for i, _, h in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        b = (h or "").encode()
        kind, to = "response", None
        copies = sum((x or "").encode() == b for _, _, x in rows)
        if len(b) >= 1000 and copies > 1:
            if best.get(b) != i or b in answered:
                kind, to = "revisit", best.get(b)
            else:
                answered.add(b)
        out.append((repr(i), len(b), hashlib.sha1(b).hexdigest(), kind, repr(to)))
    return sorted(out)


def records(df):
    return sorted(
        (repr(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, repr(r.refers_to)) for r in df.collect()
    )


def test_edge_archive(spark, edge, tmp_path):
    root = str(tmp_path / "a")
    manifest = warc.write_archive(edge, root, shard_bytes=20_000, roll_bytes=2_000)
    assert records(warc.read_archive(spark, root, manifest)) == slow_records(EDGE)
    assert manifest.count() > 4
    none = warc.write_archive(spark.createDataFrame([], PAGES), str(tmp_path / "b"))
    assert none.count() == 0 and warc.read_archive(spark, str(tmp_path / "b"), none).collect() == []


def test_archive_does_not_depend_on_partitions(spark, edge, tmp_path):
    files = []
    for n, name in ((1, "one"), (7, "seven")):
        manifest = warc.write_archive(edge.repartition(n), str(tmp_path / name), 20_000, 2_000)
        files.append({r.file: (r.sha1, r.bytes, r.records) for r in manifest.collect()})
        for file, (sha1, size, _) in files[-1].items():
            data = (tmp_path / name / file).read_bytes()
            assert (hashlib.sha1(data).hexdigest(), len(data)) == (sha1, size)
    assert files[0] == files[1]
    assert list((tmp_path / "one" / "_temporary").iterdir()) == []


def test_records_are_well_formed(spark, edge, tmp_path):
    root = str(tmp_path / "w")
    manifest = warc.write_archive(edge, root)
    ids = []
    for r in manifest.collect():
        data = gzip.decompress((tmp_path / "w" / r.file).read_bytes())
        assert data.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n") and data.endswith(b"\r\n\r\n")
        assert b"\r\nInjected" not in data
        at = 0
        while at < len(data):
            head = data[at : data.index(b"\r\n\r\n", at)].decode()
            fields = dict(line.split(": ", 1) for line in head.split("\r\n")[1:])
            ids.append(fields["WARC-Record-ID"])
            at += len(head.encode()) + 4 + int(fields["Content-Length"]) + 4
    assert len(ids) == len(set(ids))


def test_damage_is_noticed(spark, edge, tmp_path):
    root = tmp_path / "d"
    manifest = warc.write_archive(edge, str(root))
    name = manifest.first().file
    data = bytearray((root / name).read_bytes())
    (root / name).write_bytes(bytes(data[: len(data) // 2]))
    with pytest.raises(Exception):
        warc.read_archive(spark, str(root), manifest).collect()
    with pytest.raises(ValueError, match="digest"):
        warc.parsed(b"WARC/1.1\r\nContent-Length: 1\r\nWARC-Block-Digest: sha1:AAAA\r\n\r\nx\r\n\r\n")
    with pytest.raises(ValueError, match="length"):
        warc.parsed(b"WARC/1.1\r\nContent-Length: 1\r\n\r\nxy\r\n\r\n")
