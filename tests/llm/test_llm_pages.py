"""Pages, archives and embeddings against plain versions, and their edge cases."""

import hashlib
import math
import random
from collections import Counter

import brute
import numpy as np
import pytest

from tallyforge.llm import common, embeddings, html, warc

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a = "<p>no</p>";</script><style>p{}</style></head><body>
<nav><ul><li><a href="/a">Home</a><li><a href="/b">More</a></ul></nav><div class="cookie-notice">We use cookies &amp; more.</div>
<div id="wrap"><div class="sidebar"><p>Side text that is long enough to look like prose, really quite long.</p></div>%s</div>
<div id="comments"><p>Reader says something long and wordy about the article, as readers like to do.</p></div>
<form><p>Your name</p><input><button>Go</button></form><footer>&copy; Someone</footer></body></html>"""
STORY = "<h1>A &lt;great&gt; story</h1><p>First   paragraph with\n some <b>bold</b> and <a href=x>linked</a> words, and it goes on.<p>Second one<br>goes on &amp; on&nbsp;here.</p>"
WANT = "A <great> story\nFirst paragraph with some bold and linked words, and it goes on.\nSecond one goes on & on here."


@pytest.mark.parametrize("around", ["<article>%s</article>", "<main><div>%s</div></main>", "<div><div class='text'>%s</div></div>"])
def test_article_is_found(around):
    assert html.main_text(PAGE % (around % STORY)) == WANT


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), (" \n", ""), ("plain text", "plain text"), ("<p>one<p>two", "one\ntwo"), ("<html><body><nav><a>x</a></nav></body></html>", ""),
    ("<p>cut off &am", "cut off &am"), ("<p>cut off <b", "cut off"), ("<p>&#55357; &#x41;</p>", "� A"), ("<!-- <p>no</p> --><p>yes", "yes"),
    ("<article><p>a</p><script>if (a < b) '</p>'</script><p>b</p></article>", "a\nb"), ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"),
])
def test_odd_pages(page, want):
    assert html.main_text(page) == want


@pytest.mark.parametrize("names", [
    "content has-sidebar", "no-sidebar", "layout-with-sidebar", "side-by-side", "with-banner", "post share-enabled", "press-notice",
    "widget-area-off", "widget", "left-sidebar", "comments-open",
])
@pytest.mark.parametrize("inner", ["%s", "<article>%s</article>", "<main>%s</main>"])
def test_layout_classes_do_not_hide_the_article(names, inner):
    side = '<div class="sidebar"><p>Short side text.</p></div><div class="site-footer">Imprint</div>'
    page = f'<html><body><div class="{names}">{inner % STORY}</div>{side}</body></html>'
    assert html.main_text(page) == WANT
    assert html.main_text(page.replace(STORY, STORY + '<div class="share-buttons">Tell others</div>')) == WANT


def test_long_comments_and_ads_stay_out():
    assert html.main_text(f"<body><div class='ad'>{'Buy this. ' * 90}</div><article>{STORY}</article></body>") == WANT
    said = "<article class='comment-body'><p>" + "Readers have a lot to say about it. " * 20 + "</p></article>"
    for inner in ("<article>%s</article>", "<div>%s</div>"):
        assert html.main_text(f"<body>{inner % STORY}<div id='comments'>{said * 5}</div></body>") == WANT


def test_bare_text_around_a_denser_block():
    bare = [f"Part {i} is text straight in the box, " + "with more words " * 8 + "at its end." for i in range(4)]
    quote = "".join(f"<p>{'A quoted line goes on and on. ' * 13}</p>" for _ in range(2))
    page = f"<body><div>{bare[0]}<br><br>{bare[1]}<blockquote>{quote}</blockquote>{bare[2]} <b>and bold</b><br><br>{bare[3]}</div></body>"
    got = html.main_text(page)
    assert all(b in got for b in bare) and got.count("A quoted line") == 26 and "at its end. and bold" in got
    assert got.index(bare[1]) < got.index("A quoted") < got.index(bare[2])


def test_parts_beside_the_core_stay():
    core = "".join(f"<p>{'The story goes on and on in words. ' * 12}</p>" for _ in range(4))
    links = "<ul><li><a href=/a>Other page</a><li><a href=/b>One more page</a></ul>"
    page = f"<body><a href=/>Start</a><h1>Name</h1>Straight in the body.{links}<div><h2>A title</h2><p>Lead.</p>Own words, <i>short</i>.{links}<div>{core}</div><p>End.</p></div></body>"
    lines = html.main_text(page).split("\n")
    assert [x for x in lines if not x.startswith("The story")] == ["Name", "Straight in the body.", "A title", "Lead.", "Own words, short.", "End."]
    assert len(lines) == 10


def test_extract(spark):
    rows = [(1, "u", PAGE % STORY, "x", 1), (1, "u", PAGE % STORY, "x", 1), (None, None, None, "x", 1), (3, "v", "<p>" + "ä " * 50_000, "x", 1), (4, "w", "<div>" * 5000 + "deep", "x", 1)]
    pages = spark.createDataFrame(rows, "page_id LONG, url STRING, html STRING, text STRING, n_chars LONG")
    got = html.extract(pages).collect()
    assert len(got) == 5 and all(r.n_chars == len(r.text) for r in got)
    assert sorted(r.n_chars for r in got) == sorted([len(html.main_text(PAGE % STORY))] * 2 + [0, 99_999, 4])
    assert html.extract(pages.limit(0)).count() == 0


def archived(spark, rows, **options):
    return warc.archive(spark.createDataFrame(rows, "page_id LONG, url STRING, html STRING, file STRING"), **options)


def test_archive_round_trip(spark):
    big, rng = "ä" * 600, random.Random(1)
    rows = [(i, f"http://x/{i}", rng.choice([big, big + "1", "small", f"{i}" * 700]), "f") for i in range(80)]
    rows += [(200, "http://a b\n", "dup", "f"), (200, None, "dup", "f"), (None, "n", big, "f"), (None, "n", None, "f"), (90, "r", "R" * 2000, "f"), (90, "r", "R" * 2000, "f"), (300, "u", "x" * 400_000, "f")]
    got = archived(spark, rows, part_bytes=60_000, file_bytes=2000).collect()
    most, want = {}, Counter()
    for i, _, h, _ in rows:
        most[h] = max([x for x in (most.get(h), i) if x is not None], default=None)
    first = set()
    for i, _, h, _ in rows:
        raw = (h or "").encode()
        revisit = len(raw) >= 1000 and (i != most[h] or h in first)
        first |= {h} if i == most[h] else set()
        want[(i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", most[h] if revisit else None)] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    assert len({r.file for r in got}) > 6 and "http://a%20b%0A" in {r.url for r in got}


def test_archives_are_equal_when_written_again(spark):
    rows = [(i, "u", "page " * (i + 200), "f") for i in range(50)]
    pages = spark.createDataFrame(rows, "page_id LONG, url STRING, html STRING, file STRING")
    shas = [sorted((r.file, r.sha256) for r in warc.write(pages.repartition(n), common.shared_dir(spark, "w"), part_bytes=1 << 30).collect()) for n in (1, 4)]
    assert shas[0] == shas[1]
    assert archived(spark, rows[:0] or [], ).count() == 0


def test_damage_is_noticed():
    data = warc.record(1, "u", b"x" * 50, 0, False, None, "2000-01-01T00:00:00Z")
    import gzip
    import io

    _, headers, block = next(iter(warc.records_of(io.BytesIO(gzip.compress(data)))))
    assert warc.parse(headers, block)["payload_bytes"] == 50
    with pytest.raises(ValueError):
        warc.parse(headers, block.replace(b"x", b"y", 1))
    with pytest.raises(ValueError):
        list(warc.records_of(io.BytesIO(gzip.compress(data[:-30]))))


def vectors(seed=1, n=120, dims=12):
    rng = random.Random(seed)
    rows, centers = [], [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(6)]
    for i in range(n):
        center = rng.choice(centers)
        noise = rng.choice([0.0, 0.02, 0.1, 0.2, 1.0])
        rows.append((i, [x + rng.gauss(0, noise) for x in center], rng.choice([1, 2, 2, None])))
    rows += [(500, None, 1), (501, [0.0] * dims, 1), (502, [float("nan")] * dims, 1), (503, [math.inf] + [1.0] * (dims - 1), 1), (504, [1.0, None] + [0.0] * (dims - 2), 1)]
    rows += [(505, [1.0, 2.0], 2), (506, [2.0, 4.0], 2), (507, [], 2), (None, rows[0][1], rows[0][2]), (3, rows[3][1], rows[3][2]), (3, rows[3][1], rows[3][2])]
    return rows


@pytest.mark.parametrize("tile, seed", [(1024, 1), (8, 2)])
def test_near_vectors(spark, tile, seed):
    rows = vectors(seed)
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id LONG, embedding ARRAY<FLOAT>, label INT, node INT")
    plain = [(r.vec_id, r.embedding, r.label) for r in frame.collect()]
    got = embeddings.near_duplicates(frame, 0.98, rows_per_tile=tile)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, brute.near(plain, 0.98)))
    assert embeddings.near_duplicates(frame.limit(0)).count() == 0


@pytest.mark.parametrize("part", [200_000, 25])
def test_components(spark, part, monkeypatch):
    monkeypatch.setattr(common, "PART", part)
    rng = random.Random(6)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5000 + i) for i in range(40)]
    union = brute.Union()
    for a, b in edges:
        union.join(a, b)
    got = {r.node: r.root for r in common.components(spark.createDataFrame(edges, "a LONG, b LONG"), "test").collect()}
    assert got == {x: union.find(x) for e in edges for x in e if e[0] != e[1]}


def paragraphs(rng, n):
    texts = [" ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(rng.randint(25, 60))) + "." for _ in range(n)]
    return "".join(f"<p>{t}</p>" for t in texts), "\n".join(texts)


SAID = "<p>" + "I liked this very much and would read more of it. " * 8 + "</p>"


@pytest.mark.parametrize("page, want", [
    ("<article>%s</article><div id='user-comments'>" + SAID * 4 + "</div>", "%s"),
    ("<div class='post'>%s</div><div id='reader-comments'>" + SAID * 4 + "</div>", "%s"),
    ("<article>%s<section class='user-comments'>" + SAID * 4 + "</section></article>", "%s"),
    ("<main><article><p>First of two, short.</p></article><article>%s</article></main>", "First of two, short.\n%s"),
    ("<main><article>%s</article><article><a href='/x'>Another story to read</a></article></main>", "%s"),
    ("<article><header><h1>A title</h1><p>By one</p><time>Today</time></header>%s</article>", "A title\n%s"),
    ("<header><h1>The site</h1></header><article>%s</article>", "%s"),
    ("<article>%s<div class='google-ad'>Buy this</div><ins class='adsbygoogle'>Buy that</ins></article>", "%s"),
    ("<article>%s<p>So <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.</p></article>", "%s\nSo x=2 holds."),
    ("<body class='has-comments'><div class='no-ads ad-free'>%s</div>", "%s"),
])
def test_article_is_found_beside_additions(page, want):
    body, text = paragraphs(random.Random(1), 4)
    assert html.main_text(page % body) == want % text


def test_random_pages_give_their_known_article():
    """Pages put together from a known article and pieces that are not one, in random order and nesting."""
    rng = random.Random(5)
    links = lambda n: "".join(f"<li><a href='/{k}'>Go to place {k}</a></li>" for k in range(n))
    around = [
        lambda: f"<nav><ul>{links(rng.randint(2, 9))}</ul></nav>", lambda: "<aside>" + SAID * rng.randint(1, 3) + "</aside>",
        lambda: f"<div class='{rng.choice(['sidebar', 'site-footer', 'related-posts', 'cookie-notice', 'user-comments'])}'>{SAID * rng.randint(1, 6)}</div>",
        lambda: "<script>var a = '<p>no</p>';</script>", lambda: "<form><p>Your name</p><input><button>Send</button></form>",
        lambda: f"<section id='comments'><article class='comment'>{SAID}</article></section>",
    ]
    holders = ["<article>%s</article>", "<main>%s</main>", "<main><article>%s</article></main>", "<div><article class='post'>%s</article></div>"]
    for _ in range(300):
        body, text = paragraphs(rng, rng.randint(2, 8))
        pieces = [rng.choice(around)() for _ in range(rng.randint(0, 6))]
        pieces.insert(rng.randint(0, len(pieces)), rng.choice(holders) % body)
        page = "".join(pieces)
        for _ in range(rng.randint(0, 3)):
            page = f"<div>{page}</div>"
        assert html.main_text(f"<!DOCTYPE html><html><body>{page}</body></html>") == text


def test_pairs_at_the_threshold_are_decided_as_given():
    """Products over turned axes differ in the last places; the vectors as given decide."""
    rng = np.random.default_rng(3)
    axes, _ = np.linalg.qr(rng.normal(size=(24, 24)))
    raw = rng.integers(-9, 10, size=(300, 24)).astype(float)
    raw = raw[np.abs(raw).sum(axis=1) > 0]
    x = (raw / np.linalg.norm(raw, axis=1)[:, None]) @ axes
    every = np.array([embeddings.cosines(np.broadcast_to(r, raw.shape), raw) for r in raw])
    for threshold in rng.choice(every[np.triu_indices(len(raw), 1)], 20):
        i, j = embeddings.compare(x, x, float(threshold), (raw, raw))
        assert set(zip(i.tolist(), j.tolist())) == set(zip(*(k.tolist() for k in np.nonzero(every >= threshold))))
