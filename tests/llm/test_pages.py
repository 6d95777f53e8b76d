"""HTML extraction, URL verdicts and WARC archives."""

import hashlib
import math
import os
import random
import re
import urllib.parse
import uuid

import pytest
from pyspark.sql import functions as F

from sensorflow.llm import html_text, url_filter, warc
from sensorflow.llm.common import shared_folder

from .helpers import CLASHING

PAGE_SCHEMA = "page_id long, url string, html string"


def pages(spark, rows, clashing=False):
    df = spark.createDataFrame(rows, PAGE_SCHEMA)
    return df.withColumns({k: F.lit(v) for k, v in CLASHING.items()}) if clashing else df


LONG = "Long enough to be the main text of a page, sentence after sentence. "
CASES = [
    ("", ""), ("plain text", "plain text"), ("<p></p>", ""), ("<script>var a='<p>x</p>'</script>", ""),
    ("<article><h1>T &amp; t</h1><p>One\n two<br>three</p><p>Te.</p></article><footer>f</footer>", "T & t\nOne two three\nTe."),
    ("<nav><ul><li><a href=a>Home</a></ul></nav><div class='ad'>Buy!</div><article><p><b>Unclosed <i>tags<p>second"
     "</article><div id=comments><p>" + LONG + "</p></div>", "Unclosed tags\nsecond"),
    ("<header><h1>Site</h1></header><div class=post><h2>Title</h2><p>" + LONG + "</p><p>" + LONG + "<ul><li>a<li>b</ul>"
     "<form><p>Sign up</form></div><div class='cookie-notice'>" + LONG + "</div><aside>" + LONG + "</aside>",
     f"Title\n{LONG.strip()}\n{LONG.strip()}\na\nb"),
    ("<main><header><h1>Own title</h1></header><p>Body</p></main>", "Own title\nBody"),
    ("<article><p>x &lt;b&gt; &eacute;&#233;&nbsp;y</p></article>", "x <b> éé y"),
    ("<article><p>cut off in the mid", "cut off in the mid"), ("<article><!-- c --><p>a<!-- b -->c</p>", "ac"),
    ("<title>t</title><style>p{}</style><article><table><tr><td>1<td>2</table></article>", "1\n2"),
    ("<article><div hidden>no</div><p>yes</p><template>no</template></article>", "yes"),
]


@pytest.mark.parametrize("html,text", CASES)
def test_main_text(html, text):
    assert html_text.main_text(html) == text


MARKED = [
    ("<div class='has-sidebar'><article><p>Body</p></article></div>", "Body"),
    ("<body><div id='page' class='site share'><header>Site</header><div class='no-sidebar'><main><p>Body</p></main></div>"
     "<div class=sidebar><p>" + LONG + "</div></div></body>", "Body"),
    ("<div class='has-sidebar'><article><p>" + LONG + "</p></article></div><article><p>Other</p></article>",
     LONG.strip() + "\nOther"),
    ("<article><header class='entry-header'><h1>Title</h1></header><p>Body</p></article>", "Title\nBody"),
    ("<article><h1 class='post-header'>Title</h1><p>Body</p><div class='share'>Share</div></article>", "Title\nBody"),
    ("<main><div class='site share'><p>" + LONG + "</p></div><p>x</p></main>", LONG.strip() + "\nx"),
    ("<div class='site has-sidebar'><h2>Title</h2><p>" + LONG + "</p><p>" + LONG + "</p></div><p>c</p>",
     f"Title\n{LONG.strip()}\n{LONG.strip()}\nc"),
    ("<div class=post><p>Short</p></div><div class=comments><p>" + LONG * 9 + "</p></div>", "Short"),
    ("<article><p>Short</p></article><ol class=comments><li><article><p>" + LONG + "</p></article></ol>", "Short"),
    ("<article><p>" + LONG + "</p></article><div class=sidebar><article>Other</article></div>", LONG.strip()),
    ("<article><p>in <span class=share>Share</span> line</p></article>", "in line"),
]


@pytest.mark.parametrize("html,text", MARKED)
def test_marks_do_not_hide_the_page_itself(html, text):
    assert html_text.main_text(html) == text


def paragraphs(n, chars):
    return [(f"Paragraph {i} " + LONG * (chars // len(LONG) + 1))[:chars].strip() for i in range(n)]


@pytest.mark.parametrize("wrap", ["<body><div>{}</div></body>", "<body>{}</body>", "{}",
                                  "<body><div id=menu-x><ul><li><a href=a>Home page</a><li><a href=b>Other pages</a>"
                                  "</ul></div><div>{}</div></body>"])
@pytest.mark.parametrize("tag", ["p", "pre", "blockquote", "div"])
@pytest.mark.parametrize("n,long", [(20, 8_000), (60, 20_000), (0, 900)])
def test_one_long_paragraph_among_short_ones_without_article(wrap, tag, n, long):
    short, big = paragraphs(n, 200), paragraphs(1, long)[0]
    blocks = [*(f"<p>{t}</p>" for t in short[:n // 2]), f"<{tag}>{big}</{tag}>", *(f"<p>{t}</p>" for t in short[n // 2:])]
    got = html_text.main_text(wrap.format("<h1>Title</h1>" + "".join(blocks))).split("\n")
    want = ["Title", *short[:n // 2], big, *short[n // 2:]]
    assert got == want


def test_a_tenth_beside_a_nested_wrapper_stays_and_a_cluster_apart_does_not():
    links = "".join(f"<li><a href=x{i}>Another page of this site</a>" for i in range(6))
    body = "".join(f"<p>{t}</p>" for t in paragraphs(10, 300))
    near = html_text.main_text(f"<body><div><div>{body}</div><div><p>{LONG}</p></div></div></body>")
    assert near.split("\n") == [*paragraphs(10, 300), LONG.strip()]
    apart = html_text.main_text(f"<body><div>{body}</div><ul>{links}</ul><div><p>{LONG}</p></div></body>")
    assert apart.split("\n") == paragraphs(10, 300)


RELATED = "".join(f"<li><a href=x{i}>Another page of this site</a></li>" for i in range(4))
TEXT_BLOCK_MARKS = [
    ("<article><p class='search'>One</p><p id='social'>Two</p><h2 id='comments'>Comments in code</h2><ul><li id=menu>Menu</ul>"
     "</article>", "One\nTwo\nComments in code\nMenu"),
    ("<article><p>Body</p><p class='sponsored'>Buy!</p><p class='ad'>Buy!</p><div class='share'>Share</div></article>", "Body"),
    ("<article><p>Body</p><div class='comments'><p>" + LONG + "</p></div></article>", "Body"),
    ("<body><h2 id='menu'>Menu</h2><p>" + LONG + "</p></body>", "Menu\n" + LONG.strip()),
    ("<main><h1>T</h1><article><p>" + LONG + "</p></article><article><h3><a href=x>Teaser</a></h3><p>Read it</p></article></main>",
     "T\n" + LONG.strip()),
    ("<main><article>One two</article><article>One two</article></main>", "One two\nOne two"),
]


@pytest.mark.parametrize("html,text", TEXT_BLOCK_MARKS)
def test_text_blocks_stay_whatever_their_ids_and_articles_beside_the_story_go(html, text):
    assert html_text.main_text(html) == text


def test_a_closing_paragraph_after_related_links_stays_and_the_links_do_not():
    body, closing = paragraphs(30, 300), paragraphs(1, 290)[0]  # less than a tenth of the whole
    html = f"<body><div>{''.join(f'<p>{t}</p>' for t in body)}</div><ul>{RELATED}</ul><div><p>{closing}</p></div></body>"
    assert html_text.main_text(html).split("\n") == [*body, closing]


def test_nested_marks_are_read_in_two_passes_and_deep_pages_in_linear_time():
    deep = "<div class='share'>" * 3_000 + f"<article><p>{LONG}</p></article>"
    calls = []
    reader = html_text.read
    html_text.read = lambda *a: calls.append(1) or reader(*a)
    try:
        assert html_text.main_text(deep) == LONG.strip()
    finally:
        html_text.read = reader
    assert len(calls) == 2

    def steps(n):
        page = html_text.read("<div>" * n + "x" + "</section>" * n)
        return len(page.kinds) + sum(map(len, page.at.values())) + len(page.lines)

    assert steps(40_000) < 2.1 * steps(20_000)
    assert html_text.main_text("<div>" * 30_000 + "x" + "</section>" * 30_000) == "x"


def brute_ratios(lines):
    """Smoothed ratios straight from the definition: a normalised Gaussian over lines at most two apart."""
    out = []
    for i in range(len(lines)):
        pairs = [(math.exp(-(i - j) ** 2 / 2), min(html_text.LINE_CHARS, n / max(1, tags)))
                 for j, (n, tags) in enumerate(lines) if abs(i - j) <= 2]
        out.append(sum(w * r for w, r in pairs) / sum(w for w, _ in pairs))
    return out


def test_without_an_article_the_lines_are_those_of_a_brute_force_over_ratios():
    rng = random.Random(5)
    for _ in range(60):
        chars = [rng.choice([3, 12, 60, 150, 400]) for _ in range(rng.randint(1, 14))]
        linked = [rng.random() < 0.4 for _ in chars]
        texts = [("x" * n)[:n] for n in chars]
        html = "".join(f"<p><a href=l>{t}</a></p>" if on else f"<p>{t}</p>" for t, on in zip(texts, linked))
        got = html_text.read(html).lines
        lines = [(0 if on else n, line.tags) for n, on, line in zip(chars, linked, got)]
        assert [line.tags for line in got if line.text] == [3 if on else 1 for on in linked]
        smoothed = brute_ratios(lines)
        assert html_text.smooth([min(200, n / tags) for n, tags in lines]) == pytest.approx(smoothed)
        threshold = sum(smoothed) / len(smoothed) / 2
        single = [min(200, n / tags) for n, tags in lines]
        content = [i for i, r in enumerate(smoothed) if r >= threshold or single[i] >= threshold]
        content = [i for i in content if not linked[i]] or content
        apart = [[content[0]]]
        for a, b in zip(content, content[1:]):
            gap = range(a + 1, b)
            far = len(gap) >= 3 and 2 * sum(lines[i][0] for i in gap) < sum(chars[i] for i in gap)
            apart = [*apart, [b]] if far else [*apart[:-1], [*apart[-1], b]]
        kept = [g for g in apart if any(single[i] >= threshold for i in g)] or apart
        dropped = {i for a, b in zip(kept, kept[1:]) for i in range(a[-1] + 1, b[0]) if linked[i]}
        assert html_text.main_text(html) == "\n".join(t for i, t in enumerate(texts) if i not in dropped)


def test_extraction_keeps_every_row(spark):
    rows = [(i, f"u{i}", h) for i, (h, _) in enumerate(CASES)]
    big = "<article>" + "<p>word</p>" * 30_000 + "</article>"
    rows += [(90, None, None), (None, "u", "<p>x"), (91, "u", big), (91, "u", big), (92, "u", "<div>" * 3_000 + "deep")]
    got = html_text.extract_text(pages(spark, rows, clashing=True), carry=("url",)).collect()
    assert len(got) == len(rows)
    by = {r["page_id"]: r["text"] for r in got}
    assert [by[i] for i in range(len(CASES))] == [t for _, t in CASES]
    assert by[90] == "" and by[None] == "x" and by[91] == "\n".join(["word"] * 30_000) and by[92] == "deep"
    assert html_text.extract_text(pages(spark, [])).count() == 0


def test_smoothing_keeps_the_mean_of_constant_lines():
    assert html_text.smooth([2.0] * 5) == pytest.approx([2.0] * 5)
    assert html_text.smooth([0, 0, 9, 0, 0])[2] > html_text.smooth([0, 0, 9, 0, 0])[1] > 0


def brute_url(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host):], maxsplit=1)[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for h, p, v in url_filter.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, v)
    return host, path, best


def test_urls_equal_brute_force(spark):
    rng = random.Random(4)
    parts = ["http://", "https://", "WWW.", "www.", "example", ".com", "com", ".net", "net", "/en/", "/es/", "/", "?", "#",
             "x", "://", "É", "\n", ":80", "@"]
    urls = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 9))) for _ in range(400)]
    urls += [None, "", "://", "http://", "http://com", "http://com/", "http://notexample.com/en/1", "http://example.com/en",
             "http://a.example.com/en/", "http://www.example.com/en/x", "http://a.www.example.com/en/x", "ftp://x.net/fr/?q",
             "http://h/" + "p" * 50_000]
    rows = [(i, u, None) for i, u in enumerate(urls)] + [(None, "http://x.net/es/", "h"), (0, urls[0], None)]
    got = url_filter.judge_urls(pages(spark, rows, clashing=True)).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["page_id"] is not None:
            host, path, rule = brute_url(urls[r["page_id"]])
            assert (r["host"], r["path"], r["rule"]) == (host, path, rule and rule[0]), urls[r["page_id"]]
            assert r["verdict"] == (rule[1] if rule else "block" if r["score"] >= 0.7 else "allow")
    assert url_filter.judge_urls(pages(spark, [])).count() == 0


def test_url_model_on_unseen_hosts():
    m = url_filter.train(url_filter.labelled_urls())
    bad = ["mega-casino-jackpot.example.org", "cheapviagra.example.net", "pokerwin.example.com"]
    good = ["gardenmuseum.example.org", "river-library.example.net", "citynews.example.com"]
    assert all(m.score(h, "/en/7") > 0.7 for h in bad) and all(m.score(h, "/en/7") < 0.5 for h in good)
    assert m.score("", "") < 0.7 and url_filter.train([]).score("a", "b") == 0.5


def archive_pages(rng):
    body = ["x" * 2_000, "y" * 999, "é" * 600, "<p>unique</p>"]
    rows = [(i, f"http://h/{i}", rng.choice(body) if i % 2 else f"<html>{i}{rng.random()}</html>" * rng.randint(1, 80))
            for i in range(0, 400, 3)]
    return rows + [(500, None, None), (501, "http://h/ü\r\nX: 1", ""), (None, "http://n", "x" * 2_000), (None, "http://m", "z" * 1_500),
                   (7, "http://h/7", "x" * 2_000), (502, "http://big", "b" * 3_000_000), (1_000_000, "u", "y" * 999),
                   (-5, "neg", "x" * 2_000), (600, "twin", "t" * 1_200), (600, "twin", "t" * 1_200)]


def expected_records(rows):
    last = {}
    for i, _, h in rows:
        if i is not None:
            last[h or ""] = max(last.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        ref = last.get(h or "") if i is not None and len(b) >= 1_000 and last[h or ""] != i else None
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if ref is not None else "response", ref))
    return sorted(out, key=str)


def test_warc_round_trip_rolls_and_repeats(spark):
    rows = archive_pages(random.Random(5))
    folders = [f"{shared_folder(spark)}/w" for _ in range(2)]
    for folder, parts in zip(folders, (1, 7)):
        warc.write_warc(pages(spark, rows, clashing=True).repartition(parts), folder, shard_bytes=50_000, file_bytes=4_000)
    got = warc.read_warc(spark, folders[0])
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    records = got.collect()
    assert sorted((tuple(r[c] for c in cols) for r in records), key=str) == expected_records(rows)
    texts = {i: h or "" for i, _, h in rows if i is not None}
    assert all(bytes(r["payload"]).decode() == texts[r["page_id"]] for r in records
               if r["record_type"] == "response" and r["page_id"] is not None)
    listing = [spark.read.parquet(f + "/_manifest").orderBy("file").collect() for f in folders]
    assert listing[0] == listing[1] and len(listing[0]) > 5  # the same files whatever the partitions
    path = warc.filesystem(folders[0])[1]
    names = sorted(n for n in os.listdir(path) if n.endswith(".warc.gz"))
    assert names == [r["file"] for r in listing[0]] and not os.path.exists(path + "/_temporary")
    for r in listing[0]:
        data = open(f"{path}/{r['file']}", "rb").read()
        assert (len(data), hashlib.sha1(data).hexdigest()) == (r["bytes"], r["sha1"])
    ids = [int(h["X-Page-ID"]) for n in names for h, _ in warc.records_of(folders[0], n) if "X-Page-ID" in h]
    assert ids == sorted(ids)
    heads = [h for n in names for h, _ in warc.records_of(folders[0], n)]
    assert all(uuid.UUID(h["WARC-Record-ID"][10:-1]) for h in heads)
    assert any(urllib.parse.unquote(h.get("WARC-Target-URI", "")).startswith("http://h/ü") for h in heads)


@pytest.mark.parametrize("ranges", [4_096, 3])
@pytest.mark.parametrize("ids", [[0, 2 ** 63 - 1], [-2 ** 63, 2 ** 63 - 1, 0, -1], "hashes", "outlier", "null"])
def test_warc_of_any_ids(spark, monkeypatch, ids, ranges):
    monkeypatch.setattr(warc, "MOST_RANGES", ranges)
    rng = random.Random(9)
    if ids == "hashes":
        ids = [rng.getrandbits(64) - 2 ** 63 for _ in range(200)]
    elif ids == "outlier":
        ids = [*range(400), 10 ** 15]
    elif ids == "null":
        ids = [None] * 300 + [1]
    rows = [(i, f"http://h/{k}", f"{k} " + "x" * (1_000 + k % 3)) for k, i in enumerate(ids)]
    rows += [(i, u, h) for i, u, h in rows[:2]] + [(ids[-1], "again", rows[0][2])]
    df = pages(spark, rows)
    folder = warc.write_warc(df, f"{shared_folder(spark)}/w", shard_bytes=20_000)
    got = warc.resolved(warc.read_warc(spark, folder))
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted((tuple(r[c] for c in cols) for r in got.collect()), key=str) == expected_records(rows)
    files = spark.read.parquet(folder + "/_manifest").collect()
    if len(rows) > 100 and ranges > 3:  # no shard holds most of the rows
        assert max(r["records"] for r in files) < 60
    with_id = [r for r in files if r["file"].startswith("part-000000")]
    assert with_id and len(files) >= min(len(rows) // 40, 3)


def test_a_revisit_without_its_response_is_an_error(spark):
    schema = "page_id long, record_type string, refers_to long, payload_bytes long, payload_digest string"
    rows = [(1, "response", None, 1_500, "aa"), (2, "revisit", 1, 7, "aa")]
    assert sorted(tuple(r) for r in warc.resolved(spark.createDataFrame(rows, schema)).collect()) == [
        (1, "response", None, 1_500, "aa"), (2, "revisit", 1, 1_500, "aa")]
    for bad in ((3, "revisit", 9, 7, "aa"), (3, "revisit", 1, 7, "bb")):
        with pytest.raises(Exception, match="refers to a response"):
            warc.resolved(spark.createDataFrame([*rows, bad], schema)).collect()


def test_warc_uncommitted_files_do_not_count_and_damage_is_found(spark):
    folder = warc.write_warc(pages(spark, [(1, "u", "a" * 1_500), (2, "u", "b")]), f"{shared_folder(spark)}/w")
    path = warc.filesystem(folder)[1]
    with open(f"{path}/part-999999-0000.warc.gz", "wb") as f:
        f.write(b"left by a lost task")
    assert warc.read_warc(spark, folder).count() == 2
    name = next(n for n in sorted(os.listdir(path)) if n.endswith(".warc.gz"))
    data = open(f"{path}/{name}", "rb").read()
    with open(f"{path}/{name}", "wb") as f:
        f.write(data[:len(data) // 2])
    with pytest.raises(Exception, match="record|ends inside|Error"):
        warc.read_warc(spark, folder).collect()


def test_warc_of_an_empty_table(spark):
    folder = warc.write_warc(pages(spark, []), f"{shared_folder(spark)}/w")
    assert warc.read_warc(spark, folder).count() == 0
