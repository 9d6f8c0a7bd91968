"""HTML extraction: brute-force suffix coverage, markup cases, hot hosts."""

import html
import random
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from shelfline.llm import htmltext
from tests.llm.conftest import SF0001

SCHEMA = "page_id long, url string, html string, host long, text long, chunk long"


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, 0, 0, 0) for r in rows], SCHEMA)


def test_covered_equals_brute_force():
    rng = random.Random(2)
    for _ in range(60):
        page = np.sort(np.array([rng.randint(0, 5) for _ in range(rng.randint(0, 120))], np.int64))
        tokens = np.array([rng.randint(0, 2) for _ in page], np.int64)
        for least in (1, 3, 6):
            seen = {}
            for i in range(len(page) - least + 1):
                if page[i] == page[i + least - 1]:
                    seen.setdefault(tuple(tokens[i:i + least]), []).append(i)
            want = np.zeros(len(page), bool)
            for at in seen.values():
                if len({page[i] for i in at}) > 1:
                    for i in at:
                        want[i:i + least] = True
            assert (htmltext.covered(tokens, page, least) == want).all()


@pytest.mark.parametrize("page, text", [
    (None, []), ("", []), ("plain  text &amp; more", ["plain text & more"]),
    ("<nav>menu<ul><li>x</ul></nav><article><h1>T</h1><p>a <b>b</b><br>c<p>d</article><footer>f", ["T", "a b", "c", "d"]),
    ("<div class='ad'><article><p>kept", ["kept"]),
    ("<article>a<script>if (a < b) '</p>'</script>b<!-- c > --><aside>no</aside><div id=comments>no<p>no</div>d</article>", ["ab".replace("ab", "a"), "b", "d"]),
    ("<main><form>f</form>x &lt;y&gt; &#233;&eacute;</main><div class='cookie-notice'>n</div>", ["x <y> éé"]),
    ("<article><header><h1>head</h1></header><p>p</p><section class='reader-comments'><p>c</p></section></article>", ["head", "p"]),
    ("<article>end &am", ["end &am"]), ("<article><p>cut <b", ["cut"]), ("<article>1<hr>2</article><sidebar class=sidebar>s</sidebar>", ["1", "2"]),
])
def test_blocks(page, text):
    assert [t for k, t in htmltext.blocks(page) if k != htmltext.OUT] == text


def test_loose_blocks_lose_what_the_host_repeats(spark):
    menu = "home news sport weather travel about contact"
    rows = [(i, f"http://h.example/{i}", f"<div>{menu} page{i}</div><div>story {' '.join(f'w{i}x{j}' for j in range(9))}</div>") for i in range(6)]
    rows += [(100, "http://other.example/", f"<div>{menu}</div>"), (None, None, None), (None, None, "<p>one</p>"),
             (7, "http://h.example/7", f"<article>{menu}</article>")]
    got = {r.page_id: r.text for r in htmltext.report(pages_of(spark, rows)).collect() if r.page_id is not None}
    for i in range(6):
        assert got[i] == f"page{i}\nstory " + " ".join(f"w{i}x{j}" for j in range(9))
    assert got[100] == menu and got[7] == menu


def test_empty_table_and_columns(spark):
    out = htmltext.report(pages_of(spark, []))
    assert out.collect() == [] and out.columns == ["page_id", "url", "text", "n_chars"]


def test_pages_have_their_article(spark):
    pages = spark.read.parquet(f"{SF0001}/pages.parquet")
    got = {r.page_id: r for r in htmltext.report(pages).collect()}
    for r in pages.collect():
        body = re.search(r"<article>(.*?)</article>", r.html, re.DOTALL)[1]
        want = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:h1|p|br)\b[^>]*>", body)]
        assert got[r.page_id].text == "\n".join(b for b in want if b)
        assert got[r.page_id].n_chars == len(got[r.page_id].text)


def test_a_large_host_is_judged_whole(spark):
    # a notice that stands on a few pages of a host of many, wherever they lie
    notice = "all prices are without tax and postage"
    rows = [(i, f"http://big.example/{i}", "<div>" + " ".join(f"p{i}w{j}" for j in range(20)) + "</div>" + (f"<div>{notice}</div>" if i % 450 == 0 else ""))
            for i in range(4500)]
    got = {r.page_id: r.text for r in htmltext.report(pages_of(spark, rows)).collect()}
    assert len(got) == 4500
    for i in range(4500):
        assert got[i] == " ".join(f"p{i}w{j}" for j in range(20))


def test_windows_equal_covered():
    rng = random.Random(5)
    for _ in range(40):
        pages = [[" ".join(rng.choice("ab") for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(1, 3))] for _ in range(3)]
        words = [w for p in pages for t in p for w in t.split(" ")]
        page = np.array([i for i, p in enumerate(pages) for t in p for _ in t.split(" ")])
        gone = htmltext.covered(np.array([ord(w) for w in words]), page)
        seen = [set(htmltext._windows(p).tolist()) for p in pages]
        for i, p in enumerate(pages):
            twice = np.array([w for w in seen[i] if sum(w in s for s in seen) > 1], np.int64)
            assert htmltext._gone(p, twice).tolist() == gone[page == i].tolist()


def test_copies_and_common_phrases_keep_their_text(spark):
    def words(i, n):
        return " ".join(f"a{i}b{j}" for j in range(n))
    story = [words(900, 40), words(901, 30)]
    whole = "".join(f"<div>{x}</div>" for x in story)
    rows = [(1, "http://h.example/1", whole), (2, "http://h.example/2", whole),                      # two copies
            (3, "http://h.example/3", f"<div>{words(3, 5)}</div>{whole}"), (4, "http://h.example/4", f"<div>{words(4, 7)}</div>{whole}")]
    phrase = "in the middle of the year"
    rows += [(i, f"http://h.example/{i}", f"<div>{words(i, 9)} {phrase} {words(-i, 9)}</div>") for i in range(10, 30)]
    rows += [(40 + i, "http://two.example/", f"<p>{words(77, 12)}</p>") for i in range(2)]
    notice = "prices are without tax and postage"                                                    # a block of its own on two pages
    rows += [(50 + i, f"http://n.example/{i}", f"<div>{words(50 + i, 20)}</div><div>{notice}</div>") for i in range(2)]
    got = {r.page_id: r.text for r in htmltext.report(pages_of(spark, rows)).collect()}
    assert got[1] == got[2] == "\n".join(story)
    assert got[3] == "\n".join([words(3, 5), *story]) and got[4] == "\n".join([words(4, 7), *story])
    for i in range(10, 30):
        assert got[i] == f"{words(i, 9)} {phrase} {words(-i, 9)}"
    assert got[40] == got[41] == words(77, 12)
    assert got[50] == words(50, 20) and got[51] == words(51, 20)


@pytest.mark.parametrize("page, text", [
    ("<article>a<svg class='icon' /><p>b</article>", ["a", "b"]), ("<math/><iframe/><article>a</article>", ["a"]),
    ("<datalist><option value=a></datalist><article>a</article>", ["a"]),
    ("<article>a<select><option>1<option>2</select>b<datalist><option value=a></datalist>c</article>", ["a", "b", "c"]),
    ("<article>a<svg><title>t</title><path d='x'/></svg>b</article>", ["a", "b"]),
    ("<article>a<object>x<object>y</object>z</object>b<template><p>no</template>c</article>", ["a", "b", "c"]),
    ("<title>never closed <article>a</article>", ["a"]), ("<script>x = 1; <main>a</main>", ["a"]), ("<script>x = 1; '<p>'", []),
    ("<iframe src=x><article>a</article>", ["a"]), ("<article>a<svg>x</article>", ["a"]),
    ("<article>a<style>p{} </article><article>b</article>", ["a", "b"]),
])
def test_short_and_unclosed_elements(page, text):
    assert [t for k, t in htmltext.blocks(page) if k != htmltext.OUT] == text


@pytest.mark.parametrize("page, text", [
    ("<body class='post no-sidebar'><p>story</p></body>", ["story"]), ("<html id=header><body class=widget>x</body>", ["x"]),
    ("<article><p class='related-work'>a<div class='article-share-story'>b</div><div id='header-image-story'>c</div>"
     "<section id='comments-on-the-law'>d</section><figure><figcaption>e</figcaption></figure></article>", ["a", "b", "c", "d", "e"]),
    ("<article>a<div data-id='menu'>b</div><div data-class=ad>c</div></article>", ["a", "b", "c"]),
    ("<article>a<p class=x\">b</p><p title='5 > 4'>c</p><a href=\"/?q='x'\">d</a></article>", ["a", "b", "c", "d"]),
    ("<article>a</article><div class=comments><article>reader</article></div>", ["a"]),
    ("<nav><article>teaser</article></nav><article>a</article><section class='related-posts'><article>t</article></section>", ["a"]),
    ("<article>a<div class='footer-links'>x</div><div class='col cookie-notice'>y</div><ul class='site-nav'>z</ul></article>", ["a"]),
    ("<div class=widget><article>only</article></div>", ["only"]), ("<div class='has-sidebar'><p>a</p><div class=sidebar>b</div></div>", ["a"]),
    ("<div class=ad>x<article>kept", ["kept"]), ("<div class=ad><p>x<article>kept</article><p>y", ["kept", "y"]),
])
def test_names_mark_only_what_they_name(page, text):
    assert [t for k, t in htmltext.blocks(page) if k != htmltext.OUT] == text


def test_a_very_long_page(spark):
    body = "".join(f"<p>word{i} and more</p>" for i in range(60_000))
    rows = [(1, "http://l.example/", f"<nav>{'<a>x</a>' * 5000}</nav><article>{body}</article><footer>f</footer>"), (2, "http://l.example/", "<" * 200_000)]
    got = {r.page_id: r for r in htmltext.report(pages_of(spark, rows)).collect()}
    assert got[1].text == "\n".join(f"word{i} and more" for i in range(60_000)) and got[1].n_chars == len(got[1].text)
    assert got[2].text == "<" * 200_000


def test_shards_add_up_to_the_host():
    """Pages of two hosts, in one suffix array or in many: the same substrings on
    the same numbers of pages as counted one by one."""
    rng = random.Random(8)
    for _ in range(30):
        hosts = [rng.choice("xy") for _ in range(9)]
        streams = [[" ".join(rng.choice("abc") for _ in range(rng.randint(1, 25))) for _ in range(rng.randint(0, 2))] for _ in hosts]
        want = {}
        for h, texts in zip(hosts, streams):
            for w in set(htmltext._windows(texts).tolist()):
                want[h, w] = want.get((h, w), 0) + 1
        for cut in (9, 4, 1):
            got = {}
            for i in range(0, 9, cut):
                page, window, pages = htmltext.shard(hosts[i:i + cut], streams[i:i + cut])
                for p, w, n in zip(page.tolist(), window.tolist(), pages.tolist()):
                    got[hosts[i + p], w] = got.get((hosts[i + p], w), 0) + n
            assert got == want


def test_a_host_in_many_shards(spark):
    menu = "home news sport weather travel about contact"
    rows = [(i, "http://h.example/", f"<div>{menu} page{i}</div><div>" + " ".join(f"w{i}x{j}" for j in range(30)) + "</div>") for i in range(40)]
    rows += [(100 + i, "http://h.example/", rows[0][2]) for i in range(20)]
    got = {r.page_id: r.text for r in htmltext.extract(pages_of(spark, rows).repartition(5), shard_tokens=60).collect()}
    for i in range(40):
        assert got[i] == f"page{i}\n" + " ".join(f"w{i}x{j}" for j in range(30))
    assert all(got[100 + i] == got[0] for i in range(20))


def test_articles_lose_copies_of_the_template_of_their_host(spark):
    # no page has a loose block: the host's menus and notices are found all the same
    notice = "sign up here for the weekly letter of this site"

    def words(i, n=30):
        return " ".join(f"a{i}b{j}" for j in range(n))
    shared = words("shared", 12)            # stands in every article, outside none
    rows = [(i, f"http://h.example/{i}", f"<nav>{notice}</nav><article><p>{words(i)}</p><p>{notice}</p><p>{shared}</p></article>") for i in range(8)]
    rows += [(20, "http://h.example/20", f"<article><p>{notice}</p></article>"),                         # nothing else: kept
             (21, "http://h.example/21", f"<article><p>{words(21)}</p><p>{notice} it says</p></article>"),  # more than the template
             (22, "http://h.example/22", f"<div>{words(22)}</div><article><p>{words(-22)}</p><p>{notice}</p></article>"),
             (30, "http://other.example/", f"<article><p>{words(30)}</p><p>{notice}</p></article>")]      # another host
    got = {r.page_id: r.text for r in htmltext.report(pages_of(spark, rows)).collect()}
    assert len(got) == len(rows)
    for i in range(8):
        assert got[i] == f"{words(i)}\n{shared}"
    assert got[20] == notice and got[21] == f"{words(21)}\n{notice} it says"
    assert got[22] == f"{words(22)}\n{words(-22)}" and got[30] == f"{words(30)}\n{notice}"


def test_articles_are_in_the_suffix_arrays():
    """Substrings of whole pages, in one suffix array or in many, in one round or
    more, packed and added up: as counted one by one."""
    rng = random.Random(11)
    bits = 8
    for _ in range(10):
        hosts = [rng.choice("xy") for _ in range(9)]
        outer, inner = ([[" ".join(rng.choice("abc") for _ in range(rng.randint(1, 20))) for _ in range(rng.randint(0, 2))] for _ in hosts] for _ in range(2))
        want = {}
        for h, o, a in zip(hosts, outer, inner):
            salt = int(htmltext._salt([h]).view(np.int64)[0])
            out, own = set(htmltext._windows(o).tolist()), set(htmltext._windows(a).tolist())
            for w in out | own:
                pages, outside = want.get(w ^ salt, (0, 0))
                want[w ^ salt] = pages + 1, outside + (w in out)
        for cut, rounds in ((9, 1), (4, 3), (1, 2)):
            got = {}
            for r in range(rounds):
                rows = []
                for i in range(0, 9, cut):
                    page, window, pages, outside = htmltext.shard(hosts[i:i + cut], outer[i:i + cut], inner[i:i + cut], (r, rounds, bits))
                    rows.append(htmltext.packed(window.view(np.uint64) ^ htmltext._salt(hosts[i:i + cut])[page], pages, outside, bits))
                rows = pa.Table.from_batches(rows)
                for b in set(rows["bucket"].to_pylist()):
                    t = htmltext.added_up(rows.filter(pc.equal(rows["bucket"], b)), bits)
                    got |= {w: (p, o) for w, p, o in zip(*(t[c].to_pylist() for c in ("window", "pages", "outside")))}
            assert got == {w: x for w, x in want.items() if x[0] > 1}


@pytest.mark.parametrize("rounds", [1, 3])
def test_loose_copies_of_another_article_are_cut(spark, monkeypatch, rounds):
    monkeypatch.setattr(htmltext, "ROUND_TOKENS", 1 << 22 if rounds == 1 else 1)

    def words(i, n=30):
        return " ".join(f"a{i}b{j}" for j in range(n))
    rows = [(i, f"http://h.example/{i}", f"<article><p>{words(i)}</p><p>{words(-i)}</p></article>") for i in range(1, 5)]
    rows += [(10, "http://h.example/10", f"<div>{words(10)}</div><div>{words(1, 18)}</div>"),     # a teaser of page 1
             (11, "http://other.example/", f"<div>{words(11)}</div><div>{words(1, 18)}</div>"),    # whose article another host has
             (12, "http://h.example/12", f"<div>{words(12, 9)}</div><div>{words(2)}</div>")]        # mostly a copy: kept
    got = {r.page_id: r.text for r in htmltext.extract(pages_of(spark, rows), shard_tokens=50).collect()}
    assert len(got) == len(rows)
    for i in range(1, 5):
        assert got[i] == f"{words(i)}\n{words(-i)}"
    assert got[10] == words(10) and got[11] == f"{words(11)}\n{words(1, 18)}" and got[12] == f"{words(12, 9)}\n{words(2)}"


def test_pages_of_one_text_show_all_their_menus(spark):
    # two pages come with one menu and with another: neither is lost, and each counts once for a page
    def words(i, n=30):
        return " ".join(f"a{i}b{j}" for j in range(n))
    menus = "home news sport weather travel about contact", "shop cart checkout returns help stores jobs"
    rare = "printed on the first of this month"
    rows = [(10 * k + i, "http://h.example/", f"<nav>{m}</nav><article><p>{words(10 * k + i)}</p></article>") for k, m in enumerate(menus) for i in range(3)]
    rows += [(100 + 10 * k + i, "http://h.example/", f"<nav>{m}</nav><article><p>{words(i + 50)}</p></article>") for k, m in enumerate(menus) for i in range(2)]
    rows += [(200 + i, "http://h.example/", f"<nav>{rare}</nav><aside>{i}</aside><article><p>{words(60)}</p></article>") for i in range(9)]
    rows += [(300, "http://h.example/", f"<article><p>{words(300)}</p>" + "".join(f"<p>{x}</p>" for x in (*menus, rare)) + "</article>")]
    got = {r.page_id: r.text for r in htmltext.report(pages_of(spark, rows)).collect()}
    assert len(got) == len(rows) and got[300] == f"{words(300)}\n{rare}"
    assert all(got[200 + i] == words(60) for i in range(9)) and got[100] == got[110] == words(50)
