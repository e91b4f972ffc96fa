import time

import pytest

from taxaflow.llm.html_tree import blocks, parse
from taxaflow.llm.wrappers import decided, extract_main_text, fold, load, main_text, merge, wrapper_of


def page(title, paragraphs, main='<div id="content">', end="</div>", extra=""):
    body = "".join(f"<p>{p}</p>" for p in paragraphs)
    return (
        f"<!DOCTYPE html><html><head><title>{title}</title><script>if (a</b>) '</p>'</script></head><body><div class='site-header'>Logo</div>"
        f"<nav><ul><li>Home</li><li>News</li></ul></nav><div class=cookie-notice>We use cookies</div>{main}<h1>{title}</h1>{body}{extra}"
        f'<section id="comments"><p>First!</p></section>{end}<aside>Latest</aside><footer>&copy; us</footer></body></html>'
    )


@pytest.mark.parametrize("main, end", [("<article>", "</article>"), ("<div id='content'>", "</div>"), ("<main><section>", "</section></main>"), ("<table><tr><td>", "</td></tr></table>")])
def test_hosts_and_edges(spark, main, end):
    rows = [(i, f"https://Host{i % 2}.org/{i}", page(f"T {i}", [f"one {i} &amp; <b>bo</b>ld<br>x", "  same\n text " * (i + 1)], main, end, "<ul><li>a<li>b</ul>" if i % 3 else "")) for i in range(12)]
    rows += [(100, None, None), (101, "no host", ""), (102, "http://single.net", page("S", ["only"], main, end)), (None, "http://single.net", "bare &lt;text"), (0, rows[0][1], rows[0][2])]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, host string, path int").repartition(5)
    got = {(r.page_id, r.text): r.n_chars for r in extract_main_text(frame).collect()}
    want = {(i, "\n\n".join([f"T {i}", f"one {i} & bold x", " ".join(["same text"] * (i + 1)), *(["a", "b"] if i % 3 else [])])) for i in range(12)}
    want |= {(100, ""), (101, ""), (102, "S\n\nonly"), (None, "bare <text")}
    assert set(got) == want
    assert all(n == len(t) for (_, t), n in got.items())


def test_empty(spark):
    assert extract_main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def host(pages):
    whole = None
    for p in pages:
        w = wrapper_of(parse(p))
        whole = w if whole is None else merge(whole, w)
    return whole


def test_wrapper_has_slots_options_and_repeats():
    a, b = "<div><h1>A</h1><p>x</p><p>y</p><hr></div>", "<div><h1>B</h1><p>z</p></div>"
    (div,) = host([a, b]).parts
    h1, p, hr = div.parts
    assert (h1.parts[0].text, h1.parts[0].chars) == (None, 2)
    assert p.repeated and not p.optional
    assert hr.optional
    assert [x.key for x in host([b, a]).parts[0].parts] == [x.key for x in div.parts]
    (dl,) = wrapper_of(parse("<dl>" + "".join(f"<dt>{i}<dd>v{i}" for i in range(5)) + "</dl>")).parts
    assert [x.key for x in dl.parts] == ["(dt dd)"]
    assert fold([]) == []
    assert load(div.dump()).dump() == div.dump()


def test_groups_of_any_length_and_turns():
    turn = "".join(f"<x-{chr(97 + i)}>t</x-{chr(97 + i)}>" for i in range(12))
    (group,) = wrapper_of(parse(turn * 3)).parts
    assert len(group.parts) == 12 and group.is_group
    (one,) = host([turn * 3, turn]).parts  # a single turn aligns with the group
    assert [x.key for x in one.parts] == [x.key for x in group.parts]
    many = "".join(f"<x-{chr(97 + i * i % 23)}>t</x-{chr(97 + i * i % 23)}><hr>" * (1 + i % 3) for i in range(400))
    (star,) = wrapper_of(parse(many)).parts
    assert all(x.optional for x in star.parts)
    assert main_text("<article>" + many + "</article>").count("t") == many.count("t</")


def neutral(i, title, paragraphs):
    """No tag or class says anything, and what stands around articles is longer than they are."""
    menu = "".join(f'<div><a href="/{j}">topic {j} of this very site</a></div>' for j in range(30 + i % 3))
    around = "<div><p>" + "We are the best paper of this town and have been for years. " * 9 + "</p></div>"
    own = "".join(f"<p>{p}</p>" for p in paragraphs)
    return f"<html><body><div>{menu}</div><div>Offer number {i}</div><div><h1>{title}</h1>{own}</div>{around}<div>&copy; {i}</div></body></html>"


def test_names_without_meaning():
    articles = [(f"T {i}", [f"{i} once {j} upon a time there was" for j in range(2 + i % 4)]) for i in range(20)]
    pages = [neutral(i, *a) for i, a in enumerate(articles)]
    wrapper = decided(host(pages), len(pages))
    assert [main_text(p, wrapper) for p in pages] == ["\n\n".join([t, *ps]) for t, ps in articles]
    assert any(main_text(p) != "\n\n".join([t, *ps]) for p, (t, ps) in zip(pages, articles))  # a page alone doesn't tell


def test_what_a_host_repeats_is_left_out():
    pages = [f"<div class=post><div><p>Read our magazine every week!</p></div><h1>T {i}</h1><p>text {i} with words</p><div><p>More from us, for you.</p></div></div>" for i in range(4)]
    wrapper = decided(host(pages), 4)
    assert [main_text(p, wrapper) for p in pages] == [f"T {i}\n\ntext {i} with words" for i in range(4)]
    copies = decided(host(pages[:1] * 4), 4)  # pages that are all alike tell nothing
    assert main_text(pages[0], copies).count("\n\n") == 3


@pytest.mark.parametrize(
    "html, text",
    [
        ("<form><nav><p>Home of all</p></nav><h1>T</h1><p>one</p><p>two</p><select><option>o</select></form>", "T\n\none\n\ntwo"),
        ('<article><h1 class="article-header">T</h1><p class="notice-of-race">n</p><div class="related-work">r</div><div class="related-posts">x</div><p>b</p></article>', "T\n\nn\n\nr\n\nb"),
        ("<div class=post><h1>Title</h1><p class=lead>lead</p><div class=body><p>a</p><p>a very long body of the text</p></div></div><footer>f</footer>", "Title\n\nlead\n\na\n\na very long body of the text"),
        ("<article></article><nav>x</nav><form>search here</form>", ""),
        ("<div id=comments><p>only readers</p></div>", ""),
        ('<p title="unbalanced>some</p><p title="x">more</p><p data-x="<b>q</b>">z</p><p title="a > b">w</p>', "some\n\nmore\n\nz\n\nw"),
        ("a < b &lt; c", "a < b < c"),
    ],
)
def test_parts_of_articles(html, text):
    assert main_text(html) == text


def test_hostile_pages_take_linear_time():
    n = 200_000
    kinds = "".join(f'<div class="c{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}">x</div>' for i in range(2_500)) + "<p>y</p>" * 10_000
    for page_ in ("<a " * (n // 3) + '"', '<a b="' * (n // 6), "<div>" * 20_000 + "</span></p></b>" * 9_000, "<li/>" * 20_000, "<div>x " * 20_000, kinds, "<" * n, "<ul><li>" * 10_000, "<p " + "= " * n):
        began = time.process_time()
        main_text(page_)
        assert time.process_time() - began < 6


def test_broken_and_long_pages():
    assert main_text("<article><p>a<p>b", None) == "a\n\nb"
    assert main_text("<p" * 10, None) == ""
    assert main_text("text <!-- never closed", None) == "text"
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    assert blocks(parse(deep)) == ["deep"]
    assert main_text(deep, None) == "deep"
    assert main_text("<article>" + "<p>word</p>" * 20_000 + "</article>").count("word") == 20_000


def test_state_classes_drop_nothing():
    for name in ("content has-sidebar", "no-comments", "with-ads", "without_banner"):
        assert main_text(f'<div class="{name}"><p>a</p><p>b</p></div>', None) == "a\n\nb"
    assert main_text('<div class="sidebar"><p>a</p></div><p>b</p>', None) == "b"


@pytest.mark.parametrize("n", [2, 3, 30])
@pytest.mark.parametrize("box", ["article", "div id=main"])
def test_quotes_stay_however_many_pages_repeat_them(n, box):
    """Paragraphs between an article's variable texts stay, those around them and repeated boxes are the host's own."""
    quote = "<blockquote>To be, or not to be</blockquote><pre>x = 1</pre><p>as they say,</p>"
    page_ = f"<body><{box}><p>Welcome to our pages</p><h1>T {{i}}</h1><p>first {{i}} words</p>{quote}<div><p>Join our readers today</p></div><ul><li>item {{i}}</ul><p>Thanks for reading</p></{box.split()[0]}></body>"
    pages = [page_.format(i=i) for i in range(n)]
    wrapper = decided(host(pages), n)
    assert [main_text(p, wrapper) for p in pages] == [f"T {i}\n\nfirst {i} words\n\nTo be, or not to be\n\nx = 1\n\nas they say,\n\nitem {i}" for i in range(n)]


def test_wrappers_of_many_tasks_are_merged_in_groups(spark):
    pages = [neutral(i, f"T {i}", [f"{i} once {j} upon a time there was" for j in range(2 + i % 4)]) for i in range(40)]
    frame = spark.createDataFrame([(i, "https://one.org/x", p) for i, p in enumerate(pages)], "page_id long, url string, html string").repartition(13)
    got = {r.page_id: r.text for r in extract_main_text(frame).collect()}
    assert got == {i: "\n\n".join([f"T {i}", *(f"{i} once {j} upon a time there was" for j in range(2 + i % 4))]) for i in range(40)}
