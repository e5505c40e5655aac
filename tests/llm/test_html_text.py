from corvane.llm.html_text import Page, main_text

P = "A paragraph of some length, so that the container has text to score. " * 3


def page(body):
    return f"<!DOCTYPE html><html><head><title>t</title><script>var a = '</p>';</script></head><body>{body}</body></html>"


def text(source):
    return Page(source).extract([])


def test_what_stands_beside_an_article():
    body = f'<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></ul></nav><div class="cookie-notice">Cookies</div><div class="layout"><main><article><h1>Title &amp; more</h1><p>{P}<p>Second &eacute;&nbsp;<b>bold</b><br>line<div class="ad">Buy</div><ul><li>one<li>two</ul><form><p>Mail</form></article><section class="comments"><p>{P}</section></main><aside>{P}</aside></div><footer>&copy;</footer>'
    assert text(page(body)) == "\n".join(["Title & more", P.strip(), "Second é bold line", "one", "two"])


def test_blocks_and_white_space():
    assert text(page(f"<article><p>a\n  b\t c</p>tail<p> </p><table><tr><td>x<td>y</table><p>{P}</article>")) == f"a b c\ntail\nx\ny\n{P.strip()}"


def test_broken_markup():
    assert text("<article><p>cut &am") == "cut &am"
    assert text("<article><p>cut <b") == "cut"
    assert text("<article><p>1 < 2 and 3 > 2<!-- open") == "1 < 2 and 3 > 2"
    assert text("<p>no container") == "no container"
    assert text("") == text("<html>") == text("<script>x") == ""
    assert text("<div>" * 3000 + "deep") == "deep"


def test_host_consensus(spark):
    good = page(f"<div class='wrap'><div class='story'><p>{P}</div><div class='extra'><p>{P[:30]}</div></div>")
    odd = page(f"<div class='wrap'><div class='story'><p>{P[:70]}</div><div class='extra'><p>{P * 4}</div></div>")
    rows = [(i, f"https://u@Host.example:80/{i}", good, 1) for i in range(5)] + [(9, "http://host.example/x?y", odd, 1), (10, None, None, 1), (11, "nonsense", "", 1), (11, "nonsense", "", 1), (None, "http://other/", good, 1)]
    got = main_text(spark.createDataFrame(rows, "page_id long, url string, html string, text int")).collect()
    by = {r["page_id"]: r for r in got}
    assert len(got) == 10
    assert by[9]["text"] == P[:70].strip()
    assert by[0]["text"] == P.strip() and by[10]["text"] == "" and by[None]["text"] == P.strip()
    assert all(r["n_chars"] == len(r["text"]) for r in got)


def test_empty_table(spark):
    assert main_text(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_text_beside_the_main_container_of_an_article():
    long = f"<p>{P * 3}</p>"
    body = (P * 3).strip()
    assert text(page(f"<article><h1>Title</h1><div class='entry'>{long}</div></article>")) == f"Title\n{body}"
    assert text(page(f"<article><h1><a href='/x'>Title</a></h1><div class='entry'>{long}</div></article>")) == f"Title\n{body}"
    assert text(page(f"<main><section class='lead'><p>Lead.</p></section><div class='entry'>{long}</div><section><p>End.</p></section></main>")) == f"Lead.\n{body}\nEnd."
    assert text(page(f"<article><p>Before.</p><table><tr><td>{P * 3}</td></tr></table><p>After.</p></article>")) == f"Before.\n{body}\nAfter."
    assert text(page(f"<div class='post'><h1>Title</h1><div class='entry'>{long}</div></div>")) == f"Title\n{body}"
    assert text(page(f"<article><div class='entry'>{long}</div><div class='list'><a href='/a'>other</a></div></article>")) == body


def test_losses_of_levels_do_not_add_up():
    at = f"<p>{'w ' * 400}</p>"
    for k, n in enumerate((100, 125, 156)):
        at = f"<div class='in{k}'>{at}</div><div class='by{k}'><p>{f'b{k} ' * (n * 2 // 3)}</p></div>"
    got = text(page(f"<div class='wrap'>{at}</div>"))
    assert "b0 b0" in got and "b1 b1" in got


def test_votes_for_a_narrow_container_do_not_cut_an_article(spark):
    narrow = page(f"<article><div class='entry'><p>{P}</p></div></article>")
    wide = page(f"<article><h1>Title</h1><div class='entry'><p>{P}</p></div><section><p>End.</p></section></article>")
    rows = [(i, f"http://h.example/{i}", narrow) for i in range(5)] + [(9, "http://h.example/9", wide)]
    got = {r["page_id"]: r["text"] for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[0] == P.strip() and got[9] == f"Title\n{P.strip()}\nEnd."


def test_planted_articles_on_generated_pages(spark):
    """Pages made from a tree: what its article says is known, whatever stands around and inside it."""
    import random

    rng = random.Random(10)
    words = lambda n: " ".join(rng.choice(["alpha", "beta", "gamma", "d&eacute;j&agrave;", "x &lt; y", "two\n lines"]) for _ in range(n))
    plain = lambda t: " ".join(t.replace("&eacute;", "é").replace("&agrave;", "à").replace("&lt;", "<").split())
    rows, want = [], {}
    for i in range(120):
        said, inner = [], ""
        for k in range(rng.randrange(3, 9)):
            t = words(rng.randrange(15, 60))
            kind = rng.randrange(6)
            said += [plain(t)] if kind < 5 else []
            inner += [f"<p>{t}</p>", f"<h2>{t}</h2>", f"<p><b>{t}</b>", f"<blockquote>{t}</blockquote>", f"<ul><li>{t}</ul>", f"<div class='advert'>{t}</div>"][kind]
        said.append("The end of it all, with enough words to be scored.")
        inner += "<p>The end of it all, with enough words to be scored.</p>"
        host, depth = i % 3, i % 5
        around = lambda x: f"<header><p>{words(9)}</p></header><nav><a href='/'>{words(5)}</a></nav>{x}<aside><p>{words(30)}</p></aside><div class='comments'><p>{words(200)}</p></div><footer>{words(9)}</footer>"
        body = [f"<article>{inner}</article>", f"<main><article>{inner}</article></main>", f"<div class='page-{i}'><div class='content'>{inner}</div></div>"][host]
        rows.append((i, f"https://host{host}.example/{i}", page(around("<div>" * depth + body + "</div>" * depth))))
        want[i] = "\n".join(said)
    got = {r["page_id"]: r["text"] for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == want


def test_work_is_linear_in_bad_markup():
    import time

    n = 40_000
    for source in ("<div>" * n + "deep", "<b>x</i>" * n, "<i><div>" + "<b>x</i>" * n, "<p>" + "<b>" * n + "x<hr>" * n, "<dt><dl>" + "<div>" * n + "<dt>x</dt>" * n, "<blockquote>a" * n, "<p><span class='c'>x" * n, "</div></p></b>" * n):
        began = time.process_time()
        Page(source).extract(["html/body/div.a", "div/div"])
        assert time.process_time() - began < 8, source[:40]
