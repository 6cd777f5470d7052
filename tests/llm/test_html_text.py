import random
import time

from fathomline.llm.html_text import extract_main_text, main_text

FILLER = "This sentence stands for the many words that an article holds."


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a='</p>';</script></head><body>{body}</body></html>"


def test_article_among_boilerplate():
    body = (
        "<nav><ul><li><a href=/a>Home</a></li></ul></nav><header><p>Site name and slogan</p></header><div class='cookie-notice'>We use cookies</div>"
        f"<div id=content><h1>Head &amp; line</h1><p>{FILLER}<p>Second&nbsp;<b>bold</b>\n  <a href='x>y'>link</a>ed<br>line<ul><li>one<li>two</ul><div class='ad banner'>Buy</div><p>End &#8364;&copy 1 &lt;b&gt;</div>"
        f"<div class=comments><p>{FILLER} {FILLER}</p></div><aside>{FILLER}</aside><form>Search <input></form><footer>{FILLER}</footer>"
    )
    assert main_text(page(body)) == f"Head & line\n{FILLER}\nSecond bold linked line\none\ntwo\nEnd €© 1 <b>"


def test_article_in_parts_and_link_lists():
    links = "".join(f"<li><a href=/{k}>Some linked story headline {k}</a></li>" for k in range(12))
    body = f"<div><div><ul>{links}</ul></div><div><p>{FILLER}</p><p>{FILLER} One.</p></div></div>"
    assert main_text(page(body)) == f"{FILLER}\n{FILLER} One."


def test_broken_and_empty():
    assert main_text(None) == main_text("") == main_text("<html><body></body>") == main_text("<script>x") == ""
    assert main_text("no markup   at\nall") == "no markup at all"
    assert main_text("<p>cut off <a href='") == "cut off"
    assert main_text("<div>" * 3000 + "deep") == "deep"
    assert main_text("a < b && c > d <3") == "a < b && c > d <3"
    assert main_text("<p>x</p>" * 20000).count("\n") == 19999


def test_pages_with_odd_frames_give_the_article():
    text = f"{FILLER} {FILLER}"
    assert main_text(f"<html><head><title>t</title><body><p>{text}</p></body></html>") == text
    assert main_text(f"<html><head><meta charset=x><p>{text}</p>") == text
    assert main_text(page(f"<form method=post><nav>Menu</nav><div><p>{text}</p><p>{FILLER}</p><input name=a><label>L</label></div></form>")) == f"{text}\n{FILLER}"
    assert main_text(page(f"<div><p>{text}</p></div><form><p>Search this</p><input></form>")) == text
    assert main_text(page(f'<div class="content search"><p>{text}</p></div>')) == text
    assert main_text(page(f"<article><p>{text}</p><div class='notice'>Mind the step.</div><p>{FILLER}</p></article>")) == f"{text}\nMind the step.\n{FILLER}"
    assert main_text(page(f"<article><p>{text} <math><mi>x</mi><mo>=</mo><mn>1</mn></math> and <object data=a>fallback</object></p></article>")) == f"{text} x=1 and fallback"
    assert main_text(page(f"<article><p>{text}</p><div class='share notice'>Share</div><div class='ad'>Buy</div></article><div class=notice>We use cookies</div>")) == text


def test_labelled_pages_against_a_plain_version():
    """Pages of known blocks: what belongs to the article, and no other block, comes out."""
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randrange(2, 9)))
    sentence = lambda n: " ".join(word() for _ in range(n)) + "."
    for k in range(60):
        blocks, body = [], []
        for _ in range(r.randrange(4, 12)):
            t = sentence(r.randrange(15, 60))
            blocks.append(t)
            body.append(r.choice([f"<p>{t}</p>", f"<p>{t}", f"<div>{t}</div>", f"<blockquote>{t}</blockquote>", f"<p><i>{t}</i>"]))
        links = lambda: "<ul>" + "".join(f"<li><a href=/{word()}>{word()}</a>" for _ in range(r.randrange(3, 9))) + "</ul>"
        around = [f"<nav>{links()}</nav>", f"<aside><p>{sentence(12)}</p></aside>", f"<footer>{sentence(20)}</footer>", f"<div class='ad'>{sentence(9)}</div>", f"<form>{sentence(4)}<input></form>", f"<div id=comments><p>{sentence(25)}</p></div>", f"<div class=cookie-banner>{sentence(8)}</div>", "<script>var a='<p>no</p>';</script>"]
        r.shuffle(around)
        cut = r.randrange(len(around) + 1)
        wrap = r.choice(["article", "main", "div id=content"])
        html = page("".join(around[:cut]) + f"<{wrap}>" + "".join(body) + f"</{wrap.split()[0]}>" + "".join(around[cut:]))
        assert main_text(html) == "\n".join(blocks), k


def test_time_grows_with_length():
    def took(make, n):
        began = time.perf_counter()
        main_text(make(n))
        return time.perf_counter() - began

    odd = [
        lambda n: "<div>" * n + "x" + "</div>" * n, lambda n: "<p>x</b></i>" * n, lambda n: "<a href=\"x'>y</a> " * n, lambda n: "<div>" + "<b>" * n + "<p>x" * n,
        lambda n: "<a \"> \" <b> " * n, lambda n: "<li><b>" * n + "<li>x" * n, lambda n: "<!-- " * n, lambda n: "<ul><li><p>x" * n, lambda n: "<form><p>x" * n,
    ]
    for make in odd:
        took(make, 500)
        assert took(make, 16_000) < 30 * max(took(make, 2_000), 0.02)


def test_rows(spark):
    rows = [(1, "u", "<p>a"), (1, "u", "<p>a"), (2, None, None), (None, "v", "<p>é&eacute;")]
    df = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")
    out = sorted((tuple(r) for r in extract_main_text(df).collect()), key=str)
    assert out == sorted([(1, "u", "a", 1), (1, "u", "a", 1), (2, None, "", 0), (None, "v", "éé", 2)], key=str)
    assert extract_main_text(df.limit(0)).collect() == []
