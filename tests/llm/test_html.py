"""Main text of pages: trees with omitted tags, broken markup in linear time, and generated pages whose text is known."""

import html as entities
import time

import numpy as np
import pytest

from chronoloom.llm import html

PROSE = "The fox and the dog are in the house of the man who was there with us. " * 4


@pytest.mark.parametrize(
    "page",
    [
        f"<html><head><title>x</title><meta charset=a><body><p>{PROSE}",
        f"<head><link rel=x><p>{PROSE}</p>",
        f"<body><button>Menu<article><p>{PROSE}</p></article>",
        f"<select><option>a<option>b<div><p>{PROSE}</p></div>",
        f"<p class=notice>We have news<div><p>{PROSE}</p></div>",
        f"<p title=don't>{PROSE}</p>",
        f'<div class="share content"><p>{PROSE}</p></div>',
        f'<article><div class="related-work"><p>{PROSE}</p></div></article>',
        f"<article><a href=x><p>On</a><p>{PROSE}</article><footer>end</footer>",
        f"<table><tr><td>a</div><td><p>{PROSE}</table>",
        f"<p>{PROSE}<p class='share-buttons'>Tell the friends of yours",
        f"<title>unclosed<p>{PROSE}</p>",
        f"<nav><ul><li>One<li>Two</ul></nav><p>{PROSE}<aside>Of the side</aside>",
    ],
)
def test_omitted_and_odd_markup(page):
    assert PROSE.strip() in html.main_text(page)
    for word in ("Menu", "Two", "Tell", "side", "end", "news"):
        assert word not in html.main_text(page)


@pytest.mark.parametrize("piece", ["<a ", "</i>", '<a href="', "<a x='y\" ", "<!--", "<", "<title>", "<p><b>", "</div>", "<td>", "&amp", "<a href=x>y"])
def test_a_megabyte_of_anything_takes_linear_time(piece):
    began = time.perf_counter()
    html.main_text(piece * (250_000 // len(piece)))
    small = time.perf_counter() - began
    began = time.perf_counter()
    html.main_text(piece * (1_000_000 // len(piece)))
    assert time.perf_counter() - began < max(10 * small, 2)


def test_generated_pages_give_back_their_article():
    """A page is written from blocks whose kind is known: the expected text is what was put into the article."""
    rng = np.random.default_rng(31)
    common, rare = "the of and in to was is for that with are on".split(), [f"w{i}&" for i in range(300)]

    def prose(n):
        return " ".join(str(rng.choice(common if rng.random() < 0.5 else rare)) for _ in range(n))

    def chrome():
        links = "".join(f"<li><a href='/{i}'>{entities.escape(prose(2))}</a>" for i in range(rng.integers(2, 6)))
        shapes = [f"<nav><ul>{links}</ul></nav>", f"<div class='sidebar widget'><p>{entities.escape(prose(30))}</div>", f"<aside>{entities.escape(prose(25))}</aside>", f"<form><label>{prose(4)}</label><input></form>", "<script>if (a < b) { x('</p>') }</script>", f"<div id=cookie-banner>{prose(20)}</div>", f"<!-- {prose(9)} -->"]
        return str(rng.choice(shapes))

    for _ in range(60):
        parts, expected = [], []
        for _ in range(rng.integers(2, 7)):
            text = prose(int(rng.integers(40, 90)))
            expected.append(text)
            marked = entities.escape(text).replace(" ", str(rng.choice([" ", "\n", "  ", " <b></b>"])), 3)
            parts.append(str(rng.choice([f"<p>{marked}</p>", f"<p>{marked}", f"<div>{marked}</div>", f"<blockquote><p>{marked}</blockquote>"])))
            if rng.random() < 0.4:
                parts.append(chrome())
        body = "".join(parts)
        held = f"<article>{body}</article>" if rng.random() < 0.5 else f"<div class=content>{body}</div>"
        page = f"<html><head><title>{prose(4)}</title></head><body>{chrome()}<header>{prose(5)}</header>{held}{chrome()}<footer>{prose(12)}</footer>"
        assert html.main_text(page) == " ".join(" ".join(x.split()) for x in expected)


def test_pages_without_an_article_keep_short_blocks():
    brief = "<p>It was late. He went out.</p>"
    assert html.main_text(brief * 200) == " ".join(["It was late. He went out."] * 200)
    assert html.main_text(f"<nav><p>Menu</p></nav><p>By the way.</p><p>{PROSE}</p><p>Конец.</p><footer>end</footer>") == f"By the way. {PROSE.strip()} Конец."
    assert html.main_text("<h2>Title</h2>" + brief * 60 + f"<p>{PROSE}</p>").startswith("Title It was late.")
    numbers = "1234 5678 " * 40
    assert numbers.strip() in html.main_text(f"<p>{PROSE}</p><p>{numbers}</p><p>{PROSE}</p>")
    linked = "<p><a href=x>More of the same from us</a></p>" * 3
    assert "More" not in html.main_text(f"<p>{PROSE}</p>{linked}<p>See all.</p>{linked}<h3>Others</h3>{linked}")
    assert "Others" not in html.main_text(f"<p>{PROSE}</p><h3>Others</h3>{linked}")


def test_linked_paragraphs_of_an_article_stay_and_lists_of_links_do_not():
    page = f"<article><p>{PROSE}</p><p><a href=x>the report itself</a></p><p>{PROSE}</p><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></article>"
    assert html.main_text(page) == f"{PROSE.strip()} the report itself {PROSE.strip()}"


@pytest.mark.parametrize("depth", [1, 31, 32, 33, 40, 2000])
def test_comments_stay_out_however_deep(depth):
    wrap = "".join(f"<div class='widget w{i}'>" for i in range(depth))
    assert html.main_text(f"{wrap}<p>{PROSE}</p><div class=comments><p>Readers say {PROSE}</p></div>") == PROSE.strip()


def test_generated_pages_with_paragraphs_of_any_length():
    rng = np.random.default_rng(7)
    common = "the of and in to was is for that with are on".split()
    prose = lambda n: " ".join(str(rng.choice(common)) if rng.random() < 0.5 else f"w{rng.integers(300)}" for _ in range(n))
    for _ in range(60):
        said = [prose(int(rng.integers(1, 11) if rng.random() < 0.5 else rng.integers(40, 90))) + "." for _ in range(rng.integers(1, 9))]
        wraps = int(rng.integers(0, 41))
        body = "".join(f"<div class='content c{i}'>" for i in range(wraps)) + "".join(f"<p>{x}</p>" for x in said) + "</div>" * wraps
        page = f"<body><nav><ul><li><a href=/>{prose(2)}</a></ul></nav>{body}<aside>{prose(20)}</aside><footer>{prose(9)}</footer>"
        assert html.main_text(page) == " ".join(said)


def test_columns_that_clash_and_empty_tables(spark):
    pages = spark.createDataFrame([(1, "u", f"<p>{PROSE}</p>", "x", 5), (1, "u", f"<p>{PROSE}</p>", "x", 5), (None, None, None, None, None)], "page_id long, url string, html string, text string, n_chars int")
    rows = sorted((r["page_id"] or 0, r["url"] or "", r["text"], r["n_chars"]) for r in html.extract(pages).collect())
    assert rows == [(0, "", "", 0)] + [(1, "u", PROSE.strip(), len(PROSE.strip()))] * 2
    assert html.extract(pages.where("page_id > 9")).count() == 0
